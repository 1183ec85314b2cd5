"""Semantics of staging, latest state and metrics."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from orderflow.operators.latest import latest_rows
from orderflow.plans import marts, panels
from orderflow.plans.ingest import processed
from orderflow.plans.staging import stg_orders
from orderflow.schemas import ORDERS_PROCESSED, ORDERS_WIRE


def _proc(spark, rows):
    return spark.createDataFrame(rows, ORDERS_PROCESSED)


def P(id_, status, ts, op="UPDATE", qty=1, price=10.0, created="2024-01-01T10:15:00Z", cust=1, prod=1):
    return (id_, cust, prod, qty, price, None, status, op, created, created, ts)


def test_filter_and_decode(spark):
    wire = spark.createDataFrame([
        (1, 1, 1, 1, 1.0, None, "pending", None, None, op, "orders", 1) for op in ["c", "u", "d", "r", None, "x"]
    ], ORDERS_WIRE)
    ops = [r["operation"] for r in processed(wire).collect()]
    assert ops == ["INSERT", "UPDATE", "DELETE"]
    ops = [r["operation"] for r in processed(wire, include_snapshot=True).collect()]
    assert ops == ["INSERT", "UPDATE", "DELETE", "INSERT"]


def test_staging_types_and_normalisation(spark):
    stg = stg_orders(_proc(spark, [
        P(1, " Pending", 1_700_000_000_123, op=" insert ", qty=3, price=1.1),
        P(None, "x", 1), (2, None, 1, 1, 1.0, None, "x", "u", None, None, 1),
    ]))
    rows = stg.collect()
    assert len(rows) == 1
    r = rows[0]
    assert r.status == "pending" and r.operation_type == "INSERT"
    assert r.total_amount == Decimal("3.30") and r.unit_price == Decimal("1.10")
    assert r.processed_at == dt.datetime(2023, 11, 14, 22, 13, 20, 123000)
    assert r.created_at == dt.datetime(2024, 1, 1, 10, 15)


def test_timestamp_offsets_and_quarantine(spark):
    rows = [P(1, "pending", 1, created=c) for c in
            ["2024-01-01T12:00:00+02:00", "2024-01-01T10:00:00", "2024-01-01T10:00:00.5Z"]]
    out = [r.created_at for r in stg_orders(_proc(spark, rows)).collect()]
    assert out == [dt.datetime(2024, 1, 1, 10), dt.datetime(2024, 1, 1, 10),
                   dt.datetime(2024, 1, 1, 10, 0, 0, 500000)]
    bad = _proc(spark, [P(1, "pending", 1, created="not a time")])
    with pytest.raises(Exception):
        stg_orders(bad).collect()
    assert stg_orders(bad, strict_timestamps=False).collect()[0].created_at is None


def test_latest_keeps_ties_and_drops_null(spark):
    stg = stg_orders(_proc(spark, [
        P(1, "pending", 100), P(1, "confirmed", 200), P(1, "cancelled", 200),   # tie at max
        P(1, "confirmed", 200),                                                  # exact duplicate
        P(2, "pending", None),                                                   # only NULL time
        P(3, "pending", None), P(3, "shipped", 50),
    ]))
    rank = sorted((r.order_id, r.status) for r in latest_rows(stg, ["order_id"], "processed_at").collect())
    join = sorted((r.order_id, r.status) for r in
                  latest_rows(stg, ["order_id"], "processed_at", method="join").collect())
    assert rank == join == [(1, "cancelled"), (1, "confirmed"), (1, "confirmed"), (3, "shipped")]
    one = latest_rows(stg, ["order_id"], "processed_at", on_tie="one").collect()
    assert sorted(r.order_id for r in one) == [1, 3]


def test_metrics_semantics(spark):
    stg = stg_orders(_proc(spark, [
        P(1, "cancelled", 1, price=10.0), P(2, "pending", 1, price=20.0), P(3, "pending", 1, price=30.0),
        P(4, None, 1, price=5.0),
        P(5, "pending", 1, created=None, price=1.0),
    ]))
    fct = marts.fct_orders(stg)
    m = {r.metric_hour: r for r in marts.fct_order_metrics(fct).collect()}
    h = m[dt.datetime(2024, 1, 1, 10)]
    assert h.total_orders == 4 and h.cancelled_orders == 1 and h.pending_orders == 2
    assert h.gross_revenue == Decimal("65.00")
    assert h.net_revenue == Decimal("50.00")            # NULL status: in gross, not in net
    assert h.avg_order_value == 16.25
    assert h.cancellation_rate_pct == 25.0
    assert m[None].total_orders == 1                    # NULL hour is its own group
    terminal = {r.order_id: r.is_terminal_state for r in fct.collect()}
    assert terminal == {1: True, 2: False, 3: False, 4: False, 5: False}


def test_series_newest_48_hours(spark):
    rows = [P(i, "pending", 1, created=f"2024-01-{1 + i // 24:02d}T{i % 24:02d}:00:00Z") for i in range(60)]
    fct = marts.fct_orders(stg_orders(_proc(spark, rows)))
    s = panels.hourly_order_volume(marts.fct_order_metrics(fct)).collect()
    assert len(s) == 48 and s[0].ts > s[-1].ts and all(r.value == 1 for r in s)
    few = panels.hourly_revenue(marts.fct_order_metrics(fct), points=48,
                                start="2024-01-03 00:00:00").collect()
    assert len(few) == 12


def test_unknown_metric(spark):
    with pytest.raises(KeyError):
        panels.metric("nope", None, None)
