"""Marts: latest state per order and hourly KPIs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.money import avg_money, pct
from ..functions.times import trunc_ntz
from ..operators.latest import latest_rows
from ..schemas import ORDER_STATUSES, TERMINAL_STATUSES


def is_terminal(status_col: str = "status"):
    """delivered/cancelled -> true; any other status, NULL included -> false."""
    return F.coalesce(F.col(status_col).isin(*TERMINAL_STATUSES), F.lit(False))


def fct_orders(stg: DataFrame, on_tie: str = "keep_all", method: str = "rank",
               drop_deleted: bool = False, skew_safe: bool = False) -> DataFrame:
    """Latest state of each order plus terminal flag, hour and day.

    Deletes stay in the fact like in the reference unless ``drop_deleted``.
    """
    latest = latest_rows(stg, ["order_id"], "processed_at", on_tie=on_tie, method=method,
                         skew_safe=skew_safe)
    return state_columns(latest, drop_deleted)


def state_columns(latest: DataFrame, drop_deleted: bool = False) -> DataFrame:
    """The fact's columns over rows that are the latest of their orders."""
    if drop_deleted:
        latest = latest.where(F.col("operation_type") != F.lit("DELETE"))
    return latest.select(
        *latest.columns,
        is_terminal().alias("is_terminal_state"),
        trunc_ntz("hour", F.col("created_at")).alias("created_hour"),
        trunc_ntz("day", F.col("created_at")).alias("created_day"),
    )


def _count_status(s: str):
    return F.count(F.when(F.col("status") == F.lit(s), F.lit(1)))


def fct_order_metrics(fct: DataFrame) -> DataFrame:
    """Hourly KPIs over the fact, one row per ``created_hour`` (NULL hour is
    a group).  Partial aggregation runs before the shuffle, so only one
    buffer per hour and map task crosses the network.

    Money stays DECIMAL; the average is an exact DECIMAL sum divided once in
    DOUBLE and rounded to cents; the cancellation percentage is exact.
    """
    agg = fct.groupBy(F.col("created_hour").alias("metric_hour")).agg(
        F.count(F.lit(1)).alias("total_orders"),
        *[_count_status(s).alias(f"{s}_orders") for s in ORDER_STATUSES],
        F.sum("total_amount").alias("gross_revenue"),
        F.sum(F.when(F.col("status") != F.lit("cancelled"), F.col("total_amount"))
              .otherwise(F.lit(0))).alias("net_revenue"),
        avg_money(F.col("total_amount")).alias("avg_order_value"),
        pct(_count_status("cancelled"), F.count(F.lit(1))).alias("cancellation_rate_pct"),
    )
    return agg.select(
        "metric_hour", "total_orders", *[f"{s}_orders" for s in ORDER_STATUSES],
        F.round("gross_revenue", 2).alias("gross_revenue"),
        F.round("net_revenue", 2).alias("net_revenue"),
        "avg_order_value", "cancellation_rate_pct",
    )


def status_pivot_hourly(fct: DataFrame) -> DataFrame:
    """Hourly order counts per status (fixed pivot of the five statuses)."""
    return fct.groupBy(F.col("created_hour").alias("metric_hour")).agg(
        F.count(F.lit(1)).alias("total_orders"),
        *[_count_status(s).alias(f"{s}_orders") for s in ORDER_STATUSES],
    )


def cancellation_rate(fct: DataFrame) -> DataFrame:
    """Hourly cancellation percentage with the NULLIF guard."""
    return fct.groupBy(F.col("created_hour").alias("metric_hour")).agg(
        F.count(F.lit(1)).alias("total_orders"),
        _count_status("cancelled").alias("cancelled_orders"),
        pct(_count_status("cancelled"), F.count(F.lit(1))).alias("cancellation_rate_pct"),
    )


def open_orders(state: DataFrame) -> DataFrame:
    """Orders that can still change: status not delivered/cancelled (a NULL
    status is not open either, as in ``NOT IN``)."""
    return state.where(~F.col("status").isin(*TERMINAL_STATUSES))
