"""Batch build with the test gate, then published."""

from orderflow.plans import marts, models
from orderflow.plans.build import build_marts, read_mart
from tests.conftest import SF_SMALL


def _rows(df, cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=repr)


def test_build_blocks_then_publishes(spark, tmp_dir):
    proc = models.processed_events(spark, SF_SMALL)
    res = build_marts(spark, proc, tmp_dir, partition_metrics_by_day=False)
    assert not res.published and [f[2] for f in res.failures] == ["unique"]
    res = build_marts(spark, proc, tmp_dir, allow=lambda r: r[2] == "unique", partition_metrics_by_day=False)
    assert res.published
    fct = models.fact(spark, SF_SMALL)
    assert _rows(read_mart(spark, tmp_dir, "fct_orders"), fct.columns) == _rows(fct, fct.columns)
    met = marts.fct_order_metrics(fct)
    assert _rows(read_mart(spark, tmp_dir, "fct_order_metrics"), met.columns) == _rows(met, met.columns)


def test_bounded_read_prunes_metric_days(spark, tmp_dir):
    res = build_marts(spark, models.processed_events(spark, SF_SMALL), tmp_dir, allow=lambda r: r[2] == "unique")
    assert res.published
    met = read_mart(spark, tmp_dir, "fct_order_metrics", "1996-01-01 00:00:00", "1996-02-01 00:00:00")
    plan = met._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(metric_date" in plan
    want = marts.fct_order_metrics(models.fact(spark, SF_SMALL)).where(
        "metric_hour >= '1996-01-01' AND metric_hour < '1996-02-01'")
    assert _rows(met, want.columns) == _rows(want, want.columns)
