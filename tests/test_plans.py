"""Plan shape: the properties the scale design relies on."""

from pyspark.sql import functions as F

from orderflow.operators.latest import latest_rows
from orderflow.plans import models
from orderflow.plans.staging import stg_orders
from orderflow.schemas import ORDERS_PROCESSED
from tests.conftest import SF_SMALL


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_latest_state_over_files_limits_before_the_shuffle(spark, tmp_dir):
    models.processed_events(spark, SF_SMALL).write.parquet(tmp_dir + "/p")
    stg = stg_orders(spark.read.schema(ORDERS_PROCESSED).parquet(tmp_dir + "/p"))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = _plan(latest_rows(stg, ["order_id"], "processed_at"))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert plan.count("Exchange") == 1
    assert "WindowGroupLimit" in plan and "Partial" in plan and "Final" in plan


def test_feed_window_reuses_join_partitioning(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = _plan(models.fact(spark, SF_SMALL))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert plan.count("Exchange hashpartitioning") == 2       # the join's two sides only
    assert "SortMergeJoin" in plan


def test_scan_prunes_columns_and_pushes_filters(spark):
    plan = _plan(models.fact(spark, SF_SMALL).select("status"))
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint,l_linenumber:int" in plan or \
           "l_tax" not in plan
    assert "PushedFilters: [IsNotNull(l_shipdate)" in plan or "PushedFilters" in plan
    assert "l_comment" not in plan and "l_tax" not in plan and "o_orderpriority" not in plan


def test_hourly_metrics_aggregate_partially(spark):
    plan = _plan(models.metrics(spark, SF_SMALL))
    assert "partial_count" in plan and "partial_sum" in plan


def test_the_fact_cuts_hot_orders_down_before_the_exchange(spark):
    plan = models.fact(spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    above, below = plan.split("Exchange hashpartitioning(l_orderkey", 1)
    assert "WindowGroupLimit" in below and plan.count("Exchange hashpartitioning(l_orderkey") == 1
