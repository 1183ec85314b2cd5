"""Versioned tables, partition pruning and the build-then-test gate."""

import pytest
from pyspark.sql import functions as F

from orderflow.operators.checks import run_declared_tests
from orderflow.plans import build, models
from orderflow.sources import tables as TB
from tests.conftest import SF_SMALL


def test_day_partitions_prune(spark, tmp_dir):
    fct = models.fact(spark, SF_SMALL)
    path = TB.write_fct_orders(fct, tmp_dir)
    df = TB.read_fct_orders(spark, path, "1996-01-01 00:00:00", "1996-02-01 00:00:00")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "created_date" in plan
    want = fct.where((F.col("created_at") >= "1996-01-01") & (F.col("created_at") < "1996-02-01")).count()
    assert df.count() == want > 0


def test_publish_gate(spark, tmp_dir):
    stg = models.staged(spark, SF_SMALL)
    fct = models.fact(spark, SF_SMALL)
    checks = lambda written: run_declared_tests(stg, written)
    ok, failures, _ = TB.publish_if_valid(spark, fct, tmp_dir, "fct_orders", checks)
    assert not ok and any(f[2] == "unique" for f in failures)   # ties make order_id non-unique
    with pytest.raises(FileNotFoundError):
        TB.read_current(spark, tmp_dir, "fct_orders")
    ok, failures, path = TB.publish_if_valid(spark, fct, tmp_dir, "fct_orders", checks,
                                             allow=lambda r: r[2] == "unique")
    assert ok and TB.read_current(spark, tmp_dir, "fct_orders").count() == fct.count()
    one = models.fact(spark, SF_SMALL, on_tie="one")
    ok, failures, path2 = TB.publish_if_valid(spark, one, tmp_dir, "fct_orders", checks)
    assert ok and not failures
    assert path2 == f"{tmp_dir}/fct_orders" and TB.read_current(spark, tmp_dir, "fct_orders").count() == one.count() < fct.count()


def test_required_columns(spark):
    fct = models.fact(spark, SF_SMALL)
    rows = TB.fct_required_check(fct).collect()
    assert {r.column_name for r in rows} == {"order_id", "customer_id", "product_id", "quantity", "unit_price",
                                             "total_amount", "status", "operation_type"}
    assert all(r.failures == 0 for r in rows)
    lost = fct.withColumn("status", F.when(F.col("order_id") % 2 == 0, F.col("status")))
    found = {r.column_name: r.failures for r in TB.fct_required_check(lost).collect()}
    assert found["status"] == fct.where("order_id % 2 <> 0").count() > 0 and found["quantity"] == 0


def test_undeclared_types_and_missing_columns_raise(spark):
    fct = models.fact(spark, SF_SMALL)
    with pytest.raises(ValueError, match="quantity"):
        TB.fct_required_check(fct.withColumn("quantity", F.col("quantity").cast("string")))
    with pytest.raises(ValueError, match="missing"):
        TB.fct_required_check(fct.drop("created_day"))


def test_build_does_not_publish_a_wrong_type(spark, tmp_dir, monkeypatch):
    made = build.fct_orders
    monkeypatch.setattr(build, "fct_orders",
                        lambda stg, **k: made(stg, **k).limit(5).withColumn("quantity", F.col("quantity").cast("bigint")))
    with pytest.raises(ValueError, match="quantity"):
        build.build_marts(spark, models.processed_events(spark, SF_SMALL), tmp_dir, partition_metrics_by_day=False)
    with pytest.raises(FileNotFoundError):
        TB.read_current(spark, tmp_dir, "fct_orders")


def _rows_scanned(df):
    """Rows that the file scan of an executed plan let through."""
    df.collect()
    leaves = df._jdf.queryExecution().executedPlan().collectLeaves()
    return sum(leaves.apply(i).metrics().apply("numOutputRows").value() for i in range(leaves.size())
               if leaves.apply(i).metrics().contains("numOutputRows"))


def test_ordered_files_prune_by_their_statistics(spark, tmp_dir):
    met = models.metrics(spark, SF_SMALL)
    path = TB.write_ordered_metrics(met, f"{tmp_dir}/m", files=8)
    got = spark.read.parquet(path)
    assert got.count() == met.count()
    ranges = sorted((r.lo, r.hi) for r in got.groupBy(F.input_file_name().alias("f")).agg(
        F.min("metric_hour").alias("lo"), F.max("metric_hour").alias("hi")).collect())
    assert len(ranges) > 4 and all(a[1] < b[0] for a, b in zip(ranges, ranges[1:]))    # files do not overlap
    some = TB.read_ordered_metrics(spark, path, "1996-01-01 00:00:00", "1996-02-01 00:00:00")
    want = met.where("metric_hour >= '1996-01-01' AND metric_hour < '1996-02-01'").count()
    assert 0 < some.count() == want <= _rows_scanned(some) < got.count() / 2


def test_compaction_packs_small_files_by_size(spark, tmp_dir):
    import glob
    rows = spark.range(40_000).selectExpr("id", "md5(cast(id as string)) AS x")
    for n in (1, 3, 20):
        rows.repartition(n).write.mode("append").parquet(f"{tmp_dir}/src")
    size = lambda d: [__import__("os").path.getsize(f) for f in glob.glob(f"{tmp_dir}/{d}/part-*")]
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    TB.compact(spark, f"{tmp_dir}/src", f"{tmp_dir}/out", file_bytes=2_000_000)
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") == before
    assert len(size("src")) == 24 and sum(size("src")) / 2_000_000 <= len(size("out")) <= 6
    assert max(size("out")) < 2_500_000
    a, b = (spark.read.parquet(f"{tmp_dir}/{d}") for d in ("src", "out"))
    assert a.exceptAll(b).isEmpty() and a.count() == b.count()
