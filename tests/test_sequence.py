"""Neighbour rows per key: the skew-safe plan equals the plain window,
also when one key holds a large share of all rows."""

from pyspark.sql import functions as F

from orderflow.operators.sequence import with_neighbours


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_skew_safe_equals_window_with_hot_key(spark):
    n = 3000
    df = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 50).alias("k"),   # key 7: hot
        (F.col("id") * 7919 % 1000).alias("t"),
        F.when(F.col("id") % 11 == 0, F.lit(None)).otherwise(F.col("id") % 13).cast("long").alias("tb"),
        F.concat(F.lit("s"), (F.col("id") % 5).cast("string")).alias("v"))
    df = df.unionByName(df.limit(200))                                                  # exact duplicates
    cols = ["k", "t", "tb", "v", "prev_v", "next_v"]
    plain = with_neighbours(df, ["k"], ["t", "tb", "v"], ["v"], next_prefix="next_v".replace("v", ""))
    safe = with_neighbours(df, ["k"], ["t", "tb", "v"], ["v"], next_prefix="next_", skew_safe=True,
                           partitions=7)
    assert _rows(safe.select(*cols)) == _rows(plain.select(*cols))


def test_skew_safe_spreads_hot_key(spark):
    df = spark.range(4000).select(F.lit(1).alias("k"), F.col("id").alias("t"), (F.col("id") % 3).alias("v"))
    out = with_neighbours(df, ["k"], ["t"], ["v"], skew_safe=True, partitions=8)
    assert out.where(F.col("prev_v").isNull()).count() == 1        # only the very first row
    sizes = (df.withColumn("__seq", F.monotonically_increasing_id())
             .repartitionByRange(8, "k", "t").groupBy(F.spark_partition_id()).count().collect())
    assert len(sizes) > 1


def test_fill_forward_carries_across_many_partitions(spark):
    from orderflow.operators.sequence import fill_forward
    rows = [(1, t, 100.0 if t == 0 else (5.0 if t == 1500 else None)) for t in range(3000)]
    rows += [(2, t, None if t % 7 else float(t)) for t in range(500)]
    rows += [(0, t, None) for t in range(50)]
    df = spark.createDataFrame(rows, "k int, t int, v double")
    plain = _rows(fill_forward(df, ["k"], ["t"], ["v"], skew_safe=False))
    safe = _rows(fill_forward(df, ["k"], ["t"], ["v"], skew_safe=True, partitions=9))
    assert safe == plain
    got = {(k, t): v for k, t, v in plain}
    assert got[(1, 1499)] == 100.0 and got[(1, 2999)] == 5.0 and got[(0, 10)] is None


def test_latest_rows_salted_equals_plain_with_hot_key(spark):
    from orderflow.operators.latest import latest_rows
    df = spark.range(6000).select(
        F.when(F.col("id") % 3 == 0, F.lit(1)).otherwise(F.col("id") % 40).alias("k"),
        (F.col("id") % 97).alias("t"), (F.col("id") % 7).alias("v"))
    df = df.unionByName(df.where(F.col("k") == 1).limit(50))          # exact duplicates on the hot key
    for tie in ("keep_all", "one"):
        plain = _rows(latest_rows(df, ["k"], "t", on_tie=tie, skew_safe=False))
        salted = latest_rows(df, ["k"], "t", on_tie=tie, skew_safe=True, salts=5)
        assert _rows(salted) == plain, tie
        plan = salted._jdf.queryExecution().executedPlan().toString()
        assert "__salt" in plan


def test_hot_feed_order_is_spread_before_the_latest_is_taken(spark):
    """An order with a third of all rows, behind a join on the order key."""
    from orderflow.operators.latest import latest_rows
    rows = spark.range(3000).select(F.when(F.col("id") % 3 == 0, F.lit(1)).otherwise(F.col("id")).alias("k"), F.col("id").alias("t"))
    feed = rows.join(rows.select("k").distinct().hint("shuffle_hash"), "k")
    plan = latest_rows(feed, ["k"], "t", skew_safe=True)._jdf.queryExecution().executedPlan().toString()
    assert "REPARTITION_BY_NUM" in plan and "__salt" in plan
    assert _rows(latest_rows(feed, ["k"], "t", skew_safe=True)) == _rows(latest_rows(feed, ["k"], "t"))


def test_operators_run_no_job_while_they_plan(spark):
    from pathlib import Path

    import orderflow.operators as ops
    for f in Path(ops.__file__).parent.glob("*.py"):
        assert ".first()" not in f.read_text(), f
