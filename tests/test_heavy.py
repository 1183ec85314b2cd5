"""Heavy keys are found by a count and cut into slices; the others take one window and no checkpoint."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql.classic.dataframe import DataFrame as Classic

import __spark_entry__ as E
from orderflow.operators import heavy
from orderflow.operators.heavy import cut_heavy, heavy_keys, key_in
from orderflow.operators.history import with_versions
from orderflow.operators.intervals import counts_around

T0 = dt.datetime(2020, 1, 1)
HOUR = dt.timedelta(hours=1)


@pytest.fixture()
def tables(spark, tmp_dir):
    """Line items and orders with a key that holds half the rows, null keys and times, and prices that stay."""
    items = [(i // 2, None if i % 31 == 0 else 7 if i % 2 else i % 40 + 1, i % 2 + 1, 2.0, None if i % 43 == 0 else float(i % 3),
              None if i % 37 == 0 else T0 + 5 * HOUR * (i % 450)) for i in range(1200)]
    orders = [(k, k % 50, T0 + 9 * HOUR * (k % 333)) for k in range(620)]
    spark.createDataFrame(items, "l_orderkey long, l_partkey long, l_linenumber int, l_quantity double, l_extendedprice double, "
                          "l_shipdate timestamp_ntz").write.parquet(tmp_dir + "/lineitem.parquet")
    spark.createDataFrame([(k, f"Customer#{k:09d}", k % 25) for k in range(50)], "c_custkey long, c_name string, c_nationkey int") \
        .write.parquet(tmp_dir + "/customer.parquet")
    spark.createDataFrame([(k, f"part {k}", "type", k % 9, 10.0 + k) for k in range(42)], "p_partkey long, p_name string, p_type string, "
                          "p_size int, p_retailprice double").write.parquet(tmp_dir + "/part.parquet")
    spark.createDataFrame(orders, "o_orderkey long, o_custkey long, o_orderdate timestamp_ntz").write.parquet(tmp_dir + "/orders.parquet")
    return tmp_dir


@pytest.fixture()
def checkpoints(monkeypatch):
    """A list that grows with each checkpoint."""
    made = []
    real = Classic.checkpoint
    monkeypatch.setattr(Classic, "checkpoint", lambda self, *a, **k: (made.append(1), real(self, *a, **k))[1])
    return made


def test_heavy_keys_are_counted_null_too(spark):
    df = spark.range(300).select(F.when(F.col("id") % 3 == 0, F.lit(None).cast("long")).when(F.col("id") % 3 == 1, F.lit(5))
                                 .otherwise(F.col("id") + 1000).alias("k"))
    assert heavy_keys(df, "k", 99) == [None, 5] and heavy_keys(df, "k", 100) == []
    many = spark.range(1000).select((F.col("id") % 100).alias("k"))
    assert len(heavy_keys(many, "k", 1)) == int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_every_row_goes_to_one_side(spark):
    df = spark.createDataFrame([(None,), (1,), (2,), (3,)], "k long")
    for keys in ([], [None], [1], [1, None], [9]):
        inside = {r.k for r in df.where(key_in("k", keys)).collect()}
        outside = {r.k for r in df.where(~key_in("k", keys)).collect()}
        assert inside == set(keys) & {None, 1, 2, 3} and inside | outside == {None, 1, 2, 3} and not inside & outside
    seen = []
    got = cut_heavy(lambda a, safe: (seen.append(safe), a.withColumn("safe", F.lit(safe)))[1], [2], (df, "k"))
    assert seen == [False, True] and {(r.k, r.safe) for r in got.collect()} == {(None, False), (1, False), (2, True), (3, False)}


@pytest.mark.parametrize("name", ["orders_around_price_change", "product_price_history", "price_asof_order", "orders_with_versions"])
def test_only_heavy_keys_are_sliced(spark, tables, checkpoints, monkeypatch, name):
    """Slices of all rows made four checkpoints of nearly all line items for small keys."""
    rows = lambda: sorted(map(str, E.queries()[name](spark, tables).collect()))
    plain = rows()
    assert plain and not checkpoints
    monkeypatch.setattr(heavy, "HEAVY_ROWS", 30)
    assert rows() == plain and checkpoints


def test_versions_of_heavy_keys_are_sliced_alone(spark, checkpoints):
    keys = [None, 1, 1, 1, 2, 3]
    versions = [(k, f"{k} {n}", T0 + n * 50 * HOUR, T0 + (n * 50 + 40) * HOUR) for k in (1, 2) for n in range(5)]
    events = spark.createDataFrame([(i, keys[i % 6], keys[i % 5], T0 + i * HOUR) for i in range(240)], "i long, x long, y long, at timestamp_ntz")
    of = lambda key: (spark.createDataFrame(versions, f"{key} long, v string, valid_from timestamp_ntz, valid_to timestamp_ntz"), key, ["v"])
    rows = lambda **kw: sorted(map(str, with_versions(events, "at", {"a": of("x"), "b": of("y")}, **kw).collect()))
    plain = rows()
    assert len(plain) == 240 and rows(heavy={"a": [], "b": []}) == plain and not checkpoints
    for heavy_of in ({"a": [1]}, {"a": [None], "b": [1, 2]}):
        del checkpoints[:]
        assert rows(heavy=heavy_of) == plain and len(checkpoints) == 1


def test_a_point_stands_once_in_its_sequence(spark):
    points = spark.createDataFrame([(1, T0)], "k long, at timestamp_ntz")
    events = spark.createDataFrame([(1, T0)], "k long, t timestamp_ntz")
    plan = counts_around(points, events, "k", "at", "t", {"w": (-1, 1), "v": (2, 3)})._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in plan and plan.count("Union") == 1


@pytest.mark.parametrize("unit, micros", [("MICROSECOND", 1), ("SECOND", 10**6), ("HOUR", 3600 * 10**6), ("WEEK", 7 * 86400 * 10**6)])
def test_ends_are_exact_to_the_microsecond(spark, unit, micros):
    one = dt.timedelta(microseconds=1)
    edges = [T0 + s * dt.timedelta(microseconds=micros) * n + off * one for s in (-1, 0, 1) for n in (1, 2) for off in (-1, 0, 1)]
    windows = {"before": (-2, 0), "none": (0, 0), "after": (0, 1), "late": (1, 2), "early": (-2, -1)}
    points = spark.createDataFrame([(1, T0), (None, T0), (1, None), (2, T0)], "k long, at timestamp_ntz")
    events = spark.createDataFrame([(1, t) for t in edges] + [(None, T0), (1, None)], "k long, t timestamp_ntz")
    span = dt.timedelta(microseconds=micros)
    want = [sum(T0 + a * span <= t < T0 + b * span for t in edges) for a, b in windows.values()]
    for safe in (False, True):
        got = {(r.k, r.at): [r[w] for w in windows] for r in counts_around(points, events, "k", "at", "t", windows, unit, safe).collect()}
        assert got == {(1, T0): want, (None, T0): [0] * 5, (1, None): [0] * 5, (2, T0): [0] * 5}


def test_units_without_one_length(spark):
    points = spark.createDataFrame([(1, dt.datetime(2020, 3, 1))], "k long, at timestamp_ntz")
    events = spark.createDataFrame([(1, dt.datetime(2020, 2, d)) for d in (1, 29)], "k long, t timestamp_ntz")
    (row,) = counts_around(points, events, "k", "at", "t", {"n": (-1, 0)}, "MONTH").collect()
    assert row.n == 2
