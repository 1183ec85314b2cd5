"""Running totals and counts in time windows against brute force, with a hot key."""

import datetime as dt
import random

from orderflow.operators.intervals import counts_around, orders_around_price_change, running_total

DAY = dt.timedelta(days=1)
T0 = dt.datetime(2020, 1, 1)


def _events(n=600, seed=5):
    """Two thirds of the rows on one key, ties, null keys and times."""
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        key = None if i % 97 == 0 else 1 if rnd.random() < 0.66 else rnd.randrange(2, 9)
        at = None if i % 89 == 0 else T0 + DAY * rnd.randrange(40)
        rows.append((key, at))
    return rows


def test_running_total_of_a_hot_key(spark):
    rows = [(1 if i % 3 else i % 7, i, i % 5) for i in range(500)]
    df = spark.createDataFrame(rows, "k long, o long, w long")
    want = {}
    sums = {}
    for k, o, w in sorted(rows, key=lambda r: r[1]):
        sums[k] = sums.get(k, 0) + w
        want[o] = sums[k]
    for skew_safe in (False, True):
        got = running_total(df, ["k"], ["o"], "w", "total", skew_safe=skew_safe, partitions=7)
        assert got.columns == ["k", "o", "w", "total"]
        assert {r.o: r.total for r in got.collect()} == want


def test_counts_around_equal_brute_force(spark):
    events, points = _events(), [(k, t, i % 4) for i, (k, t) in enumerate(_events(120, 6))] + [(1, T0, 0), (1, T0, 0)]
    windows = {"before": (-7, 0), "after": (0, 7), "none": (3, 3), "far": (-400, 400)}
    ev = spark.createDataFrame(events, "k long, t timestamp_ntz")
    pt = spark.createDataFrame(points, "k long, at timestamp_ntz, extra long")

    def count(k, at, a, b):
        return 0 if k is None or at is None else sum(x == k and t is not None and at + a * DAY <= t < at + b * DAY for x, t in events)

    want = sorted((str(p), [count(p[0], p[1], a, b) for a, b in windows.values()]) for p in set(points))
    for skew_safe in (False, True):
        got = counts_around(pt, ev, "k", "at", "t", windows, skew_safe=skew_safe).collect()
        assert sorted((str((r.k, r.at, r.extra)), [r[w] for w in windows]) for r in got) == want


def test_first_price_is_no_change_and_empty_input(spark):
    versions = spark.createDataFrame([(1, 5.0, T0), (1, 6.0, T0 + 10 * DAY), (2, 1.0, T0)], "product_id long, price double, valid_from timestamp_ntz")
    orders = spark.createDataFrame([(1, T0 + d * DAY) for d in (0, 9, 10, 10, 12)], "product_id long, created_at timestamp_ntz")
    (row,) = orders_around_price_change(versions, orders, days=5).collect()
    assert (row.product_id, row.changed_at, row.old_price, row.new_price) == (1, T0 + 10 * DAY, 5.0, 6.0)
    assert (row.orders_before, row.orders_after, row.rate_before, row.rate_after) == (1, 3, 0.2, 0.6)
    assert orders_around_price_change(versions.limit(0), orders).count() == 0
    (row,) = orders_around_price_change(versions, orders.limit(0)).collect()
    assert (row.orders_before, row.orders_after) == (0, 0)


def test_plan_has_no_range_or_cross_join(spark):
    versions = spark.createDataFrame([(1, 5.0, T0)], "product_id long, price double, valid_from timestamp_ntz")
    orders = spark.createDataFrame([(1, T0)], "product_id long, created_at timestamp_ntz")
    plan = orders_around_price_change(versions, orders)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Cartesian" not in plan
