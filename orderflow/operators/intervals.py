"""Running totals per key, and counts of events inside time windows (M2).

How many events of a key fall into ``[from, to)`` is the difference of two
running totals: those before ``to`` less those before ``from``.  Events and
points are put into one sequence per key, and the totals are taken over frames
that grow along it.  Where a key is cut into slices, the window ends stand in
the sequence in place of the points, and each picks up the total where it
stands.  Either way one union and one sort, no range join, and a window costs
at most two rows however many events it holds.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .sequence import _nulls_last_exprs, _range_slices, _same_key, _window

# Units of one length, in microseconds.
_MICROS = {"MICROSECOND": 1, "MILLISECOND": 1_000, "SECOND": 1_000_000, "MINUTE": 60_000_000, "HOUR": 3_600_000_000,
           "DAY": 86_400_000_000, "WEEK": 604_800_000_000}


def running_total(df: DataFrame, keys: list[str], order_cols: list[str], weight: str, alias: str,
                  skew_safe: bool = False, partitions: int | None = None) -> DataFrame:
    """Add the sum of ``weight`` over the rows of the key up to this one.

    Rows of equal order are taken in some order, one after the other.  Plain
    plan: a running window on ``keys``.  Skew-safe plan (the caller's choice,
    for keys that may hold a large share of the rows): the total runs in range
    slices of (keys, order); what earlier slices hold of a slice's first key
    comes from a table of one row per slice, which is broadcast.
    """
    if not skew_safe:
        w = _window(keys, order_cols).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        return df.withColumn(alias, F.sum(weight).over(w))
    n_parts = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows, _, _, w = _range_slices(df, keys, order_cols, n_parts)
    total = F.sum(weight).over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    # what the last key of each slice adds to the slices after it
    key = F.struct(*[F.col(k) for k in keys])
    sums = rows.groupBy("__pid", *keys).agg(F.sum(weight).alias("__sum"))
    pos = F.struct(*_nulls_last_exprs(keys))
    edges = sums.groupBy("__pid").agg(F.max_by(F.struct(*[F.col(k) for k in keys], F.col("__sum")), pos).alias("__last"))
    so_far = Window.partitionBy(*[F.col(f"__last.{k}") for k in keys]).orderBy("__pid") \
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    edges = edges.withColumn("__carry", F.sum("__last.__sum").over(so_far))
    along = Window.orderBy("__pid")
    carry = edges.select("__pid", F.lag("__last").over(along).alias("__before"), F.lag("__carry").over(along).alias("__carry"))
    joined = rows.withColumn(alias, total).join(F.broadcast(carry), "__pid", "left")
    carried = F.when(_same_key("__before", keys), F.col("__carry")).otherwise(F.lit(0))
    return joined.select(*df.columns, (F.col(alias) + carried).alias(alias))


def counts_around(points: DataFrame, events: DataFrame, key: str, at: str, event_ts: str,
                  windows: dict[str, tuple[int, int]], unit: str = "DAY", skew_safe: bool = False) -> DataFrame:
    """For each row of ``points`` and each window ``name: (a, b)``, the number
    of ``events`` of the same ``key`` with ``at + a <= event_ts < at + b``
    (a <= b, in ``unit``).

    Rows of ``points`` that are equal in all columns come back once; a null
    key or time has no events: zeros.  Events without a time are in no window.
    """
    for name, (a, b) in windows.items():
        if a > b:
            raise ValueError(f"window {name!r} ends before it begins")
    ends = sorted({e for w in windows.values() for e in w})
    spark_type = dict(points.dtypes)[at]
    if not skew_safe and spark_type == "timestamp_ntz" and unit in _MICROS:
        return _counts_by_frames(points.distinct(), events, key, at, event_ts, windows, _MICROS[unit])
    probe = F.explode(F.array(*[F.lit(e) for e in ends])).alias("__end")
    probes = points.where(F.col(key).isNotNull() & F.col(at).isNotNull()).distinct().select("*", probe)
    probes = probes.withColumn("__t", F.timestamp_add(unit, F.col("__end"), F.col(at)).cast(spark_type)) \
        .withColumn("__n", F.lit(0).cast("bigint"))
    # an end comes before the events of its own instant
    side = events.where(F.col(key).isNotNull() & F.col(event_ts).isNotNull()).select(
        F.col(key), F.col(event_ts).cast(spark_type).alias("__t"), F.lit(1).cast("bigint").alias("__n"))
    both = probes.unionByName(side, allowMissingColumns=True).withColumn("__of", F.struct(*points.columns))
    both = both.select(F.col(key).alias("__k"), "__t", "__n", "__end", F.when(F.col("__n") == 0, F.col("__of")).alias("__of"))
    totals = running_total(both, ["__k"], ["__t", "__n"], "__n", "__total", skew_safe=skew_safe).where(F.col("__n") == 0)
    total_at = lambda e: F.sum(F.when(F.col("__end") == e, F.col("__total")).otherwise(0))
    counted = totals.groupBy("__of").agg(*[(total_at(b) - total_at(a)).alias(name) for name, (a, b) in windows.items()])
    counted = counted.select("__of.*", *windows)
    rest = points.where(F.col(key).isNull() | F.col(at).isNull()).distinct()
    return counted.unionByName(rest.select("*", *[F.lit(0).cast("bigint").alias(name) for name in windows]))


def _counts_by_frames(points: DataFrame, events: DataFrame, key: str, at: str, event_ts: str,
                      windows: dict[str, tuple[int, int]], micros: int) -> DataFrame:
    """The counts where a key's rows are in one task: a point stands once in
    its key's sequence, at its own time, and the total before an end is the sum
    over the frame from the first row up to a microsecond before that end.
    Such a frame only grows along the sequence, so each row is added to it once.
    No event has a null key or time, so the totals of such points are equal.
    """
    ends = sorted({e for w in windows.values() for e in w})
    both = points.select(F.col(key).alias("__k"), F.col(at).alias("__t"), F.struct(*points.columns).alias("__of")).unionByName(
        events.where(F.col(key).isNotNull() & F.col(event_ts).isNotNull()).select(
            F.col(key).alias("__k"), F.col(event_ts).cast("timestamp_ntz").alias("__t")), allowMissingColumns=True)

    def total_before(end: int) -> Column:
        last = end * micros - 1
        seconds, rest = divmod(abs(last), 1_000_000)
        bound = f"INTERVAL '{seconds}.{rest:06d}' SECOND {'FOLLOWING' if last >= 0 else 'PRECEDING'}"
        return F.expr("count_if(__of IS NULL) OVER (PARTITION BY __k ORDER BY __t "
                      f"RANGE BETWEEN UNBOUNDED PRECEDING AND {bound})").alias(f"__before_{ends.index(end)}")

    totals = both.select("__of", *[total_before(e) for e in ends]).where(F.col("__of").isNotNull())
    before = {e: F.col(f"__before_{i}") for i, e in enumerate(ends)}
    return totals.select("__of.*", *[(before[b] - before[a]).alias(name) for name, (a, b) in windows.items()])


def orders_around_price_change(versions: DataFrame, orders: DataFrame, days: int = 30, skew_safe: bool = False) -> DataFrame:
    """Orders of a product in the ``days`` before and after each change of its
    price, and their daily rates.

    ``versions``: (product_id, price, valid_from) as of ``scd2_history``, one
    row per product and time; a product's first price is no change.
    ``orders``: (product_id, created_at).  Result: product_id, changed_at,
    old_price, new_price, orders_before, orders_after, rate_before, rate_after.
    """
    from .sequence import with_neighbours

    steps = with_neighbours(versions.select("product_id", "price", "valid_from"), ["product_id"], ["valid_from"], ["price"],
                            skew_safe=skew_safe)
    changes = steps.where(F.col("prev_price").isNotNull()).select(
        "product_id", F.col("valid_from").alias("changed_at"), F.col("prev_price").alias("old_price"), F.col("price").alias("new_price"))
    counted = counts_around(changes, orders, "product_id", "changed_at", "created_at",
                            {"orders_before": (-days, 0), "orders_after": (0, days)}, skew_safe=skew_safe)
    return counted.select("*", (F.col("orders_before") / F.lit(float(days))).alias("rate_before"),
                          (F.col("orders_after") / F.lit(float(days))).alias("rate_after"))
