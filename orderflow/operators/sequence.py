"""Per-key event sequences: previous/next row, transitions, history.

The neighbour of a row inside its key's sequence is a ``lag``/``lead``
window over ``partitionBy(keys).orderBy(order_cols)``.  ``order_cols`` must
be a total order inside a key (the source gives no order for changes of the
same millisecond, so callers pass an explicit tie-break).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..schemas import ALLOWED_TRANSITIONS
from ..session import shared_dir


def _window(keys: list[str], order_cols: list[str | Column]):
    return Window.partitionBy(*keys).orderBy(*[F.col(c).asc_nulls_last() if isinstance(c, str) else c
                                                for c in order_cols])


def _nulls_last_exprs(cols: list[str]) -> list[Column]:
    """(c IS NULL, c) per column: ascending order of these equals
    ``c ASC NULLS LAST``, also when compared as one struct."""
    out = []
    for c in cols:
        out += [F.col(c).isNull(), F.col(c)]
    return out


def _range_slices(df: DataFrame, keys: list[str], order_cols: list[str], n_parts: int):
    """Rows range-partitioned on (keys, order) with their partition id.

    Range bounds come from sampling, so two executions could cut
    differently: the partitioned rows are checkpointed once (shared folder,
    lineage cut) and every later reader sees the same cut.  Returns the
    checkpointed rows, the full order (with ``__seq`` separating exact
    duplicates), the null-safe ordering and the per-slice window.
    """
    shared_dir(df.sparkSession)
    order = list(order_cols) + ["__seq"]
    ordering = _nulls_last_exprs(keys + order)
    r = (df.withColumn("__seq", F.monotonically_increasing_id())
         .repartitionByRange(n_parts, *ordering)
         .withColumn("__pid", F.spark_partition_id())
         .checkpoint(eager=True))
    w = Window.partitionBy(*keys, "__pid").orderBy(*[e.asc() for e in _nulls_last_exprs(order)])
    return r, order, ordering, w


def _same_key(edge: str, keys: list[str]) -> Column:
    cond = F.col(edge).isNotNull()
    for k in keys:
        cond = cond & F.col(f"{edge}.{k}").eqNullSafe(F.col(k))
    return cond


def fill_forward(df: DataFrame, keys: list[str], order_cols: list[str], cols: list[str],
                 skew_safe: bool = False, partitions: int | None = None) -> DataFrame:
    """Replace each of ``cols`` by the last non-NULL value seen so far in
    its key's sequence (the row's own value included).

    Plain plan: a running ``last(ignorenulls)`` window on ``keys``.  Skew-safe
    plan (the caller's choice, as in :func:`with_neighbours`): the window runs per
    range slice; a slice starting without a value takes the last non-NULL
    value of the same key from earlier slices, found in an edge table of at
    most one row per partition (broadcast, bounded by construction).
    """
    spark = df.sparkSession
    n_parts = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    if not skew_safe:
        w = _window(keys, order_cols).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        return df.select(*[F.last(c, ignorenulls=True).over(w).alias(c) if c in cols else F.col(c)
                           for c in df.columns])

    r, order, ordering, w = _range_slices(df, keys, order_cols, n_parts)
    w_run = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    filled = r.select("*", *[F.last(c, ignorenulls=True).over(w_run).alias(f"__run_{c}") for c in cols])
    pos = F.struct(*ordering)
    key_row = F.struct(*[F.col(k) for k in keys])
    aggs = [F.min_by(key_row, pos).alias("__first"), F.max_by(key_row, pos).alias("__last")]
    for c in cols:  # last non-NULL value of the partition, with its key
        aggs.append(F.max_by(F.struct(*[F.col(k) for k in keys], F.col(c).alias("v")),
                             F.when(F.col(c).isNotNull(), pos)).alias(f"__lv_{c}"))
    edges = r.groupBy("__pid").agg(*aggs)
    lv = []
    for c in cols:  # keep the value only if it belongs to the partition's last key
        same = F.lit(True)
        for k in keys:
            same = same & F.col(f"__lv_{c}.{k}").eqNullSafe(F.col(f"__last.{k}"))
        lv.append(F.when(same, F.col(f"__lv_{c}.v")).alias(f"__lv_{c}"))
    edges = edges.select("__pid", "__first", "__last", *lv)
    # running last value per last-key over earlier partitions, then shift by one partition
    run_w = (Window.partitionBy(*[F.col(f"__last.{k}") for k in keys]).orderBy("__pid")
             .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    edges = edges.select("__pid", "__first", "__last",
                         *[F.last(f"__lv_{c}", ignorenulls=True).over(run_w).alias(f"__carry_{c}") for c in cols])
    ew = Window.orderBy("__pid")
    carry = edges.select("__pid", F.lag("__last").over(ew).alias("__prev_last"),
                         *[F.lag(f"__carry_{c}").over(ew).alias(f"__carry_{c}") for c in cols])
    j = filled.join(F.broadcast(carry), "__pid", "left")
    return j.select(*[F.coalesce(F.col(f"__run_{c}"),
                                 F.when(_same_key("__prev_last", keys), F.col(f"__carry_{c}"))).alias(c)
                      if c in cols else F.col(c) for c in df.columns])


def with_neighbours(df: DataFrame, keys: list[str], order_cols: list[str], cols: list[str],
                    prev_prefix: str | None = "prev_", next_prefix: str | None = None,
                    skew_safe: bool = False, partitions: int | None = None) -> DataFrame:
    """Add the previous (and/or next) value of ``cols`` within each key.

    ``skew_safe=False``: one window on ``keys`` – one shuffle, but every row
    of a key is processed by one task.

    The caller chooses, knowing its keys: nothing is measured and no plan
    depends on the size of the input.

    ``skew_safe=True``: for keys that may hold a large share of all rows.
    The rows are range-partitioned on (keys, order) – Spark samples the
    boundaries, so a hot key is cut into contiguous slices over many
    partitions – and the window runs per (key, slice).  Only the first and
    last row of a slice lack a neighbour; those come from a per-partition
    edge table with at most one row per range partition (a proven bound),
    which is broadcast and joined back.  The range-partitioned rows are
    checkpointed to ``spark.checkpoint.dir`` so both readers see the same
    cut.  Cost: a sampling pass, a checkpoint and two balanced shuffles
    instead of one unbalanced shuffle.
    """
    spark = df.sparkSession
    n_parts = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    if not skew_safe:
        w = _window(keys, order_cols)
        extra = []
        for c in cols:
            if prev_prefix:
                extra.append(F.lag(c).over(w).alias(prev_prefix + c))
            if next_prefix:
                extra.append(F.lead(c).over(w).alias(next_prefix + c))
        return df.select("*", *extra)        # one Window operator, one sort

    r, order, ordering, w = _range_slices(df, keys, order_cols, n_parts)
    win = []
    for c in cols:
        if prev_prefix:
            win.append(F.lag(c).over(w).alias(prev_prefix + c))
        if next_prefix:
            win.append(F.lead(c).over(w).alias(next_prefix + c))
    win.append(F.row_number().over(w).alias("__rn"))
    if next_prefix:  # last row of the slice: no following row inside it
        win.append(F.lead(F.lit(1)).over(w).isNull().alias("__is_last"))
    seq = r.select("*", *win)              # one Window operator, one sort

    pos = F.struct(*ordering)
    row = F.struct(*[F.col(k) for k in keys], *[F.col(c) for c in cols])
    edges = r.groupBy("__pid").agg(F.min_by(row, pos).alias("__first"), F.max_by(row, pos).alias("__last"))
    ew = Window.orderBy("__pid")
    carry = edges.select("__pid", F.lag("__last").over(ew).alias("__prev_last"),
                         F.lead("__first").over(ew).alias("__next_first"))
    j = seq.join(F.broadcast(carry), "__pid", "left")

    def same_key(edge: str) -> Column:
        return _same_key(edge, keys)

    fixed = []
    for c in cols:
        if prev_prefix:
            fixed.append(F.when((F.col("__rn") == 1) & same_key("__prev_last"), F.col(f"__prev_last.{c}"))
                         .otherwise(F.col(prev_prefix + c)).alias(prev_prefix + c))
        if next_prefix:
            fixed.append(F.when(F.col("__is_last") & same_key("__next_first"), F.col(f"__next_first.{c}"))
                         .otherwise(F.col(next_prefix + c)).alias(next_prefix + c))
    new_names = {prev_prefix + c for c in cols if prev_prefix} | {next_prefix + c for c in cols if next_prefix}
    return j.select(*[F.col(c) for c in df.columns if c not in new_names], *fixed)


# Tie-break of changes with the same processed_at: every other column, so
# the order is total (exact duplicates are interchangeable).
STG_TIEBREAK = ["product_id", "quantity", "unit_price", "status", "operation_type",
                "customer_id", "created_at", "updated_at"]


def status_transitions(stg: DataFrame, key: str = "order_id", order_col: str = "processed_at",
                       tiebreak: list[str] = STG_TIEBREAK, skew_safe: bool = False) -> DataFrame:
    """Every status change of an order: ``(order_id, from_status, to_status,
    changed_at)``.  An event repeating the status is not a change; the first
    event of an order has no predecessor."""
    seq = with_neighbours(stg.where(F.col(order_col).isNotNull()), [key], [order_col] + tiebreak,
                          ["status"], skew_safe=skew_safe)
    return (seq.where(F.col("prev_status").isNotNull() & F.col("status").isNotNull()
                      & (F.col("prev_status") != F.col("status")))
            .select(key, F.col("prev_status").alias("from_status"),
                    F.col("status").alias("to_status"), F.col(order_col).alias("changed_at")))


def illegal_transitions(stg: DataFrame, skew_safe: bool = False) -> DataFrame:
    """Kinds of status change that the life cycle forbids, with counts.

    The allowed table is a fixed five-row literal, so broadcasting it is
    bounded by construction; the count is a partial+final aggregate.
    """
    spark = stg.sparkSession
    allowed = F.broadcast(spark.createDataFrame(ALLOWED_TRANSITIONS, "from_status string, to_status string"))
    t = status_transitions(stg, skew_safe=skew_safe)
    bad = t.join(allowed, ["from_status", "to_status"], "left_anti")
    return bad.groupBy("from_status", "to_status").agg(F.count(F.lit(1)).alias("n"))
