"""Latest row per key.

The reference keeps, per order, every event whose ``processed_at`` equals
the order's maximum – ties included, NULL never.  That is ``rank() = 1``.

Plan: Catalyst turns ``rank() = 1`` into a ``WindowGroupLimit`` that runs
*before* the shuffle as well as after it, so each map task forwards only its
local maximal rows per key.  One scan, one exchange on the key, and a hot
key (one order with a third of all events) is cut down map-side to at most
the tied maxima of each input split before it is shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

RANK_COL = "__rank"


def _order_desc(order_col: str, tiebreak: list[str]) -> list[Column]:
    return [F.col(order_col).desc()] + [F.col(c).desc_nulls_last() for c in tiebreak]


def _reduce_hot_slices(base: DataFrame, keys: list[str], spec_order: list[Column], fn, n_parts: int,
                       salts: int) -> DataFrame:
    """First phase for hot keys: spread rows over (key, salt) with an
    explicit repartition (a plain window would reuse a key partitioning),
    keep each slice's top rows.  Any row that is top for its key is top in
    its slice, so the second phase over the survivors is exact."""
    salted = base.withColumn("__salt", F.pmod(F.monotonically_increasing_id(), F.lit(salts)))
    w = Window.partitionBy(*keys, "__salt").orderBy(*spec_order)
    return (salted.repartition(n_parts, *keys, "__salt")
            .withColumn(RANK_COL, fn.over(w)).where(F.col(RANK_COL) == 1).drop(RANK_COL, "__salt"))


def latest_rows(df: DataFrame, keys: list[str], order_col: str, on_tie: str = "keep_all",
                method: str = "rank", tiebreak: list[str] | None = None,
                skew_safe: bool = False, salts: int | None = None) -> DataFrame:
    """Rows of ``df`` holding the maximal ``order_col`` of their ``keys``.

    on_tie='keep_all' keeps every tied row (reference semantics); 'one' keeps a
    single row per key, chosen by ``tiebreak`` (default: all other columns,
    descending, so the choice is deterministic).  method='join' is the
    literal max-then-self-join form; it returns the same rows but scans the
    input twice.

    ``skew_safe=True`` is for inputs that are already partitioned on the
    keys (a join on them, say): there the group limit has no exchange to run
    in front of, and all rows of a hot key would meet in one task.  Rows are
    then spread over (key, salt) first and each slice keeps its top rows.
    Over files the plain plan does the same in front of its one exchange.
    """
    base = df.where(F.col(order_col).isNotNull())
    if method == "join":
        if on_tie != "keep_all":
            raise ValueError("method='join' keeps ties; use method='rank' for on_tie='one'")
        mx = base.groupBy(*keys).agg(F.max(order_col).alias("__latest")).alias("__l")
        s = base.alias("__s")
        cond = [F.col(f"__s.{k}") == F.col(f"__l.{k}") for k in keys] + \
               [F.col(f"__s.{order_col}") == F.col("__l.__latest")]
        return s.join(mx, cond, "inner").select(*[F.col(f"__s.{c}") for c in df.columns])
    if on_tie == "keep_all":
        order = [F.col(order_col).desc()]
        fn = F.rank()
    elif on_tie == "one":
        tb = tiebreak if tiebreak is not None else [c for c in df.columns if c not in keys + [order_col]]
        order = _order_desc(order_col, tb)
        fn = F.row_number()
    else:
        raise ValueError(f"on_tie must be 'keep_all' or 'one', not {on_tie!r}")
    n_parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    if skew_safe:
        base = _reduce_hot_slices(base, keys, order, fn, n_parts, salts or n_parts)
    w = Window.partitionBy(*keys).orderBy(*order)
    return base.withColumn(RANK_COL, fn.over(w)).where(F.col(RANK_COL) == 1).drop(RANK_COL)


def max_per_key(df: DataFrame, keys: list[str], order_col: str,
                alias: str = "latest_processed_at") -> DataFrame:
    """``MAX(order_col) GROUP BY keys`` (partial + final hash aggregate)."""
    return df.groupBy(*keys).agg(F.max(order_col).alias(alias))
