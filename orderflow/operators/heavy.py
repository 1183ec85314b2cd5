"""Keys with more rows than one task should hold, and plans that cut only those.

A plan that cuts every key into range slices samples, shuffles and checkpoints
all rows; one window on the key needs one shuffle, but takes a key in one task.
Most keys are small.  So the heavy ones are found by a count, and only their
rows go through the sliced plan.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HEAVY_ROWS = 200_000


def heavy_keys(df: DataFrame, key: str, rows: int | None = None) -> list:
    """The keys of ``df`` (NULL is one) with more than ``rows`` rows (``HEAVY_ROWS`` if not given).

    At most one a shuffle partition, the heaviest first: a key behind those
    has less than a partition's share of the rows.  One scan of the column and
    a partial aggregate.
    """
    most = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = HEAVY_ROWS if rows is None else rows
    counts = df.groupBy(F.col(key).alias("key")).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > rows)
    return [r.key for r in counts.orderBy(F.col("n").desc(), "key").limit(most).collect()]


def key_in(key: str, keys: list) -> Column:
    """Whether the key is one of ``keys``, never NULL: NULL is a key like others."""
    found = F.coalesce(F.col(key).isin([k for k in keys if k is not None]), F.lit(False))
    return found | F.col(key).isNull() if None in keys else found


def cut_heavy(plan: Callable[..., DataFrame], heavy: list, *inputs: tuple[DataFrame, str]) -> DataFrame:
    """``plan(*frames, skew_safe)`` over rows of ordinary keys in the plain form and
    over rows of ``heavy`` keys in the skew-safe form, put together.

    ``inputs``: (frame, key); ``plan`` must treat each key on its own, so that
    the two results together are that of all rows.
    """
    if not heavy:
        return plan(*[df for df, _ in inputs], False)
    rest = plan(*[df.where(~key_in(key, heavy)) for df, key in inputs], False)
    return rest.unionByName(plan(*[df.where(key_in(key, heavy)) for df, key in inputs], True))
