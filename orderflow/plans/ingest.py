"""Stream-job logic: change-type filter, operation decode, projection.

Stateless, so the same functions run on a batch DataFrame and inside a
Structured Streaming query.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schemas import OPERATION_NAMES, SNAPSHOT_OP


def filter_changes(df: DataFrame, include_snapshot: bool = False) -> DataFrame:
    """Keep real changes (``__op`` in c/u/d).  Snapshot reads (``r``) are
    dropped unless ``include_snapshot``; tombstones (NULL op) always drop."""
    ops = list(OPERATION_NAMES) + ([SNAPSHOT_OP] if include_snapshot else [])
    return df.where(F.col("__op").isin(*ops))


def operation_name(op_col: str = "__op", snapshot_as_insert: bool = False):
    """c/u/d -> INSERT/UPDATE/DELETE, anything else UNKNOWN.  A snapshot
    read counts as the INSERT of the row it reads when asked to."""
    e = None
    names = dict(OPERATION_NAMES)
    if snapshot_as_insert:
        names[SNAPSHOT_OP] = "INSERT"
    for code, name in names.items():
        cond = F.col(op_col) == F.lit(code)
        e = F.when(cond, F.lit(name)) if e is None else e.when(cond, F.lit(name))
    return e.otherwise(F.lit("UNKNOWN"))


def decode_operation(df: DataFrame, snapshot_as_insert: bool = False) -> DataFrame:
    """Project wire rows to the processed layout: decoded ``operation`` and
    ``__ts_ms`` renamed ``processed_at``; ``__table`` is dropped."""
    return df.select(
        "id", "customer_id", "product_id", "quantity", "unit_price", "total_amount", "status",
        operation_name(snapshot_as_insert=snapshot_as_insert).alias("operation"),
        "created_at", "updated_at",
        F.col("__ts_ms").alias("processed_at"),
    )


def processed(wire: DataFrame, include_snapshot: bool = False) -> DataFrame:
    """Wire rows -> ``ORDERS_PROCESSED`` rows (the stream job's SELECT)."""
    return decode_operation(filter_changes(wire, include_snapshot),
                            snapshot_as_insert=include_snapshot)
