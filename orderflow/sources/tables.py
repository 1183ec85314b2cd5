"""Tables on plain files, built and tested before they are published.

A build writes a table as a version of its own, tests what was written, and
only then puts it in the place that readers read, ``<root>/<name>``.
Moving a folder is one call of the file system; the version before it is
gone afterwards.  A build that fails its tests leaves the published tables as
they were.
"""

from __future__ import annotations

import time
import uuid
from typing import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.checks import failed_checks
from ..schemas import FCT_ORDER_METRICS, FCT_ORDER_METRICS_REQUIRED, FCT_ORDERS, FCT_ORDERS_REQUIRED


def _fs(spark: SparkSession, path: str):
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def count_files(spark: SparkSession, pattern: str) -> int:
    """How many files match a glob pattern."""
    fs, p = _fs(spark, pattern)
    return len(fs.globStatus(p) or ())


def new_version_id() -> str:
    return f"{int(time.time() * 1000):013d}-{uuid.uuid4().hex[:8]}"


def write_version(df: DataFrame, root: str, name: str, partition_by: list[str] | None = None,
                  version: str | None = None) -> str:
    """Write ``df`` as a new immutable version; returns its path."""
    version = version or new_version_id()
    path = f"{root.rstrip('/')}/_versions/{name}/v={version}"
    w = df.write.mode("errorifexists").format("parquet")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)
    return path


def publish(spark: SparkSession, path: str, root: str, name: str) -> str:
    """Move the version at ``path`` to ``<root>/<name>``; returns that."""
    target = f"{root.rstrip('/')}/{name}"
    fs, new = _fs(spark, path)
    _, current = _fs(spark, target)
    if fs.exists(current):
        fs.delete(current, True)
    fs.mkdirs(current.getParent())
    if not fs.rename(new, current):
        raise OSError(f"{path} could not be moved to {target}")
    return target


def read_current(spark: SparkSession, root: str, name: str) -> DataFrame:
    path = f"{root.rstrip('/')}/{name}"
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        raise FileNotFoundError(f"table {name!r} has no published version under {root}")
    return spark.read.parquet(path)


def check_schema(df: DataFrame, schema: T.StructType, required: list[str], model: str = "table") -> DataFrame:
    """Declared-schema check before publishing: raises on missing columns or
    wrong types; returns a one-pass summary of NULLs in REQUIRED columns
    ``(model, column_name, test, failures)``."""
    have = {f.name: f.dataType for f in df.schema.fields}
    for f in schema.fields:
        if f.name not in have:
            raise ValueError(f"column {f.name!r} missing")
        if have[f.name] != f.dataType:
            raise ValueError(f"column {f.name!r} is {have[f.name].simpleString()}, "
                             f"declared {f.dataType.simpleString()}")
    structs = [F.struct(F.lit(model).alias("model"), F.lit(c).alias("column_name"),
                        F.lit("required").alias("test"),
                        F.count_if(F.col(c).isNull()).cast("bigint").alias("failures")) for c in required]
    return df.agg(F.array(*structs).alias("r")).select(F.inline("r"))


def write_ordered(df: DataFrame, path: str, *order: Column, files: int | None = None) -> str:
    """Write ``df`` in order: each file holds a range of ``order`` and is
    sorted, so the files' statistics let a reader of a range skip the others.
    The number of files is explicit, like the writers of the day partitions."""
    n = files or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    df.repartitionByRange(n, *order).sortWithinPartitions(*order).write.parquet(path)
    return path


def write_ordered_metrics(metrics: DataFrame, path: str, files: int | None = None) -> str:
    """The hourly KPIs, newest hour first, the NULL hour last.  The day stands
    beside the hour: Parquet's reader compares dates with the statistics, but
    not zoneless timestamps."""
    return write_ordered(metrics.withColumn("metric_date", F.to_date("metric_hour")), path, F.col("metric_hour").desc_nulls_last(), files=files)


def read_ordered_metrics(spark: SparkSession, path: str, start=None, end=None) -> DataFrame:
    """The KPIs of ``start <= metric_hour < end``; files of other days are
    skipped by their statistics."""
    df, hour, day = spark.read.parquet(path), F.col("metric_hour"), F.col("metric_date")
    if start is not None:
        s = F.lit(start).cast(T.TimestampNTZType())
        df = df.where((day >= F.to_date(s)) & (hour >= s))
    if end is not None:
        e = F.lit(end).cast(T.TimestampNTZType())
        df = df.where((day <= F.to_date(e)) & (hour < e))
    return df.drop("metric_date")


def compact(spark: SparkSession, source: str, target: str, file_bytes: int = 256 << 20) -> str:
    """Write the rows of the Parquet folder ``source`` to ``target`` in files
    of about ``file_bytes``; larger files are cut at their row groups.

    Spark's own scan packs files into partitions by size, largest first, so
    the small files of a rolling sink come together without a shuffle: a
    partition is read and written by one task.  A streaming sink's folder is
    read through its log, so only committed files are taken.
    """
    held = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes",
                                           "spark.sql.files.minPartitionNum") if spark.conf.get(k, None)}
    wanted = {"spark.sql.files.maxPartitionBytes": str(file_bytes), "spark.sql.files.openCostInBytes": "0",
              "spark.sql.files.minPartitionNum": "1"}
    try:
        for k, v in wanted.items():
            spark.conf.set(k, v)
        spark.read.parquet(source).write.parquet(target)
    finally:
        for k in wanted:
            spark.conf.set(k, held[k]) if k in held else spark.conf.unset(k)
    return target


def with_day_partition(fct: DataFrame, ts_col: str = "created_day", part_col: str = "created_date") -> DataFrame:
    """Add the DATE partition column of a day-partitioned table."""
    return fct.withColumn(part_col, F.to_date(F.col(ts_col)))


def write_fct_orders(fct: DataFrame, root: str, name: str = "fct_orders",
                     partitions: int | None = None) -> str:
    """Day-partitioned write of the fact.  Rows are range-partitioned on
    (day, order id): each task writes few day folders, and a hot day is cut
    across several tasks instead of landing in one.  The writer count is
    explicit (default ``spark.sql.shuffle.partitions``) so that adaptive
    coalescing cannot fold a small-but-wide write into one task."""
    n = partitions or int(fct.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    df = with_day_partition(fct)
    df = df.repartitionByRange(n, "created_date", "order_id").sortWithinPartitions("created_date", "order_id")
    return write_version(df, root, name, partition_by=["created_date"])


def read_fct_orders(spark: SparkSession, path: str, start=None, end=None) -> DataFrame:
    """Read the fact for ``start <= created_at < end``.  The bounds are put
    on the partition column too, so only the matching day folders are read
    (a filter on created_at alone does not imply one on the partition)."""
    df = spark.read.parquet(path)
    if start is not None:
        s = F.lit(start).cast(T.TimestampNTZType())
        df = df.where((F.col("created_date") >= F.to_date(s)) & (F.col("created_at") >= s))
    if end is not None:
        e = F.lit(end).cast(T.TimestampNTZType())
        df = df.where((F.col("created_date") <= F.to_date(e)) & (F.col("created_at") < e))
    return df


def publish_if_valid(spark: SparkSession, df: DataFrame, root: str, name: str,
                     checks: Callable[[DataFrame], DataFrame], partition_by: list[str] | None = None,
                     allow: Callable[[tuple], bool] = lambda row: False) -> tuple[bool, list[tuple], str]:
    """Build, test, then publish.

    The staged version is written first and the checks run on the written
    files (not on a re-computation).  Failing summary rows not accepted by
    ``allow`` block the publication; the version stays where it was written.
    Returns ``(published, failures, path)``.
    """
    path = write_version(df, root, name, partition_by)
    written = spark.read.parquet(path)
    failures = [r for r in failed_checks(checks(written)) if not allow(r)]
    if failures:
        return False, failures, path
    return True, [], publish(spark, path, root, name)


def fct_required_check(fct: DataFrame) -> DataFrame:
    """The fact against its declared columns, types and REQUIRED list."""
    return check_schema(fct, FCT_ORDERS, FCT_ORDERS_REQUIRED, "fct_orders")


def metrics_required_check(metrics: DataFrame) -> DataFrame:
    """The hourly metrics against their declared columns, types and REQUIRED list."""
    return check_schema(metrics, FCT_ORDER_METRICS, FCT_ORDER_METRICS_REQUIRED, "fct_order_metrics")
