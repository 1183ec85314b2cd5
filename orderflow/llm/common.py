"""Helpers shared by the corpus operators: stored intermediate tables, row
numbers, and streaming complete groups out of sorted Arrow batches."""

from __future__ import annotations

import os
import struct
import uuid
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orderflow.session import shared_dir


def scratch(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder of ``spark.checkpoint.dir``."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back: cuts the
    lineage, survives lost executors, and fixes values such as row numbers."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def keyed(df: DataFrame, **columns: str) -> DataFrame:
    """Only the named columns, under internal names, so that extra columns of
    the input and clashing names never reach an operator's plan."""
    return df.select(*[F.col(f"`{c}`").alias(name) for name, c in columns.items()])


def numbered(df: DataFrame, *columns: str) -> tuple[DataFrame, list[str]]:
    """``df`` with its columns named by number, and the new names of
    ``columns``: whatever the caller's names are, an operator's own columns
    do not clash with them.  ``toDF(*df.columns)`` names them back."""
    return df.toDF(*[f"c{i}" for i in range(len(df.columns))]), [f"c{df.columns.index(c)}" for c in columns]


def batches_of(columns: dict[str, object], schema: pa.Schema, rows: int = 65536) -> Iterator[pa.RecordBatch]:
    """Arrow batches of at most ``rows`` rows from equally long columns."""
    n = len(next(iter(columns.values())))
    table = pa.table({f.name: pa.array(columns[f.name], type=f.type) for f in schema}, schema=schema)
    if n:
        yield from table.to_batches(max_chunksize=rows)


def strings(values: pa.Array, absent: str) -> list[str]:
    """The strings of an array without nulls, none of which holds the
    character ``absent``: one string cut up, not an Arrow scalar for each."""
    if not len(values):
        return []
    whole = pa.LargeListArray.from_arrays(pa.array([0, len(values)], pa.int64()), values)
    return pc.binary_join(whole, absent)[0].as_py().split(absent)


def one_thread() -> None:
    """The tokenizers library in this worker runs on its task's own thread:
    the machine's cores are shared out by Spark, and each thread of the
    library would keep memory of its own."""
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")


#: How to forget what the operator named remembers in this worker.
_REMEMBERS: dict[str, Callable[[], None]] = {}


def only_memory(operator: str, forget: Callable[[], None] | None = None) -> None:
    """A Python worker runs the tasks of one operator after those of another.
    Called as a task of ``operator`` begins: what others remember here goes,
    with the memory that Arrow keeps of earlier batches; ``forget`` drops what
    this one is about to remember between its tasks."""
    for other in _REMEMBERS.keys() - {operator}:
        _REMEMBERS.pop(other)()
    pa.default_memory_pool().release_unused()
    if forget:
        _REMEMBERS[operator] = forget


def packed(ids: list[int]) -> bytes:
    """Ids as little-endian 32-bit integers."""
    return struct.pack(f"<{len(ids)}I", *ids)


def few_bytes(sizes: np.ndarray, most: int) -> Iterator[slice]:
    """Slices of neighbouring rows of at most ``most`` bytes together, or of
    one larger row."""
    first, total = 0, 0
    for i, n in enumerate(sizes.tolist()):
        if i > first and total + n > most:
            yield slice(first, i)
            first, total = i, 0
        total += n
    if first < len(sizes):
        yield slice(first, len(sizes))


def complete_groups(batches: Iterable[pa.RecordBatch], keys: list[str],
                    rows: int = 200_000) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """From batches sorted by ``keys`` (bigint), yield tables of whole groups
    of about ``rows`` rows, with the first row of each group and the end."""
    kept: list[pa.RecordBatch] = []
    size = 0

    def starts(table: pa.Table) -> np.ndarray:
        new = np.zeros(table.num_rows, bool)
        new[0] = True
        for k in keys:
            col = table.column(k).to_numpy()
            new[1:] |= col[1:] != col[:-1]
        return np.flatnonzero(new)

    for batch in batches:
        if not batch.num_rows:
            continue
        kept.append(batch)
        size += batch.num_rows
        if size < rows:
            continue
        table = pa.Table.from_batches(kept).combine_chunks()
        first = starts(table)
        if len(first) > 1:
            cut = int(first[-1])
            yield table.slice(0, cut), np.append(first[:-1], cut)
            kept, size = table.slice(cut).to_batches(), table.num_rows - cut
            rows = max(200_000, 2 * size)
        else:
            rows = 2 * size  # one group so far: look again when it has doubled
    if size:
        table = pa.Table.from_batches(kept).combine_chunks()
        yield table, np.append(starts(table), table.num_rows)


#: The side of rows that meet all others of their group.
WITHIN = 2


def in_parts(buckets: DataFrame, most: int, salt: Column) -> DataFrame:
    """Buckets (rows with the same ``key``) of more than ``most`` rows, cut
    into parts by ``salt``, with ``block``: the group of two parts i <= j in
    which a row stands, and ``side``: the part that it comes from (0 or 1), or
    WITHIN where a part meets itself (and in buckets that are not cut).  Each
    two rows of a bucket meet in exactly one group."""
    large = buckets.groupBy("key").count().where(F.col("count") > most) \
        .select("key", F.ceil(F.col("count") / most).alias("parts"))
    met = buckets.drop("block", "side").join(large, "key", "left").withColumn("parts", F.coalesce("parts", F.lit(1).cast("bigint")))
    met = met.withColumn("own", F.pmod(salt, F.col("parts"))) \
        .withColumn("other", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("parts") - 1)))
    block = F.least("own", "other") * F.col("parts") + F.greatest("own", "other")
    side = F.when(F.col("own") == F.col("other"), WITHIN).otherwise((F.col("own") > F.col("other")).cast("int"))
    return met.withColumn("block", block).withColumn("side", side).drop("parts", "own", "other")


def pairs_in_groups(bounds: np.ndarray, at_once: int = 2_000_000, side: np.ndarray | None = None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row pairs i < j of the same group, ``at_once`` at a time.  ``bounds``
    are the groups' first rows and the end; rows of the same ``side`` that is
    not WITHIN do not meet.

    Small groups go together, by distance between the rows; a large group is
    walked row block against row block, so memory does not follow its square.
    """
    for i, j in _all_pairs(bounds, at_once):
        if side is not None:
            met = (side[i] == WITHIN) | (side[i] != side[j])
            i, j = i[met], j[met]
        yield i, j


def _all_pairs(bounds: np.ndarray, at_once: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    first, last = bounds[:-1], bounds[1:]
    size = last - first
    small = size <= 512
    rows = np.concatenate([np.arange(a, b) for a, b in zip(first[small], last[small])] or [np.zeros(0, int)])
    end = np.repeat(last[small], size[small])
    step = 1
    while len(rows):
        near = rows + step < end
        rows, end = rows[near], end[near]
        for at in range(0, len(rows), at_once):
            yield rows[at:at + at_once], rows[at:at + at_once] + step
        step += 1
    for a, b in zip(first[~small], last[~small]):
        height = max(1, at_once // (b - a))
        for top in range(a, b, height):
            i = np.arange(top, min(top + height, b))
            i, j = np.repeat(i, b - i - 1), np.concatenate([np.arange(x + 1, b) for x in i])
            yield i, j


class LocalComponents:
    """Components of the links seen in one task, as smallest row numbers."""

    def __init__(self, n: int):
        self.label = np.arange(n)

    def link(self, a: np.ndarray, b: np.ndarray) -> None:
        while len(a):
            x, y = self.label[a], self.label[b]
            open_ = x != y
            a, b, x, y = a[open_], b[open_], x[open_], y[open_]
            if not len(a):
                break
            low = np.minimum(x, y)
            np.minimum.at(self.label, x, low)
            np.minimum.at(self.label, y, low)
            while True:
                up = self.label[self.label]
                if np.array_equal(up, self.label):
                    break
                self.label = up
