"""Embedding near-duplicates by iterative quantisation.

A rotation of the centred principal axes is learnt so that the signs of the
rotated vector lose least (balanced binary codes).  Codes are cut into
substrings; each substring is a hash table that is probed with the vector's
own value and all values one bit away (multi-index Hamming search).  Pairs
that meet and whose whole codes are near are reranked with the original
vectors in double precision.

Exact copies are one vector with a weight.  A pair that meets in several
tables counts in the first one only, so links are counted where they are
found: a task returns one number per vector and bucket and a spanning forest
of its links, never the pairs.  Buckets with many rows are cut into parts, and each
two parts meet as a group of their own.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderflow.llm.common import WITHIN, LocalComponents, batches_of, complete_groups, in_parts, keyed, pairs_in_groups, stored
from orderflow.llm.components import connected_components

LEAST_COSINE = 0.93
#: The bound of the sample that the rotations are learnt from.
FIT_ROWS = 4096
ROUNDS = 30
#: Expected share of links that no table finds, under the threshold's bit error rate.
MOST_MISSED = 0.005
#: Bits of the longest and shortest substring.
SUBSTRING = (12, 24)
#: Tables up to which the mean is taken off.
MOST_TABLES = 64
#: Lengths of vectors that may occur twice or more: each is searched by itself.
MOST_LENGTHS = 256
#: Rows of a bucket, and of each of two parts of a larger one, that meet at once.
BLOCK = 8192


@dataclass
class Codes:
    """Rotations (one for every 64 bits or less) and the cut into substrings."""

    mean: np.ndarray
    rotations: list[np.ndarray]
    cuts: list[tuple[int, int]]  # first and last + 1 bit of each table's substring
    far: int  # codes that differ in more bits are not reranked

    @property
    def bits(self) -> int:
        return sum(r.shape[1] for r in self.rotations)

    def encode(self, x: np.ndarray) -> np.ndarray:
        """Unit vectors to bits (rows x bits, 0 or 1)."""
        return np.hstack([(x - self.mean) @ r > 0 for r in self.rotations]).astype(np.uint8)

    def words(self, bits: np.ndarray) -> np.ndarray:
        """The bits in 64-bit words (rows x words), bit i in word i // 64."""
        n = -(-self.bits // 64)
        padded = np.zeros((len(bits), 64 * n), np.uint8)
        padded[:, :bits.shape[1]] = bits
        return np.packbits(padded, axis=1, bitorder="little").view(np.uint64).reshape(len(bits), n)

    def values(self, bits: np.ndarray, table: int) -> np.ndarray:
        a, b = self.cuts[table]
        return bits[:, a:b].astype(np.int64) @ (1 << np.arange(b - a, dtype=np.int64))

    def masks(self) -> np.ndarray:
        """Words (tables x words) with the bits of each table's substring."""
        rows = np.zeros((len(self.cuts), self.bits), np.uint8)
        for t, (a, b) in enumerate(self.cuts):
            rows[t, a:b] = 1
        return self.words(rows)


def learn_rotation(x: np.ndarray, bits: int, seed: int) -> np.ndarray:
    """Axes of largest variance, rotated: alternately the nearest signs and
    the best rotation towards them."""
    _, _, vt = np.linalg.svd(x, full_matrices=False)
    axes = vt[:bits].T
    v = x @ axes
    r, _ = np.linalg.qr(np.random.default_rng(seed).normal(size=(axes.shape[1], axes.shape[1])))
    for _ in range(ROUNDS):
        signs = np.where(v @ r >= 0, 1.0, -1.0)
        a, _, b = np.linalg.svd(signs.T @ v)
        r = (a @ b).T
    return axes @ r


def plan_codes(sample: np.ndarray, n: int, least_cosine: float) -> Codes:
    """Substrings about as long as log2 of the number of vectors, and as many
    tables as it takes for a pair at the threshold to be missed with
    probability ``MOST_MISSED`` at most, when bits differ independently at the
    rate of its angle: the largest that it can have around the mean between
    vectors as far from it as the sample's nearest one.  Where that would take
    more than ``MOST_TABLES`` tables, the mean stays in: codes then differ by
    the angle itself, in fewer and fuller buckets."""
    apart = math.sqrt(max(2 - 2 * min(max(least_cosine, -1.0), 1.0), 0.0))  # of unit vectors at the threshold
    size = min(max(math.ceil(math.log2(max(n, 2))), SUBSTRING[0]), SUBSTRING[1])

    def plan(nearest: float) -> tuple[float, float]:
        error = 2 * math.asin(min(apart / (2 * nearest), 1.0)) / math.pi if nearest > 0 else 1.0
        found = (1 - error) ** size + size * error * (1 - error) ** (size - 1)
        return error, max(1.0, math.ceil(math.log(MOST_MISSED) / math.log(1 - min(max(found, 1e-12), 1 - 1e-12))))

    mean = sample.mean(0)
    error, tables = plan(float(np.linalg.norm(sample - mean, axis=1).min()))
    if tables > MOST_TABLES:
        mean, (error, tables) = np.zeros_like(mean), plan(1.0)
    x, tables = sample - mean, int(tables)
    rank = max(1, int(np.linalg.matrix_rank(x)))
    rotations, bits, seed = [], 0, 0
    while bits < tables * size:
        r = learn_rotation(x, min(64, rank), seed)
        rotations.append(r)
        bits, seed = bits + r.shape[1], seed + 1
    cuts = [(t * size, (t + 1) * size) for t in range(tables)]
    far = math.ceil(bits * error + 5 * math.sqrt(bits * error * (1 - error)))
    return Codes(mean, rotations, cuts, far)


def _unit(column) -> np.ndarray:
    x = np.array(column.to_pylist(), np.float64)
    x /= np.abs(x).max(axis=1, keepdims=True)  # squares of very large or small components leave the doubles
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _mixed(*parts) -> np.ndarray:
    """One 64-bit key of several whole numbers."""
    h = np.uint64(0x9E3779B97F4A7C15)
    out = None
    with np.errstate(over="ignore"):
        for p in parts:
            p = np.asarray(p).astype(np.int64).view(np.uint64)
            out = p * h if out is None else (out ^ p) * h
            out = out ^ (out >> np.uint64(31))
    return out.view(np.int64)


def _pairs(table: pa.Table, bounds: np.ndarray, far: int, masks: np.ndarray):
    """(i, j) row pairs of the same bucket with near codes that did not meet
    in an earlier table, both ways round, i being a row to be counted here."""
    code = table.column("code").to_pylist()
    words = np.array(code, np.int64).view(np.uint64).reshape(len(code), -1)
    node, counted, here = table.column("node").to_numpy(), table.column("counted").to_numpy(), table.column("table").to_numpy()
    for i, j in pairs_in_groups(bounds, side=table.column("side").to_numpy()):
        near = np.zeros(len(i), np.int64)
        for w in range(words.shape[1]):
            near += np.bitwise_count(words[i, w] ^ words[j, w])
        keep = (near <= far) & (node[i] != node[j])
        i, j = i[keep], j[keep]
        first = np.ones(len(i), bool)
        for t in range(int(here.max(initial=0))):
            later = first & (here[i] > t)
            if not later.any():
                break
            differ = np.zeros(len(i), np.int64)
            for w in range(words.shape[1]):
                if masks[t, w]:
                    differ += np.bitwise_count((words[i, w] ^ words[j, w]) & masks[t, w])
            first &= ~(later & (differ <= 1))
        i, j = i[first], j[first]
        # a row counts where it stands at its own value
        a, b = np.concatenate([i, j]), np.concatenate([j, i])
        own = counted[a] > 0
        yield a[own], b[own]


_BUCKET = pa.schema([("key", pa.int64()), ("block", pa.int64()), ("side", pa.int32()), ("table", pa.int32()), ("node", pa.int64()), ("counted", pa.int32()),
                     ("code", pa.list_(pa.int64()))])
_BUCKET_DDL = "key bigint, block bigint, side int, `table` int, node bigint, counted int, code array<bigint>"


def _buckets(vectors: DataFrame, codes: Codes) -> DataFrame:
    """A row for each vector and table at its own value (``counted``), and one
    at each value a bit away."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 2048):
                some = b.slice(at, 2048)
                label, size = some.column("label").to_numpy(), some.column("size").to_numpy()
                bits = codes.encode(_unit(some.column("embedding")))
                words = codes.words(bits)
                code = pa.FixedSizeListArray.from_arrays(pa.array(words.view(np.int64).ravel()), words.shape[1]).cast(pa.list_(pa.int64()))
                node, n = some.column("node"), some.num_rows
                for t in range(len(codes.cuts)):
                    value = codes.values(bits, t)
                    for flip in [0, *(1 << k for k in range(codes.cuts[t][1] - codes.cuts[t][0]))]:
                        key = _mixed(label, size, np.full(n, t), value ^ flip)
                        yield pa.record_batch([pa.array(key), pa.array(np.zeros(n, np.int64)), pa.array(np.full(n, WITHIN, np.int32)),
                                               pa.array(np.full(n, t, np.int32)), node,
                                               pa.array(np.full(n, int(not flip), np.int32)), code], schema=_BUCKET)

    return vectors.mapInArrow(run, _BUCKET_DDL)


def _in_blocks(buckets: DataFrame, block: int) -> DataFrame:
    return in_parts(buckets, block, F.xxhash64("node")).select(*_BUCKET.names)


def _by_bucket(rows: DataFrame) -> DataFrame:
    return rows.repartition("key", "block").sortWithinPartitions("key", "block", "node")


def links(vectors: DataFrame, codes: Codes, least_cosine: float, block: int = BLOCK) -> DataFrame:
    """From distinct vectors of one length (node, label, size, embedding, weight): rows
    (node, other, n): ``n`` more weighted links of ``node`` (other null), or
    an edge of the forest (n = 0)."""
    masks, far = codes.masks(), codes.far

    def candidates(batches):
        for table, bounds in complete_groups(batches, ["key", "block"]):
            part = np.zeros(table.num_rows, bool)
            for i, j in _pairs(table, bounds, far, masks):
                part[i] = part[j] = True
            yield from table.filter(pa.array(part)).to_batches()

    met = _by_bucket(_in_blocks(_buckets(vectors, codes), block)).mapInArrow(candidates, _BUCKET_DDL)
    met = stored(met, "candidates").join(vectors.select("node", "embedding", "label", "size", "weight"), "node")
    out = pa.schema([("node", pa.int64()), ("other", pa.int64()), ("n", pa.int64())])

    def rerank(batches):
        for table, bounds in complete_groups(batches, ["key", "block"], rows=50_000):
            node, weight = table.column("node").to_numpy(), table.column("weight").to_numpy()
            label, size = table.column("label").to_numpy(), table.column("size").to_numpy()
            flat = table.column("embedding").combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.float64)
            begin = np.append(0, np.cumsum(size))
            flat /= np.repeat(np.maximum.reduceat(np.abs(flat), begin[:-1]), size)
            distinct, back = np.unique(node, return_inverse=True)
            local, total = LocalComponents(len(distinct)), np.zeros(len(distinct), np.int64)
            for i, j in _pairs(table, bounds, far, masks):
                same = (label[i] == label[j]) & (size[i] == size[j])
                i, j = i[same], j[same]
                cosine = np.zeros(len(i))
                for at in range(0, len(i), 100_000):
                    a, b = i[at:at + 100_000], j[at:at + 100_000]
                    for n in np.unique(size[a]):
                        of = np.flatnonzero(size[a] == n)
                        x = flat[begin[a[of]][:, None] + np.arange(n)]
                        y = flat[begin[b[of]][:, None] + np.arange(n)]
                        norms = np.sqrt(np.einsum("ij,ij->i", x, x) * np.einsum("ij,ij->i", y, y))
                        cosine[at + of] = np.einsum("ij,ij->i", x, y) / norms
                linked = cosine >= least_cosine
                i, j = back[i[linked]], j[linked]
                np.add.at(total, i, weight[j])
                local.link(i, back[j])
            some, moved = np.flatnonzero(total), np.flatnonzero(local.label != np.arange(len(distinct)))
            yield from batches_of({"node": np.concatenate([distinct[some], distinct[moved]]),
                                   "other": pa.concat_arrays([pa.nulls(len(some), pa.int64()), pa.array(distinct[local.label[moved]])]),
                                   "n": np.concatenate([total[some], np.zeros(len(moved), np.int64)])}, out)

    return _by_bucket(met).mapInArrow(rerank, "node bigint, other bigint, n bigint")


def near_duplicates(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
                    least_cosine: float = LEAST_COSINE, block: int = BLOCK) -> DataFrame:
    """(id, n_links, component, kept) for every row.

    Rows link when their labels are equal and not null and the cosine of
    their vectors is ``least_cosine`` or more.  Null, empty or zero vectors,
    vectors with a null or non-finite component and unlabelled rows have no
    links and are their own component; vectors of different lengths never
    link.  Repeated vectors link with each other and count each.  component
    is the smallest id reachable, null ids left out; kept: the id is the
    component's (null for null).  An empty table gives no rows; extra columns
    are not read.
    """
    rows = keyed(df, id=id_col, embedding=vector_col, label=label_col)
    x = F.transform("embedding", lambda v: v.cast("double"))
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    some = F.exists(x, lambda v: v != 0)
    fine = F.col("label").isNotNull() & F.col("embedding").isNotNull() & F.coalesce(finite, F.lit(False))
    rows = rows.withColumn("fine", F.when(fine, some).otherwise(False))
    vectors = rows.where("fine").groupBy("label", "embedding").agg(F.min("id").alias("id"), F.count("*").alias("weight"))
    vectors = stored(vectors.select(F.monotonically_increasing_id().alias("node"), F.col("label").cast("bigint").alias("number"), "label",
                                    F.size("embedding").cast("bigint").alias("size"), "embedding", "id", "weight"), "vectors")
    # vectors of different lengths never link: each length has rotations of its own
    sizes = [(r["size"], r["count"]) for r in vectors.groupBy("size").count().where("count > 1").orderBy("size").limit(MOST_LENGTHS + 1).collect()]
    if len(sizes) > MOST_LENGTHS:
        raise ValueError(f"vectors of more than {MOST_LENGTHS} lengths")
    if not sizes:
        found = vectors.select("node", F.lit(0).cast("bigint").alias("links"), F.col("node").alias("root"))
    else:
        numbered = vectors.select("node", F.xxhash64("label").alias("label"), "size", "embedding", "weight")
        parts = []
        for size, n in sizes:
            own = F.col("size") == size
            sample = vectors.where(own).orderBy(F.xxhash64("embedding"), "node").limit(FIT_ROWS).select("embedding").collect()
            codes = plan_codes(_unit(pa.array([r["embedding"] for r in sample])), n, least_cosine)
            parts.append(stored(links(numbered.where(own), codes, least_cosine, block), "links"))
        link_rows = reduce(DataFrame.unionByName, parts)
        member = connected_components(link_rows.where("other is not null").select(F.col("node").alias("a"), F.col("other").alias("b")))
        degree = link_rows.groupBy("node").agg(F.sum("n").alias("links"))
        found = vectors.select("node").join(degree, "node", "left").join(member.withColumnRenamed("vertex", "node"), "node", "left") \
            .select("node", F.coalesce("links", F.lit(0).cast("bigint")).alias("links"), F.coalesce("component", "node").alias("root"))
    found = stored(vectors.join(found, "node"), "found")
    least = found.groupBy("root").agg(F.min("id").alias("component"))
    whole = found.join(least, "root").select(F.col("label").alias("v_label"), F.col("embedding").alias("v_embedding"),
                                             (F.col("links") + F.col("weight") - 1).alias("n_links"), "component")
    same = F.col("fine") & (F.col("label") == F.col("v_label")) & (F.col("embedding") == F.col("v_embedding"))
    met = rows.join(whole, same, "left")
    component = F.when(F.col("n_links").isNull(), F.col("id")).otherwise(F.col("component"))
    return met.select("id", F.coalesce("n_links", F.lit(0).cast("bigint")).alias("n_links"), component.alias("component"),
                      F.col("id").eqNullSafe(component).alias("kept"))
