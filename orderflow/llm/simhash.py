"""SimHash near-duplicates through the generalised pigeonhole principle.

A document's fingerprint has a bit set where more than half of its shingle
hashes have it.  Two fingerprints link at ``max_bits`` or fewer differing
bits.  The 64 bits are grouped so that correlated bits share a partition;
each partition ``p`` gets a threshold t_p (-1: not probed) such that the sum
of (t_p + 1) is ``max_bits + 1``.  If two fingerprints differed by more than
t_p in every partition they would differ in ``max_bits + 1`` bits at least,
so probing every partition within its threshold finds every link.  Number of
partitions and thresholds come from dynamic programming over estimated
candidate counts; any choice gives the same links, at another cost.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderflow.llm.common import (LocalComponents, batches_of, complete_groups, in_parts, keyed, numbered, only_memory,
                                  pairs_in_groups, stored)
from orderflow.llm.components import connected_components

BITS = 64
SEED = 42
#: Cost of a shuffled index or probe row, in pair comparisons.
ROW_COST = 500.0
#: Numbers of partitions that are tried.
PARTITION_COUNTS = (2, 3, 4, 5, 6)
#: Rows of a bucket, and of each of two parts of a larger one, that meet at once.
PART_ROWS = 8192


def shingle_hashes(text: str | None, words: int) -> np.ndarray:
    """XXH64 (seed 42) of each run of ``words`` words, repeats included; all
    words if there are fewer; empty for a null or blank text.  A-Z are
    lower-cased; words are separated by ASCII white space."""
    import xxhash

    tokens = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not tokens:
        return np.zeros(0, np.uint64)
    joined = b" ".join(tokens)
    n = max(1, len(tokens) - words + 1)
    ends = np.cumsum([len(t) + 1 for t in tokens]) - 1
    starts = np.append(0, ends[:-1] + 1)
    last = np.minimum(np.arange(n) + words - 1, len(tokens) - 1)
    digest = xxhash.xxh64_intdigest
    return np.array([digest(joined[a:b], SEED) for a, b in zip(starts[:n].tolist(), ends[last].tolist())], np.uint64)


def fingerprint(text: str | None, words: int) -> int:
    """The 64-bit fingerprint, unsigned; 0 for a text without words."""
    h = shingle_hashes(text, words)
    if not len(h):
        return 0
    ones = np.zeros(BITS, np.int64)
    for at in range(0, len(h), 65536):  # memory does not follow the text
        ones += np.unpackbits(h[at:at + 65536].astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(h)).tobytes(), "big")


def fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 4) -> DataFrame:
    """(id, fp bigint with the fingerprint's 64 bits), a row for each input
    row; null and blank texts have fingerprint 0."""
    rows = keyed(df, id=id_col, text=text_col)
    schema = pa.schema([("id", pa.int64()), ("fp", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        only_memory("simhash")
        for b in batches:
            fp = np.array([fingerprint(t.as_py(), words) for t in b.column("text")], np.uint64)
            yield pa.record_batch([b.column("id").cast(pa.int64()), pa.array(fp.view(np.int64))], schema=schema)

    return rows.mapInArrow(run, "id bigint, fp bigint")


def group_bits(corr: np.ndarray, m: int) -> list[list[int]]:
    """Greedy grouping into ``m`` partitions of nearly equal width: each new
    partition starts with the free bit that is most correlated with the other
    free bits and takes those most correlated with its members."""
    free = list(range(len(corr)))
    strength = np.abs(corr - np.diag(np.diag(corr)))
    out = []
    for k in range(m):
        width = -(-len(free) // (m - k))
        part = [max(free, key=lambda b: (strength[b, free].sum(), -b))]
        free.remove(part[0])
        while len(part) < width:
            part.append(max(free, key=lambda b: (strength[b, part].sum(), -b)))
            free.remove(part[-1])
        out.append(sorted(part))
    return out


def within(q: np.ndarray) -> np.ndarray:
    """P(at most e of independent bits differ), e = 0 ... len(q)."""
    p = np.array([1.0])
    for x in q:
        p = np.append(p, 0) * (1 - x) + np.append(0, p) * x
    return np.cumsum(p)


def allocate(costs: np.ndarray, max_bits: int) -> tuple[float, list[int]]:
    """Thresholds t_p >= -1 with sum(t_p + 1) = max_bits + 1 of least total
    cost.  costs[p][s]: the cost of spending s = t_p + 1 on partition p."""
    best: list[tuple[float, list[int]]] = [(0.0, [])] + [(math.inf, [])] * (max_bits + 1)
    for row in costs:
        best = [min(((best[s - k][0] + row[k], best[s - k][1] + [k - 1]) for k in range(s + 1)), key=lambda x: x[0])
                for s in range(max_bits + 2)]
    return best[-1]


def plan_partitions(fps: DataFrame, max_bits: int) -> list[tuple[list[int], int]]:
    """[(bits, threshold)], fitted on counts over all distinct fingerprints.

    The driver gets the 64 x 64 table of joint bit counts, then one number
    for each partition tried: how many pairs agree in all its bits."""
    joint = pa.schema([("cell", pa.int32()), ("n", pa.int64())])

    def counts(batches):
        total = np.zeros((BITS + 1, BITS + 1), np.int64)
        for b in batches:
            x = bits_of(b.column("fp").to_numpy().view(np.uint64))
            x = np.hstack([x, np.ones((len(x), 1), np.float32)])
            total += (x.T @ x).astype(np.int64)
        yield pa.record_batch([pa.array(np.arange(total.size, dtype=np.int32)), pa.array(total.ravel())], schema=joint)

    rows = fps.select("fp").mapInArrow(counts, "cell int, n bigint").groupBy("cell").agg(F.sum("n").alias("n")).collect()
    table = np.zeros((BITS + 1) ** 2)
    for r in rows:
        table[r["cell"]] = r["n"]
    table = table.reshape(BITS + 1, BITS + 1)
    n = max(table[-1, -1], 1.0)
    mean = table[-1, :-1] / n
    cov = table[:-1, :-1] / n - np.outer(mean, mean)
    sd = np.sqrt(np.maximum(np.diag(cov), 1e-12))
    corr, differ = cov / np.outer(sd, sd), 2 * mean * (1 - mean)

    tried = {m: group_bits(corr, m) for m in PARTITION_COUNTS}
    parts = [(m, p, part) for m, split in tried.items() for p, part in enumerate(split)]
    value = F.explode(F.array(*[F.struct(F.lit(k).alias("k"), packed(part).alias("v"))
                                for k, (_, _, part) in enumerate(parts)])).alias("x")
    agree = {r["k"]: r["pairs"] for r in fps.select(value).groupBy("x.k", "x.v").count()
             .groupBy("k").agg(F.sum(F.col("count").cast("double") * (F.col("count") - 1) / 2).alias("pairs")).collect()}
    plans = []
    for m, split in tried.items():
        costs = np.full((m, max_bits + 2), math.inf)
        for k, (at, p, part) in enumerate(parts):
            if at != m:
                continue
            share, costs[p, 0] = within(differ[part]), 0.0
            # the pairs that agree are counted; farther ones follow the bits' own rates
            scale = max(agree.get(k, 0.0), 1.0) / max(share[0] * n * n / 2, 1e-300)
            for t in range(min(max_bits, len(part)) + 1):
                pairs = min(share[t] * n * n / 2 * max(scale, 1.0), n * n / 2)
                probes = sum(math.comb(len(part), e) for e in range(t + 1))
                costs[p, t + 1] = pairs + ROW_COST * n * probes
        plans.append((*allocate(costs, max_bits), split))
    _, thresholds, split = min(plans, key=lambda x: x[0])
    return [(part, t) for part, t in zip(split, thresholds) if t >= 0]


def packed(bits: list[int]):
    """The fingerprint's bits ``bits`` side by side, as a bigint column."""
    return sum((F.shiftright("fp", b).bitwiseAND(F.lit(1).cast("bigint")) * F.lit(1 << i).cast("bigint")
                for i, b in enumerate(bits)), F.lit(0).cast("bigint"))


def bits_of(fp: np.ndarray) -> np.ndarray:
    return ((fp[:, None] >> np.arange(BITS, dtype=np.uint64)) & np.uint64(1)).astype(np.float32)


def masks(width: int, t: int) -> np.ndarray:
    """All values of ``width`` bits with at most ``t`` set bits."""
    out, last = [0], [0]
    for _ in range(t):
        last = sorted({x | 1 << b for x in last for b in range(width) if not x >> b & 1})
        out += last
    return np.array(out, np.uint64)


def link_edges(fps: DataFrame, plan: list[tuple[list[int], int]], max_bits: int, part_rows: int = PART_ROWS) -> DataFrame:
    """(a, b) edges over distinct fingerprints whose components are those of
    all links.  Links of one task are joined there, so it emits at most one
    edge for each fingerprint and bucket, however many pairs link.  Buckets of
    more than ``part_rows`` rows are cut, and each two parts meet by themselves."""
    probes = [(np.array(part, np.uint64), masks(len(part), t)) for part, t in plan]
    keys = pa.schema([("key", pa.int64()), ("fp", pa.int64())])
    edges = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def buckets(batches):
        for b in batches:
            fp = b.column("fp").to_numpy().view(np.uint64)
            for p, (bits, flips) in enumerate(probes):
                value = np.zeros(len(fp), np.uint64)
                for i, bit in enumerate(bits):
                    value |= ((fp >> bit) & np.uint64(1)) << np.uint64(i)
                for flip in flips:  # a row at its own value and one at each near value
                    key = ((value ^ flip) | np.uint64(p) << np.uint64(60)).view(np.int64)
                    yield pa.record_batch([pa.array(key), b.column("fp")], schema=keys)

    def verify(batches):
        for table, bounds in complete_groups(batches, ["key", "block"]):
            fp = table.column("fp").to_numpy()
            bits = fp.view(np.uint64)
            local = LocalComponents(len(fp))
            for i, j in pairs_in_groups(bounds, side=table.column("side").to_numpy()):
                near = np.bitwise_count(bits[i] ^ bits[j]) <= max_bits
                local.link(i[near], j[near])
            moved = np.flatnonzero(local.label != np.arange(len(fp)))
            yield from batches_of({"a": fp[moved], "b": fp[local.label[moved]]}, edges)

    met = in_parts(fps.select("fp").mapInArrow(buckets, "key bigint, fp bigint"), part_rows, F.xxhash64("fp"))
    return met.select("key", "block", "side", "fp").repartition("key", "block").sortWithinPartitions("key", "block") \
        .mapInArrow(verify, "a bigint, b bigint")


def simhash_groups(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 4,
                   max_bits: int = 4) -> DataFrame:
    """(id, fp, component): a row for each input row; ``component`` is the
    smallest id reachable over links of at most ``max_bits`` differing bits.

    Null texts count as empty (fingerprint 0, linked like any other).  Equal
    fingerprints always link, whatever the ids.  Null ids are left out of the
    minimum; a component of null ids only has component null.  Repeated rows
    come back as often as they came.  An empty table gives no rows.  Extra
    columns of ``df`` are not read.
    """
    docs = stored(fingerprints(df, id_col, text_col, words), "fingerprints")
    distinct = stored(docs.groupBy("fp").agg(F.min("id").alias("id")), "distinct-fp")
    plan = plan_partitions(distinct, max_bits)
    member = connected_components(link_edges(distinct, plan, max_bits))
    root = distinct.join(member, distinct.fp == member.vertex, "left") \
        .select("fp", "id", F.coalesce("component", "fp").alias("root"))
    least = root.groupBy("root").agg(F.min("id").alias("component"))
    return docs.join(root.join(least, "root").select("fp", "component"), "fp").select("id", "fp", "component")


def keep_one_per_group(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 4,
                       max_bits: int = 4) -> DataFrame:
    """``df`` with one row of each group left: a row whose id is the group's
    smallest (of rows that repeat it, one; of rows without any id, one), with
    all its columns, whatever their names.  Null texts count as empty; an empty
    table stays empty."""
    rows, (id_col, text_col) = numbered(df, id_col, text_col)
    rows = stored(rows.withColumn("__row", F.monotonically_increasing_id()), "simhash-rows")
    groups = simhash_groups(rows.select(F.col("__row").alias("row"), F.col(f"`{text_col}`").alias("text")),
                            "row", "text", words, max_bits)
    met = groups.select("id", "component").join(keyed(rows, id="__row", doc=id_col), "id")
    kept = met.groupBy("component").agg(F.min(F.struct(F.col("doc").isNull(), "doc", "id")).alias("first"))
    return rows.join(kept.select(F.col("first.id").alias("__row")), "__row", "left_semi").drop("__row").toDF(*df.columns)
