"""Toxicity by nearest labelled examples, exact TF-IDF cosine.

Examples are a bounded sample of the labelled documents (``PER_CLASS`` of
each label, smallest seeded hashes first).  Terms are words and the first
letters of words; those that toxic examples have far more often than clean
ones (a z-test) make the vocabulary, at most ``MOST_TERMS``; all other words
together are one background term, so that one toxic word weighs more in a
short text than in a long one.  Weights are (1 + ln tf) * idf.

The examples stand in an inverted index cut into blocks of neighbouring
examples; each term keeps its largest weight in each block.  A search visits
blocks in order of their upper bounds and ends when the next bound is below
the k-th best cosine, so it returns exactly the k nearest (ties: the first in
the index).  Votes are weighted by closeness and by how many labelled rows an
example stands for; a logistic fit on the examples, each scored without
itself, turns the vote into a probability.
"""

from __future__ import annotations

import json
import math
import re
import uuid
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from orderflow.llm.common import keyed, numbered, only_memory, stored

#: The bound of the sample that is learnt from, for each label.
PER_CLASS = 4096
MOST_TERMS = 512
#: A term must be in this many toxic examples, and its share among toxic
#: examples this many standard errors above that among clean ones.
LEAST_EXAMPLES = 5
LEAST_Z = 5.0
#: Lengths of word beginnings that are terms.
BEGINNINGS = (4, 5, 6, 7, 8)
NEIGHBOURS = 11
#: Votes weigh cosine ** CLOSENESS.
CLOSENESS = 4
#: The vote of the prior, in neighbours.
PRIOR_VOTE = 0.25
BLOCK = 64
#: Examples named as evidence.
EVIDENCE = 3
#: Blocks that are read along between two that have to be.
GAP = 3
#: Words that a worker remembers for one index.
MEMO = 64_000
#: Short texts whose results it remembers.
MEMO_TEXTS = 20_000
WORD = re.compile(r"[^\W\d_]+")


def terms_of(word: str) -> list[str]:
    return [word, *(word[:n] + "*" for n in BEGINNINGS if len(word) > n)]


def term_counts(text: str | None) -> Counter:
    """Terms of a whole text with their counts; "" counts all words."""
    words = Counter(WORD.findall((text or "").lower()))
    out = Counter({"": sum(words.values())}) if words else Counter()
    for w, n in words.items():
        for t in terms_of(w):
            out[t] += n
    return out


_MEMORY: dict[str, tuple[dict, dict, dict]] = {}


def memory(name: str) -> tuple[dict, dict, dict]:
    """What this worker remembers for an index: words, results of short texts,
    and what words count as, one object for all words that count alike.  Only
    the last index used has any."""
    if name not in _MEMORY:
        _MEMORY.clear()
        _MEMORY[name] = ({}, {}, {})
    return _MEMORY[name]


@dataclass
class Index:
    """Block-max inverted index of the examples' unit vectors."""

    terms: dict[str, int]
    idf: np.ndarray
    ids: list
    toxic: np.ndarray
    stands_for: np.ndarray
    postings: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]  # term -> (place, weight, first posting of each block)
    most: np.ndarray  # term x block
    prior: float
    slope: float = 1.0
    shift: float = 0.0
    name: str = field(default_factory=lambda: uuid.uuid4().hex)

    def vector(self, counts: dict[int, int]) -> tuple[np.ndarray, np.ndarray]:
        """(terms, weights) of the unit vector; empty without any term."""
        t = np.array(sorted(counts), np.int64)
        w = (1 + np.log(np.array([counts[i] for i in t.tolist()], float))) * self.idf[t] if len(t) else np.zeros(0)
        norm = math.sqrt(float(w @ w))
        return (t, w / norm) if norm else (t[:0], w[:0])

    def nearest(self, terms: np.ndarray, weights: np.ndarray, k: int, without: int = -1) -> list[tuple[float, int]]:
        """The k examples of highest positive cosine, best first."""
        if not len(terms) or not self.most.shape[1]:
            return []
        bound = weights @ self.most[terms] + 1e-9
        top = int(np.argmax(bound))
        at, score = self._scores(terms, weights, max(top - 1, 0), min(top + 2, len(bound)))
        kept = at != without
        at, score = at[kept], score[kept]
        least = np.partition(score, len(score) - k)[len(score) - k] if len(score) >= k else 0.0
        # blocks beside the first ones whose bound reaches the k-th cosine, neighbours together
        open_ = np.flatnonzero((bound >= least) & (np.abs(np.arange(len(bound)) - top) > 1))
        if len(open_):
            runs = np.split(open_, np.flatnonzero(np.diff(open_) > GAP) + 1)
            found = [(at, score)]
            for run in runs:
                for lo, hi in self._without(int(run[0]), int(run[-1]) + 1, top):
                    some = self._scores(terms, weights, lo, hi)
                    kept = (some[0] != without) & (some[1] >= least)
                    found.append((some[0][kept], some[1][kept]))
            at, score = np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])
        best = np.lexsort((at, -score))[:k]
        return list(zip(score[best].tolist(), at[best].tolist()))

    @staticmethod
    def _without(lo: int, hi: int, top: int) -> list[tuple[int, int]]:
        """The block range without the blocks next to ``top``."""
        return [(a, b) for a, b in ((lo, min(hi, max(top - 1, 0))), (max(lo, top + 2), hi)) if a < b]

    def _scores(self, terms: np.ndarray, weights: np.ndarray, lo: int, hi: int) -> tuple[np.ndarray, np.ndarray]:
        """(places, cosines) of the examples of blocks lo ... hi - 1 that share a term."""
        places, parts = [], []
        for t, w in zip(terms.tolist(), weights.tolist()):
            if t in self.postings:
                place, weight, first = self.postings[t]
                a, b = first[lo], first[hi]
                if a < b:
                    places.append(place[a:b])
                    parts.append(w * weight[a:b])
        if not places:
            return np.zeros(0, np.int64), np.zeros(0)
        base = lo * BLOCK
        score = np.bincount(np.concatenate(places) - base, np.concatenate(parts))
        some = np.flatnonzero(score > 0)
        return some + base, score[some]

    def vote(self, near: list[tuple[float, int]]) -> float:
        if not near:
            return self.prior
        i = np.array([i for _, i in near])
        w = np.array([s for s, _ in near]) ** CLOSENESS * self.stands_for[i]
        base = PRIOR_VOTE * float(np.mean(self.stands_for))
        return (float(w @ self.toxic[i]) + base * self.prior) / (float(w.sum()) + base)

    def probability(self, vote: float) -> float:
        return 1 / (1 + math.exp(-min(max(self.slope * _logit(vote) + self.shift, -30), 30)))

    def counts_of(self, text: str | None) -> dict[int, int]:
        """Counts of the vocabulary's terms in a whole text; the last is the
        background, all words without any."""
        total, out = 0, Counter()
        words, _, alike = memory(self.name)
        for word, n in Counter((text or "").lower().split()).items():
            known = words.get(word)
            if known is None:
                found = WORD.findall(word)
                known = (len(found), tuple(self.terms[t] for w in found for t in terms_of(w) if t in self.terms))
                if len(words) < MEMO:
                    words[word] = alike.setdefault(known, known)
            total += n * known[0]
            for t in known[1]:
                out[t] += n
        if total:
            out[len(self.terms)] = total
        return out

    def score(self, text: str | None) -> tuple[float, list[tuple[float, int]]]:
        counts = self.counts_of(text)
        key = tuple(sorted(counts.items()))
        if len(counts) == 1:
            key = ()  # one term only: every such text has the same direction
        elif not counts:
            return self.probability(self.prior), []
        seen = memory(self.name)[1]
        known = seen.get(key)
        if known is None:
            near = self.nearest(*self.vector(counts), NEIGHBOURS)
            known = (self.probability(self.vote(near)), near[:EVIDENCE])
            if len(key) <= 4 and len(seen) < MEMO_TEXTS:
                seen[key] = known
        return known


def _logit(p: float) -> float:
    p = min(max(p, 1e-6), 1 - 1e-6)
    return math.log(p / (1 - p))


def build_index(rows: list[tuple], terms: list[str], df: list[int], stands_for: tuple[float, float], prior: float) -> Index:
    """``rows``: (id, toxic, {term: count}) of the examples."""
    at = {t: i for i, t in enumerate(terms)}
    n = max(len(rows), 1)
    idf = np.array([math.log(n / max(d, 1)) + 1 for d in df] + [1.0])
    ix = Index(at, idf, [], np.zeros(0), np.zeros(0), {}, np.zeros((len(terms) + 1, 0)), prior)
    # examples with the same leading term stand together: their blocks have tight bounds
    vectors = []
    for id_, toxic, counts in rows:
        own = {at[t]: c for t, c in counts.items() if t in at}
        if counts.get(""):
            own[len(at)] = counts[""]
        t, w = ix.vector(own)
        if len(t):
            vectors.append((int(t[np.argmax(w)]), -float(w.max()), str(id_), id_, toxic, t, w))
    vectors.sort(key=lambda v: v[:3])
    ix.ids = [v[3] for v in vectors]
    ix.toxic = np.array([float(v[4]) for v in vectors])
    ix.stands_for = np.array([stands_for[int(v[4])] for v in vectors])
    ix.most = np.zeros((len(terms) + 1, -(-len(vectors) // BLOCK)))
    lists: dict[int, tuple[list, list]] = {}
    for i, v in enumerate(vectors):
        for t, w in zip(v[5].tolist(), v[6].tolist()):
            lists.setdefault(t, ([], []))
            lists[t][0].append(i), lists[t][1].append(w)
            ix.most[t, i // BLOCK] = max(ix.most[t, i // BLOCK], w)
    begins = np.arange(ix.most.shape[1] + 1) * BLOCK
    ix.postings = {t: (np.array(p), np.array(w), np.searchsorted(p, begins)) for t, (p, w) in lists.items()}
    _calibrate(ix, [(v[5], v[6]) for v in vectors])
    return ix


def _calibrate(ix: Index, vectors: list) -> None:
    """Fit probability = logistic(slope * logit(vote) + shift) on the examples
    (each without itself), weighted by the rows they stand for, with targets
    a little inside 0 and 1."""
    if not len(ix.toxic) or not 0 < ix.toxic.sum() < len(ix.toxic):
        return
    x = np.array([_logit(ix.vote(ix.nearest(t, w, NEIGHBOURS, without=i))) for i, (t, w) in enumerate(vectors)])
    ones, n = ix.toxic.sum(), len(ix.toxic)
    y = np.where(ix.toxic > 0, (ones + 1) / (ones + 2), 1 / (n - ones + 2))
    w = ix.stands_for / ix.stands_for.mean()
    a = np.array([1.0, 0.0])
    X = np.stack([x, np.ones_like(x)], 1)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(X @ a, -30, 30)))
        g = X.T @ (w * (p - y)) + 1e-3 * (a - [1.0, 0.0])
        H = (X * (w * np.maximum(p * (1 - p), 1e-9))[:, None]).T @ X + 1e-3 * np.eye(2)
        step = np.linalg.solve(H, g)
        a = a - np.clip(step, -1, 1)
        if np.abs(step).max() < 1e-8:
            break
    if a[0] > 0:  # a higher vote must never mean a lower score
        ix.slope, ix.shift = float(a[0]), float(a[1])


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        label_id: str = "doc_id", label_col: str = "toxic", per_class: int = PER_CLASS) -> Index:
    """Learn from ``labels`` (0 or 1; null labels are left out; of several
    labels of one id the largest holds; an id with several texts gives several
    examples).  What the driver gets is bounded by ``per_class`` and
    ``MOST_TERMS``; terms are counted where the texts are."""
    marks = keyed(labels, id=label_id, toxic=label_col).where("id is not null and toxic in (0, 1)") \
        .groupBy("id").agg(F.max("toxic").cast("int").alias("toxic"))
    marks = stored(marks, "labels")
    n = {r["toxic"]: r["count"] for r in marks.groupBy("toxic").count().collect()}
    order = [F.xxhash64("id", F.lit(7)), F.col("id")]
    sample = marks.where("toxic = 1").orderBy(*order).limit(per_class) \
        .unionByName(marks.where("toxic = 0").orderBy(*order).limit(per_class))
    # at most 2 * per_class rows of two numbers
    texts = keyed(docs, id=id_col, text=text_col).join(F.broadcast(sample.withColumnRenamed("id", "l_id")), F.col("id") == F.col("l_id"))
    texts = texts.select("id", "toxic", "text").repartition(16, F.xxhash64("id"))
    counted = pa.schema([("term", pa.string()), ("ones", pa.int64()), ("zeros", pa.int64())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = (Counter(), Counter())
        for b in batches:
            for toxic, text in zip(b.column("toxic").to_pylist(), b.column("text")):
                of[toxic].update(term_counts(text.as_py()).keys())
        terms = list(of[1])  # only terms that toxic examples have can be chosen ...
        yield pa.record_batch([pa.array(terms, pa.string()), pa.array([of[1][t] for t in terms], pa.int64()),
                               pa.array([of[0][t] for t in terms], pa.int64())], schema=counted)
        rest = list(of[0].keys() - of[1].keys())  # ... but clean ones of other tasks count against them
        yield pa.record_batch([pa.array(rest, pa.string()), pa.array([0] * len(rest), pa.int64()),
                               pa.array([of[0][t] for t in rest], pa.int64())], schema=counted)

    sampled = {r["toxic"]: r["count"] for r in sample.groupBy("toxic").count().collect()}
    n1, n0 = float(sampled.get(1, 0)), float(sampled.get(0, 0))
    chosen = []
    if n1 and n0:
        share = (F.col("ones") + F.col("zeros")) / (n1 + n0)
        z = (F.col("ones") / n1 - F.col("zeros") / n0) / F.sqrt(share * (1 - share) * (1 / n1 + 1 / n0) + 1e-12)
        chosen = texts.mapInArrow(count, "term string, ones bigint, zeros bigint") \
            .groupBy("term").agg(F.sum("ones").alias("ones"), F.sum("zeros").alias("zeros")) \
            .where((F.col("ones") >= LEAST_EXAMPLES) & (F.col("term") != "")).withColumn("z", z) \
            .where(F.col("z") > LEAST_Z).orderBy(F.col("z").desc(), "term").limit(MOST_TERMS).collect()
    terms = [r["term"] for r in chosen]
    wanted = frozenset(terms) | {""}

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            counts = [json.dumps({t: c for t, c in term_counts(x.as_py()).items() if t in wanted}) for x in b.column("text")]
            yield pa.record_batch([b.column("id").cast(pa.string()), b.column("toxic"), pa.array(counts, pa.string())], names=["id", "toxic", "counts"])

    rows = [(r["id"], r["toxic"], json.loads(r["counts"]))
            for r in texts.mapInArrow(vectors, "id string, toxic int, counts string").collect()] if n1 + n0 else []
    prior = n.get(1, 0) / max(sum(n.values()), 1)
    return build_index(rows, terms, [r["ones"] + r["zeros"] for r in chosen],
                       (n.get(0, 0) / max(n0, 1), n.get(1, 0) / max(n1, 1)), prior)


def score(docs: DataFrame, index: Index, id_col: str = "doc_id", text_col: str = "text", keep: bool = False) -> DataFrame:
    """(id, score, evidence) for every row, in one narrow pass; ``keep`` also
    returns all columns of ``docs`` (score and evidence, named ``__score`` and
    ``__evidence``, come after them, the id not again).

    ``evidence`` lists the ids (as text) and cosines of the nearest examples.
    Null, empty and wordless texts have no neighbours: they get the
    calibrated prior.  Whole texts are read.  Repeated rows come back as often
    as they came; an empty table gives no rows.
    """
    spark = docs.sparkSession
    held = spark.sparkContext.broadcast(index)  # at most 2 * PER_CLASS examples of MOST_TERMS terms
    out = pa.struct([("id", pa.string()), ("cosine", pa.float64())])
    extra = [("__score", pa.float64()), ("__evidence", pa.list_(out))]
    rows = docs if keep else keyed(docs, id=id_col, text=text_col)
    text = text_col if keep else "text"
    left = docs.columns if keep else ["id"]
    schema = pa.schema([(f.name, to_arrow_type(f.dataType)) for f in rows.schema.fields if f.name in left] + extra)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ix = held.value
        only_memory("toxicity", _MEMORY.clear)
        for b in batches:
            for at in range(0, b.num_rows, 1024):
                some = b.slice(at, 1024)
                found = [ix.score(t.as_py()) for t in some.column(text)]
                near = [[{"id": ix.ids[i], "cosine": min(s, 1.0)} for s, i in e] for _, e in found]
                cols = [some.column(c).cast(schema.field(c).type) for c in left]
                yield pa.record_batch([*cols, pa.array([s for s, _ in found], pa.float64()), pa.array(near, pa.list_(out))], schema=schema)

    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields if f.name in left)
    scored = rows.mapInArrow(run, f"{ddl}, __score double, __evidence array<struct<id:string,cosine:double>>")
    return scored if keep else scored.withColumnsRenamed({"__score": "score", "__evidence": "evidence"})


def learn_rows(labels: DataFrame, id_col: str = "doc_id", folds: int = 5) -> DataFrame:
    """Labelled rows outside fold 0 (CRC-32 of the id as text, mod ``folds``)."""
    return labels.where(F.crc32(F.col(id_col).cast("string").cast("binary")) % folds != 0)


def rejected(spark: SparkSession, docs: DataFrame, labels: DataFrame, limit: float = 0.5, id_col: str = "doc_id",
             text_col: str = "text", **names) -> DataFrame:
    """``docs`` without the rows that score ``limit`` or more, with all their
    columns, whatever their names.  Null, empty and wordless texts score the
    prior; repeated rows stay or go together; without any labelled row every
    text scores the prior of an empty sample, next to 0; an empty table stays empty."""
    rows, (own_id, own_text) = numbered(docs, id_col, text_col)
    scored = score(rows, fit(docs, labels, id_col, text_col, **names), own_id, own_text, keep=True)
    return scored.where(F.col("__score") < limit).select(*rows.columns).toDF(*docs.columns)
