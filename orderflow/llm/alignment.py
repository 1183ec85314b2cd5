"""Alignment of two tokenizers over a corpus, by exact-text deduplication.

Texts are shuffled by their full content, so that each distinct text is
tokenised and aligned once, however often it occurs; its number of copies
weighs what it adds to the corpus-wide counts of id pairs.  The measures of a
distinct text then join the documents through the text's SHA-256.

A text's tokens of both tokenizers are byte ranges.  Where a token of A and a
token of B end at the same byte, the two are linked, and the tokens up to
there form a group.

Counting runs in blocks: the task that aligns texts closes a block after
``BLOCK_PAIRS`` pairs and writes, beside a row per text, one row with the
block's distinct pairs and their weights.  Only those meet the corpus-wide
counts, so a pair that stands in every text costs a row per block, and the
texts of a block are measured against the block's own counts.
"""

from __future__ import annotations

import functools
import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderflow.llm.common import few_bytes, keyed, one_thread, packed, stored, strings
from orderflow.llm.token_fst import byte_names

#: Id pairs of the texts of a block, each pair counted once a text.
BLOCK_PAIRS = 1 << 16
#: Bytes of texts that are tokenised at a time (a longer text goes alone).
AT_ONCE = 1 << 20
#: Characters of the words whose ids a worker remembers (some 20 bytes each);
#: then it starts anew.  Each idle worker of an executor keeps its own.
MEMO_CHARS = 2_000_000
#: A blank that does not follow other text: there, words can't be cut apart.
_OPEN_BLANK = re.compile(r"(?:^|\s) ")


class TwoTokenizers:
    """The ids and token bytes of texts by both tokenizers of a worker.

    Both begin a new token at a blank that follows other text, so the ids of a
    text are those of its words, which are remembered.  The words of many texts
    are split and numbered in Arrow, and only distinct ones are looked up.
    Texts with a blank elsewhere go to the libraries whole.
    """

    def __init__(self, a_path: str, b_path: str):
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True
        self.a.no_padding()
        self.a.no_truncation()
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        raw = {c: bytes([b]) for b, c in byte_names().items()}
        vocab = self.a.get_vocab()
        a_bytes = [b""] * (max(vocab.values()) + 1)
        for token, i in vocab.items():
            a_bytes[i] = b"".join(raw.get(c, c.encode()) for c in token)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode()
                   for i, p in enumerate(pieces)]
        self.a_bytes, self.b_bytes = pa.array(a_bytes, pa.large_binary()), pa.array(b_bytes, pa.large_binary())
        self.n_a, self.n_b = len(a_bytes), len(b_bytes)
        n = max(self.n_a, self.n_b)
        self.kinds = n
        self.digits = pa.array([f"{i}{mark}".encode() for mark in ",|;" for i in range(n)], pa.large_binary())
        # no piece of B crosses a blank, and B changes no white space
        probe = "of the \tend\r\n of"
        self.by_word = not any("▁" in p.lstrip("▁") for p in pieces) and \
            "".join(map(pieces.__getitem__, self.b.encode(probe))).count("▁") == 1 + probe.count(" ")
        self.known: dict[str, bytes] = {}  # number of A's ids, A's ids, B's ids
        self.chars = 0

    def encode(self, texts: pa.Array) -> tuple[tuple[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]:
        """The ids of all texts (no nulls) in a row and each text's first, and
        the end: by A (behind a blank) and by B."""
        whole = [i for i, t in enumerate(texts.to_pylist()) if not self.by_word or _OPEN_BLANK.search(t)]
        alone = np.zeros(len(texts), bool)
        alone[whole] = True
        split = pc.split_pattern(pc.if_else(pa.array(alone), "", texts), " ")
        words = split.flatten().dictionary_encode()
        firsts = split.offsets.to_numpy() - split.offsets[0].as_py()
        codes = words.indices.to_numpy().copy()
        codes[firsts[whole]] = len(words.dictionary) + np.arange(len(whole))
        ids = self._ids_of(strings(words.dictionary, " ")) + self._by_library(texts.take(pa.array(whole, pa.int64())).to_pylist())
        flat = np.frombuffer(b"".join(ids), "<i4")
        ends = np.cumsum([len(x) for x in ids], dtype=np.int64) // 4
        starts = np.concatenate([[0], ends[:-1]])
        n_a = flat[starts].astype(np.int64)
        n_b = ends - starts - 1 - n_a
        at = np.arange(len(flat)) - np.repeat(starts, ends - starts)  # place behind a word's count
        by_a = at <= np.repeat(n_a, ends - starts)
        return tuple(_by_text(flat[picked], n, codes, firsts) for picked, n in ((by_a & (at > 0), n_a), (~by_a, n_b)))

    def _by_library(self, texts: list[str]) -> list[bytes]:
        a = self.a.encode_batch_fast([" " + t for t in texts], add_special_tokens=False)
        b = self.b.encode(texts, num_threads=1)
        return [packed([len(i := x.ids), *i, *y]) for x, y in zip(a, b)]

    def _ids_of(self, words: list[str]) -> list[bytes]:
        ids = list(map(self.known.get, words))
        new = [i for i, x in enumerate(ids) if x is None]
        if new and self.chars > MEMO_CHARS:
            self.known, self.chars = {}, 0
        for at in range(0, len(new), 4096):
            places = new[at:at + 4096]
            some = [words[i] for i in places]
            got = self._by_library(some)
            if "" in some:  # B has no token for no text; after other text it has the blank
                got[some.index("")] += packed([self.b.piece_to_id("▁")])
            for i, w, x in zip(places, some, got):
                ids[i] = self.known[w] = x
            self.chars += sum(map(len, some))
        return ids


def _by_text(ids: np.ndarray, sizes: np.ndarray, codes: np.ndarray, firsts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The ids of texts and each text's first, and the end, from the ids of
    distinct words, how many each has, and the texts' words."""
    lists = pa.LargeListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)])), pa.array(ids))
    ends = np.concatenate([[0], np.cumsum(sizes[codes])])
    return lists.take(pa.array(codes)).flatten().to_numpy(), ends[firsts]


@functools.cache
def two_tokenizers(a_path: str, b_path: str) -> TwoTokenizers:
    one_thread()
    return TwoTokenizers(a_path, b_path)


def _taken(table: pa.Array, ids: np.ndarray) -> tuple[np.ndarray, memoryview]:
    """Ends of the table's values at ``ids``, and the values joined."""
    got = table.take(pa.array(ids))
    _, offsets, data = got.buffers()
    ends = np.frombuffer(offsets, np.int64, len(ids) + 1) if len(ids) else np.zeros(1, np.int64)
    return ends, memoryview(data if data is not None else b"").cast("B")


class Aligned:
    """The alignment of a few texts; those whose token bytes differ from the
    text have no tokens.  ``bounds_*``: each text's first item, and the end."""

    def __init__(self, two: TwoTokenizers, texts: pa.Array):
        by_both = two.encode(texts)
        expected = [b" " + t.encode() for t in texts.to_pylist()]
        good = np.ones(len(texts), bool)
        for (ids, bounds), table in zip(by_both, (two.a_bytes, two.b_bytes)):
            ends, data = _taken(table, ids)
            at = ends[bounds]
            good &= [data[at[i]:at[i + 1]] == e for i, e in enumerate(expected)]
        if not good.all():
            by_both = [(ids[np.repeat(good, np.diff(bounds))], np.concatenate([[0], np.cumsum(np.diff(bounds) * good)]))
                       for ids, bounds in by_both]
        (self.ids_a, self.bounds_a), (self.ids_b, self.bounds_b) = by_both
        ends_a, _ = _taken(two.a_bytes, self.ids_a)
        ends_b, _ = _taken(two.b_bytes, self.ids_b)
        # all token bytes are those of the texts, so ends of both compare
        token = np.full(int(ends_a[-1]) + 1, -1, np.int64)
        token[ends_a[1:]] = np.arange(len(self.ids_a))
        met = token[ends_b[1:]]
        self.link_b = np.flatnonzero(met >= 0)
        self.link_a = met[self.link_b]
        self.bounds = np.searchsorted(self.link_b, self.bounds_b)
        self.two = two

    def digests(self) -> list[str]:
        """SHA-256 of each text's groups, written out; '' without tokens."""
        n, last = self.two.kinds, len(self.link_a)
        ends_group_a, ends_group_b = np.zeros(len(self.ids_a), np.int64), np.zeros(len(self.ids_b), np.int64)
        ends_group_a[self.link_a] = ends_group_b[self.link_b] = 1
        group_a = np.cumsum(ends_group_a) - ends_group_a
        group_b = np.cumsum(ends_group_b) - ends_group_b
        before = np.concatenate([[0], self.link_b + 1])  # tokens of B before a group
        through = np.concatenate([self.link_a + 1, [0]])  # tokens of A up to its end
        items = np.empty(len(self.ids_a) + len(self.ids_b), np.int64)
        items[np.arange(len(self.ids_a)) + before[np.minimum(group_a, last)]] = self.ids_a + n * ends_group_a
        items[np.arange(len(self.ids_b)) + through[group_b]] = self.ids_b + 2 * n * ends_group_b
        ends, data = _taken(self.two.digits, items)
        at = ends[self.bounds_a + self.bounds_b]
        return [hashlib.sha256(data[i:j - 1]).hexdigest() if j > i else "" for i, j in zip(at, at[1:])]

    def pairs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Distinct pairs (A's id * B's size + B's id) of each text in turn,
        how often they are linked there, and each text's first pair."""
        size = self.two.n_a * self.two.n_b
        text = np.repeat(np.arange(len(self.bounds) - 1), np.diff(self.bounds))
        pair = self.ids_a[self.link_a].astype(np.int64) * self.two.n_b + self.ids_b[self.link_b]
        key, times = np.unique(text * size + pair, return_counts=True)
        return key % size, times, np.searchsorted(key // size, np.arange(len(self.bounds)))


_ALIGNED = pa.schema([("block", pa.int64()), ("digest", pa.binary()), ("n_a", pa.int64()), ("n_b", pa.int64()),
                      ("n_groups", pa.int64()), ("n_links", pa.int64()), ("groups_sha256", pa.string()),
                      ("pairs", pa.list_(pa.int64())), ("times", pa.list_(pa.int64()))])
_ALIGNED_DDL = ("block bigint, digest binary, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, "
                "groups_sha256 string, pairs array<bigint>, times array<bigint>")


def _lists(values: np.ndarray, bounds: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(values, pa.int64()))


def _align_texts(a_path: str, b_path: str, block_pairs: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        block = TaskContext.get().partitionId() << 32
        two = two_tokenizers(a_path, b_path)
        held: list[tuple[np.ndarray, np.ndarray]] = []  # pairs and weights of the open block
        n_held = 0

        def close() -> pa.RecordBatch:
            """The block's own row: its distinct pairs and their weights."""
            pair, at = np.unique(np.concatenate([p for p, _ in held]), return_inverse=True)
            weight = np.zeros(len(pair), np.int64)
            np.add.at(weight, at, np.concatenate([w for _, w in held]))
            ends = np.array([0, len(pair)])
            none = [None]
            return pa.record_batch([pa.array([block]), pa.array(none, pa.binary()), *[pa.array(none, pa.int64())] * 4,
                                    pa.array(none, pa.string()), _lists(pair, ends), _lists(weight, ends)], schema=_ALIGNED)

        for b in batches:
            texts, copies = b.column("text"), b.column("copies").to_numpy()
            for some in few_bytes(pc.binary_length(texts).to_numpy(), AT_ONCE):
                few = Aligned(two, texts[some])
                pair, times, bounds = few.pairs()
                n = some.stop - some.start
                links = np.diff(few.bounds)
                yield pa.record_batch([
                    pa.array(np.full(n, block)), b.column("digest")[some], pa.array(np.diff(few.bounds_a)),
                    pa.array(np.diff(few.bounds_b)), pa.array(links), pa.array(links), pa.array(few.digests()),
                    _lists(pair, bounds), _lists(times, bounds)], schema=_ALIGNED)
                held.append((pair, times * np.repeat(copies[some], np.diff(bounds))))
                n_held += len(pair)
                if n_held >= block_pairs:
                    yield close()
                    block, held, n_held = block + 1, [], 0
        if n_held:
            yield close()

    return run


_MEASURED = pa.schema([f for f in _ALIGNED if f.name not in ("block", "pairs", "times")]
                      + [pa.field("n_best", pa.int64()), pa.field("count_sum", pa.int64())])


def _measure(texts: pa.Table, counts: pa.Table) -> pa.Table:
    """The texts of a block against the counts of the block's pairs."""
    texts, counts = texts.combine_chunks(), counts.combine_chunks()
    pair, count = counts.column("pair").to_numpy(), counts.column("count").to_numpy()
    best = counts.column("best").to_numpy(zero_copy_only=False).astype(bool)
    order = np.argsort(pair)
    lists = texts.column("pairs").combine_chunks()
    n = np.asarray(lists.value_lengths().fill_null(0))
    flat = order[np.searchsorted(pair, np.asarray(lists.flatten()), sorter=order)] if len(pair) else np.zeros(0, np.int64)
    times = np.asarray(texts.column("times").combine_chunks().flatten())
    bounds = np.concatenate([[0], np.cumsum(n)])

    def summed(values: np.ndarray) -> pa.Array:
        running = np.concatenate([[0], np.cumsum(values)])
        return pa.array(running[bounds[1:]] - running[bounds[:-1]], pa.int64())

    columns = [texts.column(f.name) for f in _MEASURED if f.name in texts.column_names]
    return pa.table([*columns, summed(times * best[flat]), summed(times * count[flat])], schema=_MEASURED)


def aligned_texts(df: DataFrame, a_path: str, b_path: str, text_col: str = "text",
                  block_pairs: int = BLOCK_PAIRS) -> DataFrame:
    """Each distinct non-empty text aligned once, written: a row per text
    (its SHA-256, numbers of tokens, groups and links, its pairs) and a row
    per block (``digest`` null) with the pairs of its texts and their weights."""
    texts = keyed(df, text=text_col).where("text <> ''").groupBy("text").agg(F.count(F.lit(1)).alias("copies"))
    texts = texts.withColumn("digest", F.unhex(F.sha2("text", 256)))
    return stored(texts.mapInArrow(_align_texts(a_path, b_path, block_pairs), _ALIGNED_DDL), "aligned")


def pair_counts(aligned: DataFrame, n_b: int) -> DataFrame:
    """(pair, a_id, b_id, count, best): how many links corpus-wide hold the
    pair linked, copies of texts counted; ``best``: no pair with this id of B
    has more."""
    weights = aligned.where("digest IS NULL").select(F.explode(F.arrays_zip("pairs", "times")).alias("p")) \
        .select(F.col("p.pairs").alias("pair"), F.col("p.times").alias("times"))
    counts = weights.groupBy("pair").agg(F.sum("times").alias("count")) \
        .withColumn("a_id", F.floor(F.col("pair") / n_b).cast("bigint")).withColumn("b_id", F.col("pair") % n_b)
    highest = counts.groupBy("b_id").agg(F.max("count").alias("highest"))
    return counts.join(highest, "b_id").select("pair", "a_id", "b_id", "count", (F.col("count") == F.col("highest")).alias("best"))


def align(df: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text",
          block_pairs: int = BLOCK_PAIRS) -> DataFrame:
    """(id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) for
    every row.

    A is a byte-level vocabulary of the ``tokenizers`` library and reads the
    text behind a blank; B is a ``sentencepiece`` model, which adds that blank
    itself.  Both files must exist on every executor.  Null and empty texts,
    and texts whose token bytes by A or B differ from the text, have no tokens:
    zeros and ''.  Repeated rows and texts come back as often as they came,
    with equal measures, and each copy counts; null ids are ids like others.
    An empty table gives no rows; other columns are not read, whatever their
    names.  A text must fit in a task.
    """
    aligned = aligned_texts(df, a_path, b_path, text_col, block_pairs)
    scored = stored(pair_counts(aligned, _size_of(b_path)).select("pair", "count", "best"), "pair-counts")
    wanted = aligned.where("digest IS NULL").select(F.col("block").alias("of_block"), F.explode("pairs").alias("pair"))
    wanted = wanted.join(scored, "pair")
    measured = aligned.where("digest IS NOT NULL").groupBy("block").cogroup(wanted.groupBy("of_block")) \
        .applyInArrow(_measure, "digest binary, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string, "
                                "n_best bigint, count_sum bigint")
    docs = keyed(df, id=id_col, text=text_col).select("id", F.unhex(F.sha2("text", 256)).alias("digest"))
    zeros = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"]
    return docs.join(measured, "digest", "left").select(
        "id", *[F.coalesce(c, F.lit(0).cast("bigint")).alias(c) for c in zeros],
        F.coalesce("groups_sha256", F.lit("")).alias("groups_sha256"))


def _size_of(b_path: str) -> int:
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=b_path).get_piece_size()
