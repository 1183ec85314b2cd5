"""Sum-of-squares online packing of documents into token windows.

A document's full windows are cut off; its rest goes to the fill level ``h``
for which the sum over all levels of (number of open windows at that level)
squared grows least, level 0 being a new window.  The packer's state is the
array of counts by level and the open windows themselves, whose number is
bounded: beyond ``MOST_OPEN`` they are drained, as at the end.  Draining
fills windows from the fullest on by cutting the pieces of the emptiest; what
does not fill a window goes to sequences whose lengths are powers of two.

Each task packs the documents of its partition as they come, so nothing is
shuffled and no window spans two tasks.
"""

from __future__ import annotations

import functools
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from orderflow.llm.common import batches_of, few_bytes, keyed, one_thread, only_memory, packed, strings
from orderflow.llm.token_fst import byte_names

WINDOW = 2048
#: Open windows a task holds at most.
MOST_OPEN = 4096
#: The id that ends each document.
END_ID = 1
#: Characters of the words whose ids a worker remembers; then it starts anew.
MEMO_CHARS = 4_000_000
#: Bytes of texts that are tokenised at a time (a longer text goes alone).
AT_ONCE = 1 << 20
#: Finished sequences that a task gathers before it hands them on.
DONE_AT_ONCE = 512
TOKEN_BYTES = 4
#: Marks that are a token piece of their own after a letter.
MARKS = frozenset(".,;:!?")
#: Words that the tokenizer's normalizer leaves alone and its splitter keeps whole.
PLAIN = re.compile("[a-zß-öø-ÿ]+")


class WordTokens:
    """Ids of whole texts, with a memory of words.  Only for tokenizers that
    drop white space: there the ids of a text are those of its words (runs
    without ASCII white space) in order.

    The words of many texts are split and numbered in Arrow; only distinct
    ones are looked up, and those not known are asked of the library: plain
    ones of its model alone, which is what it does with them in the end.
    """

    def __init__(self, path: str, memo_chars: int = MEMO_CHARS):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.model = self.library.model
        if self._ids("of the") != self._ids("of") + self._ids("the") or self._ids(" \t\n\r\x0b\x0c"):
            raise ValueError("the tokenizer does not drop white space between words")
        self.markers = [t.content.lower() for t in self.library.get_added_tokens_decoder().values()]
        self.names = byte_names()
        probe = ["thouinor", "zqxj", "a", "straße", "élève", "çoë", "ñandú"]
        self.plain = all([t.id for t in self._model_tokens(w)] == self._ids(w) for w in probe)
        self.known: dict[str, bytes] = {}
        self.chars, self.memo_chars = 0, memo_chars

    def _ids(self, text: str) -> list[int]:
        return self.library.encode(text, add_special_tokens=False).ids

    def _model_tokens(self, word: str) -> list:
        return self.model.tokenize(word if word.isascii() else "".join(map(self.names.__getitem__, word.encode())))

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts (no nulls) in a row, and each text's first, and the end."""
        low = pc.ascii_lower(texts)
        # A-Z may be lower-cased first, as the tokenizer does it itself,
        # unless that could make one of its special strings
        for marker in self.markers:
            found = pc.match_substring(low, marker)
            if pc.any(found).as_py():
                low = pc.if_else(found, texts, low)
        split = pc.ascii_split_whitespace(low)
        words = split.flatten().dictionary_encode()
        ids = self._ids_of(strings(words.dictionary, " "))
        bounds = np.concatenate([[0], np.cumsum([len(x) for x in ids], dtype=np.int64)]) // TOKEN_BYTES
        lists = pa.LargeListArray.from_arrays(pa.array(bounds), pa.array(np.frombuffer(b"".join(ids), "<u4")))
        codes = words.indices
        ends = np.concatenate([[0], np.cumsum(np.diff(bounds)[codes.to_numpy()])])
        firsts = split.offsets.to_numpy() - split.offsets[0].as_py()
        return lists.take(codes).flatten().to_numpy(), ends[firsts]

    def _ids_of(self, words: list[str]) -> list[bytes]:
        ids = list(map(self.known.get, words))
        new = [w for w, x in zip(words, ids) if x is None]
        if not new:
            return ids
        if self.chars > self.memo_chars:
            self.known, self.chars = {}, 0
        self._learn(new)
        known = self.known
        return [known[w] if x is None else x for w, x in zip(words, ids)]

    def _learn(self, words: list[str]) -> None:
        known, others, plain, tokens_of = self.known, [], PLAIN.fullmatch, self._model_tokens
        for mark in MARKS - known.keys():
            known[mark] = packed(self._ids(mark))
        chars = 0
        for w in words:
            stem = w[:-1] if w[-1:] in MARKS else w
            if not (self.plain and plain(stem)):
                others.append(w)
                continue
            ids = known.get(stem)
            if ids is None:
                ids = known[stem] = packed([t.id for t in tokens_of(stem)])
                chars += len(stem)
            if stem is not w:
                known[w] = ids + known[w[-1]]
                chars += len(w)
        for at in range(0, len(others), 4096):
            some = others[at:at + 4096]
            known.update(zip(some, (packed(e.ids) for e in self.library.encode_batch_fast(some, add_special_tokens=False))))
            chars += sum(map(len, some))
        self.chars += chars


@functools.cache
def word_tokens(path: str, memo_chars: int = MEMO_CHARS) -> WordTokens:
    one_thread()
    return WordTokens(path, memo_chars)


class Packer:
    """Windows of one task.  A piece is (document, start, ids as bytes)."""

    def __init__(self, size: int = WINDOW, most_open: int = MOST_OPEN):
        self.size, self.most_open = size, most_open
        self.count = np.zeros(size + 1, np.int64)  # open windows by level
        self.open: list[list[list]] = [[] for _ in range(size + 1)]
        self.n_open = 0
        self.done: list[list] = []

    def level_for(self, length: int) -> int:
        """The level at which a piece makes the sum of squares smallest; of
        equal ones the fullest.  Level 0: a new window."""
        top = self.size - length
        here, there = self.count[1:top + 1], self.count[1 + length:self.size + 1]
        # a window leaves level h (2c - 1 less) and enters h + length (2c + 1 more)
        change = np.where(here > 0, 2 * (there - here) + 2, np.iinfo(np.int64).max)
        if top >= 1 and here[-1] > 0:
            change[-1] = 1 - 2 * here[-1]  # full windows are not counted
        new = 2 * self.count[length] + 1
        if top < 1:
            return 0
        best = top - int(np.argmin(change[::-1]))
        return best if change[best - 1] <= new else 0

    def add(self, document, ids: bytes) -> None:
        n = len(ids) // TOKEN_BYTES
        whole = n - n % self.size
        for start in range(0, whole, self.size):
            self.done.append([(document, start, ids[start * TOKEN_BYTES:(start + self.size) * TOKEN_BYTES])])
        rest = n - whole
        if not rest:
            return
        h = self.level_for(rest)
        window = []
        if h:
            window = self.open[h].pop()
            self.count[h] -= 1
            self.n_open -= 1
        window.append((document, whole, ids[whole * TOKEN_BYTES:]))
        if h + rest == self.size:
            self.done.append(window)
            return
        self.open[h + rest].append(window)
        self.count[h + rest] += 1
        self.n_open += 1
        if self.n_open > self.most_open:
            self.drain(last=False)

    def drain(self, last: bool = True) -> None:
        """Fill the fullest windows from the emptiest ones.  ``last``: also
        close what is left, in sequences of powers of two."""
        windows = [w for level in reversed(self.open) for w in level]
        self.open = [[] for _ in range(self.size + 1)]
        self.count[:] = 0
        self.n_open = 0
        length = lambda w: sum(len(p[2]) for p in w) // TOKEN_BYTES
        lo, hi = 0, len(windows) - 1
        while lo < hi:
            room = self.size - length(windows[lo])
            while room and lo < hi:
                document, start, ids = windows[hi][-1]
                n = len(ids) // TOKEN_BYTES
                if n <= room:
                    windows[lo].append(windows[hi].pop())
                    room -= n
                    hi -= not windows[hi]
                else:  # the end of the piece moves
                    cut = (n - room) * TOKEN_BYTES
                    windows[hi][-1] = (document, start, ids[:cut])
                    windows[lo].append((document, start + n - room, ids[cut:]))
                    room = 0
            if room:
                break
            self.done.append(windows[lo])
            lo += 1
        for w in windows[lo:hi + 1]:
            n = length(w)
            if n == self.size:
                self.done.append(w)
            elif last:
                self.done += powers_of_two(w, n)
            else:
                self.open[n].append(w)
                self.count[n] += 1
                self.n_open += 1


def powers_of_two(pieces: list, length: int) -> list[list]:
    """The pieces in sequences as long as the binary digits of ``length``."""
    out, queue = [], list(reversed(pieces))
    for bit in reversed(range(length.bit_length())):
        if not length >> bit & 1:
            continue
        room, sequence = 1 << bit, []
        while room:
            document, start, ids = queue.pop()
            n = min(room, len(ids) // TOKEN_BYTES)
            sequence.append((document, start, ids[:n * TOKEN_BYTES]))
            if n * TOKEN_BYTES < len(ids):
                queue.append((document, start + n, ids[n * TOKEN_BYTES:]))
            room -= n
        out.append(sequence)
    return out


def pack(df: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
         window: int = WINDOW, most_open: int = MOST_OPEN, memo_chars: int = MEMO_CHARS) -> DataFrame:
    """A row per piece: id, row (the document's number in the result), start,
    length, ids (binary, little-endian 32-bit), doc_tokens, sequence_id,
    offset.

    Every document ends with the id ``END_ID``; null and empty texts have that
    id only.  Each id of a document lies in exactly one piece.  Sequences hold
    ``window`` ids, but for at most one per power of two and task.  Sequence
    ids and row numbers are those of the task and a number in it.  Rows that
    repeat, or ids that are null, are documents of their own (``row`` tells
    them apart).  An empty table gives no rows; other columns are not read.
    The order of the rows in a partition decides the result: read from files,
    it is the files' order, so a task that is run again packs alike.
    ``memo_chars`` (characters of words that a worker remembers) trades its
    memory for time and changes no result.
    """
    id_type = df.schema[id_col].dataType
    rows = keyed(df, id=id_col, text=text_col)
    schema = pa.schema([("id", to_arrow_type(id_type)), ("row", pa.int64()), ("start", pa.int64()), ("length", pa.int64()),
                        ("ids", pa.binary()), ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        base = TaskContext.get().partitionId() << 32
        only_memory("packing", word_tokens.cache_clear)
        words, packer = word_tokens(tokenizer_path, memo_chars), Packer(window, most_open)
        end = np.array([END_ID], "<u4").tobytes()
        n_rows = n_sequences = 0

        def finished() -> Iterator[pa.RecordBatch]:
            nonlocal n_sequences
            out: list[tuple] = []
            for sequence in packer.done:
                offset = 0
                for (doc, row, total), start, ids in sequence:
                    n = len(ids) // TOKEN_BYTES
                    out.append((doc, base + row, start, n, ids, total, base + n_sequences, offset))
                    offset += n
                n_sequences += 1
            packer.done = []
            if out:
                yield from batches_of(dict(zip(schema.names, map(list, zip(*out)))), schema, DONE_AT_ONCE)

        for b in batches:
            ids_of, texts = b.column("id"), pc.fill_null(b.column("text"), "")
            for some in few_bytes(pc.binary_length(texts).to_numpy(), AT_ONCE):
                tokens, bounds = words.encode(texts[some])
                data, bounds = tokens.tobytes(), (bounds * TOKEN_BYTES).tolist()
                for i, doc in enumerate(ids_of[some].to_pylist()):
                    ids = data[bounds[i]:bounds[i + 1]] + end
                    packer.add((doc, n_rows, len(ids) // TOKEN_BYTES), ids)
                    n_rows += 1
                    if len(packer.done) >= DONE_AT_ONCE:
                        yield from finished()
        packer.drain()
        yield from finished()

    return rows.mapInArrow(run, f"id {id_type.simpleString()}, row bigint, start bigint, length bigint, ids binary, "
                                "doc_tokens bigint, sequence_id bigint, offset bigint")


def with_crc(pieces: DataFrame) -> DataFrame:
    """Pieces with ids_crc32 in place of their ids."""
    return pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


def crc(ids) -> int:
    """The CRC-32 of ids as they stand in a piece."""
    return zlib.crc32(np.asarray(ids, "<u4").tobytes())
