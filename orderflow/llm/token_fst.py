"""Token counts by a compiled finite-state tokenizer.

A byte-level BPE tokenizer is compiled, on demand, into two deterministic
transducers run one after the other:

* the *splitter* reads character classes and marks where the tokenizer's own
  word pieces begin (the classes of all code points are asked of the library
  once, so its Unicode tables are matched exactly);
* the *counter* reads a piece's bytes.  Each transition carries the number of
  tokens by which the count of the prefix grows (it can be negative: a longer
  token may swallow earlier ones).  A state is what the rest of the piece can
  still depend on: the longest suffix that begins some token, with the last
  token and relative count of every cut inside it.  There are finitely many.

That the last token of each prefix can be found this way rests on a property
of BPE: a sequence of tokens is what the merges make of its text exactly if
each two neighbours are what the merges make of theirs.

Texts are cut into chunks; a chunk's *map* turns the state in which it is
entered into the state in which it is left and a count.  After a reset point
(white space that follows other characters always begins a new piece) the
state no longer depends on the entry, so a map is kept as what lies before
the first reset, the count between, and what lies after the last.  Maps
compose associatively, by pairwise (tree) scan.
"""

from __future__ import annotations

import functools
import json
import re
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame

from orderflow.llm.common import keyed

#: Characters in a chunk.
CHUNK = 1 << 16
#: Words, pieces and transitions that a worker remembers (each); beyond, words
#: are counted anew, and transitions are dropped and compiled again.
MEMO = 1_000_000
LETTER, NUMBER, SPACE, OTHER = b"L", b"N", b"W", b"O"
#: Over symbols: classes, "_" for the blank, and the apostrophe and letters of
#: the contractions, which are fixed values of the tokenizer, for themselves.
SPLITTER = re.compile("'(?:s|t|re|ve|m|ll|d)|_?[Lstrevmld]+|_?N+|_?[O']+|[W_]+(?![^W_])|[W_]+")


@functools.cache
def byte_names() -> dict[int, str]:
    """The characters that byte-level vocabularies use for the 256 bytes:
    printable ones stand for themselves, the others follow from U+0100."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(0x100 + i) for i, b in enumerate(rest)}


class CountingTokenizer:
    """The two transducers of one tokenizer file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        pre = spec["pre_tokenizer"] or {}
        if spec["model"]["type"] != "BPE" or spec["normalizer"] or pre.get("type") != "ByteLevel" \
                or pre.get("add_prefix_space") or not pre.get("use_regex") or spec["model"].get("unk_token"):
            raise ValueError("only byte-level BPE without normalizer can be compiled")
        names = {c: b for b, c in byte_names().items()}
        raw = lambda s: bytes(names[c] for c in s)
        merges = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        self.rank = {(raw(a), raw(b)): i for i, (a, b) in enumerate(merges)}
        self.split = {a + b: (a, b) for a, b in self.rank}
        self.made = {a + b: i for (a, b), i in self.rank.items()}
        # tokens that no merges make are never emitted
        self.vocab = {bytes([i]) for i in range(256)} | self.split.keys()
        if {raw(t) for t in spec["model"]["vocab"]} != self.vocab or len(self.split) != len(self.rank):
            raise ValueError("only vocabularies of bytes and their merges can be compiled")
        self.starts = {t[:i] for t in self.vocab for i in range(len(t) + 1)}
        special = [t["content"] for t in spec["added_tokens"]]
        if any(t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"] for t in spec["added_tokens"]):
            raise ValueError("added tokens with options can't be compiled")
        self.special = re.compile("(" + "|".join(map(re.escape, sorted(special, key=len, reverse=True))) + ")") if special else None
        self.classes = self._classes(path)
        white = "".join(chr(c) for c in range(0x110000) if self.classes[c] == SPACE[0])
        self.symbols = _Symbols(self.classes)
        white = re.escape(white)
        self.words = re.compile(f"[{white}]*[^{white}]+|[{white}]+")
        self.reset = re.compile(f"(?<=[^{white}])[{white}]")
        self._pairs: dict[tuple[bytes, bytes], bool] = {}
        self._states: dict[tuple, int] = {}
        self._keys: list[tuple] = []
        self._next: dict[int, tuple[int, int]] = {}
        self.start = self._state(b"", ((None, 0),))
        self.word_counts: dict[str, int] = {}
        self.piece_counts: dict[str, int] = {}

    @staticmethod
    def _classes(path: str) -> bytes:
        """Class of each code point, as the library's own splitter has it.
        Code points that are no letter, number, separator or control in any
        Unicode version (marks, symbols, unassigned) are not asked about."""
        from tokenizers import Tokenizer

        split = Tokenizer.from_file(path).pre_tokenizer.pre_tokenize_str
        table = bytearray(OTHER) * 0x110000
        points = [c for c in range(0x110000) if unicodedata.category(chr(c))[0] in "LNZ" or unicodedata.category(chr(c)) == "Cc"]
        for before, kind in ((b"a", LETTER), (b"1", NUMBER), (b"!", OTHER)):
            # after `before`, a code point of the same class goes on its piece
            for at in range(0, len(points), 500):
                some = points[at:at + 500]
                cuts = {a for _, (a, _) in split("".join(f"\n{before.decode()}{chr(c)}" for c in some))}
                for i, c in enumerate(some):
                    if 3 * i + 2 not in cuts:
                        table[c] = kind[0]
                    elif kind == OTHER and table[c] == OTHER[0]:
                        table[c] = SPACE[0]
        return bytes(table)

    # the splitter

    def pieces(self, text: str) -> list[str]:
        """The pieces of a text, by one pass over its character classes."""
        return [text[m.start():m.end()] for m in SPLITTER.finditer(text.translate(self.symbols))]

    # the counter

    def _fits(self, left: bytes | None, token: bytes) -> bool:
        """Whether the merges leave ``left`` and ``token`` side by side: undo
        the merges of both, latest first; none across the joint may come
        before the one undone."""
        if left is None:
            return True
        key = (left, token)
        known = self._pairs.get(key)
        if known is None:
            known, limit = True, len(self.rank)
            while True:
                if self.rank.get((left, token), limit) < limit:
                    known = False
                    break
                a, b = self.made.get(left, -1), self.made.get(token, -1)
                if a < 0 and b < 0:
                    break
                if a > b:
                    limit, left = a, self.split[left][1]
                else:  # of the same rank the left one was made first
                    limit, token = b + 1, self.split[token][0]
            self._pairs[key] = known
        return known

    def _state(self, suffix: bytes, cuts: tuple) -> int:
        key = (suffix, cuts)
        if key not in self._states:
            self._states[key] = len(self._keys)
            self._keys.append(key)
        return self._states[key]

    def _step(self, state: int, byte: int) -> tuple[int, int]:
        """Compile one transition: the next state, the tokens it adds."""
        suffix, cuts = self._keys[state]  # cuts[-1] is here; cuts[0] lies len(suffix) bytes back
        text = suffix + bytes([byte])
        for size in range(len(text), 0, -1):
            token = text[len(text) - size:]
            if token not in self.vocab:
                continue
            last, count = cuts[len(text) - size]
            if not self._fits(last, token):
                continue
            add = count + 1
            break
        else:
            raise ValueError("the vocabulary lacks a byte")
        back = next(i for i in range(len(text) + 1) if text[i:] in self.starts)
        kept = tuple((t, c - add) for t, c in cuts[back:]) + ((token, 0),)
        return self._state(text[back:], kept), add

    def count_piece(self, piece: str) -> int:
        if len(self._next) >= MEMO:
            self._next, self._states, self._keys, self._pairs = {}, {}, [], {}
            self.start = self._state(b"", ((None, 0),))
        state, total, step = self.start, 0, self._next
        for byte in piece.encode("utf-8", "surrogatepass"):
            key = state << 8 | byte
            known = step.get(key)
            if known is None:
                known = step[key] = self._step(state, byte)
            state, add = known
            total += add
        return total

    def count_word(self, word: str) -> int:
        total, known = 0, self.piece_counts
        for piece in self.pieces(word):
            n = known.get(piece)
            if n is None:
                n = self.count_piece(piece)
                if len(known) < MEMO and len(piece) <= 64:
                    known[piece] = n
            total += n
        if len(self.word_counts) < MEMO and len(word) <= 64:
            self.word_counts[word] = total
        return total

    def count_between(self, text: str) -> int:
        """Tokens of a text that begins and ends at reset points."""
        total, known, missing = 0, self.word_counts.get, []
        for word in self.words.findall(text):
            n = known(word)
            if n is None:
                missing.append(word)
            else:
                total += n
        return total + sum(map(self.count_word, missing))

    # chunks

    def chunk_map(self, chunk: str) -> "ChunkMap":
        first = self.reset.search(chunk)
        if not first:
            return ChunkMap(chunk, None, "")
        end, back = None, 256
        while end is None:  # the last reset, looked for ever further back; the first one always matches
            for m in self.reset.finditer(chunk, max(first.start(), len(chunk) - back)):
                end = m.start()
            back *= 2
        return ChunkMap(chunk[:first.start()], self.count_between(chunk[first.start():end]), chunk[end:])

    def compose(self, a: "ChunkMap", b: "ChunkMap") -> "ChunkMap":
        """First ``a``, then ``b``.  What lies before a chunk's first reset is
        entered in the state that the chunk before leaves, so it joins that
        chunk's tail; the joint may itself hold a reset between the two."""
        if a.count is None and b.count is None:
            return self.chunk_map(a.head + b.head)
        if a.count is None:
            joint = self.chunk_map(a.head + b.head)
            if joint.count is None:
                return ChunkMap(joint.head, b.count, b.tail)
            return ChunkMap(joint.head, joint.count + self.count_between(joint.tail) + b.count, b.tail)
        if b.count is None:
            joint = a.tail + b.head
            return ChunkMap(a.head, a.count, joint)
        return ChunkMap(a.head, a.count + self.count_between(a.tail + b.head) + b.count, b.tail)

    def count(self, text: str) -> int:
        """Tokens of a text, special strings in it counted as one each."""
        if self.special and "<" in text:
            parts = self.special.split(text)
            return sum(self._count(p) for p in parts[::2]) + len(parts) // 2
        return self._count(text)

    def _count(self, text: str, chunk: int = 0) -> int:
        chunk = chunk or CHUNK
        if len(text) <= chunk:
            return self.count_between(text)
        maps = [self.chunk_map(text[i:i + chunk]) for i in range(0, len(text), chunk)]
        while len(maps) > 1:  # neighbours compose pairwise
            odd = maps[-1:] if len(maps) % 2 else []
            maps = [self.compose(a, b) for a, b in zip(maps[::2], maps[1::2])] + odd
        whole = maps[0]
        return self.count_between(whole.head) + (self.count_between(whole.tail) + whole.count if whole.count is not None else 0)


class _Symbols(dict):
    """Symbol of a code point, for str.translate."""

    def __init__(self, classes: bytes):
        self.classes = classes
        self |= {ord(c): c for c in "'stremvld"} | {ord(" "): "_"}

    def __missing__(self, point: int) -> str:
        self[point] = chr(self.classes[point])
        return self[point]


@dataclass
class ChunkMap:
    """``head``: up to the first reset, entered in an open state; ``count``:
    tokens from there to the last reset, None without a reset; ``tail``: from
    the last reset on, which decides the state on leaving."""

    head: str
    count: int | None
    tail: str


@functools.cache
def compiled(path: str) -> CountingTokenizer:
    """One per worker process and file."""
    return CountingTokenizer(path)


def count_tokens(df: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_bytes, n_tokens) for every row, in one narrow pass: no shuffle,
    so a source or text that repeats costs no more than any other row.

    ``tokenizer_path`` must exist on every executor.  Null and empty texts
    have 0 bytes and 0 tokens; texts are never cut; repeated rows come back
    as often as they came; an empty table gives no rows; other columns are
    not read.
    """
    rows = keyed(df, id=id_col, text=text_col)
    schema = pa.schema([("id", rows_type(df, id_col)), ("n_bytes", pa.int64()), ("n_tokens", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = compiled(tokenizer_path)
        for b in batches:
            texts = [t.as_py() or "" for t in b.column("text")]
            yield pa.record_batch([b.column("id"), pa.array([len(t.encode("utf-8", "surrogatepass")) for t in texts], pa.int64()),
                                   pa.array([machine.count(t) for t in texts], pa.int64())], schema=schema)

    return rows.mapInArrow(run, f"id {df.schema[id_col].dataType.simpleString()}, n_bytes bigint, n_tokens bigint")


def rows_type(df: DataFrame, col: str) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(df.schema[col].dataType)
