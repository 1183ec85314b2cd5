"""Prefix trie of conversations, by burst tries.

A conversation is a sequence of turn ids (a hash of role and text); equal
sequences are one, with the number of conversations as its weight.  Sequences
stand in *containers* under a trie head, the prefix they share.  A container
of more than ``MOST_SUFFIXES`` sequences bursts: its head becomes a node of
its own, and each sequence moves to the container of the head that is longer
by its next turn id.  When no container is too large, each shard sorts the
sequences of its containers and sweeps them once: a stack holds the open
nodes of the current sequence, and what two neighbours do not share is closed.

Burst heads get their subtree's sums from the tops of the containers below
them: a sequence carries the heads it passed, so one shuffle sums all levels.
A round of bursting costs one pass over the sequences that are still in
containers too large; there are as many rounds as turns that more than
``MOST_SUFFIXES`` different conversations share.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderflow.llm.common import keyed, stored

#: Sequences that a container may hold.
MOST_SUFFIXES = 256
#: Turns that the heads of a group of conversations may lend to each other.
GROUP, MOST_SHARED = 5, 9
#: Bytes of joined conversation ids that travel as one value.
PART_BYTES = 1 << 14
NO_MEMBERS = hashlib.sha256(b"").hexdigest()
BIG = "bigint"


def turn_sequences(df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                   text_col: str = "text") -> DataFrame:
    """(conv_id, seq): each conversation's turns in order, as (id, n): 128
    bits of a hash of role and text, and the text's bytes.

    Null turn numbers come first; equal ones are ordered by role, then by the
    turn's id.  Null roles and texts count as empty.  Rows without a
    conversation id belong to none.  A conversation's ids must fit in a task
    (some 60 bytes a turn; the texts stay behind).
    """
    rows = keyed(df, conv_id=conv_col, turn=turn_col, role=role_col, text=text_col).where("conv_id IS NOT NULL")
    role, text = F.coalesce(F.col("role").cast("string"), F.lit("")), F.coalesce(F.col("text").cast("string"), F.lit(""))
    turn_id = F.left(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256), F.lit(32))
    rows = rows.select(F.col("conv_id").cast(BIG).alias("conv_id"), F.struct("turn", role.alias("role"), turn_id.alias("id"),
                                           F.octet_length(text).cast(BIG).alias("n")).alias("t"))
    return rows.groupBy("conv_id").agg(F.transform(F.sort_array(F.collect_list("t")), lambda t: F.struct(t["id"], t["n"])).alias("seq"))


def share_first_turns(seqs: DataFrame, group: int = GROUP, most: int = MOST_SHARED) -> DataFrame:
    """Conversations with common beginnings: of conversation c, the first h
    turns are those of conversation c - c % ``group`` (none if there is no such
    conversation), h = crc32(c) % ``most``; its own turns follow after its
    first h."""
    base = F.col("conv_id") - F.col("conv_id") % group
    heads = seqs.select(F.col("conv_id").alias("head_id"), F.slice("seq", 1, most - 1).alias("head"))
    rows = seqs.withColumn("h", (F.crc32(F.col("conv_id").cast("string").cast("binary")) % most).cast("int")) \
        .join(heads, base == F.col("head_id"), "left")
    none = F.slice("seq", 1, 0)
    seq = F.concat(F.slice(F.coalesce("head", none), F.lit(1), F.col("h")),
                   F.slice("seq", F.col("h") + 1, F.greatest(F.size("seq") - F.col("h"), F.lit(0))))
    return rows.select("conv_id", seq.alias("seq"))


def _joined_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by (key, conv_id): the ids of each key, comma-joined, in
    parts of PART_BYTES, with each part's first id."""
    key, first, ids, size = None, None, [], 0
    done: list[tuple] = []
    names = ["key", "first", "ids"]

    def flush() -> pa.RecordBatch:
        out = pa.record_batch([pa.array(c) for c in zip(*done)], names=names)
        done.clear()
        return out

    for b in batches:
        for k, c in zip(b.column("key").to_pylist(), b.column("conv_id").to_pylist()):
            if k != key or size >= PART_BYTES:
                if ids:
                    done.append((key, first, ",".join(ids)))
                key, first, ids, size = k, c, [], 0
                if len(done) >= 1024:
                    yield flush()
            ids.append(str(c))
            size += len(ids[-1]) + 1
    if ids:
        done.append((key, first, ",".join(ids)))
    if done:
        yield flush()


def _hashed_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of parts sorted by (key, first): SHA-256 of each key's parts, joined."""
    key, state = None, None
    for b in batches:
        done = []
        for k, part in zip(b.column("key").to_pylist(), b.column("ids").to_pylist()):
            if k != key:
                if state is not None:
                    done.append((key, state.hexdigest()))
                key, state = k, hashlib.sha256(part.encode())
            else:
                state.update(b"," + part.encode())
        if done:
            yield pa.record_batch([pa.array(c) for c in zip(*done)], names=["key", "ends"])
    if state is not None:
        yield pa.record_batch([pa.array([key]), pa.array([state.hexdigest()])], names=["key", "ends"])


def hashed_members(members: DataFrame) -> DataFrame:
    """(key, ends): SHA-256 of the ``conv_id`` of each ``key``, ascending and
    comma-joined.  Ids are joined to parts where they lie after a range
    shuffle, so a key with very many members is cut over tasks, and only its
    parts meet, one by one."""
    n = int(members.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = members.repartitionByRange(n, "key", "conv_id").sortWithinPartitions("key", "conv_id") \
        .mapInArrow(_joined_ids, "key string, first bigint, ids string")
    return parts.repartition("key").sortWithinPartitions("key", "first").mapInArrow(_hashed_parts, "key string, ends string")


def _longer(head: Column, turn_id: Column) -> Column:
    """The head that is longer by one turn."""
    return F.left(F.sha2(F.concat(head, turn_id), 256), F.lit(32))


def burst(sequences: DataFrame, most: int = MOST_SUFFIXES) -> tuple[DataFrame, DataFrame | None]:
    """Sequences (key, seq, copies, conv_id, head, depth, path), all in the
    container of the empty head, dealt to containers of at most ``most``:
    their head, its depth (turns) and path (the heads that burst above it); and
    the burst heads as nodes: head, path, depth, conv_id, n_convs, own (the
    tokens saved at the node itself), end_key."""
    open_, settled, nodes = sequences, [], []
    while True:
        large = open_.groupBy("head").count().where(F.col("count") > most).select("head", F.lit(True).alias("large"))
        if large.isEmpty():
            settled.append(open_)
            break
        tagged = stored(open_.join(large, "head", "left").withColumn("large", F.coalesce("large", F.lit(False))), "containers")
        settled.append(tagged.where("NOT large").drop("large"))
        bursting = tagged.where("large").drop("large")
        here = F.when(F.col("depth") > 0, F.try_element_at("seq", F.col("depth"))["n"]).otherwise(0)
        nodes.append(stored(bursting.groupBy("head").agg(
            F.any_value("path").alias("path"), F.max("depth").alias("depth"), F.min("conv_id").alias("conv_id"),
            F.sum("copies").alias("n_convs"), F.max(here).alias("n"),
            F.max(F.when(F.size("seq") == F.col("depth"), F.col("key"))).alias("end_key"))
            .withColumn("own", (F.col("n_convs") - 1) * F.col("n")).drop("n"), "burst-heads"))
        next_id = F.element_at("seq", F.col("depth") + 1)["id"]
        open_ = bursting.where(F.size("seq") > F.col("depth")).select(
            "key", "seq", "copies", "conv_id", _longer(F.col("head"), next_id).alias("head"), (F.col("depth") + 1).alias("depth"),
            F.concat("path", F.array("head")).alias("path"))
    return reduce(DataFrame.unionByName, settled), reduce(DataFrame.unionByName, nodes) if nodes else None


_SWEPT = pa.schema([("depth", pa.int64()), ("conv_id", pa.int64()), ("parent_conv_id", pa.int64()), ("n_convs", pa.int64()),
                    ("n_children", pa.int64()), ("n_leaves", pa.int64()), ("saved_tokens", pa.int64()), ("end_key", pa.string()),
                    ("path", pa.list_(pa.string())), ("top", pa.bool_())])
_SWEPT_DDL = ("depth bigint, conv_id bigint, parent_conv_id bigint, n_convs bigint, n_children bigint, n_leaves bigint, "
              "saved_tokens bigint, end_key string, path array<string>, top boolean")


class _Node:
    __slots__ = ("bytes", "conv", "n", "leaves", "saved", "children", "end_key")

    def __init__(self, n_bytes: int):
        self.bytes, self.conv, self.n, self.leaves, self.saved, self.children, self.end_key = n_bytes, None, 0, 0, 0, [], None

    def add(self, conv: int, n: int) -> None:
        self.conv = conv if self.conv is None else min(self.conv, conv)
        self.n += n


class _Sweep:
    """Nodes of one container after the other.  A node's children wait in it
    until its smallest member is known; a container bounds their number."""

    def __init__(self) -> None:
        self.head, self.depth, self.path, self.ids, self.open = None, 0, None, [], []
        self.done: list[tuple] = []

    def _close(self) -> None:
        node, depth = self.open.pop(), self.depth + len(self.open)
        node.leaves = node.leaves or 1
        node.saved += (node.n - 1) * node.bytes
        for c, at in ((c, depth + 1) for c in node.children):
            self.done.append((at, c.conv, node.conv, c.n, len(c.children), c.leaves, c.saved, c.end_key, None, False))
        node.children = [None] * len(node.children)
        if self.open:
            parent = self.open[-1]
            parent.add(node.conv, node.n)
            parent.leaves += node.leaves
            parent.saved += node.saved
            parent.children.append(node)
        else:
            self.done.append((depth, node.conv, None, node.n, len(node.children), node.leaves, node.saved, node.end_key, self.path, True))

    def close(self, shared: int = 0) -> None:
        """Close the open nodes below the first ``shared``."""
        while len(self.open) > shared:
            self._close()

    def add(self, head: str, depth: int, path: list, ids: list[str], sizes: list[int], key: str, conv: int, copies: int) -> None:
        if head != self.head:
            self.close()
            self.head, self.depth, self.path = head, depth, path
            self.open.append(_Node(sizes[depth - 1] if depth else 0))
        else:
            shared, most = depth, min(len(ids), len(self.ids))
            while shared < most and ids[shared] == self.ids[shared]:
                shared += 1
            self.close(shared - depth + 1)
        for n in sizes[depth + len(self.open) - 1:]:
            self.open.append(_Node(n))
        self.open[-1].add(conv, copies)
        self.open[-1].end_key = key
        self.ids = ids


def _sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sweep = _Sweep()

    def batch() -> pa.RecordBatch:
        columns = list(zip(*sweep.done))
        sweep.done = []
        return pa.record_batch([pa.array(c, f.type) for c, f in zip(columns, _SWEPT)], schema=_SWEPT)

    for b in batches:
        columns = [b.column(c).to_pylist() for c in ("head", "depth", "path", "ids", "sizes", "key", "conv_id", "copies")]
        for row in zip(*columns):
            sweep.add(*row)
            if len(sweep.done) >= 8192:
                yield batch()
    sweep.close()
    if sweep.done:
        yield batch()


def trie(conversations: DataFrame, most: int = MOST_SUFFIXES) -> DataFrame:
    """A row per node of the trie of ``conversations`` (conv_id, seq): conv_id
    (smallest member), depth, parent_conv_id (null at the root), n_convs,
    n_children, n_leaves (childless nodes at and below it), saved_tokens (at
    and below it, each node's other members times the bytes of its last text),
    ends_sha256 (of the ids of the conversations that end at it).

    Conversations without turns are members of the root only; equal ones share
    all nodes; without conversations there are no rows.
    """
    ids = F.array_join(F.transform("seq", lambda t: t["id"]), "")
    members = stored(conversations.withColumn("key", F.sha2(ids, 256)), "conversations")
    sequences = members.groupBy("key").agg(F.any_value("seq").alias("seq"), F.count(F.lit(1)).alias("copies"),
                                           F.min("conv_id").alias("conv_id"))
    sequences = stored(sequences.withColumn("head", F.lit("")).withColumn("depth", F.lit(0))
                       .withColumn("path", F.array().cast("array<string>")), "sequences")
    ends = hashed_members(members.select("key", "conv_id"))
    settled, heads = burst(sequences, most)
    sorted_ = settled.select("head", "depth", "path", F.transform("seq", lambda t: t["id"]).alias("ids"),
                             F.transform("seq", lambda t: t["n"]).alias("sizes"), "key", "conv_id", "copies") \
        .repartition("head").sortWithinPartitions("head", "ids")
    swept = stored(sorted_.mapInArrow(_sweep, _SWEPT_DDL), "swept")
    measures = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "end_key"]
    nodes = swept
    if heads is not None:
        tops = swept.where("top")
        zero = F.lit(0).cast(BIG)
        below = tops.select(F.posexplode("path").alias("i", "head"), F.size("path").alias("levels"), "n_leaves", "saved_tokens") \
            .select("head", "n_leaves", "saved_tokens", (F.col("i") + 1 == F.col("levels")).cast(BIG).alias("child"))
        own = heads.select(F.posexplode(F.concat("path", F.array("head"))).alias("i", "head"), F.size("path").alias("levels"), "own") \
            .select("head", zero.alias("n_leaves"), F.col("own").alias("saved_tokens"),
                    (F.col("i") + 1 == F.col("levels")).cast(BIG).alias("child"))
        sums = below.unionByName(own).groupBy("head").agg(F.sum("child").alias("n_children"), F.sum("n_leaves").alias("n_leaves"),
                                                          F.sum("saved_tokens").alias("saved_tokens"))
        parent = F.try_element_at("path", F.lit(-1)).alias("parent")
        burst_nodes = heads.join(sums, "head").select(
            parent, F.col("depth").cast(BIG).alias("depth"), "conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "end_key")
        high = burst_nodes.unionByName(tops.select(parent, *[c for c in measures if c != "parent_conv_id"]))
        above = heads.select(F.col("head").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
        nodes = swept.where("NOT top").select(*measures).unionByName(high.join(above, "parent", "left").select(*measures))
    return nodes.join(ends.withColumnRenamed("key", "end_key"), "end_key", "left").select(
        *measures[:-1], F.coalesce("ends", F.lit(NO_MEMBERS)).alias("ends_sha256"))
