"""Sharding by a permutation-filled lookup table.

Every shard has its own order of preference over the slots of a table whose
size is prime: (offset + k * skip) mod size runs through all slots.  The
shards take turns, each claiming the first free slot of its order, until the
table is full, so the slots of any two shards differ by one at most.  A key
goes to the shard that owns the slot of its hash.  When a shard leaves, most
other slots stay with their owners.

DataFrame functions only.  The table's size is a parameter and does not
depend on the data, so the broadcast has a proven bound.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orderflow.llm.common import numbered

#: Slots: a prime, far above the number of shards.
SLOTS = 2053
SHARDS = tuple(f"shard-{i:03d}" for i in range(32))
#: The largest table that is filled (its time grows with the square of the slots) and broadcast.
MOST_SLOTS = 4_099


def hashed(*parts: Column) -> Column:
    """A non-negative hash that other engines can repeat: the first 15 hex
    digits of an MD5.  Null counts as the empty string."""
    text = F.concat_ws(":", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts])
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("bigint")


def _is_prime(n: int) -> bool:
    return n > 1 and all(n % d for d in range(2, int(n ** 0.5) + 1))


def lookup_table(spark: SparkSession, shards: tuple[str, ...] = SHARDS, slots: int = SLOTS) -> DataFrame:
    """(slot, shard, turn): the owner of each slot and the turn it was claimed
    in.  ``shards`` are distinct names; their order is the order of turns."""
    if not shards or len(set(shards)) != len(shards) or None in shards:
        raise ValueError("shards must be distinct names, one at least")
    if not _is_prime(slots) or slots < len(shards) or slots > MOST_SLOTS:
        raise ValueError(f"slots must be a prime from the number of shards to {MOST_SLOTS}")
    m = F.lit(slots).cast("bigint")
    # range(1) keeps the optimizer from folding the fill into the plan
    one = spark.range(1).select(F.transform(F.array(*[F.lit(s) for s in shards]), lambda s: F.struct(
        s.alias("name"), F.pmod(hashed(F.lit("offset"), s), m).alias("offset"),
        (F.pmod(hashed(F.lit("skip"), s), m - 1) + 1).alias("skip"))).alias("shards"), "id")
    # the inverse of skip turns a slot into its place in the shard's order
    one = one.select("id", F.transform("shards", lambda s: F.struct(
        s["name"].alias("name"), s["offset"].alias("offset"), _inverse(s["skip"], slots).alias("inverse"))).alias("shards"))
    start = F.struct(F.sequence(F.col("id"), F.col("id") + slots - 1).alias("free"),
                     F.array().cast("array<struct<slot:bigint,turn:bigint>>").alias("owned"))

    def claim(state: Column, turn: Column) -> Column:
        s = F.element_at(F.col("shards"), (turn % len(shards) + 1).cast("int"))
        order = F.array_min(F.transform(state["free"], lambda slot: F.struct(
            F.pmod((slot - s["offset"] + m) * s["inverse"], m).alias("place"), slot.alias("slot"))))
        taken = order["slot"]
        return F.struct(F.array_remove(state["free"], taken).alias("free"),
                        F.concat(state["owned"], F.array(F.struct(taken.alias("slot"), turn.alias("turn")))).alias("owned"))

    filled = F.aggregate(F.sequence(F.col("id"), F.col("id") + slots - 1), start, claim, lambda state: state["owned"])
    return one.select("shards", F.explode(filled).alias("o")).select(
        F.col("o.slot").alias("slot"),
        F.element_at("shards", (F.col("o.turn") % len(shards) + 1).cast("int"))["name"].alias("shard"),
        F.col("o.turn").alias("turn"))


def _inverse(x: Column, prime: int) -> Column:
    """x ** (prime - 2) mod prime, by squaring (bits from the highest)."""
    p = F.lit(prime).cast("bigint")
    bits = F.array(*[F.lit(int(b)) for b in bin(prime - 2)[2:]])
    return F.aggregate(bits, F.lit(1).cast("bigint"),
                       lambda acc, b: F.pmod(F.pmod(acc * acc, p) * F.when(b == 1, x).otherwise(F.lit(1).cast("bigint")), p))


def place(df: DataFrame, key_col: str, table: DataFrame, slots: int = SLOTS) -> DataFrame:
    """``df`` with slot and shard (with ``_`` behind them as often as it takes
    where ``df`` has columns of those names).

    The key's slot finds its shard in the broadcast table (``slots`` rows, a
    parameter checked against ``MOST_SLOTS``).  Null keys hash like an empty
    string, equal keys always go together, every row comes back once.
    """
    if slots > MOST_SLOTS:
        raise ValueError("the table is too large to broadcast")
    rows, (key_col,) = numbered(df, key_col)
    names = []
    for name in ("slot", "shard"):
        while name in df.columns:
            name += "_"
        names.append(name)
    owner = F.broadcast(table.select("slot", "shard"))
    placed = rows.withColumn("slot", F.pmod(hashed(F.lit("key"), F.col(key_col)), F.lit(slots).cast("bigint"))).join(owner, "slot")
    return placed.select(*rows.columns, "slot", "shard").toDF(*df.columns, *names)
