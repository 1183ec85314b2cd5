"""Mixing sources to target weights by Sainte-Lague apportionment.

Every source has a target in words, split over its shards by their size.  In
a shard the documents stand one after another in seeded order and are cut
into equal blocks.  The blocks of the mix go to the highest Sainte-Lague
quotients share / (2q + 1) of all shards, share being a shard's target in
blocks: an integer quota for each shard.  All blocks of a shard are taken as
often as the quota covers it; the rest are those with the smallest seeded
hashes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderflow.llm.common import keyed, numbered, stored

#: Weights by rank of the source name, repeating.
WEIGHTS = (5, 2, 1)
#: No source is taken more often than this.
MOST_TIMES = 3
#: Words in a block, and blocks in a shard (about).
BLOCK_WORDS = 128
SHARD_BLOCKS = 4096


def words_in(text: Column) -> Column:
    """Runs of characters that are not ASCII white space; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("bigint")


def seeded(seed: str, *parts: Column) -> Column:
    """A hash that other engines can repeat: 15 hex digits of an MD5."""
    text = F.concat_ws(":", F.lit(seed), *[F.coalesce(p.cast("string"), F.lit("")) for p in parts])
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("bigint")


def source_targets(sizes: DataFrame, weights=WEIGHTS, most: int = MOST_TIMES) -> DataFrame:
    """(source, source_size, target): shares by weight of the sum of all
    sizes, none above ``most`` times its source, the excess shared by weight
    among the others.  Sources in order of code points, null last.

    The level at which the excess is used up is found in closed form: sources
    in the order in which they reach their cap, running sums, first rank that
    lies under its cap.  The windows without a key run over one row a source.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    per = per.withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]),
                                                (place % len(weights) + 1).cast("int")))
    per = per.withColumn("cap", most * F.col("source_size").cast("double"))
    order = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    rest = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    total = F.sum("source_size").over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    level = (total - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / F.sum("weight").over(rest)
    per = per.withColumn("level", level)
    free = F.col("level") * F.col("weight") <= F.col("cap")
    # the first source under its cap fixes the level of all that follow
    fixed = F.first(F.when(free, F.col("level")), ignorenulls=True).over(
        order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return per.select("source", "source_size",
                      F.coalesce(F.least(F.col("cap"), fixed * F.col("weight")), F.col("cap")).alias("target"))


def sainte_lague(units: DataFrame, share: str, order: list[str]) -> DataFrame:
    """``units`` with ``quota``: round(sum of shares) seats, dealt to the
    highest quotients share / (2q + 1); ties go by ``order``.

    Rounding each share takes exactly the quotients of 1/2 or more, which
    misses the number of seats by a few.  Only those few are ranked: each
    unit offers its next (or last) quotients, more of them as long as some
    unit has won (or lost) all that it offered.
    """
    units = stored(units.withColumn("quota", F.floor(F.col(share) + 0.5).cast("bigint")), "units")
    sums = units.agg(F.floor(F.sum(share) + 0.5).cast("bigint"), F.sum("quota")).first()
    missing, offers = (sums[0] or 0) - (sums[1] or 0), 4
    if not missing:
        return units
    names = [F.col(c) for c in order]
    while True:
        step = F.explode(F.sequence(F.lit(0), F.lit(offers - 1))).alias("step")
        if missing > 0:
            bids = units.select(share, "quota", *order, step) \
                .withColumn("quotient", F.col(share) / (2 * (F.col("quota") + F.col("step")) + 1))
            won = bids.orderBy(F.col("quotient").desc(), *[c.asc_nulls_last() for c in names], "step").limit(missing)
        else:
            bids = units.select(share, "quota", *order, step).where("step < quota") \
                .withColumn("quotient", F.col(share) / (2 * (F.col("quota") - F.col("step")) - 1))
            won = bids.orderBy("quotient", *[c.desc_nulls_first() for c in names], "step").limit(-missing)
        won = stored(won.groupBy(*order).agg(F.count("*").alias("n")), "seats")
        if (won.agg(F.max("n")).first()[0] or 0) < offers:
            break
        offers *= 4
    won = won.select(*[F.col(c).alias(f"w_{c}") for c in order], "n")
    same = [F.col(c).eqNullSafe(F.col(f"w_{c}")) for c in order]
    on = same[0]
    for c in same[1:]:
        on = on & c
    seats = F.col("quota") + (1 if missing > 0 else -1) * F.coalesce("n", F.lit(0))
    return units.join(won, on, "left").withColumn("quota", seats).drop("n", *[f"w_{c}" for c in order])


def plan_mix(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
             seed: str = "mix", block_words: int = BLOCK_WORDS, shard_blocks: int = SHARD_BLOCKS,
             row_col: str | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The places of all documents in their shards (``end``: words up to their
    ends), of those with words with the shard's words and blocks, and the
    blocks: the words ``from`` ... ``to`` - 1 of a shard, taken ``times``
    times, one more than ``least`` if drawn."""
    if row_col:
        docs = keyed(df, id=id_col, source=source_col, text=text_col, row=row_col)
    else:
        docs = keyed(df, id=id_col, source=source_col, text=text_col).withColumn("row", F.lit(0).cast("bigint"))
    docs = docs.withColumn("digest", F.md5(F.coalesce("text", F.lit(""))))
    small = stored(docs.select("row", "id", "source", words_in(F.col("text")).alias("size"), "digest",
                               seeded(seed, F.col("id"), F.col("digest")).alias("rank")), "sizes")
    shards = F.greatest(F.lit(1).cast("bigint"), F.ceil(F.col("source_size") / (block_words * shard_blocks)))
    targets = stored(source_targets(small).withColumn("shards", shards), "targets") \
        .withColumnRenamed("source", "t_source")
    placed = small.join(targets, F.col("t_source").eqNullSafe(F.col("source"))).drop("t_source") \
        .withColumn("shard", F.pmod("rank", "shards"))
    names = ["source", "shard"]
    run = Window.partitionBy(*names).orderBy("rank", "digest", "id", "row")
    placed = stored(placed.withColumn("end", F.sum("size").over(run.rowsBetween(Window.unboundedPreceding, 0))), "placed")

    units = placed.groupBy(*names).agg(F.sum("size").alias("words"), F.first("target").alias("target"),
                                       F.first("source_size").alias("source_size")).where("words > 0")
    blocks = F.greatest(F.lit(1).cast("bigint"), F.floor(F.col("words") / block_words + 0.5).cast("bigint"))
    # a shard's part of the target, in its own blocks: target * words / source_size / (words / blocks)
    units = sainte_lague(units.withColumn("blocks", blocks).withColumn(
        "share", F.col("target") * F.col("blocks") / F.col("source_size")), "share", names)
    units = units.withColumn("quota", F.least("quota", MOST_TIMES * F.col("blocks")))
    block = units.select(*names, "words", "blocks", F.expr("quota div blocks").alias("times"),
                         (F.col("quota") % F.col("blocks")).alias("extra"),
                         F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1)).alias("block"))
    draw = Window.partitionBy(*names).orderBy(seeded(seed + "-block", F.col("source"), F.col("shard"), F.col("block")), "block")
    block = block.withColumn("least", F.col("times")).withColumn("times", F.col("times") + (F.row_number().over(draw) <= F.col("extra")).cast("bigint")) \
        .withColumn("begin", F.expr("(block * words) div blocks"))
    block = block.withColumn("to", F.expr("((block + 1) * words) div blocks"))
    length = F.col("to") - F.col("begin")
    before = Window.partitionBy(*names).orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    block = block.withColumn("before", F.coalesce(F.sum(F.col("times") * length).over(before), F.lit(0)))
    block = stored(block.select(F.col("source").alias("b_source"), F.col("shard").alias("b_shard"), "words", "blocks",
                                "block", "times", "least", "before", F.col("begin").alias("from"), "to"), "blocks")
    sizes = units.select(F.col("source").alias("u_source"), F.col("shard").alias("u_shard"), "words", "blocks")
    with_size = placed.where("size > 0").join(sizes, F.col("source").eqNullSafe(F.col("u_source")) & (F.col("shard") == F.col("u_shard"))) \
        .drop("u_source", "u_shard")
    return placed, with_size, block


def mix(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        seed: str = "mix", block_words: int = BLOCK_WORDS, shard_blocks: int = SHARD_BLOCKS) -> DataFrame:
    """id, size, source_size, target, taken for every row: how many words of
    the document the mix takes, repeats counted.

    A source is cut into shards by a hash of the rows, as many as its size
    asks for, so a source with a third of all rows is spread like any other.
    No document is taken more than ``MOST_TIMES`` times.  Null and blank
    texts have size 0 and are never taken.  Null sources are one source.
    Repeated rows are separate documents; which of two equal rows comes first
    does not matter.  Reruns over the same rows agree.  An empty table gives
    no rows; no other column is read.
    """
    placed, with_size, block = plan_mix(df, id_col, text_col, source_col, seed, block_words, shard_blocks)
    names = ["source", "shard"]
    # the words taken up to each end of a document: by the block in which it lies
    ends = with_size.select("row", "id", *names, "size", "rank", "digest", "source_size", "target", "end", "words", "blocks",
                            F.explode(F.array(F.struct(F.lit(-1).alias("sign"), (F.col("end") - F.col("size")).alias("p")),
                                              F.struct(F.lit(1).alias("sign"), F.col("end").alias("p")))).alias("e"))
    ends = ends.withColumn("block", F.expr("greatest(0, e.p * blocks - 1) div words")).drop("words", "blocks")
    met = ends.join(
        block.drop("words", "blocks", "least", "to").withColumnRenamed("block", "b_block"),
        F.col("source").eqNullSafe(F.col("b_source")) & (F.col("shard") == F.col("b_shard")) & (F.col("block") == F.col("b_block")))
    words = F.col("e.sign") * (F.col("before") + F.col("times") * (F.col("e.p") - F.col("from")))
    keys = ["row", "id", "size", "source_size", "target", "source", "shard", "end"]
    some = met.groupBy(*keys).agg(F.sum(words).cast("bigint").alias("taken"))
    none = placed.where("size = 0").withColumn("taken", F.lit(0).cast("bigint"))
    out = ["row", "id", "size", "source_size", "target", "taken"]
    return some.select(*out).unionByName(none.select(*out))


def take_mix(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
             **options) -> DataFrame:
    """The mix as documents, with all columns of ``df``: a document comes
    whole as often as all its blocks are taken; of a document of which some
    blocks are taken once more, each run of neighbouring ones comes as a
    document of its own, from its first word to its last with the white space
    between them.  Untaken documents go, null and blank texts among them;
    repeated rows are documents of their own.  An empty table stays empty; the
    columns may have any names."""
    rows, (id_col, text_col, source_col) = numbered(df, id_col, text_col, source_col)
    rows = stored(rows.withColumn("__row", F.monotonically_increasing_id()), "mix-rows")
    _, places, block = plan_mix(rows, id_col, text_col, source_col, row_col="__row", **options)
    begin = F.col("end") - F.col("size")
    spans = places.select("row", "source", "shard", "size", "end", F.explode(F.sequence(
        F.expr("((end - size + 1) * blocks - 1) div words"), F.expr("(end * blocks - 1) div words"))).alias("block"))
    met = spans.join(block.drop("words", "blocks").withColumnRenamed("block", "b_block"),
                     F.col("source").eqNullSafe(F.col("b_source")) & (F.col("shard") == F.col("b_shard")) & (F.col("block") == F.col("b_block")))
    met = met.select("row", "size", "block", "least", (F.col("times") > F.col("least")).alias("once_more"),
                     (F.greatest("from", begin) - begin).alias("lo"), (F.least("to", F.col("end")) - begin).alias("hi"))
    order = Window.partitionBy("row", "once_more").orderBy("block")
    runs = met.withColumn("run", F.col("block") - F.row_number().over(order)).groupBy("row", "once_more", "run") \
        .agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.first("least").alias("least"), F.first("size").alias("size"))
    piece = F.when(F.col("once_more"), F.struct("lo", "hi"))
    taken = runs.groupBy("row").agg(F.first("least").cast("int").alias("__whole"), F.first("size").alias("__size"),
                                    F.sort_array(F.collect_list(piece)).alias("__runs")) \
        .where("__whole > 0 or size(__runs) > 0").withColumnRenamed("row", "__row")
    text = F.col(f"`{text_col}`")
    words = F.regexp_extract_all(text, F.lit(r"([\x20\x09-\x0D]*[^\x20\x09-\x0D]+)"), F.lit(1))  # each with the white space before it

    def cut(all_words, run):
        some = F.concat_ws("", F.slice(all_words, (run["lo"] + 1).cast("int"), (run["hi"] - run["lo"]).cast("int")))
        return F.regexp_replace(some, r"\A[\x20\x09-\x0D]+", "")

    # the array of the words is a lambda's argument, so that it is made once for all runs
    cuts = F.transform(F.array(words), lambda w: F.transform("__runs", lambda r: cut(w, r)))[0]
    once_more = F.when(F.size("__runs") == 0, F.array().cast("array<string>")) \
        .when(F.col("__runs")[0]["hi"] - F.col("__runs")[0]["lo"] == F.col("__size"), F.array(text)).otherwise(cuts)
    copies = F.concat(F.array_repeat(text, F.col("__whole")), once_more)
    met = rows.join(taken, "__row").withColumn("__text", F.explode(copies))
    return met.withColumn(text_col, F.col("__text")).select(*[f"c{i}" for i in range(len(df.columns))]).toDF(*df.columns)
