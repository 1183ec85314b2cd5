"""Exact duplicates by progressive refinement.

Texts are compared after deleting ASCII white space.  Three passes, each only
over what the one before left open: length groups, then a hash of the first
characters within a length, then SHA-256 of the whole text within a prefix
group.  A row alone in its group at any pass is settled.  The prefix hash
takes in the length, so counting by it alone needs no rows of one length
together: a length that a third of all rows have is counted in every task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderflow.llm.common import keyed, numbered, stored

WHITE_SPACE = r"[\x20\x09-\x0D]+"
#: Normalised characters in the prefix hash.
PREFIX_CHARS = 256


def normalised(text: Column) -> Column:
    """The text without ASCII white space; null counts as empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), WHITE_SPACE, "")


def exact_groups(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 digest_all: bool = False, row_col: str | None = None) -> DataFrame:
    """A row for each input row: row (its number), id, keep_row, keep_id,
    group_size, kept, sha256.

    Of equal texts the row with the most code points in the original text
    stays, then the smallest id (null ids last), then the first row.  Rows
    that repeat id and text are separate rows of one group: one is kept.
    Null texts equal empty and blank ones.  ``sha256`` is null where an
    earlier pass settled the row, unless ``digest_all`` asks for the digest
    of every row.  ``row_col`` names a column that numbers the rows already.
    An empty table gives no rows; other columns are not read, whatever their
    names.
    """
    if row_col:
        texts = keyed(df, id=id_col, text=text_col, row=row_col)
    else:
        texts = keyed(df, id=id_col, text=text_col).withColumn("row", F.monotonically_increasing_id())
    norm = normalised(F.col("text"))
    first = stored(texts.select("row", "id", F.length(F.coalesce("text", F.lit(""))).alias("points"), norm.alias("n"))
                   .select("row", "id", "points", F.length("n").alias("len"),
                           F.xxhash64(F.length("n"), F.substring("n", 1, PREFIX_CHARS)).alias("prefix")), "lengths")

    read = texts
    if not digest_all:
        # the open lengths and prefixes are written, so that the joins with them need no rows of a hot one together
        lengths = stored(first.groupBy("len").agg(F.count("*").alias("n")).where("n > 1").select("len"), "open-lengths")
        prefixes = stored(first.join(lengths, "len", "left_semi").groupBy("prefix")
                          .agg(F.count("*").alias("n")).where("n > 1").select("prefix"), "open-prefixes")
        read = texts.join(first.join(prefixes, "prefix", "left_semi").select("row"), "row", "left_semi")
    whole = read.select("row", F.sha2(norm, 256).alias("sha256"))
    rows = stored(first.join(whole, "row", "left"), "digests")

    group = ["len", "prefix", "sha256"]
    stays = F.min(F.struct((-F.col("points")).alias("fewer"), F.col("id").isNull().alias("no_id"), "id", "row"))
    groups = rows.where("sha256 is not null").groupBy(*group) \
        .agg(F.count("*").alias("size"), stays.alias("stays")).where("size > 1") \
        .select("sha256", "size", F.col("stays.id").alias("k_id"), F.col("stays.row").alias("k_row"))
    return rows.join(groups, "sha256", "left").select(
        "row", "id", F.coalesce("k_row", "row").alias("keep_row"),
        F.when(F.col("k_row").isNull(), F.col("id")).otherwise(F.col("k_id")).alias("keep_id"),
        F.coalesce("size", F.lit(1).cast("bigint")).alias("group_size"),
        (F.coalesce("k_row", "row") == F.col("row")).alias("kept"), "sha256")


def drop_exact_copies(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``df`` without the rows that :func:`exact_groups` drops, with all its
    columns, whatever their names: null, empty and blank texts are one group,
    of which one row stays, as of repeated rows.  An empty table stays empty."""
    rows, (id_col, text_col) = numbered(df, id_col, text_col)
    rows = stored(rows.withColumn("row", F.monotonically_increasing_id()), "exact-rows")
    kept = exact_groups(rows, id_col, text_col, row_col="row").where("kept").select("row")
    return rows.join(kept, "row", "left_semi").drop("row").toDF(*df.columns)
