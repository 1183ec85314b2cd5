"""Decoding change events from their wire form.

* ``parse_json_column`` – tolerant JSON decode of a text column against a
  declared schema: one parse with every scalar as text, then lenient casts, so a
  bad field is NULL and a malformed message is an all-NULL row (removed later
  by the key filter) instead of a failed batch.
* ``parse_change_events`` – the same over Kafka-shaped records (A2).
* ``unwrap_envelope`` – flattens a before/after change envelope into the
  after-image plus ``__op``, ``__table``, ``__ts_ms`` and ``__deleted`` (A11);
  ``parse_envelopes`` does so from their JSON text.
* ``read_json_lines`` / ``read_processed`` – file scans of the sink (A6).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.casts import lenient_cast
from ..schemas import ORDERS_PROCESSED, ORDERS_WIRE


_NESTED = (T.StructType, T.ArrayType, T.MapType)
#: Lines with single quotes are no JSON for the reader of the warehouse either.
_JSON = {"mode": "PERMISSIVE", "allowSingleQuotes": "false"}
#: Text that begins with a letter, a digit or a double quote is neither an object nor a list of objects.
_NO_OBJECT = r'^[A-Za-z0-9"]'


def text_schema(schema: T.StructType) -> T.StructType:
    """The fields of ``schema``, scalars as text: what one parse reads."""
    return T.StructType([T.StructField(f.name, f.dataType if isinstance(f.dataType, _NESTED) else T.StringType())
                         for f in schema.fields])


def typed_fields(text: Column, schema: T.StructType) -> list[Column]:
    """The typed columns of a struct of ``text_schema(schema)``: numbers are
    read from text too, an integer may have a zero fraction or an exponent;
    what does not fit (a true fraction, a boolean) is NULL."""
    return [(text.getField(f.name) if isinstance(f.dataType, _NESTED) else lenient_cast(text.getField(f.name), f.dataType)).alias(f.name)
            for f in schema.fields]


def _parsed(text: Column, schema: T.StructType) -> Column:
    """``from_json`` of text that can be an object.  Plain text, numbers and
    words (``null`` too) have no fields; the parser would find that out by an
    exception, which costs more than a good line."""
    return F.when(~text.rlike(_NO_OBJECT), F.from_json(text, schema, _JSON))


def parse_json_column(df: DataFrame, value_col: str, schema: T.StructType,
                      keep: list[str] | None = None) -> DataFrame:
    """Parse ``value_col`` (JSON text) into the typed columns of ``schema``.

    The text is parsed once, every scalar as text (nested values of a text
    field as JSON), and cast leniently; explicit nulls cost no more than
    omitted fields.  Text that is no JSON object gives an all-NULL row; of a
    repeated key the last value counts.  ``from_json`` only makes the fields
    selected later, so column pruning reaches into the parser.
    """
    parsed = _parsed(F.col(value_col), text_schema(schema))
    out = df.select(*(keep or []), parsed.alias("__text"))
    return out.select(*(keep or []), *typed_fields(F.col("__text"), schema))


def parse_change_events(records: DataFrame, schema: T.StructType = ORDERS_WIRE,
                        keep: list[str] | None = None) -> DataFrame:
    """Kafka-shaped records (``value`` as text or bytes) -> typed wire rows.

    A tombstone (NULL value) becomes an all-NULL row, which the change-type
    filter removes.  ``schema`` selects the table (orders by default), so the
    same decoder serves every captured table.
    """
    if isinstance(records.schema["value"].dataType, T.BinaryType):
        records = records.withColumn("value", F.col("value").cast("string"))
    return parse_json_column(records, "value", schema, keep)


def _envelope_row(envelope_side: Column, schema: T.StructType) -> list[Column]:
    return [envelope_side.getField(f.name) for f in schema.fields]


def unwrap_envelope(events: DataFrame, row_schema: T.StructType) -> DataFrame:
    """Flatten change envelopes ``(before, after, op, ts_ms, source)``.

    Rules of the flattening transform the reference configures: the
    after-image is the row; a delete is rewritten to its before-image with
    ``__deleted = 'true'``; ``op``, ``source.table`` and ``ts_ms`` are added
    as ``__op``, ``__table``, ``__ts_ms``; a tombstone (NULL envelope) is
    kept as an all-NULL row.
    """
    is_delete = F.col("op") == F.lit("d")
    out = []
    for f in row_schema.fields:
        out.append(F.when(is_delete, F.col("before").getField(f.name))
                    .otherwise(F.col("after").getField(f.name)).alias(f.name))
    out += [
        F.col("op").alias("__op"),
        F.col("source").getField("table").alias("__table"),
        F.col("ts_ms").alias("__ts_ms"),
        F.when(F.col("op").isNull(), F.lit(None).cast("string"))
         .otherwise(F.when(is_delete, F.lit("true")).otherwise(F.lit("false"))).alias("__deleted"),
    ]
    return events.select(*out)


def parse_envelopes(records: DataFrame, row_schema: T.StructType, value_col: str = "value",
                    keep: list[str] | None = None) -> DataFrame:
    """Change envelopes as JSON text, flattened like :func:`unwrap_envelope`.

    The text is parsed once, scalars as text, and cast leniently; a row's
    fields come from ``after``, or ``before`` for a delete.  A NULL or
    malformed envelope is kept as an all-NULL row.
    """
    row = text_schema(row_schema)
    text = T.StringType()
    envelope = T.StructType([T.StructField("before", row), T.StructField("after", row), T.StructField("op", text),
                             T.StructField("ts_ms", text),
                             T.StructField("source", T.StructType([T.StructField("table", text)]))])
    e = F.from_json(F.col(value_col).cast("string"), envelope, _JSON).alias("__e")
    out = records.select(*(keep or []), e).select(*(keep or []), "__e.*")
    image = F.when(F.col("op") == "d", F.col("before")).otherwise(F.col("after"))
    out = out.select(*(keep or []), image.alias("__row"), "op", lenient_cast(F.col("ts_ms"), T.LongType()).alias("ts_ms"), "source")
    return out.select(*(keep or []), *typed_fields(F.col("__row"), row_schema), F.col("op").alias("__op"),
                      F.col("source.table").alias("__table"), F.col("ts_ms").alias("__ts_ms"),
                      F.when(F.col("op") == "d", F.lit("true")).when(F.col("op").isNotNull(), F.lit("false")).alias("__deleted"))


def to_envelope(flat: DataFrame, row_schema: T.StructType) -> DataFrame:
    """Inverse of :func:`unwrap_envelope` for a typed flat feed (tests and
    the derived fixture): deletes carry a before-image, other changes an
    after-image, a NULL ``__op`` is a tombstone."""
    row = F.struct(*[F.col(f.name) for f in row_schema.fields])
    null_row = F.lit(None).cast(row_schema)
    op = F.col("__op")
    return flat.select(
        F.when(op == "d", row).otherwise(null_row).alias("before"),
        F.when(op.isin("c", "u", "r"), row).otherwise(null_row).alias("after"),
        op.alias("op"),
        F.when(op.isNull(), F.lit(None).cast("bigint")).otherwise(F.col("__ts_ms")).alias("ts_ms"),
        F.when(op.isNull(), F.lit(None).cast("struct<table:string>"))
         .otherwise(F.struct(F.col("__table").alias("table"))).alias("source"),
    )


def read_json_lines(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Scan a folder of NDJSON part files with the tolerant decoder.

    Reading the folder (not a glob of part files) lets Spark honour a
    streaming file sink's commit log, so half-written files are skipped.
    """
    return parse_json_column(spark.read.text(path), "value", schema)


def read_processed(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """The stream job's output folder as ``ORDERS_PROCESSED`` rows."""
    if fmt == "json":
        return read_json_lines(spark, path, ORDERS_PROCESSED)
    return spark.read.schema(ORDERS_PROCESSED).parquet(path)


def processed_as_json_lines(processed: DataFrame) -> DataFrame:
    """The sink's NDJSON line of each processed row (column ``value``)."""
    return processed.select(F.to_json(F.struct(*[F.col(f.name) for f in ORDERS_PROCESSED.fields]))
                            .alias("value"))
