"""One stream for all captured tables (M5).

The messages of every topic are read once, parsed once, and split by the
table they name.  Each message becomes one row with a struct column per
table, of which one is filled, and a single file sink, partitioned by table,
takes them all: its commit log makes the rows of a batch visible for all
tables at once, so a failure between two tables loses and repeats nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..schemas import WIRE_TABLES
from ..sources.wire import text_schema, typed_fields

#: Partition of messages that name no known table; their text is kept.
UNROUTED = "unrouted"


def routed_schema(tables: dict[str, T.StructType] = WIRE_TABLES) -> T.StructType:
    return T.StructType([T.StructField("raw", T.StringType())]
                        + [T.StructField(name, schema) for name, schema in tables.items()]
                        + [T.StructField("table", T.StringType())])


def route(records: DataFrame, tables: dict[str, T.StructType] = WIRE_TABLES) -> DataFrame:
    """Topic records (``value``) -> one row each, in the column of its table.

    Tombstones (NULL values) have nothing to route and are dropped; messages
    that are no JSON or name another table are ``unrouted``, with their text.
    """
    every = T.StructType([T.StructField("__table", T.StringType())])
    for schema in tables.values():
        for f in text_schema(schema).fields:
            if f.name not in every.names:
                every.add(f)
            elif every[f.name].dataType != f.dataType:
                raise ValueError(f"field {f.name!r} is nested in one table only, or differently")
    out = records.select(F.col("value").cast("string").alias("raw")).where("raw IS NOT NULL")
    out = out.withColumn("__text", F.from_json("raw", every, {"allowSingleQuotes": "false"}))
    named = F.col("__text.__table")
    out = out.withColumn("table", F.when(named.isin(*tables), named).otherwise(F.lit(UNROUTED)))
    # each field is cast once, whatever tables have it, and the structs only put the casts together
    typed = {(f.name, f.dataType): f"f{i}" for i, f in enumerate({(f.name, f.dataType): f for s in tables.values() for f in s.fields}.values())}
    casts = [typed_fields(F.col("__text"), T.StructType([T.StructField(*k)]))[0].alias(c) for k, c in typed.items()]
    out = out.select(F.when(F.col("table") == UNROUTED, F.col("raw")).alias("raw"), *casts, "table")
    columns = [F.when(F.col("table") == name, F.struct(*[F.col(typed[f.name, f.dataType]).alias(f.name) for f in schema.fields])).alias(name)
               for name, schema in tables.items()]
    return out.select("raw", *columns, "table")


def route_stream(records: DataFrame, out_path: str, checkpoint: str, tables: dict[str, T.StructType] = WIRE_TABLES,
                 trigger: dict | None = None) -> StreamingQuery:
    """Start the routing stream: one query, one checkpoint, one commit log."""
    return (route(records, tables).writeStream.format("parquet").partitionBy("table").outputMode("append")
            .option("checkpointLocation", checkpoint).trigger(**(trigger or {"processingTime": "60 seconds"})).start(out_path))


def read_routed(spark: SparkSession, path: str, table: str, tables: dict[str, T.StructType] = WIRE_TABLES) -> DataFrame:
    """The typed rows of one table; only its partition is read."""
    rows = spark.read.schema(routed_schema(tables)).parquet(path).where(F.col("table") == table)
    return rows.select("raw") if table == UNROUTED else rows.select(f"{table}.*")
