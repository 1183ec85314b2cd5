"""Latest state and hourly KPIs kept by streams.

Two forms, both with plain Spark files and Spark's own commit logs:

* :func:`state_stream` appends the top rows of each micro-batch as Parquet,
  in a folder per stream and batch, and the state is ``latest_rows`` over the
  folder: max is associative and commutative, so late, repeated and
  out-of-order events converge to the batch result.  A replayed batch
  overwrites its own folder.
* :func:`metric_changes_stream` keeps each order's latest rows in the state
  store and emits what an event changes, the new rows with +1 and the rows
  that they replace with -1; :func:`metrics_of_changes` sums them by hour, as
  a stream (update mode) or a batch, so that an order moving to another
  status leaves its old count.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..functions.money import pct, round2_double
from ..functions.times import epoch_ms_of, ntz_from_epoch_ms
from ..operators.latest import latest_rows
from ..plans.marts import fct_order_metrics, state_columns
from ..plans.staging import stg_orders
from ..schemas import ORDER_STATUSES, STG_ORDERS

STREAM, BATCH = "__stream", "__batch"
STATE_FILES = T.StructType(STG_ORDERS.fields + [T.StructField(STREAM, T.StringType()), T.StructField(BATCH, T.LongType())])


def append_latest(processed_batch: DataFrame, batch_id: int, root: str, stream: str,
                  strict_timestamps: bool = True) -> None:
    """Write the rows of a batch that are the latest of their orders in it.
    ``stream`` is the checkpoint's own id: batch numbers of another one name
    other folders, so a new checkpoint on an old root overwrites nothing."""
    # a batch is read from its files: the group limit in front of the exchange cuts hot orders down
    top = latest_rows(stg_orders(processed_batch, strict_timestamps), ["order_id"], "processed_at")
    top.write.mode("overwrite").parquet(f"{root}/{STREAM}={stream}/{BATCH}={batch_id}")


def read_state(spark: SparkSession, root: str) -> DataFrame:
    """The fact (``FCT_ORDERS`` columns) over all streams that wrote to ``root``.

    Tied events stay, as often as one stream delivered them; a stream that
    read the same events again, under a new checkpoint, adds none.
    """
    columns = STG_ORDERS.names
    top = latest_rows(spark.read.schema(STATE_FILES).parquet(root).drop(BATCH), ["order_id"], "processed_at")
    times = top.groupBy(*columns, STREAM).count().groupBy(*columns).agg(F.max("count").alias("__n"))
    rows = times.withColumn("__i", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("__n")))).select(*columns)
    return state_columns(rows)


def read_metrics(spark: SparkSession, root: str) -> DataFrame:
    return fct_order_metrics(read_state(spark, root))


def state_stream(processed_stream: DataFrame, root: str, checkpoint: str, trigger: dict | None = None,
                 strict_timestamps: bool = True) -> StreamingQuery:
    """Keep the state under ``root`` up to date with a stream of processed
    change rows."""
    def take(batch: DataFrame, batch_id: int) -> None:
        # Spark writes the stream's id into a new checkpoint before the first batch
        lines = batch.sparkSession.read.text(f"{checkpoint}/metadata").collect()
        append_latest(batch, batch_id, root, json.loads(lines[0][0])["id"], strict_timestamps)

    return (processed_stream.writeStream.foreachBatch(take)
            .option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"processingTime": "60 seconds"}))
            .start())


# What an order's row adds to its hour.
CHANGE = T.StructType([
    T.StructField("hour_ms", T.LongType()), T.StructField("status", T.StringType()),
    T.StructField("cents", T.LongType()), T.StructField("sign", T.IntegerType()),
])
_STATE = T.StructType([T.StructField("orders", T.BinaryType())])
#: Neighbouring order ids that share a state row: a call of the state function
#: costs as much as thousands of events do.
GROUP_ORDERS = 4096
_HELD = pa.schema([("order_id", pa.int64()), ("at", pa.int64()), ("hour_ms", pa.int64()), ("status", pa.string()), ("cents", pa.int64())])
_HELD_TYPES = {"order_id": "int64", "at": "int64", "hour_ms": "Int64", "status": object, "cents": "Int64"}


def _latest(rows: pd.DataFrame) -> pd.DataFrame:
    return rows[rows["at"] == rows.groupby("order_id")["at"].transform("max")]


def _replace_latest(key: tuple, batches: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
    """A group of orders: the latest rows of a batch against those held, all
    orders at once.  The state is an Arrow table of the latest rows."""
    if state.exists:
        held = pa.ipc.open_stream(bytes(state.get[0])).read_all().to_pandas(types_mapper={pa.int64(): pd.Int64Dtype()}.get)
    else:
        held = pd.DataFrame(columns=_HELD.names)
    held, new = held.astype(_HELD_TYPES), None
    for b in batches:
        b = b[_HELD.names].astype(_HELD_TYPES)
        new = _latest(b if new is None else pd.concat([new, b], ignore_index=True))
    if new is None or not len(new):
        return
    before = held["order_id"].map(new.groupby("order_id")["at"].max())  # the new time, where the batch has the order
    known = new["order_id"].map(held.groupby("order_id")["at"].max())
    gone, come = (before > held["at"]).to_numpy(bool), ~(known > new["at"]).to_numpy(bool)
    kept = pa.RecordBatch.from_pandas(pd.concat([held[~gone], new[come]], ignore_index=True), _HELD, preserve_index=False)
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, _HELD) as out:
        out.write_batch(kept)
    state.update((sink.getvalue().to_pybytes(),))
    changes = pd.concat([held[gone].assign(sign=-1), new[come].assign(sign=1)], ignore_index=True)
    if len(changes):
        yield changes[CHANGE.names]


def metric_changes(processed: DataFrame, strict_timestamps: bool = True) -> DataFrame:
    """A stream of processed rows -> what each adds to the hours' sums (append
    mode).  State: for every order its latest event time and tied rows, a row
    per ``GROUP_ORDERS`` neighbouring orders."""
    stg = stg_orders(processed, strict_timestamps).where(F.col("processed_at").isNotNull())
    rows = stg.select("order_id", epoch_ms_of(F.col("processed_at")).alias("at"), epoch_ms_of(F.col("created_at")).alias("created"), "status",
                      (F.col("total_amount") * 100).cast("bigint").alias("cents"))
    rows = rows.select(F.floor(F.col("order_id") / GROUP_ORDERS).alias("group"), "order_id", "at",
                       (F.col("created") - F.pmod("created", F.lit(3_600_000))).alias("hour_ms"), "status", "cents")
    return rows.groupBy("group").applyInPandasWithState(_replace_latest, CHANGE, _STATE, "append", "NoTimeout")


def metric_changes_stream(processed: DataFrame, out_path: str, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """Write the changes to a file sink, whose log makes them exactly-once."""
    return (metric_changes(processed).writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"processingTime": "60 seconds"})).start(out_path))


def changes_stream(spark: SparkSession, path: str) -> DataFrame:
    return spark.readStream.schema(CHANGE).parquet(path)


def metrics_of_changes(changes: DataFrame) -> DataFrame:
    """Hourly KPIs (columns and rounding of ``fct_order_metrics``) of changes,
    streamed or not: sums that retract what a later event replaces.  An hour
    that has lost all its orders stays with ``total_orders`` 0."""
    sign, cents = F.col("sign"), F.col("cents")
    live = F.col("status") != "cancelled"
    net = F.when(live, cents).otherwise(F.lit(0))
    sums = changes.groupBy("hour_ms").agg(
        F.sum(sign).cast("bigint").alias("total_orders"),
        *[F.sum(F.when(F.col("status") == s, sign).otherwise(0)).cast("bigint").alias(f"{s}_orders") for s in ORDER_STATUSES],
        F.sum(sign * F.coalesce(cents, F.lit(0))).alias("gross"), F.sum(F.when(cents.isNotNull(), sign)).alias("n"),
        F.sum(sign * F.coalesce(net, F.lit(0))).alias("net"), F.sum(F.when(net.isNotNull(), sign)).alias("n_net"))
    money = lambda c, n: F.when(F.col(n) > 0, (F.col(c).cast("decimal(36,0)") / 100).cast("decimal(38,2)"))
    return sums.select(
        ntz_from_epoch_ms(F.col("hour_ms")).alias("metric_hour"), "total_orders", *[f"{s}_orders" for s in ORDER_STATUSES],
        money("gross", "n").alias("gross_revenue"), money("net", "n_net").alias("net_revenue"),
        round2_double(F.col("gross").cast("double") / 100 / F.nullif(F.col("n"), F.lit(0)).cast("double")).alias("avg_order_value"),
        pct(F.col("cancelled_orders"), F.col("total_orders")).alias("cancellation_rate_pct"))


def metrics_stream(changes: DataFrame, out_path: str, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """Keep the hourly KPIs of a stream of changes under ``out_path``: a row
    per hour, rewritten by each trigger."""
    def rewrite(batch: DataFrame, batch_id: int) -> None:
        batch.where("total_orders <> 0").write.mode("overwrite").parquet(out_path)

    return (metrics_of_changes(changes).writeStream.outputMode("complete").foreachBatch(rewrite)
            .option("checkpointLocation", checkpoint).trigger(**(trigger or {"processingTime": "60 seconds"})).start())
