"""Latest state as a streaming aggregation (state kept by Spark).

``groupBy(order_id).agg(max(struct(processed_at, tie-break..., row)))`` is a
keyed streaming aggregation: Spark keeps one state row per order in the
state store (RocksDB in this package's sessions), and in ``update`` output
mode each trigger emits only the orders that changed – an upsert stream for
a key-value sink.  Late and out-of-order events are handled because max is
order-independent.  Being an aggregate it keeps one row per order, i.e. the
``on_tie="one"`` semantics of :func:`orderflow.operators.latest.latest_rows`
with the same tie-break; the tie-keeping reference semantics are served by
:func:`orderflow.streaming.state.state_stream`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..plans.staging import stg_orders

ORDER_TIEBREAK = ["customer_id", "product_id", "quantity", "unit_price", "total_amount", "status",
                  "operation_type", "created_at", "updated_at"]


def latest_state_updates(processed: DataFrame) -> DataFrame:
    """Processed change rows (stream or batch) -> latest row per order."""
    stg = stg_orders(processed).where(F.col("processed_at").isNotNull())
    packed = F.max(F.struct("processed_at", *ORDER_TIEBREAK)).alias("__latest")
    return (stg.groupBy("order_id").agg(packed)
            .select("order_id", *[F.col(f"__latest.{c}").alias(c) for c in ORDER_TIEBREAK + ["processed_at"]]))


def start_latest_state_updates(processed_stream: DataFrame, sink_fn, checkpoint: str,
                               trigger: dict | None = None) -> StreamingQuery:
    """Run the aggregation in update mode; ``sink_fn(batch_df, batch_id)``
    upserts the changed orders (e.g. a MERGE into a key-value table)."""
    return (latest_state_updates(processed_stream).writeStream.outputMode("update")
            .foreachBatch(sink_fn).option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"processingTime": "60 seconds"})).start())
