"""Windowed change counts on the stream (M3): change events per hour and
operation, with a watermark bounding the state kept for late events."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.times import instant_to_utc_ntz


def change_counts(processed: DataFrame, window: str = "1 hour", watermark: str = "2 hours") -> DataFrame:
    """Count changes per event-time window and operation.

    Event time is the change's ``processed_at``.  The watermark lets Spark
    drop the state of windows older than ``watermark`` behind the newest
    event; works on batch input too (watermark is then ignored).
    """
    # An instant (streaming watermarks need TIMESTAMP); window bounds are
    # computed on epoch time, so they do not depend on the session zone.
    ts = F.timestamp_millis(F.col("processed_at"))
    return (processed.withColumn("event_time", ts)
            .withWatermark("event_time", watermark)
            .groupBy(F.window("event_time", window).alias("w"), F.col("operation"))
            .agg(F.count(F.lit(1)).alias("changes"))
            .select(instant_to_utc_ntz(F.col("w.start")).alias("window_start"),
                    instant_to_utc_ntz(F.col("w.end")).alias("window_end"),
                    "operation", "changes"))


def late_groups(query: StreamingQuery) -> int:
    """What the stateful operators of a query dropped behind the watermark in
    this run, by the progress that Spark reports.  Rows are summed within
    their task first, so events of one window, operation and task count once."""
    return sum(op["numRowsDroppedByWatermark"] for p in query.recentProgress for op in p["stateOperators"])
