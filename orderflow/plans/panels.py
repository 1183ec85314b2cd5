"""Dashboard / serving metrics as DataFrame functions.

The reference served four named metrics over HTTP from the warehouse; here
each metric is a function of the marts returning a DataFrame, and the caller
decides where it goes.  Series are ``(ts, value)`` with ``ts`` in epoch
milliseconds, newest first, at most ``points`` hours that have orders
(no gap filling).  Optional ``start``/``end`` bound the hours read, so a
day-partitioned metrics table is pruned.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.times import epoch_ms_of

SERIES_POINTS = 48


def _sorted(df: DataFrame, *order: Column) -> DataFrame:
    """A global sort: status is free text, so the number of groups has no
    bound and the last aggregation must stay spread."""
    return df.orderBy(*order)


def _by_count() -> tuple[Column, Column]:
    return F.col("orders").desc(), F.col("status").asc_nulls_last()


def orders_by_status(fct: DataFrame) -> DataFrame:
    """(status, orders) by count descending; status breaks ties."""
    return _sorted(fct.groupBy("status").agg(F.count(F.lit(1)).alias("orders")), *_by_count())


def status_revenue(fct: DataFrame) -> DataFrame:
    """(status, orders, revenue): count and revenue rounded to cents."""
    return _sorted(fct.groupBy("status").agg(F.count(F.lit(1)).alias("orders"),
                                                   F.round(F.sum("total_amount"), 2).alias("revenue")),
                         *_by_count())


def status_stats(state: DataFrame) -> DataFrame:
    """(status, orders, revenue) over the current source-table state, a
    missing sum shown as 0."""
    return _sorted(state.groupBy("status").agg(
        F.count(F.lit(1)).alias("orders"),
        F.coalesce(F.sum("total_amount"), F.lit(0).cast(T.DecimalType(10, 2))).alias("revenue")), *_by_count())


def _bounded(metrics: DataFrame, start=None, end=None) -> DataFrame:
    if start is not None:
        metrics = metrics.where(F.col("metric_hour") >= F.lit(start).cast(T.TimestampNTZType()))
    if end is not None:
        metrics = metrics.where(F.col("metric_hour") < F.lit(end).cast(T.TimestampNTZType()))
    return metrics


def _series(metrics: DataFrame, value: Column, points: int, start, end) -> DataFrame:
    m = _bounded(metrics, start, end)
    return (m.orderBy(F.col("metric_hour").desc_nulls_last())
            .limit(points)
            .select(epoch_ms_of(F.col("metric_hour")).alias("ts"), value.alias("value")))


def hourly_revenue(metrics: DataFrame, points: int = SERIES_POINTS, start=None, end=None) -> DataFrame:
    """Gross revenue of the newest hours; NULL shown as 0."""
    return _series(metrics, F.coalesce(F.col("gross_revenue").cast("double"), F.lit(0.0)),
                   points, start, end)


def hourly_order_volume(metrics: DataFrame, points: int = SERIES_POINTS, start=None, end=None) -> DataFrame:
    """Order count of the newest hours; NULL shown as 0."""
    return _series(metrics, F.coalesce(F.col("total_orders").cast("bigint"), F.lit(0).cast("bigint")),
                   points, start, end)


def hourly_cancellation_rate(metrics: DataFrame, points: int = SERIES_POINTS, start=None, end=None) -> DataFrame:
    """Cancellation percentage of the newest hours; NULL shown as 0."""
    return _series(metrics, F.coalesce(F.col("cancellation_rate_pct").cast("double"), F.lit(0.0)),
                   points, start, end)


# Metric catalogue: name -> function of (fct_orders, fct_order_metrics).
METRICS: dict[str, Callable[..., DataFrame]] = {
    "orders_by_status": lambda fct, metrics, **kw: orders_by_status(fct),
    "hourly_revenue": lambda fct, metrics, **kw: hourly_revenue(metrics, **kw),
    "hourly_order_volume": lambda fct, metrics, **kw: hourly_order_volume(metrics, **kw),
    "cancellation_rate": lambda fct, metrics, **kw: hourly_cancellation_rate(metrics, **kw),
}


def metric(name: str, fct: DataFrame, metrics: DataFrame, **kw) -> DataFrame:
    """Look up a named metric; an unknown name is an error listing the
    catalogue (the reference silently answered with an empty series)."""
    try:
        fn = METRICS[name]
    except KeyError:
        raise KeyError(f"unknown metric {name!r}; known: {sorted(METRICS)}") from None
    return fn(fct, metrics, **kw)
