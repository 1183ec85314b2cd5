"""Model composition over the derived test feed.

``stg = stg_orders(processed(wire)); fct = fct_orders(stg);
met = fct_order_metrics(fct)`` is one lazily built Catalyst plan; the
model dependency graph of the reference is plain function composition.

Building a plan costs thousands of Python->JVM calls, so the model
DataFrames are memoised per (session, folder, options).  A DataFrame is an
immutable logical plan: reusing it re-executes the plan on every action,
nothing is cached as data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..sources.testdata import latest_line_items, order_feed, to_topic_records
from .ingest import processed
from .marts import fct_order_metrics, fct_orders, state_columns
from .staging import stg_orders

_PLANS: dict[tuple, DataFrame] = {}


def _memo(spark: SparkSession, key: tuple, build) -> DataFrame:
    # settings bound into a plan at analysis time are part of the key
    bound = tuple(spark.conf.get(c, None) for c in ("spark.sql.session.timeZone", "spark.sql.ansi.enabled"))
    k = (spark.sparkContext.applicationId, id(spark)) + bound + key
    df = _PLANS.get(k)
    if df is None:
        df = _PLANS[k] = build()
    return df


def wire(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _memo(spark, ("wire", sf_dir), lambda: order_feed(spark, sf_dir))


def topic_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feed as Kafka-shaped records (JSON values, tombstones NULL)."""
    return _memo(spark, ("records", sf_dir), lambda: to_topic_records(wire(spark, sf_dir)))


def processed_events(spark: SparkSession, sf_dir: str, include_snapshot: bool = False) -> DataFrame:
    return _memo(spark, ("processed", sf_dir, include_snapshot),
                 lambda: processed(wire(spark, sf_dir), include_snapshot=include_snapshot))


def staged(spark: SparkSession, sf_dir: str, include_snapshot: bool = False) -> DataFrame:
    return _memo(spark, ("staged", sf_dir, include_snapshot),
                 lambda: stg_orders(processed_events(spark, sf_dir, include_snapshot)))


def fact(spark: SparkSession, sf_dir: str, include_snapshot: bool = False, drop_deleted: bool = False, **kw) -> DataFrame:
    """The fact over the feed, ties kept.

    The latest events are found among the line items, before the feed joins
    them to their orders (:func:`latest_line_items`); no row of the fact is
    lost or gained by that.  Other forms of the fact (``on_tie``, ``method``)
    are taken over the whole staged feed.
    """
    key = ("fact", sf_dir, include_snapshot, drop_deleted) + tuple(sorted(kw.items()))
    if kw:
        return _memo(spark, key, lambda: fct_orders(staged(spark, sf_dir, include_snapshot), drop_deleted=drop_deleted, **kw))

    def build() -> DataFrame:
        feed = order_feed(spark, sf_dir, latest_line_items(spark, sf_dir, include_snapshot))
        return state_columns(stg_orders(processed(feed, include_snapshot=include_snapshot)), drop_deleted)

    return _memo(spark, key, build)


def metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _memo(spark, ("metrics", sf_dir), lambda: fct_order_metrics(fact(spark, sf_dir)))


def current_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """State of the source table as of the end of the feed: snapshot rows
    included, deleted orders gone."""
    return fact(spark, sf_dir, include_snapshot=True, drop_deleted=True)
