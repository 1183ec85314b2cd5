"""Results do not depend on the session time zone."""

import __spark_entry__ as E
from tests.conftest import SF_SMALL

QUERIES = ["stg_orders", "fct_order_metrics", "hourly_revenue", "change_counts_hourly",
           "events_latest_state", "parse_change_events"]


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_same_results_in_another_zone(spark):
    qs = E.queries()
    want = {q: _rows(qs[q](spark, SF_SMALL)) for q in QUERIES}
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        for q in QUERIES:
            assert _rows(qs[q](spark, SF_SMALL)) == want[q], q
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
