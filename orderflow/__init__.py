"""orderflow: order change-feed analytics on Spark.

Row changes of an order database (flattened change events) are decoded,
typed, reduced to the latest state per order and aggregated into hourly
KPIs and dashboard metrics.  Every operator is a ``DataFrame -> DataFrame``
function built from Spark SQL expressions, so Catalyst sees the whole plan.
"""

__all__ = ["session", "schemas"]
