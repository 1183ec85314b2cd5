"""Declared schemas at every hop.  Nothing downstream infers a schema."""

from __future__ import annotations

from pyspark.sql import types as T

# --- fixed values of the source system -------------------------------------
# Order statuses accepted by the source table, in life-cycle order.
ORDER_STATUSES = ["pending", "confirmed", "shipped", "delivered", "cancelled"]
# Statuses after which an order never changes again.
TERMINAL_STATUSES = ["delivered", "cancelled"]
# Allowed status changes (from -> to) of the order life cycle.
ALLOWED_TRANSITIONS = [
    ("pending", "confirmed"),
    ("pending", "cancelled"),
    ("confirmed", "shipped"),
    ("confirmed", "cancelled"),
    ("shipped", "delivered"),
]
# Change-event operation codes and their decoded names.
OPERATION_NAMES = {"c": "INSERT", "u": "UPDATE", "d": "DELETE"}
SNAPSHOT_OP = "r"
OPERATION_TYPES = ["INSERT", "UPDATE", "DELETE"]
ORDERS_TOPIC = "ecommerce.public.orders"
# ---------------------------------------------------------------------------

# Flattened change event of the orders table as it travels on the topic.
ORDERS_WIRE = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("customer_id", T.LongType()),
    T.StructField("product_id", T.LongType()),
    T.StructField("quantity", T.IntegerType()),
    T.StructField("unit_price", T.DoubleType()),
    T.StructField("total_amount", T.DoubleType()),
    T.StructField("status", T.StringType()),
    T.StructField("created_at", T.StringType()),
    T.StructField("updated_at", T.StringType()),
    T.StructField("__op", T.StringType()),
    T.StructField("__table", T.StringType()),
    T.StructField("__ts_ms", T.LongType()),
])

# The other two captured tables as they travel on their topics.
CUSTOMERS_WIRE = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("email", T.StringType()),
    T.StructField("first_name", T.StringType()),
    T.StructField("last_name", T.StringType()),
    T.StructField("country", T.StringType()),
    T.StructField("created_at", T.StringType()),
    T.StructField("updated_at", T.StringType()),
    T.StructField("__op", T.StringType()),
    T.StructField("__table", T.StringType()),
    T.StructField("__ts_ms", T.LongType()),
])

PRODUCTS_WIRE = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("sku", T.StringType()),
    T.StructField("name", T.StringType()),
    T.StructField("category", T.StringType()),
    T.StructField("price", T.DoubleType()),
    T.StructField("stock_quantity", T.IntegerType()),
    T.StructField("created_at", T.StringType()),
    T.StructField("updated_at", T.StringType()),
    T.StructField("__op", T.StringType()),
    T.StructField("__table", T.StringType()),
    T.StructField("__ts_ms", T.LongType()),
])

# Wire schema of each captured table, by the name that its messages carry.
WIRE_TABLES = {"orders": ORDERS_WIRE, "customers": CUSTOMERS_WIRE, "products": PRODUCTS_WIRE}

# Output of the stream job (file sink) = input of the staging model.
ORDERS_PROCESSED = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("customer_id", T.LongType()),
    T.StructField("product_id", T.LongType()),
    T.StructField("quantity", T.IntegerType()),
    T.StructField("unit_price", T.DoubleType()),
    T.StructField("total_amount", T.DoubleType()),
    T.StructField("status", T.StringType()),
    T.StructField("operation", T.StringType()),
    T.StructField("created_at", T.StringType()),
    T.StructField("updated_at", T.StringType()),
    T.StructField("processed_at", T.LongType()),
])

MONEY = T.DecimalType(10, 2)

STG_ORDERS = T.StructType([
    T.StructField("order_id", T.LongType()),
    T.StructField("customer_id", T.LongType()),
    T.StructField("product_id", T.LongType()),
    T.StructField("quantity", T.IntegerType()),
    T.StructField("unit_price", MONEY),
    T.StructField("total_amount", MONEY),
    T.StructField("status", T.StringType()),
    T.StructField("operation_type", T.StringType()),
    T.StructField("created_at", T.TimestampNTZType()),
    T.StructField("updated_at", T.TimestampNTZType()),
    T.StructField("processed_at", T.TimestampNTZType()),
])

FCT_ORDERS = T.StructType(STG_ORDERS.fields + [
    T.StructField("is_terminal_state", T.BooleanType()),
    T.StructField("created_hour", T.TimestampNTZType()),
    T.StructField("created_day", T.TimestampNTZType()),
])

# Columns the warehouse declares REQUIRED (must never be NULL when written).
FCT_ORDERS_REQUIRED = ["order_id", "customer_id", "product_id", "quantity", "unit_price", "total_amount", "status",
                       "operation_type"]
FCT_ORDER_METRICS_REQUIRED = ["metric_hour"]

FCT_ORDER_METRICS = T.StructType([
    T.StructField("metric_hour", T.TimestampNTZType()),
    T.StructField("total_orders", T.LongType()),
    T.StructField("pending_orders", T.LongType()),
    T.StructField("confirmed_orders", T.LongType()),
    T.StructField("shipped_orders", T.LongType()),
    T.StructField("delivered_orders", T.LongType()),
    T.StructField("cancelled_orders", T.LongType()),
    T.StructField("gross_revenue", T.DecimalType(38, 2)),
    T.StructField("net_revenue", T.DecimalType(38, 2)),
    T.StructField("avg_order_value", T.DoubleType()),
    T.StructField("cancellation_rate_pct", T.DoubleType()),
])


def ddl(schema: T.StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
