"""The order change feed derived from the TPC-H-like test tables.

The reference's inputs are whatever its load generator wrote; here the
feed is derived from ``lineitem JOIN orders`` so that it grows with the
tables: one change event per line item, the order key repeats (so there is
state to reduce), the ship date gives the event time (with natural ties).

Fixed rules of the derived feed (must equal the DuckDB twin in
``orderflow.oracle_sql``):
  op:          l_partkey % 20 = 0 -> 'r' (snapshot read), = 1 -> 'd',
               = 2 -> NULL (tombstone), else l_linenumber = 1 -> 'c', else 'u'
  customer_id: NULL when l_partkey % 40 = 1 (a delete without its columns)
  status:      l_linenumber <= 2 ' Pending', 3 'confirmed', 4 'SHIPPED',
               5..6 'delivered ', else 'cancelled'  (needs TRIM + LOWER)
  created_at:  o_orderdate + (o_orderkey % 24) hours, ISO text with 'Z'
  updated_at:  l_shipdate, ISO text with 'Z'
  __ts_ms:     l_shipdate as epoch milliseconds
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.times import epoch_ms_of, format_iso_utc
from ..operators.latest import latest_rows
from ..schemas import ORDERS_TOPIC, ORDERS_WIRE


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _feed_columns(li_partkey: Column, li_line: Column) -> dict:
    pk20 = li_partkey % 20
    op = (F.when(pk20 == 0, F.lit("r"))
          .when(pk20 == 1, F.lit("d"))
          .when(pk20 == 2, F.lit(None).cast("string"))
          .when(li_line == 1, F.lit("c"))
          .otherwise(F.lit("u")))
    status = (F.when(li_line <= 2, F.lit(" Pending"))
              .when(li_line == 3, F.lit("confirmed"))
              .when(li_line == 4, F.lit("SHIPPED"))
              .when(li_line <= 6, F.lit("delivered "))
              .otherwise(F.lit("cancelled")))
    return {"op": op, "status": status}


def latest_line_items(spark: SparkSession, sf_dir: str, include_snapshot: bool = False) -> DataFrame:
    """The line items whose change events are the latest of their orders.

    What decides it is in ``lineitem`` alone: the order, the time, and whether
    staging keeps the event (a change, or a snapshot row if wanted, with its
    columns); only a missing customer of the order is not, and that drops all
    of an order's events alike.  So the latest are found before ``orders`` is
    joined: the group limit runs in the scan's tasks, where it cuts a hot
    order down, and again behind the one exchange, whose partitioning the join
    then reuses.
    """
    part = F.col("l_partkey")
    events = table(spark, sf_dir, "lineitem").where(
        F.col("l_orderkey").isNotNull() & part.isNotNull() & (part % 20 != 2) & (part % 40 != 1))
    if not include_snapshot:
        events = events.where(part % 20 != 0)
    return latest_rows(events.withColumn("__at", epoch_ms_of(F.col("l_shipdate"))), ["l_orderkey"], "__at").drop("__at")


def order_feed(spark: SparkSession, sf_dir: str, line_items: DataFrame | None = None) -> DataFrame:
    """Typed flattened change events (``ORDERS_WIRE`` columns), of all line
    items or of some.

    The join is on the order key, which is also the key every later state
    operator partitions by; with a sort-merge join the hash partitioning on
    the order key is reused downstream instead of shuffling again.
    """
    li = (table(spark, sf_dir, "lineitem") if line_items is None else line_items).select(
        "l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_shipdate")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    j = li.join(o, li.l_orderkey == o.o_orderkey, "inner")
    cols = _feed_columns(F.col("l_partkey"), F.col("l_linenumber"))
    created = F.timestamp_add("HOUR", (F.col("o_orderkey") % 24).cast("int"), F.col("o_orderdate"))
    return j.select(
        F.col("l_orderkey").alias("id"),
        F.when(F.col("l_partkey") % 40 == 1, F.lit(None).cast("bigint"))
         .otherwise(F.col("o_custkey")).alias("customer_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_quantity").cast("int").alias("quantity"),
        F.col("l_extendedprice").alias("unit_price"),
        F.lit(None).cast("double").alias("total_amount"),
        cols["status"].alias("status"),
        format_iso_utc(created).alias("created_at"),
        format_iso_utc(F.col("l_shipdate")).alias("updated_at"),
        cols["op"].alias("__op"),
        F.lit("orders").alias("__table"),
        epoch_ms_of(F.col("l_shipdate")).alias("__ts_ms"),
    )


def to_topic_records(feed: DataFrame, topic: str = ORDERS_TOPIC, schema: T.StructType = ORDERS_WIRE) -> DataFrame:
    """Kafka-shaped rows (key, value, topic, timestamp) of a typed feed.

    A row whose ``__op`` is NULL is a tombstone: its value is NULL.  The
    value is the flattened JSON of the wire fields; NULL fields are omitted,
    as a JSON converter without schemas would do.
    """
    fields = [F.col(f.name) for f in schema.fields]
    value = F.when(F.col("__op").isNull(), F.lit(None).cast("string")) \
             .otherwise(F.to_json(F.struct(*fields)))
    return feed.select(
        F.to_json(F.struct(F.col("id"))).alias("key"),
        value.alias("value"),
        F.lit(topic).alias("topic"),
        F.timestamp_millis(F.col("__ts_ms")).alias("timestamp"),
    )


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customer dimension (id, email, name, nation, balance, segment)."""
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("id"), _email().alias("email"), F.col("c_name").alias("name"),
        F.col("c_nationkey").alias("nation_id"), F.col("c_acctbal").alias("balance"),
        F.col("c_mktsegment").alias("segment"))


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Product dimension (id, sku, name, brand, category, size, price, stock)."""
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("id"), _sku().alias("sku"), F.col("p_name").alias("name"),
        F.col("p_brand").alias("brand"), F.col("p_type").alias("category"),
        F.col("p_size").alias("size"),
        F.col("p_retailprice").cast(T.DecimalType(10, 2)).alias("price"), _stock().alias("stock_quantity"))


def _email() -> Column:
    """NULL for keys that are 0 modulo 97; those that are 0 modulo 40 share
    the address of the key before."""
    key = F.col("c_custkey")
    owner = F.when(key % 40 == 0, key - 1).otherwise(key)
    return F.when(key % 97 != 0, F.concat(F.lit("customer"), owner.cast("string"), F.lit("@example.com")))


def _sku() -> Column:
    """Keys that are 0 modulo 50 share the SKU of the key before."""
    key = F.col("p_partkey")
    return F.concat(F.lit("SKU-"), F.when(key % 50 == 0, key - 1).otherwise(key).cast("string"))


def _stock() -> Column:
    """Below zero for parts of size 1 and 2."""
    return (F.col("p_size") - 3).cast("int")


# Changes of the dimension tables: (operation, keys for which it happens: key
# modulo the first number equals the second, its day after 1992-01-01: a number
# plus key modulo another, and the version that the row then has).
CUSTOMER_CHANGES = [("r", 7, 0, 0, 1, 0), ("c", 1, 0, 10, 700, 0), ("u", 3, 0, 720, 900, 1), ("u", 6, 0, 1700, 300, 2),
                    ("d", 11, 0, 1461, 365, 2), ("c", 22, 0, 1980, 30, 3)]
PRODUCT_CHANGES = [("r", 5, 0, 0, 1, 0), ("c", 1, 0, 5, 300, 0), ("u", 2, 0, 400, 1500, 1), ("u", 4, 0, 1950, 200, 2),
                   ("d", 13, 0, 2000, 100, 2)]


def _changes(df: DataFrame, key: str, changes: list[tuple]) -> DataFrame:
    """A row per change of each row of ``df``: ``__op``, ``version`` and
    ``at``; rows of the snapshot have no creation of their own."""
    k, snapshot = F.col(key), F.col(key) % changes[0][1] == 0
    one = []
    for op, modulo, rest, day, spread, version in changes:
        happens = k % modulo == rest
        if (op, modulo) == ("c", 1):
            happens = ~snapshot
        one.append(F.when(happens, F.struct(F.lit(op).alias("__op"), F.lit(version).alias("version"),
                                            F.timestamp_add("DAY", (F.lit(day) + k % spread).cast("int"),
                                                            F.expr("TIMESTAMP_NTZ'1992-01-01 00:00:00'")).alias("at"))))
    exploded = df.withColumn("__change", F.explode(F.filter(F.array(*one), lambda x: x.isNotNull())))
    return exploded.select(*df.columns, "__change.*")


def customer_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed change events of the customers table (``CUSTOMERS_WIRE``): each
    later version lives in the next country; deletes carry the row."""
    c = _changes(table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey"), "c_custkey", CUSTOMER_CHANGES)
    return c.select(
        F.col("c_custkey").alias("id"), _email().alias("email"), F.lit("Customer").alias("first_name"),
        F.substring("c_name", 10, 20).alias("last_name"),
        F.concat(F.lit("country-"), ((F.col("c_nationkey") + F.col("version")) % 25).cast("string")).alias("country"),
        format_iso_utc(F.expr("TIMESTAMP_NTZ'1992-01-01 00:00:00'")).alias("created_at"), format_iso_utc(F.col("at")).alias("updated_at"),
        F.col("__op"), F.lit("customers").alias("__table"), epoch_ms_of(F.col("at")).alias("__ts_ms"))


def product_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed change events of the products table (``PRODUCTS_WIRE``): each
    later version costs ten more."""
    p = _changes(table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_type", "p_size", "p_retailprice"),
                 "p_partkey", PRODUCT_CHANGES)
    return p.select(
        F.col("p_partkey").alias("id"), _sku().alias("sku"), F.col("p_name").alias("name"), F.col("p_type").alias("category"),
        (F.col("p_retailprice") + F.lit(10.0) * F.col("version")).alias("price"), _stock().alias("stock_quantity"),
        format_iso_utc(F.expr("TIMESTAMP_NTZ'1992-01-01 00:00:00'")).alias("created_at"), format_iso_utc(F.col("at")).alias("updated_at"),
        F.col("__op"), F.lit("products").alias("__table"), epoch_ms_of(F.col("at")).alias("__ts_ms"))


# Lines as they come from a careless producer, by (id + product) modulo their
# number; {i} id, {c} customer, {p} product, {q} quantity, {m} price, {t} time.
EDGE_LINES = [
    '{"id":{i},"customer_id":{c},"product_id":{p},"quantity":{q},"unit_price":{m},"status":"pending","__op":"c","__ts_ms":{t}}',
    '{"id":"{i}","customer_id":"{c}","product_id":{p},"quantity":"{q}","unit_price":"{m}","status":5,"__op":"u","__ts_ms":"{t}"}',
    '{"id":{i}.0,"customer_id":{c},"quantity":{q}.0,"unit_price":{q},"__op":"u"}',
    '{"id":{i},"customer_id":null,"product_id":null,"quantity":null,"unit_price":null,"status":null,"__op":null,"__ts_ms":null}',
    '{"id":{i},"customer_id":{c},"quantity":{q',
    'no json {i}',
    '[{i},{c}]',
    'null',
    '',
    '{"id":{i},"status":{"n":{q},"was":"shipped"},"__op":"u"}',
    '{"id":{i}99999999999999999999,"quantity":{q}9999999999,"__op":"u"}',
    '{"id":{i},"quantity":{q}.5,"unit_price":{q}.5}',
    '{"id":{i},"unit_price":"x{m}","quantity":"{q} pieces"}',
    ' { "id" : {i} , "status" : "\\u00e9\\tpending" } ',
    '{"id":{i},"unit_price":{q}e2,"quantity":{q}e0,"__ts_ms":"{q}e3"}',
    '{"id":{i},"quantity":true,"unit_price":[{m}],"status":false}',
    "{'id':{i}}",
    '"pending"',
    '{"id":{i},"extra":{"a":[1,2,{"id":{q}}]},"__op":"d"}',
    '{i}',
]


def edge_lines(feed: DataFrame) -> DataFrame:
    """A column ``value`` with one of ``EDGE_LINES`` for each row of the feed."""
    cents = F.round(F.col("unit_price") * 100).cast("bigint")
    money = F.concat(F.floor(cents / 100).cast("string"), F.lit("."), F.lpad((cents % 100).cast("string"), 2, "0"))
    line = F.element_at(F.array(*[F.lit(x) for x in EDGE_LINES]), ((F.col("id") + F.col("product_id")) % len(EDGE_LINES) + 1).cast("int"))
    given = {"i": F.col("id"), "c": F.coalesce("customer_id", F.lit(0)), "p": F.col("product_id"), "q": F.col("quantity"), "m": money,
             "t": F.col("__ts_ms")}
    for name, value in given.items():
        line = F.replace(line, F.lit("{" + name + "}"), value.cast("string"))
    return feed.select(line.alias("value"))


# Fixed mapping of the events table onto change operations (second captured
# table of the derived test data).
EVENT_OPERATIONS = {"signup": "c", "error": "d", "view": "r"}   # everything else: 'u'


def event_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ``events`` table as flattened change events of a user table:
    key ``user_id``, event time ``ts``; columns ``(user_id, event_id,
    event_type, value, props, __op, __table, __ts_ms)``."""
    ev = table(spark, sf_dir, "events")
    op = F.lit("u")
    for name, code in reversed(list(EVENT_OPERATIONS.items())):
        op = F.when(F.col("event_type") == F.lit(name), F.lit(code)).otherwise(op)
    return ev.select("user_id", "event_id", "event_type", "value", "props",
                     op.alias("__op"), F.lit("events").alias("__table"),
                     epoch_ms_of(F.col("ts")).alias("__ts_ms"))
