"""DuckDB twins of the registered queries (the correctness oracle).

Each string runs on DuckDB with the test tables registered as views.  The
models are derived from the tables by another way than the Spark side takes;
money and ratios are cast to DOUBLE at the end, like there.
"""

from __future__ import annotations

FEED = """
feed AS (
  SELECT l.l_orderkey AS id,
         CASE WHEN l.l_partkey % 40 = 1 THEN NULL ELSE o.o_custkey END AS customer_id,
         l.l_partkey AS product_id,
         CAST(l.l_quantity AS INTEGER) AS quantity,
         l.l_extendedprice AS unit_price,
         CAST(NULL AS DOUBLE) AS total_amount,
         CASE WHEN l.l_linenumber <= 2 THEN ' Pending' WHEN l.l_linenumber = 3 THEN 'confirmed'
              WHEN l.l_linenumber = 4 THEN 'SHIPPED' WHEN l.l_linenumber <= 6 THEN 'delivered '
              ELSE 'cancelled' END AS status,
         strftime(o.o_orderdate + INTERVAL 1 HOUR * CAST(o.o_orderkey % 24 AS INTEGER),
                  '%Y-%m-%dT%H:%M:%S.%fZ') AS created_at,
         strftime(l.l_shipdate, '%Y-%m-%dT%H:%M:%S.%fZ') AS updated_at,
         CASE WHEN l.l_partkey % 20 = 0 THEN 'r' WHEN l.l_partkey % 20 = 1 THEN 'd'
              WHEN l.l_partkey % 20 = 2 THEN NULL WHEN l.l_linenumber = 1 THEN 'c'
              ELSE 'u' END AS __op,
         'orders' AS __table,
         epoch_ms(l.l_shipdate) AS __ts_ms
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
)"""


# The change letters with their meaning, and whether they come from a snapshot.
LETTERS = """
letters(letter, operation, snapshot) AS (
  VALUES ('c', 'INSERT', false), ('u', 'UPDATE', false), ('d', 'DELETE', false), ('r', 'INSERT', true)
)"""

# What the models promise, the legal steps of a status, and the order inside one millisecond.
STATUSES = ["pending", "confirmed", "shipped", "delivered", "cancelled"]
DECLARED_TESTS = [
    ("stg_orders", "order_id", "not_null", None),
    ("stg_orders", "status", "not_null", None),
    ("stg_orders", "status", "accepted_values", STATUSES),
    ("stg_orders", "operation_type", "not_null", None),
    ("stg_orders", "operation_type", "accepted_values", ["INSERT", "UPDATE", "DELETE"]),
    ("stg_orders", "unit_price", "not_null", None),
    ("stg_orders", "total_amount", "not_null", None),
    ("fct_orders", "order_id", "unique", None),
    ("fct_orders", "order_id", "not_null", None),
    ("fct_orders", "is_terminal_state", "not_null", None),
]
REQUIRED = [("fct_orders", "order_id"), ("fct_orders", "customer_id"), ("fct_orders", "product_id"),
            ("fct_orders", "quantity"), ("fct_orders", "unit_price"), ("fct_orders", "total_amount"),
            ("fct_orders", "status"), ("fct_orders", "operation_type"), ("fct_order_metrics", "metric_hour")]
ALLOWED_TRANSITIONS = [("pending", "confirmed"), ("pending", "cancelled"), ("confirmed", "shipped"),
                       ("confirmed", "cancelled"), ("shipped", "delivered")]
STG_TIEBREAK = ["product_id", "quantity", "unit_price", "status", "operation_type", "customer_id", "created_at",
                "updated_at"]


def _changes(name: str, where: str) -> str:
    """One inner join filters the change letters and names them."""
    return f"""
{name} AS (
  SELECT f.* EXCLUDE (__op, __table, __ts_ms), l.operation, f.__ts_ms AS processed_at
  FROM feed f JOIN letters l ON l.letter = f.__op {where}
)"""


def _staged(name: str, where: str) -> str:
    """What staging must come to, in closed form from the tables: no text is
    decoded, trimmed or parsed here.  Parts that are 1 modulo 40 have no
    customer in the feed; those that are 2 modulo 20 have no letter."""
    return f"""
{name} AS (
  SELECT l_orderkey::BIGINT AS order_id, o_custkey::BIGINT AS customer_id, l_partkey::BIGINT AS product_id,
         l_quantity::INTEGER AS quantity, l_extendedprice::DECIMAL(10,2) AS unit_price,
         (l_quantity::INTEGER * l_extendedprice)::DECIMAL(10,2) AS total_amount,
         list_extract(['pending', 'pending', 'confirmed', 'shipped', 'delivered', 'delivered', 'cancelled'],
                      least(l_linenumber, 7)::BIGINT) AS status,
         if(l_partkey % 20 = 1, 'DELETE', if(l_partkey % 20 = 0 OR l_linenumber = 1, 'INSERT', 'UPDATE'))
           AS operation_type,
         o_orderdate::TIMESTAMP + to_hours((o_orderkey % 24)::INTEGER) AS created_at,
         l_shipdate::TIMESTAMP AS updated_at, l_shipdate::TIMESTAMP AS processed_at
  FROM lineitem, orders
  WHERE o_orderkey = l_orderkey AND l_partkey % 40 <> 1 AND l_partkey % 20 <> 2 AND o_custkey IS NOT NULL {where}
)"""


def _newest(name: str, src: str, where: str = "") -> str:
    """The rows for which no newer row of the order exists."""
    return f"""
{name} AS (
  SELECT a.*, list_contains(['delivered', 'cancelled'], a.status) AS is_terminal_state,
         time_bucket(INTERVAL 1 HOUR, a.created_at) AS created_hour,
         CAST(a.created_at AS DATE)::TIMESTAMP AS created_day
  FROM {src} a
  WHERE NOT EXISTS (FROM {src} b WHERE b.order_id = a.order_id AND b.processed_at > a.processed_at) {where}
)"""


_OF_STATUS = ",\n         ".join(f"coalesce(n_of['{s}'], 0) AS {s}_orders" for s in STATUSES)

# Counts and amounts per hour and status first; the hours are made of them.
METRICS_CTE = f"""
hour_status AS (
  SELECT created_hour AS hour, status, count(*) AS n, sum(total_amount) AS amount FROM fct_orders GROUP BY ALL
),
hours AS (
  SELECT hour, sum(n)::BIGINT AS n, map_from_entries(list(row(status, n))) AS n_of, sum(amount) AS gross,
         coalesce(max(amount) FILTER (WHERE status = 'cancelled'), 0) AS lost
  FROM hour_status GROUP BY hour
),
fct_order_metrics AS (
  SELECT hour AS metric_hour, n AS total_orders,
         {_OF_STATUS},
         gross AS gross_revenue, gross - lost AS net_revenue, round(gross::DOUBLE / n, 2) AS avg_order_value,
         round(cancelled_orders * 100.0::DOUBLE / n, 2) AS cancellation_rate_pct
  FROM hours
)"""

CHAIN = ",".join([
    FEED,
    LETTERS,
    _changes("processed", "AND NOT l.snapshot"),
    _staged("stg_orders", "AND l_partkey % 20 <> 0"),
    _newest("fct_orders", "stg_orders"),
    METRICS_CTE,
    _changes("processed_all", ""),
    _staged("stg_all", ""),
    _newest("fct_all", "stg_all"),
    _newest("current_state", "stg_all", "AND a.operation_type <> 'DELETE'"),
])


def with_chain(select: str) -> str:
    return f"WITH {CHAIN}\n{select}"


FCT_DOUBLE = """order_id, customer_id, product_id, quantity, CAST(unit_price AS DOUBLE) AS unit_price,
  CAST(total_amount AS DOUBLE) AS total_amount, status, operation_type, created_at, updated_at,
  processed_at"""

METRICS_DOUBLE = """metric_hour, total_orders, pending_orders, confirmed_orders, shipped_orders,
  delivered_orders, cancelled_orders, CAST(gross_revenue AS DOUBLE) AS gross_revenue,
  CAST(net_revenue AS DOUBLE) AS net_revenue, CAST(avg_order_value AS DOUBLE) AS avg_order_value,
  CAST(cancellation_rate_pct AS DOUBLE) AS cancellation_rate_pct"""


def _feed(name: str, source: str, columns: str, key: str, table: str, changes: list[tuple]) -> str:
    """The changes of a dimension table: a SELECT per kind of change."""
    parts = []
    for op, modulo, rest, day, spread, version in changes:
        happens = f"{key} % {changes[0][1]} <> 0" if (op, modulo) == ("c", 1) else f"{key} % {modulo} = {rest}"
        parts.append(f"SELECT *, '{op}' AS __op, {version} AS version, "
                     f"TIMESTAMP '1992-01-01' + to_days(({day} + {key} % {spread})::INTEGER) AS changed FROM {source} WHERE {happens}")
    return f"""
{name} AS (
  SELECT {columns}, '1992-01-01T00:00:00.000000Z' AS created_at, strftime(changed, '%Y-%m-%dT%H:%M:%S.%fZ') AS updated_at,
         __op, '{table}' AS __table, epoch_ms(changed) AS __ts_ms
  FROM ({" UNION ALL ".join(parts)})
)"""


# Which dimension rows change, how and when.
CUSTOMER_FEED = _feed(
    "customer_feed", "customer",
    "c_custkey::BIGINT AS id, if(c_custkey % 97 = 0, NULL, 'customer' || (c_custkey - (c_custkey % 40 = 0)::INT) || '@example.com') AS email, "
    "'Customer' AS first_name, substr(c_name, 10) AS last_name, 'country-' || ((c_nationkey + version) % 25) AS country",
    "c_custkey", "customers",
    [("r", 7, 0, 0, 1, 0), ("c", 1, 0, 10, 700, 0), ("u", 3, 0, 720, 900, 1), ("u", 6, 0, 1700, 300, 2), ("d", 11, 0, 1461, 365, 2),
     ("c", 22, 0, 1980, 30, 3)])
PRODUCT_FEED = _feed(
    "product_feed", "part",
    "p_partkey::BIGINT AS id, 'SKU-' || (p_partkey - (p_partkey % 50 = 0)::INT) AS sku, p_name AS name, p_type AS category, "
    "p_retailprice + 10.0::DOUBLE * version AS price, p_size - 3 AS stock_quantity",
    "p_partkey", "products",
    [("r", 5, 0, 0, 1, 0), ("c", 1, 0, 5, 300, 0), ("u", 2, 0, 400, 1500, 1), ("u", 4, 0, 1950, 200, 2), ("d", 13, 0, 2000, 100, 2)])


def history(feed: str, tracked: list[str], name: str) -> str:
    """Runs of equal values numbered by how often they have changed so far;
    a run of deletes is no version."""
    values = ", ".join(f"{c} := if(__op = 'd', NULL, {c})" for c in tracked)
    order = ", ".join(["__ts_ms", "__op", *tracked])
    return f"""
{name} AS (
  WITH marked AS (SELECT id, __op, __ts_ms, {", ".join(tracked)}, struct_pack({values}, gone := __op = 'd') AS v FROM {feed}),
  stepped AS (SELECT *, lag(v) OVER w AS before, row_number() OVER w AS nth FROM marked
              WINDOW w AS (PARTITION BY id ORDER BY {order})),
  runs AS (SELECT *, sum((nth = 1 OR v IS DISTINCT FROM before)::INT) OVER (PARTITION BY id ORDER BY nth) AS run FROM stepped),
  starts AS (SELECT id, run, any_value(v) AS v, epoch_ms(min(__ts_ms)) AS valid_from FROM runs GROUP BY id, run)
  SELECT a.id, {", ".join(f"a.v.{c} AS {c}" for c in tracked)}, a.valid_from, b.valid_from AS valid_to, b.run IS NULL AS is_current
  FROM starts a LEFT JOIN starts b ON b.id = a.id AND b.run = a.run + 1 WHERE NOT a.v.gone
)"""


# The lines of the careless producer.
LINES = [
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
_FIELDS = {"id": "BIGINT", "customer_id": "BIGINT", "product_id": "BIGINT", "quantity": "INTEGER", "unit_price": "DOUBLE",
           "total_amount": "DOUBLE", "status": "VARCHAR", "created_at": "VARCHAR", "updated_at": "VARCHAR", "__op": "VARCHAR",
           "__table": "VARCHAR", "__ts_ms": "BIGINT"}
_QUOTED = ", ".join("'" + x.replace("'", "''") + "'" for x in LINES)
_SHAPE = "{" + ", ".join(f'"{k}": "{t}"' for k, t in _FIELDS.items()) + "}"


def _field(name: str, kind: str) -> str:
    """DuckDB's own reading of the field; a true fraction or a boolean is no
    integer."""
    if kind not in ("BIGINT", "INTEGER"):
        return f"r.{name} AS {name}"
    return (f"CASE WHEN coalesce(try_cast(json_extract_string(j, '$.{name}') AS DOUBLE) % 1, 0) = 0 "
            f"AND json_type(j, '$.{name}') IS DISTINCT FROM 'BOOLEAN' THEN r.{name} END AS {name}")


EDGE_LINES = f"""
cents AS (SELECT *, round(unit_price * 100)::BIGINT AS n FROM feed),
lines AS (
  SELECT replace(replace(replace(replace(replace(replace(list_extract([{_QUOTED}], (id + product_id) % {len(LINES)} + 1),
           '{{i}}', id::VARCHAR), '{{c}}', coalesce(customer_id, 0)::VARCHAR), '{{p}}', product_id::VARCHAR),
           '{{q}}', quantity::VARCHAR), '{{m}}', (n // 100) || '.' || lpad((n % 100)::VARCHAR, 2, '0')), '{{t}}', __ts_ms::VARCHAR) AS line
  FROM cents),
parsed AS (SELECT CASE WHEN json_valid(line) THEN line::JSON END AS j FROM lines),
read AS (SELECT j, json_transform(j, '{_SHAPE}') AS r FROM parsed)
SELECT {", ".join(_field(k, t) for k, t in _FIELDS.items())} FROM read"""
