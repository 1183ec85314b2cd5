"""Tolerant decoding of the wire format."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderflow.schemas import ORDERS_WIRE
from orderflow.sources.wire import _JSON, parse_change_events, parse_json_column, text_schema, to_envelope, unwrap_envelope

SMALL = T.StructType([T.StructField("id", T.LongType()), T.StructField("quantity", T.IntegerType()),
                      T.StructField("unit_price", T.DoubleType()), T.StructField("status", T.StringType())])


def _parse(spark, lines):
    df = spark.createDataFrame([(x,) for x in lines], "value string")
    return [tuple(r) for r in parse_json_column(df, "value", SMALL).collect()]


def test_edge_lines(spark):
    rows = _parse(spark, [
        '{"id":1,"quantity":2,"unit_price":9.5,"status":"pending"}',
        '{"id":"x","quantity":2}',
        '{"id":3,"quantity":"7","unit_price":"9.5"}',
        '{"id":4,"quantity":2.5}',
        '{"id":4.0,"quantity":2}',
        '{bad', '[]', 'null', '{"id":null}',
        '{"id":6,"extra":{"a":1}}',
        '{"id":7,"status":{"a":1}}',
        '{"id":9,"unit_price":1e2}',
        '{"id":99999999999999999999}',
    ])
    assert rows[0] == (1, 2, 9.5, "pending")
    assert rows[1] == (None, 2, None, None)
    assert rows[2] == (3, 7, 9.5, None)          # numbers in strings are read
    assert rows[3] == (4, None, None, None)      # a true fraction is not an INT
    assert rows[4] == (4, 2, None, None)         # 4.0 is the integer 4
    for r in rows[5:9]:
        assert r == (None, None, None, None)     # malformed -> all NULL
    assert rows[9][0] == 6
    assert rows[10][0] == 7 and rows[10][3] == '{"a":1}'
    assert rows[11] == (9, None, 100.0, None)
    assert rows[12][0] is None                    # overflow -> NULL


def test_tombstone_and_binary_value(spark):
    df = spark.createDataFrame([(None,), (bytearray(b'{"id":5,"__op":"c"}'),)], "value binary")
    rows = parse_change_events(df, ORDERS_WIRE).collect()
    assert all(v is None for v in rows[0])
    assert rows[1]["id"] == 5 and rows[1]["__op"] == "c"


def test_envelope_round_trip(spark):
    row = T.StructType([f for f in ORDERS_WIRE.fields if not f.name.startswith("__")])
    flat = spark.createDataFrame([
        (1, 2, 3, 1, 9.5, None, "pending", "2024-01-01T00:00:00Z", None, "c", "orders", 10),
        (1, None, None, None, None, None, None, None, None, "d", "orders", 20),
        (None, None, None, None, None, None, None, None, None, None, None, None),
    ], ORDERS_WIRE)
    out = unwrap_envelope(to_envelope(flat, row), row).collect()
    assert out[0]["status"] == "pending" and out[0]["__deleted"] == "false"
    assert out[1]["id"] == 1 and out[1]["__op"] == "d" and out[1]["__deleted"] == "true"
    assert all(v is None for v in out[2])


def test_generic_schema_with_nested_and_boolean_fields(spark):
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("ok", T.BooleanType()),
                           T.StructField("tags", T.ArrayType(T.StringType())),
                           T.StructField("attrs", T.StructType([T.StructField("a", T.IntegerType())]))])
    df = spark.createDataFrame([('{"id":"5","ok":"true","tags":["x"],"attrs":{"a":1}}',)], "value string")
    r = parse_json_column(df, "value", schema).collect()[0]
    assert r.id == 5 and r.ok is True and r.tags == ["x"] and r.attrs.a == 1


def test_no_cast_or_parse_of_what_is_no_number_or_object(spark):
    """Failing casts throw inside: texts that can be no number are not cast,
    and what could be one still is."""
    from orderflow.functions.casts import lenient_cast
    texts = ["7", " 7 ", "+7", "-7", "7.0", "7.5", "7e2", "7E-2", "7 pieces", "x7", "[7]", '{"n":7}', "true", "", ".5", "5.", "99999999999999999999",
             "nan", "NaN", "inf", "-Infinity", "1.5d", "1.5f", "0x1p3", None]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(texts)], "i int, x string")
    for to in (T.LongType(), T.IntegerType(), T.DoubleType()):
        cast = lenient_cast(F.col("x"), to)
        if isinstance(to, T.DoubleType):
            plain = F.col("x").try_cast(to)
        else:
            dec = F.col("x").try_cast(T.DecimalType(38, 10))
            plain = F.coalesce(F.col("x").try_cast(to), F.when(dec == F.floor(dec), dec.try_cast(to)))
        out = df.select("x", cast.alias("a"), plain.alias("b"))
        assert out.where(~F.col("a").eqNullSafe(F.col("b"))).collect() == []
        assert "RLIKE" in out._jdf.queryExecution().analyzed().toString()
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("s", T.StringType())])
    lines = ['{"id":1}', ' {"id":2}', '[{"id":3}]', '[3]', "null", '"pending"', "no json", "12", "", "\n\t{\"id\":4}", "-5", "{'id':6}", '{"id":7', None]
    got = parse_json_column(spark.createDataFrame([(x,) for x in lines], "value string"), "value", schema)
    plain = got.sparkSession.createDataFrame([(x,) for x in lines], "value string").select(F.from_json("value", text_schema(schema), _JSON).alias("t"))
    ids = lambda df: sorted(r[0] for r in df.collect() if r[0] is not None)
    assert ids(got) == ids(plain.select(F.col("t.id").try_cast("bigint"))) and got.count() == len(lines)
    assert "RLIKE" in got._jdf.queryExecution().analyzed().toString()
