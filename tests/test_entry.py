"""The driver contract of __spark_entry__.py."""

import __spark_entry__ as E


def test_contract_keys_and_flagship(spark):
    assert set(E._QUERIES) == set(E._SQL)  # each of the reference's operators has its SQL
    assert set(E._CORPUS_SQL) <= set(E._CORPUS_QUERIES)
    assert set(E.oracle_sql()) <= set(E.queries())
    df = E.entry(spark)
    assert [f.name for f in df.schema.fields] == ["status", "orders", "revenue"]
    rows = {r.status: (r.orders, r.revenue) for r in df.collect()}
    # fixture values of the flagship at sf0.001 (FIXTURES.md)
    assert rows == {"pending": (444, 586613326.30), "delivered": (388, 555711001.75),
                    "cancelled": (236, 349960084.93), "shipped": (201, 260942556.65),
                    "confirmed": (191, 243384750.35)}
