"""Data-quality checks (J1-J7, C2) as DataFrames.

A check never collects rows: it returns a DataFrame of results and only its
(small) summary is ever brought to the driver by ``failed_checks``.

Summary rows have the columns ``(model, column_name, test, failures)``;
``failures`` counts what the test's query returns, as in the reference's
data tests: NULL rows for ``not_null``, distinct bad values for
``accepted_values`` (NULL passes), duplicated keys for ``unique`` (NULL
ignored).  All column tests of one model run in one aggregation pass.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import OPERATION_TYPES, ORDER_STATUSES

SUMMARY = "model string, column_name string, test string, failures bigint"

# The reference's declared tests: (model, column, test, accepted values).
DECLARED_TESTS = [
    ("stg_orders", "order_id", "not_null", None),
    ("stg_orders", "status", "not_null", None),
    ("stg_orders", "status", "accepted_values", ORDER_STATUSES),
    ("stg_orders", "operation_type", "not_null", None),
    ("stg_orders", "operation_type", "accepted_values", OPERATION_TYPES),
    ("stg_orders", "unit_price", "not_null", None),
    ("stg_orders", "total_amount", "not_null", None),
    ("fct_orders", "order_id", "unique", None),
    ("fct_orders", "order_id", "not_null", None),
    ("fct_orders", "is_terminal_state", "not_null", None),
]


def _summary_row(model: str, column: str, test: str, failures: Column) -> Column:
    return F.struct(F.lit(model).alias("model"), F.lit(column).alias("column_name"),
                    F.lit(test).alias("test"), failures.cast("bigint").alias("failures"))


def column_tests(df: DataFrame, model: str, tests: list[tuple[str, str, list | None]]) -> DataFrame:
    """not_null and accepted_values tests of one model in a single pass.

    ``accepted_values`` counts distinct bad values; distinct counting is
    done by a partial aggregate on the (few) offending values only.
    """
    row_tests = [(c, t, v) for c, t, v in tests if t in ("not_null", "accepted_values")]
    structs = []
    for c, t, vals in row_tests:
        if t == "not_null":
            failures = F.count_if(F.col(c).isNull())
        else:
            bad = F.when(~F.col(c).isin(*vals), F.col(c))
            failures = F.count_distinct(bad)
        structs.append(_summary_row(model, c, t, failures))
    agg = df.agg(F.array(*structs).alias("r"))
    return agg.select(F.inline("r"))


def unique_violations(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys occurring more than once (NULL keys ignored), with their count.

    Partial aggregation runs map-side, so a hot key is pre-counted in every
    task before the shuffle.
    """
    nn = df
    for k in keys:
        nn = nn.where(F.col(k).isNotNull())
    return (nn.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
            .where(F.col("n") > 1))


def unique_test(df: DataFrame, model: str, column: str) -> DataFrame:
    v = unique_violations(df, [column])
    return v.agg(F.count(F.lit(1)).alias("failures")).select(
        F.lit(model).alias("model"), F.lit(column).alias("column_name"),
        F.lit("unique").alias("test"), F.col("failures").cast("bigint"))


def unique_keys(tables: dict[str, tuple[DataFrame, list[str]]]) -> DataFrame:
    """Values that occur more than once in columns that must be unique, over
    several tables: ``(model, column_name, key, n)``.

    ``tables``: name -> (table, columns).  Each row gives its keys as tagged
    text, NULL ones left out; one grouped count finds the repeated keys of all
    columns of all tables in one shuffle, counted in every task before it.
    """
    keys = None
    for model, (df, columns) in tables.items():
        tagged = F.explode(F.array(*[F.struct(F.lit(model).alias("model"), F.lit(c).alias("column_name"),
                                              F.col(c).cast("string").alias("key")) for c in columns])).alias("t")
        part = df.select(tagged).select("t.*").where(F.col("key").isNotNull())
        keys = part if keys is None else keys.unionByName(part)
    return keys.groupBy("model", "column_name", "key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)


def accepted_values_violations(df: DataFrame, column: str, values: list) -> DataFrame:
    """The offending values with their row counts (NULL passes)."""
    return (df.where(~F.col(column).isin(*values))
            .groupBy(column).agg(F.count(F.lit(1)).alias("n_records")))


def run_declared_tests(stg: DataFrame, fct: DataFrame) -> DataFrame:
    """All ten declared tests: one pass over each model plus one grouped
    count for ``unique``."""
    out = None
    for model, df in (("stg_orders", stg), ("fct_orders", fct)):
        tests = [(c, t, v) for m, c, t, v in DECLARED_TESTS if m == model]
        parts = [column_tests(df, model, tests)]
        parts += [unique_test(df, model, c) for c, t, _ in tests if t == "unique"]
        for p in parts:
            out = p if out is None else out.unionByName(p)
    return out


def failed_checks(summary: DataFrame) -> list[tuple]:
    """The failing summary rows (small: one per declared test)."""
    return [tuple(r) for r in summary.where(F.col("failures") > 0).collect()]


# --- source constraints ------------------------------------------------------

def range_rules_orders() -> dict[str, Column]:
    """CHECK constraints of the orders table (NULL passes a CHECK)."""
    return {
        "quantity > 0": F.col("quantity") > 0,
        "unit_price > 0": F.col("unit_price") > 0,
        "status in accepted": F.col("status").isin(*ORDER_STATUSES),
    }


def range_rules_products() -> dict[str, Column]:
    return {"price > 0": F.col("price") > 0, "stock_quantity >= 0": F.col("stock_quantity") >= 0}


def range_violations(df: DataFrame, model: str, rules: dict[str, Column]) -> DataFrame:
    """Rows breaking each rule, counted in one pass: ``(model, rule, failures)``.
    A rule evaluating to NULL passes, like a SQL CHECK constraint."""
    structs = [F.struct(F.lit(model).alias("model"), F.lit(name).alias("rule"),
                        F.count_if(~F.coalesce(cond, F.lit(True))).cast("bigint").alias("failures"))
               for name, cond in rules.items()]
    return df.agg(F.array(*structs).alias("r")).select(F.inline("r"))


def generated_amount_violations(stg: DataFrame) -> DataFrame:
    """Rows whose ``total_amount`` differs from ``quantity * unit_price``
    computed exactly in DECIMAL (the source's generated column)."""
    exact = (F.col("quantity").cast(T.DecimalType(10, 0)) * F.col("unit_price"))
    bad = F.col("total_amount").isNull() != exact.isNull()
    bad = bad | (F.col("total_amount") != exact)
    return stg.where(F.coalesce(bad, F.lit(False)))


def fk_orphans(child: DataFrame, fk: str, parent: DataFrame, pk: str, relation: str) -> DataFrame:
    """Foreign-key check: child keys without a parent row.

    The child side is first reduced to its distinct keys with a row count
    (partial aggregation, so a hot key costs one row per map task), then
    anti-joined to the parent keys.  No broadcast hint: the planner picks
    a broadcast only from the measured size of the reduced sides.
    Result: ``(relation, key, n_rows)`` per orphan key.
    """
    keys = (child.where(F.col(fk).isNotNull())
            .groupBy(F.col(fk).alias("key")).agg(F.count(F.lit(1)).alias("n_rows")))
    parents = parent.select(F.col(pk).alias("key")).distinct()
    return keys.join(parents, "key", "left_anti").select(F.lit(relation).alias("relation"), "key", "n_rows")


def fk_summary(child: DataFrame, fk: str, parent: DataFrame, pk: str, relation: str) -> DataFrame:
    """One row per relation: referencing rows, orphan keys, orphan rows –
    one left join of the reduced child keys to the distinct parent keys."""
    keys = (child.where(F.col(fk).isNotNull())
            .groupBy(F.col(fk).alias("key")).agg(F.count(F.lit(1)).alias("n_rows")))
    parents = parent.select(F.col(pk).alias("key")).distinct().withColumn("__present", F.lit(True))
    j = keys.join(parents, "key", "left")
    missing = F.col("__present").isNull()
    return j.agg(
        F.coalesce(F.sum("n_rows"), F.lit(0)).cast("bigint").alias("child_rows"),
        F.count_if(missing).cast("bigint").alias("orphan_keys"),
        F.coalesce(F.sum(F.when(missing, F.col("n_rows"))), F.lit(0)).cast("bigint").alias("orphan_rows"),
    ).select(F.lit(relation).alias("relation"), "child_rows", "orphan_keys", "orphan_rows")


def fk_summaries(child: DataFrame, specs: list[tuple[str, DataFrame, str, str]]) -> DataFrame:
    """Several foreign keys of one child table in one pass over it.

    ``specs`` = [(fk column, parent DataFrame, parent key, relation name)].
    Each child row is exploded into one (relation, key) per foreign key and
    reduced by a partial aggregate; the tagged parent keys are unioned; one
    left join on (relation, key) and one aggregate give the summary rows of
    :func:`fk_summary`.
    """
    tagged = F.explode(F.array(*[F.struct(F.lit(rel).alias("relation"), F.col(fk).cast("bigint").alias("key"))
                                 for fk, _, _, rel in specs])).alias("t")
    keys = (child.select(tagged).select("t.relation", "t.key").where(F.col("key").isNotNull())
            .groupBy("relation", "key").agg(F.count(F.lit(1)).alias("n_rows")))
    parents = None
    for _, parent, pk, rel in specs:
        p = parent.select(F.lit(rel).alias("relation"), F.col(pk).cast("bigint").alias("key"))
        parents = p if parents is None else parents.unionByName(p)
    parents = parents.distinct().withColumn("__present", F.lit(True))
    missing = F.col("__present").isNull()
    return (keys.join(parents, ["relation", "key"], "left").groupBy("relation").agg(
        F.sum("n_rows").cast("bigint").alias("child_rows"),
        F.count_if(missing).cast("bigint").alias("orphan_keys"),
        F.coalesce(F.sum(F.when(missing, F.col("n_rows"))), F.lit(0)).cast("bigint").alias("orphan_rows")))
