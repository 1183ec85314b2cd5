"""Checks report violations (orphans, bad values, duplicates, ranges)."""

from pyspark.sql import functions as F

from orderflow.operators import checks as C
from orderflow.plans import models
from orderflow.sources.testdata import customers
from tests.conftest import SF_SMALL


def test_fk_orphans_from_a_filtered_parent(spark):
    stg = models.staged(spark, SF_SMALL)
    parent = customers(spark, SF_SMALL).where(F.col("id") % 2 == 0)   # drop half the customers
    orphans = C.fk_orphans(stg, "customer_id", parent, "id", "orders.customer_id -> customers")
    want = stg.where(F.col("customer_id") % 2 == 1)
    assert orphans.agg(F.sum("n_rows")).first()[0] == want.count()
    assert orphans.count() == want.select("customer_id").distinct().count()
    s = C.fk_summary(stg, "customer_id", parent, "id", "r").first()
    assert s.orphan_rows == want.count() and s.child_rows == stg.count()


def test_accepted_values_and_ranges(spark):
    df = spark.createDataFrame([("pending", 1, 2.0), ("bogus", 0, -1.0), ("bogus", None, None),
                                ("other", 5, 1.0), (None, 1, 1.0)], "status string, quantity int, unit_price double")
    bad = {r.status: r.n_records for r in C.accepted_values_violations(df, "status", ["pending"]).collect()}
    assert bad == {"bogus": 2, "other": 1}                                   # NULL passes
    summary = C.column_tests(df, "m", [("status", "accepted_values", ["pending"]), ("quantity", "not_null", None)])
    got = {(r.column_name, r.test): r.failures for r in summary.collect()}
    assert got == {("status", "accepted_values"): 2, ("quantity", "not_null"): 1}
    rules = {r.rule: r.failures for r in C.range_violations(df, "m", C.range_rules_orders()).collect()}
    assert rules["quantity > 0"] == 1 and rules["unit_price > 0"] == 1      # NULL passes a CHECK
    assert rules["status in accepted"] == 3


def test_unique_and_generated_amount(spark):
    fct = models.fact(spark, SF_SMALL)
    dups = C.unique_violations(fct, ["order_id"])
    assert dups.count() == 5 and dups.agg(F.sum("n")).first()[0] == 10
    assert C.generated_amount_violations(models.staged(spark, SF_SMALL)).count() == 0
