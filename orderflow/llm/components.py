"""Connected components by alternating large and small stars.

Each round is two grouped minima and two joins on the edge table; the edges
stay distributed and every round is written to the shared folder, so a lost
executor costs at most one round.  The driver sees two numbers a round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderflow.llm.common import stored


def _towards_minimum(edges: DataFrame, only_larger: bool) -> DataFrame:
    """For each vertex ``u``: its neighbours ``v`` point to the smallest of
    ``u`` and its neighbours.  Large star: neighbours above ``u``, from edges
    in both directions; small star: neighbours below, from edges u > v."""
    low = edges.groupBy("u").agg(F.min("v").alias("low"))
    met = edges.join(low, "u").withColumn("low", F.least("u", "low"))
    moved = met.where(F.col("v") > F.col("u")) if only_larger else met
    out = moved.select(F.col("v").alias("u"), F.col("low").alias("v"))
    if not only_larger:
        out = out.unionByName(low.select("u", F.col("low").alias("v")))
    return out.where("u <> v").distinct()


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(vertex, component) for every vertex with a link to another one;
    component is the smallest vertex it reaches.  Vertices are bigint; null
    ends and self links are ignored; no edges give no rows."""
    e = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")) \
        .where(f"{a} is not null and {b} is not null and {a} <> {b}").distinct()
    e = stored(e, "edges")
    seen = None
    while True:
        now = tuple(e.agg(F.count("*"), F.coalesce(F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")),
                                                   F.lit(0))).first())
        if now == seen or now[0] == 0:
            break
        seen = now
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        e = stored(_towards_minimum(_towards_minimum(both, True), False), "stars")
    member = e.select(F.col("u").alias("vertex"), F.col("v").alias("component"))
    return member.unionByName(e.select(F.col("v").alias("vertex"), F.col("v").alias("component")).distinct())
