"""History-shaped operators: insert-if-absent (C3), SCD2 validity ranges
(M1) and the as-of join of events to a value history (M2).

All are single-shuffle DataFrame plans keyed on the entity id; none emits
pairs within a key and none collects a group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .heavy import cut_heavy
from .sequence import fill_forward, with_neighbours


def first_per_key(df: DataFrame, keys: list[str], order_cols: list[str]) -> DataFrame:
    """One row per key: the one with the smallest ``order_cols`` (NULLs
    last, then the smallest remaining columns, so the choice is
    deterministic).

    An aggregate (``min`` of a struct led by the order columns), so partial
    aggregation shrinks a hot key map-side before the shuffle.  Each column
    enters the struct as (is NULL, value), which orders NULLs last.
    """
    rest = [c for c in df.columns if c not in keys and c not in order_cols]
    ordered = order_cols + rest
    fields = []
    for i, c in enumerate(ordered):
        fields += [F.col(c).isNull().alias(f"__n{i}"), F.col(c).alias(f"__v{i}")]
    packed = F.min(F.struct(*fields)).alias("__first")
    return (df.groupBy(*keys).agg(packed)
            .select(*keys, *[F.col(f"__first.__v{i}").alias(c) for i, c in enumerate(ordered)])
            .select(*df.columns))


def insert_if_absent(target: DataFrame, new: DataFrame, keys: list[str], order_cols: list[str]) -> DataFrame:
    """``INSERT ... ON CONFLICT (keys) DO NOTHING`` of ``new`` into ``target``.

    Among new rows with the same key the first by ``order_cols`` wins (a
    sequential insert would keep the first); keys already in ``target``
    keep their target row.  Returns the whole resulting table.
    """
    candidates = first_per_key(new.select(*target.columns), keys, order_cols)
    present = target.select(*keys).distinct()
    return target.unionByName(candidates.join(present, keys, "left_anti"))


def scd2_history(df: DataFrame, keys: list[str], ts_col: str, tracked: list[str],
                 tiebreak: list[str] | None = None, skew_safe: bool = False) -> DataFrame:
    """Validity ranges of ``tracked`` values per key.

    Consecutive events with equal tracked values collapse into one version;
    each version is valid from its first event to the next version's start
    (``valid_to`` exclusive, NULL for the current version).  Output:
    ``keys, tracked, valid_from, valid_to, is_current``.  Both neighbour
    steps use :func:`with_neighbours`, with ``skew_safe`` where one key may
    hold a large share of the rows.
    """
    order = [ts_col] + (tiebreak or [])
    base = df.where(F.col(ts_col).isNotNull()).withColumn("__one", F.lit(1))
    seq = with_neighbours(base, keys, order, tracked + ["__one"], prev_prefix="__prev_", skew_safe=skew_safe)
    opens = F.col("__prev___one").isNull()          # first event of the key
    for c in tracked:
        opens = opens | ~F.col(f"__prev_{c}").eqNullSafe(F.col(c))
    versions = seq.where(opens).select(*keys, *tracked, *[c for c in order if c not in keys + tracked])
    nxt = with_neighbours(versions, keys, order, [ts_col], prev_prefix=None, next_prefix="__next_",
                          skew_safe=skew_safe)
    return nxt.select(*keys, *tracked, F.col(ts_col).alias("valid_from"),
                      F.col(f"__next_{ts_col}").alias("valid_to"),
                      F.col(f"__next_{ts_col}").isNull().alias("is_current"))


def history_with_deletes(df: DataFrame, keys: list[str], ts_col: str, tracked: list[str], deleted: Column,
                         tiebreak: list[str] | None = None, skew_safe: bool = False) -> DataFrame:
    """Validity ranges of rows that can be deleted and made anew.

    A delete ends the version before it; until the key is created again it has
    no version, so ranges of a key may have gaps, and a deleted key has no
    current version.  Output as of :func:`scd2_history`.
    """
    marked = df.withColumn("__gone", F.coalesce(deleted, F.lit(False)))
    # values of a deleted row do not matter: consecutive deletes are one
    for c in tracked:
        marked = marked.withColumn(c, F.when(~F.col("__gone"), F.col(c)))
    versions = scd2_history(marked, keys, ts_col, tracked + ["__gone"], tiebreak, skew_safe)
    return versions.where(~F.col("__gone")).drop("__gone")


def with_versions(events: DataFrame, event_ts: str, histories: dict[str, tuple[DataFrame, str, list[str]]],
                  skew_safe: bool = False, heavy: dict[str, list] | None = None) -> DataFrame:
    """Events with the versions of several histories that were valid then.

    ``histories``: name -> (history, key, values); a history has the key under
    its name in ``events``, ``valid_from`` and ``valid_to`` (exclusive, NULL:
    still valid), without overlaps in a key.  Adds ``<name>_<value>`` columns
    and ``<name>_valid_from``, NULL where no version was valid.  Events must
    differ in some column.

    All histories are met in one pass: an event stands once per history, tagged
    with it, among that history's version starts; along each (history, key)
    the last start is carried forward; then the event's copies are put together
    again.  Two shuffles, whatever the number of histories.

    ``heavy``: name -> keys (as of :func:`heavy_keys`) that are to take the
    skew-safe plan where the others need not.
    """
    carried = [f"__v_{name}" for name in histories]
    nulls = {f"__v_{name}": F.lit(None).cast(h.select(F.struct("valid_from", "valid_to", *values).alias("v")).schema["v"].dataType)
             for name, (h, _, values) in histories.items()}
    event = F.struct(*events.columns)
    tags = F.explode(F.array(*[F.struct(F.lit(name).alias("tag"), F.col(key).cast("string").alias("k"))
                               for name, (_, key, _) in histories.items()])).alias("__t")
    rows = events.select(event.alias("__event"), F.col(event_ts).alias("__at"), tags) \
        .select("__event", "__at", "__t.tag", "__t.k", F.lit(1).alias("__side"), *[v.alias(c) for c, v in nulls.items()])
    event_type = rows.schema["__event"].dataType
    for name, (h, key, values) in histories.items():
        start = h.where(F.col("valid_from").isNotNull() & F.col(key).isNotNull()).select(
            F.lit(None).cast(event_type).alias("__event"), F.col("valid_from").alias("__at"), F.lit(name).alias("tag"),
            F.col(key).cast("string").alias("k"), F.lit(0).alias("__side"),
            *[(F.struct("valid_from", "valid_to", *values) if c == f"__v_{name}" else v).alias(c) for c, v in nulls.items()])
        rows = rows.unionByName(start)
    rows = rows.withColumn("__known", F.col("__at").isNotNull())

    def fill(some: DataFrame, safe: bool) -> DataFrame:
        return fill_forward(some, ["tag", "k"], ["__known", "__at", "__side"], carried, skew_safe=safe)

    # the keys of all histories as one, which is NULL for NULL keys: they are heavy together
    cut = [None if k is None else f"{name} {k}" for name, ks in (heavy or {}).items() for k in ks]
    keyed = rows.withColumn("__key", F.concat("tag", F.lit(" "), "k"))
    filled = (fill(rows, True) if skew_safe else cut_heavy(fill, cut, (keyed, "__key"))).where(F.col("__side") == 1)
    picked = []
    for name, (_, key, values) in histories.items():
        v = F.col(f"__v_{name}")
        # a NULL key has no versions; fill_forward meets it as a key like others, in which no version starts
        valid = (F.col("tag") == name) & F.col("__known") & (v["valid_to"].isNull() | (F.col("__at") < v["valid_to"]))
        picked.append(F.max(F.when(valid, v)).alias(f"__v_{name}"))
    together = filled.groupBy("__event").agg(*picked)
    return together.select("__event.*", *[F.col(f"__v_{name}")[c].alias(f"{name}_{c}")
                                          for name, (_, _, values) in histories.items() for c in [*values, "valid_from"]])


def asof_join(events: DataFrame, history: DataFrame, key: str, event_ts: str, valid_from: str,
              values: list[str], skew_safe: bool = False) -> DataFrame:
    """For each event, the ``values`` of the latest history row of the same
    ``key`` with ``valid_from <= event_ts`` (NULL when there is none, or
    when the event time is NULL).

    ``history`` must hold one row per (key, valid_from).  Plan: the two
    sides are unioned and ordered by (key, time, history-before-event), then
    the values are carried forward (:func:`fill_forward`) – one shuffle on
    the key, linear work, no range or cross join; with ``skew_safe`` a hot
    key is cut into range slices.
    """
    ev = events.select(*[F.col(c) for c in events.columns],
                       F.col(key).alias("__k"), F.col(event_ts).isNotNull().alias("__tnn"),
                       F.col(event_ts).alias("__t"), F.lit(1).alias("__side"),
                       *[F.lit(None).cast(history.schema[v].dataType).alias(f"__v_{v}") for v in values],
                       F.lit(None).cast(history.schema[valid_from].dataType).alias("__v_from"))
    hi = history.where(F.col(valid_from).isNotNull()).select(
        *[F.lit(None).cast(events.schema[c].dataType).alias(c) for c in events.columns],
        F.col(key).alias("__k"), F.lit(True).alias("__tnn"), F.col(valid_from).alias("__t"),
        F.lit(0).alias("__side"), *[F.col(v).alias(f"__v_{v}") for v in values],
        F.col(valid_from).alias("__v_from"))
    carried = [f"__v_{v}" for v in values] + ["__v_from"]
    filled = fill_forward(ev.unionByName(hi), ["__k"], ["__tnn", "__t", "__side"], carried,
                          skew_safe=skew_safe)
    return (filled.where(F.col("__side") == 1)
            .select(*events.columns, *[F.col(f"__v_{v}").alias(v) for v in values],
                    F.col("__v_from").alias(valid_from)))


def price_history(lineitem: DataFrame) -> DataFrame:
    """Unit-price history of products derived from sold line items:
    ``(product_id, valid_from, price)``; simultaneous prices of one product
    resolve to the highest (an aggregate, partial before the shuffle)."""
    return (lineitem.select(F.col("l_partkey").alias("product_id"),
                            F.col("l_shipdate").alias("valid_from"),
                            (F.col("l_extendedprice") / F.col("l_quantity")).alias("price"))
            .groupBy("product_id", "valid_from").agg(F.max("price").alias("price")))
