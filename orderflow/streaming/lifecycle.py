"""Illegal status steps found on the stream.

A keyed state machine per order.  Events wait in the state until the
watermark has passed them, so that those that arrive out of order are taken
in order; an event-time timer on the first waiting one releases it.  A step
that the life cycle forbids is emitted when it is taken.  An order without
events for ``idle_ms`` is closed and its state dropped.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.times import EPOCH_NTZ, epoch_ms_of
from ..operators.sequence import STG_TIEBREAK
from ..plans.staging import stg_orders
from ..schemas import ALLOWED_TRANSITIONS

STEP = T.StructType([T.StructField("order_id", T.LongType()), T.StructField("from_status", T.StringType()),
                     T.StructField("to_status", T.StringType()), T.StructField("changed_ms", T.LongType())])
#: By order: [last status taken, its time, waiting events as [time, tie-break, status]].
_STATE = T.StructType([T.StructField("orders", T.StringType())])
_ALLOWED = frozenset(ALLOWED_TRANSITIONS)
#: Neighbouring order ids that share a state row and a timer.
GROUP_ORDERS = 256


def _in_order(event: list) -> tuple:
    """Nulls of the tie-break sort last within each column."""
    return event[0], [(x is None, 0 if x is None else x) for x in event[1]]


def _machine(idle_ms: int):
    def run(key: tuple, batches: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        held = json.loads(state.get[0]) if state.exists else {}
        mark = state.getCurrentWatermarkMs()
        for b in batches:  # none when a timer runs out
            for order, t, tie, status in zip(b["order_id"].tolist(), b["ms"].tolist(), b["tie"].tolist(), b["status"].tolist()):
                held.setdefault(str(order), [None, None, []])[2].append([int(t), json.loads(tie), status if isinstance(status, str) else None])
        steps, timers = [], []
        for order in list(held):
            status, at, waiting = held[order]
            waiting.sort(key=_in_order)
            n = 0
            while n < len(waiting) and waiting[n][0] < mark:
                t, _, now = waiting[n]
                if status is not None and now is not None and now != status and (status, now) not in _ALLOWED:
                    steps.append((int(order), status, now, t))
                status, at, n = now, t, n + 1
            held[order] = [status, at, waiting[n:]]
            if n < len(waiting):
                timers.append(waiting[n][0])
            elif at + idle_ms <= mark:
                del held[order]
            else:
                timers.append(at + idle_ms)
        if held:
            state.update((json.dumps(held),))
            state.setTimeoutTimestamp(max(min(timers), mark) + 1)
        elif state.exists:
            state.remove()
        if steps:
            yield pd.DataFrame(steps, columns=STEP.names)

    return run


def illegal_steps(processed: DataFrame, watermark: str = "1 day", idle_days: int = 365) -> DataFrame:
    """A stream of processed rows -> the forbidden status steps (append mode).

    Events later than the watermark are taken after those that have already
    been: choose it as long as events may be out of order.  As in the batch
    form, an event that repeats the status is no step, a null status is no
    step and none follows it.
    """
    stg = stg_orders(processed).where(F.col("processed_at").isNotNull())
    ms = epoch_ms_of(F.col("processed_at"))
    micros = lambda c: F.timestamp_diff("MICROSECOND", EPOCH_NTZ(), F.col(c))
    exact = {"unit_price": (F.col("unit_price") * 100).cast("bigint"), "created_at": micros("created_at"), "updated_at": micros("updated_at")}
    tie = F.concat(F.lit("["), F.concat_ws(",", *[F.coalesce(_as_json(exact.get(c, F.col(c)), c), F.lit("null")) for c in STG_TIEBREAK]), F.lit("]"))
    rows = stg.select(F.floor(F.col("order_id") / GROUP_ORDERS).alias("group"), "order_id", F.timestamp_millis(ms).alias("event_time"),
                      ms.alias("ms"), tie.alias("tie"), "status")
    return rows.withWatermark("event_time", watermark).groupBy("group").applyInPandasWithState(
        _machine(idle_days * 86_400_000), STEP, _STATE, "append", "EventTimeTimeout")


def _as_json(value, column: str):
    """A number as it is, text quoted and escaped."""
    if column in ("status", "operation_type"):
        return F.when(value.isNotNull(), F.regexp_extract(F.to_json(F.struct(value.alias("v"))), r'^\{"v":(.*)\}$', 1))
    return value.cast("string")
