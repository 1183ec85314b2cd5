"""Structured Streaming: stream = batch, replay, restart, windowed counts."""

import os

from pyspark.sql import functions as F

from orderflow.plans import marts, models
from orderflow.sources.testdata import order_feed, to_topic_records
from orderflow.sources.wire import read_processed
from orderflow.streaming.ingest import decode_stream, file_records, ingest_stream
from orderflow.streaming.lifecycle import illegal_steps
from orderflow.streaming.state import append_latest, metric_changes, metrics_of_changes, read_metrics, read_state, state_stream
from orderflow.streaming.windows import change_counts
from tests.conftest import SF_SMALL

AVAILABLE_NOW = {"availableNow": True}


def _write_record_parts(spark, base, parts, which):
    """Cut the feed's topic records into ``parts`` groups by a hash of the
    whole record (so files are not in time order) and write some of them."""
    rec = to_topic_records(order_feed(spark, SF_SMALL)) \
        .withColumn("partition", F.lit(0)).withColumn("offset", F.lit(None).cast("bigint"))
    g = F.pmod(F.xxhash64("key", "value", "timestamp"), F.lit(parts))
    for k in which:
        rec.where(g == k).coalesce(1).write.json(os.path.join(base, f"part={k}"))


def _rows(df, cols=None):
    cols = cols or df.columns
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=repr)


def test_ingest_equals_batch_and_restarts(spark, tmp_dir):
    src, out, ck = (os.path.join(tmp_dir, x) for x in ("src", "out", "ck"))
    _write_record_parts(spark, src, 4, [0, 1])
    recs = lambda: file_records(spark, os.path.join(src, "*", "*.json"))
    q = ingest_stream(recs(), out, ck, trigger=AVAILABLE_NOW)
    q.awaitTermination()
    first = read_processed(spark, out).count()
    _write_record_parts(spark, src, 4, [2, 3])           # more data arrives, job restarts
    q = ingest_stream(recs(), out, ck, trigger=AVAILABLE_NOW)
    q.awaitTermination()
    got = read_processed(spark, out)
    want = models.processed_events(spark, SF_SMALL)
    assert 0 < first < got.count()
    assert _rows(got) == _rows(want)                       # no loss, no duplicates


def test_state_stream_equals_batch_replay_safe(spark, tmp_dir):
    src, ck, root = (os.path.join(tmp_dir, x) for x in ("src", "ck", "state"))
    _write_record_parts(spark, src, 5, range(5))
    stream = lambda: decode_stream(file_records(spark, os.path.join(src, "*", "*.json"), max_files_per_trigger=1))
    state_stream(stream(), root, ck, trigger=AVAILABLE_NOW).awaitTermination()
    fct_b = models.fact(spark, SF_SMALL)
    assert _rows(read_state(spark, root), fct_b.columns) == _rows(fct_b)
    met_b = marts.fct_order_metrics(fct_b)
    assert _rows(read_metrics(spark, root), met_b.columns) == _rows(met_b)

    # a fresh checkpoint on the old root reads everything again: nothing is lost, nothing comes twice
    state_stream(stream(), root, ck + "2", trigger=AVAILABLE_NOW).awaitTermination()
    assert len(os.listdir(root)) == 2
    assert _rows(read_state(spark, root), fct_b.columns) == _rows(fct_b)


def test_replayed_and_late_batches_converge(spark, tmp_dir):
    from orderflow.schemas import ORDERS_PROCESSED
    row = lambda status, ts: (1, 1, 1, 1, 10.0, None, status, "UPDATE",
                              "2024-01-01T10:00:00Z", None, ts)
    batches = [[row("pending", 1)], [row("cancelled", 2), row("cancelled", 2)], [row("confirmed", 0)]]
    root = os.path.join(tmp_dir, "s")
    for i, rows in [*enumerate(batches), (1, batches[1])]:          # the second once more
        append_latest(spark.createDataFrame(rows, ORDERS_PROCESSED), i, root, "one")
    m = read_metrics(spark, root).collect()
    assert len(m) == 1 and m[0].pending_orders == 0 and m[0].cancelled_orders == 2  # ties stay, replays add none
    assert m[0].cancellation_rate_pct == 100.0


def test_metric_changes_retract_what_they_replace(spark, tmp_dir):
    """Batch by batch, the sums equal the KPIs of what has come so far."""
    from orderflow.plans.staging import stg_orders
    from orderflow.schemas import ORDERS_PROCESSED
    from orderflow.streaming.ingest import processed_stream
    src, ck, out = (os.path.join(tmp_dir, x) for x in ("src", "ck", "out"))
    proc = models.processed_events(spark, SF_SMALL).where("id < 3000")
    part = F.pmod(F.xxhash64(*proc.columns), F.lit(3))
    for i in range(3):
        proc.where(part == i).coalesce(1).write.mode("append").parquet(src)
        changes = metric_changes(processed_stream(spark, src))
        changes.writeStream.format("parquet").outputMode("append").option("checkpointLocation", ck) \
            .trigger(availableNow=True).start(out).awaitTermination()
        want = marts.fct_order_metrics(marts.fct_orders(stg_orders(spark.read.schema(ORDERS_PROCESSED).parquet(src))))
        got = metrics_of_changes(spark.read.parquet(out)).where("total_orders <> 0")
        assert _rows(got, want.columns) == _rows(want)


def _processed(spark, rows):
    """(id, status, ms) -> processed rows."""
    from orderflow.schemas import ORDERS_PROCESSED
    return spark.createDataFrame([(i, 1, 1, 1, 1.0, None, s, "UPDATE", None, None, ms) for i, s, ms in rows], ORDERS_PROCESSED)


def test_steps_are_taken_in_order_and_idle_orders_close(spark, tmp_dir):
    from orderflow.streaming.ingest import processed_stream
    day = 86_400_000
    src, ck, out = (os.path.join(tmp_dir, x) for x in ("src", "ck", "out"))
    arrivals = [[(1, "confirmed", 2 * day), (1, "pending", 1 * day), (2, "pending", 1 * day)],       # out of order
                [(1, "delivered", 4 * day), (1, "shipped", 3 * day), (2, "shipped", 3 * day)],
                [(9, None, 1000 * day)], [(9, None, 2000 * day)]]
    open_orders = []
    for rows in arrivals:
        _processed(spark, rows).coalesce(1).write.mode("append").parquet(src)
        q = (illegal_steps(processed_stream(spark, src), "5 days", idle_days=100).writeStream.format("parquet").outputMode("append")
             .option("checkpointLocation", ck).trigger(availableNow=True).start(out))
        q.awaitTermination()
        open_orders.append(q.lastProgress["stateOperators"][0]["numRowsTotal"])
    assert [tuple(r) for r in spark.read.parquet(out).collect()] == [(2, "pending", "shipped", 3 * day)]
    assert open_orders[-1] == 1          # of all orders only the heartbeat's group is held


def test_late_rows_are_counted_and_windows_evicted(spark, tmp_dir):
    from orderflow.streaming.ingest import processed_stream
    from orderflow.streaming.windows import late_groups
    hour = 3_600_000
    src, ck, out = (os.path.join(tmp_dir, x) for x in ("src", "ck", "out"))
    arrivals = [[(1, "x", h * hour) for h in range(48)], [(1, "x", 100 * hour)], [(1, "x", 5 * hour), (1, "x", 101 * hour)]]
    late, state = 0, []
    for rows in arrivals:
        _processed(spark, rows).coalesce(1).write.mode("append").parquet(src)
        q = (change_counts(processed_stream(spark, src), "1 hour", "2 hours").writeStream.format("parquet").outputMode("append")
             .option("checkpointLocation", ck).trigger(availableNow=True).start(out))
        q.awaitTermination()
        late += late_groups(q)
        state.append(q.lastProgress["stateOperators"][0]["numRowsTotal"])
    assert late == 1                                  # the event of hour 5 came behind the watermark
    assert state[0] > state[1] == 1                   # 48 windows, then all but the newest are gone
    got = {r.window_start.hour + 24 * (r.window_start.day - 1): r.changes for r in spark.read.parquet(out).collect()}
    assert got == {h: 1 for h in range(48)}           # each window once, the late event in none


def _killed(spark, make, check):
    """Run ``make(fail)`` with a failure, then without."""
    import pytest
    with pytest.raises(Exception):
        make(True)
    make(False)
    check()


def test_file_sink_restarts_in_the_middle_of_a_batch(spark, tmp_dir):
    src, out, ck = (os.path.join(tmp_dir, x) for x in ("src", "out", "ck"))
    _write_record_parts(spark, src, 3, range(3))
    poison = F.when(F.col("value").contains('"id":7,'), F.raise_error(F.lit("killed")).cast("string")).otherwise(F.col("value"))

    def make(fail):
        recs = file_records(spark, os.path.join(src, "*", "*.json"))
        recs = recs.withColumn("value", poison) if fail else recs
        ingest_stream(recs, out, ck, trigger=AVAILABLE_NOW).awaitTermination()

    want = _rows(models.processed_events(spark, SF_SMALL))
    _killed(spark, make, lambda: None)
    assert _rows(read_processed(spark, out)) == want
    # killed between the sink's log and the checkpoint's: the batch runs again, the sink knows it
    commits = os.path.join(ck, "commits")
    for name in [n for n in os.listdir(commits) if n.lstrip(".").split(".")[0].isdigit()]:
        os.unlink(os.path.join(commits, name))
    make(False)
    assert _rows(read_processed(spark, out)) == want


def test_foreach_batch_restarts_between_data_and_commit(spark, tmp_dir, monkeypatch):
    from orderflow.streaming import state as S
    src, ck, root = (os.path.join(tmp_dir, x) for x in ("src", "ck", "state"))
    _write_record_parts(spark, src, 3, range(3))
    real = S.append_latest

    def make(fail):
        def append(batch, batch_id, *a, **k):
            real(batch, batch_id, *a, **k)
            if fail and batch_id == 1:
                raise RuntimeError("killed after the data, before the commit")
        monkeypatch.setattr(S, "append_latest", append)
        state_stream(decode_stream(file_records(spark, os.path.join(src, "*", "*.json"), max_files_per_trigger=1)), root, ck,
                     trigger=AVAILABLE_NOW).awaitTermination()

    fct = models.fact(spark, SF_SMALL)

    def check():
        assert len(os.listdir(root)) == 1             # the same stream, by its checkpoint
        assert _rows(read_state(spark, root), fct.columns) == _rows(fct)

    _killed(spark, make, check)


def test_windowed_change_counts_stream_and_batch(spark, tmp_dir):
    src, ck = os.path.join(tmp_dir, "src"), os.path.join(tmp_dir, "ck")
    _write_record_parts(spark, src, 2, [0, 1])
    stream = change_counts(decode_stream(file_records(spark, os.path.join(src, "*", "*.json"))),
                           "1 day", "3650 days")
    q = (stream.writeStream.format("memory").queryName("cc").outputMode("update")
         .option("checkpointLocation", ck).trigger(availableNow=True).start())
    q.awaitTermination()
    got = spark.sql("select window_start, operation, max(changes) as changes from cc "
                    "group by window_start, operation")
    want = change_counts(models.processed_events(spark, SF_SMALL), "1 day", "3650 days")
    assert _rows(got) == _rows(want.select("window_start", "operation", "changes"))


def test_ingest_then_state_stream_end_to_end(spark, tmp_dir):
    from orderflow.streaming.ingest import processed_stream
    src, out, ck1, ck2, root = (os.path.join(tmp_dir, x) for x in ("src", "out", "ck1", "ck2", "st"))
    _write_record_parts(spark, src, 3, range(3))
    ingest_stream(file_records(spark, os.path.join(src, "*", "*.json"), max_files_per_trigger=1),
                  out, ck1, trigger=AVAILABLE_NOW).awaitTermination()
    state_stream(processed_stream(spark, out, max_files_per_trigger=1), root, ck2, trigger=AVAILABLE_NOW).awaitTermination()
    fct_b = models.fact(spark, SF_SMALL)
    assert _rows(read_state(spark, root), fct_b.columns) == _rows(fct_b)
    met_b = marts.fct_order_metrics(fct_b)
    assert _rows(read_metrics(spark, root), met_b.columns) == _rows(met_b)


def test_json_sink_and_missing_kafka_connector(spark, tmp_dir):
    import pytest
    from orderflow.streaming.ingest import kafka_records
    src, out, ck = (os.path.join(tmp_dir, x) for x in ("src", "out", "ck"))
    _write_record_parts(spark, src, 2, [0, 1])
    ingest_stream(file_records(spark, os.path.join(src, "*", "*.json")), out, ck, fmt="json",
                  trigger=AVAILABLE_NOW).awaitTermination()
    got = read_processed(spark, out, fmt="json")
    want = models.processed_events(spark, SF_SMALL)
    assert _rows(got) == _rows(want)
    with pytest.raises(RuntimeError, match="Kafka connector"):
        kafka_records(spark, "localhost:9")


def test_streaming_aggregation_latest_state(spark, tmp_dir):
    from orderflow.operators.latest import latest_rows
    from orderflow.streaming.latest import ORDER_TIEBREAK, latest_state_updates
    src, ck = os.path.join(tmp_dir, "src"), os.path.join(tmp_dir, "ck")
    _write_record_parts(spark, src, 3, range(3))
    stream = latest_state_updates(decode_stream(file_records(spark, os.path.join(src, "*", "*.json"),
                                                             max_files_per_trigger=1)))
    q = (stream.writeStream.outputMode("update").format("memory").queryName("latest_upd")
         .option("checkpointLocation", ck).trigger(availableNow=True).start())
    q.awaitTermination()
    # last upsert per order = final state
    upd = spark.sql("select * from latest_upd")
    final = latest_rows(upd, ["order_id"], "processed_at", on_tie="one", tiebreak=ORDER_TIEBREAK)
    want = latest_rows(models.staged(spark, SF_SMALL), ["order_id"], "processed_at", on_tie="one",
                       tiebreak=ORDER_TIEBREAK)
    cols = ["order_id"] + ORDER_TIEBREAK + ["processed_at"]
    assert _rows(final, cols) == _rows(want, cols)


def test_every_status_is_returned(spark):
    from orderflow.plans import panels

    fct = spark.range(1000).selectExpr("id AS order_id", "concat('junk-', id) AS status", "CAST(id AS DECIMAL(10,2)) AS total_amount")
    rows = panels.status_revenue(fct).collect()
    assert len(rows) == 1000 and [r.status for r in rows] == sorted(r.status for r in rows)


class _State:
    """What a state function sees of its group's state."""

    def __init__(self):
        self.exists, self.get = False, None

    def update(self, row):
        self.exists, self.get = True, row


def test_group_state_holds_the_latest_rows_of_many_orders():
    """One call for thousands of orders; the changes sum up to the latest rows."""
    import collections
    import random

    import pandas as pd

    from orderflow.streaming.state import GROUP_ORDERS, _replace_latest
    assert GROUP_ORDERS >= 1024
    rng, state, seen, sums = random.Random(1), _State(), [], collections.Counter()
    for n in (3000, 1, 2500, 500):
        rows = [(rng.randrange(700), rng.randrange(6), rng.choice([None, 3_600_000]), rng.choice([None, "pending", "cancelled"]),
                 rng.choice([None, 5, 7])) for _ in range(n)]
        seen += rows
        frames = [pd.DataFrame(rows[i::2], columns=["order_id", "at", "hour_ms", "status", "cents"]) for i in range(2)]
        for out in _replace_latest((0,), iter(frames), state):
            for *row, sign in out.astype(object).where(out.notna(), None).itertuples(index=False):
                sums[tuple(row)] += sign
        last = {}
        for order, at, *_ in seen:
            last[order] = max(at, last.get(order, at))
        wanted = collections.Counter(tuple(r[2:]) for r in seen if r[1] == last[r[0]])
        assert {k: v for k, v in sums.items() if v} == wanted
    assert isinstance(state.get[0], bytes)


def test_records_are_written_compressed(spark, tmp_dir):
    from orderflow.streaming.ingest import file_records, write_records
    records = models.topic_records(spark, SF_SMALL).withColumn("partition", F.lit(0)).withColumn("offset", F.lit(None).cast("bigint"))
    import __spark_entry__ as entry
    for query in (entry.q_stream_ingest, entry.q_compact_processed):
        assert "write_records" in query.__code__.co_names
    write_records(records, tmp_dir + "/records")
    raw = records.select(F.sum(F.length("value") + F.length("key"))).collect()[0][0]
    written = sum(os.path.getsize(f"{tmp_dir}/records/{f}") for f in os.listdir(tmp_dir + "/records"))
    assert written < raw / 2
    read = spark.read.schema(file_records(spark, tmp_dir + "/records").schema).json(tmp_dir + "/records")
    assert _rows(read, ["key", "value", "topic"]) == _rows(records, ["key", "value", "topic"])


def test_micro_batches_do_not_follow_the_number_of_files(spark, tmp_dir):
    import __spark_entry__ as entry
    proc = models.processed_events(spark, SF_SMALL).limit(2000).repartition(20)
    proc.withColumn("slice", F.pmod(F.xxhash64(*proc.columns), F.lit(4))).write.partitionBy("slice").parquet(tmp_dir + "/in")
    seen = []
    (entry._sliced_stream(spark, tmp_dir + "/in").writeStream.foreachBatch(lambda b, i: seen.append(b.count()))
     .option("checkpointLocation", tmp_dir + "/ck").trigger(**AVAILABLE_NOW).start().awaitTermination())
    assert sum(seen) == 2000 and 2 <= len(seen) <= 4
