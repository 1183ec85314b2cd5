"""Command line: the jobs a user of the pipeline runs.

    python -m orderflow ingest  --records DIR [--kafka SERVERS] --out DIR --checkpoint DIR [--once]
    python -m orderflow state   --processed DIR --root DIR --checkpoint DIR [--once]
    python -m orderflow build   --processed DIR --root DIR [--allow-duplicate-keys]
    python -m orderflow metric  NAME --root DIR [--start TS] [--end TS]

Works the same under ``spark-submit`` (the session comes from the launcher;
``--local N`` starts a local one).
"""

from __future__ import annotations

import argparse
import sys

from .session import get_spark


def _trigger(once: bool) -> dict:
    return {"availableNow": True} if once else {"processingTime": "60 seconds"}


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="orderflow")
    ap.add_argument("--local", type=int, default=None, help="run on local[N]")
    ap.add_argument("--profile", default="local", choices=["local", "cluster"])
    sub = ap.add_subparsers(dest="cmd", required=True)

    p = sub.add_parser("ingest", help="topic records -> processed change files")
    p.add_argument("--records", help="folder of topic-shaped JSON records (replay / tests)")
    p.add_argument("--kafka", help="bootstrap servers (needs the Kafka connector)")
    p.add_argument("--topic", default=None)
    p.add_argument("--out", required=True)
    p.add_argument("--checkpoint", required=True)
    p.add_argument("--format", default="parquet", choices=["parquet", "json"])
    p.add_argument("--once", action="store_true", help="process what is there, then stop")

    p = sub.add_parser("state", help="processed files -> latest state, batch by batch")
    p.add_argument("--processed", required=True)
    p.add_argument("--root", required=True)
    p.add_argument("--checkpoint", required=True)
    p.add_argument("--once", action="store_true")

    p = sub.add_parser("build", help="rebuild staging, fact and metrics; test; publish")
    p.add_argument("--processed", required=True)
    p.add_argument("--root", required=True)
    p.add_argument("--allow-duplicate-keys", action="store_true",
                   help="publish although tied latest events make order_id non-unique")

    p = sub.add_parser("metric", help="print a dashboard metric of the published marts")
    p.add_argument("name")
    p.add_argument("--root", required=True)
    p.add_argument("--start")
    p.add_argument("--end")

    a = ap.parse_args(argv)
    spark = get_spark(f"local[{a.local}]" if a.local else None, a.local, profile=a.profile)

    if a.cmd == "ingest":
        from .schemas import ORDERS_TOPIC
        from .streaming.ingest import file_records, ingest_stream, kafka_records
        if a.kafka:
            recs = kafka_records(spark, a.kafka, a.topic or ORDERS_TOPIC)
        elif a.records:
            recs = file_records(spark, a.records)
        else:
            ap.error("ingest needs --records or --kafka")
        ingest_stream(recs, a.out, a.checkpoint, fmt=a.format, trigger=_trigger(a.once)).awaitTermination()
    elif a.cmd == "state":
        from .streaming.ingest import processed_stream
        from .streaming.state import state_stream
        state_stream(processed_stream(spark, a.processed), a.root, a.checkpoint,
                     trigger=_trigger(a.once)).awaitTermination()
    elif a.cmd == "build":
        from .plans.build import build_marts
        from .sources.wire import read_processed
        allow = (lambda r: r[2] == "unique") if a.allow_duplicate_keys else (lambda r: False)
        res = build_marts(spark, read_processed(spark, a.processed), a.root, allow=allow)
        for f in res.failures:
            print("FAILED", *f)
        print("published" if res.published else "not published", res.paths)
        return 0 if res.published else 1
    elif a.cmd == "metric":
        from .plans import panels
        from .plans.build import read_mart
        fct = read_mart(spark, a.root, "fct_orders", a.start, a.end)
        met = read_mart(spark, a.root, "fct_order_metrics", a.start, a.end)   # pruned to the day folders
        frame = panels.metric(a.name, fct, met).persist()
        frame.show(max(frame.count(), 1), truncate=False)
    return 0


if __name__ == "__main__":
    sys.exit(main())
