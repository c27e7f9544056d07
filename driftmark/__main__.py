"""``python -m driftmark init|apply|relay|reconcile|verify|benchmark|demo``."""

from __future__ import annotations

import argparse
import sys
import time

from driftmark.engine import Engine
from driftmark.session import local_session
from driftmark.settings import Settings
from driftmark.sources.sinks import KafkaSink
from driftmark.streaming.benchmark import phases, report
from driftmark.streaming.loops import reconciler, relay
from driftmark.streaming.worker import Worker, read_events, read_kafka


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="driftmark")
    parser.add_argument("--store", default=None)
    sub = parser.add_subparsers(dest="command", required=True)
    sub.add_parser("init", help="make the store")
    sub.add_parser("apply", help="publish waiting events and index them")
    for name, what in (("relay", "publish waiting events"), ("reconcile", "queue stale documents again and remove orphan chunks")):
        sub.add_parser(name, help=what).add_argument("--loop", action="store_true", help="again and again until interrupted")
    check = sub.add_parser("verify", help="check the index against the documents")
    check.add_argument("--wait", type=float, default=0.0, help="seconds to wait for the index to catch up")
    check.add_argument("--embeddings", action="store_true")
    check.add_argument("--max-violations", type=int, default=20)
    sub.add_parser("benchmark", help="a burst of documents and edits, reported as Markdown").add_argument("--documents", type=int, default=1000)
    sub.add_parser("demo", help="write, change and find a document")
    args = parser.parse_args(argv)
    if args.command == "benchmark":
        print(report(phases(local_session(), args.documents)))
        return 0
    settings = Settings.from_env()
    engine = Engine(local_session(), args.store or settings.store, settings)
    sink = KafkaSink(settings.kafka_servers, settings.kafka_topic) if settings.kafka_servers else settings.events
    if args.command in ("relay", "reconcile"):
        if args.loop:
            loop = (relay(engine, sink) if args.command == "relay" else reconciler(engine)).start()
            try:
                while loop.running():
                    time.sleep(0.5)
            except KeyboardInterrupt:
                loop.stop()
        else:
            print(engine.drain(sink) if args.command == "relay" else engine.reconcile())
        return 0
    if args.command == "verify":
        deadline = time.time() + args.wait
        while (n := engine.verify(args.embeddings).count()) and time.time() < deadline:
            time.sleep(0.5)
        for r in engine.verify(args.embeddings).limit(args.max_violations).collect():
            print(f"[{r['kind']}] {r['document_id']}: {r['detail']}")
        print(f"{n} violations")
        return int(n > 0)
    work = f"{engine.store.root}/worker"
    events = lambda: read_kafka(engine.spark, settings.kafka_servers, settings.kafka_topic) if settings.kafka_servers else read_events(engine.spark, settings.events)
    worker = lambda: Worker(engine, events(), f"{work}/checkpoint", f"{work}/dead")
    if args.command in ("apply", "demo"):
        if args.command == "demo":
            t = time.time()
            document = engine.create("Holiday rules", "Staff may carry over five days.\n\n" + "Requests go to the team lead two weeks ahead. " * 3)
            engine.drain(sink)
            worker().drain()
            engine.search("carry over days", 3).show(truncate=60)
            print(f"searchable after {time.time() - t:.1f} s")
            engine.update(document, "Holiday rules", "Staff may carry over ten days.\n\n" + "Requests go to the team lead two weeks ahead. " * 3)
        print(engine.drain(sink), "events published")
        worker().drain()
    return 0


if __name__ == "__main__":
    sys.exit(main())
