"""Loops, sinks, providers behind HTTP, counters and percentiles."""

import http.server
import json
import math
import random
import threading
import time
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from driftmark.engine import Engine
from driftmark.operators import metrics
from driftmark.operators.embedding import HttpEmbeddings, PermanentEmbeddingError, RemoteProvider, RetryPolicy, TransientEmbeddingError, create_provider, embed_with_retries
from driftmark.session import new_folder, scratch
from driftmark.settings import Settings, SettingsError
from driftmark.sources.files import Folder
from driftmark.sources.sinks import KafkaSink
from driftmark.sources.store import SCHEMAS, SnapshotStore
from driftmark.streaming.loops import Loop

# Loops


def test_loop_goes_on_while_there_is_more_and_after_errors():
    seen = []

    def step():
        seen.append(len(seen))
        if len(seen) == 2:
            raise ValueError("once")
        return len(seen) < 5

    loop = Loop(step, 0.01).start()
    deadline = time.time() + 10
    while len(seen) < 8 and time.time() < deadline:
        time.sleep(0.01)
    loop.stop(5)
    n = len(seen)
    time.sleep(0.05)
    assert n >= 8 and len(seen) == n and loop.errors == 1


def test_stop_ends_the_wait():
    loop = Loop(lambda: False, 3600).start()
    time.sleep(0.05)
    t = time.time()
    loop.stop(5)
    assert time.time() - t < 2 and not loop._thread.is_alive()


# Embeddings behind HTTP


@pytest.fixture
def service():
    answers = []

    class Handler(http.server.BaseHTTPRequestHandler):
        def do_POST(self):
            body = json.loads(self.rfile.read(int(self.headers["Content-Length"])))
            status, answer = answers.pop(0) if answers else (200, None)
            rows = [{"index": i, "embedding": [float(len(t)), 1.0]} for i, t in enumerate(body["input"])][::-1]
            self.send_response(status)
            self.end_headers()
            self.wfile.write(json.dumps(answer if answer is not None else {"data": rows}).encode())

        def log_message(self, *_):
            pass

    server = http.server.HTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    yield f"http://127.0.0.1:{server.server_port}", answers
    server.shutdown()


def test_remote_provider(service):
    url, answers = service
    provider = create_provider("remote", 2, 0.0, HttpEmbeddings(url, "m", timeout=5))
    assert provider.embed(["a", "bbb"]) == [[1.0, 1.0], [3.0, 1.0]]  # by index, whatever the order of the answer
    assert RemoteProvider(HttpEmbeddings(url, "m"), 2, 2).embed(["a", "b", "cc"])[2] == [2.0, 1.0]
    for status, kind in ((429, TransientEmbeddingError), (503, TransientEmbeddingError), (400, PermanentEmbeddingError)):
        answers.append((status, {}))
        with pytest.raises(kind):
            provider.embed(["a"])
    answers.append((200, {"nothing": 1}))
    with pytest.raises(PermanentEmbeddingError):
        provider.embed(["a"])
    answers += [(500, {}), (500, {})]
    assert embed_with_retries(provider, ["a"], RetryPolicy(2, 0.0))[2] == 3
    with pytest.raises(TransientEmbeddingError):
        HttpEmbeddings("http://127.0.0.1:9", "m", timeout=1)(["a"])
    with pytest.raises(PermanentEmbeddingError):
        create_provider("remote", 3, 0.0, HttpEmbeddings(url, "m")).embed(["a"])  # another width


def test_settings_of_the_remote_provider(service):
    with pytest.raises(SettingsError):
        Settings(embedding_provider="remote")
    with pytest.raises(SettingsError):
        Settings(embedding_provider="other")
    env = {"DRIFTMARK_EMBEDDING_PROVIDER": "remote", "DRIFTMARK_EMBEDDING_URL": service[0], "DRIFTMARK_LOCK_SECONDS": " "}
    assert Settings.from_env(env).embedding_url == service[0]


def test_kafka_sink_waits_for_all_replicas():
    options = KafkaSink("host:9092", "t").options
    assert options["kafka.acks"] == "all" and options["kafka.enable.idempotence"] == "true" and options["topic"] == "t"


# Store


def _documents(spark, rows):
    return spark.createDataFrame([(d, "t", "c", v, False, datetime(2025, 1, 1)) for d, v in rows], SCHEMAS["documents"])


def test_store_reads_what_it_needs_and_writes_what_changed(spark):
    store = SnapshotStore(spark, new_folder(spark, "store"), 4, 2, fan_in=3)
    ids = [f"{i:08d}-0000-4000-8000-000000000000" for i in range(60)]
    store.commit(store.manifest(), {"documents": (_documents(spark, [(d, 1) for d in ids]), None)})
    store.commit(store.manifest(), {"documents": (_documents(spark, [(ids[3], 2)]), spark.createDataFrame([(ids[5],)], "document_id string"))})
    last = store.manifest()["tables"]["documents"][-1]["name"]
    assert spark.read.parquet(f"{store.root}/{last}").count() == 2  # one changed row and one mark
    named = store.select(spark.createDataFrame([(ids[3],), (ids[5],), (ids[9],), ("none",), (None,), (ids[3],)], "document_id string"))
    rows = store.read("documents", only=named, columns=["document_id", "version"])
    assert rows.columns == ["document_id", "version"] and sorted(map(tuple, rows.collect())) == [(ids[3], 2), (ids[9], 1)]
    assert store.read("documents", only=store.select(spark.createDataFrame([], "document_id string"))).count() == 0
    old = store.manifest()
    store.commit(old, {"documents": (_documents(spark, [(ids[5], 7)]), None)})
    assert store.read("documents", old).count() == 59 and store.read("documents").count() == 60
    assert store.compact() == 1 and [r["level"] for r in store.manifest()["tables"]["documents"]] == [1]
    got = {r["document_id"]: r["version"] for r in store.read("documents").collect()}
    assert len(got) == 60 and got[ids[3]] == 2 and got[ids[5]] == 7
    assert store.read("documents", old).count() == 59  # older readers find their files


def test_store_of_the_first_format_is_taken_over(spark):
    root = new_folder(spark, "store")
    probe = SnapshotStore(spark, root + "-probe", 4, 2)
    rows = _documents(spark, [("a", 1), ("b", 2), ("c", 3)]).withColumn("bucket", probe.bucket())
    rows.repartition(1).write.partitionBy("bucket").parquet(f"{root}/documents/v=1-x")
    written = [n.removeprefix("bucket=") for n in Folder(spark, f"{root}/documents/v=1-x").names() if n.startswith("bucket=")]
    Folder(spark, root).create("manifest-000000000001.json", {"format": 1, "version": 1, "dimension": 4, "buckets": 2, "tables": {"documents": {b: "1-x" for b in written}, "chunks": {"0": None}, "outbox": {}, "index_state": {}}, "batches": ["w-0"], "sequence": 5})
    store = SnapshotStore(spark, root, 4)
    assert store.manifest()["format"] == 2 and store.manifest()["sequence"] == 5
    assert sorted((r["document_id"], r["version"]) for r in store.read("documents").collect()) == [("a", 1), ("b", 2), ("c", 3)]
    assert SnapshotStore(spark, root, 4).manifest()["version"] == 2


def test_what_a_batch_writes_does_not_grow_with_the_store(spark, tmp_path):
    written = []
    for n in (20, 400):
        store = SnapshotStore(spark, f"file://{tmp_path}/{n}", 4, 2)
        store.commit(store.manifest(), {"documents": (_documents(spark, [(f"{i:036d}", 1) for i in range(n)]), None)})
        before = sum(f.stat().st_size for f in (tmp_path / str(n)).rglob("*.parquet"))
        store.commit(store.manifest(), {"documents": (_documents(spark, [(f"{i:036d}", 2) for i in range(4)]), None)})
        written.append(sum(f.stat().st_size for f in (tmp_path / str(n)).rglob("*.parquet")) - before)
    assert abs(written[0] - written[1]) < 200


def test_scratch_folders_are_removed(spark):
    with scratch(spark):
        inner = new_folder(spark, "x")
        spark.range(3).write.parquet(inner)
        assert Folder(spark, inner).exists()
    outer = new_folder(spark, "x")
    spark.range(3).write.parquet(outer)
    assert not Folder(spark, inner).exists() and Folder(spark, outer).exists()


# Search by cells


def test_search_by_cells_is_exact_and_reads_little_of_clustered_vectors(spark):
    import numpy as np

    from driftmark.operators.cells import CellIndex

    rng = np.random.default_rng(1)
    centres = rng.standard_normal((20, 16))
    x = np.repeat(centres, 60, axis=0) + 0.05 * rng.standard_normal((1200, 16))
    rows = [(i, [float(v) for v in x[i]], "c") for i in range(1200)] + [(5000 + i, [float(v) for v in x[0]], "copy") for i in range(600)]
    bad = [(9000, None, ""), (9001, [0.0] * 16, ""), (9002, [1.0] * 3, ""), (9003, [float("nan")] * 16, ""), (9004, [None] * 16, "")]
    df = spark.createDataFrame(rows + bad, "id long, v array<float>, dm_other string")
    index = CellIndex.build(df, new_folder(spark, "cells"), "v")
    vectors = np.array([r[1] for r in rows], dtype=np.float32).astype(float)
    unit = vectors / np.linalg.norm(vectors, axis=1)[:, None]
    for q in (x[0], x[700], rng.standard_normal(16)):
        cosine = unit @ (q / np.linalg.norm(q))
        want = sorted(((-round(c, 5), rows[i][0]) for i, c in enumerate(cosine)))[:5]
        found, read = index.search(list(q), 5, ["id"])
        assert [(-round(r["score"], 5), r["id"]) for r in found] == want
        if q is not x[0] and abs(q - x[700]).max() == 0:
            assert read < len(index.cells)
    odd, _ = index.search(list(x[0]), 5, ["id"], accept=lambda rows: [r for r in rows if r["id"] % 100 == 99])
    assert len(odd) == 5 and all(r["id"] % 100 == 99 for r in odd)
    assert CellIndex.build(df.limit(0), new_folder(spark, "cells"), "v").search([1.0] * 16, 5, ["id"]) == ([], 0)


def test_indexed_search_sees_later_changes(spark, tmp_path):
    from driftmark.streaming.worker import Worker, read_events

    engine = Engine(spark, f"file://{tmp_path}/store", Settings(embedding_dimension=64, buckets=2))
    work = lambda: (engine.drain(f"{tmp_path}/events"), Worker(engine, read_events(spark, f"{tmp_path}/events"), f"{tmp_path}/cp", f"{tmp_path}/dead").drain())
    ids = [engine.create(f"T{i}", f"Report {i} about trains and flights in season {i % 3}. " * 3) for i in range(3)]
    work()
    engine.build_vector_index()
    same = lambda q: [tuple(r) for r in engine.search(q, 4).collect()] == [tuple(r) for r in engine.search_indexed(q, 4).collect()]
    assert same("trains and flights")
    engine.delete(ids[0])
    engine.update(ids[1], "T1", "Hotels near the station are booked by the travel desk. " * 3)
    work()
    engine.create("unseen", "trains flights")
    assert same("trains and flights") and same("hotels station")
    assert all(r["document_id"] != ids[0] for r in engine.search_indexed("trains", 50).collect())


# Figures


def test_nearest_ranks(spark):
    rng = random.Random(3)
    for values in ([], [None], [5.0], [1.0, 2.0], [rng.choice([1.0, 2.5, 7.0]) for _ in range(500)], [rng.random() for _ in range(333)] + [None, 9.0]):
        got = metrics.nearest_ranks(spark.createDataFrame([(v,) for v in values], "v double"), "v", (0.5, 0.95, 0.99)).head()
        own = sorted(v for v in values if v is not None)
        want = [own[max(1, math.ceil(len(own) * p)) - 1] if own else None for p in (0.5, 0.95, 0.99)]
        assert [None if math.isnan(x) else x for x in got] == want


def test_counter_deltas_across_blocks(spark):
    rng, rows, value = random.Random(5), [], 0.0
    start = datetime(2025, 1, 1)
    for i in range(300):
        value = 0.0 if rng.random() < 0.05 else value + rng.random()
        rows.append((start + timedelta(minutes=37 * i), "hot" if i % 3 else None, value))
    got = metrics.counter_deltas(spark.createDataFrame(rows, "ts timestamp, name string, value double"), ["name"]).collect()
    for name in ("hot", None):
        own = [v for _, n, v in rows if n == name]
        want = [0.0] + [b if b < a else b - a for a, b in zip(own, own[1:])]
        assert [r["delta"] for r in sorted((r for r in got if r["name"] == name), key=lambda r: r["ts"])] == pytest.approx(want)


def test_counters_of_batches(spark):
    out = new_folder(spark, "metrics")
    rows = spark.createDataFrame([("indexed", 2, 1, 0, 0.2), ("indexed", 1, 0, 0, 40.0), ("failed", 0, 0, 0, None)], "outcome string, chunks_embedded long, chunks_reused long, chunks_deleted long, lag_seconds double")
    for n in range(2):
        metrics.batch_samples(rows, 3, 1, F.lit(datetime(2025, 1, 1 + n))).write.mode("overwrite").parquet(f"{out}/batch={n}")
    held = metrics.read_counters(spark, out)
    last = {(r["name"], r["label"]): r["value"] for r in metrics.grown(held.limit(0), held).collect()}
    assert last["documents_total", "indexed"] == 4 and last["chunks_total", "embedded"] == 6 and last["events_total", "malformed"] == 2
    assert last["freshness_lag_seconds", "0.25"] == 2 and last["freshness_lag_seconds", "Infinity"] == 4
    first = held.filter(F.col("ts") < datetime(2025, 1, 2))
    assert {r["value"] for r in metrics.grown(first, held).filter("name = 'chunks_total' AND label = 'reused'").collect()} == {1.0}


def test_benchmark_and_its_report(spark):
    from driftmark.streaming.benchmark import phases, report

    seed, edit = phases(spark, 30)
    assert seed["documents"] == 30 and seed["embedded"] == seed["chunks"] and 0 < edit["embedded"] < edit["chunks"]
    assert seed["lag_ms"] == sorted(seed["lag_ms"]) and report([seed, edit]).count("|") == 4 * 11


def test_relay_and_new_checkpoints(spark, tmp_path):
    from driftmark.streaming.loops import relay
    from driftmark.streaming.worker import Worker, read_events

    engine = Engine(spark, f"file://{tmp_path}/store", Settings(embedding_dimension=64, buckets=2, relay_poll_interval_ms=50))
    a = engine.create("Travel", "The travel desk books trains before flights. " * 3)
    loop = relay(engine, f"{tmp_path}/events").start()
    deadline = time.time() + 60
    while engine.backlog() and time.time() < deadline:
        time.sleep(0.1)
    loop.stop(60)
    assert engine.backlog() == 0 and loop.errors == 0
    work = lambda cp: Worker(engine, read_events(spark, f"{tmp_path}/events"), f"{tmp_path}/{cp}", f"{tmp_path}/dead", "w")
    work("one").drain()
    before = engine.snapshot().collect()
    assert engine.status(a)["indexed_version"] == 1
    engine.store.commit(engine.store.manifest(), {"index_state": (None, engine.store.read("index_state"))})  # the index forgets
    work("one").drain()
    assert engine.status(a)["indexed_version"] is None  # nothing new for that checkpoint
    work("two").drain()  # a new checkpoint takes all events from the start, and its batch 0 is not the other's
    assert engine.status(a)["indexed_version"] == 1 and sorted(map(str, engine.snapshot().collect())) == sorted(map(str, before))
