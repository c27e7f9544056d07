"""The whole path: writes, events, indexing, search, repair and checks."""

import pytest
from pyspark.sql import functions as F

from driftmark.engine import Engine, NotFound
from driftmark.operators import verifying
from driftmark.operators.embedding import FailingProvider, HashedWords
from driftmark.operators.searching import InvalidRequest
from driftmark.settings import Settings
from driftmark.sources.store import SnapshotStore
from driftmark.streaming.worker import Worker, read_dead_letters, read_events

LONG = "The travel desk books trains before flights. " * 3
KEEP = "Receipts are kept for seven years in the archive. " * 3
SETTINGS = Settings(embedding_dimension=64, buckets=2, reconcile_grace_seconds=0.0, max_retries=1, retry_base_delay_seconds=0.0)


def kinds(engine, **kw):
    return sorted((r["kind"], r["document_id"]) for r in engine.verify(**kw).collect())


def worker(engine, tmp_path, name="w"):
    return Worker(engine, read_events(engine.spark, str(tmp_path / "events")), str(tmp_path / f"{name}-cp"), str(tmp_path / f"{name}-dead"), name)


def test_life_of_documents(spark, tmp_path):
    engine = Engine(spark, f"file://{tmp_path}/store", SETTINGS)
    events = f"{tmp_path}/events"
    a, b = engine.create("Travel", f"{LONG}\n\n{KEEP}"), engine.create("Empty", "")
    assert {k for k, _ in kinds(engine)} == {"missing_index_state", "missing_chunks"}
    assert engine.backlog() == 2 and engine.drain(events) == 2 and engine.backlog() == 0
    worker(engine, tmp_path).drain()
    assert kinds(engine, embeddings=True) == []
    assert engine.status(b)["indexed_version"] == 1 and engine.status(b)["chunks"] == []
    first = engine.status(a)
    assert [c["position"] for c in first["chunks"]] == [0, 1] and first["published_at"] is not None
    hit = engine.search("train flights desk", 1).collect()[0]
    assert hit["document_id"] == a and hit["content"].startswith("The travel desk")
    # An edit embeds the changed paragraph only; what stays keeps its version and moves.
    assert engine.update(a, "Travel", f"A new first paragraph about hotels. {LONG}\n\n{LONG}\n\n{KEEP}") == 2
    assert engine.drain(events) == 1
    worker(engine, tmp_path).drain()
    assert [(c["position"], c["embedded_at_version"]) for c in engine.status(a)["chunks"]] == [(0, 2), (1, 1), (2, 1)]
    assert kinds(engine, embeddings=True) == []
    # The whole history again, repeated and backwards: nothing changes.
    spark.read.parquet(events).unionAll(spark.read.parquet(events)).coalesce(1).write.parquet(f"{tmp_path}/again")
    before = engine.store.manifest()["tables"]
    Worker(engine, read_events(spark, f"{tmp_path}/again"), f"{tmp_path}/again-cp", f"{tmp_path}/again-dead", "again").drain()
    assert kinds(engine, embeddings=True) == [] and before is not None
    assert engine.delete(a) == 3
    with pytest.raises(NotFound):
        engine.get(a)
    with pytest.raises(NotFound):
        engine.update(a, "x", "y")
    assert engine.search("train flights desk").collect() == []  # gone at once, before the index knows
    engine.drain(events)
    worker(engine, tmp_path).drain()
    assert kinds(engine) == [] and engine.store.read("chunks").count() == 0
    with pytest.raises(InvalidRequest):
        engine.search("x", 51)
    with pytest.raises(InvalidRequest):
        engine.create("", "x")
    with pytest.raises(ValueError):
        SnapshotStore(spark, f"file://{tmp_path}/store", 32)


def test_lost_events_are_reconciled(spark, tmp_path):
    engine = Engine(spark, f"file://{tmp_path}/store", SETTINGS)
    a = engine.create("Travel", LONG)
    engine.publish(f"{tmp_path}/lost")
    report = engine.reconcile()
    assert (report.stale_documents, report.requeued, report.skipped) == (1, 1, False)
    again = engine.reconcile()
    assert (again.stale_documents, again.requeued) == (1, 0)  # already queued
    engine.drain(f"{tmp_path}/events")
    worker(engine, tmp_path).drain()
    assert kinds(engine) == []
    base = engine.store.manifest()
    stray = engine.store.read("chunks").withColumn("document_id", F.lit("0" * 8 + "-0000-4000-8000-" + "0" * 12))
    engine.store.commit(base, {"chunks": (stray, None)})
    assert [k for k, _ in kinds(engine)] == ["orphan_chunk"]
    report = engine.reconcile()
    assert (report.orphan_chunks, report.orphan_chunks_deleted) == (1, 1) and kinds(engine) == []
    assert engine.get(a)["version"] == 1
    # A pass in progress keeps others out; one whose driver was lost does so until its lock expires.
    assert engine._lock("reconcile") and engine.reconcile().skipped
    engine.locks.remove(engine._held)
    engine.locks.create("reconcile-000000007.json", {"until": 0.0})
    assert not engine.reconcile().skipped and engine.locks.names() == []


def test_failures_go_to_dead_letters(spark, tmp_path):
    engine = Engine(spark, f"file://{tmp_path}/store", SETTINGS, FailingProvider(HashedWords(64), 1.0))
    a = engine.create("Travel", LONG)
    engine.drain(f"{tmp_path}/events")
    spark.createDataFrame([(b"k", "[1, 2]"), (b"k", None), (b"k", "{broken")], "key binary, value string").write.mode("append").parquet(f"{tmp_path}/events")
    w = worker(engine, tmp_path)
    w.drain()
    dead = read_dead_letters(spark, w.dead).collect()
    assert sorted((r["headers"]["dlq.error_type"], r["headers"]["dlq.attempts"]) for r in dead) == [("TransientEmbeddingError", "2")] + [("ValueError", "1")] * 3
    sent = next(r for r in dead if r["headers"]["dlq.attempts"] == "2")
    assert a in sent["value"] and bytes(sent["key"]).decode() == a
    assert engine.store.read("index_state").count() == 0 and engine.store.read("chunks").count() == 0


def test_letters_survive_a_driver_lost_after_the_commit(spark, tmp_path):
    engine = Engine(spark, f"file://{tmp_path}/store", SETTINGS, FailingProvider(HashedWords(64), 1.0))
    a = engine.create("Travel", LONG)
    engine.drain(f"{tmp_path}/events")
    spark.createDataFrame([(b"k", "{broken")], "key binary, value string").write.mode("append").parquet(f"{tmp_path}/events")
    w = worker(engine, tmp_path)
    rows = spark.read.schema("key binary, value string").parquet(f"{tmp_path}/events").withColumns({"source_topic": F.lit("t"), "source_partition": F.lit(0), "source_offset": F.monotonically_increasing_id()})
    engine.process(spark.createDataFrame([(a,)], "document_id string"), "w", 0)  # committed, then the driver died
    for _ in range(2):
        w.apply(rows, 0)  # the replay finds its batch committed
        dead = read_dead_letters(spark, w.dead).collect()
        assert sorted(r["headers"]["dlq.error_type"] for r in dead) == ["TransientEmbeddingError", "ValueError"]


def test_commits_are_all_or_nothing(spark, tmp_path):
    engine = Engine(spark, f"file://{tmp_path}/store", SETTINGS)
    engine.create("Travel", LONG)
    base = engine.store.manifest()
    engine.create("Other", KEEP)
    rows = engine.store.read("documents", base)
    assert engine.store.commit(base, {"documents": (rows, None)}) is None  # another commit came first
    assert engine.store.read("documents").count() == 2
    assert [r["kind"] for r in verifying.counts(engine.verify()).collect()] == ["missing_chunks", "missing_index_state"]
