"""The engine: documents in, change events out, an index kept in step, search and checks over it."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime, timezone
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from driftmark.operators import mutations, reconciling, searching, verifying
from driftmark.operators.cells import CellIndex
from driftmark.operators.chunking import ChunkingConfig
from driftmark.operators.embedding import HttpEmbeddings, RetryPolicy, TransientEmbeddingError, create_provider
from driftmark.operators.indexing import IndexPlan, stale
from driftmark.session import as_uri, materialize, together
from driftmark.settings import Settings
from driftmark.sources.files import Folder
from driftmark.sources.sinks import EventSink, FileSink
from driftmark.sources.store import ConcurrentModificationError, SnapshotStore

ATTEMPTS = 3
MUTATIONS = T.StructType([T.StructField("seq", T.LongType()), T.StructField("op", T.StringType()), T.StructField("document_id", T.StringType()), T.StructField("title", T.StringType()), T.StructField("content", T.StringType())])


class NotFound(LookupError):
    """No such live document."""


class Unavailable(RuntimeError):
    """Try again later."""


@dataclass(frozen=True)
class ReconcileReport:
    stale_documents: int = 0
    requeued: int = 0
    orphan_chunks: int = 0
    orphan_chunks_deleted: int = 0
    skipped: bool = False


def _provider(settings: Settings) -> Any:
    remote = HttpEmbeddings(settings.embedding_url, settings.embedding_model, settings.embedding_key_variable, settings.embedding_timeout_seconds)
    return create_provider(settings.embedding_provider, settings.embedding_dimension, settings.embedding_failure_rate, remote)


class Engine:
    def __init__(self, spark: SparkSession, root: str, settings: Settings | None = None, provider: Any = None) -> None:
        self.spark, self.settings = spark, settings or Settings()
        self.provider = provider or _provider(self.settings)
        self.store = SnapshotStore(spark, as_uri(root), self.provider.dimension, self.settings.buckets)
        self.chunking = ChunkingConfig(self.settings.min_chars, self.settings.max_chars)
        self.policy = RetryPolicy(self.settings.max_retries, self.settings.retry_base_delay_seconds)
        self.locks, self.indexes = Folder(spark, f"{self.store.root}/locks"), Folder(spark, f"{self.store.root}/indexes")

    def now(self) -> Any:
        """The commit time as a constant, the same in every task and retry."""
        return F.lit(datetime.now(timezone.utc))

    def table(self, name: str, documents: Sequence[str] | None = None, columns: list[str] | None = None) -> DataFrame:
        """A table, of some documents only if named: then only what may hold them is read."""
        if documents is None:
            return self.store.read(name, columns=columns)
        ids = self.spark.createDataFrame([(d,) for d in documents], "document_id string")
        return self.store.read(name, only=self.store.select(ids), columns=columns)

    # Writes

    def apply(self, changes: DataFrame) -> DataFrame:
        """Apply a batch of (seq, op, document_id, title, content): documents and events in one commit.

        Returns the effective changes with the version each led to.
        """
        changes = materialize(changes, "changes")
        named = self.store.select(changes)
        for _ in range(ATTEMPTS):
            base, now = self.store.manifest(), self.now()
            documents = materialize(self.store.read("documents", base, named), "documents")
            folded = materialize(mutations.fold(documents, changes), "folded")
            added = folded.count()
            if not added:
                return folded
            new = mutations.next_documents(documents, folded, now).join(folded.select("document_id").distinct(), "document_id", "left_semi")
            events = mutations.events(folded.select("document_id", "version", (F.col("op") == mutations.REMOVE).alias("deleted")), base["sequence"], now)
            if self.store.commit(base, {"documents": (new, None), "outbox": (events, None)}, sequence=base["sequence"] + added):
                self.store.compact()
                return folded
        raise ConcurrentModificationError("documents kept changing")

    def _one(self, op: str, document_id: str, title: str | None, content: str | None) -> int:
        rows = self.apply(self.spark.createDataFrame([(1, op, document_id, title, content)], MUTATIONS)).collect()
        if not rows:
            raise NotFound(document_id)
        return int(rows[0]["version"])

    @staticmethod
    def _check(title: str, content: str) -> None:
        if not title or content is None:
            raise searching.InvalidRequest("a title of at least one character and a content are required")

    def create(self, title: str, content: str) -> str:
        self._check(title, content)
        document_id = str(uuid.uuid4())
        self._one(mutations.CREATE, document_id, title, content)
        return document_id

    def update(self, document_id: str, title: str, content: str) -> int:
        self._check(title, content)
        return self._one(mutations.UPDATE, document_id, title, content)

    def delete(self, document_id: str) -> int:
        return self._one(mutations.REMOVE, document_id, None, None)

    def get(self, document_id: str) -> dict[str, Any]:
        rows = self.table("documents", [document_id]).filter(~F.col("deleted")).collect()
        if not rows:
            raise NotFound(document_id)
        return rows[0].asDict()

    def status(self, document_id: str) -> dict[str, Any]:
        """Deleted documents have a status, too."""
        of = lambda t, *c: self.table(t, [document_id], list(c) or None)
        chunks = of("chunks", "document_id", "content_hash", "position", "content", "document_version")
        rows = searching.index_status(of("documents"), of("outbox"), of("index_state"), chunks).collect()
        if not rows:
            raise NotFound(document_id)
        return rows[0].asDict(recursive=True)

    # Publishing

    def publish(self, sink: EventSink | str, limit: int | None = None) -> int:
        """Send unpublished events, oldest first, and mark as published those that the sink acknowledged. A sink
        given as a path is a folder of files. ``limit`` is ``relay_batch`` unless given, 0 lifts it. Returns how many
        were marked."""
        sink, limit = FileSink(as_uri(sink)) if isinstance(sink, str) else sink, self.settings.relay_batch if limit is None else limit
        for _ in range(ATTEMPTS):
            base, now = self.store.manifest(), self.now()
            waiting = self.store.read("outbox", base).filter("published_at IS NULL")
            batch = materialize(waiting.orderBy("id").limit(limit) if limit else waiting, "batch")
            n = batch.count()
            sent = sink.send(batch) if n else None
            done = batch
            if sent is not None:
                done = materialize(batch.join(sent.select("id"), "id", "left_semi"), "sent")
                n = done.count()
            done = done.withColumn("published_at", now)
            # Lost the race: the events stay unpublished and go out again, which readers bear.
            if not n or self.store.commit(base, {"outbox": (done, None)}):
                self.store.compact()
                return n
        raise ConcurrentModificationError("the outbox kept changing")

    def drain(self, sink: EventSink | str) -> int:
        """Publish until nothing waits, or nothing more is acknowledged."""
        total = 0
        while n := self.publish(sink):
            total += n
        return total

    def backlog(self) -> int:
        return self.store.read("outbox", columns=["id", "published_at"]).filter("published_at IS NULL").count()

    # Indexing

    def process(self, documents: DataFrame, worker: str | None = None, batch: int = 0) -> IndexPlan | None:
        """Index the current version of the documents named by ``document_id``.

        Planned outside any lock against one snapshot; if another commit comes first it is planned anew. Of each
        ``worker`` the number of its last committed batch is kept, and a batch up to that is skipped, which makes
        replays harmless. Its failures are kept beside the store and named by the commit, see ``failures``.
        """
        named = self.store.select(documents)
        for _ in range(ATTEMPTS):
            base, now = self.store.manifest(), self.now()
            if worker is not None and batch <= base["batches"].get(worker, {"batch": -1})["batch"]:
                return None
            # Of the documents at hand only; merged once, as the plan looks at them several times.
            read = lambda t: lambda: materialize(self.store.read(t, base, named), t)
            held = together(read("documents"), read("index_state"), read("chunks"))
            plan = IndexPlan(*held, self.provider, now, self.chunking, self.policy)
            batches, path = base["batches"], f"{self.store.root}/failures/{uuid.uuid4().hex}"
            results, _ = together(lambda: materialize(plan.results, "results"), lambda: plan.failures.write.parquet(path) if worker is not None else None)  # noqa: B023 - done before the next round
            plan.results = results
            if worker is not None:
                batches = batches | {worker: {"batch": batch, "failures": path}}
            if self.store.commit(base, {"chunks": (plan.upserts, plan.removed), "index_state": (plan.state, None)}, batches=batches):
                self.store.compact()
                return plan
        raise ConcurrentModificationError("the index kept changing")

    def failures(self, worker: str, batch: int) -> DataFrame | None:
        """What failed in a worker's last committed batch (``document_id``, ``attempts``, ``error_type``,
        ``error_message``); None for any other batch."""
        held = self.store.manifest()["batches"].get(worker)
        return self.spark.read.parquet(held["failures"]) if held and held["batch"] == batch else None

    # Repair and checks

    def _lock(self, name: str) -> bool:
        """Take a lock for ``lock_seconds``; one that expired with its owner is taken over."""
        at = datetime.now(timezone.utc).timestamp()
        held = [n for n in self.locks.names() if n.startswith(f"{name}-")]
        number = int(held[-1].removesuffix(".json").rsplit("-", 1)[1]) + 1 if held else 0
        if held and self.locks.load(held[-1])["until"] > at:
            return False
        if not self.locks.create(f"{name}-{number:09d}.json", {"until": at + self.settings.lock_seconds}):
            return False
        for old in held:
            self.locks.remove(old)
        self._held = f"{name}-{number:09d}.json"
        return True

    def reconcile(self) -> ReconcileReport:
        """Queue stale documents again and remove orphan chunks; one pass at a time."""
        if not self._lock("reconcile"):
            return ReconcileReport(skipped=True)
        try:
            base, now = self.store.manifest(), self.now()
            documents = self.store.read("documents", base, columns=["document_id", "version", "deleted", "updated_at"])
            state, outbox = self.store.read("index_state", base), self.store.read("outbox", base)
            n_stale = stale(documents, state).count()
            found = materialize(reconciling.find_stale(documents, state, outbox, now, self.settings.reconcile_grace_seconds, self.settings.reconcile_batch), "stale")
            queued = found.count()
            if queued:
                events = mutations.events(found, base["sequence"], now, cause=f"repair-{base['version']}")
                if not self.store.commit(base, {"outbox": (events, None)}, sequence=base["sequence"] + queued):
                    queued = 0  # the next pass finds them
        finally:
            self.locks.remove(self._held)
        n_found = n_removed = 0
        for _ in range(ATTEMPTS):
            base = self.store.manifest()
            chunks = self.store.read("chunks", base, columns=["document_id", "content_hash"])
            live = self.store.read("documents", base, columns=["document_id", "deleted"])
            lost = materialize(chunks.join(reconciling.orphan_chunks(chunks, live), "document_id", "left_semi"), "orphans")
            n_found = lost.count()
            if not n_found:
                break
            if self.store.commit(base, {"chunks": (None, lost)}):
                n_removed = n_found
                break
        self.store.compact()
        return ReconcileReport(n_stale, queued, n_found, n_removed)

    def snapshot(self) -> DataFrame:
        """The index as rows that say all of it: chunks without their vectors and the state without its times. Two
        snapshots are equal (``differences`` is empty) if nothing happened in between."""
        chunks = self.store.read("chunks", columns=["document_id", "content_hash", "position", "content", "document_version"])
        state = self.store.read("index_state").select("document_id", F.lit(None).cast("string").alias("content_hash"), F.lit(None).cast("int").alias("position"), F.lit(None).cast("string").alias("content"), F.col("indexed_version").alias("document_version"), "deleted")
        return chunks.withColumn("deleted", F.lit(None).cast("boolean")).unionByName(state)

    @staticmethod
    def differences(a: DataFrame, b: DataFrame) -> DataFrame:
        """Rows of one snapshot that the other lacks, repeated ones counted."""
        return a.exceptAll(b).unionByName(b.exceptAll(a))

    def verify(self, embeddings: bool = False) -> DataFrame:
        base = self.store.manifest()
        return verifying.violations(*(self.store.read(t, base) for t in ("documents", "index_state", "chunks")), provider=self.provider if embeddings else None, config=self.chunking)

    def search(self, query: str, top_k: int = 5, document_id: str | None = None) -> DataFrame:
        """The best chunks of live documents, by an exact scan."""
        vector = self._vector(query)
        base = self.store.manifest()
        only = None if document_id is None else self.store.select(self.spark.createDataFrame([(document_id,)], "document_id string"))
        chunks, documents, state = (self.store.read(t, base, only) for t in ("chunks", "documents", "index_state"))
        return searching.search(chunks, documents, state, vector, top_k, document_id)

    def _vector(self, query: str) -> list[float]:
        if not query:
            raise searching.InvalidRequest("a query of at least one character is required")
        try:
            return self.provider.embed([query])[0]
        except TransientEmbeddingError as e:
            raise Unavailable(str(e)) from e

    def build_vector_index(self, cells: int | None = None) -> CellIndex:
        """Index the vectors of the current commit by cells; searches see later commits all the same."""
        base = self.store.manifest()
        rows = self.store.read("chunks", base, columns=["document_id", "content_hash", "embedding"])
        root = f"{self.store.root}/vectors/{base['version']:012d}-{uuid.uuid4().hex[:8]}"
        index = CellIndex.build(rows, root, "embedding", cells, version=base["version"])
        self.indexes.create(f"index-{base['version']:012d}-{uuid.uuid4().hex[:8]}.json", {"root": root})
        return index

    def search_indexed(self, query: str, top_k: int = 5, slack: float = 0.0) -> DataFrame:
        """The same as ``search`` through the newest vector index: exact, or with ``slack`` (an angle) nearly so.

        Chunks put since the index was built are scanned; what the index holds of chunks that are gone, and of
        documents that are, does not count.
        """
        if not 1 <= top_k <= 50:
            raise searching.InvalidRequest("top_k must be between 1 and 50")
        vector, base, names = self._vector(query), self.store.manifest(), self.indexes.names()
        index = CellIndex(self.spark, self.indexes.load(names[-1])["root"]) if names else self.build_vector_index()
        held: list[Any] = []

        def accept(candidates: list[Any]) -> list[Any]:
            """Candidates that are chunks of live documents still; only their documents are read."""
            if not candidates:
                return []
            schema = "document_id string, content_hash string, score double"
            rows = self.spark.createDataFrame([(r["document_id"], r["content_hash"], r["score"]) for r in candidates], schema)
            only = self.store.select(rows)
            of = lambda t, c=None: self.store.read(t, base, only, c)
            live, state = of("documents", ["document_id", "title", "deleted"]), of("index_state", ["document_id", "indexed_version", "deleted"])
            chunks = of("chunks", ["document_id", "content_hash", "position", "content"])
            joined = rows.join(chunks, ["document_id", "content_hash"]).join(live.filter("NOT deleted").drop("deleted"), "document_id").join(state.filter("NOT deleted").drop("deleted"), "document_id")
            found = joined.orderBy(F.col("score").desc(), "document_id", "position").collect()
            held.extend(found)
            return found

        index.search(vector, top_k, ["document_id", "content_hash"], accept, slack)
        later = searching.search(self.store.read("chunks", base, since=index.extra["version"]), self.store.read("documents", base), self.store.read("index_state", base), vector, top_k).collect()
        columns = ["document_id", "title", "indexed_version", "position", "content", "score"]
        best = sorted({tuple(r[c] for c in columns) for r in [*held, *later]}, key=lambda r: (-r[5], r[0], r[3]))[:top_k]
        return self.spark.createDataFrame(best, "document_id string, title string, indexed_version int, position int, content string, score double")
