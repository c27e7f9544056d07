"""Bringing chunks and index state in step with the current documents."""

from __future__ import annotations

from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from driftmark.operators import diffing
from driftmark.operators.chunking import ChunkingConfig, chunk_documents
from driftmark.operators.embedding import RetryPolicy, embed_documents, failures
from driftmark.session import materialize

INDEXED, DELETED, SKIPPED = "indexed", "deleted", "skipped_stale"


def stale(documents: DataFrame, state: DataFrame) -> DataFrame:
    """Documents whose index is missing or behind: no state row, a null version, or a lower one."""
    held = state.select("document_id", "indexed_version")
    return documents.join(held, "document_id", "left").filter(F.col("indexed_version").isNull() | (F.col("indexed_version") < F.col("version")))


class IndexPlan:
    """What changes in chunks and index state for some documents, planned from one snapshot.

    ``upserts`` and ``removed`` are the chunks to put and to take out, ``state`` the state rows to put; what stays as
    it is is in neither. Contents and vectors are read for moved chunks only.

    Events are hints: what counts is the current document. Chunks that are kept keep their text, vector and
    ``document_version``, the version at which they were embedded; only their position may change. New
    chunks of a document are embedded in one call; if that fails nothing of the document changes.
    """

    def __init__(self, documents: DataFrame, state: DataFrame, chunks: DataFrame, provider: Any, as_of: Column, config: ChunkingConfig | None = None, policy: RetryPolicy | None = None) -> None:
        due = stale(documents, state)
        live, gone = due.filter(~F.col("deleted")), due.filter("deleted")
        desired = chunk_documents(live.select("document_id", "content"), config)
        stored = diffing.touched(chunks.select("document_id", "content_hash", "position"), live)
        # Planned once: texts are chunked and diffed a single time for embedding, applying and counting.
        self.diff = materialize(diffing.diff_chunks(desired, stored).join(desired.select("document_id", "content_hash", "content"), ["document_id", "content_hash"], "left"), "diff")
        embedded = embed_documents(self.diff.filter(F.col("action") == diffing.EMBED), provider, policy)
        self.embedded = materialize(embedded, "embedded")
        self.failures = failures(self.embedded)
        failed = self.failures.select("document_id")
        done = live.join(failed, "document_id", "left_anti")
        new = self.embedded.filter("vectors IS NOT NULL").select("document_id", F.inline("vectors"))
        versions = done.select("document_id", F.col("version").alias("document_version"))
        applied = self.diff.join(versions, "document_id")
        inserted = applied.filter(F.col("action") == diffing.EMBED).join(new, ["document_id", "content_hash"]).select("document_id", "content_hash", "position", "content", "embedding", "document_version")
        moves = applied.filter(F.col("action") == diffing.MOVE).select("document_id", "content_hash", F.col("position").alias("new_position"))
        moved = chunks.join(moves, ["document_id", "content_hash"]).select("document_id", "content_hash", F.col("new_position").alias("position"), "content", "embedding", "document_version")
        self.upserts = inserted.unionByName(moved)
        of_gone = chunks.select("document_id", "content_hash").join(gone.select("document_id"), "document_id", "left_semi")
        self.removed = applied.filter(F.col("action") == diffing.DELETE).select("document_id", "content_hash").unionByName(of_gone)
        self.state = done.unionByName(gone).select("document_id", F.col("version").alias("indexed_version"), as_of.alias("indexed_at"), "deleted")
        fresh = self.state
        counts = diffing.summarize(self.diff)
        removed = diffing.touched(chunks.select("document_id"), gone).groupBy("document_id").agg(F.count(F.lit(1)).alias("removed"))
        of = documents.select("document_id", "version", "deleted", "updated_at").join(fresh.select("document_id", F.lit(True).alias("applied")), "document_id", "left").join(failed.withColumn("failed", F.lit(True)), "document_id", "left")
        outcome = F.when(F.col("failed"), "failed").when(F.col("applied").isNull(), SKIPPED).when(F.col("deleted"), DELETED).otherwise(INDEXED)
        zero = lambda c: F.when(F.col("applied"), F.coalesce(c, F.lit(0))).otherwise(0)
        lag = F.when(F.col("applied"), F.greatest((F.unix_micros(as_of) - F.unix_micros("updated_at")) / 1e6, F.lit(0.0)))
        self.results = of.join(counts, "document_id", "left").join(removed, "document_id", "left").select(
            "document_id", outcome.alias("outcome"), F.when(F.col("applied"), F.col("version")).alias("version"), zero(F.col("to_embed")).alias("chunks_embedded"), zero(F.col("to_reuse")).alias("chunks_reused"),
            zero(F.coalesce("to_delete", "removed")).alias("chunks_deleted"), lag.alias("lag_seconds"),
        )

    def next_chunks(self, chunks: DataFrame) -> DataFrame:
        """All of ``chunks`` as they are afterwards."""
        keys = ["document_id", "content_hash"]
        return chunks.join(self.removed.unionByName(self.upserts.select(*keys)), keys, "left_anti").unionByName(self.upserts.select(*chunks.columns))
