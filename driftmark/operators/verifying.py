"""Checks the index against the documents, computing everything from scratch."""

from __future__ import annotations

from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from driftmark.functions import vectors
from driftmark.functions.text import content_hash
from driftmark.operators.chunking import ChunkingConfig, chunk_documents
from driftmark.operators.embedding import embed_texts

KINDS = ("deleted_has_chunks", "delete_not_recorded", "missing_index_state", "wrongly_deleted", "version_mismatch", "hash_mismatch", "duplicate_position", "missing_chunks", "stale_chunks", "position_mismatch", "orphan_chunk", "embedding_mismatch")


def violations(documents: DataFrame, state: DataFrame, chunks: DataFrame, provider: Any = None, config: ChunkingConfig | None = None) -> DataFrame:
    """(``kind``, ``document_id``, ``detail``), one row per violation.

    Documents are joined with their state and with per-document figures of their chunks: both sides are
    reduced to one row per document first. Expected and stored chunks meet in one full outer join by
    (document, hash). With a deterministic ``provider`` stored vectors are checked as well.
    """
    docs = documents.select("document_id", "version", F.coalesce("deleted", F.lit(False)).alias("deleted"))
    held = state.select("document_id", "indexed_version", F.col("deleted").alias("state_deleted"), F.lit(True).alias("has_state"))
    figures = chunks.groupBy("document_id").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("position").alias("n_positions"), F.count("position").alias("n_placed"))
    d = docs.join(held, "document_id", "left").join(figures, "document_id", "left")
    n = F.coalesce("n", F.lit(0))
    text = lambda *parts: F.concat(*[F.coalesce(p.cast("string"), F.lit("null")) if isinstance(p, Column) else F.lit(p) for p in parts])
    expected_state = F.coalesce(F.col("has_state") & (F.col("indexed_version") == F.col("version")) & F.col("state_deleted"), F.lit(False))
    of_state = (
        F.when(F.col("deleted"), F.when(~expected_state, F.struct(F.lit("delete_not_recorded").alias("kind"), text("state v", F.col("indexed_version"), ", deleted v", F.col("version")).alias("detail"))))
        .when(F.col("has_state").isNull(), F.struct(F.lit("missing_index_state").alias("kind"), text("v", F.col("version"), " never indexed").alias("detail")))
        .when(F.col("state_deleted"), F.struct(F.lit("wrongly_deleted").alias("kind"), F.lit("live document recorded as deleted").alias("detail")))
        .when(~F.col("indexed_version").eqNullSafe(F.col("version")), F.struct(F.lit("version_mismatch").alias("kind"), text("indexed v", F.col("indexed_version"), ", document v", F.col("version")).alias("detail")))
    )
    remains = F.when(F.col("deleted") & (n > 0), F.struct(F.lit("deleted_has_chunks").alias("kind"), text(n, " chunks remain").alias("detail")))
    repeated = F.when(~F.col("deleted") & (n > F.coalesce(F.col("n_positions") + F.when(F.col("n_placed") < n, 1).otherwise(0), n)), F.struct(F.lit("duplicate_position").alias("kind"), text(n, " chunks at ", F.col("n_positions"), " positions").alias("detail")))
    per_document = d.select("document_id", F.explode(F.filter(F.array(of_state, remains, repeated), lambda x: x.isNotNull())).alias("v")).select("v.kind", "document_id", "v.detail")

    live = documents.filter(~F.coalesce("deleted", F.lit(False)))
    of_live = chunks.join(live.select("document_id"), "document_id", "left_semi")
    hashed = of_live.filter(~content_hash(F.col("content")).eqNullSafe(F.col("content_hash"))).select(F.lit("hash_mismatch").alias("kind"), "document_id", text("chunk at ", F.col("position")).alias("detail"))

    want = chunk_documents(live.select("document_id", "content"), config).select("document_id", "content_hash", F.col("position").alias("wanted"))
    have = of_live.groupBy("document_id", "content_hash").agg(F.max("position").alias("stored"), F.lit(True).alias("held"))
    both = want.join(have, ["document_id", "content_hash"], "full_outer")
    counted = both.groupBy("document_id").agg(
        F.count_if(F.col("held").isNull()).alias("missing_chunks"), F.count_if(F.col("wanted").isNull()).alias("stale_chunks"),
        F.count_if(F.col("held").isNotNull() & F.col("wanted").isNotNull() & ~F.col("stored").eqNullSafe(F.col("wanted"))).alias("position_mismatch"),
    )
    compared = counted.unpivot("document_id", ["missing_chunks", "stale_chunks", "position_mismatch"], "kind", "n").filter("n > 0").select("kind", "document_id", text(F.col("n"), " chunks").alias("detail"))

    unknown = figures.join(docs.select("document_id"), "document_id", "left_anti").filter("document_id IS NOT NULL").select(F.lit("orphan_chunk").alias("kind"), "document_id", text(F.col("n"), " chunks of an unknown document").alias("detail"))
    out = per_document.unionByName(hashed).unionByName(compared).unionByName(unknown)
    if provider is not None:
        fresh = embed_texts(of_live.withColumn("stored", F.col("embedding")), provider, "content", "document_id", "position", "stored")
        out = out.unionByName(fresh.filter(~F.coalesce(vectors.close(F.col("stored"), F.col("embedding")), F.lit(False))).select(F.lit("embedding_mismatch").alias("kind"), "document_id", text("chunk at ", F.col("position")).alias("detail")))
    return out


def counts(found: DataFrame) -> DataFrame:
    """Violations by kind, in order of the kind."""
    return found.groupBy("kind").agg(F.count(F.lit(1)).alias("n")).orderBy("kind")


def totals(documents: DataFrame, chunks: DataFrame) -> DataFrame:
    """One row: live documents, deleted documents, chunks."""
    d = documents.agg(F.count_if(~F.col("deleted")).alias("live_documents"), F.count_if("deleted").alias("deleted_documents"))
    return d.crossJoin(chunks.agg(F.count(F.lit(1)).alias("chunks")))  # one row each
