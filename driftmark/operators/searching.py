"""Cosine search over the chunks of live documents, and the state of one document's index."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftmark.functions.vectors import cosine_similarity, literal


class InvalidRequest(ValueError):
    """A request that cannot be answered."""


def search(chunks: DataFrame, documents: DataFrame, state: DataFrame, vector: list[float], top_k: int = 5, document_id: str | None = None) -> DataFrame:
    """(``document_id``, ``title``, ``indexed_version``, ``position``, ``content``, ``score``), best first.

    An exact scan. Chunks of deleted documents are left out before the limit, so they cannot crowd out others.
    Each task keeps its k best (``TakeOrderedAndProject``); titles, contents and vectors are not shuffled
    beyond that, as the joins to live ids come first and are broadcast only where Spark knows them to be
    small. Ties go to the smaller document id, then position. Chunks without a usable vector are not found.
    """
    if not 1 <= top_k <= 50:
        raise InvalidRequest("top_k must be between 1 and 50")
    scored = chunks if document_id is None else chunks.filter(F.col("document_id") == document_id)
    scored = scored.select("document_id", "position", "content", cosine_similarity(F.col("embedding"), literal(vector)).alias("score")).filter(F.col("score").isNotNull())
    live = documents.filter(~F.col("deleted")).select("document_id", "title")
    held = state.filter(~F.col("deleted")).select("document_id", "indexed_version")
    found = scored.join(live, "document_id").join(held, "document_id")
    return found.orderBy(F.col("score").desc(), "document_id", "position").limit(top_k).select("document_id", "title", "indexed_version", "position", "content", "score")


def above(hits: DataFrame, threshold: float = 0.01) -> DataFrame:
    """Hits with a score worth showing; applied after the limit."""
    return hits.filter(F.col("score") > threshold)


def containing(hits: DataFrame, text: str) -> DataFrame:
    """The hits whose content contains a text."""
    return hits.filter(F.col("content").contains(text))


def index_status(documents: DataFrame, outbox: DataFrame, state: DataFrame, chunks: DataFrame) -> DataFrame:
    """Per document: when its current version was first published, what is indexed, its chunks in order.

    ``chunks`` is an array of structs by position; a document bounds its length.
    """
    published = outbox.groupBy("document_id", F.col("document_version").alias("version")).agg(F.min("published_at").alias("published_at"))
    held = state.select("document_id", "indexed_version", "indexed_at", F.col("deleted").alias("index_deleted"))
    listed = chunks.groupBy("document_id").agg(F.array_sort(F.collect_list(F.struct("position", "content_hash", F.col("document_version").alias("embedded_at_version"), "content"))).alias("chunks"))
    out = documents.join(published, ["document_id", "version"], "left").join(held, "document_id", "left").join(listed, "document_id", "left")
    return out.select("document_id", "title", "version", "deleted", "updated_at", "published_at", "indexed_version", "indexed_at", F.coalesce("chunks", F.array().cast("array<struct<position:int,content_hash:string,embedded_at_version:int,content:string>>")).alias("chunks"))
