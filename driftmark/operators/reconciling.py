"""Finding what fell out of step, and queueing or removing it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from driftmark.operators.indexing import stale


def find_stale(documents: DataFrame, state: DataFrame, outbox: DataFrame, as_of: Column, grace_seconds: float = 60.0, limit: int | None = 1000) -> DataFrame:
    """(``document_id``, ``version``, ``deleted``) behind their index, unchanged for the grace period (strictly),
    with no unpublished event of at least that version; the longest unchanged first, ties by id.

    The limit is how many one pass queues, the rest waits for the next; None lifts it.
    """
    waiting = outbox.filter(F.col("published_at").isNull()).groupBy(F.col("document_id").alias("d")).agg(F.max("document_version").alias("v"))
    due = stale(documents, state).filter(F.col("updated_at") < as_of - F.make_dt_interval(secs=F.lit(grace_seconds)))
    due = due.join(waiting, (F.col("document_id") == F.col("d")) & (F.col("v") >= F.col("version")), "left_anti")
    if limit is not None:
        due = due.orderBy("updated_at", "document_id").limit(limit)
    return due.select("document_id", "version", "deleted")


def live(documents: DataFrame) -> DataFrame:
    return documents.filter(~F.col("deleted")).select("document_id")


def orphan_chunks(chunks: DataFrame, documents: DataFrame) -> DataFrame:
    """(``document_id``, ``n_chunks``) of chunks whose document is missing or deleted.

    Counted per document before the join, so that a hot document is one row.
    """
    counted = chunks.groupBy("document_id").agg(F.count(F.lit(1)).alias("n_chunks"))
    return counted.join(live(documents), "document_id", "left_anti")


def survivors(chunks: DataFrame, documents: DataFrame) -> DataFrame:
    """The chunks that stay when orphans are removed."""
    return chunks.join(live(documents), "document_id", "left_semi")
