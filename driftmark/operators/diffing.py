"""What has to be done so that the stored chunks of documents become the desired ones."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

EMBED, REUSE, MOVE, DELETE = "embed", "reuse", "move", "delete"


def diff_chunks(desired: DataFrame, stored: DataFrame) -> DataFrame:
    """(``document_id``, ``content_hash``, ``action``, ``position``, ``stored_position``).

    ``embed``: desired only. ``reuse``: in both at the same position. ``move``: in both, at another position.
    ``delete``: stored only. One full outer join on (document, hash); ``stored`` must be restricted to the
    documents at hand, or untouched documents look deleted. Vectors are not needed here and are not read. Of
    stored rows that repeat a hash the least position counts; null positions count as moved.
    """
    want = desired.select("document_id", "content_hash", "position").withColumn("wanted", F.lit(True))
    have = stored.groupBy("document_id", "content_hash").agg(F.min("position").alias("stored_position")).withColumn("held", F.lit(True))
    joined = want.join(have, ["document_id", "content_hash"], "full_outer")
    action = (
        F.when(F.col("held").isNull(), EMBED)
        .when(F.col("wanted").isNull(), DELETE)
        .when(F.col("position").eqNullSafe(F.col("stored_position")), REUSE)
        .otherwise(MOVE)
    )
    return joined.select("document_id", "content_hash", action.alias("action"), "position", "stored_position")


def summarize(diff: DataFrame) -> DataFrame:
    """Counts per document: to_embed, to_reuse (moved ones among them), repositioned, to_delete, is_noop."""
    n = lambda *a: F.count_if(F.col("action").isin(*a))
    per = diff.groupBy("document_id").agg(n(EMBED).alias("to_embed"), n(REUSE, MOVE).alias("to_reuse"), n(MOVE).alias("repositioned"), n(DELETE).alias("to_delete"))
    return per.withColumn("is_noop", (F.col("to_embed") + F.col("repositioned") + F.col("to_delete")) == 0)


def touched(stored: DataFrame, documents: DataFrame) -> DataFrame:
    """The stored rows of the documents at hand."""
    return stored.join(documents.select("document_id"), "document_id", "left_semi")
