"""Creates, updates and soft deletes of versioned documents, with their change events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

CREATE, UPDATE, REMOVE = "create", "update", "delete"


def numbered(rows: DataFrame, key: str, order: str, name: str, width: int = 4096) -> DataFrame:
    """``rows`` with their number (from 1) by ``order`` within ``key``, without one task per key.

    Rows are numbered within blocks of ``order`` values; a block's offset is the count of the blocks before
    it. So a key that holds a third of all rows is spread over as many tasks as it has blocks. ``order`` must
    be a whole number that is unique within the key.
    """
    block = rows.withColumn("dm_block", F.floor(F.col(order) / width))
    counts = block.groupBy(key, "dm_block").agg(F.count(F.lit(1)).alias("dm_n"))
    before = Window.partitionBy(key).orderBy("dm_block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.withColumn("dm_before", F.coalesce(F.sum("dm_n").over(before), F.lit(0))).drop("dm_n")
    own = F.row_number().over(Window.partitionBy(key, "dm_block").orderBy(order))
    return block.join(offsets, [key, "dm_block"]).withColumn(name, (own + F.col("dm_before")).cast("int")).drop("dm_block", "dm_before")


def fold(documents: DataFrame, mutations: DataFrame) -> DataFrame:
    """The effective mutations with the version each leads to.

    ``mutations``: seq (arrival, unique), op, document_id, title, content. A create needs an unknown document,
    an update or delete a live one; what finds no such document is dropped, so that nothing follows a delete.
    Within a batch the first create of an unknown document counts and later creates of it are dropped.
    Returns document_id, seq, op, title, content, version, base_version.
    """
    base = documents.select("document_id", F.col("version").alias("base_version"), F.col("deleted").alias("base_deleted"))
    seen = mutations.filter(F.col("document_id").isNotNull() & F.col("op").isin(CREATE, UPDATE, REMOVE)).join(base, "document_id", "left").filter(~F.coalesce("base_deleted", F.lit(False)))
    known = F.col("base_version").isNotNull()
    bounds = seen.groupBy("document_id").agg(
        F.min(F.when(F.col("op") == CREATE, F.col("seq"))).alias("first_create"),
    )
    valid = seen.join(bounds, "document_id").filter(F.when(known, F.col("op") != CREATE).otherwise((F.col("op") == CREATE) & (F.col("seq") == F.col("first_create")) | (F.col("op") != CREATE) & (F.col("seq") > F.col("first_create"))))
    ends = valid.groupBy("document_id").agg(F.min(F.when(F.col("op") == REMOVE, F.col("seq"))).alias("first_delete"))
    kept = valid.join(ends, "document_id").filter(F.col("first_delete").isNull() | (F.col("seq") <= F.col("first_delete")))
    ranked = numbered(kept, "document_id", "seq", "dm_rank")
    return ranked.select("document_id", "seq", "op", "title", "content", (F.coalesce("base_version", F.lit(0)) + F.col("dm_rank")).alias("version"), "base_version")


def next_documents(documents: DataFrame, folded: DataFrame, as_of: Column) -> DataFrame:
    """All documents after the batch: untouched ones, and touched ones in their last version.

    A delete keeps title and content.
    """
    text = F.when(F.col("op") != REMOVE, F.struct("title", "content"))
    last = folded.groupBy("document_id").agg(
        F.max("version").alias("new_version"), F.bool_or(F.col("op") == REMOVE).alias("gone"),
        F.max_by(text, F.when(text.isNotNull(), F.col("version"))).alias("text"),
    )
    joined = documents.join(last, "document_id", "full_outer")
    hit = F.col("new_version").isNotNull()
    return joined.select(
        "document_id", F.coalesce("text.title", "title").alias("title"), F.coalesce("text.content", "content").alias("content"),
        F.coalesce("new_version", "version").alias("version"), F.coalesce("gone", "deleted").alias("deleted"), F.when(hit, as_of).otherwise(F.col("updated_at")).alias("updated_at"),
    )


def new_event_id(document_id: Column, version: Column, cause: str) -> Column:
    """A UUID that is the same whenever the same event is made again."""
    h = F.sha2(F.concat_ws("|", document_id, version.cast("string"), F.lit(cause)), 256)
    return F.concat_ws("-", F.substring(h, 1, 8), F.substring(h, 9, 4), F.concat(F.lit("4"), F.substring(h, 14, 3)), F.concat(F.lit("8"), F.substring(h, 18, 3)), F.substring(h, 21, 12))


def events(rows: DataFrame, first_id: int, as_of: Column, cause: str = "write") -> DataFrame:
    """Outbox rows, unpublished, for (document_id, version, deleted), ids in order of document and version."""
    from driftmark.operators.changelog import DELETE, UPSERT

    order = Window.orderBy("dm_part")
    # Ids without one global sort: rows are counted per partition, then numbered within theirs.
    parted = rows.repartitionByRange("document_id", "version").withColumn("dm_part", F.spark_partition_id())
    counts = parted.groupBy("dm_part").agg(F.count(F.lit(1)).alias("dm_n"))
    offsets = counts.withColumn("dm_before", F.coalesce(F.sum("dm_n").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("dm_n")
    numbered_rows = parted.join(F.broadcast(offsets), "dm_part")  # one row per partition
    own = F.row_number().over(Window.partitionBy("dm_part").orderBy("document_id", "version"))
    return numbered_rows.select(
        (F.lit(first_id) + own + F.col("dm_before")).cast("long").alias("id"), new_event_id(F.col("document_id"), F.col("version"), cause).alias("event_id"), "document_id",
        F.when(F.col("deleted"), DELETE).otherwise(UPSERT).alias("event_type"), F.col("version").cast("int").alias("document_version"), as_of.alias("created_at"), F.lit(None).cast("timestamp").alias("published_at"),
    )
