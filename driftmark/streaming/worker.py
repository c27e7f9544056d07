"""The indexing worker: a stream of change events applied at least once, with dead letters."""

from __future__ import annotations

from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from driftmark.engine import Engine
from driftmark.functions.text import decode_event
from driftmark.operators import metrics
from driftmark.session import as_uri, materialize, scratch
from driftmark.sources.files import Folder

MESSAGE = "key binary, value string"
DEAD = "key binary, value string, headers map<string,string>"


def read_events(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    """A stream of (key, value, source_topic, source_partition, source_offset) from a folder of files."""
    reader = spark.readStream.schema(MESSAGE)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path).select("key", "value", F.col("_metadata.file_path").alias("source_topic"), F.lit(0).alias("source_partition"), F.col("_metadata.row_index").alias("source_offset"))


def read_kafka(spark: SparkSession, servers: str, topic: str, **options: str) -> DataFrame:
    """The same from Kafka, where its connector is on the class path."""
    reader = spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers).option("subscribe", topic).option("startingOffsets", "earliest")
    for k, v in options.items():
        reader = reader.option(k, v)
    return reader.load().select("key", F.col("value").cast("string").alias("value"), F.col("topic").alias("source_topic"), F.col("partition").alias("source_partition"), F.col("offset").alias("source_offset"))


def dead_letters(rows: DataFrame, error_type: Any, error_message: Any, attempts: Any, failed_at: Any) -> DataFrame:
    """Key and value unchanged, what went wrong in ``headers``: the parts, and all of them as JSON."""
    parts = {
        "error_type": error_type, "error_message": error_message, "attempts": attempts.cast("string"), "source_topic": F.col("source_topic"),
        "source_partition": F.col("source_partition").cast("string"), "source_offset": F.col("source_offset").cast("string"), "failed_at": F.date_format(failed_at, "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx"),
    }
    flat = [x for k, v in parts.items() for x in (F.lit(f"dlq.{k}"), v)]
    details = F.to_json(F.struct(*[v.alias(k) for k, v in parts.items()]))
    trace = F.right(F.concat_ws(": ", error_type, error_message), F.lit(4000))
    return rows.select("key", "value", F.map_from_arrays(F.array(*flat[::2], F.lit("dlq.traceback"), F.lit("dlq.details")), F.array(*flat[1::2], trace, details)).alias("headers"))


def outcomes(decoded: DataFrame, results: DataFrame) -> DataFrame:
    """(``document_id``, ``outcome``) per event: of several events of a document the first has the outcome
    and the others find it done, as if they had been taken one by one.

    The first is found by an aggregation, which the map side reduces to a row per document and task, and joined
    with what happened to the document: a document with a third of all events is one row of that join's other side.
    """
    first = decoded.groupBy("document_id").agg(F.min("source_offset").alias("dm_first"))
    of = first.join(results.select("document_id", F.col("outcome").alias("dm_outcome")), "document_id", "left").select(F.col("document_id").alias("dm_id"), "dm_first", F.coalesce("dm_outcome", F.lit("skipped_stale")).alias("dm_outcome"))
    joined = decoded.join(of, (F.col("document_id") == F.col("dm_id")) & (F.col("source_offset") == F.col("dm_first")), "left")
    return joined.select("document_id", F.coalesce("dm_outcome", F.lit("skipped_stale")).alias("outcome"))


class Worker:
    """Applies events batch by batch. A batch that fails is replayed from the checkpoint, and one that was
    committed before is skipped, so repeated and disordered events do no harm.

    Batches are known by the checkpoint's own id, so a new checkpoint starts from its first batch. With ``metrics``
    each batch leaves its counters there, a replay its own again.
    """

    def __init__(self, engine: Engine, events: DataFrame, checkpoint: str, dead: str, name: str = "worker", metrics: str | None = None) -> None:
        self.engine, self.events, self.checkpoint, self.dead, self.name, self.metrics = engine, events, checkpoint, dead, name, metrics

    def identity(self) -> str:
        """The name and the id that Spark wrote into the checkpoint."""
        folder = Folder(self.engine.spark, as_uri(self.checkpoint))
        return f"{self.name}-{folder.load('metadata')['id']}" if folder.exists("metadata") else self.name

    def apply(self, batch: DataFrame, batch_id: int) -> None:
        with scratch(self.engine.spark):
            self._apply(batch, batch_id, self.identity())

    def _apply(self, batch: DataFrame, batch_id: int, worker: str) -> None:
        decoded = materialize(batch.withColumn("e", decode_event(F.col("value"))), "decoded")
        good, bad = decoded.filter("e.error IS NULL"), decoded.filter("e.error IS NOT NULL")
        now, name = self.engine.now(), f"{worker}-{batch_id:012d}"
        # Keyed by batch: a replay overwrites its own letters. Those of malformed events do not wait for the commit,
        # those of failed documents are written from what the commit kept, by whichever attempt comes after it.
        n_good, n_bad = decoded.agg(F.count_if(F.col("e.error").isNull()), F.count_if(F.col("e.error").isNotNull())).collect()[0]
        if n_bad:
            self._letters(dead_letters(bad, F.lit("ValueError"), F.col("e.error"), F.lit(1), now), name)
        plan = self.engine.process(good.select(F.col("e.document_id").alias("document_id")), worker, batch_id)
        if (failures := self.engine.failures(worker, batch_id)) is not None and not failures.isEmpty():
            failed = good.join(failures.withColumnRenamed("document_id", "d"), F.col("e.document_id") == F.col("d"))
            self._letters(dead_letters(failed, F.col("error_type"), F.col("error_message"), F.col("attempts"), now), f"{name}-failed")
        if self.metrics is not None and plan is not None:
            metrics.batch_samples(plan.results, n_good, n_bad, now).write.mode("overwrite").parquet(f"{self.metrics}/batch={name}")

    def _letters(self, letters: DataFrame, batch: str) -> None:
        letters.write.mode("overwrite").parquet(f"{self.dead}/batch={batch}")

    def _writer(self) -> Any:
        return self.events.writeStream.foreachBatch(self.apply).option("checkpointLocation", self.checkpoint).queryName(self.name)

    def drain(self) -> None:
        """Apply all that is there and stop."""
        self._writer().trigger(availableNow=True).start().awaitTermination()

    def start(self, interval: str = "1 second") -> StreamingQuery:
        """Run until ``stop()``."""
        return self._writer().trigger(processingTime=interval).start()


def read_dead_letters(spark: SparkSession, path: str) -> DataFrame:
    if not Folder(spark, as_uri(path)).names():
        return spark.createDataFrame([], DEAD + ", batch string")
    return spark.read.schema(DEAD + ", batch string").parquet(path)


def progress_lag(query: StreamingQuery) -> list[dict[str, Any]]:
    """What the last progress says about rows read and processed, per source."""
    last = query.lastProgress
    return [] if last is None else [{"source": s["description"], "end": s["endOffset"], "rows": s["numInputRows"]} for s in last["sources"]]
