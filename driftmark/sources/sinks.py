"""Where change events are published: a sink sends a batch and says which events were acknowledged."""

from __future__ import annotations

from typing import Protocol

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftmark.functions.text import event_json, event_key

FIELDS = ("event_id", "document_id", "event_type", "document_version", "created_at")


def messages(batch: DataFrame) -> DataFrame:
    """(``id``, ``key``, ``value``) of outbox rows."""
    return batch.select("id", event_key(F.col("document_id")).alias("key"), event_json(*[F.col(c) for c in FIELDS]).alias("value"))


class EventSink(Protocol):
    def send(self, batch: DataFrame) -> DataFrame | None:
        """Send outbox rows and return those (``id``) that were acknowledged; None if all were."""
        ...


class FileSink:
    """A folder of files with columns key and value; a batch is acknowledged once it is written as a whole."""

    def __init__(self, path: str) -> None:
        self.path = path

    def send(self, batch: DataFrame) -> None:
        # One file, as a batch is bounded by its limit and readers of the folder shall see its order.
        messages(batch).orderBy("id").select("key", "value").coalesce(1).write.mode("append").parquet(self.path)


class KafkaSink:
    """A topic, where Spark's connector is on the class path. Its producer waits for the acknowledgement of all
    replicas and the write fails if any is missing, so a batch is acknowledged as a whole or not at all; events of
    a failed batch may have arrived and go out again."""

    def __init__(self, servers: str, topic: str, timeout_ms: int = 30_000, **options: str) -> None:
        self.options = {"kafka.bootstrap.servers": servers, "topic": topic, "kafka.acks": "all", "kafka.enable.idempotence": "true", "kafka.linger.ms": "5", "kafka.delivery.timeout.ms": str(timeout_ms), "kafka.request.timeout.ms": str(timeout_ms // 2)} | options

    def send(self, batch: DataFrame) -> None:
        messages(batch).select("key", "value").write.format("kafka").options(**self.options).save()
