"""The published workload through the whole engine: a burst of new documents, then edits of a tenth of their
paragraphs, and a report of both as Markdown."""

from __future__ import annotations

import time
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from driftmark.engine import Engine
from driftmark.functions import text
from driftmark.operators import metrics, workload
from driftmark.session import materialize, new_folder
from driftmark.settings import Settings
from driftmark.streaming.worker import Worker, read_events

SEED = 42


def rewritten(documents: DataFrame) -> DataFrame:
    """The documents of which about a tenth of all paragraphs, drawn by seed, number and place, got a sentence more."""
    parts = documents.select("number", "document_id", "title", text.paragraphs(F.col("content")).alias("ps"))
    key = lambda i: F.concat_ws(":", F.lit(str(SEED)), F.col("number").cast("string"), i.cast("string"))
    new = workload.rewrite(F.col("ps"), lambda i: F.substring(F.md5(key(i)), 1, 2) < "1a", lambda p: F.concat(p, F.lit(" It was revised.")))
    return parts.withColumn("new", new).filter(F.col("new") != F.col("ps")).select("number", "document_id", "title", workload.join(F.col("new")).alias("content"))


def phases(spark: SparkSession, documents: int) -> list[dict[str, Any]]:
    """A row per phase. Time runs from the first write to the last index commit, lags from a document's change to
    the commit of its index; percentiles are nearest-rank."""
    engine = Engine(spark, new_folder(spark, "store"), Settings(buckets=8, relay_batch=100_000))
    folders = {n: new_folder(spark, n) for n in ("events", "checkpoint", "dead", "metrics")}
    made = materialize(workload.synthetic_documents(spark, documents, SEED), "documents")
    out: list[dict[str, Any]] = []
    before = 0
    for name, op, rows in (("seed", "create", made), ("edit", "update", materialize(rewritten(made), "edited"))):
        start = time.perf_counter()
        engine.apply(rows.select(F.col("number").alias("seq"), F.lit(op).alias("op"), "document_id", "title", "content"))
        engine.drain(folders["events"])
        Worker(engine, read_events(spark, folders["events"]), folders["checkpoint"], folders["dead"], metrics=folders["metrics"]).drain()
        seconds = time.perf_counter() - start
        named = rows.select("document_id")
        docs, state = engine.store.read("documents", columns=["document_id", "updated_at"]), engine.store.read("index_state")
        lags = docs.join(state, "document_id").join(named, "document_id", "left_semi").select((metrics.lag_seconds(F.col("indexed_at"), F.col("updated_at")) * 1000).alias("ms"))
        ranks = metrics.nearest_ranks(lags, "ms", (*metrics.PERCENTILES, 1.0)).head()
        chunks = engine.store.read("chunks", columns=["document_id", "content_hash"]).join(named, "document_id", "left_semi").count()
        total = metrics.read_counters(spark, folders["metrics"]).filter("name = 'chunks_total' AND label = 'embedded'").agg(F.max("value")).head()[0]
        embedded, before = int(total) - before, int(total)
        out.append({"phase": name, "documents": rows.count(), "seconds": round(seconds, 3), "lag_ms": [round(x) for x in ranks], "chunks": chunks, "embedded": embedded})
    if engine.verify().count():
        raise AssertionError("the index is not in step")
    return out


def report(rows: list[dict[str, Any]]) -> str:
    """Phases as Markdown."""
    lines = ["| phase | documents | documents/s | lag p50 ms | p95 | p99 | max | chunks | embedded | avoided |", "|---|---|---|---|---|---|---|---|---|---|"]
    for r in rows:
        avoided = 1 - r["embedded"] / r["chunks"] if r["chunks"] else float("nan")
        lines.append(f"| {r['phase']} | {r['documents']} | {r['documents'] / r['seconds']:.1f} | " + " | ".join(map(str, r["lag_ms"])) + f" | {r['chunks']} | {r['embedded']} | {100 * avoided:.1f} % |")
    return "\n".join(lines)
