"""Queries of the engine's own operators over the exported tables."""

from __future__ import annotations

import dataclasses
from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from driftmark.functions import text
from driftmark.functions.vectors import close, cosine_distance, cosine_similarity, literal, norm
from driftmark.engine import Engine
from driftmark.operators import diffing, indexing, metrics, mutations, reconciling, searching, verifying, workload
from driftmark.operators.cells import CellIndex
from driftmark.operators.chunking import chunk_documents
from driftmark.operators.embedding import FailingProvider, HashedWords, RetryPolicy, embed_texts
from driftmark.plans import clean
from driftmark.session import materialize, new_folder
from driftmark.settings import Settings
from driftmark.sources.tables import table
from driftmark.streaming import benchmark, worker

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}
#: The clock of the queries, so that they and their SQL agree.
AS_OF = datetime(2026, 1, 1, tzinfo=timezone.utc)
AS_OF_SQL = "TIMESTAMPTZ '2026-01-01 00:00:00+00'"
_PRE = clean.sql_prefix()
_LIVE = "live AS (SELECT document_id, content FROM d WHERE NOT deleted)"
_DESIRED = f"{_LIVE}, {clean.chunker_sql('live')}"
_DIFF = f"""{_DESIRED},
st AS (SELECT document_id, content_hash, min(position) AS stored_position FROM c WHERE document_id IN (SELECT document_id FROM live) GROUP BY ALL),
x AS (SELECT coalesce(k.document_id, st.document_id) AS document_id, coalesce(k.content_hash, st.content_hash) AS content_hash, k.position, st.stored_position,
  CASE WHEN st.document_id IS NULL THEN 'embed' WHEN k.document_id IS NULL THEN 'delete' WHEN k.position IS NOT DISTINCT FROM st.stored_position THEN 'reuse' ELSE 'move' END AS action
  FROM k FULL JOIN st ON k.document_id = st.document_id AND k.content_hash = st.content_hash)"""


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLES[f.__name__] = f"WITH {_PRE}{',' if not sql.lstrip().startswith('SELECT') else ''} {sql}"
        return f

    return add


def _live(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.documents(spark, sf_dir).filter(~F.col("deleted"))


def _now() -> Column:
    return F.lit(AS_OF)


def _desired(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunk_documents(_live(spark, sf_dir).select("document_id", "content"))


def _diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = clean.chunks(spark, sf_dir).select("document_id", "content_hash", "position")
    return diffing.diff_chunks(_desired(spark, sf_dir), diffing.touched(stored, _live(spark, sf_dir)))


# Documents


@query("SELECT document_id, title, version, updated_at FROM d WHERE NOT deleted")
def docs_live(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _live(spark, sf_dir).select("document_id", "title", "version", "updated_at")


def _least(spark: SparkSession, sf_dir: str, live: bool) -> str:
    """The id to look up: the least one. One value is read to the driver."""
    docs = clean.documents(spark, sf_dir).filter(~F.col("deleted")) if live else clean.documents(spark, sf_dir).filter("deleted")
    return str(docs.agg(F.min("document_id")).collect()[0][0])


@query("SELECT document_id, version, title FROM d WHERE NOT deleted AND document_id = (SELECT min(document_id) FROM d WHERE NOT deleted)")
def docs_point_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One live document by its id, a literal that is applied before anything is aggregated."""
    return clean.documents(spark, sf_dir, _least(spark, sf_dir, True)).filter(~F.col("deleted")).select("document_id", "version", "title")


@query("SELECT document_id, version, deleted FROM d WHERE document_id = (SELECT min(document_id) FROM d WHERE deleted)")
def docs_point_lookup_tombstone(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One document by its id, deleted or not."""
    return clean.documents(spark, sf_dir, _least(spark, sf_dir, False)).select("document_id", "version", "deleted")


@query("SELECT document_id, updated_at, version FROM d ORDER BY updated_at, document_id LIMIT 20")
def docs_page_by_updated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.documents(spark, sf_dir).select("document_id", "updated_at", "version").orderBy("updated_at", "document_id").limit(20)


@query("SELECT deleted, count(*) AS documents, CAST(sum(version + 1) AS BIGINT) AS next_versions, min(updated_at) AS first_change, max(updated_at) AS last_change FROM d GROUP BY 1")
def docs_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.documents(spark, sf_dir).groupBy("deleted").agg(F.count(F.lit(1)).alias("documents"), F.sum(F.col("version") + 1).alias("next_versions"), F.min("updated_at").alias("first_change"), F.max("updated_at").alias("last_change"))


# Text and chunks


@query(f"SELECT doc_id, {clean.normal_sql('text')} AS normal, sha256({clean.normal_sql('text')}) AS content_hash FROM documents")
def normalize_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", text.normalize(F.col("text")).alias("normal"))
    return docs.withColumn("content_hash", F.sha2("normal", 256))


@query(f"p AS (SELECT document_id, {clean.paragraphs_sql('content')} AS ps FROM d WHERE content IS NOT NULL) SELECT document_id, CAST(i - 1 AS INTEGER) AS paragraph_no, ps[i] AS paragraph FROM (SELECT document_id, ps, unnest(range(1, len(ps) + 1)) AS i FROM p)")
def paragraphs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.documents(spark, sf_dir).select("document_id", F.posexplode(text.paragraphs(F.col("content"))).alias("paragraph_no", "paragraph"))


@query(f"al AS (SELECT document_id, content FROM d), {clean.chunker_sql('al')} SELECT document_id, CAST(i - 1 AS INTEGER) AS group_no, t AS group_text FROM k3")
def chunk_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    merged = text.merge_small(text.paragraphs(F.col("content")), 80)
    return clean.documents(spark, sf_dir).select("document_id", F.posexplode(merged).alias("group_no", "group_text"))


@query(f"{_DESIRED} SELECT document_id, position, content, content_hash FROM k")
def chunk_document(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _desired(spark, sf_dir)


@query(f"al AS (SELECT CAST(doc_id AS VARCHAR) AS document_id, text AS content FROM documents), {clean.chunker_sql('al')} SELECT coalesce(lang, '') AS lang, count(*) AS chunks, count(DISTINCT document_id) AS documents, CAST(sum(length(content)) AS BIGINT) AS characters, max(position) AS last_position FROM k JOIN documents ON CAST(doc_id AS VARCHAR) = document_id GROUP BY 1")
def chunk_stats_by_lang(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("document_id"), "text", F.coalesce("lang", F.lit("")).alias("lang"))
    cut = chunk_documents(docs.select("document_id", F.col("text").alias("content")))
    per = cut.groupBy("document_id").agg(F.count(F.lit(1)).alias("n"), F.sum(F.length("content")).alias("c"), F.max("position").alias("p"))
    return per.join(docs.select("document_id", "lang"), "document_id").groupBy("lang").agg(F.sum("n").alias("chunks"), F.count(F.lit(1)).alias("documents"), F.sum("c").alias("characters"), F.max("p").alias("last_position"))


@query("SELECT document_id, CAST(i AS INTEGER) AS window_no, sha256(substr(content, i * 200 + 1, 200)) AS window_hash FROM (SELECT document_id, content, unnest(range(0, CAST(ceil(length(content) / 200.0) AS BIGINT))) AS i FROM d WHERE content IS NOT NULL)")
def fixed_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = clean.documents(spark, sf_dir).select("document_id", F.posexplode(text.fixed_windows(F.col("content"), 200)).alias("window_no", "w"))
    return cut.select("document_id", "window_no", F.sha2("w", 256).alias("window_hash"))


@query("SELECT document_id, CAST(ceil(length(content) / 200.0) AS BIGINT) AS windows_before, CAST(ceil((length(content) + 19) / 200.0) AS BIGINT) AS windows_after FROM d WHERE NOT deleted AND content IS NOT NULL")
def fixed_window_vs_paragraph(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many windows of 200 characters a document has before and after one sentence is put in front."""
    n = lambda c: F.size(text.fixed_windows(c, 200)).cast("long")
    return _live(spark, sf_dir).filter("content IS NOT NULL").select("document_id", n(F.col("content")).alias("windows_before"), n(F.concat(F.lit("Inserted sentence. "), "content")).alias("windows_after"))


# Diff


@query(f"{_DIFF} SELECT document_id, content_hash, action, position, stored_position FROM x")
def diff_actions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _diff(spark, sf_dir)


@query(f"""{_DIFF} SELECT document_id, count(*) FILTER (action = 'embed') AS to_embed, count(*) FILTER (action IN ('reuse', 'move')) AS to_reuse, count(*) FILTER (action = 'move') AS repositioned,
count(*) FILTER (action = 'delete') AS to_delete, bool_and(action = 'reuse') AS is_noop FROM x GROUP BY 1""")
def diff_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return diffing.summarize(_diff(spark, sf_dir))


@query(f"{_DIFF} SELECT count(*) FILTER (action = 'embed') AS embedded, count(*) FILTER (action <> 'delete') AS total, 1 - count(*) FILTER (action = 'embed') / count(*) FILTER (action <> 'delete') AS avoided FROM x")
def reembed_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = _diff(spark, sf_dir).agg(F.count_if(F.col("action") == "embed").alias("embedded"), F.count_if(F.col("action") != "delete").alias("total"))
    return n.withColumn("avoided", 1 - F.col("embedded") / F.col("total"))


# Staleness, orphans, outbox


@query("SELECT count(*) AS n FROM d LEFT JOIN s ON d.document_id = s.document_id WHERE s.indexed_version IS NULL OR s.indexed_version < d.version")
def stale_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return indexing.stale(clean.documents(spark, sf_dir).drop("content"), clean.index_state(spark, sf_dir)).agg(F.count(F.lit(1)).alias("n"))


_STALE = f"""stl AS (SELECT d.document_id, d.version, d.deleted, d.updated_at FROM d LEFT JOIN s ON d.document_id = s.document_id WHERE (s.indexed_version IS NULL OR s.indexed_version < d.version)
AND d.updated_at < {AS_OF_SQL} - INTERVAL 60 SECOND AND NOT EXISTS (SELECT 1 FROM o WHERE o.document_id = d.document_id AND o.published_at IS NULL AND o.document_version >= d.version))"""


@query(f"{_STALE} SELECT document_id, version, deleted FROM stl")
def stale_find(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reconciling.find_stale(clean.documents(spark, sf_dir).drop("content"), clean.index_state(spark, sf_dir), clean.outbox(spark, sf_dir), _now(), limit=None)


@query(f"{_STALE} SELECT document_id, version, deleted FROM stl ORDER BY updated_at, document_id LIMIT 50")
def stale_oldest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reconciling.find_stale(clean.documents(spark, sf_dir).drop("content"), clean.index_state(spark, sf_dir), clean.outbox(spark, sf_dir), _now(), limit=50)


@query("SELECT o.id, o.document_id, o.document_version FROM o JOIN d ON o.document_id = d.document_id WHERE o.published_at IS NULL AND o.document_version >= d.version")
def pending_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = clean.documents(spark, sf_dir).select("document_id", "version")
    waiting = clean.outbox(spark, sf_dir).filter("published_at IS NULL")
    return waiting.join(docs, "document_id").filter("document_version >= version").select("id", "document_id", "document_version")


@query("SELECT c.document_id, count(*) AS n_chunks FROM c LEFT JOIN d ON d.document_id = c.document_id WHERE d.document_id IS NULL OR d.deleted GROUP BY 1")
def orphans_by_document(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reconciling.orphan_chunks(clean.chunks(spark, sf_dir), clean.documents(spark, sf_dir))


@query("SELECT c.id, c.document_id, c.position FROM c SEMI JOIN (SELECT * FROM d WHERE NOT deleted) d ON d.document_id = c.document_id")
def orphans_survivors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reconciling.survivors(clean.chunks(spark, sf_dir), clean.documents(spark, sf_dir)).select("id", "document_id", "position")


@query("SELECT id, event_id, document_id, event_type, document_version FROM o WHERE published_at IS NULL ORDER BY id LIMIT 500")
def outbox_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.outbox(spark, sf_dir).filter("published_at IS NULL").orderBy("id").limit(500).select("id", "event_id", "document_id", "event_type", "document_version")


@query("SELECT event_type, published_at IS NOT NULL AS published, count(*) AS n FROM o GROUP BY ALL")
def outbox_backlog(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.outbox(spark, sf_dir).groupBy("event_type", F.col("published_at").isNotNull().alias("published")).agg(F.count(F.lit(1)).alias("n"))


@query("SELECT document_id, document_version, min(published_at) AS published_at FROM o WHERE document_id IS NOT NULL GROUP BY ALL")
def first_published(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.outbox(spark, sf_dir).filter("document_id IS NOT NULL").groupBy("document_id", "document_version").agg(F.min("published_at").alias("published_at"))


@query("""pub AS (SELECT document_id, document_version, min(published_at) AS p FROM o GROUP BY ALL),
cs AS (SELECT document_id, count(*) AS n, string_agg(content_hash, ',' ORDER BY position NULLS FIRST, content_hash) AS h FROM c GROUP BY 1)
SELECT d.document_id, d.version, d.deleted, pub.p AS published_at, s.indexed_version, s.indexed_at, coalesce(cs.n, 0) AS n_chunks, coalesce(cs.h, '') AS hashes
FROM d LEFT JOIN pub ON pub.document_id = d.document_id AND pub.document_version = d.version LEFT JOIN s ON s.document_id = d.document_id LEFT JOIN cs ON cs.document_id = d.document_id""")
def index_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    all_status = searching.index_status(clean.documents(spark, sf_dir), clean.outbox(spark, sf_dir), clean.index_state(spark, sf_dir), clean.chunks(spark, sf_dir))
    return all_status.select("document_id", "version", "deleted", "published_at", "indexed_version", "indexed_at", F.size("chunks").cast("long").alias("n_chunks"), F.array_join(F.col("chunks.content_hash"), ",").alias("hashes"))


# Events


def _payload() -> Column:
    """Whole and broken payloads, by id: every kind of damage occurs."""
    good = text.event_json(F.col("event_id"), F.col("document_id"), F.col("event_type"), F.col("document_version"), F.col("created_at"))
    n = F.col("id") % 11
    return F.when(n == 1, F.substring(good, 1, 40)).when(n == 2, F.replace(good, F.lit("+00:00"), F.lit(""))).when(n == 3, F.replace(good, F.lit("upserted"), F.lit("created"))).when(n == 4, F.lit("[1, 2]")).when(n == 5, F.lit(None)).otherwise(good)


@query("""b AS (SELECT id, id % 11 AS n, event_type AS t, document_id AS di, event_id AS ei FROM o),
w AS (SELECT id, CASE WHEN n IN (1, 4, 5) THEN 'malformed payload' WHEN n = 3 AND t = 'upserted' OR t IS NULL OR t NOT IN ('upserted', 'deleted') THEN 'unknown event type' WHEN n = 2 THEN 'time without offset' WHEN di IS NULL OR ei IS NULL THEN 'malformed id' END AS error FROM b)
SELECT id, error FROM w""")
def event_decode_validate(spark: SparkSession, sf_dir: str) -> DataFrame:
    decoded = clean.outbox(spark, sf_dir).withColumn("e", text.decode_event(_payload()))
    return decoded.select("id", F.col("e.error").alias("error"))


_ERRORS = """b AS (SELECT id, id % 11 AS n, event_type AS t, document_id AS di, event_id AS ei FROM o),
w AS (SELECT id, di, CASE WHEN n IN (1, 4, 5) THEN 'malformed payload' WHEN n = 3 AND t = 'upserted' OR t IS NULL OR t NOT IN ('upserted', 'deleted') THEN 'unknown event type' WHEN n = 2 THEN 'time without offset' WHEN di IS NULL OR ei IS NULL THEN 'malformed id' END AS error FROM b)"""


@query(f"""{_ERRORS} SELECT CAST(id AS VARCHAR) AS source_offset, coalesce(di, '') AS message_key, error AS error_message, 'ValueError' AS error_type, '1' AS attempts, 'document-changes' AS source_topic, '0' AS source_partition,
  '2026-01-01T00:00:00.000000+00:00' AS failed_at, 'ValueError: ' || error AS traceback, id % 11 = 5 AS without_value, true AS details_agree FROM w WHERE error IS NOT NULL""")
def dead_letter_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What becomes of the broken payloads: key and value as they were, the rest in headers."""
    rows = clean.outbox(spark, sf_dir).select("id", text.event_key(F.col("document_id")).alias("key"), _payload().alias("value"), F.lit("document-changes").alias("source_topic"), F.lit(0).alias("source_partition"), F.col("id").alias("source_offset"))
    bad = rows.withColumn("e", text.decode_event(F.col("value"))).filter("e.error IS NOT NULL")
    letters = worker.dead_letters(bad, F.lit("ValueError"), F.col("e.error"), F.lit(1), _now())
    names = ("source_offset", "error_message", "error_type", "attempts", "source_topic", "source_partition", "failed_at", "traceback")
    details = F.from_json(F.col("headers")["dlq.details"], "error_type string, error_message string, source_offset string")
    agree = (details["error_type"] == F.col("headers")["dlq.error_type"]) & (details["error_message"] == F.col("headers")["dlq.error_message"]) & (details["source_offset"] == F.col("headers")["dlq.source_offset"])
    return letters.select(F.coalesce(F.col("key").cast("string"), F.lit("")).alias("message_key"), F.col("value").isNull().alias("without_value"), agree.alias("details_agree"), *[F.col("headers")[f"dlq.{n}"].alias(n) for n in names])


@query(f"{_ERRORS} SELECT error AS error_message, count(*) AS letters FROM w WHERE error IS NOT NULL GROUP BY 1")
def dead_letter_depth(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many dead letters there are of each kind."""
    decoded = clean.outbox(spark, sf_dir).select(text.decode_event(_payload()).alias("e")).filter("e.error IS NOT NULL")
    return decoded.groupBy(F.col("e.error").alias("error_message")).agg(F.count(F.lit(1)).alias("letters"))


@query("""r AS (SELECT o.document_id, row_number() OVER (PARTITION BY o.document_id ORDER BY o.id) AS n FROM o WHERE document_id IS NOT NULL),
w AS (SELECT CASE WHEN n > 1 OR d.document_id IS NULL OR s.indexed_version >= d.version THEN 'skipped_stale' WHEN d.deleted THEN 'deleted' ELSE 'indexed' END AS outcome
FROM r LEFT JOIN d ON d.document_id = r.document_id LEFT JOIN s ON s.document_id = r.document_id) SELECT outcome, count(*) AS n FROM w GROUP BY 1""")
def process_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each event of the outbox leads to, if all are taken in order."""
    events = clean.outbox(spark, sf_dir).filter("document_id IS NOT NULL").select("document_id", F.col("id").alias("source_offset"))
    due = indexing.stale(clean.documents(spark, sf_dir).drop("content"), clean.index_state(spark, sf_dir))
    results = due.select("document_id", F.when(F.col("deleted"), "deleted").otherwise("indexed").alias("outcome"))
    return worker.outcomes(events, results).groupBy("outcome").agg(F.count(F.lit(1)).alias("n"))


# Metrics


def _lags(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = clean.documents(spark, sf_dir).select("document_id", "version", "updated_at")
    held = clean.index_state(spark, sf_dir).select("document_id", "indexed_version", "indexed_at")
    both = docs.join(held, "document_id").filter("indexed_version >= version")
    return both.select("updated_at", "indexed_at", F.greatest(metrics.lag_seconds(F.col("indexed_at"), F.col("updated_at")), F.lit(0.0)).alias("lag"))


_LAGS = "l AS (SELECT d.updated_at, s.indexed_at, greatest((epoch_us(s.indexed_at) - epoch_us(d.updated_at)) / 1e6, 0.0) AS lag FROM d JOIN s ON d.document_id = s.document_id WHERE s.indexed_version >= d.version)"
_BOUNDS = ", ".join(f"({float(b)})" for b in metrics.LAG_BUCKETS)
_HISTOGRAM = f"b AS (SELECT CAST(col0 AS DOUBLE) AS le FROM (VALUES {_BOUNDS}) UNION ALL SELECT CAST('Infinity' AS DOUBLE)), h AS (SELECT le, (SELECT count(*) FROM l WHERE lag <= le) AS n FROM b)"


@query(f"""{_LAGS} SELECT count(*) AS documents, quantile_disc(lag, 0.5) AS p50, quantile_disc(lag, 0.95) AS p95, quantile_disc(lag, 0.99) AS p99, max(lag) AS longest,
round(count(*) / ((epoch_us(max(indexed_at)) - epoch_us(min(updated_at))) / 1e6), 9) AS per_second FROM l""")
def freshness_lag_percentiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    lags, seconds = _lags(spark, sf_dir), metrics.lag_seconds(F.max("indexed_at"), F.min("updated_at"))
    ranks = metrics.nearest_ranks(lags, "lag", metrics.PERCENTILES).select(*[F.col(f"p{i}").alias(f"p{int(p * 100)}") for i, p in enumerate(metrics.PERCENTILES)])
    whole = lags.agg(F.count(F.lit(1)).alias("documents"), F.max("lag").alias("longest"), F.round(metrics.throughput(F.count(F.lit(1)), seconds), 9).alias("per_second"))
    return whole.crossJoin(ranks)  # one row each


@query(f"{_LAGS}, {_HISTOGRAM} SELECT le, n FROM h")
def lag_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.histogram(_lags(spark, sf_dir), "lag")


@query(f"""{_LAGS}, {_HISTOGRAM}, q AS (SELECT *, lag(le) OVER (ORDER BY le) AS low, coalesce(lag(n) OVER (ORDER BY le), 0) AS below, max(n) OVER () AS total FROM h),
f AS (SELECT * FROM q WHERE n >= 0.95 * total ORDER BY le LIMIT 1)
SELECT round(CASE WHEN isinf(le) THEN low ELSE coalesce(low, 0) + (le - coalesce(low, 0)) * (0.95 * total - below) / (n - below) END, 6) AS value FROM f""")
def lag_histogram_quantile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.histogram_quantile(metrics.histogram(_lags(spark, sf_dir), "lag"), 0.95).select(F.round("value", 6).alias("value"))


def _samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counter samples with resets, from the click events: one series per type and half of the users."""
    e = table(spark, sf_dir, "events").select(F.col("ts").cast("timestamp").alias("ts"), "event_id", F.col("event_type").alias("name"), (F.col("user_id") % 2).alias("instance"))
    return e.withColumn("value", F.pmod(F.col("event_id"), F.lit(300)).cast("double"))


_SAMPLES = """smp AS (SELECT ts, event_id, event_type AS name, user_id % 2 AS instance, CAST(event_id % 300 AS DOUBLE) AS value FROM events),
dl AS (SELECT *, CASE WHEN p IS NULL THEN 0.0 WHEN value < p THEN value ELSE value - p END AS delta FROM (SELECT *, lag(value) OVER (PARTITION BY name, instance ORDER BY ts, event_id) AS p FROM smp))"""


@query(f"{_SAMPLES} SELECT CAST(time_bucket(INTERVAL 1 DAY, ts) AS VARCHAR) AS window_start, name, round(sum(delta), 6) AS increase, round(sum(delta) / 86400.0, 9) AS rate FROM dl GROUP BY ALL")
def counter_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = metrics.increase(_samples(spark, sf_dir), ["name", "instance"], "1 day", ["name"], ["ts", "event_id"])
    return out.select(F.date_format("window_start", "yyyy-MM-dd HH:mm:ss").alias("window_start"), "name", F.round("increase", 6).alias("increase"), F.round("rate", 9).alias("rate"))


@query(f"{_SAMPLES} SELECT name, round(sum(delta), 6) AS increase FROM dl GROUP BY ALL")
def counter_increase(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.counter_deltas(_samples(spark, sf_dir), ["name", "instance"], ["ts", "event_id"]).groupBy("name").agg(F.round(F.sum("delta"), 6).alias("increase"))


@query(f"{_SAMPLES} SELECT sum(v) AS total, max(v) AS greatest FROM (SELECT arg_max(value, (ts, event_id)) AS v FROM smp GROUP BY name, instance)")
def gauges_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.latest_gauges(_samples(spark, sf_dir), ["name", "instance"], ["ts", "event_id"])


@query(f"{_DIFF} SELECT round(count(*) FILTER (action IN ('reuse', 'move')) / greatest(count(*) FILTER (action <> 'delete'), 1), 9) AS ratio FROM x")
def reuse_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = _diff(spark, sf_dir).agg(F.count_if(F.col("action").isin("reuse", "move")).alias("r"), F.count_if(F.col("action") == "embed").alias("e"))
    return n.select(F.round(metrics.reuse_ratio(F.col("r"), F.col("e")), 9).alias("ratio"))


@query("""SELECT topic_partition, max(topic_offset) AS high, max(topic_offset) FILTER (batch_id <= 10) AS position, greatest(max(topic_offset) - coalesce(max(topic_offset) FILTER (batch_id <= 10), max(topic_offset)), 0) AS lag
FROM deliveries GROUP BY 1""")
def consumer_lag(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How far a consumer that stopped after ten batches is behind, per partition."""
    at = table(spark, sf_dir, "deliveries").groupBy("topic_partition").agg(F.max("topic_offset").alias("high"), F.max(F.when(F.col("batch_id") <= 10, F.col("topic_offset"))).alias("position"))
    return at.select("topic_partition", "high", "position", metrics.consumer_lag(F.col("high"), F.coalesce("position", F.lit(-1))).alias("lag"))


# Search and vectors


def _probe(spark: SparkSession, sf_dir: str) -> list[float]:
    """The query vector: that of the first row. One row is read to the driver."""
    return list(table(spark, sf_dir, "embeddings").filter("vec_id = 0").select("embedding").head()[0])  # type: ignore[index]


_SIM = "e0 AS (SELECT embedding AS q FROM embeddings WHERE vec_id = 0), sc AS (SELECT vec_id, label, list_cosine_similarity(embedding::DOUBLE[], q::DOUBLE[]) AS score FROM embeddings, e0)"


@query(f"{_SIM} SELECT vec_id, round(score, 6) AS score FROM sc ORDER BY sc.score DESC, vec_id LIMIT 5")
def search_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = table(spark, sf_dir, "embeddings").select("vec_id", cosine_similarity(F.col("embedding"), literal(_probe(spark, sf_dir))).alias("s"))
    return scored.orderBy(F.col("s").desc(), "vec_id").limit(5).select("vec_id", F.round("s", 6).alias("score"))


@query(f"{_SIM} SELECT vec_id, round(score, 6) AS score FROM sc ORDER BY sc.score DESC, vec_id LIMIT 5")
def search_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same through an index by cells, which ends when no cell that is left can hold anything better."""
    index = CellIndex.build(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"), new_folder(spark, "cells"))
    found, _ = index.search(_probe(spark, sf_dir), 5, ["vec_id"])
    return spark.createDataFrame([(r["vec_id"], r["score"]) for r in found], "vec_id long, score double").select("vec_id", F.round("score", 6).alias("score"))


@query(f"{_SIM} SELECT vec_id, round(score, 6) AS score FROM sc WHERE label = (SELECT min(label) FROM embeddings) ORDER BY sc.score DESC, vec_id LIMIT 5")
def search_scoped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Within one label, which stands for a document: a literal that reaches the scan. One value is read to the driver."""
    rows = table(spark, sf_dir, "embeddings")
    label = rows.agg(F.min("label")).collect()[0][0]
    scored = rows.filter(F.col("label") == label).select("vec_id", cosine_similarity(F.col("embedding"), literal(_probe(spark, sf_dir))).alias("s"))
    return scored.orderBy(F.col("s").desc(), "vec_id").limit(5).select("vec_id", F.round("s", 6).alias("score"))


@query(f"{_SIM}, t AS (SELECT * FROM sc ORDER BY score DESC, vec_id LIMIT 50) SELECT vec_id, round(score, 6) AS score FROM t WHERE score > 0.01")
def search_threshold(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = table(spark, sf_dir, "embeddings").select("vec_id", cosine_similarity(F.col("embedding"), literal(_probe(spark, sf_dir))).alias("score"))
    return searching.above(scored.orderBy(F.col("score").desc(), "vec_id").limit(50)).select("vec_id", F.round("score", 6).alias("score"))


@query("""e0 AS (SELECT embedding AS q FROM embeddings WHERE vec_id = 0), okc AS (SELECT * FROM c WHERE len(embedding) = 64 AND list_dot_product(embedding::DOUBLE[], embedding::DOUBLE[]) > 0),
sc AS (SELECT okc.document_id, d.title, s.indexed_version, okc.position, okc.content, list_cosine_similarity(okc.embedding::DOUBLE[], q::DOUBLE[]) AS score FROM okc JOIN d ON d.document_id = okc.document_id AND NOT d.deleted JOIN s ON s.document_id = okc.document_id AND NOT s.deleted, e0)
SELECT document_id, title, indexed_version, position, content, round(score, 5) AS score FROM sc ORDER BY sc.score DESC, document_id, position LIMIT 50""")
def search_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole search over chunks of live documents."""
    found = searching.search(clean.chunks(spark, sf_dir, "embedding"), clean.documents(spark, sf_dir), clean.index_state(spark, sf_dir), _probe(spark, sf_dir), 50)
    return found.withColumn("score", F.round("score", 5))


_TOKENS = "tk AS (SELECT doc_id, unnest(regexp_extract_all(lower({n}), '([\\p{{L}}\\p{{N}}_]+)', 1)) AS token FROM documents)".format(n=clean.normal_sql("text"))
_STOPS = ", ".join(f"'{w}'" for w in text.STOP_WORDS)


@query(f"{_TOKENS} SELECT token, count(*) AS n, CAST(('0x' || sha256(token)[1:16])::UBIGINT % 384 AS INTEGER) AS bucket FROM tk WHERE token NOT IN ({_STOPS}) GROUP BY 1")
def token_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How often each token occurs and where the hashed embedding puts it."""
    tokens = table(spark, sf_dir, "documents").select(F.explode(text.tokens(text.normalize(F.col("text")))).alias("token"))
    counted = tokens.groupBy("token").agg(F.count(F.lit(1)).alias("n"))
    bucket = F.conv(F.substring(F.sha2("token", 256), 1, 16), 16, 10).cast("decimal(20,0)") % 384
    return counted.select("token", "n", bucket.cast("int").alias("bucket"))


_EMBED = f"""{_TOKENS}, tf AS (SELECT doc_id, token, count(*) AS n FROM tk WHERE token NOT IN ({_STOPS}) GROUP BY ALL),
sl AS (SELECT doc_id, CAST(('0x' || sha256(token)[1:16])::UBIGINT % 64 AS INTEGER) AS slot, CASE WHEN CAST('0x' || sha256(token)[17:18] AS INTEGER) % 2 = 1 THEN 1.0 ELSE -1.0 END * (1 + ln(n)) AS x FROM tf),
vs AS (SELECT doc_id, slot, sum(x) AS x FROM sl GROUP BY ALL), ve AS (SELECT doc_id, slot, x / sqrt(sum(x * x) OVER (PARTITION BY doc_id)) AS x FROM vs)"""


@query(f"{_EMBED} SELECT doc_id, slot, round(x, 3) AS x FROM ve WHERE abs(x) > 0.3123")
def embed_hashed_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The large numbers of the hashed embedding of every text that has words, with their places."""
    rows = table(spark, sf_dir, "documents").select("doc_id", "text")
    worded = rows.filter(F.size(text.tokens(text.normalize(F.col("text")))) > 0)
    vectors = embed_texts(worded, HashedWords(64), "text", "doc_id").select("doc_id", F.posexplode("embedding").alias("slot", "x"))
    return vectors.filter(F.abs("x") > 0.3123).select("doc_id", "slot", F.round(F.col("x").cast("double"), 3).alias("x"))


@query(f"SELECT doc_id, true AS unit_length, true AS same_again FROM documents WHERE len(list_filter(regexp_extract_all(lower({clean.normal_sql('coalesce(text, chr(32))')}), '([\\p{{L}}\\p{{N}}_]+)', 1), lambda w: w NOT IN ({_STOPS}))) = 0")
def embed_without_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts without words get a vector that the text seeds: of unit length, the same whenever it is made."""
    rows = table(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit(" ")).alias("text"))
    bare = rows.filter(F.size(text.tokens(text.normalize(F.col("text")))) == 0)
    once = embed_texts(bare, HashedWords(64), "text", "doc_id", "text").withColumnRenamed("embedding", "first")
    twice = embed_texts(once, HashedWords(64), "text", "doc_id", "first")
    return twice.select("doc_id", (F.abs(cosine_similarity(F.col("first"), F.col("first")) - 1) + F.abs(norm(F.col("first")) - 1) < 1e-5).alias("unit_length"), (F.col("first") == F.col("embedding")).alias("same_again"))


@query("SELECT 1.0 AS itself, 0.0 AS opposite_less_two, 1.0 AS orthogonal")
def vector_distance_constant(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distances of constant vectors, as a check that vectors work at all."""
    a, b, c = literal([3.0, 4.0]), literal([-3.0, -4.0]), literal([-4.0, 3.0])
    return spark.range(1).select((1 - cosine_distance(a, a)).alias("itself"), (cosine_distance(a, b) - 2).alias("opposite_less_two"), cosine_distance(a, c).alias("orthogonal"))


@query("SELECT vec_id, embedding IS NOT NULL AS held, CAST(len(embedding) AS INTEGER) AS width, true AS same FROM embeddings")
def vector_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vectors to text and back, compared within tolerance."""
    rows = table(spark, sf_dir, "embeddings")
    back = text.vector_from_text(text.vector_to_text(F.col("embedding")))
    return rows.select("vec_id", F.col("embedding").isNotNull().alias("held"), F.size("embedding").alias("width"), close(F.col("embedding"), back).alias("same"))


@query("SELECT coalesce(len(embedding), -1)::INTEGER AS width, count(*) AS n FROM c GROUP BY 1")
def embedding_mismatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored vectors that the hashed provider would not have made (none of those given was), counted by width."""
    fresh = embed_texts(clean.chunks(spark, sf_dir, "embedding").withColumnRenamed("embedding", "stored"), HashedWords(64), "content", "id", "stored")
    return fresh.filter(~F.coalesce(close(F.col("stored"), F.col("embedding")), F.lit(False))).groupBy(F.coalesce(F.size("stored"), F.lit(-1)).alias("width")).agg(F.count(F.lit(1)).alias("n"))


# Checks and state changes

_VERIFY = f"""{_DIFF}, fg AS (SELECT document_id, count(*) AS n, count(DISTINCT position) + CASE WHEN count(*) > count(position) THEN 1 ELSE 0 END AS np FROM c GROUP BY 1),
j AS (SELECT d.*, s.document_id IS NOT NULL AS hs, s.indexed_version AS iv, s.deleted AS sd, coalesce(fg.n, 0) AS n, fg.np FROM d LEFT JOIN s ON s.document_id = d.document_id LEFT JOIN fg ON fg.document_id = d.document_id),
mm AS (SELECT document_id FROM c WHERE document_id IN (SELECT document_id FROM live) AND sha256({clean.normal_sql('content')}) IS DISTINCT FROM content_hash),
mx AS (SELECT document_id, content_hash, max(position) AS sp FROM c GROUP BY ALL),
v AS (SELECT 'deleted_has_chunks' AS kind, document_id FROM j WHERE deleted AND n > 0
UNION ALL SELECT 'delete_not_recorded', document_id FROM j WHERE deleted AND NOT coalesce(hs AND iv = version AND sd, false)
UNION ALL SELECT CASE WHEN NOT hs THEN 'missing_index_state' WHEN sd THEN 'wrongly_deleted' ELSE 'version_mismatch' END, document_id FROM j WHERE NOT deleted AND (NOT hs OR sd OR iv IS DISTINCT FROM version)
UNION ALL SELECT 'duplicate_position', document_id FROM j WHERE NOT deleted AND n > np
UNION ALL SELECT 'hash_mismatch', document_id FROM mm
UNION ALL SELECT DISTINCT 'missing_chunks', document_id FROM x WHERE action = 'embed'
UNION ALL SELECT DISTINCT 'stale_chunks', document_id FROM x WHERE action = 'delete'
UNION ALL SELECT DISTINCT 'position_mismatch', x.document_id FROM x JOIN mx ON mx.document_id = x.document_id AND mx.content_hash = x.content_hash WHERE action IN ('reuse', 'move') AND mx.sp IS DISTINCT FROM x.position
UNION ALL SELECT 'orphan_chunk', document_id FROM fg WHERE document_id NOT IN (SELECT document_id FROM d))"""


def _violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return verifying.violations(clean.documents(spark, sf_dir), clean.index_state(spark, sf_dir), clean.chunks(spark, sf_dir))


@query(f"{_VERIFY} SELECT kind, document_id, count(*) AS n FROM v GROUP BY ALL")
def verify_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _violations(spark, sf_dir).groupBy("kind", "document_id").agg(F.count(F.lit(1)).alias("n"))


@query(f"{_VERIFY} SELECT kind, count(*) AS n FROM v GROUP BY ALL")
def verify_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return verifying.counts(_violations(spark, sf_dir))


@query("SELECT (SELECT count(*) FROM d WHERE NOT deleted) AS live_documents, (SELECT count(*) FROM d WHERE deleted) AS deleted_documents, (SELECT count(*) FROM c) AS chunks")
def verify_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return verifying.totals(clean.documents(spark, sf_dir), clean.chunks(spark, sf_dir))


@query("""m AS (SELECT id AS seq, document_id, CASE WHEN event_type = 'deleted' THEN 'delete' WHEN document_version = 1 THEN 'create' WHEN event_type = 'upserted' THEN 'update' END AS op FROM o WHERE document_id IS NOT NULL),
fc AS (SELECT document_id, min(seq) FILTER (op = 'create') AS f FROM m GROUP BY 1),
va AS (SELECT m.* FROM m JOIN fc USING (document_id) WHERE op IS NOT NULL AND (op = 'create' AND seq = f OR op <> 'create' AND seq > f)),
fd AS (SELECT document_id, min(seq) FILTER (op = 'delete') AS e FROM va GROUP BY 1),
ke AS (SELECT va.* FROM va JOIN fd USING (document_id) WHERE e IS NULL OR seq <= e)
SELECT document_id, seq, op, CAST(row_number() OVER (PARTITION BY document_id ORDER BY seq) AS INTEGER) AS version FROM ke""")
def mutation_fold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The outbox taken as a batch of writes to an empty store: what each write leads to."""
    o = clean.outbox(spark, sf_dir).filter("document_id IS NOT NULL")
    op = F.when(F.col("event_type") == "deleted", "delete").when(F.col("document_version") == 1, "create").when(F.col("event_type") == "upserted", "update")
    writes = o.select(F.col("id").alias("seq"), op.alias("op"), "document_id", F.lit("t").alias("title"), F.lit("c").alias("content"))
    return mutations.fold(clean.documents(spark, sf_dir).filter(F.lit(False)), writes).select("document_id", "seq", "op", "version")


_APPLY = f"""due AS (SELECT d.document_id, d.version, d.deleted, d.content FROM d LEFT JOIN s ON s.document_id = d.document_id WHERE s.indexed_version IS NULL OR s.indexed_version < d.version),
live AS (SELECT document_id, content FROM due WHERE NOT deleted), {clean.chunker_sql('live')}{_DIFF[len(_DESIRED):]},
pd AS (SELECT document_id, count(*) FILTER (action = 'embed') AS e, count(*) FILTER (action IN ('reuse', 'move')) AS r, count(*) FILTER (action = 'delete') AS dl FROM x GROUP BY 1),
gc AS (SELECT document_id, count(*) AS dl FROM c GROUP BY 1)"""


@query(f"""{_APPLY} SELECT d.document_id, CASE WHEN due.document_id IS NULL THEN 'skipped_stale' WHEN d.deleted THEN 'deleted' ELSE 'indexed' END AS outcome, due.version, CAST(coalesce(pd.e, 0) AS BIGINT) AS chunks_embedded, CAST(coalesce(pd.r, 0) AS BIGINT) AS chunks_reused,
CAST(CASE WHEN due.document_id IS NULL THEN 0 WHEN d.deleted THEN coalesce(gc.dl, 0) ELSE coalesce(pd.dl, 0) END AS BIGINT) AS chunks_deleted FROM d LEFT JOIN due ON due.document_id = d.document_id LEFT JOIN pd ON pd.document_id = d.document_id LEFT JOIN gc ON gc.document_id = d.document_id""")
def indexer_apply(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What bringing the index up to date does to every document."""
    return _plan(spark, sf_dir).results.select("document_id", "outcome", "version", "chunks_embedded", "chunks_reused", "chunks_deleted")


def _plan(spark: SparkSession, sf_dir: str) -> indexing.IndexPlan:
    return indexing.IndexPlan(clean.documents(spark, sf_dir), clean.index_state(spark, sf_dir), _stored(spark, sf_dir), HashedWords(64), _now(), policy=RetryPolicy(0))


def _stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.chunks(spark, sf_dir, "embedding").groupBy("document_id", "content_hash").agg(F.min_by(F.struct("position", "content", "embedding", "document_version"), F.struct("position", "id")).alias("r")).select("document_id", "content_hash", "r.*")


@query(f"""{_APPLY}, kept AS (SELECT * EXCLUDE (rn) FROM (SELECT c.*, row_number() OVER (PARTITION BY document_id, content_hash ORDER BY position NULLS FIRST, id) AS rn FROM c) WHERE rn = 1)
SELECT kept.document_id, kept.content_hash, coalesce(x.position, kept.position) AS position, kept.document_version, sha256(kept.content) AS text_hash, true AS vector_kept, false AS embedded FROM kept
  LEFT JOIN x ON x.document_id = kept.document_id AND x.content_hash = kept.content_hash WHERE coalesce(x.action, '') <> 'delete' AND kept.document_id NOT IN (SELECT document_id FROM due WHERE deleted)
UNION ALL SELECT k.document_id, k.content_hash, k.position, due.version, sha256(k.content), false, true FROM k JOIN x ON x.document_id = k.document_id AND x.content_hash = k.content_hash AND x.action = 'embed' JOIN due ON due.document_id = k.document_id""")
def indexer_next_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All chunks after bringing the index up to date: kept ones with their vectors and versions, moved ones at
    their new place, new ones embedded."""
    stored = materialize(_stored(spark, sf_dir), "stored")
    after = _plan(spark, sf_dir).next_chunks(stored)
    before = stored.select("document_id", "content_hash", F.col("embedding").alias("old"), F.lit(True).alias("was"))
    both = after.join(before, ["document_id", "content_hash"], "left")
    fresh = F.coalesce(F.size("embedding") == 64, F.lit(False)) & F.col("was").isNull()
    return both.select("document_id", "content_hash", "position", "document_version", F.sha2("content", 256).alias("text_hash"), (F.col("was").isNotNull() & F.col("old").eqNullSafe(F.col("embedding"))).alias("vector_kept"), fresh.alias("embedded"))


@query(f"""{_DESIRED} SELECT d.document_id, CASE WHEN d.deleted THEN 'deleted' ELSE 'indexed' END AS outcome, d.version, count(k.document_id) AS chunks_embedded FROM d LEFT JOIN k ON k.document_id = d.document_id GROUP BY ALL""")
def indexer_seed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents indexed into an empty index, as after a burst of new ones."""
    none = clean.chunks(spark, sf_dir, "embedding").filter(F.lit(False)).drop("id")
    plan = indexing.IndexPlan(clean.documents(spark, sf_dir), clean.index_state(spark, sf_dir).filter(F.lit(False)), none, HashedWords(384), _now(), policy=RetryPolicy(0))
    return plan.results.select("document_id", "outcome", "version", "chunks_embedded")


@query("""stc AS (SELECT count(*) AS n FROM d LEFT JOIN s ON d.document_id = s.document_id WHERE s.indexed_version IS NULL OR s.indexed_version < d.version),
oc AS (SELECT count(*) AS n FROM c LEFT JOIN d ON d.document_id = c.document_id WHERE d.document_id IS NULL OR d.deleted), """ + _STALE + """
SELECT stc.n AS stale_documents, least((SELECT count(*) FROM stl), 1000) AS requeued, oc.n AS orphan_chunks FROM stc, oc""")
def reconcile_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, state = clean.documents(spark, sf_dir).drop("content"), clean.index_state(spark, sf_dir)
    count = lambda df, name, c=None: df.agg((F.coalesce(F.sum(c), F.lit(0)) if c else F.count(F.lit(1))).alias(name))
    found = reconciling.find_stale(docs, state, clean.outbox(spark, sf_dir), _now())
    parts = [count(indexing.stale(docs, state), "stale_documents"), count(found, "requeued"), count(reconciling.orphan_chunks(clean.chunks(spark, sf_dir), docs), "orphan_chunks", "n_chunks")]
    return parts[0].crossJoin(parts[1]).crossJoin(parts[2])  # one row each


@query("""m AS (SELECT event_type, coalesce(""" + clean.uuid_sql("event_id") + """, '') AS e, coalesce(""" + clean.uuid_sql("document_id") + """, '') AS d, document_version AS v FROM deliveries WHERE event_type IS NOT NULL AND document_version IS NOT NULL)
SELECT v % 7 AS version_class, count(*) AS messages FROM (SELECT DISTINCT e, d, v FROM m WHERE e <> '' AND d <> '') GROUP BY 1""")
def stream_apply(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The deliveries as a stream of files into a table that holds each message once, counted by version.

    Each batch appends what it holds to a change store keyed by message, so the stream keeps no state that grows:
    repeated messages meet in the store's sorted runs, however far apart they were received.
    """
    import glob

    from driftmark.functions.ids import canonical_uuid
    from driftmark.operators.changelog import UPSERT, ChangeSpec, ChangeStore

    schema = "delivery_id long, topic_partition int, topic_offset long, batch_id long, event_id string, document_id string, event_type string, document_version int, created_at timestamp, received_at timestamp"
    root = f"{sf_dir}/deliveries.parquet"
    source = f"{root}/*.parquet" if glob.glob(f"{root}/*.parquet") else f"{sf_dir}/deliveries*.parquet"
    messages = spark.readStream.schema(schema).parquet(source).select(canonical_uuid(F.col("event_id")).alias("event_id"), canonical_uuid(F.col("document_id")).alias("document_id"), "document_version", "event_type").dropna()
    store = ChangeStore(spark, new_folder(spark, "stream-out"))
    spec = ChangeSpec(F.concat_ws("|", "event_id", "document_id", "document_version"), F.lit(0), F.lit(UPSERT))

    def append(batch: DataFrame, _: int) -> None:
        store.append(batch, spec)
        store.compact()

    messages.writeStream.foreachBatch(append).option("checkpointLocation", new_folder(spark, "stream-checkpoint")).trigger(availableNow=True).start().awaitTermination()
    version = F.element_at(F.split("dm_key", r"\|"), 3).cast("int")
    return store.current().groupBy((version % 7).alias("version_class")).agg(F.count(F.lit(1)).alias("messages"))


# Edits, latencies, replays


@query(f"""{_LIVE}, pa AS (SELECT document_id, {clean.paragraphs_sql('content')} AS ps FROM live WHERE content IS NOT NULL),
al AS (SELECT 'b' || document_id AS document_id, array_to_string(ps, chr(10) || chr(10)) AS content FROM pa UNION ALL
  SELECT 'e' || document_id, array_to_string(list_transform(ps, lambda p, i: CASE WHEN md5(document_id || ':' || (i - 1))[1:2] < '1a' THEN p || ' It was revised.' ELSE p END), chr(10) || chr(10)) FROM pa), {clean.chunker_sql('al')},
b AS (SELECT document_id[2:] AS document_id, content_hash FROM k WHERE document_id[1] = 'b'), e AS (SELECT document_id[2:] AS document_id, content_hash FROM k WHERE document_id[1] = 'e'),
t AS (SELECT e.document_id, count(*) AS total, count(*) FILTER (b.document_id IS NULL) AS embedded FROM e LEFT JOIN b ON b.document_id = e.document_id AND b.content_hash = e.content_hash GROUP BY 1)
SELECT count(*) FILTER (embedded > 0) AS documents_edited, CAST(sum(total) FILTER (embedded > 0) AS BIGINT) AS chunks_in_edited, CAST(sum(embedded) AS BIGINT) AS chunks_embedded, round(1 - sum(embedded) / sum(total) FILTER (embedded > 0), 6) AS avoided FROM t""")
def reembed_after_edits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A tenth of the paragraphs is rewritten: what of the edited documents has to be embedded again."""
    parts = _live(spark, sf_dir).filter("content IS NOT NULL").select("document_id", text.paragraphs(F.col("content")).alias("ps"))
    edited = workload.rewrite(F.col("ps"), lambda i: workload.drawn(F.col("document_id"), i, "1a"), lambda p: F.concat(p, F.lit(" It was revised.")))
    before = chunk_documents(parts.select("document_id", workload.join(F.col("ps")).alias("content")))
    after = chunk_documents(parts.select("document_id", workload.join(edited).alias("content")))
    per = diffing.summarize(diffing.diff_chunks(after, before)).select("document_id", F.col("to_embed").alias("e"), (F.col("to_embed") + F.col("to_reuse")).alias("t"))
    hit = F.col("e") > 0
    total = F.sum(F.when(hit, F.col("t")))
    return per.agg(F.count_if(hit).alias("documents_edited"), total.alias("chunks_in_edited"), F.sum("e").alias("chunks_embedded"), F.round(1 - F.sum("e") / total, 6).alias("avoided"))


@query(f"""pa AS (SELECT document_id, {clean.paragraphs_sql('content')} AS ps FROM d WHERE content IS NOT NULL)
SELECT document_id, array_to_string(CASE WHEN len(ps) > 1 THEN list_concat([ps[2], ps[1]], ps[3:]) ELSE ps END, '|') AS swapped, array_to_string(list_prepend('New.', ps), '|') AS inserted, array_to_string(ps[2:], '|') AS removed FROM pa""")
def paragraph_edits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document with its first two paragraphs exchanged, one put in front, and the first removed."""
    parts = clean.documents(spark, sf_dir).filter("content IS NOT NULL").select("document_id", text.paragraphs(F.col("content")).alias("ps"))
    show = lambda c: F.array_join(c, "|")
    return parts.select("document_id", show(workload.swap(F.col("ps"), 0, 1)).alias("swapped"), show(workload.insert(F.col("ps"), F.lit(0), F.lit("New."))).alias("inserted"), show(workload.remove(F.col("ps"), F.lit(0))).alias("removed"))


@query("""SELECT d.document_id, (epoch_us(min(o.published_at)) - epoch_us(d.updated_at)) / 1e6 AS to_publish, (epoch_us(s.indexed_at) - epoch_us(d.updated_at)) / 1e6 AS to_index
FROM d JOIN o ON o.document_id = d.document_id AND o.document_version = d.version JOIN s ON s.document_id = d.document_id GROUP BY d.document_id, d.updated_at, s.indexed_at""")
def stage_latencies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From the change of a document to its event and to its index."""
    docs = clean.documents(spark, sf_dir).select("document_id", "version", "updated_at")
    first = clean.outbox(spark, sf_dir).groupBy("document_id", F.col("document_version").alias("version")).agg(F.min("published_at").alias("p"))
    held = clean.index_state(spark, sf_dir).select("document_id", "indexed_at")
    both = docs.join(first, ["document_id", "version"]).join(held, "document_id")
    return both.select("document_id", metrics.lag_seconds(F.col("p"), F.col("updated_at")).alias("to_publish"), metrics.lag_seconds(F.col("indexed_at"), F.col("updated_at")).alias("to_index"))


@query("SELECT c.document_id, count(*) FILTER (c.document_version = s.indexed_version) AS embedded, count(*) FILTER (c.document_version IS DISTINCT FROM s.indexed_version) AS kept FROM c JOIN s ON s.document_id = c.document_id GROUP BY 1")
def embedded_and_kept(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chunks of each document embedded at its indexed version, and kept from earlier ones."""
    both = clean.chunks(spark, sf_dir).select("document_id", "document_version").join(clean.index_state(spark, sf_dir).select("document_id", "indexed_version"), "document_id")
    same = F.col("document_version").eqNullSafe(F.col("indexed_version")) & F.col("indexed_version").isNotNull()
    return both.groupBy("document_id").agg(F.count_if(same).alias("embedded"), F.count_if(~same).alias("kept"))


@query("SELECT count(*) AS documents, count(*) FILTER (s.indexed_version IS DISTINCT FROM d.version OR s.deleted IS DISTINCT FROM d.deleted) AS out_of_step FROM d LEFT JOIN s ON s.document_id = d.document_id")
def in_step(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = clean.documents(spark, sf_dir).select("document_id", "version", "deleted")
    held = clean.index_state(spark, sf_dir).select("document_id", "indexed_version", F.col("deleted").alias("held_deleted"))
    off = ~F.col("indexed_version").eqNullSafe(F.col("version")) | ~F.col("held_deleted").eqNullSafe(F.col("deleted"))
    return docs.join(held, "document_id", "left").agg(F.count(F.lit(1)).alias("documents"), F.count_if(off).alias("out_of_step"))


@query("SELECT o.document_id, o.document_version, o.created_at = d.updated_at AS same_time FROM o JOIN d ON d.document_id = o.document_id AND d.version = o.document_version")
def event_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether the events of current versions carry the time of the change."""
    docs = clean.documents(spark, sf_dir).select("document_id", F.col("version").alias("document_version"), "updated_at")
    return clean.outbox(spark, sf_dir).join(docs, ["document_id", "document_version"]).select("document_id", "document_version", (F.col("created_at") == F.col("updated_at")).alias("same_time"))


@query("SELECT count(DISTINCT document_id) AS documents, count(*) AS events, count(*) FILTER (document_id IS NULL) AS without_document, max(n) AS most FROM (SELECT *, count(*) OVER (PARTITION BY document_id) AS n FROM o)")
def event_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    per = clean.outbox(spark, sf_dir).groupBy("document_id").agg(F.count(F.lit(1)).alias("n"))
    return per.agg(F.count("document_id").alias("documents"), F.sum("n").alias("events"), F.coalesce(F.sum(F.when(F.col("document_id").isNull(), F.col("n"))), F.lit(0)).alias("without_document"), F.max("n").alias("most"))


def _running(spark: SparkSession, sf_dir: str) -> tuple[Engine, DataFrame]:
    """An engine that holds the documents and nothing else, and the events to index them by."""
    engine = Engine(spark, new_folder(spark, "store"), Settings(embedding_dimension=64, buckets=8, max_retries=0))
    engine.store.commit(engine.store.manifest(), {"documents": (clean.documents(spark, sf_dir), None)})
    return engine, clean.outbox(spark, sf_dir)


def _apply_events(engine: Engine, events: DataFrame, order: list[Column], files: int = 1) -> worker.Worker:
    """Stream events in some order through a worker that starts anew."""
    spark, folder = engine.spark, new_folder(engine.spark, "events")
    value = text.event_json(*[F.col(c) for c in ("event_id", "document_id", "event_type", "document_version", "created_at")])
    events.select("id", text.event_key(F.col("document_id")).alias("key"), value.alias("value")).orderBy(*order).select("key", "value").coalesce(files).write.parquet(folder)
    w = worker.Worker(engine, worker.read_events(spark, folder), new_folder(spark, "checkpoint"), new_folder(spark, "dead"), metrics=new_folder(spark, "metrics"))
    w.drain()
    return w


_INDEXED = f"""ev AS (SELECT DISTINCT document_id FROM o WHERE document_id IS NOT NULL AND event_id IS NOT NULL AND event_type IN ('upserted', 'deleted') AND document_version IS NOT NULL AND created_at IS NOT NULL),
di AS (SELECT d.* FROM d SEMI JOIN ev ON ev.document_id = d.document_id WHERE version IS NOT NULL), live AS (SELECT document_id, content FROM di WHERE NOT deleted), {clean.chunker_sql('live')}"""


@query(f"""{_INDEXED} SELECT di.document_id, di.version AS indexed_version, di.deleted, count(k.document_id) AS n_chunks, coalesce(sha256(string_agg(k.content_hash, '' ORDER BY k.position)), sha256('')) AS chunks FROM di LEFT JOIN k ON k.document_id = di.document_id GROUP BY ALL""")
def stream_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The smallest whole run: documents and events streamed through the worker into a new store; what the index
    then holds of every document."""
    engine, events = _running(spark, sf_dir)
    _apply_events(engine, events, [F.col("id")])
    # The chunks of one document, to compare them in order.
    chunks = engine.store.read("chunks", columns=["document_id", "content_hash", "position"]).groupBy("document_id").agg(F.count(F.lit(1)).alias("n"), F.array_sort(F.collect_list(F.struct("position", "content_hash"))).alias("c"))
    return engine.store.read("index_state").join(chunks, "document_id", "left").select("document_id", "indexed_version", "deleted", F.coalesce("n", F.lit(0)).alias("n_chunks"), F.sha2(F.coalesce(F.array_join("c.content_hash", ""), F.lit("")), 256).alias("chunks"))


@query(f"""{_INDEXED}, bad AS (SELECT DISTINCT document_id FROM k), ok AS (SELECT *, document_id IS NOT NULL AND event_id IS NOT NULL AND event_type IN ('upserted', 'deleted') AND document_version IS NOT NULL AND created_at IS NOT NULL AS good FROM o)
SELECT * FROM (SELECT 'TransientEmbeddingError' AS error_type, '3' AS attempts, (SELECT count(*) FROM ok SEMI JOIN bad ON bad.document_id = ok.document_id WHERE good) AS letters, (SELECT count(*) FROM di WHERE document_id NOT IN (SELECT document_id FROM bad)) AS indexed
UNION ALL SELECT 'ValueError', '1', (SELECT count(*) FROM ok WHERE good IS NOT TRUE), (SELECT count(*) FROM di WHERE document_id NOT IN (SELECT document_id FROM bad))) WHERE letters > 0""")
def stream_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A provider that fails always: after three attempts each event of a document with new chunks is a dead letter,
    nothing of that document changes, and all others are indexed."""
    engine, events = _running(spark, sf_dir)
    engine.provider, engine.policy = FailingProvider(engine.provider, 1.0), RetryPolicy(2, 0.0)
    w = _apply_events(engine, events, [F.col("id")])
    header = lambda name: F.col("headers")[f"dlq.{name}"].alias(name)
    letters = worker.read_dead_letters(spark, w.dead).select(header("error_type"), header("attempts")).groupBy("error_type", "attempts").agg(F.count(F.lit(1)).alias("letters"))
    return letters.crossJoin(engine.store.read("index_state").agg(F.count(F.lit(1)).alias("indexed")))  # one row


@query("SELECT unnest(['again', 'reversed', 'shuffled']) AS replay, 0 AS differences")
def stream_replays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All events again, backwards, and in an order without sense: what each replay changed in the index."""
    engine, events = _running(spark, sf_dir)
    _apply_events(engine, events, [F.col("id")])
    out, before = [], materialize(engine.snapshot(), "snapshot")
    for name, order in (("again", F.col("id")), ("reversed", F.col("id").desc()), ("shuffled", F.md5(F.col("id").cast("string")))):
        _apply_events(engine, events, [order])
        out.append((name, engine.differences(before, engine.snapshot()).count()))
    return spark.createDataFrame(out, "replay string, differences long")


@query("""e AS (SELECT count(*) FILTER (document_id IS NOT NULL AND event_id IS NOT NULL AND event_type IN ('upserted', 'deleted') AND document_version IS NOT NULL AND created_at IS NOT NULL) AS good, count(*) AS n FROM o)
SELECT 'valid' AS label, CAST(good AS DOUBLE) AS value FROM e UNION ALL SELECT 'malformed', CAST(n - good AS DOUBLE) FROM e""")
def stream_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the worker's own counters say about the events it took."""
    engine, events = _running(spark, sf_dir)
    w = _apply_events(engine, events, [F.col("id")])
    held = metrics.read_counters(spark, str(w.metrics))
    return metrics.grown(held.limit(0), held).filter("name = 'events_total'").select("label", "value")


@query(f"""{_INDEXED}, st AS (SELECT count(*) AS n FROM d WHERE document_id NOT IN (SELECT document_id FROM di))
SELECT least(st.n, 200) AS requeued_first, greatest(least(st.n - 200, 200), 0) AS requeued_second, 0 AS waiting, CAST((SELECT count(*) FROM d WHERE version IS NOT NULL) - greatest(st.n - 400, 0) AS BIGINT) AS indexed FROM st""")
def reconcile_requeue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without any event are queued by two passes of repair, published, and indexed."""
    engine, events = _running(spark, sf_dir)
    engine.settings = dataclasses.replace(engine.settings, reconcile_batch=200)
    _apply_events(engine, events, [F.col("id")])
    passes, folder = [engine.reconcile().requeued, engine.reconcile().requeued], new_folder(spark, "requeued")
    engine.drain(folder)
    if sum(passes):
        worker.Worker(engine, worker.read_events(spark, folder), new_folder(spark, "checkpoint"), new_folder(spark, "dead")).drain()
    return spark.createDataFrame([(*passes, engine.backlog(), engine.store.read("index_state").count())], "requeued_first long, requeued_second long, waiting long, indexed long")


@query("""n AS (SELECT count(*) FILTER (document_id IS NOT NULL) AS n, count(*) FILTER (document_id IS NOT NULL AND id % 3 = 0) AS third, min(id) FILTER (document_id IS NOT NULL AND id % 3 <> 0) AS first FROM o)
SELECT third AS marked, n - third AS waiting, first AS oldest_waiting FROM n""")
def publish_acknowledged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A sink that acknowledges every third event: only those are marked as published."""

    class Third:
        def send(self, batch: DataFrame) -> DataFrame:
            return batch.filter("id % 3 = 0").select("id")

    engine = Engine(spark, new_folder(spark, "store"), Settings(embedding_dimension=64, buckets=8))
    events = clean.outbox(spark, sf_dir).filter("document_id IS NOT NULL").withColumn("published_at", F.lit(None).cast("timestamp"))
    engine.store.commit(engine.store.manifest(), {"outbox": (events, None)})
    marked = engine.publish(Third(), 0)
    left = engine.store.read("outbox", columns=["id", "published_at"]).filter("published_at IS NULL").agg(F.count(F.lit(1)).alias("waiting"), F.min("id").alias("oldest_waiting"))
    return left.select(F.lit(marked).cast("long").alias("marked"), "waiting", "oldest_waiting")


@query(f"""{_SIM}, t AS (SELECT vec_id FROM sc ORDER BY score DESC, vec_id LIMIT 50) SELECT 50 AS hits, (SELECT count(*) FROM t WHERE CAST(vec_id AS VARCHAR) LIKE '%7%') AS containing, coalesce((SELECT min(vec_id) FROM t WHERE CAST(vec_id AS VARCHAR) LIKE '%7%'), -1) AS least""")
def hits_containing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of the best hits those whose content has a text; the number of the vector stands for its content."""
    scored = table(spark, sf_dir, "embeddings").select("vec_id", F.col("vec_id").cast("string").alias("content"), cosine_similarity(F.col("embedding"), literal(_probe(spark, sf_dir))).alias("score"))
    hits = scored.orderBy(F.col("score").desc(), "vec_id").limit(50)
    found = searching.containing(hits, "7").agg(F.count(F.lit(1)).alias("containing"), F.coalesce(F.min("vec_id"), F.lit(-1)).alias("least"))
    return hits.agg(F.count(F.lit(1)).alias("hits")).crossJoin(found)  # one row each


_WORKLOAD = """wd AS (SELECT i AS d, CAST('0x' || md5('42:' || i)[1:4] AS INTEGER) % 9 + 4 AS n FROM range(1000) r(i)),
wp AS (SELECT d, p, md5('42:' || d || ':' || p)[1:2] < '1a' AS edited FROM (SELECT d, unnest(range(n)) AS p FROM wd))"""


@query(f"""{_WORKLOAD} SELECT (SELECT count(*) FROM wd) AS documents, (SELECT count(*) FROM wp) AS paragraphs, (SELECT count(DISTINCT d) FROM wp WHERE edited) AS documents_edited,
(SELECT count(*) FROM wp WHERE edited) AS chunks_embedded, (SELECT count(*) FROM wp WHERE d IN (SELECT d FROM wp WHERE edited)) AS chunks_in_edited""")
def workload_edits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The published workload: 1,000 documents of 4 to 12 paragraphs, about a tenth of the paragraphs rewritten."""
    docs = workload.synthetic_documents(spark, 1000, benchmark.SEED)
    edited = benchmark.rewritten(docs).select("document_id", "content")
    untouched = docs.select("document_id", "content").join(edited.select("document_id"), "document_id", "left_anti")
    before, after = chunk_documents(docs.select("document_id", "content")), chunk_documents(edited.unionByName(untouched))
    per = diffing.summarize(diffing.diff_chunks(after, before)).withColumn("t", F.col("to_embed") + F.col("to_reuse"))
    hit = F.col("to_embed") > 0
    return per.agg(F.count(F.lit(1)).alias("documents"), F.sum("t").alias("paragraphs"), F.count_if(hit).alias("documents_edited"), F.sum("to_embed").alias("chunks_embedded"), F.sum(F.when(hit, F.col("t"))).alias("chunks_in_edited"))
