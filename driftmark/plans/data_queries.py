"""Queries of the general data problems: change feed, incremental runs, repeated messages, orphan references."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from driftmark.functions.ids import canonical_uuid
from driftmark.operators import changelog, dedupe, incremental, orphans
from driftmark.session import new_folder
from driftmark.sources.tables import table

Query = Callable[[SparkSession, str], DataFrame]
#: Runs that a backlog of deliveries is appended as.
RUNS = 6
MESSAGE = ["event_id", "document_id", "document_version"]


def _changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "deliveries").filter("document_version >= 1")


def _append(store: changelog.ChangeStore, changes: DataFrame) -> changelog.ChangeStore:
    spec = changelog.ChangeSpec(canonical_uuid(F.col("document_id")), F.col("document_version"), F.col("event_type"))
    store.append(changes, spec, F.pmod(F.coalesce("batch_id", F.lit(0)), F.lit(RUNS)), RUNS)
    return store


def _store(spark: SparkSession, sf_dir: str) -> changelog.ChangeStore:
    return _append(changelog.ChangeStore(spark, new_folder(spark, "changes")), _changes(spark, sf_dir))


def _live(store: changelog.ChangeStore) -> DataFrame:
    return store.current().select(F.col("dm_key").alias("document_id"), F.col("dm_seq").cast("int").alias("document_version"))


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The live documents after all deliveries, each with its version."""
    return _live(_store(spark, sf_dir))


def p1_compacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same after compaction of all runs into one and a second arrival of every upsert, which revives nothing."""
    store = _store(spark, sf_dir)
    store.compact(force=True)
    return _live(_append(store, _changes(spark, sf_dir).filter(F.col("event_type") == changelog.UPSERT)))


def p1_late_after_compaction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same where all deletes come first and are compacted before any upsert arrives, in compacted runs, too."""
    store, changes = changelog.ChangeStore(spark, new_folder(spark, "changes"), fan_in=3), _changes(spark, sf_dir)
    _append(store, changes.filter(F.col("event_type") == changelog.DELETE))
    store.compact(force=True)
    _append(store, changes.filter(F.col("event_type") == changelog.UPSERT))
    store.compact()
    return _live(store)


def p1_changes_by_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many documents end live and deleted, with the sum of their versions."""
    merged = _store(spark, sf_dir).merged()
    return merged.groupBy(F.col("dm_dead").alias("deleted")).agg(F.count(F.lit(1)).alias("documents"), F.sum("dm_seq").alias("versions"))


def _log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return incremental.latest(table(spark, sf_dir, "source_documents"), canonical_uuid(F.col("id")), F.col("version"))


def _indexed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return incremental.latest(table(spark, sf_dir, "index_state"), canonical_uuid(F.col("document_id")), F.col("indexed_version"))


def _captured(spark: SparkSession, sf_dir: str, root: str) -> incremental.ChangeLog:
    log = incremental.ChangeLog(spark, f"{root}/log")
    log.capture(_log(spark, sf_dir))
    return log


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the next run has to index, read back from the plan that it writes ahead.

    The versions of documents are captured as a log, the positions up to which the index holds everything are
    committed, and the run takes what lies beyond them less what the index holds by key and version.
    """
    root, held = new_folder(spark, "incremental"), _indexed(spark, sf_dir)
    log, job = _captured(spark, sf_dir, root), incremental.IncrementalJob(spark, f"{root}/job")
    job.adopt(log.records(), held)
    run = job.plan(log.records(), held)
    return job.planned(run).select(F.col("key").alias("document_id"), F.col("offset").cast("int").alias("version"))


def p2_after_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run that fails after half its writes, and again between its last write and its commit, is replayed; per
    offset, how many records the sink then holds. Each record leads to two rows, which stay together."""
    root = new_folder(spark, "incremental")
    job, sink = incremental.IncrementalJob(spark, f"{root}/job"), incremental.Sink(spark, f"{root}/sink", "key string, offset long, copy int")
    two = lambda rows: rows.select("key", "offset", F.explode(F.array(F.lit(1), F.lit(2))).alias("copy"))
    log = _captured(spark, sf_dir, root).records()
    run = job.plan(log, sink.held())
    sink.write(two(job.planned(run).filter("offset < 5")), run)  # the lost driver's part of the work
    job.attempt(log, sink, two)  # the next driver wrote the rest and was lost before its commit
    job.run(log, sink, two)
    job.run(log, sink, two)
    return sink.rows().groupBy(F.col("offset").alias("version")).agg(F.count_if(F.col("copy") == 1).alias("documents"), F.count(F.lit(1)).alias("n_rows"))


def p2_next_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents of even versions are captured and processed; the plan after all others were captured, made by a
    second driver because the first was lost while it planned, is what changed since."""
    root, rows = new_folder(spark, "incremental"), table(spark, sf_dir, "source_documents")
    log, job = incremental.ChangeLog(spark, f"{root}/log"), incremental.IncrementalJob(spark, f"{root}/job")
    sink = incremental.Sink(spark, f"{root}/sink", "key string, offset long")
    log.capture(incremental.latest(rows.filter("version % 2 = 0"), canonical_uuid(F.col("id")), F.col("version")))
    job.run(log.records(), sink, lambda r: r)
    log.capture(_log(spark, sf_dir))
    sink.held().write.parquet(f"{root}/job/plan-{2:09d}")  # a plan without its mark, which the lost driver left
    run = job.plan(log.records(), sink.held())
    return job.planned(run).select(F.col("key").alias("document_id"), F.col("offset").cast("int").alias("version"))


def p2_backlog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents to index by whether they were never indexed, with the versions they are behind."""
    held = _indexed(spark, sf_dir).select("key", F.col("offset").alias("held"))
    behind = incremental.pending(_log(spark, sf_dir), _indexed(spark, sf_dir)).join(held, "key", "left")
    return behind.groupBy(F.col("held").isNull().alias("never_indexed")).agg(F.count(F.lit(1)).alias("documents"), F.sum(F.col("offset") - F.coalesce("held", F.lit(0))).alias("versions_behind"))


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deliveries that are copies of an earlier delivery of the same message; they are numbered as they arrive."""
    rows = table(spark, sf_dir, "deliveries").select("delivery_id", *MESSAGE)
    return dedupe.redundant_copies(rows, MESSAGE, ["delivery_id"]).select("delivery_id")


def p3_by_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many copies there are per version where only the day of delivery is known, so that most copies tie."""
    rows = table(spark, sf_dir, "deliveries").select("delivery_id", F.to_date("received_at").alias("day"), *MESSAGE)
    return dedupe.redundant_copies(rows, MESSAGE, ["day"]).groupBy("document_version").agg(F.count(F.lit(1)).alias("copies"))


def p3_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The deliveries with one copy of each message, whole rows; counted per partition of the topic."""
    once = dedupe.deduplicate(table(spark, sf_dir, "deliveries"), MESSAGE, ["delivery_id"])
    return once.groupBy("topic_partition").agg(F.count(F.lit(1)).alias("messages"), F.sum("delivery_id").alias("id_sum"), F.max("topic_offset").alias("last_offset"))


def _references(spark: SparkSession, sf_dir: str) -> list[orphans.Reference]:
    own = F.col("deleted")
    return [
        orphans.Reference("chunks", table(spark, sf_dir, "chunks"), "document_id", "loaded_at", F.lit(True)),
        orphans.Reference("index_state", table(spark, sf_dir, "index_state"), "document_id", "loaded_at", ~own),
        orphans.Reference("outbox", table(spark, sf_dir, "outbox"), "document_id", "loaded_at"),
    ]


def _parents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return orphans.parents(table(spark, sf_dir, "source_documents"), "id", "version", "deleted", "first_loaded_at")


def _cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    return orphans.cascade_references(_references(spark, sf_dir), _parents(spark, sf_dir), [("chunks", "index_state")])


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orphan references by table, month, document and reason: those of depth 0 of the cascade."""
    return _cascade(spark, sf_dir).filter("depth = 0").select("table_name", "period", F.col("key").alias("document_id"), "reason")


def p5_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orphaned documents per table, month and reason: direct ones (depth 0), and inherited ones, of which rows
    without a reason of their own hang below orphans only."""
    return _cascade(spark, sf_dir).groupBy("table_name", "period", "reason", "depth").agg(F.count_distinct("key").alias("documents"))


def p5_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Direct and inherited orphans along documents <- index_state <- chunks, and documents <- outbox."""
    live = table(spark, sf_dir, "source_documents").select("id")
    tables = {"source_documents": live} | {t: table(spark, sf_dir, t) for t in ("index_state", "chunks", "outbox")}
    edges = [
        orphans.Edge("index_state", "document_id", "source_documents", "id"),
        orphans.Edge("chunks", "document_id", "index_state", "document_id"),
        orphans.Edge("outbox", "document_id", "source_documents", "id"),
    ]
    found = orphans.cascade(spark, tables, edges)
    return found.select("table_name", F.col("key").alias("document_id"), "reason", "depth", "n_rows")


QUERIES: dict[str, Query] = {f.__name__: f for f in (p1_found, p1_compacted, p1_late_after_compaction, p1_changes_by_state, p2_found, p2_after_replay, p2_next_run, p2_backlog, p3_found, p3_messages, p3_by_day, p5_found, p5_report, p5_cascade)}


def _uuid_sql(c: str) -> str:
    """The canonical spelling in DuckDB's SQL."""
    pad = r"[\x09-\x0d\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200f}\x{2028}\x{2029}\x{202f}\x{205f}\x{2060}\x{3000}\x{feff}]"
    bare = f"regexp_replace(regexp_replace(lower({c}), '^{pad}+|{pad}+$', '', 'g'), '^urn:uuid:|^urn:|^uuid:|[{{}}\\-]', '', 'g')"
    hexes = "([0-9a-f]{8})([0-9a-f]{4})([0-9a-f]{4})([0-9a-f]{4})([0-9a-f]{12})"
    return f"(CASE WHEN regexp_full_match({bare}, '{hexes}') THEN regexp_replace({bare}, '^{hexes}$', '\\1-\\2-\\3-\\4-\\5') END)"


def _identity_sql(c: str) -> str:
    return f"coalesce({_uuid_sql(c)}, trim({c}))"


_VALID = f"""v AS (SELECT {_uuid_sql("document_id")} AS d, document_version AS n, event_type AS e FROM deliveries
  WHERE event_type IN ('upserted', 'deleted') AND document_version >= 1),
last AS (SELECT d, max(n) AS n, bool_or(e = 'deleted') AS dead FROM v JOIN (SELECT d AS d2, max(n) AS n2 FROM v GROUP BY d) ON d = d2 AND n = n2 WHERE d IS NOT NULL GROUP BY d)"""
_DUE = f"""cur AS (SELECT {_uuid_sql("id")} AS d, max(version) AS n FROM source_documents GROUP BY 1),
held AS (SELECT {_uuid_sql("document_id")} AS d, max(indexed_version) AS n FROM index_state GROUP BY 1)"""
_MESSAGES = f"m AS (SELECT *, {_identity_sql('event_id')} AS ke, {_identity_sql('document_id')} AS kd FROM deliveries)"
_ORPHANS = f"""p AS (SELECT {_identity_sql("id")} AS d, arg_max(deleted, version) AS dead, min(first_loaded_at) AS t FROM source_documents GROUP BY 1),
r AS (SELECT 'chunks' AS table_name, {_identity_sql("document_id")} AS d, loaded_at, true AS matters FROM chunks
  UNION ALL SELECT 'index_state', {_identity_sql("document_id")}, loaded_at, NOT deleted FROM index_state
  UNION ALL SELECT 'outbox', {_identity_sql("document_id")}, loaded_at, false FROM outbox),
o AS (SELECT table_name, strftime(loaded_at AT TIME ZONE 'UTC', '%Y-%m') AS period, r.d AS document_id,
  CASE WHEN p.d IS NULL THEN 'missing' WHEN p.dead AND r.matters THEN 'deleted' WHEN r.loaded_at < p.t THEN 'late' END AS reason
  FROM r LEFT JOIN p ON r.d = p.d WHERE r.d IS NOT NULL),
f AS (SELECT DISTINCT * FROM o WHERE reason IS NOT NULL)"""
_CASCADE = f"""d AS (SELECT DISTINCT {_identity_sql("id")} AS k FROM source_documents),
i AS (SELECT {_identity_sql("document_id")} AS k, count(*) AS n FROM index_state GROUP BY 1),
c AS (SELECT {_identity_sql("document_id")} AS k, count(*) AS n FROM chunks GROUP BY 1),
o AS (SELECT {_identity_sql("document_id")} AS k, count(*) AS n FROM outbox GROUP BY 1)"""

ORACLES: dict[str, str] = {
    "p1_found": f"WITH {_VALID} SELECT d AS document_id, n AS document_version FROM last WHERE NOT dead",
    "p1_compacted": f"WITH {_VALID} SELECT d AS document_id, n AS document_version FROM last WHERE NOT dead",
    "p1_late_after_compaction": f"WITH {_VALID} SELECT d AS document_id, n AS document_version FROM last WHERE NOT dead",
    "p1_changes_by_state": f"WITH {_VALID} SELECT dead AS deleted, count(*) AS documents, CAST(sum(n) AS BIGINT) AS versions FROM last GROUP BY 1",
    "p2_found": f"WITH {_DUE} SELECT cur.d AS document_id, cur.n AS version FROM cur WHERE cur.n IS NOT NULL AND cur.d IS NOT NULL AND NOT EXISTS (SELECT 1 FROM held WHERE held.d = cur.d AND held.n >= cur.n)",
    "p2_after_replay": f"WITH {_DUE} SELECT CAST(n AS BIGINT) AS version, count(*) AS documents, 2 * count(*) AS n_rows FROM cur WHERE d IS NOT NULL AND n IS NOT NULL GROUP BY 1",
    "p2_next_run": f"""WITH {_DUE}, even AS (SELECT {_uuid_sql("id")} AS d, max(version) AS n FROM source_documents WHERE version % 2 = 0 GROUP BY 1)
SELECT cur.d AS document_id, cur.n AS version FROM cur LEFT JOIN even ON even.d = cur.d WHERE cur.d IS NOT NULL AND cur.n IS NOT NULL AND (even.n IS NULL OR even.n < cur.n)""",
    "p2_backlog": f"""WITH {_DUE} SELECT held.n IS NULL AS never_indexed, count(*) AS documents, CAST(sum(cur.n - coalesce(held.n, 0)) AS BIGINT) AS versions_behind
FROM cur LEFT JOIN held ON cur.d = held.d WHERE cur.d IS NOT NULL AND cur.n IS NOT NULL AND (held.n IS NULL OR held.n < cur.n) GROUP BY 1""",
    "p3_found": f"WITH {_MESSAGES} SELECT delivery_id FROM (SELECT delivery_id, row_number() OVER (PARTITION BY ke, kd, document_version ORDER BY delivery_id) AS n FROM m WHERE ke IS NOT NULL AND kd IS NOT NULL AND document_version IS NOT NULL) WHERE n > 1",
    "p3_by_day": f"WITH {_MESSAGES} SELECT document_version, CAST(sum(n) - count(*) AS BIGINT) AS copies FROM (SELECT document_version, count(*) AS n FROM m WHERE ke IS NOT NULL AND kd IS NOT NULL AND document_version IS NOT NULL GROUP BY document_version, ke, kd) GROUP BY 1 HAVING sum(n) > count(*)",
    "p3_messages": f"""WITH {_MESSAGES}, k AS (SELECT *, row_number() OVER (PARTITION BY ke, kd, document_version ORDER BY delivery_id) AS n FROM m)
SELECT topic_partition, count(*) AS messages, CAST(sum(delivery_id) AS BIGINT) AS id_sum, max(topic_offset) AS last_offset FROM k
WHERE n = 1 OR ke IS NULL OR kd IS NULL OR document_version IS NULL GROUP BY 1""",
    "p5_found": f"WITH {_ORPHANS} SELECT table_name, period, document_id, reason FROM f",
    "p5_report": f"""WITH {_ORPHANS} SELECT table_name, period, reason, 0 AS depth, count(*) AS documents FROM f GROUP BY ALL
UNION ALL SELECT table_name, period, 'inherited', 1, count(DISTINCT document_id) FROM o
WHERE table_name = 'chunks' AND reason IS NULL AND document_id IN (SELECT document_id FROM o WHERE table_name = 'index_state' GROUP BY 1 HAVING bool_and(reason IS NOT NULL)) GROUP BY ALL""",
    "p5_cascade": f"""WITH {_CASCADE}
SELECT 'index_state' AS table_name, k AS document_id, 'missing' AS reason, 0 AS depth, n AS n_rows FROM i WHERE k IS NOT NULL AND k NOT IN (SELECT k FROM d WHERE k IS NOT NULL)
UNION ALL SELECT 'outbox', k, 'missing', 0, n FROM o WHERE k IS NOT NULL AND k NOT IN (SELECT k FROM d WHERE k IS NOT NULL)
UNION ALL SELECT 'chunks', k, CASE WHEN k IN (SELECT k FROM i WHERE k IS NOT NULL) THEN 'inherited' ELSE 'missing' END, CASE WHEN k IN (SELECT k FROM i WHERE k IS NOT NULL) THEN 1 ELSE 0 END, n
FROM c WHERE k IS NOT NULL AND (k NOT IN (SELECT k FROM i WHERE k IS NOT NULL) OR k IN (SELECT k FROM i WHERE k IS NOT NULL AND k NOT IN (SELECT k FROM d WHERE k IS NOT NULL)))""",
}
