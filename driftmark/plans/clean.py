"""The tables in the form the engine keeps them, from the dirty exports: canonical ids, one row per key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from driftmark.functions.ids import canonical_uuid
from driftmark.sources.tables import table


def _latest(rows: DataFrame, key: str, columns: list[str], rank: list[Column]) -> DataFrame:
    """One row per key, the greatest by ``rank`` (nulls least), in one aggregation with map-side partials."""
    rows = rows.filter(F.col(key).isNotNull())
    return rows.groupBy(key).agg(F.max_by(F.struct(*columns), F.struct(*rank)).alias("r")).select(key, "r.*")


def documents(spark: SparkSession, sf_dir: str, only: str | None = None) -> DataFrame:
    """All documents, or the one with an id; other rows are then left out as they are read."""
    rows = table(spark, sf_dir, "source_documents").withColumn("document_id", canonical_uuid(F.col("id")))
    rows = rows if only is None else rows.filter(F.col("document_id") == only)
    return _latest(rows, "document_id", ["title", "content", "version", "deleted", "updated_at"], [F.col("version"), F.col("updated_at")])


def outbox(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "outbox").withColumns({"document_id": canonical_uuid(F.col("document_id")), "event_id": canonical_uuid(F.col("event_id"))})
    return _latest(rows, "id", ["event_id", "document_id", "event_type", "document_version", "created_at", "published_at"], [F.col("published_at"), F.col("created_at")])


def index_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "index_state").withColumn("document_id", canonical_uuid(F.col("document_id")))
    return _latest(rows, "document_id", ["indexed_version", "indexed_at", "deleted"], [F.col("indexed_version"), F.col("indexed_at"), F.col("deleted")])


def chunks(spark: SparkSession, sf_dir: str, *more: str) -> DataFrame:
    """Without vectors unless asked for, so that they are not read."""
    rows = table(spark, sf_dir, "chunks").withColumn("document_id", canonical_uuid(F.col("document_id")))
    return _latest(rows, "id", ["document_id", "content_hash", "position", "content", "document_version", *more], [F.col("loaded_at"), F.col("document_version")]).filter("document_id IS NOT NULL")



def uuid_sql(c: str) -> str:
    """The canonical spelling of a UUID in DuckDB's SQL."""
    from driftmark.plans.data_queries import _uuid_sql

    return _uuid_sql(c)


def sql_prefix() -> str:
    """The same in DuckDB's SQL, as common table expressions d, o, s and c."""
    from driftmark.plans.data_queries import _uuid_sql

    def ranked(name: str, source: str, key: str, columns: str, order: str) -> str:
        return f"{name} AS (SELECT * EXCLUDE (rn) FROM (SELECT {columns}, row_number() OVER (PARTITION BY {key} ORDER BY {order}) AS rn FROM {source}) WHERE rn = 1)"

    return ",\n".join([
        f"d0 AS (SELECT {_uuid_sql('id')} AS document_id, title, content, version, deleted, updated_at FROM source_documents)",
        ranked("d", "(SELECT * FROM d0 WHERE document_id IS NOT NULL)", "document_id", "*", "version DESC NULLS LAST, updated_at DESC NULLS LAST"),
        f"o0 AS (SELECT id, {_uuid_sql('event_id')} AS event_id, {_uuid_sql('document_id')} AS document_id, event_type, document_version, created_at, published_at FROM outbox)",
        ranked("o", "o0", "id", "*", "published_at DESC NULLS LAST, created_at DESC NULLS LAST"),
        f"s0 AS (SELECT {_uuid_sql('document_id')} AS document_id, indexed_version, indexed_at, deleted FROM index_state)",
        ranked("s", "(SELECT * FROM s0 WHERE document_id IS NOT NULL)", "document_id", "*", "indexed_version DESC NULLS LAST, indexed_at DESC NULLS LAST, deleted DESC NULLS LAST"),
        f"c0 AS (SELECT id, {_uuid_sql('document_id')} AS document_id, content_hash, position, content, document_version, embedding, loaded_at FROM chunks)",
        ranked("c1", "c0", "id", "*", "loaded_at DESC NULLS LAST, document_version DESC NULLS LAST"),
        "c AS (SELECT * FROM c1 WHERE document_id IS NOT NULL)",
    ])


_WS = r"[\x09-\x0d\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"


def normal_sql(c: str) -> str:
    return f"trim(regexp_replace(nfc_normalize({c}), '{_WS}+', ' ', 'g'))"


def paragraphs_sql(c: str) -> str:
    parts = f"string_split_regex(replace({c}, chr(13) || chr(10), chr(10)), '\\n{_WS}*\\n')"
    return f"list_filter(list_transform({parts}, lambda x: regexp_replace(x, '^{_WS}+|{_WS}+$', '', 'g')), lambda x: x <> '')"


def chunker_sql(source: str) -> str:
    """The chunks of (document_id, content) rows of ``source`` as common table expressions ending in ``k``
    (document_id, position, content, content_hash). Folds need a value before the first element."""
    text = "VARCHAR"
    grown = "CASE WHEN a.n > 0 THEN a.held || chr(10) || chr(10) || x.held ELSE x.held END"
    merge = f"""list_reduce(list_prepend({{'out': []::{text}[], 'held': '', 'n': 0::BIGINT}}, list_transform(ps, lambda p: {{'out': []::{text}[], 'held': p, 'n': length(p)::BIGINT}})),
  lambda a, x: CASE WHEN x.n >= 80 THEN {{'out': list_concat(a.out, CASE WHEN a.n > 0 THEN [a.held, x.held] ELSE [x.held] END), 'held': '', 'n': 0::BIGINT}}
    WHEN a.n + x.n >= 80 THEN {{'out': list_append(a.out, {grown}), 'held': '', 'n': 0::BIGINT}}
    ELSE {{'out': a.out, 'held': {grown}, 'n': a.n + x.n}} END)"""

    def fill(parts: str) -> str:
        return f"""list_reduce(list_prepend({{'out': []::{text}[], 'held': NULL::{text}}}, list_transform({parts}, lambda p: {{'out': []::{text}[], 'held': p}})),
  lambda a, x: CASE WHEN a.held IS NULL THEN {{'out': a.out, 'held': x.held}} WHEN length(a.held) + 1 + length(x.held) <= 1000 THEN {{'out': a.out, 'held': a.held || ' ' || x.held}}
    ELSE {{'out': list_append(a.out, a.held), 'held': x.held}} END)"""

    def done(f: str) -> str:
        return f"list_append(({f}).out, ({f}).held)"

    words = f"flatten(list_transform(string_split({normal_sql('s')}, ' '), lambda w: list_transform(range(0, length(w), 1000), lambda i: substr(w, i + 1, 1000))))"
    return f"""k0 AS (SELECT document_id, {paragraphs_sql('content')} AS ps FROM {source} WHERE content IS NOT NULL),
k1 AS (SELECT document_id, {merge} AS m FROM k0),
k2 AS (SELECT document_id, CASE WHEN m.n > 0 THEN list_append(m.out, m.held) ELSE m.out END AS ts FROM k1),
k3 AS (SELECT document_id, i, ts[i] AS t FROM (SELECT document_id, ts, unnest(range(1, len(ts) + 1)) AS i FROM k2)),
k4 AS (SELECT document_id, i, j, ss[j] AS s FROM (SELECT document_id, i, ss, unnest(range(1, len(ss) + 1)) AS j FROM (SELECT document_id, i, string_split(regexp_replace(t, '([.!?]){_WS}+', '\\1' || chr(1), 'g'), chr(1)) AS ss FROM k3 WHERE length(t) > 1000))),
k5 AS (SELECT document_id, i, j, CASE WHEN length(s) <= 1000 THEN [s] ELSE {done(fill(words))} END AS parts FROM k4),
k6 AS (SELECT document_id, i, flatten(list(parts ORDER BY j)) AS parts FROM k5 GROUP BY ALL),
k7 AS (SELECT document_id, i, [t] AS texts FROM k3 WHERE length(t) <= 1000 UNION ALL SELECT document_id, i, {done(fill('parts'))} FROM k6),
k8 AS (SELECT document_id, i, j, texts[j] AS content FROM (SELECT document_id, i, texts, unnest(range(1, len(texts) + 1)) AS j FROM k7)),
k9 AS (SELECT *, sha256({normal_sql('content')}) AS content_hash FROM k8),
k10 AS (SELECT *, row_number() OVER (PARTITION BY document_id, content_hash ORDER BY i, j) AS rn FROM k9),
k AS (SELECT document_id, CAST(row_number() OVER (PARTITION BY document_id ORDER BY i, j) - 1 AS INTEGER) AS position, content, content_hash FROM k10 WHERE rn = 1)"""
