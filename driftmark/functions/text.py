"""Text expressions: canonical text, hashes, paragraphs, tokens, vectors as text, change events as JSON."""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: White space of any Unicode kind, as Java and RE2 write it. Their own class for it holds less.
WS = r"[\x09-\x0d\x1c-\x20\x85\xa0\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
WORD = r"[\p{L}\p{N}_]+"
# Filler words that the hashed embedding leaves out.
STOP_WORDS = (
    "a an and are as at be by can do does for from has have how if in is it its of on or our that the their there this to was we "
    "what when where which who why will with you your"
).split()


@F.pandas_udf(T.StringType())
def _nfc(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for s in texts:
        yield s.map(lambda t: t if t is None or t.isascii() or unicodedata.is_normalized("NFC", t) else unicodedata.normalize("NFC", t))


def nfc(c: Column) -> Column:
    """Unicode composition; the JVM's normalizer is out of reach of expressions, so this is an Arrow UDF."""
    return _nfc(c)


def strip(c: Column) -> Column:
    """Without white space of any Unicode kind at both ends."""
    return F.regexp_replace(c, f"^{WS}+|{WS}+$", "")


def squeeze(c: Column) -> Column:
    """Runs of white space as one space, none at the ends."""
    return F.trim(F.regexp_replace(c, f"{WS}+", " "))


def normalize(c: Column) -> Column:
    """Canonical text: composed, white space squeezed."""
    return squeeze(nfc(c))


def content_hash(c: Column) -> Column:
    """SHA-256 of the canonical text in UTF-8, in hex. Null stays null."""
    return F.sha2(normalize(c), 256)


def paragraphs(c: Column) -> Column:
    """The stripped non-empty paragraphs of a text; CR LF is LF, blank lines part them."""
    parts = F.split(F.replace(c, F.lit("\r\n"), F.lit("\n")), rf"\n{WS}*\n")
    return F.filter(F.transform(parts, strip), lambda p: p != "")


def merge_small(parts: Column, min_chars: int) -> Column:
    """Join neighbouring paragraphs shorter than ``min_chars`` until together they are as long.

    A paragraph of full size ends what was being joined. A fold, since the running length starts over.
    """
    none = F.array().cast("array<string>")
    start = F.struct(none.alias("out"), none.alias("open"), F.lit(0).alias("n"))

    def joined(acc: Column) -> Column:
        return F.when(acc["n"] > 0, F.array(F.array_join(acc["open"], "\n\n"))).otherwise(none)

    def step(acc: Column, p: Column) -> Column:
        n = F.length(p)
        grown = F.array_append(acc["open"], p)
        full = F.struct(F.concat(acc["out"], joined(acc), F.array(p)).alias("out"), none.alias("open"), F.lit(0).alias("n"))
        done = F.struct(F.array_append(acc["out"], F.array_join(grown, "\n\n")).alias("out"), none.alias("open"), F.lit(0).alias("n"))
        more = F.struct(acc["out"].alias("out"), grown.alias("open"), (acc["n"] + n).alias("n"))
        return F.when(n >= min_chars, full).when(acc["n"] + n >= min_chars, done).otherwise(more)

    return F.aggregate(parts, start, step, lambda acc: F.concat(acc["out"], joined(acc)))


def fixed_windows(c: Column, size: int) -> Column:
    """The text cut every ``size`` characters, to compare with paragraphs."""
    n = F.ceil(F.length(c) / size).cast("int")
    return F.when(n > 0, F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.substring(c, i * size + 1, F.lit(size)))).otherwise(F.array().cast("array<string>"))


def tokens(c: Column) -> Column:
    """Lower-case words without stop words."""
    words = F.regexp_extract_all(F.lower(c), F.lit(f"({WORD})"), 1)
    return F.filter(words, lambda w: ~w.isin(STOP_WORDS))


def vector_to_text(c: Column) -> Column:
    """``[v,...]``, as a vector is written in text."""
    return F.to_json(c)


def vector_from_text(c: Column) -> Column:
    return F.from_json(c, "array<float>")


EVENT = "event_id string, document_id string, event_type string, document_version string, created_at string, dm_broken string"
_OFFSET = r"(Z|[+-][0-9]{2}:?[0-9]{2}(:?[0-9]{2})?)$"


def event_json(event_id: Column, document_id: Column, event_type: Column, document_version: Column, created_at: Column) -> Column:
    """A change event as JSON, keys in fixed order, the time in ISO form with its offset."""
    time = F.date_format(created_at, "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx")
    return F.to_json(F.struct(event_id.alias("event_id"), document_id.alias("document_id"), event_type.alias("event_type"), document_version.alias("document_version"), time.alias("created_at")), {"ignoreNullFields": "false"})


def event_key(document_id: Column) -> Column:
    """The message key: the document id in UTF-8."""
    return document_id.cast("binary")


def decode_event(value: Column) -> Column:
    """A struct of the event's fields and ``error``: null for a valid event, else what is wrong with it.

    Checked in this order: JSON object, event type, time with an offset, ids, version. Every payload gets an
    answer, also lists, nulls and broken text.
    """
    from driftmark.functions.ids import canonical_uuid

    e = F.from_json(value.cast("string"), EVENT, {"columnNameOfCorruptRecord": "dm_broken"})
    version = e["document_version"].try_cast("int")
    created = F.try_to_timestamp(e["created_at"])
    error = (
        F.when(value.isNull() | e.isNull() | e["dm_broken"].isNotNull() | ~F.coalesce(strip(value.cast("string")).startswith("{"), F.lit(False)), "malformed payload")
        .when(~F.coalesce(e["event_type"].isin("upserted", "deleted"), F.lit(False)), "unknown event type")
        .when(created.isNull() | ~F.coalesce(e["created_at"].rlike(_OFFSET), F.lit(False)), "time without offset")
        .when(canonical_uuid(e["event_id"]).isNull() | canonical_uuid(e["document_id"]).isNull(), "malformed id")
        .when(version.isNull(), "malformed version")
    )
    return F.struct(canonical_uuid(e["event_id"]).alias("event_id"), canonical_uuid(e["document_id"]).alias("document_id"), e["event_type"].alias("event_type"), version.alias("document_version"), created.alias("created_at"), error.alias("error"))
