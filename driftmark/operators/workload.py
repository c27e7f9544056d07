"""Edits of documents by paragraph, to measure how much of an index they touch."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def swap(parts: Column, i: int, j: int) -> Column:
    """Two paragraphs exchanged; out of range, nothing happens."""
    n = F.size(parts)
    swapped = F.transform(parts, lambda p, k: F.when(k == i, F.get(parts, F.lit(j))).when(k == j, F.get(parts, F.lit(i))).otherwise(p))
    return F.when((n > i) & (n > j), swapped).otherwise(parts)


def insert(parts: Column, at: Column, text: Column) -> Column:
    """A paragraph put in front of position ``at``."""
    return F.concat(F.slice(parts, 1, at), F.array(text), F.slice(parts, at + 1, F.greatest(F.size(parts) - at, F.lit(0))))


def remove(parts: Column, at: Column) -> Column:
    """Without the paragraph at position ``at``."""
    return F.filter(parts, lambda _, i: i != at)


def rewrite(parts: Column, chosen, edit) -> Column:
    """Paragraphs for whose position ``chosen`` holds, put through ``edit``."""
    return F.transform(parts, lambda p, i: F.when(chosen(i), edit(p)).otherwise(p))


def join(parts: Column) -> Column:
    """The paragraphs as the content of a document."""
    return F.array_join(parts, "\n\n")


def drawn(key: Column, i: Column, below: str) -> Column:
    """A fixed draw per (key, position): whether the first two hex digits of a digest are below a bound."""
    return F.substring(F.md5(F.concat_ws(":", key, i.cast("string"))), 1, 2) < below


def synthetic_documents(spark: SparkSession, n: int, seed: int) -> DataFrame:
    """``n`` documents (``number``, ``document_id``, ``title``, ``content``) of 4 to 12 paragraphs, the same for the
    same seed. Made by expressions alone, so as many as one likes are made where they are needed."""
    key = lambda *parts: F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("id").cast("string"), *parts))
    digest = F.md5(F.concat_ws("|", F.lit(str(seed)), F.col("id").cast("string")))
    document = F.concat_ws("-", F.substring(digest, 1, 8), F.substring(digest, 9, 4), F.concat(F.lit("4"), F.substring(digest, 14, 3)), F.concat(F.lit("8"), F.substring(digest, 18, 3)), F.substring(digest, 21, 12))
    many = (F.conv(F.substring(key(), 1, 4), 16, 10).cast("int") % 9 + 4).cast("int")

    def paragraph(p: Column) -> Column:
        return F.concat(F.lit("Section "), (p + 1).cast("string"), F.lit(" of record "), F.col("id").cast("string"), F.lit(" covers case "), key(p.cast("string")), F.lit(". It names who decides and what has to be filed, and it holds until the next review."))

    return spark.range(n).select(F.col("id").alias("number"), document.alias("document_id"), F.concat(F.lit("Record "), F.col("id").cast("string")).alias("title"), F.array_join(F.transform(F.sequence(F.lit(0), many - 1), paragraph), "\n\n").alias("content"))
