"""Queries of the operators for training text and vectors."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from driftmark.functions.ids import canonical_uuid
from driftmark.llm import encodings, leaks, packing, splitting, vectors
from driftmark.session import materialize
from driftmark.sources.tables import table

Query = Callable[[SparkSession, str], DataFrame]


def _pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "source_documents").withColumn("id", canonical_uuid(F.col("id")))
    return splitting.split_documents(splitting.current_documents(rows))


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Paragraphs that had to be cut: those of which there is a second piece."""
    return _pieces(spark, sf_dir).filter("piece_no = 1").select("document_id", "paragraph_no")


def p4_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pieces of all paragraphs with their place."""
    return _pieces(spark, sf_dir)


def p4_rejoined(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per paragraph: whether its pieces keep the limits of length and overlap, and what they give when put together."""
    pieces = _pieces(spark, sf_dir)
    # The pieces of one paragraph, which is part of one document.
    per = pieces.groupBy("document_id", "paragraph_no").agg(F.array_sort(F.collect_list(F.struct("piece_no", "start", "end", "text"))).alias("p"), F.max("end").cast("long").alias("n_chars"), F.max(F.length("text")).alias("longest"))
    shared = F.transform(F.slice("p", 2, F.greatest(F.size("p") - 1, F.lit(0))), lambda x, i: F.get("p", i)["end"] - x["start"])
    own = F.transform("p", lambda x, i: F.substring(x["text"], F.lit(1), F.coalesce(F.get("p", i + 1)["start"], x["end"]) - x["start"]))
    return per.select("document_id", "paragraph_no", "n_chars", (F.size("p") > 1).alias("cut"), (F.col("longest") <= 1000).alias("within_limit"), F.forall(shared, lambda x: (x >= 0) & (x <= 100)).alias("overlaps_kept"), F.sha2(F.array_join(own, ""), 256).alias("whole"))


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of chunks that are each among the other's 5 nearest, with a cosine of at least 0.95."""
    config = vectors.SearchConfig(p=0.999, min_cosine=0.95)
    return vectors.mutual_pairs(vectors.nearest(table(spark, sf_dir, "chunks"), config))


def p6_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 5 nearest chunks of every chunk whose id is divisible by 100, with their contents."""
    chunks = table(spark, sf_dir, "chunks")
    found = vectors.nearest(chunks, vectors.SearchConfig(p=0.999), queries=F.col("id") % 100 == 0)
    contents = chunks.groupBy(F.col("id").alias("neighbour")).agg(F.min("content").alias("content"))
    return found.join(contents, "neighbour", "left").select(F.col("query").alias("id"), "rank", F.col("neighbour").alias("neighbour_id"), F.round(F.col("cosine").cast("double"), 3).alias("cosine"), "content")


def vocabulary() -> str:
    """The vocabulary file for packing; ``DRIFTMARK_VOCABULARY`` names another one."""
    return os.environ.get("DRIFTMARK_VOCABULARY", "/opt/tokenizers/byte_bpe_multi_50k.tiktoken")


def p7_packed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which text lies in which sequence of 2,048 tokens."""
    return packing.pack(table(spark, sf_dir, "documents"), vocabulary())


def _kept(documents: DataFrame, packed: DataFrame, config: packing.PackConfig) -> DataFrame:
    """One row: what a packing promises, checked against the texts encoded anew."""
    n = F.col("n_tokens").cast("long")
    per = packed.groupBy("sequence_id").agg(F.sum(n).alias("tokens"), F.count(F.lit(1)).alias("pieces"), F.sum(n * n).alias("attention"))
    of_sequences = per.agg((F.max("tokens") <= config.tokens).alias("tokens_kept"), (F.max("pieces") <= config.documents).alias("documents_kept"), (F.max(F.when(F.col("pieces") > 1, F.col("attention"))) <= config.attention).alias("attention_kept"))
    by_text = packed.groupBy("doc_id").agg(F.sum(n).alias("packed"), F.count(F.lit(1)).alias("pieces"), F.max(F.col("token_start") + n).alias("end"))
    sizes = packing.count_tokens(documents, vocabulary()).groupBy("doc_id").agg(F.sum("n_tokens").alias("tokens"))
    both = sizes.join(by_text, "doc_id", "full_outer")
    whole = F.col("tokens").eqNullSafe(F.col("packed")) & F.col("end").eqNullSafe(F.col("tokens")) & (F.col("pieces") == F.greatest(F.ceil(F.col("tokens") / config.tokens), F.lit(1)))
    of_texts = both.agg(F.count(F.lit(1)).alias("texts"), F.bool_and(F.coalesce(whole, F.lit(False))).alias("texts_whole"))
    return of_sequences.crossJoin(of_texts)  # one row each


def p7_kept(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether every text is in the packing, cut only where it is longer than a sequence, every capacity is kept,
    and little room is left over."""
    documents, packed = table(spark, sf_dir, "documents"), materialize(p7_packed(spark, sf_dir), "packed")
    fill = packed.agg((F.sum("n_tokens") >= 0.97 * 2048 * F.count_distinct("sequence_id")).alias("well_filled"))
    return _kept(documents, packed, packing.PackConfig()).crossJoin(fill)


def p7_attention(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with half of a full sequence's attention cost as capacity, which binds: long texts are joined by
    many short ones or stay alone."""
    config, documents = packing.PackConfig(attention=2048 * 2048 // 2), table(spark, sf_dir, "documents")
    return _kept(documents, materialize(packing.pack(documents, vocabulary(), config), "packed"), config)


def p8_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaks with the longest shared run, where it is in the text, and whether the answer is there too."""
    return leaks.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "eval_items"))


def p8_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which test items leaked into which documents."""
    return p8_report(spark, sf_dir).select("item_id", "doc_id")


def p8_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many words each leak shares in a row at most, and whether the answer is there, too."""
    return p8_report(spark, sf_dir).select("item_id", "doc_id", "n_words", "answer_seen")


def p9_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Garbled documents with what is wrong and the restored text."""
    return encodings.find_garbled(table(spark, sf_dir, "documents"))


def p9_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that were decoded with a wrong encoding, wholly or in places."""
    return p9_report(spark, sf_dir).select("doc_id")


QUERIES: dict[str, Query] = {f.__name__: f for f in (p4_found, p4_pieces, p4_rejoined, p6_found, p6_neighbours, p7_packed, p7_kept, p7_attention, p8_found, p8_report, p8_runs, p9_found, p9_report)}
