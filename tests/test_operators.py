"""Chunking, hashing, diffing, embedding, retries, events and metrics."""

import json
import math
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from driftmark.functions import text as T
from driftmark.functions import vectors as V
from driftmark.operators import diffing, metrics
from driftmark.operators.chunking import ChunkingConfig, canonical, chunk, chunk_documents, chunk_texts, digest
from driftmark.operators.embedding import EmbeddingError, FailingProvider, HashedWords, PermanentEmbeddingError, RemoteProvider, RetryPolicy, TransientEmbeddingError, check_vectors, create_provider, embed_documents, embed_with_retries, failures
from driftmark.settings import Settings, SettingsError

SMALL = ChunkingConfig(40, 200)


def para(label):
    return f"{label} one sentence is here. {label} another sentence follows it. {label} a third one ends the paragraph."


def texts(content, config=SMALL):
    return [t for _, t, _ in chunk(content, config)]


def test_chunks_of_nothing():
    assert texts("") == [] == texts(" \n\n\t 　 ")


def test_paragraphs_and_line_ends():
    assert texts(f"{para('A')}\r\n\r\n{para('B')}\n \t\n\n{para('C')}") == [para("A"), para("B"), para("C")]


def test_small_paragraphs_join():
    assert texts(f"Title\n\nby me\n\n{para('A')}") == ["Title\n\nby me", para("A")]
    assert texts(f"{para('A')}\n\nend") == [para("A"), "end"]
    assert texts("x" * 25 + "\n\n" + "y" * 25 + "\n\nz") == ["x" * 25 + "\n\n" + "y" * 25, "z"]


def test_long_paragraphs_are_cut():
    long = " ".join(f"Sentence number {i} is about this long." for i in range(20))
    assert all(len(t) <= 200 for t in texts(long)) and " ".join(texts(long)) == long
    words = " ".join(f"word{i}" for i in range(80))
    assert " ".join(texts(words)) == words and max(map(len, texts(words))) <= 200
    assert [len(t) for t in chunk_texts("q" * 450, SMALL)] == [200, 200, 50]


def test_repeated_chunks_count_once():
    got = chunk(f"{para('A')}\n\n{para('B')}\n\n{para('A')}", SMALL)
    assert [(p, t) for p, t, _ in got] == [(0, para("A")), (1, para("B"))]


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="ab.!? \n\t\r éé", max_size=900))
def test_chunks_lose_nothing(content):
    config = ChunkingConfig(10, 50)
    got = chunk(content, config)
    assert [p for p, _, _ in got] == list(range(len(got))) and len({h for _, _, h in got}) == len(got)
    assert all(len(t) <= 50 for _, t, _ in got)
    assert set("".join(canonical(content).split())) >= set("".join("".join(canonical(t).split()) for _, t, _ in got)) - {"́"}


def test_hash_is_of_canonical_text(spark):
    assert digest("café  x\n") == digest("café x") != digest("Café x") and digest("a.") != digest("a")
    rows = ["café  x\n", "a b", "", None, "　x y"]
    got = spark.createDataFrame([(t,) for t in rows], "t string").select(T.content_hash(F.col("t"))).collect()
    assert [r[0] for r in got] == [None if t is None else digest(t) for t in rows]


def test_config_is_checked():
    for bad in ((0, 10), (20, 10)):
        with pytest.raises(ValueError):
            ChunkingConfig(*bad)
    with pytest.raises(SettingsError):
        Settings(embedding_failure_rate=2.0)
    assert Settings.from_env({"DRIFTMARK_MAX_RETRIES": "2", "DRIFTMARK_MIN_CHARS": " "}).max_retries == 2
    with pytest.raises(SettingsError):
        Settings.from_env({"DRIFTMARK_MAX_RETRIES": "two"})


def _actions(spark, desired, stored):
    d = spark.createDataFrame([("d", h, i) for i, h in enumerate(desired)], "document_id string, content_hash string, position int")
    s = spark.createDataFrame([("d", h, i) for h, i in stored.items()], "document_id string, content_hash string, position int")
    return sorted((r["content_hash"], r["action"]) for r in diffing.diff_chunks(d, s).collect())


def test_diff(spark):
    assert _actions(spark, "abc", {"a": 0, "b": 1, "c": 2}) == [("a", "reuse"), ("b", "reuse"), ("c", "reuse")]
    assert _actions(spark, "axbc", {"a": 0, "b": 1, "c": 2}) == [("a", "reuse"), ("b", "move"), ("c", "move"), ("x", "embed")]
    assert _actions(spark, "ba", {"a": 0, "b": 1}) == [("a", "move"), ("b", "move")]
    assert _actions(spark, "", {"a": 0}) == [("a", "delete")]
    edit = [para(c) for c in "ABCDEFGH"]
    before = {h: i for i, (_, _, h) in enumerate(chunk("\n\n".join(edit), SMALL))}
    edit[3] += " And one more."
    after = [h for _, _, h in chunk("\n\n".join(edit), SMALL)]
    assert sum(h not in before for h in after) == 1


def test_hashed_words():
    p = HashedWords(64)
    a, b, c = p.embed(["The train to the office was late", "train late office", "invoice archive rules"])
    assert abs(math.fsum(x * x for x in a) - 1) < 1e-9 and p.embed(["the of and"]) == p.embed(["the of  and"]) != p.embed(["the of"])
    dot = lambda x, y: sum(i * j for i, j in zip(x, y))
    assert dot(a, b) > 0.5 > dot(a, c)
    with pytest.raises(ValueError):
        HashedWords(0)


def test_providers_and_retries():
    inner = HashedWords(8)
    assert FailingProvider(inner, 0.0).embed(["x"]) == inner.embed(["x"])
    with pytest.raises(TransientEmbeddingError):
        FailingProvider(inner, 1.0).embed(["x"])
    share = sum(embed_with_retries(FailingProvider(inner, 0.3), [str(i)], RetryPolicy(0))[1] is not None for i in range(500)) / 500
    assert 0.2 < share < 0.4
    waits = []
    assert embed_with_retries(FailingProvider(inner, 1.0), ["x"], RetryPolicy(3), waits.append)[2] == 4 and len(waits) == 3
    assert embed_with_retries(FailingProvider(inner, 1.0, permanent=True), ["x"], RetryPolicy(3), waits.append)[2] == 1
    policy = RetryPolicy(9, 0.5, 30.0)
    assert [policy.ceiling(r) for r in (0, 1, 2, 10)] == [0.5, 1.0, 2.0, 30.0] and 0 <= policy.delay(3, random.Random(1)) <= 4
    remote = RemoteProvider(lambda ts: [(i, [float(t)]) for i, t in reversed(list(enumerate(ts)))], 1, 2)
    assert remote.embed(["3", "1", "2"]) == [[3.0], [1.0], [2.0]]
    with pytest.raises(PermanentEmbeddingError):
        check_vectors([[1.0]], 1, 2)
    with pytest.raises(ValueError):
        create_provider("other", 8)
    assert create_provider("hashed", 8, 0.5).dimension == 8 and issubclass(TransientEmbeddingError, EmbeddingError)


def test_a_document_embeds_as_a_whole(spark):
    rows = spark.createDataFrame([("a", "h1", "x"), ("a", "h2", "y"), ("b", "h3", None)], "document_id string, content_hash string, content string")
    got = {r["document_id"]: r for r in embed_documents(rows, HashedWords(4), RetryPolicy(0)).collect()}
    assert [v["content_hash"] for v in got["a"]["vectors"]] == ["h1", "h2"] and len(got["b"]["vectors"]) == 1
    failed = embed_documents(rows, FailingProvider(HashedWords(4), 1.0), RetryPolicy(0)).collect()
    assert {(r["document_id"], r["error_type"], r["attempts"]) for r in failed} == {("a", "TransientEmbeddingError", 1), ("b", "TransientEmbeddingError", 1)}


def test_long_documents_are_embedded_in_several_calls(spark):
    rows = spark.createDataFrame([("a", f"h{i}", f"text number {i}") for i in range(40)] + [("b", "h", "x")], "document_id string, content_hash string, content string")
    got = embed_documents(rows, HashedWords(4), RetryPolicy(0), 8).collect()
    assert sum(r["document_id"] == "a" for r in got) > 1 and sum(r["document_id"] == "b" for r in got) == 1
    assert sorted(v["content_hash"] for r in got if r["document_id"] == "a" for v in r["vectors"]) == sorted(f"h{i}" for i in range(40))
    some = embed_documents(rows, FailingProvider(HashedWords(4), 0.5, 2), RetryPolicy(0), 8)
    calls = [r["error_type"] for r in some.collect() if r["document_id"] == "a"]
    assert None in calls and "TransientEmbeddingError" in calls  # some calls failed, so the document did
    assert "a" in {r["document_id"] for r in failures(some).collect()} and failures(some).count() <= 2


def test_events_as_json(spark):
    u, v = "01234567-89ab-4cde-8f01-23456789abcd", "11234567-89ab-4cde-8f01-23456789abcd"
    good = spark.sql(f"SELECT '{u}' e, '{v}' d, 'upserted' t, 3 n, TIMESTAMP '2025-01-02 03:04:05.000006' c").select(T.event_json(F.col("e"), F.col("d"), F.col("t"), F.col("n"), F.col("c")).alias("v"))
    raw = good.head()["v"]
    assert list(json.loads(raw)) == ["event_id", "document_id", "event_type", "document_version", "created_at"]
    broken = [raw[:30], "[1]", "7", "null", None, "", raw.replace("upserted", "made"), raw.replace("+00:00", ""), raw.replace(u, "x"), raw.replace(":3,", ":null,"), raw.replace(":3,", ':"z",')]
    got = spark.createDataFrame([(x,) for x in [raw, *broken]], "v string").select(T.decode_event(F.col("v")).alias("e")).collect()
    assert got[0]["e"]["error"] is None and got[0]["e"]["document_version"] == 3 and got[0]["e"]["document_id"] == v
    assert [r["e"]["error"] for r in got[1:]] == ["malformed payload"] * 6 + ["unknown event type", "time without offset", "malformed id", "malformed version", "malformed version"]


def test_vectors(spark):
    row = spark.sql("SELECT array(1f, 0f) a, array(0f, 2f) b, array(0f, 0f) z, array(1f) w").select(
        V.cosine_similarity(F.col("a"), F.col("b")).alias("ab"), V.cosine_distance(F.col("a"), F.col("a")).alias("aa"), V.cosine_similarity(F.col("a"), F.col("z")).alias("az"), V.cosine_similarity(F.col("a"), F.col("w")).alias("aw"), V.close(F.col("a"), F.col("a")).alias("c"), V.close(F.col("a"), F.col("w")).alias("d"),
    ).head()
    assert (row["ab"], row["aa"], row["az"], row["aw"], row["c"], row["d"]) == (0.0, 0.0, None, None, True, False)


def test_metrics_edge_cases(spark):
    none = spark.createDataFrame([], "lag double")
    assert math.isnan(metrics.histogram_quantile(metrics.histogram(none, "lag"), 0.5).head()[0])
    some = spark.createDataFrame([(float(x),) for x in (1, 2, 3, 5000)], "lag double")
    assert metrics.nearest_ranks(some, "lag", (0.5, 0.99)).head()[:] == (2.0, 5000.0)
    assert metrics.histogram_quantile(metrics.histogram(some, "lag"), 0.99).head()[0] == 1800.0
    samples = spark.createDataFrame([("a", 1, 5.0), ("a", 2, 7.0), ("a", 3, 1.0)], "name string, ts int, value double")
    assert [r["delta"] for r in metrics.counter_deltas(samples, ["name"]).orderBy("ts").collect()] == [0.0, 2.0, 1.0]
    row = spark.range(1).select(metrics.consumer_lag(F.lit(9), F.lit(-1)), metrics.consumer_lag(F.lit(9), F.lit(4)), metrics.reuse_ratio(F.lit(0), F.lit(0)), metrics.throughput(F.lit(1), F.lit(0))).head()
    assert row[:3] == (0, 5, 0.0) and math.isnan(row[3])


def test_chunk_documents_ignores_null_contents(spark):
    df = spark.createDataFrame([("a", None, 1), ("b", "", 2), ("c", para("C"), 3)], "document_id string, content string, position int")
    assert [(r["document_id"], r["position"]) for r in chunk_documents(df, SMALL).collect()] == [("c", 0)]


def test_merge_small_matches_the_chunker(spark):
    rng = random.Random(3)
    docs = ["\n\n".join("w" * rng.choice([1, 5, 30, 39, 40, 90]) for _ in range(rng.randrange(8))) for _ in range(60)]
    got = spark.createDataFrame([(d,) for d in docs], "c string").select(T.merge_small(T.paragraphs(F.col("c")), 40).alias("m")).collect()
    assert [r["m"] for r in got] == [list(chunk_texts(d, SMALL)) for d in docs]
