"""Embedding providers and their use over documents, with retries and failures per document."""

from __future__ import annotations

import hashlib
import http.client
import json
import math
import os
import random
import re
import time
import urllib.error
import urllib.request
from collections import Counter
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from functools import lru_cache
from typing import Any, Protocol

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftmark.functions.text import STOP_WORDS
from driftmark.operators.chunking import canonical
from driftmark.session import ship

_WORD = re.compile(r"\w+")
_STOP = frozenset(STOP_WORDS)


class EmbeddingError(Exception):
    """Embedding failed."""


class TransientEmbeddingError(EmbeddingError):
    """May work when tried again."""


class PermanentEmbeddingError(EmbeddingError):
    """Will not work when tried again."""


class EmbeddingProvider(Protocol):
    """What turns texts into vectors of ``dimension`` numbers; it is shipped to the workers."""

    @property
    def dimension(self) -> int: ...

    def embed(self, texts: Sequence[str]) -> list[list[float]]: ...


def check_vectors(vectors: list[list[float]], count: int, dimension: int) -> None:
    if len(vectors) != count:
        raise PermanentEmbeddingError(f"{count} vectors expected, {len(vectors)} returned")
    if any(len(v) != dimension for v in vectors):
        raise PermanentEmbeddingError(f"vectors of {dimension} numbers expected")


def unit(vector: list[float]) -> list[float]:
    length = math.sqrt(math.fsum(v * v for v in vector))
    return [v / length for v in vector]


@lru_cache(maxsize=100_000)
def _slot(word: str, dimension: int) -> tuple[int, float]:
    """The dimension that a word counts for, and its sign."""
    h = hashlib.sha256(word.encode()).digest()
    return int.from_bytes(h[:8], "big") % dimension, 1.0 if h[8] % 2 else -1.0


@dataclass(frozen=True)
class HashedWords:
    """A deterministic offline provider: words hashed to signed dimensions, damped counts, unit length."""

    dimension: int = 384

    def __post_init__(self) -> None:
        if self.dimension <= 0:
            raise ValueError("dimension must be positive")

    def embed(self, texts: Sequence[str]) -> list[list[float]]:
        return [self.vector(t) for t in texts]

    def vector(self, text: str) -> list[float]:
        plain = canonical(text)
        out = [0.0] * self.dimension
        for word, n in Counter(w for w in _WORD.findall(plain.lower()) if w not in _STOP).items():
            at, sign = _slot(word, self.dimension)
            out[at] += sign * (1.0 + math.log(n))
        if not any(out):  # no words, or they cancelled out: a vector that the whole text seeds
            generator = random.Random(hashlib.sha256(plain.encode()).digest())
            out = [generator.gauss(0.0, 1.0) for _ in out]
        return unit(out)


@dataclass(frozen=True)
class FailingProvider:
    """Fails a share of the calls before it delegates; the same text fails alike in a replayed task."""

    inner: Any
    rate: float
    seed: int = 0
    permanent: bool = False

    def __post_init__(self) -> None:
        if not 0.0 <= self.rate <= 1.0:
            raise ValueError("rate must be between 0 and 1")

    @property
    def dimension(self) -> int:
        return int(self.inner.dimension)

    def embed(self, texts: Sequence[str], attempt: int = 1) -> list[list[float]]:
        draw = hashlib.sha256(f"{self.seed}/{attempt}/".encode() + "\0".join(texts).encode()).digest()
        if int.from_bytes(draw[:7], "big") / 2**56 < self.rate:
            raise (PermanentEmbeddingError if self.permanent else TransientEmbeddingError)("injected failure")
        return self.inner.embed(texts)


@dataclass(frozen=True)
class RemoteProvider:
    """A provider behind ``call(texts) -> [(index, vector)]``, asked in batches; results go by their index."""

    call: Callable[[list[str]], list[tuple[int, list[float]]]]
    dimension: int
    batch_size: int = 2048

    def embed(self, texts: Sequence[str]) -> list[list[float]]:
        out: list[list[float]] = []
        for a in range(0, len(texts), self.batch_size):
            part = list(texts[a:a + self.batch_size])
            vectors = [v for _, v in sorted(self.call(part), key=lambda x: x[0])]
            check_vectors(vectors, len(part), self.dimension)
            out += vectors
        return out


@dataclass(frozen=True)
class HttpEmbeddings:
    """Asks a service that takes ``{"model", "input"}`` as JSON and answers ``{"data": [{"index", "embedding"}]}``.

    The key is read from an environment variable where the request is made, so it is in no plan. Time-outs, lost
    connections, too many requests and errors of the server may work when tried again, other answers will not.
    """

    url: str
    model: str
    key_variable: str = "EMBEDDING_API_KEY"
    timeout: float = 30.0

    def __call__(self, texts: list[str]) -> list[tuple[int, list[float]]]:
        headers = {"Content-Type": "application/json"}
        if key := os.environ.get(self.key_variable, ""):
            headers["Authorization"] = f"Bearer {key}"
        request = urllib.request.Request(self.url, json.dumps({"model": self.model, "input": texts}).encode(), headers)
        try:
            with urllib.request.urlopen(request, timeout=self.timeout) as answer:
                return [(int(d["index"]), [float(x) for x in d["embedding"]]) for d in json.load(answer)["data"]]
        except urllib.error.HTTPError as e:
            kind = TransientEmbeddingError if e.code in (408, 409, 429) or e.code >= 500 else PermanentEmbeddingError
            raise kind(f"status {e.code}") from e
        except (OSError, http.client.HTTPException) as e:
            raise TransientEmbeddingError(str(e)) from e
        except (ValueError, KeyError, TypeError) as e:
            raise PermanentEmbeddingError(f"unexpected answer: {e}") from e


def create_provider(name: str, dimension: int, failure_rate: float = 0.0, remote: HttpEmbeddings | None = None) -> EmbeddingProvider:
    """A provider by name; a failure rate above 0 wraps it."""
    provider: Any
    if name == "hashed":
        provider = HashedWords(dimension)
    elif name == "remote" and remote is not None:
        provider = RemoteProvider(remote, dimension)
    else:
        raise ValueError(f"unknown provider {name!r}")
    return FailingProvider(provider, failure_rate) if failure_rate > 0 else provider


@dataclass(frozen=True)
class RetryPolicy:
    """Bounded retries with full jitter: wait uniformly up to base * 2^retry, at most ``max_delay`` seconds."""

    max_retries: int = 5
    base_delay: float = 0.5
    max_delay: float = 30.0

    @property
    def max_attempts(self) -> int:
        return self.max_retries + 1

    def ceiling(self, retry: int) -> float:
        return min(self.max_delay, self.base_delay * 2.0**retry)

    def delay(self, retry: int, generator: random.Random | None = None) -> float:
        return (generator or random).uniform(0.0, self.ceiling(retry))  # type: ignore[union-attr]


def retryable(error: BaseException) -> bool:
    return not isinstance(error, PermanentEmbeddingError)


def embed_with_retries(provider: Any, texts: Sequence[str], policy: RetryPolicy, sleep: Callable[[float], None] = time.sleep) -> tuple[list[list[float]] | None, BaseException | None, int]:
    """(vectors, error, attempts): the vectors, or the last error once no attempt is left."""
    for attempt in range(1, policy.max_attempts + 1):
        try:
            vectors = provider.embed(texts, attempt) if isinstance(provider, FailingProvider) else provider.embed(texts)
            check_vectors(vectors, len(texts), provider.dimension)
            return vectors, None, attempt
        except Exception as e:  # noqa: BLE001 - whatever a provider raises is the document's failure
            if not retryable(e) or attempt == policy.max_attempts:
                return None, e, attempt
            sleep(policy.delay(attempt - 1))
    raise AssertionError


EMBEDDED = "document_id string, vectors array<struct<content_hash:string,embedding:array<float>>>, error_type string, error_message string, attempts int"


#: Chunks that one call embeds at most about.
CALL_ROWS = 2048


def embed_documents(wanted: DataFrame, provider: Any, policy: RetryPolicy | None = None, call_rows: int = CALL_ROWS) -> DataFrame:
    """Embed the new chunks of each document together, so that a document fails or succeeds as a whole.

    ``wanted`` has document_id, content_hash and content. A document's chunks come together in one call, those of a
    long document in several of about ``call_rows`` chunks, drawn by hash, so no row grows with the document. There
    is a row per call, with its error and attempts instead of vectors where it failed; that does not fail the batch,
    and a document of which any call failed has ``failures``.
    """
    policy = policy or RetryPolicy()
    ship(wanted.sparkSession)
    sizes = wanted.groupBy("document_id").agg(F.ceil(F.count(F.lit(1)) / call_rows).alias("calls"))
    parted = wanted.join(sizes, "document_id").withColumn("call", F.pmod(F.xxhash64("content_hash"), F.col("calls")))
    grouped = parted.groupBy("document_id", "call").agg(F.sort_array(F.collect_list(F.struct("content_hash", "content"))).alias("chunks")).drop("call")

    def run(batches: Iterator[Any]) -> Iterator[Any]:
        import pyarrow as pa

        item = pa.list_(pa.struct([("content_hash", pa.string()), ("embedding", pa.list_(pa.float32()))]))
        for b in batches:
            out = []
            for doc, chunks in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                vectors, error, attempts = embed_with_retries(provider, [c["content"] or "" for c in chunks], policy)
                held = None if vectors is None else [{"content_hash": c["content_hash"], "embedding": v} for c, v in zip(chunks, vectors, strict=True)]
                out.append((doc, held, type(error).__name__ if error else None, str(error) if error else None, attempts))
            cols = list(zip(*out)) or [()] * 5
            kinds = [pa.string(), item, pa.string(), pa.string(), pa.int32()]
            yield pa.record_batch([pa.array(c, k) for c, k in zip(cols, kinds)], names=["document_id", "vectors", "error_type", "error_message", "attempts"])

    return grouped.mapInArrow(run, EMBEDDED)


def failures(embedded: DataFrame) -> DataFrame:
    """(``document_id``, ``error_type``, ``error_message``, ``attempts``) of the documents of which a call failed."""
    failed = embedded.filter("error_type IS NOT NULL")
    first = F.struct("error_type", "error_message", "attempts")
    return failed.groupBy("document_id").agg(F.max_by(first, first).alias("e")).select("document_id", "e.*")


def embed_texts(rows: DataFrame, provider: Any, text: str, *keep: str) -> DataFrame:
    """The rows' ``keep`` columns with ``embedding`` of their text, row by row in Arrow batches."""
    ship(rows.sparkSession)
    kept = rows.select(*keep, F.coalesce(F.col(text), F.lit("")).alias("dm_text"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields[:-1]) + ", embedding array<float>"

    def run(batches: Iterator[Any]) -> Iterator[Any]:
        import pyarrow as pa

        for b in batches:
            vectors = provider.embed(b.column(b.num_columns - 1).to_pylist())
            yield pa.record_batch([*b.columns[:-1], pa.array(vectors, pa.list_(pa.float32()))], names=[*b.schema.names[:-1], "embedding"])

    return kept.mapInArrow(run, schema)
