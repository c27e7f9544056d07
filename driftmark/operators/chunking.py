"""Chunks of a document: paragraphs, small ones joined, long ones cut at sentences, each known by its hash."""

from __future__ import annotations

import hashlib
import re
import unicodedata
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftmark.session import ship

_BLANK = re.compile(r"\n\s*\n")
_STOP = re.compile(r"(?<=[.!?])\s+")
CHUNKS = "document_id string, position int, content string, content_hash string"


@dataclass(frozen=True)
class ChunkingConfig:
    """Shorter paragraphs than ``min_chars`` are joined, longer ones than ``max_chars`` cut."""

    min_chars: int = 80
    max_chars: int = 1000

    def __post_init__(self) -> None:
        if self.min_chars <= 0 or self.max_chars < self.min_chars:
            raise ValueError("require 0 < min_chars <= max_chars")


def canonical(text: str) -> str:
    """Composed, runs of white space as one space."""
    return " ".join((text if text.isascii() else unicodedata.normalize("NFC", text)).split())


def digest(text: str) -> str:
    return hashlib.sha256(canonical(text).encode()).hexdigest()


def _fill(parts: Iterable[str], limit: int) -> Iterator[str]:
    """Join parts by a space as long as the result keeps the limit."""
    held: list[str] = []
    size = 0
    for part in parts:
        if held and size + 1 + len(part) > limit:
            yield " ".join(held)
            held, size = [], 0
        size += len(part) + (1 if held else 0)
        held.append(part)
    if held:
        yield " ".join(held)


def _within(sentence: str, limit: int) -> Iterator[str]:
    """A sentence in parts of at most ``limit`` characters; words are cut only if longer than that."""
    if len(sentence) <= limit:
        yield sentence
        return
    words = canonical(sentence).split(" ")
    yield from _fill((w[i:i + limit] for w in words for i in range(0, len(w), limit)), limit)


def chunk_texts(content: str, config: ChunkingConfig) -> Iterator[str]:
    """The texts of the chunks in order, repeated ones included."""
    small: list[str] = []
    for raw in _BLANK.split(content.replace("\r\n", "\n")):
        if not (p := raw.strip()):
            continue
        whole = len(p) >= config.min_chars
        if not whole:
            small.append(p)
        if small and (whole or sum(map(len, small)) >= config.min_chars):
            yield "\n\n".join(small)
            small = []
        if whole:
            if len(p) <= config.max_chars:
                yield p
            else:
                yield from _fill((part for s in _STOP.split(p) for part in _within(s, config.max_chars)), config.max_chars)
    if small:
        yield "\n\n".join(small)


def chunk(content: str, config: ChunkingConfig) -> list[tuple[int, str, str]]:
    """(position, text, hash), each hash once at its first place, positions dense."""
    first: dict[str, str] = {}
    for text in chunk_texts(content, config):
        first.setdefault(digest(text), text)
    return [(i, text, h) for i, (h, text) in enumerate(first.items())]


def chunk_documents(documents: DataFrame, config: ChunkingConfig | None = None) -> DataFrame:
    """(``document_id``, ``position``, ``content``, ``content_hash``) of all chunks of (document_id, content).

    A document is chunked where it lies, in Arrow batches, without a shuffle. Null and blank contents have no
    chunks. Other columns are ignored; repeated rows are chunked each.
    """
    config = config or ChunkingConfig()
    ship(documents.sparkSession)

    def run(batches: Iterator[Any]) -> Iterator[Any]:
        import pyarrow as pa

        for b in batches:
            rows = [(doc, *c) for doc, t in zip(b.column(0).to_pylist(), b.column(1)) if t.is_valid for c in chunk(t.as_py(), config)]
            cols = list(zip(*rows)) or [()] * 4
            kinds = [pa.string(), pa.int32(), pa.string(), pa.string()]
            yield pa.record_batch([pa.array(c, k) for c, k in zip(cols, kinds)], names=["document_id", "position", "content", "content_hash"])

    return documents.select(F.col("document_id").cast("string"), "content").mapInArrow(run, CHUNKS)
