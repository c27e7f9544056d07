"""Splitting oversized paragraphs at natural boundaries, by dynamic programming over boundary positions."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass
from typing import Any

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftmark.session import ship

_BLANK_LINE = re.compile(r"\n\s*\n")
#: Boundaries from the best kind to the worst, with what a cut there costs.
_KINDS = (
    (re.compile(r"[.!?…]+[\"'”’»)\]]*\s+|[。！？]+[」』）]*|\n\s*"), 0.0),
    (re.compile(r"[,;:]\s+|[、，；：]|\s[–—-]\s"), 6.0),
    (re.compile(r"\s+"), 12.0),
)
#: A cut between any two characters, and how far apart such cuts are tried in text without any boundary.
_ANYWHERE, _UNBROKEN, _STEP = 60.0, 80, 10
#: What a cut costs per character of the specified overlap that the next piece lacks, and how much the kind of
#: boundary where that begins counts beside the kind where the piece before ends.
_SHORT, _BEGIN = 0.05, 0.25
SCHEMA = "document_id string, paragraph_no int, piece_no int, position int, start int, end int, text string"


@dataclass(frozen=True)
class SplitConfig:
    max_chars: int = 1000
    overlap: int = 100

    def __post_init__(self) -> None:
        if not 0 <= self.overlap < self.max_chars:
            raise ValueError("require 0 <= overlap < max_chars")


def paragraphs(content: str) -> list[str]:
    """CR LF is LF; split at blank lines, strip white space of any Unicode kind, drop empty ones."""
    return [p for p in map(str.strip, _BLANK_LINE.split(content.replace("\r\n", "\n"))) if p]


def _joined(text: str, i: int) -> bool:
    """Whether the characters around ``i`` belong together: marks, joiners, variation selectors, modifiers."""
    c = text[i]
    return unicodedata.combining(c) != 0 or c in "‍︎️" or text[i - 1] == "‍" or "\U0001f3fb" <= c <= "\U0001f3ff" or unicodedata.category(c) in ("Mn", "Me", "Mc")


def boundaries(text: str) -> tuple[np.ndarray, np.ndarray]:
    """All positions where ``text`` may be cut, ascending, and what each cut costs: every sentence, clause and word
    boundary, and where there is none for long, places between characters that do not belong together."""
    cost: dict[int, float] = {}
    for pattern, price in _KINDS:
        for m in pattern.finditer(text):
            cost.setdefault(m.end(), price)
    cost.pop(len(text), None)
    marks = [0, *sorted(cost), len(text)]
    for a, b in zip(marks, marks[1:]):
        if b - a > _UNBROKEN:
            for i in range(a + _STEP, b, _STEP):
                while i < b and _joined(text, i):
                    i += 1
                if i < b:
                    cost.setdefault(i, _ANYWHERE)
    at = sorted(cost)
    return np.array(at, dtype=np.int64), np.array([cost[i] for i in at])


def _begins(text: str, cut: np.ndarray, price: np.ndarray, config: SplitConfig) -> tuple[np.ndarray, np.ndarray]:
    """Where the piece after each cut begins and what that costs: the boundary before the cut with the least sum of
    its price and of what it lacks of the specified overlap, or, where none lies within the overlap, the first
    place there that parts no characters that belong together. The next cut stays within reach."""
    if not len(cut) or not config.overlap:
        return cut, np.zeros(len(cut))
    low = np.maximum(np.maximum(cut - config.overlap, np.append(cut[1:], len(text)) - config.max_chars), 1)
    begin, least = cut.copy(), np.full(len(cut), _BEGIN * _ANYWHERE + _SHORT * config.overlap)
    for back in range(1, len(cut)):
        spot = cut[:-back]
        within = spot >= low[back:]
        if not within.any():
            break
        total = np.where(within, _BEGIN * price[:-back] + _SHORT * (config.overlap - (cut[back:] - spot)), np.inf)
        better = total < least[back:]
        least[back:][better], begin[back:][better] = total[better], spot[better]
    for i in np.flatnonzero(begin == cut):
        at = int(low[i])
        while at < cut[i] and _joined(text, at):
            at += 1
        begin[i] = min(at, int(cut[i]))
    return begin, least


def split_paragraph(text: str, config: SplitConfig) -> list[tuple[int, int]]:
    """(start, end) of the pieces of one paragraph.

    A piece holds at most ``max_chars`` code points, and consecutive pieces share up to ``overlap`` of them, as
    near to it as a good boundary allows. Of all boundaries those are chosen that make the sum of the costs of the
    cuts, of the beginnings and of the squared deviation of the pieces from equal sizes least. Every character
    lies in a piece; pieces are not stripped.
    """
    n = len(text)
    if n <= config.max_chars:
        return [(0, n)]
    cut, price = boundaries(text)
    begin, extra = _begins(text, cut, price, config)
    ends, costs = np.append(cut, n), np.append(price + extra, 0.0)
    starts = np.append(0, begin)
    least = max(2, -(-(n - config.overlap) // (config.max_chars - config.overlap)))
    ideal = (n + (least - 1) * config.overlap) / least
    best = np.full(len(ends) + 1, np.inf)
    best[0] = 0.0
    back = np.zeros(len(ends) + 1, dtype=np.int64)
    # A piece that ends at a place begins at most max_chars before it, so its cut lies at most so far before it.
    first = np.searchsorted(np.append(0, cut), ends - config.max_chars)
    size_of, shift = starts / ideal, ends / ideal - 1.0
    longest = config.max_chars / ideal - 1.0 + 1e-9
    for j in range(1, len(ends) + 1):
        i = first[j - 1]
        over = shift[j - 1] - size_of[i:j]
        total = best[i:j] + 40.0 * over * over
        total[over > longest] = np.inf
        k = int(total.argmin()) if i < j else -1
        if k >= 0:
            best[j], back[j] = total[k] + costs[j - 1], i + k
    if not np.isfinite(best[-1]):  # a cluster longer than a piece: cut it at the limit
        step = config.max_chars - config.overlap
        return [(a, min(a + config.max_chars, n)) for a in range(0, n - config.overlap, step)]
    pieces: list[tuple[int, int]] = []
    j = len(ends)
    while j > 0:
        pieces.append((int(starts[back[j]]), int(ends[j - 1])))
        j = int(back[j])
    return pieces[::-1]


def current_documents(rows: DataFrame, key: str = "id", version: str = "version", deleted: str = "deleted", content: str = "content") -> DataFrame:
    """(``document_id``, ``content``) of the rows of highest version that are not deleted and have content.

    ``max_by`` keeps one row per document and task before the shuffle. Ties fall to the deleted row, then to
    the content that sorts last. Rows without key or version are no documents.
    """
    r = rows.select(F.col(f"`{key}`").alias("document_id"), F.col(f"`{version}`").alias("v"), F.coalesce(F.col(f"`{deleted}`"), F.lit(False)).alias("d"), F.col(f"`{content}`").alias("content")).filter("document_id IS NOT NULL AND v IS NOT NULL")
    last = r.groupBy("document_id").agg(F.max(F.struct("v", "d", "content")).alias("m"))
    return last.filter("NOT m.d AND m.content IS NOT NULL").select("document_id", F.col("m.content").alias("content"))


def split_documents(documents: DataFrame, config: SplitConfig | None = None) -> DataFrame:
    """All paragraphs of ``documents`` (document_id, content) as pieces of at most ``max_chars`` characters.

    ``position`` counts the pieces of a document, ``piece_no`` those of a paragraph, ``start`` and ``end`` are
    offsets in the stripped paragraph and ``text`` is what lies between them. One pass without a shuffle: a
    document is cut where it lies. Null and blank contents give no rows; repeated rows are cut as they come;
    other columns are ignored. Very long paragraphs take time in proportion to their length.
    """
    config = config or SplitConfig()
    ship(documents.sparkSession)

    def split(batches: Iterator[Any]) -> Iterator[Any]:
        import pyarrow as pa

        kinds = [pa.string(), *[pa.int32()] * 5, pa.string()]
        names = ["document_id", "paragraph_no", "piece_no", "position", "start", "end", "text"]
        for batch in batches:
            out: list[tuple[Any, ...]] = []
            for doc, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                if not content.is_valid:
                    continue
                position = 0
                for p, text in enumerate(paragraphs(content.as_py())):
                    for k, (a, b) in enumerate(split_paragraph(text, config)):
                        out.append((doc, p, k, position, a, b, text[a:b]))
                        position += 1
            cols = list(zip(*out)) or [()] * 7
            yield pa.record_batch([pa.array(c, k) for c, k in zip(cols, kinds)], names=names)

    return documents.select(F.col("document_id").cast("string"), "content").mapInArrow(split, SCHEMA)
