"""Evaluation texts leaking into training text.

One Aho-Corasick automaton over the normalised test questions and answers scans each text once; what it finds
is extended word by word to the full shared run, and offsets are mapped back to the original text.
"""

from __future__ import annotations

import re
import unicodedata
import uuid
from collections.abc import Iterator
from functools import cache
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftmark.session import ship

INLINE = "a|abbr|b|big|cite|code|del|em|font|i|ins|kbd|mark|q|s|samp|small|span|strike|strong|sub|sup|tt|u|var"
_INLINE_TAG = re.compile(rf"</?(?:{INLINE})(?:\s[^<>]*)?/?>", re.I)
_TAG = re.compile(r"</?[A-Za-z][A-Za-z0-9:-]*(?:\s[^<>]*)?/?>|<!--.*?-->", re.S)
SCHEMA = "item_id long, doc_id long, n_words int, start long, end long, answer_seen boolean"


@cache
def _counts(c: str) -> str:
    """What stands for a character: itself, nothing (marks over letters, invisible ones), or a space."""
    if c.isalnum():
        return c
    return "" if c == "\xad" or unicodedata.category(c) in ("Mn", "Me", "Cf") else " "


def plain_words(text: str) -> str:
    """The words of ``text`` (runs of letters and digits), each between single spaces, without what does not
    count: case, accents however encoded, punctuation, white space, markup tags, invisible characters."""
    if "<" in text:
        text = _TAG.sub(" ", _INLINE_TAG.sub("", text))
    if not text.isascii():
        text = unicodedata.normalize("NFKD", text)
    text = text.casefold()
    for c in set(text):  # a few dozen replacements, each at the speed of memchr
        if (by := _counts(c)) != c:
            text = text.replace(c, by)
    words = " ".join(text.split())
    return f" {words} " if words else " "


def word_spans(text: str) -> list[tuple[str, int, int]]:
    """The same words with their offsets in ``text``; slower, for texts with a leak only."""
    shown, at = text, list(range(len(text)))
    if "<" in text:
        cuts = [m.span() for m in _INLINE_TAG.finditer(text)]
        for a, b in reversed(cuts):
            shown = shown[:a] + shown[b:]
            del at[a:b]
        for a, b in reversed([m.span() for m in _TAG.finditer(shown)]):
            shown = shown[:a] + " " + shown[b:]
            at[a:b] = [at[a]]
    out: list[tuple[str, int, int]] = []
    word, start, end = "", 0, 0
    for i, c in zip(at, shown):
        for f in "".join(map(_counts, unicodedata.normalize("NFKD", c).casefold())):
            if f != " ":
                start, word, end = (i, f, i + 1) if not word else (start, word + f, i + 1)
            elif word:
                out.append((word, start, end))
                word = ""
    if word:
        out.append((word, start, end))
    return out


class Scanner:
    """The automaton over all items. A run of ``min_words`` words holds a whole block of half as many that
    starts at a multiple of that half, so one pattern per block finds every run."""

    def __init__(self, items: list[tuple[int, str | None, str | None]], min_words: int) -> None:
        import ahocorasick

        self.min_words, self.block = min_words, (min_words + 1) // 2
        self.items: dict[int, list[str]] = {}
        self.answers: dict[int, set[str]] = {}
        at: dict[str, list[tuple[int, int]]] = {}
        answers: dict[str, set[int]] = {}
        for item, text, answer in items:
            words = plain_words(text or "").split()
            self.items[item] = words
            for k in range(0, len(words) - self.block + 1, self.block):
                at.setdefault(" " + " ".join(words[k:k + self.block]) + " ", []).append((item, k))
            if (a := plain_words(answer or "")) != " ":
                answers.setdefault(a, set()).add(item)
        self.automaton = ahocorasick.Automaton()
        for pattern in at.keys() | answers.keys():
            self.automaton.add_word(pattern, (at.get(pattern, []), answers.get(pattern, set())))
        self.empty = len(self.automaton) == 0
        if not self.empty:
            self.automaton.make_automaton()

    def scan(self, text: str) -> list[tuple[int, int, int, int, bool]]:
        """(item, words in the longest run, its start and end in ``text``, whether the answer occurs too)."""
        if self.empty:
            return []
        joined = plain_words(text)
        hits: list[tuple[int, list[tuple[int, int]]]] = []
        seen: set[int] = set()
        for end, (blocks, answers) in self.automaton.iter(joined):
            if blocks:
                hits.append((end, blocks))
            if answers:
                seen |= answers
        if not hits:
            return []
        words = joined.split()
        found: dict[int, tuple[int, int]] = {}
        counted, upto = 0, 0
        reached: dict[tuple[int, int], int] = {}  # by diagonal: where its last run ended
        for end, blocks in hits:
            counted += joined.count(" ", upto, end)  # spaces before ``end``: the words that ended there
            upto = end
            first = counted - self.block
            for item, k in blocks:
                if first + self.block <= reached.get((item, first - k), 0):
                    continue
                own, a, b = self.items[item], first, first + self.block
                i, j = k, k + self.block
                while a > 0 and i > 0 and words[a - 1] == own[i - 1]:
                    a, i = a - 1, i - 1
                while b < len(words) and j < len(own) and words[b] == own[j]:
                    b, j = b + 1, j + 1
                reached[item, first - k] = b
                if b - a >= self.min_words and b - a > found.get(item, (0, 0))[0]:
                    found[item] = (b - a, a)
        if not found:
            return []
        spans = word_spans(text)
        return [(item, n, spans[a][1], spans[a + n - 1][2], item in seen) for item, (n, a) in found.items()]


#: The scanner that this worker built last, by the pass it serves: tasks of one pass share it.
_HELD: dict[str, Scanner] = {}


def _scanner(name: str, items: Any, min_words: int) -> Scanner:
    if name not in _HELD:
        _HELD.clear()
        _HELD[name] = Scanner(items.value, min_words)
    return _HELD[name]


def find_leaks(texts: DataFrame, items: DataFrame, min_words: int = 13, items_per_pass: int = 50_000, bytes_per_pass: int = 2**25) -> DataFrame:
    """Pairs (``item_id``, ``doc_id``) that share at least ``min_words`` words in a row, with the length of the
    longest shared run, its offsets in the original text and whether the item's answer occurs in the text.

    ``texts`` has doc_id and text, ``items`` item_id, item_text and answer; other columns are ignored. The
    items of one pass are broadcast: about ``items_per_pass`` of them and ``bytes_per_pass`` of their text, larger
    sets take several passes over the text, by hash of the id. The text is scanned where it lies; nothing of it is shuffled, and only leaks
    leave the scan. Null and blank texts and items share nothing. Repeated items and documents give a pair
    once for each copy of the document; items with the same id and different texts count as one by their
    longest run. Runs do not reach across documents.
    """
    spark = texts.sparkSession
    ship(spark)
    wanted = items.select(F.col("item_id").cast("long"), "item_text", "answer").filter("item_id IS NOT NULL AND item_text IS NOT NULL").distinct()
    size = wanted.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length("item_text") + F.coalesce(F.octet_length("answer"), F.lit(0))), F.lit(0))).collect()[0]
    passes = max(1, -(-size[0] // items_per_pass), -(-size[1] // bytes_per_pass))
    out: DataFrame | None = None
    for n in range(passes):
        part = wanted if passes == 1 else wanted.filter(F.pmod(F.xxhash64("item_id"), F.lit(passes)) == n)
        shared = spark.sparkContext.broadcast([(r[0], r[1], r[2]) for r in part.collect()])

        def scan(batches: Iterator[Any], shared: Any = shared, name: str = uuid.uuid4().hex) -> Iterator[Any]:
            import pyarrow as pa

            scanner = _scanner(name, shared, min_words)
            for batch in batches:
                rows: list[tuple[Any, ...]] = []
                for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                    if text.is_valid:
                        rows += [(item, doc, *rest) for item, *rest in scanner.scan(text.as_py())]
                names = ["item_id", "doc_id", "n_words", "start", "end", "answer_seen"]
                kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.bool_()]
                cols = list(zip(*rows)) or [()] * 6
                yield pa.record_batch([pa.array(c, k) for c, k in zip(cols, kinds)], names=names)

        found = texts.select(F.col("doc_id").cast("long"), "text").mapInArrow(scan, SCHEMA)
        out = found if out is None else out.unionByName(found)
    assert out is not None
    return out
