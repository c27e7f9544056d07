"""Filling sequences of fixed capacity with texts: vector best-fit over tokens, documents and attention cost."""

from __future__ import annotations

import base64
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache
from typing import Any

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftmark.session import new_folder, ship

#: The split pattern of the public byte-level vocabularies.
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
PACKED = "sequence_id long, slot int, doc_id long, piece_no int, token_start long, n_tokens int"


@dataclass(frozen=True)
class PackConfig:
    """Capacities of a sequence, and how much each counts when a sequence is chosen.

    ``attention`` bounds the sum of squared piece lengths; by default it admits one piece of full length and so
    binds only where ``tokens`` does. With less a piece that exceeds it by itself gets a sequence of its own.
    ``rule`` is ``norm`` (least weighted residual after placing) or ``dot`` (greatest weighted product of
    the piece's needs and the sequence's residual).
    """

    tokens: int = 2048
    documents: int = 64
    attention: int = 2048 * 2048
    weights: tuple[float, float, float] = (1.0, 0.05, 0.1)
    rule: str = "norm"
    #: Pieces that one task packs together.
    group_rows: int = 20_000

    def __post_init__(self) -> None:
        if min(self.tokens, self.documents, self.group_rows, self.attention) < 1:
            raise ValueError("capacities must be positive")
        if self.rule not in ("norm", "dot"):
            raise ValueError("rule must be norm or dot")


@cache
def _encoding(vocabulary: str) -> Any:
    import tiktoken

    with open(vocabulary, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("driftmark", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def count_tokens(texts: DataFrame, vocabulary: str) -> DataFrame:
    """(``doc_id``, ``n_tokens``, ``salt``) of every text; a null text has 0 tokens.

    The whole text is encoded where it lies. ``salt`` numbers the rows, so that it tells equal ids apart.
    """

    ship(texts.sparkSession)

    def count(batches: Iterator[Any]) -> Iterator[Any]:
        import pyarrow as pa

        encoding = _encoding(vocabulary)
        for b in batches:
            sizes = [len(encoding.encode_to_numpy(t.as_py(), disallowed_special=())) if t.is_valid else 0 for t in b.column(1)]
            yield pa.record_batch([b.column(0), pa.array(sizes, pa.int64()), b.column(2)], names=["doc_id", "n_tokens", "salt"])

    return texts.select(F.col("doc_id").cast("long"), "text", F.monotonically_increasing_id()).mapInArrow(count, "doc_id long, n_tokens long, salt long")


def best_fit(sizes: np.ndarray, config: PackConfig) -> np.ndarray:
    """The sequence (0, 1, ...) of each piece, pieces taken from the longest to the shortest.

    Every piece goes to the open sequence that satisfies all three constraints and is best by the rule, the
    oldest of equals, or to a new one. Sequences without room for the shortest piece are closed.
    """
    order = np.argsort(-sizes, kind="stable")
    out = np.empty(len(sizes), dtype=np.int64)
    cap = np.array([config.tokens, config.documents, config.attention], dtype=np.float64)
    weights = np.array(config.weights) / cap
    left = np.empty((1024, 3))
    names = np.empty(1024, dtype=np.int64)
    n_open = n_all = 0
    least = int(sizes.min()) if len(sizes) else 0
    for at, i in enumerate(order):
        size = float(sizes[i])
        need = np.array([size, 1.0, size * size])
        own = left[:n_open]
        fits = (own >= need).all(axis=1) if n_open else np.zeros(0, bool)
        if fits.any():
            if config.rule == "norm":
                score = np.where(fits, ((own - need) * weights) @ np.ones(3), np.inf)
                j = int(np.argmin(score))
            else:
                score = np.where(fits, (own / cap * need / cap) @ np.array(config.weights), -np.inf)
                j = int(np.argmax(score))
        else:
            if n_open == len(left):
                left, names = np.concatenate([left, np.empty_like(left)]), np.concatenate([names, np.empty_like(names)])
            j, n_open, n_all = n_open, n_open + 1, n_all + 1
            left[j], names[j] = cap, n_all - 1
        left[j] -= need
        out[i] = names[j]
        if left[j, 0] < least or left[j, 1] < 1 or left[j, 2] < least * least:
            left[j], names[j] = left[n_open - 1], names[n_open - 1]
            n_open -= 1
        if at % 4096 == 4095:
            keep = (left[:n_open, 0] >= least) & (left[:n_open, 1] >= 1) & (left[:n_open, 2] >= least * least)
            k = int(keep.sum())
            left[:k], names[:k], n_open = left[:n_open][keep], names[:n_open][keep], k
    return out


def pack(texts: DataFrame, vocabulary: str, config: PackConfig | None = None) -> DataFrame:
    """Which text lies in which sequence: (``sequence_id``, ``slot``, ``doc_id``, ``piece_no``,
    ``token_start``, ``n_tokens``).

    A text longer than the capacity is cut into full pieces and a rest, any other stays whole. Token counts
    are written to the shared folder once; then pieces are dealt by hash into groups of about ``group_rows``
    and each group is packed in one task, so no task grows with the data, and a group loses at most part of
    a sequence at its end. Only ids and counts are shuffled. Repeated rows and ids are packed each. Null and
    blank texts take a slot of their 0 or more tokens. An empty table gives no rows; other columns are ignored.
    """
    config = config or PackConfig()
    spark, root = texts.sparkSession, new_folder(texts.sparkSession, "tokens")
    count_tokens(texts, vocabulary).write.parquet(root)
    counts = spark.read.schema("doc_id long, n_tokens long, salt long").parquet(root)
    groups = max(1, -(-counts.count() // config.group_rows))
    full = config.tokens

    def pack_group(key: tuple[Any, ...], table: Any) -> Any:
        import pyarrow as pa

        table = table.sort_by([("doc_id", "ascending"), ("n_tokens", "descending"), ("salt", "ascending")])
        doc, total = table.column("doc_id"), table.column("n_tokens").to_numpy()
        whole = np.where(total > full, total // full, 0)
        rest = total - whole * full
        has_rest = (rest > 0) | (whole == 0)
        at = np.flatnonzero(has_rest)
        where = best_fit(rest[at], config)
        used = int(where.max()) + 1 if len(where) else 0
        rows = np.repeat(np.arange(len(total)), whole)
        piece = np.arange(len(rows)) - np.repeat(np.cumsum(whole) - whole, whole)
        sequence = np.concatenate([where, used + np.arange(len(rows))])
        source, number = np.concatenate([at, rows]), np.concatenate([whole[at], piece])
        length = np.concatenate([rest[at], np.full(len(rows), full)])
        order = np.lexsort((number, source, -length, sequence))
        sequence, source, number, length = sequence[order], source[order], number[order], length[order]
        first = np.flatnonzero(np.r_[True, sequence[1:] != sequence[:-1]]) if len(sequence) else np.zeros(0, np.int64)
        slot = np.arange(len(sequence)) - np.repeat(first, np.diff(np.r_[first, len(sequence)]))
        base = int(key[0].as_py()) << 32
        return pa.table({"sequence_id": pa.array(base + sequence, pa.int64()), "slot": pa.array(slot, pa.int32()), "doc_id": doc.take(pa.array(source)), "piece_no": pa.array(number, pa.int32()), "token_start": pa.array(number * full, pa.int64()), "n_tokens": pa.array(length, pa.int32())})

    dealt = counts.withColumn("part", F.pmod(F.xxhash64("doc_id", "salt"), F.lit(groups)))
    # A number of partitions of its own: the rows are few bytes, so AQE would merge all groups into one task.
    spread = dealt.repartition(min(2 * groups, 20_000), "part")
    return spread.groupBy("part").applyInArrow(pack_group, PACKED)
