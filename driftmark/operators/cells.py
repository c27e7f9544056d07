"""An index of vectors by cells, for searches that shall not score every vector.

Anchors are vectors of a sample; a vector lies in the cell of its nearest anchor, and each cell knows the widest
angle at which it holds one. A search visits cells from the nearest anchor on. By the triangle inequality no vector
of a cell is nearer to the query than the angle to the anchor less that width, so it ends once no cell that is left
can hold anything better than the k-th best: then the result is exact. ``slack`` ends it earlier.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence
from typing import Any

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from driftmark.functions.vectors import cosine_similarity, literal
from driftmark.session import fresh_name, ship
from driftmark.sources.files import Folder

#: At most so many cells there are: what is known of them is read to the driver.
MOST_CELLS = 16_384


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.linalg.norm(x, axis=-1, keepdims=True), 1e-30)


class CellIndex:
    """``root/cells`` holds the rows by cell, ``root/index.json`` the anchors and widths."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root, self.folder = spark, root.rstrip("/"), Folder(spark, root)
        held = self.folder.load("index.json")
        self.anchors = np.array(held["anchors"], dtype=np.float64).reshape(len(held["anchors"]), -1 if held["anchors"] else 0)
        self.cells, self.width = np.array(held["cells"], dtype=np.int64), np.array(held["widths"])
        self.schema, self.extra = T.StructType.fromJson(held["schema"]), held["extra"]

    @staticmethod
    def build(rows: DataFrame, root: str, vector: str = "embedding", cells: int | None = None, **extra: Any) -> CellIndex:
        """Index ``rows`` by their column ``vector``; other columns come along.

        Vectors that are null, zero, not finite or of another width than most of the sample are left out. Every
        other row is indexed; only the anchors come from a sample, of about four rows per cell. A cell is spread
        over several files, so a vector that a third of all rows share is no single task.
        """
        spark = rows.sparkSession
        ship(spark)
        n = rows.count()
        cells = max(1, min(cells or math.isqrt(max(n, 1)), MOST_CELLS))
        share = min(1.0, 4.0 * cells / max(n, 1))
        drawn = F.pmod(F.xxhash64(F.to_json(F.col(f"`{vector}`"))), F.lit(1_000_003)) < F.lit(int(share * 1_000_003) + 1)
        # Equal vectors are drawn alike, so they are taken once.
        taken = rows.filter(drawn & F.col(f"`{vector}`").isNotNull()).select(F.col(f"`{vector}`").cast("array<double>").alias("v")).distinct().limit(8 * cells).collect()
        sample = [r["v"] for r in taken if all(x is not None and math.isfinite(x) for x in r["v"]) and any(r["v"])]
        widths = [len(v) for v in sample]
        wide = max(set(widths), key=widths.count) if widths else 0
        anchors = _unit(np.array([v for v in sample if len(v) == wide][:cells], dtype=np.float64).reshape(-1, max(wide, 1)))
        cell, angle = fresh_name(rows, "cell"), fresh_name(rows, "angle")
        kept = [f.name for f in rows.schema.fields]
        at, schema = kept.index(vector), T.StructType([*rows.schema.fields, T.StructField(cell, T.IntegerType()), T.StructField(angle, T.DoubleType())])

        def assign(batches: Iterator[Any]) -> Iterator[Any]:
            import pyarrow as pa

            for b in batches:
                x = b.column(at).to_pylist()
                good = [i for i, v in enumerate(x) if v is not None and len(v) == wide and all(e is not None and math.isfinite(e) for e in v) and any(v)]
                if good:
                    cosine = np.clip(_unit(np.array([x[i] for i in good], dtype=np.float64)) @ anchors.T, -1, 1)
                    nearest = cosine.argmax(axis=1)
                    yield pa.record_batch([*b.take(pa.array(good)).columns, pa.array(nearest, pa.int32()), pa.array(np.arccos(cosine.max(axis=1)), pa.float64())], names=[*kept, cell, angle])

        folder = Folder(spark, root)
        if len(anchors):
            placed = rows.mapInArrow(assign, schema).withColumnRenamed(cell, "dm_cell").withColumnRenamed(angle, "dm_angle")
            placed.repartition(min(cells, 2000), "dm_cell", F.pmod(F.xxhash64(*[F.to_json(F.struct(c)) for c in kept]), F.lit(8))).write.partitionBy("dm_cell").parquet(f"{root}/cells")
            known = spark.read.parquet(f"{root}/cells").groupBy("dm_cell").agg(F.max("dm_angle").alias("w")).orderBy("dm_cell").collect()  # a row per cell
        else:
            known = []
        folder.create("index.json", {"anchors": anchors[[r["dm_cell"] for r in known]].tolist() if known else [], "cells": [r["dm_cell"] for r in known], "widths": [r["w"] for r in known], "schema": rows.schema.jsonValue(), "extra": {"vector": vector, **extra}})
        return CellIndex(spark, root)

    def search(self, vector: Sequence[float], k: int, ties: Sequence[str], accept: Callable[[list[Any]], list[Any]] | None = None, slack: float = 0.0, first: int = 4) -> tuple[list[Any], int]:
        """The ``k`` best rows with ``score``, best first, ties by the columns ``ties``; and how many cells were read.

        ``accept`` is given candidates, best first, and returns those that count: where rows of the index are out
        of date, the search goes on until k count. Cells are read in rounds of growing size; each round returns a
        few candidates per task and no vectors.
        """
        if not len(self.cells):
            return [], 0
        query = _unit(np.array(vector, dtype=np.float64))
        angle = np.arccos(np.clip(self.anchors @ query, -1, 1))
        least = np.maximum(angle - self.width, 0)  # no vector of the cell is nearer
        order, found, read = np.argsort(angle), [], 0
        rows = self.spark.read.schema(T.StructType([*self.schema.fields, T.StructField("dm_angle", T.DoubleType()), T.StructField("dm_cell", T.IntegerType())])).parquet(f"{self.root}/cells")
        name = self.extra["vector"]
        while read < len(order):
            limit = math.acos(max(-1.0, min(1.0, found[k - 1]["score"]))) - slack if len(found) >= k else math.inf
            left = [i for i in order[read:] if least[i] <= limit + 1e-9]
            if not left:
                break
            order = np.concatenate([order[:read], left]).astype(np.int64)
            batch = order[read:read + max(first, 2 * read)]
            read += len(batch)
            scored = rows.filter(F.col("dm_cell").isin([int(self.cells[i]) for i in batch])).withColumn("score", cosine_similarity(F.col(f"`{name}`"), literal(list(vector))))
            want = 4 * k
            while True:
                top = scored.drop(name, "dm_angle", "dm_cell").orderBy(F.col("score").desc(), *ties).limit(want).collect()
                good = accept(top) if accept is not None else top
                # Fewer may count than were asked for, if more of them are out of date than expected.
                if len(good) >= k or len(top) < want:
                    break
                want *= 4
            found = sorted([*found, *good], key=lambda r: (-r["score"], *[r[t] for t in ties]))[:k]
        return found, read
