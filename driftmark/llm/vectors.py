"""Most similar vectors for every vector: low-dimensional 2-stable projections indexed by a kd-tree.

Vectors are scaled to unit length, so the order by Euclidean distance is that by cosine, and projected by a
Gaussian matrix to ``m`` dimensions. For a pair at distance d the squared projected distance over d squared
follows a chi-square distribution with m degrees of freedom. A search visits projected neighbours leaf by leaf,
verifies them with the full vectors, and stops where a chi-square test says that nothing that is left can be
nearer than the k-th best verified so far with probability ``p``. So a true neighbour is missed with probability
1 - p at most. A query first searches the leaf of the upper kd-tree that it lies in, and with the k-th best found
there only those other leaves that pass the test.
"""

from __future__ import annotations

import copy
import math
from collections.abc import Iterator
from dataclasses import dataclass
from typing import Any

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from driftmark.session import new_folder, ship

FOUND = "query long, neighbour long, cosine float"
#: Over how many tasks the members of a group of equal vectors are spread.
SALTS = 32


@dataclass(frozen=True)
class SearchConfig:
    k: int = 5
    width: int = 64
    m: int = 12
    p: float = 0.95
    #: If given, neighbours below this cosine do not count, so the search starts as if k of it had been found.
    min_cosine: float | None = None
    #: Rows of a part of the index, a leaf of the upper kd-tree: what one task holds of either side.
    part_rows: int = 16_384
    leaf_rows: int = 512
    #: At most so many parts there are, whose boxes (100 bytes each) are known to every task; from a thousand
    #: million rows on parts hold more rows instead.
    most_parts: int = 65_536
    #: The splits of the upper kd-tree are fitted on a sample of about so many rows per part, 48 bytes each.
    sample_per_part: int = 32
    seed: int = 20_240

    def __post_init__(self) -> None:
        if self.m % 2 or not 0 < self.m or not 0 < self.p < 1 or self.k < 1:
            raise ValueError("require an even m > 0, 0 < p < 1 and k >= 1")


def chi_square_cdf(x: float, m: int) -> float:
    """Of m degrees of freedom, m even."""
    if x <= 0:
        return 0.0
    term = total = 1.0
    for i in range(1, m // 2):
        term *= x / 2 / i
        total += term
    return 1.0 - math.exp(-x / 2) * total


def chi_square_quantile(p: float, m: int) -> float:
    low, high = 0.0, 4.0 * m + 200.0
    for _ in range(200):
        mid = (low + high) / 2
        low, high = (mid, high) if chi_square_cdf(mid, m) < p else (low, mid)
    return high


def projection(config: SearchConfig) -> np.ndarray:
    """The 2-stable (Gaussian) matrix, the same on every executor."""
    return np.random.default_rng(config.seed).standard_normal((config.width, config.m)).astype(np.float32)


def usable(rows: DataFrame, id_column: str, vector_column: str, width: int) -> DataFrame:
    """(``id``, ``v``) with one row per id whose vector has the width, no null, and a finite length above 0.

    Of several usable vectors with one id the least counts. Null ids are left out.
    """
    r = rows.select(F.col(f"`{id_column}`").cast("long").alias("id"), F.col(f"`{vector_column}`").cast("array<float>").alias("v"))
    square = F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x)
    sound = r.filter(F.col("id").isNotNull() & (F.size("v") == width)).filter(square.isNotNull() & (square > 0) & (square < F.lit(float("inf"))))
    return sound.groupBy("id").agg(F.min("v").alias("v"))


def _unit(column: Any, width: int) -> np.ndarray:
    x = np.asarray(column.flatten()).reshape(-1, width).astype(np.float64)
    return (x / np.linalg.norm(x, axis=1)[:, None]).astype(np.float32)


def _as_binary(x: np.ndarray) -> Any:
    import pyarrow as pa

    size = x.shape[1] * 4
    offsets = pa.py_buffer(np.arange(0, (len(x) + 1) * size, size, dtype=np.int32).tobytes())
    return pa.Array.from_buffers(pa.binary(), len(x), [None, offsets, pa.py_buffer(np.ascontiguousarray(x).tobytes())])


def unit_rows(rows: DataFrame, config: SearchConfig) -> DataFrame:
    """(``id``, ``u``): unit vectors as the bytes of 32-bit floats."""
    width = config.width

    def scale(batches: Iterator[Any]) -> Iterator[Any]:
        import pyarrow as pa

        for b in batches:
            if b.num_rows:
                yield pa.record_batch([b.column(0), _as_binary(_unit(b.column(1), width))], names=["id", "u"])

    return rows.mapInArrow(scale, "id long, u binary")


@dataclass(frozen=True)
class Splits:
    """The upper kd-tree: node n is split at ``at[n]`` in dimension ``dim[n]``; its children are 2n+1, 2n+2."""

    dim: np.ndarray
    at: np.ndarray
    depth: int

    @staticmethod
    def fit(points: np.ndarray, depth: int) -> Splits:
        dim, at = np.zeros(2**depth - 1, dtype=np.int64), np.zeros(2**depth - 1, dtype=np.float32)
        held = {0: np.arange(len(points))}
        for n in range(2**depth - 1):
            own = held.pop(n)
            if len(own):
                x = points[own]
                dim[n] = int(np.argmax(x.var(axis=0)))
                at[n] = np.median(x[:, dim[n]])
            right = points[own, dim[n]] > at[n]
            held[2 * n + 1], held[2 * n + 2] = own[~right], own[right]
        return Splits(dim, at, depth)

    def leaf(self, points: np.ndarray) -> np.ndarray:
        node = np.zeros(len(points), dtype=np.int64)
        for _ in range(self.depth):
            right = points[np.arange(len(points)), self.dim[node]] > self.at[node]
            node = 2 * node + 1 + right
        return node - (2**self.depth - 1)


def _order_leaves(points: np.ndarray, leaf_rows: int) -> tuple[np.ndarray, list[int]]:
    """A local kd-tree as an order of the rows and the bounds of its leaves."""
    order, bounds, stack = np.arange(len(points)), [0], [(0, len(points))]
    while stack:
        a, b = stack.pop()
        if b - a <= leaf_rows:
            bounds.append(b)
            continue
        own = order[a:b]
        x = points[own]
        half = (b - a) // 2
        order[a:b] = own[np.argpartition(x[:, int(np.argmax(x.max(axis=0) - x.min(axis=0)))], half)]
        stack += [(a + half, b), (a, a + half)]
    return order, bounds


class Part:
    """Rows of a part with a local kd-tree over their projections, and the k best found for each so far."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, config: SearchConfig, matrix: np.ndarray) -> None:
        projected = vectors @ matrix
        order, self.bounds = _order_leaves(projected, config.leaf_rows)
        self.ids, self.v, self.x = ids[order], vectors[order], projected[order]
        self.half = (self.x.astype(np.float64) ** 2).sum(axis=1).astype(np.float32) / 2
        self.spans = [(a, b) for a, b in zip(self.bounds, self.bounds[1:]) if a < b]
        self.low = np.array([self.x[a:b].min(axis=0) for a, b in self.spans]).reshape(len(self.spans), config.m)
        self.high = np.array([self.x[a:b].max(axis=0) for a, b in self.spans]).reshape(len(self.spans), config.m)
        self.k, self.scale = config.k, chi_square_quantile(config.p, config.m)
        least = -2.0 if config.min_cosine is None else config.min_cosine - 1e-7
        self.best = np.full((len(ids), config.k), least, dtype=np.float32)
        self.who = np.full((len(ids), config.k), -1, dtype=np.int64)

    def reach(self, a: int, b: int) -> np.ndarray:
        """The squared projected distance beyond which nothing can be nearer than the k-th best of rows a to b."""
        return np.maximum(self.scale * 2 * (1 - self.best[a:b, -1]), 0)

    def know(self, query: np.ndarray, cosine: np.ndarray) -> None:
        """Start from cosines found before (their neighbours are known elsewhere)."""
        if len(query):
            order = np.argsort(self.ids)
            row = order[np.searchsorted(self.ids, query, sorter=order)]
            self.few(row, np.full(len(row), -1), cosine)

    def dense(self, rows: np.ndarray, ids: np.ndarray, cosine: np.ndarray) -> None:
        """Take the best of a matrix of cosines, a line per row and a column per id."""
        new = np.flatnonzero((cosine > self.best[rows, -1][:, None]).any(axis=1))
        if not len(new):
            return
        rows, cosine = rows[new], cosine[new]
        merged = np.hstack([self.best[rows], cosine])
        names = np.hstack([self.who[rows], np.broadcast_to(ids, cosine.shape)])
        top = np.argpartition(-merged, self.k - 1, axis=1)[:, :self.k]
        got = np.take_along_axis(merged, top, axis=1)
        place = np.argsort(-got, axis=1, kind="stable")
        self.best[rows] = np.take_along_axis(got, place, axis=1)
        self.who[rows] = np.take_along_axis(np.take_along_axis(names, top, axis=1), place, axis=1)

    def few(self, rows: np.ndarray, ids: np.ndarray, cosine: np.ndarray) -> None:
        """Take single pairs of row and id."""
        keep = cosine > self.best[rows, -1]
        rows, ids, cosine = rows[keep], ids[keep], cosine[keep]
        own = np.unique(rows)
        if not len(own):
            return
        r = np.concatenate([np.repeat(own, self.k), rows])
        c = np.concatenate([self.best[own].ravel(), cosine.astype(np.float32)])
        w = np.concatenate([self.who[own].ravel(), ids])
        r, w, c = _top(r, w, c, self.k)
        self.best[own], self.who[own] = c.reshape(-1, self.k), w.reshape(-1, self.k)

    def found(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        r, c = np.nonzero(self.who >= 0)
        return self.ids[r], self.who[r, c], self.best[r, c]


def _gap(low: np.ndarray, high: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances of the boxes ``low`` .. ``high`` to a box (or point) ``a`` .. ``b``."""
    gap = np.maximum(np.maximum(low - b, a - high), 0)
    return np.einsum("ij,ij->i", gap, gap)


def search(q: Part, t: Part, both: bool = False) -> None:
    """Find for the rows of ``q`` their nearest in ``t``, and with ``both`` the other way round, too.

    The leaves of ``t`` are visited from the nearest to a leaf of ``q`` on, until no row of that has anything left
    within its reach. Of a leaf only projected neighbours within reach are verified; where these are many, a
    product of whole matrices is cheaper than picking them.
    """
    width = t.x.shape[1]
    left, right = np.ones((len(q.ids), width + 2), np.float32), np.ones((len(t.ids), width + 2), np.float32)
    left[:, :width], right[:, :width], right[:, width + 1] = q.x, t.x, -t.half
    for qa, qb in q.spans:
        x = q.x[qa:qb]
        gaps = _gap(t.low, t.high, x.min(axis=0), x.max(axis=0))
        for j in np.argsort(gaps, kind="stable"):
            ta, tb = t.spans[j]
            if q is t and tb <= qa and both:
                continue  # seen from the other side
            reach = q.reach(qa, qb)
            if both:
                reach = np.maximum(reach, t.reach(ta, tb).max())
            if gaps[j] > reach.max():
                break
            gap = np.maximum(np.maximum(t.low[j] - x, x - t.high[j]), 0)
            active = np.einsum("ij,ij->i", gap, gap) <= reach
            if not active.any():
                continue
            # Half the reach less half the squared projected distance, as one product of matrices.
            left[qa:qb, width] = reach / 2 - q.half[qa:qb]
            own = qa + np.flatnonzero(active)
            near = left[own] @ right[ta:tb].T >= 0
            hit = np.flatnonzero(near)
            if len(hit) > near.size // 16:
                cosine = q.v[own] @ t.v[ta:tb].T
                cosine[q.ids[own][:, None] == t.ids[ta:tb][None, :]] = -3.0
                q.dense(own, t.ids[ta:tb], cosine)
                if both and not (q is t and ta == qa):
                    t.dense(np.arange(ta, tb), q.ids[own], np.ascontiguousarray(cosine.T))
            elif len(hit):
                r, c = own[hit // (tb - ta)], ta + hit % (tb - ta)
                other = q.ids[r] != t.ids[c]
                r, c = r[other], c[other]
                cosine = np.einsum("ij,ij->i", q.v[r], t.v[c])
                q.few(r, t.ids[c], cosine)
                if both and not (q is t and ta == qa):
                    t.few(c, q.ids[r], cosine)


def _top(query: np.ndarray, other: np.ndarray, cosine: np.ndarray, k: int) -> tuple[np.ndarray, ...]:
    """The k best of each query, ties by id."""
    order = np.lexsort((other, -cosine, query))
    query, other, cosine = query[order], other[order], cosine[order]
    first = np.flatnonzero(np.r_[True, query[1:] != query[:-1]]) if len(query) else np.zeros(0, np.int64)
    rank = np.arange(len(query)) - np.repeat(first, np.diff(np.r_[first, len(query)]))
    keep = rank < k
    return query[keep], other[keep], cosine[keep]


def _read(root: str, part: int, columns: list[str]) -> Any:
    """The rows of a part as one Arrow table; None where there are none."""
    import pyarrow as pa
    import pyarrow.fs as pafs
    import pyarrow.parquet as pq

    fs, base = pafs.FileSystem.from_uri(root)
    found = fs.get_file_info(pafs.FileSelector(f"{base}/part={part}", allow_not_found=True))
    files = sorted(f.path for f in found if f.base_name.endswith(".parquet"))
    return pa.concat_tables([pq.ParquetFile(fs.open_input_file(f)).read(columns=columns) for f in files]).combine_chunks() if files else None


def _floats(column: Any, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype=np.float32).reshape(-1, width)


def _load(root: str, part: int, config: SearchConfig, matrix: np.ndarray, asked: bool = False) -> Part:
    """A part of the index, or only the rows in it that are queries."""
    t = _read(root, part, ["id", "u", "asked"])
    if asked and t is not None:
        t = t.filter(t.column("asked")).combine_chunks()
    if t is None or not t.num_rows:
        return Part(np.zeros(0, np.int64), np.zeros((0, config.width), np.float32), config, matrix)
    return Part(t.column("id").to_numpy(), _floats(t.column("u"), config.width), config, matrix)


def _begin(first: str, part: int, rows: Part) -> Part:
    """The rows with what the first round found for them."""
    t = _read(first, part, ["query", "cosine"])
    if t is not None:
        rows.know(t.column("query").to_numpy(), t.column("cosine").to_numpy())
    return rows


def write_index(units: DataFrame, config: SearchConfig, n_rows: int, name: str) -> tuple[str, int]:
    """Write (``id``, ``u``, ``asked``) as parts, the leaves of the upper kd-tree, and return their folder and
    number. Every row is indexed; only the splits come from a sample of bounded size."""
    spark, root = units.sparkSession, new_folder(units.sparkSession, name)
    depth = max(0, min(math.ceil(math.log2(max(1, n_rows / (config.part_rows * 0.8)))), int(math.log2(config.most_parts))))
    matrix, m = projection(config), config.m

    def project(batches: Iterator[Any]) -> Iterator[Any]:
        import pyarrow as pa

        for b in batches:
            yield pa.record_batch([_as_binary(_floats(b.column(0), config.width) @ matrix)], names=["x"])

    splits = Splits(np.zeros(0, np.int64), np.zeros(0, np.float32), 0)
    if depth:
        every = max(1, n_rows // (config.sample_per_part * 2**depth))
        sample = units.filter(F.pmod(F.xxhash64("id", F.lit(config.seed)), F.lit(every)) == 0).select("u").mapInArrow(project, "x binary").collect()
        splits = Splits.fit(np.frombuffer(b"".join(r[0] for r in sample), dtype=np.float32).reshape(-1, m), depth)

    def route(batches: Iterator[Any]) -> Iterator[Any]:
        import pyarrow as pa

        for b in batches:
            part = splits.leaf(_floats(b.column(1), config.width) @ matrix)
            yield pa.record_batch([*b.columns, pa.array(part, pa.int32())], names=["id", "u", "asked", "part"])

    routed = units.select("id", "u", "asked").mapInArrow(route, "id long, u binary, asked boolean, part int")
    routed.repartition(max(1, min(2**depth, 4096)), "part").write.option("compression", "uncompressed").partitionBy("part").parquet(root)
    return root, 2**depth


def _boxes(spark: Any, root: str, parts: int, config: SearchConfig) -> tuple[np.ndarray, np.ndarray]:
    """The least and greatest projected coordinates of each part (infinitely far ones where a part is empty):
    at most ``most_parts`` rows of 100 bytes."""

    def measure(batches: Iterator[Any]) -> Iterator[Any]:
        import pyarrow as pa

        matrix = projection(config)
        for b in batches:
            own, box = b.column(0).to_pylist(), []
            for n in own:
                t = _read(root, n, ["u"])
                x = _floats(t.column("u"), config.width) @ matrix if t is not None else np.full((1, config.m), np.inf, np.float32)
                box.append(np.concatenate([x.min(axis=0), x.max(axis=0)]))
            yield pa.record_batch([pa.array(own, pa.int64()), _as_binary(np.array(box, dtype=np.float32))], names=["n", "box"])

    rows = spark.range(0, parts, 1, min(parts, 2000)).mapInArrow(measure, "n long, box binary").collect()
    out = np.array([np.frombuffer(r["box"], dtype=np.float32) for r in sorted(rows, key=lambda r: r["n"])])
    return out[:, :config.m], out[:, config.m:]


def _batch(hits: tuple[np.ndarray, np.ndarray, np.ndarray], part: int | None = None) -> Any:
    import pyarrow as pa

    query, neighbour, cosine = hits
    columns, names = [pa.array(query, pa.int64()), pa.array(neighbour, pa.int64()), pa.array(cosine, pa.float32())], ["query", "neighbour", "cosine"]
    if part is not None:
        columns, names = [*columns, pa.array(np.full(len(query), part), pa.int32())], [*names, "part"]
    return pa.record_batch(columns, names=names)


def _rounds(spark: Any, root: str, parts: int, config: SearchConfig, every: bool) -> DataFrame:
    """What every query finds in its own part, then in the other parts that pass the test.

    ``every`` says that all rows are queries: then two parts are compared once for both. Vectors are read from the
    shared folder by the tasks; only what was found, and the pairs of parts to compare, are rows of Spark.
    """
    boxes = spark.sparkContext.broadcast(_boxes(spark, root, parts, config))
    first, pairs = new_folder(spark, "vector-own"), new_folder(spark, "vector-pairs")
    width = min(parts, 20_000)

    def own_part(batches: Iterator[Any]) -> Iterator[Any]:
        matrix = projection(config)
        for b in batches:
            for n in b.column(0).to_pylist():
                t = _load(root, n, config, matrix)
                q = t if every else _load(root, n, config, matrix, True)
                search(q, t, every)
                yield _batch(q.found(), n)

    spark.range(0, parts, 1, width).mapInArrow(own_part, f"{FOUND}, part int").write.partitionBy("part").parquet(first)

    def within_reach(batches: Iterator[Any]) -> Iterator[Any]:
        import pyarrow as pa

        matrix, (low, high) = projection(config), boxes.value
        for b in batches:
            for n in b.column(0).to_pylist():
                q = _begin(first, n, _load(root, n, config, matrix, not every))
                hit = np.zeros(parts, dtype=bool)
                for a, z in q.spans if len(q.ids) else ():
                    x, reach = q.x[a:z], q.reach(a, z)
                    near = np.flatnonzero(~hit & (_gap(low, high, x.min(axis=0), x.max(axis=0)) <= reach.max()))
                    for t in near:
                        gap = np.maximum(np.maximum(low[t] - x, x - high[t]), 0)
                        hit[t] = bool((np.einsum("ij,ij->i", gap, gap) <= reach).any())
                hit[n] = False
                others = np.flatnonzero(hit)
                mine = np.full(len(others), n)
                a, z = (np.minimum(mine, others), np.maximum(mine, others)) if every else (mine, others)
                yield pa.record_batch([pa.array(a, pa.int32()), pa.array(z, pa.int32())], names=["q", "t"])

    spark.range(0, parts, 1, width).mapInArrow(within_reach, "q int, t int").distinct().write.parquet(pairs)
    todo = spark.read.schema("q int, t int").parquet(pairs)
    n_pairs = todo.count()
    own = spark.read.schema(f"{FOUND}, part int").parquet(first).select("query", "neighbour", "cosine")
    if not n_pairs:
        return own

    def compare(batches: Iterator[Any]) -> Iterator[Any]:
        matrix = projection(config)
        held: dict[int, Part] = {}
        for b in batches:
            for i, j in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                if i not in held:
                    held = {i: _load(root, i, config, matrix, not every)}
                q, t = _begin(first, i, _fresh(held[i], config)), _load(root, j, config, matrix)
                search(q, _begin(first, j, t) if every else t, every)
                yield _batch(q.found())
                if every:
                    yield _batch(t.found())

    # A number of partitions of its own, as the rows are few bytes; neighbours in a task share their first part.
    spread = todo.repartitionByRange(max(1, min(n_pairs, 20_000)), "q", "t").sortWithinPartitions("q", "t")
    return own.unionByName(spread.mapInArrow(compare, FOUND))


def _fresh(part: Part, config: SearchConfig) -> Part:
    """The same rows with nothing found."""
    out = copy.copy(part)
    least = -2.0 if config.min_cosine is None else config.min_cosine - 1e-7
    out.best, out.who = np.full_like(part.best, least), np.full_like(part.who, -1)
    return out


def _best(found: DataFrame, k: int) -> DataFrame:
    """The k best per query over all parts, ties by id; the limit is applied before the shuffle, too."""
    w = Window.partitionBy("query").orderBy(F.col("cosine").desc(), "neighbour")
    return found.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def nearest(rows: DataFrame, config: SearchConfig, id_column: str = "id", vector_column: str = "embedding", queries: Any = None) -> DataFrame:
    """(``query``, ``neighbour``, ``cosine``, ``rank``): the k most similar other vectors of each query.

    ``queries`` is a condition on ``id`` that says which rows are queries (default: all); all rows are
    searched. With ``min_cosine`` only neighbours of at least that cosine are returned. Vectors that are null,
    of another width, zero or not finite are left out; rows that repeat an id count once; ties in the cosine
    go to the smaller id. An empty table gives no rows; other columns are ignored.

    Equal vectors are indexed once, so that a group of copies that holds a third of all rows costs what one
    row costs: of each group the k + 1 least ids are enough to name anyone's neighbours. They are found with a
    row_number limit that applies before the shuffle, and a group is joined back by its representative.
    """
    ship(rows.sparkSession)
    k = config.k
    members = unit_rows(usable(rows, id_column, vector_column, config.width), config)
    ranked = members.withColumn("n", F.row_number().over(Window.partitionBy("u").orderBy("id"))).filter(F.col("n") <= k + 1)
    groups = ranked.groupBy("u").agg(F.sort_array(F.collect_list("id")).alias("ids"))
    root = new_folder(rows.sparkSession, "groups")
    groups.select(F.element_at("ids", 1).alias("id"), "u", "ids").write.parquet(root)
    spark = rows.sparkSession
    stored = spark.read.schema("id long, u binary, ids array<long>").parquet(root)
    n_rows = stored.count()
    wide = F.size("ids") > 1
    asked = F.lit(True) if queries is None else F.coalesce(queries | wide, F.lit(False))
    index, parts = write_index(stored.select("id", "u", asked.alias("asked")), config, n_rows, "vector-index")
    copies = stored.filter(wide)
    # Every member of a group of copies, by its representative. A group may hold a third of all rows, so both joins
    # with groups are salted: a group is a row per salt, and its members are spread over them by their ids.
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt")
    salted = members.withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(SALTS)).cast("int"))
    member_of = salted.join(copies.select("u", F.col("id").alias("rep"), salts), ["u", "salt"]).select(F.col("id").alias("member"), "rep", "salt")
    by_rep = _best(_rounds(spark, index, parts, config, queries is None), k).select("query", "neighbour", "cosine")
    # A representative stands for its group: its members are neighbours of each other and of whom it is near.
    named = by_rep.join(copies.select(F.col("id").alias("neighbour"), "ids"), "neighbour", "left")
    near = named.select("query", F.explode(F.coalesce("ids", F.array("neighbour"))).alias("neighbour"), "cosine")
    own = copies.select(F.col("id").alias("query"), F.explode("ids").alias("neighbour"), F.lit(1.0).cast("float").alias("cosine"))
    w = Window.partitionBy("query").orderBy(F.col("cosine").desc(), "neighbour")
    short = near.unionByName(own).withColumn("r", F.row_number().over(w)).filter(F.col("r") <= 2 * k + 1).drop("r")
    wide_ids = copies.select(F.col("id").alias("query"))
    lists = short.join(wide_ids, "query", "left_semi").groupBy(F.col("query").alias("rep")).agg(F.collect_list(F.struct("neighbour", "cosine")).alias("found"))  # at most 2k + 1 each
    of_members = member_of.join(lists.select("rep", "found", salts), ["rep", "salt"]).select(F.col("member").alias("query"), F.inline("found"))
    out = short.join(wide_ids, "query", "left_anti").unionByName(of_members).filter("query <> neighbour")
    if queries is not None:
        out = out.withColumnRenamed("query", "id").filter(queries).withColumnRenamed("id", "query")
    return _best(out, k)


def mutual_pairs(found: DataFrame) -> DataFrame:
    """(``id_a``, ``id_b``), a below b, of rows that are each among the other's nearest."""
    pairs = found.select(F.least("query", "neighbour").alias("id_a"), F.greatest("query", "neighbour").alias("id_b"))
    return pairs.groupBy("id_a", "id_b").agg(F.count(F.lit(1)).alias("n")).filter("n = 2").select("id_a", "id_b")
