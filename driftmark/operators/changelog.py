"""Applying a stream of inserts, updates and deletes: a log-structured merge store.

Changes are appended as sorted runs, merged k ways when read, and compacted level by level.

Layout below ``root``: ``<batch>/run=<i>/bucket=<n>/part-*.parquet``, each file sorted by key, with at most one
row per key and run, and ``manifest-<n>.json`` naming the runs that count with their levels. Every write has a
folder of its own, so writers share nothing but the manifest, which one at a time can create: a lost executor or
a killed driver leaves files that nobody reads and never half a run.
"""

from __future__ import annotations

import json
import random
import time
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from driftmark.session import ship
from driftmark.sources.files import Folder

UPSERT, DELETE = "upserted", "deleted"
#: How a run is stored. ``dead`` sorts a delete after an upsert of the same sequence; ``tie`` is a hash of the
#: payload, so that equal changes with different payloads resolve alike in whatever order runs are merged.
_KEY, _SEQ, _DEAD, _TIE = "dm_key", "dm_seq", "dm_dead", "dm_tie"


class ConcurrentCommit(RuntimeError):
    """Another writer kept committing first."""


@dataclass(frozen=True)
class ChangeSpec:
    """Which columns of a change say what it does. ``payload`` columns are carried to the current state."""

    key: Column
    sequence: Column
    operation: Column
    payload: tuple[str, ...] = ()


class ChangeStore:
    """The current state of a table, kept as runs of changes.

    Order is by ``sequence`` alone: arrival, repetition and the order of runs do not matter, so any runs can be
    merged with each other. A change is valid when its key and sequence are non-null and its operation is exactly
    ``upserted`` or ``deleted``; others are ignored. Of changes with the same key and sequence a delete wins over
    an upsert, and equal ones count once (of different payloads the one with the greatest hash stays). Empty
    batches make empty runs. As an older upsert may come at any time, a deleted key keeps its tombstone for good,
    also when compacted. Any number of writers may append at once.

    Appended runs have level 0. Once a level has ``fan_in`` runs they are merged into one of the next level, so
    that a change is rewritten once per level and not once per compaction, and a read meets at most
    ``fan_in - 1`` runs a level.
    """

    def __init__(self, spark: SparkSession, root: str, buckets: int | None = None, fan_in: int = 8) -> None:
        self.spark, self.root, self.fan_in = spark, root.rstrip("/"), fan_in
        self.folder = Folder(spark, self.root)
        if not self._manifests():
            first = {"version": 0, "buckets": buckets or int(spark.conf.get("spark.sql.shuffle.partitions")), "runs": [], "schema": None}
            self.folder.create(self._manifest(0), first)
        self.buckets = int(self.manifest()["buckets"])

    @staticmethod
    def _manifest(n: int) -> str:
        return f"manifest-{n:012d}.json"

    def _manifests(self) -> list[str]:
        return [n for n in self.folder.names() if n.startswith("manifest-")]

    def manifest(self) -> dict[str, Any]:
        return self.folder.load(self._manifests()[-1])

    def runs(self) -> list[str]:
        return [r["name"] for r in self.manifest()["runs"]]

    def _commit(self, change: Any, attempts: int = 100) -> None:
        """Of writers that meet one always succeeds, so each waits a little and tries again on what that one left."""
        for n in range(attempts):
            new = change(self.manifest())
            if self.folder.create(self._manifest(new["version"]), new):
                return
            time.sleep(random.uniform(0, 0.02 * min(n + 1, 10)))
        raise ConcurrentCommit(self.root)

    def append(self, changes: DataFrame, spec: ChangeSpec, run_of: Column | None = None, runs: int = 1) -> list[str]:
        """Append ``changes`` as sorted runs; ``run_of`` (0 .. runs - 1) spreads a backlog over several.

        Two shuffles: one of rows already reduced to one per key, run and task (so a hot key does not
        travel), one that brings each bucket together for sorting. Without a payload both are hash aggregation
        over fixed-width values: a key is dead if its last delete is as late as its last change.
        """
        batch, seq = uuid.uuid4().hex[:12], F.col(_SEQ)
        payload = F.struct(*[F.col(f"`{c}`").alias(c) for c in spec.payload]) if spec.payload else F.lit(None).cast("struct<none:int>")
        rows = changes.select((run_of if run_of is not None else F.lit(0)).cast("int").alias("run"), spec.key.alias(_KEY), spec.sequence.cast("long").alias(_SEQ), spec.operation.alias("op"), payload.alias("payload"))
        rows = rows.filter(F.col(_KEY).isNotNull() & seq.isNotNull() & F.col("op").isin(UPSERT, DELETE))
        dead = F.col("op") == DELETE
        if spec.payload:
            rank = F.struct(seq, dead.alias(_DEAD), F.xxhash64(F.to_json("payload")).alias(_TIE))
            last = rows.groupBy("run", _KEY).agg(F.max_by(F.struct(rank.alias("r"), "payload"), rank).alias("c"))
            flat = last.select("run", _KEY, f"c.r.{_SEQ}", f"c.r.{_DEAD}", f"c.r.{_TIE}", *[f"c.payload.{c}" for c in spec.payload])
        else:
            last = rows.groupBy("run", _KEY).agg(F.max(seq).alias(_SEQ), F.max(F.when(dead, seq)).alias("last_delete"))
            flat = last.select("run", _KEY, _SEQ, seq.eqNullSafe(F.col("last_delete")).alias(_DEAD))
        self._write(flat, batch)
        added = [{"name": f"{batch}/run={i}", "level": 0} for i in range(runs)]
        schema = flat.drop("run").schema.json()

        def add(m: dict[str, Any]) -> dict[str, Any]:
            return m | {"version": m["version"] + 1, "runs": m["runs"] + added, "schema": schema}

        self._commit(add)
        return [r["name"] for r in added]

    def _write(self, flat: DataFrame, batch: str) -> None:
        bucketed = flat.withColumn("bucket", F.pmod(F.xxhash64(_KEY), F.lit(self.buckets)).cast("int"))
        spread = bucketed.repartition(self.buckets, "bucket")
        spread.sortWithinPartitions("run", "bucket", _KEY).write.partitionBy("run", "bucket").parquet(f"{self.root}/{batch}")

    def merged(self, runs: list[str] | None = None) -> DataFrame:
        """The k-way merge of the runs: the last change of each key, tombstones among them.

        A task owns a bucket and reads its sorted files in all runs in step, batch by batch, so nothing is
        shuffled and memory is one batch per run, whatever the size of the bucket.
        """
        ship(self.spark)
        m = self.manifest()
        if m["schema"] is None:
            return self.spark.createDataFrame([], T.StructType([T.StructField(_KEY, T.StringType()), T.StructField(_SEQ, T.LongType()), T.StructField(_DEAD, T.BooleanType())]))
        schema = T.StructType.fromJson(json.loads(m["schema"]))
        names, root = [r["name"] for r in m["runs"]] if runs is None else list(runs), self.root
        arrow = to_arrow_schema(schema)

        def merge(batches: Iterator[Any]) -> Iterator[Any]:
            for batch in batches:
                for bucket in batch.column(0).to_pylist():
                    yield from merge_files(root, names, bucket, arrow)

        return self.spark.range(0, self.buckets, 1, self.buckets).mapInArrow(merge, schema)

    def current(self) -> DataFrame:
        """The rows that are live: the last change of each key, where that is an upsert."""
        return self.merged().filter(~F.col(_DEAD)).drop(_DEAD, _TIE)

    def compact(self, force: bool = False) -> int:
        """Merge full levels, from the lowest up, until none is full; with ``force`` all runs into one. Returns the
        number of merges. Tombstones stay, as older changes may follow."""
        merges = 0
        while True:
            runs, due = self.manifest()["runs"], []
            for level in sorted({r["level"] for r in runs}):
                if len(own := [r for r in runs if r["level"] == level]) >= self.fan_in:
                    due = own
                    break
            if force:
                due, force = runs if len(runs) > 1 else [], False
            if not due:
                return merges
            self._merge(due)
            merges += 1

    def _merge(self, due: list[dict[str, Any]]) -> None:
        batch, gone = uuid.uuid4().hex[:12], {r["name"] for r in due}
        self._write(self.merged(sorted(gone)).withColumn("run", F.lit(0)), batch)
        into = {"name": f"{batch}/run=0", "level": max(r["level"] for r in due) + 1}

        def swap(m: dict[str, Any]) -> dict[str, Any]:
            if not gone <= {r["name"] for r in m["runs"]}:
                raise ConcurrentCommit("the runs were compacted by another writer")
            return m | {"version": m["version"] + 1, "runs": [r for r in m["runs"] if r["name"] not in gone] + [into]}

        self._commit(swap)


def merge_files(root: str, runs: list[str], bucket: int, schema: Any, groups: Any = None, rows: int = 65536) -> Iterator[Any]:
    """The last row of each key in the sorted files of a bucket in some runs, batch by batch; ``groups`` says which
    row groups of a file to read."""
    import pyarrow as pa
    import pyarrow.compute as pc
    import pyarrow.fs as pafs
    import pyarrow.parquet as pq

    fs, base = pafs.FileSystem.from_uri(root)
    sources: list[Iterator[Any]] = []
    for run in runs:
        found = fs.get_file_info(pafs.FileSelector(f"{base}/{run}/bucket={bucket}", allow_not_found=True))
        for f in sorted(x.path for x in found if x.base_name.endswith(".parquet")):
            file = pq.ParquetFile(fs.open_input_file(f))
            batches = file.iter_batches(batch_size=rows, columns=schema.names, **({"row_groups": groups(file)} if groups is not None else {}))
            sources.append(b.select(schema.names).cast(schema) for b in batches)
    heads: dict[int, Any] = {}
    for i, s in enumerate(sources):
        if (b := next(s, None)) is not None:
            heads[i] = b
    following = {i: next(sources[i], None) for i in heads}
    while heads:
        # Keys up to the least last key of the runs that go on are complete in what was read.
        bounds = [b.column(_KEY)[-1] for i, b in heads.items() if following[i] is not None]
        bound = min((x.as_py() for x in bounds), key=lambda x: x.encode() if isinstance(x, str) else x) if bounds else None
        part = []
        for i in list(heads):
            b = heads[i]
            n = b.num_rows if bound is None else pc.sum(pc.less_equal(b.column(_KEY), bound)).as_py() or 0
            part.append(b.slice(0, n))
            rest = b.slice(n)
            if rest.num_rows == 0:
                if following[i] is None:
                    del heads[i]
                    continue
                rest, following[i] = following[i], next(sources[i], None)
            heads[i] = rest
        t = pa.Table.from_batches(part).combine_chunks()
        order = pc.sort_indices(t, sort_keys=[(c, "ascending") for c in (_KEY, _SEQ, _DEAD, _TIE) if c in schema.names])
        t = t.take(order)
        key = t.column(_KEY).combine_chunks()
        if len(key):
            last = pa.concat_arrays([pc.not_equal(key.slice(0, len(key) - 1), key.slice(1)), pa.array([True])])
            yield from t.filter(last).cast(schema).combine_chunks().to_batches()
