"""The tables as sorted runs of changes, with one manifest per commit.

A commit appends one run per table that it changes: the rows that are new or different and marks for those that are
gone, in buckets by hash of the document, each sorted by key. Then it creates the next manifest, which one writer
can do. So what a commit writes depends on what it changes and not on the size of the tables. Readers resolve one
manifest and so see one state of all tables, whatever is committed meanwhile; they merge the runs of a bucket in
step and skip row groups without the documents they ask for. Runs are merged level by level. Files of a commit
that never got its manifest are never read.
"""

from __future__ import annotations

import uuid
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from driftmark.operators.changelog import _DEAD, _KEY, _SEQ, merge_files
from driftmark.session import new_folder, ship, together
from driftmark.sources.files import Folder

FORMAT = 2
SCHEMAS = {
    "documents": "document_id string, title string, content string, version int, deleted boolean, updated_at timestamp",
    "outbox": "id long, event_id string, document_id string, event_type string, document_version int, created_at timestamp, published_at timestamp",
    "chunks": "document_id string, content_hash string, position int, content string, embedding array<float>, document_version int",
    "index_state": "document_id string, indexed_version int, indexed_at timestamp, deleted boolean",
}
#: What tells rows apart within a document.
WITHIN = {"outbox": "id", "chunks": "content_hash"}
#: Manifests that stay for readers who resolved an older one.
KEPT_MANIFESTS = 50


class ConcurrentModificationError(RuntimeError):
    """Other writers kept committing first."""


@dataclass(frozen=True)
class Selection:
    """Some documents, written by bucket where the tasks that read those buckets find them."""

    path: str
    buckets: tuple[int, ...]


def key_of(table: str) -> Column:
    document = F.col("document_id")
    if table not in WITHIN:
        return document
    within = F.col(WITHIN[table])
    return F.concat_ws(":", document, F.lpad(within.cast("string"), 20, "0") if table == "outbox" else within)


class SnapshotStore:
    def __init__(self, spark: SparkSession, root: str, dimension: int = 384, buckets: int = 16, fan_in: int = 8) -> None:
        self.spark, self.root, self.fan_in = spark, root.rstrip("/"), fan_in
        self.folder = Folder(spark, self.root)
        ship(spark)
        if not self._manifests():
            first = {"format": FORMAT, "version": 0, "dimension": dimension, "buckets": buckets, "tables": {t: [] for t in SCHEMAS}, "batches": {}, "sequence": 0}
            self.folder.create(self._name(0), first)
        held = self.manifest()
        if held["format"] == 1:
            held = self._migrate(held)
        if held["format"] != FORMAT:
            raise ValueError(f"store format {held['format']} is not {FORMAT}")
        if held["dimension"] != dimension:
            raise ValueError(f"the store holds vectors of {held['dimension']} numbers; a change needs a new store")
        self.buckets, self.dimension = int(held["buckets"]), dimension

    @staticmethod
    def _name(n: int) -> str:
        return f"manifest-{n:012d}.json"

    def _manifests(self) -> list[str]:
        return [n for n in self.folder.names() if n.startswith("manifest-")]

    def manifest(self) -> dict[str, Any]:
        return self.folder.load(self._manifests()[-1])

    def _migrate(self, held: dict[str, Any]) -> dict[str, Any]:
        """Take over a store of format 1, whose tables were whole buckets: they become the first runs of this one.
        Whoever creates the next manifest has migrated; others find it done."""
        self.buckets = int(held["buckets"])
        new = {k: v for k, v in held.items() if k not in ("batches", "failures")} | {"format": FORMAT, "version": held["version"] + 1, "batches": {}, "tables": {}}
        for table, versions in held["tables"].items():
            paths = [f"{self.root}/{table}/v={v}/bucket={b}" for b, v in versions.items() if v]
            rows = self.spark.read.schema(SCHEMAS[table]).parquet(*paths) if paths else None
            new["tables"][table] = [self._write(table, rows, None, new["version"])] if rows is not None else []
        self.folder.create(self._name(new["version"]), new)
        return self.manifest()

    def bucket(self, document_id: Column | None = None) -> Column:
        return F.pmod(F.xxhash64(document_id if document_id is not None else F.col("document_id")), F.lit(self.buckets)).cast("int")

    def select(self, documents: DataFrame) -> Selection:
        """The documents named by ``document_id``, for reading: nothing but bucket numbers comes to the driver."""
        path = new_folder(self.spark, "selection")
        named = documents.select("document_id").filter("document_id IS NOT NULL").distinct().withColumn("bucket", self.bucket())
        named.repartition("bucket").sortWithinPartitions("bucket", "document_id").write.partitionBy("bucket").parquet(path)
        found = [n.removeprefix("bucket=") for n in Folder(self.spark, path).names() if n.startswith("bucket=")]
        return Selection(path, tuple(sorted(map(int, found))))

    def read(self, table: str, manifest: dict[str, Any] | None = None, only: Selection | None = None, columns: list[str] | None = None, since: int | None = None) -> DataFrame:
        """A table in the state of one manifest: all columns or some, all documents or those selected, all rows or
        those put after the commit ``since``, for which older runs are not read.

        A task owns a bucket and merges its runs in step, so nothing is shuffled and memory is one batch per run.
        """
        runs = [r for r in (manifest or self.manifest())["tables"][table] if since is None or r["last"] > since]
        whole = T.StructType.fromDDL(SCHEMAS[table])
        wanted = T.StructType([f for f in whole.fields if columns is None or f.name in columns])
        buckets = range(self.buckets) if only is None else only.buckets
        if not runs or not len(buckets):
            return self.spark.createDataFrame([], wanted)
        stored = T.StructType([*_MARKS.fields, *[f for f in whole.fields if f in wanted.fields]])
        arrow, given = to_arrow_schema(stored), to_arrow_schema(wanted)
        root, names, path = self.root, [r["name"] for r in runs], only.path if only is not None else None

        def merge(batches: Iterator[Any]) -> Iterator[Any]:
            import pyarrow.compute as pc

            for batch in batches:
                for bucket in batch.column(0).to_pylist():
                    for found in _merge(root, names, bucket, arrow, path):
                        if since is not None:
                            found = found.filter(pc.greater(found.column(_SEQ), since))
                        yield found.select(given.names)

        at = self.spark.createDataFrame([(b,) for b in buckets], "bucket int").repartition(len(buckets), "bucket")
        return at.mapInArrow(merge, wanted)

    def _write(self, table: str, upserts: DataFrame | None, removed: DataFrame | None, version: int) -> dict[str, Any]:
        fields = T.StructType.fromDDL(SCHEMAS[table]).fields
        parts = []
        if upserts is not None:
            parts.append(upserts.select(key_of(table).alias(_KEY), F.lit(version).cast("long").alias(_SEQ), F.lit(False).alias(_DEAD), *[F.col(f.name).cast(f.dataType).alias(f.name) for f in fields]))
        if removed is not None:
            named = {"document_id", WITHIN.get(table, "document_id")}
            parts.append(removed.select(key_of(table).alias(_KEY), F.lit(version).cast("long").alias(_SEQ), F.lit(True).alias(_DEAD), *[(F.col(f.name) if f.name in named else F.lit(None)).cast(f.dataType).alias(f.name) for f in fields]))
        rows = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
        return self._store(table, rows, version, 0)

    def _store(self, table: str, rows: DataFrame, version: int, level: int) -> dict[str, Any]:
        name = f"{table}/{version}-{uuid.uuid4().hex[:8]}"
        rows = rows.withColumn("bucket", self.bucket()).repartition(self.buckets, "bucket").sortWithinPartitions("bucket", _KEY)
        rows.write.option("parquet.block.size", 8 << 20).partitionBy("bucket").parquet(f"{self.root}/{name}")
        return {"name": name, "level": level, "last": version}

    def commit(self, base: dict[str, Any], tables: dict[str, tuple[DataFrame | None, DataFrame | None]], **extra: Any) -> dict[str, Any] | None:
        """Put rows into tables and take rows out (named by their keys), all at once; None if another commit came
        first. A key is in one of the two frames of its table, and once."""
        version = base["version"] + 1
        changed = {t: c for t, c in tables.items() if c[0] is not None or c[1] is not None}
        written = together(*[lambda t=t, c=c: self._write(t, *c, version) for t, c in changed.items()])
        runs = {t: [w] for t, w in zip(changed, written)}
        new = {**base, **extra, "version": version, "tables": {t: [*held, *runs.get(t, [])] for t, held in base["tables"].items()}}
        if not self.folder.create(self._name(version), new):
            return None
        for old in self._manifests()[:-KEPT_MANIFESTS]:
            self.folder.remove(old)
        return new

    def compact(self) -> int:
        """Merge each full level of each table into one run of the next. Marks of gone rows are dropped when
        nothing older is left below them, as order is by commit. Returns the number of merges; one that meets
        another commit is left to the next time."""
        merges = 0
        for table in SCHEMAS:
            while True:
                base = self.manifest()
                runs = base["tables"][table]
                level = next((n for n in sorted({r["level"] for r in runs}) if sum(r["level"] == n for r in runs) >= self.fan_in), None)
                if level is None:
                    break
                due = [r for r in runs if r["level"] == level]  # neighbours in age: higher levels are older
                version, bottom = base["version"] + 1, due[0] is runs[0]
                stored = T.StructType([*_MARKS.fields, *T.StructType.fromDDL(SCHEMAS[table]).fields])
                root, names, arrow = self.root, [r["name"] for r in due], to_arrow_schema(stored)

                def merge(batches: Iterator[Any], root: str = root, names: list[str] = names, arrow: Any = arrow, bottom: bool = bottom) -> Iterator[Any]:
                    for batch in batches:
                        for bucket in batch.column(0).to_pylist():
                            yield from _merge(root, names, bucket, arrow, None, bottom)

                rows = self.spark.range(0, self.buckets, 1, self.buckets).mapInArrow(merge, stored)
                run = self._store(table, rows, version, level + 1) | {"last": max(r["last"] for r in due)}
                at = runs.index(due[0])
                kept = [r for r in runs if r["level"] != level]
                tables = base["tables"] | {table: [*kept[:at], run, *kept[at:]]}
                if not self.folder.create(self._name(version), {**base, "version": version, "tables": tables}):
                    return merges
                merges += 1
        return merges


_MARKS = T.StructType([T.StructField(_KEY, T.StringType()), T.StructField(_SEQ, T.LongType()), T.StructField(_DEAD, T.BooleanType())])


def _merge(root: str, runs: list[str], bucket: int, schema: Any, selection: str | None, live_only: bool = True) -> Iterator[Any]:
    """The merged rows of a bucket, those of the selected documents if there is a selection."""
    import pyarrow as pa
    import pyarrow.compute as pc
    import pyarrow.fs as pafs
    import pyarrow.parquet as pq

    wanted: list[str] | None = None
    if selection is not None:
        fs, base = pafs.FileSystem.from_uri(f"{selection}/bucket={bucket}")
        files = [f.path for f in fs.get_file_info(pafs.FileSelector(base, allow_not_found=True)) if f.base_name.endswith(".parquet")]
        wanted = sorted(x for f in files for x in pq.ParquetFile(fs.open_input_file(f)).read(columns=["document_id"]).column(0).to_pylist())

    def groups(file: Any) -> list[int]:
        """Row groups whose keys may name a wanted document."""
        every = range(file.metadata.num_row_groups)
        if wanted is None:
            return list(every)
        at = file.schema_arrow.get_field_index(_KEY)
        out = []
        for g in every:
            s = file.metadata.row_group(g).column(at).statistics
            if s is None or not s.has_min_max:
                out.append(g)
                continue
            low, high = s.min.split(":")[0], s.max.split(":")[0]
            i = bisect_left(wanted, low)
            if i < len(wanted) and wanted[i] <= high:
                out.append(g)
        return out

    named = pa.array(wanted, pa.string()) if wanted is not None else None
    for batch in merge_files(root, runs, bucket, schema, groups):
        if live_only:
            batch = batch.filter(pc.invert(batch.column(_DEAD)))
        if named is not None:
            keys = batch.column(_KEY)
            batch = batch.filter(pc.is_in(pc.list_element(pc.split_pattern(keys, ":", max_splits=1), 0), named))
        if batch.num_rows:
            yield batch
