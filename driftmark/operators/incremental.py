"""Processing only new or changed records, surviving failures without skipping or repeating any.

Changes are captured into a log with positions per partition. A run is planned from what lies beyond the
committed positions, the plan is written ahead, the planned records are processed, and the run is committed with
the positions it reached. A run that failed anywhere is replayed from its plan, never planned anew, and the sink
drops what it already holds by key and offset, so a half-written run does no harm.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from driftmark.sources.files import Folder


class ConcurrentAttempt(RuntimeError):
    """Another driver wrote for the same run meanwhile."""


def latest(rows: DataFrame, key: Column, offset: Column) -> DataFrame:
    """(``key``, ``offset``): the highest offset of each key. Null keys and offsets count for nothing.

    ``max`` aggregates on the map side, so a hot key is one row per task before the shuffle.
    """
    return rows.select(key.alias("key"), offset.cast("long").alias("offset")).dropna().groupBy("key").agg(F.max("offset").alias("offset"))


def pending(log: DataFrame, sink: DataFrame) -> DataFrame:
    """Records of the log (``key``, ``offset``, ...) whose key the sink does not hold at that offset or above.

    The sink has one row per key; the condition keeps an equi join on the key with the comparison as residual. It
    looks at no clock, so late rows and clocks that moved by themselves change nothing.
    """
    held = sink.select(F.col("key").alias("k"), F.col("offset").alias("o"))
    return log.join(held, (F.col("key") == F.col("k")) & (F.col("o") >= F.col("offset")), "left_anti")


def message_positions(log: DataFrame, partition: str, position: str, committed: dict[int, int]) -> DataFrame:
    """Records of a message log beyond the committed position of their partition.

    The condition is one comparison per partition, which reaches the Parquet scan; a partition that was
    never committed is read from its start. Rows without partition or position are no records of the log.
    """
    p, o = F.col(f"`{partition}`"), F.col(f"`{position}`")
    beyond = ~p.isin(list(committed)) if committed else F.lit(True)
    for n, at in sorted(committed.items()):
        beyond = beyond | ((p == n) & (o > at))
    return log.filter(p.isNotNull() & o.isNotNull() & beyond)


class ChangeLog:
    """Changes of a table that has no log of its own, captured with positions per partition.

    ``capture`` appends the records (``key``, ``offset``) that the log does not hold yet; a record of an older
    offset than one captured is no change. A partition is a hash bucket of the key, so the changes of a key lie in
    order; positions count from 0 and are dense. A capture becomes visible with its manifest, exclusively.
    """

    SCHEMA = "key string, offset long, position long, partition int"

    def __init__(self, spark: SparkSession, root: str, partitions: int | None = None) -> None:
        """``partitions`` counts for a new log only: by default as many as a shuffle has, 32 to 256."""
        self.spark, self.root = spark, root.rstrip("/")
        self.folder = Folder(spark, self.root)
        if not self._captures():
            partitions = partitions or min(256, max(32, int(spark.conf.get("spark.sql.shuffle.partitions"))))
            self.folder.create("captured-000000000.json", {"captures": [], "ends": {}, "partitions": partitions})
        self.partitions = int(self._last()["partitions"])

    def _captures(self) -> list[str]:
        return [n for n in self.folder.names() if n.startswith("captured-")]

    def _last(self) -> dict[str, Any]:
        return self.folder.load(self._captures()[-1])

    def ends(self) -> dict[int, int]:
        """The last position of each partition."""
        return {int(p): n for p, n in self._last()["ends"].items()}

    def records(self) -> DataFrame:
        """(``key``, ``offset``, ``position``, ``partition``) of all captures."""
        paths = [f"{self.root}/{c}" for c in self._last()["captures"]]
        if not paths:
            return self.spark.createDataFrame([], self.SCHEMA)
        found = [self.spark.read.schema(self.SCHEMA).option("basePath", p).parquet(p) for p in paths]
        out = found[0]
        for f in found[1:]:
            out = out.unionByName(f)
        return out

    def capture(self, rows: DataFrame) -> dict[int, int]:
        """Append what is new in ``rows`` (``key``, ``offset``) and return the ends reached.

        One aggregation to a row per key and one anti join with the log; rows are then numbered within their
        partition, which holds a share of the changes as even as the hash of the keys.
        """
        last, number = self._last(), len(self._captures())
        new = pending(latest(rows, F.col("key"), F.col("offset")), latest(self.records(), F.col("key"), F.col("offset")))
        new = new.withColumn("partition", F.pmod(F.xxhash64("key"), F.lit(self.partitions)).cast("int"))
        base = F.lit(0)
        for p, n in sorted(last["ends"].items()):
            base = F.when(F.col("partition") == int(p), F.lit(n + 1)).otherwise(base)
        at = F.row_number().over(Window.partitionBy("partition").orderBy("offset", "key")) - 1
        name = f"changes-{number:09d}-{uuid.uuid4().hex[:8]}"
        new.select("key", "offset", (base + at).cast("long").alias("position"), "partition").write.partitionBy("partition").parquet(f"{self.root}/{name}")
        found = self.spark.read.schema(self.SCHEMA).parquet(f"{self.root}/{name}").groupBy("partition").agg(F.max("position").alias("at")).collect()  # a number per partition
        ends = last["ends"] | {str(r["partition"]): r["at"] for r in found}
        captures = [*last["captures"], name] if found else last["captures"]
        if not self.folder.create(f"captured-{number:09d}.json", {"captures": captures, "ends": ends, "partitions": self.partitions}):
            raise ConcurrentAttempt("another capture came first")
        return {int(p): n for p, n in ends.items()}


class IncrementalJob:
    """Runs over a log: ``plan-<run>/`` holds the write-ahead plan, ``done-<run>.json`` the commit.

    The log has ``key`` and ``offset`` (the version of the record), and ``position`` names its columns of partition
    and position: those of a ``ChangeLog`` by default, those of a topic for messages. A run takes exactly the
    records between the positions of the last commit and those reached when it was planned, the highest offset of
    each key, less what the sink holds at that offset or above. The reached positions are written ahead with the
    plan and committed with the run.
    """

    def __init__(self, spark: SparkSession, root: str, position: tuple[str, str] = ("partition", "position")) -> None:
        self.spark, self.root, self.position = spark, root.rstrip("/"), position
        self.folder = Folder(spark, self.root)

    def _runs(self, kind: str) -> list[int]:
        return sorted(int(n.split("-")[1].split(".")[0]) for n in self.folder.names() if n.startswith(f"{kind}-"))

    def open_run(self) -> int | None:
        """The planned run that is not committed, which has to be replayed first."""
        done = set(self._runs("done"))
        return next((n for n in self._runs("ready") if n not in done), None)

    def committed(self) -> dict[int, int]:
        """The positions reached by the last committed run, per partition."""
        done = self._runs("done")
        return {int(p): n for p, n in self.folder.load(f"done-{done[-1]:09d}.json").get("positions", {}).items()} if done else {}

    def adopt(self, log: DataFrame, sink: DataFrame) -> dict[int, int]:
        """Commit run 0: the positions up to which a sink that other runs filled holds everything.

        Per partition that is the place before the first record which the sink lacks, or the end. What the sink
        holds beyond is dropped by key and offset when it is planned.
        """
        if self._runs("done"):
            return self.committed()
        p, o = (F.col(f"`{c}`") for c in self.position)
        lacking = pending(log, sink).groupBy(p.alias("p")).agg(F.min(o).alias("first"))
        ends = log.filter(p.isNotNull()).groupBy(p.alias("p")).agg(F.max(o).alias("end"), F.min(o).alias("start"))
        found = ends.join(lacking, "p", "left").select("p", F.coalesce(F.col("first") - 1, "end").alias("at"), "start").collect()  # a row per partition
        positions = {str(r["p"]): r["at"] for r in found if r["at"] is not None and r["at"] >= r["start"]}
        self.folder.create("done-000000000.json", {"run": 0, "records": 0, "positions": positions})
        return self.committed()

    def plan(self, log: DataFrame, sink: DataFrame) -> int:
        """Write ahead which records the next run processes; an open run is returned as it was planned."""
        if (replay := self.open_run()) is not None:
            return replay
        run = max([0, *self._runs("ready"), *self._runs("plan")]) + 1
        reached = self.committed()
        new = message_positions(log, *self.position, reached)
        p, o = (F.col(f"`{c}`") for c in self.position)
        ends = {int(r["p"]): int(r["o"]) for r in new.groupBy(p.alias("p")).agg(F.max(o).alias("o")).collect()}
        within = F.lit(False)  # records that arrive meanwhile belong to the next run
        for n, at in sorted(ends.items()):
            within = within | ((p == n) & (o <= at))
        todo = pending(latest(new.filter(within), F.col("key"), F.col("offset")), sink)
        todo.select("key", "offset").write.parquet(f"{self.root}/plan-{run:09d}")
        self.folder.create(f"ready-{run:09d}.json", {"run": run, "positions": {str(n): at for n, at in (reached | ends).items()}})
        return run

    def planned(self, run: int) -> DataFrame:
        """The records of a planned run (``key``, ``offset``)."""
        return self.spark.read.schema("key string, offset long").parquet(f"{self.root}/plan-{run:09d}")

    def commit(self, run: int) -> dict[str, Any]:
        """Record the run with the positions of its plan and the number of its records."""
        positions = self.folder.load(f"ready-{run:09d}.json")["positions"]
        state = {"run": run, "records": self.planned(run).count(), "positions": positions}
        self.folder.create(f"done-{run:09d}.json", state)
        return state

    def attempt(self, log: DataFrame, sink: Sink, process: Callable[[DataFrame], DataFrame]) -> int:
        """Plan or replay, process what the sink lacks of the plan, write it. Returns the number of the run."""
        run = self.plan(log, sink.held())
        number = sink.attempts(run)
        todo = pending(self.planned(run), sink.held(run))
        sink.write(process(todo), run, number)
        return run

    def run(self, log: DataFrame, sink: Sink, process: Callable[[DataFrame], DataFrame]) -> int:
        """An attempt and its commit. Returns the number of the run."""
        run = self.attempt(log, sink, process)
        self.commit(run)
        return run


class Sink:
    """An append-only table of (``key``, ``offset``, ...) in parts that count once they are published.

    A part is named by its run and the number of parts the run had when the part's records were chosen, and only
    one writer can publish that name. So of two drivers on one run the slower one is refused, no (key, offset)
    lies in two parts, and a record may lead to any number of rows, all from one write.
    """

    def __init__(self, spark: SparkSession, root: str, schema: str) -> None:
        self.spark, self.root, self.schema = spark, root.rstrip("/"), schema
        self.folder = Folder(spark, self.root)

    def _parts(self, run: int | None = None) -> list[str]:
        prefix = "part-" if run is None else f"part-{run:09d}-"
        return [n for n in self.folder.names() if n.startswith(prefix)]

    def attempts(self, run: int) -> int:
        """How many parts of a run are published."""
        return len(self._parts(run))

    def rows(self, run: int | None = None) -> DataFrame:
        """All rows, or those of one run."""
        paths = [f"{self.root}/{self.folder.load(n)['rows']}" for n in self._parts(run)]
        return self.spark.read.schema(self.schema).parquet(*paths) if paths else self.spark.createDataFrame([], self.schema)

    def held(self, run: int | None = None) -> DataFrame:
        return latest(self.rows(run), F.col("key"), F.col("offset"))

    def write(self, rows: DataFrame, run: int, number: int | None = None) -> None:
        """Add ``rows`` as part ``number`` of a run (default: its next)."""
        number = self.attempts(run) if number is None else number
        name = f"rows-{uuid.uuid4().hex}"
        rows.write.parquet(f"{self.root}/{name}")
        if not self.folder.create(f"part-{run:09d}-{number:06d}.json", {"rows": name}):
            raise ConcurrentAttempt(f"part {number} of run {run} was written by another driver")
