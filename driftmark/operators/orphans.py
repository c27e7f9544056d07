"""References to records that do not exist: direct and inherited orphans down a foreign-key graph."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from itertools import count

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from driftmark.functions.ids import identity
from driftmark.session import materialize

MISSING, DELETED, LATE, INHERITED = "missing", "deleted", "late", "inherited"


@dataclass(frozen=True)
class Reference:
    """Rows of one child table that refer to a parent by ``key``.

    ``deleted_matters`` says which rows may not refer to a deleted parent (default: none).
    """

    name: str
    rows: DataFrame
    key: str
    loaded_at: str
    deleted_matters: Column | None = None


def parents(df: DataFrame, key: str, version: str, deleted: str, loaded_at: str) -> DataFrame:
    """One row per parent (``key``, ``deleted``, ``first_loaded_at``): the row of the highest version.

    Repeated rows and earlier versions collapse in the map-side partial aggregation. Rows without a key
    are no parents; a null version is below every version; a null ``deleted`` counts as live. Should rows
    of the highest version disagree, deleted wins and the earliest load counts.
    """
    v = F.coalesce(F.col(f"`{version}`").cast("long"), F.lit(-(2**63)))
    rows = df.select(identity(F.col(f"`{key}`")).alias("key"), v.alias("v"), F.when(F.col(f"`{deleted}`"), v).alias("dead"), F.col(f"`{loaded_at}`").alias("t"))
    # Fixed-width values only, so that this is a hash aggregation.
    per = rows.filter("key IS NOT NULL").groupBy("key").agg(F.max("v").alias("v"), F.max("dead").alias("dead"), F.min("t").alias("first_loaded_at"))
    return per.select("key", F.col("v").eqNullSafe(F.col("dead")).alias("deleted"), "first_loaded_at")


def compact_references(refs: Sequence[Reference]) -> DataFrame:
    """All references as distinct (table, key, period, deleted_matters) with the earliest and the latest load.

    The rows that a row of the result stands for differ in nothing but whether they are late, so a key that
    holds a third of a table is a handful of rows before anything is shuffled for the join.
    """
    out: DataFrame | None = None
    for r in refs:
        matters = F.coalesce(r.deleted_matters, F.lit(False)) if r.deleted_matters is not None else F.lit(False)
        part = r.rows.select(F.lit(r.name).alias("table_name"), identity(F.col(f"`{r.key}`")).alias("key"), F.date_format(F.col(f"`{r.loaded_at}`"), "yyyy-MM").alias("period"), matters.alias("matters"), F.col(f"`{r.loaded_at}`").alias("t")).filter("key IS NOT NULL")
        out = part if out is None else out.unionByName(part)
    assert out is not None, "at least one reference is needed"
    return out.groupBy("table_name", "key", "period", "matters").agg(F.min("t").alias("t"), F.max("t").alias("last_t"))


def graded(refs: Sequence[Reference], parent: DataFrame) -> DataFrame:
    """(``table_name``, ``period``, ``key``, ``reason``), distinct, of all references; ``reason`` is null for
    those that are no direct orphans. The reasons are those of ``direct_orphans``."""
    late = lambda t: F.col(t) < F.col("first_loaded_at")
    always = F.when(F.col("first_loaded_at").isNull() & F.col("deleted").isNull(), MISSING).when(F.col("deleted") & F.col("matters"), DELETED)
    # Of the rows that one row stands for some may be late and others not: then it has both grades.
    grades = F.when(always.isNotNull(), F.array(always)).when(late("last_t"), F.array(F.lit(LATE))).when(late("t"), F.array(F.lit(LATE), F.lit(None).cast("string"))).otherwise(F.array(F.lit(None).cast("string")))
    joined = compact_references(refs).join(parent, "key", "left")
    return joined.select("table_name", "period", "key", F.explode(grades).alias("reason")).distinct()


def direct_orphans(refs: Sequence[Reference], parent: DataFrame) -> DataFrame:
    """(``table_name``, ``period``, ``key``, ``reason``), distinct, of references with a reason.

    The first that applies: ``missing``, no such parent; ``deleted``, the parent is deleted and the row's
    ``deleted_matters`` holds; ``late``, the row was loaded before its parent first was. Null references
    are no references. Null load times give a null period and are never late. Empty tables give no rows.
    """
    return graded(refs, parent).filter("reason IS NOT NULL")


@dataclass(frozen=True)
class Edge:
    """A foreign key: ``child.child_key`` refers to ``parent.parent_key``."""

    child: str
    child_key: str
    parent: str
    parent_key: str


def _per_key(rows: DataFrame) -> DataFrame:
    return rows.filter("k IS NOT NULL").groupBy("k").agg(F.sum("lost").cast("long").alias("lost"))


def _few(frames: list[DataFrame]) -> list[DataFrame]:
    """The counts of many rounds, written together from time to time so that plans stay small."""
    return frames if len(frames) <= 8 else [materialize(_per_key(reduce(DataFrame.unionByName, frames)), "fk-lost")]


def _inherit(state: dict[str, DataFrame], edges: Sequence[Edge]) -> dict[str, list[DataFrame]]:
    """The orphans of each table, one frame per round: those with a ``depth`` in ``state``, then what inherits.

    A round looks only at keys of the frontier, the orphans that the round before added: of those keys it takes
    the ones of which no parent row is left, and the child rows that refer to them by a semi join. It writes what
    it adds and nothing else. The rounds end when the frontier is empty, however many it takes.
    """
    found = {t: [rows.filter("depth IS NOT NULL")] for t, rows in state.items()}
    whole = {t: rows.filter("depth IS NULL") for t, rows in state.items()}
    frontier = {t: f[0] for t, f in found.items() if not f[0].isEmpty()}
    lost: dict[tuple[str, str], list[DataFrame]] = {}
    for n in count(1):
        gone: dict[tuple[str, str], DataFrame] = {}
        for p, k in {(e.parent, e.parent_key) for e in edges if e.parent in frontier}:
            named = frontier[p].select(F.col(k).alias("k")).filter("k IS NOT NULL").distinct()
            sound = whole[p].select(F.col(k).alias("k")).join(named, "k", "left_semi").groupBy("k").agg(F.count(F.lit(1)).alias("sound"))
            taken = lost[p, k] = _few([*lost.get((p, k), []), *([_per_key(frontier[p].select(F.col(k).alias("k"), F.lit(1).alias("lost")))] if n > 1 else [])])
            both = named.join(sound, "k", "left")
            both = both.join(_per_key(reduce(DataFrame.unionByName, taken).join(named, "k", "left_semi")), "k", "left") if taken else both.withColumn("lost", F.lit(None).cast("long"))
            gone[p, k] = materialize(both.filter(F.coalesce("sound", F.lit(0)) == F.coalesce("lost", F.lit(0))).select("k"), f"fk-gone-{n}")
        frontier = {}
        for t, rows in whole.items():
            own = [e for e in edges if e.child == t and (e.parent, e.parent_key) in gone]
            identity_of = [c for c in rows.columns if c not in ("depth", "key_name")]
            added: DataFrame | None = None
            for e in own:
                hit = rows.join(gone[e.parent, e.parent_key], F.col(e.child_key) == F.col("k"), "left_semi").withColumn("key_name", F.lit(e.child_key))
                hit = hit if added is None else hit.join(added, [hit[c].eqNullSafe(added[c]) for c in identity_of], "left_anti")
                added = hit if added is None else added.unionByName(hit)
            if added is None:
                continue
            # A key is lost once, so only another key can lead to a row a second time.
            for old in found[t][1:] if len({e.child_key for e in edges if e.child == t}) > 1 else []:
                added = added.join(old, [added[c].eqNullSafe(old[c]) for c in identity_of], "left_anti")
            new = materialize(added.withColumn("depth", F.lit(n)), f"fk-{t}-{n}")
            if not new.isEmpty():
                frontier[t] = new
                found[t].append(new)
        if not frontier:
            return found
    raise AssertionError


def cascade(spark: SparkSession, tables: dict[str, DataFrame], edges: Sequence[Edge]) -> DataFrame:
    """Direct and inherited orphans as (``table_name``, ``key_name``, ``key``, ``reason``, ``depth``, ``n_rows``).

    A row is a direct orphan (depth 0) when a non-null foreign key of it has no parent row, and an inherited
    one (depth n + 1) when every parent row that it names by some key is an orphan of depth n or less. The
    fixpoint is reached by semi joins down the graph, one round per level; a cycle ends because a row gets a
    depth once only. Each table is first reduced to its distinct combinations of key columns with a count,
    so repeated rows and hot keys are aggregated before any join, and what each round adds is written to the
    shared folder, which cuts lineage. Tables without rows give no orphans; null keys refer to nothing.
    """
    keys: dict[str, list[str]] = {t: [] for t in tables}
    for e in edges:
        for t, k in ((e.child, e.child_key), (e.parent, e.parent_key)):
            if k not in keys[t]:
                keys[t].append(k)
    base = {t: materialize(tables[t].select(*[identity(F.col(f"`{k}`")).alias(k) for k in ks]).groupBy(*ks).agg(F.count(F.lit(1)).alias("n_rows")), f"fk-{t}") for t, ks in keys.items() if ks}
    state: dict[str, DataFrame] = {}
    for t, rows in base.items():
        depth, why = F.lit(None).cast("int"), F.lit(None).cast("string")
        for i, e in enumerate(x for x in edges if x.child == t):
            known = base[e.parent].select(F.col(e.parent_key).alias(f"p{i}")).filter(F.col(f"p{i}").isNotNull()).distinct()
            rows = rows.join(known, F.col(e.child_key) == F.col(f"p{i}"), "left")
            dangling = F.col(e.child_key).isNotNull() & F.col(f"p{i}").isNull()
            depth, why = F.coalesce(depth, F.when(dangling, F.lit(0))), F.coalesce(why, F.when(dangling, F.lit(e.child_key)))
        state[t] = materialize(rows.select(*keys[t], "n_rows", depth.alias("depth"), why.alias("key_name")), f"fk-{t}-0")
    out: DataFrame | None = None
    for t, rows in ((t, r) for t, rounds in _inherit(state, edges).items() for r in rounds):
        by_name = F.lit(None).cast("string")
        for k in keys[t]:
            by_name = F.when(F.col("key_name") == k, F.col(k)).otherwise(by_name)
        part = rows.select(F.lit(t).alias("table_name"), "key_name", by_name.alias("key"), F.when(F.col("depth") == 0, MISSING).otherwise(INHERITED).alias("reason"), "depth", "n_rows")
        out = part if out is None else out.unionByName(part)
    assert out is not None
    return out.groupBy("table_name", "key_name", "key", "reason", "depth").agg(F.sum("n_rows").alias("n_rows"))


def cascade_references(refs: Sequence[Reference], parent: DataFrame, children: Sequence[tuple[str, str]] = ()) -> DataFrame:
    """Direct and inherited orphans as (``table_name``, ``period``, ``key``, ``reason``, ``depth``), distinct.

    The direct orphans of ``direct_orphans`` are those of depth 0, with their reasons. ``children`` names pairs
    (child, parent) of the tables in ``refs`` that also refer to each other by the key: a row without a reason
    of its own is ``inherited`` (depth n + 1) when every row of such a parent with its key is an orphan of depth
    n or less. Keys without a row in that parent inherit nothing. References are reduced to distinct ones per
    month and grade before the first join, and written once.
    """
    rows = materialize(graded(refs, parent), "graded")
    start = rows.select("table_name", "period", "key", "reason", F.when(F.col("reason").isNotNull(), F.lit(0)).alias("depth"), F.lit(None).cast("string").alias("key_name"))
    state = {r.name: start.filter(F.col("table_name") == r.name) for r in refs}
    out: DataFrame | None = None
    found = _inherit(state, [Edge(child, "key", of, "key") for child, of in children])
    for part in (r for rounds in found.values() for r in rounds):
        part = part.select("table_name", "period", "key", F.coalesce("reason", F.lit(INHERITED)).alias("reason"), "depth")
        out = part if out is None else out.unionByName(part)
    assert out is not None
    return out
