"""Edge cases of the general operators: nulls, empty tables, ties, repeated rows, clashing columns, hot keys."""

import random
import uuid
from datetime import datetime

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from driftmark.functions.ids import canonical_uuid, identity
from driftmark.operators.changelog import ChangeSpec, ChangeStore, ConcurrentCommit
from driftmark.operators.dedupe import deduplicate, redundant_copies
from driftmark.operators.incremental import ChangeLog, ConcurrentAttempt, IncrementalJob, Sink, message_positions
from driftmark.operators.orphans import Edge, Reference, cascade, cascade_references, direct_orphans, parents
from driftmark.session import new_folder

U = [str(uuid.UUID(int=i + 1, version=4)) for i in range(40)]


def test_uuid_spellings(spark):
    u = "01234567-89ab-4cde-8f01-23456789abcd"
    rows = [(x,) for x in (u, u.upper(), f"{{{u}}}", f"urn:uuid:{u}", u.replace("-", ""), f" {u}\t", f" {u}　", u[:-1], u + "0", "unknown", "", None)]
    got = spark.createDataFrame(rows, "c string").select(canonical_uuid(F.col("c")), identity(F.col("c"))).collect()
    assert [r[0] for r in got] == [u] * 7 + [None] * 5
    assert [r[1] for r in got][7:] == [u[:-1], u + "0", "unknown", "", None]


# Change store

CHANGES = "k string, n int, op string, batch int, note string, bucket string, run string"


def _spec(*payload):
    return ChangeSpec(F.col("k"), F.col("n"), F.col("op"), payload)


def _store(spark, **kw):
    return ChangeStore(spark, new_folder(spark, "lsm"), **kw)


def _hash(note):
    import xxhash

    n = xxhash.xxh64('{"note":"%s"}' % note, seed=42).intdigest()
    return n - 2**64 if n >= 2**63 else n


def test_change_store_against_brute_force(spark):
    rng = random.Random(5)
    rows = [(rng.choice(U[:12] + [None]), rng.choice([None, 0, *range(1, 9)]), rng.choice(["upserted"] * 6 + ["deleted", "Deleted", None]), b, f"x{b}", "clash", None) for b in range(5) for _ in range(60)]
    rows += [(U[0], 3, "upserted", 4, "hot", None, None)] * 150  # a key with a third of all rows
    rng.shuffle(rows)
    best = {}
    for k, n, op, _, note, *_ in rows:
        if k is not None and n is not None and op in ("upserted", "deleted"):
            best[k] = max(best.get(k, (-1, False, 0, "")), (n, op == "deleted", _hash(note), note))
    want = {(k, n) for k, (n, dead, *_) in best.items() if not dead}
    df = spark.createDataFrame(rows, CHANGES)
    store = _store(spark, buckets=3, fan_in=2)
    for b in range(5):  # one run per batch, out of order
        store.append(df.filter(F.col("batch") == (b * 2) % 5), _spec("note"))
    got = {(r["dm_key"], r["dm_seq"], r["note"]) for r in store.current().collect()}
    assert {(k, n) for k, n, _ in got} == want
    assert all(note == best[k][3] for k, _, note in got)
    assert store.compact() == 1 and len(store.runs()) == 1 and not store.compact(force=True)
    assert {(r["dm_key"], r["dm_seq"], r["note"]) for r in store.current().collect()} == got
    # A late repetition of every upsert changes nothing and revives nothing.
    store.append(df.filter("op = 'upserted'"), _spec("note"))
    assert {(r["dm_key"], r["dm_seq"]) for r in store.current().collect()} == want


def test_older_upsert_after_compaction_revives_nothing(spark):
    store = _store(spark, buckets=2)
    rows = [[(U[0], 5, "deleted"), (U[1], 1, "upserted")], [(U[1], 2, "upserted")], [(U[0], 3, "upserted")], [(U[0], 5, "upserted")], [(U[0], 6, "upserted")]]
    runs = [spark.createDataFrame([(k, n, op, 0, None, None, None) for k, n, op in r], CHANGES) for r in rows]
    store.append(runs[0], _spec())
    store.append(runs[1], _spec())
    live = lambda: sorted((r["dm_key"], r["dm_seq"]) for r in store.current().collect())
    for late in runs[2:4]:
        assert store.compact(force=True) and len(store.runs()) == 1
        store.append(late, _spec())
        assert live() == [(U[1], 2)]
    assert store.compact(force=True)
    store.append(runs[4], _spec())
    assert live() == sorted([(U[0], 6), (U[1], 2)])


def test_change_store_empty_and_reopened(spark):
    store = _store(spark, buckets=2)
    assert store.current().count() == 0
    store.append(spark.createDataFrame([], CHANGES), _spec())
    assert store.current().count() == 0
    store.append(spark.createDataFrame([(U[0], 2, "upserted", 0, None, None, None)], CHANGES), _spec())
    again = ChangeStore(spark, store.root)
    assert again.buckets == 2 and [r["dm_seq"] for r in again.current().collect()] == [2]


def test_lost_commit_is_not_visible(spark):
    store = _store(spark, buckets=2)
    one = spark.createDataFrame([(U[0], 1, "upserted", 0, None, None, None)], CHANGES)
    store.append(one, _spec())
    flat = one.select(F.lit(0).alias("run"), F.col("k").alias("dm_key"), F.lit(9).cast("long").alias("dm_seq"), F.lit(True).alias("dm_dead"))
    store._write(flat, "never-committed")  # the driver died before its manifest
    assert [r["dm_seq"] for r in store.current().collect()] == [1]
    store.folder.create(store._manifest(2), store.manifest() | {"version": 2})
    with pytest.raises(ConcurrentCommit):
        store._commit(lambda m: m | {"version": 2}, attempts=2)


def test_merge_reads_in_small_batches(spark):
    from driftmark.operators.changelog import merge_files
    from pyspark.sql import types as T
    from pyspark.sql.pandas.types import to_arrow_schema

    store = _store(spark, buckets=1)
    rows = [(U[i % 40], i // 40 + 1, "upserted", 0, None, None, None) for i in range(200)]
    names = []
    for part in range(4):
        names += store.append(spark.createDataFrame(rows[part::4], CHANGES), _spec())
    schema = to_arrow_schema(T.StructType.fromJson(__import__("json").loads(store.manifest()["schema"])))
    got = [r for b in merge_files(store.root, names, 0, schema, rows=3) for r in b.to_pylist()]
    assert {(r["dm_key"], r["dm_seq"]) for r in got} == {(u, 5) for u in U} and len(got) == 40


def test_levels_bound_what_is_rewritten(spark):
    store = _store(spark, buckets=1, fan_in=3)
    for n in range(1, 10):
        store.append(spark.createDataFrame([(U[0], n, "upserted", 0, None, None, None), (U[n], n, "deleted", 0, None, None, None)], CHANGES), _spec())
        store.compact()
    # Nine runs became three of level 1 and those one of level 2: each change was rewritten twice.
    assert [r["level"] for r in store.manifest()["runs"]] == [2]
    assert store.manifest()["version"] == 9 + 3 + 1
    assert [(r["dm_key"], r["dm_seq"]) for r in store.current().collect()] == [(U[0], 9)]


def test_concurrent_writers_lose_nothing(spark):
    from concurrent.futures import ThreadPoolExecutor

    store = _store(spark, buckets=2, fan_in=3)

    def write(w):
        own = ChangeStore(spark, store.root, fan_in=3)
        for n in range(2):
            own.append(spark.range(500).select(F.concat(F.lit(f"{w}-{n}-"), "id").alias("k"), F.lit(1).alias("n"), F.lit("upserted").alias("op")), _spec())

    with ThreadPoolExecutor(4) as pool:
        list(pool.map(write, range(4)))
    assert len(store.runs()) == 8 and store.current().count() == 4000


def test_commits_exclude_each_other(spark):
    from concurrent.futures import ThreadPoolExecutor

    from driftmark.sources.files import Folder

    folder = Folder(spark, new_folder(spark, "folder"))
    with ThreadPoolExecutor(8) as pool:
        won = list(pool.map(lambda n: folder.create("x.json", {"n": n}), range(8)))
    assert sum(won) == 1 and folder.load("x.json") == {"n": won.index(True)} and folder.names() == ["x.json"]


# Deduplication


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["a", "B", None]), st.sampled_from([1, 2, None]), st.integers(0, 50)), max_size=30))
def test_copies_against_brute_force(spark, rows):
    rows = [(i, a, b, t, "clash") for i, (a, b, t) in enumerate(rows)]
    df = spark.createDataFrame(rows, "id long, a string, b int, t int, k0 string")
    first = {}
    for i, a, b, t, _ in rows:
        if a is not None and b is not None:
            first[(a, b)] = min(first.get((a, b), (99, 99)), (t, i))
    want = {i for i, a, b, t, _ in rows if a is not None and b is not None and first[(a, b)] != (t, i)}
    assert {r["id"] for r in redundant_copies(df, ["a", "b"], ["t", "id"]).collect()} == want
    kept = deduplicate(df, ["a", "b"], ["t", "id"])
    assert kept.columns == df.columns
    assert sorted(r["id"] for r in kept.collect()) == sorted(set(range(len(rows))) - want)


def test_copies_of_identical_rows_and_spellings(spark):
    u = U[0]
    df = spark.createDataFrame([(u, 1, 5), (u.upper(), 1, 6), (f"{{{u}}}", 1, 7), (u, 1, 5), (None, 1, 5), ("bad", 1, 1), ("bad", 1, 2)], "e string, v int, t int")
    assert sorted(r["t"] for r in redundant_copies(df, ["e", "v"], ["t"]).collect()) == [2, 6, 7]
    assert sorted(r["t"] for r in deduplicate(df, ["e", "v"], ["t"]).collect()) == [1, 5, 5]
    assert redundant_copies(df.limit(0), ["e", "v"], ["t"]).count() == 0 == deduplicate(df.limit(0), ["e", "v"], ["t"]).count()


def test_copies_where_the_order_is_not_unique(spark):
    rows = [("m1", 10, 0), ("m1", 20, 1), ("m2", 20, 2), ("m2", 20, 3), ("m3", None, 4), ("m3", 1, 5)]
    df = spark.createDataFrame([(*r, {"k": r[2]}) for r in rows], "m string, t int, id int, more map<string,int>")
    got = {r["id"] for r in redundant_copies(df, ["m"], ["t"]).collect()}
    assert got in ({1, 2, 5}, {1, 3, 5}) and got == {r["id"] for r in redundant_copies(df.repartition(3), ["m"], ["t"]).collect()}
    assert {r["id"] for r in deduplicate(df, ["m"], ["t"]).collect()} == set(range(6)) - got


# Incremental runs

LOG = "key string, offset long"
POSITIONS = "key string, offset long, partition int, position long"


def _held(sink):
    return sorted((r["key"], r["offset"]) for r in sink.rows().collect())


def _job(spark):
    root = new_folder(spark, "inc")
    return IncrementalJob(spark, f"{root}/job"), Sink(spark, f"{root}/sink", LOG), ChangeLog(spark, f"{root}/log", 2)


def test_failed_run_is_replayed_not_planned_anew(spark):
    job, sink, log = _job(spark)
    log.capture(spark.createDataFrame([("a", 1), ("b", 3)], LOG))
    with pytest.raises(ZeroDivisionError):
        job.run(log.records(), sink, lambda df: 1 // 0)
    assert job.open_run() == 1 and _held(sink) == []
    sink.write(spark.createDataFrame([("a", 1)], LOG), 1)  # half of it had been written
    log.capture(spark.createDataFrame([("a", 2), ("b", 3), ("b", 2), ("c", 1)], LOG))
    assert job.run(log.records(), sink, lambda df: df) == 1 and _held(sink) == [("a", 1), ("b", 3)]
    assert job.run(log.records(), sink, lambda df: df) == 2 and _held(sink) == [("a", 1), ("a", 2), ("b", 3), ("c", 1)]
    assert job.run(log.records(), sink, lambda df: df) == 3 and len(_held(sink)) == 4  # nothing new
    assert job.folder.load("done-000000002.json")["records"] == 2 and job.committed() == log.ends()
    assert IncrementalJob(spark, job.root).open_run() is None


def test_replay_after_a_lost_commit_keeps_all_rows_of_a_record(spark):
    job, sink, log = _job(spark)
    log.capture(spark.createDataFrame([("a", 1), ("b", 3)], LOG))
    twice = lambda df: df.unionAll(df)
    run = job.plan(log.records(), sink.held())
    sink.write(twice(job.planned(run)), run)  # all written, the driver died before the commit
    assert job.open_run() == run and job.run(log.records(), sink, twice) == run
    assert _held(sink) == [("a", 1), ("a", 1), ("b", 3), ("b", 3)] and job.open_run() is None


def test_of_two_drivers_on_one_run_one_is_refused(spark):
    job, sink, log = _job(spark)
    log.capture(spark.createDataFrame([("a", 1)], LOG))

    def slow(df):
        job.run(log.records(), sink, lambda rows: rows)  # the other driver is done before this one writes
        return df

    with pytest.raises(ConcurrentAttempt):
        job.run(log.records(), sink, slow)
    assert _held(sink) == [("a", 1)]


def test_empty_log_and_nulls(spark):
    job, sink, log = _job(spark)
    assert log.capture(spark.createDataFrame([], LOG)) == {}
    job.run(log.records(), sink, lambda df: df)
    assert _held(sink) == []
    log.capture(spark.createDataFrame([(None, 1), ("a", None), ("b", 2), ("b", 2), ("b", 1)], LOG))
    job.run(log.records(), sink, lambda df: df)
    assert _held(sink) == [("b", 2)]


def test_capture_numbers_changes_per_partition(spark):
    _, _, log = _job(spark)
    log.capture(spark.createDataFrame([(k, 1) for k in U], LOG))
    ends = log.capture(spark.createDataFrame([(k, 2 - i % 2) for i, k in enumerate(U)], LOG))
    rows = log.records().collect()
    assert len(rows) == 60 and ends == log.ends() and sum(ends.values()) == 58
    for p in ends:
        assert sorted(r["position"] for r in rows if r["partition"] == p) == list(range(ends[p] + 1))
    assert all(r["position"] >= 10 for r in rows if r["offset"] == 2)


def test_adopted_positions_end_before_what_the_sink_lacks(spark):
    job, _, _ = _job(spark)
    log = spark.createDataFrame([("a", 1, 0, 0), ("b", 2, 0, 1), ("c", 1, 0, 2), ("d", 1, 1, 7), ("e", 1, 1, 8), ("f", 1, 2, 3)], POSITIONS)
    sink = spark.createDataFrame([("a", 1), ("c", 5), ("d", 1), ("e", 1)], LOG)
    assert job.adopt(log, sink) == {0: 0, 1: 8} == job.adopt(log.limit(0), sink)
    run = job.plan(log, sink)
    assert sorted(r["key"] for r in job.planned(run).collect()) == ["b", "f"]


def test_message_positions(spark):
    rows = [(p, o) for p in (0, 1, 2) for o in range(4)] + [(None, 1), (1, None)]
    df = spark.createDataFrame(rows, "p int, o long")
    assert sorted((r["p"], r["o"]) for r in message_positions(df, "p", "o", {0: 2, 1: 3}).collect()) == [(0, 3), (2, 0), (2, 1), (2, 2), (2, 3)]
    assert message_positions(df, "p", "o", {}).count() == 12


def test_message_log_goes_by_committed_positions(spark):
    root = new_folder(spark, "inc")
    job, sink = IncrementalJob(spark, f"{root}/job", ("p", "o")), Sink(spark, f"{root}/sink", LOG)
    f = lambda rows: spark.createDataFrame(rows, "key string, offset long, p int, o long")
    rows = [("a", 1, 0, 0), ("a", 2, 0, 1), ("b", 1, 1, 5), (None, 1, 1, 6), ("x", 9, None, 1)]
    assert job.run(f(rows), sink, lambda df: df) == 1 and _held(sink) == [("a", 2), ("b", 1)]
    assert job.committed() == {0: 1, 1: 6}
    # Positions up to the committed ones are not read again, even where the sink holds nothing of them.
    empty = spark.createDataFrame([], LOG)
    more = f([*rows, ("c", 1, 0, 2), ("d", 1, 2, 0), ("z", 1, 1, 6)])
    run = job.plan(more, empty)
    assert sorted(r["key"] for r in job.planned(run).collect()) == ["c", "d"]
    later = f([*rows, ("c", 1, 0, 2), ("d", 1, 2, 0), ("e", 1, 0, 3)])  # replayed as planned, though more has come
    assert job.run(later, sink, lambda df: df) == run and job.committed() == {0: 2, 1: 6, 2: 0}
    assert job.run(later, sink, lambda df: df) == run + 1 and job.committed() == {0: 3, 1: 6, 2: 0}
    assert _held(sink) == [("a", 2), ("b", 1), ("c", 1), ("d", 1), ("e", 1)]


# Orphans


def _t(day):
    return datetime(2025, 3, day)


def test_direct_orphans(spark):
    docs = spark.createDataFrame([(U[0], 1, False, _t(5)), (U[0], 2, True, _t(5)), (U[1], 1, False, _t(10)), (U[1], 1, False, _t(10)), (None, 1, False, _t(1)), (U[2], None, None, _t(2))], "id string, version int, deleted boolean, first_loaded_at timestamp")
    refs = spark.createDataFrame([(U[0].upper(), _t(6), False), (U[0], _t(4), True), (U[1], _t(9), None), (U[1], _t(11), False), (U[3], _t(1), False), (U[3], _t(1), False), (None, _t(1), False), (U[1], None, False)], "document_id string, loaded_at timestamp, deleted boolean")
    found = direct_orphans([Reference("r", refs.withColumn("key", F.lit("clash")), "document_id", "loaded_at", ~F.col("deleted"))], parents(docs, "id", "version", "deleted", "first_loaded_at"))
    assert sorted((r["period"], r["key"], r["reason"]) for r in found.collect()) == sorted([("2025-03", U[0], "deleted"), ("2025-03", U[0], "late"), ("2025-03", U[1], "late"), ("2025-03", U[3], "missing")])
    empty = direct_orphans([Reference("r", refs.limit(0), "document_id", "loaded_at")], parents(docs.limit(0), "id", "version", "deleted", "first_loaded_at"))
    assert empty.count() == 0


def test_cascade_reaches_a_fixpoint(spark):
    f = lambda rows, schema: spark.createDataFrame(rows, schema)
    tables = {
        "a": f([("1",), ("2",)], "id string"),
        "b": f([("b1", "1"), ("b2", "9"), ("b3", None), ("b2", "9")], "id string, a string"),
        "c": f([("c1", "b1"), ("c2", "b2"), ("c3", "b7")], "id string, b string"),
        "d": f([("c2",), ("c1",), ("c3",), (None,), ("c2",)], "c string"),
    }
    edges = [Edge("b", "a", "a", "id"), Edge("c", "b", "b", "id"), Edge("d", "c", "c", "id")]
    got = {tuple(r) for r in cascade(spark, tables, edges).collect()}
    assert got == {("b", "a", "9", "missing", 0, 2), ("c", "b", "b2", "inherited", 1, 1), ("c", "b", "b7", "missing", 0, 1), ("d", "c", "c2", "inherited", 2, 2), ("d", "c", "c3", "inherited", 1, 1)}
    assert cascade(spark, {t: df.limit(0) for t, df in tables.items()}, edges).count() == 0


def test_cascade_starts_from_all_direct_orphans_by_month(spark):
    docs = spark.createDataFrame([(U[0], 1, True, _t(5)), (U[1], 1, False, _t(10)), (U[2], 1, False, _t(1))], "id string, version int, deleted boolean, first_loaded_at timestamp")
    f = lambda rows: spark.createDataFrame(rows, "document_id string, loaded_at timestamp")
    state = f([(U[0], _t(6)), (U[1], _t(9)), (U[2], _t(2)), (U[3], _t(2))])
    april = datetime(2025, 4, 2)
    chunks = f([(U[0], april), (U[1], _t(8)), (U[1], _t(12)), (U[1], april), (U[2], _t(3)), (U[3], _t(3)), (None, _t(3))])
    notes = f([(U[0], _t(20)), (U[1], april), (U[2], _t(3))])
    refs = [Reference("notes", notes, "document_id", "loaded_at"), Reference("chunks", chunks, "document_id", "loaded_at"), Reference("state", state, "document_id", "loaded_at", F.lit(True))]
    got = {tuple(r) for r in cascade_references(refs, parents(docs, "id", "version", "deleted", "first_loaded_at"), [("chunks", "state"), ("notes", "chunks")]).collect()}
    assert got == {
        ("state", "2025-03", U[0], "deleted", 0), ("state", "2025-03", U[1], "late", 0), ("state", "2025-03", U[3], "missing", 0),
        ("chunks", "2025-04", U[0], "inherited", 1), ("chunks", "2025-03", U[1], "late", 0), ("chunks", "2025-03", U[1], "inherited", 1),
        ("chunks", "2025-04", U[1], "inherited", 1), ("chunks", "2025-03", U[3], "missing", 0),
        ("notes", "2025-03", U[0], "inherited", 2), ("notes", "2025-04", U[1], "inherited", 2),
    }


def test_cascade_of_many_levels_and_several_parents(spark):
    # Of 12 there is a second row in a cycle, which no orphan reaches, so nothing below 12 is lost.
    chain = spark.createDataFrame([(str(i), str(i - 1)) for i in range(15)] + [("12", "c"), ("c", "c"), ("y", "3")], "id string, of string")
    got = cascade(spark, {"c": chain}, [Edge("c", "of", "c", "id")])
    assert {(r["key"], r["depth"]) for r in got.collect()} == {(str(i - 1), i) for i in range(13)}


def test_shared_folder_as_uri(spark, tmp_path):
    from driftmark.session import as_uri, fresh_name, shared_root

    assert as_uri("/a/b/") == "file:///a/b" == as_uri("file:/a/b") == as_uri("file:///a/b")
    assert as_uri("hdfs://host:9000/x") == "hdfs://host:9000/x" and as_uri("hdfs:/x") == "hdfs:///x"
    assert shared_root(spark) == spark.conf.get("spark.checkpoint.dir")
    assert fresh_name(spark.createDataFrame([(1, 2)], "__K int, ___k int"), "k") == "____k"
