"""Runs: stored versions, ranges and state, plans of the executed queries, catalogue and settings."""

import datetime as dt
import re
import uuid

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import names
from tidemark.operators import incremental, load, merge, partition, scan, state, validate
from tidemark.plans import config, ddl, sync, transfer
from tidemark.sources import metadata, shared, spec
from tidemark.streaming import merge_stream

NOW = dt.datetime(2024, 3, 1, 12)
DERBY = {"driver": "org.apache.derby.jdbc.EmbeddedDriver"}


@pytest.fixture
def store(spark, tmp_path):
    return load.Store(spark, str(tmp_path / "store"))


def rows(spark, pairs):
    return spark.createDataFrame(list(pairs), "k long, v string")


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


# store


def test_ranges_are_written_where_they_change(spark, store):
    store.publish("t", rows(spark, ((i, "a") for i in range(100))), "k", [25, 50, 75])
    before = store.manifest("t")["parts"]
    done = incremental.merge_staged(store, "t", shared.written(rows(spark, [(30, "b"), (49, "a"), (1000, "n")])), ["k"], NOW)
    assert (done.inserted, done.updated, done.unchanged) == (1, 1, 1)
    after = store.manifest("t")["parts"]
    assert after[0] == before[0] and after[2] == before[2] and after[1] != before[1] and after[3] != before[3]
    assert {r.k: r.v for r in store.read("t").collect()} == {i: "b" if i == 30 else "a" for i in range(100)} | {1000: "n"}
    assert store.read("t", [1]).count() == 25
    version = store.version("t")
    assert incremental.merge_staged(store, "t", shared.written(rows(spark, [])), ["k"], NOW).staged == 0 and store.version("t") == version


def test_empty_ranges_nulls_and_vacuum(spark, store):
    store.publish("t", rows(spark, [(None, "n"), (5, "a")]), "k", [3, 10])
    assert [len(x) for x in store.manifest("t")["parts"]] == [1, 1, 0]
    store.truncate("t")
    assert store.read("t").count() == 0 and store.read("t").columns == ["k", "v"] and not store.has_data("t")
    store.publish("t", rows(spark, [(1, "x")]))
    assert store.vacuum("t") == [] and len(store.vacuum("t", 0)) == 2 and store.read("t").count() == 1 and store.vacuum("t", 0) == []


def test_of_two_writers_one_fails(spark, store):
    store.publish("t", rows(spark, [(1, "a")]))
    old = store.version("t")
    store.publish("t", rows(spark, [(1, "b")]))
    with pytest.raises(load.Conflict):
        store.publish("t", rows(spark, [(1, "c")]), expect=old)
    store.publish("t", rows(spark, [(1, "d")]), expect=store.version("t"))
    assert store.read("t").first().v == "d"


def test_a_killed_writer_needs_no_hand(spark, store):
    """Files and a manifest that was never renamed are all that it leaves."""
    store.publish("t", rows(spark, [(1, "a")]))
    rows(spark, [(1, "b")]).write.parquet(f"{store.root}/t/d1-dead/__range=0")
    store._put("{}", "t", "_NEW-dead")
    store.publish("t", rows(spark, [(1, "c")]))
    assert store.read("t").first().v == "c"
    store.vacuum("t", 0)
    assert sorted(n[:1] for n in store._names("t")) == ["_", "d"]


def test_of_writers_at_once_one_wins(spark, store):
    from concurrent.futures import ThreadPoolExecutor

    store.publish("t", rows(spark, [(0, "a")]))
    old = store.version("t")

    def write(i):
        try:
            return bool(store.publish("t", rows(spark, [(i, "b")]), expect=old))
        except load.Conflict:
            return False

    with ThreadPoolExecutor(6) as pool:
        won = [i for i, ok in enumerate(pool.map(write, range(6))) if ok]
    assert len(won) == 1 and store.read("t").first().k == won[0]


def test_vacuum_spares_a_writer_at_work(spark, store, monkeypatch):
    store.publish("t", rows(spark, [(1, "a")]))
    grace = load.GRACE
    names = store._names

    def vacuumed(*parts):
        if len(parts) == 2:
            load.Store(spark, store.root).vacuum("t", grace)
        return names(*parts)

    monkeypatch.setattr(store, "_names", vacuumed)
    store.publish("t", rows(spark, [(1, "b")]))  # vacuum runs before the manifest is written: the files stay
    assert store.read("t").first().v == "b"
    grace = -60
    with pytest.raises(load.Conflict, match="deleted"):
        store.publish("t", rows(spark, [(1, "c")]))
    assert load.Store(spark, store.root).read("t").first().v == "b"


def test_thousands_of_ranges(spark, store):
    import time

    edges = list(range(10, 50_010, 10))
    began = time.time()
    out = spark.range(50_020).select("id", load.range_of(F.col("id"), edges, T.LongType()).alias("r")).where("r != least(id div 10, 5000)")
    assert out.count() == 0 and time.time() - began < 10
    texts = [f"k{i:03}" for i in range(0, 600, 50)]
    got = spark.createDataFrame([(None,), ("a",), ("k000",), ("k049",), ("k050",), ("k549",), ("k550",), ("z",)], "k string").select(load.range_of(F.col("k"), texts, T.StringType())).collect()
    assert [r[0] for r in got] == [0, 0, 1, 1, 2, 11, 12, 12]


def test_a_reload_writes_the_ranges_it_meets(spark, store):
    store.publish("t", rows(spark, ((i, "a") for i in range(400))), "k", [100, 200, 300])
    before = store.manifest("t")["parts"]
    source = rows(spark, ((i, "b") for i in range(400)))
    done = load.transfer_range(store, "t", source, ["k"], (110,), (120,))
    after = store.manifest("t")["parts"]
    assert done.success and done.rows == 11
    assert [a == b for a, b in zip(after, before)] == [True, False, True, True] and [len(x) for x in after] == [1] * 4
    assert {r.k for r in store.read("t").where("v = 'b'").collect()} == set(range(110, 121)) and store.read("t").count() == 400
    assert load.met_ranges({"key": "k", "edges": [100, 200, 300]}, "k", 300, None) == [3] and load.met_ranges({"key": "k", "edges": [100]}, "x", 1, 2) == [0, 1]


def test_a_failed_publish_leaves_the_old_version(spark, store):
    store.publish("t", rows(spark, [(1, "a")]))
    bad = rows(spark, [(1, "b")]).withColumn("v", F.raise_error(F.lit("lost")).cast("string"))
    with pytest.raises(Exception, match="lost"):
        store.publish("t", bad)
    assert store.read("t").first().v == "a"
    store.publish("t", rows(spark, [(1, "c")]))


def test_a_cluster_needs_a_shared_folder():
    class Conf:
        def get(self, *_):
            return None

    class Session:
        conf = Conf()

        class sparkContext:  # noqa: N801
            master = "spark://host:7077"

            @staticmethod
            def getConf():  # noqa: N802
                return Conf()

    with pytest.raises(RuntimeError, match="checkpoint.dir"):
        shared.shared_folder(Session())


# plans of queries


def test_small_increment_leaves_the_target_in_place(spark, tmp_path):
    rows(spark, ((i, "a") for i in range(1000))).write.parquet(str(tmp_path / "t"))
    target = spark.read.parquet(str(tmp_path / "t"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan_of(merge.merge(target, rows(spark, [(1, "b"), (2000, "n")]), ["k"], small=True))
        assert "SortMergeJoin" not in text and "ShuffledHashJoin" not in text
        large = merge.SMALL_ROWS
        merge.SMALL_ROWS = 1
        assert not merge.is_small(rows(spark, [(1, "b"), (2, "n")]), 1)
        merge.SMALL_ROWS = large
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_a_large_increment_leaves_a_target_in_ranges_in_place(spark, store, monkeypatch):
    monkeypatch.setattr(merge, "SMALL_ROWS", 150)
    monkeypatch.setattr(load.Store, "publish_ranges", lambda self, t, df, *a, f=load.Store.publish_ranges, **k: plans.append((plan_of(df), k["gather"])) or f(self, t, df, *a, **k))
    plans = []
    store.publish("t", rows(spark, ((i, "a") for i in range(800))), "k", list(range(100, 800, 100)))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        staged = shared.written(rows(spark, ((i, "b") for i in range(0, 900, 2))))
        done = incremental.merge_staged(store, "t", staged, ["k"], NOW)
        assert (done.inserted, done.updated, done.kept) == (50, 400, 400)
        text, gather = plans[0]
        assert not gather and "SortMergeJoin" not in text and "ShuffledHashJoin" not in text
        merge.SMALL_ROWS = 20  # a range alone has more: shuffled, with the same result
        again = incremental.merge_staged(store, "t", staged, ["k"], NOW)
        assert (again.inserted, again.updated, again.unchanged, again.kept) == (0, 0, 450, 400) and plans[1][1]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert {r.k: r.v for r in store.read("t").collect()} == {i: "a" if i % 2 else "b" for i in range(800)} | {i: "b" for i in range(800, 900, 2)}
    assert merge.broadcast_groups({0: 5, 1: 5, 2: 9, 4: 1}, 10) == [[0, 1], [2, 4]] and merge.broadcast_groups({0: 11}, 10) is None and merge.broadcast_groups({i: 9 for i in range(9)}, 10) is None


def test_tuple_ranges_reach_the_files(spark, tmp_path):
    spark.range(100).selectExpr("id a", "id % 7 b", "id c").write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    chosen = df.where(scan.in_range(df, ["a", "b"], (10, 2), (40, 1)))
    assert re.search(r"PushedFilters: \[.*GreaterThanOrEqual\(a,10\).*LessThanOrEqual\(a,40\)", plan_of(chosen))
    assert sorted(r.a for r in chosen.collect()) == [i for i in range(100) if (10, 2) <= (i, i % 7) <= (40, 1)]


def test_pages_by_number_with_ties_and_nulls(spark):
    df = spark.createDataFrame([(i // 2 or None, i, f"x{i}") for i in range(40)], "a int, b int, c string")
    want = sorted(((r.a is not None, r.a or 0, r.b, r.c) for r in df.collect()))
    for first, last in ((1, 3), (5, 11), (38, 60), (50, 60)):
        got = sorted((r.rn, r.b, r.c) for r in scan.row_number_page(df, ["a", "b"], first, last).collect())
        assert got == [(i + 1, want[i][2], want[i][3]) for i in range(first - 1, min(last, 40))]


def test_batch_check_is_one_shuffle(spark):
    pairs = {f"t{i}": (spark.range(i), spark.range(i + i % 2)) for i in range(6)}
    checks = validate.batch_check(pairs)
    got = {r.table_name: (r.source_count, r.target_count, r.row_difference, r.validation_passed) for r in checks.collect()}
    assert got == {f"t{i}": (i, i + i % 2, i % 2, i % 2 == 0) for i in range(6)}


# state and incremental runs


def source(spark, changed=()):
    day = lambda i: NOW - dt.timedelta(days=i % 10)
    data = [(i, "new" if i in changed else "old", None if i % 9 == 0 else NOW if i in changed else day(i)) for i in range(60)]
    return spark.createDataFrame(data, "k long, v string, m timestamp_ntz")


def test_incremental_run_with_state(spark, store):
    store.publish("things", source(spark).where("k < 50"))
    found = sync.discover(store, [sync.Source("Things", source(spark, {3, 55}), ("k",)), sync.Source("gone", source(spark), ("k",))], ["x", "m"])
    assert [(f.column, f.skipped) for f in found] == [("m", None), (None, "no target")]
    clock = iter(NOW + dt.timedelta(minutes=i) for i in range(100)).__next__
    first = sync.sync_table(store, found[0], ("dbo", "public"), "r1", clock)
    assert first["success"] and (first["rows_inserted"], first["rows_updated"]) == (10, 1)
    key = sync.state_key("things", ("dbo", "public"))
    known = state.SyncState.load(store)
    assert known.watermark(key) == NOW and known.rows[key]["sync_status"] == "completed" and known.last_sync(key)["rows_inserted"] == 10
    again = sync.sync_table(store, found[0], ("dbo", "public"), "r2", clock)
    assert (again["rows_inserted"], again["rows_updated"], again["rows_unchanged"]) == (0, 0, 7)  # undated rows are compared again
    assert [r["table_name"] for r in state.SyncState.load(store).by_status("completed")] == ["things"]


def test_ranges_resume_and_start_anew(spark, store):
    """What failed is tried again, what is done is not; the watermark is that of the first attempt; a completed run is followed by a whole one."""
    store.publish("t", source(spark).where("k < 0"))
    key, schemas = sync.state_key("t", ("dbo", "public")), ("dbo", "public")
    bad = source(spark).withColumn("v", F.when(F.col("k") > 40, F.raise_error(F.lit("lost")).cast("string")).otherwise(F.col("v")))
    clock = iter(NOW + dt.timedelta(minutes=i) for i in range(100)).__next__
    made = lambda df: sync.Found(sync.Source("t", df, ("k",)), "m")
    failed = sync.sync_table(store, made(bad), schemas, "r1", clock, threshold=1, most=3)
    assert not failed["success"] and store.read("t").count() == 30
    assert [p["status"] for p in state.SyncState.load(store).rows[key]["partition_info"]] == ["completed", "failed"]
    known = state.SyncState.load(store)
    assert [t.index for t in sync.tasks_for(made(source(spark)), known, key, NOW, "r2", 60, 1)] == [1]
    done = sync.sync_table(store, made(source(spark)), schemas, "r2", clock, threshold=1, most=3)
    assert done["success"] and done["rows_inserted"] == 30 and store.read("t").count() == 60
    known = state.SyncState.load(store)
    assert known.watermark(key) == NOW and known.rows[key]["retry_count"] == 1
    assert [t.index for t in sync.tasks_for(made(source(spark)), known, key, NOW, "r3", 60, 1)] == [0, 1]


def test_no_update_of_the_state_is_lost(spark, store):
    keys = [("full", t, "d", "p") for t in "ab"]
    one, two = state.SyncState.load(store), state.SyncState.load(store)
    one.start(keys[0], NOW, "r")
    two.start(keys[1], NOW, "r")
    one.save(store)
    with pytest.raises(load.Conflict):
        two.save(store)
    state.SyncState.update(store, lambda s: s.start(keys[1], NOW, "r"))
    assert set(state.SyncState.load(store).rows) == set(keys)
    tries = []

    def change(s):
        tries.append(s.version)
        if len(tries) == 1:  # another writer comes between
            other = state.SyncState.load(store)
            other.fail(keys[0], NOW, "x")
            other.save(store)
        s.complete(keys[1], NOW)

    state.SyncState.update(store, change)
    assert len(tries) == 2 and {r["sync_status"] for r in state.SyncState.load(store).rows.values()} == {"failed", "completed"}


def test_tables_are_synced_at_once(spark, store):
    names_ = [f"t{i}" for i in range(6)]
    for n in names_:
        store.publish(n, source(spark).where("k < 50"))
    sources = [sync.Source(n, source(spark), ("k",)) for n in names_] + [sync.Source("gone", source(spark), ("k",))]
    done = sync.sync_all(store, sources, "m", ("dbo", "public"), "r", lambda: NOW)
    assert [(r["table"], r["success"], r["rows"]) for r in done] == [(n, True, 60) for n in names_] + [("gone", True, 0)] and done[-1]["skipped"] == "no target"
    assert [r["sync_status"] for r in state.SyncState.load(store).rows.values()] == ["completed"] * 6


def test_a_state_counts_for_its_own_table_only(spark):
    s = state.SyncState()
    for key, ends in ((("full", "users", "erp", "p"), "failed"), (("full", "users", "crm", "p"), "completed"), (("incremental", "orders", "dbo", "public"), "completed")):
        s.start(key, NOW, "r1")
        s.fail(key, NOW, "x") if ends == "failed" else s.complete(key, NOW)
    tables = [{"name": "users", "rows": 1, "schemas": ("erp", "p")}, {"name": "users", "rows": 1, "schemas": ("crm", "p")}, {"name": "orders", "rows": 1}]
    made = transfer.plan(tables, s, "r2", lambda *a: [])
    assert made.mode == "RECOVERY" and [(t.table, t.schemas[0]) for t in made.tasks] == [("users", "erp"), ("orders", "dbo")] and made.skipped == ["users"]
    assert made.tasks[0].key == ("full", "users", "erp", "p")
    s.complete(("full", "users", "erp", "p"), NOW)
    assert transfer.begin(s, "r3", NOW) == "FRESH"
    assert {k[0]: r["sync_status"] for k, r in s.rows.items()} == {"full": "pending", "incremental": "completed"}


def test_the_first_error_cancels_the_others(spark):
    import time

    slow = F.udf(lambda x: time.sleep(0.5) or x, "long")

    def run(task):
        if task.index == 2:
            time.sleep(2)
            raise RuntimeError("lost")
        return {"rows": len(spark.range(400).repartition(4).select(slow("id")).collect())}

    tasks = [transfer.Task("t", "keys", i, 6, i) for i in range(5)]
    began = time.time()
    done = transfer.run_all(tasks, run, parallel=3, spark=spark, cancel_on_error=True)
    assert time.time() - began < 25
    assert [bool(r.get("pending")) for r in done] == [True, True, False, True, True] and done[2]["error"] == "lost" and not any(r["success"] for r in done)
    assert spark.range(3).count() == 3 and not spark.sparkContext.getJobTags()


def test_mode_and_retries():
    s = state.SyncState()
    for t in "abc":
        s.start(("full", t, "d", "p"), NOW, "r1")
    s.complete(("full", "a", "d", "p"), NOW)
    assert transfer.begin(s, "r2", NOW) == "FRESH" and {r["sync_status"] for r in s.rows.values()} == {"pending"}
    s.start(("full", "b", "d", "p"), NOW, "r2")
    s.fail(("full", "b", "d", "p"), NOW, "x")
    assert transfer.mode_of(s, "r2") == "FRESH" and transfer.begin(s, "r3", NOW) == "RECOVERY"
    waits, tries = [], []

    def flaky(task):
        tries.append(task.table)
        if len(tries) < 3:
            raise RuntimeError("busy")
        return {"rows": 5}

    assert transfer.run_all([transfer.Task("t", "regular")], flaky, retries=3, delay=30, sleep=waits.append)[0] == {"table": "t", "success": True, "attempts": 3, "rows": 5}
    assert waits == [30, 30]
    assert [transfer.page_mode(k) for k in (["a"], ["a", "b"], [])] == ["keyset", "row_number", "whole"]
    assert partition.parallel(2, 400, 200) and not partition.parallel(1, 400, 200) and not partition.parallel(2, 399, 200)


def test_stream_batches_replay_to_the_same(spark, store):
    store.publish("t", rows(spark, [(1, "a")]).withColumn("at", F.lit(0)))
    batch = spark.createDataFrame([(1, "b", 5), (1, "c", 5), (2, "d", 1)], "k long, v string, at int")
    for _ in range(2):
        merge_stream.merge_batch(store, "t", batch, ["k"], "at")
        assert sorted(map(tuple, store.read("t").collect())) == [(1, "c", 5), (2, "d", 1)]
    late = spark.createDataFrame([(1, "late", 4), (2, "new", 1), (3, "f", None)], batch.schema)
    merge_stream.merge_batch(store, "t", late, ["k"], "at")
    merge_stream.merge_batch(store, "t", spark.createDataFrame([(1, "undated", None)], batch.schema), ["k"], "at")
    assert sorted(map(tuple, store.read("t").collect())) == [(1, "c", 5), (2, "new", 1), (3, "f", None)]
    with pytest.raises(ValueError, match="null"):
        merge_stream.merge_batch(store, "t", batch.union(spark.createDataFrame([(None, "e", 1)], batch.schema)), ["k"], "at")


def test_validation_message_and_report():
    good = {"table_name": "a", "source_count": 5, "target_count": 5, "row_difference": 0, "percentage_difference": 0.0, "validation_passed": True}
    bad = good | {"table_name": "b", "target_count": 4, "row_difference": -1, "percentage_difference": -20.0, "validation_passed": False}
    assert validate.run_message([good])[0] == "success" and validate.run_message([good, bad])[0] == "failed" and validate.run_message([good, bad], ["c"])[0] == "missing"
    text = validate.report([good, bad], [{"rows_transferred": 10, "elapsed_time_seconds": 2.0}])
    assert "SUMMARY" in text and "Passed: 1/2 (50.0%)" in text and "DIFFERS: b by -1 (-20.00%)" in text and "Rows/s: 5" in text and text.endswith("Status: FAILED")


# sources


def test_queries_and_statements_in_a_database(spark):
    url = f"jdbc:derby:memory:{uuid.uuid4().hex};create=true"
    spark._jvm.java.lang.Class.forName(DERBY["driver"])
    with spec.JdbcSession(spark, url) as session:
        ddl.execute(["create table t (id int primary key, name varchar(20))", "insert into t values (1, 'a?b'), (2, 'it''s')"], session.run)
    found = spec.get_records(spark, url, "select * from t where name = ? or id = ?", ["it's", 7], **DERBY).collect()
    assert [tuple(r) for r in found] == [(2, "it's")]
    assert spec.get_first(spark, url, "select id from t where name = 'a?b'", **DERBY)[0] == 1 and spec.get_first(spark, url, "select id from t where id = ?", [9], **DERBY) is None
    with pytest.raises(RuntimeError, match="statement 2 of 2"):
        with spec.JdbcSession(spark, url) as session:
            ddl.execute(["delete from t", "delete from nothing"], session.run)
    assert spec.get_records(spark, url, "select * from t", **DERBY).count() == 2
    assert spec.bound("? = '?' and ?", [None, True]) == "NULL = '?' and TRUE"
    for sql, values in (("?", []), ("", [1])):
        with pytest.raises(ValueError, match="parameters"):
            spec.bound(sql, values)


def test_table_names():
    assert [names.split_table(x) for x in ("dbo.Users", " [my.schema].[t] ", "[a]]b].c", "s.a.b")] == [("dbo", "Users"), ("my.schema", "t"), ("a]b", "c"), ("s", "a.b")]
    assert names.split_table("t", "dbo") == ("dbo", "t") and names.split_table("[t]", "dbo") == ("dbo", "t")
    for bad in ("t", ".x", "dbo.", "", "[a.b", "[a]b", "[a].[b]c", "[].t", "[a]."):
        with pytest.raises(ValueError):
            names.split_table(bad)
    assert [names.human_number(x) for x in (999, 12_345, 1_500_000, 2e9)] == ["999", "12,345", "1.50M", "2.00B"]
    assert names.shortened("x" * 200) == "x" * 97 + "..." and names.shortened("abc") == "abc"


def test_settings_and_table_lists(tmp_path):
    s = config.Settings.read({"MAX_PARTITIONS": "3", "AUTO_TUNE_CHUNK_SIZE": "true", "SIMULATE_FAILURE_TABLES": "a, b", "PARALLEL_READERS": ""})
    assert (s.max_partitions, s.auto_tune_chunk_size, s.failing_tables, s.parallel_readers, s.default_chunk_size) == (3, True, ("a", "b"), 1, 200_000)
    with pytest.raises(ValueError, match="MAX_PARTITIONS"):
        config.Settings.read({"MAX_PARTITIONS": "many"})
    assert config.page_rows(100) == 100
    with pytest.raises(ValueError):
        config.page_rows(100, "incremental")
    env = {"INCLUDE_TABLES": "e.x"}
    assert config.table_list("db", str(tmp_path), None, env) == [("e", "x")] and config.table_list("db", str(tmp_path), "p.a,p.b,p.a", env) == [("p", "a"), ("p", "b")]
    (tmp_path / "db_include_tables.txt").write_text("# only these\nf.t\n\n[f].[u] # and this\n")
    assert config.table_list("db", str(tmp_path), "p.a", env) == [("f", "t"), ("f", "u")]


def test_catalogue_errors_and_counts(spark, store):
    from tidemark.plans import catalogue

    frames = catalogue._catalogue(spark, "/root/testdata/sf0.001")
    with pytest.raises(LookupError, match="atlantis"), pytest.warns(UserWarning, match="atlantis"):
        metadata.table_schemas(frames, "ASIA", include=["nation_7", "atlantis"])
    found = metadata.table_schemas(frames, "ASIA", include=["nation_7"])[0]
    assert found["table_name"] == "NATION_7" and ddl.complete(found)[0].startswith("DROP TABLE IF EXISTS")
    counts = metadata.source_counts(["a", "b"], lambda t: {"a": 5}[t], lambda t: ["k"])
    assert counts["a"] == {"rows": 5, "key": ["k"], "error": None} and counts["b"]["rows"] == 0 and counts["b"]["key"] == [] and counts["b"]["error"]
    df = spark.range(7)
    assert metadata.approximate_count(df) == 7 and metadata.remaining(df, F.col("id") > 4) == 2 and metadata.first_rows(df, 2) == [{"id": 0}, {"id": 1}]
    assert metadata.column_types(df) == [("id", "bigint")] and metadata.as_text(b"name") == "name"
    assert metadata.common_columns(spark.createDataFrame([], "a int, b int, c int"), spark.createDataFrame([], "c int, B int, a int")) == ["a", "c"]


def test_ddl_order_and_execution(spark):
    table = lambda name, **more: {"table_name": name, "columns": [{"column_name": "Id", "data_type": "int"}, {"column_name": "V", "data_type": "nvarchar", "max_length": 40}], "primary_key": ["Id"]} | more
    tables = [table("A", indexes=[{"index_name": "IX", "columns": ["V"], "is_unique": True}]), table("B", target_schema="z", check_constraints=[{"constraint_name": "ck", "definition": "([Id]>(0))"}])]
    made = ddl.schema_run(tables)
    assert [re.match(r"\w+( \w+)?", x)[0] for x in made] == ["CREATE SCHEMA", "CREATE SCHEMA", "DROP TABLE", "DROP TABLE", "CREATE TABLE", "CREATE TABLE", "CREATE UNIQUE", "ALTER TABLE"]
    assert '"z"."b"' in made[2] and '"public"."a"' in made[3]
    again = ddl.schema_run(tables, "RECOVERY")
    assert not any(x.startswith(("DROP", "ALTER")) for x in again) and sum("IF NOT EXISTS" in x for x in again) == 4
    assert ddl.complete(table("A"))[1:] == [ddl.create_table(table("A"), constraints=False), 'ALTER TABLE "public"."a" ADD CONSTRAINT "pk_a" PRIMARY KEY ("id")']
    schema = f"s{uuid.uuid4().hex[:8]}"
    statements = ddl.spark_schema_run([table("A", target_schema=schema)])
    assert ddl.execute(statements, spark.sql) == 3 and spark.table(f"{schema}.a").columns == ["id", "v"]
    spark.sql(f"DROP SCHEMA {schema} CASCADE")
