import datetime as dt
import uuid

import pytest
from pyspark.sql import functions as F

from tidemark.operators import incremental, load, merge, partition, scan, state, validate
from tidemark.plans import transfer
from tidemark.sources import spec
from tidemark.streaming import merge_stream

NOW = dt.datetime(2024, 1, 10, 12)
KEY = ("full", "t", "dbo", "public")


def frame(spark, rows, schema="id int, name string, value int, updated_at timestamp_ntz"):
    return spark.createDataFrame(rows, schema)


def first_load():
    return [(i, f"n{i}", i, None if i < 10 else NOW - dt.timedelta(days=1 + i % 10)) for i in range(1000)]


def test_second_sync_counts(spark, tmp_path):
    store = load.Store(spark, str(tmp_path))
    store.publish("t", frame(spark, first_load()))
    changed = {i: (i, f"n{i}", i + 100, NOW + dt.timedelta(hours=1)) for i in range(20, 40)}
    rows = [changed.get(r[0], r) for r in first_load()]
    rows += [(1000 + i, "new", i, NOW + dt.timedelta(hours=1)) for i in range(50)]
    rows += [(2000 + i, "old", i, NOW - dt.timedelta(days=1)) for i in range(5)] + [(3000 + i, "undated", i, None) for i in range(3)]
    done = incremental.sync(store, "t", frame(spark, rows), ["id"], "updated_at", NOW, NOW)
    assert (done.inserted, done.updated, done.unchanged) == (53, 20, 10)
    after = store.read("t")
    assert after.count() == 1053 and after.where("id between 2000 and 2004").isEmpty()
    again = incremental.sync(store, "t", frame(spark, rows), ["id"], "updated_at", NOW, NOW)
    assert (again.inserted, again.updated) == (0, 0)


def test_null_overwrites_and_key_zero_counts(spark):
    target, staged = frame(spark, [(0, "a", 1, None), (1, "b", 2, None)]), frame(spark, [(0, None, 1, None), (2, "c", 3, None)])
    for small in (False, True):
        out = {r.id: (r.name, r.op) for r in merge.diff(target, staged, ["id"], small=small).collect()}
        assert out == {0: (None, "updated"), 1: ("b", "kept"), 2: ("c", "inserted")}


def test_key_only_and_empty(spark):
    a, none = spark.createDataFrame([(1,), (2,)], "id int"), spark.createDataFrame([], "id int")
    assert {(r.id, r.op) for r in merge.diff(a, a, ["id"]).collect()} == {(1, "unchanged"), (2, "unchanged")}
    assert merge.merge(none, a, ["id"]).count() == 2 and merge.merge(a, none, ["id"]).count() == 2


def test_duplicate_staged_keys_raise(spark):
    with pytest.raises(merge.DuplicateKeys):
        merge.require_unique(frame(spark, [(1, "a", 1, None), (1, "b", 1, None)]), ["id"])
    with pytest.raises(merge.DuplicateKeys):
        merge.require_unique(frame(spark, [(None, "a", 1, None)]), ["id"])
    with pytest.raises(ValueError):
        merge.require_unique(frame(spark, []), ["missing"])


@pytest.mark.parametrize("n, total", [(7, 100), (8, 5), (3, 3), (1, 10)])
def test_tiles_equal_ntile(spark, n, total):
    df = spark.range(total).select((F.col("id") * 7919 % 104729).alias("k"))
    got = {r.tile: (r.min_pk, r.max_pk, r.row_count) for r in partition.ntile_bounds(df, "k", n).collect()}
    want = {r.tile: (r.a, r.b, r.c) for r in df.selectExpr("k", f"ntile({n}) over (order by k) tile").groupBy("tile").agg(F.min("k").alias("a"), F.max("k").alias("b"), F.count("*").alias("c")).collect()}
    assert got == want


def test_half_open_ranges_cover_once(spark):
    df = spark.createDataFrame([(i // 3,) for i in range(100)], "k int")  # repeated keys at boundaries
    bounds = partition.half_open([(r.min_pk, r.max_pk) for r in partition.ntile_bounds(df, "k", 6).collect()])
    parts = [df.where(scan.in_range(df, ["k"], low and (low,), high and (high,), open_high=True)).count() for low, high in bounds]
    assert sum(parts) == 100


def test_predicates():
    assert partition.jdbc_predicates("k", [(None, 5), (5, None)]) == ['("k" < 5 OR "k" IS NULL)', '"k" >= 5']
    assert partition.jdbc_predicates('k"; drop', [("a'b", None)]) == ["\"k\"\"; drop\" >= 'a''b'"]


def test_pushdown(spark, tmp_path):
    spark.range(100).selectExpr("id", "id * 2 as v", "id * 3 as w").write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    plan = scan.project(df.where(scan.in_range(df, ["id"], (5,), (9,))), ["id", "v"])._jdf.queryExecution().toString()
    assert "GreaterThanOrEqual(id,5)" in plan and "ReadSchema: struct<id:bigint,v:bigint>" in plan


def test_replace_range_keeps_nulls(spark):
    target, source = frame(spark, [(None, "x", 1, None), (1, "a", 1, None), (5, "b", 1, None)]), frame(spark, [(1, "new", 2, None), (9, "no", 2, None)])
    out = load.replaced_range(target, source, F.col("id").between(0, 3))
    assert sorted(out.select("name").toPandas()["name"]) == ["b", "new", "x"]


def test_full_refresh_reports_failures(spark, tmp_path):
    store = load.Store(spark, str(tmp_path))
    df = spark.createDataFrame([(1, float("nan")), (2, 1.0)], "id int, v double")
    assert load.full_refresh(store, df, "t").success and store.read("t").where("v is null").count() == 1
    failed = load.full_refresh(store, df, "t", fail_tables=("t",))
    assert not failed.success and store.read("t").count() == 2  # the old version is still there
    store.truncate("t")
    assert not store.has_data("t") and load.full_refresh(store, df.limit(0), "e").success
    with pytest.raises(FileNotFoundError):
        store.read("none")


def test_watermark_column(spark):
    df = spark.createDataFrame([], "id int, Updated timestamp_ntz, raw binary, d date")
    assert incremental.watermark_column(df, incremental.candidates(" updated, raw , Updated,d")) == "Updated"
    assert incremental.watermark_column(df, []) is None


def test_state_transitions(spark):
    s = state.SyncState()
    s.start(KEY, NOW, "r1", 10)
    s.checkpoint(KEY, NOW, 0, 1)
    assert s.resume_point(KEY) == "0"
    s.fail(KEY, NOW, "x" * 5000)
    assert len(s.rows[KEY]["error_message"]) == 4000
    assert s.start(KEY, NOW, "r2")["retry_count"] == 1 and s.resume_point(KEY) is None
    s.complete(KEY, NOW + dt.timedelta(seconds=5), watermark=NOW)
    s.start(KEY, NOW, "r3")
    s.fail(KEY, NOW, "again")
    assert s.watermark(KEY) == NOW  # a failure keeps the last good one
    assert s.rows[KEY]["retry_count"] == 1
    back = state.SyncState.from_frame(s.to_frame(spark))
    assert back.rows == s.rows
    s.reset(NOW)
    assert s.summary()["pending"] == (1, ["t"])


def test_full_and_incremental_states_are_apart():
    s = state.SyncState()
    s.start(KEY, NOW, "r")
    s.start(("incremental", *KEY[1:]), NOW, "r")
    assert len(s.rows) == 2


def test_plans():
    s = state.SyncState()
    tables = [{"name": "small", "rows": 10, "key": ["id"]}, {"name": "big", "rows": 3_000_000, "key": ["id"]}, {"name": "pair", "rows": 1_500_000, "key": ["a", "b"]}, {"name": "odd", "rows": 2_000_000, "key": ["1;drop"]}]
    made = transfer.plan(tables, s, "r", lambda t, k, n: [(None, 5), (5, None)])
    assert made.mode == "FRESH" and [(t.table, t.kind, t.low, t.high) for t in made.tasks] == [("small", "regular", None, None), ("big", "keys", None, 5), ("big", "keys", 5, None), ("pair", "rows", 1, 750_000), ("pair", "rows", 750_001, 1_500_000), ("odd", "regular", None, None)]
    done = transfer.run_all(made.tasks, lambda t: {"rows": 1} if t.table != "big" else 1 / 0)
    assert transfer.outcome(done)["status"] == "partial_failure" and transfer.outcome(done)["failed"] == ["big"]


def test_resume_equals_uninterrupted(spark):
    """Kill a range load after any committed prefix: deleting (resume, max] and copying it gives the source."""
    source = frame(spark, [(i, f"n{i}", i, None) for i in range(20)])
    for committed in (0, 7, 19):
        target = source.where(F.col("id") <= committed)
        inside = scan.in_range(source, ["id"], (committed,), (19,), open_low=True)
        assert load.replaced_range(target, source, inside).exceptAll(source).isEmpty()
        assert load.replaced_range(target, source, inside).count() == 20


def test_validation(spark):
    a, b = frame(spark, [(1, "a", 1, None), (2, None, 2, None)]), frame(spark, [(2, None, 2, None), (1, "a", 9, None)])
    r = validate.sample_check(a, b, ["id"], 10).first()
    assert (r.compared, r.mismatches) == (2, 1)
    assert validate.table_checksum(a).first() == validate.table_checksum(a.orderBy(F.desc("id"))).first()
    empty = validate.count_check("t", a.limit(0), a).first()
    assert (empty.row_difference, empty.percentage_difference, empty.validation_passed) == (2, 0.0, False)
    text = validate.report([c.asDict() for c in validate.batch_check({"t": (a, b)}).collect()], [{"rows_transferred": 10, "elapsed_time_seconds": 0}])
    assert "PASS" in text and "\n" in text and "Rows/s: 0" in text


def test_jdbc_roundtrip(spark):
    url = f"jdbc:derby:memory:{uuid.uuid4().hex};create=true"
    df = spark.createDataFrame([(i, f"n{i}") for i in range(100)], "id int, name string")
    spec.write_jdbc(df, url, "t", driver="org.apache.derby.jdbc.EmbeddedDriver")
    back = spec.read_jdbc(spark, url, "t", partition.jdbc_predicates("id", [(None, 50), (50, None)]), driver="org.apache.derby.jdbc.EmbeddedDriver")
    assert back.rdd.getNumPartitions() == 2 and sorted(map(tuple, back.collect())) == [(i, f"n{i}") for i in range(100)]


def test_stream_merges(spark, tmp_path):
    store = load.Store(spark, str(tmp_path / "store"))
    schema = "id int, name string, value int, updated_at timestamp_ntz"
    store.publish("t", frame(spark, [(1, "a", 1, None)]))
    frame(spark, [(1, "b", 2, NOW), (1, "z", 0, None), (2, "c", 3, NOW)]).write.parquet(str(tmp_path / "in"))
    merge_stream.start(spark.readStream.schema(schema).parquet(str(tmp_path / "in")), store, "t", ["id"], "updated_at", str(tmp_path / "cp")).awaitTermination()
    assert {(r.id, r.name) for r in store.read("t").collect()} == {(1, "b"), (2, "c")}
