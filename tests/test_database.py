"""Databases as sources and sinks, the full run over one, constraints, chunks and digests."""

import datetime as dt
import decimal
import uuid

import pytest
from pyspark.sql import functions as F

from tidemark.operators import chunked, digests, incremental, load, merge, partition, quarantine, state, validate
from tidemark.plans import run
from tidemark.plans.config import Settings
from tidemark.plans.notify import Notifier
from tidemark.sources import database, shared, spec

NOW = dt.datetime(2024, 3, 1, 12)
DRIVER = {"driver": "org.apache.derby.jdbc.EmbeddedDriver"}


@pytest.fixture
def url(spark):
    spark._jvm.java.lang.Class.forName(DRIVER["driver"])
    return f"jdbc:derby:memory:{uuid.uuid4().hex};create=true"


@pytest.fixture
def store(spark, tmp_path):
    return load.Store(spark, str(tmp_path / "store"))


def rows(spark, pairs):
    return spark.createDataFrame(list(pairs), "k long, v string")


# statements


def test_parameters_reach_the_database_as_values(spark, url):
    values = (1, "it's ?", 1.5, decimal.Decimal("2.50"), bytearray(b"\x00\xff"), dt.date(2024, 2, 29), dt.datetime(2024, 1, 2, 3, 4, 5, 600000), True, None)
    with spec.JdbcSession(spark, url) as s:
        s.run('create table t (a bigint, "b?" varchar(20), c double, d decimal(9,2), e varchar(9) for bit data, f date, g timestamp, h boolean, i int)')
        assert s.run("insert into t values (?, ?, ?, ?, ?, ?, ?, ?, ?)", values) == 1
        assert s.rows('select a, "b?", c, d, f, g, h, i from t where "b?" = ? and a < ?', ("it's ?", 5)) == [(1, "it's ?", 1.5, decimal.Decimal("2.50"), dt.date(2024, 2, 29), dt.datetime(2024, 1, 2, 3, 4, 5, 600000), True, None)]
        for n in ((), (1, 2)):
            with pytest.raises(ValueError, match="parameters"):
                s.rows("select * from t where a = ?", n)
    assert spec.get_first(spark, url, 'select a from t where "b?" = ? and d = ? and f = ? and g = ? /* why? */', ["it's ?", decimal.Decimal("2.5"), dt.date(2024, 2, 29), values[6]], **DRIVER)[0] == 1
    assert spec.literal(b"\x00a") == "X'0061'"
    for bad in (float("inf"), float("nan"), [1]):
        with pytest.raises(ValueError, match="literal"):
            spec.literal(bad)


def test_values_reach_an_embedded_database_by_files_and_come_back(spark, url):
    with spec.JdbcSession(spark, url) as s:
        s.run('create table "a ""b" ("k" bigint, "Text" varchar(60), "d" double, "n" decimal(20,4), "at" timestamp, "on" date, "ok" boolean, "raw" varchar(9) for bit data)')
        s.run('create table one ("v" varchar(9))')
    texts = ["", None, 'say "x"', '"', "a,b", "line\nand\r\nanother\r", " \t ", "\\", "~", "\u00e9\u4e2d\U0001f600", "1,\"\n"]
    wanted = [(i, t, i / 3 if i else None, decimal.Decimal("-12345.6780"), dt.datetime(2024, 1, 2, 3, 4, 5, 600000 + i), dt.date(1960, 2, 29), i % 2 == 0, bytearray([0, i, 255])) for i, t in enumerate(texts)] + [(None,) * 8]
    df = spark.createDataFrame(wanted, "k long, text string, d double, n decimal(20,4), at timestamp_ntz, on date, ok boolean, raw binary")
    spec.write_jdbc(df.repartition(3), url, '"a ""b"', **DRIVER)
    back = spec.read_jdbc(spark, url, '"a ""b"', ['"k" < 4', '"k" >= 4 OR "k" IS NULL'], **DRIVER)
    assert back.columns[1] == "Text" and back.count() == 12 and back.rdd.getNumPartitions() == 2
    assert sorted((tuple(r) for r in back.withColumn("at", F.col("at").cast("timestamp_ntz")).collect()), key=str) == sorted(wanted, key=str)
    spec.write_jdbc(spark.createDataFrame([(None,), ("",), ("x",), (None,)], "v string"), url, "ONE", **DRIVER)
    one = spec.read_jdbc(spark, url, "one", **DRIVER)
    assert one.count() == 4 and sorted((r.v for r in one.collect()), key=str) == ["", None, None, "x"]


def test_a_load_that_fails_leaves_no_row_of_any_file(spark, url):
    with spec.JdbcSession(spark, url) as s:
        s.run('create table t ("k" bigint, "v" varchar(9))')
    good = rows(spark, [(k, "a") for k in range(90)])
    with pytest.raises(Exception, match="truncation"):
        spec.write_jdbc(good.unionAll(rows(spark, [(99, "much too long")])).coalesce(3), url, "t", **DRIVER)
    assert target_rows(spark, url) == {}
    for n in (90, 180):  # into an empty table and behind its rows
        spec.write_jdbc(good.repartition(3), url, "t", **DRIVER)
        assert spec.read_jdbc(spark, url, "t", **DRIVER).count() == n


def test_results_outlive_the_files_of_the_database(spark):
    from pathlib import Path

    from tidemark.plans import catalogue

    for name in ("jdbc_ntile_read", "jdbc_upsert"):
        there = set(Path(shared.shared_folder(spark)).rglob("*.csv"))
        found = catalogue.QUERIES[name](spark, "/root/testdata/sf0.001")
        assert set(Path(shared.shared_folder(spark)).rglob("*.csv")) <= there and not found.isEmpty(), name
        assert all(".parquet" in x for x in found.inputFiles()), name


@pytest.mark.parametrize("keys", ["o_orderkey % 1000 <> 1", "false"])
def test_upsert_query_without_the_keys_it_breaks(spark, tmp_path, keys):
    from tidemark.plans import catalogue

    spark.read.parquet("/root/testdata/sf0.001/orders.parquet").where(keys).write.parquet(f"{tmp_path}/orders.parquet")
    got, want = (catalogue.QUERIES[q](spark, str(tmp_path)) for q in ("jdbc_upsert", "upsert_apply"))
    assert got.columns == want.columns and got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()


# upsert


def target_rows(spark, url):
    return {r.k: r.v for r in spec.read_jdbc(spark, url, "t", **DRIVER).collect()}


def test_upsert_counts_and_rolls_back(spark, url):
    with spec.JdbcSession(spark, url) as s:
        s.run('create table t ("k" bigint primary key, "v" varchar(10), constraint short check (length("v") < 4))')
        for k, v in ((1, "a"), (2, "b"), (3, None), (9, "z")):
            s.run("insert into t values (?, ?)", (k, v))
    staged = rows(spark, [(1, "a"), (2, None), (3, "c"), (4, "d"), (5, None)]).repartition(3)
    done = database.upsert(staged, url, "t", ["k"], **DRIVER)
    want = {1: "a", 2: None, 3: "c", 4: "d", 5: None, 9: "z"}
    assert (done.inserted, done.updated, done.unchanged) == (2, 2, 1) and target_rows(spark, url) == want
    again = database.upsert(staged, url, "t", ["k"], **DRIVER)
    assert (again.inserted, again.updated, again.unchanged) == (0, 0, 5)
    always = database.upsert(staged, url, "t", ["k"], detect_changes=False, **DRIVER)
    assert (always.inserted, always.updated, always.unchanged) == (0, 5, 0)
    for bad, error in (([(1, "x"), (6, "much too long")], "SHORT|check|CHECK|length"), ([(1, "x"), (7, "p"), (7, "p")], "repeat"), ([(1, "x"), (None, "p")], "(?i)null")):
        with pytest.raises(Exception, match=error):
            database.upsert(rows(spark, bad), url, "t", ["k"], **DRIVER)
        assert target_rows(spark, url) == want
    assert database.upsert(rows(spark, []), url, "t", ["k"], **DRIVER) == database.Upsert(0, 0, 0)
    only_keys = database.upsert(rows(spark, [(1, ""), (8, "")]).select("k"), url, "t", ["k"], **DRIVER)
    assert (only_keys.inserted, only_keys.unchanged) == (1, 1)
    with spec.JdbcSession(spark, url) as s:
        assert not [r for r in s.rows("select tablename from sys.systables") if r[0].startswith("stg_")]


def test_statements_of_other_vendors():
    assert database.texts("jdbc:sqlserver://h")[0].startswith("SELECT TOP 0") and database.merge_statement("t", "s", ["k"], ["k"], end=";") == 'MERGE INTO t t USING s s ON t."k" = s."k" WHEN NOT MATCHED THEN INSERT ("k") VALUES (s."k");'


# tiles


@pytest.mark.parametrize("kind", ["long", "string"])
def test_tiles_are_cut_in_the_source(spark, url, kind):
    keys = [None, None, *(i * 7919 % 1009 for i in range(1003))]
    df = spark.createDataFrame([(None if k is None else k if kind == "long" else f"k{k:05}'", i) for i, k in enumerate(keys)], f"k {kind}, i int")
    with spec.JdbcSession(spark, url) as s:
        s.run(f'create table t ("k" {"bigint" if kind == "long" else "varchar(20)"}, "i" int)')
        for i in (0, 1):
            s.run("insert into t values (null, ?)", (i,))
    spec.write_jdbc(df.where("k is not null"), url, "t", **DRIVER)
    with spec.JdbcSession(spark, url) as s:
        tiles = database.source_tiles(s, "t", "k", 7)
    want = partition.ntile_bounds(df.where("k is not null"), "k", 7).orderBy("tile").collect()
    assert tiles == [(r.min_pk, r.row_count) for r in want]
    back = database.read_tiles(spark, url, "t", "k", 7, **DRIVER)
    assert back.rdd.getNumPartitions() == 7 and sorted(r.i for r in back.collect()) == list(range(1005))
    sizes = back.groupBy(F.spark_partition_id().alias("p")).count().collect()
    assert max(r["count"] for r in sizes) <= 146


def test_tile_query_is_ntile(spark):
    import duckdb

    con = duckdb.connect()
    con.sql("create table t as select (range * 7919 % 104729)::bigint k from range(1000)")
    df = spark.createDataFrame([(r[0],) for r in con.sql("select k from t").fetchall()], "k long")
    assert con.sql(database.tile_query("t", "k", 9)).fetchall() == [(r.min_pk, r.row_count) for r in partition.ntile_bounds(df, "k", 9).orderBy("tile").collect()]


def test_empty_source(spark, url):
    with spec.JdbcSession(spark, url) as s:
        s.run('create table t ("k" bigint)')
        assert database.source_tiles(s, "t", "k", 4) == []
    assert database.read_tiles(spark, url, "t", "k", 4, **DRIVER).count() == 0


def test_identity_goes_on_behind_the_greatest_value(spark, url):
    with spec.JdbcSession(spark, url) as s:
        s.run('create table t ("id" bigint generated by default as identity, "v" int)')
        assert database.restart_identity(s, "t", "id") == 2
        s.run("insert into t values (41, 1)")
        assert database.restart_identity(s, "t", "id") == 42
        s.run('insert into t ("v") values (2)')
        assert s.rows('select max("id") from t') == [(42,)]


# descriptions and the full run


@pytest.fixture
def shop(spark, url):
    with spec.JdbcSession(spark, url) as s:
        s.run('create table "Customers" ("Id" bigint generated by default as identity primary key, "Full Name" varchar(40) not null, "age" int, constraint adult check ("age" >= 18))')
        s.run('create table "Lines" ("o" bigint not null, "n" int not null, "q" double, primary key ("n", "o"))')
        s.run('create index "by_q" on "Lines" ("q" desc, "o")')
        s.run('create table "Notes" ("text" varchar(100))')
    customers = spark.createDataFrame([(i, f"n{i}", 18 + i % 50) for i in range(1, 2001)], ["Id", "Full Name", "age"])
    spec.write_jdbc(customers, url, '"Customers"', **DRIVER)
    spec.write_jdbc(spark.range(300).selectExpr("id div 3 o", "cast(id % 3 as int) n", "double(id) q"), url, '"Lines"', **DRIVER)
    with spec.JdbcSession(spark, url) as s:
        s.run("""insert into "Notes" values ('x'), (null)""")
    return url


def test_descriptions(spark, shop):
    with spec.JdbcSession(spark, shop) as s:
        customers, lines, notes = database.described(s, "APP")
        with pytest.raises(LookupError, match="atlantis"):
            database.described(s, "APP", ["atlantis"])
    assert [(c["column_name"], c["data_type"], c["is_identity"], c["is_nullable"]) for c in customers["columns"]] == [("Id", "bigint", True, False), ("Full Name", "varchar", False, False), ("age", "int", False, True)]
    assert (customers["row_count"], customers["primary_key"]["columns"], [c["constraint_name"] for c in customers["check_constraints"]]) == (2000, ["Id"], ["ADULT"])
    assert lines["primary_key"]["columns"] == ["n", "o"] and [(x["index_name"], x["columns"]) for x in lines["indexes"]] == [("by_q", ["q DESC", "o ASC"])] and notes["primary_key"] is None


def test_full_run_fails_recovers_and_starts_anew(spark, shop, store):
    sent, failing, seen = [], {1}, []

    def before(task):
        seen.append((task.table, task.index))
        if task.table == "customers" and task.index in failing:
            raise RuntimeError("lost connection")

    settings = Settings(partition_threshold=1000, max_partitions=4, simulate_failure_tables="dbo.Notes")
    make = lambda s: run.FullRun(spark, shop, "APP", store, s, clock=lambda: NOW, notifier=Notifier([sent.append]), before=before, properties=DRIVER)
    first = make(settings).run("r1")
    assert first.mode == "FRESH" and first.status == "missing" and "notes" in first.message and sent[-1]["status"] == "missing"
    known = state.SyncState.load(store)
    assert {k[1]: r["sync_status"] for k, r in known.rows.items()} == {"customers": "failed", "lines": "completed", "notes": "failed"}
    left = [p["status"] for p in known.rows["full", "customers", "APP", "public"]["partition_info"]]
    assert left == ["completed", "failed"]
    failing.clear()
    seen.clear()
    second = make(Settings(partition_threshold=1000, max_partitions=4)).run("r2")
    assert second.mode == "RECOVERY" and second.status == "success" and second.skipped == ["lines"]
    assert ("notes", 0) in seen and len([x for x in seen if x[0] == "customers"]) == 1
    assert {c["table_name"]: (c["source_count"], c["target_count"]) for c in second.checks} == {"customers": (2000, 2000), "lines": (300, 300), "notes": (2, 2)}
    assert sorted(r.id for r in store.read("customers").collect()) == list(range(1, 2001)) and store.read("customers").columns == ["id", "full_name", "age"]
    assert [tuple(r) for r in store.read(run.SEQUENCES).collect()] == [("customers", "id", 2001)]
    assert "Status: PASSED" in second.report and second.ddl[0].startswith("CREATE SCHEMA")
    third = make(Settings(partition_threshold=10**9, parallel_readers=3, default_chunk_size=900)).run("r3")
    assert third.mode == "FRESH" and third.status == "success" and store.read("customers").count() == 2000
    assert store.notes("customers")["done"] and store.notes("customers")["chunk"] == 2  # three chunks, each with its checkpoint
    assert state.SyncState.load(store).rows["full", "customers", "APP", "public"]["checkpoint_batch_num"] == 2


def test_a_configured_run_and_from_database_to_database(spark, shop, store):
    statements = []
    made = run.FullRun.configured(spark, shop, "db", "APP", store, None, {"INCLUDE_TABLES": "APP.Lines", "MAX_PARTITIONS": "3", "PARTITION_THRESHOLD": "100"}, clock=lambda: NOW, properties=DRIVER, execute_ddl=statements.append)
    out = made.run("r1")
    assert [c["table_name"] for c in out.checks] == ["lines"] and out.status == "success" and statements == out.ddl and any(x.startswith('CREATE TABLE "public"."lines"') for x in statements)
    assert len(store.manifest("lines")["parts"]) == 2 and store.read("lines").count() == 300  # ranges of the key's first column, equal values together
    other = f"jdbc:derby:memory:{uuid.uuid4().hex};create=true"
    with spec.JdbcSession(spark, other) as s:
        s.run('create table "copy" ("o" bigint not null, "n" int not null, "q" double, primary key ("n", "o"))')
        s.run('insert into "copy" values (0, 0, 5), (999, 0, 7)')
    done = database.upsert(database.read_tiles(spark, shop, '"Lines"', "o", 4, **DRIVER), other, '"copy"', ["n", "o"], **DRIVER)
    assert (done.inserted, done.updated, done.unchanged) == (299, 1, 0) and spec.read_jdbc(spark, other, '"copy"', **DRIVER).count() == 301


def test_full_run_puts_rows_aside_that_break_a_constraint(spark, url, store):
    spec.write_jdbc(spark.createDataFrame([(1, 17), (2, 18), (3, None)], "id int, age int"), url, "people", **DRIVER)
    made = run.FullRun(spark, url, "APP", store, check_constraints=True, clock=lambda: NOW, properties=DRIVER)
    described = database.described

    def constrained(session, schema, *a, **k):
        return [t | {"check_constraints": [{"constraint_name": "adult", "definition": "([age]>=(18))"}]} for t in described(session, schema, *a, **k)]

    database.described, kept = constrained, described
    try:
        out = made.run("r1")
    finally:
        database.described = kept
    assert out.status == "success" and sorted(r.id for r in store.read("people").collect()) == [2, 3]
    assert [tuple(r) for r in store.read("people__rejected").collect()] == [(1, 17, ["adult"])]


# constraints


def test_quarantine(spark, store):
    df = spark.createDataFrame([(1, "ab ", 5.0), (2, "len(", None), (3, "Q7", -1.0), (4, None, -2.0), (5, "it's", 0.0)], "id int, name string, price double")
    checks = [
        {"constraint_name": "price", "definition": "([price]>=(0))"},
        {"constraint_name": "name", "definition": "(len([name])<=(2) OR [name]=N'len(' OR [name]='it''s')"},
        {"constraint_name": "pattern", "definition": "([name] NOT LIKE '[A-Z][0-9]%')"},
        {"constraint_name": "off", "definition": "([id]<(0))", "is_disabled": True},
    ]
    got = {r.id: r.broken_constraints for r in quarantine.checked(df, checks).collect()}
    assert got == {1: [], 2: [], 3: ["price", "pattern"], 4: ["price"], 5: []}
    assert quarantine.load_checked(store, "t", df, checks) == quarantine.CheckedLoad(3, 2)
    assert sorted(r.id for r in store.read("t").collect()) == [1, 2, 5] and store.read("t__rejected").count() == 2
    with pytest.raises(ValueError, match="unknown function"):
        quarantine.load_checked(store, "t", df, [{"constraint_name": "x", "definition": "soundex([name]) = 'a'"}])
    assert quarantine.load_checked(store, "t", df, []) == quarantine.CheckedLoad(5, 0)


# chunks


@pytest.mark.parametrize("dies_at", [0, 2, 5])
def test_a_load_killed_after_any_chunk_goes_on(spark, store, dies_at):
    source = rows(spark, [(None, "n"), *((i * 37 % 1000, f"v{i}") for i in range(1000))])
    edges, done, seen = [100, 200, 300, 400, 500], [], []

    def committed(last, chunk, n):
        seen.append((last, chunk, n))
        if chunk == dies_at and not done:
            done.append(chunk)
            raise KeyboardInterrupt

    with pytest.raises(KeyboardInterrupt):
        chunked.load_in_chunks(store, "t", source, "k", 6, "l1", committed, edges)
    assert store.notes("t")["chunk"] == dies_at and store.read("t").count() == store.notes("t")["rows"]
    rest = chunked.load_in_chunks(store, "t", source, "k", 6, "l1", committed)
    assert rest.success and rest.first == dies_at + 1 if dies_at < 5 else rest.rows == 1001
    assert rest.rows == 1001 and sorted(store.read("t").collect(), key=str) == sorted(source.collect(), key=str)
    if dies_at < 5:
        assert rest.rows_read == 1001 - (100 * (dies_at + 1) + 1)


def test_a_failing_chunk_and_a_new_load(spark, store):
    source = rows(spark, ((i, "a") for i in range(400)))
    bad = source.withColumn("v", F.when(F.col("k") > 250, F.raise_error(F.lit("lost")).cast("string")).otherwise("a"))
    failed = chunked.load_in_chunks(store, "t", bad, "k", 4)
    assert not failed.success and failed.rows_read in range(150, 251) and failed.chunks == 4
    rest = chunked.load_in_chunks(store, "t", source, "k", 4)
    assert rest.success and rest.rows_read + failed.rows_read == 400 and rest.first == 2
    whole = chunked.load_in_chunks(store, "t", source.where("k < 100"), "k", 4)
    assert whole.first == 0 and whole.rows == store.read("t").count() == 100


# digests


def test_digest_diff_finds_exact_keys(spark, store):
    source = spark.range(5000).selectExpr("id k", "concat('v', id) v", "if(id % 7 = 0, null, id) w")
    changed = source.where("k not in (17, 4000)").withColumn("v", F.when(F.col("k").isin(0, 2500), F.lit("x")).otherwise(F.col("v"))).unionByName(spark.createDataFrame([(9000, "n", 1), (None, "z", 2)], "k long, v string, w long"))
    edges = [1000, 2000, 3000, 4000]
    want = {(17, "source"), (4000, "source"), (0, "changed"), (2500, "changed"), (9000, "target"), (None, "target")}
    assert {tuple(r) for r in digests.digest_diff(source, changed, ["k"], edges).collect()} == want
    assert digests.digest_diff(source, source.repartition(7), ["k"], edges).count() == 0
    assert {tuple(r) for r in digests.digest_diff(source, changed, ["k"], [], fan=1).collect()} == want
    store.publish("t", source, "k", edges)
    digests.keep_digests(store, "t", ["k"])
    kept, notes = digests.kept_digests(store, "t", ["k"])
    late = source.withColumn("v", F.when(F.col("k") == 3500, F.lit("new")).otherwise(F.col("v")))
    leaves = digests.differing_leaves(digests.leaf_digests(late, ["k"], notes["edges"]), kept, notes["edges"], notes["fan"])
    assert leaves.ranges == [3] and len(leaves.found) == 1 and 0 < leaves.rows(late, ["k"]).count() < 60
    store.append("t", source.limit(0))
    assert digests.kept_digests(store, "t", ["k"]) is None


def test_encoding_is_injective(spark):
    values = [("a|b", "c"), ("a", "b|c"), (None, "x"), ("~", "x"), ("", "~"), ("1:a", None), ("", None), ("a:", "1:b"), ("a", ":1:b")]
    df = spark.createDataFrame(values, "a string, b string")
    assert df.select(digests.encoded(["a", "b"])).distinct().count() == len(values)
    sums = {validate.table_checksum(spark.createDataFrame([v], df.schema)).first().checksum for v in values}
    assert len(sums) == len(values)


def test_sample_leaves_the_target_in_place(spark, tmp_path):
    spark.range(5000).selectExpr("id k", "id * 2 v").write.parquet(str(tmp_path / "t"))
    target = spark.read.parquet(str(tmp_path / "t"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        check = validate.sample_check(target, target.withColumn("v", F.when(F.col("k") == 3, 0).otherwise(F.col("v"))), ["k"], 50)
        text = check._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" not in text and "ShuffledHashJoin" not in text and tuple(check.first()) == (50, 1)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


# bounds


def test_sketch_bounds_are_near_tiles(spark, tmp_path):
    df = spark.range(50_000).selectExpr("pow(id, 2) k")
    got = partition.sketch_bounds(df, "k", 20).collect()
    assert sorted(r.tile for r in got) == list(range(1, 21)) and sum(r.row_count for r in got) == 50_000
    assert all(abs(r.row_count - 2500) <= 50 for r in got)
    skewed = partition.sketch_bounds(df.selectExpr("if(k < 1e9, 5, k) k"), "k", 8).collect()
    assert sum(r.row_count for r in skewed) == 50_000 and max(r.row_count for r in skewed) >= 31_000
    assert partition.range_edges(df.selectExpr("concat('t', cast(k as bigint)) k").limit(100), "k", 4) != [] and partition.range_edges(df.limit(0), "k", 3) == []


@pytest.mark.parametrize("n", [1, 7, 30])
def test_exact_tiles_by_an_index(spark, n):
    shapes = {"unique": "id * 7919 % 104729", "ties": "id div 40", "negative": "500 - id", "float": "double(id) / 3", "nulls": "if(id < 30, null, id)", "one": "5L", "date": "date_add(date'2020-01-01', cast(id as int))"}
    for name, x in shapes.items():
        df = spark.range(3000).selectExpr(f"{x} k").repartition(5)
        got = {tuple(r) for r in partition.ntile_bounds(df, "k", n).collect()}
        want = df.selectExpr("k", f"ntile({n}) over (order by k) tile").groupBy("tile").agg(F.min("k"), F.max("k"), F.count("*"))
        assert got == {tuple(r) for r in want.collect()}, name
    assert partition.ntile_bounds(spark.range(0).selectExpr("id k"), "k", n).count() == 0


def test_temporary_tables_go(spark):
    import os

    with pytest.raises(ZeroDivisionError):
        with shared.temporary_tables(spark):
            path = shared.written(spark.range(3)).inputFiles()[0].removeprefix("file://").rsplit("/", 1)[0]
            with shared.temporary_tables(spark):
                inner = shared.written(spark.range(3)).inputFiles()[0].removeprefix("file://").rsplit("/", 1)[0]
            assert os.path.exists(path) and not os.path.exists(inner)
            1 / 0  # noqa: B018
    assert not os.path.exists(path)


def test_footers_answer_counts(spark, tmp_path):
    spark.range(1000).selectExpr("id k", "id * 2 v").write.parquet(str(tmp_path / "t"))
    assert partition.footer_bounds(spark, str(tmp_path / "t"), "k") == (1000, 0, 999)
    assert "PushedAggregation: [COUNT(*), MIN(k), MAX(k)]" in partition.footer_aggregate(spark, str(tmp_path / "t"), "k")._jdf.queryExecution().executedPlan().toString()


def test_ranges_of_a_table_are_written_at_once(spark, store):
    from concurrent.futures import ThreadPoolExecutor

    store.publish("t", rows(spark, []), "k", [10, 20, 30])
    with ThreadPoolExecutor(4) as pool:
        done = list(pool.map(lambda i: store.publish_ranges("t", rows(spark, [(10 * i + 1, f"r{i}")]), [i])["rows"], range(4)))
    assert done == [1] * 4 and sorted(r.v for r in store.read("t").collect()) == ["r0", "r1", "r2", "r3"]
    incremental.merge_staged(store, "t", shared.written(rows(spark, [(1, "x")])), ["k"], NOW)
    assert store.read("t").count() == 4 and merge.SMALL_ROWS
