import pytest

from tidemark.functions import names, predicates, sizing, typemap
from tidemark.plans import ddl
from tidemark.plans.notify import Notifier
from tidemark.sources.spec import TableRef, TableSpec, choose_tables, jdbc_url


@pytest.mark.parametrize("name, clean", [("UserName", "username"), ("User Name", "user_name"), ("User--Name", "user_name"), ("_x_", "x"), ("123abc", "col_123abc"), ("", "col_"), ("!!!", "col_"), ("Ünïcode", "n_code")])
def test_sanitize(name, clean):
    assert names.sanitize(name) == clean


def test_collisions_are_errors():
    with pytest.raises(ValueError, match="both become"):
        names.sanitize_all(["User-Name", "User Name"])


def test_schema_names():
    assert names.target_schema("inst1", "My-DB", "sales") == "inst1__my_db__sales"
    long = names.target_schema("i" * 60, "VeryLongDB", "schema")
    assert len(long) <= 63 and long.endswith("__verylongdb__schema") and len(long.split("__")[0]) == 8


def test_lists_and_aliases():
    assert names.expand_tables('["dbo.A", "dbo.B,dbo.C"]') == ["dbo.A", "dbo.B", "dbo.C"]
    assert names.expand_tables("dbo.A, dbo.B") == ["dbo.A", "dbo.B"]
    assert names.split_table("[my.schema].[t]") == ("my.schema", "t")
    assert names.split_table("s.a.b") == ("s", "a.b")
    aliases = names.read_aliases("# c\nSQL01 = prod\nsql01 = prod2 # last\n")
    assert names.host_alias("sql01\\inst,1433", aliases) == "prod2"
    with pytest.raises(KeyError):
        names.host_alias("other", aliases)


def test_quoting():
    assert names.quote_brackets("Users]; DROP") == "[Users]]; DROP]"
    assert names.quote_double('a"b') == '"a""b"'
    assert names.is_safe("a_1") and not names.is_safe("1a") and not names.is_safe("a" * 129)


@pytest.mark.parametrize(
    "column, target",
    [
        ({"data_type": "nvarchar", "max_length": 100}, "VARCHAR(50)"),
        ({"data_type": "nvarchar", "max_length": -1}, "VARCHAR(1)"),
        ({"data_type": "nvarchar", "is_max": True}, "TEXT"),
        ({"data_type": "varbinary(max)"}, "BYTEA"),
        ({"data_type": "varchar"}, "VARCHAR(255)"),
        ({"data_type": "decimal", "precision": 10, "scale": 2}, "DECIMAL(10,2)"),
        ({"data_type": "decimal"}, "DECIMAL(18,0)"),
        ({"data_type": "datetime2", "scale": 3}, "TIMESTAMP(3)"),
        ({"data_type": "nonsense"}, "TEXT"),
        ({"data_type": "smallint", "is_identity": True}, "SERIAL"),
        ({"data_type": "bigint", "is_identity": True}, "BIGSERIAL"),
    ],
)
def test_types(column, target):
    assert typemap.target_type({"column_name": "c"} | column) == target


@pytest.mark.parametrize("source, target", [("(getdate())", "CURRENT_TIMESTAMP"), ("((0))", None), ("(0)", "0"), ("('x')", "'x'"), ("(1e10)", "1e10"), ("(1.2.3)", None), ("(--5)", None), ("(NULL)", "NULL"), (None, None), ("(MyFunc())", None)])
def test_defaults(source, target):
    assert typemap.default_value(source) == target


def test_spark_fields_are_valid(spark):
    for kind in typemap.TYPES:
        typemap.spark_field({"column_name": "C", "data_type": kind, "max_length": 20, "precision": 9, "scale": 2}, "c")


def test_sizing():
    assert [sizing.page_size(n, 50_000) for n in (0, 99_999, 500_000, 2_000_000, 9_000_000)] == [50_000, 10_000, 50_000, 50_000, 100_000]
    assert [sizing.partition_count(n) for n in (1, 2_000_000, 5_000_000)] == [2, 4, 8]
    assert sizing.key_ranges(0, 9, 3) == [(0, 2), (3, 5), (6, 9)]
    assert sizing.key_ranges(0, 1, 6) == [(0, 0), (1, 1)]
    assert sizing.row_ranges(10, 4) == [(1, 3), (4, 6), (7, 9), (10, 10)]
    assert sizing.reader_shares(10, 3) == [3, 3, 4]
    assert sizing.row_width(["int", "nvarchar(20)", "odd"]) == 154


TABLE = {
    "table_name": "User Table", "columns": [{"column_name": "Id", "data_type": "int", "is_identity": True}, {"column_name": "Name", "data_type": "nvarchar", "max_length": 40, "default_value": "('x')"}],
    "primary_key": {"columns": ["Id"]}, "indexes": [{"index_name": "IX Name", "columns": "Name DESC", "is_unique": True}],
    "check_constraints": [{"constraint_name": "ck", "definition": "(len([Name])>(0))"}, {"constraint_name": "off", "definition": "(1=1)", "is_disabled": True}],
}


def test_ddl():
    assert ddl.create_table(TABLE, "s") == 'CREATE TABLE "s"."user_table" (\n    "id" SERIAL,\n    "name" VARCHAR(20) DEFAULT \'x\',\n    CONSTRAINT "pk_user_table" PRIMARY KEY ("id")\n)'
    assert ddl.drop_table(TABLE, "s") == 'DROP TABLE IF EXISTS "s"."user_table" CASCADE'
    assert ddl.create_indexes(TABLE, "s") == ['CREATE UNIQUE INDEX "ix_name" ON "s"."user_table" ("name")']
    assert ddl.add_checks(TABLE, "s") == ['ALTER TABLE "s"."user_table" ADD CONSTRAINT "ck" CHECK (length("name") > (0))']
    assert "TBLPROPERTIES ('primary_key' = 'id')" in ddl.spark_table(TABLE, "s")


def test_specs():
    assert choose_tables(["Orders", "tmp_x", "Users"], ["orders", "gone"], ["TMP*"]) == (["Orders"], ["gone"])
    with pytest.warns(UserWarning):
        assert TableSpec(TableRef("dbo", "t"), ("a", "ID")).key_or_fallback() == ["ID"]
    assert ":1434" in jdbc_url("h", "d", 1434) and ":1433" not in jdbc_url("h", "d", 1433)


def test_notifications_drop_repeats():
    sent, now = [], [0.0]
    n = Notifier([sent.append], clock=lambda: now[0])
    assert n.send("failed", "t") and not n.send("failed", "t")
    now[0] = 61
    assert n.send("failed", "t") and len(sent) == 2


@pytest.mark.parametrize(
    "text, spark_text, target_text",
    [
        ("(len([Name])>(0))", "(length(rtrim(`name`)) > (0))", '(length("name") > (0))'),
        ("([a]='it''s len(x)' OR isnull([b],N'isnull(')<>'q')", "( `a` = 'it\\'s len(x)' OR coalesce(`b`, 'isnull(') <> 'q' )", "( \"a\" = 'it''s len(x)' OR coalesce(\"b\", 'isnull(') <> 'q' )"),
        ("[d]<=dateadd(dd,(1),getdate())", "(`d` <= dateadd(day, (1), current_timestamp()))", "(\"d\" <= (CURRENT_TIMESTAMP + ( 1 ) * INTERVAL '1 day'))"),
        ("(a > 1) or (b !< 2)", "((`a` > 1) OR (`b` >= 2))", '(("a" > 1) OR ("b" >= 2))'),
        ("[x] NOT LIKE '[A-Z]_%'", "(`x` NOT RLIKE '^[A-Z](?s:.)(?s:.)*$')", "(\"x\" !~ '^[A-Z]..*$')"),
        ("cast([a] as decimal(10,2)) = convert(int, [b])", "(CAST(`a` AS decimal(10,2)) = CAST(`b` AS int))", '(CAST("a" AS DECIMAL(10,2)) = CAST("b" AS INTEGER))'),
    ],
)
def test_conditions(text, spark_text, target_text):
    assert predicates.rewritten(text) == spark_text and predicates.rewritten(text, predicates.TARGET_DIALECT) == target_text


@pytest.mark.parametrize("text", ["soundex([a])=1", "len([a],2)=1", "(a", "a)", "", "a -- b", "a = 'open", "dateadd(foo,1,a) > b", "cast(a int) = 1"])
def test_what_is_no_condition(text):
    with pytest.raises(ValueError):
        predicates.rewritten(text)
