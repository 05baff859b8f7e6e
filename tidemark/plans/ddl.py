"""DDL texts for the target, and Spark's own."""

from __future__ import annotations

from collections.abc import Callable
from typing import Any

from tidemark.functions.names import quote_backtick, quote_double, sanitize, sanitize_all
from tidemark.functions.predicates import TARGET_DIALECT, rewritten
from tidemark.functions.typemap import default_value, spark_type, target_type


def _key(table: dict[str, Any]) -> list[str]:
    key = table.get("primary_key") or []
    return [sanitize(c) for c in (key.get("columns", []) if isinstance(key, dict) else key)]


def _name(table: dict[str, Any], schema: str) -> str:
    return f"{quote_double(schema)}.{quote_double(sanitize(table['table_name']))}"


def create_schema(schema: str) -> str:
    return f"CREATE SCHEMA IF NOT EXISTS {quote_double(schema)}"


def create_table(table: dict[str, Any], schema: str = "public", constraints: bool = True) -> str:
    """All columns nullable: NOT NULL is left to a later ALTER, after the data are in."""
    names = sanitize_all(c["column_name"] for c in table["columns"])
    lines = []
    for name, column in zip(names, table["columns"]):
        default = None if column.get("is_identity") else default_value(column.get("default_value"))
        lines.append(" ".join([quote_double(name), target_type(column), *([f"DEFAULT {default}"] if default else [])]))
    if constraints and _key(table):
        pk = quote_double(f"pk_{sanitize(table['table_name'])}")
        lines.append(f"CONSTRAINT {pk} PRIMARY KEY ({', '.join(map(quote_double, _key(table)))})")
    body = ",\n".join(f"    {x}" for x in lines)
    return f"CREATE TABLE {_name(table, schema)} (\n{body}\n)"


def drop_table(table: dict[str, Any], schema: str = "public") -> str:
    return f"DROP TABLE IF EXISTS {_name(table, schema)} CASCADE"


def truncate_table(table: dict[str, Any], schema: str = "public") -> str:
    return f"TRUNCATE TABLE {_name(table, schema)} CASCADE"


def create_indexes(table: dict[str, Any], schema: str = "public") -> list[str]:
    out = []
    for x in table.get("indexes", []):
        columns = x["columns"].split(",") if isinstance(x["columns"], str) else x["columns"]
        listed = ", ".join(quote_double(sanitize(c.strip().removesuffix(" ASC").removesuffix(" DESC"))) for c in columns)
        out.append(f"CREATE {'UNIQUE ' * bool(x.get('is_unique'))}INDEX {quote_double(sanitize(x['index_name']))} ON {_name(table, schema)} ({listed})")
    return out


def check_expression(definition: str) -> str:
    """The constraint in the target's dialect; a function that it doesn't know is an error."""
    return rewritten(definition, TARGET_DIALECT)


def add_checks(table: dict[str, Any], schema: str = "public") -> list[str]:
    return [f"ALTER TABLE {_name(table, schema)} ADD CONSTRAINT {quote_double(sanitize(c['constraint_name']))} CHECK {check_expression(c['definition'])}" for c in table.get("check_constraints", []) if not c.get("is_disabled")]


def spark_table(table: dict[str, Any], schema: str) -> str:
    names = sanitize_all(c["column_name"] for c in table["columns"])
    columns = ", ".join(f"{quote_backtick(n)} {spark_type(c)}" for n, c in zip(names, table["columns"]))
    return f"CREATE TABLE IF NOT EXISTS {quote_backtick(schema)}.{quote_backtick(sanitize(table['table_name']))} ({columns}) USING parquet TBLPROPERTIES ('primary_key' = '{','.join(_key(table))}')"


def primary_key(table: dict[str, Any], schema: str = "public") -> str | None:
    """The key as a statement of its own, for tables that are created without."""
    key = _key(table)
    name = quote_double(f"pk_{sanitize(table['table_name'])}")
    return f"ALTER TABLE {_name(table, schema)} ADD CONSTRAINT {name} PRIMARY KEY ({', '.join(map(quote_double, key))})" if key else None


def complete(table: dict[str, Any], schema: str = "public", drop: bool = True) -> list[str]:
    """All statements of one table: drop, create, key, indexes, checks."""
    key = primary_key(table, schema)
    return [*([drop_table(table, schema)] if drop else []), create_table(table, schema, constraints=False), *([key] if key else []), *create_indexes(table, schema), *add_checks(table, schema)]


def schema_run(tables: list[dict[str, Any]], mode: str = "FRESH", target: str = "public") -> list[str]:
    """The statements of a schema run in order: schemas, drops in reverse order of the tables, tables, indexes and checks.

    A recovery drops nothing, since it skips tables that are complete.
    """
    where = lambda t: t.get("target_schema") or target
    out = [create_schema(x) for x in sorted({where(t) for t in tables})]
    if mode == "FRESH":
        out += [drop_table(t, where(t)) for t in reversed(tables)]
    for t in tables:
        made = create_table(t, where(t))
        out.append(made if mode == "FRESH" else made.replace("CREATE TABLE", "CREATE TABLE IF NOT EXISTS", 1))
    if mode == "FRESH":
        out += [x for t in tables for x in (*create_indexes(t, where(t)), *add_checks(t, where(t)))]
    return out


def spark_schema_run(tables: list[dict[str, Any]], mode: str = "FRESH", target: str = "default") -> list[str]:
    """The same for Spark's catalogue, which has no indexes or checks."""
    where = lambda t: t.get("target_schema") or target
    out = [f"CREATE SCHEMA IF NOT EXISTS {quote_backtick(x)}" for x in sorted({where(t) for t in tables})]
    if mode == "FRESH":
        out += [f"DROP TABLE IF EXISTS {quote_backtick(where(t))}.{quote_backtick(sanitize(t['table_name']))}" for t in reversed(tables)]
    return out + [spark_table(t, where(t)) for t in tables]


def execute(statements: list[str], run: Callable[[str], Any], commit: Callable[[], Any] | None = None, rollback: Callable[[], Any] | None = None) -> int:
    """Run statements in order: as one transaction if there is a commit, else one by one. Returns how many ran."""
    done = 0
    try:
        for done, statement in enumerate(statements, 1):
            run(statement)
    except Exception as e:
        if rollback:
            rollback()
        raise RuntimeError(f"statement {done} of {len(statements)} failed: {statements[done - 1][:200]}") from e
    if commit:
        commit()
    return done
