"""A database as source and sink: tiles cut in the source, upserts by a staging table and one transaction, descriptions of tables.

The database is reached by JDBC; what differs between vendors is in :data:`TEXTS`. Rows move between executors and the database, the
driver sends statements only.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from typing import Any

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.names import quote_double
from tidemark.operators.merge import DuplicateKeys
from tidemark.operators.partition import half_open, jdbc_predicates, tile_sizes
from tidemark.sources.shared import temporary_tables, written
from tidemark.sources.spec import JdbcSession, embedded, read_jdbc, write_jdbc

# An empty copy of some columns of a table, and the end of a MERGE statement.
TEXTS = {
    "sqlserver": ("SELECT TOP 0 {columns} INTO {copy} FROM {table}", ";"),
    "": ("CREATE TABLE {copy} AS SELECT {columns} FROM {table} WITH NO DATA", ""),
}


# Statements that set what an identity column gives next.
RESTARTS = {
    "sqlserver": "DBCC CHECKIDENT ({name}, RESEED, {last})",
    "postgresql": "DO $$ BEGIN PERFORM setval(pg_get_serial_sequence({name}, {text}), {last}); END $$",
    "": "ALTER TABLE {table} ALTER COLUMN {column} RESTART WITH {value}",
}


def vendor(url: str) -> str:
    return url.split(":")[1]


def texts(url: str) -> tuple[str, str]:
    return TEXTS.get(vendor(url), TEXTS[""])


# tiles


def tile_query(table: str, key: str, n: int) -> str:
    """(low, rows) of each tile, as a database with window functions cuts them."""
    k = quote_double(key)
    return f"SELECT MIN(k) AS low_key, COUNT(*) AS n FROM (SELECT {k} AS k, NTILE({n}) OVER (ORDER BY {k}) AS tile FROM {table} WHERE {k} IS NOT NULL) x GROUP BY tile ORDER BY 1"


def source_tiles(session: JdbcSession, table: str, key: str, n: int, windows: bool | None = None) -> list[tuple[Any, int]]:
    """(low, rows) of up to n tiles of the non-null keys, computed in the source as NTILE cuts them.

    Without window functions (``windows``; Derby has none with an order) the lows are read at their offsets, one key each.
    """
    if windows or (windows is None and vendor(session.url) != "derby"):
        return [(low, rows) for low, rows in session.rows(tile_query(table, key, n))]
    k = quote_double(key)
    total = session.rows(f"SELECT COUNT(*) FROM {table} WHERE {k} IS NOT NULL")[0][0]
    out, at = [], 0
    for rows in tile_sizes(total, n):
        low = session.rows(f"SELECT {k} FROM {table} WHERE {k} IS NOT NULL ORDER BY {k} OFFSET {at} ROWS FETCH NEXT 1 ROWS ONLY")[0][0]
        out.append((low, rows))
        at += rows
    return out


def tile_ranges(tiles: list[tuple[Any, int]]) -> list[tuple]:
    """Half-open key ranges of tiles: keys that two tiles share fall to one; the first takes nulls too."""
    return half_open([(low, None) for low, _ in tiles]) or [(None, None)]


def read_tiles(spark: SparkSession, url: str, table: str, key: str, n: int, **properties: str) -> DataFrame:
    """The table by n reads at once, one of each tile; each row is read once, a null key in the first."""
    with JdbcSession(spark, url) as session:
        ranges = tile_ranges(source_tiles(session, table, key, n))
    return read_jdbc(spark, url, table, jdbc_predicates(key, ranges), **properties)


# upsert


@dataclass
class Upsert:
    inserted: int
    updated: int
    unchanged: int


def _differs(column: str) -> str:
    a, b = f"t.{quote_double(column)}", f"s.{quote_double(column)}"
    return f"({a} <> {b} OR ({a} IS NULL AND {b} IS NOT NULL) OR ({a} IS NOT NULL AND {b} IS NULL))"


def merge_statement(table: str, staging: str, columns: list[str], key: list[str], detect_changes: bool = True, end: str = "") -> str:
    values = [c for c in columns if c not in key]
    match = " AND ".join(f"t.{quote_double(k)} = s.{quote_double(k)}" for k in key)
    update = ""
    if values:
        changed = f" AND ({' OR '.join(map(_differs, values))})" if detect_changes else ""
        update = f" WHEN MATCHED{changed} THEN UPDATE SET {', '.join(f'{quote_double(c)} = s.{quote_double(c)}' for c in values)}"
    insert = f" WHEN NOT MATCHED THEN INSERT ({', '.join(map(quote_double, columns))}) VALUES ({', '.join(f's.{quote_double(c)}' for c in columns)})"
    return f"MERGE INTO {table} t USING {staging} s ON {match}{update}{insert}{end}"


def _unnullable(df: DataFrame, url: str) -> dict[str, str]:
    """Text columns whose nulls need a mark of their own, with its name: to a Derby server Spark binds them as CLOB, which a VARCHAR refuses."""
    if vendor(url) != "derby" or embedded(url):
        return {}
    return {f.name: f"null_{i}_{uuid.uuid4().hex[:6]}" for i, f in enumerate(df.schema.fields) if isinstance(f.dataType, T.StringType)}


def upsert(df: DataFrame, url: str, table: str, key: list[str], detect_changes: bool = True, connections: int = 8, batch: int = 10_000, **properties: str) -> Upsert:
    """Merge rows into a database table: the executors fill a staging table, and one transaction merges it, all or nothing.

    The counts are the database's own and must agree with what the merge says it changed. Repeated or null keys in the staged rows
    (of the source, or of a task that was tried again after it had committed) are an error before anything is merged, and so is a staged
    count that isn't the source's. The staging table goes in any case.
    """
    spark = df.sparkSession
    copy, end = texts(url)
    staging = quote_double(f"stg_{uuid.uuid4().hex[:12]}")
    columns, match = df.columns, " AND ".join(f"t.{quote_double(k)} = s.{quote_double(k)}" for k in key)
    if missing := [k for k in key if k not in columns]:
        raise ValueError(f"key columns not in the rows: {missing}")
    marked = _unnullable(df, url)
    with JdbcSession(spark, url) as session:
        session.run(copy.format(copy=staging, columns=", ".join(map(quote_double, columns)), table=table))
        for c in marked.values():
            session.run(f"ALTER TABLE {staging} ADD COLUMN {quote_double(c)} SMALLINT")
    try:
        with temporary_tables(spark):
            # fixed in the shared folder first: counted there, and the same if a task that stages them is tried again
            seen = Observation()
            rows = written(df.observe(seen, F.count(F.lit(1)).alias("rows"))).withColumns({m: F.col(f"`{c}`").isNull().cast("smallint") for c, m in marked.items()})
            rows = rows.withColumns({c: F.coalesce(F.col(f"`{c}`"), F.lit("")) for c in marked})
            write_jdbc(rows, url, staging, batch=batch, connections=connections, **properties)
            with JdbcSession(spark, url) as session:
                for c, m in marked.items():
                    session.run(f"UPDATE {staging} SET {quote_double(c)} = NULL WHERE {quote_double(m)} = 1")
                one = lambda sql: session.rows(sql)[0][0]
                listed = ", ".join(map(quote_double, key))
                if one(f"SELECT COUNT(*) FROM {staging} WHERE {' OR '.join(f'{quote_double(k)} IS NULL' for k in key)}"):
                    raise DuplicateKeys(f"staged rows have a null in {key}")
                if one(f"SELECT COUNT(*) FROM (SELECT {listed} FROM {staging} GROUP BY {listed} HAVING COUNT(*) > 1) d"):
                    raise DuplicateKeys(f"staged rows repeat a key of {key}")
                staged = one(f"SELECT COUNT(*) FROM {staging}")
                if staged != seen.get["rows"]:
                    raise RuntimeError(f"{seen.get['rows']} rows read, {staged} staged")
                values = [c for c in columns if c not in key]
                differs = f"COUNT(CASE WHEN {' OR '.join(map(_differs, values))} THEN 1 END)" if values and detect_changes else "COUNT(*)" if values else "0"
                matched, changed = session.rows(f"SELECT COUNT(*), {differs} FROM {staging} s JOIN {table} t ON {match}")[0]
                done = session.run(merge_statement(table, staging, columns, key, detect_changes, end))
                if done != staged - matched + changed:
                    raise RuntimeError(f"the merge changed {done} rows, not {staged - matched} new and {changed} others")
            return Upsert(staged - matched, changed, matched - changed)
    finally:
        with JdbcSession(spark, url) as session:
            session.run(f"DROP TABLE {staging}")


# descriptions

# Java.sql.Types and the source types of the same kind.
JDBC_TYPES = {
    -7: "bit", 16: "bit", -6: "tinyint", 5: "smallint", 4: "int", -5: "bigint", 6: "float", 8: "float", 7: "real", 3: "decimal", 2: "numeric", 1: "char", 12: "varchar", -1: "text",
    -15: "nchar", -9: "nvarchar", -16: "ntext", 2005: "text", -2: "binary", -3: "varbinary", -4: "image", 2004: "image", 91: "date", 92: "time", 93: "datetime2", 2014: "datetimeoffset", 2009: "xml",
}


def _found(result, *columns: str) -> list[dict[str, Any]]:
    """The rows of a JDBC result as dictionaries."""
    out = []
    try:
        while result.next():
            out.append({c: result.getObject(c) for c in columns})
    finally:
        result.close()
    return out


def described(session: JdbcSession, schema: str, include: list[str] = (), counts: bool = True) -> list[dict[str, Any]]:
    """Descriptions of a schema's tables from the driver's own catalogue calls, as the DDL texts and runs take them, by name."""
    meta = session.connection.getMetaData()
    listed = sorted(r["TABLE_NAME"] for r in _found(meta.getTables(None, schema, "%", None), "TABLE_NAME", "TABLE_TYPE") if r["TABLE_TYPE"] in ("TABLE", "BASE TABLE"))
    wanted = {x.lower() for x in include}
    if missing := wanted - {x.lower() for x in listed}:
        raise LookupError(f"no such tables in {schema}: {', '.join(sorted(missing))}")
    out = []
    for table in (t for t in listed if not wanted or t.lower() in wanted):
        columns = []
        for c in _found(meta.getColumns(None, schema, table, "%"), "COLUMN_NAME", "DATA_TYPE", "COLUMN_SIZE", "DECIMAL_DIGITS", "IS_NULLABLE", "COLUMN_DEF", "IS_AUTOINCREMENT", "ORDINAL_POSITION"):
            kind = JDBC_TYPES.get(c["DATA_TYPE"], "text")
            wide = 2 if kind in ("nchar", "nvarchar") else 1
            columns.append({
                "column_name": c["COLUMN_NAME"], "data_type": kind, "max_length": c["COLUMN_SIZE"] * wide, "precision": c["COLUMN_SIZE"], "scale": c["DECIMAL_DIGITS"],
                "is_nullable": c["IS_NULLABLE"] == "YES", "is_identity": c["IS_AUTOINCREMENT"] == "YES", "default_value": c["COLUMN_DEF"], "at": c["ORDINAL_POSITION"],
            })
        key = sorted(_found(meta.getPrimaryKeys(None, schema, table), "COLUMN_NAME", "KEY_SEQ", "PK_NAME"), key=lambda r: r["KEY_SEQ"])
        by_index: dict[str, dict[str, Any]] = {}
        for i in _found(meta.getIndexInfo(None, schema, table, False, True), "INDEX_NAME", "NON_UNIQUE", "COLUMN_NAME", "ORDINAL_POSITION", "ASC_OR_DESC"):
            own = by_index.setdefault(i["INDEX_NAME"], {"index_name": i["INDEX_NAME"], "is_unique": not i["NON_UNIQUE"], "columns": []})
            own["columns"].append((i["ORDINAL_POSITION"], f"{i['COLUMN_NAME']} {'DESC' if i['ASC_OR_DESC'] == 'D' else 'ASC'}"))
        named = [k["COLUMN_NAME"] for k in key]
        indexes = [x | {"columns": [c for _, c in sorted(x["columns"])]} for x in by_index.values()]
        whole = f"{quote_double(schema)}.{quote_double(table)}"
        out.append({
            "table_name": table, "schema_name": schema, "columns": sorted(columns, key=lambda c: c["at"]),
            "row_count": session.rows(f"SELECT COUNT(*) FROM {whole}")[0][0] if counts else None,
            "primary_key": {"constraint_name": key[0]["PK_NAME"], "columns": named, "is_composite": len(named) > 1} if key else None,
            "indexes": sorted((x for x in indexes if not (x["is_unique"] and [c.rsplit(" ", 1)[0] for c in x["columns"]] == named)), key=lambda x: x["index_name"]),
            "check_constraints": _checks(session, schema, table),
        })
    return out


# Where vendors list CHECK constraints; parameters are schema and table.
CHECKS = {
    "derby": "SELECT c.CONSTRAINTNAME, k.CHECKDEFINITION FROM SYS.SYSCHECKS k JOIN SYS.SYSCONSTRAINTS c ON c.CONSTRAINTID = k.CONSTRAINTID JOIN SYS.SYSTABLES t ON t.TABLEID = c.TABLEID JOIN SYS.SYSSCHEMAS s ON s.SCHEMAID = t.SCHEMAID WHERE s.SCHEMANAME = ? AND t.TABLENAME = ? ORDER BY 1",
    "sqlserver": "SELECT c.name, c.definition FROM sys.check_constraints c WHERE SCHEMA_NAME(c.schema_id) = ? AND OBJECT_NAME(c.parent_object_id) = ? AND c.is_disabled = 0 ORDER BY 1",
}


def _checks(session: JdbcSession, schema: str, table: str) -> list[dict[str, Any]]:
    sql = CHECKS.get(vendor(session.url))
    return [{"constraint_name": n, "definition": d, "is_disabled": False} for n, d in session.rows(sql, (schema, table))] if sql else []


def restart_identity(session: JdbcSession, table: str, column: str) -> int:
    """Let an identity column go on behind its greatest value, 1 if there is none; the next value."""
    top = session.rows(f"SELECT MAX({quote_double(column)}) FROM {table}")[0][0]
    value = (top if top is not None else 1) + 1
    form = RESTARTS.get(vendor(session.url), RESTARTS[""])
    session.run(form.format(table=table, column=quote_double(column), text=f"'{column}'", name=f"'{table}'", value=value, last=value - 1))
    return value
