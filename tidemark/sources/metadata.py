"""Catalogue tables in, table specs out.

The frames are the source's catalogue views, small and read once; joins and ordered lists are DataFrame
operations, and what comes out are specs and the plain dictionaries that the DDL texts are made of.
"""

from __future__ import annotations

import warnings
from collections.abc import Callable
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.names import sanitize
from tidemark.operators.load import Store
from tidemark.sources.spec import TableRef, TableSpec, choose_tables, columns_of

# Key types that ranges can be cut from by arithmetic.
INTEGER_TYPES = ("tinyint", "smallint", "int", "bigint")


def as_text(value: Any) -> Any:
    """Names that a driver gives as bytes; never read as numbers."""
    return value.decode("utf-8", "replace") if isinstance(value, (bytes, bytearray)) else value


def list_tables(objects: DataFrame, schemas: DataFrame, partitions: DataFrame) -> DataFrame:
    """(object_id, schema_name, table_name, row_count): user tables by name; counts are approximate, summed over heap and clustered partitions."""
    rows = partitions.where(F.col("index_id").isin(0, 1)).groupBy("object_id").agg(F.sum("rows").alias("row_count"))
    named = objects.where(F.col("type") == "U").join(schemas, "schema_id").join(rows, "object_id", "left")
    return named.select("object_id", "schema_name", "table_name", F.coalesce("row_count", F.lit(0)).cast("long").alias("row_count")).orderBy("schema_name", "table_name")


def chosen_tables(tables: DataFrame, schema: str, include: list[str] = (), exclude: list[str] = ()) -> DataFrame:
    """The tables of a schema that are asked for, names in any case; tables that don't exist are warned of."""
    own = tables.where(F.col("schema_name") == schema)
    kept, missing = choose_tables([r.table_name for r in own.select("table_name").collect()], list(include), list(exclude))
    if missing:
        warnings.warn(f"no such tables in {schema}: {', '.join(missing)}", stacklevel=2)
    return own.where(F.col("table_name").isin(kept))


def _listed(members: DataFrame, group: list[str], item: Column, ordinal: str, name: str) -> DataFrame:
    packed = F.sort_array(F.collect_list(F.struct(F.col(ordinal).alias("o"), item.alias("x"))))
    return members.groupBy(*group).agg(F.transform(packed, lambda x: x["x"]).alias(name))


def key_columns(indexes: DataFrame, members: DataFrame, columns: DataFrame) -> DataFrame:
    """(object_id, constraint_name, columns, types, is_composite, is_all_integer) of primary keys, columns in key order."""
    own = indexes.where("is_primary_key").select("object_id", "index_id", F.col("index_name").alias("constraint_name"))
    typed = own.join(members, ["object_id", "index_id"]).join(columns.select("object_id", "column_id", "column_name", "data_type"), ["object_id", "column_id"])
    keys = _listed(typed, ["object_id", "constraint_name"], F.struct("column_name", "data_type"), "key_ordinal", "c")
    names, types = F.transform("c", lambda x: x["column_name"]), F.transform("c", lambda x: F.lower(x["data_type"]))
    return keys.select("object_id", "constraint_name", names.alias("columns"), types.alias("types"), (F.size("c") > 1).alias("is_composite"), F.forall(types, lambda t: t.isin(*INTEGER_TYPES)).alias("is_all_integer"))


def index_list(indexes: DataFrame, members: DataFrame, columns: DataFrame) -> DataFrame:
    """(object_id, index_name, is_unique, columns): indexes besides keys and heaps; columns as "name ASC" or "name DESC", in index order."""
    own = indexes.where(~F.col("is_primary_key") & (F.col("index_id") > 0)).select("object_id", "index_id", "index_name", "is_unique")
    named = own.join(members, ["object_id", "index_id"]).join(columns.select("object_id", "column_id", "column_name"), ["object_id", "column_id"])
    text = F.concat("column_name", F.when(F.col("is_descending"), " DESC").otherwise(" ASC"))
    return _listed(named, ["object_id", "index_name", "is_unique"], text, "key_ordinal", "c").select("object_id", "index_name", "is_unique", F.array_join("c", ",").alias("columns"))


def check_list(checks: DataFrame) -> DataFrame:
    """(object_id, constraint_name, definition, is_disabled) by name."""
    return checks.select("object_id", "constraint_name", "definition", "is_disabled").orderBy("object_id", "constraint_name")


def constraint_columns(constraints: DataFrame, usage: DataFrame, kind: str = "PRIMARY KEY") -> DataFrame:
    """(table_schema, table_name, columns) of the target's constraints of a kind, from its information schema."""
    at = ["constraint_schema", "constraint_name"]
    own = constraints.where(F.col("constraint_type") == kind).select(*at, "table_schema", "table_name")
    return _listed(own.join(usage.select(*at, "column_name", "ordinal_position"), at), ["table_schema", "table_name"], F.col("column_name"), "ordinal_position", "columns")


def serial_columns(columns: DataFrame) -> DataFrame:
    """(table_name, column_name) of columns that a sequence fills."""
    return columns.where(F.col("column_default").like("nextval%")).select("table_name", "column_name").orderBy("table_name", "column_name")


def table_schemas(frames: dict[str, DataFrame], schema: str, include: list[str] = (), exclude: list[str] = (), target_schema: str = "public") -> list[dict[str, Any]]:
    """Whole descriptions of the chosen tables, as the DDL texts take them. Asking for a table that doesn't exist is an error.

    frames: objects, schemas, partitions, columns, types, identities, defaults, indexes, index_columns, checks.
    """
    tables = chosen_tables(list_tables(frames["objects"], frames["schemas"], frames["partitions"]), schema, include, exclude).collect()
    have = {t.table_name.lower() for t in tables}
    if missing := [x for x in include if x.lower() not in have]:
        raise LookupError(f"no such tables in {schema}: {', '.join(missing)}")
    ids = [t.object_id for t in tables]
    own = lambda df: df.where(F.col("object_id").isin(ids))
    columns = columns_of(own(frames["columns"]), frames["types"], own(frames["identities"]), own(frames["defaults"]))
    keys = key_columns(own(frames["indexes"]), frames["index_columns"], columns)
    by: dict[str, dict[int, list[dict[str, Any]]]] = {}
    parts = {"columns": columns, "key": keys, "indexes": index_list(own(frames["indexes"]), frames["index_columns"], columns), "check_constraints": check_list(own(frames["checks"]))}
    for name, df in parts.items():
        of = by[name] = {}
        for r in df.collect():
            row = {k: as_text(v) for k, v in r.asDict(recursive=True).items()}
            of.setdefault(row.pop("object_id"), []).append(row)
    out = []
    for t in tables:
        key = by["key"].get(t.object_id, [None])[0]
        whole = {name: by[name].get(t.object_id, []) for name in ("columns", "indexes", "check_constraints")}
        out.append({"table_name": t.table_name, "schema_name": t.schema_name, "row_count": t.row_count, "target_schema": target_schema, "primary_key": key} | whole)
    return out


def table_spec(described: dict[str, Any]) -> TableSpec:
    key = described["primary_key"]
    meta = {"row_count": described["row_count"], "types": {c["column_name"]: c["data_type"] for c in described["columns"]}}
    return TableSpec(TableRef(described["schema_name"], described["table_name"]), tuple(c["column_name"] for c in described["columns"]), tuple(key["columns"]) if key else (), tuple(described["indexes"]), tuple(described["check_constraints"]), meta)


def discover_targets(store: Store, wanted: list[tuple[str, str]], keys: dict[str, list[str]]) -> list[dict[str, Any]]:
    """The wanted (schema, table) that exist in the target under their sanitised names, with columns and key; others are left out."""
    found = []
    for schema, table in wanted:
        name = sanitize(table)
        if store.exists(name):
            found.append({"schema": schema, "table": table, "target": name, "columns": store.read(name).columns, "key": keys.get(name, [])})
    return found


def source_counts(tables: list[str], count: Callable[[str], int], key: Callable[[str], list[str]]) -> dict[str, dict[str, Any]]:
    """Rows and key of each table; of one that can't be read 0 and no key, with the error."""
    out: dict[str, dict[str, Any]] = {}
    for t in tables:
        try:
            out[t] = {"rows": count(t), "key": key(t), "error": None}
        except Exception as e:  # noqa: BLE001 - the run goes on with the other tables
            out[t] = {"rows": 0, "key": [], "error": str(e)[:500]}
    return out


def column_types(df: DataFrame) -> list[tuple[str, str]]:
    """Columns in order with their types."""
    return [(f.name, f.dataType.simpleString()) for f in df.schema.fields]


def common_columns(a: DataFrame, b: DataFrame) -> list[str]:
    """Columns of both, in the order of the first; names match exactly."""
    return [c for c in a.columns if c in set(b.columns)]


def approximate_count(df: DataFrame) -> int:
    """Rows from the statistics of a catalogue table if it has them, else counted."""
    stats = df._jdf.queryExecution().optimizedPlan().stats().rowCount()
    return int(str(stats.get())) if stats.isDefined() else df.count()


def remaining(df: DataFrame, inside: Column) -> int:
    """Rows that a filtered transfer still has to move, for progress."""
    return df.where(inside).count()


def first_rows(df: DataFrame, n: int = 5) -> list[dict[str, Any]]:
    """A few rows for a log."""
    return [r.asDict(recursive=True) for r in df.limit(n).collect()]
