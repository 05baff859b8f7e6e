"""Tables as the engine knows them, and readers."""

from __future__ import annotations

import datetime as dt
import fnmatch
import math
import re
import warnings
from dataclasses import dataclass, field
from decimal import Decimal

from py4j.java_gateway import JavaObject
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.names import sanitize, sanitize_all


@dataclass(frozen=True)
class TableRef:
    schema: str
    name: str

    def __str__(self) -> str:
        return f"{self.schema}.{self.name}"


@dataclass(frozen=True)
class TableSpec:
    ref: TableRef
    columns: tuple[str, ...]
    key: tuple[str, ...] = ()
    indexes: tuple[dict, ...] = ()
    checks: tuple[dict, ...] = ()
    meta: dict = field(default_factory=dict)

    @property
    def target_name(self) -> str:
        return sanitize(self.ref.name)

    @property
    def target_columns(self) -> list[str]:
        return sanitize_all(self.columns)

    def key_or_fallback(self) -> list[str]:
        """The key, else a column named id, else the first; a fallback must be checked for uniqueness."""
        if self.key:
            return list(self.key)
        found = next((c for c in self.columns if c.lower() == "id"), self.columns[0])
        warnings.warn(f"{self.ref} has no key; {found} is used", stacklevel=2)
        return [found]


def choose_tables(names: list[str], include: list[str] = (), exclude: list[str] = ()) -> tuple[list[str], list[str]]:
    """Tables kept, and those asked for but missing; names match in any case, exclusions are globs."""
    wanted = {x.lower() for x in include}
    kept = [n for n in names if (not wanted or n.lower() in wanted) and not any(fnmatch.fnmatch(n.lower(), p.lower()) for p in exclude)]
    have = {n.lower() for n in names}
    return kept, [x for x in include if x.lower() not in have]


def columns_of(columns: DataFrame, types: DataFrame, identities: DataFrame, defaults: DataFrame) -> DataFrame:
    """Catalogue rows joined: inner to types, left to identity and default by (object_id, column_id)."""
    at = ["object_id", "column_id"]
    out = columns.join(types, "type_id").join(identities, at, "left").join(defaults, at, "left")
    return out.withColumn("is_max", F.col("max_length") == -1).orderBy("object_id", "column_id")


def ordered_list(members: DataFrame, group: list[str], name: str, ordinal: str) -> DataFrame:
    """(group..., columns): names joined by comma in ordinal order."""
    packed = F.sort_array(F.collect_list(F.struct(ordinal, name)))
    return members.groupBy(*group).agg(F.array_join(F.transform(packed, lambda x: x[name]), ",").alias("columns"))


def read_table(spark: SparkSession, folder: str, name: str, columns: list[str] | None = None) -> DataFrame:
    df = spark.read.parquet(f"{folder}/{name}.parquet")
    return df.select(columns) if columns else df


def jdbc_url(host: str, database: str, port: int | None = None, vendor: str = "sqlserver", trusted: bool = False) -> str:
    if vendor == "sqlserver":
        place = f"jdbc:sqlserver://{host}" + (f":{port}" if port and port != 1433 else "")
        return f"{place};databaseName={database};encrypt=true;trustServerCertificate=true" + (";integratedSecurity=true" if trusted else "")
    return f"jdbc:{vendor}://{host}" + (f":{port}" if port else "") + f"/{database}"


def embedded(url: str) -> bool:
    """Whether the database is in the driver's JVM, where executors can't reach it; its rows move by files (module ``embedded``)."""
    return url.startswith("jdbc:derby:") and not url.startswith("jdbc:derby://")


def read_jdbc(spark: SparkSession, url: str, table: str, predicates: list[str] | None = None, fetch: int = 10_000, **properties: str) -> DataFrame:
    """One partition per predicate; the number of predicates bounds the connections."""
    if embedded(url):
        from tidemark.sources.embedded import unload

        return unload(spark, url, table, predicates, **properties)
    properties = {"fetchsize": str(fetch)} | properties
    return spark.read.jdbc(url, table, predicates=predicates, properties=properties) if predicates else spark.read.jdbc(url, table, properties=properties)


def write_jdbc(df: DataFrame, url: str, table: str, mode: str = "append", batch: int = 10_000, connections: int = 8, **properties: str) -> None:
    """mode overwrite truncates in place and keeps the table's definition."""
    if embedded(url):
        from tidemark.sources.embedded import load

        return load(df, url, table, mode, **properties)
    options = {"batchsize": str(batch), "numPartitions": str(connections), "truncate": "true"} | properties
    df.write.jdbc(url, table, mode=mode, properties=options)


_PLACES = re.compile(r"'(?:[^']|'')*'|\"(?:[^\"]|\"\")*\"|--[^\n]*|/\*.*?\*/|\?", re.S)


def bound(sql: str, parameters: tuple | list = ()) -> str:
    """``sql`` with each ? outside of literals, quoted names and comments replaced by a parameter as a literal."""
    left = list(parameters)

    def place(m: re.Match) -> str:
        if m[0] != "?":
            return m[0]
        if not left:
            raise ValueError("fewer parameters than places")
        return literal(left.pop(0))

    out = _PLACES.sub(place, sql)
    if left:
        raise ValueError("more parameters than places")
    return out


def literal(value: object) -> str:
    """A value as a literal that JDBC drivers read; one that has none is an error."""
    if value is None:
        return "NULL"
    if isinstance(value, bool):
        return "TRUE" if value else "FALSE"
    if isinstance(value, float) and not math.isfinite(value):
        raise ValueError(f"{value} has no literal")
    if isinstance(value, (int, float, Decimal)):
        return str(value)
    if isinstance(value, (bytes, bytearray)):
        return f"X'{value.hex()}'"
    if isinstance(value, dt.datetime):
        return f"{{ts '{value:%Y-%m-%d %H:%M:%S.%f}'}}"
    if isinstance(value, dt.date):
        return f"{{d '{value}'}}"
    if not isinstance(value, str):
        raise ValueError(f"{type(value).__name__} has no literal")
    escaped = value.replace("'", "''")
    return f"'{escaped}'"


def get_records(spark: SparkSession, url: str, sql: str, parameters: tuple | list = (), **properties: str) -> DataFrame:
    """The rows of a query in the source."""
    return spark.read.format("jdbc").options(url=url, query=bound(sql, parameters), **properties).load()


def get_first(spark: SparkSession, url: str, sql: str, parameters: tuple | list = (), **properties: str):
    """The first row of a query, or None."""
    return get_records(spark, url, sql, parameters, **properties).first()


class JdbcSession:
    """One connection for statements; used with ``with``. Without ``autocommit`` a failure undoes what was run."""

    def __init__(self, spark: SparkSession, url: str, autocommit: bool = False) -> None:
        self.url, self.java = url, spark._jvm.java
        self.connection = spark._jvm.java.sql.DriverManager.getConnection(url)
        self.autocommit = autocommit
        self.connection.setAutoCommit(autocommit)

    def _prepared(self, sql: str, parameters: tuple | list):
        """A prepared statement with its parameters set: the database gets values, not texts."""
        statement, sql_package = self.connection.prepareStatement(sql), self.java.sql
        try:
            places = statement.getParameterMetaData()
            if len(parameters) != (wanted := places.getParameterCount()):
                raise ValueError(f"{'fewer' if len(parameters) < wanted else 'more'} parameters than places")
            for i, v in enumerate(parameters, 1):
                if v is None:
                    statement.setNull(i, places.getParameterType(i))
                elif isinstance(v, bool):
                    statement.setBoolean(i, v)
                elif isinstance(v, int):
                    statement.setLong(i, v)
                elif isinstance(v, float):
                    statement.setDouble(i, v)
                elif isinstance(v, Decimal):
                    statement.setBigDecimal(i, self.java.math.BigDecimal(str(v)))
                elif isinstance(v, (bytes, bytearray)):
                    statement.setBytes(i, bytearray(v))
                elif isinstance(v, dt.datetime):
                    statement.setTimestamp(i, sql_package.Timestamp.valueOf(f"{v:%Y-%m-%d %H:%M:%S.%f}"))
                elif isinstance(v, dt.date):
                    statement.setDate(i, sql_package.Date.valueOf(str(v)))
                else:
                    statement.setString(i, str(v))
        except Exception:
            statement.close()
            raise
        return statement

    def run(self, sql: str, parameters: tuple | list = ()) -> int:
        """Run a statement; the rows it changed."""
        statement = self._prepared(sql, parameters)
        try:
            return statement.executeUpdate()
        finally:
            statement.close()

    def rows(self, sql: str, parameters: tuple | list = ()) -> list[tuple]:
        """The rows of a small query (counts, bounds, catalogue); large ones are read by executors."""
        statement = self._prepared(sql, parameters)
        try:
            result, out = statement.executeQuery(), []
            n = result.getMetaData().getColumnCount()
            while result.next():
                out.append(tuple(_plain(result.getObject(i)) for i in range(1, n + 1)))
            return out
        finally:
            statement.close()

    def __enter__(self) -> JdbcSession:
        return self

    def __exit__(self, kind, error, trace) -> None:
        try:
            if not self.autocommit:
                (self.connection.rollback if kind else self.connection.commit)()
        finally:
            self.connection.close()


def _plain(value: object) -> object:
    """A value of a JDBC result as Python has it; dates and times from their text."""
    if not isinstance(value, JavaObject):
        return value
    text = value.toString()
    name = value.getClass().getName()
    if name == "java.sql.Timestamp":
        return dt.datetime.fromisoformat(text)
    return dt.date.fromisoformat(text) if name == "java.sql.Date" else text
