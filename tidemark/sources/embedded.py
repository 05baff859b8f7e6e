"""A database inside the driver's JVM as source and sink: rows move by files in the shared folder.

Executors are other processes and can't open such a database. Spark's tasks write the rows to load as the database's own import reads
them, and read what its export wrote. The driver sends statements, the database streams the files; neither holds the rows.
"""

from __future__ import annotations

import os
import re
import shutil
import uuid
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.names import quote_double
from tidemark.sources.shared import deleted, mounted, new_path, temporary_tables
from tidemark.sources.spec import JdbcSession

_NAME = re.compile(r'"((?:[^"]|"")*)"|([^."]+)')
#: exports at once
CONNECTIONS = 8


def parts_of(table: str) -> tuple[str | None, str]:
    """Schema and name, as the catalogue has them, of a table as statements name it."""
    found = [plain.strip().upper() if plain else quoted.replace('""', '"') for quoted, plain in _NAME.findall(table)]
    return (found[-2] if len(found) > 1 else None), found[-1]


def _field(f: T.StructField) -> Column:
    """A value as the import reads it: in quotes, nothing at all if null."""
    c = F.col(f"`{f.name}`")
    text = F.hex(c) if isinstance(f.dataType, T.BinaryType) else c.cast("string")
    return F.coalesce(F.concat(F.lit('"'), F.replace(text, F.lit('"'), F.lit('""')), F.lit('"')), F.lit(""))


def load(df: DataFrame, url: str, table: str, mode: str = "append", **properties: str) -> None:
    """Rows into a table, which is made or emptied as Spark's own JDBC writer does it for the mode; all of them or none.

    One import of one file, as only an empty table is filled in bulk, without a log entry and a walk through its index for each row.
    """
    spark = df.sparkSession
    df.limit(0).write.jdbc(url, table, mode=mode, properties={"truncate": "true"} | properties)  # without rows no task connects
    schema, name = parts_of(table)
    there = spark.read.jdbc(url, table, properties=properties).columns
    by_lower = {c.lower(): c for c in there}
    columns = [c if c in there else by_lower[c.lower()] for c in df.columns]
    if bad := [c for c in columns if "," in c]:
        raise ValueError(f"the import takes no column names with a comma: {bad}")
    with temporary_tables(spark):
        path = new_path(spark)
        # a constant is the first field, so that no row is an empty line
        df.select(F.concat_ws(",", F.lit("1"), *map(_field, df.schema.fields)).alias("line")).write.text(path)
        folder, at = mounted(path), ",".join(str(i + 2) for i in range(len(columns)))
        whole = f"{folder}/whole"
        with open(whole, "wb") as out:
            for file in sorted(f"{folder}/{x}" for x in os.listdir(folder) if x.startswith("part-")):
                with open(file, "rb") as part:
                    shutil.copyfileobj(part, out, 1 << 20)
                os.remove(file)
        if os.path.getsize(whole):
            with JdbcSession(spark, url) as session:
                session.run("CALL SYSCS_UTIL.SYSCS_IMPORT_DATA(?, ?, ?, ?, ?, NULL, NULL, 'UTF-8', 0)", (schema, name, ",".join(columns), at, whole))


def unload(spark: SparkSession, url: str, table: str, predicates: list[str] | None = None, **properties: str) -> DataFrame:
    """The table's rows as they are now: a file, and so a partition, for each predicate, exported at once."""
    fields = spark.read.jdbc(url, table, properties=properties).schema.fields
    path, listed = new_path(spark), ", ".join(["1", *(quote_double(f.name) for f in fields)])
    os.makedirs(folder := mounted(path))
    predicates = predicates or ["1 = 1"]

    def export(i: int) -> None:
        with JdbcSession(spark, url) as session:
            session.run("CALL SYSCS_UTIL.SYSCS_EXPORT_QUERY(?, ?, NULL, NULL, 'UTF-8')", (f"SELECT {listed} FROM {table} WHERE {predicates[i]}", f"{folder}/{i}.csv"))

    with ThreadPoolExecutor(min(CONNECTIONS, len(predicates))) as pool:
        list(pool.map(export, range(len(predicates))))
    texts = ", ".join(f"c{i} string" for i in range(len(fields) + 1))
    # several lines: a text may have them, and no file is split; the mark of nulls keeps them apart from empty texts
    options = {"quote": '"', "escape": '"', "multiLine": True, "lineSep": "\n", "nullValue": uuid.uuid4().hex, "emptyValue": "", "mode": "FAILFAST", "encoding": "UTF-8"}
    files = [spark.read.schema(texts).options(**options).csv(f"{path}/{i}.csv") for i in range(len(predicates))]
    value = lambda i, f: (F.unhex(f"c{i}") if isinstance(f.dataType, T.BinaryType) else F.col(f"c{i}").cast(f.dataType)).alias(f.name)
    return reduce(DataFrame.unionAll, files).select(*(value(i, f) for i, f in enumerate(fields, 1)))


def create(spark: SparkSession, folder: str) -> str:
    """A new database on disk, in a folder of its own; its url."""
    spark._jvm.java.lang.Class.forName("org.apache.derby.jdbc.EmbeddedDriver")
    os.makedirs(mounted(folder), exist_ok=True)
    return f"jdbc:derby:{mounted(folder)}/derby-{uuid.uuid4().hex};create=true"


def drop(spark: SparkSession, url: str) -> None:
    """Close a database of :func:`create` and delete it; what was read from it stays."""
    place = url.removeprefix("jdbc:derby:").partition(";")[0]
    try:
        spark._jvm.java.sql.DriverManager.getConnection(f"jdbc:derby:{place};shutdown=true").close()
    except Py4JJavaError as e:
        if e.java_exception.getSQLState() not in ("08006", "XJ004"):  # closed as asked for, or never there
            raise
    deleted(spark, f"file://{place}")
