"""CHECK constraints as filters: rows that break one are put aside with its name, the others are loaded.

A constraint is broken if it is false; a null passes, as in the source. Comparisons of texts tell cases apart, as the target's do.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.predicates import condition
from tidemark.operators.load import Store
from tidemark.sources.shared import temporary_tables, written

BROKEN = "broken_constraints"


def broken(checks: list[dict[str, Any]]) -> Column:
    """The names of the constraints that a row breaks, in the order given; disabled ones don't count."""
    names = [F.when(~F.coalesce(condition(c["definition"]), F.lit(True)), F.lit(c["constraint_name"])) for c in checks if not c.get("is_disabled")]
    return F.array_compact(F.array(*names)) if names else F.array().cast("array<string>")


def checked(df: DataFrame, checks: list[dict[str, Any]]) -> DataFrame:
    """``df`` and the column ``broken_constraints``."""
    return df.withColumn(BROKEN, broken(checks))


@dataclass
class CheckedLoad:
    good: int
    rejected: int


def load_checked(store: Store, table: str, source: DataFrame, checks: list[dict[str, Any]], quarantine: str | None = None) -> CheckedLoad:
    """Replace the table by the good rows and ``<table>__rejected`` by the others with the names of what they break.

    The source is read once. The table of rejected rows is published first, so that none is missing from both; if a constraint
    can't be understood nothing is.
    """
    with temporary_tables(store.spark):
        rows = written(checked(source, checks))
        bad = F.size(BROKEN) > 0
        rejected = store.publish(quarantine or f"{table}__rejected", rows.where(bad))["rows"]
        return CheckedLoad(store.publish(table, rows.where(~bad).drop(BROKEN))["rows"], rejected)
