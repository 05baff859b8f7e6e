"""Settings of a run, from the environment, and the precedence of table lists."""

from __future__ import annotations

import os
from collections.abc import Mapping
from dataclasses import dataclass, fields, replace
from pathlib import Path

from tidemark.functions.names import expand_tables, read_list, split_table

# The largest and smallest rows of a page that a run may ask for.
PAGE_LIMITS = {"full": (100, 500_000), "incremental": (1_000, 500_000)}


@dataclass(frozen=True)
class Settings:
    """Names and defaults of the settings. Those for wire formats and thread queues have no use here."""

    max_parallel_transfers: int = 8
    max_active_tasks: int = 16
    default_chunk_size: int = 200_000
    max_partitions: int = 8
    default_incremental_batch_size: int = 100_000
    partition_threshold: int = 1_000_000
    max_partitions_per_table: int = 6
    date_updated_field: str = ""
    parallel_readers: int = 1
    max_pg_connections: int = 8
    max_mssql_connections: int = 12
    auto_tune_chunk_size: bool = False
    simulate_failure_tables: str = ""
    include_tables: str = ""

    @classmethod
    def read(cls, environment: Mapping[str, str] | None = None) -> Settings:
        """Values by upper-case name; a value that isn't of its kind is an error that says which."""
        environment = os.environ if environment is None else environment
        found = {}
        for f in fields(cls):
            text = environment.get(f.name.upper())
            if text is None or (text == "" and not isinstance(f.default, str)):
                continue
            try:
                found[f.name] = _yes(text) if isinstance(f.default, bool) else type(f.default)(text)
            except ValueError as e:
                raise ValueError(f"{f.name.upper()} = {text!r}") from e
        return replace(cls(), **found)

    @property
    def failing_tables(self) -> tuple[str, ...]:
        return tuple(expand_tables(self.simulate_failure_tables))


def _yes(text: str) -> bool:
    value = text.strip().lower()
    if value not in ("true", "false", "1", "0", "yes", "no"):
        raise ValueError(text)
    return value in ("true", "1", "yes")


def page_rows(asked: int, kind: str = "full") -> int:
    low, high = PAGE_LIMITS[kind]
    if not low <= asked <= high:
        raise ValueError(f"{asked} rows a page; allowed are {low} to {high}")
    return asked


def table_list(database: str, folder: str | None = None, parameter: str | list[str] | None = None, environment: Mapping[str, str] | None = None) -> list[tuple[str, str]]:
    """(schema, table) to include: of ``<database>_include_tables.txt`` if that has any, else of the parameter, else of INCLUDE_TABLES."""
    path = Path(folder, f"{database}_include_tables.txt") if folder else None
    listed = read_list(path.read_text()) if path and path.exists() else []
    chosen = listed or expand_tables(parameter) or expand_tables(Settings.read(environment).include_tables)
    return list(dict.fromkeys(split_table(x) for x in chosen))
