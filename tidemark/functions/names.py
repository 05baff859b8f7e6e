"""Identifiers: sanitising, schema names, table lists, aliases, quoting."""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: what an identifier may be.
_PLAIN = re.compile(r"[A-Za-z_][A-Za-z0-9_]*")


def sanitize(name: str) -> str:
    """Lower case, other characters than a-z, 0-9 and _ as one _, no _ at the ends; never empty or digit-led."""
    out = re.sub(r"_+", "_", re.sub(r"[^a-z0-9_]", "_", name.lower())).strip("_")
    return out if out and not out[0].isdigit() else f"col_{out}"


def sanitize_all(names: Iterable[str]) -> list[str]:
    """Sanitised names in order; two source names that become one are an error."""
    seen: dict[str, str] = {}
    out = []
    for name in names:
        clean = sanitize(name)
        if clean in seen:
            raise ValueError(f"columns {seen[clean]!r} and {name!r} both become {clean!r}")
        seen[clean] = name
        out.append(clean)
    return out


def sanitized(c: Column) -> Column:
    """:func:`sanitize` as a Column expression."""
    core = F.btrim(F.regexp_replace(F.regexp_replace(F.lower(c), "[^a-z0-9_]", "_"), "_+", "_"), F.lit("_"))
    return F.when((core == "") | core.rlike("^[0-9]"), F.concat(F.lit("col_"), core)).otherwise(core)


def target_schema(instance: str, database: str, schema: str, limit: int = 63) -> str:
    """``instance__database__schema``; a name over the limit starts with 8 digits of the instance's MD5 instead."""
    parts = [re.sub(r"[^a-z0-9_]", "_", x.lower()) for x in (instance, database, schema)]
    full = "__".join(parts)
    if len(full) <= limit:
        return full
    digest = hashlib.md5(parts[0].encode()).hexdigest()[:8]
    return f"{digest}__{'__'.join(parts[1:])[: limit - 10]}"


def host_alias(host: str, aliases: dict[str, str]) -> str:
    """The alias of a server name: as given, without ``,port``, then without ``\\instance``."""
    for key in (host, host.split(",")[0], host.split(",")[0].split("\\")[0]):
        if key.lower() in aliases:
            return aliases[key.lower()]
    raise KeyError(f"no alias for host {host!r}")


def read_aliases(text: str) -> dict[str, str]:
    """``name = alias`` lines; ``#`` starts a comment; of repeated names the last counts."""
    pairs = (line.split("#")[0].partition("=") for line in text.splitlines())
    return {k.strip().lower(): v.strip() for k, sep, v in pairs if sep and k.strip()}


def read_list(text: str) -> list[str]:
    """One table a line; blank lines and comments don't count."""
    return [x for line in text.splitlines() if (x := line.split("#")[0].strip())]


def split_table(name: str, default_schema: str | None = None) -> tuple[str, str]:
    """``schema.table`` or ``[schema].[table]``, split at the first dot outside of brackets; ``]]`` is a bracket in a name.

    An entry without a schema is an error unless a default is given; so are empty parts and open brackets.
    """
    parts, rest = [], name.strip()
    while rest and len(parts) < 2:
        if rest[0] == "[":
            part, at = "", 1
            while at < len(rest) and (rest[at] != "]" or rest[at : at + 2] == "]]"):
                part += rest[at]
                at += 1 + (rest[at] == "]")
            if at == len(rest):
                raise ValueError(f"open bracket in {name!r}")
            rest = rest[at + 1 :]
        else:
            part, dot, after = rest.partition(".") if not parts else (rest, "", "")
            rest = dot + after
        parts.append(part.strip())
        if rest and (rest[0] != "." or len(parts) == 2 or len(rest) == 1):
            raise ValueError(f"not a table name: {name!r}")
        rest = rest[1:]
    if len(parts) == 1 and default_schema:
        parts.insert(0, default_schema)
    if len(parts) != 2 or not all(parts):
        raise ValueError(f"not a schema and a table: {name!r}")
    return parts[0], parts[1]


def expand_tables(value: str | Iterable[str] | None) -> list[str]:
    """A JSON list, a comma list, or a list whose entries may be comma lists."""
    if not value:
        return []
    if isinstance(value, str):
        value = json.loads(value) if value.lstrip().startswith("[") and not re.match(r"\s*\[[A-Za-z_]", value) else [value]
    return [x for entry in value for part in entry.split(",") if (x := part.strip())]


def is_safe(name: str, limit: int = 128) -> bool:
    return len(name) <= limit and bool(_PLAIN.fullmatch(name))


def quote_brackets(name: str) -> str:
    return f"[{name.replace(']', ']]')}]"


def quote_double(name: str) -> str:
    escaped = name.replace('"', '""')
    return f'"{escaped}"'


def quote_backtick(name: str) -> str:
    return f"`{name.replace('`', '``')}`"


def human_bytes(n: float) -> str:
    for unit in ("B", "KB", "MB", "GB", "TB"):
        if abs(n) < 1024 or unit == "TB":
            return f"{n:.2f} {unit}"
        n /= 1024
    raise AssertionError


def human_seconds(s: float) -> str:
    if s < 60:
        return f"{s:.1f}s"
    return f"{int(s // 60)}m {int(s % 60)}s" if s < 3600 else f"{int(s // 3600)}h {int(s % 3600 // 60)}m"


def human_number(n: float) -> str:
    """1,234 up to a million, then 1.23M or 1.23B."""
    for size, unit in ((1_000_000_000, "B"), (1_000_000, "M")):
        if abs(n) >= size:
            return f"{n / size:.2f}{unit}"
    return f"{n:,.0f}"


def shortened(text: str, limit: int = 100) -> str:
    return text if len(text) <= limit else text[: max(limit - 3, 0)] + "..."
