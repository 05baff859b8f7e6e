"""How much at once: page sizes, partition counts, ranges. Plain arithmetic on row counts."""

from __future__ import annotations

from collections.abc import Iterable

# Bytes that a value of a source type is taken for; others 50.
WIDTHS = {
    "bit": 1, "tinyint": 1, "smallint": 2, "int": 4, "bigint": 8, "real": 4, "float": 8,
    "date": 4, "time": 8, "datetime": 8, "datetime2": 8, "smalldatetime": 4, "datetimeoffset": 10,
    "uniqueidentifier": 16, "money": 8, "smallmoney": 4,
    "varchar": 50, "nvarchar": 100, "char": 20, "nchar": 40, "text": 200, "ntext": 400,
    "binary": 50, "varbinary": 100, "image": 500, "xml": 500, "decimal": 17, "numeric": 17,
}
OTHER_WIDTH = 50


def page_size(rows: int, asked: int) -> int:
    """Rows fetched at once for a table of so many rows; an unknown count leaves what was asked."""
    if rows <= 0:
        return asked
    if rows < 100_000:
        size = min(asked, 10_000)
    else:
        floor = 20_000 if rows < 1_000_000 else 50_000 if rows < 5_000_000 else 100_000
        size = max(asked, floor)
    return min(max(size, 5_000), 200_000)


def row_width(types: Iterable[str]) -> int:
    """Estimated bytes of a row of columns of these source types."""
    return sum(WIDTHS.get(kind.lower().split("(")[0], OTHER_WIDTH) for kind in types)


def page_size_by_width(columns: int, width: int, asked: int, budget: int = 50 << 20) -> int:
    """Fewer rows of wide tables: a factor by column count, averaged with what fits the budget."""
    steps = ((5, 2.0), (10, 1.5), (20, 1.0), (40, 0.5))
    factor = next((f for most, f in steps if columns <= most), 0.25)
    by_columns = asked * factor
    size = (by_columns + budget / width) / 2 if width > 0 else by_columns
    return int(min(max(size, 10_000), 500_000))


def partition_count(rows: int, most: int = 8) -> int:
    return min(2, most) if rows < 2_000_000 else min(4, most) if rows < 5_000_000 else most


def incremental_partition_count(rows: int, most: int = 6) -> int:
    return min(most, max(2, rows // 500_000))


def key_ranges(low: int, high: int, n: int) -> list[tuple[int, int]]:
    """n inclusive ranges of equal width over integers; the last takes the remainder."""
    if high < low or n < 1:
        return []
    size = max(1, (high - low + 1) // n)
    n = min(n, high - low + 1)
    return [(low + i * size, high if i == n - 1 else low + (i + 1) * size - 1) for i in range(n)]


def row_ranges(rows: int, n: int) -> list[tuple[int, int]]:
    """Row numbers from 1, n ranges of ceil(rows / n)."""
    size = -(-rows // n)
    return [(i * size + 1, min((i + 1) * size, rows)) for i in range(n) if i * size < rows]


def reader_shares(rows: int, readers: int) -> list[int]:
    share = rows // readers
    return [share] * (readers - 1) + [rows - share * (readers - 1)]
