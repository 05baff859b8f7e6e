"""Validation: row counts, keyed samples, checksums, and the report."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.digests import encoded

#: rows of a sample that may be broadcast with their values
MOST_SAMPLED = 100_000


def count_check(table: str, source: DataFrame, target: DataFrame) -> DataFrame:
    """One row: both counts, target minus source, percent of the source (0 if that is empty), passed."""
    return batch_check({table: (source, target)})


def batch_check(pairs: dict[str, tuple[DataFrame, DataFrame]]) -> DataFrame:
    """A row for each table, from one aggregate over all tables and sides."""
    side = lambda df, t, s: df.agg(F.count("*").alias("n")).select(F.lit(t).alias("table_name"), *((F.col("n") if s == x else F.lit(0).cast("long")).alias(f"{x}_count") for x in ("source", "target")))
    counted = reduce(DataFrame.unionByName, (side(df, t, s) for t, both in pairs.items() for s, df in zip(("source", "target"), both)))
    both = counted.groupBy("table_name").agg(F.sum("source_count").alias("source_count"), F.sum("target_count").alias("target_count"))
    difference = F.col("target_count") - F.col("source_count")
    percent = F.when(F.col("source_count") > 0, difference * 100.0 / F.col("source_count")).otherwise(F.lit(0.0))
    return both.select("table_name", "source_count", "target_count", difference.alias("row_difference"), percent.alias("percentage_difference"), (difference == 0).alias("validation_passed"))


def batch_summary(checks: DataFrame) -> DataFrame:
    passed = F.sum(F.col("validation_passed").cast("long"))
    total = F.count("*")
    return checks.agg(total.alias("tables"), F.coalesce(passed, F.lit(0)).alias("passed"), F.when(total > 0, passed * 100.0 / total).otherwise(F.lit(0.0)).alias("success_rate"))


def sample_check(source: DataFrame, target: DataFrame, key: list[str], n: int, columns: list[str] | None = None) -> DataFrame:
    """(compared, mismatches) of the first n source keys, compared by key and null-safely.

    The keys of the sample, n at most, are broadcast to the target's rows, so that the target isn't shuffled.
    """
    columns = columns or [c for c in source.columns if c not in key][:5]
    sample = source.select(*key, F.struct(*columns).alias("s")).orderBy(*key).limit(n)
    met = target.select(*key, F.struct(*columns).alias("t")).join(F.broadcast(sample.select(*key)), key, "left_semi")
    joined = sample.join(F.broadcast(met) if n <= MOST_SAMPLED else met, key, "left")
    differs = F.col("t").isNull() | reduce(lambda a, b: a | b, (~F.col(f"s.{c}").eqNullSafe(F.col(f"t.{c}")) for c in columns))
    return joined.agg(F.count("*").alias("compared"), F.coalesce(F.sum(differs.cast("long")), F.lit(0)).alias("mismatches"))


def row_digest(columns: list[str]) -> F.Column:
    """MD5 of the row's values, of which no two different rows have the same text."""
    return F.md5(encoded(columns))


def table_checksum(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """(n, checksum): the sum of the first 60 bits of the rows' MD5, so independent of their order, and the same in any engine; one pass.

    Halves of 30 bits are added up as long numbers inside each input partition, which has less than 2**33 rows, and these sums as decimals.
    """
    bits = F.conv(F.substring(row_digest(columns or df.columns), 1, 15), 16, 10).cast("long").alias("x")
    half = 1 << 30
    parts = df.select(bits, F.spark_partition_id().alias("p")).groupBy("p").agg(F.count("*").alias("n"), F.sum(F.shiftright("x", 30)).alias("high"), F.sum(F.col("x").bitwiseAND(half - 1)).alias("low"))
    wide = lambda c: F.sum(F.col(c).cast("decimal(20,0)"))
    total = (wide("high") * F.lit(half) + wide("low")).cast("decimal(38,0)")
    return parts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.coalesce(total, F.lit(0)).cast("string").alias("checksum"))


def report(checks: list[dict], transfers: list[dict] = ()) -> str:
    """Fixed-width text for people: a line for each table, then the totals, then the tables that differ."""
    rule, thin = "=" * 80, "-" * 80
    lines = [rule, "MIGRATION VALIDATION REPORT", rule, f"{'Table':<40}{'Source':>12}{'Target':>12}{'Diff':>10}  Status", thin]
    for c in checks:
        lines.append(f"{c['table_name']:<40}{c['source_count']:>12,}{c['target_count']:>12,}{c['row_difference']:>+10,}  {'PASS' if c['validation_passed'] else 'FAIL'}")
    passed = sum(bool(c["validation_passed"]) for c in checks)
    rows = sum(t["rows_transferred"] for t in transfers)
    seconds = sum(t["elapsed_time_seconds"] for t in transfers)
    lines += [thin, "SUMMARY", f"Passed: {passed}/{len(checks)} ({100 * passed / len(checks) if checks else 0:.1f}%)"]
    lines.append(f"Source rows: {sum(c['source_count'] for c in checks):,}  Target rows: {sum(c['target_count'] for c in checks):,}")
    if transfers:
        lines.append(f"Rows: {rows:,}  Seconds: {seconds:.1f}  Rows/s: {rows / seconds if seconds else 0:,.0f}")
    failed = [c for c in checks if not c["validation_passed"]]
    lines += [f"DIFFERS: {c['table_name']} by {c['row_difference']:+,} ({c.get('percentage_difference', 0.0):+.2f}%)" for c in failed]
    lines.append(f"Status: {'FAILED' if failed else 'PASSED'}")
    return "\n".join(lines)


def run_message(checks: list[dict], missing: list[str] = ()) -> tuple[str, str]:
    """(status, message) of a validation run; the rate is over the tables that could be compared. Missing tables outrank failed ones."""
    failed = [c["table_name"] for c in checks if not c["validation_passed"]]
    rate = 100 * (len(checks) - len(failed)) / len(checks) if checks else 0.0
    if missing:
        return "missing", f"{len(missing)} tables missing in the target: {', '.join(sorted(missing))}; {len(checks) - len(failed)}/{len(checks)} passed ({rate:.1f}%)"
    if failed:
        return "failed", f"{len(failed)} of {len(checks)} tables differ: {', '.join(sorted(failed))}; {rate:.1f}% passed"
    return "success", f"all {len(checks)} tables passed"
