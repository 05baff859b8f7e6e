"""Quality rules with host verdicts.

Each document is measured and judged by two base rules (fewer than 50 words; more than half of the
words inside repeated 3-word windows). Failures are then aggregated by host (``source``), each
host's failure rate is shrunk towards the corpus with a beta prior fitted to all hosts by the
method of moments, and the host's verdict is joined back: a host is rejected with all of its documents
if its shrunk rate exceeds both ``HOST_TIMES`` times the corpus rate and ``HOST_FLOOR``. So the limit
follows the corpus, one bad document doesn't reject a small host, and where hosts differ by chance
only none goes.

Scale: no text is shuffled or written in between; only counts per host are shuffled (pre-aggregated on the map side,
so a host with a third of all rows sends one row per task). Only rejected hosts are joined back, a
list that Spark broadcasts if it is small enough and otherwise splits by size.

Edge cases: a null or empty text has no words and fails; a null source is a host of its own; repeated
rows are judged one by one; extra columns pass through :func:`keep_good`, whatever their names; an
empty table gives an empty result; with one host, or hosts of equal rates, the prior is the corpus
rate with weight 1.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm import textkernel as tk
from tidemark.llm.workspace import bound_batches, materialize, own_prefix

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
HOST_TIMES, HOST_FLOOR = 3.0, 0.3
SYMBOLS = b"#*$%&|<>"

MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]

_IS_SYMBOL = np.isin(np.arange(256), list(SYMBOLS))
_STARTS_CHARACTER = (np.arange(256) & 0xC0) != 0x80


def _sum_by_text(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    return np.diff(np.concatenate([[0], np.cumsum(flags)])[offsets])


def _repeat_mask(group: np.ndarray, *hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of each entry whether (group, hashes) occurs more than once, and whether it has occurred before."""
    order = np.lexsort((*hashes, group))
    new = np.ones(len(order), dtype=bool)
    new[1:] = np.any([c[order][1:] != c[order][:-1] for c in (group, *hashes)], axis=0)
    head = np.flatnonzero(new)
    size = np.diff(np.append(head, len(order)))
    many = np.zeros(len(order), dtype=bool)
    many[order] = np.repeat(size > 1, size)
    later = np.ones(len(order), dtype=bool)
    later[order[head]] = False  # lexsort is stable: the head is the earliest
    return many, later


def repeated_words(t: tk.Texts) -> np.ndarray:
    """Of each text the words in 3-word windows that it holds more than once."""
    at, (h,) = tk.windows(t, 3)
    doc = t.doc
    many, _ = _repeat_mask(doc[at], h)
    covered = np.zeros(len(t.start), dtype=bool)
    for shift in range(3):
        covered[at[many] + shift] = True
    return np.bincount(doc[covered], minlength=len(t.offsets) - 1)


def base_failed(n_words: np.ndarray, n_repeat_words: np.ndarray) -> np.ndarray:
    return (n_words < MIN_WORDS) | (100 * n_repeat_words > MAX_REPEAT_PERCENT * n_words)


def measure(t: tk.Texts) -> dict[str, np.ndarray]:
    texts = len(t.offsets) - 1
    inside = ~tk._SEPARATOR[t.bytes]
    out = {
        "n_words": t.n_words,
        "word_chars": _sum_by_text(inside & _STARTS_CHARACTER[t.bytes], t.offsets),
        "n_symbols": _sum_by_text(_IS_SYMBOL[t.bytes], t.offsets),
    }
    # lines: cut at \n and at the ends of texts
    breaks = np.flatnonzero(t.bytes == 0x0A)
    begin = np.sort(np.concatenate([t.offsets[:-1], breaks + 1]))
    doc = np.searchsorted(t.offsets, begin, side="right") - 1
    doc = np.minimum(doc, texts - 1)
    end = np.minimum(np.append(begin[1:], len(t.bytes)), t.offsets[doc + 1])
    end = np.where((end > begin) & (t.bytes[np.maximum(end - 1, 0)] == 0x0A), end - 1, end) if len(t.bytes) else end
    worded = np.searchsorted(t.start, end) > np.searchsorted(t.start, begin)
    begin, end, doc = begin[worded], end[worded], doc[worded]
    hashes = [tk.segment_hashes(t.bytes, begin, end, k) for k in (0, 1)]
    _, later = _repeat_mask(doc, *hashes)
    out["n_dup_lines"] = np.bincount(doc[later], minlength=texts)
    out["n_repeat_words"] = repeated_words(t)
    return out


def _measured(text: str, own: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in tk.gathered(batches, text):
            found = measure(tk.read_texts(batch.column(text)))
            failed = base_failed(found["n_words"], found["n_repeat_words"])
            names, columns = list(batch.schema.names), list(batch.columns)
            for k in MEASURES:
                names.append(f"{own}{k}")
                columns.append(pa.array(found[k], pa.int64()))
            yield pa.RecordBatch.from_arrays([*columns, pa.array(failed)], [*names, f"{own}base_failed"])

    return run


def measured(docs: DataFrame, text: str = "text", own: str = "__") -> DataFrame:
    """``docs`` with the measures and the verdict ``base_failed`` as columns whose names begin with ``own``."""
    schema = T.StructType([*docs.schema.fields, *(T.StructField(f"{own}{k}", T.LongType()) for k in MEASURES), T.StructField(f"{own}base_failed", T.BooleanType())])
    return bound_batches(docs).mapInArrow(_measured(text, own), schema)


def _judged(text: str, failed: str, keep: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in tk.gathered(batches, text):
            t = tk.read_texts(batch.column(text))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), pa.array(base_failed(t.n_words, repeated_words(t)))], [*keep, failed])

    return run


def judged(docs: DataFrame, text: str, failed: str, keep: list[str]) -> DataFrame:
    """The columns ``keep`` of ``docs`` and the verdict of the base rules, without the other measures."""
    schema = T.StructType([*(docs.schema[c] for c in keep), T.StructField(failed, T.BooleanType())])
    return bound_batches(docs).mapInArrow(_judged(text, failed, keep), schema)


def host_rates(judged: DataFrame, host: str, failed: str) -> DataFrame:
    """(host, n, failures, rate, rejected): failure rates shrunk with the empirical beta prior, and the verdict."""
    hosts = materialize(judged.groupBy(F.col(host).alias("host")).agg(F.count("*").alias("n"), F.sum(F.col(failed).cast("long")).alias("failures")))
    m, v = hosts.agg(F.sum("failures") / F.sum("n"), F.var_pop(F.col("failures") / F.col("n"))).first()
    m = m or 0.0
    weight = max(1.0, m * (1 - m) / v - 1) if v else 1.0
    rates = hosts.withColumn("rate", (F.col("failures") + F.lit(m * weight)) / (F.col("n") + F.lit(weight)))
    return rates.withColumn("rejected", F.col("rate") > F.lit(max(HOST_FLOOR, HOST_TIMES * m)))


def keep_good(docs: DataFrame, text: str = "text", host: str = "source") -> DataFrame:
    """The rows of ``docs`` that neither a base rule nor their host's verdict rejects.

    Texts are read and judged twice, for the hosts and for the rows: that takes less than to write them in between.
    """
    own = own_prefix(docs)
    failed = f"{own}base_failed"
    hosts = judged(docs.select(F.col(host).alias("host"), F.col(text).alias("text")), "text", failed, ["host"])
    rejected = host_rates(hosts, "host", failed).where("rejected").select(F.col("host").alias(f"{own}host"))
    good = judged(docs, text, failed, docs.columns).where(~F.col(failed)).select(docs.columns)
    return good.join(rejected, good[host].eqNullSafe(rejected[f"{own}host"]), "left_anti")


def op5_quality_rules(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "source", "text")
    judged = materialize(measured(docs).drop("text"))
    rejected = host_rates(judged, "source", "__base_failed").where("rejected").select("host", "rejected")
    out = judged.join(rejected, judged["source"].eqNullSafe(rejected["host"]), "left")
    return out.select(
        "doc_id",
        *(F.col(f"__{k}").alias(k) for k in MEASURES),
        F.col("__base_failed").alias("base_failed"),
        (~F.col("__base_failed") & F.col("rejected").isNull()).alias("kept"),
    )


# DuckDB: the same words, lines, windows and prior, document by document.
ORACLE = r"""
with w as (
  select doc_id, source, coalesce(text, '') t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') ws from documents
), g as (
  select doc_id, unnest(list_transform(range(1, greatest(len(ws) - 1, 1)), lambda i: {'i': i, 'g': ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2]})) x
  from w where len(ws) >= 3
), r as (
  select doc_id, x.i i, count(*) over (partition by doc_id, x.g) c from g
), rep as (
  select doc_id, count(distinct p) n from (select doc_id, unnest([i, i + 1, i + 2]) p from r where c > 1) group by doc_id
), l as (
  select doc_id, unnest(string_split(t, chr(10))) line from w
), dup as (
  select doc_id, count(*) - count(distinct line) n from l where regexp_matches(line, '[^\x20\x09-\x0D]') group by doc_id
), m as (
  select w.doc_id, source, len(ws)::bigint n_words, length(array_to_string(ws, ''))::bigint word_chars,
         length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::bigint n_symbols,
         coalesce(dup.n, 0)::bigint n_dup_lines, coalesce(rep.n, 0)::bigint n_repeat_words
  from w left join dup using (doc_id) left join rep using (doc_id)
), b as (
  select *, (n_words < 50 or 100 * n_repeat_words > 50 * n_words) base_failed from m
), h as (
  select source, count(*) n, sum(base_failed::int) f from b group by source
), p as (
  select sum(f) / sum(n) m, var_pop(f / n) v from h
), q as (
  select m, case when v > 0 then greatest(1.0, m * (1 - m) / v - 1) else 1.0 end k from p
)
select b.doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       (not base_failed and not ((h.f + q.m * q.k) / (h.n + q.k) > greatest(0.3, 3 * q.m))) kept
from b join h on b.source is not distinct from h.source, q
"""
