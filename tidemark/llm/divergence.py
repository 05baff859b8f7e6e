"""Source divergence audit: which sources of a language write unlike the others, and by which terms.

Terms are maximal runs of ASCII letters and characters beyond ASCII, A-Z lower-cased. A language keeps the terms that
at least ``LEAST`` of its documents hold. Each (language, source) group, and each language, gives a kept term the share
p = 1 + floor(SCALE * (count + 1) / (N + V)); two shares differ by floor((p - q)**2 / q), all in whole numbers.

Sketch first: every task adds its documents' distinct terms to a count-min sketch of document frequencies, the sketches
are merged by sum, and since such a sum is never less than the true frequency, a term with less than ``LEAST`` in one
of its cells can't be kept. The second pass drops these where the texts are read, before anything is shuffled; the
others are counted exactly, so the sketch decides what travels and never what is kept.

Pairs of sources are sparse: with the share z of a term that a group lacks, the sum over all V terms is V * f(z, z'), plus
what each side's own terms change against that (a sum over its distinct counts), plus a correction for terms that both
hold, from a join of the counts by term. A pair with nothing in common costs nothing in that join.

Scale: two passes over the texts; rows are aggregated per batch, per task, then by (language, source, term). Cells grow with the
number of documents up to ``MOST_CELLS`` in each of two rows (128 MB in a Python worker, 16 MB of bits broadcast); beyond that
the sketch discards less and more is shuffled, with the same result. A term that many sources share, and a language of many
sources, meets itself in blocks of ``BLOCK`` sources, so that no task makes all pairs of one key. Terms of one batch are told apart
by 64-bit hashes.

Edge cases: null text, language and source count as ''; a group without terms has its rows of pairs, by shares of its unseen
terms; a language without kept terms has pairs of value 0; repeated rows count each; equal values are ranked by the UTF-8 bytes of their
items; further columns aren't read; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm import textkernel as tk
from tidemark.llm.workspace import bound_batches, materialize

LEAST = 3
SCALE = 1_000_000_000
TOP = 200
CELLS_A_DOCUMENT = 32
FEWEST_CELLS, MOST_CELLS = 1 << 16, 1 << 26
PARTS = 64
BLOCK = 256
BATCH_BYTES = 4 << 20

_BYTES = np.arange(256)
_NO_TERM = ~((_BYTES >= 0x80) | ((_BYTES >= 0x41) & (_BYTES <= 0x5A)) | ((_BYTES >= 0x61) & (_BYTES <= 0x7A)))
_LOWER = np.where((_BYTES >= 0x41) & (_BYTES <= 0x5A), _BYTES + 0x20, _BYTES).astype(np.uint8)


def _codes(column: pa.Array) -> np.ndarray:
    """A 64-bit hash of each string, the same in every task."""
    made = column.dictionary_encode()
    known = np.array([xxhash.xxh64_intdigest(x.as_py()) for x in made.dictionary], np.uint64)
    return known[made.indices.to_numpy(zero_copy_only=False)] if len(known) else np.zeros(0, np.uint64)


def terms(batch: pa.RecordBatch) -> tuple[tk.Texts, np.ndarray, np.ndarray]:
    """The terms of a batch (lang, text), the row of each, and a key of each by language and term."""
    raw, offsets = tk.text_bytes(batch.column("text"))
    t = tk.split_words(_LOWER[raw], offsets, _NO_TERM)
    row = t.doc
    return t, row, tk.mix(t.hashes() ^ _codes(batch.column("lang"))[row])


def tally(key: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each key, in order: one of its entries, how many it has, and in how many rows. Rows ascend."""
    order = np.argsort(key, kind="stable")
    k, r = key[order], row[order]
    other_key = np.ones(len(k), bool)
    other_key[1:] = k[1:] != k[:-1]
    other_row = other_key.copy()
    other_row[1:] |= r[1:] != r[:-1]
    head = np.flatnonzero(other_key)
    rows = np.add.reduceat(other_row, head, dtype=np.int64) if len(head) else np.zeros(0, np.int64)
    return order[head], np.diff(np.append(head, len(k))), rows


def cells_of(key: np.ndarray, cells: int) -> list[np.ndarray]:
    """The places of a key in the two rows of a sketch, that lie one behind the other."""
    mask = np.uint64(cells - 1)
    return [(key & mask).astype(np.int64), ((key >> np.uint64(32)) & mask).astype(np.int64) + cells]


def _add(sketch: np.ndarray, at: np.ndarray, n: np.ndarray) -> None:
    """Add up to LEAST: more makes no difference, and sums of such sums are still no less than LEAST where the true ones aren't."""
    place, inverse = np.unique(at, return_inverse=True)
    sketch[place] = np.minimum(sketch[place] + np.bincount(inverse, n, len(place)).astype(np.int64), LEAST)


def _sketched(cells: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketch = np.zeros(2 * cells, np.uint8)
        for batch in tk.gathered(batches, limit=BATCH_BYTES):
            _, row, key = terms(batch)
            at, _, rows = tally(key, row)
            for place in cells_of(key[at], cells):
                _add(sketch, place, rows)
        used = np.flatnonzero(sketch)
        size = 2 * cells // PARTS
        cut = np.searchsorted(used, np.arange(1, PARTS) * size)
        rows = [(p, (x - p * size).astype(np.int32).tobytes(), sketch[x].tobytes()) for p, x in enumerate(np.split(used, cut)) if len(x)]
        yield pa.RecordBatch.from_pylist([dict(zip(("part", "place", "n"), r)) for r in rows], pa.schema([("part", pa.int32()), ("place", pa.binary()), ("n", pa.binary())]))

    return run


def _merged(cells: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for part, place, n in zip(*(batch.column(c) for c in ("part", "place", "n"))):
                own = total.setdefault(part.as_py(), np.zeros(2 * cells // PARTS, np.uint8))
                at = np.frombuffer(place.as_buffer(), np.int32)
                own[at] = np.minimum(own[at] + np.frombuffer(n.as_buffer(), np.uint8), LEAST)
        bits = [np.packbits(x >= LEAST, bitorder="little").tobytes() for x in total.values()]
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array(bits, pa.binary())], ["part", "bits"])

    return run


def possible(docs: DataFrame, cells: int) -> np.ndarray:
    """A bit for each cell of the merged sketch: whether its document frequency reaches LEAST."""
    parts = bound_batches(docs.select("lang", "text")).mapInArrow(_sketched(cells), "part int, place binary, n binary")
    out = np.zeros((PARTS, 2 * cells // PARTS // 8), np.uint8)
    for r in parts.repartitionById(PARTS, "part").mapInArrow(_merged(cells), "part int, bits binary").collect():  # two bits a cell in all
        out[r.part] = np.frombuffer(r.bits, np.uint8)
    return out.ravel()


def _survivors(bits, cells: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = bits.value
        for batch in tk.gathered(batches, limit=BATCH_BYTES):
            t, row, key = terms(batch)
            may = np.ones(len(key), bool)
            for place in cells_of(key, cells):
                may &= (known[place >> 3] >> (place & 7)) & 1 > 0
            kept = np.flatnonzero(may)
            row, key = row[kept], key[kept]
            at, n, rows = tally(tk.mix(key ^ tk.mix(_codes(batch.column("source"))[row])), row)
            word, of = kept[at], pa.array(row[at])
            size = t.end[word] - t.start[word]
            to = np.concatenate([[0], np.cumsum(size)])
            letters = t.bytes[np.arange(to[-1]) + np.repeat(t.start[word] - to[:-1], size)]
            term = pa.StringArray.from_buffers(len(word), pa.py_buffer(to.astype(np.int32)), pa.py_buffer(letters))
            yield pa.RecordBatch.from_arrays([batch.column("lang").take(of), batch.column("source").take(of), term, pa.array(n, pa.int64()), pa.array(rows, pa.int64())], ["lang", "source", "term", "n", "docs"])

    return run


def counted(docs: DataFrame, cells: int) -> DataFrame:
    """(lang, source, term, n, docs) of all terms that the sketch leaves possible."""
    bits = docs.sparkSession.sparkContext.broadcast(possible(docs, cells))
    rows = bound_batches(docs).mapInArrow(_survivors(bits, cells), "lang string, source string, term string, n long, docs long")
    return rows.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def share(n: Column | str, total: Column | str, kept: Column | str) -> Column:
    n, total, kept = (F.col(x) if isinstance(x, str) else x for x in (n, total, kept))
    scaled = F.lit(SCALE).cast("decimal(10,0)") * (n + 1).cast("decimal(20,0)")
    return F.call_function("div", scaled, F.nullif((total + kept).cast("decimal(20,0)"), F.lit(0).cast("decimal(20,0)"))) + 1


def distance(p: Column | str, q: Column | str) -> Column:
    p, q = (F.col(x) if isinstance(x, str) else x for x in (p, q))
    return F.call_function("div", (p - q) * (p - q), q)


def _big(x: Column) -> Column:
    return x.cast("decimal(20,0)")


def _in_blocks(rows: DataFrame, keys: list[str], many: str, where: Column) -> DataFrame:
    """All pairs of rows of equal ``keys``, the left ones' other columns with prefix a_, the right ones' with b_.

    ``many``: how many rows a key has. The left rows are dealt to as many parts as BLOCK goes into that, and the right ones meet each part.
    """
    parts = F.ceil(F.col(many) / BLOCK).cast("int")
    others = [c for c in rows.columns if c not in (*keys, many)]
    left = rows.select(*keys, F.pmod(F.xxhash64("source"), parts).cast("int").alias("part"), *(F.col(c).alias(f"a_{c}") for c in others))
    right = rows.select(*keys, F.explode(F.sequence(F.lit(0), parts - 1)).alias("part"), *(F.col(c).alias(f"b_{c}") for c in others))
    return left.join(right, [*keys, "part"]).where(where).drop("part")


def divergences(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source", top: int = TOP, cells: int | None = None) -> DataFrame:
    """(lang, source, part, item, value, rank): how far each source is from each other one, and its most telling terms."""
    texts = docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(n) for c, n in ((lang, "lang"), (source, "source"), (text, "text"))))
    if cells is None:
        cells = min(max(FEWEST_CELLS, 1 << (CELLS_A_DOCUMENT * max(1, texts.count()) - 1).bit_length()), MOST_CELLS)
    counts = materialize(counted(texts, cells))
    kept = counts.groupBy("lang", "term").agg(F.sum("n").alias("total"), F.sum("docs").alias("docs"), F.count("*").alias("holders")).where(F.col("docs") >= LEAST).drop("docs")
    known = materialize(counts.drop("docs").join(kept, ["lang", "term"]))

    # languages and groups: N, V and the share z of a term that the group lacks
    of_lang = known.groupBy("lang", "term").agg(F.first("total").alias("total")).groupBy("lang").agg(F.sum("total").alias("lang_n"), F.count("*").alias("v"))
    groups = texts.select("lang", "source").distinct()
    own = known.groupBy("lang", "source").agg(F.sum("n").alias("group_n"))
    sources = groups.groupBy("lang").agg(F.count("*").alias("sources"))
    zero = F.lit(0).cast("long")
    described = groups.join(own, ["lang", "source"], "left").join(of_lang, "lang", "left").join(sources, "lang")
    described = described.select("lang", "source", "sources", *(F.coalesce(c, zero).alias(c) for c in ("group_n", "lang_n", "v")))
    described = materialize(described.withColumn("z", share(zero, "group_n", "v")))

    shares = known.join(described.select("lang", "source", "group_n", "lang_n", "v", "z"), ["lang", "source"]).withColumn("p", share("n", "group_n", "v"))
    return _pairs(described, materialize(shares.select("lang", "source", "term", "holders", "n", "p", "z"))).unionByName(_terms(shares, top))


def _ranked(rows: DataFrame, part: str) -> DataFrame:
    rank = F.expr("row_number() over (partition by lang, source order by value desc, item)").cast("int")
    return rows.select("lang", "source", F.lit(part).alias("part"), "item", "value", rank.alias("rank"))


def _terms(shares: DataFrame, top: int) -> DataFrame:
    told = shares.withColumn("q", share("total", "lang_n", "v")).where(F.col("p") > F.col("q"))
    return _ranked(told.select("lang", "source", F.col("term").alias("item"), distance("p", "q").alias("value")), "term").where(F.col("rank") <= top)


def _pairs(described: DataFrame, shares: DataFrame) -> DataFrame:
    groups = described.select("lang", "source", "sources", "v", "z")
    pairs = _in_blocks(groups, ["lang"], "sources", F.col("a_source") != F.col("b_source"))
    pairs = materialize(pairs.select("lang", "a_source", "b_source", "a_v", "a_z", "b_z", distance("a_z", "b_z").alias("base")))
    steps = shares.groupBy("lang", "source", "p").agg(F.count("*").alias("m"))  # a group's terms of one share change a sum alike
    change = lambda f: F.sum(_big(F.col("m")) * _big(f - F.col("base"))).alias("change")
    at = lambda side: steps.withColumnRenamed("source", f"{side}_source")
    pair = ["lang", "a_source", "b_source"]
    left = pairs.join(at("a"), ["lang", "a_source"]).groupBy(*pair).agg(change(distance("p", "b_z")))
    right = pairs.join(at("b"), ["lang", "b_source"]).groupBy(*pair).agg(change(distance("a_z", "p")))

    # terms that both hold, each two sources once, for both directions
    met = _in_blocks(shares.select("lang", "term", "source", "holders", "p", "z"), ["lang", "term"], "holders", F.col("a_source") < F.col("b_source"))
    both = lambda x, y: _big(distance(f"{x}_p", f"{y}_p") - distance(f"{x}_p", f"{y}_z") - distance(f"{x}_z", f"{y}_p") + distance(f"{x}_z", f"{y}_z"))
    common = materialize(met.groupBy(*pair).agg(F.sum(both("a", "b")).alias("there"), F.sum(both("b", "a")).alias("back")))
    there = common.select(*pair, F.col("there").alias("change"))
    back = common.select("lang", F.col("b_source").alias("a_source"), F.col("a_source").alias("b_source"), F.col("back").alias("change"))

    wide = lambda df: df.select(*pair, F.col("change").cast("decimal(38,0)").alias("change"))
    start = pairs.select(*pair, F.coalesce(_big(F.col("a_v")) * _big(F.col("base")), _big(F.lit(0))).alias("change"))
    total = wide(start).unionByName(wide(left)).unionByName(wide(right)).unionByName(wide(there)).unionByName(wide(back))
    value = total.groupBy(*pair).agg(F.sum("change").cast("long").alias("value"))
    return _ranked(value.select("lang", F.col("a_source").alias("source"), F.col("b_source").alias("item"), "value"), "pair")


def op11_source_divergence(spark, sf_dir: str) -> DataFrame:
    return divergences(spark.read.parquet(f"{sf_dir}/documents.parquet"))


# DuckDB: every group with every kept term of its language, and every two groups.
ORACLE = r"""
with d as (
  select row_number() over () id, coalesce(lang, '') lang, coalesce(source, '') source, coalesce(text, '') t from documents
), w as (
  select id, lang, source, unnest(regexp_extract_all(translate(t, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) term from d
), c as (
  select lang, source, term, count(*) n, count(distinct id) docs from w group by all
), k as (
  select lang, term, sum(n)::hugeint total from c group by all having sum(docs) >= 3
), g as (
  select distinct lang, source from d
), l as (
  select lang, count(term)::hugeint v, coalesce(sum(total), 0)::hugeint n from (select distinct lang from g) left join k using (lang) group by lang
), s as (
  select lang, source, coalesce(sum(c.n), 0)::hugeint n from g left join (c semi join k using (lang, term)) c using (lang, source) group by all
), p as (
  select s.lang, s.source, k.term, coalesce(c.n, 0) n, 1 + (1000000000::hugeint * (coalesce(c.n, 0) + 1)) // (s.n + l.v) p, 1 + (1000000000::hugeint * (k.total + 1)) // (l.n + l.v) q
  from s join l using (lang) join k using (lang) left join c on c.lang = s.lang and c.source = s.source and c.term = k.term
), v as (
  select a.lang, a.source, b.source item, sum((a.p - b.p) * (a.p - b.p) // b.p)::bigint as value from p a join p b on a.lang = b.lang and a.term = b.term and a.source <> b.source group by all
), o as (
  select a.lang, a.source, 'pair' part, b.source item, coalesce(v.value, 0) as value
  from g a join g b on a.lang = b.lang and a.source <> b.source left join v on v.lang = a.lang and v.source = a.source and v.item = b.source
  union all select lang, source, 'term', term, ((p - q) * (p - q) // q)::bigint from p where n > 0 and p > q
), r as (
  select *, row_number() over (partition by lang, source, part order by value desc, item)::int as rank from o
)
select lang, source, part, item, value, rank from r where part = 'pair' or rank <= 200
"""
