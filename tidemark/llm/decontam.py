"""Benchmark decontamination with spaced seeds; DataFrame functions only.

A seed is a fixed mask over up to ``SPAN`` consecutive tokens; the hash of a window covers the positions
that the mask keeps, so a substituted token at an ignored position doesn't hide a match. The masks
differ in what they ignore. Hashes of all windows of the documents are joined with those of the
benchmark; around each hit the item is laid along the document and the aligned tokens are compared.
A document is contaminated by an item if the best alignment agrees in at least ``MIN_MATCHES`` tokens
and in ``MIN_SHARE`` of the aligned stretch (ends without agreement cut off).

Together the masks meet every stretch that these two limits allow: all 66 ways to substitute 2 of 12
tokens and all 455 ways to substitute 3 of 15 leave a hit, and longer stretches hold more windows
(the tests try random substitutions against an alignment without seeds). Items of ``SHORT`` to 9 tokens
match as a whole or not at all; shorter items are no evidence of leakage and never match.

Scale: windows carry a document's identity and a hash, nothing else, and are joined where they are made;
only the places of hits are shuffled, once each. Texts with hits are then read a second time and split once
to compare all of their places. The benchmark is broadcast in blocks of at most ``BLOCK_BYTES`` by its
counted size (one item at least); more blocks are more passes. Places are broadcast up to ``BROADCAST_PLACES``,
which are counted, and beyond that joined by shuffle.

Edge cases: null or empty texts have no tokens and match nothing; null ids are kept as they are and
rows with equal doc_id count as one document in the result of :func:`contaminated`, while
:func:`drop_contaminated` judges each text by itself; items of one id and different texts are told
apart by their texts and reported under that id once; empty tables give an empty result; extra columns
are ignored or, in :func:`drop_contaminated`, kept.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.workspace import materialize, own_prefix

# 1: the position counts, 0: it is ignored.
MASKS = ("11010111", "1110010011", "1110100011", "111111")
PLACES = tuple(tuple(i for i, x in enumerate(m) if x == "1") for m in MASKS)
SPAN = max(map(len, MASKS))
SHORT = min(map(len, MASKS))
MIN_MATCHES = 10
MIN_SHARE = 0.8
BLOCK_BYTES = 48 << 20
WINDOW_BYTES = 48  # of a broadcast row, about
BROADCAST_PLACES = 200_000
SEPARATORS = r"[\x20\x09-\x0D.,;:!?\"'()\[\]{}]+"


def token_hashes(text: Column) -> Column:
    """64-bit hashes of the lower-cased words; ASCII punctuation separates like blanks."""
    words = F.split(F.lower(F.coalesce(text, F.lit(""))), SEPARATORS)
    return F.transform(F.filter(words, lambda w: w != ""), lambda w: F.xxhash64(w))


def seed_hash(tokens: Column, at: Column, mask: int) -> Column:
    """Hash of the window at ``at`` under a mask; null where it doesn't fit into the text."""
    seen = F.xxhash64(F.lit(mask), *(F.get(tokens, at + p) for p in PLACES[mask]))
    return F.when((at >= 0) & (at + len(MASKS[mask]) <= F.size(tokens)), seen)


def windows(rows: DataFrame, tokens: str, *keep: str) -> DataFrame:
    """A row for each window and mask of the column ``tokens``: ``keep``, its start ``at``, ``mask`` and the hash ``h``.

    Positions are exploded with the array beside them, so that hashes are compiled code and not a
    function applied to an array. The outer forms: for the inner ones Spark infers a filter on the array's
    size and moves it, with all that the array is made of, down to the scan.
    """
    carried = dict.fromkeys((*keep, tokens))
    placed = rows.select(*carried, F.posexplode_outer(tokens).alias("at", "token"))
    every = F.array(*(seed_hash(F.col(tokens), F.col("at"), k) for k in range(len(MASKS))))
    return placed.select(*keep, "at", F.posexplode_outer(every).alias("mask", "h")).where(F.col("h").isNotNull())


def benchmark_items(benchmark: DataFrame, item_id: str = "item_id", text: str = "text") -> DataFrame:
    """(ref, item_id, item): different items with their token hashes, numbered; those that are too short are left out."""
    items = benchmark.select(F.col(item_id).alias("item_id"), token_hashes(F.col(text)).alias("item")).where(F.size("item") >= SHORT).distinct()
    return materialize(items.withColumn("ref", F.monotonically_increasing_id()))


def benchmark_windows(items: DataFrame) -> DataFrame:
    """(ref, item_at, h): the seeds of each item."""
    return windows(items, "item", "ref").select("ref", F.col("at").alias("item_at"), "h")


def _blocks(items: DataFrame) -> int:
    """Into how many parts the benchmark goes so that each can be broadcast."""
    tokens = items.agg(F.sum(F.size("item"))).first()[0] or 0
    return max(1, -(-tokens * len(MASKS) * WINDOW_BYTES // BLOCK_BYTES))


def places(docs: DataFrame, items: DataFrame) -> DataFrame:
    """(doc_id, th, ref, begin): where items lie in documents (doc_id, th, text) according to a hit."""
    n = _blocks(items)
    seen = windows(docs.select("doc_id", "th", token_hashes(F.col("text")).alias("tokens")), "tokens", "doc_id", "th")
    parts = [items.where(F.pmod(F.xxhash64("ref"), F.lit(n)) == k) for k in range(n)] if n > 1 else [items]
    hits = reduce(DataFrame.unionByName, (seen.join(F.broadcast(benchmark_windows(x)), "h").select("doc_id", "th", "ref", (F.col("at") - F.col("item_at")).alias("begin")) for x in parts))
    return hits.distinct()


def leaks(docs: DataFrame, benchmark: DataFrame, doc_id: str, text: str, item_id: str) -> DataFrame:
    """(doc_id, th, item_id, matches, share) of each place where a document holds an item; th: hash of the text."""
    slim = docs.select(F.col(doc_id).alias("doc_id"), F.xxhash64(text).alias("th"), F.col(text).alias("text"))
    items = benchmark_items(benchmark, item_id)
    found = materialize(places(slim, items))
    small = found.count() <= BROADCAST_PLACES
    own = found.select(F.col("doc_id").alias("place_id"), F.col("th").alias("place_th"), "ref", "begin")
    own = F.broadcast(own) if small else own
    there = F.col("doc_id").eqNullSafe(F.col("place_id")) & (F.col("th") == F.col("place_th"))
    # first the texts with places, so that only these are split
    split = slim.join(own, there, "left_semi").select("doc_id", "th", token_hashes(F.col("text")).alias("tokens"))
    near = split.join(own, there).join(items, "ref")
    begin, n = F.col("begin"), F.size("item")
    # the tokens in the item's place; outside of the document there are none
    outside = F.array_repeat(F.lit(None).cast("long"), F.greatest(-begin, F.lit(0)))
    beside = F.slice(F.concat(outside, F.slice("tokens", F.greatest(begin, F.lit(0)) + 1, n)), F.lit(1), n)
    same = F.zip_with(F.col("item"), beside, lambda a, b: F.coalesce(a == b, F.lit(False)))
    scored = near.select("doc_id", "th", "item_id", F.least(n, F.lit(MIN_MATCHES)).alias("need"), _best_stretch(same).alias("best"))
    share = F.col("best.matches") / F.nullif(F.col("best.long"), F.lit(0))
    scored = scored.select("doc_id", "th", "item_id", "need", F.col("best.matches").cast("long").alias("matches"), share.alias("share"))
    return scored.where((F.col("matches") >= F.col("need")) & (F.col("share") >= MIN_SHARE)).drop("need")


def contaminated(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id") -> DataFrame:
    """(doc_id, item_id, matches, share): items whose text is found in a document, substitutions allowed."""
    found = leaks(docs, benchmark, doc_id, text, item_id)
    return found.groupBy("doc_id", "item_id").agg(F.max("matches").alias("matches"), F.max("share").alias("share"))


def _best_stretch(same: Column) -> Column:
    """Matches and length of the best stretch: +1 for an equal token, -4 for another (0.8 breaks even)."""
    names = ("score", "hit", "n", "best", "matches", "long")
    start = F.struct(*(F.lit(0).alias(x) for x in names))

    def step(acc: Column, equal: Column) -> Column:
        gain = acc["score"] + F.when(equal, 1).otherwise(-4)
        score = F.greatest(gain, F.lit(0))
        # at zero the stretch goes on: it still agrees in 0.8; of equal ones the longer counts
        hit = F.when(gain >= 0, acc["hit"] + equal.cast("int")).otherwise(0)
        n = F.when(gain >= 0, acc["n"] + 1).otherwise(0)
        better = (gain > 0) & (gain >= acc["best"])
        kept = [F.when(better, new).otherwise(acc[x]) for x, new in (("best", gain), ("matches", hit), ("long", n))]
        return F.struct(*(c.alias(x) for x, c in zip(names, (score, hit, n, *kept))))

    return F.aggregate(same, start, step)


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id") -> DataFrame:
    """``docs`` without the documents that hold a benchmark passage; rows are told apart by id and text."""
    own = own_prefix(docs)
    bad = leaks(docs, benchmark, doc_id, text, item_id).select(F.col("doc_id").alias(f"{own}bad"), F.col("th").alias(f"{own}th")).distinct()
    bad = materialize(bad)
    return docs.join(bad, docs[doc_id].eqNullSafe(bad[f"{own}bad"]) & (F.xxhash64(docs[text]) == bad[f"{own}th"]), "left_anti")


def op2_decontamination(spark, sf_dir: str) -> DataFrame:
    return contaminated(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


# DuckDB: seeds as joined tokens; the best stretch from prefix sums, their running minimum and its first place.
ORACLE = r"""
with d as (
  select row_number() over () r, doc_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[\x20\x09-\x0D.,;:!?"''()\[\]{}]+'), lambda w: w <> '') t from documents
), b as (
  select row_number() over () b, * from (select distinct item_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[\x20\x09-\x0D.,;:!?"''()\[\]{}]+'), lambda w: w <> '') t from benchmark)
), dw as (
  select r, unnest(list_transform(range(1, greatest(len(t) - 6, 1)), lambda i: {'i': i, 'm': 'a', 's': hash([t[i], t[i+1], t[i+3], t[i+5], t[i+6], t[i+7]])}) || list_transform(range(1, greatest(len(t) - 8, 1)), lambda i: {'i': i, 'm': 'b', 's': hash([t[i], t[i+1], t[i+2], t[i+5], t[i+8], t[i+9]])}) || list_transform(range(1, greatest(len(t) - 8, 1)), lambda i: {'i': i, 'm': 'c', 's': hash([t[i], t[i+1], t[i+2], t[i+4], t[i+8], t[i+9]])}) || list_transform(range(1, greatest(len(t) - 4, 1)), lambda i: {'i': i, 'm': 'd', 's': hash([t[i], t[i+1], t[i+2], t[i+3], t[i+4], t[i+5]])})) x from d
), bw as (
  select b, unnest(list_transform(range(1, greatest(len(t) - 6, 1)), lambda i: {'i': i, 'm': 'a', 's': hash([t[i], t[i+1], t[i+3], t[i+5], t[i+6], t[i+7]])}) || list_transform(range(1, greatest(len(t) - 8, 1)), lambda i: {'i': i, 'm': 'b', 's': hash([t[i], t[i+1], t[i+2], t[i+5], t[i+8], t[i+9]])}) || list_transform(range(1, greatest(len(t) - 8, 1)), lambda i: {'i': i, 'm': 'c', 's': hash([t[i], t[i+1], t[i+2], t[i+4], t[i+8], t[i+9]])}) || list_transform(range(1, greatest(len(t) - 4, 1)), lambda i: {'i': i, 'm': 'd', 's': hash([t[i], t[i+1], t[i+2], t[i+3], t[i+4], t[i+5]])})) x from b
), hit as (
  select distinct r, b, dw.x.i - bw.x.i s from dw join bw on dw.x.m = bw.x.m and dw.x.s = bw.x.s
), tok as (
  select r, b, s, i, (case when i + s >= 1 then coalesce(d.t[i + s] = b.t[i], false) else false end)::int e
  from hit join d using (r) join b using (b), unnest(range(1, len(b.t) + 1)) u(i)
), sums as (
  select *, sum(case when e = 1 then 1 else -4 end) over w p, sum(e) over w h from tok window w as (partition by r, b, s order by i)
), runs as (
  select *, least(0, min(p) over (partition by r, b, s order by i)) m from sums
), best as (
  select r, b, s, max(p - m) g from runs group by all having max(p - m) > 0
), stop as (
  select r, b, s, arg_max(i, i) i, arg_max(h, i) h, arg_max(m, i) m from runs join best using (r, b, s) where p - runs.m = g group by all
), begun as (
  select stop.r, stop.b, stop.s, stop.i, stop.h, coalesce(min(runs.i) filter (stop.m < 0), 0) j, coalesce(arg_min(runs.h, runs.i) filter (stop.m < 0), 0) jh
  from stop left join runs on runs.r = stop.r and runs.b = stop.b and runs.s = stop.s and runs.p = stop.m group by all
), found as (
  select r, b, (h - jh)::bigint matches, (h - jh) / (i - j) share from begun
)
select doc_id, item_id, max(matches)::bigint matches, max(share)::double share from found join d using (r) join b using (b)
where matches >= least(10, len(b.t)) and share >= 0.8 group by doc_id, item_id
"""
