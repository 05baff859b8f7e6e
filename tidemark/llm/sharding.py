"""Sharding by fixed virtual slots; DataFrame functions only.

Records are hashed by doc_id into ``SLOTS`` virtual slots. Bytes and rows are summed per slot, and a
versioned map from slots to shards, SLOTS rows whatever the input, is stored in the shared folder.
The first version fills shards evenly by bytes: slots in order of falling size go to the shard with
the least. Rebalancing edits the map: a new version moves just the slots that a new shard takes over,
so records in other slots stay where they are.

Law of op3: ``bytes``. ``slot`` numbers the rows of a shard from 0 without gaps: the slots' row counts
give each slot a base, and rows are numbered within their slot, so no shard is ever sorted as a whole.

Scale: texts are read once; one shuffle, by virtual slot, of a few numbers per row, never of text;
thousands of slots keep it even. Where one doc_id (or null) has so many rows that its slot holds more than
``HEAVY`` times the mean, the rows of that slot are dealt to all slots one by one. The map is broadcast: its
size is fixed by SLOTS.

Edge cases: null text counts 16 bytes and has the checksum of an empty text; null doc_id is a value
like any other; repeated rows share a slot and get numbers of their own; an empty table gives an empty
result; other columns are not touched.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.workspace import checkpoint_root, materialize

SLOTS = 4096
SHARDS = 40
OVERHEAD = 16
HEAVY, LEAST_HEAVY = 8, 64


def record_size(text: Column) -> Column:
    return (F.coalesce(F.octet_length(text), F.lit(0)) + OVERHEAD).cast("long")


def virtual_slot(key: Column, slots: int = SLOTS) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(slots)).cast("int")


def without_heavy_slots(records: DataFrame, slots: int = SLOTS) -> DataFrame:
    """``records`` (vslot, row and others, written) with the rows of overfull slots spread by their row number."""
    used = records.groupBy("vslot").count()
    mean = (records.count() or 1) / slots
    heavy = [r.vslot for r in used.where(F.col("count") > max(LEAST_HEAVY, HEAVY * mean)).collect()]  # fewer than slots / HEAVY
    if not heavy:
        return records
    spread = F.pmod(F.xxhash64("row"), F.lit(slots)).cast("int")
    return records.withColumn("vslot", F.when(F.col("vslot").isin(heavy), spread).otherwise(F.col("vslot")))


def slot_sizes(records: DataFrame, slots: int = SLOTS) -> DataFrame:
    """(vslot, bytes, rows) of all slots, empty ones too; ``records`` has vslot and size."""
    every = records.sparkSession.range(slots).select(F.col("id").cast("int").alias("vslot"))
    used = records.groupBy("vslot").agg(F.sum("size").alias("bytes"), F.count("*").alias("rows"))
    return every.join(used, "vslot", "left").fillna(0, ["bytes", "rows"])


def first_map(sizes: DataFrame, shards: int = SHARDS) -> DataFrame:
    """(vslot, shard, bytes, rows): largest slot first, each to the shard with the fewest bytes so far."""
    ordered = sizes.agg(F.reverse(F.array_sort(F.collect_list(F.struct("bytes", "vslot", "rows")))).alias("slots"))
    start = F.struct(F.array_repeat(F.lit(0).cast("long"), shards).alias("load"), F.array().cast("array<int>").alias("shard"))

    def put(acc: Column, slot: Column) -> Column:
        least = F.array_position(acc["load"], F.array_min(acc["load"])).cast("int") - 1
        load = F.transform(acc["load"], lambda x, i: F.when(i == least, x + slot["bytes"]).otherwise(x))
        return F.struct(load.alias("load"), F.concat(acc["shard"], F.array(least)).alias("shard"))

    dealt = ordered.select(F.explode(F.arrays_zip("slots", F.aggregate("slots", start, put)["shard"].alias("shard"))).alias("x"))
    return dealt.select("x.slots.vslot", "x.shard", "x.slots.bytes", "x.slots.rows")


def add_shard(current: DataFrame, shards: int) -> DataFrame:
    """The map edited for one shard more: each shard gives its smallest slots while it stays above the new mean."""
    total = current.agg((F.coalesce(F.sum("bytes"), F.lit(0)) / (shards + 1)).alias("mean"), F.max("shard").alias("top"))
    mean, _ = total.first()
    by_size = Window.partitionBy("shard").orderBy("bytes", "vslot")
    left = F.sum("bytes").over(Window.partitionBy("shard")) - F.sum("bytes").over(by_size.rowsBetween(Window.unboundedPreceding, 0))
    return current.withColumn("shard", F.when((left >= F.lit(mean)) & (F.col("bytes") > 0), F.lit(shards)).otherwise(F.col("shard")))


def store_map(slot_map: DataFrame, folder: str, version: int) -> None:
    """Versions are never overwritten: an edit is a new one."""
    slot_map.coalesce(1).write.parquet(f"{folder}/version={version}")


def load_map(spark: SparkSession, folder: str, version: int) -> DataFrame:
    return spark.read.parquet(f"{folder}/version={version}")


def op3_sharding(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    text = F.col("text")
    crc = F.crc32(F.coalesce(text, F.lit("")).cast("binary"))
    records = docs.select("doc_id", record_size(text).alias("size"), crc.alias("text_crc32"), virtual_slot(F.col("doc_id")).alias("vslot"), F.monotonically_increasing_id().alias("row"))
    records = without_heavy_slots(materialize(records))
    folder = f"{checkpoint_root(spark)}/tidemark-slotmap-{uuid.uuid4().hex}"
    store_map(first_map(slot_sizes(records.select("vslot", "size"))), folder, 1)
    placed = load_map(spark, folder, 1)
    base = F.sum("rows").over(Window.partitionBy("shard").orderBy("vslot").rowsBetween(Window.unboundedPreceding, 0)) - F.col("rows")
    placed = placed.select("vslot", "shard", base.alias("base"))
    numbered = records.withColumn("n", F.row_number().over(Window.partitionBy("vslot").orderBy("doc_id", "text_crc32", "size", "row")))
    out = numbered.join(F.broadcast(placed), "vslot")
    return out.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
        (F.col("base") + F.col("n") - 1).cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
        F.col("vslot").alias("virtual_slot"), F.lit(1).alias("map_version"),
    )
