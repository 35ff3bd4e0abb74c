"""Sharding by fixed virtual slots and a versioned slot-to-shard map.

Records are hashed into ``SLOTS`` slots, bytes are summed per slot, and a map says which shard holds a slot.
Version 1 deals the slots out in turn. Rebalancing edits the map into the next version: each shard keeps
its largest slots up to the mean load, the others go one by one, largest first, to the least loaded shard.
All versions stay in a table (version, slot, shard, bytes, rows).

A slot that alone outweighs an eighth of a shard (one record repeated by a third of all rows, say) is dealt
over all slots again, by the rows' own numbers. Loads and map have a row per slot, whatever the input. Rows get their
places by slot and one of ``PARTS`` parts of it, each sorted by a hash in a task of its own, so that a slot's rows never
meet. Columns of the input that are named like an added one stay; the added one then gets an underscore.
Nulls hash like any value. Long texts count with all their bytes. Repeated rows are rows of their own, and equal texts may go
to different shards: only sizes are balanced. Empty input gives an empty result.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from keyloom.llm.common import free_name, numbered, quoted, written

SLOTS = 4096
SHARDS = 40
#: Parts of a slot whose rows are numbered apart. Their loads have at most SLOTS * PARTS rows of four numbers.
PARTS = 32
#: Bytes of a record besides its text.
OVERHEAD = 16


def record_size(text: str = "text") -> Column:
    return (F.coalesce(F.octet_length(quoted(text)), F.lit(0)) + OVERHEAD).cast("long")


def text_crc32(text: str = "text") -> Column:
    return F.crc32(F.coalesce(quoted(text), F.lit("")).cast("binary"))


def every_slot(spark: SparkSession, loads: DataFrame, slots: int) -> DataFrame:
    """``loads`` (slot, bytes, rows) with one row for each slot, empty ones too."""
    every = spark.range(slots).select(F.col("id").cast("int").alias("slot"))
    return every.join(loads, "slot", "left").select(
        "slot", *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("bytes", "rows")]
    )


def first_map(loads: DataFrame, shards: int) -> DataFrame:
    """Version 1: slots in turn."""
    return loads.select(F.lit(1).alias("version"), "slot", (F.col("slot") % shards).cast("int").alias("shard"), "bytes", "rows")


def rebalanced(current: DataFrame, shards: int) -> DataFrame:
    """The next version of a map, for ``shards`` shards; it has one row per slot, so one task may sort it."""
    mean = F.sum("bytes").over(Window.partitionBy()) / shards
    kept_so_far = Window.partitionBy("shard").orderBy(F.desc("bytes"), "slot").rowsBetween(Window.unboundedPreceding, 0)
    marked = current.withColumn("_mean", mean).withColumn("_load", F.sum("bytes").over(kept_so_far))
    marked = marked.withColumn("_stays", (F.col("shard") < shards) & ((F.col("_load") <= F.col("_mean")) | (F.col("bytes") == 0)))
    marked = written(marked, "slot_loads")
    stay = marked.filter("_stays").groupBy("shard").agg(F.sum("bytes").alias("load")).collect()  # a row per shard
    held = {r["shard"]: r["load"] for r in stay}
    loads = F.array(*[F.lit(held.get(k, 0)).cast("long") for k in range(shards)])
    pool = F.array_sort(F.collect_list(F.struct((-F.col("bytes")).alias("k"), "slot")))
    moving = marked.filter("not _stays").agg(pool.alias("pool")).withColumn("loads", loads)
    dealt = moving.select(
        F.expr(
            """aggregate(pool, struct(loads, cast(array() as array<struct<slot:int,shard:int>>) as moves),
            (a, x) -> struct(
                transform(a.loads, (v, i) -> if(i + 1 = array_position(a.loads, array_min(a.loads)), v - x.k, v)) as loads,
                concat(a.moves, array(struct(x.slot as slot, int(array_position(a.loads, array_min(a.loads)) - 1) as shard))) as moves),
            a -> a.moves)"""
        ).alias("moves")
    )
    moved = dealt.select(F.inline("moves")).withColumnRenamed("shard", "_to")
    after = marked.join(moved, "slot", "left")
    return after.select((F.col("version") + 1).alias("version"), "slot", F.coalesce("_to", "shard").alias("shard"), "bytes", "rows")


def slot_of(hashed: Column, slots: int) -> Column:
    return F.pmod(hashed, F.lit(slots)).cast("int")


def spread_hash(rows: DataFrame, row: str, keys: Sequence[str], size: str, shards: int, slots: int) -> Column:
    """The hash that says which slot a row is in; rows of slots that outweigh an eighth of a shard have one each."""
    hashed = F.xxhash64(*map(quoted, keys))
    home = slot_of(hashed, slots)
    loads = written(rows.groupBy(home.alias("slot")).agg(F.sum(quoted(size)).alias("bytes")), "loads")
    # At most eight heavy slots per shard.
    total = loads.agg(F.sum("bytes").alias("_total"))
    heavy = loads.join(F.broadcast(total), F.col("bytes") * 8 * shards > F.col("_total")).select(F.collect_set("slot").alias("_heavy"))
    heavy = heavy.first()[0]
    return F.when(home.isin(heavy), F.xxhash64(hashed, quoted(row))).otherwise(hashed) if heavy else hashed


def assign(
    records: DataFrame, keys: Sequence[str], size: str, shards: int = SHARDS, slots: int = SLOTS, parts: int = PARTS
) -> tuple[DataFrame, DataFrame]:
    """``records`` with ``shard``, ``slot`` (position in the shard, from 0) and ``virtual_slot``; and the map's versions."""
    rows, row = numbered(records, "records")
    spread, home, part = (free_name(rows, name) for name in ("spread_hash", "virtual_slot", "slot_part"))
    rows = rows.withColumn(spread, spread_hash(rows, row, keys, size, shards, slots))
    rows = rows.withColumn(home, slot_of(F.col(spread), slots)).withColumn(part, slot_of(F.xxhash64(spread), parts))
    loads = rows.groupBy(F.col(home).alias("slot"), F.col(part).alias("part")).agg(F.sum(quoted(size)).alias("bytes"), F.count("*").alias("rows"))
    loads = written(loads, "part_loads")
    per_slot = loads.groupBy("slot").agg(F.sum("bytes").alias("bytes"), F.sum("rows").alias("rows"))
    first = written(first_map(every_slot(rows.sparkSession, per_slot, slots), shards), "slot_map")
    second = rebalanced(first, shards)
    versions = written(first.unionByName(second), "slot_map")
    current = versions.filter("version = 2").select("slot", "shard")
    earlier = Window.partitionBy("shard").orderBy("slot", "part").rowsBetween(Window.unboundedPreceding, -1)
    at_slot, at_part, shard, offset, place = (free_name(rows, name) for name in ("_slot", "_part", "_shard", "_offset", "_place"))
    begins = loads.join(current, "slot").withColumn("offset", F.coalesce(F.sum("rows").over(earlier), F.lit(0)))
    begins = begins.select(F.col("slot").alias(at_slot), F.col("part").alias(at_part), F.col("shard").alias(shard), F.col("offset").alias(offset))
    within = Window.partitionBy(home, part).orderBy(spread, quoted(row))
    # One row of four numbers per slot and part: a bounded broadcast.
    met = (F.col(home) == F.col(at_slot)) & (F.col(part) == F.col(at_part))
    placed = rows.withColumn(place, F.row_number().over(within)).join(F.broadcast(begins), met)
    return placed.select(
        *map(quoted, records.columns),
        F.col(shard).alias(free_name(records, "shard")),
        (F.col(offset) + F.col(place) - 1).cast("long").alias(free_name(records, "slot")),
        F.col(home).alias(free_name(records, "virtual_slot")),
    ), versions
