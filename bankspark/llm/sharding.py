"""Sharding over fixed virtual slots.

A record belongs for good to one of a few thousand virtual slots, by the hash
of its id.  A versioned map says which shard holds a slot.  Version 0 deals the
slots out evenly; rebalancing reads the bytes per slot and moves slots to the
lightest shards where that levels them, which gives the next version.  Only
the map is edited: a record never changes its slot, and only the moved slots'
records change their shard.

Defined results: a NULL text has the size of an empty one; a record without an
id is hashed by its text; repeated rows stay repeated; an empty table gives an
empty result and an unchanged map.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from bankspark.llm.rows import unwrapped, wrapped
from bankspark.sources.scratch import store

SLOTS = 4096
SHARDS = 24
ROW_BYTES = 8


def slot_of(doc_id: Column, text: Column, slots: int = SLOTS) -> Column:
    name = F.coalesce(doc_id.cast("string"), F.md5(text), F.lit(""))
    return F.pmod(F.xxhash64(name), F.lit(slots)).cast("int")


def first_map(spark: SparkSession, shards: int = SHARDS, slots: int = SLOTS) -> DataFrame:
    """Version 0 of the slot map (version, virtual_slot, shard): slots dealt out in turn."""
    return spark.range(slots).select(
        F.lit(0).alias("version"),
        F.col("id").cast("int").alias("virtual_slot"),
        (F.col("id") % shards).cast("int").alias("shard"),
    )


def latest(slot_map: DataFrame) -> DataFrame:
    """The newest version of a map that holds several."""
    newest = F.max("version").over(Window.partitionBy(F.lit(0)))
    return slot_map.withColumn("_newest", newest).filter("version = _newest").drop("_newest")


def rebalanced(slot_map: DataFrame, slot_bytes: DataFrame, shards: int = SHARDS) -> DataFrame:
    """The next version of a map: slots moved, largest first, to the lightest shard.

    A move must leave that shard lighter than the other was.  The map
    has a fixed number of slots, so folding over it is bounded whatever the
    number of records; the fold is a SQL aggregate over the sorted slots.
    """
    current = (
        latest(slot_map)
        .join(slot_bytes, "virtual_slot", "left")
        .select("version", "virtual_slot", "shard", F.coalesce("bytes", F.lit(0)).cast("long").alias("bytes"))
    )
    slots = F.sort_array(
        F.collect_list(F.struct(F.col("bytes"), (-F.col("virtual_slot")).alias("order"), F.col("shard"))), asc=False
    )
    per_shard = F.transform(
        F.sequence(F.lit(0), F.lit(shards - 1)),
        lambda s: F.aggregate("slots", F.lit(0).cast("long"), lambda t, x: t + F.when(x.shard == s, x.bytes).otherwise(0)),
    )
    # Stored, so that the optimiser does not work the loads out again in each step of the fold.
    whole = store(current.groupBy("version").agg(slots.alias("slots")).withColumn("loads", per_shard))


    def step(state: Column, slot: Column) -> Column:
        held = F.element_at(state.loads, slot.shard + 1)
        lightest = F.array_min(state.loads)
        moves = lightest + slot.bytes < held
        shard = F.when(moves, (F.array_position(state.loads, lightest) - 1).cast("int")).otherwise(slot.shard)
        return F.element_at(F.transform(F.array(shard), lambda to: placed(state, slot, to)), 1)

    def placed(state: Column, slot: Column, to: Column) -> Column:
        moved = F.transform(
            state.loads,
            lambda load, s: load
            + F.when(s == to, slot.bytes).otherwise(0) - F.when(s == slot.shard, slot.bytes).otherwise(0),
        )
        entry = F.struct((-slot.order).cast("int").alias("virtual_slot"), to.alias("shard"))
        return F.struct(moved.alias("loads"), F.concat(state.placed, F.array(entry)).alias("placed"))

    start = F.struct(
        F.col("loads").alias("loads"), F.expr("cast(array() as array<struct<virtual_slot:int,shard:int>>)").alias("placed")
    )
    folded = store(whole.select("version", F.aggregate("slots", start, step).alias("state")))
    return folded.select(
        (F.col("version") + 1).alias("version"), F.inline("state.placed")
    ).select("version", "virtual_slot", "shard")


def _size(text: Column) -> Column:
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + ROW_BYTES


def _versions(sums: DataFrame, shards: int, slots: int, slot_map: DataFrame | None) -> DataFrame:
    """The map with one more version, rebalanced to the bytes per slot."""
    before = slot_map if slot_map is not None else first_map(sums.sparkSession, shards, slots)
    return store(before.unionByName(rebalanced(before, sums.select("virtual_slot", "bytes"), shards)))


def shard(
    docs: DataFrame, shards: int = SHARDS, slots: int = SLOTS, carry: tuple[str, ...] = ("doc_id",), slot_map: DataFrame | None = None
) -> tuple[DataFrame, DataFrame]:
    """Place every record; returns the placed records and the map with all its versions.

    Placed records have the ``carry`` columns, size, text_crc32, virtual_slot,
    shard, and slot: the record's place in its shard, without gaps from 0.
    Places are counted within virtual slots, each a bounded part of the
    records, after the records of the shard's slots before it.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    records = store(
        docs.select(
            *(F.col(c).alias(f"carry_{i}") for i, c in enumerate(carry)),
            _size(F.col("text")).alias("size"),
            F.crc32(text.cast("binary")).alias("text_crc32"),
            F.xxhash64(text).alias("_hash"),
            F.col("doc_id").alias("_id"),
            slot_of(F.col("doc_id"), F.col("text"), slots).alias("virtual_slot"),
        )
    )
    sums = store(records.groupBy("virtual_slot").agg(F.sum("size").alias("bytes"), F.count("*").alias("records")))
    versions = _versions(sums, shards, slots, slot_map)
    ahead = F.sum("records").over(Window.partitionBy("shard").orderBy("virtual_slot").rowsBetween(Window.unboundedPreceding, -1))
    places = store(
        latest(versions).join(sums, "virtual_slot")
        .select("virtual_slot", "shard", F.coalesce(ahead, F.lit(0)).cast("long").alias("_ahead"))
    )
    within = F.row_number().over(Window.partitionBy("virtual_slot").orderBy("_id", "_hash", "size"))
    placed = (
        records.withColumn("_within", within)
        .join(places, "virtual_slot")
        .select(
            *(F.col(f"carry_{i}").alias(c) for i, c in enumerate(carry)),
            "size", "text_crc32", "virtual_slot", "shard", (F.col("_ahead") + F.col("_within") - 1).alias("slot"),
        )
    )
    return placed, versions


def sharded_documents(docs: DataFrame, shards: int = SHARDS, slots: int = SLOTS, slot_map: DataFrame | None = None) -> DataFrame:
    """The documents with virtual_slot and shard; their texts are not shuffled."""
    rows = wrapped(docs, virtual_slot=slot_of(F.col("doc_id"), F.col("text"), slots), bytes=_size(F.col("text")))
    sums = store(rows.groupBy("virtual_slot").agg(F.sum("bytes").alias("bytes")))
    places = store(latest(_versions(sums, shards, slots, slot_map)).select("virtual_slot", "shard"))
    return unwrapped(rows.join(places, "virtual_slot"), "virtual_slot", "shard")


def op9_sharding(docs: DataFrame) -> DataFrame:
    placed, _ = shard(docs)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "virtual_slot",
    )
