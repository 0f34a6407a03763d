"""Sharding over fixed virtual slots.

A record's key is hashed into one of a few thousand slots for good. Bytes are summed per slot, and a small versioned table
maps slots to shards. Rebalancing edits that table: slots move, records never get another slot. All of it is DataFrame and
SQL functions; the only rows brought together are those of the slot table, whose number is a parameter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from liftplan.llm.shared import free_names, stage

N_SLOTS = 4096


def virtual_slot(key: Column, n_slots: int = N_SLOTS) -> Column:
    """The slot of a key: never changes."""
    return F.pmod(F.xxhash64(key), F.lit(n_slots)).cast("int")


def slot_stats(rows: DataFrame, n_slots: int = N_SLOTS) -> DataFrame:
    """One row per slot, empty ones too: virtual_slot, bytes, n_rows. ``rows`` has virtual_slot and size."""
    filled = rows.groupBy("virtual_slot").agg(F.sum("size").alias("bytes"), F.count("*").alias("n_rows"))
    every = rows.sparkSession.range(n_slots).select(F.col("id").cast("int").alias("virtual_slot"))
    return every.join(filled, "virtual_slot", "left").na.fill(0, ["bytes", "n_rows"])


def _place(stats: DataFrame, n_shards: int) -> DataFrame:
    """Map of version + 1: slots that overfill their shard, or have none, go largest first to the emptiest shard."""
    # A slot stays while its shard, slots taken by falling size, is not over the mean of all shards.
    mean = F.sum("bytes").over(Window.partitionBy(F.lit(0))) / n_shards
    upto = F.sum("bytes").over(Window.partitionBy("old_shard").orderBy(F.desc("bytes"), "virtual_slot").rowsBetween(Window.unboundedPreceding, 0))
    stays = F.col("old_shard").isNotNull() & (F.col("old_shard") < n_shards) & (F.col("upto") <= F.col("mean"))
    marked = stats.withColumn("mean", mean).withColumn("upto", upto).withColumn("stays", stays)
    one = marked.agg(
        F.array_sort(F.collect_list(F.when(~F.col("stays"), F.struct((-F.col("bytes")).alias("order"), "virtual_slot", "bytes")))).alias("pool"),
        F.transform(F.sequence(F.lit(0), F.lit(n_shards - 1)), lambda i: F.lit(0).cast("long")).alias("none"),
        *[F.coalesce(F.sum(F.when(F.col("stays") & (F.col("old_shard") == s), F.col("bytes"))), F.lit(0)).cast("long").alias(f"load{s}") for s in range(n_shards)])
    start = F.struct(F.array(*[F.col(f"load{s}") for s in range(n_shards)]).alias("loads"), F.array().cast("array<int>").alias("picks"))

    def step(state: Column, slot: Column) -> Column:
        least = F.array_position(state["loads"], F.array_min(state["loads"])).cast("int") - 1
        loads = F.transform(state["loads"], lambda load, i: F.when(i == least, load + slot["bytes"]).otherwise(load))
        return F.struct(loads.alias("loads"), F.concat(state["picks"], F.array(least)).alias("picks"))

    picks = one.select("pool", F.aggregate("pool", start, step)["picks"].alias("picks"))
    moved = picks.select(F.inline(F.arrays_zip(F.col("pool")["virtual_slot"].alias("virtual_slot"), F.col("picks").alias("pick"))))
    return (marked.join(moved.toDF("virtual_slot", "pick"), "virtual_slot", "left")
            .select("virtual_slot", F.when(F.col("stays"), F.col("old_shard")).otherwise(F.col("pick")).cast("int").alias("shard"), "bytes", "n_rows"))


def save_map(spark: SparkSession, path: str, stats: DataFrame, n_shards: int, version: int | None = None) -> int:
    """Add a version to the map table at ``path`` and return its number.

    The first version places all slots. A later one starts from version ``version`` and moves as few bytes as it needs to
    fill the shards evenly, new shards included, and to empty shards whose number is ``n_shards`` or more.
    """
    if version is None:
        old = stats.withColumn("old_shard", F.lit(None).cast("int"))
        new = 1
    else:
        old = stats.join(read_map(spark, path, version).select("virtual_slot", F.col("shard").alias("old_shard")), "virtual_slot", "left")
        new = version + 1
    _place(old, n_shards).coalesce(1).write.parquet(f"{path}/version={new}")
    return new


def read_map(spark: SparkSession, path: str, version: int) -> DataFrame:
    """virtual_slot, shard, bytes and n_rows of one version of the map."""
    return spark.read.parquet(f"{path}/version={version}")


def sized(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n_slots: int = N_SLOTS) -> DataFrame:
    """doc_id, size (bytes of the text and one more), text_crc32 and virtual_slot of each row.

    Null text counts as empty. The slot goes by the id; a null id takes the text instead, so that such rows spread too.
    """
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    return docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), (F.octet_length(text) + 1).cast("long").alias("size"),
                       F.crc32(text.cast("binary")).alias("text_crc32"), _row_slot(id_col, text, n_slots).alias("virtual_slot"))


def _row_slot(id_col: str, text: Column, n_slots: int) -> Column:
    return virtual_slot(F.coalesce(F.col(f"`{id_col}`").cast("long"), F.xxhash64(text)), n_slots)


def shard_documents(docs: DataFrame, map_path: str, n_shards: int, id_col: str = "doc_id", text_col: str = "text",
                    n_slots: int = N_SLOTS) -> DataFrame:
    """doc_id, size, text_crc32, virtual_slot, shard and place of each row; the map is stored at ``map_path``.

    Shards get nearly equal sums of ``size``. ``place`` counts 0, 1, ... without gaps inside each shard, by slot and then id;
    equal ids stand in the order of their checksums. An empty table gives an empty result and a map of empty slots.
    """
    rows = stage(sized(docs, id_col, text_col, n_slots), "shard-sizes")
    save_map(docs.sparkSession, map_path, slot_stats(rows, n_slots), n_shards)
    slots = read_map(docs.sparkSession, map_path, 1)
    before = F.sum("n_rows").over(Window.partitionBy("shard").orderBy("virtual_slot").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    slots = slots.select("virtual_slot", "shard", (before - F.col("n_rows")).alias("before"))
    in_slot = F.row_number().over(Window.partitionBy("virtual_slot").orderBy("doc_id", "text_crc32", "size"))
    # The slot table has n_slots rows, so it may be sent to every task.
    return (rows.withColumn("in_slot", in_slot).join(F.broadcast(slots), "virtual_slot")
            .select("doc_id", "size", "text_crc32", "virtual_slot", "shard", (F.col("before") + F.col("in_slot") - 1).alias("place")))


def with_shards(docs: DataFrame, map_path: str, n_shards: int, id_col: str = "doc_id", text_col: str = "text", n_slots: int = N_SLOTS) -> DataFrame:
    """The rows, with all columns, and their virtual_slot and shard; texts are read where they lie. The map is stored at ``map_path``.

    Columns of ``docs`` with these two names are replaced; all others stay as they are, whatever their names. Null text counts as empty, a null id goes by its
    text, equal ids share a slot, and an empty table gives an empty result.
    """
    save_map(docs.sparkSession, map_path, slot_stats(stage(sized(docs, id_col, text_col, n_slots), "shard-sizes"), n_slots), n_shards)
    own, slot, shard = free_names(docs, "own", "slot", "shard")
    slots = read_map(docs.sparkSession, map_path, 1).select(F.col("virtual_slot").alias(slot), F.col("shard").alias(shard))
    kept = [c for c in docs.columns if c.lower() not in ("virtual_slot", "shard")]
    placed = docs.withColumn(own, _row_slot(id_col, F.coalesce(F.col(f"`{text_col}`"), F.lit("")), n_slots))
    return (placed.join(F.broadcast(slots), F.col(own) == F.col(slot))
            .select(*[F.col(f"`{c}`") for c in kept], F.col(slot).alias("virtual_slot"), F.col(shard).alias("shard")))
