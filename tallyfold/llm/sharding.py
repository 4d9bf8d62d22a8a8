"""Shards of nearly equal bytes: longest-processing-time scheduling of groups that must stay together.

Large groups are scheduled one by one; all smaller ones are first put together
into a fixed number of bundles by hash. The heap so runs over a number of units
that depends on the shards alone, and no group of rows is ever collected.
"""

from __future__ import annotations

import heapq

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from tallyfold.llm.common import prepare, settle

SHARDS = 40
# Bundles for each shard, and how many to a shard a group must outweigh to be scheduled alone.
BUNDLES = 256
# What a row weighs beside its text.
OVERHEAD = 16
# Rows of one slot-numbering window.
SLOT_ROWS = 50_000


def schedule(sizes: dict, shards: int) -> dict:
    """Unit to shard: largest unit first, each to the shard with least so far, ties by smaller key and shard."""
    heap = [(0, s) for s in range(shards)]
    out = {}
    for unit, size in sorted(sizes.items(), key=lambda x: (-x[1], x[0])):
        load, shard = heapq.heappop(heap)
        out[unit] = shard
        heapq.heappush(heap, (load + size, shard))
    return out


def _lookup(spark: SparkSession, rows: list[tuple], names: str) -> DataFrame:
    """A table of at most ``shards * BUNDLES`` rows of two short columns, so that it can be broadcast."""
    return F.broadcast(spark.createDataFrame(rows, names))


def shard(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shards: int = SHARDS) -> DataFrame:
    """``(doc_id, size, text_crc32, law, shard, slot, grown_shard)`` for every row of ``docs``.

    Rows of equal text share a shard; the law is ``bytes``: sizes of shards are
    nearly equal, as far as a group that outweighs a shard allows. slot counts
    from 0 without gaps within a shard. A null text has no bytes, no checksum
    and is a group of its own with other null texts. Repeated rows each take a
    slot; other columns are ignored; an empty table gives no rows.

    The text is read once and never shuffled; group sizes are summed with a
    map-side part.
    """
    spark = prepare(docs.sparkSession)
    raw = F.col(text).cast("binary")
    rows = settle(docs.select(
        F.col(doc_id).alias("doc_id"), (F.coalesce(F.octet_length(raw), F.lit(0)) + OVERHEAD).cast("long").alias("size"),
        F.crc32(raw).alias("text_crc32"), F.coalesce(F.unhex(F.sha2(raw, 256)), F.lit(b"")).alias("grp"),
    ))
    bundle = F.pmod(F.xxhash64("grp"), F.lit(shards * BUNDLES)).cast("int")
    groups = settle(rows.groupBy("grp").agg(F.sum("size").alias("size")).withColumn("bundle", bundle))
    total = groups.agg(F.sum("size")).first()[0] or 0
    # At most shards * BUNDLES groups are this large, and there are as many bundles.
    large = groups.where(F.col("size") > total / (shards * BUNDLES))
    alone = {("group", bytes(r["grp"])): r["size"] for r in large.select("grp", "size").collect()}
    small = groups.where(F.col("size") <= total / (shards * BUNDLES)).groupBy("bundle").agg(F.sum("size").alias("size"))
    bundled = {("bundle", r["bundle"]): r["size"] for r in small.collect()}
    # Ties between a group and a bundle go by kind, then key.
    place = schedule(alone | bundled, shards)
    of_group = _lookup(spark, [(k, s) for (kind, k), s in place.items() if kind == "group"], "grp binary, g int")
    of_bundle = _lookup(spark, [(k, s) for (kind, k), s in place.items() if kind == "bundle"], "bundle int, b int")
    placed = settle(
        rows.withColumn("bundle", bundle).join(of_group, "grp", "left").join(of_bundle, "bundle", "left")
        .select("doc_id", "size", "text_crc32", F.coalesce("g", "b").alias("shard"))
    )
    # A piece is a stretch of a written file; its rows of a shard are numbered
    # in a window, and the pieces before it are counted from a small table.
    pieces = placed.select(
        "*", F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row"),
        (F.col("_metadata.row_index") / SLOT_ROWS).cast("long").alias("piece"),
    )
    counts = pieces.groupBy("shard", "file", "piece").count()
    before = Window.partitionBy("shard").orderBy("file", "piece").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("shard", "file", "piece", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("offset"))
    within = Window.partitionBy("shard", "file", "piece").orderBy("row")
    return (
        pieces.withColumn("n", F.row_number().over(within) - 1).join(offsets, ["shard", "file", "piece"])
        .select(
            "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
            (F.col("n") + F.col("offset")).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
        )
    )
