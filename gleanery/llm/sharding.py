"""Contiguous balanced shards from global prefix sums of sizes; DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import common


def balanced_shards(documents: DataFrame, shards: int = 24, extra: int = 8) -> DataFrame:
    """doc_id, size, text_crc32, law ('bytes'), shard, slot, grown_shard (null), begin (the bytes before the row).

    Rows stand in one global order: by a hash of the text, then doc_id, then size, so equal texts are neighbours. size is the
    text's UTF-8 bytes plus `extra`; a null text has no bytes and the CRC-32 of nothing, 0. Each partition of that order is
    totalled, the totals are summed up over the partitions, and a row goes to the shard in which its middle byte falls when the
    whole is cut at equal targets. So shards are contiguous, and each is within one row of total / shards. slot counts from 0
    in each shard. Repeated rows and ids, and null ids, are rows like others; an empty table gives an empty table.
    """
    spark = documents.sparkSession
    text = F.coalesce(F.col("text").cast("string").cast("binary"), F.lit(b""))
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), (F.octet_length(text) + extra).cast("long").alias("size"), F.crc32(text).alias("text_crc32"), F.xxhash64(text).alias("h"))
    order = ["h", "doc_id", "size"]
    parts = common.shuffle_partitions(spark)
    placed = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order).withColumn("part", F.spark_partition_id()).withColumn("id", F.monotonically_increasing_id())
    # written once: the ranges come from a sample and must be the same for the totals and the rows
    placed = common.keep(placed, "ranges")
    totals = placed.groupBy("part").agg(F.sum("size").alias("bytes"), F.count("*").alias("n"))
    # a row for each partition, so one task may sum them up
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    every = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    offsets = totals.select("part", F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("bytes0"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("n0"), F.sum("bytes").over(every).alias("total"))
    running = Window.partitionBy("part").orderBy("id").rowsBetween(Window.unboundedPreceding, -1)
    ranked = placed.withColumn("b", F.coalesce(F.sum("size").over(running), F.lit(0))).withColumn("i", F.count("*").over(running))
    ranked = ranked.join(F.broadcast(offsets), "part").withColumn("begin", F.col("bytes0") + F.col("b")).withColumn("place", F.col("n0") + F.col("i"))
    middle = (2 * F.col("begin") + F.col("size")).cast("decimal(38,0)") * shards
    ranked = ranked.withColumn("shard", F.least(F.lit(shards - 1), F.floor(middle / (2 * F.col("total")).cast("decimal(38,0)")).cast("int")))
    ranked = common.keep(ranked.select("doc_id", "size", "text_crc32", "shard", "place", "begin"), "shards")
    first = ranked.groupBy("shard").agg(F.min("place").alias("first"))  # `shards` rows
    return ranked.join(F.broadcast(first), "shard").select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", (F.col("place") - F.col("first")).alias("slot"), F.lit(None).cast("int").alias("grown_shard"), "begin")
