"""Exact dedup with priorities, near-duplicate pairs by Hamming distance, and hashes known already."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schema import NEAR_DUPLICATE_BITS
from . import hamming


def winners(rows: DataFrame, key: str, priority: Column, size: Column, ordinal: str) -> DataFrame:
    """rows with `winner` (ordinal of the row that its key's group keeps) and `rank_ordinal` (the group's first ordinal).

    A group keeps the row of highest priority, then size, then least ordinal. One aggregate, summed up before its shuffle, and a
    join: a hot key costs a row per task, and its rows can be split over tasks in the join.
    """
    best = rows.groupBy(key).agg(F.max(F.struct(priority.alias("p"), size.alias("s"), (-F.col(ordinal)).alias("o"))).alias("best"), F.min(ordinal).alias("rank_ordinal"))
    return rows.join(best.select(key, (-F.col("best.o")).alias("winner"), "rank_ordinal"), key)


def exact_dedup(rows: DataFrame, key: str, priority: Column, size: Column, ordinal: str) -> DataFrame:
    """The winners, each with its group's first ordinal, by which survivors are ordered."""
    return winners(rows, key, priority, size, ordinal).where(F.col("winner") == F.col(ordinal)).drop("winner")


def dedup_audit(rows: DataFrame, key: str, priority: Column, size: Column, ordinal: str, source: str) -> DataFrame:
    """How many rows of each source lost to which: key 'loser->kept:winner', n."""
    judged = winners(rows, key, priority, size, ordinal)
    kept = judged.where(F.col("winner") == F.col(ordinal)).select(key, F.col(source).alias("kept_source"))
    lost = judged.where(F.col("winner") != F.col(ordinal)).select(key, source)
    return lost.join(kept, key).groupBy(F.concat(F.col(source), F.lit("->kept:"), F.col("kept_source")).alias("key")).agg(F.count("*").alias("n"))


def drop_known(rows: DataFrame, known: DataFrame, key: str, ordinal: str) -> DataFrame:
    """Rows whose key is neither in known nor in an earlier row."""
    first = rows.groupBy(key).agg(F.min(ordinal).alias("first"))
    return rows.join(known.select(key).distinct(), key, "left_anti").join(first, key).where(F.col("first") == F.col(ordinal)).drop("first")


def near_duplicates(rows: DataFrame, words: str, bits: int, source: str, ident: str, aspect: str | None = None, most: int = NEAR_DUPLICATE_BITS, top: int = 3) -> DataFrame:
    """For each row its `top` nearest rows of smaller source within `most` bits: hamming, source_a, id_a, source_b, id_b. See hamming.nearest."""
    return hamming.nearest(rows, words, bits, source, ident, aspect, most, top)
