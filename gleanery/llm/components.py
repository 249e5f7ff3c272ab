"""Connected components of an edge table by alternating large-star and small-star steps, all in DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common


def _minima(edges: DataFrame) -> DataFrame:
    """u, m: the least of u and its neighbours. Sums up before the shuffle, so a hub costs a row per task."""
    return edges.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))


def _large_star(edges: DataFrame) -> DataFrame:
    ways = _both_ways(edges)
    return ways.join(_minima(ways), "u").where("v > u and v != m").select(F.col("m").alias("a"), F.col("v").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    least = _minima(down)
    moved = down.join(least, "u").where("v != m").select(F.col("m").alias("a"), F.col("v").alias("b"))
    return moved.union(least.where("u != m").select(F.col("m").alias("a"), F.col("u").alias("b")))


def connected_components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """edges (a, b) of any one orderable type -> (node, label), label the least node of its component; loops and nulls are left out.

    Nodes without an edge are not in the result. Each round is a table in the shared scratch folder.
    """
    now = common.keep(edges.where("a != b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")
    seen = None
    for _ in range(rounds):
        mark = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
        if mark == seen or not mark[0]:
            break
        seen = mark
        now = common.keep(_small_star(_large_star(now)).distinct(), "edges")
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    return now.select(F.col("b").alias("node"), F.col("a").alias("label")).union(now.select(F.col("a").alias("node"), F.col("a").alias("label")).distinct())
