"""Split assignment: leak-free by group, greedy and balanced, and deterministic subsets."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.keys import hex_fraction, stable_fraction
from ..schema import SPLIT_TARGETS, SPLITS


def split_by_group(rows: DataFrame, group: str, ordinal: str, source_split: Column, resplit: Column | None = None) -> DataFrame:
    """rows with `split`: all rows of a group go where the split of its first row sends them.

    test stays test; rows for which `resplit` holds go to val under a tenth of the group's hash fraction, else to train; other known
    splits stay; unknown ones go to test under a tenth, to val under a fifth, else to train.
    """
    first = rows.groupBy(group).agg(F.min_by(F.struct(source_split.alias("known"), (resplit if resplit is not None else F.lit(False)).alias("again")), F.col(ordinal)).alias("first"))
    at, known = stable_fraction(F.col(group)), F.col("first.known")
    split = (
        F.when(known == "test", "test")
        .when(F.col("first.again") & (known == "train"), F.when(at < 0.10, "val").otherwise("train"))
        .when(known.isin("train", "val"), known)
        .otherwise(F.when(at < 0.10, "test").when(at < 0.20, "val").otherwise("train"))
    )
    return rows.join(first.select(group, split.alias("split")), group)


def greedy_splits(groups: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """groups (name, size) -> (name, split): largest first, each to the split furthest under its target share of everything.

    known (split, n) are counts so far. Each choice depends on all before it, so one task makes them, over a name and a number for each group of images,
    in one pass that keeps three sums.
    """
    kind = groups.schema["name"].dataType.simpleString()
    rows = groups.select("name", F.col("size").cast("long").alias("size"), F.lit(None).cast("string").alias("split"))
    if known is not None:
        rows = rows.union(known.groupBy("split").agg(F.sum("n").cast("long").alias("size")).select(F.lit(None).cast(kind), "size", "split"))

    def place(table: pa.Table) -> pa.Table:
        had = dict.fromkeys(SPLITS, 0.0)
        todo = []
        for name, size, split in zip(*(table.column(c).to_pylist() for c in ("name", "size", "split"))):
            if split is None:
                todo.append((-size, name))
            elif split in had:
                had[split] += size
        total = sum(had.values()) - sum(k for k, _ in todo)
        names, out = [], []
        for k, name in sorted(todo):
            pick = max(SPLITS, key=lambda s: SPLIT_TARGETS[SPLITS.index(s)] * total - had[s])  # the first of equal ones
            had[pick] -= k
            names.append(name)
            out.append(pick)
        return pa.table({"name": pa.array(names, table.schema.field("name").type), "split": pa.array(out, pa.string())})

    return rows.withColumn("_all", F.lit(1)).groupBy("_all").applyInArrow(place, f"name {kind}, split string")


def subset(rows: DataFrame, sha256: str, split: str, fraction: float) -> DataFrame:
    """The rows under the fraction by their hash; test stays whole."""
    return rows if fraction >= 1 else rows.where((F.col(split) == "test") | (hex_fraction(F.col(sha256)) < fraction))


def summary(rows: DataFrame, split: str, objects: Column) -> DataFrame:
    """images, objects, negatives by split and in total, with zeros for splits that have none."""
    spark = rows.sparkSession
    by = rows.groupBy(F.col(split).alias("split")).agg(F.count("*").alias("images"), F.sum(objects).cast("long").alias("objects"), F.count_if(objects == 0).alias("negatives"))
    names = spark.createDataFrame([(s,) for s in SPLITS], "split string")
    full = names.join(by, "split", "left").na.fill(0)
    return full.union(full.agg(F.lit("total"), F.sum("images"), F.sum("objects"), F.sum("negatives")))
