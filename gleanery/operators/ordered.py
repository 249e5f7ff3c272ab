"""Values carried along the order of each key, over ranges of that order: no task gets more than a range, however long one key's line is."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import kept


def in_ranges(rows: DataFrame, key: str, *order: Column) -> DataFrame:
    """rows with `_part` and `_id`: dealt out by ranges of key and order, which `_id` then tells. A kept table, as ranges come from a sample and must be the same wherever they are used."""
    placed = rows.repartitionByRange(key, *order).sortWithinPartitions(key, *order)
    return kept(placed.withColumns({"_part": F.spark_partition_id(), "_id": F.monotonically_increasing_id()}), "ranges")


def _over_ranges(ranged: DataFrame, key: str, summary: Column, carry, out: str) -> DataFrame:
    """key, _part, out: what `carry` (a column over a window of a key's ranges) takes from the summaries of the other ranges. A row for each key and range."""
    sums = ranged.groupBy(key, "_part").agg(summary.alias("_sum"))
    return sums.select(F.col(key).alias("_key"), F.col("_part").alias("_range"), carry(Window.partitionBy(key).orderBy("_part")).alias(out))


def _joined(rows: DataFrame, carried: DataFrame, key: str) -> DataFrame:
    return rows.join(carried, F.col(key).eqNullSafe(F.col("_key")) & (F.col("_part") == F.col("_range"))).drop("_key", "_range")


def last_so_far(ranged: DataFrame, key: str, value: str, out: str) -> DataFrame:
    """ranged with `out`: the last value that is not null in its key, up to and with the row."""
    own = Window.partitionBy(key, "_part").orderBy("_id").rowsBetween(Window.unboundedPreceding, 0)
    before = lambda w: F.last("_sum", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1))
    known = F.max_by(value, F.when(F.col(value).isNotNull(), F.col("_id")))
    rows = _joined(ranged.withColumn("_own", F.last(value, ignorenulls=True).over(own)), _over_ranges(ranged, key, known, before, "_carried"), key)
    return rows.withColumn(out, F.coalesce("_own", "_carried")).drop("_own", "_carried")


def first_from_here(ranged: DataFrame, key: str, value: str, out: str) -> DataFrame:
    """ranged with `out`: the first value that is not null in its key, from the row on."""
    own = Window.partitionBy(key, "_part").orderBy("_id").rowsBetween(0, Window.unboundedFollowing)
    after = lambda w: F.first("_sum", ignorenulls=True).over(w.rowsBetween(1, Window.unboundedFollowing))
    known = F.min_by(value, F.when(F.col(value).isNotNull(), F.col("_id")))
    rows = _joined(ranged.withColumn("_own", F.first(value, ignorenulls=True).over(own)), _over_ranges(ranged, key, known, after, "_carried"), key)
    return rows.withColumn(out, F.coalesce("_own", "_carried")).drop("_own", "_carried")


def next_row(ranged: DataFrame, key: str, value: Column, out: str) -> DataFrame:
    """ranged with `out`: the value, a struct, of the next row of its key; null for the last one."""
    rows = ranged.withColumn("_value", value)
    after = lambda w: F.lead("_sum").over(w)
    carried = _over_ranges(rows, key, F.min_by("_value", "_id"), after, "_carried")
    own = F.lead("_value").over(Window.partitionBy(key, "_part").orderBy("_id"))
    return _joined(rows.withColumn("_own", own), carried, key).withColumn(out, F.coalesce("_own", "_carried")).drop("_own", "_carried", "_value")
