"""Small relational rules of curation: lookups with a fallback, first and previous values, gaps in numbering, marks that a run must have."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def lookup_with_fallback(rows: DataFrame, name: str, exact: DataFrame, others: DataFrame, value: str) -> DataFrame:
    """rows with `value`: what `exact` (name, value) has for the whole name, else what `others` (tail, value) has for what follows the name's first hyphen, else null.

    Both sides must have a name once; two equi-joins, so a hot name is split like any skewed key.
    """
    whole = exact.select(F.col("name").alias("_name"), F.col(value).alias("_exact"))
    by_tail = others.select(F.col("tail").alias("_tail"), F.col(value).alias("_other"))
    joined = rows.join(whole, F.col(name) == F.col("_name"), "left").join(by_tail, F.regexp_extract(name, "-(.*)$", 1) == F.col("_tail"), "left")
    return joined.select(*rows.columns, F.coalesce("_exact", "_other").alias(value))


def first_active_time(keyframes: DataFrame, key: str, active: Column, time: str) -> DataFrame:
    """key, starts: the least time at which a track is active, 0 if it never is."""
    return keyframes.groupBy(key).agg(F.coalesce(F.min(F.when(active, F.col(time))), F.lit(0.0)).alias("starts"))


def previous_value(rows: DataFrame, group: str, order: str, value: str) -> DataFrame:
    """rows with `previous`: the value of the row before, null for a group's first."""
    return rows.withColumn("previous", F.lag(value).over(Window.partitionBy(group).orderBy(order)))


def out_of_place(rows: DataFrame, group: str, order: str) -> DataFrame:
    """rows with `place` (from 0, in order) whose number is not their place: none if a group's numbers run from 0 without gaps or repeats."""
    placed = rows.withColumn("place", (F.row_number().over(Window.partitionBy(group).orderBy(order)) - 1).cast("long"))
    return placed.where(F.col("place") != F.col(order))


def having_all(rows: DataFrame, key: str, *marks: DataFrame) -> DataFrame:
    """The distinct keys of rows that every one of `marks` has."""
    return reduce(lambda left, mark: left.join(mark.select(key), key, "left_semi"), marks, rows.select(key).distinct())


def union_minus(parts: list[DataFrame], gone: DataFrame) -> DataFrame:
    """The distinct rows of all parts, without those that `gone` has."""
    return reduce(DataFrame.unionByName, parts).distinct().exceptAll(gone.distinct())


def repeats(rows: DataFrame, key: str, ordinal: str) -> DataFrame:
    """ordinal, first of the rows whose key an earlier row has; the key is summed up before its shuffle, so a hot one costs a row per task."""
    first = rows.groupBy(key).agg(F.min(ordinal).alias("first"), F.count("*").alias("_n")).where("_n > 1")
    return rows.join(first, key).where(F.col(ordinal) != F.col("first")).select(ordinal, "first")


def latest(rows: DataFrame, group: str, order: str, **values: Column) -> DataFrame:
    """By group the last row's order and values."""
    last = F.max_by(F.struct(*(c.alias(n) for n, c in values.items())), F.col(order)).alias("_v")
    return rows.groupBy(group).agg(F.max(order).alias(order), last).select(group, order, *(F.col(f"_v.{n}").alias(n) for n in values))
