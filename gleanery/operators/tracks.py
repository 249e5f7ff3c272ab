"""Key-frame interpolation, in its three meanings, and as-of lookups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.geometry import between
from . import ordered

VALUES = ("x", "y", "width", "height")


def _next(keys: DataFrame, track: str, order: list[str], values) -> DataFrame:
    """keys with the next key-frame's values; a track may be longer than a task should get."""
    names = ("frame", "enabled", *values)
    rows = ordered.next_row(ordered.in_ranges(keys, track, *map(F.col, order)), track, F.struct(*names), "_next")
    return rows.select(*keys.columns, *(F.col(f"_next.{c}").alias(f"_{c}") for c in names))


def _filled(pairs: DataFrame, track: str, start: Column, end: Column, values, extra=()) -> DataFrame:
    """A row for each frame from start to end; end < start gives none, since sequence() would count down."""
    frames = F.when(end >= start, F.sequence(start, end))
    rows = pairs.select("*", F.explode(frames).alias("at"))
    at = lambda c: F.when(F.col("_frame").isNull() | (F.col("_frame") <= F.col("frame")), F.col(c)).otherwise(between(F.col("frame").cast("double"), F.col("_frame").cast("double"), F.col("at").cast("double"), F.col(c), F.col(f"_{c}")))
    return rows.select(track, "at", F.col("frame").alias("from_frame"), *(at(c).alias(c) for c in values), *extra)


def interpolate_closed(keys: DataFrame, track: str, values=VALUES, tie: str = "point_no") -> DataFrame:
    """Frames both ends included: a pair needs an enabled start (missing counts as off) and end > start; it runs to its end frame if that is enabled, else to
    the one before; a later pair overwrites a shared frame; the last key-frame stands for itself if enabled. -> track, frame, values.
    """
    pairs = _next(keys, track, ["frame", tie], values).where(F.coalesce("enabled", F.lit(False)))
    last = F.col("_frame").isNull()
    end = F.when(last, F.col("frame")).when(F.coalesce("_enabled", F.lit(False)), F.col("_frame")).otherwise(F.col("_frame") - 1)
    pairs = pairs.where(last | (F.col("_frame") > F.col("frame")))
    filled = _filled(pairs, track, F.col("frame"), end, values, extra=(tie,))
    latest = F.max_by(F.struct(*values), F.struct("from_frame", tie)).alias("v")
    return filled.groupBy(track, F.col("at").alias("frame")).agg(latest).select(track, "frame", *(F.col(f"v.{c}").alias(c) for c in values))


def interpolate_half_open(keys: DataFrame, track: str, frame_count: int, values=VALUES, tie: str = "point_no") -> DataFrame:
    """Frames up to the next key-frame, which is left out: missing enabled counts as on; a rotated key-frame starts nothing; the last one stands for itself.

    -> track, frame (from 0), values; several tracks may hold a frame. Key-frames before 1 are no frames and give no rows.
    """
    pairs = _next(keys, track, ["frame", tie], values).where(F.coalesce("enabled", F.lit(True)) & (F.coalesce("rotation", F.lit(0.0)) == 0))
    end = F.least(F.when(F.col("_frame").isNull(), F.col("frame")).otherwise(F.col("_frame") - 1), F.lit(frame_count))
    filled = _filled(pairs, track, F.greatest(F.col("frame"), F.lit(1)), end, values)
    return filled.select(track, (F.col("at") - 1).alias("frame"), *values)


def interpolate_at(keys: DataFrame, times: DataFrame, track: str, values=VALUES, tie: str = "point_no") -> DataFrame:
    """Values at given times (track, t): between the last key-frame at or before and the first at or after, if the former is enabled (missing counts as off);
    after the last key-frame its values hold. Both looks-up go over keys and times together, in ranges of that order.
    """
    state = F.struct("time", "enabled", *values)
    line = keys.select(track, F.col("time").alias("t"), F.lit(0).alias("kind"), F.col(tie), state.alias("key")).unionByName(times.select(track, "t", F.lit(1).alias("kind"), F.lit(None).cast(keys.schema[tie].dataType).alias(tie), F.lit(None).cast(keys.select(state.alias("s")).schema["s"].dataType).alias("key")))
    # a time stands after the key-frames at it when looking back, and before them when looking ahead
    back = ordered.last_so_far(ordered.in_ranges(line, track, F.col("t"), F.col("kind"), F.col(tie)), track, "key", "a").where("kind = 1")
    times = back.select(track, "t", "kind", F.lit(None).cast(line.schema[tie].dataType).alias(tie), F.lit(None).cast(line.schema["key"].dataType).alias("key"), "a")
    line = line.where("kind = 0").withColumn("a", F.lit(None).cast(line.schema["key"].dataType)).unionByName(times)
    seen = ordered.first_from_here(ordered.in_ranges(line, track, F.col("t"), F.desc("kind"), F.col(tie)), track, "key", "b").where("kind = 1")
    value = lambda c: F.when(F.col("b").isNull() | (F.col("b.time") <= F.col("a.time")), F.col(f"a.{c}")).otherwise(between(F.col("a.time"), F.col("b.time"), F.col("t"), F.col(f"a.{c}"), F.col(f"b.{c}")))
    return seen.where(F.coalesce(F.col("a.enabled"), F.lit(False))).select(track, "t", *(value(c).alias(c) for c in values))


def as_of(left: DataFrame, right: DataFrame, key: str, time: str, columns: list[str], order: list[str]) -> DataFrame:
    """left with the columns of right's last row of the key at or before its time; null if there is none. Both lie in one order of key and time, which is read in ranges."""
    state = F.struct(*columns)
    kind = right.select(state.alias("s")).schema["s"].dataType
    both = left.withColumn("_s", F.lit(None).cast(kind)).withColumn("_k", F.lit(1)).unionByName(right.select(key, time, *order, state.alias("_s"), F.lit(0).alias("_k")), allowMissingColumns=True)
    ranged = ordered.in_ranges(both, key, F.col(time), F.col("_k"), *map(F.col, order))
    return ordered.last_so_far(ranged, key, "_s", "_last").where("_k = 1").select(*left.columns, *(F.col(f"_last.{c}").alias(f"last_{c}") for c in columns))


def within(spans: DataFrame, points: DataFrame, keys: list[str], first: str, last: str, at: str, width: int) -> DataFrame:
    """spans joined with the points of equal keys that they hold, ends included: an equi-join on bins of `width`, of which a span has one entry for each that it touches."""
    bins = spans.withColumn("_bin", F.explode(F.sequence(F.floor(F.col(first) / width), F.floor(F.col(last) / width))))
    return bins.join(points.withColumn("_bin", F.floor(F.col(at) / width)), [*keys, "_bin"]).where(F.col(at).between(F.col(first), F.col(last))).drop("_bin")
