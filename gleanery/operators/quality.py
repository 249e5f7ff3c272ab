"""Box filters, the label validator and audit counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schema import MIN_BOX_PIXELS, VALIDATOR_TOLERANCE


def _rules(*rules: tuple[str, Column]) -> Column:
    """The names of the rules that hold, in one pass."""
    return F.filter(F.array(*(F.when(cond, F.lit(name)) for name, cond in rules)), lambda x: x.isNotNull())


def box_verdict(boxes: Column, width: Column, height: Column, least: float = MIN_BOX_PIXELS) -> Column:
    """struct(verdict, small): 'no_boxes', 'undersized' (with the number of boxes below `least` pixels on a side) or 'kept'."""
    small = F.size(F.filter(boxes, lambda b: (b["w"] * width < least) | (b["h"] * height < least)))
    return F.struct(F.when(F.size(boxes) == 0, "no_boxes").when(small > 0, "undersized").otherwise("kept").alias("verdict"), F.when(F.size(boxes) > 0, small).otherwise(0).alias("small"))


def negative_kind(boxes: Column, removed: Column) -> Column:
    return F.when((F.size(boxes) == 0) & (removed > 0), "non_target").when(F.size(boxes) == 0, "native_empty").otherwise("")


def audit(rows: DataFrame, *metrics: tuple[str, Column, Column]) -> DataFrame:
    """metric, key, n: sums by metric and key; rows without a key count for nothing. One aggregate for all metrics."""
    entries = F.filter(F.array(*(F.struct(F.lit(m).alias("metric"), k.cast("string").alias("key"), n.cast("long").alias("n")) for m, k, n in metrics)), lambda e: e["key"].isNotNull() & (e["n"] > 0))
    return rows.select(F.inline(entries)).groupBy("metric", "key").agg(F.sum("n").alias("n"))


def usable_image(width: Column, height: Column, kind: Column) -> Column:
    return (width >= 2) & (height >= 2) & kind.isin("BMP", "GIF", "JPEG", "PNG", "WEBP")


_NUMBER = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"


def number(text: Column) -> Column:
    """A plain decimal number, else null; neither 1d nor 1_0 nor words."""
    return F.when(text.rlike(_NUMBER), text.try_cast("double"))


def finite_number(text: Column) -> Column:
    """A plain decimal number that a double can hold, else null: 1e999 is none."""
    value = number(text)
    return F.when(F.abs(value) < float("inf"), value)


def parse_label_lines(rows: DataFrame, text: str, classes: list[int] | None = None) -> DataFrame:
    """rows exploded by line of a label text: line (from 1), class_value (as it stands), class_id, cx, cy, w, h, fields, status.

    status: 'malformed' (not five fields or not numbers), 'other_class' (not of the wanted ones), else 'box'. Blank lines are left out. A class is cut to an integer.
    """
    lines = rows.select("*", F.posexplode(F.split(F.col(text), "\n")).alias("_p", "_line")).where(F.trim("_line") != "")
    # fields and numbers come out of generators: conditions on them would else be put before them, and each of their mentions be parsed anew
    once = lambda *c: F.inline(F.array(F.struct(*c)))
    parts = lines.select("*", once(F.split(F.trim(F.regexp_replace("_line", r"\s+", " ")), " ").alias("_f")))
    value = lambda i: number(F.try_element_at("_f", F.lit(i)))
    out = parts.select(*rows.columns, (F.col("_p") + 1).alias("line"), once(F.size("_f").alias("fields"), *(value(i + 1).alias(k) for i, k in enumerate(("_c", "cx", "cy", "w", "h")))))
    sound = (F.col("fields") == 5) & F.col("_c").isNotNull() & (F.abs("_c") < 2147483647) & F.col("cx").isNotNull() & F.col("cy").isNotNull() & F.col("w").isNotNull() & F.col("h").isNotNull()
    out = out.withColumn("class_id", F.when(sound, F.col("_c").cast("int"))).withColumn("_sound", sound)
    wanted = F.lit(True) if classes is None else F.col("class_id").isin(classes)
    return out.withColumn("status", F.when(~F.col("_sound"), "malformed").when(~wanted, "other_class").otherwise("box")).withColumnRenamed("_c", "class_value").drop("_sound")


def box_errors(class_value: Column, cx: Column, cy: Column, w: Column, h: Column, classes: list[int], tolerance: float = VALIDATOR_TOLERANCE) -> Column:
    """Names of the rules that a parsed label row breaks; a row with a value that is not finite breaks only that rule, besides its class."""
    finite = F.lit(True)
    for v in (cx, cy, w, h):
        finite = finite & v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf"))
    bad_class = class_value.isNull() | (class_value != F.floor(class_value)) | ~class_value.isin([float(c) for c in classes])
    crosses = (cx - w / 2 < -tolerance) | (cy - h / 2 < -tolerance) | (cx + w / 2 > 1 + tolerance) | (cy + h / 2 > 1 + tolerance)
    return _rules(
        ("class", bad_class), ("not_finite", ~finite),
        ("centre_outside", finite & ((cx < 0) | (cx > 1) | (cy < 0) | (cy > 1))),
        ("size_outside", finite & ((w <= 0) | (w > 1) | (h <= 0) | (h > 1))),
        ("crosses_boundary", finite & crosses),
    )


def validate_pairs(images: DataFrame, labels: DataFrame, key: str, allow_missing: bool = False) -> DataFrame:
    """key, rule: missing_label, orphan_label and duplicate_image, from one outer join of the two key counts."""
    left = images.groupBy(key).agg(F.count("*").alias("n"))
    both = left.join(labels.select(key).distinct().withColumn("has", F.lit(True)), key, "full_outer")
    rules = _rules(("orphan_label", F.col("n").isNull()), ("missing_label", F.col("n").isNotNull() & F.col("has").isNull() & F.lit(not allow_missing)), ("duplicate_image", F.coalesce(F.col("n"), F.lit(0)) > 1))
    return both.select(key, F.explode(rules).alias("rule"))


def disagreements(old: DataFrame, new: DataFrame, key: str, value: str, group: Column) -> DataFrame:
    """Rows by group and how many values differ, nulls counted as values."""
    joined = old.select(key, F.col(value).alias("_old"), group.alias("grp")).join(new.select(key, F.col(value).alias("_new")), key)
    return joined.groupBy("grp").agg(F.count("*").alias("n_rows"), F.count_if(~F.col("_old").eqNullSafe(F.col("_new"))).alias("changed"))
