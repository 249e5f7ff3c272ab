"""Reports: the validator of a whole data set, totals by source, split and sequence, run histories and documents for small results."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.keys import label_path
from ..schema import NEAR_DUPLICATE_COLUMNS, SPLITS
from .quality import box_errors, parse_label_lines


def dataset_report(roots: DataFrame, images: DataFrame, labels: DataFrame, classes: list[int], allow_missing: bool = False) -> tuple[DataFrame, DataFrame]:
    """(errors, counts) of a data set.

    roots (split, root, present): what its configuration names and whether it is there. images (split, root, path, readable; null where nobody looked).
    labels (path, text). errors: rule, split, path, line. counts: name, n. An image that comes again is only an error, and is counted once, for the first of the splits
    train, val, test that has it.
    """
    none = F.lit(None).cast("string")
    error = lambda df, rule, split=F.col("split"), path=F.col("path"), line=F.lit(None).cast("int"): df.select(F.lit(rule).alias("rule"), split.alias("split"), path.alias("path"), line.alias("line"))
    train = roots.agg(F.count_if(F.col("split") == "train").alias("n")).where("n = 0")
    supported = images.groupBy("split", "root").agg(F.lit(True).alias("some"))
    bare = roots.where("present").join(supported, ["split", "root"], "left_anti")
    at = F.array_position(F.array(*map(F.lit, SPLITS)), F.col("split"))
    first = images.groupBy("path").agg(F.min_by(F.struct("split", "readable"), at).alias("f"), F.count("*").alias("times"))
    once = first.select("path", F.col("f.split").alias("split"), F.col("f.readable").alias("readable"), label_path(F.col("path")).alias("label"))
    again = first.where("times > 1").select("path").join(images.select("path", "split"), "path").join(first.select("path", F.col("f.split").alias("kept")), "path")
    again = _repeats(again)
    paired = once.join(labels.select(F.col("path").alias("label"), "text"), "label", "left")
    lines = parse_label_lines(paired.where("text is not null").select("split", "label", "text"), "text")
    broken = lines.select("*", F.inline(F.array(F.struct(F.when(F.col("fields") != 5, F.array(F.lit("field_count"))).when(F.col("status") == "malformed", F.array(F.lit("not_numeric"))).otherwise(box_errors(F.col("class_value"), F.col("cx"), F.col("cy"), F.col("w"), F.col("h"), classes)).alias("rule")))))  # as in parse_label_lines
    orphan = error(labels.join(once.select(F.col("label").alias("path")).distinct(), "path", "left_anti"), "orphan_label", split=none)
    errors = [
        train.select(F.lit("train_undefined").alias("rule"), F.lit("train").alias("split"), none.alias("path"), F.lit(None).cast("int").alias("line")),
        error(roots.where("not present"), "root_missing", path=F.col("root")), error(bare, "no_images", path=F.col("root")), error(again, "duplicate_image"),
        error(once.where("not readable"), "unreadable_image"), *([] if allow_missing else [error(paired.where("text is null"), "missing_label")]),
        broken.select(F.explode("rule").alias("rule"), "split", F.col("label").alias("path"), "line"),
        orphan,
    ]
    out = errors[0]
    for e in errors[1:]:
        out = out.union(e)
    by = lambda df, kind: df.groupBy("split").agg(F.count("*").alias("n")).select(F.concat("split", F.lit(f"_{kind}")).alias("name"), "n")
    boxes = broken.where("status != 'malformed' and not array_contains(rule, 'not_finite')")
    counts = by(once, "images").union(by(paired.where("text is not null"), "labels")).union(by(paired.where("text is null"), "missing_labels")).union(by(boxes, "boxes"))
    orphans = orphan.agg(F.count("*").alias("n")).select(F.lit("orphan_labels").alias("name"), "n")
    return out, counts.union(orphans.where("n > 0"))


def _repeats(rows: DataFrame) -> DataFrame:
    """Each occurrence of an image but its first: path, split."""
    by = rows.groupBy("path", "split", "kept").agg(F.count("*").alias("n"))
    n = F.col("n") - F.when(F.col("split") == F.col("kept"), 1).otherwise(0)
    return by.where(n > 0).select("path", "split", F.explode(F.array_repeat(F.lit(1), n.cast("int"))).alias("_i")).drop("_i")


def by_source(counts: DataFrame, key: str = "key", n: str = "n") -> DataFrame:
    """Sums by what stands before a key's first colon."""
    return counts.groupBy(F.split_part(F.col(key), F.lit(":"), F.lit(1)).alias("source")).agg(F.sum(n).cast("long").alias("n"))


def conversion_totals(parts: DataFrame, split: str, fields: list[str]) -> DataFrame:
    """Sums of the fields by split."""
    return parts.groupBy(split).agg(*(F.sum(f).cast("long").alias(f) for f in fields))


def boxes_by_image(images: DataFrame, truth: DataFrame, found: DataFrame, key: str) -> DataFrame:
    """key, ground_truth_boxes, prediction_boxes of every image."""
    count = lambda df, name: df.groupBy(key).agg(F.count("*").alias(name))
    return images.select(key).join(count(truth, "ground_truth_boxes"), key, "left").join(count(found, "prediction_boxes"), key, "left").na.fill(0)


def ingest_totals(frames: DataFrame, keys: list[str], boxes: Column, undersized: Column, duplicate: Column) -> DataFrame:
    """By sequence: frames, frames_without_box, undersized_box_frames, duplicates_skipped, added, boxes (of what was added). A frame without boxes counts for nothing else, one with an undersized box is no duplicate."""
    some, fine = boxes > 0, (boxes > 0) & ~undersized
    added = fine & ~duplicate
    return frames.groupBy(*keys).agg(
        F.count("*").alias("frames"), F.count_if(~some).alias("frames_without_box"), F.count_if(some & undersized).alias("undersized_box_frames"), F.count_if(fine & duplicate).alias("duplicates_skipped"),
        F.count_if(added).alias("added"), F.coalesce(F.sum(F.when(added, boxes)), F.lit(0)).cast("long").alias("boxes"),
    )


def near_duplicate_report(pairs: DataFrame, items: DataFrame, ident: str, sha256: str) -> DataFrame:
    """The report's columns, from pairs (hamming, source_a, id_a, source_b, id_b) and items that tell their digests."""
    named = lambda k: items.select(F.col(ident).alias(f"id_{k}"), F.col(sha256).alias(f"sha256_{k}"))
    rows = pairs.join(named("a"), "id_a").join(named("b"), "id_b").withColumnsRenamed({"hamming": "hamming_distance", "id_a": "image_a", "id_b": "image_b"})
    return rows.select(*NEAR_DUPLICATE_COLUMNS)


def frame_table(sequences: DataFrame, ident: str, exists: Column, fps: Column) -> DataFrame:
    """A row for each frame: ident, frame, timestamp (three digits of seconds), drone_exist, audio_exist (0)."""
    rows = sequences.select(ident, fps.cast("double").alias("_fps"), F.posexplode(exists).alias("frame", "_e"))
    return rows.select(ident, "frame", F.format_string("%.3f", F.rint(F.col("frame") / F.col("_fps") * 1000) / 1000).alias("timestamp"), (F.coalesce("_e", F.lit(0)) != 0).cast("int").alias("drone_exist"), F.lit(0).alias("audio_exist"))


def reconciled(rows: DataFrame, truth: DataFrame, keys: list[str], value: str = "drone_exist") -> DataFrame:
    """rows with `value` (a text) as truth tells it, 0 or 1, and `corrected` where that differs from what it was; rows that truth does not know stay."""
    new = truth.select(*keys, (F.col(value) != 0).cast("int").cast("string").alias("_new"))
    out = rows.join(new, keys, "left").withColumn("corrected", F.col("_new").isNotNull() & ~F.col(value).eqNullSafe(F.col("_new")))
    return out.withColumn(value, F.coalesce("_new", value)).drop("_new")


def one_document(rows: DataFrame, name: str, *totals: Column) -> DataFrame:
    """One row, document: a JSON text of the totals and, under `name`, all rows in order. Meant for reports of some thousand rows."""
    listed = F.sort_array(F.collect_list(F.struct(*rows.columns)))
    return rows.agg(*totals, listed.alias(name)).select(F.to_json(F.struct("*")).alias("document"))


def append_history(runs: DataFrame, path: str) -> None:
    """Adds runs, a line of JSON each, to what is at path."""
    runs.write.mode("append").json(path)


def dataset_yaml(splits: dict[str, str], names: dict[int, str]) -> str:
    """The configuration of a data set: image folders by split, class names by number."""
    quoted = lambda x: x if x and all(c.isalnum() or c in "/_-. " for c in x) else json.dumps(x)
    return "".join([*(f"{k}: {quoted(v)}\n" for k, v in splits.items()), "names:\n", *(f"  {k}: {quoted(v)}\n" for k, v in names.items())])
