"""From the files of a data set to candidate rows: images beside their label texts, with group and split."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.geometry import clip_normalised
from ..functions.keys import frame_number, label_path, stem_of, suffix_of, with_suffix
from ..schema import BUILD_IMAGE_SUFFIXES, STRIDE


def is_image(path: Column) -> Column:
    return F.substring(suffix_of(path), 2, 100).isin(*BUILD_IMAGE_SUFFIXES)


def with_labels(images: DataFrame, labels: DataFrame, label: Column) -> DataFrame:
    """images (path, group, source_split) with the text of the label file at `label`; status 'missing_label' where there is none, else 'labelled'."""
    texts = labels.select(F.col("path").alias("label_path"), F.col("text"))
    rows = images.withColumn("label_path", label).join(texts, "label_path", "left")
    return rows.withColumn("status", F.when(F.col("text").isNull(), "missing_label").otherwise("labelled"))


def flat_yolo(images: DataFrame, labels: DataFrame, source: str, by_video: bool = False) -> DataFrame:
    """A folder of images with label files beside them. The group is the stem or, by_video, the video that its name begins with; no split is known."""
    stem = stem_of(F.col("path"))
    video = F.lower(F.regexp_extract(stem, r"(?i)^(video\d+)_", 1))
    group = F.when(video != "", video).otherwise(stem) if by_video else stem
    rows = images.where(is_image(F.col("path"))).select("path", F.concat(F.lit(f"{source}:"), group).alias("group"), F.lit(None).cast("string").alias("source_split"))
    return with_labels(rows, labels, with_suffix(F.col("path"), ".txt"))


def on_stride(stem: Column, stride: int = STRIDE) -> Column:
    """Whether the number at a name's end is a multiple of the stride; names without one always are."""
    number = F.regexp_extract(stem, r"_(\d+)$", 1)
    # digit by digit, as a number of any length has a remainder
    rest = F.aggregate(F.filter(F.split(number, ""), lambda d: d != ""), F.lit(0), lambda r, d: (r * 10 + d.cast("int")) % stride)
    return (number == "") | (F.when(F.length(number) <= 18, F.when(number != "", number.cast("long")) % stride).otherwise(rest) == 0)


def strided_yolo(images: DataFrame, labels: DataFrame, source: str, stride: int = STRIDE) -> DataFrame:
    """images/<split>/ beside labels/<split>/, every stride-th frame of a sequence; the group is the sequence."""
    stem = stem_of(F.col("path"))
    rows = images.where(is_image(F.col("path")) & on_stride(stem, stride))
    rows = rows.select("path", F.concat(F.lit(f"{source}:"), F.regexp_replace(stem, r"_visible_\d+$", "")).alias("group"), F.regexp_extract("path", r"(?:^|/)images/([^/]+)/[^/]*$", 1).alias("source_split"))
    return with_labels(rows, labels, label_path(F.col("path")))


def split_yolo(images: DataFrame, labels: DataFrame, source: str, exported: bool = False) -> DataFrame:
    """<split>/images/ beside <split>/labels/; a folder `valid` is val. The group is the stem or, for exports, what it was before .rf.<hash> was added."""
    stem = stem_of(F.col("path"))
    group = F.regexp_replace(stem, r"\.rf\.[^.]+$", "") if exported else stem
    split = F.regexp_extract("path", r"(?:^|/)([^/]+)/images/[^/]*$", 1)
    rows = images.where(is_image(F.col("path"))).select("path", F.concat(F.lit(f"{source}:"), group).alias("group"), F.when(split == "valid", "val").otherwise(split).alias("source_split"))
    return with_labels(rows, labels, label_path(F.col("path")))


def prepared_yolo(images: DataFrame, labels: DataFrame, source: str) -> DataFrame:
    """A tree images/ mirrored by labels/; the group is the folder below images/ that holds the file, . for images/ itself."""
    folder = F.regexp_extract("path", r"^(?:.*?/)??images/(.*)/[^/]*$", 1)
    rows = images.where(is_image(F.col("path"))).select("path", F.concat(F.lit(f"{source}:"), F.when(folder == "", ".").otherwise(folder)).alias("group"), F.lit(None).cast("string").alias("source_split"))
    first = F.regexp_replace("path", r"^((?:.*?/)??)images/", "$1labels/")
    return with_labels(rows, labels, with_suffix(first, ".txt"))


def track_frames(frames: DataFrame, tracks: DataFrame, presence: DataFrame, sequence: str) -> DataFrame:
    """Frames of video sequences with the boxes that their tracks give them.

    frames (sequence, path, width, height): the number is in the name, frame_<n>_..., from 0. tracks (sequence, frame, x, y, w, h): in percent,
    from 1. presence (sequence, frame, exist, ordinal), where the last row of a frame counts. A frame has boxes only where it is said to be present; status is 'invalid_frame_name',
    'positive_without_box' or 'kept', negative_kind 'native_empty' for kept frames without boxes. Sequences without presence or tracks are left out.
    """
    name = F.regexp_extract("path", r"([^/]*)$", 1)
    numbered = frames.withColumn("frame", F.when(name.rlike(r"^frame_\d+_"), frame_number(name)))
    known = presence.select(sequence).distinct().join(tracks.select(sequence).distinct(), sequence, "left_semi")
    there = presence.groupBy(sequence, "frame").agg(F.max_by(F.col("exist") != 0, "ordinal").alias("present"))
    at = tracks.select(sequence, (F.col("frame") - 1).alias("frame"), F.struct("x", "y", "w", "h").alias("box")).groupBy(sequence, "frame").agg(F.sort_array(F.collect_list("box")).alias("raw"))
    rows = numbered.join(known, sequence, "left_semi").join(there, [sequence, "frame"], "left").join(at, [sequence, "frame"], "left")
    box = lambda b: clip_normalised((b["x"] + b["w"] / 2) / 100, (b["y"] + b["h"] / 2) / 100, b["w"] / 100, b["h"] / 100, F.col("width"), F.col("height"))
    given = F.filter(F.transform(F.coalesce("raw", F.array().cast("array<struct<x:double,y:double,w:double,h:double>>")), box), lambda b: b.isNotNull())
    present = F.coalesce("present", F.lit(False))
    rows = rows.withColumn("boxes", F.when(present, given).otherwise(F.filter(given, lambda b: F.lit(False))))
    status = F.when(F.col("frame").isNull(), "invalid_frame_name").when(present & (F.size("boxes") == 0), "positive_without_box").otherwise("kept")
    return rows.select(sequence, "path", "frame", "boxes", status.alias("status")).withColumn("negative_kind", F.when((F.col("status") == "kept") & (F.size("boxes") == 0), "native_empty").otherwise(""))


def static_pairs(spark: SparkSession, pairs: dict[str, str], left: str = "recording", right: str = "annotation") -> DataFrame:
    """A literal mapping as a table to join with."""
    return spark.createDataFrame(list(pairs.items()), f"{left} string, {right} string")
