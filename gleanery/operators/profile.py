"""What a folder or archive holds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.keys import is_junk, suffix_of
from ..schema import ANNOTATION_SUFFIXES, IMAGE_SUFFIXES, VIDEO_SUFFIXES


def _least(rows: DataFrame, group: str, value: Column, n: int, name: str) -> DataFrame:
    """By group the n least different values, as a sorted array."""
    ranked = rows.select(group, value.alias("v")).distinct().withColumn("place", F.row_number().over(Window.partitionBy(group).orderBy("v"))).where(F.col("place") <= n)
    return ranked.groupBy(group).agg(F.sort_array(F.collect_list("v")).alias(name))


def content_profile(files: DataFrame, group: str, path: str, size: str, names: int = 30, examples: int = 20) -> DataFrame:
    """By group: files, bytes, images, videos, annotation_files, frames_or_images_dirs, labels_dirs, top_level (the `names` least names at the top) and
    annotation_examples (the `examples` least paths of annotation files). Paths are relative to the group's root; junk is left out, as are folders without files."""
    rows = files.where(~is_junk(F.col(path))).withColumn("_suffix", F.substring(suffix_of(F.col(path)), 2, 100))
    kind = lambda suffixes: F.col("_suffix").isin(*suffixes)
    sums = rows.groupBy(group).agg(
        F.count("*").alias("files"), F.sum(size).cast("long").alias("bytes"), F.count_if(kind(IMAGE_SUFFIXES)).alias("images"),
        F.count_if(kind(VIDEO_SUFFIXES)).alias("videos"), F.count_if(kind(ANNOTATION_SUFFIXES)).alias("annotation_files"),
    )
    folders = rows.select(group, F.regexp_replace(path, "/?[^/]*$", "").alias("d")).distinct().where("d != ''").withColumn("p", F.split("d", "/"))
    folders = folders.select(group, F.explode(F.transform(F.sequence(F.lit(1), F.size("p")), lambda n: F.array_join(F.slice("p", 1, n), "/"))).alias("d")).distinct()
    last = F.lower(F.regexp_extract("d", "([^/]*)$", 1))
    dirs = folders.groupBy(group).agg(F.count_if(last.isin("frames", "images")).alias("frames_or_images_dirs"), F.count_if(last == "labels").alias("labels_dirs"))
    top = _least(rows, group, F.regexp_extract(path, "^([^/]*)", 1), names, "top_level")
    shown = _least(rows.where(kind(ANNOTATION_SUFFIXES)), group, F.col(path), examples, "annotation_examples")
    out = sums.join(dirs, group, "left").join(top, group, "left").join(shown, group, "left").na.fill(0, ["frames_or_images_dirs", "labels_dirs"])
    return out.withColumn("annotation_examples", F.coalesce("annotation_examples", F.array().cast("array<string>")))


def suffix_histogram(files: DataFrame, group: str, path: str) -> DataFrame:
    suffix = suffix_of(F.col(path))
    return files.where(~is_junk(F.col(path))).groupBy(group, F.when(suffix == "", "<none>").otherwise(suffix).alias("suffix")).agg(F.count("*").alias("n"))


def shared_runs(texts: DataFrame, ident: str, items: DataFrame, item: str, words: int = 8, broadcast_bytes: int = 64 << 20) -> DataFrame:
    """item, ident, shared: how many different runs of `words` words a text shares with an item; both have a column text.

    Only runs whose hash an item has leave the texts; the items' hashes (8 bytes and some 40 of table) are broadcast if they were counted to be
    within bounds, else joined by shuffling. Equal hashes are then compared by the runs themselves.
    """

    def runs(df: DataFrame, key: str) -> DataFrame:
        split = F.filter(F.split(F.lower("text"), r"\s+"), lambda x: x != "")
        each = F.transform(F.sequence(F.lit(1), F.size("w") - (words - 1)), lambda i: F.array_join(F.slice("w", i, words), " "))
        return df.select(key, split.alias("w")).where(F.size("w") >= words).select(key, F.explode(each).alias("run")).withColumn("h", F.xxhash64("run"))

    wanted = runs(items, item)
    hashes = wanted.select("h").distinct()
    if hashes.count() * 48 <= broadcast_bytes:
        hashes = F.broadcast(hashes)
    found = runs(texts, ident).join(hashes, "h", "left_semi").distinct()  # few are left; most runs are told apart by nobody
    return found.join(wanted.distinct(), ["h", "run"]).groupBy(item, ident).agg(F.count("*").alias("shared"))
