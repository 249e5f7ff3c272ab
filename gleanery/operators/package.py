"""Shard packing, export ids and manifests."""

from __future__ import annotations

import bisect

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from ..functions.geometry import centre_to_coco
from ..schema import BUCKET_FILES, SHARD_BYTES
from ..session import kept


def next_fit(sizes, target: int, start: int = 0) -> list[int]:
    """Shard numbers in order: a shard is closed when the next item would pass the target; a larger item has one to itself."""
    out, shard, held, open_ = [], start, 0, False
    for n in sizes:
        if open_ and held + n > target:
            shard, held = shard + 1, 0
        held, open_ = held + n, True
        out.append(shard)
    return out


def _starts(sizes: np.ndarray, target: int) -> tuple[np.ndarray, np.ndarray]:
    """The sums of the sizes up to each, and for each item where the next shard begins if one begins there; len(sizes) if not among these."""
    total = np.cumsum(sizes)
    before = total - sizes
    return total, np.maximum(np.searchsorted(total, before + target, "right"), np.arange(1, len(sizes) + 1))


def _range_map(part: str, target: int):
    """What a range of items makes of what stands open before it: one row with the bytes held at its end, and the shards begun on the way, for each item that the next shard may begin with."""

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("_id")
        total, following = _starts(table.column("_size").to_numpy(), target)
        n = len(total)
        held, begun = np.zeros(n, np.int64), np.zeros(n, np.int64)
        sizes = table.column("_size").to_numpy()
        for i in range(n - 1, -1, -1):
            j = following[i]
            held[i], begun[i] = (total[-1] - total[i] + sizes[i], 1) if j >= n else (held[j], begun[j] + 1)
        before = total - sizes
        # an open shard is closed within `target` bytes, so only so many items can be the first of a new one
        k = int(np.searchsorted(before, target, "right"))
        one = lambda c: table.column(c).slice(0, 1)
        listed = lambda x: pa.array([x[:k].tolist()], pa.list_(pa.int64()))
        return pa.table([one(part), one("_part"), pa.array([int(total[-1])], pa.int64()), listed(before), listed(held), listed(begun)], names=[part, "_part", "_total", "_before", "_held", "_begun"])

    return run


def _entries(part: str, target: int, schema: pa.Schema):
    """(maps of all ranges of a split) -> what stands open before each: held (-1 for nothing) and the number of the open shard."""

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("_part")
        held, shard, out = -1, table.column("_start")[0].as_py() - 1, []
        for total, before, ends, begun in zip(*(table.column(c).to_pylist() for c in ("_total", "_before", "_held", "_begun"))):
            out.append((held, shard))
            # the item that does not fit any more; with nothing open the first one
            i = 0 if held < 0 else max(bisect.bisect_right(before, target - held) - 1, 0)
            if held >= 0 and target - held >= total:
                held += total
            else:
                held, shard = ends[i], shard + begun[i]
        return pa.table([table.column(part), table.column("_part"), pa.array([h for h, _ in out], pa.int64()), pa.array([n for _, n in out], pa.int32())], schema=schema)

    return run


def _numbered(target: int):
    """The items of a range with their shards, from what stands open before it."""

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("_id")
        sizes = table.column("_size").to_numpy()
        held, shard = table.column("_open")[0].as_py(), table.column("_number")[0].as_py()
        total, following = _starts(sizes, target)
        begins = np.zeros(len(sizes) + 1, np.int32)
        i = 0 if held < 0 else int(np.searchsorted(total, target - held, "right"))
        while i < len(sizes):
            begins[i] = 1
            i = following[i]
        return pa.table([table.column("_id"), pa.array(shard + np.cumsum(begins[:-1]), pa.int32())], names=["_id", "shard"])

    return run


def pack_next_fit(rows: DataFrame, split: str, order: list[str], size: str, target: int = SHARD_BYTES, starts: DataFrame | None = None) -> DataFrame:
    """rows with `shard`, next-fit by split in the given order, which must tell a split's rows apart; starts (split, start) are the first numbers to use.

    Where a shard ends depends on all before it, but a range of the order sees of that only how many bytes stand open at its beginning. So each range tells,
    for every item that may be its first of a new shard, what it would leave open and how many shards it would begin; these maps are composed from range to range (a row each), and
    then every range numbers its items by itself. No task gets more than a range of sizes, or a row for each range.
    """
    wanted = rows if starts is None else rows.join(F.broadcast(starts.select(F.col(split).alias("_split"), F.col("start").cast("int").alias("_start"))), F.col(split) == F.col("_split"), "left").drop("_split")
    ranged = wanted.repartitionByRange(split, *order).sortWithinPartitions(split, *order)
    ranged = ranged.withColumns({"_part": F.spark_partition_id(), "_id": F.monotonically_increasing_id(), "_size": F.coalesce(F.col(size).cast("long"), F.lit(0)), "_start": F.coalesce("_start", F.lit(0)) if starts is not None else F.lit(0)})
    # written once: the ranges come from a sample and must be the same in both passes
    ranged = kept(ranged, "ranges")
    kind = rows.schema[split].dataType
    name, sizes = f"`{split}` {kind.simpleString()}", ranged.select(split, "_part", "_id", "_size")
    maps = sizes.groupBy(split, "_part").applyInArrow(_range_map(split, target), f"{name}, _part int, _total long, _before array<long>, _held array<long>, _begun array<long>")
    first = ranged.groupBy(split).agg(F.first("_start").alias("_start")).withColumnRenamed(split, "_split")
    maps = maps.join(first, F.col(split).eqNullSafe(F.col("_split"))).drop("_split")
    schema = pa.schema([(split, to_arrow_type(kind)), ("_part", pa.int32()), ("_open", pa.int64()), ("_number", pa.int32())])
    entries = maps.groupBy(split).applyInArrow(_entries(split, target, schema), f"{name}, _part int, _open long, _number int").withColumnRenamed(split, "_split")
    entered = sizes.join(entries.withColumnRenamed("_part", "_range"), F.col(split).eqNullSafe(F.col("_split")) & (F.col("_part") == F.col("_range"))).drop("_split", "_range")
    shards = entered.groupBy(split, "_part").applyInArrow(_numbered(target), "_id long, shard int")
    return ranged.join(shards, "_id").select(*rows.columns, "shard")


def next_shard(manifest: DataFrame, split: str, shard: str) -> DataFrame:
    return manifest.groupBy(split).agg((F.coalesce(F.max(shard), F.lit(-1)) + 1).alias("start"))


def shard_manifest(packed: DataFrame, split: str, size: Column, boxes: Column) -> DataFrame:
    return packed.groupBy(split, "shard").agg(F.count("*").alias("images"), F.sum(size).cast("long").alias("bytes"), F.sum(boxes).cast("long").alias("boxes"))


def coco_ids(boxes: DataFrame, split: str, image: str, line: list[str]) -> DataFrame:
    """boxes with image_id and annotation_id, dense from 1 by split; a total order in `line` makes them certain.

    Images stand in one global order of ranges; each range is numbered by itself, and the ranges' totals by split, summed up over the ranges before, are
    added. Within an image a window numbers its boxes. No task gets a whole split.
    """
    images = boxes.groupBy(split, image).agg(F.count("*").alias("_n"))
    # written once: ranges come from a sample and must be the same for the totals and the rows
    ranged = kept(images.repartitionByRange(split, image).sortWithinPartitions(split, image).withColumn("_part", F.spark_partition_id()), "images")
    totals = ranged.groupBy("_part", split).agg(F.count("*").alias("_images"), F.sum("_n").alias("_boxes"))
    before = Window.partitionBy(split).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # a row for each range and split
    offsets = totals.select("_part", split, *(F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"{c}_before") for c in ("_images", "_boxes")))
    w = Window.partitionBy("_part", split).orderBy(image)
    numbered = ranged.withColumn("_place", F.row_number().over(w)).withColumn("_inside", F.sum("_n").over(w) - F.col("_n")).join(F.broadcast(offsets), ["_part", split])
    numbered = numbered.select(split, image, (F.col("_place") + F.col("_images_before")).cast("int").alias("image_id"), (F.col("_inside") + F.col("_boxes_before")).alias("_before"))
    inside = boxes.withColumn("_at", F.row_number().over(Window.partitionBy(split, image).orderBy(*line)))
    return inside.join(numbered, [split, image]).withColumn("annotation_id", F.col("_before") + F.col("_at")).drop("_at", "_before")


def coco_document(annotations: DataFrame, split: str, category: str = "drone") -> DataFrame:
    """split, document: a JSON text by split of images and annotations with pixel boxes. Meant for exports of one file a split."""
    box = centre_to_coco(*(F.col(c) for c in ("cx", "cy", "w", "h", "width", "height")))
    rows = annotations.withColumn("b", box)
    ann = F.struct(F.col("annotation_id").alias("id"), "image_id", F.lit(1).alias("category_id"), F.array("b.x", "b.y", "b.w", "b.h").alias("bbox"), F.col("b.area").alias("area"), F.lit(0).alias("iscrowd"))
    img = F.struct(F.col("image_id").alias("id"), F.col("image").cast("string").alias("file_name"), "width", "height")
    by = rows.groupBy(split).agg(F.sort_array(F.collect_set(img)).alias("images"), F.sort_array(F.collect_list(ann)).alias("annotations"))
    cats = F.array(F.struct(F.lit(1).alias("id"), F.lit(category).alias("name"), F.lit(category).alias("supercategory")))
    return by.select(split, F.to_json(F.struct("images", "annotations", cats.alias("categories"))).alias("document"))


def coco_lines(annotations: DataFrame, split: str, category: str = "drone") -> DataFrame:
    """split, section, n, line: the same document as lines, which in order of section and n make one JSON text by split, however large.

    Ids are dense from 1, so a line ends with a comma if its id is less than how many there are: no line has to know the one after it.
    """
    sides = ("cx", "cy", "w", "h", "width", "height")
    box = centre_to_coco(*(F.col(c) for c in sides))
    # written once: four sections read it, and the ids took shuffles of all boxes
    annotations = kept(annotations.select(split, "image", "image_id", "annotation_id", *sides), "annotations")
    totals = F.broadcast(annotations.groupBy(split).agg(F.max("image_id").alias("_images"), F.max("annotation_id").alias("_annotations")))  # a row for each split
    line = lambda x, n, most: F.concat(F.to_json(x), F.when(n < most, ",").otherwise("")).alias("line")
    images = annotations.select(split, "image_id", "image", "width", "height").distinct().join(totals, split)
    img = F.struct(F.col("image_id").alias("id"), F.col("image").cast("string").alias("file_name"), "width", "height")
    images = images.select(split, F.lit(1).alias("section"), F.col("image_id").cast("long").alias("n"), line(img, F.col("image_id"), F.col("_images")))
    boxes = annotations.withColumn("b", box).join(totals, split)
    ann = F.struct(F.col("annotation_id").alias("id"), "image_id", F.lit(1).alias("category_id"), F.array("b.x", "b.y", "b.w", "b.h").alias("bbox"), F.col("b.area").alias("area"), F.lit(0).alias("iscrowd"))
    boxes = boxes.select(split, F.lit(3).alias("section"), F.col("annotation_id").cast("long").alias("n"), line(ann, F.col("annotation_id"), F.col("_annotations")))
    cats = F.to_json(F.array(F.struct(F.lit(1).alias("id"), F.lit(category).alias("name"), F.lit(category).alias("supercategory"))))
    frame = F.array(*(F.struct(F.lit(k).alias("section"), F.lit(0).cast("long").alias("n"), x.alias("line")) for k, x in ((0, F.lit('{"images":[')), (2, F.lit('],"annotations":[')), (4, F.concat(F.lit('],"categories":'), cats, F.lit("}"))))))
    return annotations.select(split).distinct().select(split, F.inline(frame)).unionByName(images).unionByName(boxes)


def full_directories(paths: DataFrame, path: str, limit: int = BUCKET_FILES) -> DataFrame:
    """Directories with `limit` files or more."""
    return paths.groupBy(F.regexp_replace(F.col(path), "/[^/]*$", "").alias("directory")).agg(F.count("*").alias("files")).where(F.col("files") >= limit)


def first_rows(rows: DataFrame, group: str, order: list[str], n: int) -> DataFrame:
    return rows.withColumn("place", F.row_number().over(Window.partitionBy(group).orderBy(*order))).where(F.col("place") <= n)


def renamed_on_collision(rows: DataFrame, target: str, order: list[str], md5: str) -> DataFrame:
    """rows with `local_name`: the first of a name keeps it, later ones get part of their hash before the suffix."""
    again = F.row_number().over(Window.partitionBy(target).orderBy(*order)) > 1
    stem, suffix = F.regexp_replace(target, r"(\.[^./]+)?$", ""), F.regexp_extract(target, r"(\.[^./]+)$", 1)
    return rows.withColumn("local_name", F.when(again, F.concat(stem, F.lit("__"), F.substring(F.col(md5), 1, 8), suffix)).otherwise(F.col(target)))
