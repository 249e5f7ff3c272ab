"""Annotation formats as DataFrames: one row per box, key-frame or frame, with error rows instead of aborts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.geometry import corners_to_centre
from ..functions.keys import stem_of, suffix_of
from ..operators.quality import finite_number, number
from ..schema import BUILD_IMAGE_SUFFIXES, EDITOR, LABEL_STUDIO

#: Column names by which a box file may call a value, first match wins; fixed values.
ALIASES = {
    "frame": ("frame", "frame_index", "index"), "exist": ("drone_exist", "exists", "exist", "present"), "class_id": ("class", "class_id", "classid"),
    "x": ("x", "left", "x1"), "y": ("y", "top", "y1"), "width": ("width", "w"), "height": ("height", "h"), "x2": ("x2", "right"), "y2": ("y2", "bottom"),
}


def resolve_aliases(rows: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """rows of a box CSV, all strings, with the names of ALIASES as doubles; absent ones are null, as is what is no plain finite number. A file without a frame column is an error."""
    have = {c.strip().lower(): c for c in reversed(rows.columns)}
    found = {name: next((have[a] for a in aliases if a in have), None) for name, aliases in ALIASES.items()}
    if found["frame"] is None:
        raise ValueError("a box file needs a frame column")
    value = lambda c: finite_number(F.trim(F.col(f"`{c}`"))) if c else F.lit(None).cast("double")
    out = rows.select(*(keep or []), *(value(c).alias(name) for name, c in found.items()))
    size = lambda side, a, b: F.coalesce(F.col(side), F.col(b) - F.col(a))
    return out.withColumn("width", size("width", "x", "x2")).withColumn("height", size("height", "y", "y2")).drop("x2", "y2")


def read_box_csv(spark: SparkSession, path: str) -> DataFrame:
    return resolve_aliases(spark.read.option("header", True).option("escape", '"').csv(path))


def editor_frames(rows: DataFrame, text: str, ident: str) -> DataFrame:
    """ident, frame (from 0), exist, x, y, w, h, error of an editor document; arrays of unequal length make the sequence one error row."""
    doc = rows.select(ident, F.from_json(F.col(text), EDITOR).alias("d"))
    fine = F.col("d.exist").isNotNull() & F.col("d.gt_rect").isNotNull() & (F.size("d.exist") == F.size("d.gt_rect"))
    bad = doc.where(~F.coalesce(fine, F.lit(False))).select(ident, F.lit(None).cast("int").alias("frame"), F.lit(None).cast("int").alias("exist"), *(F.lit(None).cast("double").alias(c) for c in "xywh"), F.lit("length_mismatch").alias("error"))
    each = doc.where(fine).select(ident, F.posexplode(F.arrays_zip(F.col("d.exist").alias("exist"), F.col("d.gt_rect").alias("rect"))).alias("frame", "z"))
    value = lambda i: F.try_element_at("z.rect", F.lit(i))
    missing = (F.col("z.exist") != 0) & (F.size("z.rect") != 4)
    good = each.select(ident, "frame", F.col("z.exist").alias("exist"), *(value(i + 1).alias(c) for i, c in enumerate("xywh")), F.when(missing, "positive_without_box").alias("error"))
    return good.unionByName(bad)


def label_studio_keyframes(rows: DataFrame, text: str, ident: str, label: str = "Drone", latest: bool = True) -> DataFrame:
    """Key-frames of video tracks: ident, track_id, point_no, frame, time, enabled, rotation, x, y, width, height, frames_count.

    Of each task the latest annotation that was not cancelled counts (latest), or the first task's first one.
    """
    tasks = rows.select(ident, F.posexplode(F.from_json(F.col(text), f"array<{LABEL_STUDIO[6:-1]}>")).alias("task_no", "task"))
    live = F.filter("task.annotations", lambda a: ~F.coalesce(a["was_cancelled"], F.lit(False)))
    if latest:
        best = F.array_max(F.transform(live, lambda a: a["id"]))
        chosen = tasks.withColumn("ann", F.try_element_at(F.filter(live, lambda a: a["id"] == best), F.lit(1)))
    else:
        chosen = tasks.where("task_no = 0").withColumn("ann", F.try_element_at("task.annotations", F.lit(1)))
    wanted = F.filter("ann.result", lambda r: (r["type"] == "videorectangle") & F.array_contains(r["value"]["labels"], label))
    tracks = chosen.select(ident, "task_no", F.posexplode(wanted).alias("track_id", "r"))
    points = tracks.select(ident, "task_no", "track_id", F.col("r.value.framesCount").alias("frames_count"), F.posexplode("r.value.sequence").alias("point_no", "p"))
    return points.select(ident, "task_no", "track_id", "point_no", *(F.col(f"p.{c}").alias(c) for c in ("frame", "time", "enabled", "rotation", "x", "y", "width", "height")), "frames_count")


_CORNERS = ("xmin", "ymin", "xmax", "ymax")
_GAP, _TEXT = r"[ \t\r\n]*+", "[^<>&" + "".join(f"\\x{i:02x}" for i in (*range(32), 127)) + "]*+"


def _leaf(name: str, text: str = _TEXT) -> str:
    return f"<{name}>{text}</{name}>{_GAP}"


def _leaves(*names: str, text: str = _TEXT) -> str:
    """Each of these once at most, in this order."""
    return "".join(f"(?:{_leaf(name, text)})?+" for name in names)


#: An object as VOC files have it: name and corners are its groups. All repeats are possessive: no pattern here goes back or takes stack by the length of a text.
_OBJECT = _leaf("object", _GAP + _leaf("name", f"({_TEXT})") + _leaves("pose", "truncated", "difficult", "occluded") + _leaf("bndbox", _GAP + _leaves(*_CORNERS, text=f"({_TEXT})")))
#: What stands for an object once it is cut: a control, which no XML holds, and the values, each before a <.
_MARK, _CUT = "\u0001", "\u0001$1<$2<$3<$4<$5<"
#: A document, its objects cut, that is nothing but the usual elements in the usual order, without attributes, comments, entities, sections or controls; well-formed by that. What any other is, only a parser tells.
_PLAIN = rf"\A{_GAP}" + _leaf("annotation", (
    _GAP + _leaves("folder", "filename", "path") + f"(?:{_leaf('source', _GAP + _leaves('database', 'annotation', 'image'))})?+"
    + f"(?:{_leaf('size', _GAP + _leaves('width', 'height', 'depth'))})?+" + _leaves("segmented") + f"(?:{_MARK}(?:{_TEXT}<){{5}}+)*+"
)) + r"\z"


def voc_boxes(rows: DataFrame, text: str, ident: str, width: Column, height: Column, name: str = "drone") -> DataFrame:
    """ident, cx, cy, w, h, error of the named objects of a VOC document; a corner that is missing or no plain finite number makes an error row.

    Plain documents are cut up by patterns, which takes a fraction of what Spark's XML parser takes; it reads all others. Both give the same values.
    """
    kind = "array<struct<name:string,bndbox:struct<xmin:string,ymin:string,xmax:string,ymax:string>>>"
    # what is mentioned more than once comes out of generators, as each mention would make it anew
    once = lambda *c: F.inline(F.array(F.struct(*c)))
    docs = rows.select(ident, F.col(text).alias("_t"), width.alias("_w"), height.alias("_h"), once(F.regexp_replace(text, _OBJECT, _CUT).alias("_cut")))
    cut = F.split("_cut", _MARK)
    plain = F.arrays_zip(F.slice(cut, F.lit(2), F.size(cut) - 1).alias("raw"), F.array().cast(kind).alias("parsed"))
    parsed = F.arrays_zip(F.array().cast("array<string>").alias("raw"), F.from_xml("_t", f"struct<object:{kind}>")["object"].alias("parsed"))
    sound = F.col("_cut").rlike(_PLAIN) & ~F.contains("_t", F.lit(_MARK))
    objects = docs.select(ident, "_w", "_h", F.explode(F.when(sound, plain).otherwise(parsed)).alias("_o"))
    values = F.coalesce(F.split("_o.raw", "<"), F.array("_o.parsed.name", *(f"_o.parsed.bndbox.{c}" for c in _CORNERS)))
    value = lambda i: F.trim(F.get("_v", F.lit(i)))
    named = objects.select(ident, "_w", "_h", once(values.alias("_v"))).where(value(0) == name)
    numbers = named.select(ident, "_w", "_h", once(*(number(value(i + 1)).alias(f"_{c}") for i, c in enumerate(_CORNERS))))
    corner = [F.when(F.abs(f"_{c}") < float("inf"), F.col(f"_{c}")) for c in _CORNERS]
    lacking = sum(c.isNull().cast("int") for c in corner) > 0
    box = corners_to_centre(*corner, F.col("_w"), F.col("_h"))
    out = numbers.select(ident, F.when(~lacking, box).alias("b"), F.when(lacking, "bad_corner").alias("error"))
    return out.select(ident, *(F.col(f"b.{c}").alias(c) for c in ("cx", "cy", "w", "h")), "error")


def voc_images(documents: DataFrame, images: DataFrame, text: str, path: str) -> DataFrame:
    """documents with `image`: the file that a VOC document names, in its own folder, else the first by name of the images that share its stem there, else null.

    path is where a document lies; images (path) are the files that are there. Two equi-joins: by path, and by folder and stem.
    """
    name = F.trim(F.from_xml(F.col(text), "filename string")["filename"])
    folder = F.regexp_extract(path, r"^(.*/)?[^/]*$", 1)
    stemmed = lambda c: F.concat(F.regexp_extract(c, r"^(.*/)?[^/]*$", 1), stem_of(F.col(c)))
    there = images.select(F.col("path").alias("_there")).distinct()
    usable = there.where(F.substring(suffix_of(F.col("_there")), 2, 100).isin(*BUILD_IMAGE_SUFFIXES))
    by_stem = usable.groupBy(stemmed("_there").alias("_stem")).agg(F.min("_there").alias("_fallback"))
    rows = documents.withColumns({"_named": F.when(name != "", F.concat(folder, name)), "_stem": stemmed(path)})
    rows = rows.join(there, F.col("_named") == F.col("_there"), "left").join(by_stem, "_stem", "left")
    return rows.select(*documents.columns, F.coalesce("_there", "_fallback").alias("image"))


def pixel_rows(rows: DataFrame, line: str, ident: str) -> DataFrame:
    """ident, x, y, w, h, status of lines of a headerless pixel file: 'malformed' under five columns or where one is no plain finite number, 'negative' if all four are 0, else 'box'."""
    f = F.split(F.col(line), ",")
    value = [finite_number(F.trim(F.try_element_at(f, F.lit(i)))) for i in (2, 3, 4, 5)]
    bad = (F.size(f) < 5) | F.array_contains(F.transform(F.array(*value), lambda v: v.isNull()), True)
    zero = (value[0] == 0) & (value[1] == 0) & (value[2] == 0) & (value[3] == 0)
    return rows.select(ident, *(v.alias(c) for v, c in zip(value, "xywh")), F.when(bad, "malformed").when(zero, "negative").otherwise("box").alias("status"))


def nested_boxes(rows: DataFrame, ident: str, objects: str = "objects") -> DataFrame:
    """ident, box_no, x, y, w, h from a nested list column of [x, y, w, h]."""
    each = rows.select(ident, F.posexplode(f"{objects}.bbox").alias("box_no", "b"))
    return each.select(ident, "box_no", *(F.try_element_at("b", F.lit(i + 1)).alias(c) for i, c in enumerate("xywh")))


def detect_format(files: DataFrame, group: str, path: str) -> DataFrame:
    """group, format: json, yolo (text labels), csv, or json where nothing is there yet."""
    has = lambda p: F.max(F.col(path).rlike(p))
    by = files.groupBy(group).agg(has(r"(?i)\.json$").alias("j"), has(r"(?i)(^|/)labels/[^/]*\.txt$").alias("y"), has(r"(?i)\.csv$").alias("c"))
    return by.select(group, F.when(F.col("j"), "json").when(F.col("y"), "yolo").when(F.col("c"), "csv").otherwise("json").alias("format"))
