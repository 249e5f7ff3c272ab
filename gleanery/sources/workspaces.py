"""Editor workspaces: which folders are bases, which sequences lie in them, and which annotation file each sequence has."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.keys import stem_of, suffix_of
from ..schema import BUILD_IMAGE_SUFFIXES, EDITOR

# --- fixed values: the kinds of bases, in their order of precedence ------------------------------------------------
PREFERRED = "recordings_clean_annotated"
BASES = (r"^recordings_clean_annotated$", r"_annotations$", r"^dataset_samples")
EXCLUDED = "verif"
# -------------------------------------------------------------------------------------------------------------------


def base_rank(name: Column) -> Column:
    """The place of a folder's kind among BASES, null for a folder that is no base."""
    out = F.lit(None).cast("int")
    for k, pattern in reversed(list(enumerate(BASES))):
        out = F.when(name.rlike(pattern), F.lit(k)).otherwise(out)
    return out


def sequences(files: DataFrame, path: str = "path", only_one: bool = False) -> DataFrame:
    """rank, base, sequence, group, frames, annotation, status of each sequence below a base, from the paths of all files relative to the root.

    A sequence is a folder with a folder frames/, however deep; frames counts the images that lie directly in that. Its annotation is <its name>.json, else the first *.json beside
    frames/ by name. status is 'missing_json' without one, else 'chosen'. With only_one, as for what comes in anew, a file of another name counts only if it is the one there is, else status is
    'ambiguous_json', and sequences below a folder verif are left out. Files meet their sequence by equi-joins on its folder; sequences stand in order of rank, base and path parts.
    """
    parts = F.split(path, "/")
    rows = files.select(F.col(path).alias("path"), parts.alias("p")).withColumn("rank", base_rank(F.get("p", F.lit(0)))).where("rank is not null")
    marks = F.filter(F.transform("p", lambda x, i: F.when((x == "frames") & (i >= 1) & (i < F.size("p") - 1), i)), lambda i: i.isNotNull())
    inside = rows.select("rank", "p", F.explode(marks).alias("i"), F.substring(suffix_of(F.col("path")), 2, 100).isin(*BUILD_IMAGE_SUFFIXES).alias("image"))
    inside = inside.select("rank", F.get("p", F.lit(0)).alias("base"), F.slice("p", F.lit(1), F.col("i")).alias("s"), ((F.col("i") == F.size("p") - 2) & F.col("image")).alias("frame"))
    if only_one:
        inside = inside.where(~F.array_contains("s", EXCLUDED))
    found = inside.groupBy("rank", "base", "s").agg(F.count_if("frame").alias("frames")).withColumn("sequence", F.array_join("s", "/"))
    folder = F.regexp_replace("path", "/[^/]*$", "")
    named = stem_of(F.col("path")) == F.regexp_extract(folder, "([^/]*)$", 1)
    jsons = rows.where(F.col("path").endswith(".json")).groupBy(folder.alias("sequence")).agg(F.min(F.struct((~named).alias("other"), "path")).alias("first"), F.count("*").alias("jsons"))
    rows = found.join(jsons, "sequence", "left")
    unsure = F.coalesce(F.col("first.other") & (F.col("jsons") > 1), F.lit(False)) if only_one else F.lit(False)
    status = F.when(F.col("first").isNull(), "missing_json").when(unsure, "ambiguous_json").otherwise("chosen")
    relative = F.array_join(F.slice("s", F.lit(2), F.size("s")), "/")
    group = F.concat(F.lit("recordings:"), F.when(relative == "", ".").otherwise(relative))
    return rows.select("rank", "base", "sequence", group.alias("group"), "frames", F.when(status == "chosen", F.col("first.path")).alias("annotation"), status.alias("status"))


def with_documents(chosen: DataFrame, documents: DataFrame, text: str = "text") -> DataFrame:
    """chosen with the document (path, text) of its annotation and its status: 'invalid_json' unless it has two lists, 'length_mismatch' unless both are as long as there are frames, else 'complete'.

    All or nothing: a sequence that is not complete gives no frames.
    """
    doc = F.from_json(F.col(text), EDITOR)
    read = documents.select(F.col("path").alias("annotation"), F.size(doc["exist"]).alias("_exist"), F.size(doc["gt_rect"]).alias("_rect"), F.col(text).alias("document"))
    rows = chosen.join(read, "annotation", "left")
    lists = F.coalesce((F.col("_exist") >= 0) & (F.col("_rect") >= 0), F.lit(False))
    fits = (F.col("_exist") == F.col("frames")) & (F.col("_rect") == F.col("frames"))
    status = F.when(F.col("status") != "chosen", F.col("status")).when(~lists, "invalid_json").when(~fits, "length_mismatch").otherwise("complete")
    return rows.withColumn("status", status).select(*chosen.columns, F.when(F.col("status") == "complete", F.col("document")).alias("document"))
