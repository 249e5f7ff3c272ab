"""Archives of several volumes: which files make a set, what of it is missing or doubled, and whether it may be opened."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def volumes(files: DataFrame, path: str) -> DataFrame:
    """files with `archive` (the name that all volumes of a set share), `style` ('part', 'old' or 'single') and `volume` (from 1; null if the number is too long)."""
    low = F.lower(path)
    part, old = F.regexp_extract(low, r"\.part(\d+)\.rar$", 1), F.regexp_extract(low, r"\.r(\d{2,3})$", 1)
    style = F.when(part != "", "part").when((old != "") | low.endswith(".rar"), "old").otherwise("single")
    number = F.when(part != "", part.try_cast("long")).when(old != "", old.try_cast("long") + 2).otherwise(F.lit(1).cast("long"))
    archive = F.when(style == "part", F.regexp_replace(path, r"(?i)\.part\d+\.rar$", "")).when(style == "old", F.regexp_replace(path, r"(?i)\.r(ar|\d{2,3})$", "")).otherwise(F.col(path))
    return files.withColumns({"archive": archive, "style": style, "volume": number})


def volume_sets(files: DataFrame, path: str, ordinal: str) -> DataFrame:
    """archive, style, files, volumes, last, missing, doubled, disordered, unreadable, openable of each set.

    missing lists the gaps from 1 to the last volume as '3-5,8'; doubled the volumes of which there are several files; disordered counts the volumes that come,
    by `ordinal`, before the one they follow; unreadable counts files whose number is too long. A set may be opened if it has its first volume, no gap, nothing doubled
    and nothing unreadable. Gaps are found from their edges, by joins of each volume with the next and the one before: no set is gathered in one place, however many
    files or numbers it has.
    """
    rows = volumes(files.select(F.col(path).alias("path"), F.col(ordinal).alias("ordinal")), "path")
    keys = ["archive", "style"]
    each = rows.where("volume is not null and volume > 0").groupBy(*keys, "volume").agg(F.count("*").alias("n"), F.min("ordinal").alias("ordinal"))
    near = lambda step, name: each.select(*keys, (F.col("volume") + step).alias("volume"), F.col("ordinal").alias(name))
    edged = each.join(near(-1, "after"), [*keys, "volume"], "left").join(near(1, "before"), [*keys, "volume"], "left")
    # a gap begins after a volume without the next, and ends before one without the one before
    edges = edged.groupBy(*keys).agg(
        F.sum("n").alias("readable"), F.count("*").alias("volumes"), F.max("volume").alias("last"), F.min("volume").alias("first"),
        F.array_sort(F.collect_list(F.when(F.col("after").isNull(), F.col("volume") + 1))).alias("begins"), F.array_sort(F.collect_list(F.when(F.col("before").isNull() & (F.col("volume") > 1), F.col("volume") - 1))).alias("ends"),
        F.array_join(F.array_sort(F.collect_list(F.when(F.col("n") > 1, F.col("volume")))), ",").alias("doubled"), F.count_if(F.col("after") < F.col("ordinal")).alias("disordered"),
    )
    begins = F.when(F.col("first") > 1, F.concat(F.array(F.lit(1).cast("long")), "begins")).otherwise(F.col("begins"))
    gaps = F.zip_with(F.slice(begins, F.lit(1), F.size("ends")), "ends", lambda a, b: F.when(a == b, a.cast("string")).otherwise(F.concat_ws("-", a.cast("string"), b.cast("string"))))
    total = rows.groupBy(*keys).agg(F.count("*").alias("files"), F.count_if(F.col("volume").isNull() | (F.col("volume") < 1)).alias("unreadable"))
    out = total.join(edges.select(*keys, "volumes", "last", F.array_join(gaps, ",").alias("missing"), "doubled", "disordered"), keys, "left")
    zero = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    openable = (F.col("volumes") > 0) & (F.col("missing") == "") & (F.col("doubled") == "") & (F.col("unreadable") == 0)
    return out.select(*keys, "files", zero("volumes"), "last", "missing", "doubled", zero("disordered"), "unreadable", F.coalesce(openable, F.lit(False)).alias("openable"))
