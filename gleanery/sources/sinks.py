"""Manifests, labels, reports and shards as files; each writer is a plain Spark write, so its commit is atomic by job."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.rounding import rounded
from ..operators import ordered


def write_manifest(rows: DataFrame, path: str, order: tuple[str, ...] = ("split", "source", "sha256"), mode: str = "errorifexists") -> None:
    rows.orderBy(*order).write.mode(mode).option("header", True).option("escape", '"').csv(path)


def append_manifest(rows: DataFrame, path: str) -> None:
    write_manifest(rows, path, ("split", "sha256"), "append")


def label_text(boxes: Column, digits: int = 8) -> Column:
    """The lines of a label file from an array of structs cx, cy, w, h; values half way between two are rounded to the even one."""
    return F.array_join(F.transform(boxes, lambda b: F.format_string("0 " + " ".join([f"%.{digits}f"] * 4), *(rounded(b[k], digits) for k in ("cx", "cy", "w", "h")))), "\n")


def audit_lines(counts: DataFrame) -> DataFrame:
    """metric, key, line of counters (metric, key, n): the lines of one JSON text of nested counters, in order of metric and key, however many there are.

    Whether a counter is the last of its metric is told by the next one in the order, which is read in ranges; which metric comes first and last by one aggregate of the metrics.
    """
    ranged = ordered.in_ranges(counts.select("metric", "key", "n"), "metric", F.col("key"))
    rows = ordered.next_row(ranged, "metric", F.struct("key"), "_next")
    by = counts.groupBy("metric").agg(F.min("key").alias("_first"))
    edges = by.agg(F.min("metric").alias("_least"), F.max("metric").alias("_most"))
    rows = rows.join(by.withColumnRenamed("metric", "_metric"), F.col("metric") == F.col("_metric")).join(F.broadcast(edges), F.lit(True))
    quoted = lambda c: F.regexp_extract(F.to_json(F.struct(F.col(c).alias("k"))), r'(?s)^\{"k":(.*)\}$', 1)
    opened = F.when(F.col("key") == F.col("_first"), F.concat(F.when(F.col("metric") == F.col("_least"), "{").otherwise(""), quoted("metric"), F.lit(":{"))).otherwise("")
    closed = F.when(F.col("_next").isNotNull(), ",").when(F.col("metric") == F.col("_most"), "}}").otherwise("},")
    return rows.select("metric", "key", F.concat(opened, quoted("key"), F.lit(":"), F.col("n").cast("string"), closed).alias("line"))


def write_document(lines: DataFrame, path: str, *order: str) -> None:
    """Writes the column `line` as text files whose names, sorted, follow the order: one after the other they are the document, of any size, written by as many tasks."""
    lines.repartitionByRange(*order).sortWithinPartitions(*order).select("line").write.text(path)


def dataset_card(summary: list, title: str = "Dataset") -> str:
    """Markdown of split counts, from the few collected rows of a summary."""
    lines = [f"# {title}", "", "| split | images | objects | negatives |", "| --- | ---: | ---: | ---: |"]
    return "\n".join([*lines, *(f"| {r['split']} | {r['images']:,} | {r['objects']:,} | {r['negatives']:,} |" for r in summary), ""])


def repaired_jpeg(content: Column) -> Column:
    """JPEG bytes with the end marker added where it is missing."""
    return F.when(F.hex(F.substring(content, -2, 2)) != "FFD9", F.concat(content, F.unhex(F.lit("FFD9")))).otherwise(content)
