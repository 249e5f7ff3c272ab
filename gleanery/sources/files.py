"""Files, archives, manifests, listings and metrics as DataFrames."""

from __future__ import annotations

import io
import zipfile

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schema import MANIFEST

LISTING = "Path string, ID string, Size bigint, ModTime string, MimeType string, Hashes struct<md5:string>"


def scan_files(spark: SparkSession, root: str, suffixes: tuple[str, ...], content: bool = False) -> DataFrame:
    """path, length (and content) of the files under root with a suffix, whatever its case. Content is not read unless asked for."""
    rows = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
    wanted = F.lower(F.regexp_extract("path", r"\.([^./]+)$", 1)).isin(*suffixes)
    return rows.where(wanted).select("path", "length", *(["content"] if content else []))


def scan_text(spark: SparkSession, root: str, glob: str = "*.txt") -> DataFrame:
    """path and whole text of small files."""
    return spark.read.option("wholetext", True).option("recursiveFileLookup", True).option("pathGlobFilter", glob).text(root).select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("text"))


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """A manifest, whose texts may hold line ends: each file is one task's work."""
    return spark.read.schema(MANIFEST).option("header", True).option("multiLine", True).option("escape", '"').csv(path)


def synthesised_manifest(images: DataFrame, labels: DataFrame) -> DataFrame:
    """split, path, boxes for a tree without manifest: images (path) and labels (path, text) by the labels' place beside the images."""
    from ..functions.keys import label_path

    split = F.regexp_extract("path", r"(?:^|/)images/(train|val|test)/", 1)
    lines = labels.select(F.col("path").alias("_label"), F.size(F.filter(F.split("text", "\n"), lambda x: F.trim(x) != "")).alias("boxes"))
    return images.select(split.alias("split"), "path", label_path(F.col("path")).alias("_label")).join(lines, "_label", "left").select("split", "path", F.coalesce("boxes", F.lit(0)).alias("boxes"))


def read_listing(spark: SparkSession, path: str) -> DataFrame:
    rows = spark.read.schema(LISTING).option("multiLine", True).json(path)
    return rows.select(F.col("ID").alias("drive_id"), F.col("Path").alias("path"), F.col("Size").alias("size"), F.col("ModTime").alias("modified"), F.col("MimeType").alias("mime"), F.col("Hashes.md5").alias("md5"))


def archive_type(content: Column) -> Column:
    """zip or rar by the first bytes, not the name; else null."""
    head = F.hex(F.substring(content, 1, 7))
    return F.when(head.startswith("504B0304") | head.startswith("504B0506"), "zip").when(head.startswith("526172211A07"), "rar")


def zip_members(files: DataFrame) -> DataFrame:
    """archive, member, size, crc32 of ZIP files (path, content); unreadable ones give a row with member null."""

    def run(batches):
        for b in batches:
            rows = []
            for path, content in zip(b.column("path").to_pylist(), b.column("content").to_pylist()):
                try:
                    with zipfile.ZipFile(io.BytesIO(content or b"")) as z:
                        rows += [(path, i.filename, i.file_size, i.CRC) for i in z.infolist() if not i.is_dir()]
                except zipfile.BadZipFile:
                    rows.append((path, None, None, None))
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate((pa.string(), pa.string(), pa.int64(), pa.int64()))], ["archive", "member", "size", "crc32"])

    return files.select("path", "content").mapInArrow(run, "archive string, member string, size long, crc32 long")


def read_results_csv(spark: SparkSession, path: str) -> DataFrame:
    """A metrics table with blanks around its names and values."""
    rows = spark.read.option("header", True).option("ignoreLeadingWhiteSpace", True).option("ignoreTrailingWhiteSpace", True).csv(path)
    return rows.select(*(F.col(f"`{c}`").try_cast("double").alias(c.strip()) for c in rows.columns))


def read_metric_log(spark: SparkSession, path: str, metric: str = "test_coco_eval_bbox") -> DataFrame:
    """epoch (from 1), map50_95, map50 of a JSON-lines log."""
    rows = spark.read.schema(f"epoch int, {metric} array<double>").json(path)
    return rows.select((F.col("epoch") + 1).alias("epoch"), F.try_element_at(metric, F.lit(1)).alias("map50_95"), F.try_element_at(metric, F.lit(2)).alias("map50"))


def trainer_lines(rows: DataFrame, line: str) -> DataFrame:
    """rows with phase ('train' or 'test'), epoch and batch where a trainer's line tells them."""
    train, test = r"Epoch: \[(\d+)(?:/\d+)?\]\s+\[\s*(\d+)/(\d+)\]", r"Test:\s+\[\s*(\d+)/(\d+)\]"
    num = lambda p, i: F.nullif(F.regexp_extract(line, p, i), F.lit("")).try_cast("int")  # noqa: E731  null if it is too long
    phase = F.when(F.col(line).rlike(train), "train").when(F.col(line).rlike(test), "test")
    return rows.select("*", phase.alias("phase"), num(train, 1).alias("epoch"), F.coalesce(num(train, 2), num(test, 1)).alias("batch"), F.coalesce(num(train, 3), num(test, 2)).alias("batches"))


def class_names(config: dict) -> dict[int, str]:
    """Names by class of a data set's configuration, given as a list or a mapping."""
    names = config.get("names") or {}
    return {int(k): str(v) for k, v in (names.items() if isinstance(names, dict) else enumerate(names))}


def read_yaml(text: str) -> dict:
    """A data set's configuration; needs PyYAML only if the text is more than scalars, lists and one level of mapping."""
    try:
        import yaml
    except ImportError:
        yaml = None
    if yaml is not None:
        return yaml.safe_load(text) or {}
    out: dict = {}
    key = None
    for raw in text.splitlines():
        line = raw.split(" #")[0].rstrip()
        if not line or line.lstrip().startswith("#"):
            continue
        if line[0] not in " -":
            key, _, value = line.partition(":")
            value = value.strip()
            out[key] = [x.strip().strip("'\"") for x in value[1:-1].split(",") if x.strip()] if value.startswith("[") else value.strip("'\"") or None
        elif line.strip().startswith("- "):
            out[key] = [*(out[key] or []), line.strip()[2:].strip("'\"")]
        else:
            k, _, value = line.strip().partition(":")
            out[key] = {**(out[key] or {}), (int(k) if k.isdigit() else k): value.strip().strip("'\"")}
    return out
