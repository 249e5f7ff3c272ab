"""A training-data pipeline of five operators: good documents, one of each set of equal ones, one of each class of near copies, without secrets, packed.

The tables that stages get must come from files: a row is told from others by its file and its place there, never by doc_id, which may be null or
repeat. Null texts count as empty. Every stage but the last returns all columns as they are, whatever their names.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gleanery.llm import common, exact_dedup, ngram_join, packing, quality, secrets


def _free(docs: DataFrame, *names: str) -> list[str]:
    """Names like these that no column of docs has."""
    taken = {c.lower() for c in docs.columns}
    return [next(n for i in range(len(taken) + 1) if (n := f"_{name}{i}") not in taken) for name in names]


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted on the labelled rows of documents that are not held out, does not reject.

    Each row is judged alone, so repeated rows and ids are kept or dropped alike; an empty table stays empty.
    """
    common.prepare(spark)
    model = quality.fit(common.table(spark, sf_dir, "documents"), common.table(spark, sf_dir, "labels"))
    return quality.keep_good(docs, model)


def keep_exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents with equal texts the one with the largest doc_id, of rows that repeat it the last one; null ids come before all others.

    Null and empty texts are equal, so one of them stays; an empty table stays empty.
    """
    common.give_back(common.prepare(spark))
    file, row, gone_file, gone_row = _free(docs, "file", "row", "gone_file", "gone_row")
    gone = exact_dedup.exact_duplicates(docs).where(~F.col("kept")).select(F.col("file").alias(gone_file), F.col("row").alias(gone_row))
    rows = docs.select("*", F.col("_metadata.file_path").alias(file), F.col("_metadata.row_index").alias(row))
    return rows.join(common.few(gone), (F.col(file) == F.col(gone_file)) & (F.col(row) == F.col(gone_row)), "left_anti").drop(file, row)


def keep_distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near duplicates the document with the smallest doc_id, the first of rows that repeat it; null ids come after all others.

    Texts without words are in no class and stay; an empty table stays empty.
    """
    common.give_back(common.prepare(spark))
    file, row, gone_row = _free(docs, "file", "row", "gone")
    # a number for each row: files by name, then the place in the file
    files = docs.select(F.col("_metadata.file_path").alias(file)).distinct().withColumn(row, F.row_number().over(Window.orderBy(file)).cast("long") * (1 << 40))
    files = common.few(common.keep(files, "files"))
    placed = docs.select("*", F.col("_metadata.file_path").alias(file), F.col("_metadata.row_index").alias(gone_row)).join(files, file).withColumn(row, F.col(row) + F.col(gone_row)).drop(file, gone_row)
    members, _ = ngram_join.near_duplicates(placed.select(F.col(row).alias("doc_id"), "text"))
    named = members.select(F.col("doc_id").alias("row"), "component_id").join(placed.select(F.col(row).alias("row"), F.col("doc_id").cast("long").alias("id")), "row")
    stays = named.groupBy("component_id").agg(F.min(F.struct(F.col("id").isNull(), "id", "row")).alias("least")).select("least.row")
    gone = common.keep(members.select(F.col("doc_id").alias("row")).join(stays, "row", "left_anti").withColumnRenamed("row", gone_row), "gone")
    return placed.join(common.few(gone), F.col(row) == F.col(gone_row), "left_anti").drop(row)


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with the spans that hold secrets, plain or encoded, replaced; n_chars, where there is one, follows. Null texts stay null."""
    common.give_back(common.prepare(spark))
    cleaned = secrets.redact(docs)
    return cleaned.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else cleaned


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents and their places in sequences of 4096 tokens; a null or empty text is one piece of one token."""
    common.give_back(common.prepare(spark))
    return packing.pack(docs)


STAGES = [("quality_classifier", keep_quality), ("exact_dedup", keep_exact), ("ngram_jaccard_join", keep_distinct), ("secret_scans", without_secrets), ("best_fit_packing", packed)]

#: The classifier and the tokenizer can't be told in SQL; tests compare each stage with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str, root: str | None = None) -> DataFrame:
    """The last stage's result; each stage's result is a Parquet table in root, by default a new folder of the shared scratch folder, and read again by the next.

    Scratch tables of a stage are deleted when its result is written.
    """
    docs = common.table(spark, sf_dir, "documents")
    root = root or f"{common.scratch_root(spark)}/pipeline-{uuid.uuid4().hex[:12]}"
    for name, stage in STAGES[:-1]:
        with common.scratch(spark):
            stage(spark, docs, sf_dir).write.parquet(f"{root}/{name}")
        docs = spark.read.parquet(f"{root}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
