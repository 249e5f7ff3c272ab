"""Exact dedup as a stateful stream: disk-backed keyed state that never expires.

A digest of each normalised text is written with the row's id and its content locator (file and row within it). A Structured Streaming query
reads that log and keeps, in RocksDB state on the checkpoint folder, per digest: how often it came, the stable identifier of
the row that stays, and its locator. Rows are summed up per task before the shuffle, so a digest with a third of all rows
costs a row per task. On hits (digests of more than one row) the full bytes of every copy are compared with those of the row
that stays; should they differ, that digest's texts are grouped by their bytes.

The state lasts: with a folder of one's own as `state`, a later call on the grown table digests only the files that the log lacks, and
the stream goes on from its checkpoint.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import common

#: RocksDB state; without disk space reserved ahead, which many small stores would multiply, and with memory bounded by executor.
_STATE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "48",
}


def normalised(column: pa.Array) -> pa.Array:
    """A-Z lower-cased, null as empty."""
    return pc.ascii_lower(pc.fill_null(column, pa.scalar("", column.type)))


def _digests(digest_of):
    def run(batches):
        for b in batches:
            data = normalised(b.column("text")).cast(pa.large_binary() if pa.types.is_large_string(b.column("text").type) else pa.binary())
            sha, digest = [], []
            for x in data.to_pylist():
                sha.append(hashlib.sha256(x).hexdigest())
                digest.append(sha[-1] if digest_of is None else digest_of(x))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("file"), b.column("row"), pa.array(sha, pa.string()), pa.array(digest, pa.string())], ["doc_id", "file", "row", "text_sha256", "digest"])

    return run


def _normalise(batches):
    for b in batches:
        yield b.drop_columns(["text"]).append_column("body", normalised(b.column("text")))


_LOG = "doc_id long, file string, row long, text_sha256 string, digest string"


def stream_state(spark, home: str, batch_files: int = 10_000) -> DataFrame:
    """(digest, keep, group_size) after the stream has taken all of the log in home that it had not; keep is (doc_id, file, row), the largest doc_id."""
    before = {k: spark.conf.get(k, None) for k in _STATE}
    for k, v in _STATE.items():
        spark.conf.set(k, v)
    try:
        rows = spark.readStream.schema(_LOG).option("maxFilesPerTrigger", batch_files).parquet(f"{home}/log")
        state = rows.groupBy("digest").agg(F.max(F.struct("doc_id", "file", "row")).alias("keep"), F.count("*").alias("group_size"))

        def put(batch: DataFrame, number: int) -> None:
            batch.write.mode("overwrite").parquet(f"{home}/out/batch={number}")

        state.writeStream.outputMode("update").option("checkpointLocation", f"{home}/state").trigger(availableNow=True).foreachBatch(put).start().awaitTermination()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    schema = "digest string, keep struct<doc_id: bigint, file: string, row: bigint>, group_size bigint"
    if not _exists(spark, f"{home}/out"):  # nothing has ever come
        return spark.createDataFrame([], schema)
    # a digest is put out by each batch that brings it, always with more rows than before
    return spark.read.schema(schema).parquet(f"{home}/out").groupBy("digest").agg(F.max_by("keep", "group_size").alias("keep"), F.max("group_size").alias("group_size"))


def _exists(spark, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


#: A digest with more than one in so many rows is hot; there are no more of them than that.
_HOT = 1000


def _with_state(log: DataFrame, state: DataFrame, total: int) -> DataFrame:
    """log joined with state by digest. Hot digests, _HOT at most, are broadcast, so no task gets all rows of one."""
    hot = F.broadcast(state.where(F.col("group_size") * _HOT > total))
    rest = log.join(hot.select("digest"), "digest", "left_anti").join(state.where(F.col("group_size") * _HOT <= total), "digest")
    return log.join(hot, "digest").unionByName(rest)


def exact_duplicates(documents: DataFrame, digest_of=None, state: str | None = None, batch_files: int = 10_000) -> DataFrame:
    """Per row of documents: doc_id, keep_id, group_size, kept, text_sha256, file, row (the locator).

    Texts are equal when they are after A-Z is lower-cased; null counts as empty. The row with the largest doc_id stays; among
    rows that repeat that id with that text, the one last by locator. A null doc_id is less than any other. documents needs
    doc_id (long) and text and must come from files; other columns are not looked at. digest_of (bytes -> str) replaces
    SHA-256 as the key, which tests use to bring about hits whose bytes differ. An empty table gives an empty table.

    state is a folder that all executors share and that outlasts the session, in which log and state stay; a later call with it must get the same table with
    files added, none changed or gone, and takes up only those. None is a scratch folder for this call.
    """
    spark = documents.sparkSession
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row"))
    home = state or common.scratch_path(spark, "dedup")
    fresh = docs
    if state and _exists(spark, f"{home}/log"):
        fresh = docs.join(common.few(spark.read.schema(_LOG).parquet(f"{home}/log").select("file").distinct()), "file", "left_anti").select(*docs.columns)
    fresh.mapInArrow(common.freeing(_digests(digest_of)), _LOG).write.mode("append").parquet(f"{home}/log")
    log = spark.read.schema(_LOG).parquet(f"{home}/log")
    found = common.keep(stream_state(spark, home, batch_files), "state")

    # a number for each locator: files by name, then the row; what is broadcast below are such numbers
    files = common.few(common.keep(log.select(F.col("file").alias("named")).distinct().withColumn("no", F.row_number().over(Window.orderBy("named")).cast("long") * (1 << 40)), "files"))
    at = lambda df, file, row, name: df.join(files, F.col(file) == F.col("named")).withColumn(name, F.col("no") + F.col(row)).drop("no", "named")
    hits = found.where("group_size > 1").select("digest", "group_size", F.col("keep.file").alias("kept_file"), F.col("keep.row").alias("kept_row"))
    hits = common.keep(at(hits, "kept_file", "kept_row", "one").select("digest", "group_size", "one"), "hits")
    total = log.count()
    # a third of all rows may share a digest: its rows are compared in parts of some 1,000, each with a copy of the text that stays
    copies = _with_state(at(log.select("digest", "file", "row"), "file", "row", "at").select("digest", "at"), hits, total)
    copies = common.keep(copies.select("at", "one", F.ceil(F.col("group_size") / 1024).cast("int").alias("parts")), "copies")
    numbered = at(docs, "file", "row", "at").select("doc_id", "at", "text")
    body = "doc_id long, at long, one long, parts int, body string"

    def bodies_of(wanted: DataFrame) -> DataFrame:
        return numbered.join(common.few(wanted), "at").select("doc_id", "at", "one", "parts", "text").mapInArrow(common.freeing(_normalise), body)

    bodies = bodies_of(copies)
    staying = bodies_of(copies.where("at = one")).select("one", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.col("body").alias("kept_body"))
    parted = bodies.withColumn("part", F.pmod(F.xxhash64("at"), F.col("parts")).cast("int"))
    differ = common.keep(parted.join(staying, ["one", "part"]).where("body != kept_body").select("one").distinct(), "differ")

    plain = _with_state(log, found, total)
    if differ.take(1):
        odd = at(log, "file", "row", "at").join(bodies.join(differ, "one", "left_semi").select("at", "body"), "at")
        by_bytes = odd.groupBy("digest", "body").agg(F.max(F.struct("doc_id", "file", "row")).alias("keep"), F.count("*").alias("group_size"))
        exact = odd.join(by_bytes, ["digest", "body"])
        digests = hits.join(differ, "one", "left_semi").select("digest")
        plain = plain.join(digests, "digest", "left_anti").unionByName(exact.select(*plain.columns))
    return plain.select(
        "doc_id", F.col("keep.doc_id").alias("keep_id"), "group_size",
        ((F.col("keep.file") == F.col("file")) & (F.col("keep.row") == F.col("row"))).alias("kept"), "text_sha256", "file", "row",
    )
