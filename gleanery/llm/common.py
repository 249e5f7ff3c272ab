"""Helpers that the operators of this subpackage share: tables, shared scratch space, bounded broadcasts, Arrow batches."""

from __future__ import annotations

import contextlib
import contextvars
import ctypes
import sys
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_root, ship

#: Bytes, by a bound of each row's size, that may be broadcast; beyond it the same join is done by shuffling.
BROADCAST_BYTES = 16 << 20

#: What a Python worker gets at once; long texts make few rows heavy, so both are bounded.
BATCH = {"spark.sql.execution.arrow.maxRecordsPerBatch": "2000", "spark.sql.execution.arrow.maxBytesPerBatch": str(4 << 20)}

_made: contextvars.ContextVar[list[str] | None] = contextvars.ContextVar("made", default=None)


def prepare(spark: SparkSession) -> SparkSession:
    """Sends the package to the executors and bounds the batches that workers get."""
    for k, v in BATCH.items():
        spark.conf.set(k, v)
    return ship(spark)


class Memory:
    """What a worker remembers, within a number of bytes: entries go in, with their weight, to the younger of two dicts, which becomes the older one at half of the bound."""

    def __init__(self, most: int):
        self.most, self.young, self.old, self.held = most, {}, {}, 0

    def put(self, key, value, weight: int):
        if self.held + weight > self.most // 2:
            self.old, self.young, self.held = self.young, {}, 0
        self.young[key] = value
        self.held += weight
        return value

    def get(self, key, weight: int):
        """The value or None; one of the older dict becomes young again."""
        value = self.young.get(key)
        if value is None:
            value = self.old.get(key)
            if value is not None:
                self.put(key, value, weight)
        return value


def trim() -> None:
    """Gives memory that a worker has freed back to the system: beside a grown JVM it would count against the executor."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def give_back(spark: SparkSession) -> None:
    """Has each executor's JVM collect all its garbage, after which it gives unused heap back to the system: what a stage has grown it to would count against the executor beside the next stage's Python workers."""
    n = 2 * spark.sparkContext.defaultParallelism
    spark.range(0, n, 1, n).select(F.expr("java_method('java.lang.System', 'gc')")).write.format("noop").mode("overwrite").save()


def forget(own: str = "") -> None:
    """Empties what tasks of other operators than `own` have left to remember in this worker."""
    for name, kept in (("packing", "_loaded"), ("token_counts", "_loaded"), ("bpe_codec", "_loaded"), ("toxicity", "_cache")):
        module = sys.modules.get(f"{__package__}.{name}")
        if module is not None and name != own:
            getattr(module, kept).clear()


def freeing(run, own: str = ""):
    """run (batches -> batches) that begins without what other operators remember, and trims when its task ends."""

    def f(batches):
        forget(own)
        try:
            yield from run(batches)
        finally:
            trim()

    return f


def freeing_group(run):
    """run (table -> table) that trims after each group."""

    def f(table):
        forget()
        try:
            return run(table)
        finally:
            trim()

    return f


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new place in the shared scratch folder, which the scratch() around it deletes, if there is one."""
    path = f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex[:12]}"
    if (made := _made.get()) is not None:
        made.append(path)
    return path


def keep(df: DataFrame, label: str, path: str | None = None) -> DataFrame:
    """df as a Parquet table in the shared scratch folder, read back: lineage ends there and any executor can read it."""
    path = path or scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def delete(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


@contextlib.contextmanager
def scratch(spark: SparkSession, but: list[str] | None = None):
    """Deletes at its end the scratch tables made within it, and no others; those at paths in `but` go to the scratch() around it."""
    outer, mine = _made.get(), []
    token = _made.set(mine)
    try:
        yield
    finally:
        _made.reset(token)
        for path in mine:
            if but and path in but:
                if outer is not None:
                    outer.append(path)
            else:
                delete(spark, path)


def few(df: DataFrame, most: int = BROADCAST_BYTES) -> DataFrame:
    """df with a broadcast hint if its rows were counted to be within `most` bytes, else unchanged; strings are measured, other columns count 16 bytes."""
    wide = [F.coalesce(F.octet_length(f.name), F.lit(0)) + 40 for f in df.schema.fields if f.dataType.typeName() in ("string", "binary")]
    size = F.sum(sum(wide, F.lit(16 * (len(df.columns) - len(wide)) + 16)))
    return F.broadcast(df) if (df.agg(size.alias("size")).first()[0] or 0) <= most else df


def one_text(rows: DataFrame) -> DataFrame:
    """label, text of one of the rows (known_id, label, text) of each id, by a hash of the text: however often an id is repeated, it gives one row."""
    first = rows.groupBy("known_id").agg(F.min(F.struct(F.xxhash64("text").alias("h"), "text", "label")).alias("one"))
    return first.select("one.label", "one.text")


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


def ascii_lower(column):
    """A-Z to a-z and nothing else, as the contracts ask; lower() alone would also change other letters."""
    return F.translate(column, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def text_bytes(column: pa.Array) -> list[bytes]:
    """The UTF-8 bytes of each text of a batch; null counts as empty."""
    column = column.cast(pa.binary()) if not pa.types.is_large_string(column.type) else column.cast(pa.large_binary())
    return [x or b"" for x in column.to_pylist()]


def texts(column: pa.Array) -> list[str]:
    return [x or "" for x in column.to_pylist()]


def by_bytes(items: list, size, most: int):
    """Slices of items of about `most` bytes each, one item at least: (start, stop)."""
    start = total = 0
    for i, x in enumerate(items):
        total += size(x)
        if total >= most:
            yield start, i + 1
            start, total = i + 1, 0
    if start < len(items):
        yield start, len(items)
