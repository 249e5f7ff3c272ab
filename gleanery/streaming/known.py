"""A set of known keys on disk that grows batch by batch, of which a batch reads only the parts that may hold its keys.

Keys lie in parts by the first digits of their SHA-256, each batch's in files of its own. Beside them stands a Bloom filter of each part and batch, as rows of 64 bits; a batch
joins its keys' places to these rows and opens the parts where all bits of some key are set. A batch writes keys, filter, then its mark in the log: one that was cut off is
written anew in the same places, one that is marked is not done again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import kept

#: Hex digits that tell a part, bits of a filter for each key and how many of them a key sets.
DIGITS, BITS, HASHES = 2, 12, 6
#: A filter has so many words at least and at most.
LEAST_WORDS, MOST_WORDS = 16, 1 << 24


def exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def _part(key: Column) -> Column:
    return F.substring(F.sha2(key.cast("string").cast("binary"), 256), 1, DIGITS)


def _places(key: Column, words: Column) -> Column:
    """The bits of a filter of so many words that a key sets: array of struct(word, mask)."""
    bits = F.array(*(F.pmod(F.xxhash64(key, F.lit(i)), words * 64) for i in range(HASHES)))
    return F.transform(bits, lambda b: F.struct(F.floor(b / 64).cast("int").alias("word"), F.expr("1L").alias("one"), (b % 64).cast("int").alias("bit")))


class KnownKeys:
    """The set at `path`, a folder that all executors share, of the values of column `key`."""

    def __init__(self, spark: SparkSession, path: str, key: str):
        self.spark, self.path, self.key = spark, path.rstrip("/"), key

    def _table(self, name: str, schema: str) -> DataFrame:
        place = f"{self.path}/{name}"
        return self.spark.read.schema(schema).parquet(place) if exists(self.spark, place) else self.spark.createDataFrame([], schema)

    def done(self, batch: int) -> bool:
        return exists(self.spark, f"{self.path}/log/batch={batch}/_SUCCESS")

    def _filters(self, but: int) -> DataFrame:
        return self._table("filter", "part string, words int, word int, bits long, batch long").where(F.col("batch") != but)

    def parts(self, rows: DataFrame, batch: int = -1) -> list[str]:
        """The parts that may hold keys of rows, at most 16 ^ DIGITS; what `batch` itself wrote does not count."""
        filters = self._filters(batch)
        sizes = filters.select("part", "batch", "words").distinct()
        asked = rows.select(F.col(self.key).alias("k")).where("k is not null").distinct().withColumn("part", _part(F.col("k")))
        wanted = asked.join(F.broadcast(sizes), "part").withColumn("place", F.explode(_places(F.col("k"), F.col("words"))))
        hit = wanted.select("k", "part", "batch", F.col("place.word").alias("word"), F.col("place.bit").alias("bit")).join(filters.select("part", "batch", "word", "bits"), ["part", "batch", "word"]).where(F.expr("(shiftrightunsigned(bits, bit) & 1L) = 1"))
        # a key's places may fall together, so as many rows as places, not as bits
        return sorted(r.part for r in hit.groupBy("k", "part", "batch").agg(F.count("*").alias("n")).where(F.col("n") == HASHES).select("part").distinct().collect())

    def known(self, parts: list[str], batch: int = -1) -> DataFrame:
        """The keys in some parts, as column `key`; files of other parts are not opened."""
        kind = f"{self.key} string, part string, batch long"
        return self._table("keys", kind).where(F.col("part").isin(parts) & (F.col("batch") != batch)).select(self.key)

    def fresh(self, rows: DataFrame, ordinal: str, batch: int = -1) -> DataFrame:
        """Of the rows whose key is not in the set the first of each key; rows without a key are left out."""
        as_text = F.col(self.key).cast("string")
        rows = rows.where(as_text.isNotNull())
        first = rows.groupBy(self.key).agg(F.min(ordinal).alias("_first"))
        known = self.known(self.parts(rows, batch), batch).select(F.col(self.key).alias("_known"))
        return rows.join(first, self.key).where(F.col("_first") == F.col(ordinal)).drop("_first").dropDuplicates([self.key]).join(known, as_text == F.col("_known"), "left_anti")

    def add(self, rows: DataFrame, batch: int) -> None:
        """Writes the keys of rows as those of a batch; once more in the same places if it was cut off before."""
        keys = kept(rows.select(F.col(self.key).cast("string").alias(self.key)).distinct().withColumn("part", _part(F.col(self.key))), "keys")
        out = lambda df, name, *by: df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by, "batch").parquet(f"{self.path}/{name}")
        out(keys.withColumn("batch", F.lit(batch).cast("long")).repartition("part"), "keys", "part")
        words = F.least(F.greatest(F.ceil(F.col("n") * BITS / 64), F.lit(LEAST_WORDS)), F.lit(MOST_WORDS)).cast("int")
        sizes = keys.groupBy("part").agg(F.count("*").alias("n")).select("part", words.alias("words"))
        places = keys.join(F.broadcast(sizes), "part").select("part", "words", F.explode(_places(F.col(self.key), F.col("words"))).alias("p"))
        filters = places.groupBy("part", "words", F.col("p.word").alias("word")).agg(F.bit_or(F.expr("shiftleft(p.one, p.bit)")).alias("bits"))
        out(filters.withColumn("batch", F.lit(batch).cast("long")), "filter")
        self.spark.range(1).write.mode("overwrite").parquet(f"{self.path}/log/batch={batch}")


def ingest(stream: DataFrame, path: str, key: str, ordinal: str, checkpoint: str, out: str | None = None) -> None:
    """Runs a stream to its end: rows whose key is new go to out/batch=<n>, their keys to the set at `path`. A batch that is marked in the set's log does nothing, one that was cut off gives the same again."""

    def batch(rows: DataFrame, number: int) -> None:
        known = KnownKeys(rows.sparkSession, path, key)
        if known.done(number):
            return
        fresh = kept(known.fresh(rows, ordinal, number).select(*rows.columns), "fresh")
        if out is not None:
            fresh.write.mode("overwrite").parquet(f"{out}/batch={number}")
        known.add(fresh, number)

    stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
