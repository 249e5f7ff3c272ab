"""Structured Streaming forms of the incremental operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.dedup import drop_known


def stream_table(spark: SparkSession, schema, path: str, files_a_batch: int = 1000) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_a_batch).parquet(path)


def first_of_key(stream: DataFrame, keys: list[str]) -> DataFrame:
    """The first row of each key that the stream brings; keys are held in state without expiry."""
    return stream.dropDuplicates(keys)


def run_to_end(stream: DataFrame, out: str, checkpoint: str, mode: str = "append") -> None:
    """Runs a stream over what is there and stops; a restart with the same checkpoint goes on where it was."""
    stream.writeStream.outputMode(mode).format("parquet").option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def windowed_counts(stream: DataFrame, time: str, key: str, late: str = "10 minutes", width: str = "1 hour") -> DataFrame:
    """Counts by key and window; rows later than `late` behind the newest are dropped by the watermark."""
    return stream.withWatermark(time, late).groupBy(F.window(time, width), key).agg(F.count("*").alias("n"))


def ingest(stream: DataFrame, known_path: str, key: str, ordinal: str, checkpoint: str) -> None:
    """Appends to the table at known_path the rows whose key it lacks; a batch that is run again adds nothing."""

    def batch(rows: DataFrame, number: int) -> None:
        spark = rows.sparkSession
        try:
            known = spark.read.schema(rows.schema).parquet(known_path)
            known.take(1)
        except Exception as error:
            if "PATH_NOT_FOUND" not in str(error):
                raise
            known = spark.createDataFrame([], rows.schema)
        drop_known(rows, known, key, ordinal).select(*rows.columns).write.mode("append").parquet(known_path)

    stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
