"""Tables, and the boxes and tracks that the queries derive from them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: A box for each line item: its image is the order. + 0.0 turns -0.0 into 0.0.
BOXES = """SELECT l_orderkey AS image, l_linenumber AS line, l_partkey, l_suppkey, l_returnflag, l_discount * 10 + CAST(0 AS DOUBLE) AS cx, l_tax * CAST(12.5 AS DOUBLE) + CAST(0 AS DOUBLE) AS cy,
 l_quantity / CAST(50 AS DOUBLE) AS w, (l_suppkey % 40 + 1) / CAST(40 AS DOUBLE) AS h, CAST(640 + 64 * (l_orderkey % 4) AS DOUBLE) AS width, CAST(480 AS DOUBLE) AS height FROM lineitem"""
#: A key-frame for each event: its track is the user, its frame the hour.
KEYS = """SELECT user_id, event_id, CAST(floor((epoch(ts) - 1704067200) / 3600) AS INTEGER) AS frame, (epoch(ts) - 1704067200) / CAST(60 AS DOUBLE) AS time, event_type <> 'error' AS enabled,
 CASE WHEN event_type = 'signup' THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS rotation, value AS x, value / 2 AS y FROM events"""
BOX_IDS = ["image", "line", "l_partkey", "l_suppkey"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = lambda x: F.lit(float(x))
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("image"), F.col("l_linenumber").alias("line"), "l_partkey", "l_suppkey", "l_returnflag",
        (F.col("l_discount") * 10 + d(0)).alias("cx"), (F.col("l_tax") * d(12.5) + d(0)).alias("cy"), (F.col("l_quantity") / d(50)).alias("w"), ((F.col("l_suppkey") % 40 + 1) / d(40)).alias("h"),
        (640 + 64 * (F.col("l_orderkey") % 4)).cast("double").alias("width"), d(480).alias("height"),
    )


def keyframes(spark: SparkSession, sf_dir: str) -> DataFrame:
    seconds = F.unix_micros(F.col("ts").cast("timestamp")) / F.lit(1e6) - F.lit(1704067200.0)
    return table(spark, sf_dir, "events").select(
        "user_id", "event_id", F.floor(seconds / 3600).cast("int").alias("frame"), (seconds / F.lit(60.0)).alias("time"), (F.col("event_type") != "error").alias("enabled"),
        F.when(F.col("event_type") == "signup", F.lit(1.0)).otherwise(F.lit(0.0)).alias("rotation"), F.col("value").alias("x"), (F.col("value") / 2).alias("y"),
    )
