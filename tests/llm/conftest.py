import random
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parent))

@pytest.fixture
def rng():
    return random.Random(7)


@pytest.fixture
def on_disk(spark, tmp_path):
    """A table of documents as it is read from files, with columns of other operators' names beside."""

    def make(rows, name="documents", schema="doc_id long, text string", parts=3):
        df = spark.createDataFrame(rows, schema)
        for c in ("n", "node", "shard", "label", "score", "digest", "file", "row", "word"):
            df = df.selectExpr("*", f"'other' AS {c}")
        df.repartition(parts).write.parquet(f"{tmp_path}/{name}.parquet")
        return spark.read.parquet(f"{tmp_path}/{name}.parquet")

    return make
