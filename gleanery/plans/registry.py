"""All queries of the library with their SQL twins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..session import ship
from . import boxes, curation, ingest, stores, timeline, vision

_ALL = {f: sql for part in (boxes.QUERIES, curation.QUERIES, timeline.QUERIES, ingest.QUERIES, vision.QUERIES, stores.QUERIES) for f, sql in part.items()}


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return curation.flagship(ship(spark), sf_dir)


def _shipped(f):
    return lambda spark, sf_dir: f(ship(spark), sf_dir)


def queries() -> dict:
    return {f.__name__: _shipped(f) for f in _ALL}


def oracle_sql() -> dict[str, str]:
    return {f.__name__: sql for f, sql in _ALL.items() if sql}
