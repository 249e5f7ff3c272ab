"""Sessions, and getting this package to the executors."""

from __future__ import annotations

import atexit
import os
import re
import shutil
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_shipped: set[str] = set()
_roots: dict[str, str] = {}


def local_session(cpus: str | int = "*", **conf: str) -> SparkSession:
    """A session for tests and the benchmark; on a cluster use the cluster's own."""
    settings = {"spark.sql.shuffle.partitions": "8", "spark.sql.session.timeZone": "UTC", "spark.ui.enabled": "false", "spark.driver.memory": "8g", "spark.sql.adaptive.enabled": "true"} | conf
    return SparkSession.builder.master(f"local[{cpus}]").appName("gleanery").config(map=settings).getOrCreate()


def ship(spark: SparkSession) -> SparkSession:
    """Sends this package to the executors once a session, so that functions in it can be loaded there."""
    context = spark.sparkContext
    if context.applicationId not in _shipped:
        top = Path(__file__).resolve().parent
        folder = tempfile.mkdtemp(prefix="gleanery-")  # on the driver, which serves it for as long as the session runs
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        name = os.path.join(folder, "gleanery.zip")
        with zipfile.ZipFile(name, "w") as z:
            for p in sorted(top.rglob("*.py")):
                z.write(p, p.relative_to(top.parent))
        context.addPyFile(name)
        _shipped.add(context.applicationId)
    return spark


def scratch_root(spark: SparkSession) -> str:
    """A folder of this application in that of spark.checkpoint.dir. Where that is unset, one of our own, which only a driver with its executors in one process may have."""
    app = spark.sparkContext.applicationId
    if app not in _roots:
        root = spark.conf.get("spark.checkpoint.dir", None)
        if not root:
            master = spark.sparkContext.master
            if not re.fullmatch(r"local(\[.*\])?", master):
                raise RuntimeError(f"set spark.checkpoint.dir to a folder that all executors of {master} share")
            root = "file://" + tempfile.mkdtemp(prefix="gleanery-")
        _roots[app] = f"{root.rstrip('/')}/gleanery-{app}"
    return _roots[app]


def kept(df: DataFrame, label: str) -> DataFrame:
    """df as a Parquet table in the scratch folder, read back: lineage ends there and any executor can read it."""
    path = f"{scratch_root(df.sparkSession)}/{label}-{uuid.uuid4().hex[:12]}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
