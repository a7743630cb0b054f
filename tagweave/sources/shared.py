"""The folder that driver and executors share, for tables that cut lineage."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def folder(spark: SparkSession) -> str:
    """spark.checkpoint.dir; where it is unset and Spark is local, a folder of our own for this process."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir isn't set: no folder is known that driver and executors share")
        own = tempfile.mkdtemp(prefix="tagweave-")
        atexit.register(shutil.rmtree, own, ignore_errors=True)
        spark.conf.set("spark.checkpoint.dir", found := f"file://{own}")
    return found.rstrip("/")


def written(df: DataFrame) -> DataFrame:
    """``df`` as a table in the shared folder: worked out once, whatever reads it and whoever is lost."""
    path = f"{folder(df.sparkSession)}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
