"""Scratch tables: results that are used more than once, or that end a loop's round, are written where all executors see them."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def scratch_dir(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir; a temporary one where the session names none (as in tests)."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    made = spark.conf.get("sievelake.scratch.dir", None)
    if not made:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        made = tempfile.mkdtemp(prefix="spark-scratch-", dir="/tmp")
        spark.conf.set("sievelake.scratch.dir", made)
    return made


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path that nothing else uses."""
    return f"{scratch_dir(spark)}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str, **options) -> DataFrame:
    """Write ``df`` to a scratch table and read it back: the result no longer depends on what made it."""
    path = scratch_path(df.sparkSession, name)
    df.write.options(compression="zstd", **options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
