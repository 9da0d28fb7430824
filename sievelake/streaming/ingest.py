"""Incremental ingestion of an append-only answer log with Structured Streaming."""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.answers import latest_answer

BUCKETS = 64


def ingest(spark: SparkSession, source: str, schema: str, state: str, checkpoint: str, keys: list[str], seq: str, ok: Column, form: str = "json", buckets: int = BUCKETS) -> DataFrame:
    """Take in the files that are new since the last call; returns the answer that counts per key, over all files so far.

    Each micro-batch is reduced to one row per key and merged with the stored state. The state is kept in ``buckets``
    buckets by key, and only those that a batch touches are read and written anew. A bucket's new version is complete when
    its name is recorded, so a batch that is repeated after a failure gives the same state. The result equals
    ``latest_answer`` over all files at once: the last successful row, else the first failed one.

    Lines that are cut short or no JSON are left out. A state must be read with the number of buckets it was made with.
    """
    stream = spark.readStream.schema(schema).option("mode", "DROPMALFORMED").format(form).load(source)
    bucket = F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")

    def merge(batch: DataFrame, number: int) -> None:
        fresh = f"{state}/batch={number:09d}-{uuid.uuid4().hex}"
        latest_answer(batch, keys, seq, ok).withColumn("_bucket", bucket).write.partitionBy("_bucket").parquet(fresh)
        rows = _read(spark, [fresh], stream.schema)
        touched = [r["_bucket"] for r in rows.select("_bucket").distinct().collect()]  # at most ``buckets``
        if not touched:
            return
        paths = _paths(spark, state)
        known = [paths[b] for b in touched if b in paths]
        if known:
            rows = rows.unionByName(_read(spark, known, stream.schema))
        path = f"{state}/version={number:09d}-{uuid.uuid4().hex}"
        latest_answer(rows.drop("_bucket"), keys, seq, ok).withColumn("_bucket", bucket).write.partitionBy("_bucket").parquet(path)
        named = [(number, b, f"{path}/_bucket={b}") for b in touched]
        spark.createDataFrame(named, "number long, bucket int, path string").coalesce(1).write.mode("append").json(f"{state}/versions")

    query = stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return _read(spark, list(_paths(spark, state).values()), stream.schema).drop("_bucket")


def _paths(spark: SparkSession, state: str) -> dict[int, str]:
    """The last recorded version of each bucket."""
    try:
        named = spark.read.schema("number long, bucket int, path string").json(f"{state}/versions")
        return {r["bucket"]: r["path"] for r in named.groupBy("bucket").agg(F.max_by("path", F.struct("number", "path")).alias("path")).collect()}
    except AnalysisException:  # no batch yet
        return {}


def _read(spark: SparkSession, paths: list[str], schema) -> DataFrame:
    """Rows of bucket or batch folders, with their bucket where the folder's name doesn't tell it (null)."""
    if not paths:
        return spark.createDataFrame([], schema).withColumn("_bucket", F.lit(None).cast("int"))
    found = spark.read.schema(schema).parquet(*paths) if "_bucket=" in paths[0] else spark.read.parquet(*paths)
    return found if "_bucket" in found.columns else found.withColumn("_bucket", F.lit(None).cast("int"))
