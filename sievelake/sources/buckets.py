"""Tables kept in buckets by key: a change writes the buckets it touches anew, and readers see a change whole or not at all."""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

VERSIONS = "number long, bucket int, path string"


class BucketStore:
    """A table of unique keys in ``buckets`` buckets below ``path``.

    Each change is one folder of Parquet files and one line per bucket in the log of versions, which is written last. A change
    that is repeated after a failure gives the same table; folders without a line are not read. A store must be opened with
    the number of buckets it was made with.
    """

    def __init__(self, spark: SparkSession, path: str, schema: str, keys: list[str], buckets: int = 64):
        self.spark, self.path, self.schema, self.keys, self.buckets = spark, path, schema, keys, buckets

    def bucket(self):
        """The bucket of a row."""
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")

    def versions(self) -> dict[int, tuple[int, str]]:
        """Number and folder of the last version of each bucket (at most ``buckets``)."""
        try:
            named = self.spark.read.schema(VERSIONS).json(f"{self.path}/versions")
            last = named.groupBy("bucket").agg(F.max(F.struct("number", "path")).alias("v")).collect()
        except AnalysisException:  # nothing was written yet
            return {}
        return {r["bucket"]: (r["v"]["number"], r["v"]["path"]) for r in last}

    def read(self, only: list[int] | None = None) -> DataFrame:
        """The table, or some of its buckets."""
        paths = [path for b, (_, path) in sorted(self.versions().items()) if only is None or b in only]
        return self.spark.read.schema(self.schema).parquet(*paths) if paths else self.spark.createDataFrame([], self.schema)

    def change(self, changed: DataFrame, dropped: DataFrame | None = None) -> list[int]:
        """Put rows in place of those with their keys, and take out the keys of ``dropped``; returns the buckets written.

        ``changed`` is read twice and should be a written table; so should ``dropped``.
        """
        names = [c.name for c in self.spark.createDataFrame([], self.schema).schema]
        keys = changed.select(*self.keys)
        if dropped is not None:
            keys = keys.unionByName(dropped.select(*self.keys))
        touched = sorted(r["_b"] for r in keys.select(self.bucket().alias("_b")).distinct().collect())
        if not touched:
            return []
        before = self.versions()
        kept = self.read(touched).join(keys, self.keys, "left_anti")
        number = 1 + max((n for n, _ in before.values()), default=0)
        path = f"{self.path}/change={number:09d}-{uuid.uuid4().hex}"
        rows = kept.select(*names).unionByName(changed.select(*names)).withColumn("_bucket", self.bucket())
        rows.repartition("_bucket").write.partitionBy("_bucket").parquet(path)
        written = {r["_b"] for r in self.spark.read.parquet(path).select(F.col("_bucket").alias("_b")).distinct().collect()} if self._any(path) else set()
        for b in set(touched) - written:  # a bucket that lost its last row
            self.spark.createDataFrame([], self.schema).coalesce(1).write.parquet(f"{path}/_bucket={b}")
        lines = [(number, b, f"{path}/_bucket={b}") for b in touched]
        self.spark.createDataFrame(lines, VERSIONS).coalesce(1).write.mode("append").json(f"{self.path}/versions")
        return touched

    def _any(self, path: str) -> bool:
        try:
            self.spark.read.parquet(path)
            return True
        except AnalysisException:  # no row at all was left
            return False
