"""Readers and writers with fixed schemas: keyed JSON, JSON Lines, source trees, feeds, numbered texts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.scans import Fold, ranges, running
from ..scratch import materialize

# Extensions of files that can hold source text.
SOURCE_EXTENSIONS = [".tex", ".sty", ".cls", ".def"]


def read_keyed_json(spark: SparkSession, path: str, value: str, key: str = "id") -> DataFrame:
    """A JSON object of records as one row per record: (key, the fields of ``value``, a DDL struct).

    Files of any size are read in byte ranges, cut at closing braces. Whether a brace stands in a string, and how deep it is,
    follows from the quotes and braces before it in its file, which are counted along the ranges; a record ends where one
    level is left. Only the pieces of one record meet. Keys without a record (null) are rows too; empty files have none.
    """
    pieces = spark.read.option("lineSep", "}").text(path).select("value", F.col("_metadata.file_path").alias("file"), F.struct(F.col("_metadata.file_block_start").alias("b"), F.monotonically_increasing_id().alias("i")).alias("at"))
    bare = F.regexp_replace("value", r"(?s)\\.", "")
    count = lambda c, x: F.char_length(c) - F.char_length(F.replace(c, F.lit(x), F.lit("")))
    quoted = ranges(pieces.withColumn("_quotes", count(bare, '"')), ["file"], ["at"])
    quoted = running(quoted, ["file"], ["at"], {"_before": Fold("sum", F.col("_quotes"), inclusive=False)})
    first = F.coalesce(F.col("_before") % 2, F.lit(0))
    # of the parts between quotes every second one is no string
    outside = F.array_join(F.filter(F.split(bare, '"'), lambda _, i: (i + first) % 2 == 0), "")
    closes = F.when((first + F.col("_quotes")) % 2 == 0, 1).otherwise(0)  # the brace after the piece
    steps = materialize(quoted.withColumns({"_close": closes, "_open": count(outside, "{")}).drop("_quotes", "_before"), "pieces")
    deep = running(steps, ["file"], ["at"], {"_depth": Fold("sum", F.col("_open") - F.col("_close"))})
    deep = materialize(deep.withColumn("_end", F.when((F.col("_close") == 1) & (F.col("_depth") == 1), 1).otherwise(0)), "pieces")
    numbered = running(deep, ["file"], ["at"], {"_record": Fold("sum", F.col("_end"), inclusive=False)})
    records = numbered.groupBy("file", F.coalesce("_record", F.lit(0)).alias("_n")).agg(F.max("_end").alias("_whole"), F.array_sort(F.collect_list(F.struct("at", "value"))).alias("_p"))
    texts = F.transform("_p", lambda p: p["value"])
    # after the last record only keys without one, up to the object's own brace
    inner = F.when(F.col("_whole") == 1, F.concat(F.array_join(texts, "}"), F.lit("}"))).otherwise(F.get(texts, F.lit(0)))
    inner = F.regexp_replace(F.when(F.col("_n") == 0, F.regexp_replace(inner, r"^\s*\{", "")).otherwise(inner), r"^\s*,", "")
    found = records.select(inner.alias("v")).where(F.trim(F.regexp_replace("v", r"\s+", " ")) != "")
    return found.select(F.explode(F.from_json(F.concat(F.lit("{"), "v", F.lit("}")), f"map<string,{value}>")).alias(key, "_v")).select(key, "_v.*")


def read_jsonl(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """JSON Lines; blank lines, and lines that are cut short, are left out."""
    return spark.read.schema(schema).option("mode", "DROPMALFORMED").json(path)


def count_malformed(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """(good, malformed) lines of JSON Lines."""
    rows = spark.read.text(path).where(F.trim("value") != "").select(F.from_json("value", f"{schema}, _bad string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"}).alias("v"))
    return rows.agg(F.count_if(F.col("v._bad").isNull()).alias("good"), F.count_if(F.col("v._bad").isNotNull()).alias("malformed"))


def read_source_tree(spark: SparkSession, root: str, depth_pattern: str = r"/([^/]+)/[^/]+$", extensions: list[str] | None = None) -> DataFrame:
    """(paper_id, path, ext, text) of the source files (of these extensions) below ``root``; undecodable bytes are replaced."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
    ext = F.lower(F.regexp_extract("path", r"(\.[A-Za-z]+)$", 1))
    kept = files.withColumn("ext", ext).where(F.col("ext").isin(extensions or SOURCE_EXTENSIONS))
    return kept.select(F.regexp_extract("path", depth_pattern, 1).alias("paper_id"), "path", "ext", F.make_valid_utf8(F.col("content").cast("string")).alias("text"))


def read_feed(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Entries of saved Atom feeds, one response per line."""
    lines = spark.read.text(path).where(F.trim("value") != "")
    return lines.select(F.explode(F.from_xml("value", f"entry array<struct<{schema}>>")["entry"]).alias("e")).select("e.*")


def write_csv(df: DataFrame, path: str, lists: list[str] | None = None) -> None:
    """CSV with a header; the named arrays are exploded together first."""
    for name in lists or []:
        df = df.withColumn(name, F.explode_outer(name))
    df.write.option("header", True).csv(path)


def write_by_tier(df: DataFrame, path: str, tier: str, tiers: list[str]) -> None:
    """Only rows of the chosen tiers."""
    df.where(F.col(tier).isin(tiers)).write.parquet(path)


def numbered_names(df: DataFrame, number: str, prefix: str = "f", suffix: str = ".txt") -> DataFrame:
    """Adds file: ``f00001.txt`` from a row number."""
    return df.withColumn("file", F.format_string(f"{prefix}%05d{suffix}", F.col(number)))
