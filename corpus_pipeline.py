"""A corpus pipeline of five stages over ``documents``: language, near-duplicates, benchmark leaks, mixture, shards.

Each stage takes (spark, docs, sf_dir), works on all documents that its predecessor kept, and returns a DataFrame; its
result is written as Parquet and read back as the next one's input. All but the last return the columns of documents.

Every stage takes nulls in any column, empty and very long texts, repeated rows, empty tables (which give no rows) and
extra columns, also under the names that it adds itself: they are read no further and not returned.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sievelake.llm import language
from sievelake.llm.common import materialize
from sievelake.llm.decontaminate import decontaminate
from sievelake.llm.jaccard import keep_one_each
from sievelake.llm.mixing import mix_sources
from sievelake.llm.queries import SHARD_BYTES
from sievelake.llm.sharding import assign_shards

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: Below this score no language fits: 0.5 is the border of a one-versus-rest regression; clean texts of a few words lie
#: as low as 0.28.
LEAST_LANGUAGE_SCORE = 0.1


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a known language; those without letters, and those that fit no language, go.

    The languages are learned from the rows that have a text and a language; where none has, no language is known and all
    go. Null and empty texts go; repeated rows are judged alike; a null id, language or source changes nothing.
    """
    found = language.classify(docs.select(*COLUMNS), language.fit(docs))
    return found.where((found["lang_pred"] != language.UNKNOWN) & (found["score"] >= LEAST_LANGUAGE_SCORE)).select(*COLUMNS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document (the smallest id) of each group linked by a Jaccard similarity of 0.8 of five-word shingles.

    A null id comes last, ties go by a hash of the text; of rows that repeat id and text one stays; rows without words are
    linked with nothing and stay.
    """
    return keep_one_each(docs, width=5, percent=80).select(*COLUMNS)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item, even with edits of a tenth of its length.

    Rows with null or empty text stay; repeated rows are judged alike; null and empty items are in no document.
    """
    return decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")).select(*COLUMNS)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in the number of epochs that gives each source its target share of text (characters^0.8); none is lost.

    A null source is a source of its own; null and empty texts count one character; repeated rows keep their number.
    """
    return mix_sources(docs).select(*COLUMNS)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with the shard they belong to: at most 1 MiB of text, or one larger document.

    Null texts count nothing; null and repeated ids share a bucket, which overflow pages keep within the limit.
    """
    return assign_shards(docs, limit_bytes=SHARD_BYTES).select(*COLUMNS, "shard", "depth", "n_bytes", "shard_bytes", "shard_rows")


STAGES = [
    ("language_id", identify_language),
    ("jaccard_join", drop_near_duplicates),
    ("decontamination", drop_benchmark_leaks),
    ("mix_sources", mix),
    ("shards", shard),
]

#: Language identification is a trained model, which SQL can't express; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, one after the other, over the documents of ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
