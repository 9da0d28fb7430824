"""Canonical exact fingerprints of documents, in DataFrame and SQL functions only.

A text is brought to a canonical form (Unicode NFKC, full case folding, white space as one space) and digested to 192
bits by three chained xxHash64 and its length. Texts with one digest are then compared byte by byte: where a digest
stands for the canonical texts of several documents, all but the first carry their number, so documents with equal
fingerprints have equal texts. An edited text that is no document's is named by its digest alone.
"""

from __future__ import annotations

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize, text_size

RANGE_BYTES = 8 << 20
RANGES = 1 << 17


def canonical(text: Column) -> Column:
    """NFKC, case folded, NFKC again (folding can undo it), runs of white space as one space, trimmed; null is empty."""
    nfkc = lambda c: F.java_method(F.lit("com.ibm.icu.text.Normalizer"), F.lit("compose"), c, F.lit(True))
    fold = lambda c: F.java_method(F.lit("com.ibm.icu.lang.UCharacter"), F.lit("foldCase"), c, F.lit(True))
    return F.trim(F.regexp_replace(nfkc(fold(nfkc(F.coalesce(text, F.lit(""))))), r"(?U)\s+", " "))


def digest(canon: Column) -> Column:
    """Wide xxHash: three 64-bit hashes under different seeds, and the length, in hex."""
    wide = [F.lpad(F.lower(F.hex(F.xxhash64(F.lit(seed), canon))), 16, "0") for seed in (0, 1, 2)]
    return F.concat_ws("-", F.concat(*wide), F.lower(F.hex(F.octet_length(canon))))


def _numbers(digests: DataFrame, docs: DataFrame) -> DataFrame | None:
    """(digest, canon, number) of the texts that share a digest with a different one, number > 0; None if there are none.

    Only members of digests that occur more than once are compared, and each task sends one copy of a text.
    """
    twice = materialize(digests.groupBy("digest").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("digest"), "fp-twice")
    ids = materialize(digests.join(twice, "digest").select("doc_id").distinct(), "fp-ids")
    members = docs.join(ids, docs["doc_id"].eqNullSafe(ids["doc_id"]), "left_semi").select(canonical(F.col("text")).alias("canon"))
    members = members.withColumn("digest", digest(F.col("canon")))
    texts = members.groupBy("digest", "canon").agg(F.count(F.lit(1)).alias("n"))
    ranked = texts.withColumn("number", F.row_number().over(Window.partitionBy("digest").orderBy("canon")) - 1)
    clash = materialize(ranked.where("number > 0").select("digest", "canon", "number"), "fp-clash")
    return clash if clash.limit(1).count() else None


def fingerprints(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, fingerprint and group_id (the smallest id with the same canonical text) of every row.

    Null text is empty text; a null id is kept and is a group's id only if no other is known; repeated rows share their
    fingerprint; an empty table gives no rows; other columns are not read.
    """
    docs = df.select(F.col(key).alias("doc_id"), F.col(text).alias("text"))
    digests = materialize(docs.select("doc_id", canonical(F.col("text")).alias("canon")).select("doc_id", digest(F.col("canon")).alias("digest")), "fp-digests")
    clash = _numbers(digests, docs)
    if clash is None:
        named = digests.withColumnRenamed("digest", "fingerprint")
    else:
        full = docs.select("doc_id", canonical(F.col("text")).alias("canon")).withColumn("digest", digest(F.col("canon")))
        named = full.join(clash, ["digest", "canon"], "left").select("doc_id", _name(F.col("digest"), F.col("number")).alias("fingerprint"))
    groups = materialize(named.groupBy("fingerprint").agg(F.min("doc_id").alias("group_id")), "fp-groups")
    return named.join(groups, "fingerprint").select("doc_id", "fingerprint", "group_id")


def _name(value: Column, number: Column) -> Column:
    return F.when(F.coalesce(number, F.lit(0)) > 0, F.concat_ws("-", value, number.cast("string"))).otherwise(value)


def next_by_id(df: DataFrame, total_bytes: int) -> DataFrame:
    """(doc_id, text) rows with next_text: the text of the row that follows in descending id (after the last: the first).

    Ids are cut into ranges of about equal size, whose number grows with the data; one shuffle brings a range's texts
    together, and each range's highest rows are also sent to the range above it, whose last row they follow.
    """
    spark = df.sparkSession
    n = max(1, min(RANGES, total_bytes // RANGE_BYTES))
    ids = df.select(F.col("doc_id").cast("double").alias("x"), "doc_id").where("x is not null")
    ends = ids.repartitionByRange(n, "x").groupBy(F.spark_partition_id().alias("p")).agg(F.min("x").alias("low")).orderBy("low").collect()  # n rows
    lows = sorted({r["low"] for r in ends})
    docs = df.withColumn("_x", F.coalesce(F.col("doc_id").cast("double"), F.lit(float("-inf"))))
    cuts = [-float("inf"), *lows[1:], float("inf")]
    docs = Bucketizer(splits=cuts, inputCol="_x", outputCol="_range").transform(docs) if len(cuts) > 2 else docs.withColumn("_range", F.lit(0.0))
    docs = docs.withColumn("_range", F.col("_range").cast("int"))
    count = len(cuts) - 1
    tops = materialize(docs.groupBy("_range").agg(F.max("_x").alias("_top")), "fp-tops")  # count rows, at most RANGES
    docs = docs.join(F.broadcast(tops), "_range")
    to = F.when(F.col("_x") == F.col("_top"), F.array(F.col("_range") * 2, ((F.col("_range") + 1) % count) * 2 + 1)).otherwise(F.array(F.col("_range") * 2))
    sent = docs.select("doc_id", "text", "_x", F.explode(to).alias("_to"))
    sent = sent.select("doc_id", "text", "_x", F.shiftright("_to", 1).alias("_range"), (F.col("_to") % 2).alias("_guest"))
    order = Window.partitionBy("_range").orderBy("_guest", F.col("_x").desc(), F.col("doc_id").desc_nulls_last(), F.xxhash64("text"))
    return sent.withColumn("next_text", F.lead("text").over(order)).where("_guest = 0").select("doc_id", "text", "next_text")


def edited(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprints of every text and of its edited text, whose last third is the start of the next document.

    Returns doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited and near_next. An exact
    fingerprint is like another (1.0) if both canonical texts are equal byte by byte, else not (0.0).

    Null text is empty; null ids come last, after the smallest; rows of one id follow each other by a hash of their
    text; a single row follows itself; an empty table gives no rows; other columns are not read.
    """
    docs = df.select(F.col(key).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    total, _ = text_size(docs)
    rows = next_by_id(docs, total).withColumn("n_chars", F.char_length("text").cast("long")).withColumn("k", F.expr("int(n_chars div 3)"))
    rows = rows.withColumn("after", F.expr("concat(substring(text, 1, int(n_chars) - k), substring(next_text, 1, k))"))
    rows = rows.select("doc_id", "n_chars", F.sha2("after", 256).alias("edited_sha256"), canonical(F.col("text")).alias("c0"), canonical(F.col("after")).alias("c1"), canonical(F.col("next_text")).alias("c2"))
    # the digests are kept before they are used, so that the texts go no further
    rows = rows.select(
        "doc_id", "n_chars", "edited_sha256", digest(F.col("c0")).alias("d0"), digest(F.col("c1")).alias("d1"), F.col("c0").eqNullSafe(F.col("c1")).cast("double").alias("near_edited"),
        F.col("c0").eqNullSafe(F.col("c2")).cast("double").alias("near_next"),
    )
    rows = materialize(rows, "fp-edited")
    clash = _numbers(rows.select("doc_id", F.col("d0").alias("digest")), docs)
    if clash is None:
        return rows.withColumnsRenamed({"d0": "fingerprint", "d1": "edited_fingerprint"})
    # a digest that stands for several texts: the numbers are looked up by the text itself
    texts = next_by_id(docs, total).withColumn("n_chars", F.char_length("text").cast("long")).withColumn("k", F.expr("int(n_chars div 3)"))
    texts = texts.withColumn("after", F.expr("concat(substring(text, 1, int(n_chars) - k), substring(next_text, 1, k))"))
    texts = texts.select("doc_id", "n_chars", F.sha2("after", 256).alias("edited_sha256"), canonical(F.col("text")).alias("c0"), canonical(F.col("after")).alias("c1"), canonical(F.col("next_text")).alias("c2"))
    for i in (0, 1):
        known = clash.select(F.col("digest").alias(f"d{i}"), F.col("canon").alias(f"c{i}"), F.col("number").alias(f"k{i}"))
        texts = texts.withColumn(f"d{i}", digest(F.col(f"c{i}"))).join(known, [f"d{i}", f"c{i}"], "left")
    return texts.select(
        "doc_id", "n_chars", "edited_sha256", _name(F.col("d0"), F.col("k0")).alias("fingerprint"), _name(F.col("d1"), F.col("k1")).alias("edited_fingerprint"),
        F.col("c0").eqNullSafe(F.col("c1")).cast("double").alias("near_edited"), F.col("c0").eqNullSafe(F.col("c2")).cast("double").alias("near_next"),
    )
