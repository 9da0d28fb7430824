"""Sharding by extendible hashing, in DataFrame operations only.

A directory is indexed by the leading bits of a 60-bit key hash. A bucket that exceeds the byte limit is split on one
more bit, others stay as they are, until every bucket fits. The bits are counted once in cells well below a shard's
size, and every bucket's size at every depth is a sum of cells, so no pass over the rows is needed per split.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize

HASH_BITS = 60
BROADCAST_BITS = 15


def key_hash(key: Column) -> Column:
    """First 60 bits of the MD5 of the key as text; null counts as empty text."""
    return F.conv(F.substring(F.md5(F.coalesce(key.cast("string"), F.lit("")).cast("binary")), 1, 15), 16, 10).cast("long")


def _prefix(h: Column, depth: int) -> Column:
    return F.shiftright(h, HASH_BITS - depth)


def _fits(limit: int) -> Column:
    return (F.col("bytes") <= limit) | (F.col("n") <= 1)


def _leaves(cells: DataFrame, top: int, depth: int, limit: int) -> DataFrame:
    """Buckets that are not split: they fit (or are at ``depth``), and their parent does not.

    cells: (cell, bytes, n) at ``depth``; ``top``: the depth whose buckets are known not to fit (-1: none).
    """
    levels = F.explode(F.sequence(F.lit(top + 1), F.lit(depth)))
    sums = (
        cells.select("cell", "bytes", "n", levels.alias("depth"))
        .groupBy("depth", F.expr(f"shiftright(cell, {depth} - depth)").alias("prefix"))
        .agg(F.sum("bytes").alias("bytes"), F.sum("n").alias("n"))
    )
    sums = materialize(sums, "shard-sums")
    parents = sums.where(~_fits(limit)).select((F.col("depth") + 1).alias("depth"), F.col("prefix").alias("parent"))
    below = sums.withColumn("parent", F.shiftright("prefix", 1)).join(parents, ["depth", "parent"], "left_semi")
    first = sums.where(F.col("depth") == top + 1).withColumn("parent", F.shiftright("prefix", 1))
    return first.unionByName(below).where(_fits(limit) | (F.col("depth") == depth)).select("depth", "prefix", "bytes", "n")


def _count(rows: DataFrame, depth: int) -> DataFrame:
    return rows.groupBy(_prefix(F.col("_h"), depth).alias("cell")).agg(F.sum("_bytes").alias("bytes"), F.count(F.lit(1)).alias("n"))


def _lookup(rows: DataFrame, leaves: DataFrame, depth: int) -> DataFrame:
    """Rows with their leaf, through the directory of 2^depth entries; broadcast only if that is at most 2^15."""
    span = F.expr(f"sequence(shiftleft(prefix, {depth} - depth), shiftleft(prefix + 1, {depth} - depth) - 1)")
    slots = leaves.select(F.explode(span).alias("_slot"), "depth", "prefix", F.col("bytes").alias("shard_bytes"), F.col("n").alias("shard_rows"))
    slots = F.broadcast(slots) if depth <= BROADCAST_BITS else slots
    return rows.withColumn("_slot", _prefix(F.col("_h"), depth)).join(slots, "_slot", "left").drop("_slot")


def _pages(rows: DataFrame, limit: int) -> DataFrame:
    """Rows of one equal hash that exceed a shard go to consecutive overflow pages by an exact running sum.

    The sum has two levels, by the partition that holds a row and within it, so no group meets in one task.
    """
    rows = materialize(rows.withColumn("_id", F.monotonically_increasing_id()).withColumn("_p", F.spark_partition_id()), "shard-overflow")
    each = rows.groupBy("_h", "_p").agg(F.sum("_bytes").alias("_sum"), F.count(F.lit(1)).alias("_n"), F.max("_bytes").alias("_top"))
    before = Window.partitionBy("_h").orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    each = each.select(
        "_h", "_p", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_start"), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_rank"),
        F.max("_top").over(Window.partitionBy("_h")).alias("_most"),
    )
    within = Window.partitionBy("_h", "_p").orderBy("_id").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("_run", F.coalesce(F.sum("_bytes").over(within), F.lit(0))).withColumn("_row", F.coalesce(F.count(F.lit(1)).over(within), F.lit(0)))
    rows = rows.join(materialize(each, "shard-offsets"), ["_h", "_p"])
    room = F.greatest(F.lit(limit) - F.col("_most"), F.lit(1))
    page = F.when(F.col("_most") * 2 > limit, F.col("_rank") + F.col("_row")).otherwise(F.floor((F.col("_start") + F.col("_run")) / room))
    rows = rows.withColumn("_page", page.cast("long"))
    sizes = rows.groupBy("_h", "_page").agg(F.sum("_bytes").alias("shard_bytes"), F.count(F.lit(1)).alias("shard_rows"))
    return rows.drop("shard_bytes", "shard_rows", "_start", "_rank", "_most", "_run", "_row", "_id", "_p").join(sizes, ["_h", "_page"])


def assign_shards(df: DataFrame, key: str = "doc_id", text: str = "text", limit_bytes: int = 128 << 20) -> DataFrame:
    """All rows and columns of ``df`` with shard, depth, shard_bytes, shard_rows and n_bytes.

    ``shard`` is the bucket's hash prefix in binary digits, with ``/page`` for a page of equal hashes beyond the limit.
    Every shard holds at most ``limit_bytes`` of UTF-8 text, or one row that is larger by itself.

    Null text counts 0 bytes; a null key hashes as empty text; repeated rows and equal keys share a bucket, and are
    dealt to overflow pages if they exceed it; an empty table gives no rows; input columns named as one of the outputs
    are replaced.
    """
    made = ["shard", "depth", "shard_bytes", "shard_rows", "n_bytes"]
    rows = df.withColumns({"_h": key_hash(F.col(key)), "_bytes": F.coalesce(F.octet_length(text), F.lit(0)).cast("long")}).drop(*made)
    total = rows.agg(F.coalesce(F.sum("_bytes"), F.lit(0))).first()[0]
    depth = min(HASH_BITS, max(0, -(-total // limit_bytes) - 1).bit_length() + 6)
    leaves = materialize(_leaves(_count(rows, depth), -1, depth, limit_bytes), "shard-leaves")
    top = leaves.agg(F.max("depth")).first()[0] or 0
    found = _lookup(rows, leaves, top)
    done = found.withColumn("_page", F.lit(None).cast("long"))
    if leaves.where(~_fits(limit_bytes)).limit(1).count():  # a few hashes hold more than a shard: split them on all bits
        plain = (F.col("shard_bytes") <= limit_bytes) | (F.col("shard_rows") <= 1)
        rest = found.where(~plain).drop("depth", "prefix", "shard_bytes", "shard_rows")
        deep = materialize(_leaves(_count(rest, HASH_BITS), depth, HASH_BITS, limit_bytes), "shard-deep") if depth < HASH_BITS else leaves
        levels = [r["depth"] for r in deep.select("depth").distinct().collect()]  # at most 60
        parts = [rest.withColumn("prefix", _prefix(F.col("_h"), d)).join(deep.where(F.col("depth") == d).withColumnsRenamed({"bytes": "shard_bytes", "n": "shard_rows"}), "prefix") for d in levels]
        split = parts[0]
        for part in parts[1:]:
            split = split.unionByName(part)
        equal = split.where(~plain)
        done = done.where(plain).unionByName(split.where(plain).withColumn("_page", F.lit(None).cast("long"))).unionByName(_pages(equal, limit_bytes))
    bits = F.when(F.col("depth") == 0, F.lit("")).otherwise(F.lpad(F.conv(F.col("prefix").cast("string"), 10, 2), F.col("depth"), F.lit("0")))
    name = F.concat(bits, F.coalesce(F.concat(F.lit("/"), F.col("_page").cast("string")), F.lit("")))
    return done.withColumns({"shard": name, "depth": F.col("depth").cast("long"), "n_bytes": F.col("_bytes")}).drop("_h", "_bytes", "_page", "prefix")


def write_shards(df: DataFrame, path: str, **options) -> None:
    """Write the documents, one folder per shard, rows of a shard in one file."""
    placed = assign_shards(df, **options)
    placed.repartition("shard").write.partitionBy("shard").parquet(path)
