"""Selection: duplicates, capped and stratified choices, samples, examples. All orders are explicit, all choices seeded."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..scratch import materialize


def seeded(seed: str, *keys: str) -> Column:
    """A pseudo-random order that depends on the seed and the keys only (MD5 of ``seed:key:key``)."""
    return F.md5(F.concat_ws(":", F.lit(seed), *(F.col(k).cast("string") for k in keys)).cast("binary"))


def mark_duplicates(df: DataFrame, text: str, id: str, pos: str, ok: Column | None = None) -> DataFrame:
    """Adds duplicate_of: the id of the first row (by ``pos``) with the same text; null for it, and for rows that aren't ok.

    The texts are replaced by a 128-bit digest before the shuffle; the first row is found by a partial aggregate, so a
    text that many rows hold doesn't meet in one task.
    """
    ok = F.lit(True) if ok is None else ok
    keyed = df.withColumn("_key", F.when(ok & F.col(text).isNotNull(), F.md5(F.col(text).cast("binary"))))
    first = keyed.where("_key is not null").groupBy("_key").agg(F.min_by(id, F.struct(pos, id)).alias("_first"))
    joined = keyed.join(first, "_key", "left")
    return joined.withColumn("duplicate_of", F.when(F.col("_first") != F.col(id), F.col("_first"))).drop("_key", "_first")


def cap_per_group(df: DataFrame, group: str, source: str, id: str, most: int, seed: str = "0") -> DataFrame:
    """Adds selection: kept for at most ``most`` rows of a group, one from each source in turn; template_cap for the others.

    Sources and the rows of a source come in a seeded order; 0 keeps all. A first cut within (group, source) leaves at
    most ``most`` rows of each source, so a large group is thinned out before it meets.
    """
    if not most:
        return df.withColumn("selection", F.lit("kept"))
    row = F.row_number().over(Window.partitionBy(group, source).orderBy(seeded(seed, id), id))
    turn = df.select(group, source, id, row.alias("_turn")).where(F.col("_turn") <= most)
    slot = F.row_number().over(Window.partitionBy(group).orderBy("_turn", seeded(seed, source), source, id))
    kept = turn.select(F.col(id).alias("_kept"), slot.alias("_slot")).where(F.col("_slot") <= most)
    return df.join(kept, df[id] == kept["_kept"], "left").withColumn("selection", F.when(F.col("_kept").isNotNull(), "kept").otherwise("template_cap")).drop("_kept", "_slot")


def stable_sample(df: DataFrame, id: str, n: int, seed: str = "0") -> DataFrame:
    """``n`` rows by a seeded order: a larger sample holds a smaller one."""
    return df.orderBy(seeded(seed, id), id).limit(n)


def quota_sample(df: DataFrame, id: str, classes: list[tuple[str, Column, int]], total: int, seed: str = "0") -> DataFrame:
    """A quota of rows of each class (a row belongs to the first that fits), the rest up to ``total`` from all others."""
    name = F.coalesce(*(F.when(fits, F.lit(c)) for c, fits, _ in classes), F.lit("rest"))
    named, order = df.withColumn("class", name), (seeded(seed, id), F.col(id))
    chosen = None
    for c, _, quota in classes:  # a limit of each class: every task gives its first rows only
        part = named.where(F.col("class") == c).orderBy(*order).limit(quota)
        chosen = part if chosen is None else chosen.unionByName(part)
    left = total - sum(q for _, _, q in classes)
    rest = df.join(chosen.select(id), id, "left_anti").orderBy(*order).limit(max(left, 0)).withColumn("class", F.lit("rest"))
    return chosen.unionByName(rest)


def first_n(df: DataFrame, group: list[str], order: list[Column | str], n: int) -> DataFrame:
    """The first ``n`` rows of each group."""
    rank = F.row_number().over(Window.partitionBy(*group).orderBy(*order))
    return df.withColumn("_rank", rank).where(F.col("_rank") <= n).drop("_rank")


def first_n_of_frequent(df: DataFrame, group: str, order: list[str], n: int) -> DataFrame:
    """First ``n`` rows of each group with the group's size, as times."""
    sizes = df.groupBy(group).agg(F.count(F.lit(1)).alias("times"))
    return first_n(df, [group], order, n).join(sizes, group)


def best_example(df: DataFrame, group: str, tests: list[Column], text: str, pos: str, least: int = 15) -> DataFrame:
    """Per group the row that fails the fewest tests, is long enough, then shortest, then first."""
    failed = sum((F.when(t, 0).otherwise(1) for t in tests), F.lit(0))
    order = F.struct(failed.alias("f"), (F.length(text) < least).alias("s"), F.length(text).alias("l"), F.col(pos).alias("p"))
    return df.groupBy(group).agg(F.min_by(F.struct(*(F.col(c) for c in df.columns if c != group)), order).alias("_row")).select(group, "_row.*")


def diverse_examples(df: DataFrame, rule: str, kind: str, source: str, pos: str, n: int = 3) -> DataFrame:
    """Up to ``n`` rows per rule, each of another source: the first of each of its kinds, the largest kinds first, then of all its rows.

    A kind all of whose sources are taken is passed over. As at most n sources are taken, the first n sources of a kind, and
    the first 2 n of a rule, are all that can be chosen from. Adds kind_size and choice, the place in the rule's list.
    """
    sizes = df.groupBy(rule, kind).agg(F.count(F.lit(1)).alias("kind_size"), F.min(pos).alias("_first"))
    each = first_n(df, [rule, kind, source], [pos], 1)
    same = [each[c].eqNullSafe(sizes[c]) for c in (rule, kind)]
    each = each.join(sizes, same[0] & same[1]).select(*(each[c] for c in df.columns), "kind_size", "_first").withColumn("_order", F.struct(-F.col("kind_size"), "_first"))
    pools = [materialize(first_n(each, [rule, kind], [pos], n), "examples"), materialize(first_n(first_n(each, [rule, source], [pos], 1), [rule], [pos], 2 * n), "examples")]
    names = [*df.columns, "kind_size"]
    taken = pools[0].select(rule).distinct().select(F.col(rule).alias("_rule"), F.array().cast(df.select(F.array(source)).schema[0].dataType).alias("_used"), F.lit(None).cast(each.schema["_order"].dataType).alias("_last"))
    out = None
    for kinds, pool in ((True, pools[0]), (False, pools[1])):
        for _ in range(n):
            open_ = pool.join(taken, pool[rule].eqNullSafe(F.col("_rule"))).where((F.size("_used") < n) & ~F.coalesce(F.array_contains("_used", F.col(source)), F.lit(False)))
            if kinds:
                open_ = open_.where(F.col("_last").isNull() | (F.col("_order") > F.col("_last")))
            best = open_.groupBy(rule).agg(F.min_by(F.struct(*names, "_order", F.size("_used").alias("_n")), F.struct("_order", pos) if kinds else F.col(pos)).alias("_row"))
            best = materialize(best.select("_row.*"), "examples")
            choice = best.select(*names, (F.col("_n") + 1).alias("choice"))
            out = choice if out is None else out.unionByName(choice)
            new = best.select(F.col(rule).alias("_r"), F.col(source).alias("_s"), F.col("_order").alias("_o"))
            both = taken.join(new, F.col("_rule").eqNullSafe(F.col("_r")), "left")
            grown = F.when(F.col("_o").isNotNull(), F.array_append("_used", F.col("_s"))).otherwise(F.col("_used"))
            taken = materialize(both.select("_rule", grown.alias("_used"), F.coalesce("_o", "_last").alias("_last")), "examples")
    return out


def number_rows(df: DataFrame, group: list[str], order: list[str], name: str = "number") -> DataFrame:
    """Rows numbered from 1 within a group, whatever its size: a group is cut into ranges of its order.

    Ranges are numbered by their own rows and by how many rows of the group the ranges before hold. Ties of ``order`` are
    numbered in any order, so it should end in a unique key.
    """
    ranged = materialize(df.repartitionByRange(*group, *order).withColumn("_p", F.spark_partition_id()), "ranges")
    counts = ranged.groupBy(*(F.col(g).alias(f"_g{i}") for i, g in enumerate(group)), "_p").agg(F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(Window.partitionBy(*(f"_g{i}" for i in range(len(group)))).orderBy("_p").rowsBetween(Window.unboundedPreceding, -1))
    counts = counts.withColumn("_before", F.coalesce(before, F.lit(0))).where("_before > 0").withColumnRenamed("_p", "_q")  # a group within one range has none before
    rank = F.row_number().over(Window.partitionBy(*group, "_p").orderBy(*order))
    same = F.col("_p") == F.col("_q")
    for i, g in enumerate(group):
        same = same & F.col(g).eqNullSafe(F.col(f"_g{i}"))
    placed = ranged.withColumn("_rank", rank).join(counts, same, "left")
    return placed.withColumn(name, (F.col("_rank") + F.coalesce("_before", F.lit(0))).cast("long")).select(*df.columns, name)


def number_all(df: DataFrame, order: str, name: str = "number") -> DataFrame:
    """All rows numbered from 1 by a unique key, without bringing them together: range offsets plus rank in the range."""
    ranged = df.repartitionByRange(F.col(order)).withColumn("_p", F.spark_partition_id())
    ranged = materialize(ranged, "numbered")
    counts = ranged.groupBy("_p").agg(F.count(F.lit(1)).alias("_n"))
    before = counts.select("_p", F.coalesce(F.sum("_n").over(Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    rank = F.row_number().over(Window.partitionBy("_p").orderBy(order))
    return ranged.withColumn("_rank", rank).join(F.broadcast(before), "_p").withColumn(name, (F.col("_before") + F.col("_rank")).cast("long")).drop("_p", "_rank", "_before")


def split_of(key: Column, parts: list[tuple[str, int]]) -> Column:
    """Leak-safe split: rows with one key go to one part, in the given percentages."""
    place = F.conv(F.substring(F.md5(key.cast("binary")), 1, 8), 16, 10).cast("long") % 100
    at, out = 0, None
    for name, share in parts:
        at += share
        out = F.when(place < at, name) if out is None else out.when(place < at, name)
    return out
