"""Extracted records and the final sets: exclusion, duplicates, linking, splitting, writing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .select import number_rows


def exclusion_reason(*tests: tuple[Column, Column | str]) -> Column:
    """The reason of the first test that holds, else null."""
    return F.coalesce(*(F.when(F.coalesce(t, F.lit(False)), r if isinstance(r, Column) else F.lit(r)) for t, r in tests))


def dedupe_records(df: DataFrame, keys: list[str], id: str, order: list[str]) -> DataFrame:
    """Adds same_as: the id of the first row with the same keys; null for the first."""
    first = df.groupBy(*(F.col(k).alias(f"_{k}") for k in keys)).agg(F.min_by(id, F.struct(*order)).alias("_first"))
    condition = F.lit(True)
    for k in keys:
        condition = condition & F.col(k).eqNullSafe(F.col(f"_{k}"))
    joined = df.join(first, condition, "left").drop(*(f"_{k}" for k in keys))
    return joined.withColumn("same_as", F.when(F.col("_first") != F.col(id), F.col("_first"))).drop("_first")


def collect_locations(df: DataFrame, keys: list[str], order: list[str], location: Column) -> DataFrame:
    """Per key the first row, with the locations of the later ones, in order, as also_at."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    ranked = df.withColumns({"_rank": rank, "_loc": location})
    later = ranked.where("_rank > 1").groupBy(*keys).agg(F.transform(F.array_sort(F.collect_list(F.struct("_rank", "_loc"))), lambda x: x["_loc"]).alias("also_at"))
    return ranked.where("_rank = 1").drop("_rank", "_loc").join(later, keys, "left").withColumn("also_at", F.coalesce("also_at", F.array()))


def ordered_union(df: DataFrame, group: str, values: str, place: str) -> DataFrame:
    """(group, values): distinct elements of a group's arrays, by the first row (by ``place``) and position that hold them."""
    each = df.select(group, F.col(place).alias("_place"), F.posexplode(values).alias("_i", "_v")).where("_v is not null")
    first = each.groupBy(group, "_v").agg(F.min(F.struct("_place", "_i")).alias("_at"))
    return first.groupBy(group).agg(F.transform(F.array_sort(F.collect_list(F.struct("_at", "_v"))), lambda x: x["_v"]).alias(values))


def merged_lookups(df: DataFrame, group: str, lookups: str, place: str, none: str = "no_answer") -> DataFrame:
    """(group, lookups): per service the answer of the first row (by ``place``) that has one; ``none`` only where no row has."""
    each = df.select(group, F.col(place).alias("_place"), F.explode(lookups).alias("_service", "_status"))
    best = each.groupBy(group, "_service").agg(F.min_by("_status", F.struct((F.col("_status") == none), "_place")).alias("_status"))
    return best.groupBy(group).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("_service", "_status")))).alias(lookups))


def drop_if_paired(unpaired: DataFrame, paired: DataFrame, keys: list[str], id: str, pos: str) -> DataFrame:
    """Adds reason: names the last paired record with the same keys; null where there is none."""
    last = paired.groupBy(*keys).agg(F.max_by(id, F.struct(pos, id)).alias("_paired"))
    return unpaired.join(last, keys, "left").withColumn("reason", F.concat(F.lit("paired as "), F.col("_paired").cast("string"))).drop("_paired")


def pair_rows(df: DataFrame, id: str, arrays: list[str]) -> DataFrame:
    """One row per position of aligned arrays, with id ``<record>:D<n>``."""
    return df.select(*(c for c in df.columns if c not in arrays and c != id), F.col(id).alias("_id"), F.posexplode(F.arrays_zip(*arrays)).alias("_n", "_z")).select(
        F.concat(F.col("_id").cast("string"), F.lit(":D"), (F.col("_n") + 1).cast("string")).alias(id), *(c for c in df.columns if c not in arrays and c != id), *(F.col(f"_z.{a}").alias(a) for a in arrays)
    )


def numbered_pairs(df: DataFrame, id: str, order: str) -> DataFrame:
    """Rows of a record as its pairs, with id ``<record>:D<n>`` in the given order; no record is collected."""
    numbered = number_rows(df, [id], [order], "_n")
    return numbered.withColumn(id, F.concat(F.col(id).cast("string"), F.lit(":D"), F.col("_n").cast("string"))).drop("_n")


def attach_rows_by_position(rows: DataFrame, answers: DataFrame, group: str, order: str, answer_order: str, judgment: str) -> DataFrame:
    """The n-th row of a group gets its n-th judgment in the judgments' own order, null where there is none: no group is collected."""
    numbered, given = number_rows(rows, [group], [order], "_n"), number_rows(answers.select(group, answer_order, judgment), [group], [answer_order], "_n")
    return numbered.join(given.select(group, "_n", judgment), [group, "_n"], "left").drop("_n")


def augmented_pairs(df: DataFrame, id: str, text: str, rewritten: str) -> DataFrame:
    """A row ``<id>:A<n>`` per rewriting; one equal to the original or to an earlier one is left out but keeps its number."""
    return _augmented(df.select(F.col(id).alias("augmented_from"), F.col(text).alias("original"), F.posexplode(rewritten).alias("_n", "text")).withColumn("_n", F.col("_n") + 1))


def augmented_rows(df: DataFrame, id: str, order: str, text: str) -> DataFrame:
    """The same for rows: the first row of an id is the original, the later ones are its rewritings; no group is collected."""
    rows = number_rows(df.select(id, order, text), [id], [order], "_n")
    first = rows.where("_n = 1").select(F.col(id).alias("augmented_from"), F.col(text).alias("original"))
    later = rows.where("_n > 1").select(F.col(id).alias("augmented_from"), F.col(text).alias("text"), (F.col("_n") - 1).alias("_n"))
    return _augmented(later.join(first, "augmented_from"))


def _augmented(each: DataFrame) -> DataFrame:
    each = each.where("text != original").withColumn("_key", F.md5(F.col("text").cast("binary")))
    first = each.groupBy("augmented_from", "_key").agg(F.min_by("text", "_n").alias("text"), F.min("_n").alias("_n"))
    return first.select(F.concat(F.col("augmented_from").cast("string"), F.lit(":A"), F.col("_n").cast("string")).alias("id"), "augmented_from", "text")


def described_rows(formulas: DataFrame, pairs: DataFrame, manifest: DataFrame) -> DataFrame:
    """A row per description of a formula, linked to the record whose file it was read from, if that holds the same text.

    ``formulas``: formula, number, path, text; ``pairs``: formula, realization, nl; ``manifest``: file, record, text. Files are
    compared by name, texts without white space at the ends. Formulas without a description have one row, with null in nl.
    """
    name = F.regexp_extract(F.coalesce("path", F.lit("")), r"([^/]*)$", 1)
    known = manifest.where("file != ''").select(F.regexp_extract("file", r"([^/]*)$", 1).alias("_file"), "record", F.trim(F.regexp_replace("text", r"^\s+|\s+$", "")).alias("_known"))
    same = (F.col("_name") == F.col("_file")) & (F.md5(F.col("_text").cast("binary")) == F.md5(F.col("_known").cast("binary"))) & (F.col("_text") == F.col("_known"))
    linked = formulas.withColumns({"_name": name, "_text": F.regexp_replace(F.coalesce("text", F.lit("")), r"^\s+|\s+$", "")}).join(known, same, "left")
    both = linked.drop("_name", "_file", "_text", "_known").join(pairs, "formula", "left")
    id = F.coalesce(F.col("record").cast("string"), F.concat(F.lit("stlnl_"), F.col("number").cast("string")))
    return both.withColumn("id", F.when(F.col("nl").isNotNull(), F.concat(id, F.lit(":R"), F.col("realization").cast("string"))))


def conversion_counts(rows: DataFrame) -> DataFrame:
    """One row of counts over ``described_rows``: formulas, those without a description, those with one but not linked, descriptions."""
    each = rows.groupBy("formula").agg(F.count("nl").alias("_n"), F.bool_or(F.col("record").isNotNull()).alias("_linked"))
    return each.agg(F.count(F.lit(1)).alias("formulas"), F.count_if(F.col("_n") == 0).alias("without_description"), F.count_if((F.col("_n") > 0) & ~F.col("_linked")).alias("not_linked"), F.sum("_n").alias("descriptions"))


def items_of(df: DataFrame, keys: list[str], order: str, text: str) -> DataFrame:
    """One item per group with all its texts in order, and the key of what is read."""
    grouped = df.groupBy(*keys).agg(F.transform(F.array_sort(F.collect_list(F.struct(order, text))), lambda x: x[text]).alias("texts"))
    return grouped.withColumn("key", F.left(F.sha2(F.array_join("texts", "\n"), 256), F.lit(16)))


def label_rewritings(rows: DataFrame, votes: DataFrame, keys: list[str], text: str, original: str, label: str) -> DataFrame:
    """Label of each rewriting: unchanged if null or equal to the original, else the vote on that text."""
    joined = rows.join(votes.select(*keys, text, label), [*keys, text], "left")
    return joined.withColumn(label, F.when(F.col(text).isNull() | (F.col(text) == F.col(original)), "unchanged").otherwise(F.col(label)))


def part_of(df: DataFrame, set_column: str, label: str) -> DataFrame:
    """Adds part: pairs, pairs_ambiguous or dropped by label; a set with an unjudged row goes to pairs as a whole."""
    state = df.groupBy(set_column).agg(F.bool_or(F.col(label).isNull()).alias("_open"))
    part = F.when(F.col("_open") | (F.col(label) == "correct"), "pairs").when(F.col(label) == "ambiguous", "pairs_ambiguous").otherwise("dropped")
    return df.join(state, set_column).withColumn("part", part).drop("_open")


def write_split(df: DataFrame, path: str, set_column: str, label: str, form: str = "parquet") -> None:
    """Write the rows by set and part, all at once: the job's commit makes them visible."""
    part_of(df, set_column, label).write.partitionBy(set_column, "part").format(form).save(path)


def partition_check(whole: DataFrame, parts: list[DataFrame], id: str) -> DataFrame:
    """One row (missing, extra, doubled): zero each if the parts are disjoint and make up the whole."""
    every = parts[0].select(id)
    for p in parts[1:]:
        every = every.unionByName(p.select(id))
    counts = every.groupBy(id).agg(F.count(F.lit(1)).alias("_n"))
    both = whole.select(id).distinct().withColumn("_w", F.lit(1)).join(counts, id, "full")
    return both.agg(F.count_if(F.col("_n").isNull()).alias("missing"), F.count_if(F.col("_w").isNull()).alias("extra"), F.count_if(F.col("_n") > 1).alias("doubled"))


def concat_sets(*named: tuple[str, DataFrame]) -> DataFrame:
    """Sets in one schema, with their name and rank; columns that one lacks are null."""
    out = None
    for rank, (name, df) in enumerate(named):
        one = df.withColumns({"set": F.lit(name), "set_rank": F.lit(rank).cast("long")})
        out = one if out is None else out.unionByName(one, allowMissingColumns=True)
    return out
