"""Votes of several annotators, agreement and disputes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.passages import longest_common, nearly_equal, passage_groups, same_passage
from ..functions.text import without_spaces


def label_vote(a: Column, b: Column, third: Column) -> Column:
    """Struct (label, how): two that agree, else the third decides, else the middle one of correct, ambiguous, wrong."""
    every = F.array_sort(F.array(a, b, third))
    middle = every == F.array(F.lit("ambiguous"), F.lit("correct"), F.lit("wrong"))
    label = F.when(a.isNull() | b.isNull(), F.lit(None)).when(a == b, a).when(third.isNull(), F.lit(None)).when((third == a) | (third == b), third).when(middle, "ambiguous")
    how = (
        F.when(a.isNull() | b.isNull(), "unjudged").when(a == b, "agreed").when(third.isNull(), "disputed").when((third == a) | (third == b), "third decides").when(middle, "middle one").otherwise("undecided")
    )
    return F.struct(label.alias("label"), how.alias("how"))


def formula_vote(answers: DataFrame, item: str, key: str, value: str, order: str) -> DataFrame:
    """Per item the transcription whose key at least two models give: largest group, then earliest, from its first model."""
    groups = answers.where(F.col(key).isNotNull()).groupBy(item, key).agg(F.count(F.lit(1)).alias("n"), F.min(order).alias("first"), F.min_by(value, order).alias("value"))
    best = groups.where("n >= 2").groupBy(item).agg(F.max_by(F.struct("value", "n"), F.struct("n", -F.col("first"))).alias("b"))
    return best.select(item, F.col("b.value").alias(value), F.col("b.n").alias("votes"))


def majority_value(answers: DataFrame, item: str, value: str, order: str) -> DataFrame:
    """Most frequent value per item; of equally frequent ones that of the earliest model."""
    counts = answers.where(F.col(value).isNotNull()).groupBy(item, value).agg(F.count(F.lit(1)).alias("n"), F.min(order).alias("first"))
    return counts.groupBy(item).agg(F.max_by(value, F.struct(F.col("n"), -F.col("first"))).alias(value), F.max("n").alias("votes"))


def first_meaning(answers: DataFrame, item: str, meanings: str, order: str) -> DataFrame:
    """Union of the models' maps; where several name a symbol the first model's meaning counts."""
    each = answers.select(item, order, F.explode(meanings).alias("symbol", "meaning"))
    first = each.groupBy(item, "symbol").agg(F.min_by("meaning", order).alias("meaning"))
    return first.groupBy(item).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("symbol", "meaning")))).alias(meanings))


def dispute_of(agreement: Column, kind_a: Column, kind_b: Column, key_a: Column, key_b: Column) -> Column:
    """What two answers differ in: requirement, kind or formula; null if in nothing."""
    return F.when(agreement.isin("one gives none", "different passages"), "requirement").when(~kind_a.eqNullSafe(kind_b), "kind").when(~key_a.eqNullSafe(key_b), "formula")


def verdict_of(third: Column, a: Column, b: Column) -> Column:
    """Whom the third answer supports."""
    return F.when(third.isNull(), "not asked").when((third == a) & (third == b), "both").when(third == a, "first").when(third == b, "second").otherwise("neither")


def disputed_items(answers: DataFrame, item: str, part: str, model: str, value: str, first: str, second: str) -> DataFrame:
    """Items with a part on which the first two models differ: the queue of the third."""
    both = answers.where(F.col(model).isin(first, second)).groupBy(item, part).agg(F.max(F.when(F.col(model) == first, F.col(value))).alias("a"), F.max(F.when(F.col(model) == second, F.col(value))).alias("b"))
    return both.where("a is not null and b is not null and a != b").select(item).distinct()


def answer_by_label(answers: Column, label: Column, field: str = "label") -> Column:
    """The first answer whose label is the final one, else the first answer."""
    return F.coalesce(F.get(F.filter(answers, lambda x: x[field] == label), F.lit(0)), F.get(answers, F.lit(0)))


def verdict_matrix(df: DataFrame, verdict: str, agreement: str, values: list[str]) -> DataFrame:
    """verdict x agreement counts with row totals."""
    table = df.groupBy(verdict).pivot(agreement, values).count().na.fill(0)
    return table.withColumn("total", sum((F.col(f"`{v}`") for v in values), F.lit(0)))


def _matches(a: DataFrame, b: DataFrame, item: str, text: str) -> DataFrame:
    """Pairs of an item's passages of two lists that are the same passage, with ``near``: nearly equal.

    Equal texts are joined directly; only the other pairs of an item are compared by their longest common substring.
    """
    left = a.select(item, F.col(text).alias("_x"), *([F.col("kind").alias("_kx")] if "kind" in a.columns else []))
    right = b.select(item, F.col(text).alias("_y"), *([F.col("kind").alias("_ky")] if "kind" in b.columns else []))
    pairs = left.join(right, item).withColumn("_n", F.when(F.col("_x") == F.col("_y"), F.char_length(without_spaces(F.col("_x"))).cast("long")).otherwise(longest_common("_x", "_y")))
    return pairs.where(same_passage(F.col("_n"), F.col("_x"), F.col("_y"))).withColumn("near", nearly_equal(F.col("_n"), F.col("_x"), F.col("_y")))


def _sizes(a: DataFrame, b: DataFrame, item: str, pairs: DataFrame) -> DataFrame:
    """Per item: passages of each list (a, b), and how many of each have a counterpart (a_found, b_found)."""
    both = a.groupBy(item).agg(F.count(F.lit(1)).alias("a")).join(b.groupBy(item).agg(F.count(F.lit(1)).alias("b")), item, "full")
    found = pairs.groupBy(item).agg(F.count_distinct("_x").alias("a_found"), F.count_distinct("_y").alias("b_found"))
    return both.join(found, item, "left").na.fill(0, ["a", "b", "a_found", "b_found"])


def agreement(items: DataFrame, answered: str, a: DataFrame, b: DataFrame, item: str, text: str) -> DataFrame:
    """How far two lists of distinct passages agree: not answered, both none, one gives none, same, partly the same, different."""
    sizes = items.join(_sizes(a, b, item, _matches(a, b, item, text)), item, "left").na.fill(0, ["a", "b", "a_found", "b_found"])
    state = (
        F.when(~F.col(answered), "not answered").when((F.col("a") == 0) & (F.col("b") == 0), "both none").when((F.col("a") == 0) | (F.col("b") == 0), "one gives none")
        .when((F.col("a_found") == F.col("a")) & (F.col("b_found") == F.col("b")), "same passages").when(F.col("a_found") + F.col("b_found") > 0, "partly the same").otherwise("different passages")
    )
    return sizes.select(item, state.alias("agreement"))


def score_entries(labelled: DataFrame, given: DataFrame, item: str, text: str, kind: str) -> DataFrame:
    """Given against labelled passages (distinct per item): verdict, found, extra, kinds_right.

    invented, missed, other, partly, and where all are found and none is extra: exact if each label has a nearly equal
    passage, else overlap. Items without any passage on either side are in no row.
    """
    a, b = labelled.select(item, text, F.col(kind).alias("kind")), given.select(item, text, F.col(kind).alias("kind"))
    pairs = _matches(a, b, item, text)
    sizes = _sizes(a, b, item, pairs)
    each = pairs.groupBy(item, "_x").agg(F.max("near").alias("near"), F.max(F.col("_kx") == F.col("_ky")).alias("right"))
    extra = each.groupBy(item).agg(F.count_if("near").alias("_near"), F.count_if("right").alias("kinds_right"))
    sizes = sizes.join(extra, item, "left").na.fill(0, ["_near", "kinds_right"])
    verdict = (
        F.when(F.col("a") == 0, "invented").when(F.col("b") == 0, "missed").when(F.col("a_found") == 0, "other").when((F.col("a_found") < F.col("a")) | (F.col("b_found") < F.col("b")), "partly")
        .when(F.col("_near") == F.col("a"), "exact").otherwise("overlap")
    )
    return sizes.select(item, verdict.alias("verdict"), F.col("a_found").alias("found"), (F.col("b") - F.col("b_found")).alias("extra"), "kinds_right")


def requirement_vote(asked: DataFrame, given: DataFrame, item: str, model: str, text: str, kind: str, copy: str, prefer: list[str], needed: int = 2) -> DataFrame:
    """The vote of the models on an item's passages: outcome, and the kept passages with their kinds.

    ``asked``: (item, model) of every answer, ``given``: the passages of the answers, with whether each is a ``copy`` of the
    excerpt. Passages are grouped in the order of (model, text), the models of ``prefer`` first, each with the first group that has a matching member. A group that ``needed`` models give is kept, with
    the kind that most of them give it (each model's first passage of the group counts), or ``unclear``; generic ones go if
    a specific one is kept. The text is that of the first model whose passage is a copy, else of the first one. requirement: some are kept; none: ``needed`` answers have no
    passage; else open. An item's passages meet in one row, so their number is that of its models' answers.
    """
    place = F.coalesce(*(F.when(F.col(model) == m, F.lit(i)) for i, m in enumerate(prefer)), F.lit(len(prefer)))
    ordered = given.groupBy(item).agg(F.array_sort(F.collect_list(F.struct(place.alias("o"), F.col(model).alias("m"), F.col(text).alias("t"), F.col(kind).alias("k"), F.col(copy).alias("c")))).alias("_p"))
    each = ordered.select(item, "_p", passage_groups(F.col("_p.t")).alias("_g")).select(item, F.posexplode(F.arrays_zip("_p", "_g")).alias("_i", "_z")).select(item, "_i", "_z._p.*", F.col("_z._g").alias("g"))
    votes = each.groupBy(item, "g", "m").agg(F.min_by(F.struct("t", "k", "c"), "_i").alias("v"), F.min("_i").alias("_i"))
    kinds = votes.groupBy(item, "g", F.col("v.k").alias("k")).agg(F.count(F.lit(1)).alias("n"))
    most = kinds.groupBy(item, "g").agg(F.sum("n").alias("models"), F.max(F.struct("n", "k")).alias("top")).where(F.col("models") >= needed)
    first = votes.groupBy(item, "g").agg(F.min_by("v.t", F.struct(~F.coalesce(F.col("v.c"), F.lit(False)), "_i")).alias("t"))
    kept = most.join(first, [item, "g"]).withColumn("kind", F.when(2 * F.col("top.n") > F.col("models"), F.col("top.k")).otherwise("unclear"))
    kept = kept.groupBy(item).agg(F.max((F.col("kind") == "specific")).alias("_s"), F.array_sort(F.collect_list(F.struct("t", "kind"))).alias("_k"))
    kept = kept.withColumn("_k", F.when(F.col("_s"), F.filter("_k", lambda x: x["kind"] != "generic")).otherwise(F.col("_k")))
    silent = asked.join(given.select(item, model).distinct(), [item, model], "left_anti").groupBy(item).agg(F.count(F.lit(1)).alias("_none"))
    out = asked.select(item).distinct().join(kept, item, "left").join(silent, item, "left")
    outcome = F.when(F.size("_k") > 0, "requirement").when(F.col("_none") >= needed, "none").otherwise("open")
    return out.select(item, outcome.alias("outcome"), F.coalesce(F.array_join(F.transform("_k", lambda x: F.concat(x["t"], F.lit(":"), x["kind"])), ","), F.lit("")).alias("passages"))
