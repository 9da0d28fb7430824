"""Reports: counts, shares, coverage and pivots. All aggregate partially before anything is shuffled."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .scans import count_in_ranges


def with_share(counts: DataFrame, n: str) -> DataFrame:
    """Adds share: ``n`` over the sum of all, which is one row."""
    return counts.crossJoin(F.broadcast(counts.agg(F.sum(n).alias("_all")))).withColumn("share", F.col(n) / F.col("_all")).drop("_all")


def value_counts(df: DataFrame, value: str) -> DataFrame:
    """Count and share per value."""
    return with_share(df.groupBy(value).agg(F.count(F.lit(1)).alias("n")), "n")


def counts_by_set(df: DataFrame, value: str, set_column: str, sets: list[str]) -> DataFrame:
    """Value x set counts, with a total and the total's share."""
    table = df.groupBy(value).pivot(set_column, sets).count().na.fill(0, subset=sets)
    return with_share(table.withColumn("total", sum((F.col(f"`{s}`") for s in sets), F.lit(0))), "total")


def coverage(df: DataFrame, value: str, top: int = 10) -> DataFrame:
    """One row: rows, distinct values, values seen once, and the share of the rows that the most common values cover."""
    counts = df.where(F.col(value).isNotNull()).groupBy(value).agg(F.count(F.lit(1)).alias("n"))
    leaders = counts.orderBy(F.col("n").desc(), value).limit(top).agg(F.sum("n").alias("top_rows"))
    whole = counts.agg(F.sum("n").alias("n_rows"), F.count(F.lit(1)).alias("n_values"), F.count_if(F.col("n") == 1).alias("seen_once"))
    return whole.crossJoin(leaders).withColumn("top_share", F.col("top_rows") / F.col("n_rows"))


def operator_share(df: DataFrame, tokens: Column, operators: dict[str, str]) -> DataFrame:
    """Per operator the share of rows whose token list holds it."""
    held = df.select(tokens.alias("_t")).agg(*(F.avg(F.array_contains("_t", op).cast("double")).alias(name) for name, op in operators.items()))
    pairs = F.array(*(F.struct(F.lit(n).alias("operator"), F.col(n).alias("share")) for n in operators))
    return held.select(F.explode(pairs).alias("_p")).select("_p.*")


def distribution(df: DataFrame, group: str, label: str, labels: list[str]) -> DataFrame:
    """Per group the judged count and the share of each label among the judged."""
    counts = df.where(F.col(label).isNotNull()).groupBy(group).agg(F.count(F.lit(1)).alias("judged"), *(F.avg((F.col(label) == x).cast("double")).alias(f"share_{x}") for x in labels))
    return counts


def with_all_row(df: DataFrame, group: str, label: str, labels: list[str]) -> DataFrame:
    """group x label counts with a row ``all``."""
    counts = df.rollup(group).agg(*(F.count_if(F.col(label) == x).alias(str(x)) for x in labels), F.count(F.lit(1)).alias("total"), F.grouping(group).alias("_g"))
    return counts.withColumn(group, F.when(F.col("_g") == 1, "all").otherwise(F.col(group).cast("string"))).drop("_g")


def conditional_counts(df: DataFrame, group: str, subsets: dict[str, Column]) -> DataFrame:
    """Counts per group over all rows and over each subset."""
    return df.groupBy(group).agg(F.count(F.lit(1)).alias("n_all"), *(F.count_if(c).alias(name) for name, c in subsets.items()))


def counts_of_each(df: DataFrame, id: str, value: str, name: str) -> DataFrame:
    """How many different ids have each value; an id counts for each of its values."""
    return df.groupBy(F.col(value).alias(name)).agg(F.count_distinct(id).alias("n"))


def exploded_counts(df: DataFrame, values: str, name: str) -> DataFrame:
    """A row counts for each distinct element of its array."""
    return df.select(F.explode(F.array_distinct(values)).alias(name)).groupBy(name).agg(F.count(F.lit(1)).alias("n"))


def reason_counts(df: DataFrame, reason: str, ids: str) -> DataFrame:
    """Reasons counted after ids (a pattern) are masked."""
    masked = F.regexp_replace(reason, ids, "another record")
    return df.where(F.col(reason).isNotNull()).groupBy(masked.alias("masked")).agg(F.count(F.lit(1)).alias("n"))


def rule_counts(df: DataFrame, reasons: str) -> DataFrame:
    """Counts of the first reason's rule (the text before its colon)."""
    return df.where(F.size(reasons) > 0).groupBy(F.split(F.get(reasons, F.lit(0)), ":").getItem(0).alias("rule")).agg(F.count(F.lit(1)).alias("n"))


def lookup_matrix(df: DataFrame, lookups: str, services: list[str], statuses: list[str]) -> DataFrame:
    """service x status counts, and how many rows are still to ask."""
    asked = df.select(F.explode(lookups).alias("service", "status")).groupBy("service").agg(*(F.count_if(F.col("status") == s).alias(s) for s in statuses))
    open_ = df.select(F.explode(F.array(*(F.struct(F.lit(s).alias("service"), F.element_at(lookups, F.lit(s)).alias("st")) for s in services))).alias("_x"))
    open_ = open_.groupBy("_x.service").agg(F.count_if(F.col("_x.st").isNull() | (F.col("_x.st") == "no_answer")).alias("still_to_ask"))
    return open_.join(asked, "service", "left").na.fill(0)


def totals(df: DataFrame, group: list[str], counted: str) -> DataFrame:
    """Rows and distinct ``counted`` per combination of the group columns and in total."""
    sets = df.groupingSets([[*(F.col(g) for g in group)], []], *(F.col(g) for g in group)).agg(F.count(F.lit(1)).alias("n"), F.count_distinct(counted).alias("n_distinct"), F.grouping_id().alias("_g"))
    return sets.select(*(F.when(F.col("_g") > 0, "all").otherwise(F.col(g).cast("string")).alias(g) for g in group), "n", "n_distinct")


def benchmark_summary(scores: DataFrame, config: list[str], run: str, entry: str, right: str, seconds: str, cost: str) -> DataFrame:
    """Per configuration over its runs: right entries (mean, least, most), median seconds, cost, and unstable entries.

    ``scores``: one row per (config, run, entry). An entry is unstable if it is right in one run and wrong in another.
    """
    runs = scores.groupBy(*config, run).agg(F.count_if(right).alias("_n"), F.percentile(seconds, 0.5).alias("_s"), F.sum(cost).alias("_c"))
    table = runs.groupBy(*config).agg(F.count(F.lit(1)).alias("runs"), F.avg("_n").alias("mean_right"), F.min("_n").alias("least"), F.max("_n").alias("most"), F.avg("_s").alias(seconds), F.avg("_c").alias(cost))
    unstable = scores.groupBy(*config, entry).agg(F.min(right).alias("_a"), F.max(right).alias("_b")).groupBy(*config).agg(F.count_if(F.col("_a") != F.col("_b")).alias("unstable"))
    return table.join(unstable, config)


def entries_to_review(answers: DataFrame, entry: str, config: str, answer: str, wrong: str, top: int = 4) -> DataFrame:
    """Entries that at least half of the configurations get wrong mostly, with their most common wrong answers."""
    each = answers.groupBy(entry, config).agg(F.avg(F.col(wrong).cast("double")).alias("_w"))
    found = each.groupBy(entry).agg(F.count(F.lit(1)).alias("configs"), F.count_if(F.col("_w") > 0.5).alias("mostly_wrong")).where("mostly_wrong * 2 >= configs")
    counts = answers.where(wrong).groupBy(entry, answer).agg(F.count(F.lit(1)).alias("n"))
    ranked = counts.withColumn("_r", F.row_number().over(Window.partitionBy(entry).orderBy(F.desc("n"), answer))).where(F.col("_r") <= top)
    common = ranked.groupBy(entry).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_r", answer, "n"))), lambda x: F.concat_ws(" ", x[answer], x["n"].cast("string"))), ",").alias("answers"))
    return found.join(common, entry)


def formula_counts(operators: DataFrame, paper: str) -> DataFrame:
    """Per paper the concrete and symbolic operators of its document's files, and the formulas they form.

    ``operators`` as from ``scan_papers``. A formula is a unit with an operator, concrete if any of its operators is.
    """
    own = operators.where("in_document")
    concrete = F.col("kind") == "concrete"
    units = own.groupBy(paper, "path", "unit_start", "unit_end").agg(F.count_if(concrete).alias("_c"), F.count_if(~concrete).alias("_s"))
    return units.groupBy(paper).agg(F.sum("_c").alias("concrete"), F.sum("_s").alias("symbolic"), F.count_if(F.col("_c") > 0).alias("formulas_concrete"), F.count_if(F.col("_c") == 0).alias("formulas_symbolic"))


def paraphrase_stats(rows: DataFrame, group: str, original: str, formula: str, kept: str, missing: str, difference: str) -> DataFrame:
    """Per set: originals, formulas, paraphrases kept and dropped, kept ones that miss a symbol, mean word difference of those kept."""
    k = F.col(kept)
    return rows.groupBy(group).agg(
        F.count_distinct(F.when(k, F.col(original))).alias("originals"), F.count_distinct(F.when(k, F.col(formula))).alias("formulas"), F.count_if(k).alias("kept"), F.count_if(~k).alias("dropped"),
        F.count_if(k & F.col(missing)).alias("missing_symbol"), F.avg(F.when(k, F.col(difference))).alias("word_difference"),
    )


def eval_coverage(entries: DataFrame, marks: DataFrame, requirements: DataFrame, keys: list[str], id: str, start: str, end: str, pos: str) -> DataFrame:
    """(state, requirement, n): labelled entries by whether they lie in a region (null bounds: none) and are marked there, and
    whether they have requirements and all of them stand in the region of the marked entry."""
    found = entries.join(count_in_ranges(entries, marks, keys, id, start, end, pos).withColumnRenamed("n", "_marks"), id)
    found = found.join(count_in_ranges(entries, requirements, keys, id, start, end, pos).withColumnRenamed("n", "_inside"), id)
    found = found.join(requirements.groupBy(*keys).agg(F.count(F.lit(1)).alias("_wanted")), keys, "left")
    state = F.when(F.col(start).isNull(), "in no region").when(F.col("_marks") > 0, "marked").otherwise("inside, not marked")
    wanted = F.when(F.col("_wanted").isNull(), "none").when((state == "marked") & (F.col("_inside") == F.col("_wanted")), "inside").otherwise("outside")
    return found.groupBy(state.alias("state"), wanted.alias("requirement")).agg(F.count(F.lit(1)).alias("n"))
