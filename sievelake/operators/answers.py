"""Append-only answer logs: the answer that counts, what is left to ask, costs and checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .scans import Fold, running_values


def latest_answer(log: DataFrame, keys: list[str], seq: str, ok: Column) -> DataFrame:
    """Per key the last successful row; if there is none, the first failed one."""
    columns = F.struct(*(F.col(c) for c in log.columns if c not in keys))
    good, bad = F.when(ok, F.col(seq)), F.when(~F.coalesce(ok, F.lit(False)), F.col(seq))
    picked = log.groupBy(*keys).agg(F.max_by(columns, good).alias("_ok"), F.min_by(columns, bad).alias("_bad"))
    return picked.withColumn("_row", F.coalesce("_ok", "_bad")).select(*keys, "_row.*")


def latest_usable(log: DataFrame, keys: list[str], seq: str, usable: Column, content: str) -> DataFrame:
    """Per key the last usable row, unless a later failed row was for other content: then the last row."""
    columns = F.struct(*(F.col(c) for c in log.columns if c not in keys))
    usable = F.coalesce(usable, F.lit(False))
    last = log.groupBy(*keys).agg(F.max_by(columns, F.when(usable, F.col(seq))).alias("_good"), F.max_by(columns, F.when(~usable, F.struct(seq))).alias("_fail"))
    stale = (F.col(f"_fail.{seq}") > F.col(f"_good.{seq}")) & ~F.col(f"_fail.{content}").eqNullSafe(F.col(f"_good.{content}"))
    row = F.when(F.col("_good").isNull() | F.coalesce(stale, F.lit(False)), F.col("_fail")).otherwise(F.col("_good"))
    return last.withColumn("_row", row).select(*keys, "_row.*")


def current_answers(answers: DataFrame, items: DataFrame, item: str, content: str) -> DataFrame:
    """Answers whose item still has the content they were given for."""
    return answers.join(items.select(item, content), [item, content], "left_semi")


def plan_tasks(items: DataFrame, models: DataFrame, answers: DataFrame, item: str, model: str, content: str, usable: Column) -> DataFrame:
    """Every item x model with its state: stored, outdated (content changed), incomplete (no usable answer) or new.

    ``models`` is a short list and is replicated to the items; it isn't a join of two growing tables.
    """
    asked = answers.groupBy(item, model).agg(F.max_by(content, F.when(usable, F.lit(1)).otherwise(0)).alias("_c"), F.max(F.when(usable, 1).otherwise(0)).alias("_u"))
    tasks = items.select(item, content).crossJoin(F.broadcast(models.select(model))).join(asked, [item, model], "left")
    state = F.when(F.col("_u").isNull(), "new").when(F.col("_u") == 0, "incomplete").when(~F.col("_c").eqNullSafe(F.col(content)), "outdated").otherwise("stored")
    return tasks.withColumn("state", state).drop("_c", "_u")


def side_by_side(answers: DataFrame, item: str, model: str, value: str, models: list[str]) -> DataFrame:
    """A map of every asked model's answer (null if none) per item."""
    given = answers.groupBy(item).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct(F.col(model), F.col(value))))).alias("_m"))
    pairs = F.array(*(F.struct(F.lit(m).alias("k"), F.element_at("_m", F.lit(m)).alias("v")) for m in models))
    return given.select(item, F.map_from_entries(pairs).alias("answers"))


def cost_report(log: DataFrame, model: str, ok: Column, cost: str, seconds: str) -> DataFrame:
    """Calls, failures, total and mean cost, mean seconds per model."""
    return log.groupBy(model).agg(
        F.count(F.lit(1)).alias("calls"), F.count_if(~F.coalesce(ok, F.lit(False))).alias("failures"), F.sum(cost).alias("total_cost"), F.avg(cost).alias("mean_cost"), F.avg(seconds).alias("mean_seconds"),
    )


def planned_cost(report: DataFrame, plan: DataFrame, model: str) -> DataFrame:
    """Mean cost times the tasks that still have to be asked."""
    todo = plan.where("state != 'stored'").groupBy(model).agg(F.count(F.lit(1)).alias("to_do"))
    return report.join(todo, model, "left").withColumn("to_do", F.coalesce("to_do", F.lit(0))).withColumn("planned_cost", F.col("mean_cost") * F.col("to_do"))


def failed_checks(log: DataFrame, problems: str, model: str, models: list[str]) -> DataFrame:
    """Check name (detail and suffix stripped) x model counts; a check counts once per answer."""
    name = lambda p: F.trim(F.regexp_replace(F.regexp_replace(p, r":.*$", ""), r"\s*\([^)]*\)$", ""))
    each = log.select(model, F.explode(F.array_distinct(F.transform(problems, name))).alias("check_name"))
    return each.groupBy("check_name").pivot(model, models).count().na.fill(0)


def budget_cut(log: DataFrame, run: str, seq: str, cost: str, budget: float) -> DataFrame:
    """Rows that start before the run's cumulative cost reaches the budget."""
    spent = running_values(log, [run], [seq], {"spent_before": Fold("sum", F.col(cost), inclusive=False)})
    return spent.withColumn("spent_before", F.coalesce("spent_before", F.lit(0.0))).where(F.col("spent_before") < budget)


def log_runs(lines: DataFrame, file: str, line: str, starts: Column) -> DataFrame:
    """Adds run: how many start lines the file has up to this line."""
    return running_values(lines, [file], [line], {"run": Fold("sum", F.when(starts, 1).otherwise(0))})


def cooldown_answers(log: DataFrame, keys: list[str], seq: str, ts: str, warning: Column, result: Column, cooldown: int = 1020) -> DataFrame:
    """Result rows with answered: no warning since the previous result, and after the end of the last cooldown."""
    marked = log.withColumns({"_warning": F.coalesce(warning, F.lit(False)), "_result": F.coalesce(result, F.lit(False))})
    before = lambda kind, when, what: Fold(kind, F.when(F.col(when), F.col(what)), inclusive=False)
    marked = running_values(marked, keys, [seq], {"_lw": before("max", "_warning", seq), "_lr": before("max", "_result", seq), "_lt": before("last", "_warning", ts)})
    quiet = F.col("_lw").isNull() | (F.coalesce(F.col("_lr"), F.lit(-1)) > F.col("_lw"))
    over = F.col("_lt").isNull() | (F.col(ts) >= F.col("_lt") + F.make_dt_interval(secs=F.lit(cooldown)))
    return marked.where("_result").withColumn("answered", quiet & over).drop("_warning", "_result", "_lw", "_lr", "_lt")


def lookup_evidence(results: DataFrame, keys: list[str], seq: str, answered: str) -> DataFrame:
    """Per key an answered result before one that isn't, else the latest."""
    columns = F.struct(*(F.col(c) for c in results.columns if c not in keys))
    return results.groupBy(*keys).agg(F.max_by(columns, F.struct(F.col(answered), F.col(seq))).alias("_row")).select(*keys, "_row.*")


def check_entries(answer: DataFrame, asked: DataFrame, region: str, id: str, pos: str) -> DataFrame:
    """Entries of each region's answer with what is wrong: unknown id, answered twice (the first counts); and ids unanswered."""
    rank = F.row_number().over(Window.partitionBy(region, id).orderBy(pos))
    known = asked.select(region, id).distinct().withColumn("_known", F.lit(True))
    given = answer.withColumn("_rank", rank).join(known, [region, id], "left")
    state = F.when(F.col("_known").isNull(), "unknown id").when(F.col("_rank") > 1, "answered twice").otherwise("ok")
    given = given.select(region, id, F.col(pos).cast("long").alias("pos"), state.alias("state"))
    open_ = known.join(answer.select(region, id), [region, id], "left_anti").select(region, id, F.lit(None).cast("long").alias("pos"), F.lit("unanswered").alias("state"))
    return given.unionByName(open_)
