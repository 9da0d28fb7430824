"""Spans and positions: intervals, headings, context windows, pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..scratch import materialize
from .scans import Fold, ranges, running, running_values
from .select import number_rows


def point_in_interval(points: DataFrame, spans: DataFrame, keys: list[str], pos: str, start: str, end: str, width: int = 1024) -> DataFrame:
    """Each point with the span of its file that holds it (start <= pos < end), null where none does.

    Spans are cut into bins of ``width``, so that a file with many points and spans is joined on (file, bin).
    """
    bins = F.explode(F.sequence(F.expr(f"{start} div {width}"), F.expr(f"greatest({end} - 1, {start}) div {width}")))
    cut = spans.select(*keys, start, end, bins.alias("_bin"))
    binned = points.withColumn("_bin", F.expr(f"{pos} div {width}"))
    hit = binned.join(cut, [*keys, "_bin"], "left").where(F.col(start).isNull() | ((F.col(start) <= F.col(pos)) & (F.col(pos) < F.col(end))))
    first = hit.groupBy(*keys, pos).agg(F.min(F.when(F.col(start).isNotNull(), F.struct(start, end))).alias("_s"))
    return points.join(first, [*keys, pos], "left").withColumns({start: F.col(f"_s.{start}"), end: F.col(f"_s.{end}")}).drop("_s")


def asof_heading(points: DataFrame, headings: DataFrame, keys: list[str], pos: str, level: str, title: str, levels: int) -> DataFrame:
    """Section path at each point: per level the last heading at or before it, reset by a heading of a higher level."""
    p = points.withColumns({"_k": F.lit(1), level: F.lit(None).cast("int"), title: F.lit(None).cast("string")})
    h = headings.select(*keys, pos, level, title).withColumn("_k", F.lit(0))
    both = p.unionByName(h, allowMissingColumns=True)
    folds: dict[str, Fold] = {}
    for i in range(levels):
        folds[f"_h{i}"] = Fold("last", F.when(F.col(level) == i, F.struct(F.col(pos).alias("at"), F.col(title).alias("t"))))
        folds[f"_r{i}"] = Fold("max", F.when(F.col(level) < i, F.col(pos)))
    both = running_values(both, keys, [pos, "_k"], folds)
    path = F.array_compact(F.array(*(F.when(F.col(f"_r{i}").isNull() | (F.col(f"_h{i}.at") >= F.col(f"_r{i}")), F.col(f"_h{i}.t")) for i in range(levels))))
    return both.where("_k = 1").withColumn("section", path).select(*points.columns, "section")


def page_context(pages: DataFrame, doc: str, page: str, text: str, around: int = 1500) -> DataFrame:
    """Page text with the end of the page before and the start of the next, and the offset where the page begins."""
    dealt = ranges(pages, [doc], [page])
    ends = Fold("last", F.right(F.coalesce(F.col(text), F.lit("")), F.lit(around)), inclusive=False)
    starts = Fold("last", F.left(F.coalesce(F.col(text), F.lit("")), F.lit(around)), inclusive=False)
    found = running(running(dealt, [doc], [page], {"_before": ends}), [doc], [page], {"_after": starts}, backward=True)
    before, after = F.coalesce("_before", F.lit("")), F.coalesce("_after", F.lit(""))
    return found.withColumns({"context": F.concat(before, F.coalesce(F.col(text), F.lit("")), after), "offset": F.length(before).cast("long")}).drop("_before", "_after", "_range")


def merge_windows(windows: DataFrame, keys: list[str], start: str, end: str, gap: int = 200, most: int = 15) -> DataFrame:
    """(keys, run, chunk, start, end, n): windows that start within ``gap`` of the run's end so far form one run; a run of
    more than ``most`` is split into equal chunks."""
    order = [start, end]
    found = running(ranges(windows, keys, order), keys, order, {"_reach": Fold("max", F.col(end), inclusive=False), "_n": Fold("sum", F.lit(1))})
    fresh = F.col("_reach").isNull() | (F.col(start) > F.col("_reach") + gap)
    found = materialize(found.withColumn("_new", F.when(fresh, F.col("_n"))).drop("_reach"), "windows")
    order = [*order, "_n"]  # rows of equal bounds keep their place from here on
    # a run goes from its first row's number to the next run's
    found = materialize(running(found, keys, order, {"run": Fold("sum", F.when(F.col("_new").isNotNull(), 1)), "_first": Fold("last", F.col("_new"))}), "windows")
    found = running(found, keys, order, {"_next": Fold("last", F.col("_new"), inclusive=False), "_all": Fold("max", F.col("_n"))}, backward=True)
    size = F.coalesce("_next", F.col("_all") + 1) - F.col("_first")
    chunk = F.floor((F.col("_n") - F.col("_first")) * F.ceil(size / most) / size)
    return found.withColumn("chunk", chunk).groupBy(*keys, "run", "chunk").agg(F.min(start).alias(start), F.max(end).alias(end), F.count(F.lit(1)).alias("n"))


def marks_of(texts: DataFrame, keys: list[str], text: str, patterns: dict[str, str]) -> DataFrame:
    """(keys, kind, pos, stop): where each pattern stands in each text, from left to right without overlaps.

    A text is cut after each match; where a piece ends is the sum of the lengths up to it. (A piece starts where the one before
    ended; without that the search would begin anew at each character after the last match.)
    """
    sized = None
    for kind, pattern in patterns.items():
        pieces = texts.select(*keys, F.lit(kind).alias("kind"), F.posexplode(F.regexp_extract_all(text, F.lit(f"(?s)\\G.*?(?:{pattern})"), 0)).alias("_i", "_piece"))
        one = pieces.select(*keys, "kind", "_i", F.char_length("_piece").cast("long").alias("_n"), F.char_length(F.regexp_extract("_piece", f"(?s)^.*?({pattern})$", 1)).cast("long").alias("_match"))
        sized = one if sized is None else sized.unionByName(one)
    placed = running_values(sized, [*keys, "kind"], ["_i"], {"stop": Fold("sum", F.col("_n"))})
    return placed.select(*keys, "kind", (F.col("stop") - F.col("_match")).alias("pos"), "stop")


def beside(points: DataFrame, marks: DataFrame, keys: list[str], at: str, before: dict[str, str], after: dict[str, str]) -> DataFrame:
    """``points`` with the last mark (struct pos, stop) at or before ``at`` for each kind in ``before``, and the first one after ``at``
    for each in ``after`` (column name: kind). Marks are at ``_at``; nothing is joined."""
    both = points.withColumns({"_at": F.col(at), "_side": F.lit(1)}).unionByName(marks.withColumn("_side", F.lit(0)), allowMissingColumns=True)
    dealt = ranges(both, keys, ["_at", "_side"])
    mark = lambda kind: F.when((F.col("_side") == 0) & (F.col("kind") == kind), F.struct("pos", "stop"))
    found = dealt
    if before:
        found = running(found, keys, ["_at", "_side"], {n: Fold("last", mark(k)) for n, k in before.items()})
    if after:
        found = running(found, keys, ["_at", "_side"], {n: Fold("last", mark(k), inclusive=False) for n, k in after.items()}, backward=True)
    return found.where("_side = 1").select(*points.columns, *before, *after)


def window_bounds(formulas: DataFrame, texts: DataFrame, keys: list[str], start: str, end: str, text: str, hard: str, paragraph: str, line: str, math: str, before: int = 2000, after: int = 3000, snap: int = 600) -> DataFrame:
    """``formulas`` with lo and hi: the context of text[start:end], within its section, cut at a paragraph break or a line.

    A section goes from one match of ``hard`` to the next. A cut ``before`` or ``after`` characters away moves outwards to a break that is at
    most ``snap`` away, else to the line's border, and out of a ``math`` span that it falls into.
    """
    marks = materialize(marks_of(texts, keys, text, {"hard": hard, "paragraph": paragraph, "line": line, "math": math}), "marks")
    at = lambda kinds, place: marks.where(F.col("kind").isin(kinds)).withColumn("_at", F.col(place))
    rows = formulas.select(*keys, F.col(start).alias("_start"), F.col(end).alias("_end"), *(c for c in formulas.columns if c not in keys))
    rows = beside(rows, at(["hard"], "pos"), keys, "_start", {"_b": "hard"}, {"_a": "hard"}).join(texts.select(*keys, F.char_length(text).cast("long").alias("_length")), keys)
    rows = rows.withColumns({"_floor": F.coalesce("_b.pos", F.lit(0)), "_ceiling": F.coalesce("_a.pos", "_length")}).drop("_a", "_b")
    rows = materialize(rows.withColumns({"_lo": F.greatest("_floor", F.col("_start") - before), "_hi": F.least("_ceiling", F.col("_end") + after)}).withColumn("_before_hi", F.col("_hi") - 1), "bounds")
    rows = beside(rows, at(["paragraph", "line"], "stop"), keys, "_lo", {"_p": "paragraph", "_l": "line"}, {})
    low = F.when(F.col("_p.stop") >= F.greatest(F.col("_floor"), F.col("_lo") - snap), F.col("_p.stop")).otherwise(F.greatest(F.col("_floor"), F.coalesce("_l.stop", F.lit(0))))
    rows = materialize(rows.withColumn("_lo", F.when(F.col("_lo") > F.col("_floor"), low).otherwise(F.col("_lo"))).drop("_p", "_l"), "bounds")
    stops = at(["paragraph"], "stop").unionByName(at(["line"], "pos"))
    rows = beside(rows, stops, keys, "_before_hi", {}, {"_p": "paragraph", "_l": "line"})
    high = F.when(F.col("_p.stop") <= F.least(F.col("_ceiling"), F.col("_hi") + snap), F.col("_p.stop")).otherwise(F.least(F.col("_ceiling"), F.coalesce("_l.pos", F.col("_ceiling"))))
    rows = rows.withColumn("_hi", F.when(F.col("_hi") < F.col("_ceiling"), high).otherwise(F.col("_hi"))).drop("_p", "_l")
    rows = materialize(rows.withColumns({"_under_lo": F.col("_lo") - 1, "_under_hi": F.col("_hi") - 1}), "bounds")
    rows = materialize(beside(rows, at(["math"], "pos"), keys, "_under_lo", {"_m": "math"}, {}), "bounds")
    rows = beside(rows, at(["math"], "pos"), keys, "_under_hi", {"_n": "math"}, {})
    lo = F.when(F.col("_m.stop") > F.col("_lo"), F.col("_m.pos")).otherwise(F.col("_lo"))
    hi = F.when(F.col("_n.stop") > F.col("_hi"), F.col("_n.stop")).otherwise(F.col("_hi"))
    return rows.withColumns({"lo": F.least(lo, "_start"), "hi": F.greatest(hi, "_end")}).select(*formulas.columns, "lo", "hi")


def quantile_at(df: DataFrame, group: list[str], value: str, quantiles: dict[str, float]) -> DataFrame:
    """Per group the value at index int(q * (n - 1)) of the sorted values, by rank: no group is collected."""
    ranked = number_rows(df.where(F.col(value).isNotNull()), group, [value], "_i")
    sizes = ranked.groupBy(*group).agg(F.count(F.lit(1)).alias("_n"))  # one row per group
    picks = [F.max(F.when(F.col("_i") - 1 == F.floor(F.lit(q) * (F.col("_n") - 1)), F.col(value))).alias(name) for name, q in quantiles.items()]
    return ranked.join(sizes, group).groupBy(*group).agg(*picks)


def line_formulas(operators: DataFrame, keys: list[str], kind: str) -> DataFrame:
    """A line with several operators is one formula, concrete if any of them is."""
    return operators.groupBy(*keys).agg(F.bool_or(F.col(kind) == "concrete").alias("concrete"), F.count(F.lit(1)).alias("operators"))
