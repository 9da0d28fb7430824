"""Running values over ordered groups of any size, and what follows from them: nearest neighbours and counts in ranges.

Rows are dealt by ranges of (group, order). Each range is folded, the folds of a group's ranges are carried on in order, and
a row combines what its range gives up to it with what the ranges before gave. No group meets in one task, however large.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..scratch import materialize


@dataclass(frozen=True)
class Fold:
    """A running value: the ``sum`` or ``max`` of a column so far, or its ``last`` value that is not null.

    ``inclusive``: the row itself counts.
    """

    kind: str
    value: Column
    inclusive: bool = True

    def over(self, name: str, window: Window) -> Column:
        made = {"sum": F.sum, "max": F.max, "last": lambda c: F.last(c, ignorenulls=True)}[self.kind]
        return made(name).over(window)

    def total(self, name: str, place: Column) -> Column:
        if self.kind == "last":
            return F.max_by(name, F.when(F.col(name).isNotNull(), place))
        return {"sum": F.sum, "max": F.max}[self.kind](name)

    def combined(self, before: Column, own: Column) -> Column:
        if self.kind == "last":
            return F.coalesce(own, before)
        return F.greatest(before, own) if self.kind == "max" else F.coalesce(before + own, before, own)


def ranges(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """``df`` dealt by ranges of (keys, order), written once; column _range names a row's range."""
    return materialize(df.repartitionByRange(*keys, *order).withColumn("_range", F.spark_partition_id()), "ranges")


def running(ranged: DataFrame, keys: list[str], order: list[str], folds: dict[str, Fold], backward: bool = False) -> DataFrame:
    """Adds the running values of ``folds`` along ``order`` (or against it) within ``keys``, to what ``ranges`` gives.

    Rows that are equal in ``order`` are taken in any order; null keys are a group. Values of rows that are not counted are null.
    """
    turn = (lambda c: F.col(c).desc()) if backward else (lambda c: F.col(c).asc())
    valued = ranged.withColumns({f"_v_{n}": f.value for n, f in folds.items()})
    window = Window.partitionBy(*keys, "_range").orderBy(*map(turn, order))
    spans = {n: window.rowsBetween(Window.unboundedPreceding, 0 if f.inclusive else -1) for n, f in folds.items()}
    own = valued.withColumns({f"_o_{n}": f.over(f"_v_{n}", spans[n]) for n, f in folds.items()})
    # one row per group and range; where order is the same, any of the rows is the last
    place = F.struct(*order)
    named = [F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)]
    if backward:
        ends = [F.min_by(f"_v_{n}", F.when(F.col(f"_v_{n}").isNotNull(), place)) if f.kind == "last" else f.total(f"_v_{n}", place) for n, f in folds.items()]
    else:
        ends = [f.total(f"_v_{n}", place) for n, f in folds.items()]
    totals = valued.groupBy(*named, F.col("_range").alias("_r")).agg(*(e.alias(f"_t_{n}") for e, n in zip(ends, folds)))
    along = Window.partitionBy(*(f"_k{i}" for i in range(len(keys)))).orderBy(turn("_r")).rowsBetween(Window.unboundedPreceding, -1)
    carried = totals.select(*(f"_k{i}" for i in range(len(keys))), "_r", *(f.over(f"_t_{n}", along).alias(f"_c_{n}") for n, f in folds.items()))
    carried = carried.where(" or ".join(f"`_c_{n}` is not null" for n in folds))
    same = F.col("_range") == F.col("_r")
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"_k{i}"))
    both = own.join(carried, same, "left")
    return both.select(*ranged.columns, *(f.combined(F.col(f"_c_{n}"), F.col(f"_o_{n}")).alias(n) for n, f in folds.items()))


def running_values(df: DataFrame, keys: list[str], order: list[str], folds: dict[str, Fold], backward: bool = False) -> DataFrame:
    """``df`` with the running values of ``folds``."""
    return running(ranges(df, keys, order), keys, order, folds, backward).drop("_range")


def _beside(entries: DataFrame, values: DataFrame, keys: list[str], at: str, value: str) -> DataFrame:
    """Each entry with _gap, the least distance of a value of its group, and the one or two values (column ``value``) at that distance."""
    both = entries.withColumn("_side", F.lit(1)).unionByName(values.select(*keys, F.col(value).alias(at)).withColumn("_side", F.lit(0)), allowMissingColumns=True)
    known = F.when(F.col("_side") == 0, F.col(at))
    dealt = ranges(both, keys, [at, "_side"])
    low = materialize(running(dealt, keys, [at, "_side"], {"_low": Fold("last", known)}), "below")
    found = running(low, keys, [at, "_side"], {"_high": Fold("last", known, inclusive=False)}, backward=True).where("_side = 1")
    below, above = F.col(at) - F.col("_low"), F.col("_high") - F.col(at)
    found = found.withColumn("_gap", F.least(below, above)).where("_gap is not null")
    sides = F.array_distinct(F.array_compact(F.array(F.when(below == F.col("_gap"), F.col("_low")), F.when(above == F.col("_gap"), F.col("_high")))))
    return found.withColumn(value, F.explode(sides)).select(*entries.columns, "_gap", value)


def nearest(entries: DataFrame, occurrences: DataFrame, keys: list[str], id: str, order: list[tuple[str, str]], value: str) -> DataFrame:
    """(id, value): per entry the occurrence of its group that is least by distance; entries of groups without one are left out.

    ``order``: pairs (column of the entries, column of the occurrences) of numbers, whose distances are compared one after the
    other; then the smallest ``value`` counts. Neighbours are found along the sorted numbers, so the rows looked at are at most
    2 ** len(order) per entry. Nulls in these columns are near nothing.
    """
    here = occurrences.where(" and ".join(f"`{v}` is not null" for _, v in order))
    left = entries.select(id, *keys, *(a for a, _ in order)).where(" and ".join(f"`{a}` is not null" for a, _ in order))
    group, gaps = list(keys), []
    for n, (a, v) in enumerate(order):
        left = materialize(_beside(left, here.select(*group, v).distinct(), group, a, v).withColumnRenamed("_gap", f"_gap{n}"), "beside")
        group, gaps = [*group, v], [*gaps, f"_gap{n}"]
    least = here.groupBy(*group).agg(F.min(value).alias(value))
    same = F.lit(True)
    for k in group:
        same = same & left[k].eqNullSafe(least[k])
    return left.join(least, same).groupBy(id).agg(F.min(F.struct(*gaps, least[value].alias("_x")))["_x"].alias(value))


def count_in_ranges(entries: DataFrame, marks: DataFrame, keys: list[str], id: str, start: str, end: str, pos: str) -> DataFrame:
    """(id, n): how many marks of its group lie in [start, end) of each entry: those before its end less those before its start.

    Entries and marks are sorted together and counted along; nothing is joined. Entries with a null bound count none.
    """
    bound = lambda c, sign: entries.select(*keys, F.col(id).alias("_id"), F.col(c).alias("_at"), F.lit(0).alias("_mark"), F.lit(sign).alias("_sign"))
    both = bound(start, -1).unionByName(bound(end, 1)).where("_at is not null")
    both = both.unionByName(marks.where(F.col(pos).isNotNull()).select(*keys, F.col(pos).alias("_at"), F.lit(1).alias("_mark")), allowMissingColumns=True)
    counted = running_values(both, keys, ["_at", "_mark"], {"_n": Fold("sum", F.col("_mark"))}).where("_mark = 0")
    found = counted.groupBy(F.col("_id").alias(id)).agg(F.sum(F.col("_n") * F.col("_sign")).alias("_n"))
    return entries.select(id).join(found, id, "left").select(id, F.coalesce("_n", F.lit(0)).cast("long").alias("n"))
