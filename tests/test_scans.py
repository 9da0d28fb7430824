"""Running values against plain loops, with groups over many ranges."""

import random

import pytest
from pyspark.sql import functions as F

from sievelake.operators import answers as A
from sievelake.operators import scans as C
from sievelake.operators import select as S
from sievelake.operators import spans as N
from sievelake.scratch import materialize


@pytest.fixture
def many(spark):
    spark.conf.set("spark.sql.shuffle.partitions", "13")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield spark
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def log(seed=0, n=400):
    """One group holds most rows, another has a null key."""
    rng = random.Random(seed)
    return [(rng.choice(["hot", "hot", "hot", "hot", "b", None]), i, rng.choice([None, *range(50)])) for i in rng.sample(range(10 * n), n)]


@pytest.mark.parametrize("backward", [False, True])
def test_running_values(many, backward):
    rows = log()
    df = many.createDataFrame(rows, "g string, seq long, v long").repartition(5)
    folds = {f"{k}{i}": C.Fold(k, F.col("v"), inclusive=bool(i)) for k in ("sum", "max", "last") for i in (0, 1)}
    dealt = C.ranges(df, ["g"], ["seq"])
    assert dealt.where("g = 'hot'").select("_range").distinct().count() > 5
    found = {(r["g"], r["seq"]): r for r in C.running(dealt, ["g"], ["seq"], folds, backward).collect()}
    assert len(found) == len(rows)
    for g in ("hot", "b", None):
        total = most = last = None
        for _, seq, v in sorted((r for r in rows if r[0] == g), key=lambda r: -r[1] if backward else r[1]):
            r = found[g, seq]
            assert (r["sum0"], r["max0"], r["last0"]) == (total, most, last)
            if v is not None:
                total, most, last = (total or 0) + v, v if most is None else max(most, v), v
            assert (r["sum1"], r["max1"], r["last1"]) == (total, most, last)


def test_no_window_over_a_whole_group(many):
    """The windows of the operators are over a group's range, or over one row per range."""
    df = many.createDataFrame(log(), "g string, seq long, v long")
    pages = df.select("g", "seq", F.col("v").cast("string").alias("t"))
    for out in (A.budget_cut(df, "g", "seq", "v", 50), A.log_runs(df, "g", "seq", F.col("v") > 40), A.cooldown_answers(df.withColumn("ts", F.timestamp_seconds("seq")), ["g"], "seq", "ts", F.col("v") > 40, F.col("v") < 10), N.page_context(pages, "g", "seq", "t", 3)):
        plan = out._jdf.queryExecution().optimizedPlan().toString()
        windows = [line for line in plan.splitlines() if "windowspecdefinition(" in line]
        assert windows and all("_range" in line or "_r#" in line for line in windows)


def test_windows_of_one_group(many):
    rng = random.Random(5)
    spans = [("hot", a, a + rng.randrange(60)) for a in rng.sample(range(6000), 300)] * 2
    found = sorted(map(tuple, N.merge_windows(many.createDataFrame(spans, "g string, a long, b long").repartition(4), ["g"], "a", "b", 20, 3).collect()))
    runs, reach = [], None
    for _, a, b in sorted(spans):
        if reach is None or a > reach + 20:
            runs.append([])
        runs[-1].append((a, b))
        reach = b if reach is None else max(reach, b)
    want = []
    for n, run in enumerate(runs, 1):
        chunks = -(-len(run) // 3)
        for c in range(chunks):
            part = [x for i, x in enumerate(run) if i * chunks // len(run) == c]
            if part:
                want.append(("hot", n, c, min(a for a, _ in part), max(b for _, b in part), len(part)))
    assert found == sorted(want)


def test_page_context(many):
    pages = [("d", i, None if i % 7 == 0 else f"page {i}") for i in range(60)] + [("e", 0, "only")]
    found = {(r["d"], r["p"]): (r["context"], r["offset"]) for r in N.page_context(many.createDataFrame(pages, "d string, p long, t string"), "d", "p", "t", 4).collect()}
    text = lambda i: "" if not 0 <= i < 60 else pages[i][2] or ""
    assert found["e", 0] == ("only", 0)
    assert all(found["d", i] == (text(i - 1)[-4:] + text(i) + text(i + 1)[:4], len(text(i - 1)[-4:])) for i in range(60))


def test_nearest_against_all_pairs(many):
    rng = random.Random(9)
    entries = [(i, rng.choice("abcd"), float(rng.randrange(30)), rng.randrange(40)) for i in range(120)] + [(500, "a", None, 1)]
    marks = [(1000 + i, rng.choice("abc"), float(rng.randrange(30)), rng.randrange(40)) for i in range(90)] + [(2000, "a", 1.0, None)]
    found = C.nearest(many.createDataFrame(entries, "id long, g string, x double, line long"), many.createDataFrame(marks, "m long, g string, v double, at long"), ["g"], "id", [("x", "v"), ("line", "at")], "m")
    want = {}
    for i, g, x, line in entries:
        near = [(abs(v - x), abs(at - line), m) for m, h, v, at in marks if h == g and x is not None and at is not None]
        if near:
            want[i] = min(near)[2]
    assert {r["id"]: r["m"] for r in found.collect()} == want


def test_counts_in_ranges(many):
    rng = random.Random(2)
    entries = [(i, rng.choice("ab"), a, a + rng.randrange(20)) for i, a in enumerate(rng.sample(range(200), 80))] + [(900, "a", None, None)]
    marks = [(rng.choice("abc"), rng.randrange(200)) for _ in range(150)]
    found = C.count_in_ranges(many.createDataFrame(entries, "id long, g string, a long, b long"), many.createDataFrame(marks, "g string, m long"), ["g"], "id", "a", "b", "m")
    assert {r["id"]: r["n"] for r in found.collect()} == {i: sum(h == g and a is not None and a <= m < b for h, m in marks) for i, g, a, b in entries}


def test_quota_ranks_no_rest(many):
    df = materialize(many.range(500).withColumnRenamed("id", "k"), "quota")
    found = S.quota_sample(df, "k", [("tens", F.col("k") % 10 == 0, 7), ("odd", F.col("k") % 2 == 1, 5)], 20)
    rows = found.collect()
    assert len(rows) == len({r["k"] for r in rows}) == 20
    assert sum(r["class"] == "tens" for r in rows) == 7 and all(r["k"] % 2 == 1 for r in rows if r["class"] == "odd")
    assert "Window" not in found._jdf.queryExecution().optimizedPlan().toString()


def test_examples_are_chosen_greedily(many):
    rng = random.Random(6)
    rows = [(i, rng.choice("rst"), rng.choice("aabc"), rng.choice("uvw" if i % 2 else "u")) for i in rng.sample(range(500), 40)] + [(900, "q", "a", "u"), (901, "q", "b", "u"), (902, "q", "b", "u"), (903, None, "a", None), (904, None, "b", None)]
    found = {}
    for r in S.diverse_examples(many.createDataFrame(rows, "pos long, rule string, kind string, paper string"), "rule", "kind", "paper", "pos").collect():
        found.setdefault(r["rule"], []).append((r["choice"], r["pos"]))
    for rule in "rstq":
        mine = sorted(r for r in rows if r[1] == rule)
        kinds = sorted({k for _, _, k, _ in mine}, key=lambda k: (-sum(x[2] == k for x in mine), min(x[0] for x in mine if x[2] == k)))
        chosen, papers = [], set()
        for group in [[r for r in mine if r[2] == k] for k in kinds] + [mine] * 3:
            pool = [r for r in group if r[3] not in papers]
            if pool and len(chosen) < 3:
                chosen.append(pool[0][0])
                papers.add(pool[0][3])
        assert [p for _, p in sorted(found[rule])] == chosen
