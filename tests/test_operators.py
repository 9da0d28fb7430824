"""Truth tables and cases of single operators on small inline frames."""

import collections
import difflib
import itertools
import pathlib
import random
import shutil
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

from sievelake.functions import licensing as L
from sievelake.functions import passages as H
from sievelake.functions import scan as X
from sievelake.functions import text as T
from sievelake.operators import answers as A
from sievelake.operators import fuzzy
from sievelake.operators import graph as G
from sievelake.operators import records as R
from sievelake.operators import select as S
from sievelake.operators import spans as N
from sievelake.operators import votes as V


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


LABELS = ["correct", "ambiguous", "wrong", "no", None]


def expected_vote(a, b, third):
    """The vote, written as cases over how often each label is given."""
    if a is None or b is None:
        return None, "unjudged"
    if a == b:
        return a, "agreed"
    if third is None:
        return None, "disputed"
    twice = [x for x in (a, b) if x == third]
    if twice:
        return third, "third decides"
    return ("ambiguous", "middle one") if "no" not in (a, b, third) else (None, "undecided")


def test_label_vote(spark):
    cases = [(i, a, b, c) for i, (a, b, c) in enumerate(itertools.product(LABELS, repeat=3))]
    votes = spark.createDataFrame(cases, "i int, a string, b string, c string").select("i", V.label_vote(F.col("a"), F.col("b"), F.col("c")).alias("v"))
    assert {r["i"]: (r["v"]["label"], r["v"]["how"]) for r in votes.collect()} == {i: expected_vote(*x) for i, *x in cases}


@pytest.mark.parametrize("text, template", [
    ("F[2,8] (speed >= 40 && U_1 < 7.5)", "F[#,#] (a >= # && b < #)"), ("(F[2,8] (speed > 1)) && (G[0,inf] (speed < 90))", "(F[#,#] (a > #)) && (G[#,inf] (a < #))"),
    ("door R[0,tau) alarm", "a R[#,#) b"), ("true -> !lamp", "true -> !a"), (" || ".join(f"k{i}" for i in range(30)), " || ".join([*map(chr, range(97, 123)), "v27", "v28", "v29", "v30"])),
])
def test_template(spark, text, template):
    assert one(spark, T.template_of(F.lit(text))) == template


@pytest.mark.parametrize("pattern, tokens", [("!p && (q U[0,3] r)", ["!", "&&", "U"]), ("(a <-> b) || G[1,2] F[3,4] a", ["<->", "||", "G", "F"]), ("Gap -> Flag", ["->"]), ("x", [])])
def test_pattern_tokens(spark, pattern, tokens):
    assert one(spark, T.pattern_tokens(F.lit(pattern))) == tokens


def test_duplicates_point_to_the_first(spark):
    rng = random.Random(3)
    rows = [(i, f"n{i}", rng.choice(["ok", "ok", "bad"]), rng.choice(["one text", "another", "a third", None])) for i in range(80)]
    rng.shuffle(rows)
    marked = S.mark_duplicates(spark.createDataFrame(rows, "pos long, id string, state string, text string"), "text", "id", "pos", F.col("state") == "ok")
    first = {}
    for _, id_, state, text in sorted(rows):
        if state == "ok" and text is not None:
            first.setdefault(text, id_)
    want = {i: first[t] if s == "ok" and t is not None and first[t] != i else None for _, i, s, t in rows}
    assert {r["id"]: r["duplicate_of"] for r in marked.collect()} == want


@pytest.mark.parametrize("most", [1, 4, 7])
def test_cap_takes_sources_in_turn(spark, most):
    rng = random.Random(most)
    rows = [(i, f"g{rng.randrange(3)}", f"s{min(rng.randrange(9), 4)}") for i in range(120)]
    df = spark.createDataFrame(rows, "id long, grp string, src string")
    found = {r["id"]: r["selection"] for r in S.cap_per_group(df, "grp", "src", "id", most).collect()}
    for g in {g for _, g, _ in rows}:
        mine = [(i, s) for i, x, s in rows if x == g]
        kept = collections.Counter(s for i, s in mine if found[i] == "kept")
        sizes = collections.Counter(s for _, s in mine)
        assert sum(kept.values()) == min(most, len(mine))
        assert all(kept[a] >= kept[b] - 1 for a in sizes for b in sizes if kept[a] < sizes[a])  # no source is ahead by two
    assert found == {r["id"]: r["selection"] for r in S.cap_per_group(df.repartition(5), "grp", "src", "id", most).collect()}
    assert {r["selection"] for r in S.cap_per_group(df, "grp", "src", "id", 0).collect()} == {"kept"}


def test_larger_sample_holds_smaller(spark):
    df = spark.range(200).withColumnRenamed("id", "k")
    small, large = ({r["k"] for r in S.stable_sample(df, "k", n).collect()} for n in (10, 40))
    assert small < large


def test_latest_answer(spark):
    log = spark.createDataFrame([("a", 1, True, "k1"), ("a", 2, False, "k1"), ("b", 3, False, "k1"), ("b", 4, False, "k2"), ("c", 5, True, "k1"), ("c", 6, False, "k2")], "item string, seq long, ok boolean, key string")
    assert {r["item"]: r["seq"] for r in A.latest_answer(log, ["item"], "seq", F.col("ok")).collect()} == {"a": 1, "b": 3, "c": 5}
    assert {r["item"]: r["seq"] for r in A.latest_usable(log, ["item"], "seq", F.col("ok"), "key").collect()} == {"a": 1, "b": 4, "c": 6}


def test_merge_is_transitive(spark):
    keys = spark.createDataFrame([("A", "doi:1"), ("B", "doi:1"), ("B", "arxiv:7"), ("C", "arxiv:7"), ("D", None), ("E", ""), ("F", "")], "id string, key string")
    found = {r["id"]: r["component"] for r in G.merge_groups(keys, "id", "key").collect()}
    assert found == {"A": "A", "B": "A", "C": "A", "D": "D", "E": "E", "F": "F"}


@pytest.mark.parametrize("names, tier", [(["cc-by", "cc-by-nc"], "restricted_cc"), ([], "unspecified"), (["CC-BY"], "permissive_cc"), (["publisher"], "custom_or_arxiv")])
def test_tier(spark, names, tier):
    assert one(spark, L.license_tier(F.array(*(F.lit(n) for n in names)).cast("array<string>"))) == tier


def test_license_in_comment_does_not_count(spark):
    text = F.lit("% licensed CC BY 4.0\nbody \\% CC-BY-SA\n")
    assert one(spark, L.detect_license(T.strip_comments(text))) == "cc-by-sa"
    assert one(spark, L.detect_license(T.strip_comments(F.lit("% CC BY 4.0")))) is None


@pytest.mark.parametrize("text, english", [("The car must stop within 5 s.", True), ("le système doit et les", False), ("", True), ("для машины всегда", False), ("şu ğı ış", False)])
def test_english(spark, text, english):
    assert one(spark, T.is_english(F.lit(text))) is english


def test_windows(spark):
    df = spark.createDataFrame([("f", 0, 100), ("f", 300, 400), ("f", 601, 700)], "f string, a long, b long")
    assert sorted((r["a"], r["b"]) for r in N.merge_windows(df, ["f"], "a", "b").collect()) == [(0, 400), (601, 700)]
    many = spark.createDataFrame([("f", i * 10, i * 10 + 5) for i in range(16)], "f string, a long, b long")
    assert [r["n"] for r in N.merge_windows(many, ["f"], "a", "b").collect()] == [8, 8]


def test_heading_of_a_higher_level_resets(spark):
    points = spark.createDataFrame([("f", 5), ("f", 15), ("f", 25)], "f string, pos long")
    heads = spark.createDataFrame([("f", 0, 0, "A"), ("f", 10, 1, "a"), ("f", 20, 0, "B")], "f string, pos long, level int, title string")
    found = N.asof_heading(points, heads, ["f"], "pos", "level", "title", 2)
    assert {r["pos"]: r["section"] for r in found.collect()} == {5: ["A"], 15: ["A", "a"], 25: ["B"]}


def test_paraphrases_keep_their_number(spark):
    df = spark.createDataFrame([("p", "x", ["x", "y", "y", "z"])], "id string, nl string, more array<string>")
    assert sorted((r["id"], r["text"]) for r in R.augmented_pairs(df, "id", "nl", "more").collect()) == [("p:A2", "y"), ("p:A4", "z")]


def test_missing_symbol(spark):
    assert one(spark, T.missing_symbols(F.lit("Within 25 s phi holds"), F.lit("In 25 s it holds"), F.lit("G[0,25] phi"))) == ["phi"]


def pieces(text, source, most=3, least=15):
    """The pieces by trying every length, longest first."""
    text, source = "".join(text.split()), "".join(source.split())
    n = 0
    while text:
        size = next((k for k in range(len(text), 0, -1) if text[:k] in source), 0)
        n += 1
        if not size or (size < least and size < len(text)) or n > most:
            return 0
        source, text = source[source.index(text[:size]) + size :], text[size:]
    return n


def test_passages():
    rng = random.Random(0)
    assert H.common_length("ab cd ef", "xxcdefyy") == 4
    letters = "abcdefghijklmnopqrstuvwxyz"
    assert H.pieces_in_order(letters + "12345", letters + "___12345") == 2  # a short last piece counts
    assert H.pieces_in_order("", "x") == 0 and H.pieces_in_order("not there at all", "something else") == 0
    for _ in range(400):
        source = "".join(rng.choice("ab") for _ in range(60))
        cuts = sorted(rng.sample(range(61), 6))
        text = "".join(source[a:b] for a, b in zip(cuts[::2], cuts[1::2])) + rng.choice(["", "a", "c"])
        for least in (1, 4, 15):
            assert H.pieces_in_order(text, source, least=least) == pieces(text, source, least=least)


def test_passages_as_compared(spark):
    text = F.lit("always within ten seconds, the (brake) is applied: G")
    pieces_of = lambda passage: one(spark, H.ordered_pieces(F.lit(passage), text))
    assert pieces_of("(always  within ten\nseconds.") == 1 and pieces_of(" .() ") == 1 and pieces_of(None) == 1
    assert pieces_of("always within ten the (brake) is applied") == 2 and pieces_of("never within ten") == 0


def test_groups_of_passages():
    assert H.grouped(["abcdef", "xyz", "abcdefgh", "xyzzz", "ab", ""]) == [0, 1, 0, 1, 0, 2]


def test_vote_and_score(spark):
    asked = spark.createDataFrame([(i, m) for i in range(4) for m in "abc"], "item int, model string")
    given = spark.createDataFrame([
        (0, "a", "stop the car", "generic"), (0, "b", "stop the car now", "generic"), (0, "c", "go home", "specific"), (0, "a", "go home again", "specific"),
        (1, "a", "one text", "specific"), (1, "b", "one text", "generic"), (2, "a", "alone", "specific"), (3, "a", "alone", "generic"), (3, "a", "alone now", "generic"), (3, "b", "else", "generic"),
    ], "item int, model string, text string, kind string")
    found = {r["item"]: (r["outcome"], r["passages"]) for r in V.requirement_vote(asked, given.withColumn("copy", F.lit(None).cast("boolean")), "item", "model", "text", "kind", "copy", []).collect()}
    assert found == {0: ("requirement", "go home again:specific"), 1: ("requirement", "one text:unclear"), 2: ("none", ""), 3: ("open", "")}
    labelled = spark.createDataFrame([(0, "the long passage", "specific"), (1, "abcd", "generic"), (1, "wxyz", "generic"), (2, "abcd", "generic"), (3, "abcdefghij", "generic")], "i int, text string, kind string")
    answer = spark.createDataFrame([(0, "the long", "specific"), (1, "abcd", "specific"), (2, "qqqq", "generic"), (3, "abcdefghij.", "generic"), (4, "new", "generic")], "i int, text string, kind string")
    scores = {r["i"]: tuple(r)[1:] for r in V.score_entries(labelled, answer, "i", "text", "kind").collect()}
    assert scores == {0: ("overlap", 1, 0, 1), 1: ("partly", 1, 0, 0), 2: ("other", 0, 1, 0), 3: ("exact", 1, 0, 1), 4: ("invented", 0, 1, 0)}


def test_numbers_within_ranges(spark):
    rng = random.Random(0)
    rows = [(rng.choice("aaaab"), rng.randrange(10**6), None if rng.random() < 0.1 else "x") for _ in range(500)]
    df = spark.createDataFrame(rows, "g string, k long, n string")
    found = sorted(tuple(r) for r in S.number_rows(df, ["g"], ["k"], "number").select("g", "k", "number").collect())
    want = []
    for g in "ab":
        want += [(g, k, i + 1) for i, k in enumerate(sorted(k for x, k, _ in rows if x == g))]
    assert found == want


def test_fuzzy_titles_against_all_pairs(spark):
    rng = random.Random(1)
    words = ["signal", "temporal", "logic", "of", "a", "robust", "control", "für", "42", "learning"]
    titles = [" ".join(rng.choice(words) for _ in range(rng.randint(0, 9))) for _ in range(40)]
    rows = []
    for i in range(160):
        t = list(rng.choice(titles))
        for _ in range(rng.choice([0, 0, 1, 2, 4])):
            t.insert(rng.randint(0, len(t)), rng.choice("abc xyz"))
            del t[rng.randrange(len(t))]
        rows.append((i, "".join(t).title() + rng.choice(["", "!", "?"]), "x"))
    rows += [(200 + i, t, "x") for i, t in enumerate(["abcd", "abxcd", "abcx", "abc", None, "", "--", "a b", "ab", "abcde", "abcdef", "bcdef"])] + [(None, "abcd", "x"), (3, rows[3][1], "x")]
    clean = lambda t: "".join(c.lower() for c in (t or "") if c.isalnum() or c == " ")
    known = sorted({(i, clean(t)) for i, t, _ in rows if i is not None})
    want = {}
    for j, (other, b) in enumerate(known):
        hits = (i for i, a in known[:j] if a == b or difflib.SequenceMatcher(None, a, b, autojunk=False).ratio() >= 0.88)
        if (first := next(hits, None)) is not None:
            want[other] = first
    df = spark.createDataFrame(rows, "doc_id long, title string, ratio string")
    found = fuzzy.fuzzy_title_join(df, "doc_id", "title").collect()
    assert {r["other"]: r["doc_id"] for r in found} == want and len(found) == len(want) > 60
    assert fuzzy.fuzzy_title_join(df.where("false"), "doc_id", "title").count() == 0


def test_long_chains_take_few_rounds(spark, monkeypatch):
    rounds = collections.Counter()
    plain = G.materialize
    monkeypatch.setattr(G, "materialize", lambda df, name: (rounds.update([name]), plain(df, name))[1])
    edges = spark.createDataFrame([(i, i + 1) for i in range(2000)] + [(9000, 9001), (9001, 9001), (None, 3)], "a long, b long")
    found = {r["node"]: r["component"] for r in G.connected(edges, "a", "b").collect()}
    assert found == {**dict.fromkeys(range(2001), 0), 9000: 9000, 9001: 9000}
    assert rounds["labels"] < 20 and rounds["hook"] < 40


def test_hub_key_leads_to_the_least_record(spark):
    known = spark.createDataFrame([(i, "doi", "hub") for i in range(50)] + [(7, "title", "t")], "old long, type string, key string")
    new = spark.createDataFrame([(100 + i, "doi", "hub") for i in range(50)] + [(100, "title", "t"), (300, "title", "none")], "new long, type string, key string")
    found = {r["new"]: (r["old"], r["matched_by"]) for r in G.upsert_match(new, known, "new", "old", "type", "key", ["doi", "title"]).collect()}
    assert found == {**{100 + i: (0, "doi") for i in range(50)}, 300: (None, None)}


def test_entry_without_the_optional_parts(tmp_path):
    """The entry point imports, with all other queries, where the optional folders are deleted, with and without the pipeline."""
    import __spark_entry__ as entry

    here = entry.__file__.rsplit("/", 1)[0]
    shutil.copytree(f"{here}/sievelake", tmp_path / "sievelake", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    code = "import __spark_entry__ as e; q = e.queries(); assert q and not any(k.startswith('op') or k == 'pipeline' for k in q); assert set(e.oracle_sql()) <= set(q); print(len(q))"
    for name in ("__spark_entry__.py", "corpus_pipeline.py"):
        if not (source := pathlib.Path(here, name)).exists():
            continue
        shutil.copy(source, tmp_path)
        done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, timeout=120)
        assert done.returncode == 0 and int(done.stdout) > 100, done.stderr


def test_scan():
    files = {"main.tex": r"\begin{document}\input{b}\end{document}", "b.tex": r"\newcommand{\alw}{\red{\square}} $\alw_{[0, 5]} p \\ q \wedge \\ \Box_{[a, b)} r$", "old.tex": "x"}
    macros = X.temporal_macros(list(files.values()))
    assert macros == {"alw"} and X.document_files(files) == {"main.tex", "b.tex"}
    found = X.operators(files["b.tex"], macros)
    assert [k for _, k in found] == ["concrete"]
    assert len(X.units(files["b.tex"])) == 2


def test_judgment(spark):
    good = '{"judgments":[{"id":"D1","describes":"yes","faithful":"correct"},{"id":"D2","describes":"no"}]}'
    assert one(spark, T.validate_judgment(F.lit(good), F.lit(2))) is None
    assert one(spark, T.validate_judgment(F.lit("```json\n" + good + "\n```"), F.lit(2))) is None
    assert one(spark, T.validate_judgment(F.lit(good), F.lit(3))) == "ids differ"
    assert one(spark, T.validate_judgment(F.lit("yes"), F.lit(1))) == "not the expected JSON"
    assert one(spark, T.validate_judgment(F.lit('{"judgments":[],"x":1}'), F.lit(1))) == "another key"


def test_streamed_log_equals_batch(spark, tmp_path):
    from sievelake.streaming.ingest import ingest

    rows = [(i % 3, i, i % 4 != 0) for i in range(24)]
    found = None
    for n, part in enumerate((rows[12:], rows[:5], rows[5:12])):  # files need not come in order
        spark.createDataFrame(part, "item long, seq long, ok boolean").coalesce(1).write.mode("append").json(str(tmp_path / "log"))
        (tmp_path / "log" / f"bad{n}.json").write_text('{"item": 1, "seq"\n\nnot JSON\n')
        found = ingest(spark, str(tmp_path / "log"), "item long, seq long, ok boolean", str(tmp_path / "state"), str(tmp_path / "marks"), ["item"], "seq", F.col("ok"))
    want = A.latest_answer(spark.createDataFrame(rows, "item long, seq long, ok boolean"), ["item"], "seq", F.col("ok"))
    assert sorted(found.select("item", "seq").collect()) == sorted(want.select("item", "seq").collect())


def test_point_in_interval_falls_back_to_null(spark):
    points = spark.createDataFrame([("f", 5), ("f", 1500), ("g", 5)], "f string, pos long")
    spans = spark.createDataFrame([("f", 0, 2000), ("f", 4, 6)], "f string, a long, b long")
    found = {(r["f"], r["pos"]): (r["a"], r["b"]) for r in N.point_in_interval(points, spans, ["f"], "pos", "a", "b").collect()}
    assert found == {("f", 5): (0, 2000), ("f", 1500): (0, 2000), ("g", 5): (None, None)}
