"""Text and record functions against plain versions."""

import json
import random
import re
import unicodedata

import pytest
from pyspark.sql import functions as F

from sievelake.functions import text as T
from sievelake.operators import graph as G
from sievelake.operators import records as R
from sievelake.operators import votes as V


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


def test_places_aside_from_spaces(spark):
    rng = random.Random(1)
    word = lambda n: "".join(rng.choice("ab. \n(\\*1é") for _ in range(rng.randint(0, n)))
    rows = [(i, word(40), word(4)) for i in range(400)] + [(900, None, "a"), (901, "a", None), (902, "a b", " "), (903, "x" * 5000 + " y", "x y")]
    for r in spark.createDataFrame(rows, "i int, t string, p string").select("i", "t", "p", T.find_ignoring_spaces(F.col("t"), F.col("p")).alias("s")).collect():
        want = None
        if r["t"] is not None and r["p"] is not None and (bare := re.sub(r"\s+", "", r["p"])):
            places = [i for i, c in enumerate(r["t"]) if not c.isspace()]
            at = "".join(r["t"][i] for i in places).find(bare)
            want = None if at < 0 else (places[at], places[at + len(bare) - 1] + 1)
        assert (tuple(r["s"]) if r["s"] else None) == want, r


def test_stretch_of_a_copy(spark):
    trim = lambda source, copies: tuple(one(spark, T.trim_formula(F.lit(source).cast("string"), F.array(*(F.lit(c) for c in copies)).cast("array<string>"))))
    assert trim("$ x :=  G_{[0, 5]} p. $", [None, "no", "G_{[0,5]}p.", "x"]) == ("G_{[0, 5]} p", True)
    assert trim(" $a \\label{eq} & b \\\\[2pt] c,$ ", ["zz", ""]) == ("a b c", False)
    assert trim("\\begin{align} a &= b \\nonumber \\\\ c &= d \\end{align}", ["b c"]) == ("b c", True)
    assert trim(None, []) == (None, False)
    # the map leads from the text without layout back to where each character stands
    rng = random.Random(3)
    parts = ["a", "b", " ", "\\,", "\\\\", "&", "$", "\\quad", "~", "\\label{x}", "é", "\\begin{a}"]
    rows = [(i, "".join(rng.choice(parts) for _ in range(rng.randint(0, 25)))) for i in range(200)]
    layout = re.compile(T.LAYOUT)
    for r in spark.createDataFrame(rows, "i int, t string").select("t", T.layout_map(F.col("t")).alias("m")).collect():
        assert "".join(r["m"]["tokens"]) == r["t"]
        assert "".join(r["m"]["tokens"][i] for i in r["m"]["places"]) == layout.sub("", r["t"])


def test_passages_as_they_are_compared(spark):
    core = lambda text: one(spark, T.passage_core(F.lit(text).cast("string")))
    assert core("a “b” \\varphi_{i} \\le 3 \\unknown") == "abφi≤3\\unknown" and core(None) is None and core("") == ""
    assert core("ﬁve − \\mathbf{x}\\%  well-\nknown ’s") == "fivex%wellknown's"
    rng = random.Random(5)
    rows = [(i, "".join(rng.choice("aé\u0301ﬁ½Å　−’\\ {x}") for _ in range(30))) for i in range(100)]
    same = str.maketrans(T.SAME)
    for r in spark.createDataFrame(rows, "i int, t string").select("t", T.passage_core(F.col("t")).alias("c")).collect():
        text = unicodedata.normalize("NFKC", r["t"]).translate(same)
        text = re.sub(r"\\([A-Za-z]+)", lambda m: T.PRINTED.get(m[1], m[0]), text)
        assert r["c"] == re.sub(T.PASSAGE_LAYOUT, "", re.sub(T.PASSAGE_MARKS, "", text))


@pytest.mark.parametrize("symbol, formula, found", [("x_3", "G (x_i > 2)", True), ("x_{3}", "x_1 + x_6", True), ("x_3", "max_i", False), ("y", "x", False), ("\\mathrm{in\\_room}", "in_room", True), ("q^2", "p + q^{k}", True), ("_1", "x", False)])
def test_symbols_of_a_family(spark, symbol, formula, found):
    assert one(spark, T.in_formula(F.lit(symbol), F.lit(formula))) is found


def test_passages_that_count(spark):
    given = F.array(*(F.struct(F.lit(x).cast("string").alias("text"), F.lit(k).alias("kind")) for x, k in [("a b", "x"), (" NULL ", "x"), ("ab", "y"), ("", "x"), ("None", "x"), (None, "x"), ("c", "z")]))
    assert [(p["text"], p["kind"]) for p in one(spark, T.given_passages(given))] == [("a b", "x"), ("c", "z")]


def test_disabled_blocks(spark):
    text = "a % \\iffalse\nb \\iffalse x % \\fi\n y \\fi c \\begin{comment}\n d\\end{comment}e \\% f"
    assert one(spark, T.strip_disabled(F.lit(text))) == "a \nb  c e \\% f"


def test_works(spark):
    work = lambda **more: one(spark, T.project_work(F.lit(json.dumps({"id": "https://openalex.org/W1", **more})))).asDict()
    assert work() == {"paper_id": "W1", "arxiv_id": None, "doi": None, "title": None, "year": None, "cited_by": 0, "is_oa": False, "pdf_mirrors": [], "licenses": []}
    found = work(ids={"arxiv": "https://arxiv.org/abs/math/0101001"}, locations=[{"license": "CC0", "landing_page_url": "https://arxiv.org/abs/2001.00001", "pdf_url": "u"}, {"license": None, "landing_page_url": None, "pdf_url": "u"}], open_access={"is_oa": True, "oa_url": "v"})
    assert (found["arxiv_id"], found["pdf_mirrors"], found["licenses"], found["is_oa"]) == ("math/0101001", ["u", "v"], ["cc0"], True)
    assert work(locations=[{"license": "", "landing_page_url": "https://arxiv.org/x", "pdf_url": "https://arxiv.org/pdf/2001.00001"}])["arxiv_id"] == "2001.00001"


def test_what_is_still_to_ask(spark):
    rows = [("W1", {"semantic_scholar": "no_answer"}, "d", None, "A title of twenty", "pending"), ("W2", {"semantic_scholar": "found", "hal": "not_found"}, "d", "", "short", "pending"), ("W3", None, "", "2001.1", "A title of twenty", "pending"), ("W4", {}, None, None, "short", "downloaded_pdf")]
    df = spark.createDataFrame(rows, "id string, l map<string,string>, doi string, arxiv string, title string, state string")
    ask = {s: {r["id"] for r in df.where(G.needs_lookup(F.col("l"), s, F.col("doi"), F.col("arxiv"), F.col("title"), F.col("state"))).collect()} for s in ("semantic_scholar", "arxiv_title", "hal")}
    assert ask == {"semantic_scholar": {"W1"}, "arxiv_title": {"W1"}, "hal": {"W1"}}
    papers = spark.createDataFrame([(1, "pending", None), (2, "unavailable", True), (3, "unavailable", None), (4, "downloaded_pdf", True)], "i int, state string, t boolean")
    assert [{r["i"] for r in G.download_queue(papers, "state", F.col("t"), m).collect()} for m in ("all", "transient")] == [{1, 2, 3}, {1, 2}]
    with pytest.raises(ValueError):
        G.download_queue(papers, "state", F.col("t"), "some")


def test_descriptions_link_by_file_and_text(spark):
    formulas = spark.createDataFrame([("h1", 0, "/x/f1.stl", "G p\n"), ("h2", 1, "/x/f2.stl", "F p"), ("h3", 2, None, None), ("h4", 3, "/y/f1.stl", "other")], "formula string, number int, path string, text string")
    pairs = spark.createDataFrame([("h1", 1, "b"), ("h1", 0, "a"), ("h4", 0, "c")], "formula string, realization int, nl string")
    manifest = spark.createDataFrame([("stl/f1.stl", "R7", " G p"), ("", "R8", "G p")], "file string, record string, text string")
    rows = R.described_rows(formulas, pairs, manifest)
    assert sorted((r["formula"], r["id"]) for r in rows.collect() if r["id"]) == [("h1", "R7:R0"), ("h1", "R7:R1"), ("h4", "stlnl_3:R0")]
    assert tuple(R.conversion_counts(rows).first()) == (4, 2, 1, 3)


def test_text_of_a_vote(spark):
    asked = spark.createDataFrame([(1, m) for m in "abc"], "item int, model string")
    given = spark.createDataFrame([(1, "a", "stop the car", "generic", False), (1, "b", "stop the car now", "generic", True), (1, "c", "stop the cars", "generic", True)], "item int, model string, text string, kind string, copy boolean")
    text = lambda g, prefer: V.requirement_vote(asked, g, "item", "model", "text", "kind", "copy", prefer).first()["passages"]
    assert text(given, []) == "stop the car now:generic" and text(given, ["c"]) == "stop the cars:generic" and text(given, ["a"]) == "stop the car now:generic"
    assert text(given.withColumn("copy", F.lit(None).cast("boolean")), ["c", "b"]) == "stop the cars:generic"


def test_alike_texts_by_bounds(monkeypatch):
    """Pairs that the bounds let through are those of the longest common subsequence, whatever the lengths and the way; pieces are difflib's."""
    import difflib
    import random

    from sievelake.functions import alike

    def longest(a, b):
        row = [0] * (len(b) + 1)
        for x in a:
            new = [0]
            for j, y in enumerate(b):
                new.append(row[j] + 1 if x == y else max(new[-1], row[j + 1]))
            row = new
        return row[-1]

    rng, texts = random.Random(3), []
    for n in (1, 4, 10, 30, 62, 63, 64, 70, 126, 127, 200) * 2:
        base = "".join(rng.choice("abcd éß") for _ in range(n))
        for edits in (0, n // 12, n // 8, n // 5):
            t = list(base)
            for _ in range(edits):
                t.insert(rng.randint(0, len(t)), rng.choice("abcx"))
                del t[rng.randrange(len(t))]
            texts.append("".join(t))
    near = lambda a, b: 200 * longest(a, b) >= 88 * (len(a) + len(b))
    want = {(i, j) for j in range(len(texts)) for i in range(j) if near(texts[i], texts[j])}
    assert len(want) > 60
    for few, held in ((0, 1 << 24), (16, 1 << 24), (0, 5000)):
        monkeypatch.setattr(alike, "FEW", few)
        monkeypatch.setattr(alike, "BITS_BYTES", held)
        found = [tuple(sorted(p)) for p in alike.alike_pairs(texts, None, 88).T.tolist()]
        assert set(found) == want and len(found) == len(want)
        cut = {tuple(p) for p in alike.alike_pairs(texts[:30], texts[30:], 88).T.tolist()}
        assert cut == {(i, j - 30) for i, j in want if i < 30 <= j}
    for i, j in sorted(want)[::3]:
        for a, b in ((texts[i], texts[j]), (texts[j], texts[i]), (texts[i] * 5, texts[j] * 4)):
            n = sum(k.size for k in difflib.SequenceMatcher(None, a, b, autojunk=False).get_matching_blocks())
            assert alike.matched(a, b) == n == alike.matched(a, b, n) and alike.matched(a, b, n + 1) == -1


def test_titles_of_one_language_are_compared_in_time(spark):
    """Long titles of the same few syllables share nearly all trigrams; a table of pairs by shared trigrams would have millions of rows."""
    import difflib
    import random
    import time

    from sievelake.operators.fuzzy import fuzzy_title_join

    rng, rows = random.Random(5), []
    word = lambda: "".join(rng.choice(["the", "an", "ed", "er", "on", "ti", "ha", "re"]) for _ in range(rng.randint(1, 4)))
    rows = [(i, " ".join(word() for _ in range(40))) for i in range(1500)]
    rows += [(1500 + k, rows[7 * k][1].replace("the", "teh", 2)) for k in range(40)] + [(1600, "".join(word() for _ in range(4000)))]
    rows.append((1601, rows[-1][1][:9000] + "x" + rows[-1][1][9000:]))
    began = time.time()
    found = {r["other"]: (r["id"], r["ratio"]) for r in fuzzy_title_join(spark.createDataFrame(rows, "id long, title string"), "id", "title").collect()}
    assert time.time() - began < 120
    assert {k: v[0] for k, v in found.items()} == {1500 + k: 7 * k for k in range(40)} | {1601: 1600}
    for k in (1500, 1539):
        assert found[k][1] == difflib.SequenceMatcher(None, rows[found[k][0]][1], rows[k][1], autojunk=False).ratio()
