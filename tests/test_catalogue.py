"""The stored catalogue, stored components and bucketed tables."""

import random

from pyspark.sql import functions as F

from sievelake.operators import catalogue as K
from sievelake.operators import graph as G
from sievelake.operators import records as R
from sievelake.scratch import materialize, scratch_path
from sievelake.sources.buckets import BucketStore

BLANK = {"arxiv_id": None, "doi": None, "title": None, "alternate_ids": [], "alternate_dois": [], "cited_by": 0, "is_oa": False, "methods": [], "hop": None, "parent_ids": [], "pdf_mirrors": [], "lookups": {}, "status": "pending"}


def paper(paper_id, **more):
    return {"paper_id": paper_id, **BLANK, **more}


def frame(spark, rows, seq=False):
    names = [c.strip().split()[0] for c in K.SCHEMA.replace("map<string,string>", "map").split(", ")]
    schema = K.SCHEMA + (", seq long" if seq else "")
    return spark.createDataFrame([tuple(r[n] for n in names) + ((i,) if seq else ()) for i, r in enumerate(rows)], schema)


def store(spark, rows):
    s = BucketStore(spark, scratch_path(spark, "catalogue"), K.SCHEMA, ["paper_id"], buckets=8)
    s.change(materialize(frame(spark, rows), "known"))
    return s


def table(s):
    return {r["paper_id"]: r.asDict() for r in s.read().collect()}


LONG = "A title of more than sixteen letters"


def test_keys_by_strength(spark):
    known = [paper("W1", doi="10.1/A", title=LONG, hop=2), paper("W2", alternate_ids=["X2"], cited_by=3), paper("W3", arxiv_id="2001.00001"), paper("W4", title=LONG + "!")]
    new = [
        paper("W1", title="other", methods=["m"], hop=1), paper("X2", cited_by=9), paper("N3", arxiv_id="2001.00001", pdf_mirrors=["u"]), paper("N4", doi="10.1/a"), paper("N5", title=LONG.upper()), paper("N6", title="short"), paper("N7", title="short"),
        paper("N8", arxiv_id="2002.2", title="Some quite different title"), paper("N9", title="some quite different TITLE"), paper("", doi="", arxiv_id=""),
    ]
    s = store(spark, known)
    assert K.upsert(s, frame(spark, new, seq=True)) == {"incoming": 10, "added": 4, "changed": 7, "buckets": s_touched(s)}
    found = table(s)
    assert set(found) == {"W1", "W2", "W3", "W4", "N6", "N7", "N8", ""}
    assert found["W1"]["methods"] == ["m"] and found["W1"]["hop"] == 1 and found["W1"]["doi"] == "10.1/A"
    assert found["W2"]["cited_by"] == 9 and found["W3"]["pdf_mirrors"] == ["u"] and found["N8"]["arxiv_id"] == "2002.2"


def s_touched(s):
    """Buckets of the last change."""
    last = max(n for n, _ in s.versions().values())
    return sum(n == last for n, _ in s.versions().values())


def test_same_records_again_change_nothing(spark):
    rng = random.Random(4)
    some = lambda p, n: rng.choice([None, f"{p}{rng.randrange(n)}"])
    make = lambda i: paper(f"{rng.choice('WP')}{i}", arxiv_id=some("a", 12), doi=some("10.", 12), title=rng.choice([None, f"the long common title {rng.randrange(9)}"]), cited_by=rng.randrange(9), methods=[rng.choice("xyz")], parent_ids=[f"W{rng.randrange(40)}"], lookups={rng.choice("st"): rng.choice(["no_answer", "found"])})
    s = store(spark, [make(i) for i in range(25)])
    new = frame(spark, [make(i) for i in range(20, 50)], seq=True)
    assert K.upsert(s, new)["changed"] > 0
    before, versions = table(s), s.versions()
    again = K.upsert(s, new)
    assert again["changed"] == again["added"] == again["buckets"] == 0
    assert table(s) == before and s.versions() == versions


def test_an_arxiv_id_of_another_makes_one_work(spark):
    known = [paper("arxiv_1", arxiv_id="a1", lookups={"s": "found", "t": "no_answer"}, status="downloaded_latex", methods=["k"]), paper("W9", doi="10.1/x", lookups={"s": "no_answer", "t": "not_found"}, methods=["w"], alternate_ids=["old"]), paper("W5", parent_ids=["arxiv_1", "W9", "W5"]), paper("W6")]
    s = store(spark, known)
    before = s.versions()
    assert K.upsert(s, frame(spark, [paper("W9", arxiv_id="a1", methods=["n"])], seq=True))["added"] == 0
    found = table(s)
    assert set(found) == {"W9", "W5", "W6"}  # the published record is kept
    w = found["W9"]
    assert (w["arxiv_id"], w["status"], w["alternate_ids"], w["methods"]) == ("a1", "downloaded_latex", ["arxiv_1", "old"], ["w", "k", "n"])
    assert w["lookups"] == {"s": "found", "t": "not_found"} and found["W5"]["parent_ids"] == ["W9"]
    of = lambda p: spark.range(1).select(F.pmod(F.xxhash64(F.lit(p)), F.lit(8)).alias("b")).first()["b"]
    assert of("W6") in {of(p) for p in ("W9", "W5", "arxiv_1")} or s.versions()[of("W6")] == before[of("W6")]  # an untouched bucket is not written


def test_bucket_store(spark):
    s = BucketStore(spark, scratch_path(spark, "store"), "k long, v string", ["k"], buckets=4)
    assert s.read().count() == 0 and s.versions() == {}
    s.change(spark.createDataFrame([(i, "a") for i in range(20)], "k long, v string"))
    touched = s.change(spark.createDataFrame([(3, "b")], "k long, v string"), spark.createDataFrame([(5,)], "k long"))
    assert len(touched) <= 2 and {r["k"]: r["v"] for r in s.read().collect()} == {i: "b" if i == 3 else "a" for i in range(20) if i != 5}
    s.change(spark.createDataFrame([], "k long, v string"), spark.range(20).select(F.col("id").alias("k")))
    assert s.read().count() == 0 and s.change(spark.createDataFrame([], "k long, v string")) == []


def test_components_grow_as_a_whole_run_would(spark):
    rng, edges, labels = random.Random(8), [], spark.createDataFrame([], "node long, component long")
    for _ in range(4):
        batch = [(rng.randrange(60), rng.randrange(60)) for _ in range(9)] + [(None, 1), (5, 5)]
        edges += batch
        changed = materialize(G.extend_components(labels, spark.createDataFrame(batch, "a long, b long"), "a", "b"), "changed")
        assert not labels.join(changed, ["node", "component"]).count()  # labels that stay are not given
        labels = materialize(labels.join(changed.select("node"), "node", "left_anti").unionByName(changed), "labels")
        whole = {r["node"]: r["component"] for r in G.connected(spark.createDataFrame(edges, "a long, b long"), "a", "b").collect()}
        grown = {r["node"]: r["component"] for r in labels.collect()}
        assert {n: c for n, c in grown.items() if n in whole} == whole and all(n == c for n, c in grown.items() if n not in whole)


def test_lookups_and_ordered_unions(spark):
    rows = [("g", 2, ["b", "a"], {"s": "found", "t": "no_answer"}), ("g", 1, ["c", "b"], {"s": "no_answer", "t": "no_answer"}), ("g", 3, None, {"t": "not_found"}), ("h", 1, [], {})]
    for order in (rows, rows[::-1]):
        df = spark.createDataFrame(order, "g string, n int, m array<string>, l map<string,string>")
        assert {r["g"]: r["l"] for r in R.merged_lookups(df, "g", "l", "n").collect()} == {"g": {"s": "found", "t": "not_found"}}
        assert {r["g"]: r["m"] for r in R.ordered_union(df, "g", "m", "n").collect()} == {"g": ["c", "b", "a"]}
