"""Registered queries against their SQL, and the pipeline's stages against brute force."""

import re

import pytest
from pyspark.sql import functions as F

from sievelake.llm.queries import ORACLES, QUERIES

from ..compare import same


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_oracle(spark, small, duck, name):
    same(QUERIES[name](spark, small).toPandas(), duck.sql(ORACLES[name]).df())


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_runs(spark, small, name):
    assert QUERIES[name](spark, small).count() > 0


def test_pipeline(spark, small):
    import corpus_pipeline as P

    from .test_operators import brute

    docs = spark.read.parquet(f"{small}/documents.parquet")
    assert [n for n, _ in P.STAGES] == ["language_id", "jaccard_join", "decontamination", "mix_sources", "shards"]
    stages = dict(P.STAGES)
    odd = docs.unionByName(spark.createDataFrame([(10**6, "12 34", None, None, None), (10**6 + 1, None, None, "src0", 0)], docs.schema))
    kept = stages["language_id"](spark, odd, small)
    assert {r["doc_id"] for r in kept.collect()} == {r["doc_id"] for r in docs.collect()} and kept.columns == P.COLUMNS
    words = lambda t: re.findall(r"[^\x20\x09-\x0D]+", t.lower())
    sets = {r["doc_id"]: {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} for r in docs.collect() for w in [words(r["text"])]}
    ids, group = sorted(sets), {}
    for i in ids:
        group[i] = i
    for i in ids:
        for j in ids:
            if j < i and (both := len(sets[i] & sets[j])) and 100 * both >= 80 * (len(sets[i]) + len(sets[j]) - both):
                a, b = group[i], group[j]
                for k in ids:
                    if group[k] in (a, b):
                        group[k] = min(a, b)
    one = stages["jaccard_join"](spark, docs, small)
    assert {r["doc_id"] for r in one.collect()} == {i for i in ids if group[i] == i} and one.columns == P.COLUMNS
    items = [re.sub(r"\s+", " ", r["text"].lower()) for r in spark.read.parquet(f"{small}/benchmark.parquet").collect()]
    clean = {r["doc_id"] for r in stages["decontamination"](spark, docs, small).collect()}
    for r in docs.collect():
        text = re.sub(r"\s+", " ", r["text"].lower())
        if any(x in text for x in items):
            assert r["doc_id"] not in clean
        elif len(text) < 400 and r["doc_id"] not in clean:
            assert any(brute(x, text) <= len(x) * 0.1 for x in items)
    assert {r["doc_id"] for r in stages["mix_sources"](spark, docs, small).collect()} == set(ids)
    last = P.run(spark, small)
    assert {*P.COLUMNS, "shard"} <= set(last.columns) and last.count() > 0


def test_stages_with_odd_tables(spark, small):
    """Every stage on rows with nulls, repeated rows, a very long text and columns under the names it adds, and on none."""
    import corpus_pipeline as P

    text = " ".join(f"the word{i % 300} of the house is {i}" for i in range(30))
    rows = [
        (1, text, "en", "a", len(text)), (1, text, "en", "a", len(text)), (2, text + " end", "en", "a", 9), (3, None, "en", None, None), (4, "", None, "b", 0), (None, text, None, None, None), (None, "der weg und das haus", "de", "b", 20),
        (5, "el camino de la casa " * 30000, "es", "hot", None), (6, "the way of the house", "en", "hot", 20), (7, "12 34", "en", "a", 5), (8, "das haus und der weg", "de", "a", 20),
    ]
    extra = ["score", "lang_pred", "slot", "rank", "class", "shard", "depth", "n_bytes", "component_id", "row", "mark", "s0", "_lang", "_row"]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for name in extra:
        docs = docs.withColumn(name, F.lit("old"))
    found = {}
    for name, stage in P.STAGES:
        out = stage(spark, docs, small)
        assert out.columns[: len(P.COLUMNS)] == P.COLUMNS and stage(spark, docs.where("false"), small).count() == 0
        found[name] = sorted(str(r["doc_id"]) for r in out.collect())
    every = sorted(str(r[0]) for r in rows)
    assert found["language_id"] == [d for d in every if d not in {"3", "4", "7"}]  # no text, or no letter
    assert found["jaccard_join"] == sorted(["1", "3", "4", "None", "5", "6", "7", "8"])  # 2 and a null id are copies of 1
    assert found["decontamination"] == every and found["shards"] == every and set(found["mix_sources"]) == set(every)
