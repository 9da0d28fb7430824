"""Every registered query of the curation library against its DuckDB SQL."""

import collections
import difflib
import re

import pytest

from sievelake.plans import ALL_ORACLES, ALL_QUERIES

from .compare import same


@pytest.mark.parametrize("name", sorted(ALL_ORACLES))
def test_oracle(spark, small, duck, name):
    same(ALL_QUERIES[name](spark, small).toPandas(), duck.sql(ALL_ORACLES[name]).df())


@pytest.mark.parametrize("name", sorted(set(ALL_QUERIES) - set(ALL_ORACLES)))
def test_runs(spark, small, name):
    assert ALL_QUERIES[name](spark, small).count() > 0


def turns(small):
    import pyarrow.parquet as pq

    texts = {(r["conv_id"], r["turn"]): r["text"] for r in pq.read_table(f"{small}/conversations.parquet").to_pylist()}
    return {k: (a, texts[k[0], k[1] + 1]) for k, a in texts.items() if (k[0], k[1] + 1) in texts}


def longest(a, b):
    """Longest common substring without spaces, by the table of suffix lengths."""
    a, b = "".join(a.split()), "".join(b.split())
    best, row = 0, [0] * (len(b) + 1)
    for x in a:
        row = [0, *(row[j] + 1 if x == y else 0 for j, y in enumerate(b))]
        best = max(best, *row)
    return best, len(a), len(b)


def test_turns_against_the_next(spark, small):
    both = turns(small)
    for r in ALL_QUERIES["f8_same_passage"](spark, small).collect():
        n, x, y = longest(*both[r["conv_id"], r["turn"]])
        assert (r["n"], r["same"], r["near"]) == (n, min(x, y) > 0 and 2 * n >= min(x, y), n >= 0.9 * (x + y - n))
    tokens = lambda t: [w.lower() for w in re.findall(r"\d+(?:\.\d+)?|[A-Za-z_][A-Za-z0-9_']*", t)]
    for r in ALL_QUERIES["f17_word_difference"](spark, small).collect():
        a, b = map(tokens, both[r["conv_id"], r["turn"]])
        assert abs(r["difference"] - (1 - difflib.SequenceMatcher(None, a, b, autojunk=False).ratio())) < 1e-9
    states = collections.Counter(r["state"] for r in ALL_QUERIES["f9_check_passage"](spark, small).collect())
    assert set(states) == {"copy", "joined", "not a copy"}


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_partitioning_changes_nothing(spark, small):
    found = []
    for n in ("1", "7"):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        found.append(sorted(map(str, ALL_QUERIES["w4_cap_per_group"](spark, small).collect())))
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert found[0] == found[1]
