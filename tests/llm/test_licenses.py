"""Licence scan against plain versions: every substring for the statistics, word by word for the phrases."""

import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from sievelake.llm import license_texts, licenses
from sievelake.llm.licenses import WINDOW, Automaton, Scanner, scan


def plain_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))


def base(text):
    words, places, labels = plain_words(text), [], set()
    for phrase, label in license_texts.BASE.items():
        p = phrase.split()
        at = [i for i in range(len(words) - len(p) + 1) if words[i : i + len(p)] == p]
        places += at
        labels |= {label} if at else set()
    return len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels))


def test_statistics_against_all_substrings():
    rng = random.Random(2)
    for _ in range(20):
        sequences = [[rng.randrange(4) for _ in range(rng.randint(1, 12))] for _ in range(rng.randint(1, 5))]
        machine = Automaton(sequences, 4, 1)
        text = [rng.randrange(4) for _ in range(60)]
        inside = {tuple(s[i:j]): {(n, b) for n, q in enumerate(sequences) for b in range(j - i, len(q) + 1) if q[b - (j - i) : b] == s[i:j]} for s in sequences for i in range(len(s)) for j in range(i + 1, len(s) + 1)}
        states, lengths = machine.statistics(np.array(text, np.int32), np.array([0]), np.array([60]), 12)
        for i in range(60):
            best = max((n for n in range(0, i + 2) if n == 0 or tuple(text[i + 1 - n : i + 1]) in inside))
            assert lengths[i] == best
            if best:
                assert set(machine.ends[states[i]]) == inside[tuple(text[i + 1 - best : i + 1])]


def test_long_runs_are_cut_into_windows():
    rng = random.Random(4)
    sequences = [[rng.randrange(3) for _ in range(40)] for _ in range(3)]
    machine, text = Automaton(sequences, 3, 1), []
    while len(text) < 5 * WINDOW:
        s = rng.choice(sequences)
        text += s[rng.randrange(20) : rng.randrange(20, 41)]
    whole, s, m = [], 0, 0
    for t in text:
        m = min(m, int(machine.reach[s, t])) + 1
        s = int(machine.into[s, t])
        whole.append((s, m))
    states, lengths = machine.statistics(np.array(text, np.int32), np.array([0]), np.array([len(text)]), 40)
    assert list(zip(states.tolist(), lengths.tolist())) == whole


def texts():
    rng = random.Random(7)
    words = ["cc", "by", "CC-BY", "general", "Public", "license", "all", "rights", "reserved", "x", "é", "cc by", "0"]
    made = [rng.choice(" .\n-_").join(rng.choice(words) for _ in range(rng.randint(0, 40))) for _ in range(120)]
    mit = license_texts.TEXTS["mit"]
    return [*made, None, "", "general public " * 3 + "license", "cc by " * 5000, mit, mit.upper().replace(",", " ;"), mit * 3, "Released under the MIT License.", "Licensed under CC BY-NC 4.0.", "This work is licensed under the GNU General Public License, version 3.", "Licensed under the Apache License, Version 2.0."]


def test_scan_against_plain(spark):
    rows = [(i, t) for i, t in enumerate(texts())] + [(None, "all rights reserved"), (3, "all rights reserved")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("labels", F.lit("old")).repartition(3)
    found = scan(docs).collect()
    assert len(found) == len(rows)
    get = {r["doc_id"]: r for r in found if r["doc_id"] not in (None, 3)}
    for i, t in rows:
        if i not in (None, 3):
            r = get[i]
            assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"], ",".join(r["base_labels"])) == base(t), t
            assert set(r["base_labels"]) <= set(r["labels"]) and 0 <= r["score"] <= 1
            assert all(0 <= s["start"] < s["stop"] <= r["n_words"] for s in r["spans"]) and all(a["stop"] <= b["start"] for a, b in zip(r["spans"], r["spans"][1:]))
    last = len(texts())
    labels = [sorted(get[i]["labels"]) for i in range(last - 7, last)]
    assert labels == [["mit"], ["mit"], ["mit"], ["mit"], ["cc-by", "cc-by-nc-4.0"], ["gpl", "gpl-3.0"], ["apache-2.0"]]
    assert len(get[last - 5]["spans"]) == 3 and scan(docs.where("false")).count() == 0


@pytest.mark.parametrize("name", sorted(license_texts.TEXTS))
def test_edited_templates_are_found(name):
    rng = random.Random(name)
    scanner = licenses.scanner(tuple(license_texts.templates()), tuple(license_texts.BASE.items()), 4, 40, 0.8)
    words = license_texts.TEXTS[name].split()
    clean = scanner.scan(pa.array([" ".join(words)], pa.large_binary()))[0]
    assert name in {s[0] for s in clean["spans"]} and clean["score"] == 1
    for i in range(10, len(words) - 5, 30):  # a word in 30 is another one, and some are put in
        words[i] = rng.choice(["Foo", "Bar baz", ""])
    text = "qqq www " * 50 + " ".join(words) + " zzz" * 40
    found = scanner.scan(pa.array([text], pa.large_binary()))[0]
    span = [s for s in found["spans"] if s[0] == name]
    assert len(span) == 1 and span[0][1] == 100 and 0.8 <= span[0][4] < 1


def test_chains_against_all_choices():
    """The share of a chain is that of the best choice of matches, where a chain is the only one of its start."""
    scanner = Scanner((("t", "a b c d e f g h i j k l"),), (), 2, 5, 0.5)
    scan_one = lambda text: scanner.scan(pa.array([text], pa.large_binary()))[0]
    assert scan_one("a b c d x e f g h y i j k l")["spans"] == [("t", 0, 14, 12, 1.0)]
    assert scan_one("a b c d e f q q q q q q q g h i j k l")["spans"] == [("t", 0, 6, 6, 0.5), ("t", 13, 19, 6, 0.5)]  # the gap is too wide
    assert scan_one("i j k l q a b c d")["spans"] == [] and scan_one("g h i j k l a b c d e f")["score"] == 0.5
    assert scan_one("a b c d c d e f")["spans"][0][3] == 6  # words of the template count once


def test_query(spark, small):
    import pyarrow.parquet as pq

    from sievelake.llm.queries import QUERIES

    found = {r["doc_id"]: r for r in QUERIES["op13_license_scan"](spark, small).collect()}
    rows = pq.read_table(f"{small}/documents.parquet", columns=["doc_id", "text"]).to_pylist()
    assert len(found) == len(rows)
    for r in rows:
        f = found[r["doc_id"]]
        assert (f["n_words"], f["n_base"], f["first_word"], f["last_word"], f["base_labels"]) == base(r["text"])
        assert set(filter(None, f["base_labels"].split(","))) <= set(filter(None, f["labels"].split(",")))
