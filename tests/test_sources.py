"""Readers and sinks against plain versions."""

import json
import os
import random
import string

import pytest
from pyspark.sql import functions as F

from sievelake.operators import spans as N
from sievelake.scratch import scratch_path
from sievelake.sources.named import _Writer, read_named_texts, write_named_texts
from sievelake.sources.readers import read_keyed_json


def test_keyed_json_in_byte_ranges(spark):
    """A file of many ranges, with braces and quotes in strings, nested records, keys without a record, and line breaks."""
    rng, path = random.Random(7), scratch_path(spark, "keyed")
    os.makedirs(path)
    text = lambda n: "".join(rng.choice('ab{}"\\ ,:é\n') for _ in range(rng.randrange(n)))
    for k, indent in enumerate((None, 2)):
        made = {f"{k}-{i}-{text(5)}": None if i % 17 == 0 else {"a": text(40), "n": i, "deep": [{"x": text(9)}, {}]} for i in range(300)}
        made[f"last{k}"] = None
        with open(f"{path}/{k}.json", "w", encoding="utf-8") as out:
            json.dump(made, out, indent=indent, ensure_ascii=bool(k))
    for name, content in (("empty.json", ""), ("none.json", "{}\n")):
        with open(f"{path}/{name}", "w", encoding="utf-8") as out:
            out.write(content)
    want = {}
    for k in (0, 1):
        with open(f"{path}/{k}.json", encoding="utf-8") as file:
            want |= json.load(file)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        assert spark.read.option("lineSep", "}").text(path).rdd.getNumPartitions() > 10
        found = read_keyed_json(spark, path, "struct<a:string,n:long,deep:array<struct<x:string>>>").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert len(found) == len(want) == 602
    for r in found:
        v = want[r["id"]]
        assert (r["a"], r["n"]) == ((None, None) if v is None else (v["a"], v["n"])) and [d["x"] for d in r["deep"] or []] == ([] if v is None else [v["deep"][0]["x"], None])


def test_named_files(spark):
    rows = [(f"f{i:05d}.txt", None if i == 5 else f"text {i}\n" * (i % 4)) for i in range(60)]
    df, path = spark.createDataFrame(rows, "n string, t string").repartition(5), scratch_path(spark, "named")
    write_named_texts(df, path, "n", "t")
    assert {(r["file"], r["text"]) for r in read_named_texts(spark, path).collect()} == {(n, t) for n, t in rows if t}
    assert {f for _, _, names in os.walk(path) for f in names} == {n for n, _ in rows} | {"_SUCCESS"}
    with pytest.raises(Exception, match="FileExists"):
        write_named_texts(df, path, "n", "t")
    other = scratch_path(spark, "named")
    with pytest.raises(Exception, match="no file name"):
        write_named_texts(df.withColumn("n", F.when(F.col("n") == "f00050.txt", "../x").otherwise(F.col("n"))), other, "n", "t")
    parent = os.path.dirname(other)
    assert not os.path.exists(other) and not [f for f in os.listdir(parent) if f.startswith(os.path.basename(other))]  # nothing is left


def test_a_repeated_task_leaves_no_second_copy(spark):
    path = scratch_path(spark, "named")
    writer = _Writer(path)
    lost, kept = writer.write(iter([("a", "1")])), writer.write(iter([("a", "1"), ("b", "2")]))
    assert lost.folder != kept.folder and not os.path.exists(path)
    writer.commit([kept])
    assert {(r["file"], r["text"]) for r in read_named_texts(spark, path).collect()} == {("a", "1"), ("b", "2")}


def test_windows_of_texts(spark):
    """Window bounds against a search in the text itself."""
    rng = random.Random(4)
    docs = [(i, "".join(rng.choice(string.ascii_lowercase[:4] + "  ..,,,\n|" + ("" if i % 3 else "bbbbbbbb")) for _ in range(rng.randint(1, 400)))) for i in range(60)]
    df = spark.createDataFrame(docs, "d long, t string")
    at = df.select("d", F.floor(F.char_length("t") / 2).cast("long").alias("s")).withColumn("e", F.col("s"))
    import re

    found = {r["d"]: (r["lo"], r["hi"]) for r in N.window_bounds(at, df, ["d"], "s", "e", "t", "[|]", "[.] *[\n]", "[.]", ",[^,.]+,", 40, 50, 15).collect()}
    for d, text in docs:
        s = len(text) // 2
        where = lambda p: [m.span() for m in re.finditer(p, text)]  # noqa: B023, E731
        floor = max((a for a, _ in where("[|]") if a <= s), default=0)
        top = min((a for a, _ in where("[|]") if a > s), default=len(text))
        lo, hi = max(floor, s - 40), min(top, s + 50)
        if lo > floor:
            breaks = [b for _, b in where("[.] *[\n]") if max(floor, lo - 15) <= b <= lo]
            lo = max(breaks) if breaks else max(floor, max((b for _, b in where("[.]") if b <= lo), default=0))
        if hi < top:
            breaks = [b for _, b in where("[.] *[\n]") if hi <= b <= min(top, hi + 15)]
            hi = min(breaks) if breaks else min(top, min((a for a, _ in where("[.]") if a >= hi), default=top))
        math = where(",[^,.]+,")
        lo, hi = next((a for a, b in math if a < lo < b), lo), next((b for a, b in math if a < hi < b), hi)
        assert found[d] == (min(lo, s), max(hi, s)), (d, text)


def test_numbers_of_more_than_five_digits():
    """SQL and names of the export agree beyond 99,999 files, where events share an id or have none, and on both sides of the order."""
    import duckdb

    from sievelake.plans import ALL_ORACLES

    connection = duckdb.connect()
    connection.sql("create table events as select i as event_id, 'view' as event_type, 91.0 as value, '{}' as props from range(100002) t(i)")
    connection.sql("insert into events values (null, 'error', 95.0, 'b'), (7, 'error', 95.0, 'b'), (7, 'error', 95.0, 'a')")
    found = connection.sql(ALL_ORACLES["s8_numbered_export"]).fetchall()
    names = sorted(f for s, f, _ in found if s == "ok")
    assert len(set(names)) == 100002 and names == sorted(f"ok-f{i:05d}.txt" for i in range(1, 100003))
    assert sorted((f, t) for s, f, t in found if s == "rejected") == [("rejected-f00001.txt", "error\nb"), ("rejected-f00002.txt", "error\na"), ("rejected-f00003.txt", "error\nb")]


def test_files_are_not_listed_in_one_place(spark, monkeypatch):
    """Folders stay short, and a read makes no list of all files; empty files have a row where they are asked for."""
    from sievelake.sources import named

    monkeypatch.setattr(named, "FOLDER_FILES", 3)
    path = scratch_path(spark, "named")
    writer = _Writer(path)
    writer.commit([writer.write(iter([(f"{k}{i}", "" if i == 4 else f"é{i}") for i in range(n)])) for k, n in (("a", 8), ("b", 3), ("c", 0))])
    assert max(len(names) for _, _, names in os.walk(path)) == 3
    want = {(f"{k}{i}", "" if i == 4 else f"é{i}") for k, n in (("a", 8), ("b", 3)) for i in range(n)}
    found = read_named_texts(spark, path, empty=True)
    assert "binaryFile" not in found._jdf.queryExecution().toString() and found.rdd.getNumPartitions() == 2
    rows = [tuple(r) for r in found.collect()]
    assert set(rows) == want and len(rows) == len(want)
    assert {tuple(r) for r in read_named_texts(spark, path).collect()} == {r for r in want if r[1]}
    none = scratch_path(spark, "named")
    write_named_texts(spark.createDataFrame([], "n string, t string"), none, "n", "t")
    assert read_named_texts(spark, none, empty=True).count() == 0


def test_export_of_odd_events(spark):
    """Rows without a text, without an id, with equal ids and without a kind are exported, as the SQL has them."""
    import duckdb

    from sievelake.plans import ALL_ORACLES, ALL_QUERIES

    folder = scratch_path(spark, "odd")
    rows = [(None, "error", 95.0, "b"), (7, "error", 95.0, "b"), (7, "error", 95.0, "a"), (8, "error", 95.0, None), (9, None, 95.0, "c"), (10, "view", 95.0, ""), (11, "view", 3.0, "d"), (None, "view", None, "e")]
    spark.createDataFrame(rows, "event_id long, event_type string, value double, props string").write.parquet(f"{folder}/events.parquet")
    connection = duckdb.connect()
    connection.sql(f"create view events as select * from '{folder}/events.parquet/*.parquet'")
    want = connection.sql(ALL_ORACLES["s8_numbered_export"]).fetchall()
    found = [tuple(r) for r in ALL_QUERIES["s8_numbered_export"](spark, folder).collect()]
    assert sorted(found, key=str) == sorted(want, key=str) and len(want) == 6
