"""The training-data operators against brute force, with odd inputs."""

import hashlib
import random
import re
import unicodedata

import numpy as np
import pytest
from pyspark.sql import functions as F

from sievelake.llm import cotraining, decontaminate, fingerprints, jaccard, language, mixing, sharding, substrings, warc
from sievelake.llm.common import rolling, words_of, binary_column
from sievelake.llm.jaccard import components

LONG = " ".join(f"w{i % 997}x{i % 31}" for i in range(30000))
DOCS = "doc_id long, text string, lang string, source string, n_chars long, shard string, score double, kind int"


def corpus(seed=0, n=60):
    r = random.Random(seed)
    words = [f"t{i}" for i in range(400)]
    base = [" ".join(r.choice(words) for _ in range(r.randint(20, 120))) for _ in range(12)]
    out = []
    for i in range(n):
        kind, text = r.random(), r.choice(base)
        if kind < 0.3:
            text = " ".join(r.choice(words) for _ in range(r.randint(1, 60)))
        elif kind < 0.6:
            w = text.split()
            for _ in range(r.randint(0, 4)):
                w[r.randrange(len(w))] = r.choice(words)
            text = " ".join(w)
        elif kind < 0.8:
            text = " ".join(r.choice(words) for _ in range(10)) + "\n\t " + text[: r.randint(50, 300)]
        out.append((i, text))
    out += [(n, None), (n + 1, ""), (n + 2, "   \n"), (n + 3, LONG), (n + 4, LONG), (n + 5, "one"), (n + 6, "one two"), (n + 7, "ONE two"), (n + 7, "ONE two"), (None, base[0]), (None, None)]
    return out


def frame(spark, rows):
    return spark.createDataFrame([(d, t, None if d is None else "en", "s", None, "old", 1.0, 7) for d, t in rows], DOCS)


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def test_words_and_windows():
    import pyarrow as pa

    texts = ["a  b\tc", None, "", "é ü\n", "a b c d", "\x1cz \x85y"]
    hashes, bounds = words_of(binary_column(pa.array(texts)))
    assert np.diff(bounds).tolist() == [len(words(t)) for t in texts]
    assert hashes[0] == hashes[5] and len(rolling(hashes, 3, 7)) == len(hashes) - 2


def test_substrings(spark):
    rows = corpus()
    seen = {}
    for d, t in rows:
        w = words(t)
        for i in range(len(w) - 12):
            key = tuple(w[i : i + 13])
            seen[key] = min(seen.get(key, 10**12), 10**12 if d is None else d)
    got = substrings.remove_repeats(frame(spark, rows)).collect()
    want = []
    for d, t in rows:
        w = words(t)
        gone = {j for i in range(len(w) - 12) if seen[tuple(w[i : i + 13])] < (10**12 if d is None else d) for j in range(i, i + 13)}
        kept = " ".join(x for j, x in enumerate(w) if j not in gone)
        want.append((d, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest(), kept))
    key = lambda x: (x[0] is None, x[0] or 0, x[1:])
    assert sorted(((r["doc_id"], r["n_words"], r["n_removed"], r["kept_sha256"], r["kept_text"]) for r in got), key=key) == sorted(want, key=key)
    assert substrings.remove_repeats(frame(spark, [])).count() == 0


def test_substrings_with_the_outermost_ids(spark):
    """A null id is no number: it comes after 2^63 - 1, and both keep what they are."""
    text = " ".join(f"w{i}" for i in range(20))
    for ids, first in (([2**63 - 1, None], 2**63 - 1), ([None, 2**63 - 1, -(2**63), 0, 1, 2, 3], -(2**63)), ([None, None], None)):
        found = substrings.remove_repeats(frame(spark, [(i, text) for i in ids])).collect()
        assert sorted(str(r["doc_id"]) for r in found) == sorted(map(str, ids))
        assert all(r["n_removed"] == (0 if r["doc_id"] == first else 20) for r in found)


def test_languages_are_bounded(spark):
    rows = [(i, f"label{i % 300} word{i % 300} text", f"l{i % 300:03d}") for i in range(600)] + [(1000 + i, "the common words of it", "en") for i in range(9)]
    model = language.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"), fit_rows=200)
    assert len(model["labels"]) <= 10 and "en" in model["labels"]


@pytest.mark.parametrize("width, percent", [(3, 90), (5, 80), (2, 60)])
def test_jaccard(spark, width, percent):
    rows = corpus(3, 80)

    def shingles(text):
        w = words(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        return {tuple(w[i : i + width]) for i in range(len(w) - width + 1)} if len(w) >= width else {tuple(w)} - {()}

    sets = [shingles(t) for _, t in rows]
    up = list(range(len(rows)))

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                up[top(i)] = top(j)
    ids = {}
    for i, (d, _) in enumerate(rows):
        ids.setdefault(top(i), []).append(d)
    want = sorted((str(d), len(sets[i]), str(min((x for x in ids[top(i)] if x is not None), default=None) if sets[i] else d)) for i, (d, _) in enumerate(rows))
    got = jaccard.similarity_components(frame(spark, rows), width=width, percent=percent).collect()
    assert sorted((str(r["doc_id"]), r["n_shingles"], str(r["component_id"])) for r in got) == want
    kept = jaccard.keep_one_each(frame(spark, rows), width=width, percent=percent)
    stay = {}
    for i, (d, t) in enumerate(rows):
        if sets[i]:
            x = (d is None, d or 0)
            stay.setdefault(top(i), set()).add((x, t))
    least = {c: min(x for x, _ in members) for c, members in stay.items()}
    found = [(r["doc_id"], r["text"]) for r in kept.collect()]
    assert kept.columns == frame(spark, []).columns and len(found) == len(least) + sum(not s for s in sets)
    for d, t in found:
        c = next(top(i) for i, r in enumerate(rows) if r == (d, t))
        assert not shingles(t) or (d is None, d or 0) == least[c]


def test_jaccard_of_repeated_and_missing_ids(spark):
    a, b, c = (" ".join(f"{x}{i}" for i in range(40)) for x in "abc")
    near = lambda t: t.rsplit(" ", 1)[0] + " end"
    get = lambda rows: jaccard.similarity_components(frame(spark, rows), width=3, percent=80).collect()
    keep = lambda rows: sorted((str(r["doc_id"]), r["text"]) for r in jaccard.keep_one_each(frame(spark, rows), width=3, percent=80).collect())
    assert keep([(1, a), (5, a), (5, b)]) == [("1", a), ("5", b)]
    assert len(keep([(1, a), (1, a), (1, b), (1, b), (2, ""), (2, "")])) == 4
    found = get([(1, a), (1, b), (2, near(a)), (3, b)])
    assert {(r["doc_id"], r["component_id"]) for r in found} == {(1, 1), (2, 1), (3, 1)}
    found = get([(1, a), (None, near(a)), (None, c), (4, near(b)), (None, b)])
    assert sorted((str(r["doc_id"]), str(r["component_id"])) for r in found) == [("1", "1"), ("4", "4"), ("None", "1"), ("None", "4"), ("None", "None")]
    assert keep([(4, near(b)), (None, b), (None, c), (None, c)]) == [("4", near(b)), ("None", c)]


@pytest.mark.parametrize("list_rows, salt_rows", [(2048, 1 << 20), (7, 1 << 20), (7, 3)])
def test_jaccard_bridge_of_two_families(spark, monkeypatch, list_rows, salt_rows):
    monkeypatch.setattr(jaccard, "LIST_BYTES", 1)  # about a range for each list, as at large sizes
    monkeypatch.setattr(jaccard, "LIST_ROWS", list_rows)  # lists in blocks
    monkeypatch.setattr(jaccard, "SALT_ROWS", salt_rows)
    r = random.Random(0)
    whole = [f"b{i}" for i in range(100)]
    families = [[set(whole) - set(r.sample(whole[at : at + 26], lack)) for _ in range(60)] for at, lack in ((0, 19), (26, 14))]
    sets = [*families[0], *families[1], set(whole)]

    def least(sets):
        """The smallest position that links lead to, by brute force."""
        out = list(range(len(sets)))
        for i, a in enumerate(sets):
            for j, b in enumerate(sets[:i]):
                if out[i] != out[j] and 100 * len(a & b) >= 80 * len(a | b):
                    low, high = sorted((out[i], out[j]))
                    out = [low if x == high else x for x in out]
        return out

    assert set(least(sets)) == {0} and set(least(sets[:-1])) == {0, 60}  # only the whole one links the families
    rows = [(i, " ".join(sorted(x))) for i, x in enumerate(sets)]
    assert {r["component_id"] for r in jaccard.similarity_components(frame(spark, rows), width=1, percent=80).collect()} == {0}
    apart = jaccard.similarity_components(frame(spark, rows[:-1]), width=1, percent=80).collect()
    assert all(r["component_id"] == (0 if r["doc_id"] < 60 else 60) for r in apart)


@pytest.mark.parametrize("map_bits", [29, 15])
def test_jaccard_bitmap_of_rows(spark, monkeypatch, map_bits):
    monkeypatch.setattr(jaccard, "MAP_BITS", map_bits)  # 15: fewer bits than the rows ask for
    docs = spark.range(20_000).select(F.xxhash64("id").alias("row"), "id", F.col("id").cast("string").alias("text"))
    few = docs.where("id % 10 = 0").select("row")
    near = jaccard._only_near(docs, few)
    assert near.columns == docs.columns and near.where("id % 10 = 0").count() == 2000
    assert near.where("id % 10 != 0").count() < 18_000 * (0.03 if map_bits == 29 else 0.1)
    assert jaccard._only_near(docs, few.where("false")).count() == 0


def test_jaccard_shuffles_few_texts(spark):
    r = random.Random(1)
    rows = [(i, " ".join(f"{r.getrandbits(40):x}" for _ in range(300))) for i in range(600)]
    rows += [(1000 + i, rows[i][1] + " end") for i in range(9)]
    stages = lambda: {(s.stageId(), s.attemptId()): s.shuffleWriteBytes() for s in spark._jvm.scala.jdk.javaapi.CollectionConverters.asJava(spark.sparkContext._jsc.sc().statusStore().stageList(None, False, False, spark.sparkContext._gateway.new_array(spark._jvm.double, 0), None))}
    before = stages()
    assert sorted(x["doc_id"] for x in jaccard.keep_one_each(frame(spark, rows), width=5, percent=95).select("doc_id").collect()) == list(range(600))
    sent = sum(size for key, size in stages().items() if key not in before)
    assert 0 < sent < 0.5 * sum(len(t) for _, t in rows)  # the texts that need no search stay where they are


def test_jaccard_empty(spark):
    assert jaccard.similarity_components(frame(spark, [])).count() == 0


def test_divide_skip():
    r = random.Random(5)
    for _ in range(300):
        lists = [sorted(r.sample(range(40), r.randint(0, 30))) for _ in range(r.randint(1, 25))]
        least = r.randint(1, 12)
        counts = {}
        for one in lists:
            for x in one:
                counts[x] = counts.get(x, 0) + 1
        assert jaccard.divide_skip(lists, least) == {x: n for x, n in counts.items() if n >= least}


def test_components(spark):
    edges = [(i, i + 1) for i in range(1, 40)] + [(100, 200), (200, 150), (7, 7), (None, 3)]
    found = {r["node"]: r["label"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert {found[i] for i in range(1, 41)} == {found[1]} and found[100] == found[150] != found[1]


def test_shards(spark):
    r = random.Random(2)
    rows = [(i, "x" * r.randint(0, 400)) for i in range(500)] + [(9, "y" * 300)] * 40 + [(None, None), (None, "z" * 5000)]
    limit = 2000
    got = sharding.assign_shards(frame(spark, rows), limit_bytes=limit)
    assert "kind" in got.columns and got.columns.count("shard") == 1
    found = got.collect()
    assert len(found) == len(rows)
    sizes = {}
    for x in found:
        sizes.setdefault(x["shard"], []).append(len((x["text"] or "").encode()))
    assert all(sum(v) <= limit or len(v) == 1 for v in sizes.values())
    assert all(x["shard_bytes"] == sum(sizes[x["shard"]]) and x["shard_rows"] == len(sizes[x["shard"]]) for x in found)
    bits = {s for s in sizes if "/" not in s}
    assert not any(a != b and b.startswith(a) for a in bits for b in bits)  # no shard's prefix holds another's
    one = sharding.assign_shards(frame(spark, rows[:5]), limit_bytes=1 << 20).collect()
    assert {(x["shard"], x["depth"]) for x in one} == {("", 0)}
    assert sharding.assign_shards(frame(spark, [])).count() == 0


def test_edf_windows():
    share = mixing.shares({"a": 5, "b": 3.3, "c": 1, "d": 0.001}, 100)
    assert sum(share.values()) == 100 and min(share.values()) >= 1
    slots = mixing.edf_frame(share, 100)
    assert sorted(s for v in slots.values() for s in v) == list(range(100))
    for k, own in slots.items():
        for j, s in enumerate(own):
            assert j * 100 // share[k] <= s < -(-(j + 1) * 100 // share[k])
        for t in range(101):
            assert abs(sum(s < t for s in own) - t * share[k] / 100) < 1


def test_mixture(spark):
    rows = [(i, "abc " * 5, None, "a" if i % 3 else ("b" if i % 2 else None), None, "old", 1.0, 7) for i in range(300)] + [(0, None, None, "c", None, "old", 1.0, 7)] * 2
    df = spark.createDataFrame(rows, DOCS)
    got = mixing.mix_sources(df, block_chars=40, frame=50)
    found = got.collect()
    assert got.columns[: len(df.columns)] == df.columns and {r["doc_id"] for r in found} == set(range(300))
    assert all(r["release"] <= r["slot"] < r["deadline"] for r in found)
    first = [r for r in found if r["epoch"] == 0]
    assert len(first) == len(rows)
    end = max(r["slot"] for r in found) + 1
    share = {k: len({r["block"] for r in found if r["class"] == k}) for k in {r["class"] for r in found}}
    want = mixing.shares({k: sum(len(x[1] or "x") for x in rows if (x[3] or "") == k) ** 0.8 for k in share}, 50)
    assert all(abs(n - end * want[k] / 50) <= 1 for k, n in share.items())
    stop = mixing.mix_sources(df, weights={"a": 0.5, "b": 0.5}, block_chars=40, frame=10, exhausted="stop").collect()
    assert {r["class"] for r in stop} == {"a", "b"} and len({(r["doc_id"], r["class"]) for r in stop}) == len(stop)
    assert mixing.mix_sources(df.where("false")).count() == 0


def test_equal_deadlines_go_by_name():
    assert mixing.edf_frame({"b": 1, "a": 1}, 2) == {"a": [0], "b": [1]}


@pytest.mark.parametrize("count", [60, 1500])
def test_mixture_row_by_row(spark, count):
    """Blocks, epochs, slots and ranks of every row against a plain loop over the seeded order."""
    frame_, block = 20, 300
    rows = [(i, "x" * (1 + i * 37 % 90), "a" if i % 3 else "b" if i % 2 else "c") for i in range(count)] + [(5, "y" * 11, "a"), (6, None, "b")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    order = F.xxhash64(F.lit(3), F.col("doc_id").cast("string"))
    seeded = [(r["doc_id"], r["source"], len(r["text"] or "x"), r["o"]) for r in df.withColumn("o", order).collect()]
    unsigned = len(rows) >= 512  # the order starts with the hash's upper bits where there are several cells
    classes = {k: sorted((o % 2**64 if unsigned else o, i, n) for i, s, n, o in seeded if s == k) for k in "abc"}
    share = mixing.shares({k: sum(n for *_, n in x) ** 0.8 for k, x in classes.items()}, frame_)
    slots = mixing.edf_frame(share, frame_)
    slot = lambda k, b: b // share[k] * frame_ + slots[k][b % share[k]]
    blocks = {k: -(-sum(n for *_, n in x) // block) for k, x in classes.items()}
    end = max(slot(k, b - 1) + 1 for k, b in blocks.items())
    want = []
    for k, x in classes.items():
        before = 0
        for rank, (_, i, n) in enumerate(x):
            epoch, b = 0, before // block
            while slot(k, b) < end:
                want.append((i, k, epoch, b, b * frame_ // share[k], -(-(b + 1) * frame_ // share[k]), slot(k, b), rank))
                epoch, b = epoch + 1, b + blocks[k]
            before += n
    got = mixing.mix_sources(df, block_chars=block, frame=frame_, seed=3).select("doc_id", "class", "epoch", "block", "release", "deadline", "slot", "rank")
    assert sorted(map(tuple, got.collect())) == sorted(want)


def test_language(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    model = language.fit(docs.where(~language.held_out()))
    found = language.classify(docs.where(language.held_out()), model).toPandas()
    assert (found.lang == found.lang_pred).mean() > 0.97 and found.score.between(0, 1).all()
    odd = language.classify(frame(spark, [(1, None), (2, "12 %% 3"), (None, ""), (4, "\U0001f600 \U0001f600 \U0001d7d8"), (3, LONG + " the and of"), (5, "\U00010400\U00010401")]), model).collect()
    assert [r["lang_pred"] for r in odd][:4] == ["und"] * 4 and odd[4]["lang_pred"] in model["labels"] and odd[0]["score"] == 0
    assert odd[5]["lang_pred"] in model["labels"]  # letters beyond the basic plane are letters
    empty = language.fit(docs.where("false"))
    assert {r["lang_pred"] for r in language.classify(docs.limit(3), empty).collect()} == {"und"}
    assert language.classify(docs.where("false"), model).count() == 0


def test_language_is_kernel_ridge_regression(spark):
    """With every row as a landmark the model is exact kernel ridge regression; here by its own normal equations."""
    r = random.Random(2)
    vocabulary = {"aa": ["haus", "und", "über", "weg", "dem"], "bb": ["casa", "y", "señor", "de", "la"], "cc": ["house", "and", "over", "way", "of"]}
    rows = [(i, " ".join(r.choice(v) + r.choice(["", ",", " 7"]) for _ in range(r.randint(2, 9))), k) for i, (k, v) in enumerate(sorted(vocabulary.items()) * 14)]

    def grams(text):
        folded = " " + " ".join("".join(c if c.isalpha() else " " for c in text.lower()).split()) + " "
        return {folded[i : i + n] for n in (1, 2, 3, 4) for i in range(len(folded) - n + 1)}

    sets = [grams(t) for _, t, _ in rows]
    kernel = np.array([[len(a & b) / np.sqrt(len(a) * len(b)) for b in sets] for a in sets])
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language.fit(df, fit_rows=10**6, landmarks=10**6)
    queries = ["casa de la and", "über den weg", "of house", "weg casa and"]
    found = language.classify(spark.createDataFrame([(i, q) for i, q in enumerate(queries)], "doc_id long, text string"), model).orderBy("doc_id").collect()
    every, ridge = np.ones(len(rows)), 0.05 / len(rows)
    best = {}
    for label in vocabulary:
        y = np.array([1.0 if k == label else -1.0 for _, _, k in rows])
        w = np.array([1 / (y == v).sum() for v in y])
        w /= w.sum()
        left = np.block([[np.diag(w) @ kernel + ridge * np.eye(len(rows)), w[:, None]], [(w @ kernel)[None], np.array([[w.sum() + ridge]])]])
        solved = np.linalg.solve(left, np.append(w * y, w @ y))
        for q in queries:
            near = np.array([len(grams(q) & s) / np.sqrt(len(grams(q)) * len(s)) for s in sets])
            best.setdefault(q, {})[label] = near @ solved[:-1] + solved[-1]
    for row, q in zip(found, queries):
        assert row["lang_pred"] == max(best[q], key=best[q].get)
        assert abs(row["score"] - np.clip((max(best[q].values()) + 1) / 2, 0, 1)) < 0.01  # n-grams are hashed to 2^16 cells


def test_fingerprints(spark):
    rows = [(1, "Straße  A B"), (2, "STRASSE a b "), (3, "ét"), (4, "ét"), (5, None), (6, ""), (7, LONG), (9, "ab"), (9, "cd"), (None, "x")]
    canon = lambda s: re.sub(r"\s+", " ", unicodedata.normalize("NFKC", unicodedata.normalize("NFKC", s or "").casefold())).strip()
    found = {(r["doc_id"], r["fingerprint"]) for r in fingerprints.fingerprints(frame(spark, rows)).collect()}
    names = {}
    for d, f in found:
        names.setdefault(f, set()).add(d)
    want = {}
    for d, t in rows:
        want.setdefault(canon(t), set()).add(d)
    assert sorted(map(str, names.values())) == sorted(map(str, want.values()))
    plain = [(i, t) for i, t in enumerate(["Hello world", "hello  WORLD", "abcdef", "", "zz", "\U0001d400bc d"])]
    got = {r["doc_id"]: r for r in fingerprints.edited(frame(spark, plain)).collect()}
    for d, t in plain:
        after = dict(plain)[d - 1 if d else 5]
        k = len(t) // 3
        e = t[: len(t) - k] + after[:k]
        assert got[d]["edited_sha256"] == hashlib.sha256(e.encode()).hexdigest() and got[d]["n_chars"] == len(t)
        assert (got[d]["near_edited"], got[d]["near_next"]) == (float(canon(e) == canon(t)), float(canon(after) == canon(t)))
    assert fingerprints.edited(frame(spark, rows)).count() == len(rows) and fingerprints.edited(frame(spark, [])).count() == 0


def test_fingerprint_collision_is_told_apart(spark, monkeypatch):
    monkeypatch.setattr(fingerprints, "digest", lambda c: F.left(c, F.lit(1)))
    found = fingerprints.fingerprints(frame(spark, [(1, "ab"), (2, "ac"), (3, "AB"), (4, "x")])).collect()
    names = {r["doc_id"]: r["fingerprint"] for r in found}
    assert names[1] == names[3] != names[2]
    got = {r["doc_id"]: r["fingerprint"] for r in fingerprints.edited(frame(spark, [(1, "ab"), (2, "ac"), (3, "AB")])).collect()}
    assert got[1] == got[3] != got[2]


def test_warc(spark, tmp_path):
    rows = [(1, "http://a/x", "<p>one"), (2, None, "<p>one"), (3, "http://a/\r\ny", None), (4, "u", ""), (5, "u", "é" * 70000), (5, "u", "é" * 70000), (None, "n", "<p>one")]
    pages = spark.createDataFrame([(*r, "extra") for r in rows], "page_id long, url string, html string, record_type string")
    archives = warc.write_archives(pages, archive_bytes=300)
    for found in (warc.read_archives(archives, with_payload=True).collect(),):
        assert len(found) == len(rows) and all(r["digest_ok"] for r in found)
        by = {}
        for r in found:
            by.setdefault(r["page_id"], []).append((r["record_type"], r["refers_to"], r["payload_bytes"], r["payload_digest"]))
        one = warc.digest(b"<p>one")
        assert by[1] == [("revisit", 2, 6, one)] and by[2] == [("response", None, 6, one)] and by[None] == [("response", None, 6, one)]
        assert by[3] == [("revisit", 4, 0, warc.digest(b""))] and by[4][0][0] == "response" and [x[0] for x in by[5]] == ["response"] * 2
        assert {r["payload"].decode() for r in found if r["page_id"] == 5} == {"é" * 70000}
    warc.save_files(archives, str(tmp_path / "w"))
    assert warc.read_files(spark, str(tmp_path / "w")).count() == len(rows)
    assert {r["record_type"] for r in warc.read_archives(warc.write_archives(pages, least_revisit_bytes=7)).where("payload_bytes < 7").collect()} == {"response"}
    assert warc.write_archives(pages.where("false")).count() == 0
    good = warc.record(1, "u", b"abc", None)
    with pytest.raises(ValueError):
        list(warc.members(good[:-5]))
    with pytest.raises(ValueError):
        warc.parse(next(warc.members(good)).replace(b"Content-Length: 3", b"Content-Length: 4").replace(b"abc", b"abcd")[:-1])


def brute(pattern, text):
    row = [0] * (len(text) + 1)
    for i, a in enumerate(pattern, 1):
        new = [i]
        for j, b in enumerate(text, 1):
            new.append(min(row[j - 1] + (a != b), row[j] + 1, new[j - 1] + 1))
        row = new
    return min(row)


def test_decontamination(spark):
    r = random.Random(4)
    letters = "abcde "
    items = [(i, "".join(r.choice(letters) for _ in range(r.randint(60, 130))).strip()) for i in range(5)]
    docs = []
    for d in range(60):
        t = list(r.choice(items)[1])
        for _ in range(r.randint(0, 14)):
            k = r.randrange(len(t))
            t[k : k + 1] = r.choice([[], [r.choice(letters)], [t[k], r.choice(letters)]])
        docs.append((d, "".join(r.choice(letters) for _ in range(50)) + "".join(t).upper() + "".join(r.choice(letters) for _ in range(50))))
    docs += [(70, None), (71, ""), (None, items[0][1]), (72, LONG)]
    norm = lambda s: re.sub(r"\s+", " ", (s or "").lower()).strip()
    want = sorted((str(d), i, brute(norm(it), norm(t))) for d, t in docs if d != 72 for i, it in items if t is not None and brute(norm(it), norm(t)) <= int(len(norm(it)) * 0.1))
    bench = spark.createDataFrame([*items, (8, "short"), (9, None)], "item_id long, text string")
    got = sorted((str(r["doc_id"]), r["item_id"], r["distance"]) for r in decontaminate.matches(frame(spark, docs), bench).collect())
    assert got == want
    clean = decontaminate.decontaminate(frame(spark, docs), bench)
    assert {str(r["doc_id"]) for r in clean.collect()} == {str(d) for d, _ in docs} - {d for d, _, _ in want}
    assert decontaminate.matches(frame(spark, docs), bench.where("false")).count() == 0 and decontaminate.matches(frame(spark, []), bench).count() == 0


def test_short_items_are_whole_words(spark):
    bench = spark.createDataFrame([(1, "Why not?"), (2, "cat"), (3, "x" * 29), (4, None), (5, " \n"), (6, "x" * 30)], "item_id long, text string")
    docs = [(1, "so why  NOT? because"), (2, "whynot? concatenate cats"), (3, "a Cat."), (4, "y" + "x" * 29), (5, "cat why not?x"), (6, "x" * 28), (7, "why not"), (8, "x" * 15 + "-" + "x" * 15)]
    found = {(r["doc_id"], r["item_id"]) for r in decontaminate.matches(frame(spark, docs), bench).collect()}
    assert found == {(1, 1), (3, 2), (5, 2), (5, 1), (4, 6), (6, 6), (8, 6)}


def test_blocks_of_items(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "BLOCK_CHARS", 50)
    items = [(i, f"item number {i} " + "abc def ghi " * 4) for i in range(4)]
    found = decontaminate.matches(frame(spark, [(1, items[3][1]), (2, "clean")]), spark.createDataFrame(items, "item_id long, text string"), share=0.01)
    assert [(r["doc_id"], r["item_id"]) for r in found.collect()] == [(1, 3)]


def test_cotraining(spark, small):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    known = labels.where(~language.held_out())
    found = cotraining.classify(docs, known, rounds=1).join(labels.where(language.held_out()), "doc_id").toPandas()
    assert (found.predicted == found.quality).mean() > 0.93 and found.score.between(0, 1).all()
    none = cotraining.classify(frame(spark, [(1, None), (None, "x")]), labels.where("false")).collect()
    assert [(r["score"], r["predicted"]) for r in none] == [(0.5, 1)] * 2


def test_cotraining_odd_rows(spark):
    rows = [(i, ("good words here " * 5 if i % 2 else "%%% ### |||| ") + str(i)) for i in range(60)] + [(None, None), (100, ""), (101, LONG)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)] + [(3, 0), (None, 1), (5, None), (999, 1)], "doc_id long, quality int")
    found = cotraining.classify(frame(spark, rows), labels, sample_rows=100, rounds=1, add=5).collect()
    assert len(found) == len(rows)
    assert all((r["predicted"] == 1) == (r["doc_id"] % 2 == 1) for r in found if r["doc_id"] is not None and 40 <= r["doc_id"] < 60)


def test_warc_with_broken_records(spark):
    import zlib

    good = [warc.record(i, f"http://x/{i}", b"text %d" % i, None) for i in range(3)]
    inner = zlib.decompress(good[1], 31)
    again = lambda data: (lambda z: z.compress(data) + z.flush())(zlib.compressobj(6, zlib.DEFLATED, 31))
    wrong = [again(inner.replace(b"Content-Length: ", b"Content-Length: 9", 1)), again(b"no header end"), again(inner.replace(b"WARC-Type", b"Other")), again(b"\xff\r\n\r\n")]
    archives = [b"".join([good[0], *wrong, good[2]]), good[0] + good[1][:-9], b"not gzip" + good[0], b"", None]
    found = warc.read_archives(spark.createDataFrame([(x,) for x in archives], "data binary")).collect()
    assert sorted(r["page_id"] for r in found if r["error"] is None) == [0, 0, 2]
    assert sum(r["error"] is not None for r in found) == 6 and all(r["page_id"] is None for r in found if r["error"])
