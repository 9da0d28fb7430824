"""Tokenizer alignment against a plain version: whole texts by the named libraries, links by comparing all byte ranges."""

import collections
import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from sievelake.llm import alignment as L

A, B = "/opt/tokenizers/byte_bpe_50k.json", "/opt/tokenizers/piece_bpe_32k.model"


def plain(texts):
    """Rows of (n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256)."""
    import sentencepiece
    from tokenizers import Tokenizer

    a_tokens, b_tokens = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    a_tokens.encode_special_tokens = True
    letters = L._byte_letters()
    a_bytes = lambda i: bytes(letters[c] for c in a_tokens.id_to_token(i))
    b_bytes = lambda i: bytes([int(b_tokens.id_to_piece(i)[3:5], 16)]) if b_tokens.is_byte(i) else b_tokens.id_to_piece(i).replace("▁", " ").encode()
    made, docs = [], collections.Counter()
    for t in texts:
        links, groups = [], []
        if t:
            a, b = a_tokens.encode(" " + t, add_special_tokens=False).ids, b_tokens.encode(t)
            x, y = [a_bytes(i) for i in a], [b_bytes(i) for i in b]
            if b"".join(x) == b"".join(y) == b" " + t.encode():
                ends_a, ends_b = np.cumsum([len(p) for p in x]).tolist(), np.cumsum([len(p) for p in y]).tolist()
                j = 0
                for i, end in enumerate(ends_a):
                    while j and ends_b[j - 1] > end - len(x[i]):
                        j -= 1
                    while ends_b[j] <= end - len(x[i]):
                        j += 1
                    k = j
                    while k < len(b) and ends_b[k] - len(y[k]) < end:
                        links.append((a[i], b[k]))
                        k += 1
                i = j = 0
                for end in sorted(set(ends_a) & set(ends_b)):
                    p, q = ends_a.index(end, i) + 1, ends_b.index(end, j) + 1
                    groups.append(",".join(map(str, a[i:p])) + "|" + ",".join(map(str, b[j:q])))
                    i, j = p, q
                made.append((len(a), len(b), groups, links))
                docs.update(set(links))
                continue
        made.append((0, 0, [], []))
    top = collections.Counter()
    for (i, _), n in docs.items():
        top[i] = max(top[i], n)
    return [(n, m, len(g), len(k), sum(docs[p] == top[p[0]] for p in k), sum(docs[p] for p in k), hashlib.sha256(";".join(g).encode()).hexdigest() if g else "") for n, m, g, k in made]


def odd_texts():
    rng = random.Random(6)
    parts = ["the", " ", "  ", "\n", "\t", "naïve", "'s", "don't", "123", "4.5", "…", "日本語", "🎉🎊", " ", " ", "　", "<|endoftext|>", "<s>", "<0x41>", "▁", "́", "x" * 40, "\x00", "\x1c", "\x85", "é", "!!", "a b c", "\x7f", "ﬁ", "​"]
    made = ["".join(rng.choice(parts) for _ in range(rng.randint(1, 30))) for _ in range(250)]
    made += [" ".join(rng.choice(["the", "cat", "sat", "naïve", "don't", "über"]) for _ in range(rng.randint(1, 60))) for _ in range(60)]
    return [*made, None, "", " ", "a", " a", "a ", "  a  b  ", "\n", "x" * 3000, "é" * 2000, "the end", "the end"]


def test_merge_path():
    rng = np.random.default_rng(1)
    for steps in (1, 3, 64):
        for _ in range(30):
            cut = lambda: np.unique(np.append(rng.integers(1, 60, rng.integers(0, 40)), 60))
            a, b = cut(), cut()
            order = sorted([(v, 0, i) for i, v in enumerate(a)] + [(v, 1, i) for i, v in enumerate(b)])
            found = L.merge_path(a, b, steps)
            assert found[:, -1].tolist() == [len(a), len(b)]
            for k, (i, j) in enumerate(found.T[:-1].tolist()):
                assert i + j == k * steps and i == sum(side == 0 for _, side, _ in order[: k * steps])
            links, common = set(), []
            for (i, j), (i2, j2) in zip(found.T.tolist(), found.T.tolist()[1:]):
                x, y, z = L.piece(a, b, i, i2, j, j2)
                assert len(x) <= steps and not links & set(zip(x.tolist(), y.tolist()))
                links |= set(zip(x.tolist(), y.tolist()))
                common += z.tolist()
            starts = lambda e: np.append(0, e[:-1])
            assert links == {(i, j) for i in range(len(a)) for j in range(len(b)) if max(starts(a)[i], starts(b)[j]) < min(a[i], b[j])}
            assert a[common].tolist() == sorted(set(a.tolist()) & set(b.tolist()))


def test_units_join_to_the_texts():
    texts = [t or "" for t in odd_texts()]
    found, bounds = L.units(pa.array([t.encode() for t in texts], pa.large_binary()))
    words = found.to_pylist()
    for t, p, q in zip(texts, bounds, bounds[1:]):
        assert b" ".join(words[p:q]) == t.encode()


@pytest.mark.parametrize("size", [8 << 20, 400])
def test_align_against_plain(spark, size):
    texts = odd_texts()
    rows = [(i if i % 9 else None, t, f"{i}") for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_a string").repartition(3)
    found = L.align(docs.select("text", F.col("n_a").alias("doc_id"), F.lit("old").alias("rows")), A, B, slice_bytes=size, with_groups=True).collect()
    names = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert len(found) == len(texts)
    want = plain(texts)
    for r in found:
        assert tuple(r[n] for n in names) == want[int(r["doc_id"])], texts[int(r["doc_id"])]
        assert hashlib.sha256(r["groups"].encode()).hexdigest() == r["groups_sha256"] or not r["groups"]
    assert L.align(docs.where("false"), A, B).count() == 0


def test_units_and_pieces_change_nothing():
    """Slices in pieces of a few steps give the figures of one piece, and long texts without spaces are cut by diagonals only."""
    known = L.tokens(A, B)
    texts = ["x" * 5000 + "日本" * 3000, *(t for t in odd_texts() if t)]
    one, many = L.Aligned(known, texts), L.Aligned(known, texts, steps=7)
    assert one.groups == many.groups and one.n_links.tolist() == many.n_links.tolist()
    key = lambda x: sorted(zip(x.unit.tolist(), x.a.tolist(), x.b.tolist()))
    assert key(one) == key(many)


def test_query(spark, small):
    import pyarrow.parquet as pq

    from sievelake.llm.queries import QUERIES

    rows = pq.read_table(f"{small}/documents.parquet", columns=["doc_id", "text"]).to_pylist()
    want = dict(zip((r["doc_id"] for r in rows), plain([r["text"] for r in rows])))
    found = QUERIES["op11_align_tokenizers"](spark, small).collect()
    assert {r["doc_id"]: tuple(r)[1:] for r in found} == want and len(found) == len(rows)


def test_a_slice_is_small(small):
    """What a slice hands on takes less than one and a half times its text, with numbers of any size intact."""
    import pyarrow.parquet as pq

    texts = pq.read_table(f"{small}/documents.parquet", columns=["text"]).column("text").combine_chunks()
    size, made = 0, 0
    for p, q in L._cuts(texts, L.SLICE_BYTES):
        found = L._slice(L.tokens(A, B), L.binary_column(texts.slice(p, q - p)), False)
        made += sum(len(v) for v in found.values() if isinstance(v, bytes))
        size += sum(len((t or "").encode()) for t in texts.slice(p, q - p).to_pylist())
    assert size and made < 1.5 * size
    for top in (0, 255, 256, 65535, 65536, 2**32, 2**40):
        assert L._unpacked(L._packed(np.array([0, top, 1]))).tolist() == [0, top, 1]
    assert L._unpacked(L._packed(np.zeros(0, np.int64))).tolist() == []


def test_a_task_holds_one_slice_at_a_time(spark, small):
    """Slices go to Python one by one, not in batches of a whole partition, and no array is made of a slice's pairs."""
    docs = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text")
    plan = L.align(docs, A, B, slice_bytes=1 << 14)._jdf.queryExecution().toString()
    assert "FlatMapCoGroupsInArrow" in plan and "collect_list" not in plan
