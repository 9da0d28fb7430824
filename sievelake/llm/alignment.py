"""Cross-tokenizer alignment: groups between common token ends, and links of tokens whose bytes overlap, of two tokenizers.

Both tokenizers cut a text before every single space between two solid characters, so a text is a sequence of units, and
both sequences of tokens end at each unit's end. A slice of texts is tokenised once per distinct unit. The ends of the
units' A and B tokens, laid one after the other, are two sorted lists; merge path cuts their merging into pieces of equal
work by a binary search on each diagonal, whatever the units' lengths. A piece emits the overlaps of its steps and, by the
common ends it holds, parts of groups; the groups that a diagonal cuts are stitched.

How many documents hold an id pair is counted per slice, summed over slices by id pair, and given back to each slice for
its own pairs only: nothing as large as all pairs is sent anywhere, and no pair has more rows than there are slices.
"""

from __future__ import annotations

import functools
import hashlib
import itertools
import json
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import binary_column, materialize

#: White space beyond ASCII, as the tokenizers' patterns know it: texts with it are one unit.
WIDE_SPACE = re.compile("[\u0085\u00a0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")
#: The A tokenizer's words, as stated for its vocabulary.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
STEPS = 1 << 16
SLICE_BYTES = 1 << 20
TOGETHER = 4096
LONG_SPACE = re.compile(r"\s{1000}")


def _byte_letters() -> dict[str, int]:
    """The letter by which byte-level vocabularies write each byte: printable ones themselves, others from U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class Tokens:
    """Both tokenizers, with the number of bytes of each token."""

    def __init__(self, a_path: str, b_path: str):
        import sentencepiece
        import tiktoken

        self.path = a_path
        with open(a_path, encoding="utf-8") as file:
            spec = json.load(file)
        letters = _byte_letters()
        special = {t["content"] for t in spec["added_tokens"]}
        ranks = {bytes(letters[c] for c in piece): i for piece, i in spec["model"]["vocab"].items() if piece not in special}
        # where merges are in the order of the ids, the faster library gives the same tokens
        merges = (m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"])
        self.in_order = all(spec["model"]["vocab"].get("".join(m)) == 256 + k for k, m in enumerate(merges))
        self.a = tiktoken.Encoding("a", pat_str=WORDS, mergeable_ranks=ranks, special_tokens={})
        self.a_bytes = {i: piece for piece, i in ranks.items()}
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        pieces = (self.b.id_to_piece(i) for i in range(self.b.get_piece_size()))
        self.b_bytes = [bytes([int(p[3:5], 16)]) if re.fullmatch("<0x[0-9A-F]{2}>", p) else p.replace("▁", " ").encode() for p in pieces]
        # a space may only start a token, and begins a word of the pattern: then texts can be cut before single spaces
        self.cut = not any("▁" in self.b.id_to_piece(i).lstrip("▁") for i in range(self.b.get_piece_size()))
        self.a_sizes = np.zeros(max(self.a_bytes) + 1, np.int64)
        for i, piece in self.a_bytes.items():
            self.a_sizes[i] = len(piece)
        self.b_pieces = pa.array(self.b_bytes, pa.large_binary())
        self.b_sizes = np.array([len(p) for p in self.b_bytes], np.int64)

    def encode_a(self, text: str) -> list[int]:
        if not self.in_order or (len(text) > 1000 and LONG_SPACE.search(text)):  # the pattern goes back over white space
            return _reference(self.path).encode(text, add_special_tokens=False).ids
        return self.a.encode_ordinary(text)

    def encode_units(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """A tokens of space + text of every unit, one after the other, and how many each has.

        Short units between solid characters are encoded together, as the text they would be cut from.
        """
        size = np.array([len(t.encode()) for t in texts], np.int64) + 1
        plain = [self.in_order and len(t) < 1000 and t[:1] > " " and t[-1:] > " " and not WIDE_SPACE.search(t[0] + t[-1]) for t in texts]
        parts, counts, i = [], np.zeros(len(texts), np.int64), 0
        while i < len(texts):
            j = i + 1
            if plain[i]:
                while j < len(texts) and j - i < TOGETHER and plain[j]:
                    j += 1
                ids = np.array(self.a.encode_ordinary(" " + " ".join(texts[i:j])), np.int64)
                counts[i:j] = np.diff(np.searchsorted(np.cumsum(self.a_sizes[ids]), np.cumsum(size[i:j])) + 1, prepend=0)
            else:
                ids = np.array(self.encode_a(" " + texts[i]), np.int64)
                counts[i] = len(ids)
            parts.append(ids)
            i = j
        return np.concatenate([np.zeros(0, np.int64), *parts]), counts

    def good_units(self, texts: list[str], a: np.ndarray, n_a: np.ndarray, b: np.ndarray, n_b: np.ndarray) -> np.ndarray:
        """Whether both token sequences of each unit are the bytes of space + unit; byte-level ones can only lack some."""
        whole = [b" " + t.encode() for t in texts]
        size, unit_a, unit_b = np.array([len(w) for w in whole], np.int64), np.repeat(np.arange(len(texts)), n_a), np.repeat(np.arange(len(texts)), n_b)
        total = lambda unit, sizes: np.bincount(unit, sizes, len(texts)).astype(np.int64)
        good = (total(unit_a, self.a_sizes[a]) == size) & (total(unit_b, self.b_sizes[b]) == size)
        # of the units of the right length, the bytes one after the other
        made = self.b_pieces.take(pa.array(b[good[unit_b]]))
        ends = np.frombuffer(made.buffers()[1], np.int64)[: len(made) + 1]
        data = np.frombuffer(made.buffers()[2], np.uint8)[ends[0] : ends[-1]] if len(made) else np.zeros(0, np.uint8)
        wanted = np.frombuffer(b"".join(w for w, g in zip(whole, good) if g), np.uint8)
        some = np.flatnonzero(good)
        wrong = np.bincount(np.repeat(some, size[some])[data != wanted], minlength=len(texts))
        return good & (wrong == 0)


@functools.lru_cache(maxsize=2)
def _reference(a_path: str):
    from tokenizers import Tokenizer

    found = Tokenizer.from_file(a_path)
    found.encode_special_tokens = True
    return found


@functools.lru_cache(maxsize=2)
def tokens(a_path: str, b_path: str) -> Tokens:
    """The tokenizers, loaded once in each process."""
    return Tokens(a_path, b_path)


def units(texts: pa.Array, cuts: bool = True) -> tuple[pa.Array, np.ndarray]:
    """The units of all texts (without the space before them), and each text's first unit."""
    ends = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2], np.uint8)[ends[0] : ends[-1]] if ends[-1] > ends[0] else np.zeros(0, np.uint8)
    ends = ends - ends[0]
    solid = (data > 32) & (data != 127)
    cut = (data == 32) & cuts
    if len(data):
        cut[0] = cut[-1] = False
        cut[1:-1] &= solid[:-2] & solid[2:]
        edges = ends[(ends > 0) & (ends < len(data))]
        cut[edges] = False  # a text's first character
        cut[edges - 1] = False
    # texts with other white space are one unit; few texts have a byte that starts such a character
    odd = np.flatnonzero((data == 0xC2) | (data == 0xE1) | (data == 0xE2) | (data == 0xE3))
    for d in np.unique(np.searchsorted(ends, odd, "right") - 1).tolist():
        if WIDE_SPACE.search(data[ends[d] : ends[d + 1]].tobytes().decode("utf-8", "replace")):
            cut[ends[d] : ends[d + 1]] = False
    at = np.flatnonzero(cut)
    filled = np.flatnonzero(np.diff(ends) > 0)
    starts = np.sort(np.concatenate([ends[:-1][filled], at + 1]))
    bounds = np.searchsorted(starts, ends).astype(np.int64)
    kept = ~cut
    offsets = np.append((np.cumsum(kept) - 1)[starts], kept.sum()).astype(np.int64) if len(starts) else np.zeros(1, np.int64)
    return pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data[kept]))]), bounds


def merge_path(a_ends: np.ndarray, b_ends: np.ndarray, steps: int = STEPS) -> np.ndarray:
    """For every ``steps``-th diagonal of the merging of two sorted lists: how many of the first list lie before it.

    Equal ends are taken from the first list first.
    """
    n, m = len(a_ends), len(b_ends)
    diagonal = np.append(np.arange(0, n + m, steps), n + m)
    low, high = np.maximum(diagonal - m, 0), np.minimum(diagonal, n)
    while (open_ := low < high).any():
        middle = (low + high) // 2
        # a[middle] belongs before b[diagonal - 1 - middle]
        first = open_ & (a_ends[np.minimum(middle, max(n - 1, 0))] <= b_ends[np.clip(diagonal - 1 - middle, 0, max(m - 1, 0))])
        low = np.where(first, middle + 1, low)
        high = np.where(open_ & ~first, middle, high)
    return np.stack([low, diagonal - low])


def piece(a_ends: np.ndarray, b_ends: np.ndarray, i: int, i2: int, j: int, j2: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """One piece of the merging: overlaps (A token, B token), and the steps after which both lists end (as A tokens).

    A step takes the next end of either list and emits the overlap of the two tokens then open. Where it is a common end,
    the first list's step emits it and the second's does not.
    """
    a, b = a_ends[i:i2], b_ends[j:j2]
    # B tokens open at each A step, and A tokens open at each B step
    left = np.searchsorted(b, a, "left") + j
    right = np.searchsorted(a, b, "right") + i
    common = np.zeros(len(a), bool)
    inside = left < len(b_ends)
    common[inside] = b_ends[left[inside]] == a[inside]
    # a B step emits where its end is not an A end
    before = right - 1
    single = np.ones(len(b), bool)
    single[before >= 0] = a_ends[before[before >= 0]] != b[before >= 0]
    pairs_a = np.concatenate([np.arange(i, i2), right[single]])
    pairs_b = np.concatenate([left, np.arange(j, j2)[single]])
    return pairs_a, pairs_b, np.flatnonzero(common) + i


class Aligned:
    """Groups and links of the distinct units of a slice.

    Per unit: ``good`` (both token sequences are its bytes), numbers of tokens, groups and links, its groups as text; per link,
    ordered by unit: ``unit``, ``a``, ``b``.
    """

    def __init__(self, known: Tokens, texts: list[str], steps: int = STEPS):
        a, n_a = known.encode_units(texts)
        b = known.b.encode(texts, num_threads=1) if texts else []
        n_b = np.fromiter(map(len, b), np.int64, len(b))
        b = np.fromiter(itertools.chain.from_iterable(b), np.int64, int(n_b.sum()))
        self.good = known.good_units(texts, a, n_a, b, n_b)
        a, b = a[np.repeat(self.good, n_a)], b[np.repeat(self.good, n_b)]
        self.n_a, self.n_b = n_a * self.good, n_b * self.good
        ids = [a, b]
        ends = [np.cumsum(sizes[x]) for sizes, x in zip((known.a_sizes, known.b_sizes), ids)]
        cuts = merge_path(*ends, steps)
        links_a, links_b, common = [], [], []
        for k in range(cuts.shape[1] - 1):
            found = piece(*ends, cuts[0, k], cuts[0, k + 1], cuts[1, k], cuts[1, k + 1])
            for out, part in zip((links_a, links_b, common), found):
                out.append(part)
        none = np.zeros(0, np.int64)
        at_a, at_b, shared = (np.concatenate([none, *x]).astype(np.int64) for x in (links_a, links_b, common))
        owner = np.repeat(np.arange(len(texts)), self.n_a)
        unit = owner[at_a] if len(at_a) else none
        order = np.argsort(unit, kind="stable")
        self.unit, self.a, self.b = unit[order], ids[0][at_a][order], ids[1][at_b][order]
        self.n_links = np.bincount(self.unit, minlength=len(texts))
        # groups go from one common end to the next, across the pieces
        shared_b = np.searchsorted(ends[1], ends[0][shared]) if len(shared) else none
        self.n_groups = np.bincount(owner[shared], minlength=len(texts)) if len(shared) else np.zeros(len(texts), np.int64)
        self.groups = self._texts(ids, shared, shared_b, len(texts))

    def _texts(self, ids, shared, shared_b, n) -> list[bytes]:
        """``a1,a2|b1;a3|b2`` of each unit: all tokens in the order of the groups, each with the sign after it."""
        if not len(shared):
            return [b""] * n
        group = [np.repeat(np.arange(len(shared)), np.diff(last + 1, prepend=0)) for last in (shared, shared_b)]
        place = np.argsort(np.concatenate([2 * group[0], 2 * group[1] + 1]), kind="stable")
        sign = np.zeros(len(place), np.int32)  # a comma, but after a group's last tokens
        sign[shared], sign[len(ids[0]) + shared_b] = 1, 2
        written = pc.binary_join_element_wise(pc.cast(pa.array(np.concatenate(ids)[place]), pa.large_string()), SIGNS.take(pa.array(sign[place])), pa.scalar("", pa.large_string()))
        ends = np.frombuffer(written.buffers()[1], np.int64)[written.offset : written.offset + len(written) + 1]
        data = written.buffers()[2].to_pybytes()
        # where each unit's last group ends, without its last sign
        tokens = np.cumsum(self.n_a + self.n_b)
        stops = ends[tokens]
        starts = np.append(ends[0], stops[:-1])
        return [data[p : q - 1] if q > p else b"" for p, q in zip(starts.tolist(), stops.tolist())]


SIGNS = pa.array([",", "|", ";"], pa.large_string())
SUMS = ("n_a", "n_b", "n_groups", "n_links")
ROWS = "slice long, keys binary, rows array<struct<n_a:long,n_b:long,n_groups:long,n_links:long,groups_sha256:string,groups:string>>, doc_units binary, units binary, times binary, unit_links binary, link_pair binary, pairs_a binary, pairs_b binary, counts binary"
#: Bytes of a group of rows in the table of slices: a task reads, and holds, one at a time.
GROUP_BYTES = 16 << 20


def _packed(numbers: np.ndarray) -> bytes:
    """Whole numbers from 0 on in the smallest type that holds them, after a byte with its size."""
    size = next(k for k in (1, 2, 4, 8) if int(numbers.max(initial=0)) < 1 << 8 * k)
    return bytes([size]) + np.ascontiguousarray(numbers, f"<u{size}").tobytes()


def _unpacked(data: bytes) -> np.ndarray:
    return np.frombuffer(data, f"<u{data[0]}", offset=1).astype(np.int64)


def _slice(known: Tokens, texts: pa.Array, with_groups: bool) -> dict:
    """Everything of a slice that needs no other: figures of its texts, its distinct id pairs and how many texts hold each."""
    split, bounds = units(texts, known.cut)
    coded = split.dictionary_encode()
    word = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    aligned = Aligned(known, [w.decode("utf-8", "replace") for w in coded.dictionary.to_pylist()])
    n, doc = len(texts), np.repeat(np.arange(len(texts)), np.diff(bounds))
    good = np.bincount(doc[~aligned.good[word]], minlength=n) == 0
    used = good[doc]
    word, doc = word[used], doc[used]
    sums = {s: np.bincount(doc, getattr(aligned, s)[word], n).astype(np.int64) for s in SUMS}
    ends = np.cumsum(np.bincount(doc, minlength=n)).tolist()
    groups = [b";".join([aligned.groups[w] for w in word[p:q].tolist()]) for p, q in zip([0, *ends[:-1]], ends)]
    rows = [dict(zip(SUMS, map(int, r)), groups_sha256=hashlib.sha256(g).hexdigest() if g else "", groups=g.decode() if with_groups else None) for *r, g in zip(*sums.values(), groups)]
    # distinct id pairs, the links of each unit, and the units of each text
    keys, link_pair = np.unique(aligned.a << 32 | aligned.b, return_inverse=True)
    size = max(len(coded.dictionary), 1)
    both, times = np.unique(doc * size + word, return_counts=True)
    doc_of, unit_of = both // size, both % size
    # texts that hold a pair: each text's distinct units' distinct pairs, once per text
    own = np.unique(aligned.unit * max(len(keys), 1) + link_pair)
    first = np.searchsorted(own, np.arange(size + 1) * max(len(keys), 1))
    each = np.diff(first)[unit_of]
    at = np.repeat(first[unit_of] - np.cumsum(each) + each, each) + np.arange(each.sum())
    held = np.unique(np.repeat(doc_of, each) * max(len(keys), 1) + own[at] % max(len(keys), 1))
    counts = np.bincount(held % max(len(keys), 1), minlength=len(keys)) if len(held) else np.zeros(len(keys), np.int64)
    # texts and units are in order, so how many rows each has tells whose they are
    numbers = {"doc_units": np.bincount(doc_of, minlength=n), "units": unit_of, "times": times, "unit_links": np.bincount(aligned.unit, minlength=size), "link_pair": link_pair, "pairs_a": keys >> 32, "pairs_b": keys & 0xFFFFFFFF, "counts": counts}
    return {"rows": rows} | {k: _packed(v) for k, v in numbers.items()}


def _cuts(texts: pa.Array, most: int):
    """Consecutive row ranges of at most ``most`` bytes of text (one row at least)."""
    ends, at = np.append(0, np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64))), 0
    while at < len(texts):
        stop = max(at + 1, int(np.searchsorted(ends, ends[at] + most, "right")) - 1)
        yield at, stop
        at = stop


def sliced(docs: DataFrame, a_path: str, b_path: str, key: str = "doc_id", text: str = "text", slice_bytes: int = SLICE_BYTES, with_groups: bool = False) -> DataFrame:
    """One row per slice of texts: the figures of its texts, and its distinct id pairs with the texts that hold them."""
    kind = docs.schema[key].dataType.simpleString()
    schema = ROWS.replace("keys binary", f"keys array<{kind}>")
    fields = ("doc_units", "units", "times", "unit_links", "link_pair", "pairs_a", "pairs_b", "counts")
    row = pa.list_(pa.struct([*((s, pa.int64()) for s in SUMS), ("groups_sha256", pa.string()), ("groups", pa.string())]))

    def run(batches):
        known, number = tokens(a_path, b_path), TaskContext.get().partitionId() << 32
        for batch in batches:
            for p, q in _cuts(batch.column(1), slice_bytes):
                found = _slice(known, binary_column(batch.column(1).slice(p, q - p)), with_groups)
                keys = pa.ListArray.from_arrays(pa.array([0, q - p], pa.int32()), batch.column(0).slice(p, q - p))
                yield pa.RecordBatch.from_arrays([pa.array([number], pa.int64()), keys, pa.array([found["rows"]], row), *(pa.array([found[f]], pa.binary()) for f in fields)], names=["slice", "keys", "rows", *fields])
                number += 1

    return docs.select(key, text).mapInArrow(run, schema)


def pair_counts(slices_: DataFrame) -> DataFrame:
    """(a, b, n_docs, best): in how many texts each id pair is linked, and whether that is the most of its A id."""
    each = _pairs(slices_).groupBy("a", "b").agg(F.sum("n").alias("n_docs")).where("n_docs > 0")
    top = each.groupBy(F.col("a").alias("_a")).agg(F.max("n_docs").alias("_most"))
    return each.join(top, F.col("a") == F.col("_a")).select("a", "b", "n_docs", (F.col("n_docs") == F.col("_most")).alias("best"))


def _pairs(slices_: DataFrame) -> DataFrame:
    def run(batches):
        for batch in batches:
            for number, *columns in zip(*(batch.column(n).to_pylist() for n in ("slice", "pairs_a", "pairs_b", "counts"))):
                a, b, n = map(_unpacked, columns)
                yield pa.record_batch({"slice": np.full(len(a), number), "i": np.arange(len(a), dtype=np.int32), "a": a.astype(np.int32), "b": b.astype(np.int32), "n": n})

    return slices_.select("slice", "pairs_a", "pairs_b", "counts").mapInArrow(run, "slice long, i int, a int, b int, n long")


def align(docs: DataFrame, a_path: str, b_path: str, key: str = "doc_id", text: str = "text", slice_bytes: int = SLICE_BYTES, with_groups: bool = False) -> DataFrame:
    """One row per row of ``docs``: tokens, groups and links of both tokenizers, and the links' counts over all texts.

    A is a byte-level BPE of a ``tokenizers`` file whose merges are in the order of its ids and whose words are ``WORDS``; B is a
    SentencePiece model that adds the space. n_best counts links whose id pair is linked in the most texts of all pairs of its A id
    (ties included), count_sum adds the numbers of texts over links. ``with_groups`` adds the groups as text (``a1,a2|b1;...``).

    Nulls, empty texts, and texts that a tokenizer does not give back byte by byte have no tokens: zeros and ''. Repeated
    rows are texts of their own, whatever their keys; other columns are not read; no rows give no rows.
    """
    kind = docs.schema[key].dataType.simpleString()
    parts = materialize(sliced(docs, a_path, b_path, key, text, slice_bytes, with_groups), "aligned-slices", **{"parquet.block.size": GROUP_BYTES})
    counts = materialize(pair_counts(parts), "pair-counts").withColumnsRenamed({"a": "_a", "b": "_b"})
    known = _pairs(parts).where("n > 0").join(counts, (F.col("a") == F.col("_a")) & (F.col("b") == F.col("_b"))).select("slice", "i", "n_docs", "best")
    names = [*SUMS, "groups_sha256", *(["groups"] if with_groups else [])]
    keep = ["doc_units", "units", "times", "unit_links", "link_pair"]

    def run(slice_: pa.Table, own: pa.Table) -> pa.Table:
        """A slice with its own pairs: one slice is in memory at a time, however many a partition has."""
        one = slice_.combine_chunks()
        rows = pa.concat_arrays(one.column("rows").chunks).flatten()
        doc_units, word, times, unit_links, pair = (_unpacked(one.column(c)[0].as_py()) for c in keep)
        doc, unit = np.repeat(np.arange(len(rows)), doc_units), np.repeat(np.arange(len(unit_links)), unit_links)
        n_pairs = int(pair.max(initial=-1)) + 1
        count, best = np.zeros(n_pairs, np.int64), np.zeros(n_pairs, np.int64)
        i = own.column("i").to_numpy()
        count[i], best[i] = own.column("n_docs").to_numpy(), own.column("best").to_numpy()
        sums = {}
        for name, weight in (("n_best", best), ("count_sum", count)):
            # whole numbers: added as such, not as floating-point weights
            of_unit, of_doc = np.zeros(len(unit_links), np.int64), np.zeros(len(rows), np.int64)
            np.add.at(of_unit, unit, weight[pair])
            np.add.at(of_doc, doc, of_unit[word] * times)
            sums[name] = pa.array(of_doc)
        keys = pa.concat_arrays(one.column("keys").chunks).flatten()
        return pa.Table.from_arrays([keys, *sums.values(), *(rows.field(n) for n in names)], names=[key, *sums, *names])

    figures = ", ".join(f"{n} {'string' if n.startswith('groups') else 'long'}" if n != "n_groups" else "n_groups long" for n in names)
    whole = parts.select("slice", "keys", "rows", *keep).groupBy("slice").cogroup(known.groupBy("slice"))
    return whole.applyInArrow(run, f"`{key}` {kind}, n_best long, count_sum long, {figures}")
