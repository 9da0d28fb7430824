"""Exact Jaccard join of documents on word shingles by T-occurrence search over inverted lists.

1. A sketch counts all shingles in a fixed number of slots, which gives one global order: rare shingles first. The order
   steers the cost only.
2. Two linked sets share a shingle among the first few of each in that order, so only those are sent, to inverted lists
   over all documents. Documents with equal sets are one entry.
3. Within a list, sizes and 512-bit parity signatures rule out what can't be linked: the signatures of two sets differ in
   at most as many bits as the sets differ in elements. Pairs that are connected already are not tried again. A long list
   is cut into blocks, which are searched by tasks of their own.
4. The sets of the remaining pairs are searched with DivideSkip: they are indexed together in inverted lists over all their
   shingles; the short lists of a query are heap-merged, the long ones are probed by binary search, and those sets are
   retained that reach the overlap which the two sizes require.
5. Then come the pairs that step 3 left out: those across blocks of a list whose entries are still in different
   components, and those that seemed connected through a pair that step 4 refuted.

Shingles are equal if their 64-bit hashes are, and sets if the 128 bits of two sums over them are.
"""

from __future__ import annotations

import heapq
import math
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.graph import connected
from .common import binary_column, materialize, parts_for, rolling, slices, text_size, words_of

BASE = 0xD6E8FEB86659FD93
SHORT = 0xA0761D6478BD642F
S0, S1 = 0x589965CC75374CC3, 0x1D8E4E27C47D124F
SLICE_BYTES = 2 << 20
LIST_BYTES = 1 << 20
LIST_ROWS = 512  # a longer list is cut into blocks
SALT_ROWS = 1 << 20  # a list that may be longer is not brought together at all
CELLS = 512
INDEX_BYTES = 1 << 20
MAP_BITS = 29  # a bitmap of rows has at most 64 MB
NODE_BITS = 64  # of it for each row
BITMAP_BITS = 15  # bits in one of its pieces, which bitmap_construct_agg fixes


def shingle_sets(texts: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of every text, ascending, and the bounds of each text's part.

    A text of fewer words than ``width`` has its whole word sequence as its one shingle, without words it has none.
    """
    words, bounds = words_of(texts, lower=True)
    count = np.diff(bounds)
    doc = np.repeat(np.arange(len(count)), count)
    hashes = rolling(words, width, BASE)
    whole = doc[: len(hashes)] == doc[width - 1 :] if len(hashes) else np.zeros(0, bool)
    owner, hashes = doc[: len(hashes)][whole], hashes[whole]
    few = np.flatnonzero((count > 0) & (count < width))
    if len(few):
        one = []
        for i in few:
            h = SHORT + int(count[i])
            for w in words[bounds[i] : bounds[i + 1]].tolist():
                h = (h * BASE + w) & 0xFFFFFFFFFFFFFFFF
            one.append(h)
        owner, hashes = np.append(owner, few), np.append(hashes, np.array(one, np.uint64))
    order = np.lexsort((hashes, owner))
    owner, hashes = owner[order], hashes[order]
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])
    owner, hashes = owner[new], hashes[new]
    return hashes, np.searchsorted(owner, np.arange(len(count) + 1))


def _mix(x: np.ndarray, k: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(31))) * np.uint64(k)
        return x ^ (x >> np.uint64(29))


def _per_doc(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sum (mod 2^64) of each document's values."""
    with np.errstate(over="ignore"):
        total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(values, dtype=np.uint64)))
        return total[bounds[1:]] - total[bounds[:-1]]


def signatures(hashes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Parity of the number of elements in each of CELLS cells, 64 bytes per document."""
    n = len(bounds) - 1
    cell = (_mix(hashes, 0x9FB21C651E98DF25) >> np.uint64(55)).astype(np.int64)
    doc = np.repeat(np.arange(n), np.diff(bounds))
    odd = np.bincount(doc * CELLS + cell, minlength=n * CELLS).reshape(n, CELLS) & 1
    return np.packbits(odd.astype(bool), axis=1)


def _slots(hashes: np.ndarray, bits: int) -> np.ndarray:
    return (_mix(hashes, 0xE7037ED1A0B428DB) >> np.uint64(64 - bits)).astype(np.int64)


def _sketch(docs: DataFrame, width: int, bits: int, groups: int) -> np.ndarray:
    """About log2 of how often the shingles of each of 2^bits slots occur, over all documents (one byte a slot).

    The tasks' counts are added up in two steps, first in ``groups`` groups of tasks.
    """
    chunk = 1 << max(0, bits - 6)
    unpack = lambda x, kind: np.frombuffer(pa.decompress(x, chunk * np.dtype(kind).itemsize, codec="zstd", asbytes=True), kind)
    pack = lambda x: pa.compress(x.tobytes(), codec="zstd", asbytes=True)

    def count(batches):
        # one array for the task (a task has fewer shingles than 2^32); a slice only touches the slots of its own shingles
        total = np.zeros(1 << bits, np.uint32)
        for batch in batches:
            texts = binary_column(batch.column("text"))
            for s, e in slices(texts, SLICE_BYTES):
                np.add.at(total, _slots(shingle_sets(texts[s:e], width)[0], bits), 1)
        parts = [(i, total[i * chunk : (i + 1) * chunk]) for i in range((1 << bits) // chunk)]
        parts = [(i, x) for i, x in parts if x.any()]
        group = TaskContext.get().partitionId() % groups
        yield pa.RecordBatch.from_pydict({"chunk": pa.array([i for i, _ in parts], pa.int32()), "grp": pa.array([group] * len(parts), pa.int32()), "counts": pa.array([pack(x) for _, x in parts], pa.binary())})

    def add(last: bool):
        def run(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros(chunk, np.uint64)
            for batch in batches:
                for x in batch.column("counts").to_pylist():
                    total += unpack(x, np.uint64 if last else np.uint32)
            data = np.ceil(np.log2(total.astype(np.float64) + 1) * 2).astype(np.uint8).tobytes() if last else pack(total)
            yield pa.RecordBatch.from_pydict({"chunk": pa.array([key[0].as_py()], pa.int32()), "counts": pa.array([data], pa.binary())})

        return run

    rows = docs.select("text").mapInArrow(count, "chunk int, grp int, counts binary")
    rows = rows.groupBy("chunk", "grp").applyInArrow(add(False), "chunk int, counts binary").groupBy("chunk").applyInArrow(add(True), "chunk int, counts binary").collect()
    out = np.zeros(1 << bits, np.uint8)  # 2^bits bytes, at most 64 MB
    for r in rows:
        out[r["chunk"] * chunk : (r["chunk"] + 1) * chunk] = np.frombuffer(r["counts"], np.uint8)
    return out


def _salts(level: np.ndarray) -> np.ndarray:
    """Into how many parts the list of a shingle of this slot is dealt: 1, unless it stands out and may be very long."""
    usual = 2.0 ** (np.median(level) / 2)
    often = 2.0 ** (np.arange(128) / 2)
    return np.where(often > max(SALT_ROWS, 64 * usual), np.ceil(often / SALT_ROWS), 1).astype(np.uint64)


_OWN = [("doc_id", pa.int64()), ("row", pa.int64()), ("mark", pa.int32()), ("n", pa.int64()), ("s0", pa.int64()), ("s1", pa.int64()), ("signature", pa.binary())]
_OWN_DDL = "doc_id long, row long, mark int, n long, s0 long, s1 long, signature binary"
_POST = f"kind int, part long, data binary, {_OWN_DDL}"
_POST_SCHEMA = pa.schema([("kind", pa.int32()), ("part", pa.int64()), ("data", pa.binary()), *_OWN])
_ENTRY = np.dtype([("token", "<u8"), ("s0", "<u8"), ("n", "<u4"), ("role", "u1")])


def _postings(width: int, percent: int, bits: int, part_bits: int, held):
    """Per row its size, set hashes and signature (kind 1); per list range the packed prefix entries (kind 0).

    Bit 0 of an entry's role: it may be the smaller of a pair; bit 1: its list is dealt over several parts.
    """

    def run(batches):
        level, salts = held.value
        for batch in batches:
            texts, ids = binary_column(batch.column("text")), batch.column("doc_id").cast(pa.int64())
            rows, marks32 = batch.column("row"), batch.column("mark")
            for s, e in slices(texts, SLICE_BYTES):
                hashes, bounds = shingle_sets(texts[s:e], width)
                n = np.diff(bounds)
                s0, s1 = _per_doc(_mix(hashes, S0), bounds), _per_doc(_mix(hashes, S1), bounds)
                marks = signatures(hashes, bounds)
                m = e - s
                # these rows only pass by the lists, so they are dealt by id and text: copies of a text are not one group
                parts = pa.array((rows.slice(s, m).to_numpy().view(np.uint64) >> np.uint64(64 - part_bits)).astype(np.int64))
                own = [ids.slice(s, m), rows.slice(s, m), marks32.slice(s, m), pa.array(n.astype(np.int64)), pa.array(s0.view(np.int64)), pa.array(s1.view(np.int64)), pa.array([x.tobytes() for x in marks], pa.binary())]
                yield pa.RecordBatch.from_arrays([pa.array(np.ones(m, np.int32)), parts, pa.nulls(m, pa.binary()), *own], schema=_POST_SCHEMA)
                _, first = np.unique(np.stack([s0, s1], axis=1), axis=0, return_index=True)
                chosen = np.zeros(m, bool)
                chosen[first] = True
                chosen &= n > 0
                doc = np.repeat(np.arange(m), n)
                keep = chosen[doc]
                token, doc = hashes[keep], doc[keep]
                often = level[_slots(token, bits)]
                order = np.lexsort((token, often, doc))
                token, doc, often = token[order], doc[order], often[order]
                place = np.arange(len(doc)) - np.searchsorted(doc, doc, "left")
                size = n[doc]
                probe = place <= size - (percent * size + 99) // 100
                index = place <= size - (2 * percent * size + 99 + percent) // (100 + percent)
                entry = np.zeros(int(probe.sum()), _ENTRY)
                salt = salts[often]
                for name, value in (("token", token), ("s0", s0[doc]), ("n", size), ("role", index + 2 * (salt > 1))):
                    entry[name] = value[probe]
                dealt = _mix(entry["token"] ^ _mix(entry["s0"], 0xA24BAED4963EE407) % salt[probe], 0x9FB21C651E98DF25)
                where = (np.where(entry["role"] > 1, dealt, entry["token"]) >> np.uint64(64 - part_bits)).astype(np.int64)
                order = np.argsort(where, kind="stable")
                where, entry = where[order], entry[order]
                cuts = np.flatnonzero(np.diff(where, prepend=-1))
                stops = np.append(cuts[1:], len(where)) if len(cuts) else cuts
                if len(cuts):
                    k = len(cuts)
                    data = pa.array([entry[a:b].tobytes() for a, b in zip(cuts, stops, strict=True)], pa.binary())
                    yield pa.RecordBatch.from_arrays([pa.array(np.zeros(k, np.int32)), pa.array(where[cuts]), data, *(pa.nulls(k, t) for _, t in _OWN)], schema=_POST_SCHEMA)

    return run


_LISTS = f"kind int, token long, role int, {_OWN_DDL}"
_LISTS_SCHEMA = pa.schema([("kind", pa.int32()), ("token", pa.int64()), ("role", pa.int32()), *_OWN])


def _lists(percent: int):
    """Entries (kind 0) that have, or whose list is dealt and may have, a neighbour of fitting size; rows (kind 1) pass."""

    def run(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packed = []
        for batch in batches:
            kinds = batch.column("kind").to_numpy()
            own = batch.filter(pa.array(kinds == 1))
            if own.num_rows:
                yield pa.RecordBatch.from_arrays([own.column("kind"), pa.nulls(own.num_rows, pa.int64()), pa.nulls(own.num_rows, pa.int32()), *(own.column(c) for c, _ in _OWN)], schema=_LISTS_SCHEMA)
            packed += [np.frombuffer(x, _ENTRY) for x in batch.filter(pa.array(kinds == 0)).column("data").to_pylist()]
        if not packed:
            return
        e = np.concatenate(packed)
        del packed
        e = e[np.lexsort((e["s0"], e["n"], e["token"]))]
        same = np.zeros(len(e), bool)
        same[1:] = (e["token"][1:] == e["token"][:-1]) & (e["s0"][1:] == e["s0"][:-1])
        e = e[~same]
        near = e["role"] > 1
        n = e["n"].astype(np.int64)
        pair = (e["token"][1:] == e["token"][:-1]) & (100 * n[:-1] >= percent * n[1:])
        near[1:] |= pair
        near[:-1] |= pair
        e = e[near]
        for at in range(0, len(e), 100_000):
            x = e[at : at + 100_000]
            column = lambda name, kind: pa.array(np.ascontiguousarray(x[name]).astype(kind, copy=False).view(np.int64))
            held = {"n": column("n", np.int64), "s0": column("s0", np.uint64)}
            own = [held.get(name, pa.nulls(len(x), t)) for name, t in _OWN]
            yield pa.RecordBatch.from_arrays([pa.array(np.zeros(len(x), np.int32)), column("token", np.uint64), pa.array((x["role"] & 1).astype(np.int32)), *own], schema=_LISTS_SCHEMA)

    return run


def _allowed(na: np.ndarray, nb: np.ndarray, percent: int) -> np.ndarray:
    """Largest symmetric difference of linked sets of these sizes."""
    both = na + nb
    return both - 2 * -(-percent * both // (100 + percent))


def _lists_of(batches: Iterator[pa.RecordBatch], *more: str):
    """Entries of lists sorted by (token, n, s0), as columns, and the bounds of each list."""
    table = pa.Table.from_batches(list(batches))
    marks = np.frombuffer(b"".join(table.column("signature").to_pylist()), np.uint64).reshape(table.num_rows, CELLS // 64)
    columns = [table.column(c).to_numpy() for c in ("token", "s0", "n", "role", *more)]
    order = np.lexsort((columns[1], columns[2], columns[0]))
    token, *columns = (c[order] for c in columns)
    cuts = np.flatnonzero(np.concatenate(([True], token[1:] != token[:-1])))
    return marks[order], columns, cuts, np.append(cuts[1:], len(token))


def _fits(percent: int, s0: np.ndarray, n: np.ndarray, role: np.ndarray, marks: np.ndarray):
    """Whether entries j (the smaller) and i can be linked: by size, role and signature."""

    def fits(j: np.ndarray, i: np.ndarray) -> np.ndarray:
        ok = (role[j] > 0) & (100 * n[j] >= percent * n[i]) & (s0[j] != s0[i])
        left = np.flatnonzero(ok)
        if len(left):
            a, b = j[left], i[left]
            ok[left] = np.bitwise_count(marks[a] ^ marks[b]).sum(axis=1) <= _allowed(n[a], n[b], percent)
        return ok

    return fits


def _batch_of(found: set[tuple[int, int]]) -> pa.RecordBatch:
    pairs = sorted({(min(p), max(p)) for p in found})
    return pa.RecordBatch.from_pydict({"a": pa.array([p[0] for p in pairs], pa.int64()), "b": pa.array([p[1] for p in pairs], pa.int64())})


def _pairs(percent: int):
    """Candidate pairs of some lists: sizes and signatures allow a link, and no pair found before connects them."""

    def run(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marks, (s0, n, role), cuts, stops = _lists_of(batches)
        fits = _fits(percent, s0, n, role, marks)
        found: set[tuple[int, int]] = set()
        up: dict[int, int] = {}

        def top(x: int) -> int:
            while (y := up.get(x, x)) != x:
                up[x] = x = up.get(y, y)
            return x

        two = cuts[stops - cuts == 2]
        good = two[fits(two, two + 1)]
        found.update(zip(s0[good].tolist(), s0[good + 1].tolist(), strict=True))
        for start, stop in zip(cuts.tolist(), stops.tolist(), strict=True):
            if stop - start <= 2:
                continue
            ids = s0[start:stop].tolist()
            lows = np.searchsorted(n[start:stop] * 100, percent * n[start:stop]).tolist()
            tops = np.array([top(x) for x in ids], np.int64)  # component of each entry by the pairs found so far
            for i in range(1, stop - start):
                at, most = lows[i], 8
                while at < i:  # in growing steps: in a group of copies the first one tried is linked, and those connected with it are skipped
                    step = at + np.flatnonzero(tops[at:i] != tops[i])[:most]
                    if not len(step):
                        break
                    at, most = int(step[-1]) + 1, 2 * most
                    for x in step[fits(start + step, np.full(len(step), start + i))].tolist():
                        if tops[x] != tops[i]:
                            found.add((ids[x], ids[i]))
                            low, high = sorted((int(tops[x]), int(tops[i])))
                            up[high] = low
                            tops[tops == high] = low
        yield _batch_of(found)

    return run


def _rest(percent: int):
    """All pairs of different components (``grp``) in some lists whose sizes and signatures allow a link.

    ``minor`` entries are those outside the list's largest component: of a pair that counts, one is. They are compared
    with every entry; of two guests from other blocks the pair is found elsewhere.
    """

    def run(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marks, (s0, n, role, group, minor, guest), cuts, stops = _lists_of(batches, "grp", "minor", "guest")
        fits = _fits(percent, s0, n, role, marks)
        found: set[tuple[int, int]] = set()
        for start, stop in zip(cuts.tolist(), stops.tolist(), strict=True):
            for i in (start + np.flatnonzero(minor[start:stop])).tolist():
                other = (group[start:stop] != group[i]) & ~(guest[start:stop] & guest[i])
                before, after = start + np.flatnonzero(other[: i - start]), i + 1 + np.flatnonzero(other[i + 1 - start :])
                after = after[~minor[after]]
                before, after = before[fits(before, np.full(len(before), i))], after[fits(np.full(len(after), i), after)]
                found.update((x, int(s0[i])) for x in (*s0[before].tolist(), *s0[after].tolist()))
        yield _batch_of(found)

    return run


def divide_skip(lists: list[list[int]], least: int) -> dict[int, int]:
    """Ids on at least ``least`` of the ascending id lists, with the number of lists.

    The longest lists are set aside; the others are merged with a heap, and the ids that occur often enough there to be
    able to reach ``least`` are looked up in the long lists by binary search.
    """
    lists = sorted((x for x in lists if x), key=len)
    longest = len(lists[-1]) if lists else 0
    aside = min(max(0, least - 1), int(least / (0.0085 * math.log2(longest + 1) + 1))) if longest else 0
    aside = min(aside, len(lists))
    short, long_ = lists[: len(lists) - aside], lists[len(lists) - aside :]
    out, need = {}, least - len(long_)
    at, count = None, 0

    def settle(x: int, seen: int) -> None:
        if seen >= need:
            for k, one in enumerate(long_):
                if seen + len(long_) - k < least:
                    return
                i = bisect_left(one, x)
                seen += i < len(one) and one[i] == x
            if seen >= least:
                out[x] = seen

    for x in heapq.merge(*short):
        if x == at:
            count += 1
        else:
            if at is not None:
                settle(at, count)
            at, count = x, 1
    if at is not None:
        settle(at, count)
    return out


class Index:
    """Inverted lists over all shingles of some sets."""

    def __init__(self, sets: list[np.ndarray]):
        self.sizes = np.array([len(x) for x in sets], np.int64)
        tokens, owner = np.concatenate(sets), np.repeat(np.arange(len(sets)), self.sizes)
        order = np.lexsort((owner, tokens))
        tokens, self.owner = tokens[order], owner[order]
        self.starts = np.flatnonzero(np.concatenate(([True], tokens[1:] != tokens[:-1]))) if len(tokens) else np.zeros(0, np.int64)
        self.stops = np.append(self.starts[1:], len(tokens)) if len(tokens) else self.starts
        self.tokens = tokens[self.starts]

    def search(self, query: np.ndarray, percent: int) -> list[int]:
        """The sets that are linked with ``query``, by T-occurrence search over the lists of its shingles."""
        if not len(query) or not len(self.tokens):
            return []
        place = np.minimum(np.searchsorted(self.tokens, query), len(self.tokens) - 1)
        place = place[self.tokens[place] == query]
        needs = -(-percent * (len(query) + self.sizes) // (100 + percent))
        fitting = (100 * self.sizes >= percent * len(query)) & (100 * len(query) >= percent * self.sizes)
        if not fitting.any():
            return []
        least = int(needs[fitting].min())
        if len(place) < least:
            return []
        lists = [self.owner[a:b].tolist() for a, b in zip(self.starts[place].tolist(), self.stops[place].tolist(), strict=True)]
        return [i for i, shared in divide_skip(lists, max(1, least)).items() if shared >= needs[i]]


def _verify(width: int, percent: int):
    """Pairs with ok: whether the search for set ``a`` retains set ``b``, in one index of the sets of many pairs."""

    def run(batches):
        for batch in batches:
            a, b, za, zb, ka, kb = (batch.column(c).to_pylist() for c in ("a", "b", "za", "zb", "ka", "kb"))
            at = 0
            while at < len(a):
                packed: dict[int, tuple[bytes, int]] = {}
                stop, size = at, 0
                while stop < len(a) and (size < INDEX_BYTES or stop == at):
                    for s, z, k in ((a[stop], za[stop], ka[stop]), (b[stop], zb[stop], kb[stop])):
                        if s not in packed:
                            packed[s] = (z, k)
                            size += k
                    stop += 1
                names = list(packed)
                texts = pa.array([pa.decompress(z, k, codec="zstd", asbytes=True) for z, k in packed.values()], pa.large_binary())
                hashes, bounds = shingle_sets(texts, width)
                sets = dict(zip(names, np.split(hashes, bounds[1:-1]), strict=True))
                held = sorted(set(b[at:stop]))
                index = Index([sets[x] for x in held])
                linked = {(x, held[i]) for x in set(a[at:stop]) for i in index.search(sets[x], percent)}
                ok = [p in linked for p in zip(a[at:stop], b[at:stop], strict=True)]
                yield pa.RecordBatch.from_pydict({"a": pa.array(a[at:stop], pa.int64()), "b": pa.array(b[at:stop], pa.int64()), "ok": pa.array(ok, pa.bool_())})
                at = stop

    return run


def _zip_texts(width: int):
    """Compressed texts of the wanted sets (``s0``); a row whose text has another set only shares the row's hash."""

    def run(batches):
        for batch in batches:
            texts, wanted = binary_column(batch.column("text")), batch.column("s0").to_numpy()
            for s, e in slices(texts, SLICE_BYTES):
                hashes, bounds = shingle_sets(texts[s:e], width)
                right = np.flatnonzero(_per_doc(_mix(hashes, S0), bounds).view(np.int64) == wanted[s:e])
                some = texts[s:e].take(pa.array(right)).to_pylist()
                data = pa.array([pa.compress(t, codec="zstd", asbytes=True) for t in some], pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(wanted[s:e][right]), pa.array([len(t) for t in some], pa.int64()), data], names=["s0", "k", "z"])

    return run


def components(edges: DataFrame) -> DataFrame:
    """(node, label) of the edges (a, b)."""
    return connected(edges, "a", "b").withColumnRenamed("component", "label")


def _row_of(key: Column, text: Column) -> list[Column]:
    """96 bits that tell a row by its id and text; rows that repeat both are one."""
    return [F.xxhash64(key, text).alias("row"), F.hash(text, key).alias("mark")]


def _by_bitmap(docs: DataFrame, rows: DataFrame) -> DataFrame:
    """``docs`` with ``near``: true for all whose ``row`` is one of ``rows``, and for few others.

    One in NODE_BITS of the others is near, more where the bitmap would exceed its 2^MAP_BITS bits. It saves the shuffle
    of rows that are not near; a join with ``rows`` must follow for those that are.
    """
    bits = min(MAP_BITS, max(BITMAP_BITS, (NODE_BITS * rows.count()).bit_length()))
    slot = F.shiftrightunsigned("row", 64 - bits)
    place = {"_piece": F.shiftright(slot, BITMAP_BITS), "_at": slot.bitwiseAND(F.lit((1 << BITMAP_BITS) - 1))}
    pieces = rows.select("row").withColumns(place).groupBy("_piece").agg(F.bitmap_construct_agg("_at").alias("_bitmap"))
    there = F.expr("shiftright(cast(conv(hex(substring(_bitmap, cast(_at div 8 as int) + 1, 1)), 16, 10) as int), cast(_at % 8 as int)) & 1 = 1")
    marked = docs.withColumns(place).join(F.broadcast(pieces), "_piece", "left")
    return marked.select(*docs.columns, F.coalesce(there, F.lit(False)).alias("near"))


def _only_near(docs: DataFrame, rows: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are near ``rows``: all that a join by ``row`` finds, and few others."""
    return _by_bitmap(docs, rows).where("near").select(*docs.columns)


def _linked_rows(docs: DataFrame, width: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """Rows (doc_id, row, mark, n, s0, s1) of ``docs`` (doc_id, text), and the component (x, y) of each of their sets (s0, s1)."""
    spark = docs.sparkSession
    docs = docs.select("doc_id", "text", *_row_of(F.col("doc_id"), F.col("text")))
    total, _ = text_size(docs)
    bits = min(26, max(12, (total // 1024).bit_length()))
    part_bits = max(1, parts_for(total, LIST_BYTES, 16).bit_length() - 1)
    level = _sketch(docs, width, bits, math.isqrt(total >> 27) + 1)
    held = spark.sparkContext.broadcast((level, _salts(level)))  # at most 64 MB
    sent = docs.mapInArrow(_postings(width, percent, bits, part_bits, held), _POST)
    found = materialize(sent.groupBy("part").applyInArrow(_lists(percent), _LISTS), "jaccard-lists")
    own = found.where("kind = 1").select("doc_id", "row", "mark", "n", "s0", "s1", "signature")
    entries = found.where("kind = 0").select("token", "role", "n", "s0")
    # one row and signature for each set that is on a list
    listed = materialize(entries.select("s0").distinct(), "jaccard-listed")
    reps = own.where("n > 0").groupBy("s0").agg(F.min(F.struct("row", "mark")).alias("r"), F.min("signature").alias("signature"))
    reps = materialize(reps.join(listed, "s0", "left_semi").select("s0", "r.row", "r.mark", "signature"), "jaccard-reps")
    marked = entries.join(reps.select("s0", "signature"), "s0").withColumn("part", F.shiftrightunsigned("token", 64 - part_bits))
    long_ = materialize(entries.groupBy("token").agg(F.count(F.lit(1)).alias("rows")).where(F.col("rows") > LIST_ROWS).select("token", F.ceil(F.col("rows") / LIST_ROWS).alias("blocks")), "jaccard-long")
    blocked = marked.join(long_, "token", "left").withColumn("block", F.when(F.col("blocks").isNull(), F.lit(0)).otherwise(F.pmod(F.xxhash64("s0", "token"), F.col("blocks"))))
    first = materialize(blocked.groupBy("part", "block").applyInArrow(_pairs(percent), "a long, b long").distinct(), "jaccard-pairs-1")

    def texts_of(pairs: DataFrame, known: DataFrame | None, name: str) -> DataFrame:
        """Texts of the pairs' sets that are not ``known``."""
        nodes = pairs.select(F.explode(F.array("a", "b")).alias("s0")).distinct()
        nodes = nodes if known is None else nodes.join(known.select("s0"), "s0", "left_anti")
        nodes = materialize(nodes.join(reps.select("s0", "row", "mark"), "s0"), f"{name}-nodes")
        wanted = _only_near(docs, nodes).join(nodes.hint("merge"), ["row", "mark"]).select("s0", "text")  # the same join at every size
        made = materialize(wanted.mapInArrow(_zip_texts(width), "s0 long, k long, z binary").dropDuplicates(["s0"]), f"{name}-texts")
        return made if known is None else known.unionByName(made)

    def verified(pairs: DataFrame, texts: DataFrame, name: str) -> DataFrame:
        side = lambda c: texts.select(F.col("s0").alias(c), F.col("k").alias(f"k{c}"), F.col("z").alias(f"z{c}"))
        return materialize(pairs.join(side("b").hint("merge"), "b").join(side("a").hint("merge"), "a").mapInArrow(_verify(width, percent), "a long, b long, ok boolean"), name)

    texts = texts_of(first, None, "jaccard-1")
    tried = verified(first, texts, "jaccard-links-1")
    links = tried.where("ok").select("a", "b")
    labels = components(links)
    left_out = []
    known = lambda: labels.select(F.col("node").alias("s0"), F.col("label").alias("grp"))
    if tried.where("not ok").limit(1).count():
        # only where a refuted pair stood between others can pairs of one block have been left out
        assumed = materialize(components(tried.select("a", "b")), "jaccard-assumed")
        bad = tried.where("not ok").select(F.col("a").alias("node")).join(assumed, "node").select("label").distinct()
        dirty = materialize(assumed.join(materialize(bad, "jaccard-bad"), "label", "left_semi").select(F.col("node").alias("s0")), "jaccard-dirty")
        again = marked.join(dirty, "s0", "left_semi").join(long_, "token", "left_anti").join(known(), "s0", "left").withColumn("grp", F.coalesce("grp", "s0"))
        left_out.append(again.select("part", F.lit(0).cast("long").alias("block"), "token", "s0", "n", "role", "signature", "grp", F.lit(True).alias("minor"), F.lit(False).alias("guest")))
    if long_.limit(1).count():
        # long lists with entries of several components: those outside the largest one go to all blocks
        parted = blocked.where("blocks is not null").join(known(), "s0", "left").withColumn("grp", F.coalesce("grp", "s0"))
        parted = materialize(parted, "jaccard-parted")
        sizes = parted.groupBy("token", "grp").agg(F.count(F.lit(1)).alias("rows"))
        most = materialize(sizes.groupBy("token").agg(F.max_by("grp", F.struct("rows", "grp")).alias("main"), F.count(F.lit(1)).alias("groups")).where("groups > 1").select("token", "main"), "jaccard-open")
        parted = parted.join(most, "token").withColumn("minor", F.col("grp") != F.col("main"))
        to = F.when(F.col("minor"), F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).otherwise(F.array(F.col("block")))
        parted = parted.withColumn("to", F.explode(to)).select("part", F.col("to").alias("block"), "token", "s0", "n", "role", "signature", "grp", "minor", (F.col("to") != F.col("block")).alias("guest"))
        left_out.append(parted)
    if left_out:
        rows = left_out[0] if len(left_out) == 1 else left_out[0].unionByName(left_out[1])
        second = materialize(rows.groupBy("part", "block").applyInArrow(_rest(percent), "a long, b long").distinct(), "jaccard-pairs-2")
        if second.limit(1).count():
            labels = components(links.unionByName(verified(second, texts_of(second, texts, "jaccard-2"), "jaccard-links-2").where("ok").select("a", "b")))
    labels = materialize(labels.select(F.col("node").alias("s0"), "label"), "jaccard-labels")
    sets = own.where("n > 0").groupBy("s0", "s1").agg(F.min("doc_id").alias("least"))
    linked = F.col("label").isNotNull()
    sets = sets.join(labels, "s0", "left").select("s0", "s1", "least", F.coalesce("label", "s0").alias("x"), F.when(linked, F.lit(0).cast("long")).otherwise(F.col("s1")).alias("y"), linked.alias("linked"))
    return own.drop("signature"), materialize(sets, "jaccard-sets")


def similarity_components(df: DataFrame, width: int = 5, percent: int = 80, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_shingles and component_id of every row: documents linked by 100 * shared >= percent * union of shingles.

    Words are ``[^\\x20\\x09-\\x0D]+`` with A-Z lower-cased; component_id is the smallest id that links lead to. No
    link is lost: lists, candidates and groups have no cap.

    Null and empty texts have no shingles, are linked with nothing, and have themselves as component (a null id: null).
    Rows that repeat a text are linked through their equal sets; rows that repeat an id with different texts are documents
    of their own. Rows with a null id link like others, but only a component without any other id is named null. An empty
    table gives no rows; other columns are not read. ``percent`` is from 51 to 100.
    """
    docs = df.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    own, sets = _linked_rows(docs, width, percent)
    names = sets.groupBy("x", "y", "linked").agg(F.min("least").alias("component_id"))
    named = materialize(sets.join(names, ["x", "y", "linked"]).select("s0", "s1", "component_id"), "jaccard-names")
    # a set that many documents share is one row on the right, so Spark can split its documents
    empty = own.where("n = 0").select("doc_id", F.lit(0).cast("long").alias("n_shingles"), F.col("doc_id").alias("component_id"))
    return own.where("n > 0").join(named, ["s0", "s1"]).select("doc_id", F.col("n").alias("n_shingles"), "component_id").unionByName(empty)


def keep_one_each(df: DataFrame, key: str = "doc_id", text: str = "text", width: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``df``, with all columns, without those that another row of their component stands for.

    Of a component the row with the smallest id stays (a null id comes last, ties go by a hash of the text); of rows that
    repeat its id and text any one. A row is judged by its own text: of an id with several texts only those go that are
    copies. Rows without words are linked with nothing and stay. An empty table gives no rows.
    """
    keys = [F.col(key).cast("long"), F.col(text)]
    own, sets = _linked_rows(df.select(keys[0].alias("doc_id"), keys[1].alias("text")), width, percent)
    several = own.where("n > 0").groupBy("s0", "s1").agg(F.count(F.lit(1)).alias("rows"), F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row", "mark")).alias("best"))
    several = sets.join(several, ["s0", "s1"])
    best = several.groupBy("x", "y", "linked").agg(F.sum("rows").alias("rows"), F.min("best").alias("best")).where("rows > 1").select("x", "y", "linked", "best.row", "best.mark")
    best = materialize(sets.join(best, ["x", "y", "linked"]).select("s0", "s1", F.col("row").alias("_row"), F.col("mark").alias("_mark")), "jaccard-best")
    judged = own.where("n > 0").select("row", "mark", "s0", "s1").join(best, ["s0", "s1"])
    judged = materialize(judged.select("row", "mark", (F.col("row").eqNullSafe(F.col("_row")) & (F.col("mark") == F.col("_mark"))).alias("stays")), "jaccard-judged")
    gone = materialize(judged.where("not stays").select("row", "mark").distinct(), "jaccard-gone")
    again = materialize(judged.where("stays").groupBy("row", "mark").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("row", "mark"), "jaccard-again")
    # only the rows that go or repeat, and the few like them in the bitmap, are shuffled with their texts
    placed = _by_bitmap(df.select(F.struct(*df.columns).alias("it"), *_row_of(*keys)), gone.unionByName(again))
    clear, rest = placed.where("not near").select("it.*"), placed.where("near").join(gone, ["row", "mark"], "left_anti")
    if not again.limit(1).count():
        return clear.unionByName(rest.select("it.*"))
    once, twice = rest.join(again, ["row", "mark"], "left_anti"), rest.join(again, ["row", "mark"], "left_semi").dropDuplicates(["row", "mark"])
    return clear.unionByName(once.unionByName(twice).select("it.*"))
