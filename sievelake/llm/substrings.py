"""Substring deduplication by Rabin-Karp hashes of every fixed-length word window.

Every window's hash (64 bits and 16 of a second one) goes to one of P hash ranges, in packed form: a task first reduces
its own documents to one holder per hash (the smallest doc_id, and its first position), so a window that every document
holds, or one document holds many times, is sent once per slice of a task. A hash range decides for each holder whether a
smaller document has the window, and sends the positions of those that lose back by document. There a holder's other
positions of the same window follow, windows merge into maximal intervals of words, and the words are removed.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import binary_column, parts_for, rolling, slices, text_size, words_of

BASE, SECOND = 0x9E3779B97F4A7C15, 0xD1342543DE82EF95  # any odd numbers
NO_ID = np.iinfo(np.int64).max
SLICE_BYTES = 4 << 20
RANGE_BYTES = 8 << 20


def _planes(values: np.ndarray) -> bytes:
    """Integers as byte planes, compressed: the high planes of small numbers are zeros."""
    raw = np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8).T).tobytes()
    return pa.compress(raw, codec="zstd", asbytes=True)


def _unplanes(data: bytes, n: int) -> np.ndarray:
    raw = np.frombuffer(pa.decompress(data, n * 8, codec="zstd", asbytes=True), np.uint8).reshape(8, n)
    return np.ascontiguousarray(raw.T).view("<u8").ravel()


def _pack(ids: np.ndarray, positions: np.ndarray, tail: np.ndarray | None = None) -> bytes:
    """Windows sorted by (id, position): ids and positions as differences, then ``tail`` (bytes of each row) as it is."""
    step = np.diff(ids.view(np.uint64), prepend=np.uint64(0))
    pos = positions.astype(np.int64)
    gap = np.where(step == 0, np.diff(pos, prepend=0), pos).astype(np.int64)
    a, b = _planes(step), _planes(gap.view(np.uint64))
    return struct.pack("<III", len(ids), len(a), len(b)) + a + b + (b"" if tail is None else tail.tobytes())


def _unpack(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    n, a, b = struct.unpack_from("<III", data)
    at = 12
    step, gap = _unplanes(data[at : at + a], n), _unplanes(data[at + a : at + a + b], n).view(np.int64)
    ids = np.cumsum(step, dtype=np.uint64).view(np.int64)
    total = np.cumsum(gap)
    heads = np.flatnonzero(step != 0)
    base = np.zeros(n, np.int64)
    if n:
        heads = np.append(0, heads[heads > 0])
        base = np.repeat(total[heads] - gap[heads], np.diff(np.append(heads, n)))
    tail = np.frombuffer(data, np.uint8, offset=at + a + b)
    return ids, total - base, tail.reshape(n, -1) if n else tail.reshape(0, 0)


def _bytes_of(values: np.ndarray, size: int) -> np.ndarray:
    return np.ascontiguousarray(values.astype("<u8")).view(np.uint8).reshape(-1, 8)[:, :size]


def _number(rows: np.ndarray) -> np.ndarray:
    wide = np.zeros((len(rows), 8), np.uint8)
    wide[:, : rows.shape[1]] = rows
    return wide.view("<u8").ravel()


def _by_part(part: np.ndarray, ids: np.ndarray, positions: np.ndarray, tail: np.ndarray | None = None):
    """(part, packed windows) for each part that has any."""
    if not len(part):
        return
    order = np.lexsort((positions, ids, part))
    part, ids, positions = part[order], ids[order], positions[order]
    tail = None if tail is None else tail[order]
    cuts = np.flatnonzero(np.diff(part, prepend=-1))
    for s, e in zip(cuts, np.append(cuts[1:], len(part)), strict=True):
        yield int(part[s]), _pack(ids[s:e], positions[s:e], None if tail is None else tail[s:e])


def _doc_part(ids: np.ndarray, bits: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return ((ids.view(np.uint64) * np.uint64(BASE)) >> np.uint64(64 - bits)).astype(np.int64)


def _losers(hashes: np.ndarray, second: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order by (hash, id); in that order, where each row's group begins, and True where a smaller id has the same hash."""
    order = np.lexsort((ids, second, hashes))
    h, k, d = hashes[order], second[order], ids[order]
    first = np.ones(len(h), bool)
    first[1:] = (h[1:] != h[:-1]) | (k[1:] != k[:-1])
    begin = np.maximum.accumulate(np.where(first, np.arange(len(h)), 0)) if len(h) else np.zeros(0, np.int64)
    return order, begin, d > d[begin]


_SENT = "kind int, part long, data binary"


def _batch(rows: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
    k, p, d = zip(*rows, strict=True) if rows else ((), (), ())
    return pa.RecordBatch.from_arrays([pa.array(k, pa.int32()), pa.array(p, pa.int64()), pa.array(d, pa.binary())], names=["kind", "part", "data"])


def _windows(width: int, bits: int):
    """Map side: kind 0 holds windows by hash range; by document, kind 1 holds windows that lose within the slice, and kind
    3 holds further positions of a holder's window, with the position that is judged."""

    def run(batches):
        for batch in batches:
            texts = binary_column(batch.column("text"))
            every = batch.column("doc_id").cast(pa.int64()).fill_null(NO_ID).to_numpy(zero_copy_only=False)
            for s, e in slices(texts, SLICE_BYTES):
                words, bounds = words_of(texts[s:e])
                hashes, second = rolling(words, width, BASE), rolling(words, width, SECOND) >> np.uint64(48)
                if not len(hashes):
                    continue
                doc = np.repeat(np.arange(e - s), np.diff(bounds))
                whole = doc[: len(hashes)] == doc[width - 1 :]
                position = (np.arange(len(words)) - bounds[:-1][doc])[: len(hashes)][whole]
                ids, hashes, second = every[s:e][doc[: len(hashes)][whole]], hashes[whole], second[whole]
                order, begin, lost = _losers(hashes, second, ids)
                h, k, d, p = hashes[order], second[order], ids[order], position[order]
                first = begin == np.arange(len(h))
                follow = ~first & ~lost
                tail = np.concatenate((_bytes_of(h[first], 7), _bytes_of(k[first], 2)), axis=1)
                rows = [(0, n, x) for n, x in _by_part((h[first] >> np.uint64(64 - bits)).astype(np.int64), d[first], p[first], tail)]
                rows += [(1, n, x) for n, x in _by_part(_doc_part(d[lost], bits), d[lost], p[lost])]
                rows += [(3, n, x) for n, x in _by_part(_doc_part(d[follow], bits), d[follow], p[follow], _bytes_of(p[begin[follow]], 4))]
                yield _batch(rows)

    return run


def _decide(bits: int):
    """One hash range: positions whose window a smaller document has, by document."""

    def run(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, positions, tails = [], [], []
        for batch in batches:
            for kind, part, data in zip(batch.column("kind").to_pylist(), batch.column("part").to_pylist(), batch.column("data").to_pylist(), strict=True):
                if kind:
                    yield _batch([(kind, part, data)])
                    continue
                a, b, c = _unpack(data)
                ids.append(a)
                positions.append(b)
                tails.append(c)
        if ids:
            d, p, tail = np.concatenate(ids), np.concatenate(positions), np.concatenate(tails)
            del ids, positions, tails
            order, _, lost = _losers(_number(tail[:, :7]), _number(tail[:, 7:]), d)
            take = order[lost]
            yield _batch([(1, k, x) for k, x in _by_part(_doc_part(d[take], bits), d[take], p[take])])

    return run


def _send_texts(bits: int):
    """Documents by part, compressed together; a row's place in its part's blob is kept."""

    def run(batches):
        for batch in batches:
            texts, ids = binary_column(batch.column("text")), batch.column("doc_id").cast(pa.int64())
            for s, e in slices(texts, SLICE_BYTES):
                own = ids.slice(s, e - s)
                known = own.fill_null(NO_ID).to_numpy(zero_copy_only=False)
                part = _doc_part(known, bits)
                order = np.argsort(part, kind="stable")
                cuts = np.flatnonzero(np.diff(part[order], prepend=-1))
                rows = []
                for a, b in zip(cuts, np.append(cuts[1:], len(order)), strict=True):
                    some = order[a:b]
                    values = texts.slice(s, e - s).take(pa.array(some)).to_pylist()
                    head = np.array([len(v) for v in values], "<i8").tobytes() + known[some].astype("<i8").tobytes()
                    body = b"".join(values)
                    rows.append((2, int(part[some[0]]), struct.pack("<II", len(values), len(body)) + head + pa.compress(body, codec="zstd", asbytes=True)))
                yield _batch(rows)

    return run


def intervals(positions: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Maximal word intervals [start, end) covered by windows that start at the sorted ``positions``."""
    if not len(positions):
        return positions, positions
    cut = np.flatnonzero(np.diff(positions) > width) + 1
    return positions[np.append(0, cut)], positions[np.append(cut - 1, len(positions) - 1)] + width


_KEPT = "doc_id long, n_words long, n_removed long, kept_sha256 string, removed array<struct<start:long,end:long>>, kept_text string"


def _apply(width: int, with_text: bool):
    """One part: its documents and the window positions to remove from them."""
    removed = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    schema = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_sha256", pa.string()), ("removed", removed), ("kept_text", pa.string())])

    def run(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, positions, texts, more = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [], []
        for batch in batches:
            for kind, data in zip(batch.column("kind").to_pylist(), batch.column("data").to_pylist(), strict=True):
                if kind == 2:
                    texts.append(data)
                elif kind == 3:
                    more.append(_unpack(data))
                else:
                    a, b, _ = _unpack(data)
                    ids.append(a)
                    positions.append(b)
        d, p = np.concatenate(ids), np.concatenate(positions)
        if more:  # positions whose judged position is removed
            fd, fp, judged = (np.concatenate(x) for x in zip(*more, strict=True))
            _, at = np.unique(np.concatenate((d, fd)), return_inverse=True)
            place = lambda n, x: n.astype(np.int64) << 32 | x.astype(np.int64)
            gone = np.isin(place(at[len(d) :], _number(judged)), place(at[: len(d)], p))
            d, p = np.concatenate((d, fd[gone])), np.concatenate((p, fp[gone]))
        order = np.lexsort((p, d))
        d, p = d[order], p[order]
        for data in texts:
            n, size = struct.unpack_from("<II", data)
            lengths = np.frombuffer(data, "<i8", n, 8)
            own = np.frombuffer(data, "<i8", n, 8 + 8 * n)
            body = pa.decompress(data[8 + 16 * n :], size, codec="zstd", asbytes=True)
            ends = np.cumsum(lengths)
            rows = []
            for one, length, end in zip(own.tolist(), lengths.tolist(), ends.tolist(), strict=True):
                words = body[end - length : end].split()
                starts = p[np.searchsorted(d, one, "left") : np.searchsorted(d, one, "right")]
                # a repeated doc_id with another, shorter text can't hold a window beyond its end
                begin, until = intervals(np.unique(starts[starts + width <= len(words)]), width)
                kept, at = [], 0
                for s, e in zip(begin.tolist(), until.tolist(), strict=True):
                    kept += words[at:s]
                    at = e
                kept += words[at:]
                text = b" ".join(kept)
                spans = [{"start": s, "end": e} for s, e in zip(begin.tolist(), until.tolist(), strict=True)]
                rows.append((None if one == NO_ID else one, len(words), len(words) - len(kept), hashlib.sha256(text).hexdigest(), spans, text.decode() if with_text else None))
            yield pa.RecordBatch.from_pylist([dict(zip(schema.names, r, strict=True)) for r in rows], schema=schema)

    return run


def _gap(docs: DataFrame, n: int) -> int | None:
    """A number that is no id, where the largest one is an id; else null. Of 0 to n one at least is none of n ids."""
    if not docs.where(F.col("doc_id") == NO_ID).limit(1).count():
        return None
    return docs.sparkSession.range(n + 1).join(docs.select(F.col("doc_id").alias("id")), "id", "left_anti").agg(F.min("id")).first()[0]


def remove_repeats(df: DataFrame, width: int = 13, key: str = "doc_id", text: str = "text", with_text: bool = True) -> DataFrame:
    """Remove each word covered by a window of ``width`` words that also starts in a document with a smaller id.

    Returns doc_id, n_words, n_removed, kept_sha256 (of the kept words joined by one space), removed (maximal word
    intervals) and kept_text (null unless ``with_text``), one row per input row. The id must be an integer.

    Null text has no words and an empty kept text; a null id counts as larger than any other, 2^63 - 1 too, and is returned as null;
    rows that repeat an id are one document for the comparison, and a position removed from one is removed from the
    others where it exists; documents of fewer words than a window lose nothing; an empty table gives no rows; other
    columns are not read. Windows are equal if 72 bits of their hashes, and those that name their range, are: 74 with 4 ranges, one
    more with each doubling.
    """
    docs = df.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    total, n = text_size(docs, "text")
    gap = _gap(docs, n)
    if gap is not None:  # ids above an unused one move down, so that the largest number is free for null ids
        docs = docs.withColumn("doc_id", F.when(F.col("doc_id") > gap, F.col("doc_id") - 1).otherwise(F.col("doc_id")))
    parts = parts_for(total, RANGE_BYTES)
    bits = max(1, parts.bit_length() - 1)
    sent = docs.mapInArrow(_windows(width, bits), _SENT)
    back = sent.groupBy("part").applyInArrow(_decide(bits), _SENT)
    texts = docs.mapInArrow(_send_texts(bits), _SENT)
    out = back.unionByName(texts).groupBy("part").applyInArrow(_apply(width, with_text), _KEPT)
    if gap is not None:
        out = out.withColumn("doc_id", F.when(F.col("doc_id") >= gap, F.col("doc_id") + 1).otherwise(F.col("doc_id")))
    return out if with_text else out.drop("kept_text")
