"""Shared pieces of the training-data operators: sizes and the tokeniser."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..scratch import materialize  # noqa: F401

WORD_BYTES = 2 << 20


def text_size(df: DataFrame, text: str = "text") -> tuple[int, int]:
    """Bytes of text and number of rows, from one aggregation."""
    row = df.agg(F.coalesce(F.sum(F.octet_length(text)), F.lit(0)).alias("b"), F.count(F.lit(1)).alias("n")).first()
    return int(row["b"]), int(row["n"])


def parts_for(total: int, each: int, least: int = 4) -> int:
    """Power of two of pieces of about ``each`` bytes; it grows with the data."""
    return 1 << max(least.bit_length() - 1, (max(total, 1) // each).bit_length())


def binary_column(column: pa.ChunkedArray | pa.Array) -> pa.Array:
    """A text column as one large_binary array; null becomes empty."""
    one = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    if isinstance(one, pa.ChunkedArray):
        one = pa.concat_arrays(one.chunks) if one.num_chunks else pa.array([], one.type)
    return pc.fill_null(one.cast(pa.large_string()), "").cast(pa.large_binary())


def slices(texts: pa.Array, most: int = WORD_BYTES):
    """Consecutive row ranges of at most ``most`` bytes of text (one row at least)."""
    ends = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    at = 0
    while at < len(texts):
        stop = max(at + 1, int(np.searchsorted(ends, ends[at] + most, "right")) - 1)
        yield at, min(stop, len(texts))
        at = stop


def words_of(texts: pa.Array, lower: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Words ``[^\\x20\\x09-\\x0D]+`` of every text: a 64-bit hash per word, and the first word's index per text.

    White space is ASCII, so the UTF-8 bytes can be cut without decoding. ``lower`` folds A-Z only.
    """
    ends = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    size = int(ends[-1] - ends[0])
    if not size:
        return np.zeros(0, np.uint64), np.zeros(len(texts) + 1, np.int64)
    buf = np.frombuffer(texts.buffers()[2], np.uint8)[ends[0] : ends[-1]]
    solid = (buf != 32) & ((buf < 9) | (buf > 13))
    first = np.ones(size, bool)
    first[1:] = ~solid[:-1]
    cuts = ends[:-1] - ends[0]
    first[cuts[cuts < size]] = True
    starts = np.flatnonzero(first & solid)
    bounds = np.searchsorted(starts, ends - ends[0]).astype(np.int64)
    if not len(starts):
        return np.zeros(0, np.uint64), bounds
    packed = buf[solid]
    if lower:
        packed = np.where((packed >= 65) & (packed <= 90), packed + 32, packed).astype(np.uint8)
    before = np.cumsum(solid, dtype=np.int64)
    offsets = np.append(before[starts] - 1, len(packed)).astype(np.int64)
    array = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(packed)])
    coded = array.dictionary_encode()
    hashes = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in coded.dictionary.to_pylist()), np.uint64, len(coded.dictionary))
    return hashes[coded.indices.to_numpy(zero_copy_only=False)], bounds


def rolling(words: np.ndarray, width: int, base: int) -> np.ndarray:
    """Rabin-Karp hash (mod 2^64) of every ``width`` consecutive words."""
    n = len(words) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out, base64 = words[:n].copy(), np.uint64(base)
    with np.errstate(over="ignore"):
        for k in range(1, width):
            out = out * base64 + words[k : k + n]
    return out
