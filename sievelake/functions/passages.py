"""Passage helpers that Spark has no built-in function for, as Arrow-batched pandas functions of one row each."""

from __future__ import annotations

import difflib
import re

import numpy as np
import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, LongType

from .text import passage_core

TOKEN = re.compile(r"\d+(?:\.\d+)?|[A-Za-z_][A-Za-z0-9_']*")


def common_length(a: str, b: str) -> int:
    """Length of the longest common substring, spaces aside (one row of lengths at a time)."""
    a, b = "".join((a or "").split()), "".join((b or "").split())
    if a and a in b:
        return len(a)
    if len(a) > len(b):
        a, b = b, a
    points = np.frombuffer(a.encode("utf-32-le", "surrogatepass"), np.uint32)
    best, row = 0, np.zeros(len(points) + 1, np.int32)
    for c in b:  # common suffix lengths of every prefix of a with the prefix of b so far
        new = np.zeros_like(row)
        new[1:] = np.where(points == ord(c), row[:-1] + 1, 0)
        best, row = max(best, int(new.max(initial=0))), new
    return best


@F.pandas_udf(LongType())
def longest_common(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([common_length(x, y) for x, y in zip(a, b, strict=True)], dtype="int64")


@F.pandas_udf(DoubleType())
def sequence_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    """Matching ratio of two texts by character (2 * matched / total)."""
    return pd.Series([difflib.SequenceMatcher(None, x or "", y or "", autojunk=False).ratio() for x, y in zip(a, b, strict=True)])


@F.pandas_udf(DoubleType())
def word_difference(a: pd.Series, b: pd.Series) -> pd.Series:
    """1 - matching ratio of the lower-case token lists; 0 for the same words in the same order."""
    tokens = lambda t: [w.lower() for w in TOKEN.findall(t or "")]
    return pd.Series([1 - difflib.SequenceMatcher(None, tokens(x), tokens(y), autojunk=False).ratio() for x, y in zip(a, b, strict=True)])


def grouped(texts: list[str]) -> list[int]:
    """The group of each passage: the first one with a member that is the same passage, else one of its own."""
    groups: list[list[str]] = []
    out = []
    for text in texts:
        size = len("".join((text or "").split()))
        fits = lambda x: text == x or 2 * common_length(text, x) >= max(1, min(size, len("".join((x or "").split()))))  # noqa: B023, E731
        at = next((i for i, members in enumerate(groups) if any(map(fits, members))), len(groups))
        if at == len(groups):
            groups.append([])
        if text not in groups[at]:
            groups[at].append(text)
        out.append(at)
    return out


@F.pandas_udf(ArrayType(IntegerType()))
def passage_groups(texts: pd.Series) -> pd.Series:
    return texts.map(lambda x: grouped(list(x)))


def same_passage(length, a, b):
    """The longest common substring is at least half of the shorter text (spaces aside)."""
    size = lambda c: F.length(F.regexp_replace(F.coalesce(c, F.lit("")), r"\s+", ""))
    return (F.least(size(a), size(b)) > 0) & (length * 2 >= F.least(size(a), size(b)))


def nearly_equal(length, a, b):
    """Shared over union of the characters is at least 0.9."""
    size = lambda c: F.length(F.regexp_replace(F.coalesce(c, F.lit("")), r"\s+", ""))
    return length >= 0.9 * (size(a) + size(b) - length)


def pieces_in_order(piece_text: str, excerpt: str, most: int = 3, least: int = 15) -> int:
    """How many stretches of the excerpt, one after the other, make up the text (spaces aside); 0 if over ``most`` do.

    Each stretch is as long as it can be; only the last may have fewer than ``least`` characters.
    """
    rest, source = "".join((piece_text or "").split()), "".join((excerpt or "").split())
    for number in range(1, most + 1):
        found = _longest_start(rest, source)
        if not found or (found < least and found < len(rest)):
            return 0
        if found == len(rest):
            return number
        source = source[source.index(rest[:found]) + found :]
        rest = rest[found:]
    return 0


def _longest_start(text: str, source: str) -> int:
    """Length of the longest prefix of ``text`` that occurs in ``source``: each place where a longer one begins is grown."""
    if text in source:
        return len(text)
    size = 0
    at = source.find(text[:1])
    while at >= 0:
        step = 1
        while step:
            if size + step <= len(text) and source.startswith(text[size : size + step], at + size):
                size, step = size + step, 2 * step
            else:
                step //= 2
        if size == len(text):
            break
        at = source.find(text[: size + 1], at + 1)
    return size


@F.pandas_udf(LongType())
def _pieces(core: pd.Series, excerpt: pd.Series) -> pd.Series:
    return pd.Series([pieces_in_order(x, y) if x else 1 for x, y in zip(core, excerpt, strict=True)], dtype="int64")


def ordered_pieces(text, excerpt):
    """As ``pieces_in_order``, for passages as they are compared; punctuation and brackets at the ends are no part of one."""
    core = lambda c: passage_core(F.coalesce(c, F.lit("")))
    return _pieces(F.trim(core(text), F.lit(".,;:()[]{}")), core(excerpt))


def check_passage(pieces):
    """copy, joined or not a copy."""
    return F.when(pieces == 1, "copy").when(pieces > 1, "joined").otherwise("not a copy")
