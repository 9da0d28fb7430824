"""Benchmark decontamination by pigeonhole edit matching.

A test item may occur in a document with up to k edits, k a fixed share of its length. Cut into k + 1 pieces, at least
one piece of it then occurs unchanged. An automaton finds the pieces of a whole block of items in one pass over a text,
and each hit gives a place where Myers' bit-parallel algorithm computes the smallest edit distance of the item to any
stretch of the text. Items are handled in blocks of bounded size, so the automaton is too.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import ahocorasick
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLOCK_CHARS = 4_000_000
_SPACE = re.compile(r"\s+")


def normal(text: str | None) -> str:
    """Lower case with single spaces."""
    return _SPACE.sub(" ", (text or "").lower()).strip()


def cuts_of(length: int, budget: int) -> list[int]:
    """Bounds of ``budget`` + 1 pieces of about equal length."""
    return [length * i // (budget + 1) for i in range(budget + 2)]


def halves(n: int, i: int) -> list[tuple[int, int]]:
    """The ranges of pieces that hold piece ``i`` when ``n`` pieces are halved again and again, smallest first."""
    low, high, out = 0, n, []
    while high - low > 1:
        out.append((low, high))
        middle = (low + high) // 2
        low, high = (low, middle) if i < middle else (middle, high)
    return out[::-1]


def myers(pattern: str, text: str, most: int) -> tuple[int, int]:
    """Smallest edit distance of ``pattern`` to any substring of ``text``, and the first end at which it is reached.

    One bit of an integer per pattern character; (most + 1, -1) if it exceeds ``most``.
    """
    m = len(pattern)
    masks: dict[str, int] = {}
    for i, c in enumerate(pattern):
        masks[c] = masks.get(c, 0) | 1 << i
    full, top = (1 << m) - 1, 1 << (m - 1)
    plus, minus, score, best, end = full, 0, m, most + 1, -1
    for at, c in enumerate(text):
        eq = masks.get(c, 0)
        down = eq | minus
        diag = (((eq & plus) + plus) ^ plus) | eq
        hp = minus | (~(diag | plus) & full)
        hn = plus & diag
        if hp & top:
            score += 1
        elif hn & top:
            score -= 1
        hp = (hp << 1) & full
        hn = (hn << 1) & full
        plus = hn | (~(down | hp) & full)
        minus = hp & down
        if score < best:
            best, end = score, at + 1
    return best, end


def whole_words(text: str, start: int, stop: int) -> bool:
    """Whether no word is cut at either end of a stretch."""
    return not (start > 0 and text[start - 1].isalnum() and text[start].isalnum()) and not (stop < len(text) and text[stop].isalnum() and text[stop - 1].isalnum())


class Matcher:
    """The pieces of a block of items in one automaton."""

    def __init__(self, items: list[tuple[int, str]], share: float, exact_below: int):
        self.exact_below = exact_below
        self.items = [(i, t, cuts_of(len(t), int(len(t) * share) if len(t) >= exact_below else 0)) for i, t in items]
        self.automaton = ahocorasick.Automaton()
        found: dict[str, list[tuple[int, int]]] = {}
        for number, (_, text, cuts) in enumerate(self.items):
            for i, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
                found.setdefault(text[a:b], []).append((number, i))
        for piece, where in found.items():
            self.automaton.add_word(piece, (len(piece), where))
        self.automaton.make_automaton()

    def _verify(self, text: str, at: int, number: int, i: int) -> tuple[int, int] | None:
        """Distance and end of the item around a hit of piece ``i`` at ``at``.

        A range of s pieces with under s edits has a half for which the same holds, down to a piece without any: so
        the ranges above the hit are tried from the smallest on, and the first that fails ends the trial.
        """
        _, item, cuts = self.items[number]
        got, low = 0, at
        end = cuts[i + 1] - cuts[i]
        for a, b in halves(len(cuts) - 1, i):
            most = b - a - 1
            low = max(0, at - (cuts[i] - cuts[a]) - most)
            got, end = myers(item[cuts[a] : cuts[b]], text[low : at + cuts[b] - cuts[i] + most], most)
            if got > most:
                return None
        return got, low + end

    def match(self, text: str) -> list[tuple[int, int, int]]:
        """(item id, distance, end in the normalised text) of each item that occurs within its budget."""
        best: dict[int, tuple[int, int]] = {}
        for stop, (length, where) in self.automaton.iter(text):
            for number, i in where:
                if len(self.items[number][1]) < self.exact_below and not whole_words(text, stop + 1 - length, stop + 1):
                    continue
                if best.get(number, (1,))[0] and (got := self._verify(text, stop + 1 - length, number, i)):
                    best[number] = min(best.get(number, got), got)
        return [(self.items[number][0], *got) for number, got in best.items()]


def _blocks(items: DataFrame) -> Iterator[list[tuple[int, str]]]:
    """Items in blocks of at most BLOCK_CHARS characters (one item at least), read one after the other."""
    block, size = [], 0
    for row in items.toLocalIterator():
        block.append((row["item_id"], row["text"]))
        size += len(row["text"])
        if size >= BLOCK_CHARS:
            yield block
            block, size = [], 0
    if block:
        yield block


def _items(benchmark: DataFrame, item: str, item_text: str) -> DataFrame:
    plain = F.trim(F.regexp_replace(F.lower(F.col(item_text)), r"(?U)\s+", " "))
    return benchmark.select(F.col(item).cast("long").alias("item_id"), plain.alias("text")).where("text != ''").orderBy("item_id", "text")


def matches(df: DataFrame, benchmark: DataFrame, share: float = 0.1, exact_below: int = 30, key: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text") -> DataFrame:
    """(doc_id, item_id, distance, end_pos) of every item that a document's whole text holds with at most share * length edits.

    Both texts are compared in lower case with single spaces; ``end_pos`` is the end of the first best stretch there.
    Items below ``exact_below`` characters have no budget and must stand between word borders, since a few edits make
    other words of them. Each block of items is one pass over the documents.

    Null and empty texts match nothing, nor do null and empty items, and a null id is kept; of equally good stretches the
    first found counts; an item that is given twice is found under each id;
    repeated documents give repeated rows; without items or documents there are no rows; other columns are not read.
    """
    spark = df.sparkSession
    docs = df.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text")).where("text is not null")
    schema = "doc_id long, item_id long, distance long, end_pos long"
    out = None
    for block in _blocks(_items(benchmark, item, item_text)):
        held = spark.sparkContext.broadcast(block)  # at most BLOCK_CHARS and one item

        def run(batches: Iterator[pd.DataFrame], held=held) -> Iterator[pd.DataFrame]:
            matcher = None
            for batch in batches:
                matcher = matcher or Matcher([(i, normal(t)) for i, t in held.value], share, exact_below)
                rows = [(d, *hit) for d, t in zip(batch["doc_id"], batch["text"], strict=True) for hit in matcher.match(normal(t))]
                yield pd.DataFrame(rows, columns=["doc_id", "item_id", "distance", "end_pos"]).astype({"doc_id": "Int64", "item_id": "Int64"})

        part = docs.mapInPandas(run, schema)
        out = part if out is None else out.unionByName(part)
    return spark.createDataFrame([], schema) if out is None else out


def _leaks(held, share: float, exact_below: int):
    """Whether a text holds an item of the block, as a column function."""

    @F.pandas_udf("boolean")
    def leaks(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        matcher = None
        for batch in batches:
            matcher = matcher or Matcher([(i, normal(t)) for i, t in held.value], share, exact_below)
            yield pd.Series([bool(matcher.match(normal(t))) for t in batch])

    return leaks


def decontaminate(df: DataFrame, benchmark: DataFrame, share: float = 0.1, exact_below: int = 30, text: str = "text", item: str = "item_id", item_text: str = "text") -> DataFrame:
    """The rows of ``df``, with all columns, whose text holds no item; decided row by row, so nothing is shuffled.

    Rows with null or empty text stay.
    """
    for block in _blocks(_items(benchmark, item, item_text)):
        df = df.where(~_leaks(df.sparkSession.sparkContext.broadcast(block), share, exact_below)(F.col(text)))
    return df
