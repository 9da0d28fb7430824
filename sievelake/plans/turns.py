"""Pairs of adjacent turns, which several queries read."""

from __future__ import annotations

from pyspark.sql import functions as F

from .registry import Tables

TURNS_SQL = "turns AS (SELECT u.conv_id, u.turn, u.text AS a, v.text AS b FROM conversations u JOIN conversations v ON v.conv_id = u.conv_id AND v.turn = u.turn + 1)"


def turns(t: Tables):
    """Each turn's text (a) with the next one's (b)."""
    c = t.conversations
    return c.select("conv_id", "turn", F.col("text").alias("a")).join(c.select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("b")), ["conv_id", "turn"])


def quoted(v: list[str]) -> str:
    """Words as a SQL list."""
    return "[" + ", ".join(f"'{w}'" for w in v) + "]"
