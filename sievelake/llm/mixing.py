"""Mixing sources to target weights by Pfair scheduling.

Each source is a periodic task whose rate is its target weight: its block number b (from 0) may not be scheduled before
floor(b / w) and must be scheduled before ceil((b + 1) / w). With one block per slot and weights that sum to one,
earliest deadline first meets every window, so at any slot each source is less than one block away from its share.

Weights are shares of a frame of M slots, so the schedule repeats every M slots: EDF runs over one frame only, and the
slot of any block follows from its number. Numbering the blocks is a distributed prefix sum.
"""

from __future__ import annotations

import heapq
import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import materialize

POOL = "<small sources>"


def shares(weights: dict[str, float], frame: int) -> dict[str, int]:
    """Whole slots per frame in proportion to the weights: largest remainders, at least one each."""
    total = sum(weights.values())
    exact = {k: w / total * frame for k, w in weights.items()}
    out = {k: max(1, math.floor(x)) for k, x in exact.items()}
    by_rest = sorted(exact, key=lambda k: (math.floor(exact[k]) - exact[k], k))
    for k in by_rest * 2:
        if sum(out.values()) >= frame:
            break
        out[k] += 1
    while sum(out.values()) > frame:
        out[max(out, key=lambda k: (out[k] - exact[k] if out[k] > 1 else -1, k))] -= 1
    return out


def edf_frame(share: dict[str, int], frame: int) -> dict[str, list[int]]:
    """Slots of each source's blocks in one frame, earliest deadline first among the released blocks."""
    slots: dict[str, list[int]] = {k: [] for k in share}
    waiting = [(0, k) for k in share]  # (release, source)
    heapq.heapify(waiting)
    ready: list[tuple[int, str]] = []
    for slot in range(frame):
        while waiting and waiting[0][0] <= slot:
            _, k = heapq.heappop(waiting)
            heapq.heappush(ready, (-(-(len(slots[k]) + 1) * frame // share[k]), k))
        if ready:
            _, k = heapq.heappop(ready)
            slots[k].append(slot)
            if len(slots[k]) < share[k]:
                heapq.heappush(waiting, (len(slots[k]) * frame // share[k], k))
    return slots


def mix_sources(
    df: DataFrame, weights: dict[str, float] | None = None, alpha: float = 0.8, block_chars: int = 65536, frame: int = 10000,
    exhausted: str = "repeat", source: str = "source", key: str = "doc_id", text: str = "text", length: str | None = None, seed: int = 0,
) -> DataFrame:
    """The documents of ``df`` in a schedule that holds the target weights, one row per scheduled document.

    Adds class, epoch, block, release, deadline and slot; ordering by (slot, rank) gives the mixture. ``weights`` maps
    sources to target shares of text; without it they are (characters of the source)^alpha. A source whose share is
    below one slot of ``frame`` shares one class with the others like it. Blocks hold ``block_chars`` characters of a
    source (``length`` names a column that has their number) in a seeded order. ``exhausted``: "repeat" goes on until
    every source is used up once, and starts used up sources anew (epoch 1, 2, ...), so that no document is lost; "stop"
    ends before the first source runs out. Of equal deadlines the first class by name is served first; documents of
    equal place in the seeded order go by id, a null id first, then by length.

    A null source is a class of its own (named as empty text); null and empty texts count one character, so they keep
    a place; sources missing in ``weights`` are not scheduled; repeated rows are scheduled as rows of their own; an
    empty table gives no rows; input columns with the names of the added ones are replaced.
    """
    spark = df.sparkSession
    made = ["class", "epoch", "block", "release", "deadline", "slot", "rank"]
    size = F.col(length) if length else F.char_length(text)
    rows = df.drop(*made).withColumns({
        "_src": F.coalesce(F.col(source).cast("string"), F.lit("")), "_len": F.greatest(F.coalesce(size, F.lit(1)), F.lit(1)).cast("long"),
        "_ord": F.xxhash64(F.lit(seed), F.coalesce(F.col(key).cast("string"), F.lit(""))),
    })
    totals = materialize(rows.groupBy("_src").agg(F.sum("_len").alias("chars"), F.count(F.lit(1)).alias("n")), "mix-totals")
    if weights is None:
        totals = totals.withColumn("w", F.pow(F.col("chars").cast("double"), F.lit(float(alpha))))
    else:
        given = spark.createDataFrame([(str(k), float(w)) for k, w in weights.items() if w > 0], "_src string, w double")
        totals = totals.join(F.broadcast(given), "_src")
    whole = totals.agg(F.sum("w"), F.sum("n")).first()
    schema = T.StructType([*df.drop(*made).schema.fields, *(T.StructField(c, T.StringType() if c == "class" else T.LongType()) for c in made)])
    if not whole[0]:
        return spark.createDataFrame([], schema)
    totals = totals.withColumn("class", F.when(F.col("w") / F.lit(whole[0]) < 1 / frame, F.lit(POOL)).otherwise(F.col("_src")))
    groups = totals.groupBy("class").agg(F.sum("w").alias("w"), F.sum("chars").alias("chars")).collect()  # at most frame + 1 rows
    share = shares({r["class"]: r["w"] for r in groups}, frame)
    own = [(r["class"],) for r in groups if r["class"] != POOL]
    mapped = spark.createDataFrame(own, "_src string").withColumn("class", F.col("_src"))
    rows = rows.join(F.broadcast(mapped), "_src", "left")
    if weights is None:
        rows = rows.withColumn("class", F.coalesce("class", F.lit(POOL)))
    else:
        rows = rows.join(totals.select("_src"), "_src", "left_semi").withColumn("class", F.coalesce("class", F.lit(POOL)))

    # running sum of characters by class: by cells of the hash order, then within a cell
    bits = max(0, (int(whole[1]) // 512)).bit_length()
    rows = rows.withColumn("_cell", F.shiftrightunsigned(F.col("_ord"), 64 - bits) if bits else F.lit(0).cast("long"))
    cells = rows.groupBy("class", "_cell").agg(F.sum("_len").alias("_sum"), F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("class").orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    cells = cells.select("class", "_cell", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_from"), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_rank0"))
    within = Window.partitionBy("class", "_cell").orderBy(F.col("_ord"), F.col(key).asc_nulls_first(), F.col("_len")).rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumns({"_run": F.coalesce(F.sum("_len").over(within), F.lit(0)), "_row": F.coalesce(F.count(F.lit(1)).over(within), F.lit(0))})
    rows = rows.join(cells, ["class", "_cell"]).withColumn("_block", F.expr(f"(_from + _run) div {block_chars}"))

    # one frame of EDF, and how far each class goes
    slots = edf_frame(share, frame)
    blocks = {r["class"]: -(-r["chars"] // block_chars) for r in groups}

    def slot_of(k: str, b: int) -> int:
        return b // share[k] * frame + slots[k][b % share[k]]

    end = max(slot_of(k, b - 1) + 1 for k, b in blocks.items()) if exhausted == "repeat" else min(slot_of(k, b) for k, b in blocks.items())
    until = {k: end // frame * share[k] + sum(s < end % frame for s in slots[k]) for k in share}
    table = spark.createDataFrame([(k, share[k], blocks[k], until[k], slots[k]) for k in share], "class string, _a long, _blocks long, _until long, _slots array<int>")
    rows = rows.join(F.broadcast(table), "class").where(F.col("_block") < F.col("_until"))
    times = F.sequence(F.lit(0), F.expr("(_until - 1 - _block) div _blocks"))
    rows = rows.withColumn("epoch", F.explode(times) if exhausted == "repeat" else F.lit(0).cast("long"))
    rows = rows.withColumn("block", F.col("_block") + F.col("epoch") * F.col("_blocks"))
    rows = rows.withColumns({
        "release": F.expr(f"block * {frame} div _a"), "deadline": F.expr(f"-(-(block + 1) * {frame} div _a)") + F.expr(f"int((block + 1) * {frame} % _a > 0)"),
        "slot": F.expr(f"block div _a * {frame} + get(_slots, int(block % _a))"), "rank": F.col("_rank0") + F.col("_row"),
    })
    return rows.select(*(F.col(f"`{c}`") for c in schema.names))
