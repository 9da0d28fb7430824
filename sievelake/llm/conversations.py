"""Conversation structure repair: the cheapest edits that make roles alternate, by min-plus matrices over a Re-Pair grammar.

A row of a conversation is one symbol: the initial of its role and its first fault. Keep, Rerole, Delete and Insert move a
four-state automaton (nothing yet; a system row; a user row last; an assistant row last), so a row is a 4 x 4 matrix over
(cost, audit), where sums add costs and join audits, and minima take the least cost, then the ASCII-least audit. Sequences of symbols
repeat across conversations: Re-Pair replaces their most frequent pairs by rules, a rule's matrix is made once from those
of its two sides, and a conversation multiplies the few matrices that are left.

Rows are dealt by range of (conversation, turn), so no conversation is gathered anywhere: it is a row of chunks. One that
lies in one chunk is repaired where it is. The chunks of the others pass their matrices through the conversation in order;
the carried state has a fixed size, since of two audits with equal rows only one can start the other, by trailing inserts.
"""

from __future__ import annotations

import functools
import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import materialize

SPACE = " \t\n\u000b\f\r"
#: Symbols: the initial's class (s, u, a, none, other), 5 more where the text is truncated, and the two that must go.
BLANK, DUPLICATE, SYMBOLS = 10, 11, 12
STATES, OPEN, INSERT = 4, (0, 3), {0: 2, 1: 2, 2: 3, 3: 2}
KEEP = {0: {0: 1}, 1: {0: 2, 1: 2, 3: 2}, 2: {2: 3}, 3: {0: 0, 1: 1, 2: 2, 3: 3}, 4: {}}
REROLE = {0: 2, 1: 2, 2: 3, 3: 2}
LEGAL = {"su", "ua", "au"}
EMPTY = hashlib.sha256(b"").hexdigest()

# An audit is a rope: a string, or (length, left, right). A matrix is a list of 16 None or (cost, rope).


def flat(rope) -> str:
    """The rope's characters."""
    out, stack = [], [rope]
    while stack:
        one = stack.pop()
        if isinstance(one, str):
            out.append(one)
        else:
            stack += (one[2], one[1])
    return "".join(out)


def _joined(a, b):
    if isinstance(a, str) and isinstance(b, str) and len(a) + len(b) <= 16:
        return a + b
    if not len(a) or not len(b):
        return a if len(a) else b
    return ((len(a) if isinstance(a, str) else a[0]) + (len(b) if isinstance(b, str) else b[0]), a, b)


def _less(a, b) -> bool:
    """Whether rope ``a`` sorts before ``b``; parts that both share at one place are passed over."""
    if a is b:
        return False
    left, right = [a], [b]
    while left and right:
        x, y = left.pop(), right.pop()
        if x is y:
            continue
        if not isinstance(x, str) and (isinstance(y, str) or x[0] >= y[0]):
            left += (x[2], x[1])
            right.append(y)
        elif not isinstance(y, str):
            right += (y[2], y[1])
            left.append(x)
        else:
            n = min(len(x), len(y))
            if x[:n] != y[:n]:
                return x[:n] < y[:n]
            if len(x) > n:
                left.append(x[n:])
            if len(y) > n:
                right.append(y[n:])
    return any(len(y) for y in right) and not any(len(x) for x in left)


def _better(found, cost, rope) -> bool:
    return found is None or cost < found[0] or (cost == found[0] and _less(rope, found[1]))


def times(a: list, b: list) -> list:
    """Min-plus product of two matrices."""
    out = [None] * 16
    for i in range(0, 16, 4):
        for k in range(4):
            if (left := a[i + k]) is None:
                continue
            for j in range(4):
                if (right := b[4 * k + j]) is None:
                    continue
                cost, at = left[0] + right[0], i + j
                if (found := out[at]) is None or cost < found[0]:
                    out[at] = (cost, _joined(left[1], right[1]))
                elif cost == found[0] and _less(rope := _joined(left[1], right[1]), found[1]):
                    out[at] = (cost, rope)
    return out


def _inserts() -> list:
    """Any inserts: none, one or two (three come back to a state that one reaches)."""
    out = [None] * 16
    for i in range(STATES):
        state, n = i, 0
        while out[4 * i + state] is None:
            out[4 * i + state] = (5 * n, "I" * n)
            state, n = INSERT[state], n + 1
    return out


@functools.cache
def symbols() -> tuple:
    """The matrix of each symbol: inserts, then the row's own edit. The last one is of inserts alone."""
    out = []
    for s in range(SYMBOLS):
        own = [None] * 16
        for i in range(STATES):
            own[5 * i] = (2, "D")
            if s < BLANK:
                extra = 5 * (s >= 5)
                for j, cost, name in [*((j, 0, "K") for j in [KEEP[s % 5].get(i)] if j is not None), (REROLE[i], 1, "R")]:
                    if _better(own[4 * i + j], cost + extra, name):
                        own[4 * i + j] = (cost + extra, name)
        out.append(times(_inserts(), own))
    return (*out, _inserts())


def _replaced(line: np.ndarray, x: int, y: int, new: int) -> np.ndarray:
    """``new`` for x y, from the left; in a run of one symbol every second pair counts."""
    at = np.flatnonzero((line[:-1] == x) & (line[1:] == y))
    if x == y and len(at):
        first = np.append(True, np.diff(at) > 1)
        at = at[(at - at[first][np.cumsum(first) - 1]) % 2 == 0]
    if not len(at):
        return line
    line = line.copy()
    line[at] = new
    return np.delete(line, at + 1)


def _line(texts: pa.Array) -> np.ndarray:
    """The symbols of all sequences, each followed by -1."""
    sizes = pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64)
    ends = np.cumsum(sizes + 1)
    line = np.full(int(ends[-1]) if len(ends) else 0, -1, np.int32)
    inside = np.ones(len(line), bool)
    inside[ends - 1] = False
    line[inside] = np.frombuffer(b"".join(texts.to_pylist()), np.uint8)
    return line


def grammar(sequences: DataFrame, rules: int = 256, rounds: int = 8) -> list[tuple[int, int]]:
    """Re-Pair rules over all distinct sequences (column ``symbols``): rule k makes symbol 12 + k of two older ones.

    Each round counts the pairs of all sequences and takes, by falling count, those whose sides don't meet those of another
    one taken. ``rules`` and ``rounds`` bound the grammar; how much it compresses changes no result.
    """
    found: list[tuple[int, int]] = []
    for _ in range(rounds):
        known = list(found)

        def pairs(batches, known=known):
            for batch in batches:
                line = _line(batch.column(0))
                for k, (x, y) in enumerate(known):
                    line = _replaced(line, x, y, SYMBOLS + k)
                both = (line[:-1] >= 0) & (line[1:] >= 0)
                keys, counts = np.unique(line[:-1][both].astype(np.int64) << 32 | line[1:][both], return_counts=True)
                yield pa.record_batch({"pair": keys, "n": counts.astype(np.int64)})

        counted = sequences.select("symbols").mapInArrow(pairs, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))
        best = counted.where("n >= 2").orderBy(F.desc("n"), "pair").limit(max(rules - len(known), 1)).collect()
        lefts, rights, new = set(), set(), []
        for row in best:
            x, y = row["pair"] >> 32, row["pair"] & 0xFFFFFFFF
            if x in rights or y in lefts or (x == y and (x in lefts or y in rights)):
                continue
            lefts.add(x)
            rights.add(y)
            new.append((x, y))
        found += new
        if not new or len(found) >= rules:
            break
    return found[:rules]


class Repairer:
    """Matrices of sequences under a grammar, each distinct sequence worked out once."""

    def __init__(self, rules: list[tuple[int, int]], keep: int = 50_000):
        self.rules, self.keep, self.known = rules, keep, {}
        self.matrices = list(symbols()[:SYMBOLS])
        for x, y in rules:
            self.matrices.append(times(self.matrices[x], self.matrices[y]))

    def matrix(self, sequence: bytes) -> list:
        found = self.known.get(sequence)
        if found is None:
            line = np.append(np.frombuffer(sequence, np.uint8).astype(np.int32), -1)
            for k, (x, y) in enumerate(self.rules):
                if len(line) < 3:
                    break
                line = _replaced(line, x, y, SYMBOLS + k)
            found = functools.reduce(times, (self.matrices[s] for s in line[:-1]))
            if len(self.known) >= self.keep:
                self.known.clear()
            self.known[sequence] = found
        return found

    def whole(self, sequence: bytes) -> tuple[int, str]:
        """Cost and audit of a sequence that is a whole conversation."""
        found, last = self.known.get((sequence,)), None
        if found is None:
            closed = times(self.matrix(sequence), symbols()[SYMBOLS])
            for state in OPEN:
                if closed[state] is not None and _better(last, *closed[state]):
                    last = closed[state]
            found = self.known[(sequence,)] = (last[0], flat(last[1]))
        return found


def _repaired(audit: str, roles: list, texts: list, state: int = 0):
    """The lines that the edits of ``audit`` leave, from a state on."""
    rows = zip(roles, texts)
    for edit in audit:
        if edit == "I":
            state = INSERT[state]
            yield ("user:", "assistant:")[state - 2]
            continue
        role, text = next(rows)
        if edit == "K":
            state = KEEP["sua".find(role[:1]) if role[:1] in ("s", "u", "a") else 3 if not role else 4][state]
            yield f"{role}:{text}"
        elif edit == "R":
            state = REROLE[state]
            yield f"{('user', 'assistant')[state - 2]}:{text}"


def damage(rows: DataFrame) -> DataFrame:
    """Rows of conversations with planted faults, by crc32 of ``conv_id:turn``; nulls count as one space.

    Of remainders by 20, 0 drops the row, 1 empties its text, 2 takes its full stops, 3 repeats it, 4 makes its role user.
    """
    word = lambda name: F.coalesce(F.col(name).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(word("conv_id"), F.lit(":"), word("turn")).cast("binary")) % 20
    found = rows.select("conv_id", "turn", word("role").alias("role"), word("text").alias("text"), kind.alias("_kind")).where("_kind != 0")
    text = F.when(F.col("_kind") == 1, "").when(F.col("_kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(F.col("_kind") == 4, "user").otherwise(F.col("role"))
    copies = F.explode(F.when(F.col("_kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    return found.select("conv_id", "turn", role.alias("role"), text.alias("text"), copies.alias("_copy")).drop("_copy")


def _coded(rows: DataFrame) -> DataFrame:
    """Rows with their symbol (as if no row was a repetition) and a key of role and text."""
    word = lambda name: F.coalesce(F.col(name).cast("string"), F.lit(" "))
    rows = rows.select("conv_id", F.col("turn").cast("long").alias("turn"), word("role").alias("role"), word("text").alias("text"))
    solid = F.rtrim("text", F.lit(SPACE))
    first = F.substring("role", 1, 1)
    kind = F.when(first == "s", 0).when(first == "u", 1).when(first == "a", 2).when(first == "", 3).otherwise(4)
    code = F.when(solid == "", BLANK).when(F.right(solid, F.lit(1)).isin(".", "!", "?"), kind).otherwise(kind + 5)
    key = F.substring(F.unhex(F.sha2(F.concat(F.char_length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")), 256)), 1, 16)
    return rows.select("*", code.cast("byte").alias("code"), key.alias("key"))


def _chunk_schema(conv: T.DataType) -> T.StructType:
    text = T.ArrayType(T.StringType())
    return T.StructType([T.StructField("conv_id", conv), *(T.StructField(n, t) for n, t in {
        "at": T.LongType(), "whole": T.BooleanType(), "symbols": T.BinaryType(), "roles": text, "texts": text, "keys": T.ArrayType(T.BinaryType()), "first_turn": T.LongType(), "last_turn": T.LongType(), "least_turn": T.LongType(), "n_turns": T.LongType(),
    }.items())])


def chunks(rows: DataFrame, chunk_rows: int = 1024) -> DataFrame:
    """Conversations cut into consecutive chunks; ``at`` orders the chunks of one, ``whole`` marks the only chunk of one.

    Rows are ordered by turn (nulls first), then role, then the SHA-256 of role and text; equal rows may change places.
    """
    coded = _coded(rows)
    order = [F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), F.col("role"), F.col("key")]
    # equal rows, however many, are spread by their place in the input
    dealt = coded.withColumn("_place", F.monotonically_increasing_id()).repartitionByRange(*order, "_place").sortWithinPartitions(*order)

    def cut(batches):
        base = TaskContext.get().partitionId() << 40
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            conv, key = batch.column("conv_id"), batch.column("key")
            turns, none = batch.column("turn").fill_null(0).to_numpy(zero_copy_only=False), batch.column("turn").is_null().to_numpy(zero_copy_only=False)
            code = batch.column("code").to_numpy(zero_copy_only=False).astype(np.uint8)
            ids = conv.dictionary_encode().indices.fill_null(-1).to_numpy(zero_copy_only=False)
            fresh = np.append(True, ids[1:] != ids[:-1])
            opens = np.flatnonzero(fresh)
            group = np.cumsum(fresh) - 1
            place = np.arange(n) - opens[group]
            starts = np.flatnonzero(place % chunk_rows == 0)
            ends = np.append(starts[1:], n)
            chunk = np.cumsum(place % chunk_rows == 0) - 1
            whole = fresh[starts] & np.append(fresh, True)[ends] & (starts > 0) & (ends < n)
            # rows whose role and text stand earlier in the chunk
            same = key.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)
            _, kept = np.unique(chunk.astype(np.int64) * (n + 1) + same, return_index=True)
            again = np.ones(n, bool)
            again[kept] = False
            code = np.where(again & (code != BLANK), DUPLICATE, code).astype(np.uint8)
            new_turn = ~none & (np.append(True, (turns[1:] != turns[:-1]) | none[:-1]) | (place % chunk_rows == 0))
            known = np.add.reduceat((~none).astype(np.int64), starts)
            least = turns[np.minimum(ends - known, n - 1)]  # nulls come first
            offsets = pa.array(np.append(starts, n).astype(np.int32))
            lists = lambda name: pa.ListArray.from_arrays(offsets, batch.column(name))
            yield pa.RecordBatch.from_arrays([
                conv.take(pa.array(starts)), pa.array(base + starts), pa.array(whole),
                pa.Array.from_buffers(pa.binary(), len(starts), [None, offsets.buffers()[1], pa.py_buffer(code)]),
                lists("role"), lists("text"), pc.if_else(pa.array(whole), pa.scalar(None, pa.list_(key.type)), lists("key")),
                pa.array(turns[starts], mask=none[starts]), pa.array(turns[ends - 1], mask=none[ends - 1]), pa.array(least, mask=known == 0),
                pa.array(np.add.reduceat(new_turn.astype(np.int64), starts)),
            ], names=[f.name for f in schema.fields])
            base += n

    schema = _chunk_schema(coded.schema["conv_id"].dataType)
    return dealt.drop("_place").mapInArrow(cut, schema)


FOUND = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"


def _figures(sequence: bytes, roles: list) -> tuple[int, int, int, int]:
    """Rows that are blank, repeated and truncated, and adjacent initials that may not be."""
    initials = [r[:1] for r in roles]
    illegal = sum(a + b not in LEGAL for a, b in zip(initials, initials[1:]))
    return sequence.count(BLANK), sequence.count(DUPLICATE), sum(5 <= s < BLANK for s in sequence), illegal


def _whole(cut: DataFrame, rules: list, with_lines: bool) -> DataFrame:
    """Repair the conversations that lie in one chunk."""

    def repair(batches):
        repairer = Repairer(rules)
        for batch in batches:
            out: dict[str, list] = {n: [] for n in names}
            columns = (batch.column(n).to_pylist() for n in ("symbols", "roles", "texts", "least_turn", "last_turn", "n_turns"))
            for sequence, roles, texts, least, last, turns in zip(*columns):
                cost, audit = repairer.whole(sequence)
                lines = list(_repaired(audit, roles, texts))
                figures = _figures(sequence, roles)
                gaps = 0 if least is None else last - least + 1 - turns
                for name, value in zip(names, (gaps, *figures, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest(), lines)):
                    out[name].append(value)
            yield pa.RecordBatch.from_arrays([batch.column("conv_id"), *(pa.array(out[n], t) for n, t in zip(names, kinds))], names=["conv_id", *names])

    conv = cut.schema["conv_id"].dataType.simpleString()
    kinds = [*[pa.int64()] * 6, pa.string(), pa.string(), *([pa.list_(pa.string())] if with_lines else [])]
    found = FOUND + (", lines array<string>" if with_lines else "")
    names = [c.split()[0] for c in found.split(", ")]
    return cut.select("conv_id", "symbols", "roles", "texts", "least_turn", "last_turn", "n_turns").mapInArrow(repair, f"conv_id {conv}, {found}")


def _relation(a: str, b: str):
    """-1 or 1 where the strings differ at a place; otherwise the longer one and what it has more."""
    if b.startswith(a):
        return (1, b[len(a) :])
    if a.startswith(b):
        return (0, a[len(b) :])
    return -1 if a < b else 1


class Walk:
    """The cheapest way through a conversation whose chunks come one after the other.

    For each state: the cost of reaching it; for each pair of states: which audit is less, or by which inserts one is longer.
    """

    def __init__(self):
        self.costs, self.order, self.back = [0, None, None, None], {}, []

    def _compared(self, k: int, x: str, m: int, y: str):
        """How audit k followed by x compares with audit m followed by y."""
        if k == m:
            return _relation(x, y)
        known = self.order[k, m]
        if not isinstance(known, tuple):
            return known
        return _relation(x, known[1] + y) if known[0] else _relation(known[1] + x, y)

    def step(self, costs: list, audits: list) -> None:
        """One more chunk, by its matrix."""
        best: list = [None] * 4
        for j in range(4):
            for k in range(4):
                if self.costs[k] is None or costs[4 * k + j] is None:
                    continue
                cost = self.costs[k] + costs[4 * k + j]
                if best[j] is None or cost < best[j][0] or (cost == best[j][0] and self._before(k, audits[4 * k + j], best[j][1], audits[4 * best[j][1] + j])):
                    best[j] = (cost, k)
        reached = [j for j in range(4) if best[j]]
        self.order = {(i, j): self._compared(best[i][1], audits[4 * best[i][1] + i], best[j][1], audits[4 * best[j][1] + j]) for i in reached for j in reached if i != j}
        self.costs = [b and b[0] for b in best]
        self.back.append(sum((b[1] if b else 0) << 2 * j for j, b in enumerate(best)))

    def _before(self, k, x, m, y) -> bool:
        found = self._compared(k, x, m, y)
        return found == -1 or (isinstance(found, tuple) and found[0] == 1 and bool(found[1]))

    def end(self) -> tuple[int, list[int]]:
        """The least cost, and the state after each chunk, the last one after trailing inserts."""
        close = symbols()[SYMBOLS]
        self.step([c and c[0] for c in close], [c and c[1] for c in close])
        state = min((j for j in OPEN if self.costs[j] is not None), key=lambda j: self.costs[j])
        if self.costs[0] is not None and self.costs[0] == self.costs[3] and not self._first_is_less():
            state = 3
        cost, states = self.costs[state], [state]
        for back in reversed(self.back):
            states.append(back >> 2 * states[-1] & 3)
        return cost, states[::-1]

    def _first_is_less(self) -> bool:
        known = self.order[0, 3]
        return known == -1 or (isinstance(known, tuple) and known[0] == 1)


def _cut_ones(cut: DataFrame, rules: list, with_lines: bool) -> DataFrame:
    """Repair the conversations of several chunks."""
    conv = cut.schema["conv_id"].dataType.simpleString()
    # repetitions across chunks: the first place of each role and text that stands in several chunks
    each = cut.select("conv_id", "at", "symbols", F.posexplode("keys").alias("i", "key"))
    each = each.where(~F.ascii(F.substring("symbols", F.col("i") + 1, 1).cast("string")).isin(BLANK, DUPLICATE)).drop("symbols")
    firsts = materialize(each.groupBy("conv_id", "key").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").select(F.col("conv_id").alias("_conv"), F.col("key").alias("_key"), "first"), "repeated")
    again = each.join(firsts, F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("key") == F.col("_key"))).where(F.col("at") > F.col("first"))
    again = again.groupBy(F.col("at").alias("_at")).agg(F.collect_list("i").alias("again"))
    narrow = cut.select("conv_id", "at", "symbols", "roles", "first_turn", "last_turn", "least_turn", "n_turns")

    def weigh(batches):
        repairer = Repairer(rules)
        for batch in batches:
            out: dict[str, list] = {n: [] for n in ("symbols", "blank", "duplicate", "truncated", "illegal", "first_role", "last_role", "costs", "audits")}
            for sequence, roles, more in zip(*(batch.column(n).to_pylist() for n in ("symbols", "roles", "again"))):
                sequence = bytearray(sequence)
                for i in more or ():
                    sequence[i] = DUPLICATE
                sequence = bytes(sequence)
                matrix = repairer.matrix(sequence)
                for name, value in zip(out, (sequence, *_figures(sequence, roles), roles[0][:1], roles[-1][:1], [m and m[0] for m in matrix], [m and flat(m[1]) for m in matrix])):
                    out[name].append(value)
            kinds = [pa.binary(), *[pa.int64()] * 4, pa.string(), pa.string(), pa.list_(pa.int64()), pa.list_(pa.string())]
            keep = ["conv_id", "at", "first_turn", "last_turn", "least_turn", "n_turns"]
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in keep), *(pa.array(out[n], k) for n, k in zip(out, kinds))], names=[*keep, *out])

    weighed = narrow.join(again, narrow["at"] == again["_at"], "left").drop("_at").mapInArrow(
        weigh, f"conv_id {conv}, at long, first_turn long, last_turn long, least_turn long, n_turns long, symbols binary, blank long, duplicate long, truncated long, illegal long, first_role string, last_role string, costs array<long>, audits array<string>"
    )
    weighed = materialize(weighed, "chunk-matrices")

    def walk(batches):
        for rows in _conversations(batches):
            conv_id, walker, places, figures, turns, least, before = None, Walk(), [], [0] * 4, 0, None, None
            for r in rows:
                conv_id = r["conv_id"]
                walker.step(r["costs"], r["audits"])
                places.append(r["at"])
                for i, name in enumerate(("blank", "duplicate", "truncated", "illegal")):
                    figures[i] += r[name]
                turns += r["n_turns"]
                least = r["least_turn"] if least is None else least
                if before:
                    figures[3] += before["last_role"] + r["first_role"] not in LEGAL
                    turns -= before["last_turn"] is not None and before["last_turn"] == r["first_turn"]
                before = {"last_role": r["last_role"], "last_turn": r["last_turn"]}
            cost, states = walker.end()
            gaps = 0 if least is None else before["last_turn"] - least + 1 - turns
            n = len(places)
            for at in range(0, n, 4096):
                part = slice(at, min(at + 4096, n))
                final = [i == n - 1 for i in range(part.start, part.stop)]
                tail = symbols()[SYMBOLS][4 * states[n] + states[n + 1]][1]
                yield pa.record_batch({
                    "_at": pa.array(places[part], pa.int64()), "entry": pa.array(states[part], pa.int32()), "exit": pa.array(states[part.start + 1 : part.stop + 1], pa.int32()), "tail": pa.array([tail if f else "" for f in final], pa.string()),
                    **{name: pa.array([value if f else 0 for f in final], pa.int64()) for name, value in zip(("gaps", "blank", "duplicate", "truncated", "illegal", "cost"), (gaps, *figures, cost))},
                })

    spread = weighed.drop("symbols").repartition("conv_id").sortWithinPartitions(F.col("conv_id").asc_nulls_first(), "at")
    ways = spread.mapInArrow(walk, "_at long, entry int, exit int, tail string, gaps long, blank long, duplicate long, truncated long, illegal long, cost long")
    ways = materialize(ways, "chunk-ways")
    audit = weighed.select("at", "audits").join(ways, F.col("at") == F.col("_at")).select("_at", "entry", F.concat(F.get("audits", F.col("entry") * 4 + F.col("exit")), "tail").alias("audit"), "gaps", "blank", "duplicate", "truncated", "illegal", "cost")

    def lines(batches):
        for batch in batches:
            made = [list(_repaired(*r)) for r in zip(*(batch.column(n).to_pylist() for n in ("audit", "roles", "texts", "entry")))]
            keep = [i for i, n in enumerate(batch.schema.names) if n not in ("roles", "texts", "entry")]
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in keep), pa.array(made, pa.list_(pa.string()))], names=[*(batch.schema.names[i] for i in keep), "lines"])

    texts = cut.select("conv_id", "at", "roles", "texts").join(audit, F.col("at") == F.col("_at")).drop("_at")
    made = texts.mapInArrow(lines, f"conv_id {conv}, at long, audit string, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, lines array<string>")
    if with_lines:
        return made

    def digests(batches):
        for rows in _conversations(batches):
            digest, audits, figures, conv_id, some = hashlib.sha256(), [], [0] * 6, None, False
            for r in rows:
                conv_id = r["conv_id"]
                audits.append(r["audit"])
                figures = [a + r[n] for a, n in zip(figures, names)]
                if r["lines"]:
                    digest.update((b"\n" if some else b"") + "\n".join(r["lines"]).encode())
                    some = True
            yield pa.RecordBatch.from_arrays([pa.array([conv_id], kind), *(pa.array([f], pa.int64()) for f in figures), pa.array(["".join(audits)]), pa.array([digest.hexdigest()])], names=["conv_id", *names, "audit", "repaired_sha256"])

    names = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    kind = {"string": pa.string(), "int": pa.int32(), "bigint": pa.int64()}[conv]
    return made.repartition("conv_id").sortWithinPartitions(F.col("conv_id").asc_nulls_first(), "at").mapInArrow(digests, f"conv_id {conv}, {FOUND}")


def _conversations(batches):
    """Consecutive rows with one conversation, as generators; a batch at a time is held."""
    rows = (r for batch in batches for r in batch.to_pylist())
    held = next(rows, None)
    while held is not None:
        conv_id = held["conv_id"]

        def one():
            nonlocal held
            while held is not None and held["conv_id"] == conv_id:
                yield held
                held = next(rows, None)

        yield one()


def repair(rows: DataFrame, chunk_rows: int = 1024, with_lines: bool = False) -> DataFrame:
    """One row per conversation: its faults, and the cheapest edits that make its roles fit ``(s?(ua)+)?``.

    ``rows`` has conv_id (string, int or long), turn, role and text; other columns are not read. ``with_lines`` adds the repaired lines: one row per
    chunk then (``at`` orders those of one conversation, whose figures are on one of them).

    Nulls: conversations with a null id are one; null turns come first and count in no gap; null role and text are one
    space. Ties (equal turns) go by role, then by the SHA-256 of role and text. Repeated rows are duplicates. An empty role adds no initial, so
    keeping it changes no state. Texts of any length are whole; no rows give no rows.
    """
    cut = materialize(chunks(rows, chunk_rows), "chunks")
    rules = grammar(materialize(cut.select("symbols").distinct(), "sequences"))
    whole = _whole(cut.where("whole"), rules, with_lines)
    rest = _cut_ones(cut.where("not whole"), rules, with_lines)
    return whole.unionByName(rest, allowMissingColumns=True)


def all_conversations(conversations: DataFrame, repaired: DataFrame) -> DataFrame:
    """``repaired`` with a row for every conversation; those of which no row is left have zeros and empty results."""
    ids = conversations.select(F.col("conv_id").alias("_conv")).distinct()
    found = ids.join(repaired, F.col("_conv").eqNullSafe(F.col("conv_id")), "left")
    figures = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return found.select(F.col("_conv").alias("conv_id"), *figures, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.lit(EMPTY)).alias("repaired_sha256"))
