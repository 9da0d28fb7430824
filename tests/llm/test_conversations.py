"""Conversation repair against plain versions: every sequence of edits for short ones, a row-by-row search for long ones."""

import hashlib
import itertools
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from sievelake.llm import conversations as C

SOLID, GOAL = re.compile(r"[^\x20\x09-\x0D]"), re.compile(r"(s?(ua)+)?")


def faults(rows):
    seen, out = set(), []
    for role, text in rows:
        solid = SOLID.findall(text)
        out.append("blank" if not solid else "duplicate" if (role, text) in seen else "truncated" if solid[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def plain(rows):
    """(cost, audit, lines) by extending the cheapest audits row by row; initials that can go on alike are one."""
    marks = faults(rows)
    fits = lambda initials: re.fullmatch(r"(s|s?(ua)*u?)?", initials) is not None
    state = {"": ("", 0, "", ())}

    def widened(known):
        out = dict(known)
        for _ in range(2):
            for initials, cost, audit, lines in list(out.values()):
                for role in ("user", "assistant"):
                    put(out, initials + role[0], cost + 5, audit + "I", (*lines, f"{role}:"))
        return out

    def put(out, initials, cost, audit, lines):
        if fits(initials):
            short = {"u": "u", "a": "ua"}.get(initials[-1:], initials)
            if short not in out or (cost, audit) < out[short][1:3]:
                out[short] = (short, cost, audit, lines)

    for (role, text), mark in zip(rows, marks):
        out = {}
        for initials, cost, audit, lines in widened(state).values():
            put(out, initials, cost + 2, audit + "D", lines)
            if mark not in ("blank", "duplicate"):
                more = 5 * (mark == "truncated")
                put(out, initials + role[:1], cost + more, audit + "K", (*lines, f"{role}:{text}"))
                for other in ("user", "assistant"):
                    put(out, initials + other[0], cost + 1 + more, audit + "R", (*lines, f"{other}:{text}"))
        state = out
    done = [(cost, audit, lines) for k, (_, cost, audit, lines) in widened(state).items() if k in ("", "ua")]
    return min(done)


def exhaustive(rows, most=2):
    """The same by trying every audit with up to ``most`` inserts at each place."""
    marks, found = faults(rows), []
    for inserts in itertools.product(range(most + 1), repeat=len(rows) + 1):
        for edits in itertools.product("DKR", repeat=len(rows)):
            if any(e != "D" and m in ("blank", "duplicate") for e, m in zip(edits, marks)):
                continue
            slots = []
            for i, n in enumerate(inserts):
                slots += [("I", None)] * n
                if i < len(rows):
                    slots.append((edits[i], rows[i]))
            cost = sum({"D": 2, "K": 0, "R": 1, "I": 5}[e] for e, _ in slots) + sum(5 for e, m in zip(edits, marks) if e != "D" and m == "truncated")
            for roles in itertools.product(*([r[0][:1]] if e == "K" else [""] if e == "D" else "ua" for e, r in slots)):
                if GOAL.fullmatch("".join(roles)):
                    found.append((cost, "".join(e for e, _ in slots)))
    return min(found)


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        out += [(conv, turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    return out


def expected(rows, all_ids):
    groups = {i: [] for i in all_ids}
    for r in rows:
        groups[r[0]].append(r)
    out = {}
    for conv, found in groups.items():
        tie = lambda r: hashlib.sha256(f"{len(r[2])}:{r[2]}{r[3]}".encode()).digest()[:16]
        found.sort(key=lambda r: (r[1] is not None, r[1] or 0, r[2], tie(r)))
        pairs = [(r[2], r[3]) for r in found]
        turns = [r[1] for r in found if r[1] is not None]
        marks = faults(pairs)
        cost, audit, lines = plain(pairs)
        illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(pairs, pairs[1:]))
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        out[conv] = (gaps, *(marks.count(m) for m in ("blank", "duplicate", "truncated")), illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


NAMES = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def random_rows(seed, n, roles=("system", "user", "assistant", "tool", "", None)):
    rng = random.Random(seed)
    texts = ["", " \t", "yes.", "no", "why?", "end! ", None, "längst.", "a.b"]
    return [(rng.choice([None, 1, 2, 3, 4, 5, 6]), rng.choice([None, *range(12)]), rng.choice(roles), rng.choice(texts)) for _ in range(n)]


def test_plain_version_is_right():
    rng = random.Random(3)
    for _ in range(60):
        rows = [(rng.choice(["system", "user", "assistant", "tool", ""]), rng.choice(["", "yes.", "no", "why?"])) for _ in range(rng.randint(0, 3))]
        assert plain(rows)[:2] == exhaustive(rows), rows


def test_matrices_against_plain():
    rng, sizes = random.Random(5), [*range(1, 12), 60, 300]
    marks = {"blank": C.BLANK, "duplicate": C.DUPLICATE}
    sequences = []
    for n in sizes * 3:
        rows = [(rng.choice(["system", "user", "assistant", "assistant", "tool", ""]), rng.choice(["", "yes.", "no", f"{rng.random()}.", f"{rng.random()}"])) for _ in range(n)]
        codes = bytes(marks.get(m, "sua".find(r[:1]) if r[:1] in ("s", "u", "a") else 3 if not r else 4) + 5 * (m == "truncated") for (r, _), m in zip(rows, faults(rows)))
        sequences.append((rows, codes))
    for rules in ([], [(1, 2), (12, 12), (13, 13), (6, 2), (7, 1), (10, 10), (17, 17)]):
        repairer = C.Repairer(rules)
        for rows, codes in sequences:
            cost, audit, lines = plain(rows)
            assert repairer.whole(codes) == (cost, audit)
            assert list(C._repaired(audit, *zip(*rows))) == list(lines)
            for cut in (1, 2, 7):
                walker, parts = C.Walk(), [codes[i : i + cut] for i in range(0, len(codes), cut)]
                matrices = [repairer.matrix(p) for p in parts]
                for m in matrices:
                    walker.step([x and x[0] for x in m], [x and C.flat(x[1]) for x in m])
                found, states = walker.end()
                way = "".join(C.flat(m[4 * a + b][1]) for m, a, b in zip(matrices, states, states[1:])) + C.symbols()[C.SYMBOLS][4 * states[-2] + states[-1]][1]
                assert (found, way) == (cost, audit)


def test_ropes():
    rng = random.Random(1)
    for _ in range(200):
        words = ["".join(rng.choice("DI") for _ in range(rng.randint(0, 20))) for _ in range(6)]
        left, right = (C._joined(C._joined(a, b), c) for a, b, c in (words[:3], words[3:]))
        assert C._less(left, right) == ("".join(words[:3]) < "".join(words[3:])) and C.flat(left) == "".join(words[:3])


@pytest.mark.parametrize("batch,chunk", [(10000, 1024), (3, 2), (17, 4)])
def test_repair(spark, batch, chunk):
    rows = random_rows(11, 260) + [(7, t, r, f"text {t}.") for t in range(90) for r in ("user", "assistant")] + [(8, 0, "user", "same.")] * 40
    rows += [(9 + i, t, r, x) for i in range(40) for t, (r, x) in enumerate([("system", "be kind."), ("user", "why?"), ("assistant", f"so {i}."), ("user", "why?")])]
    docs = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("at", F.lit("old")).withColumn("code", F.lit("old")).repartition(3)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    try:
        found = C.all_conversations(docs, C.repair(C.damage(docs), chunk_rows=chunk)).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert {r["conv_id"]: tuple(r[n] for n in NAMES) for r in found} == expected(damaged(rows), {r[0] for r in rows}) and len(found) == len({r[0] for r in rows})


def test_lines_and_odd_tables(spark):
    schema = "conv_id string, turn int, role string, text string"
    none = spark.createDataFrame([], schema)
    assert C.repair(none).count() == 0 and C.all_conversations(none, C.repair(C.damage(none))).count() == 0
    long = "word " * 400000
    docs = spark.createDataFrame([("a", 0, "user", long + "."), ("a", 1, "user", "again."), ("b", None, None, None)], schema)
    lines = {r["conv_id"]: r for r in C.repair(docs, with_lines=True).where("conv_id is not null").collect()}
    assert lines["b"]["audit"] == "D" and lines["b"]["lines"] == []
    assert lines["a"]["audit"] == "DKI" or lines["a"]["cost"] == plain([("user", long + "."), ("user", "again.")])[0]


def test_query(spark, small):
    import pyarrow.parquet as pq

    from sievelake.llm.queries import QUERIES

    rows = [tuple(r.values()) for r in pq.read_table(f"{small}/conversations.parquet", columns=["conv_id", "turn", "role", "text"]).to_pylist()]
    found = {r["conv_id"]: tuple(r[n] for n in NAMES) for r in QUERIES["op12_repair_conversations"](spark, small).collect()}
    assert found == expected(damaged(rows), {r[0] for r in rows})


def test_grammar(spark):
    sequences = spark.createDataFrame([(bytearray([0] + [1, 2] * n),) for n in range(1, 40)], "symbols binary")
    rules = C.grammar(sequences, rules=8)
    assert rules[0] == (1, 2) and (12, 12) in rules and len(rules) <= 8
