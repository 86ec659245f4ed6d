"""Repair against plain strings: all edits of short conversations, and a program over strings for longer ones."""

import collections
import hashlib
import itertools
import random
import re
import zlib

import pyarrow.dataset
import pytest
from llm import repair
from llm.queries import QUERIES

SPACES = " \t\n\x0b\x0c\r"
PATTERN = re.compile("(s?(ua)+)?")
CODES = {"s": 0, "u": 1, "a": 2}
FAULTS = ["", "blank", "duplicate", "truncated"]
NEXT = {"": "user", "s": "user", "u": "assistant", "a": "user"}
SCHEMA = "conv_id long, turn long, role string, text string"


def damage(rows):
    out = []
    for r in rows:
        role, text = (" " if r[name] is None else r[name] for name in ("role", "text"))
        conv_id, turn = (" " if r[name] is None else r[name] for name in ("conv_id", "turn"))
        kind = zlib.crc32(f"{conv_id}:{turn}".encode()) % 20
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        out += [(r["conv_id"], r["turn"], "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    return out


def faults_of(rows):
    seen, out = set(), []
    for _, _, role, text in rows:
        last = text.rstrip(SPACES)[-1:]
        out.append("blank" if not last else "duplicate" if (role, text) in seen else "truncated" if last not in ".!?" else "")
        seen.add((role, text))
    return out


def cheapest(rows, faults):
    """Cost, audit and repaired rows; states hold whole strings."""

    def put(states, key, value):
        if key not in states or value[:2] < states[key][:2]:
            states[key] = value

    def inserts(states):
        for _ in range(3):
            for key, (cost, audit, out) in list(states.items()):
                put(states, NEXT[key][0], (cost + 3, audit + "I", (*out, (NEXT[key], ""))))
        return states

    states = {"": (0, "", ())}
    for (_, _, role, text), fault in zip(rows, faults):
        after, extra = {}, 3 if fault == "truncated" else 0
        for key, (cost, audit, out) in inserts(states).items():
            put(after, key, (cost + 4, audit + "D", out))
            if fault in ("blank", "duplicate"):
                continue
            if role and key + role[0] in ("s", "u", "su", "ua", "au"):
                put(after, role[0], (cost + extra, audit + "K", (*out, (role, text))))
            put(after, NEXT[key][0], (cost + 3 + extra, audit + "R", (*out, (NEXT[key], text))))
        states = after
    states = inserts(states)
    return min((states[key] for key in ("", "a") if key in states), key=lambda v: v[:2])


def every_edit(rows, faults):
    """Least (cost, audit) of all edits with at most two inserts in a row."""
    best = None

    def further(at, audit, cost, roles):
        nonlocal best
        if best is not None and cost > best[0]:
            return
        for n in range(3):
            for put in itertools.product("ua", repeat=n):
                a, c, made = audit + "I" * n, cost + 3 * n, roles + "".join(put)
                if at == len(rows):
                    if PATTERN.fullmatch(made) and (best is None or (c, a) < best):
                        best = c, a
                    continue
                extra = 3 if faults[at] == "truncated" else 0
                further(at + 1, a + "D", c + 4, made)
                if faults[at] not in ("blank", "duplicate"):
                    further(at + 1, a + "K", c + extra, made + (rows[at][2][:1] or "x"))
                    for role in "ua":
                        further(at + 1, a + "R", c + 3 + extra, made + role)

    further(0, "", 0, "")
    return best


def coded(rows, faults):
    return bytes(4 * CODES.get(r[2][:1], 3) + FAULTS.index(f) for r, f in zip(rows, faults))


def brute(rows):
    by_id = {r["conv_id"]: [] for r in rows}
    for r in damage(rows):
        by_id[r[0]].append(r)
    out = []
    for conv_id, members in by_id.items():
        members.sort(key=lambda r: (r[1] is not None, r[1] or 0, r[2].encode(), hashlib.sha256(r[3].encode()).digest()))
        faults = faults_of(members)
        counts = collections.Counter(faults)
        turns = [r[1] for r in members if r[1] is not None]
        illegal = sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in zip(members, members[1:]))
        cost, audit, repaired = cheapest(members, faults)
        assert PATTERN.fullmatch("".join(role[:1] for role, _ in repaired))
        text = "\n".join(f"{role}:{text}" for role, text in repaired)
        out.append((conv_id, max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, *(counts[f] for f in FAULTS[1:]),
                    illegal, cost, audit, hashlib.sha256(text.encode()).hexdigest()))
    return sorted(out, key=str)


def test_every_edit():
    r = random.Random(3)
    for _ in range(300):
        rows = [(0, i, r.choice(["user", "assistant", "system", "x", ""]), r.choice(["a.", "b", "", "c!"])) for i in range(r.randrange(4))]
        faults = faults_of(rows)
        assert every_edit(rows, faults) == cheapest(rows, faults)[:2] == repair.solve(coded(rows, faults))


@pytest.mark.parametrize("prime", [(1 << 61) - 1, 3])
def test_long_conversations(monkeypatch, prime):
    """Also where most hashes collide."""
    monkeypatch.setattr(repair, "_PRIME", prime)
    r = random.Random(prime % 97)
    for _ in range(500):
        rows = [(0, i, r.choice("suax"), "") for i in range(r.randrange(60))]
        faults = [r.choice(["", "", *FAULTS, "truncated"]) for _ in rows]
        assert cheapest(rows, faults)[:2] == repair.solve(coded(rows, faults))


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01", "sf0.1"])
def test_whole_table(spark, sf):
    rows = pyarrow.dataset.dataset(f"/root/testdata/{sf}/conversations.parquet").to_table().to_pylist()
    got = QUERIES["op12_conversation_repair"](spark, f"/root/testdata/{sf}").collect()
    assert sorted(map(tuple, got), key=str) == brute(rows)


def asked(spark, tmp_path, rows):
    frame = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "'x' AS kind", "1 AS part", "2 AS code", "'y' AS mark", "'z' AS audit")
    frame.write.mode("overwrite").parquet(str(tmp_path / "conversations.parquet"))
    return sorted(map(tuple, QUERIES["op12_conversation_repair"](spark, str(tmp_path)).collect()), key=str)


def test_odd_rows(spark, tmp_path):
    """Nulls in every column, ties of a turn, repeated rows, a long text, one conversation with a third of all rows."""
    r = random.Random(11)
    rows = [
        {"conv_id": r.choice([None, 7, *range(8), *[5] * 5]), "turn": r.choice([None, *range(9), -3, 1 << 40]),
         "role": r.choice([None, "", "user", "assistant", "system", "Sys"]),
         "text": r.choice([None, "", " \t", "Yes.", "No", "Why?\n", "w " * 50_000, "é "])}
        for _ in range(400)
    ]
    assert asked(spark, tmp_path, rows) == brute(rows)


def test_no_rows(spark, tmp_path):
    assert asked(spark, tmp_path, []) == []


def test_conversation_that_is_lost(spark, tmp_path):
    """Zeros where the damage leaves no row."""
    turn = next(t for t in range(1000) if zlib.crc32(f"1:{t}".encode()) % 20 == 0)
    rows = [{"conv_id": 1, "turn": turn, "role": "user", "text": "Hi."}]
    assert asked(spark, tmp_path, rows) == [(1, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())] == brute(rows)


def test_repaired_rows(spark):
    rows = spark.createDataFrame(
        [(1, 0, "system", "Be kind."), (1, 1, "assistant", "Hello."), (1, 2, "user", "Hi"), (1, 3, "user", "")], SCHEMA)
    found = repair.audits(rows)
    (audit,) = found.collect()
    assert (audit.audit, audit.cost, audit.blank, audit.truncated, audit.illegal) == ("KIKDD", 11, 1, 1, 2)
    got = [(r.place, r.edit, r.role, r.text) for r in repair.repair(rows, found).orderBy("place").collect()]
    assert got == [(1, "K", "system", "Be kind."), (2, "I", "user", ""), (3, "K", "assistant", "Hello.")]
