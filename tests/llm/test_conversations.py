"""Conversation repair against a plain recursion over (cost, audit) pairs."""

import functools
import hashlib
import random
import zlib

import numpy as np
import pytest

from epistand.llm import conversations
from epistand.llm.conversations import LeastPaths

WHITE = " \t\n\x0b\x0c\r"


def plain_damage(rows):
    out = []
    for conv, turn, role, text in rows:
        k = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if k == 1:
            text = ""
        elif k == 2:
            text = "".join(c for c in text if c not in ".!?")
        elif k == 4:
            role = "user"
        out += [(conv, turn, role, text)] * {0: 0, 3: 2}.get(k, 1)
    return out


def plain_repair(rows):
    """rows of one conversation in order -> the contract's tuple."""
    seen, faults = set(), []
    for _, role, text in rows:
        body = text.rstrip(WHITE)
        faults.append("blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else None)
        seen.add((role, text))
    after = {"0": "u", "s": "u", "u": "a", "a": "u"}

    @functools.cache
    def best(i, state, inserted):
        """least (cost, audit, repaired lines)"""
        found = []
        if i == len(rows) and state in "0a":
            found.append((0, "", ()))
        step = after[state]
        name = {"u": "user", "a": "assistant"}[step]
        if inserted < 2:
            c, audit, lines = best(i, step, inserted + 1)
            found.append((c + 3, "I" + audit, (f"{name}:", *lines)))
        if i < len(rows):
            _, role, text = rows[i]
            c, audit, lines = best(i + 1, state, 0)
            found.append((c + 4, "D" + audit, lines))
            if faults[i] not in ("blank", "duplicate"):
                more = 3 if faults[i] == "truncated" else 0
                if role[:1] == step or (role[:1] == "s" and state == "0"):
                    c, audit, lines = best(i + 1, role[:1], 0)
                    found.append((c + more, "K" + audit, (f"{role}:{text}", *lines)))
                c, audit, lines = best(i + 1, step, 0)
                found.append((c + 3 + more, "R" + audit, (f"{name}:{text}", *lines)))
        return min(found, default=(1 << 40, "", ()))

    cost, audit, lines = best(0, "0", 0)
    turns = [t for t, _, _ in rows if t is not None]
    legal = sum((a[1][:1] + b[1][:1]) not in ("su", "ua", "au") for a, b in zip(rows, rows[1:], strict=False))
    return (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, *[faults.count(f) for f in ("blank", "duplicate", "truncated")],
            legal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())


def plain(rows, present):
    """conv_id -> result; ties of a turn in the order of (role, text)."""
    out = {c: [] for c in present}
    for conv, turn, role, text in sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, f"{r[2]}\0{r[3]}"[:64], key(*r[2:]))):
        out[conv].append((turn, role, text))
    return {c: plain_repair(tuple(r)) for c, r in out.items()}


def key(role, text):
    return hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()[:16]


def got_of(df):
    names = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    rows = df.collect()
    out = {r.conv_id: tuple(r[n] for n in names) for r in rows}
    assert len(out) == len(rows)
    return out


def made(rng, conversations, most):
    texts = ["Yes.", "Yes", "No!", "", " \n", "Why?", "a.b", "é. ", "longer words here", "Ok.\t"]
    rows = []
    for conv in range(conversations):
        turn = rng.randint(0, 3)
        for _ in range(rng.randint(1, most)):
            rows.append((conv, turn, rng.choice(["user", "assistant", "system", "user", "assistant", "tool", "", "agent"]),
                         rng.choice(texts) if rng.random() < 0.5 else f"text {rng.random()}."))
            turn += rng.choice([1, 1, 1, 2, 0])
    return rows


def test_least_paths_of_any_graph():
    rng = random.Random(4)
    for _ in range(60):
        n = rng.randint(2, 30)
        arcs = sorted({(a, rng.randint(1, 3), rng.randint(a + 1, n - 1)) for a in (rng.randrange(n - 1) for _ in range(60))})

        @functools.cache
        def least(v, arcs=tuple(arcs)):
            return min(((x, *least(w)) for a, x, w in arcs if a == v), default=())

        src, label, dst = (np.array(x) for x in zip(*arcs, strict=True))
        paths = LeastPaths(n, src, label, dst)
        bounds, node, _ = paths.walk(np.arange(n))
        for v in range(n):
            assert tuple(paths.label[node[bounds[v]:bounds[v + 1]]]) == least(v)
        assert sorted(range(n), key=lambda v: (paths.rank[v], v)) == sorted(range(n), key=lambda v: (least(v), v))


def test_matches_plain_recursion(spark):
    rows = made(random.Random(1), 400, 9) + [(None, None, None, None), (None, 3, "user", "Hi."), (None, 4, None, "x"), (7000, None, "user", None),
                                            (7001, -(1 << 62), "user", "A."), (7001, 1 << 62, "assistant", "B."), (7002, 1, "user", "long. " * 50000)]
    rows += [(8000, 1, "user", "Same.")] * 5
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "conv_id long, turn long, role string, text string, key string, code int")
    damaged = conversations.damage(df)
    assert got_of(conversations.repair(damaged)) == plain(plain_damage(rows), {r[0] for r in rows})
    assert got_of(conversations.repair(df)) == plain([(a, b, " " if c is None else c, " " if d is None else d) for a, b, c, d in rows],
                                                     {r[0] for r in rows})


@pytest.mark.parametrize("block", [1, 3, 7])
def test_hot_conversations_in_fragments(spark, monkeypatch, block):
    rng = random.Random(block)
    rows = made(rng, 30, 6) + [(100 + c % 2, t, r, x) for c, t, r, x in made(rng, 2, 150)]
    monkeypatch.setattr(conversations, "BLOCK_ROWS", block)
    monkeypatch.setattr(conversations, "RANGE_BYTES", 2000)
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    assert got_of(conversations.repair(conversations.damage(df))) == plain(plain_damage(rows), {r[0] for r in rows})


def test_turns_give_the_hash(spark, monkeypatch):
    rows = made(random.Random(9), 40, 20)
    monkeypatch.setattr(conversations, "BLOCK_ROWS", 4)
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    turns = {}
    for r in sorted(conversations.repaired_turns(df).collect(), key=lambda r: (r.conv_id, r.fid, r.place)):
        turns.setdefault(r.conv_id, []).append(r)
    for conv, result in got_of(conversations.repair(df)).items():
        mine = turns.get(conv, [])
        assert hashlib.sha256("\n".join(f"{r.role}:{r.text}" for r in mine).encode()).hexdigest() == result[-1]
        assert "".join(r.edit for r in mine) == result[-2].replace("D", "")


def test_empty_table(spark):
    df = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert conversations.repair(conversations.damage(df)).count() == 0
