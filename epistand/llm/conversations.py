"""Conversation repair: cheapest edits to a legal turn order, the least audit among the cheapest.

A repaired conversation's role initials are ``(s?(ua)+)?``. A node is (rows done, grammar state):
nothing yet, after ``s``, after ``u``, after ``a``. A cost DP from the end gives every node's cheapest
completion and so its optimal arcs, labelled by the edit's initial. The least label sequence is
found by prefix doubling: nodes are ranked by their least 1, 2, 4, ... labels, each round from the
ranks at both halves; the final ranks pick every node's arc, and doubled pointers read all paths off
at once. Arcs that leave a node differ in label, so costs alone join a conversation's parts.

Rows are dealt over ranges of (conversation, turn, text) and sorted. A conversation inside a range is
solved where it lies. One that crosses ranges or exceeds a block is cut into fragments: equal rows are
traced across fragments by digest, a fragment's costs are a 4 x 4 (min, +) matrix, and only those
matrices, then only its states, pass along the conversation. SHA-256 has to see a conversation's
text in order: its pieces stream through one task, one piece held at a time.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from epistand.llm.common import shared_table

BLOCK_ROWS = 4096  # rows solved together, and the longest fragment
BLOCK_CHARS = 4 << 20
RANGE_BYTES = 32 << 20
MAX_RANGES = 20_000  # then ranges grow; a range is streamed
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3  # costs
EDITS = b"\0DIKR"  # labels 1 to 4 in ASCII order; 0: the path has ended
NONE, SYSTEM, USER, ASSISTANT = range(4)  # states, and the codes of role initials
AFTER = (USER, USER, ASSISTANT, USER)  # state after a user or assistant turn emitted from each state
BIG = 1 << 40
LAST = (0, INSERT + INSERT, INSERT, 0)  # costs behind the last row, insertions included


# ---- damage and row faults -----------------------------------------------------------------------

def damage(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, present): the planted faults, by crc32(``conv_id:turn``) % 20:
    0 drops the row (present is false), 1 empties the text, 2 removes its ``[.!?]``, 3 repeats the
    row, 4 sets role user. Null conv_id, turn, role and text read as one space here; conv_id and turn
    stay null in the result."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    k = F.crc32(F.concat(text("conv_id"), F.lit(":"), text("turn")).cast("binary")) % 20
    body = F.when(k == 1, "").when(k == 2, F.translate(text("text"), ".!?", "")).otherwise(text("text"))
    return rows.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.when(k == 4, "user").otherwise(text("role")).alias("role"), body.alias("text"), (k != 0).alias("present"),
        F.explode(F.array_repeat(F.lit(0), F.when(k == 3, 2).otherwise(1))).alias("copy")).drop("copy")


def _coded(rows: DataFrame) -> DataFrame:
    """Rows with ``code`` (role initial, blank 4, truncated 8, absent 16) and ``key``, a digest of role and text."""
    role, text = F.coalesce("role", F.lit(" ")), F.coalesce("text", F.lit(" "))
    initial = F.substring(role, 1, 1)
    seen = F.regexp_replace(text, "[\\x20\\x09-\\x0D]+\\z", "")
    code = (F.when(initial == "s", SYSTEM).when(initial == "u", USER).when(initial == "a", ASSISTANT).otherwise(NONE)
            + F.when(seen == "", 4).when(~F.substring(seen, -1, 1).isin(".", "!", "?"), 8).otherwise(0)
            + F.when(F.col("present"), 0).otherwise(16))
    key = F.unhex(F.substring(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256), 1, 32))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), code.cast("int").alias("code"),
                       F.when(F.col("present"), key).alias("key"))


# ---- cost DP, arcs and the least path --------------------------------------------------------------

def costs_to_go(codes: list[int], gone: list[bool], end: tuple) -> list[tuple]:
    """Cheapest completion from each (row, state), rows first to last and then ``end``."""
    a0, a1, a2, a3 = end
    out = [tuple(end)]
    for code, must in zip(reversed(codes), reversed(gone), strict=True):
        r0, r1, r2, r3 = a0 + DELETE, a1 + DELETE, a2 + DELETE, a3 + DELETE
        if not must:
            first, more = code & 3, TRUNCATED if code & 8 else 0
            user = a2 + more + (KEEP if first == USER else REROLE)
            reply = a3 + more + (KEEP if first == ASSISTANT else REROLE)
            r0, r1, r2, r3 = min(r0, user), min(r1, user), min(r2, reply), min(r3, user)
            if first == SYSTEM:
                r0 = min(r0, a1 + more + KEEP)
        a2, a3 = min(r2, r3 + INSERT), min(r3, r2 + INSERT)
        a0, a1 = min(r0, a2 + INSERT), min(r1, a2 + INSERT)
        out.append((a0, a1, a2, a3))
    return out[::-1]


def optimal_arcs(cost: np.ndarray, code: np.ndarray, gone: np.ndarray, row: np.ndarray, insert: np.ndarray):
    """(from, label, to) of all optimal arcs; node = 4 * layer + state. ``row``: a row follows the
    layer; ``insert``: turns may be inserted in it."""
    found = []
    has = np.flatnonzero(row)
    first, more = code & 3, np.where(code & 8, TRUNCATED, 0)

    def add(at, state, to, layers, price, label):
        ok = (cost[at, state] < BIG) & (cost[at, state] == price + cost[at + layers, to])
        found.append((4 * at[ok] + state, np.full(int(ok.sum()), label), 4 * (at[ok] + layers) + to))

    keepable = has[~gone[has]]
    for state in range(4):
        add(has, state, state, 1, DELETE, 1)
        add(np.flatnonzero(insert), state, AFTER[state], 0, INSERT, 2)
        same = first[keepable] == AFTER[state]
        add(keepable[same], state, AFTER[state], 1, KEEP + more[keepable[same]], 3)
        add(keepable[~same], state, AFTER[state], 1, REROLE + more[keepable[~same]], 4)
    system = keepable[first[keepable] == SYSTEM]
    add(system, NONE, SYSTEM, 1, KEEP + more[system], 3)
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


class LeastPaths:
    """Least label sequences from all nodes of an acyclic graph of labelled arcs (labels above 0);
    a sequence that ends is less than its extensions. Equal labels may leave a node."""

    def __init__(self, nodes: int, src: np.ndarray, label: np.ndarray, dst: np.ndarray):
        self.rank = self._ranks(nodes, src, label, dst)
        order = np.lexsort((self.rank[dst], label, src))
        arc = order[np.unique(src[order], return_index=True)[1]]
        step, self.label = np.arange(nodes), np.zeros(nodes, np.int64)
        step[src[arc]] = dst[arc]
        self.label[src[arc]] = label[arc]
        self.jumps, self.length = [step], (self.label > 0).astype(np.int64)
        while (self.label[self.jumps[-1]] > 0).any():
            far = self.jumps[-1]
            self.length = self.length + self.length[far]
            self.jumps.append(far[far])

    @staticmethod
    def _ranks(nodes, src, label, dst):
        least = np.full(nodes, np.iinfo(np.int64).max)
        np.minimum.at(least, src, label)
        ended = np.ones(nodes, bool)
        ended[src] = False
        rank = np.where(ended, 0, least)
        on = label == least[src]
        # where the least 2^k labels of a node may lead, sorted by node
        v, w = np.concatenate([src[on], np.flatnonzero(ended)]), np.concatenate([dst[on], np.flatnonzero(ended)])
        order = np.argsort(v, kind="stable")
        v, w = v[order], w[order]
        while not ended[w].all():
            low = np.minimum.reduceat(rank[w], np.flatnonzero(np.diff(v, prepend=-1)))
            best = rank[w] == low[v]  # every node has a place it leads to, so low is by node
            first, count = np.searchsorted(v, np.arange(nodes)), np.bincount(v, minlength=nodes)
            kv, km = v[best], w[best]
            n = count[km]
            reached = np.repeat(first[km] - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(int(n.sum()))
            pair = np.unique(np.repeat(kv, n) * nodes + w[reached])
            rank = np.unique(rank * (int(low.max()) + 1) + low, return_inverse=True)[1]
            v, w = pair // nodes, pair % nodes
        low = np.minimum.reduceat(rank[w], np.flatnonzero(np.diff(v, prepend=-1)))
        return np.unique(rank * (int(low.max()) + 1) + low, return_inverse=True)[1]

    def walk(self, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Path bounds, then the nodes of all paths one after the other, and each path's last node."""
        size = self.length[starts]
        bounds = np.concatenate([[0], np.cumsum(size)])
        offset = np.arange(int(bounds[-1])) - np.repeat(bounds[:-1], size)
        node = np.repeat(starts, size)
        for k, jump in enumerate(self.jumps):
            node = np.where((offset >> k) & 1, jump[node], node)
        return bounds, node, self.jumps[-1][starts]


class Unit:
    """Rows of one conversation in order, all of it or a fragment. Absent rows only name it."""

    def __init__(self, conv, rows: list[tuple], earlier: frozenset = frozenset()):
        self.conv = conv
        self.rows = [r for r in rows if not r[3] & 16]  # (turn, role, text, code, key)
        seen, gone, self.blank, self.duplicate, self.truncated = set(earlier), [], 0, 0, 0
        for _, _, _, code, key in self.rows:
            if code & 4:
                self.blank += 1
            elif key in seen:
                self.duplicate += 1
            elif code & 8:
                self.truncated += 1
            gone.append(bool(code & 4) or key in seen)
            seen.add(key)
        self.codes, self.gone = [r[3] for r in self.rows], gone

    def stats(self) -> dict:
        initials = [c & 3 for c in self.codes]
        legal = {(SYSTEM, USER), (USER, ASSISTANT), (ASSISTANT, USER)}
        turns = [r[0] for r in self.rows if r[0] is not None]
        return {"blank": self.blank, "duplicate": self.duplicate, "truncated": self.truncated,
                "illegal": sum(p not in legal for p in zip(initials, initials[1:], strict=False)),
                "distinct": len(set(turns)), "low": turns[0] if turns else None, "high": turns[-1] if turns else None,
                "first": initials[0] if initials else -1, "final": initials[-1] if initials else -1}


def solve(units: list[Unit], ends: list[tuple], last: list[bool], entry: list[int]):
    """For each unit (cost, end state, audit, edits); an edit is (label, row or -1, state after it)."""
    if not units:
        return []
    cost, code, gone, row, insert, base = [], [], [], [], [], []
    for u, end, final in zip(units, ends, last, strict=True):
        base.append(len(code))
        cost += costs_to_go(u.codes, u.gone, end)
        code += [*u.codes, 0]
        gone += [*u.gone, True]
        row += [True] * len(u.codes) + [False]
        insert += [True] * len(u.codes) + [final]
    cost = np.array(cost, np.int64)
    paths = LeastPaths(4 * len(code), *optimal_arcs(cost, np.array(code), np.array(gone), np.array(row), np.array(insert)))
    starts = 4 * np.array(base) + np.array(entry)
    bounds, node, stop = paths.walk(starts)
    label = paths.label[node]
    to = paths.jumps[0][node]
    layer = np.where(label == 2, -1, node >> 2)
    out = []
    for i, b in enumerate(base):
        lo, hi = bounds[i], bounds[i + 1]
        rows = np.where(layer[lo:hi] < 0, -1, layer[lo:hi] - b)
        final = int(stop[i])
        out.append((int(cost[b, entry[i]] - cost[final >> 2, final & 3]), final & 3,
                    bytes(EDITS[k] for k in label[lo:hi].tolist()).decode(),
                    list(zip(label[lo:hi].tolist(), rows.tolist(), (to[lo:hi] & 3).tolist(), strict=True))))
    return out


def turns_of(unit: Unit, edits: list[tuple]) -> list[tuple[str, str]]:
    """(role, text) of the repaired rows."""
    out = []
    for label, row, state in edits:
        if label == 1:
            continue
        name = "user" if state == USER else "assistant"
        out.append((name, "") if label == 2 else (unit.rows[row][1] if label == 3 else name, unit.rows[row][2]))
    return out


# ---- ranges, fragments and their joins ---------------------------------------------------------------

_RESULT = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
_FRAGMENT = "fid long, turns array<long>, roles array<string>, texts array<string>, codes array<int>, keys array<binary>"
_PIECE = ("conv_id long, fid long, blank long, duplicate long, truncated long, illegal long, distinct long, low long, high long, "
          "first long, final long, cost long, audit string, lines long, body string")
_TYPES = {"long": pa.int64(), "string": pa.string(), "boolean": pa.bool_(), "array<long>": pa.list_(pa.int64()), "binary": pa.binary(),
          "array<string>": pa.list_(pa.string()), "array<int>": pa.list_(pa.int32()), "array<binary>": pa.list_(pa.binary())}
TURNS = "conv_id long, fid long, place long, edit string, role string, text string"


def _batches(schema: str, rows: Iterator[tuple], size: int = 500) -> Iterator[pa.RecordBatch]:
    fields = [x.rsplit(" ", 1) for x in schema.split(", ")]
    held, chars = [], 0
    for r in rows:
        held.append(r)
        chars += sum(len(x) for x in r if isinstance(x, str))
        if len(held) == size or chars > BLOCK_CHARS:
            yield _batch(fields, held)
            held, chars = [], 0
    if held:
        yield _batch(fields, held)


def _batch(fields, rows):
    return pa.RecordBatch.from_arrays([pa.array(c, _TYPES[t]) for c, (_, t) in zip(zip(*rows, strict=True), fields, strict=True)],
                                      [n for n, _ in fields])


def _gaps(low, high, distinct) -> int:
    return 0 if low is None else min(high - low + 1 - distinct, (1 << 63) - 1)


def _whole(units: list[Unit], detail: bool) -> Iterator[tuple]:
    """Result rows (or repaired turns) of complete conversations."""
    n = len(units)
    for u, (cost, _, audit, edits) in zip(units, solve(units, [LAST] * n, [True] * n, [NONE] * n), strict=True):
        turns = turns_of(u, edits)
        if detail:
            kept = [e for e in edits if e[0] != 1]
            yield from ((u.conv, 0, i, chr(EDITS[e[0]]), *t) for i, (e, t) in enumerate(zip(kept, turns, strict=True)))
            continue
        s = u.stats()
        digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in turns).encode()).hexdigest()
        yield (u.conv, _gaps(s["low"], s["high"], s["distinct"]), u.blank, u.duplicate, u.truncated, s["illegal"], cost, audit, digest)


def _rows(batch: pa.RecordBatch) -> Iterator[tuple]:
    return zip(*(batch.column(i).to_pylist() for i in range(batch.num_columns)), strict=True)


def _cut(rows: DataFrame, detail: bool) -> DataFrame:
    """Rows in ranges of (conversation, turn, role and text): complete conversations as results (or
    turns), fragments of the others as lists, in one table written to the shared folder."""
    size = rows.agg(F.sum(F.octet_length("text")), F.count(F.lit(1))).first()
    ranges = min(MAX_RANGES, max(1, -(-(int(size[0] or 0) + 50 * size[1]) // RANGE_BYTES)))
    head = F.substring(F.concat("role", F.lit("\0"), "text"), 1, 64)
    order = [F.asc_nulls_first("conv_id"), F.asc_nulls_first("turn"), "head", "key"]
    sorted_rows = (rows.withColumn("head", head).withColumn("rid", F.monotonically_increasing_id())
                   .repartitionByRange(ranges, *order, "rid").sortWithinPartitions(*order, "rid")
                   .select("conv_id", "turn", "role", "text", "code", "key"))
    whole_schema = TURNS if detail else f"conv_id long, {_RESULT}"
    blank_whole, blank_part = (None,) * (whole_schema.count(",") + 1), (None,) * 6
    schema = f"complete boolean, own long, {', '.join('w_' + x for x in whole_schema.split(', '))}, {_FRAGMENT}"

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        seq = 0

        def fragment(conv, rows):
            nonlocal seq
            turns, roles, texts, codes, keys = (list(x) for x in zip(*rows, strict=True))
            seq += 1
            return (False, conv, *blank_whole, (part << 32) + seq, turns, roles, texts, codes, keys)

        def events():
            conv, rows, chars, split, first = None, None, 0, False, True
            ready, held = [], 0
            for batch in batches:
                for c, *row in _rows(batch):
                    if rows is None or c != conv:
                        if rows is not None:
                            if first or split:
                                yield fragment(conv, rows)
                            else:
                                ready.append(Unit(conv, rows))
                                held += len(rows)
                                if held >= BLOCK_ROWS:
                                    yield from ((True, None, *r, *blank_part) for r in _whole(ready, detail))
                                    ready, held = [], 0
                            first = False
                        conv, rows, chars, split = c, [], 0, False
                    elif len(rows) >= BLOCK_ROWS or chars > BLOCK_CHARS:
                        yield fragment(conv, rows)
                        rows, chars, split = [], 0, True
                    rows.append(tuple(row))
                    chars += len(row[2])
            if rows is not None:
                yield fragment(conv, rows)
            yield from ((True, None, *r, *blank_part) for r in _whole(ready, detail))

        yield from _batches(schema, events())

    return shared_table(sorted_rows.mapInArrow(stream, schema), "conversations")


def _along(df: DataFrame, schema: str, down: bool, begin, follow) -> DataFrame:
    """Stream each conversation's rows by fragment number through ``follow(carry, row) -> (carry, out)``."""

    def run(batches):
        def out():
            conv, carry, any_ = None, None, False
            for batch in batches:
                for row in _rows(batch):
                    if not any_ or row[0] != conv:
                        conv, carry, any_ = row[0], begin(), True
                    carry, got = follow(carry, row)
                    yield got

        yield from _batches(schema, out())

    by = F.desc("fid") if down else F.asc("fid")
    return df.repartition("conv_id").sortWithinPartitions("conv_id", by).mapInArrow(run, schema)


def _pieces(parts: DataFrame, detail: bool) -> DataFrame:
    """Fragments solved with what precedes and follows them: pieces, or repaired turns."""
    # keys that an earlier fragment of the conversation holds
    keys = parts.select("conv_id", "fid", F.explode(F.array_distinct("keys")).alias("key")).where("key is not null")
    first = keys.groupBy("conv_id", "key").agg(F.min("fid").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    first = first.select(F.col("conv_id").alias("c"), F.col("key").alias("k"), "first")
    seen = (keys.join(first, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("key") == F.col("k"))).where("fid > first")
            .groupBy("fid").agg(F.collect_list("key").alias("earlier")))
    seen = shared_table(seen, "earlier-rows")
    thin = parts.select("conv_id", "fid", "codes", "keys").join(seen, "fid", "left").select("conv_id", "fid", "codes", "keys", "earlier")

    def unit(conv, turns, roles, texts, codes, keys, earlier):
        return Unit(conv, list(zip(turns, roles, texts, codes, keys, strict=True)), frozenset(earlier or ()))

    def matrix(batches):
        def out():
            for batch in batches:
                for conv, fid, codes, keys, earlier in _rows(batch):
                    none = [None] * len(codes)
                    u = unit(conv, none, none, none, codes, keys, earlier)
                    columns = [costs_to_go(u.codes, u.gone, tuple(0 if s == t else BIG for s in range(4)))[0] for t in range(4)]
                    yield conv, fid, [min(columns[t][s], BIG) for s in range(4) for t in range(4)]

        yield from _batches("conv_id long, fid long, m array<long>", out())

    def cost_before(after, row):
        conv, fid, m = row
        final, end = (True, LAST) if after is None else (False, after)
        return tuple(min(m[4 * s + t] + end[t] for t in range(4)) for s in range(4)), (conv, fid, final, list(end))

    costs = _along(thin.mapInArrow(matrix, "conv_id long, fid long, m array<long>"), "conv_id long, fid long, final boolean, end array<long>",
                   True, lambda: None, cost_before)
    costs = shared_table(costs, "fragment-costs").select("fid", "final", "end")

    def states(batches):
        def out():
            for batch in batches:
                for conv, fid, codes, keys, earlier, final, end in _rows(batch):
                    none = [None] * len(codes)
                    u = unit(conv, none, none, none, codes, keys, earlier)
                    yield conv, fid, [s for _, s, _, _ in solve([u] * 4, [tuple(end)] * 4, [final] * 4, [0, 1, 2, 3])]

        yield from _batches("conv_id long, fid long, leads array<long>", out())

    leads = thin.join(costs, "fid").select("conv_id", "fid", "codes", "keys", "earlier", "final", "end").mapInArrow(
        states, "conv_id long, fid long, leads array<long>")
    entry = _along(leads, "conv_id long, fid long, entry long", False, lambda: NONE, lambda s, row: (row[2][s], (row[0], row[1], s)))
    plan = shared_table(entry, "fragment-states").join(costs, "fid").join(seen, "fid", "left").select(
        "fid", "entry", "final", "end", "earlier")

    def piece(batches):
        def out():
            for batch in batches:
                for conv, fid, turns, roles, texts, codes, keys, state, final, end, earlier in _rows(batch):
                    u = unit(conv, turns, roles, texts, codes, keys, earlier)
                    ((cost, _, audit, edits),) = solve([u], [tuple(end)], [final], [state])
                    lines = turns_of(u, edits)
                    if detail:
                        kept = [e for e in edits if e[0] != 1]
                        yield from ((conv, fid, i, chr(EDITS[e[0]]), *t) for i, (e, t) in enumerate(zip(kept, lines, strict=True)))
                    else:
                        yield conv, fid, *u.stats().values(), cost, audit, len(lines), "\n".join(f"{r}:{t}" for r, t in lines)

        yield from _batches(TURNS if detail else _PIECE, out())

    names = ["conv_id", "fid", "turns", "roles", "texts", "codes", "keys", "entry", "final", "end", "earlier"]
    return parts.join(plan, "fid").select(*names).mapInArrow(piece, TURNS if detail else _PIECE)


def _assembled(pieces: DataFrame) -> DataFrame:
    """One result row per conversation from its pieces, streamed in order."""

    def run(batches):
        def out():
            open_ = None
            for batch in batches:
                for conv, _, blank, dup, cut, illegal, distinct, low, high, first, final, cost, audit, lines, body in _rows(batch):
                    if open_ is None or open_["conv"] != conv:
                        if open_ is not None:
                            yield close(open_)
                        open_ = {"conv": conv, "sums": [0] * 5, "low": None, "high": None, "distinct": 0, "final": -1, "audit": [],
                                 "lines": 0, "sha": hashlib.sha256()}
                    o = open_
                    if first >= 0:
                        legal = (o["final"], first) in ((SYSTEM, USER), (USER, ASSISTANT), (ASSISTANT, USER))
                        illegal += o["final"] >= 0 and not legal
                        o["final"] = final
                    o["sums"] = [a + b for a, b in zip(o["sums"], (blank, dup, cut, illegal, cost), strict=True)]
                    if low is not None:
                        o["distinct"] += distinct - (o["high"] == low)
                        o["low"], o["high"] = low if o["low"] is None else o["low"], high
                    o["audit"].append(audit)
                    if lines:
                        o["sha"].update((("\n" if o["lines"] else "") + body).encode())
                        o["lines"] += lines
            if open_ is not None:
                yield close(open_)

        def close(o):
            return (o["conv"], _gaps(o["low"], o["high"], o["distinct"]), *o["sums"], "".join(o["audit"]), o["sha"].hexdigest())

        yield from _batches(f"conv_id long, {_RESULT}", out())

    return pieces.repartition("conv_id").sortWithinPartitions("conv_id", "fid").mapInArrow(run, f"conv_id long, {_RESULT}")


def _repair(rows: DataFrame, detail: bool) -> DataFrame:
    if "present" not in rows.columns:
        rows = rows.withColumn("present", F.lit(True))
    out = _cut(_coded(rows.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                                  F.col("role").cast("string").alias("role"), F.col("text").cast("string").alias("text"),
                                  F.coalesce("present", F.lit(True)).alias("present"))), detail)
    names = [x.split()[0] for x in (TURNS if detail else f"conv_id long, {_RESULT}").split(", ")]
    whole = out.where("complete").select(*[F.col(f"w_{n}").alias(n) for n in names])
    parts = out.where("not complete").select(F.col("own").alias("conv_id"), "fid", "turns", "roles", "texts", "codes", "keys")
    pieces = _pieces(parts, detail)
    return whole.union(pieces if detail else _assembled(pieces))


def repair(rows: DataFrame) -> DataFrame:
    """One row per conversation of ``rows`` (conv_id, turn, role, text; others are not read): its faults
    (gaps, blank, duplicate, truncated, illegal), the edits' cost, the audit and the repaired text's SHA-256.

    Rows stand by turn, nulls first; rows of one turn by the first 64 characters of role and text, then
    by digest, so equal rows are neighbours. Null role and text read as one space; a null conv_id is one
    conversation. Role and text count as seen earlier when their 128-bit digests are equal. Where
    ``present`` (optional) is false a row only names its conversation; one without other rows has zeros,
    an empty audit and the hash of empty text. No rows give no rows. Gaps beyond a long are cut to it."""
    return _repair(rows, False)


def repaired_turns(rows: DataFrame) -> DataFrame:
    """The repaired conversations' turns: conv_id, fid and place (ascending: the order), the edit that
    made the turn (K, R or I), role and text."""
    return _repair(rows, True)
