"""Conversation repair against brute force over all edits and against a plain DP over whole texts."""

from __future__ import annotations

import hashlib
import itertools
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from encore.llm import conversation_repair as repair

SCHEMA = "conv_id long, turn long, role string, text string, fate int, `a.b` int, part long, audit string"


def all_edits(rows):
    """Every edit of a short conversation: (cost, audit, repaired text); at most two inserts at a place."""
    seen, options = set(), []
    for _, role, text in rows:
        fault = repair.fault_of(text, (role, text) in seen)
        seen.add((role, text))
        more = 5 if fault == "t" else 0
        own = [(2, "D", None)]
        if fault not in ("b", "d"):
            own += [(more, "K", (role, text))] + [(1 + more, "R", (other, text)) for other in ("user", "assistant")]
        options.append(own)
    inserts = [list(x) for n in range(3) for x in itertools.product(("user", "assistant"), repeat=n)]
    best = None
    for picks in itertools.product(*options):
        for gaps in itertools.product(inserts, repeat=len(rows) + 1):
            cost = sum(p[0] for p in picks) + 5 * sum(map(len, gaps))
            if best is not None and cost > best[0]:
                continue
            out, audit = [], ""
            for k, gap in enumerate(gaps):
                out += [(r, "") for r in gap]
                audit += "I" * len(gap)
                if k < len(picks):
                    audit += picks[k][1]
                    out += [picks[k][2]] if picks[k][2] else []
            if re.fullmatch(r"(s?(ua)+)?", "".join(r[:1] for r, _ in out)):
                found = (cost, audit, "\n".join(f"{r}:{t}" for r, t in out))
                best = found if best is None else min(best, found)
    return best


def plain(rows):
    """The same DP on whole audit texts, with inserts as steps; (cost, audit)."""
    best, seen = {0: (0, "")}, set()

    def put(table, state, value):
        table[state] = min(table.get(state, value), value)

    def insert(table):
        for _ in range(3):
            for state in list(table):
                put(table, repair.NEXT[state][1], (table[state][0] + 5, table[state][1] + "I"))
        return table

    insert(best)
    for _, role, text in rows:
        fault, after = repair.fault_of(text, (role, text) in seen), {}
        seen.add((role, text))
        for state, (cost, audit) in best.items():
            put(after, state, (cost + 2, audit + "D"))
            if fault in ("b", "d"):
                continue
            more = 5 * (fault == "t")
            if (state, role[:1]) in repair.KEPT:
                put(after, repair.KEPT[state, role[:1]], (cost + more, audit + "K"))
            put(after, repair.NEXT[state][1], (cost + 1 + more, audit + "R"))
        best = insert(after)
    return min(best[s] for s in (0, 3) if s in best)


def damaged(conversations):
    """(conv_id -> rows) by the contract, in plain Python."""
    out = {}
    for conv, turn, role, text in conversations:
        rows = out.setdefault(conv, [])
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        fate = zlib.crc32(key.encode()) % 20
        role, text = (" " if x is None else x for x in (role, text))
        role = "user" if fate == 4 else role
        text = "" if fate == 1 else re.sub("[.!?]", "", text) if fate == 2 else text
        rows += [(turn, role, text)] * {0: 0, 3: 2}.get(fate, 1)
    for rows in out.values():
        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
    return out


def expected(conversations):
    result = []
    for conv, rows in damaged(conversations).items():
        turns = {t for t, _, _ in rows if t is not None}
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        seen, faults = set(), []
        for _, role, text in rows:
            faults.append(repair.fault_of(text, (role, text) in seen))
            seen.add((role, text))
        initials = [r[:1] for _, r, _ in rows]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        cost, audit = plain(rows)
        text = "\n".join(repair.lines(audit, ((r, t) for _, r, t in rows)))
        result.append((conv, gaps, *(faults.count(f) for f in "bdt"), illegal, cost, audit, hashlib.sha256(text.encode()).hexdigest()))
    return sorted(result, key=str)


def conversations(seed, long=0):
    rnd = random.Random(seed)
    texts = ["Hello.", "Why?", "no stop", "  ", "", None, "Fine! ", "é…", "tab\t.\n", "Hello."]
    roles = ["user", "assistant", "user", "assistant", "system", "tool", "", None]
    rows = []
    for conv in [None, -3, *range(60)]:
        for k in range(rnd.randint(1, 9)):
            turn = rnd.choice([k, k, k, k + 1, None, 2 * k])
            rows.append((conv, turn, rnd.choice(roles), rnd.choice(texts)))
    rows += [(1000, k, ("user", "assistant")[k % 2] if rnd.random() < 0.9 else rnd.choice(roles),
              f"{rnd.choice(texts)} {k}{rnd.choice(['.', '.', '', '?'])}" if rnd.random() < 0.9 else "Same.") for k in range(long)]
    rows += [(1001, 0, "user", None)] * 5
    return rows


def result(spark, rows):
    frame = spark.createDataFrame([(*r, 1, 2, 3, "x") for r in rows], SCHEMA).repartition(5)
    return sorted((tuple(r) for r in repair.repair(repair.damage(frame)).collect()), key=str)


@pytest.mark.parametrize("seed", range(12))
def test_against_all_edits(seed):
    rnd = random.Random(seed)
    roles, texts = ["user", "assistant", "system", "tool"], ["A.", "B!", "c", "", "D?"]
    rows = [(k, rnd.choice(roles), rnd.choice(texts)) for k in range(rnd.randint(0, 4))]
    cost, audit, text = all_edits(rows)
    counts, got_cost, got_audit, digest = repair.repair_rows(rows)
    assert (got_cost, got_audit, digest) == (cost, audit, hashlib.sha256(text.encode()).hexdigest())


@pytest.mark.parametrize("seed", range(4))
def test_against_plain_dp(seed):
    rnd = random.Random(100 + seed)
    for _ in range(60):
        rows = [(k, rnd.choice(["user", "assistant", "system", "x"]), rnd.choice(["A.", "b", "", f"{k}.", f"{k}!"])) for k in range(rnd.randint(0, 40))]
        assert repair.repair_rows(rows)[1:3] == plain(rows)


def test_queries_rows(spark):
    rows = conversations(1)
    assert result(spark, rows) == expected(rows)


def test_conversation_over_many_partitions_and_segments(spark, monkeypatch):
    rows = conversations(2, long=9000)
    assert result(spark, rows) == expected(rows)


def test_segments_of_any_size(spark):
    """The tables of segments joined in order give the audit of the whole."""
    rnd = random.Random(5)
    rows = [(k, rnd.choice(["user", "assistant", "system", "x"]), rnd.choice(["A.", "b", "", f"{k}."])) for k in range(300)]
    cost, audit = plain(rows)
    for size in (1, 2, 7, 64):
        best, seen = [(0, repair.Trail()), None, None, None], set()
        for a in range(0, len(rows), size):
            tables = [repair.from_state(s) for s in range(4)]
            for _, role, text in rows[a:a + size]:
                fault = repair.fault_of(text, (role, text) in seen)
                seen.add((role, text))
                tables = [repair.advance(t, role[:1], fault) for t in tables]
            after = [None] * 4
            for start, held in enumerate(best):
                for end, move in enumerate(tables[start] if held else []):
                    if move is not None:
                        repair._offer(after, end, held[0] + move[0], held[1], move[1].text())
            best = after
        final = repair.end(best)
        assert (final[0], final[1].text()) == (cost, audit)


def test_colliding_hashes_do_not_decide(monkeypatch):
    """With a hash that always agrees, the texts themselves are compared."""
    monkeypatch.setattr(repair, "_rolled", lambda value, piece: 0)
    rnd = random.Random(6)
    for _ in range(200):
        root, trails = repair.Trail(), []
        for _ in range(2):
            node = root
            for _ in range(rnd.randint(0, 6)):
                node = repair.Trail(node, "".join(rnd.choice("DIKR") for _ in range(rnd.randint(1, 3))))
            trails.append(node)
        a, b = trails
        assert repair.precedes(a, b) == (a.text() < b.text())


def test_empty_and_dropped(spark):
    assert result(spark, []) == []
    gone = next(k for k in range(1000) if zlib.crc32(f"{k}:0".encode()) % 20 == 0)
    assert result(spark, [(gone, 0, "user", "Hello.")]) == [(gone, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]


def test_string_ids(spark):
    frame = spark.createDataFrame([("a", 0, "user", "Hi."), ("a", 1, "assistant", "Yes."), (None, 0, "user", "Hi.")], "conv_id string, turn int, role string, text string")
    got = repair.repair(frame.withColumn("absent", F.lit(False))).collect()
    assert {r.conv_id: r.audit for r in got} == {"a": "KK", None: "D"}
