"""Operator 13 against an enumeration of all edits, and against itself cut
into blocks."""

from __future__ import annotations

import hashlib
import heapq
import random
import re
import zlib

import pytest

from tallyflow.llm import conversation_repair as rep

SCHEMA = "conv_id long, turn long, role string, text string"
LEGAL = re.compile(r"(s?(ua)+)?")
PREFIX = re.compile(r"s?(ua)*u?")


def cheapest(rows):
    """(cost, audit) by Dijkstra over (row, roles so far) with audits as ties:
    whole role strings as states, no bounds, no tables of the operator."""
    heap, done = [(0, "", 0, "")], set()
    while heap:
        cost, audit, i, roles = heapq.heappop(heap)
        if i == len(rows) and LEGAL.fullmatch(roles):
            return cost, audit
        if (i, roles) in done or not PREFIX.fullmatch(roles):
            continue
        done.add((i, roles))
        if len(roles) < len(rows) + 4:
            for r in "ua":
                heapq.heappush(heap, (cost + 3, audit + "I", i, roles + r))
        if i < len(rows):
            initial, fault = rows[i]
            heapq.heappush(heap, (cost + 4, audit + "D", i + 1, roles))
            if fault not in ("blank", "duplicate"):
                more = 3 if fault == "truncated" else 0
                heapq.heappush(heap, (cost + more, audit + "K", i + 1, roles + (initial or "?")))
                for r in "ua":
                    heapq.heappush(heap, (cost + more + 3, audit + "R", i + 1, roles + r))
    return None


def brute(rows):
    """conv_id -> the contract's columns."""
    convs: dict = {}
    for conv, turn, role, text in rows:
        here = convs.setdefault(conv, [])
        s = lambda x: " " if x is None else str(x)
        role, text, hit = s(role), s(text), zlib.crc32(f"{s(conv)}:{s(turn)}".encode()) % 20
        if hit == 0:
            continue
        if hit == 1:
            text = ""
        if hit == 2:
            text = re.sub("[.!?]", "", text)
        if hit == 4:
            role = "user"
        here += [(turn, role, text)] * (2 if hit == 3 else 1)
    out = {}
    for conv, here in convs.items():
        here.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        seen, codes = set(), []
        for _, role, text in here:
            solid = re.findall(r"[^\x20\x09-\x0D]", text)
            if not solid:
                fault = "blank"
            elif (role, text) in seen:
                fault = "duplicate"
            else:
                fault = "" if solid[-1] in ".!?" else "truncated"
            seen.add((role, text))
            codes.append((role[:1], fault))
        cost, audit = cheapest(codes)
        kept, rest, roles = [], iter(here), ""
        for e in audit:
            row = next(rest) if e != "I" else None
            if e == "D":
                continue
            role = row[1] if e == "K" else "assistant" if roles[-1:] == "u" else "user"
            kept.append(f"{role}:{row[2] if row else ''}")
            roles += role[:1]
        turns = {t for t, _, _ in here if t is not None}
        count = lambda f: sum(x == f for _, x in codes)  # noqa: B023, E731
        initials = [c for c, _ in codes]
        out[conv] = (
            max(turns) - min(turns) + 1 - len(turns) if turns else 0,
            count("blank"), count("duplicate"), count("truncated"),
            sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:], strict=False)),
            cost, audit, hashlib.sha256("\n".join(kept).encode()).hexdigest(),
        )
    return out


def operator(df):
    fixed = rep.repair(rep.damaged(df))
    found = {r["conv_id"]: r for r in fixed.summary.collect()}
    digests = {r["conv_id"]: r["sha256"] for r in fixed.digests().collect()}
    empty = hashlib.sha256(b"").hexdigest()
    return {c: (*(r[x] for x in (*rep.COUNTS, "audit")), digests.get(c, empty)) for c, r in found.items()}


def conversations(rng, n, longest=6):
    rows = []
    for conv in range(n):
        for turn in range(rng.randint(1, longest)):
            role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None])
            text = rng.choice(["Yes.", "No!", "open", "", " \t", None, "Why? ", "ok.\n", "ok)"])
            rows.append((conv, None if rng.random() < 0.1 else turn, role, text))
    return rows


def test_search_is_the_cheapest_then_least():
    rng = random.Random(3)
    code = {"": rep.CLEAN, "blank": rep.BLANK, "duplicate": rep.DUPLICATE, "truncated": rep.OPEN}
    for _ in range(400):
        rows = [(rng.choice("uuaast"), rng.choice(["", "", "", "blank", "duplicate", "truncated"])) for _ in range(rng.randint(0, 5))]
        assert rep.search([(i, code[f]) for i, f in rows]) == cheapest(rows), rows


def test_matches_brute_force(spark):
    rows = conversations(random.Random(5), 60)
    rows += [(None, 0, "user", "Hi."), (None, 1, "assistant", "Hi."), (None, None, None, None)]
    rows += rows[:3]
    assert operator(spark.createDataFrame(rows, SCHEMA)) == brute(rows)


@pytest.mark.parametrize("bits", [2, 16])
def test_conversations_cut_by_partition_borders(spark, monkeypatch, bits):
    """One conversation holds nearly all rows, so it is searched in blocks."""
    monkeypatch.setattr(rep, "BLOCK_BITS", bits)
    rng = random.Random(7)
    roles = ["user", "assistant", "assistant", "user", "tool"]
    rows = [(1, t // 2, rng.choice(roles), rng.choice([f"Say {t}.", f"say {t}", "Again.", ""])) for t in range(400)]
    rows += [(2, 0, "user", "Q?"), (2, 1, "assistant", "A."), (0, 5, "user", "x")]
    got = operator(spark.createDataFrame(rows, SCHEMA).repartition(5))
    plain = [(r[0], r[1], r[2], r[3]) for r in rows]
    kept: list = []
    for conv, turn, role, text in plain:
        if conv != 1:
            continue
        hit = zlib.crc32(f"{conv}:{turn}".encode()) % 20
        if hit == 0:
            continue
        text = "" if hit == 1 else re.sub("[.!?]", "", text) if hit == 2 else text
        kept += [(turn, "user" if hit == 4 else role, text, 1, None)] * (2 if hit == 3 else 1)
    kept.sort(key=lambda r: (r[0], r[1], r[2]))
    faulted = [
        (*r[:4], rep.BLANK if not r[2].strip() else rep.CLEAN if r[2].rstrip()[-1] in ".!?" else rep.OPEN) for r in kept
    ]
    *counts, messages = rep._whole(faulted)
    lines = "\n".join(f"{m['role']}:{m['text']}" for m in messages)
    assert got[1] == (*counts, hashlib.sha256(lines.encode()).hexdigest())
    assert got[2] == brute(plain[400:])[2]
    assert got[0] == brute(plain[400:])[0]


def test_empty_table_long_text_and_extra_columns(spark):
    assert operator(spark.createDataFrame([], SCHEMA)) == {}
    rows = [(4, 0, "user", "word " * 200_000 + "."), (4, 1, "assistant", "Fine.")]
    df = spark.createDataFrame(rows, SCHEMA)
    want = brute(rows)
    clash = df.selectExpr("*", "1 as fault", "'x' as copies", "2 as tie", "true as edge")
    assert operator(clash) == want
