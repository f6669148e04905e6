"""Conversation repair: the search against a full recursion, the query against a plain version on odd rows, segments of any length."""

import hashlib
import random
import re
import zlib
from itertools import groupby

import pytest

from vitrina.llm import conversation_repair as repair

GRAMMAR = {0: {"s": 1, "u": 2}, 1: {"u": 2}, 2: {"a": 3}, 3: {"u": 2}}


def plain_repair(roles, faults, start=0, targets=(0, 3)):
    """The least (cost, audit) by a forward pass over states, up to two inserts between rows."""
    best = {start: (0, "")}

    def put(into, state, value):
        into[state] = min(into.get(state, value), value)

    def with_inserts(before):
        after = dict(before)
        for _ in range(3):
            for q, (c, a) in list(after.items()):
                for role, then in GRAMMAR[q].items():
                    if role != "s":
                        put(after, then, (c + 5, a + "I"))
        return after

    best = with_inserts(best)
    for role, fault in zip(roles, faults, strict=True):
        then = {}
        for q, (c, a) in best.items():
            put(then, q, (c + 2, a + "D"))
            if fault not in ("blank", "duplicate"):
                extra = 5 if fault == "truncated" else 0
                for r, p in GRAMMAR[q].items():
                    if r == role:
                        put(then, p, (c + extra, a + "K"))
                    elif r != "s":
                        put(then, p, (c + extra + 1, a + "R"))
        best = with_inserts(then)
    return min((best[q] for q in targets if q in best), default=None)


def letter(role, fault):
    role = role if role in ("s", "u", "a") else "o"
    return "x" if fault in ("blank", "duplicate") else role.upper() if fault == "truncated" else role


@pytest.mark.parametrize("letters", ["suaoSUAOx", "ua", "uaxU", "sSx", "uuaaS"])
def test_search_finds_the_least_cost_and_audit(letters):
    draw = random.Random(letters)
    for _ in range(1500):
        rows = [(draw.choice(["s", "u", "a", "o"]), draw.choice(["none", "none", "truncated", "blank"])) for _ in range(draw.randint(0, 9))]
        rows = [r for r in rows if letter(*r) in letters + letters.lower()]
        text, start = "".join(letter(*r) for r in rows), draw.randrange(4)
        for targets in ((0, 3), (0,), (1,), (2,), (3,)):
            assert repair.search(text, start, targets) == plain_repair(*zip(*rows) if rows else ((), ()), start, targets), text


def test_long_conversations_take_time_in_proportion():
    draw = random.Random(1)
    for letters in ("suaoSUAOx", "s", "us", "uUaA"):
        text = "".join(draw.choice(letters) for _ in range(20_000))
        cost, audit = repair.search(text, 0, (0, 3))
        assert len(audit.replace("I", "")) == 20_000 and cost <= 40_000


def plain_query(rows):
    """The contract, for a list of (conv_id, turn, role, text)."""
    blank = lambda x: " " if x is None else str(x)
    out = []
    key = lambda r: (r[0] is not None, r[0])
    for conv, own in groupby(sorted(rows, key=key), key=lambda r: r[0]):
        after = []
        for _, turn, role, text in own:
            kind = zlib.crc32(f"{blank(conv)}:{blank(turn)}".encode()) % 20
            role, text = blank(role), blank(text)
            text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
            role = "user" if kind == 4 else role
            after += [(turn, role, text)] * (kind != 0) * (1 + (kind == 3))
        after.sort(key=lambda r: (r[0] is not None, r[0], hashlib.sha256(f"{len(r[1])}:{r[1]}{r[2]}".encode()).digest()))
        faults, seen = [], set()
        for _, role, text in after:
            bare = text.strip(" \t\n\x0b\x0c\r")
            faults.append("blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else "none")
            seen.add((role, text))
        roles = [r[1][:1] for r in after]
        cost, audit = plain_repair(roles, faults)
        lines, k, odd = [], 0, len(audit.replace("D", "")) % 2
        for edit in audit:
            named = "user" if (len(lines) - odd) % 2 == 0 else "assistant"
            if edit == "I":
                lines.append(f"{named}:")
                continue
            if edit != "D":
                lines.append(f"{after[k][1] if edit == 'K' else named}:{after[k][2]}")
            k += 1
        turns = [r[0] for r in after if r[0] is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        count = lambda f: faults.count(f)
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(roles, roles[1:]))
        out.append((conv, gaps, count("blank"), count("duplicate"), count("truncated"), illegal, cost, audit,
                    hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return out


COLUMNS = ("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")
KINDS = "conv_id bigint, turn bigint, role string, text string, kind string, digest int, audit string"


def some_rows(seed, convs, most):
    draw = random.Random(seed)
    texts = ["Hello there.", "Yes!", "cut off", "", " \t", "One.\nTwo?", None, "é. \n", "x" * 3000 + "."]
    roles = ["user", "assistant", "user", "assistant", "system", "User", "u", "", None, "tool"]
    rows = []
    for conv in [None, *range(convs)]:
        for turn in range(draw.randint(1, most)):
            role = draw.choice(roles) if draw.random() < 0.3 else ("user", "assistant")[turn % 2]
            text = draw.choice(texts) if draw.random() < 0.4 else f"Text {draw.random()}."
            rows.append((conv, turn * draw.choice([1, 1, 2]) if draw.random() < 0.95 else None, role, text))
            if draw.random() < 0.05:
                rows.append(rows[-1])
    return rows


@pytest.mark.parametrize("length, partitions", [(1, 3), (5, 8), (4096, 8)])
def test_query_equals_plain_version(spark, tmp_path, monkeypatch, length, partitions):
    rows = some_rows(length, 40, 30) + [(999, None, None, None), (998, 2 ** 40, "user", "a."), (998, -2 ** 40, "x", "b")]
    frame = spark.createDataFrame([(*r, "k", 1, "a") for r in rows], KINDS).repartition(partitions)
    frame.write.parquet(f"{tmp_path}/conversations.parquet")
    inner = repair.segments
    monkeypatch.setattr(repair, "segments", lambda faulty, _: inner(faulty, length))
    got = [tuple(r[c] for c in COLUMNS) for r in repair.op13_conversation_repair(spark, str(tmp_path)).collect()]
    assert sorted(got, key=str) == sorted(plain_query(rows), key=str)


def test_one_conversation_over_many_tasks(spark, tmp_path):
    """All rows in one conversation: range partitions cut it, the segments of several tasks are joined."""
    draw = random.Random(7)
    rows = [(5, t, draw.choice(["user", "assistant", "system"]), draw.choice(["A.", "b", f"{t}."])) for t in range(3000)]
    spark.createDataFrame([(*r, "k", 1, "a") for r in rows], KINDS).repartition(4).write.parquet(f"{tmp_path}/conversations.parquet")
    rows_ = repair.damaged(repair.rows_of(spark.read.parquet(f"{tmp_path}/conversations.parquet")))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        parts = repair.segments(repair.faults(rows_), 700)
        assert parts.select("part").distinct().count() > 1
        got = [tuple(r[c] for c in COLUMNS) for r in repair.op13_conversation_repair(spark, str(tmp_path)).collect()]
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert got == plain_query(rows)


def test_repaired_rows(spark):
    rows = repair.rows_of(spark.createDataFrame([
        (1, 1, "system", "Be good."), (1, 2, "user", "Hi."), (1, 3, "user", "Still there?"), (1, 4, "tool", "Yes."), (2, 1, "assistant", "Long."),
        (2, 2, "user", " ")], "conv_id bigint, turn bigint, role string, text string"))
    solved = repair.solve(rows)
    assert {r["conv"]: (r["cost"], r["audit"]) for r in solved.collect()} == {1: (3, "KDKR"), 2: (4, "DD")}
    assert sorted(map(tuple, repair.repaired(rows, solved).collect())) == [
        (1, 0, "system", "Be good."), (1, 1, "user", "Still there?"), (1, 2, "assistant", "Yes.")]
