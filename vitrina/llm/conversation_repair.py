"""Conversation structure repair: the cheapest edits that make the roles of a conversation read ``(s?(ua)+)?``.

Edits and their initials: Delete costs 2 (it must be chosen for blank and duplicate rows), Insert of an empty user or assistant row 5, Keep 0, Rerole to
user or assistant 1; a truncated row that is not deleted costs 5 more.  Of equally cheap repairs the one whose initials are least in ASCII order is taken.

A depth-first branch-and-bound proves the optimum (``repair``).  Its nodes are (rows done, state of the role grammar); an explicit stack
visits the edits of a node in the order D, I, K, R, hence audits in ASCII order, so that of equal costs the first one met is the least.
A node is left if a cheaper or equally cheap prefix has reached it before (dominance table per node) or if its cost and a lower bound of
the rest reach the incumbent.  The bound is the cheapest repair of the remaining rows in a grammar that lets conversations end anywhere; the first incumbent's cost comes from one greedy dive along that bound.

At scale: rows are reduced to one letter each (role initial and fault), sorted over range partitions, and searched in segments of at most
``SEGMENT`` rows, so that a conversation of any length is spread over tasks.  A segment whose neighbours lie elsewhere is solved for every
pair of states before and after it; a streaming pass joins the segments of a conversation.  The texts are then passed once in order beside the audit; only the
hash of one conversation's text is a chain that has to stay in one task, and it streams.

Rows are taken by turn, nulls first; rows of one turn by the sha256 of role and text.  A null role, text, id or turn reads as one blank where text is asked for; a role without a
first character has no legal initial.  A null ``conv_id`` is a conversation of its own.  Rows may repeat.  An empty table gives no row.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vitrina.llm.common import SPACES, map_arrow, shared_table, table

DELETE, INSERT, REROLE, TRUNCATED = 2, 5, 1, 5
SEGMENT = 4096
START, SYSTEM, USER, ASSISTANT = range(4)
#: The state after a user or assistant row, the role initial that it takes, and the role's name.
_NEXT, _ROLE = (USER, USER, ASSISTANT, USER), "uuau"
_NAMES = {"u": "user", "a": "assistant"}
_ACCEPTED = (START, ASSISTANT)
_FAR = 1 << 60


def _edits(letter: str, state: int) -> Iterator[tuple[str, int, int, int]]:
    """(initial, cost, next state, rows used) of the legal edits of a row in ASCII order.

    A row's letter is its role's initial, ``o`` for other roles, in upper case if the row is truncated; ``x`` has to go, and an empty letter is the end.
    """
    if letter:
        yield "D", DELETE, state, 1
    yield "I", INSERT, _NEXT[state], 0
    if letter and letter != "x":
        role, extra = letter.lower(), 0 if letter.islower() else TRUNCATED
        if role == _ROLE[state]:
            yield "K", extra, _NEXT[state], 1
        else:
            if role == "s" and state == START:
                yield "K", extra, SYSTEM, 1
            yield "R", REROLE + extra, _NEXT[state], 1


def _bounds(letters: str, targets: tuple[int, ...]) -> list[list[int]]:
    """For each number of rows done and each state: a lower bound of the cost of what is left, ``_FAR`` if no target can be reached."""
    n = len(letters)
    if targets in ((START,), (SYSTEM,)):  # all rows go but, from the start to the system state, one system row
        rest, system = [], _FAR
        for i in range(n, -1, -1):
            if i < n and letters[i] in "sS":
                system = min(system, (TRUNCATED if letters[i] == "S" else 0) - DELETE)
            gone = DELETE * (n - i)
            rest.append([gone, _FAR, _FAR, _FAR] if targets == (START,) else [min(_FAR, gone + system), gone, _FAR, _FAR])
        return rest[::-1]
    user = assistant = start = 0  # the least cost where a user is next, an assistant, or nothing has stood before
    rest = [[0, 0, 0, 0]]
    for letter in reversed(letters):
        one, two, none = user + DELETE, assistant + DELETE, start + DELETE
        if letter != "x":
            role, extra = letter.lower(), 0 if letter.islower() else TRUNCATED
            as_user, as_assistant = assistant + extra + (role != "u") * REROLE, user + extra + (role != "a") * REROLE
            one, two, none = min(one, as_user), min(two, as_assistant), min(none, as_user, user + extra if role == "s" else _FAR)
        user, assistant, start = min(one, two + INSERT), min(two, one + INSERT), min(none, two + INSERT)
        rest.append([start, user, assistant, user])
    return rest[::-1]


def _greedy(letters: str, state: int, targets: tuple[int, ...], rest: list[list[int]]) -> int:
    """The cost of a dive that always takes the edit with the least bound; ``_FAR`` if there is none."""
    at, cost = 0, 0
    while at < len(letters) or state not in targets:
        letter = letters[at:at + 1]
        bound, _, use, spent, then = min((c + rest[at + k][q], not k, k, c, q) for _, c, q, k in _edits(letter, state))
        if bound >= _FAR:
            return _FAR
        at, cost, state = at + use, cost + spent, then
    return cost


def search(letters: str, start: int, targets: tuple[int, ...]) -> tuple[int, str] | None:
    """The least (cost, audit) that leads from the state over all rows into one of the targets; None if nothing does."""
    n, rest = len(letters), _bounds(letters, targets)
    if rest[0][start] >= _FAR:
        return None
    incumbent, audit = _greedy(letters, start, targets, rest) + 1, ""
    least = [_FAR] * (4 * (n + 1))  # per node: the cost of the best prefix so far; among equal ones the first is the least in ASCII order
    path: list[str] = []
    stack = [(0, start, 0, 0, "")]
    while stack:
        at, state, cost, depth, edit = stack.pop()
        if cost >= least[4 * at + state] or cost + rest[at][state] >= incumbent:
            continue
        least[4 * at + state] = cost
        del path[max(0, depth - 1):]
        if edit:
            path.append(edit)
        if at == n and state in targets:
            incumbent, audit = cost, "".join(path)
        for name, more, then, use in reversed(list(_edits(letters[at:at + 1], state))):
            stack.append((at + use, then, cost + more, depth + 1, name))
    return incumbent, audit


_short = lru_cache(1 << 16)(search)


def repair(letters: str) -> tuple[int, str]:
    """(cost, audit) of the best repair of a whole conversation."""
    return (_short if len(letters) <= 64 else search)(letters, START, _ACCEPTED)


def cells(letters: str, known_start: bool, known_end: bool) -> list[dict]:
    """The best edits of a segment for each state before it, and each after it; after -1 stands for the end of the conversation."""
    if known_start and known_end:
        ends = [(START, -1, repair(letters))]
    else:
        ends = [(a, b, search(letters, a, _ACCEPTED if b < 0 else (b,)))
                for a in ((START,) if known_start else range(4)) for b in ((-1,) if known_end else range(4))]
    return [{"before": a, "after": b, "cost": found[0], "audit": found[1]} for a, b, found in ends if found]


def _text(column: Column) -> Column:
    return F.coalesce(column.cast("string"), F.lit(" "))


def rows_of(df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv, turn, role, text) with nulls of role and text as one blank."""
    return df.select(F.col(conv_col).alias("conv"), F.col(turn_col).cast("bigint").alias("turn"), _text(F.col(role_col)).alias("role"),
                     _text(F.col(text_col)).alias("text"))


def damaged(rows: DataFrame) -> DataFrame:
    """Rows dropped, emptied, stripped of sentence ends, repeated or given the role user, by the crc32 of ``conv:turn``."""
    kind = F.crc32(F.concat(_text(F.col("conv")), F.lit(":"), _text(F.col("turn"))).cast("binary")) % 20
    text = F.when(kind == 1, "").when(kind == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    role = F.when(kind == 4, "user").otherwise(F.col("role"))
    times = F.explode(F.when(kind == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    return rows.where(kind != 0).select("conv", "turn", role.alias("role"), text.alias("text"), times.alias("copy")).drop("copy")


def _with_digest(rows: DataFrame) -> DataFrame:
    return rows.withColumn("digest", F.unhex(F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256)))


def faults(rows: DataFrame) -> DataFrame:
    """(conv, turn, digest, number of equal rows, role initial, first fault): one narrow row for the equal rows of a turn.

    Fault 1 is blank, 2 duplicate, 3 truncated, 0 none; of equal rows the second and later ones are duplicates if they are not blank.
    """
    bare = F.btrim("text", F.lit(SPACES))
    narrow = _with_digest(rows).select("conv", "turn", "digest", F.substring("role", 1, 1).alias("initial"), (bare == "").alias("blank"),
                                       (~F.right(bare, F.lit(1)).isin(".", "!", "?")).alias("truncated"))
    counted = shared_table(narrow.groupBy("conv", "turn", "digest").agg(
        F.count(F.lit(1)).alias("n"), *[F.first(c).alias(c) for c in ("initial", "blank", "truncated")]), "turns")
    again = (counted.groupBy("conv", "digest").agg(F.min(F.struct("turn")).alias("first"), F.count(F.lit(1)).alias("places"))
             .where(F.col("places") > 1).select(F.col("conv").alias("c"), F.col("digest").alias("d"), "first"))
    later = F.col("first").isNotNull() & (F.struct("turn") > F.col("first"))
    fault = F.when(F.col("blank"), 1).when(later, 2).when(F.col("truncated"), 3).otherwise(0)
    return (counted.join(again, F.col("conv").eqNullSafe(F.col("c")) & (F.col("digest") == F.col("d")), "left")
            .select("conv", "turn", "digest", "n", "initial", fault.alias("fault")))


_LEGAL = frozenset(("su", "ua", "au"))
_COUNTS = ("blank", "duplicate", "truncated", "illegal")
_CELLS = pa.list_(pa.struct([("before", pa.int64()), ("after", pa.int64()), ("cost", pa.int64()), ("audit", pa.string())]))
_SEGMENT = pa.schema([("part", pa.int64()), ("seq", pa.int64()), ("low", pa.int64()), ("high", pa.int64()), ("turns", pa.int64()),
                      *[(c, pa.int64()) for c in _COUNTS], ("head", pa.string()), ("tail", pa.string()), ("cells", _CELLS)])
_SEGMENT_DDL = ("part bigint, seq bigint, low bigint, high bigint, turns bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint,"
                " head string, tail string, cells array<struct<before:bigint,after:bigint,cost:bigint,audit:string>>")


class _Segment:
    """The counts and letters of consecutive rows of one conversation."""

    def __init__(self, conv, known_start: bool) -> None:
        self.conv, self.known_start = conv, known_start
        self.low = self.high = None
        self.turns, self.counts, self.head, self.tail = 0, dict.fromkeys(_COUNTS, 0), None, None
        self.letters: list[str] = []

    def add(self, turn: int | None, initial: str, fault: int) -> None:
        if turn is not None and turn != self.high:
            self.turns, self.high = self.turns + 1, turn
            self.low = turn if self.low is None else self.low
        if self.tail is None:
            self.head = initial
        elif self.tail + initial not in _LEGAL:
            self.counts["illegal"] += 1
        self.tail = initial
        if fault:
            self.counts[_COUNTS[fault - 1]] += 1
        letter = initial if initial in ("s", "u", "a") else "o"
        self.letters.append("x" if fault in (1, 2) else letter.upper() if fault == 3 else letter)

    def row(self, part: int, seq: int, known_end: bool) -> dict:
        return {"part": part, "seq": seq, "low": self.low, "high": self.high, "turns": self.turns, **self.counts, "head": self.head, "tail": self.tail,
                "cells": cells("".join(self.letters), self.known_start, known_end)}


def segments(faulty: DataFrame, length: int = SEGMENT) -> DataFrame:
    """(conv, place, counts, best edits for the states at both ends) of every run of at most ``length`` rows of one conversation in a task."""
    kind = faulty.schema["conv"].dataType.simpleString()
    spread = faulty.repartitionByRange("conv", "turn", "digest").sortWithinPartitions("conv", "turn", "digest")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq, here = TaskContext.get().partitionId(), 0, None
        conv_type = None

        def batch_of(rows: list[tuple[object, dict]]) -> pa.RecordBatch:
            columns = pa.RecordBatch.from_pylist([r for _, r in rows], _SEGMENT)
            return pa.record_batch([pa.array([c for c, _ in rows], conv_type), *columns.columns], names=["conv", *_SEGMENT.names])

        for batch in batches:
            conv_type, out = batch.schema.field(0).type, []
            for conv, turn, initial, fault, n in zip(*(batch.column(k).to_pylist() for k in range(5)), strict=True):
                if here is None or here.conv != conv:
                    if here is not None:
                        out.append((here.conv, here.row(part, seq, True)))
                        seq += 1
                    here = _Segment(conv, here is not None)
                for k in range(n):
                    if len(here.letters) >= length:
                        out.append((conv, here.row(part, seq, False)))
                        seq += 1
                        here = _Segment(conv, False)
                    here.add(turn, initial, 2 if k and fault != 1 else fault)
                    if len(out) >= 256:
                        yield batch_of(out)
                        out = []
            if out:
                yield batch_of(out)
        if here is not None:
            yield batch_of([(here.conv, here.row(part, seq, False))])

    return map_arrow(spread.select("conv", "turn", "initial", "fault", "n"), run, f"conv {kind}, {_SEGMENT_DDL}")


_RESULT = pa.schema([("gaps", pa.int64()), *[(c, pa.int64()) for c in _COUNTS], ("cost", pa.int64()), ("audit", pa.string())])


def combined(parts: DataFrame) -> DataFrame:
    """(conv, gaps, counts, cost, audit) of each conversation, from its segments in order; keeps one edit string for each state."""
    kind = parts.schema["conv"].dataType.simpleString()
    spread = parts.repartition("conv").sortWithinPartitions("conv", "part", "seq")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv_type, state = None, None
        for batch in batches:
            conv_type, out = batch.schema.field(0).type, []
            for row in batch.to_pylist():
                if state is None or state.conv != row["conv"]:
                    if state is not None:
                        out.append((state.conv, state.result()))
                    state = _Joined(row["conv"])
                state.add(row)
            if out:
                yield _result_batch(out, conv_type)
        if state is not None:
            yield _result_batch([(state.conv, state.result())], conv_type)

    ddl = ", ".join(f"{f.name} {'string' if f.name == 'audit' else 'bigint'}" for f in _RESULT)
    return map_arrow(spread, run, f"conv {kind}, {ddl}")


def _result_batch(rows: list[tuple[object, dict]], conv_type: pa.DataType) -> pa.RecordBatch:
    columns = pa.RecordBatch.from_pylist([r for _, r in rows], _RESULT)
    return pa.record_batch([pa.array([c for c, _ in rows], conv_type), *columns.columns], names=["conv", *_RESULT.names])


class _Joined:
    """The segments of one conversation so far."""

    def __init__(self, conv) -> None:
        self.conv, self.best = conv, {START: (0, "")}
        self.low = self.high = self.tail = None
        self.turns, self.counts = 0, dict.fromkeys(_COUNTS, 0)

    def add(self, row: dict) -> None:
        if row["low"] is not None:
            self.turns += row["turns"] - (row["low"] == self.high)
            self.low, self.high = row["low"] if self.low is None else self.low, row["high"]
        for c in _COUNTS:
            self.counts[c] += row[c]
        if self.tail is not None and self.tail + row["head"] not in _LEGAL:
            self.counts["illegal"] += 1
        self.tail = row["tail"]
        then: dict[int, tuple[int, str]] = {}
        for cell in row["cells"]:
            before = self.best.get(cell["before"])
            if before is not None:
                found = before[0] + cell["cost"], before[1] + cell["audit"]
                then[cell["after"]] = min(then.get(cell["after"], found), found)
        self.best = then

    def result(self) -> dict:
        gaps = 0 if self.low is None else min(self.high - self.low + 1 - self.turns, (1 << 63) - 1)
        cost, audit = min(self.best[q] for q in (-1, *_ACCEPTED) if q in self.best)
        return {"gaps": gaps, **self.counts, "cost": cost, "audit": audit}


def solve(rows: DataFrame, length: int = SEGMENT) -> DataFrame:
    """(conv, gaps, counts, cost, audit) of the conversations in ``rows`` (see ``rows_of``)."""
    return combined(shared_table(segments(shared_table(faults(rows), "faults"), length), "segments"))


class _Walk:
    """The rows of one conversation beside its audit, in order; gives what is left and put in as (role, text)."""

    def __init__(self, audit: str) -> None:
        self.audit, self.at, self.place = audit, 0, 0
        self.odd = (len(audit) - audit.count("D")) % 2  # a repaired conversation of odd length begins with a system row

    def _role(self) -> str:
        role = _NAMES["ua"[(self.place - self.odd) % 2]]
        self.place += 1
        return role

    def inserted(self) -> Iterator[tuple[str, str]]:
        while self.audit[self.at:self.at + 1] == "I":
            self.at += 1
            yield self._role(), ""

    def row(self, role: str, text: str) -> Iterator[tuple[str, str]]:
        yield from self.inserted()
        edit = self.audit[self.at]
        self.at += 1
        if edit == "K":
            self.place += 1
            yield role, text
        elif edit == "R":
            yield self._role(), text


def _beside_audits(rows: DataFrame, solved: DataFrame) -> DataFrame:
    """The rows with their conversation's result before them (kind 0), each conversation in order in one partition."""
    extra = [f.name for f in solved.schema if f.name != "conv"]
    heads = solved.select("conv", F.lit(0).alias("kind"), *extra, *[F.lit(None).cast(t).alias(c) for c, t in (
        ("turn", "bigint"), ("digest", "binary"), ("role", "string"), ("text", "string"))])
    bodies = _with_digest(rows).select("conv", F.lit(1).alias("kind"), *[F.lit(None).cast(solved.schema[c].dataType).alias(c) for c in extra],
                                       "turn", "digest", "role", "text")
    return heads.union(bodies).repartition("conv").sortWithinPartitions("conv", "kind", "turn", "digest")


def repaired(rows: DataFrame, solved: DataFrame) -> DataFrame:
    """(conv, place, role, text): the rows of every conversation after repair, numbered from 0."""
    source = _beside_audits(rows, solved.select("conv", "audit"))
    kind = source.schema["conv"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        walk = conv = conv_type = None
        number = 0
        for batch in batches:
            conv_type, out = batch.schema.field(0).type, []
            for row in batch.to_pylist():
                if row["kind"]:
                    found = walk.row(row["role"], row["text"])
                else:
                    found = walk.inserted() if walk else ()
                for role, text in found:
                    out.append((conv, number, role, text))
                    number += 1
                if not row["kind"]:
                    walk, conv, number = _Walk(row["audit"]), row["conv"], 0
            yield _rows_batch(out, conv_type)
        if walk:
            yield _rows_batch([(conv, number + k, *r) for k, r in enumerate(walk.inserted())], conv_type)

    return map_arrow(source, run, f"conv {kind}, place bigint, role string, text string")


def _rows_batch(rows: list[tuple], conv_type: pa.DataType) -> pa.RecordBatch:
    kinds = (conv_type, pa.int64(), pa.string(), pa.string())
    return pa.record_batch([pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds)], names=["conv", "place", "role", "text"])


def with_hashes(rows: DataFrame, solved: DataFrame) -> DataFrame:
    """``solved`` with ``repaired_sha256``, of the repaired ``role:text`` lines; texts stream past their audit."""
    source = _beside_audits(rows, solved)
    kept = [f.name for f in solved.schema]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        walk = head = schema = None
        sha, first = hashlib.sha256(), True

        def hash_in(found) -> None:
            nonlocal first
            for role, text in found:
                sha.update((f"{role}:{text}" if first else f"\n{role}:{text}").encode())
                first = False

        def ended() -> dict:
            hash_in(walk.inserted())
            return {**head, "repaired_sha256": sha.hexdigest()}

        for batch in batches:
            schema = pa.schema([*(batch.schema.field(c) for c in kept), ("repaired_sha256", pa.string())])
            out = []
            for row in batch.to_pylist():
                if row["kind"]:
                    hash_in(walk.row(row["role"], row["text"]))
                    continue
                if walk:
                    out.append(ended())
                walk, head, sha, first = _Walk(row["audit"]), {c: row[c] for c in kept}, hashlib.sha256(), True
            yield pa.RecordBatch.from_pylist(out, schema)
        if walk:
            yield pa.RecordBatch.from_pylist([ended()], schema)

    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in solved.schema)
    return map_arrow(source, run, f"{ddl}, repaired_sha256 string")


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = rows_of(table(spark, sf_dir, "conversations"))
    rows = damaged(given)
    solved = solve(rows)
    numbers = [F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in ("gaps", *_COUNTS, "cost")]
    every = given.select(F.col("conv").alias("c")).distinct().join(solved, F.col("c").eqNullSafe(F.col("conv")), "left")
    every = every.select(F.col("c").alias("conv"), *numbers, F.coalesce("audit", F.lit("")).alias("audit"))
    return with_hashes(rows, every).withColumnRenamed("conv", "conv_id")


#: The same by a forward recursion over rows and states; a step is up to two inserts and one edit of the row.
OP13_SQL = rf"""
WITH RECURSIVE crc AS (SELECT [list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)
                               FOR i IN range(256)] AS steps),
keyed AS (SELECT *, [ord(c) FOR c IN string_split(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), '')] AS codes FROM conversations),
hashed AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
             xor(list_reduce(list_concat([4294967295], codes), lambda c, b: xor(c >> 8, steps[xor(c & 255, b) + 1])), 4294967295) % 20 AS kind FROM keyed, crc),
after AS (SELECT conv_id, turn, CASE kind WHEN 4 THEN 'user' ELSE role END AS role,
            CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
          FROM hashed, generate_series(1, 2) AS copies(n) WHERE kind <> 0 AND (n = 1 OR kind = 3)),
placed AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, sha256(length(role) || ':' || role || text)) AS i FROM after),
judged AS (SELECT *, CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'blank'
                          WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate'
                          WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') THEN 'truncated' ELSE 'none' END AS fault,
             lag(role[1]) OVER (PARTITION BY conv_id ORDER BY i) || role[1] AS pair FROM placed),
summed AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0)::BIGINT AS gaps, count_if(fault = 'blank')::BIGINT AS blank,
             count_if(fault = 'duplicate')::BIGINT AS duplicate, count_if(fault = 'truncated')::BIGINT AS truncated,
             count_if(pair NOT IN ('su', 'ua', 'au'))::BIGINT AS illegal, count(*) AS n FROM judged GROUP BY conv_id),
grammar(q, role, later) AS (VALUES (0, 's', 1), (0, 'u', 2), (1, 'u', 2), (2, 'a', 3), (3, 'u', 2)),
inserts AS (SELECT DISTINCT q, 0 AS many, q AS later FROM grammar UNION ALL SELECT q, 1, later FROM grammar WHERE role <> 's'
            UNION ALL SELECT a.q, 2, b.later FROM grammar a JOIN grammar b ON b.q = a.later WHERE a.role <> 's' AND b.role <> 's'),
edits AS (SELECT DISTINCT q, NULL AS own, 'D' AS edit, q AS later FROM grammar UNION ALL SELECT q, role, 'K', later FROM grammar
          UNION ALL SELECT q, NULL, 'R', later FROM grammar WHERE role <> 's'),
search AS (
  SELECT conv_id, 0::BIGINT AS i, 0 AS q, ROW(0::BIGINT, '') AS best FROM summed
  UNION ALL
  SELECT s.conv_id, s.i + 1, e.later, min(ROW((s.best[1] + 5 * a.many + CASE edit WHEN 'D' THEN 2 ELSE (edit = 'R')::INT + 5 * (fault = 'truncated')::INT END)::BIGINT,
                                         s.best[2] || repeat('I', a.many) || edit))
  FROM search s JOIN judged r ON r.conv_id = s.conv_id AND r.i = s.i + 1 JOIN inserts a ON a.q = s.q JOIN edits e ON e.q = a.later
  WHERE (own IS NULL OR own = r.role[1]) AND (edit = 'D' OR fault IN ('none', 'truncated'))
  GROUP BY s.conv_id, s.i, e.later),
ended AS (SELECT s.conv_id, min(ROW((s.best[1] + 5 * a.many)::BIGINT, s.best[2] || repeat('I', a.many))) AS best
          FROM search s JOIN summed t ON t.conv_id = s.conv_id AND t.n = s.i JOIN inserts a ON a.q = s.q WHERE a.later IN (0, 3) GROUP BY s.conv_id),
letters AS (SELECT conv_id, best[2] AS audit, unnest(string_split(best[2], '')) AS edit, generate_subscripts(string_split(best[2], ''), 1) AS p FROM ended),
numbered AS (SELECT *, count_if(edit <> 'I') OVER w AS i, count_if(edit <> 'D') OVER w - 1 - length(replace(audit, 'D', '')) % 2 AS place
             FROM letters WHERE edit <> '' WINDOW w AS (PARTITION BY conv_id ORDER BY p)),
lines AS (SELECT n.conv_id, p, CASE edit WHEN 'K' THEN role ELSE CASE place % 2 WHEN 0 THEN 'user' ELSE 'assistant' END END || ':'
                 || CASE edit WHEN 'I' THEN '' ELSE text END AS line
          FROM numbered n LEFT JOIN judged r ON r.conv_id = n.conv_id AND r.i = n.i WHERE edit <> 'D'),
hashes AS (SELECT conv_id, sha256(string_agg(line, chr(10) ORDER BY p)) AS sha FROM lines GROUP BY conv_id)
SELECT c.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
       coalesce(illegal, 0) AS illegal, coalesce(best[1], 0) AS cost, coalesce(best[2], '') AS audit, coalesce(sha, sha256('')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN summed USING (conv_id) LEFT JOIN ended USING (conv_id) LEFT JOIN hashes USING (conv_id)
"""
