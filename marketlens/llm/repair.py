"""Conversation structure repair by a persistent audit DP.

The cheapest edits that give a conversation the role order ``(s?(ua)+)?``,
and of the cheapest the ASCII-least audit, the initials of the edits in order.
A row's step is any number of Inserts and then Keep, Rerole or Delete; the DP
keeps the best audit for each state of the role order: empty, after s, after
u, after a.  Audits share their beginnings: an audit is a node that links to
the one before it, with ancestors at powers of two and a rolling hash of all
its steps.  Audits of one cost are compared by the first step in which they
differ, which binary lifting over equal hashes finds; equal hashes of
different nodes are verified step by step.  No step of a row begins another
one of it, and the state follows from the audit, so the least beginning
extends to the least audit.

Rows are summed up in blocks of ``BLOCK`` rows, each solved for every state
that it can be entered in, and the blocks of a conversation are then chained
by the same DP with a block's audit as one step.  A conversation with a third
of all rows is so spread over many tasks; its audit is one cell of the result,
under 2 GB, and the digest of its repaired text one pass over its rows in
order, of which one is in memory.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlens.llm.ranks import blocks, ranked
from marketlens.llm.shared import table
from marketlens.llm.sql_text import CRC32

BLOCK = 512
WHITE = "\t\n\x0b\x0c\r "
EMPTY, SYSTEM, USER, ASSISTANT = range(4)
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1
#: The state that a user or assistant turn leads to from each state.
NEXT = {EMPTY: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
#: Final Inserts from each state: (cost, audit).
FINAL = {EMPTY: (0, ""), SYSTEM: (2 * INSERT, "II"), USER: (INSERT, "I"), ASSISTANT: (0, "")}
PRIME, BASE = (1 << 61) - 1, 0x1B873593CC9E2D51 % ((1 << 61) - 1)


def _steps(initial: str, fault: str) -> dict[int, list[tuple[int, int, str]]]:
    """to state -> (from state, cost, step): the cheapest, then least step of a row between two states."""
    best: dict[tuple[int, int], tuple[int, str]] = {}
    late = TRUNCATED if fault == "t" else 0
    for start in NEXT:
        state, inserts = start, ""
        for _ in range(3):  # more Inserts come back to a state they began in
            cost = INSERT * len(inserts)
            found = [(state, cost + DELETE, inserts + "D")]
            if fault not in "bd":
                if initial == "s" and state == EMPTY:
                    found.append((SYSTEM, cost + KEEP + late, inserts + "K"))
                if initial == {USER: "u", ASSISTANT: "a"}[NEXT[state]]:
                    found.append((NEXT[state], cost + KEEP + late, inserts + "K"))
                found.append((NEXT[state], cost + REROLE + late, inserts + "R"))
            for to, c, step in found:
                best[start, to] = min(best.get((start, to), (c, step)), (c, step))
            state, inserts = NEXT[state], inserts + "I"
    out: dict[int, list[tuple[int, int, str]]] = {s: [] for s in NEXT}
    for (start, to), (c, step) in best.items():
        out[to].append((start, c, step))
    return out


def step_code(step: str) -> int:
    return int.from_bytes(hashlib.blake2b(step.encode(), digest_size=7).digest(), "big") + 1


class Audit:
    """The steps up to a row: the last one, a hash of all, and the audits 1, 2, 4, ... steps before."""

    __slots__ = ("step", "hash", "up")

    def __init__(self, before: Audit | None = None, step: str = "", code: int = 0):
        self.step = step
        self.hash = (before.hash * BASE + code) % PRIME if before else 0
        self.up = []
        while before is not None:
            self.up.append(before)
            before = before.up[len(self.up) - 1] if len(before.up) >= len(self.up) else None

    def steps(self) -> list[str]:
        out, node = [], self
        while node.up:
            out.append(node.step)
            node = node.up[0]
        return out[::-1]


def same(a: Audit, b: Audit) -> bool:
    """Whether two audits of as many steps are equal; equal hashes are verified."""
    if a is b or a.hash != b.hash:
        return a is b
    while a is not b:
        if a.step != b.step:
            return False
        a, b = a.up[0], b.up[0]
    return True


def less(a: Audit, step: str, b: Audit, other: str) -> bool:
    """Whether ``a`` and then ``step`` comes before ``b`` and then ``other``; ``a`` and ``b`` have as many steps."""
    if same(a, b):
        return step < other
    for j in range(len(a.up) - 1, -1, -1):
        if j < len(a.up) and not same(a.up[j], b.up[j]):
            a, b = a.up[j], b.up[j]
    return a.step < b.step


def advance(best: dict, moves: dict[int, list[tuple[int, int, str]]], code=step_code) -> dict:
    """The best (cost, audit) of each state after a step; ``moves`` as of ``_steps``."""
    out = {}
    for to, options in moves.items():
        found = None
        for start, cost, step in options:
            if start in best:
                total, audit = best[start][0] + cost, best[start][1]
                if found is None or total < found[0] or total == found[0] and less(audit, step, found[1], found[2]):
                    found = total, audit, step
        if found:
            out[to] = found[0], Audit(found[1], found[2], code(found[2]))
    return out


def finish(best: dict) -> tuple[int, str]:
    """Cost and audit of the best end."""
    found = None
    for state, (cost, audit) in best.items():
        more, step = FINAL[state]
        if found is None or cost + more < found[0] or cost + more == found[0] and less(audit, step, found[1], found[2]):
            found = cost + more, audit, step
    return found[0], "".join(found[1].steps()) + found[2]


def solve_block(rows: str, entries=(EMPTY,)) -> list[tuple[int, int, int, str]]:
    """(entry, exit, cost, audit) of a block of rows, two letters each: role initial and fault."""
    tables: dict[str, dict] = {}
    codes: dict[str, int] = {}

    def code(step):
        if step not in codes:
            codes[step] = step_code(step)
        return codes[step]

    out = []
    for entry in entries:
        best = {entry: (0, Audit())}
        for i in range(0, len(rows), 2):
            kind = rows[i:i + 2]
            if kind not in tables:
                tables[kind] = _steps(*kind)
            best = advance(best, tables[kind], code)
        out += [(entry, state, cost, "".join(audit.steps())) for state, (cost, audit) in best.items()]
    return out


def _arrow(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(schema)], schema=schema)


SOLVED = pa.schema([("conv", pa.int64()), ("block", pa.int64()), ("ends", pa.string()), ("illegal", pa.int64()),
                    ("moves", pa.string())])
AUDITS = pa.schema([("conv", pa.int64()), ("illegal", pa.int64()), ("cost", pa.int64()), ("audit", pa.string())])
DIGESTS = pa.schema([("conv", pa.int64()), ("sha", pa.string())])
LEGAL = ("su", "ua", "au")


def _solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for conv, block, rows in zip(*(c.to_pylist() for c in batch.columns)):
            roles = rows[::2]
            illegal = sum(roles[i:i + 2] not in LEGAL for i in range(len(roles) - 1))
            moves = solve_block(rows, (EMPTY,) if block == 0 else tuple(NEXT))
            out.append((conv, block, roles[0] + roles[-1], illegal, json.dumps(moves)))
        yield _arrow(out, SOLVED)


def _chain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The audit of each conversation from its blocks, which come in order."""
    now = None

    def result():
        return (now["conv"], now["illegal"], *finish(now["best"]))

    for batch in batches:
        out = []
        for conv, block, ends, illegal, moves in zip(*(c.to_pylist() for c in batch.columns)):
            if now is None or block == 0:
                if now is not None:
                    out.append(result())
                now = {"conv": conv, "illegal": 0, "last": None, "best": {EMPTY: (0, Audit())}}
            else:
                now["illegal"] += now["last"] + ends[0] not in LEGAL
            now["illegal"] += illegal
            now["last"] = ends[1]
            steps: dict[int, list] = {s: [] for s in NEXT}
            for start, to, cost, audit in json.loads(moves):
                steps[to].append((start, cost, audit))
            now["best"] = advance(now["best"], steps)
        yield _arrow(out, AUDITS)
    if now is not None:
        yield _arrow([result()], AUDITS)


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of each repaired conversation: its audit, then its rows in order."""
    now = None

    def line(role, text):
        now["sha"].update(("\n" if now["lines"] else "").encode() + f"{role}:{text}".encode())
        now["lines"] = True

    def inserts():
        while now["audit"][now["at"]:now["at"] + 1] == "I":
            now["at"] += 1
            now["state"] = NEXT[now["state"]]
            line("user" if now["state"] == USER else "assistant", "")

    def result():
        inserts()
        return now["conv"], now["sha"].hexdigest()

    for batch in batches:
        out = []
        for conv, audit, role, text in zip(*(c.to_pylist() for c in batch.columns)):
            if audit is not None:
                if now is not None:
                    out.append(result())
                now = {"conv": conv, "audit": audit, "at": 0, "state": EMPTY, "lines": False, "sha": hashlib.sha256()}
                continue
            inserts()
            letter = now["audit"][now["at"]]
            now["at"] += 1
            if letter != "D":
                state = NEXT[now["state"]]
                if letter == "K":
                    now["state"] = SYSTEM if role[:1] == "s" else state
                    line(role, text)
                else:
                    now["state"] = state
                    line("user" if state == USER else "assistant", text)
        yield _arrow(out, DIGESTS)
    if now is not None:
        yield _arrow([result()], DIGESTS)


def damaged(conversations: DataFrame) -> DataFrame:
    """(conv, turn, role, text): the rows with the damage that the CRC-32 of ``conv_id:turn`` names; nulls are one space."""
    text_of = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(text_of("conv_id"), F.lit(":"), text_of("turn"))) % 20
    rows = conversations.select(F.col("conv_id").cast("long").alias("conv"), F.col("turn").cast("long").alias("turn"),
                                text_of("role").alias("role"), text_of("text").alias("text"), kind.alias("kind")).where("kind > 0")
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    rows = rows.withColumns({"role": F.when(F.col("kind") == 4, "user").otherwise(F.col("role")), "text": text})
    copies = F.explode(F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    return rows.withColumn("copy", copies).select("conv", "turn", "role", "text")


def _initial(role: Column) -> Column:
    first = F.substring(role, 1, 1)
    return F.when(first.isin("s", "u", "a"), first).otherwise("-")


def audits(turns: DataFrame, block: int = BLOCK) -> DataFrame:
    """(conv, illegal, cost, audit, gaps, blank, duplicate, truncated, sha) of ``turns`` (conv, turn, role, text).

    Rows of a conversation are in order of turn, nulls first, those of one
    turn in order of a hash of role and text.  A null conversation id is a
    conversation; roles and texts must not be null.  Every conversation with a
    row has one in the result; ``sha`` is the SHA-256 of its repaired
    ``role:text`` lines.
    """
    bare = F.rtrim(F.col("text"), F.lit(WHITE))
    rows = turns.select(
        "conv", "turn", "role", "text", F.xxhash64("role", "text").alias("x1"),
        F.xxhash64(F.lit(2), "text", F.lit("/"), "role").alias("x2"), _initial(F.col("role")).alias("initial"),
        (bare == "").alias("blank"), F.right(bare, F.lit(1)).isin(".", "!", "?").alias("ended"))
    order = [F.col("turn").asc_nulls_first(), F.col("x1").asc(), F.col("x2").asc()]
    rows = blocks(rows, "conv", order, "damaged-turns")
    narrow = ranked(rows.drop("role", "text"), "conv", order)
    first = (narrow.where("not blank").groupBy("conv", "x1", "x2").agg(F.min("__rank").alias("first"))
             .select(F.col("conv").alias("c"), F.col("x1").alias("z1"), F.col("x2").alias("z2"), "first"))
    narrow = narrow.join(first, F.col("conv").eqNullSafe(F.col("c")) & (F.col("x1") == F.col("z1"))
                         & (F.col("x2") == F.col("z2")), "left")
    fault = (F.when(F.col("blank"), "b").when(F.col("__rank") > F.col("first"), "d").when(~F.col("ended"), "t").otherwise("-"))
    narrow = narrow.select("conv", "turn", "__rank", fault.alias("fault"), "initial",
                           F.expr(f"(__rank - 1) div {block}").alias("block"))
    letters = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("__rank", F.concat("initial", "fault").alias("k")))),
                                       lambda x: x.k), "")
    solved = narrow.groupBy("conv", "block").agg(letters.alias("rows")).select("conv", "block", "rows").mapInArrow(
        _solve, "conv long, block long, ends string, illegal long, moves string")
    found = solved.repartition("conv").sortWithinPartitions("conv", "block").mapInArrow(
        _chain, "conv long, illegal long, cost long, audit string")
    count = lambda x: F.sum(F.when(F.col("fault") == x, 1).otherwise(0))
    by_turn = narrow.groupBy("conv", "turn").agg(*[count(x).alias(x) for x in "bdt"])
    faults = by_turn.groupBy(F.col("conv").alias("c")).agg(
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count("turn"), F.lit(0)).alias("gaps"),
        F.sum("b").alias("blank"), F.sum("d").alias("duplicate"), F.sum("t").alias("truncated"))
    nothing = F.lit(None)
    lines = found.select("conv", nothing.cast("long").alias("turn"), nothing.cast("long").alias("x1"),
                         nothing.cast("long").alias("x2"), "audit", nothing.cast("string").alias("role"),
                         nothing.cast("string").alias("text")).unionByName(
        rows.select("conv", "turn", "x1", "x2", nothing.cast("string").alias("audit"), "role", "text"))
    digests = (lines.repartition("conv").sortWithinPartitions(
        "conv", F.col("audit").isNull(), F.col("turn").asc_nulls_first(), "x1", "x2")
        .select("conv", "audit", "role", "text").mapInArrow(_digest, "conv long, sha string").withColumnRenamed("conv", "d"))
    return (found.join(faults, F.col("conv").eqNullSafe(F.col("c"))).join(digests, F.col("conv").eqNullSafe(F.col("d")))
            .drop("c", "d"))


def op12_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults, cheapest audit and repaired text of every conversation, after the damage."""
    turns = table(spark, sf_dir, "conversations")
    convs = turns.select(F.col("conv_id").cast("long").alias("conv_id")).distinct()
    found = convs.join(audits(damaged(turns)), F.col("conv_id").eqNullSafe(F.col("conv")), "left")
    numbers = [F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c)
               for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return found.select("conv_id", *numbers, F.coalesce("audit", F.lit("")).alias("audit"),
                        F.coalesce("sha", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))


_WHITE = r"[\x20\x09-\x0D]"
OP12_SQL = f"""
WITH RECURSIVE k AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    {CRC32.format("(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '))")} % 20 AS kind FROM conversations),
f AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
    CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM k, unnest(CASE WHEN kind = 3 THEN [0, 1] ELSE [0] END) WHERE kind > 0),
g AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i FROM f),
r AS (
  SELECT conv_id, turn, i, role, text, CASE WHEN substr(role, 1, 1) IN ('s', 'u', 'a') THEN substr(role, 1, 1) ELSE '-' END AS initial,
    lag(substr(role, 1, 1)) OVER (PARTITION BY conv_id ORDER BY i) || substr(role, 1, 1) AS pair,
    CASE WHEN NOT regexp_matches(text, '[^\\x20\\x09-\\x0D]') THEN 'b'
      WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'd'
      WHEN NOT regexp_matches(text, '[.!?]{_WHITE}*\\z') THEN 't' ELSE '-' END AS fault FROM g),
ins(a, n, b) AS (VALUES (0, 0, 0), (0, 1, 2), (0, 2, 3), (1, 0, 1), (1, 1, 2), (1, 2, 3), (2, 0, 2), (2, 1, 3), (3, 0, 3), (3, 1, 2)),
edit(b, letter, initial, c, cost) AS (
  VALUES (0, 'D', '', 0, 3), (1, 'D', '', 1, 3), (2, 'D', '', 2, 3), (3, 'D', '', 3, 3),
    (0, 'R', '', 2, 2), (1, 'R', '', 2, 2), (2, 'R', '', 3, 2), (3, 'R', '', 2, 2),
    (0, 'K', 's', 1, 0), (0, 'K', 'u', 2, 0), (1, 'K', 'u', 2, 0), (3, 'K', 'u', 2, 0), (2, 'K', 'a', 3, 0)),
dp AS (
  SELECT DISTINCT conv_id, 0::BIGINT AS i, 0 AS state, {{'cost': 0, 'audit': ''}} AS x FROM r
  UNION ALL
  SELECT dp.conv_id, r.i, e.c, min({{'cost': x.cost + 2 * n + e.cost + (fault = 't' AND letter <> 'D')::INT,
                                  'audit': x.audit || repeat('I', n) || letter}})
  FROM dp JOIN r ON r.conv_id IS NOT DISTINCT FROM dp.conv_id AND r.i = dp.i + 1 JOIN ins ON ins.a = dp.state
    JOIN edit e ON e.b = ins.b AND (letter = 'D' OR fault NOT IN ('b', 'd') AND e.initial IN ('', r.initial))
  GROUP BY dp.conv_id, r.i, e.c),
z AS (
  SELECT conv_id, min(CASE state WHEN 1 THEN {{'cost': x.cost + 4, 'audit': x.audit || 'II'}}
                                 WHEN 2 THEN {{'cost': x.cost + 2, 'audit': x.audit || 'I'}} ELSE x END) AS x
  FROM dp JOIN (SELECT conv_id AS c, max(i) AS last FROM r GROUP BY ALL) ON c IS NOT DISTINCT FROM conv_id AND i = last GROUP BY conv_id),
l AS (
  SELECT conv_id, j, x.audit[j] AS letter, length(replace(x.audit[1:j], 'I', '')) AS i, length(replace(x.audit[1:j], 'D', '')) AS o
  FROM z, unnest(range(1, length(x.audit) + 1)) u(j)),
w AS (
  SELECT l.conv_id, j, letter, r.role, CASE WHEN letter = 'I' THEN '' ELSE text END AS text,
    o - max((o = 1 AND letter = 'K' AND initial = 's')::INT) OVER (PARTITION BY l.conv_id) AS o
  FROM l LEFT JOIN r ON r.conv_id IS NOT DISTINCT FROM l.conv_id AND r.i = l.i WHERE letter <> 'D'),
s AS (
  SELECT conv_id, string_agg(CASE WHEN letter = 'K' THEN role WHEN o % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' || text,
    chr(10) ORDER BY j) AS said FROM w GROUP BY conv_id),
n AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'b') AS blank,
    count(*) FILTER (fault = 'd') AS duplicate, count(*) FILTER (fault = 't') AS truncated,
    count(*) FILTER (i > 1 AND pair NOT IN ('su', 'ua', 'au')) AS illegal FROM r GROUP BY conv_id)
SELECT c.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate,
  coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal, coalesce(z.x.cost, 0)::BIGINT AS cost,
  coalesce(z.x.audit, '') AS audit, sha256(coalesce(said, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN n ON n.conv_id IS NOT DISTINCT FROM c.conv_id
  LEFT JOIN z ON z.conv_id IS NOT DISTINCT FROM c.conv_id LEFT JOIN s ON s.conv_id IS NOT DISTINCT FROM c.conv_id
"""
