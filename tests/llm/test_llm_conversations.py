"""The prefix trie and the conversation repair, against plain Python."""

import hashlib
import itertools
import os
import random
import sys
import zlib

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from conftest import write_tables  # noqa: E402
from marketlens.llm import prefix_trie, repair  # noqa: E402

HASHED = [("conv", "long"), ("turn", "long"), ("role", "string"), ("text", "string")]


def hashed_order(spark, rows, on):
    """Rows (conv, turn, role, text, ...) as the operators order them: turn with nulls first, then the hashes."""
    frame = spark.createDataFrame([(i, r[2], r[3]) for i, r in enumerate(rows)], "i int, role string, text string")
    hashes = {r.i: (r.a, r.b) for r in frame.select("i", F.xxhash64("role", "text").alias("a"), F.xxhash64(
        F.lit(2), "text", F.lit("/"), "role").alias("b")).collect()}
    order = sorted(range(len(rows)), key=lambda i: (rows[i][1] is not None, rows[i][1] or 0, *hashes[i]))
    out = {}
    for i in order:
        out.setdefault(rows[i][on], []).append(rows[i])
    return out


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def brute_trie(spark, rows):
    """The rows of op11 for (conv_id, turn, role, text)."""
    rows = [(c, t, r or "", x or "") for c, t, r, x in rows if c is not None]
    own = {c: [(r, x) for _, _, r, x in said] for c, said in hashed_order(spark, rows, 0).items()}
    built = {}
    for c, said in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        built[c] = own.get(c - (c % 100 if c >= 0 else -(-c % 100)), [])[:h] + said[h:]
    nodes = {tuple(said[:d]) for said in built.values() for d in range(len(said) + 1)}
    out = set()
    for node in nodes:
        d = len(node)
        members = [c for c, said in built.items() if tuple(said[:d]) == node]
        below = [n for n in nodes if n[:d] == node]
        count = {n: sum(tuple(said[:len(n)]) == n for said in built.values()) for n in below}
        parent = min(c for c, said in built.items() if tuple(said[:d - 1]) == node[:-1]) if d else None
        out.add((min(members), d, parent, len(members), sum(n[:-1] == node for n in below if len(n) == d + 1),
                 sum(not any(m[:-1] == n for m in below if len(m) == len(n) + 1) for n in below),
                 sum((count[n] - 1) * len(n[-1][1]) for n in below if n),
                 sha(",".join(str(c) for c in sorted(members) if len(built[c]) == d))))
    return out


def random_conversations(seed, n):
    r = random.Random(seed)
    rows = []
    for _ in range(n):
        c = r.choice([r.randrange(0, 8), r.randrange(100, 112), r.randrange(200, 230), -r.randrange(1, 9), 300])
        rows += [(c, r.choice([None, *range(6)]), r.choice(["user", "assistant", "system", None]),
                  r.choice(["a", "b?", "", None, "é\U0001F600", "x" * 50])) for _ in range(r.randrange(1, 5))]
    return rows


@pytest.mark.parametrize("shard,factor,queue", [(1, 2, 2), (3, 2, 1000), (128, 64, 3)])
def test_trie_equals_brute_force(spark, tmp_path, monkeypatch, shard, factor, queue):
    """Small shards and queues go through many classes and spilled runs."""
    rows = random_conversations(shard, 40) + [(7, t, "user", f"t{t}") for t in range(12)] + [(None, 0, "user", "x")]
    for name, value in (("SHARD", shard), ("FACTOR", factor), ("QUEUE", queue), ("PIECE", 2)):
        monkeypatch.setattr(prefix_trie, name, value)
    folder = write_tables(tmp_path, conversations=rows)
    found = prefix_trie.op11_prefix_trie(spark, folder).collect()
    assert len(found) == len({tuple(r) for r in found})
    assert {tuple(r) for r in found} == brute_trie(spark, rows)


def test_long_and_copied_conversations_share_their_nodes(spark, tmp_path):
    said = [(i, ("user", "assistant")[i % 2], f"turn {i}.") for i in range(2500)]
    rows = [(c, *t) for c in (100, 200) for t in said] + [(c, t, "user", "same") for c in range(1000, 1400) for t in range(3)]
    found = prefix_trie.op11_prefix_trie(spark, write_tables(tmp_path, conversations=rows)).collect()
    deepest = max(found, key=lambda r: r.depth)
    assert (deepest.depth, deepest.n_convs, deepest.conv_id) == (2500, 2, 100)
    assert deepest.ends_sha256 == sha("100,200")
    root = next(r for r in found if r.depth == 0)
    # 1000 + i is rebuilt on 1000, 1100, ...: all say the same
    assert (root.n_convs, root.n_leaves, root.parent_conv_id) == (402, 2, None)
    assert root.saved_tokens == sum(len(t[2]) for t in said) + 399 * 3 * 4


def test_queue_spills_in_order():
    r = random.Random(5)
    items = [tuple(r.randrange(-9, 9) for _ in range(6)) for _ in range(500)]
    queue = prefix_trie.SpillingQueue(16, 3)
    for x in items:
        queue.push(x)
    assert len(queue.heap) <= 16 and 0 < len(queue.runs) <= 3
    keys = sorted({x[:3] for x in items})
    got = [(k, sorted(queue.pop(k))) for k in keys]
    assert got == [(k, sorted(x for x in items if x[:3] == k)) for k in keys]


def damage(rows):
    out = []
    for c, t, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        text = "" if kind == 1 else text.translate({ord(x): None for x in ".!?"}) if kind == 2 else text
        out += [(c, t, "user" if kind == 4 else role, text)] * (kind > 0) * (1 + (kind == 3))
    return out


WHITE = " \t\n\x0b\x0c\r"


def faults_of(said):
    """Fault of each (role, text)."""
    out = []
    for i, (role, text) in enumerate(said):
        bare = text.rstrip(WHITE)
        out.append("b" if not bare else "d" if (role, text) in said[:i] else "t" if bare[-1] not in ".!?" else "-")
    return out


def brute_repair(said, faults):
    """(cost, audit, lines) of the cheapest, then least audit: a search over all edits with whole audits."""
    import heapq

    heap, done = [(0, "", 0, 0, ())], {}
    best = None
    while heap:
        cost, audit, i, state, lines = heapq.heappop(heap)
        if best is not None and cost > best[0]:
            break
        if i == len(said) and state in (0, 3):
            best = min(best, (cost, audit, lines)) if best else (cost, audit, lines)
        if len(audit) > 3 * len(said) + 3 or (i, state, audit) in done:
            continue
        done[i, state, audit] = True
        role_in = {0: "user", 1: "user", 2: "assistant", 3: "user"}[state]
        to = 3 if state == 2 else 2
        if cost < 3 * len(said):
            heapq.heappush(heap, (cost + 2, audit + "I", i, to, (*lines, f"{role_in}:")))
        if i < len(said):
            (role, text), late = said[i], int(faults[i] == "t")
            heapq.heappush(heap, (cost + 3, audit + "D", i + 1, state, lines))
            if faults[i] not in "bd":
                heapq.heappush(heap, (cost + 2 + late, audit + "R", i + 1, to, (*lines, f"{role_in}:{text}")))
                if role[:1] == "s" and state == 0 or role[:1] == role_in[0]:
                    heapq.heappush(heap, (cost + late, audit + "K", i + 1, 1 if role[:1] == "s" else to, (*lines, f"{role}:{text}")))
    return best


def test_repair_equals_brute_force(spark, tmp_path):
    r = random.Random(8)
    rows = [(c, r.choice([None, *range(9)]) if r.random() < 0.3 else t, r.choice(["user", "assistant", "system", "tool", "", None]),
             r.choice(["a.", "b", "b ", "", None, "é!", f"{c} {t}?", f"{t} \n", "\x85", "x.. "]))
            for c in range(60) for t in range(r.randrange(1, 7))]
    rows += [(None, 0, "user", "nobody."), (None, None, "assistant", "here.")] + rows[:9]
    found = {x.conv_id: x for x in repair.op12_repair(spark, write_tables(tmp_path, conversations=rows)).collect()}
    assert set(found) == {x[0] for x in rows}
    after = hashed_order(spark, damage(rows), 0)
    for conv, x in found.items():
        said = [(role, text) for _, _, role, text in after.get(conv, [])]
        faults = faults_of(said)
        turns = [t for _, t, _, _ in after.get(conv, []) if t is not None]
        cost, audit, lines = brute_repair(said, faults)
        illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(said))
        assert (x.gaps, x.blank, x.duplicate, x.truncated, x.illegal, x.cost, x.audit, x.repaired_sha256) == (
            max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, faults.count("b"), faults.count("d"), faults.count("t"),
            illegal, cost, audit, sha("\n".join(lines))), (conv, said)


def test_blocks_chain_to_the_same_audit(spark):
    """Conversations of many blocks: the same audits whatever the size of a block."""
    r = random.Random(2)
    rows = [(c, t, r.choice(["user", "assistant", "assistant", "system"]), r.choice(["", f"{t}.", f"{t}", "same."]))
            for c in range(6) for t in range(40 * c + 1)]
    turns = spark.createDataFrame(rows, "conv long, turn long, role string, text string")
    want = sorted(map(tuple, repair.audits(turns).collect()))
    assert sorted(map(tuple, repair.audits(turns, block=3).collect())) == want
    for conv, cost, audit in repair.audits(turns, block=7).select("conv", "cost", "audit").collect():
        said = [(x[2], x[3]) for x in rows if x[0] == conv]
        best = repair.advance({0: (0, repair.Audit())}, {0: [(0, 0, "")]})
        for (role, _), fault in zip(said, faults_of(said)):
            best = repair.advance(best, repair._steps(role[:1], fault))
        assert (cost, audit) == repair.finish(best)


def test_equal_hashes_are_verified():
    """With one hash for all steps the least audit is still found."""
    r = random.Random(4)
    for _ in range(200):
        rows = "".join(r.choice("sua-") + r.choice("-bdt") for _ in range(r.randrange(1, 9)))
        best, plain = ({0: (0, repair.Audit())} for _ in range(2))
        for i in range(0, len(rows), 2):
            best = repair.advance(best, repair._steps(*rows[i:i + 2]), lambda s: 1)
            plain = repair.advance(plain, repair._steps(*rows[i:i + 2]))
        assert repair.finish(best) == repair.finish(plain)
        said = [(rows[i].replace("-", "t"), str(i)) for i in range(0, len(rows), 2)]
        assert repair.finish(best) == brute_repair(said, rows[1::2])[:2]
