"""The operators on groups of rows, against plain Python."""

import hashlib
import random
import re

import pytest
from conftest import SF, duck_over, prose
from pyspark.sql import functions as F

from marketlens.llm import chat, line_dedup, lsh_forest, mixing, token_rollup
from marketlens.llm.graph import _star, components

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute_components(rows, k, percent):
    """(id, set size, component, kept) by comparing all pairs."""
    sets = []
    for i, text in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
        sets.append({tuple(w[j:j + k]) for j in range(max(1, len(w) - k + 1))} if w else set())
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for x in range(len(rows)):
        for y in range(x):
            a, b = sets[x], sets[y]
            if rows[x][0] is not None and rows[y][0] is not None and a and b and 100 * len(a & b) >= percent * len(a | b):
                root[find(x)] = find(y)
    least = {}
    for x, (i, _) in enumerate(rows):
        if i is not None:
            least[find(x)] = min(i, least.get(find(x), i))
    return sorted(((i, len(sets[x]), least.get(find(x)) if i is not None else None,
                    i is None or least[find(x)] == i) for x, (i, _) in enumerate(rows)), key=str)


@pytest.mark.parametrize("k", [2, 5])
def test_near_duplicates_by_brute_force(spark, hard, k):
    rows = duck_over(hard).execute("SELECT doc_id, text FROM documents").fetchall()
    r = random.Random(k)
    for g in range(12):  # groups of near copies around the threshold, chains among them
        words = prose(1000 + g, 60).split()
        for c in range(6):
            rows.append((1000 + 10 * g + c, " ".join(words)))
            for _ in range(r.randrange(1, 5)):
                words[r.randrange(60)] = f"new{r.random()}"
    found = lsh_forest.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), k=k).collect()
    assert sorted(((x.doc_id, x.n_shingles, x.component_id, x.kept) for x in found), key=str) == brute_components(rows, k, 80)


def test_one_row_of_each_component_stays(spark, hard):
    docs = spark.read.parquet(f"{hard}/documents.parquet")
    kept = lsh_forest.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.collect()]
    assert ids.count(1) == 1 and not {2, 3, 8} & set(ids) and {4, 5, 6} <= set(ids) and ids.count(None) == 3


def test_kept_rows_are_found_in_one_pass_over_the_texts(spark, hard):
    """The texts are read once to choose rows, those without words or id among them; repeats of those stay too."""
    docs = spark.read.parquet(f"{hard}/documents.parquet")
    kept = lsh_forest.drop_near_duplicates(docs.where("doc_id <> 2"))
    assert kept._jdf.queryExecution().sparkPlan().toString().count("FileScan") == 2  # the texts, and what is named
    rows = [(1, "a b c"), (1, "a b c"), (1, "d e f"), (2, None), (2, ""), (2, " "), (2, ""), (2, "x y z"), (3, "x y z"),
            (None, "a b c"), (None, "a b c"), (None, None)]
    found = lsh_forest.drop_near_duplicates(spark.createDataFrame(rows, "doc_id int, text string")).collect()
    count = lambda i, t: sum(r.doc_id == i and r.text == t for r in found)
    assert [count(2, None), count(2, ""), count(2, " "), count(2, "x y z"), count(3, "x y z")] == [1, 2, 1, 1, 0]
    assert [count(None, "a b c"), count(None, None), count(1, "a b c") + count(1, "d e f")] == [2, 1, 1] and len(found) == 9


def test_rounds_end_when_they_find_few_links(spark, monkeypatch):
    """Rounds that find one link each, after one with hundreds, give way to the exact step, which finds them all."""
    real, turns = lsh_forest._candidates, []
    late = [(1000 + 2 * p, 1001 + 2 * p) for p in range(8)]
    rows = alike_texts(0, 90, 0, 300, 84) + [(i, f"l{i // 2} " * 3 + " ".join(f"l{i // 2}x{j}" for j in range(90))
                                              + f" only{i}" * 2) for p in late for i in p]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    ids = {r["__cid"]: r["__doc"] for r in docs.selectExpr("doc_id __doc", "xxhash64(text) __th", "text __text").mapInArrow(
        lsh_forest._describe(1, 24, (4, 6, 9)), "__doc long, __th long, __n long, __cid long, __keys array<long>").collect()}
    classes = {d: c for c, d in ids.items()}

    def slow(*args):
        turn = args[4]
        turns.append(turn)
        if not turn:
            found = [(r.a, r.b) for r in real(*args).collect() if ids[r.a] < 1000]
        else:
            found = [tuple(sorted(classes[i] for i in late[turn - 1]))] if turn <= len(late) else []
        return spark.createDataFrame(found, "a long, b long")

    monkeypatch.setattr(lsh_forest, "_candidates", slow)
    got = {r.doc_id: r.component_id for r in lsh_forest.near_duplicates(docs, k=1).collect()}
    assert got == {i: i - i % 2 for i, _ in rows} and len(turns) <= 5


def alike_texts(shared, own, singles, pairs, pair_shared):
    """Texts of ``shared`` common words and ``own`` others, and pairs that have further words in common."""
    common = [f"c{j}" for j in range(shared)]
    rows = [(i, " ".join(common + [f"s{i}x{j}" for j in range(own)])) for i in range(singles)]
    for p in range(pairs):
        both = common + [f"p{p}x{j}" for j in range(pair_shared - shared)]
        rows += [(singles + 2 * p + e, " ".join(both + [f"q{p}e{e}x{j}" for j in range(shared + own - pair_shared)])) for e in (0, 1)]
    return rows


def test_pairs_in_crowded_regions(spark):
    """Texts alike by 0.695 share regions with hundreds of others; the pairs are alike by 0.802."""
    rows = alike_texts(82, 18, 1600, 250, 89)
    found = lsh_forest.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(8), k=1)
    got = {r.doc_id: r.component_id for r in found.collect()}
    assert got == {i: i if i < 1600 else i - (i - 1600) % 2 for i in range(2100)}


def test_threshold_pairs_whose_signatures_agree_less(spark):
    """Of 500 pairs alike by exactly 0.8, a few agree in less than 0.74 of the signature; no round is without the filter."""
    rows = alike_texts(0, 90, 0, 500, 80)
    found = lsh_forest.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(8), k=1, best_rounds=0)
    assert {r.doc_id: r.component_id for r in found.collect()} == {i: i - i % 2 for i in range(1000)}


def test_common_shingles_are_counted_on_some_of_a_component(spark, monkeypatch):
    """Four times the near copies of one component make no four times the counts; every pair is still listed."""
    real, made = lsh_forest._frequencies, []

    def counted(k):
        total, run = spark.sparkContext.accumulator(0), real(k)
        made.append(total)

        def rows(batches):
            for batch in run(batches):
                total.add(batch.num_rows)
                yield batch
        return rows

    monkeypatch.setattr(lsh_forest, "_frequencies", counted)
    r = random.Random(5)
    base = [f"b{j}" for j in range(100)]
    for copies in (300, 1200):
        rows = []
        for i in range(copies + 60):  # the last are alone in their components, every other one alike to the base
            words = list(base)
            for j in r.sample(range(100), 5 if i < copies or i % 2 else 30):
                words[j] = f"x{i}y{j}"
            rows.append((i, 0 if i < copies else i, " ".join(words)))
        crowd = spark.createDataFrame(rows, "__cid long, __comp long, __text string").repartition(4).cache()
        found = {(x.a, x.b) for x in lsh_forest._joined(
            crowd.select("__cid", "__comp"), crowd.select("__cid", "__text"), 1, 80).collect()}
        sets = [set(text.split()) for _, _, text in rows]
        assert {(a, b) for b in range(copies, copies + 60) for a in range(b)
                if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])} <= found
        crowd.unpersist()
    assert 0 < made[1].value < 2.5 * made[0].value


def test_components_of_paths_and_stars(spark):
    r = random.Random(2)
    edges = [(i, i + 1) for i in range(100, 160)] + [(500, i) for i in range(501, 560)] + [(7, 7), (900, 901), (901, 900)]
    r.shuffle(edges)
    found = {x.u: x.root for x in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    want = {i: 100 for i in range(101, 161)} | {i: 500 for i in range(501, 560)} | {901: 900}
    assert found == want
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_star_steps_share_their_shuffles(spark):
    """A small star step takes the large one before it twice, not three times."""
    edges = spark.createDataFrame([(2, 1)], "u long, v long")
    plan = _star(_star(edges, True), False)._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("Join") == 3
    doubled = _star(spark.createDataFrame([(3, 1), (2, 1), (3, 2)], "u long, v long"), True)
    assert {(r.u, r.v) for r in doubled.collect()} == {(2, 1), (3, 1)}


def test_line_runs_merge_and_anti_join(spark):
    def batch(*docs):
        return line_dedup.eligible_lines(spark.createDataFrame(docs, "doc_id long, text string"), min_chars=3)

    runs = line_dedup.LineRuns(spark, fanout=2)
    batches = [batch((1, "aaa\nbbb"), (2, "AAA ")), batch((3, "aaa\nccc"), (4, None)), batch((5, "bbb\nddd")), batch((6, "aaa\neee"))]
    fresh = []
    for b in batches:
        fresh.append(runs.fresh_lines(b).count())
        runs.add(b)
    assert fresh == [3, 1, 1, 1] and [len(level) for level in runs.levels] == [0, 0, 1]
    shared = {(r.n_docs, r.last_doc) for r in runs.shared(2).collect()}
    assert shared == {(4, 6), (2, 5)}
    runs.add(batch((7, "aaa\nfff\neee")))
    (run, delta), = runs.levels[0]
    assert spark.table(run).count() == 1 and {(r.n_docs, r.last_doc) for r in spark.table(delta).collect()} == {(1, 7)}
    assert {(r.n_docs, r.last_doc) for r in runs.shared(2).collect()} == {(5, 7), (2, 5), (2, 7)}
    plan = runs._unseen(spark.table(run))._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "LeftAnti" in plan and "Exchange" not in plan  # runs are merged where they lie
    runs.forget()
    assert not [t for t in spark.catalog.listTables() if t.name.startswith(runs.name)]


def test_columns_of_any_name_pass(spark, hard):
    docs = spark.read.parquet(f"{hard}/documents.parquet").where("doc_id < 30")
    odd = docs.withColumn("__th", F.col("doc_id")).withColumn("__doc", F.lit("x")).withColumn("__n_lines", F.lit("y"))
    plain, found = line_dedup.drop_shared_lines(docs), line_dedup.drop_shared_lines(odd)
    assert set(found.columns) == set(plain.columns) | {"__th", "__doc"}
    assert sorted(map(str, found.select(plain.columns).collect())) == sorted(map(str, plain.collect()))
    assert found.where("__th = doc_id and __doc = 'x'").count() == docs.count()
    kept = lsh_forest.drop_near_duplicates(odd)
    assert kept.columns == odd.columns and kept.count() == lsh_forest.drop_near_duplicates(docs).count()
    assert mixing.mix(odd, mixing.cycled_weights(docs)).count() == docs.count()


def test_shared_lines(spark, hard):
    docs = spark.read.parquet(f"{hard}/documents.parquet")
    found = {r.doc_id: r for r in line_dedup.drop_shared_lines(docs).collect()}
    rows = dict(duck_over(hard).execute("SELECT doc_id, text FROM documents WHERE doc_id BETWEEN 20 AND 27").fetchall())
    for i, text in rows.items():
        lines = text.split("\n")
        assert found[i]["__n_lines"] == 4 and found[i]["__n_dropped"] == (0 if i == 27 else 2)
        assert found[i]["__kept_text"] == (text if i == 27 else "\n".join([lines[0], lines[3]]))
    assert found[4]["__n_lines"] == found[5]["__n_lines"] == 1 and found[4]["__kept_text"] == "" and found[14]["__kept_text"] == "x\n\n\ny"


def test_mix_reaches_its_targets(spark, hard):
    docs = spark.read.parquet(f"{hard}/documents.parquet")
    found = mixing.mix(docs, mixing.cycled_weights(docs)).collect()
    by = {}
    for r in found:
        assert 0 <= r.taken <= 3 * r.size
        by.setdefault(r.source, []).append(r)
    for rows in by.values():
        assert rows[0].source_size == sum(r.size for r in rows) and rows[0].target <= 3 * rows[0].source_size
        assert sum(r.taken for r in rows) == int(rows[0].target)
    again = mixing.mix(docs.repartition(9), mixing.cycled_weights(docs)).collect()
    assert sorted(map(str, found)) == sorted(map(str, again))


@pytest.mark.parametrize("seed", range(4))
def test_water_filling(spark, seed):
    r = random.Random(seed)
    rows = [(f"s{i}", r.choice((0, 1, 10, 1000, 10**6)), r.choice((0, 1, 2, 5))) for i in range(12)]
    found = {x.s: x["__num"] / x["__den"] for x in
             mixing.water_fill(spark.createDataFrame(rows, "s string, __size long, __weight int")).collect()}
    total, caps = sum(x[1] for x in rows), {}
    while True:  # one source a time
        free = sum(w for s, _, w in rows if s not in caps)
        share = (total - sum(caps.values())) / free if free else 0
        above = [s for s, n, w in rows if s not in caps and share * w > 3 * n]
        if not above:
            break
        caps[above[0]] = 3 * dict((s, n) for s, n, _ in rows)[above[0]]
    for s, n, w in rows:
        assert found[s] == pytest.approx(caps.get(s, share * w))


def test_sources_without_a_weight_take_nothing(spark):
    docs = spark.createDataFrame([(1, "a", "x y"), (2, "b", "x")], "doc_id long, source string, text string")
    weights = spark.createDataFrame([("a", 1)], "source string, weight int")
    assert {r.doc_id: r.taken for r in mixing.mix(docs, weights).collect()} == {1: 3, 2: 0}


def test_conversations_by_brute_force(spark, hard):
    rows = duck_over(hard).execute("SELECT * FROM conversations").fetchall()
    convs = {}
    last = 10**18
    for c, t, role, text, *_ in rows:
        convs.setdefault(c, []).append((last if t is None else t, role or "", text or "", role, text))
    said = {c: [(r, x) for *_, r, x in sorted(v, key=lambda y: y[:3])] for c, v in convs.items()}
    maximal = {}
    for c, v in said.items():
        if not any(len(o) > len(v) and o[:len(v)] == v for o in said.values()):
            maximal.setdefault(str(v), []).append(c)
    want = {min(cs, key=lambda c: (c is not None, c or 0)): len(cs) for cs in maximal.values()}
    for block in (1, 1024):
        found = chat.collapse(spark.read.parquet(f"{hard}/conversations.parquet"), block=block).collect()
        assert {r.conv_id: r.n_collapsed for r in found} == want
        assert {r.conv_id: r.n_collapsed for r in found} == want
        for r in found:
            assert r.n_turns == len(said[r.conv_id])
            assert r.rendered == "".join(f"<|{a or ''}|>\n{b or ''}\n" for a, b in said[r.conv_id])


def test_chunks_join_to_the_whole_text(spark, hard):
    rows = [(1, i, "user", f"turn {i}") for i in range(25)] + [(2, None, "user", f"late {i:02}") for i in range(9)]
    turns = spark.read.parquet(f"{hard}/conversations.parquet").select("conv_id", "turn", "role", "text").where("conv_id > 2")
    turns = turns.unionByName(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    pieces = {}
    for r in sorted(chat.chunks(turns, block=4).collect(), key=lambda r: (r.conv_id, r.chunk)):
        assert r.rendered.count("<|") <= 4 and r.chunk == len(pieces.setdefault(r.conv_id, []))
        pieces[r.conv_id].append(r.rendered)
    assert {k: "".join(v) for k, v in pieces.items()} == {r.conv_id: r.rendered for r in chat.collapse(turns).collect()}
    assert len(pieces[1]) == 7 and len(pieces[2]) == 3


def test_rollup_counts_every_batch_once(spark):
    def rows(*r):
        return spark.createDataFrame([(s, "en", "t", n) for s, n in r], "source string, lang string, tokenizer string, n_tokens long")

    rollup = token_rollup.TokenRollup(spark)
    assert rollup.totals().count() == 0
    assert rollup.commit("one", token_rollup.inserts(rows(("a", 5), ("a", 7), ("b", 1))))
    assert not rollup.commit("one", token_rollup.inserts(rows(("a", 5))))
    # a batch that was written but not logged is written again
    token_rollup.inserts(rows(("a", 99))).write.parquet(f"{rollup.path}/batch=two")
    assert rollup.commit("two", token_rollup.revisions(rows(("a", 7)), rows(("a", 8), ("c", 2))))
    for _ in range(2):
        rollup.compact()
        assert not rollup.commit("two", token_rollup.inserts(rows(("a", 5))))
        again = token_rollup.TokenRollup(spark, rollup.path)
        assert {(r.source, r.n_docs, r.n_tokens) for r in again.totals().collect()} == {("a", 2, 13), ("b", 1, 1), ("c", 1, 2)}
    rollup.commit("three", token_rollup.deletes(rows(("b", 1))))
    assert {r.source for r in rollup.totals().collect()} == {"a", "c"}


def test_vocabulary_tokens(spark):
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    tokenizer = Tokenizer.from_file(path)
    docs = [(i, t) for i, t in duck_over(SF).execute("SELECT doc_id, text FROM documents").fetchall()] + [(-1, None), (-2, "")]
    found = token_rollup.vocabulary_tokens(spark.createDataFrame(docs, "doc_id long, text string"), path).collect()
    assert {r.doc_id: r.n_tokens for r in found} == {i: len(tokenizer.encode(t or "", add_special_tokens=False).ids) for i, t in docs}


def test_hash_of_kept_text(spark):
    found = line_dedup.op8_line_dedup(spark, SF).first()
    text = dict(duck_over(SF).execute("SELECT doc_id, text FROM documents").fetchall())[found.doc_id]
    if not found.n_dropped:
        assert found.kept_sha256 == hashlib.sha256(text.encode()).hexdigest()
