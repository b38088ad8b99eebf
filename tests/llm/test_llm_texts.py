"""The word arrays and the operators on texts, against plain Python."""

import hashlib
import html
import random
import re
import time
import tracemalloc
import zlib

import numpy as np
import pyarrow as pa
import pytest
from conftest import SF, duck_over, prose
from pyspark.sql import functions as F

from marketlens.llm import decontaminate, html_text, language_id, order_minhash, toxicity
from marketlens.llm.words import ALNUM, NONBLANK, chunks_of, runs_of, words_of

TEXTS = ["", "a", " a  B\tc\n", "É é", "x" * 3000, None, "ab cd " * 700, "\x00\x1f z", "Zz9-你 q"]


@pytest.mark.parametrize("kind,pattern", [(ALNUM, r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"), (NONBLANK, r"[^\x20\x09-\x0D]+")])
@pytest.mark.parametrize("size", [64, 1 << 20])
def test_words(kind, pattern, size, monkeypatch):
    monkeypatch.setattr("marketlens.llm.words.SEGMENT", size)
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    hashes = {}
    for a, b, data, offsets in chunks_of(pa.array(TEXTS), 256):
        w = words_of(data, offsets, kind)
        for t, text in enumerate(TEXTS[a:b]):
            want = re.findall(pattern, (text or "").translate(lower))
            i, j = w.first[t], w.first[t + 1]
            assert [w.text(x, 1, kind.lower).decode() for x in range(i, j)] == want
            for word, h in zip(want, w.hash[i:j].tolist()):
                assert hashes.setdefault(word, h) == h
            assert len(runs_of(w.hash[i:j], 3)) == max(0, len(want) - 2)
    assert len(set(hashes.values())) == len(hashes)


def test_blocks_of_windows_find_the_same(spark, hard):
    docs, bench = (spark.read.parquet(f"{hard}/{t}.parquet") for t in ("documents", "benchmark"))
    whole = decontaminate.find_leaks(docs, bench).select("doc_id", "text", "__n_words", "__spans", "__items", "__n_hit")
    split = decontaminate.find_leaks(docs, bench, max_windows=20).select(*whole.columns)
    assert sorted(map(str, whole.collect())) == sorted(map(str, split.collect()))
    hit = {r.doc_id: r for r in whole.collect()}
    assert hit[1]["__n_hit"] == 120 and hit[1]["__items"] == ["1", "null"] and hit[7]["__items"] == ["4"] and hit[31]["__n_hit"] == 40
    assert hit[9]["__n_hit"] == 1 and hit[40]["__n_hit"] == 0


def test_removing_spans_and_documents(spark):
    item = prose(5, 12)
    docs = spark.createDataFrame([(1, f"É before {item.upper()} after"), (2, "clean"), (3, None)], "doc_id long, text string")
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    assert {r.doc_id: r.text for r in decontaminate.remove_leaks(docs, bench, mode="spans").collect()} == {
        1: "É before \n after", 2: "clean", 3: None}
    assert sorted(r.doc_id for r in decontaminate.remove_leaks(docs, bench).collect()) == [2, 3]


def test_pages_equal_their_articles(spark):
    want = {}
    for page_id, page in duck_over(SF).execute("SELECT page_id, html FROM pages").fetchall():
        article = re.search(r"<article>(.*)</article>", page, re.S)[1]
        want[page_id] = " ".join(html.unescape(re.sub(r"<[^>]*>", " ", re.sub(r"</?b>", "", article))).split())
    found = html_text.op1_html_text(spark, SF).collect()
    assert {r.page_id: r.text for r in found} == want and all(r.n_chars == len(r.text) for r in found)


def test_regions_outside_the_article():
    page = """<html><body class="has-sidebar"><header><h1>Site</h1></header><div class="cookie-notice">Cookies</div>
    <main><article><header><h1>Title &amp; more</h1></header><p>One<br>two <b>bo</b>ld&nbsp;x.</p><!-- no -->
    <form><label>Email</label></form><aside>side</aside><script>var p = "<p>";</script><p>Last &#233;</article>
    <section class="comments"><article class="comment"><p>First!</p></article></section></main>
    <div id="sidebar"><p>Links</p></div><footer>f</footer></body></html>"""
    assert html_text.main_text(page, frozenset()) == "Title & more One two bold x. Last é"


@pytest.mark.parametrize("page", [
    "<div class='page has-comments'><article><p>{}</p></article></div>", "<article class='post comments-open'><p>{}</p></article>",
    "<div class='content ad-free'><p>{}</p></div>", "<div class='social-science'><p>{}</p></div>",
    "<article><p>A</p><div class='social-science'><p>{}</p></div></article>",
    "<article><p>{}</p><div class='alert'><p>B</p></div><div id='form-of-government'><p>C</p></div></article>"])
def test_one_piece_of_a_name_loses_no_article(page):
    rest = "<div class='comments'><p>First!</p></div><div class='share-links'>Share</div>"
    want = re.sub("<[^>]*>", " ", page).format(prose(4, 30)).split()
    assert html_text.main_text(page.format(prose(4, 30)) + rest, frozenset()).split() == want


def test_names_keep_comments_out():
    comments = "<article class='comment'><p>First comment!</p></article>" * 40
    page = f"<main><article><p>Short article.</p><div class='share-links'>Share</div></article><div class='comments'>{comments}</div></main>"
    assert html_text.main_text(page, frozenset()) == "Short article."


@pytest.mark.parametrize("between", [
    "<svg class='i'/>", "<math/>", "<object-list></object-list>", "<select-box>", "<template-part/>", "<noscript>", "<object>",
    "<select>", "<svg>gone</svg>", "<script>var p = '<p>';</script>", "<TITLE>gone</title>"])
def test_raw_elements_end_where_they_end(between):
    assert html_text.main_text(f"<p>one</p>{between}<p>two</p>", frozenset()) == "one two"


def test_unclosed_elements_take_linear_time():
    assert html_text.main_text("<object><p>x</p>" * 20_000 + "<script>rest", frozenset()).count("x") == 20_000


def test_deep_and_unmatched_tags_take_linear_time():
    start, text = time.process_time(), "<p>one</p>"
    pages = ("<b>x</i>" * 40_000 + text, "<div>" * 100_000 + text, "<p><div>" + "<b>" * 40_000 + "<p></p>" * 40_000 + text)
    assert [html_text.main_text(p, frozenset()).count("one") for p in pages] == [1, 1, 1]
    assert time.process_time() - start < 6
    tracemalloc.start()
    html_text.parse(pages[1])
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 100e6


@pytest.mark.parametrize("n", [4, 12])
def test_template_alone_finds_the_article(spark, n):
    """A host without article elements or telling names; the article may be the shorter part of the page."""
    menu = "<div>Home</div><div>World news</div><div>Weather and traffic</div>"
    notice = "<div>" + prose(900, 60) + "</div>"
    want = {i: f"Headline number {i} {prose(i, 8 if i % 2 else 80)}" for i in range(n)}
    pages = [(i, f"http://plain.example/{i}", f"<html><body>{menu}<div><div>Headline number {i}</div><p>{prose(i, 8 if i % 2 else 80)}"
              f"</p></div>{notice}</body></html>") for i in range(n)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    assert {r.page_id: r.text for r in html_text.extract(df).collect()} == want
    assert all(html_text.main_text(p, frozenset()) != want[i] for i, _, p in pages)


def test_template_text_goes_and_copies_stay(spark, hard):
    found = {r.page_id: r.text for r in html_text.op1_html_text(spark, hard).collect()}
    assert found[3] == f"T3 {prose(3, 30)}"  # "Share this" is on every page of the host
    assert found[102] == "no article at & all" and found[100] == found[101] == "" and len(found[103].split()) == 50_000
    same = [(i, f"http://c.example/{i}", "<article><p>All pages say just this</p></article>") for i in range(12)]
    pages = spark.createDataFrame(same, "page_id long, url string, html string")
    assert {r.text for r in html_text.extract(pages).collect()} == {"All pages say just this"}


def test_occurrence_classes_do_not_depend_on_partitions(spark, hard):
    pages = spark.read.parquet(f"{hard}/pages.parquet").where("html is not null and page_id < 12").select(
        F.lit("h").alias("__host"), F.xxhash64("page_id").alias("__page"), F.col("html").alias("__html"))
    one, many = (sorted(html_text.host_templates(p).first()["__fixed"]) for p in (pages.coalesce(1), pages.repartition(7)))
    assert one == many and one


def test_nested_classes():
    def named(support, *places):
        return {"support": support, "tokens": [{"token": p, "place": float(p), "text": True} for p in places]}

    root, inner, crossing = named(9, 1, 10, 20), named(8, 12, 15), named(7, 14, 17)
    assert html_text.nested([crossing, inner, root]) == [root, inner]


def test_languages_of_held_out_documents(spark):
    sf = SF.replace("0.001", "0.01")
    truth = dict(duck_over(sf).execute("SELECT doc_id, lang FROM documents").fetchall())
    found = language_id.op5_language_id(spark, sf).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 for r in found)
    held = [r for r in found if r.held_out]
    assert sum(r.lang_pred == truth[r.doc_id] for r in held) >= 0.98 * len(held)


def test_undetermined(spark, hard):
    found = {r.doc_id: r for r in language_id.op5_language_id(spark, hard).collect()}
    assert all(found[i].lang_pred == "und" and found[i].score == 0 for i in (4, 5, 6, 10)) and found[1].lang_pred != "und"


def test_presence_of_pieces_is_presence_of_the_text(monkeypatch):
    text = prose(4, 400) + " Été 123 " + prose(5, 300)
    whole, pieces = np.zeros(language_id.BUCKETS), np.zeros(language_id.BUCKETS)
    language_id.presence(text, whole)
    monkeypatch.setattr(language_id, "PIECE", 100)
    language_id.presence(text, pieces)
    assert (whole == pieces).all() and whole.sum() > 100


def test_toxicity_of_held_out_documents(spark, tmp_path):
    r = random.Random(1)
    rows, labels = [], []
    for i in range(1200):
        words = prose(i, 60).split()
        if bad := i % 6 == 0:
            words[r.randrange(60)] = r.choice(("vilewordo", "vilewordan", "badterm"))
        rows.append((i, " ".join(words)))
        labels.append((i, 1, int(bad)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    model = toxicity.fit(docs, marks.where("doc_id < 900"))
    scores = {x.doc_id: x["__score"] for x in model.score(docs).collect()}
    assert all((scores[i] >= 0.3) == (i % 6 == 0) for i in range(900, 1200))


def test_features():
    lexicon = frozenset(["clown", "lowe-"])
    plain, none = toxicity.features("You silly CLOWN!", lexicon), toxicity.features(None, lexicon)
    assert plain[0] == pytest.approx(100 / 3) and plain[2] == 1 and plain[5] > 0 and plain[7] > 0.4 and none == [0.0] * toxicity.FEATURES
    assert toxicity.features("c.l.0.w.n", lexicon)[3] > 0 and toxicity.features("loweichen", lexicon)[2] == 1


def literal_order_minhash(sketch, text):
    """The definition, k-mer by k-mer."""
    kmers = sketch.kmers(text).tolist()
    seen, numbered = {}, []
    for h in kmers:
        numbered.append((h, seen.setdefault(h, 0)))
        seen[h] += 1
    values = order_minhash.mixed(np.array([h for h, _ in numbered], np.uint64)
                                 + np.array([c for _, c in numbered], np.uint64) * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(32)
    parts = []
    for flip, factor in zip(sketch.flip[:, 0].tolist(), sketch.factor[:, 0].tolist()):
        order = sorted(range(len(values)), key=lambda i: (((int(values[i]) ^ flip) * factor) % 2**32, i))
        parts.append(tuple(kmers[i] for i in sorted(order[:sketch.pick])))
    return parts


def test_order_minhash_is_its_definition(monkeypatch):
    sketch = order_minhash.OrderMinHash(sketches=16)
    texts = ["a", "abcdef", "abcabcabcabc" * 4, prose(1, 50), prose(1, 25) + " " + prose(2, 25)]
    literal = [literal_order_minhash(sketch, t) for t in texts]
    for block in (7, 1 << 14):
        monkeypatch.setattr(order_minhash, "BLOCK", block)
        prints = [sketch.fingerprint(t) for t in texts]
        for i, a in enumerate(texts):
            for j, b in enumerate(texts):
                same = [x == y for x, y in zip(literal[i], literal[j])]
                assert order_minhash.likeness(prints[i], prints[j]) == pytest.approx(sum(same) / 16)


def test_edited_texts(spark, hard):
    docs = duck_over(hard).execute("SELECT doc_id, coalesce(text, '') FROM documents WHERE doc_id IS NOT NULL").fetchall()
    unique = sorted(set(docs), key=lambda r: -r[0])
    found = order_minhash.fingerprints(spark.createDataFrame(unique, "doc_id long, text string").repartition(5), ranges=7).collect()
    assert len(found) == len(unique)
    rows = {r.doc_id: r for r in found}
    for (i, text), (_, following) in zip(unique, unique[1:] + unique[:1]):
        half = len(text) // 2
        edited = text[:len(text) - half] + following[:half]
        assert rows[i].n_chars == len(text) and rows[i].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert 0 <= rows[i].near_edited <= 1 and (edited != text or rows[i].near_edited == 1)
    assert rows[1].fingerprint == rows[2].fingerprint and rows[7].fingerprint != rows[8].fingerprint


def test_neighbours_with_ties_and_null_ids(spark, hard):
    docs = spark.read.parquet(f"{hard}/documents.parquet")
    for ranges in (1, 3, 50):
        assert order_minhash.fingerprints(docs, ranges=ranges).count() == docs.count()


def _next_of(rows):
    """Literal reading: the next text of every row in descending order of id, nulls last, equal ids by hash of the text."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[2]), reverse=True)
    return sorted((r[0] is not None, r[0] or 0, r[1], n[1]) for r, n in zip(rows, rows[1:] + rows[:1]))


@pytest.mark.parametrize("ids", ["one id", "no id", "a third", "all"])
def test_rows_of_one_id_span_ranges(spark, ids):
    doc = {"one id": lambda i: 7, "no id": lambda i: None, "a third": lambda i: None if i % 3 == 0 else 7 if i % 3 == 1 else i,
           "all": lambda i: (1 << 62) + i}[ids]
    docs = spark.createDataFrame([(doc(i), f"text number {i % 290}") for i in range(300)], "doc_id long, text string").repartition(4)

    def pairs(triples):
        found = list(triples)
        if found:
            yield pa.RecordBatch.from_arrays([pa.array([f[0] for f in found], pa.int64()), pa.array([f[1] for f in found]),
                                              pa.array([f[2] for f in found]), pa.array([len(found)] * len(found), pa.int64())],
                                             names=["doc", "text", "following", "n"])

    got = order_minhash.with_next(docs, "doc_id", "text", 6, pairs, "doc long, text string, following string, n long").collect()
    rows = [tuple(r) for r in docs.select("doc_id", "text", F.xxhash64("text")).collect()]
    assert sorted((r.doc is not None, r.doc or 0, r.text, r.following) for r in got) == _next_of(rows)
    assert max(r.n for r in got) <= 150
