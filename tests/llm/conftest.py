import os
import random

import duckdb
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

SF = "/root/testdata/sf0.001"
TABLES = ("documents", "pages", "benchmark", "labels", "conversations")
SCHEMAS = {
    "documents": {"doc_id": pa.int64(), "text": pa.string(), "lang": pa.string(), "source": pa.string(), "n_chars": pa.int64()},
    "benchmark": {"item_id": pa.int64(), "text": pa.string()},
    "labels": {"doc_id": pa.int64(), "quality": pa.int32(), "toxic": pa.int32()},
    "pages": {"page_id": pa.int64(), "url": pa.string(), "html": pa.string()},
    "conversations": {"conv_id": pa.int64(), "turn": pa.int64(), "role": pa.string(), "text": pa.string()},
}
WORDS = "the of and to in is it as for on with at by from that this be are was an".split()
#: Names that the operators' own outputs and inputs have, as further columns of the input.
CLASHES = ("score", "size", "target", "taken", "kept", "key", "rank", "n_words", "component_id", "text_hash", "a", "b", "u", "v", "n")


def duck_over(folder):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{folder}/{t}.parquet')")
    return con


def write_tables(folder, clashes=False, **tables):
    """The five tables under ``folder``; those not given are empty."""
    for name, schema in SCHEMAS.items():
        rows = tables.get(name, [])
        columns = {c: pa.array([r[i] for r in rows], t) for i, (c, t) in enumerate(schema.items())}
        if clashes:
            columns |= {c: pa.array(["x"] * len(rows), pa.string()) for c in CLASHES if c not in columns}
        pq.write_table(pa.table(columns), os.path.join(folder, f"{name}.parquet"))
    return str(folder)


def prose(seed, n):
    r = random.Random(seed)
    return " ".join(r.choice(WORDS) + str(r.randrange(60)) for _ in range(n))


def hard_documents():
    """Nulls in every column, empty and very long texts, ties, repeated rows, near copies, odd white space."""
    base = prose(1, 120)
    words = base.split()
    line = "a line that many documents share, with more than forty characters"
    rows = [
        (1, base, "en", "a", 1), (2, base, "en", "a", 1), (2, base, "en", "a", 1),
        (3, " ".join(words[:60] + ["other"] + words[61:]), "en", "b", 1),
        (4, None, "en", "a", None), (5, "", None, None, 0), (6, " \t\n\x0b\x0c\r ", "de", "c", 3),
        (7, "one", "fr", "b", 3), (8, "ONE", "fr", "b", 3), (9, "one two", None, "b", 3),
        (None, base, "en", "a", 1), (None, None, None, None, None), (None, "alone here", "en", None, 2),
        (10, "%%% 123 !!!", "en", "a", 1), (11, prose(2, 30_000), "de", "c", 9),
        (12, "word" * 60_000, "es", "c", 9), (13, "Été \U0001F600 naïve 你好", "fr", "\U0001F600", 9),
        (14, "x\n\n\ny", "es", "￿", 4),
    ]
    for i in range(20, 28):
        rows.append((i, f"{prose(i, 15)}\n  {line.upper() if i % 2 else line}\t\n{line}\n{prose(i + 50, 9)}", "en", "a", 5))
    for i in range(30, 60):
        rows.append((i, prose(i, 40), ("en", "de", "fr", "es")[i % 4], ("a", "b", None)[i % 3], 5))
    return rows


@pytest.fixture(scope="session")
def hard(tmp_path_factory):
    docs = hard_documents()
    bench = [(1, " ".join(docs[0][1].split()[5:25])), (2, None), (3, ""), (4, "One"), (None, docs[0][1]), (5, "..."),
             (1, " ".join(docs[0][1].split()[5:25])), (10, prose(31, 40))]
    labels = [(i, i % 2, int(i % 5 == 0)) for i in range(1, 60)] + [(3, None, None), (None, 1, 1), (4, 1, 1), (4, 1, 1)]
    convs = [(1, 0, "user", "hi"), (1, 1, "assistant", "yo"), (2, 0, "user", "hi"), (3, 0, "user", "hi"), (3, 1, "assistant", "yo"),
             (3, 2, "user", "more"), (4, 5, "user", "hi"), (4, 9, "assistant", "yo"), (5, 0, None, None), (6, 0, "user", ""),
             (6, 0, "user", ""), (6, None, "user", "late"), (None, 0, "user", "nobody"), (7, 0, "user", prose(3, 20_000)),
             (8, 0, "user", "hi"), (8, 1, "assistant", "yo"), (8, 2, "user", "more")]
    page = "<html><body><nav>Menu here</nav><article><h1>T{0}</h1><p>{1}</p><p>Share this</p></article><div class='ad'>Buy {0}</div></body></html>"
    pages = [(i, f"http://h.example/{i}", page.format(i, prose(i, 30))) for i in range(12)]
    pages += [(100, None, None), (101, "not a url", ""), (None, "http://h.example/n", page.format("n", "null id")),
              (102, "http://h.example/x", "<p>no article <b>at &amp; all"), (102, "http://h.example/x", "<p>no article <b>at &amp; all"),
              (103, "http://other.example", "<article>" + prose(9, 50_000) + "</article>"), (104, "http://bad.example", "< <a <<p x='>1</p>")]
    return write_tables(tmp_path_factory.mktemp("hard"), True, documents=docs, benchmark=bench, labels=labels,
                        conversations=convs, pages=pages)


@pytest.fixture(scope="session")
def empty(tmp_path_factory):
    return write_tables(tmp_path_factory.mktemp("empty"))
