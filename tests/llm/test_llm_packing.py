"""Packing, against the tokenizer on whole texts and an account of every token."""

import os
import random
import sys
import zlib

import numpy as np
import pyarrow as pa
import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import public_tokenizers  # noqa: E402
from tokenizers import Tokenizer  # noqa: E402

from conftest import SF, prose, write_tables  # noqa: E402
from marketlens.llm import packing  # noqa: E402

PATH = public_tokenizers.path(packing.TOKENIZER)
ODD = ["", None, "a b", " lead x  y trail ", "it's don't 'S 'll we'RE", "<|endoftext|>x <|STARTOFTEXT|> < <|endoftext|>", "ΑΣ. ΑΣ.Β ΑΣ",
       "É é é ≠ ≠ İİ ŉ ẞß ×÷ a×b Ā̄", "\x1c\x1da\x1eb \x85z y\xa0q", "“q”.\" ”", "\U0001F44D\U0001F3FD你好 12345 a1b2 １２",
       "no_white-space,at.all;" * 30, "Über-Öl, naïve café: 3.14!", "\x00\x7f", "''s s' 's's", "co­op"]


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


def whole_ids(tokenizer, text):
    return tokenizer.encode(text or "", add_special_tokens=False).ids + [packing.END]


@pytest.mark.parametrize("segment", [7, 64, 1 << 22])
def test_ids_are_the_tokenizers_ids_of_whole_texts(monkeypatch, tokenizer, segment):
    monkeypatch.setattr(packing, "SEGMENT", segment)
    r = random.Random(1)
    chars = "aZ9é'<|>.,- \n\t\x0b́ßİ×Σσ你\U0001F600\x1f "
    texts = ODD + ["".join(r.choice(chars) for _ in range(r.randrange(60))) for _ in range(400)] + [prose(1, 3000)]
    encoder = packing.Encoder(PATH)
    assert encoder.by_words
    for _ in range(2):  # with an empty cache, and with a full one
        found = [None] * len(texts)
        for a, b, ids, bounds in encoder.encode(pa.array(texts), packing.END):
            found[a:b] = [ids[x:y].tolist() for x, y in zip(bounds, bounds[1:])]
        for text, ids in zip(texts, found):
            assert ids == whole_ids(tokenizer, text), repr(text)


def test_other_tokenizers_encode_whole_texts():
    path = public_tokenizers.path("byte_bpe_50k.json")
    texts = [x for x in ODD]
    (a, b, ids, bounds), = packing.Encoder(path).encode(pa.array(texts), 5)
    other = Tokenizer.from_file(path)
    assert [ids[x:y].tolist() for x, y in zip(bounds, bounds[1:])] == [other.encode(t or "", add_special_tokens=False).ids + [5] for t in texts]


def test_phases_serve_every_token_once():
    r = random.Random(3)
    for trial in range(300):
        window, sizes = r.choice([1, 4, 16, 64]), {f"s{i}": r.randrange(1, 400) for i in range(r.randrange(1, 7))}
        weights = sizes if trial % 2 else {s: r.randrange(1, 9) for s in sizes}
        total, seen, lengths = sum(sizes.values()), set(), {}
        for s, own in packing.phases(sizes, weights).items():
            cutter, at = packing.Cutter(own, total, window), 0
            while at < sizes[s]:
                n = min(sizes[s] - at, r.randrange(1, 30))
                for begin, length, number, offset in cutter.cut(at, at + n):
                    assert begin == at and length > 0
                    at, n = at + length, n - length
                    seen |= {(number, x) for x in range(offset, offset + length)}
                    lengths[number] = max(lengths.get(number, 0), offset + length)
                assert n == 0
        assert len(seen) == total == sum(lengths.values())
        assert sorted(lengths) == list(range(len(lengths)))
        assert all(n == window for k, n in lengths.items() if k < total // window)
        assert all(n & (n - 1) == 0 and n < window for k, n in lengths.items() if k >= total // window)


def test_windows_hold_the_target_mixture():
    """Deficits stay below a token for every halving of the round, at every window and until a queue is empty."""
    sizes, weights = {"a": 50_000, "b": 9_000, "c": 30_000, None: 12_345}, {"a": 5, "b": 2, "c": 1, None: 5}
    own = packing.phases(sizes, weights)
    first = min(p[0].length for p in own.values())
    for k in range(first // 4096):
        for s, (phase, *_) in own.items():
            assert abs(phase.served(4096 * k)[0] - 4096 * k * weights[s] / 13) <= 2
    assert min(sizes[s] - p[0].served(first)[0] for s, p in own.items()) == 0


def account(rows, docs, tokenizer):
    """Asserts the contract of the pieces of (doc_id, text); the length of every sequence."""
    pieces, sequences = {}, {}
    for r in rows:
        pieces.setdefault(r.doc_id, []).append(r)
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert set(pieces) == set(docs)
    for doc, text in docs.items():
        ids, at = np.array(whole_ids(tokenizer, text), "<u4"), 0
        for r in sorted(pieces[doc], key=lambda r: r.start):
            assert r.start == at and r.length > 0 and r.doc_tokens == len(ids)
            assert r.ids_crc32 == zlib.crc32(ids[at:at + r.length].tobytes())
            at += r.length
        assert at == len(ids)
    for spans in sequences.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
    return {k: sum(n for _, n in spans) for k, spans in sequences.items()}


def test_query_packs_every_token_of_every_document(spark, tokenizer):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "source").collect()
    rows = packing.op13_pack(spark, SF).collect()
    lengths = account(rows, {d.doc_id: d.text for d in docs}, tokenizer)
    total = sum(lengths.values())
    assert sum(n == 4096 for n in lengths.values()) >= total // 4096
    assert all(n == 4096 or n & (n - 1) == 0 for n in lengths.values())
    source, sizes, seen = {d.doc_id: d.source for d in docs}, {}, {}
    for r in rows:
        sizes[source[r.doc_id]] = sizes.get(source[r.doc_id], 0) + r.length
        seen[r.sequence_id, source[r.doc_id]] = seen.get((r.sequence_id, source[r.doc_id]), 0) + r.length
    for k in range(total // 4096):
        for s, n in sizes.items():
            assert abs(seen.get((k, s), 0) - 4096 * n / total) <= 2 * len(sizes).bit_length()


def test_weights_null_and_hot_sources(spark, tokenizer, tmp_path):
    texts = ODD + [prose(i, 200) for i in range(30)]
    docs = [(i, t, "en", ("hot", "hot", None, "rare")[i % 4] if i < 40 else "hot", 1) for i, t in enumerate(texts)]
    folder = write_tables(tmp_path, True, documents=docs)
    frame = spark.read.parquet(f"{folder}/documents.parquet").repartition(5)
    tokens = packing.tokenized(frame, PATH, ["doc_id"])
    for weights in (None, {"hot": 1, None: 7}):
        lengths = account(packing.pack(tokens, ["doc_id"], weights, window=256).collect(), {d[0]: d[1] for d in docs}, tokenizer)
        assert all(n == 256 or n & (n - 1) == 0 for n in lengths.values())
    with pytest.raises(ValueError):
        packing.pack(tokens, ["doc_id"], window=100)
