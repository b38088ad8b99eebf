"""Benchmark decontamination by word n-grams.

Benchmark texts become a hash set of windows: ``n`` consecutive normalised
words, or the whole item where it is shorter.  The set is broadcast to a scan
of all training texts; a word window whose hash is in the set is compared
word by word before it counts, and every word inside an occurrence is hit.

The broadcast is bounded: at most ``MAX_WINDOWS`` windows go out at a time.  A
larger benchmark is split into blocks, each scanned against all documents, and
the blocks' hits are united per document.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketlens.llm.shared import any_names, stored, table
from marketlens.llm.words import ALNUM, chunks_of, runs_of, words_of

WINDOW = 10
MAX_WINDOWS = 200_000
FILTER_BITS = 22


def _windows(n: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            items, lengths, hashes, texts = [], [], [], []
            names = batch.column(0).to_pylist()
            for a, _, data, offsets in chunks_of(batch.column(1)):
                w = words_of(data, offsets, ALNUM)
                for t in range(len(offsets) - 1):
                    i, j = int(w.first[t]), int(w.first[t + 1])
                    k = min(n, j - i)
                    for x, h in enumerate(runs_of(w.hash[i:j], k) if k else ()):
                        items.append(names[a + t])
                        lengths.append(k)
                        hashes.append(int(h.astype(np.int64)))
                        texts.append(w.text(i + x, k, ALNUM.lower))
            yield pa.RecordBatch.from_arrays([pa.array(items, pa.string()), pa.array(lengths, pa.int32()),
                                              pa.array(hashes, pa.int64()), pa.array(texts, pa.binary())],
                                             names=["__item", "__len", "__hash", "__words"])
    return run


def benchmark_windows(benchmark: DataFrame, item_id: str = "item_id", text: str = "text",
                      n: int = WINDOW) -> DataFrame:
    """(__item, __len, __hash, __words) of every window; a null id reads "null"."""
    items = benchmark.select(F.coalesce(F.col(item_id).cast("string"), F.lit("null")).alias("i"),
                             F.col(text).cast("string").alias("t"))
    found = items.mapInArrow(_windows(n), "__item string, __len int, __hash long, __words binary")
    return found.distinct()


class _Block:
    """Windows by length: sorted hashes, a bit filter, and hash -> {words: items}."""

    def __init__(self, rows: pa.Table):
        self.by_length: dict[int, dict[int, dict[bytes, list[str]]]] = {}
        for item, k, h, words in zip(*(rows.column(c).to_pylist() for c in ("__item", "__len", "__hash", "__words"))):
            self.by_length.setdefault(k, {}).setdefault(h & (2**64 - 1), {}).setdefault(words, []).append(item)
        self.filters = {}
        for k, found in self.by_length.items():
            self.filters[k] = np.zeros(1 << FILTER_BITS, bool)
            self.filters[k][np.fromiter(found, np.uint64, len(found)) >> np.uint64(64 - FILTER_BITS)] = True


def _scan(block, column: int, keep: list[int], schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from bisect import bisect_right

        known = block.value
        for batch in batches:
            n_words, spans, found_items = [], [], []
            for _, _, data, offsets in chunks_of(batch.column(column)):
                w = words_of(data, offsets, ALNUM)
                counts = np.diff(w.first)
                mine: dict[int, tuple[list, set]] = {}
                for k, found in known.by_length.items():
                    hashes = runs_of(w.hash, k)
                    for i in np.flatnonzero(known.filters[k][hashes >> np.uint64(64 - FILTER_BITS)]).tolist():
                        if (texts := found.get(int(hashes[i]))) is None:
                            continue
                        t = bisect_right(w.first, i) - 1
                        if i + k > w.first[t + 1] or (items := texts.get(w.text(i, k, ALNUM.lower))) is None:
                            continue
                        runs, names = mine.setdefault(t, ([], set()))
                        runs.append((i, i + k))
                        names.update(items)
                n_words += counts.tolist()
                for t in range(len(counts)):
                    runs, names = mine.get(t, ((), ()))
                    united: list[list[int]] = []
                    for i, j in sorted(runs):
                        if united and i <= united[-1][1]:
                            united[-1][1] = max(united[-1][1], j)
                        else:
                            united.append([i, j])
                    at = int(w.first[t])
                    spans.append([{"first_word": i - at, "last_word": j - 1 - at,
                                   "start_byte": int(w.start[i] - offsets[t]), "end_byte": int(w.end[j - 1] - offsets[t])}
                                  for i, j in united])
                    found_items.append(sorted(names))
            columns = [batch.column(c) for c in keep] + [pa.array(n_words, pa.int64()),
                                                         pa.array(spans, schema.field("__spans").type),
                                                         pa.array(found_items, pa.list_(pa.string()))]
            yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, schema)], schema=schema)
    return run


SPANS = "array<struct<first_word:int,last_word:int,start_byte:long,end_byte:long>>"


def _hits(docs: DataFrame, text: str, block, keep_text: bool) -> DataFrame:
    from pyspark.sql.pandas.types import to_arrow_schema

    kept = [c for c in docs.columns if keep_text or c != text]
    found = T._parse_datatype_string(f"__n_words long, __spans {SPANS}, __items array<string>")
    schema = T.StructType([docs.schema[c] for c in kept] + found.fields)
    arrow = to_arrow_schema(schema)
    return docs.mapInArrow(_scan(block, docs.columns.index(text), [docs.columns.index(c) for c in kept], arrow), schema)


@any_names
def find_leaks(docs: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id",
               item_text: str = "text", n: int = WINDOW, max_windows: int = MAX_WINDOWS,
               keep_text: bool = True) -> DataFrame:
    """Every row of ``docs`` with ``__n_words``, ``__spans`` (merged runs of hit words, with their place in
    words and in UTF-8 bytes), ``__n_hit`` and ``__items`` (sorted ids of the items found).

    Null and empty texts and texts without words have no words and no hits; so has an empty benchmark.  Items
    without words have no window.  Repeated rows are each reported.  Columns of ``docs`` are passed on.
    """
    spark = docs.sparkSession
    windows = stored(benchmark_windows(benchmark, item_id, item_text, n), "benchmark-windows")
    blocks = max(1, -(-windows.count() // max_windows))
    part = F.pmod(F.xxhash64("__hash", "__item"), F.lit(blocks))

    def sent(k: int):
        return spark.sparkContext.broadcast(_Block(windows.where(part == k).toArrow()))

    if blocks == 1:
        found = _hits(docs, text, sent(0), keep_text)
    else:  # a scan for each block; rows are named by a hash of all their columns, equal rows have equal hits
        named = docs.withColumn("__row", F.xxhash64(*docs.columns))
        pieces = None
        for k in range(blocks):
            piece = _hits(named.select("__row", text), text, sent(k), False).where(F.size("__spans") > 0)
            piece = stored(piece.distinct(), f"leaks-{k}")
            pieces = piece if pieces is None else pieces.unionByName(piece)
        united = (pieces.groupBy("__row").agg(F.flatten(F.collect_list("__spans")).alias("__spans"),
                                              F.array_sort(F.array_distinct(F.flatten(F.collect_list("__items")))).alias("__items"))
                  .withColumn("__spans", _united(F.col("__spans"))))
        counted = _hits(named, text, spark.sparkContext.broadcast(_Block(windows.limit(0).toArrow())), keep_text)
        found = (counted.drop("__spans", "__items").join(united, "__row", "left").drop("__row")
                 .withColumn("__spans", F.coalesce("__spans", F.array().cast(SPANS)))
                 .withColumn("__items", F.coalesce("__items", F.array().cast("array<string>"))))
    hit = F.aggregate("__spans", F.lit(0).cast("long"), lambda s, x: s + x.last_word - x.first_word + 1)
    return found.withColumn("__n_hit", hit)


def _united(spans):
    """Overlapping and touching spans as one, in order."""
    def add(done, x):
        last = F.try_element_at(done, F.lit(-1))
        longer = F.struct(last.first_word.alias("first_word"), F.greatest(last.last_word, x.last_word).alias("last_word"),
                          last.start_byte.alias("start_byte"), F.greatest(last.end_byte, x.end_byte).alias("end_byte"))
        before = F.slice(done, F.lit(1), F.greatest(F.size(done) - 1, F.lit(0)))
        return F.when(x.first_word <= last.last_word + 1, F.concat(before, F.array(longer))).otherwise(
            F.concat(done, F.array(x)))
    return F.aggregate(F.array_sort(spans), F.array().cast(SPANS), add)


@any_names
def remove_leaks(docs: DataFrame, benchmark: DataFrame, text: str = "text", mode: str = "documents",
                 **options) -> DataFrame:
    """``mode="documents"``: the rows without any hit.  ``mode="spans"``: all rows, the hit spans cut out of
    their texts (from the first hit word to the last, a line break in their place).  Same columns as ``docs``.
    """
    found = find_leaks(docs, benchmark, text, **options)
    if mode == "documents":
        return found.where(F.col("__n_hit") == 0).select(*docs.columns)
    raw = F.encode(F.col(text), "UTF-8")
    starts = F.concat(F.array(F.lit(0).cast("long")), F.transform("__spans", lambda s: s.end_byte))
    ends = F.concat(F.transform("__spans", lambda s: s.start_byte), F.array(F.octet_length(raw).cast("long")))
    pieces = F.transform(F.arrays_zip(starts.alias("a"), ends.alias("b")),
                         lambda p: F.decode(F.substring(raw, (p.a + 1).cast("int"), (p.b - p.a).cast("int")), "UTF-8"))
    cut = F.when(F.size("__spans") > 0, F.array_join(pieces, "\n")).otherwise(F.col(text))
    return found.withColumn(text, cut).select(*docs.columns)


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark windows found in every whole document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = find_leaks(docs, table(spark, sf_dir, "benchmark"), keep_text=False)
    return found.select("doc_id", F.col("__n_words").alias("n_words"), F.col("__n_hit").alias("n_hit"),
                        F.size("__items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("__items", ","), 256).alias("items_sha256"),
                        (F.col("__n_hit") > 0).alias("contaminated"))


OP4_SQL = r"""
WITH w AS (
  SELECT doc_id, ws, len(ws) AS n FROM (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents)),
b AS (
  SELECT item_id, ws, least(10, len(ws)) AS k FROM (
    SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                       '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark) WHERE len(ws) > 0),
g AS (
  SELECT DISTINCT item_id, k, array_to_string(ws[i:i + k - 1], ' ') AS g
  FROM (SELECT item_id, ws, k, unnest(range(1, len(ws) - k + 2)) AS i FROM b)),
p AS (
  SELECT doc_id, k, i, array_to_string(ws[i:i + k - 1], ' ') AS g
  FROM (SELECT doc_id, ws, k, unnest(range(1, n - k + 2)) AS i FROM w, (SELECT DISTINCT k FROM b) WHERE n >= k)),
h AS (SELECT p.doc_id, p.i, p.k, g.item_id FROM p JOIN g ON p.k = g.k AND p.g = g.g),
hw AS (SELECT doc_id, count(DISTINCT j) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + k)) AS j FROM h) GROUP BY doc_id),
hi AS (SELECT doc_id, count(*) AS n_items, string_agg(x, ',' ORDER BY x) AS items
       FROM (SELECT DISTINCT doc_id, coalesce(item_id::VARCHAR, 'null') AS x FROM h) GROUP BY doc_id)
SELECT w.doc_id, n::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM w LEFT JOIN hw USING (doc_id) LEFT JOIN hi USING (doc_id)
"""
