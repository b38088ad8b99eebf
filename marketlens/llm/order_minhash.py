"""Document fingerprints by Order MinHash.

A text's k-mers of code points are numbered by occurrence, so a repeated k-mer
counts as often as it occurs.  Each of ``sketches`` hash functions selects the
``pick`` numbered k-mers of least hash; these, in text order, make a tuple
whose hash is one part of the fingerprint.  Two texts agree in a part if both
the k-mers and their order agree, so the share of equal parts falls with edit
distance, moves included.

``with_next`` pairs every row with the next one in a total order without a
global sort in one task: sampled places in that order cut the rows into
ranges, each range is sorted by itself, and the first row of the following
range is handed to it as a guest.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlens.llm.shared import any_names, table
from marketlens.llm.words import U, mixed

K = 5
SKETCHES = 64
PICK = 2
BLOCK = 1 << 14
ROWS = 1 << 16
U32 = np.uint32


class OrderMinHash:
    """Fingerprints of texts; the same settings give the same fingerprints anywhere."""

    def __init__(self, k: int = K, sketches: int = SKETCHES, pick: int = PICK):
        self.k, self.sketches, self.pick = k, sketches, pick
        r = np.random.default_rng(23)
        self.flip = r.integers(0, 1 << 32, sketches, dtype=np.uint32)[:, None]
        self.factor = (r.integers(0, 1 << 31, sketches, dtype=np.uint32) * U32(2) + U32(1))[:, None]

    def kmers(self, text: str) -> np.ndarray:
        """Hash of the k-mer at each position; a text of fewer than k code points is one k-mer."""
        points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
        k = min(self.k, len(points))
        out = np.full(max(0, len(points) - k + 1) if k else 0, k, np.uint64)
        for j in range(k):
            out = out * U(0x9E3779B97F4A7C15) + points[j:j + len(out)]
        return mixed(out)

    @staticmethod
    def numbered(kmers: np.ndarray) -> np.ndarray:
        """Each k-mer's hash combined with how many equal ones stand before it."""
        n = len(kmers)
        bits = U(max(1, n.bit_length()))
        order = np.sort(kmers >> bits << bits | np.arange(n, dtype=np.uint64))
        at = (order & ((U(1) << bits) - U(1))).astype(np.int64)
        kind = order >> bits
        new = np.empty(n, bool)
        new[:1] = True
        new[1:] = kind[1:] != kind[:-1]
        firsts = np.flatnonzero(new)
        count = np.empty(n, np.uint64)
        count[at] = np.arange(n) - np.repeat(firsts, np.diff(np.append(firsts, n)))
        return mixed(kmers + count * U(0xD6E8FEB86659FD93))

    def _least(self, narrow: np.ndarray, pick: int) -> tuple[np.ndarray, np.ndarray]:
        """Of every hash function the ``pick`` least values and their places; a few functions at a time stay in cache."""
        pick = min(pick, len(narrow))
        values, places = np.empty((self.sketches, pick), np.uint32), np.empty((self.sketches, pick), np.int64)
        step = max(1, ROWS // len(narrow))
        for r in range(0, self.sketches, step):
            h = (narrow[None, :] ^ self.flip[r:r + step]) * self.factor[r:r + step]
            rows = np.arange(len(h))
            for j in range(pick):
                i = h.argmin(axis=1)
                values[r:r + step, j], places[r:r + step, j] = h[rows, i], i
                h[rows, i] = 0xFFFFFFFF
        return values, places

    def fingerprint(self, text: str) -> np.ndarray:
        """One 32-bit tuple hash a sketch; empty for an empty text."""
        kmers = self.kmers(text)
        if not len(kmers):
            return np.zeros(0, np.uint32)
        narrow = (self.numbered(kmers) >> U(32)).astype(np.uint32)
        pick = min(self.pick, len(kmers))
        values = positions = None
        for a in range(0, len(narrow), BLOCK):
            v, p = self._least(narrow[a:a + BLOCK], pick)
            p += a
            if values is not None:
                v, p = np.concatenate([values, v], 1), np.concatenate([positions, p], 1)
                best = np.argsort(v, axis=1, kind="stable")[:, :pick]
                v, p = np.take_along_axis(v, best, 1), np.take_along_axis(p, best, 1)
            values, positions = v, p
        tuples = kmers[np.sort(positions, axis=1)]
        out = np.full(self.sketches, pick, np.uint64)
        for j in range(tuples.shape[1]):
            out = mixed(out * U(0x9E3779B97F4A7C15) + tuples[:, j])
        return (out >> U(32)).astype(np.uint32)


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Share of equal parts; 1 for two empty texts, 0 if only one is empty."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    return float((a == b).mean())


def with_next(docs: DataFrame, doc_id: str, text: str, ranges: int, body: Callable, schema: str) -> DataFrame:
    """Apply ``body`` to the stream of (id, text, next text) in descending order of id.

    Nulls come last, equal ids by hash of the text; after the last comes the
    first.  A range is cut at an id and a hash, so many rows of one id, or
    without one, span many ranges; only equal texts of one id stay together.
    ``body`` maps an iterator of such triples to record batches.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(doc_id).cast("long").alias("__doc"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("__text"))
    rows = rows.withColumn("__th", F.xxhash64("__text"))
    at = F.struct(F.col("__doc").isNotNull().alias("known"), F.coalesce("__doc", F.lit(0)).alias("doc"), F.col("__th").alias("th"))
    # One row a range comes to the driver: id and hash of its first row, where it is cut and what the range before gets.
    firsts = [r["f"] for r in rows.select(at.alias("__at")).repartitionByRange(ranges, F.col("__at").desc())
              .groupBy(F.spark_partition_id()).agg(F.max("__at").alias("f")).collect()]
    if not firsts:
        return spark.createDataFrame([], schema)
    firsts.sort(reverse=True)
    known = F.array(*[F.struct(F.lit(f["known"]).alias("known"), F.lit(f["doc"]).cast("long").alias("doc"),
                               F.lit(f["th"]).cast("long").alias("th")) for f in firsts])
    rows = rows.withColumn("__range", F.size(F.filter(known, lambda f: f >= at)) - 1)
    handed = [((i - 1) % len(firsts), i, *f) for i, f in enumerate(firsts)]
    handed = spark.createDataFrame(handed, "__to int, __range int, __known boolean, __d long, __th long")
    guests = (rows.join(F.broadcast(handed), ["__range", "__th"])
              .where((F.col("__doc").isNotNull() == F.col("__known")) & (F.coalesce("__doc", F.lit(0)) == F.col("__d")))
              .dropDuplicates(["__range"])
              .select(F.col("__to").alias("__range"), F.lit(1).alias("__guest"), "__doc", "__th", "__text"))
    dealt = rows.select("__range", F.lit(0).alias("__guest"), "__doc", "__th", "__text").unionByName(guests)
    dealt = dealt.repartitionById(len(firsts), F.col("__range")).sortWithinPartitions(
        "__range", "__guest", F.col("__doc").desc_nulls_last(), F.col("__th").desc())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def triples():
            held = None
            for batch in batches:
                for guest, doc, whole in zip(*(batch.column(c).to_pylist() for c in ("__guest", "__doc", "__text"))):
                    if held:
                        yield (*held, whole)
                    held = None if guest else (doc, whole)
        yield from body(triples())

    return dealt.select("__guest", "__doc", "__text").mapInArrow(run, schema)


FINGERPRINTS = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
                "near_edited double, near_next double")


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows))
    return pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int64()), *map(pa.array, columns[1:])],
                                      names=[c.split()[0] for c in FINGERPRINTS.split(", ")])


def _compare(settings: tuple, size: int = 512):
    def body(triples):
        sketch = OrderMinHash(*settings)
        rows, held, ready = [], None, None
        for doc, text, following in triples:
            own = ready if held == text and ready is not None else sketch.fingerprint(text)
            half = len(text) // 2
            edited = text[:len(text) - half] + following[:half]
            other = own if edited == text else sketch.fingerprint(edited)
            held, ready = following, (own if following == text else sketch.fingerprint(following))
            rows.append((doc, len(text), hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest(),
                         own.astype(">u4").tobytes().hex(), other.astype(">u4").tobytes().hex(), likeness(own, other),
                         likeness(own, ready)))
            if len(rows) >= size:
                yield _batch(rows)
                rows = []
        if rows:
            yield _batch(rows)
    return body


@any_names
def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", k: int = K, sketches: int = SKETCHES,
                 pick: int = PICK, ranges: int | None = None) -> DataFrame:
    """Fingerprints of every text and of its edited text, and their likeness.

    The edited text is the text with its last half replaced by the start of
    the next document's, in descending order of id.  Null is an empty text,
    with an empty fingerprint; null ids come last; repeated rows are rows of
    their own; one document alone is its own next.
    """
    ranges = ranges or int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return with_next(docs, doc_id, text, ranges, _compare((k, sketches, pick)), FINGERPRINTS)


def op10_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order MinHash fingerprints of all documents and their edited texts."""
    return fingerprints(table(spark, sf_dir, "documents").select("doc_id", "text"))
