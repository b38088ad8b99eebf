"""Language ID by string kernels.

The kernel of two texts is the blended-spectrum presence kernel: the number
of character n-grams (UTF-8 bytes, n = 1 to 4, of the lower-cased letters
with single blanks between words) that both hold, divided by the geometric
mean of the numbers they hold.  n-grams are hashed to 2**16 buckets.  Nyström
landmarks make features of it: ``phi(x) = k(x, landmarks) @ K_mm**-1/2``, on
which one-versus-rest kernel ridge regression is solved in closed form.

Presence vectors X of a batch and P of the landmarks give ``k = X P^T``, so
all scores of a batch are one matrix product with the regression folded in:
``scores = X (P^T K_mm**-1/2 beta) / |x|``.

Learning uses a bounded sample: about ``SAMPLE`` labelled rows a language,
drawn by a hash of the id, of which ``LANDMARKS`` a language are landmarks.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketlens.llm.shared import any_names, stored, table

MAX_N = 4
BUCKETS = 1 << 16
SAMPLE = 500
LANDMARKS = 40
LANDMARK_CHARS = 8_000
RIDGE = 1e-2
SHARPNESS = 6.0
BATCH = 32
PIECE = 1 << 20
UND = "und"
_NOT_LETTERS = re.compile(r"[\W\d_]+")


def held_out(doc_id: Column, parts: int = 4, part: int = 2) -> Column:
    """Whether crc32 of the id as text leaves ``part`` modulo ``parts``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % parts == part


def presence(text: str, out: np.ndarray) -> bool:
    """Set the buckets of the text's n-grams in ``out``; whether it has letters."""
    letters = _NOT_LETTERS.sub(" ", text.lower()).strip()
    whole = np.frombuffer(f" {letters} ".encode("utf-8", "replace"), np.uint8)
    for a in range(0, len(whole), PIECE):  # long texts in pieces that overlap by all but one byte of the longest n-gram
        data = whole[a:a + PIECE + MAX_N - 1].astype(np.uint32)
        gram = np.zeros(len(data), np.uint32)
        for n in range(1, min(MAX_N, len(data)) + 1):
            gram = (gram[:len(data) - n + 1] << np.uint32(8)) | data[n - 1:]
            out[((gram + np.uint32(n)) * np.uint32(0x9E3779B1)) >> np.uint32(16)] = 1
    return bool(letters)


def _presences(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    out = np.zeros((len(texts), BUCKETS), np.float32)
    return out, np.array([presence(t, row) if t else False for t, row in zip(texts, out)], bool)


class KernelModel:
    """Fitted languages: ``weights`` of buckets by language, and ``basis`` while fitting."""

    def __init__(self, languages: list[str], weights: np.ndarray):
        self.languages, self.weights = languages, weights

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        """Language and score (softmax of the regression's outputs); ``und`` and 0 without letters."""
        names: list[str] = []
        scores = np.zeros(len(texts))
        for a in range(0, len(texts), BATCH):
            x, lettered = _presences(texts[a:a + BATCH])
            size = np.maximum(x.sum(axis=1, keepdims=True), 1)
            raw = (x @ self.weights) / np.sqrt(size)
            raw = np.exp(SHARPNESS * (raw - raw.max(axis=1, keepdims=True)))
            best = raw.argmax(axis=1)
            sure = raw[np.arange(len(best)), best] / raw.sum(axis=1)
            names += [self.languages[i] if ok else UND for i, ok in zip(best, lettered)]
            scores[a:a + BATCH] = np.where(lettered, sure, 0)
        return names, scores


def _gram(basis, languages: list[str]):
    """Sums of phi phi^T and phi y^T over a task's rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = basis.value
        m, c = weights.shape[1], len(languages)
        left, right = np.zeros((m, m)), np.zeros((m, c))
        for batch in batches:
            texts, labels = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for a in range(0, len(texts), BATCH):
                x, lettered = _presences(texts[a:a + BATCH])
                phi = ((x @ weights) / np.sqrt(np.maximum(x.sum(axis=1, keepdims=True), 1)))[lettered].astype(np.float64)
                y = np.array([[1.0 if v == label else -1.0 for v in languages] for label in labels[a:a + BATCH]])
                y = y.reshape(-1, c)[lettered]
                left += phi.T @ phi
                right += phi.T @ y
        yield pa.RecordBatch.from_arrays([pa.array([left.ravel().tolist()]), pa.array([right.ravel().tolist()])], names=["l", "r"])
    return run


def fit(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", sample: int = SAMPLE,
        landmarks: int = LANDMARKS, ridge: float = RIDGE, seed: int = 5) -> KernelModel:
    """Learn from a bounded sample of the rows with a label and a text.

    About ``sample`` rows a language, chosen by a hash of id and text against
    the language's count; the ``landmarks`` of least hash with at most
    ``LANDMARK_CHARS`` characters are its landmarks.
    """
    spark = docs.sparkSession
    rows = docs.where(F.col(lang).isNotNull() & F.col(text).isNotNull()).select(
        F.col(text).cast("string").alias("t"), F.col(lang).cast("string").alias("y"),
        F.xxhash64(F.lit(seed), F.col(doc_id), F.col(text)).alias("h"))
    counts = {r["y"]: r["n"] for r in rows.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    languages = sorted(counts)
    if not languages:
        return KernelModel([UND], np.zeros((BUCKETS, 1), np.float32))
    share = F.element_at(F.create_map(*[F.lit(v) for y, n in counts.items() for v in (y, min(1.0, sample / n))]), F.col("y"))
    chosen = stored(rows.where((F.col("h") / F.lit(2.0**64) + 0.5) < share), "language-sample")
    points = [r["t"] for y in languages for r in
              chosen.where((F.col("y") == y) & (F.length("t") <= LANDMARK_CHARS)).orderBy("h", "t").limit(landmarks).collect()]
    p, lettered = _presences(points)
    p = p[lettered]
    if not len(p):
        return KernelModel([UND], np.zeros((BUCKETS, 1), np.float32))
    p /= np.sqrt(np.maximum(p.sum(axis=1, keepdims=True), 1))
    values, vectors = np.linalg.eigh((p @ p.T).astype(np.float64))
    good = values > 1e-6 * values[-1]
    basis = p.T @ (vectors[:, good] / np.sqrt(values[good])).astype(np.float32)
    del p
    sent = spark.sparkContext.broadcast(basis)
    m, c = basis.shape[1], len(languages)
    # As many sums as tasks come to the driver, each landmarks x landmarks; the sample is bounded and so are they.
    sums = chosen.select("t", "y").repartition(6).mapInArrow(_gram(sent, languages), "l array<double>, r array<double>").toArrow()
    sent.destroy()  # the driver needs the memory for later stages
    left = np.sum([np.array(v) for v in sums.column("l").to_pylist()], axis=0).reshape(m, m)
    right = np.sum([np.array(v) for v in sums.column("r").to_pylist()], axis=0).reshape(m, c)
    beta = np.linalg.solve(left + ridge * np.trace(left) / m * np.eye(m), right)
    return KernelModel(languages, (basis @ beta).astype(np.float32))


def _predict(model, column: int, keep: list[int], schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = KernelModel(*model.value)
        for batch in batches:
            for a in range(0, len(batch), 512):
                part = batch.slice(a, 512)
                names, scores = known.predict(part.column(column).to_pylist())
                columns = [part.column(c) for c in keep] + [pa.array(names, pa.string()), pa.array(scores, pa.float64())]
                yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, schema)], schema=schema)
    return run


@any_names
def identify(docs: DataFrame, model: KernelModel, text: str = "text", keep_text: bool = True) -> DataFrame:
    """Every row of ``docs`` with ``__lang`` and ``__score``.

    Null and empty texts and texts without a letter are ``und`` with score 0.
    Other columns are passed on and never read.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    kept = [c for c in docs.columns if keep_text or c != text]
    schema = T.StructType([docs.schema[c] for c in kept] + [T.StructField("__lang", T.StringType()),
                                                             T.StructField("__score", T.DoubleType())])
    sent = docs.sparkSession.sparkContext.broadcast((model.languages, model.weights))
    return docs.mapInArrow(_predict(sent, docs.columns.index(text), [docs.columns.index(c) for c in kept],
                                    to_arrow_schema(schema)), schema)


def keep_identified(docs: DataFrame, model: KernelModel, text: str = "text", min_score: float = 0.0) -> DataFrame:
    """The rows that have a language, with at least ``min_score``; same columns as ``docs``."""
    found = identify(docs, model, text)
    return found.where((F.col("__lang") != UND) & (F.col("__score") >= min_score)).select(*docs.columns)


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of every document, learned from those that are not held out."""
    docs = table(spark, sf_dir, "documents")
    model = fit(docs.where(~held_out(F.col("doc_id"))))
    found = identify(docs.select("doc_id", "text"), model, keep_text=False)
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), F.col("__lang").alias("lang_pred"),
                        F.col("__score").alias("score"))
