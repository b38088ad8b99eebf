"""Toxicity by gradient-boosted trees over dense features, with isotonic calibration.

A lexicon of words and word stems is learned from a bounded sample of
labelled rows: terms of toxic texts of many families, and by greedy coverage
of the rest.  A text's features are
densities of lexicon hits, their proximity to second-person words, rates of
capitals, punctuation and obfuscated words, and lengths.  Spark's
gradient-boosted trees are fitted on one part of the sample, their margin is
calibrated by isotonic regression on the other, and every whole text is scored
by both.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression, IsotonicRegressionModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketlens.llm.language_id import held_out
from marketlens.llm.shared import stored, table

SAMPLE = 12_000
CALIBRATION = 0.3
TREES = 20
DEPTH = 3
THRESHOLD = 0.3
STEMS = (4, 5, 6)
MIN_TOXIC = 6
MIN_PURITY = 0.75
PURE = 0.9
MIN_FAMILIES = 0.5
MIN_GAIN = 4
NEAR = 5
FEATURES = 13

#: Second-person words of English, French, German and Spanish.
SECOND_PERSON = frozenset("you your yours yourself u ur tu te toi ton ta tes vous votre vos du dich dir dein deine euch ihr "
                          "eure usted ustedes tus tuyo vosotros".split())
_WORD = re.compile(r"[^\W\d_]+")
# From the start of a run of letters only, and without backtracking: a text of one long word takes linear time.
_MASKED = re.compile(r"(?<![^\W\d_])[^\W\d_]++(?:[\d@$!|*+.\-_#%&]++[^\W\d_]++)++")
_LEET = str.maketrans({"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i", "|": "l", "+": "t"})
_REPEATS = re.compile(r"(.)\1{2,}")
_PUNCTUATION = np.array([33 <= b <= 47 or 58 <= b <= 64 or 91 <= b <= 96 or 123 <= b <= 126 for b in range(256)])


def terms_of(word: str) -> list[str]:
    """The word, and its stems marked by a hyphen."""
    return [word] + [word[:n] + "-" for n in STEMS if len(word) >= n]


def _in(word: str, lexicon: frozenset[str]) -> bool:
    return word in lexicon or any(word[:n] + "-" in lexicon for n in STEMS if len(word) >= n)


def features(text: str | None, lexicon: frozenset[str]) -> list[float]:
    """The dense features of one text; an empty text has zeros."""
    text = text or ""
    data = np.frombuffer(text.encode("utf-8", "replace"), np.uint8)
    bytes_ = np.bincount(data, minlength=256)
    n_bytes = max(1, len(data) - int(bytes_[32]))
    words = _WORD.findall(text.lower())
    n = max(1, len(words))
    counts = Counter(words)
    bad = {w for w in counts if _in(w, lexicon)}
    hits = sum(counts[w] for w in bad)
    near = 0
    if bad and not SECOND_PERSON.isdisjoint(counts):
        last_bad = last_you = -NEAR - 1
        for i, w in enumerate(words):
            if w in bad:
                last_bad = i
                near += i - last_you <= NEAR
            elif w in SECOND_PERSON:
                last_you = i
                near += i - last_bad <= NEAR
    masked = hidden = 0
    if len(words):
        for w, c in Counter(_MASKED.findall(text)).items():
            masked += c
            plain = w.lower().translate(_LEET)
            plain = _REPEATS.sub(r"\1", "".join(ch for ch in plain if ch.isalpha()))
            hidden += c * (plain not in bad and _in(plain, lexicon))
    capitals, letters = int(bytes_[65:91].sum()), max(1, int(bytes_[65:91].sum() + bytes_[97:123].sum()))
    return [100.0 * hits / n, float(np.log1p(hits)), float(len(bad)), 100.0 * hidden / n, float(np.log1p(hidden)),
            100.0 * near / n, float(np.log1p(near)), capitals / letters, float(bytes_[_PUNCTUATION].sum()) / n_bytes,
            float(bytes_[33]) / n_bytes, 100.0 * masked / n, sum(map(len, words)) / n, float(np.log1p(len(words)))]


def _term_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    found: dict[str, list[int]] = {}
    for batch in batches:
        for text, label in zip(batch.column("t").to_pylist(), batch.column("y").to_pylist()):
            for term in {t for w in set(_WORD.findall(text.lower())) for t in terms_of(w)}:
                v = found.setdefault(term, [0, 0])
                v[0] += 1
                v[1] += label
    yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.string()), pa.array([v[0] for v in found.values()], pa.int64()),
                                      pa.array([v[1] for v in found.values()], pa.int64())], names=["term", "n", "toxic"])


def _incidence(candidates):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = candidates.value
        for batch in batches:
            words = [set(_WORD.findall(text.lower())) for text in batch.column("t").to_pylist()]
            held = [[known[t] for t in {t for w in ws for t in terms_of(w)} if t in known] for ws in words]
            family = [min((xxhash.xxh64_intdigest(w) >> 1 for w in ws), default=0) for ws in words]
            yield pa.RecordBatch.from_arrays([pa.array(held, pa.list_(pa.int32())), pa.array(family, pa.int64())],
                                             names=["held", "family"])
    return run


def learn_lexicon(sample: DataFrame) -> frozenset[str]:
    """Toxic terms of (t, y) rows.  The sample is bounded, and so is what the driver gets of it.

    A term's texts must be toxic for a share of ``MIN_PURITY``.  Terms of
    share ``PURE`` whose toxic texts are of many families are taken; a family
    is texts with the same least word hash, such as near copies, all of whose
    rare words would look toxic.  Of the others, a term is added while
    ``MIN_GAIN`` toxic texts hold it and no earlier one.
    """
    sums = sample.mapInArrow(_term_counts, "term string, n long, toxic long").groupBy("term").agg(
        F.sum("n").alias("n"), F.sum("toxic").alias("toxic"))
    good = sums.where((F.col("toxic") >= MIN_TOXIC) & (F.col("toxic") >= F.col("n") * MIN_PURITY)).toArrow().to_pylist()
    purity = {r["term"]: r["toxic"] / r["n"] for r in good}
    terms = sorted(purity)
    if not terms:
        return frozenset()
    sent = sample.sparkSession.sparkContext.broadcast({t: i for i, t in enumerate(terms)})
    found = sample.where("y = 1").mapInArrow(_incidence(sent), "held array<int>, family long").toArrow()
    texts: list[set[int]] = [set() for _ in terms]
    families: list[set[int]] = [set() for _ in terms]
    for i, (ids, family) in enumerate(zip(found.column("held").to_pylist(), found.column("family").to_pylist())):
        for t in ids:
            texts[t].add(i)
            families[t].add(family)
    chosen = [t for t, term in enumerate(terms)
              if purity[term] >= PURE and len(families[t]) >= max(MIN_TOXIC, MIN_FAMILIES * len(texts[t]))]
    covered = set().union(*(texts[t] for t in chosen))
    live = set(range(len(terms))) - set(chosen)
    while live:
        best, gain = None, ()
        for t in list(live):
            new = len(texts[t] - covered)
            if new < MIN_GAIN:
                live.discard(t)
            elif (g := (new * purity[terms[t]] ** 4, terms[t])) > gain:
                best, gain = t, g
        if best is not None:
            chosen.append(best)
            covered |= texts[best]
    return frozenset(terms[t] for t in chosen)


def _features(lexicon, column: int, keep: list[int], schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = lexicon.value
        for batch in batches:
            for a in range(0, len(batch), 512):
                part = batch.slice(a, 512)
                rows = [features(t, known) for t in part.column(column).to_pylist()]
                columns = [part.column(c) for c in keep] + [pa.array(rows, pa.list_(pa.float64()))]
                yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, schema)], schema=schema)
    return run


def with_features(docs: DataFrame, text: str, lexicon: frozenset[str]) -> DataFrame:
    """``docs`` without the text, with ``__features``."""
    from pyspark.sql.pandas.types import to_arrow_schema

    kept = [c for c in docs.columns if c != text]
    schema = T.StructType([docs.schema[c] for c in kept] + [T.StructField("__features", T.ArrayType(T.DoubleType()))])
    sent = docs.sparkSession.sparkContext.broadcast(lexicon)
    return docs.mapInArrow(_features(sent, docs.columns.index(text), [docs.columns.index(c) for c in kept],
                                     to_arrow_schema(schema)), schema)


class ToxicityModel:
    """Lexicon, trees and calibration; without training rows of both labels, a constant score."""

    def __init__(self, lexicon: frozenset[str], trees: GBTClassificationModel | None,
                 calibration: IsotonicRegressionModel | None, constant: float = 0.0):
        self.lexicon, self.trees, self.calibration, self.constant = lexicon, trees, calibration, constant

    def _margin(self, rows: DataFrame) -> DataFrame:
        rows = self.trees.transform(rows.withColumn("__vector", array_to_vector("__features")))
        return rows.withColumn("__margin", vector_to_array("__raw")[1]).drop("__vector", "__raw", "__probability", "__prediction")

    def score(self, docs: DataFrame, text: str = "text") -> DataFrame:
        """Every row of ``docs`` without the text, with ``__score`` from 0 to 1."""
        if self.trees is None:
            return docs.drop(text).withColumn("__score", F.lit(self.constant))
        rows = self.calibration.transform(self._margin(with_features(docs, text, self.lexicon)))
        return rows.withColumn("__score", F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.col("__calibrated")))).drop(
            "__features", "__margin", "__calibrated")


def fit(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "toxic",
        sample: int = SAMPLE, seed: int = 3) -> ToxicityModel:
    """Learn from about ``sample`` of the labelled rows, drawn by a hash of id; equal texts count once.

    Rows without a label, an id or a text are left out; an id with several
    labels takes the largest.
    """
    marks = labels.where(F.col(label).isNotNull() & F.col(doc_id).isNotNull()).groupBy(doc_id).agg(
        F.max(F.col(label).cast("int")).alias("y"))
    draw = F.xxhash64(F.lit(seed), F.col(doc_id)) / F.lit(2.0**64) + 0.5
    share = min(1.0, sample / max(1, marks.count()))
    marks = marks.where(draw < share)
    rows = docs.where(F.col(text).isNotNull()).select(doc_id, F.col(text).cast("string").alias("t")).join(marks, doc_id)
    rows = rows.groupBy(F.xxhash64("t").alias("h")).agg(F.max_by("t", doc_id).alias("t"), F.max("y").alias("y"))
    rows = stored(rows, "toxicity-sample")
    n, toxic = rows.agg(F.count(F.lit(1)), F.sum("y")).first()
    if not toxic or toxic == n:
        return ToxicityModel(frozenset(), None, None, float(toxic or 0) / max(1, n))
    lexicon = learn_lexicon(rows)
    rows = stored(with_features(rows, "t", lexicon).coalesce(4), "toxicity-features")
    apart = F.pmod(F.xxhash64(F.lit(seed + 1), "h"), F.lit(1000)) < CALIBRATION * 1000
    train, rest = rows.where(~apart), rows.where(apart)
    if train.select("y").distinct().count() < 2 or rest.isEmpty():
        train = rest = rows
    booster = GBTClassifier(featuresCol="__vector", labelCol="y", maxIter=TREES, maxDepth=DEPTH, minInstancesPerNode=10, seed=seed,
                            predictionCol="__prediction").setRawPredictionCol("__raw").setProbabilityCol("__probability")
    model = ToxicityModel(lexicon, booster.fit(train.withColumn("__vector", array_to_vector("__features"))), None)
    steps = IsotonicRegression(featuresCol="__margin", labelCol="y", predictionCol="__calibrated")
    model.calibration = steps.fit(model._margin(rest).withColumn("y", F.col("y").cast("double")))
    return model


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document, learned from the labelled ones that are not held out."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit(docs, table(spark, sf_dir, "labels").where(~held_out(F.col("doc_id"))))
    return model.score(docs).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), F.col("__score").alias("score"),
        (F.col("__score") >= THRESHOLD).cast("int").alias("predicted"))
