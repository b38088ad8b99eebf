"""Mixing sources to target weights: capped water-filling and seeded repetition.

Every source's target is its weight's share of the total size, clamped at
``max_epochs`` times the source's own size; what a clamped source cannot take
is shared among the others by weight until no target is above its cap.
All decisions compare whole numbers, so reruns and other engines agree.

A source whose target is r times its size takes every document floor(r)
times, and fills the rest with documents in a seeded random order; the last of
them is taken in part.  The order's running sums come from sums of hash
buckets first and from the rows of one bucket then, so a source with a third
of all rows is no single task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from marketlens.llm.shared import any_names, stored, table

SEED = 17
MAX_EPOCHS = 3
WORD = r"[^\x20\x09-\x0D]+"
BUCKET_DIGITS = 3  # hex digits: 4,096 buckets a source


def n_words(text: Column) -> Column:
    """Number of runs of characters other than ASCII white space; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def water_fill(sources: DataFrame, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """Targets of sources given as (__size, __weight) with any other columns.

    Adds ``__num`` and ``__den``: the target is their quotient.  Each round
    clamps the sources that are above their cap and shares the rest again;
    only three totals a round come to the driver.  Sources without size or
    weight get 0.
    """
    weight = F.when(F.col("__weight") > 0, F.col("__weight")).otherwise(F.lit(0)).cast("long")
    sources = stored(sources.withColumn("__weight", weight).withColumn("__size", F.col("__size").cast("long")),
                     "mix-sources")
    total = sources.agg(F.sum("__size")).first()[0] or 0
    size, weight = F.col("__size"), F.col("__weight")
    rest, share, clamped = total, None, -1
    above = F.lit(False)
    while True:
        row = sources.agg(F.sum(F.when(above, size * max_epochs).otherwise(0)),
                          F.sum(F.when(above, 0).otherwise(weight)),
                          F.sum(above.cast("int"))).first()
        if (row[2] or 0) == clamped or not row[1]:
            break
        clamped, rest, share = row[2] or 0, total - row[0], row[1]
        above = above | (weight * F.lit(rest).cast("decimal(38,0)") > size * F.lit(max_epochs * share).cast("decimal(38,0)"))
    return (sources.withColumn("__num", F.when(above, size * max_epochs).otherwise(weight * F.lit(rest).cast("long")))
            .withColumn("__den", F.when(above, F.lit(1)).otherwise(F.lit(share or 1)).cast("long")))


@any_names
def mix(docs: DataFrame, weights: DataFrame, doc_id: str = "doc_id", source: str = "source", text: str = "text",
        size: Column | None = None, max_epochs: int = MAX_EPOCHS, seed: int = SEED) -> DataFrame:
    """How much of every document the mix takes.

    ``weights`` has one row per source: (``source``, ``weight``, whole
    numbers); a source that it leaves out takes nothing.  ``size`` is the size
    of a row, the words of ``text`` unless given.  Returns the id, ``source``,
    ``size``, ``source_size``, ``target`` and ``taken`` (words, repetitions
    counted, at most ``max_epochs`` times the size).

    Null texts have size 0.  A null source is a source of its own.  Rows that
    repeat an id are rows of their own: order by hash of the id, then by
    size.  An empty table gives an empty result.
    """
    size = n_words(F.col(text)) if size is None else size.cast("long")
    key = lambda c: F.coalesce(F.concat(F.lit("="), c.cast("string")), F.lit("null"))
    order = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(doc_id).cast("string"), F.lit(""))))
    rows = stored(docs.select(F.col(doc_id).alias("__id"), F.col(source).alias("__source"), size.alias("__words"),
                              order.alias("__order")), "mix-rows")
    rows = rows.withColumn("__key", key(F.col("__source"))).withColumn(
        "__bucket", F.substring("__order", 1, BUCKET_DIGITS))
    buckets = stored(rows.groupBy("__key", "__bucket").agg(F.sum("__words").alias("__bucket_size")), "mix-buckets")
    given = weights.select(key(F.col("source")).alias("__key"), F.col("weight").alias("__weight"))
    sources = buckets.groupBy("__key").agg(F.sum("__bucket_size").alias("__size")).join(given, "__key", "left")
    sources = water_fill(sources, max_epochs)

    num, den, total = F.col("__num"), F.col("__den"), F.col("__size")
    epochs = F.when(total > 0, F.expr("__num div (__den * __size)")).otherwise(0)
    sources = sources.select("__key", F.col("__size").alias("__source_size"),
                             (num.cast("double") / den.cast("double")).alias("__target"),
                             epochs.alias("__epochs"),
                             (F.expr("__num div __den") - epochs * total).alias("__rest"))
    before = F.sum("__bucket_size").over(Window.partitionBy("__key").orderBy("__bucket").rowsBetween(
        Window.unboundedPreceding, -1))
    offsets = (buckets.withColumn("__before", F.coalesce(before, F.lit(0)))
               .join(sources, "__key"))
    inside = F.coalesce(F.sum("__words").over(
        Window.partitionBy("__key", "__bucket").orderBy("__order", "__words").rowsBetween(
            Window.unboundedPreceding, -1)), F.lit(0))
    rows = rows.withColumn("__inside", inside).join(offsets.drop("__bucket_size"), ["__key", "__bucket"])
    part = F.greatest(F.lit(0), F.least(F.col("__words"), F.col("__rest") - F.col("__before") - F.col("__inside")))
    return rows.select(F.col("__id").alias(doc_id), F.col("__source").alias(source), F.col("__words").alias("size"),
                       F.col("__source_size").alias("source_size"), F.col("__target").alias("target"),
                       (F.col("__epochs") * F.col("__words") + part).cast("long").alias("taken"))


def cycled_weights(docs: DataFrame, cycle: tuple[int, ...] = (5, 2, 1), source: str = "source") -> DataFrame:
    """Weights by the sources' rank in code-point order, null last.

    The list of sources is a dimension that somebody weighs by name: one
    row per source, far from one per document, passes the ranking window.
    """
    names = docs.groupBy(F.col(source).alias("source")).agg(F.count(F.lit(1)).alias("__n"))
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    return names.select("source", F.element_at(F.array(*map(F.lit, cycle)), (rank % len(cycle) + 1).cast("int")).alias("weight"))


def op2_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a mix of all sources, weights 5, 2, 1 repeating, takes of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return mix(docs, cycled_weights(docs)).select("doc_id", "size", "source_size", "target", "taken")


OP2_SQL = r"""
WITH d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
    md5('17:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents),
s AS (
  SELECT source, sum(size)::HUGEINT AS source_size,
    CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS w
  FROM d GROUP BY source),
o AS (
  SELECT *, (SELECT sum(source_size) FROM s) AS total,
    row_number() OVER (ORDER BY source_size::DOUBLE / w, source NULLS LAST) AS r FROM s),
f AS (
  SELECT *, total - 3 * coalesce(sum(source_size) OVER (ORDER BY r ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS rest,
    sum(w) OVER (ORDER BY r ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS share FROM o),
c AS (SELECT *, rest * w > 3 * source_size * share AS capped FROM f),
g AS (SELECT rest, share FROM c WHERE NOT capped ORDER BY r LIMIT 1),
t AS (
  SELECT c.source, source_size, CASE WHEN capped THEN 3 * source_size ELSE c.w * g.rest END AS num,
    CASE WHEN capped THEN 1 ELSE g.share END AS den FROM c, g),
e AS (SELECT *, CASE WHEN source_size > 0 THEN num // (den * source_size) ELSE 0 END AS epochs FROM t),
x AS (
  SELECT d.doc_id, d.size, e.source_size, e.num::DOUBLE / e.den::DOUBLE AS target, e.epochs,
    e.num // e.den - e.epochs * e.source_size
      - coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.h, d.size
                                   ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS room
  FROM d JOIN e ON d.source IS NOT DISTINCT FROM e.source)
SELECT doc_id, size, source_size::BIGINT AS source_size, target,
  (epochs * size + greatest(0, least(size, room)))::BIGINT AS taken FROM x
"""
