"""Ranks of rows within groups of any size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketlens.llm.shared import stored


def blocks(rows: DataFrame, group: str, order: list[Column], name: str) -> DataFrame:
    """``rows`` stored in blocks of the order (``group``, ``order``), with the block's number as ``__block``.

    A block is a range of that order, so a large group spans many blocks.
    """
    return stored(rows.repartitionByRange(F.col(group), *order).withColumn("__block", F.spark_partition_id()), name)


def ranked(rows: DataFrame, group: str, order: list[Column]) -> DataFrame:
    """The rows of ``blocks`` with ``__rank``, from 1 in every group; null is a group.

    Windows run within a block; a group that goes on over several blocks
    gets the number of its rows in the blocks before.
    """
    own = Window.partitionBy(group, "__block").orderBy(*order)
    earlier = Window.partitionBy(group).orderBy("__block").rowsBetween(Window.unboundedPreceding, -1)
    counts = rows.groupBy(group, "__block").agg(F.count(F.lit(1)).alias("__n"))
    offsets = (counts.withColumn("__before", F.sum("__n").over(earlier)).where("__before > 0")
               .select(F.col(group).alias("__g"), F.col("__block").alias("__b"), "__before"))
    found = rows.withColumn("__rank", F.row_number().over(own).cast("long"))
    found = found.join(offsets, F.col(group).eqNullSafe(F.col("__g")) & (F.col("__block") == F.col("__b")), "left")
    return found.withColumn("__rank", F.col("__rank") + F.coalesce("__before", F.lit(0))).drop("__g", "__b", "__before")
