"""How rows are dealt to tasks: many rows of few bytes, and keys of which some hold very many rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A key with at least so many rows is frequent.
FREQUENT = 500_000


def shuffle_partitions(rows: DataFrame) -> int:
    return int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def deal(rows: DataFrame, *key: str) -> DataFrame:
    """``rows`` dealt by ``key`` into all shuffle partitions.

    Adaptive execution joins partitions up to a number of shuffled bytes.
    Where a few bytes a row become a wide row of a hash table, a task's memory
    would follow from that number; here it is its share of the input.
    """
    return rows.repartition(shuffle_partitions(rows), *key)


def join_totals(rows: DataFrame, key: list[str], totals: dict[str, Column], frequent: int = FREQUENT) -> DataFrame:
    """``rows`` with the ``totals`` of their key, whatever the number of rows of a key; null is a key.

    The totals are partial-aggregated.  Keys with ``frequent`` rows or more
    are at most one in ``frequent`` rows: their totals are broadcast, so their
    rows stay where they are.  The rows of all other keys, each bounded by
    ``frequent``, are dealt by key.
    """
    keyed = rows.groupBy(*key).agg(F.count(F.lit(1)).alias("__rows"), *[c.alias(n) for n, c in totals.items()])
    other = keyed.select(*[F.col(k).alias(f"__{i}") for i, k in enumerate(key)], "__rows", *totals)
    on = [F.col(k).eqNullSafe(F.col(f"__{i}")) for i, k in enumerate(key)]
    often, seldom = (F.col("__rows") >= frequent), (F.col("__rows") < frequent)
    kept = [*rows.columns, *totals]
    hot = rows.join(F.broadcast(other.where(often)), on).select(*kept)
    return hot.unionByName(rows.join(other.where(seldom), on).select(*kept))


def split_frequent(rows: DataFrame, key: str, frequent: int = FREQUENT) -> tuple[DataFrame, DataFrame]:
    """``rows`` whose key has fewer than ``frequent`` rows, and the others; the list of frequent keys is broadcast."""
    counts = rows.groupBy(F.col(key).alias("__key")).agg(F.count(F.lit(1)).alias("__rows")).where(F.col("__rows") >= frequent)
    keys = F.broadcast(counts.select("__key"))
    on = F.col(key).eqNullSafe(F.col("__key"))
    return rows.join(keys, on, "left_anti"), rows.join(keys, on, "left_semi")


#: Slots of hashes in which keys are counted first.
SLOTS = 1 << 16


def frequent_values(rows: DataFrame, key: str, frequent: int = FREQUENT) -> list:
    """The keys with ``frequent`` rows or more, at most one in ``frequent`` rows.

    Rows are counted by a hash of their key first, which shuffles a bounded
    list; only the keys of slots with that many rows are counted themselves.
    """
    slot = F.pmod(F.xxhash64(key), F.lit(SLOTS))
    counts = rows.groupBy(slot.alias("__slot")).agg(F.count(F.lit(1)).alias("__rows"))
    full = [r[0] for r in counts.where(F.col("__rows") >= frequent).collect()]
    if not full:
        return []
    counts = rows.where(slot.isin(full)).groupBy(F.col(key).alias("__key")).agg(F.count(F.lit(1)).alias("__rows"))
    return [r[0] for r in counts.where(F.col("__rows") >= frequent).collect()]


def among(key: str, values: list) -> Column:
    """Whether ``key`` is one of ``values``; null is a key."""
    found = F.coalesce(F.col(key).isin([v for v in values if v is not None]), F.lit(False))
    return found | F.col(key).isNull() if None in values else found
