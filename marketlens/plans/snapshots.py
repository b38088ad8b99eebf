"""Snapshot tables: atomic replace, backfill over a month spine, incremental refresh, read-back.

The reference deletes one snapshot and appends it again, per date, in a
sequential loop -- two commits per date and one full scan of the history per
date.  Here:

* ``replace_snapshots`` replaces the snapshots present in a frame and keeps the
  others; re-running gives the same table, and the first run needs no existing
  one.  In a folder (``path``) it is one atomic commit
  (:mod:`marketlens.plans.publish`); a catalog ``table`` gets dynamic partition
  overwrite, asked for by the write itself, as atomic as Spark's file commit.
* ``backfill`` builds every date of the spine in one Spark job and writes it
  once.  The payment mix has every month with a sale in one build and no
  reference date of its own; its table is overwritten as a whole.
* ``refresh`` rebuilds only the snapshots that changed or late facts touch.
* ``GROUPS`` says for each feature group how it is built and which column
  names a snapshot; the batch job and ``read_snapshot`` use the same.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from marketlens.functions.dates import DateLike, month_starts, snapshot_dates
from marketlens.functions.horizons import REF
from marketlens.operators import customers, delivery, geo, payments, products, reputation
from marketlens.plans.publish import is_published, latest, publish, read_published
from marketlens.session import checkpoint_dir, materialize, scratch_of
from marketlens.sources.marketplace import Marketplace

MultiBuilder = Callable[[Marketplace, list], DataFrame]


@dataclass(frozen=True)
class Group:
    """A feature group: its builder for many dates, and the column that names a snapshot.

    ``label`` turns a reference date into a value of that column; ``whole``
    says that one build has all snapshots up to the last date, ``ranged`` that
    its rows come dealt in ranges of the seller, ``stored`` that they are dear
    to make: a write in ranges reads them twice, so they are stored first.
    """

    build: MultiBuilder
    column: str = REF
    label: Callable[[DateLike], object] = lambda d: snapshot_dates(d)[0]
    whole: bool = False
    ranged: bool = False
    stored: bool = False


def _one_a_month(build: MultiBuilder) -> MultiBuilder:
    def run(mk: Marketplace, refs: list) -> DataFrame:
        months = [d.strftime("%Y-%m") for d in snapshot_dates(refs)]
        if len(set(months)) < len(months):
            raise ValueError("two reference dates in one month would give two rows a seller and snapshot month")
        return build(mk, refs)
    return run


GROUPS: dict[str, Group] = {
    "products": Group(products.products_snapshot, stored=True),
    "reputation": Group(reputation.reputation_snapshot),
    "customers": Group(_one_a_month(customers.customers_snapshot), "dtSafra",
                       lambda d: snapshot_dates(d)[0].replace(day=1)),
    "delivery": Group(lambda mk, refs: delivery.delivery_snapshot(mk, refs, with_ref=True)),
    "geo": Group(lambda mk, refs: geo.geo_snapshot(mk, refs, with_ref=True)),
    "payments": Group(lambda mk, refs: payments.payments_snapshot(mk, max(refs)), "ref_month",
                      lambda d: snapshot_dates(d)[0].strftime("%Y%m"), whole=True, ranged=True),
}


def _order(df: DataFrame) -> list[str]:
    return [c for c in ("idSeller", "seller_id") if c in df.columns][:1]


def _location(spark: SparkSession, table: str) -> str:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").where("col_name = 'Location'").collect()
    return rows[0].data_type


def replace_snapshots(df: DataFrame, path: str | None = None, table: str | None = None,
                      partition_col: str = REF, notes: dict | None = None) -> None:
    """Replace exactly the snapshots contained in ``df`` (S10 + S11 as one S12)."""
    spark = df.sparkSession
    if table:
        keys = [partition_col, *_order(df)]
        writer = lambda x: (x.repartitionByRange(*keys).sortWithinPartitions(*keys).write.mode("overwrite")
                            .partitionBy(partition_col).format("parquet").option("partitionOverwriteMode", "dynamic"))
        if not spark.catalog.tableExists(table):
            writer(df).saveAsTable(table)
            return
        writer(df.select(*spark.table(table).columns)).save(_location(spark, table))
        spark.catalog.recoverPartitions(table)
        spark.catalog.refreshTable(table)
    elif path:
        publish(df, path, partition_col, _order(df), notes)
    else:
        raise ValueError("path or table is required")


def overwrite_table(df: DataFrame, path: str | None = None, table: str | None = None, ranged: bool = False) -> None:
    """Full overwrite (S13), for tables holding every snapshot at once such as the payment mix."""
    if table:
        df.write.mode("overwrite").format("parquet").saveAsTable(table)
    elif path:
        publish(df, path, None, _order(df), ranged=ranged)
    else:
        raise ValueError("path or table is required")


def read_snapshot(spark: SparkSession, path: str | None = None, table: str | None = None,
                  ref: DateLike | None = None, order_by: Iterable[str] = (), group: str = "products") -> DataFrame:
    """Read a snapshot table of a feature group back (S9); ``ref`` keeps one snapshot."""
    if table:
        df = spark.table(table)
    else:
        df = read_published(spark, path) if is_published(spark, path) else spark.read.parquet(path)
    if ref is not None:
        df = df.where(F.col(GROUPS[group].column) == F.lit(GROUPS[group].label(ref)))
    order_by = list(order_by)
    return df.orderBy(*order_by) if order_by else df


def read_positions(spark: SparkSession, order_by: list[str], **where) -> DataFrame:
    """``read_snapshot`` with ``position``, the place of each row in the order, from 1.

    Rows are sorted in ranges; a range's rows get the number of rows in the
    ranges before it, one row a range.  Rows that tie are in any order.
    """
    keys = [F.col(c) for c in order_by]
    ranges = materialize(read_snapshot(spark, **where).repartitionByRange(*keys).withColumn("__range", F.spark_partition_id()),
                         "ranges")
    counts = ranges.groupBy("__range").agg(F.count(F.lit(1)).alias("__n"))
    earlier = Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select("__range", F.coalesce(F.sum("__n").over(earlier), F.lit(0)).alias("__before"))
    own = F.row_number().over(Window.partitionBy("__range").orderBy(*keys))
    found = ranges.withColumn("__own", own).join(F.broadcast(before), "__range")
    return found.withColumn("position", F.col("__own") + F.col("__before")).drop("__range", "__own", "__before")


def write_group(group: str, mk: Marketplace, dates: Iterable[DateLike], path: str | None = None,
                table: str | None = None, notes: dict | None = None) -> None:
    """Build a group's snapshots of ``dates`` in one job and replace those, or the whole table where one build is all."""
    g = GROUPS[group]
    with scratch_of(mk.orders.sparkSession):  # what the build writes on its way goes when the snapshots are written
        df = g.build(mk, list(snapshot_dates(list(dates))))
        df = materialize(df, group) if g.stored else df
        if g.whole:
            overwrite_table(df, path=path, table=table, ranged=g.ranged)
        else:
            replace_snapshots(df, path=path, table=table, partition_col=g.column, notes=notes)


def backfill(group: str, mk: Marketplace, first: DateLike, last: DateLike,
             path: str | None = None, table: str | None = None) -> None:
    """Build the monthly spine ``first..last`` (R3) of a feature group and write it."""
    if GROUPS[group].whole:
        raise ValueError(f"{group} has no spine: one build has every month before its cutoff; use write_group")
    write_group(group, mk, month_starts(first, last), path, table)


DIMENSIONS = ("products", "customers", "sellers", "geolocation")
FACTS = ("items", "payments", "reviews")


def day_digests(mk: Marketplace) -> DataFrame:
    """(relation, day, rows, digest): one row a fact relation and purchase day, one a dimension (null day).

    Facts count on the purchase day of their order; a row is its hash when it
    meets the order.  The digest is a sum of row hashes, so the order of rows
    does not matter and repeated rows do.
    """
    def digest(rows: DataFrame, relation: str, day: Column, hashed: Column) -> DataFrame:
        found = rows.select(day.alias("day"), hashed.cast("decimal(38,0)").alias("h")).groupBy("day").agg(
            F.count(F.lit(1)).alias("rows"), F.sum("h").cast("string").alias("digest"))
        return found.select(F.lit(relation).alias("relation"), "day", "rows", "digest")

    ts = "order_purchase_timestamp"
    days = mk.orders.select(F.col("order_id").alias("__order"), F.to_date(ts).alias("__day"))
    hashed = lambda rows: F.xxhash64(*rows.columns)
    parts = [digest(mk.orders, "orders", F.to_date(ts), hashed(mk.orders))]
    for name in FACTS:
        rows = getattr(mk, name)
        narrow = rows.select("order_id", hashed(rows).alias("__hash"))
        parts.append(digest(narrow.join(days, F.col("order_id") == F.col("__order")), name, F.col("__day"), F.col("__hash")))
    parts += [digest(getattr(mk, name), name, F.lit(None).cast("date"), hashed(getattr(mk, name))) for name in DIMENSIONS]
    return reduce(DataFrame.unionByName, parts)


def refresh(group: str, mk: Marketplace, dates: Iterable[DateLike], path: str) -> list:
    """Bring the snapshots of ``dates`` at ``path`` up to date and return the dates rebuilt.

    A snapshot is rebuilt if it is not there, if a fact of a day up to its date
    was added, changed or removed since the digests of the last refresh, or if
    a dimension was changed.  The digests (one row a relation and day) are
    written beside the table, and the commit that publishes the snapshots names
    them.
    """
    g, spark = GROUPS[group], mk.orders.sparkSession
    if g.whole:
        raise ValueError(f"{group} is one table of all months; use write_group")
    dates, record = list(snapshot_dates(list(dates))), latest(spark, path)
    digests = f"digests-{uuid.uuid4().hex}"
    day_digests(mk).write.parquet(f"{path}/{digests}")
    now = spark.read.parquet(f"{path}/{digests}")
    before = record["notes"].get("digests") if record else None
    stale = dates
    if before:
        old = spark.read.parquet(f"{path}/{before}")
        changed = now.exceptAll(old).unionByName(old.exceptAll(now)).agg(
            F.min("day").alias("first"), F.count(F.when(F.col("day").isNull(), 1)).alias("dimensions")).first()
        there = set(record["snapshots"])
        stale = [d for d in dates if changed.dimensions or changed.first and d >= changed.first
                 or f"{g.column}={g.label(d)}" not in there]
    if stale:
        write_group(group, mk, stale, path=path, notes={"digests": digests})
    return stale


def scratch_path(spark: SparkSession, name: str) -> str:
    """A folder under the session's shared checkpoint directory."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}"
