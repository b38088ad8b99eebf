"""Spark session defaults and the shared checkpoint folder."""

from __future__ import annotations

import gc
import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager, suppress

from py4j.protocol import Py4JError
from pyspark.sql import DataFrame, SparkSession

# Settings every build relies on.  Time zone pinned so month truncation and
# date arithmetic do not depend on the machine; AQE re-plans joins and
# coalesces / splits skewed shuffle partitions at run time.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # Percentiles keep one small histogram a group: hash up to so many groups a task before sorting the rows.
    "spark.sql.objectHashAggregate.sortBased.fallbackThreshold": "4096",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_spark(
    master: str | None = None,
    app_name: str = "marketlens",
    shuffle_partitions: int | None = None,
    extra_conf: dict[str, str] | None = None,
) -> SparkSession:
    """Build (or reuse) a session with the library defaults.

    On a cluster pass ``master=None`` and let the launcher decide; size
    ``shuffle_partitions`` so one partition of the largest shuffle fits an
    executor core (AQE then coalesces the small ones).
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra_conf or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for lineage cuts and intermediate tables.

    Read from the session: ``spark.checkpoint.dir``, else the context's
    checkpoint dir.  A local session, whose executors are this process, may go
    without and gets a temporary folder; on a cluster that folder would be
    another one on every machine, so none is an error.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    sc = spark.sparkContext
    if not sc.getCheckpointDir():
        if not re.match(r"local(\[|$)", sc.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="marketlens-ckpt-"))
    return sc.getCheckpointDir()


_scratch: dict[str, list[tuple[str, str | None]]] = {}


def materialize(df, name: str = "stage", by: str | None = None):
    """Cut the lineage of a relation that many branches re-read.

    The rows are computed once and written as a Parquet table under the
    session's shared checkpoint folder, then read back: later stages neither
    recompute the joins that built them nor lose them with an executor.
    (``Dataset.checkpoint`` would compute the plan twice -- once to count,
    once to write -- and store row objects instead of columns.)

    ``by``: the rows come dealt by this column into all shuffle partitions
    (:func:`marketlens.functions.skew.deal`) and are kept so, in a bucketed
    table: what groups or joins them by it later needs no exchange.

    The table stays until :func:`release_scratch`; the snapshot writers, whose
    results no longer need it, release theirs (:func:`scratch_of`).
    """
    spark = df.sparkSession
    key = f"{name}-{uuid.uuid4().hex}"
    path = f"{checkpoint_dir(spark).rstrip('/')}/marketlens/{key}"
    table = f"marketlens_{key.replace('-', '_')}" if by else None
    _scratch.setdefault(spark.sparkContext.applicationId, []).append((path, table))
    if not table:
        df.write.mode("overwrite").parquet(path)
        return spark.read.schema(df.schema).parquet(path)
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    df.write.format("parquet").option("path", path).bucketBy(buckets, by).saveAsTable(table)
    return spark.table(table)


def drop_shuffles(spark: SparkSession) -> None:
    """Have the files deleted that finished jobs shuffled; else they stay until the driver happens to collect its garbage.

    Spark deletes them when nothing on the driver refers to the job's plan any
    more; the events of a finished job do until its listeners have read them.
    """
    with suppress(Py4JError):  # listeners that take longer keep the files a little longer
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(10_000)
    for _ in range(2):
        gc.collect()
        spark.sparkContext._jvm.System.gc()


def release_scratch(spark: SparkSession, since: int = 0) -> None:
    """Delete the tables that ``materialize`` wrote in this session (from the ``since``-th on); frames on them end."""
    found = _scratch.get(spark.sparkContext.applicationId, [])
    while len(found) > since:
        _delete(spark, *found.pop())


def release(df: DataFrame) -> None:
    """Delete the tables that ``df`` reads of those that ``materialize`` wrote in this session."""
    files = df.inputFiles()
    found = _scratch.get(df.sparkSession.sparkContext.applicationId, [])
    for one in [x for x in found if any(f"/{x[0].rpartition('/')[2]}/" in f for f in files)]:
        found.remove(one)
        _delete(df.sparkSession, *one)


def _delete(spark: SparkSession, path: str, table: str | None) -> None:
    if table:
        spark.sql(f"DROP TABLE IF EXISTS {table}")
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


@contextmanager
def scratch_of(spark: SparkSession) -> Iterator[None]:
    """Release what ``materialize`` writes inside; for work whose result is written out inside, too."""
    since = len(_scratch.get(spark.sparkContext.applicationId, []))
    try:
        yield
    finally:
        release_scratch(spark, since)
