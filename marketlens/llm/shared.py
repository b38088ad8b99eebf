"""Reading the tables, and intermediate tables in the folder that all executors share."""

from __future__ import annotations

import functools
import re
import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One given table."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``, else the context's checkpoint folder.

    Only a local session, whose executors are this process, may go without
    one and gets a temporary folder; a cluster session without one is an error.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not re.match(r"local(\[|$)", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="marketlens-llm-"))
    return spark.sparkContext.getCheckpointDir().rstrip("/")


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/llm/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write a relation once to the shared folder and read it back: a lineage cut that outlives executors."""
    path = fresh_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased, every other character as it is."""
    return F.when(F.length(text) == F.octet_length(text), F.lower(text)).otherwise(
        F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))


def any_names(operator: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """Let the first argument of ``operator`` have columns whose names begin with two underscores, as the library's own do.

    They pass under other names and get their own back; one named as a
    column that the operator adds is replaced by it.
    """
    @functools.wraps(operator)
    def called(docs: DataFrame, *args, **options) -> DataFrame:
        away = {c: f"in_{uuid.uuid4().hex}" for c in docs.columns if c.startswith("__")}
        if not away:
            return operator(docs, *args, **options)

        def named(value):
            return away.get(value, value) if isinstance(value, str) else value

        found = operator(docs.withColumnsRenamed(away), *map(named, args), **{k: named(v) for k, v in options.items()})
        added = {c.lower() for c in found.columns}
        found = found.drop(*(new for old, new in away.items() if old.lower() in added))
        return found.withColumnsRenamed({new: old for old, new in away.items()})
    return called
