"""Atomic replacement of snapshots in a folder of Parquet files.

A write goes to a folder of its own, ``data/<id>``, that no reader looks at.
Then one small commit record, ``_commits/<version>.json``, says for every
snapshot which folder holds it: those of the write in the new folder, all
others where they were.  Readers follow the record of the highest version, so
they see all snapshots of a write or none, and a write that fails half-way
leaves the table as it was.  A record appears by a rename that fails if the
version is taken; the later of two writers then puts its snapshots on top of
the other's.  ``expire`` deletes folders that no kept record names.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

COMMITS, DATA = "_commits", "data"
WHOLE = ""


class _Folder:
    """The files of a table by Hadoop's file system, as Spark sees them."""

    def __init__(self, spark: SparkSession, path: str):
        self.jvm, self.path = spark.sparkContext._jvm, path.rstrip("/")
        self.conf = spark.sparkContext._jsc.hadoopConfiguration()
        self.fs = self._path().getFileSystem(self.conf)

    def _path(self, name: str = ""):
        return self.jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)

    def names(self, name: str) -> list[str]:
        at = self._path(name)
        return sorted(x.getPath().getName() for x in self.fs.listStatus(at)) if self.fs.exists(at) else []

    def read(self, name: str) -> str:
        stream = self.fs.open(self._path(name))
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def write(self, name: str, text: str) -> bool:
        """Whether the file is now there with this text; False if there was one of this name."""
        draft = f"{COMMITS}/.{uuid.uuid4().hex}"
        stream = self.fs.create(self._path(draft), False)
        stream.write(bytearray(text.encode()))
        stream.close()
        if self.fs.exists(self._path(name)) or not self.fs.rename(self._path(draft), self._path(name)):
            self.fs.delete(self._path(draft), False)
            return False
        return True

    def delete(self, name: str) -> None:
        self.fs.delete(self._path(name), True)


def _versions(folder: _Folder) -> list[int]:
    return sorted(int(x[:-5]) for x in folder.names(COMMITS) if x.endswith(".json") and x[:-5].isdigit())


def _record(folder: _Folder, version: int) -> dict:
    return json.loads(folder.read(f"{COMMITS}/{version:020d}.json"))


def is_published(spark: SparkSession, path: str) -> bool:
    return bool(_versions(_Folder(spark, path)))


def latest(spark: SparkSession, path: str) -> dict | None:
    """The newest commit record: ``schema``, ``column``, ``snapshots`` (name -> folder) and ``notes``."""
    folder = _Folder(spark, path)
    versions = _versions(folder)
    return _record(folder, versions[-1]) if versions else None


def publish(df: DataFrame, path: str, column: str | None, order: list[str] = (), notes: dict | None = None,
            ranged: bool = False) -> int:
    """Replace the snapshots in ``df``, values of ``column``, and return the new version; without a column the whole table.

    Files hold ranges of (``column``, ``order``), sorted.  The rows of a frame that is ``ranged`` are dealt so already
    and only sorted.  ``notes`` are kept in the record on top of earlier ones.
    """
    spark = df.sparkSession
    folder, name = _Folder(spark, path), f"{DATA}/{uuid.uuid4().hex}"
    keys = [F.col(c) for c in ([column] if column else []) + list(order)]
    if keys:
        df = (df if ranged else df.repartitionByRange(*keys)).sortWithinPartitions(*keys)
    writer = df.write.partitionBy(column) if column else df.write
    writer.parquet(f"{folder.path}/{name}")
    new = {x: name for x in folder.names(name) if "=" in x} if column else {WHOLE: name}
    while True:
        versions = _versions(folder)
        old = _record(folder, versions[-1]) if versions else {"snapshots": {}, "notes": {}}
        kept = old["snapshots"] if column and old.get("column") == column else {}
        record = {"schema": df.schema.jsonValue(), "column": column, "snapshots": kept | new,
                  "notes": old["notes"] | (notes or {})}
        version = versions[-1] + 1 if versions else 1
        if folder.write(f"{COMMITS}/{version:020d}.json", json.dumps(record)):
            return version


def read_published(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """The table as of a commit record, by default the newest."""
    folder = _Folder(spark, path)
    record = _record(folder, version or _versions(folder)[-1])
    schema, by_folder = StructType.fromJson(record["schema"]), {}
    for snapshot, name in record["snapshots"].items():
        by_folder.setdefault(name, []).append(snapshot)
    found = spark.createDataFrame([], schema) if not by_folder else None
    for name, snapshots in sorted(by_folder.items()):
        base = f"{folder.path}/{name}"
        part = spark.read.schema(schema).option("basePath", base).parquet(*[f"{base}/{s}" if s else base for s in snapshots])
        part = part.select(*schema.names)
        found = part if found is None else found.unionByName(part)
    return found


def expire(spark: SparkSession, path: str, keep: int = 2) -> None:
    """Delete the commit records but the newest ``keep``, and the folders that none of those names."""
    folder = _Folder(spark, path)
    versions = _versions(folder)
    live = {f for v in versions[-keep:] for f in _record(folder, v)["snapshots"].values()}
    for v in versions[:-keep]:
        folder.delete(f"{COMMITS}/{v:020d}.json")
    for name in folder.names(DATA):
        if f"{DATA}/{name}" not in live:
            folder.delete(f"{DATA}/{name}")
