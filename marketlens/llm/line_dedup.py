"""Line dedup with levelled sorted runs of line hashes.

Every document line of a minimal length is reduced to a 128-bit hash of its
key (the line stripped of ASCII white space, A-Z lower-cased).  A batch of
documents is one row per hash, with the number of documents that hold it and
the largest of their ids.  The batch merge-anti-joins the runs: hashes that no
run holds are written as a new *run*, those that one holds as a *delta* to
its counts.  ``LineRuns`` keeps runs in levels; when a level has ``fanout``
runs they and their deltas are compacted into one run of the next level.
Batches, runs and deltas are tables bucketed and sorted by the hash, so the
joins merge them bucket by bucket without moving a row.  ``drop_shared_lines``
applies the corpus rule: a line found in at least ``min_docs`` documents stays
in the largest id only.

DataFrame and SQL functions only.  Hot lines are counted by partial
aggregates; a hash has one row in a table, so no bucket is skewed by one.  The
join that finds the lines to drop is split by adaptive execution.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlens.llm.shared import any_names, ascii_lower, fresh_path, stored, table

MIN_CHARS = 40
MIN_DOCS = 5
BATCHES = 4
FANOUT = 3
BLANKS = " \t\n\x0b\x0c\r"
HASH = ["__h1", "__h2"]


def line_key(line: Column) -> Column:
    """What makes two lines equal: ASCII white space stripped at both ends, A-Z lower-cased."""
    return ascii_lower(F.btrim(line, F.lit(BLANKS)))


def eligible_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                   min_chars: int = MIN_CHARS) -> DataFrame:
    """(__doc, __th, __pos, __h1, __h2): the lines whose key has at least ``min_chars`` code points.

    ``__th`` is the hash of the whole text: with the id it names the row, so
    rows that repeat an id keep their own line numbers.
    """
    whole = F.coalesce(F.col(text).cast("string"), F.lit(""))
    rows = docs.select(F.col(doc_id).alias("__doc"), F.xxhash64(whole).alias("__th"),
                       F.posexplode(F.split(whole, "\n")).alias("__pos", "__line"))
    key = F.col("__key")
    return (rows.select("__doc", "__th", "__pos", line_key(F.col("__line")).alias("__key"))
            .where(F.length(key) >= min_chars)
            .select("__doc", "__th", "__pos", F.xxhash64(key).alias("__h1"),
                    F.xxhash64(F.lit(1), key, F.lit(2)).alias("__h2")))


class LineRuns:
    """Levelled sorted runs of line hashes, tables in one folder of the shared store.

    Rows are (__h1, __h2, n_docs, last_doc).  Batches must not share
    documents: counts are added.  A table is written whole before it is listed,
    so a lost executor or a repeated write leaves no half run.  ``buckets`` is
    the session's number of shuffle partitions, with which a batch is grouped.
    """

    def __init__(self, spark: SparkSession, path: str | None = None, fanout: int = FANOUT):
        self.spark, self.fanout = spark, fanout
        self.path = path or fresh_path(spark, "line-runs")
        self.name = f"line_runs_{uuid.uuid4().hex}"
        self.buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        #: Of every level its runs; of every run its table and that of the delta that came with it; the path of every table.
        self.levels: list[list[tuple[str, ...]]] = [[]]
        self.tables: dict[str, str] = {}

    def _write(self, rows: DataFrame) -> str:
        name = f"{self.name}_{len(self.tables)}"
        self.tables[name] = f"{self.path}/{len(self.tables)}"
        (rows.write.format("parquet").option("path", self.tables[name]).option("compression", "zstd")
         .bucketBy(self.buckets, *HASH).sortBy(*HASH).saveAsTable(name))
        return name

    def _rows(self, runs: list[tuple[str, ...]]) -> DataFrame | None:
        # By path: a union of bucketed tables is taken for one bucketed table by some releases, and not grouped anew.
        paths = [self.tables[name] for run in runs for name in run]
        return self.spark.read.schema(self.spark.table(runs[0][0]).schema).parquet(*paths) if paths else None

    def _unseen(self, rows: DataFrame) -> DataFrame:
        """The rows whose hash no run holds: a merge-anti-join with each of them."""
        for level in self.levels:
            for run, *_ in level:
                rows = rows.join(self.spark.table(run).select(*HASH).hint("merge"), HASH, "left_anti")
        return rows

    def rows(self) -> DataFrame | None:
        """The rows of all runs and deltas."""
        return self._rows([run for level in self.levels for run in level])

    def add(self, lines: DataFrame) -> None:
        """Add a batch of ``eligible_lines``: new hashes as a run of level 0, known ones as its delta; compact the levels
        that are full."""
        per_doc = lines.select(*HASH, "__doc").distinct()
        batch = per_doc.groupBy(*HASH).agg(F.count(F.lit(1)).alias("n_docs"), F.max("__doc").alias("last_doc"))
        name = self._write(batch)
        if any(self.levels):
            whole = self.spark.table(name)
            run = self._write(self._unseen(whole))
            known = whole.join(self.spark.table(run).select(*HASH).hint("merge"), HASH, "left_anti")
            self.levels[0].append((run, self._write(known)))
            self._forget(name)
        else:
            self.levels[0].append((name,))
        level = 0
        while len(self.levels[level]) >= self.fanout:
            if level + 1 == len(self.levels):
                self.levels.append([])
            full, self.levels[level] = self.levels[level], []
            self.levels[level + 1].append((self._write(self._merged(self._rows(full))),))
            for name in (name for run in full for name in run):
                self._forget(name)
            level += 1

    def _forget(self, name: str) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {name}")

    def forget(self) -> None:
        """Take the tables out of the catalog; their files stay in the shared folder."""
        for name in self.tables:
            self._forget(name)

    @staticmethod
    def _merged(rows: DataFrame) -> DataFrame:
        return rows.groupBy(*HASH).agg(F.sum("n_docs").alias("n_docs"), F.max("last_doc").alias("last_doc"))

    def fresh_lines(self, lines: DataFrame) -> DataFrame:
        """Lines of a batch that no run holds yet."""
        return self._unseen(lines)

    def shared(self, min_docs: int = MIN_DOCS) -> DataFrame:
        """Hashes found in at least ``min_docs`` documents, over all runs and deltas."""
        return self._merged(self.rows()).where(F.col("n_docs") >= min_docs)


@any_names
def drop_shared_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_chars: int = MIN_CHARS,
                      min_docs: int = MIN_DOCS, batches: int = BATCHES, fanout: int = FANOUT) -> DataFrame:
    """Drop the lines that many documents share, except in the largest id holding each.

    Returns every row and column of ``docs`` and ``__n_lines`` (lines before),
    ``__n_dropped``, ``__kept_text``.  The documents are dealt into ``batches``
    by a hash of the id; each batch adds a run.

    Null or empty texts are one empty line.  Rows with the same id are one
    document for counting.  Null ids are one document, and never the largest
    where another id holds the line.  Repeated rows stay and lose the same
    lines.  An empty table gives an empty result.  Columns of any name pass,
    but one named as a result column is replaced by it.
    """
    lines = eligible_lines(docs, doc_id, text, min_chars)
    lines = lines.withColumn("__batch", F.pmod(F.xxhash64("__doc"), F.lit(batches)).cast("int"))
    lines = stored(lines, "lines")
    runs = LineRuns(docs.sparkSession, fanout=fanout)
    for k in range(batches):
        runs.add(lines.where(F.col("__batch") == k))
    shared = stored(runs.shared(min_docs).select(*HASH, "last_doc"), "shared-lines")
    runs.forget()
    loses = ~F.col("__doc").eqNullSafe(F.col("last_doc"))
    drops = (lines.join(shared, HASH).where(loses)
             .groupBy(F.col("__doc").alias("__drop_doc"), F.col("__th").alias("__drop_th"))
             .agg(F.collect_set("__pos").alias("__drop")))
    whole = F.coalesce(F.col(text).cast("string"), F.lit(""))
    rows = docs.withColumn("__th", F.xxhash64(whole))
    rows = rows.join(drops.hint("shuffle_hash"), F.col(doc_id).eqNullSafe(F.col("__drop_doc"))
                     & (F.col("__th") == F.col("__drop_th")), "left")
    split = F.split(whole, "\n")
    left = F.array_except(F.sequence(F.lit(0), F.col("__n_lines").cast("int") - 1), F.col("__drop"))
    kept = F.array_join(F.transform(left, lambda p: F.get(split, p)), "\n")
    return (rows.withColumn("__n_lines", F.size(split).cast("long"))
            .withColumn("__n_dropped", F.coalesce(F.size("__drop"), F.lit(0)).cast("long"))
            .withColumn("__kept_text", F.when(F.col("__drop").isNull(), whole).otherwise(kept))
            .drop("__th", "__drop_doc", "__drop_th", "__drop"))


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: lines before, lines dropped, hash of the kept text."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return drop_shared_lines(docs).select(
        "doc_id", F.col("__n_lines").alias("n_lines"), F.col("__n_dropped").alias("n_dropped"),
        F.sha2("__kept_text", 256).alias("kept_sha256"))


OP8_SQL = """
WITH l AS (
  SELECT doc_id, generate_subscripts(ls, 1) AS pos, unnest(ls) AS line
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents)),
k AS (SELECT doc_id, pos, line,
  translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
s AS (SELECT key, max(doc_id) AS last_doc FROM k WHERE length(key) >= 40
      GROUP BY key HAVING count(DISTINCT doc_id) >= 5),
m AS (SELECT k.*, s.key IS NOT NULL AND k.doc_id <> s.last_doc AS gone FROM k LEFT JOIN s USING (key))
SELECT doc_id, count(*)::BIGINT AS n_lines, (count(*) FILTER (WHERE gone))::BIGINT AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM m GROUP BY doc_id
"""
