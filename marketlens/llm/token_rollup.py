"""Token counts as delta-maintained rollups.

Totals of documents and tokens by source, language and tokenizer version are
never recounted: inserted documents add their counts, deleted ones subtract
them, and a revised count subtracts the old and adds the new.  A batch of
changes is aggregated to one signed row a group and committed under an id; a
batch that is committed already, or was half written before a failure, can be
sent again without counting twice.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlens.llm.shared import fresh_path, stored, table

BATCHES = 4
GROUP = ["source", "lang", "tokenizer"]
TOTALS = "source string, lang string, tokenizer string, n_docs long, n_tokens long"
#: Tokenizers that are patterns: a token is a match.
PATTERNS = {
    "words-1": r"[^\x20\x09-\x0D]+",
    "words-2": r"[0-9A-Za-z\x{80}-\x{10FFFF}]+|[!-/:-@\[-`{-~]",
}


def _encode(path: str, column: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        tokenizer.encode_special_tokens = True
        for batch in batches:
            counts: list[int] = []
            for a in range(0, len(batch), 64):
                texts = [t or "" for t in batch.column(column).slice(a, 64).to_pylist()]
                counts += [len(e.ids) for e in tokenizer.encode_batch(texts, add_special_tokens=False)]
            rest = [batch.column(c) for c in range(batch.num_columns) if c != column]
            names = [n for i, n in enumerate(batch.schema.names) if i != column]
            yield pa.RecordBatch.from_arrays([*rest, pa.array(counts, pa.int64())], names=[*names, "n_tokens"])
    return run


def pattern_tokens(text: Column, tokenizer: str) -> Column:
    """Number of tokens of a pattern tokenizer; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(PATTERNS[tokenizer])), F.lit(0)).cast("long")


def vocabulary_tokens(docs: DataFrame, path: str, text: str = "text") -> DataFrame:
    """``docs`` with ``n_tokens`` in place of the text, by the tokenizer file at ``path`` (the same on all executors)."""
    from pyspark.sql.types import LongType, StructField, StructType

    schema = StructType([f for f in docs.schema.fields if f.name != text] + [StructField("n_tokens", LongType())])
    return docs.mapInArrow(_encode(path, docs.columns.index(text)), schema)


def inserts(counts: DataFrame) -> DataFrame:
    """Changes of documents that come; ``counts`` has the group's columns and ``n_tokens``, one row a document."""
    return counts.select(*GROUP, F.lit(1).cast("long").alias("n_docs"), F.col("n_tokens").cast("long").alias("n_tokens"))


def deletes(counts: DataFrame) -> DataFrame:
    """Changes of documents that go, with the counts they came with."""
    return inserts(counts).withColumns({"n_docs": -F.col("n_docs"), "n_tokens": -F.col("n_tokens")})


def revisions(old: DataFrame, new: DataFrame) -> DataFrame:
    """Changes of documents whose counts, tokenizer or group are new."""
    return deletes(old).unionByName(inserts(new))


class TokenRollup:
    """Totals in one folder of the shared store: a table of signed rows for each batch, and a log of committed ids.

    A batch's table is written first and overwritten by any retry; the batch
    counts once its id is in the log.  One writer at a time.  ``compact``
    folds committed batches into one table, and their ids stay known.
    """

    def __init__(self, spark: SparkSession, path: str | None = None):
        self.spark, self.path = spark, path or fresh_path(spark, "token-rollup")

    def _log(self) -> list[dict]:
        try:
            log = self.spark.read.schema("id string, stored string").parquet(f"{self.path}/log")
        except Exception as e:  # no batch yet
            if "PATH_NOT_FOUND" not in str(e):
                raise
            return []
        return [r.asDict() for r in log.collect()]  # a row a batch

    def commit(self, batch_id: str, changes: DataFrame) -> bool:
        """Add a batch; False if it was committed before."""
        if any(r["id"] == batch_id for r in self._log()):
            return False
        self._write(batch_id, self._sums(changes), [batch_id])
        return True

    def _write(self, name: str, rows: DataFrame, ids: list[str]) -> None:
        rows.write.mode("overwrite").option("compression", "zstd").parquet(f"{self.path}/batch={name}")
        log = self.spark.createDataFrame([(i, name) for i in ids], "id string, stored string")
        log.coalesce(1).write.mode("append").parquet(f"{self.path}/log")

    @staticmethod
    def _sums(rows: DataFrame) -> DataFrame:
        sums = rows.groupBy(*GROUP).agg(F.sum("n_docs").alias("n_docs"), F.sum("n_tokens").alias("n_tokens"))
        return sums.where((F.col("n_docs") != 0) | (F.col("n_tokens") != 0))

    def totals(self) -> DataFrame:
        """The current totals; groups that are back at zero have no row."""
        log = self._log()
        folded = {r["id"] for r in log if r["id"] != r["stored"]}  # by the last compaction that holds them
        last = max((r["stored"] for r in log if r["id"] != r["stored"]), default=None)
        held = {r["id"] for r in log if r["stored"] == last}
        names = ([last] if last else []) + sorted({r["id"] for r in log if r["id"] == r["stored"]} - folded - held)
        if not names:
            return self.spark.createDataFrame([], TOTALS)
        return self._sums(self.spark.read.schema(TOTALS).parquet(*[f"{self.path}/batch={n}" for n in names]))

    def compact(self) -> None:
        """Fold all committed batches into one table."""
        log = self._log()
        ids = sorted({r["id"] for r in log})
        if ids:
            generation = len({r["stored"] for r in log if r["id"] != r["stored"]})
            self._write(f"~compact-{generation:09d}", self.totals(), ids)


def op6_token_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rollup after the load of all documents, the removal of those of low quality and a new tokenizer version for
    those of high quality, with every batch sent twice.

    Null sources and languages are groups of their own; null texts have no
    tokens; a document's labels are its largest.
    """
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "lang", "text")
    marks = table(spark, sf_dir, "labels").groupBy("doc_id").agg(F.max("quality").alias("quality"))
    counted = docs.select("doc_id", "source", "lang", *[pattern_tokens(F.col("text"), t).alias(t) for t in PATTERNS])
    counted = stored(counted.join(marks, "doc_id", "left"), "token-counts")

    def by(rows: DataFrame, tokenizer: str) -> DataFrame:
        return rows.select("source", "lang", F.lit(tokenizer).alias("tokenizer"), F.col(tokenizer).alias("n_tokens"))

    rollup = TokenRollup(spark)
    batch = F.pmod(F.xxhash64("doc_id"), F.lit(BATCHES))
    low, high = counted.where("quality = 0"), counted.where("quality = 1")
    sent = {f"load-{k}": inserts(by(counted.where(batch == k), "words-1")) for k in range(BATCHES)}
    sent |= {"low-quality": deletes(by(low, "words-1")), "retokenized": revisions(by(high, "words-1"), by(high, "words-2"))}
    for _ in range(2):
        for name, changes in sent.items():
            rollup.commit(name, changes)
        rollup.compact()
    return rollup.totals()


OP6_SQL = r"""
WITH m AS (SELECT doc_id, max(quality) AS quality FROM labels GROUP BY doc_id),
c AS (
  SELECT source, lang, CASE WHEN quality = 1 THEN 'words-2' ELSE 'words-1' END AS tokenizer,
    coalesce(len(regexp_extract_all(text, CASE WHEN quality = 1 THEN '[0-9A-Za-z\x{80}-\x{10FFFF}]+|[!-/:-@\[-`{-~]'
                                           ELSE '[^\x20\x09-\x0D]+' END)), 0) AS n
  FROM documents LEFT JOIN m USING (doc_id) WHERE quality IS DISTINCT FROM 0)
SELECT source, lang, tokenizer, count(*)::BIGINT AS n_docs, sum(n)::BIGINT AS n_tokens FROM c GROUP BY ALL
"""
