"""A training corpus from the documents table, in stages.

Every stage takes (spark, docs, sf_dir), works on all rows it gets and returns
a DataFrame; each stage's rows are written to the shared folder and reread by
the next.  All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlens.llm import decontaminate, language_id, line_dedup, lsh_forest, mixing
from marketlens.llm.shared import stored, table


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Language ID: documents in which no language can be read (no text, no letters) go."""
    return language_id.keep_identified(docs, language_id.fit(docs))


def drop_shared_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Line dedup: lines that five documents or more share stay in the largest id only."""
    found = line_dedup.drop_shared_lines(docs)
    found = found.withColumns({"text": F.col("__kept_text"), "n_chars": F.length("__kept_text").cast(docs.schema["n_chars"].dataType)})
    return found.select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """MinHash near-dedup: five-word shingles, similarity of 0.8 or more; the smallest id of a group stays."""
    return lsh_forest.drop_near_duplicates(docs)


def decontaminate_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark decontamination: documents with a benchmark window of ten words go."""
    return decontaminate.remove_leaks(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Mixing: how many words of each document the mix takes, sources weighing 5, 2, 1, repeating."""
    return mixing.mix(docs, mixing.cycled_weights(docs))


STAGES = [
    ("language_id", identify_language),
    ("line_dedup", drop_shared_lines),
    ("near_dedup", drop_near_duplicates),
    ("decontamination", decontaminate_documents),
    ("mixing", mix_sources),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, applied to documents."""
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = stored(docs, f"pipeline-{name}")
    return docs


ORACLE_SQL = r"""
WITH RECURSIVE d1 AS (SELECT doc_id, source, text FROM documents WHERE regexp_matches(text, '\p{L}')),
l AS (SELECT doc_id, source, generate_subscripts(ls, 1) AS pos, unnest(ls) AS line
      FROM (SELECT doc_id, source, string_split(text, chr(10)) AS ls FROM d1)),
lk AS (SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
ls AS (SELECT key, max(doc_id) AS last_doc FROM lk WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT doc_id) >= 5),
d2 AS (SELECT doc_id, any_value(source) AS source,
         coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE ls.key IS NULL OR doc_id = last_doc), '') AS text
       FROM lk LEFT JOIN ls USING (key) GROUP BY doc_id),
s AS (SELECT doc_id, CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
        ELSE list_distinct(list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' '))) END AS ss
      FROM (SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM d2)),
c AS (SELECT list_sort(ss) AS ss, min(doc_id) AS rep, any_value(len(ss)) AS n FROM s WHERE len(ss) > 0 GROUP BY list_sort(s.ss)),
x AS (SELECT rep, n, unnest(ss) AS sh FROM c),
e AS (SELECT a.rep AS u, b.rep AS v FROM x a JOIN x b ON a.sh = b.sh AND a.rep <> b.rep
        AND 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n)
      GROUP BY a.rep, b.rep, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))),
r AS (SELECT rep AS node, rep AS reach FROM c UNION SELECT r.node, e.v FROM r JOIN e ON r.reach = e.u),
d3 AS (SELECT d2.* FROM d2 JOIN s USING (doc_id) WHERE len(s.ss) = 0
       OR doc_id IN (SELECT node FROM r GROUP BY node HAVING min(reach) = node)),
b AS (SELECT ws, least(10, len(ws)) AS k FROM (
        SELECT regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark) WHERE len(ws) > 0),
g AS (SELECT DISTINCT k, array_to_string(ws[i:i + k - 1], ' ') AS g FROM (SELECT ws, k, unnest(range(1, len(ws) - k + 2)) AS i FROM b)),
w AS (SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM d3),
hit AS (SELECT DISTINCT doc_id FROM (
          SELECT doc_id, k, array_to_string(ws[i:i + k - 1], ' ') AS g
          FROM (SELECT doc_id, ws, k, unnest(range(1, len(ws) - k + 2)) AS i FROM w, (SELECT DISTINCT k FROM b) WHERE len(ws) >= k))
        JOIN g USING (k, g)),
d4 AS (SELECT doc_id, source, len(regexp_extract_all(text, '[^\x20\x09-\x0D]+'))::BIGINT AS size, md5('17:' || doc_id::VARCHAR) AS h
       FROM d3 WHERE doc_id NOT IN (SELECT doc_id FROM hit)),
so AS (SELECT source, sum(size)::HUGEINT AS source_size,
         CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS w
       FROM d4 GROUP BY source),
o AS (SELECT *, (SELECT sum(source_size) FROM so) AS total,
        row_number() OVER (ORDER BY source_size::DOUBLE / w, source NULLS LAST) AS r FROM so),
f AS (SELECT *, total - 3 * coalesce(sum(source_size) OVER (ORDER BY r ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS rest,
        sum(w) OVER (ORDER BY r ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS share FROM o),
ca AS (SELECT *, rest * w > 3 * source_size * share AS capped FROM f),
fr AS (SELECT rest, share FROM ca WHERE NOT capped ORDER BY r LIMIT 1),
t AS (SELECT ca.source, source_size, CASE WHEN capped THEN 3 * source_size ELSE ca.w * fr.rest END AS num,
        CASE WHEN capped THEN 1 ELSE fr.share END AS den FROM ca, fr),
ep AS (SELECT *, CASE WHEN source_size > 0 THEN num // (den * source_size) ELSE 0 END AS epochs FROM t),
y AS (SELECT d4.*, ep.source_size, ep.num::DOUBLE / ep.den::DOUBLE AS target, ep.epochs,
        ep.num // ep.den - ep.epochs * ep.source_size
          - coalesce(sum(d4.size) OVER (PARTITION BY d4.source ORDER BY d4.h, d4.size
                                        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS room
      FROM d4 JOIN ep ON d4.source IS NOT DISTINCT FROM ep.source)
SELECT doc_id, source, size, source_size::BIGINT AS source_size, target,
  (epochs * size + greatest(0, least(size, room)))::BIGINT AS taken FROM y
"""
