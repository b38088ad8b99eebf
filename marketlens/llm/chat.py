"""Chat formatting after collapsing cumulative snapshots.

A logged conversation is often a prefix of a later log of the same one.  Every
turn gets a rolling hash of all turns up to it.  A conversation whose last
hash is some longer conversation's hash at the same turn is a prefix of it; an
anti-join retains those that are not, equal ones once, and these are rendered.

DataFrame and SQL functions only.  The rolling hash is a running XOR of turn
hashes that hold the turn's rank, so it can be put together from blocks of
turns: a conversation with a third of all turns is many windows, not one, if
its turn numbers differ.  Null and repeated numbers of a conversation are
ordered in one window.

``chunks`` renders a conversation in pieces of a bounded number of turns.
``collapse`` returns it as one text, which is made in one task and must stay
under 2 GB, the size of a cell.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from marketlens.llm.shared import stored, table

BLOCK = 1024
OPEN, MIDDLE, CLOSE = "<|", "|>\n", "\n"


def ranked_turns(turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role",
                 text: str = "text", block: int = BLOCK) -> DataFrame:
    """(__conv, __rank, __role, __text, __h1, __h2): turns by rank, and the hash of all turns up to each.

    Turns are ordered by number, nulls last, then by role and text.  Windows
    run over blocks of turn numbers first and over the blocks' totals then.
    """
    rows = turns.select(F.col(conv_id).alias("__conv"), F.col(turn).cast("long").alias("__turn"),
                        F.col(role).cast("string").alias("__role"), F.col(text).cast("string").alias("__text"))
    rows = rows.withColumn("__block", F.expr(f"coalesce(__turn div {block}, 9223372036854775807)"))
    within = Window.partitionBy("__conv", "__block").orderBy(
        F.col("__turn").asc_nulls_last(), F.col("__role").asc_nulls_last(), F.col("__text").asc_nulls_last())
    rows = rows.withColumn("__rank", F.row_number().over(within).cast("long"))
    totals = rows.groupBy("__conv", "__block").agg(F.count(F.lit(1)).alias("__n"))
    earlier = Window.partitionBy("__conv").orderBy("__block").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.withColumn("__before", F.coalesce(F.sum("__n").over(earlier), F.lit(0))).drop("__n")
    a, b = rows.alias("a"), totals.alias("b")
    rows = a.join(b, F.col("a.__conv").eqNullSafe(F.col("b.__conv")) & (F.col("a.__block") == F.col("b.__block"))).select(
        "a.__conv", "a.__block", (F.col("__rank") + F.col("__before")).alias("__rank"), "__role", "__text")
    own = [F.lit("rank"), F.col("__rank"), F.col("__role").isNull(), F.col("__role"), F.col("__text").isNull(), F.col("__text")]
    rows = rows.withColumn("__x1", F.xxhash64(*own)).withColumn("__x2", F.xxhash64(F.lit(2), *own[::-1]))
    up_to = Window.partitionBy("__conv", "__block").orderBy("__rank").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumns({"__x1": F.bit_xor("__x1").over(up_to), "__x2": F.bit_xor("__x2").over(up_to)})
    sums = rows.groupBy("__conv", "__block").agg(F.max_by(F.struct("__x1", "__x2"), "__rank").alias("__x"))
    sums = sums.select("__conv", "__block", F.bit_xor("__x.__x1").over(earlier).alias("__b1"),
                       F.bit_xor("__x.__x2").over(earlier).alias("__b2"))
    a, b = rows.alias("a"), sums.alias("b")
    joined = a.join(b, F.col("a.__conv").eqNullSafe(F.col("b.__conv")) & (F.col("a.__block") == F.col("b.__block")))
    put = lambda x, y: x.bitwiseXOR(F.coalesce(y, F.lit(0).cast("long")))
    return joined.select("a.__conv", "__rank", "__role", "__text", put(F.col("__x1"), F.col("__b1")).alias("__h1"),
                         put(F.col("__x2"), F.col("__b2")).alias("__h2"))


def _maximal(turns: DataFrame, conv_id: str, turn: str, role: str, text: str, block: int) -> DataFrame:
    """(__conv, n_turns, n_collapsed, __rank, line): the rendered turns of the maximal conversations."""
    rows = stored(ranked_turns(turns, conv_id, turn, role, text, block), "turns")
    key = ["__rank", "__h1", "__h2"]
    whole = rows.groupBy("__conv").agg(F.max_by(F.struct(*key), "__rank").alias("k")).select("__conv", "k.*")
    distinct = whole.groupBy(*key).agg(F.min(F.struct(F.col("__conv").isNotNull().alias("o"), F.col("__conv").alias("c"))).alias("__first"),
                                       F.count(F.lit(1)).alias("n_collapsed"))
    lasts = whole.select("__conv", F.col("__rank").alias("__last"))
    a, b = rows.alias("a"), lasts.alias("b")
    prefixes = (a.join(b, F.col("a.__conv").eqNullSafe(F.col("b.__conv"))).where("__rank < __last")
                .select(*key).distinct())
    kept = stored(distinct.join(prefixes, key, "left_anti").select(
        F.col("__first.c").alias("__kept"), F.col("__rank").alias("n_turns"), "n_collapsed"), "kept-conversations")
    line = F.concat(F.lit(OPEN), F.coalesce("__role", F.lit("")), F.lit(MIDDLE), F.coalesce("__text", F.lit("")), F.lit(CLOSE))
    return rows.join(kept, F.col("__conv").eqNullSafe(F.col("__kept"))).withColumn("line", line)


def _texts(said: DataFrame, *by: str) -> DataFrame:
    """The lines of each group in one text, by rank."""
    lines = said.groupBy(*by).agg(F.array_sort(F.collect_list(F.struct("__rank", "line"))).alias("__lines"))
    return lines.withColumn("rendered", F.array_join(F.transform("__lines", lambda x: x.line), "")).drop("__lines")


def chunks(turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
           block: int = BLOCK) -> DataFrame:
    """(``conv_id``, chunk, n_turns, n_collapsed, rendered): the maximal conversations in pieces of ``block`` turns.

    The pieces of a conversation, joined in order from chunk 0 on, are the
    text of ``collapse``.
    """
    said = _maximal(turns, conv_id, turn, role, text, block).withColumn("chunk", F.expr(f"(__rank - 1) div {block}"))
    found = _texts(said, "__conv", "chunk", "n_turns", "n_collapsed")
    return found.select(F.col("__conv").alias(conv_id), "chunk", "n_turns", "n_collapsed", "rendered")


def collapse(turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
             block: int = BLOCK) -> DataFrame:
    """(``conv_id``, n_turns, n_collapsed, rendered): the maximal conversations.

    ``n_collapsed`` is the number of equal conversations it stands for, itself
    included; among them the smallest id stays.  Null roles and texts are
    values of their own and render as empty.  Rows with a null conversation id
    are one conversation, smallest of all.  Rows that repeat a turn are turns
    of their own, in order of role and text.
    """
    found = _texts(_maximal(turns, conv_id, turn, role, text, block), "__conv", "n_turns", "n_collapsed")
    return found.select(F.col("__conv").alias(conv_id), "n_turns", "n_collapsed", "rendered")


def op3_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The maximal conversations, rendered."""
    return collapse(table(spark, sf_dir, "conversations")).select(
        "conv_id", "n_turns", "n_collapsed", F.length("rendered").cast("long").alias("n_chars"),
        F.sha2("rendered", 256).alias("rendered_sha256"))


OP3_SQL = """
WITH t AS (
  SELECT conv_id, row_number() OVER w AS rank, coalesce(role, '') AS role, coalesce(text, '') AS text,
    CASE WHEN role IS NULL THEN 'n' ELSE 'r' || length(role) || ':' || role END ||
    CASE WHEN text IS NULL THEN 'n' ELSE 't' || length(text) || ':' || text END AS said
  FROM conversations
  WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS LAST, role NULLS LAST, text NULLS LAST)),
p AS (SELECT conv_id, rank, max(rank) OVER (PARTITION BY conv_id) AS n,
        string_agg(said, chr(1)) OVER (PARTITION BY conv_id ORDER BY rank) AS prefix FROM t),
k AS (SELECT prefix, min(conv_id) AS conv_id, count(*) AS n_collapsed, any_value(n) AS n_turns FROM p WHERE rank = n GROUP BY prefix),
m AS (SELECT * FROM k WHERE prefix NOT IN (SELECT prefix FROM p WHERE rank < n)),
r AS (SELECT conv_id, string_agg('<|' || role || '|>' || chr(10) || text || chr(10), '' ORDER BY rank) AS rendered FROM t GROUP BY conv_id)
SELECT m.conv_id, n_turns::BIGINT AS n_turns, n_collapsed::BIGINT AS n_collapsed, length(rendered)::BIGINT AS n_chars,
  sha256(rendered) AS rendered_sha256 FROM m JOIN r USING (conv_id)
"""
