"""Conversation prefix trie with subtree totals by time-forward processing.

Every prefix of a conversation is a node, named by its depth and a 128-bit
hash of its turns; conversations that begin with it are its members.  Totals
over subtrees go from children to parents: the nodes of a shard are sorted by
reverse level order, and each one takes the messages of its children from a
priority queue, adds what is its own and sends the sums to its parent.  The
queue spills to disk, so a task holds a bounded part of its messages.

Shards are pieces of the trie.  A node's class is 0 up to ``SHARD`` members
and grows by one with every ``FACTOR``-fold; members only get fewer downwards,
so the nodes of one class below one node of a higher class are a connected
piece.  Class 0 is processed first, all its shards in parallel; the totals of
the shards' roots, summed by parent, are the first messages of the next class,
and so on up to the root.  There are as many rounds as classes, a number that
grows with the logarithm of the number of conversations.  A path without
branches stays in one shard: its task streams it.
"""

from __future__ import annotations

import heapq
import itertools
import struct
import tempfile
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from marketlens.llm.ranks import blocks, ranked
from marketlens.llm.shared import stored, table
from marketlens.llm.sql_text import CRC32

BLOCK = 1024
SHARD, FACTOR = 128, 64
QUEUE = 1 << 17
PIECE = 4096
HEAD = 6
NODE = ["depth", "p1", "p2"]


def turn_hashes(conversations: DataFrame) -> DataFrame:
    """(conv, rank, x1, x2, size): turns by rank, as hashes of role and text, with the text's code points.

    Turns are ordered by number, nulls first, those of one number by the
    hash.  Null roles and texts are empty.  Rows without a conversation id
    belong to no conversation.
    """
    role, text = F.coalesce(F.col("role").cast("string"), F.lit("")), F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv"), F.col("turn").cast("long").alias("turn"),
        F.xxhash64(role, text).alias("x1"), F.xxhash64(F.lit(2), text, F.lit("/"), role).alias("x2"),
        F.length(text).cast("long").alias("size"))
    order = [F.col("turn").asc_nulls_first(), F.col("x1").asc(), F.col("x2").asc()]
    return ranked(blocks(rows, "conv", order, "turns"), "conv", order).select(
        "conv", F.col("__rank").alias("rank"), "x1", "x2", "size")


def branched(turns: DataFrame, family: int = 100, head: int = HEAD) -> tuple[DataFrame, DataFrame]:
    """(conv) and (conv, rank, x1, x2, size): conversations that share the first turns of their family's first one.

    Conversation c gets the first h turns of conversation c - c % family, h
    the CRC-32 of its decimal number modulo ``head``, and its own turns after
    its first h.  A family is at most 2 * ``family`` conversations.
    """
    base, h = F.expr(f"conv - conv % {family}"), F.crc32(F.col("conv").cast("string")) % head
    convs = turns.where("rank = 1").select("conv", base.alias("base"), h.alias("h"))
    heads = turns.where((base == F.col("conv")) & (F.col("rank") < head)).select(
        F.col("conv").alias("base"), "rank", "x1", "x2", "size")
    given = heads.groupBy("base").agg(F.count(F.lit(1)).alias("given"))
    own = (turns.withColumns({"base": base, "h": h}).where(F.col("rank") > F.col("h")).join(given, "base", "left")
           .select("conv", (F.col("rank") - F.col("h") + F.least("h", F.coalesce("given", F.lit(0)))).alias("rank"),
                   "x1", "x2", "size"))
    taken = convs.join(heads, "base").where(F.col("rank") <= F.col("h")).select("conv", "rank", "x1", "x2", "size")
    return convs.select("conv"), own.unionByName(taken)


def prefixes(turns: DataFrame, block: int = BLOCK) -> DataFrame:
    """(conv, depth, p1, p2, q1, q2, size): the hash p of the turns up to each, and q of those before it.

    A running XOR of hashes that hold the turn's rank, put together from
    blocks of ranks, so a conversation of any length is many windows.
    """
    rows = turns.select("conv", F.col("rank").alias("depth"), F.xxhash64("rank", "x1", "x2").alias("y1"),
                        F.xxhash64("x2", "x1", "rank").alias("y2"), "size", F.expr(f"(rank - 1) div {block}").alias("blk"))
    up_to = Window.partitionBy("conv", "blk").orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    earlier = Window.partitionBy("conv").orderBy("blk").rowsBetween(Window.unboundedPreceding, -1)
    sums = rows.groupBy("conv", "blk").agg(F.bit_xor("y1").alias("b1"), F.bit_xor("y2").alias("b2"))
    sums = sums.select("conv", "blk", F.bit_xor("b1").over(earlier).alias("b1"), F.bit_xor("b2").over(earlier).alias("b2"))
    rows = rows.withColumns({"r1": F.bit_xor("y1").over(up_to), "r2": F.bit_xor("y2").over(up_to)})
    rows = rows.join(sums.where("b1 is not null"), ["conv", "blk"], "left")
    xor = lambda a, b: F.col(a).bitwiseXOR(F.coalesce(b, F.lit(0).cast("long")))
    rows = rows.withColumns({"p1": xor("r1", "b1"), "p2": xor("r2", "b2")})
    return rows.select("conv", *NODE, F.col("p1").bitwiseXOR(F.col("y1")).alias("q1"),
                       F.col("p2").bitwiseXOR(F.col("y2")).alias("q2"), "size")


def _class(members: Column, shard: int, factor: int) -> Column:
    """0 up to ``shard`` members, 1 up to ``shard * factor``, and so on."""
    bounds, n = [], shard
    while n < 1 << 62:
        bounds.append(n)
        n *= factor
    return sum((F.when(members > b, 1).otherwise(0) for b in bounds), F.lit(0))


class SpillingQueue:
    """A priority queue of tuples of six integers; beyond ``limit`` in memory the later half goes to a sorted file.

    Beyond ``runs`` files they are merged to one.
    """

    def __init__(self, limit: int, runs: int = 64):
        self.limit, self.most, self.heap, self.runs, self.spilled = limit, runs, [], [], 0

    def push(self, item: tuple) -> None:
        heapq.heappush(self.heap, item)
        if len(self.heap) > self.limit:
            items = sorted(self.heap)
            half = len(items) // 2
            self.heap = items[:half]
            self._spill(items[half:])

    def _spill(self, items: Iterable[tuple]) -> None:
        if len(self.runs) >= self.most:
            files, self.runs = self.runs, []
            items = heapq.merge(items, *(itertools.chain([x], map(struct.Struct("<6q").unpack, run)) for x, _, run in files))
        file = tempfile.TemporaryFile(buffering=1 << 16)
        for x in items:
            file.write(struct.pack("<6q", *x))
        file.seek(0)
        run = iter(lambda: file.read(48), b"")
        self.spilled += 1
        heapq.heappush(self.runs, (struct.unpack("<6q", next(run)), self.spilled, run))

    def pop(self, key: tuple) -> Iterator[tuple]:
        """The items that begin with ``key``, which no item left precedes."""
        n = len(key)
        while self.heap and self.heap[0][:n] <= key:
            yield heapq.heappop(self.heap)
        while self.runs and self.runs[0][0][:n] <= key:
            item, i, run = self.runs[0]
            rest = next(run, None)
            if rest is None:
                heapq.heappop(self.runs)
            else:
                heapq.heapreplace(self.runs, (struct.unpack("<6q", rest), i, run))
            yield item


def _forward(names: list[str], limit: int):
    """Totals of the nodes of some shards, which come in reverse level order."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queue = SpillingQueue(limit)
        for batch in batches:
            sums: tuple[list, list, list] = ([], [], [])
            for depth, p1, p2, q1, q2, inside, own, children, leaves, saved in zip(
                    *(batch.column(n).to_pylist() for n in ("depth", "p1", "p2", "q1", "q2", "inside", "own", "children",
                                                            "leaves", "saved"))):
                saved += own
                for _, _, _, c, n, s in queue.pop((-depth, p1, p2)):
                    children, leaves, saved = children + c, leaves + n, saved + s
                leaves = leaves or 1
                for out, x in zip(sums, (children, leaves, saved)):
                    out.append(x)
                if inside:
                    queue.push((1 - depth, q1, q2, 1, leaves, saved))
            columns = dict(zip(batch.schema.names, batch.columns)) | dict(
                zip(("children", "leaves", "saved"), (pa.array(x, pa.int64()) for x in sums)))
            yield pa.RecordBatch.from_arrays([columns[n] for n in names], names=names)
    return run


def _nodes(convs: DataFrame, rows: DataFrame, shard: int, factor: int) -> DataFrame:
    """The nodes with their parents, classes and shards."""
    nodes = rows.groupBy(*NODE).agg(F.min("conv").alias("conv"), F.count(F.lit(1)).alias("n"), F.min("q1").alias("q1"),
                                    F.min("q2").alias("q2"), F.min("size").alias("size"))
    zero = F.lit(0).cast("long")
    root = convs.agg(F.min("conv").alias("conv"), F.count(F.lit(1)).alias("n")).where("n > 0").select(
        *[zero.alias(c) for c in NODE], "conv", "n", *[zero.alias(c) for c in ("q1", "q2", "size")])
    nodes = stored(nodes.withColumn("depth", F.col("depth").cast("long")).unionByName(root)
                   .withColumn("class", _class(F.col("n"), shard, factor)), "trie-nodes")
    paths = rows.select("conv", *NODE).join(nodes.select(*NODE, "class"), NODE)
    tops = paths.groupBy("conv", "class").agg(F.min(F.struct(*NODE)).alias("top"))
    tops = tops.select("conv", "class", F.xxhash64("top").alias("shard"))
    up = nodes.select(F.col("depth").alias("up_depth"), F.col("p1").alias("up1"), F.col("p2").alias("up2"),
                      F.col("conv").alias("parent"), F.col("class").alias("up_class"))
    above = (F.col("depth") - 1 == F.col("up_depth")) & (F.col("q1") == F.col("up1")) & (F.col("q2") == F.col("up2"))
    nodes = nodes.join(up, above, "left").drop("up_depth", "up1", "up2").join(tops, ["conv", "class"], "left")
    return nodes.select(*NODE, "q1", "q2", "conv", "parent", "n", "class", "up_class",
                        F.coalesce("up_class", F.lit(-1)).eqNullSafe(F.col("class")).alias("inside"),
                        ((F.col("n") - 1) * F.col("size")).alias("own"), F.coalesce("shard", zero).alias("shard"))


def trie(convs: DataFrame, turns: DataFrame, shard: int = SHARD, factor: int = FACTOR, queue: int = QUEUE) -> DataFrame:
    """The nodes of the trie of ``turns`` (conv, rank, x1, x2, size), ranks 1 to n in each conversation of ``convs`` (conv).

    depth, p1, p2 name a node; conv is its smallest member, parent that of its
    parent, n its members, children its child nodes; leaves and saved are
    totals of its subtree.  Without conversations there is no node.  A
    conversation without turns is a member of the root alone.
    """
    return _totals(convs, stored(prefixes(turns), "prefixes"), shard, factor, queue)


def _totals(convs: DataFrame, rows: DataFrame, shard: int, factor: int, queue: int) -> DataFrame:
    nodes = stored(_nodes(convs, rows, shard, factor), "trie")
    spark = nodes.sparkSession
    last = nodes.agg(F.max("class")).first()[0]
    counts = ["children", "leaves", "saved"]
    done, messages = None, None
    for k in range((last or 0) + 1):
        part = nodes.where(F.col("class") == k)
        if messages is not None:
            part = part.join(messages.where(F.col("class") == k).groupBy(*NODE).agg(*[F.sum(c).alias(c) for c in counts]),
                             NODE, "left").fillna(0, counts)
        else:
            part = part.withColumns({c: F.lit(0).cast("long") for c in counts})
        part = part.repartition("shard").sortWithinPartitions(F.col("depth").desc(), "p1", "p2")
        found = stored(part.mapInArrow(_forward(part.columns, queue), part.schema), "trie-totals")
        sent = found.where(F.col("up_class") > k).select(
            (F.col("depth") - 1).alias("depth"), F.col("q1").alias("p1"), F.col("q2").alias("p2"),
            F.col("up_class").alias("class"), F.lit(1).cast("long").alias("children"), "leaves", "saved")
        messages = sent if messages is None else messages.unionByName(sent)
        done = found if done is None else done.unionByName(found)
    return done.drop("class", "up_class", "inside", "shard", "own", "q1", "q2") if done is not None else spark.range(0)


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Ids of each node in comma-joined pieces."""
    names = [*NODE, "first", "ids"]
    kinds = [pa.int64()] * 4 + [pa.string()]
    key, ids = None, []
    for batch in batches:
        out: list[tuple] = []
        for *node, conv in zip(*(c.to_pylist() for c in batch.columns)):
            if node != key or len(ids) == PIECE:
                if ids:
                    out.append((*key, ids[0], ",".join(map(str, ids))))
                key, ids = node, []
            ids.append(conv)
        yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out) if out else [[]] * 5, kinds)], names=names)
    if ids:
        yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip((*key, ids[0], ",".join(map(str, ids))), kinds)],
                                         names=names)


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of each node's pieces, which come in order; one piece at a time is in memory."""
    import hashlib

    names, kinds = [*NODE, "sha"], [pa.int64()] * 3 + [pa.string()]
    key, state = None, None
    for batch in batches:
        out: list[tuple] = []
        for *node, ids in zip(*(batch.column(n).to_pylist() for n in (*NODE, "ids"))):
            if node == key:
                state.update(b"," + ids.encode())
            else:
                if key:
                    out.append((*key, state.hexdigest()))
                key, state = node, hashlib.sha256(ids.encode())
        yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out) if out else [[]] * 4, kinds)], names=names)
    if key:
        yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip((*key, state.hexdigest()), kinds)], names=names)


def ends(convs: DataFrame, rows: DataFrame) -> DataFrame:
    """(depth, p1, p2, sha): SHA-256 of the ids of the conversations that end at a node, ascending and comma-joined.

    The ids of a node are cut into pieces over ranges of (node, id), so no
    task sorts them all; only the digest itself runs through one node's
    pieces in order.
    """
    zero = F.lit(0).cast("long")
    last = rows.groupBy("conv").agg(F.max(F.struct(F.col("depth").cast("long").alias("depth"), "p1", "p2")).alias("k"))
    found = convs.join(last, "conv", "left").select(*[F.coalesce(F.col(f"k.{c}"), zero).alias(c) for c in NODE], "conv")
    schema = "depth long, p1 long, p2 long, first long, ids string"
    cut = (found.repartitionByRange(*NODE, "conv").sortWithinPartitions(*NODE, "conv").mapInArrow(_pieces, schema)
           .repartition(*NODE).sortWithinPartitions(*NODE, "first"))
    return cut.mapInArrow(_digests, "depth long, p1 long, p2 long, sha string")


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nodes of the trie of all conversations, each rebuilt on the first turns of its family."""
    convs, turns = branched(stored(turn_hashes(table(spark, sf_dir, "conversations")), "turn-ranks"))
    convs, rows = stored(convs, "conversations"), stored(prefixes(turns), "prefixes")
    found = _totals(convs, rows, SHARD, FACTOR, QUEUE).join(ends(convs, rows), NODE, "left")
    return found.select(
        F.col("conv").alias("conv_id"), "depth", F.col("parent").alias("parent_conv_id"), F.col("n").alias("n_convs"),
        F.col("children").alias("n_children"), F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"),
        F.coalesce("sha", F.sha2(F.lit(""), 256)).alias("ends_sha256"))


OP11_SQL = f"""
WITH t AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) AS rank,
    coalesce(role, '') AS role, coalesce(text, '') AS text
  FROM conversations WHERE conv_id IS NOT NULL),
c AS (SELECT conv_id, conv_id - conv_id % 100 AS base, {CRC32.format('conv_id::VARCHAR')} % {HEAD} AS h
      FROM (SELECT DISTINCT conv_id FROM t)),
r AS (
  SELECT c.conv_id, t.rank AS k, role, text FROM c JOIN t ON t.conv_id = c.base AND t.rank <= c.h
  UNION ALL
  SELECT c.conv_id, 1000 + t.rank, role, text FROM c JOIN t ON t.conv_id = c.conv_id AND t.rank > c.h),
d AS (SELECT conv_id, row_number() OVER w AS depth, text,
        string_agg(length(role) || ':' || role || length(text) || ':' || text, '') OVER w AS prefix
      FROM r WINDOW w AS (PARTITION BY conv_id ORDER BY k)),
m AS (SELECT conv_id, depth, text, prefix, max(depth) OVER (PARTITION BY conv_id) AS turns,
        min(conv_id) OVER (PARTITION BY depth, prefix) AS node, count(*) OVER (PARTITION BY depth, prefix) AS n FROM d
      UNION ALL
      SELECT c.conv_id, 0, '', '', (SELECT count(*) FROM r WHERE r.conv_id = c.conv_id), min(conv_id) OVER (), count(*) OVER ()
      FROM c),
p AS (SELECT x.node, x.depth, any_value(x.n) AS n, any_value(x.text) AS text, any_value(y.node) AS parent,
        string_agg(x.conv_id::VARCHAR, ',' ORDER BY x.conv_id) FILTER (x.turns = x.depth) AS ends
      FROM m x LEFT JOIN m y ON y.conv_id = x.conv_id AND y.depth = x.depth - 1 GROUP BY x.node, x.depth),
k AS (SELECT parent AS node, depth - 1 AS depth, count(*) AS children FROM p WHERE depth > 0 GROUP BY ALL),
a AS (SELECT m.node, m.depth, sum((p.n - 1) * length(p.text)) AS saved,
        count(*) FILTER (NOT EXISTS (FROM k WHERE k.node = p.node AND k.depth = p.depth)) AS leaves
      FROM p JOIN m ON m.conv_id = p.node AND m.depth <= p.depth GROUP BY m.node, m.depth)
SELECT p.node AS conv_id, p.depth::BIGINT AS depth, p.parent AS parent_conv_id, p.n::BIGINT AS n_convs,
  coalesce(children, 0)::BIGINT AS n_children, leaves::BIGINT AS n_leaves, saved::BIGINT AS saved_tokens,
  sha256(coalesce(ends, '')) AS ends_sha256
FROM p JOIN a ON a.node = p.node AND a.depth = p.depth LEFT JOIN k ON k.node = p.node AND k.depth = p.depth
"""
