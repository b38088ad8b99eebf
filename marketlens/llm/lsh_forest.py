"""Near-duplicate documents by an LSH forest over MinHash signatures.

Texts become sets of ``k``-word shingles.  Equal sets form a class.  Every
class has one MinHash label in each tree of the forest, and every tree is a
sorted order of the labels: the longer the common prefix of two labels, the
more alike their classes are likely to be, and neighbours in the order are
the candidates.  Classes that share a prefix of the base depth with no other
in any tree are left alone.

Rounds: each tree's labels are dealt by range and sorted, ties in an order
drawn anew for each round, and neighbours of different components that share
the base prefix are candidates, which weigh more the deeper they meet.  The
first rounds test the best candidate of every class, the later ones the
``MOST`` of a class and tree, among its nearest ``window`` neighbours of other
components, whose signatures agree best and nearly enough.  A test compares the full shingle sets.  Confirmed links unite
components, regions that hold one component drop out, so the window reaches
further in what is left, and rounds go on until one finds no link.

The last step leaves nothing of the remaining regions out.  Regions of at most
``window`` + 1 classes are whole in one task and all their pairs are looked at.
The classes of larger regions are joined exactly: sets that are alike enough
share a shingle among the rarest of each, and a join on these with a bound on
the overlap that their places allow lists the candidates.  Only pairs of
different components are joined, and common shingles are dealt over cells of
at most ``CELL`` by ``CELL`` rows.  No region is one task.

What a pair at the threshold similarity 0.8 can be missed by: it shares no base
region of any tree with probability (1 - 0.8**4)**24 = 3e-6, and where it meets
in small regions only, its signatures agree in less than the last step asks
for, 5 standard deviations below the threshold, with 1.5e-6 (binomial).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlens.llm.graph import components
from marketlens.llm.shared import any_names, stored, table
from marketlens.llm.words import NONBLANK, U, chunks_of, mixed, runs_of, words_of

SHINGLE = 5
PERCENT = 80
TREES = 24
DEPTHS = (4, 6, 9)
BEST_ROUNDS = 2
WINDOW = 32
SLACK = 0.06  # of agreeing signature parts below the threshold; 2.2 standard deviations of 216 parts at 0.8
SURE = 5.0  # standard deviations of the agreeing parts below the threshold that the last step allows
BUCKETS = 20  # bits of a shingle's hash by which its frequency is counted
CELL = 1000
MOST = 2  # candidates of a class in one tree and round, beyond the first rounds
BLOCK = 1 << 14
FEW = 100  # a round that finds less than one in so many of all links is the last before the exact step
U32 = np.uint32


def shingle_set(hashes: np.ndarray, k: int) -> np.ndarray:
    """Sorted distinct hashes of k-word shingles; fewer words are one shingle; no words, none."""
    if not len(hashes):
        return hashes
    return np.unique(runs_of(hashes, min(k, len(hashes))))


def _functions(n: int) -> tuple[np.ndarray, np.ndarray]:
    r = np.random.default_rng(11)
    return (r.integers(0, 1 << 32, n, dtype=np.uint32)[:, None],
            (r.integers(0, 1 << 31, n, dtype=np.uint32) * U32(2) + U32(1))[:, None])


def signature(shingles: np.ndarray, functions) -> np.ndarray:
    """The least value of every hash function over a set that is not empty."""
    flip, factor = functions
    low = np.full(len(flip), 0xFFFFFFFF, np.uint32)
    narrow = (shingles >> U(32)).astype(np.uint32)
    for a in range(0, len(narrow), BLOCK):
        h = (narrow[None, a:a + BLOCK] ^ flip) * factor
        h ^= h >> U32(15)
        np.minimum(low, h.min(axis=1), out=low)
    return low


def tree_keys(labels: np.ndarray, depths: tuple[int, ...]) -> np.ndarray:
    """64-bit keys of the prefixes of each tree's label, tree by tree; ``labels`` has a row a tree."""
    labels = labels.astype(np.uint64)
    out, key = np.empty((len(labels), len(depths)), np.uint64), np.arange(len(labels), dtype=np.uint64)
    for j in range(labels.shape[1]):
        key = mixed(key * U(0x9E3779B97F4A7C15) + labels[:, j] + U(1))
        if j + 1 in depths:
            out[:, depths.index(j + 1)] = key
    return out


def _describe(k: int, trees: int, depths: tuple[int, ...]):
    """(id, hash of text, set size, class, base keys) of every text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base = [f.reshape(trees, depths[-1])[:, :depths[0]].reshape(-1, 1) for f in _functions(trees * depths[-1])]
        for batch in batches:
            sizes, ids, keys = [], [], []
            for _, _, data, offsets in chunks_of(batch.column(2)):
                w = words_of(data, offsets, NONBLANK)
                for t in range(len(offsets) - 1):
                    s = shingle_set(w.hash[w.first[t]:w.first[t + 1]], k)
                    sizes.append(len(s))
                    if not len(s):
                        ids.append(U(0))
                        continue
                    both = np.array([np.add.reduce(s), np.bitwise_xor.reduce(s)]) + U(len(s))
                    ids.append(mixed(both[:1] ^ mixed(both[1:]))[0])
                    keys.append(tree_keys(signature(s, base).reshape(trees, -1), depths[:1]).ravel())
            flat = np.concatenate(keys).astype(np.int64) if keys else np.zeros(0, np.int64)
            at = np.concatenate([[0], np.cumsum((np.array(sizes) > 0) * trees)]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(sizes, pa.int64()),
                 pa.array(np.array(ids, np.uint64).astype(np.int64)), pa.ListArray.from_arrays(pa.array(at), pa.array(flat))],
                names=["__doc", "__th", "__n", "__cid", "__keys"])
    return run


def _labels(k: int, trees: int, depths: tuple[int, ...]):
    """(class, text, set size, keys of all depths tree by tree, a byte of each signature part) of active classes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        functions = _functions(trees * depths[-1])
        for batch in batches:
            sizes, keys, parts = [], [], []
            for _, _, data, offsets in chunks_of(batch.column(1)):
                w = words_of(data, offsets, NONBLANK)
                for t in range(len(offsets) - 1):
                    s = shingle_set(w.hash[w.first[t]:w.first[t + 1]], k)
                    low = signature(s, functions)
                    sizes.append(len(s))
                    keys.append(tree_keys(low.reshape(trees, -1), depths).astype(np.int64).ravel().tolist())
                    parts.append((low * U32(0x9E3779B1) >> U32(24)).astype(np.uint8).tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(sizes, pa.int64()),
                                              pa.array(keys, pa.list_(pa.int64())), pa.array(parts, pa.binary())],
                                             names=["__cid", "__text", "__n", "__keys", "__parts"])
    return run


def _best(pairs: dict[tuple[int, int], float], most: int) -> dict[tuple[int, int], float]:
    """The pairs that are among the ``most`` of largest value of either side."""
    a, b = (np.fromiter((p[i] for p in pairs), np.int64, len(pairs)) for i in (0, 1))
    v = np.fromiter(pairs.values(), np.float64, len(pairs))
    side, at = np.concatenate([a, b]), np.tile(np.arange(len(pairs)), 2)
    order = np.lexsort((at, -v[at], side))
    side, at = side[order], at[order]
    rank = np.arange(len(side)) - np.searchsorted(side, side)
    return {(x, y): w for x, y, w in zip(*(z[np.unique(at[rank < most])].tolist() for z in (a, b, v)))}


def _neighbours(depths: int, percent: int, window: int, least: float | None, most: int | None = None):
    """Candidates among the ``window`` nearest of a sorted stream of (class, size, component, keys, parts).

    With ``most``, only those in which one side is among the other's so many
    most alike by their signatures.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            if not len(batch):
                continue
            now = [batch.column(c).to_numpy(zero_copy_only=False) for c in range(3 + depths)]
            if least is not None:
                joined = b"".join(batch.column(3 + depths).to_pylist())
                now.append(np.frombuffer(joined, np.uint8).reshape(len(batch), -1))
            old = 0 if held is None else len(held[0])
            rows = now if held is None else [np.concatenate(x) for x in zip(held, now)]
            found: dict[tuple[int, int], float] = {}
            cid, n, comp, keys = rows[0], rows[1], rows[2], rows[3:3 + depths]
            for lag in range(1, min(window, len(cid) - 1) + 1):
                b = np.arange(max(lag, old), len(cid))
                b = b[(keys[0][b] == keys[0][b - lag]) & (comp[b] != comp[b - lag])
                      & (100 * np.minimum(n[b], n[b - lag]) >= percent * np.maximum(n[b], n[b - lag]))]
                if least is not None and len(b):
                    alike = (rows[-1][b] == rows[-1][b - lag]).mean(axis=1)
                    b, alike = b[alike >= least], alike[alike >= least]
                a = b - lag
                weight = alike if most and len(b) else sum((key[a] == key[b]) * 8.0**d for d, key in enumerate(keys))
                for x, y, v in zip(np.minimum(cid[a], cid[b]).tolist(), np.maximum(cid[a], cid[b]).tolist(), weight):
                    found[x, y] = found.get((x, y), 0.0) + v
            held = [x[-window:] for x in rows]
            if found and most:
                found = _best(found, most)
            if found:
                yield pa.RecordBatch.from_arrays([pa.array([p[0] for p in found], pa.int64()), pa.array([p[1] for p in found], pa.int64()),
                                                  pa.array(list(found.values()), pa.float64())], names=["a", "b", "v"])
    return run


def _confirm(k: int, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            linked: list[bool] = []
            sides = [[shingle_set(w.hash[w.first[t]:w.first[t + 1]], k) for _, _, data, offsets in chunks_of(batch.column(c))
                      for w in (words_of(data, offsets, NONBLANK),) for t in range(len(offsets) - 1)] for c in (2, 3)]
            for a, b in zip(*sides):
                both = len(np.intersect1d(a, b, assume_unique=True))
                linked.append(100 * both >= percent * (len(a) + len(b) - both))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(linked, pa.bool_())],
                                             names=["a", "b", "linked"])
    return run


def _frequencies(k: int):
    """(bucket, count): in how many sets the shingles of a bucket occur, as far as one task sees; a text counts by its weight."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << BUCKETS, np.int64)
        for batch in batches:
            weights = batch.column(0).to_numpy()
            for first, _, data, offsets in chunks_of(batch.column(1)):
                w = words_of(data, offsets, NONBLANK)
                for t in range(len(offsets) - 1):
                    s = shingle_set(w.hash[w.first[t]:w.first[t + 1]], k)
                    np.add.at(total, (s >> U(64 - BUCKETS)).astype(np.int64), weights[first + t])
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(total[at], pa.int64())], names=["bucket", "n"])
    return run


def _rarest(k: int, percent: int, frequency):
    """(shingle, place, class, component, set size, short) of each set's rarest shingles in one order of all shingles.

    A set has as many as it takes to share one with any set that is alike
    enough; ``short`` are those it takes with sets of its size or more.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, comps = (batch.column(c).to_numpy(zero_copy_only=False) for c in (0, 1))
            for first, _, data, offsets in chunks_of(batch.column(2)):
                w = words_of(data, offsets, NONBLANK)
                found, sizes, places = [], [], []
                for t in range(len(offsets) - 1):
                    s = shingle_set(w.hash[w.first[t]:w.first[t + 1]], k)
                    order = np.lexsort((s, frequency.value[(s >> U(64 - BUCKETS)).astype(np.int64)]))
                    found.append(s[order[:len(s) + 1 + -percent * len(s) // 100]])
                    sizes.append(len(s))
                    places.append(np.arange(len(found[-1])))
                each = np.array([len(f) for f in found])
                n, place = np.repeat(sizes, each), np.concatenate(places)
                short = (n - place) * (100 + percent) >= 2 * percent * n
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(found).astype(np.int64)), pa.array(place, pa.int64()),
                     pa.array(np.repeat(ids[first:first + len(each)], each), pa.int64()),
                     pa.array(np.repeat(comps[first:first + len(each)], each), pa.int64()), pa.array(n, pa.int64()), pa.array(short)],
                    names=["s", "i", "cid", "comp", "n", "short"])
    return run


def _speakers(crowd: DataFrame) -> DataFrame:
    """(class, weight): about the square root of each component's (class, component) rows, and for how many each stands."""
    held = crowd.groupBy("__comp").agg(F.ceil(F.sqrt(F.count(F.lit(1)))).alias("__weight"), F.min("__cid").alias("__least"))
    return crowd.join(held, "__comp").where("__cid = __least or pmod(xxhash64(__cid), __weight) = 0").select("__cid", "__weight")


def _joined(crowd: DataFrame, texts: DataFrame, k: int, percent: int, cell: int = CELL) -> DataFrame:
    """(a, b): every pair of (class, component) of different components whose texts can be alike enough.

    Any order of the shingles lists every pair; the rarer the first ones are,
    the fewer others.  So the order is counted on the speakers of components,
    whose classes are alike, while every class is joined.

    Of each shingle's rows, the component with the most of them is joined with
    the others only, so rows of one component meet no oftener than rows of
    different ones.
    """
    spark = crowd.sparkSession
    counts = np.zeros(1 << BUCKETS, np.int64)
    spoken = stored(_speakers(crowd).join(texts, "__cid").select("__weight", "__text"), "speakers")
    seen = spoken.mapInArrow(_frequencies(k), "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    counts[seen["bucket"].to_numpy()] = seen["n"].to_numpy()
    frequency = spark.sparkContext.broadcast(counts)
    crowd = crowd.join(texts, "__cid").select("__cid", "__comp", "__text")
    rows = stored(crowd.mapInArrow(_rarest(k, percent, frequency), "s long, i long, cid long, comp long, n long, short boolean"), "rarest")
    frequency.destroy()
    held = rows.groupBy("s", "comp").agg(F.count(F.lit(1)).alias("all"), F.count_if("short").alias("few"))
    held = held.groupBy("s").agg(F.max(F.struct("all", "few", "comp")).alias("m"), F.sum("all").alias("all"),
                                 F.sum("few").alias("few"), F.count(F.lit(1)).alias("comps")).where("comps > 1 and few > 0")
    cells = lambda n: F.greatest(F.ceil(n / cell), F.lit(1)).cast("int")
    # Join 0: rows of the lesser components with all; join 1: the largest component's with the lesser ones'.
    held = held.select("s", F.col("m.comp").alias("main"), F.array(cells(F.expr("few - m.few")), cells(F.expr("m.few"))).alias("x"),
                       F.array(cells(F.col("all")), cells(F.expr("all - m.all"))).alias("y"))
    rows = rows.join(held, "s")
    other = F.col("comp") != F.col("main")
    left = rows.where("short").withColumn("j", F.when(other, 0).otherwise(1))
    right = rows.withColumn("j", F.explode(F.when(other, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))))
    for_each = lambda c: F.explode(F.sequence(F.lit(0), F.get(c, F.col("j")) - 1))
    dealt = lambda c: F.pmod(F.xxhash64("cid"), F.get(c, F.col("j"))).cast("int")
    left = left.withColumn("p", dealt("x")).withColumn("q", for_each("y"))
    right = right.withColumn("q", dealt("y")).withColumn("p", for_each("x"))
    key = ["s", "j", "p", "q"]
    left = left.select(*key, F.col("i").alias("i1"), F.col("cid").alias("c1"), F.col("comp").alias("m1"), F.col("n").alias("n1"))
    right = right.select(*key, F.col("i").alias("i2"), F.col("cid").alias("c2"), F.col("comp").alias("m2"), F.col("n").alias("n2"))
    found = left.join(right.hint("merge"), key).where(
        f"m1 <> m2 and n1 <= n2 and 100 * n1 >= {percent} * n2 and (n1 - i1) * {100 + percent} >= {percent} * (n1 + n2) "
        f"and (n2 - i2) * {100 + percent} >= {percent} * (n1 + n2)")
    return found.select(F.least("c1", "c2").alias("a"), F.greatest("c1", "c2").alias("b")).distinct()


def _candidates(entries: DataFrame, tested: DataFrame | None, depths: int, percent: int, turn: int,
                best_rounds: int, window: int) -> DataFrame:
    """(a, b): untested pairs of classes in different components, near each other in some tree."""
    wide = turn >= best_rounds
    keys = [f"__k{d}" for d in range(depths)]
    order = [*keys, F.xxhash64(F.lit(turn), "__cid"), "__cid"]
    rows = entries.select("__cid", "__n", "__comp", *keys, *["__parts"] * wide).repartitionByRange(*order).sortWithinPartitions(*order)
    least = max(0.0, percent / 100 - SLACK) if wide else None
    found = rows.mapInArrow(_neighbours(depths, percent, window if turn > best_rounds else 1, least, MOST if wide else None),
                            "a long, b long, v double")
    found = found.groupBy("a", "b").agg(F.sum("v").alias("v"))
    if tested is not None:
        found = found.join(tested, ["a", "b"], "left_anti")
    if wide:
        return found.select("a", "b")
    best = found.select(F.explode(F.array("a", "b")).alias("__cid"), "v", "a", "b").groupBy("__cid").agg(
        F.max(F.struct("v", "a", "b")).alias("m"))
    return best.select("m.a", "m.b").distinct()


def _rest(entries: DataFrame, texts: DataFrame, tested: DataFrame, depths: int, k: int, percent: int,
          signed: int, window: int) -> DataFrame:
    """(a, b): all untested pairs of the remaining regions that can be alike enough."""
    held = entries.groupBy("__k0").agg(F.count(F.lit(1)).alias("held"))
    small, large = (held.where(w).select("__k0") for w in (f"held <= {window + 1}", f"held > {window + 1}"))
    keys = [f"__k{d}" for d in range(depths)]
    rows = entries.join(small, "__k0", "left_semi").select("__cid", "__n", "__comp", *keys, "__parts")
    share = percent / 100
    least = max(0.0, share - SURE * (share * (1 - share) / signed) ** 0.5)
    found = rows.repartition("__k0").sortWithinPartitions("__k0").mapInArrow(
        _neighbours(depths, percent, window, least), "a long, b long, v double").select("a", "b").distinct()
    crowd = stored(entries.join(large, "__k0", "left_semi").select("__cid", "__comp").distinct(), "crowded")
    if not crowd.isEmpty():
        found = found.unionByName(_joined(crowd, texts, k, percent)).distinct()
    return found.join(tested, ["a", "b"], "left_anti")


def _several(entries: DataFrame) -> DataFrame:
    """The entries in base regions that hold more than one component."""
    many = entries.groupBy("__k0").agg(F.min("__comp").alias("x"), F.max("__comp").alias("y")).where("x <> y").select("__k0")
    return entries.join(many, "__k0", "left_semi")


@any_names
def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", k: int = SHINGLE,
                    percent: int = PERCENT, trees: int = TREES, depths: tuple[int, ...] = DEPTHS,
                    best_rounds: int = BEST_ROUNDS, window: int = WINDOW) -> DataFrame:
    """(``doc_id``, n_shingles, component_id, kept, text_hash): one row per row of ``docs``.

    Documents are linked if the Jaccard similarity of their shingle sets is at
    least ``percent`` / 100; ``component_id`` is the smallest id reachable,
    ``kept`` says that it is the row's own.  Texts without words, empty and
    null ones are linked with nothing.  A null id is linked with nothing, its
    component is null and it is kept.  Repeated rows and equal texts are one
    class; rows that repeat an id with other texts are nodes of their own.
    """
    whole = F.coalesce(F.col(text).cast("string"), F.lit(""))
    source = docs.select(F.col(doc_id).cast("long").alias("__doc"), F.xxhash64(whole).alias("__th"), whole.alias("__text"))
    described = stored(source.mapInArrow(_describe(k, trees, depths),
                                         "__doc long, __th long, __n long, __cid long, __keys array<long>"), "described")
    nodes = described.where((F.col("__n") > 0) & F.col("__doc").isNotNull())

    # The classes that share a base region with another, and a text of each.
    base = nodes.select("__cid", F.explode("__keys").alias("key"))
    shared = base.groupBy("key").agg(F.min("__cid").alias("x"), F.max("__cid").alias("y")).where("x <> y").select("key")
    active = base.join(shared, "key", "left_semi").select("__cid").distinct()
    reps = stored(nodes.join(active, "__cid", "left_semi").groupBy("__cid").agg(F.min(F.struct("__doc", "__th")).alias("r"))
                  .select("__cid", "r.*"), "active-classes")
    # The texts are dealt by id at any size and not sorted: the classes of a task are its hash table.
    classes = source.join(reps.hint("shuffle_hash"), ["__doc", "__th"]).select("__cid", "__text").dropDuplicates(
        ["__cid"]).mapInArrow(
        _labels(k, trees, depths), "__cid long, __text string, __n long, __keys array<long>, __parts binary")
    classes = stored(classes, "active-texts")
    parts, texts, width = classes.select("__cid", "__parts"), classes.select("__cid", "__text"), len(depths)
    entries = classes.select("__cid", "__n", F.col("__cid").alias("__comp"), F.explode(F.transform(
        F.sequence(F.lit(0), F.lit(trees - 1)),
        lambda t: F.struct(*[F.get("__keys", t * width + d).alias(f"__k{d}") for d in range(width)]))).alias("e"))
    entries = _several(entries.select("__cid", "__n", "__comp", "e.*"))
    # From the first wide round on the entries carry the parts, so that no round joins them anew.
    entries = stored(entries if best_rounds else entries.join(parts, "__cid"), "entries-0")
    comps, tested, turn = classes.select("__cid", F.col("__cid").alias("__comp")), None, 0
    last, united = False, 0
    while True:
        pairs = (_rest(entries, texts, tested, width, k, percent, trees * depths[-1], window) if last else
                 _candidates(entries, tested, width, percent, turn, best_rounds, window))
        left, right = texts.toDF("a", "__text_a"), texts.toDF("b", "__text_b")
        checked = stored(pairs.join(left, "a").join(right, "b").select("a", "b", "__text_a", "__text_b")
                         .mapInArrow(_confirm(k, percent), "a long, b long, linked boolean"), f"checked-{turn}")
        links = checked.where("linked").count()
        turn, united = turn + 1, united + links
        tested = checked.select("a", "b") if tested is None else tested.unionByName(checked.select("a", "b"))
        if links:
            edges = (checked.where("linked").join(comps.toDF("a", "u"), "a").join(comps.toDF("b", "v"), "b").select("u", "v"))
            roots = components(edges).toDF("__comp", "__root")
            moved = lambda df: df.join(roots, "__comp", "left").withColumn(
                "__comp", F.coalesce("__root", "__comp")).drop("__root")
            comps = stored(moved(comps).select("__cid", "__comp"), f"comps-{turn}")
            entries = entries if last else _several(moved(entries))
        if turn == best_rounds:
            entries = entries.join(parts, "__cid")
        if not last and (links or turn == best_rounds):
            entries = stored(entries, f"entries-{turn}")
        if last:
            break
        last = turn > best_rounds + 1 and FEW * links <= united

    first = nodes.groupBy("__cid").agg(F.min("__doc").alias("__first")).join(comps, "__cid", "left").withColumn(
        "__comp", F.coalesce("__comp", "__cid"))
    least = first.groupBy("__comp").agg(F.min("__first").alias("__least"))
    named = first.join(least, "__comp").select("__cid", "__least")
    out = described.select("__doc", "__th", "__n",
                           F.when((F.col("__n") > 0) & F.col("__doc").isNotNull(), F.col("__cid")).alias("__cid"))
    out = out.join(named, "__cid", "left").withColumn("__least", F.coalesce("__least", "__doc"))
    return out.select(F.col("__doc").alias(doc_id), F.col("__n").alias("n_shingles"), F.col("__least").alias("component_id"),
                      F.coalesce(F.col("__doc") == F.col("__least"), F.lit(True)).alias("kept"),
                      F.col("__th").alias("text_hash"))


@any_names
def drop_near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **settings) -> DataFrame:
    """The rows of ``docs`` that ``near_duplicates`` keeps, one for each component; same columns.

    Rows without words and rows with a null id all stay.  Of rows that repeat
    a kept id, the one whose text has the smallest hash stays.
    """
    found = near_duplicates(docs, doc_id, text, **settings).where("kept")
    alone = F.col(doc_id).isNull() | (F.col("n_shingles") == 0)
    named = found.groupBy(F.col(doc_id).alias("__keep"), F.when(alone, F.col("text_hash")).alias("__alone")).agg(
        F.min("text_hash").alias("__keep_th"), F.count(F.lit(1)).alias("__n"))
    named = stored(named, "kept")
    repeated = not named.where("__n > 1 and __alone is null").isEmpty()
    # Rows that stay anyway are named too: one pass over the texts.
    whole = F.coalesce(F.col(text).cast("string"), F.lit(""))
    rows = docs.withColumn("__th", F.xxhash64(whole))
    kept = rows.join(named.hint("shuffle_hash"), F.col(doc_id).cast("long").eqNullSafe(F.col("__keep"))
                     & (F.col("__th") == F.col("__keep_th")), "left_semi")
    if repeated:
        wordless = F.col(doc_id).isNull() | (F.length(F.btrim(whole, F.lit(" \t\n\x0b\x0c\r"))) == 0)
        kept = kept.where(~wordless).dropDuplicates([doc_id, "__th"]).unionByName(kept.where(wordless))
    return kept.select(*docs.columns)


def op9_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose sets of two-word shingles are alike by 0.8 or more."""
    return near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"), k=2).drop("text_hash")


OP9_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (
  SELECT doc_id, CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) = 1 THEN ws
    ELSE list_distinct(list_transform(range(1, len(ws)), lambda i: ws[i] || ' ' || ws[i + 1])) END AS ss FROM w),
c AS (SELECT list_sort(ss) AS ss, min(doc_id) AS rep, any_value(len(ss)) AS n FROM s WHERE len(ss) > 0 GROUP BY list_sort(s.ss)),
x AS (SELECT rep, n, unnest(ss) AS sh FROM c),
l AS (
  SELECT a.rep AS u, b.rep AS v FROM x a JOIN x b ON a.sh = b.sh AND a.rep <> b.rep
    AND 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n)
  GROUP BY a.rep, b.rep, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))),
r AS (SELECT rep AS node, rep AS reach FROM c UNION SELECT r.node, l.v FROM r JOIN l ON r.reach = l.u),
m AS (SELECT node, min(reach) AS least FROM r GROUP BY node)
SELECT s.doc_id, len(s.ss)::BIGINT AS n_shingles, coalesce(m.least, s.doc_id) AS component_id,
  coalesce(m.least, s.doc_id) = s.doc_id AS kept
FROM s LEFT JOIN c ON list_sort(s.ss) = c.ss AND len(s.ss) > 0 LEFT JOIN m ON m.node = c.rep
"""
