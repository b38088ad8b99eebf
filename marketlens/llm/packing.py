"""Mixture-controlled packing by deficit round-robin over source queues.

Every source is a queue of its documents' tokens.  A window of ``WINDOW``
tokens serves the queues in turn: each has a credit that grows by its share of
the window, and what it is owed but not served, its deficit, stays below one
token for every halving of the round and is carried to the next window.  A queue that runs empty leaves the
round and the others share by their weights; that begins a new phase.  By
default a source's weight is its number of tokens, so all queues last to the
end and every window has the mixture of the whole corpus.

Credits are whole-number arithmetic on a position in the packed stream, so the
deficits at any window are known without the windows before it: a task that
holds a range of a queue cuts its documents where the windows cut that queue,
and no document moves for it.  Documents are tokenized once and written with
their place in their task's part of the queue; parts are put in line by their
token counts, one row a part and source.

All windows are full but for the rest at the end, which becomes sequences of
lengths that are powers of two: nothing is padded.
"""

from __future__ import annotations

import bisect
import json
import os
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from marketlens.llm.shared import stored, table
from marketlens.llm.words import NONBLANK, U, _power_tables as power_tables, chunks_of, mixed

WINDOW = 4096
END = 2
TOKENIZER = "word_bpe_49k.json"
CACHE = 1 << 19
SEGMENT = 1 << 22
BLANK, LETTER, DIGIT, SIGN, OTHER = range(5)
#: Kinds of bytes; letters of two bytes, U+00C0 to U+024F, are seen to apart.
KIND = np.array([BLANK if b == 32 or 9 <= b <= 13 else DIGIT if 48 <= b <= 57 else LETTER if 65 <= b <= 90 or 97 <= b <= 122
                 else OTHER if b < 33 or b > 126 or b in b"'<" else SIGN for b in range(256)], np.uint8)
#: The two signs in that range, and the letter that becomes two characters in lower case.
NOT_LETTERS = ((0xC3, 0x97), (0xC3, 0xB7), (0xC4, 0xB0))
#: How a tokenizer file normalises and splits texts for which ``Encoder`` may look at words one by one.
WORDS = (
    {"type": "Sequence", "normalizers": [
        {"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]},
    {"type": "Sequence", "pretokenizers": [
        {"type": "Split", "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"},
         "behavior": "Removed", "invert": True},
        {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]},
)


class Encoder:
    """Token ids of texts by a tokenizer file.

    A tokenizer of word pieces (lower case, white space dropped, tokens that
    end words marked; see ``WORDS``) splits every text between white space,
    letters, digits and signs.  Runs of Latin letters, runs of ASCII signs and
    single digits are then found on the byte buffer, each distinct one is
    encoded once, many in one call, and a text's ids are those of its runs.
    Words with any other character, an apostrophe or ``<`` are encoded whole.
    The cache starts anew beyond ``CACHE`` runs.  Other tokenizers encode whole
    texts.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        spec = json.loads(self.tokenizer.to_str())
        self.by_words = (spec["normalizer"], spec["pre_tokenizer"]) == WORDS and not spec["post_processor"]
        if self.by_words:
            self.last = np.zeros(self.tokenizer.get_vocab_size(), bool)
            for token, i in self.tokenizer.get_vocab().items():
                self.last[i] = token.endswith(spec["model"]["end_of_word_suffix"])
            values = np.random.default_rng(11).integers(1, 1 << 63, 256, dtype=np.uint64) * U(2) + U(1)
            self.value = values[NONBLANK.lower]
            self.clear()

    def clear(self) -> None:
        self.slot: dict[int, int] = {}
        self.starts, self.sizes, self.pool, self.end = np.zeros(1024, np.int64), np.zeros(1024, np.int64), np.zeros(1 << 14, np.uint32), 0

    def _learn(self, hashes: list[int], runs: list[str], whole: list[bool]) -> None:
        plain = [r for r, w in zip(runs, whole) if not w]
        texts = [" ".join(plain[i:i + 512]) for i in range(0, len(plain), 512)]
        ids = [np.array(e.ids, np.uint32) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        flat = np.concatenate(ids) if ids else np.zeros(0, np.uint32)
        cuts = np.flatnonzero(self.last[flat]) + 1
        if len(cuts) != len(plain):
            raise ValueError("the tokenizer does not mark the ends of words")
        odd = [e.ids for e in self.tokenizer.encode_batch_fast([r for r, w in zip(runs, whole) if w], add_special_tokens=False)]
        is_odd = np.array(whole, bool)
        sizes, order = np.zeros(len(runs), np.int64), np.zeros(len(runs), np.int64)
        sizes[~is_odd] = np.diff(cuts, prepend=0)
        order[~is_odd] = cuts - sizes[~is_odd]
        sizes[is_odd] = [len(x) for x in odd]
        order[is_odd] = len(flat) + np.cumsum(sizes[is_odd]) - sizes[is_odd]
        flat = np.concatenate([flat, *(np.array(x, np.uint32) for x in odd)])
        n, new = len(self.slot), len(runs)
        while len(self.starts) < n + new:
            self.starts, self.sizes = np.resize(self.starts, 2 * len(self.starts)), np.resize(self.sizes, 2 * len(self.sizes))
        while len(self.pool) < self.end + len(flat):
            self.pool = np.resize(self.pool, 2 * len(self.pool))
        self.sizes[n:n + new], self.starts[n:n + new] = sizes, self.end + order
        self.pool[self.end:self.end + len(flat)] = flat
        self.end += len(flat)
        self.slot.update(zip(hashes, range(n, n + new)))

    def _segment(self, data: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of bytes that begin and end between words, and the number of ids before each of ``edges``, where texts begin."""
        kind = KIND[data]
        lead = (data >= 0xC3) & (data <= 0xC9)
        after = np.flatnonzero(lead)
        after = after[after + 1 < len(data)]
        kind[after], kind[after + 1] = LETTER, LETTER
        for first, second in NOT_LETTERS:
            at = after[(data[after] == first) & (data[after + 1] == second)]
            kind[at], kind[at + 1] = OTHER, OTHER
        inside = kind != BLANK
        cut = np.zeros(len(data) + 1, bool)  # where words begin or end
        cut[0] = cut[-1] = True
        cut[1:-1] = inside[1:] != inside[:-1]
        cut[edges] = True
        bounds = np.flatnonzero(cut)
        odd = np.add.reduceat((kind == OTHER).astype(np.int32), bounds[:-1]) > 0 if len(data) else np.zeros(0, bool)
        whole = np.repeat(odd, np.diff(bounds))
        cut[1:-1] |= ((kind[1:] != kind[:-1]) | (kind[1:] == DIGIT) | (kind[:-1] == DIGIT)) & ~(whole[1:] & whole[:-1])
        bounds = np.flatnonzero(cut)
        start, stop = bounds[:-1], bounds[1:]
        keep = inside[start]
        start, stop = start[keep], stop[keep]
        up, down = power_tables(len(data))
        sums = np.zeros(len(data) + 1, U)
        np.cumsum(self.value[data] * up[:len(data)], out=sums[1:])
        hashes = mixed((sums[stop] - sums[start]) * down[start])
        unique, at, which = np.unique(hashes, return_index=True, return_inverse=True)
        keys = unique.tolist()
        slots = np.fromiter((self.slot.get(k, -1) for k in keys), np.int64, len(keys))
        new = np.flatnonzero(slots < 0)
        if len(new):
            slots[new] = np.arange(len(self.slot), len(self.slot) + len(new))
            raw = data.tobytes()
            self._learn(unique[new].tolist(), [raw[a:b].decode() for a, b in zip(start[at[new]].tolist(), stop[at[new]].tolist())],
                        whole[start[at[new]]].tolist())
        slots = slots[which]
        sizes = self.sizes[slots]
        ends = np.concatenate([[0], np.cumsum(sizes)])
        ids = self.pool[np.repeat(self.starts[slots] - ends[:-1], sizes) + np.arange(ends[-1])]
        return ids, ends[np.searchsorted(start, edges)]

    def encode(self, column: pa.Array, end: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
        """(first row, last row + 1, ids, bounds of each row's ids) of slices; every row ends with the id ``end``."""
        for a, b, data, offsets in chunks_of(column, SEGMENT):
            if self.by_words:
                parts, befores, total = [], [], 0
                for x, y in segments(data, offsets):
                    if len(self.slot) > CACHE:
                        self.clear()
                    edges = offsets[(offsets >= x) & ((offsets < y) | (y == offsets[-1]))] - x
                    ids, before = self._segment(data[x:y], edges)
                    parts.append(ids)
                    befores.append(before + total)
                    total += len(ids)
                ids = np.concatenate(parts) if parts else np.zeros(0, np.uint32)
                bounds = np.concatenate(befores) if parts else np.zeros(b - a + 1, np.int64)
            else:
                found = self.tokenizer.encode_batch_fast([x or "" for x in column.slice(a, b - a).to_pylist()], add_special_tokens=False)
                bounds = np.concatenate([[0], np.cumsum([len(e.ids) for e in found])])
                ids = np.concatenate([np.array(e.ids, np.uint32) for e in found])
            yield a, b, np.insert(ids, bounds[1:], end), bounds + np.arange(b - a + 1)


def segments(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[int, int]]:
    """Spans of about ``SEGMENT`` bytes that end at white space or at the end."""
    a, last = int(offsets[0]), int(offsets[-1])
    while a < last:
        b = min(last, a + SEGMENT)
        while b < last and KIND[data[b]] != BLANK:
            more = np.flatnonzero(KIND[data[b:b + SEGMENT]] == BLANK)
            b = b + int(more[0]) if len(more) else min(last, b + SEGMENT)
        yield a, b
        a = b


def _tokenize(path: str, end: int, keys: int):
    """Rows of (keys..., text, source) to (keys..., part, source, begins, n_tokens, ids)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(path)
        small = encoder.tokenizer.get_vocab_size() <= 1 << 16 and end < 1 << 16
        part, line = TaskContext.get().partitionId(), {}
        for batch in batches:
            text, sources = batch.column(keys), batch.column(keys + 1)
            for a, b, ids, bounds in encoder.encode(text, end):
                begins = []
                for s, n in zip(sources.slice(a, b - a).to_pylist(), np.diff(bounds).tolist()):
                    begins.append(line.get(s, 0))
                    line[s] = begins[-1] + n
                data = ids.astype("<u2" if small else "<u4")
                raw = pa.LargeBinaryArray.from_buffers(pa.large_binary(), b - a, [
                    None, pa.py_buffer((bounds * data.itemsize).astype(np.int64)), pa.py_buffer(data)]).cast(pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(i).slice(a, b - a) for i in range(keys)), pa.array([part] * (b - a), pa.int32()),
                     sources.slice(a, b - a), pa.array(begins, pa.int64()), pa.array(np.diff(bounds), pa.int64()), raw],
                    names=[*batch.schema.names[:keys], "part", "source", "begins", "n_tokens", "ids"])
    return run


def tokenized(docs: DataFrame, path: str, keys: list[str], text: str = "text", source: str = "source", end: int = END) -> DataFrame:
    """(keys, part, source, begins, n_tokens, ids): token ids of whole texts, and their place in a part of their source's queue.

    Written once.  ``ids`` are little-endian, 16 bits each where the vocabulary allows, else 32.
    """
    rows = docs.select(*keys, F.col(text).cast("string").alias("__text"), F.col(source).cast("string").alias("source"))
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:len(keys)]]
                       + ["part int", "source string", "begins long", "n_tokens long", "ids binary"])
    return stored(rows.mapInArrow(_tokenize(path, end, len(keys)), schema), "tokens")


@dataclass(frozen=True)
class Phase:
    """A stretch of the packed stream in which the same queues are served.

    It begins at ``at`` in the stream and at ``done`` in the queue.  The queues
    of a round are halved again and again; of x tokens for two halves of
    weights a and b the first gets floor(x * a / (a + b)), the other the rest.
    ``path`` leads to this queue: (whether it is in the other half, a, a + b).
    """

    at: int
    length: int
    done: int
    path: tuple[tuple[bool, int, int], ...]

    def served(self, x: int) -> tuple[int, int]:
        """Of the first x tokens of the phase, those of this queue and those of queues earlier in the round."""
        earlier = 0
        for other, a, both in self.path:
            first = x * a // both
            if other:
                earlier += first
                x -= first
            else:
                x = first
        return x, earlier

    def place(self, i: int) -> int:
        """The place in the phase of the queue's token i, counted from 0."""
        for other, a, both in reversed(self.path):
            i = i * both // (both - a) if other else -(-(i + 1) * both // a) - 1
        return i


def _paths(active: list, weights: dict) -> dict[object, tuple]:
    """The way to each queue when the round is halved again and again."""
    if len(active) < 2:
        return {s: () for s in active}
    first, rest = active[:len(active) // 2], active[len(active) // 2:]
    a, both = sum(weights[s] for s in first), sum(weights[s] for s in active)
    return ({s: ((False, a, both), *p) for s, p in _paths(first, weights).items()}
            | {s: ((True, a, both), *p) for s, p in _paths(rest, weights).items()})


def phases(sizes: dict, weights: dict) -> dict[object, list[Phase]]:
    """The phases of each queue: ``sizes`` its tokens, ``weights`` its whole-number weight, both by source in round order.

    A phase lasts until a queue is empty.
    """
    left, at, out = dict(sizes), 0, {s: [] for s in sizes}
    while any(left.values()):
        found = {s: Phase(at, 0, sizes[s] - left[s], p) for s, p in _paths([s for s in left if left[s]], weights).items()}
        length = min(sum(left.values()), *(p.place(left[s]) for s, p in found.items()))
        for s, p in found.items():
            out[s].append(Phase(at, length, p.done, p.path))
            left[s] -= p.served(length)[0]
        at += length
    return out


def tail(total: int, window: int) -> list[int]:
    """Ends of the sequences after the last full window: powers of two, the largest first."""
    at, ends = total - total % window, []
    for bit in range(window.bit_length() - 1, -1, -1):
        if total % window >> bit & 1:
            at += 1 << bit
            ends.append(at)
    return ends


class Cutter:
    """Pieces of a queue, by the stretches of one sequence and phase."""

    def __init__(self, own: list[Phase], total: int, window: int):
        self.own, self.total, self.window, self.ends = own, total, window, tail(total, window)
        self.done = [p.done for p in own]

    def _sequence(self, at: int) -> tuple[int, int, int]:
        """(number, begin, end) of the sequence that holds place ``at`` of the stream."""
        full = self.total // self.window
        if at < full * self.window:
            k = at // self.window
            return k, k * self.window, (k + 1) * self.window
        i = bisect.bisect_right(self.ends, at)
        return full + i, (self.ends[i - 1] if i else full * self.window), self.ends[i]

    def cut(self, begin: int, end: int) -> Iterator[tuple[int, int, int, int]]:
        """(begin, length, sequence, offset) of the pieces of places begin to end - 1 of the queue."""
        while begin < end:
            phase = self.own[bisect.bisect_right(self.done, begin) - 1]
            x = phase.place(begin - phase.done)
            number, low, high = self._sequence(phase.at + x)
            a, b = max(low - phase.at, 0), min(high - phase.at, phase.length)
            (had, before), (has, until) = phase.served(a), phase.served(b)
            length = min(end, phase.done + has) - begin
            yield begin, length, number, phase.at + a - low + until - before + begin - phase.done - had
            begin += length


def _cut(plans: dict, total: int, window: int, keys: int, small: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cutters = {s: Cutter([Phase(*p) for p in own], total, window) for s, own in plans.items()}
        for batch in batches:
            rows, values = [], [[] for _ in range(6)]
            for i, (source, begins, n, ids) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("source", "begins", "n_tokens", "ids")))):
                ids = np.frombuffer(ids, "<u2").astype("<u4") if small else np.frombuffer(ids, "<u4")
                for begin, length, number, offset in cutters[source].cut(begins, begins + n):
                    a = begin - begins
                    rows.append(i)
                    for out, x in zip(values, (a, length, zlib.crc32(ids[a:a + length].tobytes()), n, number, offset)):
                        out.append(x)
            picked = pa.array(rows, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(i).take(picked) for i in range(keys)), *(pa.array(v, pa.int64()) for v in values)],
                names=[*batch.schema.names[:keys], "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"])
    return run


def pack(tokens: DataFrame, keys: list[str], weights: dict | None = None, window: int = WINDOW, small: bool = True) -> DataFrame:
    """(keys, start, length, ids_crc32, doc_tokens, sequence_id, offset): the pieces of ``tokens``, as of ``tokenized``.

    ``weights`` are positive whole numbers by source (null is a source), those
    not named 1; by default a source's tokens.  Sources are served by name,
    null last.  On the driver: a row a source.
    """
    if window & (window - 1):
        raise ValueError("the window must be a power of two")
    spark = tokens.sparkSession
    parts = tokens.groupBy("source", "part").agg(F.sum("n_tokens").alias("n"))
    line = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = stored(parts.select("source", "part", "n", F.coalesce(F.sum("n").over(line), F.lit(0)).alias("before")), "parts")
    found = [(r.source, r.n) for r in parts.groupBy("source").agg(F.sum("n").alias("n")).collect()]
    sizes = dict(sorted(found, key=lambda x: (x[0] is None, x[0] or "")))
    plans = phases(sizes, {s: weights.get(s, 1) for s in sizes} if weights is not None else sizes)
    plans = {s: [(p.at, p.length, p.done, p.path) for p in own] for s, own in plans.items()}
    offsets = parts.select(F.col("source").alias("s"), F.col("part").alias("p"), "before")
    rows = tokens.join(offsets, F.col("source").eqNullSafe(F.col("s")) & (F.col("part") == F.col("p")))
    rows = rows.select(*keys, "source", (F.col("begins") + F.col("before")).alias("begins"), "n_tokens", "ids")
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:len(keys)]]
                       + [f"{c} long" for c in ("start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")])
    return rows.mapInArrow(_cut(plans, sum(sizes.values()), window, len(keys), small), schema)


def op13_pack(spark: SparkSession, sf_dir: str, path: str | None = None) -> DataFrame:
    """All documents in sequences of 4,096 tokens, each with the mixture of the whole corpus."""
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path(TOKENIZER)
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return pack(tokenized(docs, path, ["doc_id"]), ["doc_id"])
