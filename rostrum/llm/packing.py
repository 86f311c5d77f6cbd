"""Packing of token sequences by non-negative least squares over length combinations.

1. Every document is tokenized once. It is cut into full windows and one
   remainder shorter than the window; only counts, checksums and ranks leave
   the task, not the ids.
2. The histogram of remainder lengths (at most one row per length, whatever
   the input) goes to the driver. All combinations of up to ``depth`` lengths
   that fill a window exactly are enumerated, and non-negative least squares
   finds how often to repeat each so that the histogram is met. The counts are
   rounded, never beyond the histogram.
3. What is left over is packed greedily, longest first: pieces are laid end to
   end and cut where a window is full. The last, unfilled window is cut at its
   powers of two, which need no padding.
4. Each remainder finds its place by its rank among the remainders of equal
   length; ranks are counted per block of rows and shifted by the blocks
   before, so that no length, however frequent, meets in one task.
5. Only documents whose remainder was cut are tokenized again for checksums.

Defined results: a null text is empty; every document ends with ``end_id``, so
the shortest has one token; equal rows are packed one by one; an empty table
gives an empty result. Columns beside id and text aren't read.
"""
from __future__ import annotations

import zlib
from collections import Counter

import numpy as np
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import land
from .byte_bpe import load_tokenizer
from .common import arrow_schema, as_batches, rows_of

WINDOW = 2048
DEPTH = 3
ROUNDS = 300


# ------------------------------------------------------------------ the plan
def combinations(window: int, depth: int) -> np.ndarray:
    """All multisets of up to ``depth`` (1 to 3) lengths below ``window`` that sum to it; unused slots are 0."""
    if not 2 <= depth <= 3:
        raise ValueError("depth must be 2 or 3")
    half = np.arange(1, window // 2 + 1)
    pairs = np.stack([window - half, half, np.zeros_like(half)], 1)
    if depth == 2:
        return pairs
    third = [np.arange(c, (window - c) // 2 + 1) for c in range(1, window // 3 + 1)]
    low = np.repeat(np.arange(1, len(third) + 1), [len(t) for t in third])
    mid = np.concatenate(third) if third else low
    triples = np.stack([window - low - mid, mid, low], 1)
    return np.concatenate([pairs, triples])


def solve_counts(histogram: np.ndarray, combos: np.ndarray, rounds: int = ROUNDS) -> np.ndarray:
    """Repeat counts x >= 0 that minimise |A x - histogram|^2, by accelerated projected gradient.

    A has a column per combination: how often it takes each length.
    """
    size = len(histogram)
    taken = combos > 0

    def use(x):
        out = np.bincount(combos.ravel(), weights=(x[:, None] * taken).ravel(), minlength=size)
        out[0] = 0
        return out

    def back(r):
        return (r[combos] * taken).sum(1)

    x = np.ones(len(combos))
    bound = 1.0
    for _ in range(20):              # the largest eigenvalue of A'A, by power iteration
        y = back(use(x))
        bound = np.linalg.norm(y)
        x = y / bound
    step = 1 / (1.05 * bound)
    x = y = np.zeros(len(combos))
    t = 1.0
    for _ in range(rounds):
        new = np.maximum(0, y - step * back(use(y) - histogram))
        grown = (1 + (1 + 4 * t * t) ** 0.5) / 2
        y = new + (t - 1) / grown * (new - x)
        x, t = new, grown
    return x


def round_counts(histogram: np.ndarray, combos: np.ndarray, x: np.ndarray) -> list[tuple[tuple[int, ...], int]]:
    """(combination, whole repeat count), the largest first, within the histogram."""
    left = histogram.copy()
    out = []
    order = np.argsort(-x, kind="stable")
    for i in order[x[order] > 1e-6]:
        need = Counter(int(v) for v in combos[i] if v)
        count = min(int(np.ceil(x[i])), *(int(left[v]) // k for v, k in need.items()))
        if count > 0:
            for v, k in need.items():
                left[v] -= k * count
            out.append((tuple(int(v) for v in combos[i] if v), count))
    return out


class Plan:
    """Places of remainders by (length, rank); bounded by the number of combinations."""

    def __init__(self, histogram: np.ndarray, window: int, depth: int = DEPTH):
        self.window = window
        used = []
        if histogram.sum():
            combos = combinations(window, depth)
            fits = (histogram[combos] > 0) | (combos == 0)
            combos = combos[fits.all(1)]
            if len(combos):
                used = round_counts(histogram, combos, solve_counts(histogram.astype(float), combos))
        ends = np.zeros(window, np.int64)
        slots: dict[int, list] = {}
        base = 0
        for combo, count in used:
            offset = 0
            for length in combo:
                slots.setdefault(length, []).append((int(ends[length]), base, offset))
                ends[length] += count
                offset += length
            base += count
        self.slots = {k: np.array(v, np.int64) for k, v in slots.items()}
        self.ends = ends                      # ranks from here on are left over
        self.first_left = base
        left = histogram - ends
        tokens = left * np.arange(window)
        self.start = tokens[::-1].cumsum()[::-1] - tokens      # longer lengths lie before
        total = int(tokens.sum())
        self.tail = total // window * window
        self.borders = [self.tail]
        rest, size = total - self.tail, window
        while rest:
            size >>= 1
            if rest >= size:
                self.borders.append(self.borders[-1] + size)
                rest -= size
        self.first_full = base + total // window + len(self.borders) - 1

    def places(self, length: int, rank: int) -> list[tuple[int, int, int, int]]:
        """(start in the remainder, length, sequence, offset) of its pieces."""
        if rank < self.ends[length]:
            s = self.slots[length]
            lo, base, offset = s[np.searchsorted(s[:, 0], rank, "right") - 1]
            return [(0, length, int(base + rank - lo), int(offset))]
        at = int(self.start[length] + (rank - self.ends[length]) * length)
        end, out, begin = at + length, [], at
        while at < end:
            if at < self.tail:
                sequence, low, high = at // self.window, at // self.window * self.window, (at // self.window + 1) * self.window
            else:
                k = int(np.searchsorted(self.borders, at, "right"))
                sequence, low, high = self.tail // self.window + k - 1, self.borders[k - 1], self.borders[k]
            stop = min(high, end)
            out.append((at - begin, stop - at, self.first_left + sequence, at - low))
            at = stop
        return out


# ------------------------------------------------------------------ the jobs
def _measured(docs: DataFrame, tokenizer: str, window: int, end_id: int, id_col: str, text_col: str) -> DataFrame:
    """A small row per document: its block, token count, window and remainder checksums, and counts before it."""
    ddl = (f"doc_id {docs.schema[id_col].dataType.simpleString()}, text_key long, block long, n long, rest long, "
           "rank_in_block long, full_in_block long, full_crcs binary, rest_crc long")
    schema = arrow_schema(ddl)
    end = np.array([end_id], "<u4").tobytes()

    def measure(batches):
        encode = load_tokenizer(tokenizer).encode
        block = TaskContext.get().partitionId()

        def results():
            ranks, full_before = Counter(), 0
            for key, text, text_key in rows_of(batches, ["doc_id", "text", "text_key"]):
                ids = memoryview(encode(text) + end)
                n = len(ids) // 4
                full, rest = divmod(n, window)
                crcs = [zlib.crc32(ids[k * window * 4:(k + 1) * window * 4]) for k in range(full)]
                yield (key, text_key, block, n, rest, ranks[rest], full_before, np.array(crcs, "<u4").tobytes(),
                       zlib.crc32(ids[full * window * 4:]))
                ranks[rest] += 1
                full_before += full
        yield from as_batches(results(), schema)

    text = F.col(text_col)
    return docs.select(F.col(id_col).alias("doc_id"), text.alias("text"),
                       F.xxhash64(F.coalesce(text, F.lit(""))).alias("text_key")).mapInArrow(measure, ddl)


def pack_documents(docs: DataFrame, tokenizer: str, window: int = WINDOW, depth: int = DEPTH, end_id: int = 1,
                   id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset: a row per piece."""
    measured = land(_measured(docs, tokenizer, window, end_id, id_col, text_col), "measured")
    per_length = measured.groupBy("block", "rest").agg(F.count(F.lit(1)).alias("k"))
    histogram = np.zeros(window, np.int64)
    for rest, k in per_length.groupBy("rest").agg(F.sum("k")).collect():     # at most a row per length
        histogram[rest] = k
    histogram[0] = 0
    plan = Plan(histogram, window, depth)

    before = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    ranks = per_length.select("block", "rest", F.coalesce(F.sum("k").over(
        before.partitionBy("rest")), F.lit(0)).alias("rank_before"))
    fulls = (measured.groupBy("block").agg(F.sum(F.floor(F.col("n") / window)).alias("k"))      # a row per block
             .select("block", F.coalesce(F.sum("k").over(before), F.lit(0)).alias("full_before")))
    placed = measured.join(ranks, ["block", "rest"]).join(fulls, "block")

    id_type = measured.schema["doc_id"].dataType.simpleString()
    ddl = (f"doc_id {id_type}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, "
           "offset long, text_key long")
    schema = arrow_schema(ddl)

    def cut(batches):
        def results():
            columns = ["doc_id", "text_key", "n", "rest", "rank_in_block", "rank_before", "full_in_block",
                       "full_before", "full_crcs", "rest_crc"]
            for key, text_key, n, rest, rank, ranks_, full, fulls_, crcs, rest_crc in rows_of(batches, columns):
                for k, crc in enumerate(np.frombuffer(crcs, "<u4").tolist()):
                    yield key, k * window, window, crc, n, plan.first_full + fulls_ + full + k, 0, text_key
                if rest:
                    places = plan.places(rest, rank + ranks_)
                    for start, length, sequence, offset in places:
                        crc = rest_crc if len(places) == 1 else None
                        yield key, n - rest + start, length, crc, n, sequence, offset, text_key
        yield from as_batches(results(), schema)

    pieces = land(placed.mapInArrow(cut, ddl), "pieces")
    whole = pieces.filter(F.col("ids_crc32").isNotNull()).drop("text_key")
    open_ = pieces.filter(F.col("ids_crc32").isNull()).drop("ids_crc32")
    return whole.unionByName(_with_checksums(open_, docs, tokenizer, end_id, id_col, text_col))


def _with_checksums(pieces: DataFrame, docs: DataFrame, tokenizer: str, end_id: int, id_col: str,
                    text_col: str) -> DataFrame:
    """Tokenize the documents of cut remainders again. Rows equal in id and text share their cuts."""
    cuts = (pieces.groupBy("doc_id", "text_key")
            .agg(F.collect_set(F.struct("start", "length")).alias("cuts"))
            .select(F.col("doc_id").alias("cut_id"), F.col("text_key").alias("cut_key"), "cuts"))
    keyed = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"),
                        F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("text_key"))
    found = keyed.join(cuts, F.col("doc_id").eqNullSafe(F.col("cut_id")) & (F.col("text_key") == F.col("cut_key")))
    ddl = f"doc_id {pieces.schema['doc_id'].dataType.simpleString()}, text_key long, start long, length long, ids_crc32 long"
    schema = arrow_schema(ddl)
    end = np.array([end_id], "<u4").tobytes()

    def checksums(batches):
        encode = load_tokenizer(tokenizer).encode

        def results():
            for key, text_key, text, cuts_ in rows_of(batches, ["doc_id", "text_key", "text", "cuts"]):
                ids = memoryview(encode(text) + end)
                for c in cuts_:
                    a = c["start"] * 4
                    yield key, text_key, c["start"], c["length"], zlib.crc32(ids[a:a + c["length"] * 4])
        yield from as_batches(results(), schema)

    sums = (found.select("doc_id", "text_key", "text", "cuts").mapInArrow(checksums, ddl)
            .groupBy("doc_id", "text_key", "start", "length").agg(F.min("ids_crc32").alias("ids_crc32"))
            .toDF("k_id", "k_key", "k_start", "k_length", "ids_crc32"))
    same = (F.col("doc_id").eqNullSafe(F.col("k_id")) & (F.col("text_key") == F.col("k_key"))
            & (F.col("start") == F.col("k_start")) & (F.col("length") == F.col("k_length")))
    return pieces.join(sums, same).select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")
