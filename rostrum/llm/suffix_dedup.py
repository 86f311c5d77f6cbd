"""Repeated byte strings by a distributed difference-cover suffix sort.

Every byte covered by a string of ``length`` bytes that also starts anywhere
else in the corpus is removed (in all places, judged on the input).

1. *Anchors.* In each window of ``length`` bytes the leftmost smallest hash of
   a gram of half that length is its anchor (winnowing). Equal windows have
   equal anchors at equal places, so only windows whose anchor's gram occurs again
   can repeat; all others are settled without sorting. This loses nothing and
   leaves a few hundredths of ordinary text.
2. *Extents.* An anchor with the bytes of all its windows is an extent. Equal
   extents are counted by 128-bit hashes before anything else (all their windows
   repeat), and only distinct ones go on, dealt by the anchor's gram.
3. *Suffix sort* of the extents of a batch of grams (the gram that all windows
   share being one symbol) by the difference cover modulo 3: triples at positions not divisible by 3 are sorted and named, the
   names are sorted by recursion until they cover ``length`` bytes, the
   remaining suffixes are sorted by their first byte and the rank behind, and
   the two orders are merged. Windows that are neighbours in the order are
   compared on their ``length`` bytes.
4. *Hot grams.* A gram with more than ``block`` distinct extents (a passage in
   very many surroundings) isn't sorted in one place: its windows are dealt anew by
   halves of their distance to the anchor, together with a hash of the bytes
   that the windows of a half share, until each part is small. At a distance
   range of one all windows of a part are equal, so this always ends.
5. Repeating windows become byte ranges of their text, merged per document.

Texts that are equal as a whole are sorted once; with ``length`` bytes or more
all of them is removed.

Defined results: a null text is empty; texts shorter than ``length`` keep all
bytes; rows that repeat, also with the same or a null id, are texts of their
own; an empty table gives no rows. Columns beside id and text aren't read.
Memory of a task: a batch of extents, or one document.
"""
from __future__ import annotations

from functools import reduce

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import forget, land
from .common import ROWS_AT_ONCE, array_batches, arrow_schema, as_batches, rows_of

LENGTH = 200
BLOCK = 4096             # distinct extents of a gram that are sorted together
BATCH_BYTES = 500_000    # extents sorted at once
STEP = 1 << 19           # windows of a long text looked at together
SHORT = 1 << 16          # texts of fewer bytes are looked at together, about as many bytes at once
PLACE = (1 << 20) - 1    # bits of a hash that make room for its place; over STEP and any length

_ODD = 0x9E3779B97F4A7C15
_INVERSE = pow(_ODD, -1, 1 << 64)
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(n: int):
    """At least n powers of the odd base and of its inverse modulo 2^64."""
    size = 1 << max(12, (n - 1).bit_length())
    held = max(_POWERS, default=0)
    if held < size:
        both = []
        for base in (_ODD, _INVERSE):
            a = np.full(size, base, np.uint64)
            a[0] = 1
            both.append(np.multiply.accumulate(a))
        _POWERS.clear()
        _POWERS[size] = tuple(both)
        held = size
    return _POWERS[held]


def gram_hashes(data: np.ndarray, size: int) -> np.ndarray:
    """A 64-bit hash of every run of ``size`` bytes, equal for equal bytes."""
    up, down = _powers(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:len(data)], out=sums[1:])
    h = (sums[size:] - sums[:-size]) * down[:len(data) - size + 1]
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(32)
    return h


def anchors_of(texts: list[bytes], length: int) -> tuple[np.ndarray, ...]:
    """Columns (number of the text, gram hash, anchor, first window, last window), windows in order.

    Smallest is by the hash without its lowest bits, which hold the place; so equal windows still have equal anchors."""
    gram = (length + 1) // 2
    width = length - gram + 1           # grams of a window
    whole = np.frombuffer(b"".join(texts), np.uint8)
    ends = np.cumsum([len(t) for t in texts])
    starts = ends - [len(t) for t in texts]
    inside = np.zeros(len(whole) + 1, bool)         # windows that don't run over their text
    for start, end in zip(starts.tolist(), ends.tolist()):
        inside[start:max(start, end - length + 1)] = True
    out = []
    for at in range(0, len(whole) - length + 1, STEP):
        h = gram_hashes(whole[at:at + STEP + length - 1], gram)
        least, reach = h & ~np.uint64(PLACE) | np.arange(len(h), dtype=np.uint64), 1      # leftmost smallest of `reach` grams from each on
        while reach < width:
            more = min(reach, width - reach)
            least = np.minimum(least[:-more], least[more:])
            reach += more
        least = (least & np.uint64(PLACE)).astype(np.int64)
        ok = inside[at:at + len(least)]
        new = np.append(True, (least[1:] != least[:-1]) | ~ok[:-1] | ~ok[1:])
        first, last = np.flatnonzero(ok & new), np.flatnonzero(ok & np.append(new[1:], True))
        where, text = least[first], np.searchsorted(starts, first + at, "right") - 1
        shift = at - starts[text]
        out.append((text, h[where].view(np.int64), where + shift, first + shift, last + shift))
    return tuple(map(np.concatenate, zip(*out))) if out else (np.zeros(0, np.int64),) * 5


def anchors(text: bytes, length: int) -> list[tuple[int, int, int, int]]:
    """(gram hash, anchor, first window, last window) of a text, windows in order."""
    return list(zip(*(c.tolist() for c in anchors_of([text], length)[1:]), strict=True))


# ------------------------------------------------- the difference-cover sort
def _names(*columns: np.ndarray) -> tuple[np.ndarray, int]:
    """Dense ranks from 0 of the rows of the columns, and how many there are."""
    order = np.lexsort(columns[::-1]) if len(columns) > 1 else np.argsort(columns[0])
    new = np.zeros(len(order), bool)
    for c in columns:
        sorted_ = c[order]
        new[1:] |= sorted_[1:] != sorted_[:-1]
    ranks = np.empty(len(order), np.int64)
    ranks[order] = np.cumsum(new)
    return ranks, int(new.sum()) + 1 if len(order) else 0


def suffix_ranks(s: np.ndarray, reach: int, cover: int = 1) -> np.ndarray:
    """Ranks of all suffixes of ``s`` (values from 1), equal only for suffixes alike in ``reach`` bytes or more.

    ``cover``: the bytes that a value of ``s`` stands for.
    """
    n = len(s)
    if cover >= reach or n < 2:
        return _names(s)[0]
    padded = np.concatenate([s, np.zeros(3, np.int64)])
    one, two = np.arange(1, n + 1, 3), np.arange(2, n + 1, 3)      # one past the end stands for the empty suffix
    sample = np.concatenate([one, two])
    limit = int(s.max()) + 1
    if limit < 1 << 21:
        names, count = _names(padded[sample] * limit * limit + padded[np.minimum(sample + 1, n)] * limit + padded[np.minimum(sample + 2, n)])
    else:
        names, count = _names(padded[sample], padded[np.minimum(sample + 1, n)], padded[np.minimum(sample + 2, n)])
    if count < len(sample) and cover * 3 < reach:
        names = suffix_ranks(names + 1, reach, cover * 3)
    rank = np.zeros(n + 3, np.int64)        # of sampled suffixes, from 1
    rank[sample] = names + 1
    rest = np.arange(0, n, 3)
    behind = int(rank.max()) + 1
    rest_key = padded[rest] * behind + rank[rest + 1]
    # Merge: against positions 1 mod 3 by (value, rank behind), against 2 mod 3 by (value, value, rank behind).
    one_key = padded[one] * behind + rank[np.minimum(one + 1, n + 2)]
    keys = (np.concatenate([padded[two], padded[rest]]),
            np.concatenate([padded[np.minimum(two + 1, n)], padded[np.minimum(rest + 1, n)]]),
            np.concatenate([rank[np.minimum(two + 2, n + 2)], rank[np.minimum(rest + 2, n + 2)]]))
    if limit * limit * behind < 1 << 62:
        two_rank = (keys[0] * limit + keys[1]) * behind + keys[2]
    else:
        two_rank, _ = _names(*keys)
    two_key, rest_key2 = two_rank[:len(two)], two_rank[len(two):]
    sorted_rest, sorted_rest2 = np.sort(rest_key), np.sort(rest_key2)
    before = np.empty(len(sample), np.int64)         # remaining suffixes before each sampled one
    before[:len(one)] = np.searchsorted(sorted_rest, one_key, "left")
    before[len(one):] = np.searchsorted(sorted_rest2, two_key, "left")
    merged = np.empty(n + 1, np.int64)
    order = np.argsort(names, kind="stable")
    sorted_names = names[order]
    sampled_before = np.searchsorted(sorted_names, sorted_names, "left")
    merged[sample[order]] = sampled_before + np.maximum.accumulate(before[order]) if len(order) else 0
    sample_one, sample_two = np.sort(one_key), np.sort(two_key)
    merged[rest] = (np.searchsorted(sorted_rest, rest_key, "left") + np.searchsorted(sample_one, rest_key, "left")
                    + np.searchsorted(sample_two, rest_key2, "left"))
    return merged[:n]


def repeated_windows(groups: np.ndarray, counts: np.ndarray, sizes: np.ndarray, symbols: np.ndarray,
                     reach: int) -> np.ndarray:
    """Of all windows of ``reach`` symbols of the extents, one extent after another: which are in another extent of their group.

    The extents lie one after another in ``symbols`` (from 1), ``sizes`` long;
    the ``counts`` windows of an extent start at its first symbols.
    """
    starts = np.cumsum(sizes) - sizes
    own = np.repeat(np.arange(len(sizes)), counts)
    at = np.arange(len(own)) - np.repeat(np.cumsum(counts) - counts, counts) + starts[own]
    ranks = suffix_ranks(symbols, reach)
    group = groups[own]
    limit = int(ranks.max(initial=0)) + 1
    packed = int(group.max(initial=0)) < (1 << 62) // limit
    order = np.argsort(group * limit + ranks[at]) if packed else np.lexsort((ranks[at], group))
    windows = np.lib.stride_tricks.sliding_window_view(symbols.astype(np.int32), reach)
    same = np.zeros(len(order) + 1, bool)                # is a window equal to the one before it
    for a in range(0, len(order) - 1, 20_000):
        x, y = order[a:a + 20_000], order[a + 1:a + 20_001]
        x = x[:len(y)]
        near = np.flatnonzero(group[x] == group[y])
        x, y = at[x[near]], at[y[near]]
        near = near[(symbols[x] == symbols[y]) & (symbols[x + reach - 1] == symbols[y + reach - 1])]
        x, y = at[order[a:a + 20_000][near]], at[order[a + 1:a + 20_001][near]]
        same[a + 1 + near] = (windows[x] == windows[y]).all(1)
    found = np.zeros(len(order), bool)
    found[order] = same[:-1] | same[1:]
    return found


def sort_extents(extents: list[tuple[int, int, int, bytes]], length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(number of the extent, first, last) of the runs of windows that are in another extent of the same gram.

    ``extents`` are (gram hash, low, high, bytes); windows are numbered in page order. All windows hold the gram itself, so it is
    one symbol of the sorted strings.
    """
    size = (length + 1) // 2
    grams: dict[tuple[int, bytes], int] = {}
    parts, sizes, marks, symbols_, counts = [], [], [], [], []
    at = 0
    for gram, low, high, data in extents:
        key = gram, data[high:high + size]
        symbols_.append(257 + grams.setdefault(key, len(grams)))
        marks.append(at + high)
        parts += [data[:high], b"\0", data[high + size:]]
        sizes.append(len(data) - size + 1)
        counts.append(high - low + 1)
        at += sizes[-1]
    symbols = np.frombuffer(b"".join(parts), np.uint8).astype(np.int64) + 1
    symbols[marks] = symbols_
    counts = np.array(counts)
    found = repeated_windows(np.array(symbols_), counts, np.array(sizes), symbols, length - size + 1)
    own = np.repeat(np.arange(len(counts)), counts)
    apart = np.append(own[1:] != own[:-1], True)             # the last window of an extent
    ends = np.flatnonzero(found & (apart | ~np.append(found[1:], False)))
    begins = np.flatnonzero(found & (np.append(True, apart[:-1]) | ~np.append(False, found[:-1])))
    place = (np.cumsum(counts) - counts)[own[begins]]
    return own[begins], begins - place, ends - place


# ------------------------------------------------------------------ the jobs
def _anchor_table(texts: DataFrame, length: int) -> DataFrame:
    """(gram, text_key, at): a row per anchor; ``at`` packs its place and its windows."""
    ddl = "gram long, text_key long, at long, near long"
    schema = arrow_schema(ddl)

    def rows(keys, texts):
        text, gram, where, first, last = anchors_of(texts, length)
        yield from array_batches([gram, np.array(keys, np.int64)[text], where, (where - first) << 16 | where - last], schema)

    def find(batches):
        keys, short, size = [], [], 0
        for key, text in rows_of(batches, ["text_key", "text"]):
            if not text or len(text) * 4 < length:
                continue
            data = text.encode()
            if len(data) >= SHORT:
                yield from rows([key], [data])
            elif len(data) >= length:
                keys.append(key)
                short.append(data)
                size += len(data)
            if size >= SHORT:
                yield from rows(keys, short)
                keys, short, size = [], [], 0
        if keys:
            yield from rows(keys, short)

    return texts.select("text_key", "text").mapInArrow(find, ddl)


def _candidates(table: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Anchors whose gram occurs again in other text or elsewhere in the same one, and the table of these grams.

    The grams are landed, so that the join's sides are plain and Spark can split a gram that holds many of the rows."""
    again = (table.groupBy("gram").agg(F.min("text_key").alias("a"), F.max("text_key").alias("b"),
                                       F.min("at").alias("c"), F.max("at").alias("d"))
             .filter("a <> b or c <> d").select("gram"))
    again = land(again, "grams")
    return table.join(again, "gram"), again


def _per_text(rows: DataFrame) -> DataFrame:
    """Rows (gram, at, near) of a text as one list; it is no longer than the text."""
    return rows.groupBy("text_key").agg(F.collect_set(F.struct("gram", "at", "near")).alias("found"))


def _gram_hashes_at(data: bytes, places: np.ndarray, size: int) -> np.ndarray:
    """The gram hashes at some places of a text."""
    whole = np.frombuffer(data, np.uint8)
    if len(whole) <= size * len(places) and len(whole) <= STEP:
        return gram_hashes(whole, size)[places].view(np.int64)
    h = np.empty(len(places), np.uint64)
    for a in range(0, len(places), 10_000):
        grams = whole[places[a:a + 10_000, None] + np.arange(size)]
        h[a:a + 10_000] = ((grams.astype(np.uint64) + np.uint64(1)) * _powers(size)[0][:size]).sum(1, dtype=np.uint64)
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(32)
    return h.view(np.int64)


def _listed(batches, text_col: str, list_col: str):
    """Of each row its other columns' values as a tuple, the text's bytes and the list's fields as arrays."""
    for batch in batches:
        for start in range(0, batch.num_rows, ROWS_AT_ONCE):
            part = batch.slice(start, ROWS_AT_ONCE)
            column = {f.name: part.column(k) for k, f in enumerate(part.schema)}
            lists = column.pop(list_col)
            texts = column.pop(text_col).to_pylist()
            others = list(zip(*[c.to_pylist() for c in column.values()])) or [()] * len(texts)
            edges = lists.offsets.to_numpy()
            edges = (edges - edges[0]).tolist()
            flat = lists.flatten()
            fields = [c.to_numpy(zero_copy_only=False) for c in flat.flatten()]
            for other, text, a, b in zip(others, texts, edges, edges[1:]):
                yield other, text.encode(), [f[a:b] for f in fields]


def _references(texts: DataFrame, length: int, parts: int) -> DataFrame:
    """A row per extent, without its bytes: bucket, a 128-bit hash of the extent, its place.

    ``parts`` over 1 deals the windows of an anchor to that many ranges of
    their distance, each in a bucket of the bytes that the range's windows share.
    """
    ddl = "bucket long, key1 long, key2 long, text_key long, gram long, at long, near long"
    schema = arrow_schema(ddl)
    size = (length + 1) // 2
    width = length - size + 1

    def of_text(key, data, found, digest):
        gram, at, near = found
        inside = at + size <= len(data)
        gram, at, near = gram[inside], at[inside], near[inside]
        if not len(at):
            return
        # other places are another text's, whose key is the same
        true = _gram_hashes_at(data, at, size) == gram
        gram, at, near = gram[true], at[true], near[true]
        for k in range(parts):
            a, b = width * k // parts, width * (k + 1) // parts - 1
            lo, hi = np.maximum(near & 0xFFFF, a), np.minimum(near >> 16, b)
            some = np.flatnonzero(lo <= hi)
            if a > b or not len(some):
                continue
            lo, hi, where, bucket = lo[some], hi[some], at[some], gram[some]
            if parts > 1:
                shared = b"".join([digest(data[w - a:w - b + length], seed=k)[:8] for w in where.tolist()])
                bucket = np.frombuffer(shared, "<i8")
            span = hi << 16 | lo
            codes = b"".join([digest(data[w - h:w - l + length], seed=l << 16 | h)
                              for w, h, l in zip(where.tolist(), hi.tolist(), lo.tolist())])
            codes = np.frombuffer(codes, "<i8").reshape(-1, 2)
            yield bucket, codes[:, 0], codes[:, 1], np.full(len(some), key), gram[some], where, span

    def refer(batches):
        from xxhash import xxh3_128_digest

        rows, n = [], 0
        for (key,), data, found in _listed(batches, "text", "found"):
            for columns in of_text(key, data, found, xxh3_128_digest):
                rows.append(columns)
                n += len(columns[0])
            if n >= 20_000:
                yield from array_batches(list(map(np.concatenate, zip(*rows))), schema)
                rows, n = [], 0
        if rows:
            yield from array_batches(list(map(np.concatenate, zip(*rows))), schema)

    return texts.select("text_key", "text", "found").mapInArrow(refer, ddl)


def _sorted(texts: DataFrame, length: int) -> DataFrame:
    """(bucket, key1, key2, first, last): repeated windows of distinct extents, sorted in batches of whole buckets."""
    ddl = "bucket long, key1 long, key2 long, near long, extent binary"
    schema = arrow_schema(ddl)

    def cut(batches):
        def results():
            for _, data, (bucket, key1, key2, at, near) in _listed(batches, "text", "wanted"):
                first, last = (at - (near >> 16)).tolist(), (at - (near & 0xFFFF) + length).tolist()
                yield from zip(bucket.tolist(), key1.tolist(), key2.tolist(), near.tolist(), [data[a:b] for a, b in zip(first, last)])
        yield from as_batches(results(), schema)

    out_ddl = "bucket long, key1 long, key2 long, first int, last int"
    out_schema = arrow_schema(out_ddl)

    def batched(rows):
        batch, weight, seen = [], 0, None
        for row in rows:
            if row[0] != seen and weight >= BATCH_BYTES:
                yield batch
                batch, weight = [], 0
            seen = row[0]
            batch.append(row)
            weight += len(row[4])
        if batch:
            yield batch

    def sort(batches):
        def results():
            for batch in batched(rows_of(batches, ["bucket", "key1", "key2", "near", "extent"])):
                runs = sort_extents([(bucket, near & 0xFFFF, near >> 16, extent) for bucket, _, _, near, extent in batch], length)
                for own, a, b in zip(*(c.tolist() for c in runs)):
                    bucket, key1, key2, near, _ = batch[own]
                    yield bucket, key1, key2, (near >> 16) - a, (near >> 16) - b       # distances from the anchor
        yield from as_batches(results(), out_schema)

    return (texts.mapInArrow(cut, ddl).repartition("bucket").sortWithinPartitions("bucket").mapInArrow(sort, out_ddl))


def repeated_ranges(texts: DataFrame, length: int = LENGTH, block: int = BLOCK) -> tuple[DataFrame, list[DataFrame]]:
    """Texts with candidates, and tables (text_key, start, end) of repeated bytes, from ``text_key`` and ``text``; all are landed."""
    if not 16 <= length < 1 << 16:
        raise ValueError("length must be 16 to 65535 bytes")
    table = land(_anchor_table(texts, length), "anchors")
    candidates, grams = _candidates(table)
    found = _per_text(candidates)
    first = F.row_number().over(Window.partitionBy("text_key").orderBy(F.lit(1)))
    # Equal texts meet in the join; one of them goes on.
    held = texts.join(found, "text_key").withColumn("n", first).filter("n = 1").drop("n")
    held = land(held, "candidates")
    forget(table, grams)
    marks, parts, asked, before = [], 1, held, []
    while True:
        refs = land(_references(asked, length, parts), "extents")
        forget(*before)
        keys = ["bucket", "key1", "key2"]
        distinct = land(refs.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies"), F.first("text_key").alias("text_key"),
                                                F.first("at").alias("at"), F.first("near").alias("near")), "distinct")
        sizes = distinct.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
        several = distinct.join(sizes.filter(F.col("n") <= block), "bucket")
        wanted = several.groupBy("text_key").agg(F.collect_list(F.struct(*keys, "at", "near")).alias("wanted"))
        runs = _sorted(held.select("text_key", "text").join(wanted, "text_key").select("text", "wanted"), length)
        copied = distinct.filter("copies > 1").select(*keys, F.shiftright("near", 16).cast("int").alias("first"),
                                                      F.col("near").bitwiseAND(F.lit(0xFFFF)).cast("int").alias("last"))
        met = (refs.select(*keys, "text_key", "at").join(runs.unionByName(copied), keys)
               .select("text_key", (F.col("at") - F.col("first")).alias("start"),
                       (F.col("at") - F.col("last") + length).alias("end")))
        marks.append(land(met, "marks"))
        before = [refs, distinct]
        large = sizes.filter(F.col("n") > block).select("bucket")
        if large.isEmpty():
            forget(*before)
            return held, marks
        parts *= 2
        again = _per_text(refs.join(large, "bucket").select("text_key", "gram", "at", "near"))
        asked = held.drop("found").join(again, "text_key")


def _merge(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(ranges):
        if out and a <= out[-1][1]:
            out[-1] = out[-1][0], max(out[-1][1], b)
        else:
            out.append((a, b))
    return out


def _keyed(docs: DataFrame, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.withColumn("text_key", F.xxhash64(text)).withColumn("text_key2", F.xxhash64(F.lit(7), text))


def _kept(docs: DataFrame, length: int, block: int, text_col: str) -> DataFrame:
    """(text_key, copies, kept binary, n_removed, n_spans) of the texts of which something is removed."""
    keyed = _keyed(docs.select(text_col), text_col).select(F.col(text_col).alias("text"), "text_key")
    held, marks = repeated_ranges(keyed, length, block)
    found = reduce(DataFrame.unionByName, marks)
    per_text = found.groupBy("text_key").agg(F.collect_set(F.struct("start", "end")).alias("ranges"))
    ddl = "text_key long, kept binary, n_removed long, n_spans long"
    schema = arrow_schema(ddl)

    def cut(batches):
        def results():
            for (key,), data, (start, end) in _listed(batches, "text", "ranges"):
                spans = _merge(list(zip(start.tolist(), end.tolist())))
                kept, at = [], 0
                for a, b in spans:
                    kept.append(data[at:a])
                    at = b
                yield key, b"".join([*kept, data[at:]]), sum(b - a for a, b in spans), len(spans)
        yield from as_batches(results(), schema, 200)

    kept = land(held.drop("found").join(per_text, "text_key").mapInArrow(cut, ddl), "kept")
    forget(held, *marks)
    return kept


def dedup_documents(docs: DataFrame, length: int = LENGTH, block: int = BLOCK, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of every row."""
    kept = _kept(docs, length, block, text_col)
    data = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    base = _keyed(docs, text_col).select(F.col(id_col), "text_key", "text_key2",
                                         F.octet_length(data).cast("long").alias("n_bytes"), F.sha2(data, 256).alias("sha"))
    copies = base.groupBy("text_key", "text_key2").agg(F.count(F.lit(1)).alias("copies")).filter("copies > 1")
    some = kept.select("text_key", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha"))
    all_ = (F.col("copies") > 1) & (F.col("n_bytes") >= length)
    joined = base.join(copies, ["text_key", "text_key2"], "left").join(some, "text_key", "left")
    return joined.select(
        id_col, "n_bytes", F.when(all_, F.col("n_bytes")).otherwise(F.coalesce("n_removed", F.lit(0))).alias("n_removed"),
        F.when(all_, 1).otherwise(F.coalesce("n_spans", F.lit(0))).cast("long").alias("n_spans"),
        F.when(all_, F.sha2(F.lit(b""), 256)).otherwise(F.coalesce("kept_sha", "sha")).alias("kept_sha256"))


def without_repeats(docs: DataFrame, length: int = LENGTH, block: int = BLOCK, text_col: str = "text",
                    length_col: str | None = "n_chars") -> DataFrame:
    """All rows and columns; repeated strings are cut out of the text. Characters cut in two go whole."""
    # own names inside: a user's column may have any
    names, kinds = docs.columns, docs.schema
    held = [f"c{k}" for k in range(len(names))]
    docs, text = docs.toDF(*held), held[names.index(text_col)]
    kept = _kept(docs, length, block, text).select("text_key", "kept")
    keyed = _keyed(docs, text)
    copies = keyed.groupBy("text_key", "text_key2").agg(F.count(F.lit(1)).alias("copies"))
    # One table of changes, so that the texts are shuffled once.
    changes = copies.join(kept, "text_key", "left").filter("copies > 1 or kept is not null").withColumn(
        "copies", F.when(F.col("copies") > 1, F.col("copies")))
    joined = keyed.join(changes, ["text_key", "text_key2"], "left")

    def rebuild(batches):
        import pyarrow as pa

        for batch in batches:
            col = {f.name: batch.column(k).to_pylist() for k, f in enumerate(batch.schema) if f.name in (text, "copies", "kept")}
            texts = []
            for whole, copies_, data in zip(col[text], col["copies"], col["kept"], strict=True):
                if copies_ and whole and len(whole.encode()) >= length:
                    whole = ""
                elif data is not None:
                    whole = data.decode("utf-8", "ignore")
                texts.append(whole)
            out = [pa.array(texts, pa.string()) if n == text else batch.column(batch.schema.get_field_index(n)) for n in held]
            yield pa.RecordBatch.from_arrays(out, names=held)

    out = joined.select(*held, "copies", "kept").mapInArrow(rebuild, docs.schema)
    if length_col in names:
        place = held[names.index(length_col)]
        out = out.withColumn(place, F.coalesce(F.length(text), F.lit(0)).cast(kinds[length_col].dataType))
    return out.toDF(*names)
