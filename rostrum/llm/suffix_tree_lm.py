"""Scoring with a probabilistic suffix tree over words.

Tokens are words and one end token a text. The tree's contexts are the last
0, 1 or 2 tokens (never over a text's start):

* Counting. Every (context, next) pair that occurs at least twice in the
  training texts is kept with its exact count, at any size of the input.
* Divergence test. A context is kept as a state where its next-token
  distribution says more than that of its suffix: count * KL divergence (over the
  kept pairs and the rest) is at least ``gain`` nats. The suffix of a state is
  a state too.
* Smoothing. At the root P(x) = (c + 0.5) / (N + 0.5 (V + 1)). In a state,
  P(x | s) = (n(s, x) + weight * P(x | suffix)) / (n(s) + weight) for kept
  pairs; what is left over is shared by all other tokens in proportion to
  P(x | suffix).
* Scoring. Each token is scored in the longest suffix of the text so far that
  is a state.

Counting hands on arrays, one a task and bucket of codes, and sums them bucket by
bucket; tokens, pairs and triples are counted together, each turn those with its share of the codes. The tree is a written table of arrays that grows with the input. Its entries that make up
at least ``share`` of all training tokens, 1 / share an order at most, are sent to
every task. What isn't among them is asked for by code, again in arrays by bucket;
ln P is the sum of what its entries add, so answers are summed a row and texts stay
where they are. ``share`` decides only which way an entry takes, never a score.
Tables that are superseded are deleted, and Spark deletes the shuffle files of a
table when it is written.

Defined results: a null text is empty (one end token); without training texts N
and V are 0 and every token has probability 1. Words are told apart by
64-bit hashes. Repeated rows and null ids are scored row by row.
"""
from __future__ import annotations

import math
from dataclasses import dataclass, field, replace
from functools import reduce

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import forget, land
from .common import arrow_schema, in_chunks, rows_of

SHARE = 2e-6
LEAST = 2             # a pair that occurs once says nothing about a context
GAIN = 8.0
WEIGHT = 2.0
FLUSH = 1_500_000     # keys that a task gathers before it hands them on
BUCKET = 3_000_000    # keys of a bucket
LONGEST = 64          # bytes of a word that is hashed with others at once
AT_ONCE = 1 << 18     # bytes of texts that are hashed at once
TURNS = 2             # tokens, pairs and triples are counted by turns, by their code, so that fewer are on the disk at a time
WORD_BYTES = 4        # bytes of a token and the space behind it, at least about; only the number of buckets hangs on it
SLICES = 4            # so are the rows that are scored
TOKEN_BUCKETS = 512   # tokens are counted before their number is known
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
BLANK = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])
END = 0               # the end token; words hash to other values


def _land(df: DataFrame, label: str) -> DataFrame:
    return land(df, label, tidy=True)


class Words:
    """Hashes of the tokens of texts: a word of up to ``LONGEST`` bytes is the sum of random numbers by place and byte."""

    def __init__(self):
        from xxhash import xxh64_intdigest

        self.digest = xxh64_intdigest
        self.numbers = np.random.default_rng(7).integers(0, 2**64, LONGEST * 256, np.uint64)

    def hashes(self, data: bytes) -> tuple[np.ndarray, np.ndarray]:
        """(hash, first byte) of each word."""
        chars = np.frombuffer(data, np.uint8)
        inside = ~BLANK[chars]
        edges = np.flatnonzero(np.diff(inside, prepend=False, append=False))
        starts, sizes = edges[::2], edges[1::2] - edges[::2]
        if not len(starts):
            return np.zeros(0, np.int64), starts
        first = np.cumsum(sizes) - sizes
        place = np.arange(first[-1] + sizes[-1], dtype=np.int32) - np.repeat(first.astype(np.int32), sizes)
        if sizes.max() > LONGEST:
            place = np.minimum(place, LONGEST - 1, out=place)
        out = np.add.reduceat(self.numbers.take(place * 256 + chars[inside]), first)
        for k in np.flatnonzero(sizes > LONGEST):
            out[k] = self.digest(data[starts[k]:starts[k] + sizes[k]])
        return np.maximum(out >> np.uint64(1), np.uint64(1)).astype(np.int64), starts      # 63 bits, not END

    def all_tokens(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """The tokens of texts one after another, and how many each has."""
        parts, counts, held, size = [], [], [], 0

        def flush():
            found, starts = self.hashes(b" ".join(held))
            ends = np.searchsorted(starts, np.cumsum([len(h) + 1 for h in held]))
            parts.append(np.insert(found, ends, END))
            counts.append(np.diff(ends, prepend=0) + 1)

        for text in texts:
            data = (text or "").encode("utf-8", "surrogatepass").translate(LOWER)
            if held and size + len(data) > AT_ONCE:
                flush()
                held, size = [], 0
            held.append(data)
            size += len(data)
        if held:
            flush()
        return (np.concatenate(parts), np.concatenate(counts)) if parts else (np.zeros(0, np.int64), np.zeros(0, np.int64))

    def tokens(self, text: str | None) -> np.ndarray:
        return self.all_tokens([text])[0]


def pair(context: np.ndarray, token: np.ndarray) -> np.ndarray:
    """A 63-bit code of a context's code and a token."""
    h = context.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + token.astype(np.uint64) + np.uint64(0x632BE59BD9B4E019)
    h ^= h >> np.uint64(31)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(29)
    return (h >> np.uint64(1)).astype(np.int64)


# ------------------------------------------------------------------ counting
def _gathered(batches, columns: list[str], size: int = FLUSH):
    """Lists of rows (the last column a text) with about ``size`` tokens, and (tokens, how many each row has)."""
    words, kept, parts, counts, n = Words(), [], [], [], 0
    for part in in_chunks(rows_of(batches, columns), 256):
        tokens, many = words.all_tokens([row[-1] for row in part])
        kept += [row[:-1] for row in part]
        parts.append(tokens), counts.append(many)
        n += len(tokens)
        if n >= size:
            yield kept, np.concatenate(parts), np.concatenate(counts)
            kept, parts, counts, n = [], [], [], 0
    if parts:
        yield kept, np.concatenate(parts), np.concatenate(counts)


def _token_counts(texts: DataFrame, text_col: str) -> DataFrame:
    """(token, n); tasks sum before they hand on."""
    return _counted(texts, text_col, (0,), TOKEN_BUCKETS).select(F.col("context").alias("token"), "n")


def _runs(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order of codes, and where in it each distinct code begins. Equal codes in any order, which sorts much faster."""
    by = np.argsort(codes)
    codes = codes[by]
    return by, np.flatnonzero(np.append(True, codes[1:] != codes[:-1])) if len(codes) else by


def _summed(codes: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct codes, their summed numbers, and a place of each code."""
    by, first = _runs(codes)
    at = by[first]
    return codes[at], np.add.reduceat(n[by].astype(np.int64), first) if len(by) else n.astype(np.int64), at


def codes_of(tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Codes of each two and each three tokens in a row."""
    two = pair(tokens[:-1], tokens[1:])
    return two, pair(two[:-1], two[1:])


def _inside(tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which two and which three tokens in a row are of one text."""
    two = tokens[:-1] != END
    return two, two[:-1] & two[1:]


def _dealt(key: np.ndarray, columns: list[np.ndarray], schema, *constants: int, counts: np.ndarray | None = None):
    """Arrow record batches with a row per key: the key, the constants and the bytes of each column's part.

    ``counts``, from 1, become the last column, without the ones, which stand first (``_with_ones``)."""
    import pyarrow as pa

    if not len(key):
        return
    low = key.min()
    # numpy orders 16 bits by radix
    short = (key - low).astype(np.uint16) if key.max() - low < 1 << 16 else key
    if counts is None:
        by = np.argsort(short, kind="stable")
    else:
        by = np.concatenate([np.flatnonzero(counts == 1), np.flatnonzero(counts > 1)])
        by = by[np.argsort(short[by], kind="stable")]
    key, columns = key[by], [c[by] for c in columns]
    first = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
    ends = np.append(first[1:], len(key))
    more = np.zeros(0) if counts is None else counts[by]
    for k, at, end in zip(key[first].tolist(), first.tolist(), ends.tolist()):
        parts = [c[at:end].tobytes() for c in columns]
        if counts is not None:
            parts.append(more[at:end][more[at:end] > 1].tobytes())
        yield pa.RecordBatch.from_arrays(
            [*[pa.array([c], pa.int64()) for c in (k, *constants)], *[pa.array([c], pa.binary()) for c in parts]], schema=schema)


def _joined(table, name: str, kind) -> np.ndarray:
    """The numbers of a column of bytes."""
    return np.frombuffer(b"".join(table.column(name).to_pylist()), kind)


def _with_ones(table, name: str, size: np.ndarray) -> np.ndarray:
    """The counts of a column that ``_dealt`` wrote, ``size`` of them a row."""
    n = np.ones(size.sum(), np.uint32)
    for end, held in zip(np.cumsum(size).tolist(), table.column(name).to_pylist()):
        n[end - len(held) // 4:end] = np.frombuffer(held, np.uint32)
    return n


def _counted(texts: DataFrame, text_col: str, orders: tuple[int, ...], buckets: int, turn: int = 0, turns: int = 1) -> DataFrame:
    """(kind, context, next, n, code) by order: tokens (0; the token is the context and the code), all; pairs (1) and triples (2)
    that occur at least ``LEAST`` times. Of all of them those whose code is of the turn."""
    import pyarrow as pa

    ddl, out_ddl = "key long, context binary, next binary, n binary", "kind int, context long, next long, n long, code long"
    schema, out = arrow_schema(ddl), arrow_schema(out_ddl)

    def count(batches):
        for _, tokens, _ in _gathered(batches, [text_col]):
            codes, inside = (tokens, *codes_of(tokens)), (None, *_inside(tokens))
            for order in orders:
                code = codes[order]
                if turns > 1:
                    own = code % turns == turn
                    at = np.flatnonzero(own if order == 0 else own & inside[order])
                else:
                    at = np.arange(len(code)) if order == 0 else np.flatnonzero(inside[order])
                code = code[at]
                by, first = _runs(code)
                n, code, at = np.diff(first, append=len(at)).astype(np.uint32), code[by[first]], at[by[first]]
                last = codes[order - 1]
                columns = [last[at], last[at + 1]] if order else [code, np.zeros((len(at), 0))]
                yield from _dealt(order * buckets + code // turns % buckets, columns, schema, counts=n)

    def add(table):
        kind = table.column("key")[0].as_py() // buckets
        context = _joined(table, "context", np.int64)
        n = _with_ones(table, "n", np.array([len(c) // 8 for c in table.column("context").to_pylist()]))
        if kind == 0:
            code, n, _ = _summed(context, n)
            columns = code, np.zeros(len(code), np.int64), n, code
        else:
            after = _joined(table, "next", np.int64)
            code, n, at = _summed(pair(context, after), n)
            often = n >= LEAST
            at = at[often]
            columns = context[at], after[at], n[often], code[often]
        return pa.Table.from_arrays([pa.array(np.full(len(columns[0]), kind, np.int32)), *map(pa.array, columns)], schema=out)

    return texts.select(text_col).mapInArrow(count, ddl).groupBy("key").applyInArrow(add, out_ddl)


def _repeated(texts: DataFrame, text_col: str, order: int, buckets: int, turn: int, turns: int) -> DataFrame:
    """(context, next, n, code) of the pairs (order 1) or triples (order 2) that occur at least ``LEAST`` times."""
    return _counted(texts, text_col, (order,), buckets, turn, turns).drop("kind")


def _matched(rows: DataFrame, entries: DataFrame, key: str, hot: int, how: str = "inner") -> DataFrame:
    """Inner or left join on ``key``, unique in ``entries``; rows of keys with a total of ``hot`` (few keys) stay where they are."""
    frequent = F.broadcast(entries.filter(F.col("total") >= hot))
    rare = entries.filter(F.col("total") < hot)
    return rows.join(frequent, key).unionByName(rows.join(frequent.select(key), key, "left_anti").join(rare, key, how))


# ------------------------------------------------------------------ the tree
def _nothing(kind=np.float64):
    return field(default_factory=lambda: np.zeros(0, kind))


@dataclass
class Entries:
    """Tokens, pairs or triples by their codes."""

    codes: np.ndarray = _nothing(np.int64)
    counts: np.ndarray = _nothing()
    values: np.ndarray = _nothing()     # what an occurrence adds to ln P of its last token, besides the root's part
    shares: np.ndarray = _nothing()     # as a context: ln of the factor of tokens without a pair, NaN where it is no state

    #: Places of entries by bits of their codes, -1 where there is none; entries whose place is taken are in the next table.
    tables: list[np.ndarray] = field(default_factory=list)

    @staticmethod
    def of(codes, counts, values, shares) -> Entries:
        tables, left = [], np.arange(len(codes), dtype=np.int32)
        while len(left):
            table = np.full(1 << (4 * len(left)).bit_length(), -1, np.int32)
            at = Entries.bits(codes[left], len(tables), table)
            table[at] = left
            tables.append(table)
            left = left[table[at] != left]
        return Entries(codes, counts, values, shares, tables)

    @staticmethod
    def bits(codes: np.ndarray, level: int, table: np.ndarray) -> np.ndarray:
        return (codes >> (7 * level % 35)) & (len(table) - 1)

    def find(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which codes are entries, and the entries' places."""
        places = np.full(len(codes), -1, np.int32)
        at, sought = None, codes
        for level, table in enumerate(self.tables):
            k = table[self.bits(sought, level, table)]
            taken = np.flatnonzero(k >= 0)      # elsewhere there is no entry, in no table
            k, sought = k[taken], sought[taken]
            at = taken if at is None else at[taken]
            same = self.codes[k] == sought
            places[at[same]] = k[same]
            at, sought = at[~same], sought[~same]
        held = places >= 0
        return held, places[held]


@dataclass
class SuffixTree:
    """The entries of a trained model that are sent to every task, and the table of the others."""

    total: int = 0
    vocabulary: int = 0
    orders: list[Entries] = field(default_factory=list)        # tokens, pairs, triples
    others: DataFrame | None = None

    @property
    def states(self) -> list[np.ndarray]:
        """Contexts of one and two tokens among the entries."""
        return [e.codes[~np.isnan(e.shares)] for e in self.orders[:2]]

    def root(self, counts: np.ndarray) -> np.ndarray:
        return np.log((counts + 0.5) / (self.total + 0.5 * (self.vocabulary + 1)))

    def told(self, tokens: np.ndarray):
        """What the entries add to each token's ln P and base ln P, which tokens are entries, and by order
        (codes, which of them only the table can tell about)."""
        one, both, last = self.orders
        two, three = codes_of(tokens)
        in_two, in_three = _inside(tokens)
        held, at = one.find(tokens)
        base = np.zeros(len(tokens))
        base[held] = self.root(one.counts)[at]
        logs = base.copy()
        share = np.zeros(len(tokens))
        share[held] = one.shares[at]
        fine = ~np.isnan(share)            # also of tokens that aren't entries: it isn't known whether they are states
        logs[1:] += np.where(in_two, np.nan_to_num(share[:-1]), 0.0)
        held_two, at = both.find(two)
        logs[1:][held_two] += both.values[at]
        share = np.full(len(two), np.nan)
        share[held_two] = both.shares[at]
        logs[2:] += np.where(in_three, np.nan_to_num(share[:-1]), 0.0)
        held_three, at = last.find(three)
        logs[2:][held_three] += last.values[at]
        # a pair matters by its own probability or as a context, whose suffix is a state too
        open_two = in_two & ~held_two
        fine_two = open_two & fine[1:] | ~np.isnan(share)
        return logs, base, held, [(tokens, ~held), (two, open_two & (fine[:-1] | fine[1:])),
                                  (three, in_three & fine_two[:-1] & ~held_three)]

    def score(self, tokens: np.ndarray) -> tuple[float, float, int, np.ndarray]:
        """(ln P, base ln P, known tokens), and the tokens without an entry, whose root's part is left out."""
        logs, base, held, _ = self.told(tokens)
        return float(logs.sum()), float(base.sum()), int(held.sum()), tokens[~held]


def _states(pairs: DataFrame, totals: DataFrame, gain: float, weight: float) -> DataFrame:
    """(``totals``, share) of all contexts, the share null where one does not pass the divergence test.

    ``pairs`` has context, n and above = ln P(next | suffix of the context); ``totals`` the contexts' counts."""
    n, above, seen, total = F.col("n"), F.col("above"), F.col("seen"), F.col("total")
    sums = pairs.groupBy("context").agg(F.sum("n").alias("seen"), F.sum(n * (F.log(n) - above)).alias("gained"),
                                        F.sum(F.exp(above)).alias("expected"))
    rest = F.greatest(1 - seen / total, F.lit(0.0))
    rest_above = F.greatest(1 - F.col("expected"), F.lit(1e-12))
    divergence = (F.col("gained") - seen * F.log(total)) / total + F.when(
        rest > 0, rest * F.log(F.greatest(rest, F.lit(1e-12)) / rest_above)).otherwise(0.0)
    # what the kept pairs leave, for all other tokens in proportion to the suffix's distribution
    left = (total - seen + weight * (1 - F.col("expected"))) / (total + weight)
    share = F.log(F.greatest(left, F.lit(1e-12)) / rest_above)
    return totals.join(sums, "context", "left").select(*totals.columns, F.when(total * divergence >= gain, share).alias("share"))


def train(texts: DataFrame, text_col: str = "text", share: float = SHARE, gain: float = GAIN,
          weight: float = WEIGHT) -> tuple[SuffixTree, DataFrame]:
    """The tree, and the exact counts (token, n) of all training tokens."""
    import pyarrow.compute as pc

    def log(total):        # of a pair in a state
        return F.log(F.col("n") + weight * F.exp("above")) - F.log(total + weight)

    size = texts.agg(F.coalesce(F.sum(F.octet_length(F.col(text_col))), F.lit(0))).first()[0]
    found = [_land(_counted(texts, text_col, (0, 1, 2), _buckets(size // WORD_BYTES), turn, TURNS), "counted") for turn in range(TURNS)]
    by_order = [reduce(DataFrame.unionByName, [f.filter(F.col("kind") == k).drop("kind") for f in found]) for k in range(3)]
    counts = _land(by_order[0].select(F.col("context").alias("token"), "n"), "tokens")
    total, vocabulary = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    hot = max(LEAST, math.ceil(share * total))
    totals = counts.select(F.col("token").alias("context"), F.col("n").alias("total"))
    buckets = _buckets(total)

    root = F.log((F.col("total") + 0.5) / (total + 0.5 * (vocabulary + 1)))
    pairs = _land(_matched(by_order[1], totals.withColumnRenamed("context", "next"), "next", hot)
                 .select("context", "next", "n", "code", root.alias("above")), "pairs")
    tokens = _land(_states(pairs, totals, gain, weight), "contexts")
    in_state = F.when(F.col("share").isNotNull(), log(F.col("total")))
    rooted = pairs
    pairs = _land(_matched(rooted, tokens, "context", hot).select(
        "code", "next", F.col("n").alias("total"), (in_state - F.col("above") - F.col("share")).alias("value"),
        F.coalesce(in_state, "above").alias("above")), "pairs")
    forget(rooted)

    # A triple is the pair of its first two tokens as the context, and that of its last two.
    triples = _land(_matched(by_order[2], pairs.select(F.col("code").alias("next"), "total", "above"), "next", hot)
                   .select("context", "n", "code", "above"), "triples")
    forget(*found)
    # What a pair adds and whether it is a state: it passes the test, and its suffix is a state too.
    contexts = pairs.select(F.col("code").alias("context"), "total", F.col("next").alias("suffix"), "value")
    matters = (F.col("total") >= hot) | F.col("value").isNotNull() | F.col("share").isNotNull()
    passed = _land(_states(triples, contexts, gain, weight).filter(matters), "passed")
    forget(pairs)
    suffixes = tokens.filter("share is not null").select(F.col("context").alias("suffix"), "total")
    judged = _land(_matched(passed.filter("share is not null").withColumnRenamed("total", "n"), suffixes, "suffix", hot, "left")
                  .select("context", F.col("n").alias("total"), "value", F.when(F.col("total").isNotNull(), F.col("share")).alias("share")), "contexts")
    states = judged.filter("share is not null").select("context", "total", "share")

    none = F.lit(None).cast("double")
    columns = ["kind", "code", "total", "value", "share"]
    ones = tokens.select(F.lit(0).alias("kind"), F.col("context").alias("code"), "total", none.alias("value"), "share")
    twos = (passed.filter("share is null").select(*judged.columns).unionByName(judged.filter(matters))
            .select(F.lit(1).alias("kind"), F.col("context").alias("code"), *columns[2:]))
    threes = _matched(triples, states, "context", hot).select(
        F.lit(2).alias("kind"), "code", F.col("n").alias("total"),
        (log(F.col("total")) - F.col("above") - F.col("share")).alias("value"), none.alias("share"))
    model = _land(_packed(ones.unionByName(twos).unionByName(threes), buckets, hot), "model")
    forget(tokens, passed, judged, triples)
    sent = model.filter("key < 0").toArrow()       # 1 / share entries an order at most
    orders = []
    for k in range(3):
        own = sent.filter(pc.equal(sent.column("key"), -1 - k))
        code, n, values, shares = (_joined(own, c, t) for c, t in zip(PACKED, (np.int64, np.int64, float, float)))
        orders.append(Entries.of(code, n.astype(float), values, shares))
    others = model.filter("key >= 0").select(F.expr(f"key div {buckets}").alias("kind"), "key", *PACKED[:3])
    return SuffixTree(total, vocabulary, orders, others), counts


PACKED = ["codes", "totals", "adds", "shares"]


def _packed(entries: DataFrame, buckets: int, hot: int) -> DataFrame:
    """Entries (kind, code, total, value, share) as arrays (key, ``PACKED``): with a total of ``hot`` under -1 - kind, with
    the value and, NaN where there is none, the share; others under kind * buckets + bucket with the sum of the two, and with
    totals for tokens only."""
    ddl = f"key long, {', '.join(f'{c} binary' for c in PACKED)}"
    schema = arrow_schema(ddl)

    def dealt(parts):
        kind, code, total, value, share = (np.concatenate(c) for c in zip(*parts))
        value, often = np.nan_to_num(value), total >= hot
        yield from _dealt(-1 - kind[often], [c[often] for c in (code, total, value, share)], schema)
        value += np.nan_to_num(share)
        for own in (~often & (kind == 0), ~often & (kind > 0)):
            kinds, codes = kind[own], code[own]
            none = np.zeros((len(codes), 0))
            totals = none if kinds.any() else total[own]
            yield from _dealt(kinds * buckets + codes % buckets, [codes, totals, value[own], none], schema)

    def pack(batches):
        parts, n = [], 0
        for batch in batches:
            ints = [batch.column(k).to_numpy(zero_copy_only=False).astype(np.int64) for k in range(3)]
            parts.append([*ints, *(batch.column(k).to_numpy(zero_copy_only=False).astype(float) for k in (3, 4))])
            n += batch.num_rows
            if n >= FLUSH // 2:
                yield from dealt(parts)
                parts, n = [], 0
        if n:
            yield from dealt(parts)

    return entries.mapInArrow(pack, ddl)


def _buckets(total: int) -> int:
    return max(32, math.ceil(total / BUCKET))


def _answers(rows: DataFrame, sent, others: DataFrame) -> DataFrame:
    """Tokens, known tokens, ln P and base ln P of rows (row, text) in parts: what a task knows, and what the table adds;
    without the root's part of tokens that aren't known."""
    import pyarrow as pa

    total = sent.value.total
    buckets = _buckets(total)
    ddl, out_ddl = "key long, block long, codes binary, places binary", "row long, n_tokens long, known long, ln double, base double"
    schema, out = arrow_schema(ddl), arrow_schema(out_ddl)

    def ask(batches):
        own = sent.value
        for kept, tokens, many in _gathered(batches, ["row", "text"], FLUSH // 4):
            rows = np.array([k for k, in kept])
            logs, base, known, asked = own.told(tokens)
            # known at once: goes by the rows' block, under keys of its own
            first = np.cumsum(many) - many
            parts = np.stack([many, *[np.add.reduceat(c, first) for c in (known.astype(float), logs, base)]], axis=1)
            for block in np.unique(rows >> 16).tolist():
                at = np.flatnonzero(rows >> 16 == block)
                yield from _dealt(np.full(len(at), -1 - block), [parts[at], (rows[at] & 0xFFFF).astype(np.uint16)], schema, block)
            row = np.repeat(rows, many)
            found = [(kind, codes, np.flatnonzero(ask)) for kind, (codes, ask) in enumerate(asked)]
            keys = np.concatenate([kind * buckets + codes[at] % buckets for kind, codes, at in found])
            codes = np.concatenate([codes[at] for _, codes, at in found])
            row = np.concatenate([row[at] for _, _, at in found])
            for block in np.unique(row >> 16).tolist():
                at = np.flatnonzero(row >> 16 == block)
                yield from _dealt(keys[at], [codes[at], (row[at] & 0xFFFF).astype(np.uint16)], schema, block)

    def filled(*columns):
        return pa.Table.from_arrays([pa.array(c.astype(f.type.to_pandas_dtype())) for c, f in zip(columns, out, strict=True)], schema=out)

    def answer(asked, entries):
        if not asked.num_rows or asked.column("key")[0].as_py() >= 0 and not entries.num_rows:
            return out.empty_table()
        places = _joined(asked, "places", np.uint16)
        row = np.repeat(asked.column("block").to_numpy() << 16, [len(c) // 2 for c in asked.column("places").to_pylist()]) + places
        if asked.column("key")[0].as_py() < 0:
            return filled(row, *_joined(asked, "codes", float).reshape(-1, 4).T)
        code, n, value = (_joined(entries, c, t) for c, t in zip(PACKED, (np.int64, np.int64, float)))
        table = Entries.of(code, n, value, value)
        held, at = table.find(_joined(asked, "codes", np.int64))
        row, which = np.unique(row[held], return_inverse=True)
        ln, base, known = np.bincount(which, table.values[at], len(row)), np.zeros(len(row)), np.zeros(len(row))
        if entries.column("key")[0].as_py() < buckets:
            base, known = np.bincount(which, sent.value.root(table.counts[at]), len(row)), np.bincount(which, minlength=len(row))
        return filled(row, np.zeros(len(row)), known, ln + base, base)

    entries = others.select("key", *PACKED[:3])
    return rows.select("row", "text").mapInArrow(ask, ddl).groupBy("key").cogroup(entries.groupBy("key")).applyInArrow(answer, out_ddl)


def score_documents(docs: DataFrame, tree: SuffixTree, counts: DataFrame, keep: tuple[str, ...] = (),
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col``, ``keep``, n_tokens, n_known, train_tokens, base_score, score of every row (log10)."""
    sent = docs.sparkSession.sparkContext.broadcast(replace(tree, others=None))
    held = (id_col, *keep)
    # Own names for the columns that are carried along: theirs may be any.
    carried = [f"held{k}" for k in range(len(held))]
    columns = docs.select(*[F.col(c).alias(h) for c, h in zip(held, carried)], F.col(text_col).alias("text"))
    rows = _land(columns.withColumn("row", F.monotonically_increasing_id()), "texts")
    sums = [F.sum(c).alias(c) for c in ("n_tokens", "known", "ln", "base")]
    told = reduce(DataFrame.unionByName, [
        _land(_answers(rows.filter(F.col("row") % SLICES == turn), sent, tree.others).groupBy("row").agg(*sums), "told")
        for turn in range(SLICES)])
    unknown = (F.col("n_tokens") - F.col("known")) * float(tree.root(np.zeros(1))[0])
    scores = [((F.col(c) + unknown) / math.log(10)).alias(name) for c, name in (("base", "base_score"), ("ln", "score"))]
    return rows.drop("text").join(told, "row").select(
        *[F.col(h).alias(c) for h, c in zip(carried, held)], "n_tokens", F.col("known").alias("n_known"),
        F.lit(tree.total).cast("long").alias("train_tokens"), *scores)
