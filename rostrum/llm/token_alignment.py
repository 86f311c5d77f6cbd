"""Alignment of the tokens of two tokenizers over the same texts.

Both tokenizers cut the bytes of a text, a space before it, into tokens. The
cumulative ends of each side go into a table from end to index (an array with a
place for every byte); the places that both tables hold, in order, are those
where tokens of both sides end. Those places slice both id lists into groups, the smallest stretches
that both sides cut alike, and every token of a group's one side is linked with
every token of its other side.

A pair of ids is counted by the documents that hold it linked. Tasks count the
distinct pairs of their documents before they hand on anything, so a frequent pair
is a few rows. Documents keep their distinct pairs with the number of occurrences;
a group of n and m tokens has at most n * m links, but only the pairs of its
distinct ids are expanded. Counts come back to the documents in two ways with the
same result: pairs that make up at least ``share`` of all (1 / share at most) are
sent to every task, the others are joined on the pair, where none is hot.

Side A is byte-level BPE, side B SentencePiece; both as the libraries do without
special tokens, whose strings are plain text. Where the files allow it tiktoken makes the
same ids for both (``PieceRanks``; tests compare them); other files, and on side B texts with
two spaces in a row, go to the libraries themselves.

Defined results: texts that are null or empty, or whose joined token bytes on a side
differ from a space and the text (the normaliser of a side changed them), have no
tokens: numbers are zero and the digest is empty. Repeated rows are documents of their
own. Long texts are aligned whole; a document with a longer list of distinct pairs than
``PART`` is kept in several rows meanwhile. Other columns are ignored, whatever their
names.
"""
from __future__ import annotations

import hashlib
import math
import struct
from collections import Counter
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import land
from .byte_bpe import byte_characters, load_tokenizer
from .common import array_batches, arrow_schema, as_batches, rows_of
from .sentencepiece_bpe import BYTE, MARK, NORMAL, UNUSED, USER, _fields

SHARE = 2e-6
FLUSH = 1_500_000       # pairs that a task gathers before it hands on their counts
KNOWN = 300_000         # groups that a task remembers before it starts anew
PART = 50_000           # distinct pairs of a document in one row
HALF = 32               # bits of an id in a pair


class PieceRanks:
    """Ids of a merge-type SentencePiece model by tiktoken, whose rule is the same: the best-scored neighbours merge first, from
    the left, if their text is a piece.

    It begins with bytes, the model with characters, so the bytes of each known character merge before all else; bytes
    that stay alone are byte pieces. Words that are pieces are taken whole, so pieces that the model itself cuts are left out.
    Equal scores are only allowed in runs of spaces, which aren't for this encoder."""

    def __init__(self, ranks: dict[bytes, int], ids: list[tuple[int, ...]]):
        import tiktoken

        self.fast = tiktoken.Encoding("pieces", pat_str=" +[^ ]*|[^ ]+", mergeable_ranks=ranks, special_tokens={})
        self.many = ids
        self.single = np.array([i[0] if len(i) == 1 else -1 for i in ids], np.int64)

    @staticmethod
    def of(path: str, model) -> PieceRanks | None:
        """None for a model with other rules."""
        with open(path, "rb") as file:
            fields = list(_fields(file.read()))
        trainer, normalizer = (dict(_fields(next((v for k, v in fields if k == number), b""))) for number in (2, 3))
        if trainer.get(3) != 2 or normalizer.get(2) or normalizer.get(4, 1) or not normalizer.get(3, 1) or not normalizer.get(5, 1):
            return None
        pieces = [dict(_fields(v)) for k, v in fields if k == 1]
        kinds = [p.get(3, NORMAL) for p in pieces]
        normal = {p[1].decode(): i for i, (p, kind) in enumerate(zip(pieces, kinds)) if kind == NORMAL}
        by_byte = {int(p[1][1:-1], 16): i for i, (p, kind) in enumerate(zip(pieces, kinds)) if kind == BYTE}
        scores = {text: struct.unpack("<f", pieces[i].get(2, bytes(4)))[0] for text, i in normal.items() if len(text) > 1 and MARK * 2 not in text}
        if (USER in kinds or UNUSED in kinds or len(by_byte) != 256 or len(set(scores.values())) < len(scores) or " " in normal
                or MARK not in normal or any(MARK in text.lstrip(MARK) or " " in text or not normal.keys() >= set(text) for text in normal)):
            return None
        spaced = {(" " if text == MARK else text).encode(): i for text, i in normal.items() if len(text) == 1}
        ranks = {bytes([b]): b for b in range(256)}
        ids = [(spaced.get(bytes([b]), by_byte[b]),) for b in range(256)]
        for char in spaced:
            for n in range(2, len(char)):
                if ranks.setdefault(char[:n], len(ids)) == len(ids):
                    ids.append(tuple(by_byte[b] for b in char[:n]))
        for char, i in spaced.items():
            if len(char) > 1:
                ranks[char] = len(ids)
                ids.append((i,))
        for text in sorted(scores, key=scores.get, reverse=True):
            spaces = text.replace(MARK, " ")
            if spaces[0] != " " or model.encode(spaces[1:]) == [normal[text]]:
                ranks[spaces.encode()] = len(ids)
                ids.append((normal[text],))
        return PieceRanks(ranks, ids)

    def ids(self, spaced: str) -> np.ndarray:
        """Ids of a text that begins with a space, without a space mark and without two spaces in a row."""
        ranks = self.fast.encode_to_numpy(spaced, disallowed_special=())
        ids = self.single[ranks]
        if len(ids) and ids.min() < 0:       # a few bytes of an unknown character
            ids = np.array([i for rank in ranks.tolist() for i in self.many[rank]], np.int64)
        return ids


class Sides:
    """The two tokenizers, and the bytes of their tokens."""

    def __init__(self, a_path: str, b_path: str):
        import sentencepiece

        self.a = load_tokenizer(a_path)
        to_byte = byte_characters()
        vocabulary = self.a.tokenizer.get_vocab()
        self.a_bytes = [b""] * (max(vocabulary.values(), default=-1) + 1)
        for entry, i in vocabulary.items():
            self.a_bytes[i] = bytes(map(to_byte.__getitem__, entry)) if all(c in to_byte for c in entry) else entry.encode()
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        self.b_bytes = [bytes([int(self.b.id_to_piece(i)[3:5], 16)]) if self.b.is_byte(i)
                        else self.b.id_to_piece(i).replace("▁", " ").encode() for i in range(self.b.get_piece_size())]
        self.b_fast = PieceRanks.of(b_path, self.b)
        self.a_sizes, self.b_sizes = (np.array([len(x) for x in entries], np.int64) for entries in (self.a_bytes, self.b_bytes))

    def a_ids(self, text: str) -> np.ndarray:
        if self.a.fast is not None:
            return self.a.fast.encode_to_numpy(text, disallowed_special=()).astype(np.int64)
        self.a.tokenizer.encode_special_tokens = True
        ids = self.a.tokenizer.encode(text, add_special_tokens=False).ids
        self.a.tokenizer.encode_special_tokens = False
        return np.array(ids, np.int64)

    def b_ids(self, text: str, raw: bytes) -> list[int]:
        """Ids of side B, none where they don't join to ``raw``, the bytes of a space and the text."""
        spaced = " " + text
        if self.b_fast is not None and MARK not in text and "  " not in spaced:
            return self.b_fast.ids(spaced).tolist()         # they join to the text's bytes
        ids = self.b.encode(text)
        return ids if b"".join(map(self.b_bytes.__getitem__, ids)) == raw else []

    def cuts(self, text: str | None):
        """Ids of both sides, and how many of each side lie before the end of each group; None where the text has no tokens by definition."""
        if not text:
            return None
        spaced = " " + text
        raw = spaced.encode("utf-8", "surrogatepass")
        a_ids, b = self.a_ids(spaced), self.b_ids(text, raw)
        if not len(a_ids) or not b:
            return None
        a, b_ids = a_ids.tolist(), np.array(b, np.int64)
        a_ends, b_ends = np.cumsum(self.a_sizes[a_ids]), np.cumsum(self.b_sizes[b_ids])
        if not a_ends[-1] == b_ends[-1] == len(raw):
            return None
        # byte-level ids of the fast way join to the text where they are as long
        if self.a.fast is None and b"".join(map(self.a_bytes.__getitem__, a)) != raw:
            return None
        # end of each token -> number of tokens up to it; of tokens without bytes the last one counts
        a_at, b_at = np.zeros(len(raw) + 1, np.int64), np.zeros(len(raw) + 1, np.int64)
        a_at[a_ends], b_at[b_ends] = np.arange(1, len(a) + 1), np.arange(1, len(b) + 1)
        both = np.flatnonzero((a_at > 0) & (b_at > 0))
        a_cuts, b_cuts = a_at[both], b_at[both]
        return a, b, a_ids, b_ids, a_cuts, b_cuts

    def groups(self, text: str | None) -> list[tuple[tuple[int, ...], tuple[int, ...]]]:
        """Ids of both sides in each group."""
        cut = self.cuts(text)
        if cut is None:
            return []
        a, b, _, _, a_cuts, b_cuts = cut
        a_cuts, b_cuts = a_cuts.tolist(), b_cuts.tolist()
        return [(tuple(a[i:j]), tuple(b[k:m])) for i, j, k, m in zip([0, *a_cuts], a_cuts, [0, *b_cuts], b_cuts)]


@lru_cache(maxsize=1)
def load_sides(a_path: str, b_path: str) -> Sides:
    return Sides(a_path, b_path)


def pairs_of(group) -> tuple[list[int], list[int], int]:
    """Distinct pairs of a group, the occurrences of each, and the number of links."""
    a, b = group
    left, right = Counter(a), Counter(b)
    pairs = [x << HALF | y for x in left for y in right]
    return pairs, [n * m for n in left.values() for m in right.values()], len(a) * len(b)


class Links:
    """The distinct linked pairs of texts; remembers a bounded number of groups.

    A group of one token a side goes by its pair, every other one by a negative number of its own."""

    def __init__(self, sides: Sides):
        self.sides = sides
        self.forget()

    def forget(self):
        self.texts: dict[int, str] = {}          # of every known group, by its number
        self.numbers: dict[tuple, int] = {}      # of groups with more tokens
        self.pairs: dict[int, tuple] = {}        # of the same

    def of(self, text: str | None):
        """(n_a, n_b, n_groups, n_links, digest, pairs, times): sorted distinct pairs and how often each is linked."""
        cut = self.sides.cuts(text)
        if cut is None:
            return 0, 0, 0, 0, "", np.zeros(0, np.int64), np.zeros(0, np.int64)
        if len(self.texts) > KNOWN:
            self.forget()
        a, b, a_ids, b_ids, a_cuts, b_cuts = cut
        a_from, b_from = np.append(0, a_cuts[:-1]), np.append(0, b_cuts[:-1])
        numbers = a_ids[a_from] << HALF | b_ids[b_from]
        wide = np.flatnonzero((a_cuts - a_from > 1) | (b_cuts - b_from > 1))
        a_all, b_all = tuple(a), tuple(b)
        numbers[wide] = [self.number((a_all[i:j], b_all[k:m])) for i, j, k, m in
                         zip(*(x[wide].tolist() for x in (a_from, a_cuts, b_from, b_cuts)))]
        distinct, often = np.unique(numbers, return_counts=True)
        known = self.texts
        for number in distinct.tolist():
            if number not in known:
                known[number] = f"{number >> HALF}|{number & (2 ** HALF - 1)}"
        digest = hashlib.sha256(";".join(map(known.__getitem__, numbers.tolist())).encode()).hexdigest()
        more = int(np.searchsorted(distinct, 0))         # groups with more tokens come first
        links = int(often[more:].sum())
        pairs, times = [], []
        for number, n in zip(distinct[:more].tolist(), often[:more].tolist()):
            own, each, size = self.pairs[number]
            pairs += own
            times += each if n == 1 else [n * m for m in each]
            links += n * size
        codes = np.concatenate([distinct[more:], np.array(pairs, np.int64)])
        order = np.argsort(codes, kind="stable")
        codes, summed = codes[order], np.concatenate([often[more:], np.array(times, np.int64)])[order]
        first = np.flatnonzero(np.append(True, codes[1:] != codes[:-1]))
        codes, summed = codes[first], np.add.reduceat(summed, first)     # whole numbers: doubles would round
        return len(a), len(b), len(numbers), links, digest, codes, summed

    def number(self, group: tuple) -> int:
        found = self.numbers.get(group)
        if found is None:
            found = self.numbers[group] = -1 - len(self.numbers)
            self.texts[found] = "|".join(",".join(map(str, side)) for side in group)
            self.pairs[found] = pairs_of(group)
        return found


def alignments(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col`` and groups: an array of (a, b), the ids of both sides in each group, in the order of the text."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    out = StructType([docs.schema[id_col], *StructType.fromDDL("groups array<struct<a: array<int>, b: array<int>>>").fields])
    schema = to_arrow_schema(out)

    def align(batches):
        sides = load_sides(a_path, b_path)
        yield from as_batches(((i, [{"a": list(a), "b": list(b)} for a, b in sides.groups(text)])
                               for i, text in rows_of(batches, ["id", "text"])), schema, 200)

    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(align, out)


NUMBERS = ["n_a", "n_b", "n_groups", "n_links"]


def linked(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc (a number of its own for each row of ``docs``), id, the numbers and digest of every document, and its distinct pairs.

    A document with more than ``PART`` distinct pairs has further rows, with zeros for the numbers. Land it before use: doc
    depends on the partitions."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import LongType, StructField, StructType

    out = StructType([StructField("doc", LongType()), StructField("id", docs.schema[id_col].dataType), *StructType.fromDDL(
        "n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, a array<int>, b array<int>, times array<long>").fields])
    schema = to_arrow_schema(out)

    def link(batches):
        links = Links(load_sides(a_path, b_path))

        def results():
            for doc, i, text in rows_of(batches, ["doc", "id", "text"]):
                *numbers, codes, times = links.of(text)
                for at in range(0, max(1, len(codes)), PART):
                    some = codes[at:at + PART]
                    yield (doc, i, *numbers, (some >> HALF).astype(np.int32), (some & (2 ** HALF - 1)).astype(np.int32), times[at:at + PART])
                    numbers = [0, 0, 0, 0, ""]
        yield from as_batches(results(), schema, 500)

    rows = docs.select(F.monotonically_increasing_id().alias("doc"), F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(link, out)


def _slices(batches, size: int = 1000):
    for batch in batches:
        for at in range(0, batch.num_rows, size):
            yield batch.slice(at, size)


def _flat(batch, name: str) -> np.ndarray:
    return batch.column(batch.schema.get_field_index(name)).flatten().to_numpy(zero_copy_only=False)


def _codes(batch) -> np.ndarray:
    return _flat(batch, "a").astype(np.int64) << HALF | _flat(batch, "b").astype(np.int64)


def pair_counts(rows: DataFrame) -> DataFrame:
    """(pair, n, best) of ``linked`` rows: how many documents hold the pair, and 1 if that is the highest of its A id, else 0."""
    ddl = "pair long, n long"
    schema = arrow_schema(ddl)

    def count(batches):
        def flush(parts):
            codes, n = np.unique(np.concatenate(parts), return_counts=True)
            yield from array_batches([codes, n], schema)

        parts, size = [], 0
        for batch in _slices(batches):
            parts.append(_codes(batch))
            size += len(parts[-1])
            if size >= FLUSH:
                yield from flush(parts)
                parts, size = [], 0
        if size:
            yield from flush(parts)

    counts = land(rows.select("a", "b").mapInArrow(count, ddl).groupBy("pair").agg(F.sum("n").alias("n")), "counts")
    counts = counts.withColumn("a", F.shiftright("pair", HALF))
    highest = counts.groupBy("a").agg(F.max("n").alias("most"))       # a row an id of A
    return counts.join(highest, "a").select("pair", "n", (F.col("n") == F.col("most")).cast("long").alias("best"))


def counted(rows: DataFrame, counts: DataFrame, share: float = SHARE) -> DataFrame:
    """id, the numbers and digest of ``linked`` rows (landed), with n_best and count_sum: the links whose count is the highest of
    their A id, and the sum of the counts of all links."""
    import pyarrow as pa
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    hot = max(1, math.ceil(share * total))
    sent = counts.filter(F.col("n") >= hot).orderBy("pair").toArrow()          # 1 / share rows at most
    table = rows.sparkSession.sparkContext.broadcast(tuple(sent.column(c).to_numpy() for c in ("pair", "n", "best")))
    passed = ["doc", "id", *NUMBERS, "groups_sha256"]
    out = StructType([*rows.select(*passed).schema.fields, *StructType.fromDDL("n_best long, count_sum long, pair long, times long").fields])
    schema = to_arrow_schema(out)

    def look(batches):
        """Each row with the sums over the pairs among those sent, and a row (doc, pair, times) for each other pair."""
        pair, n, best = table.value
        for batch in _slices(batches):
            codes, times, size = _codes(batch), _flat(batch, "times"), batch.num_rows
            at = np.repeat(np.arange(size), np.diff(batch.column(batch.schema.get_field_index("a")).offsets.to_numpy()))
            place = np.minimum(np.searchsorted(pair, codes), max(0, len(pair) - 1))
            there = pair[place] == codes if len(pair) else np.zeros(len(codes), bool)
            sums = np.zeros((2, size), np.int64)
            np.add.at(sums[0], at[there], times[there] * best[place[there]])
            np.add.at(sums[1], at[there], times[there] * n[place[there]])
            held = [batch.column(batch.schema.get_field_index(c)) for c in passed]
            none = pa.nulls(size, pa.int64())
            yield pa.RecordBatch.from_arrays([*held, pa.array(sums[0]), pa.array(sums[1]), none, none], schema=schema)
            rest = np.flatnonzero(~there)
            for k in range(0, len(rest), 50_000):
                part = rest[k:k + 50_000]
                empty = [pa.nulls(len(part), f.type) for f in list(schema)[1:-2]]
                docs = pa.array(held[0].to_numpy()[at[part]])
                yield pa.RecordBatch.from_arrays([docs, *empty, pa.array(codes[part]), pa.array(times[part])], schema=schema)

    told = land(rows.mapInArrow(look, out), "told")
    asked = told.filter("pair is not null").select("doc", "pair", "times").join(counts.filter(F.col("n") < hot), "pair")
    asked = asked.groupBy("doc").agg(F.sum(F.col("times") * F.col("best")).alias("n_best"), F.sum(F.col("times") * F.col("n")).alias("count_sum"))
    sums = told.filter("pair is null").drop("pair", "times").unionByName(asked, allowMissingColumns=True)
    return (sums.groupBy("doc").agg(F.max("id").alias("id"), *[F.sum(c).alias(c) for c in (*NUMBERS, "n_best", "count_sum")],
                                    F.max("groups_sha256").alias("groups_sha256")).drop("doc"))


def align_documents(docs: DataFrame, a_path: str, b_path: str, share: float = SHARE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col``, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 of every document."""
    rows = land(linked(docs, a_path, b_path, id_col, text_col), "linked")
    return counted(rows, pair_counts(rows), share).withColumnRenamed("id", id_col)
