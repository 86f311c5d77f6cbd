"""Quality classifier by compression with dictionaries of good and of bad text.

Training. Labelled texts are cut into pieces of ``PIECE`` bytes. A zstandard
dictionary is built from good pieces and another one from bad pieces: of each
label the ``samples`` distinct pieces whose hashes are smallest, a bounded sample
spread over all training texts (the only bounded step; 4,000 pieces of 1 KB a
label).

Score. Each piece of a whole text is compressed with both dictionaries. The
normalised difference (bytes with the bad dictionary - bytes with the good one) /
bytes of the text says which of the two the text resembles. Pieces are compressed
one by one, so a long text is told by the dictionaries at its end as at its
start, and memory doesn't grow.

Calibration. A quarter of the training texts, told by their hash, is kept out of
the dictionaries; all of them are counted in ``BINS`` bins of the difference by
label, and an isotonic fit of the share of label 1 (pooled neighbours, each
smoothed towards the share of all) turns a difference into a share. A short text
says little: a text of n bytes counts n / (n + ``SHORT``) in the fit, and its score
is that part of the fitted share and the rest of the share of all.

Texts are read where they lie, three times: for hashes of pieces, for the pieces
chosen, and to be compressed; only hashes and differences are joined with labels.

Defined results: a null or empty text has the share of all as its score; rows whose label is null or neither 0 nor 1 teach nothing; a
text with both labels counts for both, labels without a text or an id for nothing;
repeated rows each count in the calibration, their equal pieces once in the dictionary; without training rows of both labels
every score is the share of label 1, 0.5 without any. Repeated rows and null ids
are scored row by row; other columns are ignored, whatever their names.
"""
from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, replace
from functools import cached_property

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import land
from .common import arrow_schema, as_batches, rows_of

PIECE = 1024             # bytes that are compressed at a time
SAMPLES = 4000           # pieces a dictionary is built from
DICTIONARY = 112_640     # bytes of a dictionary
LEVEL = 3
BINS = 2000              # of differences from -1 to 1
SHORT = 64               # bytes at which a text's own difference counts half
FEWEST = 16              # pieces that a dictionary can be built from; fewer are taken as they are


def pieces(text: str | None, size: int = PIECE) -> Iterable[bytes]:
    raw = (text or "").encode("utf-8", "surrogatepass")
    return (raw[at:at + size] for at in range(0, len(raw), size))


@dataclass
class Classifier:
    good: bytes
    bad: bytes
    piece: int = PIECE
    edges: np.ndarray | None = None       # differences, ascending
    shares: np.ndarray | None = None      # the fitted share of label 1 at each
    prior: float = 0.5                    # the share of label 1 among the rows it was calibrated with

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k != "compressors"}

    @cached_property
    def compressors(self):
        import zstandard

        def of(data):
            kind = zstandard.DICT_TYPE_AUTO if data[:4] == b"\x37\xa4\x30\xec" else zstandard.DICT_TYPE_RAWCONTENT
            held = zstandard.ZstdCompressionDict(data, dict_type=kind)
            held.precompute_compress(level=LEVEL)
            return zstandard.ZstdCompressor(level=LEVEL, dict_data=held, write_content_size=False, write_checksum=False, write_dict_id=False)
        return of(self.good), of(self.bad)

    def difference(self, text: str | None) -> tuple[float, float]:
        """The normalised difference, and how far it counts (0 to 1)."""
        good, bad = self.compressors
        gap = size = 0
        for part in pieces(text, self.piece):
            gap += len(bad.compress(part)) - len(good.compress(part))
            size += len(part)
        return (gap / size if size else 0.0), size / (size + SHORT)

    def score(self, text: str | None) -> float:
        return self.score_of(*self.difference(text)) if self.shares is not None else self.prior

    def score_of(self, gap: float, weight: float) -> float:
        if self.shares is None:
            return self.prior
        return weight * float(np.interp(gap, self.edges, self.shares)) + (1 - weight) * self.prior


def dictionary(parts: list[bytes], size: int = DICTIONARY) -> bytes:
    """A zstandard dictionary of the pieces; the pieces themselves where they are too few to build one."""
    import zstandard

    if len(parts) >= FEWEST:
        try:
            return zstandard.train_dictionary(size, parts).as_bytes()
        except zstandard.ZstdError:
            pass
    return b"".join(parts)[-size:]


def isotonic(good: np.ndarray, bad: np.ndarray, prior: float) -> np.ndarray:
    """Ascending shares of good in consecutive bins, neighbours that fall pooled; each pool is smoothed by ``prior``."""
    pools: list[list[float]] = []         # good, all, bins
    for g, b in zip(good.tolist(), bad.tolist(), strict=True):
        pools.append([g, g + b, 1])
        while len(pools) > 1 and pools[-2][0] * pools[-1][1] >= pools[-1][0] * pools[-2][1]:
            last = pools.pop()
            pools[-1] = [a + c for a, c in zip(pools[-1], last, strict=True)]
    shares = np.concatenate([np.full(int(n), (g + prior) / (seen + 1)) for g, seen, n in pools])
    return np.maximum.accumulate(shares)


def _apart(text_col: str):
    """Whether a text is kept out of the dictionaries, for the calibration."""
    return F.coalesce(F.pmod(F.xxhash64(text_col), F.lit(4)) == 0, F.lit(True))


def _labels(labels: DataFrame, id_col: str, label_col: str) -> DataFrame:
    return labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label")).filter("label in (0, 1)").distinct()


def sample_pieces(texts: DataFrame, wanted: DataFrame, samples: int = SAMPLES, piece: int = PIECE) -> dict[int, list[bytes]]:
    """Of each label the distinct pieces with the smallest hashes, in their order.

    ``texts`` has id and text, ``wanted`` id and label. Only hashes meet the labels: those under a limit, which is raised
    until each label has its ``samples`` or all pieces are under it. The texts themselves are never shuffled."""
    top = 2 ** 63
    n_bytes, n_texts = texts.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)), F.count(F.lit(1))).first()
    part = min(1.0, 64 * samples / max(1, n_bytes // piece + n_texts))
    schema = arrow_schema("id binary, hash long")

    def under(limit):
        def hashes(batches):
            from xxhash import xxh64_intdigest

            def found():
                for i, text in rows_of(batches, ["id", "text"]):
                    for h in {xxh64_intdigest(p) >> 1 for p in pieces(text, piece)}:
                        if h < limit:
                            yield i, h
            yield from as_batches(found(), schema, 20_000)
        return hashes

    keyed = texts.select(F.col("id").cast("string").cast("binary").alias("id"), "text")
    asked = wanted.select(F.col("id").cast("string").cast("binary").alias("id"), "label")
    while True:
        near = keyed.mapInArrow(under(int(part * top)), "id binary, hash long").distinct()
        hashes = land(near.join(asked, "id").select("label", "hash").distinct(), "hashes")
        counts = dict(map(tuple, hashes.groupBy("label").count().collect()))
        if part == 1.0 or min(counts.get(0, 0), counts.get(1, 0)) >= samples:
            break
        part = min(1.0, 8 * part)
    chosen = {label: [r.hash for r in hashes.filter(F.col("label") == label).orderBy("hash").limit(samples).collect()] for label in (0, 1)}
    known = set(chosen[0]) | set(chosen[1])
    schema_of_pieces = arrow_schema("hash long, piece binary")

    def taken(batches):
        from xxhash import xxh64_intdigest

        held: dict[int, bytes] = {}
        for (text,) in rows_of(batches, ["text"]):
            for p in pieces(text, piece):
                h = xxh64_intdigest(p) >> 1
                if h in known:
                    held[h] = p
        yield from as_batches(held.items(), schema_of_pieces, 500)

    fetched = texts.select("text").mapInArrow(taken, "hash long, piece binary").groupBy("hash").agg(F.first("piece").alias("piece"))
    by_hash = {r.hash: bytes(r.piece) for r in fetched.collect()} if known else {}
    return {label: [by_hash[h] for h in hashes] for label, hashes in chosen.items()}


def learn(docs: DataFrame, labels: DataFrame, label_col: str = "quality", id_col: str = "doc_id", text_col: str = "text",
          samples: int = SAMPLES, piece: int = PIECE) -> Classifier:
    """The dictionaries, from the texts of ``docs`` whose id has a label 0 or 1 in ``labels``; not yet calibrated."""
    texts = docs.filter(~_apart(text_col)).select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).filter("id is not null")
    parts = sample_pieces(texts, _labels(labels, id_col, label_col), samples, piece)
    return Classifier(dictionary(parts[1]), dictionary(parts[0]), piece)


def differences(docs: DataFrame, model: Classifier, keep: tuple[str, ...] = (), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col``, ``keep``, gap, weight and apart (whether the calibration may use it) of every row."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    held = StructType([docs.schema[c] for c in (id_col, *keep)])
    carried = [f"held{k}" for k in range(len(held))]       # own names: theirs may be any
    rows = docs.select(*[F.col(c).alias(h) for c, h in zip((id_col, *keep), carried)], F.col(text_col).alias("text"), _apart(text_col).alias("apart"))
    out = StructType(held.fields + StructType.fromDDL("gap double, weight double, apart boolean").fields)
    schema = to_arrow_schema(out)

    def measure(batches):
        def results():
            for *held_, text, apart in rows_of(batches, [*carried, "text", "apart"]):
                yield (*held_, *(model.difference(text) if model.good and model.bad else (0.0, 0.0)), apart)
        yield from as_batches(results(), schema)

    return rows.mapInArrow(measure, out)


def calibrated(model: Classifier, gaps: DataFrame, labels: DataFrame, label_col: str = "quality", id_col: str = "doc_id") -> Classifier:
    """The classifier, calibrated by ``differences`` of training rows."""
    mine = gaps.select(F.col(id_col).alias("id"), "gap", "weight", "apart").join(_labels(labels, id_col, label_col), "id")
    place = F.floor((F.least(F.greatest("gap", F.lit(-1.0)), F.lit(1.0)) + 1) / 2 * (BINS - 1) + 0.5).cast("int")
    counts = mine.groupBy("label", place.alias("place")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.when(F.col("apart"), F.round(F.col("weight") * 1000)).otherwise(0).cast("long")).alias("weight"))
    total, seen = np.zeros((2, BINS)), [0, 0]
    for label, at, n, weight in counts.collect():      # at most two rows a bin
        total[label, at] = weight / 1000
        seen[label] += n
    prior = seen[1] / sum(seen) if any(seen) else 0.5
    used = np.flatnonzero(total.sum(0))
    if not (model.good and model.bad and len(used)):
        return replace(model, prior=prior, shares=None)
    # between bins that hold texts, shares are interpolated
    return replace(model, prior=prior, edges=np.linspace(-1, 1, BINS)[used], shares=isotonic(total[1, used], total[0, used], prior))


def train(docs: DataFrame, labels: DataFrame, label_col: str = "quality", id_col: str = "doc_id", text_col: str = "text",
          samples: int = SAMPLES, piece: int = PIECE) -> Classifier:
    """The calibrated classifier of the labelled rows of ``docs``."""
    model = learn(docs, labels, label_col, id_col, text_col, samples, piece)
    return calibrated(model, differences(docs.filter(_apart(text_col)), model, (), id_col, text_col), labels, label_col, id_col)


def scored(gaps: DataFrame, model: Classifier, threshold: float = 0.3) -> DataFrame:
    """Rows of ``differences`` with score and predicted (1 if the score is at least ``threshold``) in place of gap, weight and apart."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    held = gaps.columns[:-3]
    carried = [f"held{k}" for k in range(len(held))]
    out = StructType(gaps.schema.fields[:-3] + StructType.fromDDL("score double, predicted int").fields)
    schema = to_arrow_schema(out)

    def score(batches):
        def results():
            for *held_, gap, weight in rows_of(batches, [*carried, "gap", "weight"]):
                value = model.score_of(gap, weight)
                yield (*held_, value, int(value >= threshold))
        yield from as_batches(results(), schema)

    return gaps.toDF(*carried, "gap", "weight", "apart").mapInArrow(score, out)


def score_documents(docs: DataFrame, model: Classifier, threshold: float = 0.3, keep: tuple[str, ...] = (), id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """``id_col``, ``keep``, score and predicted of every row."""
    return scored(differences(docs, model, keep, id_col, text_col), model, threshold)
