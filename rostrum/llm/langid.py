"""Language identification by nearest centroids.

A text is lower-cased, everything but letters becomes one space, and its byte
bigrams and trigrams are hashed into ``DIMS`` features: (1 + ln count) * idf,
normalised to length 1. Document frequencies come from every training row. On
a sample of at most about ``sample`` training rows a language (by hash of the
id, the only bounded step) spherical k-means gives ``clusters`` centroids a
language. The centroid with the largest cosine names the language.

Rejection is by distance: short texts lie further from any centroid, so the
cosine is divided by the square root of the number of features; a text is
``rejected`` below ``slack`` times the smallest such ratio in the samples.

Defined results: a null text or one without a letter is ``und`` with score 0
and rejected; without any training row every text is; a text whose features
are all unknown gets the most frequent language with score 0 and is rejected.
Ties go to the more frequent language. Repeated rows are predicted alike.
"""
from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_schema, as_batches, rows_of

DIMS = 1 << 14
SAMPLE = 1000
CLUSTERS = 4
ROUNDS = 12
SLACK = 0.5
UNKNOWN = "und"
LETTER = re.compile(r"[^\W\d_]")
#: Lower-case ASCII letters and all bytes of other characters stay, the rest becomes a space.
KEEP = bytes(b if b >= 128 or 97 <= b <= 122 else 32 for b in range(256))


def features(text: str) -> tuple[np.ndarray, np.ndarray]:
    """(distinct features in order, their counts) of a whole text."""
    words = text.lower().encode("utf-8", "replace").translate(KEEP).split()
    if not words:
        return np.zeros(0, np.int64), np.zeros(0)
    b = np.frombuffer(b" " + b" ".join(words) + b" ", np.uint8).astype(np.uint32)
    two = (b[:-1] << 8 | b[1:]) * np.uint32(2654435761)
    three = (b[:-2] << 16 | b[1:-1] << 8 | b[2:]) * np.uint32(2246822519)
    hashed = np.concatenate([two, three]) >> np.uint32(18)
    if len(hashed) < 4000:
        return np.unique(hashed, return_counts=True)
    counts = np.bincount(hashed, minlength=DIMS)
    found = np.flatnonzero(counts)
    return found, counts[found]


def vector(text: str, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(features, weights): the normalised TF-IDF vector."""
    found, counts = features(text)
    weights = (1 + np.log(counts)) * idf[found]
    norm = np.sqrt((weights * weights).sum())
    return (found, weights / norm) if norm else (found[:0], weights[:0])


@dataclass
class Centroids:
    """A trained classifier; its size is set by DIMS, languages and clusters."""

    languages: list[str]         # the most frequent first
    owner: np.ndarray            # language of each centroid
    matrix: np.ndarray           # DIMS x centroids, columns of length 1
    idf: np.ndarray
    floor: float                 # reject below

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        if not text or not self.languages or not LETTER.search(text):
            return UNKNOWN, 0.0, True
        found, weights = vector(text, self.idf)
        if not len(found):
            return self.languages[0], 0.0, True
        cosines = weights @ self.matrix[found]
        best = np.full(len(self.languages), -1.0)
        np.maximum.at(best, self.owner, cosines)
        k = int(best.argmax())
        cosine = float(min(1.0, max(0.0, best[k])))
        return self.languages[k], cosine, cosine < self.floor * len(found) ** 0.5


def document_frequencies(texts: DataFrame, text_col: str) -> tuple[np.ndarray, int]:
    """(documents that hold each feature, documents) over all rows; DIMS rows reach the driver."""
    def count(batches):
        df, n = np.zeros(DIMS + 1, np.int64), 0
        for (text,) in rows_of(batches, [text_col]):
            df[features(text)[0]] += 1
            n += 1
        df[DIMS] = n
        held = np.flatnonzero(df)
        yield from as_batches(zip(held.tolist(), df[held].tolist(), strict=True), schema, DIMS + 1)

    schema = arrow_schema("feature int, n long")
    sums = texts.select(text_col).mapInArrow(count, "feature int, n long").groupBy("feature").agg(F.sum("n").alias("n"))
    df = np.zeros(DIMS + 1, np.int64)
    for feature, n in sums.collect():
        df[feature] = n
    return df[:DIMS], int(df[DIMS])


def cluster(rows: np.ndarray, clusters: int, rounds: int) -> np.ndarray:
    """Spherical k-means with a farthest-first start; fewer clusters if some stay empty."""
    unit = lambda m: m / np.maximum(np.sqrt((m * m).sum(1, keepdims=True)), 1e-12)
    centers = unit(rows.mean(0, keepdims=True))
    while len(centers) < min(clusters, len(rows)):
        centers = np.vstack([centers, rows[(rows @ centers.T).max(1).argmin()][None]])
    for _ in range(rounds):
        owner = (rows @ centers.T).argmax(1)
        centers = unit(np.vstack([rows[owner == k].mean(0, keepdims=True) for k in range(len(centers)) if (owner == k).any()]))
    return centers


def train(labelled: DataFrame, text_col: str = "text", lang_col: str = "lang", id_col: str = "doc_id",
          sample: int = SAMPLE, clusters: int = CLUSTERS, rounds: int = ROUNDS, slack: float = SLACK) -> Centroids:
    """Learn from the rows of ``labelled`` whose text and language aren't null."""
    rows = labelled.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"),
                           F.col(lang_col).cast("string").alias("lang")).filter("text is not null and lang is not null")
    df, n = document_frequencies(rows, "text")
    idf = np.log((1 + n) / (1 + df)) + 1
    sizes = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}      # a row a language
    languages = sorted(sizes, key=lambda k: (-sizes[k], k))
    if not languages:
        return Centroids([], np.zeros(0, int), np.zeros((DIMS, 0)), idf, 0.0)
    share = F.create_map(*[F.lit(x) for k in languages for x in (k, min(1.0, sample / sizes[k]))])
    draw = F.pmod(F.xxhash64("id", "text"), F.lit(1 << 30)) / float(1 << 30)
    chosen = rows.filter(draw < F.element_at(share, F.col("lang"))).select("lang", "text")

    def vectors(batches):
        def results():
            for lang, text in rows_of(batches, ["lang", "text"]):
                found, weights = vector(text, idf)
                if len(found):
                    yield lang, found.astype("<i4").tobytes(), weights.astype("<f4").tobytes()
        yield from as_batches(results(), sparse, 500)

    def learn(key, frame):
        import pandas as pd

        held = [(np.frombuffer(a, "<i4"), np.frombuffer(b, "<f4")) for a, b in zip(frame.found, frame.weights, strict=True)]
        dense = np.zeros((len(held), DIMS), np.float32)
        for row, (a, b) in zip(dense, held, strict=True):
            row[a] = b
        centers = cluster(dense, clusters, rounds)
        near = (dense @ centers.T).max(1)
        ratio = min(float(c) / len(a) ** 0.5 for c, (a, _) in zip(near, held, strict=True))
        return pd.DataFrame({"lang": key[0], "center": [c.astype("<f4").tobytes() for c in centers], "ratio": ratio})

    sparse = arrow_schema("lang string, found binary, weights binary")
    learned = (chosen.mapInArrow(vectors, "lang string, found binary, weights binary").groupBy("lang")
               .applyInPandas(learn, "lang string, center binary, ratio double").collect())
    learned.sort(key=lambda r: (languages.index(r["lang"]), r["center"]))
    kept = [k for k in languages if any(r["lang"] == k for r in learned)]
    matrix = np.stack([np.frombuffer(r["center"], "<f4") for r in learned], 1) if learned else np.zeros((DIMS, 0))
    return Centroids(kept, np.array([kept.index(r["lang"]) for r in learned], int), matrix.astype(np.float64), idf,
                     slack * min((r["ratio"] for r in learned), default=0.0))


def predict_documents(docs: DataFrame, model: Centroids, id_col: str = "doc_id", text_col: str = "text",
                      keep: tuple[str, ...] = ()) -> DataFrame:
    """``id_col``, ``keep``, lang_pred, score, rejected for every row: a map, no shuffle."""
    from pyspark.sql.types import StructType

    held = StructType([docs.schema[c] for c in (id_col, *keep)])
    out = StructType.fromDDL("lang_pred string, score double, rejected boolean")
    from pyspark.sql.pandas.types import to_arrow_schema

    schema = to_arrow_schema(StructType(held.fields + out.fields))
    names = [id_col, *keep]
    sent = docs.sparkSession.sparkContext.broadcast(model)      # DIMS x centroids, whatever the input

    def predict(batches):
        own = sent.value

        def results():
            for *held_, text in rows_of(batches, [*names, text_col]):
                yield (*held_, *own.predict(text))
        yield from as_batches(results(), schema, 500)

    columns = list(dict.fromkeys([*names, text_col]))
    return docs.select(*columns).mapInArrow(predict, StructType(held.fields + out.fields))


def keep_identified(docs: DataFrame, model: Centroids, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose language isn't rejected; all columns as they are."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def keep(batches):
        import pyarrow as pa

        for batch in batches:
            texts = batch.column(batch.schema.get_field_index(text_col)).to_pylist()
            yield batch.filter(pa.array([not sent.value.predict(t)[2] for t in texts], pa.bool_()))

    return docs.mapInArrow(keep, docs.schema)
