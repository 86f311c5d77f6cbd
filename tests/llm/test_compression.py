"""Held-out accuracy, the score against a plain computation, and awkward input."""
import random
import zlib

import numpy as np
import pytest
import zstandard
from pyspark.sql import functions as F

from rostrum.llm import compression as C
from rostrum.llm.common import in_bucket
from rostrum.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


def texts(n, seed=0):
    """Plain sentences and shouted lists, by turns."""
    rnd = random.Random(seed)
    words = ["".join(rnd.choice("aeioust nrl".replace(" ", "")) for _ in range(rnd.randint(2, 9))) for _ in range(400)]
    out = []
    for k in range(n):
        some = [rnd.choice(words) for _ in range(rnd.randint(30, 200))]
        out.append((" ".join(some).capitalize() + ".", 1) if k % 2 else ("!! ".join(w.upper() for w in some), 0))
    return out


def trained(spark, rows, **options):
    """A classifier of (text, quality) rows."""
    numbered = [(k, *row) for k, row in enumerate(rows)]
    docs = spark.createDataFrame([r[:2] for r in numbered], "doc_id long, text string").repartition(3)
    return C.train(docs, spark.createDataFrame([(r[0], r[2]) for r in numbered], "doc_id long, quality int"), **options)


@pytest.fixture(scope="module")
def model(spark):
    return trained(spark, texts(400))


def test_tells_unseen_texts_apart(model):
    right = [(model.score(text) >= 0.5) == bool(label) for text, label in texts(200, 1)]
    assert np.mean(right) > 0.97


def test_score_is_that_of_plain_compression(model):
    for text, _ in texts(6, 2) + [("short", 1), ("x" * 5000, 0)]:
        raw = text.encode()
        sizes = []
        for data in (model.bad, model.good):
            held = zstandard.ZstdCompressionDict(data)
            one = zstandard.ZstdCompressor(level=C.LEVEL, dict_data=held, write_content_size=False, write_checksum=False, write_dict_id=False)
            sizes.append(sum(len(one.compress(raw[at:at + C.PIECE])) for at in range(0, len(raw), C.PIECE)))
        gap, weight = model.difference(text)
        assert gap == (sizes[0] - sizes[1]) / len(raw) and weight == len(raw) / (len(raw) + C.SHORT)
        assert model.score(text) == pytest.approx(weight * np.interp(gap, model.edges, model.shares) + (1 - weight) * model.prior)


def test_isotonic_is_ascending_and_pools():
    got = C.isotonic(np.array([0.0, 5, 1, 9]), np.array([9.0, 1, 5, 0]), 0.5)
    assert list(got) == sorted(got) and got[1] == got[2] == (6 + 0.5) / 13


def test_awkward_rows(spark, docs, awkward, model):
    got = C.score_documents(docs(awkward), model).collect()
    assert len(got) == len(awkward) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got)
    scores = {r.doc_id: r.score for r in got}
    assert scores[1] == scores[2] == model.prior
    extra = docs(awkward).selectExpr("*", "1 as score", "2 as predicted", "3 as held0", "4 as label")
    assert sorted(C.score_documents(extra, model).collect(), key=str) == sorted(got, key=str)
    assert C.score_documents(docs([]), model).count() == 0


def test_training_with_little(spark):
    assert trained(spark, []).score("any text") == 0.5
    assert trained(spark, [("only good", 1), ("and more", 1)]).score("any text") == 1.0
    assert trained(spark, [(None, 1), ("", 0), ("x", None), ("y", 7)]).score("any text") in (0.0, 0.5, 1.0)
    few = trained(spark, [("good words here", 1), ("BAD!! WORDS!!", 0)] * 3)
    assert 0 <= few.score("good words here") <= 1


def test_sample_is_the_smallest_hashes_whatever_the_first_limit(spark):
    from xxhash import xxh64_intdigest

    rows = [("the same copy of a text", 1)] * 500 + texts(300)
    docs = spark.createDataFrame([(k, text) for k, (text, _) in enumerate(rows)], "id long, text string").repartition(4)
    wanted = spark.createDataFrame([(k, label) for k, (_, label) in enumerate(rows)], "id long, label int")
    got = C.sample_pieces(docs, wanted, 3, 64)
    for label in (0, 1):
        every = {p for text, mine in rows if mine == label for p in C.pieces(text, 64)}
        assert got[label] == sorted(every, key=lambda p: xxh64_intdigest(p) >> 1)[:3]


def test_labels_of_repeated_and_null_ids(spark):
    docs = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (None, "d")], "id long, text string")
    labels = spark.createDataFrame([(1, 1), (1, 1), (2, 0), (2, None), (None, 1), (3, 1)], "doc_id long, quality int")
    got = C.sample_pieces(docs.filter("id is not null"), C._labels(labels, "doc_id", "quality"))
    assert sorted(got[1]) == [b"a", b"b"] and got[0] == [b"c"]


def test_registered_query(spark):
    got = QUERIES["op12_compression_quality"](spark, SF)
    assert got.dtypes[:4] == [("doc_id", "bigint"), ("held_out", "boolean"), ("score", "double"), ("predicted", "int")]
    rows = got.collect()
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert len(rows) == docs.count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    held = {r.doc_id: r.predicted for r in rows if r.held_out}
    truth = spark.read.parquet(f"{SF}/labels.parquet").filter("quality is not null").collect()
    right = [held[r.doc_id] == r.quality for r in truth if r.doc_id in held]
    assert np.mean(right) >= 0.95
    # labels of held-out rows don't matter
    training = docs.filter(~in_bucket("doc_id", 5, 0))
    model = C.train(training, spark.read.parquet(f"{SF}/labels.parquet"))
    flipped = spark.read.parquet(f"{SF}/labels.parquet").withColumn("quality", F.when(in_bucket("doc_id", 5, 0), 1 - F.col("quality")).otherwise(F.col("quality")))
    again = C.train(training, flipped)
    assert model.good == again.good and model.bad == again.bad and np.array_equal(model.shares, again.shares)
