"""Exact search against all inner products."""
import math
import random

import numpy as np
from pyspark.sql import types as T
from rostrum.llm.cover_tree import build, search, top_k
from rostrum.llm.queries import QUERIES

SCHEMA = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.DoubleType())),
                       T.StructField("score", T.IntegerType())])


def plain(rows, queries, k=10, scale=1024):
    def ready(rs):
        return [(i, [math.floor(scale * x) for x in v]) for i, v in rs
                if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    data, out = ready(rows), set()
    for i, q in ready(queries):
        scores = [(max(-2 ** 63, min(2 ** 63 - 1, sum(a * b for a, b in zip(q, x)))), j) for j, x in data if j != i]
        for rank, (s, j) in enumerate(sorted(scores, key=lambda t: (-t[0], t[1]))[:k], 1):
            out.add((i, rank, j, s))
    return out


def test_tree_covers_its_points():
    rng = np.random.default_rng(1)
    vectors = np.concatenate([rng.normal(size=(300, 6)), np.repeat(rng.normal(size=(1, 6)), 200, 0), rng.normal(size=(100, 6)) * 0.01])
    root, seen = build(vectors, leaf=8), []

    def walk(node):
        assert node.center in node.points
        gap = vectors[node.points] - vectors[node.center]
        assert np.sqrt((gap ** 2).sum(1)).max() <= node.radius + 1e-9
        if node.children:
            assert sorted(np.concatenate([c.points for c in node.children])) == sorted(node.points)
        else:
            seen.extend(node.points)
        for c in node.children:
            walk(c)
    walk(root)
    assert sorted(seen) == list(range(600))


def test_search_equals_all_pairs():
    rng = np.random.default_rng(2)
    for spread in (0.05, 1.0):
        centers = rng.normal(size=(10, 8))
        data = np.floor(100 * (centers[rng.integers(10, size=900)] + spread * rng.normal(size=(900, 8))))
        ids = rng.permutation(900).astype(np.int64)
        queries, query_ids = data[::9], ids[::9]
        scores, found = search(queries, query_ids, data, ids, 10)
        full = queries @ data.T
        full[query_ids[:, None] == ids[None]] = -np.inf
        for row, s, f in zip(full, scores, found):
            best = np.lexsort((ids, -row))[:10]
            assert (ids[best] == f).all() and (row[best] == s).all()


def test_awkward_rows(spark):
    draw = random.Random(4)
    rows = [(i, [draw.uniform(-1, 1) for _ in range(4)]) for i in range(60)]
    rows += [(60, None), (61, [1.0, None]), (62, [float("nan"), 1.0]), (63, [float("inf")]), (64, []), (65, [0.5]), (None, [1.0] * 4),
             (66, rows[0][1]), (67, rows[0][1]), (68, [0.5, 0.5, 0.5, 0.5, 0.5, 2.0])]
    frame = spark.createDataFrame([(*r, 1) for r in rows], SCHEMA)
    asked = [r for r in rows if r[0] is not None and (r[0] % 4 == 0 or r[0] > 59)]
    queries = frame.filter("vec_id % 4 = 0 or vec_id > 59")
    for blocks in ((8192, 512), (7, 3)):
        got = {(r.query_id, r["rank"], r.vec_id, r.score) for r in top_k(frame, queries, data_block=blocks[0], query_block=blocks[1]).collect()}
        assert got == plain(rows, asked)
    few = frame.filter("vec_id < 4")
    assert {(r.query_id, r["rank"], r.vec_id, r.score) for r in top_k(few, few).collect()} == plain(rows[:4], rows[:4])
    assert top_k(frame.filter("vec_id < 0"), queries).count() == 0 and top_k(frame, frame.filter("vec_id < 0")).count() == 0


def test_repeated_query_rows(spark):
    draw = random.Random(5)
    rows = [(i, [draw.uniform(-1, 1) for _ in range(4)]) for i in range(40)]
    asked = [*rows[:3], *[rows[0]] * 30, (1, rows[7][1])]
    frame, queries = (spark.createDataFrame([(*r, 1) for r in rs], SCHEMA) for rs in (rows, asked))
    for blocks in ((8192, 512), (7, 3)):
        got = [(r.query_id, r["rank"], r.vec_id, r.score) for r in top_k(frame, queries, data_block=blocks[0], query_block=blocks[1]).collect()]
        assert len(got) == 40 and set(got) == plain(rows, asked)


def test_numbers_beyond_float(spark):
    rows = [(0, [1e30, 3.0]), (1, [1e30, 1.0]), (2, [-1e30, 2.0]), (3, [2.0 ** 25, 1.0]), (4, [1.0, 2.0 ** 25])]
    frame = spark.createDataFrame([(*r, 1) for r in rows], SCHEMA)
    got = {(r.query_id, r["rank"], r.vec_id, r.score) for r in top_k(frame, frame).collect()}
    assert got == plain(rows, rows)


def test_registered_query(spark):
    sf = "/root/testdata/sf0.01"
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    got = {(r.query_id, r["rank"], r.vec_id, r.score) for r in QUERIES["op3_cover_tree"](spark, sf).collect()}
    assert got == plain(rows, [r for r in rows if r[0] % 100 == 0])
