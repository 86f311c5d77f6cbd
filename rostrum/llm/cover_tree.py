"""Exact top-k search by inner product with dual cover trees.

Vectors are turned into integers. All rows are dealt into blocks of bounded
size; so are the queries. Every pair of a query block and a data block is
searched by two cover trees; the k best of all blocks are a query's result.

Cover tree: a node has a center that is one of its points and a covering
radius; its children cover its points with at most ``SHRINK`` of that radius, the
first child keeps the center. Where most points would stand alone at that radius
(vectors in many dimensions lie about equally far apart) they are halved by
nearness to two distant points instead.

Dual search: a pair of nodes can't hold an inner product above
<q, x> + |q| rx + |x| rq + rq rx, with centers q, x and radii rq, rx. It is
pruned when that is below the worst k-th score of the queries in the query
node. Best pairs first; leaves are multiplied as matrices.

Scores are whole numbers below 2^53, which float64 holds exactly; vectors with
larger ones are searched with Python's integers instead, by the same trees'
order but without pruning, and scores beyond 64 bits are limited to them.

Defined results: vectors that are null, or hold a null or a non-finite
component, take no part; shorter vectors are filled with zeros; an empty vector
is all zeros; queries with fewer candidates get all; ties go to the smaller id,
rows with a null id take no part. A query's own row, found by its id, is no
candidate for it (with repeated ids, none of them is). Equal query rows are
asked once; query rows with one id and other vectors each get their k best.
"""
from __future__ import annotations

import heapq
import math

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import land
from .common import arrow_schema, as_batches, rows_of

K = 10
DATA_BLOCK = 8192
QUERY_BLOCK = 512
WAVE = 16              # query blocks that a task searches with one data tree
SHRINK = 0.6
LEAF = 64
EXACT = 2 ** 53


class Node:
    __slots__ = ("center", "radius", "children", "points", "norm")

    def __init__(self, center: int, radius: float, points: np.ndarray, norm: float):
        self.center, self.radius, self.points, self.norm = center, radius, points, norm
        self.children: list[Node] = []


def build(vectors: np.ndarray, leaf: int = LEAF, shrink: float = SHRINK) -> Node | None:
    """The root of a cover tree over the rows of ``vectors`` (float64); nodes hold row numbers."""
    if not len(vectors):
        return None
    norms = np.sqrt((vectors * vectors).sum(1))

    def distances(center, points):
        gap = vectors[points] - vectors[center]
        return np.sqrt((gap * gap).sum(1))

    everything = np.arange(len(vectors))
    first = int(norms.argmax())
    away = distances(first, everything)
    root = Node(first, float(away.max()), everything, float(norms[first]))
    open_ = [(root, away)]
    while open_:
        node, away = open_.pop()
        if len(node.points) <= leaf or node.radius == 0:
            continue
        reach = node.radius * shrink
        points, center, single = node.points, node.center, []
        while len(points):
            near = away <= reach
            mine, rest = points[near], points[~near]
            if len(mine) == 1 and center != node.center:
                single.append(center)
            else:
                child = Node(center, float(away[near].max()), mine, float(norms[center]))
                node.children.append(child)
                open_.append((child, away[near]))
            points = rest
            if len(points):
                if len(single) >= leaf and 2 * len(single) > len(node.points) - len(points):
                    # most points stand alone at this radius: they and the rest are halved by nearness instead
                    apart = np.concatenate([np.array(single), points])
                    node.children += _spread(apart, norms, distances, open_)
                    single = []
                    break
                center = int(points[0])
                away = distances(center, points)
        for k in range(0, len(single), leaf):
            part = np.array(single[k:k + leaf])
            away = distances(int(part[0]), part)
            node.children.append(Node(int(part[0]), float(away.max()), part, float(norms[part[0]])))
    return root


def _spread(points, norms, distances, open_) -> list[Node]:
    """Two nodes around two points far apart."""
    a = int(points[distances(int(points[0]), points).argmax()])
    to_a = distances(a, points)
    b = int(points[to_a.argmax()])
    to_b = distances(b, points)
    left = to_a <= to_b
    out = []
    for center, away, mine in ((a, to_a, left), (b, to_b, ~left)):
        if mine.any():
            node = Node(center, float(away[mine].max()), points[mine], float(norms[center]))
            out.append(node)
            open_.append((node, away[mine]))
    return out


def search(queries: np.ndarray, query_ids: np.ndarray, data: np.ndarray, ids: np.ndarray, k: int,
           query_tree: Node | None = None, data_tree: Node | None = None):
    """Per query (scores, ids), the k best of ``data`` without the query's own id; unused places have score -inf."""
    m = len(queries)
    scores = np.full((m, k), -np.inf)
    found = np.full((m, k), np.iinfo(np.int64).max)
    if not m or not len(data):
        return scores, found
    query_tree, data_tree = query_tree or build(queries), data_tree or build(data)

    def worst(node: Node) -> float:
        return float(scores[node.points, -1].min())

    def bound(q: Node, x: Node) -> float:
        exact = float(queries[q.center] @ data[x.center])
        return exact + q.norm * x.radius + x.norm * q.radius + q.radius * x.radius

    count = 0
    heap = [(-bound(query_tree, data_tree), count, query_tree, data_tree)]
    while heap:
        high, _, q, x = heapq.heappop(heap)
        if -high * (1 + 1e-9) + 1e-6 < worst(q):
            continue
        if not q.children and not x.children:
            block = queries[q.points] @ data[x.points].T
            block[query_ids[q.points][:, None] == ids[x.points][None]] = -np.inf
            need = scores[q.points, -1]
            for i in np.flatnonzero((block >= need[:, None]).any(1)):
                row = q.points[i]
                both = np.concatenate([scores[row], block[i]])
                both_ids = np.concatenate([found[row], ids[x.points]])
                best = np.lexsort((both_ids, -both))[:k]
                scores[row], found[row] = both[best], both_ids[best]
            continue
        # open the larger of the two
        if x.children and (not q.children or x.radius >= q.radius):
            pairs = [(q, c) for c in x.children]
        else:
            pairs = [(c, x) for c in q.children]
        for a, b in pairs:
            value = bound(a, b)
            if value * (1 + 1e-9 * (value > 0)) + 1e-6 >= worst(a):
                count += 1
                heapq.heappush(heap, (-value, count, a, b))
    return scores, found


def search_wide(queries: list, query_ids, data: list, ids, k: int):
    """The same with whole numbers of any size."""
    top, low = 2 ** 63 - 1, -2 ** 63
    out = []
    for qid, q in zip(query_ids, queries, strict=True):
        rows = [(min(top, max(low, sum(int(a) * int(b) for a, b in zip(q, x)))), int(i)) for x, i in zip(data, ids, strict=True) if i != qid]
        out.append(sorted(rows, key=lambda r: (-r[0], r[1]))[:k])
    return out


def whole(vector: Column, scale: float) -> Column:
    """floor(scale * x) of each component as double; null where the vector takes no part."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")))
    return F.when(vector.isNotNull() & fine, F.transform(vector, lambda x: _floor(x.cast("double") * F.lit(scale))))


def _floor(x: Column) -> Column:
    """Floor as double, also of numbers beyond 64 bits (which are whole already)."""
    return F.when(F.abs(x) < 2.0 ** 53, F.floor(F.when(F.abs(x) < 2.0 ** 53, x).otherwise(0.0)).cast("double")).otherwise(x)


def top_k(rows: DataFrame, queries: DataFrame, k: int = K, scale: float = 1024.0, id_col: str = "vec_id",
          vector_col: str = "embedding", data_block: int = DATA_BLOCK, query_block: int = QUERY_BLOCK) -> DataFrame:
    """query_id, rank, vec_id, score: the k highest integer inner products of each query among ``rows``."""
    def ready(frame):
        out = frame.select(F.col(id_col).cast("long").alias("id"), whole(F.col(vector_col), scale).alias("v"))
        return out.filter("id is not null and v is not null")

    data, asked = ready(rows), ready(queries).distinct().withColumn("ask", F.xxhash64("v"))
    n_data, n_asked = data.count(), asked.count()
    data_blocks, query_blocks = max(1, math.ceil(n_data / data_block)), max(1, math.ceil(n_asked / query_block))
    # Repeated rows would meet in one block of a hash of the id and vector; data rows are dealt by a row number.
    data = data.withColumn("ask", F.monotonically_increasing_id())
    deal = lambda n: F.pmod(F.xxhash64("id", "ask"), F.lit(n)).cast("int")
    # A task searches one data block for the queries of one wave, so neither side of it grows with the tables.
    waves = math.ceil(query_blocks / WAVE)
    upto = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    blocks = (_packed(asked.withColumn("block", deal(query_blocks))).withColumn("wave", F.floor(F.col("block") / WAVE).cast("int"))
              .withColumn("block", upto(data_blocks)))
    tables = _packed(data.withColumn("block", deal(data_blocks))).withColumn("wave", upto(waves))
    ddl = "query_id long, ask long, vec_id long, score long"
    schema = arrow_schema(ddl)

    def join(key, left, right):
        import pandas as pd

        results = []
        if len(left) and len(right):
            parts = [_unpack(i, v, d) for i, v, d in zip(left["ids"], left["vectors"], left["dims"], strict=True)]
            ids, vectors = np.concatenate([p[0] for p in parts]), _stack([p[1] for p in parts])
            trees: dict[int, Node] = {}
            for qi, qa, qv, qd in zip(right["ids"], right["asks"], right["vectors"], right["dims"], strict=True):
                query_ids, asked_ = _unpack(qi, qv, qd)
                results += _pairs(query_ids, np.frombuffer(qa, "<i8"), asked_, ids, vectors, k, trees)
        return pd.DataFrame(results, columns=schema.names).astype("int64")

    found = (tables.groupBy("block", "wave").cogroup(blocks.groupBy("block", "wave"))
             .applyInPandas(join, ddl))
    rank = F.row_number().over(Window.partitionBy("query_id", "ask").orderBy(F.col("score").desc(), "vec_id"))
    # Repeated data rows are candidates of their own.
    return (land(found, "found").withColumn("rank", rank).filter(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def _packed(frame: DataFrame) -> DataFrame:
    """Rows of a block packed by the task that read them: (block, ids, asks, vectors, dims)."""
    ddl = "block int, ids binary, asks binary, vectors binary, dims binary"
    schema = arrow_schema(ddl)

    def pack(batches):
        held: dict[int, list] = {}
        for i, ask, v, block in rows_of(batches, ["id", "ask", "v", "block"]):
            held.setdefault(block, []).append((i, ask, v))

        def results():
            for block, part in held.items():
                flat = [c for _, _, v in part for c in v]
                yield (block, np.array([i for i, _, _ in part], "<i8").tobytes(), np.array([a for _, a, _ in part], "<i8").tobytes(),
                       np.array(flat, "<f8").tobytes(), np.array([len(v) for _, _, v in part], "<i4").tobytes())
        yield from as_batches(results(), schema, 4)

    return frame.mapInArrow(pack, ddl)


def _unpack(ids: bytes, vectors: bytes, dims: bytes):
    sizes = np.frombuffer(dims, "<i4")
    flat = np.frombuffer(vectors, "<f8")
    out = np.zeros((len(sizes), int(sizes.max(initial=0))))
    at = 0
    if len(set(sizes.tolist())) == 1:
        out[:] = flat.reshape(len(sizes), -1)
    else:
        for row, n in zip(out, sizes.tolist(), strict=True):
            row[:n] = flat[at:at + n]
            at += n
    return np.frombuffer(ids, "<i8"), out


def _stack(parts: list[np.ndarray]) -> np.ndarray:
    width = max(p.shape[1] for p in parts)
    return np.concatenate([_widened(p, width) for p in parts])


def _widened(rows: np.ndarray, width: int) -> np.ndarray:
    return rows if rows.shape[1] == width else np.pad(rows, ((0, 0), (0, width - rows.shape[1])))


def _pairs(query_ids, asks, queries, ids, data, k, trees):
    width = max(queries.shape[1], data.shape[1])
    queries, data = _widened(queries, width), _widened(data, width)
    if queries.size and data.size and np.abs(queries).max() * np.abs(data).max() * width >= EXACT:
        best = search_wide(queries.tolist(), query_ids, data.tolist(), ids, k)
        return [(int(q), int(a), i, s) for q, a, rows in zip(query_ids, asks, best, strict=True) for s, i in rows]
    if width not in trees:
        trees[width] = build(data)
    scores, found = search(queries, query_ids, data, ids, k, data_tree=trees[width])
    return [(int(q), int(a), int(i), int(s)) for q, a, row, row_ids in zip(query_ids, asks, scores, found, strict=True)
            for s, i in zip(row, row_ids, strict=True) if s > -np.inf]
