"""The trie against a plain one, at several block sizes, and the SQL of the query."""
import hashlib
import zlib
from collections import defaultdict

import duckdb
import pytest
from pyspark.sql import types as T

from rostrum.llm.oracle import OP13_SQL
from rostrum.llm.prefix_trie import last_turns, trie_of_conversations
from rostrum.llm.queries import QUERIES

TURNS = T.StructType([T.StructField("conv_id", T.LongType()), T.StructField("turn", T.LongType()),
                      T.StructField("role", T.StringType()), T.StructField("text", T.StringType())])


def plain(rows, heads):
    said = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            said[c].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [x[2:] for x in sorted(v)] for c, v in said.items()}
    built = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6 if heads else 0
        built[c] = own.get(c - c % 100, [])[:h] + turns[h:]
    members, children = defaultdict(list), defaultdict(list)
    for c, turns in built.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    for p in members:
        if p:
            children[p[:-1]].append(p)
    leaves, saved, out = {}, {}, []
    for p in sorted(members, key=len, reverse=True):
        leaves[p] = sum(leaves[k] for k in children[p]) or 1
        saved[p] = sum(saved[k] for k in children[p]) + ((len(members[p]) - 1) * len(p[-1][1]) if p else 0)
        ends = ",".join(str(c) for c in sorted(members[p]) if len(built[c]) == len(p))
        out.append((min(members[p]), len(p), min(members[p[:-1]]) if p else None, len(members[p]), len(children[p]), leaves[p], saved[p],
                    hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def found(nodes):
    return sorted((tuple(r) for r in nodes.drop("path").collect()), key=str)


AWKWARD = ([(1, None, None, None), (1, 0, "user", "é😀"), (1, 0, "user", "é😀"), (2, 0, "", ""), (3, 0, None, None), (None, 0, "user", "x"),
            (100, 0, "user", "a"), (100, 1, "assistant", "b"), (101, 5, "user", "c"), (-7, 0, "user", "a"), (4, 0, "1:", "x"), (5, 0, "1", ":x"),
            (205, 0, "user", "x" * 100_000)]
           + [(c, t, "user", f"t{t}") for c in range(300, 340) for t in range(c % 4)]
           + [(1000 + c, t, "user", "same") for c in range(60) for t in range(3)]
           + [(2000, t, "user", f"deep {t % 7}") for t in range(200)] + [(2001, t, "user", f"deep {t % 7}") for t in range(190)])


@pytest.mark.parametrize("heads", [False, True])
@pytest.mark.parametrize("block", [1, 17, 20_000])
def test_same_as_plain(spark, heads, block):
    turns = spark.createDataFrame(AWKWARD, TURNS).repartition(5)
    assert found(trie_of_conversations(turns, heads, block)) == plain(AWKWARD, heads)


def test_empty_and_extra_columns(spark):
    empty = spark.createDataFrame([], TURNS)
    assert found(trie_of_conversations(empty, True)) == []
    only_null = spark.createDataFrame([(None, 1, "user", "x")], TURNS)
    assert found(trie_of_conversations(only_null, True)) == []
    extra = spark.createDataFrame(AWKWARD[:12], TURNS).selectExpr("*", "1 as steps", "2 as path", "3 as base", "4 as h", "5 as key", "6 as lengths")
    assert found(trie_of_conversations(extra, True)) == plain(AWKWARD[:12], True)


def test_many_blocks_share_one_conversation(spark):
    rows = [(c, t, "user", "the same") for c in range(700) for t in range(2)]
    turns = spark.createDataFrame(rows, TURNS)
    assert found(trie_of_conversations(turns, False, 40)) == plain(rows, False)


def test_last_turns(spark):
    rows = [(1, 0, "user", "a"), (1, 1, "assistant", "b"), (2, 0, "user", "a")]
    turns = spark.createDataFrame(rows, TURNS)
    got = last_turns(trie_of_conversations(turns), turns).select("depth", "role", "text").orderBy("depth").collect()
    assert [tuple(r) for r in got] == [(0, None, None), (1, "user", "a"), (2, "assistant", "b")]


def test_registered_query_and_sql(spark):
    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").collect()]
    got = found(QUERIES["op13_prefix_trie"](spark, sf))
    assert got == plain(rows, True)
    con = duckdb.connect()
    con.execute(f"create view conversations as select * from '{sf}/conversations.parquet'")
    assert sorted(con.execute(OP13_SQL).fetchall(), key=str) == got
