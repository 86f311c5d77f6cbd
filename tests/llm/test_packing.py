"""Packing: ids of the tokenizers library, gapless pieces, histogram met."""
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from rostrum.llm.byte_bpe import load_tokenizer
from rostrum.llm.packing import Plan, combinations, pack_documents, solve_counts
from rostrum.llm.queries import BYTE_TOKENIZER, QUERIES
from tokenizers import Tokenizer


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(BYTE_TOKENIZER)


def test_ids_over_all_characters(library):
    own = load_tokenizer(BYTE_TOKENIZER)
    for first in range(0, 0x30000, 64):
        chars = [chr(c) for c in range(first, first + 64) if not 0xD800 <= c < 0xE000]
        text = "".join(f"a{c}b {c}{c} 1{c}2 .{c}! \n{c} x" for c in chars)
        assert np.frombuffer(own.encode(text), "<u4").tolist() == library.encode(text, add_special_tokens=False).ids


def test_ids_of_random_and_long_texts(library):
    own, draw = load_tokenizer(BYTE_TOKENIZER), random.Random(3)
    parts = [" ", "  ", "\n", "\n\n", "\t", "the", "'s", "'", "é", "1", "...", "<|endoftext|>", "\x00", "\x85", "½", "😀", "x" * 70]
    texts = ["".join(draw.choice(parts) for _ in range(draw.randint(0, 20))) for _ in range(2000)]
    for text in [*texts, "x" * 50_000, " " * 50_000]:
        assert np.frombuffer(own.encode(text), "<u4").tolist() == library.encode(text, add_special_tokens=False).ids


def test_combinations_fill_the_window():
    found = {tuple(sorted(int(v) for v in row if v)) for row in combinations(24, 3)}
    want = {tuple(sorted(c)) for c in [(a, 24 - a) for a in range(1, 24)] + [
        (a, b, 24 - a - b) for a in range(1, 24) for b in range(1, 24 - a)]}
    assert found == want


def test_least_squares_meets_a_histogram():
    combos = combinations(16, 3)
    histogram = np.zeros(16)
    for row, count in zip(combos[::3], range(5, 100)):
        for v in row[row > 0]:
            histogram[v] += count
    x = solve_counts(histogram, combos, 3000)
    used = np.zeros(16)
    for row, k in zip(combos, x):
        for v in row[row > 0]:
            used[v] += k
    assert (x >= 0).all() and np.abs(used - histogram).max() < 0.05 * histogram.max()


@pytest.mark.parametrize("counts", [{}, {1500: 7}, {1: 3}, {2047: 1, 1: 1}, {700: 90, 648: 40, 300: 25, 5: 11}])
def test_plan_places_every_remainder_once(counts):
    histogram = np.zeros(2048, np.int64)
    for length, n in counts.items():
        histogram[length] = n
    plan, at = Plan(histogram, 2048), defaultdict(list)
    for length, n in counts.items():
        for rank in range(n):
            places = plan.places(length, rank)
            assert sum(p[1] for p in places) == length and [p[0] for p in places] == [sum(q[1] for q in places[:i]) for i in range(len(places))]
            for _, size, sequence, offset in places:
                at[sequence].append((offset, size))
    for pieces in at.values():
        end = 0
        for offset, size in sorted(pieces):
            assert offset == end
            end += size
        assert end <= 2048 and (end == 2048 or end & (end - 1) == 0)
    assert sorted(at) == list(range(plan.first_full))


def check(rows, texts, library):
    """Pieces by (id, text) rows against the definition; returns the sequences' lengths."""
    want = Counter()
    by_id = defaultdict(list)
    for key, text in texts:
        ids = np.array([*library.encode(text or "", add_special_tokens=False).ids, 1], "<u4")
        by_id[key].append(ids)
        want[key] += len(ids)
    got, at = Counter(), defaultdict(list)
    for r in rows:
        got[r.doc_id] += r.length
        assert any(len(ids) == r.doc_tokens and zlib.crc32(ids[r.start:r.start + r.length].tobytes()) == r.ids_crc32
                   for ids in by_id[r.doc_id])
        at[r.sequence_id].append((r.offset, r.length))
    assert got == want
    for pieces in at.values():
        end = 0
        for offset, size in sorted(pieces):
            assert offset == end
            end += size
        assert end <= 2048
    return [sum(size for _, size in p) for p in at.values()]


def test_awkward_rows(spark, docs, awkward, library):
    rows = pack_documents(docs(awkward).withColumnRenamed("source", "block"), BYTE_TOKENIZER).collect()
    lengths = check(rows, awkward, library)
    assert sum(2048 - n for n in lengths if n & (n - 1)) == 0
    assert pack_documents(docs([]), BYTE_TOKENIZER).count() == 0


def test_registered_query(spark, library):
    sf = "/root/testdata/sf0.001"
    texts = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    rows = QUERIES["op6_nnls_packing"](spark, sf).collect()
    lengths = check(rows, texts, library)
    assert sum(2048 - n for n in lengths if n & (n - 1)) == 0
    starts = defaultdict(list)
    for r in rows:
        starts[r.doc_id].append((r.start, r.length))
    for pieces in starts.values():
        assert all(a + n == b for (a, n), (b, _) in zip(sorted(pieces), sorted(pieces)[1:]))
