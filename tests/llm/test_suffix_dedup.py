"""Repeated strings against all windows of a small corpus."""
import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from rostrum.llm.queries import QUERIES
from rostrum.llm.suffix_dedup import anchors, anchors_of, dedup_documents, sort_extents, suffix_ranks, without_repeats


def plain(texts, length=200):
    data = [(t or "").encode() for t in texts]
    seen = Counter(d[i:i + length] for d in data for i in range(len(d) - length + 1))
    out = []
    for d in data:
        gone = np.zeros(len(d), bool)
        for i in range(len(d) - length + 1):
            if seen[d[i:i + length]] > 1:
                gone[i:i + length] = True
        runs = int((np.diff(gone.astype(int), prepend=0) == 1).sum())
        out.append((len(d), int(gone.sum()), runs, hashlib.sha256(np.frombuffer(d, np.uint8)[~gone].tobytes()).hexdigest()))
    return out


def corpus(seed, n=40):
    draw = random.Random(seed)
    words = ["".join(draw.choice("abcdeéß") for _ in range(draw.randint(1, 9))) for _ in range(300)]
    passage = [" ".join(draw.choice(words) for _ in range(60)) for _ in range(3)]
    texts = []
    for _ in range(n):
        text = " ".join(draw.choice(words) for _ in range(draw.randint(0, 90)))
        for _ in range(draw.randint(0, 2)):
            at = draw.randint(0, len(text))
            text = text[:at] + draw.choice(passage) + text[at:]
        texts.append(text)
    texts += [texts[0], texts[1], "z" * 700, "ab" * 300, None, "", passage[0] * 3]
    return texts


def test_suffix_ranks():
    draw = random.Random(0)
    for _ in range(100):
        s = np.array([draw.randint(1, 3) for _ in range(draw.randint(1, 50))], np.int64)
        suffixes = [tuple(s[i:].tolist()) for i in range(len(s))]
        for reach in (1, 4, 10, 100):
            ranks = suffix_ranks(s, reach)
            for i in range(len(s)):
                for j in range(len(s)):
                    if suffixes[i][:reach] < suffixes[j][:reach]:
                        assert ranks[i] < ranks[j]


def test_equal_windows_have_equal_anchors():
    draw = random.Random(3)
    shared = bytes(draw.choice(b"abcd ") for _ in range(500))
    texts = [bytes(draw.choice(b"abcd ") for _ in range(k)) + shared + b"x" * 30 for k in (0, 77, 300)]
    seen = []
    for text, skip in zip(texts, (0, 77, 300)):
        of = {}
        for gram, at, first, last in anchors(text, 200):
            of.update({w: (gram, at - w) for w in range(first, last + 1)})
        assert sorted(of) == list(range(len(text) - 199))
        seen.append([of[skip + w] for w in range(301)])
    assert seen[0] == seen[1] == seen[2]


@pytest.mark.parametrize("block", [4096, 2])
def test_equals_all_windows(spark, docs, block):
    texts = corpus(1)
    rows = sorted(dedup_documents(docs(list(enumerate(texts))), block=block).collect(), key=lambda r: r.doc_id)
    assert [(r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in rows] == plain(texts)


def test_awkward_rows(spark, docs, awkward):
    out = dedup_documents(docs(awkward).withColumnRenamed("source", "kept")).collect()
    assert len(out) == len(awkward)
    assert sorted((r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in out) == sorted(plain([t for _, t in awkward]))
    assert dedup_documents(docs([])).count() == 0


def test_texts_without_repeats(spark, docs):
    texts = corpus(2)
    out = {r.doc_id: r for r in without_repeats(docs(list(enumerate(texts)))).collect()}
    for i, (want, text) in enumerate(zip(plain(texts), texts)):
        if text is not None and want[1] == 0:
            assert out[i].text == text
        if want[1] == want[0] and want[0]:
            assert out[i].text == ""
        assert out[i].n_chars == len(out[i].text or "")


def test_registered_query(spark):
    sf = "/root/testdata/sf0.001"
    texts = dict(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect())
    rows = sorted(QUERIES["op5_suffix_dedup"](spark, sf).collect(), key=lambda r: r.doc_id)
    assert [(r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in rows] == plain([texts[k] for k in sorted(texts)])


def test_texts_looked_at_together_have_their_own_anchors():
    draw = random.Random(4)
    texts = [bytes(draw.choice(b"ab ") for _ in range(n)) for n in (500, 0, 199, 200, 16, 900)]
    number, gram, at, first, last = (c.tolist() for c in anchors_of(texts, 200))
    found = [list(zip(gram, at, first, last))[i] for k in range(len(texts)) for i in range(len(number)) if number[i] == k]
    assert number == sorted(number) and found == [row for text in texts for row in anchors(text, 200)]


def test_runs_of_sorted_extents():
    draw = random.Random(6)
    gram = bytes(draw.choice(b"xyz") for _ in range(10))
    extents = []
    for _ in range(60):
        low = draw.randint(0, 3)
        high = low + draw.randint(0, 6)
        extents.append((7, low, high, bytes(draw.choice(b"ab") for _ in range(high)) + gram + bytes(draw.choice(b"ab") for _ in range(10 - low))))
    windows = [[data[k:k + 20] for k in range(high - low + 1)] for _, low, high, data in extents]
    seen = Counter(w for own in windows for w in set(own))
    runs = [set() for _ in extents]
    for own, a, b in zip(*(c.tolist() for c in sort_extents(extents, 20))):
        assert a <= b and not runs[own] & set(range(a - 1, b + 2))
        runs[own] |= set(range(a, b + 1))
    again = [{k for k, w in enumerate(own) if seen[w] > 1 or own.count(w) > 1} for own in windows]
    assert runs == again
