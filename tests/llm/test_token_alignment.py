"""Groups, links and counts against a plain computation with the libraries."""
import hashlib
import random
from collections import Counter

import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from rostrum.llm import token_alignment as T
from rostrum.llm.queries import BYTE_TOKENIZER, PIECE_MODEL, QUERIES

SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
HOSTILE = [(1, None), (2, ""), (3, " "), (4, "two  spaces\n\n\tand tabs "), (5, "<|endoftext|> <s> </s> <unk> <0x41>"), (6, "▁ under ▁▁"),
           (7, "日本語 😀 é ﬁ ́x"), (8, "a" * 3000), (9, "xyzzy" * 900), (4, "two  spaces\n\n\tand tabs "), (None, "null id"),
           (10, "nul \x00 and \x7f \x85   ﻿"), (11, "½ ² ™ Å"), (12, "ab" * 20_000), (13, "\r\n \r")]


class Plain:
    def __init__(self):
        self.a, self.b = Tokenizer.from_file(BYTE_TOKENIZER), sentencepiece.SentencePieceProcessor(model_file=PIECE_MODEL)
        self.a.encode_special_tokens = True
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        self.byte = {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in plain)}

    def groups(self, text):
        if not text:
            return [], [], []
        raw = (" " + text).encode()
        a, b = self.a.encode(" " + text, add_special_tokens=False).ids, self.b.encode(text)
        a_bytes = [bytes(self.byte[c] for c in self.a.id_to_token(i)) for i in a]
        b_bytes = [bytes([int(self.b.id_to_piece(i)[3:5], 16)]) if self.b.is_byte(i) else self.b.id_to_piece(i).replace("▁", " ").encode()
                   for i in b]
        if b"".join(a_bytes) != raw or b"".join(b_bytes) != raw:
            return [], [], []
        groups, i, j, x, y = [], 0, 0, 0, 0
        at_a = at_b = 0
        while i < len(a):
            at_a += len(a_bytes[i])
            i += 1
            while at_b < at_a:
                at_b += len(b_bytes[j])
                j += 1
            if at_a == at_b:
                groups.append((a[x:i], b[y:j]))
                x, y = i, j
        return a, b, groups


def brute(rows):
    plain, done, counts = Plain(), [], Counter()
    for i, text in rows:
        a, b, groups = plain.groups(text)
        links = [(x, y) for left, right in groups for x in left for y in right]
        counts.update(set(links))
        done.append((i, a, b, groups, links))
    most = Counter()
    for (x, _), n in counts.items():
        most[x] = max(most[x], n)
    out = []
    for i, a, b, groups, links in done:
        digest = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        out.append((i, len(a), len(b), len(groups), len(links), sum(counts[p] == most[p[0]] for p in links), sum(counts[p] for p in links),
                    hashlib.sha256(digest.encode()).hexdigest() if groups else ""))
    return sorted(out, key=str)


def found(frame):
    return sorted((tuple(r) for r in frame.select(*COLUMNS).collect()), key=str)


@pytest.mark.parametrize("share", [T.SHARE, 0.002, 1.0])
def test_same_as_plain(spark, docs, share):
    rows = [r for r in HOSTILE if len(r[1] or "") < 30_000] + [(20 + k, "the same words " * 3) for k in range(5)]
    assert found(T.align_documents(docs(rows).repartition(3), BYTE_TOKENIZER, PIECE_MODEL, share)) == brute(rows)


def test_long_lists_in_parts(spark, docs, monkeypatch):
    rows = [r for r in HOSTILE if len(r[1] or "") < 4000]
    whole = found(T.align_documents(docs(rows), BYTE_TOKENIZER, PIECE_MODEL))
    monkeypatch.setattr(T, "PART", 3)
    assert found(T.align_documents(docs(rows), BYTE_TOKENIZER, PIECE_MODEL)) == whole == brute(rows)


def test_wide_group_is_counted_without_its_links():
    wide = (tuple([5, 6] * 10_000), tuple([7, 8, 8] * 10_000))
    pairs, times, links = T.pairs_of(wide)
    assert links == 20_000 * 30_000 == sum(times) and len(pairs) == 4


def test_groups(spark, docs):
    rows = HOSTILE[:8]
    got = T.alignments(docs(rows), BYTE_TOKENIZER, PIECE_MODEL).collect()
    plain = Plain()
    want = {i: [(x, y) for x, y in plain.groups(text)[2]] for i, text in rows}
    assert {r.doc_id: [(g.a, g.b) for g in r.groups] for r in got} == want


def test_empty_and_extra_columns(spark, docs):
    assert T.align_documents(docs([]), BYTE_TOKENIZER, PIECE_MODEL).collect() == []
    rows = HOSTILE[:7]
    extra = docs(rows).selectExpr("*", "1 as doc", "2 as id", "3 as a", "4 as n_a", "5 as pair", "6 as times")
    assert found(T.align_documents(extra, BYTE_TOKENIZER, PIECE_MODEL)) == brute(rows)


def test_other_tokenizer_file(spark, docs):
    """Without ranks in the order of merges the tokenizers library makes the ids."""
    sides = T.Sides(BYTE_TOKENIZER, PIECE_MODEL)
    text = " Some <|endoftext|> text, 日本"
    quick, fast = sides.a_ids(text).tolist(), sides.a.fast
    sides.a.fast = None
    try:
        assert sides.a_ids(text).tolist() == quick and sides.groups(text)
    finally:
        sides.a.fast = fast


def test_registered_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    got = QUERIES["op11_token_alignment"](spark, SF)
    assert [t for _, t in got.select(*COLUMNS).dtypes] == ["bigint"] * 7 + ["string"]
    assert found(got) == brute(rows)
    assert public_tokenizers.path("byte_bpe_50k.json") == BYTE_TOKENIZER


def test_common_ends_are_those_of_dictionaries():
    sides = T.load_sides(BYTE_TOKENIZER, PIECE_MODEL)
    for text in [t for _, t in HOSTILE if t]:
        raw = (" " + text).encode()
        a, b = sides.a_ids(" " + text).tolist(), sides.b_ids(text, raw)
        cut = sides.cuts(text)
        if cut is None:
            assert not b or sum(len(sides.a_bytes[i]) for i in a) != len(raw)
            continue
        tables = []
        for ids, sizes in ((a, sides.a_sizes), (b, sides.b_sizes)):
            at, table = 0, {}
            for k, i in enumerate(ids, 1):
                at += int(sizes[i])
                table[at] = k
            tables.append(table)
        both = sorted(tables[0].keys() & tables[1].keys())
        assert [c.tolist() for c in cut[4:]] == [[table[e] for e in both] for table in tables]


def test_quick_ids_are_those_of_sentencepiece():
    sides, rng = T.load_sides(BYTE_TOKENIZER, PIECE_MODEL), random.Random(3)
    quick = sides.b_fast.ids
    pieces = [sides.b.id_to_piece(i).replace("▁", " ") for i in range(sides.b.get_piece_size())]
    characters = [chr(c) for c in [*range(0x250), *range(0x5d0, 0x600), *range(0x4e00, 0x4f00), *range(0x1f600, 0x1f620)]]
    texts = [t for _, t in HOSTILE if t] + pieces + [f"x{c}y {c}" for c in characters]
    texts += ["".join(rng.choices(rng.choice([pieces, characters, list(" ab\né日")]), k=rng.randint(1, 30))) for _ in range(3000)]
    for text in texts:
        if "▁" not in text and "  " not in " " + text:
            assert quick(" " + text).tolist() == sides.b.encode(text)
        raw = (" " + text).encode()
        joined = b"".join(sides.b_bytes[i] for i in sides.b.encode(text))
        assert sides.b_ids(text, raw) == (sides.b.encode(text) if joined == raw else [])


def test_without_quick_ids_the_same(monkeypatch):
    monkeypatch.setattr(T.PieceRanks, "of", staticmethod(lambda path, model: None))
    sides = T.Sides(BYTE_TOKENIZER, PIECE_MODEL)
    assert sides.b_fast is None
    quick = T.load_sides(BYTE_TOKENIZER, PIECE_MODEL)
    assert [sides.groups(t) for _, t in HOSTILE[:9]] == [quick.groups(t) for _, t in HOSTILE[:9]]
