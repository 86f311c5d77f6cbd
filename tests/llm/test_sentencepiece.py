"""Encoding and decoding equal the library's."""
import hashlib
import random
import struct

import pytest
import sentencepiece
from rostrum.llm.queries import PIECE_MODEL, QUERIES
from rostrum.llm.sentencepiece_bpe import encode_documents, load_model

PARTS = [" ", "  ", "   ", "\n", "\t", "a", "the", "ing", "é", "日本", "本", "😀", "▁", "<s>", "</s>", "<0x41>", "\x00", "\x7f",
         "zz", "0", "12", ".", "...", "aaaa", "\xa0", "한국", "'", "://", "\r\n", "====", "ſ"]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PIECE_MODEL)


def test_equals_library_on_random_texts(library):
    model, draw = load_model(PIECE_MODEL), random.Random(5)
    for _ in range(3000):
        text = "".join(draw.choice(PARTS) for _ in range(draw.randint(0, 25)))
        ids = library.encode(text, add_bos=True, add_eos=True)
        assert model.encode(text) == ids
        assert model.encode_decode(text)[1] == library.decode(ids) == model.decode(ids)


@pytest.mark.parametrize("text", ["a" * 3000, " " * 1000, "\n" * 500, "日" * 700, "thethe" * 500, "=-" * 600, "aé" * 600])
def test_long_runs(library, text):
    assert load_model(PIECE_MODEL).encode(text) == library.encode(text, add_bos=True, add_eos=True)


def test_backtracking_equals_merging():
    model, draw = load_model(PIECE_MODEL), random.Random(2)
    for _ in range(500):
        text = "".join(draw.choice("thesaindonr▁") for _ in range(draw.randint(1, 20)))
        assert model.backtrack(text) == model.merged(text)


def test_query_rows(spark, docs, awkward, library):
    out = encode_documents(docs(awkward), PIECE_MODEL, keep_ids=True, keep_text=True).collect()
    assert len(out) == len(awkward)
    for (key, text), r in zip(awkward, out):
        ids = library.encode(text or "", add_bos=True, add_eos=True)
        assert (r.doc_id, r.n_tokens, r.ids) == (key, len(ids), ids)
        assert r.ids_sha256 == hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(library.decode(ids).encode()).hexdigest()
    assert encode_documents(docs([]), PIECE_MODEL).count() == 0


def test_registered_query(spark, library):
    sf = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = QUERIES["op10_sentencepiece"](spark, sf).collect()
    assert {r.doc_id for r in rows} == set(texts)
    for r in rows:
        ids = library.encode(texts[r.doc_id], add_bos=True, add_eos=True)
        assert r.ids_sha256 == hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest()


def test_longest_piece_and_merging_by_definition():
    model, draw = load_model(PIECE_MODEL), random.Random(8)
    for _ in range(300):
        text = "".join(c for c in "".join(draw.choice(PARTS) for _ in range(6)).replace(" ", "▁") if c in model.known)
        for at in range(len(text)):
            best = max((text[at:end] for end in range(at + 1, len(text) + 1) if text[at:end] in model.id_of), key=len)
            assert model.longest(text, at) == model.id_of[best]
        parts = list(text)
        while True:
            pairs = [(-model.pieces[model.id_of[x + y]][1], k) for k, (x, y) in enumerate(zip(parts, parts[1:])) if x + y in model.id_of]
            if not pairs:
                break
            at = min(pairs)[1]
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        assert model.merged(text) == [model.id_of[p] for p in parts]
