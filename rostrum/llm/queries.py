"""Queries of the training-data operators: op<N>_<name>, each over its whole table."""
from __future__ import annotations

import public_tokenizers

from ..session import land
from . import compression
from .common import in_bucket, table
from .cover_tree import top_k
from .fingerprints import fingerprint_documents
from .html_text import extract_pages
from .langid import predict_documents, train
from .oracle import OP3_SQL, OP13_SQL
from .packing import pack_documents
from .prefix_trie import trie_of_conversations
from .secrets import scan_documents
from .sentencepiece_bpe import encode_documents
from .simhash import near_duplicates
from .suffix_dedup import dedup_documents
from .suffix_tree_lm import score_documents
from .suffix_tree_lm import train as train_tree
from .token_alignment import align_documents

PIECE_MODEL = public_tokenizers.path("piece_bpe_32k.model")
BYTE_TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def op1_language_id(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").withColumn("held_out", in_bucket("doc_id", 5, 0))
    model = train(docs.filter("not held_out"))
    return predict_documents(docs, model, keep=("held_out",))


def op2_html_extraction(spark, sf_dir):
    return extract_pages(table(spark, sf_dir, "pages"))


def op3_cover_tree(spark, sf_dir):
    rows = table(spark, sf_dir, "embeddings")
    return top_k(rows, rows.filter("vec_id % 100 = 0"))


def op4_simhash(spark, sf_dir):
    return near_duplicates(table(spark, sf_dir, "documents"))


def op5_suffix_dedup(spark, sf_dir):
    return dedup_documents(table(spark, sf_dir, "documents"))


def op6_nnls_packing(spark, sf_dir):
    return pack_documents(table(spark, sf_dir, "documents"), BYTE_TOKENIZER)


def op7_suffix_tree_lm(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").withColumn("held_out", in_bucket("doc_id", 5, 1))
    tree, counts = train_tree(docs.filter("not held_out"))
    return score_documents(docs, tree, counts, keep=("held_out",))


def op8_weighted_sampling(spark, sf_dir):
    return fingerprint_documents(table(spark, sf_dir, "documents"))


def op9_secret_scan(spark, sf_dir):
    return scan_documents(table(spark, sf_dir, "documents"))


def op10_sentencepiece(spark, sf_dir):
    return encode_documents(table(spark, sf_dir, "documents"), PIECE_MODEL)


def op11_token_alignment(spark, sf_dir):
    return align_documents(table(spark, sf_dir, "documents"), BYTE_TOKENIZER, PIECE_MODEL)


def op12_compression_quality(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").withColumn("held_out", in_bucket("doc_id", 5, 0))
    training, labels = docs.filter("not held_out"), table(spark, sf_dir, "labels")
    model = compression.learn(training, labels)
    gaps = land(compression.differences(docs, model, keep=("held_out",)), "differences")
    return compression.scored(gaps, compression.calibrated(model, gaps.filter("not held_out"), labels))


def op13_prefix_trie(spark, sf_dir):
    return trie_of_conversations(table(spark, sf_dir, "conversations"), heads=True).drop("path")


QUERIES = {
    "op1_language_id": op1_language_id,
    "op2_html_extraction": op2_html_extraction,
    "op3_cover_tree": op3_cover_tree,
    "op4_simhash": op4_simhash,
    "op5_suffix_dedup": op5_suffix_dedup,
    "op6_nnls_packing": op6_nnls_packing,
    "op7_suffix_tree_lm": op7_suffix_tree_lm,
    "op8_weighted_sampling": op8_weighted_sampling,
    "op9_secret_scan": op9_secret_scan,
    "op10_sentencepiece": op10_sentencepiece,
    "op11_token_alignment": op11_token_alignment,
    "op12_compression_quality": op12_compression_quality,
    "op13_prefix_trie": op13_prefix_trie,
}

#: DuckDB SQL of the queries that SQL can express on whole tables.
ORACLE: dict[str, str] = {
    "op3_cover_tree": OP3_SQL,
    "op13_prefix_trie": OP13_SQL,
}
