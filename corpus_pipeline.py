"""The corpus pipeline: language ID, SimHash near-dedup, suffix-array dedup, secret scans, packing.

Every stage is a function of (spark, docs, sf_dir); its result is written as
Parquet in the shared folder and read back as the next stage's docs. All but
the last return the columns of documents.
"""
from __future__ import annotations

from rostrum.llm import langid, packing, secrets, simhash, suffix_dedup
from rostrum.llm.common import in_bucket
from rostrum.llm.queries import BYTE_TOKENIZER
from rostrum.session import land


def language_id(spark, docs, sf_dir):
    """Documents whose language is rejected go; the classifier learns as in its query."""
    model = langid.train(docs.filter(~in_bucket("doc_id", 5, 0)))
    return langid.keep_identified(docs, model)


def near_dedup(spark, docs, sf_dir):
    """Of each group of near-duplicates the document with the smallest id stays."""
    return simhash.one_of_each(docs)


def cut_repeats(spark, docs, sf_dir):
    """Strings of 200 bytes that start twice are cut out of the texts."""
    return suffix_dedup.without_repeats(docs)


def secret_scan(spark, docs, sf_dir):
    """Secrets in the texts are replaced by a mark."""
    return secrets.redact_documents(docs)


def pack(spark, docs, sf_dir):
    """Token sequences for training: a row per piece."""
    return packing.pack_documents(docs, BYTE_TOKENIZER)


STAGES = [
    ("language_id", language_id),
    ("near_dedup", near_dedup),
    ("suffix_dedup", cut_repeats),
    ("secret_scan", secret_scan),
    ("packing", pack),
]

#: The stages need a trained classifier and a tokenizer, which SQL can't express; tests hold run() against brute force.
ORACLE_SQL = None


def run(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = land(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
