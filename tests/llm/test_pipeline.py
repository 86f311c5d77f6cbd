"""The corpus pipeline: stages keep the columns, and each decision shows."""
from collections import Counter

import corpus_pipeline
import pytest
from rostrum.llm.secrets import scan
from rostrum.session import land
from tokenizers import Tokenizer

from .test_packing import check
from .test_simhash import plain_components, plain_fingerprint
from .test_suffix_dedup import plain

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        docs = land(stage(spark, docs, SF), name)
        out.append(docs)
    return out


def test_columns_and_rows(stages):
    documents, identified, near, cut, safe, packed = stages
    for table in (identified, near, cut, safe):
        assert table.dtypes == documents.dtypes
    assert identified.count() == documents.count()          # every document is in a known language
    texts = dict(identified.select("doc_id", "text").collect())
    keys = sorted(texts)
    label = plain_components([plain_fingerprint(texts[k]) for k in keys])
    assert sorted(r.doc_id for r in near.collect()) == sorted({keys[k] for k in label})
    rows = {r.doc_id: r for r in cut.collect()}
    left = sorted(rows)
    for key, (n_bytes, n_removed, _, _) in zip(left, plain([texts[k] for k in left])):
        now = rows[key].text.encode()
        assert n_bytes - n_removed - 6 * (n_removed > 0) * 10 <= len(now) <= n_bytes - n_removed
        assert n_removed or rows[key].text == texts[key]
    for r in safe.collect():
        assert not scan(r.text)[1] and r.n_chars == len(r.text)
        assert scan(rows[r.doc_id].text)[1] or r.text == rows[r.doc_id].text
    library = Tokenizer.from_file(corpus_pipeline.BYTE_TOKENIZER)
    check(packed.collect(), [(r.doc_id, r.text) for r in safe.collect()], library)


def test_run_equals_the_stages(spark, stages):
    columns = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
    whole = lambda t: Counter((r.doc_id, r.doc_tokens) for r in t.select(*columns).filter("start = 0").collect())
    assert whole(corpus_pipeline.run(spark, SF)) == whole(stages[-1])
