"""Language ID: held-out accuracy, rejection, awkward rows."""
import zlib

import numpy as np
from rostrum.llm.langid import cluster, features, keep_identified, predict_documents, train
from rostrum.llm.queries import QUERIES


def test_features_and_clusters():
    a, n = features("Ab ab! 12 ab")
    b, m = features("ab ab ab")
    assert a.tolist() == b.tolist() and n.tolist() == m.tolist() and len(features("12 --")[0]) == 0
    long = features("the cat sat on " * 2000)
    assert set(features("the cat sat on the cat")[0]) <= set(long[0])
    rows = np.repeat(np.eye(3), 5, 0)
    assert len(cluster(rows, 3, 5)) == 3 and len(cluster(rows[:2], 4, 5)) <= 2


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    langs = dict(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang").collect())
    rows = QUERIES["op1_language_id"](spark, sf).collect()
    assert {r.doc_id for r in rows} == set(langs)
    held = [r for r in rows if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1 for r in rows)
    assert np.mean([langs[r.doc_id] == r.lang_pred for r in held]) > 0.99
    assert sum(r.rejected for r in rows) <= 0.001 * len(rows)


def test_awkward_rows(spark, docs, awkward):
    learn = [(k, t, lang) for k, (t, lang) in enumerate([("the cat and the dog and the bird", "en"), ("der hund und die katze und das haus", "de")] * 20)]
    model = train(docs([*learn, (99, None, "en"), (98, "no label", None)]))
    assert sorted(model.languages) == ["de", "en"]
    rows = docs([*awkward, (50, "the bird and the cat"), (51, "die katze und der hund"), (52, "漢字かな交じり"), (53, "123 ... !")])
    out = predict_documents(rows.withColumnRenamed("source", "lang_pred"), model).collect()
    got = {r.doc_id: r for r in out}
    assert len(out) == rows.count()
    assert got[50].lang_pred == "en" and got[51].lang_pred == "de" and not got[50].rejected
    assert all(got[k].lang_pred == "und" and got[k].score == 0 and got[k].rejected for k in (1, 2, 3, 53))
    assert got[52].lang_pred in ("de", "en") and got[52].rejected
    kept = keep_identified(rows, model)
    assert kept.columns == rows.columns and sorted(str(r.doc_id) for r in kept.collect()) == sorted(
        str(r.doc_id) for r in out if not r.rejected)


def test_without_training_rows(spark, docs):
    model = train(docs([]))
    assert [tuple(r) for r in predict_documents(docs([(1, "text")]), model).collect()] == [(1, "und", 0.0, True)]
    assert predict_documents(docs([]), model).count() == 0
