"""SimHash against a plain definition and all pairs."""
import random
import re

import numpy as np
import xxhash
from rostrum.llm.queries import QUERIES
from rostrum.llm.simhash import fingerprint, link_fingerprints, near_duplicates, one_of_each
from rostrum.llm.components import components


def plain_fingerprint(text, words=3):
    found = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    shingles = [" ".join(found[i:i + words]) for i in range(len(found) - words + 1)] or ([" ".join(found)] if found else [])
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(prints, distance=3):
    """Component number of each fingerprint, by all pairs."""
    label = list(range(len(prints)))
    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= distance and label[i] != label[j]:
                a, b = sorted((label[i], label[j]))
                label = [a if x == b else x for x in label]
    return label


def test_fingerprint(awkward):
    for _, text in awkward:
        assert fingerprint(text) == plain_fingerprint(text)
    assert fingerprint("A b") == fingerprint("a\tB") and fingerprint(None) == 0


def test_links_equal_all_pairs(spark):
    draw = random.Random(1)
    prints = []
    for _ in range(25):
        center = draw.getrandbits(64)
        for _ in range(12):
            x = center
            for _ in range(draw.randint(0, 5)):
                x ^= 1 << draw.randrange(64)
            prints.append(x)
    prints = sorted(set(prints))
    signed = np.array(prints, np.uint64).view(np.int64).tolist()
    table = spark.createDataFrame([(x,) for x in signed], "print long")
    want = plain_components(prints)
    for block in (1024, 2):
        of = {r.node: r.component for r in components(link_fingerprints(table, 3, block)).collect()}
        got = [of.get(x, x) for x in signed]
        for i in range(len(got)):
            for j in range(i):
                assert (got[i] == got[j]) == (want[i] == want[j])


def test_components_of_a_long_chain(spark):
    chain = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 101), (101, 100), (7, 7)], "u long, v long")
    of = {r.node: r.component for r in components(chain).collect()}
    assert of == {**{i: 0 for i in range(61)}, 100: 100, 101: 100}


def test_rows(spark, docs, awkward):
    out = near_duplicates(docs(awkward)).collect()
    assert len(out) == len(awkward)
    texts = {}
    for key, text in awkward:
        texts.setdefault(key, text)
    for r in out:
        assert r.fingerprint == f"{plain_fingerprint(texts[r.doc_id]):016x}"
    by_id = {r.doc_id: r.component_id for r in out}
    assert by_id[1] == by_id[2] == by_id[3] == 1 and by_id[4] == by_id[5] == 4 and by_id[None] is None
    assert near_duplicates(docs([])).count() == 0
    kept = one_of_each(docs(awkward).withColumnRenamed("source", "simhash_x"))
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["1", "4", "6", "7", "8", "9", "None"]


def test_registered_query(spark):
    sf = "/root/testdata/sf0.001"
    rows = sorted(QUERIES["op4_simhash"](spark, sf).collect(), key=lambda r: r.doc_id)
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    prints = [plain_fingerprint(texts[r.doc_id]) for r in rows]
    assert [int(r.fingerprint, 16) for r in rows] == prints
    label = plain_components(prints)
    assert [r.component_id for r in rows] == [rows[k].doc_id for k in label]
