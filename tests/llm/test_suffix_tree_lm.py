"""Scores: the base against its formula, the tree against its definition, held-out gain."""
import math
import re
import zlib
from collections import Counter
from dataclasses import replace

import numpy as np
import pytest
from rostrum.llm.queries import QUERIES
from rostrum.llm.suffix_tree_lm import END, Entries, Words, _answers, _repeated, _token_counts, score_documents, train


def tokens(text):
    return re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")) + [None]


def base(text, counts):
    n, v = sum(counts.values()), len(counts)
    return sum(math.log10((counts[t] + 0.5) / (n + 0.5 * (v + 1))) for t in tokens(text))


def plain_scores(training, texts, gain, weight, least=2):
    """The tree by its definition, over words."""
    one, two, three = Counter(), Counter(), Counter()
    for t in training:
        w = tokens(t)
        one.update(w), two.update(zip(w, w[1:])), three.update(zip(w, w[1:], w[2:]))
    n, v = sum(one.values()), len(one)
    root = lambda x: (one[x] + 0.5) / (n + 0.5 * (v + 1))
    fine = {x for x, k in one.items() if k >= least}
    pairs = {c: k for c, k in two.items() if k >= least}
    triples = {c: k for c, k in three.items() if k >= least and c[:2] in pairs and c[1:] in pairs}
    states = {}

    def p(x, context):
        if not context:
            return root(x)
        if context not in states:
            return p(x, context[1:])
        held, factor = states[context]
        return held[x] if x in held else factor * p(x, context[1:])

    for order, table, count in ((1, pairs, one), (2, triples, two)):
        after = {}
        for c, k in table.items():
            after.setdefault(c[:-1], {})[c[-1]] = k
        new = {}
        for context, nexts in after.items():
            total = count[context[0]] if order == 1 else count[context]
            above = {x: p(x, context[1:]) for x in nexts}
            kl = sum(k / total * math.log(k / total / above[x]) for x, k in nexts.items())
            rest, rest_above = 1 - sum(nexts.values()) / total, max(1 - sum(above.values()), 1e-12)
            if rest > 1e-15:
                kl += rest * math.log(rest / rest_above)
            if total * kl >= gain and (order == 1 or context[1:] in states):
                held = {x: (k + weight * above[x]) / (total + weight) for x, k in nexts.items()}
                new[context] = held, max(1 - sum(held.values()), 1e-12) / rest_above
        states.update(new)
    assert fine and states
    out = []
    for t in texts:
        w = tokens(t)
        out.append(sum(math.log10(p(x, tuple(w[max(0, i - 2):i]))) for i, x in enumerate(w)))
    return out


def test_tree_equals_its_definition(spark, docs):
    sf = "/root/testdata/sf0.001"
    texts = [r.text for r in spark.read.parquet(f"{sf}/documents.parquet").orderBy("doc_id").collect()][:60]
    tree, counts = train(docs(list(enumerate(texts[:45]))), share=0.0, gain=3.0, weight=2.0)
    assert all(len(s) for s in tree.states)
    rows = sorted(score_documents(docs(list(enumerate(texts))), tree, counts).collect(), key=lambda r: r.doc_id)
    want = plain_scores(texts[:45], texts, 3.0, 2.0)
    assert [r.score for r in rows] == pytest.approx(want, rel=1e-9)


def test_share_decides_no_score(spark, docs):
    sf = "/root/testdata/sf0.001"
    texts = [r.text for r in spark.read.parquet(f"{sf}/documents.parquet").orderBy("doc_id").collect()][:60]
    want = plain_scores(texts[:45], texts, 3.0, 2.0)
    for share in (2e-3, 0.5):       # pairs under the share are asked for, not forgotten
        tree, counts = train(docs(list(enumerate(texts[:45]))), share=share, gain=3.0, weight=2.0)
        assert tree.others.filter("kind > 0").count()
        rows = sorted(score_documents(docs(list(enumerate(texts))), tree, counts).collect(), key=lambda r: r.doc_id)
        assert [r.score for r in rows] == pytest.approx(want, rel=1e-9)


def test_probabilities_sum_to_one(spark, docs):
    sf = "/root/testdata/sf0.001"
    texts = [r.text for r in spark.read.parquet(f"{sf}/documents.parquet").orderBy("doc_id").collect()][:40]
    tree, counts = train(docs(list(enumerate(texts))), share=0.0, gain=1.0)
    words = Words()
    every = np.array(sorted(r.token for r in counts.collect()))
    n = dict(counts.collect())
    rare = np.log([(n[t] + 0.5) / (tree.total + 0.5 * (tree.vocabulary + 1)) for t in every.tolist()])
    context = words.tokens("\n".join(texts))[:-1]
    for at in range(2, 400, 40):
        lead = context[at - 2:at]
        total = 0.0
        before = tree.score(np.array([*lead]))[0]
        for t, log in zip(every, rare):
            ln, _, _, left = tree.score(np.array([*lead, t]))
            total += math.exp(ln - before + (log if t in left[-1:] and len(left) > len(tree.score(lead)[3]) else 0))
        unseen = math.exp(tree.score(np.array([*lead, -5]))[0] - before) * 0.5 / (tree.total + 0.5 * (tree.vocabulary + 1))
        assert total + unseen == pytest.approx(1, abs=1e-6)


def test_registered_query(spark):
    sf = "/root/testdata/sf0.01"
    texts = dict(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect())
    held = {k: zlib.crc32(str(k).encode()) % 5 == 1 for k in texts}
    counts = Counter(t for k, text in texts.items() if not held[k] for t in tokens(text))
    rows = QUERIES["op7_suffix_tree_lm"](spark, sf).collect()
    assert {r.doc_id for r in rows} == set(texts)
    for r in rows:
        w = tokens(texts[r.doc_id])
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (
            held[r.doc_id], len(w), sum(counts[t] > 0 for t in w), sum(counts.values()))
        assert r.base_score == pytest.approx(base(texts[r.doc_id], counts), rel=1e-9)
    assert sum(r.score for r in rows if r.held_out) > 0.96 * sum(r.base_score for r in rows if r.held_out)
    assert np.mean([r.score > r.base_score for r in rows if r.held_out]) > 0.75


def test_awkward_rows(spark, docs, awkward):
    tree, counts = train(docs(awkward))
    out = score_documents(docs(awkward).withColumnRenamed("source", "ln"), tree, counts).collect()
    known = Counter(t for _, text in awkward for t in tokens(text))
    assert len(out) == len(awkward)
    by_id = {key: text for key, text in awkward}
    for r in out:
        assert r.base_score == pytest.approx(base(by_id[r.doc_id], known)) and r.n_known == r.n_tokens == len(tokens(by_id[r.doc_id]))
    tree, counts = train(docs([]))
    assert [(r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in score_documents(
        docs([(1, "a b")]), tree, counts).collect()] == [(3, 0, 0, 0.0, 0.0)]
    assert score_documents(docs([]), tree, counts).count() == 0


def test_counting_hands_on_few_rows_and_all_counts(spark, docs):
    rng = np.random.default_rng(3)
    texts = [" ".join(f"w{x}" for x in rng.integers(0, 60, 400)) for _ in range(50)] + [None, "a", "x" * 100 + " b " + "x" * 100 + " b"]
    two, three = Counter(), Counter()
    for t in texts:
        w = tokens(t)
        two.update(zip(w, w[1:])), three.update(zip(w, w[1:], w[2:]))
    frame, words = docs(list(enumerate(texts))), Words()
    code = {t: int(words.tokens(t)[0]) for c in two for t in c if t} | {None: END}
    pairs = {(r.context, r.next): r.n for r in _repeated(frame, "text", 1, 8, 0, 1).collect()}
    assert pairs == {(code[a], code[b]): n for (a, b), n in two.items() if n >= 2}
    found = [[r.n for r in _repeated(frame, "text", 2, 8, turn, 2).collect()] for turn in (0, 1)]
    assert all(found) and Counter(found[0] + found[1]) == Counter(n for n in three.values() if n >= 2)
    plan = _repeated(frame, "text", 1, 8, 0, 1)._jdf.queryExecution().executedPlan().toString()
    assert "next#" in plan and "HashAggregate" not in plan      # a row per task and bucket, not one per pair


def test_tables_leave_no_shuffle_files(spark, docs, monkeypatch):
    from rostrum import session
    from rostrum.llm import suffix_tree_lm

    seen = []
    write = session.land
    monkeypatch.setattr(suffix_tree_lm, "land", lambda df, label, tidy=False: seen.append(tidy) or write(df, label, tidy))
    before = spark.conf.get(session.CLEANUP, None)
    tree, counts = train(docs([(1, "a b a b a b a b"), (2, "a b c")]))
    assert score_documents(docs([(1, "a b")]), tree, counts).count() == 1
    assert len(seen) > 8 and all(seen) and spark.conf.get(session.CLEANUP, None) == before


def test_entries_are_found_also_where_low_bits_are_equal():
    rng = np.random.default_rng(5)
    codes = np.unique(np.concatenate([rng.integers(0, 2**63, 3000), np.arange(50) << 40, [END]]))
    rng.shuffle(codes)
    entries = Entries.of(codes, codes.astype(float), codes.astype(float), codes.astype(float))
    sought = np.concatenate([codes[::3], rng.integers(0, 2**63, 2000), codes[:10], np.arange(60) << 40])
    held, at = entries.find(sought)
    assert held.tolist() == np.isin(sought, codes).tolist() and entries.codes[at].tolist() == sought[held].tolist()
    assert [x.tolist() for x in Entries().find(sought[:2])] == [[False, False], []]


def test_tokens_and_entries_go_as_arrays(spark, docs):
    """A row per task and bucket; a text is asked about once, whatever the number of slices."""
    texts = [" ".join(f"w{(k * j) % 97}" for j in range(300)) for k in range(1, 30)]
    frame = docs(list(enumerate(texts)))
    plan = _token_counts(frame, "text")._jdf.queryExecution().executedPlan().toString()
    assert "FlatMapGroupsInArrow" in plan and "HashAggregate" not in plan
    want = Counter(t for text in texts for t in tokens(text))
    assert Counter(r.n for r in _token_counts(frame, "text").collect()) == Counter(want.values())
    tree, _ = train(frame, share=0.5)
    rows = tree.others.collect()
    assert sum(len(r.codes) // 8 for r in rows) > 10 * len({r.key for r in rows})
    assert all(len(r.adds) == len(r.codes) and len(r.totals) == len(r.codes) * (r.kind == 0) for r in rows)
    sent = spark.sparkContext.broadcast(replace(tree, others=None))
    held = frame.withColumn("row", frame.doc_id.cast("long"))
    asked = [_answers(held.filter(held.row % 2 == turn), sent, tree.others).groupBy("row").sum("n_tokens").collect() for turn in (0, 1)]
    assert {r[0]: r[1] for part in asked for r in part} == {k: len(tokens(t)) for k, t in enumerate(texts)}


def test_tokens_pairs_and_triples_are_counted_in_the_same_passes(spark, docs, monkeypatch):
    from rostrum.llm import suffix_tree_lm

    rng = np.random.default_rng(4)
    texts = [" ".join(f"w{x}" for x in rng.integers(0, 40, 300)) for _ in range(20)] + [None, "once only", "w1"]
    want = [Counter(), Counter(), Counter()]
    for t in texts:
        w = tokens(t)
        want[0].update(w), want[1].update(zip(w, w[1:])), want[2].update(zip(w, w[1:], w[2:]))
    frame = docs(list(enumerate(texts)))
    found = [r for turn in range(3) for r in suffix_tree_lm._counted(frame, "text", (0, 1, 2), 5, turn, 3).collect()]
    assert len({(r.kind, r.code) for r in found}) == len(found)
    for kind, least in enumerate((1, 2, 2)):
        assert Counter(r.n for r in found if r.kind == kind) == Counter(n for n in want[kind].values() if n >= least)
    passes = []
    counted = suffix_tree_lm._counted
    monkeypatch.setattr(suffix_tree_lm, "_counted", lambda *args: passes.append(args[2]) or counted(*args))
    tree, counts = train(frame)
    assert passes == [(0, 1, 2)] * suffix_tree_lm.TURNS and sorted(r.n for r in counts.collect()) == sorted(want[0].values())
    assert (tree.total, tree.vocabulary) == (sum(want[0].values()), len(want[0]))
