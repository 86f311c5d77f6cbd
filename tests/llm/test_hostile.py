"""Hostile and very long input within a time, and columns whose names the operators use inside."""
import re
import time

import pytest
from pyspark.sql import functions as F

from rostrum.llm.html_text import main_text, page_lines, surge_and_dive
from rostrum.llm.secrets import scan
from rostrum.llm.simhash import one_of_each
from rostrum.llm.suffix_dedup import without_repeats


def timed(run, text):
    began = time.process_time()
    out = run(text)
    assert time.process_time() - began < 20
    return out


@pytest.mark.parametrize("page", ["<a " * 330_000, '<a "' * 250_000, "<div>" * 100_000 + "</p>" * 100_000, '<a ">" ' * 150_000, "<p>" + "x<" * 500_000,
                                  "<script " * 120_000, "<!--" * 250_000, "<p>word " * 120_000])
def test_pages_of_a_megabyte(page):
    timed(main_text, page)


def test_names_that_are_built_up():
    doubled = "x = 'Tr0ub4dor&3x'\n" + "x = x + x\n" * 50_000 + "password = x\n"
    assert timed(scan, doubled)[1] == [(5, 17, "literal")]
    many = "".join(f"x = x + 'Lit{i}er&l9'\n" for i in range(20_000)) + "secret_key = x\n"
    assert len(timed(scan, many)[1]) == 20_000
    # a name stands for what it had when it was taken over
    assert scan("a = 'Qw8#mZ!pLr'\nb = a\na = 'harmless'\npassword = b")[1] == [(5, 15, "literal")]
    assert scan("a = 'Qw8#mZ!pLr'\nb = a\na = 'x'\npassword = a")[1] == []


def test_the_distribution_decides(spark):
    pages = [r.html for r in spark.read.parquet("/root/testdata/sf0.001/pages.parquet").collect()]
    located = 0
    for page in pages:
        lines, _ = page_lines(page)
        located += surge_and_dive([0 if beside else len(text) for text, beside, *_ in lines], 3) is not None
        bare = re.sub(r"</?(article|main)\b[^>]*>", "<div>", page)
        assert main_text(bare) == main_text(page)        # the marks only weigh
    assert located >= 0.95 * len(pages)


CLASHING = ["simhash", "simhash_text", "simhash_row", "text_key", "text_key2", "copies", "kept", "component", "row", "words", "first", "c0", "c1"]


@pytest.mark.parametrize("stage", [one_of_each, without_repeats])
def test_clashing_names_keep_their_values(spark, docs, stage):
    repeated = "a passage that is long enough to be found again in another text " * 5
    rows = [(1, "one two three four five six"), (2, "one two three four five six"), (3, None), (4, "alone " + repeated), (5, repeated + " and more")]
    plain = docs(rows)
    wide = plain.select("*", *[F.concat(F.lit(f"{n} "), "doc_id").alias(n) for n in CLASHING])
    want = {tuple(r) for r in stage(plain).collect()}
    got = stage(wide)
    assert got.columns == wide.columns
    found = got.collect()
    assert {tuple(r)[:5] for r in found} == want and len(found) == len(want)
    assert all(r[n] == f"{n} {r.doc_id}" for r in found for n in CLASHING)
