"""Python's patterns on the JVM: the same matches, or a refusal by name."""
import re

import pytest
from pyspark.sql import functions as F

from rostrum.functions import headers as H
from rostrum.functions.regex_dialect import UnsupportedPattern, to_java

TEXTS = ["Held", "held over", "x_1", "x1", "ÀÉ", "straße", "½ off", "e\u0301a", "a\u00a0b", "a\x1cb", "line\nend", "line\r", "end\n", "end\n\n", "[a]", "a&&b",
         "\\", "a-b", "^", "", " ", "DEGREE_EARNED.TRAINING", "abab", "aabb", "😀 smile", "12٣", "\x0b", "\x08", "tab\there", "aA", "ſ", "İ", "#x y", "."]
PATTERNS = [r"(?P<x>held)", r"(?P<a_b>a)(?P=a_b)", r"(a)(b)\1\2", r"^\w+$", r"\d", r"\D", r"\s", r"\S+\s\S+", r"\bheld\b", r"\Bel", r"[\w-]+$", r"[^\w\s]", r"[^\W\d]",
            r"end$", r"end\Z", r"\Aend", r"(?m)^end|^line$", r"(?s)line.end", r"line.end", r"[[a]", r"[a&&b]", r"[]a]", r"[\]^]", r"\v", r"[\b]", r"\t", r"\x41",
            r"\u00c0", r"\U0001F600", r"\N{BULLET}|a", r"a{,2}b", r"a{2}", r"a*?b", r"a++b", r"(?>a+)b", r"(?<=a)b", r"(?<!a)b", r"a(?=b)", r"a(?!b)",
            r"(?i:A)b", r"(?-i:A)A", r"(?a)\w+$", r"(?a:\w)\w", r"(?x) x  # remark", r"#x\ y", r"()", r"a|", r"\.", r"(?:ab)+", r"\0", r"\141", r"straSSe", r"STRASSE|ß"]
INVALID = ["(", "[", "*a", r"\Q", "(?P<x>a)(?P<x>b)", r"(?<=a+)b", r"\p{L}", "a{2,1}"]
REFUSED = [r"(a)?(?(1)b|c)"]


def test_same_matches(spark):
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "i int, t string")
    got = frame.select("i", *[F.col("t").rlike(to_java(p)).alias(f"p{k}") for k, p in enumerate(PATTERNS)]).orderBy("i").collect()
    for row, text in zip(got, TEXTS, strict=True):
        for k, p in enumerate(PATTERNS):
            assert row[f"p{k}"] == bool(re.search(p, text, re.I)), (p, text)


def test_invalid_and_refused():
    assert [to_java(p) for p in INVALID] == [None] * len(INVALID)
    for p in REFUSED:
        with pytest.raises(UnsupportedPattern, match="conditional group"):
            to_java(p)


def test_headers_by_python_patterns(spark):
    headers = spark.createDataFrame([("held",), ("on hold",), ("Zeugnis",), ("(",)], "h string")
    base = H.standard_name(F.col("h"), "four_regex", {"Degree": [r"(?P<x>held)", r"(?P<word>z)eugnis\Z"], "Role": ["("]}, {})
    got = {r.h: r.b for r in headers.select("h", base.alias("b")).collect()}
    assert got["held"] == got["Zeugnis"] == "Degree" and got["("] == "Role" and got["on hold"] not in ("Degree", "Role")
    with pytest.raises(UnsupportedPattern):
        H.standard_name(F.col("h"), "four_regex", {"Degree": REFUSED}, {})
