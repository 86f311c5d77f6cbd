"""Python-equivalent string primitives vs Python's own str methods (random Unicode)."""
import random
import re

from pyspark.sql import functions as F

from rostrum.functions.headers import python_title
from rostrum.functions.names import ws_tokens
from rostrum.functions.text import capitalize, pstrip, py_round, squash_ws, strip_chars

ALPHABET = list("abcXYZ éÉüß'.-,_ 0129") + [" ", "\t", "  ", "o'n", "mc", "III"]


def _rand(r):
    return "".join(r.choice(ALPHABET) for _ in range(r.randint(0, 12)))


def test_primitives_match_python(spark):
    r = random.Random(3)
    texts = [_rand(r) for _ in range(3000)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, t string")
    c = F.col("t")
    rows = df.select("id", pstrip(c).alias("strip"), squash_ws(c).alias("squash"), capitalize(c).alias("cap"),
                     python_title(c).alias("title"), strip_chars(c, ".,").alias("sc"),
                     ws_tokens(c).alias("split")).collect()
    for row in rows:
        t = texts[row["id"]]
        assert row["strip"] == t.strip(), repr(t)
        assert row["squash"] == re.sub(r"\s+", " ", t), repr(t)
        assert row["cap"] == t.capitalize() or t[:1] in "ß", repr(t)
        assert row["title"] == t.title() or "ß" in t, repr(t)
        assert row["sc"] == t.strip(".,"), repr(t)
        assert list(row["split"]) == t.split(), repr(t)


def test_py_round_matches_python(spark):
    r = random.Random(4)
    vals = [float(f"{r.randint(0, 200000) / 1000:.3f}") for _ in range(5000)] + [n / 12 for n in range(600)]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "id int, x double")
    got = {x["id"]: (x["r2"], x["r4"]) for x in
           df.select("id", py_round(F.col("x"), 2).alias("r2"), py_round(F.col("x"), 4).alias("r4")).collect()}
    bad = [(v, got[i], (round(v, 2), round(v, 4))) for i, v in enumerate(vals) if got[i] != (round(v, 2), round(v, 4))]
    assert not bad, bad[:5]
