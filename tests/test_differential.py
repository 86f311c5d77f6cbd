"""Differential test: random age texts and provider names through the Spark
rules and through the independently written DuckDB oracle SQL; both must agree
row by row.  Inputs are built from the rule vocabularies so that rule order,
regex corner cases and NULL/blank handling are exercised far beyond the
fixed query templates."""
import os
import random
import tempfile

import duckdb
import pytest

from rostrum.operators.ages import clean_ages
from rostrum.operators.names import clean_names
from rostrum.plans import oracle_ages, oracle_names

N_ROWS = int(os.environ.get("FUZZ_ROWS", "1500"))

AGE_WORDS = ["and", "older", "up", "over", "above", "&", "or", "+", "*", "months", "month", "mo", "mos", "m",
             "days", "day", "d", "years", "year", "yrs", "yr", "y", "Y", "to", "-", "–", "~", "under", "below",
             "less than", "up to", "younger", "and younger", "newborn", "newborns", "Adults", "adult only",
             "infant", "teen", "kids", "children", "Pediatric", "none", "None", "no restriction", "all ages",
             "between", ">=", ">", "<", "<=", "fetal", "birth", "plus", "Age", "a n d up", "andUp", "seniors",
             "no age restriction", "members", "adolescents to adult", "young adults"]
HEADERS = ["Minimum Age", "Maximum Age", "Age Range From", "Age", None, "Max Age (<=)", "min", "Patient MAX",
           "Lower bound", "upper bound age", "Practice limitations: Min Age", "Ages", "header"]


def _num(r):
    return str(r.choice([0, 1, 2, 5, 6, 12, 17, 18, 19, 21, 28, 30, 65, 99, 100, 120, 129, 150, 151, 1000,
                         r.randint(0, 200)])) + (r.choice(["", "", "", ".5", ".25"]))


def age_text(r):
    if r.random() < 0.05:
        return None
    parts = []
    for _ in range(r.randint(1, 5)):
        parts.append(_num(r) if r.random() < 0.45 else r.choice(AGE_WORDS))
    sep = r.choice([" ", " ", "", "  "])
    s = sep.join(parts)
    if r.random() < 0.1:
        s = " " + s + " "
    return s


GIVEN = ["John", "Mary", "Anna", "Lee", "Amy", "JOHN", "Élodie", "O'Neil", "Oor", "jean-luc", "A.", "Q", "J"]
LAST = ["Doe", "Smith", "Wilson", "Cruz", "DOE", "Van", "Der", "Berg", "de", "la", "Mac", "St.", "Jones"]
DEG = ["MD", "M.D.", "DO", "PhD", "RN", "RN BSN", "NP-C", "PA-C", "FNP", "DPT", "MBA", "CPA", "Esq", "BSc", "LPC",
       "ABC", "md", "Jr", "Sr", "III", "IV", "jr.", "MI"]
ORG = ["Hospital", "Clinic", "Health", "Pharmacy", "Pvt", "Ltd", "Inc", "& Sons", "University", "Care",
       "Medical", "Center", "Bank", "Co."]
TITLE = ["Dr.", "Mr", "Mrs.", "Prof", "Sir"]


def name_text(r):
    if r.random() < 0.04:
        return r.choice([None, "", "  "])
    shape = r.randint(0, 6)
    g, l, d = r.choice(GIVEN), r.choice(LAST), r.choice(DEG)
    if shape == 0:
        s = f"{l}, {g}"
    elif shape == 1:
        s = f"{g} {r.choice(GIVEN)} {l}"
    elif shape == 2:
        s = f"{l}, {g}, {d}"
    elif shape == 3:
        s = f"{r.choice(TITLE)} {g} {l} {d}"
    elif shape == 4:
        s = f"{l} {r.choice(ORG)}"
    elif shape == 5:
        s = f"{g} {l} ({r.choice(ORG)} {r.choice(LAST)})"
    else:
        s = ", ".join(r.choice(GIVEN + LAST + DEG + ORG) for _ in range(r.randint(1, 4)))
    if r.random() < 0.2:
        s = s + r.choice([" " + d, ", " + d, " " + r.choice(DEG) + " " + d, "."])
    if r.random() < 0.1:
        s = r.choice([" ", "  "]) + s.replace(" ", "  ") + " "
    return s


@pytest.fixture(scope="module")
def fuzz_tables(spark):
    r = random.Random(int(os.environ.get("FUZZ_SEED", "20240601")))
    d = tempfile.mkdtemp(prefix="rostrum-fuzz-")
    ages = spark.createDataFrame([(i, age_text(r), r.choice(HEADERS)) for i in range(N_ROWS)],
                                 "id bigint, header_col_value string, header_col_name string")
    names = spark.createDataFrame([(i, name_text(r), r.choice(["a.xlsx", "Roster Files - top 20 entities_desensitized.xlsx"]))
                                   for i in range(N_ROWS)], "id bigint, header_col_value string, file_name string")
    two = spark.createDataFrame([(i, age_text(r), age_text(r), age_text(r)) for i in range(N_ROWS)],
                                "p_partkey bigint, `Accepts Minimum Patient Age` string, "
                                "`Accepts Maximum Patient Age` string, `Age Group` string")
    paths = {}
    for name, df in [("ages", ages), ("names", names), ("two", two)]:
        paths[name] = os.path.join(d, name)
        df.coalesce(1).write.parquet(paths[name])
    con = duckdb.connect()
    for name, p in paths.items():
        con.execute(f"CREATE VIEW fuzz_{name} AS SELECT * FROM read_parquet('{p}/*.parquet')")
    oracle_ages.SOURCES.update({"age_text": "SELECT * FROM fuzz_ages", "age_two_col": "SELECT * FROM fuzz_two",
                                "provider_text": "SELECT * FROM fuzz_names"})
    yield {k: spark.read.parquet(p) for k, p in paths.items()}, con
    oracle_ages.SOURCES.clear()


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(repr(tuple(row[i] for i in order)) for row in rows)


def _check(df, con, sql):
    res = con.execute(sql)
    ocols = [c[0] for c in res.description]
    assert sorted(df.columns) == sorted(ocols)
    got = _rows(df.columns, [tuple(r) for r in df.collect()])
    exp = _rows(ocols, res.fetchall())
    diff = sorted(set(got) ^ set(exp))
    assert got == exp, diff[:6]


AGE_CASES = {
    "label_map": lambda t: clean_ages(t, "label_map", value_col="header_col_value"),
    "phrase": lambda t: clean_ages(t, "phrase"),
    "phrase_hdr": lambda t: clean_ages(t, "phrase_hdr"),
    "band": lambda t: clean_ages(t.withColumnRenamed("header_col_name", "header_colName"), "band"),
    "simple120": lambda t: clean_ages(t, "simple120"),
}
AGE_SQL = {"label_map": oracle_ages.age_label_map, "phrase": oracle_ages.age_phrase,
           "phrase_hdr": oracle_ages.age_phrase_hdr, "band": oracle_ages.age_band,
           "simple120": oracle_ages.age_simple120}


@pytest.mark.parametrize("profile", list(AGE_CASES))
def test_ages_agree(fuzz_tables, profile):
    tables, con = fuzz_tables
    _check(AGE_CASES[profile](tables["ages"]), con, AGE_SQL[profile]())


def test_two_col_agrees(fuzz_tables):
    tables, con = fuzz_tables
    _check(clean_ages(tables["two"], "two_col", keep=["p_partkey"]), con, oracle_ages.age_two_col())


NAME_SQL = {
    "degree_caps": lambda: oracle_names.degree_names("degree_caps"),
    "degree_dict": lambda: oracle_names.degree_names("degree_dict"),
    "credential_org": lambda: oracle_names.credential_names("credential_org"),
    "credential_list": lambda: oracle_names.credential_names("credential_list"),
    "credential_clean": lambda: oracle_names.credential_names("credential_clean"),
    "format_detect": oracle_names.format_detect,
}


@pytest.mark.parametrize("profile", list(NAME_SQL))
def test_names_agree(fuzz_tables, profile):
    tables, con = fuzz_tables
    kw = {"keep": ["id"]} if profile.startswith("degree") else {}
    _check(clean_names(tables["names"], profile, **kw), con, NAME_SQL[profile]())


HEADER_WORDS = ["Degree", "Degrees", "degree(s)", "credential", "Credentials", "MD", "M.D", "DO", "D.O", "PhD", "Dr",
                "DMD", "PA-C", "NP", "RN", "MS", "Taxonomy", "Tax", "Code", "tax code", "Specialty", "Speciality",
                "Special", "Specialist", "Specialization", "Primary", "Secondary", "Third", "3rd", "Care",
                "primary care", "PCP", "Role", "Spec", "Name", "First", "Last", "Middle", "Given", "Group", "DOB",
                "Date of Birth", "DEA", "License", "Lic", "Policy", "Board", "Cert", "Certified", "Fax", "Fx",
                "Phone", "Tel", "Telephone", "Email", "E-mail", "Mail", "Contact", "Provider", "ID", "Number",
                "#", "(", ")", "_", ".", "-", "/", ":", "DEGREE_EARNED.TRAINING_PROG_DEGREE", "x", "Indicator"]


def header_text(r):
    if r.random() < 0.03:
        return r.choice(["", " ", None])
    parts = [r.choice(HEADER_WORDS) for _ in range(r.randint(1, 5))]
    s = r.choice([" ", " ", "", "_"]).join(parts)
    return r.choice([s, s.upper(), s.lower(), " " + s + " "])


@pytest.mark.parametrize("profile", ["general", "three", "four", "four_regex", "four_list"])
def test_header_profiles_agree(spark, profile):
    from pyspark.sql import functions as F

    from rostrum.functions.headers import standard_name
    from rostrum.plans.oracle_roster import base_sql
    r = random.Random(int(os.environ.get("FUZZ_SEED", "7")) + len(profile))
    rows = [(i, header_text(r)) for i in range(N_ROWS)]
    df = spark.createDataFrame(rows, "id bigint, h string").filter(F.col("h").isNotNull())
    got = {x["id"]: x["b"] for x in df.select("id", standard_name(F.col("h"), profile).alias("b")).collect()}
    con = duckdb.connect()
    con.execute("CREATE TABLE hdr (id BIGINT, h VARCHAR)")
    con.executemany("INSERT INTO hdr VALUES (?, ?)", [x for x in rows if x[1] is not None])
    exp = dict(con.execute(f"SELECT id, {base_sql('h', profile)} FROM hdr").fetchall())
    bad = [(rows[i][1], got[i], exp[i]) for i in got if got[i] != exp[i]]
    assert not bad, bad[:8]


def path_text(r):
    segs = ["", ".", "..", "home", "airflow", "gcs", "dags", "team", "x", "job.py", "a", "b", "gcs2", "data"]
    s = "/".join(r.choice(segs) for _ in range(r.randint(1, 7)))
    return r.choice(["", "/", "//", "///", "/home/airflow/gcs/", "/srv/", "x/"]) + s


def test_path_prefix_agrees(spark):
    from pyspark.sql import functions as F

    from rostrum.functions.paths import storage_prefix
    from rostrum.plans.oracle_misc import _norm, prefix_sql
    r = random.Random(int(os.environ.get("FUZZ_SEED", "5")))
    rows = [(i, path_text(r)) for i in range(N_ROWS)]
    got = {x["id"]: x["p"] for x in spark.createDataFrame(rows, "id bigint, path string")
           .select("id", storage_prefix(F.col("path")).alias("p")).collect()}
    con = duckdb.connect()
    con.execute("CREATE TABLE paths (id BIGINT, path VARCHAR)")
    con.executemany("INSERT INTO paths VALUES (?, ?)", rows)
    exp = dict(con.execute(f"SELECT id, {prefix_sql('np')} FROM (SELECT id, {_norm('path')} AS np FROM paths)")
               .fetchall())
    bad = [(rows[i][1], got[i], exp[i]) for i in got if got[i] != exp[i]]
    assert not bad, bad[:8]


def test_normpath_dirname_match_posixpath(spark):
    import posixpath

    from pyspark.sql import functions as F

    from rostrum.functions.paths import dirname, normpath
    r = random.Random(99)
    rows = [(i, path_text(r)) for i in range(N_ROWS)]
    df = spark.createDataFrame(rows, "id bigint, path string")
    got = {x["id"]: (x["n"], x["d"]) for x in df.select("id", normpath(F.col("path")).alias("n"),
                                                           dirname(F.col("path")).alias("d")).collect()}
    bad = [(p, got[i], (posixpath.normpath(p), posixpath.dirname(p))) for i, p in rows
           if got[i] != (posixpath.normpath(p), posixpath.dirname(p))]
    assert not bad, bad[:8]
