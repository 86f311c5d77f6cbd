"""Roster-like inputs derived from the driver tables.

The driver tables hold no roster text, so every registered query derives its
input deterministically from integer keys of a whole table (``part``,
``supplier``, ``customer``, ``documents``, ``pages``); the work therefore grows
with the table.  Each template list is used twice: to build the Spark column
and to print the equivalent DuckDB expression for the oracle SQL.
"""
from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.partitioning import spread_for_cpu

# ---------------------------------------------------------------------------
# Template lists; {n} = p_size (1..50), {m} = p_size + p_partkey % 30,
# {f}/{l}/{F}/{L} = first/last word of p_name (lower / upper case),
# {fc}/{lc} = capitalised.  None = NULL cell.
# ---------------------------------------------------------------------------
AGE_TEMPLATES = [
    "{n}+", "{n}-{m}", "{n} to {m}", "{n} and older", "{n} years and older", "{n} & younger",
    "Under {n}", "{n}", "Adults", "Pediatric", "Newborn to {n}", "None", "{n} months",
    "{n} months and older", "0 - {m}+ years", "{n} days", "{m}–{n}", "{n}Y", "{m} {n}", None, "",
    "up to {n}", "Age {n}", "{n} and up", "newborn - {n} days", "between {n} and {m}", ">= {n}",
    "> {n}", "< {n}", "{n} mos - {m} yrs", "Infants", "18 & Older", "no age restriction", "Teens",
    "fetal", "{n}* ", " {n} a n d up", "{n}andUp", "{n} yrs", "less than {n}", "{n} mo", "Adult only",
    "adolescents to adult", "{n} or older", "{n} & under", "birth to {n}", "all ages", "{n} and over",
]
AGE_HEADERS = ["Minimum Age", "Maximum Age", "Age Range From", "Age", None, "Max Age (<=)",
               "Practice limitations: Min Age", "PATIENT MAX AGE", "AGE_MINIMUM", "PatientAgeMinimum", "MinAge"]

TWO_COL_MIN = ["{n}", "newborn", "{n}+", "28 days", None, "fetal", "{n} months", "", "Adults",
               "{n}-{m}", "Newborns", "{n} years", "> {n}", "kids"]
TWO_COL_MAX = ["{m}", "{n} {m}", "none", None, "newborn", "under {m}", "{m} years", "teen",
               "{n} to {m}", "< {m}", "  ", "{m}.5", "elderly", "up to {m}", "{m} days"]
TWO_COL_AGE = ["{n} - {m}", None, "kids", "{n}", "between {n} and {m}", ""]

NAME_TEMPLATES = [
    "{lc}, {fc}", "{fc} J {lc}", "{lc}, {fc}, MD", "{lc}, {fc} MD", "{L}, {F}", "{lc}, {fc}, MD, RN",
    "{lc}, {fc}, PhD", "{lc} {fc} MI", "{fc} de la {lc}", "{fc}", "St {fc} Hospital",
    "{fc} Pharmacy Pvt Ltd", "{lc}, {fc}, MD, City Hospital", "{lc}, {fc} A.", "Dr. Mr. {fc} {lc}",
    "{lc}, {fc}, Jr, MD", "{fc} {lc} (ABC DEF)", "{fc} Q {lc} Jr", None, "", "Van Der {lc}", "MD",
    "{fc} {lc}, DO PhD", "CARE Clinic / Community Health", "{lc}, {fc} A", "{fc} {lc} RN BSN",
    "{fc} {lc}, PA-C", "{lc}, {fc} {lc}", "{fc}-{lc} {lc}", "{F} {L}", "{fc} O'{lc}",
    "{lc}, Dr. {fc}", "{fc} {lc} III", "{fc} {lc} (Mercy Clinic)", "{lc} Medical Group",
    "{fc} {lc}, M.D.", "{lc}, {fc}, NP-C", "{fc} {lc} MBA CPA", "{lc} & Sons Inc",
    "{fc} {lc} (friend)", "{lc}, {fc}, D.O.", "Oo{l} {fc}",
]

# Names with people and organizations in one value (profile spec).
SPEC_TEMPLATES = [
    "{lc}, {fc}", "{lc}, {fc} A.", "{fc} A {lc}", "{lc}, {fc}, MD", "{lc}, {fc} MD", "St {fc} Hospital", "{fc} Clinic / Community {lc}",
    "{lc}, {fc}, MD, City Hospital", "{fc}", "{lc} {fc} MI", "{lc}, {fc}, PhD", "{fc} Pharmacy Pvt Ltd", "Dr. {fc} {lc} Jr.",
    "{lc}, Dr. {fc}, M.D., III", "MD", None, " , ", "Yo Ma", "{lc}, {fc}, {fc} {lc}, RN", "{fc} {lc}, PhD", "{fc} (other)",
    "{lc}, {fc}, City Clinic, North College", "Do {lc} DO", "{f} {l}  Ann  md", "{fc} {lc} DO RN;", "{F}, {L} X., mba", "{fc} Trust, MD", "MD, RN",
    "Mr. Dr. {lc}", "{lc} de la {fc}, Esq.", "{fc} {lc} II, University of {lc}",
]

ROSTER_FILE = "Roster Files - top 20 entities_desensitized.xlsx"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


_PH = re.compile(r"\{(n|m|f|l|F|L|fc|lc)\}")


def _pieces(tpl: str):
    pos = 0
    for m in _PH.finditer(tpl):
        if m.start() > pos:
            yield ("lit", tpl[pos:m.start()])
        yield ("var", m.group(1))
        pos = m.end()
    if pos < len(tpl):
        yield ("lit", tpl[pos:])


def template_column(templates, key: Column, env: dict[str, Column]) -> Column:
    """CASE key % len(templates) -> filled template (Spark)."""
    k = key % len(templates)
    expr = None
    for i, tpl in enumerate(templates):
        if tpl is None:
            val = F.lit(None).cast("string")
        else:
            parts = [F.lit(x) if kind == "lit" else env[x] for kind, x in _pieces(tpl)] or [F.lit("")]
            val = parts[0] if len(parts) == 1 else F.concat(*parts)
        expr = F.when(k == i, val) if expr is None else expr.when(k == i, val)
    return expr


def _sql_lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def template_sql(templates, key_sql: str, env: dict[str, str]) -> str:
    """Same template choice written as DuckDB SQL."""
    out = [f"CASE ({key_sql}) % {len(templates)}"]
    for i, tpl in enumerate(templates):
        if tpl is None:
            val = "CAST(NULL AS VARCHAR)"
        else:
            parts = [_sql_lit(x) if kind == "lit" else env[x] for kind, x in _pieces(tpl)] or ["''"]
            val = " || ".join(parts) if len(parts) > 1 else parts[0]
        out.append(f"WHEN {i} THEN {val}")
    out.append("END")
    return " ".join(out)


# ------------------------------- part-based ---------------------------------
def _part_env():
    n = F.col("p_size").cast("string")
    m = (F.col("p_size") + F.col("p_partkey") % 30).cast("string")
    first = F.split(F.col("p_name"), " ").getItem(0)
    last = F.split(F.col("p_name"), " ").getItem(1)
    cap = lambda c: F.concat(F.upper(F.substring(c, 1, 1)), F.lower(F.substr(c, F.lit(2))))  # noqa
    return {"n": n, "m": m, "f": first, "l": last, "F": F.upper(first), "L": F.upper(last),
            "fc": cap(first), "lc": cap(last)}


PART_ENV_SQL = {
    "n": "CAST(p_size AS VARCHAR)",
    "m": "CAST(p_size + p_partkey % 30 AS VARCHAR)",
    "f": "split_part(p_name, ' ', 1)",
    "l": "split_part(p_name, ' ', 2)",
    "F": "upper(split_part(p_name, ' ', 1))",
    "L": "upper(split_part(p_name, ' ', 2))",
    "fc": "(upper(left(split_part(p_name, ' ', 1), 1)) || lower(substr(split_part(p_name, ' ', 1), 2)))",
    "lc": "(upper(left(split_part(p_name, ' ', 2), 1)) || lower(substr(split_part(p_name, ' ', 2), 2)))",
}


def age_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """id, header_col_value (age text), header_col_name (header it came from)."""
    return age_text_of(spread_for_cpu(read_table(spark, sf_dir, "part").select("p_partkey", "p_size")))


def age_text_of(part: DataFrame) -> DataFrame:
    """The same of a table or stream of parts."""
    env = _part_env()
    return part.select(
        F.col("p_partkey").alias("id"),
        template_column(AGE_TEMPLATES, F.col("p_partkey"), env).alias("header_col_value"),
        template_column(AGE_HEADERS, F.floor(F.col("p_partkey") / 7), env).alias("header_col_name"),
    )


def age_text_sql() -> str:
    return (
        "SELECT p_partkey AS id, "
        f"{template_sql(AGE_TEMPLATES, 'p_partkey', PART_ENV_SQL)} AS header_col_value, "
        f"{template_sql(AGE_HEADERS, 'p_partkey // 7', PART_ENV_SQL)} AS header_col_name "
        "FROM part"
    )


def age_two_col(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = spread_for_cpu(read_table(spark, sf_dir, "part").select("p_partkey", "p_size"))
    env = _part_env()
    return part.select(
        "p_partkey",
        template_column(TWO_COL_MIN, F.col("p_partkey"), env).alias("Accepts Minimum Patient Age"),
        template_column(TWO_COL_MAX, F.floor(F.col("p_partkey") / 3), env).alias("Accepts Maximum Patient Age"),
        template_column(TWO_COL_AGE, F.floor(F.col("p_partkey") / 11), env).alias("Age Group"),
    )


def age_two_col_sql() -> str:
    return (
        "SELECT p_partkey, "
        f"{template_sql(TWO_COL_MIN, 'p_partkey', PART_ENV_SQL)} AS \"Accepts Minimum Patient Age\", "
        f"{template_sql(TWO_COL_MAX, 'p_partkey // 3', PART_ENV_SQL)} AS \"Accepts Maximum Patient Age\", "
        f"{template_sql(TWO_COL_AGE, 'p_partkey // 11', PART_ENV_SQL)} AS \"Age Group\" "
        "FROM part"
    )


def provider_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """id, header_col_value (provider name text), file_name."""
    return provider_text_of(spread_for_cpu(read_table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_size")))


def provider_text_of(part: DataFrame) -> DataFrame:
    """The same of a table or stream of parts."""
    env = _part_env()
    fname = F.when(F.col("p_partkey") % 5 == 0, F.lit(ROSTER_FILE)).otherwise(
        F.concat(F.lit("roster_"), (F.col("p_partkey") % 7).cast("string"), F.lit(".xlsx")))
    return part.select(
        F.col("p_partkey").alias("id"),
        template_column(NAME_TEMPLATES, F.col("p_partkey"), env).alias("header_col_value"),
        fname.alias("file_name"),
    )


def provider_text_sql() -> str:
    return (
        "SELECT p_partkey AS id, "
        f"{template_sql(NAME_TEMPLATES, 'p_partkey', PART_ENV_SQL)} AS header_col_value, "
        f"CASE WHEN p_partkey % 5 = 0 THEN {_sql_lit(ROSTER_FILE)} "
        "ELSE 'roster_' || CAST(p_partkey % 7 AS VARCHAR) || '.xlsx' END AS file_name "
        "FROM part"
    )


def spec_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """id, header_col_value: names of people and organizations, mixed."""
    part = spread_for_cpu(read_table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_size"))
    return part.select(F.col("p_partkey").alias("id"),
                       template_column(SPEC_TEMPLATES, F.col("p_partkey"), _part_env()).alias("header_col_value"))


def spec_text_sql() -> str:
    return f"SELECT p_partkey AS id, {template_sql(SPEC_TEMPLATES, 'p_partkey', PART_ENV_SQL)} AS header_col_value FROM part"


def token_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """token, kind, canonical: a user's dictionary that grows with ``part``: first words of names as organization keywords or,
    in capitals, as designations, beside a few fixed rows."""
    word = F.split(F.col("p_name"), " ").getItem(0)
    words = read_table(spark, sf_dir, "part").groupBy(word.alias("w")).agg(F.min("p_partkey").alias("k"))
    made = words.filter("k % 3 <> 2").select(
        F.col("w").alias("token"), F.when(F.col("k") % 3 == 0, "organization").otherwise("Designation ").alias("kind"),
        F.when(F.col("k") % 3 == 1, F.upper("w")).alias("canonical"))
    fixed = spark.createDataFrame(TOKEN_ROWS, "token string, kind string, canonical string")
    return made.unionByName(fixed)


TOKEN_ROWS = [("MD", "designation", None), ("M.D.", "designation", "MD"), ("ph.d", "designation", "PhD"), ("RN", "designation", None),
              ("Hospital", "organization", None), ("Dr", "title", None), ("Dr", "designation", None), ("", "designation", "x")]


def token_table_sql() -> str:
    rows = ", ".join("(" + ", ".join("NULL" if x is None else _sql_lit(x) for x in row) + ")" for row in TOKEN_ROWS)
    return f"""SELECT w AS token, CASE WHEN k % 3 = 0 THEN 'organization' ELSE 'designation' END AS kind,
                      CASE WHEN k % 3 = 1 THEN upper(w) END AS canonical
               FROM (SELECT split_part(p_name, ' ', 1) AS w, min(p_partkey) AS k FROM part GROUP BY 1) WHERE k % 3 <> 2
               UNION ALL SELECT * FROM (VALUES {rows}) AS fixed(token, kind, canonical)"""


# ------------------------------ roster cells --------------------------------
# Value kinds -> (Spark column over customer c + nation n, DuckDB SQL).
def _cust_values():
    """kind -> (Spark column factory, DuckDB SQL)."""
    return {k: (lambda e=e: e(), sql) for k, (e, sql) in _CUST_VALUE_SPECS.items()}


def _k():
    return F.col("c_custkey")


_CUST_VALUE_SPECS = {
    "name": (lambda: F.col("c_name"), "c_name"),
    "last": (lambda: F.concat(F.lit("Doe"), (_k() % 13).cast("string")), "'Doe' || CAST(c_custkey % 13 AS VARCHAR)"),
    "first": (lambda: F.concat(F.lit("Ann"), (_k() % 11).cast("string")), "'Ann' || CAST(c_custkey % 11 AS VARCHAR)"),
    "degree": (lambda: F.when(_k() % 4 == 0, "MD").when(_k() % 4 == 1, "DO").when(_k() % 4 == 2, "NP"),
               "CASE c_custkey % 4 WHEN 0 THEN 'MD' WHEN 1 THEN 'DO' WHEN 2 THEN 'NP' END"),
    "specialty": (lambda: F.when(F.col("c_mktsegment") == "AUTOMOBILE", "Cardiology")
                  .when(F.col("c_mktsegment") == "BUILDING", "Internal Medicine and Pediatrics Care")
                  .when(F.col("c_mktsegment") == "FURNITURE", "Family Practice")
                  .when(F.col("c_mktsegment") == "HOUSEHOLD", "nan")
                  .otherwise("  Oncology "),
                  "CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'Cardiology' "
                  "WHEN 'BUILDING' THEN 'Internal Medicine and Pediatrics Care' "
                  "WHEN 'FURNITURE' THEN 'Family Practice' WHEN 'HOUSEHOLD' THEN 'nan' "
                  "ELSE '  Oncology ' END"),
    "taxonomy": (lambda: F.concat(F.lit("207R"), (F.col("c_nationkey") % 3).cast("string")),
                 "'207R' || CAST(c_nationkey % 3 AS VARCHAR)"),
    "taxid": (lambda: (_k() % 50).cast("string"), "CAST(c_custkey % 50 AS VARCHAR)"),
    "phone": (lambda: F.concat(F.lit("555-"), (_k() % 1000).cast("string")), "'555-' || CAST(c_custkey % 1000 AS VARCHAR)"),
    "email": (lambda: F.concat(F.lit("p"), (_k() % 100).cast("string"), F.lit("@example.org")),
              "'p' || CAST(c_custkey % 100 AS VARCHAR) || '@example.org'"),
    "pcp": (lambda: F.when(_k() % 2 == 0, "Y").otherwise("N"), "CASE WHEN c_custkey % 2 = 0 THEN 'Y' ELSE 'N' END"),
    "role": (lambda: F.when(_k() % 3 == 0, "PCP").when(_k() % 3 == 1, "Specialist")
             .otherwise("Primary care physician group lead"),
             "CASE c_custkey % 3 WHEN 0 THEN 'PCP' WHEN 1 THEN 'Specialist' "
             "ELSE 'Primary care physician group lead' END"),
    "board": (lambda: F.when(F.col("c_acctbal") > 5000, "Yes").otherwise("No"),
              "CASE WHEN c_acctbal > 5000 THEN 'Yes' ELSE 'No' END"),
    "license": (lambda: F.concat(F.lit("L"), (_k() % 20).cast("string")), "'L' || CAST(c_custkey % 20 AS VARCHAR)"),
    "dob": (lambda: F.concat(F.lit("19"), (50 + _k() % 40).cast("string")), "'19' || CAST(50 + c_custkey % 40 AS VARCHAR)"),
    "fax": (lambda: F.lit(None).cast("string"), "CAST(NULL AS VARCHAR)"),
}


# A workbook "providers_<number>.xlsx" for every WORKBOOK_CUSTOMERS customer keys, so that
# workbooks and headers grow with the table, each with one sheet per region laid out as below:
# region key -> (header row index, [(header text, value kind)]).
WORKBOOK_CUSTOMERS = 500
ROSTER_SHEETS = {
    0: (1, [("Provider Name", "name"), ("Degree", "degree"), ("Primary Specialty", "specialty"),
            ("Tax ID", "taxid"), ("Phone Number", "phone")]),
    1: (2, [("Degree", "degree"), ("Taxonomy Code", "taxonomy"), ("PCP", "pcp"),
            ("Email Address", "email"), ("Secondary Specialty", "specialty")]),
    2: (1, [("Last Name", "last"), ("First Name", "first"), ("Credentials", "degree"),
            ("Specialty", "specialty"), ("Fax", "fax")]),
    3: (2, [("Provider Name", "name"), ("Degree", "degree"), ("Degree", "pcp"), ("", "taxid"),
            ("Board Certified", "board")]),
    4: (1, [("DEGREE_EARNED.TRAINING_PROG_DEGREE", "degree"), ("Role", "role"),
            ("Specialty Taxonomy Code Primary", "taxonomy"), ("License #", "license"), ("DOB", "dob")]),
}
ROSTER_DATA_ROW0 = 20   # data row of customer k sits at row 20 + k


def _workbook() -> Column:
    number = F.floor(F.col("c_custkey") / WORKBOOK_CUSTOMERS).cast("string")
    return F.concat(F.lit("providers_"), number, F.lit(".xlsx"))


WORKBOOK_SQL = f"'providers_' || CAST(c_custkey // {WORKBOOK_CUSTOMERS} AS VARCHAR) || '.xlsx'"


def roster_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """raw_cells of a workbook per WORKBOOK_CUSTOMERS customers: one sheet per region, one data row per customer.

    A workbook has the headers of all regions; sheets without a customer are header-only."""
    region = read_table(spark, sf_dir, "region")
    nation = read_table(spark, sf_dir, "nation")
    cust = read_table(spark, sf_dir, "customer")
    vals = _cust_values()
    ncols = max(len(cols) for _, cols in ROSTER_SHEETS.values())
    rk = F.col("n_regionkey")
    cells = []
    for j in range(ncols):
        expr = None
        for r, (_, cols) in ROSTER_SHEETS.items():
            if j < len(cols):
                v = vals[cols[j][1]][0]()
                expr = F.when(rk == r, v) if expr is None else expr.when(rk == r, v)
        cells.append(F.struct(F.lit(j).alias("col_idx"), expr.alias("value")))
    data = (cust.join(nation.select("n_nationkey", "n_regionkey"), F.col("c_nationkey") == F.col("n_nationkey"))
            .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
            .select(_workbook().alias("workbook"),
                    F.col("r_name").alias("sheet"), F.col("r_regionkey").alias("sheet_idx"),
                    (F.lit(ROSTER_DATA_ROW0) + F.col("c_custkey")).alias("row_idx"),
                    F.explode(F.array(*cells)).alias("c"))
            .select("workbook", "sheet", "sheet_idx", "row_idx", "c.col_idx", "c.value"))
    # title, note and header rows per sheet (derived from the region table)
    top = []
    for r, (hrow, cols) in ROSTER_SHEETS.items():
        top.append((r, 0, 0, "Roster as of 2023"))
        if hrow == 2:
            top += [(r, 1, 0, "Confidential"), (r, 1, 1, "Internal use")]
        top += [(r, hrow, j, h) for j, (h, _) in enumerate(cols)]
    lines = [F.struct(F.lit(r).alias("rk"), F.lit(i).alias("row_idx"), F.lit(j).alias("col_idx"), F.lit(v).alias("value")) for r, i, j, v in top]
    heads = (cust.select(_workbook().alias("workbook")).distinct().select("workbook", F.explode(F.array(*lines)).alias("t"))
             .select("workbook", "t.*").join(region, F.col("r_regionkey") == F.col("rk"))
             .select("workbook", F.col("r_name").alias("sheet"), F.col("r_regionkey").alias("sheet_idx"), "row_idx", "col_idx", "value"))
    allc = heads.unionByName(data).filter(F.col("value").isNotNull())
    return allc.select("workbook", "sheet",
                       F.col("sheet_idx").cast("int").alias("sheet_idx"),
                       F.col("row_idx").cast("int").alias("row_idx"),
                       F.col("col_idx").cast("int").alias("col_idx"), "value")


EMPTY_SHEET, EMPTY_SHEET_IDX, EMPTY_HEADERS = "PLANNED", 9, ["Degree", "Specialty", "Fax Number"]


def header_only_sheets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A sheet more for every workbook, with headers and no data row."""
    books = read_table(spark, sf_dir, "customer").select(_workbook().alias("workbook")).distinct()
    return books.select("workbook", F.lit(EMPTY_SHEET).alias("sheet"), F.lit(EMPTY_SHEET_IDX).alias("sheet_idx"), F.lit(0).alias("row_idx"),
                        F.posexplode(F.array(*map(F.lit, EMPTY_HEADERS))).alias("col_idx", "value"))


def header_only_sheets_sql() -> str:
    values = ", ".join(f"({k}, {_sql_lit(v)})" for k, v in enumerate(EMPTY_HEADERS))
    return f"""SELECT workbook, '{EMPTY_SHEET}' AS sheet, {EMPTY_SHEET_IDX} AS sheet_idx, 0 AS row_idx, h.col_idx, h.value
               FROM (SELECT DISTINCT {WORKBOOK_SQL} AS workbook FROM customer), (VALUES {values}) AS h(col_idx, value)"""


def roster_cells_sql() -> str:
    vals = _cust_values()
    ncols = max(len(cols) for _, cols in ROSTER_SHEETS.values())
    parts = []
    for j in range(ncols):
        whens = " ".join(f"WHEN {r} THEN {vals[cols[j][1]][1]}" for r, (_, cols) in ROSTER_SHEETS.items()
                         if j < len(cols))
        parts.append(f"SELECT {WORKBOOK_SQL} AS workbook, "
                     f"r_name AS sheet, r_regionkey AS sheet_idx, {ROSTER_DATA_ROW0} + c_custkey AS row_idx, "
                     f"{j} AS col_idx, CASE n_regionkey {whens} END AS value FROM cr")
    top = []
    for r, (hrow, cols) in ROSTER_SHEETS.items():
        top.append((r, 0, 0, "Roster as of 2023"))
        if hrow == 2:
            top += [(r, 1, 0, "Confidential"), (r, 1, 1, "Internal use")]
        top += [(r, hrow, j, h) for j, (h, _) in enumerate(cols)]
    top_vals = ", ".join(f"({r}, {ri}, {ci}, {_sql_lit(v)})" for r, ri, ci, v in top)
    return f"""
SELECT workbook, sheet, CAST(sheet_idx AS INTEGER) AS sheet_idx,
       CAST(row_idx AS INTEGER) AS row_idx, CAST(col_idx AS INTEGER) AS col_idx, value
FROM (
  WITH cr AS (SELECT c.*, n.n_regionkey, r.r_name, r.r_regionkey FROM customer c
              JOIN nation n ON c.c_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey)
  {' UNION ALL '.join(parts)}
  UNION ALL
  SELECT w.workbook, r.r_name, r.r_regionkey, t.ri, t.ci, t.v
  FROM (SELECT DISTINCT {WORKBOOK_SQL} AS workbook FROM customer) w, region r
  JOIN (VALUES {top_vals}) AS t(rk, ri, ci, v) ON r.r_regionkey = t.rk
) WHERE value IS NOT NULL
"""


# --------------------------------- paths -------------------------------------
PATH_ROOTS = ["/home/airflow/gcs/", "/srv/x/dags/", "/mnt/gcs/", "/opt/"]


def page_objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """page_id, object name (URL without scheme), local path under one of four roots."""
    pages = spread_for_cpu(read_table(spark, sf_dir, "pages").select("page_id", "url"))
    obj = F.regexp_replace(F.col("url"), r"^[a-z]+://", "")
    root = template_column(PATH_ROOTS, F.col("page_id"), {})
    return pages.select("page_id", obj.alias("object"), F.concat(root, obj).alias("path"))


def page_objects_sql() -> str:
    root = template_sql(PATH_ROOTS, "page_id", {})
    return ("SELECT page_id, regexp_replace(url, '^[a-z]+://', '') AS object, "
            f"({root}) || regexp_replace(url, '^[a-z]+://', '') AS path FROM pages")
