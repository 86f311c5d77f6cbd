"""DuckDB oracle SQL for the age queries.

Written from the rule descriptions (SURVEY §2.8), independently of the Spark
expressions: DuckDB's regex engine is RE2 (no look-ahead), so a few rules are
re-stated in a form RE2 accepts.  Each profile is one CASE chain per output.
"""
from __future__ import annotations

from . import inputs

NUM = r"(\d+(?:\.\d+)?)"

# Optional replacement of the input CTEs (tests point the same rules at other tables).
SOURCES: dict[str, str] = {}


def source(name: str, default) -> str:
    return SOURCES.get(name) or default()


def q(p: str) -> str:
    """SQL string literal."""
    return "'" + p.replace("'", "''") + "'"


def has(x: str, p: str) -> str:
    return f"coalesce(regexp_matches({x}, {q(p)}), false)"


def grab(x: str, p: str, g: int = 1) -> str:
    return f"TRY_CAST(NULLIF(regexp_extract({x}, {q(p)}, {g}), '') AS DOUBLE)"


def nums(x: str, p: str = r"\d+(?:\.\d+)?") -> str:
    return f"list_transform(regexp_extract_all(coalesce({x}, ''), {q(p)}), lambda z: TRY_CAST(z AS DOUBLE))"


def strip(x: str) -> str:
    return rf"regexp_replace({x}, '^\s+|\s+$', '', 'g')"


def sub(x: str, needle: str) -> str:
    return f"contains({x}, {q(needle)})"


def py_round_sql(x: str, nd: int) -> str:
    """Python round(x, nd) on doubles: half-even on the exact binary value, via the
    error-free product x * 10**nd (Veltkamp split); x must be a plain column."""
    f = float(10 ** nd)
    split = 134217729.0
    c = split * f
    bh = c - (c - f)
    bl = f - bh
    p = f"({x} * {f!r})"
    ah = f"(({x} * {split!r}) - (({x} * {split!r}) - {x}))"
    al = f"({x} - {ah})"
    err = f"((({ah} * {bh!r} - {p}) + {ah} * {bl!r} + {al} * {bh!r}) + {al} * {bl!r})"
    fl = f"floor({p})"
    k = (f"CASE WHEN {p} - {fl} = 0.5 THEN (CASE WHEN {err} > 0 THEN {fl} + 1 WHEN {err} < 0 THEN {fl} "
         f"WHEN {fl} % 2 = 0 THEN {fl} ELSE {fl} + 1 END) ELSE round_even({p}, 0) END")
    return f"(({k}) / {f!r})"


def case(rules, idx: int, default: str = "NULL") -> str:
    body = " ".join(f"WHEN {r[0]} THEN {r[idx]}" for r in rules)
    return f"CASE {body} ELSE {default} END"


# ------------------------------- label_map ---------------------------------
_A1_LABELS = [
    ("adult", 18, 150), ("adults", 18, 150), ("adult only", 18, 150), ("adolescents", 10, 21),
    ("adolescent", 10, 21), ("adolescents to adult", 10, 21), ("pediatric", 0, 18),
    ("pediatrics", 0, 18), ("children", 0, 12), ("child", 0, 12), ("adolescent & adult", 6, 21),
    ("pediatric and adult", 0, 21), ("pediatric/adult", 0, 21), ("pediatric only", 0, 17),
    ("children only", 0, 17), ("neonatal", 0, 0.25), ("infants", 0, 1), ("birth to 18", 0, 18),
    ("birth to 21", 0, 21), ("no pediatric patients", 18, 150), ("preferred 18 and over", 18, 150),
    ("female specialist", 0, 18), ("females only", None, None), ("permanent females", None, None),
    ("infectious pts only 18-99", 18, 99),
]


def _vals(rows):
    def lit(x):
        if x is None:
            return "CAST(NULL AS DOUBLE)"
        if isinstance(x, str):
            return q(x)
        return f"CAST({x} AS DOUBLE)"
    return ", ".join("(" + ", ".join(lit(x) for x in r) + ")" for r in rows)


def age_label_map() -> str:
    s = "s"
    rng = r"(\d+)\s*(?:to|-|–|—)\s*(\d+)"
    up = r"(\d+)\s*(?:\+|and up|older|over|above)"
    yng = r"(\d+)\s*(?:and under|and younger)"
    rules = [
        ("v IS NULL OR v = ''", "NULL", "NULL"),
        ("label IS NOT NULL", "lo", "hi"),
        (has(s, rng), grab(s, rng, 1), f"least({grab(s, rng, 2)}, 150.0)"),
        (has(s, up), grab(s, up), "150.0"),
        (has(s, yng), "0.0", f"least({grab(s, yng)}, 150.0)"),
        (has(s, r"^(\d+)\s*(?:yrs?|years?)"), grab(s, r"^(\d+)"), grab(s, r"^(\d+)")),
        (has(s, r"^(\d+)\s*months?"), "0.0", f"{grab(s, r'^(\d+)')} / 12.0"),
        (has(s, r"^(\d+)\s*days?"), "0.0", f"{grab(s, r'^(\d+)')} / 365.0"),
        (has(s, r"^\d+$"), f"TRY_CAST({s} AS DOUBLE)", f"TRY_CAST({s} AS DOUBLE)"),
        (f"({sub(s, 'no restriction')} OR {sub(s, 'no age restriction')})", "0.0", "150.0"),
        ("len(ns) = 1", "0.0", "least(ns[1], 150.0)"),
        ("len(ns) >= 2", "least(ns[1], ns[2])", "least(greatest(ns[1], ns[2]), 150.0)"),
    ]
    return f"""
WITH src AS ({source('age_text', inputs.age_text_sql)}),
a AS (SELECT *, header_col_value AS v,
        regexp_replace(replace(replace(lower({strip('header_col_value')}), '&', 'and'), '–', '-'),
                       '\\s+', ' ', 'g') AS s FROM src),
b AS (SELECT a.*, lab.label, lab.lo, lab.hi, {nums('s', r'\d+')} AS ns
      FROM a LEFT JOIN (VALUES {_vals(_A1_LABELS)}) AS lab(label, lo, hi) ON lab.label = a.s)
SELECT id, header_col_value,
       CAST({case(rules, 1)} AS DOUBLE) AS "min_Age",
       CAST({case(rules, 2)} AS DOUBLE) AS "max_Age",
       header_col_name
FROM b
"""


# ------------------------------ phrase profiles -----------------------------
def _lexicon(t: str):
    adult_no_to = has(f"regexp_replace({t}, '(?i)\\badults?\\b\\s*to', '#', 'g')", r"(?i)\badults?\b")
    return [
        (has(t, r"(?i)\b(newborn|neonate|neonatal)\b"), "0.0", "0.08", "'lex_newborn'"),
        (has(t, r"(?i)\badult\s*only\b"), "18.0", "150.0", "'lex_adult_only'"),
        (adult_no_to, "18.0", "150.0", "'lex_adult'"),
        (has(t, r"(?i)\badolescents?\s*to\s*adult(s)?\b"), "10.0", "150.0", "'lex_adol'"),
    ]


def _phrase_sql(profile: str) -> str:
    t, tl, tln = "t", "tl", "tln"
    strict = r"^\s*" + NUM + r"\s*[\+\*]+\s*$"
    inline = NUM + r"\s*[\+\*]+"
    rng = NUM + r"\s*[-~]\s*" + NUM
    maxonly = (f"({has(tln, r'(under|below|less than|up to)\s*' + NUM)} OR "
               f"{has(tln, NUM + r'\s*(and younger|younger)')})")
    tail = [
        (f"({has(tln, rng)})", f"least({grab(tln, rng, 1)}, {grab(tln, rng, 2)})",
         f"greatest({grab(tln, rng, 1)}, {grab(tln, rng, 2)})", "'range'"),
        (maxonly, "0.0", "nt[-1]", "'max_only'"),
        ("len(nt) = 1", "NULL", "NULL", "'single_ambiguous'"),
    ]
    if profile == "phrase":
        t1 = rf"regexp_replace({t}, '\s+', ' ', 'g')"
        fz1 = r"(?i)^\s*" + NUM + r"\s+(a\w*d)\s+(u\w*p)\b"
        fz2 = r"(?i)^\s*" + NUM + r"\s+a\s*n\s*d\s+u\s+p\b"
        older = NUM + r"\s*(?:\+|\*|(?:and|&)\s*older|(?:and\s+above)|above|over)\b"
        months = r"(?i)" + NUM + r"\s*(?:month|months)\b"
        my = f"({grab(t, months)} / 12.0)"
        plus_words = " OR ".join(sub(tln, w) for w in ["and older", "older", "+", "& older"])
        max_words = " OR ".join(sub(tln, w) for w in ["and younger", "younger", "under", "below",
                                                        "less than", "up to"])
        body = [
            (has(t, strict), grab(t, strict), "150.0", "'plus'"),
            (has(t, inline), grab(t, inline), "150.0", "'plus_inline'"),
            (f"({has(t1, fz1)} OR {has(t1, fz2)})", f"coalesce({grab(t1, fz1)}, {grab(t1, fz2)})",
             "150.0", "'and_up'"),
            (f"({sub(tln, 'none')} OR {sub(tln, 'no restriction')} OR {sub(tln, 'all ages')})",
             "0.0", "150.0", "'no_restriction'"),
            (has(tln, older), grab(tln, NUM), "150.0", "'older'"),
            (f"({has(t, months)} AND ({plus_words}))", my, "150.0", "'months_plus'"),
            (f"({has(t, months)} AND ({max_words}))", "0.0", my, "'months_max'"),
            (has(t, months), my, "150.0", "'months_as_min'"),
        ]
    else:
        rng_plus = NUM + r"\s*[-~]\s*" + NUM + r"\s*[\+\*]\b"
        words = r"(?:\+|\*|(?:and|&|or)\s*(?:up|over|older|above)|up|over|older|above)"
        up1 = r"(?i)" + NUM + r"\s*(?:[a-z/]+\s*){0,3}?" + words + r"\b"
        coll = f"regexp_replace({tl}, '[^a-z0-9+*]', '', 'g')"
        up2 = r"(?i)^" + NUM + r"((years?|yrs?|yr|yo|y/o)?)and(?:up|over|older|above)\b"
        up3 = r"(?i)" + NUM + r"\s*a\s*n\s*d\s+u\s*p\b"
        months = r"(?i)" + NUM + r"\s*(?:month|months|mon|mons|mo|mos|mth|mths|m)\b"
        my = f"({grab(t, months)} / 12.0)"
        body = [
            (has(tln, rng_plus), f"least({grab(tln, rng_plus, 1)}, {grab(tln, rng_plus, 2)})", "150.0",
             "'range_plus'"),
            (has(t, strict), grab(t, strict), "150.0", "'plus'"),
            (has(t, inline), grab(t, inline), "150.0", "'plus_inline'"),
            (f"({has(tl, up1)} OR {has(coll, up2)} OR {has(tl, up3)})",
             f"coalesce({grab(tl, up1)}, {grab(coll, up2)}, {grab(tl, up3)})", "150.0", "'up_over'"),
            (f"({has(t, months)} AND {has(tl, '(?i)' + words + r'\b')})", my, "150.0", "'months_up'"),
            (f"({has(t, months)} AND {has(tl, r'(?i)(and\s+younger|younger|under|below|less than|up to)\b')})",
             "0.0", my, "'months_max'"),
            (has(t, months), my, "150.0", "'months_as_min'"),
        ]
    rules = [("v IS NULL", "NULL", "NULL", "'empty'")] + _lexicon(t) + body + tail
    hl = "lower(coalesce(h, ''))"
    hints = [" min", "min ", "(min", ">=", "lower bound"] + ["minimum"] * (profile != "phrase_hdr")
    min_sub = " OR ".join([sub(hl, k) for k in hints]
                          + [f"ends_with({hl}, ' min')", f"starts_with({hl}, 'min')"])
    if profile == "phrase_hdr":
        min_sub = f"{has(hl, r'\b(min|minimum|from)\b')} OR {min_sub}"
    max_sub = " OR ".join([sub(hl, k) for k in [" max", "maximum", "max ", "(max", "<=", "upper bound"]]
                          + [f"ends_with({hl}, ' max')", f"starts_with({hl}, 'max')"])
    if profile == "phrase_hdr":
        step2 = """,
s2 AS (SELECT *,
         (is_min AND fnum IS NOT NULL AND r1 IN ('single_ambiguous', 'max_only', 'unparsed')) AS forced
       FROM s1),
s3 AS (SELECT *,
         CASE WHEN forced THEN fnum ELSE mn1 END AS mn2,
         CASE WHEN forced THEN 150.0 ELSE mx1 END AS mx2 FROM s2),
s4 AS (SELECT *,
         CASE WHEN is_min AND fnum IS NOT NULL AND mn2 IS NULL THEN fnum ELSE mn2 END AS mn3,
         CASE WHEN is_min AND fnum IS NOT NULL AND mx2 IS NULL AND cnt = 1 THEN 150.0 ELSE mx2 END AS mx3
       FROM s3)"""
    else:
        step2 = """,
s4 AS (SELECT *, CASE WHEN is_min AND mn1 IS NULL THEN fnum ELSE mn1 END AS mn3, mx1 AS mx3 FROM s1)"""
    return f"""
WITH src AS ({source('age_text', inputs.age_text_sql)}),
a AS (SELECT *, header_col_value AS v, header_col_name AS h,
             {strip('header_col_value')} AS t FROM src),
b AS (SELECT *, lower(t) AS tl,
             replace(replace(replace(lower(t), '—', '-'), '–', '-'), ' to ', '-') AS tln FROM a),
c AS (SELECT *, {nums('tln')} AS nt,
             len(regexp_extract_all(coalesce(v, ''), '\\d+(?:\\.\\d+)?')) AS cnt,
             {grab("coalesce(v, '')", NUM)} AS fnum,
             ({min_sub}) AS is_min, ({max_sub}) AS is_max FROM b),
p AS (SELECT *, {case(rules, 1)} AS mn0, {case(rules, 2)} AS mx0,
             {case(rules, 3, "'unparsed'")} AS r0 FROM c),
s1 AS (SELECT *,
         CASE WHEN r0 = 'single_ambiguous' AND cnt = 1 AND NOT is_min THEN 0.0 ELSE mn0 END AS mn1,
         CASE WHEN r0 = 'single_ambiguous' AND cnt = 1 AND NOT is_min THEN fnum ELSE mx0 END AS mx1,
         CASE WHEN r0 = 'single_ambiguous' AND cnt = 1 AND NOT is_min THEN 'assumed' ELSE r0 END AS r1
       FROM p){step2},
s5 AS (SELECT *, CAST(coalesce(mn3, 0.0) AS DOUBLE) AS mn_f,
              CAST(coalesce(CASE WHEN is_max AND mx3 IS NULL THEN fnum ELSE mx3 END, 150.0) AS DOUBLE) AS mx_f
       FROM s4)
SELECT id, header_col_value, header_col_name,
       {py_round_sql('mn_f', 2)} AS min_age, {py_round_sql('mx_f', 2)} AS max_age
FROM s5
"""


def age_phrase() -> str:
    return _phrase_sql("phrase")


def age_phrase_hdr() -> str:
    return _phrase_sql("phrase_hdr")


# ---------------------------------- band ------------------------------------
_A4_LABELS = [("adult", 18, 150), ("adults", 18, 150), ("pediatric", 0, 17), ("children", 0, 17),
              ("child", 0, 17), ("members", 0, 150), ("no age restriction", 0, 150),
              ("no age restrictions", 0, 150), ("none", 0, 150)]
_A4_HEADERS = [
    ("age", "min"), ("ages", "min"), ("age restrictions", "min"), ("age range from", "min"),
    ("age ranges", "min"), ("age ranges (0-99)", "min"), ("minimum age", "min"), ("min age", "min"),
    ("max age", "max"), ("maximum age", "max"), ("maximum patient age", "max"),
    ("patient min age", "min"), ("patient max age", "max"),
    ("practice limitations: min age", "min"), ("practice limitations: max age", "max"),
    ("age restrictions (required for all providers)", "min"),
    ("address/service location age restrictions (ex: none, 18 & younger, 19& older) [no blanks]", "min"),
    ("address/service location age restrictions (ex: none, 18 & younger, 19 & older) [no blanks]", "min"),
    ("accepts minimum patient age", "min"),
]


def age_band() -> str:
    s = "s"
    months = r"^\s*" + NUM + r"\s*(month|months)\s*(?:and\s*older|and\s*up)?\s*$"
    and_up = r"^\s*" + NUM + r"[\s\+&]*(\+|and\s*up|and\s*older|or\s*older|&\s*older)\s*$"
    under = r"^\s*(under|less\s*than)\s*" + NUM + r"\s*$"
    younger = r"^\s*" + NUM + r"[\s]*(?:&|and)?\s*younger\s*$"
    rng = r"^\s*" + NUM + r"[\s]*(?:-|–|to)[\s]*" + NUM + r"\s*$"
    only = r"^\s*" + NUM + r"\s*$"
    rules = [("v IS NULL OR s = ''", "NULL", "NULL")]
    rules += [(sub(s, k), f"{lo}.0", f"{hi}.0") for k, lo, hi in _A4_LABELS]
    rules += [
        (has(s, months), "0.0", f"greatest(0.0, {grab(s, months)} / 12.0)"),
        (has(s, and_up), grab(s, and_up), "150.0"),
        (has(s, under), "0.0", f"{grab(s, under, 2)} - 1"),
        (has(s, younger), "0.0", grab(s, younger)),
        (has(s, rng), f"least({grab(s, rng, 1)}, {grab(s, rng, 2)})",
         f"greatest({grab(s, rng, 1)}, {grab(s, rng, 2)})"),
        (has(s, only), grab(s, only), "150.0"),
        ("len(ns) >= 2", "least(ns[1], ns[2])", "greatest(ns[1], ns[2])"),
        ("len(ns) = 1", "ns[1]", "150.0"),
    ]
    hdr_vals = ", ".join(f"({q(k)}, {q('Min_age' if v == 'min' else 'Max_age')})" for k, v in _A4_HEADERS)
    return f"""
WITH src AS ({source('age_text', inputs.age_text_sql)}),
a AS (SELECT id, header_col_value, header_col_name AS "header_colName", header_col_value AS v,
             lower({strip('header_col_value')}) AS s FROM src),
b AS (SELECT *, {nums('s')} AS ns,
             lower(regexp_replace({strip('coalesce("header_colName", \'None\')')}, '\\s+', ' ', 'g')) AS hk
      FROM a)
SELECT id, header_col_value, "header_colName",
       CAST({case(rules, 1)} AS DOUBLE) AS "Min_age",
       CAST({case(rules, 2)} AS DOUBLE) AS "Max_age",
       coalesce(hm.col, '') AS "sub-category"
FROM b LEFT JOIN (VALUES {hdr_vals}) AS hm(k, col) ON hm.k = b.hk
"""


# -------------------------------- simple120 ---------------------------------
def age_simple120() -> str:
    s = "sl"
    rng = r"(\d{1,3})\s*[-–]\s*(\d{1,3})"
    one = "len(ns) = 1"
    rules = [
        ("v IS NULL OR t = ''", "0", "0"),
        (f"{s} IN ('none', 'no', 'unknown', 'n/a')", "0", "0"),
        (sub(s, "birth"), "0", "0"),
        (f"NOT {has(s, r'\d')}", "0", "0"),
        (has(s, rng), f"greatest(0, {grab(s, rng, 1)})", f"least({grab(s, rng, 2)}, 120)"),
        (f"{one} AND ({sub(s, '+')} OR ends_with({s}, 'plus'))", "ns[1]", "120"),
        (f"{one} AND {sub(s, 'older')}", "ns[1]", "120"),
        (f"{one} AND {sub(s, 'younger')}", "0", "ns[1]"),
        (one, "0", "least(ns[1], 120)"),
        ("ns[1] > ns[2] AND ns[2] = 0", "0", "least(ns[1], 120)"),
        ("len(ns) >= 2", "greatest(0, least(ns[1], ns[2]))", "least(greatest(ns[1], ns[2]), 120)"),
    ]
    return f"""
WITH src AS ({source('age_text', inputs.age_text_sql)}),
a AS (SELECT *, header_col_value AS v, {strip('header_col_value')} AS t FROM src),
b AS (SELECT *, lower(t) AS sl, {nums('lower(t)', r'\d{1,3}')} AS ns FROM a)
SELECT id, header_col_value, header_col_name,
       CAST({case(rules, 1, '0')} AS INTEGER) AS "Min_Age",
       CAST({case(rules, 2, '0')} AS INTEGER) AS "Max_Age"
FROM b
"""


# --------------------------------- two_col ----------------------------------
_A5_SYN = [
    (r"\bnewborns?\b", 0, 0), (r"\binfants?\b", 0, 1), (r"\btoddlers?\b", 1, 3),
    (r"\bchildren\b|\bkids?\b", 0, 12), (r"\bteens?\b|\bteenagers?\b", 13, 19),
    (r"\byoung adults?\b", 18, 24), (r"\badults?\b|\badult only\b|\badults only\b", 18, 150),
    (r"\bseniors?\b|\belderly\b|\bold(er|est)? adults?\b", 60, 150),
]


def _a5_expr(x: str):
    """(min_sql, max_sql) of the two_col single-cell parser on column x."""
    s = (rf"regexp_replace(replace(replace(lower({strip(x)}), '–', '-'), '—', '-'), '\s+', ' ', 'g')")
    n3 = r"(\d{1,3})"

    def full(p):
        return f"coalesce(regexp_full_match({s}, {q(p)}), false)"

    def fx(p, g):
        return grab(s, "^(?:" + p + ")$", g)

    p_days = n3 + r"\s*(days?|d)"
    p_drng = n3 + r"\s*(days?|d)\s*(?:-|to)\s*" + n3 + r"\s*(days?|d)"
    p_rng = n3 + r"\s*(?:-|to)\s*" + n3
    p_btw = r"between\s+" + n3 + r"\s+and\s+" + n3
    p_plus = n3 + r"\s*(\+|\*|and\s*(?:over|older|above|up)|&\s*older)"
    p_ge = r"(>=|≥|>)\s*" + n3
    p_under = r"(?:under|below|less\s*than)\s*" + n3
    p_le = r"(?:<=|≤|up\s*to|upto|to)\s*" + n3
    p_lt = r"<\s*" + n3
    p_years = n3 + r"\s*(years?|yrs?|ys?)"
    p_months = n3 + r"\s*(months?|mos?|m)"
    p_mrng = n3 + r"\s*(months?|mos?|m)\s*(?:-|to)\s*" + n3 + r"\s*(months?|mos?|m|years?|yrs?)"
    nb_last = f"TRY_CAST(regexp_extract_all({s}, '\\b(\\d{{1,3}})\\b', 1)[-1] AS DOUBLE)"
    fb = nums(s, r"\d{1,3}")
    dlo, dhi = f"round_even({fx(p_drng, 1)} / 365.0, 4)", f"round_even({fx(p_drng, 3)} / 365.0, 4)"
    rlo, rhi = fx(p_rng, 1), fx(p_rng, 2)
    blo, bhi = fx(p_btw, 1), fx(p_btw, 2)
    mlo = f"round_even({fx(p_mrng, 1)} / 12.0, 2)"
    munit = f"regexp_extract({s}, {q('^(?:' + p_mrng + ')$')}, 4)"
    mhi = f"CASE WHEN starts_with({munit}, 'm') THEN round_even({fx(p_mrng, 3)} / 12.0, 2) ELSE {fx(p_mrng, 3)} END"
    fb0, fb1 = f"({fb})[1]", f"({fb})[2]"
    ge_op = f"regexp_extract({s}, {q('^(?:' + p_ge + ')$')}, 1)"
    rules = [
        (f"{x} IS NULL OR {strip(x)} = ''", "NULL", "NULL"),
        (has(s, r"\bfetal\b"), "0.0", "0.0"),
        (f"{has(s, r'\bnewborns?\b')} AND {nb_last} BETWEEN 0 AND 150", "0.0", nb_last),
    ] + [(has(s, p), f"{lo}.0", f"{hi}.0") for p, lo, hi in _A5_SYN] + [
        (full(p_days), f"round_even({fx(p_days, 1)} / 365.0, 4)", f"round_even({fx(p_days, 1)} / 365.0, 4)"),
        (f"{full(p_drng)} AND {dlo} <= {dhi}", dlo, dhi),
        (f"{full(p_rng)} AND 0 <= {rlo} AND {rlo} <= {rhi} AND {rhi} <= 150", rlo, rhi),
        (f"{full(p_btw)} AND 0 <= {blo} AND {blo} <= {bhi} AND {bhi} <= 150", blo, bhi),
        (full(p_plus), fx(p_plus, 1), "150.0"),
        (full(p_ge), f"CASE WHEN {ge_op} = '>' THEN {fx(p_ge, 2)} + 1 ELSE {fx(p_ge, 2)} END", "150.0"),
        (full(p_under), "0.0", f"greatest(0.0, {fx(p_under, 1)} - 1)"),
        (full(p_le), "0.0", fx(p_le, 1)),
        (full(p_lt), "0.0", f"greatest(0.0, {fx(p_lt, 1)} - 1)"),
        (full(p_years), fx(p_years, 1), fx(p_years, 1)),
        (full(p_months), f"round_even({fx(p_months, 1)} / 12.0, 2)", f"round_even({fx(p_months, 1)} / 12.0, 2)"),
        (f"{full(p_mrng)} AND {mlo} <= ({mhi})", mlo, f"({mhi})"),
        (f"len({fb}) = 2 AND 0 <= {fb0} AND {fb0} <= {fb1} AND {fb1} <= 150", fb0, fb1),
        (f"len({fb}) = 1 AND {fb0} BETWEEN 0 AND 150", fb0, fb0),
    ]
    return f"CAST({case(rules, 1)} AS DOUBLE)", f"CAST({case(rules, 2)} AS DOUBLE)"


def age_two_col() -> str:
    vmin, vmax, vgrp = '"Accepts Minimum Patient Age"', '"Accepts Maximum Patient Age"', '"Age Group"'

    def pure(x):
        return f"coalesce(regexp_full_match({strip(x)}, '[+-]?\\d+(?:\\.\\d+)?'), false)"

    def newborn(x):
        return has(x, r"(?i)\bnewborns?\b")

    nl, nr = nums(vmin, r"\d{1,3}(?:\.\d+)?"), nums(vmax, r"\d{1,3}(?:\.\d+)?")
    a_min, a_max = _a5_expr("vmin")
    b_min, b_max = _a5_expr("vmax")
    g_min, g_max = _a5_expr("vage")

    def nb(x):
        return f"CASE WHEN {x} IS NOT NULL AND {strip(x)} <> '' THEN {x} END"
    return f"""
WITH src AS ({source('age_two_col', inputs.age_two_col_sql)}),
a AS (SELECT p_partkey, {vmin} AS vmin, {vmax} AS vmax,
             coalesce({nb(vmin)}, {nb(vmax)}, {nb(vgrp)}) AS vage FROM src),
b AS (SELECT *, {pure('vmin')} AS pmin, {pure('vmax')} AS pmax,
             {nl.replace(vmin, 'vmin')} AS nl, {nr.replace(vmax, 'vmax')} AS nr,
             {newborn('vmin')} AS nbl, {newborn('vmax')} AS nbr FROM a),
c AS (SELECT *, list_max(list_filter(list_concat(
               CASE WHEN pmax THEN [TRY_CAST(vmax AS DOUBLE)] ELSE [] END,
               CASE WHEN pmin THEN [TRY_CAST(vmin AS DOUBLE)] ELSE [] END, nl, nr),
             lambda z: z > 0)) AS cpos FROM b),
d AS (SELECT *, ((nbl AND (pmax OR len(nr) > 0)) OR (nbr AND (pmin OR len(nl) > 0))) AND cpos IS NOT NULL
               AS case_a FROM c),
e AS (SELECT *, NOT case_a AND pmin AND vmax IS NOT NULL AND NOT pmax AND len(nr) > 0 AS case_b,
             CASE WHEN vmin IS NOT NULL AND NOT pmin THEN {a_min} END AS l_min,
             CASE WHEN vmin IS NOT NULL AND NOT pmin THEN {a_max} END AS l_max,
             CASE WHEN vmax IS NOT NULL AND NOT pmax THEN {b_min} END AS r_min,
             CASE WHEN vmax IS NOT NULL AND NOT pmax THEN {b_max} END AS r_max FROM d),
f AS (SELECT *,
        CASE WHEN case_a THEN 0.0 WHEN case_b THEN TRY_CAST(vmin AS DOUBLE) ELSE coalesce(l_min, r_min) END AS mn,
        CASE WHEN case_a THEN cpos WHEN case_b THEN list_max(nr) ELSE coalesce(r_max, l_max) END AS mx
      FROM e),
g AS (SELECT *, mn IS NULL AND mx IS NULL AND vage IS NOT NULL AND NOT {pure('vage')} AS need FROM f)
SELECT p_partkey, vmin AS "Accepts Minimum Patient Age", vmax AS "Accepts Maximum Patient Age",
       CAST(coalesce(mn, CASE WHEN need THEN {g_min} END) AS DOUBLE) AS min_age,
       CAST(coalesce(mx, CASE WHEN need THEN {g_max} END) AS DOUBLE) AS max_age
FROM g
"""
