"""Age-band parsing: free text such as "18 & older" -> (min_age, max_age, rule).

Six rule sets ("profiles") are provided.  Each is an *ordered* list of rules
where the first match wins, so each profile compiles to one ``CASE WHEN``
chain of native regex expressions -- no Python UDF, usable on batch and
streaming DataFrames alike.

``age_struct(value, profile)`` returns ``struct<min_age double, max_age double,
rule string>``.  Header-aware post-processing (profiles ``phrase`` and
``phrase_hdr``) and the two-column form (``two_col``) live in
``rostrum.operators.ages`` because they are DataFrame transforms.
"""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import NUM, count_matches, find_all, nums_array, pstrip, squash_ws

PROFILES = ("label_map", "phrase", "phrase_hdr", "band", "two_col", "simple120")

# ---------------------------------------------------------------------------
# Fixed values (must equal the reference rule tables for identical results)
# ---------------------------------------------------------------------------
DEFAULT_MAX = 150.0
SIMPLE_MAX = 120

# label_map profile: exact label -> (min, max); None means "known, no range".
LABELS_EXACT = [
    ("adult", 18, 150), ("adults", 18, 150), ("adult only", 18, 150),
    ("adolescents", 10, 21), ("adolescent", 10, 21), ("adolescents to adult", 10, 21),
    ("pediatric", 0, 18), ("pediatrics", 0, 18), ("children", 0, 12), ("child", 0, 12),
    ("adolescent & adult", 6, 21), ("pediatric and adult", 0, 21), ("pediatric/adult", 0, 21),
    ("pediatric only", 0, 17), ("children only", 0, 17), ("neonatal", 0, 0.25),
    ("infants", 0, 1), ("birth to 18", 0, 18), ("birth to 21", 0, 21),
    ("no pediatric patients", 18, 150), ("preferred 18 and over", 18, 150),
    ("female specialist", 0, 18), ("females only", None, None),
    ("permanent females", None, None), ("infectious pts only 18-99", 18, 99),
]

# band profile: label found as a substring, checked in this order.
LABELS_SUBSTRING = [
    ("adult", 18, 150), ("adults", 18, 150), ("pediatric", 0, 17), ("children", 0, 17),
    ("child", 0, 17), ("members", 0, 150), ("no age restriction", 0, 150),
    ("no age restrictions", 0, 150), ("none", 0, 150),
]

# band profile: header text -> which output column it feeds.
HEADER_KIND = [
    ("AGE", "min"), ("Age", "min"), ("Ages", "min"), ("AGE RESTRICTIONS", "min"),
    ("Age Range From", "min"), ("Age Ranges", "min"), ("Age Ranges (0-99)", "min"),
    ("Minimum Age", "min"), ("Min Age", "min"), ("Max Age", "max"), ("Maximum Age", "max"),
    ("MAX Age", "max"), ("MAXIMUM PATIENT AGE", "max"), ("PATIENT MIN AGE", "min"),
    ("PATIENT MAX AGE", "max"), ("Practice limitations: Min Age", "min"),
    ("Practice limitations: Max Age", "max"),
    ("Age Restrictions (required for all providers)", "min"),
    ("Address/Service Location Age Restrictions (EX: None, 18 & Younger, 19& older) [No Blanks]", "min"),
    ("Address/Service Location Age Restrictions (EX: None, 18 & Younger, 19 & Older) [No Blanks]", "min"),
    ("Accepts Minimum Patient Age", "min"),
]

# two_col profile: word synonyms, checked in this order.
SYNONYMS_TWO_COL = [
    (r"\bnewborns?\b", 0.0, 0.0, "syn_newborn_0"),
    (r"\binfants?\b", 0.0, 1.0, "syn_infant_0_1y"),
    (r"\btoddlers?\b", 1.0, 3.0, "syn_toddler_1_3y"),
    (r"\bchildren\b|\bkids?\b", 0.0, 12.0, "syn_children_0_12y"),
    (r"\bteens?\b|\bteenagers?\b", 13.0, 19.0, "syn_teen_13_19y"),
    (r"\byoung adults?\b", 18.0, 24.0, "syn_young_adult_18_24y"),
    (r"\badults?\b|\badult only\b|\badults only\b", 18.0, 150.0, "syn_adult_18_plus"),
    (r"\bseniors?\b|\belderly\b|\bold(er|est)? adults?\b", 60.0, 150.0, "syn_senior_60_plus"),
]

# simple120 profile: texts meaning "no value".
NO_VALUE_WORDS = ["none", "no", "unknown", "n/a"]

# Word lists shared by the phrase profiles.
UP_WORDS = r"(?:\+|\*|(?:and|&|or)\s*(?:up|over|older|above)|up|over|older|above)"

# Rule patterns, per profile.  NUM = one integer or decimal number, N3 = a 1-3 digit number.
N3 = r"(\d{1,3})"
# label_map
A1_RANGE = r"(\d+)\s*(?:to|-|–|—)\s*(\d+)"
A1_AND_UP = r"(\d+)\s*(?:\+|and up|older|over|above)"
A1_AND_YOUNGER = r"(\d+)\s*(?:and under|and younger)"
A1_YEARS = r"^(\d+)\s*(?:yrs?|years?)"
A1_MONTHS = r"^(\d+)\s*(?:months?)"
A1_DAYS = r"^(\d+)\s*(?:days?)"
A1_LEADING_NUMBER = r"^(\d+)"
A1_NUMBER_ONLY = r"^\d+$"
# phrase and phrase_hdr
PH_PLUS_STRICT = r"^\s*" + NUM + r"\s*[\+\*]+\s*$"
PH_PLUS_INLINE = NUM + r"\s*[\+\*]+"
PH_RANGE = NUM + r"\s*[-~]\s*" + NUM
PH_MAX_ONLY_BEFORE = r"(under|below|less than|up to)\s*" + NUM
PH_MAX_ONLY_AFTER = NUM + r"\s*(and younger|younger)"
A2_FUZZY_AND_UP = r"(?i)^\s*" + NUM + r"\s+(a\w*d)\s+(u\w*p)\b"
A2_SPACED_AND_UP = r"(?i)^\s*" + NUM + r"\s+a\s*n\s*d\s+u\s+p\b"
A2_OLDER = NUM + r"\s*(?:\+|\*|(?:and|&)\s*older|(?:and\s+above)|above|over)\b"
A2_MONTHS = r"(?i)" + NUM + r"\s*(?:month|months)\b"
A2_NO_RESTRICTION = ["none", "no restriction", "all ages"]
A2_MONTHS_PLUS = ["and older", "older", "+", "& older"]
A2_MONTHS_MAX = ["and younger", "younger", "under", "below", "less than", "up to"]
A3_RANGE_PLUS = NUM + r"\s*[-~]\s*" + NUM + r"\s*[\+\*]\b"
A3_UP_OVER = r"(?i)" + NUM + r"\s*(?:[a-z/]+\s*){0,3}?" + UP_WORDS + r"\b"
A3_COLLAPSE_DROP = r"[^a-z0-9+*]"
A3_UP_OVER_COLLAPSED = r"(?i)^" + NUM + r"((years?|yrs?|yr|yo|y/o)?)and(?:up|over|older|above)\b"
A3_SPACED_AND_UP = r"(?i)" + NUM + r"\s*a\s*n\s*d\s+u\s*p\b"
A3_MONTHS = r"(?i)" + NUM + r"\s*(?:month|months|mon|mons|mo|mos|mth|mths|m)\b"
A3_MONTHS_UP = r"(?i)" + UP_WORDS + r"\b"
A3_MONTHS_MAX = r"(?i)(and\s+younger|younger|under|below|less than|up to)\b"
MIN_HEADER_HINTS = [" min", "minimum", "min ", "(min", ">=", "lower bound"]
MIN_HEADER_WORDS = r"\b(min|minimum|from)\b"
MAX_HEADER_HINTS = [" max", "maximum", "max ", "(max", "<=", "upper bound"]
# band
A4_MONTHS = r"^\s*" + NUM + r"\s*(month|months)\s*(?:and\s*older|and\s*up)?\s*$"
A4_AND_UP = r"^\s*" + NUM + r"[\s\+&]*(\+|and\s*up|and\s*older|or\s*older|&\s*older)\s*$"
A4_UNDER = r"^\s*(under|less\s*than)\s*" + NUM + r"\s*$"
A4_YOUNGER = r"^\s*" + NUM + r"[\s]*(?:&|and)?\s*younger\s*$"
A4_RANGE = r"^\s*" + NUM + r"[\s]*(?:-|–|to)[\s]*" + NUM + r"\s*$"
A4_NUMBER_ONLY = r"^\s*" + NUM + r"\s*$"
# two_col (whole-text patterns)
A5_NEWBORN_NUMBER = r"\b(\d{1,3})\b"
A5_DAYS = N3 + r"\s*(days?|d)"
A5_DAYS_RANGE = N3 + r"\s*(days?|d)\s*(?:-|to)\s*" + N3 + r"\s*(days?|d)"
A5_RANGE = N3 + r"\s*(?:-|to)\s*" + N3
A5_BETWEEN = r"between\s+" + N3 + r"\s+and\s+" + N3
A5_PLUS = N3 + r"\s*(\+|\*|and\s*(?:over|older|above|up)|&\s*older)"
A5_GE_GT = r"(>=|≥|>)\s*" + N3
A5_UNDER = r"(?:under|below|less\s*than)\s*" + N3
A5_LE_TO = r"(?:<=|≤|up\s*to|upto|to)\s*" + N3
A5_LT = r"<\s*" + N3
A5_YEARS = N3 + r"\s*(years?|yrs?|ys?)"
A5_MONTHS = N3 + r"\s*(months?|mos?|m)"
A5_MONTHS_RANGE = N3 + r"\s*(months?|mos?|m)\s*(?:-|to)\s*" + N3 + r"\s*(months?|mos?|m|years?|yrs?)"
A5_PURE_NUMBER = r"^[+-]?\d+(?:\.\d+)?$"
A5_CELL_NUMBERS = r"\d{1,3}(?:\.\d+)?"
# simple120
A6_RANGE = r"(\d{1,3})\s*[-–]\s*(\d{1,3})"

# ---------------------------------------------------------------------------


def _d(x) -> Column:
    return F.lit(None).cast("double") if x is None else F.lit(float(x))


def _rec(mn, mx, rule: str) -> Column:
    mn = mn if isinstance(mn, Column) else _d(mn)
    mx = mx if isinstance(mx, Column) else _d(mx)
    return F.struct(mn.cast("double").alias("min_age"), mx.cast("double").alias("max_age"),
                    F.lit(rule).alias("rule"))


def _chain(rules, otherwise: Column) -> Column:
    """First-match-wins rule list -> one CASE WHEN."""
    expr = None
    for cond, value in rules:
        expr = F.when(cond, value) if expr is None else expr.when(cond, value)
    return otherwise if expr is None else expr.otherwise(otherwise)


def _g(c: Column, pattern: str, idx: int = 1) -> Column:
    return F.regexp_extract(c, pattern, idx).try_cast("double")


def _last(arr: Column) -> Column:
    return F.try_element_at(arr, F.lit(-1))


# --------------------------- label_map (A1) --------------------------------
def _a1(v: Column) -> Column:
    s = squash_ws(F.replace(F.replace(F.lower(pstrip(v)), F.lit("&"), F.lit("and")),
                            F.lit("–"), F.lit("-")))
    labels = F.create_map(*[x for k, mn, mx in LABELS_EXACT
                            for x in (F.lit(k), F.struct(_d(mn).alias("a"), _d(mx).alias("b")))])
    hit = F.try_element_at(labels, s)
    rng, up, younger, lead = A1_RANGE, A1_AND_UP, A1_AND_YOUNGER, A1_LEADING_NUMBER
    nums = nums_array(s, r"\d+")
    n0, n1 = F.try_element_at(nums, F.lit(1)), F.try_element_at(nums, F.lit(2))
    clamp = lambda c: F.least(c, F.lit(DEFAULT_MAX))
    rules = [
        (F.map_contains_key(labels, s), _rec(hit["a"], hit["b"], "label")),
        (s.rlike(rng), _rec(_g(s, rng, 1), clamp(_g(s, rng, 2)), "range")),
        (s.rlike(up), _rec(_g(s, up), DEFAULT_MAX, "and_up")),
        (s.rlike(younger), _rec(F.lit(0.0), clamp(_g(s, younger)), "and_younger")),
        (s.rlike(A1_YEARS), _rec(_g(s, lead), _g(s, lead), "years")),
        (s.rlike(A1_MONTHS), _rec(F.lit(0.0), _g(s, lead) / 12, "months")),
        (s.rlike(A1_DAYS), _rec(F.lit(0.0), _g(s, lead) / 365, "days")),
        (s.rlike(A1_NUMBER_ONLY), _rec(s.try_cast("double"), s.try_cast("double"), "number")),
        (s.contains("no restriction") | s.contains("no age restriction"),
         _rec(0.0, DEFAULT_MAX, "no_restriction")),
        (F.size(nums) == 1, _rec(F.lit(0.0), clamp(n0), "one_number")),
        (F.size(nums) >= 2, _rec(F.least(n0, n1), clamp(F.greatest(n0, n1)), "two_numbers")),
    ]
    return F.when(v.isNull() | (v == ""), _rec(None, None, "empty")).otherwise(
        _chain(rules, _rec(None, None, "unparsed")))


# ----------------------- phrase / phrase_hdr (A2, A3) ----------------------
_LEXICON = [
    (r"(?i)\b(newborn|neonate|neonatal)\b", 0.0, 0.08, "lex_newborn"),
    (r"(?i)\badult\s*only\b", 18.0, 150.0, "lex_adult_only"),
    (r"(?i)\badults?\b(?!\s*to)", 18.0, 150.0, "lex_adult"),
    (r"(?i)\badolescents?\s*to\s*adult(s)?\b", 10.0, 150.0, "lex_adol_to_adult"),
    # The reference's two "newborn ... to 17" rules follow and can never fire
    # (the first lexicon rule already matches "newborn").
]


def _phrase_common(v: Column):
    t = pstrip(v)
    tl = F.lower(t)
    tln = F.replace(F.replace(F.replace(tl, F.lit("—"), F.lit("-")), F.lit("–"), F.lit("-")),
                    F.lit(" to "), F.lit("-"))
    lex = [(t.rlike(p), _rec(mn, mx, r)) for p, mn, mx, r in _LEXICON]
    return t, tl, tln, lex


def _a2(v: Column) -> Column:
    t, tl, tln, lex = _phrase_common(v)
    strict, inline, rng, older, months = PH_PLUS_STRICT, PH_PLUS_INLINE, PH_RANGE, A2_OLDER, A2_MONTHS
    t1 = squash_ws(t)
    fz1, fz2 = A2_FUZZY_AND_UP, A2_SPACED_AND_UP
    my = _g(t, months) / 12.0
    maxonly = tln.rlike(PH_MAX_ONLY_BEFORE) | tln.rlike(PH_MAX_ONLY_AFTER)

    def any_of(c, words):
        cond = F.lit(False)
        for w in words:
            cond = cond | c.contains(w)
        return cond
    nums = nums_array(tln)
    rules = lex + [
        (t.rlike(strict), _rec(_g(t, strict), DEFAULT_MAX, "min_plus_or_star")),
        (t.rlike(inline), _rec(_g(t, inline), DEFAULT_MAX, "min_plus_or_star_inline")),
        (t1.rlike(fz1) | t1.rlike(fz2),
         _rec(F.coalesce(_g(t1, fz1), _g(t1, fz2)), DEFAULT_MAX, "and_up")),
        (any_of(tln, A2_NO_RESTRICTION),
         _rec(0.0, DEFAULT_MAX, "no_restriction")),
        (tln.rlike(older), _rec(_g(tln, NUM), DEFAULT_MAX, "min_only_older")),
        (t.rlike(months) & any_of(tln, A2_MONTHS_PLUS),
         _rec(my, DEFAULT_MAX, "months_plus")),
        (t.rlike(months) & any_of(tln, A2_MONTHS_MAX),
         _rec(F.lit(0.0), my, "months_max")),
        (t.rlike(months), _rec(my, DEFAULT_MAX, "months_as_min")),
        (tln.rlike(rng), _rec(F.least(_g(tln, rng, 1), _g(tln, rng, 2)),
                              F.greatest(_g(tln, rng, 1), _g(tln, rng, 2)), "range")),
        (maxonly, _rec(F.lit(0.0), _last(nums), "max_only")),
        (F.size(nums) == 1, _rec(None, None, "single_ambiguous")),
    ]
    return F.when(v.isNull(), _rec(None, None, "empty")).otherwise(
        _chain(rules, _rec(None, None, "unparsed")))


def _a3(v: Column) -> Column:
    t, tl, tln, lex = _phrase_common(v)
    rng_plus, strict, inline, rng = A3_RANGE_PLUS, PH_PLUS_STRICT, PH_PLUS_INLINE, PH_RANGE
    up1, up2, up3, months = A3_UP_OVER, A3_UP_OVER_COLLAPSED, A3_SPACED_AND_UP, A3_MONTHS
    collapsed = F.regexp_replace(tl, A3_COLLAPSE_DROP, "")
    my = _g(t, months) / 12.0
    maxonly = tln.rlike(PH_MAX_ONLY_BEFORE) | tln.rlike(PH_MAX_ONLY_AFTER)
    nums = nums_array(tln)
    rules = lex + [
        (tln.rlike(rng_plus), _rec(F.least(_g(tln, rng_plus, 1), _g(tln, rng_plus, 2)),
                                   DEFAULT_MAX, "range_upper_plus_as_150")),
        (t.rlike(strict), _rec(_g(t, strict), DEFAULT_MAX, "min_plus_or_star")),
        (t.rlike(inline), _rec(_g(t, inline), DEFAULT_MAX, "min_plus_or_star_inline")),
        (tl.rlike(up1) | collapsed.rlike(up2) | tl.rlike(up3),
         _rec(F.coalesce(_g(tl, up1), _g(collapsed, up2), _g(tl, up3)), DEFAULT_MAX,
              "min_only_up_over")),
        (t.rlike(months) & tl.rlike(A3_MONTHS_UP),
         _rec(my, DEFAULT_MAX, "months_plus_or_up")),
        (t.rlike(months) & tl.rlike(A3_MONTHS_MAX),
         _rec(F.lit(0.0), my, "months_max")),
        (t.rlike(months), _rec(my, DEFAULT_MAX, "months_as_min")),
        (tln.rlike(rng), _rec(F.least(_g(tln, rng, 1), _g(tln, rng, 2)),
                              F.greatest(_g(tln, rng, 1), _g(tln, rng, 2)), "range")),
        (maxonly, _rec(F.lit(0.0), _last(nums), "max_only")),
        (F.size(nums) == 1, _rec(None, None, "single_ambiguous")),
    ]
    return F.when(v.isNull(), _rec(None, None, "empty")).otherwise(
        _chain(rules, _rec(None, None, "unparsed")))


def is_min_header_phrase(h: Column) -> Column:
    """Profile ``phrase``: min-like header by substrings."""
    hl = F.lower(F.coalesce(h, F.lit("")))
    cond = hl.endswith(" min") | hl.startswith("min")
    for hint in MIN_HEADER_HINTS:
        cond = cond | hl.contains(hint)
    return cond


def is_min_header_phrase_hdr(h: Column) -> Column:
    """Profile ``phrase_hdr``: the words min / minimum / from (whole words, where
    ``phrase`` takes "minimum" anywhere), else the other hints of ``phrase``."""
    hl = F.lower(F.coalesce(h, F.lit("")))
    cond = hl.rlike(MIN_HEADER_WORDS) | hl.startswith("min")
    for hint in MIN_HEADER_HINTS:
        if hint != "minimum":
            cond = cond | hl.contains(hint)
    return cond


def is_max_header_phrase(h: Column) -> Column:
    hl = F.lower(F.coalesce(h, F.lit("")))
    cond = hl.endswith(" max") | hl.startswith("max")
    for hint in MAX_HEADER_HINTS:
        cond = cond | hl.contains(hint)
    return cond


# ------------------------------ band (A4) ----------------------------------
def _a4(v: Column) -> Column:
    s = F.lower(pstrip(v))
    months, and_up, under, younger = A4_MONTHS, A4_AND_UP, A4_UNDER, A4_YOUNGER
    rng, only = A4_RANGE, A4_NUMBER_ONLY
    nums = nums_array(s)
    n0, n1 = F.try_element_at(nums, F.lit(1)), F.try_element_at(nums, F.lit(2))
    rules = [(s.contains(k), _rec(mn, mx, "label")) for k, mn, mx in LABELS_SUBSTRING] + [
        (s.rlike(months), _rec(F.lit(0.0), F.greatest(F.lit(0.0), _g(s, months) / 12.0), "months")),
        (s.rlike(and_up), _rec(_g(s, and_up), DEFAULT_MAX, "and_up")),
        (s.rlike(under), _rec(F.lit(0.0), _g(s, under, 2) - 1, "under")),
        (s.rlike(younger), _rec(F.lit(0.0), _g(s, younger), "younger")),
        (s.rlike(rng), _rec(F.least(_g(s, rng, 1), _g(s, rng, 2)),
                            F.greatest(_g(s, rng, 1), _g(s, rng, 2)), "range")),
        (s.rlike(only), _rec(_g(s, only), DEFAULT_MAX, "number")),
        (F.size(nums) >= 2, _rec(F.least(n0, n1), F.greatest(n0, n1), "two_numbers")),
        (F.size(nums) == 1, _rec(n0, DEFAULT_MAX, "one_number")),
    ]
    return F.when(v.isNull() | (pstrip(v) == ""), _rec(None, None, "empty")).otherwise(
        _chain(rules, _rec(None, None, "unparsed")))


def header_key(h: Column) -> Column:
    """Normalised header key: strip, collapse whitespace, lower-case."""
    return F.lower(squash_ws(pstrip(h)))


def band_sub_category(h: Column, min_col: str = "Min_age", max_col: str = "Max_age") -> Column:
    """Header -> name of the output column it feeds, else ''."""
    kinds = {}
    for k, kind in HEADER_KIND:
        kinds.setdefault(" ".join(k.split()).lower(), kind)
    key = header_key(F.coalesce(h, F.lit("None")))
    m = F.create_map(*[x for k, kind in kinds.items()
                       for x in (F.lit(k), F.lit(min_col if kind == "min" else max_col))])
    return F.coalesce(F.try_element_at(m, key), F.lit(""))


# ----------------------------- two_col (A5) --------------------------------
def _days_to_years(c: Column) -> Column:
    # v is an integer 0..999 here; for v/365 (4 digits) and v/12 (2 digits) half-even
    # rounding of the shortest decimal text equals Python's round on the binary value
    # (checked exhaustively over the domain), so bround is exact for this profile.
    return F.bround(c / 365.0, 4)


def _a5(v: Column) -> Column:
    s = squash_ws(F.replace(F.replace(F.lower(pstrip(v)), F.lit("–"), F.lit("-")),
                            F.lit("—"), F.lit("-")))
    n3 = N3
    nb_nums = find_all(s, A5_NEWBORN_NUMBER, 1)
    nb_hi = _last(nb_nums).try_cast("double")
    full = lambda p: s.rlike("^(?:" + p + ")$")
    gx = lambda p, i: _g(s, "^(?:" + p + ")$", i)
    p_days, p_days_rng, p_rng, p_between, p_plus = A5_DAYS, A5_DAYS_RANGE, A5_RANGE, A5_BETWEEN, A5_PLUS
    p_ge, p_under, p_le, p_lt = A5_GE_GT, A5_UNDER, A5_LE_TO, A5_LT
    p_years, p_months, p_months_rng = A5_YEARS, A5_MONTHS, A5_MONTHS_RANGE
    in_age = lambda lo, hi: (F.lit(0.0) <= lo) & (lo <= hi) & (hi <= F.lit(DEFAULT_MAX))
    d_lo, d_hi = _days_to_years(gx(p_days_rng, 1)), _days_to_years(gx(p_days_rng, 3))
    r_lo, r_hi = gx(p_rng, 1), gx(p_rng, 2)
    b_lo, b_hi = gx(p_between, 1), gx(p_between, 2)
    ge_op = F.regexp_extract(s, "^(?:" + p_ge + ")$", 1)
    mr_lo = F.bround(gx(p_months_rng, 1) / 12.0, 2)
    mr_unit = F.regexp_extract(s, "^(?:" + p_months_rng + ")$", 4)
    mr_hi = F.when(mr_unit.startswith("m"), F.bround(gx(p_months_rng, 3) / 12.0, 2)).otherwise(
        gx(p_months_rng, 3))
    fb = nums_array(s, n3)
    f0, f1 = F.try_element_at(fb, F.lit(1)), F.try_element_at(fb, F.lit(2))
    rules = [
        (s.rlike(r"\bfetal\b"), _rec(0.0, 0.0, "special_fetal_0")),
        (s.rlike(r"\bnewborns?\b") & s.rlike(r"\b(\d{1,3})\b") & (nb_hi >= 0) & (nb_hi <= DEFAULT_MAX),
         _rec(F.lit(0.0), nb_hi, "special_newborn_and_number")),
    ] + [(s.rlike(p), _rec(mn, mx, r)) for p, mn, mx, r in SYNONYMS_TWO_COL] + [
        (full(p_days), _rec(_days_to_years(gx(p_days, 1)), _days_to_years(gx(p_days, 1)),
                            "days_exact_to_years")),
        (full(p_days_rng) & (d_lo <= d_hi), _rec(d_lo, d_hi, "days_range_to_years")),
        (full(p_rng) & in_age(r_lo, r_hi), _rec(r_lo, r_hi, "range_numeric")),
        (full(p_between) & in_age(b_lo, b_hi), _rec(b_lo, b_hi, "range_between")),
        (full(p_plus), _rec(gx(p_plus, 1), DEFAULT_MAX, "lower_bound_plus")),
        (full(p_ge), _rec(F.when(ge_op == ">", gx(p_ge, 2) + 1.0).otherwise(gx(p_ge, 2)),
                          DEFAULT_MAX, "lower_bound_ge_gt")),
        (full(p_under), _rec(F.lit(0.0), F.greatest(F.lit(0.0), gx(p_under, 1) - 1.0),
                             "upper_bound_under")),
        (full(p_le), _rec(F.lit(0.0), gx(p_le, 1), "upper_bound_le_to")),
        (full(p_lt), _rec(F.lit(0.0), F.greatest(F.lit(0.0), gx(p_lt, 1) - 1.0), "upper_bound_lt")),
        (full(p_years), _rec(gx(p_years, 1), gx(p_years, 1), "years_exact")),
        (full(p_months), _rec(F.bround(gx(p_months, 1) / 12.0, 2), F.bround(gx(p_months, 1) / 12.0, 2),
                              "months_exact")),
        (full(p_months_rng) & (mr_lo <= mr_hi), _rec(mr_lo, mr_hi, "range_months_to_?")),
        ((F.size(fb) == 2) & in_age(f0, f1), _rec(f0, f1, "range_two_numbers_fallback")),
        ((F.size(fb) == 1) & (f0 >= 0) & (f0 <= DEFAULT_MAX), _rec(f0, f0, "single_number_fallback")),
    ]
    return F.when(v.isNull() | (pstrip(v) == ""), _rec(None, None, "empty")).otherwise(
        _chain(rules, _rec(None, None, "unparsed")))


# ---------------------------- simple120 (A6) -------------------------------
def _a6(v: Column) -> Column:
    s = pstrip(v)
    sl = F.lower(s)
    rng = A6_RANGE
    nums = nums_array(sl, r"\d{1,3}")
    n0, n1 = F.try_element_at(nums, F.lit(1)), F.try_element_at(nums, F.lit(2))
    cap = lambda c: F.least(c, F.lit(float(SIMPLE_MAX)))
    rules = [
        (v.isNull() | (s == ""), _rec(0.0, 0.0, "empty")),
        (sl.isin(*NO_VALUE_WORDS), _rec(0.0, 0.0, "no_value")),
        (sl.contains("birth"), _rec(0.0, 0.0, "birth")),
        (~sl.rlike(r"\d"), _rec(0.0, 0.0, "no_digit")),
        (sl.rlike(rng), _rec(F.greatest(F.lit(0.0), _g(sl, rng, 1)), cap(_g(sl, rng, 2)), "range")),
        ((F.size(nums) == 1) & (sl.contains("+") | sl.endswith("plus")),
         _rec(n0, float(SIMPLE_MAX), "plus")),
        ((F.size(nums) == 1) & sl.contains("older"), _rec(n0, float(SIMPLE_MAX), "older")),
        ((F.size(nums) == 1) & sl.contains("younger"), _rec(F.lit(0.0), n0, "younger")),
        (F.size(nums) == 1, _rec(F.lit(0.0), cap(n0), "single")),
        ((n0 > n1) & (n1 == 0), _rec(F.lit(0.0), cap(n0), "stray_zero")),
        (F.size(nums) >= 2, _rec(F.greatest(F.lit(0.0), F.least(n0, n1)), cap(F.greatest(n0, n1)),
                                 "two_numbers")),
    ]
    return _chain(rules, _rec(0.0, 0.0, "fallback"))


_CORES = {"label_map": _a1, "phrase": _a2, "phrase_hdr": _a3, "band": _a4,
          "two_col": _a5, "simple120": _a6}


def age_struct(value: Column, profile: str = "phrase_hdr") -> Column:
    """Parse one age text column with the given profile (no header logic)."""
    try:
        core = _CORES[profile]
    except KeyError:
        raise ValueError(f"unknown age profile {profile!r}; expected one of {PROFILES}") from None
    return core(value.cast("string"))


def is_pure_numeric(v: Column) -> Column:
    """Whole (trimmed) text is a signed integer or decimal."""
    return F.coalesce(pstrip(v).rlike(A5_PURE_NUMBER), F.lit(False))


def is_newborn_text(v: Column) -> Column:
    return F.coalesce(v.rlike(r"(?i)\bnewborns?\b"), F.lit(False))


def nums_in_text(v: Column) -> Column:
    """All 1-3 digit numbers (with decimals) in a cell, as array<double>."""
    return nums_array(v, A5_CELL_NUMBERS)


def count_numbers(v: Column) -> Column:
    return count_matches(v, r"\d+(?:\.\d+)?")
