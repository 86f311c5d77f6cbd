"""Provider-name parsing (family N): messy full name -> parts.

Every profile is a single projection of native expressions: token lists are
Spark arrays, the reference's ``while tokens and pred(tokens[-1]): pop`` loops
become "trailing run" index arithmetic over ``transform``/``array_max``
(``split_trailing``), so no Python runs per row.

Profiles: ``degree_caps`` (N1), ``degree_dict`` (N2), ``credential_org`` (N3),
``credential_list`` (N4), ``credential_clean`` (N5), ``format_detect`` (N6).
"""
from __future__ import annotations

import re
from types import SimpleNamespace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .literals import empty_str, in_list, str_map
from .text import capitalize, pstrip, squash_ws, strip_chars

PROFILES = ("degree_caps", "degree_dict", "credential_org", "credential_list", "credential_clean",
            "format_detect")

# ---------------------------------------------------------------------------
# Fixed values (must equal the reference word lists for identical results)
# ---------------------------------------------------------------------------
# N1/N2 degree aliases (alias -> canonical), keys are normalised by
# dropping whitespace, '-' and '.', then lower-casing.
RAW_DEGREE_ALIASES = [
    ("m.d.", "MD"), ("md", "MD"), ("MD", "MD"),
    ("ph.d.", "PhD"), ("phd", "PhD"), ("PhD", "PhD"),
    ("d.o.", "DO"), ("do", "DO"), ("DO", "DO"),
    ("r.n.", "RN"), ("rn", "RN"), ("RN", "RN"),
    ("d.d.s.", "DDS"), ("dds", "DDS"), ("DDS", "DDS"),
    ("d.c.", "DC"), ("dc", "DC"), ("DC", "DC"),
    ("m.b.b.s.", "MBBS"), ("mbbs", "MBBS"), ("MBBS", "MBBS"),
    ("d.m.", "DM"), ("dm", "DM"), ("DM", "DM"),
    ("pa", "PA"), ("pa-c", "PA-C"), ("pa c", "PA-C"), ("pa-c.", "PA-C"),
    ("aprn", "APRN"), ("crna", "CRNA"), ("np", "NP"), ("np-c", "NP-C"), ("NP-C", "NP-C"),
    ("dpt", "DPT"), ("d.p.t.", "DPT"),
    ("dpm", "DPM"), ("d.p.m.", "DPM"),
    ("pt", "PT"), ("otr", "OTR"), ("otr/l", "OTR/L"),
    ("aud", "AUD"), ("msw", "MSW"), ("rnfa", "RNFA"),
    ("dnp", "DNP"), ("fnp", "FNP"), ("cnm", "CNM"), ("cns", "CNS"),
    ("rt", "RT"), ("rtt", "RTT"), ("rd", "RD"), ("rdn", "RDN"),
    ("rdms", "RDMS"), ("rdcs", "RDCS"),
    ("msc", "MSC"), ("ms", "MS"), ("ma", "MA"), ("mba", "MBA"), ("mph", "MPH"),
    ("obgyn", "OBGYN"),
]
NAME_SUFFIXES_N12 = ["jr", "sr", "ii", "iii", "iv", "v", "vi"]
ROMAN_NUMERALS = ["I", "II", "III", "IV", "V", "VI"]
TITLES = ["dr", "mr", "mrs", "ms", "prof", "sir", "madam", "miss"]
DASHES = ["-", "–", "—"]
ORG_KEYWORDS_N12 = ["health", "MedCare", "Medicine", "Clinic", "Hospital", "Medical", "University",
                    "WakeMed"]

# N3-N5
NAME_SUFFIXES = ["jr", "sr", "ii", "iii", "iv", "v", "phd", "md", "dds", "esq"]
LAST_NAME_PREFIXES = ["de", "del", "de la", "da", "di", "van", "von", "der", "du", "la", "le", "st", "st.",
                      "mac"]
COMMON_DESIGNATIONS = [
    "CEO", "CTO", "CFO", "COO", "VP", "SVP", "AVP", "MD", "HR", "QA", "QA LEAD", "TEAM LEAD", "LEAD",
    "ENGINEER", "SR ENGINEER", "SENIOR ENGINEER", "MANAGER", "SR MANAGER", "SENIOR MANAGER", "DIRECTOR",
    "SR DIRECTOR", "SENIOR DIRECTOR", "PRESIDENT", "CHAIRMAN", "CHAIRWOMAN", "CHIEF", "ARCHITECT",
    "ANALYST", "PA", "DO", "OT", "PT", "NP", "FNP", "ARNP", "APRN", "RN", "LPN", "MBA", "CPA", "FNP-C",
    "PA-C", "RN BSN", "BSN", "DNP", "OT",
]
ORG_KEYWORDS_N3 = ["inc", "llc", "ltd", "corp", "company", "co.", "bank", "hospital", "university",
                   "foundation", "&", "association", "society"]
ROSTER_FILENAME = "Roster Files - top 20 entities_desensitized.xlsx"

# N6
DEGREE_TERMS_N6 = ["MD", "MBBS", "DO", "PhD", "MSc", "MS", "MBA", "RN", r"R\.?N\.?", "PA", "DVM", "OTR", "CHT",
                   "DDS", "DMD", "BSc", "BPharm", "FRCS", "FRCP", "LPC", "CPA", "Esq"]
ORG_WORDS_N6 = ["hospital", "clinic", "center", "centre", "institute", "school", "college", "laboratory",
                "laboratories", "labs", "trust", "clinic", "pharmacy", "care", "health", "healthcare",
                "medical", "association", "hospitality", "lab", "university"]
ORG_STRONG_TOKENS_N6 = ["ltd", "pvt", "inc", "company", "co", "llc", "corp", "clinic", "hospital", "institute",
                        "college", "university", "trust"]
SUFFIXES_N6 = ["jr", "sr", "ii", "iii", "iv"]

# Patterns of the name rules.
TOKEN_KEY_DROP = r"[\s\-.]"                 # dropped when normalising a degree token
UPPERCASE_DEGREE = r"^[A-Z][A-Z\-]+$"       # ALL-CAPS token read as a degree (degree_caps)
INITIAL = r"^[A-Za-z]\.$"                   # "J." -> upper-cased
O_PREFIX = r"^O[Oo]+"                       # "Oo..." title-case rule
ROMAN_UPPER = ["II", "III", "IV", "VI"]     # kept upper-case by the title-case rule
SHORT_CREDENTIAL = r"^[A-Za-z]{2,4}$"
UPPER_CREDENTIAL = r"^[A-Z]{2,4}$"
COMMA_FORMAT = r"^\s*([^,]+)\s*,\s*(.+)$"   # "Last, First ..." (format_detect)
PARENS_FORMAT = r"^(.+?)\s*\((.+)\)\s*$"    # "Name (Affiliation)" (format_detect)
# ---------------------------------------------------------------------------

def _e() -> Column:
    return empty_str()


def _norm_key(s: str) -> str:
    return re.sub(r"[\s\-.]", "", s).lower()


def _degree_map() -> Column:
    m = {}
    for k, v in RAW_DEGREE_ALIASES:
        m[_norm_key(k)] = v
    return str_map(m)


def ws_tokens(c: Column) -> Column:
    """``str.split()``."""
    return F.regexp_extract_all(c, F.lit(r"(?U)\S+"), F.lit(0))


def split_trailing(arr: Column, pred):
    """(head, tail): tail = longest run of trailing elements satisfying pred."""
    k = F.coalesce(F.array_max(F.transform(arr, lambda t, i: F.when(pred(t), F.lit(0)).otherwise(i + 1))),
                   F.lit(0))
    return F.slice(arr, 1, k), F.slice(arr, k + 1, F.greatest(F.size(arr) - k, F.lit(0)))


def _runs(c: Column, token_re: str) -> Column:
    """All maximal matches of a token class -- ``split`` + drop empty pieces,
    with the pattern compiled once per task (``split`` with a multi-character
    regex recompiles it on every row)."""
    return F.regexp_extract_all(c, F.lit(token_re), F.lit(0))


def _get(arr: Column, i: int) -> Column:
    return F.try_element_at(arr, F.lit(i))


def _join(arr: Column, sep: str = " ") -> Column:
    return F.coalesce(F.array_join(arr, sep), _e())


def _slice_from(arr: Column, start: int) -> Column:
    return F.slice(arr, start, F.greatest(F.size(arr) - (start - 1), F.lit(0)))


def letters(c: Column) -> Column:
    return F.regexp_replace(c, r"[^\p{L}]", "")


def is_upper_py(c: Column) -> Column:
    """``str.isupper()``."""
    return (c == F.upper(c)) & c.rlike(r"\p{Lu}")


# ------------------------------ N1 / N2 --------------------------------------
def strip_leading_titles(c: Column) -> Column:
    t = pstrip(c)
    t = F.regexp_replace(t, r"^(?:(?i:" + "|".join(TITLES) + r")\.?\s+)+", "")
    return pstrip(t)


def _fix_token(t: Column, hyphen: bool = True) -> Column:
    e = (F.when(F.upper(t).isin(*ROMAN_UPPER), F.upper(t))
         .when(t.rlike(INITIAL), F.upper(t))
         .when(t.rlike(O_PREFIX), F.concat(F.lit("O"), capitalize(F.substr(t, F.lit(3))))))
    if hyphen:
        e = e.when(t.contains("-"), F.array_join(
            F.transform(F.split(t, "-", -1), lambda p: _fix_token(p, hyphen=False)), "-"))
    return e.otherwise(capitalize(t))


def smart_title(c: Column) -> Column:
    return _join(F.transform(ws_tokens(c), lambda t: _fix_token(t)), " ")


class Stager:
    """Adds intermediate results as columns, one projection per stage.

    Referencing a staged column instead of re-embedding its expression keeps
    expression trees linear in size (chained array rules otherwise grow
    multiplicatively) and makes Catalyst evaluate each stage once per row.
    """

    def __init__(self, df: DataFrame, tag: str):
        self.df, self.tag, self.temps = df, tag, []

    def add(self, **exprs: Column) -> SimpleNamespace:
        refs, cols = {}, []
        for k, e in exprs.items():
            name = f"__{self.tag}_{k}"
            cols.append(e.alias(name))
            self.temps.append(name)
            refs[k] = F.col(name)
        self.df = self.df.select("*", *cols)
        return SimpleNamespace(**refs)

    def result(self) -> DataFrame:
        return self.df



def _deg_helpers(caps: bool):
    dmap = _degree_map()

    def key(t):
        return F.lower(F.regexp_replace(t, TOKEN_KEY_DROP, ""))

    def is_deg(t):
        cond = F.map_contains_key(dmap, key(t))
        if caps:
            cond = cond | (t.rlike(UPPERCASE_DEGREE) & ~in_list(F.upper(t), ROMAN_NUMERALS)
                           & (F.length(t) >= 2))
        return cond

    def deg_val(t):
        return F.coalesce(F.try_element_at(dmap, key(t)), F.upper(t))

    def toks(p):
        return F.filter(_runs(p, r"(?U)[^\s,]+"), lambda t: ~in_list(t, DASHES))
    return key, is_deg, deg_val, toks


def parse_degree_names(df: DataFrame, src: str, profile: str = "degree_dict") -> Stager:
    """N1/N2 on column ``src``; adds staged columns, final ones named
    ``__nm_{input_fullname, firstname, lastname, middlename, medical_degree, organization}``."""
    caps = profile == "degree_caps"
    key, is_deg, deg_val, toks = _deg_helpers(caps)
    st = Stager(df, "nm")
    raw = F.col(f"`{src}`").cast("string")
    a = st.add(raw=raw, s=F.replace(pstrip(raw), F.lit(";"), F.lit("")))
    b = st.add(parts=F.filter(F.transform(F.split(a.s, ",", -1), lambda p: pstrip(p)),
                              lambda p: p != ""))
    c = st.add(deg1=F.flatten(F.transform(_slice_from(b.parts, 2),
                                          lambda p: F.transform(F.filter(toks(p), is_deg), deg_val))),
               parts1=split_trailing(b.parts, lambda p: (F.size(toks(p)) > 0) & F.forall(toks(p), is_deg))[0])
    n1 = F.size(c.parts1)
    last_part = F.try_element_at(c.parts1, F.lit(-1))
    d = st.add(has_suffix=(n1 >= 3) & F.coalesce(in_list(key(last_part), NAME_SUFFIXES_N12), F.lit(False)),
               last_part=last_part)
    e = st.add(parts2=F.when(d.has_suffix, F.slice(c.parts1, 1, F.greatest(n1 - 1, F.lit(0))))
               .otherwise(c.parts1))
    n2 = F.size(e.parts2)
    if caps:
        right = strip_leading_titles(F.coalesce(_get(e.parts2, 2), _e()))
        rtoks = F.filter(ws_tokens(right), lambda t: ~in_list(t, DASHES))
        stoks = F.filter(ws_tokens(strip_leading_titles(_join(e.parts2))), lambda t: ~in_list(t, DASHES))
    else:
        right = strip_leading_titles(_join(_slice_from(e.parts2, 2)))
        rtoks = F.filter(_runs(right, r"(?U)[^\s,]+"), lambda t: ~in_list(t, DASHES))
        stoks = F.filter(_runs(strip_leading_titles(_join(e.parts2)), r"(?U)[^\s,]+"),
                         lambda t: ~in_list(t, DASHES))
    f = st.add(comma=(n2 >= 2) & a.s.contains(","))
    g = st.add(used=F.when(f.comma, rtoks).otherwise(stoks))
    h = st.add(kept=F.filter(g.used, lambda t: ~is_deg(t)),
               degs=F.array_distinct(F.concat(c.deg1, F.transform(F.filter(g.used, is_deg), deg_val))))
    nk = F.size(h.kept)
    c_last = F.concat(F.coalesce(_get(e.parts2, 1), _e()),
                      F.when(d.has_suffix, F.concat(F.lit(" "), F.upper(d.last_part))).otherwise(_e()))
    s_last = F.when(nk == 2, _get(h.kept, 2)).when(nk >= 3, F.try_element_at(h.kept, F.lit(-1))).otherwise(_e())
    s_mid = F.when(nk >= 3, _join(F.slice(h.kept, 2, F.greatest(nk - 2, F.lit(0))))).otherwise(_e())
    i = st.add(first=F.coalesce(_get(h.kept, 1), _e()),
               last=F.when(f.comma, c_last).otherwise(s_last),
               middle=F.when(f.comma, _join(_slice_from(h.kept, 2))).otherwise(s_mid),
               med=F.when(F.size(h.degs) > 0, F.array_join(h.degs, ", ")).otherwise(F.lit("NA")))
    empty = a.raw.isNull() | (a.s == "")
    inp = F.coalesce(a.raw, _e())
    org = is_organization_n12(inp)
    blank = empty | org

    def out(x):
        return F.when(blank, _e()).otherwise(x)
    st.add(input_fullname=inp,
           firstname=out(smart_title(i.first)), lastname=out(smart_title(i.last)),
           middlename=out(smart_title(i.middle)),
           medical_degree=F.when(org, _e()).when(empty, F.lit("NA")).otherwise(i.med),
           organization=F.when(org, inp).otherwise(_e()))
    return st


def is_organization_n12(c: Column) -> Column:
    pat = r"(?i)\b(" + "|".join(re.escape(k) for k in ORG_KEYWORDS_N12) + r")\b"
    return F.coalesce(c.rlike(pat) & (pstrip(c) != ""), F.lit(False))


# ----------------------------- N3 / N4 / N5 ----------------------------------
def is_designation(seg: Column, sep: str = r"[,\s]+") -> Column:
    """Credential-like segment (F6 with sep='\\s+', F7 with sep='[,\\s]+')."""
    s1 = F.regexp_replace(pstrip(seg), r"^\.+|\.+$", "")
    toks = _runs(s1, r"(?U)\S+" if sep == r"\s+" else r"(?U)[^,\s]+")
    lt = letters(s1)
    single = F.coalesce(_get(toks, 1), _e())
    one = (F.when(F.upper(single) != single, F.lit(False))
           .when(in_list(F.upper(single), COMMON_DESIGNATIONS), F.lit(True))
           .otherwise(F.length(single).between(2, 4)))
    return (F.when(seg.isNull() | (s1 == ""), F.lit(False))
            .when(in_list(F.upper(s1), COMMON_DESIGNATIONS), F.lit(True))
            .when(F.size(toks) == 0, F.lit(False))
            .when(F.length(lt) < 2, F.lit(False))
            .when(lt != F.upper(lt), F.lit(False))
            .when(F.size(toks) == 1, one)
            .otherwise(F.lit(True)))


def normalize_designation_segment(seg: Column) -> Column:
    """Segment -> credential tokens (split on commas then whitespace, dots
    stripped, ordered distinct)."""
    parts = F.flatten(F.transform(F.split(seg, ",", -1),
                                  lambda c: _runs(c, r"(?U)\S+")))
    parts = F.filter(F.transform(parts, lambda p: strip_chars(pstrip(p), ".")), lambda p: p != "")
    keep = F.filter(parts, lambda p: is_designation(p, r"[,\s]+")
                    | (p.rlike(r"\p{L}") & (F.upper(p) == p) & (F.length(letters(p)) >= 2))
                    | p.rlike(SHORT_CREDENTIAL))
    return F.array_distinct(keep)


def _split_tokens_clean(c: Column) -> Column:
    """Whitespace tokens with '.' and ',' stripped from both ends (blanks
    filtered before stripping, as the reference does)."""
    return F.transform(_runs(c, r"(?U)\S+"), lambda t: strip_chars(t, ".,"))


def _suffix_key(t: Column) -> Column:
    return F.regexp_replace(F.lower(t), r"\.+$", "")


def _prefix_key(t: Column) -> Column:
    return pstrip(strip_chars(F.lower(t), "."))


def looks_like_organization(c: Column) -> Column:
    t = F.lower(c)
    cond = F.lit(False)
    for kw in ORG_KEYWORDS_N3:
        cond = cond | t.contains(kw)
    return F.coalesce(cond, F.lit(False))


def remove_designation_tokens(part: Column, designations: Column) -> Column:
    """Drop credential-like tokens from a name part."""
    norm = F.transform(designations, lambda d: F.lower(strip_chars(pstrip(d), ".")))
    toks = F.filter(_split_tokens_clean(part), lambda t: t != "")
    keep = F.filter(toks, lambda t: ~(F.array_contains(norm, F.lower(t)) | t.rlike(UPPER_CREDENTIAL)
                                      | in_list(F.upper(t), COMMON_DESIGNATIONS)))
    return _join(keep)


def file_tag(file_name: Column, roster_file: str = ROSTER_FILENAME) -> Column:
    """Organization tag from the source file: the roster file's name, else ''."""
    return F.when(F.coalesce(pstrip(file_name) == roster_file, F.lit(False)), file_name).otherwise(_e())


def parse_credential_names(df: DataFrame, src: str, profile: str, file_col: str | None = None) -> Stager:
    """N3/N4/N5 on column ``src``; final staged columns ``__cr_{first_name,
    middle_name, last_name, designation, organization}``."""
    variant = {"credential_org": "n3", "credential_list": "n4", "credential_clean": "n5"}[profile]
    sep = r"\s+" if variant == "n3" else r"[,\s]+"

    def desig(x):
        return is_designation(x, sep)

    st = Stager(df, "cr")
    raw = F.col(f"`{src}`").cast("string")
    if variant == "n5":
        raw = F.coalesce(raw, _e())
    name0 = pstrip(strip_chars(pstrip(raw), ".")) if variant == "n3" else pstrip(raw)
    a = st.add(raw=raw, name0=name0)
    b = st.add(name=squash_ws(a.name0))
    c = st.add(pa=F.transform(F.split(b.name, ",", -1), lambda p: pstrip(p)), has_comma=b.name.contains(","))
    n = F.size(c.pa)
    empty_list = F.array().cast("array<string>")
    if variant == "n3":
        k_head, k_tail = split_trailing(_slice_from(c.pa, 2), desig)
        d1 = st.add(kk=F.size(k_head), k_tail=k_tail,
                    first_seg=F.coalesce(_get(c.pa, 1), _e()), second_seg=F.coalesce(_get(c.pa, 2), _e()))
        trailing = F.size(d1.k_tail) > 0
        d2 = st.add(core_tr=F.array_join(F.slice(c.pa, 1, d1.kk + 1), ","),
                    d_tr=F.array_join(F.transform(d1.k_tail, lambda t: F.replace(t, F.lit(" "), _e())), ","),
                    two_rule=(n == 2) & (desig(d1.second_seg) | ((F.size(ws_tokens(d1.first_seg)) > 1)
                                         & is_upper_py(F.replace(d1.second_seg, F.lit("."), _e())))))
        e = st.add(
            name_core=(F.when(~c.has_comma, b.name).when(trailing, d2.core_tr)
                       .when(d2.two_rule, d1.first_seg).otherwise(b.name)),
            comma_mode=(F.when(~c.has_comma, F.lit(False)).when(trailing, d2.core_tr.contains(","))
                        .when(d2.two_rule, F.lit(False)).otherwise(F.lit(True))),
            d0=(F.when(~c.has_comma, _e()).when(trailing, d2.d_tr)
                .when(d2.two_rule, F.replace(d1.second_seg, F.lit(" "), F.lit(","))).otherwise(_e())),
            dl0=empty_list)
    else:
        d1 = st.add(lead=c.has_comma & desig(F.coalesce(F.try_element_at(c.pa, F.lit(-1)), _e())),
                    run=split_trailing(c.pa, desig)[1])
        e = st.add(dl0=F.when(d1.lead, F.flatten(F.transform(d1.run, normalize_designation_segment)))
                   .otherwise(empty_list),
                   name_core=F.when(d1.lead, F.array_join(F.slice(c.pa, 1, F.greatest(n - 1, F.lit(0))), ","))
                   .otherwise(b.name),
                   comma_mode=c.has_comma, d0=_e())
    f = st.add(split_mode=e.comma_mode & e.name_core.contains(","),
               last_part=pstrip(F.substring_index(e.name_core, ",", 1)),
               rest_part=pstrip(F.regexp_extract(e.name_core, r"^[^,]*,(.*)$", 1)))
    tok = _split_tokens_clean if variant == "n5" else ws_tokens
    g = st.add(given=F.when(f.split_mode, tok(f.rest_part)).otherwise(tok(e.name_core)),
               last_tokens=F.when(f.split_mode, tok(f.last_part)).otherwise(empty_list))
    head, tail = split_trailing(g.given, desig)
    h = st.add(head=head, tail=tail)

    def is_suffix(t):
        return in_list(_suffix_key(t), NAME_SUFFIXES) & ~desig(t)
    if variant == "n3":
        dstr = F.when(F.size(h.tail) > 0, F.concat_ws(",", F.when(e.d0 != "", e.d0),
                                                        F.array_join(h.tail, ","))).otherwise(e.d0)
        dlist = e.dl0
    else:
        dstr = e.d0
        dlist = F.concat(e.dl0, F.flatten(F.transform(h.tail, normalize_designation_segment)))
    i = st.add(head_a=split_trailing(h.head, is_suffix)[0], dstr=dstr, dlist=dlist)
    if variant == "n3":
        lastg = F.try_element_at(h.head, F.lit(-1))
        pop1 = (F.size(h.head) > 0) & F.coalesce(is_suffix(lastg), F.lit(False))
        head_b = F.when(pop1, F.slice(h.head, 1, F.greatest(F.size(h.head) - 1, F.lit(0)))).otherwise(h.head)
    else:
        head_b = i.head_a
    na = F.size(i.head_a)
    j = F.coalesce(F.array_max(F.transform(F.slice(i.head_a, 1, F.greatest(na - 1, F.lit(0))),
                                           lambda t, k: F.when(in_list(_prefix_key(t), LAST_NAME_PREFIXES), F.lit(0))
                                           .otherwise(k + 1))), F.lit(0))
    jj = st.add(j=j, head_b=head_b)
    a_first = F.coalesce(_get(i.head_a, 1), _e())
    a_mid = F.when((na >= 3) & (jj.j >= 2), _join(F.slice(i.head_a, 2, F.greatest(jj.j - 1, F.lit(0))))) \
        .otherwise(_e())
    a_last = (F.when(na == 2, _get(i.head_a, 2))
              .when(na >= 3, _join(F.slice(i.head_a, jj.j + 1, F.greatest(na - jj.j, F.lit(0))))).otherwise(_e()))
    nb = F.size(jj.head_b)
    is_b = F.size(g.last_tokens) > 0
    empty = a.raw.isNull() | (a.name0 == "")

    def pick(bv, av):
        return F.when(empty, _e()).when(is_b, bv).otherwise(F.coalesce(av, _e()))
    k = st.add(first=pick(F.coalesce(_get(jj.head_b, 1), _e()), a_first),
               middle=pick(F.when(nb >= 2, _join(_slice_from(jj.head_b, 2))).otherwise(_e()), a_mid),
               last=pick(_join(g.last_tokens), a_last),
               desig_s=F.when(empty, _e()).otherwise(i.dstr),
               desig_l=F.when(empty, empty_list).otherwise(i.dlist))
    org_file = file_tag(F.col(f"`{file_col}`")) if file_col else _e()
    if variant == "n3":
        orig = F.coalesce(a.raw, _e())
        is_org = ((k.first == "") & (k.last == "")) | looks_like_organization(orig)
        st.add(first_name=F.when(is_org, _e()).otherwise(k.first),
               middle_name=F.when(is_org, _e()).otherwise(k.middle),
               last_name=F.when(is_org, _e()).otherwise(k.last),
               designation=k.desig_s,
               organization=F.when(is_org, pstrip(orig)).otherwise(_e()))
    elif variant == "n4":
        st.add(first_name=k.first, middle_name=k.middle, last_name=k.last,
               designation=_join(F.filter(F.transform(k.desig_l, lambda x: pstrip(x)),
                                          lambda x: x != ""), ","),
               organization=org_file)
    else:
        m = st.add(f0=remove_designation_tokens(k.first, k.desig_l),
                   m0=remove_designation_tokens(k.middle, k.desig_l),
                   l0=remove_designation_tokens(k.last, k.desig_l))
        mt = ws_tokens(m.m0)
        promote = (m.f0 == "") & (m.m0 != "")
        st.add(first_name=F.when(promote, F.coalesce(_get(mt, 1), _e())).otherwise(m.f0),
               middle_name=F.when(promote, _join(_slice_from(mt, 2))).otherwise(m.m0),
               last_name=m.l0,
               designation=_join(F.transform(F.filter(k.desig_l, lambda x: x != ""),
                                             lambda x: pstrip(x)), ","),
               organization=org_file)
    return st


# --------------------------------- N6 ----------------------------------------
_DEG6 = r"(?i)\b(?:" + "|".join(DEGREE_TERMS_N6) + r")\b"
_ORG6 = r"(?i)\b(?:" + "|".join(ORG_WORDS_N6) + r")\b"


def is_organization_n6(c: Column) -> Column:
    t = pstrip(c)
    words = F.regexp_extract_all(F.lower(t), F.lit(r"[A-Za-z0-9]+"), F.lit(0))
    strong = F.exists(words, lambda w: in_list(w, ORG_STRONG_TOKENS_N6))
    digits = F.length(F.regexp_replace(t, r"[^\p{Nd}]", "")) >= 2
    caps = is_upper_py(t) & (F.size(ws_tokens(t)) > 1)
    return F.coalesce(t.rlike(_ORG6) | strong | digits | caps, F.lit(False))


def detect_formats(df: DataFrame, src: str) -> Stager:
    """N6 on column ``src``; final staged columns ``__fm_{detected_format,
    first_name_parsed, middle_name_parsed, last_name_parsed,
    designation_parsed, organization_parsed}`` (NULL = none)."""
    null = F.lit(None).cast("string")
    st = Stager(df, "fm")
    raw = F.col(f"`{src}`").cast("string")
    a = st.add(raw=raw, s=squash_ws(pstrip(raw)))
    b = st.add(degs=F.array_distinct(F.transform(F.regexp_extract_all(a.s, F.lit(_DEG6), F.lit(0)),
                                                 lambda f: F.upper(F.regexp_replace(f, r"\.", "")))),
               nd=squash_ws(pstrip(F.regexp_replace(a.s, _DEG6, ""))))
    comma_re, paren_re = COMMA_FORMAT, PARENS_FORMAT
    c = st.add(desig=F.when(F.size(b.degs) > 0, F.array_join(b.degs, ", ")).otherwise(null),
               deg_sfx=F.when(F.size(b.degs) > 0, F.lit(",degree")).otherwise(_e()),
               left=pstrip(F.regexp_extract(b.nd, comma_re, 1)),
               right=pstrip(F.regexp_extract(b.nd, comma_re, 2)),
               before=pstrip(F.regexp_extract(b.nd, paren_re, 1)),
               inside=pstrip(F.regexp_extract(b.nd, paren_re, 2)),
               toks=ws_tokens(b.nd), nd_org=is_organization_n6(b.nd),
               is_comma=b.nd.rlike(comma_re), is_paren=b.nd.rlike(paren_re))
    d = st.add(rtoks=ws_tokens(c.right), ptoks=ws_tokens(c.before), left_org=is_organization_n6(c.left),
               paren_org=c.inside.rlike(_ORG6) | is_organization_n6(c.inside),
               tok1_org=is_organization_n6(F.coalesce(_get(c.toks, 1), _e())))
    nt, npt = F.size(c.toks), F.size(d.ptoks)
    last_tok = F.try_element_at(c.toks, F.lit(-1))
    sfx = (nt >= 4) & F.coalesce(in_list(strip_chars(F.lower(last_tok), "."), SUFFIXES_N6), F.lit(False))
    empty = a.raw.isNull() | (pstrip(a.raw) == "")
    # Each branch: (condition, format, first, middle, last, organization)
    branches = [
        (empty, F.lit("empty"), null, null, null, null),
        (c.nd_org, F.lit("organization"), null, null, null, b.nd),
        (c.is_comma & ~d.left_org, F.concat(F.lit("last_name,first_name"), c.deg_sfx), _get(d.rtoks, 1),
         F.when(F.size(d.rtoks) > 1, _join(_slice_from(d.rtoks, 2))), c.left, null),
        (c.is_comma, F.lit("organization"), null, null, null, b.nd),
        (c.is_paren & d.paren_org, F.lit("first_name last_name (organization)"), _get(d.ptoks, 1),
         F.when(npt >= 3, _join(F.slice(d.ptoks, 2, F.greatest(npt - 2, F.lit(0))))),
         F.when(npt == 2, _get(d.ptoks, 2)).when(npt >= 3, F.try_element_at(d.ptoks, F.lit(-1))), c.inside),
        (c.is_paren, F.lit("unknown_with_parenthesis"), null, null, null, b.nd),
        ((nt == 1) & d.tok1_org, F.lit("organization"), null, null, null, _get(c.toks, 1)),
        (nt == 1, F.lit("single_name"), _get(c.toks, 1), null, null, null),
        (nt == 2, F.concat(F.lit("first_name last_name"), c.deg_sfx), _get(c.toks, 1), null, _get(c.toks, 2),
         null),
        ((nt >= 3) & sfx, F.concat(F.lit("first middle last, suffix"), c.deg_sfx), _get(c.toks, 1),
         _join(F.slice(c.toks, 2, F.greatest(nt - 3, F.lit(0)))),
         F.concat(F.try_element_at(c.toks, F.lit(-2)), F.lit(" "), last_tok), null),
        (nt >= 3, F.concat(F.lit("first_name middle_name last_name"), c.deg_sfx), _get(c.toks, 1),
         _join(F.slice(c.toks, 2, F.greatest(nt - 2, F.lit(0)))), last_tok, null),
    ]

    def chain(idx, default):
        e = None
        for br in branches:
            e = F.when(br[0], br[idx]) if e is None else e.when(br[0], br[idx])
        return e.otherwise(default)
    st.add(detected_format=chain(1, F.lit("other")), first_name_parsed=chain(2, null),
           middle_name_parsed=chain(3, null), last_name_parsed=chain(4, null),
           designation_parsed=F.when(empty, null).otherwise(c.desig), organization_parsed=chain(5, null))
    return st
