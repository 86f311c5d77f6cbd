"""DuckDB oracle SQL for the name profiles.

Written from the rule descriptions with DuckDB list lambdas: loops that pop
trailing tokens become "index of the last token that does not match" via
``list_transform(l, lambda x, i: ...)`` + ``list_max``; ordered de-duplication
keeps the first position of each value.
"""
from __future__ import annotations

import re

from . import inputs
from .oracle_ages import q, source

DASH = "('-', '–', '—')"
COMMON = ["CEO", "CTO", "CFO", "COO", "VP", "SVP", "AVP", "MD", "HR", "QA", "QA LEAD", "TEAM LEAD", "LEAD",
          "ENGINEER", "SR ENGINEER", "SENIOR ENGINEER", "MANAGER", "SR MANAGER", "SENIOR MANAGER", "DIRECTOR",
          "SR DIRECTOR", "SENIOR DIRECTOR", "PRESIDENT", "CHAIRMAN", "CHAIRWOMAN", "CHIEF", "ARCHITECT",
          "ANALYST", "PA", "DO", "OT", "PT", "NP", "FNP", "ARNP", "APRN", "RN", "LPN", "MBA", "CPA", "FNP-C",
          "PA-C", "RN BSN", "BSN", "DNP"]
ALIASES = {
    "md": "MD", "phd": "PhD", "do": "DO", "rn": "RN", "dds": "DDS", "dc": "DC", "mbbs": "MBBS", "dm": "DM",
    "pa": "PA", "pac": "PA-C", "aprn": "APRN", "crna": "CRNA", "np": "NP", "npc": "NP-C", "dpt": "DPT",
    "dpm": "DPM", "pt": "PT", "otr": "OTR", "otr/l": "OTR/L", "aud": "AUD", "msw": "MSW", "rnfa": "RNFA",
    "dnp": "DNP", "fnp": "FNP", "cnm": "CNM", "cns": "CNS", "rt": "RT", "rtt": "RTT", "rd": "RD", "rdn": "RDN",
    "rdms": "RDMS", "rdcs": "RDCS", "msc": "MSC", "ms": "MS", "ma": "MA", "mba": "MBA", "mph": "MPH",
    "obgyn": "OBGYN",
}


def lst(xs) -> str:
    return "(" + ", ".join(q(x) for x in xs) + ")"


def strip(x: str) -> str:
    return rf"regexp_replace({x}, '^\s+|\s+$', '', 'g')"


def words(x: str) -> str:
    """str.split()"""
    return rf"list_filter(string_split_regex({x}, '\s+'), lambda w_: w_ <> '')"


def join(x: str, sep: str = " ") -> str:
    return f"array_to_string({x}, {q(sep)})"


def odistinct(x: str) -> str:
    return f"list_filter({x}, lambda d_, di_: list_position({x}, d_) = di_)"


def head_until(x: str, pred_false_idx: str) -> str:
    """index (1-based) of the last element NOT matching; pred given as lambda body on e_."""
    return f"coalesce(list_max(list_transform({x}, lambda e_, ei_: CASE WHEN {pred_false_idx} THEN 0 ELSE ei_ END)), 0)"


def cap(x: str) -> str:
    return f"(upper(left({x}, 1)) || lower(substr({x}, 2)))"


# ------------------------------ N1 / N2 --------------------------------------
def _fix(t: str, hyphen: bool = True) -> str:
    body = (f"CASE WHEN upper({t}) IN ('II', 'III', 'IV', 'VI') THEN upper({t}) "
            f"WHEN regexp_full_match({t}, '[A-Za-z]\\.') THEN upper({t}) "
            f"WHEN regexp_matches({t}, '^O[Oo]+') THEN 'O' || {cap(f'substr({t}, 3)')} ")
    if hyphen:
        body += (f"WHEN contains({t}, '-') THEN array_to_string(list_transform(string_split({t}, '-'), "
                 f"lambda h_: {_fix('h_', False)}), '-') ")
    return body + f"ELSE {cap(t)} END"


def smart_title(x: str) -> str:
    return f"array_to_string(list_transform({words(x)}, lambda st_: {_fix('st_')}), ' ')"


def _key(t: str) -> str:
    return f"lower(regexp_replace({t}, '[\\s\\-.]', '', 'g'))"


def _is_deg(t: str, caps: bool) -> str:
    cond = f"({_key(t)} IN {lst(ALIASES)}"
    if caps:
        cond += (f" OR (regexp_full_match({t}, '[A-Z][A-Z\\-]+') AND upper({t}) NOT IN "
                 f"('I', 'II', 'III', 'IV', 'V', 'VI') AND length({t}) >= 2)")
    return cond + ")"


def _deg_val(t: str) -> str:
    whens = " ".join(f"WHEN {q(k)} THEN {q(v)}" for k, v in ALIASES.items())
    return f"(CASE {_key(t)} {whens} ELSE upper({t}) END)"


def _toks(p: str) -> str:
    return (f"list_filter(string_split_regex({strip(p)}, '[\\s,]+'), "
            f"lambda tk_: tk_ <> '' AND tk_ NOT IN {DASH})")


def _titles(x: str) -> str:
    return strip(f"regexp_replace({strip(x)}, '^(?:(?i:dr|mr|mrs|ms|prof|sir|madam|miss)\\.?\\s+)+', '')")


def degree_names(profile: str) -> str:
    caps = profile == "degree_caps"
    isd = lambda t: _is_deg(t, caps)
    all_deg = f"(len({_toks('e_')}) > 0 AND len(list_filter({_toks('e_')}, lambda ad_: NOT {isd('ad_')})) = 0)"
    if caps:
        right = _titles("coalesce(parts2[2], '')")
        rtoks = f"list_filter({words(right)}, lambda r_: r_ NOT IN {DASH})"
        stoks = f"list_filter({words(_titles(join('parts2')))}, lambda r_: r_ NOT IN {DASH})"
    else:
        right = _titles(join("parts2[2:]"))
        rtoks = f"list_filter(string_split_regex({right}, '[\\s,]+'), lambda r_: r_ <> '' AND r_ NOT IN {DASH})"
        stoks = (f"list_filter(string_split_regex({_titles(join('parts2'))}, '[\\s,]+'), "
                 f"lambda r_: r_ <> '' AND r_ NOT IN {DASH})")
    org = r"(?i)\b(health|MedCare|Medicine|Clinic|Hospital|Medical|University|WakeMed)\b"
    return f"""
WITH src AS ({source('provider_text', inputs.provider_text_sql)}),
a AS (SELECT id, header_col_value AS raw, replace({strip('header_col_value')}, ';', '') AS s FROM src),
b AS (SELECT *, list_filter(list_transform(string_split_regex(s, '\\s*,\\s*'), lambda p_: {strip('p_')}),
                            lambda p_: p_ <> '') AS parts FROM a),
c AS (SELECT *, flatten(list_transform(parts[2:], lambda pp_: list_transform(list_filter({_toks('pp_')},
                 lambda dt_: {isd('dt_')}), lambda dv_: {_deg_val('dv_')}))) AS deg1,
             parts[1:{head_until('parts', all_deg)}] AS parts1 FROM b),
d AS (SELECT *, len(parts1) >= 3 AND coalesce({_key('parts1[-1]')} IN ('jr', 'sr', 'ii', 'iii', 'iv', 'v', 'vi'), false)
               AS has_sfx FROM c),
e AS (SELECT *, CASE WHEN has_sfx THEN parts1[1:len(parts1) - 1] ELSE parts1 END AS parts2 FROM d),
f AS (SELECT *, len(parts2) >= 2 AND contains(s, ',') AS comma FROM e),
g AS (SELECT *, CASE WHEN comma THEN {rtoks} ELSE {stoks} END AS used FROM f),
h AS (SELECT *, list_filter(used, lambda u_: NOT {isd('u_')}) AS kept,
             list_concat(deg1, list_transform(list_filter(used, lambda u_: {isd('u_')}), lambda u_: {_deg_val('u_')}))
               AS degs0 FROM g),
i AS (SELECT *, {odistinct('degs0')} AS degs, len(kept) AS nk FROM h),
j AS (SELECT *, coalesce(kept[1], '') AS first,
        CASE WHEN comma THEN coalesce(parts2[1], '') || CASE WHEN has_sfx THEN ' ' || upper(parts1[-1]) ELSE '' END
             WHEN nk = 2 THEN kept[2] WHEN nk >= 3 THEN kept[-1] ELSE '' END AS last,
        CASE WHEN comma THEN {join('kept[2:]')} WHEN nk >= 3 THEN {join('kept[2:nk - 1]')} ELSE '' END AS middle,
        CASE WHEN len(degs) > 0 THEN {join('degs', ', ')} ELSE 'NA' END AS med,
        raw IS NULL OR s = '' AS empty,
        coalesce(raw, '') AS inp FROM i),
k AS (SELECT *, coalesce(regexp_matches(inp, {q(org)}), false) AND {strip('inp')} <> '' AS org FROM j)
SELECT id, inp AS input_fullname,
       CASE WHEN empty OR org THEN '' ELSE {smart_title('first')} END AS firstname,
       CASE WHEN empty OR org THEN '' ELSE {smart_title('last')} END AS lastname,
       CASE WHEN empty OR org THEN '' ELSE {smart_title('middle')} END AS middlename,
       CASE WHEN org THEN '' WHEN empty THEN 'NA' ELSE med END AS medical_degree,
       CASE WHEN org THEN inp ELSE '' END AS organization
FROM k
"""


# ----------------------------- N3 / N4 / N5 ----------------------------------
def is_desig(seg: str, sep: str) -> str:
    s1 = f"trim({strip(seg)}, '.')"
    toks = f"list_filter(string_split_regex({s1}, {q(sep)}), lambda dz_: dz_ <> '')"
    lt = f"regexp_replace({s1}, '[^A-Za-z]', '', 'g')"
    one = (f"CASE WHEN upper({toks}[1]) <> {toks}[1] THEN false WHEN upper({toks}[1]) IN {lst(COMMON)} THEN true "
           f"ELSE length({toks}[1]) BETWEEN 2 AND 4 END")
    return (f"(CASE WHEN {seg} IS NULL OR {s1} = '' THEN false WHEN upper({s1}) IN {lst(COMMON)} THEN true "
            f"WHEN len({toks}) = 0 THEN false WHEN length({lt}) < 2 THEN false WHEN {lt} <> upper({lt}) THEN false "
            f"WHEN len({toks}) = 1 THEN {one} ELSE true END)")


def normalize_seg(seg: str) -> str:
    parts = (f"list_filter(list_transform(flatten(list_transform(string_split({seg}, ','), lambda nc_: "
             f"list_filter(string_split_regex({strip('nc_')}, '\\s+'), lambda np_: np_ <> ''))), "
             f"lambda nq_: trim({strip('nq_')}, '.')), lambda nr_: nr_ <> '')")
    keep = (f"list_filter({parts}, lambda nk_: {is_desig('nk_', '[,\\s]+')} OR (regexp_matches(nk_, '[A-Za-z]') "
            f"AND upper(nk_) = nk_ AND length(regexp_replace(nk_, '[^A-Za-z]', '', 'g')) >= 2) "
            f"OR regexp_full_match(nk_, '[A-Za-z]{{2,4}}'))")
    return odistinct(keep)


def _clean_tokens(x: str) -> str:
    return (f"list_transform(list_filter(string_split_regex({x}, '\\s+'), lambda ct_: {strip('ct_')} <> ''), "
            f"lambda ct_: trim({strip('ct_')}, '.,'))")


def credential_names(profile: str) -> str:
    v = {"credential_org": "n3", "credential_list": "n4", "credential_clean": "n5"}[profile]
    sep = "\\s+" if v == "n3" else "[,\\s]+"
    D = lambda x: is_desig(x, sep)
    sfx = lambda x: f"(regexp_replace(lower({x}), '\\.+$', '') IN {lst(['jr', 'sr', 'ii', 'iii', 'iv', 'v', 'phd', 'md', 'dds', 'esq'])} AND NOT {D(x)})"  # noqa: E501
    prefixes = lst(["de", "del", "de la", "da", "di", "van", "von", "der", "du", "la", "le", "st", "st.", "mac"])
    tok = _clean_tokens if v == "n5" else words
    raw = "coalesce(header_col_value, '')" if v == "n5" else "header_col_value"
    name0 = f"{strip(f'trim({strip(raw)}, {q(chr(46))})')}" if v == "n3" else strip(raw)
    if v == "n3":
        comma_cte = f"""
c1 AS (SELECT *, pa[2:] AS tailp FROM c),
c2 AS (SELECT *, {head_until('tailp', D('e_'))} AS kk FROM c1),
c3 AS (SELECT *, tailp[kk + 1:] AS k_tail, coalesce(pa[1], '') AS fseg, coalesce(pa[2], '') AS sseg FROM c2),
c4 AS (SELECT *, len(k_tail) > 0 AS has_trail, array_to_string(pa[1:kk + 1], ',') AS core_tr,
              array_to_string(list_transform(k_tail, lambda kt_: replace(kt_, ' ', '')), ',') AS d_tr,
              len(pa) = 2 AND ({D('sseg')} OR (len({words('fseg')}) > 1
                 AND replace(sseg, '.', '') = upper(replace(sseg, '.', ''))
                 AND regexp_matches(replace(sseg, '.', ''), '[A-Z]'))) AS two_rule FROM c3),
e AS (SELECT *,
        CASE WHEN NOT has_comma THEN name WHEN has_trail THEN core_tr WHEN two_rule THEN fseg ELSE name END AS name_core,
        CASE WHEN NOT has_comma THEN false WHEN has_trail THEN contains(core_tr, ',') WHEN two_rule THEN false
             ELSE true END AS comma_mode,
        CASE WHEN NOT has_comma THEN '' WHEN has_trail THEN d_tr WHEN two_rule THEN replace(sseg, ' ', ',')
             ELSE '' END AS d0,
        []::VARCHAR[] AS dl0 FROM c4),"""
    else:
        comma_cte = f"""
e AS (SELECT *,
        CASE WHEN has_comma AND {D("coalesce(pa[-1], '')")}
             THEN flatten(list_transform(pa[{head_until('pa', D('e_'))} + 1:], lambda ns_: {normalize_seg('ns_')}))
             ELSE []::VARCHAR[] END AS dl0,
        CASE WHEN has_comma AND {D("coalesce(pa[-1], '')")} THEN array_to_string(pa[1:len(pa) - 1], ',')
             ELSE name END AS name_core,
        has_comma AS comma_mode, '' AS d0 FROM c),"""
    if v == "n3":
        d_a = "CASE WHEN len(tail) > 0 THEN concat_ws(',', CASE WHEN d0 <> '' THEN d0 END, array_to_string(tail, ',')) ELSE d0 END"
        dl_a = "dl0"
        head_b = (f"CASE WHEN len(head) > 0 AND coalesce({sfx('head[-1]')}, false) THEN head[1:len(head) - 1] "
                  f"ELSE head END")
    else:
        d_a = "d0"
        dl_a = f"list_concat(dl0, flatten(list_transform(tail, lambda nt_: {normalize_seg('nt_')})))"
        head_b = "head_a"
    if v == "n3":
        final = f"""
SELECT CASE WHEN is_org THEN '' ELSE first END AS first_name, CASE WHEN is_org THEN '' ELSE middle END AS middle_name,
       CASE WHEN is_org THEN '' ELSE last END AS last_name, desig AS designation,
       CASE WHEN is_org THEN {strip('orig')} ELSE '' END AS organization, id, file_name
FROM (SELECT *, coalesce(header_col_value, '') AS orig,
             (first = '' AND last = '') OR {' OR '.join(f"contains(lower(coalesce(header_col_value, '')), {q(k)})" for k in ['inc', 'llc', 'ltd', 'corp', 'company', 'co.', 'bank', 'hospital', 'university', 'foundation', '&', 'association', 'society'])} AS is_org
      FROM z)"""
    else:
        org = (f"CASE WHEN coalesce({strip('file_name')} = {q(inputs.ROSTER_FILE)}, false) THEN file_name ELSE '' END")
        if v == "n4":
            final = f"""
SELECT first AS first_name, middle AS middle_name, last AS last_name,
       array_to_string(list_filter(list_transform(dlist, lambda x_: {strip('x_')}), lambda x_: x_ <> ''), ',')
         AS designation, {org} AS organization, id, file_name
FROM z"""
        else:
            def rm(part):
                norm = f"list_transform(dlist, lambda dd_: lower(trim({strip('dd_')}, '.')))"
                kept = (f"list_filter(list_filter({_clean_tokens(part)}, lambda rt_: rt_ <> ''), lambda rt_: NOT "
                        f"(list_contains({norm}, lower(rt_)) OR regexp_full_match(rt_, '[A-Z]{{2,4}}') "
                        f"OR upper(rt_) IN {lst(COMMON)}))")
                return f"array_to_string({kept}, ' ')"
            final = f"""
SELECT coalesce(header_col_value, '') AS header_col_value,
       CASE WHEN f0 = '' AND m0 <> '' THEN coalesce({words('m0')}[1], '') ELSE f0 END AS first_name,
       CASE WHEN f0 = '' AND m0 <> '' THEN array_to_string({words('m0')}[2:], ' ') ELSE m0 END AS middle_name,
       l0 AS last_name,
       array_to_string(list_transform(list_filter(dlist, lambda x_: x_ <> ''), lambda x_: {strip('x_')}), ',')
         AS designation, {org} AS organization, id, file_name
FROM (SELECT *, {rm('first')} AS f0, {rm('middle')} AS m0, {rm('last')} AS l0 FROM z)"""
    return f"""
WITH src AS ({source('provider_text', inputs.provider_text_sql)}),
a AS (SELECT *, {name0} AS name0 FROM src),
b AS (SELECT *, regexp_replace(name0, '\\s+', ' ', 'g') AS name FROM a),
c AS (SELECT *, list_transform(string_split(name, ','), lambda sp_: {strip('sp_')}) AS pa,
             contains(name, ',') AS has_comma FROM b),{comma_cte}
f AS (SELECT *, comma_mode AND contains(name_core, ',') AS split_mode,
             {strip("split_part(name_core, ',', 1)")} AS last_part,
             {strip("regexp_extract(name_core, '^[^,]*,(.*)$', 1)")} AS rest_part FROM e),
g AS (SELECT *, CASE WHEN split_mode THEN {tok('rest_part')} ELSE {tok('name_core')} END AS given,
             CASE WHEN split_mode THEN {tok('last_part')} ELSE []::VARCHAR[] END AS last_tokens FROM f),
h0 AS (SELECT *, {head_until('given', D('e_'))} AS hk FROM g),
h AS (SELECT *, given[1:hk] AS head, given[hk + 1:] AS tail FROM h0),
i0 AS (SELECT *, {d_a} AS dstr, {dl_a} AS dlist0, head[1:{head_until('head', sfx('e_'))}] AS head_a FROM h),
i AS (SELECT *, {head_b} AS head_b, len(head_a) AS na FROM i0),
j AS (SELECT *, coalesce(list_max(list_transform(head_a[1:greatest(na - 1, 0)], lambda pf_, pi_:
                  CASE WHEN trim(trim(lower(pf_), '.')) IN {prefixes} THEN 0 ELSE pi_ END)), 0) AS jx FROM i),
z AS (SELECT *,
        CASE WHEN header_col_value IS NULL OR name0 = '' THEN '' WHEN len(last_tokens) > 0 THEN coalesce(head_b[1], '')
             ELSE coalesce(head_a[1], '') END AS first,
        CASE WHEN header_col_value IS NULL OR name0 = '' THEN '' WHEN len(last_tokens) > 0
               THEN CASE WHEN len(head_b) >= 2 THEN array_to_string(head_b[2:], ' ') ELSE '' END
             WHEN na >= 3 AND jx >= 2 THEN array_to_string(head_a[2:jx], ' ') ELSE '' END AS middle,
        CASE WHEN header_col_value IS NULL OR name0 = '' THEN '' WHEN len(last_tokens) > 0 THEN array_to_string(last_tokens, ' ')
             WHEN na = 2 THEN head_a[2] WHEN na >= 3 THEN array_to_string(head_a[jx + 1:], ' ') ELSE '' END AS last,
        CASE WHEN header_col_value IS NULL OR name0 = '' THEN '' ELSE dstr END AS desig,
        CASE WHEN header_col_value IS NULL OR name0 = '' THEN []::VARCHAR[] ELSE dlist0 END AS dlist
      FROM j){final}
"""


# --------------------------------- N6 ----------------------------------------
DEG6 = (r"(?i)\b(?:MD|MBBS|DO|PhD|MSc|MS|MBA|RN|R\.?N\.?|PA|DVM|OTR|CHT|DDS|DMD|BSc|BPharm|FRCS|FRCP|LPC|CPA|Esq)\b")
ORG6 = (r"(?i)\b(?:hospital|clinic|center|centre|institute|school|college|laboratory|laboratories|labs|trust|"
        r"clinic|pharmacy|care|health|healthcare|medical|association|hospitality|lab|university)\b")
STRONG6 = ["ltd", "pvt", "inc", "company", "co", "llc", "corp", "clinic", "hospital", "institute", "college",
           "university", "trust"]


def is_org6(x: str) -> str:
    t = strip(x)
    return (f"(coalesce(regexp_matches({t}, {q(ORG6)}), false) "
            f"OR list_has_any(regexp_extract_all(lower({t}), '[A-Za-z0-9]+'), {'[' + ', '.join(q(w) for w in STRONG6) + ']'}) "
            f"OR length(regexp_replace({t}, '[^0-9]', '', 'g')) >= 2 "
            f"OR ({t} = upper({t}) AND regexp_matches({t}, '[A-Z]') AND len({words(t)}) > 1))")


def format_detect() -> str:
    comma_re = r"^\s*([^,]+)\s*,\s*(.+)$"
    paren_re = r"^(.+?)\s*\((.+)\)\s*$"
    null = "CAST(NULL AS VARCHAR)"
    branches = [
        ("empty", "'empty'", null, null, null, null),
        ("nd_org", "'organization'", null, null, null, "nd"),
        ("is_comma AND NOT left_org", "'last_name,first_name' || sfx", "rtoks[1]",
         "CASE WHEN len(rtoks) > 1 THEN array_to_string(rtoks[2:], ' ') END", "lft", null),
        ("is_comma", "'organization'", null, null, null, "nd"),
        ("is_paren AND paren_org", "'first_name last_name (organization)'", "ptoks[1]",
         "CASE WHEN len(ptoks) >= 3 THEN array_to_string(ptoks[2:len(ptoks) - 1], ' ') END",
         "CASE WHEN len(ptoks) = 2 THEN ptoks[2] WHEN len(ptoks) >= 3 THEN ptoks[-1] END", "inside"),
        ("is_paren", "'unknown_with_parenthesis'", null, null, null, "nd"),
        ("nt = 1 AND tok1_org", "'organization'", null, null, null, "toks[1]"),
        ("nt = 1", "'single_name'", "toks[1]", null, null, null),
        ("nt = 2", "'first_name last_name' || sfx", "toks[1]", null, "toks[2]", null),
        ("nt >= 4 AND trim(lower(toks[-1]), '.') IN ('jr', 'sr', 'ii', 'iii', 'iv')",
         "'first middle last, suffix' || sfx", "toks[1]", "array_to_string(toks[2:nt - 2], ' ')",
         "toks[-2] || ' ' || toks[-1]", null),
        ("nt >= 3", "'first_name middle_name last_name' || sfx", "toks[1]",
         "array_to_string(toks[2:nt - 1], ' ')", "toks[-1]", null),
    ]

    def chain(idx, default):
        return "CASE " + " ".join(f"WHEN {b[0]} THEN {b[idx]}" for b in branches) + f" ELSE {default} END"
    return f"""
WITH src AS ({source('provider_text', inputs.provider_text_sql)}),
a AS (SELECT *, regexp_replace({strip('header_col_value')}, '\\s+', ' ', 'g') AS s FROM src),
b AS (SELECT *, {odistinct(f"list_transform(regexp_extract_all(s, {q(DEG6)}), lambda f_: upper(replace(f_, '.', '')))")}
               AS degs,
             regexp_replace({strip(f"regexp_replace(s, {q(DEG6)}, '', 'g')")}, '\\s+', ' ', 'g') AS nd FROM a),
c AS (SELECT *, CASE WHEN len(degs) > 0 THEN array_to_string(degs, ', ') END AS desig,
             CASE WHEN len(degs) > 0 THEN ',degree' ELSE '' END AS sfx,
             {strip(f"regexp_extract(nd, {q(comma_re)}, 1)")} AS lft,
             {strip(f"regexp_extract(nd, {q(comma_re)}, 2)")} AS rgt,
             {strip(f"regexp_extract(nd, {q(paren_re)}, 1)")} AS before,
             {strip(f"regexp_extract(nd, {q(paren_re)}, 2)")} AS inside,
             {words('nd')} AS toks, {is_org6('nd')} AS nd_org,
             regexp_matches(nd, {q(comma_re)}) AS is_comma, regexp_matches(nd, {q(paren_re)}) AS is_paren,
             header_col_value IS NULL OR {strip('header_col_value')} = '' AS empty FROM b),
d AS (SELECT *, {words('rgt')} AS rtoks, {words('before')} AS ptoks, {is_org6('lft')} AS left_org,
             coalesce(regexp_matches(inside, {q(ORG6)}), false) OR {is_org6('inside')} AS paren_org,
             {is_org6("coalesce(toks[1], '')")} AS tok1_org, len(toks) AS nt FROM c)
SELECT id, header_col_value, file_name,
       {chain(1, "'other'")} AS detected_format, {chain(2, null)} AS first_name_parsed,
       {chain(3, null)} AS middle_name_parsed, {chain(4, null)} AS last_name_parsed,
       CASE WHEN empty THEN NULL ELSE desig END AS designation_parsed, {chain(5, null)} AS organization_parsed
FROM d
"""


def format_counts() -> str:
    return f"SELECT detected_format, count(*) AS n_rows FROM ({format_detect()}) GROUP BY detected_format"


def kind_counts() -> str:
    return f"""
SELECT CASE WHEN organization <> '' THEN 'organization'
            WHEN first_name <> '' OR last_name <> '' THEN 'person' ELSE 'ambiguous' END AS kind,
       count(*) AS n_rows
FROM ({credential_names('credential_org')}) GROUP BY 1
"""


def issues() -> str:
    punct = " OR ".join(f"regexp_matches({c}, '[,;/]')" for c in ["first_name", "middle_name", "last_name"])
    return f"""
SELECT id, header_col_value, reason FROM (
  SELECT *, CASE WHEN {strip("coalesce(header_col_value, '')")} = '' THEN 'empty input'
                 WHEN first_name = '' AND last_name = '' AND organization = ''
                   THEN 'no person name or organization found'
                 WHEN {punct} THEN 'punctuation left in a name part' END AS reason
  FROM ({credential_names('credential_clean')}))
WHERE reason IS NOT NULL
"""


_ = re
