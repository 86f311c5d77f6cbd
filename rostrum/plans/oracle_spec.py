"""DuckDB SQL of profile ``spec`` and of the confidences: tokens are rows, joined to the dictionary and regrouped."""
from __future__ import annotations

from ..functions.spec_names import CONFIDENCE, DESIGNATIONS, ORGANIZATION_KEYWORDS, TITLES, UNASSIGNED_COSTS
from ..operators.names import NAME_PARTS, PUNCTUATION_COSTS, RULE_CONFIDENCE
from . import inputs, oracle_names
from .oracle_ages import q, source


def strip(x: str, chars: str = r"\s") -> str:
    return f"regexp_replace({x}, '^[{chars}]+|[{chars}]+$', '', 'g')"


def built_in() -> str:
    rows = [(w, kind) for kind, words in (("designation", DESIGNATIONS), ("organization", ORGANIZATION_KEYWORDS), ("title", TITLES))
            for w in words]
    return "SELECT * FROM (VALUES " + ", ".join(f"({q(w)}, {q(k)}, {q(w)})" for w, k in rows) + ") AS d(token, kind, canonical)"


def percents(column: str, table: dict[str, int]) -> str:
    return f"(CASE {column} " + " ".join(f"WHEN {q(k)} THEN {v}" for k, v in table.items()) + " ELSE 0 END)"


def _taken(n: int) -> str:
    """Titles before and designations behind the tokens of person ``n``: t, h (names) and e of it."""
    x = f"p{n}"
    return f"""
s{n} AS (SELECT *, CASE WHEN coalesce(list_position(list_transform({x}, lambda z: z.title), false), 0) = 0 THEN greatest(len({x}) - 1, 0)
                   ELSE list_position(list_transform({x}, lambda z: z.title), false) - 1 END AS skip{n} FROM {f's{n - 1}' if n > 1 else 'r'}),
u{n} AS (SELECT *, {x}[1:skip{n}] AS t{n}, {x}[skip{n} + 1:skip{n} + 1] AS f{n}, {x}[skip{n} + 2:] AS rest{n} FROM s{n}),
v{n} AS (SELECT *, coalesce(list_max(list_transform(rest{n}, lambda z, i: CASE WHEN z.desig IS NOT NULL THEN 0 ELSE i END)), 0) AS k{n}
         FROM u{n}),
w{n} AS (SELECT id, list_transform(list_concat(f{n}, rest{n}[1:k{n}]), lambda z: z.token) AS h{n}, t{n}, rest{n}[k{n} + 1:] AS e{n} FROM v{n})"""


def spec(dictionary: str | None = None) -> str:
    marks = "list_concat(list_concat(list_concat(t1, e1), list_concat(t2, e2)), creds)"
    return f"""
WITH src AS ({source('spec_text', inputs.spec_text_sql)}),
entries AS ({dictionary or built_in()}),
dict AS (SELECT lower(replace({strip('token')}, '.', '')) AS key,
                min(coalesce(canonical, token)) FILTER (lower({strip('kind')}) = 'designation') AS canonical,
                bool_or(lower({strip('kind')}) = 'organization') AS keyword, bool_or(lower({strip('kind')}) = 'title') AS title
         FROM entries GROUP BY 1 HAVING lower(replace({strip('token')}, '.', '')) <> ''),
cut AS (SELECT id, string_split(regexp_replace(coalesce(header_col_value, ''), '\\s+', ' ', 'g'), ',') AS l FROM src),
p AS (SELECT id, unnest(l) AS raw, generate_subscripts(l, 1) AS part FROM cut),
p2 AS (SELECT id, part, {strip(strip('raw'), ';')} AS text,
              list_filter(list_transform(regexp_extract_all(raw, '[^\\s;/()]+'), lambda t: {strip('t', '.,;')}), lambda t: t <> '') AS l FROM p),
tok AS (SELECT id, part, text, unnest(l) AS token, generate_subscripts(l, 1) AS place FROM p2),
tag AS (SELECT t.*, replace(token, '.', '') AS plain, d.canonical, coalesce(d.keyword, false) AS keyword, coalesce(d.title, false) AS title
        FROM tok t LEFT JOIN dict d ON d.key = lower(replace(t.token, '.', ''))),
tagged AS (SELECT *, CASE WHEN plain = replace(canonical, '.', '') OR plain = upper(plain) OR plain = lower(plain) THEN canonical END AS desig
           FROM tag),
parts AS (SELECT id, part, text, list({{'token': token, 'desig': desig, 'title': title}} ORDER BY place) AS toks,
                 CASE WHEN regexp_matches(text, '[/()]') OR bool_or(keyword) THEN 'organization'
                      WHEN bool_and(desig IS NOT NULL) THEN 'credential' ELSE 'person' END AS kind
          FROM tagged GROUP BY id, part, text),
whole AS (SELECT id, arg_min(kind, part) AS first_kind, count(*) FILTER (kind = 'person') AS persons,
                 coalesce(list(toks ORDER BY part) FILTER (kind = 'person'), []) AS people,
                 coalesce(list(text ORDER BY part) FILTER (kind = 'person'), []) AS people_texts,
                 coalesce(list(text ORDER BY part) FILTER (kind = 'organization'), []) AS orgs,
                 coalesce(flatten(list(toks ORDER BY part) FILTER (kind = 'credential')), []) AS creds
          FROM parts GROUP BY id),
r AS (SELECT *, coalesce(people[1], creds[1:0]) AS p1, coalesce(people[2], creds[1:0]) AS p2 FROM whole),{_taken(1)},{_taken(2)},
j AS (SELECT r.*, h1, t1, e1, h2, t2, e2, len(h1) AS n1 FROM r JOIN w1 ON w1.id = r.id JOIN w2 ON w2.id = r.id),
ruled AS (SELECT s.id, s.header_col_value, j.* EXCLUDE (id),
                 CASE WHEN j.id IS NULL THEN 'empty'
                      WHEN first_kind = 'organization' OR (persons = 0 AND len(orgs) > 0) THEN 'organization'
                      WHEN persons = 0 THEN 'credential only' WHEN persons >= 2 THEN 'last, first' WHEN n1 = 1 THEN 'single name'
                      WHEN n1 = 2 THEN 'first last' WHEN n1 = 3 AND regexp_full_match(h1[3], '[A-Z]{{1,2}}') THEN 'last first initials'
                      ELSE 'first middle last' END AS parse_rule
          FROM src s LEFT JOIN j ON j.id = s.id),
done AS (SELECT *, CASE WHEN parse_rule <> 'organization' THEN nullif(array_to_string(people_texts[3:], ', '), '') END AS unassigned,
                list_transform(list_filter({marks}, lambda z: z.desig IS NOT NULL), lambda z: z.desig) AS marks FROM ruled)
SELECT id, header_col_value,
       nullif(CASE parse_rule WHEN 'last, first' THEN h2[1] WHEN 'last first initials' THEN h1[2] WHEN 'first last' THEN h1[1]
              WHEN 'first middle last' THEN h1[1] WHEN 'single name' THEN h1[1] END, '') AS first_name,
       nullif(CASE parse_rule WHEN 'last, first' THEN array_to_string(h2[2:], ' ') WHEN 'last first initials' THEN h1[3]
              WHEN 'first middle last' THEN array_to_string(h1[2:n1 - 1], ' ') END, '') AS middle_name,
       nullif(CASE parse_rule WHEN 'last, first' THEN array_to_string(h1, ' ') WHEN 'last first initials' THEN h1[1]
              WHEN 'first last' THEN h1[2] WHEN 'first middle last' THEN h1[n1] END, '') AS last_name,
       CASE WHEN parse_rule <> 'organization'
            THEN nullif(array_to_string(list_filter(marks, lambda m, i: list_position(marks, m) = i), ', '), '') END AS designation,
       CASE WHEN parse_rule = 'organization' THEN {strip('header_col_value')} ELSE nullif(array_to_string(orgs, ', '), '') END AS organization_name,
       unassigned, parse_rule,
       ({percents('parse_rule', CONFIDENCE)} - CASE WHEN unassigned IS NOT NULL THEN {UNASSIGNED_COSTS} ELSE 0 END) / 100.0::DOUBLE AS parse_confidence
FROM done
"""


def spec_table() -> str:
    return spec(inputs.token_table_sql())


def spec_issues(threshold: float) -> str:
    return f"""SELECT id, header_col_value, 'low confidence: ' || parse_rule AS reason FROM ({spec()})
               WHERE parse_confidence < {threshold}::DOUBLE"""


def confidence() -> str:
    made = {"degree_caps": oracle_names.degree_names, "degree_dict": oracle_names.degree_names,
            **dict.fromkeys(("credential_org", "credential_list", "credential_clean"), oracle_names.credential_names),
            "format_detect": lambda _: oracle_names.format_detect()}
    out = []
    for profile, make in made.items():
        first, middle, last, organization = NAME_PARTS[profile]

        def found(c):
            return f"coalesce({strip(f'n.{c}')} <> '', false)"

        named = f"({found(first)} OR {found(last)})"
        org = "false" if profile in ("credential_list", "credential_clean") else found(organization)
        rule = f"""CASE WHEN NOT coalesce({strip('s.header_col_value')} <> '', false) THEN 'empty' WHEN NOT {named} AND {org} THEN 'organization'
            WHEN NOT {named} THEN 'no name found'
            WHEN {found(first)} AND {found(last)} AND contains(s.header_col_value, ',') THEN 'last, first'
            WHEN {found(first)} AND {found(last)} AND {found(middle)} THEN 'first middle last'
            WHEN {found(first)} AND {found(last)} THEN 'first last' ELSE 'single name' END"""
        out.append(f"""SELECT s.id, {q(profile)} AS profile, {rule} AS parse_rule,
            regexp_matches(concat_ws(' ', n.{first}, n.{middle}, n.{last}), '[,;/]') AS marked
            FROM ({make(profile)}) n JOIN ({source('provider_text', inputs.provider_text_sql)}) s ON s.id = n.id""")
    percent = percents("parse_rule", RULE_CONFIDENCE)
    return f"""SELECT id, profile, parse_rule,
        ({percent} - CASE WHEN marked AND {percent} > {PUNCTUATION_COSTS} THEN {PUNCTUATION_COSTS} ELSE 0 END) / 100.0::DOUBLE AS parse_confidence
        FROM ({' UNION ALL '.join(out)})"""
