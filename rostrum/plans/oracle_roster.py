"""DuckDB oracle SQL for the roster (family R) queries.

Written from SURVEY §2.10 / FIXTURES §5: header row = first row with most
non-null cells among rows 0..19; header text trimmed, blank -> Column_<i+1>;
repeats numbered; standard base per header by the profile's rule list; slots
numbered per base in first-seen order; the wide table lists the standard
columns expected for the derived workbook (worked out by hand below).
"""
from __future__ import annotations

from . import inputs, oracle_names
from .oracle_ages import has, q, strip, sub

# Expected standard columns of the derived workbook, per profile (hand-derived).
STD_COLUMNS = {
    "four": ["Degree 1", "Degree 2", "Degree 3", "Speciality 1", "Speciality 2", "Speciality 3",
             "Taxonomy 1", "Taxonomy 2", "Role 1", "Role 2"],
    "four_regex": ["Degree 1", "Degree 2", "Degree 3", "Speciality 1", "Speciality 2", "Speciality 3",
                   "Taxonomy 1", "Taxonomy 2", "Role 1", "Role 2"],
    "three": ["Degree 1", "Degree 2", "Degree 3", "Speciality 1", "Speciality 2", "Speciality 3",
              "Taxonomy 1", "Taxonomy 2", "Taxonomy 3"],
    "four_list": ["Degree 1", "Degree 2", "Degree 3", "Degree 4", "Speciality 1", "Speciality 2",
                  "Speciality 3", "Taxonomy 1", "Taxonomy 2", "Role 1", "Role 2"],
}


def title_sql(x: str) -> str:
    runs = f"regexp_extract_all({x}, '([A-Za-z]+|[^A-Za-z]+)', 1)"
    return (f"array_to_string(list_transform({runs}, lambda r: CASE WHEN regexp_matches(r, '^[A-Za-z]') "
            f"THEN upper(left(r, 1)) || lower(substr(r, 2)) ELSE r END), '')")


def _fallback(h: str) -> str:
    cleaned = rf"regexp_replace({strip(f'regexp_replace({h}, {q(r"[^\w\s]")}, {q(" ")}, {q("g")})')}, '\s+', ' ', 'g')"
    return title_sql(cleaned)


def words(h: str) -> str:
    return f"len(regexp_extract_all({strip(h)}, '\\w+'))"


DEG3 = (r"(?i)\b(degree|degree(s)?|credential|credentials|deg\b|md\b|m\.d\b|do\b|d\.o\b|phd\b|dr\b|dmd\b"
        r"|dds\b|mbbs\b|mbchb\b|pa-c\b|pa\b|np\b|rn\b|bsc\b|msc\b|ms\b|mph\b|mds\b)\b")
DEG4 = DEG3.replace("degree(s)?", "degrees")
ROLE = r"(?i)\b(role|spec\b|pcp\b|primary care|primarycare|primary-care)\b"
TAX4 = r"(?i)\b(taxonomy|taxonomy code|tax code)\b"
SPEC = r"(?i)\b(special|specialty|speciality|specialisation|specialization)\b"


def base_sql(h: str, profile: str) -> str:
    o = f"lower({strip(h)})"
    if profile == "general":
        rules = [
            (f"{has(o, r'\bfax\b')} OR {has(o, r'\bfx\b')}", "Fax"),
            (" OR ".join(has(o, p) for p in [r"\bphone\b", r"\btelephone\b", r"\btel\b", r"\bcontact\b"]), "Phone"),
            (" OR ".join(has(o, p) for p in [r"\bemail\b", r"\bmail\b", r"\be-mail\b"]), "Email"),
            (f"{sub(o, 'primary')} AND {sub(o, 'special')}", "Speciality"),
            (f"{sub(o, 'secondary')} AND {sub(o, 'special')}", "Speciality"),
            (f"{has(o, r'\b(3rd|third|tertiary)\b')} AND {sub(o, 'special')}", "Speciality"),
            (f"{sub(o, 'first name')} OR ({sub(o, 'name')} AND ({sub(o, 'first')} OR {sub(o, 'given')}))", "Name"),
            (f"{sub(o, 'last name')} OR ({sub(o, 'last')} AND {sub(o, 'name')})", "Name"),
            (sub(o, "middle"), "Name"),
            (f"{sub(o, 'name')} AND NOT {sub(o, 'group')}", "Name"),
            (f"{sub(o, 'dob')} OR {sub(o, 'date of birth')}", "DOB"),
            (sub(o, "dea"), "DEA"),
            (f"{sub(o, 'license')} OR {sub(o, 'lic')}", "License"),
            (f"{sub(o, 'board')} AND {sub(o, 'cert')}", "Board Certification"),
        ]
        body = " ".join(f"WHEN {c} THEN {q(b)}" for c, b in rules)
        return f"CASE {body} ELSE {_fallback(h)} END"
    if profile == "three":
        return (f"CASE WHEN {has(o, DEG3)} THEN 'Degree' "
                f"WHEN {has(o, r'(?i)\b(taxonomy|taxonomy code|tax code|tax)\b')} THEN 'Taxonomy' "
                f"WHEN {sub(o, 'special')} THEN 'Speciality' ELSE {_fallback(h)} END")
    short = f"{words(h)} <= 3"
    if profile == "four":
        return (f"CASE WHEN {has(o, DEG4)} THEN 'Degree' "
                f"WHEN {has(o, ROLE)} THEN CASE WHEN {short} THEN 'Role' ELSE '' END "
                f"WHEN {has(o, TAX4)} THEN 'Taxonomy' "
                f"WHEN {has(o, SPEC)} THEN CASE WHEN {short} THEN 'Speciality' ELSE '' END "
                f"ELSE {_fallback(h)} END")
    if profile == "four_regex":
        return (f"CASE WHEN {has(o, DEG4)} THEN 'Degree' "
                f"WHEN {has(o, ROLE)} AND {short} THEN 'Role' "
                f"WHEN {has(o, TAX4)} THEN 'Taxonomy' "
                f"WHEN {has(o, SPEC)} AND {short} THEN 'Speciality' "
                f"ELSE {_fallback(h)} END")
    if profile == "four_regex_custom":
        # include: Degree by regex; Role pattern "(" is not a valid regex -> literal comparison
        # exclude: "primary" keeps a header out of Taxonomy, "second" out of Speciality
        return (f"CASE WHEN {has(h, '(?i)^DEGREE_EARNED\\.TRAINING_PROG_DEGREE$')} THEN 'Degree' "
                f"WHEN lower({strip(h)}) = '(' THEN 'Role' "
                f"WHEN {has(o, DEG4)} THEN 'Degree' "
                f"WHEN {has(o, ROLE)} AND {short} THEN 'Role' "
                f"WHEN {has(o, TAX4)} AND NOT {has(h, '(?i)primary')} THEN 'Taxonomy' "
                f"WHEN {has(o, SPEC)} AND {short} AND NOT {has(h, '(?i)second')} THEN 'Speciality' "
                f"ELSE {_fallback(h)} END")
    if profile == "four_list_custom":
        key = f"lower(regexp_replace({h}, '[^A-Za-z0-9]', '', 'g'))"
        return (f"CASE WHEN {key} = 'degreeearnedtrainingprogdegree' THEN 'Degree' "
                f"WHEN {key} = 'boardcertified' THEN 'Role' "
                f"WHEN {key} <> 'credentials' AND {has(h, DEG4)} THEN 'Degree' "
                f"WHEN {key} <> 'pcp' AND {has(h, ROLE)} AND {short} THEN 'Role' "
                f"WHEN {has(h, TAX4)} THEN 'Taxonomy' "
                f"WHEN {has(h, SPEC)} AND {short} THEN 'Speciality' ELSE '' END")
    if profile == "four_list":
        key = f"lower(regexp_replace({h}, '[^A-Za-z0-9]', '', 'g'))"
        return (f"CASE WHEN {key} = 'degreeearnedtrainingprogdegree' THEN 'Degree' "
                f"WHEN {has(h, DEG4)} THEN 'Degree' "
                f"WHEN {has(h, ROLE)} AND {short} THEN 'Role' "
                f"WHEN {has(h, TAX4)} THEN 'Taxonomy' "
                f"WHEN {has(h, SPEC)} AND {short} THEN 'Speciality' ELSE '' END")
    raise ValueError(profile)


KEPT = {"three": ["Degree", "Speciality", "Taxonomy"],
        "four_regex_custom": ["Degree", "Speciality", "Taxonomy", "Role"],
        "four_list_custom": ["Degree", "Speciality", "Taxonomy", "Role"],
        "four": ["Degree", "Speciality", "Taxonomy", "Role"],
        "four_regex": ["Degree", "Speciality", "Taxonomy", "Role"],
        "four_list": ["Degree", "Speciality", "Taxonomy", "Role"]}


def _pipeline(profile: str) -> str:
    """CTEs: cells, hr (header rows), hm (header map), below (data cells), cmap."""
    kept = KEPT.get(profile)
    if kept is None:
        base_filter = "SELECT *, CASE WHEN trim(base0) = '' THEN 'Column' ELSE base0 END AS base FROM cb"
    else:
        base_filter = "SELECT *, base0 AS base FROM cb WHERE base0 IN (" + ", ".join(q(b) for b in kept) + ")"
    return f"""
cells AS ({inputs.roster_cells_sql()}),
probe AS (SELECT workbook, sheet, sheet_idx, row_idx, count(*) AS n FROM cells
          WHERE row_idx < 20 AND value IS NOT NULL GROUP BY workbook, sheet, sheet_idx, row_idx),
best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY workbook, sheet, sheet_idx
                                                     ORDER BY n DESC, row_idx) AS rk FROM probe) WHERE rk = 1),
sheets AS (SELECT DISTINCT workbook, sheet, sheet_idx FROM cells),
hr AS (SELECT s.workbook, s.sheet, s.sheet_idx, CAST(coalesce(b.row_idx, 0) AS INTEGER) AS header_row
       FROM sheets s LEFT JOIN best b ON s.workbook = b.workbook AND s.sheet = b.sheet),
width AS (SELECT workbook, sheet, sheet_idx, max(col_idx) AS max_col FROM cells GROUP BY ALL),
grid AS (SELECT workbook, sheet, sheet_idx, unnest(range(0, max_col + 1)) AS col_idx FROM width),
hm0 AS (SELECT g.workbook, g.sheet, g.sheet_idx, CAST(g.col_idx AS INTEGER) AS col_idx, h.header_row,
               {strip("coalesce(c.value, '')")} AS t
        FROM grid g JOIN hr h ON g.workbook = h.workbook AND g.sheet = h.sheet
        LEFT JOIN cells c ON c.workbook = g.workbook AND c.sheet = g.sheet AND c.col_idx = g.col_idx
                          AND c.row_idx = h.header_row),
hm AS (SELECT *, row_number() OVER (PARTITION BY workbook, sheet, header_text ORDER BY col_idx) AS dup_n
       FROM (SELECT *, CASE WHEN t = '' THEN 'Column_' || CAST(col_idx + 1 AS VARCHAR) ELSE t END AS header_text
             FROM hm0)),
below AS (SELECT c.workbook, c.sheet, c.sheet_idx, c.row_idx, c.col_idx, hm.header_row, hm.header_text,
                 hm.dup_n, c.v
          FROM (SELECT *, CASE WHEN {strip('value')} <> 'nan' THEN {strip('value')} END AS v FROM cells) c
          JOIN hm ON c.workbook = hm.workbook AND c.sheet = hm.sheet AND c.col_idx = hm.col_idx
          WHERE c.v IS NOT NULL AND c.row_idx > hm.header_row),
cols AS (SELECT workbook, header_text, dup_n, min(sheet_idx * 100000 + col_idx) AS first_seen
         FROM hm WHERE (workbook, sheet) IN (SELECT DISTINCT workbook, sheet FROM below)
         GROUP BY workbook, header_text, dup_n),
cb AS (SELECT *, {base_sql('header_text', profile)} AS base0 FROM cols),
cbf AS ({base_filter}),
cmap AS (SELECT workbook, header_text, dup_n, base,
                row_number() OVER (PARTITION BY workbook, base ORDER BY first_seen) AS slot FROM cbf)"""


def column_map(profile: str) -> str:
    return f"""
WITH {_pipeline(profile)}
SELECT workbook, base || ' ' || CAST(slot AS VARCHAR) AS std_name, header_text AS original_header, base,
       CAST(slot AS INTEGER) AS slot
FROM cmap
"""


def header_rows() -> str:
    return f"""
WITH {_pipeline('four_list')}
SELECT workbook, sheet, header_row + 1 AS header_row_number FROM hr
"""


def header_map() -> str:
    return f"""
WITH {_pipeline('four_list')}
SELECT workbook, sheet, col_idx, header_text, CAST(dup_n AS INTEGER) AS dup_n FROM hm
"""


def _wide(profile: str) -> str:
    cols = STD_COLUMNS[profile]
    filt = profile.startswith("four")
    sel = []
    for c in cols:
        v = f"max(CASE WHEN m.std_name = {q(c)} THEN b.v END)"
        if filt and c.split(" ")[0] in ("Speciality", "Role"):
            v = (f"CASE WHEN {v} IS NULL OR {strip(v)} = '' THEN NULL "
                 f"WHEN len(regexp_extract_all({strip(v)}, '\\w+')) <= 3 THEN {v} END")
        sel.append(f"{v} AS {q(c).replace(chr(39), chr(34))}")
    return f"""
WITH {_pipeline(profile)},
m0 AS (SELECT workbook, header_text, dup_n, base || ' ' || CAST(slot AS VARCHAR) AS std_name FROM cmap),
wide AS (
  SELECT {', '.join(sel)}, b.header_row + 1 AS header_row_number, b.sheet AS source_sheet, b.workbook,
         b.sheet_idx, b.row_idx
  FROM below b LEFT JOIN m0 m ON b.workbook = m.workbook AND b.header_text = m.header_text AND b.dup_n = m.dup_n
  GROUP BY b.workbook, b.sheet, b.sheet_idx, b.row_idx, b.header_row)"""


def wide(profile: str) -> str:
    return _wide(profile) + "\nSELECT * FROM wide\n"


def long(profile: str) -> str:
    return f"""
WITH {_pipeline(profile)}
SELECT b.workbook, b.sheet, b.sheet_idx, b.row_idx, m.base || ' ' || CAST(m.slot AS VARCHAR) AS std_name, b.v AS value
FROM below b JOIN cmap m ON b.workbook = m.workbook AND b.header_text = m.header_text AND b.dup_n = m.dup_n
"""


def dedupe_no_columns() -> str:
    return _wide("three") + """
SELECT CAST(1 AS BIGINT) AS duplicate_count, header_row_number, sheet AS source_sheets, workbook
FROM (SELECT header_row_number, source_sheet AS sheet, workbook FROM wide)
"""


def flat_headers() -> str:
    return f"""
WITH cells AS ({inputs.roster_cells_sql()})
SELECT workbook, sheet, sheet_idx, col_idx, string_agg(value, '_' ORDER BY row_idx) AS header_text
FROM cells WHERE row_idx IN (1, 2) GROUP BY workbook, sheet, sheet_idx, col_idx
"""


def skipped_sheets() -> str:
    return f"""
WITH cells AS (SELECT * FROM ({inputs.roster_cells_sql()}) UNION ALL SELECT * FROM ({inputs.header_only_sheets_sql()}))
SELECT workbook, sheet, sheet_idx FROM cells GROUP BY ALL HAVING max(row_idx) < {inputs.ROSTER_DATA_ROW0}
"""


def _qcols(profile):
    return [q(c).replace("'", '"') for c in STD_COLUMNS[profile]]


def dedupe(profile: str) -> str:
    cols = ", ".join(_qcols(profile))
    return _wide(profile) + f"""
SELECT {cols}, count(*) AS duplicate_count, min(header_row_number) AS header_row_number,
       array_to_string(list_sort(list_distinct(list(source_sheet))), ',') AS source_sheets, workbook
FROM wide GROUP BY workbook, {cols}
"""


def audit(profile: str) -> str:
    cols = _qcols(profile)
    key = " || '||' || ".join(f"coalesce({c}, '')" for c in cols)
    return _wide(profile) + f"""
SELECT {', '.join(cols)}, source_sheet, header_row_number, group_key,
       CAST(occurrence_index AS BIGINT) AS occurrence_index, 'duplicate_of_group' AS removed_reason, workbook
FROM (SELECT *, row_number() OVER (PARTITION BY workbook, group_key ORDER BY sheet_idx, row_idx)
                AS occurrence_index
      FROM (SELECT *, {key} AS group_key FROM wide))
WHERE occurrence_index > 1
"""


def general_map() -> str:
    """Rows of profile general, the standard values as text by name."""
    return f"""
WITH {_pipeline('general')},
rows_ AS (
  SELECT coalesce(string_agg(m.base || ' ' || CAST(m.slot AS VARCHAR) || '=' || b.v, '||' ORDER BY m.base || ' ' || CAST(m.slot AS VARCHAR)), '')
           AS row_values, b.header_row + 1 AS header_row_number, b.sheet AS source_sheet, b.workbook, b.sheet_idx, b.row_idx
  FROM below b LEFT JOIN cmap m ON b.workbook = m.workbook AND b.header_text = m.header_text AND b.dup_n = m.dup_n
  GROUP BY b.workbook, b.sheet, b.sheet_idx, b.row_idx, b.header_row)
"""


def dedupe_general() -> str:
    return general_map() + """
SELECT row_values, count(*) AS duplicate_count, min(header_row_number) AS header_row_number,
       array_to_string(list_sort(list_distinct(list(source_sheet))), ',') AS source_sheets, workbook
FROM rows_ GROUP BY workbook, row_values
"""


def audit_general() -> str:
    return general_map() + """
SELECT row_values, source_sheet, header_row_number, row_values AS group_key, CAST(n AS BIGINT) AS occurrence_index,
       'duplicate_of_group' AS removed_reason, workbook
FROM (SELECT *, row_number() OVER (PARTITION BY workbook, row_values ORDER BY sheet_idx, row_idx) AS n FROM rows_) WHERE n > 1
"""


def header_block() -> str:
    cols = STD_COLUMNS["four_list"]
    tracking = ["duplicate_count", "header_row_number", "source_sheets"]
    first = ", ".join(f'{q(c)} AS "{c}"' for c in (*cols, *tracking))
    second = ", ".join([*[f"""coalesce(max(CASE WHEN base || ' ' || CAST(slot AS VARCHAR) = {q(c)} THEN header_text END), '') AS "{c}\"""" for c in cols],
                        *[f'{q(c)} AS "{c}"' for c in tracking]])
    return f"""
WITH {_pipeline('four_list')}
SELECT workbook, 1 AS header_line, {first} FROM cmap GROUP BY workbook
UNION ALL
SELECT workbook, 2 AS header_line, {second} FROM cmap GROUP BY workbook
"""


def names_from_cells(candidates: list[str]) -> str:
    """The cells of each sheet's name column, parsed by the rules of profile credential_clean; the other cells as text by header."""
    ranked = " ".join(f"WHEN {q(c)} THEN {k}" for k, c in enumerate(candidates))
    records = f"""
SELECT r.workbook || '|' || r.sheet || '|' || r.row_idx AS id, r.value AS header_col_value, r.workbook AS file_name
FROM record r"""
    prefix = f"""
WITH {_pipeline('general')},
named AS (SELECT workbook, sheet, col_idx, header_row, header_text || CASE WHEN dup_n > 1 THEN '__dup' || (dup_n - 1) ELSE '' END AS name FROM hm),
chosen AS (SELECT workbook, sheet, arg_min(col_idx, (CASE lower(trim(name)) {ranked} ELSE {len(candidates)} END) * 10000 + col_idx) AS value_col,
                  arg_min(name, (CASE lower(trim(name)) {ranked} ELSE {len(candidates)} END) * 10000 + col_idx) AS value_header
           FROM named GROUP BY workbook, sheet),
record AS (SELECT c.workbook, c.sheet, c.row_idx, max(CASE WHEN c.col_idx = k.value_col THEN c.value END) AS value, k.value_header,
                  coalesce(string_agg(n.name || '=' || c.value, '||' ORDER BY n.name) FILTER (c.col_idx <> k.value_col), '') AS columns
           FROM cells c JOIN named n ON n.workbook = c.workbook AND n.sheet = c.sheet AND n.col_idx = c.col_idx
           JOIN chosen k ON k.workbook = c.workbook AND k.sheet = c.sheet
           WHERE c.row_idx > n.header_row GROUP BY c.workbook, c.sheet, c.row_idx, k.value_header)"""
    parsed = oracle_names.credential_names("credential_clean").replace(inputs.provider_text_sql(), records)
    return prefix + f"""
SELECT p.* EXCLUDE (id), r.sheet AS source_sheet, CAST(r.row_idx AS INTEGER) AS source_row, r.value_header AS header_col_name, r.columns
FROM ({parsed}) p JOIN record r ON p.id = r.workbook || '|' || r.sheet || '|' || r.row_idx
"""
