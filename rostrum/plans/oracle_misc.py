"""DuckDB oracle SQL for file-name filters and path operators."""
from __future__ import annotations

from . import inputs
from .oracle_ages import q
from .oracle_ages import strip as _strip


def json_rows() -> str:
    from .oracle_names import degree_names
    return f"""
SELECT id, to_json({{'firstname': coalesce(firstname, ''), 'lastname': coalesce(lastname, ''),
                     'middlename': coalesce(middlename, ''), 'medical_degree': coalesce(medical_degree, ''),
                     'organization': coalesce(organization, '')}})::VARCHAR AS json_line
FROM ({degree_names('degree_dict')})
"""


def fill_blanks() -> str:
    from .oracle_roster import STD_COLUMNS, dedupe
    cols = STD_COLUMNS["three"]
    filled = ", ".join(f"coalesce(\"{c}\", '') AS \"{c}\"" for c in cols)
    return f"SELECT {filled}, duplicate_count, header_row_number, source_sheets, workbook FROM ({dedupe('three')})"


def coalesce_first() -> str:
    cols = ["Accepts Minimum Patient Age", "Accepts Maximum Patient Age", "Age Group"]
    vals = ", ".join(f"CASE WHEN {_strip(chr(34) + c + chr(34))} <> '' THEN \"{c}\" END" for c in cols)
    which = ", ".join(f"CASE WHEN {_strip(chr(34) + c + chr(34))} <> '' THEN {q(c)} END" for c in cols)
    return f"""
SELECT p_partkey, coalesce({vals}) AS first_value, coalesce({which}) AS from_column
FROM ({inputs.age_two_col_sql()})
"""


def file_tag() -> str:
    return f"""
WITH src AS ({inputs.provider_text_sql()})
SELECT id, file_name,
       CASE WHEN trim(file_name) = {q(inputs.ROSTER_FILE)} THEN file_name ELSE '' END AS organization
FROM src
"""


def file_exclude(names) -> str:
    lowered = sorted({n.strip().lower() for n in names})
    lst = ", ".join(q(x) for x in lowered)
    return f"""
WITH src AS ({inputs.provider_text_sql()})
SELECT id, file_name FROM src
WHERE lower(trim(coalesce(file_name, ''))) = {q(inputs.ROSTER_FILE.lower())}
   OR lower(trim(coalesce(file_name, ''))) NOT IN ({lst})
"""


def file_exclusion_counts(names) -> str:
    lowered = sorted({n.strip().lower() for n in names})
    lst = ", ".join(q(x) for x in lowered)
    key = "lower(trim(coalesce(file_name, '')))"
    return f"""
WITH src AS ({inputs.provider_text_sql()})
SELECT count(*) AS n_input,
       count(*) FILTER (WHERE {key} <> {q(inputs.ROSTER_FILE.lower())} AND {key} IN ({lst})) AS n_excluded,
       count(*) - count(*) FILTER (WHERE {key} <> {q(inputs.ROSTER_FILE.lower())} AND {key} IN ({lst})) AS n_output
FROM src
"""


def _norm(x: str) -> str:
    """POSIX normpath: '' and '.' segments dropped, '..' pops the previous segment
    (kept on a relative path with nothing to pop, dropped at an absolute root),
    exactly two leading slashes kept, '' -> '.'."""
    absolute = f"starts_with({x}, '/')"
    comps = (f"list_reduce(string_split({x}, '/'), lambda acc, c: CASE WHEN c IN ('', '.') THEN acc "
             f"WHEN c <> '..' OR (NOT {absolute} AND len(acc) = 0) OR (len(acc) > 0 AND acc[-1] = '..') "
             f"THEN list_append(acc, c) WHEN len(acc) > 0 THEN acc[1:len(acc) - 1] ELSE acc END, []::VARCHAR[])")
    init = (f"CASE WHEN starts_with({x}, '//') AND NOT starts_with({x}, '///') THEN '//' "
            f"WHEN {absolute} THEN '/' ELSE '' END")
    out = f"({init} || array_to_string({comps}, '/'))"
    return f"(CASE WHEN {out} = '' THEN '.' ELSE {out} END)"


def _dirname(x: str) -> str:
    head = f"regexp_extract({x}, '^(.*/)[^/]*$', 1)"
    stripped = f"rtrim({head}, '/')"
    return f"(CASE WHEN {head} = '' THEN '' WHEN {stripped} = '' THEN {head} ELSE {stripped} END)"


def _slash(x: str) -> str:
    return f"(CASE WHEN ends_with({x}, '/') THEN {x} ELSE {x} || '/' END)"


def prefix_sql(p: str) -> str:
    """Storage prefix of an already normalised path column ``p``."""
    return f"""CASE WHEN starts_with({p}, '/home/airflow/gcs') THEN {_slash(_dirname(f"substr({p}, 19)"))}
       WHEN strpos({p}, '/dags/') > 0 THEN {_slash(_dirname(f"substr({p}, strpos({p}, '/dags/') + 1)"))}
       WHEN strpos({p}, '/gcs/') > 0 THEN {_slash(_dirname(f"substr({p}, strpos({p}, '/gcs/') + 1)"))}
       ELSE {_slash(_dirname(p))} END"""


def path_prefix() -> str:
    return f"""
WITH src AS ({inputs.page_objects_sql()}),
n AS (SELECT page_id, path, {_norm('path')} AS p FROM src)
SELECT page_id, path, {prefix_sql('p')} AS prefix
FROM n
"""


def file_exclude_table() -> str:
    return f"""
WITH src AS ({inputs.provider_text_sql()}),
ex AS (SELECT DISTINCT lower('ROSTER_' || CAST(n_nationkey % 4 AS VARCHAR) || '.xlsx') AS name FROM nation
       UNION SELECT lower({q(inputs.ROSTER_FILE)}))
SELECT id, file_name FROM src
WHERE lower(trim(coalesce(file_name, ''))) = lower({q(inputs.ROSTER_FILE)})
   OR lower(trim(coalesce(file_name, ''))) NOT IN (SELECT name FROM ex)
"""


def file_exclusion_counts_table() -> str:
    return f"""
SELECT n_input, n_input - n_output AS n_excluded, n_output
FROM (SELECT count(*) AS n_input FROM ({inputs.provider_text_sql()})), (SELECT count(*) AS n_output FROM ({file_exclude_table()}))
"""


def table_cells() -> str:
    columns = ["c_name", "c_nationkey", "c_mktsegment"]
    heads = ", ".join(f"(0, {i}, {q(c)})" for i, c in enumerate(columns))
    body = " UNION ALL ".join(f"SELECT c_custkey + 1, {i}, CAST({c} AS VARCHAR) FROM customer" for i, c in enumerate(columns))
    return f"""
SELECT 'customers' AS workbook, 'all' AS sheet, 0 AS sheet_idx, row_idx, col_idx, value
FROM (SELECT * FROM (VALUES {heads}) AS h(row_idx, col_idx, value) UNION ALL {body}) WHERE value IS NOT NULL
"""


def path_listing() -> str:
    return f"""
WITH objs AS (SELECT object AS path FROM ({inputs.page_objects_sql()})),
hosts AS (SELECT DISTINCT split_part(path, '/', 1) || '/' AS prefix FROM objs UNION SELECT ''),
m AS (SELECT h.prefix, o.path, substr(o.path, length(h.prefix) + 1) AS rest
      FROM objs o JOIN hosts h ON starts_with(o.path, h.prefix))
SELECT DISTINCT prefix,
       CASE WHEN strpos(rest, '/') = 0 THEN 'file' ELSE 'folder' END AS entry_type,
       CASE WHEN strpos(rest, '/') = 0 THEN path ELSE prefix || split_part(rest, '/', 1) || '/' END AS entry
FROM m
"""
