"""End-to-end jobs: workbook files in, cleaned tables out.

These are the user-level entry points matching the reference's programs;
each is a plain Spark job (read -> transform -> write) and runs on any number
of workbooks at once. Each writes the files and sheets that couldn't be read or
are empty as JSON lines to ``<output_path>_problems``. With damaged ones it then
fails (``on_damage="fail"``) or goes on without them (``"leave_out"``: damaged
sheets are left out whole).
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .operators.ages import clean_ages
from .operators.names import NAME_COL_CANDIDATES, clean_names, observe_exclusion
from .operators.roster import RosterResult, standardize_roster
from .operators.roster_map import standardize_as_map
from .sinks import write_json_array, write_name_jsonl, write_records_json, write_roster, write_roster_map, write_table
from .session import land
from .sources.workbook import (EMPTY, ORDER_COLUMNS, cells_to_records, cells_to_table, check_sheet, read_sheet, read_workbooks_checked,
                               whole_sheets, workbook_problems)


def load_cells(spark: SparkSession, input_path: str, output_path: str | None = None,
               on_damage: str = "fail") -> DataFrame:
    """Cells of all whole sheets under ``input_path``, parsed once; problems are written beside ``output_path``."""
    if on_damage not in ("fail", "leave_out"):
        raise ValueError(f"on_damage is 'fail' or 'leave_out', not {on_damage!r}")
    checked = land(read_workbooks_checked(spark, input_path), "cells")
    problems = workbook_problems(checked)
    where = ""
    if output_path is not None:
        where = f"{output_path.rstrip('/')}_problems"
        write_table(problems, where, fmt="json")
    if on_damage == "fail":
        first = problems.filter(F.col("problem") != EMPTY).first()
        if first is not None:
            raise ValueError(f"{first['workbook']}, sheet {first['sheet']}: {first['problem']}" + (f" (all: {where})" if where else ""))
    return whole_sheets(checked)


def load_sheet_table(spark: SparkSession, input_path: str, sheet: str | None = None,
                     checked: bool = False, output_path: str | None = None, on_damage: str = "fail") -> DataFrame:
    """One sheet (by name, else the first) of the workbook(s) under ``input_path``
    as a table whose header is the sheet's first row (all values as text).
    ``checked=True`` applies the single-workbook checks (missing / ambiguous sheet)."""
    cells = load_cells(spark, input_path, output_path, on_damage)
    if checked:
        sheet = check_sheet(cells, sheet)
    return cells_to_table(read_sheet(cells, sheet), header_row=0)


def run_roster_job(spark: SparkSession, input_path: str, output_path: str, profile: str = "four_list",
                   fmt: str = "csv", on_damage: str = "fail", **kw) -> RosterResult:
    """All sheets of all workbooks -> combined standard table, header rows,
    column map, duplicates audit (+ note). Profile ``general``, whose names grow with
    the workbooks, is written with maps (``roster_map``)."""
    cells = load_cells(spark, input_path, output_path, on_damage)
    if profile == "general":
        res = standardize_as_map(cells, profile, materialize=True, materialize_input=True, **kw)
        write_roster_map(res, output_path, fmt=fmt)
        return res
    res = standardize_roster(cells, profile, materialize=True, materialize_input=True, **kw)
    write_roster(res, output_path, fmt=fmt)
    return res


def load_sheet_records(spark: SparkSession, input_path: str, candidates, sheet: str | None = None,
                       output_path: str | None = None, on_damage: str = "fail") -> DataFrame:
    """One sheet of each workbook as records (``cells_to_records``): for any number of workbooks and headers. The other cells
    are JSON text by header in ``columns``."""
    cells = load_cells(spark, input_path, output_path, on_damage)
    records = cells_to_records(read_sheet(cells, sheet), candidates)
    return records.withColumn("columns", F.to_json("columns"))


def run_name_job(spark: SparkSession, input_path: str, output_path: str, profile: str = "credential_clean",
                 sheet: str | None = None, value_col: str | None = None, exclude=(), fmt: str = "csv",
                 on_damage: str = "fail", json: str = "lines", layout: str = "table") -> DataFrame:
    """R2: provider names of one sheet -> parsed name columns, written as a
    table plus JSON: JSON lines of the five name fields for the degree profiles,
    otherwise all columns, as ``json`` says: "lines" or one "array". With ``layout="records"`` the other cells are one
    column, whatever the workbooks' headers; the name column is ``value_col`` or a known header of each sheet. What was
    excluded is written as a row of counts to ``<output_path>/summary``."""
    if layout == "records":
        candidates = [value_col] if value_col else NAME_COL_CANDIDATES
        df, value_col = load_sheet_records(spark, input_path, candidates, sheet, output_path, on_damage), "header_col_value"
    else:
        df = load_sheet_table(spark, input_path, sheet, output_path=output_path, on_damage=on_damage)
    kw = {"value_col": value_col} if value_col else {}
    if profile in ("degree_caps", "degree_dict"):
        kw["keep"] = [*ORDER_COLUMNS, *(["columns"] if layout == "records" else [])]
    obs = None
    if profile in ("credential_list", "credential_clean"):
        kw["exclude"] = exclude
        if "file_name" in df.columns:
            df, obs = observe_exclusion(df, "file_name", exclude)
    out = land(clean_names(df, profile, **kw), "names").orderBy(*ORDER_COLUMNS)
    write_table(out, f"{output_path}/table", fmt=fmt)
    if obs is not None:
        counts = {**obs.get, "n_output": obs.get["n_input"] - obs.get["n_excluded"]}
        write_table(spark.createDataFrame([counts], "n_input long, n_excluded long, n_output long"), f"{output_path}/summary", fmt="json")
    if profile in ("degree_caps", "degree_dict"):
        write_name_jsonl(out, f"{output_path}/jsonl")
    else:
        (write_json_array if json == "array" else write_records_json)(out, f"{output_path}/json")
    return out


def run_age_job(spark: SparkSession, input_path: str, output_path: str, profile: str = "phrase_hdr",
                sheet: str | None = None, value_col: str | None = None, fmt: str = "csv",
                on_damage: str = "fail") -> DataFrame:
    """Age texts of one sheet -> min/max ages."""
    df = load_sheet_table(spark, input_path, sheet, checked=profile == "label_map", output_path=output_path,
                          on_damage=on_damage)
    kw = {"value_col": value_col} if value_col else {}
    out = clean_ages(df, profile, **kw)
    write_table(out.orderBy(*ORDER_COLUMNS), output_path, fmt=fmt)
    return out


__all__ = ["load_cells", "load_sheet_records", "load_sheet_table", "run_roster_job", "run_name_job", "run_age_job"]
