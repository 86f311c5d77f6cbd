"""Query catalog: name -> Spark query over the driver tables, name -> oracle SQL.

Every query reads whole driver tables (no id subsets or row caps) and derives
roster-like inputs from them deterministically (see ``inputs``).
"""
from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.names import file_tag
from ..functions.text import pstrip
from ..operators import paths as P
from ..operators import roster as R
from ..operators import roster_map as M
from ..operators.ages import clean_ages
from ..operators.joins import materialize
from ..operators.names import (NAME_PARTS, clean_names, exclude_files, exclusion_counts, format_summary, kind_summary,
                               parse_issues)
from ..session import shared_folder
from ..sinks import header_rows
from ..sources.workbook import cells_to_records
from ..streaming import clean_available
from . import inputs, oracle_ages, oracle_misc, oracle_names, oracle_roster, oracle_spec

Query = Callable[[SparkSession, str], DataFrame]


# ---------------------------------- ages ------------------------------------
def q_age_a1(spark, sf):
    return clean_ages(inputs.age_text(spark, sf), "label_map", value_col="header_col_value")


def q_age_a2(spark, sf):
    return clean_ages(inputs.age_text(spark, sf), "phrase")


def q_age_a3(spark, sf):
    return clean_ages(inputs.age_text(spark, sf), "phrase_hdr")


def q_age_a4(spark, sf):
    df = inputs.age_text(spark, sf).withColumnRenamed("header_col_name", "header_colName")
    return clean_ages(df, "band")


def q_age_a5(spark, sf):
    return clean_ages(inputs.age_two_col(spark, sf), "two_col", keep=["p_partkey"])


def q_age_a6(spark, sf):
    return clean_ages(inputs.age_text(spark, sf), "simple120")


# --------------------------------- roster -----------------------------------
def _roster(spark, sf, profile, **kw):
    return R.standardize_roster(inputs.roster_cells(spark, sf), profile, materialize_input=True, **kw)


def q_roster_header_rows(spark, sf):
    hr = R.detect_header_rows(inputs.roster_cells(spark, sf))
    return hr.select("workbook", "sheet", (F.col("header_row") + 1).alias("header_row_number"))


def q_roster_header_map(spark, sf):
    cells = inputs.roster_cells(spark, sf)
    hm = R.build_header_map(cells, R.detect_header_rows(cells))
    return hm.select("workbook", "sheet", "col_idx", "header_text", "dup_n")


def _column_map_query(profile):
    def run(spark, sf):
        cells = inputs.roster_cells(spark, sf)
        ext = R.sheet_extents(cells)
        hr = R.detect_header_rows(cells, 20, ext)
        hm = R.build_header_map(cells, hr, ext)
        cmap = R.build_column_map(hm, R.sheets_with_data(ext, hr), profile)
        return cmap.select("workbook", "std_name", "original_header", "base", "slot")
    return run


# user include / exclude rules (F12 regex lists with an invalid pattern, F13 plain-name lists)
REGEX_INCLUDE = {"Degree": [r"^DEGREE_EARNED\.TRAINING_PROG_DEGREE$"], "Role": ["("]}
REGEX_EXCLUDE = {"Taxonomy": ["primary"], "Speciality": ["second"]}
LIST_INCLUDE = {"Degree": ["DEGREE_EARNED.TRAINING_PROG_DEGREE"], "Role": ["Board Certified"]}
LIST_EXCLUDE = {"Degree": ["Credentials"], "Role": ["pcp"]}


def _column_map_custom(profile, include, exclude):
    def run(spark, sf):
        cells = inputs.roster_cells(spark, sf)
        ext = R.sheet_extents(cells)
        hr = R.detect_header_rows(cells, 20, ext)
        hm = R.build_header_map(cells, hr, ext)
        cmap = R.build_column_map(hm, R.sheets_with_data(ext, hr), profile, include, exclude)
        return cmap.select("workbook", "std_name", "original_header", "base", "slot")
    return run


def q_file_exclusion_counts(spark, sf):
    return exclusion_counts(inputs.provider_text(spark, sf), "file_name", EXCLUDED_FILES)


def q_roster_long_general(spark, sf):
    cells = materialize(inputs.roster_cells(spark, sf))
    ext = R.sheet_extents(cells)
    hr = R.detect_header_rows(cells, 20, ext)
    hm = materialize(R.build_header_map(cells, hr, ext))
    cmap = R.build_column_map(hm, R.sheets_with_data(ext, hr), "general")
    return R.standard_long(R.data_cells(cells, hm), cmap)


def q_roster_dedupe_no_columns(spark, sf):
    """Without a standard column every row stays."""
    return R.dedupe(_roster(spark, sf, "three").wide, [])


def q_roster_flat_headers(spark, sf):
    """Two header rows of every sheet as one text per column."""
    return R.flatten_header_rows(inputs.roster_cells(spark, sf), [1, 2])


def q_roster_skipped_sheets(spark, sf):
    """Beside all sheets with data, a header-only sheet in every workbook is left out and reported."""
    cells = inputs.roster_cells(spark, sf).unionByName(inputs.header_only_sheets(spark, sf))
    return R.standardize_roster(cells, "four_list", materialize_input=True).skipped_sheets


def q_table_cells(spark, sf):
    """A wide table as the cells of one sheet."""
    cust = inputs.read_table(spark, sf, "customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    return R.table_to_cells(cust, "customers", "all", order_col="c_custkey")


def _wide_query(profile):
    return lambda spark, sf: _roster(spark, sf, profile).wide


def _dedupe_query(profile):
    return lambda spark, sf: _roster(spark, sf, profile).combined


def _audit_query(profile):
    return lambda spark, sf: _roster(spark, sf, profile, materialize=True).audit


def _general(spark, sf, **kw):
    return M.standardize_as_map(inputs.roster_cells(spark, sf), materialize_input=True, **kw)


def _map_as_text(df):
    """``row_values`` as text: DuckDB and Spark order the entries of a map differently."""
    return df.withColumn(M.VALUES, M.text_of(F.col(M.VALUES)))


def q_roster_wide_general(spark, sf):
    return _map_as_text(_general(spark, sf).wide)


def q_roster_dedupe_general(spark, sf):
    return _map_as_text(_general(spark, sf).combined)


def q_roster_audit_general(spark, sf):
    return _map_as_text(_general(spark, sf, materialize=True).audit)


def q_roster_header_block(spark, sf):
    """The two header rows of every workbook."""
    res = _roster(spark, sf, "four_list")
    return header_rows(res.column_map, res.std_names)


# ---------------------------------- names -----------------------------------
def _name_query(profile):
    def run(spark, sf):
        df = inputs.provider_text(spark, sf)
        if profile.startswith("degree"):
            return clean_names(df, profile, keep=["id"])
        return clean_names(df, profile)
    return run


def q_name_format_counts(spark, sf):
    return format_summary(clean_names(inputs.provider_text(spark, sf), "format_detect"))


def q_name_issues(spark, sf):
    parsed = clean_names(inputs.provider_text(spark, sf), "credential_clean")
    return parse_issues(parsed).select("id", "header_col_value", "reason")


def q_name_spec(spark, sf):
    """People and organizations in one value, with a confidence."""
    return clean_names(inputs.spec_text(spark, sf), "spec")


def q_name_spec_table(spark, sf):
    """The same with designations, keywords and titles from a table that grows."""
    return clean_names(inputs.spec_text(spark, sf), "spec", designations=inputs.token_table(spark, sf))


REVIEW_BELOW = 0.7


def q_name_spec_issues(spark, sf):
    return parse_issues(q_name_spec(spark, sf), threshold=REVIEW_BELOW).select("id", "header_col_value", "reason")


def q_name_confidence(spark, sf):
    """Rule and confidence of every name under each of the six other profiles."""
    names, out = inputs.provider_text(spark, sf), None
    for profile in NAME_PARTS:
        keep = ["id"] if profile.startswith("degree") else None
        one = clean_names(names, profile, keep=keep, confidence=True).select("id", F.lit(profile).alias("profile"), "parse_rule", "parse_confidence")
        out = one if out is None else out.unionByName(one)
    return out


def _streamed(transform):
    """ST: a file stream over the table ``part`` with a fresh checkpoint, its sink read back."""
    def run(spark, sf):
        table = f"{sf.rstrip('/')}/part.parquet"
        schema = spark.read.parquet(table).schema
        # a file stream takes a folder or a pattern; this one names the table whether it is a file or a folder
        return clean_available(spark, table[:-1] + f"[{table[-1]}]", schema, transform, f"{shared_folder(spark)}/rostrum-stream-{uuid.uuid4().hex}")
    return run


def q_file_exclusion_counts_table(spark, sf):
    """The counts with a table of file names."""
    return exclusion_counts(inputs.provider_text(spark, sf), "file_name", _excluded_names(spark, sf))


NAME_HEADERS = ["provider name", "last name"]


def q_names_from_cells(spark, sf):
    """R2: cells of growing workbooks -> the name column of each sheet -> parsed names, other cells in a map."""
    cells = materialize(inputs.roster_cells(spark, sf))
    records = cells_to_records(cells, NAME_HEADERS, header_rows=R.detect_header_rows(cells), keep_blank_rows=False)
    named = clean_names(records.withColumnRenamed("source_workbook", "file_name"), "credential_clean")
    return named.withColumn("columns", M.text_of(F.col("columns")))


def q_name_kind_counts(spark, sf):
    return kind_summary(clean_names(inputs.provider_text(spark, sf), "credential_org"))


EXCLUDED_FILES = ["roster_3.xlsx", " ROSTER_4.XLSX ", inputs.ROSTER_FILE]


def q_json_rows(spark, sf):
    """One JSON object per name row, five name fields, '' for missing."""
    names = clean_names(inputs.provider_text(spark, sf), "degree_dict", keep=["id"])
    fields = ["firstname", "lastname", "middlename", "medical_degree", "organization"]
    obj = F.to_json(F.struct(*[F.coalesce(F.col(c), F.lit("")).alias(c) for c in fields]))
    return names.select("id", obj.alias("json_line"))


def q_fill_blanks(spark, sf):
    """The de-duplicated roster with every missing standard value written as ''."""
    res = _roster(spark, sf, "three")
    return res.combined.na.fill("", subset=res.std_names)


def q_coalesce_first(spark, sf):
    """First non-blank age cell among the age-like columns, and which column it came from."""
    df = inputs.age_two_col(spark, sf)
    cols = ["Accepts Minimum Patient Age", "Accepts Maximum Patient Age", "Age Group"]
    nonblank = [F.when(pstrip(F.col(f"`{c}`")) != "", F.col(f"`{c}`")) for c in cols]
    which = [F.when(pstrip(F.col(f"`{c}`")) != "", F.lit(c)) for c in cols]
    return df.select("p_partkey", F.coalesce(*nonblank).alias("first_value"), F.coalesce(*which).alias("from_column"))


def q_file_tag(spark, sf):
    df = inputs.provider_text(spark, sf)
    return df.select("id", "file_name", file_tag(F.col("file_name")).alias("organization"))


def q_file_exclude(spark, sf):
    return exclude_files(inputs.provider_text(spark, sf), "file_name", EXCLUDED_FILES).select("id", "file_name")


def q_file_exclude_table(spark, sf):
    """Exclusion by a table of file names, as one anti join; the roster file in it is never excluded."""
    return exclude_files(inputs.provider_text(spark, sf), "file_name", _excluded_names(spark, sf)).select("id", "file_name")


def _excluded_names(spark, sf):
    nation = inputs.read_table(spark, sf, "nation")
    names = nation.select(F.concat(F.lit("ROSTER_"), (F.col("n_nationkey") % 4).cast("string"), F.lit(".xlsx")).alias("file_name"))
    return names.unionByName(names.limit(1).select(F.lit(inputs.ROSTER_FILE).alias("file_name")))


# ---------------------------------- paths -----------------------------------
def q_path_prefix(spark, sf):
    return P.with_storage_prefix(inputs.page_objects(spark, sf).select("page_id", "path"))


def q_path_listing(spark, sf):
    objs = inputs.page_objects(spark, sf).select(F.col("object").alias("path"))
    hosts = objs.select(F.concat(F.substring_index("path", "/", 1), F.lit("/")).alias("prefix")).distinct()
    root = spark.range(1).select(F.lit("").alias("prefix"))
    return P.list_prefixes(objs, hosts.unionByName(root))


WIDE_PROFILES = ("three", "four", "four_regex", "four_list")

QUERIES: dict[str, Query] = {
    "age_a1_label_map": q_age_a1,
    "age_a2_phrase": q_age_a2,
    "age_a3_phrase_hdr": q_age_a3,
    "age_a4_band_subcat": q_age_a4,
    "age_a5_two_col": q_age_a5,
    "age_a6_simple120": q_age_a6,
    "roster_header_rows": q_roster_header_rows,
    "roster_header_map": q_roster_header_map,
    **{f"roster_column_map_{p}": _column_map_query(p)
       for p in ("general", "three", "four", "four_regex", "four_list")},
    "roster_column_map_four_regex_custom": _column_map_custom("four_regex", REGEX_INCLUDE, REGEX_EXCLUDE),
    "roster_column_map_four_list_custom": _column_map_custom("four_list", LIST_INCLUDE, LIST_EXCLUDE),
    **{f"roster_wide_{p}": _wide_query(p) for p in WIDE_PROFILES},
    **{f"roster_dedupe_{p}": _dedupe_query(p) for p in WIDE_PROFILES},
    **{f"roster_audit_{p}": _audit_query(p) for p in WIDE_PROFILES},
    "roster_long_general": q_roster_long_general,
    "roster_wide_general": q_roster_wide_general,
    "roster_dedupe_general": q_roster_dedupe_general,
    "roster_audit_general": q_roster_audit_general,
    "roster_header_block": q_roster_header_block,
    "roster_dedupe_no_columns": q_roster_dedupe_no_columns,
    "roster_flat_headers": q_roster_flat_headers,
    "roster_skipped_sheets": q_roster_skipped_sheets,
    "table_cells": q_table_cells,
    "file_exclude_table": q_file_exclude_table,
    "name_n1_degree_caps": _name_query("degree_caps"),
    "name_n2_degree_dict": _name_query("degree_dict"),
    "name_n3_credential_org": _name_query("credential_org"),
    "name_n4_credential_list": _name_query("credential_list"),
    "name_n5_credential_clean": _name_query("credential_clean"),
    "name_n6_format_detect": _name_query("format_detect"),
    "name_format_counts": q_name_format_counts,
    "name_kind_counts": q_name_kind_counts,
    "names_from_cells": q_names_from_cells,
    "name_issues": q_name_issues,
    "name_spec": q_name_spec,
    "name_spec_table": q_name_spec_table,
    "name_spec_issues": q_name_spec_issues,
    "name_confidence": q_name_confidence,
    "json_rows": q_json_rows,
    "fill_blanks": q_fill_blanks,
    "coalesce_first": q_coalesce_first,
    "file_tag": q_file_tag,
    "file_exclude": q_file_exclude,
    "file_exclusion_counts": q_file_exclusion_counts,
    "file_exclusion_counts_table": q_file_exclusion_counts_table,
    "stream_ages": _streamed(lambda part: clean_ages(inputs.age_text_of(part), "phrase_hdr")),
    "stream_names": _streamed(lambda part: clean_names(inputs.provider_text_of(part), "credential_clean")),
    "path_prefix": q_path_prefix,
    "path_listing": q_path_listing,
}

ORACLE: dict[str, Callable[[], str]] = {
    "age_a1_label_map": oracle_ages.age_label_map,
    "age_a2_phrase": oracle_ages.age_phrase,
    "age_a3_phrase_hdr": oracle_ages.age_phrase_hdr,
    "age_a4_band_subcat": oracle_ages.age_band,
    "age_a5_two_col": oracle_ages.age_two_col,
    "age_a6_simple120": oracle_ages.age_simple120,
    "roster_header_rows": oracle_roster.header_rows,
    "roster_header_map": oracle_roster.header_map,
    **{f"roster_column_map_{p}": (lambda p=p: oracle_roster.column_map(p))
       for p in ("general", "three", "four", "four_regex", "four_list")},
    "roster_column_map_four_regex_custom": lambda: oracle_roster.column_map("four_regex_custom"),
    "roster_column_map_four_list_custom": lambda: oracle_roster.column_map("four_list_custom"),
    **{f"roster_wide_{p}": (lambda p=p: oracle_roster.wide(p)) for p in WIDE_PROFILES},
    **{f"roster_dedupe_{p}": (lambda p=p: oracle_roster.dedupe(p)) for p in WIDE_PROFILES},
    **{f"roster_audit_{p}": (lambda p=p: oracle_roster.audit(p)) for p in WIDE_PROFILES},
    "roster_long_general": lambda: oracle_roster.long("general"),
    "roster_wide_general": lambda: oracle_roster.general_map() + "SELECT * FROM rows_",
    "roster_dedupe_general": oracle_roster.dedupe_general,
    "roster_audit_general": oracle_roster.audit_general,
    "roster_header_block": oracle_roster.header_block,
    "roster_dedupe_no_columns": oracle_roster.dedupe_no_columns,
    "roster_flat_headers": oracle_roster.flat_headers,
    "roster_skipped_sheets": oracle_roster.skipped_sheets,
    "table_cells": oracle_misc.table_cells,
    "file_exclude_table": oracle_misc.file_exclude_table,
    "name_n1_degree_caps": lambda: oracle_names.degree_names("degree_caps"),
    "name_n2_degree_dict": lambda: oracle_names.degree_names("degree_dict"),
    "name_n3_credential_org": lambda: oracle_names.credential_names("credential_org"),
    "name_n4_credential_list": lambda: oracle_names.credential_names("credential_list"),
    "name_n5_credential_clean": lambda: oracle_names.credential_names("credential_clean"),
    "name_n6_format_detect": oracle_names.format_detect,
    "name_format_counts": oracle_names.format_counts,
    "name_kind_counts": oracle_names.kind_counts,
    "names_from_cells": lambda: oracle_roster.names_from_cells(NAME_HEADERS),
    "name_issues": oracle_names.issues,
    "name_spec": oracle_spec.spec,
    "name_spec_table": oracle_spec.spec_table,
    "name_spec_issues": lambda: oracle_spec.spec_issues(REVIEW_BELOW),
    "name_confidence": oracle_spec.confidence,
    "json_rows": oracle_misc.json_rows,
    "fill_blanks": lambda: oracle_misc.fill_blanks(),
    "coalesce_first": oracle_misc.coalesce_first,
    "file_tag": oracle_misc.file_tag,
    "file_exclude": lambda: oracle_misc.file_exclude(EXCLUDED_FILES),
    "file_exclusion_counts": lambda: oracle_misc.file_exclusion_counts(EXCLUDED_FILES),
    "file_exclusion_counts_table": oracle_misc.file_exclusion_counts_table,
    "stream_ages": oracle_ages.age_phrase_hdr,
    "stream_names": lambda: oracle_names.credential_names("credential_clean"),
    "path_prefix": oracle_misc.path_prefix,
    "path_listing": oracle_misc.path_listing,
}
