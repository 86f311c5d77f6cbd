"""Roster standardization with the standard values of a row in one map column.

Profile ``general`` keeps every header, so its standard names grow with the workbooks. Here
they are never columns and never reach the driver: a row has ``row_values``, a map from
standard name to value. De-duplication and audit group by the map's sorted entries, which
equal maps have in common, whatever the order of their sheets' columns.
"""
from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import roster as R
from .joins import materialize as materialize_df

VALUES = "row_values"


def map_rows(cells_below: DataFrame, profile: str = "general") -> DataFrame:
    """One row per sheet row of ``R.data_cells`` with std_name: ``row_values``, header_row_number, source_sheet, workbook,
    sheet_idx, row_idx. One shuffle by row; a row has at most an entry for each column of its sheet."""
    value = F.col("v")
    if profile in ("four", "four_regex", "four_list"):
        short = F.split("std_name", " ").getItem(0).isin("Speciality", "Role")
        value = F.when(short, R.value_filter(value)).otherwise(value)
    entry = F.when(F.col("std_name").isNotNull() & value.isNotNull(), F.struct(F.col("std_name").alias("key"), value.alias("value")))
    rows = cells_below.groupBy(*R.ROW_KEYS, "header_row").agg(F.map_from_entries(F.array_sort(F.collect_list(entry))).alias(VALUES))
    return rows.select(VALUES, (F.col("header_row") + 1).alias("header_row_number"), F.col("sheet").alias("source_sheet"), "workbook",
                       "sheet_idx", "row_idx")


def entries(values: Column) -> Column:
    """A map's entries by key: equal for equal maps, and a key to group by."""
    return F.array_sort(F.map_entries(values))


def text_of(values: Column, sep: str = "||") -> Column:
    """A map as text: name=value, by name."""
    return F.array_join(F.transform(entries(values), lambda e: F.concat(e["key"], F.lit("="), e["value"])), sep)


def dedupe_map(rows: DataFrame) -> DataFrame:
    """One row per distinct map of a workbook, with the tracking columns (partial aggregation first)."""
    found = rows.groupBy("workbook", entries(F.col(VALUES)).alias("entries")).agg(
        F.count(F.lit(1)).alias("duplicate_count"), F.min("header_row_number").alias("header_row_number"),
        F.array_join(F.sort_array(F.collect_set("source_sheet")), ",").alias("source_sheets"))
    return found.select(F.map_from_entries("entries").alias(VALUES), *R.TRACKING, "workbook")


def audit_map(rows: DataFrame, block_rows: int = 1 << 16) -> DataFrame:
    """Every occurrence of a map after the first, in blocks as ``R.audit``; ``group_key`` is the map as text."""
    keyed = rows.withColumn("__entries", entries(F.col(VALUES)))
    numbered = R.occurrence_index(keyed, ["workbook", "__entries"], block_rows)
    return (numbered.filter(F.col("occurrence_index") > 1)
            .select(VALUES, "source_sheet", "header_row_number", text_of(F.col(VALUES)).alias("group_key"), "occurrence_index",
                    F.lit("duplicate_of_group").alias("removed_reason"), "workbook"))


def standardize_as_map(cells: DataFrame, profile: str = "general", max_header_rows: int = 20,
                       include: Mapping[str, Sequence[str]] | None = None, exclude: Mapping[str, Sequence[str]] | None = None,
                       materialize: bool = False, materialize_input: bool = False, block_rows: int = 1 << 16) -> R.RosterResult:
    """Job R1 with maps (see ``R.standardize_roster``); nothing but the test for an empty input reaches the driver."""
    if materialize_input:
        cells = materialize_df(cells)
    ext = R.sheet_extents(cells)
    info = materialize_df(ext.join(R.detect_header_rows(cells, max_header_rows, ext), R.SHEET_KEYS))
    header_rows = info.select(*R.SHEET_KEYS, "header_row")
    with_data = R.sheets_with_data(info)
    if with_data.isEmpty():
        raise ValueError("No data found in any sheet to process.")
    header_map = materialize_df(R.build_header_map(cells, header_rows, info, max_header_rows))
    column_map = materialize_df(R.build_column_map(header_map, with_data, profile, include, exclude))
    rows = map_rows(R.data_cells(cells, R.cell_mapping(header_map, column_map)), profile)
    if materialize:
        rows = materialize_df(rows)
    return R.RosterResult(combined=dedupe_map(rows), audit=audit_map(rows, block_rows),
                          column_map=column_map.select("workbook", "std_name", "original_header", "base", "slot"), wide=rows,
                          header_rows=header_rows, std_names=[],
                          skipped_sheets=info.select(*R.SHEET_KEYS).join(with_data, R.SHEET_KEYS, "left_anti"))
