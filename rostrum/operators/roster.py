"""Roster standardization (job R1): many sheets -> one standard table + audit.

Input is the long cell table produced by a workbook source::

    raw_cells(workbook, sheet, sheet_idx, row_idx, col_idx, value)   -- 0-based

Plan (each step a DataFrame operator; shuffles noted):

1. header row per sheet: first row with the most non-null cells among the first
   ``max_rows`` rows  [aggregate on the ``row_idx < 20`` slice only]
2. header map: header text per (sheet, col_idx) over the whole grid width;
   blank -> ``Column_<i+1>``; duplicates numbered (``__dupN``)   [tiny]
3. data cells: cells below the header row, text-normalised, joined to their
   header  [join with the per-sheet header table; AQE picks broadcast when it
   is small at run time]
4. column map: distinct headers -> base standard name -> numbered slot
   ("Degree 1", "Degree 2") in first-seen order  [tiny; one driver collect of
   the standard column names, needed for the pivot schema]
5. wide table: pivot cells to one row per sheet row  [shuffle by row key]
6. dedupe: group by all standard columns  [partial aggregation, skew-safe]
7. audit: every repeat occurrence of a group with its occurrence number, in
   blocks of bounded size so a hot duplicate group never lands in one task
   [one shuffle by key and block; small window over block sizes; join by block]
"""
from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import headers as H
from ..functions.text import pstrip
from .joins import materialize as materialize_df

TRACKING = ["duplicate_count", "header_row_number", "source_sheets"]
SHEET_KEYS = ["workbook", "sheet", "sheet_idx"]
ROW_KEYS = ["workbook", "sheet", "sheet_idx", "row_idx"]


def normalize_cell(value: Column) -> Column:
    """Cell -> trimmed text; the text 'nan' becomes NULL."""
    v = pstrip(value.cast("string"))
    return F.when(v != "nan", v)


# ------------------------------- step 1 -------------------------------------
def sheet_extents(cells: DataFrame) -> DataFrame:
    """(workbook, sheet, sheet_idx, max_col, last_row): every sheet, its grid
    width and the last row holding a non-null (normalised) value -- one
    partial aggregate, so "does the sheet have data below its header" needs
    no second pass over the body."""
    v = normalize_cell(F.col("value"))
    return cells.groupBy(*SHEET_KEYS).agg(F.max("col_idx").alias("max_col"),
                                          F.max(F.when(v.isNotNull(), F.col("row_idx"))).alias("last_row"))


def detect_header_rows(cells: DataFrame, max_rows: int = 20, extents: DataFrame | None = None) -> DataFrame:
    """(workbook, sheet, sheet_idx, header_row): per sheet, the first row with
    the largest number of non-null cells among rows ``0 .. max_rows-1``.
    Only the ``row_idx < max_rows`` slice is read (a pushed-down filter)."""
    probe = (cells.filter((F.col("row_idx") < max_rows) & F.col("value").isNotNull())
             .groupBy(*SHEET_KEYS, "row_idx").agg(F.count(F.lit(1)).alias("n")))
    best = probe.groupBy(*SHEET_KEYS).agg(
        F.min_by("row_idx", F.struct(-F.col("n"), F.col("row_idx"))).alias("header_row"))
    sheets = (extents if extents is not None else sheet_extents(cells)).select(*SHEET_KEYS)
    return (sheets.join(best, SHEET_KEYS, "left")
            .select(*SHEET_KEYS, F.coalesce("header_row", F.lit(0)).cast("int").alias("header_row")))


# ------------------------------- step 2 -------------------------------------
def build_header_map(cells: DataFrame, header_rows: DataFrame, extents: DataFrame | None = None,
                     max_rows: int = 20) -> DataFrame:
    """(workbook, sheet, sheet_idx, col_idx, header_row, header_text, dup_n).

    Every column of the grid (0 .. max col_idx of the sheet) gets a header;
    blank headers become ``Column_<col_idx+1>``; the n-th repeat of a header
    text within a sheet has ``dup_n = n``.
    """
    width = extents if extents is not None else sheet_extents(cells)
    grid = width.select(*SHEET_KEYS, F.explode(F.sequence(F.lit(0), F.col("max_col"))).alias("col_idx"))
    hdr_cells = (cells.filter(F.col("row_idx") < max_rows)
                 .join(header_rows, SHEET_KEYS)
                 .filter(F.col("row_idx") == F.col("header_row"))
                 .select(*SHEET_KEYS, "col_idx", F.col("value").alias("raw_header")))
    text = pstrip(F.coalesce(F.col("raw_header").cast("string"), F.lit("")))
    hm = (grid.join(header_rows, SHEET_KEYS)
          .join(hdr_cells, SHEET_KEYS + ["col_idx"], "left")
          .withColumn("header_text", F.when(text == "", F.concat(F.lit("Column_"),
                                                                 (F.col("col_idx") + 1).cast("string")))
                      .otherwise(text)))
    w = Window.partitionBy(*SHEET_KEYS, "header_text").orderBy("col_idx")
    return hm.select(*SHEET_KEYS, "col_idx", "header_row", "header_text",
                     F.row_number().over(w).alias("dup_n"))




# ------------------------------- step 3 -------------------------------------
def data_cells(cells: DataFrame, header_map: DataFrame) -> DataFrame:
    """Cells below their sheet's header row with a non-null normalised value,
    tagged with every column of ``header_map`` (joined on sheet + col_idx).
    No join hint: Spark knows the bytes of the materialised ``header_map`` and
    broadcasts it only below its own threshold; beyond, skewed sheets are
    split by the adaptive skew join."""
    v = normalize_cell(F.col("value"))
    body = (cells.select(*ROW_KEYS, "col_idx", v.alias("v"))
            .filter(F.col("v").isNotNull()))
    keys = SHEET_KEYS + ["col_idx"]
    joined = body.join(header_map, keys)
    extra = [c for c in header_map.columns if c not in keys]
    return (joined.filter(F.col("row_idx") > F.col("header_row"))
            .select(*ROW_KEYS, "col_idx", *extra, "v"))


# ------------------------------- step 4 -------------------------------------
def sheets_with_data(extents: DataFrame, header_rows: DataFrame | None = None) -> DataFrame:
    """Sheets with at least one data row below the header row.  ``extents``
    may already carry ``header_row`` (the materialised sheet table)."""
    info = extents if header_rows is None else extents.join(header_rows, SHEET_KEYS)
    return info.filter(F.col("last_row") > F.col("header_row")).select(*SHEET_KEYS)


def build_column_map(header_map: DataFrame, with_data: DataFrame, profile: str,
                     include: Mapping[str, Sequence[str]] | None = None,
                     exclude: Mapping[str, Sequence[str]] | None = None) -> DataFrame:
    """(workbook, header_text, dup_n, original_header, base, slot, std_name, base_order).

    Only sheets that still have data rows (``with_data``: sheet keys, or the
    data cells themselves) contribute columns.  Slots are numbered per base in
    first-seen order (sheet order, then column order).
    """
    with_data = with_data.select(*SHEET_KEYS).distinct()
    cols = (header_map.join(with_data, SHEET_KEYS, "left_semi")
            .groupBy("workbook", "header_text", "dup_n")
            .agg(F.min(F.struct("sheet_idx", "col_idx")).alias("first_seen")))
    base = H.standard_name(F.col("header_text"), profile, include, exclude)
    cols = cols.withColumn("base", base)
    kept = H.kept_bases(profile)
    if kept is None:
        cols = cols.withColumn("base", F.when(pstrip(F.col("base")) == "", F.lit("Column"))
                               .otherwise(F.col("base")))
        wb = Window.partitionBy("workbook", "base")
        cols = cols.withColumn("base_first", F.min("first_seen").over(wb))
        order = Window.partitionBy("workbook").orderBy("base_first")
        cols = cols.withColumn("base_order", F.dense_rank().over(order))
    else:
        cols = cols.filter(F.col("base").isin(*kept))
        order_map = F.create_map(*[x for i, b in enumerate(kept) for x in (F.lit(b), F.lit(i + 1))])
        cols = cols.withColumn("base_order", F.element_at(order_map, F.col("base")))
    slot = F.row_number().over(Window.partitionBy("workbook", "base").orderBy("first_seen"))
    return cols.select(
        "workbook", "header_text", "dup_n", F.col("header_text").alias("original_header"), "base",
        slot.alias("slot"), F.concat_ws(" ", F.col("base"), slot.cast("string")).alias("std_name"),
        F.col("base_order").cast("int").alias("base_order"), "first_seen")


def std_column_names(column_map: DataFrame) -> list[str]:
    """Ordered standard column names (small driver-side collect: one row per
    standard column, bounded by bases x slots, not by data size)."""
    rows = (column_map.groupBy("std_name", "base")
            .agg(F.min("base_order").alias("bo"), F.min("slot").alias("slot"))
            .orderBy("bo", "slot").collect())
    return [r["std_name"] for r in rows]


# ------------------------------- step 5 -------------------------------------
def value_filter(v: Column) -> Column:
    """Speciality/Role cells: blank -> NULL; more than 3 word tokens -> NULL."""
    words = F.size(F.regexp_extract_all(pstrip(v), F.lit(r"(?U)\w+"), F.lit(0)))
    return F.when(v.isNull() | (pstrip(v) == ""), F.lit(None).cast("string")) \
        .when(words <= 3, v).otherwise(F.lit(None).cast("string"))


def cell_mapping(header_map: DataFrame, column_map: DataFrame) -> DataFrame:
    """(sheet keys, col_idx, header_row, std_name): every grid column of every
    sheet with its standard column (NULL when the profile drops it)."""
    return header_map.join(column_map.select("workbook", "header_text", "dup_n", "std_name"),
                           ["workbook", "header_text", "dup_n"], "left") \
        .select(*SHEET_KEYS, "col_idx", "header_row", "std_name")


def pivot_wide(cells_below: DataFrame, column_map: DataFrame | None, std_names: list[str],
               profile: str) -> DataFrame:
    """One row per data row: standard columns + tracking columns.  When
    ``column_map`` is None the cells already carry ``std_name``."""
    if column_map is None:
        mapped = cells_below
    else:
        mapped = cells_below.join(column_map.select("workbook", "header_text", "dup_n", "std_name"),
                                  ["workbook", "header_text", "dup_n"], "left")
    keys = ROW_KEYS + ["header_row"]
    if std_names:
        # One map per row (hash aggregate; at most one entry per sheet column),
        # then one column per standard name -- same result as
        # pivot(std_name, std_names).agg(first(v)) without a sort-based aggregate.
        pairs = F.collect_list(F.when(F.col("std_name").isNotNull(), F.struct("std_name", "v")))
        wide = (mapped.groupBy(*keys).agg(F.map_from_entries(pairs).alias("__m"))
                .select(*keys, *[F.try_element_at("__m", F.lit(n)).alias(n) for n in std_names]))
    else:
        wide = mapped.select(*keys).distinct()
    filt = profile in ("four", "four_regex", "four_list")
    cols = []
    for n in std_names:
        c = F.col(f"`{n}`")
        if filt and n.split(" ")[0] in ("Speciality", "Role"):
            c = value_filter(c)
        cols.append(c.alias(n))
    return wide.select(*cols, (F.col("header_row") + 1).alias("header_row_number"),
                       F.col("sheet").alias("source_sheet"), "workbook", "sheet_idx", "row_idx")


def standard_long(cells_below: DataFrame, column_map: DataFrame) -> DataFrame:
    """(workbook, sheet, sheet_idx, row_idx, std_name, value): the data cells under
    their standard names. For ``general``, whose names grow with the headers: no
    column and nothing on the driver grows with the input."""
    mapped = cells_below.join(column_map.select("workbook", "header_text", "dup_n", "std_name"),
                              ["workbook", "header_text", "dup_n"])
    return mapped.select(*ROW_KEYS, "std_name", F.col("v").alias("value"))


# ------------------------------ steps 6-7 -----------------------------------
def group_key(cols: Sequence[str]) -> Column:
    """Values joined by '||', NULL as ''."""
    return F.concat_ws("||", *[F.coalesce(F.col(f"`{c}`"), F.lit("")) for c in cols])


def dedupe(wide: DataFrame, data_cols: Sequence[str]) -> DataFrame:
    """One row per distinct combination of standard values (NULL is a value)."""
    if not data_cols:
        return wide.select("source_sheet", F.lit(1).cast("long").alias("duplicate_count"),
                           "header_row_number", F.col("source_sheet").alias("source_sheets"),
                           "workbook").drop("source_sheet")
    agg = (wide.groupBy("workbook", *[F.col(f"`{c}`") for c in data_cols])
           .agg(F.count(F.lit(1)).alias("duplicate_count"),
                F.min("header_row_number").alias("header_row_number"),
                F.array_join(F.sort_array(F.collect_set("source_sheet")), ",").alias("source_sheets")))
    return agg.select(*[F.col(f"`{c}`") for c in data_cols], *TRACKING, "workbook")


def occurrence_index(rows: DataFrame, key_cols: Sequence[str], block_rows: int = 1 << 16) -> DataFrame:
    """Add ``occurrence_index`` (1-based position of each row inside its key
    group in (sheet_idx, row_idx) order) and ``group_rows`` (the group's size).

    Skew-safe: rows are shuffled by key and block, a block being at most
    ``block_rows`` consecutive rows of one sheet, and numbered inside it. Only
    block sizes (summed before their shuffle, one row per block) meet by key
    alone; they become the offsets and the group's size. ``rows`` is read
    twice, so pass a written table where it is expensive.
    """
    blk = F.floor(F.col("row_idx") / block_rows).cast("long")
    b = rows.withColumn("__blk", blk)
    bkeys = [*key_cols, "sheet_idx", "__blk"]
    sizes = b.groupBy(*bkeys).agg(F.count(F.lit(1)).alias("__n"))
    group = Window.partitionBy(*key_cols)
    before = group.orderBy("sheet_idx", "__blk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(*bkeys, F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__off"),
                           F.sum("__n").over(group).alias("group_rows"))
    inner = F.row_number().over(Window.partitionBy(*bkeys).orderBy("row_idx"))
    return (b.withColumn("__in", inner).join(offsets, bkeys)
            .withColumn("occurrence_index", F.col("__off") + F.col("__in"))
            .drop("__blk", "__off", "__in"))


def audit(wide: DataFrame, data_cols: Sequence[str], block_rows: int = 1 << 16) -> DataFrame:
    """Rows removed as duplicates: every occurrence after the first."""
    if not data_cols:
        schema = ", ".join(["source_sheet string", "header_row_number long", "group_key string",
                            "occurrence_index long", "removed_reason string", "workbook string"])
        return wide.sparkSession.createDataFrame([], schema)
    keyed = wide.withColumn("group_key", group_key(data_cols))
    occ = occurrence_index(keyed, ["workbook", "group_key"], block_rows)
    return (occ.filter(F.col("occurrence_index") > 1)
            .select(*[F.col(f"`{c}`") for c in data_cols], "source_sheet", "header_row_number",
                    "group_key", "occurrence_index", F.lit("duplicate_of_group").alias("removed_reason"),
                    "workbook"))


def audit_or_note(audit_df: DataFrame) -> DataFrame:
    """The one-row note written instead of an empty audit (a global count, no collect)."""
    return (audit_df.agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") == 0)
            .select(F.lit("No duplicates removed").alias("note")))


@dataclass
class RosterResult:
    combined: DataFrame      # deduplicated standard table
    audit: DataFrame         # removed duplicate occurrences
    column_map: DataFrame    # std_name -> original header
    wide: DataFrame          # standard table before de-duplication
    header_rows: DataFrame   # header row per sheet
    std_names: list[str]
    skipped_sheets: DataFrame | None = None   # sheets without data rows (U2)


def standardize_roster(cells: DataFrame, profile: str = "four_list", max_header_rows: int = 20,
                       include: Mapping[str, Sequence[str]] | None = None,
                       exclude: Mapping[str, Sequence[str]] | None = None,
                       materialize: bool = False, materialize_input: bool = False,
                       block_rows: int = 1 << 16) -> RosterResult:
    """Job R1.

    Passes over the cell table: one partial aggregate (sheet extents), the
    ``row_idx < max_header_rows`` slice (header rows and header texts) and one
    scan of the body.  The per-sheet header map and the column map are tiny,
    materialised to the shared checkpoint folder, and joined to the body
    (Spark broadcasts them by their bytes); the body is shuffled once for the pivot and once
    for de-duplication.

    ``materialize_input=True`` checkpoints the cell table first (when it is an
    expensive derived plan).  ``materialize=True`` checkpoints the wide table so
    the dedupe and audit outputs do not both recompute the pivot.
    """
    if materialize_input:
        cells = materialize_df(cells)
    ext = sheet_extents(cells)
    # one small table per sheet: grid width, last data row, header row
    info = materialize_df(ext.join(detect_header_rows(cells, max_header_rows, ext), SHEET_KEYS))
    hr = info.select(*SHEET_KEYS, "header_row")
    with_data = sheets_with_data(info)
    if with_data.isEmpty():   # tiny materialised table
        raise ValueError("No data found in any sheet to process.")
    skipped = info.select(*SHEET_KEYS).join(with_data, SHEET_KEYS, "left_anti")
    hm = materialize_df(build_header_map(cells, hr, info, max_header_rows))
    cmap = materialize_df(build_column_map(hm, with_data, profile, include, exclude))
    names = std_column_names(cmap)
    below = data_cells(cells, cell_mapping(hm, cmap))
    wide = pivot_wide(below, None, names, profile)
    if materialize:
        wide = materialize_df(wide)
    return RosterResult(combined=dedupe(wide, names), audit=audit(wide, names, block_rows),
                        column_map=cmap.select("workbook", "std_name", "original_header", "base", "slot"),
                        wide=wide, header_rows=hr, std_names=names, skipped_sheets=skipped)


# --------------------------- table <-> cells (X2, C8) ------------------------
def table_to_cells(df: DataFrame, workbook: str, sheet: str, sheet_idx: int = 0,
                   order_col: str | None = None) -> DataFrame:
    """A wide table (CSV/Parquet landing) -> cells of one sheet, header in row 0.

    ``order_col`` is the explicit, non-negative integer ingest position of each
    row (row order must be a column, never an implicit id); data row ``k``
    becomes sheet row ``k + 1``.  Values go through ``unpivot`` -- a narrow
    operation, no global numbering window.  NULL cells are not emitted."""
    if order_col is None:
        raise ValueError("order_col is required: row order must be an explicit column")
    cols = [c for c in df.columns if c != order_col]
    spark = df.sparkSession
    header = spark.createDataFrame([(workbook, sheet, sheet_idx, 0, i, c) for i, c in enumerate(cols)],
                                   "workbook string, sheet string, sheet_idx int, row_idx long, col_idx int, "
                                   "value string")
    numbered = df.select((F.col(f"`{order_col}`").cast("long") + 1).alias("row_idx"),
                         *[F.col(f"`{c}`").cast("string").alias(f"c{i}") for i, c in enumerate(cols)])
    long = numbered.unpivot("row_idx", [f"c{i}" for i in range(len(cols))], "col", "value")
    body = long.filter(F.col("value").isNotNull()).select(
        F.lit(workbook).alias("workbook"), F.lit(sheet).alias("sheet"), F.lit(sheet_idx).alias("sheet_idx"),
        "row_idx", F.expr("cast(substring(col, 2) as int)").alias("col_idx"), "value")
    return header.unionByName(body)


def flatten_header_rows(cells: DataFrame, header_rows: list[int], sep: str = "_") -> DataFrame:
    """Several header rows -> one header text per (sheet, col_idx): the
    non-null header cells joined by ``sep`` top to bottom (tiny aggregate)."""
    top = cells.filter(F.col("row_idx").isin(*header_rows) & F.col("value").isNotNull())
    parts = F.array_sort(F.collect_list(F.struct("row_idx", F.col("value").cast("string").alias("v"))))
    return top.groupBy(*SHEET_KEYS, "col_idx").agg(
        F.array_join(F.transform(parts, lambda p: p["v"]), sep).alias("header_text"))
