"""Writers for cleaned tables.

Spreadsheet export is replaced by Parquet/CSV/JSON written by Spark's own
writers (one file per task, nothing funnelled through the driver).
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.roster import TRACKING, RosterResult, audit_or_note
from ..operators.roster_map import VALUES
from ..session import land

NAME_FIELDS = ["firstname", "lastname", "middlename", "medical_degree", "organization"]


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite") -> None:
    """Result table as Parquet or CSV (header row; NULL written as '')."""
    w = df.write.mode(mode)
    if fmt == "csv":
        df.na.fill("").write.mode(mode).option("header", True).csv(path)
    elif fmt == "json":
        w.json(path)
    else:
        w.parquet(path)


def write_name_jsonl(df: DataFrame, path: str, fields=NAME_FIELDS, mode: str = "overwrite") -> None:
    """Newline-delimited JSON with the five name fields, '' for missing."""
    df.select(*fields).na.fill("").write.mode(mode).json(path)


def write_records_json(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """JSON records (one object per line, all columns; NULLs kept as null)."""
    df.write.mode(mode).option("ignoreNullFields", False).json(path)


def write_json_array(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """All records as one JSON array, written by many tasks.

    The part files of ``path``, put together in the order of their names, are one valid array: a line with the opening bracket,
    a line a record (all but the first begin with the comma), a line with the closing one. Rows are numbered as they were
    written once, so their order is that of ``df`` and a repeated task writes the same lines; Spark's commit makes the parts
    of a failed attempt vanish."""
    rows = land(df, "records").select(F.monotonically_increasing_id().alias("id"), F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("json"))
    first = rows.agg(F.min("id")).first()[0]
    spark = df.sparkSession
    comma = F.when(F.col("id") == F.lit(first), "").otherwise(",")
    records = rows.select(F.lit(1).alias("place"), "id", F.concat(comma, "json").alias("line"))
    frame = spark.createDataFrame([(0, 0, "["), (2, 0, "]")], "place int, id long, line string")
    frame.unionByName(records).orderBy("place", "id").select("line").write.mode(mode).text(path)


def header_rows(column_map: DataFrame, std_names: list[str]) -> DataFrame:
    """S7 header block of every workbook: header_line 1 has the standard names, line 2 the workbook's original header of each
    ('' where it has none); tracking columns repeat their own name. One row a workbook and line, made from the workbook's
    own columns only; no cell gathers several workbooks."""
    pairs = F.collect_list(F.struct("std_name", "original_header"))
    books = column_map.groupBy("workbook").agg(F.map_from_entries(pairs).alias("names"))
    second = [F.coalesce(F.try_element_at("names", F.lit(n)), F.lit("")) for n in std_names]
    lines = F.array(*[F.struct(F.lit(k + 1).alias("header_line"), *[c.alias(f"c{i}") for i, c in enumerate(cells)])
                      for k, cells in enumerate(([F.lit(n) for n in (*std_names, *TRACKING)], [*second, *map(F.lit, TRACKING)]))])
    names = [*std_names, *TRACKING]
    return books.select("workbook", F.explode(lines).alias("line")).select(
        "workbook", "line.header_line", *[F.col(f"line.c{i}").alias(n) for i, n in enumerate(names)])


def write_roster_map(result: RosterResult, path: str, fmt: str = "csv", mode: str = "overwrite") -> None:
    """S7 + S8 of a roster whose values are maps: as ``write_roster``, the maps as JSON texts; the names and original headers
    of each workbook are ``path/column_map``."""
    def texts(df):
        return df.withColumn(VALUES, F.to_json(VALUES))

    tables = {"combined": texts(result.combined), "column_map": result.column_map, "duplicates_removed": texts(result.audit),
              "note": audit_or_note(result.audit), "skipped_sheets": result.skipped_sheets}
    for name, table in tables.items():
        if table is not None:
            write_table(table, f"{path}/{name}", fmt, mode)


def write_roster(result: RosterResult, path: str, fmt: str = "csv", mode: str = "overwrite") -> None:
    """S7 + S8: ``path/combined`` (data, NULL -> ''), ``path/header`` (a folder
    with the two header rows for each workbook), ``path/column_map``, ``path/duplicates_removed`` (audit),
    ``path/note`` (one 'No duplicates removed' row when the audit is empty) and
    ``path/skipped_sheets`` (sheets without data rows)."""
    cols = result.std_names + TRACKING
    # sorted by the standard columns, NULLs last (a distributed range sort; the
    # combined table has one row per distinct key, so no key is hot)
    ordered = result.combined.orderBy(*[F.col(f"`{c}`").asc_nulls_last() for c in result.std_names]) \
        if result.std_names else result.combined
    combined = ordered.select(*[F.col(f"`{c}`").cast("string").alias(c) for c in cols]).na.fill("")
    hdr = header_rows(result.column_map, result.std_names).repartition("workbook").sortWithinPartitions("workbook", "header_line")
    audit = result.audit.na.fill("")
    note = audit_or_note(result.audit)
    if fmt == "csv":
        combined.write.mode(mode).option("header", False).csv(f"{path}/combined")
        hdr.drop("header_line").write.mode(mode).partitionBy("workbook").option("header", False).csv(f"{path}/header")
        result.column_map.write.mode(mode).option("header", True).csv(f"{path}/column_map")
        audit.write.mode(mode).option("header", True).csv(f"{path}/duplicates_removed")
        note.write.mode(mode).option("header", True).csv(f"{path}/note")
        if result.skipped_sheets is not None:
            result.skipped_sheets.write.mode(mode).option("header", True).csv(f"{path}/skipped_sheets")
    else:
        combined.write.mode(mode).parquet(f"{path}/combined")
        hdr.write.mode(mode).partitionBy("workbook").parquet(f"{path}/header")
        result.column_map.write.mode(mode).parquet(f"{path}/column_map")
        audit.write.mode(mode).parquet(f"{path}/duplicates_removed")
        note.write.mode(mode).parquet(f"{path}/note")
        if result.skipped_sheets is not None:
            result.skipped_sheets.write.mode(mode).parquet(f"{path}/skipped_sheets")
