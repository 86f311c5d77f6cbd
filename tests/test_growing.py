"""What holds for any number of workbooks: maps, records, header blocks, one JSON array, streams that go on, counts by a table."""
import glob
import json

import pytest
from pyspark.sql import functions as F

from rostrum.operators import roster as R
from rostrum.operators import roster_map as M
from rostrum.operators.ages import clean_ages
from rostrum.operators.names import exclude_files, exclusion_counts, observe_exclusion
from rostrum.jobs import run_name_job, run_roster_job
from rostrum.plans.catalog import QUERIES
from rostrum.sinks import header_rows, write_json_array
from rostrum.sources.workbook import cells_to_records, write_xlsx
from rostrum.streaming import clean_available, run_file_stream

CELLS = "workbook string, sheet string, sheet_idx int, row_idx int, col_idx int, value string"
BOOKS = {"a": {"S": [["Name", "Degree", "Degree"], ["Doe", "MD", "RN"], ["Doe", "MD", "RN"], ["Roe", None, "nan"]],
               "T": [["Degree", "Name", ""], ["RN", "Doe", "MD"], [None, "Doe", "x"]]},
         "b": {"S": [["Only here", "Name"], ["1", "Doe"], ["1", "Doe"], ["1", "Doe"]], "E": [["Name"]]}}


@pytest.fixture(scope="module")
def cells(spark):
    rows = [(book, sheet, k, i, j, v) for book, sheets in BOOKS.items() for k, (sheet, grid) in enumerate(sheets.items())
            for i, row in enumerate(grid) for j, v in enumerate(row) if v is not None]
    return spark.createDataFrame(rows, CELLS)


def test_general_as_map(spark, cells):
    res = M.standardize_as_map(cells, materialize=True)
    assert res.std_names == []
    wide = {(r.workbook, r.source_sheet, r.row_idx): r.row_values for r in res.wide.collect()}
    long = {}
    ext = R.sheet_extents(cells)
    hr = R.detect_header_rows(cells, 20, ext)
    hm = R.build_header_map(cells, hr, ext)
    cmap = R.build_column_map(hm, R.sheets_with_data(ext, hr), "general")
    for r in R.standard_long(R.data_cells(cells, hm), cmap).collect():
        long.setdefault((r.workbook, r.sheet, r.row_idx), {})[r.std_name] = r.value
    assert wide == long
    groups = {}
    for (book, _, _), values in long.items():
        groups.setdefault((book, tuple(sorted(values.items()))), []).append(1)
    got = {(r.workbook, tuple(sorted(r.row_values.items()))): r.duplicate_count for r in res.combined.collect()}
    assert got == {k: len(v) for k, v in groups.items()}
    audit = [(r.workbook, tuple(sorted(r.row_values.items())), r.occurrence_index) for r in res.audit.collect()]
    assert sorted(audit) == sorted((*k, i) for k, v in groups.items() for i in range(2, len(v) + 1))
    assert sorted(map(str, M.audit_map(res.wide, 1).collect())) == sorted(map(str, res.audit.collect()))
    assert [(r.workbook, r.sheet) for r in res.skipped_sheets.collect()] == [("b", "E")]
    with pytest.raises(ValueError):
        M.standardize_as_map(cells.filter("row_idx = 0"))


def test_general_job_writes_maps(spark, tmp_path):
    (tmp_path / "in").mkdir()
    for book, sheets in BOOKS.items():
        write_xlsx(sheets, str(tmp_path / "in" / f"{book}.xlsx"))
    out = str(tmp_path / "out")
    run_roster_job(spark, str(tmp_path / "in"), out, "general", fmt="json")
    rows = [json.loads(r.row_values) for r in spark.read.json(f"{out}/combined").collect()]
    assert {"Only Here 1": "1", "Name 1": "Doe"} in rows and spark.read.json(f"{out}/column_map").count() > 5
    assert spark.read.json(f"{out}/duplicates_removed").count() == 3


def test_header_block_is_per_workbook(spark):
    cmap = spark.createDataFrame([("a", "Degree 1", "Degree"), ("a", "Degree 2", "Credentials"), ("b", "Degree 1", "Title, degree")],
                                 "workbook string, std_name string, original_header string")
    got = {(r.workbook, r.header_line): (r["Degree 1"], r["Degree 2"], r.source_sheets) for r in header_rows(cmap, ["Degree 1", "Degree 2"]).collect()}
    assert got == {(b, 1): ("Degree 1", "Degree 2", "source_sheets") for b in "ab"} | {
        ("a", 2): ("Degree", "Credentials", "source_sheets"), ("b", 2): ("Title, degree", "", "source_sheets")}


def test_records(spark, cells):
    got = {(r.source_workbook, r.source_sheet, r.source_row): (r.v, r.header_col_name, r.columns)
           for r in cells_to_records(cells, ["nothing", " NAME "], "v").collect()}
    assert got[("a", "S", 1)] == ("Doe", "Name", {"Degree": "MD", "Degree__dup1": "RN"})
    assert got[("a", "T", 2)] == ("Doe", "Name", {"Column_3": "x"}) and got[("b", "S", 3)] == ("Doe", "Name", {"Only here": "1"})
    first = {(r.source_workbook, r.source_sheet, r.source_row): r.header_col_value for r in cells_to_records(cells, []).collect()}
    assert first[("a", "T", 1)] == "RN" and first[("a", "T", 2)] is None and ("b", "E", 0) not in first
    gap = spark.createDataFrame([("a", "S", 0, 0, 0, "Name"), ("a", "S", 0, 3, 0, "Doe")], CELLS)
    assert [r.header_col_value for r in cells_to_records(gap, ["name"]).orderBy("source_row").collect()] == [None, None, "Doe"]
    assert cells_to_records(gap, ["name"], keep_blank_rows=False).count() == 1


def test_name_job_of_records_with_one_array(spark, tmp_path):
    (tmp_path / "in").mkdir()
    write_xlsx({"S": [["Full Name", "file_name", "x"], ["Doe, John", "a", 1], ["Roe, Ann", "b", None]]}, str(tmp_path / "in" / "one.xlsx"))
    write_xlsx({"S": [["Other", "Full Name"], ["y", "Poe, Edgar"]]}, str(tmp_path / "in" / "two.xlsx"))
    out = str(tmp_path / "out")
    run_name_job(spark, str(tmp_path / "in"), out, "credential_clean", fmt="json", json="array", layout="records")
    text = "".join(open(f).read() for f in sorted(glob.glob(f"{out}/json/part-*")))
    rows = json.loads(text)
    assert [(r["last_name"], r["first_name"]) for r in rows] == [("Doe", "John"), ("Roe", "Ann"), ("Poe", "Edgar")]
    assert json.loads(rows[0]["columns"]) == {"file_name": "a", "x": "1"}


def test_name_job_writes_its_summary(spark, tmp_path):
    (tmp_path / "in").mkdir()
    write_xlsx({"S": [["header_col_value", "file_name"], ["Doe, John", "a"], ["Roe, Ann", "b"]]}, str(tmp_path / "in" / "one.xlsx"))
    out = str(tmp_path / "out")
    names = spark.createDataFrame([("A ",)], "file_name string")
    got = run_name_job(spark, str(tmp_path / "in"), out, "credential_clean", exclude=names)
    assert [r.last_name for r in got.collect()] == ["Roe"]
    assert spark.read.json(f"{out}/summary").first().asDict() == {"n_excluded": 1, "n_input": 2, "n_output": 1}


@pytest.mark.parametrize("n", [0, 1, 1000])
def test_json_array_over_many_parts(spark, tmp_path, n):
    df = spark.range(n).select("id", F.when(F.col("id") % 3 > 0, F.concat(F.lit('q"\n'), "id")).alias("v")).repartition(7).sortWithinPartitions("id")
    out, setting = str(tmp_path / "out"), "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(setting, "false")
    try:
        write_json_array(df, out)
    finally:
        spark.conf.unset(setting)
    parts = sorted(glob.glob(f"{out}/part-*"))
    rows = json.loads("".join(open(f).read() for f in parts))
    assert sorted(r["id"] for r in rows) == list(range(n)) and all("v" in r for r in rows)
    assert n < 1000 or len(parts) > 1


def test_failed_task_leaves_a_whole_array(spark, tmp_path):
    out = str(tmp_path / "out")
    write_json_array(spark.range(10), out)
    with pytest.raises(Exception):
        write_json_array(spark.range(100).select(F.when(F.col("id") == 77, F.raise_error(F.lit("no"))).otherwise(F.col("id")).alias("id")), out)
    assert len(json.loads("".join(open(f).read() for f in sorted(glob.glob(f"{out}/part-*"))))) == 10


def test_stream_goes_on_where_it_stopped(spark, tmp_path):
    src, folder = str(tmp_path / "in"), str(tmp_path / "run")
    schema = "id int, header_col_value string, header_col_name string"

    def more(ids):
        spark.createDataFrame([(i, f"{i}+", "Minimum Age") for i in ids], schema).coalesce(1).write.mode("append").parquet(src)

    def clean(frame):
        return clean_ages(frame, "phrase_hdr")

    def failing(frame):
        return clean(frame).filter(F.when(F.col("id") == 4, F.raise_error(F.lit("lost"))).otherwise(F.lit(True)).cast("boolean"))

    more([1, 2])
    assert sorted(r.id for r in clean_available(spark, src, schema, clean, folder).collect()) == [1, 2]
    assert sorted(r.id for r in clean_available(spark, src, schema, clean, folder).collect()) == [1, 2]
    more([3])
    more([4])
    query = run_file_stream(spark, src, schema, failing, f"{folder}/out", f"{folder}/checkpoint", files_per_batch=1)
    with pytest.raises(Exception):
        query.awaitTermination()
    got = clean_available(spark, src, schema, clean, folder, files_per_batch=1)
    want = clean_ages(spark.read.parquet(src), "phrase_hdr")
    assert sorted(map(str, got.select(want.columns).collect())) == sorted(map(str, want.collect())) and got.count() == 4


def test_exclusion_by_table_counts_what_it_drops(spark):
    rows = spark.createDataFrame([("a.xlsx",), (" A.XLSX",), ("b.xlsx",), (None,), ("Roster Files - top 20 entities_desensitized.xlsx",)], "file_name string")
    names = spark.createDataFrame([("A.xlsx ",), ("a.xlsx",), ("roster files - top 20 entities_desensitized.xlsx",)], "file_name string")
    kept = exclude_files(rows, "file_name", names)
    assert exclusion_counts(rows, "file_name", names).first() == (5, 2, kept.count()) == (5, 2, 3)
    seen, obs = observe_exclusion(rows, "file_name", names)
    assert seen.columns == ["file_name"] and seen.count() == 5 and obs.get == {"n_input": 5, "n_excluded": 2}


@pytest.mark.parametrize("name", ["roster_header_rows", "roster_header_map", "roster_column_map_three", "roster_flat_headers", "roster_skipped_sheets",
                                  "roster_header_block"])
def test_header_work_grows(spark, name):
    small, large = (QUERIES[name](spark, f"/root/testdata/{sf}").count() for sf in ("sf0.001", "sf0.01"))
    assert large >= 2 * small > 0
