"""Roster job on the FIXTURES §5 workbook + invariants."""
import pytest
from pyspark.sql import functions as F

from rostrum.operators import roster as R

N = None
SHEETS = {
    ("A", 0): [["Roster as of 2023", N, N, N], ["Provider Name", "Degree", "Primary Specialty", "Tax ID"],
               ["Doe, John", "MD", "Cardiology", "11"], ["Roe, Ann", "DO", "Internal Medicine and Pediatrics Care", "12"],
               [N, N, N, N], ["Doe, John", "MD", "Cardiology", "11"]],
    ("B", 1): [["Degree", "Taxonomy Code", "PCP"], ["MD", "207R", "Y"], [N, "208D", "N"]],
}


def _cells(spark, sheets=SHEETS, workbook="wb.xlsx"):
    rows = [(workbook, s, si, r, c, v) for (s, si), grid in sheets.items()
            for r, line in enumerate(grid) for c, v in enumerate(line) if v is not None]
    return spark.createDataFrame(rows, "workbook string, sheet string, sheet_idx int, row_idx int, col_idx int, "
                                       "value string")


def test_header_rows(spark):
    hr = {r["sheet"]: r["header_row"] for r in R.detect_header_rows(_cells(spark)).collect()}
    assert hr == {"A": 1, "B": 0}


def test_four_list_map_and_combined(spark):
    res = R.standardize_roster(_cells(spark), "four_list")
    cmap = {r["std_name"]: r["original_header"] for r in res.column_map.collect()}
    assert cmap == {"Degree 1": "Degree", "Speciality 1": "Primary Specialty", "Taxonomy 1": "Taxonomy Code",
                    "Role 1": "PCP"}
    assert res.std_names == ["Degree 1", "Speciality 1", "Taxonomy 1", "Role 1"]
    got = [tuple(r[c] for c in res.std_names + R.TRACKING) for r in res.combined.collect()]
    exp = sorted([("DO", N, N, N, 1, 2, "A"), ("MD", "Cardiology", N, N, 2, 2, "A"),
                  ("MD", N, "207R", "Y", 1, 1, "B"), (N, N, "208D", "N", 1, 1, "B")], key=str)
    assert sorted(got, key=str) == exp
    audit = res.audit.collect()
    assert len(audit) == 1
    a = audit[0]
    assert (a["Degree 1"], a["Speciality 1"], a["source_sheet"], a["occurrence_index"], a["removed_reason"]) == \
        ("MD", "Cardiology", "A", 2, "duplicate_of_group")
    assert a["group_key"] == "MD||Cardiology||||"


def test_three_map(spark):
    res = R.standardize_roster(_cells(spark), "three")
    cmap = {r["std_name"]: r["original_header"] for r in res.column_map.collect()}
    assert cmap["Taxonomy 1"] == "Tax ID" and cmap["Taxonomy 2"] == "Taxonomy Code"


def test_invariants_and_partition_independence(spark):
    cells = _cells(spark)
    base = R.standardize_roster(cells, "general")
    n_rows = base.wide.count()
    assert base.combined.agg(F.sum("duplicate_count")).first()[0] == n_rows
    assert base.combined.count() + base.audit.count() == n_rows
    shuffled = R.standardize_roster(cells.repartition(7, "col_idx").orderBy(F.rand(3)), "general")
    key = lambda df: sorted(map(str, df.collect()))
    assert key(shuffled.combined) == key(base.combined)
    assert key(shuffled.audit) == key(base.audit)


def test_duplicate_and_blank_headers(spark):
    # the blank header's column holds no data (else a data row would out-count the header row)
    sheets = {("S", 0): [["Degree", "Degree", N, "Specialty"], ["MD", "DO", N, "Cardiology"],
                         ["MD", "DO", N, "Cardiology"]]}
    res = R.standardize_roster(_cells(spark, sheets), "four_list")
    assert res.std_names == ["Degree 1", "Degree 2", "Speciality 1"]
    rows = res.combined.collect()
    assert len(rows) == 1 and rows[0]["Degree 2"] == "DO" and rows[0]["duplicate_count"] == 2
    gen = R.standardize_roster(_cells(spark, sheets), "general")
    assert "Column_3 1" in gen.std_names


@pytest.mark.parametrize("block", [1, 2, 1 << 16])
def test_blockwise_occurrence_matches_window(spark, block):
    from pyspark.sql import Window
    rows = [("w", "s", 0, r, "hot" if r % 3 else f"k{r % 5}") for r in range(60)]
    rows += [("w", "t", 1, r, "hot") for r in range(25)]
    df = spark.createDataFrame(rows, "workbook string, sheet string, sheet_idx int, row_idx int, group_key string")
    got = R.occurrence_index(df, ["workbook", "group_key"], block_rows=block)
    w = Window.partitionBy("workbook", "group_key").orderBy("sheet_idx", "row_idx")
    exp = df.withColumn("occurrence_index", F.row_number().over(w))
    assert sorted(map(tuple, got.select(exp.columns).collect())) == sorted(map(tuple, exp.collect()))


def test_audit_note(spark):
    sheets = {("S", 0): [["Degree"], ["MD"], ["DO"]]}
    res = R.standardize_roster(_cells(spark, sheets), "four_list")
    assert [r["note"] for r in R.audit_or_note(res.audit).collect()] == ["No duplicates removed"]


def test_table_to_cells_feeds_roster(spark):
    df = spark.createDataFrame([(1, "MD", "Cardiology"), (2, "MD", "Cardiology"), (3, "DO", None)],
                               "n int, Degree string, `Primary Specialty` string")
    cells = R.table_to_cells(df, "t.csv", "S", order_col="n")
    res = R.standardize_roster(cells, "three")
    assert res.std_names == ["Degree 1", "Speciality 1"]
    got = sorted((r["Degree 1"], r["Speciality 1"] or "", r["duplicate_count"]) for r in res.combined.collect())
    assert got == [("DO", "", 1), ("MD", "Cardiology", 2)]


def test_flatten_header_rows(spark):
    sheets = {("S", 0): [["Age", "Age", "Name"], ["Min", "Max", N]]}
    got = {r["col_idx"]: r["header_text"] for r in R.flatten_header_rows(_cells(spark, sheets), [0, 1]).collect()}
    assert got == {0: "Age_Min", 1: "Age_Max", 2: "Name"}


def test_skipped_and_empty_sheets(spark):
    sheets = {("S", 0): [["Degree"], ["MD"]], ("E", 1): [["Degree", "PCP"]]}
    res = R.standardize_roster(_cells(spark, sheets), "four_list")
    assert [r["sheet"] for r in res.skipped_sheets.collect()] == ["E"]
    with pytest.raises(ValueError):
        R.standardize_roster(_cells(spark, {("E", 0): [["Degree", "PCP"]]}), "four_list")
