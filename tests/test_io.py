import os
import tempfile

from pyspark.sql import functions as F

from rostrum.operators.roster import standardize_roster
from rostrum.sinks import write_name_jsonl, write_roster
from rostrum.sources.workbook import check_sheet, read_workbooks, write_xlsx
from rostrum.operators.ages import clean_ages
from rostrum.operators.names import clean_names
from rostrum.streaming import run_file_stream


def test_xlsx_roundtrip_and_roster(spark):
    d = tempfile.mkdtemp(prefix="rostrum-xlsx-")
    write_xlsx({"A": [["Roster as of 2023"], ["Provider Name", "Degree", "Primary Specialty", "Tax ID"],
                      ["Doe, John", "MD", "Cardiology", 11], ["Doe, John", "MD", "Cardiology", 11]],
                "B": [["Degree", "Taxonomy Code", "PCP"], ["MD", "207R", "Y"]]}, os.path.join(d, "wb.xlsx"))
    cells = read_workbooks(spark, d)
    got = {(r["sheet"], r["row_idx"], r["col_idx"]): r["value"] for r in cells.collect()}
    assert got[("A", 2, 3)] == "11" and got[("B", 0, 0)] == "Degree" and got[("A", 0, 0)] == "Roster as of 2023"
    assert check_sheet(cells, "B") == "B"
    res = standardize_roster(cells, "four_list")
    assert res.combined.filter(F.col("duplicate_count") == 2).count() == 1
    out = tempfile.mkdtemp(prefix="rostrum-out-")
    write_roster(res, out)
    hdr = spark.read.csv(f"{out}/header").collect()
    assert hdr[0][0] == "Degree 1" and hdr[1][0] == "Degree"
    assert spark.read.option("header", True).csv(f"{out}/duplicates_removed").count() == 1
    assert spark.read.option("header", True).csv(f"{out}/note").count() == 0


def test_name_jsonl(spark):
    from rostrum.operators.names import clean_names
    df = spark.createDataFrame([("Doe, John, MD",), (None,)], "header_col_value string")
    out = tempfile.mkdtemp(prefix="rostrum-json-")
    write_name_jsonl(clean_names(df, "degree_dict"), out)
    rows = spark.read.json(out).collect()
    assert sorted(r["medical_degree"] for r in rows) == ["MD", "NA"]


def test_stream_ages(spark):
    src = tempfile.mkdtemp(prefix="rostrum-src-")
    spark.createDataFrame([(1, "18+", "Minimum Age"), (2, "Under 18", None)],
                          "id int, header_col_value string, header_col_name string").write.mode("append").parquet(src)
    sink, ck = tempfile.mkdtemp(prefix="rostrum-sink-"), tempfile.mkdtemp(prefix="rostrum-ck-")
    q = run_file_stream(spark, src, "id int, header_col_value string, header_col_name string",
                        lambda s: clean_ages(s, "phrase_hdr"), sink, ck)
    q.awaitTermination(120)
    got = {r["id"]: (r["min_age"], r["max_age"]) for r in spark.read.parquet(sink).collect()}
    assert got == {1: (18.0, 150.0), 2: (0.0, 18.0)}


def test_xlsx_dates_read_as_datetime_text(spark):
    import datetime as dt
    d = tempfile.mkdtemp(prefix="rostrum-xlsx-dates-")
    write_xlsx({"S": [["Name", "DOB", "N"], ["Doe", dt.date(1980, 2, 29), 12.5], ["Roe", dt.datetime(2023, 1, 5, 10, 30), 3]]},
               os.path.join(d, "d.xlsx"))
    got = {(r["row_idx"], r["col_idx"]): r["value"] for r in read_workbooks(spark, d).collect()}
    assert got[(1, 1)] == "1980-02-29 00:00:00" and got[(2, 1)] == "2023-01-05 10:30:00"
    assert got[(1, 2)] == "12.5" and got[(2, 2)] == "3"


def test_xlsx_default_missing_texts(spark):
    d = tempfile.mkdtemp(prefix="rostrum-xlsx-na-")
    write_xlsx({"S": [["A", "B"], ["None", "NA"], ["x", "n/a"]]}, os.path.join(d, "na.xlsx"))
    assert sorted(r["value"] for r in read_workbooks(spark, d).collect()) == ["A", "B", "x"]
    assert len(read_workbooks(spark, d, na_values=()).collect()) == 6


def test_stream_names(spark):
    src = tempfile.mkdtemp(prefix="rostrum-nsrc-")
    spark.createDataFrame([(1, "Doe, John, MD", "a.xlsx"), (2, "St Mary Hospital", "a.xlsx")],
                          "id int, header_col_value string, file_name string").write.mode("append").parquet(src)
    sink, ck = tempfile.mkdtemp(prefix="rostrum-nsink-"), tempfile.mkdtemp(prefix="rostrum-nck-")
    q = run_file_stream(spark, src, "id int, header_col_value string, file_name string",
                        lambda s: clean_names(s, "credential_org"), sink, ck)
    q.awaitTermination(120)
    got = {r["id"]: (r["first_name"], r["last_name"], r["designation"], r["organization"])
           for r in spark.read.parquet(sink).collect()}
    assert got == {1: ("John", "Doe", "MD", ""), 2: ("", "", "", "St Mary Hospital")}


def test_sheet_check_report(spark):
    from rostrum.sources.workbook import sheet_check_report
    cells = spark.createDataFrame([("a.xlsx", "S", 0, 0, 0, "x"), ("a.xlsx", "T", 1, 0, 0, "y"),
                                   ("b.xlsx", "S", 0, 0, 0, "z")],
                                  "workbook string, sheet string, sheet_idx int, row_idx int, col_idx int, value string")
    assert [r["workbook"] for r in sheet_check_report(cells).collect()] == ["a.xlsx"]
    assert sorted(r["workbook"] for r in sheet_check_report(cells, "T").collect()) == ["b.xlsx"]
    assert sheet_check_report(cells, "S").count() == 0


def _raw_book(path, sheets, rels):
    """A workbook from (name, sheet xml) and relationship targets, as other writers lay it out."""
    import zipfile
    ns = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    rns = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
    with zipfile.ZipFile(path, "w") as z:
        names = "".join(f'<sheet name="{n}" sheetId="{i}" r:id="r{i}"/>' for i, (n, _) in enumerate(sheets))
        z.writestr("xl/workbook.xml", f'<workbook {ns} xmlns:r="{rns}"><sheets>{names}</sheets></workbook>')
        z.writestr("xl/_rels/workbook.xml.rels", '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">'
                   + "".join(f'<Relationship Id="r{i}" Target="{t}"/>' for i, t in enumerate(rels)) + "</Relationships>")
        for i, (_, xml) in enumerate(sheets):
            if xml is not None:
                z.writestr(f"xl/worksheets/sheet{i + 1}.xml", f"<worksheet {ns}><sheetData>{xml}</sheetData></worksheet>")


def test_workbooks_of_other_writers_and_problems(spark, tmp_path):
    from rostrum.sources.workbook import cells_to_table, read_workbooks, read_workbooks_checked, workbook_problems
    cell = '<row><c t="inlineStr"><is><t>h</t></is></c><c t="inlineStr"><is><t>g</t></is></c></row><row r="3"><c><v>7</v></c></row>'
    for folder in ("a", "b"):
        (tmp_path / folder).mkdir()
        _raw_book(tmp_path / folder / "x.xlsx", [("S", cell), ("E", ""), ("M", None)],
                  ["/xl/worksheets/sheet1.xml", "worksheets/sheet2.xml", "worksheets/gone.xml"])
    (tmp_path / "a" / "bad.xlsm").write_bytes(b"no zip")
    checked = read_workbooks_checked(spark, str(tmp_path / "*"))
    problems = sorted((r.workbook.rsplit("/", 2)[-2], r.sheet or "", r.problem.split(":")[0]) for r in workbook_problems(checked).collect())
    assert problems == [("a", "", "file not read"), ("a", "E", "sheet has no cells"), ("a", "M", "sheet not read"),
                        ("b", "E", "sheet has no cells"), ("b", "M", "sheet not read")]
    cells = read_workbooks(spark, str(tmp_path / "*"))
    assert cells.select("workbook").distinct().count() == 2
    assert {(r.row_idx, r.col_idx, r.value) for r in cells.collect()} == {(0, 0, "h"), (0, 1, "g"), (2, 0, "7")}
    table = cells_to_table(cells)
    assert table.columns == ["h", "g", "source_workbook", "source_sheet", "source_row"]
    assert sorted((r.source_row, r.h or "") for r in table.collect()) == [(1, ""), (1, ""), (2, "7"), (2, "7")]
