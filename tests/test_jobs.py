import os
import tempfile

import pytest

from rostrum.jobs import run_age_job, run_name_job, run_roster_job
from rostrum.sources.workbook import write_xlsx


def test_jobs_end_to_end(spark):
    d = tempfile.mkdtemp(prefix="rostrum-jobs-")
    write_xlsx({"Ages": [["Age_Band", "Other"], ["18+", "x"], ["Under 18", "y"], ["6 months", None]]},
               os.path.join(d, "ages.xlsx"))
    out = tempfile.mkdtemp(prefix="rostrum-jobs-out-")
    ages = run_age_job(spark, os.path.join(d, "ages.xlsx"), f"{out}/ages", "label_map")
    got = sorted((r["Age_Band"], r["min_Age"], r["max_Age"]) for r in ages.collect())
    assert got == [("18+", 18.0, 150.0), ("6 months", 0.0, 0.5), ("Under 18", 0.0, 18.0)]
    assert spark.read.option("header", True).csv(f"{out}/ages").count() == 3

    n = tempfile.mkdtemp(prefix="rostrum-jobs-names-")
    write_xlsx({"Names": [["Full Name"], ["Doe, John, MD"], ["St Mary Hospital"]]}, os.path.join(n, "n.xlsx"))
    names = run_name_job(spark, n, f"{out}/names", "degree_dict")
    assert sorted(r["organization"] for r in names.collect()) == ["", "St Mary Hospital"]
    assert spark.read.json(f"{out}/names/jsonl").count() == 2

    r = tempfile.mkdtemp(prefix="rostrum-jobs-roster-")
    write_xlsx({"A": [["Degree", "Specialty"], ["MD", "Cardiology"], ["MD", "Cardiology"]]}, os.path.join(r, "r.xlsx"))
    res = run_roster_job(spark, r, f"{out}/roster", "four_list")
    assert res.combined.count() == 1 and res.audit.count() == 1


def test_jobs_tell_of_damage(spark, tmp_path):
    from tests.test_io import _raw_book
    books, out = tmp_path / "in", str(tmp_path / "out")
    books.mkdir()
    write_xlsx({"A": [["Degree", "Specialty"], ["MD", "Cardiology"]], "E": []}, str(books / "r.xlsx"))
    row = '<row><c t="inlineStr"><is><t>Degree</t></is></c></row><row><c t="inlineStr"><is><t>DO</t></is></c></row>'
    _raw_book(books / "half.xlsx", [("H", row + "<row><c")], ["worksheets/sheet1.xml"])
    (books / "bad.xlsx").write_bytes(b"no zip")

    def problems(path):
        return sorted((r.workbook.rsplit("/", 1)[-1], r.problem.split(":")[0]) for r in spark.read.json(f"{path}_problems").collect())

    want = [("bad.xlsx", "file not read"), ("half.xlsx", "sheet not read"), ("r.xlsx", "sheet has no cells")]
    jobs = {"roster": (run_roster_job, "four_list", {}), "names": (run_name_job, "degree_dict", {"value_col": "Degree"}),
            "ages": (run_age_job, "phrase_hdr", {"value_col": "Degree"})}
    for name, (job, profile, kw) in jobs.items():
        path = f"{out}/{name}"
        with pytest.raises(ValueError, match="not read"):
            job(spark, str(books), path, profile, **kw)
        assert problems(path) == want and not os.path.exists(path)
        res = job(spark, str(books), path, profile, on_damage="leave_out", **kw)
        assert problems(path) == want
        if name == "roster":
            assert [r["Degree 1"] for r in res.combined.collect()] == ["MD"]
        else:
            assert res.count() == 1
