"""Plan-level checks over every registered query (no execution)."""
import re

import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(E.queries()))
def test_no_python_evaluation(spark, name):
    plan = _plan(E.queries()[name](spark, SF))
    for node in ("BatchEvalPython", "ArrowEvalPython", "PythonUDF", "MapInPandas", "FlatMapGroupsInPandas"):
        assert node not in plan, (name, node)


@pytest.mark.parametrize("name,table,cols", [
    ("age_a3_phrase_hdr", "part", {"p_partkey", "p_size"}),
    ("age_a5_two_col", "part", {"p_partkey", "p_size"}),
    ("name_n5_credential_clean", "part", {"p_partkey", "p_name"}),
    ("path_prefix", "pages", {"page_id", "url"}),
])
def test_scan_reads_only_needed_columns(spark, name, table, cols):
    df = E.queries()[name](spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    scans = re.findall(r"FileScan parquet \[([^\]]*)\][^\n]*" + table + r"\.parquet", plan)
    assert scans, plan[:500]
    for s in scans:
        read = {re.sub(r"#\d+L?$", "", c.strip()) for c in s.split(",")}
        assert read <= cols, (name, read)


def test_audit_numbers_rows_by_key_and_block(spark):
    """A third of the rows in one group: no join or window of all rows by the group key alone."""
    import re

    from rostrum.operators.roster import audit
    rows = [("A" if k % 3 == 0 else f"B{k % 500}", "s", 1, "w", 0, k) for k in range(3000)]
    wide = spark.createDataFrame(rows, "`Degree 1` string, source_sheet string, header_row_number int, workbook string, sheet_idx int, row_idx long")
    out = audit(wide, ["Degree 1"], block_rows=100)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "LeftSemi" not in plan and "__blk" in re.search(r"row_number\(\) windowspecdefinition\(([^)]*)", plan)[1]
    seen = [(r["group_key"], r["occurrence_index"]) for r in out.collect()]
    assert sum(k == "A" for k, _ in seen) == 999 and max(i for k, i in seen if k == "A") == 1000
