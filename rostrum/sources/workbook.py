"""Workbook source: ``.xlsx`` files -> long cell table.

Files are read with Spark's ``binaryFile`` source (any Hadoop file system,
one row per file) and parsed inside tasks by ``mapInPandas`` with the
standard library (``zipfile`` + ``xml.etree``): no spreadsheet library is
needed on the executors.  Output schema::

    workbook string, sheet string, sheet_idx int, row_idx int, col_idx int, value string

Empty cells are not emitted.  One workbook is parsed by one task (a workbook
is the unit of work); many workbooks parse in parallel. Sheets and shared
strings are read as streams. Files and sheets that can't be read, and sheets
without cells, are reported (``read_workbooks_checked``), not dropped in silence.
"""
from __future__ import annotations

import datetime as dt
import io
import posixpath
import re
import zipfile
import xml.etree.ElementTree as ET
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

CELL_SCHEMA = "workbook string, sheet string, sheet_idx int, row_idx int, col_idx int, value string"

# Cell texts a spreadsheet reader treats as missing by default
# (the documented default ``na_values`` of pandas' reader, which the reference's
# jobs relied on).  Such text cells are not emitted (= NULL).
DEFAULT_NA_STRINGS = ["", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
                      "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null"]
_NS = {"m": "http://schemas.openxmlformats.org/spreadsheetml/2006/main",
       "r": "http://schemas.openxmlformats.org/officeDocument/2006/relationships",
       "rel": "http://schemas.openxmlformats.org/package/2006/relationships"}
#: The problem of a sheet that was read whole; any other one is damage.
EMPTY = "sheet has no cells"
_REF = re.compile(r"([A-Z]+)(\d+)")


def _col_index(letters: str) -> int:
    n = 0
    for ch in letters:
        n = n * 26 + (ord(ch) - 64)
    return n - 1


def _text(el) -> str:
    return "".join(t.text or "" for t in el.iter(f"{{{_NS['m']}}}t"))


def _number_text(v: str) -> str:
    # integers stored as floats ("12.0") read back as "12", like a spreadsheet reader
    try:
        f = float(v)
    except ValueError:
        return v
    return str(int(f)) if f.is_integer() else repr(f)


# Built-in number formats that display dates / times (ECMA-376 numFmtId).
_DATE_FMT_IDS = set(range(14, 18)) | {22} | set(range(27, 37)) | set(range(50, 59))
_TIME_FMT_IDS = set(range(18, 22)) | {45, 46, 47}


def _is_date_code(code: str) -> bool:
    """Custom format code shows a date/time: d, m, y, h or s outside quoted text,
    escapes and [colour/condition] sections."""
    bare = re.sub(r'"[^"]*"|\\.|\[[^\]]*\]', "", code or "")
    return bool(re.search(r"[dmyhs]", bare, re.I)) and "general" not in bare.lower()


def _date_styles(zf: zipfile.ZipFile, names: set) -> tuple[set, set]:
    """Indices of cell styles (``s`` attribute) that show dates and times."""
    if "xl/styles.xml" not in names:
        return set(), set()
    root = ET.fromstring(zf.read("xl/styles.xml"))
    custom = {int(n.get("numFmtId")): n.get("formatCode", "") for n in root.findall("m:numFmts/m:numFmt", _NS)}
    dates, times = set(), set()
    xfs = root.find("m:cellXfs", _NS)
    for i, xf in enumerate(xfs.findall("m:xf", _NS) if xfs is not None else []):
        fid = int(xf.get("numFmtId", "0"))
        if fid in _TIME_FMT_IDS:
            times.add(i)
        elif fid in _DATE_FMT_IDS or (fid in custom and _is_date_code(custom[fid])):
            dates.add(i)
    return dates, times


def _serial_to_text(v: str, epoch: dt.datetime, time_only: bool) -> str:
    """Spreadsheet serial day number -> the text a datetime/time value prints as."""
    ts = epoch + dt.timedelta(days=float(v))
    ts = ts.replace(microsecond=0) if ts.microsecond < 500 else ts
    return str(ts.time()) if time_only else str(ts)


def _elements(zf: zipfile.ZipFile, part: str, tag: str) -> Iterator:
    """Elements of a part, read as a stream; each is emptied after use."""
    name = f"{{{_NS['m']}}}{tag}"
    with zf.open(part) as stream:
        events = ET.iterparse(stream, events=("start", "end"))
        _, root = next(events)
        depth = 0
        for event, el in events:
            if el.tag != name:
                continue
            depth += 1 if event == "start" else -1
            if event == "end" and depth == 0:
                yield el
                el.clear()
                root.clear()


def _sheet_part(target: str) -> str:
    """Part name of a relationship target: absolute, or relative to the workbook part."""
    return posixpath.normpath(target.lstrip("/") if target.startswith("/") else posixpath.join("xl", target))


def _sheet_cells(zf: zipfile.ZipFile, part: str) -> Iterator[tuple]:
    """(row_idx, col_idx, cell element); cells and rows without a reference follow the one before."""
    row_idx = -1
    for row in _elements(zf, part, "row"):
        number = row.get("r", "")
        row_idx = int(number) - 1 if number.isdigit() else row_idx + 1
        col_idx = -1
        for c in row.iter(f"{{{_NS['m']}}}c"):
            m = _REF.fullmatch(c.get("r", ""))
            col_idx = _col_index(m.group(1)) if m else col_idx + 1
            yield (int(m.group(2)) - 1 if m else row_idx), col_idx, c


def parse_xlsx(content: bytes, workbook: str, na_strings=frozenset(DEFAULT_NA_STRINGS)) -> Iterator[tuple]:
    """Yield (workbook, sheet, sheet_idx, row_idx, col_idx, value, problem) for one file.

    Text cells whose whole text is in ``na_strings`` are missing. A sheet that
    can't be read or has no cells, and a file that can't be read, give one row
    with a ``problem`` and no cell; what was read before stays."""
    try:
        zf = zipfile.ZipFile(io.BytesIO(content))
        names = set(zf.namelist())
        rels = {}
        if "xl/_rels/workbook.xml.rels" in names:
            for rel in ET.fromstring(zf.read("xl/_rels/workbook.xml.rels")).findall("rel:Relationship", _NS):
                rels[rel.get("Id")] = _sheet_part(rel.get("Target"))
        wb = ET.fromstring(zf.read("xl/workbook.xml"))
        pr = wb.find("m:workbookPr", _NS)
        epoch = dt.datetime(1904, 1, 1) if pr is not None and pr.get("date1904") in ("1", "true") \
            else dt.datetime(1899, 12, 30)
        styles = _date_styles(zf, names)
        strings = next((n for n in names if n.lower() == "xl/sharedstrings.xml"), None)
        shared = [_text(si) for si in _elements(zf, strings, "si")] if strings else []
        sheets = wb.findall("m:sheets/m:sheet", _NS)
    except Exception as error:  # any damage of the file: reported, and the other files go on
        yield workbook, None, None, None, None, None, f"file not read: {type(error).__name__}: {error}"
        return
    for sheet_idx, sh in enumerate(sheets):
        sheet = sh.get("name")
        part = rels.get(sh.get(f"{{{_NS['r']}}}id"), f"xl/worksheets/sheet{sheet_idx + 1}.xml")
        empty = True
        try:
            for row_idx, col_idx, c in _sheet_cells(zf, part):
                value = _cell_text(c, shared, styles, epoch, na_strings)
                if value is not None and value != "":
                    empty = False
                    yield workbook, sheet, sheet_idx, row_idx, col_idx, value, None
        except Exception as error:
            yield workbook, sheet, sheet_idx, None, None, None, f"sheet not read: {type(error).__name__}: {error}"
        else:
            if empty:
                yield workbook, sheet, sheet_idx, None, None, None, EMPTY


def _cell_text(c, shared: list, styles: tuple[set, set], epoch: dt.datetime, na_strings) -> str | None:
    """Text of a cell; None where it is missing."""
    kind = c.get("t", "n")
    if kind == "inlineStr":
        inline = c.find("m:is", _NS)
        value = _text(inline) if inline is not None else None
        return None if value in na_strings else value
    v = c.find("m:v", _NS)
    if v is None or v.text is None:
        return None
    if kind in ("s", "str", "e"):
        value = shared[int(v.text)] if kind == "s" else v.text
        return None if value in na_strings else value
    if kind == "b":
        return "True" if v.text == "1" else "False"
    dates, times = styles
    style = int(c.get("s", "-1"))
    if style in dates or style in times:
        return _serial_to_text(v.text, epoch, style in times)
    return _number_text(v.text)


def _batch_parser(na_strings: frozenset):
    cols = ["workbook", "sheet", "sheet_idx", "row_idx", "col_idx", "value", "problem"]

    def frame(rows):
        out = pd.DataFrame(rows, columns=cols)
        return out.astype({c: "Int32" for c in ("sheet_idx", "row_idx", "col_idx")})

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for path, content in zip(pdf["path"], pdf["content"]):
                chunk = []
                # emit in bounded chunks so a large workbook never builds one huge frame
                for row in parse_xlsx(bytes(content), path, na_strings):
                    chunk.append(row)
                    if len(chunk) == 100_000:
                        yield frame(chunk)
                        chunk = []
                if chunk:
                    yield frame(chunk)
    return parse


def read_workbooks_checked(spark: SparkSession, path: str, glob: str = "*.xls[xm]",
                           na_values=DEFAULT_NA_STRINGS) -> DataFrame:
    """Cells of every sheet of every workbook under ``path``, and a row with a
    ``problem`` for each file and sheet that couldn't be read or is empty.
    ``workbook`` is the full path, so equal file names in two folders are two
    workbooks. Write the result (``session.land``) to parse the files once."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(path).select("path", "content")
    return files.mapInPandas(_batch_parser(frozenset(na_values)), CELL_SCHEMA + ", problem string")


def read_workbooks(spark: SparkSession, path: str, glob: str = "*.xls[xm]",
                   na_values=DEFAULT_NA_STRINGS) -> DataFrame:
    """S3: every sheet of every workbook under ``path`` as cells.  ``na_values``:
    cell texts treated as missing (default: the spreadsheet reader defaults;
    pass ``()`` to keep every text). Tells nothing of what couldn't be read;
    ``read_workbooks_checked`` and the jobs do."""
    return read_workbooks_checked(spark, path, glob, na_values).filter(F.col("problem").isNull()).drop("problem")


def workbook_problems(checked: DataFrame) -> DataFrame:
    """(workbook, sheet, sheet_idx, problem) of files and sheets that were skipped."""
    return checked.filter(F.col("problem").isNotNull()).select("workbook", "sheet", "sheet_idx", "problem")


def whole_sheets(checked: DataFrame) -> DataFrame:
    """Cells of the sheets that were read to their end."""
    cells = checked.filter(F.col("problem").isNull()).drop("problem")
    broken = workbook_problems(checked).filter((F.col("problem") != EMPTY) & F.col("sheet_idx").isNotNull())
    keys = ["workbook", "sheet_idx"]
    return cells.join(broken.select(*keys), keys, "left_anti").select(*cells.columns)


def read_sheet(cells: DataFrame, sheet: str | None = None) -> DataFrame:
    """One sheet per workbook, by name or the first (sheet_idx 0)."""
    if sheet is None:
        return cells.filter(F.col("sheet_idx") == 0)
    return cells.filter(F.col("sheet") == sheet)


def check_sheet(cells: DataFrame, sheet: str | None) -> str:
    """S2 checks for one workbook: sheet given and missing -> error; not given
    and several sheets -> error.  Returns the sheet name (small distinct)."""
    sheets = [r["sheet"] for r in cells.select("sheet").distinct().collect()]
    if not sheets:
        raise FileNotFoundError("no cells: missing or empty workbook")
    if sheet is None:
        if len(sheets) != 1:
            raise ValueError(f"Specify sheet_name; found multiple: {sorted(sheets)}")
        return sheets[0]
    if sheet not in sheets:
        raise ValueError(f"Sheet {sheet!r} not found in workbook")
    return sheet


def sheet_check_report(cells: DataFrame, sheet: str | None = None) -> DataFrame:
    """S2 for many workbooks at once: (workbook, problem) rows, no driver collect.
    Problems: the named sheet is missing, or no sheet was named and the workbook
    has several.  An empty result means every workbook passes."""
    per_book = cells.groupBy("workbook").agg(
        F.countDistinct("sheet").alias("n_sheets"),
        F.max(F.when(F.col("sheet") == (sheet if sheet is not None else ""), 1)).alias("has_sheet"))
    if sheet is None:
        problem = F.when(F.col("n_sheets") > 1, F.lit("several sheets; specify the sheet name"))
    else:
        problem = F.when(F.col("has_sheet").isNull(), F.lit(f"sheet {sheet!r} not found"))
    return per_book.select("workbook", problem.alias("problem")).filter(F.col("problem").isNotNull())


SHEET = ["workbook", "sheet", "sheet_idx"]
ORDER_COLUMNS = ["source_workbook", "source_sheet", "source_row"]


def _named_grid(cells: DataFrame, extent: DataFrame, header: DataFrame, taken: Sequence[str] = ()) -> DataFrame:
    """(sheet keys, col_idx, name): every column of every sheet under its header.

    Blank headers are ``Column_<i+1>``, a header that repeats in a sheet gets ``__dup1`` and so on; so does one of ``taken``."""
    grid = extent.select(*SHEET, F.explode(F.sequence(F.lit(0), "width")).alias("col_idx")).join(header, [*SHEET, "col_idx"], "left")
    blank = F.coalesce("text", F.lit("")) == ""
    grid = grid.withColumn("text", F.when(blank, F.concat(F.lit("Column_"), F.col("col_idx") + 1)).otherwise(F.col("text")))
    again = F.row_number().over(Window.partitionBy(*SHEET, "text").orderBy("col_idx")) - 1
    if taken:
        again = again + F.col("text").isin(*taken).cast("int")
    return grid.withColumn("name", F.when(again > 0, F.concat("text", F.lit("__dup"), again)).otherwise(F.col("text")))


def cells_to_records(cells: DataFrame, candidates: Sequence[str], value_name: str = "header_col_value",
                     header_rows: DataFrame | None = None, keep_blank_rows: bool = True) -> DataFrame:
    """Sheets -> one row a data row: ``ORDER_COLUMNS``, ``value_name`` and its header in header_col_name, and ``columns``, a map
    of the row's other cells by header.

    The value's column is found per sheet, in the sheet's own headers: the first of ``candidates`` (in their order, case and
    outer blanks ignored) that the sheet has, else its first column. Headers stay in a table: none reaches the driver and no
    column of the result grows with the workbooks. ``header_rows`` (sheet keys, header_row) names the header row of each sheet,
    row 0 otherwise; a sheet's rows without a value up to its last row are kept unless ``keep_blank_rows`` is off."""
    if header_rows is None:
        header_rows = cells.select(*SHEET).distinct().withColumn("header_row", F.lit(0))
    extent = cells.groupBy(*SHEET).agg(F.max("col_idx").alias("width"), F.max("row_idx").alias("last")).join(header_rows, SHEET)
    header = (cells.join(header_rows, SHEET).filter(F.col("row_idx") == F.col("header_row"))
              .select(*SHEET, "col_idx", F.trim("value").alias("text")))
    grid = _named_grid(cells, extent, header)
    wanted = F.array(*[F.lit(c.strip().lower()) for c in candidates]) if candidates else F.array().cast("array<string>")
    rank = F.array_position(wanted, F.lower(F.trim("name")))
    rank = F.when(rank > 0, rank).otherwise(len(candidates) + 1)
    chosen = grid.groupBy(*SHEET).agg(F.min(F.struct(rank.alias("rank"), F.col("col_idx").alias("value_col"),
                                                     F.col("name").alias("value_header"))).alias("best"))
    grid = grid.join(chosen.select(*SHEET, "best.value_col", "best.value_header"), SHEET)
    mine = F.col("col_idx") == F.col("value_col")
    body = (cells.join(grid.select(*SHEET, "col_idx", "name", "value_col"), [*SHEET, "col_idx"])
            .join(header_rows, SHEET).filter(F.col("row_idx") > F.col("header_row"))
            .groupBy(*SHEET, "row_idx").agg(F.max(F.when(mine, F.col("value"))).alias(value_name), F.map_from_entries(
                F.array_sort(F.collect_list(F.when(~mine & F.col("value").isNotNull(), F.struct("name", "value"))))).alias("columns")))
    if keep_blank_rows:
        rows = extent.filter(F.col("last") > F.col("header_row")).select(
            *SHEET, F.explode(F.sequence(F.col("header_row") + 1, F.col("last"))).alias("row_idx"))
        body = rows.join(body, [*SHEET, "row_idx"], "left")
    body = body.join(chosen.select(*SHEET, "best.value_header"), SHEET)
    return body.select(F.col("workbook").alias("source_workbook"), F.col("sheet").alias("source_sheet"), F.col("row_idx").alias("source_row"),
                       value_name, F.col("value_header").alias("header_col_name"), "columns")


def cells_to_table(cells: DataFrame, header_row: int = 0) -> DataFrame:
    """Sheets with their header in ``header_row`` -> one wide table of all
    workbooks and sheets, united by header name; then the ``ORDER_COLUMNS``.

    Blank headers are ``Column_<i+1>``, a header that repeats in a sheet gets
    ``__dup1`` and so on, rows without a value are kept up to the sheet's last
    row. The distinct header names reach the driver and are columns: for few
    workbooks; ``cells_to_records`` holds for any number."""
    keys = SHEET
    extent = cells.groupBy(*keys).agg(F.max("col_idx").alias("width"), F.max("row_idx").alias("last"))
    header = cells.filter(F.col("row_idx") == header_row).select(*keys, "col_idx", F.trim("value").alias("text"))
    grid = _named_grid(cells, extent, header, ORDER_COLUMNS)
    names = [r["name"] for r in grid.groupBy("name").agg(F.min("col_idx").alias("at")).orderBy("at", "name").collect()]
    body = (cells.filter(F.col("row_idx") > header_row).join(grid.select(*keys, "col_idx", "name"), [*keys, "col_idx"])
            .groupBy(*keys, "row_idx").pivot("name", names).agg(F.first("value")))
    rows = extent.filter(F.col("last") > header_row).select(
        *keys, F.explode(F.sequence(F.lit(header_row + 1), "last")).alias("row_idx"))
    wide = rows.join(body, [*keys, "row_idx"], "left")
    return wide.select(*[F.col(f"`{n}`") for n in names], F.col("workbook").alias("source_workbook"),
                       F.col("sheet").alias("source_sheet"), F.col("row_idx").alias("source_row"))


def write_xlsx(rows_by_sheet: dict[str, list[list]], path: str) -> None:
    """Write a minimal .xlsx (inline strings / numbers) -- for tests and fixtures."""
    def ref(r, c):
        s = ""
        c += 1
        while c:
            c, rem = divmod(c - 1, 26)
            s = chr(65 + rem) + s
        return f"{s}{r + 1}"

    def esc(x):
        return str(x).replace("&", "&amp;").replace("<", "&lt;").replace(">", "&gt;")
    sheets = list(rows_by_sheet.items())
    with zipfile.ZipFile(path, "w") as z:
        z.writestr("[Content_Types].xml",
                   '<?xml version="1.0"?><Types xmlns="http://schemas.openxmlformats.org/package/2006/content-types">'
                   '<Default Extension="xml" ContentType="application/xml"/></Types>')
        z.writestr("xl/styles.xml",
                   f'<styleSheet xmlns="{_NS["m"]}"><cellXfs count="2"><xf numFmtId="0"/><xf numFmtId="14"/>'
                   '</cellXfs></styleSheet>')
        z.writestr("xl/workbook.xml",
                   f'<workbook xmlns="{_NS["m"]}" xmlns:r="{_NS["r"]}"><sheets>'
                   + "".join(f'<sheet name="{esc(n)}" sheetId="{i + 1}" r:id="rId{i + 1}"/>' for i, (n, _) in enumerate(sheets))
                   + "</sheets></workbook>")
        z.writestr("xl/_rels/workbook.xml.rels",
                   f'<Relationships xmlns="{_NS["rel"]}">'
                   + "".join(f'<Relationship Id="rId{i + 1}" Target="worksheets/sheet{i + 1}.xml" Type="ws"/>'
                             for i in range(len(sheets))) + "</Relationships>")
        for i, (_, rows) in enumerate(sheets):
            cells = []
            for r, row in enumerate(rows):
                cells.append(f'<row r="{r + 1}">')
                for c, v in enumerate(row):
                    if v is None:
                        continue
                    if isinstance(v, (dt.date, dt.datetime)):
                        d = v if isinstance(v, dt.datetime) else dt.datetime(v.year, v.month, v.day)
                        serial = (d - dt.datetime(1899, 12, 30)) / dt.timedelta(days=1)
                        cells.append(f'<c r="{ref(r, c)}" s="1"><v>{serial!r}</v></c>')
                    elif isinstance(v, (int, float)) and not isinstance(v, bool):
                        cells.append(f'<c r="{ref(r, c)}"><v>{v}</v></c>')
                    else:
                        cells.append(f'<c r="{ref(r, c)}" t="inlineStr"><is><t>{esc(v)}</t></is></c>')
                cells.append("</row>")
            z.writestr(f"xl/worksheets/sheet{i + 1}.xml",
                       f'<worksheet xmlns="{_NS["m"]}"><sheetData>' + "".join(cells) + "</sheetData></worksheet>")
