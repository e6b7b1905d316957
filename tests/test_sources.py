"""Workbooks as a source, and tables that are replaced at once."""

from __future__ import annotations

import datetime as dt
import os
import zipfile
from xml.sax.saxutils import escape

import pytest
from pyspark.sql import functions as F

from tillroll.operators import bronze as B
from tillroll.operators import silver as S
from tillroll.sources import io, versions
from tillroll.sources.schema import RAW_COLUMNS

MAIN = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
REL = 'xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"'
SERIAL = (dt.datetime(2010, 12, 1, 8, 26) - dt.datetime(1899, 12, 30)) / dt.timedelta(days=1)


def cell(at, row, value, strings):
    ref = f'r="{chr(65 + at)}{row}"'
    if value is None:
        return ""
    if isinstance(value, dt.datetime):
        serial = (value - dt.datetime(1899, 12, 30)) / dt.timedelta(days=1)
        return f'<c {ref} s="1"><v>{serial!r}</v></c>'
    if isinstance(value, (int, float)):
        return f"<c {ref}><v>{value!r}</v></c>"
    if value.startswith("inline:"):
        return f'<c {ref} t="inlineStr"><is><t>{escape(value[7:])}</t></is></c>'
    strings.append(value)
    return f'<c {ref} t="s"><v>{len(strings) - 1}</v></c>'


def write_workbook(path, sheets, custom_format="m/d/yyyy h:mm"):
    strings = []
    body = {name: "".join(f'<row r="{i + 1}">' + "".join(cell(j, i + 1, v, strings) for j, v in enumerate(row)) + "</row>"
                          for i, row in enumerate(rows)) for name, rows in sheets.items()}
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("xl/workbook.xml", f"<workbook {MAIN} {REL}><workbookPr/><sheets>" + "".join(
            f'<sheet name="{n}" sheetId="{i}" r:id="rId{i}"/>' for i, n in enumerate(sheets)) + "</sheets></workbook>")
        z.writestr("xl/_rels/workbook.xml.rels", "<Relationships>" + "".join(
            f'<Relationship Id="rId{i}" Target="worksheets/sheet{i}.xml"/>' for i in range(len(sheets))) + "</Relationships>")
        z.writestr("xl/styles.xml", f'<styleSheet {MAIN}><numFmts><numFmt numFmtId="164" formatCode="{custom_format}"/></numFmts>'
                                    '<cellXfs><xf numFmtId="0"/><xf numFmtId="164"/></cellXfs></styleSheet>')
        z.writestr("xl/sharedStrings.xml", f"<sst {MAIN}>" + "".join(f"<si><t>{escape(s)}</t></si>" for s in strings) + "</sst>")
        for i, rows in enumerate(body.values()):
            z.writestr(f"xl/worksheets/sheet{i}.xml", f"<worksheet {MAIN}><sheetData>{rows}</sheetData></worksheet>")


@pytest.fixture()
def workbooks(tmp_path):
    at = dt.datetime(2010, 12, 1, 8, 26)
    first = [RAW_COLUMNS, [536365, "85123A", "inline:A <B> & C", 6, at, 2.55, 17850, "UK"],
             [536366.0, 71053, None, -1, "12/1/2010 8:28", 3, None, "UK"], [],
             ["C536367", "x", "bad count", "six", at, 2.5, 17850.0, "EIRE"], ["536368", "y", "z", 2.5, at, "2.5", "17851", None]]
    turned = [["Country", "other", "InvoiceNo", "Quantity"], ["France", "?", "7", 3]]
    os.makedirs(tmp_path / "books" / "deep")
    write_workbook(tmp_path / "books" / "a.xlsx", {"Year 1": first, "empty": [], "notes": [["just"], ["text"]]})
    write_workbook(tmp_path / "books" / "deep" / "b.xlsx", {"S": turned, "only names": [RAW_COLUMNS]})
    (tmp_path / "books" / "~lock.xlsx").write_text("no workbook")
    return str(tmp_path / "books")


def test_workbooks(spark, workbooks):
    raw = io.read_raw(spark, workbooks, fmt="xlsx")
    got = {r.InvoiceNo: tuple(r) for r in raw.collect()}
    origin = f"{workbooks}/a.xlsx#Year 1"
    assert got == {
        "536365": ("536365", "85123A", "A <B> & C", 6, "12/1/2010 8:26", 2.55, "17850", "UK", None, origin),
        "536366": ("536366", "71053", None, -1, "12/1/2010 8:28", 3.0, None, "UK", None, origin),
        "C536367": ("C536367", "x", "bad count", None, "12/1/2010 8:26", 2.5, "17850", "EIRE",
                    '["C536367", "x", "bad count", "six", "12/1/2010 8:26", "2.5", "17850", "EIRE"]', origin),
        "536368": ("536368", "y", "z", None, "12/1/2010 8:26", 2.5, "17851", None,
                   '["536368", "y", "z", "2.5", "12/1/2010 8:26", "2.5", "17851"]', origin),
        "7": ("7", None, None, 3, None, None, None, "France", None, f"{workbooks}/deep/b.xlsx#S"),
    }
    assert raw.rdd.getNumPartitions() == 5  # a partition per sheet
    bronze = B.add_lineage(raw, ingested_at="2011-01-01 00:00:00")
    assert B.bronze_quality(bronze).first().corrupt_rows == 2
    assert {r.source_file for r in bronze.collect()} == {origin, f"{workbooks}/deep/b.xlsx#S"}
    assert S.clean_transactions(bronze).count() == 2


def test_one_workbook_and_many_rows(spark, tmp_path):
    rows = [RAW_COLUMNS] + [[i, f"S{i % 7}", f"text {i % 50}", i, dt.datetime(2011, 1, 1 + i % 28), 1.5, i % 100, "UK"] for i in range(9000)]
    write_workbook(tmp_path / "one.xlsx", {"S": rows}, "yyyy\\-mm\\-dd")
    path = str(tmp_path / "one.xlsx")
    got = io.read_raw(spark, path, fmt="xlsx")
    assert got.agg(F.sum("Quantity"), F.count_distinct("InvoiceDate"), F.count("_corrupt_record")).first()[:] == (9000 * 8999 // 2, 28, 0)
    stored, quality = B.ingest_transactions(spark, path, str(tmp_path / "lake"), fmt="xlsx")
    assert quality.first().total_rows == 9000


def test_early_dates():
    from tillroll.sources.workbook import date_text

    assert date_text(SERIAL, False) == "12/1/2010 8:26"
    assert date_text(1, False) == "1/1/1900 0:00" and date_text(61, False) == "3/1/1900 0:00"
    assert date_text(0.5, True) == "1/1/1904 12:00"


def failing(spark, n):
    boom = F.when(F.col("id") == n - 1, F.raise_error(F.lit("half-way"))).otherwise(F.col("id"))
    return spark.range(0, n, 1, 4).select(boom.cast("long").alias("id"))


def test_replace_is_all_or_nothing(spark, tmp_path):
    base = str(tmp_path)
    io.write_table(spark.range(10), base, "gold", "t")
    with pytest.raises(Exception):
        io.write_table(failing(spark, 1000), base, "gold", "t")
    assert io.read_table(spark, base, "gold", "t").count() == 10
    # a job that reads the table it replaces, with another schema
    io.write_table(io.read_table(spark, base, "gold", "t").select((F.col("id") * 2).alias("twice")), base, "gold", "t")
    got = io.read_table(spark, base, "gold", "t")
    assert got.columns == ["twice"] and got.agg(F.sum("twice")).first()[0] == 90


def test_a_reader_keeps_its_version(spark, tmp_path):
    path = str(tmp_path / "t")
    versions.replace_table(spark.range(5), path)
    held = versions.read_current(spark, path)
    versions.replace_table(spark.range(50), path)
    assert held.count() == 5 and versions.read_current(spark, path).count() == 50
    versions.replace_table(spark.range(7), path)
    assert len(versions.prune(spark, path, keep=1, spare_hours=0)) == 2
    assert versions.read_current(spark, path).count() == 7
    assert versions.current(spark, str(tmp_path / "none")) is None


def test_touched_partitions_only(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.range(40).selectExpr("id", "CAST(id % 4 AS INT) AS month")
    versions.replace_partitions(df, path, ["month"], [(0,), (1,), (2,), (3,)])
    before = versions.current(spark, path)
    new = versions.read_current(spark, path, partitions=["month=1"]).selectExpr("id + 100 AS id", "month")
    versions.replace_partitions(new, path, ["month"], [(1,), (3,)])  # 3 loses its rows
    after = versions.current(spark, path)
    assert {m for m in before if after.get(m) == before[m]} == {"month=0", "month=2"} and "month=3" not in after
    rows = {(r.id, r.month) for r in versions.read_current(spark, path).collect()}
    assert rows == {(i + 100 * (i % 4 == 1), i % 4) for i in range(40) if i % 4 != 3}
