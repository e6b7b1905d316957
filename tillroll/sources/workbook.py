"""A2: workbooks (.xlsx) as a Spark data source, one partition per sheet.

``spark.read.format("invoice_workbook").load(folder)`` gives the raw invoice lines
of all sheets of all workbooks below a folder. A workbook is a zip of XML files: a
task opens one sheet of one workbook and streams its rows, whatever their number;
what it holds are the workbook's shared strings. Planning lists the folder and reads
each workbook's table of sheets, no rows.

Columns are found by the names in a sheet's first row that is not empty; other
columns are ignored, missing ones are NULL, sheets without any of them hold no
lines. Cells with a date format become the raw text of a date; whole numbers in text
columns lose their ".0". A cell that does not fit its column is NULL, and the line's
cells are kept in ``_corrupt_record``. ``source_file`` names workbook and sheet.
"""

from __future__ import annotations

import datetime as dt
import json
import re
import zipfile
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from xml.etree import ElementTree

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from tillroll.sources.schema import CORRUPT_COLUMN, RAW_COLUMNS

NAME = "invoice_workbook"
SOURCE_COLUMN = "source_file"
BATCH_ROWS = 4096
# Number formats of the file format that show dates or times.
DATE_FORMATS = {*range(14, 23), *range(27, 37), *range(45, 48), *range(50, 59)}
_RELATIONS = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}id"


def _tag(element) -> str:
    return element.tag.rsplit("}", 1)[-1]


def _open(path: str) -> zipfile.ZipFile:
    """The workbook in whatever store its path names."""
    store, inner = pafs.FileSystem.from_uri(path) if "://" in path else (pafs.LocalFileSystem(), path.removeprefix("file:"))
    return zipfile.ZipFile(store.open_input_file(inner))


def list_workbooks(path: str) -> list[str]:
    """Workbooks at or below a path, in order; hidden and lock files are left out."""
    scheme = path.split("://", 1)[0] + "://" if "://" in path else ""
    store, inner = pafs.FileSystem.from_uri(path) if scheme else (pafs.LocalFileSystem(), path.removeprefix("file:"))
    info = store.get_file_info(inner)
    found = [info] if info.is_file else store.get_file_info(pafs.FileSelector(inner, recursive=True))
    host = path[len(scheme):].split("/", 1)[0] if scheme and not path[len(scheme):].startswith("/") else ""
    names = [f.path for f in found if f.is_file and f.extension == "xlsx" and not f.base_name.startswith(("~", ".", "_"))]
    if not scheme:
        return sorted(names)
    return sorted(f"{scheme}{n if n.startswith((host, '/')) else f'{host}/{n}'}" for n in names)


def sheets(book: zipfile.ZipFile) -> list[tuple[str, str]]:
    """(name, member) of every sheet, in the workbook's order."""
    targets = {r.get("Id"): r.get("Target") for r in ElementTree.fromstring(book.read("xl/_rels/workbook.xml.rels"))}
    listed = [e for e in ElementTree.fromstring(book.read("xl/workbook.xml")).iter() if _tag(e) == "sheet"]
    out = []
    for e in listed:
        target = targets[e.get(_RELATIONS)]
        out.append((e.get("name"), target.lstrip("/") if target.startswith("/") else f"xl/{target}"))
    return out


def _stream(book: zipfile.ZipFile, member: str, wanted: str) -> Iterator:
    """Elements of one name, each dropped after its use."""
    with book.open(member) as raw:
        path = []
        for event, element in ElementTree.iterparse(raw, ("start", "end")):
            if event == "start":
                path.append(element)
                continue
            path.pop()
            if _tag(element) == wanted:
                yield element
                if path:
                    path[-1].clear()


def shared_strings(book: zipfile.ZipFile) -> list[str]:
    if "xl/sharedStrings.xml" not in book.namelist():
        return []
    out = []
    for item in _stream(book, "xl/sharedStrings.xml", "si"):
        spoken = {t for e in item.iter() if _tag(e) == "rPh" for t in e}
        out.append("".join(t.text or "" for t in item.iter() if _tag(t) == "t" and t not in spoken))
    return out


def date_styles(book: zipfile.ZipFile) -> set[int]:
    """Cell styles whose number format shows a date or time."""
    if "xl/styles.xml" not in book.namelist():
        return set()
    root = ElementTree.fromstring(book.read("xl/styles.xml"))
    formats = set(DATE_FORMATS)
    for e in root.iter():
        if _tag(e) == "numFmt":
            shown = re.sub(r'"[^"]*"|\\.|\[[^\]]*\]|_.', "", e.get("formatCode", "").split(";")[0])
            if re.search(r"[dmyhs]", shown, re.I):
                formats.add(int(e.get("numFmtId")))
    cells = [x for e in root.iter() if _tag(e) == "cellXfs" for x in e]
    return {i for i, x in enumerate(cells) if int(x.get("numFmtId") or 0) in formats}


def starts_1904(book: zipfile.ZipFile) -> bool:
    flags = [e.get("date1904") for e in ElementTree.fromstring(book.read("xl/workbook.xml")).iter() if _tag(e) == "workbookPr"]
    return bool(flags) and flags[0] in ("1", "true")


def date_text(serial: float, from_1904: bool) -> str:
    """A day number as the raw text of a date (month/day/year hour:minute). Day 60
    of the older calendar is a 29 February 1900 that never was."""
    base = dt.datetime(1904, 1, 1) if from_1904 else dt.datetime(1899, 12, 30 if serial >= 60 else 31)
    at = base + dt.timedelta(minutes=round(serial * 1440))
    return f"{at.month}/{at.day}/{at.year} {at.hour}:{at.minute:02d}"


def _column(reference: str | None, after: int) -> int:
    """Place of a cell from its reference ("AB12"), else the next one."""
    letters = re.match(r"[A-Z]+", reference or "")
    if not letters:
        return after + 1
    place = 0
    for c in letters.group():
        place = place * 26 + ord(c) - 64
    return place - 1


def rows(book: zipfile.ZipFile, member: str) -> Iterator[dict[int, str | float]]:
    """The filled cells of each row by their place: texts, numbers, dates as text."""
    strings, dates, old = shared_strings(book), date_styles(book), starts_1904(book)
    for row in _stream(book, member, "row"):
        cells, at = {}, -1
        for cell in row:
            at = _column(cell.get("r"), at)
            kind = cell.get("t", "n")
            value = "".join(t.text or "" for t in cell.iter() if _tag(t) == ("t" if kind == "inlineStr" else "v"))
            if value == "" or kind == "e":
                continue
            if kind == "s":
                value = strings[int(value)]
            elif kind == "b":
                value = "TRUE" if value == "1" else "FALSE"
            elif kind == "d":  # an ISO date
                moment = dt.datetime.fromisoformat(value)
                value = f"{moment.month}/{moment.day}/{moment.year} {moment.hour}:{moment.minute:02d}"
            elif kind == "n":
                number = float(value)
                value = date_text(number, old) if int(cell.get("s") or 0) in dates else number
            cells[at] = value
        yield cells


def _text(value: str | float) -> str:
    return value if isinstance(value, str) else str(int(value)) if value.is_integer() else repr(value)


def _fitted(name: str, value: str | float | None):
    """A cell's value in its column; raises ValueError where it does not fit."""
    if value is None or (isinstance(value, str) and not value.strip() and name in ("Quantity", "UnitPrice")):
        return None
    if name == "Quantity":
        number = float(value)
        if not number.is_integer() or abs(number) >= 1 << 31:
            raise ValueError(name)
        return int(number)
    return float(value) if name == "UnitPrice" else _text(value)


def lines(book: zipfile.ZipFile, member: str) -> Iterator[tuple]:
    """The raw columns and the corrupt-record text of every line of a sheet."""
    places: dict[str, int] | None = None
    for cells in rows(book, member):
        if not cells:
            continue
        if places is None:
            names = {_text(v).strip(): i for i, v in sorted(cells.items(), reverse=True)}
            places = {c: names[c] for c in RAW_COLUMNS if c in names}
            if not places:
                return
            continue
        out, bad = [], False
        for name in RAW_COLUMNS:
            try:
                out.append(_fitted(name, cells.get(places[name])) if name in places else None)
            except (ValueError, OverflowError):
                out.append(None)
                bad = True
        yield (*out, json.dumps([_text(v) for _, v in sorted(cells.items())], ensure_ascii=False) if bad else None)


class SheetPartition(InputPartition):
    def __init__(self, path: str, sheet: str, member: str):
        super().__init__((path, sheet, member))
        self.path, self.sheet, self.member = path, sheet, member


class WorkbookReader(DataSourceReader):
    def __init__(self, path: str):
        self.path = path

    def partitions(self) -> list[SheetPartition]:
        def of_book(path: str) -> list[SheetPartition]:
            with _open(path) as book:
                return [SheetPartition(path, name, member) for name, member in sheets(book)]

        with ThreadPoolExecutor(16) as pool:
            return [p for found in pool.map(of_book, list_workbooks(self.path)) for p in found]

    def read(self, partition: SheetPartition) -> Iterator[pa.RecordBatch]:
        kinds = [pa.int32() if c == "Quantity" else pa.float64() if c == "UnitPrice" else pa.string() for c in RAW_COLUMNS]
        names, kinds = [*RAW_COLUMNS, CORRUPT_COLUMN, SOURCE_COLUMN], [*kinds, pa.string(), pa.string()]
        origin = f"{partition.path}#{partition.sheet}"

        def batch(held: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(zip(*held), kinds)], names)

        held: list[tuple] = []
        with _open(partition.path) as book:
            for line in lines(book, partition.member):
                held.append((*line, origin))
                if len(held) == BATCH_ROWS:
                    yield batch(held)
                    held = []
        if held:
            yield batch(held)


class WorkbookSource(DataSource):
    """``load(path)``: a workbook or a folder of workbooks."""

    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> str:
        kinds = {"Quantity": "int", "UnitPrice": "double"}
        return ", ".join(f"{c} {kinds.get(c, 'string')}" for c in [*RAW_COLUMNS, CORRUPT_COLUMN, SOURCE_COLUMN])

    def reader(self, schema) -> WorkbookReader:
        return WorkbookReader(self.options["path"])


def register(spark: SparkSession) -> None:
    """Make the source known to a session."""
    spark.dataSource.register(WorkbookSource)
