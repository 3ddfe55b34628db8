"""Response workbooks: a Spark data source for XLSX, and the search for the header row.

`spark.read.format("xlsx")` gives every cell of every sheet as a row (sheet, sheet_ord, row, col, value). A
partition is a sheet. `read_responses` tries the first rows of every sheet as headers, keeps those with a key
column, takes the last, and turns cells into a wide table of texts."""

from __future__ import annotations

import io
import re
import xml.etree.ElementTree as ET
import zipfile
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from ..constants import HEADER_OFFSETS
from ..operators.columns import clean_names, key_column, nulls_normalised, with_key
from ..providers import UnsupportedFileError

_NS = {"m": "http://schemas.openxmlformats.org/spreadsheetml/2006/main", "r": "http://schemas.openxmlformats.org/officeDocument/2006/relationships"}


def _column(ref: str) -> int:
    n = 0
    for c in re.match(r"[A-Z]+", ref).group():
        n = n * 26 + ord(c) - 64
    return n - 1


def _sheets(archive: zipfile.ZipFile) -> list[tuple[str, str]]:
    book = ET.fromstring(archive.read("xl/workbook.xml"))
    rels = ET.fromstring(archive.read("xl/_rels/workbook.xml.rels"))
    target = {r.get("Id"): r.get("Target") for r in rels}
    rid = f"{{{_NS['r']}}}id"
    return [(s.get("name"), "xl/" + target[s.get(rid)].lstrip("/").removeprefix("xl/")) for s in book.iterfind("m:sheets/m:sheet", _NS)]


def cells_of(data: bytes, number: int | None = None):
    """(sheet, sheet_ord, row, col, value) of the non-empty cells."""
    with zipfile.ZipFile(io.BytesIO(data)) as archive:
        shared = []
        if "xl/sharedStrings.xml" in archive.namelist():
            for si in ET.fromstring(archive.read("xl/sharedStrings.xml")).iterfind("m:si", _NS):
                shared.append("".join(t.text or "" for t in si.iter(f"{{{_NS['m']}}}t")))
        for order, (name, path) in enumerate(_sheets(archive)):
            if number is not None and order != number:
                continue
            for cell in ET.fromstring(archive.read(path)).iter(f"{{{_NS['m']}}}c"):
                value = cell.find("m:v", _NS)
                if cell.get("t") == "inlineStr":
                    text = "".join(t.text or "" for t in cell.iter(f"{{{_NS['m']}}}t"))
                elif value is None or value.text is None:
                    continue
                else:
                    text = shared[int(value.text)] if cell.get("t") == "s" else value.text
                ref = cell.get("r")
                yield name, order, int(re.search(r"\d+", ref).group()) - 1, _column(ref), text


class _Sheet(InputPartition):
    def __init__(self, number: int):
        self.number = number


class _XlsxReader(DataSourceReader):
    def __init__(self, path: str):
        self.path = path

    def _data(self) -> bytes:
        with open(self.path.removeprefix("file://"), "rb") as f:
            return f.read()

    def partitions(self):
        with zipfile.ZipFile(io.BytesIO(self._data())) as archive:
            return [_Sheet(i) for i in range(len(_sheets(archive)))]

    def read(self, partition):
        yield from cells_of(self._data(), partition.number)


class XlsxSource(DataSource):
    """format("xlsx"): the cells of a workbook."""

    @classmethod
    def name(cls) -> str:
        return "xlsx"

    def schema(self) -> str:
        return "sheet string, sheet_ord int, row int, col int, value string"

    def reader(self, schema) -> DataSourceReader:
        return _XlsxReader(self.options["path"])


@dataclass
class Responses:
    """A response table and what was found about it."""

    table: DataFrame
    sheet_name: str
    skiprows: int
    index_col: str
    columns: list[str]
    labels: list[tuple[str, str | None]]


def read_responses(spark: SparkSession, path: str) -> Responses:
    """The wide response table of a workbook, a CSV or a parquet file, with its key as respondent_key."""
    kind = path.rsplit(".", 1)[-1].lower()
    if kind in ("csv", "parquet"):
        df = spark.read.csv(path, header=True, multiLine=True) if kind == "csv" else spark.read.parquet(path)
        key = key_column(df.columns)
        if key is None:
            raise ValueError(f"no key column in {path}")
        return Responses(with_key(nulls_normalised(df), key), "", 0, key, [c for c in df.columns if c != key], [(c, None) for c in df.columns if c != key])
    if kind != "xlsx":
        raise UnsupportedFileError(f"no reader for {path}")
    spark.dataSource.register(XlsxSource)
    cells = spark.read.format("xlsx").load(path)
    head = cells.where(F.col("row") <= max(HEADER_OFFSETS)).orderBy("sheet_ord", "row", "col").collect()  # a few rows a sheet
    best = None
    for order in sorted({c.sheet_ord for c in head}):
        for skip in HEADER_OFFSETS:
            row = {c.col: c.value for c in head if c.sheet_ord == order and c.row == skip}
            names = clean_names([row[c] for c in sorted(row)])
            key = key_column(names)
            if key:
                best = (order, skip, dict(zip(sorted(row), names)), key)
    if best is None:
        raise ValueError(f"no sheet of {path} has a key column")
    order, skip, names, key = best
    sheet = next(c.sheet for c in head if c.sheet_ord == order)
    body = cells.where((F.col("sheet_ord") == order) & (F.col("row") > skip))
    wide = body.groupBy("row").agg(*[F.max(F.when(F.col("col") == c, F.col("value"))).alias(n) for c, n in names.items()])
    table = with_key(nulls_normalised(wide), key).withColumnRenamed("row", "ingest_ord")
    above = {c.value: names[c.col] for c in head if c.sheet_ord == order and c.row < skip and c.col in names}
    labels = [(n, next((c.value for c in head if c.sheet_ord == order and c.row < skip and names.get(c.col) == n), above.get(n))) for n in names.values() if n != key]
    return Responses(table, sheet, skip, key, [n for n in names.values() if n != key], labels)
