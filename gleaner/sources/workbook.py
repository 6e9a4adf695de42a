"""Excel workbooks (.xlsx) as a Spark data source: one task per workbook.

A sheet holds at most 1,048,576 rows by its file format; more data means more
workbooks, and each is read by its own task, row by row.
"""

from __future__ import annotations

import json
import re
import sys
import zipfile
from collections.abc import Iterator, Sequence
from xml.etree import ElementTree

import pyarrow as pa
from pyarrow import fs
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import LongType, StringType, StructField, StructType

from gleaner.operators.rows import STABLE_PLACE
from gleaner.sources.documents import NA_VALUES, null_na_values

# XML name spaces of the workbook format.
MAIN = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
LINK = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}"
PACKAGE = "{http://schemas.openxmlformats.org/package/2006/relationships}"

# Where a row stands: its workbook, and its number among the rows that are not empty.
FILE, ROW = "_workbook", "_row_of_sheet"


# The source reaches the workers by value: they need not be able to import this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def read_excel(
    spark: SparkSession,
    path: str,
    sheet: str | int = 0,
    *,
    na_values: Sequence[str] = NA_VALUES,
    columns: Sequence[str] | None = None,
    places: bool = False,
) -> DataFrame:
    """Read one sheet (by name or position) of each workbook under ``path``, as strings.

    The columns are those of all workbooks, whose headers are read by a Spark
    job, unless ``columns`` names them; a column that a workbook lacks is
    null there.  Columns of one name in a sheet are told apart by a number
    (``a``, ``a.1``), columns without a name by their place.  ``places`` adds
    where each row stands, for ``add_row_ids`` in file order.
    """
    spark.dataSource.register(WorkbookSource)
    names = list(columns) if columns is not None else all_columns(spark, path, sheet)
    reader = spark.read.format(WorkbookSource.name()).option("sheet", str(sheet))
    df = reader.option("columns", json.dumps(names)).load(path)
    df = null_na_values(df, na_values)
    if places:
        df = df.withColumn(STABLE_PLACE, F.struct(F.col(FILE).alias("file"), F.col(ROW).alias("row")))
    return df.drop(FILE, ROW)


def all_columns(spark: SparkSession, path: str, sheet: str | int = 0) -> list[str]:
    """The names in the headers of all workbooks, in the order of files and columns."""
    sheet = str(sheet)

    def headers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [
                (number, place, name)
                for number, file in zip(*(batch.column(c).to_pylist() for c in ("number", "file")), strict=True)
                for place, name in enumerate(_header(_rows(file, sheet)))
            ]
            numbers, places, names = zip(*found, strict=True) if found else ((), (), ())
            yield pa.record_batch(
                [pa.array(numbers, pa.int64()), pa.array(places, pa.int64()), pa.array(names, pa.string())],
                names=["number", "place", "name"],
            )

    files = spark.createDataFrame(list(enumerate(workbooks(path))), "number long, file string")
    tasks = min(files.count(), spark.sparkContext.defaultParallelism * 4)
    found = files.repartition(tasks, "number").mapInArrow(headers, "number long, place long, name string")
    first = found.groupBy("name").agg(F.min(F.struct("number", "place")).alias("first"))
    return [row.name for row in first.orderBy("first").collect()]


def workbooks(path: str) -> list[str]:
    """The workbook at ``path``, or all in that folder, by name."""
    system, inner = _locate(path)
    info = system.get_file_info(inner)
    if info.type == fs.FileType.File:
        return [path]
    listed = system.get_file_info(fs.FileSelector(inner))
    names = sorted(f.base_name for f in listed if f.base_name.endswith(".xlsx"))
    if not names:
        raise FileNotFoundError(f"no .xlsx workbook at {path}")
    return [f"{path.rstrip('/')}/{name}" for name in names]


class WorkbookSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "gleaner_workbook"

    def _columns(self) -> list[str]:
        return json.loads(self.options["columns"])

    def schema(self) -> StructType:
        texts = [StructField(name, StringType()) for name in self._columns()]
        return StructType([*texts, StructField(FILE, StringType()), StructField(ROW, LongType())])

    def reader(self, schema: StructType) -> DataSourceReader:
        return WorkbookReader(workbooks(self.options["path"]), self.options["sheet"], self._columns())


class WorkbookReader(DataSourceReader):
    def __init__(self, files: list[str], sheet: str, columns: list[str]):
        self.files, self.sheet, self.columns = files, sheet, columns

    def partitions(self) -> list[InputPartition]:
        return [InputPartition(file) for file in self.files]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        rows = _rows(partition.value, self.sheet)
        header = _header(rows)
        places = [header.index(name) if name in header else None for name in self.columns]
        filled = (row for row in rows if any(cell is not None for cell in row))
        for number, row in enumerate(filled):
            cells = (row[place] if place is not None and place < len(row) else None for place in places)
            yield (*cells, partition.value, number)


def _header(rows: Iterator[list[str | None]]) -> list[str]:
    """The names in the first row, each one once."""
    names: list[str] = []
    for place, name in enumerate(next(rows, [])):
        unique = base = f"Unnamed: {place}" if name is None else name
        again = 0
        while unique in names:
            again += 1
            unique = f"{base}.{again}"
        names.append(unique)
    return names


def _locate(path: str) -> tuple[fs.FileSystem, str]:
    if "://" in path:
        return fs.FileSystem.from_uri(path)
    return fs.LocalFileSystem(), path.removeprefix("file:")


def _rows(path: str, sheet: str) -> Iterator[list[str | None]]:
    """The rows of a sheet as lists of cell texts; empty cells are None."""
    system, inner = _locate(path)
    with system.open_input_file(inner) as file, zipfile.ZipFile(file) as book:
        shared = _shared_strings(book)
        with book.open(_sheet_part(book, sheet)) as xml:
            for _, element in ElementTree.iterparse(xml):
                if element.tag == MAIN + "row":
                    yield _cells(element, shared)
                    element.clear()


def _shared_strings(book: zipfile.ZipFile) -> list[str]:
    if "xl/sharedStrings.xml" not in book.namelist():
        return []
    root = ElementTree.fromstring(book.read("xl/sharedStrings.xml"))
    return [_rich_text(item) for item in root.iter(MAIN + "si")]


def _rich_text(item: ElementTree.Element) -> str:
    """The text of a string and its formatted parts, without phonetic readings."""
    parts = [*item.findall(MAIN + "t"), *item.findall(f"{MAIN}r/{MAIN}t")]
    return "".join(part.text or "" for part in parts)


def _sheet_part(book: zipfile.ZipFile, sheet: str) -> str:
    sheets = list(ElementTree.fromstring(book.read("xl/workbook.xml")).iter(MAIN + "sheet"))
    by_name = {s.get("name"): s for s in sheets}
    if sheet in by_name:
        chosen = by_name[sheet]
    elif sheet.isdigit() and int(sheet) < len(sheets):
        chosen = sheets[int(sheet)]
    else:
        raise ValueError(f"no sheet '{sheet}', the workbook has {list(by_name)}")
    links = ElementTree.fromstring(book.read("xl/_rels/workbook.xml.rels"))
    targets = {link.get("Id"): link.get("Target") for link in links.iter(PACKAGE + "Relationship")}
    target = targets[chosen.get(LINK + "id")]
    return target.lstrip("/") if target.startswith("/") else "xl/" + target


def _cells(row: ElementTree.Element, shared: list[str]) -> list[str | None]:
    cells: list[str | None] = []
    for cell in row.iter(MAIN + "c"):
        letters = re.match("[A-Z]+", cell.get("r") or "")
        place = _column_number(letters.group()) if letters else len(cells)
        cells.extend([None] * (place + 1 - len(cells)))
        cells[place] = _cell_text(cell, shared)
    return cells


def _column_number(letters: str) -> int:
    number = 0
    for letter in letters:
        number = number * 26 + ord(letter) - ord("A") + 1
    return number - 1


def _cell_text(cell: ElementTree.Element, shared: list[str]) -> str | None:
    kind = cell.get("t")
    if kind == "inlineStr":
        inline = cell.find(MAIN + "is")
        return "" if inline is None else _rich_text(inline)
    value = cell.find(MAIN + "v")
    if value is None or value.text is None:
        return None
    if kind == "s":
        return shared[int(value.text)]
    if kind == "b":
        return "True" if value.text == "1" else "False"
    return value.text
