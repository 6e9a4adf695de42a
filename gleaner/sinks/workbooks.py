"""Tables as Excel workbooks (.xlsx), one for each range of rows."""

from __future__ import annotations

import sys
import zipfile
from collections.abc import Iterator, Sequence
from xml.sax.saxutils import escape

import pyarrow as pa
from pyarrow import fs
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleaner.sources.workbook import LINK, MAIN, PACKAGE, _locate

# The writer reaches the workers by value: they need not be able to import this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# The parts that make a workbook of one sheet.
_HEAD = '<?xml version="1.0" encoding="UTF-8"?>'
_TYPES = "http://schemas.openxmlformats.org/package/2006/content-types"
_PARTS = "application/vnd.openxmlformats-officedocument.spreadsheetml"


def write_workbooks(df: DataFrame, path: str, books: int, order_by: Sequence[str]) -> None:
    """Write ``df`` as ``books`` workbooks below ``path``: ranges of ``order_by``, named in that order.

    Each workbook is written by one task, row by row, and takes its name when
    it is whole; a task that is repeated replaces it.  All values are
    written as text, nulls as empty cells.  A sheet holds at most 1,048,576 rows.
    """
    names = df.columns
    texts = df.select(*(F.col(name).cast("string").alias(name) for name in names), *(F.col(n).alias(f"_{i}") for i, n in enumerate(order_by)))
    order = [f"_{i}" for i in range(len(order_by))]
    ranged = texts.repartitionByRange(books, *order).sortWithinPartitions(*order).drop(*order)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        context = TaskContext.get()
        system, folder = _locate(path)
        system.create_dir(folder, recursive=True)
        file = f"{folder}/book-{context.partitionId():05d}.xlsx"
        part = f"{folder}/_{context.taskAttemptId()}.part"
        rows = _write(system, part, names, batches)
        if rows:
            system.move(part, file)
        else:
            system.delete_file(part)
        yield pa.record_batch([pa.array([rows], pa.int64())], names=["rows"])

    ranged.mapInArrow(write, "rows long").write.format("noop").mode("overwrite").save()


def _write(system: fs.FileSystem, file: str, names: Sequence[str], batches: Iterator[pa.RecordBatch]) -> int:
    rows = 0
    relation = LINK[1:-1]
    with system.open_output_stream(file) as out, zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as book:
        book.writestr(
            "[Content_Types].xml",
            f'{_HEAD}<Types xmlns="{_TYPES}"><Default Extension="rels" '
            'ContentType="application/vnd.openxmlformats-package.relationships+xml"/>'
            f'<Override PartName="/xl/workbook.xml" ContentType="{_PARTS}.sheet.main+xml"/>'
            f'<Override PartName="/xl/worksheets/sheet1.xml" ContentType="{_PARTS}.worksheet+xml"/></Types>',
        )
        target = f'Id="r1" Type="{relation}/officeDocument" Target="xl/workbook.xml"'
        book.writestr("_rels/.rels", f'{_HEAD}<Relationships xmlns="{PACKAGE[1:-1]}"><Relationship {target}/></Relationships>')
        sheet = '<sheets><sheet name="rows" sheetId="1" r:id="r1"/></sheets>'
        book.writestr("xl/workbook.xml", f'{_HEAD}<workbook xmlns="{MAIN[1:-1]}" xmlns:r="{relation}">{sheet}</workbook>')
        target = f'Id="r1" Type="{relation}/worksheet" Target="worksheets/sheet1.xml"'
        book.writestr(
            "xl/_rels/workbook.xml.rels",
            f'{_HEAD}<Relationships xmlns="{PACKAGE[1:-1]}"><Relationship {target}/></Relationships>',
        )
        with book.open("xl/worksheets/sheet1.xml", "w") as xml:
            xml.write(f'{_HEAD}<worksheet xmlns="{MAIN[1:-1]}"><sheetData>{_row(names)}'.encode())
            for batch in batches:
                columns = [column.to_pylist() for column in batch.columns]
                for values in zip(*columns, strict=True):
                    xml.write(_row(values).encode())
                rows += batch.num_rows
            xml.write(b"</sheetData></worksheet>")
    return rows


def _row(values: Sequence[str | None]) -> str:
    cells = (
        "<c/>" if value is None else f'<c t="inlineStr"><is><t xml:space="preserve">{escape(value)}</t></is></c>'
        for value in values
    )
    return f"<row>{''.join(cells)}</row>"
