"""Shared plumbing: texts through Python in bounded slices, and tables written to the shared folder."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from gleaner.session import shared_folder
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

#: At most so many rows and bytes go to Python at once.
SLICE_ROWS = 256
BATCH_BYTES = 16 << 20


def bounded_batches(spark) -> None:
    """Arrow batches of bounded bytes, for tables with very long texts; a smaller setting stays."""
    for key, most in (
        ("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES),
        ("spark.sql.execution.arrow.maxRecordsPerBatch", 2048),
    ):
        set_to = spark.conf.get(key, None)
        if not (set_to and str(set_to).isdigit() and 0 < int(set_to) <= most):
            spark.conf.set(key, str(most))


def map_rows(
    df: DataFrame,
    keep: list[str],
    read: list[str],
    fields: list[T.StructField],
    make: Callable[[], Callable[..., dict[str, list]]],
) -> DataFrame:
    """The columns ``keep`` and the new ``fields``, one row for each row of ``df``.

    ``make()`` is called once for each task and returns a function from lists
    of the values of ``read`` to the values of the new columns.
    """
    bounded_batches(df.sparkSession)
    given = df.select(*dict.fromkeys([*keep, *read]))
    schema = T.StructType([given.schema[c] for c in keep] + fields)
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        function = make()
        for batch in batches:
            for start in range(0, batch.num_rows, SLICE_ROWS):
                part = batch.slice(start, SLICE_ROWS)
                made = function(*(part.column(c).to_pylist() for c in read))
                columns = [part.column(c).cast(arrow.field(c).type) for c in keep]
                columns += [pa.array(made[f.name], arrow.field(f.name).type) for f in fields]
                yield pa.RecordBatch.from_arrays(columns, schema=arrow)

    return given.mapInArrow(run, schema)


#: Spark's setting by which a query removes its shuffle files when it has ended.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def _tidy(spark) -> Iterator[None]:
    """What is computed meanwhile leaves no shuffle files behind."""
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(SHUFFLE_CLEANUP)
        else:
            spark.conf.set(SHUFFLE_CLEANUP, before)


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read again: computed once, its lineage cut.

    Its shuffle files go when it is written. The files written stay, like
    those of ``checkpoint()``, unless they are given to :func:`discard`.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    with _tidy(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def without_repeats(rows: DataFrame, known: DataFrame, keys: list[str]) -> DataFrame:
    """``rows`` with one row for each of ``keys``; they move for that only if ``known``, their keys, repeat at all."""
    repeated = known.groupBy(*keys).count().filter("count > 1")
    return rows if repeated.isEmpty() else rows.dropDuplicates(keys)


def discard(table: DataFrame) -> None:
    """Remove the files of a stored table that nothing reads any more, neither now nor after the loss of an executor."""
    spark = table.sparkSession
    hadoop = spark.sparkContext._jsc.hadoopConfiguration()
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    for parent in {file.rsplit("/", 1)[0] for file in table.inputFiles()}:
        path = folder(parent)
        path.getFileSystem(hadoop).delete(path, True)
