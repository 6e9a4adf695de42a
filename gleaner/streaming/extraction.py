"""Incremental extraction over arriving files.

The streaming plans reuse the batch expressions unchanged: cleaning and
matching look at one document at a time and keep no state.  What goes on from
one micro-batch to the next is a number (of the rows that have ids), a tally
(as small as groups x vocabulary) and, where repeated documents count once,
the ids of a bounded time.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from gleaner.operators.frequencies import tally
from gleaner.operators.rows import PLACE, generated_id, number_placed_rows, number_rows
from gleaner.sources.documents import READ_CSV, null_na_values

# Where a row of a stream stands: (file, start of the split).
SPLIT = "_split_of_files"


def read_document_stream(
    spark: SparkSession,
    path: str,
    schema: str,
    file_format: str = "parquet",
    *,
    max_files: int | None = None,
    places: bool = False,
    **options: str,
) -> DataFrame:
    """Files of a folder (or one file) as a stream, at most ``max_files`` per micro-batch.

    CSV files are read like in a batch: with a header, quoted fields that may
    span lines, and the usual spellings of missing values as nulls.  ``places``
    adds where each row stands, for :func:`write_numbered_stream`.
    """
    if file_format == "csv":
        options = {**READ_CSV, "multiLine": True, **options}
    reader = spark.readStream.format(file_format).schema(schema).options(**options)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    stream = reader.load(path)
    if places:
        file, start = F.col("_metadata.file_path"), F.col("_metadata.file_block_start")
        stream = stream.withColumn(SPLIT, F.struct(file.alias("file"), start.alias("start")))
    return null_na_values(stream) if file_format == "csv" else stream


def write_numbered_stream(
    documents: DataFrame,
    path: str,
    checkpoint: str,
    *,
    prefix: str = "jd",
    order_by: Sequence[str] | None = None,
    plan: Callable[[DataFrame], DataFrame] | None = None,
) -> StreamingQuery:
    """Give the rows of a stream ids that go on from one micro-batch to the next.

    Rows are numbered within a micro-batch by ``order_by``, or by file and
    place in it (a stream read with ``places``).  Each micro-batch adds
    ``row_number`` and a ``job_id`` as wide as the rows so far need, goes
    through ``plan`` (say, an extraction by ``job_id``), which must keep both
    columns, and is written below ``path``; then the total is noted there. The next
    micro-batch goes on from the total of the ones before it, so that one that
    is repeated after a failure gives its rows the same numbers and replaces itself.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        before = _total_before(spark, path, batch_id)
        if order_by:
            numbered = number_rows(batch, "row_number", "_total", order_by=order_by)
        else:
            # A split is read in order by one task, so that these numbers grow within it.
            place = F.struct(f"{SPLIT}.file", f"{SPLIT}.start", F.monotonically_increasing_id().alias("row"))
            numbered = number_placed_rows(
                batch.withColumn(PLACE, place).drop(SPLIT), "row_number", "_total"
            )
        numbered = numbered.withColumn("row_number", F.col("row_number") + before)
        made = generated_id(F.col("row_number"), F.col("_total") + before, prefix)
        numbered = numbered.withColumn("job_id", made).drop("_total")
        rows = f"{path}/rows/batch={batch_id}"
        (plan(numbered) if plan else numbered).write.mode("overwrite").parquet(rows)
        # The plan may drop rows: the total is the last number given.
        total = spark.range(1).select(F.lit(before + batch.count()).cast("long").alias("total"))
        total.write.mode("overwrite").parquet(f"{path}/totals/batch={batch_id}")

    return (
        documents.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def _total_before(spark: SparkSession, path: str, batch_id: int) -> int:
    """How many rows have numbers before this micro-batch."""
    earlier = [folder for number, folder in _complete(spark, f"{path}/totals") if number < batch_id]
    return spark.read.parquet(earlier[-1].toString()).first().total if earlier else 0


def read_numbered_stream(spark: SparkSession, path: str, prefix: str = "jd") -> DataFrame:
    """All complete micro-batches of :func:`write_numbered_stream`, with ids of one width.

    The ids are those that one batch of all rows would have, however many
    micro-batches there were.
    """
    complete = _complete(spark, f"{path}/totals")
    if not complete:
        raise FileNotFoundError(f"no complete micro-batch at {path}")
    number, folder = complete[-1]
    total = spark.read.parquet(folder.toString()).first().total
    rows = spark.read.parquet(f"{path}/rows").filter(F.col("batch") <= number).drop("batch")
    return rows.withColumn("job_id", generated_id(F.col("row_number"), F.lit(total), prefix))


def write_extraction_stream(
    documents: DataFrame,
    extract: Callable[[DataFrame], DataFrame],
    path: str,
    checkpoint: str,
    *,
    per_batch: bool = True,
) -> StreamingQuery:
    """Extract from all files that have arrived and append the result to ``path``.

    ``extract`` is any batch plan with an id column.  It runs on each
    micro-batch, whose own folder makes a repeated batch replace itself: so a
    vocabulary of any size does, also one that is joined, which a plain
    stream refuses in append mode.  Without ``per_batch`` the plan becomes part
    of the stream; then it must keep no state.
    """
    if per_batch:

        def write(batch: DataFrame, batch_id: int) -> None:
            extract(batch).write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

        writer = documents.writeStream.foreachBatch(write)
    else:
        writer = extract(documents).writeStream.format("parquet").option("path", path)
    return writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def once(documents: DataFrame, event_time: str | None = None, delay: str = "1 day") -> DataFrame:
    """Documents of a stream, those with a ``job_id`` seen before left out.

    With an ``event_time`` column the state holds the ids of ``delay`` only: a copy that is later than
    that counts again, and rows older than the latest time less ``delay`` are
    left out.  Without, the state grows with the ids ever seen.
    """
    if event_time is None:
        return documents.dropDuplicates(["job_id"])
    return documents.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(["job_id"])


def running_document_frequency(
    extracted: DataFrame,
    *,
    distinct_ids: bool = False,
    event_time: str | None = None,
    delay: str = "1 day",
) -> DataFrame:
    """Document frequency over everything seen so far.

    The state is one count per term.  ``distinct_ids`` counts repeated
    documents once, as :func:`once` does with ``event_time`` and ``delay``.
    """
    if distinct_ids:
        extracted = once(extracted, event_time, delay)
    terms = extracted.select(F.explode(F.array_distinct("extracted_skills")).alias("skill"))
    return terms.groupBy("skill").agg(F.count("*").alias("count"))


def running_tally(
    extracted: DataFrame,
    role: Column | str | None = None,
    *,
    distinct_ids: bool = False,
    event_time: str | None = None,
    delay: str = "1 day",
) -> DataFrame:
    """The tally over everything seen so far, from which rankings, summaries and rules are made.

    ``write_running_table`` keeps it; ``top_terms(read_running_table(...))``
    ranks what has been seen, with percentages, without the documents.
    """
    return tally(once(extracted, event_time, delay) if distinct_ids else extracted, role)


def write_running_table(table: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Keep the latest state of an aggregated stream below ``path``, for :func:`read_running_table`.

    Each micro-batch writes its own folder, complete once it is marked so.
    The one before stays for readers that have opened it; older ones go.
    """

    def replace(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")
        for number, folder in _complete(batch.sparkSession, path)[:-2]:
            if number < batch_id - 1:
                folder.getFileSystem(_hadoop(batch.sparkSession)).delete(folder, True)

    return (
        table.writeStream.outputMode("complete")
        .foreachBatch(replace)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def read_running_table(spark: SparkSession, path: str) -> DataFrame:
    """The newest complete state that :func:`write_running_table` has written."""
    complete = _complete(spark, path)
    if not complete:
        raise FileNotFoundError(f"no complete table at {path}")
    return spark.read.parquet(complete[-1][1].toString())


def _hadoop(spark: SparkSession):
    return spark.sparkContext._jsc.hadoopConfiguration()


def _complete(spark: SparkSession, path: str) -> list:
    """(number, folder) of the batches that are written completely, in order."""
    marks = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/batch=*/_SUCCESS")
    found = marks.getFileSystem(_hadoop(spark)).globStatus(marks) or []
    folders = [status.getPath().getParent() for status in found]
    return sorted(
        ((int(folder.getName().split("=")[1]), folder) for folder in folders), key=lambda f: f[0]
    )
