"""Row ids, row filters and output columns."""

from __future__ import annotations

import logging
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gleaner.functions.characters import NOT_SPACE
from gleaner.functions.cleaning import has_text
from gleaner.session import shared_folder

logger = logging.getLogger(__name__)

# Where a row stands in the files read: (file, start of the split, number that grows within it).
PLACE = "_place_in_files"

# The same where the number within a file does not depend on how it was split: (file, row), rows from 0.
STABLE_PLACE = "_stable_place_in_files"

# Files, splits or partitions whose row counts are broadcast; more of them are joined by a shuffle.
BROADCAST_PARTS = 100_000

_PARTITION_BITS = 33


def validate_columns(
    df: DataFrame,
    text_column: str,
    id_column: str | None = None,
    title_column: str | None = None,
) -> None:
    """Raise ``ValueError`` when a required column is missing."""
    for use, name in (("text", text_column), ("id", id_column)):
        if name and name not in df.columns:
            raise ValueError(f"no {use} column '{name}' among {df.columns}")
    if title_column and title_column not in df.columns:
        logger.warning("no title column '%s' among %s", title_column, df.columns)


def add_row_ids(
    df: DataFrame,
    id_column: str | None = None,
    *,
    prefix: str = "jd",
    order_by: Sequence[str] | None = None,
    file_order: bool = False,
    offset: int = 0,
) -> DataFrame:
    """Add ``job_id``: the id column as text, or ``prefix_001``, ``prefix_002``, ...

    An existing id column needs neither a shuffle nor a job: prefer it on
    large tables.  Generated ids follow the place in the files read
    (``file_order``: parquet without a shuffle; CSV, JSON lines and Excel read with ``places``), or
    ``order_by``, or else the order of the scan.  They are padded to one width for the whole table (3 digits at
    least).
    """
    if id_column and id_column in df.columns:
        return df.withColumn("job_id", F.col(id_column).cast("string"))
    if file_order and STABLE_PLACE in df.columns:
        numbered = number_stable_rows(df, "_number", "_total")
    elif file_order and PLACE in df.columns:
        numbered = number_placed_rows(df, "_number", "_total")
    elif file_order:
        numbered = number_file_rows(df, "_number", "_total")
    else:
        numbered = number_rows(df, "_number", "_total", order_by=order_by)
    made = generated_id(F.col("_number") + offset, F.col("_total") + offset, prefix)
    return numbered.withColumn("job_id", made).drop("_number", "_total")


def generated_id(number: Column, total: Column, prefix: str = "jd") -> Column:
    """``prefix_001`` for 1: as many digits as ``total`` has, 3 at least."""
    width = F.greatest(F.lit(3), F.length(total.cast("string")))
    return F.concat(F.lit(prefix + "_"), F.lpad(number.cast("string"), width, F.lit("0")))


def number_file_rows(df: DataFrame, number: str, total: str) -> DataFrame:
    """Add consecutive numbers from 1 in file order, and the row count, to a parquet scan.

    A row's place in its file is known to the scan.  Only the rows per file
    are counted (from the file footers); files follow each other by name.
    """
    file, place = F.col("_metadata.file_path"), F.col("_metadata.row_index")
    sizes = df.groupBy(file.alias("_file")).agg(F.count("*").alias("_size"))
    return (
        _with_starts(df.withColumns({"_file": file, "_place": place}), sizes, "_file", total)
        .withColumn(number, F.col("_start") + F.col("_place") + 1)
        .drop("_file", "_place", "_start")
    )


def number_stable_rows(df: DataFrame, number: str, total: str) -> DataFrame:
    """Add consecutive numbers from 1 in file order, and the row count, to rows with their ``STABLE_PLACE``.

    Only the rows per file are counted, by a scan of their own; the rows
    themselves are neither moved nor written.
    """
    place = F.col(STABLE_PLACE)
    sizes = df.groupBy(place["file"].alias("_file")).agg(F.count("*").alias("_size"))
    return (
        _with_starts(df.withColumn("_file", place["file"]), sizes, "_file", total)
        .withColumn(number, F.col("_start") + place["row"] + 1)
        .drop("_file", "_start", STABLE_PLACE)
    )


def number_placed_rows(df: DataFrame, number: str, total: str) -> DataFrame:
    """Add consecutive numbers from 1 in file order, and the row count, to rows with their ``PLACE``.

    Files follow each other by name and their splits by place, whatever the
    number of tasks.  The rows are checkpointed, since another scan might be
    split in another way; only the rows per split are moved.
    """
    shared_folder(df.sparkSession)
    place = F.col(PLACE)
    placed = df.checkpoint().withColumns(
        {"_split": F.struct(place["file"].alias("file"), place["start"].alias("start")), "_row": place["row"]}
    )
    sizes = placed.groupBy("_split").agg(F.count("*").alias("_size"), F.min("_row").alias("_first"))
    return (
        _with_starts(placed, sizes, "_split", total)
        .withColumn(number, F.col("_start") + F.col("_row") - F.col("_first") + 1)
        .drop("_split", "_row", "_first", "_start", PLACE)
    )


def number_rows(
    df: DataFrame,
    number: str,
    total: str,
    *,
    order_by: Sequence[str] | None = None,
) -> DataFrame:
    """Add consecutive numbers from 1 and the row count, without one global sort task.

    The rows are range-partitioned and sorted (or left in scan order), then
    checkpointed, so that their places are fixed even if an executor is lost.
    A row's number is its place in its partition plus the rows of all earlier
    partitions; only one row per partition passes through a single task.
    """
    shared_folder(df.sparkSession)
    place = F.monotonically_increasing_id()
    if order_by:
        # Rows with equal keys keep their order, and many of them can be split up.
        order = [*order_by, "_arrival"]
        df = df.withColumn("_arrival", place)
        df = df.repartitionByRange(*order).sortWithinPartitions(*order).drop("_arrival")
    placed = df.checkpoint().withColumns(
        {
            "_part": F.shiftright(place, _PARTITION_BITS),
            "_place": place.bitwiseAND((1 << _PARTITION_BITS) - 1),
        }
    )
    sizes = placed.groupBy("_part").agg(F.count("*").alias("_size"))
    return (
        _with_starts(placed, sizes, "_part", total)
        .withColumn(number, F.col("_start") + F.col("_place") + 1)
        .drop("_part", "_place", "_start")
    )


def _with_starts(df: DataFrame, sizes: DataFrame, key: str, total: str) -> DataFrame:
    """``df`` with the rows before each part (``_start``), the rows of all parts, and what else ``sizes`` has.

    The sizes, one row per part, are counted once; they are broadcast if there
    are not too many.
    """
    shared_folder(df.sparkSession)
    sizes = sizes.checkpoint()
    earlier = Window.orderBy(key).rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(
        *(name for name in sizes.columns if name != "_size"),
        F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_start"),
        F.sum("_size").over(Window.partitionBy()).alias(total),
    )
    return df.join(F.broadcast(starts) if sizes.count() <= BROADCAST_PARTS else starts, key)


def duplicate_ids(df: DataFrame, id_column: str = "job_id") -> DataFrame:
    """One row: how many rows repeat the id of another row."""
    per_id = df.groupBy(id_column).agg(F.count("*").alias("copies"))
    return per_id.agg(F.coalesce(F.sum(F.col("copies") - 1), F.lit(0)).alias("duplicate_count"))


def valid_rows(df: DataFrame, text_column: str) -> DataFrame:
    """Rows whose text is neither null nor blank."""
    text = F.col(text_column)
    return df.filter(text.isNotNull() & text.cast("string").rlike(NOT_SPACE))


def skipped_rows(df: DataFrame, text_column: str) -> DataFrame:
    """Rows left out by :func:`valid_rows`."""
    return df.filter(~has_text(F.col(text_column)))


def skipped_sample(
    df: DataFrame, text_column: str, id_column: str = "job_id", limit: int = 10
) -> DataFrame:
    """Ids of the first skipped rows."""
    return skipped_rows(df, text_column).select(id_column).orderBy(id_column).limit(limit)


def clean_stats(df: DataFrame, text_column: str) -> DataFrame:
    """One row: rows processed, skipped as null and skipped as blank."""
    text = F.col(text_column)
    return df.agg(
        F.count_if(has_text(text)).alias("total_processed"),
        F.count_if(text.isNull()).alias("skipped_null"),
        F.count_if(text.isNotNull() & ~has_text(text)).alias("skipped_empty"),
    )


def format_results(
    df: DataFrame,
    columns: Sequence[str] = ("job_id", "extracted_skills", "skill_count"),
    title_column: str | None = None,
) -> DataFrame:
    """The output columns in order.

    Unknown names are left out; a missing ``job_title`` is filled from
    ``title_column``, or else stays empty.
    """
    chosen = []
    for name in columns:
        if name in df.columns:
            chosen.append(F.col(name))
        elif name == "job_title":
            known = title_column and title_column in df.columns
            chosen.append((F.col(title_column) if known else F.lit("")).alias("job_title"))
    return df.select(*chosen)
