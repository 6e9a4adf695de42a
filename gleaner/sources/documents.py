"""Reading document tables."""

from __future__ import annotations

import csv
from collections import Counter
from collections.abc import Sequence
from pathlib import PurePosixPath

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gleaner.operators.rows import BROADCAST_PARTS, PLACE

# The spellings that the usual CSV readers take as missing.
NA_VALUES = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

# Encodings whose line breaks and quotes are single ASCII bytes.
LINE_ENCODINGS = ("UTF-8", "US-ASCII", "ISO-8859-1")

# A doubled quote inside a quoted field is an escaped quote; a header that differs from the
# schema is an error, not a list of other names.
READ_CSV = {"header": True, "escape": '"', "enforceSchema": False}

FORMATS = {
    ".csv": "csv",
    ".xlsx": "xlsx",
    ".json": "json",
    ".jsonl": "json",
    ".parquet": "parquet",
}


def file_format(path: str) -> str:
    """The reader for a path, by its extension."""
    suffix = PurePosixPath(path).suffix.lower()
    if suffix not in FORMATS:
        raise ValueError(f"cannot read '{suffix}' files, only {sorted(FORMATS)}")
    return FORMATS[suffix]


def read_documents(
    spark: SparkSession, path: str, file_type: str = "auto", **options
) -> DataFrame:
    """Read documents from CSV, Excel, JSON or parquet, chosen by extension or ``file_type``."""
    kind = file_format(path) if file_type == "auto" else file_type
    if kind == "csv":
        return read_csv(spark, path, **options)
    if kind in ("xlsx", "excel"):
        from gleaner.sources.workbook import read_excel

        return read_excel(spark, path, **options)
    if kind == "json":
        return read_json(spark, path, **options)
    return spark.read.format(kind).options(**options).load(path)


def read_csv(
    spark: SparkSession,
    paths: str | Sequence[str],
    encoding: str = "auto",
    *,
    multi_line: bool | None = None,
    na_values: Sequence[str] = NA_VALUES,
    places: bool = False,
) -> DataFrame:
    """Read headered CSV files as strings; quoted fields may span lines.

    ``places`` adds where each row stands, for ``add_row_ids`` in file order.

    ``encoding="auto"`` reads files of valid UTF-8 as such and all others as
    ISO-8859-1.  Files with line breaks inside fields are one task each; all
    others are split.  Columns are bound by name.  All of this is found out
    per file and joined to its lines, so that files of any encodings and
    headers are one plan; the driver sees the different headers only.
    With ``encoding`` and ``multi_line`` given, nothing is found out before the
    read; then all files must have one header, or the read fails.
    """
    if encoding != "auto" and (multi_line is not None or encoding.upper() not in LINE_ENCODINGS):
        df = _scan_csv(spark, paths, encoding, multi_line is not False, places)
    else:
        df = _parse_csv(spark, paths, encoding, multi_line, places)
    return null_na_values(df, na_values)


def _parse_csv(
    spark: SparkSession, paths: str | Sequence[str], encoding: str, multi_line: bool | None, places: bool
) -> DataFrame:
    """Lines of all files, decoded and parsed by what :func:`file_traits` knows of their file."""
    traits = file_traits(spark, paths)
    if encoding != "auto":
        latin = encoding.upper() == "ISO-8859-1"
        traits = traits.withColumn("encoding", F.lit("ISO-8859-1" if latin else "UTF-8"))
    if multi_line is not None:
        traits = traits.withColumn("multi_line", F.lit(multi_line))
    first = F.decode(F.col("header").cast("binary"), "ISO-8859-1")
    traits = traits.withColumn("header", F.when(F.col("encoding") == "UTF-8", F.col("header")).otherwise(first))
    kinds = traits.groupBy("header").agg(
        F.min("file").alias("file"), F.count("*").alias("files"), F.bool_or("multi_line").alias("multi_line")
    )
    kinds = kinds.orderBy("file").collect()
    if not kinds:
        return _scan_csv(spark, paths, "UTF-8", True, places)
    few = sum(kind.files for kind in kinds) <= BROADCAST_PARTS
    traits = F.broadcast(traits) if few else traits
    records = _records_of_lines(_lines(spark, paths), traits)
    if any(kind.multi_line for kind in kinds):
        records = records.unionByName(_records_over_lines(_lines(spark, paths, blank=True), traits))
    names = {kind.header: header_names(kind.header) for kind in kinds}
    width = max(map(len, names.values()))
    fields = ", ".join(f"c{i} string" for i in range(width))
    parsed = records.withColumn("_fields", F.from_csv("_record", F.lit(fields), {"escape": '"'}))
    columns = []
    for name in dict.fromkeys(name for listed in names.values() for name in listed):
        value = F.lit(None).cast("string")
        for header, listed in names.items():
            if name in listed:
                here = F.col("_fields")[f"c{listed.index(name)}"]
                value = here if len(names) == 1 else F.when(F.col("_header") == header, here).otherwise(value)
        columns.append(value.alias(name))
    return parsed.select(*columns, *([PLACE] if places else []))


def header_names(header: str) -> list[str]:
    """The names in a header line: those that repeat an earlier or later one and empty ones get their place."""
    names = next(csv.reader([header]), [])
    often = Counter(name.lower() for name in names)
    return [
        f"_c{i}" if not name else f"{name}{i}" if often[name.lower()] > 1 else name for i, name in enumerate(names)
    ]


def _lines(spark: SparkSession, paths: str | Sequence[str], *, blank: bool = False) -> DataFrame:
    """``(_file, _start, _line, _seq)``: lines as they are stored, with the split they are read in.

    A split is read in order by one task, so that ``_seq`` grows within it; it
    is the same in all scans, which cut the files into the same splits.
    """
    lines = spark.read.text(paths).select(
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_start"),
        F.col("value").alias("_line"),
    )
    if not blank:
        lines = lines.filter(F.trim("_line") != "")
    return lines.withColumn("_seq", F.monotonically_increasing_id())


def _decoded() -> Column:
    latin = F.decode(F.col("_line").cast("binary"), "ISO-8859-1")
    return F.when(F.col("encoding") == "UTF-8", F.col("_line")).otherwise(latin)


def _odd_quotes(line: Column) -> Column:
    return (F.octet_length(line) - F.octet_length(F.replace(line, F.lit('"'), F.lit("")))) % 2


def _records_of_lines(lines: DataFrame, traits: DataFrame) -> DataFrame:
    """``(_record, _header, PLACE)`` of the files whose lines are records; the first line of a file is its header."""
    found = lines.join(traits, lines["_file"] == traits["file"]).filter(~F.col("multi_line"))
    body = found.filter((F.col("_start") > 0) | (F.col("_seq") > F.col("first")))
    place = F.struct(F.col("_file").alias("file"), F.col("_start").alias("start"), F.col("_seq").alias("row"))
    return body.select(_decoded().alias("_record"), F.col("header").alias("_header"), place.alias(PLACE))


def _records_over_lines(lines: DataFrame, traits: DataFrame) -> DataFrame:
    """The same for files with line breaks in quoted fields: a record goes on while a quote is open.

    The lines of such a file are put in order by one task.
    """
    found = lines.join(traits, lines["_file"] == traits["file"]).filter("multi_line")
    ordered = Window.partitionBy("_file").orderBy("_start", "_seq")
    before = ordered.rowsBetween(Window.unboundedPreceding, -1)
    closed = F.coalesce(F.sum(_odd_quotes(F.col("_line"))).over(before), F.lit(0)) % 2 == 0
    filled = F.trim("_line") != ""
    cut = found.withColumn("_begins", closed & filled).withColumn("_blank", closed & ~filled).filter(~F.col("_blank"))
    cut = cut.withColumn("_number", F.sum(F.col("_begins").cast("long")).over(ordered))
    listed = F.sort_array(F.collect_list(F.struct("_start", "_seq", _decoded().alias("text"))))
    whole = cut.filter("_number > 1").groupBy("_file", "header", "_number").agg(listed.alias("lines"))
    record = F.array_join(F.transform("lines", lambda line: line["text"]), "\n")
    place = F.struct(F.col("_file").alias("file"), F.lit(0).cast("long").alias("start"), F.col("_number").alias("row"))
    return whole.select(record.alias("_record"), F.col("header").alias("_header"), place.alias(PLACE))


def _scan_csv(spark: SparkSession, paths, encoding: str, multi_line: bool, places: bool) -> DataFrame:
    df = spark.read.csv(paths, **READ_CSV, multiLine=multi_line, encoding=encoding, inferSchema=False)
    return _with_places(df) if places else df


def _with_places(scan: DataFrame) -> DataFrame:
    split = F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start")
    # A split is read in order by one task, so that these numbers grow within it.
    return scan.withColumn(PLACE, F.struct(*split, F.monotonically_increasing_id().alias("row")))


def read_json(
    spark: SparkSession,
    paths: str | Sequence[str],
    *,
    schema: str | None = None,
    places: bool = False,
    **options: str,
) -> DataFrame:
    """Read files of JSON lines, split like any text, or with ``multiLine`` of one JSON value each.

    ``places`` adds where each row stands, for ``add_row_ids`` in file order.
    """
    reader = spark.read.options(**options)
    scan = (reader.schema(schema) if schema else reader).json(paths)
    return _with_places(scan) if places else scan


def file_traits(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """``(file, encoding, multi_line, header, first)`` of text files whose line breaks are ASCII.

    UTF-8 if all lines are valid UTF-8, else ISO-8859-1; ``multi_line`` if some
    line has an odd number of quotes, as the lines have where a quoted field
    goes on; ``header`` is the first line that is not blank, as it is stored,
    and ``first`` its number in the scan.  The lines are checked where they are
    read, in splits of any file size; no line break byte can be part of a longer
    UTF-8 character.
    """
    # The split at the start of a file is read from there, in order.
    first = F.when(F.col("_start") == 0, F.struct(F.col("_seq").alias("seq"), F.col("_line").alias("line")))
    found = _lines(spark, paths).groupBy(F.col("_file").alias("file")).agg(
        F.when(F.bool_and(F.is_valid_utf8("_line")), "UTF-8").otherwise("ISO-8859-1").alias("encoding"),
        F.bool_or(_odd_quotes(F.col("_line")) == 1).alias("multi_line"),
        F.min(first).alias("first"),
    )
    return found.select(
        "file", "encoding", "multi_line", F.rtrim("first.line").alias("header"), F.col("first.seq").alias("first")
    )


def null_na_values(df: DataFrame, na_values: Sequence[str] = NA_VALUES) -> DataFrame:
    """Turn the spellings of a missing value into nulls, in every text column."""
    quoted = {name: F.col("`" + name.replace("`", "``") + "`") for name in df.columns}
    kinds = dict(df.dtypes)
    return df.select(
        *(
            F.when(~text.isin(*na_values), text).alias(name) if kinds[name] == "string" else text
            for name, text in quoted.items()
        )
    )


def row_count_estimate(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """One row: text lines without one header line per file (``rows``)."""
    lines = spark.read.text(paths).groupBy("_metadata.file_path").agg(F.count("*").alias("lines"))
    return lines.agg(F.coalesce(F.sum(F.col("lines") - 1), F.lit(0)).alias("rows"))


def spread(df: DataFrame, tasks: int | None = None) -> DataFrame:
    """Give text work enough tasks when an input has at most half as many splits as there are cores.

    Moving a text costs far less than matching it.  Large inputs have more
    splits than that and pass through untouched.
    """
    tasks = tasks or df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() * 2 > tasks else df.repartition(tasks)
