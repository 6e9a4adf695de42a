"""Writing results, analytics and rules.

Every writer is one distributed write into a folder.  JSON is written one
object per line, with non-ASCII text kept and null fields left out.
"""

from __future__ import annotations

import logging
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleaner.operators.frequencies import dataset_document, role_documents
from gleaner.operators.rows import format_results

logger = logging.getLogger(__name__)

# The default output columns.
OUTPUT_COLUMNS = ("job_id", "job_title", "extracted_skills", "skill_count")

# Values are written as they are; Spark would trim them.
WRITE_CSV = {
    "header": True,
    "escape": '"',
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
}


def skills_as_text(df: DataFrame, skills_format: str = "comma_separated") -> DataFrame:
    """The term list as ``a, b`` or as a JSON array, for formats without lists."""
    if "extracted_skills" not in df.columns:
        return df
    if skills_format == "comma_separated":
        text = F.array_join("extracted_skills", ", ")
    elif skills_format == "json_array":
        text = F.to_json("extracted_skills")
    else:
        raise ValueError(f"unknown skills format '{skills_format}'")
    return df.withColumn("extracted_skills", text)


def write_csv(
    df: DataFrame,
    path: str,
    columns: Sequence[str] = OUTPUT_COLUMNS,
    *,
    skills_format: str = "comma_separated",
    title_column: str | None = None,
) -> str:
    rows = skills_as_text(format_results(df, columns, title_column), skills_format)
    rows.write.mode("overwrite").csv(path, **WRITE_CSV)
    return path


def write_json(
    df: DataFrame,
    path: str,
    columns: Sequence[str] = OUTPUT_COLUMNS,
    *,
    title_column: str | None = None,
) -> str:
    format_results(df, columns, title_column).write.mode("overwrite").json(path)
    return path


def write_all(
    df: DataFrame,
    folder: str,
    formats: Sequence[str] = ("csv",),
    columns: Sequence[str] = OUTPUT_COLUMNS,
    *,
    skills_format: str = "comma_separated",
    title_column: str | None = None,
) -> dict[str, str]:
    """Write the result in each format; pass a stored table, it is read once per format."""
    written = {}
    for kind in formats:
        path = f"{folder}/{kind}"
        if kind == "csv":
            written[kind] = write_csv(
                df, path, columns, skills_format=skills_format, title_column=title_column
            )
        elif kind == "json":
            written[kind] = write_json(df, path, columns, title_column=title_column)
        else:
            logger.warning("cannot write format %s, left out", kind)
    return written


def write_dataset_analytics(tallied: DataFrame, path: str, top_n: int = 20) -> str:
    dataset_document(tallied, top_n).write.mode("overwrite").json(path)
    return path


def write_role_analytics(tallied: DataFrame, path: str, top_n: int = 20) -> str:
    """One document per role, in one folder per role.

    The folder name is an escaped copy of ``role``, so names cannot collide,
    and the document keeps the role as it is (a folder cannot be named ``""``).
    """
    _write_per_role(role_documents(tallied, top_n), path)
    return path


def write_global_rules(rules: DataFrame, path: str) -> str:
    rules.write.mode("overwrite").json(path)
    return path


def write_role_rules(rules: DataFrame, path: str) -> str:
    """Rules in one folder per role; ``role`` is part of each rule as well."""
    _write_per_role(rules, path)
    return path


def _write_per_role(df: DataFrame, path: str) -> None:
    placed = df.withColumn("for_role", F.col("role")).repartition("for_role")
    placed.write.mode("overwrite").partitionBy("for_role").json(path)

