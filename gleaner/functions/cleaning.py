"""Text cleaning as plain Spark expressions.

Every step is one projection over the same column.  Catalyst keeps a step
apart from the next one as soon as the column is used more than once, so each
regular expression is evaluated once per row, and all steps still run in one
stage without a shuffle.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleaner.functions.abbreviations import expand_abbreviations
from gleaner.functions.characters import NOT_SPACE, SPACE, SPACE_MEMBERS, WORD_MEMBERS

TAG = r"<[^>]++>"
URL = rf"https?://{NOT_SPACE}++"
# A whole token holding an inner "@".  Anchored at the token start and
# possessive, so that long tokens without "@" stay linear.
EMAIL = rf"(?<!{NOT_SPACE}){NOT_SPACE}[^@{SPACE_MEMBERS}]*+@{NOT_SPACE}++"
# Characters kept besides word characters and white space.
KEPT_SYMBOLS = r"\-.+#"


def has_text(column: Column) -> Column:
    """True for a value that is neither null nor blank (never null itself)."""
    return F.coalesce(column.cast("string").rlike(NOT_SPACE), F.lit(False))


def strip(column: Column) -> Column:
    """Remove white space at both ends; Spark's ``trim`` knows only U+0020."""
    return F.regexp_replace(column, rf"\A{SPACE}++|{SPACE}++\z", "")


def collapse_spaces(column: Column) -> Column:
    return F.trim(F.regexp_replace(column, f"{SPACE}++", " "))


def strip_tags(df: DataFrame, column: str) -> DataFrame:
    """Replace markup tags by a space.

    The text behind the last ``>`` cannot hold a tag and is left out, which
    keeps text with many lone ``<`` linear.
    """
    text = F.col(column)
    tail = F.substring_index(text, ">", -1)
    head = F.left(text, F.length(text) - F.length(tail))
    return _where_found(df, column, "<", F.concat(F.regexp_replace(head, TAG, " "), tail))


def strip_urls(df: DataFrame, column: str) -> DataFrame:
    return _where_found(df, column, "http", F.regexp_replace(column, URL, " "))


def strip_emails(df: DataFrame, column: str) -> DataFrame:
    return _where_found(df, column, "@", F.regexp_replace(column, EMAIL, " "))


def _where_found(df: DataFrame, column: str, needle: str, replaced: Column) -> DataFrame:
    """Run a regular expression only over values that can match at all."""
    text = F.col(column)
    return df.withColumn(column, F.when(F.contains(text, F.lit(needle)), replaced).otherwise(text))


def clean_text(
    df: DataFrame,
    text_column: str,
    output: str = "processed_text",
    *,
    lowercase: bool = True,
    normalize_whitespace: bool = True,
    remove_special_chars: bool = True,
    preserve_hyphens: bool = True,
    abbreviations: Mapping[str, str] | None = None,
) -> DataFrame:
    """Add ``output``: the cleaned text of ``text_column``.

    Tags, links and e-mail addresses go first, then special characters, case
    and white space; abbreviations are expanded last.
    """
    df = df.withColumn(output, F.col(text_column).cast("string"))
    df = strip_emails(strip_urls(strip_tags(df, output), output), output)

    text = F.col(output)
    kept = WORD_MEMBERS + (KEPT_SYMBOLS if preserve_hyphens else "")
    if remove_special_chars and normalize_whitespace:
        # Neither special characters nor white space are kept, and a run of
        # both ends up as one space: one pass does both steps.
        text = F.regexp_replace(text, f"[^{kept}]++", " ")
    elif remove_special_chars:
        text = F.regexp_replace(text, f"[^{kept}{SPACE_MEMBERS}]", " ")
    if lowercase:
        text = F.lower(text)
    if normalize_whitespace:
        text = F.trim(text) if remove_special_chars else collapse_spaces(text)
    df = df.withColumn(output, text)

    if abbreviations:
        df = df.withColumn(
            output,
            expand_abbreviations(
                F.col(output),
                abbreviations,
                lowered=lowercase,
                controls_removed=remove_special_chars,
            ),
        )
    return df
