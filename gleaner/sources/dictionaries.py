"""Reading term lists and variation, abbreviation and role maps."""

from __future__ import annotations

import json
import logging
from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleaner.functions.cleaning import strip
from gleaner.operators.vocabulary import variations_from_map

logger = logging.getLogger(__name__)


def read_terms(spark: SparkSession, path: str, category: str = "custom") -> DataFrame:
    """``(term, category)`` from a text file: one term per line, ``#`` starts a comment line.

    Repeated entries are kept, so that they can be counted; a missing file
    gives no terms.
    """
    try:
        lines = spark.read.text(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        logger.error("no term list at %s", path)
        return spark.createDataFrame([], "term string, category string")
    return (
        lines.select(F.lower(strip(F.col("value"))).alias("term"))
        .filter((F.col("term") != "") & ~F.startswith("term", F.lit("#")))
        .withColumn("category", F.lit(category))
    )


def read_dictionary(spark: SparkSession, files: Mapping[str, str | None]) -> DataFrame:
    """One dictionary from a file per category; a category without a file is skipped."""
    dictionary = spark.createDataFrame([], "term string, category string")
    for category, path in files.items():
        if path:
            dictionary = dictionary.unionByName(read_terms(spark, path, category))
    return dictionary


def read_map(spark: SparkSession, path: str | None) -> dict:
    """A small YAML or JSON mapping, in file order; a missing file is an empty map.

    Such files hold what a person typed in (variations, abbreviations, roles).
    """
    if not path:
        return {}
    try:
        content = spark.read.text(path, wholetext=True).first()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        logger.warning("no map file at %s", path)
        return {}
    if content is None:
        return {}
    if path.endswith(".json"):
        return json.loads(content.value)
    try:
        import yaml
    except ImportError as error:
        raise RuntimeError("reading YAML needs the yaml module; use JSON instead") from error
    return yaml.safe_load(content.value) or {}


def read_variations(spark: SparkSession, path: str | None) -> DataFrame:
    """The variation table of a map file ``canonical -> variations``."""
    mapping: dict[str, Sequence[str]] = read_map(spark, path)
    return variations_from_map(spark, mapping)
