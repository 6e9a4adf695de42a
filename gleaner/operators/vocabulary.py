"""Term dictionaries and variation maps as tables.

A dictionary is ``(term, category)``; a variation map is ``(canonical,
variation, pos)`` with ``pos`` the place in the map; a vocabulary is
``(pattern, canonical)``: what to look for and what to report.
"""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# A term listed in several categories belongs to the first one.
CATEGORIES = ("technical", "soft", "custom")


def normalized_terms(dictionary: DataFrame) -> DataFrame:
    """Lower-cased distinct ``(term, category)`` rows."""
    return dictionary.select(F.lower("term").alias("term"), "category").distinct()


def dictionary_union(dictionary: DataFrame) -> DataFrame:
    """The distinct terms of all categories."""
    return dictionary.select(F.lower("term").alias("term")).distinct()


def terms_of_category(dictionary: DataFrame, category: str) -> DataFrame:
    return dictionary_union(dictionary.filter(F.col("category") == category))


def add_terms(dictionary: DataFrame, terms: Sequence[str], category: str = "custom") -> DataFrame:
    """The dictionary with further terms."""
    if category not in CATEGORIES:
        raise ValueError(f"unknown category '{category}', expected one of {CATEGORIES}")
    rows = [(term.lower(), category) for term in terms]
    extra = _small_table(dictionary.sparkSession, rows, ("term", "category"))
    return dictionary.select("term", "category").unionByName(extra)


def dictionary_stats(dictionary: DataFrame) -> DataFrame:
    """Distinct terms, repeated entries and lists loaded, per category and for ``all``.

    Entries repeated inside a category count as duplicates; the row ``all``
    adds them up, while its term count is over the union.
    """
    entries = dictionary.groupBy(F.lower("term").alias("term"), "category").agg(
        F.count("*").alias("copies")
    )
    own = F.col("category").alias("own")
    levels = F.array(
        F.struct(own, F.col("category").alias("level")), F.struct(own, F.lit("all").alias("level"))
    )
    return (
        entries.withColumn("at", F.explode(levels))
        .groupBy(F.col("at.level").alias("category"))
        .agg(
            F.countDistinct("term").alias("terms"),
            F.sum(F.col("copies") - 1).alias("duplicates_removed"),
            F.countDistinct("at.own").alias("lists_loaded"),
        )
    )


def members(df: DataFrame, column: str, dictionary: DataFrame, *, inside: bool = True) -> DataFrame:
    """Rows whose value is (or is not) a dictionary term, ignoring case."""
    terms = dictionary_union(dictionary)
    how = "left_semi" if inside else "left_anti"
    return df.join(terms, F.lower(df[column]) == terms["term"], how)


def term_categories(dictionary: DataFrame) -> DataFrame:
    """``(term, category)`` with the first category in the fixed order."""
    return normalized_terms(dictionary).groupBy("term").agg(
        F.min_by("category", _category_rank(F.col("category"))).alias("category")
    )


def _category_rank(category: Column) -> Column:
    known = F.array_position(F.array(*map(F.lit, CATEGORIES)), category)
    return F.when(known > 0, known).otherwise(F.lit(len(CATEGORIES) + 1))


def with_category(df: DataFrame, column: str, dictionary: DataFrame) -> DataFrame:
    """Add ``category``; terms of no dictionary are ``unknown``."""
    categories = term_categories(dictionary).withColumnRenamed("term", "_term")
    return (
        df.join(categories, F.lower(df[column]) == F.col("_term"), "left")
        .drop("_term")
        .withColumn("category", F.coalesce("category", F.lit("unknown")))
    )


def canonical_variations(variations: DataFrame) -> DataFrame:
    """``(term, variations)``: the spellings belonging to a canonical or to one of its variations.

    A canonical lists its variations; a variation lists its canonical in front
    of them.  A term found under several canonicals takes the first one.
    """
    entries = variations.groupBy("canonical").agg(
        F.min("pos").alias("pos"),
        F.transform(
            F.array_sort(F.collect_list(F.struct("pos", "variation"))), lambda v: v["variation"]
        ).alias("spellings"),
    )
    spelled = F.filter("spellings", lambda v: v.isNotNull())
    own = F.struct(F.lower("canonical").alias("term"), F.lit(0).alias("kind"), spelled.alias("variations"))
    listed = F.transform(
        spelled,
        lambda v: F.struct(
            F.lower(v).alias("term"),
            F.lit(1).alias("kind"),
            F.concat(F.array("canonical"), spelled).alias("variations"),
        ),
    )
    keyed = entries.select("pos", F.explode(F.concat(F.array(own), listed)).alias("key"))
    return keyed.groupBy("key.term").agg(
        F.min_by("key.variations", F.struct("pos", "key.kind")).alias("variations")
    )


def with_variations(df: DataFrame, column: str, variations: DataFrame | None) -> DataFrame:
    """Add ``variations``; a term of no variation map lists itself."""
    alone = F.array(F.col(column))
    if variations is None:
        return df.withColumn("variations", alone)
    keyed = canonical_variations(variations).withColumnRenamed("term", "_term")
    return (
        df.join(keyed, F.lower(df[column]) == F.col("_term"), "left")
        .drop("_term")
        .withColumn("variations", F.coalesce("variations", alone))
    )


def match_vocabulary(
    dictionary: DataFrame, variations: DataFrame | None = None, *, normalize: bool = True
) -> DataFrame:
    """``(pattern, canonical)``: dictionary terms and variations, lower-cased.

    A variation reports its canonical (the last one, if listed twice), every
    other term itself.  Canonicals are not patterns unless the dictionary
    holds them.  Without ``normalize`` the variation map is not used at all.
    """
    entries = dictionary.select(
        F.lower("term").alias("pattern"), F.lit(None).cast("string").alias("canonical"), F.lit(-1).alias("pos")
    )
    if variations is not None and normalize:
        entries = entries.unionByName(
            variations.filter(F.col("variation").isNotNull()).select(
                F.lower("variation").alias("pattern"), F.lower("canonical").alias("canonical"), "pos"
            )
        )
    return (
        entries.filter(F.col("pattern") != "")
        .groupBy("pattern")
        .agg(F.max_by("canonical", "pos").alias("canonical"))
        .withColumn("canonical", F.coalesce("canonical", "pattern"))
    )


def longest_first(vocabulary: DataFrame) -> DataFrame:
    """Patterns in matching preference: longest first, then alphabetical."""
    return vocabulary.orderBy(F.length("pattern").desc(), "pattern")


def dictionary_from_lists(spark: SparkSession, terms: dict[str, Sequence[str]]) -> DataFrame:
    """A dictionary table from ``category -> terms``."""
    rows = [(term, category) for category, listed in terms.items() for term in listed]
    return _small_table(spark, rows, ("term", "category"))


def variations_from_map(spark: SparkSession, mapping: dict[str, Sequence[str]]) -> DataFrame:
    """A variation table from ``canonical -> variations``, in the order of the map."""
    rows = []
    for canonical, listed in mapping.items():
        for variation in listed or [None]:
            rows.append((str(canonical), variation, len(rows)))
    return _small_table(spark, rows, ("canonical", "variation", "pos"))


def _small_table(spark: SparkSession, rows: Sequence[tuple], names: Sequence[str]) -> DataFrame:
    """A table whose size Spark knows: it plans joins with it as broadcasts by itself."""
    schema = pa.schema([(name, pa.int32() if name == "pos" else pa.string()) for name in names])
    columns = [[row[i] for row in rows] for i in range(len(names))]
    return spark.createDataFrame(pa.table(columns, schema=schema))
