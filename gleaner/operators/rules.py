"""Reusable extraction rules, one per frequent term."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleaner.functions.scalars import round2
from gleaner.operators.frequencies import all_groups, term_stats
from gleaner.operators.vocabulary import with_category, with_variations


def rules(
    tallied: DataFrame,
    dictionary: DataFrame,
    variations: DataFrame | None = None,
    *,
    min_frequency: int = 2,
    core_threshold: float = 0.5,
    top_n: int = 20,
) -> DataFrame:
    """Rules per role of the tally.

    A term needs ``min_frequency`` documents; it is a core term from
    ``core_threshold`` of all documents on.  ``rank`` is null outside the
    first ``top_n``.
    """
    frequent = term_stats(tallied, top_n).filter(F.col("count") >= min_frequency)
    enriched = with_variations(with_category(frequent, "skill", dictionary), "skill", variations)
    return enriched.select(
        "skill",
        F.col("skill").alias("pattern"),
        "variations",
        "category",
        F.lit("dictionary").alias("pattern_type"),
        F.col("count").alias("frequency"),
        round2(F.col("percentage")).alias("percentage"),
        (F.col("percentage") >= core_threshold * 100).alias("is_core_skill"),
        "rank",
        "role",
    )


def global_rules(
    tallied: DataFrame, dictionary: DataFrame, variations: DataFrame | None = None, **options
) -> DataFrame:
    """Rules over the whole dataset, without a role."""
    return rules(all_groups(tallied), dictionary, variations, **options).drop("role")
