"""Document frequencies, percentages, rankings and summaries.

Everything is derived from one *tally* of the extraction result.  A document
adds one row per distinct term and one marker row (without a term) carrying
its term count; the rows are counted per group.  The documents are therefore
read and shuffled once, partial counts absorb frequent terms and large
groups, and the tally is as small as groups x vocabulary.  The marker rows
keep documents without any term in the denominators.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gleaner.functions.scalars import percentage, round2
from gleaner.session import shared_folder

SINGLE_GROUP = "all"


def tally(df: DataFrame, role: Column | str | None = None, counted: Column | None = None) -> DataFrame:
    """``(role, skill, size, docs)``: documents per term, and per number of terms.

    ``size`` is set on marker rows only, ``skill`` on all others.  Without
    ``role`` there is one group, ``all``.  ``counted`` tells which documents
    get a marker row (all by default).
    """
    if isinstance(role, str):
        role = F.col(role) if role in df.columns else None
    group = F.lit(SINGLE_GROUP) if role is None else role
    marker = F.array(F.lit(None).cast("string"))
    if counted is not None:
        marker = F.when(counted, marker).otherwise(F.array().cast("array<string>"))
    terms = F.array_distinct(F.coalesce("extracted_skills", F.array().cast("array<string>")))
    rows = df.select(
        group.alias("role"), "skill_count", F.explode(F.concat(marker, terms)).alias("skill")
    )
    size = F.when(F.col("skill").isNull(), F.col("skill_count"))
    return rows.groupBy("role", "skill", size.alias("size")).agg(F.count("*").alias("docs"))


def all_groups(tallied: DataFrame) -> DataFrame:
    """The tally of the whole dataset from a tally per role, without the documents."""
    return (
        tallied.groupBy("skill", "size")
        .agg(F.sum("docs").alias("docs"))
        .select(F.lit(SINGLE_GROUP).alias("role"), "skill", "size", "docs")
    )


def _once(tallied: DataFrame) -> DataFrame:
    """The tally, written to the shared folder: rankings use it more than once, and the documents are not to be read again."""
    spark = tallied.sparkSession
    path = f"{shared_folder(spark)}/tally-{uuid.uuid4().hex}"
    tallied.write.parquet(path)
    return spark.read.schema(tallied.schema).parquet(path)


def _totals(tallied: DataFrame) -> DataFrame:
    """``(role, total_jds)``: the documents of each role."""
    return tallied.groupBy("role").agg(_documents().alias("total_jds"))


def _ranks(tallied: DataFrame, top_n: int) -> DataFrame:
    """``(role, skill, docs, place)`` of the first terms of each role; ties rank in term order.

    Each partition of the tally keeps its own first rows only, and these are
    merged: no task sees the whole tally, also when there is one group.
    """
    # Marker rows sort behind all terms.
    is_term = F.col("skill").isNotNull()
    place = F.row_number().over(Window.partitionBy("role").orderBy(is_term.desc(), F.desc("docs"), "skill"))
    ranked = tallied.select("role", "skill", "docs", place.alias("place"))
    return ranked.filter((F.col("place") <= top_n) & F.col("skill").isNotNull())


def _with_totals(rows: DataFrame, tallied: DataFrame) -> DataFrame:
    totals = _totals(tallied).withColumnRenamed("role", "_role")
    return rows.join(totals, F.col("role").eqNullSafe(F.col("_role"))).drop("_role")


def _placed(tallied: DataFrame, top_n: int) -> DataFrame:
    """The tally with the documents of the role (``total_jds``) and the ``place`` of its first terms."""
    tallied = _once(tallied)
    ranks = _ranks(tallied, top_n).select(F.col("role").alias("_role"), F.col("skill").alias("_skill"), "place")
    same = F.col("role").eqNullSafe(F.col("_role")) & (F.col("skill") == F.col("_skill"))
    return _with_totals(tallied, tallied).join(ranks, same, "left").drop("_role", "_skill")


def term_stats(tallied: DataFrame, top_n: int = 20) -> DataFrame:
    """``(role, skill, count, percentage, rank, total_jds)``, one row per role and term.

    ``percentage`` is unrounded.  ``rank`` is null outside the first ``top_n``;
    ties rank in term order.
    """
    return (
        _placed(tallied, top_n)
        .filter("skill is not null")
        .select(
            "role",
            "skill",
            F.col("docs").alias("count"),
            percentage(F.col("docs"), F.col("total_jds")).alias("percentage"),
            F.col("place").alias("rank"),
            "total_jds",
        )
    )


def document_frequency(df: DataFrame) -> DataFrame:
    """``(skill, count)``: the number of documents holding each term."""
    return (
        df.select(F.explode(F.array_distinct("extracted_skills")).alias("skill"))
        .groupBy("skill")
        .agg(F.count("*").alias("count"))
    )


def top_terms(tallied: DataFrame, n: int = 20) -> DataFrame:
    """The first ``n`` terms of each role with count, rounded percentage and rank."""
    share = percentage(F.col("docs"), F.col("total_jds"))
    tallied = _once(tallied)
    return _with_totals(_ranks(tallied, n), tallied).select(
        "role",
        F.col("place").alias("rank"),
        "skill",
        F.col("docs").alias("count"),
        round2(share).alias("percentage"),
    )


def _documents() -> Column:
    return F.coalesce(F.sum(F.when(F.col("skill").isNull(), F.col("docs"))), F.lit(0))


def _mentions() -> Column:
    return F.coalesce(F.sum(F.col("size") * F.col("docs")), F.lit(0))


def _mean_size() -> Column:
    total = F.sum(F.when(F.col("skill").isNull(), F.col("docs")))
    return F.coalesce(round2(F.sum(F.col("size") * F.col("docs")) / total), F.lit(0.0))


def group_summary(tallied: DataFrame) -> DataFrame:
    """``(role, total_jds, unique_skills, avg_skills_per_jd)``, one row per role."""
    return tallied.groupBy("role").agg(
        _documents().alias("total_jds"),
        F.count("skill").alias("unique_skills"),
        _mean_size().alias("avg_skills_per_jd"),
    )


def _summary() -> list[Column]:
    frequency = F.when(F.col("skill").isNull(), F.col("docs")).otherwise(0)
    return [
        _documents().alias("total_jds_processed"),
        F.count("skill").alias("unique_skills_extracted"),
        _mentions().alias("total_skill_extractions"),
        _mean_size().alias("avg_skills_per_jd"),
        F.coalesce(round2(F.percentile("size", F.lit(0.5), frequency)), F.lit(0.0)).alias(
            "median_skills_per_jd"
        ),
        F.coalesce(F.max("size"), F.lit(0)).alias("max_skills_in_single_jd"),
        F.coalesce(F.min("size"), F.lit(0)).alias("min_skills_in_single_jd"),
    ]


def dataset_summary(tallied: DataFrame) -> DataFrame:
    """One row over all documents; zeros for an empty table."""
    return all_groups(tallied).agg(*_summary())


def extraction_stats(df: DataFrame, text_column: str = "processed_text") -> DataFrame:
    """One row: documents with text, terms found, distinct terms and their sorted list."""
    tallied = tally(df, counted=F.coalesce(F.col(text_column) != "", F.lit(False)))
    return tallied.agg(
        _documents().alias("total_extractions"),
        _mentions().alias("total_skills_found"),
        F.count("skill").alias("unique_skills_count"),
        F.array_sort(F.collect_set("skill")).alias("unique_skills"),
    )


def _term_lists() -> list[Column]:
    """All terms in alphabetical order, and the first ones by rank."""
    is_term = F.col("skill").isNotNull()
    count = F.col("docs").alias("count")
    share = percentage(F.col("docs"), F.col("total_jds"))
    term = F.struct("skill", count, share.alias("percentage"))
    ranked = F.struct("place", "skill", count, round2(share).alias("percentage"))
    return [
        F.array_sort(F.collect_list(F.when(is_term, term))).alias("terms"),
        F.array_sort(F.collect_list(F.when(F.col("place").isNotNull(), ranked))).alias("ranked"),
    ]


def _frequency_map() -> Column:
    return F.map_from_entries(F.transform("terms", lambda t: F.struct(t["skill"], t["count"])))


def _percentage_map() -> Column:
    return F.map_from_entries(F.transform("terms", lambda t: F.struct(t["skill"], t["percentage"])))


def _ranking() -> Column:
    return F.transform("ranked", lambda t: F.struct(t["skill"], t["count"], t["percentage"]))


def role_documents(tallied: DataFrame, top_n: int = 20) -> DataFrame:
    """One nested row per role: totals, frequencies, percentages and ranking.

    The maps hold one entry per term of the vocabulary found in the role, so
    their size does not depend on the number of documents.
    """
    totals = [
        _documents().alias("total_jds"),
        F.count("skill").alias("unique_skills"),
        _mean_size().alias("avg_skills_per_jd"),
    ]
    grouped = _placed(tallied, top_n).groupBy("role").agg(*totals, *_term_lists())
    return grouped.select(
        "role",
        "total_jds",
        "unique_skills",
        _frequency_map().alias("skill_frequencies"),
        _percentage_map().alias("skill_percentages"),
        _ranking().alias("top_skills"),
        "avg_skills_per_jd",
    )


def dataset_document(tallied: DataFrame, top_n: int = 20) -> DataFrame:
    """One nested row: summary, ranking, all frequencies and percentages."""
    grouped = _placed(all_groups(tallied), top_n).agg(*_summary(), *_term_lists())
    summary = F.struct(*[name for name in grouped.columns if name not in ("terms", "ranked")])
    return grouped.select(
        summary.alias("summary"),
        _ranking().alias("skill_rankings"),
        _frequency_map().alias("all_skill_frequencies"),
        _percentage_map().alias("all_skill_percentages"),
    )
