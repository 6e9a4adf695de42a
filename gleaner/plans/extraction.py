"""The whole way from documents to results, analytics and rules."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleaner.functions.cleaning import clean_text, has_text
from gleaner.functions.scalars import normalize_role, round2
from gleaner.operators.extraction import extract_terms
from gleaner.operators.frequencies import tally
from gleaner.operators.roles import with_role
from gleaner.operators.rows import PLACE, add_row_ids, valid_rows, validate_columns
from gleaner.operators.rules import global_rules, rules
from gleaner.operators.vocabulary import match_vocabulary
from gleaner.session import shared_folder
from gleaner.sinks import writers


def extraction_result(
    df: DataFrame,
    text_column: str,
    dictionary: DataFrame,
    variations: DataFrame | None = None,
    *,
    id_column: str | None = None,
    id_prefix: str = "jd",
    order_by: Sequence[str] | None = None,
    file_order: bool = False,
    title_column: str | None = None,
    keep: Sequence[str] | None = None,
    abbreviations: Mapping[str, str] | None = None,
    lowercase: bool = True,
    normalize_whitespace: bool = True,
    remove_special_chars: bool = True,
    preserve_hyphens: bool = True,
    normalize: bool = True,
    case_sensitive: bool = False,
    remove_duplicates: bool = True,
    matcher: str = "auto",
) -> DataFrame:
    """Add ``job_id``, ``processed_text``, ``extracted_skills`` and ``skill_count``.

    Rows without text are dropped, after ids were given.  With an id column
    this is one projection over the scan, without a shuffle; ids in
    ``file_order`` of parquet files add only a join with the file sizes.
    ``keep`` names the columns to carry on; ids by ``order_by``, scan order or
    the places of CSV rows move the rows, so a narrow ``keep`` saves moving the texts.
    """
    validate_columns(df, text_column, id_column, title_column)
    vocabulary = match_vocabulary(dictionary, variations, normalize=normalize)
    places = [PLACE] if file_order and PLACE in df.columns else []
    early_ids = bool(id_column) or (file_order and not places)
    if early_ids:
        df = add_row_ids(df, id_column, prefix=id_prefix, file_order=file_order)
        df = valid_rows(df, text_column)
    else:
        # Ids count all rows: those without text leave after they were numbered.
        df = df.withColumn("_has_text", has_text(F.col(text_column)))
    df = clean_text(
        df,
        text_column,
        lowercase=lowercase,
        normalize_whitespace=normalize_whitespace,
        remove_special_chars=remove_special_chars,
        preserve_hyphens=preserve_hyphens,
        abbreviations=abbreviations,
    )
    df = extract_terms(
        df,
        vocabulary,
        case_sensitive=case_sensitive,
        remove_duplicates=remove_duplicates,
        lowered=lowercase,
        matcher=matcher,
        made_from=text_column,
    )
    if keep is not None:
        own = ["job_id"] if early_ids else ["_has_text", *places, *(order_by or [])]
        df = df.select(*dict.fromkeys([*own, *keep, "extracted_skills", "skill_count"]))
    if early_ids:
        return df
    if order_by:
        # Range partitioning samples its input first: do not extract twice for that.
        df = stored(df)
    df = add_row_ids(df, prefix=id_prefix, order_by=order_by, file_order=bool(places)).filter("_has_text")
    passing = [name for name in order_by or [] if keep is not None and name not in keep]
    return df.drop("_has_text", *passing)


def extraction_report(
    df: DataFrame,
    text_column: str,
    dictionary: DataFrame,
    variations: DataFrame | None = None,
    *,
    abbreviations: Mapping[str, str] | None = None,
    matcher: str = "auto",
) -> DataFrame:
    """One row: records processed and skipped, terms found, distinct terms, mean per record.

    Skipped rows take part as documents without a term count, so that all
    numbers come from one pass over the texts.
    """
    validate_columns(df, text_column)
    kept = has_text(F.col(text_column)).alias("_has_text")
    rows = clean_text(df.select(text_column, kept), text_column, abbreviations=abbreviations)
    rows = extract_terms(
        rows,
        match_vocabulary(dictionary, variations),
        lowered=True,
        matcher=matcher,
        made_from=text_column,
    ).withColumn("skill_count", F.when(F.col("_has_text"), F.col("skill_count")))
    docs, is_document = F.col("docs"), F.col("skill").isNull()
    processed = F.coalesce(F.sum(F.when(is_document & F.col("size").isNotNull(), docs)), F.lit(0))
    total = F.coalesce(F.sum(F.col("size") * docs), F.lit(0))
    return tally(rows).agg(
        processed.alias("records_processed"),
        F.coalesce(F.sum(F.when(is_document & F.col("size").isNull(), docs)), F.lit(0)).alias(
            "records_skipped"
        ),
        total.alias("total_skills"),
        F.count("skill").alias("unique_skills"),
        round2(F.when(processed > 0, total / processed).otherwise(0.0)).alias("avg_skills_per_jd"),
    )


def role_tally(
    result: DataFrame,
    role_column: str | None = None,
    role_map: Mapping[str, Sequence[str]] | DataFrame | None = None,
) -> DataFrame:
    """The tally per canonical role; one group when there is no role column.

    ``role_map`` is a dict (canonical name -> spellings) or a table ``(canonical, spelling, pos)``.
    """
    if not role_column or role_column not in result.columns:
        return tally(result)
    if isinstance(role_map, DataFrame):
        named = result.select("extracted_skills", "skill_count", F.col(role_column).alias("_raw"))
        return tally(with_role(named, "_raw", role_map), "role")
    return tally(result, normalize_role(F.col(role_column), role_map))


def stored(df: DataFrame) -> DataFrame:
    """Write a table to the shared folder and read it back.

    What follows neither computes it again nor depends on the executors that
    did, and reads only the columns it needs.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.parquet(path)


def run_extraction(
    df: DataFrame,
    text_column: str,
    dictionary: DataFrame,
    variations: DataFrame | None,
    folder: str,
    *,
    formats: Sequence[str] = ("csv", "json"),
    columns: Sequence[str] = writers.OUTPUT_COLUMNS,
    skills_format: str = "comma_separated",
    title_column: str | None = None,
    role_column: str | None = None,
    role_map: Mapping[str, Sequence[str]] | DataFrame | None = None,
    analytics: bool = False,
    make_rules: bool = False,
    top_n: int = 20,
    min_frequency: int = 2,
    core_threshold: float = 0.5,
    **options,
) -> dict[str, str]:
    """Extract and write everything below ``folder``; returns the paths by kind.

    The texts are processed once.  Analytics and rules come from one tally.
    """
    wanted = [*columns, title_column, role_column]
    available = {*df.columns, "processed_text"}
    keep = [name for name in dict.fromkeys(wanted) if name in available]
    result = stored(
        extraction_result(
            df, text_column, dictionary, variations, title_column=title_column, keep=keep, **options
        )
    )
    paths = writers.write_all(
        result, folder, formats, columns, skills_format=skills_format, title_column=title_column
    )
    if not (analytics or make_rules):
        return paths
    counts = stored(role_tally(result, role_column, role_map))
    if analytics:
        paths["dataset_analytics"] = writers.write_dataset_analytics(
            counts, f"{folder}/analytics/dataset", top_n
        )
        paths["role_analytics"] = writers.write_role_analytics(
            counts, f"{folder}/analytics/roles", top_n
        )
    if make_rules:
        limits = {"min_frequency": min_frequency, "core_threshold": core_threshold, "top_n": top_n}
        paths["global_rules"] = writers.write_global_rules(
            global_rules(counts, dictionary, variations, **limits), f"{folder}/rules/global"
        )
        paths["role_rules"] = writers.write_role_rules(
            rules(counts, dictionary, variations, **limits), f"{folder}/rules/roles"
        )
    return paths
