"""The registered queries: name -> (session, table folder) -> DataFrame."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gleaner.functions import cleaning
from gleaner.functions.abbreviations import expand_abbreviations
from gleaner.functions.characters import NOT_WORD, WORD
from gleaner.functions.scalars import normalize_role, round2, safe_name
from gleaner.operators import frequencies, rows, rules, vocabulary
from gleaner.operators.extraction import extract_terms
from gleaner.plans import extraction
from gleaner.plans.sample_terms import (
    ABBREVIATIONS,
    DOCUMENT_TERMS,
    DOCUMENT_VARIATIONS,
    LANGUAGE_ROLES,
    PART_TERMS,
    PART_VARIATIONS,
)
from gleaner.session import shared_folder
from gleaner.sinks import writers
from gleaner.sinks.workbooks import write_workbooks
from gleaner.sources import dictionaries
from gleaner.sources import documents as sources
from gleaner.streaming import extraction as streaming

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


# Inputs ---------------------------------------------------------------------


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return sources.spread(table(spark, folder, "documents"))


def gappy_documents(spark: SparkSession, folder: str) -> DataFrame:
    """All documents, and rows without text: the labels, whose text is null or blank."""
    label = table(spark, folder, "labels")
    without_text = label.select(
        (-1 - F.col("doc_id")).alias("doc_id"),
        F.when(F.col("quality") == 1, F.lit("  \t")).alias("text"),
        F.lit("").alias("lang"),
        F.lit("label").alias("source"),
        F.lit(0).cast("bigint").alias("n_chars"),
    )
    return documents(spark, folder).unionByName(without_text)


def document_dictionary(spark: SparkSession) -> DataFrame:
    return vocabulary.dictionary_from_lists(spark, DOCUMENT_TERMS)


def document_variations(spark: SparkSession) -> DataFrame:
    return vocabulary.variations_from_map(spark, DOCUMENT_VARIATIONS)


def part_dictionary(spark: SparkSession, folder: str) -> DataFrame:
    """A dictionary read off the part table: nouns, adjectives, and both with types."""
    part = table(spark, folder, "part")
    noun, adjective = F.substring_index("p_name", " ", -1), F.substring_index("p_name", " ", 1)
    entries = F.array(
        F.struct(noun.alias("term"), F.lit("technical").alias("category")),
        F.struct(adjective.alias("term"), F.lit("soft").alias("category")),
        F.struct(F.col("p_name").alias("term"), F.lit("custom").alias("category")),
        F.struct(F.col("p_type").alias("term"), F.lit("custom").alias("category")),
    )
    return part.select(F.inline(entries))


def place_variations(spark: SparkSession, folder: str) -> DataFrame:
    """A variation map read off the tables: region -> its nations."""
    nation, region = table(spark, folder, "nation"), table(spark, folder, "region")
    return nation.join(region, nation.n_regionkey == region.r_regionkey).select(
        F.col("r_name").alias("canonical"),
        F.col("n_name").alias("variation"),
        F.col("n_nationkey").alias("pos"),
    )


def words(df: DataFrame, column: str = "text") -> DataFrame:
    found = F.explode(F.split(F.lower(column), f"{NOT_WORD}+"))
    return df.select(found.alias("word")).filter("word != ''").distinct()


def benchmark_dictionary(spark: SparkSession, folder: str) -> DataFrame:
    """Every word of the benchmark items: a vocabulary that grows with its table."""
    found = words(table(spark, folder, "benchmark"))
    return found.select(F.col("word").alias("term"), F.lit("custom").alias("category"))


def extracted(spark: SparkSession, folder: str, **options) -> DataFrame:
    return extraction.extraction_result(
        documents(spark, folder),
        "text",
        document_dictionary(spark),
        document_variations(spark),
        id_column="doc_id",
        **options,
    )


def extracted_parts(spark: SparkSession, folder: str) -> DataFrame:
    return extraction.extraction_result(
        table(spark, folder, "part"),
        "p_name",
        vocabulary.dictionary_from_lists(spark, PART_TERMS),
        vocabulary.variations_from_map(spark, PART_VARIATIONS),
        id_column="p_partkey",
        title_column="p_brand",
    )


def shown(df: DataFrame, *keys: str) -> DataFrame:
    """Keys, terms as text, and their number."""
    return df.select(*keys, F.array_join("extracted_skills", "|").alias("skills"), "skill_count")


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


# Cleaning -------------------------------------------------------------------


@query
def clean_text(spark, folder):
    return cleaning.clean_text(documents(spark, folder), "text").select("doc_id", "processed_text")


@query
def clean_html(spark, folder):
    pages = sources.spread(table(spark, folder, "pages"))
    return cleaning.clean_text(pages, "html").select("page_id", "processed_text")


@query
def clean_keep_case(spark, folder):
    cleaned = cleaning.clean_text(documents(spark, folder), "text", lowercase=False)
    return cleaned.select("doc_id", "processed_text")


@query
def clean_keep_spaces(spark, folder):
    cleaned = cleaning.clean_text(documents(spark, folder), "text", normalize_whitespace=False)
    return cleaned.select("doc_id", "processed_text")


@query
def clean_keep_special(spark, folder):
    cleaned = cleaning.clean_text(documents(spark, folder), "text", remove_special_chars=False)
    return cleaned.select("doc_id", "processed_text")


@query
def strip_special_all(spark, folder):
    cleaned = cleaning.clean_text(documents(spark, folder), "text", preserve_hyphens=False)
    return cleaned.select("doc_id", "processed_text")


@query
def strip_tags(spark, folder):
    pages = sources.spread(table(spark, folder, "pages"))
    return cleaning.strip_tags(pages, "html").select("page_id", "html")


@query
def strip_urls(spark, folder):
    pages = sources.spread(table(spark, folder, "pages"))
    return cleaning.strip_urls(cleaning.strip_urls(pages, "html"), "url").select(
        "page_id", "url", "html"
    )


@query
def strip_emails(spark, folder):
    return cleaning.strip_emails(documents(spark, folder), "text").select("doc_id", "text")


@query
def expand_abbreviations_words(spark, folder):
    cleaned = cleaning.clean_text(documents(spark, folder), "text", abbreviations=ABBREVIATIONS)
    return cleaned.select("doc_id", "processed_text")


@query
def expand_abbreviations_raw(spark, folder):
    """On raw text: mixed case and any control characters."""
    expanded = expand_abbreviations(
        F.col("text"), ABBREVIATIONS, lowered=False, controls_removed=False
    )
    return documents(spark, folder).select("doc_id", expanded.alias("expanded"))


@query
def valid_filter(spark, folder):
    return rows.valid_rows(gappy_documents(spark, folder), "text").select("doc_id", "n_chars")


@query
def clean_stats(spark, folder):
    return rows.clean_stats(gappy_documents(spark, folder), "text")


@query
def skipped_sample(spark, folder):
    with_ids = rows.add_row_ids(gappy_documents(spark, folder), "doc_id")
    return rows.skipped_sample(with_ids, "text")


# Ids and output columns -----------------------------------------------------


@query
def row_ids_generated(spark, folder):
    keys = table(spark, folder, "documents").select("doc_id", "lang", "n_chars")
    return rows.add_row_ids(keys, order_by=["doc_id"]).select("doc_id", "job_id")


@query
def row_ids_file_order(spark, folder):
    numbered = rows.add_row_ids(table(spark, folder, "documents"), file_order=True)
    return numbered.select("doc_id", "job_id")


@query
def row_ids_csv_files(spark, folder):
    """Ids in the order of CSV files and of the rows in them."""
    path = fresh_path(spark, "csv")
    keys = table(spark, folder, "documents").select("doc_id", "lang", "n_chars")
    keys.repartitionByRange(5, "doc_id").sortWithinPartitions("doc_id").write.csv(path, header=True)
    back = sources.read_csv(spark, path, encoding="UTF-8", multi_line=False, places=True)
    numbered = rows.add_row_ids(back, file_order=True)
    return numbered.select(F.col("doc_id").cast("bigint"), "job_id")


@query
def row_ids_existing(spark, folder):
    return rows.add_row_ids(table(spark, folder, "conversations"), "conv_id").select(
        "job_id", "turn", "role"
    )


@query
def duplicate_ids(spark, folder):
    return rows.duplicate_ids(rows.add_row_ids(table(spark, folder, "conversations"), "conv_id"))


@query
def format_results(spark, folder):
    parts = extracted_parts(spark, folder)
    columns = ["skill_count", "job_id", "no_such_column", "job_title", "p_type"]
    return rows.format_results(parts, columns, title_column="p_brand")


# Dictionaries ---------------------------------------------------------------


@query
def dictionary_union(spark, folder):
    return vocabulary.dictionary_union(part_dictionary(spark, folder))


@query
def dictionary_stats(spark, folder):
    return vocabulary.dictionary_stats(part_dictionary(spark, folder))


@query
def dictionary_category_filter(spark, folder):
    return vocabulary.terms_of_category(part_dictionary(spark, folder), "custom")


@query
def dictionary_add_terms(spark, folder):
    grown = vocabulary.add_terms(part_dictionary(spark, folder), ["Left Handed Bolt", "bolt"], "soft")
    return vocabulary.normalized_terms(grown)


@query
def dictionary_members(spark, folder):
    dictionary = benchmark_dictionary(spark, folder)
    return vocabulary.members(words(documents(spark, folder)), "word", dictionary)


@query
def dictionary_strangers(spark, folder):
    dictionary = benchmark_dictionary(spark, folder)
    spoken = words(table(spark, folder, "conversations"))
    return vocabulary.members(spoken, "word", dictionary, inside=False)


@query
def match_vocabulary(spark, folder):
    return vocabulary.match_vocabulary(
        part_dictionary(spark, folder), place_variations(spark, folder)
    )


@query
def longest_first_vocabulary(spark, folder):
    patterns = vocabulary.match_vocabulary(part_dictionary(spark, folder))
    return vocabulary.longest_first(patterns).select("pattern", F.length("pattern").alias("length"))


@query
def term_list_scan(spark, folder):
    """Part names as a term list with comments, blanks and mixed case, read back."""
    path = fresh_path(spark, "terms")
    lines = F.array(
        F.concat(F.lit("# "), F.col("p_type")), F.concat(F.lit("  "), F.initcap("p_name")), F.lit(" ")
    )
    table(spark, folder, "part").select(F.explode(lines)).write.text(path)
    read = dictionaries.read_dictionary(spark, {"custom": path, "soft": f"{path}/missing"})
    return vocabulary.dictionary_stats(read)


# Extraction -----------------------------------------------------------------


@query
def extract_terms_pattern(spark, folder):
    return shown(extracted(spark, folder, matcher="pattern"), "job_id")


@query
def extract_terms_join(spark, folder):
    return shown(extracted(spark, folder, matcher="join"), "job_id")


@query
def extract_large_vocabulary(spark, folder):
    """Every word of the benchmark items is a term."""
    patterns = vocabulary.match_vocabulary(benchmark_dictionary(spark, folder))
    found = extract_terms(documents(spark, folder), patterns, "text", matcher="join")
    return shown(found, "doc_id")


@query
def extract_terms_lookup(spark, folder):
    return shown(extracted(spark, folder, matcher="lookup"), "job_id")


def passage_patterns(spark: SparkSession, folder: str) -> DataFrame:
    """Single words, and whole passages: the benchmark items without symbols at their ends."""
    passage = F.regexp_replace("text", rf"\A{NOT_WORD}+|{NOT_WORD}+\z", "").alias("term")
    items = table(spark, folder, "benchmark").select(passage, F.lit("custom").alias("category"))
    return vocabulary.match_vocabulary(document_dictionary(spark).unionByName(items))


@query
def extract_passages(spark, folder):
    """Passages of hundreds of characters are terms like any others, in one plan."""
    patterns = passage_patterns(spark, folder)
    return shown(extract_terms(documents(spark, folder), patterns, "text", matcher="lookup"), "doc_id")


@query
def extract_passages_join(spark, folder):
    patterns = passage_patterns(spark, folder)
    return shown(extract_terms(documents(spark, folder), patterns, "text", matcher="join"), "doc_id")


@query
def extract_longest_first(spark, folder):
    return shown(extracted_parts(spark, folder), "job_id", "p_name")


@query
def extract_case_sensitive(spark, folder):
    patterns = vocabulary.match_vocabulary(document_dictionary(spark), document_variations(spark))
    return shown(
        extract_terms(documents(spark, folder), patterns, "text", case_sensitive=True), "doc_id"
    )


@query
def extract_no_dedup(spark, folder):
    return shown(extracted(spark, folder, remove_duplicates=False), "job_id")


@query
def extract_no_normalize(spark, folder):
    return shown(extracted(spark, folder, normalize=False), "job_id")


@query
def extract_with_abbreviations(spark, folder):
    return shown(extracted(spark, folder, abbreviations=ABBREVIATIONS), "job_id")


@query
def extract_html(spark, folder):
    result = extraction.extraction_result(
        sources.spread(table(spark, folder, "pages")),
        "html",
        document_dictionary(spark),
        document_variations(spark),
        id_column="page_id",
    )
    return shown(result, "job_id")


# Frequencies ----------------------------------------------------------------


@query
def document_frequency(spark, folder):
    return frequencies.document_frequency(extracted(spark, folder))


@query
def document_frequency_no_dedup(spark, folder):
    return frequencies.document_frequency(extracted(spark, folder, remove_duplicates=False))


@query
def term_percentages(spark, folder):
    stats = frequencies.term_stats(frequencies.tally(extracted(spark, folder)))
    return stats.select("skill", "count", "total_jds", round2(F.col("percentage")).alias("percentage"))


@query
def min_frequency(spark, folder):
    counts = frequencies.document_frequency(extracted(spark, folder))
    return counts.filter(F.col("count") >= 100)


@query
def top_terms(spark, folder):
    ranked = frequencies.top_terms(frequencies.tally(extracted(spark, folder)), 20)
    return ranked.select("rank", "skill", "count", "percentage")


@query
def dataset_summary(spark, folder):
    return frequencies.dataset_summary(frequencies.tally(extracted(spark, folder)))


@query
def group_summary(spark, folder):
    return frequencies.group_summary(frequencies.tally(extracted(spark, folder)))


@query
def extraction_stats(spark, folder):
    stats = frequencies.extraction_stats(extracted(spark, folder))
    return stats.withColumn("unique_skills", F.array_join("unique_skills", "|"))


# Roles ----------------------------------------------------------------------


def uneven_role() -> Column:
    """Languages with spellings, gaps and blanks, as a role column has them."""
    source = F.col("source")
    return (
        F.when(source == "src3", F.lit(None))
        .when(source == "src5", F.lit(""))
        .when(source == "src7", F.lit("  "))
        .when(source.isin("src11", "src13"), F.concat(F.lit(" "), F.upper("lang"), F.lit("\t")))
        .otherwise(F.col("lang"))
    )


@query
def normalize_roles(spark, folder):
    role = uneven_role()
    canonical = normalize_role(role, LANGUAGE_ROLES)
    return table(spark, folder, "documents").select(
        "doc_id", canonical.alias("role"), safe_name(canonical).alias("file_name")
    )


def roles_tallied(spark: SparkSession, folder: str) -> DataFrame:
    result = extracted(spark, folder).withColumn("role", uneven_role())
    return extraction.role_tally(result, "role", LANGUAGE_ROLES)


@query
def role_term_stats(spark, folder):
    return frequencies.term_stats(roles_tallied(spark, folder)).select(
        "role", "skill", "count", round2(F.col("percentage")).alias("percentage"), "rank", "total_jds"
    )


@query
def role_summary(spark, folder):
    return frequencies.group_summary(roles_tallied(spark, folder))


@query
def role_top_terms(spark, folder):
    tallied = extraction.role_tally(extracted(spark, folder), "source")
    return frequencies.top_terms(tallied, 5)


@query
def part_role_top_terms(spark, folder):
    tallied = extraction.role_tally(extracted_parts(spark, folder), "p_type")
    return frequencies.top_terms(tallied, 3)


@query
def roles_by_table(spark, folder):
    """Roles by a map that is read off a table: brands are spelled in any case, their first part names the type."""
    part = table(spark, folder, "part")
    spelling = F.when(F.col("p_partkey") % 2 == 0, F.upper("p_brand")).otherwise(F.col("p_brand"))
    role_map = part.filter("p_brand != 'Brand#7'").select(
        F.col("p_type").alias("canonical"), spelling.alias("spelling"), F.col("p_partkey").alias("pos")
    )
    tallied = extraction.role_tally(extracted_parts(spark, folder), "p_brand", role_map)
    return frequencies.top_terms(tallied, 4)


@query
def maps_from_files(spark, folder):
    """Extraction with a variation map and abbreviations that Spark has written as JSON files and read back."""
    path = fresh_path(spark, "maps")
    word = F.lower(F.regexp_extract("text", rf"({WORD}+){NOT_WORD}+({WORD}+)", 2))
    first = table(spark, folder, "benchmark").select("item_id", word.alias("variation")).filter("length(variation) > 1")
    owner = first.groupBy("variation").agg(F.concat(F.lit("item "), F.min("item_id")).alias("canonical"))
    entry = F.struct("canonical", "variations")
    listed = owner.groupBy("canonical").agg(F.sort_array(F.collect_list("variation")).alias("variations"))
    one = listed.agg(F.to_json(F.map_from_entries(F.sort_array(F.collect_list(entry)))).alias("value"))
    one.coalesce(1).write.text(f"{path}/variations.json")
    short = spark.createDataFrame([(json.dumps(ABBREVIATIONS),)], "value string")
    short.coalesce(1).write.text(f"{path}/abbreviations.json")
    result = extraction.extraction_result(
        documents(spark, folder),
        "text",
        document_dictionary(spark),
        dictionaries.read_variations(spark, f"{path}/variations.json"),
        id_column="doc_id",
        abbreviations=dictionaries.read_map(spark, f"{path}/abbreviations.json"),
    )
    return shown(result, "job_id")


@query
def row_ids_json_files(spark, folder):
    """Ids in the order of JSON files and of the lines in them."""
    path = fresh_path(spark, "json")
    keys = table(spark, folder, "documents").select("doc_id", "lang", "n_chars")
    keys.repartitionByRange(5, "doc_id").sortWithinPartitions("doc_id").write.json(path)
    back = sources.read_json(spark, path, schema="doc_id bigint, lang string", places=True)
    return rows.add_row_ids(back, file_order=True).select("doc_id", "job_id")


@query
def row_ids_workbooks(spark, folder):
    """Ids in the order of Excel workbooks and of the rows in them, whose texts are extracted from."""
    path = fresh_path(spark, "books")
    parts = table(spark, folder, "part").select("p_partkey", "p_name", F.nullif("p_type", F.lit("PROMO")).alias("p_type"))
    write_workbooks(parts, path, 4, ["p_partkey"])
    back = sources.read_documents(spark, path, "excel", places=True)
    result = extraction.extraction_result(
        back,
        "p_name",
        vocabulary.dictionary_from_lists(spark, PART_TERMS),
        vocabulary.variations_from_map(spark, PART_VARIATIONS),
        file_order=True,
    )
    return shown(result, "job_id", "p_partkey", "p_type")


@query
def single_group_fallback(spark, folder):
    tallied = extraction.role_tally(extracted(spark, folder), "no_such_column")
    return frequencies.top_terms(tallied, 10)


# Rules ----------------------------------------------------------------------


def rules_shown(df: DataFrame) -> DataFrame:
    return df.withColumn("variations", F.array_join("variations", "|"))


RULE_LIMITS = {"min_frequency": 20, "core_threshold": 0.15, "top_n": 5}


@query
def term_category(spark, folder):
    found = frequencies.document_frequency(extracted(spark, folder)).select("skill")
    return vocabulary.with_category(found, "skill", document_dictionary(spark))


@query
def term_variations(spark, folder):
    found = frequencies.document_frequency(extracted(spark, folder, normalize=False)).select("skill")
    return rules_shown(vocabulary.with_variations(found, "skill", document_variations(spark)))


@query
def global_rules(spark, folder):
    tallied = frequencies.tally(extracted(spark, folder))
    made = rules.global_rules(
        tallied, document_dictionary(spark), document_variations(spark), **RULE_LIMITS
    )
    return rules_shown(made)


@query
def role_rules(spark, folder):
    made = rules.rules(
        roles_tallied(spark, folder),
        document_dictionary(spark),
        document_variations(spark),
        **RULE_LIMITS,
    )
    return rules_shown(made)


@query
def core_terms(spark, folder):
    tallied = extraction.role_tally(extracted_parts(spark, folder), "p_type")
    made = rules.rules(
        tallied, vocabulary.dictionary_from_lists(spark, PART_TERMS), core_threshold=0.1
    )
    return made.filter("is_core_skill").select("role", "skill", "frequency", "percentage")


# Sinks and sources ----------------------------------------------------------


@query
def csv_roundtrip(spark, folder):
    path = fresh_path(spark, "csv")
    writers.write_csv(extracted(spark, folder), path, title_column="source")
    return sources.read_csv(spark, path, encoding="UTF-8")


@query
def csv_json_array_roundtrip(spark, folder):
    path = fresh_path(spark, "csv")
    columns = ["job_id", "text", "extracted_skills"]
    writers.write_csv(extracted(spark, folder), path, columns, skills_format="json_array")
    back = sources.read_csv(spark, path, encoding="UTF-8", na_values=())
    terms = F.from_json("extracted_skills", "array<string>")
    return back.select("job_id", "text", F.array_join(terms, "|").alias("skills"))


@query
def json_roundtrip(spark, folder):
    path = fresh_path(spark, "json")
    columns = ["job_id", "job_title", "extracted_skills", "skill_count"]
    writers.write_json(extracted(spark, folder), path, columns, title_column="source")
    schema = "job_id string, job_title string, extracted_skills array<string>, skill_count int"
    return shown(spark.read.schema(schema).json(path), "job_id", "job_title")


RULE_SCHEMA = (
    "skill string, pattern string, variations array<string>, category string, pattern_type string,"
    " frequency bigint, percentage double, is_core_skill boolean, rank int, role string"
)


@query
def rules_jsonl_roundtrip(spark, folder):
    tallied = frequencies.tally(extracted(spark, folder))
    made = rules.global_rules(
        tallied, document_dictionary(spark), document_variations(spark), **RULE_LIMITS
    )
    path = writers.write_global_rules(made, fresh_path(spark, "rules"))
    return rules_shown(spark.read.schema(RULE_SCHEMA).json(path)).drop("role")


@query
def role_rules_roundtrip(spark, folder):
    made = rules.rules(
        roles_tallied(spark, folder),
        document_dictionary(spark),
        document_variations(spark),
        **RULE_LIMITS,
    )
    path = writers.write_role_rules(made, fresh_path(spark, "rules"))
    back = spark.read.schema(RULE_SCHEMA + ", for_role string").json(path)
    return rules_shown(back).drop("for_role")


@query
def dataset_analytics_roundtrip(spark, folder):
    path = fresh_path(spark, "analytics")
    writers.write_dataset_analytics(frequencies.tally(extracted(spark, folder)), path, 5)
    schema = (
        "summary struct<total_jds_processed:bigint, total_skill_extractions:bigint>,"
        " skill_rankings array<struct<skill:string,count:bigint,percentage:double>>,"
        " all_skill_frequencies map<string,bigint>, all_skill_percentages map<string,double>"
    )
    back = spark.read.schema(schema).json(path)
    return back.select(
        "summary.*", "skill_rankings", "all_skill_percentages", F.explode("all_skill_frequencies")
    ).select(
        "total_jds_processed",
        "total_skill_extractions",
        F.col("key").alias("skill"),
        F.col("value").alias("count"),
        round2(F.col("all_skill_percentages")[F.col("key")]).alias("percentage"),
        F.exists("skill_rankings", lambda r: r["skill"] == F.col("key")).alias("ranked"),
    )


@query
def role_analytics_roundtrip(spark, folder):
    path = fresh_path(spark, "analytics")
    writers.write_role_analytics(roles_tallied(spark, folder), path, 3)
    schema = (
        "total_jds bigint, unique_skills bigint, avg_skills_per_jd double,"
        " top_skills array<struct<skill:string,count:bigint,percentage:double>>,"
        " role string, for_role string"
    )
    back = spark.read.schema(schema).json(path)
    listed = F.array_join(F.transform("top_skills", lambda t: t["skill"]), "|")
    return back.select(
        "role", "total_jds", "unique_skills", "avg_skills_per_jd", listed.alias("top_skills")
    )


@query
def na_values(spark, folder):
    """Spellings of a missing value become null, other text stays."""
    path = fresh_path(spark, "csv")
    source = F.col("source")
    noted = F.when(source == "src1", "NA").when(source == "src2", "n/a").when(source == "src3", "nap")
    written = table(spark, folder, "documents").select("doc_id", noted.otherwise("").alias("note"), "lang")
    written.write.csv(path, header=True)
    back = sources.read_documents(spark, path, "csv")
    return back.select(F.col("doc_id").cast("bigint"), "note", "lang")


@query
def encoding_routing(spark, folder):
    """Files in two encodings, read back together."""
    path = fresh_path(spark, "csv")
    source = table(spark, folder, "documents").select("doc_id", "text")
    western = F.col("text").rlike(r"\A[\x00-\xff]*\z")
    plain = source.filter(~western)
    plain.write.csv(f"{path}/a", header=True, escape='"', encoding="UTF-8")
    source.filter(western).write.csv(f"{path}/b", header=True, escape='"', encoding="ISO-8859-1")
    back = sources.read_csv(spark, [f"{path}/a", f"{path}/b"], na_values=())
    return back.select(F.col("doc_id").cast("bigint"), "text")


@query
def read_by_format(spark, folder):
    """One table through the JSON, parquet and CSV readers."""
    path = fresh_path(spark, "formats")
    kept = table(spark, folder, "documents").select("doc_id", "text")
    kept.write.json(f"{path}/in.json")
    kept.write.parquet(f"{path}/in.parquet")
    kept.write.csv(f"{path}/in.csv", header=True, escape='"')
    read = [
        sources.read_documents(spark, f"{path}/in.{kind}").select(
            F.lit(kind).alias("format"), F.col("doc_id").cast("bigint").alias("doc_id"), "text"
        )
        for kind in ("json", "parquet", "csv")
    ]
    return read[0].unionByName(read[1]).unionByName(read[2])


@query
def row_count_estimate(spark, folder):
    path = fresh_path(spark, "csv")
    orders = table(spark, folder, "orders").select("o_orderkey", "o_orderpriority")
    orders.repartition(3).write.csv(path, header=True)
    return sources.row_count_estimate(spark, path)


# End to end -----------------------------------------------------------------


@query
def extraction_result(spark, folder):
    result = extraction.extraction_result(
        gappy_documents(spark, folder),
        "text",
        document_dictionary(spark),
        document_variations(spark),
        order_by=["doc_id"],
        abbreviations=ABBREVIATIONS,
        keep=["doc_id"],
    )
    return shown(result, "job_id", "doc_id")


@query
def extraction_report(spark, folder):
    return extraction.extraction_report(
        gappy_documents(spark, folder),
        "text",
        document_dictionary(spark),
        document_variations(spark),
        abbreviations=ABBREVIATIONS,
    )


@query
def extraction_result_file_order(spark, folder):
    result = extraction.extraction_result(
        table(spark, folder, "documents"),
        "text",
        document_dictionary(spark),
        document_variations(spark),
        file_order=True,
        id_prefix="doc",
    )
    return shown(result, "job_id", "source")


# Streams --------------------------------------------------------------------


DOCUMENTS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def document_stream(spark: SparkSession, folder: str) -> DataFrame:
    # A pattern, since the table may be one file; a path must be a folder.
    return streaming.read_document_stream(spark, f"{folder}/document[s].parquet", DOCUMENTS)


def stream_plan(spark: SparkSession, **options) -> Callable[[DataFrame], DataFrame]:
    def plan(df: DataFrame) -> DataFrame:
        return extraction.extraction_result(
            df,
            "text",
            document_dictionary(spark),
            document_variations(spark),
            id_column="doc_id",
            **{"keep": [], **options},
        )

    return plan


@query
def stream_extract(spark, folder):
    path, state = fresh_path(spark, "stream"), fresh_path(spark, "state")
    started = streaming.write_extraction_stream(
        document_stream(spark, folder), stream_plan(spark), path, state
    )
    started.awaitTermination()
    return shown(spark.read.parquet(path), "job_id")


@query
def stream_extract_join(spark, folder):
    path, state = fresh_path(spark, "stream"), fresh_path(spark, "state")
    started = streaming.write_extraction_stream(
        document_stream(spark, folder),
        stream_plan(spark, matcher="join"),
        path,
        state,
    )
    started.awaitTermination()
    return shown(spark.read.parquet(path), "job_id")


#: Bytes of text in a file that arrives, about.
FILE_BYTES = 16 << 20


def files_for(text_bytes: int) -> int:
    """How many files so many bytes of text have: more for more text, so that files stay small."""
    return max(1, -(-text_bytes // FILE_BYTES))


@query
def stream_document_frequency(spark, folder):
    path, state = fresh_path(spark, "stream"), fresh_path(spark, "state")
    arriving, docs = fresh_path(spark, "arriving"), table(spark, folder, "documents")
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    files = files_for(-(-total // 4))
    docs.repartition(4 * files).write.parquet(arriving)
    seen = stream_plan(spark)(
        streaming.read_document_stream(spark, arriving, DOCUMENTS, max_files=files)
    )
    running = streaming.running_document_frequency(seen, distinct_ids=True)
    streaming.write_running_table(running, path, state).awaitTermination()
    return streaming.read_running_table(spark, path)


def in_files(docs: DataFrame, number: int, path: str) -> None:
    """Append the documents to a folder in the order of their ids, as ``number`` files at most.

    Documents of one id, or without ids, keep their order, and many of them can be split up.
    """
    order = ["doc_id", "_arrival"]
    placed = docs.withColumn("_arrival", F.monotonically_increasing_id())
    ranged = placed.repartitionByRange(number, *order).sortWithinPartitions(*order).drop("_arrival")
    ranged.write.mode("append").parquet(path)


def arriving_documents(spark: SparkSession, folder: str, chunks: int, path: str) -> Iterator[int]:
    """The documents in so many chunks in the order of their ids, which arrive in ``path`` one after the other.

    A chunk has as many files as its own text needs; their number comes when a chunk has arrived.
    """
    docs, key = table(spark, folder, "documents"), F.col("doc_id")
    shares = [n / chunks for n in range(1, chunks)]
    bounds = docs.agg(F.percentile_approx(key, shares).alias("bounds")).first().bounds or []
    number = sum((F.coalesce((key > bound).cast("int"), F.lit(0)) for bound in bounds), F.lit(0))
    size = F.sum(F.octet_length("text"))
    sizes = {row.chunk: row.size or 0 for row in docs.groupBy(number.alias("chunk")).agg(size.alias("size")).collect()}
    for chunk in range(chunks):
        files = files_for(sizes.get(chunk, 0))
        in_files(docs.filter(number == chunk), files, path)
        yield files


@query
def stream_row_ids(spark, folder):
    """Ids that go on over micro-batches of one chunk each."""
    path, state, arriving = (fresh_path(spark, kind) for kind in ("stream", "state", "arriving"))
    for _ in arriving_documents(spark, folder, 5, arriving):
        stream = streaming.read_document_stream(spark, arriving, DOCUMENTS, places=True)
        streaming.write_numbered_stream(
            stream.drop("text"), path, state, order_by=["doc_id"]
        ).awaitTermination()
    return streaming.read_numbered_stream(spark, path).select("doc_id", "job_id")


@query
def stream_extract_numbered(spark, folder):
    """Extraction from chunks, whose generated ids go on from chunk to chunk."""
    path, state, arriving = (fresh_path(spark, kind) for kind in ("stream", "state", "arriving"))

    def plan(batch: DataFrame) -> DataFrame:
        result = extraction.extraction_result(
            batch, "text", document_dictionary(spark), document_variations(spark), id_column="job_id"
        )
        return result.select("row_number", "job_id", "doc_id", "extracted_skills", "skill_count")

    for _ in arriving_documents(spark, folder, 3, arriving):
        stream = streaming.read_document_stream(spark, arriving, DOCUMENTS, places=True)
        streaming.write_numbered_stream(stream, path, state, plan=plan).awaitTermination()
    return shown(streaming.read_numbered_stream(spark, path), "job_id", "doc_id")


@query
def stream_top_terms(spark, folder):
    """The ranking of all documents that have arrived, each of them twice."""
    path, state, arriving = (fresh_path(spark, kind) for kind in ("stream", "state", "arriving"))
    files = list(arriving_documents(spark, folder, 3, arriving))
    in_files(spark.read.schema(DOCUMENTS).parquet(arriving), sum(files), arriving)
    stream = streaming.read_document_stream(spark, arriving, DOCUMENTS, max_files=-(-2 * sum(files) // 3))
    stream = stream.withColumn("seen", F.timestamp_seconds(F.col("doc_id") + 1_700_000_000))
    found = extraction.extraction_result(
        stream, "text", document_dictionary(spark), document_variations(spark), id_column="doc_id"
    )
    running = streaming.running_tally(found, distinct_ids=True, event_time="seen", delay="10000 days")
    streaming.write_running_table(running, path, state).awaitTermination()
    ranked = frequencies.top_terms(streaming.read_running_table(spark, path), 20)
    return ranked.select("rank", "skill", "count", "percentage")


@query
def stream_extract_csv(spark, folder):
    """CSV files as a stream: quoted commas, doubled quotes, line breaks and missing values."""
    path, state, arriving = (fresh_path(spark, kind) for kind in ("stream", "state", "arriving"))
    noted = F.when(F.col("source") == "src1", "NA").otherwise(
        F.concat(F.lit('say ""license"", now\n'), F.col("text"))
    )
    documents(spark, folder).select("doc_id", noted.alias("text")).write.csv(
        arriving, **writers.WRITE_CSV
    )
    stream = streaming.read_document_stream(spark, arriving, "doc_id string, text string", "csv")
    streaming.write_extraction_stream(
        stream, stream_plan(spark, keep=["text"]), path, state
    ).awaitTermination()
    return shown(spark.read.parquet(path), "job_id", "text")


@query
def csv_edge_spaces_roundtrip(spark, folder):
    """White space at the edges of values survives writing and reading."""
    path = fresh_path(spark, "csv")
    title = F.concat(F.lit("  "), F.substring("text", 1, 20), F.lit(" \t "))
    titled = extracted(spark, folder).withColumn("job_title", title)
    writers.write_csv(titled, path)
    back = sources.read_csv(spark, path, na_values=())
    return back.select("job_id", "job_title")


@query
def csv_mixed_headers(spark, folder):
    """Files with other columns, in another order, are read by name."""
    path = fresh_path(spark, "csv")
    docs = documents(spark, folder)
    even, odd = docs.filter("doc_id % 2 = 0"), docs.filter("doc_id % 2 = 1")
    even.select("doc_id", "lang", "source").write.csv(f"{path}/a", header=True)
    odd.select("source", "n_chars", "doc_id").write.csv(f"{path}/b", header=True)
    back = sources.read_csv(spark, [f"{path}/a", f"{path}/b"])
    return back.select(
        F.col("doc_id").cast("bigint"), "lang", "source", F.col("n_chars").cast("bigint")
    )


def whole_run(spark: SparkSession, folder: str) -> dict[str, str]:
    """The whole run from documents to files; the paths by kind."""
    return extraction.run_extraction(
        documents(spark, folder),
        "text",
        document_dictionary(spark),
        document_variations(spark),
        fresh_path(spark, "run"),
        columns=("job_id", "job_title", "processed_text", "extracted_skills", "skill_count"),
        title_column="source",
        role_column="source",
        id_column="doc_id",
        analytics=True,
        make_rules=True,
    )


@query
def run_extraction_roundtrip(spark, folder):
    """The result that a whole run has written, read back."""
    written = whole_run(spark, folder)
    schema = "job_id string, processed_text string, extracted_skills array<string>, skill_count int"
    json = spark.read.schema(schema).json(written["json"])
    csv = sources.read_csv(spark, written["csv"], na_values=("",))
    csv = csv.select(
        "job_id", "job_title", F.col("skill_count").cast("int").alias("csv_count")
    )
    return shown(json.join(csv, "job_id"), "job_id", "job_title", "processed_text", "csv_count")


@query
def run_extraction_rules(spark, folder):
    """The rules that a whole run has written, of all documents and per role, read back."""
    written = whole_run(spark, folder)
    overall = spark.read.schema(RULE_SCHEMA).json(written["global_rules"]).withColumn("role", F.lit("all"))
    per_role = spark.read.schema(RULE_SCHEMA + ", for_role string").json(written["role_rules"])
    return rules_shown(overall.unionByName(per_role.drop("for_role")))


@query
def run_extraction_analytics(spark, folder):
    """The analytics that a whole run has written, of all documents and per role, read back."""
    written = whole_run(spark, folder)
    ranking = "array<struct<skill:string,count:bigint,percentage:double>>"
    totals = "total_jds_processed:bigint, unique_skills_extracted:bigint, avg_skills_per_jd:double"
    overall = spark.read.schema(f"summary struct<{totals}>, skill_rankings {ranking}").json(written["dataset_analytics"])
    overall = overall.select(F.lit("all").alias("role"), "summary.*", "skill_rankings")
    fields = f"role string, total_jds bigint, unique_skills bigint, avg_skills_per_jd double, top_skills {ranking}"
    per_role = spark.read.schema(fields).json(written["role_analytics"])
    names = ["role", "total_jds", "unique_skills", "avg_skills_per_jd", "top_skills"]
    both = overall.toDF(*names).unionByName(per_role.select(*names))
    listed = F.transform("top_skills", lambda t: F.concat_ws(":", t["skill"], t["count"], t["percentage"].cast("decimal(20,2)")))
    return both.withColumn("top_skills", F.array_join(listed, "|"))
