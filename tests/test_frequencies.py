import math
import random
from collections import Counter

import pytest

from gleaner.functions.scalars import normalize_role, safe_name
from gleaner.operators import frequencies as f
from gleaner.operators.rules import global_rules, rules
from gleaner.operators.vocabulary import dictionary_from_lists, variations_from_map
from gleaner.plans.extraction import role_tally
from pyspark.sql import functions as F

DOCUMENTS = [
    ("en", ["a", "b", "a"]),
    ("en", ["a"]),
    ("en", []),
    ("fr", ["b", "c"]),
    ("fr", ["c", "b"]),
    ("de", []),
]


def table(spark, documents):
    df = spark.createDataFrame(documents, "role string, extracted_skills array<string>")
    return df.withColumn("skill_count", F.size("extracted_skills"))


def rows(df, *columns):
    return {tuple(r) for r in df.select(*columns).collect()}


def test_document_frequency_counts_a_document_once(spark):
    assert rows(f.document_frequency(table(spark, DOCUMENTS)), "skill", "count") == {
        ("a", 2), ("b", 3), ("c", 2),
    }


def test_term_stats_per_role(spark):
    stats = f.term_stats(f.tally(table(spark, DOCUMENTS), "role"), top_n=1)
    assert rows(stats, "role", "skill", "count", "total_jds", "rank") == {
        ("en", "a", 2, 3, 1), ("en", "b", 1, 3, None), ("fr", "b", 2, 2, 1), ("fr", "c", 2, 2, None),
    }
    assert {r.skill: r.percentage for r in stats.filter("role='en'").collect()} == {
        "a": 2 / 3 * 100, "b": 1 / 3 * 100,
    }


def test_missing_role_column_is_one_group(spark):
    tallied = f.tally(table(spark, DOCUMENTS), "no_such_column")
    assert rows(f.group_summary(tallied), "role", "total_jds", "unique_skills", "avg_skills_per_jd") == {
        ("all", 6, 3, 1.33)
    }


def test_groups_without_terms_are_summarised(spark):
    summary = f.group_summary(f.tally(table(spark, DOCUMENTS), "role"))
    assert rows(summary, "role", "total_jds", "unique_skills", "avg_skills_per_jd") == {
        ("en", 3, 2, 1.33), ("fr", 2, 2, 2.0), ("de", 1, 0, 0.0),
    }


def test_all_groups_equals_a_tally_without_roles(spark):
    df = table(spark, DOCUMENTS)
    columns = ("role", "skill", "size", "docs")
    assert rows(f.all_groups(f.tally(df, "role")), *columns) == rows(f.tally(df), *columns)


def test_dataset_summary(spark):
    assert f.dataset_summary(f.tally(table(spark, DOCUMENTS))).first().asDict() == {
        "total_jds_processed": 6,
        "unique_skills_extracted": 3,
        "total_skill_extractions": 8,
        "avg_skills_per_jd": 1.33,
        "median_skills_per_jd": 1.5,
        "max_skills_in_single_jd": 3,
        "min_skills_in_single_jd": 0,
    }


def test_empty_table_gives_zeros(spark):
    empty = table(spark, DOCUMENTS).limit(0)
    assert set(f.dataset_summary(f.tally(empty)).first().asDict().values()) == {0}
    assert f.term_stats(f.tally(empty)).count() == 0


def test_dataset_document_of_an_empty_table(spark):
    document = f.dataset_document(f.tally(table(spark, DOCUMENTS).limit(0))).first()
    assert set(document.summary.asDict().values()) == {0}
    assert document.skill_rankings == [] and document.all_skill_frequencies == {}


@pytest.mark.parametrize("make", [f.dataset_document, f.role_documents, f.term_stats, f.dataset_summary])
def test_documents_are_read_once(spark, make, tmp_path):
    path = str(tmp_path / "in")
    table(spark, DOCUMENTS).write.parquet(path)
    made = make(f.tally(spark.read.parquet(path), "role"))
    made.collect()
    plan = made._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    # What is ranked is the tally, which was written; the documents are not read for it again.
    ranked = make is not f.dataset_summary
    assert "isFinalPlan=true" in plan and plan.count("extracted_skills:array") == (0 if ranked else 1)
    assert "SinglePartition" not in plan or make is f.dataset_document or make is f.dataset_summary


def test_extraction_stats_leave_out_empty_texts(spark):
    df = spark.createDataFrame(
        [("a b", ["a", "b"]), ("", []), ("x", []), (None, [])],
        "processed_text string, extracted_skills array<string>",
    ).withColumn("skill_count", F.size("extracted_skills"))
    assert f.extraction_stats(df).first().asDict() == {
        "total_extractions": 2,
        "total_skills_found": 2,
        "unique_skills_count": 2,
        "unique_skills": ["a", "b"],
    }


def test_one_hot_role_and_term(spark):
    """A third of the documents share one role and all of those one term."""
    generator = random.Random(7)
    documents = [("hot", ["t0", f"t{generator.randrange(50)}"]) for _ in range(1000)]
    documents += [(f"r{i % 40}", [f"t{generator.randrange(50)}"]) for i in range(2000)]
    stats = f.term_stats(f.tally(table(spark, documents), "role"), 3)
    counted = Counter((role, term) for role, terms in documents for term in set(terms))
    assert rows(stats, "role", "skill", "count") == {(r, t, n) for (r, t), n in counted.items()}
    top = stats.filter("role = 'hot' and rank = 1").first()
    assert (top.skill, top["count"], top.percentage) == ("t0", 1000, 100.0)


def test_percentages_round_half_to_even(spark):
    counts = [(count, total) for total in (8, 16, 32, 160, 800) for count in range(1, total)]
    df = spark.createDataFrame(counts, "n int, total int")
    from gleaner.functions.scalars import percentage, round2

    found = df.select("n", "total", round2(percentage(F.col("n"), F.col("total"))).alias("p")).collect()
    assert all(math.isclose(r.p, round(r.n / r.total * 100, 2), abs_tol=1e-9) for r in found)


def test_role_documents(spark):
    found = {r.role: r for r in f.role_documents(f.tally(table(spark, DOCUMENTS), "role"), 1).collect()}
    assert found["fr"].skill_frequencies == {"b": 2, "c": 2}
    assert found["fr"].skill_percentages == {"b": 100.0, "c": 100.0}
    assert [tuple(t) for t in found["en"].top_skills] == [("a", 2, 66.67)]
    assert found["de"].skill_frequencies == {} and found["de"].top_skills == []


ROLES = {"Data Engineer": ["data engineer", "Sr Data Engineer"], "Second": ["data engineer"]}


@pytest.mark.parametrize(
    ("raw", "canonical"),
    [
        (" SR data engineer\t", "Data Engineer"),
        ("data engineer", "Data Engineer"),
        ("Data Analyst ", "Data Analyst"),
        ("data analyst", "data analyst"),
        ("   ", ""),
        ("", "Unknown"),
        (None, "Unknown"),
    ],
)
def test_normalize_role(spark, raw, canonical):
    df = spark.createDataFrame([(raw,)], "role string")
    assert df.select(normalize_role(F.col("role"), ROLES).alias("r")).first().r == canonical
    unmapped = df.select(normalize_role(F.col("role")).alias("r")).first().r
    assert unmapped == ("Unknown" if not raw else raw.strip())


def test_safe_name(spark):
    df = spark.createDataFrame([("R&D / Café 2",)], "role string")
    assert df.select(safe_name(F.col("role")).alias("n")).first().n == "R_D___Café_2"


def test_rules(spark):
    dictionary = dictionary_from_lists(spark, {"technical": ["a"], "soft": ["b", "a"]})
    variations = variations_from_map(spark, {"C": ["cc", "see"]})
    tallied = role_tally(table(spark, DOCUMENTS), "role", {"English": ["EN"]})
    made = rules(tallied, dictionary, variations, min_frequency=2, core_threshold=2 / 3, top_n=1)
    assert {(r.role, r.skill, r.category, r.is_core_skill, r.rank, tuple(r.variations)) for r in made.collect()} == {
        ("English", "a", "technical", True, 1, ("a",)),
        ("fr", "b", "soft", True, 1, ("b",)),
        ("fr", "c", "unknown", True, None, ("cc", "see")),
    }
    whole = {r.skill: r for r in global_rules(tallied, dictionary, core_threshold=0.5, min_frequency=3).collect()}
    assert whole["b"].asDict() == {
        "skill": "b", "pattern": "b", "variations": ["b"], "category": "soft",
        "pattern_type": "dictionary", "frequency": 3, "percentage": 50.0, "is_core_skill": True,
        "rank": 1,
    }
    assert set(whole) == {"b"}
