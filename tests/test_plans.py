import json
from pathlib import Path

import pytest

from gleaner.operators.vocabulary import dictionary_from_lists, variations_from_map
from gleaner.plans.extraction import extraction_report, extraction_result, run_extraction
from gleaner.streaming import extraction as streaming
from pyspark.sql import functions as F

ROWS = [
    ("A", "Sr Engineer", "<p>Needs Python, SQL and JS</p>"),
    ("B", "engineer", "python PYTHON mgmt"),
    ("C", "Analyst", None),
    ("D", None, "   "),
    ("E", "Analyst", "excel & sql"),
    ("F", "Analyst", "!!!"),
]
ROLES = {"Engineer": ["engineer", "sr engineer"]}


@pytest.fixture(scope="module")
def jobs(spark):
    return spark.createDataFrame(ROWS, "code string, title string, description string")


@pytest.fixture(scope="module")
def dictionary(spark):
    return dictionary_from_lists(
        spark, {"technical": ["Python", "SQL", "Excel"], "soft": ["management"]}
    )


@pytest.fixture(scope="module")
def variations(spark):
    return variations_from_map(spark, {"JavaScript": ["JS", "ECMA"]})


EXPECTED = {
    "jd_001": ["python", "sql", "javascript"],
    "jd_002": ["python", "management"],
    "jd_005": ["excel", "sql"],
    "jd_006": [],
}


@pytest.mark.parametrize("matcher", ["auto", "join"])
def test_ids_are_given_before_rows_are_dropped(jobs, dictionary, variations, matcher):
    result = extraction_result(
        jobs, "description", dictionary, variations,
        order_by=["code"], abbreviations={"mgmt": "management"}, matcher=matcher,
    )
    assert {r.job_id: r.extracted_skills for r in result.collect()} == EXPECTED
    assert set(result.columns) == {
        "code", "title", "description", "job_id", "processed_text", "extracted_skills", "skill_count",
    }


def test_with_an_id_column_nothing_is_shuffled(jobs, dictionary, variations):
    result = extraction_result(jobs, "description", dictionary, variations, id_column="code")
    assert "Exchange" not in result._jdf.queryExecution().executedPlan().toString()
    assert sorted(r.job_id for r in result.collect()) == ["A", "B", "E", "F"]


def test_missing_text_column(jobs, dictionary):
    with pytest.raises(ValueError, match="no text column 'jd'"):
        extraction_result(jobs, "jd", dictionary)


def test_report(jobs, dictionary, variations):
    report = extraction_report(
        jobs, "description", dictionary, variations, abbreviations={"mgmt": "management"}
    )
    assert report.first().asDict() == {
        "records_processed": 4,
        "records_skipped": 2,
        "total_skills": 7,
        "unique_skills": 5,
        "avg_skills_per_jd": 1.75,
    }


def lines(path):
    return [json.loads(line) for file in Path(path).rglob("part-*") for line in file.read_text().splitlines()]


def test_everything_is_written(spark, jobs, dictionary, variations, tmp_path):
    paths = run_extraction(
        jobs, "description", dictionary, variations, str(tmp_path),
        formats=["csv", "json", "other"], title_column="title", role_column="title", role_map=ROLES,
        analytics=True, make_rules=True, min_frequency=1, top_n=1, order_by=["code"],
        abbreviations={"mgmt": "management"},
    )
    assert set(paths) == {
        "csv", "json", "dataset_analytics", "role_analytics", "global_rules", "role_rules",
    }
    back = {r.job_id: r.asDict() for r in spark.read.csv(paths["csv"], header=True).collect()}
    assert back["jd_001"]["extracted_skills"] == "python, sql, javascript"
    assert back["jd_001"]["job_title"] == "Sr Engineer"
    assert {r["job_id"]: r["extracted_skills"] for r in lines(paths["json"])} == EXPECTED

    (analytics,) = lines(paths["dataset_analytics"])
    assert analytics["summary"]["total_jds_processed"] == 4
    assert analytics["summary"]["median_skills_per_jd"] == 2.0
    assert analytics["skill_rankings"] == [{"skill": "python", "count": 2, "percentage": 50.0}]
    assert analytics["all_skill_frequencies"] == {
        "python": 2, "sql": 2, "javascript": 1, "management": 1, "excel": 1,
    }
    by_role = {r["role"]: r for r in lines(paths["role_analytics"])}
    assert set(by_role) == {"Engineer", "Analyst"}
    assert by_role["Analyst"]["total_jds"] == 2
    assert by_role["Analyst"]["skill_percentages"] == {"excel": 50.0, "sql": 50.0}

    rules = {r["skill"]: r for r in lines(paths["global_rules"])}
    assert rules["python"]["rank"] == 1 and "rank" not in rules["sql"]
    assert "role" not in rules["python"]
    assert rules["javascript"]["variations"] == ["JS", "ECMA"]
    assert rules["javascript"]["category"] == "unknown"
    role_rules = lines(paths["role_rules"])
    assert {(r["role"], r["skill"]) for r in role_rules} == {
        ("Engineer", "python"), ("Engineer", "sql"), ("Engineer", "javascript"),
        ("Engineer", "management"), ("Analyst", "excel"), ("Analyst", "sql"),
    }


@pytest.fixture
def arriving(spark, jobs, tmp_path):
    """The rows as five files, the last one a copy of the first."""
    folder = tmp_path / "in"
    for i in range(4):
        jobs.filter(F.crc32("code") % 4 == i).coalesce(1).write.mode("append").parquet(str(folder))
    jobs.filter("code = 'A'").coalesce(1).write.mode("append").parquet(str(folder))
    schema = "code string, title string, description string"
    return streaming.read_document_stream(spark, str(folder), schema, max_files=1)


@pytest.mark.parametrize("matcher", ["pattern", "join"])
def test_stream_equals_batch(spark, arriving, jobs, dictionary, variations, tmp_path, matcher):
    def plan(df):
        result = extraction_result(
            df, "description", dictionary, variations, id_column="code", matcher=matcher
        )
        return result.select("job_id", "extracted_skills", "skill_count")

    path = str(tmp_path / "out")
    streaming.write_extraction_stream(
        arriving, plan, path, str(tmp_path / "state"), per_batch=matcher == "join"
    ).awaitTermination()
    found = spark.read.parquet(path).select("job_id", "extracted_skills", "skill_count")
    wanted = plan(jobs).collect()
    first = [row for row in wanted if row.job_id == "A"]
    assert sorted(found.collect()) == sorted([*wanted, *first])


@pytest.mark.parametrize(("distinct_ids", "python"), [(True, 2), (False, 3)])
def test_running_frequency(spark, arriving, dictionary, tmp_path, distinct_ids, python):
    seen = extraction_result(arriving, "description", dictionary, id_column="code")
    table = streaming.running_document_frequency(seen, distinct_ids=distinct_ids)
    path = str(tmp_path / "out")
    streaming.write_running_table(table, path, str(tmp_path / "state")).awaitTermination()
    assert len(list((tmp_path / "out").glob("batch=*"))) <= 3  # older states go
    (tmp_path / "out" / "batch=999").mkdir()  # as a writer leaves it that is stopped half-way
    counts = {r.skill: r["count"] for r in streaming.read_running_table(spark, path).collect()}
    assert counts["python"] == python and counts["excel"] == 1
