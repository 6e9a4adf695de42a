import pytest

from gleaner.operators import vocabulary as v


@pytest.fixture(scope="module")
def dictionary(spark):
    return v.dictionary_from_lists(
        spark,
        {
            "technical": ["Python", "python", "SQL", "Go"],
            "soft": ["Teamwork", "sql"],
            "custom": ["go", "dbt", "kafka"],
        },
    )


@pytest.fixture(scope="module")
def variations(spark):
    return v.variations_from_map(
        spark,
        {
            "JavaScript": ["JS", "ECMA"],
            "SQL": ["structured query language", "Sequel"],
            "Sequel": ["sql"],
            "Empty": [],
            "Other": ["js"],
        },
    )


def as_dict(df):
    return {row[0]: row[1] for row in df.collect()}


def test_union(dictionary):
    assert sorted(r.term for r in v.dictionary_union(dictionary).collect()) == [
        "dbt", "go", "kafka", "python", "sql", "teamwork",
    ]


def test_stats(dictionary):
    found = {r.category: tuple(r)[1:] for r in v.dictionary_stats(dictionary).collect()}
    assert found == {"technical": (3, 1, 1), "soft": (2, 0, 1), "custom": (3, 0, 1), "all": (6, 1, 3)}


def test_category_filter_and_first_category(dictionary):
    assert {r.term for r in v.terms_of_category(dictionary, "custom").collect()} == {"go", "dbt", "kafka"}
    assert as_dict(v.term_categories(dictionary)) == {
        "python": "technical", "sql": "technical", "go": "technical",
        "teamwork": "soft", "dbt": "custom", "kafka": "custom",
    }


def test_add_terms(dictionary):
    grown = v.add_terms(dictionary, ["Spark SQL"])
    assert as_dict(v.term_categories(grown))["spark sql"] == "custom"
    with pytest.raises(ValueError):
        v.add_terms(dictionary, ["x"], "other")


def test_members(spark, dictionary):
    df = spark.createDataFrame([("PYTHON",), ("rust",), (None,)], "word string")
    assert v.members(df, "word", dictionary).collect() == [("PYTHON",)]
    assert {r.word for r in v.members(df, "word", dictionary, inside=False).collect()} == {"rust", None}


def test_unknown_category(spark, dictionary):
    df = spark.createDataFrame([("sql",), ("rust",)], "skill string")
    assert as_dict(v.with_category(df, "skill", dictionary)) == {"sql": "technical", "rust": "unknown"}


def test_vocabulary_takes_the_last_canonical(dictionary, variations):
    found = as_dict(v.match_vocabulary(dictionary, variations))
    assert found["js"] == "other"
    assert found["ecma"] == "javascript"
    assert found["sql"] == "sequel"
    assert found["python"] == "python"
    assert "javascript" not in found and "empty" not in found


def test_longest_first(dictionary):
    ordered = [r.pattern for r in v.longest_first(v.match_vocabulary(dictionary)).collect()]
    assert ordered == ["teamwork", "python", "kafka", "dbt", "sql", "go"]


def test_spellings_take_the_first_canonical(spark, variations):
    df = spark.createDataFrame(
        [("javascript",), ("js",), ("sql",), ("sequel",), ("empty",), ("rust",)], "skill string"
    )
    assert as_dict(v.with_variations(df, "skill", variations)) == {
        "javascript": ["JS", "ECMA"],
        "js": ["JavaScript", "JS", "ECMA"],
        "sql": ["structured query language", "Sequel"],
        "sequel": ["SQL", "structured query language", "Sequel"],
        "empty": [],
        "rust": ["rust"],
    }
    assert as_dict(v.with_variations(df, "skill", None))["js"] == ["js"]
