import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from gleaner.functions.abbreviations import expand_abbreviations, passes
from gleaner.functions.cleaning import clean_text, has_text, strip
from pyspark.sql import functions as F
from tests import model

TEXTS = [
    "<p>Hello <b>World</b></p>",
    "a < b > c < d",
    "<a\nhref='x'>link",
    "<><x> <",
    "see https://x.y/z?a=1 and http://q",
    "mail bob@example.org now, @me a@ @@x c@d",
    "C++, C# & .NET; full-stack!",
    "no break space\x1cseparator\x85next",
    "é decomposed ai² ١٢",
    "ΑΣ ΑΣΑ İstanbul ẞ",
    "TH th-er nd, NT st\tth",
    "under_score Th_er",
    "",
    "  \t\n",
]
ABBREVIATIONS = {"th": "than", "er": "other", "nd": "and", "nt": "st", "st": "street"}


@pytest.mark.parametrize(
    "options",
    [
        {},
        {"lower": False},
        {"spaces": False},
        {"special": False},
        {"hyphens": False},
        {"lower": False, "spaces": False, "special": False},
    ],
)
@pytest.mark.parametrize("abbreviations", [None, ABBREVIATIONS])
def test_options(texts, options, abbreviations):
    names = {
        "lower": "lowercase",
        "spaces": "normalize_whitespace",
        "special": "remove_special_chars",
        "hyphens": "preserve_hyphens",
    }
    cleaned = clean_text(
        texts(*TEXTS),
        "text",
        abbreviations=abbreviations,
        **{names[key]: value for key, value in options.items()},
    )
    found = [row.processed_text for row in cleaned.orderBy("id").collect()]
    assert found == [model.clean(text, abbreviations, **options) for text in TEXTS]


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.text(alphabet="<>@ht:/p.+-#aZ_é²\n\t\x1c ", max_size=30), min_size=1, max_size=40))
def test_random_texts(texts, values):
    cleaned = clean_text(texts(*values), "text").orderBy("id").collect()
    assert [row.processed_text for row in cleaned] == [model.clean(text) for text in values]


def test_no_step_is_quadratic(texts):
    hostile = ["<" * 200_000, "x" * 200_000, "@" * 200_000, "<a" * 100_000 + ">", "a@" + " b@" * 50_000]
    cleaned = clean_text(texts(*hostile), "text", remove_special_chars=False)
    lengths = [row.n for row in cleaned.select("id", F.length("processed_text").alias("n")).orderBy("id").collect()]
    assert lengths[:3] == [200_000, 200_000, 0]


def test_numbers_are_cleaned_as_text(spark):
    df = spark.createDataFrame([(5,)], "text int")
    assert clean_text(df, "text").first().processed_text == "5"


def test_null_stays_null(texts):
    assert clean_text(texts(None), "text", abbreviations=ABBREVIATIONS).first().processed_text is None


def test_has_text_and_strip(texts):
    values = ["a", None, "", " \t \x1c", " b "]
    rows = (
        texts(*values)
        .select(has_text(F.col("text")).alias("ok"), strip(F.col("text")).alias("s"), "id")
        .orderBy("id")
        .collect()
    )
    assert [row.ok for row in rows] == [True, False, False, False, True]
    assert [row.s for row in rows] == ["a", None, "", "", "b"]


@pytest.mark.parametrize(
    "abbreviations",
    [
        {"mgmt": "management", "sr": "senior"},
        {"a": "b", "b": "c", "c": "a"},
        {"b": "c", "a": "b"},
        {"nt": "st nt", "st": "street $1 \\"},
        {"p m": "project manager", "pm": "p m"},
        {"c++": "cpp", "c#": "c-sharp", ".net": "dotnet"},
        {"x": "", "y": "x"},
        {"th": "th"},
    ],
)
def test_abbreviations(texts, abbreviations):
    values = ["Sr mgmt, sr_ SR.", "a b c abc a-b", "nt st nts NT", "the p m and PM pm", "c++ c++11 c# vb.net .net", "x y xy", "TH", ""]
    expanded = texts(*values).select(
        "id",
        expand_abbreviations(
            F.col("text"), abbreviations, lowered=False, controls_removed=False
        ).alias("out"),
    )
    found = [row.out for row in expanded.orderBy("id").collect()]
    assert found == [model.abbreviate(text, abbreviations) for text in values]


KEYS = st.text(alphabet="ab. +", min_size=1, max_size=5).filter(lambda key: key == key.strip())


@settings(max_examples=40, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    st.dictionaries(KEYS, st.text(alphabet="abC. +", max_size=5), min_size=1, max_size=8),
    st.lists(st.text(alphabet="ab.+ AB", max_size=25), min_size=1, max_size=25),
)
def test_entries_in_groups_are_the_same_as_in_turn(texts, abbreviations, values):
    df = texts(*values).select(
        "id", expand_abbreviations(F.col("text"), abbreviations, lowered=False, controls_removed=False).alias("out")
    )
    found = [row.out for row in df.orderBy("id").collect()]
    # Keys that differ only in case are one key.
    assert found == [model.abbreviate(text, abbreviations) for text in values]


def test_many_mixed_entries_take_few_passes(texts):
    """Two hundred entries: single words, several words, symbols, and some that build on others."""
    entries = {f"abbr{i}": f"abbreviation {i}" for i in range(100)}
    entries |= {f"key {i} of": f"the key no {i} out of" for i in range(60)}
    entries |= {f"c{i}++": f"cplus{i}#" for i in range(20)} | {f".x{i}": f".xml{i}" for i in range(18)}
    entries |= {"abbreviation 7": "seventh", "no 3": "third"}
    assert len(entries) == 200 and len(passes(entries)) <= 3
    values = ["abbr1 ABBR7, abbr99x key 3 of key 59 of", "c1++ c19++x a.x1 b.x17c abbr7.x2 ok", ""]
    df = texts(*values).select("id", expand_abbreviations(F.col("text"), entries, lowered=False).alias("out"))
    found = [row.out for row in df.orderBy("id").collect()]
    assert found == [model.abbreviate(text, entries) for text in values]
    assert found[0].startswith("abbreviation 1 seventh, abbr99x the key third out of")
