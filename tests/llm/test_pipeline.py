"""The pipeline's stages, each on all that its predecessor kept, against plain models."""

from collections import Counter, defaultdict

from corpus_pipeline import STAGES
from gleaner.llm.tasks import stored
from tests.llm.brute import DOCUMENTS, awkward_rows, base_spans, classes, fingerprint, rule_stats

FOLDER = "/root/testdata/sf0.001"


def clashing(df):
    """More columns, of names that the stages use themselves."""
    return df.selectExpr("*", "'x' as row", "1 as key", "'h' as host", "2 as copies", "'d' as digest", "0 as piece")


def test_stages_on_awkward_rows(spark):
    """Nulls in every column, empty and very long texts, ties, repeated rows, and other columns of clashing names."""
    rows = [tuple(r) for r in spark.createDataFrame(awkward_rows(), DOCUMENTS).collect()]
    rows += rows[:4] + [(8, "other " + "text " * 30, "en", "b", 5, "k", "n", "i"), (20, "y " * 9 + "z", None, None, 1, *"kni")]
    rows += [(1, rows[0][1], "fr", "zz", None, "k", "n", "i")]  # the same id and text, another language
    docs = clashing(spark.createDataFrame(rows, DOCUMENTS))
    kept = check_stages(spark, docs)
    assert any(r.doc_id is None for r in kept["quality rules"])
    assert sum(r.doc_id == 1 for r in kept["near duplicates"]) == 1
    again = [stage(spark, docs, FOLDER) for name, stage in STAGES if name == "near duplicates"][0].collect()
    assert {r.lang for r in again if r.doc_id == 1} == {"en"}  # of equal ids and texts the smallest row


def test_stages_on_an_empty_table(spark):
    docs = clashing(spark.createDataFrame([], DOCUMENTS))
    for name, stage in STAGES:
        docs = stage(spark, docs, FOLDER) if name == STAGES[-1][0] else stored(stage(spark, docs, FOLDER), "stage")
        assert docs.collect() == []


def test_stages(spark):
    check_stages(spark, spark.read.parquet(f"{FOLDER}/documents.parquet"))


def check_stages(spark, docs):
    columns, results = docs.columns, [docs.collect()]
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, FOLDER), "stage")
        results.append(docs.collect())
        assert name == STAGES[-1][0] or docs.columns == columns
    given, good, single, clean, mixed, packed = results

    # Shared lines reject no others in so small a table.
    for _, text in {(r.doc_id, r.text) for r in given} - {(r.doc_id, r.text) for r in good}:
        n_words, *_, repeated = rule_stats(text)
        assert n_words < 10 or 100 * repeated > 20 * n_words
    assert all(rule_stats(r.text)[0] >= 10 for r in good)

    ids = [r.doc_id for r in good]
    groups = classes(ids, [fingerprint(r.text) for r in good], 4)
    assert Counter(r.doc_id for r in single) == Counter(set(groups))

    before = {r.doc_id: r for r in single}
    assert Counter(r.doc_id for r in single) == Counter(r.doc_id for r in clean)
    for r in clean:
        assert r.n_chars is None or r.n_chars == len(r.text)
        spans = base_spans(before[r.doc_id].text)
        assert spans or "[" in r.text or r.text == before[r.doc_id].text
        assert all(before[r.doc_id].text[a:b] not in r.text for a, _, _, b in spans)

    assert mixed and set(mixed) <= set(clean)
    assert Counter(p.doc_id for p in packed if p.piece == 0) == Counter(r.doc_id for r in mixed)
    places = defaultdict(list)
    for p in packed:
        places[p.sequence_id].append((p.offset, p.length))
    for own in places.values():
        end = 0
        for offset, length in sorted(own):
            assert offset == end
            end += length
        assert end <= 4096
    return dict(zip(["given", *(name for name, _ in STAGES)], results, strict=True))
