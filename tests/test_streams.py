"""What goes on from one micro-batch to the next: numbers, tallies, and ids of a bounded time."""

import pytest

from gleaner.operators import frequencies
from gleaner.operators.extraction import extract_terms
from gleaner.plans import catalog
from gleaner.plans.extraction import extraction_result
from gleaner.streaming import extraction as streaming
from gleaner.operators.vocabulary import dictionary_from_lists
from pyspark.sql import functions as F

ROWS = "n long, text string, seen timestamp"


def arrive(spark, folder, low, high, hour=0):
    """One file of the numbers from ``low`` to ``high``."""
    rows = spark.range(low, high, 1, 1).select(
        F.col("id").alias("n"),
        F.when(F.col("id") % 3 == 0, "python and sql").otherwise("sql").alias("text"),
        F.timestamp_seconds(F.lit(1_700_000_000 + hour * 3600) + F.col("id") % 60).alias("seen"),
    )
    rows.write.mode("append").parquet(folder)


def stream(spark, folder, **options):
    return streaming.read_document_stream(spark, folder, ROWS, places=True, **options)


@pytest.mark.parametrize("order", [None, ["n"]])
def test_ids_do_not_depend_on_the_micro_batches(spark, tmp_path, order):
    folder, cuts = str(tmp_path / "in"), [0, 7, 7, 400, 990, 1203]
    for low, high in zip(cuts[:-1], cuts[1:], strict=True):
        arrive(spark, folder, low, high)
    found = []
    for files in (1, 2, 100) if order else (1,):
        path = str(tmp_path / f"out{files}")
        given = stream(spark, folder, max_files=files)
        streaming.write_numbered_stream(given, path, f"{path}.state", order_by=order).awaitTermination()
        rows = streaming.read_numbered_stream(spark, path, "doc")
        assert "_split_of_files" not in rows.columns or order
        found.append({r.n: r.job_id for r in rows.collect()})
    assert all(ids == {n: f"doc_{n + 1:04d}" for n in range(1203)} for ids in found)
    first = spark.read.parquet(str(tmp_path / "out1/rows")).filter("n = 3").first()
    assert first.job_id == "jd_004"  # as wide as the rows so far need


def test_a_killed_micro_batch_is_repeated_with_the_same_ids(spark, tmp_path):
    folder, path, state = (str(tmp_path / name) for name in ("in", "out", "state"))
    arrive(spark, folder, 0, 50)
    streaming.write_numbered_stream(stream(spark, folder), path, state).awaitTermination()
    arrive(spark, folder, 50, 120)

    def broken(df):
        assert df.count() == 70
        raise RuntimeError("killed")

    with pytest.raises(Exception, match="killed"):
        streaming.write_numbered_stream(stream(spark, folder), path, state, plan=broken).awaitTermination()
    # As a writer leaves it that is stopped after the rows, before the total.
    spark.range(9).selectExpr("id as n", "id as row_number", "'x' as job_id", "'t' as text", "null as seen").write.parquet(
        f"{path}/rows/batch=1"
    )
    assert streaming.read_numbered_stream(spark, path).count() == 50
    arrive(spark, folder, 120, 130)
    streaming.write_numbered_stream(stream(spark, folder), path, state).awaitTermination()
    ids = {r.n: r.job_id for r in streaming.read_numbered_stream(spark, path).collect()}
    assert ids == {n: f"jd_{n + 1:03d}" for n in range(130)}


def test_ids_of_an_extraction_that_drops_rows(spark, tmp_path):
    folder, path = str(tmp_path / "in"), str(tmp_path / "out")
    terms = dictionary_from_lists(spark, {"technical": ["python"]})
    arrive(spark, folder, 0, 30)
    arrive(spark, folder, 30, 60)

    def plan(df):
        result = extraction_result(df.filter("n % 2 = 0"), "text", terms, id_column="job_id")
        return result.select("n", "row_number", "job_id", "extracted_skills")

    given = stream(spark, folder, max_files=1)
    streaming.write_numbered_stream(given, path, f"{path}.state", plan=plan).awaitTermination()
    rows = streaming.read_numbered_stream(spark, path).collect()
    assert {r.n: r.job_id for r in rows} == {n: f"jd_{n + 1:03d}" for n in range(0, 60, 2)}
    assert all(r.extracted_skills == (["python"] if r.n % 3 == 0 else []) for r in rows)


def test_the_state_of_seen_ids_levels_off(spark, tmp_path):
    """Twenty micro-batches an hour apart, each file twice: ids are held for three hours only."""
    folder, path = str(tmp_path / "in"), str(tmp_path / "out")
    for hour in range(20):
        for _ in range(2):
            arrive(spark, folder, hour * 50, hour * 50 + 50, hour)
    given = stream(spark, folder, max_files=2).withColumn("job_id", F.col("n").cast("string"))
    found = extract_terms(given, {"python": "python", "sql": "sql"}, "text")
    running = streaming.running_tally(found, distinct_ids=True, event_time="seen", delay="3 hours")
    query = streaming.write_running_table(running, path, f"{path}.state")
    query.awaitTermination()
    held = [max(s["numRowsTotal"] for s in p["stateOperators"]) for p in query.recentProgress if p["numInputRows"]]
    assert len(held) == 20
    assert max(held[10:]) <= max(held[:10]) <= 8 * 50
    ranked = frequencies.top_terms(streaming.read_running_table(spark, path), 5).orderBy("rank").collect()
    python = sum(n % 3 == 0 for n in range(1000))
    assert [(r["skill"], r["count"], r["percentage"]) for r in ranked] == [
        ("sql", 1000, 100.0), ("python", python, round(python / 10, 2)),
    ]


def test_running_frequency_within_a_time(spark, tmp_path):
    folder, path = str(tmp_path / "in"), str(tmp_path / "out")
    for hour in range(3):
        arrive(spark, folder, 0, 30, hour)
    given = stream(spark, folder, max_files=1).withColumn("job_id", F.col("n").cast("string"))
    found = extract_terms(given, {"python": "python"}, "text")
    table = streaming.running_document_frequency(found, distinct_ids=True, event_time="seen", delay="1 day")
    streaming.write_running_table(table, path, f"{path}.state").awaitTermination()
    assert {r.skill: r["count"] for r in streaming.read_running_table(spark, path).collect()} == {"python": 10}


def own_documents(spark, folder):
    """800 documents in four files, ids out of order and one of them twice; (id, text) of each."""
    rows = [(n * 37 % 800, f"ertion {n} " + "of the word " * (n % 50)) for n in range(800)] + [(5, "ertion again")]
    made = spark.createDataFrame(rows, "doc_id long, text string").withColumns(
        {"lang": F.lit("en"), "source": F.lit("src1"), "n_chars": F.length("text").cast("long")}
    )
    made.repartition(4).write.parquet(f"{folder}/documents.parquet")
    return rows


def files_written(spark, monkeypatch, query, folder):
    """What a query returns where a file has 20,000 bytes, and the bytes of text in each file it lets arrive."""
    paths = []

    def fresh(session, name, made=catalog.fresh_path):
        paths.append((name, made(session, name)))
        return paths[-1][1]

    monkeypatch.setattr(catalog, "fresh_path", fresh)
    monkeypatch.setattr(catalog, "FILE_BYTES", 20_000, raising=False)
    found = catalog.QUERIES[query](spark, folder).collect()
    arriving = spark.read.parquet(dict(paths)["arriving"])
    sizes = arriving.groupBy(F.input_file_name()).agg(F.sum(F.octet_length("text")).alias("bytes")).collect()
    return found, [row["bytes"] for row in sizes]


def test_files_that_arrive_for_a_ranking_stay_small(spark, tmp_path, monkeypatch):
    folder = str(tmp_path)
    rows = own_documents(spark, folder)
    found, sizes = files_written(spark, monkeypatch, "stream_top_terms", folder)
    assert sum(sizes) == 2 * sum(len(text) for _, text in rows)
    assert max(sizes) <= 2 * 20_000
    assert {r["skill"]: (r["rank"], r["count"]) for r in found}["ertion"] == (1, 800)  # the repeated id counts once


@pytest.mark.parametrize("query", ["stream_extract_numbered", "stream_row_ids"])
def test_files_that_arrive_for_numbers_stay_small(spark, tmp_path, monkeypatch, query):
    folder = str(tmp_path)
    rows = own_documents(spark, folder)
    found, sizes = files_written(spark, monkeypatch, query, folder)
    assert sum(sizes) == sum(len(text) for _, text in rows)
    assert max(sizes) <= 2 * 20_000
    expected = sorted(doc_id for doc_id, _ in rows)
    assert sorted((r.job_id, r.doc_id) for r in found) == [(f"jd_{n:03d}", i) for n, i in enumerate(expected, 1)]


def test_files_that_arrive_for_frequencies_stay_small(spark, tmp_path, monkeypatch):
    folder = str(tmp_path)
    rows = own_documents(spark, folder)
    found, sizes = files_written(spark, monkeypatch, "stream_document_frequency", folder)
    assert sum(sizes) == sum(len(text) for _, text in rows)
    assert max(sizes) <= 2 * 20_000
    assert {r["skill"]: r["count"] for r in found}["ertion"] == 800


@pytest.mark.parametrize("ids", [[], [7] * 30, [None, None, 3, 3, 3, 9]])
def test_chunks_of_few_ids(spark, tmp_path, ids):
    """No documents, equal ids and no ids: every row arrives once, and is numbered."""
    folder = str(tmp_path)
    spark.createDataFrame(
        [(i, f"ertion {n}", "en", "src1", 8) for n, i in enumerate(ids)], catalog.DOCUMENTS
    ).write.parquet(f"{folder}/documents.parquet")
    found = catalog.QUERIES["stream_extract_numbered"](spark, folder).collect()
    assert sorted(r.job_id for r in found) == [f"jd_{n:03d}" for n in range(1, len(ids) + 1)]
    assert sorted(str(r.doc_id) for r in found) == sorted(map(str, ids))


@pytest.mark.parametrize("query", ["stream_extract_numbered", "stream_row_ids"])
@pytest.mark.parametrize("key", [None, 7])
def test_files_that_arrive_stay_small_without_different_ids(spark, tmp_path, monkeypatch, query, key):
    """No ids, or one id for all: the documents of a chunk still are many files, in their order."""
    folder = str(tmp_path)
    texts = [f"ertion {n} " + "of the word " * (n % 50) for n in range(800)]
    spark.createDataFrame(
        [(key, text, "en", "src1", len(text)) for text in texts], catalog.DOCUMENTS
    ).repartition(4).write.parquet(f"{folder}/documents.parquet")
    found, sizes = files_written(spark, monkeypatch, query, folder)
    assert sum(sizes) == sum(map(len, texts))
    assert max(sizes) <= 2 * 20_000
    assert sorted((r.job_id, r.doc_id) for r in found) == [(f"jd_{n:03d}", key) for n in range(1, 801)]


def test_files_that_arrive_stay_small_where_a_chunk_is_long(spark, tmp_path, monkeypatch):
    """A chunk that has nearly all of the text has more files than the others."""
    folder = str(tmp_path)
    texts = [f"ertion {n} " + "of the word " * (50 if n < 250 else 0) for n in range(800)]
    spark.createDataFrame(
        [(n, text, "en", "src1", len(text)) for n, text in enumerate(texts)], catalog.DOCUMENTS
    ).repartition(4).write.parquet(f"{folder}/documents.parquet")
    found, sizes = files_written(spark, monkeypatch, "stream_extract_numbered", folder)
    assert sum(sizes) == sum(map(len, texts))
    assert max(sizes) <= 2 * 20_000
    assert sorted((r.job_id, r.doc_id) for r in found) == [(f"jd_{n + 1:03d}", n) for n in range(800)]
