import pytest

from gleaner.operators import rows
from gleaner.sources.documents import read_csv
from pyspark.sql import functions as F


def ids(df, *order):
    return [row.job_id for row in df.orderBy(*order).collect()]


def test_generated_ids_follow_the_order(spark):
    df = spark.range(1000).select((999 - F.col("id")).alias("k")).repartition(7)
    numbered = rows.add_row_ids(df, order_by=["k"])
    assert ids(numbered, "k") == [f"jd_{i:04d}" for i in range(1, 1001)]
    assert numbered.columns == ["k", "job_id"]


def test_generated_ids_have_three_digits_at_least(spark):
    assert ids(rows.add_row_ids(spark.range(2).coalesce(1), prefix="doc"), "id") == ["doc_001", "doc_002"]


def test_generated_ids_in_scan_order(spark, tmp_path):
    path = str(tmp_path / "in.csv")
    with open(path, "w") as file:
        file.write("text\n" + "\n".join(f"row {i}" for i in range(1, 51)))
    df = spark.read.csv(path, header=True)
    numbered = rows.add_row_ids(df)
    assert all(row.text == f"row {int(row.job_id[3:])}" for row in numbered.collect())


def test_generated_ids_in_file_order(spark, tmp_path):
    path = str(tmp_path / "in")
    df = spark.range(0, 5000, 1, 7).select("id", F.concat(F.lit("text "), "id").alias("text"))
    df.write.option("parquet.block.size", 4096).parquet(path)
    numbered = rows.add_row_ids(spark.read.parquet(path), file_order=True)
    assert all(int(row.job_id[3:]) == row.id + 1 for row in numbered.collect())
    plan = numbered.filter("text is not null")._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "hashpartitioning" not in plan


@pytest.mark.parametrize("split", ["1000", "128m"])
@pytest.mark.parametrize("parts", [0, rows.BROADCAST_PARTS])
def test_generated_ids_in_the_order_of_csv_files(spark, tmp_path, monkeypatch, split, parts):
    """Files of unequal size, the last one largest and in another encoding, whole or in many splits."""
    monkeypatch.setattr(rows, "BROADCAST_PARTS", parts)
    wanted = []
    for name, size, encoding in (("a b.csv", 40, "utf-8"), ("b.csv", 0, "utf-8"), ("c.csv", 900, "latin-1")):
        texts = [f"{name} é {i}" for i in range(size)]
        header = "text,n" if name < "c" else "n,text"
        lines = [f"{t},1" if name < "c" else f"1,{t}" for t in texts]
        (tmp_path / name).write_bytes("\n".join([header, *lines, ""]).encode(encoding))
        wanted += texts
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    try:
        df = read_csv(spark, str(tmp_path), places=True)
        numbered = rows.add_row_ids(df, file_order=True)
        found = [r.text for r in sorted(numbered.collect(), key=lambda r: int(r.job_id[3:]))]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert found == wanted and sorted(numbered.columns) == ["job_id", "n", "text"]


def test_offset_continues_the_numbers(spark):
    numbered = rows.add_row_ids(spark.range(30).coalesce(1), order_by=["id"], offset=90)
    assert ids(numbered, "id")[0] == "jd_091"
    assert ids(numbered, "id")[-1] == "jd_120"


def test_one_hot_order_key_is_spread(spark):
    df = spark.range(20000).select((F.col("id") % 1).alias("k"), "id").repartition(5)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        numbered = rows.number_rows(df, "n", "total", order_by=["k"])
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    found = numbered.agg(F.min("n"), F.max("n"), F.countDistinct("n"), F.max("total")).first()
    assert tuple(found) == (1, 20000, 20000, 20000)
    parts = numbered.groupBy(F.spark_partition_id()).count()
    assert parts.count() > 1


def test_ids_are_generated_even_if_a_job_id_exists(spark):
    df = spark.createDataFrame([("x",), ("x",)], "job_id string")
    assert sorted(ids(rows.add_row_ids(df), "job_id")) == ["jd_001", "jd_002"]


def test_existing_ids_become_text(spark):
    assert ids(rows.add_row_ids(spark.range(2), "id"), "id") == ["0", "1"]


def test_empty_table(spark):
    assert rows.add_row_ids(spark.range(0), order_by=["id"]).count() == 0


def test_duplicate_ids(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",), ("a",), (None,)], "job_id string")
    assert rows.duplicate_ids(df).first().duplicate_count == 2
    assert rows.duplicate_ids(df.limit(0)).first().duplicate_count == 0


def test_missing_columns_are_named(spark):
    df = spark.createDataFrame([("a",)], "description string")
    with pytest.raises(ValueError, match="no text column 'text' among .*description"):
        rows.validate_columns(df, "text")
    with pytest.raises(ValueError, match="no id column 'id'"):
        rows.validate_columns(df, "description", "id")
    rows.validate_columns(df, "description", None, "title")


def test_valid_and_skipped_rows(texts):
    df = texts("a", None, " ", "\x1c\xa0", "b").withColumn("job_id", F.col("id").cast("string"))
    assert [r.id for r in rows.valid_rows(df, "text").orderBy("id").collect()] == [1, 5]
    assert [r.job_id for r in rows.skipped_sample(df, "text").collect()] == ["2", "3", "4"]
    assert rows.skipped_rows(df, "text").count() == 3
    assert rows.clean_stats(df, "text").first().asDict() == {
        "total_processed": 2,
        "skipped_null": 1,
        "skipped_empty": 2,
    }


def test_format_results(spark):
    df = spark.createDataFrame([("1", "Engineer", 2)], "job_id string, title string, skill_count int")
    wanted = ["skill_count", "job_title", "nothing", "job_id"]
    assert rows.format_results(df, wanted, "title").collect() == [(2, "Engineer", "1")]
    assert rows.format_results(df, wanted, "no_title").collect() == [(2, "", "1")]
    assert rows.format_results(df, wanted).columns == ["skill_count", "job_title", "job_id"]
    named = df.withColumnRenamed("title", "job_title")
    assert rows.format_results(named, ["job_title"], "job_id").collect() == [("Engineer",)]
