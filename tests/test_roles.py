from gleaner.functions.scalars import normalize_role
from gleaner.operators import roles
from gleaner.plans.extraction import role_tally
from pyspark.sql import functions as F

MAP = [("Boss", "chief", 0), ("Lead", "CHIEF", 1), ("Boss", "head of", 2), ("None", None, 3), (None, "x", 4), ("Void", "", 5)]
RAW = ["Chief", " chief\t", "HEAD OF", "x", "", None, "  ", "other ", "chief"]


def test_a_map_that_is_a_table_is_the_same_as_a_dict(spark, monkeypatch):
    df = spark.createDataFrame(list(enumerate(RAW)), "id long, raw string").withColumn("spelling", F.lit("clash"))
    table = spark.createDataFrame(MAP, "canonical string, spelling string, pos int")
    plain = {"Boss": ["chief", "head of"], "Lead": ["CHIEF"], "Void": [""]}
    wanted = [tuple(r) for r in df.select("id", normalize_role(F.col("raw"), plain)).orderBy("id").collect()]
    for size in (roles.BROADCAST_BYTES, 0):
        monkeypatch.setattr(roles, "BROADCAST_BYTES", size)
        made = roles.with_role(df, "raw", table)
        assert made.columns == ["id", "raw", "spelling", "role"]
        assert [(r.id, r.role) for r in made.orderBy("id").collect()] == wanted
    empty = roles.with_role(df, "raw", table.limit(0)).orderBy("id").collect()
    assert [r.role for r in empty] == ["Chief", "chief", "HEAD OF", "x", "Unknown", "Unknown", "", "other", "chief"]


def test_tally_by_a_table_of_roles(spark):
    df = spark.createDataFrame([("a", ["p"], 1), ("A ", ["p"], 1), (None, [], 0)], "raw string, extracted_skills array<string>, skill_count int")
    table = spark.createDataFrame([("Alpha", "a", 0)], "canonical string, spelling string, pos int")
    found = {(r.role, r.skill): r.docs for r in role_tally(df, "raw", table).collect()}
    assert found[("Alpha", "p")] == 2 and found[("Unknown", None)] == 1
