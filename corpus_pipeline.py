"""A training corpus from raw documents: rules, near duplicates, personal data, mixture, sequences."""

from __future__ import annotations

from gleaner.llm.mixing import mixed
from gleaner.llm.packing import pack
from gleaner.llm.personal_data import redact
from gleaner.llm.quality_rules import cleaned
from gleaner.llm.queries import WEIGHTS
from gleaner.llm.simhash import simhash_components
from gleaner.llm.tasks import stored
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def drop_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep, without their host's boilerplate lines; ``n_chars`` follows."""
    clean = cleaned(docs)
    changed = F.length("text").cast(clean.schema["n_chars"].dataType)
    return clean.withColumn("n_chars", F.when(F.col("n_chars").isNotNull(), changed))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component: that with its smallest id.

    Rows without an id come last. Of rows that share id and text the smallest one
    stays, so that of repeated rows there is one left.
    """
    known = F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), F.coalesce("text", F.lit("")))
    keyed = docs.select(
        F.struct(*docs.columns).alias("row"),
        F.md5(known.cast("binary")).alias("key"),
        F.col("text").alias("text"),
        F.struct(F.col("doc_id").isNull().alias("late"), F.col("doc_id").alias("id")).alias("order"),
    )
    named = keyed.select(F.struct("order", "key").alias("id"), "text")
    found = simhash_components(named, "id")
    first = found.filter("id = component_id").select("id.key").distinct()
    chosen = keyed.select("key", "row").join(first, "key", "left_semi")
    return chosen.groupBy("key").agg(F.min("row").alias("row")).select("row.*")


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data in their texts replaced by its kind; ``n_chars`` follows."""
    clean = redact(docs, "text")
    changed = F.length("text").cast(clean.schema["n_chars"].dataType)
    return clean.withColumn("n_chars", F.when(F.col("n_chars").isNotNull(), changed))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated to the sources' target weights, in shuffled order."""
    return mixed(docs, WEIGHTS).select("row.*")


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token sequences of all documents, written, and the pieces and places that they hold.

    A repeated document is packed each time.
    """
    return pack(docs)


STAGES = [
    ("quality rules", drop_low_quality),
    ("near duplicates", drop_near_duplicates),
    ("personal data", redact_personal_data),
    ("source mixture", mix_sources),
    ("packing", pack_sequences),
]

#: Tokenizers and fingerprints are beyond SQL: tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder; each stage's result is written and read again."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
