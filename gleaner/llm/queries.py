"""The registered queries of this package, each over its whole tables."""

from __future__ import annotations

from gleaner.llm.hard_negatives import hard_negatives
from gleaner.llm.merkle import manifest
from gleaner.llm.mixing import mixed
from gleaner.llm.packing import pack
from gleaner.llm.personal_data import personal_data
from gleaner.llm.quality_classifier import quality_scores
from gleaner.llm.quality_rules import quality_rules
from gleaner.llm.sharding import shard_digests
from gleaner.llm.simhash import simhash_components
from gleaner.llm.substring_dedup import substring_dedup
from gleaner.llm.suffix_dedup import suffix_dedup
from gleaner.llm.tasks import stored
from gleaner.llm.topk import exact_topk
from gleaner.llm.url_filter import judged
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Target weights of the mixture; other sources have weight 1.
WEIGHTS = {"src0": 6.0, "src1": 1.5, "src2": 1.5, "src3": 0.5}


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def op1_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    return quality_scores(_table(spark, folder, "documents"), _table(spark, folder, "labels"))


def op2_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    return pack(_table(spark, folder, "documents"))


def op3_personal_data(spark: SparkSession, folder: str) -> DataFrame:
    return personal_data(_table(spark, folder, "documents"), ["doc_id"])


def op4_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return quality_rules(_table(spark, folder, "documents"), ["doc_id"])


def op5_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    return judged(_table(spark, folder, "pages"), _table(spark, folder, "labels"))


def op6_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return simhash_components(_table(spark, folder, "documents"))


def op7_exact_topk(spark: SparkSession, folder: str) -> DataFrame:
    vectors = _table(spark, folder, "embeddings")
    return exact_topk(vectors, vectors.filter(F.col("vec_id") % 100 == 0))


def op8_sharding(spark: SparkSession, folder: str) -> DataFrame:
    return shard_digests(_table(spark, folder, "documents"))


def op9_mixing(spark: SparkSession, folder: str) -> DataFrame:
    whole = stored(mixed(_table(spark, folder, "documents"), WEIGHTS), "mixed")
    return whole.select("row.doc_id", "row.source", "rate", "copy", "shuffle_key")


def op10_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return substring_dedup(_table(spark, folder, "documents"))


def op11_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    """Every seventh label is changed first, so that near rows of another label exist."""
    changed = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vectors = _table(spark, folder, "embeddings").withColumn("label", changed)
    return hard_negatives(vectors, vectors.filter(F.col("vec_id") % 100 == 0))


def op12_merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    """Rows are checked with one more character noted, where 7 divides the id's CRC-32."""
    struck = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    noted = F.when(struck, F.col("n_chars") + 1).otherwise(F.col("n_chars"))
    return manifest(_table(spark, folder, "documents"), {"n_chars": noted})


def op13_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return suffix_dedup(_table(spark, folder, "documents"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_quality_classifier,
        op2_best_fit_packing,
        op3_personal_data,
        op4_quality_rules,
        op5_url_filter,
        op6_simhash,
        op7_exact_topk,
        op8_sharding,
        op9_mixing,
        op10_substring_dedup,
        op11_hard_negatives,
        op12_merkle_manifest,
        op13_suffix_dedup,
    )
}
