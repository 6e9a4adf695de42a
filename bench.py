"""Time the headline queries; prints one JSON line.

``$BENCH_SF_DIR`` names the tables, ``$BENCH_CPUS`` the cores.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import threading
import time

from gleaner.functions.cleaning import clean_text
from gleaner.functions.characters import NOT_WORD
from gleaner.operators.extraction import extract_terms
from gleaner.operators.vocabulary import match_vocabulary
from gleaner.plans.catalog import ABBREVIATIONS, QUERIES, documents
from gleaner.session import local_session
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
CPUS = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
PATTERNS = 450
RUNS = 2
#: Seconds for all runs of one query.
LIMIT = 90

HEADLINES = (
    "clean_text",
    "clean_html",
    "expand_abbreviations_words",
    "extract_terms_pattern",
    "extract_terms_lookup",
    "extract_terms_join",
    "extract_large_vocabulary",
    "extract_html",
    "document_frequency",
    "top_terms",
    "dataset_summary",
    "role_term_stats",
    "role_top_terms",
    "global_rules",
    "role_rules",
    "row_ids_generated",
    "extraction_result",
    "extraction_report",
    "stream_extract",
)


def frequent_words(spark: SparkSession) -> DataFrame:
    """A vocabulary of realistic size: the most frequent longer words of the documents."""
    words = F.explode(F.split(F.lower("text"), f"{NOT_WORD}+"))
    counted = documents(spark, FOLDER).select(words.alias("term")).filter(F.length("term") >= 5)
    ranked = counted.groupBy("term").count().orderBy(F.desc("count"), "term").limit(PATTERNS)
    return ranked.select("term", F.lit("custom").alias("category"))


def run(spark: SparkSession, name: str, make) -> float | None:
    """The median of some runs, each planned and computed anew; the first run warms up.

    None if the runs together take longer than the limit; the others go on.
    """
    late = threading.Event()

    def stop() -> None:
        late.set()
        spark.sparkContext.cancelAllJobs()

    times = []
    timer = threading.Timer(LIMIT, stop)
    timer.start()
    try:
        for _ in range(RUNS + 1):
            start = time.perf_counter()
            make().write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - start)
    except Exception as error:
        if not late.is_set():
            raise
        print(f"{name}: stopped after {LIMIT} s ({type(error).__name__})", file=sys.stderr, flush=True)
        return None
    finally:
        timer.cancel()
    taken = statistics.median(times[1:])
    print(f"{name}: {taken:.3f}", file=sys.stderr, flush=True)
    return taken


def main() -> None:
    spark = local_session(CPUS)
    queries = {name: run(spark, name, lambda name=name: QUERIES[name](spark, FOLDER)) for name in HEADLINES}

    # The stages of the reference measurement, over a vocabulary of its size.
    count = documents(spark, FOLDER).count()
    vocabulary = match_vocabulary(spark.createDataFrame(frequent_words(spark).toArrow()))

    def cleaned() -> DataFrame:
        return clean_text(documents(spark, FOLDER), "text", abbreviations=ABBREVIATIONS).select(
            "doc_id", "processed_text"
        )

    def extracted(df: DataFrame) -> DataFrame:
        return extract_terms(df, vocabulary, lowered=True).drop("processed_text")

    stages = {
        "clean": run(spark, "clean", cleaned),
        "end_to_end": run(spark, "end_to_end", lambda: extracted(cleaned())),
    }
    prepared = cleaned().cache()
    prepared.count()
    stages["extract"] = run(spark, "extract", lambda: extracted(prepared))
    prepared.unpersist()
    stages = {name: seconds for name, seconds in stages.items() if seconds}
    queries = {name: seconds for name, seconds in queries.items() if seconds}
    queries |= {f"stage_{name}_{PATTERNS}": seconds for name, seconds in stages.items()}
    print(
        json.dumps(
            {
                "metric": "headline queries, total",
                "value": round(sum(queries.values()), 3),
                "unit": "sec",
                "queries": {name: round(seconds, 3) for name, seconds in queries.items()},
                "sf": FOLDER.rsplit("sf", 1)[-1],
                "cpus": CPUS,
                "documents": count,
                "docs_per_sec": {name: round(count / s) for name, s in stages.items()},
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
