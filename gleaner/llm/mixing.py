"""Mixing sources to target weights by Poisson replication."""

from __future__ import annotations

from math import ceil, log, sqrt

from gleaner.llm.tasks import stored
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SEED = 7
#: Ids that rows share are broadcast up to so many.
BROADCAST_IDS = 100_000
#: Sources without a weight of their own.
DEFAULT_WEIGHT = 1.0
#: Rows drawn in all, as a multiple of the rows given.
EPOCHS = 1.0

#: A mean above this is drawn as a sum of equal parts, each inverted exactly.
PART = 32.0
#: Uniform numbers have 52 bits, so that no count beyond this can be drawn for a part.
MOST = ceil(PART + sqrt(2 * 53 * log(2) * PART) + 53 * log(2))


def uniform(*parts: Column) -> Column:
    """A number from [0, 1) with 52 bits, from a hash of the parts."""
    joined = F.concat_ws(":", *(F.coalesce(p.cast("string"), F.lit("null")) for p in parts))
    return F.conv(F.substring(F.md5(joined), 1, 13), 16, 10).cast("long").cast("double") / F.lit(float(1 << 52))


def cumulative(mean: Column) -> Column:
    """The Poisson distribution's sums from 0 on, as far as they are below 1."""
    start = F.struct(F.exp(-mean).alias("term"), F.exp(-mean).alias("total"), F.array(F.exp(-mean)).alias("sums"))

    def step(state: Column, k: Column) -> Column:
        term = state["term"] * mean / k
        total = state["total"] + term
        return F.struct(
            term.alias("term"), total.alias("total"), F.concat(state["sums"], F.array(total)).alias("sums")
        )

    sums = F.aggregate(F.sequence(F.lit(1), F.lit(MOST - 1)), start, step, lambda state: state["sums"])
    return F.filter(sums, lambda total: total < 1)


def poisson(sums: Column, drawn: Column) -> Column:
    """The Poisson count at the quantile ``drawn``: how many of the distribution's sums it reaches."""
    return F.size(F.filter(sums, lambda total: drawn >= total)).cast("long")


def rates(docs: DataFrame, source: str, weights: dict[str, float], default: float, epochs: float) -> DataFrame:
    """The mean repetitions of each source's rows, and their distribution: (source, rate, parts, sums).

    The source's part of the weights, times the rows drawn in all, over its
    rows. Sources that do not occur take no part of the weights. A mean above
    32 is drawn in equal parts; ``sums`` are the cumulative sums of one part.
    """
    sizes = docs.groupBy(F.col(source).alias("source")).agg(F.count("*").alias("rows"))
    given = F.create_map(*(F.lit(x) for pair in weights.items() for x in pair)) if weights else None
    weight = F.coalesce(given[F.col("source")], F.lit(default)) if weights else F.lit(default)
    sizes = stored(sizes.withColumn("weight", weight.cast("double")), "sources")
    whole = sizes.agg(F.sum("rows").alias("all_rows"), F.sum("weight").alias("all_weights"))
    total = whole.first()
    share = F.col("weight") / F.lit(total["all_weights"] or 1.0) * F.lit(float(total["all_rows"] or 0)) * F.lit(epochs)
    parts = F.greatest(F.lit(1), F.ceil(F.col("rate") / PART).cast("int"))
    known = sizes.select("source", (share / F.col("rows")).alias("rate")).withColumn("parts", parts)
    return stored(known.withColumn("sums", cumulative(F.col("rate") / F.col("parts"))), "rates")


def _numbered(docs: DataFrame, id_column: str) -> DataFrame:
    """``row``, the columns of ``docs``, and ``number``: what tells rows of one id apart, null where the id is unique.

    It is a hash of the whole row and a count of its equals.
    """
    name = F.coalesce(F.concat(F.lit("i"), F.col(id_column).cast("string")), F.lit(""))
    packed = docs.select(F.struct(*docs.columns).alias("row"), name.alias("name"))
    single = packed.select("row", F.lit(None).cast("string").alias("number"))
    shared = stored(packed.groupBy("name").agg(F.count("*").alias("n")).filter("n > 1").select("name"), "shared-ids")
    if not (known := shared.count()):
        return single
    shared = F.broadcast(shared) if known <= BROADCAST_IDS else shared
    single = packed.join(shared, "name", "left_anti").select("row", F.lit(None).cast("string").alias("number"))
    equal = packed.join(shared, "name", "left_semi").groupBy("row").agg(F.count("*").alias("n"))
    each = equal.select("row", F.explode(F.sequence(F.lit(1).cast("long"), "n")).alias("k"))
    number = F.concat_ws("-", F.xxhash64("row").cast("string"), F.col("k").cast("string"))
    return single.unionByName(each.select("row", number.alias("number")))


def mixed(
    docs: DataFrame,
    weights: dict[str, float],
    id_column: str = "doc_id",
    source: str = "source",
    default: float = DEFAULT_WEIGHT,
    epochs: float = EPOCHS,
    seed: int = SEED,
) -> DataFrame:
    """``docs`` repeated to the sources' target weights and shuffled: ``row``, ``rate``, ``copy``, ``shuffle_key``.

    Each row is repeated a Poisson number of times, whose mean is its source's
    target repetitions: the quantile is a hash of the seed and the id (and, where
    rows share it, of the row and its number among equal ones), so the
    result does not depend on partitions or on lost executors. A mean above 32
    is drawn as a sum of parts. ``copy`` counts a row's repetitions from 0.
    The rows are dealt out and sorted by ``shuffle_key``, a hash of seed, id
    and copy: a random order over the whole table.

    A null source is a source of its own, a null id is drawn like any other.
    Rows that share an id are drawn and placed one by one. ``row`` holds the
    columns of ``docs``, whatever their names; an empty table gives none.
    """
    packed = _numbered(docs, id_column)
    own = rates(docs, source, weights, default, epochs)
    # A few rows per source: a null-safe lookup whose large side adaptive execution may split.
    keyed = packed.withColumn("key", F.coalesce(F.concat(F.lit("s"), F.col(f"row.{source}")), F.lit("")))
    found = keyed.join(
        own.select(F.coalesce(F.concat(F.lit("s"), "source"), F.lit("")).alias("key"), "rate", "parts", "sums"), "key"
    )
    identity = F.concat_ws(
        ":", F.coalesce(F.col(f"row.{id_column}").cast("string"), F.lit("null")), F.col("number")
    )
    # The quantiles first, each made once, not again for each of the sums.
    quantiles = F.transform(
        F.sequence(F.lit(1), "parts"), lambda part: uniform(F.lit(seed), F.lit("draw"), identity, part)
    )
    draws = F.transform(quantiles, lambda drawn: poisson(F.col("sums"), drawn))
    copies = F.aggregate(draws, F.lit(0).cast("long"), lambda total, x: total + x)
    repeated = found.withColumn("copies", copies).filter("copies > 0")
    repeated = repeated.select(
        "row", "rate", "number", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1)).alias("copy")
    )
    shuffle_key = F.md5(F.concat_ws(":", F.lit(str(seed)), F.lit("place"), identity, "copy"))
    placed = repeated.select("row", "rate", "copy", shuffle_key.alias("shuffle_key"))
    return placed.repartition("shuffle_key").sortWithinPartitions("shuffle_key")
