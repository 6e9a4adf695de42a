"""Connected components of a table of links."""

from __future__ import annotations

from gleaner.llm.tasks import stored
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _stars(links: DataFrame) -> DataFrame:
    """One round of star contraction over links (a, b) with b < a.

    Each node first hands its larger neighbours to its smallest one, then its
    smaller neighbours. Both keep the components and flatten the trees.
    """
    both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m"))
    least = least.select("a", F.least("a", "m").alias("m"))
    large = (
        both.join(least, "a")
        .filter(F.col("b") > F.col("a"))
        .select(F.col("b").alias("a"), F.col("m").alias("b"))
        .distinct()
    )
    least = large.groupBy("a").agg(F.min("b").alias("m"))
    small = large.join(least, "a").select("a", "b", "m")
    return (
        small.select("a", F.col("m").alias("b"))
        .union(small.filter("b != m").select(F.col("b").alias("a"), F.col("m").alias("b")))
        .distinct()
    )


def components(links: DataFrame) -> DataFrame:
    """The nodes of ``links`` (a, b) with the smallest node of their component: (node, component).

    Nodes without links are not returned. Links may repeat, point either way
    or join a node with itself. A round needs two joins on nodes, whose hot
    side adaptive execution can split; the number of rounds is logarithmic.
    """
    current = stored(
        links.filter("a != b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct(),
        "links",
    )
    state = None
    while True:
        before, state = (
            state,
            tuple(
                current.agg(
                    F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
                ).first()
            ),
        )
        if state == before or not state[0]:
            return current.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
                current.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
            )
        current = stored(_stars(current), "links")
