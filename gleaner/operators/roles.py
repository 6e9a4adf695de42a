"""Roles by a map that is a table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleaner.functions.cleaning import strip
from gleaner.functions.scalars import normalize_role

# Largest map (estimated bytes) that is broadcast; beyond it the join shuffles.
BROADCAST_BYTES = 64 * 1024 * 1024


def keyed_roles(role_map: DataFrame) -> DataFrame:
    """``(spelling, canonical)`` from ``(canonical, spelling, pos)``: lower-cased spellings, each once, the first mapping wins."""
    named = role_map.filter(F.col("spelling").isNotNull() & F.col("canonical").isNotNull())
    return named.groupBy(F.lower("spelling").alias("spelling")).agg(
        F.min_by("canonical", F.struct("pos", "canonical")).alias("canonical")
    )


def with_role(df: DataFrame, role: Column | str, role_map: DataFrame, output: str = "role") -> DataFrame:
    """Add ``output``: the canonical name of each row's role, by a table ``(canonical, spelling, pos)``.

    The same as ``normalize_role`` with a map of any size: a left join, which
    broadcasts the map up to a measured size.  Beyond it, common roles are hot
    keys on the outer side, which adaptive execution splits.
    """
    raw = F.col(role) if isinstance(role, str) else role
    spelled = strip(raw.cast("string"))
    keyed = keyed_roles(role_map).select(
        F.col("spelling").alias("_spelling"), F.col("canonical").alias("_canonical")
    )
    bytes_each = F.octet_length("_spelling") + F.octet_length("_canonical") + 64
    size = keyed.agg(F.coalesce(F.sum(bytes_each), F.lit(0)).alias("bytes")).first().bytes
    keyed = F.broadcast(keyed) if size <= BROADCAST_BYTES else keyed.hint("merge")
    joined = df.withColumn("_spelled", F.lower(spelled)).join(
        keyed, F.col("_spelled") == F.col("_spelling"), "left"
    )
    # Null and empty roles are unknown whatever the map says.
    given = raw.isNotNull() & (raw.cast("string") != "")
    known = F.coalesce(F.when(given, F.col("_canonical")), normalize_role(raw))
    return joined.withColumn(output, known).drop("_spelled", "_spelling", "_canonical")
