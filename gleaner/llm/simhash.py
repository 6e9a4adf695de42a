"""SimHash near-duplicates: fingerprints, and their links by multi-index hashing."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import xxhash
from gleaner.llm.components import components
from gleaner.llm.tasks import map_rows, stored
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SHINGLE = 4
DISTANCE = 4
BITS = 64
SEED = 42

#: From so many fingerprints of one component under one key on, that component is not compared with itself there.
HEAVY = 32
#: Work of one table row compared, in units of one probe row made, moved and sorted.
COMPARED = 0.05


def fingerprint(text: str, shingle: int = SHINGLE) -> int:
    """The 64-bit SimHash: a bit is set if over half of the shingles' hashes have it; no word gives 0."""
    words = text.encode().lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    width = min(shingle, len(words))
    stops = ends[width - 1 :].tolist()
    starts = [0, *(ends[: len(words) - width] + 1).tolist()]
    hashed = xxhash.xxh64_intdigest
    pairs = zip(starts, stops, strict=True)
    hashes = np.fromiter((hashed(joined[a:b], SEED) for a, b in pairs), np.uint64, len(stops))
    ones = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        block = hashes[at : at + (1 << 16)].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(block, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = (2 * ones > len(hashes)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, keep: list[str], text: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """``keep`` and the signed 64-bit ``bits`` of each document's fingerprint; a null text has no words."""

    def make():
        def run(texts: list) -> dict[str, list]:
            made = (fingerprint(t or "", shingle) for t in texts)
            return {"bits": [x - (1 << 64) if x >> 63 else x for x in made]}

        return run

    return map_rows(docs, keep, [text], [T.StructField("bits", T.LongType())], make)


def segments(rows: int, distance: int = DISTANCE, bits: int = BITS) -> list[tuple[int, int, int]]:
    """How to cut fingerprints for ``rows`` of them: (first bit, length, radius) of each segment.

    By the pigeonhole principle, fingerprints that differ in at most
    ``distance`` bits agree up to its radius in one segment at least, if the
    radii plus one sum up to ``distance`` plus one. The number of segments is
    the one with the least probes and rows compared, all results being equal.
    """

    def cut(m: int) -> list[tuple[int, int, int]]:
        radii = [(distance + 1 + i) // m - 1 for i in range(m)][::-1]
        lengths = [(bits + i) // m for i in range(m)]
        starts = np.cumsum([0, *lengths]).tolist()
        return list(zip(starts, lengths, radii, strict=False))

    def cost(parts: list[tuple[int, int, int]]) -> float:
        balls = ((length, sum(comb(length, k) for k in range(radius + 1))) for _, length, radius in parts)
        return sum(ball * (1 + COMPARED * rows / 2.0**length) for length, ball in balls)

    return min((cut(m) for m in range(1, distance + 2)), key=cost)


def masks(length: int, radius: int) -> Iterator[int]:
    """What to flip in a segment to get all values within the radius."""
    for k in range(radius + 1):
        for places in combinations(range(length), k):
            yield sum(1 << p for p in places)


def _key(bits: Column, start: int, length: int) -> Column:
    return F.shiftrightunsigned(bits, start).bitwiseAND(F.lit((1 << length) - 1).cast("long"))


def _tables(points: DataFrame, parts: list[tuple[int, int, int]]) -> DataFrame:
    """Each point once for each segment: (segment, key, bits, component)."""
    keys = [
        F.struct(F.lit(i).alias("segment"), _key(F.col("bits"), start, length).alias("key"))
        for i, (start, length, _) in enumerate(parts)
    ]
    return points.select(F.inline(F.array(*keys)), "bits", "component")


def _probes(points: DataFrame, parts: list[tuple[int, int, int]]) -> DataFrame:
    """Each point once for each key within its segments' radii: (segment, key, probe, probe_component)."""

    def ball(segment: int, start: int, length: int, radius: int) -> Column:
        key = _key(F.col("bits"), start, length)
        flips = F.array(*(F.lit(m).cast("long") for m in masks(length, radius)))
        return F.transform(
            flips, lambda m: F.struct(F.lit(segment).alias("segment"), key.bitwiseXOR(m).alias("key"))
        )

    balls = [ball(i, *part) for i, part in enumerate(parts)]
    return points.select(
        F.inline(F.flatten(F.array(*balls))),
        F.col("bits").alias("probe"),
        F.col("component").alias("probe_component"),
    )


def _near(a: Column, b: Column, distance: int) -> Column:
    return F.bit_count(a.bitwiseXOR(b)) <= distance


def _star_links(points: DataFrame, distance: int) -> DataFrame:
    """Links of fingerprints with a common one, found without comparing all pairs.

    Under keys of all bits but a few, each fingerprint is compared with the
    one there that most documents have.
    """
    block = 16
    blocks = [
        F.struct(F.lit(i).alias("block"), F.col("bits").bitwiseAND(F.lit(_signed(~(((1 << block) - 1) << i)))).alias("key"))
        for i in range(0, BITS, block // 2)
        if i + block <= BITS
    ]
    keyed = points.select(F.inline(F.array(*blocks)), "bits", "documents")
    centre = F.max(F.struct("documents", "bits"))["bits"].alias("centre")
    centres = keyed.groupBy("block", "key").agg(centre, F.count("*").alias("n")).filter("n > 1")
    return (
        keyed.join(centres.drop("n"), ["block", "key"])
        .filter((F.col("bits") != F.col("centre")) & _near(F.col("bits"), F.col("centre"), distance))
        .select(F.col("bits").alias("a"), F.col("centre").alias("b"))
    )


def _signed(x: int) -> int:
    x &= (1 << 64) - 1
    return x - (1 << 64) if x >> 63 else x


def _labelled(points: DataFrame, links: DataFrame) -> DataFrame:
    found = components(links).toDF("bits", "found")
    return points.join(found, "bits", "left").select("bits", F.coalesce("found", "bits").alias("component"))


def fingerprint_components(points: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """The component of each distinct fingerprint: ``points`` (bits, documents) with ``component``.

    Multi-index hashing: a table holds each fingerprint under the value of
    each segment; each fingerprint looks up all values in a small Hamming ball
    around its own and verifies the full distance to what it finds. Large
    groups are joined to a common fingerprint first, and from then on
    fingerprints are only compared with those of other components: a key with
    many fingerprints of one component does not make all their pairs.
    """
    points = stored(_labelled(points, _star_links(points, distance)), "points")
    parts = segments(points.count(), distance)
    table, probes = _tables(points, parts), _probes(points, parts)
    sizes = table.groupBy("segment", "key", "component").agg(F.count("*").alias("n"))
    heavy = stored(sizes.filter(F.col("n") >= HEAVY).drop("n"), "heavy")
    on, own = ["segment", "key"], ["segment", "key", "component"]
    light = probes.join(table.join(heavy, own, "left_anti"), on)
    other = probes.join(heavy, on).filter("component != probe_component").join(table, own)
    columns = ["probe", "probe_component", "bits", "component"]
    found = light.filter("component != probe_component").select(*columns).union(other.select(*columns))
    links = (
        found.filter(_near(F.col("probe"), F.col("bits"), distance))
        .select(F.col("probe_component").alias("a"), F.col("component").alias("b"))
    )
    joined = components(links).toDF("component", "joined")
    return points.join(joined, "component", "left").select(
        "bits", F.coalesce("joined", "component").alias("component")
    )


def simhash_components(
    docs: DataFrame,
    id_column: str = "doc_id",
    text: str = "text",
    shingle: int = SHINGLE,
    distance: int = DISTANCE,
) -> DataFrame:
    """The fingerprint and component of each document: (id, fingerprint, component_id).

    Words are runs without ASCII white space, A-Z lower-cased; a text of fewer
    words than a shingle is one shingle, one without words (or null) has
    fingerprint zero and is linked like any other. Documents whose fingerprints
    differ in at most ``distance`` bits are linked; ``component_id`` is the
    smallest id reachable by links, null only if all ids there are null.
    Repeated rows give repeated result rows, an empty table an empty one;
    other columns do not matter.
    """
    named = docs.select(F.col(id_column).alias("id"), F.col(text).alias("text"))
    printed = stored(fingerprints(named, ["id"], "text", shingle), "fingerprints")
    points = stored(
        printed.groupBy("bits").agg(F.count("*").alias("documents"), F.min("id").alias("least")), "distinct"
    )
    labels = stored(fingerprint_components(points.select("bits", "documents"), distance), "labels")
    least = labels.join(points, "bits").groupBy("component").agg(F.min("least").alias("component_id"))
    known = labels.join(least, "component").select("bits", "component_id")
    return printed.join(known, "bits", "left").select(
        F.col("id").alias(id_column),
        F.lower(F.lpad(F.hex("bits"), 16, "0")).alias("fingerprint"),
        "component_id",
    )
