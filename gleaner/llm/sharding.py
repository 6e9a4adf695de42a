"""Sharding by a two-pass external shuffle, with DataFrame functions only."""

from __future__ import annotations

import uuid

from gleaner.llm.tasks import stored
from gleaner.session import shared_folder
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

SHARDS = 8
SEED = 20240229

#: Rows and bytes of one bucket, which is shuffled in the memory of one task.
BUCKET_ROWS = 16_384
BUCKET_BYTES = 32 << 20
#: Hashes of rows with many copies, and the offsets of buckets, are broadcast up to so many.
BROADCAST_HASHES = 100_000
BROADCAST_BUCKETS = 100_000


def _drawn(seed: int, columns: list[str]) -> Column:
    return F.xxhash64(F.lit(seed), *columns)


def _heavy(rows: DataFrame, size: str | None, bucket_rows: int, bucket_bytes: int) -> DataFrame:
    """Hashes of equal rows that together fill an eighth of a bucket: at most sixteen for each bucket."""
    bytes_each = F.col(size) if size else F.lit(0).cast("long")
    equal = rows.select(_hash(rows).alias("hash"), bytes_each.alias("bytes")).groupBy("hash")
    found = equal.agg(F.count("*").alias("n"), F.sum("bytes").alias("bytes"))
    many = (F.col("n") * 8 > bucket_rows) | (F.col("bytes") * 8 > bucket_bytes)
    return stored(found.filter((F.col("n") > 1) & many).select("hash"), "heavy-rows")


def _hash(rows: DataFrame) -> Column:
    return F.xxhash64(F.struct(*rows.columns))


def shuffled(
    rows: DataFrame,
    key: list[str],
    seed: int = SEED,
    size: str | None = None,
    bucket_rows: int = BUCKET_ROWS,
    bucket_bytes: int = BUCKET_BYTES,
) -> DataFrame:
    """All ``rows`` in a random order: their columns and ``position``, gapless from 0.

    First pass: a seeded hash of ``key`` scatters the rows over buckets that
    fit in memory. Second pass: each bucket is put in order and permuted by
    Spark's ``shuffle``, a seeded Fisher-Yates shuffle. Buckets follow one
    another, so a row's position is the rows of earlier buckets and its place.
    Whole rows move once, to the task of their bucket; its rows come out in
    the order of their positions.

    Equal rows cannot be told apart by a hash. Where they would fill much of
    a bucket, they are counted first and scattered one by one. ``size`` names
    a column of bytes for the memory of a bucket.
    """
    columns = rows.columns
    total, volume = rows.agg(
        F.count("*"), F.sum(F.col(size)) if size else F.lit(0).cast("long")
    ).first()
    buckets = max(1, -(-total // bucket_rows), -(-(volume or 0) // bucket_bytes))
    single = rows.select(F.struct(*columns).alias("row"), F.lit(0).cast("long").alias("copy"))
    heavy = _heavy(rows, size, bucket_rows, bucket_bytes)
    if known := heavy.count():
        heavy = F.broadcast(heavy) if known <= BROADCAST_HASHES else heavy
        named = rows.select(_hash(rows).alias("hash"), F.struct(*columns).alias("row"))
        single = named.join(heavy, "hash", "left_anti").select("row", F.lit(0).cast("long").alias("copy"))
        counted = named.join(heavy, "hash", "left_semi").groupBy("row").agg(F.count("*").alias("copies"))
        single = single.unionByName(
            counted.select("row", F.explode(F.sequence(F.lit(1).cast("long"), "copies")).alias("copy"))
        )
    drawn = _drawn(seed, [*(f"row.{c}" for c in key), "copy"])
    scattered = single.select(
        F.pmod(drawn, F.lit(buckets)).cast("int").alias("bucket"),
        F.struct(_drawn(seed + 1, ["row", "copy"]).alias("place"), "copy", "row").alias("record"),
    )
    sizes = stored(scattered.groupBy("bucket").agg(F.count("*").alias("n")), "bucket-sizes")
    before = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    # One bucket, one task: its number is the partition's.
    dealt = scattered.repartitionById(buckets, "bucket")
    gathered = dealt.groupBy("bucket").agg(F.sort_array(F.collect_list("record")).alias("records"))
    # A row for each bucket: broadcast for fewer than some terabytes of rows.
    offsets = F.broadcast(offsets) if buckets <= BROADCAST_BUCKETS else offsets
    # The seed is joined with the partition's number: the order within it must be fixed.
    ordered = gathered.join(offsets, "bucket").sortWithinPartitions("bucket")
    return ordered.select("offset", F.shuffle("records", F.lit(seed)).alias("records")).select(
        "offset", F.posexplode("records").alias("place", "record")
    ).select("record.row.*", (F.col("offset") + F.col("place")).cast("long").alias("position"))


def sharded(
    rows: DataFrame,
    key: list[str],
    shards: int = SHARDS,
    seed: int = SEED,
    size: str | None = None,
) -> DataFrame:
    """``rows`` in random order dealt over ``shards``: ``shard`` and ``slot``, gapless from 0 in each.

    Law ``rows``: position p goes to shard p mod ``shards``, so that the shards'
    row counts are at most one apart. Null values are values like others,
    repeated rows each get their own slot, an empty table gives an empty
    result. The columns may have any names but ``position``, ``shard`` and ``slot``.
    """
    placed = shuffled(rows, key, seed, size)
    return placed.select(
        *rows.columns,
        F.pmod("position", F.lit(shards)).cast("int").alias("shard"),
        F.floor(F.col("position") / shards).cast("long").alias("slot"),
    )


def write_shards(
    docs: DataFrame, path: str, id_column: str = "doc_id", text: str = "text", shards: int = SHARDS, seed: int = SEED
) -> None:
    """All columns of ``docs`` as Parquet, a folder for each shard, in the order of its slots.

    A bucket holds a range of slots of each shard: it is one task and at most
    one file in each folder, so a shard is not gathered in one place.
    """
    whole = docs.select(
        F.struct(*docs.columns).alias("doc"),
        F.col(id_column).alias("id"),
        F.coalesce(F.octet_length(text), F.lit(0)).cast("long").alias("size"),
    )
    dealt = sharded(whole, ["id"], shards, seed, "size")
    dealt.select("shard", "slot", "doc").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)


def shard_digests(
    docs: DataFrame, id_column: str = "doc_id", text: str = "text", shards: int = SHARDS, seed: int = SEED
) -> DataFrame:
    """What each document is and where it went: whole documents are sharded and written, then described as read again.

    (id, size, text_crc32, law, shard, slot, grown_shard): the bytes of the text and one more,
    the unsigned CRC-32 of its UTF-8 bytes; a null text is empty (CRC 0).
    """
    spark = docs.sparkSession
    path = f"{shared_folder(spark).rstrip('/')}/shards-{uuid.uuid4().hex}"
    write_shards(docs, path, id_column, text, shards, seed)
    doc = T.StructField("doc", docs.schema)
    schema = T.StructType([T.StructField("slot", T.LongType()), doc, T.StructField("shard", T.IntegerType())])
    written = spark.read.schema(schema).parquet(path)
    content = F.col("doc").getField(text)
    return written.select(
        F.col("doc").getField(id_column).alias(id_column),
        (F.coalesce(F.octet_length(content), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.coalesce(content, F.lit("")).cast("binary")).alias("text_crc32"),
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
