"""Hard negatives by exact integer scores: Strassen products of tiles, merged into bounded heaps."""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from gleaner.llm.tasks import stored
from gleaner.llm.topk import quantised
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

POSITIVES, NEGATIVES = 5, 10
#: A negative's score lies between these hundredths of the positive's.
LEAST, MOST = 30, 90
SCALE = 256

#: Anchors and candidates of a tile; a task holds one tile of scores.
ANCHORS = 512
CANDIDATES = 4096
#: Products of this many common components or rows are not halved any more.
LEAF = 16


def _even(tile: np.ndarray) -> np.ndarray:
    """The tile with a row or column of zeros where its sides are odd."""
    rows, columns = tile.shape
    if rows % 2 == columns % 2 == 0:
        return tile
    made = np.zeros((rows + rows % 2, columns + columns % 2), tile.dtype)
    made[:rows, :columns] = tile
    return made


def strassen(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The exact product of two integer tiles: seven products of quarters instead of eight, recursively."""
    rows, columns = a.shape[0], b.shape[1]
    if min(rows, a.shape[1], columns) <= LEAF:
        return a @ b
    a, b = _even(a), _even(b)
    m, k, n = a.shape[0] // 2, a.shape[1] // 2, b.shape[1] // 2
    a11, a12, a21, a22 = a[:m, :k], a[:m, k:], a[m:, :k], a[m:, k:]
    b11, b12, b21, b22 = b[:k, :n], b[:k, n:], b[k:, :n], b[k:, n:]
    made = np.empty((2 * m, 2 * n), a.dtype)
    p = strassen(a11 + a22, b11 + b22)
    made[:m, :n], made[m:, n:] = p, p
    p = strassen(a21 + a22, b11)
    made[m:, :n] = p
    made[m:, n:] -= p
    p = strassen(a11, b12 - b22)
    made[:m, n:] = p
    made[m:, n:] += p
    p = strassen(a22, b21 - b11)
    made[:m, :n] += p
    made[m:, :n] += p
    p = strassen(a11 + a12, b22)
    made[:m, :n] -= p
    made[:m, n:] += p
    made[m:, n:] += strassen(a21 - a11, b11 + b12)
    made[:m, :n] += strassen(a12 - a22, b21 + b22)
    return made[:rows, :columns]


def _matrix(vectors: pa.ListArray, width: int) -> np.ndarray:
    """Integer vectors as rows, padded with zeros."""
    lengths = vectors.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    made = np.zeros((len(vectors), width), np.int64)
    rows = np.repeat(np.arange(len(vectors)), lengths)
    places = np.arange(len(rows)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    made[rows, places] = vectors.flatten().to_numpy(zero_copy_only=False)
    return made


def tile_scores(anchors: pa.ChunkedArray, candidates: pa.ChunkedArray) -> np.ndarray:
    """Inner products of all anchors with all candidates, held to 64 bits.

    Python integers do the work where the sums, or a score times hundred, could pass 64 bits.
    """
    both = [vectors.combine_chunks() for vectors in (anchors, candidates)]
    width = max(1, *(pc.max(vectors.value_lengths()).as_py() or 0 for vectors in both))
    a, b = (_matrix(vectors, width) for vectors in both)
    largest = [max(abs(int(x.max(initial=0))), abs(int(x.min(initial=0)))) for x in (a, b)]
    # Strassen's own sums may go round in 64 bits without harm: only the result must fit.
    if largest[0] * largest[1] * width * 100 >= 1 << 63:
        return np.clip(strassen(a.astype(object), b.astype(object).T), -(1 << 63), (1 << 63) - 1)
    return strassen(a, b.T)


def first(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the ``k`` highest scores, ties to smaller ids, in order: the heap of one tile."""
    return np.array(heapq.nsmallest(k, _reaching(scores, k), key=lambda i: (-scores[i], ids[i])), np.int64)


def _reaching(scores: np.ndarray, k: int) -> list[int]:
    """Places of the scores that are at least the k-th: more than ``k`` only in a tie."""
    if len(scores) <= k:
        return list(range(len(scores)))
    return np.flatnonzero(scores >= np.partition(scores, len(scores) - k)[len(scores) - k]).tolist()


def _deal() -> Column:
    """A number by which whole rows are dealt; with their place, so that rows with one id do not share a block."""
    return F.xxhash64("id", "v", F.monotonically_increasing_id())


def _by_label(df: DataFrame, per_block: int, own: str) -> tuple[DataFrame, DataFrame]:
    """``df`` dealt into blocks (``own``) of about ``per_block`` rows of one label, and each label's number of blocks."""
    count = F.ceil(F.count("*") / per_block).cast("int").alias("blocks")
    counts = df.groupBy("label").agg(count)
    dealt = df.withColumn("deal", _deal()).join(counts, "label")
    return dealt.select("id", "v", "label", F.pmod("deal", "blocks").cast("int").alias(own)), counts


def _in_blocks(df: DataFrame, per_block: int, own: str) -> tuple[DataFrame, int]:
    """``df`` dealt into blocks (``own``) of about ``per_block`` rows, and their number."""
    count = max(1, -(-df.count() // per_block))
    return df.withColumn(own, F.pmod(_deal(), F.lit(count)).cast("int")), count


def _to_each(count: Column) -> Column:
    return F.explode(F.sequence(F.lit(0), count - 1))


def _positives(rows: DataFrame, anchors: DataFrame, k: int) -> DataFrame:
    """(anchor, positive, score): each anchor's ``k`` best other rows of its label."""
    left, left_blocks = _by_label(anchors, ANCHORS, "a")
    right, right_blocks = _by_label(rows, CANDIDATES, "c")
    left = left.join(right_blocks, "label").withColumn("c", _to_each(F.col("blocks"))).drop("blocks")
    right = right.join(left_blocks, "label").withColumn("a", _to_each(F.col("blocks"))).drop("blocks")
    schema = T.StructType.fromDDL("anchor_id long, positive_id long, positive_score long")
    arrow = to_arrow_schema(schema)

    def run(asking: pa.Table, held: pa.Table) -> pa.Table:
        out: list[list] = [[], [], []]
        if asking.num_rows and held.num_rows:
            ids = held.column("id").to_numpy()
            for own, scores in zip(asking.column("id").to_pylist(), tile_scores(asking.column("v"), held.column("v")), strict=True):
                others = np.flatnonzero(ids != own)
                best = others[first(scores[others], ids[others], k)]
                out[0].extend([own] * len(best))
                out[1].extend(ids[best].tolist())
                out[2].extend(scores[best].tolist())
        return pa.Table.from_arrays([pa.array(c, pa.int64()) for c in out], schema=arrow)

    keys = ["label", "a", "c"]
    heaps = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(run, schema)
    return _merged(heaps, ["anchor_id"], "positive_score", "positive_id", k)


def _merged(heaps: DataFrame, keys: list[str], score: str, ident: str, k: int) -> DataFrame:
    """The ``k`` best of all tiles' bounded heaps, with their ``rank``."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc(score), ident))
    return heaps.withColumn("rank", rank).filter(F.col("rank") <= k)


def hard_negatives(
    vectors: DataFrame,
    anchors: DataFrame,
    id_column: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    *,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    least: int = LEAST,
    most: int = MOST,
    scale: int = SCALE,
) -> DataFrame:
    """Rows of another label that score nearly as high as an anchor's positives.

    Returns (anchor_id, positive_id, rank, negative_id, positive_score,
    negative_score). Components are ``floor(scale * x)``, scores exact integer
    inner products; higher scores come first, ties by smaller id. An anchor's
    positives are its first ``positives`` other rows of its label. For each,
    the first ``negatives`` rows of another label whose score lies between
    ``least`` and ``most`` hundredths of the positive's are returned, or all if there are fewer.

    Anchors and rows are dealt into blocks of bounded size; each pair of
    blocks is a tile, whose scores are a Strassen product of 64-bit integers
    (Python integers where 64 bits could not hold them; scores beyond 64 bits
    count as the last value that fits). A tile gives a bounded heap for each anchor,
    then for each anchor and positive; the heaps of all tiles are merged. The
    first round has tiles of one label only, however many rows it has.

    Rows with a null id or label, a null vector or a null or non-finite
    component take no part. Vectors of different lengths meet in their common
    components. "Other" rows have another id; rows that share an id all count
    as candidates, and of anchors that share one the smallest label and vector
    asks. Positives that share an id and score are one. Other columns do not
    matter; an empty table gives an empty result.
    """

    def prepared(df: DataFrame) -> DataFrame:
        made = df.select(
            F.col(id_column).cast("long").alias("id"),
            F.col(label).cast("long").alias("label"),
            quantised(vector, scale).alias("v"),
        )
        return made.filter("id is not null and label is not null and v is not null")

    rows = stored(prepared(vectors), "vectors")
    asking = prepared(anchors).groupBy("id").agg(F.min(F.struct("label", "v")).alias("own")).select("id", "own.*")
    asking = stored(asking, "anchors")
    found = stored(_positives(rows, asking, positives), "positives")
    goals = found.groupBy(F.col("anchor_id").alias("id")).agg(
        F.collect_set(F.struct("positive_id", "positive_score")).alias("positives")
    )
    left, left_blocks = _in_blocks(stored(asking.join(goals, "id"), "goals"), ANCHORS, "a")
    right, right_blocks = _in_blocks(rows, CANDIDATES, "c")
    left = left.withColumn("c", _to_each(F.lit(right_blocks)))
    right = right.withColumn("a", _to_each(F.lit(left_blocks)))
    schema = T.StructType.fromDDL(
        "anchor_id long, positive_id long, negative_id long, positive_score long, negative_score long"
    )
    arrow = to_arrow_schema(schema)

    def run(asked: pa.Table, held: pa.Table) -> pa.Table:
        out: list[list] = [[], [], [], [], []]
        if asked.num_rows and held.num_rows:
            ids, labels = held.column("id").to_numpy(), held.column("label").to_numpy()
            tile = tile_scores(asked.column("v"), held.column("v"))
            given = (asked.column(name).to_pylist() for name in ("id", "label", "positives"))
            for own, kind, goals, scores in zip(*given, tile, strict=True):
                others = np.flatnonzero(labels != kind)
                scores = scores[others]
                hundreds = scores * 100
                for goal in goals:
                    score = goal["positive_score"]
                    near = np.flatnonzero((hundreds >= least * score) & (hundreds <= most * score))
                    best = near[first(scores[near], ids[others[near]], negatives)]
                    out[0].extend([own] * len(best))
                    out[1].extend([goal["positive_id"]] * len(best))
                    out[2].extend(ids[others[best]].tolist())
                    out[3].extend([score] * len(best))
                    out[4].extend(scores[best].tolist())
        return pa.Table.from_arrays([pa.array(c, pa.int64()) for c in out], schema=arrow)

    heaps = left.groupBy("a", "c").cogroup(right.groupBy("a", "c")).applyInArrow(run, schema)
    keys = ["anchor_id", "positive_id", "positive_score"]
    return _merged(heaps, keys, "negative_score", "negative_id", negatives).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"
    )
