"""Exact top-k by inner product: term-at-a-time accumulation over blocks of postings."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from gleaner.llm.tasks import stored
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

K = 10
SCALE = 1024

#: Candidates and queries of a block; a task holds one block of each.
CANDIDATES = 8192
QUERIES = 1024
#: Queries whose dense scores are held at once.
ROWS = 64

LEAST, MOST = -(1 << 63), (1 << 63) - 1


def quantised(vector: str, scale: int = SCALE) -> Column:
    """floor(scale * x) of each component; null for vectors that take no part."""
    components = F.transform(F.col(vector), lambda x: x.cast("double"))
    fine = F.forall(components, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.when(F.coalesce(fine, F.lit(False)), F.transform(components, lambda x: F.floor(x * scale)))


def _postings(vectors: pa.ListArray) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each term (a component's place), the rows that have it and their weights."""
    lengths = vectors.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    weights = vectors.flatten().to_numpy(zero_copy_only=False)
    rows = np.repeat(np.arange(len(vectors)), lengths)
    terms = np.arange(len(rows)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    there = weights != 0
    rows, terms, weights = rows[there], terms[there], weights[there]
    order = np.argsort(terms, kind="stable")
    cuts = np.searchsorted(terms[order], np.arange(int(lengths.max(initial=0)) + 1))
    return [(rows[order[a:b]], weights[order[a:b]]) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]


def _largest(postings: list[tuple[np.ndarray, np.ndarray]]) -> int:
    return max((max(abs(int(w.max())), abs(int(w.min()))) for _, w in postings if len(w)), default=0)


def scores(queries: pa.ListArray, postings: list, count: int, exact: bool) -> np.ndarray:
    """Dense scores of all queries and ``count`` candidates, gathered term by term."""
    kind = object if exact else np.int64
    made = np.zeros((len(queries), count), kind)
    for (asking, weights), (rows, held) in zip(_postings(queries), postings, strict=False):
        if len(asking) and len(rows):
            added = np.multiply.outer(weights.astype(kind), held.astype(kind))
            if len(rows) == count:
                made[asking] += added
            else:
                made[np.ix_(asking, rows)] += added
    return made


def best(row: np.ndarray, ids: np.ndarray, own: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids and scores of the k largest scores, ties to smaller ids, without the query's own."""
    others = np.flatnonzero(ids != own)
    row, ids = row[others], ids[others]
    if len(row) > k:  # all that reach the k-th score stay, so that ties are settled by id
        among = np.flatnonzero(row >= np.partition(row, len(row) - k)[len(row) - k])
        row, ids = row[among], ids[among]
    order = np.lexsort((ids, ~row))[:k]
    return ids[order], row[order]


def exact_topk(
    vectors: DataFrame,
    queries: DataFrame,
    id_column: str = "vec_id",
    vector: str = "embedding",
    k: int = K,
    scale: int = SCALE,
) -> DataFrame:
    """The ``k`` rows of ``vectors`` with the highest inner product for each of ``queries``.

    Returns (query_id, rank, id, score). Components are ``floor(scale * x)``;
    the score is their integer product sum, exact; components and scores beyond
    64 bits are held to its limits. Ties go to the smaller id; a query's own id is no candidate. Fewer
    than ``k`` candidates are all returned.

    Queries and candidates are dealt into blocks of bounded size; each pair
    of blocks is one group: the candidates become posting lists, and each
    term's postings are scattered, times the query's weight, into dense score
    rows, of which the k largest are selected and merged. The rows of a block
    go to as many groups as the other side has blocks.

    Vectors that are null or hold a null or non-finite component, and rows
    without an id, take no part. Vectors of different lengths meet in their
    common components; an empty one scores zero. Of query rows that share an
    id the smallest vector asks; candidate rows that share an id all count.
    Other columns do not matter; an empty table gives an empty result.
    """
    def prepared(df: DataFrame) -> DataFrame:
        made = df.select(F.col(id_column).cast("long").alias("id"), quantised(vector, scale).alias("v"))
        return made.filter("id is not null and v is not null")

    rows = stored(prepared(vectors), "vectors")
    asked = prepared(queries).groupBy("id").agg(F.min("v").alias("v"))
    asked = stored(asked, "queries")
    n_rows, n_asked = rows.count(), asked.count()
    row_blocks, asked_blocks = max(1, -(-n_rows // CANDIDATES)), max(1, -(-n_asked // QUERIES))

    def block(count: int) -> Column:
        # Whole rows and their place, so that rows with one id do not share a block.
        return F.pmod(F.xxhash64("id", "v", F.monotonically_increasing_id()), F.lit(count)).cast("int")

    def all_blocks(count: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(count - 1)))

    left = rows.select("id", "v", block(row_blocks).alias("r")).select("*", all_blocks(asked_blocks).alias("q"))
    right = asked.select("id", "v", block(asked_blocks).alias("q")).select("*", all_blocks(row_blocks).alias("r"))
    schema = T.StructType([T.StructField(c, T.LongType()) for c in ("query_id", "id", "score")])
    arrow = to_arrow_schema(schema)

    def run(candidates: pa.Table, asking: pa.Table) -> pa.Table:
        ids, query_ids = candidates.column("id").to_numpy(), asking.column("id").to_pylist()
        held, query_vectors = (table.column("v").combine_chunks() for table in (candidates, asking))
        postings = _postings(held) if len(ids) else []
        top = _largest(postings) * _largest(_postings(query_vectors)) * max(1, len(postings))
        found: list[list[np.ndarray]] = [[], [], []]
        for at in range(0, len(query_ids) if len(ids) else 0, ROWS):
            part = scores(query_vectors.slice(at, ROWS), postings, len(ids), top > MOST)
            part = np.clip(part, LEAST, MOST).astype(np.int64) if top > MOST else part
            for own, row in zip(query_ids[at : at + ROWS], part, strict=True):
                near, values = best(row, ids, own, k)
                found[0].append(np.full(len(near), own))
                found[1].append(near)
                found[2].append(values)
        columns = [np.concatenate(c) if c else np.zeros(0, np.int64) for c in found]
        return pa.Table.from_arrays([pa.array(c, pa.int64()) for c in columns], schema=arrow)

    found = left.groupBy("r", "q").cogroup(right.groupBy("r", "q")).applyInArrow(run, schema)
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "id"))
    return (
        found.withColumn("rank", rank)
        .filter(F.col("rank") <= k)
        .select("query_id", "rank", F.col("id").alias(id_column), "score")
    )
