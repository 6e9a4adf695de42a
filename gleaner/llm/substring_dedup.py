"""Substring dedup: passages that an earlier document has, found by level-wise doubling."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from gleaner.llm.tasks import SLICE_ROWS, bounded_batches, map_rows, stored, without_repeats
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

MIN_WORDS = 50

#: Words whose hashes a task remembers.
KNOWN_WORDS = 250_000
_ODD = (
    (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xFF51AFD7ED558CCD),
    (0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xC4CEB9FE1A85EC53),
)
_HIGH, _LOW = np.uint64(0xFFFFFFFF00000000), np.uint64(0xFFFFFFFF)
#: The first level is the half of a half ... of the length that has at most so many words.
FIRST_LEVEL = 16


class WordHashes(dict):
    """The 64-bit hash of each word, kept for a bounded number of words."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= KNOWN_WORDS:
            self.clear()
        self[word] = made = xxhash.xxh3_64_intdigest(word)
        return made

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def _join(a: np.ndarray, b: np.ndarray, lane: int) -> np.ndarray:
    """Hashes of neighbouring windows made into those of the windows of both."""
    p, q, r = (np.uint64(x) for x in _ODD[lane])
    x = a * p ^ ((b << np.uint64(29)) | (b >> np.uint64(35))) * q
    x ^= x >> np.uint64(32)
    x *= r
    x ^= x >> np.uint64(29)
    return x


def _doubled(h: np.ndarray, length: int, join: Callable) -> np.ndarray:
    """``join`` over all windows of ``length`` neighbours, put together from windows of powers of two."""
    n, made, done, size = len(h), None, 0, 1
    while True:
        if length & size:
            count = n - done - size + 1
            made = h if made is None else join(made[:count], h[done : done + count])
            done += size
        if 2 * size > length:
            return made
        count = n - 2 * size + 1
        h, size = join(h[:count], h[size : size + count]), 2 * size


def window_hashes(words: np.ndarray, length: int, lane: int = 0) -> np.ndarray:
    """A hash of each window of ``length`` words; empty if there are fewer words."""
    if len(words) < length:
        return words[:0]
    return _doubled(words, length, lambda a, b: _join(a, b, lane))


def levels(length: int) -> list[int]:
    """The lengths of the levels below ``length``, each at most twice the one before."""
    made = [(length + 1) // 2]
    while made[0] > FIRST_LEVEL:
        made.insert(0, (made[0] + 1) // 2)
    return made


class Windows:
    """The windows of one text's words and what stands for them at each level.

    A window of ``length`` words is stood for by the shortest gram in it that
    has the least hash (the first of these), and at the next level by that gram
    extended to twice its length: forward, or backward where it would leave the
    window. Equal windows are stood for by equal grams at equal places in them,
    so a window can only repeat if these do, at each level.
    """

    def __init__(self, words: list[bytes], length: int, hashes: WordHashes):
        self.length, self.levels = length, levels(length)
        self.words = hashes.of(words)
        self.count = max(0, len(words) - length + 1)
        self.alive = np.arange(self.count)
        if self.count:
            grams = window_hashes(self.words, self.levels[0])
            key = (grams & _HIGH) | np.arange(len(grams), dtype=np.uint64)
            self.standing = (_least(key, length - self.levels[0] + 1) & _LOW).astype(np.int64)

    def grams(self, level: int) -> np.ndarray:
        """The grams that stand for the windows left, at a level."""
        if not len(self.alive):
            return np.zeros(0, np.uint64)
        size, place = self.levels[level], self.standing[self.alive]
        fits = place + size <= self.alive + self.length
        return window_hashes(self.words, size)[np.where(fits, place, place + self.levels[0] - size)]

    def keep(self, level: int, shared: list[int]) -> None:
        """Only the windows whose gram of a level is among ``shared`` are left."""
        known = np.array(shared, np.int64).view(np.uint64)
        self.alive = self.alive[np.isin(self.grams(level), known)]

    def hashes(self) -> tuple[np.ndarray, np.ndarray]:
        """128 bits of the windows left, each once."""
        second = self.words ^ np.uint64(_ODD[1][2])
        one, two = (
            window_hashes(words, self.length, lane)[self.alive] for lane, words in enumerate((self.words, second))
        )
        one, places = np.unique(one, return_index=True)
        return one, two[places]


def _least(h: np.ndarray, length: int) -> np.ndarray:
    """The least value of each window of ``length`` values."""
    size = 1
    while 2 * size <= length:
        h, size = np.minimum(h[:-size], h[size:]), 2 * size
    rest = length - size
    return np.minimum(h[:-rest], h[rest:]) if rest else h


def _standing(docs: DataFrame, min_words: int) -> DataFrame:
    """Each document's number of words, their digest, and the grams that stand for its windows at the first level."""

    def make():
        hashes = WordHashes()

        def run(texts: list) -> dict[str, list]:
            out: dict[str, list] = {"n_words": [], "digest": [], "content": [], "grams": []}
            for text in texts:
                words = (text or "").encode().split()
                digest = hashlib.sha256(b" ".join(words)).digest()
                out["n_words"].append(len(words))
                out["digest"].append(digest)
                out["content"].append(int.from_bytes(digest[:8], "little", signed=True))
                short = len(words) < min_words
                grams = words[:0] if short else np.unique(Windows(words, min_words, hashes).grams(0)).view(np.int64)
                out["grams"].append(grams)
            return out

        return run

    fields = [
        T.StructField("n_words", T.LongType()),
        T.StructField("digest", T.BinaryType()),
        T.StructField("content", T.LongType()),
        T.StructField("grams", T.ArrayType(T.LongType())),
    ]
    return map_rows(docs, ["id", "key"], ["text"], fields, make)


def _left(words: list[bytes], min_words: int, hashes: WordHashes, shared: tuple) -> Windows:
    windows = Windows(words, min_words, hashes)
    for level, known in enumerate(shared):
        windows.keep(level, known)
    return windows


def _extended(docs: DataFrame, min_words: int, level: int) -> DataFrame:
    """``docs`` with the grams of the next level that stand for what is left of their windows."""

    def make():
        hashes = WordHashes()

        def run(texts: list, *shared: list) -> dict[str, list]:
            left = (_left(t.encode().split(), min_words, hashes, known) for t, *known in zip(texts, *shared, strict=True))
            return {"grams": [np.unique(windows.grams(level)).view(np.int64) for windows in left]}

        return run

    fields = [T.StructField("grams", T.ArrayType(T.LongType()))]
    return map_rows(docs, docs.columns, ["text", *_shared_columns(level)], fields, make)


def _shared_columns(count: int) -> list[str]:
    return [f"shared{level}" for level in range(count)]


def _shared(grams: DataFrame, level: int) -> DataFrame:
    """(doc, shared): the grams that another text has too."""
    rows = grams.select("doc", "content", F.explode("grams").alias("gram"))
    known = rows.groupBy("gram").agg(F.min("content").alias("low"), F.max("content").alias("high"))
    found = rows.select("doc", "gram").join(known.filter("low < high").select("gram"), "gram")
    return found.groupBy("doc").agg(F.collect_list("gram").alias(f"shared{level}"))


def _windows(docs: DataFrame, min_words: int) -> DataFrame:
    """The windows left after all levels, each once for a document: (one, two, id, doc)."""
    bounded_batches(docs.sparkSession)
    names = ["doc", "id", "text", *_shared_columns(len(levels(min_words)))]
    schema = T.StructType.fromDDL("one long, two long, id long, doc long")
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            for start in range(0, batch.num_rows, SLICE_ROWS // 4):
                part = batch.slice(start, SLICE_ROWS // 4)
                out: list[list[np.ndarray]] = [[], [], [], []]
                for doc, own, text, *shared in zip(*(part.column(n).to_pylist() for n in names), strict=True):
                    one, two = _left(text.encode().split(), min_words, hashes, shared).hashes()
                    columns = one.view(np.int64), two.view(np.int64), np.full(len(one), own), np.full(len(one), doc)
                    for column, more in zip(out, columns, strict=True):
                        column.append(more)
                arrays = [pa.array(np.concatenate(column), pa.int64()) for column in out]
                yield pa.RecordBatch.from_arrays(arrays, schema=arrow)

    return docs.select(*names).mapInArrow(run, schema)


def repeated_windows(windows: DataFrame) -> DataFrame:
    """Hashes of the windows that also start in a document with a smaller id: (doc, repeated)."""
    firsts = windows.groupBy("one", "two").agg(F.min("id").alias("least"), F.max("id").alias("most"))
    firsts = firsts.filter("least < most").drop("most")
    found = windows.join(firsts, ["one", "two"]).filter("id > least")
    return found.groupBy("doc").agg(F.collect_list("one").alias("repeated"))


def removed_mask(words: np.ndarray, repeated: list[int], length: int) -> np.ndarray:
    """Which words lie in a window of ``length`` words whose hash is among ``repeated``."""
    marks = np.zeros(len(words) + 1, np.int64)
    repeated = np.array(repeated, np.int64).view(np.uint64)
    starts = np.flatnonzero(np.isin(window_hashes(words, length), repeated))
    marks[starts] += 1
    marks[starts + length] -= 1
    return np.cumsum(marks[:-1]) > 0


def _kept(losing: DataFrame, min_words: int) -> DataFrame:
    """Removed words and the digest of what is kept, of the texts that lose words: (digest, lost, rest)."""

    def make():
        hashes = WordHashes()

        def run(texts: list, repeated: list) -> dict[str, list]:
            out: dict[str, list] = {"lost": [], "rest": []}
            for text, own in zip(texts, repeated, strict=True):
                words = text.encode().split()
                gone = removed_mask(hashes.of(words), own, min_words)
                rest = [w for w, g in zip(words, gone.tolist(), strict=True) if not g]
                out["lost"].append(len(words) - len(rest))
                out["rest"].append(hashlib.sha256(b" ".join(rest)).hexdigest())
            return out

        return run

    fields = [T.StructField("lost", T.LongType()), T.StructField("rest", T.StringType())]
    return map_rows(losing, ["digest"], ["text", "repeated"], fields, make)


def substring_dedup(
    docs: DataFrame, id_column: str = "doc_id", text: str = "text", min_words: int = MIN_WORDS
) -> DataFrame:
    """How many words each document loses and a digest of the rest: (id, n_words, n_removed, kept_sha256).

    A word goes if a window of ``min_words`` words around it, as they stand
    in the input, also starts in a document with a smaller id. Words are runs
    without ASCII white space.

    Level-wise doubling: grams of a quarter of the length (13 words for 50)
    stand for the windows; where two different texts have the same, they are
    extended to twice the length, and again, until the windows themselves are
    compared, by 128 bits. Each level sees only what the level before has left.
    Longer windows could not remove more, so the doubling ends at ``min_words``. A gram or window that stands
    many times in a text is compared once. Texts with equal words are settled
    by their digest: all but the first lose all their words, if they have
    ``min_words``.

    Ids are whole numbers. Null texts have no words, null ids come after all others. Rows that share
    an id do not remove each other's words, whatever their texts; equal rows have equal results.
    Other columns do not matter; an empty table gives an empty result.
    """
    last = F.lit((1 << 63) - 1)
    named = docs.select(
        F.coalesce(F.col(id_column).cast("long"), last).alias("id"),
        F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"),
    ).withColumn("key", F.xxhash64("text"))
    # The label is fixed when the table is written; texts are met again by id and key.
    whole = stored(_standing(named, min_words).withColumn("doc", F.monotonically_increasing_id()), "sequences")
    firsts = whole.groupBy("digest").agg(F.min("id").alias("first"))

    # Of texts with equal words the first one stands for all.
    chosen = whole.select("digest", "content", "id", "key", "doc")
    chosen = chosen.join(firsts.withColumnRenamed("first", "id"), ["digest", "id"], "left_semi")
    chosen = chosen.groupBy("digest", "id", "content").agg(F.min(F.struct("doc", "key")).alias("row"))
    chosen = chosen.select("digest", "id", "content", "row.*")
    texts = without_repeats(named, whole, ["id", "key"])
    left = chosen.join(_shared(whole, 0), "doc").join(texts, ["id", "key"])
    for level in range(1, len(levels(min_words))):
        met = stored(_extended(left, min_words, level), "candidates")
        left = met.join(_shared(met, level), "doc").drop("grams")
    if len(levels(min_words)) == 1:
        met = left = stored(left, "candidates")
    windows = stored(_windows(left, min_words), "windows")
    losing = met.select("doc", "digest", "text").join(repeated_windows(windows), "doc")
    kept = stored(_kept(losing, min_words), "kept")
    empty = F.lit(hashlib.sha256(b"").hexdigest())
    own, copy = F.lower(F.hex("digest")), F.col("id") > F.col("first")
    again = copy & (F.col("n_words") >= min_words)
    return (
        whole.drop("grams")
        .join(firsts.join(kept, "digest", "left"), "digest")
        .select(
            F.nullif(F.col("id"), last).alias(id_column),
            "n_words",
            F.when(again, F.col("n_words")).when(copy, 0).otherwise(F.coalesce("lost", F.lit(0))).cast("long").alias("n_removed"),
            F.when(again, empty).when(copy, own).otherwise(F.coalesce("rest", own)).alias("kept_sha256"),
        )
    )
