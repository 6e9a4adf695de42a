"""Quality rules: heuristics of one text, and lines that many documents of a host share."""

from __future__ import annotations

import hashlib
import re
from collections import Counter

import numpy as np
from gleaner.llm.tasks import map_rows, stored
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Fixed values of the contract.
SYMBOLS = "#*$%&|<>"
SEPARATORS = " \t\n\x0b\x0c\r"
WINDOW = 5

#: A text fails with fewer words, or with a larger percentage of repeated ones.
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20

#: A line is boilerplate in more documents of its host than this many and this share.
MIN_DOCUMENTS = 10
MIN_SHARE = 0.005
#: Sketches of two texts differ in at most so many of 256 bits if they are copies: about 92 % of their word pairs are common.
COPY_BITS = 32
#: Copies are sought among documents with at least this percentage of words in frequent lines.
FREQUENT_PERCENT = 50
#: A document is depleted if fewer words, or a smaller percentage of them, are left.
LEFT_WORDS = 5
LEFT_PERCENT = 20

LINES = T.ArrayType(T.StructType([T.StructField("line", T.LongType()), T.StructField("words", T.LongType())]))
STATS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
#: Digits within a word, as in names and codes, tell lines apart; other numbers do not.
_LETTER = rb"[A-Za-z_\x80-\xff]"
_NUMBER = re.compile(rb"(?<!" + _LETTER + rb")(?<![0-9])[0-9]++(?!" + _LETTER + rb")")


def repeated_words(words: list, window: int = WINDOW) -> int:
    """How many words lie in a window of ``window`` words that occurs twice or more."""
    n = len(words)
    if n <= window:
        return 0
    known: dict = {}
    ids = np.fromiter((known.setdefault(w, len(known)) for w in words), np.int64, n)
    if len(known) == n:
        return 0
    code, length = ids, 1
    while length < window:
        step = min(length, window - length)
        pair = code[: n - length - step + 1] * n + code[step : step + n - length - step + 1]
        code, length = np.unique(pair, return_inverse=True)[1], length + step
    starts = np.flatnonzero(np.bincount(code)[code] > 1)
    marks = np.zeros(n + 1, np.int64)
    np.add.at(marks, starts, 1)
    np.add.at(marks, starts + window, -1)
    return int(np.count_nonzero(np.cumsum(marks[:-1])))


def normalised_line(words: list[bytes]) -> bytes:
    """What lines are compared by: lower case, single spaces, any number outside words as 0."""
    return _NUMBER.sub(b"0", b" ".join(words).lower())


def line_hash(words: list[bytes]) -> int:
    digest = hashlib.blake2b(normalised_line(words), digest_size=8).digest()
    return int.from_bytes(digest, "little", signed=True)


def sketch(words: list[bytes]) -> list[int]:
    """A SimHash of 256 bits over the distinct pairs of neighbouring words, as four signed numbers."""
    pairs = list(set(zip(words, words[1:], strict=False)) or {tuple(words)})
    ones = np.zeros(256, np.int64)
    for start in range(0, len(pairs), 4096):
        part = b"".join(hashlib.blake2b(b" ".join(p)).digest()[:32] for p in pairs[start : start + 4096])
        ones += np.unpackbits(np.frombuffer(part, np.uint8).reshape(-1, 32), axis=1).sum(0, dtype=np.int64)
    return np.packbits(2 * ones > len(pairs)).view("<i8").tolist()


def without_lines(text: str, gone: list[int]) -> str:
    """The text without the lines of these hashes."""
    lost = set(gone)
    lines = text.split("\n")
    return "\n".join(x for x in lines if not ((own := x.encode().split()) and line_hash(own) in lost))


def _text_stats() -> object:
    def one(text: str) -> tuple:
        raw = text.encode()
        words = raw.split()
        seen, duplicates, lines = set(), 0, Counter()
        for line in raw.split(b"\n"):
            if own := line.split():
                duplicates += line in seen
                seen.add(line)
                lines[line_hash(own)] += len(own)
        return (
            len(words),
            len(text) - sum(map(text.count, SEPARATORS)),
            sum(raw.count(c) for c in SYMBOLS.encode()),
            duplicates,
            repeated_words(words),
            hashlib.md5(raw).digest(),
            sketch(words),
            [{"line": h, "words": n} for h, n in lines.items()],
        )

    def run(texts: list) -> dict[str, list]:
        made = zip(*(one(t or "") for t in texts), strict=True)
        return dict(zip((*STATS, "digest", "sketch", "lines"), made, strict=True))

    return run


def text_stats(docs: DataFrame, keep: list[str], text: str = "text") -> DataFrame:
    """``keep`` and the statistics of each text, a digest and a sketch of it, and its distinct lines with their words."""
    fields = [T.StructField(c, T.LongType()) for c in STATS]
    fields += [T.StructField("digest", T.BinaryType()), T.StructField("sketch", T.ArrayType(T.LongType()))]
    fields += [T.StructField("lines", LINES)]
    return map_rows(docs, keep, [text], fields, _text_stats)


def boilerplate(
    contents: DataFrame,
    counted: DataFrame,
    min_documents: int = MIN_DOCUMENTS,
    min_share: float = MIN_SHARE,
) -> DataFrame:
    """The lines (host, line) of more than ``min_documents`` documents and ``min_share`` of a host's.

    ``contents`` (host, digest, lines) are distinct documents. ``counted``
    (host, line) has a row for each document and line that counts.
    """
    hosts = contents.groupBy("host").agg(F.count("*").alias("documents"))
    found = counted.groupBy("host", "line").agg(F.count("*").alias("n"))
    return (
        found.filter(F.col("n") > min_documents)
        .join(hosts, "host")
        .filter(F.col("n") > F.col("documents") * min_share)
        .select("host", "line")
    )


def _left(lines: DataFrame, removed: DataFrame) -> DataFrame:
    """Words of each document outside the removed lines."""
    gone = removed.select("host", "line", F.lit(True).alias("gone"))
    rest = F.sum(F.when(F.col("gone"), 0).otherwise(F.col("words")))
    return lines.join(gone, ["host", "line"], "left").groupBy("host", "digest").agg(rest.alias("left"))


def copies(candidates: DataFrame) -> DataFrame:
    """The documents (host, digest) that are copies of another, which comes before them by its digest.

    ``candidates`` (host, digest, sketch) meet where 16 bits of their
    sketches are equal; there each is compared with the first document. The
    first of all is nobody's copy, so that each group keeps a representative.
    """
    band = F.sequence(F.lit(0), F.lit(15))
    value = F.expr("shiftrightunsigned(sketch[int(band / 4)], 16 * (band % 4)) & 65535")
    banded = candidates.select("host", "digest", "sketch", F.explode(band).alias("band"))
    banded = banded.withColumn("bits", value)
    first = banded.groupBy("host", "band", "bits").agg(F.min(F.struct("digest", "sketch")).alias("first"))
    apart = sum(F.bit_count(F.col("sketch")[i].bitwiseXOR(F.col("first.sketch")[i])) for i in range(4))
    near = (F.col("first.digest") < F.col("digest")) & (apart <= COPY_BITS)
    return banded.join(first, ["host", "band", "bits"]).filter(near).select("host", "digest").distinct()


def judged_contents(
    stats: DataFrame,
    min_documents: int = MIN_DOCUMENTS,
    min_share: float = MIN_SHARE,
) -> tuple[DataFrame, DataFrame]:
    """The depleted contents (host, digest), and the boilerplate lines (host, digest, gone) of each content.

    ``stats`` has host, digest, sketch, n_words and lines. A content is
    depleted if removing its host's boilerplate leaves too little. Copies are
    one document: equal texts of a host are counted once, and so are near
    copies, so that they do not make their own lines boilerplate. All
    other documents count, however many of their lines are shared.
    """
    distinct = stats.groupBy("host", "digest").agg(
        F.first("n_words").alias("n_words"), F.first("sketch").alias("sketch"), F.first("lines").alias("lines")
    )
    contents = stored(distinct, "contents")
    lines = contents.select("host", "digest", "n_words", F.inline("lines"))
    frequent = stored(boilerplate(contents, lines, min_documents, min_share), "frequent-lines")
    own = _left(lines, frequent).join(contents.select("host", "digest", "n_words", "sketch"), ["host", "digest"])
    few_own = F.col("left") * 100 <= F.col("n_words") * (100 - FREQUENT_PERCENT)
    copied = copies(stored(own.filter(few_own).select("host", "digest", "sketch"), "copy-candidates"))
    known = lines.join(frequent, ["host", "line"], "left_semi")
    counted = known.join(copied, ["host", "digest"], "left_anti")
    lost = stored(boilerplate(contents, counted, min_documents, min_share), "lost-lines")
    left = _left(lines, lost).join(contents.select("host", "digest", "n_words"), ["host", "digest"])
    few = (F.col("left") < LEFT_WORDS) | (F.col("left") * 100 < F.col("n_words") * LEFT_PERCENT)
    depleted = left.filter((F.col("left") < F.col("n_words")) & few).select("host", "digest")
    gone = lines.join(lost, ["host", "line"], "left_semi").groupBy("host", "digest")
    return depleted, gone.agg(F.collect_set("line").alias("gone"))


def _base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * MAX_REPEAT_PERCENT)


def quality_rules(
    docs: DataFrame, keep: list[str], host: str = "source", text: str = "text"
) -> DataFrame:
    """``keep``, the text statistics, ``base_failed`` and ``kept`` for each document.

    A document fails the base rules with fewer than 10 words, or when over
    20 % of its words lie in five-word windows that repeat in it. Of the
    others those are not kept which are depleted once the lines that many
    documents of their host share are removed (``judged_contents``).

    A null text is an empty one and fails; a null host is a host of its own.
    Repeated rows are judged alike, each with its own result row. Column
    names of ``docs`` other than those given do not matter, and an empty
    table gives an empty result.
    """
    named = docs.select(
        F.struct(*keep).alias("kept_columns"), F.coalesce(host, F.lit("")).alias("host"), F.col(text).alias("text")
    )
    stats = stored(text_stats(named, ["kept_columns", "host"], "text"), "text-stats")
    depleted = judged_contents(stats)[0].withColumn("depleted", F.lit(True))
    failed = _base_failed()
    return (
        stats.drop("lines", "sketch")
        .join(depleted, ["host", "digest"], "left")
        .select(
            "kept_columns.*",
            *STATS,
            failed.alias("base_failed"),
            (~failed & F.col("depleted").isNull()).alias("kept"),
        )
    )


def cleaned(docs: DataFrame, host: str = "source", text: str = "text") -> DataFrame:
    """The documents that the rules keep, their texts without the boilerplate lines of their host."""
    digest = F.unhex(F.md5(F.coalesce(text, F.lit("")).cast("binary"))).alias("digest")
    named = docs.select(
        F.struct(*docs.columns).alias("row"), F.coalesce(host, F.lit("")).alias("host"), F.col(text).alias("text"), digest
    )
    stats = stored(text_stats(named, ["host"], "text"), "text-stats")
    depleted, gone = judged_contents(stats)
    rejected = stats.filter(_base_failed()).select("host", "digest").unionByName(depleted).distinct()
    kept = named.join(rejected, ["host", "digest"], "left_anti").join(gone, ["host", "digest"], "left")

    def make():
        def run(texts: list, lost: list) -> dict[str, list]:
            pairs = zip(texts, lost, strict=True)
            return {"clean": [without_lines(t, own) if t and own else t for t, own in pairs]}

        return run

    made = map_rows(kept, ["row"], ["text", "gone"], [T.StructField("clean", T.StringType())], make)
    return made.select(
        *(F.col("clean").alias(c) if c == text else F.col("row").getField(c).alias(c) for c in docs.columns)
    )
