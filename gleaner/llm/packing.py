"""Packing documents into sequences of bounded length by the sum-of-squares rule."""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from gleaner.llm.tasks import SLICE_ROWS, bounded_batches, stored
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema
from tokenizers import Tokenizer

VOCABULARY = "word_bpe_49k.json"
CAPACITY = 4096
END = 1

#: Words whose ids a worker remembers (those of at most so many characters), and pieces and tokens that are packed together.
KNOWN_WORDS = 1_000_000
KNOWN_LENGTH = 64
GROUP_PIECES = 20_000
GROUP_TOKENS = 8_000_000

#: Symbols that may follow a word and are split from it by the vocabulary's splitter.
TAIL = ".,;:!?&%$#*|"


def byte_characters() -> dict[int, str]:
    """The character that byte-level vocabularies write for each byte: itself if it is printable."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(others)}


class WordIds(dict):
    """The ids of words as little-endian numbers, kept for a bounded number of words of bounded length.

    Of 16 bits (``kind`` <u2), or of 32 (<u4) for a vocabulary of more than 65,536 ids.

    The vocabulary's splitter never joins characters across white space, so
    a text's ids are those of the parts between its blanks, one after the
    other. Words of Latin letters, alone or before symbols, are one piece to
    it and go to its merges directly; all others take the whole way.
    """

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.merges, self.characters = self.tokenizer.model, byte_characters()
        self.kind = "<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4"
        self.letter = "H" if self.kind == "<u2" else "I"

    def __missing__(self, word: str) -> bytes:
        if len(self) >= KNOWN_WORDS:
            self.clear()
        core = word.rstrip(TAIL)
        low = core.lower()
        if not (core.isalpha() and low.isalpha() and len(low) == len(core) and max(core) < "\u0180"):
            made = self.bytes_of(self.tokenizer.encode(word, add_special_tokens=False).ids)
        elif core == word == low:
            letters = low if low.isascii() else "".join(map(self.characters.__getitem__, low.encode()))
            made = self.bytes_of([t.id for t in self.merges.tokenize(letters)])
        else:
            made = self[low] + (self[word[len(core) :]] if word != core else b"")
        if len(word) <= KNOWN_LENGTH:
            self[word] = made
        return made

    def bytes_of(self, ids: list[int]) -> bytes:
        return struct.pack(f"<{len(ids)}{self.letter}", *ids)

    def __call__(self, texts: list[str]) -> list[bytes]:
        return [b"".join(map(self.__getitem__, t.replace("\n", " ").split(" "))) for t in texts]


_KNOWN: dict[str, WordIds] = {}


def words_of_worker(path: str) -> WordIds:
    """What this worker process knows of the vocabulary: loaded once, not again for each of its tasks."""
    if path not in _KNOWN:
        _KNOWN[path] = WordIds(path)
    return _KNOWN[path]


def pieces(
    docs: DataFrame,
    id_column: str,
    text: str,
    capacity: int = CAPACITY,
    end: int = END,
    vocabulary: str = VOCABULARY,
) -> DataFrame:
    """The pieces of each document's ids: (id, piece, start, length, ids), ids as :class:`WordIds` has them."""
    spark = docs.sparkSession
    bounded_batches(spark)
    path = public_tokenizers.path(vocabulary)
    given = docs.select(F.col(id_column).alias("id"), F.col(text).alias("text"))
    schema = T.StructType(
        [
            given.schema["id"],
            *(T.StructField(n, T.LongType()) for n in ("piece", "start", "length")),
            T.StructField("ids", T.BinaryType()),
        ]
    )
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = words_of_worker(path)
        last, width = words.bytes_of([end]), len(words.bytes_of([end]))
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE_ROWS):
                part = batch.slice(at, SLICE_ROWS)
                rows = []
                texts = [t or "" for t in part.column("text").to_pylist()]
                for i, ids in zip(part.column("id").to_pylist(), words(texts), strict=True):
                    ids += last
                    for piece, start in enumerate(range(0, len(ids), width * capacity)):
                        own = ids[start : start + width * capacity]
                        rows.append((i, piece, start // width, len(own) // width, own))
                columns = zip(*rows, strict=True) if rows else [[]] * len(schema)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, f.type) for c, f in zip(columns, arrow, strict=True)], schema=arrow
                )

    return given.mapInArrow(run, schema)


def sum_of_squares(lengths: np.ndarray, capacity: int = CAPACITY) -> tuple[np.ndarray, np.ndarray]:
    """The bin and the place in it of each length, in order.

    Each item goes where the sum of the squared numbers of open bins with
    each gap becomes smallest: into a bin of some gap, or a new one. Ties
    prefer the smaller gap, a new bin last.
    """
    number = np.zeros(capacity + 1, np.int64)  # of open bins with that gap
    open_bins: list[list[int]] = [[] for _ in range(capacity + 1)]
    bins, places, made = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64), 0
    for i, length in enumerate(lengths.tolist()):
        # From a gap g to g - length: (N(g) - 1)^2 - N(g)^2 + (N(g - length) + 1)^2 - N(g - length)^2.
        after = 2 * number[: capacity + 1 - length] + 1
        after[0] = 0  # a full bin is not open
        change = after - 2 * number[length:] + 1
        change[number[length:] == 0] = np.iinfo(np.int64).max
        new = int(after[capacity - length])
        best = int(change.argmin())
        if change[best] <= new:
            gap = best + length
            where = open_bins[gap].pop()
            number[gap] -= 1
        else:
            gap, where, made = capacity, made, made + 1
        bins[i], places[i] = where, capacity - gap
        if left := gap - length:
            open_bins[left].append(where)
            number[left] += 1
    return bins, places


def sequences(
    found: DataFrame,
    capacity: int = CAPACITY,
    group_pieces: int = GROUP_PIECES,
    group_tokens: int = GROUP_TOKENS,
) -> DataFrame:
    """The sequences that ``found`` (id, piece, start, length, ids) is packed into.

    (sequence_id, ids, pieces): the tokens, and what lies in them, each piece with its ``offset``.

    Pieces are dealt by a hash into groups of bounded pieces and tokens,
    whatever their number; each group is packed on its own, longest pieces
    first, so that no more than one group is ever in one task. The hash takes
    in a piece's place in the stored table, so that equal rows are dealt one by one.
    """
    placed = stored(found.withColumn("row", F.monotonically_increasing_id()), "pieces")
    total, tokens = placed.agg(F.count("*"), F.sum("length")).first()
    groups = max(1, -(-total // group_pieces), -(-(tokens or 0) // group_tokens))
    dealt = placed.withColumn("group", F.pmod(F.xxhash64("row"), F.lit(groups)))
    columns = ["id", "piece", "start", "length"]
    piece = T.StructType([found.schema[c] for c in columns] + [T.StructField("offset", T.LongType())])
    schema = T.StructType(
        [
            T.StructField("sequence_id", T.LongType()),
            T.StructField("ids", T.BinaryType()),
            T.StructField("pieces", T.ArrayType(piece)),
        ]
    )
    arrow = to_arrow_schema(schema)

    def run(table: pa.Table) -> pa.Table:
        order = pc.sort_indices(table.select(["length", "row"]), [("length", "descending"), ("row", "ascending")])
        lengths = table.column("length").to_numpy()[order]
        bins, places = sum_of_squares(lengths, capacity)
        # Sequence by sequence, in each by offset.
        lying = np.lexsort((places, bins))
        whole = table.take(pa.array(order.to_numpy()[lying])).combine_chunks()
        bins, places = bins[lying], places[lying]
        starts = np.flatnonzero(np.concatenate([[True], bins[1:] != bins[:-1]]))
        ids = whole.column("ids").to_pylist()
        joined = [b"".join(part) for part in _cut(ids, starts)]
        offsets = pa.array(np.append(starts, len(ids)), pa.int32())
        fields = [whole.column(c).combine_chunks() for c in columns] + [pa.array(places)]
        lists = pa.ListArray.from_arrays(offsets, pa.StructArray.from_arrays(fields, names=[*columns, "offset"]))
        numbers = pa.array(bins[starts] * groups + table.column("group")[0].as_py())
        made = pa.table([numbers, pa.array(joined, pa.binary()), lists], names=["sequence_id", "ids", "pieces"])
        return made.cast(arrow)

    return dealt.groupBy("group").applyInArrow(run, schema)


def _cut(values: list, starts: np.ndarray) -> Iterator[list]:
    ends = [*starts[1:].tolist(), len(values)]
    for a, b in zip(starts.tolist(), ends, strict=True):
        yield values[a:b]


def pack_sequences(
    docs: DataFrame, id_column: str = "doc_id", text: str = "text", capacity: int = CAPACITY
) -> DataFrame:
    """All documents packed into sequences of at most ``capacity`` tokens: (sequence_id, ids, pieces).

    A document is its ids and an end mark; only longer ones are cut, into full
    pieces and a rest. ``ids`` are a sequence's tokens (little-endian, of 16 bits for
    a vocabulary of at most 65,536 ids, else of 32), ``pieces`` what they are:
    (id, piece, start, length, offset), gapless from offset 0.

    A null text is empty: one piece with the end mark alone. Repeated rows
    and rows that share an id are packed each on its own; other columns do
    not matter; an empty table gives an empty result.
    """
    return sequences(pieces(docs, id_column, text, capacity), capacity)


def described(written: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """One row for each piece of sequences: (id, piece, start, length, ids_crc32, sequence_id, offset).

    ``ids_crc32`` is that of the tokens at its place, as 32-bit numbers.
    """
    piece = written.schema["pieces"].dataType.elementType
    bounded_batches(written.sparkSession)
    schema = T.StructType(
        [
            T.StructField(id_column, piece["id"].dataType),
            *(T.StructField(n, T.LongType()) for n in ("piece", "start", "length", "ids_crc32", "sequence_id", "offset")),
        ]
    )
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for number, ids, own in zip(*(batch.column(c).to_pylist() for c in ("sequence_id", "ids", "pieces")), strict=True):
                total = sum(p["length"] for p in own)
                tokens = np.frombuffer(ids, f"<u{len(ids) // total}").astype("<u4")
                for p in own:
                    part = tokens[p["offset"] : p["offset"] + p["length"]]
                    rows.append((p["id"], p["piece"], p["start"], p["length"], zlib.crc32(part), number, p["offset"]))
            columns = zip(*rows, strict=True) if rows else [[]] * len(schema)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(columns, arrow, strict=True)], schema=arrow
            )

    return written.mapInArrow(run, schema)


def pack(
    docs: DataFrame, id_column: str = "doc_id", text: str = "text", capacity: int = CAPACITY
) -> DataFrame:
    """All documents as pieces of sequences, which are written, and described as read again.

    See :func:`pack_sequences` for the sequences and :func:`described` for the rows.
    """
    return described(stored(pack_sequences(docs, id_column, text, capacity), "sequences"), id_column)
