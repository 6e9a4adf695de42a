"""Term extraction over a table of documents.

Three plans give the same result:

* ``pattern``: the vocabulary becomes one regular expression inside the
  projection.  The fastest, for vocabularies that one pattern can hold.
* ``lookup``: the vocabulary becomes one hash table inside the projection.
  Terms of any length and any number up to a checked size.
* ``join``: the vocabulary stays a table and meets the words of the documents
  in an equi-join.  For any larger vocabulary.

The first two need no shuffle and work on streams.  All three take time in
proportion to the text.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleaner.functions.characters import NOT_WORD, RUNS, WORD
from gleaner.functions.matching import find_terms, nesting

# Largest vocabulary kept as one literal pattern: terms, their characters together, and how deep
# terms with common beginnings nest. The length of a single term does not matter.
PATTERN_TERMS = 20_000
PATTERN_CHARS = 600_000
PATTERN_DEPTH = 200
# Largest vocabulary (estimated bytes) kept as a hash table in the projection; beyond it, a join.
LOOKUP_BYTES = 16 * 1024 * 1024
# Largest vocabulary (estimated bytes) that a join broadcasts; beyond it the join shuffles.
BROADCAST_BYTES = 64 * 1024 * 1024
# Common words are hot keys of the shuffled join, so each entry is copied to several parts:
# as many as these bytes allow for all copies together, between the two limits.
COPIES_BYTES = 2 * 1024 * 1024 * 1024
SALTS = (4, 32)
# A pattern of more runs is found by a window of this length.
WINDOW = 3
# Hits of a text that are walked at once.
BLOCK = 512

ENTRY = "struct<key:string,offset:int,runs:int,pattern:string,canonical:string,opens:boolean,ends:boolean>"


def vocabulary_bytes(vocabulary: DataFrame) -> int:
    """About what a vocabulary takes in memory."""
    size = F.octet_length("pattern") + F.octet_length("canonical") + 64
    return vocabulary.agg(F.coalesce(F.sum(size), F.lit(0)).alias("bytes")).first().bytes


def collect_vocabulary(vocabulary: DataFrame) -> dict[str, str] | None:
    """The vocabulary as a dict if it is small enough for one pattern, else None."""
    rows = vocabulary.select("pattern", "canonical").limit(PATTERN_TERMS + 1).collect()
    patterns = [row.pattern for row in rows]
    if len(rows) > PATTERN_TERMS or sum(map(len, patterns)) > PATTERN_CHARS or nesting(patterns) > PATTERN_DEPTH:
        return None
    return {row.pattern: row.canonical for row in rows}


def extract_terms(
    df: DataFrame,
    vocabulary: DataFrame | dict[str, str],
    text_column: str = "processed_text",
    *,
    case_sensitive: bool = False,
    remove_duplicates: bool = True,
    lowered: bool = False,
    matcher: str = "auto",
    made_from: str | None = None,
) -> DataFrame:
    """Add ``extracted_skills`` (terms in order of appearance) and ``skill_count``.

    Matches are whole-word, non-overlapping, leftmost and longest first.
    ``vocabulary`` is a ``(pattern, canonical)`` table, or a dict of the same.
    ``matcher`` is ``pattern``, ``lookup``, ``join``, or ``auto`` for the first
    of these that can hold the vocabulary.
    ``made_from`` names the column the text was made from, if any: rows equal
    there have equal texts, and a join need not make the texts once more to
    tell that.
    """
    text = F.col(text_column) if case_sensitive or lowered else F.lower(text_column)
    small = None if isinstance(vocabulary, DataFrame) else vocabulary
    if small is None and matcher in ("auto", "pattern"):
        small = collect_vocabulary(vocabulary)
        if matcher == "pattern" and small is None:
            raise ValueError("the vocabulary is too large for one pattern")
    if small is not None:
        found = find_terms(text, small, remove_duplicates=remove_duplicates, lowered=True)
        df = df.withColumn("extracted_skills", found)
    else:
        size = vocabulary_bytes(vocabulary)
        if matcher == "lookup" and size > LOOKUP_BYTES:
            raise ValueError("the vocabulary is too large for a lookup")
        if matcher != "join" and size <= LOOKUP_BYTES:
            found = _look_up(text, vocabulary, remove_duplicates)
            df = df.withColumn("extracted_skills", found)
        else:
            df = _extract_by_join(df, text, vocabulary, size, made_from or text_column, remove_duplicates)
    return df.withColumn("skill_count", F.size("extracted_skills"))


# Vocabulary -----------------------------------------------------------------


def _runs(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(RUNS), F.lit(0))


def _window(runs: Column, place: Column, length: int) -> Column:
    """``length`` neighbouring runs as one text; null where there are fewer."""
    parts = [F.get(runs, place + i) for i in range(length)]
    return parts[0] if length == 1 else F.concat(*parts)


def _keyed_patterns(vocabulary: DataFrame) -> DataFrame:
    """``(key, length, wordlike, offset, runs, pattern, canonical, opens, ends)``.

    A whole-word match is a sequence of whole runs (of word or of other
    characters).  The key of a pattern of up to three runs is the pattern
    itself.  A longer one is found by two of its words and what stands between
    them: those that the fewest patterns have.  ``length`` is the number of
    runs in the key, ``wordlike`` whether it begins with a word, ``offset`` how
    many runs stand before it.
    """
    whole = vocabulary.select("pattern", "canonical", _runs(F.col("pattern")).alias("parts"))
    begins = F.get("parts", F.lit(0)).rlike(f"^{WORD}")
    whole = whole.filter(F.size("parts") > 0).select(
        "pattern",
        "canonical",
        "parts",
        F.size("parts").alias("runs"),
        (~begins).alias("opens"),
        (~F.get("parts", F.size("parts") - 1).rlike(f"^{WORD}")).alias("ends"),
    )
    fields = ["offset", "runs", "pattern", "canonical", "opens", "ends"]
    short = whole.filter(F.col("runs") <= WINDOW).select(
        F.col("pattern").alias("key"),
        F.col("runs").alias("length"),
        (~F.col("opens")).alias("wordlike"),
        F.lit(0).alias("offset"),
        *fields[1:],
    )
    long = whole.filter(F.col("runs") > WINDOW)
    places = F.sequence(F.col("opens").cast("int"), F.col("runs") - WINDOW, F.lit(2))
    windows = long.select("pattern", F.explode(places).alias("offset"), "parts").select(
        "pattern", "offset", _window(F.col("parts"), F.col("offset"), WINDOW).alias("key")
    )
    spread = windows.groupBy("key").agg(F.count("*").alias("patterns"))
    rarest = windows.join(spread, "key").groupBy("pattern").agg(
        F.min(F.struct("patterns", "offset", "key")).alias("rarest")
    )
    anchored = long.join(rarest, "pattern").select(
        "rarest.key", F.lit(WINDOW).alias("length"), F.lit(True).alias("wordlike"), "rarest.offset", *fields[1:]
    )
    return short.unionByName(anchored)


def _keys(runs: Column, kinds: list, made: Callable[[Column, Column], Column]) -> list[Column]:
    """For each kind of key, ``made(place, key)`` of the windows of a text's runs that can be one.

    ``kinds`` lists ``(length, wordlike)``. Runs of words and of other characters take turns.
    """

    def of_kind(length: int, wordlike: bool) -> Column:
        begins = F.coalesce(F.get(runs, F.lit(0)).rlike(f"^{WORD}"), F.lit(True))
        first = F.when(begins == F.lit(wordlike), 0).otherwise(1)
        last = F.size(runs) - length
        places = F.when(first <= last, F.sequence(first, last, F.lit(2)))
        places = F.coalesce(places, F.array().cast("array<int>"))
        return F.transform(places, lambda place: made(place, _window(runs, place, length)))

    return [of_kind(*kind) for kind in kinds]


def _within_edges(entry: Column, start: Column, total: Column) -> Column:
    """Symbols at an edge of a pattern need a word character next to them; no pattern begins before the text."""
    after = start + entry["runs"] < total
    return (start >= 0) & (~entry["opens"] | (start > 0)) & (~entry["ends"] | after)


def _stands(pattern: Column, start: Column, length: Column, runs: Column) -> Column:
    return F.array_join(F.slice(runs, start + 1, length), "") == pattern


def _hit(entry: Column, start: Column) -> Column:
    """Ordered by place, and at one place the longest first."""
    return F.struct(
        start.alias("start"), (-entry["runs"]).alias("shorter"), entry["canonical"].alias("canonical")
    )


def _bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)``, with ``value`` computed once however often it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _terms(hits: Column, words_only: bool, remove_duplicates: bool) -> Column:
    """The terms of the hits that stand, in order of appearance; single words cannot overlap."""
    hits = F.array_sort(hits)
    found = F.transform(hits if words_only else _without_overlaps(hits), lambda hit: hit["canonical"])
    return F.array_distinct(found) if remove_duplicates else found


def _without_overlaps(hits: Column) -> Column:
    """The hits that begin where the ones kept before them have ended.

    One pass over the hits, which notes in a string which ones to keep: the
    state of an aggregate is copied at each step, so it must stay small.  For
    the same reason the hits are walked in blocks.
    """

    def walk(state: Column, hit: Column) -> Column:
        stands = hit["start"] >= state["end"]
        end = F.when(stands, hit["start"] - hit["shorter"]).otherwise(state["end"])
        return F.struct(end.alias("end"), F.concat(state["kept"], F.when(stands, "1").otherwise("0")).alias("kept"))

    def walk_block(state: Column, block: Column) -> Column:
        start = F.struct(state["end"], F.lit("").alias("kept"))
        return F.aggregate(
            block, start, walk, lambda own: F.struct(own["end"], F.concat(state["kept"], own["kept"]).alias("kept"))
        )

    def standing(hits: Column) -> Column:
        places = F.when(F.size(hits) > 0, F.sequence(F.lit(0), F.size(hits) - 1, F.lit(BLOCK)))
        blocks = F.transform(places, lambda at: F.slice(hits, at + 1, BLOCK))
        start = F.struct(F.lit(0).alias("end"), F.lit("").alias("kept"))
        kept = F.split(F.aggregate(blocks, start, walk_block, lambda state: state["kept"]), "")
        return _bound(kept, lambda kept: F.filter(hits, lambda hit, i: F.get(kept, i) == "1"))

    return _bound(hits, standing)


# Plans ----------------------------------------------------------------------


def _look_up(text: Column, vocabulary: DataFrame, remove_duplicates: bool) -> Column:
    """Terms found through a hash table of the vocabulary, which is a literal of the projection.

    Each window of a text that can be a key reads one bucket of the table.
    """
    keyed = _keyed_patterns(vocabulary)
    rows = keyed.withColumn("slot", F.xxhash64("key")).collect()
    nothing = F.array().cast("array<string>")
    if not rows:
        return nothing
    count = 2 * len(rows)
    buckets: list[list[dict]] = [[] for _ in range(count)]
    for row in rows:
        buckets[row.slot % count].append(row.asDict())
    table = F.from_json(F.lit(json.dumps(buckets)), f"array<array<{ENTRY}>>")
    long = any(row.runs > WINDOW for row in rows)

    def found(runs: Column) -> Column:
        def here(place: Column, key: Column) -> Column:
            bucket = F.get(table, F.pmod(F.xxhash64(key), F.lit(count)).cast("int"))

            def fits(entry: Column) -> Column:
                start = place - entry["offset"]
                same = (entry["key"] == key) & _within_edges(entry, start, F.size(runs))
                if long:
                    whole = _stands(entry["pattern"], start, entry["runs"], runs)
                    same = same & ((entry["runs"] <= WINDOW) | whole)
                return same

            return F.transform(F.filter(bucket, fits), lambda entry: _hit(entry, place - entry["offset"]))

        kinds = sorted({(row.length, row.wordlike) for row in rows})
        return F.concat(*(F.flatten(hits) for hits in _keys(runs, kinds, here)))

    hits = _bound(_runs(text), found)
    return F.coalesce(_terms(hits, all(row.runs == 1 for row in rows), remove_duplicates), nothing)


def _extract_by_join(
    df: DataFrame,
    text: Column,
    vocabulary: DataFrame,
    size: int,
    key_column: str,
    remove_duplicates: bool,
) -> DataFrame:
    """Match by joining windows of the texts with the keys of the patterns.

    Documents are keyed by a digest: copies are matched together, and
    duplicate ids do no harm.  Only patterns longer than their key are compared
    with the text itself, where they have been found.
    """
    # Never null, so that the join does not test it for null (and make the key twice for that).
    keyed = df.withColumn("_digest", F.coalesce(F.md5(F.col(key_column).cast("string")), F.lit("")))
    terms = _keyed_patterns(vocabulary)
    shape = terms.agg(
        F.collect_set(F.struct("length", "wordlike")).alias("kinds"),
        F.coalesce(F.max("runs"), F.lit(0)).alias("runs"),
    ).first()
    kinds = sorted((kind.length, kind.wordlike) for kind in shape.kinds)
    nothing = F.array().cast("array<string>")
    if not kinds:
        return keyed.withColumn("extracted_skills", nothing).drop("_digest")
    long = shape.runs > WINDOW
    candidates = _joined(_places(keyed, text, kinds), terms, size)
    # One set per text, combined before the shuffle: copies of a text add nothing to it.
    rest = F.when(F.col("runs") > WINDOW, F.col("pattern")) if long else F.lit(None).cast("string")
    per_text = candidates.select(
        "_digest", F.struct("start", (-F.col("runs")).alias("shorter"), "canonical", rest.alias("rest")).alias("hit")
    )
    per_text = per_text.groupBy("_digest").agg(F.collect_set("hit").alias("_hits"))
    # Many copies of one text make one hot key here.  It sits on the outer side, where the skew
    # join of adaptive execution splits it, provided that both sides are shuffled for this join:
    # the second key, though it adds nothing, keeps the partitioning by text from being reused.
    shard = F.substring("_digest", 1, 1)
    joined = keyed.withColumn("_shard", shard).join(
        per_text.withColumn("_shard", shard), ["_digest", "_shard"], "left"
    )
    hits = F.col("_hits")
    if long:

        def confirmed(runs: Column) -> Column:
            return F.filter(
                hits, lambda hit: hit["rest"].isNull() | _stands(hit["rest"], hit["start"], -hit["shorter"], runs)
            )

        unsure = F.exists(hits, lambda hit: hit["rest"].isNotNull())
        hits = F.when(unsure, _bound(_runs(text), confirmed)).otherwise(hits)
    found = _terms(hits, shape.runs == 1, remove_duplicates)
    return joined.withColumn(
        "extracted_skills", F.when(F.col("_hits").isNull(), nothing).otherwise(found)
    ).drop("_digest", "_shard", "_hits")


def _places(keyed: DataFrame, text: Column, kinds: list) -> DataFrame:
    """``(_digest, place, total, key)``: the windows of each text that can be a key, and its number of runs."""

    def listed(runs: Column) -> Column:
        total = F.size(runs).alias("total")
        return F.concat(
            *_keys(runs, kinds, lambda place, key: F.struct(place.alias("place"), total, key.alias("key")))
        )

    return keyed.select("_digest", F.inline(_bound(_runs(text), listed)))


def _joined(places: DataFrame, terms: DataFrame, size: int) -> DataFrame:
    """``(_digest, start, runs, pattern, canonical)`` of the patterns whose key is in a text."""
    if size <= BROADCAST_BYTES:
        found = places.join(F.broadcast(terms), "key")
    else:
        copies = max(SALTS[0], min(SALTS[1], COPIES_BYTES // size))
        salted = places.withColumn("_salt", F.pmod(F.xxhash64("_digest", "place"), F.lit(copies)))
        salts = F.sequence(F.lit(0).cast("long"), F.lit(copies - 1).cast("long"))
        found = salted.join(terms.withColumn("_salt", F.explode(salts)).hint("merge"), ["key", "_salt"])
    start = F.col("place") - F.col("offset")
    entry = {name: F.col(name) for name in ("runs", "opens", "ends")}
    return found.filter(_within_edges(entry, start, F.col("total"))).select(
        "_digest", start.alias("start"), "runs", "pattern", "canonical"
    )
