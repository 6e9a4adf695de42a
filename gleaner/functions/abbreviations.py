"""Whole-word abbreviation expansion."""

from __future__ import annotations

import re
from collections.abc import Mapping
from itertools import groupby

from pyspark.sql import Column
from pyspark.sql import functions as F

from gleaner.functions.characters import RUNS, edge_after, edge_before, is_word_char, quote
from gleaner.functions.lookup import literal_lookup
from gleaner.functions.matching import terms_regex

_MARK = "\x01"
_WORD_RUN = re.compile(r"\w+")


def expand_abbreviations(
    text: Column,
    abbreviations: Mapping[str, str],
    *,
    lowered: bool = True,
    controls_removed: bool = True,
) -> Column:
    """Replace every abbreviation standing as a whole word, ignoring case.

    The entries apply in order, each to the output of the one before.
    ``lowered`` says that ``text`` is in lower case already, and
    ``controls_removed`` that it holds no control characters.
    """
    if not abbreviations:
        return text
    if all(_is_single_word(key) for key in abbreviations):
        return _replace_words(text, _resolve_chains(abbreviations), lowered, controls_removed)
    for entries in passes(abbreviations):
        text = _replace_at_once(text, entries)
    return text


def _is_single_word(key: str) -> bool:
    return bool(key) and all(is_word_char(c) for c in key)


def _resolve_chains(abbreviations: Mapping[str, str]) -> dict[str, str]:
    """What each key becomes once all later entries have been applied to it.

    A key that is one word is replaced between two non-word characters, so the
    words of its expansion meet the later entries just like words of the text.
    """
    entries = [(key.lower(), str(value)) for key, value in abbreviations.items()]
    resolved: dict[str, str] = {}
    for position, (key, value) in enumerate(entries):
        if key in resolved:
            continue
        for later_key, later_value in entries[position + 1 :]:
            value = _WORD_RUN.sub(
                lambda run: later_value if run.group().lower() == later_key else run.group(), value
            )
        resolved[key] = value
    return resolved


def _replace_words(
    text: Column, resolved: Mapping[str, str], lowered: bool, controls_removed: bool
) -> Column:
    if controls_removed:
        # Fence the hits with a character the text cannot hold, then split there.
        pattern = ("" if lowered else "(?iu)") + terms_regex(resolved)
        pieces = F.split(F.regexp_replace(text, pattern, f"{_MARK}$0{_MARK}"), _MARK)
    else:
        pieces = F.regexp_extract_all(text, F.lit(RUNS), F.lit(0))
    find = literal_lookup(resolved)

    def expand(piece: Column) -> Column:
        return F.coalesce(find(piece if lowered else F.lower(piece)), piece)

    return F.array_join(F.transform(pieces, expand), "")


def passes(abbreviations: Mapping[str, str]) -> list[dict[str, str]]:
    """The entries (lower-case keys) in groups; those of a group can be applied in one pass.

    An entry joins the group of the ones before it unless their order can
    matter: their keys can overlap in a text, an earlier expansion can form
    the later key, alone or with its neighbours, or an earlier expansion can
    change what stands at the edge of a word.
    """
    groups: list[dict[str, str]] = []
    held: list[list[str]] = []
    for key, value in abbreviations.items():
        key, value = key.lower(), str(value)
        if not key:
            continue
        own = _runs(key)
        if not groups or any(_meet(other, own) for other in held):
            groups.append({})
            held = []
        groups[-1][key] = value
        held += [own, _runs(value.lower())]
        if not value or not _same_edges(key, value):
            held.append([])  # meets any key
    return groups


def _runs(text: str) -> list[str]:
    """Runs of word characters and of others, by turns."""
    return ["".join(run) for _, run in groupby(text, is_word_char)]


def _same_edges(key: str, value: str) -> bool:
    return all(is_word_char(key[i]) is is_word_char(value[i]) for i in (0, -1))


def _meet(a: list[str], b: list[str]) -> bool:
    """Whether two sequences of runs can lie over each other in a text; an empty one meets all."""
    if not a or not b:
        return True
    for shift in range(1 - len(b), len(a)):
        first, last = max(0, shift), min(len(a), shift + len(b))
        if a[first:last] == b[first - shift : last - shift]:
            return True
    return False


def _replace_at_once(text: Column, entries: Mapping[str, str]) -> Column:
    """All entries of one group: what lies between the hits, and the expansions of the hits."""
    if len(entries) == 1:
        ((key, value),) = entries.items()
        pattern = "(?iu)" + edge_before(key[0]) + quote(key) + edge_after(key[-1])
        return F.regexp_replace(text, pattern, value.replace("\\", "\\\\").replace("$", "\\$"))
    pattern = "(?iu)" + terms_regex(entries)
    hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    find = literal_lookup(dict(entries))

    def expanded(gap: Column, hit: Column) -> Column:
        return F.concat(gap, F.coalesce(find(F.lower(hit)), hit, F.lit("")))

    return F.array_join(F.zip_with(F.split(text, pattern, -1), hits, expanded), "")
