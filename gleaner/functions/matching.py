"""Whole-word term matching with one regular expression.

The terms are merged into a prefix tree before they become a pattern.  At any
position only the branch that fits the text is followed, so the cost per
character hardly depends on the number of terms, while a flat alternation
tries every term in turn.  All terms that match at one position are prefixes
of one another, and a branch prefers to go on before it stops: the longest
term wins, as with a longest-first alternation.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from gleaner.functions.characters import edge_after, edge_before, is_word_char, quote
from gleaner.functions.lookup import literal_lookup

_END = ""


def terms_regex(terms: Iterable[str]) -> str:
    """A pattern for the leftmost, longest whole-word occurrences of ``terms``."""
    root = _tree(terms)
    if not root:
        raise ValueError("no terms to match")
    branches = []
    for wordlike in (True, False):
        starts = {c: n for c, n in root.items() if is_word_char(c) is wordlike}
        if starts:
            branches.append(edge_before(next(iter(starts))) + _branches(starts))
    return branches[0] if len(branches) == 1 else "(?:" + "|".join(branches) + ")"


def _tree(terms: Iterable[str]) -> dict:
    root: dict = {}
    for term in terms:
        node = root
        for char in term:
            node = node.setdefault(char, {})
        if term:
            node[_END] = edge_after(term[-1])
    return root


def nesting(terms: Iterable[str]) -> int:
    """How many forks of the prefix tree lie one behind the other, at most."""
    deepest, todo = 0, [(_tree(terms), 0)]
    while todo:
        node, depth = todo.pop()
        depth += len(node) > 1
        deepest = max(deepest, depth)
        todo.extend((child, depth) for char, child in node.items() if char != _END)
    return deepest


def _branches(node: dict) -> str:
    literal = ""
    while len(node) == 1 and _END not in node:
        ((char, node),) = node.items()
        literal += quote(char)
    options = [quote(char) + _branches(node[char]) for char in sorted(node) if char != _END]
    if _END in node:
        options.append(node[_END])
    return literal + (options[0] if len(options) == 1 else "(?:" + "|".join(options) + ")")


def find_terms(
    text: Column,
    canonical_by_pattern: Mapping[str, str],
    *,
    case_sensitive: bool = False,
    remove_duplicates: bool = True,
    lowered: bool = False,
) -> Column:
    """Terms found in ``text`` in order of appearance, as an array.

    ``canonical_by_pattern`` maps each lower-cased pattern to the term to
    report; ``lowered`` says that ``text`` is in lower case already.  Null or
    empty text, or no patterns, gives an empty array.
    """
    nothing = F.array().cast("array<string>")
    if not canonical_by_pattern:
        return nothing
    haystack = text if case_sensitive or lowered else F.lower(text)
    found = F.regexp_extract_all(haystack, F.lit(terms_regex(canonical_by_pattern)), F.lit(0))
    if remove_duplicates:
        found = F.array_distinct(found)
    renamed = {p: c for p, c in canonical_by_pattern.items() if p != c}
    if renamed:
        find = literal_lookup(renamed)
        found = F.transform(found, lambda term: F.coalesce(find(term), term))
        if remove_duplicates:
            found = F.array_distinct(found)
    return F.coalesce(found, nothing)
