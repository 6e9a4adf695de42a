"""Small scalar expressions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from gleaner.functions.cleaning import strip
from gleaner.functions.lookup import literal_lookup


def round2(column: Column) -> Column:
    """Two decimals, ties to even."""
    return F.bround(column, 2)


def percentage(part: Column, whole: Column) -> Column:
    """``part`` per hundred of ``whole``, unrounded; 0 for an empty whole."""
    return F.when(whole > 0, part / whole * 100).otherwise(F.lit(0.0))


def normalize_role(role: Column, role_map: Mapping[str, Sequence[str]] | None = None) -> Column:
    """Canonical role name.

    Null and empty roles are ``Unknown``.  Otherwise the stripped, lower-cased
    role is looked up in ``role_map`` (canonical name -> spellings, first
    mapping wins); a role without a mapping keeps its stripped spelling.
    """
    spelled = strip(role.cast("string"))
    name = spelled
    if role_map:
        canonical_by_spelling: dict[str, str] = {}
        for canonical, spellings in role_map.items():
            for spelling in spellings:
                canonical_by_spelling.setdefault(spelling.lower(), canonical)
        find = literal_lookup(canonical_by_spelling)
        name = F.coalesce(find(F.lower(spelled)), spelled)
    return F.when(role.isNull() | (role.cast("string") == ""), F.lit("Unknown")).otherwise(name)


def safe_name(role: Column) -> Column:
    """A role as a file-safe label: everything but letters and numbers becomes ``_``."""
    return F.regexp_replace(role, r"[^\p{L}\p{N}]", "_")
