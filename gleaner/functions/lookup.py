"""Constant-time lookup of a string in a literal mapping.

Spark scans a map literal entry by entry.  Here the mapping is cut into
buckets by CRC-32, so one lookup reads one array element and one tiny map.
The whole table is a single literal: nothing is joined or shuffled.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Callable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

BUCKET_SCHEMA = "array<map<string,string>>"


def literal_lookup(mapping: Mapping[str, str]) -> Callable[[Column], Column]:
    """A function ``key -> value`` over columns; null for unknown keys."""
    count = max(1, len(mapping))
    buckets: list[dict[str, str]] = [{} for _ in range(count)]
    for key, value in mapping.items():
        buckets[zlib.crc32(key.encode("utf-8")) % count][key] = value
    table = F.from_json(F.lit(json.dumps(buckets)), BUCKET_SCHEMA)

    def find(key: Column) -> Column:
        slot = (F.crc32(key.cast("binary")) % F.lit(count)).cast("int")
        return F.element_at(F.get(table, slot), key)

    return find
