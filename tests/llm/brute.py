"""Plain models that the tests compare the operators with, and a table of awkward rows."""

from __future__ import annotations

import re
import struct
import zlib

import xxhash

SPACE = "[\x20\x09-\x0d]+"
DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long, kept string, n_words string, id string"


def words(text: str | None) -> list[str]:
    return [w for w in re.split(SPACE, text or "") if w]


def awkward_rows() -> list[tuple]:
    """Nulls in each column, empty, tiny and very long texts, copies, repeated rows, other columns' names."""
    prose = " ".join(f"word{i % 97}x{i % 13}" for i in range(400))
    rest = ("k", "n", "i")
    rows = [
        (1, prose, "en", "a", len(prose), *rest),
        (2, prose, "en", "a", len(prose), *rest),
        (3, None, "en", "a", None, *rest),
        (4, "", "en", "a", 0, *rest),
        (5, "one", None, None, 3, None, None, None),
        (6, " \t\n\x0b\x0c\r ", "en", "b", 7, *rest),
        (7, "a b  c é́ 日本 \U0001f600", "xx", "b", 12, *rest),
        (8, "long " * 60_000, "en", "b", 300_000, *rest),
        (8, "long " * 60_000, "en", "b", 300_000, *rest),
        (None, "no id here, but " + prose, "en", "c", 9, *rest),
        (10, "x" * 100_000, "en", None, 100_000, *rest),
        (11, "call +1 (614) 555-8001 or a.b@c.example, 10.1.2.3", "en", "c", 9, *rest),
    ]
    return rows


def fingerprint(text: str | None) -> int:
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    own = words(low)
    shingles = [" ".join(own[i : i + 4]) for i in range(max(1, len(own) - 3))] if own else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def classes(ids: list, points: list[int], distance: int) -> list:
    """The smallest id of the component of each point."""
    parent = list(range(len(points)))

    def root(i: int) -> int:
        while parent[i] != i:
            i = parent[i]
        return i

    for i, p in enumerate(points):
        for j in range(i):
            if (p ^ points[j]).bit_count() <= distance:
                a, b = root(i), root(j)
                parent[max(a, b)] = min(a, b)
    least: dict = {}
    for i, value in enumerate(ids):
        if value is not None:
            least[root(i)] = min(least.get(root(i), value), value)
    return [least.get(root(i)) for i in range(len(ids))]


BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def _fine(kind: str, found: str) -> bool:
    digits = [int(c) for c in found if c in "0123456789"]
    if kind == "ip":
        return all(int(p) <= 255 for p in found.split("."))
    if kind == "card":
        doubled = [d if i % 2 == 0 else (2 * d) // 10 + (2 * d) % 10 for i, d in enumerate(digits[::-1])]
        return 14 <= len(digits) <= 19 and sum(doubled) % 10 == 0
    return kind == "email" or 10 <= len(digits) <= 15


def base_spans(text: str | None) -> list[tuple[int, int, str, int]]:
    """(start, place of the kind, kind, end), sorted."""
    return sorted(
        (m.start(), place, kind, m.end())
        for place, (kind, pattern) in enumerate(BASE.items())
        for m in re.finditer(pattern, text or "")
        if _fine(kind, m[0])
    )


def rule_stats(text: str | None) -> tuple[int, int, int, int, int]:
    text, own = text or "", words(text)
    lines = [line for line in text.split("\n") if words(line)]
    windows = [tuple(own[i : i + 5]) for i in range(len(own) - 4)]
    counts: dict = {}
    for w in windows:
        counts[w] = counts.get(w, 0) + 1
    covered = {i + k for i, w in enumerate(windows) if counts[w] > 1 for k in range(5)}
    symbols = sum(c in "#*$%&|<>" for c in text)
    return len(own), sum(map(len, own)), symbols, len(lines) - len(set(lines)), len(covered)


def crc32_ids(ids: list[int]) -> int:
    return zlib.crc32(struct.pack(f"<{len(ids)}I", *ids))
