"""Character classes shared by cleaning, matching and the boundary rules.

Java's ``\\w`` and ``\\s`` are ASCII-only, so the Unicode classes are spelled
out.  A word character is a letter, a number or ``_``; a word boundary lies
between a word character and anything else.
"""

from __future__ import annotations

# The ASCII ranges come first: Java tests the members of a class in order.
WORD_MEMBERS = r"a-zA-Z0-9_\p{L}\p{N}"
WORD = f"[{WORD_MEMBERS}]"
NOT_WORD = f"[^{WORD_MEMBERS}]"

# Unicode white space plus the four ASCII separators U+001C..U+001F.  Few, broad
# members: an enumeration of the characters makes Java many times slower.
SPACE_MEMBERS = r"\s\x85\x1c-\x1f\p{Z}"
SPACE = f"[{SPACE_MEMBERS}]"
NOT_SPACE = f"[^{SPACE_MEMBERS}]"

# A maximal run of word characters, or of anything else.
RUNS = f"{WORD}++|{NOT_WORD}++"


def is_word_char(char: str) -> bool:
    return char.isalnum() or char == "_"


def quote(text: str) -> str:
    """Regex-escape literal text for Java."""
    return "".join(c if is_word_char(c) or c.isspace() else "\\" + c for c in text)


def edge_before(char: str) -> str:
    """Zero-width test for a word boundary in front of ``char``."""
    return f"(?<!{WORD})" if is_word_char(char) else f"(?<={WORD})"


def edge_after(char: str) -> str:
    """Zero-width test for a word boundary behind ``char``."""
    return f"(?!{WORD})" if is_word_char(char) else f"(?={WORD})"
