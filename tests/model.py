"""What cleaning, abbreviations and matching must give: a walk over the characters of one text."""

from __future__ import annotations

KEPT = "-.+#"


def wordlike(char: str) -> bool:
    return char == "_" or char.isalnum()


def edges(text: str) -> set[int]:
    """The places between a word character and something else."""
    marks = [False, *map(wordlike, text), False]
    return {i for i in range(len(text) + 1) if marks[i] != marks[i + 1]}


def _tags(text: str) -> str:
    out, at = [], 0
    while (start := text.find("<", at)) >= 0:
        end = text.find(">", start + 2)
        if end < 0 or text[start + 1] == ">":
            out.append(text[at : start + 1])
            at = start + 1
        else:
            out.append(text[at:start] + " ")
            at = end + 1
    return "".join(out) + text[at:]


def _tokens(text: str) -> list[str]:
    """Runs of white space and of anything else, by turns."""
    out: list[str] = []
    for char in text:
        if out and out[-1][0].isspace() == char.isspace():
            out[-1] += char
        else:
            out.append(char)
    return out


def _link(token: str) -> str:
    places = [p for scheme in ("http://", "https://") if 0 <= (p := token.find(scheme)) < len(token) - len(scheme)]
    return token[: min(places)] + " " if places else token


def _address(token: str) -> str:
    return " " if "@" in token[1:-1] else token


def clean(text, abbreviations=None, *, lower=True, spaces=True, special=True, hyphens=True):
    for step in (_link, _address):
        text = "".join(map(step, _tokens(_tags(text) if step is _link else text)))
    if special:
        kept = KEPT if hyphens else ""
        text = "".join(c if wordlike(c) or c.isspace() or c in kept else " " for c in text)
    if lower:
        text = text.lower()
    if spaces:
        text = " ".join(text.split())
    return abbreviate(text, abbreviations or {})


def _standing(text: str, at: int, term: str, ends: set[int]) -> bool:
    return at in ends and at + len(term) in ends and text.startswith(term, at)


def abbreviate(text, abbreviations):
    for key, value in abbreviations.items():
        folded, ends, out, at = text.lower(), edges(text), [], 0
        while at < len(text):
            if key and _standing(folded, at, key.lower(), ends):
                out.append(value)
                at += len(key)
            else:
                out.append(text[at])
                at += 1
        text = "".join(out)
    return text


def match(text, vocabulary, *, case_sensitive=False, distinct=True):
    """``vocabulary`` maps patterns to the terms to report."""
    folded = text if case_sensitive else text.lower()
    ends, found, at = edges(folded), [], 0
    while at < len(folded):
        here = [term for term in vocabulary if _standing(folded, at, term, ends)]
        if here:
            longest = max(here, key=len)
            found.append(vocabulary[longest])
        at += len(longest) if here else 1
    if distinct:
        found = [term for i, term in enumerate(found) if term not in found[:i]]
    return found
