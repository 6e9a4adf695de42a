"""Personal data: anchors found by an Aho-Corasick automaton, expanded by deterministic parsers."""

from __future__ import annotations

import hashlib
import re

import ahocorasick
from gleaner.llm.tasks import map_rows
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Base kinds in their order, then those that the anchors add.
BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "login", "iban", "account", "secret")

#: Cues of an identifier, in lower case; what follows them decides.
ACCOUNT_CUES = ("account", "acct", "iban", "ssn", "passport", "konto", "cuenta", "compte")
SECRET_CUES = ("token", "secret", "password", "passwd", "api_key", "apikey", "api-key")

#: Fixed lengths of IBANs by country; others may have any.
_COUNTRIES = {
    15: "NO", 16: "BE", 18: "DK FI FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK",
    21: "CH HR LI LV", 22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL",
    24: "AD CZ DZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST", 26: "IS TR", 27: "DJ FR GR IT MC MR SM",
    28: "AL AZ BY CY DO GT HU LB NI PL SV", 29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
}
IBAN_LENGTHS = {country: length for length, names in _COUNTRIES.items() for country in names.split()}

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_DIGITS = re.compile(r"[0-9]+")
_IP = re.compile(r"[0-9]+(?:\.[0-9]+){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_SCHEME_END = re.compile(r"[A-Za-z][A-Za-z0-9+.-]{0,31}\Z")
_AUTHORITY = re.compile(r"[^\s/?#@:]+:[^\s/?#@]+@[A-Za-z0-9.-]+(?::[0-9]+)?")
_IBAN = re.compile(r"[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])")
# Blanks and hyphens are part of a number only before a digit: the word behind it is not.
_NUMBER = re.compile(
    r"[ \t]*(?:number|no\.?|nr\.?|num)?[ \t]*[:=#][ \t]*\"?([A-Z]{0,4}[0-9](?:[ -]?[0-9]|[A-Z]){4,33})(?![0-9A-Za-z])",
    re.I,
)
_VALUE = re.compile(r"\"?[ \t]*[:=][ \t]*[\"']?([A-Za-z0-9_+/=.-]{16,})")


def luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + place % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def _valid_iban(text: str) -> bool:
    text = text.replace(" ", "")
    if not 15 <= len(text) <= 34:
        return False
    return int("".join(str(int(c, 36)) for c in text[4:] + text[:4])) % 97 == 1


def _iban_length(text: str) -> int:
    """Characters of the IBAN that ``text`` begins with, 0 if none: upper-case words may follow it.

    It ends where a group ends, at its country's length if it is valid there;
    else the longest valid one counts.
    """
    ends = [len(text), *(i for i in range(len(text) - 1, 0, -1) if text[i] == " ")]
    usual = IBAN_LENGTHS.get(text[:2])
    ends.sort(key=lambda end: end - text.count(" ", 0, end) != usual)
    return next((end for end in ends if _valid_iban(text[:end])), 0)


def automaton() -> ahocorasick.Automaton:
    """Finds at-signs, digits, plus signs, schemes and identifier cues."""
    made = ahocorasick.Automaton()
    for digit in "0123456789":
        made.add_word(digit, ("digit", 1))
    made.add_word("@", ("at", 1))
    made.add_word("+", ("plus", 1))
    made.add_word("://", ("scheme", 3))
    for cue in ACCOUNT_CUES:
        made.add_word(cue, ("account", len(cue)))
    for cue in SECRET_CUES:
        made.add_word(cue, ("secret", len(cue)))
    made.make_automaton()
    return made


def _lower(text: str) -> str:
    """Lower case of the same length."""
    low = text.lower()
    return low if len(low) == len(text) else "".join(c.lower() if len(c.lower()) == 1 else c for c in text)


def _word(c: str) -> bool:
    return c.isalnum() or c == "_"


class Finder:
    """All spans of a text: (kind, start, end) in code points, end exclusive, by start and kind."""

    def __init__(self):
        self.anchors = automaton()

    def __call__(self, text: str) -> list[tuple[str, int, int]]:
        spans: set[tuple[str, int, int]] = set()
        self.text, self.after = text, dict.fromkeys((*KINDS, "digits"), 0)
        parsers = {
            "digit": self._digit,
            "at": self._email,
            "plus": self._phone,
            "scheme": self._login,
            "account": self._account,
            "secret": self._secret,
        }
        for last, (anchor, length) in self.anchors.iter(_lower(text)):
            spans.update(parsers[anchor](last - length + 1, last + 1))
        order = KINDS.index
        return sorted(spans, key=lambda s: (s[1], order(s[0]), s[2]))

    def _digit(self, start: int, _: int):
        """A card is the longest chain of digits; an address has four parts of such a run."""
        if start >= self.after["card"]:
            if chain := _CARD.match(self.text, start):
                self.after["card"] = chain.end()
                digits = chain[0].replace(" ", "").replace("-", "")
                if 14 <= len(digits) <= 19 and luhn(digits):
                    yield "card", start, chain.end()
        if start >= self.after["ip"]:
            if found := _IP.match(self.text, start):
                self.after["ip"] = found.end()
                parts = [p.lstrip("0") for p in found[0].split(".")]  # of any length before
                if all(len(p) <= 3 and int(p or 0) <= 255 for p in parts):
                    yield "ip", start, found.end()
            else:  # no other digit of this run can begin one
                self.after["ip"] = _DIGITS.match(self.text, start).end()
        yield from self._iban(start)

    def _email(self, start: int, end: int):
        first = start
        while first > self.after["email"] and self.text[first - 1] in _LOCAL:
            first -= 1
        if first < start and (domain := _DOMAIN.match(self.text, end)):
            self.after["email"] = domain.end()
            yield "email", first, domain.end()

    def _phone(self, start: int, _: int):
        if found := _PHONE.match(self.text, start):
            if 10 <= sum("0" <= c <= "9" for c in found[0]) <= 15:
                yield "phone", start, found.end()

    def _login(self, start: int, end: int):
        """An address with a user and a password, from its scheme to the end of its host."""
        scheme = _SCHEME_END.search(self.text, max(0, start - 32), start)
        if scheme and (found := _AUTHORITY.match(self.text, end)):
            yield "login", scheme.start(), found.end()

    def _iban(self, digit: int):
        """An account number with a country, valid by its check digits; its first digit is the third character."""
        start = digit - 2
        if start < self.after["iban"] or (start and _word(self.text[start - 1])):
            return
        if (found := _IBAN.match(self.text, start)) and (length := _iban_length(found[0])):
            self.after["iban"] = start + length
            yield "iban", start, start + length

    def _account(self, start: int, end: int):
        if start and _word(self.text[start - 1]):
            return
        if found := _NUMBER.match(self.text, end):
            yield "account", *found.span(1)

    def _secret(self, start: int, end: int):
        if start and _word(self.text[start - 1]) and self.text[start - 1] != "_":
            return
        if found := _VALUE.match(self.text, end):
            value = found[1]
            if any(c.isdigit() for c in value) and any(c.isalpha() for c in value):
                yield "secret", *found.span(1)


def _joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in spans)


def redacted(text: str, spans: list[tuple[str, int, int]]) -> str:
    """The text with each span replaced by its kind in brackets; of overlapping ones the first kind stands."""
    out, at = [], 0
    for kind, start, end in spans:
        if start >= at:
            out += [text[at:start], f"[{kind.upper()}]"]
        at = max(at, end)
    return "".join([*out, text[at:]])


def personal_data(docs: DataFrame, keep: list[str], text: str = "text") -> DataFrame:
    """``keep``, counts of the base kinds, a digest of the base spans, and all spans of each document.

    An Aho-Corasick automaton finds at-signs, digits, plus signs, schemes and
    identifier cues in one pass; from each anchor a local parser expands to
    the boundaries of an e-mail address, IP address, card number, phone
    number, address with a password, IBAN, account number or secret, and
    validates it. Whole texts are searched; a null text is empty and has no
    spans (its digest is that of an empty string). Rows are independent:
    repeated rows and other columns do not matter.
    """

    def make():
        find = Finder()

        def run(texts: list) -> dict[str, list]:
            out: dict[str, list] = {f"n_{kind}": [] for kind in BASE} | {"base_sha256": [], "spans": []}
            for spans in (find(t or "") for t in texts):
                base = [s for s in spans if s[0] in BASE]
                for kind in BASE:
                    out[f"n_{kind}"].append(sum(s[0] == kind for s in base))
                out["base_sha256"].append(hashlib.sha256(_joined(base).encode()).hexdigest())
                out["spans"].append(_joined(spans))
            return out

        return run

    fields = [T.StructField(f"n_{kind}", T.LongType()) for kind in BASE]
    fields += [T.StructField("base_sha256", T.StringType()), T.StructField("spans", T.StringType())]
    return map_rows(docs, keep, [text], fields, make)


def redact(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with the personal data of ``text`` replaced by ``[KIND]``; a null text stays null."""

    def make():
        find = Finder()

        def run(texts: list) -> dict[str, list]:
            return {"clean": [None if t is None else redacted(t, find(t)) for t in texts]}

        return run

    packed = docs.select(F.struct(*docs.columns).alias("row"), F.col(text).alias("text"))
    made = map_rows(packed, ["row"], ["text"], [T.StructField("clean", T.StringType())], make)
    return made.select(
        *(F.col("clean").alias(c) if c == text else F.col("row").getField(c).alias(c) for c in docs.columns)
    )
