"""Terms that occur in the benchmark tables, used by the registered queries."""

from __future__ import annotations

DOCUMENT_TERMS = {
    "technical": [
        "thtion", "attion", "ertion", "eriner", "thanedble", "antion", "License", "apache", "rest",
    ],
    "soft": ["ontion", "retion", "edtion", "hation", "rest"],
    "custom": [
        "of the", "the and", "and the", "for the", "de la", "la de", "der die", "und der", "the",
        "Thtion",
    ],
}

DOCUMENT_VARIATIONS = {
    "Thtion": ["attion", "antion"],
    "the conjunction": ["the and", "and the"],
}

# Each is frequent as a whole word; "nt" reaches "street" through "st".
ABBREVIATIONS = {"th": "than", "er": "other", "nd": "and", "nt": "st", "st": "street"}

PART_TERMS = {
    "technical": ["anvil", "bolt", "gear", "gizmo", "plate", "ring", "rod", "widget"],
    "custom": ["small ring", "red widget", "blue bolt"],
}

PART_VARIATIONS = {"fastener": ["bolt", "rod"]}

LANGUAGE_ROLES = {"English": ["EN"], "Romance": ["fr", "es"], "Romanic": ["es"]}
