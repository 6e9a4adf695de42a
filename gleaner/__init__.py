"""Dictionary-term extraction and analytics on Spark DataFrames."""

from gleaner.functions.cleaning import clean_text
from gleaner.operators.extraction import extract_terms
from gleaner.operators.frequencies import (
    dataset_summary,
    document_frequency,
    group_summary,
    tally,
    term_stats,
    top_terms,
)
from gleaner.operators.rows import add_row_ids, valid_rows
from gleaner.operators.rules import global_rules, rules
from gleaner.operators.vocabulary import match_vocabulary
from gleaner.plans.extraction import extraction_result, run_extraction

__all__ = [
    "add_row_ids",
    "clean_text",
    "dataset_summary",
    "document_frequency",
    "extract_terms",
    "extraction_result",
    "global_rules",
    "group_summary",
    "match_vocabulary",
    "rules",
    "run_extraction",
    "tally",
    "term_stats",
    "top_terms",
    "valid_rows",
]
