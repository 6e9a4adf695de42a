"""The registered queries once more, as SQL for an independent engine (DuckDB).

Its regular expressions know only ASCII word boundaries and no look-around.
So every run of word characters is fenced with two control characters first,
and terms are matched together with the fences.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping, Sequence

from gleaner.plans.sample_terms import (
    ABBREVIATIONS,
    DOCUMENT_TERMS,
    DOCUMENT_VARIATIONS,
    LANGUAGE_ROLES,
    PART_TERMS,
    PART_VARIATIONS,
)

SPACES = r"\s\p{Z}\x0b\x1c-\x1f\x{85}"
WORDS = r"\p{L}\p{N}_"


def literal(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def replaced(text: str, pattern: str, by: str = " ") -> str:
    return f"regexp_replace({text}, {literal(pattern)}, {literal(by)}, 'g')"


# Cleaning -------------------------------------------------------------------


def tags(text: str) -> str:
    return replaced(text, "<[^>]+>")


def urls(text: str) -> str:
    return replaced(text, f"https?://[^{SPACES}]+")


def emails(text: str) -> str:
    return replaced(text, f"[^{SPACES}]+@[^{SPACES}]+")


def single_spaces(text: str) -> str:
    return f"trim({replaced(text, f'[{SPACES}]+')})"


def special(text: str, kept: str = r"\-.+#") -> str:
    return replaced(text, f"[^{WORDS}{SPACES}{kept}]")


def cleaned(text: str) -> str:
    return single_spaces(f"lower({special(emails(urls(tags(text))))})")


def fenced(text: str) -> str:
    return rf"regexp_replace({text}, '([{WORDS}]+)', chr(1) || '\1' || chr(2), 'g')"


def unfenced(text: str) -> str:
    return f"replace(replace({text}, chr(1), ''), chr(2), '')"


def abbreviated(text: str) -> str:
    text = fenced(text)
    for key, value in ABBREVIATIONS.items():
        text = f"replace({text}, chr(1) || '{key}' || chr(2), chr(1) || '{value}' || chr(2))"
    return unfenced(text)


def abbreviated_any_case(text: str) -> str:
    text = fenced(text)
    for key, value in ABBREVIATIONS.items():
        text = rf"regexp_replace({text}, '(?i)\x01{key}\x02', chr(1) || '{value}' || chr(2), 'g')"
    return unfenced(text)


# Matching -------------------------------------------------------------------


def patterns_of(terms: Mapping[str, Sequence[str]], variations: Mapping[str, Sequence[str]]) -> set[str]:
    listed = [t for group in terms.values() for t in group]
    listed += [v for group in variations.values() for v in group]
    return {t.lower() for t in listed}


def alternation(patterns: Iterable[str]) -> str:
    ordered = sorted(patterns, key=lambda p: (-len(p), p))
    return "|".join(re.sub(r"(\w+)", r"\\x01\1\\x02", p) for p in ordered)


def canonical(term: str, variations: Mapping[str, Sequence[str]]) -> str:
    cases = " ".join(
        f"WHEN {literal(v.lower())} THEN {literal(name.lower())}"
        for name, listed in variations.items()
        for v in listed
    )
    return f"CASE {term} {cases} ELSE {term} END" if cases else term


def distinct_in_order(terms: str) -> str:
    return f"list_filter({terms}, lambda x, i: list_position({terms}, x) = i)"


def found(
    text: str,
    terms: Mapping[str, Sequence[str]],
    variations: Mapping[str, Sequence[str]],
    flags: str = "(?i)",
) -> str:
    matches = (
        f"regexp_extract_all({fenced(text)}, '{flags}(?:{alternation(patterns_of(terms, variations))})')"
    )
    name = canonical(f"lower({unfenced('x')})", variations)
    return f"list_transform({matches}, lambda x: {name})"


def extracted(
    columns: str,
    source: str,
    text: str = "text",
    *,
    terms: Mapping[str, Sequence[str]] = DOCUMENT_TERMS,
    variations: Mapping[str, Sequence[str]] = DOCUMENT_VARIATIONS,
    dedup: bool = True,
    clean: bool = True,
    abbreviate: bool = False,
    flags: str = "(?i)",
) -> str:
    """A query with ``columns``, ``skills`` (a list) and ``skill_count``."""
    body = cleaned(text) if clean else text
    if abbreviate:
        body = abbreviated(body)
    skills = distinct_in_order("matched") if dedup else "matched"
    return f"""
        SELECT *, CAST(len(skills) AS INTEGER) AS skill_count FROM (
            SELECT * EXCLUDE (matched), {skills} AS skills FROM (
                SELECT *, {found("body", terms, variations, flags)} AS matched FROM (
                    SELECT {columns}, {body} AS body FROM {source})))"""


def shown(keys: str, inner: str) -> str:
    return f"""SELECT {keys}, coalesce(array_to_string(skills, '|'), '') AS skills, skill_count
        FROM ({inner})"""


JOB = "CAST(doc_id AS VARCHAR) AS job_id"
DOCUMENTS = extracted(f"{JOB}, doc_id, lang, source, text", "documents")
PARTS = extracted(
    "CAST(p_partkey AS VARCHAR) AS job_id, p_name, p_type, p_brand",
    "part",
    "p_name",
    terms=PART_TERMS,
    variations=PART_VARIATIONS,
)
GAPPY = """(SELECT doc_id, text, lang, source, n_chars FROM documents UNION ALL
    SELECT -1 - doc_id, CASE WHEN quality = 1 THEN '  ' || chr(9) END, '', 'label', 0 FROM labels)"""
NO_TEXT = f"(text IS NULL OR {single_spaces('text')} = '')"



def numbered(source: str, prefix: str = "jd") -> str:
    """Documents with generated ids in the order of their keys."""
    return f"""(SELECT *, '{prefix}_' || lpad(CAST(number AS VARCHAR),
        CAST(greatest(3, length(CAST(total AS VARCHAR))) AS INTEGER), '0') AS job_id
        FROM (SELECT *, row_number() OVER (ORDER BY doc_id) AS number, count(*) OVER () AS total
              FROM {source}))"""


# Roles and statistics -------------------------------------------------------


def role_case(role: str) -> str:
    stripped = f"regexp_replace({role}, '^[{SPACES}]+|[{SPACES}]+$', '', 'g')"
    seen: set[str] = set()
    cases = ""
    for name, spellings in LANGUAGE_ROLES.items():
        for spelling in spellings:
            if spelling.lower() not in seen:
                seen.add(spelling.lower())
                cases += f" WHEN lower({stripped}) = '{spelling.lower()}' THEN '{name}'"
    return f"CASE WHEN {role} IS NULL OR {role} = '' THEN 'Unknown'{cases} ELSE {stripped} END"


UNEVEN_ROLE = """CASE WHEN source = 'src3' THEN NULL WHEN source = 'src5' THEN ''
    WHEN source = 'src7' THEN '  '
    WHEN source IN ('src11', 'src13') THEN ' ' || upper(lang) || chr(9) ELSE lang END"""
ROLES = f"SELECT * REPLACE ({role_case('role')} AS role) FROM (SELECT *, {UNEVEN_ROLE} AS role FROM ({DOCUMENTS}))"


def stats(inner: str, role: str = "role") -> str:
    """``(role, skill, count, total_jds, percentage, place)`` per role and term."""
    return f"""
        SELECT *, count / total_jds * 100 AS percentage,
            row_number() OVER (PARTITION BY role ORDER BY count DESC, skill) AS place
        FROM (
            SELECT role, skill, count(*) AS count, any_value(total_jds) AS total_jds
            FROM (SELECT role, total_jds, unnest(list_distinct(skills)) AS skill
                  FROM (SELECT {role} AS role, skills, count(*) OVER (PARTITION BY {role}) AS total_jds
                        FROM ({inner})))
            GROUP BY role, skill)"""


def ranked(inner: str, n: int, role: str = "role") -> str:
    return f"""SELECT role, CAST(place AS INTEGER) AS rank, skill, count,
        round_even(percentage, 2) AS percentage FROM ({stats(inner, role)}) WHERE place <= {n}"""


def category(term: str) -> str:
    cases = ""
    for name in ("technical", "soft", "custom"):
        listed = ", ".join(literal(t.lower()) for t in DOCUMENT_TERMS[name])
        cases += f" WHEN {term} IN ({listed}) THEN '{name}'"
    return f"CASE{cases} ELSE 'unknown' END"


def spellings(term: str) -> str:
    cases = ""
    for name, listed in DOCUMENT_VARIATIONS.items():
        cases += f" WHEN {term} = {literal(name.lower())} THEN {literal('|'.join(listed))}"
        members = ", ".join(literal(v.lower()) for v in listed)
        cases += f" WHEN {term} IN ({members}) THEN {literal('|'.join([name, *listed]))}"
    return f"CASE{cases} ELSE {term} END"


def rules(inner: str, role: str, *, frequency: int = 20, core: float = 0.15, top: int = 5) -> str:
    return f"""
        SELECT skill, skill AS pattern, {spellings("skill")} AS variations,
            {category("skill")} AS category, 'dictionary' AS pattern_type, count AS frequency,
            round_even(percentage, 2) AS percentage, percentage >= {core} * 100 AS is_core_skill,
            CAST(CASE WHEN place <= {top} THEN place END AS INTEGER) AS rank, role
        FROM ({stats(inner, role)}) WHERE count >= {frequency}"""


def summary(inner: str, keys: str = "") -> str:
    lead = f"{keys}, " if keys else ""
    group = f"GROUP BY {keys}" if keys else ""
    return f"""
        SELECT {lead}count(*) AS total_jds,
            len(list_distinct(flatten(list(skills)))) AS unique_skills,
            round_even(avg(skill_count), 2) AS avg_skills_per_jd
        FROM ({inner}) {group}"""


PART_DICTIONARY = """
    SELECT split_part(p_name, ' ', 2) AS term, 'technical' AS category FROM part
    UNION ALL SELECT split_part(p_name, ' ', 1), 'soft' FROM part
    UNION ALL SELECT p_name, 'custom' FROM part
    UNION ALL SELECT p_type, 'custom' FROM part"""
VOCABULARY = f"""
    SELECT pattern, coalesce(arg_max(canonical, pos), pattern) AS canonical FROM (
        SELECT lower(term) AS pattern, NULL AS canonical, -1 AS pos FROM ({PART_DICTIONARY})
        UNION ALL SELECT lower(n_name), lower(r_name), n_nationkey
        FROM nation JOIN region ON n_regionkey = r_regionkey) GROUP BY pattern"""


def distinct_words(source: str) -> str:
    return f"""SELECT DISTINCT word FROM (
        SELECT unnest(regexp_split_to_array(lower(text), '[^{WORDS}]+')) AS word FROM {source})
        WHERE word <> ''"""


PASSAGES = f"""
    WITH vocabulary AS (
        SELECT DISTINCT lower(regexp_replace(text, '^[^{WORDS}]+|[^{WORDS}]+$', '', 'g')) AS term FROM benchmark
        UNION SELECT unnest([{", ".join(literal(t.lower()) for group in DOCUMENT_TERMS.values() for t in group)}])),
    pattern AS (
        SELECT '(?i)(?:' || string_agg({fenced("regexp_escape(term)")}, '|' ORDER BY length(term) DESC, term) || ')' AS p
        FROM vocabulary),
    matched AS (
        SELECT doc_id, list_transform(regexp_extract_all({fenced("text")}, p), lambda x: lower({unfenced("x")})) AS matched
        FROM documents, pattern)
    SELECT doc_id, coalesce(array_to_string(skills, '|'), '') AS skills, CAST(len(skills) AS INTEGER) AS skill_count
    FROM (SELECT doc_id, {distinct_in_order("matched")} AS skills FROM matched)"""
MAPPED = f"""
    WITH variations AS (
        SELECT lower(regexp_extract(text, '([{WORDS}]+)[^{WORDS}]+([{WORDS}]+)', 2)) AS variation,
            'item ' || min(item_id) AS canonical
        FROM benchmark GROUP BY 1 HAVING length(variation) > 1),
    vocabulary AS (
        SELECT variation AS term FROM variations
        UNION SELECT unnest([{", ".join(literal(t.lower()) for group in DOCUMENT_TERMS.values() for t in group)}])),
    pattern AS (
        SELECT '(?:' || string_agg({fenced("regexp_escape(term)")}, '|' ORDER BY length(term) DESC, term) || ')' AS p,
            (SELECT map_from_entries(list((variation, canonical))) FROM variations) AS names
        FROM vocabulary),
    matched AS (
        SELECT doc_id, list_transform(regexp_extract_all({fenced("body")}, p),
            lambda x: coalesce(names[{unfenced("x")}], {unfenced("x")})) AS matched
        FROM (SELECT doc_id, {abbreviated(cleaned("text"))} AS body FROM documents), pattern)
    SELECT CAST(doc_id AS VARCHAR) AS job_id, coalesce(array_to_string(skills, '|'), '') AS skills,
        CAST(len(skills) AS INTEGER) AS skill_count
    FROM (SELECT doc_id, {distinct_in_order("matched")} AS skills FROM matched)"""
RULES_ONE = f"SELECT * EXCLUDE (role) FROM ({rules(DOCUMENTS, repr('all'))})"
FREQUENCIES = f"SELECT skill, count FROM ({stats(DOCUMENTS, repr('all'))})"
REPORT = extracted("doc_id", f"(SELECT * FROM {GAPPY} WHERE NOT {NO_TEXT})", abbreviate=True)
ORACLE: dict[str, str] = {
    # Cleaning
    "clean_text": f"SELECT doc_id, {cleaned('text')} AS processed_text FROM documents",
    "clean_html": f"SELECT page_id, {cleaned('html')} AS processed_text FROM pages",
    "clean_keep_case": f"""SELECT doc_id,
        {single_spaces(special(emails(urls(tags("text")))))} AS processed_text FROM documents""",
    "clean_keep_spaces": f"""SELECT doc_id,
        lower({special(emails(urls(tags("text"))))}) AS processed_text FROM documents""",
    "clean_keep_special": f"""SELECT doc_id,
        {single_spaces(f"lower({emails(urls(tags('text')))})")} AS processed_text FROM documents""",
    "strip_special_all": f"""SELECT doc_id,
        {single_spaces(f"lower({special(emails(urls(tags('text'))), '')})")} AS processed_text
        FROM documents""",
    "strip_tags": f"SELECT page_id, {tags('html')} AS html FROM pages",
    "strip_urls": f"SELECT page_id, {urls('url')} AS url, {urls('html')} AS html FROM pages",
    "strip_emails": f"SELECT doc_id, {emails('text')} AS text FROM documents",
    "expand_abbreviations_words": f"""SELECT doc_id, {abbreviated("body")} AS processed_text
        FROM (SELECT doc_id, {cleaned("text")} AS body FROM documents)""",
    "expand_abbreviations_raw": f"""SELECT doc_id, {abbreviated_any_case("text")} AS expanded
        FROM documents""",
    "valid_filter": f"SELECT doc_id, n_chars FROM {GAPPY} WHERE NOT {NO_TEXT}",
    "clean_stats": f"""SELECT count(*) FILTER (WHERE NOT {NO_TEXT}) AS total_processed,
        count(*) FILTER (WHERE text IS NULL) AS skipped_null,
        count(*) FILTER (WHERE text IS NOT NULL AND {NO_TEXT}) AS skipped_empty FROM {GAPPY}""",
    "skipped_sample": f"""SELECT CAST(doc_id AS VARCHAR) AS job_id FROM {GAPPY} WHERE {NO_TEXT}
        ORDER BY 1 LIMIT 10""",
    # Ids and output columns
    "row_ids_generated": f"SELECT doc_id, job_id FROM {numbered('documents')}",
    # The rows of the file lie in the order of their keys.
    "row_ids_file_order": f"SELECT doc_id, job_id FROM {numbered('documents')}",
    "row_ids_csv_files": f"SELECT doc_id, job_id FROM {numbered('documents')}",
    "row_ids_existing": """SELECT CAST(conv_id AS VARCHAR) AS job_id, turn, role
        FROM conversations""",
    "duplicate_ids": """SELECT count(*) - count(DISTINCT conv_id) AS duplicate_count
        FROM conversations""",
    "format_results": f"SELECT skill_count, job_id, p_brand AS job_title, p_type FROM ({PARTS})",
    # Dictionaries
    "dictionary_union": f"SELECT DISTINCT lower(term) AS term FROM ({PART_DICTIONARY})",
    "dictionary_stats": f"""
        SELECT category, count(DISTINCT lower(term)) AS terms,
            count(*) - count(DISTINCT lower(term)) AS duplicates_removed, 1 AS lists_loaded
        FROM ({PART_DICTIONARY}) GROUP BY category
        UNION ALL
        SELECT 'all', count(DISTINCT lower(term)), count(*) - count(DISTINCT (lower(term), category)), 3
        FROM ({PART_DICTIONARY})""",
    "dictionary_category_filter": f"""SELECT DISTINCT lower(term) AS term FROM ({PART_DICTIONARY})
        WHERE category = 'custom'""",
    "dictionary_add_terms": f"""SELECT DISTINCT lower(term) AS term, category FROM (
        {PART_DICTIONARY} UNION ALL SELECT 'left handed bolt', 'soft'
        UNION ALL SELECT 'bolt', 'soft')""",
    "dictionary_members": f"""{distinct_words("documents")}
        AND word IN ({distinct_words("benchmark")})""",
    "dictionary_strangers": f"""{distinct_words("conversations")}
        AND word NOT IN ({distinct_words("benchmark")})""",
    "match_vocabulary": VOCABULARY,
    "longest_first_vocabulary": f"""SELECT DISTINCT lower(term) AS pattern,
        length(lower(term)) AS length FROM ({PART_DICTIONARY})""",
    "term_list_scan": """SELECT unnest(['custom', 'all']) AS category,
        count(DISTINCT lower(p_name)) AS terms,
        count(*) - count(DISTINCT lower(p_name)) AS duplicates_removed, 1 AS lists_loaded FROM part""",
    # Extraction
    "extract_terms_pattern": shown("job_id", DOCUMENTS),
    "extract_terms_join": shown("job_id", DOCUMENTS),
    "extract_terms_lookup": shown("job_id", DOCUMENTS),
    "extract_passages": PASSAGES,
    "extract_passages_join": PASSAGES,
    "extract_large_vocabulary": f"""
        WITH vocabulary AS ({distinct_words("benchmark")}),
        tokens AS (
            SELECT doc_id, word, min(place) AS place FROM (
                SELECT doc_id, unnest(split) AS word, generate_subscripts(split, 1) AS place FROM (
                    SELECT doc_id, regexp_split_to_array(lower(text), '[^{WORDS}]+') AS split
                    FROM documents))
            WHERE word IN (SELECT word FROM vocabulary) GROUP BY doc_id, word),
        per_document AS (
            SELECT doc_id, string_agg(word, '|' ORDER BY place) AS skills,
                CAST(count(*) AS INTEGER) AS skill_count FROM tokens GROUP BY doc_id)
        SELECT doc_id, coalesce(skills, '') AS skills, coalesce(skill_count, 0) AS skill_count
        FROM documents LEFT JOIN per_document USING (doc_id)""",
    "extract_longest_first": shown("job_id, p_name", PARTS),
    "extract_case_sensitive": shown(
        "doc_id", extracted("doc_id", "documents", clean=False, flags="")
    ),
    "extract_no_dedup": shown("job_id", extracted(JOB, "documents", dedup=False)),
    "extract_no_normalize": shown("job_id", extracted(JOB, "documents", variations={})),
    "extract_with_abbreviations": shown("job_id", extracted(JOB, "documents", abbreviate=True)),
    "extract_html": shown(
        "job_id", extracted("CAST(page_id AS VARCHAR) AS job_id", "pages", "html")
    ),
    # Frequencies
    "document_frequency": FREQUENCIES,
    "document_frequency_no_dedup": FREQUENCIES,
    "term_percentages": f"""SELECT skill, count, total_jds, round_even(percentage, 2) AS percentage
        FROM ({stats(DOCUMENTS, repr("all"))})""",
    "min_frequency": f"SELECT * FROM ({FREQUENCIES}) WHERE count >= 100",
    "top_terms": f"SELECT * EXCLUDE (role) FROM ({ranked(DOCUMENTS, 20, repr('all'))})",
    "dataset_summary": f"""
        SELECT count(*) AS total_jds_processed,
            len(list_distinct(flatten(list(skills)))) AS unique_skills_extracted,
            CAST(sum(skill_count) AS BIGINT) AS total_skill_extractions,
            round_even(avg(skill_count), 2) AS avg_skills_per_jd,
            round_even(median(skill_count), 2) AS median_skills_per_jd,
            max(skill_count) AS max_skills_in_single_jd,
            min(skill_count) AS min_skills_in_single_jd FROM ({DOCUMENTS})""",
    "group_summary": f"SELECT 'all' AS role, * FROM ({summary(DOCUMENTS)})",
    "extraction_stats": f"""
        SELECT count(*) FILTER (WHERE body <> '') AS total_extractions,
            CAST(sum(skill_count) AS BIGINT) AS total_skills_found,
            len(list_distinct(flatten(list(skills)))) AS unique_skills_count,
            array_to_string(list_sort(list_distinct(flatten(list(skills)))), '|') AS unique_skills
        FROM ({DOCUMENTS})""",
    # Roles
    "normalize_roles": f"""SELECT doc_id, role, regexp_replace(role, '[^\\p{{L}}\\p{{N}}]', '_', 'g')
        AS file_name FROM (SELECT doc_id, {role_case("role")} AS role
        FROM (SELECT doc_id, {UNEVEN_ROLE} AS role FROM documents))""",
    "role_term_stats": f"""SELECT role, skill, count, round_even(percentage, 2) AS percentage,
        CAST(CASE WHEN place <= 20 THEN place END AS INTEGER) AS rank, total_jds
        FROM ({stats(ROLES)})""",
    "role_summary": summary(ROLES, "role"),
    "role_top_terms": ranked(DOCUMENTS, 5, "source"),
    "part_role_top_terms": ranked(PARTS, 3, "p_type"),
    "single_group_fallback": ranked(DOCUMENTS, 10, "'all'"),
    # Rules
    "term_category": f"SELECT skill, {category('skill')} AS category FROM ({FREQUENCIES})",
    "term_variations": f"""SELECT skill, {spellings("skill")} AS variations FROM
        ({stats(extracted("doc_id", "documents", variations={}), repr("all"))})""",
    "global_rules": RULES_ONE,
    "role_rules": rules(ROLES, "role"),
    "core_terms": f"""SELECT role, skill, frequency, percentage
        FROM ({rules(PARTS, "p_type", frequency=2, core=0.1, top=20)}) WHERE is_core_skill""",
    # Sinks and sources
    "csv_roundtrip": f"""SELECT job_id, source AS job_title,
        nullif(array_to_string(skills, ', '), '') AS extracted_skills,
        CAST(skill_count AS VARCHAR) AS skill_count FROM ({DOCUMENTS})""",
    "csv_json_array_roundtrip": f"""SELECT job_id, text,
        coalesce(array_to_string(skills, '|'), '') AS skills FROM ({DOCUMENTS})""",
    "json_roundtrip": shown("job_id, source AS job_title", DOCUMENTS),
    "rules_jsonl_roundtrip": RULES_ONE,
    "role_rules_roundtrip": rules(ROLES, "role"),
    "dataset_analytics_roundtrip": f"""
        SELECT (SELECT count(*) FROM documents) AS total_jds_processed,
            CAST(sum(count) OVER () AS BIGINT) AS total_skill_extractions, skill, count,
            round_even(percentage, 2) AS percentage, place <= 5 AS ranked
        FROM ({stats(DOCUMENTS, repr("all"))})""",
    "role_analytics_roundtrip": f"""
        SELECT role, total_jds, unique_skills, avg_skills_per_jd, top_skills
        FROM ({summary(ROLES, "role")}) LEFT JOIN (
            SELECT role, string_agg(skill, '|' ORDER BY place) AS top_skills
            FROM ({stats(ROLES)}) WHERE place <= 3 GROUP BY role) USING (role)""",
    "na_values": """SELECT doc_id, CASE WHEN source = 'src3' THEN 'nap' END AS note, lang
        FROM documents""",
    "read_by_format": """SELECT format, doc_id, text FROM documents,
        (VALUES ('json'), ('parquet'), ('csv')) AS formats(format)""",
    "encoding_routing": "SELECT doc_id, text FROM documents",
    "row_count_estimate": "SELECT count(*) AS rows FROM orders",
    # End to end
    "extraction_result": shown(
        "job_id, doc_id",
        extracted("job_id, doc_id", f"(SELECT * FROM {numbered(GAPPY)} WHERE NOT {NO_TEXT})", abbreviate=True),
    ),
    "extraction_result_file_order": shown(
        "job_id, source", extracted("job_id, source", numbered("documents", "doc"))
    ),
    "extraction_report": f"""
        SELECT count(*) AS records_processed,
            (SELECT count(*) FROM {GAPPY} WHERE {NO_TEXT}) AS records_skipped,
            CAST(sum(skill_count) AS BIGINT) AS total_skills,
            len(list_distinct(flatten(list(skills)))) AS unique_skills,
            round_even(avg(skill_count), 2) AS avg_skills_per_jd FROM ({REPORT})""",
    # Streams
    "stream_extract": shown("job_id", DOCUMENTS),
    "stream_extract_join": shown("job_id", DOCUMENTS),
    "stream_document_frequency": FREQUENCIES,
    "roles_by_table": ranked(
        f"""SELECT p.*, coalesce(canonical, p_brand) AS role FROM ({PARTS}) p LEFT JOIN (
            SELECT p_brand, arg_min(p_type, p_partkey) AS canonical FROM part WHERE p_brand <> 'Brand#7' GROUP BY 1)
            USING (p_brand)""",
        4,
    ),
    "maps_from_files": MAPPED,
    "row_ids_json_files": f"SELECT doc_id, job_id FROM {numbered('documents')}",
    "row_ids_workbooks": shown(
        "job_id, p_partkey, p_type",
        extracted(
            "job_id, CAST(p_partkey AS VARCHAR) AS p_partkey, nullif(p_type, 'PROMO') AS p_type, p_name",
            """(SELECT *, 'jd_' || lpad(CAST(number AS VARCHAR),
                    CAST(greatest(3, length(CAST(total AS VARCHAR))) AS INTEGER), '0') AS job_id
                FROM (SELECT *, row_number() OVER (ORDER BY p_partkey) AS number, count(*) OVER () AS total FROM part))""",
            "p_name",
            terms=PART_TERMS,
            variations=PART_VARIATIONS,
        ),
    ),
    "stream_row_ids": f"SELECT doc_id, job_id FROM {numbered('documents')}",
    "stream_extract_numbered": shown("job_id, doc_id", extracted("job_id, doc_id", numbered("documents"))),
    "stream_top_terms": f"SELECT * EXCLUDE (role) FROM ({ranked(DOCUMENTS, 20, repr('all'))})",
    "stream_extract_csv": shown(
        "job_id, text",
        extracted(
            f"{JOB}, text",
            """(SELECT doc_id, 'say ""license"", now' || chr(10) || text AS text
                FROM documents WHERE source <> 'src1')""",
        ),
    ),
    "csv_edge_spaces_roundtrip": f"""SELECT job_id,
        '  ' || substr(text, 1, 20) || ' ' || chr(9) || ' ' AS job_title FROM ({DOCUMENTS})""",
    "csv_mixed_headers": """SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN lang END AS lang, source,
        CASE WHEN doc_id % 2 = 1 THEN n_chars END AS n_chars FROM documents""",
    "run_extraction_rules": f"""
        SELECT * FROM ({rules(DOCUMENTS, repr("all"), frequency=2, core=0.5, top=20)})
        UNION ALL SELECT * FROM ({rules(DOCUMENTS, "source", frequency=2, core=0.5, top=20)})""",
    "run_extraction_analytics": f"""
        SELECT role, total_jds, unique_skills, avg_skills_per_jd, coalesce(top_skills, '') AS top_skills
        FROM (
            SELECT 'all' AS role, * FROM ({summary(DOCUMENTS)})
            UNION ALL SELECT * FROM ({summary(DOCUMENTS, "source")})
        ) LEFT JOIN (
            SELECT role, string_agg(skill || ':' || count || ':' || CAST(round_even(percentage, 2) AS DECIMAL(20, 2)),
                '|' ORDER BY place) AS top_skills
            FROM (SELECT * FROM ({stats(DOCUMENTS, repr("all"))}) UNION ALL SELECT * FROM ({stats(DOCUMENTS, "source")}))
            WHERE place <= 20 GROUP BY role) USING (role)""",
    "run_extraction_roundtrip": shown(
        f"""job_id, source AS job_title, {cleaned("text")} AS processed_text,
            CAST(skill_count AS INTEGER) AS csv_count""",
        DOCUMENTS,
    ),
}
