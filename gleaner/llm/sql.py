"""SQL twins of this package's queries, where SQL can express them."""

from __future__ import annotations

from gleaner.llm.mixing import MOST, PART, SEED
from gleaner.llm.queries import WEIGHTS

_GIVEN = ", ".join(f"('{source}', {weight}::DOUBLE)" for source, weight in WEIGHTS.items())

#: One bit of a CRC-32: eight of them take in a byte.
_BITS = "list_reduce([xor(crc, byte), 0, 0, 0, 0, 0, 0, 0, 0], lambda c, z: xor(c >> 1, (c & 1) * 3988292384))"
_CRC32 = f"""xor(4294967295, list_reduce(
    list_concat([4294967295], list_transform(string_split(doc_id::VARCHAR, ''), lambda d: ord(d)::BIGINT)),
    lambda crc, byte: {_BITS}))"""


def _field(value: str) -> str:
    return f"coalesce(strlen({value}::VARCHAR) || ':' || {value}::VARCHAR, '-')"


def _leaf(n_chars: str) -> str:
    fields = ("doc_id", "source", "lang", n_chars, "text")
    return f"sha256({' || '.join(map(_field, fields))})"


def _tree(name: str, leaves: str) -> str:
    """Nodes (of, level, idx, n, h, sibling) of the binary trees over ``leaves`` (of, idx, n, h)."""
    sibling = """CASE WHEN n = 1 THEN NULL WHEN idx % 2 = 0 THEN 'R' || coalesce(lead(h) OVER w, '')
        ELSE 'L' || lag(h) OVER w END"""
    window = "WINDOW w AS (PARTITION BY of ORDER BY idx)"
    return f"""{name} AS (
            SELECT of, 0 AS level, idx, n, h, {sibling} AS sibling FROM {leaves} {window}
            UNION ALL
            SELECT of, level, idx, n, h, {sibling} AS sibling FROM (
                SELECT of, level + 1 AS level, idx // 2 AS idx, (n + 1) // 2 AS n, sha256(h || substr(sibling, 2)) AS h
                FROM {name} WHERE n > 1 AND idx % 2 = 0) {window}
        )"""


#: DuckDB has no replacement for Spark's xxhash64 and shuffle, no crc32 and no tokenizer: the queries that
#: return such values have no twin and are tested against brute force.
ORACLE = {
    "op7_exact_topk": """
        WITH raw AS (
            SELECT vec_id, i, embedding[i]::DOUBLE AS x
            FROM (SELECT vec_id, embedding, unnest(range(1, len(embedding) + 1)) AS i FROM embeddings)
        ), parts AS (
            SELECT vec_id, i, floor(1024 * x)::BIGINT AS x FROM raw
            WHERE vec_id NOT IN (SELECT vec_id FROM raw WHERE x IS NULL OR NOT isfinite(x))
        ), scored AS (
            SELECT q.vec_id AS query_id, c.vec_id, sum(q.x * c.x)::BIGINT AS score
            FROM parts q JOIN parts c ON q.i = c.i AND q.vec_id <> c.vec_id
            WHERE q.vec_id % 100 = 0 GROUP BY 1, 2
        ), ranked AS (
            SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank FROM scored
        )
        SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 10
    """,
    "op9_mixing": f"""
        WITH RECURSIVE given(source, weight) AS (VALUES {_GIVEN}),
        sizes AS (SELECT source, count(*) AS n FROM documents GROUP BY source),
        weighed AS (
            SELECT s.source, n, coalesce(g.weight, 1.0::DOUBLE) AS weight
            FROM sizes s LEFT JOIN given g ON s.source = g.source
        ), rates AS (
            SELECT source, weight / (SELECT sum(weight) FROM weighed)
                * (SELECT sum(n) FROM weighed)::DOUBLE * 1.0::DOUBLE / n AS rate FROM weighed
        ), parts AS (
            SELECT source, rate, greatest(1, ceil(rate / {PART})::INT) AS parts FROM rates
        ), sums(source, parts, mean, k, term, total) AS (
            SELECT source, parts, rate / parts, 0, exp(-(rate / parts)), exp(-(rate / parts)) FROM parts
            UNION ALL
            SELECT source, parts, mean, k + 1, term * mean / (k + 1), total + term * mean / (k + 1)
            FROM sums WHERE k < {MOST} - 1
        ), drawn AS (
            SELECT doc_id, d.source, part,
                ('0x' || substr(md5('{SEED}:draw:' || coalesce(doc_id::VARCHAR, 'null') || ':' || part), 1, 13))::BIGINT::DOUBLE
                    / {1 << 52}::DOUBLE AS u
            FROM documents d
            JOIN (SELECT source, unnest(range(1, parts + 1)) AS part FROM parts) p ON d.source IS NOT DISTINCT FROM p.source
        ), copies AS (
            SELECT doc_id, source, sum((
                SELECT count(*) FROM sums s WHERE s.source IS NOT DISTINCT FROM drawn.source AND drawn.u >= s.total
            ))::BIGINT AS copies
            FROM drawn GROUP BY doc_id, source
        ), repeated AS (
            SELECT doc_id, source, unnest(range(0, copies)) AS copy FROM copies
        )
        SELECT r.doc_id, r.source, p.rate, r.copy,
            md5('{SEED}:place:' || coalesce(r.doc_id::VARCHAR, 'null') || ':' || r.copy) AS shuffle_key
        FROM repeated r JOIN rates p ON r.source IS NOT DISTINCT FROM p.source
    """,
    "op11_hard_negatives": """
        WITH given AS (
            SELECT vec_id, embedding, (CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END)::BIGINT AS label
            FROM embeddings WHERE label IS NOT NULL AND vec_id IS NOT NULL AND embedding IS NOT NULL
        ), raw AS (
            SELECT vec_id, label, i, embedding[i]::DOUBLE AS x
            FROM (SELECT vec_id, label, embedding, unnest(range(1, len(embedding) + 1)) AS i FROM given)
        ), parts AS (
            SELECT vec_id, label, i, floor(256 * x)::BIGINT AS x FROM raw
            WHERE vec_id NOT IN (SELECT vec_id FROM raw WHERE x IS NULL OR NOT isfinite(x))
        ), scored AS (
            SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same, sum(a.x * c.x)::BIGINT AS score
            FROM parts a JOIN parts c ON a.i = c.i AND a.vec_id <> c.vec_id
            WHERE a.vec_id % 100 = 0 GROUP BY 1, 2, 3
        ), positives AS (
            SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM (
                SELECT *, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) AS place
                FROM scored WHERE same)
            WHERE place <= 5
        ), ranked AS (
            SELECT s.anchor_id, positive_id, positive_score, s.vec_id AS negative_id, s.score AS negative_score,
                row_number() OVER (PARTITION BY s.anchor_id, positive_id ORDER BY s.score DESC, s.vec_id)::INT AS rank
            FROM positives p JOIN scored s ON p.anchor_id = s.anchor_id AND NOT s.same
                AND 30 * positive_score <= 100 * s.score AND 100 * s.score <= 90 * positive_score
        )
        SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM ranked WHERE rank <= 10
    """,
    "op12_merkle_manifest": f"""
        WITH RECURSIVE given AS (
            SELECT doc_id, coalesce('=' || lang, '') AS of, {_leaf("n_chars")} AS leaf,
                {_leaf(f"(n_chars + CASE WHEN {_CRC32} % 7 = 0 THEN 1 ELSE 0 END)")} AS now
            FROM documents
        ), leaves AS (
            SELECT *, leaf AS h, row_number() OVER (PARTITION BY of ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx,
                count(*) OVER (PARTITION BY of) AS n FROM given
        ), {_tree("nodes", "leaves")},
        subroots AS (
            SELECT of AS lang, '' AS of, h, row_number() OVER (ORDER BY of) - 1 AS idx, count(*) OVER () AS n
            FROM nodes WHERE n = 1
        ), {_tree("tops", "subroots")},
        upper AS (
            SELECT s.lang AS of, s.h AS subroot, (SELECT h FROM tops WHERE n = 1) AS root,
                list(t.sibling ORDER BY t.level) FILTER (WHERE t.n > 1) AS rest
            FROM subroots s JOIN tops t ON t.idx = s.idx >> t.level GROUP BY ALL
        ), proved AS (
            SELECT l.doc_id, l.leaf, l.now, u.subroot, u.root,
                list_concat(coalesce(list(t.sibling ORDER BY t.level) FILTER (WHERE t.n > 1), []), coalesce(any_value(u.rest), [])) AS path
            FROM leaves l JOIN nodes t ON t.of = l.of AND t.idx = l.idx >> t.level JOIN upper u ON u.of = l.of
            GROUP BY l.doc_id, l.leaf, l.now, l.of, l.idx, u.subroot, u.root
        ), done AS (
            SELECT *, sha256(array_to_string(list_transform(path, lambda s: substr(s, 2)), '')) AS proof_sha256,
                list_reduce(list_concat([now], path), lambda h, s: sha256(
                    CASE WHEN s[1] = 'L' THEN substr(s, 2) || h ELSE h || substr(s, 2) END)) AS folded_root
            FROM proved
        )
        SELECT doc_id, leaf, subroot, root, proof_sha256, folded_root, folded_root = root AS verified FROM done
    """,
}
