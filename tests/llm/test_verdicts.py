"""Verdicts on whole tables against plain models: quality rules, copies among them, and URL rules."""

import hashlib
import random
from collections import Counter, defaultdict
from itertools import combinations

import pytest
from gleaner.llm import quality_rules as rules
from gleaner.llm import url_filter
from gleaner.llm.queries import QUERIES
from pyspark.sql import functions as F
from tests.llm.brute import rule_stats


def judged_by_loops(rows):
    """kept by (doc_id), with every pair of a host's candidates compared."""
    hosts: dict = defaultdict(dict)
    for _, text, host in rows:
        hosts[host or ""][hashlib.md5((text or "").encode()).digest()] = (text or "").encode()
    depleted = set()
    for host, contents in hosts.items():
        lines = {}
        for digest, raw in contents.items():
            own = Counter()
            for line in raw.split(b"\n"):
                if line.split():
                    own[rules.line_hash(line.split())] += len(line.split())
            lines[digest] = own

        def frequent(digests, lines=lines, total=len(contents)):
            counts = Counter(h for d in digests for h in lines[d])
            return {h for h, n in counts.items() if n > rules.MIN_DOCUMENTS and n > total * rules.MIN_SHARE}

        often = frequent(lines)
        sketches = {}
        for digest, own in lines.items():
            whole, left = sum(own.values()), sum(n for h, n in own.items() if h not in often)
            if left * 100 <= whole * (100 - rules.FREQUENT_PERCENT) and whole:
                sketches[digest] = rules.sketch(contents[digest].split())
        copied = set()
        order = sorted(sketches)
        for i, digest in enumerate(order):
            for earlier in order[:i]:
                apart = sum(bin((a ^ b) & (2**64 - 1)).count("1") for a, b in zip(sketches[digest], sketches[earlier], strict=True))
                if apart <= rules.COPY_BITS:
                    copied.add(digest)
                    break
        lost = often & frequent([d for d in lines if d not in copied])
        for digest, own in lines.items():
            whole, left = sum(own.values()), sum(n for h, n in own.items() if h not in lost)
            if left < whole and (left < rules.LEFT_WORDS or left * 100 < whole * rules.LEFT_PERCENT):
                depleted.add((host, digest))
    out = {}
    for i, text, host in rows:
        n_words, *_, repeated = rule_stats(text)
        failed = n_words < 10 or 100 * repeated > 20 * n_words
        out[i] = not failed and (host or "", hashlib.md5((text or "").encode()).digest()) not in depleted
    return out


@pytest.mark.parametrize("folder", ["/root/testdata/sf0.01", "/root/testdata/sf0.1"])
def test_kept_documents_of_a_whole_table(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    rows = [tuple(r) for r in docs.select("doc_id", "text", "source").collect()]
    made = {r.doc_id: r.kept for r in QUERIES["op4_quality_rules"](spark, folder).collect()}
    assert made == judged_by_loops(rows)


def test_kept_documents_of_hosts_with_templates(spark):
    """Menus that many pages share, pages of little else, and groups of edited copies."""
    draw = random.Random(5)
    prose = [f"w{draw.randrange(4000)}" for _ in range(40_000)]
    menu = [" ".join(f"menu{k}x{j}" for j in range(8)) for k in range(6)]
    rows = []
    for i in range(260):
        own = " ".join(prose[i * 70 : i * 70 + draw.choice([6, 8, 60])])
        rows.append((len(rows), "\n".join([*menu[: draw.choice([0, 3, 6])], own]), f"host{i % 2}"))
    for group in range(4):
        text = prose[20_000 + group * 300 : 20_300 + group * 300]
        for _ in range(30):
            edited = list(text)
            for _ in range(draw.randrange(1, 4)):
                edited[draw.randrange(300)] = f"edit{draw.randrange(10**6)}"
            lines = [" ".join(edited[k : k + 25]) for k in range(0, 300, 25)]
            rows.append((len(rows), "\n".join(lines), "host0"))
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    made = {r.doc_id: r.kept for r in rules.quality_rules(docs, ["doc_id"]).collect()}
    assert made == judged_by_loops(rows)
    assert all(made[i] for i in range(260, 380)) and 0 < sum(not k for k in made.values()) < 200


def test_copies_are_found_among_many_others(spark):
    """Each group of copies, with some words edited in each, keeps one document that is nobody's copy."""
    draw = random.Random(11)
    vocabulary = [f"v{i}" for i in range(3000)]
    rows, group_of = [], {}

    def add(text, group):
        digest = hashlib.md5(text.encode()).digest()
        rows.append(("h", bytearray(digest), rules.sketch(text.encode().split())))
        group_of[digest] = group

    for group in range(12):
        base = [draw.choice(vocabulary) for _ in range(200)]
        for _ in range(draw.randrange(15, 60)):
            own = list(base)
            for _ in range(draw.randrange(0, 4)):
                own[draw.randrange(200)] = draw.choice(vocabulary)
            add(" ".join(own), group)
    for _ in range(3000):
        add(" ".join(draw.choice(vocabulary) for _ in range(150)), None)
    df = spark.createDataFrame(rows, "host string, digest binary, sketch array<long>")
    copied = {bytes(r.digest) for r in rules.copies(df).collect()}
    assert not any(group_of[d] is None for d in copied)
    members = Counter(g for g in group_of.values() if g is not None)
    found = Counter(group_of[d] for d in copied)
    recall = sum(found.values()) / (sum(members.values()) - len(members))
    assert recall >= 0.98
    assert all(found[g] < members[g] for g in members)


def blocked_by_subsets(token_sets, labelled, min_support, min_confidence):
    """Which token sets hold a combination that is frequent and confident enough, by counting all combinations."""
    rows = len(labelled)
    counts, hits = Counter(), Counter()
    for tokens, blocked in labelled:
        for size in range(1, len(tokens) + 1):
            for part in combinations(sorted(tokens), size):
                counts[part] += 1
                hits[part] += blocked
    good = {
        part: hits[part] / n
        for part, n in counts.items()
        if hits[part] >= max(url_filter.MIN_ROWS, min_support * rows) and hits[part] / n >= min_confidence
    }
    best = {}
    for tokens in token_sets:
        held = [good[p] for size in range(1, len(tokens) + 1) for p in combinations(sorted(tokens), size) if p in good]
        best[tokens] = max(held, default=None)
    return best


def test_url_verdicts_of_a_whole_table(spark):
    """Labels that depend on two tokens of a URL together, with exceptions, over all pages."""
    folder = "/root/testdata/sf0.1"
    pages = spark.read.parquet(f"{folder}/pages.parquet")
    parsed = pages.select(
        "page_id", "url", url_filter.host(F.col("url")).alias("host"), url_filter.path(F.col("url")).alias("path")
    )
    parsed = parsed.withColumn("tokens", url_filter.tokens(F.col("url"), F.col("host"), F.col("path")))
    rows = parsed.collect()
    common = [t for t, _ in Counter(t for r in rows for t in r.tokens).most_common(40)]
    draw, pairs = random.Random(2), []
    while len(pairs) < 4:
        pair = set(draw.sample(common, 2))
        n = sum(pair <= set(r.tokens) for r in rows)
        if 30 <= n <= len(rows) // 6:
            pairs.append(pair)
    marks = []
    for r in rows:
        bad = any(pair <= set(r.tokens) for pair in pairs)
        marks.append((r.page_id, int((draw.random() < 0.1) if bad else (draw.random() < 0.97))))
    labels = spark.createDataFrame(marks, "doc_id long, quality int")
    made = url_filter.judged(pages, labels).collect()

    label = dict(marks)
    labelled = [(frozenset(r.tokens), label[r.page_id] == 0) for r in rows if r.tokens]
    best = blocked_by_subsets({frozenset(r.tokens) for r in rows}, labelled, url_filter.MIN_SUPPORT, url_filter.MIN_CONFIDENCE)
    given = {r.page_id: r for r in made}
    assert len(given) == len(rows)
    learnt = 0
    for r in rows:
        mine, confidence = given[r.page_id], best[frozenset(r.tokens)]
        assert (mine.confidence is None) == (confidence is None), (r.url, mine.confidence, confidence)
        assert confidence is None or mine.confidence == pytest.approx(confidence)
        if mine.rule is None:
            assert mine.verdict == ("allow" if confidence is None else "block")
            learnt += mine.verdict == "block"
    assert learnt > 50


def test_url_edge_cases(spark):
    """Repeated pages, null ids and URLs, a very long URL, and other columns of the same names."""
    long = "http://a.example.org/" + "x/" * 20_000 + "?q=" + "y" * 50_000
    rows = [(1, long, "h"), (1, long, "h"), (None, "http://x.com/de/1", "h"), (3, None, None), (4, "no scheme", "h"), (5, "", "h")]
    pages = spark.createDataFrame(rows, "page_id long, url string, host string").withColumn("tokens", F.lit("t"))
    labels = spark.createDataFrame([(1, 0), (None, 0), (3, None)], "doc_id long, quality int")
    made = Counter((r.page_id, r.host, r.rule, r.verdict) for r in url_filter.judged(pages, labels).collect())
    assert made == Counter(
        [(1, "a.example.org", "org/", "allow")] * 2
        + [(None, "x.com", "com/de/", "block"), (3, "", None, "allow"), (4, "", None, "allow"), (5, "", None, "allow")]
    )
    assert url_filter.judged(pages.limit(0), labels).collect() == []
