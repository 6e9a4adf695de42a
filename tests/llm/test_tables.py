"""Operators on whole tables: near duplicates, substrings, packing, sharding, mixing, top-k and URLs."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from gleaner.llm import packing, queries, sharding, simhash, substring_dedup, topk, url_filter
from gleaner.llm.components import components
from gleaner.llm.mixing import mixed
from gleaner.llm.queries import QUERIES, WEIGHTS
from gleaner.llm.sql import ORACLE
from hypothesis import given, settings
from hypothesis import strategies as st
from tests.compare import connect, difference
from tests.llm.brute import DOCUMENTS, awkward_rows, classes, crc32_ids, fingerprint, words
from tokenizers import Tokenizer

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def awkward(spark):
    return spark.createDataFrame(awkward_rows(), DOCUMENTS)


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{FOLDER}/documents.parquet")


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_twins(spark, name):
    assert difference(spark, FOLDER, name, QUERIES, ORACLE, connect(FOLDER)) is None


# Near duplicates


def test_components(spark):
    links = [(5, 4), (4, 3), (3, 2), (9, 8), (8, 9), (7, 7), (20, 2)] + [(100 + i, 101 + i) for i in range(60)]
    made = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert made == {5: 2, 4: 2, 3: 2, 2: 2, 20: 2, 9: 8, 8: 8} | {100 + i: 100 for i in range(61)}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


@pytest.mark.parametrize("rows", [1, 10**5, 10**7, 10**9, 10**11])
def test_segments_find_all_links(rows):
    parts = simhash.segments(rows)
    assert sum(length for _, length, _ in parts) == 64
    assert sum(radius + 1 for _, _, radius in parts) == simhash.DISTANCE + 1


def test_fingerprint_components_of_clusters(spark, monkeypatch):
    """Large clusters whose members are linked by chains, with heavy keys."""
    monkeypatch.setattr(simhash, "HEAVY", 4)
    draw = random.Random(3)
    points = set()
    for _ in range(12):
        centre = draw.getrandbits(64)
        for _ in range(60):
            near = centre
            for _ in range(draw.randrange(0, 6)):
                near ^= 1 << draw.randrange(64)
            points.add(near)
    points = sorted(points)
    signed = [p - (1 << 64) if p >> 63 else p for p in points]
    df = spark.createDataFrame([(p, 1) for p in signed], "bits long, documents long")
    made = {r.bits: r.component for r in simhash.fingerprint_components(df).collect()}
    want = classes(list(range(len(points))), points, simhash.DISTANCE)
    groups = defaultdict(set)
    for s, w in zip(signed, want, strict=True):
        groups[w].add(made[s])
    assert all(len(g) == 1 for g in groups.values())
    assert len({next(iter(g)) for g in groups.values()}) == len(groups)


def test_simhash_of_whole_tables(spark, docs, awkward):
    for df, made in (
        (docs, QUERIES["op6_simhash"](spark, FOLDER)),
        (awkward, simhash.simhash_components(awkward)),
    ):
        rows = [(r.doc_id, fingerprint(r.text)) for r in df.select("doc_id", "text").collect()]
        want = classes([r[0] for r in rows], [r[1] for r in rows], 4)
        expected = Counter((i, f"{f:016x}", c) for (i, f), c in zip(rows, want, strict=True))
        assert Counter(map(tuple, made.collect())) == expected
    assert simhash.simhash_components(awkward.limit(0)).collect() == []


# Substrings


def brute_substrings(rows, length):
    first: dict = {}
    for i, text in sorted(rows, key=lambda r: (r[0] is None, r[0])):
        own = words(text)
        for p in range(len(own) - length + 1):
            first.setdefault(tuple(own[p : p + length]), i)
    out = []
    for i, text in rows:
        own = words(text)
        gone = set()
        for p in range(len(own) - length + 1):
            found = first[tuple(own[p : p + length])]
            if found is not None and (i is None or found < i):
                gone.update(range(p, p + length))
        kept = " ".join(w for p, w in enumerate(own) if p not in gone)
        out.append((i, len(own), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return Counter(out)


def test_substrings_of_whole_tables(spark, docs, awkward):
    for df, made in ((docs, QUERIES["op10_substring_dedup"](spark, FOLDER)), (awkward, substring_dedup.substring_dedup(awkward))):
        rows = [tuple(r) for r in df.select("doc_id", "text").collect()]
        assert Counter(map(tuple, made.collect())) == brute_substrings(rows, 50)
    assert substring_dedup.substring_dedup(awkward.limit(0)).collect() == []


@pytest.mark.parametrize("length", [2, 5, 8, 11])
def test_substrings_with_few_words(spark, length):
    draw = random.Random(length)
    passage = [draw.choice("abcdefgh") for _ in range(40)]
    rows = []
    for i in range(80):
        own = [draw.choice("abcdefghijkl") for _ in range(draw.randrange(0, 40))]
        at = draw.randrange(0, 30)
        own += passage[at : at + draw.randrange(0, 25)] + [draw.choice("abc") for _ in range(5)]
        rows.append((i % 70, " ".join(own)))
    rows = list({r[0]: r for r in rows}.values())
    df = spark.createDataFrame(rows, "doc_id long, text string")
    made = substring_dedup.substring_dedup(df, min_words=length).collect()
    assert Counter(map(tuple, made)) == brute_substrings(rows, length)


# Packing


def check_packing(df, made, ids):
    want = Counter()
    for i, text in df.select("doc_id", "text").collect():
        own = [*ids(text), 1]
        for piece, start in enumerate(range(0, len(own), 4096)):
            part = own[start : start + 4096]
            want[i, piece, start, len(part), crc32_ids(part)] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in made) == want
    bins = defaultdict(list)
    for r in made:
        bins[r.sequence_id].append((r.offset, r.length))
    for own in bins.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= 4096
    return len(bins)


def test_packing_of_whole_tables(spark, docs, awkward):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))

    def ids(text):
        return tokenizer.encode(text or "", add_special_tokens=False).ids

    made = QUERIES["op2_best_fit_packing"](spark, FOLDER).collect()
    bins = check_packing(docs, made, ids)
    assert bins <= sum(r.length for r in made) / 4096 * 1.02 + 1
    check_packing(awkward, packing.pack(awkward).collect(), ids)
    assert packing.pack(awkward.limit(0)).collect() == []


def test_sequences_hold_the_tokens(spark, docs):
    """What is written are the ids of the documents, and all of them can be put together again."""
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    found, sizes = defaultdict(dict), []
    for r in packing.pack_sequences(docs).collect():
        ids = np.frombuffer(r.ids, "<u2").tolist()
        sizes.append(len(ids))
        assert len(ids) == sum(p.length for p in r.pieces) <= 4096
        for p in r.pieces:
            found[p.id][p.start] = ids[p.offset : p.offset + p.length]
    for r in docs.collect():
        whole = [i for _, part in sorted(found[r.doc_id].items()) for i in part]
        assert whole == [*tokenizer.encode(r.text, add_special_tokens=False).ids, 1]
    assert len(sizes) <= sum(sizes) / 4096 * 1.02 + 1


def test_packing_in_many_groups(spark, docs):
    found = packing.pieces(docs, "doc_id", "text")
    made = packing.sequences(found, group_pieces=30, group_tokens=20_000).collect()
    assert len({r.sequence_id for r in made}) == len(made)
    assert Counter((p.id, p.start, p.length) for r in made for p in r.pieces) == Counter(
        (r.id, r.start, r.length) for r in found.collect()
    )


@settings(max_examples=100, deadline=None)
@given(st.text(st.sampled_from("aB'stéßÉ.,!&\u0301 \n\t\u00a0\u2003\x1c9日<|endoftext|>İΣ.!"), max_size=40))
def test_ids_by_words_are_those_of_the_text(text):
    path = public_tokenizers.path("word_bpe_49k.json")
    whole = TOKENIZERS.setdefault("t", Tokenizer.from_file(path)).encode(text, add_special_tokens=False).ids
    made = TOKENIZERS.setdefault("w", packing.WordIds(path))
    assert np.frombuffer(made([text])[0], made.kind).tolist() == whole


TOKENIZERS: dict = {}


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 20), max_size=60))
def test_sum_of_squares(lengths):
    """Each step has the least sum of squares of all its choices."""
    bins, places = packing.sum_of_squares(np.array(lengths, np.int64), 20)
    filled: dict = {}
    for length, where, place in zip(lengths, bins.tolist(), places.tolist(), strict=True):
        def total(after):
            return sum(n * n for n in Counter(20 - f for f in after.values() if f < 20).values())

        costs = [total({**filled, b: f + length}) for b, f in filled.items() if f + length <= 20]
        costs.append(total({**filled, "new": length}))
        assert place == filled.get(where, 0)
        filled[where] = place + length
        assert filled[where] <= 20 and total(filled) == min(costs)


# Sharding


def test_sharding_of_whole_tables(spark, docs, awkward):
    for df, made in ((docs, QUERIES["op8_sharding"](spark, FOLDER).collect()), (awkward, sharding.shard_digests(awkward).collect())):
        rows = [(r.doc_id, (r.text or "").encode()) for r in df.select("doc_id", "text").collect()]
        assert Counter((r.doc_id, r["size"], r.text_crc32) for r in made) == Counter((i, len(t) + 1, zlib.crc32(t)) for i, t in rows)
        slots = defaultdict(list)
        for r in made:
            slots[r.shard].append(r.slot)
            assert r.law == "rows" and r.grown_shard is None
        assert all(sorted(s) == list(range(len(s))) for s in slots.values())
        sizes = [len(slots[s]) for s in range(8)]
        assert max(sizes) - min(sizes) <= 1
    assert sharding.shard_digests(awkward.limit(0)).collect() == []


def test_shuffle_is_seeded_and_mixes(spark):
    rows = spark.range(1000).toDF("id")
    def order(seed):
        made = sharding.shuffled(rows, ["id"], seed, bucket_rows=100).orderBy("position").collect()
        assert [r.position for r in made] == list(range(1000))
        return [r.id for r in made]

    one, again, other = order(1), order(1), order(2)
    assert one == again and one != other and sorted(one) == list(range(1000))
    assert abs(np.corrcoef(one, range(1000))[0, 1]) < 0.15


def test_written_shards(spark, docs, tmp_path):
    sharding.write_shards(docs, str(tmp_path / "shards"))
    back = spark.read.parquet(str(tmp_path / "shards"))
    assert sorted(r.doc.doc_id for r in back.collect()) == sorted(r.doc_id for r in docs.collect())
    counts = [r["count"] for r in back.groupBy("shard").count().collect()]
    assert len(counts) == 8 and max(counts) - min(counts) <= 1


def test_digests_are_those_of_written_documents(spark, docs, awkward, monkeypatch):
    """Very long texts and hot copies go through small buckets; places are those of the files."""
    written, write = [], sharding.write_shards
    monkeypatch.setattr(sharding, "write_shards", lambda docs, path, *rest: (written.append(path), write(docs, path, *rest)))
    monkeypatch.setattr(sharding.shuffled, "__defaults__", (sharding.SEED, None, 64, 1 << 20))
    hot = docs.limit(1).crossJoin(spark.range(500)).drop("id")
    df = docs.unionByName(hot).unionByName(awkward.select(docs.columns))
    made = Counter(map(tuple, sharding.shard_digests(df).select("doc_id", "size", "text_crc32", "shard", "slot").collect()))
    files = spark.read.parquet(written[0]).select("doc.*", "shard", "slot").collect()
    assert Counter(tuple(r)[:5] for r in files) == Counter(map(tuple, df.collect()))
    rows = ((r.doc_id, (r.text or "").encode(), r.shard, r.slot) for r in files)
    assert Counter((i, len(t) + 1, zlib.crc32(t), shard, slot) for i, t, shard, slot in rows) == made
    assert {(shard, slot) for *_, shard, slot in made} == {(p % 8, p // 8) for p in range(df.count())}


# Mixing


def test_mixing_reaches_the_weights(spark, awkward):
    rows = [(i, "a" if i % 10 else "b") for i in range(20_000)]
    df = spark.createDataFrame(rows, "doc_id long, source string")
    made = mixed(df, {"a": 1.0, "b": 3.0}).select("row.*", "copy").collect()
    drawn = Counter(r.source for r in made)
    assert drawn["b"] / len(made) == pytest.approx(0.75, abs=0.02)
    assert len(made) == pytest.approx(20_000, rel=0.05)
    copies = Counter(r.doc_id for r in made if r.source == "b")
    counts = np.array([copies[i] for i in range(0, 20_000, 10)])
    assert counts.var() == pytest.approx(counts.mean(), rel=0.15)
    large = mixed(df, {"a": 0.001, "b": 3.0}, epochs=8.0).select("row.*").groupBy("source").count().collect()
    assert {r.source: r["count"] for r in large}["b"] == pytest.approx(160_000, rel=0.02)
    own = mixed(awkward, WEIGHTS, epochs=20.0).select("row.*")
    assert own.columns == awkward.columns and {r.source for r in own.collect()} == {"a", "b", "c", None}
    assert mixed(awkward.limit(0), WEIGHTS).collect() == []


def test_rows_of_one_id_are_drawn_one_by_one(spark):
    """A null id and a shared id in a third of the rows each, some rows equal."""
    rows = [((None, 5, i)[i % 3], "a" if i % 2 else "b", f"text {i // 12}") for i in range(6000)]
    df = spark.createDataFrame(rows, "doc_id long, source string, text string")
    made = mixed(df, {"a": 0.5, "b": 1.5}).collect()
    for name in (None, 5):
        own = [r for r in made if r.row.doc_id == name]
        assert {s: sum(r.row.source == s for r in own) for s in "ab"} == {"a": pytest.approx(500, rel=0.15), "b": pytest.approx(1500, rel=0.1)}
    assert len({r.shuffle_key for r in made}) == len(made)


# Top-k


def test_topk_on_awkward_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0]), (100, [1.0, 2.0]), (1, [1.0, 2.0]), (2, [2.0, 1.0]), (2, [2.0, 1.0]), (3, [nan, 1.0])]
    rows += [(4, None), (5, [inf]), (6, [None, 1.0]), (7, []), (8, [-1.0]), (None, [9.0, 9.0]), (200, [0.0, 1e30]), (9, [0.5, 1e30, 3.0])]
    df = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<double>, score string")
    made = topk.exact_topk(df, df.filter("vec_id % 100 = 0"), k=4).orderBy("query_id", "rank").collect()
    held = [(i, [min(int(np.floor(1024 * x)), (1 << 63) - 1) for x in v]) for i, v in rows if i not in (None, 3, 4, 5, 6)]
    for q in (0, 100, 200):
        asked = dict(held)[q]
        all_scores = [(sum(a * b for a, b in zip(asked, v, strict=False)), i) for i, v in held if i != q]
        all_scores = [(min(max(s, -(1 << 63)), (1 << 63) - 1), i) for s, i in all_scores]
        want = sorted(all_scores, key=lambda s: (-s[0], s[1]))[:4]
        assert [(r.score, r.vec_id) for r in made if r.query_id == q] == want
    assert topk.exact_topk(df.limit(0), df.limit(0)).collect() == []


def test_topk_over_blocks(spark, monkeypatch):
    monkeypatch.setattr(topk, "CANDIDATES", 37)
    monkeypatch.setattr(topk, "QUERIES", 5)
    draw = np.random.default_rng(5)
    vectors = draw.integers(-2, 3, size=(400, 6)).astype(float)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>")
    made = topk.exact_topk(df, df.filter("vec_id % 20 = 0"), scale=1).collect()
    whole = vectors.astype(int) @ vectors.astype(int).T
    for q in range(0, 400, 20):
        want = sorted((-whole[q, i], i) for i in range(400) if i != q)[:10]
        got = sorted((r.rank, r.vec_id, r.score) for r in made if r.query_id == q)
        assert got == [(n, i, -s) for n, (s, i) in enumerate(want, 1)]


# URLs


def brute_judged(url):
    url = url or ""
    if "://" not in url:
        return "", "", None
    rest = url.split("://", 1)[1]
    cut = min((rest.find(c) for c in "/?#" if c in rest), default=len(rest))
    host, path = rest[:cut], rest[cut:]
    path = path[: min((path.find(c) for c in "?#" if c in path), default=len(path))]
    host = "".join(c.lower() if c.isascii() else c for c in host)
    fits = []
    for _, rule in url_filter.RULES:
        own, _, start = rule.partition("/")
        if (host == own or host.endswith("." + own)) and path.startswith("/" + start):
            fits.append(rule)
    return host, path, max(fits, key=len, default=None)


URLS = [None, "", "no scheme", "http://", "HTTP://ÀA.Example.ORG/es/x?q=1#f", "https://example.org", "https://example.org?x=/es/",
        "a://b://c/d", "http://myexample.org/es/", "http://x.com/de/1.html", "http://com/fr/", "http://x.com/FR/", "x://y.org/a\nb#c",
        "https://user@www.example.org:80/en/12", "https://example.org/en/2", "://"]


def test_urls_by_rule(spark):
    pages = spark.createDataFrame([(i, u, "h", "r") for i, u in enumerate(URLS)], "page_id long, url string, html string, rule string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    made = {r.page_id: r for r in url_filter.judged(pages, labels).collect()}
    verdicts = {rule: verdict for verdict, rule in url_filter.RULES}
    for i, url in enumerate(URLS):
        host, path, rule = brute_judged(url)
        assert (made[i].host, made[i].path, made[i].rule) == (host, path, rule)
        assert made[i].verdict == verdicts.get(rule, "allow")
    assert url_filter.judged(pages.limit(0), labels).collect() == []


def test_urls_of_whole_tables(spark):
    urls = {r.page_id: r.url for r in spark.read.parquet(f"{FOLDER}/pages.parquet").collect()}
    made = QUERIES["op5_url_filter"](spark, FOLDER).collect()
    assert len(made) == len(urls)
    assert all((r.host, r.path, r.rule) == brute_judged(urls[r.page_id]) for r in made)


def test_urls_by_association(spark):
    """A host that is bad only under one path: the pair of tokens is the rule."""
    pages, labels = [], []
    for i in range(900):
        site, part = ("mixed", "plain", "other")[i % 3], ("casino", "news")[i // 3 % 2]
        pages.append((i, f"http://www.{site}.net/{part}/{i}"))
        if i < 600:
            labels.append((i, int(not (site == "mixed" and part == "casino")), 0))
    pages.append((1000, "http://shop.mixed.net/casino/"))
    pages.append((1001, "http://shop.mixed.net/a/b/c/d/e/f/g/h/i/j/k/l/casino/?q=1"))
    made = url_filter.judged(
        spark.createDataFrame(pages, "page_id long, url string"),
        spark.createDataFrame(labels, "doc_id long, quality int, toxic int"),
        min_support=0.05,
    ).collect()
    for r in made:
        bad = "mixed" in r.host and "casino" in r.path
        assert (r.verdict, r.confidence) == (("block", 1.0) if bad else ("allow", None))


def test_urls_by_all_their_tokens(spark):
    """What is bad shows in the query, the extension, a part with digits or a short host word of a long URL."""
    deep = "a/b/c/d/e/f/g/h/i/j/k/l/m"
    kinds = [
        f"http://one.two.three.four.net/{deep}/x.html?bad=1", f"http://one.two.three.four.net/{deep}/x.html?good=1",
        f"http://www.files.net/{deep}/x.mp3", f"http://www.files.net/{deep}/x.txt",
        "http://www.lists.net/top10/x", "http://www.lists.net/top20/x", "http://sex-n.net/", "http://sea-n.net/",
        f"http://www.long.net/{'y' * 70}/x", f"http://www.long.net/{'z' * 70}/x",
    ]
    pages = [(i, kinds[i % 10]) for i in range(600)]
    labels = [(i, i % 2, 0) for i in range(500)]
    made = url_filter.judged(
        spark.createDataFrame(pages, "page_id long, url string"),
        spark.createDataFrame(labels, "doc_id long, quality int, toxic int"),
        min_support=0.05,
    ).collect()
    assert all((r.verdict, r.confidence) == (("allow", None) if r.page_id % 2 else ("block", 1.0)) for r in made)


def test_the_mixture_is_of_whole_documents(spark, docs, monkeypatch):
    made = []
    monkeypatch.setattr(queries, "stored", lambda df, name: made.append(df.select("row.*").columns) or df)
    QUERIES["op9_mixing"](spark, FOLDER)
    assert made == [docs.columns]
