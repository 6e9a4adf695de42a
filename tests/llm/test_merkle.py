"""Merkle manifests against a plain tree."""

import hashlib
import zlib
from collections import Counter

import pytest
from gleaner.llm import merkle
from gleaner.llm.queries import QUERIES
from gleaner.llm.sql import ORACLE
from pyspark.sql import functions as F
from tests.compare import connect, difference
from tests.llm.brute import DOCUMENTS, awkward_rows


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(values):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def tree(nodes, arity):
    """The root, and for each leaf its siblings by level as (slot, others)."""
    paths, above = [[] for _ in nodes], [[i] for i in range(len(nodes))]
    while len(nodes) > 1:
        runs = [nodes[i : i + arity] for i in range(0, len(nodes), arity)]
        for i, leaves in enumerate(above):
            run, slot = runs[i // arity], i % arity
            for k in leaves:
                paths[k].append((slot, run[:slot] + run[slot + 1 :]))
        above = [sum(above[i : i + arity], []) for i in range(0, len(above), arity)]
        nodes = [sha("".join(run)) for run in runs]
    return nodes[0], paths


def fold(node, path):
    for slot, others in path:
        node = sha("".join([*others[:slot], node, *others[slot:]]))
    return node


def brute(rows, arity=2):
    """``rows`` are (doc_id, source, lang, n_chars, text)."""
    groups: dict = {}
    for r in rows:
        groups.setdefault(r[2], []).append(r)
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    made = {}
    for g in order:
        own = sorted(groups[g], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        made[g] = (own, *tree([leaf(r) for r in own], arity))
    if not order:
        return Counter()
    root, tops = tree([made[g][1] for g in order], arity)
    out = []
    for g, top in zip(order, tops, strict=True):
        own, subroot, paths = made[g]
        for r, path in zip(own, paths, strict=True):
            whole = path + top
            struck = r[0] is not None and r[3] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0
            now = (*r[:3], r[3] + 1, r[4]) if struck else r
            again = fold(leaf(now), whole)
            siblings = sha("".join(h for _, others in whole for h in others))
            out.append((r[0], leaf(r), subroot, root, siblings, again, again == root))
    return Counter(out)


def noted():
    struck = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    return {"n_chars": F.when(struck, F.col("n_chars") + 1).otherwise(F.col("n_chars"))}


def fields(df):
    return [tuple(r) for r in df.select(*merkle.FIELDS).collect()]


def test_whole_table(spark):
    folder = "/root/testdata/sf0.001"
    made = QUERIES["op12_merkle_manifest"](spark, folder).collect()
    want = brute(fields(spark.read.parquet(f"{folder}/documents.parquet")))
    assert Counter(map(tuple, made)) == want
    assert 0 < sum(not r.verified for r in made) < len(made)
    assert difference(spark, folder, "op12_merkle_manifest", QUERIES, ORACLE, connect(folder)) is None


@pytest.mark.parametrize("arity", [2, 3, 5])
def test_awkward_rows(spark, arity):
    """Null groups, ids and texts, one leaf alone, runs that are not full, equal rows, clashing columns."""
    rows = awkward_rows() + [(i, "t" * (i % 3), "de", f"s{i}", i, "k", "n", "i") for i in range(100, 129)]
    rows += [(None, None, None, None, None, None, None, None), (7, "again", "xx", "b", 12, "k", "n", "i")]
    docs = spark.createDataFrame(rows, DOCUMENTS).selectExpr("*", "'x' as node", "1 as idx", "2 as size", "3 as `group`")
    made = Counter(map(tuple, merkle.manifest(docs, noted(), arity=arity).collect()))
    want = brute(fields(docs), arity)

    def shown(counted):  # equal rows share the places in any order
        return Counter(counted.elements())

    assert shown(made) == shown(want)
    assert merkle.manifest(docs.limit(0), noted()).collect() == []
    assert all(r.verified for r in merkle.manifest(docs, arity=arity).collect())
    one = merkle.manifest(docs.filter("doc_id = 7 and text = 'again'")).first()
    assert one.leaf == one.subroot == one.root == one.folded_root and one.proof_sha256 == sha("")
