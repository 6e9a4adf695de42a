"""The classifier's forward pass and passages, and the top-k of long vectors, against plain loops."""

import math
import zlib
from collections import Counter

import numpy as np
import pytest
from gleaner.llm import topk
from gleaner.llm.quality_classifier import PASSAGE, SHAPES, Passages, _shape, fit, fitted, quality_scores, word_facts

FOLDER = "/root/testdata/sf0.001"


def passages_of(words):
    """The words of each passage; the last one takes the rest."""
    count = max(1, len(words) // PASSAGE)
    return [words[k * PASSAGE : (k + 1) * PASSAGE if k + 1 < count else None] for k in range(count)]


def features_by_loops(text):
    rows = []
    for words in passages_of(text.split()):
        n = len(words)
        facts = [word_facts(w)[0] for w in words]
        means = [math.fsum(column) / n for column in zip(*facts, strict=True)]
        spreads = [
            math.sqrt(max(0.0, math.fsum(x * x for x in column) / n - m * m))
            for column, m in zip(zip(*facts, strict=True), means, strict=True)
        ]
        shapes = Counter(zlib.crc32(_shape(w).encode()) % SHAPES for w in words)
        again = sum(a == b for a, b in zip(words, words[1:], strict=False))
        rows.append(
            [*means, *spreads, *(shapes[s] / n for s in range(SHAPES)), len(set(words)) / n, again / n, None, math.log(n) / 4]
        )
    return rows


def score_by_loops(model, rows):
    """One text's score: code of each passage, gated attention, weighted code, logistic score."""
    w = model.weights

    def sigmoid(x):
        return 1 / (1 + math.exp(-x))

    codes, logits = [], []
    for row in rows:
        x = [min(8, max(-8, (v - m) / s)) for v, m, s in zip(row, model.mean, model.scale, strict=True)]
        code = [
            math.tanh(math.fsum(a * w["code"][i][j] for i, a in enumerate(x)) + w["code_offset"][j])
            for j in range(len(w["code_offset"]))
        ]
        units = range(len(w["attention"]))
        content = [math.tanh(math.fsum(c * w["content"][i][j] for i, c in enumerate(code))) for j in units]
        gate = [sigmoid(math.fsum(c * w["gate"][i][j] for i, c in enumerate(code))) for j in units]
        codes.append(code)
        logits.append(math.fsum(a * b * v for a, b, v in zip(content, gate, w["attention"], strict=True)))
    raised = [math.exp(v - max(logits)) for v in logits]
    shares = [v / math.fsum(raised) for v in raised]
    bag = [math.fsum(s * c[j] for s, c in zip(shares, codes, strict=True)) for j in range(len(w["score"]))]
    return sigmoid(math.fsum(b * v for b, v in zip(bag, w["score"], strict=True)) + float(w["offset"][0]))


def test_features_of_passages(spark):
    encode = Passages()
    texts = [r.text for r in spark.read.parquet(f"{FOLDER}/documents.parquet").limit(40).collect()]
    for text in [*texts, "one", "a a a A1 B-2 x. y; !", "word " * 200]:
        made, wanted = encode(text), features_by_loops(text)
        assert len(made) == len(wanted)
        for row, want in zip(made.tolist(), wanted, strict=True):
            for a, b in zip(row, want, strict=True):
                assert b is None or a == pytest.approx(b, abs=2e-3, rel=2e-3)


def test_scores_of_whole_texts(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    model = fit(docs, spark.read.parquet(f"{FOLDER}/labels.parquet"))
    made = {r.doc_id: r.score for r in quality_scores(docs, docs.limit(0), model=model).collect()}
    encode = Passages()
    for row in docs.limit(60).collect():
        assert made[row.doc_id] == pytest.approx(score_by_loops(model, encode(row.text).tolist()), abs=1e-4)


def test_long_texts_are_learnt_from(spark):
    """A text of thousands of passages takes part in the fit as far as the budget of passages allows it."""
    long, short = "good words here " * 60_000, "bad, words; there! " * 10
    docs = spark.createDataFrame([(1, long), (3, short)], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1), (3, 0)], "doc_id long, quality int")
    encode = Passages()
    order = sorted([1, 3], key=lambda i: (zlib.crc32(str(i).encode()), i))
    bags = {1: encode(long), 3: encode(short)}
    wanted = fitted([bags[i] for i in order], np.array([float(i == 1) for i in order]))
    made = fit(docs, labels)
    assert all(np.allclose(made.weights[n], wanted.weights[n]) for n in made.weights)
    only = fit(docs, labels, sample_passages=len(bags[1]) - 1)  # the long one does not fit, the other one does
    assert only.forward(bags[1], np.array([0]))["score"][0] == pytest.approx(0.0, abs=1e-5)


def test_topk_of_long_vectors(spark):
    draw = np.random.default_rng(3)
    rows = [(i, draw.normal(size=int(draw.integers(0, 3000))).round(3).tolist()) for i in range(40)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    made = topk.exact_topk(df, df.filter("vec_id % 10 = 0"), k=7).orderBy("query_id", "rank").collect()
    held = [(i, [math.floor(1024 * x) for x in v]) for i, v in rows]
    for q in range(0, 40, 10):
        asked = held[q][1]
        scored = sorted((-sum(a * b for a, b in zip(asked, v, strict=False)), i) for i, v in held if i != q)[:7]
        assert [(-r.score, r.vec_id) for r in made if r.query_id == q] == scored
