"""Quality classifier: attention-based multiple-instance learning over the passages of a text."""

from __future__ import annotations

import zlib
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
from gleaner.llm.tasks import map_rows, stored
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Words of a passage; the last one takes the rest of a text.
PASSAGE = 64
#: The model learns from at most so many labelled documents and passages of them.
SAMPLE_DOCUMENTS = 4000
SAMPLE_PASSAGES = 120_000
#: Sizes of a passage's code and of the attention; steps of the fit.
CODE = 24
ATTENTION = 12
STEPS = 250
RATE = 0.02
DECAY = 1e-4
SEED = 11
THRESHOLD = 0.7

SHAPES = 48
WORD_FACTS = 9
FEATURES = 2 * WORD_FACTS + SHAPES + 4
KNOWN_WORDS = 200_000


def _shape(word: str) -> str:
    """The classes of a word's characters, each run shortened to one."""
    out = []
    for c in word:
        kind = "a" if c.islower() else "A" if c.isupper() else "0" if c.isdigit() else "b" if c.isalpha() else c
        if not out or out[-1] != kind:
            out.append(kind)
    return "".join(out)


def word_facts(word: str) -> tuple[list[float], int]:
    """Numbers that describe a word by its characters, and the bucket of its shape."""
    n = len(word)
    upper = sum(c.isupper() for c in word)
    digits = sum(c.isdigit() for c in word)
    alphas = sum(c.isalpha() for c in word)
    facts = [
        min(n, 40) / 10,
        min(n, 40) ** 2 / 100,
        upper / n,
        digits / n,
        (n - alphas - digits) / n,
        float(upper == alphas > 1),
        float(word[-1] in ".!?"),
        float(word[-1] in ",;:"),
        float(alphas == 0),
    ]
    return facts, zlib.crc32(_shape(word).encode()) % SHAPES


class Passages:
    """Encodes texts as the features of their passages, with what is known of a bounded number of words."""

    def __init__(self):
        self.known: dict[str, int] = {}
        self.facts = np.zeros((KNOWN_WORDS, WORD_FACTS), np.float32)
        self.shapes = np.zeros(KNOWN_WORDS, np.int64)

    def _places(self, words: list[str]) -> np.ndarray:
        new = set(words).difference(self.known)
        if len(self.known) + len(new) > len(self.shapes):
            self.known, new = {}, set(words)
            if len(new) > len(self.shapes):  # one text with more words than are kept
                self.facts = np.zeros((len(new), WORD_FACTS), np.float32)
                self.shapes = np.zeros(len(new), np.int64)
        for word in new:
            at = self.known[word] = len(self.known)
            self.facts[at], self.shapes[at] = word_facts(word)
        return np.fromiter(map(self.known.__getitem__, words), np.int64, len(words))

    def __call__(self, text: str) -> np.ndarray:
        """One row of features for each passage; an empty text is one passage of zeros."""
        words = text.split()
        n = len(words)
        if not n:
            return np.zeros((1, FEATURES), np.float32)
        places = self._places(words)
        count = max(1, n // PASSAGE)
        passage = np.minimum(np.arange(n) // PASSAGE, count - 1)
        starts = np.arange(count) * PASSAGE
        sizes = np.bincount(passage, minlength=count).astype(np.float32)[:, None]
        facts = self.facts[places]
        mean = np.add.reduceat(facts, starts, axis=0) / sizes
        spread = np.sqrt(np.maximum(np.add.reduceat(facts**2, starts, axis=0) / sizes - mean**2, 0))
        shapes = np.bincount(passage * SHAPES + self.shapes[places], minlength=count * SHAPES)
        top = int(places.max()) + 1
        distinct = np.unique(passage * top + places)
        different = np.bincount(distinct // top, minlength=count)[:, None] / sizes
        same = np.zeros(n)
        same[1:] = (places[1:] == places[:-1]) & (passage[1:] == passage[:-1])
        again = np.bincount(passage, weights=same, minlength=count)[:, None] / sizes
        # Pairs of neighbouring words that occur more than once in the passage.
        pairs = passage[1:] * top * top + places[:-1] * top + places[1:] if n > 1 else places[:0]
        once = np.bincount(np.unique(pairs) // (top * top), minlength=count)[:, None] / sizes
        return np.concatenate(
            [mean, spread, shapes.reshape(count, SHAPES) / sizes, different, again, once, np.log(sizes) / 4], axis=1
        ).astype(np.float32)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -60, 60)))


@dataclass
class Model:
    """Gated attention over passage codes and a logistic score of their weighted sum."""

    mean: np.ndarray
    scale: np.ndarray
    weights: dict[str, np.ndarray]

    @classmethod
    def constant(cls, chance: float) -> Model:
        """Gives every text the same score: for samples with one label or none."""
        weights = {name: np.zeros(shape) for name, shape in _sizes().items()}
        chance = min(max(chance, 1e-6), 1 - 1e-6)
        weights["offset"] = np.array([np.log(chance / (1 - chance))])
        return cls(np.zeros(FEATURES), np.ones(FEATURES), weights)

    def forward(self, rows: np.ndarray, starts: np.ndarray) -> dict[str, np.ndarray]:
        w = self.weights
        counts = np.diff(np.append(starts, len(rows)))
        x = np.clip((rows - self.mean) / self.scale, -8, 8)
        code = np.tanh(x @ w["code"] + w["code_offset"])
        content, gate = np.tanh(code @ w["content"]), _sigmoid(code @ w["gate"])
        logits = (content * gate) @ w["attention"]
        raised = np.exp(logits - np.repeat(np.maximum.reduceat(logits, starts), counts))
        share = raised / np.repeat(np.add.reduceat(raised, starts), counts)
        bag = np.add.reduceat(share[:, None] * code, starts, axis=0)
        score = _sigmoid(bag @ w["score"] + w["offset"])
        return {"x": x, "code": code, "content": content, "gate": gate, "share": share, "bag": bag, "score": score, "counts": counts}

    def gradient(self, at: dict[str, np.ndarray], starts: np.ndarray, labels: np.ndarray) -> dict[str, np.ndarray]:
        """Of the mean log loss."""
        w, code, share, counts = self.weights, at["code"], at["share"], at["counts"]
        error = (at["score"] - labels) / len(labels)
        to_bag = np.repeat(error[:, None] * w["score"], counts, axis=0)
        to_share = (to_bag * code).sum(axis=1)
        to_logits = share * (to_share - np.repeat(np.add.reduceat(share * to_share, starts), counts))
        product = at["content"] * at["gate"]
        to_product = to_logits[:, None] * w["attention"]
        to_content = to_product * at["gate"] * (1 - at["content"] ** 2)
        to_gate = to_product * product * (1 - at["gate"])
        to_code = share[:, None] * to_bag + to_content @ w["content"].T + to_gate @ w["gate"].T
        to_code *= 1 - code**2
        return {
            "code": at["x"].T @ to_code,
            "code_offset": to_code.sum(axis=0),
            "content": code.T @ to_content,
            "gate": code.T @ to_gate,
            "attention": product.T @ to_logits,
            "score": at["bag"].T @ error,
            "offset": np.array([error.sum()]),
        }


def _sizes() -> dict[str, tuple[int, ...]]:
    return {
        "code": (FEATURES, CODE),
        "code_offset": (CODE,),
        "content": (CODE, ATTENTION),
        "gate": (CODE, ATTENTION),
        "attention": (ATTENTION,),
        "score": (CODE,),
        "offset": (1,),
    }


def fitted(bags: list[np.ndarray], labels: np.ndarray, steps: int = STEPS, seed: int = SEED) -> Model:
    """Learns attention and score together by Adam on all bags; the result depends on nothing but them."""
    if not len(labels) or labels.min() == labels.max():
        return Model.constant(float(labels.mean()) if len(labels) else 0.5)
    rows = np.concatenate(bags).astype(np.float64)
    starts = np.cumsum([0, *map(len, bags)])[:-1]
    draw = np.random.default_rng(seed)
    weights = {n: draw.normal(size=s) / np.sqrt(s[0]) if len(s) > 1 or n != "offset" else np.zeros(s) for n, s in _sizes().items()}
    weights["code_offset"] = np.zeros(CODE)
    model = Model(rows.mean(axis=0), rows.std(axis=0) + 1e-3, weights)
    first = {n: np.zeros_like(v) for n, v in weights.items()}
    second = {n: np.zeros_like(v) for n, v in weights.items()}
    for step in range(1, steps + 1):
        slopes = model.gradient(model.forward(rows, starts), starts, labels)
        for name, slope in slopes.items():
            slope = slope + DECAY * weights[name]
            first[name] = 0.9 * first[name] + 0.1 * slope
            second[name] = 0.999 * second[name] + 0.001 * slope**2
            size = RATE * np.sqrt(1 - 0.999**step) / (1 - 0.9**step)
            weights[name] -= size * first[name] / (np.sqrt(second[name]) + 1e-8)
    return model


def held_out(id_column: str) -> Column:
    """Whether a document is never learnt from: crc32 of its id as text is 2 modulo 4. A null id is ''."""
    return F.pmod(F.crc32(F.coalesce(F.col(id_column).cast("string"), F.lit("")).cast("binary")), F.lit(4)) == 2


def fit(
    docs: DataFrame,
    labels: DataFrame,
    id_column: str = "doc_id",
    text: str = "text",
    quality: str = "quality",
    sample_documents: int = SAMPLE_DOCUMENTS,
    sample_passages: int = SAMPLE_PASSAGES,
) -> Model:
    """A model of the labelled documents that are not held out.

    It learns from at most ``sample_documents`` of them, drawn by a hash of
    the id, and at most ``sample_passages`` passages: in that order, each
    document whose passages fit into what is left of these, whatever its
    length. These two bound what reaches the driver, at any size of the tables.
    Documents with contradicting labels count as of low quality.
    """
    known = labels.filter(F.col(quality).isNotNull() & F.col(id_column).isNotNull() & ~held_out(id_column))
    known = known.groupBy(F.col(id_column).alias("id")).agg(F.min(quality).cast("double").alias("label"))
    drawn = known.orderBy(F.xxhash64(F.lit(SEED), "id"), "id").limit(sample_documents)
    named = docs.select(F.col(id_column).alias("id"), F.col(text).alias("text"))
    sample = named.join(F.broadcast(drawn), "id")  # at most sample_documents rows

    def make():
        encode = Passages()

        def run(texts: list) -> dict[str, list]:
            made = [encode(t or "") for t in texts]
            return {"passages": [len(m) for m in made], "features": [m.tobytes() for m in made]}

        return run

    fields = [T.StructField("passages", T.LongType()), T.StructField("features", T.BinaryType())]
    encoded = map_rows(sample, ["id", "label"], ["text"], fields, make)
    # One row for an id: of rows that share it, that with the fewest passages.
    single = encoded.groupBy("id", "label").agg(F.min(F.struct("passages", "features")).alias("bag"))
    single = stored(single.select("id", "label", "bag.*"), "labelled-passages")
    sizes = {row["id"]: row["passages"] for row in single.select("id", "passages").collect()}
    chosen, left = [], sample_passages
    for i in sorted(sizes, key=lambda i: (zlib.crc32(str(i).encode()), i)):
        if sizes[i] <= left:
            chosen.append(i)
            left -= sizes[i]
    rows = {row["id"]: row for row in single.filter(F.col("id").isin(chosen)).collect()}
    bags = [np.frombuffer(rows[i]["features"], np.float32).reshape(-1, FEATURES) for i in chosen]
    return fitted(bags, np.array([rows[i]["label"] for i in chosen]))


def _score(model: Model) -> Callable:
    def make():
        encode = Passages()

        def run(texts: list) -> dict[str, list]:
            bags = [encode(t or "") for t in texts]
            starts = np.cumsum([0, *map(len, bags)])[:-1]
            return {"score": model.forward(np.concatenate(bags), starts)["score"].tolist() if bags else []}

        return run

    return make


def quality_scores(
    docs: DataFrame,
    labels: DataFrame,
    id_column: str = "doc_id",
    text: str = "text",
    quality: str = "quality",
    threshold: float = THRESHOLD,
    model: Model | None = None,
) -> DataFrame:
    """The quality of each whole text: (id, held_out, score, predicted).

    Every passage is encoded from its characters and words, gated attention
    weighs the passages, and the weighted code is scored from 0 to 1. Ids,
    labels and other columns are no inputs. A null or empty text is one empty
    passage; repeated rows get equal scores, each in its own row; with no
    labels, or labels of one kind, all scores are alike; an empty table gives
    an empty result.
    """
    model = model or fit(docs, labels, id_column, text, quality)
    named = docs.select(F.col(id_column).alias("id"), F.col(text).alias("text"))
    scored = map_rows(named, ["id"], ["text"], [T.StructField("score", T.DoubleType())], _score(model))
    return scored.select(
        F.col("id").alias(id_column),
        held_out("id").alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )
