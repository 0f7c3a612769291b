"""Quality classifier: supervised subword embeddings.

A document is the average of the vectors of its words, of its pairs of neighbouring words and of its
character n-grams, all hashed into one table. A softmax over that average gives the class. Vectors and
softmax weights are learnt together by stochastic gradient descent, one document a step, with step sizes
that shrink per vector as it gathers gradients. After training only the score of each table row matters
(its vector times the softmax weights), so a document is scored by averaging numbers, not vectors.

The three families weigh the same in the average. A pair of equal neighbouring words is one common feature,
whatever the word.

Labels are learnt from at most ``SAMPLE`` rows of each class, the first by a hash of the id, of texts of at
most ``SAMPLE_BYTES``. That is the only bound; every row is scored on its whole text.

Defined results: null and empty texts, and texts without words, have no features and get the class share
of the sample. Without labelled rows every score is 0.5. Null ids are scored, never learnt from. Repeated
rows are scored each. Conflicting labels of an id are all used. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from docquarry.llm.common import binary_values, column, filtered, labelled_sample, steps
from docquarry.llm.shingles import letter_codes, mix, words

SAMPLE = 3000
SAMPLE_BYTES = 1 << 16
BITS = 18
WIDTH = 8
EPOCHS = 4
RATE = 1.0
GRAMS = (3, 4)
CUT = 0.3


class Model(NamedTuple):
    """``scores``: log-odds that each table row adds; ``offset``: log-odds before any; ``empty``: for no features."""

    scores: np.ndarray
    offset: float
    empty: float


def features(texts: list[bytes | None], bits: int = BITS) -> list[tuple[np.ndarray, np.ndarray]]:
    """For words, pairs and character n-grams: table rows of the features, and the text that each belongs to."""
    shift = np.uint64(64 - bits)
    hashes, firsts = words(texts)
    text_of_word = np.repeat(np.arange(len(texts)), np.diff(firsts))
    inside = text_of_word[1:] == text_of_word[:-1]
    left, right = hashes[:-1][inside], hashes[1:][inside]
    pairs = mix(np.where(left == right, np.uint64(1), left * np.uint64(0x9E3779B97F4A7C15) + right))
    grams, text_of_gram = [], []
    codes, text_of_byte = letter_codes(texts)
    for n in GRAMS:
        size = max(0, len(codes) - n + 1)
        rolled = np.zeros(size, np.uint64)
        for place in range(n):
            rolled = rolled * np.uint64(0xD6E8FEB86659FD93) + codes[place: place + size]
        whole = text_of_byte[:size] == text_of_byte[n - 1: n - 1 + size]
        grams.append(mix(rolled[whole] + np.uint64(n)))
        text_of_gram.append(text_of_byte[:size][whole])
    families = ((hashes, text_of_word), (pairs, text_of_word[1:][inside]), (np.concatenate(grams), np.concatenate(text_of_gram)))
    return [((f >> shift).astype(np.int64), of) for f, of in families]


def _parts(text: bytes, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct features of a text and their shares of its average; each family that it has weighs the same."""
    families = [f for f, _ in features([text], bits) if len(f)]
    rows = np.concatenate([*families, np.empty(0, np.int64)])
    shares = np.concatenate([*(np.full(len(f), 1 / (len(f) * len(families))) for f in families), np.empty(0)])
    distinct, place = np.unique(rows, return_inverse=True)
    return distinct, np.bincount(place, shares, len(distinct)).astype(np.float32)


def train(
    texts: list[bytes], labels: list[int], bits: int = BITS, width: int = WIDTH, epochs: int = EPOCHS, rate: float = RATE,
    seed: int = 7,
) -> Model:
    """Learn from texts and their 0/1 labels; both classes weigh the same."""
    rng = np.random.default_rng(seed)
    docs, kept = [], []
    for text, label in zip(texts, labels):
        rows, parts = _parts(text, bits)
        if len(rows):
            docs.append((rows, parts))
            kept.append(label)
    share = float(np.clip(np.mean(labels), 0.01, 0.99)) if labels else 0.5
    empty = float(np.log(share / (1 - share)))
    if len(set(kept)) < 2:
        return Model(np.zeros(1 << bits, np.float32), empty, empty)
    vectors = rng.uniform(-1 / width, 1 / width, (1 << bits, width)).astype(np.float32)
    weights = np.zeros((width, 2), np.float32)
    weights[:, 1] = rng.uniform(-1, 1, width)
    weights[:, 0] = -weights[:, 1]
    bias = np.zeros(2, np.float32)
    gathered = np.full(1 << bits, 1e-12, np.float32)
    gathered_out = 1e-8
    balance = {c: len(kept) / (2 * kept.count(c)) for c in (0, 1)}
    for _ in range(epochs):
        for i in rng.permutation(len(docs)):
            rows, parts = docs[i]
            hidden = parts @ vectors[rows]
            logits = hidden @ weights + bias
            chances = np.exp(logits - logits.max())
            error = chances / chances.sum()
            error[kept[i]] -= 1
            error *= balance[kept[i]]
            back = weights @ error
            gathered_out += float(error @ error) * (1 + float(hidden @ hidden))
            weights -= rate * np.outer(hidden, error) / np.sqrt(gathered_out)
            bias -= rate * error / np.sqrt(gathered_out)
            gathered[rows] += parts**2 * float(back @ back)
            vectors[rows] -= (0.1 * rate * parts / np.sqrt(gathered[rows]))[:, None] * back
    return Model(vectors @ (weights[:, 1] - weights[:, 0]), float(bias[1] - bias[0]), empty)


def log_odds(model: Model, texts: list[bytes | None]) -> np.ndarray:
    total, families = np.zeros(len(texts)), np.zeros(len(texts))
    for rows, of in features(texts, len(model.scores).bit_length() - 1):
        counts = np.bincount(of, minlength=len(texts))
        total += np.bincount(of, model.scores[rows], len(texts)) / np.maximum(counts, 1)
        families += counts > 0
    return np.where(families > 0, model.offset + total / np.maximum(families, 1), model.empty)


def score(docs: DataFrame, model: Model, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns and the score of every row; the model has a fixed size and goes to every task."""
    rows = docs.select(*keep, docs[text].cast("string").alias("_text"))
    known = docs.sparkSession.sparkContext.broadcast(model)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches, "_text"):
            odds = log_odds(known.value, binary_values(column(batch, "_text")))
            chances = 1 / (1 + np.exp(-np.clip(odds, -30, 30)))
            yield pa.record_batch([*(column(batch, k) for k in keep), pa.array(chances)], [*keep, "score"])

    kept_schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.select(*keep).schema)
    return rows.mapInArrow(scored, f"{kept_schema}, score double")


def without_rejected(docs: DataFrame, model: Model, text: str = "text", cut: float = CUT) -> DataFrame:
    """The documents, with all their columns, whose score is at least ``cut``."""
    known = docs.sparkSession.sparkContext.broadcast(model)
    least = float(np.log(cut / (1 - cut)))
    return filtered(docs, text, lambda texts: log_odds(known.value, texts) >= least)


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", most: int = SAMPLE) -> Model:
    _, texts, marks = labelled_sample(docs, labels, label, most, SAMPLE_BYTES)
    return train(texts, marks)
