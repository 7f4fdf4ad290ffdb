"""Language ID: averaged hashed subword embeddings and a linear softmax, with calibrated rejection (operator 5).

Subwords are the byte pairs and triples of the text, letters lower-cased and everything else a space, hashed into
BUCKETS. Their embeddings' average goes through a linear softmax; both are trained by stochastic gradient descent in
numpy on a bounded sample: at most `per_language` rows of each language, chosen by a hash of the id. A fifth of it sets
the temperature and the score below which a prediction counts as rejected, so that what stays is `precision` right.

Defined cases: a null text, and one without a letter, is `und` with score 0; a null lang is not learnt from; with no
language to learn every text is `und`. Equal scores go to the language that sorts first. Repeated rows are scored alike;
lang, source and ids reach no score.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from perigee.llm import texts
from perigee.llm.shared import mapped, narrow


BUCKETS, DIMENSIONS, PER_LANGUAGE = 4096, 16, 800
EPOCHS, RATE, SEED, PRECISION = 30, 4.0, 5, 0.99
UNDETERMINED = "und"

_FOLD = np.full(256, 0x20, np.uint8)
_FOLD[0x61:0x7B] = np.arange(0x61, 0x7B)
_FOLD[0x41:0x5B] = np.arange(0x61, 0x7B)
_FOLD[0x80:] = np.arange(0x80, 0x100)
_PAIRS = (texts.mixed(np.arange(1 << 16, dtype=np.uint64) + np.uint64(1)) >> np.uint64(52)).astype(np.int64)


def subwords(block: texts.Block) -> np.ndarray:
    """Share of each bucket among the subwords of each text."""
    n = len(block.offsets) - 1
    letters = _FOLD[block.data].astype(np.uint64)
    rows = np.repeat(np.arange(n, dtype=np.int64), np.diff(block.offsets))
    counts = np.zeros(n * BUCKETS)
    if len(letters) >= 2:
        pair = letters[:-1] * np.uint64(256) + letters[1:]
        inside = (rows[:-1] == rows[1:]) & (pair != 0x2020)
        counts += np.bincount((rows[:-1] * BUCKETS + _PAIRS[pair])[inside], minlength=n * BUCKETS)
    if len(letters) >= 3:
        triple = pair[:-1] * np.uint64(256) + letters[2:]
        inside = (rows[:-2] == rows[2:]) & (pair[:-1] != 0x2020) & (pair[1:] != 0x2020)
        bucket = ((triple * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(52)).astype(np.int64)
        counts += np.bincount((rows[:-2] * BUCKETS + bucket)[inside], minlength=n * BUCKETS)
    counts = counts.reshape(n, BUCKETS)
    return counts / np.maximum(counts.sum(1, keepdims=True), 1)


class Model(NamedTuple):
    languages: list[str]
    embedding: np.ndarray
    weights: np.ndarray
    bias: np.ndarray
    temperature: float = 1.0
    reject_below: float = 0.0

    def probabilities(self, shares: np.ndarray) -> np.ndarray:
        return _softmax((shares @ (self.embedding @ self.weights) + self.bias) / self.temperature)


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def train(shares: np.ndarray, target: np.ndarray, languages: list[str]) -> Model:
    """Stochastic gradient descent in small batches, then the temperature and rejection from the rows left out."""
    rng = np.random.default_rng(SEED)
    held = rng.random(len(target)) < 0.2 if len(target) >= 50 else np.zeros(len(target), bool)
    x, y = shares[~held], target[~held]
    embedding = rng.normal(size=(BUCKETS, DIMENSIONS))
    weights, bias = rng.normal(size=(DIMENSIONS, len(languages))) * 0.1, np.zeros(len(languages))
    for epoch in range(EPOCHS):
        rate = RATE * (1 - epoch / EPOCHS)
        for rows in np.array_split(rng.permutation(len(y)), max(1, len(y) // 32)):
            average = x[rows] @ embedding
            error = _softmax(average @ weights + bias)
            error[np.arange(len(rows)), y[rows]] -= 1
            error /= max(len(rows), 1)
            back = x[rows].T @ (error @ weights.T)
            weights -= rate * (average.T @ error)
            bias -= rate * error.sum(0)
            embedding -= rate * 8 * back
    model = Model(languages, embedding, weights, bias)
    if not held.any():
        return model
    x, y = shares[held], target[held]

    def loss(t: float) -> float:
        p = model._replace(temperature=t).probabilities(x)[np.arange(len(y)), y]
        return -np.log(np.maximum(p, 1e-12)).mean()

    model = model._replace(temperature=min((0.25, 0.5, 0.75, 1.0, 1.5, 2.0, 3.0, 5.0), key=loss))
    p = model.probabilities(x)
    order = np.argsort(-p.max(1), kind="stable")
    right = np.cumsum((p.argmax(1) == y)[order]) / np.arange(1, len(y) + 1)
    good = np.flatnonzero(right >= PRECISION)
    below = float(p.max(1)[order][good[-1]]) if len(good) else 1.0
    return model._replace(reject_below=below if len(good) < len(y) else 0.0)


def fit(docs: DataFrame, learn: Column, per_language: int = PER_LANGUAGE) -> Model | None:
    """A model from the sample of the rows that `learn` (on doc_id) admits; None if there is nothing to learn."""
    rows = docs.where(learn & F.col("lang").isNotNull() & F.col("text").isNotNull())
    counts = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}  # one per language
    if not counts:
        return None
    languages = sorted(counts)
    # 1.2 times the quota by hash, so that the bound below rarely cuts.
    share = F.element_at(
        F.create_map(*(F.lit(x) for k in languages for x in (k, min(1.0, 1.2 * per_language / counts[k])))), F.col("lang")
    )
    draw = F.pmod(F.xxhash64("doc_id", F.lit(SEED)), F.lit(1 << 20)) / float(1 << 20)
    sample = rows.where(draw < share).select("lang", draw.alias("draw"), "text")

    def shares(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in texts.blocks(batch["text"]):
                n = len(block.offsets) - 1
                x = [r.astype(np.float32).tobytes() for r in subwords(block)]
                own = [batch[c].slice(block.first, n) for c in ("lang", "draw")]
                yield pa.RecordBatch.from_arrays([*own, pa.array(x, pa.binary())], names=["lang", "draw", "x"])

    def learnt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        x, y, seen = [], [], dict.fromkeys(languages, 0)
        for batch in batches:
            for lang, value in zip(batch["lang"].to_pylist(), batch["x"], strict=True):
                if seen[lang] < per_language:
                    seen[lang] += 1
                    x.append(np.frombuffer(value.as_py(), np.float32))
                    y.append(languages.index(lang))
        if y:
            model = train(np.array(x), np.array(y), languages)
            parts = [model.embedding, model.weights, model.bias, [model.temperature, model.reject_below]]
            yield pa.RecordBatch.from_arrays([pa.array([np.asarray(p, float).tobytes() for p in parts], pa.binary()), pa.array(range(4))], names=["v", "part"])

    # One task trains: it gets at most 1.2 quotas of BUCKETS floats for each language, however many rows there are.
    vectors = mapped(sample, shares, "lang string, draw double, x binary").repartition(1).sortWithinPartitions("draw")
    parts = {r["part"]: np.frombuffer(r["v"]) for r in vectors.mapInArrow(learnt, "v binary, part bigint").collect()}
    k = len(languages)
    return Model(languages, parts[0].reshape(BUCKETS, DIMENSIONS), parts[1].reshape(DIMENSIONS, k), parts[2], *parts[3])


def _has_letter(text: str | None) -> bool:
    return any(map(str.isalpha, text or ""))


def predicted(docs: DataFrame, model: Model | None) -> DataFrame:
    """doc_id, lang_pred, score (its probability), rejected (the score is below what calibration asks)."""

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = np.array([*(model.languages if model else []), UNDETERMINED], object)
        for batch in batches:
            best = np.full(len(batch), len(names) - 1)
            score = np.zeros(len(batch))
            known = np.array([model is not None and _has_letter(t.as_py()) for t in batch["text"]], bool)
            for block in texts.blocks(batch["text"]) if model else ():
                p = model.probabilities(subwords(block))
                rows = slice(block.first, block.first + len(p))
                best[rows] = np.where(known[rows], p.argmax(1), len(names) - 1)
                score[rows] = np.where(known[rows], p.max(1), 0)
            rejected = ~known | (score < (model.reject_below if model else 0))
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], pa.array(names[best].tolist(), pa.string()), pa.array(score), pa.array(rejected)],
                names=["doc_id", "lang_pred", "score", "rejected"],
            )

    return mapped(narrow(docs), predict, "doc_id bigint, lang_pred string, score double, rejected boolean"
    )


