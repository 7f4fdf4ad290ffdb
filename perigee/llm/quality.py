"""Quality classifier: random Fourier features, ridge scores, isotonic calibration (operator 4).

Each text gives statistics (see NAMES), standardised over all texts. Cosines of random projections approximate a
Gaussian kernel over them. The normal equations of ridge regression are summed by partition over all labelled training
rows; every fifth of these, by a hash of its id, is left out and serves the calibration: pool adjacent violators over
a histogram of scores, again summed by partition.

Defined cases: a null text is an empty one, and both have statistics (zeros) and a score; rows without a label are not
learnt from, and several labels of one id count as several rows; with no labelled row every score is 0.5; with labelled
rows but none for calibration the clipped ridge score is the score. Labels and ids never reach the statistics.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from perigee.llm import repetition, texts
from perigee.llm.shared import mapped, narrow, one_vector, stored, summed

NAMES = (
    "log_words", "log_chars", "word_length", "word_length_spread", "longest_word", "upper", "digits", "symbols",
    "sentence_marks", "other_marks", "non_ascii", "lines_per_word", "distinct_words", "covered", "longest_repeat",
    "unended_lines",
)
FEATURES, WIDTH, RIDGE, SEED, BINS = 256, 3.0, 1e-3, 11, 512


def _marked(characters: str) -> np.ndarray:
    table = np.zeros(256, bool)
    table[list(characters.encode())] = True
    return table


_UPPER = _marked("ABCDEFGHIJKLMNOPQRSTUVWXYZ")
_DIGIT = _marked("0123456789")
_SYMBOL = _marked("#$%&*+/<=>@\\^_`{|}~")
_SENTENCE = _marked(".,;:?'\"")
_OTHER = _marked("!()[]-")
_HIGH = np.arange(256) >= 0xC0


def _block_statistics(block: texts.Block) -> np.ndarray:
    words = texts.units(block, texts.NOT_SPACE)
    keys, rows, bounds = texts.hashes(block, words, lower=True), words.rows, words.bounds
    n = np.diff(bounds).astype(float)
    some = np.maximum(n, 1)
    chars = np.maximum(np.diff(block.offsets), 1).astype(float)

    def share(table: np.ndarray) -> np.ndarray:
        return np.diff(np.concatenate([[0], np.cumsum(table[block.data])])[block.offsets])

    length = np.minimum(words.ends - words.starts, 1000).astype(float)
    mean = texts.per_text(length, bounds) / some
    spread = np.sqrt(np.maximum(texts.per_text(length**2, bounds) / some - mean**2, 0))
    order = np.lexsort((keys, rows))
    new = np.ones(len(keys), bool)
    new[1:] = (keys[order][1:] != keys[order][:-1]) | (rows[order][1:] != rows[order][:-1])
    distinct = np.bincount(rows[order][new], minlength=len(n))
    longest = repetition.longest_repeats(keys, bounds)
    lines = texts.units(block, texts.NOT_NEWLINE)
    n_lines = np.maximum(np.diff(lines.bounds), 1)
    unended = ~_marked(".!?")[block.data[lines.ends - 1]] if len(lines.ends) else np.zeros(0, bool)
    return np.stack([
        np.log1p(n),
        np.log1p(chars),
        mean,
        spread,
        np.log1p(texts.largest(length, bounds)),
        share(_UPPER) / chars,
        share(_DIGIT) / chars,
        share(_SYMBOL) / some,
        share(_SENTENCE) / some,
        share(_OTHER) / some,
        share(_HIGH) / chars,
        np.diff(lines.bounds) / some,
        np.where(n > 0, distinct / some, 0),
        texts.per_text(repetition.covered(longest, 5), bounds) / some,
        np.log1p(texts.largest(longest, bounds)),
        texts.per_text(unended, lines.bounds) / n_lines,
    ], 1)


def statistics(docs: DataFrame) -> DataFrame:
    """doc_id, x: the statistics of each text."""

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [_block_statistics(block) for block in texts.blocks(batch["text"])]
            values = np.concatenate(found) if found else np.zeros((0, len(NAMES)))
            x = pa.ListArray.from_arrays(np.arange(0, values.size + 1, len(NAMES), dtype=np.int32), pa.array(values.ravel()))
            yield pa.RecordBatch.from_arrays([batch["doc_id"], x], names=["doc_id", "x"])

    return mapped(narrow(docs), compute, "doc_id bigint, x array<double>"
    )


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, len(NAMES))


class Model(NamedTuple):
    mean: np.ndarray
    scale: np.ndarray
    projection: np.ndarray
    phase: np.ndarray
    weights: np.ndarray | None
    steps: np.ndarray | None  # calibrated score of each bin of the ridge score

    def features(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -5, 5)
        cosines = np.cos(z @ self.projection + self.phase) * np.sqrt(2 / len(self.phase))
        return np.concatenate([cosines, np.ones((len(x), 1))], 1)

    def ridge(self, x: np.ndarray) -> np.ndarray:
        return np.clip(self.features(x) @ self.weights, 0, 1)

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.weights is None:
            return np.full(len(x), 0.5)
        raw = self.ridge(x)
        if self.steps is None:
            return raw
        return np.interp(raw, (np.arange(BINS) + 0.5) / BINS, self.steps)


def isotonic(positive: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Pool adjacent violators: the non-decreasing means nearest to positive / n; bins without rows take the line between."""
    pools: list[list[float]] = []
    for k in np.flatnonzero(n):
        pools.append([positive[k], n[k], k, k])
        while len(pools) > 1 and pools[-2][0] * pools[-1][1] >= pools[-1][0] * pools[-2][1]:
            p, m, _, end = pools.pop()
            pools[-1][0] += p
            pools[-1][1] += m
            pools[-1][3] = end
    at = [x for _, _, a, b in pools for x in (a, b)]
    value = [p / m for p, m, _, _ in pools for _ in (0, 1)]
    return np.interp(np.arange(len(n)), at, value)


def fit(rows: DataFrame, labelled: DataFrame) -> Model:
    """rows: x of all texts. labelled: x, label (0 or 1), calibrate of the training rows."""
    d = len(NAMES)

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 + 2 * d)
        for batch in batches:
            x = _matrix(batch["x"])
            total += np.concatenate([[len(x)], x.sum(0), (x**2).sum(0)])
        yield one_vector(total)

    found = summed(rows.select("x").mapInArrow(moments, "v binary"), 1 + 2 * d)
    n = max(found[0], 1)
    mean = found[1 : d + 1] / n
    scale = np.sqrt(np.maximum(found[d + 1 :] / n - mean**2, 1e-9))
    rng = np.random.default_rng(SEED)
    model = Model(mean, scale, rng.normal(size=(d, FEATURES)) / WIDTH, rng.uniform(0, 2 * np.pi, FEATURES), None, None)
    m = FEATURES + 1

    def normal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, right = np.zeros((m, m)), np.zeros(m)
        for batch in batches:
            f = model.features(_matrix(batch["x"]))
            total += f.T @ f
            right += f.T @ batch["label"].to_numpy(zero_copy_only=False)
        yield one_vector(np.concatenate([total.ravel(), right]))

    learnt = labelled.where("NOT calibrate").select("x", "label")
    sums = summed(learnt.mapInArrow(normal, "v binary"), m * m + m)
    gram = sums[: m * m].reshape(m, m)
    if gram[-1, -1] == 0:
        return model
    penalty = RIDGE * gram[-1, -1] * np.eye(m) / m
    model = model._replace(weights=np.linalg.solve(gram + penalty, sums[m * m :]))

    def histogram(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, BINS))
        for batch in batches:
            at = np.minimum((model.ridge(_matrix(batch["x"])) * BINS).astype(int), BINS - 1)
            total[0] += np.bincount(at, batch["label"].to_numpy(zero_copy_only=False), BINS)
            total[1] += np.bincount(at, minlength=BINS)
        yield one_vector(total.ravel())

    held = labelled.where("calibrate").select("x", "label")
    positive, count = summed(held.mapInArrow(histogram, "v binary"), 2 * BINS).reshape(2, BINS)
    return model if not count.any() else model._replace(steps=isotonic(positive, count))


def scored(docs: DataFrame, labels: DataFrame, learn: Column) -> DataFrame:
    """doc_id, score (0 to 1) of every text. learn: on doc_id, which rows may be learnt from."""
    rows = stored(statistics(docs))
    known = labels.select(F.col("doc_id").cast("bigint").alias("_id"), F.col("quality").cast("double").alias("label"))
    joined = rows.where(learn).join(known.where("label IS NOT NULL"), F.col("doc_id") == F.col("_id"))
    calibrate = F.pmod(F.xxhash64("doc_id"), F.lit(5)) == 0
    model = fit(rows, stored(joined.select("x", "label", calibrate.alias("calibrate"))))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(model.score(_matrix(batch["x"])))], names=["doc_id", "score"])

    return rows.mapInArrow(score, "doc_id bigint, score double")
