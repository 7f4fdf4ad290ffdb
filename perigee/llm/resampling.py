"""Importance resampling towards a target distribution (operator 11).

Texts are bags of hashed features: runs of 1 to `longest` words (A-Z lower-cased), each counted in the bucket of its
crc32. The two tables' bucket counts give one array of gains, a gain being the scaled and floored log ratio of the
target's smoothed share to the source's. A document's weight is the sum of its features' gains, its score adds noise
from a hash of its id (Gumbel's law), so the highest scores are a draw without replacement by importance.

Ranks come from parallel sorting by regular sampling. Each partition sorts its rows: a run. Every `stride`-th row of
each run is a sample, so the samples are regular in every run and their number depends on the number of segments only.
Splitters are regular among the sorted samples. Each row goes to its segment's task, where the sorted pieces are
merged; prefix sums of the segments' sizes turn places within segments into exact ranks. Rows compare by score (high
first), id (small first, null before all) and place in the runs, so no two are equal and ties split like other rows.

Defined cases: a null or empty text has no features and weight 0; a null id hashes as an empty one; repeated rows are
ranked one by one, in the order of the runs if all else is equal; an empty source or target table has counts 0. Only
doc_id and text are read. Texts are read in blocks of words, however long they are.
"""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from perigee.llm.shared import mapped, narrow, one_vector, stored, summed

BUCKETS, LONGEST, SEED = 10_000, 1, 2024
SHARE, OF, MIN_WORDS = 10, 100, 20
#: Samples for each segment: no segment gets more than its even share by much.
OVERSAMPLE = 32
#: Fewer segments than shuffle partitions if they would hold fewer rows than this.
SEGMENT_ROWS = 4096
# Words of lower-cased UTF-8: all that is not among the other ASCII characters.
_WORD = re.compile(rb"[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
_BLOCK, _KNOWN = 1_000_000, 1_000_000


class _Buckets(dict):
    """Buckets of features, remembered up to a number of different ones."""

    def __init__(self, buckets: int):
        self.buckets = buckets

    def __missing__(self, feature: bytes) -> int:
        if len(self) >= _KNOWN:
            self.clear()
        found = self[feature] = zlib.crc32(feature) % self.buckets
        return found

    def of(self, text: bytes | None, longest: int) -> Iterator[tuple[int, np.ndarray]]:
        """For each block of the text, cut between words: its number of words and its features' buckets."""
        text, at, before = (text or b"").lower(), 0, []
        while at < len(text):
            rest = _WORD.match(text, at + _BLOCK)
            end = rest.end() if rest else at + _BLOCK
            words, at = _WORD.findall(text, at, end), end
            features = words
            if longest > 1:
                # Runs that end in this block.
                window, skip = before + words, len(before)
                features = words + [
                    b" ".join(window[e - n : e]) for n in range(2, longest + 1) for e in range(max(n, skip + 1), len(window) + 1)
                ]
                before = window[max(0, len(window) - longest + 1) :]
            yield len(words), np.fromiter(map(self.__getitem__, features), np.int64, len(features))


def _texts(batch: pa.RecordBatch) -> Iterator[bytes | None]:
    return (text.as_py() for text in batch["text"].cast(pa.binary()))


def bucket_counts(texts: DataFrame, buckets: int = BUCKETS, longest: int = LONGEST) -> np.ndarray:
    """The number of features in each bucket, over all rows of column `text`."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, total = _Buckets(buckets), np.zeros(buckets)
        for batch in batches:
            for text in _texts(batch):
                for _, found in known.of(text, longest):
                    np.add.at(total, found, 1)
        yield one_vector(total)

    return summed(mapped(texts.select("text"), count, "v binary"), buckets).astype(np.int64)


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln((t + 1)(S + B) / ((s + 1)(T + B)))) for each of the B buckets."""
    all_s, all_t, buckets = int(source.sum()), int(target.sum()), len(source)
    return np.array(
        [
            math.floor(1000 * math.log((t + 1) * (all_s + buckets) / ((s + 1) * (all_t + buckets))))
            for s, t in zip(source.tolist(), target.tolist(), strict=True)
        ],
        np.int64,
    )


def noise(doc_id: int | None, seed: int = SEED) -> int:
    h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def scored(docs: DataFrame, gain: np.ndarray, longest: int = LONGEST, seed: int = SEED) -> DataFrame:
    """doc_id, n_words, n_features, weight, score of every document."""

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _Buckets(len(gain))
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch["doc_id"].to_pylist(), _texts(batch), strict=True):
                n_words = n_features = weight = 0
                for words, found in known.of(text, longest):
                    n_words, n_features, weight = n_words + words, n_features + len(found), weight + int(gain[found].sum())
                rows.append((doc_id, n_words, n_features, weight, weight + noise(doc_id, seed)))
            columns = zip(*rows, strict=True) if rows else [[]] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=_SCORED)

    return mapped(narrow(docs), score, ", ".join(f"{c} bigint" for c in _SCORED))


_SCORED = ["doc_id", "n_words", "n_features", "weight", "score"]


def _keys(table: pa.RecordBatch | pa.Table) -> np.ndarray:
    """Bytes that compare like (score descending, doc_id ascending with null first, at ascending)."""

    def sortable(values: np.ndarray) -> np.ndarray:
        return (values.astype(np.int64).view(np.uint64) ^ np.uint64(1 << 63)).astype(">u8").view(np.uint8).reshape(-1, 8)

    def column(name: str) -> np.ndarray:
        return np.asarray(table[name].fill_null(0).to_numpy(zero_copy_only=False))

    ids = table["doc_id"].is_valid().to_numpy(zero_copy_only=False).astype(np.uint8).reshape(-1, 1)
    parts = [sortable(~column("score")), ids, sortable(column("doc_id")), sortable(column("at"))]
    return np.ascontiguousarray(np.hstack(parts)).view("S25").ravel()


def ranked(rows: DataFrame) -> DataFrame:
    """The rows with `rank`: 1, 2, 3... by score (high first), then doc_id (small first)."""
    spark = rows.sparkSession
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_first()]
    runs = stored(rows.sortWithinPartitions(*order).withColumn("at", F.monotonically_increasing_id()))
    n = runs.count()
    segments = max(1, min(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-n // SEGMENT_ROWS)))
    stride = max(1, n // (segments * OVERSAMPLE))

    def regular(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = 0
        for batch in batches:
            first = (stride - 1 - seen) % stride
            seen += len(batch)
            yield batch.take(pa.array(range(first, len(batch), stride), pa.int64()))

    key = "doc_id bigint, score bigint, at bigint"
    samples = np.sort(_keys(mapped(runs.select("doc_id", "score", "at"), regular, key, None).toArrow()))
    splitters = samples[[len(samples) * k // segments for k in range(1, segments)]] if len(samples) else samples

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            segment = pa.array(np.searchsorted(splitters, _keys(batch), side="right"), pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns, segment], names=[*batch.schema.names, "segment"])

    schema = ", ".join(f"{c} bigint" for c in runs.columns)
    exchanged = stored(mapped(runs, cut, f"{schema}, segment bigint", None))
    sizes = dict(exchanged.groupBy("segment").count().collect())
    before = np.concatenate([[0], np.cumsum([sizes.get(k, 0) for k in range(segments)])])

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        taken = np.zeros(segments, np.int64)
        for batch in batches:
            own = batch["segment"].to_numpy()
            # A task's rows are sorted by segment, so equal ones are neighbours.
            starts = np.flatnonzero(np.diff(own, prepend=-1))
            inside = np.arange(len(own)) - np.repeat(starts, np.diff(starts, append=len(own)))
            rank = before[own] + taken[own] + inside + 1
            np.add.at(taken, own, 1)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(rank)], names=[*batch.schema.names, "rank"])

    merged = exchanged.repartitionById(segments, F.col("segment").cast("int")).sortWithinPartitions("segment", *order, "at")
    return mapped(merged, number, f"{schema}, segment bigint, rank bigint", None).drop("segment", "at")


def resample(
    docs: DataFrame,
    target: DataFrame,
    buckets: int = BUCKETS,
    longest: int = LONGEST,
    seed: int = SEED,
    share: tuple[int, int] = (SHARE, OF),
    min_words: int = MIN_WORDS,
) -> DataFrame:
    """Every document's doc_id, n_words, n_features, weight, score and rank, which is null for those not drawn.

    Drawn are the highest scores: share[0] of each share[1] documents of at least `min_words` words, rounded down.
    """
    gain = gains(bucket_counts(docs, buckets, longest), bucket_counts(target, buckets, longest))
    rows = stored(scored(docs, gain, longest, seed))
    able = rows.where(F.col("n_words") >= min_words)
    drawn = share[0] * able.count() // share[1]
    best = ranked(able).withColumn("rank", F.when(F.col("rank") <= drawn, F.col("rank")))
    return best.unionByName(rows.where(F.col("n_words") < min_words).withColumn("rank", F.lit(None).cast("bigint")))
