"""Resampling and clustering: against plain versions, in hard cases and with many segments."""

import hashlib
import math
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from perigee.llm import clustering, resampling
from tests.llm.brute import LOWER

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def features(text, longest):
    words = WORD.findall((text or "").translate(LOWER))
    return words, [" ".join(words[k : k + n]) for n in range(1, longest + 1) for k in range(len(words) - n + 1)]


def resampled(docs, target, buckets, longest, seed, share, min_words):
    def bucket(feature):
        return zlib.crc32(feature.encode()) % buckets

    source_n, target_n = [0] * buckets, [0] * buckets
    for count, texts in ((source_n, (t for _, t in docs)), (target_n, target)):
        for text in texts:
            for f in features(text, longest)[1]:
                count[bucket(f)] += 1
    s, t = sum(source_n), sum(target_n)
    rows = []
    for doc_id, text in docs:
        words, own = features(text, longest)
        weight = sum(
            math.floor(1000 * math.log((target_n[b] + 1) * (s + buckets) / ((source_n[b] + 1) * (t + buckets)))) for b in map(bucket, own)
        )
        h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append([doc_id, len(words), len(own), weight, score, None])
    able = sorted((r for r in rows if r[1] >= min_words), key=lambda r: (-r[4], r[0] is not None, r[0] or 0, r[2], r[3]))
    for rank, row in enumerate(able[: share[0] * len(able) // share[1]], 1):
        row[5] = rank
    return sorted(map(tuple, rows), key=str)


def collected(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_words", "n_features", "weight", "score", "rank").collect()), key=str)


@pytest.mark.parametrize(("longest", "share", "min_words"), [(1, (10, 100), 20), (3, (1, 2), 0)])
def test_resampling_in_hard_cases(spark, documents, longest, share, min_words):
    long = " ".join(f"Wort{k % 977}" for k in range(250_000))
    pairs = [(k, f"alpha beta {'gamma ' * k} d{k}") for k in range(300)]
    pairs += [(None, None), (None, "same text without an id"), (None, "same text without an id"), (7, "alpha " * 7), (7, "alpha " * 7)]
    pairs += [(1000, ""), (1001, " \n"), (1002, "ÄÖ été 中文 " * 30), (1003, long)]
    target = ["alpha gamma gamma", None, "", "Wort1 wort2 ÉTÉ été"]
    docs = documents(*pairs).select("*", *(F.lit(1).alias(c) for c in ("score", "at", "segment", "rank", "n_words")))
    wanted = spark.createDataFrame([(t, 1) for t in target], "text string, score int")
    found = resampling.resample(docs, wanted, 500, longest, 3, share, min_words)
    assert collected(found) == resampled(pairs, target, 500, longest, 3, share, min_words)


def test_resampling_of_nothing(spark, documents):
    empty = spark.createDataFrame([], "text string")
    assert resampling.resample(documents().limit(0), empty).collect() == []
    found = resampling.resample(documents((1, "a b")), empty, share=(1, 1), min_words=1).first()
    assert (found["weight"], found["rank"]) == (2 * (math.floor(1000 * math.log(10002 * 1 / (2 * 10000)))), 1)


def test_ranks_over_many_segments(spark, monkeypatch):
    """Ties of a third of the rows, one id among them, are split like other rows; no segment is much larger than its share."""
    monkeypatch.setattr(resampling, "SEGMENT_ROWS", 500)
    n = 20_000
    rows = spark.range(n, numPartitions=7).select(
        F.when(F.col("id") % 3 == 0, -5).otherwise(F.xxhash64("id") % 1000).alias("score"),
        F.when(F.col("id") % 3 == 0, 17).when(F.col("id") % 100 > 0, F.col("id")).alias("doc_id"),
        F.col("id").alias("n_words"),
    )
    sizes = []
    stored = resampling.stored

    def looked_at(df):
        kept = stored(df)
        if "segment" in kept.columns:
            sizes.extend(r["count"] for r in kept.groupBy("segment").count().collect())
        return kept

    monkeypatch.setattr(resampling, "stored", looked_at)
    found = resampling.ranked(rows).orderBy("rank").collect()
    assert [r["rank"] for r in found] == list(range(1, n + 1))
    key = [(-r["score"], r["doc_id"] is not None, r["doc_id"] or 0) for r in found]
    assert key == sorted(key) and {r["n_words"] for r in found} == set(range(n))
    assert len(sizes) == 8 and max(sizes) < 1.3 * n / 8


def plainly_clustered(rows, k, rounds, seed):
    """By all distances, in Python's integers."""
    whole = [(i, [math.floor(256 * float(x)) for x in v]) for i, v in rows]
    order = sorted((hashlib.sha256(f"{seed}:{i}".encode()).hexdigest(), v) for i, v in whole if i is not None)
    centroids = [v for _, v in order[:k]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), n) for n, c in enumerate(centroids))

    for _ in range(rounds):
        groups = {}
        for _, v in whole:
            groups.setdefault(nearest(v)[1], []).append(v)
        centroids = [[sum(x) // len(x) for x in zip(*groups[c], strict=True)] if c in groups else m for c, m in enumerate(centroids)]
    return [(i, n, d) for i, (d, n) in ((i, nearest(v)) for i, v in whole)], centroids


def test_clusters_in_hard_cases(spark):
    rng = np.random.default_rng(5)
    good = [(k, [float(x) for x in rng.integers(-3, 4, 4)]) for k in range(200)]  # many ties
    good += [(None, [0.0, 1.0, -1.0, 2.5]), (3, [1.0, 1.0, 1.0, 1.0]), (3, [1.0, 1.0, 1.0, 1.0]), (500, [0.0] * 4), (501, [-0.001, 0.0, 0.0039, 0.004])]
    bad = [(600, None), (601, []), (602, [1.0] * 5), (603, [1.0, None, 1.0, 1.0]), (604, [float("nan"), 1.0, 1.0, 1.0]), (605, [float("-inf")] * 4)]
    table = spark.createDataFrame(good + bad, "vec_id bigint, embedding array<double>").repartition(5)
    table = table.select("*", *(F.lit(1).alias(c) for c in ("v", "cluster", "distance", "h", "label")))
    found = clustering.clustered(table, k=9, rounds=3, seed=2, dimensions=4).collect()
    want, centroids = plainly_clustered(good, 9, 3, 2)
    assert sorted(((r["vec_id"], r["cluster"], r["distance"]) for r in found), key=str) == sorted(want, key=str)
    assert {r["inertia"] for r in found} == {sum(d for _, _, d in want)}
    for r in found:
        assert r["cluster_inertia"] == sum(d for _, c, d in want if c == r["cluster"])
        assert r["centroid_sha256"] == hashlib.sha256(",".join(map(str, centroids[r["cluster"]])).encode()).hexdigest()


def test_clusters_of_large_components(spark):
    rows = [(1, [1e30, 0.0]), (2, [1e30, 1.0]), (3, [0.0, 2.0**40]), (4, [-1e18, 5.0]), (5, [3.0, 4.0])]
    found = clustering.clustered(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>"), k=2, rounds=2, dimensions=2).collect()
    want = {i: (c, d if d < 2**63 else None) for i, c, d in plainly_clustered(rows, 2, 2, 2)[0]}
    assert {r["vec_id"]: (r["cluster"], r["distance"]) for r in found} == want


def test_few_vectors_and_none(spark):
    table = spark.createDataFrame([(1, [1.0, 2.0]), (None, [1.5, 2.0])], "vec_id bigint, embedding array<double>")
    assert {(r["vec_id"], r["cluster"], r["distance"]) for r in clustering.clustered(table, dimensions=2, rounds=1).collect()} == {(1, 0, 64 * 64), (None, 0, 64 * 64)}
    assert clustering.clustered(table.limit(0), dimensions=2).collect() == []
    only = clustering.clustered(table.where("vec_id IS NULL"), dimensions=2).collect()
    assert [(r["vec_id"], r["cluster"], r["inertia"]) for r in only] == [(None, None, None)]


def test_walks_stop_early_and_find_the_nearest():
    """The threshold algorithm against all distances, with ties, and counting what it sees."""
    rng = np.random.default_rng(1)
    centroids = rng.integers(-20, 20, (40, 3))
    vectors = rng.integers(-25, 25, (500, 3))
    vectors[:50] = centroids[rng.integers(0, 40, 50)]
    cluster, best = clustering.Walks(centroids.tolist()).nearest(vectors)
    every = ((vectors[:, None] - centroids[None]) ** 2).sum(axis=2)
    assert (best == every.min(axis=1)).all() and (cluster == every.argmin(axis=1)).all()
    met, gaps = clustering.Walks(centroids.tolist()).outward(np.zeros(500, int), vectors[:, 0])
    assert (np.sort(met, axis=1) == np.arange(40)).all() and (np.diff(gaps, axis=1) >= 0).all()
    assert (gaps == (centroids[met, 0] - vectors[:, :1]) ** 2).all()
