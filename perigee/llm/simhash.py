"""SimHash near-dedup with generalised pigeonhole search (operator 9).

Fingerprints: 64-bit SimHash of word shingles by XXH64. Search: the 64 bits are grouped into partitions by correlation,
each partition i gets a threshold t_i with sum(t_i) = distance - partitions + 1, and two fingerprints within the
distance then lie within t_i of each other in some partition i (the general pigeonhole principle; t_i = -1 leaves a
partition out). Dynamic programming picks the thresholds with the fewest estimated candidates, for several numbers of
partitions, and the cheapest of these plans is used. Each distinct fingerprint is indexed under its own bits of a
partition and probes those within t_i. A bucket of many rows is split by its other bits, by the same principle with
thresholds of zero. What remains of a bucket is verified in blocks, so that a hot one spreads over tasks; a block
gives links that connect what it found, not all its pairs. Components come from label propagation over the links.

Defined cases: a text without words has fingerprint zero and is linked like any other; a text of fewer words than a
shingle is one shingle; rows that share an id share a component if any of their fingerprints do, since components are of
ids; a null id gets a fingerprint and the smallest non-null id it is linked to, or null.
Further columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from perigee.llm.shared import fresh, mapped, narrow, stored

BITS = 64
SHINGLE, DISTANCE, SEED = 3, 3, 42
#: Rows of a block of a bucket: the largest matrix that a task compares at once is this squared.
BLOCK_ROWS = 2048
#: Buckets of more than so many blocks are split by their other bits first.
HOT_BLOCKS = 8


# Fingerprints


def _shingle_hashes(text: str | None, words: int, seed: int) -> list[int]:
    found = (text or "").encode().lower().split()
    if not found:
        return []
    if len(found) <= words:
        return [xxhash.xxh64_intdigest(b" ".join(found), seed)]
    hashed = xxhash.xxh64_intdigest
    return [hashed(b" ".join(s), seed) for s in zip(*(found[i:] for i in range(words)), strict=False)]


def fingerprint(text: str | None, words: int = SHINGLE, seed: int = SEED) -> int:
    """A bit is 1 if it is set in more than half of the shingle hashes."""
    values = np.array(_shingle_hashes(text, words, seed), np.uint64)
    ones = np.zeros(BITS, np.int64)
    for part in range(0, len(values), 1 << 16):
        ones += np.unpackbits(values[part : part + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1).sum(0, np.int64)
    return int(np.packbits(2 * ones > len(values)).view(np.uint64)[0])


def fingerprints(docs: DataFrame, words: int = SHINGLE, seed: int = SEED) -> DataFrame:
    """doc_id, fp (the 64 bits as a signed number)."""

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = np.array([fingerprint(t.as_py(), words, seed) for t in batch["text"]], np.uint64)
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(prints.view(np.int64))], names=["doc_id", "fp"])

    return mapped(narrow(docs), compute, "doc_id bigint, fp bigint"
    )


# Plan of the search


def bit_pair_counts(prints: DataFrame) -> tuple[int, np.ndarray]:
    """How many fingerprints there are, and how many have bits i and j both set: summed by partition, then in all."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros((BITS, BITS)), 0
        for batch in batches:
            bits = _bits(batch["fp"].to_numpy(zero_copy_only=False)).astype(np.float32)
            for part in range(0, len(bits), 1 << 16):
                chunk = bits[part : part + (1 << 16)]
                total += chunk.T @ chunk
            n += len(bits)
        cells = pa.array(np.append(total.ravel(), n).astype(np.int64))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(BITS * BITS + 1)), cells], names=["cell", "n"])

    rows = prints.select("fp").mapInArrow(count, "cell bigint, n bigint").groupBy("cell").agg(F.sum("n").alias("n"))
    cells = np.zeros(BITS * BITS + 1)
    for row in rows.collect():  # 4,097 rows whatever the input
        cells[row["cell"]] = row["n"]
    return int(cells[-1]), cells[:-1].reshape(BITS, BITS)


def _bits(prints: np.ndarray) -> np.ndarray:
    return np.unpackbits(prints.view(np.uint64).astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")


def group_bits(n: int, both: np.ndarray, partitions: int) -> list[list[int]]:
    """Equal groups of bits, each grown from a seed by the bit with the greatest correlation to it."""
    share = np.diag(both) / max(n, 1)
    spread = np.sqrt(np.maximum(share * (1 - share), 1e-12))
    tie = np.abs((both / max(n, 1) - np.outer(share, share)) / np.outer(spread, spread))
    np.fill_diagonal(tie, 0)
    left, groups = list(range(BITS)), []
    for k in range(partitions):
        size = len(left) // (partitions - k)
        first = max(left, key=lambda b: (tie[b, left].sum(), -b))
        group = [first]
        left.remove(first)
        while len(group) < size:
            best = max(left, key=lambda b: (tie[b, group].sum(), -b))
            group.append(best)
            left.remove(best)
        groups.append(sorted(group))
    return groups


def estimated_candidates(n: int, both: np.ndarray, group: list[int], limit: int) -> list[float]:
    """Estimated candidate pairs and probes of a partition for thresholds 0 to limit.

    Two fingerprints differ in bit b with probability 2p(1-p); taking bits as independent, the number of differing bits
    of a partition has the distribution summed here. Probes count like candidates: each is a row of the search.
    """
    share = np.diag(both)[group] / max(n, 1)
    chance = np.zeros(limit + 1)
    chance[0] = 1
    for q in 2 * share * (1 - share):
        chance[1:], chance[0] = chance[1:] * (1 - q) + chance[:-1] * q, chance[0] * (1 - q)
    pairs = n * (n - 1) / 2 * np.cumsum(chance)
    return [float(p) + n * sum(math.comb(len(group), e) for e in range(t + 1)) for t, p in enumerate(pairs)]


def allocate(costs: list[list[float]], distance: int) -> tuple[float, list[int]]:
    """Thresholds (-1 and up) that sum to distance - partitions + 1 at the least cost, by dynamic programming."""
    budget = distance + 1  # of t_i + 1
    best: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
    for cost in costs:
        following: dict[int, tuple[float, list[int]]] = {}
        for used, (total, chosen) in best.items():
            for t in range(-1, min(len(cost) - 1, budget - used - 1) + 1):
                reached = (total + (cost[t] if t >= 0 else 0.0), [*chosen, t])
                if used + t + 1 not in following or reached < following[used + t + 1]:
                    following[used + t + 1] = reached
        best = following
    return best[budget]


def plan(n: int, both: np.ndarray, distance: int) -> list[tuple[list[int], int]]:
    """The (bits, threshold) of each partition that is searched, from the cheapest number of partitions."""
    plans = []
    for partitions in range(1, min(distance + 3, 8) + 1):
        groups = group_bits(n, both, partitions)
        costs = [estimated_candidates(n, both, g, distance) for g in groups]
        total, chosen = allocate(costs, distance)
        plans.append((total, partitions, [(g, t) for g, t in zip(groups, chosen, strict=True) if t >= 0]))
    return min(plans)[2]


# Search


def _entries(parts: list[tuple[list[int], int]]):
    """Index and probe rows: of each fingerprint its own key in each partition, and the keys within the threshold."""
    masks = [np.uint64(sum(1 << b for b in bits)) for bits, _ in parts]
    flips = [
        np.array([sum(1 << b for b in c) for e in range(1, t + 1) for c in combinations(bits, e)], np.uint64)
        for bits, t in parts
    ]

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            every = batch["fp"].to_numpy(zero_copy_only=False).view(np.uint64)
            for part, (mask, flip) in enumerate(zip(masks, flips, strict=True)):
                step = max(1, (1 << 18) // (1 + len(flip)))
                for at in range(0, len(every), step):
                    own = every[at : at + step]
                    near = ((own & mask)[:, None] ^ flip[None, :]).ravel()
                    keys = np.concatenate([own & mask, near]).view(np.int64)
                    prints = np.concatenate([own, np.repeat(own, len(flip))]).view(np.int64)
                    probe = np.concatenate([np.zeros(len(own), bool), np.ones(len(near), bool)])
                    arrays = [pa.array(np.full(len(keys), part, np.int32)), *map(pa.array, (keys, prints, probe))]
                    yield pa.RecordBatch.from_arrays(arrays, names=["part", "key", "fp", "probe"])

    return emit


def _forest(left: np.ndarray, right: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect the components of the pairs (left, right) within the distance: at most as many as rows."""
    nodes, near = np.unique(np.concatenate([left, right])), []
    for at in range(0, len(left), 256):
        a, b = np.nonzero(np.bitwise_count(left[at : at + 256, None] ^ right[None, :]) <= distance)
        near.append((a + at, b))
    a = np.searchsorted(nodes, left[np.concatenate([x for x, _ in near])])
    b = np.searchsorted(nodes, right[np.concatenate([x for _, x in near])])
    a, b = a[a != b], b[a != b]
    label = np.arange(len(nodes))
    while len(a):
        low = np.minimum(label[a], label[b])
        before = label.copy()
        np.minimum.at(label, a, low)
        np.minimum.at(label, b, low)
        label = label[label]
        if (label == before).all():
            break
    other = np.flatnonzero(label != np.arange(len(nodes)))
    return nodes[label[other]], nodes[other]


def _small_buckets(fp: np.ndarray, probe: np.ndarray, bounds: np.ndarray, distance: int):
    """Near pairs of many buckets at once: each row against the index rows of its bucket."""
    sizes = np.diff(bounds)
    bucket = np.repeat(np.arange(len(sizes)), sizes)
    n = sizes[bucket]
    left = np.repeat(np.arange(len(fp)), n)
    right = np.arange(len(left)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(bounds[:-1][bucket], n)
    near = ~probe[right] & (np.bitwise_count(fp[left] ^ fp[right]) <= distance) & (fp[left] != fp[right])
    return fp[left[near]], fp[right[near]]


def _search(distance: int):
    """Reads rows sorted by bucket block; emits links."""

    def links(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
        pairs = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)], 1), axis=0) if len(a) else np.zeros((0, 2), np.uint64)
        arrays = [pa.array(np.ascontiguousarray(pairs[:, k]).view(np.int64)) for k in (0, 1)]
        return pa.RecordBatch.from_arrays(arrays, names=["a", "b"])

    def solve(columns: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        part, key, b1, b2, fp, probe, side = columns
        new = np.ones(len(fp), bool)
        new[1:] = (part[1:] != part[:-1]) | (key[1:] != key[:-1]) | (b1[1:] != b1[:-1]) | (b2[1:] != b2[:-1])
        bounds = np.append(np.flatnonzero(new), len(fp))
        sizes = np.diff(bounds)
        split = (b1 != b2)[bounds[:-1]] if len(fp) else np.zeros(0, bool)
        small = (sizes <= 24) & ~split
        rows = np.repeat(small, sizes)
        if rows.any():
            small_sizes = sizes[small]
            for chunk in np.array_split(np.arange(len(small_sizes)), max(1, int((small_sizes**2).sum() >> 21))):
                ends = np.cumsum(small_sizes)
                lo, hi = (ends[chunk[0]] - small_sizes[chunk[0]], ends[chunk[-1]]) if len(chunk) else (0, 0)
                own = np.flatnonzero(rows)[lo:hi]
                at = np.concatenate([[0], np.cumsum(small_sizes[chunk])])
                yield links(*_small_buckets(fp[own], probe[own], at, distance))
        for g in np.flatnonzero(~small & (sizes > 1)):
            s = slice(bounds[g], bounds[g + 1])
            index = ~probe[s]
            if split[g]:  # two different blocks of a bucket: one side against the other, probes against index rows
                first = side[s] == 1
                yield links(*_forest(fp[s][first], fp[s][~first & index], distance))
                if probe[s][~first].any():
                    yield links(*_forest(fp[s][~first], fp[s][first & index], distance))
            elif index.any():
                yield links(*_forest(fp[s], fp[s][index], distance))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list[np.ndarray]] = []
        for batch in batches:
            columns = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
            columns[4] = columns[4].view(np.uint64)
            if not len(columns[0]):
                continue
            # The last bucket block of a batch may go on in the next one.
            last = [c[-1] for c in columns[:4]]
            same = np.logical_and.reduce([c == v for c, v in zip(columns[:4], last, strict=True)])
            tail = int(np.argmin(same[::-1])) if not same.all() else len(same)
            cut = len(same) - tail
            if cut:
                whole = [np.concatenate(c) for c in zip(*held, [c[:cut] for c in columns], strict=True)]
                yield from solve(whole)
                held = []
            held.append([c[cut:] for c in columns])
            if cut == 0 and len(held) > 1 and any(h[k][0] != columns[k][0] for h in held[-2:-1] for k in range(4)):
                yield from solve([np.concatenate(c) for c in zip(*held[:-1], strict=True)])
                held = held[-1:]
        if held:
            yield from solve([np.concatenate(c) for c in zip(*held, strict=True)])

    return search


def _split(held: DataFrame, parts: list[tuple[list[int], int]], distance: int, limit: int) -> DataFrame:
    """The rows of buckets, of which those over the limit are split by their other bits.

    Outside a partition's bits near fingerprints differ by at most the distance as well, so of distance + 1 groups of the
    other bits one at least is equal: each row goes to that many smaller buckets, whatever the size of the old one.
    """
    subs = distance + 1
    masks = []
    for bits, _ in parts:
        other = [b for b in range(BITS) if b not in bits]
        masks += [sum(1 << b for b in other[len(other) * k // subs : len(other) * (k + 1) // subs]) for k in range(subs)]
    signed = [m - (1 << BITS) if m >> (BITS - 1) else m for m in masks]
    hot = held.where(F.col("n") > limit).select("part", "key", "fp", "probe", F.explode(F.sequence(F.lit(0), F.lit(subs - 1))).alias("sub"))
    mask = F.element_at(F.array(*map(F.lit, signed)), F.col("part") * subs + F.col("sub") + 1)
    key = F.xxhash64("part", "key", "sub", F.col("fp").bitwiseAND(mask))
    hot = stored(hot.select("part", key.alias("key"), "fp", "probe"))
    counts = hot.groupBy("part", "key").agg(F.count("*").alias("n"), F.count_if("probe").alias("probes"))
    smaller = hot.join(stored(counts.where("n > 1 AND probes < n")), ["part", "key"])
    columns = ["part", "key", "fp", "probe", "n"]
    return held.where(F.col("n") <= limit).select(*columns).unionByName(smaller.select(*columns))


def linked(prints: DataFrame, distance: int = DISTANCE, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """a, b: links between distinct fingerprints (column fp) within the distance that connect every component."""
    n, both = bit_pair_counts(prints)
    parts = plan(n, both, distance)
    rows = stored(prints.select("fp").mapInArrow(_entries(parts), "part int, key bigint, fp bigint, probe boolean"))
    counts = rows.groupBy("part", "key").agg(
        F.count("*").alias("n"), F.count_if("probe").alias("probes")
    ).where("n > 1 AND probes < n")
    # Stored, so that both sides of the join are plain shuffles, whose large parts adaptive execution can split.
    counts = stored(counts)
    held = rows.join(counts, ["part", "key"])
    if not counts.where(F.col("n") > HOT_BLOCKS * block_rows).isEmpty():
        held = _split(held, parts, distance, HOT_BLOCKS * block_rows)
    blocks = F.ceil(F.col("n") / block_rows).cast("int")
    # A row of block i takes part in the block pairs (i, j) and (j, i) with the smaller first.
    own = F.pmod(F.xxhash64("fp", "probe"), blocks).cast("int")
    dealt = held.select("part", "key", "fp", "probe", own.alias("own"), F.explode(F.sequence(F.lit(0), blocks - 1)).alias("other"))
    dealt = dealt.select(
        "part",
        "key",
        F.least("own", "other").alias("b1"),
        F.greatest("own", "other").alias("b2"),
        "fp",
        "probe",
        F.when(F.col("own") <= F.col("other"), 1).otherwise(2).alias("side"),
    )
    sorted_rows = dealt.repartition("part", "key", "b1", "b2").sortWithinPartitions("part", "key", "b1", "b2")
    return sorted_rows.mapInArrow(_search(distance), "a bigint, b bigint")


def components(links: DataFrame, rounds: int = 64) -> DataFrame:
    """node, root: the least node (as a signed number) that each linked node reaches. Nodes without links have no row.

    Each round links the neighbours of a node to the least of them (first larger ones, then all), which keeps
    components whole and flattens them to stars; it ends when nothing changes. The least are stored before they are
    joined, so that the edges of a node with many neighbours are split over tasks.
    """
    edges = stored(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct())
    for _ in range(rounds):
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = stored(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = stored(large.where("u <> v").distinct())
        least = stored(large.groupBy("u").agg(F.min("v").alias("m")))
        small = large.join(least, "u").select(
            F.explode(F.array(F.struct(F.col("u"), F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e")
        )
        following = stored(small.select("e.*").where("u <> v").distinct())
        state = lambda e: e.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
        done = state(following) == state(edges)
        edges = following
        if done:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    raise RuntimeError(f"components did not settle in {rounds} rounds")


def near_duplicates(docs: DataFrame, words: int = SHINGLE, distance: int = DISTANCE, seed: int = SEED) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id (the least id reachable by links)."""
    prints = stored(fingerprints(docs, words, seed))
    groups = prints.groupBy("fp").agg(F.min("doc_id").alias("least"))
    distinct = stored(groups)
    roots = components(linked(distinct, distance))
    of = distinct.join(roots, F.col("fp") == F.col("node"), "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root")
    )
    of = stored(of)
    smallest = stored(of.groupBy("root").agg(F.min("least").alias("component_id")))
    found = of.join(smallest, "root").select("fp", "component_id")
    return prints.join(found, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def keep_one(docs: DataFrame, words: int = SHINGLE, distance: int = DISTANCE, seed: int = SEED) -> DataFrame:
    """One document of each group, that whose id is the component's; all columns as they were.

    Of rows that share that id the one with the least text stays. Rows without an id can't be told apart by it: those
    of a group without any id all stay.
    """
    found = near_duplicates(docs, words, distance, seed)
    kept = found.where(F.col("doc_id").eqNullSafe(F.col("component_id"))).select(F.col("doc_id").alias("id")).distinct()
    doc_id = docs["doc_id"].cast("bigint")
    rows = docs.join(kept, doc_id.eqNullSafe(kept["id"]), "left_semi")
    # Rows without an id are parted by text, lest they meet in one task.
    same = Window.partitionBy(docs["doc_id"], F.when(doc_id.isNull(), F.xxhash64(docs["text"]))).orderBy(docs["text"])
    place = fresh(docs.columns, "place")
    numbered = rows.select(*(docs[name] for name in docs.columns), F.row_number().over(same).alias(place))
    return numbered.where(numbered["doc_id"].isNull() | (numbered[place] == 1)).drop(place)
