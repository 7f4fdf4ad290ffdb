"""Hidden Markov language model (operator 6).

Tokens are the words of a text (white space separates, A-Z lower-cased) and one end. Words are counted over all training
texts. The most frequent, at most FREQUENT of them, are sent to all tasks; the CLASSES most frequent of these and the
end are symbols of their own, every other word is a symbol by the hash of its last bytes. Within such a class a word has
the share (c + 0.5) / (n + 0.5 (v + 1)) of the class's n counts of v words. The hidden Markov model over symbols is
trained by Baum-Welch: expected counts are summed by partition. First steps read a part of the training texts each, larger
from step to step, and let earlier counts fade; the last WHOLE steps each sum the counts of all training texts. The scaled forward recursion gives the likelihood of a whole text.

What is broadcast is bounded: FREQUENT words, the model and the class totals. Counts of all other words are joined.

Defined cases: a null text is an empty one and consists of its end; nothing to learn from leaves a uniform model with
one unseen word (N = V = 0); repeated rows and ids are scored each for itself; a null id is not learnt from.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from perigee.llm import texts
from perigee.llm.shared import mapped, one_vector, stored, summed

STATES, FREQUENT, CLASSES, SUFFIX_BITS, SEED = 16, 1 << 17, 1 << 12, 10, 3
#: Parts of the training texts, in 64ths, that the steps of Baum-Welch read one after the other.
STEPS = (1, 1, 2, 2, 4, 6, 8, 16, 24)
DECAY = 0.7
#: Steps over all training texts after those.
WHOLE = 2
#: Tokens that a task counts, or texts' tokens that it scores, at once.
CHUNK = 1 << 20
_SUFFIX = np.uint64((1 << SUFFIX_BITS) - 1)
#: The end token's key; its last bits are no suffix class.
_END = np.uint64(0x5EED5EED5EED5EED)


def tokens(block: texts.Block) -> tuple[np.ndarray, np.ndarray]:
    """The keys of each text's words, and its bounds. The last bits of a key are the class of the word's last 3 bytes."""
    words = texts.units(block, texts.NOT_SPACE)
    tails = texts.Units(np.maximum(words.starts, words.ends - 3), words.ends, words.bounds)
    keys = texts.hashes(block, words, lower=True) & ~_SUFFIX
    return keys | (texts.hashes(block, tails, lower=True) & _SUFFIX), words.bounds


def counts(docs: DataFrame) -> DataFrame:
    """key, n: how often each token occurs. Tasks count before the shuffle, a chunk of tokens at a time."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, ends = [], 0, 0

        def flush() -> pa.RecordBatch:
            keys, n = np.unique(np.concatenate([*held, np.zeros(0, np.uint64)]), return_counts=True)
            if ends:
                keys, n = np.append(keys, _END), np.append(n, ends)
            return pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(n)], names=["key", "n"])

        for batch in batches:
            ends += len(batch)
            for block in texts.blocks(batch["text"]):
                keys, _ = tokens(block)
                held.append(keys)
                size += len(keys)
                if size >= 4 * CHUNK:
                    yield flush()
                    held, size, ends = [], 0, 0
        yield flush()

    rows = mapped(docs.select("text"), count, "key bigint, n bigint")
    return rows.groupBy("key").agg(F.sum("n").alias("n"))


class Vocabulary(NamedTuple):
    """What tasks know of words: the frequent ones, and the classes of the others."""

    total: int
    distinct: int
    keys: np.ndarray  # of frequent words, sorted
    n: np.ndarray
    symbol: np.ndarray  # of frequent words
    own: int  # symbols of one word, the end included
    class_mass: np.ndarray  # n + 0.5 (v + 1) of the words without a symbol of their own, by class
    symbol_counts: np.ndarray

    @property
    def base_mass(self) -> float:
        return self.total + 0.5 * (self.distinct + 1)


def vocabulary(found: DataFrame, frequent: int = FREQUENT, classes: int = CLASSES) -> tuple[Vocabulary, int]:
    """And the count that frequent words reach."""
    # Words by eighths of a power of two of their count: a few hundred rows.
    level = F.floor(F.log2("n") * 8).cast("int")
    histogram = found.groupBy(level.alias("level")).agg(
        F.count("*").alias("words"), F.sum("n").alias("n"), F.min("n").alias("least")
    )
    levels = sorted(histogram.collect(), key=lambda r: -r["level"])
    total, distinct = sum(r["n"] for r in levels), sum(r["words"] for r in levels)
    least, held = 1 << 62, 0
    for row in levels:
        held += row["words"]
        if held > frequent:
            break
        least = row["least"]
    end = F.col("key") == int(_END.view(np.int64))
    top = found.where((F.col("n") >= least) | end).collect()  # at most `frequent` rows, and the end whatever its count
    keys = np.array([r["key"] for r in top], np.int64).view(np.uint64)
    n = np.array([r["n"] for r in top], np.int64)
    order = np.argsort(keys)
    keys, n = keys[order], n[order]
    rank = np.empty(len(keys), np.int64)
    rank[np.lexsort((keys, -n))] = np.arange(len(keys))
    own = np.flatnonzero((rank < classes) & (keys != _END))
    symbol = (keys & _SUFFIX).astype(np.int64) + len(own) + 1
    symbol[own] = np.arange(len(own)) + 1
    symbol[keys == _END] = 0
    rest = found.where((F.col("n") < least) & ~end).groupBy(
        F.col("key").bitwiseAND(int(_SUFFIX)).alias("class")
    )
    sums = np.zeros((2, int(_SUFFIX) + 1))
    for row in rest.agg(F.sum("n").alias("n"), F.count("*").alias("v")).collect():  # a row per class
        sums[:, row["class"]] = row["n"], row["v"]
    shared = symbol > len(own)
    np.add.at(sums[0], symbol[shared] - len(own) - 1, n[shared])
    np.add.at(sums[1], symbol[shared] - len(own) - 1, 1)
    symbol_counts = np.concatenate([[n[keys == _END].sum()], n[own], sums[0]]).astype(float)
    mass = sums[0] + 0.5 * (sums[1] + 1)
    return Vocabulary(total, distinct, keys, n, symbol, len(own) + 1, mass, symbol_counts), least


def encoded(docs: DataFrame, known: Vocabulary, learn: Column) -> DataFrame:
    """doc_id, rid (a row's own number), step (of training, null if held out), n_tokens, symbols (uint16, the end last),
    n_known and base (log10 sums) of frequent tokens, inside (log10 share within the class, of all tokens but for the
    counts of rare ones), rare (keys of the tokens that are not frequent)."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(known)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = shared.value
        log_n, log_class, log_base = np.log10(v.n + 0.5), np.log10(v.class_mass), np.log10(v.base_mass)
        end_count = v.n[v.keys == _END].sum()
        # Buckets by the first bits of the keys narrow each search to a few of them.
        for batch in batches:
            for block in texts.blocks(batch["text"]):
                keys, bounds = tokens(block)
                order = np.argsort(keys, kind="stable")
                place = np.empty(len(keys), np.int64)
                place[order] = np.searchsorted(v.keys, keys[order])  # in order, so that the search stays in cache
                place = np.minimum(place, max(len(v.keys) - 1, 0))
                hit = v.keys[place] == keys if len(v.keys) else np.zeros(len(keys), bool)
                by_class = (keys & _SUFFIX).astype(np.int64)
                symbol = np.where(hit, v.symbol[place] if len(v.keys) else 0, by_class + v.own)
                base = np.where(hit, log_n[place] if len(v.keys) else 0.0, 0.0)
                inside = np.where(symbol >= v.own, base - log_class[by_class], 0.0)
                n, texts_n = np.diff(bounds) + 1, len(bounds) - 1
                whole = np.insert(symbol, bounds[1:], 0).astype(np.uint16)
                at = np.concatenate([[0], np.cumsum(n)])
                rare, rare_n = keys[~hit].view(np.int64), texts.per_text(~hit, bounds)
                ends = np.log10(end_count + 0.5)
                own = slice(block.first, block.first + texts_n)
                columns = [
                    batch["doc_id"].slice(own.start, texts_n),
                    batch["rid"].slice(own.start, texts_n),
                    batch["step"].slice(own.start, texts_n),
                    pa.array(n, pa.int64()),
                    pa.array([whole[a:b].tobytes() for a, b in zip(at[:-1], at[1:], strict=True)], pa.binary()),
                    pa.array(texts.per_text(hit, bounds) + int(end_count > 0), pa.int64()),
                    pa.array(texts.per_text(base, bounds) + ends - n * log_base),
                    pa.array(texts.per_text(inside, bounds)),
                    pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(rare_n)]), pa.int32()), pa.array(rare)),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=_ENCODED)

    cut = np.cumsum(STEPS)
    bucket = F.pmod(F.xxhash64("doc_id", F.lit(SEED)), F.lit(int(cut[-1])))
    step = F.lit(len(STEPS) - 1)
    for k in range(len(STEPS) - 2, -1, -1):
        step = F.when(bucket < int(cut[k]), k).otherwise(step)
    rows = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        "text",
        F.monotonically_increasing_id().alias("rid"),
        F.when(learn, step).alias("step"),
    )
    return mapped(
        rows,
        encode,
        "doc_id bigint, rid bigint, step int, n_tokens bigint, symbols binary, n_known bigint, base double, "
        "inside double, rare array<bigint>",
    )


_ENCODED = ["doc_id", "rid", "step", "n_tokens", "symbols", "n_known", "base", "inside", "rare"]


class Model(NamedTuple):
    start: np.ndarray  # (states,)
    move: np.ndarray  # (states, states)
    emit: np.ndarray  # (states, symbols)


def initial(known: Vocabulary, states: int = STATES) -> Model:
    """The symbols' shares in each state, unevenly shaken, and states that tend to stay."""
    rng = np.random.default_rng(SEED)
    share = (known.symbol_counts + 0.5) / (known.symbol_counts + 0.5).sum()
    emit = share * rng.gamma(2.0, size=(states, len(share)))
    move = np.full((states, states), 0.2 / states) + 0.8 * np.eye(states)
    return Model(np.full(states, 1 / states), move, emit / emit.sum(1, keepdims=True))


def _chunks(column: pa.Array) -> Iterator[list[tuple[int, np.ndarray]]]:
    """(row, symbols) by falling length, about CHUNK symbols at once."""
    held, size = [], 0
    for row, value in enumerate(column):
        symbols = np.frombuffer(value.as_py(), np.uint16)
        held.append((row, symbols))
        size += len(symbols)
        if size >= CHUNK:
            yield sorted(held, key=lambda x: -len(x[1]))
            held, size = [], 0
    if held:
        yield sorted(held, key=lambda x: -len(x[1]))


def _by_time(chunk: list[tuple[int, np.ndarray]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All symbols, first those at place 0 of each text, then at place 1, ...; where each place begins; how many texts
    it has (a falling number, as texts are in falling length)."""
    lengths = np.array([len(s) for _, s in chunk])
    active = np.searchsorted(-lengths, -np.arange(lengths[0]), "left")
    begin = np.concatenate([[0], np.cumsum(active)])
    out = np.empty(begin[-1], np.int64)
    for k, (_, symbols) in enumerate(chunk):
        out[begin[: len(symbols)] + k] = symbols
    return out, begin, active


def _forward(model: Model, seen: np.ndarray, begin: np.ndarray, active: np.ndarray, keep: bool):
    """Scaled forward recursion over all texts of a chunk at once: the log10 likelihoods; alphas and scales if kept."""
    emission = np.ascontiguousarray(model.emit.T)
    scales = np.empty(len(seen))
    alphas = np.empty((len(seen), len(model.start))) if keep else None
    alpha = np.tile(model.start, (active[0], 1))
    for t, n in enumerate(active):
        at = slice(begin[t], begin[t] + n)
        alpha = (alpha[:n] @ model.move if t else alpha) * emission[seen[at]]
        scale = alpha.sum(1)
        alpha /= scale[:, None]
        scales[at] = scale
        if keep:
            alphas[at] = alpha
    logs, total = np.log10(scales), np.zeros(active[0])
    which = np.arange(len(seen)) - np.repeat(begin[:-1], active)
    np.add.at(total, which, logs)
    return total, alphas, scales


def _expected(model: Model, chunk: list[tuple[int, np.ndarray]]) -> np.ndarray:
    """Expected counts of starts, moves and emissions, end to end."""
    seen, begin, active = _by_time(chunk)
    _, alphas, scales = _forward(model, seen, begin, active, keep=True)
    emission = np.ascontiguousarray(model.emit.T)
    states = len(model.start)
    moves = np.zeros((states, states))
    back = np.ascontiguousarray(model.move.T)
    following, n_following = None, 0
    for t in range(len(active) - 1, -1, -1):
        n = active[t]
        at = slice(begin[t], begin[t] + n)
        beta = np.ones((n, states))
        if n_following:
            moves += alphas[at][:n_following].T @ following
            beta[:n_following] = following @ back
        following = emission[seen[at]] * beta / scales[at][:, None]
        n_following = n
        alphas[at] *= beta  # now the state's probability given the text
    emits = np.stack([np.bincount(seen, alphas[:, k], model.emit.shape[1]) for k in range(states)])
    return np.concatenate([alphas[: active[0]].sum(0), (moves * model.move).ravel(), emits.ravel()])


def _reestimated(gathered: np.ndarray, known: Vocabulary, states: int) -> Model:
    """The model of these expected counts."""
    prior = (known.symbol_counts + 0.5) / (known.symbol_counts + 0.5).sum()
    start = gathered[:states] + 1
    move = gathered[states : states + states**2].reshape(states, states) + 1
    emit = gathered[states + states**2 :].reshape(states, len(prior)) + 20 * prior
    return Model(start / start.sum(), move / move.sum(1, keepdims=True), emit / emit.sum(1, keepdims=True))


def baum_welch(rows: DataFrame, known: Vocabulary, states: int = STATES, whole: int = WHOLE) -> Model:
    """rows: step, symbols. Expected counts of a step are added to those before, which fade; then `whole` steps start from
    none and read all rows that have a step."""
    model = initial(known, states)
    length = states + states * states + states * model.emit.shape[1]
    gathered = np.zeros(length)
    context = rows.sparkSession.sparkContext
    parts = [F.col("step") == step for step in range(len(STEPS))]
    for k, part in enumerate([*parts, *[F.col("step").isNotNull()] * whole]):
        shared = context.broadcast(model)

        def expect(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            total = np.zeros(length)
            for batch in batches:
                for chunk in _chunks(batch["symbols"]):
                    total += _expected(shared.value, chunk)
            yield one_vector(total)

        found = summed(rows.where(part).select("symbols").mapInArrow(expect, "v binary"), length)
        if not found.any():
            continue
        gathered = gathered * DECAY + found if k < len(parts) else found
        model = _reestimated(gathered, known, states)
    return model


def scored(docs: DataFrame, learn: Column, states: int = STATES) -> DataFrame:
    """doc_id, n_tokens, n_known, train_tokens, base_score, score of every text. learn: on doc_id, what is learnt from."""
    found = stored(counts(docs.where(learn)))
    known, least = vocabulary(found)
    rows = stored(encoded(docs, known, learn))
    model = baum_welch(rows, known, states)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def forward(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            score = np.zeros(len(batch))
            for chunk in _chunks(batch["symbols"]):
                score[[row for row, _ in chunk]] = _forward(shared.value, *_by_time(chunk), keep=False)[0]
            columns = [batch[c] for c in ("rid", "doc_id", "n_tokens", "n_known", "base", "inside")]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(score)], names=_SCORED)

    likelihood = rows.select("rid", "doc_id", "n_tokens", "n_known", "base", "inside", "symbols").mapInArrow(
        forward, "rid bigint, doc_id bigint, n_tokens bigint, n_known bigint, base double, inside double, score double"
    )
    # Rare tokens get their counts by a join. By `least` a counted one has few; one unseen in training may have many.
    rare = rows.select("rid", F.explode("rare").alias("key")).join(found.where(F.col("n") < least), "key", "left")
    sums = rare.groupBy("rid").agg(
        F.sum(F.log10(F.coalesce("n", F.lit(0)) + 0.5)).alias("logs"), F.count("n").alias("known")
    )
    logs, more = F.coalesce("logs", F.lit(0.0)), F.coalesce("known", F.lit(0))
    return likelihood.join(sums, "rid", "left").select(
        "doc_id",
        "n_tokens",
        (F.col("n_known") + more).alias("n_known"),
        F.lit(known.total).cast("bigint").alias("train_tokens"),
        (F.col("base") + logs).alias("base_score"),
        (F.col("score") + F.col("inside") + logs).alias("score"),
    )


_SCORED = ["rid", "doc_id", "n_tokens", "n_known", "base", "inside", "score"]
