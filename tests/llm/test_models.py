"""The learnt operators end to end: whole registered queries against versions in one process, written plainly."""

import math
import re
from collections import Counter
from functools import partial

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from perigee.llm import hmm, language, quality, queries, texts
from tests.llm import brute

SMALL, MEDIUM = "/root/testdata/sf0.001", "/root/testdata/sf0.01"


def rows_of(sf_dir, columns="doc_id, text", table="documents"):
    return duckdb.sql(f"SELECT {columns} FROM '{sf_dir}/{table}.parquet'").fetchall()


def result(spark, name, sf_dir):
    return {r["doc_id"]: r for r in queries.queries()[name](spark, sf_dir).collect()}


def drawn(spark, ids, *more):
    """Spark's xxhash64 of each id."""
    table = spark.createDataFrame([(i,) for i in ids], "id bigint")
    return {r[0]: r[1] for r in table.select("id", F.xxhash64("id", *map(F.lit, more))).collect()}


# Quality


def statistics(text):
    data = (text or "").encode()
    words = re.findall(rb"[^\x20\x09-\x0D]+", data)
    lines = [line for line in data.split(b"\n") if line]
    some, chars = max(len(words), 1), max(len(data), 1)
    lengths = [min(len(w), 1000) for w in words]
    lower = [w.lower() for w in words]

    def places(size):
        """Of the sequences of this size that stand twice or more."""
        grams = [tuple(lower[k : k + size]) for k in range(len(lower) - size + 1)]
        often = Counter(grams)
        return [k for k, g in enumerate(grams) if often[g] > 1]

    low, high = 0, len(lower)
    while low < high:
        middle = (low + high + 1) // 2
        low, high = (middle, high) if places(middle) else (low, middle - 1)
    covered = {k + j for k in places(5) for j in range(5)}

    def number(characters):
        return sum(data.count(c.encode()) for c in characters)

    mean = sum(lengths) / some
    return [
        math.log1p(len(words)),
        math.log1p(chars),
        mean,
        math.sqrt(max(sum(n * n for n in lengths) / some - mean * mean, 0)),
        math.log1p(max(lengths, default=0)),
        number("ABCDEFGHIJKLMNOPQRSTUVWXYZ") / chars,
        number("0123456789") / chars,
        number("#$%&*+/<=>@\\^_`{|}~") / some,
        number(".,;:?'\"") / some,
        number("!()[]-") / some,
        sum(b >= 0xC0 for b in data) / chars,
        len(lines) / some,
        len(set(lower)) / some if words else 0,
        len(covered) / some,
        math.log1p(low if low >= 2 else 0),  # a repeat has two words at least
        sum(line[-1:] not in (b".", b"!", b"?") for line in lines) / max(len(lines), 1),
    ]


def monotone(positive, n):
    """The isotonic means of bins with rows, as the greatest of the least means."""
    at = [k for k in range(len(n)) if n[k]]
    p, m = np.append(0, np.cumsum([positive[k] for k in at])), np.append(0, np.cumsum([n[k] for k in at]))
    means = [[(p[j + 1] - p[i]) / (m[j + 1] - m[i]) if j >= i else math.inf for j in range(len(at))] for i in range(len(at))]
    return at, [max(min(means[i][k:]) for i in range(k + 1)) for k in range(len(at))]


def test_quality_equals_the_plain_version(spark):
    docs, labels = rows_of(MEDIUM), dict(rows_of(MEDIUM, "doc_id, quality", "labels"))
    x = np.array([statistics(t) for _, t in docs])
    z = np.clip((x - x.mean(0)) / np.maximum(x.std(0), 1e-9**0.5), -5, 5)
    rng = np.random.default_rng(quality.SEED)
    projection = rng.normal(size=(x.shape[1], quality.FEATURES)) / quality.WIDTH
    phase = rng.uniform(0, 2 * np.pi, quality.FEATURES)
    f = np.hstack([np.cos(z @ projection + phase) * math.sqrt(2 / quality.FEATURES), np.ones((len(x), 1))])
    hashed = drawn(spark, [i for i, _ in docs])
    known = [k for k, (i, _) in enumerate(docs) if labels.get(i) is not None and brute.fold(i, 3) != 1]
    apart = [k for k in known if hashed[docs[k][0]] % 5 == 0]
    used = [k for k in known if hashed[docs[k][0]] % 5 != 0]
    # Ridge regression as least squares with a row for each weight.
    penalty = math.sqrt(quality.RIDGE * len(used) / f.shape[1])
    y = np.array([labels[docs[k][0]] for k in used], float)
    weights = np.linalg.lstsq(np.vstack([f[used], penalty * np.eye(f.shape[1])]), np.append(y, np.zeros(f.shape[1])), rcond=None)[0]
    raw = np.clip(f @ weights, 0, 1)
    positive, n = [0] * quality.BINS, [0] * quality.BINS
    for k in apart:
        n[b := min(int(raw[k] * quality.BINS), quality.BINS - 1)] += 1
        positive[b] += labels[docs[k][0]]
    steps = np.interp(range(quality.BINS), *monotone(positive, n))
    want = np.interp(raw, [(b + 0.5) / quality.BINS for b in range(quality.BINS)], steps)
    found = result(spark, "op4_quality", MEDIUM)
    assert len(known) > 250 and len(apart) > 40
    assert np.abs(np.array([found[i]["score"] for i, _ in docs]) - want).max() < 1e-6


# Language


def plain_shares(text):
    """Share of each bucket, from a list of the text's subwords."""
    folded = bytes(b | 0x20 if chr(b).isascii() and chr(b).isalpha() else b if b >= 0x80 else 0x20 for b in (text or "").encode())
    found = Counter()
    for a, b in zip(folded, folded[1:], strict=False):
        if (a, b) != (0x20, 0x20):
            found[int(language._PAIRS[a * 256 + b])] += 1
    for a, b, c in zip(folded, folded[1:], folded[2:], strict=False):
        if (a, b) != (0x20, 0x20) != (b, c):
            found[((a << 16 | b << 8 | c) * 0x9E3779B97F4A7C15 % 2**64) >> 52] += 1
    return {k: n / found.total() for k, n in found.items()}


def test_language_equals_a_fit_in_one_process(spark):
    docs = rows_of(SMALL, "doc_id, text, lang")
    hashed = drawn(spark, [i for i, _, _ in docs], language.SEED)
    shares = {i: plain_shares(t) for i, t, _ in docs}
    sample = [(hashed[i] % (1 << 20), i, lang) for i, t, lang in docs if None not in (t, lang) and brute.fold(i, 4) != 2]
    sample.sort()
    languages = sorted({lang for *_, lang in sample})
    assert len({d for d, *_ in sample}) == len(sample) <= language.PER_LANGUAGE  # whole, in one order
    x = np.zeros((len(sample), language.BUCKETS), np.float32)
    for row, (_, i, _) in enumerate(sample):
        for k, share in shares[i].items():
            x[row, k] = share
    model = language.train(x, np.array([languages.index(lang) for *_, lang in sample]), languages)
    found = result(spark, "op5_language", SMALL)
    for i, text, _ in docs:
        if not any(map(str.isalpha, text or "")):
            assert (found[i]["lang_pred"], found[i]["score"]) == ("und", 0)
            continue
        average = sum(share * model.embedding[k] for k, share in shares[i].items())
        logits = (average @ model.weights + model.bias) / model.temperature
        chances = np.exp(logits - logits.max())
        chances /= chances.sum()
        assert found[i]["lang_pred"] == languages[int(chances.argmax())]
        assert found[i]["score"] == pytest.approx(chances.max(), abs=1e-6)
        assert found[i]["rejected"] == (found[i]["score"] < model.reject_below)


# Language model


@pytest.mark.parametrize(("frequent", "classes"), [(hmm.FREQUENT, hmm.CLASSES), (300, 100)])
def test_scores_of_the_language_model_equal_the_plain_recursion(spark, monkeypatch, frequent, classes):
    """The model's likelihood of every text, from words, counts and classes told by plain means; with rare words also."""
    learnt = []
    baum_welch = hmm.baum_welch
    monkeypatch.setattr(hmm, "vocabulary", partial(hmm.vocabulary, frequent=frequent, classes=classes))
    monkeypatch.setattr(hmm, "baum_welch", lambda *a: learnt.append(baum_welch(*a)) or learnt[-1])
    found = result(spark, "op6_hmm", SMALL)
    [model] = learnt
    docs = rows_of(SMALL)
    split = {i: [w.lower() for w in re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode())] for i, t in docs}
    n = Counter(w for i, _ in docs if brute.fold(i, 5) != 1 for w in split[i])
    ends = sum(brute.fold(i, 5) != 1 for i, _ in docs)
    every = sorted({w for words in split.values() for w in words})
    [block] = texts.blocks(pa.array([b" ".join(every).decode()]))
    key = dict(zip(every, map(int, hmm.tokens(block)[0]), strict=True))
    assert len(set(key.values())) == len(every)
    # Frequent words: whole eighths of a power of two of their counts, as many as fit, the end among them.
    level = Counter(math.floor(math.log2(c) * 8) for c in [*n.values(), ends])
    held, lowest = 0, math.inf
    for k in sorted(level, reverse=True):
        held += level[k]
        if held > frequent:
            break
        lowest = k
    top = sorted((w for w in n if math.floor(math.log2(n[w]) * 8) >= lowest), key=lambda w: (-n[w], key[w]))
    ranked = sorted([(-n[w], key[w], w) for w in top] + [(-ends, int(hmm._END), None)])
    own = {w: None for *_, w in ranked[:classes] if w is not None}
    own = {w: k + 1 for k, w in enumerate(sorted(own, key=key.get))}
    mass, distinct = Counter(), Counter()
    for w, c in n.items():
        if w not in own:
            mass[key[w] & 1023] += c
            distinct[key[w] & 1023] += 1
    start, move, emit = (np.asarray(m) for m in model)
    assert (len(top) < len(n)) == (frequent == 300)
    for i, _ in docs:
        inside, alpha, total = 0.0, start, 0.0
        for at, w in enumerate([*split[i], None]):
            if w is None:
                symbol = 0
            elif w in own:
                symbol = own[w]
            else:
                symbol = len(own) + 1 + (key[w] & 1023)
                of = key[w] & 1023
                inside += math.log10((n[w] + 0.5) / (mass[of] + 0.5 * (distinct[of] + 1)))
            alpha = (alpha @ move if at else alpha) * emit[:, symbol]
            total += math.log10(alpha.sum())
            alpha = alpha / alpha.sum()
        assert found[i]["score"] == pytest.approx(total + inside, rel=1e-9)
