"""Quality rules with suffix-array repetition (operator 8).

Each text is a sequence of words that white space separates. Its suffix array comes from prefix doubling (ranks of windows
of 1, 2, 4, ... words), the longest common prefixes of neighbouring suffixes from the ranks of the first windows and, where
they are longer, from one walk over the text in which a prefix is at most one word shorter than the one before it. Maximal
repeats are the intervals of these prefixes. The deepest interval around a suffix has the larger of the prefixes it shares
with its neighbours: that is its longest repeat, and each place where that has `min_repeat` words or more begins a repeated
stretch. The stretches are all occurrences of all maximal repeats of that length; their union is the covered part.

The verdict rejects texts that fail the base rule, of which too much is covered, or whose longest repeat is too long, both
in relation to the text's words. The limits are the least, in steps of 0.05 of a text and of 2 words, that together keep 99.5 % of the rows
labelled good in the learning fold of operator 4 (sf0.1). Repeats of two to four words are common phrases in long texts,
so they count for neither limit; windows of three words that come again are the base rule's.

Memory is linear in a text's words. Defined cases: null and empty texts have no words and all counts zero; `kept` is false
for them, as for every text of fewer than MIN_WORDS words. Repeated rows are judged alike. Further columns are ignored or
kept.
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

MIN_WORDS = 50
MAX_REPEAT_WORDS_PERCENT = 50
SYMBOLS = b"#*$%&|<>"


class Limits(NamedTuple):
    min_repeat: int = 5  # words of a repeat that counts
    max_covered: float = 0.15  # share of the words in repeats
    least_longest: int = 8  # words of the longest repeat that any text may have
    max_longest: float = 0.1  # and share of the words


#: Levels of ranks that are kept: by the first 1, 2, ... 64 words.
LEVELS = 7


def suffix_array(keys: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """Suffixes of all texts in order (text, then words), and the ranks by the first 1, 2, 4, ... words up to LEVELS.

    Texts are one after the other in keys, parted by bounds. A suffix has the rank of the first place of its group, so
    ranks of settled suffixes stay and each doubling sorts the unsettled ones alone.
    """
    n = len(keys)
    rows = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    ends = np.repeat(bounds[1:], np.diff(bounds))
    order = np.lexsort((keys, rows))
    new = np.ones(n, bool)
    new[1:] = (keys[order][1:] != keys[order][:-1]) | (rows[order][1:] != rows[order][:-1])
    rank = np.empty(n, np.int64)
    first = np.flatnonzero(new)
    rank[order] = first[np.cumsum(new) - 1]
    levels, width = [rank], 1
    groups = np.diff(np.append(first, n))
    active = order[np.repeat(groups > 1, groups)]
    while len(active):
        after = active + width
        second = np.where(after < ends[active], rank[np.minimum(after, n - 1)], -1)
        own = rank[active]
        place = np.lexsort((second, own))
        active, own, second = active[place], own[place], second[place]
        new = np.ones(len(active), bool)
        group = np.ones(len(active), bool)
        group[1:] = own[1:] != own[:-1]
        new[1:] = group[1:] | (second[1:] != second[:-1])
        # The place of each within its old group is what its rank gains.
        starts = np.flatnonzero(group)
        within = np.arange(len(active)) - starts[np.cumsum(group) - 1]
        first = np.flatnonzero(new)
        rank = rank.copy()
        rank[active] = (own + within)[first][np.cumsum(new) - 1]
        if len(levels) < LEVELS:
            levels.append(rank)
        width *= 2
        groups = np.diff(np.append(first, len(active)))
        active = active[np.repeat(groups > 1, groups)]
    suffixes = np.empty(n, np.int64)
    suffixes[rank] = np.arange(n)
    return suffixes, levels


def _extend(keys: np.ndarray, ends: np.ndarray, left: np.ndarray, right: np.ndarray, common: np.ndarray, known: int) -> None:
    """Common prefixes of `known` words may be longer: in the order of the text each starts from the one before it."""
    open_ones = np.flatnonzero(common == known)
    before, length = 0, 0
    for k in open_ones[np.argsort(right[open_ones])]:
        i, j = int(left[k]), int(right[k])
        length, before = max(known, length - (j - before)), j
        size, most = 64, int(min(ends[i] - i, ends[j] - j))
        while length < most:
            size = min(size, most - length)
            apart = np.flatnonzero(keys[i + length : i + length + size] != keys[j + length : j + length + size])
            if len(apart):
                length += int(apart[0])
                break
            length, size = length + size, 2 * size
        common[k] = length


def longest_repeats(keys: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """The words of the longest sequence that begins at each position and occurs again in its text; under 2 words: 0."""
    n = len(keys)
    longest = np.zeros(n, np.int64)
    if n < 2:
        return longest
    suffixes, levels = suffix_array(keys, bounds)
    if len(levels) < 2:
        return longest
    ends = np.repeat(bounds[1:], np.diff(bounds))
    near = levels[1][suffixes[1:]] == levels[1][suffixes[:-1]]
    left, right = suffixes[:-1][near], suffixes[1:][near]
    i, j = left.copy(), right.copy()
    for level in range(len(levels) - 1, -1, -1):
        inside = (i < ends[left]) & (j < ends[right])
        same = inside & (levels[level][np.minimum(i, n - 1)] == levels[level][np.minimum(j, n - 1)])
        i, j = i + (same << level), j + (same << level)
    common = i - left
    if len(levels) == LEVELS:
        _extend(keys, ends, left, right, common, 2**LEVELS - 1)
    np.maximum.at(longest, left, common)
    np.maximum.at(longest, right, common)
    return longest


def covered(longest: np.ndarray, least: int, width: int | None = None) -> np.ndarray:
    """Which words lie in a stretch that begins where the longest repeat has `least` words; `width` words of it if given."""
    begin = np.flatnonzero(longest >= least)
    steps = np.zeros(len(longest) + 1, np.int64)
    np.add.at(steps, begin, 1)
    np.add.at(steps, begin + (longest[begin] if width is None else width), -1)
    return np.cumsum(steps[:-1]) > 0


_IS_SYMBOL = np.zeros(256, bool)
_IS_SYMBOL[list(SYMBOLS)] = True
_COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_covered", "longest_repeat")


def _dup_lines(block: texts.Block, words: texts.Units) -> np.ndarray:
    """Lines with a word that equal an earlier line of their text."""
    lines = texts.units(block, texts.NOT_NEWLINE)
    keys, rows = texts.hashes(block, lines), lines.rows
    worded = np.searchsorted(words.starts, lines.ends) > np.searchsorted(words.starts, lines.starts)
    keys, rows = keys[worded], rows[worded]
    order = np.lexsort((keys, rows))
    again = (keys[order][1:] == keys[order][:-1]) & (rows[order][1:] == rows[order][:-1])
    return np.bincount(rows[order][1:][again], minlength=len(block.offsets) - 1)


def _counts(block: texts.Block, min_repeat: int) -> list[np.ndarray]:
    words = texts.units(block, texts.NOT_SPACE)
    keys = texts.hashes(block, words)
    longest = longest_repeats(keys, words.bounds)
    leads = np.concatenate([[0], np.cumsum(texts.LEAD[block.data])])
    symbols = np.concatenate([[0], np.cumsum(_IS_SYMBOL[block.data])])
    return [
        np.diff(words.bounds),
        texts.per_text(leads[words.ends] - leads[words.starts], words.bounds),
        np.diff(symbols[block.offsets]),
        _dup_lines(block, words),
        texts.per_text(covered(longest, 3, 3), words.bounds),
        texts.per_text(covered(longest, min_repeat), words.bounds),
        texts.largest(longest, words.bounds),
    ]


def counts(docs: DataFrame, min_repeat: int = Limits().min_repeat) -> DataFrame:
    """doc_id and, as bigint: n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words (words in windows of three that
    occur again), n_covered (words in repeats of min_repeat words) and longest_repeat."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch["doc_id"], *_arrays(batch["text"], min_repeat)], names=["doc_id", *_COUNTS])

    schema = "doc_id bigint, " + ", ".join(f"{c} bigint" for c in _COUNTS)
    return mapped(narrow(docs), count, schema)


def _arrays(column: pa.Array, min_repeat: int) -> list[pa.Array]:
    found = [_counts(block, min_repeat) for block in texts.blocks(column)]
    return [
        pa.array(np.concatenate([f[k] for f in found]) if found else np.zeros(0, np.int64), pa.int64())
        for k in range(len(_COUNTS))
    ]


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_WORDS_PERCENT * F.col("n_words"))


def passes(limits: Limits = Limits()) -> Column:
    """The verdict on a row of counts."""
    n = F.col("n_words")
    return ~base_failed() & (
        (F.col("n_covered") <= limits.max_covered * n)
        & (F.col("longest_repeat") <= F.greatest(F.lit(limits.least_longest), limits.max_longest * n))
    )


def keep_good(docs: DataFrame, limits: Limits = Limits(), max_symbols: float | None = None) -> DataFrame:
    """The documents that pass; all columns as they were. Judged batch by batch where they are read: no shuffle.

    `max_symbols` is a rule of its own beside the operator's: texts with more symbols to a word go too.
    """
    names = docs.columns

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = _arrays(batch["text"], limits.min_repeat)
            n, _, symbols, _, repeated, inside, longest = (v.to_numpy() for v in values)
            failed = (n < MIN_WORDS) | (100 * repeated > MAX_REPEAT_WORDS_PERCENT * n)
            good = (inside <= limits.max_covered * n) & (longest <= np.maximum(limits.least_longest, limits.max_longest * n))
            if max_symbols is not None:
                good &= symbols <= max_symbols * n
            yield batch.select(names).filter(pa.array(~failed & good))

    return mapped(docs, judge, docs.schema)
