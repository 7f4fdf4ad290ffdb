"""Word and hash helpers over Arrow text columns, used inside tasks.

Texts are handled whole, in blocks of rows of about BLOCK bytes (a longer text is a block of its own), so that the
temporary arrays of a block stay small whatever a batch holds. A null text is an empty one.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BLOCK = 1 << 18
BLOCK_ROWS = 1024
_BASE = 0x9E3779B97F4A7C15 | 1
_MIX = np.uint64(0xD6E8FEB86659FD93)

#: Bytes of words that white space separates: all but \x20 and \x09-\x0D.
NOT_SPACE = np.ones(256, bool)
NOT_SPACE[[0x20, *range(0x09, 0x0E)]] = False
#: Bytes of words of letters and digits: 0-9, A-Z, a-z and whatever is not ASCII.
ALNUM = np.zeros(256, bool)
ALNUM[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
#: Bytes of lines.
NOT_NEWLINE = np.ones(256, bool)
NOT_NEWLINE[0x0A] = False
#: Bytes that begin a code point.
LEAD = np.ones(256, bool)
LEAD[0x80:0xC0] = False


class Block(NamedTuple):
    first: int
    data: np.ndarray  # bytes of the texts, end to end
    offsets: np.ndarray  # of each text in data, and the end

    def text(self, row: int) -> bytes:
        return self.data[self.offsets[row] : self.offsets[row + 1]].tobytes()


class Units(NamedTuple):
    starts: np.ndarray
    ends: np.ndarray
    bounds: np.ndarray  # of each text's units, and the end

    @property
    def rows(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.bounds) - 1), np.diff(self.bounds))


def blocks(column: pa.Array) -> Iterator[Block]:
    column = pc.fill_null(column, "").cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)
    row = 0
    while row < len(column):
        end = max(row + 1, int(np.searchsorted(offsets, offsets[row] + BLOCK, "right")) - 1)
        end = min(end, row + BLOCK_ROWS, len(column))
        yield Block(row, data[offsets[row] : offsets[end]], offsets[row : end + 1] - offsets[row])
        row = end


def units(block: Block, inside: np.ndarray) -> Units:
    """Maximal runs of the bytes marked in `inside`, none across two texts."""
    mask = inside[block.data]
    cut = np.zeros(len(mask) + 1, bool)
    cut[block.offsets] = True
    begin, end = mask.copy(), mask.copy()
    begin[1:] &= ~mask[:-1] | cut[1:-1]
    end[:-1] &= ~mask[1:] | cut[1:-1]
    starts = np.flatnonzero(begin)
    return Units(starts, np.flatnonzero(end) + 1, np.searchsorted(starts, block.offsets))


_powers: dict[str, np.ndarray] = {}


def _power(name: str, base: int, n: int) -> np.ndarray:
    """Powers of the base modulo 2^64, kept up to the block length."""
    kept = _powers.get(name)
    if kept is None or len(kept) < n:
        steps = np.full(max(n, BLOCK), base, np.uint64)
        steps[0] = 1
        kept = np.multiply.accumulate(steps)
        if len(kept) <= 4 * BLOCK:
            _powers[name] = kept
    return kept[:n]


def _table(lower: bool) -> np.ndarray:
    table = np.random.default_rng(20177).integers(1, 1 << 63, 256, np.uint64) * np.uint64(2) + np.uint64(1)
    if lower:
        table[0x41:0x5B] = table[0x61:0x7B]
    return table


_TABLES = {lower: _table(lower) for lower in (False, True)}


def mixed(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(32))) * _MIX
    return values ^ (values >> np.uint64(29))


def hashes(block: Block, found: Units, lower: bool = False) -> np.ndarray:
    """A 64-bit hash of each unit's bytes, the same in every block; A-Z as a-z if wanted."""
    n = len(block.data)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(_TABLES[lower][block.data] * _power("up", _BASE, n), out=sums[1:])
    down = _power("down", pow(_BASE, -1, 1 << 64), n + 1)
    return mixed((sums[found.ends] - sums[found.starts]) * down[found.starts])


def windows(values: np.ndarray, n: int) -> np.ndarray:
    """A hash of each n consecutive values."""
    out = np.zeros(max(0, len(values) - n + 1), np.uint64)
    for k in range(n):
        out = mixed(out * np.uint64(_BASE) + values[k : k + len(out)])
    return out


def per_text(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sums of the values of each text, whose units lie between the bounds."""
    sums = np.concatenate([[0], np.cumsum(values, dtype=np.int64 if values.dtype.kind in "bui" else None)])
    return sums[bounds[1:]] - sums[bounds[:-1]]


def largest(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """The largest value of each text; 0 for one without units."""
    out = np.zeros(len(bounds) - 1, values.dtype)
    some = bounds[1:] > bounds[:-1]
    if some.any():
        out[some] = np.maximum.reduceat(values, bounds[:-1][some])
    return out
