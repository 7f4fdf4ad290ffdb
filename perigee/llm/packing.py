"""Packing by vector bin packing with the dot-product heuristic (operator 10).

An example is a text's tokens and one end token; its demand is (tokens, one segment, loss-bearing tokens). Examples of
more tokens than a sequence holds first give whole sequences. Then a sequence is filled piece by piece: of the waiting
examples that fit under all limits, the one with the greatest dot product of its demand and what is left, both as shares
of the limits, goes in. If none fits whole, one is cut to the room that is left. A pool of waiting examples has bounded
size and each task packs what it reads, so nothing is shuffled and no task holds more than a pool. What a task has left
at its end goes into sequences whose lengths are powers of two, which need no padding.

The tokeniser's file is a parameter. Ids are those of `tokenizers`; a rank-based encoder built from the same file does
the work, and `tokenizers` itself takes texts that name a special token or that the encoder refuses.

Defined cases: a null or empty text is its end token alone; repeated rows and ids are packed each for itself; a null id
stays null; an empty table gives no rows. `prompt_chars`, if the table has it, is the number of leading characters that
bear no loss (null: none). Other columns are ignored.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Callable, Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from perigee.llm.shared import mapped

END_ID = 1
POOL = 2048
#: Room that is padded instead of being filled by a cut.
LEAST_CUT = 16
# Fixed value: how the vocabulary's makers part a text into words before merging.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


class Limits(NamedTuple):
    tokens: int = 2048
    segments: int = 64
    loss_tokens: int = 2048


class Piece(NamedTuple):
    doc_id: int | None
    start: int
    ids: np.ndarray
    doc_tokens: int
    loss_from: int  # tokens before it bear no loss

    @property
    def loss(self) -> int:
        return max(0, self.start + len(self.ids) - max(self.start, self.loss_from))

    def cut(self, at: int) -> tuple[Piece, Piece]:
        return self._replace(ids=self.ids[:at]), self._replace(start=self.start + at, ids=self.ids[at:])


def _byte_of_character() -> dict[str, int]:
    """Byte-level vocabularies write a byte as a character: printable ones as they are, the others from U+0100 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(0x100 + k): b for k, b in enumerate(others)}


@lru_cache(maxsize=2)
def _encoder(file: str) -> Callable[[str], np.ndarray]:
    made = json.loads(file)
    special = [token["content"] for token in made.get("added_tokens", [])]
    to_byte = _byte_of_character()
    ranks = {bytes(to_byte[c] for c in t): i for t, i in made["model"]["vocab"].items() if t not in special}
    fast = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    exact: list[Tokenizer] = []

    def encode(text: str) -> np.ndarray:
        if not any(token in text for token in special):
            try:
                return np.array(fast.encode_ordinary(text), np.uint32)
            except ValueError:  # a run that its pattern can't take
                pass
        if not exact:
            exact.append(Tokenizer.from_str(file))
        return np.array(exact[0].encode(text, add_special_tokens=False).ids, np.uint32)

    return encode


class Packer:
    """Takes examples, gives whole sequences (lists of pieces)."""

    def __init__(self, limits: Limits, pool: int = POOL) -> None:
        if min(limits) < 1:
            raise ValueError("limits must be positive")
        self.limits, self.size = np.array(limits, float), pool
        self.tokens = limits.tokens
        self.pool: list[Piece] = []

    def add(self, example: Piece) -> Iterator[list[Piece]]:
        whole = min(self.tokens, int(self.limits[2]))
        while len(example.ids) > whole:
            piece, example = example.cut(whole)
            if whole == self.tokens:
                yield [piece]
            else:
                self.pool.append(piece)
        self.pool.append(example)
        if len(self.pool) >= self.size:
            yield from self._fill(until=self.size // 4)

    def finish(self) -> Iterator[list[Piece]]:
        yield from self._fill(until=0)

    def _fill(self, until: int) -> Iterator[list[Piece]]:
        """Sequences from the pool while more than `until` pieces wait; at 0, all of it."""
        pool = self.pool
        demand = np.array([(len(p.ids), 1, p.loss) for p in pool], float).reshape(-1, 3)
        waiting, n_waiting = np.ones(len(pool), bool), len(pool)
        while n_waiting > until:
            room, chosen = self.limits.copy(), []
            while n_waiting and room[0] > 0 and room[1] >= 1:
                fits = waiting & (demand <= room).all(1)
                if fits.any():
                    score = np.where(fits, demand @ (room / self.limits**2), -1.0)
                    best = int(score.argmax())
                    chosen.append(pool[best])
                    room -= demand[best]
                    waiting[best] = False
                    n_waiting -= 1
                    continue
                at = int(min(room[0], room[2]))
                longer = waiting & (demand[:, 0] > at)
                if at < LEAST_CUT or not longer.any():
                    break
                best = int(np.where(longer, demand @ (room / self.limits**2), -1.0).argmax())
                piece, pool[best] = pool[best].cut(at)
                demand[best] = (len(pool[best].ids), 1, pool[best].loss)
                chosen.append(piece)
                room -= (len(piece.ids), 1, piece.loss)
            # The last, partly filled sequence of a task is cut into powers of two.
            if not n_waiting and until == 0 and room[0] >= LEAST_CUT:
                yield from _powers_of_two(chosen)
            else:
                yield chosen
        self.pool = [p for p, w in zip(pool, waiting, strict=True) if w]


def _powers_of_two(pieces: list[Piece]) -> Iterator[list[Piece]]:
    left, total = list(pieces), sum(len(p.ids) for p in pieces)
    while total:
        size = 1 << (total.bit_length() - 1)
        total -= size
        taken: list[Piece] = []
        while size:
            piece = left.pop(0)
            if len(piece.ids) > size:
                piece, rest = piece.cut(size)
                left.insert(0, rest)
            taken.append(piece)
            size -= len(piece.ids)
        yield taken


_COLUMNS = {
    "doc_id": pa.int64(),
    "start": pa.int64(),
    "length": pa.int64(),
    "ids_crc32": pa.int64(),
    "doc_tokens": pa.int64(),
    "sequence_id": pa.int64(),
    "offset": pa.int64(),
    "loss_tokens": pa.int64(),
    "ids": pa.binary(),
}


def pack(docs: DataFrame, tokenizer_path: str, limits: Limits = Limits(), with_ids: bool = True) -> DataFrame:
    """A row per piece: doc_id, start (of its document's ids before it), length, ids_crc32 (of its little-endian 32-bit
    ids), doc_tokens, sequence_id, offset (in its sequence, gapless from 0), loss_tokens, and ids (those bytes) if wanted.

    sequence_id is the partition's number and a count, so a task that runs again gives the same.
    """
    with open(tokenizer_path, encoding="utf-8") as source:  # a vocabulary: its size is fixed
        file = docs.sparkSession.sparkContext.broadcast(source.read())
    names = [c for c in _COLUMNS if with_ids or c != "ids"]

    def rows(sequences: Iterator[list[Piece]], count: list[int]) -> Iterator[tuple]:
        for pieces in sequences:
            number, offset = count[0], 0
            count[0] += 1
            for p in pieces:
                data = p.ids.astype("<u4").tobytes()
                row = (p.doc_id, p.start, len(p.ids), zlib.crc32(data), p.doc_tokens, number, offset, p.loss)
                yield (*row, data) if with_ids else row
                offset += len(p.ids)

    def batch_of(found: list[tuple]) -> pa.RecordBatch:
        columns = zip(*found, strict=True) if found else [[]] * len(names)
        return pa.RecordBatch.from_arrays(
            [pa.array(c, _COLUMNS[n]) for n, c in zip(names, columns, strict=True)], names=names
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, packer = _encoder(file.value), Packer(limits)
        count = [TaskContext.get().partitionId() << 40]
        out: list[tuple] = []
        for batch in batches:
            for doc_id, text, prompt in zip(batch["doc_id"], batch["text"], batch["prompt"], strict=True):
                text, prompt = text.as_py() or "", prompt.as_py() or 0
                ids = np.append(encode(text), np.uint32(END_ID)).astype(np.uint32)
                free = min(len(ids), len(encode(text[:prompt]))) if prompt > 0 else 0
                out.extend(rows(packer.add(Piece(doc_id.as_py(), 0, ids, len(ids), free)), count))
                if len(out) >= 4096:
                    yield batch_of(out)
                    out = []
        out.extend(rows(packer.finish(), count))
        yield batch_of(out)

    prompt = F.col("prompt_chars").cast("bigint") if "prompt_chars" in docs.columns else F.lit(None).cast("bigint")
    source = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", prompt.alias("prompt"))
    kinds = {pa.int64(): "bigint", pa.binary(): "binary"}
    return mapped(source, run, ", ".join(f"{n} {kinds[_COLUMNS[n]]}" for n in names))
