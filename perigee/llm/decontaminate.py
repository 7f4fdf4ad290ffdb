"""Benchmark decontamination with a generalised suffix automaton of the test items (operator 3).

Items and documents are words of ASCII letters, digits and non-ASCII characters, A-Z lower-cased. The automaton holds all
word sequences of all items. Document words stream through it; at each word it gives the longest sequence that ends
there and occurs in some item. Where that length reaches a window (`limit` words, or a whole shorter item) the window's
words are hit and the items that hold it are noted.

Stretches that can't hold a window are passed over without a step of the automaton: a window's neighbouring words are
neighbours in an item, so a table of hashed pairs rules out most of a document; it can only let through too much.

An automaton holds about SHARD_WORDS words at most (500 bytes each); a larger benchmark is dealt by item into several,
whose finds are put together by document. Up to DRIVER_WORDS words the driver builds them, one after the other, and each
reads the documents. Beyond, tasks build them and the documents are read once for TABLES shards: their stretches go to
the shards whose tables let them through, and there meet the shard's items. The driver then sees the tables alone,
128 KB of each shard, whatever the documents.

Defined cases: null and empty texts have no words; items without words have no window; repeated items or item ids count
once; a null item id is hit but not listed; an empty benchmark hits nothing; a null document id stays null. Further
columns are ignored by `hits` and kept by `decontaminate`.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from perigee.llm import texts
from perigee.llm.shared import fresh, mapped, narrow, stored

LIMIT = 10
SHARD_WORDS = 200_000
#: A larger benchmark doesn't pass through the driver.
DRIVER_WORDS = 4 * SHARD_WORDS
#: Shards for which one pass over the documents looks: 32 MB of tables.
TABLES = 256
#: A document of which a greater share of words is hit goes whole.
MAX_COVERAGE = 0.5
_BITS = 20


def words_of(text: str | None) -> list[bytes]:
    return _words((text or "").encode())


def _words(data: bytes) -> list[bytes]:
    block = texts.Block(0, np.frombuffer(data, np.uint8), np.array([0, len(data)]))
    found = texts.units(block, texts.ALNUM)
    return [data[a:b].lower() for a, b in zip(found.starts, found.ends, strict=True)]


class Automaton:
    """Suffix automaton of several word sequences."""

    def __init__(self, items: Iterable[tuple[str | None, list[bytes]]], limit: int) -> None:
        self.limit = limit
        self.next: list[dict[bytes, int]] = [{}]
        self.link, self.length = [-1], [0]
        self.window_items: dict[int, set] = {}  # state that holds a full window -> item ids
        self.short_items: dict[int, list[tuple[int, str | None]]] = {}  # state -> (length, id) of short items ending there
        self.shortest = limit
        sequences = [(i, w) for i, w in items if w]
        for _, words in sequences:
            state = 0
            for word in words:
                state = self._extend(state, word)
        for item, words in sequences:
            self.shortest = min(self.shortest, len(words))
            state = 0
            for at, word in enumerate(words):
                state = self.next[state][word]
                if at + 1 >= limit:
                    self.window_items.setdefault(self._suffix(state, limit), set()).add(item)
            if len(words) < limit:
                self.short_items.setdefault(self._suffix(state, len(words)), []).append((len(words), item))

    def _add(self, length: int) -> int:
        self.next.append({})
        self.link.append(0)
        self.length.append(length)
        return len(self.next) - 1

    def _split(self, before: int, word: bytes, old: int) -> int:
        copy = self._add(self.length[before] + 1)
        self.next[copy] = dict(self.next[old])
        self.link[copy] = self.link[old]
        self.link[old] = copy
        while before >= 0 and self.next[before].get(word) == old:
            self.next[before][word] = copy
            before = self.link[before]
        return copy

    def _extend(self, last: int, word: bytes) -> int:
        known = self.next[last].get(word)
        if known is not None:
            exact = self.length[known] == self.length[last] + 1
            return known if exact else self._split(last, word, known)
        state, before = self._add(self.length[last] + 1), last
        while before >= 0 and word not in self.next[before]:
            self.next[before][word] = state
            before = self.link[before]
        if before >= 0:
            old = self.next[before][word]
            exact = self.length[old] == self.length[before] + 1
            self.link[state] = old if exact else self._split(before, word, old)
        return state

    def _suffix(self, state: int, length: int) -> int:
        """The state of the last `length` words of what reached the state."""
        while self.length[self.link[state]] >= length:
            state = self.link[state]
        return state

    def lengths(self, words: Iterable[bytes]) -> Iterator[tuple[int, int]]:
        """After each word, the state and the length of the longest ending that some item holds."""
        state = length = 0
        for word in words:
            while state and word not in self.next[state]:
                state = self.link[state]
                length = self.length[state]
            to = self.next[state].get(word)
            state, length = (0, 0) if to is None else (to, length + 1)
            yield state, length

    def matches(self, words: list[bytes]) -> Iterator[tuple[int, int, set]]:
        """(first word, end, item ids) of each window found."""
        for at, (state, length) in enumerate(self.lengths(words)):
            if length >= self.limit:
                items = self.window_items.get(self._suffix(state, self.limit))
                if items:
                    yield at + 1 - self.limit, at + 1, items
            while self.short_items and state > 0:
                for size, item in self.short_items.get(state, ()):
                    if size <= length:
                        yield at + 1 - size, at + 1, {item}
                state = self.link[state]
                length = self.length[state]


def _pairs(words: list[list[bytes]], shortest: int) -> np.ndarray:
    """Table of the hashed pairs of neighbouring words of the items; of single words if an item has but one."""
    table = np.zeros(1 << _BITS, bool)
    for item in words:
        data = b" ".join(item)
        block = texts.Block(0, np.frombuffer(data, np.uint8), np.array([0, len(data)]))
        keys = texts.hashes(block, texts.units(block, texts.ALNUM), lower=True)
        table[texts.windows(keys, min(2, shortest)) >> np.uint64(64 - _BITS)] = True
    return table


def _stretches(keys: np.ndarray, found: texts.Units, table: np.ndarray, shortest: int) -> Iterator[tuple[int, int, int]]:
    """(text, first word, end) of the stretches of words whose neighbours all are neighbours in items."""
    size = min(2, shortest)
    return _runs(table[texts.windows(keys, size) >> np.uint64(64 - _BITS)], found, size, shortest)


def _runs(good: np.ndarray, found: texts.Units, size: int, shortest: int) -> Iterator[tuple[int, int, int]]:
    """The stretches where the windows of this size are good."""
    rows = found.rows
    if size == 2:
        good = good & (rows[1:] == rows[:-1])
    edges = np.diff(np.concatenate([[0], good.astype(np.int8), [0]]))
    if size == 1:  # words of different texts are no neighbours
        for row in np.unique(rows[good]):
            yield int(row), int(found.bounds[row]), int(found.bounds[row + 1])
        return
    for a, b in zip(np.flatnonzero(edges == 1), np.flatnonzero(edges == -1), strict=True):
        if b - a + 1 >= shortest:
            yield int(rows[a]), int(a), int(b) + 1


def _scan(items: list[tuple[str | None, list[bytes]]], limit: int):
    """Reads doc_id and text; emits a row per document."""
    automaton = Automaton(items, limit)
    automaton_table = _pairs([w for _, w in items if w], automaton.shortest)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_words, spans, ids = [], [], []
            for block in texts.blocks(batch["text"]):
                found = texts.units(block, texts.ALNUM)
                keys = texts.hashes(block, found, lower=True)
                n = len(block.offsets) - 1
                n_words.append(np.diff(found.bounds))
                hit: list[list[tuple[int, int]]] = [[] for _ in range(n)]
                held: list[set] = [set() for _ in range(n)]
                for row, a, b in _stretches(keys, found, automaton_table, automaton.shortest) if items else ():
                    words = [block.data[found.starts[i] : found.ends[i]].tobytes().lower() for i in range(a, b)]
                    for first, end, named in automaton.matches(words):
                        at = a - found.bounds[row]
                        hit[row].append((int(first + at), int(end + at)))
                        held[row] |= named
                spans += [_merged(h) for h in hit]
                ids += [sorted(i for i in h if i is not None) for h in held]
            flat = pa.array(np.concatenate(n_words) if n_words else np.zeros(0, np.int64), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], flat, pa.array(spans, pa.list_(pa.list_(pa.int64()))), pa.array(ids, pa.list_(pa.string()))],
                names=["doc_id", "n_words", "spans", "items"],
            )

    return scan


def _merged(spans: list[tuple[int, int]]) -> list[list[int]]:
    out: list[list[int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return out


_HITS = "doc_id bigint, n_words bigint, spans array<array<bigint>>, items array<string>"


def _items(benchmark: DataFrame) -> DataFrame:
    return benchmark.select(F.col("item_id").cast("string").alias("item"), "text").where("text IS NOT NULL").distinct()


def _shards(items: DataFrame, n: int) -> Iterator[list[Row]]:
    """The items in n lists, each collected by itself when it is asked for."""
    return (items.where(F.pmod(F.xxhash64("item", "text"), F.lit(n)) == shard).collect() for shard in range(n))


def _count(items: DataFrame, shard_words: int) -> tuple[int, int]:
    """How many words the items hold at most, and how many shards they need."""
    # A word takes at least two bytes with its separator: a bound, and cheap. Most take more, so a shard gets twice that.
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    return -(-total // 2), max(1, -(-total // (4 * shard_words)))


def _scans(items: DataFrame, n: int, limit: int) -> Iterator:
    return (_scan([(row["item"], words_of(row["text"])) for row in shard], limit) for shard in _shards(items, n))


def _of_shards(docs: DataFrame, scans: Iterator) -> DataFrame:
    """doc_id, hash of the text, n_words, spans, items from several automata, and the number of rows that were alike.

    Each one's finds are stored and it is dropped before the next is built; of all but the first, only rows with finds.
    """
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", F.xxhash64("text").alias("hash"))

    def with_hash(scan):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for result in scan(iter([batch])):
                    yield result.append_column("hash", batch["hash"])

        return run

    found = None
    for scan in scans:
        own = mapped(rows, with_hash(scan), _HITS + ", hash bigint").groupBy("doc_id", "hash", "n_words", "spans", "items")
        own = own.agg(F.count("*").alias("n"))
        own = stored(own if found is None else own.where(F.size("spans") > 0))
        found = own if found is None else found.unionByName(own)
        del scan
    return _by_document(found)


def _by_document(found: DataFrame) -> DataFrame:
    """The finds of all shards together; a document's rows are as many as its stretches or the shards."""
    grouped = found.groupBy("doc_id", "hash", "n_words").agg(
        F.flatten(F.collect_list("spans")).alias("spans"), F.flatten(F.collect_list("items")).alias("items"), F.max("n").alias("n")
    )

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = grouped_names.index("spans")
        for batch in batches:
            spans = [_merged([tuple(s) for s in row]) for row in batch["spans"].to_pylist()]
            columns = list(batch.columns)
            columns[at] = pa.array(spans, pa.list_(pa.list_(pa.int64())))
            yield pa.RecordBatch.from_arrays(columns, names=grouped_names)

    grouped_names = grouped.columns
    merged = mapped(grouped, merge, grouped.schema)
    return merged.withColumn("items", F.array_sort(F.array_distinct("items")))


_WORD = r"[0-9A-Za-z\x{80}-\x{10FFFF}]+"
_TABLE = "shard int, shortest int, pairs binary"
_STRETCHES = "doc_id bigint, hash bigint, n_words bigint, stretches array<struct<shard:int,first:bigint,data:binary>>"
_SEARCHED = "doc_id bigint, hash bigint, n_words bigint, spans array<array<bigint>>, items array<string>"


def _tables(dealt: DataFrame, limit: int) -> DataFrame:
    """A row of each shard: its shortest window and the bits of its table."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, table, shortest = None, None, limit

        def done() -> pa.RecordBatch:
            columns = [pa.array([shard], pa.int32()), pa.array([shortest], pa.int32()), pa.array([np.packbits(table).tobytes()])]
            return pa.RecordBatch.from_arrays(columns, names=["shard", "shortest", "pairs"])

        for batch in batches:
            for k, text in zip(batch["shard"].to_pylist(), batch["text"].to_pylist(), strict=True):
                if k != shard:
                    if shard is not None:
                        yield done()
                    shard, table, shortest = k, np.zeros(1 << _BITS, bool), limit
                words = words_of(text)
                shortest = min(shortest, len(words))
                table |= _pairs([words], min(2, len(words), limit))
        if shard is not None:
            yield done()

    return mapped(dealt.repartition("shard").sortWithinPartitions("shard"), build, _TABLE)


class _Sieve:
    """Tables of several shards with windows of one kind (of one word, or of more), a bit of each shard to a slot."""

    def __init__(self, rows: list[Row], size: int) -> None:
        self.size, self.shards, self.shortest = size, [r["shard"] for r in rows], [r["shortest"] for r in rows]
        self.bits = np.zeros((1 << _BITS, -(-len(rows) // 8)), np.uint8)
        for at in range(0, len(rows), 8):
            tables = [np.unpackbits(np.frombuffer(r["pairs"], np.uint8)) for r in rows[at : at + 8]]
            self.bits[:, at // 8] = np.packbits(np.stack(tables), axis=0)[0]

    def stretches(self, keys: np.ndarray, found: texts.Units) -> Iterator[tuple[int, int, int, int]]:
        """(shard, text, first word, end)."""
        if len(keys) < self.size:
            return
        passed = self.bits[texts.windows(keys, self.size) >> np.uint64(64 - _BITS)]
        # A shard's stretch has so many neighbouring windows that it lets through.
        least = min(self.shortest) - self.size + 1
        together = passed[: max(0, len(passed) - least + 1)].copy()
        for k in range(1, least):
            together &= passed[k : k + len(together)]
        some = np.unpackbits(np.bitwise_or.reduce(together, axis=0)) if len(together) else ()
        for k in np.flatnonzero(some):
            good = passed[:, k // 8] >> (7 - k % 8) & 1
            for row, a, b in _runs(good.astype(bool), found, self.size, self.shortest[k]):
                yield self.shards[k], row, a, b


def _sieved(rows: DataFrame, sieves: list[_Sieve]) -> DataFrame:
    """Reads doc_id, text and hash once; a row per document, with the stretches that some shard has to look at."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_words, stretches = [], []
            for block in texts.blocks(batch["text"]):
                found = texts.units(block, texts.ALNUM)
                keys = texts.hashes(block, found, lower=True)
                n_words.append(np.diff(found.bounds))
                own: list[list[dict]] = [[] for _ in range(len(block.offsets) - 1)]
                for sieve in sieves:
                    for shard, row, a, b in sieve.stretches(keys, found):
                        data = block.data[found.starts[a] : found.ends[b - 1]].tobytes()
                        own[row].append({"shard": shard, "first": int(a - found.bounds[row]), "data": data})
                stretches += own
            flat = pa.array(np.concatenate(n_words) if n_words else np.zeros(0, np.int64), pa.int64())
            kind = pa.list_(pa.struct([("shard", pa.int32()), ("first", pa.int64()), ("data", pa.binary())]))
            columns = [batch["doc_id"], batch["hash"], flat, pa.array(stretches, kind)]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "hash", "n_words", "stretches"])

    return mapped(rows, scan, _STRETCHES)


def _search(limit: int):
    """Reads rows sorted by shard, part and kind: a shard's items, from which its automaton is built, then stretches."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = items = automaton = None
        for batch in batches:
            out: list[tuple] = []
            for row in batch.to_pylist():
                place = (row["shard"], row["part"])
                if row["kind"] == 0:
                    if of is None or of[0] != place[0]:  # another part of a shard brings the same items again
                        of, items, automaton = place, [], None
                    if of == place:
                        items.append((row["item"], _words(row["data"])))
                    continue
                if automaton is None:
                    automaton, items = Automaton(items, limit), None
                spans, held = [], set()
                for a, b, named in automaton.matches(_words(row["data"])):
                    spans.append((a + row["first"], b + row["first"]))
                    held |= named
                if spans:
                    out.append((row["doc_id"], row["hash"], row["n_words"], _merged(spans), sorted(i for i in held if i is not None)))
            names = ["doc_id", "hash", "n_words", "spans", "items"]
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.list_(pa.int64())), pa.list_(pa.string())]
            columns = [pa.array([r[k] for r in out], kind) for k, kind in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return search


def _in_tasks(docs: DataFrame, items: DataFrame, n: int, limit: int) -> DataFrame:
    """What `_of_shards` gives, from automata that tasks build."""
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", F.xxhash64("text").alias("hash"))
    size = F.regexp_count("text", F.lit(_WORD))
    # Items of one word let whole documents through: shards of their own.
    shard = F.pmod(F.xxhash64("item", "text"), F.lit(n)).cast("int") + F.when(size == 1, n).otherwise(0)
    dealt = stored(items.where(size > 0).select(shard.alias("shard"), "item", "text"))
    # Every shard is searched in several tasks, each of which gets its items.
    parts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")) // n)
    none = F.lit(None).cast("bigint")
    found = None
    for low in range(0, 2 * n, TABLES):
        chosen = dealt.where(F.col("shard").between(low, low + TABLES - 1))
        tables = sorted(_tables(chosen, limit).collect())  # at most TABLES rows of 128 KB
        if found is not None and not tables:
            continue
        groups = [[r for r in tables if min(2, r["shortest"]) == k] for k in (1, 2)]
        sieved = stored(_sieved(rows, [_Sieve(g, k) for k, g in enumerate(groups, 1) if g]))
        if found is None:
            empty = [F.array().cast("array<array<bigint>>").alias("spans"), F.array().cast("array<string>").alias("items")]
            found = sieved.groupBy("doc_id", "hash", "n_words").agg(F.count("*").alias("n")).select("doc_id", "hash", "n_words", *empty, "n")
        stretches = sieved.select("doc_id", "hash", "n_words", F.inline("stretches")).dropDuplicates(["doc_id", "hash", "shard", "first"])
        part = F.pmod(F.xxhash64("doc_id", "hash", "first"), F.lit(parts)).cast("int")
        there = stretches.select("shard", part.alias("part"), F.lit(1).alias("kind"), F.lit(None).cast("string").alias("item"),
                                 "doc_id", "hash", "n_words", "first", "data")
        here = chosen.select("shard", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part"), F.lit(0).alias("kind"), "item",
                             none.alias("doc_id"), none.alias("hash"), none.alias("n_words"), none.alias("first"),
                             F.col("text").cast("binary").alias("data"))
        both = here.unionByName(there).repartition("shard", "part").sortWithinPartitions("shard", "part", "kind")
        found = found.unionByName(mapped(both, _search(limit), _SEARCHED).withColumn("n", F.lit(0).cast("bigint")))
    return _by_document(found)


def _found(docs: DataFrame, items: DataFrame, n: int, words: int, limit: int, driver_words: int) -> DataFrame:
    return _of_shards(docs, _scans(items, n, limit)) if words <= driver_words else _in_tasks(docs, items, n, limit)


def hits(
    docs: DataFrame, benchmark: DataFrame, limit: int = LIMIT, shard_words: int = SHARD_WORDS, driver_words: int = DRIVER_WORDS
) -> DataFrame:
    """doc_id, n_words, spans ([first word, end] of what is hit, merged, ascending), items (ids, sorted)."""
    items = _items(benchmark)
    words, n = _count(items, shard_words)
    if n == 1 and words <= driver_words:
        return mapped(narrow(docs), next(_scans(items, n, limit)), _HITS)
    found = _found(docs, items, n, words, limit, driver_words)
    found = found.withColumn("row", F.explode(F.sequence(F.lit(1).cast("bigint"), "n")))
    return found.select("doc_id", "n_words", "spans", "items")


def hit_words() -> Column:
    return F.aggregate("spans", F.lit(0).cast("bigint"), lambda n, s: n + s[1] - s[0])


def decontaminate(
    docs: DataFrame,
    benchmark: DataFrame,
    limit: int = LIMIT,
    max_coverage: float = MAX_COVERAGE,
    shard_words: int = SHARD_WORDS,
    driver_words: int = DRIVER_WORDS,
) -> DataFrame:
    """The documents without the hit spans; those of which more than max_coverage is hit go. Other columns stay.

    The text is cut from the first character of a span's first word to the last of its last.
    """
    items = _items(benchmark)
    words, n = _count(items, shard_words)
    only = next(_scans(items, n, limit)) if n == 1 and words <= driver_words else None
    names = docs.columns

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if only:
                ids = pa.nulls(len(batch), pa.int64())
                own = pa.RecordBatch.from_arrays([ids, batch["text"]], names=["doc_id", "text"])
                result = next(only(iter([own])))
            else:
                result = pa.RecordBatch.from_arrays(batch.columns[-2:], names=["n_words", "spans"])
            keep, text = np.ones(len(batch), bool), batch["text"].to_pylist()
            for row, (n, found) in enumerate(zip(result["n_words"].to_pylist(), result["spans"].to_pylist(), strict=True)):
                if found:
                    keep[row] = sum(b - a for a, b in found) <= max_coverage * n
                    text[row] = _without(text[row], found)
            columns = [
                pa.array(text, batch["text"].type) if name == "text" else batch.column(k) for k, name in enumerate(names)
            ]
            yield pa.RecordBatch.from_arrays(columns, names=names).filter(pa.array(keep))

    if only:
        return mapped(docs, cut, docs.schema)
    found = _found(docs, items, n, words, limit, driver_words)
    same = docs["doc_id"].cast("bigint").eqNullSafe(found["doc_id"]) & F.xxhash64(docs["text"]).eqNullSafe(found["hash"])
    more = [found[n].alias(fresh(names, n)) for n in ("n_words", "spans")]
    return mapped(docs.join(found, same).select(*(docs[n] for n in names), *more), cut, docs.schema)


def _without(text: str, spans: list[list[int]]) -> str:
    data = text.encode()
    block = texts.Block(0, np.frombuffer(data, np.uint8), np.array([0, len(data)]))
    found, out, at = texts.units(block, texts.ALNUM), [], 0
    for a, b in spans:
        out.append(data[at : found.starts[a]])
        at = found.ends[b - 1]
    return b"".join([*out, data[at:]]).decode()
