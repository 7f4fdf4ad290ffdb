"""Substring dedup by line or paragraph hashing (operator 1).

Units are lines or paragraphs, normalised (A-Z lower-cased, ASCII white space collapsed) and digested. Of all units
with one digest the earliest ranked, by document id and then position, stays; the others are removed (`removed_units`).

Passages begin and end inside lines, so `removed_passages` cuts lines further, into clauses: after marks that end one
before white space, and after such marks of unspaced scripts. A repeat is a run of clauses in a row, each a later one of
its digest, that together hold `min_words` words (in clauses mostly of three-byte characters one of an unspaced script counts as one).
Shorter runs stay.

Defined cases: a null or empty text has no units; units (runs) of fewer than `min_words` words are never removed; a null
id ranks before all others; rows that share an id are treated alike: what is first at some position of an id stays in each
row that holds it there (for clauses: what no smaller id holds stays in each row, once). Pieces without a word are no units and don't break runs.
Further columns of the input are ignored (`removed_...`) or kept (`remove_...`).
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from struct import unpack

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from perigee.llm.shared import fresh, in_runs, mapped, narrow, parts_left, rejoined, stored

LINE, PARAGRAPH = "\n", "\n\n"
MIN_WORDS = 5
#: Words that repeated clauses in a row must hold together. On the test tables 25 finds nearly as many passages of over
#: 50 words as 10 does and leaves as many other documents alone as 40 does (README).
PASSAGE_WORDS = 25
#: A clause ends with marks before white space, with a line, or with marks of unspaced scripts.
CLAUSE = "(?:[.!?,;:|]+[ \\t\\x0B\\f\\r\\n]+|\\n|[\u3002\uff01\uff1f\uff0c\uff1b\uff1a\u3001]+)"
_PIECE = re.compile(f"(?s:.*?){CLAUSE}|(?s:.+)")
#: Thai, Lao, Burmese, Khmer, kana and ideographs: characters of scripts written without spaces.
UNSPACED = "[\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff]"
_UNSPACED = re.compile(UNSPACED)


def units(docs: DataFrame, separator: str = LINE, min_words: int = MIN_WORDS) -> DataFrame:
    """doc_id, unit (its number), start, end (code points, end exclusive) and digest of each unit that counts."""

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"], strict=True):
                start = 0
                for number, part in enumerate((text.as_py() or "").split(separator)):
                    words = part.encode().lower().split()
                    if words and len(words) >= min_words:
                        digest = hashlib.md5(b" ".join(words)).digest()
                        out.append((doc_id, number, start, start + len(part), digest))
                    start += len(part) + len(separator)
            columns = zip(*out, strict=True) if out else [[]] * 5
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, _UNIT.values(), strict=True)], names=list(_UNIT)
            )

    schema = "doc_id bigint, unit bigint, start bigint, end bigint, digest binary"
    return mapped(narrow(docs), digests, schema)


_UNIT = {"doc_id": pa.int64(), "unit": pa.int64(), "start": pa.int64(), "end": pa.int64(), "digest": pa.binary()}


def removed_units(docs: DataFrame, separator: str = LINE, min_words: int = MIN_WORDS) -> DataFrame:
    """The units to remove: doc_id, unit, start, end, digest, and first_doc_id, first_unit of the one that stays.

    Digests that occur once drop out in an aggregate that combines before the shuffle; a frequent digest is one row
    on its side of the join, and adaptive execution splits its occurrences on the other.
    """
    rows = stored(units(docs, separator, min_words))
    rank = F.struct("doc_id", "unit")
    firsts = rows.groupBy("digest").agg(F.min(rank).alias("first"), F.max(rank).alias("last"))
    # Stored, so that both sides of the join are plain shuffles, whose large parts adaptive execution can split.
    firsts = stored(firsts.where("first < last").select("digest", "first"))
    return rows.join(firsts, "digest").where(F.col("first") < rank).select(
        "doc_id",
        "unit",
        "start",
        "end",
        F.lower(F.hex("digest")).alias("digest"),
        F.col("first.doc_id").alias("first_doc_id"),
        F.col("first.unit").alias("first_unit"),
    )


def remove_units(docs: DataFrame, removed: DataFrame, separator: str = LINE) -> DataFrame:
    """The documents without those units; `removed_spans` keeps their original start and end."""
    spans = removed.groupBy(F.col("doc_id").alias("id")).agg(
        F.array_sort(F.collect_set(F.struct("unit", "start", "end"))).alias("spans")
    )
    joined = docs.join(spans, docs["doc_id"].cast("bigint").eqNullSafe(spans["id"]), "left")
    cut = F.transform(spans["spans"], lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end")))
    name = fresh([*docs.columns, "removed_spans"], "parts")
    pattern = F.concat(F.lit("\\Q"), F.lit(separator), F.lit("\\E"))
    made = joined.select(
        *(docs[c] for c in docs.columns),
        cut.alias("removed_spans"),
        parts_left(docs["text"], spans["spans"]["unit"], pattern).alias(name),
    )
    text = rejoined(made[name], made["text"], separator)
    return made.select(*(text.alias("text") if c == "text" else made[c] for c in docs.columns), "removed_spans")


_DIGEST = {"h1": "bigint", "h2": "bigint", "doc_id": "bigint"}
_CLAUSE = _DIGEST | {"copy": "bigint", "place": "int", "start": "int", "length": "int", "words": "int", "again": "boolean"}
_ARROW = {"bigint": pa.int64(), "int": pa.int32(), "boolean": pa.bool_()}


def clauses(docs: DataFrame, columns: dict[str, str]) -> DataFrame:
    """The clauses that have a word.

    h1, h2: the digest; copy: a hash of the whole text; place: the clause's number among those with a word; start, length:
    code points, without the white space around; words; again: whether its digest stands earlier in the text.
    """
    names = list(columns)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"], strict=True):
                text, seen = text.as_py() or "", set()
                copy = xxhash.xxh3_64_intdigest(text.encode()) & 0xFFFFFFFF
                place = 0
                for piece in _PIECE.finditer(text):
                    content = piece[0].strip(" \t\n\x0b\f\r")
                    if not content:
                        continue
                    words = content.encode().lower().split()
                    normal = b" ".join(words)
                    digest = hashlib.md5(normal).digest()
                    if len(names) == len(_DIGEST):
                        out.append((*unpack(">qq", digest), doc_id))
                        continue
                    count = len(words)
                    if not normal.isascii() and len(normal) > 2 * len(plain := normal.decode()):
                        count = max(count, len(_UNSPACED.findall(plain)))
                    start = piece.start() + piece[0].index(content[0])
                    out.append((*unpack(">qq", digest), doc_id, copy, place, start, len(content), count, digest in seen))
                    seen.add(digest)
                    place += 1
            found = zip(*out, strict=True) if out else [[]] * len(names)
            arrays = [pa.array(values, _ARROW[columns[c]]) for c, values in zip(names, found, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    return mapped(narrow(docs), cut, ", ".join(f"{c} {t}" for c, t in columns.items()), 256)


def removed_passages(docs: DataFrame, min_words: int = PASSAGE_WORDS) -> DataFrame:
    """The clauses to remove: doc_id, unit (their number among those that have a word), start, end, and first_doc_id, that of
    the document whose clause stays.

    Texts are cut twice instead of storing all clauses: first for the digests that occur more than once, which combine
    before the shuffle, then for the join with these, whose hot digests adaptive execution splits. Fields are packed into
    few longs for both. Runs are found within texts: the clauses of one text, whose number its length bounds, meet in one task.
    """
    key = ["h1", "h2"]
    # A null id ranks first.
    ranked = F.coalesce("doc_id", F.lit(_NULL)).alias("rank")
    counted = clauses(docs, _DIGEST).select(*key, ranked).groupBy(*key).agg(F.min("rank").alias("first"), F.count("*").alias("n"))
    # Stored, so that both sides of the join are plain shuffles, whose large parts adaptive execution can split.
    firsts = stored(counted.where("n > 1").select(*key, "first"))
    wide = 2**32
    packed = clauses(docs, _CLAUSE).select(
        *key,
        ranked,
        "again",
        F.col("copy").alias("copy"),
        (F.col("place") * F.lit(wide) + F.col("start")).alias("at"),
        (F.col("length") * F.lit(wide) + F.col("words")).alias("size"),
    )
    later = packed.join(firsts, key).where((F.col("first") < F.col("rank")) | F.col("again"))
    rows = later.select(
        "rank",
        "copy",
        "first",
        F.shiftright("at", 32).cast("int").alias("place"),
        F.col("at").bitwiseAND(wide - 1).cast("int").alias("start"),
        F.shiftright("size", 32).cast("int").alias("length"),
        F.col("size").bitwiseAND(wide - 1).cast("int").alias("words"),
    )
    return in_runs(rows, ["rank", "copy"], min_words).select(
        F.nullif("rank", F.lit(_NULL)).alias("doc_id"),
        F.col("place").cast("bigint").alias("unit"),
        F.col("start").cast("bigint").alias("start"),
        (F.col("start") + F.col("length")).cast("bigint").alias("end"),
        F.nullif("first", F.lit(_NULL)).alias("first_doc_id"),
    )


_NULL = -(2**63)


def remove_passages(docs: DataFrame, removed: DataFrame) -> DataFrame:
    """The documents without those clauses and the white space behind them; `removed_spans` keeps their start and end."""
    spans = removed.groupBy(F.col("doc_id").alias("id")).agg(
        F.array_sort(F.collect_set(F.struct("start", "end"))).alias("spans")
    )
    name = fresh([*docs.columns, "id", "spans"], "removed_spans")
    joined = docs.join(spans, docs["doc_id"].cast("bigint").eqNullSafe(spans["id"]), "left").select(
        *(docs[c] for c in docs.columns), spans["spans"].alias(name)
    )
    at, column = len(docs.columns), docs.columns.index("text")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for text, own in zip(batch.column(column), batch.column(at).to_pylist(), strict=True):
                text, kept, end = text.as_py(), [], 0
                for span in own or () if text is not None else ():
                    kept.append(text[end : span["start"]])
                    end = span["end"]
                    while end < len(text) and text[end] in " \t\n\x0b\f\r":
                        end += 1
                texts.append("".join([*kept, text[end:]]) if own and text is not None else text)
            columns = [pa.array(texts, pa.string()) if k == column else c for k, c in enumerate(batch.columns)]
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names)

    return mapped(joined, cut, joined.schema, 256)
