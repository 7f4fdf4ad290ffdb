"""Repeated passages by clauses: against a plain version, with offsets, in hard cases."""

import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from perigee.llm import line_hashing, winnowing
from tests.llm.brute import normal

SPACE = " \t\n\x0b\f\r"


CLAUSE, SENTENCE = (".!?,;:|", "。！？，；：、"), (".!?;:", "。！？；：")


def cut(text, marks=CLAUSE):
    """All pieces of a text, cut character by character."""
    out, start, k = [], 0, 0
    while k < len(text):
        e = k
        while e < len(text) and text[e] in marks[0]:
            e += 1
        behind = e
        while behind < len(text) and text[behind] in SPACE:
            behind += 1
        wide = k
        while wide < len(text) and text[wide] in marks[1]:
            wide += 1
        ends = behind if e > k and behind > e else k + 1 if text[k] == "\n" else wide if wide > k else None
        k = ends or k + 1
        if ends or k == len(text):
            out.append(text[start:k])
            start = k
    return out


def pieces(text):
    """(unit, start, end, normal, words) of the pieces that have a word."""
    out, start = [], 0
    for piece in cut(text):
        content, own = piece.strip(SPACE), normal(piece)
        if content:
            at = start + len(piece) - len(piece.lstrip(SPACE))
            words = len(own.split(" "))
            if len(own.encode()) > 2 * len(own):
                words = max(words, len(re.findall("[぀-ヿ一-鿿]", own)))
            out.append((len(out), at, at + len(content), own, words))
        start += len(piece)
    return out


def plain(docs, min_words):
    first = {}
    for doc_id, text in docs:
        for piece in pieces(text or ""):
            first[piece[3]] = min(first.get(piece[3], (True, 2**62)), (doc_id is not None, doc_id or 0))
    out = []
    for doc_id, text in docs:
        run, seen = [], set()
        for piece in [*pieces(text or ""), None]:
            if piece and (first[piece[3]] != (doc_id is not None, doc_id or 0) or piece[3] in seen):
                run.append(piece)
            else:
                if sum(p[4] for p in run) >= min_words:
                    out += [(doc_id, unit, start, end, first[own][1] if first[own][0] else None) for unit, start, end, own, _ in run]
                run = []
            seen |= {piece[3]} if piece else set()
    return out


def collected(df):
    names = ("doc_id", "unit", "start", "end", "first_doc_id")
    return sorted((tuple(r[n] for n in names) for r in df.collect()), key=str)


def sentences(text):
    """The sentences that have a word, normalised."""
    found = (" ".join(p.lower().translate(dict.fromkeys(map(ord, SPACE), " ")).split(" ")) for p in cut(text, SENTENCE))
    return [w for p in found if (w := re.sub(" +", " ", p).strip(" ").rstrip(SENTENCE[1]).strip(" "))]


def winnowed(docs, run, min_bytes):
    """Sentences to delete by (doc_id, text), from all windows of sentences."""
    first, out = {}, {}

    def rank(doc_id, text, at):
        return (doc_id is not None, doc_id or 0, np.int64(np.uint64(xxhash.xxh64_intdigest((text or "").encode(), 42))), at)

    for doc_id, text in docs:
        own = sentences(text or "")
        for at in range(len(own) - run + 1):
            key = tuple(own[at : at + run])
            first[key] = min(first.get(key, (True, 2**62, 0, 0)), rank(doc_id, text, at))
    for doc_id, text in docs:
        own, later, gone, now = sentences(text or ""), set(), set(), []
        for at in range(len(own) - run + 1):
            if first[tuple(own[at : at + run])] != rank(doc_id, text, at):
                later |= set(range(at, at + run))
        for k in range(len(own) + 1):
            if k in later:
                now.append(k)
            else:
                gone |= set(now) if sum(len(own[x].encode()) for x in now) >= min_bytes else set()
                now = []
        out[doc_id, text] = sorted(gone)
    return out


def without(text, units):
    """The text without the pieces of these sentences and those without a word behind them."""
    gone, kept, unit = False, [], -1
    for piece in cut(text or "", SENTENCE):
        if piece.strip(SPACE + SENTENCE[1]):
            unit += 1
            gone = unit in units
        kept += [] if gone else [piece]
    return text if text is None else "".join(kept)


PASSAGE = "One two three, four five: six seven eight. Nine ten eleven! Twelve; thirteen fourteen"


@pytest.mark.parametrize("min_words", [1, 6, 25])
def test_passages_equal_the_plain_version(documents, min_words):
    rng = random.Random(min_words)

    def text():
        return "".join(rng.choices(["a b", "c", "D e f", ", ", ". ", ".", "\n", " ", "... ", "|\t", "é ü", "中文", "。", "、字字", "\r\n"], k=60))

    some = [text() for _ in range(30)]
    docs = [(k, rng.choice(some) + rng.choice([". ", "\n", " "]) + rng.choice(some)) for k in range(60)]
    docs += [(None, some[0]), (100, None), (101, ""), (102, " \n "), (103, "中文字" * 9 + "。x"), (104, "y、" + "中文字" * 9 + "。"), (105, PASSAGE * 3000)]
    docs += [(7, docs[7][1]), (7, docs[7][1])]
    found = line_hashing.removed_passages(documents(*docs).withColumn("place", F.lit(1)), min_words)
    assert collected(found) == sorted(plain(docs, min_words), key=str)


def test_passages_are_cut_out_of_their_lines(documents):
    docs = documents((1, f"Own start, {PASSAGE}. Own end"), (2, f"Other start here, {PASSAGE}. Other end"), (3, "four five: six"), (4, None))
    docs = docs.select("*", *(F.lit(c).alias(c) for c in ("id", "spans", "removed_spans")))
    removed = line_hashing.removed_passages(docs, 10)
    kept = line_hashing.remove_passages(docs, removed)
    assert kept.columns == [*docs.columns, "removed_spans_0"]
    rows = {r["doc_id"]: r for r in kept.collect()}
    assert rows[2]["text"] == "Other start here, Other end" and rows[4]["text"] is None
    assert [rows[k]["text"] for k in (1, 3)] == [f"Own start, {PASSAGE}. Own end", "four five: six"]
    text = f"Other start here, {PASSAGE}. Other end"
    assert " ".join(text[s["start"] : s["end"]] for s in rows[2]["removed_spans_0"]) == f"{PASSAGE}."


def test_no_documents(documents):
    empty = documents().limit(0)
    removed = line_hashing.removed_passages(empty)
    assert removed.collect() == [] and line_hashing.remove_passages(empty, removed).collect() == []


@pytest.mark.parametrize(("run", "min_bytes"), [(1, 4), (2, 1), (3, 40), (2, 25)])
def test_winnowed_passages_equal_the_plain_version(documents, run, min_bytes):
    rng = random.Random(run)

    def text():
        return "".join(rng.choices(["a b", "c", "D e f", ", ", ". ", "\n", " ", "... ", "é ü", "中文字。", "\r\n"], k=rng.randint(0, 40)))

    some = [text() for _ in range(20)]
    docs = [(k, rng.choice(some) + rng.choice([". ", "\n", " "]) + rng.choice(some)) for k in range(50)]
    docs += [(None, some[0]), (None, some[1]), (100, None), (101, ""), (102, " \n "), (103, "x. " * 5000), (7, docs[7][1]), (8, some[3])]
    docs += [(104, "A  b\t c. D\x0be f.  \n。 Ü 中文。。字"), (105, "a b c. d e f. ü 中文. 字")]
    table = documents(*docs).select("*", *(F.lit(c).alias(c) for c in ("keys", "copy", "at", "places", "pieces", "sizes", "gone")))
    want = winnowed(docs, run, min_bytes)
    found = {}
    copies = {r["copy"]: r["text"] for r in table.select(F.xxhash64("text").alias("copy"), "text").distinct().collect()}
    for r in winnowing.repeated_passages(table, run, min_bytes).collect():
        found.setdefault((r["doc_id"], copies[r["copy"]]), []).append(r["unit"])
    assert {k: sorted(v) for k, v in found.items()} == {k: v for k, v in want.items() if v}
    kept = winnowing.delete_passages(table, run, min_bytes)
    assert kept.columns == table.columns
    got = sorted(((r["doc_id"], r["text"]) for r in kept.collect()), key=str)
    assert got == sorted(((i, without(t, want[i, t])) for i, t in docs), key=str)


def test_no_documents_to_winnow(documents):
    empty = documents().limit(0)
    assert winnowing.repeated_passages(empty).collect() == [] and winnowing.delete_passages(empty).collect() == []


def test_winnowing_runs_in_the_jvm(documents):
    plan = winnowing.delete_passages(documents((1, "a, b. c"), (2, "a, b. c")))._jdf.queryExecution().executedPlan().toString()
    assert not any(name in plan for name in ("Python", "Arrow", "Pandas"))
