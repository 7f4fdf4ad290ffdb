"""Line dedup by winnowing over line hashes (operator 2), in DataFrame functions alone.

Lines with a word, normalised (A-Z lower-cased, ASCII white space collapsed), are hashed. Of each window of `run` line
hashes the rightmost minimum is a fingerprint, so every run of `run` lines holds one and equal runs choose the same.
Positions are joined to the first position with their fingerprint. Around those that are not the first, matches are
extended both ways to whole runs, which are compared by a hash of all their lines. A run goes if the same lines stand
earlier, by document id and then line; overlapping runs make one longer run. The result is exact: a line goes if, and
only if, it lies in a run of `run` lines that stands earlier as well. `long_repeats` finds the shorter runs of at least
so many words, on request (`long_words`): each is a window of its own, compared in the same way.

Passages begin and end inside lines, so `repeated_passages` cuts lines into sentences (at marks before white space and at
marks of unspaced scripts) and winnows their hashes in the same way. Positions with a fingerprint meet in an aggregate that
keeps the first of them and their number. Texts learn which of their fingerprints stand nowhere else; around the others
the windows are compared by a hash of all their sentences, in the same way. Windows that are not the first of theirs and
overlap or touch extend each other both ways, up to where the repeat ends; such a run goes if its sentences, lower-cased and
with white space collapsed, hold `min_bytes` bytes of UTF-8. Aggregates combine before their shuffle and nothing is joined on a hash, so
frequent passages need no splitting. `delete_passages` deletes the sentences' pieces of the text with the white space behind.

Defined cases: null and empty texts have no lines; lines without a word are no part of a run, stay, and do not break
one; texts with fewer than `run` lines lose nothing but long runs; a null id ranks first; rows that share an id are
treated alike (passages: those with the same text). For long runs white space parts words, and a character of a script without spaces counts as one.
Clashing column names don't matter: only doc_id and text are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from perigee.llm.shared import fresh, in_runs, parts_left, rejoined, stored

RUN = 3
_SPACE = "[ \\t\\n\\x0B\\f\\r]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


_UNSPACED = "[" + "".join(f"\\p{{Is{s}}}" for s in ("Han", "Hiragana", "Katakana", "Thai", "Lao", "Khmer", "Myanmar")) + "]"


def _key(line: Column) -> Column:
    """A hash of the normalised line; null for a line without a word."""
    normal = F.trim(F.regexp_replace(F.translate(line, _UPPER, _LOWER), _SPACE, " "))
    return F.when(normal != "", F.xxhash64(normal))


def sequences(docs: DataFrame) -> DataFrame:
    """doc_id, keys (hashes of the lines with a word), numbers (their places among all lines)."""
    keyed = F.transform(F.split("text", "\n", -1), lambda line, i: F.struct(_key(line).alias("key"), i.alias("at")))
    found = docs.select("doc_id", F.filter(keyed, lambda x: x["key"].isNotNull()).alias("_l"))
    return found.select("doc_id", F.col("_l.key").alias("keys"), F.col("_l.at").alias("numbers"))


def _starts(n: Column, run: int) -> Column:
    """0 to n - run; empty if there is no run."""
    return F.when(n >= run, F.sequence(F.lit(0), n - run)).otherwise(F.array().cast("array<int>"))


def fingerprints(seqs: DataFrame, run: int = RUN) -> DataFrame:
    """doc_id, at (place in the sequence), key: the window minima, each once."""

    def minimum(start: Column) -> Column:
        window = F.slice("keys", start + 1, run)
        # Order by value, then from the right: -at makes the rightmost the least.
        ordered = F.transform(window, lambda key, i: F.struct(key.alias("key"), (-(start + i)).alias("at")))
        return -F.array_min(ordered)["at"]

    # Distinct places, not structs: numbers are hashed, structs would be compared pair by pair.
    places = F.array_distinct(F.transform(_starts(F.size("keys"), run), minimum))
    picked = F.transform(places, lambda at: F.struct(at.alias("at"), F.col("keys")[at].alias("key")))
    return seqs.select("doc_id", F.explode(picked).alias("f")).select("doc_id", "f.at", "f.key")


def repeated_lines(docs: DataFrame, run: int = RUN) -> DataFrame:
    """doc_id, line: the numbers of all lines to delete, from 0."""
    if run < 1:
        raise ValueError("run must be at least 1")
    seqs = stored(sequences(docs))
    rank = F.struct("doc_id", "at")
    prints = fingerprints(seqs, run).groupBy("key").agg(F.min(rank).alias("lo"), F.max(rank).alias("hi"))
    # Stored, so that both sides of the joins are plain shuffles, whose large parts adaptive execution can split.
    shared = stored(prints.where("lo < hi").select("key"))
    # Both ways around a shared fingerprint: the runs that hold it.
    marked = fingerprints(seqs, run).join(shared, "key", "left_semi")
    places = marked.groupBy("doc_id").agg(F.collect_set("at").alias("ats"))
    around = F.array_distinct(
        F.flatten(F.transform("ats", lambda at: F.sequence(F.greatest(at - (run - 1), F.lit(0)), at)))
    )
    held = seqs.join(places.withColumnRenamed("doc_id", "id"), F.col("doc_id").eqNullSafe(F.col("id")))
    starts = F.filter(around, lambda at: at <= F.size("keys") - run)

    def span(at: Column) -> Column:
        window = F.slice("keys", at + 1, run)
        return F.struct(
            at.alias("at"),
            F.slice("numbers", at + 1, run).alias("span"),
            F.xxhash64(window).alias("h1"),
            F.hash(F.reverse(window)).alias("h2"),
        )

    # Cut before they are rows, so that no row carries the whole sequence.
    spans = held.select("doc_id", F.explode(F.transform(starts, span)).alias("s")).select("doc_id", "s.*")
    spans = stored(spans)
    first = spans.groupBy("h1", "h2").agg(F.min(rank).alias("lo"), F.max(rank).alias("hi"))
    first = stored(first.where("lo < hi").select("h1", "h2", "lo"))
    later = spans.join(first, ["h1", "h2"]).where(F.col("lo") < rank)
    return later.select("doc_id", F.explode("span").alias("line")).distinct()


def _words(line: Column) -> Column:
    """How many words a line has that has one."""
    trimmed = F.trim(F.regexp_replace(line, _SPACE, " "))
    spaced = F.length(trimmed) - F.length(F.replace(trimmed, F.lit(" "), F.lit(""))) + 1
    wide = F.octet_length(trimmed) > F.length(trimmed)
    return F.when(wide, F.greatest(spaced, F.regexp_count(trimmed, F.lit(_UNSPACED)))).otherwise(spaced)


def long_repeats(docs: DataFrame, long_words: int, run: int = RUN) -> DataFrame:
    """doc_id, line: the lines of runs of fewer than `run` lines, but `long_words` words, that stand earlier."""
    line = F.transform(
        F.split("text", "\n", -1),
        lambda x, i: F.struct(_key(x).alias("key"), i.alias("number"), _words(x).alias("words")),
    )
    seqs = docs.select("doc_id", F.filter(line, lambda x: x["key"].isNotNull()).alias("lines"))

    def spans(size: int) -> Column:
        def span(at: Column) -> Column:
            window = F.slice("lines", at + 1, size)
            keys = F.transform(window, lambda x: x["key"])
            return F.struct(
                at.alias("at"),
                F.transform(window, lambda x: x["number"]).alias("span"),
                F.aggregate(window, F.lit(0), lambda n, x: n + x["words"]).alias("words"),
                F.xxhash64(keys).alias("h1"),
                F.hash(F.reverse(keys)).alias("h2"),
            )

        return F.filter(F.transform(_starts(F.size("lines"), size), span), lambda s: s["words"] >= long_words)

    every = F.concat(F.array().cast("array<struct<at:int,span:array<int>,words:int,h1:bigint,h2:int>>"), *map(spans, range(1, run)))
    rows = seqs.select("doc_id", F.explode(every).alias("s"))
    rows = stored(rows.select("doc_id", "s.at", "s.span", F.size("s.span").alias("size"), "s.h1", "s.h2"))
    rank, alike = F.struct("doc_id", "at"), ["size", "h1", "h2"]
    first = rows.groupBy(*alike).agg(F.min(rank).alias("lo"), F.max(rank).alias("hi"))
    first = stored(first.where("lo < hi").select(*alike, "lo"))
    later = rows.join(first, alike).where(F.col("lo") < rank)
    return later.select("doc_id", F.explode("span").alias("line")).distinct()


def removed_runs(removed: DataFrame) -> DataFrame:
    """doc_id, lines (sorted array of the numbers of its deleted lines); documents that lose none have no row."""
    return removed.groupBy("doc_id").agg(F.array_sort(F.collect_list("line")).alias("lines"))


def delete_runs(docs: DataFrame, run: int = RUN, long_words: int | None = None) -> DataFrame:
    """The documents with their repeated runs deleted, with `long_words` the long ones of fewer lines too; all columns as
    they were."""
    lines = repeated_lines(docs, run)
    if long_words is not None:
        lines = lines.union(long_repeats(docs, long_words, run)).distinct()
    gone = removed_runs(lines).select(F.col("doc_id").alias("id"), F.col("lines").alias("gone"))
    joined = docs.join(gone, docs["doc_id"].eqNullSafe(gone["id"]), "left")
    name = fresh(docs.columns, "lines")
    made = joined.select(*(docs[c] for c in docs.columns), parts_left(docs["text"], gone["gone"], "\n").alias(name))
    text = rejoined(made[name], made["text"], "\n")
    return made.select(*(text.alias("text") if c == "text" else made[c] for c in docs.columns))


#: Sentences to a window, and bytes that a run needs: about 25 words of English or 50 ideographs.
SENTENCES, PASSAGE_BYTES = 2, 150
_WIDE = "[\u3002\uff01\uff1f\uff1b\uff1a]+"
#: What ends a sentence, with the white space behind its marks; and the same without the marks.
SENTENCE = f"(?:[.!?;:]+[ \\t\\x0B\\f\\r\\n]+|\\n|{_WIDE})"
_BORDER = f"(?<=[.!?;:])[ \\t\\x0B\\f\\r\\n]+|\\n|{_WIDE}"
_ODD_SPACE = "\t", "\x0b", "\f", "\r", "  "


def sentence_sequences(docs: DataFrame, run: int = SENTENCES) -> DataFrame:
    """doc_id, copy (a hash of the text), of its sentences with a word keys (hashes) and sizes (bytes), and minima: the
    places of the fingerprints, the rightmost minima of all windows. Texts without a window have no row."""
    # Generators, lest what uses a part repeats the whole.
    lower = F.explode(F.array(F.lower(F.coalesce("text", F.lit("")))))
    made = docs.select("doc_id", F.xxhash64("text").alias("copy"), lower.alias("lower"))
    odd = F.lit(False)
    for space in _ODD_SPACE:
        odd = odd | F.contains("lower", F.lit(space))
    plain = F.when(odd, F.regexp_replace("lower", _SPACE.replace("\\n", ""), " ")).otherwise(F.col("lower"))
    made = made.select("doc_id", "copy", F.explode(F.array(F.split(plain, _BORDER, -1))).alias("parts"))
    trimmed = F.explode(F.array(F.filter(F.transform("parts", lambda part: F.trim(part)), lambda part: part != "")))
    made = made.select("doc_id", "copy", trimmed.alias("parts")).where(F.size("parts") >= run)
    keys = F.explode(F.array(F.transform("parts", lambda part: F.xxhash64(part))))
    sizes = F.transform("parts", lambda part: F.octet_length(part))
    made = made.select("doc_id", "copy", keys.alias("keys"), sizes.alias("sizes"))
    minima = F.array_distinct(F.transform(_starts(F.size("keys"), run), lambda start: _minimum(start, run)))
    return made.select("*", minima.alias("minima"))


def _minimum(start: Column, run: int) -> Column:
    """The place of the rightmost minimum of the window."""
    best, at = F.get("keys", start), start
    for k in range(1, run):
        other = F.get("keys", start + k)
        at, best = F.when(other <= best, start + k).otherwise(at), F.least(best, other)
    return at


def _first_places(rows: DataFrame, key: list[str], which: str) -> DataFrame:
    """By text, the places that are the first of their key (`which`: a condition on the number n of places with it)."""
    found = rows.groupBy(*key).agg(F.min(F.struct("doc_id", "copy", "at")).alias("first"), F.count("*").alias("n"))
    own = found.where(which).groupBy(F.col("first.doc_id").alias("id"), F.col("first.copy").alias("text"))
    return own.agg(F.collect_list("first.at").alias("places"))


def _with_places(texts: DataFrame, places: DataFrame) -> DataFrame:
    same = F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("copy") == F.col("text"))
    none = F.array().cast("array<int>")
    return texts.join(places, same, "left").withColumn("places", F.coalesce("places", none)).drop("id", "text")


def repeated_passages(docs: DataFrame, run: int = SENTENCES, min_bytes: int = PASSAGE_BYTES) -> DataFrame:
    """doc_id, copy, unit: the sentences to delete, by their numbers among those of their text that have a word."""
    if run < 1:
        raise ValueError("run must be at least 1")
    seqs = stored(sentence_sequences(docs, run))
    print_ = F.explode(F.transform("minima", lambda at: F.struct(at.alias("at"), F.get("keys", at).alias("key"))))
    prints = seqs.select("doc_id", "copy", print_.alias("p")).select("doc_id", "copy", "p.at", "p.key")
    told = _with_places(seqs, _first_places(prints, ["key"], "n = 1"))
    # Around each fingerprint that stands elsewhere too: the windows that chose it.
    around = F.flatten(
        F.transform(
            F.array_except("minima", "places"),
            lambda at: F.filter(
                F.sequence(F.greatest(at - (run - 1), F.lit(0)), F.least(at, F.size("keys") - run)),
                lambda start: _minimum(start, run) == at,
            ),
        )
    )

    def window(at: Column) -> Column:
        keys = F.slice("keys", at + 1, run)
        return F.struct(at.alias("at"), F.xxhash64(keys).alias("h1"), F.hash(F.reverse(keys)).alias("h2"))

    held = told.select("doc_id", "copy", "sizes", F.transform(around, window).alias("w")).where(F.size("w") > 0)
    held = held.select("doc_id", "copy", "sizes", F.col("w.at").alias("ats"), F.col("w.h1").alias("h1"), F.col("w.h2").alias("h2"))
    held = stored(held)
    windows = held.select("doc_id", "copy", F.explode(F.arrays_zip("ats", "h1", "h2")).alias("w"))
    windows = windows.select("doc_id", "copy", F.col("w.ats").alias("at"), "w.h1", "w.h2")
    known = _with_places(held.select("doc_id", "copy", "sizes", "ats"), _first_places(windows, ["h1", "h2"], "n > 0"))
    later = F.array_except("ats", "places")
    units = F.array_distinct(F.flatten(F.transform(later, lambda at: F.sequence(at, at + (run - 1)))))
    unit = F.transform(units, lambda at: F.struct(at.alias("place"), F.get("sizes", at).alias("words")))
    rows = known.select("doc_id", "copy", F.explode(unit).alias("u")).select("doc_id", "copy", "u.place", "u.words")
    found = in_runs(rows, ["doc_id", "copy"], min_bytes)
    return found.select("doc_id", "copy", F.col("place").alias("unit")).distinct()


def removed_passages(removed: DataFrame) -> DataFrame:
    """doc_id, units (sorted numbers of its deleted sentences); documents that lose none have no row."""
    return removed.groupBy("doc_id").agg(F.array_sort(F.collect_set("unit")).alias("units"))


def delete_passages(docs: DataFrame, run: int = SENTENCES, min_bytes: int = PASSAGE_BYTES) -> DataFrame:
    """The documents without their repeated passages; all columns as they were."""
    removed = repeated_passages(docs, run, min_bytes)
    gone = removed.groupBy(F.col("doc_id").alias("id"), F.col("copy").alias("copy")).agg(F.collect_list("unit").alias("gone"))
    same = docs["doc_id"].eqNullSafe(gone["id"]) & (F.xxhash64(docs["text"]) == gone["copy"])
    name = fresh(docs.columns, "pieces")
    pieces = F.regexp_extract_all(docs["text"], F.lit(f"(?s:.*?){SENTENCE}|(?s:.+)"), F.lit(0))
    lost, none = gone["gone"].isNotNull(), F.array().cast("array<int>")
    cut = F.struct(
        F.when(lost, pieces).otherwise(F.array().cast("array<string>")).alias("pieces"),
        F.when(lost, gone["gone"]).otherwise(none).alias("gone"),
        (~lost).alias("whole"),
    )
    made = docs.join(gone, same, "left").select(*(docs[c] for c in docs.columns), F.explode(F.array(cut)).alias(name))
    # The numbers of the pieces that have a word; a sentence is its piece and those without a word behind it.
    own = made[name]
    every = F.when(F.size(own["pieces"]) > 0, F.sequence(F.lit(0), F.size(own["pieces"]) - 1)).otherwise(none)
    worded = F.filter(every, lambda i: ~F.regexp_like(own["pieces"][i], F.lit(f"^(?:{_SPACE}|{_WIDE})*$")))
    numbers = F.struct(*(own[c].alias(c) for c in ("pieces", "gone", "whole")), every.alias("every"), worded.alias("worded"))
    made = made.select(*(made[c] for c in docs.columns), F.explode(F.array(numbers)).alias(name))
    own = made[name]

    def piece_numbers(unit: Column) -> Column:
        end = F.coalesce(F.get(own["worded"], unit + 1), F.size(own["pieces"]))
        return F.sequence(F.get(own["worded"], unit), end - 1)

    left = F.array_except(own["every"], F.flatten(F.transform(own["gone"], piece_numbers)))
    rest = F.explode(F.array(F.struct(own["pieces"].alias("parts"), left.alias("left"), own["whole"].alias("whole"))))
    made = made.select(*(made[c] for c in docs.columns), rest.alias(name))
    text = rejoined(made[name], made["text"], "")
    return made.select(*(text.alias("text") if c == "text" else made[c] for c in docs.columns))
