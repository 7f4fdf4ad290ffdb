"""Personal data by offset-preserving deobfuscation (operator 7).

Plain patterns find what is written openly. Then transducers rewrite the text: look-alike characters to ASCII, invisible
ones to nothing, references and escapes, spelled digits (in four languages) and disguises of @ and . to themselves. Each character of the outcome carries
the span of the source it came from, so identifiers found in it are mapped back to source characters. What overlaps a
plain find of its kind is not added, unless look-alikes had cut that short; nor is what no transducer has touched.

Defined cases: a null or empty text has no spans; repeated rows are searched alike; a null id stays null; other columns
are ignored by `found` and kept by `masked`. Offsets are code points, ends exclusive.
"""

from __future__ import annotations

import re
import unicodedata
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from perigee.llm.shared import mapped, narrow

KINDS = ("email", "ip", "card", "phone")
Span = tuple[int, int]

# Each pattern is tried once for a run of its characters, so that a long run costs no more than its length.
_NAME_CHARACTERS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_HOST = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def _digits(text: str) -> list[int]:
    return [ord(c) - 48 for c in text if "0" <= c <= "9"]


def luhn(digits: list[int]) -> bool:
    doubled = [d * 2 - 9 * (d > 4) for d in digits[-2::-2]]
    return (sum(digits[-1::-2]) + sum(doubled)) % 10 == 0


def _emails(text: str) -> list[Span]:
    """Leftmost matches of name@host: an @ before which a name ends, and after which a host begins."""
    out, done, at = [], 0, text.find("@")
    while at >= 0:
        host, start = _HOST.match(text, at + 1), at
        while host and start > done and text[start - 1] in _NAME_CHARACTERS:
            start -= 1
        if start < at:
            done = host.end()
            out.append((start, done))
        at = text.find("@", at + 1)
    return out


def _octet(part: str) -> bool:
    """At most 255; a number may have any number of digits."""
    part = part.lstrip("0")
    return len(part) <= 3 and int(part or 0) <= 255


def plain(text: str) -> dict[str, list[Span]]:
    """Leftmost, non-overlapping matches by kind; those that fail their check are dropped."""
    if not any(c in text for c in "0123456789@"):
        return {kind: [] for kind in KINDS}
    ips = (m for m in _IP.finditer(text) if all(map(_octet, m[0].split(".")))) if "." in text else ()
    cards = (m for m in _CARD.finditer(text) if 13 <= len(d := _digits(m[0])) <= 19 and luhn(d))
    phones = (m for m in _PHONE.finditer(text) if 9 <= len(_digits(m[0])) <= 15) if "+" in text else ()
    return {
        "email": _emails(text),
        "ip": [m.span() for m in ips],
        "card": [m.span() for m in cards],
        "phone": [m.span() for m in phones],
    }


# Transducers: each takes a text and the source spans of its characters (rows of start and end), and gives both anew.

# Letters of other scripts that look like ASCII ones, and what they look like.
_ALIKE = dict(
    zip(
        "АВЕЅІЈКМНОРСТУХаеѕіјорсухһԁԛԝӏΑΒΕΖΗΙΚΜΝΟΡΤΥΧονρι٫․。．∙•＠﹫＋﹢➕‐‑‒–—−",
        "ABESIJKMHOPCTYXaesijopcyxhdqwlABEZHIKMNOPTYXovpi.....·@@+++------",
        strict=False,
    )
)
_ALIKE["∙"] = _ALIKE["•"] = "."
_ALIKE |= dict(zip("\u03b1\u03c4\u03c5\u03ba\u0131\u0251\u0261\u03f2\u03f3\u043a\u0475\u0585\u057d\u0578\u0570\u0581", "atukiagcjkvounhg", strict=True))
_INVISIBLE = "­᠎​‌‍⁠⁡⁢⁣⁤﻿"
#: Marks of writing direction, and what joins or varies characters.
_INVISIBLE += "\u200e\u200f\u061c\u202a\u202b\u202c\u202d\u202e\u2066\u2067\u2068\u2069\u034f" + "".join(map(chr, range(0xFE00, 0xFE10)))


@lru_cache(maxsize=4096)
def _folded(c: str) -> str:
    """The ASCII character that c stands for, nothing for an invisible one, or c."""
    if c < "\x80":
        return c
    if c in _INVISIBLE:
        return ""
    if c in _ALIKE:
        return _ALIKE[c]
    if c in "     ":
        return " "
    digit = unicodedata.digit(c, -1)
    if digit >= 0:
        return str(digit)
    wide = unicodedata.normalize("NFKC", c)
    return wide if len(wide) == 1 and wide < "\x80" else c


def fold(text: str, spans: np.ndarray) -> tuple[str, np.ndarray]:
    if text.isascii():
        return text, spans
    folded = [_folded(c) for c in text]
    return "".join(folded), spans[np.fromiter(map(bool, folded), bool, len(folded))]


# Names of the digits in English, French, German and Spanish, and of what stands between and before them.
_DIGIT_NAMES = {
    "zero": "0", "oh": "0", "one": "1", "two": "2", "three": "3", "four": "4", "five": "5", "six": "6", "seven": "7",
    "eight": "8", "nine": "9",
    "zéro": "0", "un": "1", "deux": "2", "trois": "3", "quatre": "4", "cinq": "5", "sept": "7", "huit": "8", "neuf": "9",
    "null": "0", "eins": "1", "zwei": "2", "zwo": "2", "drei": "3", "vier": "4", "fünf": "5", "sechs": "6", "sieben": "7",
    "acht": "8", "neun": "9",
    "cero": "0", "uno": "1", "dos": "2", "tres": "3", "cuatro": "4", "cinco": "5", "seis": "6", "siete": "7", "ocho": "8",
    "nueve": "9",
}
_TIMES = {"double": 2, "triple": 3}
_NAME = rf"(?:(?:{'|'.join(_TIMES)})[\x20-]+)?(?:{'|'.join(sorted(_DIGIT_NAMES, key=len, reverse=True))})"
_MARK = {
    "dot": ".", "point": ".", "period": ".", "punkt": ".", "punto": ".", "plus": "+", "más": "+", "dash": "-", "hyphen": "-",
}
_LETTER = "[A-Za-zÀ-ÖØ-öø-ÿ]"
_TOKEN = re.compile(rf"(?<!{_LETTER})(?:{_NAME}|{'|'.join(_MARK)})(?!{_LETTER})|[0-9]+", re.IGNORECASE)
_SPELLED = re.compile(
    rf"(?<![0-9])(?<!{_LETTER})(?:(?:plus|más)[\x20-]+)?(?:{_NAME}(?!{_LETTER})|[0-9]+)"
    rf"(?:[\x20,.()-]+(?:(?:{_NAME}|dot|point|period|punkt|punto|dash|hyphen)(?!{_LETTER})|[0-9]+))+",
    re.IGNORECASE,
)
_NAMED = re.compile(rf"(?<!{_LETTER})(?:{_NAME})(?!{_LETTER})", re.IGNORECASE)
_OPEN, _CLOSE = r"[\[({<]", r"[\])}>]"
_BRACKETED = re.compile(
    rf"(?:(?<!\s)\s+)?{_OPEN}\s*(?:(?P<at>at|ät|arroba|arobase|@)|(?P<dot>dot|point|punkt|punto|\.))\s*{_CLOSE}\s*", re.IGNORECASE
)
# Endings of host names that are no common word, so that a sentence with "at" and "dot" isn't taken for one.
_TOP = "com|net|org|edu|gov|mil|info|biz|dev|app|io|ai|co|tv|uk|de|fr|es|nl|ch|eu|ca|au|jp|cn|br|ru|pl|se|fi|dk|pt"
_TOPS = frozenset(_TOP.split("|"))
#: Any other ending of letters counts after a host that isn't one of these words,
_NO_HOST = frozenset(
    "a an the this that these those each every any some no one another either its my your his her our their which what "
    "same first second third next last red blue green black white yellow dot".split()
)
#: if the ending isn't one of these, or the name looks like one of an address.
_NO_END = frozenset(
    "am an and are as at be but by can do does for from had has he her his if in is it its matrix me my no not now of on "
    "or our out over plot product she so than that the their them then there they this to under up us was we were when "
    "where which while who will with you your".split()
)
#: Nor after these words, unless they are part of a longer name.
_NO_NAME = frozenset("look looks looked looking point points pointed stare stares stared staring is are was were be start stop end aim".split())
_LOCAL, _LABEL = r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]+", "[A-Za-z0-9-]+"
#: name at host dot com, with "dot" spelled at least before the end, and at most 15 times in the name
_WORDED = re.compile(
    rf"(?P<name>{_LOCAL}(?:\s+dot\s+[A-Za-z0-9._%+-]+){{0,15}})(?:\s+at\s+|\s*@\s*)"
    rf"(?P<host>{_LABEL}(?:(?:\s+dot\s+|\.){_LABEL})*?\s+dot\s+{_LABEL}(?:(?:\s+dot\s+|\.){_LABEL})*)",
    re.IGNORECASE,
)
#: name @ host . com
_SPACED = re.compile(rf"(?P<name>{_LOCAL})\s*@\s*(?P<host>{_LABEL}(?:\s*\.\s*{_LABEL})+)", re.IGNORECASE)
#: first.last at host.com: the name must look like one of an address
_HALF = re.compile(
    rf"(?P<name>(?<![A-Za-z0-9._%+-])(?=[A-Za-z0-9%+-]*[0-9._%+-][A-Za-z0-9])[A-Za-z0-9._%+-]+)\s+at\s+"
    rf"(?P<host>{_LABEL}(?:\.{_LABEL})+)",
    re.IGNORECASE,
)
_PART = re.compile(r"(?P<by>\s+dot\s+|\s*\.\s*)(?P<label>[A-Za-z0-9-]+)", re.IGNORECASE)
_ENDING = re.compile(r"[A-Za-z]{2,}|xn--[A-Za-z0-9-]+", re.IGNORECASE)
_ADDRESS_NAME = re.compile(r"\sdot\s|[0-9._%+-][A-Za-z0-9]", re.IGNORECASE)
_AT_HOST = re.compile(r"\s*@|\s+at\s+[A-Za-z0-9-]+(?:\s+dot\s|\.[A-Za-z0-9])", re.IGNORECASE)


def _host_end(m: re.Match, text: str, spelled: bool) -> int:
    """Where the longest host name ends that the match holds, or 0."""
    name, host = m["name"], m["host"]
    sure = bool(_ADDRESS_NAME.search(name))
    first = re.match("[A-Za-z0-9-]+", host)[0].lower()
    # What goes on with an "at" and a host is the name of that address.
    other = (
        first not in _NO_HOST
        and (sure or name.lower() not in _NO_NAME)
        and any("a" <= c <= "z" for c in name.lower())
        and not _AT_HOST.match(text, m.end())
    )
    best = 0
    for part in _PART.finditer(text, m.start("host") + len(first), m.end()):
        label, by = part["label"], part["by"]
        if spelled and "." in by or text[part.end() : part.end() + 1] == "@":
            continue
        if "." in by and by[-1].isspace():
            # A stop and a space may end a sentence: after a host only a country goes on, and only after a stop apart.
            if best and (len(label) > 2 or label.lower() in _NO_END or not by[0].isspace()):
                break
            if label.lower() not in _TOPS and (label[0].isupper() or label.lower() in _NO_END or not by[0].isspace()):
                continue
        if label.lower() in _TOPS or other and _ENDING.fullmatch(label) and (sure or label.lower() not in _NO_END):
            best = part.end()
    return best


def _addresses(pattern: re.Pattern, text: str) -> Iterator[Span]:
    """Leftmost matches that end in a host name; after another one the search goes on at its host."""
    m = pattern.search(text)
    while m:
        end = _host_end(m, text, pattern is _WORDED)
        if end:
            yield m.start(), end
        m = pattern.search(text, end or m.start("host"))


#: 192 dot 168 dot 0 dot 1
_DOTTED = re.compile(r"(?<![A-Za-z0-9.])[0-9]{1,3}(?:\s+dot\s+[0-9]{1,3}){3}(?![0-9])", re.IGNORECASE)
_INNER = re.compile(r"\s+(?P<at>at)\s+|\s*(?P<sign>@)\s*|\s+(?P<dot>dot)\s+|\s*(?P<stop>\.)\s*", re.IGNORECASE)


def _replaced(text: str, spans: np.ndarray, edits: list[tuple[int, int, str]]) -> tuple[str, np.ndarray]:
    """Edits are (start, end, new text), ascending; a new character stands for the whole of what it replaces."""
    if not edits:
        return text, spans
    out, mapped, at = [], [], 0
    for start, end, new in edits:
        out += [text[at:start], new]
        mapped += [spans[at:start], *([[[spans[start, 0], spans[end - 1, 1]]]] * len(new))]
        at = end
    return "".join([*out, text[at:]]), np.concatenate([*mapped, spans[at:]])


# Characters written as references or percent escapes, and words that stand for @ alone.
_ESCAPED = re.compile(r"&#0{0,8}(64|46|43);|&#x0{0,8}(40|2e|2b);|&(commat|period|plus);|%(40|2e|2b)", re.IGNORECASE)
_ESCAPES = {"64": "@", "40": "@", "commat": "@", "46": ".", "2e": ".", "period": ".", "43": "+", "2b": "+", "plus": "+"}
_AT_WORD = re.compile(rf"(?<=[A-Za-z0-9])\s+(?:arroba|arobase)\s+(?={_LABEL}(?:\s+(?:punto|punkt|point|dot)\s+|\s*\.\s*)[A-Za-z])", re.IGNORECASE)
_DOT_WORDS = re.compile(rf"@\s*{_LABEL}(?:\s+(?:punto|punkt|point|dot)\s+{_LABEL}){{1,15}}", re.IGNORECASE)
_DOT_WORD = re.compile(r"\s+(?:punto|punkt|point)\s+", re.IGNORECASE)
#: jane_at_mail_dot_com, jane-at-mail-dot-com
_JOINED = re.compile(
    rf"(?<![A-Za-z0-9._%+-])(?P<name>[A-Za-z0-9.%+]+)(?P<by>[_-])at(?P=by)(?P<host>[A-Za-z0-9]+(?:(?P=by)dot(?P=by)[A-Za-z0-9]+){{1,15}})(?![A-Za-z0-9_-])",
    re.IGNORECASE,
)
#: janeATmailDOTcom
_CAPITAL = re.compile(r"(?<![A-Za-z0-9._%+-])(?P<name>[a-z0-9._%+-]+)AT(?P<host>[a-z0-9-]+(?:DOT[a-z0-9-]+){1,15})(?![A-Za-z0-9-])")
_CAPITAL_DOT, _JOINED_DOT = re.compile("DOT"), re.compile("[_-]dot[_-]", re.IGNORECASE)
#: j a n e @ and @ m a i l . c o m
_LETTERS_BEFORE = re.compile(r"(?<![A-Za-z0-9])[A-Za-z0-9](?:\x20[A-Za-z0-9_]){2,63}(?=\s*@)")
_LETTERS_AFTER = re.compile(r"@\s*(?:[A-Za-z0-9]\x20){2,63}\.(?:\x20[A-Za-z0-9.]){0,126}\x20[A-Za-z]\x20[A-Za-z](?![A-Za-z0-9])(?!\s*@)")
#: + 49 151 ..., no sum
_APART_PLUS = re.compile(r"(?:\A|(?<=[\n(:])|(?<=[^0-9)\]=\x20]\x20))\+\x20+(?=[0-9]{1,3}[\x20().-]*[0-9])")


def joined(text: str, spans: np.ndarray) -> tuple[str, np.ndarray]:
    """Escaped marks, words for @ and what follows them, disguises without spaces, spaced letters and a plus apart."""
    edits = [(m.start(), m.end(), _ESCAPES[m[m.lastindex].lower()]) for m in _ESCAPED.finditer(text)]
    text, spans = _replaced(text, spans, edits)
    text, spans = _replaced(text, spans, [(m.start(), m.end(), "@") for m in _AT_WORD.finditer(text)])
    edits = [(d.start(), d.end(), ".") for m in _DOT_WORDS.finditer(text) for d in _DOT_WORD.finditer(text, *m.span())]
    text, spans = _replaced(text, spans, edits)
    for pattern, dot, width in ((_JOINED, _JOINED_DOT, 4), (_CAPITAL, _CAPITAL_DOT, 2)):
        edits = []
        for m in pattern.finditer(text):
            edits.append((m.end("name"), m.end("name") + width, "@"))
            edits += [(d.start(), d.end(), ".") for d in dot.finditer(text, *m.span("host"))]
        text, spans = _replaced(text, spans, edits)
    for letters in (_LETTERS_BEFORE, _LETTERS_AFTER):
        edits = [(k, k + 1, "") for m in letters.finditer(text) for k in range(*m.span()) if text[k] == " "]
        text, spans = _replaced(text, spans, edits)
    return _replaced(text, spans, [(m.start() + 1, m.end(), "") for m in _APART_PLUS.finditer(text)])


def spelled_digits(text: str, spans: np.ndarray) -> tuple[str, np.ndarray]:
    """Runs of digit names, with digits and named marks among them, to digits. A single . between two tokens stays."""
    edits: list[tuple[int, int, str]] = []
    for run in _SPELLED.finditer(text):
        if not _NAMED.search(run[0]):
            continue
        before = None
        for token in _TOKEN.finditer(text, run.start(), run.end()):
            if before is not None and text[before : token.start()] != ".":  # what parts the tokens goes
                edits.append((before, token.start(), ""))
            edits.append((token.start(), token.end(), _spelled(token[0].lower())))
            before = token.end()
    return _replaced(text, spans, [e for e in edits if e[0] < e[1]])


def _spelled(token: str) -> str:
    """The digits or the mark that a token names; digits stay."""
    times, _, name = token.replace("-", " ").rpartition(" ")
    if name in _DIGIT_NAMES:
        return _DIGIT_NAMES[name] * _TIMES.get(times.strip(), 1)
    return _MARK.get(token, token)


def marks(text: str, spans: np.ndarray) -> tuple[str, np.ndarray]:
    """(at), [dot] and the like; then addresses and numbers whose marks are words or stand apart."""
    edits = [(m.start(), m.end(), "@" if m["at"] else ".") for m in _BRACKETED.finditer(text)]
    text, spans = _replaced(text, spans, edits)
    for disguised in (_WORDED, _SPACED, _HALF, _DOTTED):
        edits = []
        spans_in = (m.span() for m in _DOTTED.finditer(text)) if disguised is _DOTTED else _addresses(disguised, text)
        for span in spans_in:
            inner = _INNER.finditer(text, *span)
            edits += [(i.start(), i.end(), "@" if i["at"] or i["sign"] else ".") for i in inner]
        text, spans = _replaced(text, spans, edits)
    return text, spans


# What a disguise holds, in lower case; a text without any needs no transducer.
_BRACKETS = tuple(f"{a}{s}{b}" for a in "[({<" for s in ("", " ") for b in ("at", "ät", "arroba", "arobase", "@", "dot", ".", "point", "punkt", "punto"))
_JOINTS = "&#", "&commat", "&period", "&plus", "%40", "%2e", "%2b", "arroba", "arobase", "_at_", "-at-", "+ "


def _disguises(text: str) -> bool:
    """Whether a transducer could matter to the text: cheap tests that let too much through."""
    if not text.isascii() and any(_folded(c) != c for c in set(text) if c >= "\x80"):
        return True
    low = text.lower()
    if any(j in low for j in _JOINTS) or "DOT" in text and _CAPITAL.search(text):
        return True
    if " dot " in low or any(b in low for b in _BRACKETS):
        return True
    if "@" in low and re.search(r"\s@|@\s", low) or re.search(r"\bdot\b", low):
        return True
    if re.search(r"\sat\s", low) and _HALF.search(low):
        return True
    return any(name in low for name in _DIGIT_NAMES) and any(_NAMED.search(m[0]) for m in _SPELLED.finditer(low))


def _apart(span: Span, known: list[Span], text: str) -> bool:
    """No overlap with the known (ascending), or the whole of identifiers of which look-alikes left only a part open."""
    a, b = span
    near = known[bisect_right(known, a, key=lambda s: s[1]) : bisect_left(known, b, key=lambda s: s[0])]
    return all(a <= c and d <= b for c, d in near) and (not near or not text[a:b].isascii())


def hidden(text: str, open_spans: dict[str, list[Span]]) -> dict[str, list[Span]]:
    """Spans of disguised identifiers, in source characters."""
    none = {kind: [] for kind in KINDS}
    if not _disguises(text):
        return none
    places = np.arange(len(text))
    spans = np.stack([places, places + 1], 1)
    seen, source = marks(*spelled_digits(*joined(*fold(text, spans))))
    if seen == text:
        return none
    out = {}
    for kind, found in plain(seen).items():
        mapped = [(int(source[a, 0]), int(source[b - 1, 1]), seen[a:b]) for a, b in found]
        out[kind] = [
            (a, b)
            for a, b, new in mapped
            if text[a:b] != new and _apart((a, b), open_spans[kind], text)
        ]
    return out


def spans_of(text: str | None) -> tuple[dict[str, list[Span]], dict[str, list[Span]]]:
    """Plain spans and added spans, by kind."""
    first = plain(text or "")
    return first, hidden(text or "", first)


_FOUND = "doc_id bigint, spans array<struct<kind: string, start: bigint, end: bigint, plain: boolean>>"


def found(docs: DataFrame) -> DataFrame:
    """doc_id, spans: by kind (as in KINDS), then start; `plain` tells those of the plain patterns."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("plain", pa.bool_())]))
        for batch in batches:
            rows = []
            for text in batch["text"]:
                first, more = spans_of(text.as_py())
                rows.append([
                    {"kind": k, "start": a, "end": b, "plain": p}
                    for k in KINDS
                    for a, b, p in sorted([(*s, True) for s in first[k]] + [(*s, False) for s in more[k]])
                ])
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(rows, kind)], names=["doc_id", "spans"])

    return mapped(narrow(docs), search, _FOUND)


def mask(text: str | None) -> str | None:
    """The text with each identifier replaced by its kind in brackets; of overlapping ones the first."""
    if not text:
        return text
    first, more = spans_of(text)
    out, at = [], 0
    for a, b, kind in sorted((a, b, k) for k in KINDS for a, b in first[k] + more[k]):
        if a >= at:
            out += [text[at:a], f"[{kind}]"]
            at = b
    return "".join([*out, text[at:]])


def masked(docs: DataFrame) -> DataFrame:
    """The documents with masked texts; all other columns as they were."""
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text = pa.array([mask(t.as_py()) for t in batch["text"]], batch.schema.field("text").type)
            yield pa.RecordBatch.from_arrays([text if n == "text" else batch[n] for n in names], names=names)

    return mapped(docs, run, docs.schema)
