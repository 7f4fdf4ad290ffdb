"""The operators' results computed plainly, one document at a time."""

import collections
import hashlib
import math
import re
import zlib

import numpy as np
import xxhash

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text, lower=False):
    text = text or ""
    return re.findall("[^\x20\x09-\x0d]+", text.translate(LOWER) if lower else text)


def fold(doc_id, n):
    return zlib.crc32(str(doc_id).encode()) % n


def normal(line):
    return " ".join(words(line, lower=True))


def op2(docs, run=3):
    """Lines to delete by (doc_id, line), from all windows of lines."""
    seen, gone = {}, set()
    for doc_id, text in sorted(docs, key=lambda d: (d[0] is not None, d[0] or 0)):
        lines = [(k, normal(x)) for k, x in enumerate((text or "").split("\n")) if normal(x)]
        for at in range(len(lines) - run + 1):
            key = tuple(x for _, x in lines[at : at + run])
            if seen.setdefault(key, (doc_id, at)) != (doc_id, at):
                gone |= {(doc_id, k) for k, _ in lines[at : at + run]}
    return gone


def without_runs(docs, run=3):
    gone = op2(docs, run)
    return [
        (i, t if t is None else "\n".join(x for k, x in enumerate(t.split("\n")) if (i, k) not in gone)) for i, t in docs
    ]


_ALNUM = "[^\x00-\x2f\x3a-\x60\x7b-\x7f]+"


def op3(text, items, limit=10):
    """Number of words, hit places, ids of the items with an occurring window."""
    found = re.findall(_ALNUM, (text or "").translate(LOWER))
    hit, named = set(), set()
    for item, content in items:
        own = re.findall(_ALNUM, (content or "").translate(LOWER))
        size = min(limit, len(own))
        wanted = {tuple(own[k : k + size]) for k in range(len(own) - size + 1)} if own else set()
        for k in range(len(found) - size + 1):
            if tuple(found[k : k + size]) in wanted:
                hit |= set(range(k, k + size))
                named.add(item)
    return len(found), hit, named


def without_items(text, items, limit=10, max_coverage=0.5):
    """The text without hit words and what stands between them; None if too much of it is hit."""
    n, hit, _ = op3(text, items, limit)
    if not hit:
        return text
    if len(hit) > max_coverage * n:
        return None
    places = [m.span() for m in re.finditer(_ALNUM.replace("\x3a-\x60", "\x3a-\x40\x5b-\x60"), text)]
    out, at = "", 0
    for k in sorted(hit):
        out += text[at : places[k][0]] if k - 1 not in hit else ""
        at = places[k][1]
    return out + text[at:]


def op6_base(docs, n=5):
    """(n_tokens, n_known, N, base) by id."""
    tokens = {i: [*words(t, lower=True), "\n"] for i, t in docs}
    count = collections.Counter(w for i, ws in tokens.items() if fold(i, n) != 1 for w in ws)
    total = sum(count.values())
    mass = total + 0.5 * (len(count) + 1)
    return {
        i: (len(ws), sum(count[w] > 0 for w in ws), total, sum(math.log10((count[w] + 0.5) / mass) for w in ws))
        for i, ws in tokens.items()
    }


_PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def _luhn(digits):
    total = 0
    for k, d in enumerate(reversed(digits)):
        total += d if k % 2 == 0 else (2 * d if 2 * d < 10 else 2 * d - 9)
    return total % 10 == 0


def op7(text):
    """Plain spans by kind."""
    out = {}
    for kind, pattern in _PATTERNS.items():
        out[kind] = []
        for m in re.finditer(pattern, text or ""):
            digits = [int(c) for c in m[0] if c in "0123456789"]
            good = {
                "email": True,
                "ip": kind == "ip" and all(int(p) <= 255 for p in m[0].split(".")),
                "card": 13 <= len(digits) <= 19 and _luhn(digits),
                "phone": 9 <= len(digits) <= 15,
            }[kind]
            if good:
                out[kind].append(m.span())
    return out


def longest_repeats(found):
    n, out = len(found), [0] * len(found)
    for i in range(n):
        for j in range(n):
            k = 0
            while i != j and max(i, j) + k < n and found[i + k] == found[j + k]:
                k += 1
            out[i] = max(out[i], k)
    return [x if x > 1 else 0 for x in out]


def repeated_words(found, size):
    """Words in windows of that size that occur twice, and the longest repeat from windows of growing size."""
    count = collections.Counter(tuple(found[k : k + size]) for k in range(len(found) - size + 1))
    return len({k + d for k in range(len(found) - size + 1) if count[tuple(found[k : k + size])] > 1 for d in range(size)})


def longest_repeat(found):
    size = 1
    while repeated_words(found, size + 1):
        size += 1
    return size if size > 1 else 0


def op8(text):
    text = text or ""
    found, seen, dup = words(text), set(), 0
    for line in text.split("\n"):
        if words(line):
            dup += line in seen
            seen.add(line)
    return (
        len(found), sum(map(len, found)), sum(c in "#*$%&|<>" for c in text), dup, repeated_words(found, 3),
        repeated_words(found, 5), longest_repeat(found),
    )


def op8_kept(text):
    n, _, _, _, repeated, covered, longest = op8(text)
    failed = n < 50 or 100 * repeated > 50 * n
    return failed, not failed and covered <= 0.15 * n and longest <= max(8, 0.1 * n)


def few_symbols(text):
    return sum(c in "#*$%&|<>" for c in text or "") <= 0.3 * len(words(text))


def fingerprint(text, size=3):
    found = words(text, lower=True)
    shingles = [found[k : k + size] for k in range(max(1, len(found) - size + 1))] if found else []
    values = [xxhash.xxh64_intdigest(" ".join(s).encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(v >> b & 1 for v in values) > len(values))


def op9(docs, distance=3):
    """(fingerprint, component) by id."""
    prints = {i: fingerprint(t) for i, t in docs}
    ids = sorted(prints)
    values = np.array([prints[i] for i in ids], np.uint64)
    root = {i: i for i in ids}

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for k, i in enumerate(ids):
        for other in np.flatnonzero(np.bitwise_count(values[k + 1 :] ^ values[k]) <= distance) + k + 1:
            a, b = sorted((top(i), top(ids[other])))
            root[b] = a
    return {i: (f"{prints[i]:016x}", top(i)) for i in ids}


def sha256(text):
    return hashlib.sha256(text.encode()).hexdigest()
