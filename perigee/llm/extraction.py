"""Main text of web pages by template deduction with equivalence classes (operator 12).

A page is a row of tokens, told apart by their roles: a block element's opening (tag, words of class and id) and a run of
text, each under the path of the elements around it. Over the pages of one host a token has an occurrence vector: how often
it stands on each page. Tokens of equal vectors are a class; vectors are compared by their numbers of pages and occurrences
and two sums of hashes of (page, count), which add up over partitions in any order. Classes that are frequent, large and
hold an element are valid if their tokens nest in one element of the template so far; the class of the page itself is its
root. The tokens of valid classes, in the order of their mean places, are the host's template; a class whose tokens stand
in another order on a page is no template there.

Text of the template goes: menus, notices and the like that say the same on each page. What is left stands in slots, each
under the innermost template element around it. Slots that hold no article go: by the names of tags, classes and ids around
them or, outside marked regions, because their text is mostly links over all pages of the host. If a page marks articles
(else a main region, else blocks named as content that hold most of its text) only what is in them stays. On a host's few
first pages, too few for classes, names alone decide.

Templates are as large as pages, not as hosts. If all of them together hold at most SMALL tokens they go to all executors,
and no page is moved; otherwise they are shuffled plainly with the pages, so that adaptive execution splits a large host.

Defined cases: a null or empty html, or one without such text, gives an empty text and 0; pages without a host share no
template; repeated rows are pages like others, but copies don't make a template out of an article: template text stays
where it is over half of the host's text in marked regions (nine tenths elsewhere). Comments, scripts and the like reach to
the end of a page that does not close them; a cut page is read as far as it goes. Other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from html import unescape

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from perigee.llm.shared import mapped, stored

#: A class is large with so many tokens, and frequent on so many pages and such a share of the host's.
LARGE, PAGES, SHARE = 3, 5, 0.5
#: Template text stays where it is more than this share of the host's text: in marked regions, elsewhere.
MARKED, UNMARKED = 0.5, 0.9
#: A slot whose text is links in more than this share is a menu.
LINKS = 0.5
_HELD = 100_000
#: Tokens of templates, of eight bytes, that may be broadcast.
SMALL = 1_000_000

# Roles of HTML elements.
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark nobr q rp rt ruby s samp small span strike "
    "strong sub sup time tt u var".split()
)
#: Elements whose content is no markup; and others without running text.
_RAW = frozenset("script style textarea title iframe noembed noframes xmp".split())
_OTHER_RAW = frozenset("template noscript svg math object canvas audio video".split())
_DROPPED = frozenset("nav header footer aside form menu dialog button select input fieldset datalist head label search".split())
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6 hgroup".split())
_CLOSES_P = frozenset(
    "address article aside blockquote details dialog div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr "
    "main menu nav ol p pre search section table ul".split()
)
#: What an opening tag closes, and what bounds the search for it.
_CLOSES = {
    "li": (frozenset(["li"]), frozenset(["ul", "ol", "menu"])),
    "dt": (frozenset(["dt", "dd"]), frozenset(["dl"])),
    "dd": (frozenset(["dt", "dd"]), frozenset(["dl"])),
    "tr": (frozenset(["tr", "td", "th"]), frozenset(["table"])),
    "td": (frozenset(["td", "th"]), frozenset(["tr", "table"])),
    "th": (frozenset(["td", "th"]), frozenset(["tr", "table"])),
    "option": (frozenset(["option"]), frozenset(["select"])),
    "body": (frozenset(["head"]), frozenset()),
}
_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar".split())

#: Words of classes and ids whose elements hold the article, and whose elements hold none.
_CONTENT = frozenset("article post entry story content main".split())
_NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense sponsor sponsored sponsors promo promos promotion banner banners "
    "nav navbar navigation menu menus breadcrumb breadcrumbs pagination pager header masthead topbar toolbar "
    "footer copyright colophon sidebar sidebars aside widget widgets related recommended recommendations trending popular "
    "comment comments commentlist disqus reply replies respond discussion notice notices cookie cookies consent gdpr alert alerts "
    "popup modal overlay newsletter subscribe subscription signup login paywall share sharing social form search skip hidden".split()
)
#: A name with one of these speaks of what stands beside the element.
_BESIDE = frozenset("has with without no".split())
CONTENT, MAIN, ARTICLE = 1, 2, 3
KEEP, HEADER, DROP = 0, 1, 2

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|</?[A-Za-z](?:[^<>\"']++|\"[^\"]*+\"|'[^']*+')*+>|<[!?/][^>]*+>?|</?[A-Za-z][^<>]*+>?", re.S
)
_NAME = re.compile(r"</?([A-Za-z][^\s/>]*)")
_ATTRIBUTE = re.compile(r"""([^\s"'<>/=]++)(?:\s*+=\s*+(?:"([^"]*+)"|'([^']*+)'|([^\s"'<>=`]++)))?""")
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
_HOST = r"(?i)^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)"


@dataclass(slots=True)
class _Open:
    """An open element."""

    tag: str
    token: int
    verdict: int
    region: int
    inline: bool = False
    same: int = 0


@dataclass(slots=True)
class Run:
    """A run of text: the token, the text, how much of it is in links, what the names around it say, the element it is in."""

    token: int
    text: str
    links: int
    verdict: int
    region: int
    inside: int


@dataclass(slots=True)
class Page:
    """The tokens of a page in order, the element around each element, and the runs of text."""

    tokens: list[int] = field(default_factory=list)
    parents: dict[int, int] = field(default_factory=dict)
    runs: list[Run] = field(default_factory=list)


def _token(kind: str, path: int, text: str) -> int:
    return xxhash.xxh3_64_intdigest(f"{kind}{path} {text}".encode()) >> 1


ROOT = _token("e", 0, "")


def _named(tag: str, words: list[list[str]], attributes: dict[str, str]) -> tuple[int, int]:
    """The verdict and the region that an element's tag and attributes ask for."""
    region = {"article": ARTICLE, "main": MAIN}.get(tag, MAIN if attributes.get("role") == "main" else 0)
    plain = [w for w in words if not _BESIDE.intersection(w)]
    content = any(_CONTENT.intersection(w) for w in plain)
    named = {w for ws in plain for w in ws if w in _NAMES}
    hidden = "hidden" in attributes or attributes.get("aria-hidden") == "true" or _HIDDEN.search(attributes.get("style", ""))
    if tag in ("html", "body", "main"):
        return KEEP, region
    if hidden or attributes.get("role") in _ROLES or tag in _DROPPED and tag != "header":
        return DROP, 0
    if tag == "article" and content:
        named.clear()
    if named - {"header"}:
        return DROP, 0
    if tag == "header" or named:
        return HEADER, 0
    return KEEP, region or (CONTENT if content else 0)


def parse(html: str | None) -> Page:
    """One reading of the page from its start to its end."""
    html, page = html or "", Page()
    page.tokens.append(ROOT)
    stack, pieces, links, in_link, at = [_Open("", ROOT, KEEP, 0)], [], 0, False, 0

    def flush() -> None:
        nonlocal links
        text = " ".join("".join(pieces).split())
        pieces.clear()
        if text:
            top = stack[-1]
            token = _token("t", top.token, text)
            page.tokens.append(token)
            page.runs.append(Run(token, text, min(links, len(text)), top.verdict, top.region, top.token))
        links = 0

    def depth_of(tags: frozenset, limits: frozenset = frozenset()) -> int | None:
        for depth in range(len(stack) - 1, 0, -1):
            if stack[depth].tag in tags:
                return depth
            if stack[depth].tag in limits:
                return None
        return None

    while at < len(html):
        match = _TOKEN.search(html, at)
        end = match.start() if match else len(html)
        if end > at:
            text = unescape(html[at:end])
            pieces.append(text)
            links += len(text.strip()) if in_link else 0
        if not match:
            break
        at, markup = match.end(), match[0]
        name = _NAME.match(markup)
        if not name:
            continue
        closing, tag = markup[1] == "/", name[1].lower()
        if (tag in _RAW or tag in _OTHER_RAW) and not closing:
            close = re.compile(f"</{re.escape(tag)}(?=[\\s/>]|\\Z)[^>]*+>?", re.I).search(html, at)
            if close or tag in _RAW:
                at = close.end() if close else len(html)
                pieces.append(" ")
            continue
        top = stack[-1]
        if tag in _INLINE:
            if tag == "a":
                in_link = not closing
            if top.inline and top.tag == tag:
                top.same += -1 if closing else 1
                if top.same < 0:
                    flush()
                    stack.pop()
                continue
            if closing or len(markup) == len(tag) + 2:
                continue
        elif tag in _VOID and tag not in ("hr", "input"):
            if tag == "br":
                pieces.append(" ")
            continue
        words, attributes = [], {}
        if not closing and len(markup) > len(tag) + 2:
            for m in _ATTRIBUTE.finditer(markup, name.end(), len(markup) - markup.endswith(">")):
                attributes.setdefault(m[1].lower(), unescape(m[2] or m[3] or m[4] or "").strip())
            for key in ("class", "id"):
                words += ([w.lower() for w in _WORD.findall(part)] for part in attributes.get(key, "").split())
        verdict, region = _named(tag, words, attributes)
        if tag in _INLINE and verdict != DROP:
            continue
        flush()
        if closing:
            in_link = False
            depth = depth_of(frozenset([tag]))
            if depth is not None:
                del stack[depth:]
            continue
        if tag not in _INLINE:
            in_link = False
            if top.tag == "p" and tag in _CLOSES_P:
                stack.pop()
            if tag in _CLOSES:
                depth = depth_of(*_CLOSES[tag])
                if depth is not None:
                    del stack[depth:]
        if tag in _VOID or markup.endswith("/>") and tag not in ("p", "div"):
            continue
        above = stack[-1]
        token = _token("e", above.token, " ".join([tag, *(w for ws in words for w in ws)]))
        if above.verdict == HEADER and tag in _HEADINGS and above.region:
            verdict = KEEP  # an article's own title
        elif verdict == HEADER and not above.region:
            verdict = DROP
        else:
            verdict = max(verdict, above.verdict)
        page.parents[token] = above.token
        page.tokens.append(token)
        stack.append(_Open(tag, token, verdict, max(region, above.region), tag in _INLINE))
    flush()
    return page


# Occurrence vectors

_ROLE = "host string, token bigint, parent bigint, is_text boolean, pages bigint, n bigint, h1 bigint, h2 bigint, place bigint, chars bigint, links bigint, marked bigint"
_SUMMED = ["pages", "n", "h1", "h2", "place", "chars", "links", "marked"]


def host(url: Column) -> Column:
    found = F.lower(F.regexp_extract(url, _HOST, 1))
    return F.when(found != "", found)


def _occurrences(name: str, page_id: int | None, html: str | None, held: dict) -> None:
    """Adds a page's tokens: for texts how long they are, in links and in marked regions; for elements all they hold."""
    page = parse(html)
    count, first = {}, {}
    for place, token in enumerate(page.tokens):
        count[token] = count.get(token, 0) + 1
        first.setdefault(token, place)
    sizes = {token: [0, 0, 0] for token in count}
    texts = {}
    for run in page.runs:
        texts[run.token] = run.inside
        if run.verdict != DROP:
            own = (len(run.text), run.links, len(run.text) if run.region else 0)
            for token in (run.token, run.inside):
                sizes[token] = [a + b for a, b in zip(sizes[token], own, strict=True)]
        else:
            sizes[run.inside][0] += len(run.text)
            sizes[run.inside][1] += run.links
    for token in reversed(page.parents):  # an element stands behind the one around it
        above = sizes[page.parents[token]]
        for k in range(3):
            above[k] += sizes[token][k]
    identity = xxhash.xxh3_64_intdigest(f"{page_id} {html or ''}".encode("utf-8", "surrogatepass"))
    hashes = {}
    for token, n in count.items():
        if n not in hashes:
            mixed = xxhash.xxh3_64_intdigest(f"{identity} {n}")
            hashes[n] = (mixed >> 32, mixed & 0xFFFFFFFF)
        values = (1, n, *hashes[n], first[token], *sizes[token])
        key = (name, token)
        row = held.get(key)
        if row is None:
            held[key] = [texts.get(token, page.parents.get(token)), token in texts, *values]
        else:
            row[2:] = [a + b for a, b in zip(row[2:], values, strict=True)]


def roles(pages: DataFrame) -> DataFrame:
    """The tokens of each host on PAGES pages or more, with the sums that stand for their occurrence vectors.

    h1 and h2 are sums of 32-bit hashes, whole in a long for two billion pages of a host.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict = {}
        for batch in batches:
            for name, page_id, text in zip(batch["host"].to_pylist(), batch["page_id"].to_pylist(), batch["html"], strict=True):
                _occurrences(name, page_id, text.as_py(), held)
                if len(held) >= _HELD:
                    yield _rows(held)
                    held.clear()
        yield _rows(held)

    def _rows(held: dict) -> pa.RecordBatch:
        columns = zip(*((*key, *row) for key, row in held.items()), strict=True) if held else [[]] * 12
        types = [pa.string(), pa.int64(), pa.int64(), pa.bool_(), *[pa.int64()] * 8]
        names = [part.split()[0] for part in _ROLE.split(", ")]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)

    named = pages.select(host(F.col("url")).alias("host"), F.col("page_id").cast("bigint").alias("page_id"), "html")
    found = mapped(named.where("host IS NOT NULL"), read, _ROLE, 256)
    summed = found.groupBy("host", "token").agg(
        F.max("parent").alias("parent"), F.max("is_text").alias("is_text"), *(F.sum(c).alias(c) for c in _SUMMED)
    )
    return summed.where(F.col("pages") >= PAGES)


# Templates


def deduce(rows: list[dict]) -> tuple[list[list[int]], list[int], list[int]]:
    """From a host's frequent tokens: the valid classes, each in order, the texts that go, the elements that are menus."""
    known = {r["token"]: r for r in rows}
    if ROOT not in known:
        return [], [], []
    groups: dict[tuple, list[dict]] = {}
    for r in rows:
        groups.setdefault((r["pages"], r["n"], r["h1"], r["h2"]), []).append(r)
    root = known[ROOT]
    first = groups.pop((root["pages"], root["n"], root["h1"], root["h2"]))
    valid = [first] if len(first) >= LARGE else []
    template = {r["token"] for found in valid for r in found}

    def around(r: dict) -> int | None:
        """The innermost template element around a token."""
        above = r["parent"]
        while above is not None and above not in template:
            above = known[above]["parent"] if above in known else None
        return above

    # From frequent to rare, so that a class is nested in those before it.
    for _, found in sorted(groups.items(), reverse=True):
        if len(found) >= LARGE and not all(r["is_text"] for r in found):
            elements = {around(r) for r in found}
            if len(elements) == 1 and None not in elements:
                valid.append(found)
                template |= {r["token"] for r in found}
    texts = [r for found in valid for r in found if r["is_text"]]
    for marked, share in ((True, MARKED), (False, UNMARKED)):
        whole = root["marked"] if marked else root["chars"] - root["marked"]
        mine = [r for r in texts if (r["marked"] > 0) == marked]
        if sum(r["chars"] for r in mine) > share * whole:
            texts = [r for r in texts if (r["marked"] > 0) != marked]
    menus = [
        r["token"] for found in valid for r in found if not r["is_text"] and not r["marked"] and r["links"] > LINKS * r["chars"]
    ]
    classes = [[r["token"] for r in sorted(found, key=lambda r: (r["place"], r["token"]))] for found in valid]
    return classes, [r["token"] for r in texts], menus


def templates(found: DataFrame) -> DataFrame:
    """host, classes, texts, menus for the roles' hosts.

    A host's list is short: tokens on half of its pages or more are at most twice as many as a page has on average.
    """
    sizes = found.where(F.col("token") == ROOT).select(F.col("host").alias("of"), F.col("pages").alias("all_pages"))
    frequent = found.join(sizes, F.col("host") == F.col("of")).where(F.col("pages") >= SHARE * F.col("all_pages"))
    fields = ["token", "parent", "is_text", *_SUMMED]
    lists = frequent.groupBy("host").agg(F.collect_list(F.struct(*fields)).alias("rows"))

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [deduce(rows) for rows in batch["rows"].to_pylist()]
            columns = [pa.array([m[k] for m in made], t) for k, t in enumerate((_LISTS, _LIST, _LIST))]
            yield pa.RecordBatch.from_arrays([batch["host"], *columns], names=["host", "classes", "texts", "menus"])

    return mapped(lists, build, "host string, classes array<array<bigint>>, texts array<bigint>, menus array<bigint>", 64)


_LIST = pa.list_(pa.int64())
_LISTS = pa.list_(_LIST)


# Extraction


def main_text(html: str | None, classes: list[list[int]] = (), texts: list[int] = (), menus: list[int] = ()) -> str:
    """The page's main text, given its host's template."""
    page = parse(html)
    place: dict[int, int] = {}
    for k, token in enumerate(page.tokens):
        place.setdefault(token, k)
    template: set[int] = set()
    for tokens in classes:
        places = [place[t] for t in tokens if t in place]
        if all(a < b for a, b in zip(places, places[1:], strict=False)):
            template.update(tokens)
    gone, listed = template.intersection(texts), set(menus)
    slot: dict[int, int | None] = {}

    def slot_of(element: int) -> int | None:
        """The innermost template element around."""
        walked = []
        while element is not None and element not in slot and element not in template:
            walked.append(element)
            element = page.parents.get(element)
        found = slot.get(element, element)
        slot.update(dict.fromkeys(walked, found))
        return found

    left = [
        r for r in page.runs
        if r.verdict == KEEP and r.token not in gone and (r.region or slot_of(r.inside) not in listed)
    ]
    size = sum(len(r.text) for r in left)
    for region in (ARTICLE, MAIN, CONTENT):
        inside = [r for r in left if r.region >= region]
        if inside and (region > CONTENT or 2 * sum(len(r.text) for r in inside) >= size):
            left = inside
            break
    return " ".join(r.text for r in left)


def extracted(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of every row."""
    made = stored(templates(stored(roles(pages)))).withColumnRenamed("host", "of")
    held = F.aggregate("classes", F.size("texts") + F.size("menus"), lambda n, tokens: n + F.size(tokens))
    if (made.agg(F.sum(held)).first()[0] or 0) <= SMALL:
        made = F.broadcast(made)
    rows = pages.select("page_id", "url", "html", host(F.col("url")).alias("host"))
    joined = rows.join(made, F.col("host") == F.col("of"), "left")

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = [batch[c].to_pylist() for c in ("classes", "texts", "menus")]
            out = [main_text(h.as_py(), *(x or () for x in found)) for h, *found in zip(batch["html"], *lists, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch["page_id"], batch["url"], pa.array(out, pa.string()), pa.array(map(len, out), pa.int64())],
                names=["page_id", "url", "text", "n_chars"],
            )

    page_id = pages.schema["page_id"].dataType.simpleString()
    columns = joined.select("page_id", "url", "html", "classes", "texts", "menus")
    return mapped(columns, extract, f"page_id {page_id}, url string, text string, n_chars bigint", 256)
