"""Extraction: planted templates, a plain version with whole occurrence vectors, hard cases."""

import html
import random
import re
import time

import duckdb
import pytest
from pyspark.sql import functions as F

from perigee.llm import extraction, queries
from tests.llm.test_queries import MEDIUM

WORDS = [f"{a}{b}" for a in "ba ke li mo nu ra se ti vo za".split() for b in "n r s t l m d k p g".split()]


def prose(rng, n):
    return " ".join(rng.choices(WORDS, k=n)).capitalize() + "."


def site(rng, name, k):
    """A page of a site without telling names: a varying menu, a notice, a promotion on two of three pages, the story."""
    article = [prose(rng, rng.randint(30, 60)) for _ in range(rng.randint(2, 5))]
    menu = "".join(f'<li><a href="/{k}">{prose(rng, 2)}</a></li>' for _ in range(rng.randint(4, 7)))
    promo = "<section class='x9'><h3>More for you</h3><div>Try our plans today</div><div>Call us</div></section>" if k % 3 else ""
    story = "".join(f"<p>{html.escape(p)} <b>so</b><i>what</i>" for p in article)
    page = f"""<!doctype html><html><head><title>T{k}</title></head><body><div class="x1"><ul class="x2">{menu}</ul></div>
      <div class="x3">We store what you choose on {name}.</div>{promo}
      <div class="x4">{story}</div><div class="x5">All rights with {name}</div></body></html>"""
    return page, " ".join(f"{p} sowhat" for p in article)


def plain(rows):
    """The main texts by page, from occurrence vectors held whole."""
    by_host = {}
    for k, (_, url, text) in enumerate(rows):
        found = re.match(r"(?i)[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", url or "")
        if found:
            by_host.setdefault(found[1].lower(), []).append((k, text))
    made = {}
    for pages in by_host.values():
        roles, vectors = {}, {}
        for k, text in pages:
            held = {}
            extraction._occurrences("h", k, text, held)
            for (_, token), values in held.items():
                row = dict(zip(["parent", "is_text", *extraction._SUMMED], values, strict=True))
                vectors.setdefault(token, {})[k] = row["n"]
                old = roles.setdefault(token, row | dict.fromkeys(extraction._SUMMED, 0))
                for name in extraction._SUMMED:
                    old[name] += row[name]
        numbers = {}
        for token, row in roles.items():
            vector = tuple(sorted(vectors[token].items()))
            row.update(token=token, h1=numbers.setdefault(vector, len(numbers)), h2=0)
        n = roles[extraction.ROOT]["pages"]
        often = [r for r in roles.values() if r["pages"] >= max(extraction.PAGES, extraction.SHARE * n)]
        template = extraction.deduce(often)
        made.update({k: extraction.main_text(text, *template) for k, text in pages})
    return [made.get(k, extraction.main_text(text)) for k, (_, _, text) in enumerate(rows)]


def pages_of(spark, rows):
    return spark.createDataFrame(rows, "page_id bigint, url string, html string").repartition(3)


def texts(df):
    found = df.collect()
    assert all(r["n_chars"] == len(r["text"]) for r in found)
    return sorted(((r["page_id"], r["url"], r["text"]) for r in found), key=str)


def test_template_of_sites_without_names(spark):
    rng = random.Random(7)
    rows, want = [], []
    for s in range(3):
        for k in range(12):
            page, text = site(rng, f"site{s}", k)
            rows.append((len(rows), f"https://www.site{s}.example/{k}", page))
            want.append(text)
    found = extraction.extracted(pages_of(spark, rows))
    assert texts(found) == sorted(((i, u, t) for (i, u, _), t in zip(rows, want, strict=True)), key=str)
    assert plain(rows) == want


def test_named_parts_go():
    page = """<html><head><title>no</title><style>p{}</style></head><body class="home has-sidebar">
      <header class="site-header"><h2>Site</h2></header><nav>menu</nav>
      <div id="cookie-notice">We use cookies</div>
      <main><article class="post with-ads"><header><h1>A &amp; B</h1><p>by me</p></header>
      <p>One&nbsp;two<br>three <span class="ad">buy</span><a href="x">four</a>, fi<b>v</b>e <script>var a = "</p><p>";</script>
      <table><tr><td>six<td>seven<tr><td>eight</table>
      <aside>aside</aside><form>form<input type="text"><button>go</button></form><div class="share-links">share</div>
      <p hidden>hidden</p><!-- a <p>comment</p> --><ul><li>nine<li>1 &lt; 2 < 3</ul>
      <div class="newsletter">sign</div></article>
      <section id="comments"><article class="comment">first!</article></section></main>
      <div class="related">more</div><footer>&copy; foot</footer></body></html>"""
    assert extraction.main_text(page) == "A & B One two three four, five six seven eight nine 1 < 2 < 3"


def test_regions_and_cut_pages():
    main = extraction.main_text
    assert main("<div>outside</div><article><p>in one</article><article><h2>in two</h2>") == "in one in two"
    assert main("<div>outside</div><div role=main>inside <b>bold") == "inside bold"
    assert main("<p>outside</p><div class='entry-content'>most of the text is here</div>") == "most of the text is here"
    assert main("<p>most of the text is out here</p><div class='content'>some</div>") == "most of the text is out here some"
    assert main("plain text only") == "plain text only"
    assert main("<article>open <script>never closed") == "open" and main("<article>a<!-- never closed") == "a"
    assert main("<article>a<p class='cut") == "a" and main("<article><p>a</nav></div>b</p>c") == "a b c"
    assert main(None) == main("") == main("<nav>x</nav>") == main("<") [:0] == ""


@pytest.mark.parametrize("small", [extraction.SMALL, 0])
def test_hard_cases_equal_the_plain_version(spark, monkeypatch, small):
    """With templates broadcast and joined."""
    monkeypatch.setattr(extraction, "SMALL", small)
    rng = random.Random(3)
    copy, _ = site(rng, "one", 1)
    rows = [(k, "http://copies.example/x", copy) for k in range(20)] + [(5, "http://copies.example/x", copy)] * 2
    rows += [(100 + k, "http://user@Mixed.Example:80/a?b", site(rng, "mixed", k)[0]) for k in range(8)]
    rows += [(200 + k, None, site(rng, "none", k)[0]) for k in range(8)] + [(300, "no url", "<p>x"), (None, "http://mixed.example/", "<p>own")]
    rows += [(400 + k, "http://short.example/", site(rng, "short", k)[0]) for k in range(4)]
    rows += [(500, "http://mixed.example/n", None), (501, "http://mixed.example/e", ""), (502, "http://mixed.example/w", " \n ")]
    rows += [(600, "http://long.example", "<div>" * 20_000 + "deep " + "<p>para <b>x</b>" * 50_000)]
    table = pages_of(spark, rows).select("*", *(F.lit(1).alias(c) for c in ("host", "of", "classes", "texts", "menus", "text")))
    started = time.time()
    found = texts(extraction.extracted(table))
    assert time.time() - started < 60
    assert found == sorted(((i, u, t) for (i, u, _), t in zip(rows, plain(rows), strict=True)), key=str)
    # Copies of one page alone are no template of their article.
    assert all(len(t) > 300 for i, u, t in found if u == "http://copies.example/x")


def test_copies_do_not_empty_an_article(spark):
    """A third of a host's pages are one article under varying menus: marked, it stays."""
    rng = random.Random(4)
    same = f"<h1>{prose(rng, 5)}</h1><table><tr><td>{prose(rng, 40)}</td></tr></table><p>{prose(rng, 50)}</p>"
    rows = []
    for k in range(30):
        own = same if k % 3 == 0 else f"<h1>{prose(rng, 5)}</h1><p>{prose(rng, 90)}</p>"
        rows.append((k, "http://a.example/", f"<body><nav>{prose(rng, 6)}</nav><article>{own}</article><footer>f</footer>"))
    found = {i: t for i, _, t in texts(extraction.extracted(pages_of(spark, rows)))}
    want = " ".join(re.sub("<[^>]*>", " ", same).split())
    assert all((found[k] == want) == (k % 3 == 0) for k in range(30))


def test_empty_table(spark):
    assert extraction.extracted(pages_of(spark, []).limit(0)).collect() == []


def test_invalid_classes():
    """Classes of texts alone, small ones, and those that don't nest in one place are no template."""

    def row(token, parent, is_text, vector, place, pages=10):
        sums = {"pages": pages, "n": pages, "h1": vector, "h2": 0, "place": place, "chars": 0, "links": 0, "marked": 0}
        return {"token": token, "parent": parent, "is_text": is_text} | sums

    root = [row(extraction.ROOT, None, False, 1, 0), row(2, extraction.ROOT, False, 1, 1), row(3, extraction.ROOT, False, 1, 2)]
    nested = [row(4, 3, False, 2, 5, 8), row(5, 4, False, 2, 6, 8), row(6, 5, True, 2, 7, 8)]
    apart = [row(7, 2, False, 3, 5, 7), row(8, 3, False, 3, 6, 7), row(9, 8, True, 3, 7, 7)]
    prose_only = [row(20 + k, 3, True, 4, k, 6) for k in range(4)]
    small = [row(30, 3, False, 5, 3, 6), row(31, 30, True, 5, 4, 6)]
    classes, _, _ = extraction.deduce(apart + small + nested + prose_only + root)
    assert classes == [[extraction.ROOT, 2, 3], [4, 5, 6]]


def test_query_keeps_whole_articles(spark):
    """The pages' articles, cut out by their plain marks."""
    rows = duckdb.sql(f"SELECT page_id, url, html FROM '{MEDIUM}/pages.parquet'").fetchall()

    def article(text):
        inside = re.search(r"<article>(.*?)(</article>|<footer>|$)", text, re.S)[1]
        return " ".join(html.unescape(re.sub("</?b>", "", re.sub("</?(p|h1|br)>", " ", inside))).split())

    found = texts(queries.op12_extraction(spark, MEDIUM))
    assert found == sorted(((i, u, article(t)) for i, u, t in rows), key=str)


@pytest.mark.parametrize("piece", ['<a title="x', "<!--", "<div ", "&#", "</", "<b></a>"])
def test_time_grows_with_the_length(piece):
    def seconds(n):
        started = time.perf_counter()
        extraction.main_text(piece * n)
        return time.perf_counter() - started

    seconds(10)
    assert seconds(40_000) < 5
