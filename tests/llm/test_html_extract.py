import difflib
import os
import random

import pytest

from keepsake.llm import html_extract

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body>
<nav><ul><li><a href="/a">Menu</a></li></ul></nav><header><div>Site <b>name</b></div></header><!-- <p>no</p> -->
<div class="ad-slot big">Buy</div><div id='cookie_bar'><div>We use</div> cookies</div>
<article class=post><header><h1>Ti<i>t</i>le &amp; more</h1></header><p>One&nbsp;two
three.<br>Four<p title="a>b">5 &lt; 6 &#8364;<script>x()</script>
<aside>aside</aside><form><input value=1>send</form><ul><li>item<li>next</ul>
<table><tr><td>cell</td><td>other</td></tr></table>
<section class="comments"><p>first!</p></section></article><div>outside</div><footer>&copy; me</footer>"""


def text_of(html):
    return html_extract.settled(html_extract.page_lines(html), None)[0]


def test_structure():
    assert text_of(PAGE) == "Title & more One two three. Four 5 < 6 € item next cell other"
    assert text_of(PAGE[: PAGE.index("next")]).endswith("item")
    assert text_of(None) == text_of("") == text_of("<p>  </p>") == ""
    assert text_of("just &amp; text < 5 <") == "just & text < 5 <"
    assert text_of("<p>a<b>b</b>c</p>d<div>e") == "abc d e"
    assert text_of("<p class='lead'>x</p><p class='comment-list'>y</p>") == "x"
    assert text_of("<p>" * 3000 + "deep" + "<i title='>" * 50).startswith("deep")


def test_names_of_furniture():
    inside = "<article><p>text</p>{}</article>"
    for gone in (
        '<div class="post-comments-area">x</div>', '<section id="reader-comments"><article>x</article></section>',
        '<div class="notice">x</div>', '<div role="complementary">x</div>', '<p hidden>x</p>', '<div class="ad ad-1">x</div>',
        '<div class="box"><article class="comment">x</article></div>',
    ):
        assert text_of(inside.format(gone)) == "text", gone
    for kept in ('<p class="share-price">x</p>', '<div class="entry-header"><h2>x</h2></div>', '<p id="shadow">x</p>'):
        assert text_of(inside.format(kept)) == "text x", kept
    shell = '<form id="f"><div class="sidebar-content"><div class="ad">buy</div><article>text</article></div></form>'
    assert text_of(shell) == "text"
    assert text_of('<section class="comments"><article>remark</article></section><p>text</p>') == "text"
    assert text_of('<article>text</article><aside><article>teaser</article></aside>') == "text"


def test_names_are_read_from_attributes_only():
    for kept in (
        '<p style="overflow:hidden">x</p>', '<p title="a hidden gem">x</p>', '<p data-hidden="no">x</p>', '<div data-id="ad">x</div>',
        '<p data-role="navigation">x</p>', '<p><a title="class = ad">x</a></p>', '<p title=\'id="ad"\' class=lead>x</p>',
        '<section id="discussion">x</section>', '<h2 id="related">x</h2>', '<section class="related"><h3>x</h3></section>',
        '<h2 class="share">x</h2>', '<p/hiddenish>x</p>',
    ):
        assert text_of(f"<article><p>text</p>{kept}<p>end</p></article>") == "text x end", kept
    for gone in (
        "<p HIDDEN>x</p>", "<p class = ad>x</p>", "<p data-x=1 hidden>x</p>", '<div id="ad" class="z">x</div>', "<![CDATA[x]]>",
        '<section class="comments">x</section>', '<ul class="related">x</ul>', "<?php x ?>",
    ):
        assert text_of(f"<article><p>text</p>{gone}<p>end</p></article>") == "text end", gone
    # A neighbour tells a section of the site from one of the article.
    lines = html_extract.page_lines('<article><p>a</p><section id="related">More stories</section></article>')
    other = html_extract.page_lines('<article><p>b</p><section id="related">More stories</section></article>')
    assert html_extract.settled(lines, other) == ("a", 1, 0) and html_extract.settled(lines, None)[0] == "a More stories"


def test_skipped_elements_without_end_tags():
    for html, left in (
        ('<article><p class="notice">ad <b>x</b><p>text</article>end', "text"),
        ('<article><p class="notice">ad<div>text</div></article>', "text"),
        ('<article>text<div><p class="notice">ad</div>more</article>', "text more"),
        ('<p class="notice">ad<article>text</article>', "text"),
        ('<article><ul><li class="ad">ad<ul><li>ad</ul>ad<li>text<li class="ad">ad</ul>more</article>', "text more"),
        ('<article><ul><li class="ad"><p>ad<div>ad</div></p>ad</b></li>text</ul></article>', "text"),
        ('<article><ul><li>a<p class="notice">ad<li>b</ul></article>', "a b"),
        ('<article><dl><dt class="ad">ad<dd>a<dd class="ad">ad<dt>b</dl>c</article>', "a b c"),
        ('<article><table><tr class="ad"><td>ad<table><tr><td>ad</table>ad<tr><td>a<td class="ad">ad<th>b</table>c</article>', "a b c"),
        ('<article><table><tr><td class="ad">ad<tbody><tr><td>a</table></article>', "a"),
        ('<article><p class="notice">ad<script>var t="</article><div>";</script>ad<p>text</article>', "text"),
        ('<article><p class="notice">ad</p>text</article>', "text"),
    ):
        assert text_of(html) == left, html


def test_common_lines_are_a_longest_common_subsequence():
    rng = random.Random(3)
    for _ in range(300):
        a = [rng.choice("abcdef") for _ in range(rng.randint(0, 12))]
        b = [rng.choice("abcdef") for _ in range(rng.randint(0, 12))]
        best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                best[i + 1][j + 1] = best[i][j] + 1 if x == y else max(best[i][j + 1], best[i + 1][j])
        got = sorted(html_extract.common_lines(a, b))
        assert len(got) == best[-1][-1]
        rest = iter(b)
        assert all(a[k] in rest for k in got)
    assert difflib.SequenceMatcher(None, a, b).ratio() >= 0


def page(n, body, around=("Top line", "Bottom line")):
    return f"<html><body><div>{around[0]}</div>{body}<div>{around[1]}</div></body></html>"


def expected(rows):
    """Pages sorted by host and path, each with the nearer of the pages beside it that differ."""
    hosts = {}
    for page_id, url, html in rows:
        rest = (url or "").partition("://")[2]
        host, _, path = rest.partition("/")
        lines = html_extract.page_lines(html)
        key = ("/" + path if rest else "", page_id is not None, page_id or 0, url or "", html_extract._packed(lines))
        hosts.setdefault(host, []).append((key, page_id, url, lines))
    out = []
    for pages in hosts.values():
        pages.sort(key=lambda p: p[0])
        for n, (key, page_id, url, lines) in enumerate(pages):
            before = next((q for q in reversed(pages[:n]) if q[0][4] != key[4]), None)
            after = next((q for q in pages[n:] if q[0][4] != key[4]), None)
            same = [len(os.path.commonprefix([key[0], q[0][0]])) if q else -1 for q in (before, after)]
            near = after if same[1] > same[0] else before
            text, *counts = html_extract.settled(lines, near and near[3])
            out.append((page_id, url, text, len(text), *counts))
    return sorted(out, key=repr)


@pytest.mark.parametrize("parts", [1, 9])
def test_furniture_is_what_neighbours_share(spark, parts):
    rng = random.Random(6)
    rows = []
    for n in range(60):
        site = f"h{rng.choice('aaab')}.org"
        body = "".join(f"<p>line {rng.randint(0, 30)}</p>" for _ in range(rng.randint(0, 6)))
        rows.append((n, f"http://{site}/p{rng.randint(0, 9)}/{n % 7}", page(n, body)))
    rows += [(100 + n, "http://ha.org/p5/copy", page(0, "<p>same</p>")) for n in range(40)]
    rows += [(200 + n, "http://only.org/x", page(0, "<p>alone</p>")) for n in range(3)]
    rows += [(300, None, page(0, "<p>lost</p>")), (301, "no scheme", None), (None, "http://ha.org/p5", ""), (302, "http://z.org/", PAGE)]
    rows += [rows[0]]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("host", html_extract.F.lit(1))
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        got = sorted((tuple(r) for r in html_extract.extract(df).collect()), key=repr)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", 8)
    assert got == expected(rows)


def test_text_beside_an_article_stays_unless_shared(spark):
    rows = [(n, f"http://a.org/{n}", page(n, f"<p>body {n}</p><article>teaser</article>")) for n in range(4)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r["page_id"]: r["text"] for r in html_extract.extract(df).collect()}
    assert got == {n: f"body {n} teaser" for n in range(4)}


def made_pages(rng, hosts, pages):
    """Pages put together from parts, with the text that a reader would call the article."""
    words = lambda n: " ".join("".join(rng.choice("abcdefghiklmnoprstu") for _ in range(rng.randint(2, 9))) for _ in range(n))
    rows = []
    for h in range(hosts):
        menu = "".join(f"<li><a href='/{k}'>{words(2)}</a></li>" for k in range(4))
        notice, legal, brand = words(6), words(5), words(2)
        boxed = words(4)  # a box without any telling name, on all pages of the host
        for n in range(pages):
            title, body = words(4), [words(rng.randint(5, 30)) for _ in range(rng.randint(1, 5))]
            kind = rng.randrange(3)
            mains = [f"<h1>{title}</h1>", *(f"<p>{b}</p>" if k % 2 else f"<p>{b}" for k, b in enumerate(body))]
            inner = "".join(mains)
            article = (f"<article>{inner}</article>", f"<main><div>{inner}</div></main>", f"<div class='text'>{inner}</div>")[kind]
            remarks = f"<div class='comments'><p>{words(8)}</p></div>"
            advert = f"<div class='ad-slot'>{words(3)}</div>"
            html = (
                f"<html><head><title>{title}</title></head><body><div class='masthead'>{brand}</div><nav><ul>{menu}</ul></nav>"
                f"<div class='cookie-notice'>{notice}</div><div class='x1'>{boxed}</div>{advert}{article}{remarks}"
                f"<div class='site-footer'>{legal}</div></body></html>"
            )
            rows.append((len(rows), f"http://h{h}.org/{rng.choice('abc')}/{n}", html, " ".join([title, *body])))
    return rows


def test_made_pages_give_back_their_articles(spark):
    """The expected text is known from how the page was made, without any code of the extraction."""
    rows = made_pages(random.Random(12), 6, 15)
    df = spark.createDataFrame([r[:3] for r in rows], "page_id long, url string, html string")
    out = {r["page_id"]: r for r in html_extract.extract(df.repartition(3)).collect()}
    assert {n: r["text"] for n, r in out.items()} == {r[0]: r[3] for r in rows}
    # Masthead, notice, nameless box and footer are told by the neighbour; advert and remarks, never shared, by name.
    assert {(r["shared_lines"], r["named_lines"]) for r in out.values()} == {(4, 2)}


def test_the_nearer_page_counts(spark):
    """By the page before, /a, the shared line would stay; the page after has the longer common path."""
    rows = [(0, "http://h/a", "<div>one</div><p>x</p>"), (1, "http://h/b/c1", "<div>two</div><p>y</p>"),
            (2, "http://h/b/c2", "<div>two</div><p>z</p>")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r["page_id"]: r["text"] for r in html_extract.extract(df).collect()}
    assert got == {0: "one x", 1: "y", 2: "z"}


def test_nothing(spark):
    empty = spark.createDataFrame([], "page_id long, url string, html string")
    assert html_extract.extract(empty).count() == 0
