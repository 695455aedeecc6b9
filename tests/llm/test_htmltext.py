import re
from collections import defaultdict

from trovespark.llm import htmltext
from trovespark.llm.htmltext import Page


def test_article_of_a_page():
    page = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body><nav><ul><li><a href="/a">a</a></li></ul></nav>
    <!-- ad --><div class="ad">Buy</div><article><header><h1>Head &amp; more</h1><p>by me</p></header><p><b>One<br><p>Two&nbsp; x<b>y</b>z &copy;</p><div class="share">tweet</div>
    <aside>side</aside><ul><li>i<li>j</ul><form>f</form></article><section id="comments"><p>nice</p></section><footer>&copy; host</footer></body></html>"""
    assert Page(page).text() == "Head & more One Two xyz © i j"


def test_odd_sources():
    assert Page("").text() == "" and Page("plain  text\n only").text() == "plain text only"
    assert Page("<p>a < b <c d='>'>x</c> &lt;t&gt;").text() == "a < b x <t>"
    assert Page("<p>a<script>never closed").text() == "a"
    assert Page('<div class="sidebar-left"><p>x</p></div><div class="with-sidebar"><main><p>m</p></main></div>').text() == "m"
    assert Page("<table><tr><td>1<td>2<tr><td>3</table>").text() == "1 2 3"
    assert Page("a<!-- x").text() == "a" and Page("a<!DOCTYPE").text() == "a" and Page("<").text() == "<"
    assert Page("<p hidden>h</p><p style='display: none'>n</p>v").text() == "v"
    Page("<div>" * 20_000 + "x").text()
    Page('<a "' * 50_000).text()
    Page("<p>" * 100_000).text()


def site(i, article, extra=""):
    return f"<html><body><div><a href=/>Home</a> <a href=/x>News</a></div><div><p>{article}</p></div><div>All rights kept</div>{extra}</body></html>"


def host_of(url):
    m = re.match(htmltext.HOST, url or "")
    return m[1].lower() if m else ""


def brute(rows, min_pages, min_share):
    bodies, seen = defaultdict(set), defaultdict(set)
    for _, url, source in rows:
        page = Page(source or "")
        host = host_of(url)
        bodies[host].add(page.body)
        for h in page.subtrees():
            seen[host, h].add(page.body)
    out = []
    for i, url, source in rows:
        host = host_of(url)
        held = {h for (k, h), b in seen.items() if k == host and len(b) >= max(min_pages, min_share * len(bodies[host]))}
        text = Page(source or "").text(held)
        out.append((i, url, text, len(text)))
    return sorted(out, key=str)


def test_templates_go_and_copies_do_not_make_one(spark):
    rows = [(i, f"http://User@A.example.com:80/{i}?x", site(i, f"story {i} of the day")) for i in range(12)]
    rows += [(100 + i, "https://b.example.com/", site(0, "the same story")) for i in range(20)]
    rows += [(200, None, None), (201, "nonsense", "<p>x"), (200, None, None), (None, "http://c.example.com", "<p>y</p>")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "1 as text", "2 as HTML")
    want = brute(rows, 5, 0.1)
    for few in (htmltext.BROADCAST_HASHES, 0):
        got = sorted(map(tuple, htmltext.extract(df, broadcast_hashes=few).collect()), key=str)
        assert got == want
    texts = {i: t for i, _, t, _ in want}
    assert texts[3] == "story 3 of the day" and texts[105] == "Home News the same story All rights kept" and texts[200] == ""
    assert htmltext.extract(df.limit(0)).count() == 0


def test_blocks_on_few_pages_of_a_large_host_go(spark):
    menu = "<div><a href=/s>Section</a> one two</div>"
    rows = [(i, f"http://big.example.com/{i}", site(i, f"story {i} of the day", menu if i < 6 else "")) for i in range(100)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    for few in (htmltext.BROADCAST_HASHES, 0):
        got = {r.page_id: r.text for r in htmltext.extract(df, broadcast_hashes=few).collect()}
        assert got == {i: f"story {i} of the day" for i in range(100)}


PARAGRAPH = "Words of an article that go on for a while, with names, places and dates in them."


def test_words_in_names_of_article_blocks_do_not_delete_them():
    for name in ("related-work", "social-history", "search-results", "share-prices", "reply-letter", "notice"):
        page = f'<html><body><nav>menu</nav><article><h1>Head</h1><div class="{name}"><p>{PARAGRAPH}</p></div></article></body></html>'
        assert Page(page).text() == f"Head {PARAGRAPH}", name
    for name in ("share", "related", "sidebar-left", "site-footer", "cookie-notice", "ad top", "comments", "user-comments", "related-posts", "share-buttons"):
        page = f'<html><body><article><h1>Head</h1><p>{PARAGRAPH}</p><div class="{name}"><p>Other</p></div></article><div class="{name}">Else</div></body></html>'
        assert Page(page).text() == f"Head {PARAGRAPH}", name


def test_names_of_what_stands_beside():
    for name in ("has-sidebar", "no-footer", "with-comments", "menu-du-jour", "search-results", "ad-hoc"):
        assert not htmltext.names_a_side_block(name), name


def test_teaser_articles_are_not_the_page():
    page = f"<html><body><header><p>Site</p></header><div><p>{PARAGRAPH}</p><p>{PARAGRAPH}</p></div><article>Read more</article></body></html>"
    assert Page(page).text() == f"{PARAGRAPH} {PARAGRAPH} Read more"
    page = f"<html><body><main><h1>Head</h1><p>{PARAGRAPH}</p><article><p>{PARAGRAPH} two</p></article></main><div>left over</div></body></html>"
    assert Page(page).text().startswith(PARAGRAPH[:5]) or Page(page).text().startswith("Head")


def test_hand_labelled_pages(spark):
    """Whole texts written by hand, of a site whose menu, notice and prose boilerplate say nothing by name."""
    def page(i):
        own = f"<h1>Story {i}</h1><p>{PARAGRAPH} Number {i}.</p><blockquote>A quote that {'two' if i < 2 else 'one'} share{' ' * (i > 1)}{i if i > 1 else ''}</blockquote>"
        return f'<html><head><title>t</title></head><body><div><a href="/">Home</a> <a href="/n">News</a></div><article>{own}<p>Write to us if you like this story.</p></article><div>We use cookies on this site.</div><section><h2>What readers say</h2><p class="comment">nice {i}</p></section></body></html>'

    rows = [(i, f"https://site.example/{i}", page(i)) for i in range(30)]
    want = {i: f"Story {i} {PARAGRAPH} Number {i}. A quote that two share" if i < 2 else f"Story {i} {PARAGRAPH} Number {i}. A quote that one share {i}" for i in range(30)}
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    for few in (htmltext.BROADCAST_HASHES, 0):
        assert {r.page_id: r.text for r in htmltext.extract(df, broadcast_hashes=few).collect()} == want
