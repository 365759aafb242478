import pytest

from tripkpi.llm import html_consensus as H

PAGE = '''<!doctype html><html><head><title>T &amp; x</title><script>if(a<b){"<div>"}</script></head><body class="has-sidebar post-12">
<header class="site-header"><h1>My Site</h1><ul class="menu"><li><a href="/">Home</a></li></ul></header>
<div id="cookie-notice">We use cookies.<button>OK</button></div>
<div class="layout"><div class="sidebar"><p>About me is a long text that goes on and on for quite some while here.</p></div>
<div class="post post-123"><h1>The   title</h1><p>First &lt;para&gt; with <b>bold</b> and<br>break.<div class="ad-slot">Buy now!</div><p>Second caf&eacute; &#8212; dash&nbsp;x.
<ul><li>one<li>two</ul><form><p>sub</p></form><blockquote>Quote text</blockquote><aside>Aside</aside><!-- <p>hidden</p> -->
<div class="share-buttons">Share this</div><span hidden>secret</span><p>Last para.</p></div>
<section id="comments"><h3>Comments</h3><article class="comment"><p>I disagree with all of this very strongly and at length, a very long
comment which is much longer than the article itself, really, it goes on, and on, and on, and on, for ever, to fool a score by length.</p></article></section></div>
<footer>&copy; 2020</footer></body></html>'''
TEXT = "The title\n\nFirst <para> with bold and break.\n\nSecond café — dash x.\n\none\n\ntwo\n\nQuote text\n\nLast para."


def test_article_without_its_surroundings():
    assert H.text_of(PAGE, None) == TEXT
    assert H.Page(PAGE).path(H.Page(PAGE).ranked()[0][1]) == "body.has-sidebar.post-#>div.layout>div.post.post-#"


@pytest.mark.parametrize("source, text", [
    (None, ""), ("", ""), ("   ", ""), ("just text &amp; more", "just text & more"), ("<p>plain <p>two<div>x", "plain\n\ntwo\n\nx"),
    ("<div class='a><p>x</p>", "x"), ("<script>only()</script>", ""), ("<p>a<!-- never closed <p>b", "a"), ("<nav>menu</nav>", ""),
    ("<article><header><h1>T</h1><p>By Z</p></header><p>Body text.</p><footer>tags</footer></article>", "T\n\nBody text."),
    ("<body><p><b>Open tags<br><p>next</body>", "Open tags\n\nnext"), ("<p>a &lt; b &#x41;&#66; &bogus; &amp</p>", "a < b AB &bogus; &"),
    ("<article>" + "<p>w</p>" * 3000 + "</article>", "\n\n".join(["w"] * 3000)), ("<div>" * 5000 + "deep" + "</div>" * 5000, "deep"),
])
def test_defined_cases(source, text):
    assert H.text_of(source, None) == text


def test_host_consensus_wins_over_a_page_of_its_own(spark):
    from conftest import with_clashes
    body = "<body><div class='main-{0}'><p>{1}</p></div><div class='extra'><p>{2}</p></div></body>"
    rows = [(i, f"http://WWW.site.example:80/{i}", body.format(i, "article words " * 30, "few")) for i in range(9)]
    rows += [(9, "http://www.site.example/9", body.format(9, "short article", "words beside it " * 40)),
             (10, None, body.format(10, "short article", "words beside it " * 40)), (11, "http://x.example", None), (12, "no url", "<p>t</p>"),
             (13, "http://www.site.example/13", "<body><div class='extra'><p>only this</p></div></body>"), (None, "http://x.example", "<p>u</p>")]
    df = with_clashes(spark.createDataFrame(rows + rows[:1], "page_id long, url string, html string").repartition(3))
    got = H.main_text(df).collect()
    assert len(got) == len(rows) + 1 and got[0].asDict().keys() == {"page_id", "url", "text", "n_chars"}
    text = {r.page_id: r.text for r in got}
    assert text[9] == "short article" and text[10].startswith("words beside") and text[11] == "" and text[12] == "t" and text[13] == "only this"
    assert text[None] == "u" and all(r.n_chars == len(r.text) for r in got)
    assert H.main_text(df.limit(0)).count() == 0


def test_pages_of_the_test_tables(spark, sf_small):
    """Against a plain model of their template: the blocks between <article> and </article>."""
    import html
    import re
    pages = spark.read.parquet(f"{sf_small}/pages.parquet")
    want = {}
    for r in pages.collect():
        inner = re.search(r"<article>(.*?)</article>", r.html, re.S)[1]
        blocks = re.split(r"</?(?:p|h1|b)>|</?div[^>]*>", inner.replace("<br>", " "))
        want[r.page_id] = "\n\n".join(x for x in (" ".join(html.unescape(b).split()) for b in blocks) if x)
    assert {r.page_id: r.text for r in H.main_text(pages).collect()} == want


@pytest.mark.parametrize("name", ["form-guide", "related-work", "share-price", "tasting-menu", "social-history", "cookie-recipe",
                                  "search-history", "banner-of-heaven", "alert_levels"])
def test_marking_words_beside_others_keep_their_text(name):
    page = f"<body><article><p>First words here.</p><div class='{name}'><p>Text of the block, which matters.</p></div></article></body>"
    assert H.text_of(page, None) == "First words here.\n\nText of the block, which matters."


@pytest.mark.parametrize("name", ["ad", "ad-slot", "share-buttons", "social_share-bar", "relatedPosts", "site-menu", "comments", "cookie-notice",
                                  "form-guide"])
def test_marked_blocks_go(name):
    inside = "<a href=/x>one of many links</a> <a href=/y>and another</a>" if name == "form-guide" else "Buy, share and log in."
    page = f"<body><article><p>First words here.</p><div class='{name}'>{inside}</div><p>Last words.</p></article></body>"
    assert H.text_of(page, None) == "First words here.\n\nLast words."


@pytest.mark.parametrize("page", [
    "<div>" * 60_000 + "deep" + "</div>" * 60_000, "<div class=a>x" * 50_000, "<span hidden>" * 50_000 + "x", "<span hidden>a</span>" * 50_000,
    "<p>a" * 60_000, "</div>" * 90_000 + "x", "<div>" * 30_000 + "</section>" * 50_000, "<article>w</article>" * 30_000,
    "<div>" * 30_000 + "<article>" * 30_000 + "x"])
def test_time_in_proportion_to_the_page(page):
    import time
    at = time.process_time()
    H.Page(page).ranked()
    H.text_of(page, "div")
    H.text_of(page, None)
    assert time.process_time() - at < 40
