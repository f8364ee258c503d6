"""Main text extraction on small pages, and on the test pages against a plain reading of their layout."""

import re
from html import unescape

from headway.llm import htmltext

PAGE = """<html><body><header><h1>Site</h1></header><div id="cookie-banner">We use cookies</div><div class="layout"><aside>Side</aside>
<main><article class="post"><header><h1>T &amp; U</h1></header><p>One <i>two</i>
three<br>four<ul><li>a<li>b</ul><p>x<table><tr><td>1<td>2<tr><td>3</table><div class="share">Share</div><pre>a
 b</pre><section id="comments"><article class="comment">bad</article></section><footer>foot</footer></article></main><form>f</form></div></body></html>"""


def test_layout():
    assert htmltext.main_text(PAGE) == "T & U\n\nOne two three four\n\na\n\nb\n\nx\n\n1\n\n2\n\n3\n\na b"
    assert htmltext.main_text("plain <b>text</b> &lt;x&gt; <div>more") == "plain text <x>\n\nmore"
    assert htmltext.main_text("<p>a</p><!-- x") == "a"
    assert htmltext.main_text("<script>var t='</p>'; if (a<b) x()</script><p>ok</p><style>p{}") == "ok"


BODY = "<h1>Head</h1><p>" + "Words of the article. " * 20 + "</p><p>More of it, at some length.</p>"
SAYS = "Head\n\n" + ("Words of the article. " * 20).strip() + "\n\nMore of it, at some length."
NAMED = [
    "<article class='post share-enabled'>{}</article>", "<div class='content no-sidebar'>{}</div>", "<div class='entry comment-status-open'>{}</div>", "<div id='main-menu-page'><article>{}</article></div>",
    "<div class='social-text'>{}</div>", "<article><div class='social-text'>{}</div></article>", "<form id='aspnet'><div>{}</div></form>", "<form><article>{}</article></form>", "<div class='has-ads'><main>{}</main></div>",
    "<div class='search'><article>{}</article></div>", "<div role='dialog'>{}</div>", "<form><fieldset>{}</fieldset></form>",
]


def test_names_do_not_delete_the_article():
    other = "<div class='site-footer'>foot</div><div id='cookie-banner'>We use cookies</div><ul class='nav-links'><li>Home</li></ul><div class='sidebar-left'>side</div><form>Mail <input></form>"
    for layout in NAMED:
        assert htmltext.main_text(f"<body>{other}{layout.format(BODY)}{other}</body>") == SAYS, layout
    for name in ("related-posts", "share-buttons", "comments-area", "adSlot2", "newsletter-box"):
        assert htmltext.main_text(f"<article>{BODY}<div class='{name}'>x y z</div></article>") == SAYS, name
    # a menu is mostly links, however long it is
    menu = "".join(f"<li><a>Entry {k} of a long menu</a></li>" for k in range(200))
    assert htmltext.main_text(f"<body><div class='nav'><ul>{menu}</ul></div><div>{BODY}</div></body>") == SAYS
    # reader comments go however long they are
    assert htmltext.main_text(f"<article>{BODY}<section id='comments'>{'<p>So do I.</p>' * 500}</section></article>") == SAYS


def test_inline_elements_in_sentences_stay():
    assert htmltext.main_text("<article><p>We look for <span class='search'>gold <b class='share'>here</b></span> today.</p><p><a class='share'>Share</a></p></article>") == "We look for gold here today."
    assert htmltext.main_text("<article><p>Seen <span hidden>not </span>here.</p></article>") == "Seen here."


def test_deep_and_long():
    assert htmltext.main_text("<div>" * 20_000 + "deep" + "</div>" * 20_000) == "deep"
    assert htmltext.main_text("<p>" + "word " * 200_000) == ("word " * 200_000).strip()
    assert htmltext.main_text('<a href="' * 3000) is not None


def test_templates_are_deleted_per_host(spark):
    body = lambda k: f"<div><div><a>Alpha</a><span>Beta</span></div><p>Text of page {k}.</p><p>Shared words.</p></div>"
    rows = [(k, f"http://a.example/{k}", body(k), "x") for k in range(8)] + [(100 + k, f"http://b.example/{k}", body(k), "x") for k in range(2)]
    copies = [(200 + k, f"http://c.example/{k}", "<article><div><p>Same</p></div></article>", "x") for k in range(30)]
    edge = [(None, None, None, None), (300, None, body(3), "y"), (301, "", "", "z"), (302, "no host", "<p>t", "z"), (0, "http://a.example/0", body(0), "x")]
    df = spark.createDataFrame(rows + copies + edge, "page_id long, url string, html string, text string")
    got = {}
    for r in htmltext.extract(df).collect():
        got.setdefault(r.page_id, []).append(r.text)
    assert got[3] == ["Text of page 3."]
    assert got[0] == ["Text of page 0."] * 2
    assert got[101] == ["AlphaBeta\n\nText of page 1.\n\nShared words."]
    assert got[205] == ["Same"]
    assert got[None] == [""] and got[301] == [""] and got[302] == ["t"]
    assert got[300] == ["AlphaBeta\n\nText of page 3.\n\nShared words."]
    assert htmltext.extract(df.limit(0)).count() == 0


def test_templates_inside_articles(spark):
    """Only counts can tell these blocks from the article: no tag, role or class speaks."""
    news, links, quote, boxed = "<div class='x7'><p>Get our letter.</p></div>", "<ul><li><a>One</a></li><li><a>Two</a></li></ul>", "<p>A shared passage.</p>", "<div><p>A boxed passage.</p></div>"
    own = lambda k: f"<p>Text of page {k} " + f"word{k} " * 20 + "</p>"
    plain = lambda k: f"Text of page {k} " + " ".join([f"word{k}"] * 20)
    page = lambda k: f"<body><article><h1>T{k}</h1>{own(k)}{quote}{boxed if k < 2 else ''}{links}<section>{'<p>x</p>' * (k % 7)}{boxed}{'<p>y</p>' * (k % 5)}</section>{news}</article></body>"
    copy = lambda k: f"<body><article><h1>T{k}</h1><div><p>The same body, on every page, with nothing of its own.</p></div><div><p>Short.</p></div></article></body>"
    alone = f"<body><article>{news}</article></body>"
    rows = [(k, f"http://a.example/{k}", page(k)) for k in range(20)] + [(100 + k, f"http://b.example/{k}", copy(k)) for k in range(20)]
    rows += [(200 + k, f"http://c.example/{k}", page(k)) for k in range(4)] + [(300, "http://a.example/alone", alone)]
    got = {r.page_id: r.text for r in htmltext.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    for k in range(20):
        want = [f"T{k}", plain(k), "A shared passage.", *["A boxed passage."] * (k < 2), *["x"] * (k % 7), "A boxed passage.", *["y"] * (k % 5)]
        assert got[k] == "\n\n".join(want)
        assert got[100 + k] == f"T{k}\n\nThe same body, on every page, with nothing of its own.\n\nShort."
    assert "Get our letter." in got[200] and "One" in got[200] and got[300] == "Get our letter."


WORDS = "eins zwei drei vier fünf sechs sieben acht neun zehn elf zwölf".split()


def layouts(k):
    """Pages without marked articles, with class names of no known language; only counts tell their templates."""
    own = [f"Absatz {k} {n} " + " ".join(f"{w}{k}" for w in WORDS) + "." for n in range(3)]
    text = "".join(f"<p>{x}</p>" for x in own)
    yield f"<body><div class='kopf'><a>Start</a> <a>Themen</a></div><div class='inhalt'>{text}</div><div class='fuss'><p>Impressum und mehr.</p></div></body>", "\n\n".join(own)
    yield f"<table><tr><td><ul><li><a>Eins</a><li><a>Zwei</a></ul></td><td>{text}</td></tr></table><table><tr><td>Unten</td></tr></table>", "\n\n".join(own)
    promo = "<div class='q'><article><p>" + "Große Werbung. " * 60 + "</p></article></div>"
    yield f"<body>{promo}<article>{text}</article></body>", "\n\n".join(own)


def test_only_counts_can_tell(spark, monkeypatch):
    rows, want = [], {}
    for layout in range(3):
        # small hosts too, where no block has MIN_PAGES pages, but for recurring articles
        for size in (4, 12) if layout < 2 else (12,):
            for k in range(size):
                page_id = 1000 * layout + 100 * size + k
                page, text = list(layouts(k))[layout]
                rows.append((page_id, f"http://l{layout}s{size}.example/{k}", page))
                want[page_id] = text
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    assert {r.page_id: r.text for r in htmltext.extract(df).collect()} == want
    # without the counts no page comes out right
    assert all(htmltext.main_text(page) != want[page_id] for page_id, _, page in rows)


def test_columns_with_the_names_of_inner_ones_stay(spark):
    names = ["_k1", "_k2", "_host", "_gone", "host", "own", "hashes", "inner", "k1"]
    df = spark.createDataFrame([(1, "http://a.example/1", "<p>x</p>", *names)], ["page_id", "url", "html", *names])
    (r,) = htmltext.extract(df).collect()
    assert r.text == "x" and all(r[n] == n for n in names)


def test_pages_table(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    rows = htmltext.extract(df).collect()
    assert len(rows) == df.count()
    for r in rows:
        article = re.search(r"<article>(.*)</article>", r.html, re.S)[1]
        parts = re.split(r"</?(?:p|h1|h2|h3|ul|li|div|table|tr|td|blockquote|pre)\b[^>]*>", article)
        plain = (" ".join(unescape(re.sub(r"<[^>]+>", "", p.replace("<br>", " "))).split()) for p in parts)
        assert r.text == "\n\n".join(p for p in plain if p)
