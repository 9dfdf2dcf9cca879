import random
from html.parser import HTMLParser

from scorecast.llm import html_extract as h

LONG = "This is the long paragraph of the article and it has the words that are in a text of this kind."
PAGE = f"""<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style><script>var t="</p>";</script></head><body>
<header><h1>Site of the day</h1></header><nav><ul><li><a href="/a">A</a></li></ul></nav>
<div class="cookie-notice">We use cookies so that the site is the best for you and for all of us in the end</div>
<article><h1>Title &amp; more</h1><p>{LONG}<br>Second&nbsp;line &lt;b&gt;</p><p>Short.</p><div class="ad">Buy the thing that is in the box now or never</div>
<form><p>Name <input value="x"></p></form><p><b>Unclosed<p>Last</p><section id="comments"><p>I am a reader and this is what I have to say on the article</p></section></article>
<aside>Related: the next of the things that you are to read as well</aside><!-- <p>no</p> --><footer>&copy; it</footer></body></html>"""


def test_article():
    assert h.main_text(PAGE).split("\n") == ["Title & more", LONG + " Second line <b>", "Short.", "Unclosed", "Last"]


def test_page_without_article_element():
    page = PAGE.replace("<article>", '<div id="main">').replace("</article>", "</div>")
    assert h.main_text(page).split("\n") == ["Title & more", LONG + " Second line <b>", "Short.", "Unclosed", "Last"]


def test_names_are_one_vote():
    p = f"<p>{LONG}</p>"
    for page in (f'<article><div class="article-header"><h1>Title</h1>{p}</div>{p}</article>', f'<article><h1>Title</h1><section id="legal-history">{p}</section>{p}</article>',
                 f'<div id="main"><h1>Title</h1><div class="comment-period">{p}</div>{p}</div>', f'<div class="content with-sidebar side"><h1>Title</h1>{p}{p}</div>',
                 f'<div class="sidebar"><h1>Title</h1>{p}{p}</div>'):
        assert h.main_text(page).split("\n") == ["Title", LONG, LONG], page
    for name in ("ad", "ads-box", "ad_slot", "cookie-notice", "site-header", "post-comments", "comments", "sidebar-right", "newsletter-signup", "social-share"):
        assert h.main_text(f'<article>{p}</article><div class="{name}">{p}</div>') == LONG
        assert h.main_text(f'<div id="x">{p}</div><div class="{name}">{p}</div>') == LONG, name
    assert h.main_text(f'<article>{p}<div class="ad">{p}</div><section id="comments">{p}</section></article>') == LONG


def test_nothing_else_is_dropped():
    assert h.main_text(f"<article><p>{LONG} <math><mi>x</mi><mo>=</mo><mn>2</mn></math> and <button>this</button> &am<b>p;</b> it</p></article>") == f"{LONG} x=2 and this &amp; it"
    assert h.main_text("<p>" + "<title>x " * 20000) != ""


def test_against_a_walk_of_the_tree():
    """Random well-formed articles: every block's text, in page order, and
    nothing from outside."""
    rng = random.Random(2)
    words = "the of and in to storm river ship market people found under stone &amp; &lt;x&gt; caf&eacute; &#8212;".split()

    def inline(n):
        out = []
        for _ in range(n):
            w = rng.choice(words)
            out.append(rng.choice(["{}"] * 6 + ["<b>{}</b>", "<em class='side'>{}</em>", "<span id=nav>{}</span>", "<code>{}</code>"]).format(w))
        return rng.choice([" ", "\n  "]).join(out)

    class Walk(HTMLParser):
        def __init__(self):
            super().__init__()
            self.found, self.text, self.depth = [], "", 0

        def cut(self):
            if self.text.split() and self.depth:
                self.found.append(" ".join(self.text.split()))
            self.text = ""

        def handle_starttag(self, tag, attrs):
            if tag in h._BLOCK:
                self.cut()
            self.depth += tag == "article"

        def handle_endtag(self, tag):
            if tag in h._BLOCK:
                self.cut()
            self.depth -= tag == "article"

        def handle_data(self, data):
            self.text += data
    for _ in range(200):
        body = [f"<p>{inline(40)}</p>"]
        for _ in range(rng.randint(0, 8)):
            body.append(rng.choice([lambda: f"<p>{inline(rng.randint(1, 60))}</p>", lambda: f"<h2>{inline(3)}</h2>", lambda: f"<ul><li>{inline(9)}</li><li>{inline(2)}</li></ul>",
                                    lambda: f"<blockquote><p>{inline(20)}</p>{inline(5)}</blockquote>", lambda: f"<div class='wide'>{inline(12)}</div>",
                                    lambda: f"<table><tr><td>{inline(4)}</td><td>{inline(4)}</td></tr></table>"])())
        page = f"<html><body><nav>{inline(5)}</nav><article>{''.join(body)}</article><footer>{inline(30)}</footer></body></html>"
        walk = Walk()
        walk.feed(page)
        assert h.main_text(page).split("\n") == walk.found, page


def test_very_long_page():
    page = "<article>" + f"<p>{LONG}</p>" * 20_000 + "</article>"
    assert h.main_text(page) == "\n".join([LONG] * 20_000)


def test_broken_html():
    assert h.main_text(None) == h.main_text("") == h.main_text("   ") == h.main_text("<script>alert(1)") == ""
    assert h.main_text("just text &eacute;  <") == "just text é <"
    assert h.main_text('<div class="ad">x<article><p>in</article><p>out') == "in"
    assert h.main_text("<p>" * 5000 + "deep" + "<div>" * 5000) == "deep"


def test_second_pass():
    good, bad, open_ = (h.Block(LONG, 0, False, False, 1), h.Block("x", 0, True, False, 2), h.Block("Hm", 0, False, False, 1))
    assert h.settle([bad, open_, good], [-1, 0, 1]) == [False, True, True]
    assert h.settle([bad, open_._replace(home=3)], [-1, 0]) == [False, False]
    assert h.settle([open_], [0]) == [True]


def test_extract(spark):
    pages = spark.createDataFrame([(1, "u", PAGE, "old"), (1, "u", PAGE, "old"), (None, None, None, None)], "page_id long, url string, html string, text string")
    out = h.extract(pages)
    assert out.columns == ["page_id", "url", "html", "text"]
    rows = out.collect()
    assert sorted(len(r["text"]) for r in rows) == [0, len(h.main_text(PAGE)), len(h.main_text(PAGE))]
    assert h.extract(pages.limit(0)).count() == 0
