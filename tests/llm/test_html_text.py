from __future__ import annotations

import pytest

from tillroll.llm import html_text as h

ARTICLE = (
    "<html><head><title>No</title><style>p{}</style><script>var a='</p><p>no';</script></head><body>"
    "<nav><ul><li><a href=/a>Home</a></li><li><a href=/b>News of the day and more</a></li></ul></nav>"
    "<div class='ad'>Buy this fine thing now and save a lot</div><article><h1>The &amp; title</h1>"
    "<p>First  para\n with <b>bold</b>ness &lt;ok&gt;.<br>Next<p>Second &#233;t&eacute; one.</p></article>"
    "<div class=odd>Unknown box of words below the story</div><footer>&copy; someone</footer></body></html>"
)
WANT = "The & title First para with boldness <ok>. Next Second été one."
PLAIN = (
    "<body><header><h1>Site name</h1></header><div class='cookie-notice'>We use cookies here</div><div id=content>"
    "<h2>A real headline</h2><p>Words of the story that go on for a while, as they do.</p><div class=ad>Buy now</div>"
    "<ul><li>one thing</li><li>another thing</li></ul><form><label>Mail</label><button>Go</button></form>"
    "<p>The end of it all, at last.</p></div><aside>See also</aside><section class='comments'><article><p>First! Great "
    "story, thanks for sharing it with us</p></article></section><footer>Imprint</footer></body>"
)


@pytest.fixture(scope="module")
def pages(spark, store):
    rows = [(i, f"u{i}", ARTICLE, "clash", 1) for i in range(20)]
    rows += [(50, "p", PLAIN, None, None), (51, None, None, None, None), (52, "e", "", None, None), (None, "x", "<p>one", None, 3)]
    rows += [(50, "p", PLAIN, None, None), (60, "l", "<p>word</p>" * 30000, None, None)]
    return store(spark.createDataFrame(rows, "page_id long, url string, html string, text string, n_chars long"), "pages")


def test_extract(pages):
    out = h.extract(pages).collect()
    assert out[0].asDict().keys() == {"page_id", "url", "text", "n_chars"} and len(out) == 26
    assert all(r.n_chars == len(r.text) for r in out)
    assert {r.text for r in out if r.page_id is not None and r.page_id < 20} == {WANT}
    plain = [r.text for r in out if r.page_id == 50]
    want = "A real headline Words of the story that go on for a while, as they do. one thing another thing The end of it all, at last."
    assert plain == [want, want]
    assert [r.text for r in out if r.page_id in (51, 52)] == ["", ""]
    assert [r.text for r in out if r.page_id is None] == ["one"]
    assert [r.text for r in out if r.page_id == 60] == [" ".join(["word"] * 30000)]
    assert h.extract(pages.limit(0)).count() == 0


@pytest.mark.parametrize(
    "source,text",
    [
        ("", ""), ("<", "<"), ("a < b", "a < b"), ("<p", "<p"), ("<p>one", "one"), ("<script>x", ""), ("<!-- open", ""),
        ("<nav>one of the menu words <p>text of it</p>", "one of the menu words text of it"), ('<p title="a>b">q</p>', "q"), ('<p title="open>q</p> "tail', 'q "tail'),
        ("<textarea><p>no</p></textarea><p>yes yes</p>", "yes yes"), ("<![CDATA[x]]><p>a&nbsp;b</p>", "a b"),
        ("<P CLASS='Ad'>no</P><P>yes</P>", "yes"), ("a<b>b</b>c<i>\n</i>d", "abc d"),
    ],
)
def test_odd_markup(source, text):
    page = h.Page(source)
    assert page.text(*page.best({})) == text


def test_the_scan_finds_the_best_range():
    import random

    rng = random.Random(4)
    for _ in range(200):
        page = h.Page("")
        page.features = [rng.choice(["w:p", "w:div", "p", "x"]) for _ in range(rng.randint(0, 25))]
        page.words = [rng.randint(1, 4) if f[0] == "w" else 0 for f in page.features]
        weights = {"w:p": 1.0, "w:div": 0.3, "p": -0.5, "x": -4.0}
        value = [weights[f] * (w or 1) for f, w in zip(page.features, page.words)]
        start, stop = page.best(weights)
        sums = [sum(value[i:j]) for i in range(len(value)) for j in range(i, len(value) + 1)]
        assert sum(value[start:stop]) == pytest.approx(max([0.0, *sums]))


def test_unclosed_quotes_and_tags_stay_linear():
    for source in ('<p a="' * 20000, "<" * 100000, "<a <" * 30000, "<p>" * 50000, "</p>" * 50000, "<!--" * 50000):
        page = h.Page(source)
        page.text(*page.best({}))


BODY = "<h1>Title here</h1><p>" + " ".join(f"word{i}" for i in range(60)) + ".</p>"
REST = "<nav><a>Home</a><a>News</a></nav><div class='sidebar'><a>Other page</a></div>"
MENU = "<footer>All rights reserved</footer>"


@pytest.mark.parametrize(
    "page",
    [
        f"<body>{REST}<div style='overflow: hidden'><article>{BODY}</article></div>{MENU}</body>",
        f"<body>{REST}<div title='a hidden gem'><article>{BODY}</article></div>{MENU}</body>",
        f"<body>{REST}<div class='with-sidebar'><article>{BODY}</article></div>{MENU}</body>",
        f"<body>{REST}<div class='layout has-comments'><article>{BODY}</article></div>{MENU}</body>",
        f"<body><form action='/x'>{REST}<div><article>{BODY}</article></div>{MENU}</form></body>",
        f"<body><form action='/x'>{REST}<div>{BODY}</div>{MENU}</form></body>",
        f"<body>{REST}<article class='no-sidebar'>{BODY}</article>{MENU}</body>",
        f"<body>{REST}<article><div class='entry-header'><h1>Title here</h1></div>{BODY[19:]}</article>{MENU}</body>",
        f"<body>{REST}<div class='widget-page'><main>{BODY}</main></div>{MENU}</body>",
        f"<body>{REST}<article>{BODY}</article><div class='comments'><article class='comment'><p>Nice one, thanks all</p></article></div>{MENU}</body>",
        f"<body>{REST}<article>{BODY}</article><div hidden><p>Not to be seen</p></div>{MENU}</body>",
    ],
)
def test_wrappers_named_like_boilerplate(page):
    shown = h.Page(page)
    text = shown.text(*shown.best({}))
    assert text == "Title here " + " ".join(f"word{i}" for i in range(60)) + "."
