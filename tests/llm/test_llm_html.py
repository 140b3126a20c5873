"""Main text of pages in several layouts."""
import pytest

from clickflow.llm.html_extract import extract_pages, main_text

LONG = "This is a paragraph of the article with a good number of words in it, and some more of them."
MENU = "<ul><li><a href='/a'>Home</a></li><li><a href='/b'>News</a></li><li><a href='/c'>About us</a></li></ul>"

PAGES = {
    "semantic": (f"<html><head><title>T</title><style>p{{}}</style><script>var a='</p>';</script></head><body><header>Site</header>"
                 f"<nav>{MENU}</nav><main><article><h1>Head</h1><p>{LONG}</p><p>Short.</p><p>A &amp; <b>b</b>c &eacute;</p></article>"
                 f"<section class='comments'><p>{LONG} by a reader</p></section></main><aside>{LONG}</aside><footer>&copy; x</footer></body></html>",
                 f"Head {LONG} Short. A & bc é"),
    "div soup": (f"<body><div id='top-menu'>{MENU}</div><div class='content'><h2>Head</h2><p>{LONG}</p>x<br>y<p>{LONG}</div>"
                 f"<div class='ad'>{LONG}</div><div class='cookie-notice'>We use cookies</div><form><p>{LONG}</p></form></body>",
                 f"Head {LONG} x y {LONG}"),
    "unmarked menus": (f"<body><div>{MENU}</div><div><p>{LONG}</p><p>{LONG}</p><p>{LONG}</p></div><div>{MENU}</div></body>",
                       f"{LONG} {LONG} {LONG}"),
    "tables": (f"<table><tr><td>{MENU}</td><td><p>{LONG}</p><p>{LONG}</p></td></tr></table>", f"{LONG} {LONG}"),
    "article header": (f"<header>Site</header><article><header><h1>Head</h1></header><p>{LONG}</p></article>", f"Head {LONG}"),
    "nested dropped": (f"<article><div class='ad'><div>{LONG}</div>{LONG}</div><span class='ad'><span>a</span>b</span><p>{LONG}</p></article>", LONG),
    "white space": ("<article><p> a\n\t b&nbsp; c </p>\n\n<p>d</p></article>", "a b c d"),
    "unclosed": (f"<article><p>{LONG}<p>{LONG}", f"{LONG} {LONG}"),
    "plain": ("just text", "just text"),
    "none": ("<script>x</script><!-- c -->", ""),
}


@pytest.mark.parametrize("name", PAGES)
def test_layouts(name):
    page, want = PAGES[name]
    assert main_text(page) == want


def test_malformed_pages_do_not_fail():
    for page in ("<![foo", "<!x[ <p>a", "<", "<p", "&#xFFFFFFFF;", "<a" * 500, "</div>" * 50 + "x", "\x00<p>퟿", "<div>" * 3000 + "x"):
        main_text(page)


def test_table_edges(spark):
    rows = [(1, "u", PAGES["semantic"][0], "t", 3), (1, "u", PAGES["semantic"][0], "t", 3), (None, None, None, None, None),
            (2, "u", "", "t", 4), (3, "u", f"<article><p>{'w ' * 200000}</p></article>", "t", 5)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string, n_chars int")
    got = extract_pages(df)
    assert got.columns == ["page_id", "url", "text", "n_chars"]
    out = [tuple(r) for r in got.collect()]
    assert out[0] == out[1] == (1, "u", PAGES["semantic"][1], len(PAGES["semantic"][1]))
    assert out[2] == (None, None, "", 0) and out[3] == (2, "u", "", 0) and out[4][3] == 399999
    assert extract_pages(df.limit(0)).count() == 0


def test_given_pages_give_their_articles(spark):
    import html
    import re
    for (h,) in spark.read.parquet("/root/testdata/sf0.01/pages.parquet").select("html").collect():
        inner = re.search(r"<article>(.*?)(</article>|$)", h, re.S)
        blocks = [" ".join(html.unescape(re.sub(r"</?b>", "", x)).split()) for x in re.split(r"</?(?:p|h1|br)>", inner.group(1))]
        assert main_text(h) == " ".join(b for b in blocks if b)


WHOLE = {
    "lead before a body": (f"<article><h1>Title</h1><p>Lead</p><div class='body'>{'<p>' + LONG + '</p>'}</div></article>",
                           f"Title Lead {LONG}"),
    "long list": (f"<article><p>Before.</p><ul>{''.join(f'<li>{LONG}</li>' for _ in range(30))}</ul><p>After.</p></article>",
                  " ".join(["Before.", *[LONG] * 30, "After."])),
    "long section": (f"<main><p>Before.</p><section>{'<p>' + LONG + '</p>' + '<p>' + LONG * 20 + '</p>'}</section><p>After.</p></main>",
                     f"Before. {LONG} {LONG * 20} After."),
    "no article": (f"<body><div>{MENU}</div><div class='post'><h1>Title</h1><p>Lead</p><div class='body'><p>{LONG}</p><p>{LONG * 20}</p></div>"
                   f"<p>{LONG}</p></div></body>", f"Title Lead {LONG} {LONG * 20} {LONG}"),
}


@pytest.mark.parametrize("name", WHOLE)
def test_text_around_the_longest_container_stays(name):
    page, want = WHOLE[name]
    assert main_text(page) == want


@pytest.mark.parametrize("attrs", ["class='content has-sidebar'", "id='page' class='no-comments'", "class='post social-icons-on'",
                                   "class='social'", "id='main' class='widget'"])
def test_marks_on_a_layout_wrapper_do_not_drop_the_article(attrs):
    inner = f"<h2>Head</h2><p>{LONG}</p><p>{LONG}</p><div class='sidebar'><p>{LONG} aside</p></div>"
    assert main_text(f"<body><div>{MENU}</div><div {attrs}>{inner}</div></body>") == f"Head {LONG} {LONG}"
    assert main_text(f"<body><div {attrs}><article>{inner}</article></div></body>") == f"Head {LONG} {LONG}"
    assert main_text(f"<body><div {attrs}><h1>Head</h1>{inner[13:]}</div></body>") == f"Head {LONG} {LONG}"
    assert main_text(f"<main><div {attrs}><article>{inner}</article></div></main>") == f"Head {LONG} {LONG}"
    assert main_text(f"<article><div {attrs}>{inner[:13]}<p>{LONG}</p></div></article>") == f"Head {LONG}"


def test_marked_elements_beside_the_article_go():
    for mark in ("ad", "site-footer", "related-posts", "comment-list", "cookie-notice", "left sidebar"):
        for page in (f"<article><h1>Head</h1><p>{LONG}</p></article><div class='{mark}'><p>{LONG}</p><p>{LONG}</p></div>",
                     f"<div class='post'><h1>Head</h1><p>{LONG}</p></div><div id='x' class='{mark}'><p>{LONG}</p></div>"):
            assert main_text(page) == f"Head {LONG}"
