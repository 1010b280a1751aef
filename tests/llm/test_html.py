"""Main text of pages: attributes as browsers read them, what stands beside an article, deep pages, whole tables."""

import time

import pytest

from recordloom.llm import htmltext
from recordloom.llm.htmltext import attributes, beside, main_text

LONG = "A long paragraph, with words, and marks; it goes on."
ARTICLE = f"<h1>A title</h1><p>{LONG} {LONG}</p><p>{LONG}</p>"
WANT = f"A title\n\n{LONG} {LONG}\n\n{LONG}"


@pytest.mark.parametrize(
    "part",
    [
        "<p><a title='a hidden gem' href=x>{}</a></p>", "<p data-hidden='false'>{}</p>", "<p data-id='menu'>{}</p>", "<p title=don't>{}</p>",
        "<p title = \"class='menu'\">{}</p>", "<p data-class=comments>{}</p>", "<p class=no-comments>{}</p>", "<p class='ad-hoc has-sidebar'>{}</p>",
        "<p title='x>y' style='color:red'>{}</p>", "<p 'odd\" class=x>{}</p>", "<p id=header-history>{}</p>", "<p class=x/>{}</p>",
    ],
)
def test_article_text_stays(part):
    page = f"<body><nav>Home</nav><article>{ARTICLE}{part.format('It is after, with words.')}<p>{LONG}</p></article><footer>foot</footer>"
    assert main_text(page) == f"{WANT}\n\nIt is after, with words.\n\n{LONG}"


def test_attributes():
    got = attributes(" Class=\"a b\" id='x' hidden data-x=y'z title = don't href=/a/b?c=d class=second empty=")
    assert got == {"class": "a b", "id": "x", "hidden": "", "data-x": "y'z", "title": "don't", "href": "/a/b?c=d", "empty": ""}


@pytest.mark.parametrize("inside", [True, False])
@pytest.mark.parametrize(
    "name",
    [
        "class=comment-list", "class=commentlist", "id=reader-comments", "class='x comment-thread'", "class=ad-slot", "class=cookie-bar", "class=commentList",
        "id=comments", "class='ads_box'", "class=sponsored-links", "hidden", "role=complementary", "style='display: none'", "class=related-posts", "class=share-buttons",
        "aria-hidden=true", "class=comments-section", "class=newsletter-box", "id=disqus_thread",
    ],
)
def test_what_stands_beside_goes(name, inside):
    alien = f"<div {name}><p>I like this text, it is long, and a comment.</p><p>So do I, really.</p></div>"
    page = f"<body><nav>Home</nav><article>{ARTICLE}{alien if inside else ''}</article>{'' if inside else alien}<footer>foot</footer>"
    assert main_text(page) == WANT
    assert main_text(page.replace("article>", "div>")) == WANT


def test_names():
    assert all(beside(n) for n in ("comment-list", "commentList", "site-header", "ad_slot_2", "top-nav"))
    assert not any(beside(n) for n in ("no-comments", "ad-hoc", "content", "header-history", "searching", "", "2"))


def test_header_of_an_article():
    byline = "<p>By somebody, today.</p>"
    page = f"<body><header><h1>Site</h1></header><article><header><h1>A title</h1>{byline}</header><p>{LONG} {LONG}</p><p>{LONG}</p><header><a>Skip</a></header></article>"
    assert main_text(page) == f"A title\n\nBy somebody, today.\n\n{LONG} {LONG}\n\n{LONG}"


def test_entries_of_readers_by_structure():
    entry = "<div class=x7><b>name</b><p>I think so too, and said it, long ago.</p><a>Reply</a></div>"
    other = "<div class=x7><b>other</b><p>I do not, for once.</p><a>Reply</a></div>"
    assert main_text(f"<article>{ARTICLE}<div>{entry}{other}</div></article>") == WANT
    assert main_text(f"<body><div><div>{ARTICLE}</div><ol>{entry.replace('div', 'li')}{other.replace('div', 'li')}</ol></div>") == WANT
    # sections of the article that share a label hold most of its text
    section = f"<section><h2>Part</h2><p>{LONG} {LONG}</p><a>Back to top</a></section>"
    assert main_text(f"<article><p>{LONG}</p>{section}{section}</article>").count("Part") == 2
    # a list without a common label stays
    assert "One, and" in main_text(f"<article>{ARTICLE}<ul><li>One, and more.</li><li>Two, and more.</li></ul></article>")


@pytest.mark.parametrize("open_tag,stray", [("<div>", ""), ("<div class=comments>", ""), ("<b>", "</i>"), ("<div>", "</section>"), ("<div><li></li>", "<p>")])
def test_deep_pages_take_linear_time(open_tag, stray):
    def seconds(n):
        page = "".join(f"{open_tag}word {i}, and more.{stray}" for i in range(n))
        start = time.perf_counter()
        assert open_tag != "<div>" or f"word {n - 1}," in main_text(page)
        return time.perf_counter() - start

    seconds(1000)
    small, large = seconds(4000), seconds(16000)
    assert large < 12 * small + 0.5 and large < 6


def test_pages_as_a_table(spark):
    rows = [(1, "u", f"<article>{ARTICLE}</article>", "x"), (1, "u", f"<article>{ARTICLE}</article>", "x"), (None, None, None, None), (2, "v", "", "y"), (3, None, "<p>é &amp; <", "z")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = sorted((tuple(r) for r in htmltext.extract_main_text(df).collect()), key=repr)
    want = [(1, "u", WANT, len(WANT))] * 2 + [(2, "v", "", 0), (3, None, "é & <", 5), (None, None, "", 0)]
    assert got == sorted(want, key=repr)
    assert htmltext.extract_main_text(df.limit(0)).count() == 0
