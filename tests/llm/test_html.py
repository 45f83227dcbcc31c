"""Main text of pages: a plainer reading of the generated pages, the rules one by one, and broken markup."""

import html as H
import re
import time

import pytest

from staymill.llm import html as X
from staymill.llm.catalog import QUERIES, read

STORY = "The house on the hill was old and it had been there for as long as anyone in the town could remember, and that is a long time."


def _article(page):
    """Paragraphs of the article element; the generated pages are regular enough for patterns."""
    out = []
    for article in re.findall(r"<article>(.*?)</article>", page, re.S):
        for piece in re.split(r"</?(?:p|h1)>", article):
            plain = re.sub(r"<[^>]*>", lambda m: " " if m[0] == "<br>" else "", re.sub(r"<!--.*?-->", "", piece))
            if words := H.unescape(plain).split():
                out.append(" ".join(words))
    return "\n".join(out)


def test_query_equals_the_articles(spark, small):
    pages = {r.page_id: r for r in read(spark, small, "pages").collect()}
    got = QUERIES["op12_html_extract"](spark, small).collect()
    assert len(got) == len(pages) and all(pages[r.page_id].url == r.url for r in got)
    assert [r.page_id for r in got if r.text != _article(pages[r.page_id].html) or r.n_chars != len(r.text)] == []


def test_rules_of_the_first_pass():
    def label(text, **kw):
        return X._first_pass(X.Block(text, kw.get("linked", 0), kw.get("kind", X._PLAIN), 0), X.STOP_WORDS)

    assert label(STORY) is True
    assert label("Home") is None  # too short to tell
    assert label(STORY, kind=X._SIDE) is False
    assert label(STORY, linked=len(STORY) // 2) is False
    assert label("xyzzy plugh " * 20) is None  # no stop words


@pytest.mark.parametrize("kinds, want", [
    ([True, None, True], [True, True, True]),
    ([False, None, True], [False, False, True]),  # as near to a dropped one: dropped
    ([False, None, None, True], [False, False, True, True]),
    ([None, False], [False, False]),
    ([None, None], [False, False]),
])
def test_open_blocks_follow_their_neighbours(kinds, want):
    assert X._second_pass([X.Block("x", 0, X._PLAIN, 0) for _ in kinds], kinds) == want


@pytest.mark.parametrize("around", [
    "<nav><a href=/>{}</a></nav>", "<header><p>{}</header>", "<footer>{}</footer>", "<aside><p>{}</p></aside>", "<form><p>{}<input></form>",
    "<div class='cookie-notice'><p>{}</p></div>", "<div id=sidebar>{}</div>", "<div class=ad>{}</div>", "<section class='comments'><p>{}</p></section>",
    "<script>document.write('<p>{}</p>')</script>", "<style>{}</style>", "<!-- <p>{}</p> -->", "<noscript><p>{}</p></noscript>", "<div hidden><p>{}</p></div>",
    "<select><option>{}</option></select>", "<div role=navigation>{}</div>", "<template><p>{}</p></template>", "<svg><text>{}</text></svg>",
])
def test_what_is_no_article_goes(around):
    noise = around.format(STORY.replace("house", "spam"))
    for page in ("<html><body>%s<article><h1>Title</h1><p>%s</p><p>End.</article>%s", "<body>%s<div><h1>Title</h1><p>%s</p><p>End.</div>%s"):
        got = X.main_text(page % (noise, STORY, noise))
        assert STORY in got and "spam" not in got and "Title" in got.split("\n") and got.endswith("\nEnd.")


def test_comments_and_lists_of_links_inside_an_article_go():
    links = "".join(f"<li><a href=/{i}>Another story of the day, number {i}</a></li>" for i in range(9))
    page = f"<article><p>{STORY}</p><ul class=related>{links}</ul><div class=comments><p>{STORY} I agree</p></div><p>{STORY} Fin.</p></article>"
    assert X.main_text(page) == f"{STORY}\n{STORY} Fin."


def test_white_space_and_references():
    page = f"<title>no</title><main><p>A&amp;B&nbsp;&#8212;&#x41;<br>c\n\t d <b>e</b>f &unknown; &lt;p&gt; {STORY}</main>"
    assert X.main_text(page) == f"A&B —A c d ef &unknown; <p> {STORY}"


def test_a_short_article_stays_whole():
    assert X.main_text("<nav><a href=/>Home</a></nav><article><h1>Hm.</h1><p><b>Hm.<br><p></article><footer>f</footer>") == "Hm.\nHm."


def test_defined_cases(spark):
    rows = [(1, "u", None, 7), (1, "u", "", 7), (None, None, "   ", 7), (2, "v", "<p>", 7), (3, "w", "no markup", 7), (4, "x", "<article>" + f"<p>{STORY}</p>" * 20_000, 7)]
    got = X.extract(spark.createDataFrame(rows, "page_id long, url string, html string, text int")).collect()
    assert sorted((r.page_id or 0, r.text) for r in got)[:5] == [(0, ""), (1, ""), (1, ""), (2, ""), (3, "")]
    assert next(r for r in got if r.page_id == 4).text.count("\n") == 19_999
    assert X.extract(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


@pytest.mark.parametrize("piece", ["<", '<a "', "<!--", "<script>", '<div class="', "<p a='>", "<b>", "<div>", '"<a =', '<a "x', "</div>", "<a ='"])
def test_broken_markup_takes_linear_time(piece):
    start = time.perf_counter()
    X.main_text(piece * (400_000 // len(piece)))
    X.main_text("<a " + piece * (400_000 // len(piece)) + ">")
    assert time.perf_counter() - start < 10
