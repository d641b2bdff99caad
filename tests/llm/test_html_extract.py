import pytest
from catlens.llm.html_extract import blocks, extract_pages, main_text

ARTICLE = """<!DOCTYPE html><html><head><title>No &amp; title</title><style>p{}</style><script>var t="</p>"; if (a<b) {}</script></head><body>
<header><a href="/">Home</a> Site name</header><nav><ul><li><a href="/a">A</a></li><li>B</ul></nav><!-- ad > --><div class="ad">Buy this, now. It is good.</div>
<div id="cookie-notice">We use cookies, as you know. Agree?</div>
<article class="post"><h1>Big  news</h1><p><b>First&nbsp;part &lt;one&gt; &amp;amp;<br>goes on<p>Second,
 <i>in</i>line<script>x</script> text.</p><ul><li>item <a href=x title="a>b">one</a><li>item two</ul><aside>Related: other story, long text here.</aside>
<table><tr><td>c1<td>c2</table><form><input name=q><label>Search, please.</label></form><blockquote><p>Quoted.</blockquote></article>
<section class="comments"><h2>Comments</h2><p>I disagree, with all of it.</p></section>
<div class="sidebar"><p>More, and more. And more.</p></div><footer>Copyright, all rights.</footer></body></html>"""


def test_article_page():
    assert main_text(ARTICLE).split("\n") == ["Big news", "First part <one> &amp; goes on", "Second, inline text.", "item one", "item two", "c1", "c2", "Quoted."]


def test_page_without_article_uses_the_ratios():
    text = "".join(f"<p>Paragraph {i}, with a good deal of text, and marks; really quite a lot of it. And more.</p>" for i in range(6))
    page = f"<body><div class=top><a href=1>Home</a> <a href=2>News</a></div><div class=body><h2>Heading</h2>{text}</div><div class=x><a href=3>next</a></div><div class=footer>Imprint.</div>"
    got = main_text(page).split("\n")
    assert got[0] == "Heading" and len(got) == 7 and "next" not in got and "Imprint." not in got


def test_comments_and_teasers_inside_main():
    page = "<main><article><h1>T</h1><p>The story, which is long enough to be it. Yes.</p><div id=comments><article><p>First! A comment, of a reader.</p></article></div></article></main>"
    assert main_text(page) == "T\nThe story, which is long enough to be it. Yes."
    teasers = "<article><p>" + "Main text, of length. " * 30 + "</p></article><article><p>Teaser.</p></article>"
    assert "Teaser" not in main_text(teasers)


@pytest.mark.parametrize("page", [None, "", "   ", "<", "<p", "</p></p>", "<!--", "<script>", "<script>x", "<a href='", "&#0;&#xD800;&bogus;", "<p>" * 3000, "<div>" * 2000 + "x", "]]>", "<p a=\"b>c</p><p>d"])
def test_broken_pages(page):
    assert isinstance(main_text(page), str)


def test_plain_text_and_entities():
    assert main_text("just text, no markup &eacute;&#233;&#x41;") == "just text, no markup ééA"
    assert [b.text for b in blocks("<p>a<p>b<b>c</b>d<div>e</div>f")] == ["a", "bcd", "e", "f"]


def test_second_article_part_stays():
    first = "<article><p>" + "Main text, of some length. " * 40 + "</p></article>"
    second = "<article><h2>Part two</h2><p>" + "More of it, as text goes. " * 6 + "</p></article>"
    assert main_text(first + second).split("\n")[1:] == ["Part two", ("More of it, as text goes. " * 6).strip()]
    links = "<article><p>" + "<a href=x>Another story, quite long. Yes.</a> " * 6 + "</p></article>"
    assert "Another" not in main_text(first + links)


def test_names_that_may_be_topics():
    text = "".join(f"<p>Sentence {i}, with a clause; and an end. More of it.</p>" for i in range(5))
    page = f"<article>{text}<p class='legal'>The legal case, which went on for years, ended; nobody won. Both paid.</p><section class='discussion'><h2>Discussion</h2><p>We see, in short, what was to be seen; more work is needed. Indeed.</p></section></article>"
    got = main_text(page)
    assert "The legal case" in got and "what was to be seen" in got
    outside = f"<div class='legal'>All rights.</div><article>{text}<div class='legal-notice'>No liability, of any kind. None.</div><div class=comments><p>Nice, really. Good.</p></div></article><div class='notice'>We changed, a bit.</div>"
    assert main_text(outside) == main_text(f"<article>{text}</article>")


def test_an_unmarked_neighbour_is_left_out():
    text = "<p>" + "A sentence, with a clause; and an end. " * 9 + "</p>"
    assert "Buy" not in main_text(f"<body><div>Buy this, now. Good.</div><article>{text}{text}</article><div><p>Buy that, too. Fine.</p></div></body>")


@pytest.mark.parametrize("piece", ["<a ", "<div>x", "<b>x", "<p a='", '<a "', "<button>", "<!", "</x", "<li><b>", "<table><tr>", "<h1>x", "&amp;<i>", "<!--", "<span class='a", "<svg>x", "<em><h2>x</h2>"])
def test_long_broken_pages_are_scanned_once(piece):
    import time

    page = piece * (1_000_000 // len(piece))
    t = time.process_time()
    main_text(page + "<p>end")
    assert time.process_time() - t < 12


def test_table(spark):
    rows = [(1, "u", ARTICLE, "clash"), (None, None, None, None), (2, "", "", "x"), (1, "u", ARTICLE, "clash")]
    got = extract_pages(spark.createDataFrame(rows, "page_id long, url string, html string, text string")).collect()
    assert sorted((r.page_id or 0, r.n_chars) for r in got) == [(0, 0), (1, len(main_text(ARTICLE))), (1, len(main_text(ARTICLE))), (2, 0)]
    assert extract_pages(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0
