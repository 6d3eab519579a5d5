import pytest

from freightloom.llm import html

LONG = "Some long paragraph of the article goes on for a while and says many things. " * 4
ARTICLE = f"<article><h1>Title</h1><p>{LONG}</p><p>Short.</p><p>{LONG}</p></article>"
TEXT = "\n\n".join(["Title", LONG.strip(), "Short.", LONG.strip()])


def page(body, head=""):
    return f"<!DOCTYPE html><html><head><title>T</title>{head}</head><body>{body}</body></html>"


NOISE = {
    "menu": '<nav><ul><li><a href="/a">A</a></li><li><a href="/b">B</a></li></ul></nav>',
    "header": f"<header><h2>Site</h2><p>{LONG}</p></header>",
    "footer": f"<footer>&copy; {LONG}</footer>",
    "sidebar": f'<aside><p>{LONG}</p></aside><div class="left-sidebar"><div><p>{LONG}</p></div></div>',
    "notice": f'<div id="cookie-notice"><p>{LONG}</p></div>',
    "advert": f'<div class="ad">{LONG}</div><section class="box sponsored"><div>{LONG}</div></section>',
    "form": f"<form><label>Name</label><input name=x><textarea>{LONG}</textarea><button>Go</button></form>",
    "script": f'<script>var t="</p>{LONG}";</script><style>p{{margin:0}}</style><noscript>{LONG}</noscript>',
    "comments": f'<section id="comments"><h2>Comments</h2><div class="comment"><p>{LONG}</p></div></section>',
    "markup": f"<!-- {LONG} --><svg><text>{LONG}</text></svg>",
    "open advert": '<div class="ad">Buy this',
}


@pytest.mark.parametrize("name", NOISE)
def test_noise_is_left_out(name):
    assert html.main_text(page(NOISE[name] + ARTICLE)) == TEXT
    if name != "open advert":
        assert html.main_text(page(ARTICLE + NOISE[name])) == TEXT
        inside = ARTICLE.replace("<p>Short.", NOISE[name] + "<p>Short.")
        if name not in ("header",):
            assert html.main_text(page(inside)) == TEXT


def test_all_noise_together():
    noise = "".join(v for k, v in NOISE.items() if k != "open advert")
    assert html.main_text(page(noise + ARTICLE + noise)) == TEXT


@pytest.mark.parametrize("wrap", ["<main>{}</main>", "<div class='content'>{}</div>", "<div><section>{}</section></div>", "{}"])
def test_pages_without_an_article_element(wrap):
    body = ARTICLE.removeprefix("<article>").removesuffix("</article>")
    links = "<div>" + "".join(f'<a href="/{k}">x{k}</a> ' for k in range(20)) + "</div>"
    found = html.main_text(page(NOISE["menu"] + (links if wrap != "{}" else "") + wrap.format(body) + NOISE["footer"]))
    assert found == TEXT


@pytest.mark.parametrize("names", ['class="content has-sidebar"', 'class="post no-comments"', 'id="search-results-study"', 'class="content right-sidebar"', 'class="page-without-ads"'])
def test_names_that_merely_contain_a_word(names):
    body = ARTICLE.removeprefix("<article>").removesuffix("</article>")
    assert html.main_text(page(f"{NOISE['menu']}<div {names}>{body}</div>{NOISE['footer']}")) == TEXT


def test_anchors_and_paragraphs_of_an_article():
    inside = (
        f'<h2 id="related-work">Related work</h2><p>{LONG}</p><section id="social-history"><h3 id="search">Search</h3><p>{LONG}</p></section>'
        f'<p class="share">{LONG}</p>'
    )
    found = html.main_text(page(ARTICLE.replace("</article>", inside + "</article>")))
    assert found == "\n\n".join([TEXT, "Related work", LONG.strip(), "Search", LONG.strip(), LONG.strip()])
    links = '<p class="share"><a href="/a">A</a> <a href="/b">B</a> <a href="/c">C</a></p>'
    assert html.main_text(page(ARTICLE.replace("<p>Short.", links + "<p>Short."))) == TEXT


def test_compounds_that_mean_noise():
    for name in ("comments-area", "related-posts", "site-footer", "ad-slot-300", "share_buttons", "nav-menu"):
        assert html.main_text(page(f'{ARTICLE}<div class="{name}"><p>{LONG}</p></div>')) == TEXT, name


ARTICLES_OF_NO_MAIN_TEXT = {
    "comments": f'<section id="comments"><article class="comment"><p>{LONG}</p></article><p>{LONG}</p></section>',
    "promo in aside": f'<aside><article class="promo"><p>{LONG}</p></article><p>{LONG}</p></aside>',
    "plain card in aside": f"<aside><article><h3>Card</h3><p>{LONG}</p></article><article><p>{LONG}</p></article><p>{LONG}</p></aside>",
    "related": f'<div class="related"><div><article><p>{LONG}</p></article></div><p>{LONG}</p></div>',
    "comment alone": f'<article class="comment"><p>{LONG}</p></article>',
    "footer": f"<footer><main><p>{LONG}</p></main>{LONG}</footer>",
}


@pytest.mark.parametrize("name", ARTICLES_OF_NO_MAIN_TEXT)
def test_articles_within_left_out_elements(name):
    noise = ARTICLES_OF_NO_MAIN_TEXT[name]
    assert html.main_text(page(noise + ARTICLE)) == TEXT
    assert html.main_text(page(ARTICLE + noise)) == TEXT
    assert html.main_text(page(ARTICLE.replace("<p>Short.", noise + "<p>Short."))) == TEXT


@pytest.mark.parametrize("tags", ['<div class="ad">Buy', '<section class="ad"><div>Buy</div>', "<nav><ul><li>A", '<div class="ad"><div class="ad">Buy'])
def test_elements_left_open_do_not_swallow_the_article(tags):
    assert html.main_text(page(tags + ARTICLE)) == TEXT
    assert html.main_text(page(f'<div id="page">{tags}{ARTICLE}</div>')) == TEXT
    assert html.main_text(page(tags + ARTICLE + ARTICLES_OF_NO_MAIN_TEXT["comments"])) == TEXT
    assert html.main_text(f"<head><title>T</title><body>{tags}{ARTICLE}") == TEXT


def test_many_open_elements_take_linear_time():
    import time

    def seconds(n):
        begin = time.perf_counter()
        html.main_text(page('<div class="ad">x<article><aside>' * n))
        return time.perf_counter() - begin

    seconds(1000)
    assert seconds(8000) < 40 * seconds(1000) + 0.5


UNBALANCED = [
    "<b>{}</i>", "<b>{}<div></div>", "<li><div>{}<b><li></li>", "{}<!--", "{}<!-- -", "{}<a ", '{}<a x="', "{}<a x='>", '{}<a "', "{}</", "{}</a ",
    "{}<!", "{}<?", "{}<![CDATA[", "{}<p", "{}<script>", "{}</script", "{}<style>", "{}<textarea>", "{}&", "{}&#", "{}<a b=c d='e", "{}<p>", "{}<table><tr><td>",
    "{}<nav>", '{}<div class="ad">', "{}<article>", "{}<svg>", "{}<h1>", '{}<div class="share">x',
]


@pytest.mark.parametrize("ends", ["", ">", "--", "x>y"])
@pytest.mark.parametrize("tag", UNBALANCED)
def test_unbalanced_tags_take_linear_time(tag, ends):
    """A megabyte of any of them takes seconds; a quadratic way takes minutes."""
    import time

    before, after = tag.split("{}")
    unit = max(1, len(before) + len(after))
    count = 250_000 // unit
    begin = time.perf_counter()
    html.main_text(before * count + after * count + ends)
    assert time.perf_counter() - begin < 2.5


def test_the_article_decides():
    other = f"<div><p>{LONG}{LONG}</p><p>{LONG}{LONG}</p></div>"
    one = f"<article><p>{LONG}</p></article>"
    for text in (one + other, other + one):
        assert html.main_text(page(text)) == LONG.strip()
    two = "<article><h1>Title</h1><p>A few words here.</p><p>And some more.</p></article>"
    assert html.main_text(page(two + other)) == "Title\n\nA few words here.\n\nAnd some more."
    # Several articles are kept, whatever their lengths.
    long = f"<article><p>{LONG}{LONG}{LONG}</p><p>{LONG}</p></article>"
    assert html.main_text(page(f"<article><p>{LONG}</p><p>{LONG}</p></article>" + long)) == "\n\n".join([LONG.strip()] * 2 + [(LONG * 3).strip(), LONG.strip()])


def test_a_main_element_decides_where_no_article_is():
    menu = "<div>Home News Shop</div>"
    assert html.main_text(page(f"{menu}<main><p>{LONG}</p></main><div>Imprint</div>")) == LONG.strip()
    assert html.main_text(page(f"{menu}<main><p>{LONG}</p><article><p>Card.</p></article><article><p>Card two.</p></article></main>")) == "\n\n".join(
        [LONG.strip(), "Card.", "Card two."]
    )


def test_sections_of_short_paragraphs_are_kept():
    text = f"<section><h1>Title</h1><p>{LONG}</p><p>{LONG}</p></section><section><h2>Short part</h2><p>One line.</p><p>Two lines.</p></section>"
    assert html.main_text(page(NOISE["menu"] + text + NOISE["footer"])) == "\n\n".join(["Title", LONG.strip(), LONG.strip(), "Short part", "One line.", "Two lines."])


def test_body_of_a_page_builder():
    body = ARTICLE.removeprefix("<article>").removesuffix("</article>")
    names = "elementor-element elementor-widget elementor-widget-theme-post-content"
    menu = '<div class="elementor-widget elementor-widget-nav-menu"><a href="/a">Home</a> <a href="/b">News</a></div>'
    assert html.main_text(page(f'{menu}<div class="{names}"><div class="elementor-widget-container">{body}</div></div>')) == TEXT


@pytest.mark.parametrize("name", ["share", "related", "search-results", "notice", "widget", "social-modal"])
def test_names_that_may_mean_something_else_never_beat_a_dense_block(name):
    body = ARTICLE.removeprefix("<article>").removesuffix("</article>")
    assert html.main_text(page(f'{NOISE["menu"]}<div class="{name}">{body}</div>{NOISE["footer"]}')) == TEXT
    # Beside main text they hold.
    assert html.main_text(page(f'<div>{body}</div><div class="{name}"><p>{LONG}</p></div>')) == TEXT
    assert html.main_text(page(f'{ARTICLE}<div class="{name}"><p>{LONG * 9}</p></div>')) == TEXT


def test_left_out_elements_within_a_paragraph_leave_it_whole():
    for tag in ("<script>x()</script>", "<svg><text>t</text></svg>", '<span class="ad">Buy</span>', "<button>Go</button>", "<style>p{}</style>", "<select><option>1</select>"):
        assert html.main_text(page(f"<article><p>Water {tag}is wet.</p></article>")) == "Water is wet.", tag
    assert html.main_text(page("<article>One<nav>menu</nav>two</article>")) == "One\n\ntwo"


def test_quotes_and_comments_without_an_end():
    assert html.main_text(page(f'<article><p>{LONG}</p><p>a < b and c > d</p><!-- never ends <p>x</p></article>')) == f"{LONG.strip()}\n\na < b and c > d"
    assert html.main_text(f'<article><p>{LONG}</p><a href="x>link</a><p>After.</p></article>').startswith(LONG.strip())
    assert html.main_text("<p>one</p><!-- a --><p>two</p><!-- b --!><p>three <") == "one\n\ntwo\n\nthree <"
    assert html.main_text("<p>one <!--> two</p>") == "one two"


def test_blocks_white_space_and_references():
    body = "<article><p> one\n two&nbsp;&amp;\tthree <b>bo</b>ld<br>next</p>loose text<p><b>open<br><p>after &lt;x&gt; &eacute;&#233;&#xe9;</p><ul><li>a<li>b</ul><p></p></article>"
    assert html.main_text(page(body)) == "one two & three bold next\n\nloose text\n\nopen\n\nafter <x> ééé\n\na\n\nb"


@pytest.mark.parametrize("broken", [None, "", "   ", "<", "<p", "<!--", "<html><body></body></html>", "</p></div>", "<script>x", "<![CDATA[x", "<p>" * 2000])
def test_pages_without_text(broken):
    assert html.main_text(broken) in ("", "<", "<p", "<!--", "x", "<![CDATA[x")


def test_plain_text_is_kept():
    assert html.main_text("just words & more") == "just words & more"


def test_smoothing_and_threshold():
    assert html.smoothed([5.0, 5.0, 5.0]) == pytest.approx([5.0, 5.0, 5.0])
    spread = html.smoothed([0.0, 0.0, 0.0, 10.0, 0.0, 0.0, 0.0])
    assert spread[3] == max(spread) and spread[2] == pytest.approx(spread[4]) and spread[2] > spread[1]
    assert 2 < html.threshold([1.0, 2.0, 1.5, 50.0, 60.0]) < 50
    assert html.threshold([3.0]) <= 3.0


def test_query_on_all_pages(spark, sf_dir):
    import html as entities
    import re

    from freightloom.llm.queries import QUERIES

    found = {r.page_id: r for r in QUERIES["op10_html_main_text"](spark, sf_dir).collect()}
    for row in spark.read.parquet(f"{sf_dir}/pages.parquet").collect():
        inside = row.html[row.html.index("<article>") + 9 : row.html.rindex("</article>")]
        blocks = [" ".join(entities.unescape(re.sub("<[^>]*>", " ", b)).split()) for b in re.split("</?(?:p|h1)>", inside)]
        want = "\n\n".join(b for b in blocks if b)
        assert (found[row.page_id].text, found[row.page_id].n_chars, found[row.page_id].url) == (want, len(want), row.url)


def test_odd_rows(spark):
    rows = [(1, "u", page(ARTICLE), 1), (1, "u", page(ARTICLE), 1), (2, None, None, 2), (None, "v", "", 3), (4, "w", page(f"<article><p>{LONG * 2000}</p></article>"), 4)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, n_chars int")
    found = sorted([(r.page_id or 0, r.n_chars) for r in html.extracted(pages).collect()])
    assert found == [(0, 0), (1, len(TEXT)), (1, len(TEXT)), (2, 0), (4, len((LONG * 2000).strip()))]
    assert html.extracted(pages.where("false")).count() == 0
