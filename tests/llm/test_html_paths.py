from __future__ import annotations

import time

import pytest

from tidings.llm import html_paths

BLOCKS = html_paths.Blocks()


def text(page):
    return " ".join(html_paths.content(BLOCKS(page)))


PROSE = "A sentence of the article, with a comma and a stop. Another one follows it; so it goes on."
PAGE = f"""<!DOCTYPE html><html><head><title>T. T, T</title><style>p{{}}</style><script>var a="</p><p>no, no.";</script></head>
<body><header><h1>Site, name.</h1></header><nav><ul><li><a href=x>Home</a><li>News, today.</ul></nav>
<div class="cookie-notice">We use cookies, always. Accept, please.</div>
<main><article><h1>Title</h1><p>{PROSE}</p><div class="ad banner">Buy, now. Really, now.</div><p><b>Bold</b>ly <i>put</i>.<br>Next&nbsp;line &amp; &lt;tag&gt; &#x41;&eacute;
<p>Of.<ul><li>one<li>two</ul><form><label>Name, please.</label><input></form><aside>Related, things.</aside></article>
<section id="comments"><p>{PROSE} {PROSE} I said, so.</p></section></main>
<footer>&copy; Site, all rights.</footer><!-- <p>hidden, text.</p> --></body></html>"""


def test_article_without_furniture():
    assert text(PAGE) == f"Title {PROSE} Boldly put. Next line & <tag> Aé Of. one two"


def test_pages_without_names_are_told_by_their_ratios():
    menu = "".join(f"<div><div>Menu {k}</div></div>" for k in range(8))
    page = f"<body><div>{menu}</div><div>" + f"<p>{PROSE}</p>" * 5 + "<p>Of.</p></div><div><span>Imprint</span></div></body>"
    assert text(page) == " ".join([PROSE] * 5 + ["Of."])


def test_open_tags_and_cut_pages():
    page = f"<article><p><b>{PROSE}<br><p>{PROSE}<p>End &am"
    assert text(page) == f"{PROSE} {PROSE} End &am"
    assert text(f"<article><p>{PROSE}</p><scr") == f"{PROSE} <scr"
    assert text("<article><p>x, y.<script>var a = 1") == "x, y."


@pytest.mark.parametrize(("page", "want"), [("", ""), ("  \n ", ""), ("plain, text &amp; more", "plain, text & more"), ("<br><hr>", ""), ("<p>one<p>two", "one two"),
                                            ("<nav>only, menu.</nav>", ""), ("a < b and c > d, so.", "a < b and c > d, so."), ("<P CLASS=AD>x, y.</P><P>keep, this.</P>", "keep, this.")])
def test_small_pages(page, want):
    assert text(page) == want


def test_long_pages_are_read_whole():
    page = "<article>" + f"<p>{PROSE}</p>" * 20000 + "</article>"
    assert len(text(page)) == 20000 * (len(PROSE) + 1) - 1


def test_table(spark):
    rows = spark.createDataFrame([(1, "u", PAGE, "c"), (1, "u", PAGE, "c"), (None, None, None, None), (3, "v", "", "c")], "page_id long, url string, html string, x string")
    got = html_paths.extract(rows)
    assert got.columns == ["page_id", "url", "x", "text"]
    assert [r["text"] != "" for r in got.orderBy("page_id").collect()] == [False, True, True, False]
    assert [(r["page_id"], r["n_chars"]) for r in html_paths.report(rows.limit(0)).collect()] == []
    assert {r["n_chars"] for r in html_paths.report(rows).collect()} == {0, len(text(PAGE))}
    with pytest.raises(ValueError):
        html_paths.extract(rows, name="url")


ITEM = "An item of the list, in two sentences. The second one, too, has a stop."
SECTIONS = f'<section class="intro"><p>{PROSE}</p></section><section class="body"><h2>Part</h2><p>{PROSE} {PROSE}</p><div><p>{PROSE}</p></div></section>'
ROWS = "<table>" + f"<tr><td>{ITEM}</td><td>7</td></tr>" * 20 + "</table>"
PARTS = {
    "list": (f"<h1>Title</h1><p>{PROSE}</p><ul>" + f"<li>{ITEM}</li>" * 20 + "</ul>", " ".join(["Title", PROSE, *[ITEM] * 20])),
    "table": (f"<h1>Title</h1><p>{PROSE}</p>{ROWS}<p>End.</p>", " ".join(["Title", PROSE, *[f"{ITEM} 7"] * 20, "End."])),
    "lead": (f"<h1>Title</h1><p>{PROSE}</p><section>" + f"<p>{PROSE}</p>" * 6 + "<p>End.</p></section>", " ".join(["Title", *[PROSE] * 7, "End."])),
    "sections": (f"<h1>Title</h1>{SECTIONS}", " ".join(["Title", PROSE, "Part", *[PROSE] * 3])),
}


@pytest.mark.parametrize("part", PARTS)
@pytest.mark.parametrize("around", ["article", "main", "div", 'div id="story"'])
def test_parts_of_an_article_are_kept_whole(part, around):
    page, want = PARTS[part]
    menu = "".join(f"<div><div>Menu {k}</div></div>" for k in range(8))
    shut = around.split()[0]
    assert text(f"<body><div>{menu}</div><{around}>{page}</{shut}><div><span>Imprint</span></div></body>") == want


def test_parts_right_in_the_body_are_kept():
    menu = "".join(f"<div><div>Menu {k}</div></div>" for k in range(8))
    page = f"<body><div>{menu}</div><h1>Title</h1><p>{PROSE}</p><p>{PROSE}</p><ul><li>one<li>two</ul>{SECTIONS}<div><span>Imprint</span></div></body>"
    assert text(page) == " ".join(["Title", PROSE, PROSE, "one", "two", PROSE, "Part", *[PROSE] * 3])


def test_columns_of_a_layout_table_are_told_apart():
    menu = "".join(f"<div>Menu {k}</div>" for k in range(8))
    assert text(f"<table><tr><td>{menu}</td><td><h2>Title</h2>" + f"<p>{PROSE}</p>" * 4 + "<p>Of.</p></td></tr></table>") == " ".join(["Title", *[PROSE] * 4, "Of."])


@pytest.mark.parametrize("names", ["single no-sidebar", "right-sidebar has-banner", "search-results", "header"])
@pytest.mark.parametrize("tag", ["html", "body", "main", "article", "div"])
def test_names_of_the_whole_page_set_nothing_aside(tag, names):
    story = f"<h1>Title</h1><p>{PROSE}</p><p>{PROSE}</p><p>Of.</p><div class=ad>Buy, now. Really, now.</div><div id=comments><p>{PROSE} I said, so.</p></div>"
    page = f"<html><body><div>Menu</div><main><article>{story}</article></main><footer>Site, all rights.</footer></body></html>"
    page = f'<html><body><div class="{names}">{page[12:-14]}</div></body></html>' if tag == "div" else page.replace(f"<{tag}>", f'<{tag} class="{names}">')
    assert text(page) == f"Title {PROSE} {PROSE} Of."


def test_a_wrapper_without_an_article_is_judged_by_its_ratios():
    menu = "".join(f"<div><div>Menu {k}</div></div>" for k in range(8))
    page = f'<body><div id="page" class="left-sidebar"><div>{menu}</div><div>' + f"<p>{PROSE}</p>" * 5 + f'<p>Of.</p></div><div class="comments"><p>{PROSE}</p></div></div></body>'
    assert text(page) == " ".join([*[PROSE] * 5, "Of."])


def test_many_comments_do_not_replace_a_short_article():
    comments = "<div id=comments>" + f"<p>{PROSE} I said, so.</p>" * 50 + "</div>"
    assert text(f"<article><p>{PROSE}</p></article>{comments}") == PROSE
    assert text(f"<div id=post><h1>Title</h1><p>{PROSE}</p></div>{comments}") == f"Title {PROSE}"


@pytest.mark.parametrize("names", ["comment-body", "comment", "related-card", "teaser", "reply comment depth-2"])
def test_articles_that_are_comments_or_teasers(names):
    page = f'<main><article><h1>Title</h1><p>{PROSE}</p></article><div><article class="{names}"><p>{PROSE} I said, so.</p></article></div></main>'
    assert text(page) == f"Title {PROSE}"


def test_opinions_of_readers():
    page = f'<main><article><h1>Title</h1><p>{PROSE}</p></article><div class="user-opinions"><p>{PROSE} I said, so.</p></div></main>'
    assert text(page) == f"Title {PROSE}"
    assert text(f'<main><article class="opinion"><h1>Title</h1><p>{PROSE}</p></article></main>') == f"Title {PROSE}"


def test_names_of_inline_elements_say_nothing():
    assert text(f'<article><p>One <span class="search-hit">word</span> here, so. <a class="ad" href=x>{PROSE}</a></p></article>') == f"One word here, so. {PROSE}"


SECTION = f"<h2>Part</h2><p>{PROSE}</p><p>{PROSE} {PROSE}</p>"


@pytest.mark.parametrize("names", ["share-price", "related-work", "comment-on-policy", "cookie-recipe", "search", "navigation", "category-ads", "comments-open"])
def test_sections_of_the_article_with_names_like_furniture_stay(names):
    assert text(f'<article><h1>Title</h1><p>{PROSE}</p><section class="{names}">{SECTION}</section><p>End.</p></article>') == f"Title {PROSE} Part {PROSE} {PROSE} {PROSE} End."


@pytest.mark.parametrize(("names", "inner"), [
    ("share-buttons", "<ul><li>Here<li>There</ul>"), ("social", "<p>Follow us here, there, and on.</p>"), ("ad-slot-2", f"<p>{PROSE}</p>"), ("comments", SECTION),
    ("related-posts", SECTION), ("cookie-notice", f"<p>{PROSE}</p>"), ("story-share-tools", "<a>Here</a> <a>There</a>"), ("newsletter-signup", f"<h3>Mail</h3><p>{PROSE}</p>")])
def test_furniture_inside_the_article_goes(names, inner):
    assert text(f'<article><h1>Title</h1><p>{PROSE}</p><div class="{names}">{inner}</div><p>{PROSE}</p><p>End.</p></article>') == f"Title {PROSE} {PROSE} End."


@pytest.mark.parametrize("around", ["article", "main", "div"])
@pytest.mark.parametrize("tag", ["nav", "header", "aside", "footer"])
def test_elements_left_open_do_not_take_the_page_along(tag, around):
    page = f"<body><{tag}><ul><li>Home<li>News</ul><{around}><h1>Title</h1>" + f"<p>{PROSE}</p>" * 4 + f"<p>Of.</p></{around}><div><span>Imprint</span></div></body>"
    assert text(page) == " ".join(["Title", *[PROSE] * 4, "Of."])


def test_a_form_around_the_page():
    assert text(f"<body><form id=f><div>Menu</div><main><h1>Title</h1><p>{PROSE}</p><form><label>Name, please.</label></form></main></form></body>") == f"Title {PROSE}"
    assert text("<form><label>Name, please.</label></form>") == ""


def test_marks_in_attributes():
    assert text(f"""<article><p title="a > b" data-x='>'>{PROSE}</p><p data-x=it's>{PROSE}</p><p title="open>{PROSE}</p></article>""") == " ".join([PROSE] * 3)
    assert text(f"<article><p>{PROSE}<svg/>{PROSE}</p></article>") == PROSE * 2


@pytest.mark.parametrize("page", ["<div>" * 20000, "<div>x, y." * 20000, '<a "' * 20000, '<a "' * 20000 + '" > "', '<a x="' * 20000 + '">"', "<script " * 10000, "<!-" * 30000,
                                  "<div>" * 20000 + "</x></b>" * 20000, "<table><tr><td><table>" + "<div>" * 20000 + "<tr></tr>" * 20000])
def test_time_grows_with_the_page(page):
    took = []
    for part in (page, page * 4):
        start = time.process_time()
        text(part)
        took.append(time.process_time() - start)
    assert took[1] < 10 * took[0] + 2  # sixteen times and many seconds if it grew with the square
