from __future__ import annotations

import html
import re

from histora.llm.html_text import extract_main_text, main_text

PAGE = """<html><head><title>x</title><script>var a="<p>no</p>";</script></head><body class="home"><header><a href=/>Site</a></header>
<div id="sidebar">side text, here.</div><div class="cookie-notice">We use cookies.</div><main><article><header><h1>Head &amp; line</h1>
</header><p>One <b>two</b>three&nbsp;x.<p>Second <a href=x>link</a> par.<div class="ad-slot">Buy now!</div><form><label>Name</label></form>
<ul><li>item one<li>item two</ul><!-- <p>not this</p> --></article><section class="comments"><p>Great post, a really long comment, indeed, thanks
a lot, more, more, more.</p></section></main><footer>(c)</footer></body>"""


def test_boilerplate_is_left_out():
    assert main_text(PAGE) == "Head & line One twothree x. Second link par. item one item two"


def test_without_an_article_the_paths_decide():
    page = ("<body><div class=top><a href=a>Home</a> <a href=b>News</a></div><div class=body>" +
            "".join(f"<p>Paragraph {i}, with some words, and more of them.</p>" for i in range(6)) +
            "</div><div class=x><a href=1>one</a><a href=2>two</a></div></body>")
    assert main_text(page) == " ".join(f"Paragraph {i}, with some words, and more of them." for i in range(6))


def test_cut_off_and_broken_markup():
    assert main_text("<article><p>a <b>b<br><p>c &amp; d &lt;e&gt; <i>f") == "a b c & d <e> f"
    assert main_text("<article><p>text <a href='x") == "text"
    assert main_text("<article><p>1 < 2 and 3 > 2") == "1 < 2 and 3 > 2"
    assert main_text("<article><p>a</b></div></p>b<script>x") == "a b"
    assert main_text("plain  text\n only") == "plain text only"
    assert main_text("<!-- never closed <p>x") == "" and main_text("<") == "<"
    assert main_text("<p>" * 3000 + "x") == "x"


def test_rows(spark):
    rows = [(1, "u", None, "t"), (2, None, "", "t"), (3, "u", PAGE, "t"), (3, "u", PAGE, "t")]
    got = extract_main_text(spark.createDataFrame(rows, "page_id bigint, url string, html string, text string")).collect()
    assert sorted((r["page_id"], r["text"], r["n_chars"]) for r in got) == sorted(
        [(1, "", 0), (2, "", 0)] + 2 * [(3, main_text(PAGE), len(main_text(PAGE)))])
    assert extract_main_text(spark.createDataFrame([], "page_id bigint, url string, html string")).count() == 0


def test_articles_of_the_given_pages(spark):
    """Brute force: on these pages the article element is the main text."""
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    given = {r["page_id"]: r["html"] for r in pages.collect()}
    for r in extract_main_text(pages).collect():
        page = given[r["page_id"]]
        body = page[page.index("<article>") + 9:].split("</article>")[0]
        body = re.sub(r"<[a-zA-Z/!][^>]*(?:>|$)", lambda m: " " if re.match(r"</?(p|h1|br)\b", m[0]) else "", body)
        assert r["text"] == " ".join(html.unescape(body).split())


STORY = " ".join(f"Paragraph {i}, with some words, and more of them." for i in range(20))
DIVS = "".join(f"<p>Paragraph {i}, with some words, and more of them.</p>" for i in range(20))


def test_a_teaser_article_does_not_hide_the_story():
    teaser = "<article><h2>Teaser</h2><p>Read on.</p></article>"
    assert main_text(f"<body><div class=story>{DIVS}</div>{teaser}</body>") == STORY
    cards = "".join(f"<article><p>{p}</p></article>" for p in re.findall("<p>(.*?)</p>", DIVS))
    assert main_text(f"<body>{cards}<div>x</div></body>") == STORY


def test_an_open_head_ends_where_the_body_begins():
    for start in ("<body>", "<div>", ""):
        assert main_text(f"<html><head><title>t</title><meta charset=x>{start}{DIVS}</html>") == STORY
    assert main_text("<head><title>t</title>text, at once") == "text, at once"


def test_names_and_forms_do_not_drop_most_of_the_page():
    assert main_text(f"<body><form id=aspnetForm>{DIVS}<input><button>Go</button></form></body>") == STORY
    assert main_text(f"<body><div class='page has-sidebar'>{DIVS}<div class=sidebar>Side, text.</div></div></body>") == STORY
    teaser = "<article><p>Read on.</p></article>"
    assert main_text(f"<body><div class=promo>{DIVS}</div>{teaser}</body>") == STORY
    assert main_text("<p>one<span class=ad>x</span> <b>two</b></p><p>More words, of the page.</p>") == "one two More words, of the page."


LOREM = "Lorem ipsum dolor sit amet, consectetur adipiscing elit, sed do eiusmod. " * 3


def test_an_article_beside_an_intro_is_the_text():
    page = f"<body><div>Welcome to our site, we sell things.</div><article><h1>T</h1><p>{LOREM}</p></article></body>"
    assert main_text(page) == f"T {LOREM}".strip()


def test_an_unnamed_menu_is_no_text():
    menu = "<ul><li>Home</li><li>About</li><li>Contact us</li></ul>"
    for before, after in ((menu, ""), ("", menu), (menu, menu)):
        assert main_text(f"<body>{before}<h2>A heading</h2>{DIVS}{after}</body>") == f"A heading {STORY}"
        assert main_text(f"<body>{before}<div><h2>A heading</h2>{DIVS}</div>{after}</body>") == f"A heading {STORY}"
    middle = DIVS.replace("<p>Paragraph 9,", "<h3>Half way</h3><ul><li>one</li></ul><p>Paragraph 9,")
    assert main_text(f"<body>{menu}{middle}</body>") == STORY.replace("Paragraph 9,", "Half way one Paragraph 9,")


def test_long_and_deep_pages_take_linear_time():
    import time
    used = []
    for n in (4_000, 16_000):
        start = time.process_time()
        assert main_text("<div>a" * n).count("a") >= 0.9 * n      # the deepest element with that share of the weight
        assert main_text("<div class=ad><p>a" * n + "</section></i>" * n) is not None
        assert len(main_text(f"<p>{LOREM}</p>" * n)) == n * len(LOREM) - 1
        used.append(time.process_time() - start)
    assert used[1] < 10 * max(used[0], 0.2) and used[1] < 30
