import time

import pytest

from parcelstar.llm.html_extraction import BAD, GOOD, NEAR, SHORT, blocks, main_text, op3_html_extraction, second_pass

LONG = (
    "This is the first paragraph of the text that we want to have, and it is long enough to be sure that it is "
    "the one that we need, with all of the words in it; it goes on and on for some more time so that it counts."
)
AROUND = (
    "<html><head><title>T</title><style>p {{}}</style></head><body><header><h1>Site</h1><a href=/>Home</a></header>"
    "<nav><ul><li><a href=1>One</a><li><a>Two</a></ul></nav><div class='cookie-notice'>We use cookies on this site.</div>"
    "<!-- <p>no</p> --><div class=ad>Buy it now, it is the best of all</div>{}<aside><p>" + LONG + "</p></aside>"
    "<div id=comments><article><p>I do not agree.</p></article></div><form><p>Name</p><input></form>"
    "<footer>&copy; 2024 <a>imprint</a></footer><script>if (a<b) w('<p>no</p>')</script></body></html>"
)


def test_an_article_is_kept_whole():
    article = (
        "<article><header><h1>A &amp; B</h1></header><p>One.<p><b>Two <br>lines<p>5 < 6 &nbsp; &lt;ok&gt;</p>"
        "<ul><li>x<li>y</ul><script>no()</script><div class=share>Share it</div><p>$$$ *** ###</p></article>"
    )
    assert main_text(AROUND.format(article)) == "A & B\nOne.\nTwo lines\n5 < 6 <ok>\nx\ny\n$$$ *** ###"


def test_blocks_without_marked_article():
    body = f"<div><h2>A heading</h2><p>{LONG}<p>Short.</p><p>{LONG}</div>"
    assert main_text(AROUND.format(body)) == f"A heading\n{LONG}\nShort.\n{LONG}"


def test_prose_beside_marked_teasers_is_kept():
    cards = "".join(f"<article><h3><a href={i}>Story number {i}</a></h3><p>Read on.</p></article>" for i in range(3))
    body = f"<div><h1>A title</h1><p>{LONG}</p><p>Short.</p><p>{LONG}</p></div>"
    assert main_text(AROUND.format(body + cards)) == f"A title\n{LONG}\nShort.\n{LONG}"
    assert main_text(AROUND.format(f"<div id=main>{cards}</div><p>{LONG}</p><p>Short.</p>")) == f"{LONG}\nShort."


def test_both_passes_run_inside_articles():
    links = "".join(f"<li><a href={i}>A story of the day, number {i}</a>" for i in range(3))
    table = "<p>" + "x1 = 0x2f; " * 20 + "</p>"
    article = f"<article><h1>T</h1><p>{LONG}</p>{table}<p>See <a>it</a> there.</p><h2>More</h2><p>On:</p><ul>{links}</ul></article>"
    shown = f"T\n{LONG}\n{('x1 = 0x2f; ' * 20).strip()}\nSee it there."
    assert main_text(AROUND.format(article)) == shown


def test_an_article_of_links_alone_is_kept():
    page = "<article><h1>Links</h1><p><a>One story</a></p><p><a>Two</a></p></article>"
    assert main_text(AROUND.format(page)) == "Links\nOne story\nTwo"


@pytest.mark.parametrize(
    "text",
    [
        "Мы живём в большом городе, где каждый день происходит что-то новое, и люди рассказывают об этом друг другу. " * 2,
        "我们住在一个很大的城市里，每天都有新的事情发生，人们互相讲述这些故事，晚上大家一起回家吃饭。",
        "Nós vivemos numa cidade grande, com gente boa; hoje acontece algo novo, todos falam disso, amanhã virá outra história.",
    ],
)
def test_other_languages_are_judged_by_length_and_links(text):
    links = "<ul>" + "".join(f"<li><a href={i}>{text[:30]} {i}</a>" for i in range(4)) + "</ul>"
    page = f"<body>{links}<p>{text}</p>{links}<p>{text}</p>{links}</body>"
    assert main_text(page) == f"{text.strip()}\n{text.strip()}"


def test_tables_and_code_of_a_good_page_are_kept():
    code = "x1 = 0x2f; " * 20
    links = "<p>" + f"<a href=x>{code}</a></p><p>{code[:80]}</p><p><a href=x>{code}</a></p>"
    assert main_text(f"<body><p>{LONG}</p><pre>{code}</pre><p>{LONG}</p>{links}</body>") == f"{LONG}\n{code.strip()}\n{LONG}"


def test_link_lists_go():
    links = "<div>" + "".join(f"<p><a href={i}>A story of the day, number {i}</a></p>" for i in range(5)) + "</div>"
    assert main_text(f"<body><p>{LONG}</p>{links}</body>") == LONG


def test_undecided_blocks_follow_the_nearest_decided():
    assert second_pass([GOOD, SHORT, SHORT, BAD]) == [True, True, False, False]
    assert second_pass([GOOD, SHORT, BAD, GOOD, NEAR, BAD]) == [True, False, False, True, True, False]
    assert second_pass([SHORT, BAD, SHORT]) == [False, False, False]
    assert second_pass([SHORT, NEAR]) == [True, True]
    assert second_pass([]) == []


@pytest.mark.parametrize(
    "page, text",
    [
        ("<p>x</p", "x"), ("a<b", "a"), ("<", "<"), ("a < b", "a < b"), ("<p title=it's>ok</p>", "ok"), ("</", "</"),
        ("<script>", ""), ("<![CDATA[ x & y", "x & y"), ("<!-- x", ""), ("&#x41;&#66;&bogus;&amp", "AB&bogus;&"),
        ("<td><td></tr></table>t</p></p>", "t"), ("<p hidden>x</p>y", "y"), ("<p>a<span>b</span>c</p>", "abc"),
        ("<P>Up<BR/>down</P>", "Up down"), ("<p>é\xa0 z", "é z"),
    ],
)
def test_broken_markup(page, text):
    assert main_text(page) == text


@pytest.mark.parametrize(
    "wrapped",
    [
        "<div class='content has-sidebar'>{}</div>",
        "<article class='post comments-open'>{}</article>",
        "<main class='with-sidebar'>{}</main>",
        "<main><section id=search-algorithms>{}</section></main>",
        "<form id=aspnetForm>{}</form>",
        "<form><article>{}</article></form>",
        "<body class='comments related'>{}</body>",
        "<div class='content-sidebar-wrap'><main>{}</main></div>",
        "<div class=paywall><div class=widget>{}</div></div>",
        "<div class=search-page>{}</div>",
        "<div data-hidden=1 class='mt-4 hidden-xs md:block'>{}</div>",
    ],
)
@pytest.mark.parametrize(
    "around",
    [
        "{}",
        "<nav><a>One</a><p>Two</p></nav>{}<footer>&copy; 2024</footer>",
        "<div class='cookie-notice'><p>" + LONG + "</p></div>{}",
        "{}<div id=comments><article><p>" + LONG + "</p></article><p>" + LONG * 5 + "</p></div>",
        "<div class='sidebar widget-area'><p>Follow us on the web, and see what is new with us in the world.</p></div>{}",
        "{}<div class='related-posts'><h3>More</h3><p><a>Another story of the day</a></p></div><aside>x</aside>",
    ],
)
def test_names_are_evidence_only(wrapped, around):
    """66 pages: 11 ways to hold an article, 6 to put something around it."""
    article = f"<h1>A title</h1><p>{LONG}</p><p>Short.</p><p>{LONG} Some <a title='a hidden gem'>linked</a> words.</p>"
    inner = wrapped.format(article)
    page = inner if around == "{}" else around.format(inner)
    assert main_text(page) == f"A title\n{LONG}\nShort.\n{LONG} Some linked words."


def test_parts_of_an_article_with_telling_names():
    body = "<section id=related-work><h2>Related work</h2><p>{0}</p></section><div class='post-share'>Share</div><p hidden>{0}</p>"
    assert main_text(f"<article><p>{LONG}</p>{body.format(LONG)}</article>") == f"{LONG}\nRelated work\n{LONG}"
    gone = ["class=cookieNotice", "class='x ad-banner'", "id=comment-list", "role=complementary", "style='display: none'", "aria-hidden=true", "class=newsletter"]
    rest = "".join(f"<div {name}><p>{LONG}</p></div>" for name in gone)
    assert main_text(f"<div><p>{LONG}</p><p>{LONG}</p></div>{rest}") == f"{LONG}\n{LONG}"


def test_unmatched_end_tags_take_linear_time():
    for page in ("<div>" * 100_000 + "</p>" * 100_000, "<x>" * 50_000 + "<li>" * 50_000 + "</td>" * 50_000,
                 "<div class=menu>" * 50_000 + "x<p>" * 50_000):
        began = time.time()
        blocks(page)
        assert time.time() - began < 10


def test_long_pages_take_linear_time():
    for unit in ("<p>", "<div>", "<", '<a href="', "<!--", "<b class=x>", "&", "</p>", "<p>word "):
        began = time.time()
        blocks(unit * 100_000)
        assert time.time() - began < 10, unit


def test_query(spark):
    rows = [(1, "u", None), (2, None, ""), (3, "u", f"<p>{LONG}</p>"), (3, "u", f"<p>{LONG}</p>"), (None, "u", "<p>é</p>")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    clashing = pages.selectExpr("*", "1 AS text", "2 AS n_chars")
    got = sorted(map(tuple, op3_html_extraction(clashing).collect()), key=repr)
    text = {None: "", "": "", f"<p>{LONG}</p>": LONG, "<p>é</p>": "é"}
    assert got == sorted(((i, u, text[h], len(text[h])) for i, u, h in rows), key=repr)
    assert op3_html_extraction(pages.limit(0)).count() == 0
