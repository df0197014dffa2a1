"""Page operators: extraction rules and url judgement."""

import html
import time

from martlet.llm import urls
from martlet.llm._io import table
from martlet.llm.html import BAD, GOOD, OPEN, extracted_pages, main_text, second_pass
from tests.conftest import SF_CHECK

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p><p>x";</script></head><body>
<header><h2>Site name</h2></header><nav><ul><li><a href="/">Home</a></li></ul></nav><div class="ad">Buy now!</div>
<div id="cookie-notice">We use cookies</div>
<article><h1>Title &amp; more</h1><p>First  <b>bold</b>
line<br>goes on &#233;&nbsp;here.<p>Second <i>line</i><div class="ad-slot sponsored">Ad</div>
<ul><li>one<li>two</ul><form><input><label>Mail</label></form><!-- <p>no</p> --></article>
<aside>Side</aside><section class="comments"><article><p>I say the of and to in is it</p></article></section>
<footer>&copy; all</footer></body></html>"""


def test_article_without_boilerplate():
    assert main_text(PAGE).split("\n") == ["Title & more", "First bold line goes on é here.", "Second line", "one", "two"]


def test_odd_pages():
    assert main_text("") == "" and main_text("<html><body><nav>a</nav></body></html>") == ""
    assert main_text("<article><p>open <b>end") == "open end"
    assert main_text("<article><p>a &lt;b&gt; &amp;amp; c</p></article></div></p>") == "a <b> &amp; c"


def test_names_of_layouts_do_not_hide_the_article():
    for page in (
        "<div class='layout has-sidebar'><article><p>text</p></article></div>",
        "<article class='post comments-open'><p>text</p></article>",
        "<div class='no-sidebar'><main class='with-nav'><p>text</p></main></div><div class='ad-slot'>buy</div>",
        "<div id='page-with-menu'><div class='entry-content share-on'><p>text</p></div><div class='cookie-notice'>ok</div></div>",
    ):
        assert main_text(page) == "text", page
    assert main_text("<article><p>text</p></article><div class='comments'><article><p>I say</p></article></div>") == "text"


BODY = "<article><p>the text of it</p></article>"


def test_comments_and_related_cards_stay_out():
    for page in (
        BODY + "<section class='comments-area'><article class='comment-body'><p>I say " + "so " * 90 + "</p></article></section>",
        BODY + "<div class='related-posts'><article><p>Another story</p></article></div>",
        "<article><p>the text of it</p><ol class='commentlist'><li>I say so</li></ol></article>",
        "<article><p>the text of it</p><p style='color:red; display: none'>hidden</p></article>",
        "<div class='has-sidebar'>" + BODY + "<div class='sidebar-left'><article><p>card</p></article></div></div>",
        "<main>" + BODY + "<div id='comments'><article class='comment'>I say</article><article>me too</article></div></main>",
        BODY + "<article class='related-post'><p>card</p></article>",
    ):
        assert main_text(page) == "the text of it", page


def test_wrappers_do_not_empty_a_page():
    prose = "the cat and the dog went to the house of the man and it was in the garden for all of them to see " * 3
    for page in (
        "<form id='all'><input>" + BODY + "</form>",
        "<div class='widget'>" + BODY + "</div><div class='widget'>Buy</div>",
        "<div class='single comments-open'>" + BODY + "</div>",
        "<div class='comments'>" + BODY + "</div>",
    ):
        assert main_text(page) == "the text of it", page
    assert main_text(f"<form><p>{prose}</p><select><option>x</option></select></form>") == prose.strip()
    assert main_text(f"<p>{prose}</p><form><p>{prose}</p></form>") == prose.strip()


def test_pages_outside_the_stop_list():
    chinese = "\u6211\u4eec\u5728\u8fd9\u91cc\u8bb2\u4e00\u4e2a\u6545\u4e8b\u3002" * 4
    assert main_text(f"<body><nav>\u83dc\u5355</nav><p>{chinese}</p><p><a href='/'>\u94fe\u63a5</a></p></body>") == chinese
    italian = "Questa notte abbiamo visto molte stelle sopra le montagne, poi siamo tornati verso casa cantando."
    assert main_text(f"<body><p>{italian}</p><footer>Fine</footer></body>") == italian
    assert main_text("<body><p>Loading</p></body>") == ""


def test_work_is_linear_in_tags():
    n = 100_000
    for page in (
        "<div>" * n + "</p>" * n, "<b>" * n + "</i>" * n, "<u><div>" + "<b>" * n + "</u>" * n,
        "<div class='menu'>" * n + "x" + "</div>" * n, "<article class='share'>" * n + "x", "<i>" * n + "<p>x" * n,
    ):
        start = time.process_time()
        main_text(page)
        assert time.process_time() - start < 10


def test_links_inside_an_article():
    page = """<article><h1><a href='/a'>Title</a></h1><p><a href='/b'>mostly a link</a> here</p>
<ul><li><a href='/1'>one</a></li><li><a href='/2'>two</a></li></ul>
<ul><li>plain entry of some words</li><li><a href='/3'>linked</a></li></ul></article>"""
    assert main_text(page).split("\n") == ["Title", "mostly a link here", "plain entry of some words", "linked"]
    assert main_text("<ul><li><article><h2><a href='/a'>Title</a></h2></article></li></ul>") == "Title"


def test_rules_without_an_article():
    prose = "the cat and the dog went to the house of the man and it was in the garden for all of them to see " * 3
    page = f"<body><p>Short one</p><p>{prose}</p><p>Next to it</p><p>Near the links</p><p><a href='/x'>many links here</a> <a>and more</a></p></body>"
    lines = main_text(page).split("\n")
    assert lines == ["Short one", prose.strip(), "Next to it"]


def test_open_blocks_take_the_nearest_label():
    assert second_pass([OPEN, GOOD, OPEN, OPEN, BAD, OPEN]) == [GOOD, GOOD, GOOD, BAD, BAD, BAD]
    assert second_pass([GOOD, OPEN, BAD]) == [GOOD, BAD, BAD]
    assert second_pass([OPEN]) == [BAD] and second_pass([]) == []


def test_given_pages_give_their_documents(spark):
    docs = {r["doc_id"]: r["text"] for r in table(spark, SF_CHECK, "documents").select("doc_id", "text").collect()}
    pages = table(spark, SF_CHECK, "pages")
    heads = {r["page_id"]: r["html"].split("<h1>")[1].split("</h1>")[0] for r in pages.collect()}
    rows = extracted_pages(pages).collect()
    assert len(rows) == pages.count()
    for r in rows:
        number = int("".join(c for c in r["url"].split("/")[4].split("?")[0].split("#")[0] if c.isdigit()))
        lines = [html.unescape(heads[r["page_id"]]), *docs[number].split("\n")]
        assert r["text"] == "\n".join(x for x in (" ".join(line.split()) for line in lines) if x)
        assert r["n_chars"] == len(r["text"])


def test_extraction_of_null_and_repeated_pages(spark):
    df = spark.createDataFrame(
        [(1, None, None, "x"), (2, "u", "", "x"), (3, "u", PAGE, "x"), (3, "u", PAGE, "x"), (None, "u", "<p", "x")],
        "page_id long, url string, html string, text string",
    )
    rows = extracted_pages(df).collect()
    assert len(rows) == 5 and sorted(r["n_chars"] for r in rows) == [0, 0, 0] + [rows_n(PAGE)] * 2
    assert extracted_pages(df.limit(0)).count() == 0


def rows_n(page):
    return len(main_text(page))


URLS = [
    ("http://example.org/es/1", "example.org", "/es/1", "example.org/es/", "block"),
    ("http://A.Example.ORG/en/12?x#y", "a.example.org", "/en/12", "example.org/en/1", "block"),
    ("https://example.org/en/2", "example.org", "/en/2", "org/", "allow"),
    ("https://badexample.org/es/", "badexample.org", "/es/", "org/", "allow"),
    ("https://x.com/de/a", "x.com", "/de/a", "com/de/", "block"),
    ("https://x.com/fr/", "x.com", "/fr/", "com/fr/", "allow"),
    ("https://x.com/fr", "x.com", "/fr", None, "allow"),
    ("https://org", "org", "", None, "allow"),
    ("mailto:a@b", "", "", None, "allow"),
    ("x://h?/es/", "h", "", None, "allow"),
    ("É://ÀB.com://c", "Àb.com:", "//c", None, "allow"),
    (None, "", "", None, "allow"),
]


def url_frames(spark):
    rows = [(i, u, "<p>") for i, (u, *_) in enumerate(URLS)]
    rows += [(100 + i, f"http://spam.example.net/en/{500 + i}", None) for i in range(40)]
    rows += [(200 + i, f"http://fine.example.net/en/{600 + i}", None) for i in range(40)] + [(None, None, None)]
    marks = [(500 + i, 0, 0) for i in range(30)] + [(600 + i, 1, 0) for i in range(30)] + [(600, None, 1), (None, 0, 0)]
    return (
        spark.createDataFrame(rows, "page_id long, url string, html string"),
        spark.createDataFrame(marks, "doc_id long, quality int, toxic int"),
    )


def test_rules_and_reputation(spark):
    pages, labels = url_frames(spark)
    got = {r["page_id"]: tuple(r)[1:] for r in urls.judged_pages(pages, labels).collect()}
    for i, (_, *want) in enumerate(URLS):
        assert got[i] == tuple(want)
    assert {got[i][3] for i in range(100, 140)} == {"block"} and {got[i][3] for i in range(200, 240)} == {"allow"}


def test_urls_without_outcomes(spark):
    pages, labels = url_frames(spark)
    got = urls.judged_pages(pages, labels.limit(0)).filter("rule is null").select("verdict").distinct().collect()
    assert [r["verdict"] for r in got] == ["allow"]
    assert urls.judged_pages(pages.limit(0), labels).count() == 0
