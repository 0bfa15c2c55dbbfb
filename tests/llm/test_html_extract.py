import html as htmllib
import re

import pyarrow.parquet as pq

from dimstar.llm.html_extract import extract, extracted


def plain_article(page):
    """Brute force for pages made of nav, advert, article and footer: the article's blocks."""
    inner = re.search(r"<article>(.*)</article>", page, re.S).group(1)
    parts = re.split(r"<(?:h1|p)>", inner)
    blocks = []
    for part in parts:
        text = htmllib.unescape(re.sub(r"<[^>]*>", " ", part))
        text = re.sub(r"\s+", " ", text).strip()
        if text:
            blocks.append(text)
    return "\n\n".join(blocks)


def test_given_pages_as_by_brute_force():
    pages = pq.read_table("/root/testdata/sf0.01/pages.parquet").to_pandas()
    for page in pages["html"]:
        assert extract(page) == plain_article(page)


def test_boilerplate_goes_and_markup_is_repaired():
    page = (
        "<html><head><title>t</title><script>var x='<p>no</p>';</script></head><body>"
        "<header><a href=/>Home</a> Site name</header><div class='cookie-notice'>We use cookies</div>"
        "<aside>Sidebar text</aside><main><article><h2>T&amp;itle &#233;t&eacute;</h2>"
        "<p>One  two<br>three<p>four <b>bold <i>nested</p><ul><li>a<li>b</ul>"
        "<form><input value=x>Sign up now</form><section id='comments'><p>great post</p></section>"
        "<div class='related'><a href=1>r1</a> <a href=2>r2</a></div></article></main>"
        "<footer>(c) 2024</footer></body></html>"
    )
    assert extract(page) == "T&itle été\n\nOne two three\n\nfour bold nested\n\na\n\nb"


def test_edge_pages():
    assert extract(None) == "" and extract("") == "" and extract("<html><body></body></html>") == ""
    assert extract("plain text only") == "plain text only"
    assert extract("<div>" * 5000 + "deep text") == "deep text"
    long = "<p>" + " ".join(["word"] * 200_000) + "</p>"
    assert extract(long) == " ".join(["word"] * 200_000)


def test_query_rows(spark):
    rows = [
        (1, "http://a/x", "<body><article><p>Hello &lt;world&gt;</p></article></body>", "c"),
        (1, "http://a/x", "<body><article><p>Hello &lt;world&gt;</p></article></body>", "c"),
        (2, None, None, None),
        (None, "u", "<p>x</p>", "z"),
    ]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = sorted((tuple(r) for r in extracted(pages).collect()), key=str)
    assert got == sorted([
        (1, "http://a/x", "Hello <world>", 13), (1, "http://a/x", "Hello <world>", 13),
        (2, None, "", 0), (None, "u", "x", 1),
    ], key=str)
    assert extracted(pages.where("false")).count() == 0
