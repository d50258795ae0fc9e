"""Main text: hand-made pages, templates per host, awkward markup."""

from pyspark.sql import functions as F
from rateflow.llm import html_text as h

PAGES = "page_id long, url string, html string"
PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p><article>x";</script></head>
<body><header>Site</header><nav><ul><li><a href="/a">A</a></ul></nav><div class="cookie-notice">cookies</div>
<div class='ad top'>Buy</div><article><h1>Head &amp; line</h1><p><b>First <i>in</i>line<br>next &lt;b&gt; &eacute;&#x41;
<p>second&nbsp;&nbsp;one</p><ul><li>one<li>two</ul><aside>side</aside><form>mail <input></form>
<pre>  pre   text </pre><section class="comments"><p>nice!</p></section><!-- <p>gone</p> --></article>
<div id="comments"><article class="comment">me too</article></div><footer>&copy; x</footer></body></html>"""
TEXT = "Head & line First inline next <b> éA second one one two pre text"


def test_article_text():
    assert h.extract(PAGE) == TEXT


def test_page_without_article():
    page = "<body><nav>menu</nav><div id=sidebar>s</div><div class=content><h2>T</h2><p>a<p>b</div><p class='notice'>n</p></body>"
    assert h.extract(page) == "T a b"
    assert h.extract("plain & simple\n text") == "plain & simple text"


def test_awkward_markup():
    assert h.extract(None) == h.extract("") == h.extract("<") .replace("<", "") == ""
    assert h.extract("<article><p>cut off <b>he") == "cut off he"
    assert h.extract('<article><p>x <a href="y') == "x"
    assert h.extract("<p>a < b and c > d</p>") == "a < b and c > d"
    assert h.extract("</div></p><p>t</p></article>") == "t"
    assert h.extract("<P CLASS=x>Up<BR/>down</P>") == "Up down"
    assert h.extract("<article><p>&am &amp &amp;amp;</p></article>") == "&am & &amp;"
    assert h.extract("<div>" * 20_000 + "deep") == "deep"
    long = "word " * 60_000
    assert h.extract(f"<article><p>{long}</p></article>") == long.strip()
    assert h.extract("<script>never closed <p>x") == ""


def pages(spark, rows):
    return spark.createDataFrame(rows, PAGES).withColumn("host", F.lit("clash")).withColumn("keys", F.lit(1))


def test_templates_are_found_per_host(spark):
    rows = []
    for k in range(40):
        own = f"<p>story {k} of the day</p>"
        bar = "<div class=x7><a href='/s?{}'>Follow the feed</a></div>".format(k)
        rows.append((k, f"http://WWW.a.org/{k}", f"<body>{bar}<div>{own}</div></body>"))
        rows.append((100 + k, f"http://b.org/{k}", f"<body>{bar if k < 5 else ''}<div>{own}</div></body>"))
        # An article's recurring passage is text, its recurring group is template.
        rows.append((200 + k, f"//c.org/{k}", f"<article>{own}<p>shared passage</p><ul><li>More</ul></article>"))
        rows.append((300 + k, "http://d.org/same", f"<body>{bar}<div><p>copied page</p></div></body>"))
    got = {r.page_id: r for r in h.extract_pages(pages(spark, rows)).collect()}
    for k in range(40):
        assert got[k].text == f"story {k} of the day"
        assert got[100 + k].text == ("Follow the feed " if k < 5 else "") + f"story {k} of the day"
        assert got[200 + k].text == f"story {k} of the day shared passage"
        assert got[300 + k].text == "Follow the feed copied page"  # copies of one page are no template
        assert got[k].n_chars == len(got[k].text)


def test_joined_removal_lists_give_the_same(spark, monkeypatch):
    rows = [(k, "http://a.org/", f"<body><div>bar</div><p>story {k}</p></body>") for k in range(30)]
    shipped = sorted(map(tuple, h.extract_pages(pages(spark, rows)).collect()))
    monkeypatch.setattr(h, "BROADCAST_BYTES", -1)
    assert sorted(map(tuple, h.extract_pages(pages(spark, rows)).collect())) == shipped
    assert shipped[0][2] == "story 0"


def test_awkward_rows(spark):
    rows = [(1, None, None), (2, "u", ""), (None, "http://x/", PAGE), (3, "http://x/", PAGE), (3, "http://x/", PAGE)]
    got = sorted((r.page_id or -1, r.url, r.text, r.n_chars) for r in h.extract_pages(pages(spark, rows)).collect())
    assert got == [(-1, "http://x/", TEXT, len(TEXT)), (1, None, "", 0), (2, "u", "", 0),
                   (3, "http://x/", TEXT, len(TEXT)), (3, "http://x/", TEXT, len(TEXT))]
    assert h.extract_pages(pages(spark, [])).collect() == []


def test_wrappers_and_headings_of_the_article_stay():
    from rateflow.llm.html_text import extract
    article = "<article><h1>T</h1><p>real text</p></article>"
    for page in (f"<body><form id=aspnetForm>{article}</form>", f"<div class='layout has-sidebar'>{article}</div>",
                 f"<body><nav><a>x</a>{article}", f"<aside><p>x</p>{article}<nav><a>y</a></nav>", f"<form><input>{article}",
                 f"<main><div class='has-sidebar'>{article}</div></main>"):
        assert extract(page) == "T real text", page
    inside = ("<article><div class='entry-header'><h1>T</h1></div><h2 id='related-work'>R</h2><p>a</p><h2 id='search'>S</h2>"
              "<h2 class='section-header'>H</h2><p id='notice-period'>b</p><p class='ad'>buy</p><section id='related-work'>c</section>"
              "<div class='share'>tweet</div></article>")
    assert extract(inside) == "T R a S H b c"
    assert extract(f"{article}<div class='related'><article><p>card</p></article></div>") == "T real text"
    assert extract(f"{article}<aside><article><p>card</p></article></aside>") == "T real text"
