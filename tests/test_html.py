from urllib.parse import urljoin

import pytest
from pyspark.sql import functions as F

from newsloom.functions import html as H
from newsloom.plans import ingest

PAGES = {
    "article wins": ('<body><div class="content">no</div><article><p>yes</p></article></body>',
                     "<article><p>yes</p></article>"),
    "class order": ('<body><div class="content">c</div><div class="x post-content">p</div></body>',
                    '<div class="x post-content">p</div>'),
    "nested div": ('<body><div class="entry-content"><div>a</div>b</div>c</body>',
                   '<div class="entry-content"><div>a</div>b</div>'),
    "main": ("<body><nav>n</nav><main>m<footer>f</footer>tail</main></body>", "<main>mtail</main>"),
    "role": ('<body><div role="main">r</div></body>', '<div role="main">r</div>'),
    "body": ("<html><body><script>var a='</div>'</script>text<header>h</header></body></html>", "<body>text</body>"),
    "none": ("no markup at all", None),
    "two articles": ("<body><article>1</article><article>2</article></body>", "<article>1</article>"),
    "nested article": ("<body><article>1<article>2</article>3</article></body>",
                       "<article>1<article>2</article>3</article>"),
    "commented": ("<body><!-- <article>x</article> --><article>y<script>z</script></article></body>",
                  "<article>y</article>"),
    "nested header": ("<article>a<header>b<header>c</header>d</header>e</article>", "<article>ae</article>"),
    "article in header": ("<body><header><article>in</article></header>out</body>", "<article>in</article>"),
    "unclosed": ("<body><article><p>open", "<article><p>open"),
}


def test_main_element(spark):
    rows = [(name, "https://a.vn/b", page) for name, (page, _) in PAGES.items()]
    pages = spark.createDataFrame(rows, "page_id string, url string, html string")
    found = {r.page_id: r.main_html for r in ingest.extract_bodies(pages).collect()}
    assert found == {name: wanted for name, (_, wanted) in PAGES.items()}


def test_native_and_parsed_paths_agree(spark):
    rows = [(n, "u", p) for n, (p, _) in PAGES.items()]
    pages = spark.createDataFrame(rows, "page_id string, url string, html string")
    clean = H.without_noise(F.col("html"))
    native = pages.where(H.is_plain(clean, H.article_of(clean))).withColumn("m", H.article_of(clean)).collect()
    assert {r.page_id for r in native} >= {"article wins", "commented"}
    for row in native:
        assert row.m == H.find_body(row.html).replace("<!-- -->", "")


def test_sanitize():
    clean = lambda h: H.sanitize(h, "https://a.vn/x/y.html")
    assert clean('<article><b>bold</b> <p style="x">t &amp; u</p></article>') == "bold <p>t &amp; u</p>"
    assert clean('<a href="/r" onclick="e()" title="t">l</a>') == '<a href="https://a.vn/r" title="t">l</a>'
    assert clean('<a href="javascript:x()">l</a>') == "<a>l</a>"
    assert clean('<img src="i.png" alt="" width=3>') == '<img src="https://a.vn/x/i.png" alt="">'
    assert clean('<div class="c" id="i"><span class="s">z</span></div>') == '<div class="c"><span class="s">z</span></div>'
    assert clean("<p>one<p>two<br>three") == "<p>one</p><p>two<br>three</p>"
    assert clean("<ul><li>a<li>b</ul> x\n\n y") == "<ul><li>a</li><li>b</li></ul> x y"
    assert clean("</p></div>") is None
    assert clean(None) is None


LINKS = [
    "/a", "b.html", "../c", "../../../d", "./e", "http://o.org/f", "//o.org/g", "#h", "?q=1", "i?x=../y",
    "j#k/../l", "mailto:m@n.vn", "/p/./q/../r", "s/..", "..", ".",
]


@pytest.mark.parametrize("base", ["https://a.vn/x/y/z.html?u=1#v", "http://a.vn", "https://a.vn/x/"])
def test_absolute_links_equal_the_standard_library(spark, base):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(LINKS)], "i int, v string").orderBy("i")
    ours = [r[0] for r in df.select(H.absolute_link(F.col("v"), F.lit(base))).collect()]
    assert ours == [urljoin(base, v) for v in LINKS]


def test_substantial_body(spark):
    df = spark.createDataFrame([("x" * 50,), ("x" * 51,), (" " * 60 + "x",), (None,)], "b string")
    assert [r.b for r in df.where(ingest.substantial("b")).collect()] == ["x" * 51]


def test_page_text_can_leave_cut_references_alone(spark):
    html = "<article><p>a &amp; b&amp</p><p>Ly.&lt;&#233;&copy d &notit;&&amp;lt;</p></article>"
    pages = spark.createDataFrame([(1, "https://a.vn/", html)], "page_id long, url string, html string")
    read = lambda **options: ingest.page_text(pages, **options).first().page_text
    assert read(whole_references=True) == "a & b&ampLy.<é&copy d &notit;&&lt;"
    assert read() == "a & b&Ly.<é© d ¬it;&&lt;"


def test_page_links_skip_comments_and_read_all_quotes(spark):
    html = """<a href="/1">x</a><!-- <a href="/no"> --><A class=c HREF='2'>y</A><a href=/3?a=1&amp;b=2>z</a><a name="n">"""
    pages = spark.createDataFrame([(1, "https://a.vn/d/", html)], "page_id long, url string, html string")
    rows = ingest.page_links(pages).orderBy("position").collect()
    assert [r.link for r in rows] == ["https://a.vn/1", "https://a.vn/d/2", "https://a.vn/3?a=1&b=2"]
