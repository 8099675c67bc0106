import html
import re

import pytest

from lumentide.llm.html_extraction import blocks, extract, parse

CASES = [
    ("", ""),
    ("plain &amp; simple", "plain & simple"),
    ("<p>a<p>b", "a\nb"),
    ("<article><h1>T</h1><p><b>One<br><p>two\n three</p></article><footer>x</footer>", "T\nOne\ntwo three"),
    ("<article><p>a < b &lt;i&gt; &copy; &#233; &ampx &am</p></article>", "a < b <i> © é &x &am"),
    ("<body><nav><ul><li>m</ul></nav><main><header><h1>T</h1></header><p>x</p><aside>s</aside><form>f</form></main><p>out</p>", "T\nx"),
    ("<article><p>x</p><div class='comments'><p>first!</p></div><section id=related-posts>r</section></article>", "x"),
    ("<div class=ad>a</div><div><p>kept</p></div><script>if (a<b) '</p>'</script><style>p{}</style>", "kept"),
    ("<article><p>x<!-- <p>no</p> --> y</p><p title='a>b'>z</p><p title=it's>w</p></article>", "x y\nz\nw"),
    ("<article><p>whole</p><p>cut <a href='", "whole\ncut"),
    ("<article><table><tr><td>a<td>b<tr><td>c</table><ul><li>d<li>e</ul></article>", "a\nb\nc\nd\ne"),
    ("<article><p>soft space<span>in</span>line</p></article>", "soft space" + "inline"),
    ("<DIV><P>Big</DIV><article>t</article>", "t"),
    ("<article>a</article><p>between</p><article>b</article>", "a\nb"),
    ("<div role=main><p>m</p></div><p>n</p>", "m"),
    ("1 < 2 <3> <", "1 < 2 <3> <"),
    ("<" * 50 + "x", "<" * 49),
]


@pytest.mark.parametrize(("page", "text"), CASES)
def test_blocks(page, text):
    assert "\n".join(blocks(parse(page))) == text


def test_deep_and_long_pages():
    assert blocks(parse("<div>" * 20_000 + "x")) == ["x"]
    assert blocks(parse("<article>" + "<p>y z</p>" * 20_000)) == ["y z"] * 20_000


def expected(page):
    """By plain string operations, for pages of the tables' make."""
    body = page.partition("<article>")[2].partition("</article>")[0]
    body = re.sub(r"<[^>]*$", "", body)
    parts = [re.sub("<[^>]*>", "", b) for b in re.split(r"</?(?:p|h1)>", body)]
    return "\n".join(t for t in (" ".join(html.unescape(b).split()) for b in parts) if t)


def test_tables(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    want = {r.page_id: expected(r.html) for r in pages.collect()}
    out = extract(pages).collect()
    assert {r.page_id: r.text for r in out} == want and all(r.n_chars == len(r.text) for r in out)


def test_templates_go_by_host_and_prose_stays(spark):
    def page(i, site, extra=""):
        return f"<body><div><p>{site} since 1999</p></div><div><p>story {i} of {site}</p><p>shared words</p></div>{extra}</body>"

    rows = [(i, f"https://www.{s}.org:80/p{i}", page(i, s)) for s in ("one", "two") for i in range(12)]
    rows += [(100 + i, "https://copies.net/x", page(7, "copies")) for i in range(12)]  # one page, copied
    rows += [(200, None, page(1, "one")), (201, "https://one.org", None), (202, "", ""), (203, "https://few.org/", page(3, "few"))]
    rows += [(300 + i, "http://art.org/", f"<article><p>n{i}</p><p>always</p><div>Share this</div></article>") for i in range(10)]
    out = {(r.page_id, r.url): r.text for r in extract(spark.createDataFrame([(a, b, c, 1) for a, b, c in rows], "page_id long, url string, html string, host int")).collect()}
    assert len(out) == len({r[:2] for r in rows})
    assert out[3, "https://www.one.org:80/p3"] == "story 3 of one"  # what recurs outside an article is template
    assert out[100, "https://copies.net/x"] == "copies since 1999\nstory 7 of copies\nshared words"
    assert out[200, None].startswith("one since 1999") and out[201, "https://one.org"] == "" and out[202, ""] == ""
    assert out[203, "https://few.org/"].startswith("few since")
    assert out[304, "http://art.org/"] == "n4\nalways"
    assert extract(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0
