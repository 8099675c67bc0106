import pytest

from lumentide.llm.html_extraction import blocks, extract, parse


@pytest.mark.parametrize("known", [50_000, 0])
def test_templates_of_a_host_with_many_layouts(spark, known):
    def page(i):
        return f"<body><div><p>promo of layout {i % 20}</p></div><div><p>story {i}</p></div></body>"

    rows = [(i, f"https://big.org/p{i}", page(i)) for i in range(200)]  # each layout is on a twentieth of the pages
    rows += [(1000 + i, f"https://other.org/p{i}", page(0) if i < 4 else f"<div><p>text {i}</p></div>") for i in range(12)]  # copies make no template
    rows += [(3, "https://big.org/p3", page(3)), (2000, None, page(3)), (2001, "https://big.org/x", None)]
    out = extract(spark.createDataFrame(rows, "page_id long, url string, html string"), known=known).collect()
    assert len(out) == len(rows)
    for r in out:
        if r.page_id < 200:
            assert r.text == f"story {r.page_id}"
    text = {r.page_id: r.text for r in out}
    assert text[1000] == "promo of layout 0\nstory 0" and text[1005] == "text 5"
    assert text[2000] == "promo of layout 3\nstory 3" and text[2001] == ""


def test_articles_that_are_comments_or_teasers_go():
    body = '<article><h1>T</h1><p>Main text.</p><article class="comment"><p>Reader says hi</p></article></article>'
    body += '<section><article class="related teaser"><p>Another story</p></article></section><article class="post comment-free"><p>More.</p></article>'
    assert blocks(parse(body.replace("comment-free", "open"))) == ["T", "Main text.", "More."]
    assert blocks(parse('<article class="teaser"><p>a</p></article><div><p>b</p></div>')) == ["b"]


def test_only_counts_can_tell_in_marked_articles(spark):
    """Unnamed boxes in the article, some on every page of the host, some on one: no tag or name tells them apart."""

    def page(i, site):
        note = f"<div>{site} is read by many</div>" if site == "one" or i == 3 else f"<div>note {i}</div>"
        return f"<article><h1>t{i}</h1><p>story {i}</p>{note}</article>"

    rows = [(i if s == "one" else 100 + i, f"https://{s}.org/{i}", page(i, s)) for s in ("one", "two") for i in range(9)]
    text = {r.page_id: r.text for r in extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert all(text[i] == f"t{i}\nstory {i}" for i in range(9))  # on nine pages of one.org
    assert text[103] == "t3\nstory 3\ntwo is read by many" and text[104] == "t4\nstory 4\nnote 4"
