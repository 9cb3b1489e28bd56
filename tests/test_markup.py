"""The element table of a page and the selectors over it."""

import random

import pytest
from pyspark.sql import functions as F

from jobmeld.operators import extract as ex
from jobmeld.operators.markup import El, Field, Page, elements, with_fields

PAGES = "page_id int, url string, html string"


def take(html, select, what="text"):
    return Page(html).take(Field(select, what))


def one_page(spark, html, url="https://x.vn/a/list.html"):
    return spark.createDataFrame([(1, url, html)], PAGES)


def build(rnd, depth=0):
    """A random tree (tag, attributes, children), children being trees or texts."""
    tag = rnd.choice(["div", "span", "section", "b", "ul"])
    attrs = {n: rnd.choice(["a", "b", "a b", "ab c"]) for n in rnd.sample(["class", "id", "title"], rnd.randint(0, 2))}
    kids = []
    if depth < 4:
        kids = [rnd.choice([f"t{rnd.randint(0, 5)} ", " ", build(rnd, depth + 1), build(rnd, depth + 1)]) for _ in range(rnd.randint(0, 4))]
    return tag, attrs, kids


def render(rnd, tree):
    tag, attrs, kids = tree
    text = "".join(f' {n}={q}{v}{q}' for n, v in attrs.items() for q in rnd.choice("\"'"))
    noise = rnd.choice(["", "", "<!-- <div class='a'>t1</div> -->", "<br>", "<img title='>'>"])
    return f"<{tag}{text}>{noise}" + "".join(k if isinstance(k, str) else render(rnd, k) for k in kids) + f"</{tag.upper()}>"


def walk(tree, above=()):
    yield tree, above
    for k in tree[2]:
        if not isinstance(k, str):
            yield from walk(k, (*above, tree))


def text_of(tree):
    return "".join(k if isinstance(k, str) else text_of(k) for k in tree[2])


@pytest.mark.parametrize("seed", range(40))
def test_selectors_on_random_pages(seed):
    rnd = random.Random(seed)
    tree = ("div", {}, [build(rnd) for _ in range(4)])
    page = Page(render(rnd, tree))
    nodes = list(walk(tree))

    def css(node, words):
        return set(words.split()) <= set(node[1].get("class", "").split())

    def found(test):
        return [text_of(n) for n, above in nodes if test(n, above)]

    cases = [
        (El("div"), lambda n, up: n[0] == "div"),
        (El("span", css="b a"), lambda n, up: n[0] == "span" and css(n, "a b")),
        (El("b", css_part="b"), lambda n, up: n[0] == "b" and "b" in n[1].get("class", "")),
        (El("b", within=El("div", css="a")), lambda n, up: n[0] == "b" and any(u[0] == "div" and css(u, "a") for u in up)),
        (El("span", child_of=El("div")), lambda n, up: n[0] == "span" and up and up[-1][0] == "div"),
        (El("div", holds=El("b")), lambda n, up: n[0] == "div" and any(m[0] == "b" for m, a in list(walk(n))[1:])),
        (El("div", parent_of=El("b")), lambda n, up: n[0] == "div" and any(not isinstance(k, str) and k[0] == "b" for k in n[2])),
        (El(ident="a"), lambda n, up: n[1].get("id") == "a"),
        (El("section", has="t1"), lambda n, up: n[0] == "section" and "t1" in text_of(n)),
        (El("span", text="t1 t2"), lambda n, up: n[0] == "span" and text_of(n).split() == ["t1", "t2"]),
    ]
    for select, test in cases:
        assert page.take(Field(select)) == found(test), select
    behind = {}
    for n, up in nodes:
        kids = [k for k in n[2] if not isinstance(k, str)]
        for i, k in enumerate(kids):
            after = next((m for m in kids[i + 1 :] if m[0] == "span"), None)
            if k[0] == "b" and after:
                behind[id(after)] = after
    assert page.take(Field(El("span", after=El("b")))) == [text_of(n) for n, _ in nodes if id(n) in behind]


def test_markup_as_found():
    assert take("<ul><li>a<li>b<ul><li>c</ul><li>d</ul>", El("li", child_of=El("ul")), "own") == ["a", "b", "c", "d"]
    assert take("<p>a<p>b<div>c</div>", El("p")) == ["a", "b"]
    assert take("<table><tr><td>a<td>b<tr><td>c</table>", El("tr")) == ["ab", "c"]
    assert take("<div><b>x</div><i>y</i>", El("i", within=El("div"))) == []
    assert take("<a title=\"a > b\" href='x'>t</a>", El("a"), "href") == ["x"]
    assert take("a < b <b>c</b> < d", El("b")) == ["c"]
    assert take("<b class=a/b>x</b><b CLASS>y", El("b"), "class") == ["a/b", ""]
    assert take("<title>a <b> &amp; b</title><b>c", El("title"), "own") == ["a <b> & b"]
    assert take("<script>'<b>no</b>'</SCRIPT ><b>yes</b><!-- <b>no</b> --><style><b></style><b>more", El("b")) == ["yes", "more"]
    assert take("<div><!-- open <b>no</b>", El("b")) == []
    assert take("<b title=\"it's>x</b><b>y</b>", El("b"))[-1] == "y"
    assert take("", El("b")) == take("</b></div>text", El("b")) == []
    assert take("<b>1</b><b>2</b>", El("b", first=True)) == ["1"]


def test_a_long_broken_page_is_read_in_linear_time():
    import time

    start = time.perf_counter()
    for text in ("<a href=\"", "<", "<!--", "<b '", "<b '>", "<b \"'>", "<p>", "<b>", "<b></i>", "<script>", "<div><b></div>"):
        page = Page(text * 40_000)
        page.take(Field(El("b", within=El("p", holds=El("i"))), "title"))
    assert time.perf_counter() - start < 20


def test_pager_in_any_form(spark):
    url, html = F.col("url"), F.col("html")
    cases = {
        "<a rel='next' href='?a=1&amp;p=2'>n</a>": "https://x.vn/a/list.html?a=1&p=2",
        '<li class="page-item next-page"><a href="/p/2">n</a></li>': "https://x.vn/p/2",
        '<li class="pagi_pre active"><a href="/p/3">n</a></li>': "https://x.vn/p/3",
        '<a class="h-8 w-8 rounded-full bg-white border border-se-blue-10 flex justify-center items-center cursor-pointer z" href="/p/4">': "https://x.vn/p/4",
        "<!-- <a rel=next href=/no> --><p>none": None,
    }
    rows = spark.createDataFrame([(i, "https://x.vn/a/list.html", h) for i, h in enumerate(cases)] + [(9, "u", None)], PAGES)
    got = {r.page_id: r.n for r in rows.select("page_id", ex.next_page(url, html).alias("n")).collect()}
    assert got == {**dict(enumerate(cases.values())), 9: None}


def test_links_are_decoded_and_not_out_of_scripts_or_comments(spark):
    html = "<script>'<a href=\"/s\">'</script><!-- <a href='/c'> --><a href='/x?a=1&#38;b=2&amp;c'>1</a><a name=q>2</a><a href=/y>3"
    got = one_page(spark, html).select(ex.page_links(F.col("html")).alias("l")).first()["l"]
    assert got == ["/x?a=1&b=2&c", "/y"]


def test_value_beside_the_right_label(spark):
    html = """<p>Giới tính</p><span>Trang chủ</span><p class='item_if'>Giới tính</p><br> <!-- x --><span>Nam</span>"""
    got = one_page(spark, html).select(
        ex.sibling_value(F.col("html"), "Giới tính", css="item_if").alias("a"), ex.sibling_value(F.col("html"), "Giới tính").alias("b")
    ).first()
    assert tuple(got) == ("Nam", "Trang chủ")


def test_fields_leave_the_reader_without_the_page(spark):
    df = with_fields(one_page(spark, "<h1>a</h1><b>c"), {"h": Field(El("h1")), "b": Field(El("b"))}, "page_id")
    assert df.columns == ["page_id", "h", "b"] and tuple(df.first()) == (1, ["a"], ["c"])
    text = df._jdf.queryExecution().executedPlan().toString()
    assert text.count("ArrowEvalPython") == 1
    assert one_page(spark, None).select(elements(F.col("html"), El("b")).alias("x")).first()["x"] == []


def test_every_list_page_has_a_listing(spark):
    assert {m for m, _ in ex.LISTINGS} == {"careerviet", "jobsgo", "timviec365", "topcv", "vieclam24h", "careerlink"}
    many = "".join(f'<a target="_blank" href="/v/{i}">x</a>' for i in range(40))
    assert ex.listed(one_page(spark, many), "vieclam24h", "recruit").count() == 30
