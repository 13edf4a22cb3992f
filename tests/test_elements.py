"""The element index on hand-made and random markup."""

import random
import time

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from pagetables.functions import elements as E
from pagetables.functions import markup as M


def rows(spark, fn, *pages):
    df = spark.createDataFrame([(i, p) for i, p in enumerate(pages)], "id int, html string")
    found = E.with_index(df).select("id", fn(E.Page("page")).alias("x")).collect()
    return [r.x for r in sorted(found)]


def test_index_of_a_page(spark):
    page = "<!DOCTYPE html><html><body>a<p>b<p>c<b>d</b></p><ul><li>x<li>y<i>z</ul><br>t</em><x/></body>"
    found = rows(spark, lambda p: p.at, page, None, "", "plain")
    assert found[0].texts == ["", "", "", "a", "b", "c", "d", "", "", "", "x", "y", "z", "", "t", "", "", ""][:18]
    shown = [(e.name, e.around, e.depth, e.at, e.end, e.up) for e in found[0].elements]
    assert shown == [
        ("html", "", 0, 2, 18, 0), ("body", "html", 1, 3, 17, 2), ("p", "body", 2, 4, 5, 3),
        ("p", "body", 2, 5, 8, 3), ("b", "p", 3, 6, 7, 5), ("ul", "body", 2, 9, 13, 3),
        ("li", "ul", 3, 10, 11, 9), ("li", "ul", 3, 11, 13, 9), ("i", "li", 4, 12, 13, 11),
        ("br", "body", 2, 14, 14, 3), ("x", "body", 2, 16, 16, 3),
    ]
    assert found[1] is None
    assert (found[2].texts, found[2].elements, found[3].texts) == ([""], [], ["plain"])


def test_random_markup_nests(spark):
    rnd = random.Random(7)
    parts = ["<p>", "</p>", "<div class=a>", "</div>", "<li>", "</li>", "<b>", "</b>", "<br>", "<i/>", "x", " ", "<!-- c -->", "</q>", "<", "a>b"]
    pages = ["".join(rnd.choice(parts) for _ in range(rnd.randint(0, 60))) for _ in range(300)]
    for page, found in zip(pages, rows(spark, lambda p: p.at, *pages), strict=True):
        prepared = page.replace("<!-- c -->", "<x>")
        assert "".join(found.texts) == "".join(E._TAG.split(prepared))
        by_start = {e.at: e for e in found.elements}
        assert list(by_start) == sorted(by_start)
        for e in found.elements:
            assert e.at <= e.end <= len(found.texts) and e.tag.lower().startswith(f"<{e.name}")
            around = by_start.get(e.up)
            assert (around is None) == (e.up == 0) and e.depth == (around.depth + 1 if around else 0)
            if around:
                assert around.at < e.at and e.end <= around.end and e.around == around.name
        # Two elements lie one in the other, or apart.
        for a in found.elements:
            for b in found.elements:
                assert a.end <= b.at or b.end <= a.at or a.at <= b.at and b.end <= a.end or b.at <= a.at and a.end <= b.end


PAGE = (
    "<div id=s><a href='/1.html'>1</a><span>t &amp; u</span><div class='k one'>A<p>p1</p></div>"
    "<i></i><div>B</div></div><a href='/2.html?x'>2</a><div><p>p2</p></div>"
)


def test_ranges_and_siblings(spark):
    def texts(elements):
        return lambda p: F.transform(elements(p), p.text)

    cases = [
        (lambda p: p.find("a", "href", ".html", "$="), ["1"]),
        (lambda p: p.inside(p.find(None, "id", "s"), p.find("p")), ["p1"]),
        (lambda p: p.inside(p.find("div"), p.find("p")), ["p1", "p2"]),
        (lambda p: p.after(p.find("span"), p.find("div")), ["Ap1", "B"]),
        (lambda p: p.parents(p.find("p")), ["Ap1", "p2"]),
        (lambda p: F.transform(p.next_to(p.find("i"), p.find("div"), 1), lambda x: x["next"]), ["B"]),
        (lambda p: F.transform(p.next_to(p.find("i"), p.find("div"), -1), lambda x: x["next"]), ["Ap1"]),
        (lambda p: F.transform(p.next_to(p.find("p"), p.find("div"), 1), lambda x: x["next"]), []),
        (lambda p: p.find("div", "class", "one", "~="), ["Ap1"]),
        (lambda p: p.find("span"), ["t & u"]),
    ]
    for elements, wanted in cases:
        assert rows(spark, texts(elements), PAGE) == [wanted]
    assert rows(spark, lambda p: p.attribute(p.first("a"), "href"), PAGE, "", None) == ["/1.html", None, None]
    assert rows(spark, lambda p: p.text(p.first("h1")), PAGE, "<h1></h1>") == [None, ""]


def test_time_grows_with_the_tags(spark):
    def seconds(n):
        pages = ["<div>" + "<span class=a>" * n + "x" + "</span>" * n + "</div>"] * 16
        start = time.perf_counter()
        assert set(rows(spark, lambda p: F.size(p.find("span", "class", "a")), *pages)) == {n}
        return time.perf_counter() - start

    seconds(400)
    short, long = min(seconds(400) for _ in range(3)), min(seconds(6400) for _ in range(2))
    assert long < 16 * short


@pytest.mark.parametrize("page", ["<b " + "x" * 200_000, "</p>" * 20_000, "<p>" * 20_000 + "</div>" * 20_000, "<i>" * 30_000])
def test_broken_markup(spark, page):
    texts, elements = E.scan(page)
    assert len(texts) == len(M.re.findall(E._TAG, page)) + 1
    assert all(e[1] <= len(texts) for e in elements)


def test_a_batch_is_indexed_in_portions():
    pages = ["<p>x</p>" * 20_000] * 30 + [None, "", "<b>y"]
    found = list(E._scan.func(iter([pa.array(pages)])))
    assert sum(map(len, found)) == len(pages)
    # No portion holds the index of more than a megabyte of markup, or of one page.
    assert max(len(part.field("elements").flatten()) for part in found) <= 7 * 20_000
    last = [row for part in found for row in part.to_pylist()][-4:]
    assert len(last[0]["elements"]) == 20_000
    assert [r and (r["texts"], len(r["elements"])) for r in last[1:]] == [None, ([""], 0), (["", "y"], 1)]
