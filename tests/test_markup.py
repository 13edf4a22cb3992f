"""Markup to fields on hand-made pages."""

import pytest
from pyspark.sql import functions as F

from pagetables.functions import elements as E
from pagetables.functions import markup as M
from pagetables.operators import records


def one(spark, fn, page):
    df = spark.createDataFrame([(page,)], "html string")
    return df.select(fn(M.prepare(F.col("html")))).first()[0]


@pytest.mark.parametrize(
    ("page", "text"),
    [
        ("<p>a <b>b</b></p><li> </li><li>c</li>", "a b\nc"),
        ("x  y", "x y"),
        (None, ""),
        ("", ""),
        ("<p>one<p>two<br>three</p>tail", "one\ntwothree"),
        ("<ul><li>a</ul>after", "a"),
        ("<p>1 &lt; 2 &amp;amp; 3</p>", "1 < 2 &amp; 3"),
        ("<script>var t='</p><p>x';</script><P class=q>Y</P>", "Y"),
        ("<pre>no block</pre>", "no block"),
        ("<li><div>a</div> b</li><li>c<p>d</p>e</li>", "a b\nc\nd\ne"),
        ("<div><p>a</div>b<ul><li>c<ul><li>d</li></ul>e</li></ul>f", "a\nc\nd\ne"),
        ("<li><div><div>a</div>b</div>c</li>d", "abc"),
    ],
)
def test_block_text(spark, page, text):
    assert one(spark, M.block_text, page) == text


@pytest.mark.parametrize(
    ("page", "text"),
    [
        ("<p>A <b>b</b>.</p>c", "A\nb\n.\nc"),
        (None, ""),
        ("a<!-- x -->b", "a\nb"),
        ("<style>p{}</style>   <i>x</i>&nbsp;", "x"),
    ],
)
def test_line_text(spark, page, text):
    assert one(spark, M.line_text, page) == text


def test_raw_text_runs_words_together(spark):
    assert one(spark, M.raw_text, "<h2>Dose</h2><p>Six drops</p>a<br>b") == "DoseSix dropsab"


PAGE = """<html lang="vi"><head><title> A &amp; B </title><meta content='/i.jpg' property='og:image'>
<!-- <h1>hidden</h1> --></head><body><h1 data-test="product_name" class="x y">Name <b>here</b></h1>
<i data-test=empty></i><a>no link</a><a href="">none</a><a class="c" href='/one.html'>One</a>
<a href=/two.html>Two</a><div class="ad">cut</div><div class="usage box">never closed"""


def test_first_matches(spark):
    assert one(spark, M.title, PAGE) == "A & B"
    assert one(spark, lambda p: M.first_text(p, "h1"), PAGE) == "Name here"
    assert one(spark, lambda p: M.first_text(p, None, "data-test", "product_name"), PAGE) == "Name here"
    assert one(spark, lambda p: M.first_text(p, "h2"), PAGE) is None
    assert one(spark, lambda p: M.first_text(p, "div", "class", "usage", "~="), PAGE) == "never closed"
    assert one(spark, lambda p: M.first_text(p, "div", "class", "usage"), PAGE) is None
    assert one(spark, lambda p: M.first_attr(p, "content", "meta", "property", "og:image"), PAGE) == "/i.jpg"
    assert one(spark, lambda p: M.first_attr(p, "id", "h1"), PAGE) is None
    assert one(spark, lambda p: M.first_text(p, None, "data-test", "empty"), PAGE) == ""
    assert one(spark, lambda p: M.first_text(p, None, "data-test", "Empty"), PAGE) is None
    assert one(spark, lambda p: M.first_text(p, "A", "HREF", "/two", "^="), PAGE) == "Two"
    assert one(spark, lambda p: M.first_text(p, "a", "href", "one.html", "$="), PAGE) == "One"
    assert one(spark, M.anchor_hrefs, PAGE) == ["/one.html", "/two.html"]


def indexed(spark, fn, page):
    df = spark.createDataFrame([(page,)], "html string")
    return E.with_index(df).select(fn(E.Page("page"))).first()[0]


def test_detail_rows_and_sections(spark):
    page = (
        "<div data-test='strike_price'><p>9đ</p></div><div>"
        "<div><p>\n Số đăng   ký </p></div><div>12/3</div>"
        "<div><p>Danh mục</p></div><div> </div>"
        "<div><p>Số đăng ký</p></div><div>second</div><div><p>Other</p></div><div>no</div></div>"
        "<div id='content-wrapper'><div class='usage'>H<p>use</p></div><div class='usages'>no</div></div>"
    )
    assert indexed(spark, records.detail_rows, page) == {"Số đăng ký": "12/3"}
    assert indexed(spark, records.sections, page) == {"usage": "Huse"}


@pytest.mark.parametrize(
    ("page", "inner"),
    [
        ("x<div class='q'><div>a</div><div>b</div></div>c", "<div>a</div><div>b</div>"),
        ("<DIV class='q'><div>a</Div>b", "<div>a</Div>b"),
        ("<div class='q'><divan>a</divan></div>b", "<divan>a</divan>"),
        ("<span class='q'><span/>a</span>b", "<span/>a"),
        ("<img class='q'>b", ""),
        ("<i class='q'></i>b", ""),
        ("<i>b</i>", None),
        ("<div class='q'>" * 3 + "a" + "</div>" * 2 + "b</div>c", "<div class='q'><div class='q'>a</div></div>b"),
        (None, None),
    ],
)
def test_elements_are_balanced(spark, page, inner):
    assert one(spark, lambda p: M.first_inner(p, None, "class", "q"), page) == inner


def test_all_elements_with_nested_ones(spark):
    page = "<div class='q'>a<div class='q'>b</div></div><div>c</div><p class='q'>d</p>"
    found = indexed(spark, lambda p: F.transform(p.find(None, "class", "q"), p.raw), page)
    assert found == ["ab", "b", "d"]


def test_long_and_deep_markup(spark):
    deep = "<div class='q'>" + "<div>" * 3000 + "x" * 100_000 + "</div>" * 3000 + "y</div>z"
    assert one(spark, lambda p: M.first_text(p, "div", "class", "q"), deep) == "x" * 100_000 + "y"


def test_price_of_nested_spans(spark):
    page = "<span data-test=\"price\"><span>380.000đ</span>/<span>Hộp</span></span>tail"
    assert one(spark, lambda p: M.first_text(p, None, "data-test", "price"), page) == "380.000đ/Hộp"


def test_details_and_sections_with_inner_markup(spark):
    page = (
        "<div class='usage'>menu</div><div>"
        "<div><i></i><p><b>Quy cách</b></p><div>?</div></div><span>:</span>"
        "<div><div>Hộp</div><div>8 ống</div></div>"
        "<div><p>Danh mục</p></div></div><div>not a sibling</div>"
        "<div><p>Danh mục</p></div><div><div>x</div></div>"
        "<div id='content-wrapper'><div><div class='a dosage'><div>a</div><div>b</div></div></div>"
        "<div class='usage'>real</div></div><div class='careful'>outside</div>"
    )
    assert indexed(spark, records.detail_rows, page) == {"Quy cách": "Hộp8 ống", "Danh mục": "x"}
    assert indexed(spark, records.sections, page) == {"usage": "real", "dosage": "ab"}


def test_siblings_with_inner_markup(spark):
    page = (
        "<h1 data-test='product_name'>N</h1><section>"
        "<div><div><i></i><span>Nhật <b>Bản</b></span></div></div> <i>.</i>"
        "<div><b>x</b><span><i></i>Thương hiệu: </span><a href='/thuong-hieu/a'>A</a></div></section>"
        "<div><span data-test-id='sku'><span>0</span>1</span><b>-</b>"
        "<span class='inline-flex'><svg><path/></svg><span>5</span></span><br>"
        "<span class='cursor-pointer'><i></i>10 đánh giá</span><div>"
        "</div><span class='cursor-pointer'>80 bình luận</span></div>"
        "<span class='cursor-pointer'>other</span>"
    )
    row = records.dom_record(spark.createDataFrame([("u", page)], "url string, html string")).first()
    assert (row.sku, row.xuat_xu, row.diem_danh_gia) == ("01", "Nhật Bản", "5")
    assert (row.so_danh_gia, row.so_binh_luan) == ("10 đánh giá", "80 bình luận")
    apart = page.replace("<i>.</i>", "</section><section>")
    row = records.dom_record(spark.createDataFrame([("u", apart)], "url string, html string")).first()
    assert row.xuat_xu is None


def test_counts_need_two_spans(spark):
    head = "<h1 data-test='product_name'>N</h1><div><span data-test-id='sku'>1</span>"
    spans = "<span class='a inline-flex'>5</span><span class='cursor-pointer'>10 đánh giá</span>"
    more = "<span class='cursor-pointer'> 80 bình luận</span>"
    df = spark.createDataFrame(
        [("one", head + spans + "</div>"), ("two", head + spans + more + "</div>")], "url string, html string"
    )
    found = {r.url: r for r in records.dom_record(df).collect()}
    assert (found["one"].diem_danh_gia, found["one"].so_danh_gia, found["one"].so_binh_luan) == ("5", None, None)
    assert (found["two"].so_danh_gia, found["two"].so_binh_luan) == ("10 đánh giá", "80 bình luận")


def test_listing_errors_are_rows(spark):
    pages = [("a", "<h1 data-test='product_name'></h1><h1>Head</h1><b data-test='price'>1.500đ/Hộp</b>"), ("b", "<p>")]
    listed = records.listing_record(spark.createDataFrame(pages, "url string, html string"))
    assert listed.columns == records.LISTING_COLUMNS
    rows = {r.url: r for r in listed.collect()}
    assert (rows["a"].price, rows["a"].error) == (1500, None)
    assert (rows["b"].name, rows["b"].error) == (None, records.MISSING_NAME)
    good, bad = records.split_failures(listed)
    assert (good.count(), bad.count()) == (1, 1)


def test_crawl_reports_missing_pages(spark):
    links = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3)], "url string, round int")
    pages = spark.createDataFrame([("a", "<i data-test='product_name'>N</i>"), ("b", "x"), ("z", "y")], "url string, html string")
    rows = {r.url: (r.name, r.error, r.round) for r in records.crawl(links, pages, also=("round",)).collect()}
    assert rows == {
        "a": ("N", None, 1), "b": (None, records.MISSING_NAME, 2), "c": (None, records.MISSING_PAGE, 3),
    }
