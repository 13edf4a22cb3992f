"""Scalar functions on hand-made rows, and against the standard library."""

import html
from urllib.parse import urljoin

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pagetables.functions import links as L
from pagetables.functions import markup as M
from pagetables.functions import text as X


def apply(spark, fn, values):
    rows = [(i, v) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, "i int, v string")
    return [r[0] for r in df.orderBy("i").select(fn(F.col("v"))).collect()]


def test_price(spark):
    given_ = ["380.000đ/Hộp", "/Hộp", "Liên hệ", "", None, "-1.5đ", "380.000đ", "475.000đ", "9" * 30]
    assert apply(spark, X.parse_price, given_) == [380000, None, None, None, None, 15, 380000, 475000, None]


def test_price_label_reads_back(spark):
    amounts = spark.createDataFrame([(0,), (999,), (1000,), (12345678,)], "a bigint")
    shown = amounts.select("a", X.price_label(F.col("a")).alias("t"))
    assert [r.t for r in shown.collect()] == ["0đ", "999đ", "1.000đ", "12.345.678đ"]
    assert shown.filter(X.parse_price(F.col("t")) != F.col("a")).count() == 0


SPACED = [
    "  a  b \t\n c  ", "a b", "", " ", None, "a\x1cb", " \x1f ", "x\xa0 y", "a\u2003b",
    "\u3000a\u3000", "a \x1c b", "a \u200b b", "\x85a\u2028b", "\xa0", "a\xa0b",
]


def test_squash_is_split_and_join(spark):
    expected = [None if v is None else " ".join(v.split()) for v in SPACED]
    assert apply(spark, X.squash, SPACED) == expected


def test_strip_is_strip(spark):
    expected = [None if v is None else v.strip() for v in SPACED]
    assert apply(spark, X.strip_ends, SPACED) == expected


def test_preview(spark):
    exact, longer = "x" * 50, "x" * 51
    given_ = [exact, longer, "", None]
    assert apply(spark, X.preview, given_) == [exact, exact + "...", "", ""]
    kept_null = apply(spark, lambda c: X.preview(c, null_as_empty=False), given_)
    assert kept_null == [exact, exact + "...", "", None]


def test_fallback(spark):
    rows = [("a", "b"), ("", "b"), (None, "b"), ("", ""), (None, None)]
    df = spark.createDataFrame(rows, "a string, b string")
    found = [r[0] for r in df.select(X.fallback(F.col("a"), F.col("b"))).collect()]
    assert found == [a or b for a, b in rows]


def test_labels_and_lists(spark):
    rows = [("Zn", "5 mg", ["a", None, "b"]), ("Zn", None, []), (None, "5 mg", None)]
    df = spark.createDataFrame(rows, "n string, s string, l array<string>")
    got = df.select(X.strength_label(F.col("n"), F.col("s")), X.join_list(F.col("l"))).collect()
    assert [tuple(r) for r in got] == [("Zn (5 mg)", "a | b"), ("Zn", ""), (None, "")]


def test_to_int(spark):
    given_ = [" 20 ", "20.5", "abc", "", None, "-3", "\xa07"]
    assert apply(spark, X.to_int, given_) == [20, None, None, None, None, -3, 7]


@pytest.mark.parametrize(
    ("needle", "hits"),
    [("an", [0, 1]), ("đ", [2]), ("Đ", [0]), ("", [0, 1, 2, 3]), ("_", [0, 1, 2]), ("a\\", []), ("%n", [0, 1])],
)
def test_search_folds_ascii_only(spark, needle, hits):
    names = ["ĐAn", "Binh An", "đ", "", None]
    df = spark.createDataFrame([(i, n) for i, n in enumerate(names)], "i int, n string")
    found = df.filter(X.contains_like(F.col("n"), needle)).orderBy("i").collect()
    assert [r.i for r in found] == hits


def test_fixed_width_never_cuts(spark):
    df = spark.createDataFrame([(1, "x" * 30), (2, None)], "i int, n string")
    lines = [r[0] for r in df.select(X.fixed_width((F.col("i"), 5), (F.col("n"), 25))).collect()]
    assert lines == [f"{1:<5}{'x' * 30:<25}", f"{2:<5}{'':<25}"]


# ------------------------------------------------------------ links

BASES = [
    "https://h.example", "https://h.example/", "https://h.example/a/b/c", "https://h.example/a/b/?q=1#f",
    "http://h.example/a?x=/y/z",
]
LINKS = [
    "/a/b.html", "https://x.example/c", "c.html", "../c.html", "../../../c", "./d", ".", "..", "?q=2", "#top",
    "//cdn.example/x", "a/./b/../c?u=../v#../w", "/x/../y/", "mailto:a@b.example", "", "a/..", "/..", "é/ü.html", "a//b//", "//", "/a//b", "//?q", "///a", "////a", "/b//.", "//#f",
]


def test_resolve_is_urljoin(spark):
    pairs = [(b, u) for b in BASES for u in LINKS]
    df = spark.createDataFrame(pairs, "b string, u string")
    got = [r[0] for r in df.select(L.resolve(F.col("b"), F.col("u"))).collect()]
    assert {p: g for p, g in zip(pairs, got)} == {p: urljoin(*p) for p in pairs}


def test_slugs_resolve_below_the_root(spark):
    base = F.lit("https://h.example")
    slugs = ["a/b.html", "/a/b.html", "///b.html"]
    assert apply(spark, lambda c: L.resolve_slug(base, c), slugs) == [
        "https://h.example/a/b.html", "https://h.example/a/b.html", "https://h.example/b.html",
    ]


def test_link_predicates(spark):
    links = ["/a.html", "/a.html?x", "/a", None]
    assert apply(spark, L.is_page_link, links) == [True, False, False, None]
    assert apply(spark, L.mentions_page, links) == [True, True, False, None]
    buttons = ["Xem thêm 8 sản phẩm", "Xem thêm 125\nsản phẩm", "Xem thêm sản phẩm"]
    assert apply(spark, L.has_more, buttons) == [True, True, False]


# ------------------------------------------------------------ references

REFERENCES = [
    "a & b", "&amp;lt;", "&lt;b&gt;", "&copy;&copy", "&notit; &notin;", "&#233;&#xE9;&#XE9", "&#128;", "&#0;",
    "&unknown;", "&amp", "&am", "&#38;amp;", "&quot;x&apos;", "&NotEqualTilde;", "&#1114112;", "&&amp;&", "&#;",
    "&#128512;", "&eacuteX", "&#1;&#11;&#12;&#13;&#31;&#127;", "&#xD800928;&#99999999999;&#x0000000000041;&#000000000000066;", "&#xFFFE;&#x1FFFF;&#xFDD0;&#xD800;&#x110000;", "&Eacute;tude &nbsp;",
]


def test_unescape_is_html_unescape(spark):
    assert apply(spark, M.unescape, REFERENCES) == [html.unescape(r) for r in REFERENCES]


@settings(max_examples=5, deadline=None)
@given(st.lists(st.text(alphabet="&#xa1;mpltgeucoy 9", max_size=14), min_size=40, max_size=40))
def test_unescape_on_random_text(spark, texts):
    assert apply(spark, M.unescape, texts) == [html.unescape(t) for t in texts]
