"""Embedded JSON: paths, defaults, slugs and whole records."""

import json

import pytest
from pyspark.sql import functions as F

from pagetables.functions import state as S
from pagetables.operators import ledger, records
from pagetables.sources.tables import api_responses, response_rejects


def page(product=None, **props):
    body = {"props": {"pageProps": {**({"product": product} if product else {}), **props}}}
    return f'<html><script id="__NEXT_DATA__" type="application/json">{json.dumps(body)}</script></html>'


def parsed(spark, *pages):
    rows = [(f"u{i}", p) for i, p in enumerate(pages)]
    return records.with_state(spark.createDataFrame(rows, "url string, html string"))


PRICES = [{"measureUnitName": "Vỉ", "price": 5}, {"isSellDefault": True, "measureUnitName": "Hộp", "price": 50}]


def test_default_and_final_price(spark):
    plain = [{"measureUnitName": "Vỉ", "price": 5}, {"isSellDefault": False, "measureUnitName": "Hộp", "price": 50}]
    df = parsed(
        spark,
        page({"sku": "1", "prices": PRICES}, initPromotionPrices=[{"finalPrice": 40}]),
        page({"sku": "2", "prices": plain}, initPromotionPrices=[{"finalPrice": None}]),
        page({"sku": "3", "prices": []}),
        page({"sku": "4"}, initPromotionPrices=[]),
        page({"sku": "5", "prices": PRICES}, initPromotionPrices=[{"promotionTags": [{"promotionTitle": "x"}]}]),
        page(None),
        "<html>no state</html>",
    )
    rows = records.flat_product(df).orderBy("url").collect()
    assert [(r.don_vi_tinh, r.gia_goc, r.gia_ban) for r in rows] == [
        ("Hộp", 50, 40), ("Vỉ", 5, None), (None, None, None), (None, None, None), ("Hộp", 50, 50),
    ]
    assert rows[4].khuyen_mai == "x"


def test_record_of_a_bare_product(spark):
    df = parsed(spark, page({"sku": "1"}))
    flat = records.flat_product(df).first().asDict()
    assert len(flat) == 30
    empty = ["danh_muc", "thanh_phan", "khuyen_mai", "tat_ca_hinh", "hinh_dai_dien", "mo_ta_ngan", "cong_dung"]
    assert all(flat[c] == "" for c in empty)
    nested = records.nested_product(df).first().asDict()
    assert len(nested) == 26  # 25 fields and the URL
    assert nested["thanh_phan"] == [] and nested["hinh_anh"] == [] and nested["khuyen_mai"] == []


def test_full_record(spark):
    product = {
        "sku": "00050292", "webName": "Men", "prices": PRICES,
        "categories": [{"name": "Thực phẩm"}, {"name": "Tiêu hóa"}],
        "ingredient": [{"name": "Zn", "shortDescription": "5mg"}, {"name": "C"}],
        "primaryImage": {"url": "/1.jpg"}, "secondaryImages": [{"url": "/2.jpg"}],
    }
    df = parsed(
        spark,
        page(product, content={"usage": "<p>A <b>b</b>.</p>c"}, initReview={"avgRating": 5, "total": 10},
             initComment={"total": 29}),
    )
    flat, nested = records.flat_product(df).first(), records.nested_product(df).first()
    assert (flat.danh_muc, flat.thanh_phan, flat.tat_ca_hinh) == ("Thực phẩm > Tiêu hóa", "Zn (5mg) | C", "/1.jpg | /2.jpg")
    assert (flat.cong_dung, nested.cong_dung) == ("A b.", "A\nb\n.\nc")
    assert (nested.thanh_phan, nested.hinh_anh) == (["Zn (5mg)", "C"], ["/1.jpg", "/2.jpg"])
    assert (nested.diem_danh_gia, nested.so_danh_gia, nested.so_binh_luan) == (5.0, 10, 29)


# Bodies and the slugs in them, an object's own before those below it.
BODIES = [
    ('{"a": {"slug": "x.html"}, "b": [1, {"slug": "y.html"}, {"slug": "z"}]}', ["x.html", "y.html"]),
    ('{"b": {"k": [{"slug": "in.html"}], "slug": "late.html"}, "a": {"slug": "z.html"}}',
     ["late.html", "in.html", "z.html"]),
    ('{"slug": {"slug": "deep.html"}}', ["deep.html"]),
    ('[[[{"slug": "é.html"}]], "slug", null, {"slug": 5}]', ["é.html"]),
    ("{}", []),
    ('{"slug":"a\\/b.html"}', ["a/b.html"]),
    ('{"sl\\u0075g":"caf\\u00e9.html"}', ["café.html"]),
    ('{"n": NaN, "slug": "nan.html"}', ["nan.html"]),
    ('{"a":"x,\\"slug\\":\\"no.html\\""}', []),
    ("[" * 100000 + '{"k": [{"slug": "in.html"}], "slug": "d\\u0041.html"}' + "]" * 100000, ["dA.html", "in.html"]),
    ("not json with slug", []),
    (None, []),
]


def test_recursive_slugs(spark):
    df = spark.createDataFrame([(i, b) for i, (b, _) in enumerate(BODIES)], "i int, b string")
    found = [r[0] for r in df.orderBy("i").select(S.recursive_slugs(F.col("b"))).collect()]
    assert found == [slugs for _, slugs in BODIES]


def test_responses_and_rejects_are_all(spark):
    odd = ['{"slug":"a.html","slug":"b.html"}', '{"n":NaN}', '{"n":' * 1200 + "1" + "}" * 1200, "[" * 100000 + "]" * 100000]
    bad = [("no body", None), ("not JSON", "<html>"), ("not JSON", '{"a":')]
    rows = [("https://x/search-product-service", b) for b in [*odd, *(b for _, b in bad)]]
    responses = spark.createDataFrame(rows, "url string, body string")
    assert sorted(r.body for r in api_responses(responses).collect()) == sorted(odd)
    found = [(r.reason, r.body) for r in response_rejects(responses).collect()]
    assert sorted(found, key=repr) == sorted(bad, key=repr)


def test_json_path_tells_types(spark):
    df = spark.createDataFrame([('{"a":{"b":7}}',), ('{"a":{"b":"x"}}',), ("bad",), (None,)], "b string")
    found = [r[0] for r in df.select(S.json_path(F.col("b"), "$.a.b", "bigint")).collect()]
    assert found == [7, None, None, None]


def test_responses_need_hint_and_json(spark):
    rows = [("https://x/search-product-service/1", "{}"), ("https://x/search-product-service/2", "<html>"), ("https://x/a", "{}")]
    kept = api_responses(spark.createDataFrame(rows, "url string, body string"))
    assert [r.url for r in kept.collect()] == [rows[0][0]]


@pytest.mark.parametrize(
    ("a", "b", "status"),
    [("29", "29", "equal"), ("80", "29", "differ"), ("1", None, "only_a"), ("", "1", "only_b"), (None, "", None)],
)
def test_reconcile(spark, a, b, status):
    left = spark.createDataFrame([("u", a)], "url string, v string")
    right = spark.createDataFrame([("u", b)], "url string, v string")
    rows = ledger.reconcile(left, right, "url", ["v"]).collect()
    assert [r.status for r in rows] == ([] if status is None else [status])


def test_reconcile_keeps_records_of_one_side(spark):
    left = spark.createDataFrame([("u", "1")], "url string, v string")
    right = spark.createDataFrame([("w", "2")], "url string, v string")
    rows = {r.url: r.status for r in ledger.reconcile(left, right, "url", ["v"]).collect()}
    assert rows == {"u": "only_a", "w": "only_b"}


def test_state_is_not_read_from_comments(spark):
    script = '<script id="__NEXT_DATA__">{"v":"%s"}</script>'
    page = "<!-- " + script % "old" + " --><script>var x = '<!--'</script>" + script % "new"
    df = spark.createDataFrame([(page,), ("<!--" + script % "old",), (None,)], "html string")
    assert [r[0] for r in df.select(S.state_json(F.col("html"))).collect()] == ['{"v":"new"}', None, None]


def test_prices_of_other_number_types(spark):
    prices = [
        {"isSellDefault": 0, "price": 1},
        {"isSellDefault": 1, "price": 380000.0, "measureUnitName": "a"},
        {"isSellDefault": True, "price": 2},
    ]
    row = records.flat_product(parsed(spark, page({"sku": "1", "prices": prices}))).first()
    assert (row.gia_goc, row.gia_ban, row.don_vi_tinh) == (380000, 380000, "a")


def test_kept_and_rejected_pages_are_all_pages(spark):
    def held(text):
        return f'<script id="__NEXT_DATA__">{text}</script>'

    pages = {
        "good": held('{"props":{"pageProps":{"product":{"sku":"1"}}}}'),
        "none": "<p>", "bad": held('{"props":'), "other": held('{"props":{}}'), "missing": None,
    }
    df = spark.createDataFrame(list(pages.items()), "url string, html string")
    assert [r.url for r in records.with_state(df).collect()] == ["good"]
    assert {r.url: r.reason for r in records.state_rejects(df).collect()} == {
        "none": records.NO_STATE, "bad": records.BAD_STATE, "other": records.NO_PRODUCT,
        "missing": records.MISSING_PAGE,
    }
