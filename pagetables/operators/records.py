"""Whole product records from pages: one ``select`` each, nothing shuffled."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagetables.functions import elements as E
from pagetables.functions import markup as M
from pagetables.functions import state as S
from pagetables.functions.text import (
    LIST_SEPARATOR,
    PATH_SEPARATOR,
    fallback,
    join_list,
    parse_price,
    strip_ends,
    truncate,
)

# Columns of the listing record, in their order.
LISTING_COLUMNS = [
    "url", "name", "sku", "price_text", "price", "original_price", "image", "error",
]

# Labels of the detail rows, and classes of the text sections.
DETAIL_LABELS = [
    "Tên chính hãng", "Số đăng ký", "Thành phần", "Dạng bào chế", "Quy cách",
    "Danh mục", "Nhà sản xuất", "Nước sản xuất", "Hạn sử dụng",
]
SECTION_CLASSES = [
    "description", "usage", "dosage", "careful", "preservation", "adverseEffect",
]
CONTENT_ID = "content-wrapper"
BRAND_LABEL = "Thương hiệu"
BRAND_PATH = "/thuong-hieu/"

MISSING_NAME = "product name not found"
MISSING_PAGE = "page not found"


# ---------------------------------------------------------------- markup

def prepared(pages: DataFrame, html: str = "html") -> DataFrame:
    """Pages whose markup is ready for the field functions."""
    return pages.withColumn(html, M.prepare(F.col(html)))


def _named(array: str, names: Iterable[str]) -> list[Column]:
    """The elements of an array as columns."""
    return [F.get(array, F.lit(i)).alias(name) for i, name in enumerate(names)]


def listing_record(
    pages: DataFrame, url: str = "url", html: str = "html", also: tuple[str, ...] = ()
) -> DataFrame:
    """The 8-column listing record, and the columns named in ``also``. A page that
    is missing or has no product name becomes a row of its URL and an error; the
    others go on.

    All fields are read from one index of the page's elements.
    """
    page = E.Page("__page")
    texts = {
        "own_name": page.first(None, "data-test", "product_name"),
        "heading": page.first("h1"),
        "sku": page.first(None, "data-test-id", "sku"),
        "price_text": page.first(None, "data-test", "price"),
        "strike_text": page.first(None, "data-test", "strike_price"),
    }
    read = E.with_index(pages, html, "__page").select(
        F.col(url).alias("url"),
        _texts(page, texts),
        page.attribute(page.first("meta", "property", "og:image"), "content").alias("image"),
        F.col("__page").isNull().alias("no_page"),
        *also,
    ).select("url", *_named("__texts", texts), "image", "no_page", *also)
    found = F.col("own_name").isNotNull()
    problem = F.when(F.col("no_page"), F.lit(MISSING_PAGE)).otherwise(F.lit(MISSING_NAME))
    fields = {
        "name": fallback(F.col("own_name"), F.col("heading")),
        "sku": F.col("sku"),
        "price_text": F.col("price_text"),
        "price": parse_price(F.col("price_text")),
        "original_price": parse_price(F.col("strike_text")),
        "image": F.col("image"),
    }
    return read.select(
        "url",
        *[F.when(found, c).alias(n) for n, c in fields.items()],
        F.when(~found, truncate(problem)).alias("error"),
        *also,
    ).select(*LISTING_COLUMNS, *also)


def crawl(frontier: DataFrame, pages: DataFrame, also: tuple[str, ...] = ()) -> DataFrame:
    """Listing records of the links of a frontier, from the pages that were fetched.

    Links are distinct before the join, and both sides hold a URL once.
    """
    fetched = frontier.select("url", *also).join(pages.select("url", "html"), "url", "left")
    return listing_record(fetched, also=also)


def split_failures(records: DataFrame, error: str = "error") -> tuple[DataFrame, DataFrame]:
    """Good rows without the error column, and the rejected ones."""
    return records.filter(F.col(error).isNull()).drop(error), records.filter(F.col(error).isNotNull())


def simple_record(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """The 6-column record; prices stay text."""
    page = E.Page("__page")
    texts = {
        "name": page.first(None, "data-test", "product_name"),
        "sku": page.first(None, "data-test-id", "sku"),
        "price": page.first(None, "data-test", "price"),
        "original_price": page.first(None, "data-test", "strike_price"),
    }
    return E.with_index(pages, html, "__page").select(
        F.col(url).alias("url"),
        _texts(page, texts),
        page.attribute(page.first("meta", "property", "og:image"), "content").alias("image"),
    ).select("url", *_named("__texts", texts), "image")


def detail_rows(page: E.Page, labels: list[str] = DETAIL_LABELS) -> Column:
    """Map of label to value: the ``div`` after the one whose paragraph is the label.

    For each label the first row counts, and empty values are dropped.
    """
    wanted = F.array(*[F.lit(label) for label in labels])
    held = F.transform(
        page.find("p"),
        lambda p: F.struct(p["up"].alias("at"), F.when(p["around"] == "div", page.text(p)).alias("label")),
    )

    def rows(cells: Column) -> Column:
        boxes = F.filter(
            page.find("div"), lambda e: F.exists(cells, lambda c: c["at"] == e["at"])
        )

        def entries(pairs: Column) -> Column:
            found = F.transform(
                cells,
                lambda c: F.struct(
                    F.get(F.filter(pairs, lambda p: p["of"] == c["at"]), F.lit(0))["next"].alias("value"),
                    c["label"].alias("label"),
                ),
            )
            # In the order of the values, as they stand on the page.
            ordered = F.array_sort(F.filter(found, lambda c: c["value"].isNotNull()))
            return F.transform(
                ordered, lambda c: F.struct(c["label"].alias("label"), page.text(c["value"]).alias("value"))
            )

        return M._bound(page.next_to(boxes, page.find("div"), 1), entries)

    labelled = F.filter(held, lambda c: F.array_contains(wanted, c["label"]))
    return first_entries(M._bound(labelled, rows), labels)


def first_entries(cells: Column, keys: list[str]) -> Column:
    """Map of the known keys to their first value in an array of pairs.

    The pairs are first cut down to the known keys with a value, one per key.
    """
    known = F.array(*[F.lit(k) for k in keys])
    wanted = F.filter(cells, lambda c: F.array_contains(known, c["label"]))
    empty = F.array().cast("array<struct<label:string,value:string>>")
    firsts = F.aggregate(
        wanted,
        empty,
        lambda kept, c: F.when(F.exists(kept, lambda k: k["label"] == c["label"]), kept).otherwise(
            F.array_append(kept, F.struct(c["label"].alias("label"), c["value"].alias("value")))
        ),
    )
    return F.map_from_entries(F.filter(firsts, lambda e: e["value"] != ""))


def section_map(page: E.Page, elements: dict[str, Column]) -> Column:
    """Map of name to text for the named elements that are present."""
    entries = F.transform(
        F.array(*[F.struct(F.lit(name).alias("key"), element.alias("value")) for name, element in elements.items()]),
        lambda e: F.struct(e["key"].alias("key"), strip_ends(page.raw(e["value"])).alias("value")),
    )
    return F.map_from_entries(F.filter(entries, lambda e: e["value"].isNotNull()))


def sections(page: E.Page, classes: list[str] = SECTION_CLASSES) -> Column:
    """Map of class to text: the first section of each class in the page's content."""
    content = page.inside(page.find(None, "id", CONTENT_ID), page.find("div"))
    return M._bound(
        content,
        lambda divs: section_map(page, {name: page.first("div", "class", name, "~=", divs) for name in classes}),
    )


def brand_origin(page: E.Page) -> Column:
    """The first span in the ``div`` that precedes the brand row."""
    labels = F.filter(page.find("span"), lambda e: (e["around"] == "div") & page.raw(e).contains(BRAND_LABEL))
    rows = page.next_to(page.parents(labels), page.find("div"), -1)
    origins = page.inside(F.transform(rows, lambda r: r["next"]), page.find("span"))
    return F.get(origins, F.lit(0))


def _texts(page: E.Page, elements: dict[str, Column]) -> Column:
    """Texts of some elements as one array: the plan holds their cleaning once."""
    return F.transform(F.array(*elements.values()), page.text).alias("__texts")


def dom_record(
    pages: DataFrame, url: str = "url", html: str = "html", also: tuple[str, ...] = ()
) -> DataFrame:
    """The record as the page shows it: scalars, two counts and two maps.

    All fields are read from one index of the page's elements. Columns named in ``also``
    are passed on.
    """
    return dom_fields(E.with_index(pages, html, "__page"), url, also)


def dom_fields(
    indexed: DataFrame, url: str = "url", also: tuple[str, ...] = (), index: str = "__page"
) -> DataFrame:
    """``dom_record`` of pages that are indexed already."""
    # All rules look through parts of the index, which are made once per page.
    parts = E.Page(index).parts(("div", "span", "p"))
    columns = {name: f"__part_{i}" for i, name in enumerate(parts)}
    indexed = indexed.withColumns({columns[name]: part for name, part in parts.items()})
    page = E.Page(index, {name: F.col(column) for name, column in columns.items()})
    texts = {
        "ten": page.first(None, "data-test", "product_name"),
        "sku": page.first(None, "data-test-id", "sku"),
        "gia_ban": page.first(None, "data-test", "price"),
        "gia_goc": F.get(page.inside(page.find(None, "data-test", "strike_price"), page.find("p")), F.lit(0)),
        "don_vi": page.first(None, "data-test", "unit"),
        "thuong_hieu": page.first("a", "href", BRAND_PATH, "^="),
    }
    beside = page.after(page.find("span", "data-test-id", "sku"), page.find("span"))
    read = indexed.select(
        F.col(url).alias("url"),
        _texts(page, texts | {"xuat_xu": brand_origin(page)}),
        page.attribute(page.first("meta", "property", "og:image"), "content").alias("hinh_anh"),
        F.transform(
            M._bound(beside, lambda s: _beside_sku(page, s)), lambda e: strip_ends(page.raw(e))
        ).alias("__beside"),
        detail_rows(page).alias("thong_tin_khac"),
        sections(page).alias("mo_ta"),
        *also,
    )
    # The rating, or null, and then the counts.
    both = F.size("__beside") >= 3
    return read.select("*", *_named("__texts", [*texts, "xuat_xu"])).select(
        "url", "ten", "sku", "gia_ban", "gia_goc", "don_vi", "thuong_hieu", "xuat_xu", "hinh_anh",
        F.get("__beside", F.lit(0)).alias("diem_danh_gia"),
        F.when(both, F.get("__beside", F.lit(1))).alias("so_danh_gia"),
        F.when(both, F.get("__beside", F.lit(2))).alias("so_binh_luan"),
        "thong_tin_khac", "mo_ta", *also,
    )


def _beside_sku(page: E.Page, spans: Column) -> Column:
    """The rating and the counts, as elements, among the spans that follow the SKU."""
    rating, counts = (page.find("span", "class", c, "*=", spans) for c in ("inline-flex", "cursor-pointer"))
    return F.concat(F.array(F.get(rating, F.lit(0))), counts)


# ---------------------------------------------------------------- state

def with_state(pages: DataFrame, html: str = "html") -> DataFrame:
    """Pages with their state; those without a product are left out.

    The state goes through a generator, past which no filter is pushed: the JSON
    is parsed once per page.
    """
    products = F.filter(F.array(S.page_props(F.col(html))), lambda p: p["product"].isNotNull())
    others = [c for c in pages.columns if c != html]
    return pages.select(*others, F.explode(products).alias("state"))


NO_STATE, BAD_STATE, NO_PRODUCT = "page holds no state", "state is not JSON", "state holds no product"


def state_rejects(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """``(url, reason)`` of the pages that ``with_state`` leaves out."""
    # Past the generator no filter is pushed, so the script is cut out once.
    read = pages.select(
        F.col(url).alias("url"),
        F.col(html).isNull().alias("no_page"),
        F.explode(F.array(S.state_json(F.col(html)))).alias("text"),
    )
    product = F.from_json("text", S.STATE_SCHEMA)["props"]["pageProps"]["product"]
    without = read.filter(product.isNull())
    reason = (
        F.when(F.col("no_page"), F.lit(MISSING_PAGE))
        .when(F.col("text").isNull(), F.lit(NO_STATE))
        .when(~S.is_json(F.col("text")), F.lit(BAD_STATE))
        .otherwise(F.lit(NO_PRODUCT))
    )
    return without.select("url", reason.alias("reason"))


# Columns of the flat and the nested product record, and where each
# comes from: a path of the state, or a fact named in ``product_facts``.
FLAT_FIELDS = {
    "ma_san_pham": "state.product.sku",
    "ten_san_pham": "state.product.webName",
    "ten_chinh_hang": "state.product.officialProductName",
    "thuong_hieu": "state.product.brand",
    "xuat_xu_thuong_hieu": "state.product.brandOrigin",
    "nuoc_san_xuat": "state.product.manufactor",
    "nha_san_xuat": "state.product.producer",
    "so_dang_ky": "state.product.registNum",
    "dang_bao_che": "state.product.dosageForm",
    "quy_cach": "state.product.specification",
    "han_su_dung": "state.product.expirationDate",
    "danh_muc": "category",
    "thanh_phan": "ingredients",
    "don_vi_tinh": "offer.measureUnitName",
    "gia_goc": "offer.price",
    "gia_ban": "final_price",
    "khuyen_mai": "promotions",
    "diem_danh_gia": "state.initReview.avgRating",
    "so_danh_gia": "state.initReview.total",
    "so_binh_luan": "state.initComment.total",
    "hinh_dai_dien": "main_image",
    "tat_ca_hinh": "images",
}
FLAT_TEXTS = {
    "mo_ta_ngan": "state.product.shortDescription",
    "cong_dung": "state.content.usage",
    "cach_dung": "state.content.dosage",
    "tac_dung_phu": "state.content.adverseEffect",
    "luu_y": "state.content.careful",
    "bao_quan": "state.content.preservation",
    "mo_ta_chi_tiet": "state.content.description",
}
NESTED_FIELDS = {
    "ten": "state.product.webName",
    "ten_chinh_hang": "state.product.officialProductName",
    "sku": "state.product.sku",
    "thuong_hieu": "state.product.brand",
    "xuat_xu_thuong_hieu": "state.product.brandOrigin",
    "nuoc_san_xuat": "state.product.manufactor",
    "nha_san_xuat": "state.product.producer",
    "so_dang_ky": "state.product.registNum",
    "dang_bao_che": "state.product.dosageForm",
    "quy_cach": "state.product.specification",
    "han_su_dung": "state.product.expirationDate",
    "danh_muc": "category",
    "thanh_phan": "ingredients",
    "don_vi": "offer.measureUnitName",
    "gia_goc": "offer.price",
    "gia_ban": "final_price",
    "khuyen_mai": "promotions",
    "diem_danh_gia": "state.initReview.avgRating",
    "so_danh_gia": "state.initReview.total",
    "so_binh_luan": "state.initComment.total",
    "hinh_anh": "images",
}
NESTED_TEXTS = {
    "cong_dung": "state.content.usage",
    "cach_dung": "state.content.dosage",
    "luu_y": "state.content.careful",
    "bao_quan": "state.content.preservation",
}


def product_facts(parsed: DataFrame) -> DataFrame:
    """Add to the state what a record derives from it."""
    product = F.col("state.product")
    promotions = F.col("state.initPromotionPrices")
    tags = F.get(promotions, F.lit(0))["promotionTags"]
    return parsed.withColumn("offer", S.default_price(product["prices"])).withColumns(
        {
            "category": S.path_text(product["categories"], PATH_SEPARATOR),
            "ingredients": S.strength_labels(product["ingredient"]),
            "final_price": S.final_price(promotions, F.col("offer.price")),
            "promotions": S.names(tags, "promotionTitle"),
            "main_image": F.coalesce(product["primaryImage"]["url"], F.lit("")),
            "images": S.image_list(product["primaryImage"], product["secondaryImages"]),
        }
    )


def _with_texts(parsed: DataFrame, texts: dict[str, str], clean: Callable[[Column], Column]) -> DataFrame:
    """Add the cleaned fragments as the array ``texts``.

    They go through one array, so the plan holds their cleaning once.
    """
    markup = F.transform(F.array(*[F.col(path) for path in texts.values()]), M.prepare)
    return parsed.withColumn("markup", markup).withColumn("texts", F.transform("markup", clean))


def _fields(fields: dict[str, str], texts: dict[str, str]) -> list[Column]:
    return [F.col(path).alias(name) for name, path in fields.items()] + _named("texts", texts)


def flat_product(parsed: DataFrame, url: str = "url") -> DataFrame:
    """The flat 30-column record of pages read by ``with_state``; lists are joined."""
    lists = {c: join_list(F.col(c), LIST_SEPARATOR) for c in ("ingredients", "promotions", "images")}
    read = _with_texts(product_facts(parsed), FLAT_TEXTS, M.block_text).withColumns(lists)
    return read.select(F.col(url).alias("url"), *_fields(FLAT_FIELDS, FLAT_TEXTS))


def nested_product(parsed: DataFrame, url: str = "url", also: tuple[str, ...] = ()) -> DataFrame:
    """The nested 25-field record, arrays kept, next to its URL.

    Columns named in ``also`` are passed on.
    """
    read = _with_texts(product_facts(parsed), NESTED_TEXTS, M.line_text)
    return read.select(F.col(url).alias("url"), *_fields(NESTED_FIELDS, NESTED_TEXTS), *also)


def two_source(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """``(url, dom, nextdata)``: both readings of each page, taken where it lies.

    Pages whose markup names no product, or that hold no state, give no row.
    """
    raw = pages.select(F.col(url).alias("url"), F.col(html).alias("html"), F.col(html).alias("__raw"))
    shown = dom_record(raw, also=("__raw",))
    fields = [c for c in shown.columns if c not in ("url", "__raw")]
    # A generator again: a filter on a field would read all fields a second time.
    named = F.filter(F.array(F.struct(*fields)), lambda d: d["ten"].isNotNull())
    dom = shown.select("url", "__raw", F.explode(named).alias("dom"))
    held = nested_product(with_state(dom, "__raw"), also=("dom",))
    fields = [c for c in held.columns if c not in ("url", "dom")]
    return held.select("url", "dom", F.struct(*fields).alias("nextdata"))


def result_rows(listed: DataFrame, flat: DataFrame, tool: str, run: int) -> DataFrame:
    """Rows of the results ledger: every listed URL, with its state record if any."""
    found = flat.select(
        "url",
        F.col("ten_san_pham").alias("ten"),
        F.col("gia_ban").alias("gia"),
        F.col("don_vi_tinh").alias("don_vi"),
        "thuong_hieu",
        "so_dang_ky",
    )
    status = F.when(F.col("error").isNull(), F.lit("ok")).otherwise(F.col("error"))
    return listed.select("url", status.alias("trang_thai")).join(found, "url", "left").withColumns(
        {"cong_cu": F.lit(tool), "lan": F.lit(run)}
    )
