"""Product pages derived from the part, lineitem, supplier and nation tables.

The given page table holds no product markup, so the record jobs read pages
rendered from the business tables: every part becomes one page that shows the
product in its markup and again in the state script. Each array in the state
has a fixed number of slots, filled from aggregates that are combined before
the shuffle; no list is gathered per part.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagetables.functions.state import STATE_SCRIPT_ID
from pagetables.operators.records import BRAND_LABEL, BRAND_PATH
from pagetables.sources.tables import table

SITE = "https://shop.example.com"
UNITS = ("A", "N", "R")
DEFAULT_UNIT = "R"
# Sizes from here on stand for pages that answered without a product.
BLOCKED_SIZE = 46


def offers(spark: SparkSession, folder: str) -> DataFrame:
    """Per part: one price per unit, the best discount, ratings and suppliers."""
    lines = table(spark, folder, "lineitem")
    price = F.floor("l_extendedprice")
    per_unit = [
        F.max(F.when(F.col("l_returnflag") == u, price)).alias(f"price_{u}") for u in UNITS
    ]
    return lines.groupBy(F.col("l_partkey").alias("p_partkey")).agg(
        *per_unit,
        F.min(price).alias("low_price"),
        F.max(F.round(F.col("l_discount") * 100).cast("int")).alias("best_discount"),
        F.count("*").alias("reviews"),
        F.count_if(F.col("l_linestatus") == "O").alias("comments"),
        F.sum(F.col("l_quantity").cast("bigint")).alias("quantity"),
        F.min("l_suppkey").alias("first_supp"),
        F.max("l_suppkey").alias("last_supp"),
    )


def products(spark: SparkSession, folder: str) -> DataFrame:
    """One row per part with all that its page shows."""
    # Rendering is the costly part, so the pages are spread over all tasks. The
    # key is that of the join with the offers, which then moves no page again.
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    parts = table(spark, folder, "part").select(
        "p_partkey", "p_name", "p_brand", "p_type", "p_size"
    ).repartition(tasks, "p_partkey")
    suppliers = table(spark, folder, "supplier").select(
        F.col("s_suppkey").alias("first_supp"), "s_name", "s_nationkey"
    )
    nations = table(spark, folder, "nation")
    regions = table(spark, folder, "region")
    return (
        parts.join(offers(spark, folder), "p_partkey", "left")
        .join(suppliers, "first_supp", "left")
        .join(nations, F.col("s_nationkey") == F.col("n_nationkey"), "left")
        .join(regions, F.col("n_regionkey") == F.col("r_regionkey"), "left")
    )


# The expressions below are templates in SQL: one page is one long ``concat``.
SKU = "lpad(cast(p_partkey AS string), 8, '0')"
PAGE_URL = f"concat('{SITE}/p/', translate(p_name, ' ', '-'), '-', p_partkey, '.html')"
MAIN_IMAGE = f"if(p_type <> 'PROMO', concat('{SITE}/img/p', p_partkey, '.jpg'), null)"
LIST_PRICE = "coalesce(price_R, price_A, price_N)"
OFFICIAL_NAME = "if(p_size > 5, concat(p_brand, ' ', p_name), null)"


def _price(unit: str) -> str:
    default = str(unit == DEFAULT_UNIT).lower()
    return (
        f"if(price_{unit} IS NULL, null, named_struct('isSellDefault', {default}, "
        f"'measureUnitName', 'unit {unit}', 'price', cast(price_{unit} AS double)))"
    )


def _image(key: str) -> str:
    return f"if({key} IS NULL, null, named_struct('url', concat('{SITE}/img/s', {key}, '.jpg')))"


# ``to_json`` leaves out null fields, so the promotions, where an explicit null
# differs from an absent key, are put together as text.
STATE = f"""
concat('{{"props":{{"pageProps":{{"product":', to_json(named_struct(
    'sku', {SKU}, 'webName', p_name, 'officialProductName', {OFFICIAL_NAME}, 'brand', p_brand,
    'brandOrigin', n_name, 'manufactor', r_name, 'producer', s_name,
    'registNum', concat(p_partkey, '/', p_size), 'dosageForm', p_type,
    'specification', concat('Box of ', p_size), 'expirationDate', concat(p_size, ' months'),
    'shortDescription', concat('<p>', p_name, ' &amp; ', p_brand, '</p>'),
    'categories', array(named_struct('name', r_name), named_struct('name', n_name),
                        named_struct('name', p_type)),
    'ingredient', transform(split(p_name, ' '), w -> named_struct(
        'name', w, 'shortDescription', if(p_size <= 40, concat(p_size, 'mg'), null))),
    'prices', array_compact(array({", ".join(_price(u) for u in UNITS)})),
    'primaryImage', if(p_type <> 'PROMO', named_struct('url', {MAIN_IMAGE}), null),
    'secondaryImages', array_compact(array({_image("first_supp")}, {_image("last_supp")})))),
  ',"content":', to_json(named_struct(
    'usage', concat('<p>For <b>', p_name, '</b>\\n use.</p><li> </li><li>', p_brand),
    'dosage', concat('take  ', p_size, '\\ta day'),
    'careful', concat('<ul><li>Keep <i>dry</i></li><li>', p_type, ' &lt;3</li></ul>'),
    'preservation', '<div>Cool &amp; dark</div>',
    'description', concat('<h2>', p_name, '</h2><p>one<p>two <br>three</p>'))),
  ',"initPromotionPrices":', CASE
    WHEN best_discount >= 10 THEN concat('[{{"finalPrice":', low_price,
      ',"promotionTags":[{{"promotionTitle":"-', best_discount, '%"}},{{"promotionTitle":"Voucher"}}]}}]')
    WHEN best_discount = 9 THEN '[{{"finalPrice":null,"promotionTags":[]}}]'
    WHEN best_discount = 8 THEN '[{{"promotionTags":[{{"promotionTitle":"Gift"}}]}}]'
    ELSE 'null' END,
  ',"initReview":', to_json(named_struct('avgRating', quantity / reviews, 'total', reviews)),
  ',"initComment":', to_json(named_struct('total', comments)), '}}}}}}')
"""


def _shown(price: str) -> str:
    """A price as the page shows it, e.g. ``380.000đ``."""
    return f"concat(translate(format_number({price}, 0), ',', '.'), 'đ')"


def _row(label: str, value: str) -> str:
    return f"'<div><div><p> {label} </p></div><div><div><b>', {value}, '</b></div></div></div>'"


PAGE = f"""
concat('<!DOCTYPE html><html><head><title>', p_name, '</title>',
  coalesce(concat('<meta property="og:image" content="', {MAIN_IMAGE}, '">'), ''),
  '<!-- <h1 data-test="product_name">old</h1> --></head><body>',
  '<h1 data-test="product_name">', p_name, '</h1>',
  '<div class="usage">menu</div><section><div><i></i><div><span>', n_name, '</span></div></div>',
  '<div><span>{BRAND_LABEL}: </span><a href="{BRAND_PATH}', translate(p_brand, '#', '-'), '">',
  p_brand, '</a></div></section>',
  '<div><span data-test-id="sku">', {SKU}, '</span>',
  '<span class="inline-flex items-center"><i class="star"></i><span>', floor(quantity / reviews), '</span></span>',
  if(p_size > 3, concat('<span class="cursor-pointer">', reviews, ' đánh giá</span>'), ''),
  '<span class="cursor-pointer">', comments, ' bình luận</span></div>',
  '<span data-test="price"><span>', {_shown(f"if(best_discount >= 10, low_price, {LIST_PRICE})")},
  '</span><i></i></span>/<span data-test="unit">unit ',
  CASE WHEN price_R IS NOT NULL THEN 'R' WHEN price_A IS NOT NULL THEN 'A' ELSE 'N' END, '</span>',
  if(best_discount >= 10,
     concat('<div data-test="strike_price"><p>', {_shown(LIST_PRICE)}, '</p></div>'), ''),
  '<section>', {_row("Tên chính hãng", f"coalesce({OFFICIAL_NAME}, '')")},
  {_row("Số đăng ký", "p_partkey, '/', p_size")},
  {_row("Danh mục", "p_type")},
  {_row("Nhà sản xuất", "s_name")}, '</section>',
  '<div id="content-wrapper"><div class="usage"><div>For <b>', p_name, '</b></div> use.</div>',
  '<div class="box dosage"> take ', p_size, ' a day </div></div>',
  '<!-- <script id="{STATE_SCRIPT_ID}">{{"props":1}}</script> -->',
  '<script id="{STATE_SCRIPT_ID}" type="application/json">', replace(state, '<', '\\\\u003c'),
  '</script></body></html>')
"""

# Some of the pages without a product hold a state that breaks off.
BROKEN_STATE = "p_partkey % 2 = 0"
BLOCKED_PAGE = f"""
concat('<html><head><title>Blocked</title></head><body>Please wait', if({BROKEN_STATE},
  '<script id="{STATE_SCRIPT_ID}" type="application/json">{{"props":{{"pageProps":{{"product"</script>', ''),
  '</body></html>')
"""


def product_pages(spark: SparkSession, folder: str) -> DataFrame:
    """``(page_id, url, html)`` of every part."""
    blocked = f"p_size >= {BLOCKED_SIZE} OR reviews IS NULL"
    return (
        products(spark, folder)
        .withColumn("state", F.expr(STATE))
        .selectExpr(
            "p_partkey AS page_id",
            f"{PAGE_URL} AS url",
            f"if({blocked}, {BLOCKED_PAGE}, {PAGE}) AS html",
        )
    )
