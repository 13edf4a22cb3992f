"""Product records from page state and product markup."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pagetables import schemas
from pagetables.functions import state as S
from pagetables.operators import frontier as R
from pagetables.operators import records
from pagetables.operators.ledger import compare, reconcile
from pagetables.plans.registry import plan
from pagetables.session import fresh_path
from pagetables.sources import product_pages as P
from pagetables.sources import sinks
from pagetables.sources.tables import table

# What the pages were rendered from, straight from the business tables.
PRODUCTS = f"""
select *, coalesce(price_r, price_a, price_n) as list_price,
  'unit ' || case when price_r is not null then 'R' when price_a is not null then 'A' else 'N' end as unit,
  lpad(p_partkey::varchar, 8, '0') as sku,
  '{P.SITE}/p/' || replace(p_name, ' ', '-') || '-' || p_partkey || '.html' as url,
  case when p_size > 5 then p_brand || ' ' || p_name end as official,
  case when p_type <> 'PROMO' then '{P.SITE}/img/p' || p_partkey || '.jpg' end as main_image,
  '{P.SITE}/img/s' || first_supp || '.jpg' as image_1, '{P.SITE}/img/s' || last_supp || '.jpg' as image_2,
  p_partkey || '/' || p_size as regist,
  quantity::double / reviews as rating,
  case when best_discount >= 10 then low_price when best_discount = 9 then null
       else coalesce(price_r, price_a, price_n) end as final_price,
  case when best_discount >= 10 then ['-' || best_discount || '%', 'Voucher']
       when best_discount = 8 then ['Gift'] else [] end as titles,
  r_name || ' > ' || n_name || ' > ' || p_type as category,
  [w || case when p_size <= 40 then ' (' || p_size || 'mg)' else '' end
    for w in string_split(p_name, ' ')] as ingredients
from part join (
  select l_partkey,
    max(case when l_returnflag = 'A' then cast(floor(l_extendedprice) as bigint) end) as price_a,
    max(case when l_returnflag = 'N' then cast(floor(l_extendedprice) as bigint) end) as price_n,
    max(case when l_returnflag = 'R' then cast(floor(l_extendedprice) as bigint) end) as price_r,
    min(cast(floor(l_extendedprice) as bigint)) as low_price,
    max(cast(round(l_discount * 100) as integer)) as best_discount,
    count(*) as reviews, count(*) filter (l_linestatus = 'O') as comments,
    cast(sum(cast(l_quantity as bigint)) as bigint) as quantity,
    min(l_suppkey) as first_supp, max(l_suppkey) as last_supp
  from lineitem group by l_partkey) on l_partkey = p_partkey
join supplier on s_suppkey = first_supp
join nation on n_nationkey = s_nationkey
join region on r_regionkey = n_regionkey
where p_size < {P.BLOCKED_SIZE}
"""
BLOCKED = f"""
select *, '{P.SITE}/p/' || replace(p_name, ' ', '-') || '-' || p_partkey || '.html' as url from part
where p_size >= {P.BLOCKED_SIZE} or p_partkey not in (select l_partkey from lineitem)
"""


def _dots(sql: str) -> str:
    """A whole amount with dots between thousands."""
    return f"replace(format('{{:,}}', {sql}), ',', '.') || 'đ'"


def state_pages(spark: SparkSession, folder: str) -> DataFrame:
    return records.with_state(P.product_pages(spark, folder))


# ------------------------------------------------------------ state

@plan(f"select p_partkey as page_id, sku, p_name as name, comments from ({PRODUCTS})")
def embedded_state(spark: SparkSession, folder: str) -> DataFrame:
    """Scalars by path from the VARIANT of the state script."""
    found = P.product_pages(spark, folder).select(
        "page_id", F.try_parse_json(S.state_json(F.col("html"))).alias("v")
    )
    props = "$.props.pageProps"
    return found.filter("v is not null").select(
        "page_id",
        F.try_variant_get("v", f"{props}.product.sku", "string").alias("sku"),
        F.try_variant_get("v", f"{props}.product.webName", "string").alias("name"),
        F.try_variant_get("v", f"{props}.initComment.total", "bigint").alias("comments"),
    )


@plan("""
select event_id, cast(json_extract(props, '$.k') as bigint) as k, null::varchar as missing from events
""")
def json_path(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "events").select(
        "event_id",
        S.json_path(F.col("props"), "$.k", "bigint").alias("k"),
        S.json_path(F.col("props"), "$.a.b", "string").alias("missing"),
    )


@plan("""
select l_orderkey, coalesce(
    arg_min(l_partkey, l_linenumber::bigint * 1000000000 + l_partkey) filter (l_returnflag = 'R'),
    arg_min(l_partkey, l_linenumber::bigint * 1000000000 + l_partkey)) as partkey
from lineitem group by l_orderkey
""")
def default_pick(spark: SparkSession, folder: str) -> DataFrame:
    """Per order the first returned line, else its first line.

    An aggregate, so an order with a third of all lines is reduced map-side.
    """
    order = F.struct("l_linenumber", "l_partkey")
    flagged = F.when(F.col("l_returnflag") == "R", order)
    return table(spark, folder, "lineitem").groupBy("l_orderkey").agg(
        F.coalesce(F.min(flagged), F.min(order))["l_partkey"].alias("partkey")
    )


@plan(f"""
select url, case when {P.BROKEN_STATE} then '{records.BAD_STATE}' else '{records.NO_STATE}' end as reason
from ({BLOCKED})
""")
def state_rejects(spark: SparkSession, folder: str) -> DataFrame:
    """Pages that give no state record, and why."""
    return records.state_rejects(P.product_pages(spark, folder))


@plan(f"select p_partkey as page_id, unit, list_price from ({PRODUCTS})")
def default_price(spark: SparkSession, folder: str) -> DataFrame:
    pick = S.default_price(F.col("state.product.prices"))
    return state_pages(spark, folder).select(
        "page_id", pick["measureUnitName"].alias("unit"), pick["price"].alias("list_price")
    )


@plan(f"select p_partkey as page_id, final_price from ({PRODUCTS})")
def final_price(spark: SparkSession, folder: str) -> DataFrame:
    """Offered, explicitly null and absent final prices all occur."""
    list_price = S.default_price(F.col("state.product.prices"))["price"]
    return state_pages(spark, folder).select(
        "page_id", S.final_price(F.col("state.initPromotionPrices"), list_price).alias("final_price")
    )


@plan(f"""
select p_partkey as page_id, cast(unnest(range(len(l))) as integer) as pos, unnest(l) as image
from (select p_partkey, [x for x in [main_image, image_1, image_2] if x is not null] as l from ({PRODUCTS}))
""")
def image_list(spark: SparkSession, folder: str) -> DataFrame:
    product = F.col("state.product")
    images = S.image_list(product["primaryImage"], product["secondaryImages"])
    return state_pages(spark, folder).select("page_id", F.posexplode(images).alias("pos", "image"))


def slug_bodies(spark: SparkSession, folder: str) -> DataFrame:
    """API bodies with slugs at three depths, some not pages, in an order that
    neither sorted keys nor the text alone would give."""
    name = F.translate("p_name", " ", "-")
    body = F.concat(
        F.lit('{"z":{"slug":"'), name, F.lit('.html","sub":[1,{"deep":{"slug":"'), "p_brand",
        F.lit('.html"}},{"slug":7}]},"list":[{"x":{"slug":"/'), "p_type",
        F.lit('"}},{"a":[{"slug":"'), F.col("p_size").cast("string"),
        F.lit('.html"}],"slug":"caf\\u00e9-'), F.col("p_partkey").cast("string"), F.lit('.html"}]}'),
    )
    return table(spark, folder, "part").select("p_partkey", body.alias("body"))


@plan("""
select p_partkey, unnest(range(4))::integer as pos,
  unnest([replace(p_name, ' ', '-') || '.html', p_brand || '.html',
          'café-' || p_partkey || '.html', p_size || '.html']) as slug
from part
""")
def recursive_slugs(spark: SparkSession, folder: str) -> DataFrame:
    return slug_bodies(spark, folder).select(
        "p_partkey", F.posexplode(S.recursive_slugs(F.col("body"))).alias("pos", "slug")
    )


# ------------------------------------------------------------ records from state

_USAGE_BLOCKS = "'For ' || p_name || ' use.' || chr(10) || p_brand"


@plan(f"""
select url, sku as ma_san_pham, p_name as ten_san_pham, official as ten_chinh_hang, p_brand as thuong_hieu,
  n_name as xuat_xu_thuong_hieu, r_name as nuoc_san_xuat, s_name as nha_san_xuat, regist as so_dang_ky,
  p_type as dang_bao_che, 'Box of ' || p_size as quy_cach, p_size || ' months' as han_su_dung,
  category as danh_muc, array_to_string(ingredients, ' | ') as thanh_phan, unit as don_vi_tinh,
  list_price as gia_goc, final_price as gia_ban, array_to_string(titles, ' | ') as khuyen_mai,
  rating as diem_danh_gia, reviews as so_danh_gia, comments as so_binh_luan,
  coalesce(main_image, '') as hinh_dai_dien,
  concat_ws(' | ', main_image, image_1, image_2) as tat_ca_hinh,
  p_name || ' & ' || p_brand as mo_ta_ngan, {_USAGE_BLOCKS} as cong_dung,
  'take ' || p_size || ' a day' as cach_dung, '' as tac_dung_phu,
  'Keep dry' || chr(10) || p_type || ' <3' as luu_y, 'Cool & dark' as bao_quan,
  'one' || chr(10) || 'two three' as mo_ta_chi_tiet
from ({PRODUCTS})
""")
def flat_product(spark: SparkSession, folder: str) -> DataFrame:
    return records.flat_product(state_pages(spark, folder))


def _joined(df: DataFrame) -> DataFrame:
    """Arrays shown as text, so that both engines print them alike."""
    return df.select(
        *[
            F.array_join(f.name, " ; ").alias(f.name) if f.dataType.typeName() == "array" else F.col(f.name)
            for f in df.schema.fields
        ]
    )


@plan(f"""
select url, p_name as ten, official as ten_chinh_hang, sku, p_brand as thuong_hieu,
  n_name as xuat_xu_thuong_hieu, r_name as nuoc_san_xuat, s_name as nha_san_xuat, regist as so_dang_ky,
  p_type as dang_bao_che, 'Box of ' || p_size as quy_cach, p_size || ' months' as han_su_dung,
  category as danh_muc, array_to_string(ingredients, ' ; ') as thanh_phan, unit as don_vi,
  list_price as gia_goc, final_price as gia_ban, array_to_string(titles, ' ; ') as khuyen_mai,
  rating as diem_danh_gia, reviews as so_danh_gia, comments as so_binh_luan,
  concat_ws(' ; ', main_image, image_1, image_2) as hinh_anh,
  'For' || chr(10) || p_name || chr(10) || 'use.' || chr(10) || p_brand as cong_dung,
  'take  ' || p_size || chr(9) || 'a day' as cach_dung,
  'Keep' || chr(10) || 'dry' || chr(10) || p_type || ' <3' as luu_y, 'Cool & dark' as bao_quan
from ({PRODUCTS})
""")
def nested_product(spark: SparkSession, folder: str) -> DataFrame:
    return _joined(records.nested_product(state_pages(spark, folder)))


# ------------------------------------------------------------ records from markup

SALE_PRICE = _dots("case when best_discount >= 10 then low_price else list_price end")
STRIKE_PRICE = f"case when best_discount >= 10 then {_dots('list_price')} end"


@plan(f"""
select url, p_name as name, sku, {SALE_PRICE} as price_text,
  case when best_discount >= 10 then low_price else list_price end as price,
  case when best_discount >= 10 then list_price end as original_price, main_image as image,
  null::varchar as error
from ({PRODUCTS})
union all
select url, null, null, null, null, null, null, '{records.MISSING_NAME}' from ({BLOCKED})
""")
def listing_record(spark: SparkSession, folder: str) -> DataFrame:
    return records.listing_record(P.product_pages(spark, folder))


@plan(f"select url, '{records.MISSING_NAME}' as error from ({BLOCKED})")
def error_rows(spark: SparkSession, folder: str) -> DataFrame:
    listed = records.listing_record(P.product_pages(spark, folder))
    _, failed = records.split_failures(listed)
    return failed.select("url", "error")


@plan(f"""
select url, p_name as name, sku, {SALE_PRICE} as price_text,
  case when best_discount >= 10 then low_price else list_price end as price,
  case when best_discount >= 10 then list_price end as original_price, main_image as image
from ({PRODUCTS})
""")
def drop_failures(spark: SparkSession, folder: str) -> DataFrame:
    good, _ = records.split_failures(records.listing_record(P.product_pages(spark, folder)))
    return good


@plan(f"""
select url, p_name as name, sku, {SALE_PRICE} as price, {STRIKE_PRICE} as original_price, main_image as image
from ({PRODUCTS})
union all select url, null, null, null, null, null from ({BLOCKED})
""")
def simple_record(spark: SparkSession, folder: str) -> DataFrame:
    return records.simple_record(P.product_pages(spark, folder))


def _map_text(c: Column) -> Column:
    entries = F.transform(F.map_entries(c), lambda e: F.concat(e["key"], F.lit("="), e["value"]))
    return F.array_join(entries, "; ")


@plan(f"""
select url, p_name as ten, sku, {SALE_PRICE} as gia_ban, {STRIKE_PRICE} as gia_goc, unit as don_vi,
  p_brand as thuong_hieu, n_name as xuat_xu, main_image as hinh_anh,
  cast(floor(rating) as bigint)::varchar as diem_danh_gia,
  case when p_size > 3 then reviews || ' đánh giá' end as so_danh_gia,
  case when p_size > 3 then comments || ' bình luận' end as so_binh_luan,
  concat_ws('; ', 'Tên chính hãng=' || official, 'Số đăng ký=' || regist, 'Danh mục=' || p_type,
            'Nhà sản xuất=' || s_name) as thong_tin_khac,
  'usage=For ' || p_name || ' use.; dosage=take ' || p_size || ' a day' as mo_ta
from ({PRODUCTS})
union all select url, null, null, null, null, null, null, null, null, null, null, null, '', '' from ({BLOCKED})
""")
def dom_record(spark: SparkSession, folder: str) -> DataFrame:
    found = records.dom_record(P.product_pages(spark, folder))
    return found.withColumn("thong_tin_khac", _map_text(F.col("thong_tin_khac"))).withColumn(
        "mo_ta", _map_text(F.col("mo_ta"))
    )


# ------------------------------------------------------------ two readings

SHARED = ["ten", "sku", "thuong_hieu", "xuat_xu", "gia_ban", "gia_goc", "so_binh_luan", "danh_muc",
          "hinh_anh", "nuoc_san_xuat"]


def digits(c: str) -> Column:
    return F.regexp_replace(c, "[^0-9]", "")


def shown_fields(dom: str = "") -> list[Column]:
    """The shared fields as the markup shows them, from columns or a struct."""
    return [
        *[F.col(dom + c).alias(c) for c in ("ten", "sku", "thuong_hieu", "xuat_xu", "hinh_anh")],
        *[digits(dom + c).alias(c) for c in ("gia_ban", "gia_goc", "so_binh_luan")],
        *[
            F.col(dom + "thong_tin_khac")[label].alias(name)
            for name, label in (("danh_muc", "Danh mục"), ("nuoc_san_xuat", "Nước sản xuất"))
        ],
    ]


def held_fields(state: str = "") -> list[Column]:
    """The shared fields as the state holds them."""
    same = ("ten", "sku", "thuong_hieu", "gia_ban", "gia_goc", "so_binh_luan", "danh_muc", "nuoc_san_xuat")
    return [
        *[F.col(state + c).alias(c) for c in same],
        F.col(state + "xuat_xu_thuong_hieu").alias("xuat_xu"),
        F.get(state + "hinh_anh", F.lit(0)).alias("hinh_anh"),
    ]


RECONCILED = f"""
with p as ({PRODUCTS}),
a as (select url, unnest(['ten', 'sku', 'thuong_hieu', 'xuat_xu', 'gia_ban', 'gia_goc', 'so_binh_luan',
                          'danh_muc', 'hinh_anh']) as field,
  unnest([p_name, sku, p_brand, n_name,
    (case when best_discount >= 10 then low_price else list_price end)::varchar,
    (case when best_discount >= 10 then list_price end)::varchar,
    case when p_size > 3 then comments::varchar end, p_type, main_image]) as value from p),
b as (select url, unnest(['ten', 'sku', 'thuong_hieu', 'xuat_xu', 'gia_ban', 'gia_goc', 'so_binh_luan',
                          'danh_muc', 'hinh_anh', 'nuoc_san_xuat']) as field,
  unnest([p_name, sku, p_brand, n_name, final_price::varchar, list_price::varchar, comments::varchar,
    category, coalesce(main_image, image_1), r_name]) as value from p)
select coalesce(a.url, b.url) as url, coalesce(a.field, b.field) as field, a.value as value_a, b.value as value_b,
  case when b.value is null then 'only_a' when a.value is null then 'only_b'
       when a.value = b.value then 'equal' else 'differ' end as status
from (select * from a where value is not null) a
full outer join (select * from b where value is not null) b on a.url = b.url and a.field = b.field
"""


@plan(RECONCILED)
def reconcile_sources(spark: SparkSession, folder: str) -> DataFrame:
    """Markup against embedded state, as two tables joined on the URL."""
    pages = P.product_pages(spark, folder)
    shown = records.dom_record(pages).select("url", *shown_fields())
    held = records.nested_product(records.with_state(pages)).select("url", *held_fields())
    return reconcile(shown, held, "url", SHARED)


@plan(RECONCILED)
def reconcile_page(spark: SparkSession, folder: str) -> DataFrame:
    """The same, both readings taken from a page where it lies: nothing is joined."""
    both = records.two_source(P.product_pages(spark, folder))
    sides = both.select(
        "url", F.struct(*shown_fields("dom.")).alias("a"), F.struct(*held_fields("nextdata.")).alias("b")
    )
    return compare(sides, "url", "a", "b", SHARED)


@plan(f"""
select url, p_name as ten, {SALE_PRICE} as shown_price, final_price as held_price,
  p_type as danh_muc, 'For ' || p_name || ' use.' as usage, array_to_string(ingredients, ' ; ') as thanh_phan
from ({PRODUCTS})
""")
def two_source_json(spark: SparkSession, folder: str) -> DataFrame:
    """Both readings written as one JSON object per page, and read back."""
    both = records.two_source(P.product_pages(spark, folder))
    path = fresh_path(spark, "two-source")
    sinks.write_json(both, path)
    back = sinks.read_json(spark, path, both.schema)
    return back.select(
        "url",
        "dom.ten",
        F.col("dom.gia_ban").alias("shown_price"),
        F.col("nextdata.gia_ban").alias("held_price"),
        F.col("dom.thong_tin_khac")["Danh mục"].alias("danh_muc"),
        F.col("dom.mo_ta")["usage"].alias("usage"),
        F.array_join("nextdata.thanh_phan", " ; ").alias("thanh_phan"),
    )


# ------------------------------------------------------------ from links to records

def product_links(spark: SparkSession, folder: str) -> DataFrame:
    """A frontier of product links from listing answers.

    Parts of a size are listed in the same round; promoted parts are also listed
    under an old address that no page answers.
    """
    slug = F.concat(F.lit("p/"), F.translate("p_name", " ", "-"), F.lit("-"), "p_partkey", F.lit(".html"))
    old = F.when(F.col("p_type") == "PROMO", F.concat(F.lit("/old/"), "p_partkey", F.lit(".html")))
    items = F.transform(F.array_compact(F.array(slug, slug, old)), lambda x: F.struct(x.alias("slug")))
    answers = table(spark, folder, "part").select(
        "p_size", F.to_json(F.struct(items.alias("items"))).alias("body")
    )
    seen = R.api_sightings(answers, "p_size", S.recursive_slugs(F.col("body")), F.lit(P.SITE))
    return R.first_sightings(seen)


OLD_LINKS = f"""
select '{P.SITE}/old/' || p_partkey || '.html' as url, p_size::bigint as round from part where p_type = 'PROMO'
"""


@plan(f"""
select url, p_name as name, sku, {SALE_PRICE} as price_text,
  case when best_discount >= 10 then low_price else list_price end as price,
  case when best_discount >= 10 then list_price end as original_price, main_image as image,
  null::varchar as error, p_size::bigint as round
from ({PRODUCTS})
union all
select url, null, null, null, null, null, null, '{records.MISSING_NAME}', p_size from ({BLOCKED})
union all
select url, null, null, null, null, null, null, '{records.MISSING_PAGE}', round from ({OLD_LINKS})
""")
def category_crawl(spark: SparkSession, folder: str) -> DataFrame:
    """Listing answers to distinct links to pages to records, errors as rows."""
    pages = P.product_pages(spark, folder)
    return records.crawl(product_links(spark, folder), pages, also=("round",))


@plan(f"""
select 'state' as cong_cu, 1 as lan, url, 'ok' as trang_thai, p_name as ten, final_price as gia, unit as don_vi,
  p_brand as thuong_hieu, regist as so_dang_ky, null::double as thoi_gian_xu_ly
from ({PRODUCTS})
union all
select 'state', 1, url, '{records.MISSING_NAME}', null, null, null, null, null, null from ({BLOCKED})
""")
def result_ledger(spark: SparkSession, folder: str) -> DataFrame:
    """The results ledger under its fixed columns; nothing measures the time."""
    pages = P.product_pages(spark, folder)
    rows = records.result_rows(
        records.listing_record(pages), records.flat_product(records.with_state(pages)), "state", 1
    )
    return sinks.fixed_columns(rows, schemas.RESULTS).drop("thoi_diem")
