"""Text cleaning over whole documents, and the sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagetables.functions import markup as M
from pagetables.functions import text as X
from pagetables.operators.records import LISTING_COLUMNS
from pagetables.plans.entities import ENTITY_SQL, entities
from pagetables.plans.registry import plan
from pagetables.session import fresh_path
from pagetables.sources import sinks
from pagetables.sources.tables import table

# The whitespace class of ``functions.text`` in RE2 notation.
SPACE_RE2 = (
    r"[\t-\r\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
)

LISTING_SCHEMA = T.StructType(
    [
        T.StructField(c, T.LongType() if c in ("price", "original_price") else T.StringType())
        for c in LISTING_COLUMNS
    ]
)


@plan(f"select doc_id, trim(regexp_replace(text, '{SPACE_RE2}+', ' ', 'g')) as text from documents")
def squash_whitespace(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "documents").select("doc_id", X.squash(F.col("text")).alias("text"))


@plan(f"""
select doc_id, array_to_string(
  [regexp_replace(x, '^{SPACE_RE2}+|{SPACE_RE2}+$', '', 'g') for x in string_split(text, '.')], '|') as text
from documents
""")
def strip_ends(spark: SparkSession, folder: str) -> DataFrame:
    sentences = F.transform(F.split("text", r"\."), X.strip_ends)
    return table(spark, folder, "documents").select(
        "doc_id", F.array_join(sentences, "|").alias("text")
    )


@plan("select doc_id, substring(text, 1, 200) as error from documents")
def truncate_text(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "documents").select("doc_id", X.truncate(F.col("text")).alias("error"))


@plan("""
select conv_id, turn,
  case when length(coalesce(t, '')) > 50 then substring(t, 1, 50) || '...' else coalesce(t, '') end as shown,
  case when length(t) > 50 then substring(t, 1, 50) || '...' else t end as shown_or_null
from (select conv_id, turn, case when role = 'system' then null else text end as t from conversations)
""")
def preview_text(spark: SparkSession, folder: str) -> DataFrame:
    text = F.when(F.col("role") != "system", F.col("text"))
    return table(spark, folder, "conversations").select(
        "conv_id",
        "turn",
        X.preview(text).alias("shown"),
        X.preview(text, null_as_empty=False).alias("shown_or_null"),
    )


@plan("""
select p_partkey, cast(floor(p_retailprice * p_size) as bigint) * 1000 as price,
       case when p_type <> 'PROMO' then cast(p_size as bigint) end as unit_price
from part
""")
def parse_price(spark: SparkSession, folder: str) -> DataFrame:
    """Prices rendered as on a page (``380.000đ/Hộp``) and read back."""
    amount = F.floor(F.col("p_retailprice") * F.col("p_size")) * 1000
    shown = F.concat(X.price_label(amount), F.lit("/Hộp "), "p_size")
    unit = F.when(F.col("p_type") == "PROMO", F.lit("Liên hệ/1")).otherwise(
        F.concat(F.lit("-"), F.col("p_size").cast("string"), F.lit(" đ"))
    )
    return table(spark, folder, "part").select(
        "p_partkey", X.parse_price(shown).alias("price"), X.parse_price(unit).alias("unit_price")
    )


@plan("""
select p_partkey,
  p_name || case when p_size > 40 then '' else ' (' || p_size || 'mg)' end as label
from part
""")
def label_pairs(spark: SparkSession, folder: str) -> DataFrame:
    strength = F.when(F.col("p_size") <= 40, F.concat(F.col("p_size").cast("string"), F.lit("mg")))
    return table(spark, folder, "part").select(
        "p_partkey", X.strength_label(F.col("p_name"), strength).alias("label")
    )


@plan("""
select n_nationkey, r_name || ' > ' || n_name as path
from nation join region on n_regionkey = r_regionkey
""")
def join_path(spark: SparkSession, folder: str) -> DataFrame:
    nations = table(spark, folder, "nation")
    regions = table(spark, folder, "region")
    joined = nations.join(regions, nations.n_regionkey == regions.r_regionkey)
    return joined.select(
        "n_nationkey", X.join_list(F.array("r_name", "n_name"), X.PATH_SEPARATOR).alias("path")
    )


@plan("""
select p_partkey, concat_ws(' | ', a, n, r) as flags
from part left join (
  select l_partkey, max(case when l_returnflag = 'A' then 'A' end) as a,
         max(case when l_returnflag = 'N' then 'N' end) as n,
         max(case when l_returnflag = 'R' then 'R' end) as r
  from lineitem group by l_partkey) on l_partkey = p_partkey
""")
def join_list(spark: SparkSession, folder: str) -> DataFrame:
    """Return flags of each part's lines; parts without any get ''."""
    seen = table(spark, folder, "lineitem").groupBy(F.col("l_partkey").alias("p_partkey")).agg(
        *[F.max(F.when(F.col("l_returnflag") == f, f)).alias(f) for f in ("A", "N", "R")]
    )
    parts = table(spark, folder, "part").select("p_partkey").join(seen, "p_partkey", "left")
    return parts.select("p_partkey", X.join_list(F.array("A", "N", "R")).alias("flags"))


@plan("select doc_id, text, lang, source, n_chars from documents")
def csv_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents")
    path = fresh_path(spark, "csv")
    sinks.write_csv(documents, path)
    return sinks.read_csv(spark, path, documents.schema)


@plan("select p_partkey, p_name, p_brand, p_type, p_size, p_retailprice from part")
def json_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    parts = table(spark, folder, "part")
    path = fresh_path(spark, "json")
    sinks.write_json(parts, path)
    return sinks.read_json(spark, path, parts.schema)


@plan(f"""
select id || repeat(' ', greatest(5 - length(id::varchar), 0))
    || name || repeat(' ', greatest(25 - length(name), 0))
    || age || repeat(' ', greatest(10 - length(age::varchar), 0))
    || major || repeat(' ', greatest(15 - length(major), 0)) as line
from ({ENTITY_SQL})
""")
def fixed_width_report(spark: SparkSession, folder: str) -> DataFrame:
    path = fresh_path(spark, "report")
    sinks.write_report(entities(spark, folder), ["id", "name", "age", "major"], "id", path)
    return spark.read.text(path).withColumnRenamed("value", "line")


@plan("""
select c_custkey as id, c_name as name, c_mktsegment as major, null::double as balance from customer
union all select s_suppkey, s_name, null, s_acctbal from supplier
""")
def union_schema(spark: SparkSession, folder: str) -> DataFrame:
    customers = table(spark, folder, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("major")
    )
    suppliers = table(spark, folder, "supplier").select(
        F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"), F.col("s_acctbal").alias("balance")
    )
    return sinks.union_columns(customers, suppliers)


@plan("""
select url, regexp_extract(url, '([0-9]+)', 1) as sku, null::varchar as name, null::varchar as price_text,
       null::bigint as price, null::bigint as original_price, null::varchar as image, null::varchar as error
from pages
""")
def fixed_columns(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages").select(
        F.regexp_extract("url", "([0-9]+)", 1).alias("sku"), "url", "page_id"
    )
    return sinks.fixed_columns(pages, LISTING_SCHEMA)


@plan(r"""
select page_id, coalesce(nullif(regexp_extract(url, '\?(.*)$', 1), ''),
                         regexp_extract(html, '<html lang="([a-z]*)"', 1)) as name
from pages
""")
def fallback_text(spark: SparkSession, folder: str) -> DataFrame:
    query = F.regexp_extract("url", r"\?(.*)$", 1)
    lang = M.first_attr(F.col("html"), "lang", "html")
    return table(spark, folder, "pages").select("page_id", X.fallback(query, lang).alias("name"))
