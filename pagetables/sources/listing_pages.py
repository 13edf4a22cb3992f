"""Listing pages and answers of the listing service, derived from the part table.

A listing is a part type, a round of it the parts of a hundred keys. The page of a round
shows cards, two links each, in its products section; links and a button outside the
section, links with something behind ``.html``, and a button without a number are there
to be left out. Some parts are named by the service only; the first ones of a
round are named again in the next.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagetables.functions.links import SECTION_ID
from pagetables.sources.tables import table

ROUND_KEYS = 100
# Sizes beyond this are named by the service only, sizes up to the other one twice.
SHOWN_SIZE, REPEATED_SIZE = 40, 5
# A round whose last key is a multiple of this shows no button for more.
LAST_KEY = 7

ROUND = f"p_partkey div {ROUND_KEYS} + 1"
PATH = "concat('/p/', translate(p_name, ' ', '-'), '-', p_partkey, '.html')"

_CARD = (
    "concat('<div class=\"card\"><a href=\"', c.path, '\"><img src=\"x.png\"></a>"
    "<div><a class=name href=\" ', c.path, '\">', c.name, '</a></div></div>')"
)
_PAGE = f"""
concat('<!DOCTYPE html><html><body><nav><a href="/p/nav-', round, '.html">n</a>',
  '<button>Xem thêm 9 sản phẩm</button></nav><section id="{SECTION_ID}">',
  '<a href="/p/ad-', round, '.html?ref=1">ad</a><a href="/brand/x">b</a><div class="grid">',
  array_join(transform(cards, c -> {_CARD}), '\\n'), '</div>',
  if(last_key % {LAST_KEY} = 0, '<button>Xem thêm</button>',
     concat('<button class="more"><span>Xem thêm</span>\\u00a0<b>', size(cards), '</b>\\n sản phẩm</button>')),
  '</section><div><a href="/p/below-', round, '.html">x</a></div>',
  '<footer><a href="/p/footer.html">f</a></footer></body></html>')
"""


def _parts(spark: SparkSession, folder: str) -> DataFrame:
    parts = table(spark, folder, "part").selectExpr(
        "p_type AS listing", f"{ROUND} AS round", "p_partkey", "p_name", "p_size", f"{PATH} AS path"
    )
    return parts.withColumn("round", F.col("round").cast("bigint"))


def listing_pages(spark: SparkSession, folder: str) -> DataFrame:
    """``(listing, round, html)``: one page per round, which holds a hundred keys at most."""
    card = F.struct(F.col("p_partkey"), F.col("path"), F.col("p_name").alias("name"))
    rounds = _parts(spark, folder).groupBy("listing", "round").agg(
        F.array_sort(F.collect_list(F.when(F.col("p_size") <= SHOWN_SIZE, card))).alias("cards"),
        F.max("p_partkey").alias("last_key"),
    )
    return rounds.selectExpr("listing", "round", f"{_PAGE} AS html")


def listing_answers(spark: SparkSession, folder: str) -> DataFrame:
    """``(listing, round, body)``: what the service answered in each round."""
    parts = _parts(spark, folder)
    own = parts.filter(F.col("p_size") > SHOWN_SIZE).withColumn("kind", F.lit(0))
    again = parts.filter(F.col("p_size") <= REPEATED_SIZE).withColumns({"round": F.col("round") + 1, "kind": F.lit(1)})
    named = own.unionByName(again).groupBy("listing", "round").agg(
        F.array_sort(F.collect_list(F.struct("kind", "p_partkey", "path"))).alias("found")
    )
    items = F.transform("found", lambda x: F.struct(F.struct(x["path"].alias("slug")).alias("item")))
    return named.select("listing", "round", F.to_json(F.struct(items.alias("items"))).alias("body"))
