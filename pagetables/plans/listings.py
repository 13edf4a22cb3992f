"""Listings: cards, buttons for more, rounds that stop, and the records behind the links."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagetables.functions import state as S
from pagetables.operators import listing as H
from pagetables.operators import records
from pagetables.plans.products import BLOCKED, PRODUCTS, SALE_PRICE
from pagetables.plans.registry import plan
from pagetables.session import materialize
from pagetables.sources import listing_pages as L
from pagetables.sources import product_pages as P

# Our limits: links per listing, and rounds.
MAX_LINKS, MAX_ROUNDS = 50, 20

_PARTS = f"""
select p_type as listing, p_partkey // {L.ROUND_KEYS} + 1 as round, p_partkey, p_size,
  '{P.SITE}/p/' || replace(p_name, ' ', '-') || '-' || p_partkey || '.html' as url
from part
"""
CARDS = f"""
select listing, url, round, 1 as source,
  (row_number() over (partition by listing, round order by p_partkey) - 1) * 2 as pos
from ({_PARTS}) where p_size <= {L.SHOWN_SIZE}
"""
NAMED = f"""
select listing, url, round, 2 as source,
  row_number() over (partition by listing, round order by kind, p_partkey) - 1 as pos
from (select listing, url, round, 0 as kind, p_partkey from ({_PARTS}) where p_size > {L.SHOWN_SIZE}
      union all
      select listing, url, round + 1, 1, p_partkey from ({_PARTS}) where p_size <= {L.REPEATED_SIZE})
"""
BUTTONS = f"""
select listing, round, max(p_partkey) % {L.LAST_KEY} <> 0 as more from ({_PARTS}) group by all
"""
FRONTIER = f"""
select * from ({CARDS} union all {NAMED})
qualify row_number() over (partition by listing, url order by round, source, pos) = 1
"""
PROGRESS = f"""
with firsts as ({FRONTIER}),
rounds as (
  select listing, round, bool_or(more) as more
  from ({BUTTONS} union all select listing, round, false from ({NAMED})) group by all),
gained as (select listing, round, count(*) as new_links from firsts group by all),
counted as (
  select listing, round, more, coalesce(new_links, 0) as new_links,
    cast(sum(coalesce(new_links, 0)) over by_round as bigint) as total_links, row_number() over by_round as step
  from rounds left join gained using (listing, round)
  window by_round as (partition by listing order by round)),
ruled as (
  select *, case when total_links >= {MAX_LINKS} then 'enough' when not more then 'no more'
                 when new_links = 0 then 'stalled' when step >= {MAX_ROUNDS} then 'round limit' end as stop_rule
  from counted)
select *, count(stop_rule) over (
    partition by listing order by round rows between unbounded preceding and 1 preceding) = 0 as going
from ruled
"""
HARVESTED = f"""
select * from (
  select listing, row_number() over (partition by listing order by round, source, pos, url) as rank,
    url, round, source, pos
  from ({FRONTIER}) join (select listing, round from ({PROGRESS}) where going) using (listing, round))
where rank <= {MAX_LINKS}
"""


def _read(spark: SparkSession, folder: str) -> DataFrame:
    return H.read_pages(L.listing_pages(spark, folder))


def _harvest(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """The frontier of all listings, and their progress.

    Pages are read once for their cards and buttons, the frontier is counted and then cut.
    """
    read, answers = materialize(_read(spark, folder), "listings"), L.listing_answers(spark, folder)
    base = F.lit(P.SITE)
    seen = H.card_sightings(read, base).unionByName(
        H.slug_sightings(answers, S.recursive_slugs(F.col("body")), base)
    )
    frontier = materialize(H.first_sightings(seen), "frontier")
    rounds = read.select("listing", "round", "more").unionByName(
        answers.select("listing", "round", F.lit(False).alias("more"))
    )
    return frontier, H.progress(frontier, rounds, MAX_LINKS, MAX_ROUNDS)


@plan(f"select * from ({CARDS})")
def card_frontier(spark: SparkSession, folder: str) -> DataFrame:
    """The cards of the products section: links of other parts of the page, and those with
    something behind the suffix, are left out."""
    return H.first_sightings(H.card_sightings(_read(spark, folder), F.lit(P.SITE)))


@plan(BUTTONS)
def more_button(spark: SparkSession, folder: str) -> DataFrame:
    """Whether the button of the products section names a number that remains."""
    return _read(spark, folder).select("listing", "round", "more")


@plan(f"select * from ({PROGRESS})")
def listing_progress(spark: SparkSession, folder: str) -> DataFrame:
    return _harvest(spark, folder)[1]


@plan(f"select listing, round, stop_rule, total_links from ({PROGRESS}) where going and stop_rule is not null")
def listing_stops(spark: SparkSession, folder: str) -> DataFrame:
    """The round that stopped each listing."""
    told = _harvest(spark, folder)[1].filter("going and stop_rule is not null")
    return told.select("listing", "round", "stop_rule", "total_links")


@plan(HARVESTED)
def listing_harvest(spark: SparkSession, folder: str) -> DataFrame:
    """The first links of each listing, none from after its stop."""
    return H.harvested(*_harvest(spark, folder), MAX_LINKS)


@plan(f"""
with kept as ({HARVESTED})
select listing, rank, url, name, sku, price_text, price, original_price, image, error
from kept join (
  select url, p_name as name, sku, {SALE_PRICE} as price_text,
    case when best_discount >= 10 then low_price else list_price end as price,
    case when best_discount >= 10 then list_price end as original_price, main_image as image,
    null::varchar as error
  from ({PRODUCTS})
  union all
  select url, null, null, null, null, null, null, '{records.MISSING_NAME}' from ({BLOCKED})) using (url)
""")
def listing_records(spark: SparkSession, folder: str) -> DataFrame:
    """From listing pages and answers to the records of the links that were kept."""
    kept = H.harvested(*_harvest(spark, folder), MAX_LINKS)
    pages = P.product_pages(spark, folder)
    return records.crawl(kept, pages, also=("listing", "rank"))
