"""Harvests of many listings: cards of a page's section, rounds, and when they stop.

A listing may hold a third of all links and millions of rounds. Running sums over its
rounds are taken within blocks of rounds; one row per block carries what came before,
and everything else is joined by listing and block.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pagetables.functions import elements as E
from pagetables.functions.links import SECTION_ID, has_more, is_page_link, resolve_href, resolve_slug
from pagetables.functions.markup import _bound
from pagetables.operators.frontier import FROM_API, FROM_PAGE, SIGHTING
from pagetables.session import materialize

# Rounds of one listing whose running sums are taken together.
BLOCK_ROUNDS = 4096


def cards(page: E.Page, section: str = SECTION_ID) -> Column:
    """The links of the anchors in the products section that name a page, as they stand there."""
    anchors = page.inside(page.find(None, "id", section), page.find("a"))
    hrefs = F.transform(anchors, lambda a: page.attribute(a, "href"))
    return F.filter(hrefs, is_page_link)


def more_left(page: E.Page, section: str = SECTION_ID) -> Column:
    """Whether a button in the products section says that more remain."""
    buttons = page.inside(page.find(None, "id", section), page.find("button"))
    return F.coalesce(_bound(buttons, lambda bs: F.exists(bs, lambda b: has_more(page.raw(b)))), F.lit(False))


def read_pages(pages: DataFrame, section: str = SECTION_ID) -> DataFrame:
    """``(listing, round, hrefs, more)`` of listing pages (``listing``, ``round``, ``html``).

    A page that is missing shows no cards and no button.
    """
    page = E.Page("__page")
    return E.with_index(pages.select("listing", "round", "html"), "html", "__page").select(
        "listing", F.col("round").cast("bigint").alias("round"),
        F.coalesce(cards(page, section), F.array().cast("array<string>")).alias("hrefs"),
        more_left(page, section).alias("more"),
    )


def card_sightings(read: DataFrame, base: Column) -> DataFrame:
    """``(listing, url, round, source, pos)`` of the cards of pages read by ``read_pages``."""
    links = read.select("listing", "round", F.posexplode("hrefs").alias("pos", "href"))
    return _seen(links, resolve_href(base, F.col("href")), FROM_PAGE)


def slug_sightings(answers: DataFrame, slugs: Column, base: Column) -> DataFrame:
    """``(listing, url, round, source, pos)`` of the slugs of answers (``listing``, ``round``)."""
    links = answers.select("listing", "round", F.posexplode(slugs).alias("pos", "slug"))
    return _seen(links, resolve_slug(base, F.col("slug")), FROM_API)


def _seen(links: DataFrame, url: Column, source: int) -> DataFrame:
    return links.select(
        "listing", url.alias("url"), F.col("round").cast("bigint").alias("round"),
        F.lit(source).alias("source"), F.col("pos").cast("bigint").alias("pos"),
    )


def first_sightings(sightings: DataFrame) -> DataFrame:
    """Each link of a listing once, at its first sighting there."""
    first = F.min(F.struct(*SIGHTING)).alias("__first")
    return sightings.groupBy("listing", "url").agg(first).select("listing", "url", "__first.*")


def progress(
    frontier: DataFrame, rounds: DataFrame, max_links: int, max_rounds: int, block_rounds: int = BLOCK_ROUNDS
) -> DataFrame:
    """What each round of each listing brought: ``listing``, ``round``, ``more``, ``new_links``,
    ``total_links``, ``step``, the first ``stop_rule`` that it meets, and whether
    the harvest was still ``going`` when it began.

    ``rounds`` (``listing``, ``round``, ``more``) names every round; one that was seen
    several times has more left if any sighting says so. A round that begins after a
    stop is no part of the harvest: ``going`` is false. The listing may be null.
    """
    same = ["listing", "round"]
    gained = frontier.groupBy(*same).agg(F.count("*").alias("new_links"))
    seen = rounds.groupBy(*same).agg(F.coalesce(F.bool_or("more"), F.lit(False)).alias("more"))
    joined = seen.alias("s").join(
        gained.alias("g"), F.expr("s.listing <=> g.listing AND s.round = g.round"), "left"
    )
    rows = materialize(
        joined.select("s.listing", "s.round", "more", F.coalesce("new_links", F.lit(0)).alias("new_links"))
        .withColumn("block", F.floor(F.col("round") / block_rounds)),
        "rounds",
    )

    def before(blocks: DataFrame, sums: dict[str, Column]) -> DataFrame:
        """Per block, sums over the blocks of its listing that come before it."""
        earlier = Window.partitionBy("listing").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
        made = [F.coalesce(c.over(earlier), F.lit(0)).alias(name) for name, c in sums.items()]
        return blocks.select(F.col("listing").alias("of"), F.col("block").alias("in_block"), *made)

    def with_before(part: DataFrame, facts: DataFrame) -> DataFrame:
        return part.join(facts, F.expr("listing <=> of AND block = in_block")).drop("of", "in_block")

    within = Window.partitionBy("listing", "block").orderBy("round")
    so_far = within.rowsBetween(Window.unboundedPreceding, 0)
    sums = rows.groupBy("listing", "block").agg(F.sum("new_links").alias("links"), F.count("*").alias("rounds"))
    carried = before(sums, {"links_before": F.sum("links"), "rounds_before": F.sum("rounds")})
    counted = with_before(
        rows.withColumns({"total": F.sum("new_links").over(so_far), "step": F.row_number().over(within)}), carried
    )
    total, step = F.col("links_before") + F.col("total"), F.col("rounds_before") + F.col("step")
    stop = (
        F.when(F.col("total_links") >= max_links, "enough")
        .when(~F.col("more"), "no more")
        .when(F.col("new_links") == 0, "stalled")
        .when(F.col("step") >= max_rounds, "round limit")
    )
    ruled = counted.select(
        "listing", "round", "block", "more", "new_links", total.alias("total_links"), step.alias("step")
    ).withColumn("stop_rule", stop)
    stops = ruled.groupBy("listing", "block").agg(F.count("stop_rule").alias("stops"))
    told = with_before(
        ruled.withColumn("stops", F.count("stop_rule").over(within.rowsBetween(Window.unboundedPreceding, -1))),
        before(stops, {"stops_before": F.sum("stops")}),
    )
    going = F.col("stops") + F.col("stops_before") == 0
    return told.select(
        "listing", "round", "more", "new_links", "total_links", "step", "stop_rule", going.alias("going")
    )


def harvested(frontier: DataFrame, told: DataFrame, max_links: int | None = None) -> DataFrame:
    """The links of each listing up to the round that stopped it, with their ``rank`` in
    order of sighting; the first ``max_links`` of them, or all.

    ``told`` is of ``progress``. A link's rank is its place in its round, which one
    page and its answers fill, after all links of the rounds before.
    """
    rounds = told.filter("going").select(
        F.col("listing").alias("of"), F.col("round").alias("in_round"),
        (F.col("total_links") - F.col("new_links")).alias("earlier"),
    )
    placed = frontier.join(rounds, F.expr("listing <=> of AND round = in_round"))
    in_round = Window.partitionBy("listing", "round").orderBy("source", "pos", "url")
    ranked = placed.withColumn("rank", F.col("earlier") + F.row_number().over(in_round))
    kept = ranked if max_links is None else ranked.filter(F.col("rank") <= max_links)
    return kept.select("listing", "rank", "url", *SIGHTING)
