"""Link frontier: ordered distinct union of page links and API slugs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagetables.functions.links import resolve_href, resolve_slug
from pagetables.functions.markup import anchor_hrefs, prepare
from pagetables.operators.numbering import dense_index

# Seeds are seen before every round; page links of a round before its API slugs.
FROM_SEED, FROM_PAGE, FROM_API = 0, 1, 2
SIGHTING = ["round", "source", "pos"]


def seed_sightings(seeds: DataFrame, url: str, order: str) -> DataFrame:
    """``(url, round, source, pos)`` of a list of URLs to start from."""
    return _sightings(seeds, F.col(url), F.lit(-1), FROM_SEED, F.col(order))


def _sightings(found: DataFrame, url: Column, round_no: Column, source: int, pos: Column) -> DataFrame:
    return found.select(
        url.alias("url"),
        round_no.cast("bigint").alias("round"),
        F.lit(source).alias("source"),
        pos.cast("bigint").alias("pos"),
    )


def page_sightings(pages: DataFrame, round_col: str, html: str, base: Column) -> DataFrame:
    """``(url, round, source, pos)`` of every anchor on a page."""
    links = pages.select(
        F.col(round_col).alias("round"),
        base.alias("__base"),
        F.posexplode(anchor_hrefs(prepare(F.col(html)))).alias("pos", "__href"),
    )
    url = resolve_href(F.col("__base"), F.col("__href"))
    return _sightings(links, url, F.col("round"), FROM_PAGE, F.col("pos"))


def api_sightings(bodies: DataFrame, round_col: str, slugs: Column, base: Column) -> DataFrame:
    """``(url, round, source, pos)`` of every slug in an API body."""
    found = bodies.select(
        F.col(round_col).alias("round"),
        base.alias("__base"),
        F.posexplode(slugs).alias("pos", "__slug"),
    )
    url = resolve_slug(F.col("__base"), F.col("__slug"))
    return _sightings(found, url, F.col("round"), FROM_API, F.col("pos"))


def first_sightings(*sightings: DataFrame) -> DataFrame:
    """Each link once, at its first sighting.

    A minimum over the sighting, so links on every page are reduced to one row
    per input partition before the shuffle.
    """
    merged = sightings[0]
    for more in sightings[1:]:
        merged = merged.unionByName(more)
    first = F.min(F.struct(*SIGHTING)).alias("__first")
    return merged.groupBy("url").agg(first).select("url", "__first.*")


def first_links(frontier: DataFrame, n: int | None) -> DataFrame:
    """The first ``n`` links in order of sighting; None keeps them all."""
    if n is None:
        return frontier
    return frontier.orderBy(*SIGHTING, "url").limit(n)


def growth(
    frontier: DataFrame, rounds: DataFrame, max_links: int, max_rounds: int
) -> DataFrame:
    """Links gained per round, the first stop rule each round meets, and whether
    the harvest was still going when the round began.

    ``rounds(round, more)`` says whether a round showed that more remain. This is
    ``listing.progress`` of one listing.
    """
    from pagetables.operators.listing import progress

    one = F.lit(None).cast("string").alias("listing")
    told = progress(frontier.select("*", one), rounds.select("*", one), max_links, max_rounds)
    return told.select(
        "round", "new_links", "total_links", F.col("step").cast("int").alias("step"), "stop_rule", "going"
    )


def url_table(frontier: DataFrame, category: Column) -> DataFrame:
    """``(id, url, danh_muc)``: links numbered in order of sighting, with a category."""
    numbered = dense_index(frontier, [F.col(c) for c in (*SIGHTING, "url")], "id")
    return numbered.select("id", "url", category.alias("danh_muc"))
