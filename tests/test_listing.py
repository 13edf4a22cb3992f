"""Harvests of listings: cards, buttons, stop rules, blocks of rounds, first links."""

import random

import pytest
from pyspark.sql import functions as F

from pagetables.functions.links import SECTION_ID
from pagetables.operators import listing as H

ROUNDS = "listing string, round bigint, more boolean"
LINKS = "listing string, url string, round bigint, source int, pos bigint"


def test_cards_and_buttons(spark):
    def page(inner, outside=""):
        return f"<nav><a href='/n.html'></a></nav><div id='{SECTION_ID}'>{inner}</div>{outside}"

    pages = [
        ("a", 1, page("<a href=' /1.html'><a href='/2.html?x'>q</a><a href='/3.HTML'>r</a><a>s</a><p><a href=\"/4.html\">")),
        ("a", 2, page("<a href='/5.html'></a><button><i>Xem</i> thêm 12\n sản phẩm</button>")),
        ("a", 3, page("<button>Xem thêm</button>", "<button>Xem thêm 5 sản phẩm</button><a href='/6.html'></a>")),
        ("a", 4, None),
        ("b", 1, "<a href='/7.html'>no section</a>"),
        (None, 1, page("<button><b>Xem thêm</b>  3  sản phẩm nữa</button><a href='http://x.example/8.html'></a>")),
    ]
    read = H.read_pages(spark.createDataFrame(pages, "listing string, round int, html string"))
    rows = {(r.listing, r.round): (r.hrefs, r.more) for r in read.collect()}
    assert rows == {
        ("a", 1): ([" /1.html", "/4.html"], False), ("a", 2): (["/5.html"], True), ("a", 3): ([], False),
        ("a", 4): ([], False), ("b", 1): ([], False), (None, 1): (["http://x.example/8.html"], True),
    }
    seen = H.card_sightings(read, F.lit("https://h.example"))
    assert {(r.listing, r.url, r.pos) for r in seen.collect()} == {
        ("a", "https://h.example/1.html", 0), ("a", "https://h.example/4.html", 1),
        ("a", "https://h.example/5.html", 0), (None, "http://x.example/8.html", 0),
    }


def test_each_stop_rule(spark):
    links = [
        *[("enough", f"e{i}", 1 + i // 3, 1, i) for i in range(9)],
        *[("no more", f"n{i}", 1 + i, 1, i) for i in range(4)],
        *[("stalled", f"s{i}", 1 + 2 * i, 1, i) for i in range(3)],
        *[("round limit", f"r{i}", 1 + i, 1, i) for i in range(8)],
        *[("open", f"o{i}", 1 + i, 1, i) for i in range(2)],
    ]
    rounds = [(name, r, True) for name in ("enough", "stalled", "round limit") for r in range(1, 9)]
    rounds += [("no more", 1, True), ("no more", 2, False), ("no more", 2, None), ("no more", 3, True), ("no more", 4, True)]
    rounds += [("open", 1, True), ("open", 1, False), ("open", 2, True)]
    frontier = spark.createDataFrame(links, LINKS)
    told = H.progress(frontier, spark.createDataFrame(rounds, ROUNDS), max_links=5, max_rounds=4)
    stops = {r.listing: (r.round, r.stop_rule) for r in told.filter("going and stop_rule is not null").collect()}
    assert stops == {
        "enough": (2, "enough"), "no more": (2, "no more"), "stalled": (2, "stalled"), "round limit": (4, "round limit"),
    }
    kept = {}
    for r in H.harvested(frontier, told, max_links=5).orderBy("listing", "rank").collect():
        kept.setdefault(r.listing, []).append((r.rank, r.url))
    assert kept == {
        "enough": [(i + 1, f"e{i}") for i in range(5)], "no more": [(1, "n0"), (2, "n1")], "stalled": [(1, "s0")],
        "round limit": [(i + 1, f"r{i}") for i in range(4)], "open": [(1, "o0"), (2, "o1")],
    }
    assert H.harvested(frontier, told).filter("listing = 'enough'").count() == 6
    assert H.progress(frontier.limit(0), told.limit(0), 5, 4).count() == 0


@pytest.mark.parametrize("block", [1, 3, 1000])
def test_progress_equals_a_loop(spark, block):
    rnd = random.Random(block)
    links, rounds = [], []
    for name in ("x", "y", "z", None):
        for r in sorted(rnd.sample(range(-20, 60), 30)):
            rounds.append((name, r, rnd.random() < 0.9))
            links += [(name, f"{r}/{i}", r, rnd.randint(1, 2), i) for i in range(rnd.choice((0, 1, 2, 5)))]
    frontier = spark.createDataFrame(links, LINKS)
    told = H.progress(frontier, spark.createDataFrame(rounds, ROUNDS), 40, 25, block)
    wanted = set()
    for name in ("x", "y", "z", None):
        total, going = 0, True
        for step, (_, r, more) in enumerate([x for x in rounds if x[0] == name], 1):
            new = sum(link[0] == name and link[2] == r for link in links)
            total += new
            rule = "enough" if total >= 40 else "no more" if not more else "stalled" if not new else "round limit" if step >= 25 else None
            wanted.add((name, r, more, new, total, step, rule, going))
            going = going and rule is None
    assert {tuple(r) for r in told.collect()} == wanted


def test_one_listing_of_a_million_rounds(spark):
    rounds = spark.range(1_000_000).select(F.lit("hot").alias("listing"), F.col("id").alias("round"), F.lit(True).alias("more"))
    frontier = rounds.select(
        "listing", F.col("round").cast("string").alias("url"), "round", F.lit(1).alias("source"), F.lit(0).cast("bigint").alias("pos")
    )
    told = H.progress(frontier, rounds, 900_001, 2_000_000)
    assert [(r.round, r.stop_rule) for r in told.filter("going and stop_rule is not null").collect()] == [(900_000, "enough")]
    plan = told._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan
    assert H.harvested(frontier, told, 900_000).agg(F.count("*"), F.max("rank")).first()[:] == (900_000, 900_000)
