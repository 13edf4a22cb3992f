"""Frontier, robots and schedule, against brute force and the standard library."""

import itertools
from urllib import robotparser

import pytest
from pyspark.sql import functions as F

from pagetables.operators import frontier as R
from pagetables.operators import policy


def test_frontier_first_sighting_wins(spark):
    base = F.lit("https://h.example")
    pages = spark.createDataFrame(
        [(1, '<a href="/a.html"></a><a href=" /b.html "></a><a href="/a.html"></a>'), (2, '<a href="/c.html"></a>')],
        "round int, html string",
    )
    bodies = spark.createDataFrame([(1, ["c.html", "/b.html"]), (2, ["d.html"])], "round int, slugs array<string>")
    seeds = spark.createDataFrame([(7, "https://h.example/s.html"), (3, "https://h.example/d.html")], "n int, url string")
    found = R.first_sightings(
        R.seed_sightings(seeds, "url", "n"),
        R.page_sightings(pages, "round", "html", base),
        R.api_sightings(bodies, "round", F.col("slugs"), base),
    )
    ordered = [r.url.removeprefix("https://h.example/") for r in R.first_links(found, None).orderBy(*R.SIGHTING).collect()]
    assert ordered == ["d.html", "s.html", "a.html", "b.html", "c.html"]
    assert [r.url for r in R.first_links(found, 2).orderBy(*R.SIGHTING).collect()] == [
        "https://h.example/d.html", "https://h.example/s.html",
    ]
    twice = R.first_sightings(found, found)
    assert sorted(map(tuple, twice.collect())) == sorted(map(tuple, found.collect()))


def test_growth_and_stop_rules(spark):
    rows = [("a", 1, True), ("b", 1, False), ("a", 2, True), ("c", 3, True), ("d", 3, True), ("d", 4, False), ("e", 5, True)]
    seen = spark.createDataFrame(rows, "url string, round int, more boolean").select(
        "url", "round", "more", F.lit(0).alias("source"), F.lit(0).alias("pos")
    )
    found = R.growth(R.first_sightings(seen), seen, max_links=5, max_rounds=3).orderBy("round").collect()
    assert [(r.new_links, r.total_links, r.stop_rule, r.going) for r in found] == [
        (2, 2, None, True), (0, 2, "stalled", True), (2, 4, "round limit", False), (0, 4, "no more", False),
        (1, 5, "enough", False),
    ]


def test_url_table_numbers_by_sighting(spark):
    rows = [("https://h/b", 2, 0, 0), ("https://h/a", 1, 1, 5), ("https://h/c", 1, 1, 4)]
    frontier = spark.createDataFrame(rows, "url string, round bigint, source int, pos bigint")
    found = R.url_table(frontier, F.lit("x")).orderBy("id").collect()
    assert [(r.id, r.url[-1]) for r in found] == [(1, "c"), (2, "a"), (3, "b")]


ROBOTS = [
    "User-agent: *\nDisallow: /private\nAllow: /private/open\nCrawl-delay: 7\n",
    "User-agent: bot\nUser-agent: other # two\nDisallow: /\n\nUser-agent: *\nDisallow:\n",
    "User-agent: *\n\nDisallow: /a\nUser-agent: bot\n# note\nAllow: /a/b\nDisallow: /a\nCrawl-delay: x\nCrawl-delay: 3",
    "Disallow: /\n",
    "User-agent: *\nDisallow: /%7Ejoe\nDisallow: /a%3cd\nDisallow: /x y\n\n\nUser-agent: *\nDisallow: /\n",
    "user-agent: Bot/1.0\r\nDISALLOW: /a?q=1\r\nSitemap: https://h.example/s.xml\r\nDisallow: /b\r\n",
    "",
]
PATHS = ["/", "", "/private", "/private/open", "/a", "/a/b", "/~joe/x", "/a<d", "/a%3Cd", "/x%20y", "/a?q=1", "/b#f"]


@pytest.mark.parametrize("agent", ["*", "bot", "Bot/2.1", "none"])
def test_robots_as_the_standard_library(spark, agent):
    hosts = [(f"h{i}.example", 200, text) for i, text in enumerate(ROBOTS)]
    robots = spark.createDataFrame(hosts, "host string, status int, body string")
    urls = [(f"https://{h}{p}",) for (h, _, _), p in itertools.product(hosts, PATHS)]
    got = {
        r.url: (r.allowed, r.delay)
        for r in policy.verdicts(spark.createDataFrame(urls, "url string"), robots, agent).collect()
    }
    expected = {}
    for host, _, text in hosts:
        parser = robotparser.RobotFileParser()
        parser.parse(text.splitlines())
        for path in PATHS:
            url = f"https://{host}{path}"
            expected[url] = (parser.can_fetch(agent, url), parser.crawl_delay(agent))
    assert got == expected


def test_robots_status_sitemaps_and_longest(spark):
    rows = [("a", 403, ""), ("b", 404, "User-agent: *\nDisallow: /"), ("c", 200, ROBOTS[0] + "Sitemap: s1\nSitemap: s2")]
    robots = spark.createDataFrame(rows, "host string, status int, body string")
    urls = spark.createDataFrame([(f"https://{h}/private/open/x",) for h in "abcd"], "url string")
    verdict = {r.host: r.allowed for r in policy.verdicts(urls, robots).collect()}
    assert verdict == {"a": False, "b": True, "c": False, "d": True}
    longest = {r.host: r.allowed for r in policy.verdicts(urls, robots, longest=True).collect()}
    assert longest["c"] is True
    maps = [r.sitemap for r in policy.sitemaps(robots).orderBy("n").collect()]
    assert maps == ["s1", "s2"]


@pytest.mark.parametrize(
    ("rule", "path", "fits"),
    [
        ("/*.pdf$", "/x/a.pdf", True), ("/*.pdf$", "/x/a.pdfs", False), ("/*.pdf", "/x/a.pdf?q", True),
        ("/a*b*c", "/aXbYYcZ", True), ("/a*b*c", "/aXcYYb", False), ("/a$", "/a", True), ("/a$", "/ab", False),
        ("/a.c", "/abc", False), ("/a$b", "/a$bc", True), ("/%2A", "/*x", True), ("/%2A", "/x", False),
        ("/*\\E.+", "/z\\E.+", True), ("/*\\E.+", "/z\\Exx", False), ("*", "/", True), ("/x%20*y$", "/x zzy", True),
    ],
)
def test_robots_wildcards(spark, rule, path, fits):
    robots = spark.createDataFrame([("h", 200, f"User-agent: *\nDisallow: {rule}\nAllow: /zzzzzzzzzzzz\n")], "host string, status int, body string")
    urls = spark.createDataFrame([(f"https://h{path}",)], "url string")
    assert policy.verdicts(urls, robots, longest=True).first().allowed is not fits


def test_longest_wildcard_rule_decides(spark):
    body = "User-agent: *\nDisallow: /*.php$\nAllow: /shop/*.php$\nDisallow: /a\nAllow: /a\n"
    robots = spark.createDataFrame([("h", 200, body)], "host string, status int, body string")
    urls = spark.createDataFrame([(f"https://h{p}",) for p in ("/x.php", "/shop/x.php", "/shop/x.php5", "/a")], "url string")
    found = {r.url[9:]: r.allowed for r in policy.verdicts(urls, robots, longest=True).collect()}
    assert found == {"/x.php": False, "/shop/x.php": True, "/shop/x.php5": True, "/a": True}


def test_schedule_of_a_hot_host(spark):
    host = F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("h"), (F.col("id") % 7).cast("string")))
    links = spark.range(2500).select("id", F.concat(F.lit("https://"), host, F.lit("/p")).alias("url"))
    delays = spark.createDataFrame([("h1", 5.0)], "host string, delay double")
    planned = policy.crawl_schedule(links, [F.col("id")], delays).orderBy("id").collect()
    seen = {}
    for n, row in enumerate(planned):
        rank = seen[row.host] = seen.get(row.host, 0) + 1
        assert (row.seq, row.host_rank, row.run_no) == (n + 1, rank, n // 1000)
        assert row.offset_s == (rank - 1) * (5.0 if row.host == "h1" else 2.0)
