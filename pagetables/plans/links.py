"""Links: resolve, collect, rank, schedule, and robots rules."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagetables.functions import links as L
from pagetables.functions import markup as M
from pagetables.functions import state as S
from pagetables.operators import frontier as R
from pagetables.operators import policy
from pagetables.plans.markup import ANCHORS
from pagetables.plans.registry import plan
from pagetables.sources.tables import table

SITE = "https://site.example.com"


@plan(rf"""
select page_id, 'anchor' as kind, regexp_extract(url, '^[a-z]+://[^/]+') || href as target from ({ANCHORS})
union all
select page_id, 'tail',
  case when contains(url, '?') then url
       when contains(url, '#') then url
       else regexp_replace(url, '#.*', '') || '#end' end
from pages
union all
select page_id, 'up', regexp_extract(url, '^[a-z]+://[^/]+') || case
    when regexp_matches(url, '^[a-z]+://[^/]+/[a-z]+/[0-9]+/$') then '/' || regexp_extract(url, '/([a-z]+)/[0-9]+/$', 1)
    else '' end || '/x.html?y=../z'
from pages
""")
def resolve_links(spark: SparkSession, folder: str) -> DataFrame:
    """Anchors, query or fragment links, and a climb out of the page's folder,
    each read against its own page."""
    pages = table(spark, folder, "pages")
    url = F.col("url")
    tail = F.coalesce(F.nullif(F.regexp_extract(url, r"[?#].*$", 0), F.lit("")), F.lit("#end"))
    links = F.concat(
        F.transform(
            M.anchor_hrefs(M.prepare(F.col("html"))),
            lambda h: F.struct(F.lit("anchor").alias("kind"), h.alias("link")),
        ),
        F.array(
            F.struct(F.lit("tail").alias("kind"), tail.alias("link")),
            F.struct(F.lit("up").alias("kind"), F.lit("./../x.html?y=../z").alias("link")),
        ),
    )
    listed = pages.select("page_id", "url", F.inline(links))
    return listed.select("page_id", "kind", L.resolve_href(F.col("url"), F.col("link")).alias("target"))


def sightings(spark: SparkSession, folder: str) -> list[DataFrame]:
    """Page URLs that name a page are the seeds. Round n sees the anchors of page
    n, then the API answer n.

    The answers are made from the documents; their slugs repeat across answers.
    """
    base = F.lit(SITE)
    slug = F.concat(F.lit("//"), "lang", F.lit("/"), "n_chars", F.lit(".html"))
    item = F.struct(slug.alias("slug"), F.col("source").alias("name"))
    answers = table(spark, folder, "documents").select(
        "doc_id", F.to_json(F.struct(F.array(item).alias("items"))).alias("body")
    )
    seeds = table(spark, folder, "pages").filter(L.is_page_link(F.col("url")))
    return [
        R.seed_sightings(seeds, "url", "page_id"),
        R.page_sightings(table(spark, folder, "pages"), "page_id", "html", base),
        R.api_sightings(answers, "doc_id", S.recursive_slugs(F.col("body")), base),
    ]


FRONTIER_SQL = f"""
select url, round, source, pos from (
  select *, row_number() over (partition by url order by round, source, pos) as n from (
    select '{SITE}' || href as url, page_id as round, 1 as source, pos::bigint as pos from ({ANCHORS})
    union all
    select '{SITE}/' || lang || '/' || n_chars || '.html', doc_id, 2, 0 from documents
    union all
    select url, -1, 0, page_id from pages where url like '%.html'))
where n = 1
"""


@plan(FRONTIER_SQL)
def link_frontier(spark: SparkSession, folder: str) -> DataFrame:
    return R.first_sightings(*sightings(spark, folder))


@plan(f"select * from ({FRONTIER_SQL}) order by round, source, pos, url limit 30")
def first_n_links(spark: SparkSession, folder: str) -> DataFrame:
    return R.first_links(R.first_sightings(*sightings(spark, folder)), 30)


@plan(rf"""
select row_number() over (order by round, source, pos, url) as id, url,
       regexp_extract(url, '^https?://[^/]+/([a-z]+)/', 1) as danh_muc
from ({FRONTIER_SQL})
""")
def url_table(spark: SparkSession, folder: str) -> DataFrame:
    frontier = R.first_sightings(*sightings(spark, folder))
    return R.url_table(frontier, F.regexp_extract("url", "^https?://[^/]+/([a-z]+)/", 1))


@plan("""
with seen as (
  select user_id, date_diff('day', date '2024-01-01', ts::date) * 24 + hour(ts) as round,
         event_type = 'click' as more from events),
firsts as (select user_id, min(round) as round from seen group by user_id),
rounds as (select round, bool_or(more) as more from seen group by round),
counted as (
  select r.round, more, count(f.user_id) as new_links, row_number() over (order by r.round) as step
  from rounds r left join firsts f on f.round = r.round group by r.round, more),
totals as (select *, cast(sum(new_links) over (order by round) as bigint) as total_links from counted),
ruled as (
  select round, new_links, total_links, cast(step as integer) as step,
    case when total_links >= 100 then 'enough' when not more then 'no more'
         when new_links = 0 then 'stalled' when step >= 20 then 'round limit' end as stop_rule
  from totals)
select *, not exists (select 1 from ruled e where e.round < r.round and e.stop_rule is not null) as going
from ruled r
""")
def harvest_growth(spark: SparkSession, folder: str) -> DataFrame:
    """Events as a harvest: an hour is a round, a user an item, a click says that
    more remain."""
    day = F.datediff(F.to_date("ts"), F.lit("2024-01-01").cast("date")).cast("bigint")
    seen = table(spark, folder, "events").select(
        F.col("user_id").cast("string").alias("url"),
        (day * 24 + F.hour("ts")).alias("round"),
        F.lit(R.FROM_PAGE).alias("source"),
        F.col("event_id").alias("pos"),
        (F.col("event_type") == "click").alias("more"),
    )
    return R.growth(R.first_sightings(seen), seen, max_links=100, max_rounds=20)


def robots(spark: SparkSession, folder: str) -> DataFrame:
    """A robots file per host, from what its pages show."""
    page_host = L.host(F.col("url")).alias("host")
    lang = F.regexp_extract("url", "://[^/]+/([a-z]+)/", 1)
    hosts = table(spark, folder, "pages").groupBy(page_host).agg(
        F.count("*").alias("n"),
        F.min("page_id").alias("first_page"),
        F.min_by(lang, "page_id").alias("first_lang"),
    )
    status = (
        F.when(F.col("host").startswith("m."), 403)
        .when(F.col("host").startswith("blog.") & (F.col("n") >= 4), 404)
        .otherwise(200)
    )
    lines = [
        F.lit("User-agent: otherbot\nDisallow: /\n\nUser-Agent: *   # everyone\n# rules\nCrawl-delay: "),
        F.col("n").cast("string"),
        F.lit("\nDisallow:  /fr/\nallow: /en/1\nDisallow: /en\nDisallow: /%65s/9\nDisallow: /"),
        F.col("first_lang"),
        F.lit("/2\n\nDisallow: /\nSitemap: https://"),
        F.col("host"),
        F.lit("/sitemap-"),
        F.col("first_page").cast("string"),
        F.lit(".xml\nUser-agent: *\nDisallow: /never\n"),
    ]
    body = F.when(F.col("host").startswith("m."), F.lit("")).otherwise(F.concat(*lines))
    return hosts.select("host", status.alias("status"), body.alias("body"))


HOSTS_SQL = """
select host, count(*) as n, min(page_id) as first_page, arg_min(lang, page_id) as first_lang
from (select page_id, regexp_extract(url, '://([^/]+)', 1) as host,
             regexp_extract(url, '://[^/]+/([a-z]+)/', 1) as lang from pages)
group by host
"""


def _verdict_sql() -> str:
    after_host = r"regexp_replace(url, '^[a-z]+://[^/]+', '')"
    first = f"""
      when {after_host} like '/fr/%' then false
      when {after_host} like '/en/1%' then true
      when {after_host} like '/en%' then false
      when {after_host} like '/es/9%' then false
      when {after_host} like '/' || first_lang || '/2%' then false
      else true"""
    return rf"""
    select page_id, url, h.host,
      case when h.host like 'm.%' then false
           when h.host like 'blog.%' and n >= 4 then true {first} end as allowed,
      case when h.host not like 'm.%' then cast(n as double) end as delay
    from pages join ({HOSTS_SQL}) h on h.host = regexp_extract(url, '://([^/]+)', 1)
    """


@plan(_verdict_sql())
def robots_verdict(spark: SparkSession, folder: str) -> DataFrame:
    urls = table(spark, folder, "pages").select("page_id", "url")
    return policy.verdicts(urls, robots(spark, folder))


# Rules with wildcards, and the same as patterns for the other engine.
WILD_RULES = [
    ("Disallow", "/*?page=", r"^/.*\?page="), ("Disallow", "/fr/", "^/fr/"), ("Allow", "/fr/*5", "^/fr/.*5"),
    ("Disallow", "/en/*1$", "^/en/.*1$"), ("Allow", "/en/1", "^/en/1"), ("Disallow", "/es/9", "^/es/9"),
    ("Allow", "/es/$", "^/es/$"), ("Allow", "/e%2A", r"^/e\*"), ("Disallow", "/*/2*4$", "^/.*/2.*4$"),
]
_WILD_SQL = ", ".join(f"('{p}', {len(r) - 2 * r.count('%2A')}, {k == 'Allow'})" for k, r, p in WILD_RULES)


@plan(rf"""
select page_id, url, coalesce(arg_max(allow, size * 2 + allow::int), true) as allowed
from pages left join (values {_WILD_SQL}) rules(pattern, size, allow)
  on regexp_matches(regexp_replace(url, '^[a-z]+://[^/]+', ''), pattern)
group by page_id, url
""")
def robots_rfc9309(spark: SparkSession, folder: str) -> DataFrame:
    """The longest rule that fits decides; rules hold wildcards and ends."""
    lines = "\n".join(f"{kind}: {rule}" for kind, rule, _ in WILD_RULES)
    urls = table(spark, folder, "pages").select("page_id", "url")
    files = urls.select(L.host(F.col("url")).alias("host")).distinct().select(
        "host", F.lit(200).alias("status"), F.lit(f"User-agent: *\n{lines}\n").alias("body")
    )
    return policy.verdicts(urls, files, longest=True).select("page_id", "url", "allowed")


@plan(f"""
select host, case when host not like 'm.%' then cast(n as double) end as delay from ({HOSTS_SQL})
""")
def robots_delay(spark: SparkSession, folder: str) -> DataFrame:
    return policy.policies(robots(spark, folder), "*").select("host", "delay")


@plan(f"""
select host, 'https://' || host || '/sitemap-' || first_page || '.xml' as sitemap
from ({HOSTS_SQL}) where host not like 'm.%'
""")
def robots_sitemaps(spark: SparkSession, folder: str) -> DataFrame:
    return policy.sitemaps(robots(spark, folder)).select("host", "sitemap")


@plan(f"""
select page_id, p.host, page_id_rank as seq, host_rank,
  (page_id_rank - 1) // 1000 as run_no,
  (host_rank - 1) * case when p.host like 'm.%' then 2.0::double else cast(n as double) end as offset_s
from (select page_id, regexp_extract(url, '://([^/]+)', 1) as host,
             row_number() over (order by page_id) as page_id_rank,
             row_number() over (partition by regexp_extract(url, '://([^/]+)', 1) order by page_id) as host_rank
      from pages) p
join ({HOSTS_SQL}) h on h.host = p.host
""")
def crawl_schedule(spark: SparkSession, folder: str) -> DataFrame:
    links = table(spark, folder, "pages").select("page_id", "url")
    delays = policy.policies(robots(spark, folder), "*")
    planned = policy.crawl_schedule(links, [F.col("page_id")], delays)
    return planned.select("page_id", "host", "seq", "host_rank", "run_no", "offset_s")
