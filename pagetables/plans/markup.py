"""Fields out of page markup."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagetables.functions import elements as E
from pagetables.functions import links as L
from pagetables.functions import markup as M
from pagetables.operators import records
from pagetables.plans.registry import plan
from pagetables.plans.texts import SPACE_RE2
from pagetables.sources.tables import table

# ------------------------------------------------------------ SQL building blocks


def decoded(sql: str) -> str:
    """The references that occur in the page table, ``&amp;`` last."""
    for name, char in (("copy", "©"), ("middot", "·"), ("quot", '"'), ("amp", "&")):
        sql = f"regexp_replace({sql}, '&{name};?', '{char}', 'g')"
    return sql


def squashed(sql: str) -> str:
    return f"trim(regexp_replace({sql}, '{SPACE_RE2}+', ' ', 'g'))"


def stripped(sql: str) -> str:
    return f"regexp_replace({sql}, '^{SPACE_RE2}+|{SPACE_RE2}+$', '', 'g')"


def untagged(sql: str) -> str:
    return f"regexp_replace({sql}, '<[/!?A-Za-z][^>]*(?:>|$)', '', 'g')"


VISIBLE = (
    "regexp_replace(html, '(?s)<!--.*?-->|<script>.*?</script>|<style>.*?</style>', '', 'g')"
)


def inner(start: str, tag: str) -> str:
    """Inside of the first element, null if there is none."""
    found = rf"'(?s){start}(.*?)(?:</{tag}>|$)'"
    return (
        f"case when nullif(regexp_extract({VISIBLE}, {found}, 0), '') is not null "
        f"then regexp_extract({VISIBLE}, {found}, 1) end"
    )


def text_of(start: str, tag: str) -> str:
    return squashed(decoded(untagged(inner(start, tag))))


ANCHORS = """
select page_id, url, unnest(hrefs) as href, generate_subscripts(hrefs, 1) - 1 as pos
from (select page_id, url, regexp_extract_all(html, '<a href="([^"]*)"', 1) as hrefs from pages)
"""


def raw_pages(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "pages")


def pages(spark: SparkSession, folder: str) -> DataFrame:
    """Pages with their markup prepared."""
    return records.prepared(raw_pages(spark, folder))


# ------------------------------------------------------------ scan and first matches

@plan("select page_id, url, length(html) as n_chars from pages")
def page_scan(spark: SparkSession, folder: str) -> DataFrame:
    return raw_pages(spark, folder).select("page_id", "url", F.char_length("html").cast("bigint").alias("n_chars"))


@plan(f"select page_id, {text_of('<title>', 'title')} as title from pages")
def page_title(spark: SparkSession, folder: str) -> DataFrame:
    return pages(spark, folder).select("page_id", M.title(F.col("html")).alias("title"))


@plan(f"""
select page_id, {text_of('<h1>', 'h1')} as heading, {text_of('<div class="ad">', 'div')} as ad,
       {text_of('<nav>', 'nav')} as nav, {text_of('<footer>', 'footer')} as footer,
       null::varchar as price
from pages
""")
def first_text(spark: SparkSession, folder: str) -> DataFrame:
    page = F.col("html")
    return pages(spark, folder).select(
        "page_id",
        M.first_text(page, "h1").alias("heading"),
        M.first_text(page, "div", "class", "ad").alias("ad"),
        M.first_text(page, "nav").alias("nav"),
        M.first_text(page, "footer").alias("footer"),
        M.first_text(page, None, "data-test", "price").alias("price"),
    )


@plan("""
select page_id, regexp_extract(html, '<html lang="([^"]*)"', 1) as lang,
       regexp_extract(html, '<meta charset="([^"]*)"', 1) as charset,
       regexp_extract(html, '<a href="([^"]*)"', 1) as first_link,
       null::varchar as image
from pages
""")
def first_attr(spark: SparkSession, folder: str) -> DataFrame:
    page = F.col("html")
    return pages(spark, folder).select(
        "page_id",
        M.first_attr(page, "lang", "html").alias("lang"),
        M.first_attr(page, "charset", "meta").alias("charset"),
        M.first_attr(page, "href", "a").alias("first_link"),
        M.first_attr(page, "content", "meta", "property", "og:image").alias("image"),
    )


@plan(f"""
select page_id, {text_of('<title>', 'title')} as title, {text_of('<h1>', 'h1')} as heading,
       {text_of('<article>', 'article')} as body, {text_of('<footer>', 'footer')} as footer,
       regexp_extract(html, '<html lang="([^"]*)"', 1) as lang,
       nullif(regexp_extract(html, '<a href="(/t[^"]*)"', 1), '') as t_link
from pages
""")
def rule_fields(spark: SparkSession, folder: str) -> DataFrame:
    """The same kind of fields from the index of the page's elements."""
    page = E.Page("page")
    fields = {"title": "title", "heading": "h1", "body": "article", "footer": "footer"}
    return E.with_index(raw_pages(spark, folder).select("page_id", "html")).select(
        "page_id",
        *[page.text(page.first(tag)).alias(name) for name, tag in fields.items()],
        page.attribute(page.first("html"), "lang").alias("lang"),
        page.attribute(page.first("a", "href", "/t", "^="), "href").alias("t_link"),
    )


# ------------------------------------------------------------ anchors

@plan(f"select page_id, cast(pos as integer) as pos, href from ({ANCHORS})")
def anchors(spark: SparkSession, folder: str) -> DataFrame:
    return pages(spark, folder).select(
        "page_id", F.posexplode(M.anchor_hrefs(F.col("html"))).alias("pos", "href")
    )


@plan(f"select page_id, count(*) as anchors, count(distinct href) as links from ({ANCHORS}) group by page_id")
def distinct_links(spark: SparkSession, folder: str) -> DataFrame:
    """Per page; one page is one row, so nothing is shuffled."""
    hrefs = M.anchor_hrefs(F.col("html"))
    counted = pages(spark, folder).select("page_id", hrefs.alias("hrefs"))
    return counted.filter(F.size("hrefs") > 0).select(
        "page_id",
        F.size("hrefs").cast("bigint").alias("anchors"),
        F.size(F.array_distinct("hrefs")).cast("bigint").alias("links"),
    )


@plan(f"select count(distinct href) as links from ({ANCHORS})")
def distinct_links_total(spark: SparkSession, folder: str) -> DataFrame:
    """Over all pages; each page's own repeats go before the shuffle."""
    hrefs = F.array_distinct(M.anchor_hrefs(F.col("html")))
    links = pages(spark, folder).select(F.explode(hrefs).alias("href"))
    return links.distinct().agg(F.count("*").alias("links"))


@plan("""
select page_id, len(regexp_extract_all(html, '<a href="([^"]*)"', 1)) // 2 as products from pages
""")
def halved_anchor_count(spark: SparkSession, folder: str) -> DataFrame:
    count = F.size(M.anchor_hrefs(F.col("html")))
    return pages(spark, folder).select(
        "page_id", F.floor(count / F.lit(2)).cast("bigint").alias("products")
    )


@plan("select page_id, url from pages where url like '%.html'")
def link_suffix(spark: SparkSession, folder: str) -> DataFrame:
    return raw_pages(spark, folder).select("page_id", "url").filter(L.is_page_link(F.col("url")))


@plan("select page_id, url from pages where contains(url, '.html')")
def link_contains(spark: SparkSession, folder: str) -> DataFrame:
    return raw_pages(spark, folder).select("page_id", "url").filter(L.mentions_page(F.col("url")))


@plan(r"select page_id, regexp_matches(url, '[?&]page=[ \t]*[0-9]+') as more from pages")
def more_marker(spark: SparkSession, folder: str) -> DataFrame:
    """The given pages have no buttons; a page number in the URL marks more."""
    return raw_pages(spark, folder).select(
        "page_id", L.has_more(F.col("url"), r"(?U)[?&]page=\s*\d+").alias("more")
    )


# ------------------------------------------------------------ text

BLOCK_END_RE2 = "(?s)</(?:p|li|ul|ol|div|article|section|nav|main|body|html)>.*"


@plan(f"""
with blocks as (
  select page_id, [
      {squashed(decoded(untagged(f"regexp_replace(b, '{BLOCK_END_RE2}', '')")))}
      for b in string_split_regex({VISIBLE}, '<(?:p|li)(?:[ ][^>]*)?>')[2:]] as found
  from pages),
kept as (select page_id, [b for b in found if b <> ''] as lines from blocks)
select page_id, cast(unnest(range(len(lines))) as integer) as pos, unnest(lines) as line from kept
""")
def html_blocks(spark: SparkSession, folder: str) -> DataFrame:
    return pages(spark, folder).select(
        "page_id", F.posexplode(M.block_lines(F.col("html"))).alias("pos", "line")
    )


@plan(f"""
with blocks as (
  select doc_id, [{squashed(decoded(untagged("b")))} for b in string_split(text, '.')] as lines from documents)
select doc_id, array_to_string([b for b in lines if b <> ''], chr(10)) as text from blocks
""")
def block_text(spark: SparkSession, folder: str) -> DataFrame:
    """Documents marked up as lists, one item per sentence, and read back."""
    listed = F.concat(F.lit("<li>"), F.replace(F.col("text"), F.lit("."), F.lit("<li>")))
    documents = table(spark, folder, "documents")
    return documents.select("doc_id", M.block_text(M.prepare(listed)).alias("text"))


@plan(f"""
with nodes as (
  select page_id, [{stripped(decoded("n"))} for n in string_split_regex(regexp_replace(html,
       '(?s)<!--.*?-->|<script>.*?</script>|<style>.*?</style>', '<x>', 'g'), '<[/!?A-Za-z][^>]*(?:>|$)')] as found
  from pages)
select page_id, array_to_string([n for n in found if n <> ''], chr(10)) as text from nodes
""")
def html_lines(spark: SparkSession, folder: str) -> DataFrame:
    return pages(spark, folder).select("page_id", M.line_text(F.col("html")).alias("text"))


@plan(f"select page_id, {decoded(untagged(inner('<article>', 'article')))} as text from pages")
def html_raw_text(spark: SparkSession, folder: str) -> DataFrame:
    return pages(spark, folder).select(
        "page_id", M.raw_text(M.first_inner(F.col("html"), "article")).alias("text")
    )


# ------------------------------------------------------------ maps and positions

# The given pages have no labelled rows; these navigation targets play the labels.
NAV_LABELS = ["/the", "/of", "/in", "/is", "/was", "/de", "/un", "/be", "/En"]
_LABELS_SQL = ", ".join(f"'{x}'" for x in NAV_LABELS)

PAIRS = f"""
select page_id, generate_subscripts(m, 1) as pos,
  regexp_extract(unnest(m), '<a href="([^"]*)"', 1) as href,
  {squashed(decoded(untagged("unnest(m)")))} as text
from (select page_id, regexp_extract_all(html, '<a href="[^"]*">[^<]*</a>') as m from pages)
"""


@plan(f"""
select page_id, href as label, text as value
from (select *, row_number() over (partition by page_id, href order by pos) as n from ({PAIRS})
      where href in ({_LABELS_SQL}))
where n = 1 and text <> ''
""")
def label_map(spark: SparkSession, folder: str) -> DataFrame:
    cells = F.transform(
        M.anchor_pairs(F.col("html")),
        lambda p: F.struct(p["href"].alias("label"), p["text"].alias("value")),
    )
    values = records.first_entries(cells, NAV_LABELS)
    return pages(spark, folder).select("page_id", F.explode(values).alias("label", "value"))


_SECTIONS = [("title", None), ("h1", None), ("nav", None), ("div", "ad"), ("footer", None), ("aside", None)]


def _section_sql() -> str:
    parts = []
    for tag, css in _SECTIONS:
        start = f'<{tag} class="{css}">' if css else f"<{tag}>"
        text = stripped(decoded(untagged(inner(start, tag))))
        parts.append(f"select page_id, '{css or tag}' as section, {text} as text from pages")
    return f"select * from ({' union all '.join(parts)}) where text is not null"


@plan(_section_sql())
def section_map(spark: SparkSession, folder: str) -> DataFrame:
    page = E.Page("page")
    elements = {
        css or tag: page.first(tag, "class" if css else None, css, "~=") for tag, css in _SECTIONS
    }
    found = E.with_index(raw_pages(spark, folder).select("page_id", "html")).select(
        "page_id", records.section_map(page, elements).alias("m")
    )
    return found.select("page_id", F.explode("m").alias("section", "text"))


@plan(f"""
with pairs as ({PAIRS}),
firsts as (select page_id, min(pos) as spot from pairs where href like '/t%' group by page_id),
near as (select p.page_id, p.pos - v.spot as step, p.text from pairs p join firsts v on p.page_id = v.page_id)
select page_id,
  max(case when step = -1 then text end) as before,
  max(case when step = 0 then text end) as picked,
  case when max(step) >= 2 then max(case when step = 1 then text end) end as next_1,
  case when max(step) >= 2 then max(case when step = 2 then text end) end as next_2
from near group by page_id
""")
def relative_pick(spark: SparkSession, folder: str) -> DataFrame:
    """Navigation items next to the first one under ``/t``; the two that follow
    count only if both exist. Positions are read within the page's own array."""
    items = pages(spark, folder).select("page_id", M.anchor_pairs(F.col("html")).alias("items"))
    at = F.array_position(F.transform("items", lambda i: i["href"].startswith("/t")), True)
    found = items.withColumn("at", at.cast("int")).filter("at > 0")

    def item(step: int):
        return F.get("items", F.col("at") - 1 + step)["text"]

    both = F.size("items") - F.col("at") >= 2
    return found.select(
        "page_id",
        item(-1).alias("before"),
        item(0).alias("picked"),
        F.when(both, item(1)).alias("next_1"),
        F.when(both, item(2)).alias("next_2"),
    )
