"""Robots rules and the crawl schedule."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pagetables.functions.links import host, path_of
from pagetables.functions.text import strip_ends
from pagetables.operators.numbering import dense_index, rank_in_group

# Pause between requests in seconds, and pages per run.
PAUSE_SECONDS = 2.0
PAGES_PER_RUN = 1000


# ---------------------------------------------------------------- robots

def _unquote(path: Column) -> Column:
    """Percent-decoded path; one that cannot be decoded is left as it is."""
    safe = F.replace(path, F.lit("+"), F.lit("%2B"))
    return F.coalesce(F.try_url_decode(safe), path)


def _pattern(value: Column) -> Column:
    """A rule with ``*`` (any characters) or a last ``$`` (the end) as a pattern; null for others.

    Parts between are plain text, percent-decoded on their own, so that ``%2A`` stays a star.
    """
    to_end = value.endswith("$")
    whole = F.when(to_end, F.left(value, F.char_length(value) - 1)).otherwise(value)
    parts = F.transform(
        F.split(whole, r"\*"),
        lambda part: F.concat(F.lit(r"\Q"), F.replace(_unquote(part), F.lit(r"\E"), F.lit(r"\E\\E\Q")), F.lit(r"\E")),
    )
    pattern = F.concat(F.lit(r"(?s)\A"), F.array_join(parts, ".*"), F.when(to_end, r"\z").otherwise(""))
    return F.when(value.contains("*") | to_end, pattern)


def robots_lines(robots: DataFrame) -> DataFrame:
    """Lines of ``robots(host, status, body)`` as ``(host, status, n, kind, value)``.

    Comments are cut off; a line that held nothing else is no blank line. A blank
    line is put before the first, so that a host without any is not lost.
    """
    body = F.coalesce("body", F.lit(""))
    raw = F.concat(F.array(F.lit("")), F.split(body, r"\r\n|\r|\n"))
    cut = F.transform(
        raw,
        lambda line, n: F.struct(
            n.alias("n"),
            (strip_ends(line) == "").alias("blank"),
            strip_ends(F.regexp_replace(line, "#.*", "")).alias("text"),
        ),
    )
    split = F.transform(
        cut,
        lambda c: F.struct(
            c["n"].alias("n"),
            c["blank"].alias("blank"),
            F.lower(strip_ends(F.regexp_extract(c["text"], r"^([^:]*):", 1))).alias("name"),
            strip_ends(F.regexp_extract(c["text"], r"^[^:]*:(.*)$", 1)).alias("value"),
        ),
    )
    kinds = F.transform(
        split,
        lambda s: F.struct(
            s["n"].alias("n"),
            F.when(s["blank"], "blank")
            .when(s["name"] == "user-agent", "agent")
            .when(s["name"].isin("allow", "disallow", "crawl-delay", "sitemap"), s["name"])
            .alias("kind"),
            s["value"].alias("value"),
        ),
    )
    known = F.filter(kinds, lambda k: k["kind"].isNotNull())
    return robots.select("host", "status", F.inline(known))


def policies(robots: DataFrame, agent: str) -> DataFrame:
    """Per host, what its robots file says to ``agent``.

    ``(host, status, rules, delay)``: the rules of the first group naming the
    agent, else of the first group for everyone, in file order. One shuffle by
    host serves the windows and both groupings; a host has one file, which bounds
    what they hold.
    """
    name = agent.split("/")[0].lower()
    by_line = Window.partitionBy("host").orderBy("n")
    lines = robots_lines(robots).filter("kind <> 'sitemap'")
    starts = (F.col("kind") == "blank") | (
        (F.col("kind") == "agent")
        & (F.coalesce(F.lag("kind").over(by_line), F.lit("blank")) != "agent")
    )
    grouped = lines.withColumn("__starts", starts.cast("int")).withColumn(
        "group", F.sum("__starts").over(by_line)
    )

    is_agent = F.col("kind") == "agent"
    is_rule = F.col("kind").isin("allow", "disallow")
    is_delay = F.col("kind") == "crawl-delay"
    named = is_agent & (F.col("value") != "*") & F.lit(name).contains(F.lower("value"))
    rule = F.struct(
        "n",
        ((F.col("kind") == "allow") | (F.col("value") == "")).alias("allow"),
        _unquote(F.col("value")).alias("path"),
        _pattern(F.col("value")).alias("pattern"),
    )
    seconds = F.when(is_delay & F.col("value").rlike(r"\A[0-9]+\z"), F.col("value")).try_cast("double")
    groups = grouped.groupBy("host", "group").agg(
        F.max("status").alias("status"),
        F.bool_or(is_agent & (F.col("value") == "*")).alias("__everyone"),
        F.bool_or(named).alias("__named"),
        F.bool_or(is_rule | is_delay).alias("__used"),
        F.sort_array(F.collect_list(F.when(is_rule, rule))).alias("rules"),
        F.max_by(seconds, F.when(seconds.isNotNull(), F.col("n"))).alias("delay"),
    )
    fits = F.col("__used") & (F.col("__everyone") | F.col("__named"))
    rank = F.struct(F.col("__everyone").cast("int"), "group")
    chosen = F.min_by(F.when(fits, F.struct("rules", "delay")), F.when(fits, rank))
    return (
        groups.groupBy("host")
        .agg(F.max("status").alias("status"), chosen.alias("p"))
        .select("host", "status", F.col("p.rules").alias("rules"), F.col("p.delay").alias("delay"))
    )


def may_fetch(path: Column, status: Column, rules: Column, longest: bool = False) -> Column:
    """Whether a path may be fetched: the first fitting rule decides.

    With ``longest`` the longest one does, ``*`` and a last ``$`` in rules mean any
    characters and the end, and allow wins a tie (RFC 9309). 401 and 403 for the robots file forbid everything, other 4xx nothing; no
    file or no fitting rule means allowed.
    """
    target = _unquote(path)
    fits = lambda r: target.startswith(r["path"])
    if longest:
        # Plain rules need no pattern; most files have no others.
        fits = lambda r: F.when(r["pattern"].isNotNull(), F.rlike(target, r["pattern"])).otherwise(
            target.startswith(r["path"])
        )
    fitting = F.filter(rules, fits)
    if longest:
        ordered = F.transform(
            fitting,
            lambda r: F.struct(F.char_length(r["path"]).alias("size"), r["allow"].alias("allow")),
        )
        fitting = F.reverse(F.sort_array(ordered))
    verdict = F.coalesce(F.get(fitting, F.lit(0))["allow"], F.lit(True))
    return (
        F.when(status.isin(401, 403), F.lit(False))
        .when(status.between(400, 499), F.lit(True))
        .otherwise(verdict)
    )


def verdicts(
    urls: DataFrame, robots: DataFrame, agent: str = "*", longest: bool = False
) -> DataFrame:
    """``urls`` with ``allowed`` and ``delay`` added.

    The join is on the host and brings one row per host: a host with a third of
    the URLs is split by the adaptive skew join, and a small robots table is
    broadcast by Spark's own size check.
    """
    known = urls.withColumn("host", host(F.col("url")))
    joined = known.join(policies(robots, agent), "host", "left")
    allowed = may_fetch(
        path_and_fragment(F.col("url")), F.col("status"), F.col("rules"), longest
    )
    return joined.withColumn("allowed", allowed).drop("status", "rules")


def path_and_fragment(url: Column) -> Column:
    """What rules are compared with: everything after the host."""
    fragment = F.regexp_extract(url, r"#[\s\S]+$", 0)
    return F.concat(path_of(url), fragment)


def sitemaps(robots: DataFrame) -> DataFrame:
    """``(host, n, sitemap)``: sitemap lines count whatever group they are in."""
    return robots_lines(robots).filter("kind = 'sitemap'").select(
        "host", "n", F.col("value").alias("sitemap")
    )


# ---------------------------------------------------------------- schedule

def crawl_schedule(
    links: DataFrame,
    order: list[Column],
    delays: DataFrame | None = None,
    pause: float = PAUSE_SECONDS,
    pages_per_run: int = PAGES_PER_RUN,
) -> DataFrame:
    """When each URL is due: a run number and an offset within its host's queue.

    ``order`` must be unique. A host is served one request at a time, its own
    delay apart where ``delays(host, delay)`` names one. Hosts of any size are
    ranked in bounded blocks, so none ends up in a single task.
    """
    hosted = links.withColumn("host", F.coalesce(host(F.col("url")), F.lit("")))
    numbered = dense_index(hosted, order, "seq")
    known = None if delays is None else delays.select("host", "delay")
    ranked = rank_in_group(numbered, "host", "seq", "host_rank", group_facts=known)
    if known is None:
        ranked = ranked.withColumn("delay", F.lit(None).cast("double"))
    gap = F.coalesce("delay", F.lit(pause))
    run = F.expr(f"(seq - 1) div {pages_per_run}")
    return ranked.withColumn("run_no", run).withColumn(
        "offset_s", (F.col("host_rank") - 1) * gap
    ).drop("delay")
