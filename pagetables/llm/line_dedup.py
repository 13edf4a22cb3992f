"""Line dedup by how often a line stands on the pages of its host.

A line on more than a given share of a host's pages is boilerplate there and goes
from all of them. Counting is one aggregation on (host, line), combined before the
shuffle, so a host with a third of all pages is spread over its lines. Only the
lines that go, few per host by their very definition, meet the pages again.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagetables.llm.common import let
from pagetables.session import materialize


@dataclass(frozen=True)
class Boilerplate:
    """Lines on more than ``percent`` of a host's pages, and on ``min_pages`` of them;
    pages of one host with one and the same text count as one page.

    ``broadcast_lines`` is up to how many lines (16 bytes each) the list of those
    that go is sent to every executor; a longer one is joined by a salted shuffle.
    """

    percent: int = 10
    min_pages: int = 5
    broadcast_lines: int = 500_000
    salts: int = 32


def line_hashes(text: Column) -> Column:
    """A hash per line of a text, null for lines of white space; ends of lines are trimmed."""

    def of_line(line: Column) -> Column:
        return let(
            F.regexp_replace(line, r"^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$", ""),
            lambda x: F.when(x != "", F.xxhash64(x)),
        )

    return F.transform(F.split(text, "\n"), of_line)


def boilerplate(pages: DataFrame, text: str, host: str, rule: Boilerplate = Boilerplate()) -> DataFrame:
    """The lines that go: ``host``, ``lines`` (array of their hashes), one row per host."""
    whole = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    hosts = F.coalesce(F.col(f"`{host}`"), F.lit("")).alias("host")
    # A page that was copied does not make its text boilerplate.
    own = pages.select(hosts, F.xxhash64(whole).alias("page"), F.array_distinct(line_hashes(whole)).alias("lines"))
    own = materialize(own.dropDuplicates(["host", "page"]), "distinct-pages")
    totals = own.groupBy("host").agg(F.count("*").alias("pages"))
    lines = own.select("host", F.explode("lines").alias("line")).filter("line is not null")
    counts = lines.groupBy("host", "line").agg(F.count("*").alias("n"))
    often = counts.filter(F.col("n") >= rule.min_pages)
    gone = often.join(totals, "host").filter(F.col("n") * 100 > F.col("pages") * rule.percent)
    return gone.groupBy("host").agg(F.collect_list("line").alias("lines"))


def dedup(
    pages: DataFrame, text: str = "text", host: str = "host", rule: Boilerplate = Boilerplate()
) -> DataFrame:
    """``pages`` with one column more, ``line_dedup``, a struct of

    ``clean_text`` (without the lines that go), ``n_lines`` (those with more than
    white space) and ``n_dropped``.

    A null text counts as empty; pages without a host are one host together. A line
    counts once per page however often it stands there; rows that come twice count as
    one page and are cleaned alike. Blank lines are neither counted nor dropped. A column called
    ``line_dedup`` is replaced; other columns stay, whatever their names.
    """
    gone = materialize(boilerplate(pages, text, host, rule), "boilerplate")
    size = gone.agg(F.coalesce(F.sum(F.size("lines")), F.lit(0))).first()[0]
    held = pages.drop("line_dedup").select(F.struct("*").alias("page"))
    hosts = F.coalesce(F.col(f"page.`{host}`"), F.lit(""))
    if size <= rule.broadcast_lines:
        joined = held.withColumn("host", hosts).join(F.broadcast(gone), "host", "left")
    else:
        salt = F.pmod(F.xxhash64(F.col(f"page.`{text}`")), F.lit(rule.salts)).cast("int")
        salted = gone.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(rule.salts - 1))))
        joined = held.select("page", hosts.alias("host"), salt.alias("salt")).join(
            salted, ["host", "salt"], "left"
        )

    whole = F.coalesce(F.col(f"page.`{text}`"), F.lit(""))

    def cut(hashes: Column) -> Column:
        here = F.array_intersect(hashes, F.coalesce("lines", F.array().cast("array<bigint>")))

        def kept(goes: Column) -> Column:
            left = F.filter(
                F.split(whole_text, "\n"),
                lambda line, i: ~F.coalesce(F.array_contains(goes, F.get(hashes, i)), F.lit(False)),
            )
            return F.when(F.size(goes) == 0, whole_text).otherwise(F.array_join(left, "\n"))

        whole_text = F.col("whole")
        return let(
            here,
            lambda goes: F.struct(
                kept(goes).alias("clean_text"),
                F.size(F.filter(hashes, lambda h: h.isNotNull())).cast("long").alias("n_lines"),
                F.size(F.filter(hashes, lambda h: F.array_contains(goes, h))).cast("long").alias("n_dropped"),
            ),
        )

    # Behind a generator the cut is made once, however many of its fields are used.
    made = F.explode(F.array(let(line_hashes(F.col("whole")), cut))).alias("line_dedup")
    return joined.withColumn("whole", whole).select("page", made).select("page.*", "line_dedup")


def clean(
    pages: DataFrame, text: str = "text", host: str = "host", rule: Boilerplate = Boilerplate()
) -> DataFrame:
    """The pages with the lines that stay, in their own columns; no page goes."""
    judged = dedup(pages.withColumnRenamed("line_dedup", "__line_dedup_of_row"), text, host, rule)
    names = {text: "line_dedup.clean_text", "line_dedup": "`__line_dedup_of_row`"}
    return judged.select(*(F.col(names.get(c, f"`{c}`")).alias(c) for c in pages.columns))
