"""URL filters: rules found by their rarest literal token.

A rule is a regular expression over host and path, with the literal tokens that any
URL it fits must have. Each rule is indexed under the one of its tokens that fewest
URLs have. The tokens of a URL fetch the rules that are indexed under them, and only
those are run. A rule without a literal is indexed under the empty token, which
every URL has.

All steps are joins and aggregations over distinct URLs; Spark broadcasts the rules
where their size allows it.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagetables.llm.common import literal_rows

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Rule:
    """``pattern`` is searched in host + path; ``tokens`` are its literals. A rule of a
    higher ``rank`` goes before others, then a longer ``name``."""

    name: str
    verdict: str
    pattern: str
    tokens: tuple[str, ...]
    rank: int


def place_rule(verdict: str, host: str, path: str) -> Rule:
    """For a host, its subdomains, and paths that begin with ``path``."""
    literal = host + path
    pattern = r"^(?:[^/]*\.)?" + java_quoted(literal)
    tokens = re.findall(r"[a-z0-9]+(?![a-z0-9]|$)", literal.lower())
    return Rule(literal, verdict, pattern, tuple(tokens), 1)


def word_rule(verdict: str, word: str) -> Rule:
    """For URLs with a word between punctuation, anywhere."""
    return Rule(word, verdict, rf"(?i)(?:^|[^a-z0-9]){word}(?:[^a-z0-9]|$)", (word,), 0)


def java_quoted(literal: str) -> str:
    return re.sub(r"([^A-Za-z0-9/])", r"\\\1", literal)


PLACES = (
    place_rule("allow", "org", "/"),
    place_rule("block", "example.org", "/es/"),
    place_rule("block", "example.org", "/en/1"),
    place_rule("allow", "com", "/fr/"),
    place_rule("block", "com", "/de/"),
)
WORDS = ("casino", "escort", "gambling", "hentai", "malware", "phishing", "poker", "porn", "spam", "torrent", "viagra",
         "warez", "xxx")
RULES = PLACES + tuple(word_rule("block", w) for w in WORDS)


def lower_ascii(text: Column) -> Column:
    return F.translate(text, _UPPER, _LOWER)


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (after the first ``://``, lower case) and path of a URL; both empty without one."""
    at = F.instr(url, "://")
    rest = F.coalesce(F.when(at > 0, F.substring(url, at + 3, F.length(url))), F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    return lower_ascii(host), F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def tokens_of(host: Column, path: Column) -> Column:
    """The distinct tokens of a URL, and the empty one."""
    found = F.split(lower_ascii(F.concat(host, path)), "[^a-z0-9]+")
    return F.array_distinct(F.array_append(found, F.lit("")))


def index_rules(tokens: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """One row per rule under its rarest token; ``tokens`` has a row per URL and token."""
    spark = tokens.sparkSession
    names = ["rule", "action", "pattern", "rank", "token"]
    literals = literal_rows(
        spark, names, [(r.name, r.verdict, r.pattern, r.rank, t) for r in rules for t in (r.tokens or ("",))]
    )
    urls = tokens.join(literals.select("token").distinct(), "token").groupBy("token").agg(F.count("*").alias("urls"))
    counted = literals.join(urls, "token", "left").withColumn("urls", F.coalesce("urls", F.lit(0)))
    rarest = F.min(F.struct("urls", "token"))["token"].alias("token")
    return counted.groupBy("rule", "action", "pattern", "rank").agg(rarest)


def judge(
    pages: DataFrame, url: str = "url", rules: tuple[Rule, ...] = RULES, default: str = "allow"
) -> DataFrame:
    """``pages`` with one column more, ``verdict``, a struct of

    ``host``, ``path``, ``rule`` (the place rule that fits and is longest, else null),
    ``verdict`` (that rule's; else that of the word found, else ``default``) and
    ``pattern`` (the word that decided, else null).

    A null URL, or one without ``://``, has neither host nor path, and no rule fits.
    Equal URLs get equal verdicts, a row each; rules of one length that fit are taken
    by name, the last first. A column called ``verdict`` is replaced.
    """
    host, path = host_and_path(F.col(f"`{url}`"))
    held = pages.drop("verdict").select(F.struct("*").alias("page"), host.alias("host"), path.alias("path"))
    urls = held.select("host", "path").distinct()
    tokens = urls.select("host", "path", F.explode(tokens_of(F.col("host"), F.col("path"))).alias("token"))
    candidates = tokens.join(index_rules(tokens, rules), "token")
    fits = candidates.filter(F.regexp(F.concat("host", "path"), F.col("pattern")))
    best = F.max(F.struct("rank", F.length("rule").alias("length"), "rule", "action"))
    found = fits.groupBy("host", "path").agg(best.alias("best"))
    by_place = F.col("best.rank") == 1
    verdict = F.struct(
        "host",
        "path",
        F.when(by_place, F.col("best.rule")).alias("rule"),
        F.coalesce("best.action", F.lit(default)).alias("verdict"),
        F.when(~by_place, F.col("best.rule")).alias("pattern"),
    )
    judged = held.join(found, ["host", "path"], "left").select("page", verdict.alias("verdict"))
    return judged.select("page.*", "verdict")
