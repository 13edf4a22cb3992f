"""Quality rules: clean line by line, then reject texts that lost too much.

Every line is judged on its own: does it look like navigation, boilerplate,
symbols, shouting or a stutter, is it a fragment without punctuation. Lines that
fail are removed, and a document of which too few words are left is rejected. A
document is also rejected by two rules on its whole text: too few words, or too
many words inside five-word windows that come twice.

One projection over the table: no shuffle, no Python. A text is held by the row
that has it, at any length.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagetables.llm.common import let, words

SYMBOLS = "#*$%&|<>"
WINDOW = 5


@dataclass(frozen=True)
class Rules:
    """The thresholds; shares are of a line's words, or of its characters for symbols."""

    min_words: int = 10
    max_repeat_percent: int = 20
    symbol_percent: int = 10
    separators: str = r"[|»›·•]"
    separator_percent: int = 25
    shouts: str = r"[!?]{2}"
    shout_percent: int = 50
    fragment_words: int = 3
    distinct_percent: int = 34
    boilerplate: str = (
        r"(?i)\b(?:cookie policy|accept cookies|enable javascript|all rights reserved|privacy policy"
        r"|terms of (?:use|service)|lorem ipsum|click here|sign in|log in to|subscribe to our)\b"
    )
    min_left_percent: int = 50


def count_of(text: Column, characters: str) -> Column:
    """How many characters of ``text`` are among ``characters``."""
    return F.length(text) - F.length(F.translate(text, characters, ""))


def repeated_words(tokens: Column, window: int = WINDOW) -> Column:
    """How many words lie in windows of ``window`` words that the text has twice or more.

    Windows are compared by a 64-bit hash. Only a text with a repeat sorts them;
    then the covered words are summed along the sorted starts of repeats.
    """

    def starts(hashes: Column) -> Column:
        ordered = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def twice(s: Column) -> Column:
            last = F.size(s) - 1
            same = F.filter(
                F.transform(
                    s,
                    lambda x, j: F.when(
                        ((j > 0) & (F.get(s, j - 1)["h"] == x["h"]))
                        | ((j < last) & (F.get(s, j + 1)["h"] == x["h"])),
                        x["i"],
                    ),
                ),
                lambda x: x.isNotNull(),
            )
            return F.sort_array(same)

        return let(ordered, twice)

    def covered(places: Column) -> Column:
        steps = F.transform(
            places,
            lambda p, j: F.least(F.lit(window), F.coalesce(F.get(places, j + 1) - p, F.lit(window))),
        )
        return F.aggregate(steps, F.lit(0).cast("long"), lambda a, x: a + x)

    def windows(h: Column) -> Column:
        places = F.sequence(F.lit(0), F.size(h) - window)
        return F.transform(places, lambda i: F.xxhash64(*[F.get(h, i + k) for k in range(window)]))

    def count(hashes: Column) -> Column:
        return F.when(
            F.size(F.array_distinct(hashes)) < F.size(hashes), let(starts(hashes), covered)
        ).otherwise(F.lit(0).cast("long"))

    word_hashes = F.transform(tokens, lambda w: F.xxhash64(w))
    return let(
        word_hashes,
        lambda h: F.when(F.size(h) >= window, let(windows(h), count)).otherwise(F.lit(0).cast("long")),
    )


def line_fails(line: Column, tokens: Column, rules: Rules, holds: Column) -> Column:
    """Whether a line with these words goes.

    ``holds`` tells what the whole text has at all (symbols, separators, doubled
    marks, boilerplate), so that most texts are spared the tests of their lines.
    """
    n, length = F.size(tokens), F.length(line)

    def separated() -> Column:
        found = length - F.length(F.regexp_replace(line, rules.separators, ""))
        return (found >= 3) & (found * 100 > n * rules.separator_percent)

    shouted = (F.size(F.split(line, rules.shouts)) - 1) * 100 > n * rules.shout_percent
    ended = line.rlike("[.!?…:;。！？][\"'”’»)\\]]*[\\x20\\x09-\\x0D]*$")
    return (
        (holds["symbols"] & (count_of(line, SYMBOLS) * 100 > length * rules.symbol_percent))
        | (holds["separators"] & separated())
        | (holds["shouts"] & (n >= 4) & shouted)
        | ((n <= rules.fragment_words) & ~ended)
        | ((n >= 10) & (F.size(F.array_distinct(tokens)) * 100 < n * rules.distinct_percent))
        | (holds["boilerplate"] & line.rlike(rules.boilerplate))
    )


def judge(docs: DataFrame, text: str = "text", rules: Rules = Rules()) -> DataFrame:
    """``docs`` with one column more, ``quality``, a struct of

    ``n_words``, ``word_chars``, ``n_symbols``, ``n_dup_lines``, ``n_repeat_words``
    (measures of the whole text), ``base_failed``, ``clean_text`` (the lines that
    passed), ``clean_words``, ``n_dropped_lines`` and ``kept``.

    A null text counts as empty; empty and blank texts fail for want of words.
    Lines without a word are neither judged nor dropped. Rows that come twice are
    judged twice. A column that is called ``quality`` is replaced; other columns,
    whatever their names, stay as they are.
    """
    whole = F.coalesce(F.col(f"`{text}`"), F.lit(""))

    def cut(line: Column) -> Column:
        return F.struct(line.alias("line"), words(line).alias("words"))

    def held(t: Column, n_symbols: Column) -> Column:
        return F.struct(
            (n_symbols > 0).alias("symbols"),
            t.rlike(rules.separators).alias("separators"),
            t.rlike(rules.shouts).alias("shouts"),
            t.rlike(rules.boilerplate).alias("boilerplate"),
        )

    def measures(t: Column, lines: Column, tokens: Column, n_symbols: Column) -> Column:
        def stays(holds: Column) -> Column:
            return F.filter(
                lines, lambda x: (F.size(x["words"]) == 0) | ~line_fails(x["line"], x["words"], rules, holds)
            )

        full = F.filter(lines, lambda x: F.size(x["words"]) > 0)["line"]
        return let(
            let(held(t, n_symbols), stays),
            lambda left: F.struct(
                F.size(tokens).cast("long").alias("n_words"),
                F.length(F.array_join(tokens, "")).cast("long").alias("word_chars"),
                n_symbols.cast("long").alias("n_symbols"),
                let(full, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
                repeated_words(tokens).alias("n_repeat_words"),
                F.array_join(left["line"], "\n").alias("clean_text"),
                F.aggregate(left, F.lit(0).cast("long"), lambda a, x: a + F.size(x["words"])).alias("clean_words"),
                (F.size(lines) - F.size(left)).cast("long").alias("n_dropped_lines"),
            ),
        )

    def verdict(m: Column) -> Column:
        failed = (m["n_words"] < rules.min_words) | (
            m["n_repeat_words"] * 100 > m["n_words"] * rules.max_repeat_percent
        )
        left = m["clean_words"] * 100 >= m["n_words"] * rules.min_left_percent
        return F.struct(
            *(m[name].alias(name) for name in _MEASURES),
            failed.alias("base_failed"),
            (~failed & left).alias("kept"),
        )

    judged = let(
        whole,
        lambda t: let(
            F.transform(F.split(t, "\n"), cut),
            lambda lines: let(
                F.flatten(lines["words"]),
                lambda tokens: let(
                    count_of(t, SYMBOLS),
                    lambda symbols: let(measures(t, lines, tokens, symbols), verdict),
                ),
            ),
        ),
    )
    # A generator is a border for the optimizer, which would else evaluate the whole
    # judgement again for a filter on it and for each of its fields.
    return docs.drop("quality").select("*", F.explode(F.array(judged)).alias("quality"))


_MEASURES = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "clean_text",
    "clean_words", "n_dropped_lines",
)


def clean(docs: DataFrame, text: str = "text", rules: Rules = Rules()) -> DataFrame:
    """The documents that stay, with the lines that stay, in the columns of ``docs``."""
    held = "__text_of_row"
    judged = judge(docs.withColumnRenamed("quality", "__quality_of_row"), text, rules)
    kept = judged.filter(F.col("quality.kept")).withColumn(held, F.col("quality.clean_text"))
    names = {text: held, "quality": "__quality_of_row"}
    return kept.select(*(F.col(f"`{names.get(c, c)}`").alias(c) for c in docs.columns))
