"""String and number cleaning as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters a Unicode-aware split on whitespace removes, as a
# pattern (those with the White_Space property, and the four ASCII separators)
# and one by one.
SPACE = r"[\s\x1c-\x1f]"
SPACES = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x20\x85\xa0"
    "\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007"
    "\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)

# ASCII letters, the only ones the name search folds.
ASCII_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
ASCII_LOWER = "abcdefghijklmnopqrstuvwxyz"

# Separators and lengths used in the output records.
PATH_SEPARATOR = " > "
LIST_SEPARATOR = " | "
ERROR_LENGTH = 200
PREVIEW_LENGTH = 50


def squash(c: Column) -> Column:
    """Collapse every run of whitespace to one blank and trim the ends."""
    # A single plain blank between words is left alone.
    runs = rf"(?U)(?! [^\s\x1c-\x1f]){SPACE}++"
    return F.trim(F.regexp_replace(c, runs, " "))


def strip_ends(c: Column) -> Column:
    """Remove Unicode whitespace from both ends; only the ends are looked at."""
    return F.btrim(c, F.lit(SPACES))


def parse_price(c: Column) -> Column:
    """Digits before the first ``/`` as a whole number; none gives null.

    Signs and decimal marks are dropped with every other non-digit. Numbers
    beyond 64 bits give null.
    """
    amount = F.split_part(c, F.lit("/"), F.lit(1))
    return F.regexp_replace(amount, "[^0-9]", "").try_cast("bigint")


def price_label(amount: Column) -> Column:
    """Whole amount as shown on a page, e.g. ``380.000đ``."""
    return F.concat(F.translate(F.format_number(amount, 0), ",", "."), F.lit("đ"))


def truncate(c: Column, length: int = ERROR_LENGTH) -> Column:
    return F.left(c, F.lit(length))


def preview(c: Column, length: int = PREVIEW_LENGTH, null_as_empty: bool = True) -> Column:
    """First ``length`` characters, with ``...`` only when something was cut."""
    text = F.coalesce(c, F.lit("")) if null_as_empty else c
    cut = F.concat(F.left(text, F.lit(length)), F.lit("..."))
    return F.when(F.char_length(text) > length, cut).otherwise(text)


def fallback(first: Column, second: Column) -> Column:
    """``second`` where ``first`` is missing or empty; each is evaluated once."""
    given = F.get(F.filter(F.array(first), lambda text: text != ""), F.lit(0))
    return F.coalesce(given, second)


def join_list(items: Column, separator: str = LIST_SEPARATOR) -> Column:
    """Non-null items joined; a missing or empty list gives an empty string."""
    return F.coalesce(F.array_join(items, separator), F.lit(""))


def strength_label(name: Column, strength: Column) -> Column:
    """``name (strength)``, or the bare name when no strength is known."""
    return F.concat(name, F.coalesce(F.concat(F.lit(" ("), strength, F.lit(")")), F.lit("")))


def ascii_fold(c: Column) -> Column:
    return F.translate(c, ASCII_UPPER, ASCII_LOWER)


def contains_like(c: Column, needle: Column | str) -> Column:
    """ASCII case-insensitive LIKE ``%needle%``.

    Wildcards in the needle stay wildcards and there is no escape character, so
    the escape is set to one that cannot be typed.
    """
    if isinstance(needle, str):
        needle = F.lit(needle)
    pattern = F.concat(F.lit("%"), ascii_fold(needle), F.lit("%"))
    return F.like(ascii_fold(c), pattern, F.lit("\u0001"))


def to_int(c: Column) -> Column:
    """Whole number from free text; anything else is null."""
    return strip_ends(c).try_cast("int")


def fixed_width(*cells: tuple[Column, int]) -> Column:
    """Left-aligned cells padded to a width and never cut; null is blank."""
    padded = []
    for cell, width in cells:
        text = F.coalesce(cell.cast("string"), F.lit(""))
        gap = F.greatest(F.lit(width) - F.char_length(text), F.lit(0))
        padded.append(F.concat(text, F.repeat(F.lit(" "), gap)))
    return F.concat(*padded)
