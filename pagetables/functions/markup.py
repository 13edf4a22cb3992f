"""Markup to fields: Column expressions over an ``html`` string.

Elements are found with regular expressions inside the JVM. One that holds no
other of its name ends at the next end tag; otherwise the tags of that name are
counted to the end tag that balances it. An element that is never closed runs to
the end of the page, as a browser would have it.

``prepare`` is run once per page: it hides scripts, styles and comments and
decodes every character reference but those that stand for markup characters.
The field functions take prepared markup and decode the rest, which is cheap.
"""

from __future__ import annotations

import html.entities
import json
import re
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from pagetables.functions.text import squash, strip_ends

_TAG = r"<[/!?A-Za-z][^>]*(?:>|\z)"
# Possessive loops run from one candidate end to the next without backtracking. What all
# branches begin with stands before them: a search then tests one character per place.
_HIDDEN = (
    r"(?i)<(?:!--[^-]*+(?:-(?!->)[^-]*+)*+(?:-->)?"
    r"|(script|style)\b[^>]*+>[^<]*+(?:<(?!/\1\b)[^<]*+)*+(?:</\1[^>]*+>)?)"
)
_BLOCK_START = r"(?i)<(?:p|li)(?=[\s>/])[^>]*>"
_BLOCK_OWN_END = r"</(?:p|li)\s*+>"
_CONTAINER = "(?:ul|ol|div|article|section|nav|main|body|html)"
# Elements that have no end tag.
_VOID = "(?:area|base|br|col|embed|hr|img|input|link|meta|source|track|wbr)"
_ANY_TAG = r"(?i)</?[a-z][^>]*+>"

# The references that stand for markup characters; ``&amp;`` is
# decoded last, so that what it uncovers is not decoded again.
MARKUP_REFERENCES = {"lt": "<", "gt": ">", "quot": '"', "apos": "'", "amp": "&"}


# ---------------------------------------------------------------- references

def _reference_table() -> str:
    """Character references as JSON, built from the standard library's table.

    Numbers 128-159 mean the Windows-1252 characters, as browsers read them.
    Markup characters stay references, in one spelling.
    """
    spelling = {char: f"&{name};" for name, char in MARKUP_REFERENCES.items()}
    table = {}
    for name, text in html.entities.html5.items():
        if name.endswith(";"):
            table[name] = spelling.get(text, text)
    for char, kept in spelling.items():
        table[f"#{ord(char)}"] = kept
    for code in range(128, 160):
        try:
            table[f"#{code}"] = bytes([code]).decode("cp1252")
        except UnicodeDecodeError:
            table[f"#{code}"] = chr(code)
    return json.dumps(table)


_TABLE_JSON = _reference_table()
# Old names may stand without the semicolon; the longest one that fits counts.
_OLD_NAMES = "|".join(
    sorted((n for n in html.entities.html5 if not n.endswith(";")), key=lambda n: (-len(n), n))
)
_RARE = rf"&(?!(?:{'|'.join(MARKUP_REFERENCES)});)[#A-Za-z]"


def _character(number: Column) -> Column:
    """The character with a code point given as a number.

    Control and non-characters vanish; numbers that are no code point become the
    replacement character.
    """
    vanishing = (
        number.between(1, 8)
        | (number == 11)
        | number.between(14, 31)
        | (number == 127)
        | number.between(0xFDD0, 0xFDEF)
        | ((number <= 0x10FFFF) & (number.bitwiseAND(F.lit(0xFFFE)) == 0xFFFE))
    )
    in_range = number.between(1, 0x10FFFF) & ~number.between(0xD800, 0xDFFF)
    char = F.decode(F.unhex(F.lpad(F.hex(number), 8, "0")), "UTF-32")
    return F.when(vanishing, F.lit("")).when(in_range, char).otherwise(F.lit("\ufffd"))


def _decode_start(piece: Column) -> Column:
    """Decode the reference at the start of ``piece`` (the text after an ``&``)."""
    table = F.from_json(F.lit(_TABLE_JSON), "map<string,string>")
    token = F.regexp_extract(
        piece, rf"^(?:#[0-9]+;?|#[xX][0-9A-Fa-f]+;?|[A-Za-z][A-Za-z0-9]*;|{_OLD_NAMES})", 0
    )
    old = F.regexp_extract(piece, f"^(?:{_OLD_NAMES})", 0)
    digits = F.regexp_extract(token, "^#0*([0-9]+)", 1)
    hex_digits = F.regexp_extract(token, "^#[xX]0*([0-9A-Fa-f]+)", 1)
    beyond = F.lit(0x110000).cast("bigint")
    number = (
        F.when(F.char_length(digits) > 9, beyond)
        .when(F.char_length(hex_digits) > 8, beyond)
        .when(digits != "", digits.try_cast("bigint"))
        .when(hex_digits != "", F.conv(hex_digits, 16, 10).try_cast("bigint"))
    )
    name = F.when(number.isNotNull(), F.concat(F.lit("#"), number.cast("string"))).otherwise(
        F.concat(F.rtrim(token, F.lit(";")), F.lit(";"))
    )
    known = F.try_element_at(table, name)
    by_old_name = F.try_element_at(table, F.concat(old, F.lit(";")))

    def then_rest(text: Column, matched: Column) -> Column:
        return F.concat(text, F.substr(piece, F.char_length(matched) + 1))

    return (
        F.when(known.isNotNull(), then_rest(known, token))
        .when(number.isNotNull(), then_rest(_character(number), token))
        .when(old != "", then_rest(by_old_name, old))
        .otherwise(F.concat(F.lit("&"), piece))
    )


def _decode_rare(c: Column) -> Column:
    """Decode all references but the markup ones; most texts have none."""
    pieces = F.split(c, "&")
    decoded = F.transform(pieces, lambda p, i: F.when(i == 0, p).otherwise(_decode_start(p)))
    return F.when(c.rlike(_RARE), F.array_join(decoded, "")).otherwise(c)


def _decode_markup(c: Column) -> Column:
    for name, char in MARKUP_REFERENCES.items():
        c = F.replace(c, F.lit(f"&{name};"), F.lit(char))
    return c


def unescape(c: Column) -> Column:
    """Decode every character reference."""
    return _decode_markup(_decode_rare(c))


# ---------------------------------------------------------------- text

def hide(html_text: Column) -> Column:
    """Scripts, styles and comments cut down to a bare tag."""
    return F.regexp_replace(html_text, _HIDDEN, "<x>")


def prepare(html_text: Column) -> Column:
    """Markup the field functions read: hidden parts are cut, and references
    decoded except those for markup characters."""
    # The lambda binds the cut markup, which is looked at more than once.
    return F.get(F.transform(F.array(hide(html_text)), _decode_rare), F.lit(0))


def raw_text(prepared: Column) -> Column:
    """Text content: tags removed and nothing put in their place."""
    return _decode_markup(F.regexp_replace(prepared, _TAG, ""))


def squashed_text(prepared: Column) -> Column:
    return squash(raw_text(prepared))


def line_text(prepared: Column) -> Column:
    """Every text node stripped, empty ones dropped, one per line."""
    nodes = F.split(F.coalesce(prepared, F.lit("")), _TAG)
    lines = F.filter(F.transform(nodes, lambda n: strip_ends(_decode_markup(n))), lambda n: n != "")
    return F.array_join(lines, "\n")


def _block_part(piece: Column) -> Column:
    """``piece``, which follows a block's start tag, up to the end of the block."""
    first_end = rf"(?is)(?:{_BLOCK_OWN_END}|</{_CONTAINER}\s*+>).*+\z"
    upto_own = F.regexp_replace(piece, rf"(?is){_BLOCK_OWN_END}.*+\z", "")
    return F.when(
        upto_own.rlike(rf"(?i)<{_CONTAINER}(?=[\s/>])"),
        _bound(upto_own, lambda own: _inside(own, rf"(?i)</?{_CONTAINER}(?=[\s/>])[^>]*+>")),
    ).otherwise(F.regexp_replace(piece, first_end, ""))


def block_lines(prepared: Column) -> Column:
    """Text of each ``<p>``/``<li>`` in page order, squashed, empty ones dropped.

    A block ends at its end tag, at the next block, or with a container that was
    open before it. Text that goes on after an inner block, up to the end tag of
    the outer one, is a line of its own.
    """
    pieces = F.split(prepared, _BLOCK_START)
    blocks = F.slice(pieces, F.lit(2), F.greatest(F.size(pieces) - 1, F.lit(0)))

    def lines_of(piece: Column) -> Column:
        return _bound(
            _block_part(piece),
            lambda block: F.array(
                squashed_text(block),
                squashed_text(
                    F.regexp_extract(
                        F.substr(piece, F.char_length(block) + 1),
                        rf"(?is)\A</[^>]*+>(.*){_BLOCK_OWN_END}", 1,
                    )
                ),
            ),
        )

    lines = F.flatten(F.transform(blocks, lines_of))
    return F.filter(lines, lambda line: line != "")


def block_text(prepared: Column) -> Column:
    """One line per block; markup without blocks is squashed; null is empty."""
    text = F.when(prepared.rlike(_BLOCK_START), F.array_join(block_lines(prepared), "\n"))
    return F.coalesce(text, squashed_text(prepared), F.lit(""))


# ---------------------------------------------------------------- elements

def _open_tag(tag: str | None, attr: str | None, value: str | None, match: str) -> str:
    """Pattern of a start tag; names fold case, the value does not."""
    name = re.escape(tag) if tag else "[A-Za-z][A-Za-z0-9]*+"
    if attr is None:
        return rf"<({name})(?=[\s>/])[^>]*+>"
    wanted = "" if value is None else re.escape(value)

    def inside(any_text: str, around: tuple[str, ...]) -> str:
        return {
            "=": wanted,
            "^=": wanted + any_text,
            "$=": any_text + wanted,
            "*=": any_text + wanted + any_text,
            "~=": wanted.join(around) if around else wanted,
        }[match if value is not None else "*="]

    quoted = inside(r"[^\"'>]*", (r"(?:[^\"'>]*\s)?", r"(?:\s[^\"'>]*)?"))
    bare = inside(r"[^\s\"'>]*", ())
    given = rf"(?-i:[\"']{quoted}[\"']|{bare}(?=[\s>]))"
    return rf"<({name})(?=\s)[^>]*?\s{re.escape(attr)}\s*=\s*{given}[^>]*+>"


def _bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)``, with ``value`` evaluated once however often it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _inside_length(tail: Column, tags: str | Column) -> Column:
    """How many characters of ``tail`` lie before the end tag of the element it
    starts in, counting the tags that fit ``tags``; all of them if it has none.
    """
    pattern = F.lit(tags) if isinstance(tags, str) else tags
    pieces = F.zip_with(
        F.split(tail, pattern),
        F.regexp_extract_all(tail, pattern, F.lit(0)),
        lambda text, tag: F.struct(
            F.char_length(text).alias("text"),
            F.coalesce(F.char_length(tag), F.lit(0)).alias("tag"),
            F.when(tag.startswith("</"), -1)
            .when(tag.rlike(rf"(?i)\A<{_VOID}[\s/>]|/>\z"), 0)
            .when(tag.isNotNull(), 1)
            .otherwise(0)
            .alias("step"),
        ),
    )

    def walk(at: Column, piece: Column) -> Column:
        depth = at["depth"] + piece["step"]
        length = at["length"] + piece["text"] + F.when(depth > 0, piece["tag"]).otherwise(0)
        return F.when(at["depth"] == 0, at).otherwise(
            F.struct(depth.alias("depth"), length.alias("length"))
        )

    start = F.struct(F.lit(1).alias("depth"), F.lit(0).alias("length"))
    return F.aggregate(pieces, start, walk)["length"]


def _inside(tail: Column, tags: str | Column) -> Column:
    return F.substr(tail, F.lit(1), _inside_length(tail, tags))


def _tags_of(name: Column) -> Column:
    return F.concat(F.lit("(?i)</?"), name, F.lit(r"(?=[\s/>])[^>]*+>"))


def without(name: str) -> str:
    """Pattern of markup in which no tag of a name starts or ends."""
    return rf"[^<]*+(?:<(?!/?{name}[\s/>])[^<]*+)*+"


def element(start_tag: str, group: int) -> str:
    """Pattern that captures, at a start tag whose name is in ``group``, the tag
    and what is inside; all the rest if an element of that name comes first.

    It consumes one character, so elements inside the match are found as well.
    """
    own = without(rf"\{group}")
    return rf"(?is)(?=({start_tag}(?:{own}(?=</\{group}[\s/>]|\z)|.*+)))<"


def inside_element(found: Column) -> Column:
    """What is inside the element that starts ``found`` (see ``element``)."""
    name = F.lower(F.regexp_extract(found, r"\A<([A-Za-z0-9]+)", 1))
    tail = F.regexp_replace(found, r"\A<[^>]*+>", "")
    return (
        F.when(found.rlike(rf"(?i)\A<{_VOID}[\s/>]"), "")
        .when(found.rlike(r"(?i)\A<([a-z0-9]++)[^>]*+>" + without(r"\1") + r"\z"), tail)
        .otherwise(_bound(tail, lambda t: _inside(t, _tags_of(name))))
    )


def _rule_element(
    tag: str | None, attr: str | None = None, value: str | None = None, match: str = "="
) -> str:
    return element(_open_tag(tag, attr, value, match), 2)


def _if_held(page: Column, value: str | None, found: Column) -> Column:
    """Pages without the wanted value are not scanned."""
    return found if value is None else F.when(page.contains(value), found)


def first_inner(
    page: Column,
    tag: str | None,
    attr: str | None = None,
    value: str | None = None,
    match: str = "=",
) -> Column:
    """Markup inside the first matching element, or null if there is none.

    A rule is a tag (any, if None), an attribute, its value and how to match it.
    """
    found = _first_element(page, tag, attr, value, match)
    return _bound(found, lambda e: F.when(e != "", inside_element(e)))


def _first_element(
    page: Column,
    tag: str | None,
    attr: str | None = None,
    value: str | None = None,
    match: str = "=",
) -> Column:
    """The first matching element (see ``element``); empty or null if there is none."""
    found = F.regexp_extract(page, _rule_element(tag, attr, value, match), 1)
    return _if_held(page, value, found)


def first_text(page: Column, *rule: str | None, **kw: str | None) -> Column:
    """Squashed text of the first matching element, or null."""
    return squashed_text(first_inner(page, *rule, **kw))


def attribute(open_tag: Column, attr: str) -> Column:
    """Value of an attribute in one start tag, or null if it is not set."""
    pattern = rf"(?is)\s{re.escape(attr)}\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>\"']+)"
    value = F.get(F.regexp_extract_all(open_tag, F.lit(pattern), F.lit(1)), F.lit(0))
    return _decode_markup(F.regexp_replace(value, r"\A[\"']|[\"']\z", ""))


def first_tag(
    page: Column,
    tag: str | None,
    attr: str | None = None,
    value: str | None = None,
    match: str = "=",
) -> Column:
    """The first matching start tag, or null if there is none."""
    pattern = "(?i)" + _open_tag(tag, attr, value, match)
    found = F.regexp_extract(page, pattern, 0)
    return _if_held(page, value, F.nullif(found, F.lit("")))


def first_attr(page: Column, take: str, *rule: str | None, **kw: str | None) -> Column:
    """An attribute of the first matching element, or null."""
    return attribute(first_tag(page, *rule, **kw), take)


def anchor_hrefs(page: Column) -> Column:
    """``href`` of every anchor in page order; missing and empty ones dropped."""
    tags = F.regexp_extract_all(page, F.lit(r"(?is)<a\s[^>]*>"), F.lit(0))
    hrefs = F.transform(tags, lambda t: attribute(t, "href"))
    return F.filter(hrefs, lambda h: h.isNotNull() & (h != ""))


def anchor_pairs(page: Column) -> Column:
    """``(href, text)`` of every anchor in page order."""
    whole = F.regexp_extract_all(page, F.lit(r"(?is)<a\s[^>]*>.*?</a\s*>"), F.lit(0))
    return F.transform(
        whole,
        lambda a: F.struct(
            attribute(F.regexp_extract(a, r"^<[^>]*>", 0), "href").alias("href"),
            squashed_text(a).alias("text"),
        ),
    )


def title(page: Column) -> Column:
    return squashed_text(first_inner(page, "title"))
