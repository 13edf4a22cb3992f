"""One element index per page, and what can be asked of it.

``index`` scans a page's tags once, with the stack of open elements, and gives each
element the places where it starts and ends, its depth, and the start of the element
around it. Descendants, children and siblings are then comparisons of these numbers;
no pattern runs over the page again, and an element's text is a slice of the texts
between the tags. All of that is Column functions.

The scan itself is an Arrow function: ``aggregate`` copies its whole state at every step,
so a fold over tags that gathers elements takes time by the square of their number.

An element ends at its end tag, at the latest with the element around it or the page.
A ``p``, ``li``, ``option``, or part of a table or a description list also ends where another
of its name starts right inside it. End tags of elements that are not open count for
nothing.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagetables.functions import markup as M

# Elements whose end tag may be left out before another of their name.
_ENDED_BY_NEXT = frozenset(("p", "li", "dt", "dd", "tr", "td", "th", "option"))
_TAG = re.compile(r"<[/!?A-Za-z][^>]*(?:>|\Z)")
_TAGS = re.compile(f"({_TAG.pattern})")
_NAME = re.compile(r"</?([A-Za-z][^\s/>]*)")
_ALONE = re.compile(rf"(?i){M._VOID}\Z")

_ELEMENT = T.StructType(
    [T.StructField(n, T.IntegerType()) for n in ("at", "end", "depth", "up")]
    + [T.StructField(n, T.StringType()) for n in ("name", "around", "tag")]
)
_INDEX = T.StructType(
    [T.StructField("texts", T.ArrayType(T.StringType())), T.StructField("elements", T.ArrayType(_ELEMENT))]
)


# A portion of a batch holds about so many characters of pages, and a worker remembers
# so many tags of so many characters.
_PORTION = 1 << 20
_KNOWN_TAGS, _KNOWN_LENGTH = 4096, 100


def _kind(tag: str) -> tuple[str, bool, bool, bool]:
    """A tag's name (empty if it has none), whether it is an end tag, whether it stands
    alone, and whether the next of its name ends it."""
    named = _NAME.match(tag)
    name = named[1].lower() if named else ""
    alone = tag.endswith("/>") or _ALONE.match(name) is not None
    return name, tag[1] == "/", alone, name in _ENDED_BY_NEXT


def _scan_into(page: str, texts: list[str], columns: list[list], known: dict[str, tuple]) -> None:
    """Add a page's texts and elements to lists, one for each field of an element."""
    ats, ends, depths, ups, names, arounds, tags = columns
    parts = _TAGS.split(page)
    texts.extend(parts[::2])
    open_at: list[int] = []  # of each open element its place in the columns
    open_names: dict[str, int] = {}

    def end_top(at: int) -> str:
        place = open_at.pop()
        ends[place] = at
        open_names[names[place]] -= 1
        return names[place]

    for at, tag in enumerate(parts[1::2], 1):
        kind = known.get(tag)
        if kind is None:
            kind = _kind(tag)
            if len(tag) <= _KNOWN_LENGTH and len(known) < _KNOWN_TAGS:
                known[tag] = kind
        name, is_end, alone, ended_by_next = kind
        if not name:
            continue
        if is_end:
            # Only where such an element is open is the stack unwound to it.
            while open_names.get(name) and end_top(at) != name:
                pass
            continue
        if open_at and not alone and ended_by_next and names[open_at[-1]] == name:
            end_top(at)
        ats.append(at)
        ends.append(at)
        depths.append(len(open_at))
        ups.append(ats[open_at[-1]] if open_at else 0)
        arounds.append(names[open_at[-1]] if open_at else "")
        names.append(name)
        tags.append(tag)
        if not alone:
            open_at.append(len(names) - 1)
            open_names[name] = open_names.get(name, 0) + 1
    while open_at:
        end_top(len(parts) // 2 + 1)


def scan(page: str) -> tuple[list[str], list[list]]:
    """Texts between the tags, and the elements ``[at, end, depth, up, name, around, tag]``."""
    texts, columns = [], [[] for _ in _ELEMENT.names]
    _scan_into(page, texts, columns, {})
    return texts, [list(e) for e in zip(*columns, strict=True)]


def _portions(pages: pa.Array) -> Iterator[pa.Array]:
    """Parts of a batch, of about ``_PORTION`` bytes or a single page each."""
    first, size = 0, 0
    for at, one in enumerate(pc.binary_length(pages).to_pylist()):
        if at > first and size + (one or 0) > _PORTION:
            yield pages.slice(first, at - first)
            first, size = at, 0
        size += one or 0
    yield pages.slice(first)


@F.arrow_udf(_INDEX)
def _scan(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    kinds = [pa.int32()] * 4 + [pa.string()] * 3
    known: dict[str, tuple] = {}
    # An index is many times its page, so that of a whole batch is never held at once.
    for pages in (part for batch in batches for part in _portions(batch)):
        texts, columns, text_ends, ends, nulls = [], [[] for _ in kinds], [0], [0], []
        for page in pages.to_pylist():
            nulls.append(page is None)
            if page is not None:
                _scan_into(page, texts, columns, known)
            text_ends.append(len(texts))
            ends.append(len(columns[0]))
        values = pa.StructArray.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=_ELEMENT.names
        )
        lists = [
            pa.ListArray.from_arrays(pa.array(text_ends, pa.int32()), pa.array(texts, pa.string())),
            pa.ListArray.from_arrays(pa.array(ends, pa.int32()), values),
        ]
        yield pa.StructArray.from_arrays(lists, names=_INDEX.names, mask=pa.array(nulls, pa.bool_()))


def index(prepared: Column) -> Column:
    """``(texts, elements)`` of prepared markup (see ``markup.prepare``); null for null.

    ``texts[i]`` is the text after tag ``i``, ``texts[0]`` what stands before the first.
    An element starts with tag ``at`` and ends before tag ``end``; ``up`` is the start of the
    element around it and ``around`` its name, 0 and nothing if there is none. Elements are
    in order of their start.
    """
    return _scan(prepared)


def with_index(pages: DataFrame, html: str = "html", name: str = "page") -> DataFrame:
    """Pages with the index of their markup in place of the markup."""
    others = [c for c in pages.columns if c != html]
    return pages.select(*others, index(M.prepare(F.col(html))).alias(name))


class Page:
    """Reads a column that holds an index. Elements are found in page order.

    ``lists`` holds columns of ``parts``: rules look through these alone.
    """

    def __init__(self, column: str | Column = "page", lists: dict[str, Column] | None = None) -> None:
        self.at = F.col(column) if isinstance(column, str) else column
        self.texts, self.elements = self.at["texts"], self.at["elements"]
        self.lists = lists or {}

    def parts(self, tags: Iterable[str]) -> dict[str, Column]:
        """The elements of some names, and under ``=`` those whose tag sets a value."""
        named = {tag: self.find(tag) for tag in tags}
        return named | {"=": F.filter(self.elements, lambda e: e["tag"].contains("="))}

    def _among(self, tag: str | None, value: str | None) -> Column:
        return self.lists.get("=" if value is not None else tag, self.elements)

    def find(
        self,
        tag: str | None = None,
        attr: str | None = None,
        value: str | None = None,
        match: str = "=",
        among: Column | None = None,
    ) -> Column:
        """The elements that fit a rule, of ``among`` or the whole page.

        A rule is a tag (any, if None), an attribute, its value and how to match it.
        """
        pattern = r"(?is)\A" + M._open_tag(None, attr, value, match)

        def fits(e: Column) -> Column:
            result = e["name"] == tag if tag else F.lit(True)
            if value is not None:
                result = result & e["tag"].contains(value)
            return result & e["tag"].rlike(pattern) if attr is not None else result

        return F.filter(self._among(tag, value) if among is None else among, fits)

    def first(
        self,
        tag: str | None = None,
        attr: str | None = None,
        value: str | None = None,
        match: str = "=",
        among: Column | None = None,
    ) -> Column:
        """The first element that fits, or null."""
        return F.get(self.find(tag, attr, value, match, among), F.lit(0))

    def raw(self, element: Column) -> Column:
        """Text inside an element, tags gone; null if there is no element."""

        def between(e: Column) -> Column:
            inside = F.slice(self.texts, e["at"] + 1, e["end"] - e["at"])
            return F.when(e.isNotNull(), M._decode_markup(F.array_join(inside, "")))

        return M._bound(element, between)

    def text(self, element: Column) -> Column:
        """``raw`` with white space squashed."""
        return M.squash(self.raw(element))

    def attribute(self, element: Column, attr: str) -> Column:
        """Value of an attribute; null without an element or where it is not set."""
        return M.attribute(element["tag"], attr)

    # A lambda evaluates what it uses for every element; lists are bound before it.

    def inside(self, outers: Column, among: Column) -> Column:
        """Those of ``among`` that lie in one of ``outers``."""
        return M._bound(
            outers,
            lambda os: F.filter(among, lambda e: F.exists(os, lambda o: (e["at"] > o["at"]) & (e["at"] < o["end"]))),
        )

    def after(self, elements: Column, among: Column) -> Column:
        """Those of ``among`` that are siblings after one of ``elements``."""
        return M._bound(
            elements,
            lambda os: F.filter(among, lambda e: F.exists(os, lambda o: (e["up"] == o["up"]) & (e["at"] > o["at"]))),
        )

    def parents(self, elements: Column) -> Column:
        """The elements right around some others."""
        return M._bound(
            F.array_distinct(F.transform(elements, lambda e: e["up"])),
            lambda ups: F.filter(self.elements, lambda e: F.array_contains(ups, e["at"])),
        )

    def next_to(self, elements: Column, among: Column, step: int) -> Column:
        """Pairs ``of`` (an element's start) and ``next``: the nearest of ``among`` that is
        a sibling after it (``step`` 1) or before it (-1); elements without one are left out."""

        def pairs(list_of: Column) -> Column:
            def nearest(o: Column) -> Column:
                if step > 0:
                    beside = F.filter(list_of, lambda e: (e["up"] == o["up"]) & (e["at"] > o["at"]))
                else:
                    beside = F.filter(list_of, lambda e: (e["up"] == o["up"]) & (e["at"] < o["at"]))
                return F.struct(o["at"].alias("of"), F.try_element_at(beside, F.lit(step)).alias("next"))

            return F.filter(F.transform(elements, nearest), lambda pair: pair["next"].isNotNull())

        return M._bound(among, pairs)
