"""Link predicates and link resolution as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pagetables.functions.text import strip_ends

# The suffix that marks a detail page, the section of a listing page that
# holds its products, and the text of the button that says more results remain.
PAGE_SUFFIX = ".html"
SECTION_ID = "category-page__products-section"
MORE_MARKER = r"(?U)Xem thêm\s*\d+\s*sản phẩm"

_SCHEME = r"^[A-Za-z][A-Za-z0-9+.\-]*:"
_ORIGIN = r"^([A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*)"


def is_page_link(link: Column) -> Column:
    return link.endswith(PAGE_SUFFIX)


def mentions_page(link: Column) -> Column:
    return link.contains(PAGE_SUFFIX)


def has_more(button_text: Column, pattern: str = MORE_MARKER) -> Column:
    return button_text.rlike(pattern)


def origin(url: Column) -> Column:
    """Scheme and host of an absolute URL; empty for a relative one."""
    return F.regexp_extract(url, _ORIGIN, 1)


def host(url: Column) -> Column:
    return F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.\-]*://([^/?#]*)", 1)


def path_of(url: Column) -> Column:
    """Everything after the origin, without the fragment; at least ``/``."""
    rest = F.regexp_replace(F.regexp_replace(url, _ORIGIN, ""), r"#[\s\S]*$", "")
    return F.when(rest.startswith("/"), rest).otherwise(F.concat(F.lit("/"), rest))


def _drop_dots(path: Column) -> Column:
    """Resolve ``.`` and ``..`` segments of an absolute path."""
    segments = F.split(path, "/")
    walked = F.aggregate(
        segments,
        F.array().cast("array<string>"),
        lambda kept, part: F.when(part == ".", kept)
        .when(part == "..", F.slice(kept, F.lit(1), F.greatest(F.size(kept) - 1, F.lit(0))))
        .otherwise(F.array_append(kept, part)),
    )
    # A path that ends in a dot segment names a folder.
    folder = F.when(path.rlike(r"/\.\.?$"), F.array_append(walked, "")).otherwise(walked)
    joined = F.array_join(folder, "/")
    return F.when(joined.startswith("/"), joined).otherwise(F.concat(F.lit("/"), joined))


def resolve(base: Column, link: Column) -> Column:
    """``link`` as an absolute URL, read against ``base`` (RFC 3986, 5.2).

    All branches are built-in expressions; the segment walk runs only for links
    that hold dot segments.
    """
    root = origin(base)
    scheme = F.regexp_extract(base, _SCHEME, 0)
    no_fragment = F.regexp_replace(base, r"#[\s\S]*$", "")
    no_query = F.regexp_replace(base, r"[?#][\s\S]*$", "")
    folder = F.regexp_replace(F.regexp_replace(no_query, _ORIGIN, ""), r"[^/]*$", "")
    folder = F.when(folder == "", F.lit("/")).otherwise(folder)

    # Two slashes with no host behind them are no host part.
    local = F.regexp_replace(link, r"^//(?=[/?#]|$)", "")
    local_path = F.regexp_extract(local, r"^[^?#]*", 0)
    tail = F.regexp_extract(local, r"[?#][\s\S]*$", 0)
    # Where folder and link are put together, empty segments are dropped.
    merged = F.regexp_replace(F.concat(folder, local_path), "/+", "/")
    path = F.when(local.startswith("/"), local_path).otherwise(merged)
    clean = F.when(path.rlike(r"/\.\.?(?:/|$)"), _drop_dots(path)).otherwise(path)

    return (
        F.when(link == "", base)
        .when(link.rlike(_SCHEME), link)
        .when(link.startswith("//") & (link == local), F.concat(scheme, link))
        .when(local.startswith("?"), F.concat(no_query, local))
        .when(local.startswith("#") | (local == ""), F.concat(no_fragment, local))
        .otherwise(F.concat(root, clean, tail))
    )


def resolve_href(base: Column, href: Column) -> Column:
    """A markup link: outer whitespace is not part of it."""
    return resolve(base, strip_ends(href))


def resolve_slug(base: Column, slug: Column) -> Column:
    """An API slug: always below the site root, whatever slashes lead it."""
    return resolve(F.concat(base, F.lit("/")), F.regexp_replace(slug, r"^/+", ""))
