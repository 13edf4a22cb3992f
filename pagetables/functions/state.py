"""Embedded page state (JSON in a script tag) and API bodies."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagetables.functions.links import PAGE_SUFFIX
from pagetables.functions.text import join_list, strength_label

# Where a page keeps its state, and which API responses matter.
STATE_SCRIPT_ID = "__NEXT_DATA__"
API_HINT = "search-product-service"

# The known part of the state, as its records name it.
# ``finalPrice`` stays a VARIANT so that an explicit null (a variant null) can
# be told from an absent key (a SQL null); prices and their marks are read as
# VARIANT because ``380000.0`` and ``1`` are good ones too.
STATE_SCHEMA = """
props struct<pageProps struct<
  product struct<
    sku string, webName string, officialProductName string, brand string,
    brandOrigin string, manufactor string, producer string, registNum string,
    dosageForm string, specification string, expirationDate string,
    shortDescription string,
    categories array<struct<name string>>,
    ingredient array<struct<name string, shortDescription string>>,
    prices array<struct<isSellDefault variant, measureUnitName string, price variant>>,
    primaryImage struct<url string>,
    secondaryImages array<struct<url string>>>,
  content struct<usage string, dosage string, adverseEffect string,
    careful string, preservation string, description string>,
  initPromotionPrices array<struct<finalPrice variant,
    promotionTags array<struct<promotionTitle string>>>>,
  initReview struct<avgRating double, total bigint>,
  initComment struct<total bigint>>>
"""


def state_json(page: Column, script_id: str = STATE_SCRIPT_ID) -> Column:
    """Text of the state script, or null when the page has none.

    Comments and other scripts are stepped over, so what they hold is not found.
    """
    pattern = (
        rf"(?is)<(?:script\s(?:[^>]*?\s)?id\s*=\s*[\"']{script_id}[\"'][^>]*+>(.*?)</script\s*+>"
        r"|!--.*?(?:-->|\z)|script\b[^>]*+>.*?(?:</script\s*+>|\z))"
    )
    found = F.regexp_extract_all(page, F.lit(pattern), F.lit(1))
    return F.when(
        page.contains(script_id), F.get(F.filter(found, lambda text: text != ""), F.lit(0))
    )


def page_props(page: Column) -> Column:
    """The typed state of a page; null fields where the JSON is missing or bad."""
    return F.from_json(state_json(page), STATE_SCHEMA)["props"]["pageProps"]


def json_path(body: Column, path: str, as_type: str) -> Column:
    """Value at a path of a JSON text; null if absent, null or of another type."""
    return F.try_variant_get(F.try_parse_json(body), path, as_type)


def default_price(prices: Column) -> Column:
    """The first price marked as the default, else the first, else null.

    ``true`` and any number but 0 are marks. The price comes out as a whole number.
    """
    marked = F.filter(prices, lambda p: F.try_variant_get(p["isSellDefault"], "$", "boolean"))
    pick = F.coalesce(F.get(marked, F.lit(0)), F.get(prices, F.lit(0)))
    held = F.transform(
        F.filter(F.array(pick), lambda p: p.isNotNull()),
        lambda p: F.struct(
            p["measureUnitName"].alias("measureUnitName"),
            F.try_variant_get(p["price"], "$", "bigint").alias("price"),
        ),
    )
    return F.get(held, F.lit(0))


def final_price(promotions: Column, list_price: Column) -> Column:
    """Final price of the first promotion.

    The list price stands in only where the key is absent; an explicit null
    stays null.
    """
    offered = F.get(promotions, F.lit(0))["finalPrice"]
    return F.when(offered.isNull(), list_price).otherwise(
        F.try_variant_get(offered, "$", "bigint")
    )


def names(items: Column, field: str) -> Column:
    """One field of each object in a list; a missing list gives an empty one."""
    return F.coalesce(F.transform(items, lambda x: x[field]), F.array().cast("array<string>"))


def strength_labels(items: Column) -> Column:
    labels = F.transform(items, lambda x: strength_label(x["name"], x["shortDescription"]))
    return F.coalesce(labels, F.array().cast("array<string>"))


def image_list(main: Column, others: Column) -> Column:
    """Main image first, then the others; a missing main image leaves no gap."""
    return F.array_compact(F.concat(F.array(main["url"]), names(others, "url")))


def path_text(items: Column, separator: str) -> Column:
    return join_list(names(items, "name"), separator)


def _slugs_in(body: object) -> list[str]:
    """Page slugs at any depth; an object's own slug precedes those below it."""
    found: list[str] = []
    todo = [body]
    while todo:
        node = todo.pop()
        if isinstance(node, dict):
            own = node.get("slug")
            if isinstance(own, str) and own.endswith(PAGE_SUFFIX):
                found.append(own)
            todo.extend(reversed(list(node.values())))
        elif isinstance(node, list):
            todo.extend(reversed(node))
    return found


# A string, or a mark that opens, closes or separates; other values are skipped.
_TOKEN = re.compile(r'"(?:[^"\\]|\\.)*"|[{}\[\],:]', re.DOTALL)


def _slugs_by_tokens(body: str) -> list[str]:
    """As ``_slugs_in``, token by token: for bodies nested too deeply to parse."""
    found: dict[int, str] = {}
    open_objects: list[int] = []  # number of each open object, -1 for a list
    objects, key, text = 0, "", None
    for token in _TOKEN.findall(body):
        if token == ":":
            key, text = text, None
        elif token in "{[":
            open_objects.append(objects if token == "{" else -1)
            objects += token == "{"
            key, text = "", None
        elif token[0] == '"':
            text = json.loads(token, strict=False)
        else:
            if key == "slug" and text and text.endswith(PAGE_SUFFIX) and open_objects and open_objects[-1] >= 0:
                found[open_objects[-1]] = text
            key, text = "", None
            if token in "}]" and open_objects:
                open_objects.pop()
    return [found[i] for i in sorted(found)]


@F.pandas_udf(T.ArrayType(T.StringType()))
def _slug_walk(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    def read(body: str | None) -> list[str]:
        if body is None:
            return []
        try:
            return _slugs_in(json.loads(body))
        except RecursionError:
            return _slugs_by_tokens(body)
        except ValueError:
            return []

    for bodies in batches:
        yield bodies.map(read)


def recursive_slugs(body: Column) -> Column:
    """All page slugs of a JSON body, in pre-order, at any depth.

    VARIANT sorts the keys of an object, so only a walk over the text keeps the
    order in which slugs are met. Bodies that cannot hold a slug stay in the JVM
    and reach the Arrow batch as nulls.
    """
    possible = body.contains("slug") | body.contains("\\u")
    return _slug_walk(F.when(possible, body))


@F.pandas_udf(T.BooleanType())
def _parses(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    def read(body: str | None) -> bool:
        if body is None:
            return False
        try:
            json.loads(body)
        except RecursionError:
            return True
        except ValueError:
            return False
        return True

    for bodies in batches:
        yield bodies.map(read).astype(bool)


def is_json(body: Column) -> Column:
    """Whether a body is JSON, as Python's parser has it.

    What VARIANT accepts is; it has limits of its own (size, depth, repeated keys,
    NaN), so what it refuses is parsed once more. A body nested too deeply for that
    counts as JSON; a null one does not.
    """
    accepted = F.try_parse_json(body).isNotNull()
    return accepted | _parses(F.when(~accepted, body))
