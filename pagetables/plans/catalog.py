"""All queries, by name."""

from __future__ import annotations

from pagetables.plans import entities, ledgers, links, listings, markup, products, streams, texts  # noqa: F401
from pagetables.plans.registry import PLANS, Build


def queries() -> dict[str, Build]:
    return {name: p.build for name, p in PLANS.items()}


def oracle_sql() -> dict[str, str]:
    return {name: p.oracle for name, p in PLANS.items() if p.oracle is not None}
