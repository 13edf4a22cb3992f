"""Named queries and the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

Build = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Plan:
    name: str
    build: Build
    oracle: str | None


PLANS: dict[str, Plan] = {}


def plan(oracle: str | None = None) -> Callable[[Build], Build]:
    """Register a query under its function's name."""

    def register(build: Build) -> Build:
        name = build.__name__
        if name in PLANS:
            raise ValueError(f"query {name} is registered twice")
        PLANS[name] = Plan(name, build, oracle)
        return build

    return register
