"""Result summaries and reconciliation of two readings of one record."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def ok_summary(results: DataFrame, error: str = "error") -> DataFrame:
    """All rows and those without an error."""
    return results.agg(
        F.count("*").alias("rows"), F.count_if(F.col(error).isNull()).alias("ok_rows")
    )


def run_ledger(
    results: DataFrame,
    ok: Column,
    seconds: Column,
    at: Column,
    memory_mb: Column,
    keys: tuple[str, ...] = ("tool", "run"),
) -> DataFrame:
    """One row per run: pages, good pages, busy and elapsed time, peak memory.

    Seconds are summed as decimals, so the total does not depend on task order.
    """
    elapsed = F.timestamp_diff("MICROSECOND", F.min(at), F.max(at)) / F.lit(1_000_000.0)
    return results.groupBy(*keys).agg(
        F.count("*").alias("pages"),
        F.count_if(ok).alias("ok_pages"),
        F.sum(seconds.cast("decimal(18,2)")).cast("double").alias("busy_s"),
        elapsed.alias("elapsed_s"),
        F.max(memory_mb).alias("peak_mb"),
        F.max(at).alias("finished_at"),
    )


def compare(both: DataFrame, key: str, a: str, b: str, fields: list[str]) -> DataFrame:
    """Field by field, two readings held as structs in one row.

    The status is equal, differ, only_a or only_b; fields neither has are left out.
    """
    cells = F.array(
        *[
            F.struct(
                F.lit(f).alias("field"),
                F.nullif(F.col(a)[f].cast("string"), F.lit("")).alias("value_a"),
                F.nullif(F.col(b)[f].cast("string"), F.lit("")).alias("value_b"),
            )
            for f in fields
        ]
    )
    status = (
        F.when(F.col("value_b").isNull(), "only_a")
        .when(F.col("value_a").isNull(), "only_b")
        .when(F.col("value_a") == F.col("value_b"), "equal")
        .otherwise("differ")
    )
    return (
        both.select(key, F.inline(cells))
        .filter("value_a is not null or value_b is not null")
        .withColumn("status", status)
    )


def reconcile(a: DataFrame, b: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """Compare two tables of readings.

    Both sides hold one row per record, so the join moves one row per record and
    side rather than one per field.
    """
    left = a.select(key, F.struct(*fields).alias("__a"))
    right = b.select(key, F.struct(*fields).alias("__b"))
    return compare(left.join(right, key, "full_outer"), key, "__a", "__b", fields)
