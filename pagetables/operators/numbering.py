"""Dense row numbers without a single-task window."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pagetables.session import materialize

# monotonically_increasing_id() keeps the partition in the upper bits and the
# row within it in the lower 33.
_ROW_BITS = 33


def dense_index(df: DataFrame, order: list[Column], name: str) -> DataFrame:
    """Number the rows 1..n in ``order``, which must be unique.

    One range shuffle sorts the rows; their place is written out, because range
    bounds are sampled and must not be drawn twice. The offsets are one row per
    partition, so they are safe to broadcast however large the table is.
    """
    place = "__place"
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = materialize(ranged.withColumn(place, F.monotonically_increasing_id()), "numbered")

    part = F.shiftright(F.col(place), _ROW_BITS)
    row = F.col(place).bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    sizes = placed.groupBy(part.alias("__part")).agg(F.count("*").alias("__rows"))
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        "__part", F.coalesce(F.sum("__rows").over(before), F.lit(0)).alias("__offset")
    )
    return (
        placed.withColumn("__part", part)
        .join(F.broadcast(offsets), "__part")
        .withColumn(name, F.col("__offset") + row + 1)
        .drop("__part", "__offset", place)
    )


def rank_in_group(
    df: DataFrame,
    group: str,
    index: str,
    name: str,
    group_facts: DataFrame | None = None,
    block_rows: int = 1 << 20,
) -> DataFrame:
    """Number the rows of each group by a dense index, however large the group.

    Rows are ranked within (group, block of the index), and a block holds at
    most ``block_rows`` rows because the index is dense. What came before is
    added from per-block counts. ``group_facts`` (one row per group) are joined
    to those counts, so that the rows themselves are never shuffled by group.
    The group must not be null.
    """
    blocked = df.withColumn("__block", F.expr(f"`{index}` div {block_rows}"))
    keys = [group, "__block"]
    counts = blocked.groupBy(*keys).agg(F.count("*").alias("__rows"))
    earlier = Window.partitionBy(group).orderBy("__block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*keys, F.coalesce(F.sum("__rows").over(earlier), F.lit(0)).alias("__offset"))
    if group_facts is not None:
        offsets = offsets.join(group_facts, group, "left")
    ranked = blocked.withColumn(
        "__rank", F.row_number().over(Window.partitionBy(*keys).orderBy(index))
    )
    return (
        ranked.join(offsets, keys)
        .withColumn(name, F.col("__offset") + F.col("__rank"))
        .drop("__block", "__rank", "__offset")
    )
