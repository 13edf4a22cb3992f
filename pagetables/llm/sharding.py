"""Sharding by extendible hashing.

A document's hash is a string of bits; the directory is the set of prefixes that are
shards. A prefix that holds more bytes than a shard may is split on its next bit,
others are not, so every shard is a prefix of its own depth.

The splits of one pass are found at once: bytes are summed per cell (the first bits
of the hash, a few more than shards need on average), each cell gives its sum to all
of its prefixes, and a cell's shard is its shortest prefix that fits. Cells that do
not fit whole are taken up again by their following bits.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagetables.session import materialize

#: Bits of a hash: of the key, of the text, and drawn per row, so that keys, and rows
#: equal in key and text, can be split as well.
KEY_BITS, TEXT_BITS, ROW_BITS = 32, 16, 12
BITS = KEY_BITS + TEXT_BITS + ROW_BITS


@dataclass(frozen=True)
class Shards:
    """No shard above ``limit`` bytes; a pass looks ``spare`` bits beyond the average."""

    limit: int = 1 << 20
    spare: int = 4


def _bits(digest: Column, bits: int) -> Column:
    return F.conv(F.substring(digest, 1, bits // 4), 16, 10).cast("long")


def hash_of(key: Column, text: Column) -> Column:
    """The ``BITS`` bits of a row: its key decides first, then its text, then chance."""
    by_key = F.shiftleft(_bits(F.md5(F.coalesce(key.cast("string"), F.lit("")).cast("binary")), KEY_BITS), TEXT_BITS + ROW_BITS)
    by_text = F.shiftleft(_bits(F.md5(F.coalesce(text, F.lit("")).cast("binary")), TEXT_BITS), ROW_BITS)
    by_row = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(1 << ROW_BITS))
    return by_key + by_text + by_row


def _pass(hashes: DataFrame, start: int, stop: int, rule: Shards) -> DataFrame:
    """``cell`` (the first ``stop`` bits), ``depth`` and ``shard_bytes`` of its shard.

    ``depth`` is null for a cell that is too large as a whole and can still be split.
    ``hashes`` are those whose first ``start`` bits are known to be too large.
    """
    cell = F.shiftright("hash", BITS - stop)
    cells = hashes.groupBy(cell.alias("cell")).agg(
        F.sum("bytes").alias("bytes"), F.count("*").alias("rows")
    )
    depths = cells.withColumn("depth", F.explode(F.sequence(F.lit(start), F.lit(stop))))
    prefix = F.expr(f"cell div cast(pow(2, {stop} - depth) as bigint)")
    nodes = depths.withColumn("prefix", prefix)
    sums = nodes.groupBy("depth", "prefix").agg(F.sum("bytes").alias("bytes"), F.sum("rows").alias("rows"))
    # One row alone is not split further, nor is what has no bits left.
    fits = sums.filter((F.col("bytes") <= rule.limit) | (F.col("rows") == 1) | (F.col("depth") == BITS))
    own = nodes.select("cell", "depth", "prefix").join(fits, ["depth", "prefix"], "left")
    leaf = F.min(F.when(F.col("bytes").isNotNull(), F.struct("depth", "bytes")))
    return own.groupBy("cell").agg(leaf.alias("leaf")).select(
        "cell", F.col("leaf.depth").alias("depth"), F.col("leaf.bytes").alias("shard_bytes")
    )


def assign(
    docs: DataFrame, key: str = "doc_id", text: str = "text", rule: Shards = Shards()
) -> DataFrame:
    """``docs`` with one column more, ``shard``, a struct of ``bytes`` (of the row's text
    in UTF-8), ``shard`` (the bits of its prefix, ``root`` if there is but one shard),
    ``depth`` (how many) and ``shard_bytes`` (of the whole shard).

    Null and empty texts have no bytes; null keys hash as empty ones. A row above the
    limit is a shard of its own. Rows with one key are split by text, and rows equal in
    both by chance, only where they would not fit otherwise; which of the equal rows
    lies where may then change if the table is read in another order. An empty table
    stays empty. A column called ``shard`` is replaced.
    """
    size = F.coalesce(F.octet_length(F.col(f"`{text}`")), F.lit(0)).cast("long")
    code = hash_of(F.col(f"`{key}`"), F.col(f"`{text}`"))
    hashes = materialize(docs.select(code.alias("hash"), size.alias("bytes")), "hashes")
    total = hashes.agg(F.coalesce(F.sum("bytes"), F.lit(0))).first()[0]
    stop = min(KEY_BITS, max(0, math.ceil(math.log2(max(1, total / rule.limit)))) + rule.spare)

    placed = docs.drop("shard").select(F.struct("*").alias("row"), code.alias("hash"), size.alias("bytes")).select(
        "*", F.lit(None).cast("int").alias("depth"), F.lit(None).cast("long").alias("shard_bytes")
    )
    start = 0
    while True:
        found = materialize(_pass(hashes, start, stop, rule), "directory")
        here = F.shiftright("hash", BITS - stop)
        placed = (
            placed.withColumn("cell", here)
            .join(found.toDF("cell", "own_depth", "own_bytes"), "cell", "left")
            .withColumn("shard_bytes", F.coalesce("shard_bytes", "own_bytes"))
            .withColumn("depth", F.coalesce("depth", "own_depth"))
            .drop("own_depth", "own_bytes", "cell")
        )
        left = found.filter("depth is null").select("cell")
        if stop == BITS or not left.limit(1).count():
            break
        hashes = hashes.withColumn("cell", here).join(left, "cell", "left_semi").drop("cell")
        start, stop = stop, min(BITS, stop + 8)
    # A row drawn anew into a cell that was empty is a shard of that cell.
    depth = F.coalesce("depth", F.lit(stop))
    prefix = F.expr(f"hash div cast(pow(2, {BITS} - coalesce(depth, {stop})) as bigint)")
    name = F.when(depth == 0, F.lit("root")).otherwise(F.lpad(F.bin(prefix), depth, F.lit("0")))
    shard = F.struct(
        "bytes",
        name.alias("shard"),
        depth.cast("long").alias("depth"),
        F.coalesce("shard_bytes", "bytes").alias("shard_bytes"),
    )
    return placed.select("row", shard.alias("shard")).select("row.*", "shard")


def write_shards(assigned: DataFrame, path: str) -> None:
    """Write the shards as folders ``shard_name=<bits>`` of Parquet files."""
    flat = assigned.withColumn("shard_name", F.col("shard.shard")).drop("shard")
    flat.repartition("shard_name").write.partitionBy("shard_name").parquet(path)
