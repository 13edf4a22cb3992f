"""What the text operators share."""

from __future__ import annotations

import math
import sys
import types
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Text is cut into words at these characters.
SPACE = r"[\x20\x09-\x0D]+"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is evaluated once per row.

    A column that a lambda uses is evaluated again for every element; bound as
    the variable of an outer lambda it is not.
    """
    return F.element_at(F.transform(F.array(value), body), 1)


def words(text: Column) -> Column:
    """The words of a text; null has none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE), "")


def literal_rows(spark: SparkSession, names: list[str], rows: list[tuple]) -> DataFrame:
    """A small table of constants, made by the JVM alone."""
    structs = [F.struct(*(F.lit(v).alias(n) for n, v in zip(names, row, strict=True))) for row in rows]
    return spark.range(1).select(F.inline(F.array(*structs)))


#: At most so many rows of 16 bytes go into the bitmap that ``maybe_in`` broadcasts.
MOST_SLOTS = 1 << 20


def maybe_in(df: DataFrame, value: Column, ids: DataFrame, name: str) -> DataFrame:
    """``df`` with a flag ``name``: false where ``value`` is surely not among ``ids``.

    ``ids`` (one column, written out) become a bitmap of about 16 bits each, and of a
    fixed size at most, which is broadcast. Few rows are flagged wrongly; of far more
    ids than the bitmap has bits for, more are. A join of the flagged rows decides.
    """
    slots = 1 << max(6, min(int(math.log2(MOST_SLOTS)), math.ceil(math.log2(max(1, ids.count()) / 4))))

    def place(v: Column) -> tuple[Column, Column]:
        h = F.xxhash64(v)
        return F.pmod(F.shiftright(h, 8), F.lit(slots)), h.bitwiseAND(F.lit(63)).cast("int")

    slot, bit = place(F.col(f"`{ids.columns[0]}`"))
    bitmap = ids.select(slot.alias("__slot"), bit.alias("bit")).groupBy("__slot").agg(
        F.bit_or(F.expr("shiftleft(1L, bit)")).alias("__bits")
    )
    own_slot, own_bit = place(value)
    held = df.select("*", own_slot.alias("__slot"), own_bit.alias("__bit")).join(F.broadcast(bitmap), "__slot", "left")
    flag = F.expr("coalesce(shiftright(__bits, __bit) & 1, 0) = 1")
    return held.select(*(f"`{c}`" for c in df.columns), flag.alias(name))


def portions(batch: pa.RecordBatch, rows: int, chars: int) -> Iterator[pa.RecordBatch]:
    """Rows of a batch, at most so many and of about so many characters (of its second
    column) at a time."""
    first, size = 0, 0
    for at, one in enumerate(pc.fill_null(pc.utf8_length(batch.column(1)), 0).to_pylist()):
        if at > first and (at - first == rows or size + one > chars):
            yield batch.slice(first, at - first)
            first, size = at, 0
        size += one
    if first < batch.num_rows:
        yield batch.slice(first)


def worker_state(name: str, make: Callable[[], object]) -> object:
    """What ``make`` gave when this Python worker first asked for ``name``.

    Functions travel to the workers by value, so a global of theirs begins anew with
    every task; a module of this name in ``sys.modules`` lives as long as the worker.
    """
    held = sys.modules.setdefault("_pagetables_worker", types.ModuleType("_pagetables_worker"))
    if not hasattr(held, name):
        setattr(held, name, make())
    return getattr(held, name)
