"""Keyed entity tables: copy-on-write changes, keys and constraints.

Parquet tables reject UPDATE and DELETE, so each change is a new DataFrame over
the old one; ``KeyedTable.commit`` makes it durable as a new version and never
writes to the path being read. Joins carry no hints: a small batch of changes is
broadcast when Spark's size check allows it, and shuffled otherwise.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagetables.functions.text import contains_like
from pagetables.operators.numbering import dense_index
from pagetables.session import exists


# ---------------------------------------------------------------- ids

def high_water(*tables: DataFrame, key: str = "id") -> DataFrame:
    """One row holding the highest id ever given out (0 for none)."""
    ids = [t.select(F.max(key).cast("bigint").alias(key)) for t in tables]
    both = ids[0]
    for more in ids[1:]:
        both = both.unionByName(more)
    return both.select(F.coalesce(F.max(key), F.lit(0).cast("bigint")).alias("high_water"))


def assign_ids(
    rows: DataFrame, order: list[Column], mark: DataFrame, key: str = "id"
) -> DataFrame:
    """Give new rows ids above ``mark``, in ``order`` (unique), without gaps."""
    numbered = dense_index(rows, order, "__seq")
    next_id = mark.select("high_water").scalar() + F.col("__seq")
    return numbered.select(next_id.cast("bigint").alias(key), *rows.columns)


def append(table: DataFrame, rows: DataFrame) -> DataFrame:
    return table.unionByName(rows)


def truncate(table: DataFrame) -> DataFrame:
    """The empty table of the same shape; the high-water mark lives elsewhere."""
    return table.limit(0)


class KeyedTable:
    """A table folder that lasts: versions of the rows, each with the highest id
    ever given out, which deletions do not lower.

    ``root`` lies apart from scratch data, and is all that another session needs
    to open the table again. A version counts once its mark is written, which is
    the last thing a commit does; one that breaks off is never read and its number
    is used again. One writer at a time.
    """

    def __init__(self, spark: SparkSession, root: str, schema: T.StructType, key: str = "id"):
        self.spark, self.root, self.schema, self.key = spark, root.rstrip("/"), schema, key

    def _marks(self) -> DataFrame:
        """``(version, high_water)``, one row per version."""
        schema = "high_water bigint, version int"
        if not exists(self.spark, f"{self.root}/marks"):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(f"{self.root}/marks")

    def version(self) -> int:
        """Number of the last commit; 0 if there is none."""
        return self._marks().agg(F.coalesce(F.max("version"), F.lit(0))).first()[0]

    def rows(self, version: int | None = None) -> DataFrame:
        """The rows of a version, the last one if not named."""
        version = self.version() if version is None else version
        if version == 0:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(f"{self.root}/rows/version={version}")

    def mark(self) -> DataFrame:
        """One row holding the highest id ever given out (0 for none)."""
        marks = self._marks()
        return marks.select(F.coalesce(F.max("high_water"), F.lit(0).cast("bigint")).alias("high_water"))

    def new_rows(self, rows: DataFrame, order: list[Column]) -> DataFrame:
        """``rows`` with unused ids, in ``order``."""
        return assign_ids(rows, order, self.mark(), self.key).select(*self.schema.names)

    def commit(self, table: DataFrame) -> DataFrame:
        """Write ``table`` as the next version and read it back."""
        version = self.version() + 1
        table.select(*self.schema.names).write.mode("overwrite").parquet(
            f"{self.root}/rows/version={version}"
        )
        written = self.rows(version)
        earlier = self.mark().withColumnRenamed("high_water", self.key)
        high_water(written, earlier, key=self.key).write.mode("overwrite").parquet(
            f"{self.root}/marks/version={version}"
        )
        return written


# ---------------------------------------------------------------- changes

def latest(changes: DataFrame, key: str | list[str], order: list[str]) -> DataFrame:
    """The last change per key: one aggregate, combined before the shuffle."""
    keys = [key] if isinstance(key, str) else key
    others = [c for c in changes.columns if c not in keys]
    if not others:
        return changes.distinct()
    newest = F.max_by(F.struct(*others), F.struct(*order)).alias("__row")
    return changes.groupBy(*keys).agg(newest).select(*keys, "__row.*").select(*changes.columns)


def update_by_key(table: DataFrame, changes: DataFrame, key: str) -> DataFrame:
    """Overwrite every other column of the rows whose key has a change.

    ``changes`` holds one row per key (see ``latest``); its nulls are written too.
    """
    others = [c for c in table.columns if c != key]
    new = changes.select(key, F.struct(*others).alias("__new"))
    joined = table.join(new, key, "left")
    changed = F.col("__new").isNotNull()
    return joined.select(
        *[
            F.col(c) if c == key
            else F.when(changed, F.col("__new")[c]).otherwise(F.col(c)).alias(c)
            for c in table.columns
        ]
    )


def _distinct(rows: DataFrame, key: str) -> DataFrame:
    """The keys of ``rows``, each once: a key on a third of them is reduced before
    the shuffle, and the join then needs no other one."""
    return rows.select(key).distinct()


def delete_by_key(table: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    return table.join(_distinct(keys, key), key, "left_anti")


def upsert(table: DataFrame, changes: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of ``changes`` replace those of the same key; the rest stay."""
    return table.join(changes.select(*keys), keys, "left_anti").unionByName(changes)


def lookup(table: DataFrame, key: str, value: object) -> DataFrame:
    """The row with a key; the predicate reaches the Parquet scan."""
    return table.filter(F.col(key) == F.lit(value))


def lookup_batch(table: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    return table.join(_distinct(keys, key), key, "left_semi")


def missing_keys(keys: DataFrame, table: DataFrame, key: str) -> DataFrame:
    """Requested keys the table does not have."""
    return _distinct(keys, key).join(_distinct(table, key), key, "left_anti")


def search(table: DataFrame, column: str, needle: Column | str) -> DataFrame:
    return table.filter(contains_like(F.col(column), needle))


# ---------------------------------------------------------------- constraints

def check_required(df: DataFrame, columns: list[str]) -> DataFrame:
    """Add ``reason``: the first required column that is null, else null."""
    reason = F.coalesce(
        *[F.when(F.col(c).isNull(), F.lit(f"{c} is null")) for c in columns]
    )
    return df.withColumn("reason", reason)


def first_per_key(df: DataFrame, keys: list[str], row_id: str) -> DataFrame:
    """Ids of the rows that came first under their key.

    Keys are compared by their SHA-256 digest, so long keys do not travel, and a
    key shared by a third of the table is reduced before the shuffle. As in SQL,
    a null equals no other key.
    """
    complete = F.lit(True)
    for key in keys:
        complete = complete & F.col(key).isNotNull()
    own = F.when(~complete, F.col(row_id)).alias("__row")
    digest = F.sha2(F.to_json(F.struct(*keys, own)), 256)
    return df.groupBy(digest.alias("__key")).agg(F.min(row_id).alias(row_id)).select(row_id)


def mark_unique(
    df: DataFrame, keys: list[str], row_id: str, columns: list[str] | None = None
) -> DataFrame:
    """Add ``kept``: whether the row is the first under its key.

    The join is on the unique ``row_id``, so a hot key cannot skew it. Only
    ``columns`` travel through it (all, if None).
    """
    winners = first_per_key(df, keys, row_id).withColumn("kept", F.lit(True))
    wanted = df if columns is None else df.select(*columns)
    return wanted.join(winners, row_id, "left").withColumn(
        "kept", F.coalesce("kept", F.lit(False))
    )


def split_unique(df: DataFrame, keys: list[str], row_id: str) -> tuple[DataFrame, DataFrame]:
    """Rows kept and rows rejected by a unique constraint; the first one wins."""
    marked = mark_unique(df, keys, row_id)
    return marked.filter("kept").drop("kept"), marked.filter("not kept").drop("kept")


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Composite keys held by more than one row, and null keys, with their counts."""
    any_null = F.lit(False)
    for key in keys:
        any_null = any_null | F.col(key).isNull()
    counted = df.groupBy(*keys).agg(F.count("*").alias("copies"))
    return counted.filter((F.col("copies") > 1) | any_null)
