"""Harvest, upsert and run summary as Structured Streaming jobs.

Each job names the folder it lives in. Sink and checkpoint lie there, so a lost
executor or a restarted driver goes on after the last committed batch.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagetables.functions.links import resolve_slug
from pagetables.functions.state import recursive_slugs
from pagetables.operators.keyed import latest
from pagetables.schemas import RESULT_KEY, RESULTS, RUNS
from pagetables.session import children, exists, remove
from pagetables.sources.tables import api_responses

# Our parameters: the width of a summary window, and after how many batches a
# ledger is brought together.
WINDOW = "1 hour"
COMPACT_EVERY = 16


def run_to_table(stream: DataFrame, root: str) -> DataFrame:
    """Drain ``stream`` into Parquet files under ``root``, exactly once, and read them."""
    spark = stream.sparkSession
    query = (
        stream.writeStream.format("parquet")
        .outputMode("append")
        .option("path", f"{root}/data")
        .option("checkpointLocation", f"{root}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{root}/data")


def sightings(responses: DataFrame, base: Column, hint: str) -> DataFrame:
    """``(ts, url)`` of every link that a response names."""
    found = api_responses(responses, hint=hint).select(
        "ts", F.explode(recursive_slugs(F.col("body"))).alias("slug")
    )
    return found.select("ts", resolve_slug(base, F.col("slug")).alias("url"))


def harvest(responses: DataFrame, base: Column, hint: str, within: str | None = None) -> DataFrame:
    """Each link once, as the responses that name it come in.

    Without ``within`` every link is remembered. With it, a link is remembered
    for that long after its event time ``ts``, which bounds the state. A ``Ledger``
    fed with ``sightings`` keeps each link once without any state.
    """
    links = sightings(responses, base, hint)
    if within is None:
        return links.select("url").dropDuplicates(["url"])
    return links.withWatermark("ts", within).dropDuplicatesWithinWatermark(["url"])


def run_summary(
    results: DataFrame, at: str, tool: str, ok: Column, seconds: Column, window: str = WINDOW
) -> DataFrame:
    """Per window and tool: pages, good pages and busy seconds.

    Sums over some of the rows, such as those of one micro-batch, add up to the
    sums over all of them, however late a row comes.
    """
    return (
        results.groupBy(F.window(at, window).alias("w"), F.col(tool).alias("tool"))
        .agg(
            F.count("*").alias("pages"),
            F.count_if(ok).alias("ok_pages"),
            F.sum(seconds.cast("decimal(18,2)")).alias("busy_s"),
        )
        .select(F.col("w.start").alias("window_start"), "tool", "pages", "ok_pages", "busy_s")
    )


Merge = Callable[[DataFrame, list[str]], DataFrame]


def newest(*order: str) -> Merge:
    """Per key the row with the greatest ``order``; the later batch if they tie."""
    return lambda rows, keys: latest(rows, keys, [*order, "batch"])


def totals(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Per key the sums of all other columns, each in its own type."""
    sums = [
        F.sum(f.name).cast(f.dataType).alias(f.name)
        for f in rows.schema.fields
        if f.name not in keys and f.name != "batch"
    ]
    merged = rows.groupBy(*keys).agg(*sums, F.max("batch").alias("batch"))
    return merged.select(*rows.columns)


class Ledger:
    """A table with one row per key, kept as one set of changes per micro-batch.

    A batch writes only its own merged rows, to a folder named by the batch id:
    replaying it overwrites that folder with the same rows. Every
    ``compact_every`` batches the changes since the last snapshot are merged into a
    new one; a snapshot counts once its mark is written. Reading merges the
    last snapshot with the changes after it: one aggregate that combines before its
    shuffle. Rows with a null in their key go to ``rejects``.

    Two snapshots are kept; older ones, and changes that the older of the two holds, are
    removed when a new one is marked. A reader should therefore not hold a ledger's rows
    over many batches.

    ``merge`` must not care in which order, or in how many steps, rows are merged.
    """

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        schema: T.StructType,
        keys: list[str],
        merge: Merge,
        compact_every: int = COMPACT_EVERY,
    ):
        self.spark, self.root, self.schema, self.keys = spark, root.rstrip("/"), schema, keys
        self.merge, self.compact_every = merge, compact_every
        self.stored = T.StructType(schema.fields + [T.StructField("batch", T.LongType())])

    def write_batch(self, batch: DataFrame, batch_id: int) -> None:
        rows = batch.select(*self.schema.names).withColumn("batch", F.lit(batch_id).cast("bigint"))
        complete = F.lit(True)
        for key in self.keys:
            complete = complete & F.col(key).isNotNull()
        merged = self.merge(rows.filter(complete), self.keys)
        merged.drop("batch").write.mode("overwrite").parquet(f"{self.root}/changes/batch={batch_id}")
        rows.filter(~complete).drop("batch").write.mode("overwrite").parquet(
            f"{self.root}/rejects/batch={batch_id}"
        )
        if (batch_id + 1) % self.compact_every == 0:
            self._compact(batch_id)

    def _compact(self, upto: int) -> None:
        """Write the state after batch ``upto``; a replay writes the same again."""
        merged = self.merge(self._pieces(upto), self.keys)
        merged.write.mode("overwrite").parquet(f"{self.root}/snapshots/upto={upto}")
        mark = self.spark.range(1).select(F.lit(True).alias("done"))
        mark.write.mode("overwrite").parquet(f"{self.root}/marks/upto={upto}")
        self._forget(upto)

    def _forget(self, upto: int) -> None:
        """Remove what the last two snapshots have made needless.

        The last batch may come again and is then merged with what was before it: the
        snapshot before this one stays, and so do the changes after it. Marks go first, so that
        no mark is left without its snapshot.
        """
        done = sorted(int(name.split("=")[1]) for name in children(self.spark, f"{self.root}/marks") if "=" in name)
        earlier = [n for n in done if n < upto]
        if not earlier:
            return
        for old in earlier[:-1]:
            remove(self.spark, f"{self.root}/marks/upto={old}")
            remove(self.spark, f"{self.root}/snapshots/upto={old}")
        for name in children(self.spark, f"{self.root}/changes"):
            if "=" in name and int(name.split("=")[1]) <= earlier[-1]:
                remove(self.spark, f"{self.root}/changes/{name}")

    def last_snapshot(self, before: int | None = None) -> int:
        """The batch up to which rows are in a snapshot; -1 if there is none."""
        if not exists(self.spark, f"{self.root}/marks"):
            return -1
        marks = self.spark.read.schema("done boolean, upto bigint").parquet(f"{self.root}/marks")
        earlier = marks if before is None else marks.filter(F.col("upto") < before)
        return earlier.agg(F.coalesce(F.max("upto"), F.lit(-1))).first()[0]

    def _pieces(self, upto: int | None = None) -> DataFrame:
        """The last snapshot and the changes after it, as after batch ``upto``."""
        start = self.last_snapshot(upto)
        later = self._read("changes").filter(F.col("batch") > start)
        if upto is not None:
            later = later.filter(F.col("batch") <= upto)
        if start < 0:
            return later
        snapshot = self.spark.read.schema(self.stored).parquet(f"{self.root}/snapshots/upto={start}")
        return snapshot.unionByName(later)

    def before(self, batch_id: int) -> DataFrame:
        """One row per key as it was before a batch, also when that batch comes again;
        ``batch`` tells when a row came."""
        return self.merge(self._pieces(batch_id - 1), self.keys)

    def _read(self, part: str) -> DataFrame:
        path = f"{self.root}/{part}"
        if not exists(self.spark, path):
            return self.spark.createDataFrame([], self.stored)
        return self.spark.read.schema(self.stored).parquet(path)

    def drain(self, stream: DataFrame, prepare: Callable[[DataFrame], DataFrame] | None = None) -> None:
        """Take in all that ``stream`` holds now; ``prepare`` runs on each batch."""

        def write(batch: DataFrame, batch_id: int) -> None:
            self.write_batch(prepare(batch) if prepare else batch, batch_id)

        query = (
            stream.writeStream.foreachBatch(write)
            .option("checkpointLocation", f"{self.root}/checkpoint")
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()

    def rejects(self) -> DataFrame:
        return self._read("rejects")

    def current(self) -> DataFrame:
        """One row per key."""
        return self.merge(self._pieces(), self.keys).drop("batch")


RUN_KEY = ["cong_cu", "lan"]
_SUMS = T.StructType(
    [
        T.StructField("cong_cu", T.StringType()),
        T.StructField("lan", T.IntegerType()),
        T.StructField("so_url", T.LongType()),
        T.StructField("so_trang_ok", T.LongType()),
        T.StructField("tong_thoi_gian", T.DecimalType(28, 6)),
        T.StructField("thoi_gian_xu_ly", T.DecimalType(28, 6)),
        T.StructField("thoi_diem", T.TimestampType()),
    ]
)


def _run_sums(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Per run the sums of its changes, and the latest time."""
    merged = totals(rows.drop("thoi_diem"), keys)
    latest_at = rows.groupBy(*keys).agg(F.max("thoi_diem").alias("thoi_diem"))
    same = [F.col(f"s.{k}").eqNullSafe(F.col(f"t.{k}")) for k in keys]
    both = merged.alias("s").join(latest_at.alias("t"), same)
    return both.select(*[F.col(f"s.{c}") if c != "thoi_diem" else F.col("t.thoi_diem") for c in rows.columns])


class RunLedger:
    """The run ledger, fed by results as they come: two ledgers under one folder.

    ``results`` holds the newest result per tool, run and URL. When a batch replaces a
    result, the run's changes take the old one out and put the new one in; a result
    that is older than the one that stands changes neither. Only the batch's keys
    are sought among the results, and a batch that comes again is compared with the results
    before it, so it writes the same changes.

    A run's ``so_url``, ``so_trang_ok`` and ``thoi_gian_xu_ly`` are of the results that
    stand; ``tong_thoi_gian`` is the time of all tries, replaced ones too, and ``thoi_diem``
    that of the last try. Nothing measures ``ram_dinh_mb``, which is null. Results with a
    null in their key go to the rejects of ``results`` and count for no run.
    """

    def __init__(self, spark: SparkSession, root: str, ok: str = "ok", compact_every: int = COMPACT_EVERY):
        self.ok = ok
        order = newest("thoi_diem", "thoi_gian_xu_ly")
        self.results = Ledger(spark, f"{root}/results", RESULTS, RESULT_KEY, order, compact_every)
        self.runs = Ledger(spark, f"{root}/runs", _SUMS, RUN_KEY, _run_sums, compact_every)

    def _counted(self, rows: DataFrame, sign: int) -> DataFrame:
        """What results that stand (1) or go (-1) add to their runs."""
        seconds = F.coalesce(F.col("thoi_gian_xu_ly").cast("decimal(18,6)"), F.lit(0))
        return rows.select(
            *RUN_KEY,
            F.lit(sign).cast("long").alias("so_url"),
            (F.coalesce(F.col("trang_thai") == self.ok, F.lit(False)).cast("long") * sign).alias("so_trang_ok"),
            F.lit(0).cast("decimal(28,6)").alias("tong_thoi_gian"),
            (seconds * sign).cast("decimal(28,6)").alias("thoi_gian_xu_ly"),
            F.lit(None).cast("timestamp").alias("thoi_diem"),
        )

    def write_batch(self, batch: DataFrame, batch_id: int) -> None:
        complete = F.lit(True)
        for key in RESULT_KEY:
            complete = complete & F.col(key).isNotNull()
        rows = batch.select(*RESULTS.names).filter(complete).withColumn("batch", F.lit(batch_id).cast("long"))
        came = self.results.merge(rows, RESULT_KEY)
        earlier = self.results.before(batch_id)
        stood = earlier.join(came.select(*RESULT_KEY), RESULT_KEY, "left_semi")
        stands = self.results.merge(came.unionByName(stood), RESULT_KEY)
        replacing = stands.filter(F.col("batch") == batch_id)
        replaced = stood.join(replacing.select(*RESULT_KEY), RESULT_KEY, "left_semi")
        tried = rows.groupBy(*RUN_KEY).agg(
            F.coalesce(F.sum(F.col("thoi_gian_xu_ly").cast("decimal(18,6)")), F.lit(0)).cast("decimal(28,6)").alias("tong_thoi_gian"),
            F.max("thoi_diem").alias("thoi_diem"),
        )
        none = F.lit(0).cast("long")
        tries = tried.select(
            *RUN_KEY, none.alias("so_url"), none.alias("so_trang_ok"), "tong_thoi_gian",
            F.lit(0).cast("decimal(28,6)").alias("thoi_gian_xu_ly"), "thoi_diem",
        )
        changes = self._counted(replacing, 1).unionByName(self._counted(replaced, -1)).unionByName(tries)
        self.runs.write_batch(changes, batch_id)
        self.results.write_batch(batch, batch_id)

    def drain(self, stream: DataFrame) -> None:
        """Take in all results that ``stream`` holds now."""
        query = (
            stream.writeStream.foreachBatch(self.write_batch)
            .option("checkpointLocation", f"{self.runs.root}/checkpoint")
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()

    def current(self) -> DataFrame:
        """One row per run, under the fixed columns."""
        sums = self.runs.current().withColumn("ram_dinh_mb", F.lit(None).cast("double"))
        return sums.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in RUNS.fields])
