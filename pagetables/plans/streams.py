"""The streaming jobs, drained over the events table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagetables import schemas
from pagetables.plans.ledgers import responses
from pagetables.plans.registry import plan
from pagetables.session import fresh_path
from pagetables.sources import sinks
from pagetables.sources.tables import stream_table, table
from pagetables.streaming import jobs

SHOP = "https://shop.example.com"
LINK = T.StructType([T.StructField("url", T.StringType())])
SUMMARY = T.StructType(
    [
        T.StructField("window_start", T.TimestampType()),
        T.StructField("tool", T.StringType()),
        T.StructField("pages", T.LongType()),
        T.StructField("ok_pages", T.LongType()),
        T.StructField("busy_s", T.DecimalType(28, 2)),
    ]
)


def event_stream(spark: SparkSession, folder: str) -> DataFrame:
    return stream_table(spark, folder, "events", table(spark, folder, "events").schema)


@plan(f"""
select distinct '{SHOP}/' || event_type || '/' || user_id || '.html' as url
from events where event_type in ('purchase', 'view')
""")
def stream_harvest(spark: SparkSession, folder: str) -> DataFrame:
    seen = jobs.sightings(
        responses(event_stream(spark, folder)), F.lit(SHOP), "search-product-service"
    )
    links = jobs.Ledger(spark, fresh_path(spark, "harvest"), LINK, ["url"], jobs.newest())
    links.drain(seen)
    return links.current()


def event_results(spark: SparkSession, folder: str) -> DataFrame:
    """Events as results of crawls, under the 11 columns of the results ledger."""
    results = event_stream(spark, folder).select(
        F.col("event_type").alias("cong_cu"),
        (F.col("user_id") % 10).cast("int").alias("lan"),
        F.concat(F.lit("/u/"), "user_id").alias("url"),
        F.when(F.col("value") >= 50, "ok").otherwise("slow").alias("trang_thai"),
        F.floor("value").cast("bigint").alias("gia"),
        F.col("value").alias("thoi_gian_xu_ly"),
        F.col("ts").cast("timestamp").alias("thoi_diem"),
    )
    return sinks.fixed_columns(results, schemas.RESULTS)


@plan("""
with tries as (
  select event_type as cong_cu, cast(user_id % 10 as integer) as lan, user_id, value, ts,
    cast(value as decimal(18,6)) as seconds,
    row_number() over (partition by event_type, user_id order by ts desc, value desc) = 1 as stands
  from events)
select cong_cu, lan, count(*) filter (stands) as so_url, count(*) filter (stands and value >= 50) as so_trang_ok,
  cast(sum(seconds) as double) as tong_thoi_gian,
  cast(sum(seconds) filter (stands) as double) as thoi_gian_xu_ly, null::double as ram_dinh_mb,
  max(ts) as thoi_diem
from tries group by all
""")
def result_runs(spark: SparkSession, folder: str) -> DataFrame:
    """The run ledger, fed by results; a replaced result is taken out of its run."""
    ledger = jobs.RunLedger(spark, fresh_path(spark, "runs"))
    ledger.drain(event_results(spark, folder))
    return ledger.current().withColumn("thoi_diem", F.col("thoi_diem").cast("timestamp_ntz"))


@plan("""
select event_type as cong_cu, cast(user_id % 10 as integer) as lan, '/u/' || user_id as url,
  case when value >= 50 then 'ok' else 'slow' end as trang_thai, null::varchar as ten,
  cast(floor(value) as bigint) as gia, null::varchar as don_vi, null::varchar as thuong_hieu,
  null::varchar as so_dang_ky, value as thoi_gian_xu_ly, ts as thoi_diem
from events
qualify row_number() over (partition by event_type, user_id order by ts desc, value desc) = 1
""")
def stream_upsert(spark: SparkSession, folder: str) -> DataFrame:
    """The newest result of each tool, run and URL."""
    ledger = jobs.Ledger(
        spark, fresh_path(spark, "ledger"), schemas.RESULTS, schemas.RESULT_KEY,
        jobs.newest("thoi_diem", "thoi_gian_xu_ly"),
    )
    ledger.drain(event_results(spark, folder))
    return ledger.current().withColumn("thoi_diem", F.col("thoi_diem").cast("timestamp_ntz"))


@plan("""
select date_trunc('hour', ts) as window_start, event_type as tool, count(*) as pages,
  count(*) filter (value >= 50) as ok_pages, cast(sum(cast(value as decimal(18,2))) as double) as busy_s
from events group by all
""")
def stream_run_summary(spark: SparkSession, folder: str) -> DataFrame:
    """Sums of each micro-batch, merged: every window, open or late, is whole."""
    results = event_stream(spark, folder).select(
        F.col("ts").cast("timestamp").alias("at"), F.col("event_type").alias("tool"), "value"
    )
    windows = jobs.Ledger(
        spark, fresh_path(spark, "summary"), SUMMARY, ["window_start", "tool"], jobs.totals
    )
    value = F.col("value")
    windows.drain(results, lambda batch: jobs.run_summary(batch, "at", "tool", value >= 50, value))
    return windows.current().withColumns(
        {"window_start": F.col("window_start").cast("timestamp_ntz"), "busy_s": F.col("busy_s").cast("double")}
    )
