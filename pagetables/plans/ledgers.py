"""Result summaries, and responses as input."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagetables.functions import state as S
from pagetables.operators import ledger
from pagetables.plans.registry import plan
from pagetables.sources.tables import api_responses, response_rejects, table

API = "https://api.example.com/"


def responses(events: DataFrame) -> DataFrame:
    """Events as API responses: the listing service answers purchases, views and
    errors; an error's body is no JSON. The slug names the user and the type."""
    service = F.when(
        F.col("event_type").isin("purchase", "view", "error"), F.lit(S.API_HINT)
    ).otherwise(F.lit("other-service"))
    slug = F.concat("event_type", F.lit("/"), "user_id", F.lit(".html"))
    body = F.to_json(F.struct(F.array(F.struct(slug.alias("slug"))).alias("items")))
    return events.select(
        "event_id",
        F.col("ts").cast("timestamp").alias("ts"),
        F.concat(F.lit(API), service, F.lit("/items?user="), "user_id").alias("url"),
        F.when(F.col("event_type") == "error", F.lit("<html>502</html>")).otherwise(body).alias("body"),
    )


@plan(f"""
select event_id, '{API}search-product-service/items?user=' || user_id as url,
       event_type || '/' || user_id || '.html' as slug
from events where event_type in ('purchase', 'view')
""")
def api_response_filter(spark: SparkSession, folder: str) -> DataFrame:
    kept = api_responses(responses(table(spark, folder, "events")))
    return kept.select("event_id", "url", F.explode(S.recursive_slugs(F.col("body"))).alias("slug"))


@plan(f"""
select event_id, '{API}search-product-service/items?user=' || user_id as url, 'not JSON' as reason
from events where event_type = 'error'
""")
def response_reject_rows(spark: SparkSession, folder: str) -> DataFrame:
    rejects = response_rejects(responses(table(spark, folder, "events")))
    return rejects.select("event_id", "url", "reason")


@plan("""
select count(*) as rows, count(*) filter (event_type <> 'error') as ok_rows from events
""")
def ok_summary(spark: SparkSession, folder: str) -> DataFrame:
    error = F.when(F.col("event_type") == "error", F.col("props"))
    return ledger.ok_summary(table(spark, folder, "events").select(error.alias("error")))


@plan("""
select 'tool ' || (cast(json_extract(props, '$.k') as bigint) // 25) as tool, cast(user_id % 10 as integer) as run,
  count(*) as pages, count(*) filter (event_type <> 'error') as ok_pages,
  cast(sum(cast(value as decimal(18,2))) as double) as busy_s,
  date_diff('microsecond', min(ts), max(ts)) / 1000000.0::double as elapsed_s,
  max(value) as peak_mb, max(ts) as finished_at
from events group by all
""")
def run_ledger(spark: SparkSession, folder: str) -> DataFrame:
    """Events as crawl results of four tools in ten runs."""
    k = S.json_path(F.col("props"), "$.k", "bigint")
    results = table(spark, folder, "events").select(
        "ts", "value", "event_type",
        F.concat(F.lit("tool "), F.floor(k / 25).cast("string")).alias("tool"),
        (F.col("user_id") % 10).cast("int").alias("run"),
    )
    return ledger.run_ledger(
        results,
        ok=F.col("event_type") != "error",
        seconds=F.col("value"),
        at=F.col("ts"),
        memory_mb=F.col("value"),
    )
