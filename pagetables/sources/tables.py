"""Tables and responses as inputs."""

from __future__ import annotations

from functools import cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagetables.functions.state import API_HINT, is_json


@cache
def _schema(spark: SparkSession, path: str) -> T.StructType:
    return spark.read.parquet(path).schema


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A given table; its schema is read from the files once per session."""
    path = f"{folder.rstrip('/')}/{name}.parquet"
    return spark.read.schema(_schema(spark, path)).parquet(path)


def create_if_absent(spark: SparkSession, name: str, schema: T.StructType, path: str) -> DataFrame:
    """Create an empty Parquet table; one of that name is left as it is, even if
    its schema differs."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet LOCATION '{path}'")
    return spark.table(name)


def api_responses(
    responses: DataFrame, url: str = "url", body: str = "body", hint: str = API_HINT
) -> DataFrame:
    """Responses of the listing API; those that are not JSON are left to ``response_rejects``."""
    return responses.filter(F.col(url).contains(hint)).filter(is_json(F.col(body)))


def response_rejects(
    responses: DataFrame, url: str = "url", body: str = "body", hint: str = API_HINT
) -> DataFrame:
    """Responses of the listing API without usable JSON, with the ``reason``.

    With ``api_responses`` these are all responses that carry the hint.
    """
    hinted = responses.filter(F.col(url).contains(hint))
    reason = F.when(F.col(body).isNull(), F.lit("no body")).otherwise(F.lit("not JSON"))
    return hinted.filter(~is_json(F.col(body))).withColumn("reason", reason)


def stream_table(
    spark: SparkSession, folder: str, name: str, schema: T.StructType, files_per_batch: int = 64
) -> DataFrame:
    """A table's files as a stream, a bounded number per micro-batch."""
    return (
        spark.readStream.schema(schema)
        .option("pathGlobFilter", f"{name}.parquet")
        .option("maxFilesPerTrigger", str(files_per_batch))
        .parquet(folder)
    )
