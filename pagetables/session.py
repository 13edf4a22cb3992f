"""Session defaults and the shared folder used to cut lineage."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Every setting here can be overridden by spark-submit or the cluster defaults.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, **extra: str) -> SparkSession:
    """A local session for tests and the bench; clusters bring their own."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName("pagetables")
    settings = {**DEFAULTS, "spark.sql.shuffle.partitions": str(shuffle_partitions), **extra}
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


_local_dirs: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach.

    It is the one the cluster names in ``spark.checkpoint.dir``. Only a local
    master may go without: there a temporary folder does, since driver and
    executors are one process.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    if context.applicationId not in _local_dirs:
        _local_dirs[context.applicationId] = tempfile.mkdtemp(prefix="pagetables-")
    return _local_dirs[context.applicationId]


def fresh_path(spark: SparkSession, label: str) -> str:
    """A path under the shared folder that nothing has written to yet."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def exists(spark: SparkSession, path: str) -> bool:
    """Whether there is anything at ``path``, on whatever file system it names."""
    jvm = spark.sparkContext._jvm
    place = jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(place)


def children(spark: SparkSession, path: str) -> list[str]:
    """Names of what lies in a folder; none if it is not there."""
    if not exists(spark, path):
        return []
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    system = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return [status.getPath().getName() for status in system.listStatus(place)]


def remove(spark: SparkSession, path: str) -> None:
    """Remove a folder and all in it, if it is there."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


# Whether the shuffle files of a query are removed when it ends.
_FREES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def materialize(df: DataFrame, label: str, path: str | None = None, frees: bool = False) -> DataFrame:
    """Write ``df`` to a fresh Parquet table and read it back. A caller that removes the
    table again names the ``path``, one of ``fresh_path``. With ``frees`` the shuffle files of
    the write go as soon as it ends, not when the driver next collects its garbage.

    Unlike a cached plan, the written table survives the loss of executors, and
    later readers can prune its columns.
    """
    spark = df.sparkSession
    path = path or fresh_path(spark, label)
    before = spark.conf.get(_FREES, None)
    if frees:
        spark.conf.set(_FREES, "true")
    try:
        df.write.parquet(path)
    finally:
        if frees and before is None:
            spark.conf.unset(_FREES)
        elif frees:
            spark.conf.set(_FREES, before)
    return spark.read.schema(df.schema).parquet(path)
