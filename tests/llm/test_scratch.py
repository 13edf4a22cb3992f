"""What the operators leave on disk while they run."""

import random
import time

import pytest

pytest.importorskip("pagetables.llm")

from pyspark.sql import functions as F  # noqa: E402

from pagetables.llm import span_dedup  # noqa: E402
from pagetables.session import materialize  # noqa: E402

SETTING = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@pytest.fixture(autouse=True)
def setting_off(spark):
    held = spark.conf.get(SETTING, None)
    spark.conf.set(SETTING, "false")
    yield
    if held is None:
        spark.conf.unset(SETTING)
    else:
        spark.conf.set(SETTING, held)


def _shuffle_files(spark):
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {f.getName(): f.length() for f in (files.apply(i) for i in range(files.size())) if "shuffle_" in f.getName()}


def _left(spark, before, most):
    """Bytes of new shuffle files, which go shortly after a query's end."""
    for _ in range(50):
        left = sum(n for name, n in _shuffle_files(spark).items() if name not in before)
        if left <= most:
            break
        time.sleep(0.1)
    return left


def test_materialize_frees_shuffles(spark):
    before = _shuffle_files(spark)
    rows = spark.range(10_000).groupBy((F.col("id") % 100).alias("k")).count()
    out = materialize(rows, "freed", frees=True)
    assert _left(spark, before, 0) == 0
    assert spark.conf.get(SETTING) == "false"
    assert sorted(map(tuple, out.collect())) == [(k, 100) for k in range(100)]


def test_materialize_resets_setting_after_failure(spark):
    with pytest.raises(Exception):
        materialize(spark.range(1).select(F.raise_error(F.lit("no")).cast("int").alias("x")), "failed", frees=True)
    assert spark.conf.get(SETTING) == "false"


def test_span_dedup_frees_shuffles(spark):
    rng = random.Random(5)
    passage = " ".join(f"p{i}" for i in range(120))
    rows = [(k, " ".join(f"w{rng.randrange(10**6)}" for _ in range(2000)) + (f" {passage}" if k % 3 == 0 else "")) for k in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    before = _shuffle_files(spark)
    found = span_dedup.dedup(docs)
    # What stays is of counts, and of the repartition under them.
    assert _left(spark, before, 100_000) <= 100_000
    kept = {r["doc_id"]: r["text"] for r in found.collect()}
    assert [k for k, t in kept.items() if passage in t] == [0] and len(kept) == 300
