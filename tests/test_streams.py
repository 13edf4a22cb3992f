"""Streaming jobs against their batch twins."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagetables.functions.state import API_HINT
from pagetables.session import children, fresh_path
from pagetables.streaming import jobs

LEDGER = T.StructType(
    [T.StructField("k", T.StringType()), T.StructField("at", T.LongType()), T.StructField("v", T.StringType())]
)


def as_stream(spark, frames):
    """Each frame becomes one file, read one file per micro-batch."""
    path = fresh_path(spark, "in")
    for frame in frames:
        frame.coalesce(1).write.mode("append").parquet(path)
    return spark.readStream.schema(frames[0].schema).option("maxFilesPerTrigger", "1").parquet(path)


def test_ledger_keeps_the_newest_and_replays(spark):
    first = spark.createDataFrame([("a", 1, "x"), ("a", 3, "y"), ("b", 1, "z"), (None, 9, "no")], LEDGER)
    second = spark.createDataFrame([("a", 2, "late"), ("b", 5, None), ("c", 1, "c")], LEDGER)
    book = jobs.Ledger(spark, fresh_path(spark, "book"), LEDGER, ["k"], jobs.newest("at"))
    assert (book.current().count(), book.rejects().count()) == (0, 0)
    book.drain(as_stream(spark, [first, second]))
    expected = [("a", 3, "y"), ("b", 5, None), ("c", 1, "c")]
    assert sorted(map(tuple, book.current().collect())) == expected
    book.write_batch(second, 1)
    book.write_batch(second, 1)
    assert sorted(map(tuple, book.current().collect())) == expected
    assert [(r.at, r.v, r.batch) for r in book.rejects().collect()] == [(9, "no", 0)]


def test_a_ledger_keeps_two_snapshots(spark):
    root = fresh_path(spark, "book")
    book = jobs.Ledger(spark, root, LEDGER, ["k"], jobs.newest("at"), compact_every=2)
    days = [spark.createDataFrame([(f"k{n % 3}", n, str(n)), ("a", n, str(n))], LEDGER) for n in range(9)]
    for n, day in enumerate(days):
        book.write_batch(day, n)
        # The batch comes again, and once more after a restart.
        jobs.Ledger(spark, root, LEDGER, ["k"], jobs.newest("at"), compact_every=2).write_batch(day, n)
    assert sorted(map(tuple, book.current().collect())) == [("a", 8, "8"), ("k0", 6, "6"), ("k1", 7, "7"), ("k2", 8, "8")]
    assert sorted(children(spark, f"{root}/snapshots")) == ["upto=5", "upto=7"] == sorted(children(spark, f"{root}/marks"))
    assert sorted(children(spark, f"{root}/changes")) == ["batch=6", "batch=7", "batch=8"]
    assert {(r.k, r.at) for r in book.before(8).collect()} == {("a", 7), ("k0", 6), ("k1", 7), ("k2", 5)}


@pytest.mark.parametrize("every", [2])
def test_ledgers_resume_and_compact(spark, every):
    """Each job is stopped and started anew on its folder, with more input."""
    source, root = fresh_path(spark, "in"), fresh_path(spark, "book")
    days = [[("a", 1, "x"), ("b", 1, "y")], [("a", 2, "z")], [("b", 0, "old"), ("c", 1, "w")]]
    for n, day in enumerate(days):
        spark.createDataFrame(day, LEDGER).coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(LEDGER).parquet(source)
        jobs.Ledger(spark, f"{root}/a", LEDGER, ["k"], jobs.newest("at"), every).drain(stream)
        sums = T.StructType([LEDGER["k"], LEDGER["at"]])
        jobs.Ledger(spark, f"{root}/b", sums, ["k"], jobs.totals, every).drain(stream)
        jobs.Ledger(spark, f"{root}/c", T.StructType([LEDGER["k"]]), ["k"], jobs.newest(), every).drain(stream)
        assert jobs.run_to_table(stream, f"{root}/d").count() == sum(map(len, days[: n + 1]))
    book = jobs.Ledger(spark, f"{root}/a", LEDGER, ["k"], jobs.newest("at"), every)
    assert book.last_snapshot() == 1
    assert sorted(map(tuple, book.current().collect())) == [("a", 2, "z"), ("b", 1, "y"), ("c", 1, "w")]
    total = jobs.Ledger(spark, f"{root}/b", sums, ["k"], jobs.totals, every)
    assert sorted(map(tuple, total.current().collect())) == [("a", 3), ("b", 1), ("c", 1)]
    links = jobs.Ledger(spark, f"{root}/c", T.StructType([LEDGER["k"]]), ["k"], jobs.newest(), every)
    assert sorted(r.k for r in links.current().collect()) == ["a", "b", "c"]


def test_harvest_over_batches(spark):
    def answers(*slugs):
        body = '{"items":[' + ",".join(f'{{"slug":"{s}"}}' for s in slugs) + "]}"
        at = dt.datetime(2024, 1, 1)
        rows = [(at, f"https://x/{API_HINT}/1", body), (at, "https://x/other", body.replace("a", "q")), (at, f"https://x/{API_HINT}/2", "oops")]
        return spark.createDataFrame(rows, "ts timestamp, url string, body string")

    frames = [answers("a.html", "/b.html", "c"), answers("b.html", "d.html")]
    found = jobs.run_to_table(jobs.harvest(as_stream(spark, frames), F.lit("https://h"), API_HINT), fresh_path(spark, "harvest"))
    assert sorted(r.url for r in found.collect()) == ["https://h/a.html", "https://h/b.html", "https://h/d.html"]
    bounded = jobs.harvest(as_stream(spark, frames), F.lit("https://h"), API_HINT, within="1 hour")
    assert jobs.run_to_table(bounded, fresh_path(spark, "harvest")).count() == 3


def test_summary_counts_open_windows_and_late_rows(spark):
    def rows(*minutes):
        data = [(dt.datetime(2024, 1, 1) + dt.timedelta(minutes=m), "t", float(m % 2)) for m in minutes]
        return spark.createDataFrame(data, "at timestamp, tool string, value double")

    value = F.col("value")
    schema = jobs.run_summary(rows(1), "at", "tool", value > 0, value).schema
    book = jobs.Ledger(spark, fresh_path(spark, "summary"), schema, ["window_start", "tool"], jobs.totals)
    book.drain(
        as_stream(spark, [rows(1, 2, 59), rows(61, 62), rows(190), rows(3)]),
        lambda batch: jobs.run_summary(batch, "at", "tool", value > 0, value),
    )
    found = book.current().orderBy("window_start").collect()
    assert [(r.pages, r.ok_pages, float(r.busy_s)) for r in found] == [(4, 3, 3.0), (2, 1, 1.0), (1, 0, 0.0)]
