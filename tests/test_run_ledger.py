"""The run ledger fed by results: replaced results, late ones, replays, restarts."""

import datetime as dt
import random

from pagetables.schemas import RESULTS
from pagetables.session import fresh_path
from pagetables.streaming import jobs

START = dt.datetime(2024, 5, 1, tzinfo=dt.UTC)


def result(tool, run, url, status, seconds, minute):
    at = None if minute is None else START + dt.timedelta(minutes=minute)
    return (tool, run, url, status, "n", 1, "u", "b", "r", seconds, at)


def recount(rows):
    """All runs from all results, in the order they came."""
    standing, runs = {}, {}
    for row in rows:
        key = row[:3]
        if None in key:
            continue
        run = runs.setdefault(key[:2], [0, None])
        run[0] += row[9] or 0
        run[1] = max(filter(None, (run[1], row[10])), default=None)
        order = (row[10] is not None, row[10] or START, row[9] is not None, row[9] or 0)
        if key not in standing or standing[key][0] <= order:
            standing[key] = (order, row)
    found = []
    for key, (tries, latest) in runs.items():
        own = [row for k, (_, row) in standing.items() if k[:2] == key]
        busy = sum(row[9] or 0 for row in own)
        found.append((*key, len(own), sum(row[3] == "ok" for row in own), round(tries, 6), round(busy, 6), latest))
    return sorted(found)


def shown(book):
    rows = book.current().collect()
    assert all(r.ram_dinh_mb is None for r in rows)
    at = lambda r: None if r.thoi_diem is None else r.thoi_diem.replace(tzinfo=dt.UTC)
    return sorted(
        (r.cong_cu, r.lan, r.so_url, r.so_trang_ok, round(r.tong_thoi_gian, 6), round(r.thoi_gian_xu_ly, 6), at(r)) for r in rows
    )


def test_runs_equal_a_recount(spark):
    rnd = random.Random(11)
    days = [
        [result("a", 1, "u1", "ok", 1.5, 1), result("a", 1, "u2", "slow", 2.0, 2), result("b", 1, "u1", "ok", None, 3)],
        [result("a", 1, "u1", "slow", 4.0, 9), result("a", 1, "u2", "ok", 1.0, 1), result(None, 1, "u", "ok", 7.0, 1)],
        [result("a", 1, "u1", "ok", 0.5, 9), result("b", 1, "u1", "ok", 3.25, 3), result("b", 2, "u1", None, 1.0, None)],
    ]
    days += [
        [result(rnd.choice("ab"), rnd.randint(1, 2), f"u{rnd.randint(1, 5)}", rnd.choice(("ok", "no")), rnd.randint(1, 9) / 4, rnd.randint(0, 30)) for _ in range(12)]
        for _ in range(2)
    ]
    root = fresh_path(spark, "runs")
    for n, day in enumerate(days):
        # Each batch by a ledger of its own, as after a restart; every batch comes twice.
        book = jobs.RunLedger(spark, root, compact_every=2)
        frame = spark.createDataFrame(day, RESULTS)
        book.write_batch(frame, n)
        if n != 3:
            assert shown(book) == recount([r for d in days[: n + 1] for r in d])
        book.write_batch(frame, n)
    assert shown(book) == recount([r for d in days for r in d])
    assert book.results.rejects().count() == 1


def test_no_results(spark):
    book = jobs.RunLedger(spark, fresh_path(spark, "runs"))
    book.write_batch(spark.createDataFrame([], RESULTS), 0)
    assert book.current().count() == 0
