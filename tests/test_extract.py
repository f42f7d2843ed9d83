"""S11 between runs: the stored mark, windows, late rows and repeated runs."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from hearth.session import scratch_path
from hearth.sources import extract

T = dt.datetime(2024, 3, 1)
H = dt.timedelta(hours=1)


def source(spark, rows):
    return spark.createDataFrame(rows, "id long, created_ts timestamp_ntz, modified_ts timestamp_ntz")


def job(spark, **settings):
    return extract.Extract(spark, scratch_path(spark, "extract"), "id", **settings)


def delivered(e):
    return sorted((r.run, r.id, r.version_ts) for r in e.delivered().collect())


@pytest.mark.parametrize("window, now, want", [
    ("LAST_N_DAYS:1", dt.datetime(2024, 3, 1, 15, 30), dt.datetime(2024, 2, 29)),
    ("last_n_days:0", dt.datetime(2024, 3, 1, 15, 30), dt.datetime(2024, 3, 1)),
    (" LAST_N_DAYS:30 ", dt.datetime(2024, 3, 1), dt.datetime(2024, 1, 31))])
def test_last_n_days(window, now, want):
    assert extract.last_n_days(window, now) == want


@pytest.mark.parametrize("window", ["LAST_N_DAYS", "LAST_N_DAYS:-1", "LAST_MONTH", ""])
def test_other_windows_are_refused(window):
    with pytest.raises(ValueError):
        extract.last_n_days(window, T)


def test_in_window(spark):
    rows = source(spark, [(1, T, T), (2, T, T - H), (3, T, T - 24 * H), (4, T, T - 24 * H - dt.timedelta(seconds=1))])
    got = rows.where(extract.in_window(rows.modified_ts, "LAST_N_DAYS:1", T + 5 * H)).collect()
    assert {r.id for r in got} == {1, 2, 3}


def test_each_change_once(spark):
    e = job(spark)
    assert e.mark() is None and e.delivered() is None
    e.run(source(spark, [(1, T, T), (2, T, T + H)]))
    assert e.mark() == T + H
    e.run(source(spark, [(1, T, T + 3 * H), (2, T, T + H), (3, T + 2 * H, T + 2 * H)]))
    e.run(source(spark, [(1, T, T + 3 * H), (2, T, T + H), (3, T + 2 * H, T + 2 * H)]))
    assert delivered(e) == [(0, 1, T), (0, 2, T + H), (1, 1, T + 3 * H), (1, 3, T + 2 * H)]
    assert e.mark() == T + 3 * H and e.runs() == [0, 1, 2]


def test_late_rows_within_the_overlap_are_delivered(spark):
    e = job(spark, overlap=2 * H)
    e.run(source(spark, [(1, T, T + 5 * H)]))
    e.run(source(spark, [(1, T, T + 5 * H), (2, T, T + 4 * H), (3, T, T + 2 * H)]))
    assert delivered(e) == [(0, 1, T + 5 * H), (1, 2, T + 4 * H)]     # 3 came later than the overlap allows


def test_a_missed_day_loses_nothing(spark):
    e = job(spark, window="LAST_N_DAYS:1")
    e.run(source(spark, [(1, T, T)]), T + H)
    day = 24 * H
    e.run(source(spark, [(1, T, T), (2, T + 2 * day, T + 2 * day), (3, T + 6 * day, T + 6 * day)]), T + 6 * day + H)
    assert delivered(e) == [(0, 1, T), (1, 2, T + 2 * day), (1, 3, T + 6 * day)]


def test_a_run_that_died_before_its_mark_is_run_again(spark):
    e = job(spark)
    e.run(source(spark, [(1, T, T)]))
    source(spark, [(9, T, T)]).withColumn("version_ts", F.col("modified_ts")).write.parquet(f"{e.root}/run=1/rows")
    assert e.runs() == [0]
    assert e.run(source(spark, [(1, T, T), (2, T + H, T + H)])) == 1
    assert delivered(e) == [(0, 1, T), (1, 2, T + H)]


def test_nothing_new_and_empty_sources(spark):
    e = job(spark)
    e.run(source(spark, []))
    assert e.mark() is None and delivered(e) == []
    e.run(source(spark, [(1, T, T)]))
    e.run(source(spark, []))
    assert e.mark() == T and delivered(e) == [(1, 1, T)]


def test_random_growing_table(spark):
    """Any number of runs over a table that only grows and changes forward delivers each version seen once."""
    rng = random.Random(2)
    e, table, seen = job(spark, overlap=3 * H), {}, set()
    now = T
    for _ in range(4):
        for _ in range(12):
            now += dt.timedelta(minutes=rng.randrange(1, 50))
            i = rng.randrange(20)
            table[i] = (table.get(i, (now,))[0], now)
        seen |= {(i, max(v)) for i, v in table.items()}
        e.run(source(spark, [(i, c, m) for i, (c, m) in table.items()]))
    got = [(i, v) for _, i, v in delivered(e)]
    assert len(got) == len(set(got)) and set(got) == seen
