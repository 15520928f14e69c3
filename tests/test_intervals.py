"""Runs of consecutive numbers and the gaps between them, against plain Python."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators import intervals
from tidemark.plans import stages
from tidemark.plans.store import Store
from tidemark.sources.feeds import auction_feed
from tidemark.specs import auction_spec
from tests.conftest import SF_SMALL


def frame(spark, numbers):
    return spark.createDataFrame([(n,) for n in numbers], "c long")


def brute_gaps(numbers):
    x = sorted({n for n in numbers if n is not None})
    return [(a + 1, b - 1) for a, b in zip(x, x[1:], strict=False) if b > a + 1]


def got(df):
    return sorted((r["first_missing"], r["last_missing"]) for r in df.collect())


CASES = [
    [],
    [5],
    [None, 3, 3, 4, None],
    [-(1 << 63), (1 << 63) - 1, 0],
    [65535, 65536, 65537, 131071, 131073],
    list(range(-70_000, 70_000, 1)) + [200_000],
    [1 << 16, 1 << 28, (1 << 28) + 1, 1 << 40, 1 << 52, (1 << 52) - 1],
]


@pytest.mark.parametrize("numbers", CASES, ids=range(len(CASES)))
def test_gaps_equal_brute_force(spark, numbers):
    runs = intervals.runs_of(frame(spark, numbers), "c")
    want = brute_gaps(numbers)
    assert got(intervals.gaps(runs)) == want
    r = intervals.runs_profile(runs).first()
    x = {n for n in numbers if n is not None}
    assert r["n_distinct"] == len(x)
    if 0 < len(x) and max(x) - min(x) < 1 << 62:
        assert (r["min_cursor"], r["max_cursor"], r["gaps"]) == (min(x), max(x), max(x) - min(x) + 1 - len(x))


def test_merging_parts_equals_all_at_once(spark):
    rng = random.Random(2)
    numbers = [rng.randrange(400_000) for _ in range(60_000)]
    cuts = [numbers[:20_000], numbers[15_000:45_000], numbers[40_000:]]
    runs = None
    for part in cuts:
        new = intervals.runs_of(frame(spark, part), "c")
        runs = new if runs is None else intervals.merge_runs(runs.unionByName(new))
    whole = intervals.runs_of(frame(spark, numbers), "c")
    assert sorted(map(tuple, runs.collect())) == sorted(map(tuple, whole.collect()))
    assert got(intervals.gaps(runs)) == brute_gaps(numbers)


def test_a_load_is_merged_without_reading_the_rest_of_raw(spark, scratch):
    store, spec = Store(spark, f"{scratch}/t"), auction_spec(reject_policy="quarantine")
    events = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    for lo, hi in ((0, 300), (500, 700), (250, 600)):
        run = stages.load_raw(store, spec, auction_feed(events.filter(F.col("event_id").between(lo, hi - 1))).select("payload"))
        fresh = stages.untracked_cursors(store, spec)
        files = [r["f"] for r in fresh.selectExpr("_metadata.file_path AS f").distinct().collect()]
        assert files and all(f"extract_run_id={run.run_id}/" in f for f in files)
        stages.track_cursors(store, spec)
    raw = [r[0] for r in stages.read_raw(store, spec).select("_id").collect()]
    assert got(stages.cursor_gaps(store, spec)) == brute_gaps(raw)
    before = store.pointers(stages.cursor_runs_table(spec))
    assert stages.track_cursors(store, spec) == 0 and store.pointers(stages.cursor_runs_table(spec)) == before


def test_parts_of_the_state_that_a_load_does_not_touch_stay(spark, scratch):
    import json

    store, spec = Store(spark, f"{scratch}/t"), auction_spec(reject_policy="quarantine")
    for cursor in (5, (1 << 28) + 3, 7):
        stages.load_raw(store, spec, spark.createDataFrame([(json.dumps({"_id": cursor, "unitResultID": f"k{cursor}"}),)], "payload string"))
        before = dict(store.pointers(stages.cursor_runs_table(spec)))
        stages.track_cursors(store, spec)
    after = store.pointers(stages.cursor_runs_table(spec))
    assert set(after) == {"0", "1"} and after["1"] == before["1"] and after["0"] != before["0"]
    assert got(stages.cursor_gaps(store, spec)) == [(6, 6), (8, (1 << 28) + 2)]
