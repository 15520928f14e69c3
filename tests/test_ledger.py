"""Run ledger fold and reports."""

from __future__ import annotations

import datetime as dt

from tidemark.operators import ledger

T0 = dt.datetime(2026, 1, 1, 0, 0)


def _events(spark):
    ev = []
    for run_id, stage, start, finish in [
        ("r1", "validate", T0, ("success", 10, 8, 2)),
        ("r2", "validate", T0 + dt.timedelta(hours=1), ("failed", 5, 0, 5)),
        ("r3", "load_raw", T0 + dt.timedelta(hours=2), None),
    ]:
        ev.append(ledger.run_event(spark, run_id=run_id, source="s", stage=stage, event="start", event_seq=0, at=start, status="running"))
        if finish:
            status, read, written, rejected = finish
            ev.append(
                ledger.run_event(
                    spark, run_id=run_id, source="s", stage=stage, event="finish", event_seq=1,
                    at=start + dt.timedelta(seconds=90), status=status, rows_read=read, rows_written=written,
                    rows_rejected=rejected,
                )
            )
    out = ev[0]
    for e in ev[1:]:
        out = out.unionByName(e)
    return out


def test_fold_history_recent(spark):
    runs = ledger.fold_runs(_events(spark))
    hist = ledger.run_history(runs).collect()
    assert [r["run_id"] for r in hist] == ["r3", "r2", "r1"]
    assert hist[0]["status"] == "running" and hist[0]["ended_at"] is None and hist[0]["duration_seconds"] is None
    assert hist[2]["reject_rate"] == 0.2 and hist[2]["duration_seconds"] == 90.0
    assert [r["run_id"] for r in ledger.recent_runs(runs, 2).collect()] == ["r3", "r2"]
    assert ledger.latest_run_id(runs, "validate").first()["run_id"] == "r2"


def test_reject_reasons_of_latest_run(spark):
    runs = ledger.fold_runs(_events(spark))
    rejects = spark.createDataFrame(
        [("r1", "s", "{}", "a: missing", T0), ("r2", "s", "{}", "b: blank", T0), ("r2", "s", "{}", "b: blank", T0)],
        ledger.REJECT_SCHEMA,
    )
    assert [tuple(r) for r in ledger.reject_reason_counts(rejects, runs).collect()] == [("b: blank", 2)]


def test_freshness_one_null_row_when_empty(spark):
    empty = spark.createDataFrame([], "ingested_at timestamp, delivery_start_utc timestamp")
    (row,) = ledger.freshness(empty, T0, source="s").collect()
    assert row["source"] == "s" and row["last_ingest"] is None and row["ingest_lag_seconds"] is None
    df = spark.createDataFrame([(T0, T0 + dt.timedelta(days=1))], "ingested_at timestamp, delivery_start_utc timestamp")
    (row,) = ledger.freshness(df, T0 + dt.timedelta(hours=1), source="s").collect()
    assert row["ingest_lag_seconds"] == 3600 and row["delivery_horizon_seconds"] == 82800
