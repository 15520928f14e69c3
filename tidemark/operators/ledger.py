"""Run ledger as append-only events, folded to one row per run, plus reports.

A run writes a ``start`` event before any work and a ``finish`` event (and,
under the ``fail`` reject policy, a later ``failed`` event) when done. Nothing
is updated in place; the current state of a run is its latest event.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.time import whole_seconds_between

RUN_EVENT_SCHEMA = T.StructType(
    [
        T.StructField("run_id", T.StringType(), False),
        T.StructField("source", T.StringType(), False),
        T.StructField("stage", T.StringType(), False),
        T.StructField("event", T.StringType(), False),
        T.StructField("event_seq", T.IntegerType(), False),
        T.StructField("event_at", T.TimestampType(), False),
        T.StructField("status", T.StringType(), False),
        T.StructField("rows_read", T.LongType(), True),
        T.StructField("rows_written", T.LongType(), True),
        T.StructField("rows_rejected", T.LongType(), True),
        T.StructField("rows_skipped", T.LongType(), True),
        T.StructField("watermark_before", T.LongType(), True),
        T.StructField("watermark_after", T.LongType(), True),
        T.StructField("error", T.StringType(), True),
    ]
)

REJECT_SCHEMA = T.StructType(
    [
        T.StructField("run_id", T.StringType(), False),
        T.StructField("source", T.StringType(), False),
        T.StructField("raw_payload", T.StringType(), False),
        T.StructField("reason", T.StringType(), False),
        T.StructField("rejected_at", T.TimestampType(), False),
    ]
)

_STATE_COLS = (
    "status",
    "rows_read",
    "rows_written",
    "rows_rejected",
    "rows_skipped",
    "watermark_before",
    "watermark_after",
    "error",
)


def run_event(
    spark: SparkSession,
    *,
    run_id: str,
    source: str,
    stage: str,
    event: str,
    event_seq: int,
    at: dt.datetime,
    status: str,
    rows_read: int | None = 0,
    rows_written: int | None = 0,
    rows_rejected: int | None = 0,
    rows_skipped: int | None = 0,
    watermark_before: int | None = None,
    watermark_after: int | None = None,
    error: str | None = None,
) -> DataFrame:
    """A one-row ledger event (a run's own bookkeeping, not data)."""
    row = (
        run_id, source, stage, event, event_seq, at, status, rows_read, rows_written,
        rows_rejected, rows_skipped, watermark_before, watermark_after, error,
    )
    return spark.createDataFrame([row], RUN_EVENT_SCHEMA)


def fold_runs(events: DataFrame) -> DataFrame:
    """Current state per run: the latest event's status and counters, start time of the first.

    ``max(struct(event_seq, ...))`` is an aggregate, so it combines map-side;
    ``ended_at`` is NULL while the latest event is the start.
    """
    latest = F.max(F.struct(F.col("event_seq"), F.col("event_at"), F.col("event"), *[F.col(c) for c in _STATE_COLS]))
    folded = events.groupBy("run_id", "source", "stage").agg(
        F.min(F.when(F.col("event") == "start", F.col("event_at"))).alias("started_at"),
        latest.alias("__l"),
    )
    return folded.select(
        "run_id",
        "source",
        "stage",
        "started_at",
        F.when(F.col("__l.event") != "start", F.col("__l.event_at")).alias("ended_at"),
        *[F.col(f"__l.{c}").alias(c) for c in _STATE_COLS],
    )


def reject_rate(read: Column, rejected: Column) -> Column:
    return (rejected.cast("double") / F.nullif(read, F.lit(0)).cast("double")).alias("reject_rate")


def duration_seconds(started: Column, ended: Column) -> Column:
    """Run duration in seconds (double, microsecond precision); NULL while running."""
    return ((F.unix_micros(ended) - F.unix_micros(started)) / F.lit(1_000_000.0)).alias("duration_seconds")


def run_history(runs: DataFrame) -> DataFrame:
    """Every run with reject rate and duration, newest first (run_id breaks ties)."""
    return runs.select(
        "run_id",
        "source",
        "stage",
        "status",
        "rows_read",
        "rows_written",
        "rows_rejected",
        reject_rate(F.col("rows_read"), F.col("rows_rejected")),
        "started_at",
        "ended_at",
        duration_seconds(F.col("started_at"), F.col("ended_at")),
    ).orderBy(F.col("started_at").desc(), F.col("run_id").desc())


def recent_runs(runs: DataFrame, limit: int = 20) -> DataFrame:
    """The latest ``limit`` runs by start time (a top-k: one partial top-k per task)."""
    return runs.orderBy(F.col("started_at").desc(), F.col("run_id").desc()).limit(limit)


def latest_run_id(runs: DataFrame, stage: str, source: str | None = None) -> DataFrame:
    """One row ``run_id`` of the newest run of ``stage`` (NULL when there is none)."""
    pick = runs.filter(F.col("stage") == stage)
    if source is not None:
        pick = pick.filter(F.col("source") == source)
    return pick.agg(F.max_by("run_id", F.struct("started_at", "run_id")).alias("run_id"))


def reject_reason_counts(rejects: DataFrame, runs: DataFrame, stage: str = "validate") -> DataFrame:
    """Reject reasons of the latest validate run with their counts.

    The run lookup is a scalar subquery (one value), so the rejects are only
    filtered, never joined or shuffled before the partial count.
    """
    latest = latest_run_id(runs, stage).scalar()
    return rejects.filter(F.col("run_id") == latest).groupBy("reason").agg(F.count(F.lit(1)).alias("n_rejects"))


def freshness(
    staging: DataFrame,
    as_of: dt.datetime,
    delivery_col: str = "delivery_start_utc",
    ingested_col: str = "ingested_at",
    source: str | None = None,
    source_col: str = "source",
) -> DataFrame:
    """Last ingest, last delivery, ingest lag and delivery horizon (seconds) at ``as_of``.

    With ``source`` given: exactly one row, NULLs when staging is empty. Without
    it: one row per value of ``source_col``.
    """
    now = F.lit(as_of).cast("timestamp")
    aggs = [F.max(ingested_col).alias("last_ingest"), F.max(delivery_col).alias("last_delivery")]
    if source is not None:
        out = staging.agg(*aggs).select(F.lit(source).alias("source"), "*")
    else:
        out = staging.groupBy(F.col(source_col).alias("source")).agg(*aggs)
    return out.select(
        "source",
        "last_ingest",
        "last_delivery",
        whole_seconds_between(now, F.col("last_ingest")).alias("ingest_lag_seconds"),
        whole_seconds_between(F.col("last_delivery"), now).alias("delivery_horizon_seconds"),
    )
