"""Streams into raw and staging (T1): landing files, or saved pages by their cursor.

Each micro-batch is one load run and one validate run, whose ids are made of
the streaming query's id (kept in its checkpoint) and the epoch. A replayed
epoch is therefore the same run: what the ledger shows as finished is not run
again, and what a crash left unfinished is repeated under its id. Repeating is
harmless: the insert-only merge into raw skips keys that are there, and
validation reads only raw rows that are not in staging yet. The cursor
watermark of a batch extract still comes from raw.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.plans import stages
from tidemark.plans.store import Store
from tidemark.sources import saved_pages
from tidemark.spec import SourceSpec


def epoch_run_ids(batch: DataFrame, epoch_id: int) -> tuple[str, str]:
    """Ids of an epoch's load run and validate run: the query's id lives in its checkpoint, so a restart makes the same ones."""
    query = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId") or "stream"
    return f"{query}-{epoch_id}-load", f"{query}-{epoch_id}-validate"


def finished(store: Store, run_id: str) -> bool:
    """Whether the ledger shows the run as done (a run that policy failed has done its work too)."""
    run = stages.runs(store).filter(F.col("run_id") == run_id).select("status").first()
    return run is not None and run["status"] != "running"


def micro_batch(
    store: Store, spec: SourceSpec, validate: bool = True, incremental: bool = True, lines: Callable[[DataFrame], DataFrame] | None = None
):
    """The ``foreachBatch`` function: load the batch's lines, then validate.

    Each micro-batch is one load run, so the incremental validate only reads
    that run's raw partition plus the carried-over pending keys. ``lines`` makes
    payloads of a batch (default: its non-empty text lines).
    """

    def process(batch: DataFrame, epoch_id: int) -> None:
        load_id, validate_id = epoch_run_ids(batch, epoch_id)
        payloads = lines(batch) if lines else batch.filter(F.col("value") != "").select(F.col("value").alias("payload"))
        if not finished(store, load_id):
            stages.load_raw(store, spec, payloads, run_id=load_id)
        if validate and not finished(store, validate_id):
            stages.validate(store, spec, run_id=validate_id, incremental=incremental)

    return process


def start_pages_stream(
    store: Store, spec: SourceSpec, path: str, checkpoint_location: str | None = None, starting_cursor: int = 0, processing_time: str | None = None, incremental: bool = True
) -> StreamingQuery:
    """Stream saved pages past ``starting_cursor`` into raw and staging; offsets are cursors (see ``sources.saved_pages``)."""
    spark = store.spark
    saved_pages.register(spark)
    pages = spark.readStream.format(saved_pages.FORMAT).option("path", path).option("startingCursor", str(starting_cursor)).load()
    step = micro_batch(store, spec, incremental=incremental, lines=lambda batch: saved_pages.unwrap_pages(batch.select("value")))
    writer = pages.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint_location or f"{store.root}/_streams/{spec.name}-pages")
    return (writer.trigger(processingTime=processing_time) if processing_time else writer).start()


def start_landing_stream(
    store: Store,
    spec: SourceSpec,
    landing_dir: str,
    checkpoint_location: str | None = None,
    available_now: bool = True,
    processing_time: str | None = None,
    max_files_per_trigger: int | None = None,
    validate: bool = True,
    incremental: bool = True,
) -> StreamingQuery:
    """Start the stream over ``landing_dir`` (recursively, so every run directory counts).

    ``available_now`` processes everything present and stops (a catch-up
    run); otherwise the stream triggers every ``processing_time``. The
    checkpoint defaults to ``<store root>/_streams/<source>`` (shared storage).
    """
    spark = store.spark
    reader = spark.readStream.format("text").option("recursiveFileLookup", "true")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    lines = reader.load(landing_dir)
    writer = (
        lines.writeStream.foreachBatch(micro_batch(store, spec, validate, incremental))
        .option("checkpointLocation", checkpoint_location or f"{store.root}/_streams/{spec.name}")
    )
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    return writer.start()
