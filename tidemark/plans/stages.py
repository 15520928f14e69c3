"""Stages: extract, load_raw, validate, transform, and their compositions.

These are the only functions that write. Each opens a run in the ledger
before any work and closes it on success or failure. Data never comes back
to the driver; only scalars do (watermarks, counters, duplicate-group count).
Intermediate results that feed two writes are written as a Parquet table in
the shared folder named by ``spark.checkpoint.dir`` (see ``materialize``), so
they are computed once, survive executor loss, and are never recomputed after
a target they were derived from has changed.
"""

from __future__ import annotations

import datetime as dt
import logging
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators import checks, contract, ingest, intervals, ledger, marts, merge
from tidemark.functions.text import btrim_ws
from tidemark.plans import key_index
from tidemark.plans.store import CODEC, Store
from tidemark.session import apply_required_conf, delete_folder, ensure_checkpoint_dir, path_exists, shuffles_freed, work_folder
from tidemark.sources import landing, saved_pages, table
from tidemark.sources.footers import footer_watermark
from tidemark.sources.json_split import read_array_elements
from tidemark.spec import SourceSpec

log = logging.getLogger("tidemark")

RUN_EVENTS = "ops_run_events"
REJECTS = "ops_rejected_records"
DRIFT = "ops_schema_drift"
DRIFT_SCHEMA = T.StructType(
    [
        T.StructField("run_id", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("extra_key", T.StringType()),
        T.StructField("rows_with_key", T.LongType()),
        T.StructField("seen_at", T.TimestampType()),
    ]
)
RAW_PARTITION = "extract_run_id"  # raw is laid out by load run

LOADS_SCHEMA = T.StructType([T.StructField("load_run_id", T.StringType())])
STAGED_BY = "layout_run"  # staging is laid out by the validate run that inserted the rows
MERGED_SCHEMA = T.StructType([T.StructField("staging", T.StringType()), T.StructField("validate_run_id", T.StringType())])
TRANSFORMED_SCHEMA = T.StructType(
    [T.StructField("staging", T.StringType()), T.StructField("n_rows", T.LongType()), T.StructField("at", T.TimestampType())]
)

# A source: given the watermark (None on a cold start), the records past it as
# ``payload`` (JSON text) and ``cursor`` (the cursor where it counts toward the
# watermark: JSON integers only).
Fetch = Callable[[int | None], DataFrame]


class RejectsNotAllowed(RuntimeError):
    """A validate run whose policy allows no rejects has recorded some; the marts must not be built on it."""


@dataclass(frozen=True)
class StageResult:
    run_id: str
    stage: str
    rows_read: int = 0
    rows_written: int = 0
    rows_rejected: int = 0
    rows_skipped: int = 0
    watermark_before: int | None = None
    watermark_after: int | None = None
    path: str | None = None

    @property
    def rows_duplicate(self) -> int:
        return self.rows_read - self.rows_written - self.rows_rejected


def raw_table(spec: SourceSpec) -> str:
    return f"raw_{spec.name}"


def carry_table(spec: SourceSpec) -> str:
    """Raw (key, cursor) pairs an incremental validate left pending (rejects, duplicates)."""
    return f"ops_validate_carry_{spec.name}"


def transformed_table(spec: SourceSpec) -> str:
    """What of staging the marts were last built from: its version and row count."""
    return f"ops_transformed_{spec.name}"


def merged_runs_table(spec: SourceSpec) -> str:
    """Validate runs whose staging rows the marts hold, per version of staging."""
    return f"ops_merged_runs_{spec.name}"


def dim_state_table(spec: SourceSpec) -> str:
    """The dimension's aggregates over all staging rows merged so far, which new rows are merged into."""
    return f"ops_dim_state_{spec.name}"


def validated_loads_table(spec: SourceSpec) -> str:
    """Load runs whose raw partitions an incremental validate has read."""
    return f"ops_validated_loads_{spec.name}"


def read_raw(store: Store, spec: SourceSpec, parsed: bool = False) -> DataFrame | None:
    """raw with its declared schema (the load-run partition column stays a string).

    With ``parsed`` also the members of the contract from the parsed payload,
    where raw has it: Spark writes it shredded, so the scan reads the columns of
    these members and no text is parsed.
    """
    if not store.exists(raw_table(spec)):
        return None
    held = store.read(raw_table(spec)) if parsed else None
    if held is None or ingest.PARSED not in held.columns:
        return store.read(raw_table(spec), ingest.raw_schema(spec))
    return contract.parsed_members(store.read(raw_table(spec), ingest.raw_schema(spec, parsed=True)), spec.contract, ingest.PARSED)


def staging_table(spec: SourceSpec) -> str:
    return f"staging_{spec.name}"


def _now() -> dt.datetime:
    return dt.datetime.now(dt.UTC).replace(tzinfo=None)


class _Run:
    """Ledger bookkeeping of one stage run (start event now, finish event later)."""

    def __init__(self, store: Store, spec: SourceSpec, stage: str, run_id: str | None, watermark_before=None):
        self.store, self.spec, self.stage = store, spec, stage
        self.run_id = run_id or str(uuid.uuid4())
        self.watermark_before = watermark_before
        self.seq = 0
        self._event("start", "running", rows_read=0, rows_written=0, rows_rejected=0, rows_skipped=0)

    def _event(self, event: str, status: str, **counters) -> None:
        row = ledger.run_event(
            self.store.spark,
            run_id=self.run_id,
            source=self.spec.name,
            stage=self.stage,
            event=event,
            event_seq=self.seq,
            at=_now(),
            status=status,
            watermark_before=self.watermark_before,
            **counters,
        )
        self.store.append(RUN_EVENTS, row)
        self.seq += 1

    def success(self, result: StageResult) -> None:
        self._event(
            "finish", "success",
            rows_read=result.rows_read, rows_written=result.rows_written, rows_rejected=result.rows_rejected,
            rows_skipped=result.rows_skipped, watermark_after=result.watermark_after,
        )

    def failure(self, error: str, result: StageResult | None = None) -> None:
        counters = {}
        if result is not None:
            counters = dict(
                rows_read=result.rows_read, rows_written=result.rows_written,
                rows_rejected=result.rows_rejected, rows_skipped=result.rows_skipped,
                watermark_after=result.watermark_after,
            )
        else:
            counters = dict(rows_read=0, rows_written=0, rows_rejected=0, rows_skipped=0)
        self._event("finish" if result is None else "policy", "failed", error=error, **counters)


def _prepare(spark: SparkSession) -> None:
    apply_required_conf(spark)
    ensure_checkpoint_dir(spark)


def materialize(spark: SparkSession, df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the shared checkpoint folder and read it back (lineage cut).

    Unlike an RDD checkpoint, the input is computed by exactly one job, so
    observed counters are exact and nothing is recomputed later. The stage that
    asked for it removes it (``release``) once its results are written.
    """
    path = work_folder(spark, label)
    with shuffles_freed(df.sparkSession):
        df.write.option("compression", CODEC).parquet(path)
    return spark.read.parquet(path)


def release(spark: SparkSession, *frames: DataFrame | None) -> None:
    """Remove hand-over tables made by ``materialize``."""
    for frame in frames:
        if frame is not None:
            for folder in {f.rsplit("/", 1)[0] for f in frame.inputFiles()}:
                if "/tidemark/" in folder:
                    delete_folder(spark, folder)


def current_watermark(store: Store, spec: SourceSpec) -> int | None:
    """``MAX(cursor)`` of raw, from its files' footers; None when raw is missing or empty (cold start)."""
    cur = store.current(raw_table(spec))
    if cur is None or not path_exists(store.spark, cur[1]):
        return None
    return footer_watermark(store.spark, cur[1], spec.cursor, ingest.raw_schema(spec)).first()["watermark"]


# -- S12 --------------------------------------------------------------------------
def create_tables(store: Store, spec: SourceSpec) -> None:
    """Idempotent creation of the source's raw and staging tables and the ops tables."""
    store.create(raw_table(spec), ingest.raw_schema(spec), partitioned=True)
    store.create(staging_table(spec), ingest.staging_schema(spec), layout=STAGED_BY)
    store.create(RUN_EVENTS, ledger.RUN_EVENT_SCHEMA)
    store.create(REJECTS, ledger.REJECT_SCHEMA)
    store.create(DRIFT, DRIFT_SCHEMA)


# -- D1 ---------------------------------------------------------------------------
def extract(
    store: Store,
    spec: SourceSpec,
    fetch: Fetch,
    landing_root: str,
    run_id: str | None = None,
    limit: int | None = None,
    compression: str | None = "gzip",
) -> StageResult:
    """Records past the raw watermark -> one committed JSON-lines landing directory."""
    _prepare(store.spark)
    before = current_watermark(store, spec)
    run = _Run(store, spec, "extract", run_id, before)
    try:
        records = table.cap_rows(fetch(before), "cursor", limit)
        obs = Observation(f"extract_{run.run_id}")
        counted = records.observe(obs, F.count(F.lit(1)).alias("rows"), F.max("cursor").alias("max_cursor"))
        path = landing.landing_path(landing_root, spec.name, run.run_id)
        landing.write_landing(counted.select("payload"), path, compression)
        stats = obs.get
        seen = stats.get("max_cursor")
        after = before if seen is None else (seen if before is None else max(before, seen))
        result = StageResult(
            run.run_id, "extract", rows_read=stats["rows"], rows_written=stats["rows"],
            watermark_before=before, watermark_after=after, path=path,
        )
    except Exception as exc:
        run.failure(str(exc))
        raise
    run.success(result)
    return result


# -- D2 ---------------------------------------------------------------------------
def load_raw(
    store: Store,
    spec: SourceSpec,
    lines: DataFrame | str,
    run_id: str | None = None,
    as_of: dt.datetime | None = None,
) -> StageResult:
    """Landing lines -> insert-only merge into raw. Rows without key or cursor are skipped.

    A malformed line or uncastable cursor fails the stage before anything is
    appended (the append job aborts as a whole).
    """
    spark = store.spark
    _prepare(spark)
    run = _Run(store, spec, "load_raw", run_id)
    try:
        source = landing.read_landing(spark, lines) if isinstance(lines, str) else lines
        keyed = ingest.extract_keys(source, spec, parsed=True)
        obs = Observation(f"load_{run.run_id}")
        counted = keyed.observe(
            obs,
            F.count(F.when(ingest.loadable(keyed, spec), True)).alias("read"),
            F.count(F.when(~ingest.loadable(keyed, spec), True)).alias("skipped"),
        )
        batch = ingest.raw_batch(counted, spec, run.run_id, as_of or _now())
        deduped = materialize(
            spark, merge.first_wins(batch, [spec.business_key], [spec.cursor, "payload"], carried=[ingest.PARSED]), "load"
        )
        stats = obs.get
        raw = read_raw(store, spec)
        inserts = ingest.raw_inserts(deduped, raw, spec, deduplicated=True)
        wobs = Observation(f"load_w_{run.run_id}")
        store.append(
            raw_table(spec), inserts.observe(wobs, F.count(F.lit(1)).alias("written")), partition_by=[RAW_PARTITION]
        )
        result = StageResult(
            run.run_id, "load_raw", rows_read=stats["read"], rows_written=wobs.get["written"],
            rows_skipped=stats["skipped"],
        )
        release(spark, deduped)
    except Exception as exc:
        run.failure(str(exc))
        raise
    run.success(result)
    return result


# -- A10 --------------------------------------------------------------------------
RUNS_SCHEMA = T.StructType([T.StructField(c, T.LongType()) for c in ("rng", "first", "last")])


def cursor_runs_table(spec: SourceSpec) -> str:
    """Raw's cursors as runs of consecutive ones, published in parts of 2**28 cursors."""
    return f"ops_cursor_runs_{spec.name}"


def tracked_loads_table(spec: SourceSpec) -> str:
    return f"ops_tracked_loads_{spec.name}"


def _untracked_loads(store: Store, spec: SourceSpec) -> list[str]:
    """Load runs with a folder in raw (a listing, no file is read) whose cursors are not in the runs yet."""
    loads = [n.partition("=")[2] for n in store.layout(raw_table(spec)) if n.startswith(f"{RAW_PARTITION}=")]
    done = store.read(tracked_loads_table(spec), LOADS_SCHEMA)
    here = store.spark.createDataFrame([(x,) for x in loads], LOADS_SCHEMA)
    return sorted(r[0] for r in here.join(done, "load_run_id", "left_anti").collect())


def untracked_cursors(store: Store, spec: SourceSpec, loads: list[str] | None = None) -> DataFrame:
    """Cursors of the raw rows of loads that are not tracked yet: only their folders are read."""
    loads = _untracked_loads(store, spec) if loads is None else loads
    raw = store.read(raw_table(spec), ingest.raw_schema(spec))
    return raw.filter(F.col(RAW_PARTITION).isin(loads)).select(spec.cursor)


def track_cursors(store: Store, spec: SourceSpec) -> int:
    """Merge the cursors of new loads into the stored runs; returns how many loads were merged.

    The parts of the state that the new cursors fall into are read, merged and
    replaced; what was merged is published with them.
    """
    _prepare(store.spark)
    loads = _untracked_loads(store, spec)
    if not loads:
        return 0
    name = cursor_runs_table(spec)
    fresh = materialize(store.spark, intervals.runs_of(untracked_cursors(store, spec, loads), spec.cursor), "runs")
    part = F.shiftright("rng", intervals.GROUP_BITS).cast("string")
    touched = sorted(r[0] for r in fresh.select(part.alias("p")).distinct().collect())  # one in 2**28 cursors
    merged = intervals.merge_runs(fresh.unionByName(store.read(name, RUNS_SCHEMA, parts=touched)))
    done = store.read(tracked_loads_table(spec), LOADS_SCHEMA).unionByName(store.spark.createDataFrame([(x,) for x in loads], LOADS_SCHEMA))
    store.publish({tracked_loads_table(spec): done}, {name: (merged, part)})
    release(store.spark, fresh)
    return len(loads)


def cursor_gaps(store: Store, spec: SourceSpec) -> DataFrame:
    """Cursors missing in raw between its least and its greatest, as intervals, from the tracked runs."""
    return intervals.gaps(store.read(cursor_runs_table(spec), RUNS_SCHEMA))


# -- D3 ---------------------------------------------------------------------------
def _append_staging(store: Store, spec: SourceSpec, rows: DataFrame, run_id: str) -> None:
    """Rows of one validate run, in a folder of their own (a version written plainly before stays plain)."""
    table_name = staging_table(spec)
    plain = store.read(table_name) is not None and not store.layout(table_name)
    if plain:
        store.append(table_name, rows)
    else:
        store.append(table_name, rows.withColumn(STAGED_BY, F.lit(run_id)), partition_by=[STAGED_BY])


def staged_by(store: Store, spec: SourceSpec, runs: list[str]) -> DataFrame:
    """Staging rows that the given validate runs inserted: no other folder is read."""
    schema = T.StructType([*ingest.staging_schema(spec).fields, T.StructField(STAGED_BY, T.StringType())])
    staging = store.read(staging_table(spec), schema, with_layout=True)
    return staging.filter(F.col(STAGED_BY).isin(runs)).select(*ingest.staging_columns(spec))


def _new_loads(store: Store, spec: SourceSpec, raw: DataFrame) -> list[str]:
    """Load runs in raw that no incremental validate has read (one, as a rule).

    Ids are text as declared in raw's schema, never inferred from folder names;
    the two small id tables are compared by an anti-join.
    """
    loads = raw.select(F.col(RAW_PARTITION).alias("load_run_id")).distinct()
    done = store.read(validated_loads_table(spec), LOADS_SCHEMA)
    return sorted(r[0] for r in loads.join(done.distinct(), "load_run_id", "left_anti").collect())


def _incremental_pending(store: Store, spec: SourceSpec, raw: DataFrame, staging: DataFrame | None, new_loads: list[str], indexed: bool) -> DataFrame:
    """Candidates: the rows of new load partitions and the carried-over keys.

    Exact: a raw row from an already-validated load can only be pending if it
    was left pending by the previous run (staging only grows), and those rows
    are exactly the carry-over. With the index, staged keys are looked up in
    the candidates' hash buckets; else in all of staging.
    """
    fresh = raw.filter(F.col(RAW_PARTITION).isin(new_loads)) if new_loads else raw.limit(0)
    carry = store.read(carry_table(spec))
    if carry is not None:
        fresh = fresh.unionByName(raw.join(carry, [spec.business_key, spec.cursor], "left_semi"))
    if indexed:
        staging = key_index.staged_in_buckets(store, spec, spec.business_key, fresh)
    return ingest.pending(fresh, staging, spec)


def _staged_near(staging: DataFrame, validated: DataFrame, spec: SourceSpec) -> DataFrame:
    """The part of staging that can decide ``validated``: rows with one of its keys or cursors (those two columns).

    One scan of the two columns; each row is marked by its key and by its cursor.
    """
    key, cur = spec.business_key, spec.cursor
    keys = validated.select(F.col(key).cast(staging.schema[key].dataType).alias(key), F.lit(True).alias("__k")).distinct()
    cursors = validated.select(cur, F.lit(True).alias("__c")).distinct()
    marked = staging.select(key, cur).join(keys, key, "left").join(cursors, cur, "left")
    return marked.filter("__k OR __c").select(key, cur)


def _indexed_near(store: Store, spec: SourceSpec, validated: DataFrame) -> DataFrame:
    """As ``_staged_near``, from the buckets of the batch's keys and cursors."""
    found = [key_index.staged_with(store, spec, c, validated).select(spec.business_key, spec.cursor) for c in (spec.business_key, spec.cursor)]
    return found[0].unionByName(found[1]).distinct()


def _follow_staging(store: Store, spec: SourceSpec) -> bool:
    """Bring the index of staged keys up to staging; False where staging is not laid out by run."""
    runs = _staged_runs(store, spec)
    if runs:
        key_index.follow(store, spec, runs, staged_by)
    return bool(runs)


def pending_rows(store: Store, spec: SourceSpec) -> DataFrame:
    """The raw rows that the next incremental validate takes up."""
    raw = read_raw(store, spec)
    staging = store.read(staging_table(spec), ingest.staging_schema(spec))
    return _incremental_pending(store, spec, raw, staging, _new_loads(store, spec, raw), _follow_staging(store, spec))


def validate(
    store: Store,
    spec: SourceSpec,
    run_id: str | None = None,
    as_of: dt.datetime | None = None,
    incremental: bool = False,
) -> StageResult:
    """Raw rows not yet in staging -> typed staging rows + rejects with reasons.

    Rejected rows stay out of staging, so later runs read and record them again.
    The pending rows are checked and written once; decisions are made on their
    keys, cursors and errors alone, against the part of staging that shares a
    key or a cursor with them. ``incremental`` gives the same result without
    reading all of raw: only raw partitions of load runs not validated before,
    plus the raw keys the last incremental run left pending (kept in a small
    carry-over table). The first incremental run reads everything once.
    """
    spark = store.spark
    _prepare(spark)
    run = _Run(store, spec, "validate", run_id)
    at = as_of or _now()
    key, cur = spec.business_key, spec.cursor
    try:
        raw = read_raw(store, spec, parsed=True)
        if raw is None:
            raise RuntimeError(f"raw table for {spec.name} does not exist; load first")
        # before the first run there is no table to compare with: no row is moved for it
        staging = store.read(staging_table(spec), ingest.staging_schema(spec)) if store.exists(staging_table(spec)) else None
        new_loads = _new_loads(store, spec, raw) if incremental else []
        indexed = incremental and _follow_staging(store, spec)
        if incremental and store.exists(validated_loads_table(spec)):
            todo = _incremental_pending(store, spec, raw, staging, new_loads, indexed)
        else:
            todo = ingest.pending(raw, staging, spec)
        seen = Observation(f"pending_{run.run_id}")
        checked = ingest.validate_frame(todo, spec).observe(seen, F.count(F.lit(1)).alias("read"))
        validated = materialize(spark, checked, "validated")
        read = seen.get.get("read", 0)
        near = None
        if staging is not None:
            near = _indexed_near(store, spec, validated) if indexed else _staged_near(staging, validated, spec)
        obs = Observation(f"validate_{run.run_id}")
        decided = ingest.staging_outcome(validated, near, spec, carry=["raw_key"]).observe(
            obs,
            F.count(F.when(F.col("outcome") == "insert", True)).alias("insert"),
            F.count(F.when(F.col("outcome") == "reject", True)).alias("reject"),
        )
        decided = materialize(spark, decided, "decided")
        counts = obs.get
        inserted = validated.join(decided.filter(F.col("outcome") == "insert").select("raw_key"), "raw_key", "left_semi")
        _append_staging(store, spec, inserted.select(*ingest.staging_columns(spec)), run.run_id)
        if counts.get("reject", 0):
            rejects = validated.join(decided.filter(F.col("outcome") == "reject").select("raw_key", "reason"), "raw_key")
            store.append(REJECTS, ingest.reject_rows(rejects, run.run_id, spec.name, at))
        if incremental:
            # next run's carry-over: pending rows whose raw key is still not in staging
            left = validated.select(F.col("raw_key").alias(key), cur)
            staged = inserted.select(F.col(key).cast("string").alias(key))
            store.publish({carry_table(spec): left.join(staged, key, "left_anti")})
            store.create(validated_loads_table(spec), LOADS_SCHEMA)
            if new_loads:
                store.append(validated_loads_table(spec), spark.createDataFrame([(x,) for x in new_loads], LOADS_SCHEMA))
        # O8: every unknown payload key this run met, as a table
        drift = contract.drift_report(validated.select(F.col("raw_payload").alias("payload")), spec.contract)
        met = Observation(f"drift_{run.run_id}")
        drift = drift.select(
            F.lit(run.run_id).alias("run_id"), F.lit(spec.name).alias("source"), "extra_key", "rows_with_key",
            F.lit(at).cast("timestamp").alias("seen_at"),
        ).observe(met, F.count(F.lit(1)).alias("n"))
        store.append(DRIFT, drift)
        if met.get.get("n", 0):
            log.info("validate %s: %d unknown keys recorded in %s", spec.name, met.get["n"], DRIFT)
        release(spark, validated, decided)
        result = StageResult(
            run.run_id, "validate", rows_read=read, rows_written=counts.get("insert", 0),
            rows_rejected=counts.get("reject", 0),
        )
    except Exception as exc:
        run.failure(str(exc))
        raise
    run.success(result)
    if result.rows_rejected:
        if spec.reject_policy == "fail":
            message = f"policy 'fail' allows no rejected rows; this run recorded {result.rows_rejected}"
            run.failure(message, result)
            raise RejectsNotAllowed(message)
        if spec.reject_policy == "warn":
            log.warning("validate %s: %d rows rejected", spec.name, result.rows_rejected)
    return result


# -- D4 ---------------------------------------------------------------------------
def _staged_runs(store: Store, spec: SourceSpec) -> list[str]:
    """Validate runs with a folder in staging's current version (a listing of folders, no file is read)."""
    return [n.partition("=")[2] for n in store.layout(staging_table(spec)) if n.startswith(f"{STAGED_BY}=")]


def _merged_frame(store: Store, spec: SourceSpec, runs: list[str]) -> DataFrame:
    version = store.current(staging_table(spec))[1]
    return store.spark.createDataFrame([(version, r) for r in runs], MERGED_SCHEMA)


def unmerged_runs(store: Store, spec: SourceSpec) -> list[str]:
    """Validate runs whose rows the marts do not hold yet. After a rewrite of staging that is every run: merging again changes nothing."""
    here = _merged_frame(store, spec, _staged_runs(store, spec))
    done = store.read(merged_runs_table(spec), MERGED_SCHEMA)
    return sorted(r["validate_run_id"] for r in here.join(done, ["staging", "validate_run_id"], "left_anti").collect())


def _observed(frames: dict, run: _Run) -> dict[str, Observation]:
    """Count the rows of each frame while it is written; frames are (DataFrame) or (DataFrame, part)."""
    seen = {}
    for name, frame in frames.items():
        seen[name] = Observation(f"tf_{name}_{run.run_id}")
        count = F.count(F.lit(1)).alias("n")
        frames[name] = (frame[0].observe(seen[name], count), frame[1]) if isinstance(frame, tuple) else frame.observe(seen[name], count)
    return seen


def _no_orphans(fact_src: DataFrame, dim: DataFrame, spec: SourceSpec) -> None:
    if spec.fact.dim_key:
        lost = checks.orphans(fact_src, dim, [spec.fact.dim_key], [spec.dim.key]).agg(F.sum("n")).first()[0]
        if lost:
            raise checks.OrphanViolation(f"{lost} rows of {spec.fact.name} have no row in {spec.dim.name}")


def _upserted_dim(store: Store, dim, source: DataFrame) -> DataFrame:
    target = store.read(dim.name, source.schema)
    return merge.upsert_aggregate(target, source, dim.key, dim.attributes, least_cols=(dim.first_seen,), greatest_cols=(dim.last_seen,))


def _merge_new(store: Store, spec: SourceSpec, run: _Run) -> StageResult | None:
    """Marts after the staging rows they do not hold yet, at the cost of those rows; None where all of staging is needed.

    The fact is published by month: the months of the new rows are read, merged
    and replaced, the files of the other months stay. A grain that the fact
    holds for another business key is a duplicate in staging, as the fact
    carries its row's key. The dimension is upserted from a stored state of its
    aggregates, into which the new rows are merged. What was merged is
    published with the marts, in the same append.
    """
    fact, dim = spec.fact, spec.dim
    if spec.mart_steps or fact is None or fact.month_of is None or spec.business_key not in fact.columns + fact.grain:
        return None
    if not _staged_runs(store, spec) or store.current(fact.name) or (dim is not None and store.exists(dim.name) and not store.exists(dim_state_table(spec))):
        return None
    runs = unmerged_runs(store, spec)
    if not runs:
        return StageResult(run.run_id, "transform")
    fresh = staged_by(store, spec, runs)
    columns = list(spec.clean_columns) + list(spec.nullable_clean_columns)
    cleaned = marts.clean_strings(fresh, columns)
    fact_src = marts.fact_rows(cleaned, fact)
    flagged = fresh.select(
        *[(btrim_ws(F.col(g)) if g in columns else F.col(g)).alias(g) for g in fact.grain],
        marts.changed_predicate(spec.clean_columns, spec.nullable_clean_columns).alias("__changed"),
    )
    profile = checks.grain_and_flag_profile(flagged, fact.grain, F.col("__changed"))
    if profile["flagged"]:
        return None  # the clean pass rewrites staging
    checks.raise_on_duplicates(profile, fact.grain)
    months = sorted(r[0] for r in fact_src.select(marts.fact_month(fact).alias("m")).distinct().collect())
    target = store.read(fact.name, fact_src.schema, parts=months)
    held = target.select(*fact.grain, F.col(spec.business_key).alias("__held"))
    clash = held.join(fact_src.select(*fact.grain, spec.business_key), list(fact.grain)).filter(~F.col("__held").eqNullSafe(F.col(spec.business_key)))
    checks.raise_on_duplicates({"dup_groups": clash.select(*fact.grain).distinct().count()}, fact.grain)
    parts = {fact.name: (merge.upsert_replace(target, fact_src, fact.grain), marts.fact_month(fact))}
    frames: dict[str, DataFrame] = {}
    if dim is not None:
        units = marts.build_dim(cleaned, dim)
        state = marts.merge_dim_state(store.read(dim_state_table(spec), units.schema), units, dim)
        frames[dim.name] = _upserted_dim(store, dim, state.join(units.select(dim.key), dim.key, "left_semi"))
        frames[dim_state_table(spec)] = state
        _no_orphans(fact_src, frames[dim.name], spec)
    seen = _observed(frames, run)
    seen |= _observed(parts, run)
    done = store.read(merged_runs_table(spec), MERGED_SCHEMA).unionByName(_merged_frame(store, spec, runs))
    store.publish({**frames, merged_runs_table(spec): done}, parts)
    written = sum(o.get["n"] for n, o in seen.items() if n != dim_state_table(spec))
    return StageResult(run.run_id, "transform", rows_read=profile["n_rows"], rows_written=written)


def transform(store: Store, spec: SourceSpec, run_id: str | None = None, force: bool = False, incremental: bool = False) -> StageResult:
    """Staging -> cleaned staging, dimension upsert, grain check, fact upsert; all or nothing.

    Every check runs before the first write; the new versions are published
    together. Staging is rewritten only when the clean pass changes a row. A
    version of staging only grows, so when it is the one the marts were last
    built from, with as many rows, nothing is new and nothing is written
    (``force`` builds anyway, e.g. after a change of the specification).
    ``incremental`` merges only the staging rows of validate runs that the marts
    do not hold yet (see ``_merge_new``), to the same marts.
    """
    spark = store.spark
    _prepare(spark)
    run = _Run(store, spec, "transform", run_id)
    try:
        staging = store.read(staging_table(spec), with_layout=True)
        if staging is None:
            raise RuntimeError(f"staging table for {spec.name} does not exist; validate first")
        if incremental and not force:
            result = _merge_new(store, spec, run)
            if result is not None:
                run.success(result)
                return result
        before = store.current(staging_table(spec))[1]
        built = store.read(transformed_table(spec), TRANSFORMED_SCHEMA).agg(F.max_by(F.struct("staging", "n_rows"), "at").alias("b")).first()["b"]
        if built is not None and not force and not incremental and built["staging"] == before:
            rows = staging.count()  # row counts of the files' footers
            if rows == built["n_rows"]:
                result = StageResult(run.run_id, "transform", rows_read=rows, rows_written=0)
                run.success(result)
                return result
        merged = _merged_frame(store, spec, _staged_runs(store, spec))
        columns = list(spec.clean_columns) + list(spec.nullable_clean_columns)
        cleaned = marts.clean_strings(staging, columns)
        changed_flag = marts.changed_predicate(spec.clean_columns, spec.nullable_clean_columns)
        frames: dict[str, DataFrame] = {}
        parts: dict[str, tuple] = {}
        if spec.fact is not None:
            # one pass: grain check on the cleaned grain + count of rows the clean pass rewrites
            flagged = staging.select(
                *[(btrim_ws(F.col(g)) if g in columns else F.col(g)).alias(g) for g in spec.fact.grain],
                changed_flag.alias("__changed"),
            )
            profile = checks.grain_and_flag_profile(flagged, spec.fact.grain, F.col("__changed"))
            checks.raise_on_duplicates(profile, spec.fact.grain)
            read, changed = profile["n_rows"], profile["flagged"]
            fact_src = marts.fact_rows(cleaned, spec.fact)
            fact_tgt = store.read(spec.fact.name, fact_src.schema)
            upserted = merge.upsert_replace(fact_tgt, fact_src, spec.fact.grain)
            if spec.fact.month_of is not None and store.current(spec.fact.name) is None:
                parts[spec.fact.name] = (upserted, marts.fact_month(spec.fact))
            else:
                frames[spec.fact.name] = upserted
        else:
            read = None
            changed = staging.filter(changed_flag).count()
        if spec.dim is not None:
            dim_src = marts.build_dim(cleaned, spec.dim)
            frames[spec.dim.name] = _upserted_dim(store, spec.dim, dim_src)
            frames[dim_state_table(spec)] = dim_src
        if spec.fact is not None and spec.dim is not None:
            _no_orphans(fact_src, frames[spec.dim.name], spec)
        for name, build in spec.mart_steps:  # X4: further mart steps, in order
            frames[name] = build(cleaned.drop(STAGED_BY))
        if changed:
            frames[staging_table(spec)] = cleaned
        seen = _observed(frames, run)
        seen |= _observed(parts, run)
        store.publish({**frames, merged_runs_table(spec): merged} if not changed else frames, parts)
        written = sum(o.get["n"] for n, o in seen.items() if n not in (staging_table(spec), dim_state_table(spec)))
        read = read if read is not None else staging.count()
        state = [(store.current(staging_table(spec))[1], read, _now())]
        store.append(transformed_table(spec), spark.createDataFrame(state, TRANSFORMED_SCHEMA))
        result = StageResult(run.run_id, "transform", rows_read=read, rows_written=written)
    except Exception as exc:
        run.failure(str(exc))
        raise
    run.success(result)
    return result


# -- X1 ---------------------------------------------------------------------------
def configured_source(spark: SparkSession, spec: SourceSpec) -> Fetch:
    """The source that ``spec.source`` names by format and options."""
    if spec.source is None:
        raise ValueError(f"{spec.name} names no source; pass one")
    kind, options = spec.source
    if kind == saved_pages.FORMAT:
        return saved_pages.saved_pages_source(spark, options["path"], spec.cursor_field)
    return table.table_source(spark.read.format(kind).options(**options).load(), spec.cursor_field)


# -- D5 / D6 ----------------------------------------------------------------------
STAGES = ("extract", "load_raw", "validate", "transform")


def run_stages(
    store: Store,
    spec: SourceSpec,
    fetch: Fetch | None,
    landing_root: str,
    stages: tuple[str, ...] = STAGES,
    limit: int | None = None,
    as_of: dt.datetime | None = None,
    incremental: bool = False,
) -> dict[str, StageResult]:
    """Run the named stages in order; a failing stage raises and stops the rest.

    ``load_raw`` alone reads the newest committed landing directory;
    ``incremental`` selects the incremental validate and transform (same result, reads less). Without a ``fetch`` the
    source is the one that the specification names.
    """
    fetch = fetch or (configured_source(store.spark, spec) if "extract" in stages else None)
    results: dict[str, StageResult] = {}
    landing_dir = None
    if "extract" in stages:
        results["extract"] = extract(store, spec, fetch, landing_root, limit=limit)
        landing_dir = results["extract"].path
    if "load_raw" in stages:
        landing_dir = landing_dir or landing.latest_landing(store.spark, landing_root, spec.name)
        if landing_dir is None:
            raise FileNotFoundError(f"no landing batch for {spec.name}")
        results["load_raw"] = load_raw(store, spec, landing_dir, as_of=as_of)
    if "validate" in stages:
        results["validate"] = validate(store, spec, as_of=as_of, incremental=incremental)
    if "transform" in stages:
        results["transform"] = transform(store, spec, incremental=incremental)
    return results


def run_from_json_array(
    store: Store, spec: SourceSpec, path: str, landing_root: str, as_of: dt.datetime | None = None, split_bytes: int | None = None
) -> dict[str, StageResult]:
    """Offline run: JSON-array files of any size -> landing -> load -> validate -> transform."""
    spark = store.spark
    _prepare(spark)
    run_id = str(uuid.uuid4())
    target = landing.landing_path(landing_root, spec.name, run_id)
    landing.write_landing(read_array_elements(spark, path, split_bytes), target)
    results = {"load_raw": load_raw(store, spec, target, as_of=as_of)}
    results["validate"] = validate(store, spec, as_of=as_of)
    results["transform"] = transform(store, spec)
    return results


# -- ops reads (O4 O5 O6 O7) ---------------------------------------------------------
def runs(store: Store) -> DataFrame:
    events = store.read(RUN_EVENTS, ledger.RUN_EVENT_SCHEMA)
    return ledger.fold_runs(events)


def rejects(store: Store) -> DataFrame:
    return store.read(REJECTS, ledger.REJECT_SCHEMA)


def report(store: Store, spec: SourceSpec | list[SourceSpec], as_of: dt.datetime | None = None, limit: int = 20) -> dict[str, DataFrame]:
    """S15: recent runs, and freshness of one or several sources, as JSON-line frames (``value`` column), never collected here."""
    at = as_of or _now()
    fresh = None
    for one in spec if isinstance(spec, list) else [spec]:
        staging = store.read(staging_table(one), ingest.staging_schema(one))
        row = ledger.freshness(staging, at, delivery_col=one.freshness_delivery or "ingested_at", source=one.name)
        fresh = row if fresh is None else fresh.unionByName(row)
    return {
        "recent_runs": ledger.recent_runs(runs(store), limit).select(F.to_json(F.struct("*")).alias("value")),
        "freshness": fresh.select(F.to_json(F.struct("*")).alias("value")),
    }
