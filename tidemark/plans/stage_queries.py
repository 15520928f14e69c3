"""Registered queries over what the stages wrote: each runs stages in a fresh folder below ``spark.checkpoint.dir``
over the driver tables and reads the published tables, the ledger or the landing area."""

from __future__ import annotations

import dataclasses
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import checks, ingest
from tidemark.plans import stages
from tidemark.plans.queries import _EVENT_RECORD, _STAGING_OUT, ARRAY_ROWS, AS_OF, AUCTION, KEYSET_WATERMARK, LOAD_AT, ORDERS, ORDERS_LOAD_AT, _read, _typed_event, comparable, written
from tidemark.plans.store import Store
from tidemark.session import work_folder
from tidemark.sources import landing, pages, saved_pages
from tidemark.sources.footers import footer_watermark
from tidemark.sources.feeds import auction_feed, auction_source
from tidemark.sources.json_split import read_array_elements
from tidemark.spec import Contract
from tidemark.specs import auction_spec
from tidemark.streaming.landing_stream import start_pages_stream

# Three batches by share of the cursor range; each repeats a part of the one before.
BATCHES = ((0.0, 0.5), (0.4, 0.8), (0.7, 1.0))


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _read(spark, sf_dir, "events")


def _fresh_store(spark: SparkSession) -> tuple[Store, str]:
    root = work_folder(spark, "query")
    return Store(spark, f"{root}/tables"), root


def three_batches(spark: SparkSession, sf_dir: str) -> Store:
    """A store after three overlapping batches, each loaded, validated and merged into the marts incrementally."""
    store, _ = _fresh_store(spark)
    events = _events(spark, sf_dir)
    end = (events.agg(F.max("event_id")).first()[0] or 0) + 1
    for lo, hi in BATCHES:
        part = events.filter((F.col("event_id") >= int(lo * end)) & (F.col("event_id") < int(hi * end)))
        stages.load_raw(store, AUCTION, auction_feed(part).select("payload"), as_of=LOAD_AT)
        stages.validate(store, AUCTION, as_of=LOAD_AT, incremental=True)
        stages.transform(store, AUCTION, incremental=True)
    return store


# -- D4 J5: the fact by month, only the months of new rows replaced --------------------
def fact_incremental(spark, sf_dir):
    return comparable(three_batches(spark, sf_dir).read(AUCTION.fact.name))


# -- D4 J4 A2: the dimension from a stored state and new rows ---------------------------
def dim_incremental(spark, sf_dir):
    return comparable(three_batches(spark, sf_dir).read(AUCTION.dim.name))


# -- D1-D5 O1 O2 A7: every stage's counters, from the ledger ------------------------------
_COUNTERS = ["stage", "status", "rows_read", "rows_written", "rows_rejected", "rows_skipped", "watermark_before", "watermark_after"]


def stage_counters(spark, sf_dir):
    """Ledger of a first run and of a second one that finds only the re-issued records past the watermark."""
    store, root = _fresh_store(spark)
    for _ in range(2):
        stages.run_stages(store, AUCTION, auction_source(_events(spark, sf_dir)), root, as_of=LOAD_AT, incremental=True)
    return stages.runs(store).select(*_COUNTERS)


# -- O3 S14: a run that allows no rejects -------------------------------------------------
def ledger_after_fail(spark, sf_dir):
    """Ledger after a validate whose policy is ``fail``: its rows and rejects are kept, it ends failed, no mart is built."""
    store, root = _fresh_store(spark)
    spec = auction_spec(reject_policy="fail")
    try:
        stages.run_stages(store, spec, auction_source(_events(spark, sf_dir)), root, as_of=LOAD_AT)
    except stages.RejectsNotAllowed:
        pass
    kept = stages.rejects(store).agg(F.count(F.lit(1)).alias("rejects_kept")).crossJoin(
        store.read(stages.staging_table(spec)).agg(F.count(F.lit(1)).alias("staging_kept"))
    )  # two rows of counts
    return stages.runs(store).select("stage", "status", "rows_read", "rows_written", "rows_rejected", F.col("error").isNotNull().alias("has_error")).crossJoin(kept)


# -- S7 S8 S9: the newest committed landing batch, read back ------------------------------
def landing_roundtrip(spark, sf_dir):
    """Two extracts; the newer batch holds the records past the first one's watermark."""
    store, root = _fresh_store(spark)
    events = _events(spark, sf_dir)
    source = auction_source(events)
    half = (events.agg(F.max("event_id")).first()[0] or 0) // 2
    first = stages.extract(store, AUCTION, auction_source(events.filter(F.col("event_id") <= half)), root)
    stages.load_raw(store, AUCTION, first.path, as_of=LOAD_AT)
    stages.extract(store, AUCTION, source, root)
    newest = landing.latest_landing(spark, root, AUCTION.name)
    return ingest.extract_keys(landing.read_landing(spark, newest), AUCTION).select("unit_result_id", "_id")


# -- D6 S10: a JSON-array file, run offline -------------------------------------------------
def offline_run(spark, sf_dir):
    """Staging of a run over JSON-array files packed from the feed."""
    store, root = _fresh_store(spark)
    feed = auction_feed(_events(spark, sf_dir))
    elements = F.concat(F.lit("["), F.array_join(F.collect_list("payload"), ","), F.lit("]"))
    arrays = feed.groupBy((F.col("event_id") / ARRAY_ROWS).cast("long").alias("file")).agg(elements.alias("value"))  # bounded files
    path = f"{root}/arrays"
    arrays.write.partitionBy("file").text(path)
    stages.run_from_json_array(store, AUCTION, path, root, as_of=LOAD_AT)
    return comparable(store.read(stages.staging_table(AUCTION)).select("unit_result_id", "_id", "auction_unit", "executed_quantity_mw", "delivery_start_utc"))


# -- P1 P3-P9: members read from raw's shredded payload, not parsed again ---------------------
def validate_shredded(spark, sf_dir):
    """Accepted and rejected rows of raw as ``load_raw`` wrote it.

    The checked rows, of them what is returned or decides, are written first: deciding reads them twice, and the plan of the
    contract is neither evaluated nor planned again for it.
    """
    store, _ = _fresh_store(spark)
    stages.load_raw(store, AUCTION, auction_feed(_events(spark, sf_dir)).select("payload"), as_of=LOAD_AT)
    kept = ["unit_result_id", "_id", "auction_unit", "technology_type", "executed_quantity_mw", "delivery_start_utc"]
    checked = ingest.validate_frame(stages.read_raw(store, AUCTION, parsed=True), AUCTION)
    checked = written(spark, checked.select(*kept, "errors", "raw_payload", "raw_key"), "checked")
    out = ingest.staging_outcome(checked, None, AUCTION, carry=kept)
    return comparable(out).select(
        "unit_result_id", "_id", "outcome", "reason", *[F.when(F.col("outcome") == "insert", F.col(c)).alias(c) for c in kept[2:]]
    )


# -- J1 J3: pending rows by the staged keys in their hash buckets ------------------------------
PENDING_CUT = 0.9  # share of the cursors that is staged before
PENDING_OVERLAP = 0.8


def pending_by_bucket(spark, sf_dir):
    """Raw rows an incremental validate takes up: a second load's new keys, and what the first one rejected."""
    store, _ = _fresh_store(spark)
    events = _events(spark, sf_dir)
    end = (events.agg(F.max("event_id")).first()[0] or 0) + 1
    stages.load_raw(store, AUCTION, auction_feed(events.filter(F.col("event_id") < int(PENDING_CUT * end))).select("payload"), as_of=LOAD_AT)
    stages.validate(store, AUCTION, as_of=LOAD_AT, incremental=True)
    stages.load_raw(store, AUCTION, auction_feed(events.filter(F.col("event_id") >= int(PENDING_OVERLAP * end))).select("payload"), as_of=LOAD_AT)
    return stages.pending_rows(store, AUCTION).select("unit_result_id", "_id")


# -- S5 A1: the watermark from file footers -------------------------------------------------------
def watermark_from_footers(spark, sf_dir):
    return footer_watermark(spark, f"{sf_dir.rstrip('/')}/events.parquet", "event_id")


# -- X1 S2 S3: saved pages by a connector --------------------------------------------------------
SAVED_PAGE_ROWS = 500


def datasource_drain(spark, sf_dir):
    """Records past a watermark from pages saved of ``events``; pages before it are not opened."""
    _, root = _fresh_store(spark)
    saved_pages.write_pages(_events(spark, sf_dir), "event_id", SAVED_PAGE_ROWS, F.struct(*_EVENT_RECORD), f"{root}/pages")
    fetch = saved_pages.saved_pages_source(spark, f"{root}/pages", "event_id")
    return _typed_event(fetch(KEYSET_WATERMARK).select("payload"))


# -- T1: saved pages as a stream whose offset is the cursor ------------------------------------------
def stream_equals_batch(spark, sf_dir):
    """Staging after two epochs of a stream of saved pages; the second half of the pages is saved after the first epoch."""
    store, root = _fresh_store(spark)
    feed = auction_feed(_events(spark, sf_dir))
    end = (feed.agg(F.max("event_id")).first()[0] or 0) + 1
    query = None
    for part in (F.col("event_id") < end // 2, F.col("event_id") >= end // 2):
        saved_pages.write_pages(feed.filter(part), "event_id", SAVED_PAGE_ROWS, F.parse_json("payload"), f"{root}/pages")
        query = query or start_pages_stream(store, AUCTION, f"{root}/pages", f"{root}/stream", starting_cursor=-1)
        query.processAllAvailable()
    query.stop()
    return comparable(store.read(stages.staging_table(AUCTION)).select(*_STAGING_OUT))


# -- S10: array files over several tasks each ---------------------------------------------------
SPLIT_FILE_ROWS = 2500
SPLITS_A_FILE = 8


def json_array_split(spark, sf_dir):
    """Records of JSON-array files, each dealt over several tasks by byte ranges."""
    _, root = _fresh_store(spark)
    files = pages.pack_arrays(_events(spark, sf_dir), F.expr(f"event_id div {SPLIT_FILE_ROWS}"), F.struct(*_EVENT_RECORD))
    files.write.partitionBy("file").text(f"{root}/arrays")
    size = spark.read.format("binaryFile").load(f"{root}/arrays").agg(F.max("length")).first()[0] or SPLITS_A_FILE
    return _typed_event(read_array_elements(spark, f"{root}/arrays", -(-size // SPLITS_A_FILE)))


# -- A10: missing cursors as intervals, from runs merged load by load ------------------------------
def cursor_gaps(spark, sf_dir):
    store, _ = _fresh_store(spark)
    events = _events(spark, sf_dir)
    end = (events.agg(F.max("event_id")).first()[0] or 0) + 1
    for lo, hi in BATCHES:
        part = events.filter((F.col("event_id") >= int(lo * end)) & (F.col("event_id") < int(hi * end)))
        stages.load_raw(store, AUCTION, auction_feed(part).select("payload"), as_of=LOAD_AT)
        stages.track_cursors(store, AUCTION)
    return stages.cursor_gaps(store, AUCTION)


# -- C2 C3: keys of every table a run wrote ----------------------------------------------------------
def key_uniqueness(spark, sf_dir):
    """Rows and repeated keys of each table after two runs over the same source."""
    store, root = _fresh_store(spark)
    for _ in range(2):
        stages.run_stages(store, AUCTION, auction_source(_events(spark, sf_dir)), root, as_of=LOAD_AT, incremental=True)
    keys = {
        "raw": (stages.read_raw(store, AUCTION), [AUCTION.business_key]), "staging": (store.read(stages.staging_table(AUCTION)), [AUCTION.business_key]),
        "staging_cursor": (store.read(stages.staging_table(AUCTION)), [AUCTION.cursor]), "dim": (store.read(AUCTION.dim.name), [AUCTION.dim.key]),
        "fact": (store.read(AUCTION.fact.name), list(AUCTION.fact.grain)), "runs": (stages.runs(store), ["run_id"]),
    }
    out = None
    for name, (df, key) in keys.items():
        one = checks.grain_profile(df, key).select(F.lit(name).alias("table_name"), "n_rows", "dup_groups")
        out = one if out is None else out.unionByName(one)
    return out


# -- X3 X4: hooks of the contract and a further mart step ----------------------------------------------
def hooked_mart_step(spark, sf_dir):
    """Rows per unit of a mart step, under a contract that upper-cases products and refuses short units."""
    store, _ = _fresh_store(spark)
    hooks = {
        "auction_product": {"clean": F.upper},
        "auction_unit": {"check": lambda c: F.when(F.length(c) < 4, F.lit("too short"))},
    }
    fields = tuple(dataclasses.replace(r, **hooks.get(r.name, {})) for r in AUCTION.contract.fields)
    step = ("unit_products", lambda staging: staging.groupBy("auction_unit", "auction_product").agg(F.count(F.lit(1)).alias("n_rows")))
    spec = dataclasses.replace(AUCTION, contract=Contract(fields), mart_steps=(step,))
    stages.load_raw(store, spec, auction_feed(_events(spark, sf_dir)).select("payload"), as_of=LOAD_AT)
    stages.validate(store, spec, as_of=LOAD_AT)
    stages.transform(store, spec)
    return store.read("unit_products")


# -- S15 X1 O4 O5 D7: the report over two sources, each named by configuration -------------------------
def report_two_sources(spark, sf_dir):
    """Freshness of both sources from the report's JSON, with how many runs it lists."""
    store, root = _fresh_store(spark)
    saved_pages.write_pages(auction_feed(_events(spark, sf_dir)), "_id", SAVED_PAGE_ROWS, F.parse_json("payload"), f"{root}/pages")
    auction = dataclasses.replace(AUCTION, source=(saved_pages.FORMAT, {"path": f"{root}/pages"}))
    orders = dataclasses.replace(ORDERS, source=("parquet", {"path": f"{sf_dir.rstrip('/')}/orders.parquet"}))
    for spec, at in ((auction, LOAD_AT), (orders, ORDERS_LOAD_AT)):
        stages.run_stages(store, spec, None, root, as_of=at, incremental=True)
    out = stages.report(store, [auction, orders], as_of=AS_OF)
    fresh = out["freshness"].select(F.from_json("value", "source string, last_ingest timestamp, last_delivery timestamp, ingest_lag_seconds long").alias("f")).select("f.*")
    listed = out["recent_runs"].agg(F.count(F.lit(1)).alias("runs_listed"))  # one row
    return comparable(fresh.crossJoin(listed))


STAGE_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "fact_incremental": fact_incremental,
    "dim_incremental": dim_incremental,
    "stage_counters": stage_counters,
    "ledger_after_fail": ledger_after_fail,
    "landing_roundtrip": landing_roundtrip,
    "offline_run": offline_run,
    "validate_shredded": validate_shredded,
    "pending_by_bucket": pending_by_bucket,
    "watermark_from_footers": watermark_from_footers,
    "datasource_drain": datasource_drain,
    "json_array_split": json_array_split,
    "cursor_gaps": cursor_gaps,
    "key_uniqueness": key_uniqueness,
    "hooked_mart_step": hooked_mart_step,
    "report_two_sources": report_two_sources,
    "stream_equals_batch": stream_equals_batch,
}
