"""Registered queries: each operator of the inventory as a lazy DataFrame over the driver tables.

Every query takes ``(spark, sf_dir)``, reads the given Parquet tables and
returns a DataFrame without collecting. They compose the same operators the
stages use; literals stand in for run ids and clocks so results are
reproducible. Decimal outputs are returned as DOUBLE and instants as
TIMESTAMP_NTZ (UTC wall clock) so they compare across engines.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import coerce as C
from tidemark.functions import json as J
from tidemark.functions.time import local_wall_clock
from tidemark.operators import checks, contract, ingest, ledger, marts, merge
from tidemark.session import apply_required_conf, work_folder
from tidemark.sources import pages, table
from tidemark.sources.feeds import REISSUE_SHIFT, auction_feed, orders_feed
from tidemark.specs import LOCAL_ZONE, auction_spec, orders_spec

# Fixed query parameters (shared with the oracle SQL).
KEYSET_WATERMARK = 5000
PAGE_SIZE = 250
EXTRACT_LIMIT = 1000
PAGE_ROWS = 100
ARRAY_ROWS = 500
LINEITEM_SPLIT = dt.datetime(1998, 1, 1)
DELIVERY_SPLIT = dt.datetime(2024, 1, 16)
OVERLAP = dt.timedelta(days=3)
PRICE_BUMP = 1.0
LOAD_RUN_ID = "load-0001"
LOAD_AT = dt.datetime(2024, 2, 1, 6, 0, 0)
ORDERS_LOAD_AT = dt.datetime(2001, 9, 1, 0, 0, 0)
AS_OF = dt.datetime(2024, 2, 2, 0, 0, 0)
VALIDATE_RUN_A = ("validate-a", dt.datetime(2024, 2, 1, 7, 0, 0))
VALIDATE_RUN_B = ("validate-b", dt.datetime(2024, 2, 1, 8, 0, 0))
RECENT_RUNS = 20
LINEITEM_KEY = ["l_orderkey", "l_linenumber"]
LINEITEM_ORDER = [
    "l_partkey", "l_suppkey", "l_shipdate", "l_quantity", "l_extendedprice",
    "l_discount", "l_tax", "l_returnflag", "l_linestatus",
]

AUCTION = auction_spec(reject_policy="quarantine")
AUCTION_FORBID = auction_spec(reject_policy="quarantine", extra="forbid")
ORDERS = orders_spec()


# -- helpers ------------------------------------------------------------------------
def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    apply_required_conf(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def comparable(df: DataFrame) -> DataFrame:
    """Decimals as DOUBLE, instants as their UTC wall clock (TIMESTAMP_NTZ)."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DecimalType):
            c = c.cast("double")
        elif isinstance(f.dataType, T.TimestampType):
            c = c.cast("timestamp_ntz")
        cols.append(c.alias(f.name))
    return df.select(*cols)


def _feed_lines(spark, sf_dir) -> DataFrame:
    return auction_feed(_read(spark, sf_dir, "events")).select("payload")


def _raw(spark, sf_dir, spec=AUCTION) -> DataFrame:
    """Raw table after one load of the auction feed (insert-only into an empty raw)."""
    keyed = ingest.extract_keys(_feed_lines(spark, sf_dir), spec)
    batch = ingest.raw_batch(keyed, spec, LOAD_RUN_ID, LOAD_AT)
    return ingest.raw_inserts(batch, None, spec)


def written(spark: SparkSession, df: DataFrame, label: str) -> DataFrame:
    """``df`` written once below ``spark.checkpoint.dir`` and read back, as the stages do with what two reads need."""
    path = work_folder(spark, f"query-{label}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _outcomes(spark, sf_dir, spec=AUCTION) -> DataFrame:
    """Decided rows of raw. The checked rows are written first, as ``validate`` does: deciding reads them twice, and the
    contract is evaluated once per row."""
    checked = written(spark, ingest.validate_frame(_raw(spark, sf_dir, spec), spec), "checked")
    return ingest.staging_outcome(checked, None, spec)


def _staging(spark, sf_dir) -> DataFrame:
    out = _outcomes(spark, sf_dir)
    return out.filter(F.col("outcome") == "insert").select(*ingest.staging_columns(AUCTION))


def _staging_table(spark, sf_dir) -> DataFrame:
    """Staging as a table, for queries that read it more than once."""
    return written(spark, _staging(spark, sf_dir), "staging")


_PROVENANCE = ("ingested_at", "extract_run_id")
_STAGING_OUT = [c for c in ingest.staging_columns(AUCTION) if c not in _PROVENANCE]


# -- S1 K1 F8 ---------------------------------------------------------------------
def keyset_page(spark, sf_dir):
    events = _read(spark, sf_dir, "events")
    return table.keyset_page(events, "event_id", KEYSET_WATERMARK, PAGE_SIZE)


# -- S2 ---------------------------------------------------------------------------
def incremental_drain(spark, sf_dir):
    """Cold start (no watermark): every row with cursor > 0."""
    return table.drain(_read(spark, sf_dir, "events"), "event_id", None)


# -- S5 A1 ------------------------------------------------------------------------
def watermark_max(spark, sf_dir):
    raw = _raw(spark, sf_dir)
    return raw.agg(F.max("_id").alias("watermark"), F.count(F.lit(1)).alias("raw_rows"))


# -- S6 S4 ------------------------------------------------------------------------
def watermark_after(spark, sf_dir):
    # a superset on the scanned column, so that the scan is pruned
    events = _read(spark, sf_dir, "events").filter(F.col("event_id") > KEYSET_WATERMARK - 1 - REISSUE_SHIFT)
    feed = auction_feed(events)
    v = J.parse_payload(F.col("payload"))
    cursor_kind = F.schema_of_variant(J.field(v, "_id"))
    records = feed.select(
        F.col("_id"),
        table.integer_cursor(J.try_field_as(v, "_id", "bigint"), cursor_kind == "BIGINT").alias("counted"),
    )
    page = table.cap_rows(table.after(records, "_id", KEYSET_WATERMARK), "_id", EXTRACT_LIMIT)
    return table.watermark_after(page, F.col("counted"), KEYSET_WATERMARK)


# -- S3 ---------------------------------------------------------------------------
_EVENT_RECORD = ["event_id", "user_id", "event_type", "value", "props"]


def _typed_event(payloads: DataFrame) -> DataFrame:
    v = J.parse_payload(F.col("payload"))
    return contract.evaluate_once(
        payloads.select(
            J.field_as(v, "event_id", "bigint").alias("event_id"),
            J.field_as(v, "user_id", "bigint").alias("user_id"),
            J.field_as(v, "event_type", "string").alias("event_type"),
            J.field_as(v, "value", "double").alias("value"),
            J.field_as(v, "props", "string").alias("props"),
        )
    )


def api_pages_unwrap(spark, sf_dir):
    events = _read(spark, sf_dir, "events")
    saved = pages.pack_pages(events, F.expr(f"event_id div {PAGE_ROWS}"), F.struct(*_EVENT_RECORD))
    return _typed_event(pages.unwrap_pages(saved))


# -- S10 --------------------------------------------------------------------------
def json_array_explode(spark, sf_dir):
    events = _read(spark, sf_dir, "events")
    files = pages.pack_arrays(events, F.expr(f"event_id div {ARRAY_ROWS}"), F.struct(*_EVENT_RECORD))
    return _typed_event(pages.explode_json_array(files))


# -- S8 P1 P2 F1 ------------------------------------------------------------------
def load_raw_extract_keys(spark, sf_dir):
    keyed = ingest.extract_keys(_feed_lines(spark, sf_dir), AUCTION)
    return keyed.filter(ingest.loadable(keyed, AUCTION)).select("unit_result_id", "_id")


# -- J2 ---------------------------------------------------------------------------
def merge_insert_only(spark, sf_dir):
    """Existing table = lineitem shipped before the split (first row per key); the
    batch = the rest. Result: the table after the insert-only merge."""
    li = _read(spark, sf_dir, "lineitem")
    existing = merge.first_wins(li.filter(F.col("l_shipdate") < F.lit(LINEITEM_SPLIT)), LINEITEM_KEY, LINEITEM_ORDER)
    batch = li.filter(F.col("l_shipdate") >= F.lit(LINEITEM_SPLIT))
    inserts = merge.insert_only(batch, existing, LINEITEM_KEY, LINEITEM_ORDER)
    return existing.unionByName(inserts)


def reload_shift_noop(spark, sf_dir):
    """Reload of the same batch with every cursor + 1,000,000 inserts nothing."""
    keyed = ingest.extract_keys(_feed_lines(spark, sf_dir), AUCTION)
    batch = ingest.raw_batch(keyed, AUCTION, LOAD_RUN_ID, LOAD_AT)
    raw = ingest.raw_inserts(batch, None, AUCTION)
    shifted = batch.withColumn("_id", F.col("_id") + F.lit(REISSUE_SHIFT))
    again = ingest.raw_inserts(shifted, raw, AUCTION)
    both = raw.select(F.lit(True).alias("is_raw"), "_id").unionByName(again.select(F.lit(False).alias("is_raw"), "_id"))
    return both.agg(
        F.count(F.when(F.col("is_raw"), True)).alias("raw_rows"),
        F.count(F.when(~F.col("is_raw"), True)).alias("rows_inserted"),
        F.max(F.when(F.col("is_raw"), F.col("_id"))).alias("watermark"),
    )


# -- J1 ---------------------------------------------------------------------------
def anti_join_pending(spark, sf_dir):
    orders = _read(spark, sf_dir, "orders")
    lines = _read(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"))
    return merge.anti_join(orders, lines, ["o_orderkey"])


# -- P3-P11 F2 F3 J3 --------------------------------------------------------------
def validate_accepted(spark, sf_dir):
    return comparable(_staging(spark, sf_dir).select(*_STAGING_OUT))


def validate_rejects(spark, sf_dir):
    out = _outcomes(spark, sf_dir)
    return out.filter(F.col("outcome") == "reject").select("unit_result_id", "_id", "reason")


def validate_extras_forbid(spark, sf_dir):
    out = _outcomes(spark, sf_dir, AUCTION_FORBID)
    return out.filter(F.col("outcome") == "reject").select("unit_result_id", "_id", "reason")


# -- J3 C3 ------------------------------------------------------------------------
def validate_duplicate_cursor(spark, sf_dir):
    """Raw in which every tenth row carries the cursor of the row before it, and returns
    later under a tabbed key: a lost cursor must not hold back the next row of its key."""
    raw = _raw(spark, sf_dir)
    clash = (F.col("_id") - 1) % 10 == 3
    moved = raw.withColumn("_id", F.when(clash, F.col("_id") - 1).otherwise(F.col("_id")))
    again = raw.filter(clash).withColumn("unit_result_id", F.concat("unit_result_id", F.lit("\t")))
    both = moved.unionByName(again.withColumn("_id", F.col("_id") + F.lit(2 * REISSUE_SHIFT)))
    return ingest.validate_all(both, None, AUCTION).select("unit_result_id", "_id", "outcome", "reason")


# -- P4 P7 ------------------------------------------------------------------------
def validate_grammar_edges(spark, sf_dir):
    """Integer and timestamp texts at the edge of their grammar, made of ``events`` columns."""
    ev = _read(spark, sf_dir, "events")
    m, n = F.col("event_id") % 6, F.col("event_id").cast("string")
    text = (
        F.when(m == 1, F.concat(n, F.lit("\n")))
        .when(m == 2, F.concat(n, F.lit(".00000000001")))
        .when(m == 3, F.concat(n, F.lit(".000")))
        .when(m == 4, F.lit("9223372036854775808"))
        .otherwise(n)
    )
    start = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")
    whole = C.to_integer(F.lit(J.STRING), text)
    stamp = C.to_timestamp_utc(F.when(m == 5, F.concat(start, F.lit("\n"))).otherwise(start))
    return ev.select(
        "event_id", whole.value.alias("i_value"), whole.error.alias("i_error"), whole.insert_error.alias("i_insert_error"),
        stamp.value.cast("timestamp_ntz").alias("t_value"), stamp.error.alias("t_error"),
    )


# -- A5 O7 J7 K4 ------------------------------------------------------------------
def reject_reason_counts(spark, sf_dir):
    """Two validate runs (first half of raw, then all pending rows); reasons of the latest run.

    Staging only grows and decisions are made in order of the cursor, so run A's
    decisions on its half are those that one pass over all rows makes there: one
    validated frame serves both runs, and run B's rejects are the rows of that
    pass which are no duplicates and not in staging.
    """
    raw = _raw(spark, sf_dir)
    split = raw.agg((F.max("_id") / 2).alias("__split")).scalar()  # scalar subquery
    rejected = _outcomes(spark, sf_dir).filter(F.col("outcome") == "reject")
    rejects = rejected.select(
        F.explode(
            F.when(F.col("_id") <= split, F.array(*[F.struct(F.lit(r).alias("run_id"), F.lit(t).cast("timestamp").alias("rejected_at")) for r, t in (VALIDATE_RUN_A, VALIDATE_RUN_B)]))
            .otherwise(F.array(F.struct(F.lit(VALIDATE_RUN_B[0]).alias("run_id"), F.lit(VALIDATE_RUN_B[1]).cast("timestamp").alias("rejected_at"))))
        ).alias("run"),
        F.lit(AUCTION.name).alias("source"), "raw_payload", "reason",
    ).select("run.run_id", "source", "raw_payload", "reason", "run.rejected_at")
    events = None
    for run_id, at in (VALIDATE_RUN_A, VALIDATE_RUN_B):
        for seq, (event, status) in enumerate((("start", "running"), ("finish", "success"))):
            e = ledger.run_event(
                spark, run_id=run_id, source=AUCTION.name, stage="validate", event=event, event_seq=seq,
                at=at + dt.timedelta(minutes=seq), status=status,
            )
            events = e if events is None else events.unionByName(e)
    return ledger.reject_reason_counts(rejects, ledger.fold_runs(events))


# -- A8 O8 U1 ---------------------------------------------------------------------
def schema_drift_keys(spark, sf_dir):
    return contract.drift_report(_raw(spark, sf_dir), AUCTION.contract)


# -- P12 F4 -----------------------------------------------------------------------
_CLEAN_NOT_NULL, _CLEAN_NULLABLE = list(AUCTION.clean_columns), list(AUCTION.nullable_clean_columns)
_CLEAN_ALIASES = {r.name: r.alias for r in AUCTION.contract.fields if r.name in _CLEAN_NOT_NULL + _CLEAN_NULLABLE}


def _untrimmed_staging(spark, sf_dir) -> DataFrame:
    """Staging strings as an earlier, non-trimming validator would have stored them."""
    raw = _raw(spark, sf_dir)
    v = J.parse_payload(F.col("payload"))
    return contract.evaluate_once(
        raw.select(
            F.col("unit_result_id"),
            *[J.try_field_as(v, alias, "string").alias(name) for name, alias in _CLEAN_ALIASES.items()],
        )
    )


def clean_strings(spark, sf_dir):
    return marts.clean_strings(_untrimmed_staging(spark, sf_dir), _CLEAN_NOT_NULL + _CLEAN_NULLABLE)


def clean_strings_changed(spark, sf_dir):
    lax = _untrimmed_staging(spark, sf_dir)
    return lax.filter(marts.changed_predicate(_CLEAN_NOT_NULL, _CLEAN_NULLABLE)).select("unit_result_id")


# -- P11 --------------------------------------------------------------------------
def local_wall_clock_query(spark, sf_dir):
    orders = _read(spark, sf_dir, "orders")
    instant = F.col("o_orderdate").cast("timestamp")
    return orders.select(
        "o_orderkey",
        F.col("o_orderdate"),
        local_wall_clock(instant, LOCAL_ZONE).alias("o_orderdate_uk"),
    )


# -- P5 P6 ------------------------------------------------------------------------
def decimal_fit(spark, sf_dir):
    li = _read(spark, sf_dir, "lineitem")
    price = C.to_decimal(F.col("l_extendedprice").cast("string"), 12, 4)
    milli = C.to_decimal((F.col("l_extendedprice") * 1000).cast("string"), 12, 4)
    return comparable(
        li.select(
            "l_orderkey",
            "l_linenumber",
            "l_partkey",
            price.value.alias("price_dec"),
            milli.value.alias("price_milli_dec"),
            milli.insert_error.isNotNull().alias("milli_overflow"),
        )
    )


# -- A2 ---------------------------------------------------------------------------
def dim_build(spark, sf_dir):
    return comparable(marts.build_dim(_staging(spark, sf_dir), AUCTION.dim))


# -- J4 P19 -----------------------------------------------------------------------
def dim_upsert(spark, sf_dir):
    staging = _staging_table(spark, sf_dir)
    split = F.lit(DELIVERY_SPLIT).cast("timestamp")
    dim = AUCTION.dim
    first = marts.build_dim(staging.filter(F.col("delivery_start_utc") < split), dim)
    second = marts.build_dim(staging.filter(F.col("delivery_start_utc") >= split), dim)
    merged = merge.upsert_aggregate(
        first, second, dim.key, dim.attributes, least_cols=(dim.first_seen,), greatest_cols=(dim.last_seen,)
    )
    return comparable(merged)


# -- J5 P15 U2 --------------------------------------------------------------------
def fact_upsert(spark, sf_dir):
    staging = _staging_table(spark, sf_dir)
    fact = AUCTION.fact
    start = F.col("delivery_start_utc")
    target = marts.fact_rows(staging.filter(start < F.lit(DELIVERY_SPLIT + OVERLAP).cast("timestamp")), fact)
    source = marts.fact_rows(staging.filter(start >= F.lit(DELIVERY_SPLIT - OVERLAP).cast("timestamp")), fact)
    source = source.withColumn(
        "clearing_price_gbp_per_mw_h",
        (F.col("clearing_price_gbp_per_mw_h") + F.lit(PRICE_BUMP)).cast("decimal(12,4)"),
    )
    return comparable(merge.upsert_replace(target, source, fact.grain))


# -- A3 F7 C1 ---------------------------------------------------------------------
def grain_violations(spark, sf_dir):
    li = _read(spark, sf_dir, "lineitem")
    ev = _read(spark, sf_dir, "events").withColumn("hour", F.date_trunc("hour", "ts"))
    fact = marts.fact_rows(_staging(spark, sf_dir), AUCTION.fact)
    parts = [
        ("lineitem(l_orderkey,l_linenumber)", checks.grain_profile(li, LINEITEM_KEY)),
        ("events(user_id,event_type,hour)", checks.grain_profile(ev, ["user_id", "event_type", "hour"])),
        ("fact(auction_unit,auction_product,delivery_start_utc)", checks.grain_profile(fact, AUCTION.fact.grain)),
    ]
    out = None
    for name, prof in parts:
        one = prof.select(F.lit(name).alias("grain"), "dup_groups")
        out = one if out is None else out.unionByName(one)
    return out


# -- A4 ---------------------------------------------------------------------------
def uniqueness_proof(spark, sf_dir):
    parts = [
        ("events", checks.grain_profile(_read(spark, sf_dir, "events"), ["user_id", "event_type", "ts"])),
        ("lineitem", checks.grain_profile(_read(spark, sf_dir, "lineitem"), LINEITEM_KEY)),
    ]
    out = None
    for name, prof in parts:
        one = prof.select(
            F.lit(name).alias("table_name"), "n_rows", "n_distinct",
            (F.col("n_rows") == F.col("n_distinct")).alias("is_unique"),
        )
        out = one if out is None else out.unionByName(one)
    return out


# -- J6 C5 ------------------------------------------------------------------------
def fk_orphans(spark, sf_dir):
    orders = _read(spark, sf_dir, "orders")
    li = _read(spark, sf_dir, "lineitem")
    checks_ = [
        ("orders.o_custkey -> customer", orders, _read(spark, sf_dir, "customer"), ["o_custkey"], ["c_custkey"]),
        ("lineitem.l_orderkey -> orders", li, orders, ["l_orderkey"], ["o_orderkey"]),
        ("lineitem.l_partkey -> part", li, _read(spark, sf_dir, "part"), ["l_partkey"], ["p_partkey"]),
        ("lineitem.l_suppkey -> supplier", li, _read(spark, sf_dir, "supplier"), ["l_suppkey"], ["s_suppkey"]),
    ]
    out = None
    for name, child, parent, cc, pc in checks_:
        one = checks.orphans(child, parent, cc, pc).agg(F.coalesce(F.sum("n"), F.lit(0)).alias("orphans"))
        one = one.select(F.lit(name).alias("fk"), "orphans")
        out = one if out is None else out.unionByName(one)
    return out


def mart_fk_orphans(spark, sf_dir):
    """Fact rows whose unit is not in a dimension built of one technology only, per unit."""
    staging = _staging_table(spark, sf_dir)
    dim = marts.build_dim(staging.filter(F.col("technology_type") == "T-1"), AUCTION.dim)
    fact = marts.fact_rows(staging, AUCTION.fact)
    return checks.orphans(fact, dim, [AUCTION.fact.dim_key], [AUCTION.dim.key])


# -- A9 A10 -----------------------------------------------------------------------
def null_rates(spark, sf_dir):
    staging = _staging(spark, sf_dir).select(*_STAGING_OUT)
    return checks.null_rates(staging, _STAGING_OUT)


def cursor_density(spark, sf_dir):
    ev = _read(spark, sf_dir, "events")
    raw = _raw(spark, sf_dir)
    a = checks.cursor_density(ev.select(F.col("event_id").alias("c")), "c").select(F.lit("events.event_id").alias("cursor_of"), "*")
    b = checks.cursor_density(raw.select(F.col("_id").alias("c")), "c").select(F.lit("raw._id").alias("cursor_of"), "*")
    return a.unionByName(b)


# -- A6 O5 ------------------------------------------------------------------------
def freshness(spark, sf_dir):
    staging = _staging(spark, sf_dir).select(
        F.lit(AUCTION.name).alias("source"),
        F.lit(LOAD_AT).cast("timestamp").alias("ingested_at"),
        F.col("delivery_start_utc").alias("delivery"),
    )
    orders = _read(spark, sf_dir, "orders").select(
        F.lit(ORDERS.name).alias("source"),
        F.lit(ORDERS_LOAD_AT).cast("timestamp").alias("ingested_at"),
        F.col("o_orderdate").cast("timestamp").alias("delivery"),
    )
    both = staging.unionByName(orders)
    return comparable(ledger.freshness(both, AS_OF, delivery_col="delivery"))


# -- O1 O2 O4 O6 P16 P17 K2 K3 ----------------------------------------------------
_REJECT_MODS = (7, 11, 13, 23, 29)


def _hourly_run_events(spark, sf_dir) -> DataFrame:
    """Ledger events of one validate run per event hour: a start at the hour; a
    finish at the hour's last event unless the hour is 23:00 (still running);
    failed when the hour has no 'purchase' event."""
    ev = _read(spark, sf_dir, "events")
    hour = F.date_trunc("hour", F.col("ts").cast("timestamp"))
    per_hour = ev.groupBy(hour.alias("hour")).agg(
        F.count(F.lit(1)).alias("rows_read"),
        F.count(F.when((F.col("event_id") % 50).isin(*_REJECT_MODS), True)).alias("rows_rejected"),
        F.max(F.col("ts").cast("timestamp")).alias("last_ts"),
        F.count(F.when(F.col("event_type") == "purchase", True)).alias("purchases"),
    )
    run_id = F.concat(F.lit("run-"), F.date_format("hour", "yyyyMMddHH"))
    common = [run_id.alias("run_id"), F.lit(AUCTION.name).alias("source"), F.lit("validate").alias("stage")]
    start = per_hour.select(
        *common, F.lit("start").alias("event"), F.lit(0).alias("event_seq"), F.col("hour").alias("event_at"),
        F.lit("running").alias("status"), F.lit(0).cast("bigint").alias("rows_read"),
        F.lit(0).cast("bigint").alias("rows_written"), F.lit(0).cast("bigint").alias("rows_rejected"),
        F.lit(0).cast("bigint").alias("rows_skipped"), F.lit(None).cast("bigint").alias("watermark_before"),
        F.lit(None).cast("bigint").alias("watermark_after"), F.lit(None).cast("string").alias("error"),
    )
    failed = F.col("purchases") == 0
    finish = per_hour.filter(F.hour("hour") != 23).select(
        *common, F.lit("finish").alias("event"), F.lit(1).alias("event_seq"), F.col("last_ts").alias("event_at"),
        F.when(failed, "failed").otherwise("success").alias("status"), F.col("rows_read"),
        (F.col("rows_read") - F.col("rows_rejected")).alias("rows_written"), F.col("rows_rejected"),
        F.lit(0).cast("bigint").alias("rows_skipped"), F.lit(None).cast("bigint").alias("watermark_before"),
        F.lit(None).cast("bigint").alias("watermark_after"),
        F.when(failed, F.lit("no purchase events")).alias("error"),
    )
    return start.unionByName(finish)


def run_history(spark, sf_dir):
    return comparable(ledger.run_history(ledger.fold_runs(_hourly_run_events(spark, sf_dir))))


def recent_runs(spark, sf_dir):
    runs = ledger.fold_runs(_hourly_run_events(spark, sf_dir))
    return comparable(
        ledger.recent_runs(runs, RECENT_RUNS).select(
            "run_id", "source", "stage", "status", "started_at", "ended_at",
            "rows_read", "rows_written", "rows_rejected", "error",
        )
    )


# -- D7 ---------------------------------------------------------------------------
def second_source(spark, sf_dir):
    lines = orders_feed(_read(spark, sf_dir, "orders")).select("payload")
    keyed = ingest.extract_keys(lines, ORDERS)
    raw = ingest.raw_inserts(ingest.raw_batch(keyed, ORDERS, LOAD_RUN_ID, ORDERS_LOAD_AT), None, ORDERS)
    out = ingest.validate_all(raw, None, ORDERS).filter(F.col("outcome") == "insert")
    return comparable(
        out.select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority")
    )


# -- D5 D6 (flagship) ----------------------------------------------------------------
def run_summary(spark, sf_dir):
    """Row counts of every stage of one full run over the events-backed source.

    The feed is read once: what load reads and skips is counted while its
    checked rows are written, decisions while staging is written.
    """
    keyed = ingest.extract_keys(_feed_lines(spark, sf_dir), AUCTION)
    loadable = ingest.loadable(keyed, AUCTION)
    load, decide = Observation(), Observation()
    keyed = keyed.observe(load, F.count(F.when(loadable, True)).alias("rows_read"), F.count(F.when(~loadable, True)).alias("rows_skipped"))
    raw = ingest.raw_inserts(ingest.raw_batch(keyed, AUCTION, LOAD_RUN_ID, LOAD_AT), None, AUCTION)
    checked = written(spark, ingest.validate_frame(raw, AUCTION), "checked")
    outcome = ingest.staging_outcome(checked, None, AUCTION)
    outcome = outcome.observe(decide, *[F.count(F.when(F.col("outcome") == o, True)).alias(o) for o in ("insert", "reject")])
    staging = written(spark, outcome.filter(F.col("outcome") == "insert").select(*ingest.staging_columns(AUCTION)), "staging")
    # Marts as transform builds them, over marts that hold the first part of the deliveries already.
    dim_spec, fact = AUCTION.dim, AUCTION.fact
    early = staging.filter(F.col("delivery_start_utc") < F.lit(DELIVERY_SPLIT).cast("timestamp"))
    dim = merge.upsert_aggregate(
        marts.build_dim(early, dim_spec), marts.build_dim(staging, dim_spec), dim_spec.key, dim_spec.attributes,
        least_cols=(dim_spec.first_seen,), greatest_cols=(dim_spec.last_seen,),
    )
    source = marts.fact_rows(staging, fact)
    upserted = merge.upsert_replace(marts.fact_rows(early, fact), source, fact.grain)
    # The grain check guards the fact: with a duplicate there is no fact, and the query fails.
    dup = checks.grain_profile(source, fact.grain).select("dup_groups").scalar()
    one = F.when(dup == 0, F.lit("fact")).otherwise(F.raise_error(F.lit("fact grain is not unique")))
    metrics = (
        checked.select(F.lit("raw").alias("m"))
        .unionByName(dim.select(F.lit("dim").alias("m")))
        .unionByName(upserted.select(one.alias("m")))
    )
    counted = metrics.agg(*[F.count(F.when(F.col("m") == m, True)).alias(f"{m}_rows") for m in ("raw", "dim", "fact")])
    seen = {"rows_read": load.get["rows_read"], "rows_skipped": load.get["rows_skipped"], "staging_rows": decide.get["insert"], "rejected_rows": decide.get["reject"]}
    order = ("rows_read", "rows_skipped", "raw_rows", "staging_rows", "rejected_rows", "dim_rows", "fact_rows")
    return counted.select(*[F.lit(seen[c]).cast("long").alias(c) if c in seen else F.col(c) for c in order])


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "keyset_page": keyset_page,
    "incremental_drain": incremental_drain,
    "watermark_max": watermark_max,
    "watermark_after": watermark_after,
    "api_pages_unwrap": api_pages_unwrap,
    "json_array_explode": json_array_explode,
    "load_raw_extract_keys": load_raw_extract_keys,
    "merge_insert_only": merge_insert_only,
    "reload_shift_noop": reload_shift_noop,
    "anti_join_pending": anti_join_pending,
    "validate_accepted": validate_accepted,
    "validate_rejects": validate_rejects,
    "validate_extras_forbid": validate_extras_forbid,
    "validate_duplicate_cursor": validate_duplicate_cursor,
    "validate_grammar_edges": validate_grammar_edges,
    "reject_reason_counts": reject_reason_counts,
    "schema_drift_keys": schema_drift_keys,
    "clean_strings": clean_strings,
    "clean_strings_changed": clean_strings_changed,
    "local_wall_clock": local_wall_clock_query,
    "decimal_fit": decimal_fit,
    "dim_build": dim_build,
    "dim_upsert": dim_upsert,
    "fact_upsert": fact_upsert,
    "grain_violations": grain_violations,
    "uniqueness_proof": uniqueness_proof,
    "fk_orphans": fk_orphans,
    "mart_fk_orphans": mart_fk_orphans,
    "null_rates": null_rates,
    "cursor_density": cursor_density,
    "freshness": freshness,
    "run_history": run_history,
    "recent_runs": recent_runs,
    "second_source": second_source,
    "run_summary": run_summary,
}
