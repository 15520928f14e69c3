"""What the incremental tables and connectors read: plan properties, crash and replay behaviour."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from tidemark.operators import ingest
from tidemark.plans import key_index, stages
from tidemark.plans.store import Store
from tidemark.sources import pages, saved_pages
from tidemark.sources.feeds import auction_feed
from tidemark.sources.footers import footer_watermark
from tidemark.specs import auction_spec
from tidemark.streaming import landing_stream


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture()
def spec():
    return auction_spec(reject_policy="quarantine")


@pytest.fixture(scope="module")
def events(spark):
    return spark.read.parquet(f"{SF_SMALL}/events.parquet")


def rec(k, **kw):
    base = {
        "_id": k, "unitResultID": f"k{k}", "registeredAuctionParticipant": "P", "auctionUnit": "U", "serviceType": "S", "auctionProduct": "X", "executedQuantity": "1",
        "clearingPrice": "2", "deliveryStart": f"2026-04-01T00:{k % 60:02d}:00.{k:06d}", "deliveryEnd": "2026-12-01T08:00:00",
    }
    return json.dumps({**base, **kw})


def lines(spark, *payloads):
    return spark.createDataFrame([(p,) for p in payloads], "payload string")


# ------------------------------------------------------------- parsed payload
def test_validate_reads_typed_members_and_parses_no_text(spark, scratch, spec, events):
    store = Store(spark, f"{scratch}/t")
    stages.load_raw(store, spec, auction_feed(events).select("payload"))
    checked = ingest.validate_frame(stages.read_raw(store, spec, parsed=True), spec)
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    text = plan(checked)
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "parse_json" not in text.lower() and "parsejson" not in text.lower()
    scan = next(x for x in text.splitlines() if "ReadSchema" in x)
    assert "payload_parsed:struct<0:variant,1:variant" in scan  # members, not the whole
    # the same rows as from the text
    from_text = ingest.validate_frame(stages.read_raw(store, spec), spec)
    assert "parse_json" in plan(from_text).lower() or "parsejson" in plan(from_text).lower()
    rows = lambda df: sorted(map(str, df.select("unit_result_id", "_id", "errors", "raw_payload", "executed_quantity_mw", "delivery_start_utc", "post_code").collect()))
    assert rows(checked) == rows(from_text)


def test_kinds_of_members_survive_shredding(spark, scratch, spec):
    odd = [rec(1, executedQuantity=1.50), rec(2, executedQuantity="1e2"), rec(3, executedQuantity=True), rec(4, postCode=7), rec(5, postCode=None), rec(6, auctionUnit={"a": 1}),
           rec(7, clearingPrice=12345678901234567890), rec(8, executedQuantity="007.10"), '{"_id": 9, "unitResultID": "k9", "unitResultID": "k9b"}']
    store = Store(spark, f"{scratch}/t")
    stages.load_raw(store, spec, lines(spark, *odd))
    rows = lambda df: sorted(map(str, ingest.validate_frame(df, spec).select("_id", "unit_result_id", "executed_quantity_mw", "post_code", "errors").collect()))
    assert rows(stages.read_raw(store, spec, parsed=True)) == rows(stages.read_raw(store, spec))


def test_raw_rows_without_a_parsed_payload_fail_and_an_old_raw_is_parsed(spark, scratch, spec):
    store = Store(spark, f"{scratch}/t")
    old = lines(spark, rec(1)).select(F.lit("k1").alias("unit_result_id"), F.lit(1).cast("long").alias("_id"), "payload", F.current_timestamp().alias("ingested_at"), F.lit("r0").alias("extract_run_id"))
    store.append(stages.raw_table(spec), old, partition_by=["extract_run_id"])
    assert stages.validate(store, spec).rows_written == 1  # no column of parsed payloads: read from the text
    mixed = Store(spark, f"{scratch}/m")
    stages.load_raw(mixed, spec, lines(spark, rec(2)))
    mixed.append(stages.raw_table(spec), old, partition_by=["extract_run_id"])
    raw = spark.read.option("mergeSchema", "true").parquet(mixed.current(stages.raw_table(spec))[1])
    assert raw.filter("payload_parsed IS NULL").count() == 1
    with pytest.raises(Exception, match=ingest.NOT_PARSED):
        from tidemark.operators import contract

        full = spark.read.schema(ingest.raw_schema(spec, parsed=True)).parquet(mixed.current(stages.raw_table(spec))[1])
        ingest.validate_frame(contract.parsed_members(full, spec.contract, ingest.PARSED), spec).collect()


# ------------------------------------------------------------------ key index
def test_a_small_batch_reads_few_bucket_folders(spark, scratch, spec, events):
    store = Store(spark, f"{scratch}/t")
    stages.load_raw(store, spec, auction_feed(events).select("payload"))
    stages.validate(store, spec, incremental=True)
    key_index.follow(store, spec, stages._staged_runs(store, spec), stages.staged_by)
    batch = spark.createDataFrame([(f"k{i}", i) for i in range(5)], "unit_result_id string, _id long")
    for column in (spec.business_key, spec.cursor):
        near = key_index.staged_in_buckets(store, spec, column, batch)
        folders = {f.rsplit("/", 2)[1] for f in near.inputFiles()}
        read = {r["f"].rsplit("/", 2)[1] for r in near.selectExpr("_metadata.file_path AS f").distinct().collect()}
        assert 1 <= len(read) <= 5 < len(folders) <= spec.key_buckets
        assert "PartitionFilters: [" in plan(near) and key_index.BUCKET in plan(near)
    staged = store.read(stages.staging_table(spec)).count()
    assert store.read(key_index.index_table(spec, "_id")).count() == staged


def test_index_left_behind_by_a_crash_catches_up(spark, scratch, spec, monkeypatch):
    store = Store(spark, f"{scratch}/t")
    for k in range(3):
        stages.load_raw(store, spec, lines(spark, rec(10 * k + 1), rec(10 * k + 2), rec(1)))
        if k == 1:
            with monkeypatch.context() as m:
                m.setattr(key_index, "follow", lambda *a: 0)  # the index misses run 0 while run 1 validates
                with pytest.raises(Exception):
                    monkeypatch_fail(m)
                    stages.validate(store, spec, incremental=True)
        out = stages.validate(store, spec, incremental=True)
        assert out.rows_rejected == 0
    assert sorted(r[0] for r in store.read(stages.staging_table(spec)).select("_id").collect()) == [1, 2, 11, 12, 21, 22]
    # adding a run twice changes no answer
    store.append(key_index.index_table(spec, "_id"), store.read(key_index.index_table(spec, "_id"), with_layout=True), partition_by=[key_index.BUCKET])
    stages.load_raw(store, spec, lines(spark, rec(31), rec(40, _id=12, unitResultID="other")))
    out = stages.validate(store, spec, incremental=True)
    assert (out.rows_written, out.rows_rejected) == (1, 1)  # cursor 12 is taken


def monkeypatch_fail(m):
    m.setattr(ingest, "staging_outcome", lambda *a, **k: (_ for _ in ()).throw(RuntimeError("lost")))


# --------------------------------------------------------------------- footers
def test_watermark_reads_no_column(spark, scratch, spec, events):
    df = footer_watermark(spark, f"{SF_SMALL}/events.parquet", "event_id")
    assert "PushedAggregation: [MAX(event_id), COUNT(*)]" in plan(df) and "ReadSchema: struct<max(event_id):bigint,count(*):bigint>" in plan(df)
    with pytest.raises(ValueError, match="not in the footers"):
        footer_watermark(spark, f"{SF_SMALL}/events.parquet", "ts")
    store = Store(spark, f"{scratch}/t")
    assert stages.current_watermark(store, spec) is None
    stages.create_tables(store, spec)
    assert stages.current_watermark(store, spec) is None
    stages.load_raw(store, spec, lines(spark, '{"_id": 5}'))  # skipped: nothing is appended
    assert stages.current_watermark(store, spec) is None
    stages.load_raw(store, spec, auction_feed(events).select("payload"))
    stages.load_raw(store, spec, lines(spark, rec(7), rec(9_000_000)))
    path = store.current(stages.raw_table(spec))[1]
    by_load = footer_watermark(spark, path, "_id", ingest.raw_schema(spec), by="extract_run_id")
    assert "PushedGroupBy: [extract_run_id]" in plan(by_load)
    assert stages.current_watermark(store, spec) == 9_000_000 == max(r["watermark"] for r in by_load.collect())
    assert sum(r["n_rows"] for r in by_load.collect()) == stages.read_raw(store, spec).count()


def test_a_nested_column_before_the_cursor_is_refused(spark, scratch):
    spark.range(3).selectExpr("named_struct('x', id, 'y', id) AS s", "id AS c").write.parquet(f"{scratch}/n")
    with pytest.raises(ValueError, match="nested column stands before"):
        footer_watermark(spark, f"{scratch}/n", "c")


def test_shredded_rows_are_checked_before_they_are_decided(spark):
    """The plan that decides begins at the checked rows, so the contract is planned and evaluated once."""
    from tidemark.plans.stage_queries import validate_shredded

    df = validate_shredded(spark, "/root/testdata/sf0.001")
    files = df.inputFiles()
    assert files and all("query-checked" in f for f in files)
    assert {r["outcome"] for r in df.select("outcome").distinct().collect()} == {"insert", "reject"}


# ------------------------------------------------------------ what runs leave on disk
def shuffle_blocks(spark) -> str:
    return spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllBlocks().mkString(" ")


def test_written_statements_leave_no_shuffle_files(spark, scratch):
    import re
    import time

    from tidemark.session import FREE_SHUFFLES

    was = spark.conf.get(FREE_SHUFFLES)
    before = set(re.findall(r"shuffle_\d+", shuffle_blocks(spark)))
    counted = spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count()
    assert stages.materialize(spark, counted, "counted").count() == 7
    Store(spark, f"{scratch}/t").append("t", counted)
    for _ in range(50):  # they are removed beside the driver's work
        left = set(re.findall(r"shuffle_\d+", shuffle_blocks(spark))) - before
        if not left:
            break
        time.sleep(0.1)
    assert len(left) <= 1  # of the count() above, which is not written
    assert spark.conf.get(FREE_SHUFFLES) == was


def test_landing_and_pages_are_packed_and_read_back(spark, scratch, events, monkeypatch):
    import glob

    from tidemark.sources import landing

    monkeypatch.setattr(landing, "MAX_LINES", 100)
    feed = auction_feed(events)
    want = sorted(r["payload"] for r in feed.select("payload").collect())
    landing.write_landing(feed, f"{scratch}/l")
    files = glob.glob(f"{scratch}/l/part-*")
    assert all(f.endswith(".gz") for f in files) and len(files) >= len(want) // 100
    assert sorted(r["payload"] for r in landing.read_landing(spark, f"{scratch}/l").collect()) == want
    saved_pages.write_pages(feed, "event_id", 200, F.parse_json("payload"), f"{scratch}/p")
    assert all(f.endswith(".gz") for f in glob.glob(f"{scratch}/p/*/part-*"))
    saved_pages.register(spark)
    assert spark.read.format(saved_pages.FORMAT).option("path", f"{scratch}/p").load().count() == len(glob.glob(f"{scratch}/p/page=*"))


def test_the_first_validate_compares_with_no_staging(spark, scratch, spec, events, monkeypatch):
    seen = []
    real = ingest.staging_outcome
    monkeypatch.setattr(ingest, "staging_outcome", lambda validated, staging, *a, **k: seen.append(staging is None) or real(validated, staging, *a, **k))
    store = Store(spark, f"{scratch}/t")
    stages.load_raw(store, spec, auction_feed(events).select("payload"))
    first = stages.validate(store, spec)
    again = stages.validate(store, spec)
    assert seen == [True, False]
    assert first.rows_written > 0 and again.rows_written == 0 and again.rows_rejected == first.rows_rejected


# ----------------------------------------------------------------- saved pages
def save(spark, path, ids):
    rows = spark.createDataFrame([(i, f"v{i}") for i in ids], "id long, v string")
    saved_pages.write_pages(rows, "id", 10, F.struct("id", "v"), path)


def test_pages_before_the_watermark_are_not_opened(spark, scratch):
    path = f"{scratch}/pages"
    save(spark, path, range(100))
    assert [(p.first, p.last) for p in saved_pages.list_pages(path)] == [(k, k + 9) for k in range(0, 100, 10)]
    for p in saved_pages.list_pages(path)[:5]:
        import glob

        for f in glob.glob(f"{p.path}/part-*"):
            with open(f, "w") as out:
                out.write("no page")  # opening it would fail the job
    fetch = saved_pages.saved_pages_source(spark, path, "id")
    assert sorted(r["cursor"] for r in fetch(54).collect()) == list(range(55, 100))
    with pytest.raises(Exception, match="page|JSON|json"):
        fetch(None).collect()
    reader = saved_pages.SavedPagesReader({"path": path})
    from pyspark.sql.datasource import GreaterThan, LessThan

    kept = list(reader.pushFilters([GreaterThan(("last_cursor",), 89), LessThan(("first_cursor",), 5)]))
    assert len(kept) == 2 and [p.first for t in reader.partitions() for p in t.pages] == [90]


def test_connector_feeds_the_stages_by_format_and_path(spark, scratch, spec, events):
    path = f"{scratch}/pages"
    feed = auction_feed(events)
    saved_pages.write_pages(feed, "event_id", 200, F.parse_json("payload"), path)
    store = Store(spark, f"{scratch}/t")
    fetch = saved_pages.saved_pages_source(spark, path, "_id")
    first = stages.extract(store, spec, fetch, scratch)
    assert first.rows_written == feed.count()
    missing = spark.read.format(saved_pages.FORMAT).option("path", f"{scratch}/none").load()
    assert missing.count() == 0


# --------------------------------------------------------------------- streams
def test_a_replayed_epoch_is_the_same_run(spark, scratch, spec, events):
    store, path = Store(spark, f"{scratch}/t"), f"{scratch}/pages"
    saved_pages.write_pages(auction_feed(events.filter("event_id < 400")), "event_id", 100, F.parse_json("payload"), path)
    query = landing_stream.start_pages_stream(store, spec, path, f"{scratch}/ckpt", starting_cursor=-1)
    query.processAllAvailable()
    query.stop()
    runs = {r["run_id"]: r for r in stages.runs(store).collect()}
    assert len(runs) == 2 and all("-0-" in r for r in runs)
    staged = store.read(stages.staging_table(spec)).count()
    # the same epoch once more, as after a crash before its commit
    load_id = next(r for r in runs if r.endswith("-load"))
    step = landing_stream.micro_batch(store, spec, lines=lambda b: pages.unwrap_pages(b.select("value")))
    batch = spark.read.format(saved_pages.FORMAT).option("path", path).load()
    original = landing_stream.epoch_run_ids
    try:
        landing_stream.epoch_run_ids = lambda b, e: (load_id, load_id.replace("-load", "-validate"))
        step(batch, 0)
    finally:
        landing_stream.epoch_run_ids = original
    assert stages.runs(store).count() == 2 and store.read(stages.staging_table(spec)).count() == staged
    # a restart goes on from the cursor: only the new pages are an epoch, under the same query's id
    saved_pages.write_pages(auction_feed(events.filter("event_id BETWEEN 400 AND 599")), "event_id", 100, F.parse_json("payload"), path)
    query = landing_stream.start_pages_stream(store, spec, path, f"{scratch}/ckpt", starting_cursor=-1)
    query.processAllAvailable()
    query.stop()
    after = {r["run_id"]: r for r in stages.runs(store).collect()}
    new = [r for i, r in after.items() if i not in runs]
    assert len(new) == 2 and {i.rsplit("-", 2)[0] for i in after} == {load_id.rsplit("-", 2)[0]}
    assert next(r for r in new if r["stage"] == "load_raw")["rows_read"] == auction_feed(events.filter("event_id BETWEEN 400 AND 599")).filter("get_json_object(payload, '$.unitResultID') IS NOT NULL").count()
