"""Stages end to end in a fresh folder: counts, idempotency, policy, grain check, streaming."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from tidemark.operators import checks
from tidemark.plans import stages
from tidemark.plans.store import Store
from tidemark.sources.feeds import auction_feed, auction_source
from tidemark.specs import auction_spec
from tidemark.streaming.landing_stream import start_landing_stream


@pytest.fixture(scope="module")
def events(spark):
    return spark.read.parquet(f"{SF_SMALL}/events.parquet")


def test_full_run_twice(spark, events, scratch):
    store = Store(spark, f"{scratch}/tables")
    spec = auction_spec(reject_policy="quarantine")
    first = stages.run_stages(store, spec, auction_source(events), f"{scratch}/landing")
    n_events = events.count()
    reissued = events.filter(F.col("event_id") % 50 == 37).count()
    null_keys = events.filter(F.col("event_id") % 50 == 31).count()
    assert first["extract"].rows_written == n_events + reissued
    assert first["load_raw"].rows_skipped == null_keys
    assert first["load_raw"].rows_read == n_events + reissued - null_keys
    assert first["load_raw"].rows_written == n_events - null_keys
    v = first["validate"]
    assert v.rows_read == v.rows_written + v.rows_rejected + v.rows_duplicate
    assert v.rows_duplicate == 0 and v.rows_rejected > 0
    staging = store.read(stages.staging_table(spec))
    assert staging.count() == v.rows_written
    # C2/C3: keys and cursors unique; C4: required columns never NULL
    assert checks.grain_profile(staging, ["unit_result_id"]).first()["dup_groups"] == 0
    assert checks.grain_profile(staging, ["_id"]).first()["dup_groups"] == 0
    required = ["registered_auction_participant", "auction_unit", "executed_quantity_mw", "delivery_start_utc"]
    assert staging.filter(checks.not_null_violations(staging, required)).count() == 0
    dim, fact = store.read("dim_unit"), store.read("fact_auction_result")
    # C5: fact -> dim has no orphans
    assert checks.orphans(fact, dim, ["auction_unit"], ["auction_unit"]).count() == 0
    assert fact.count() == v.rows_written

    second = stages.run_stages(store, spec, auction_source(events), f"{scratch}/landing")
    max_cursor = events.agg(F.max("event_id")).first()[0] + 1
    assert second["extract"].watermark_before == max_cursor
    assert second["extract"].rows_written == reissued  # re-issued cursors sit above the watermark
    assert second["load_raw"].rows_written == 0
    assert second["validate"].rows_written == 0
    assert second["validate"].rows_rejected == v.rows_rejected  # rejects are re-read each run
    assert store.read("fact_auction_result").count() == fact.count()
    runs = stages.runs(store).collect()
    assert len(runs) == 8 and {r["status"] for r in runs} == {"success"}
    assert stages.rejects(store).select("run_id").distinct().count() == 2


def test_reissued_cursors_insert_nothing(spark, events, scratch):
    store = Store(spark, f"{scratch}/tables")
    spec = auction_spec(reject_policy="quarantine")
    lines = auction_feed(events).select("payload")
    stages.load_raw(store, spec, lines)
    total = store.read(stages.raw_table(spec)).count()
    shifted = lines.select(
        F.regexp_replace("payload", r'^\{"_id":([0-9]+)', "").alias("rest"),
        F.get_json_object("payload", "$._id").cast("long").alias("id"),
    ).select(F.concat(F.lit('{"_id":'), (F.col("id") + 1_000_000).cast("string"), F.col("rest")).alias("payload"))
    again = stages.load_raw(store, spec, shifted)
    assert again.rows_written == 0
    assert store.read(stages.raw_table(spec)).count() == total


def test_fail_policy_marks_run_failed_after_writing(spark, events, scratch):
    store = Store(spark, f"{scratch}/tables")
    spec = auction_spec(reject_policy="fail")
    stages.load_raw(store, spec, auction_feed(events).select("payload"))
    with pytest.raises(stages.RejectsNotAllowed):
        stages.validate(store, spec)
    assert store.read(stages.staging_table(spec)).count() > 0
    assert stages.rejects(store).count() > 0
    (run,) = [r for r in stages.runs(store).collect() if r["stage"] == "validate"]
    assert run["status"] == "failed" and "rejected" in run["error"]


def test_grain_violation_stops_transform_before_writes(spark, scratch):
    store = Store(spark, f"{scratch}/tables")
    spec = auction_spec(reject_policy="quarantine")
    rec = {
        "_id": 1, "unitResultID": "k1", "registeredAuctionParticipant": "P", "auctionUnit": "U",
        "serviceType": "S", "auctionProduct": "X", "executedQuantity": "1", "clearingPrice": "2",
        "deliveryStart": "2026-04-01T07:30:00", "deliveryEnd": "2026-04-01T08:00:00",
    }
    dup = dict(rec, _id=2, unitResultID="k2")
    stages.load_raw(store, spec, spark.createDataFrame([(json.dumps(rec),), (json.dumps(dup),)], "payload string"))
    stages.validate(store, spec)
    with pytest.raises(checks.GrainViolation, match="1 values of \\(auction_unit, auction_product, delivery_start_utc\\)"):
        stages.transform(store, spec)
    assert not store.exists("fact_auction_result") and not store.exists("dim_unit")
    (run,) = [r for r in stages.runs(store).collect() if r["stage"] == "transform"]
    assert run["status"] == "failed"


def test_malformed_line_fails_load_without_append(spark, scratch):
    store = Store(spark, f"{scratch}/tables")
    spec = auction_spec()
    bad = spark.createDataFrame([('{"_id": 1, "unitResultID": "a"}',), ("{oops",)], "payload string")
    with pytest.raises(Exception, match="not a JSON object"):
        stages.load_raw(store, spec, bad)
    assert not store.exists(stages.raw_table(spec))


def test_offline_run_from_json_array(spark, events, scratch):
    store = Store(spark, f"{scratch}/tables")
    spec = auction_spec(reject_policy="quarantine")
    records = [json.loads(r["payload"]) for r in auction_feed(events.filter("event_id < 50")).collect()]
    path = f"{scratch}/fixture.json"
    with open(path, "w") as fh:
        json.dump(records, fh)
    out = stages.run_from_json_array(store, spec, path, f"{scratch}/landing")
    assert out["load_raw"].rows_written == 49  # one record has a null key
    assert out["validate"].rows_written + out["validate"].rows_rejected == 49
    assert out["transform"].rows_read == out["validate"].rows_written


def test_landing_stream_catches_up_and_replays_harmlessly(spark, events, scratch):
    store = Store(spark, f"{scratch}/tables")
    spec = auction_spec(reject_policy="quarantine")
    landing_root = f"{scratch}/landing"
    stages.extract(store, spec, auction_source(events.filter("event_id < 300")), landing_root)
    q = start_landing_stream(store, spec, f"{landing_root}/landing/{spec.name}", f"{scratch}/stream-ckpt")
    q.awaitTermination(300)
    staged = store.read(stages.staging_table(spec)).count()
    assert staged > 0
    # a new landing batch is picked up by the next catch-up run (incremental validate)
    stages.extract(store, spec, auction_source(events.filter("event_id < 400")), landing_root)
    q = start_landing_stream(store, spec, f"{landing_root}/landing/{spec.name}", f"{scratch}/stream-ckpt")
    q.awaitTermination(300)
    grown = store.read(stages.staging_table(spec)).count()
    full = Store(spark, f"{scratch}/full")
    stages.load_raw(full, spec, auction_feed(events.filter("event_id < 400")).select("payload"))
    stages.validate(full, spec)
    assert grown == full.read(stages.staging_table(spec)).count()
    staged = grown
    # a second catch-up run with no new files changes nothing
    q = start_landing_stream(store, spec, f"{landing_root}/landing/{spec.name}", f"{scratch}/stream-ckpt")
    q.awaitTermination(300)
    assert store.read(stages.staging_table(spec)).count() == staged


def test_second_source_and_create_tables_and_report(spark, scratch):
    from tidemark.sources.feeds import orders_source
    from tidemark.specs import orders_spec

    store = Store(spark, f"{scratch}/tables")
    spec = orders_spec()
    stages.create_tables(store, spec)
    stages.create_tables(store, spec)  # idempotent
    assert store.read(stages.staging_table(spec)).count() == 0
    assert stages.current_watermark(store, spec) is None  # empty raw = cold start
    orders = spark.read.parquet(f"{SF_SMALL}/orders.parquet")
    out = stages.run_stages(store, spec, orders_source(orders), f"{scratch}/landing")
    n = orders.filter("o_orderkey > 0").count()  # a cold start never reads cursors <= 0
    assert out["load_raw"].rows_written == n and out["validate"].rows_written == n
    staging = store.read(stages.staging_table(spec))
    assert dict(staging.dtypes)["o_totalprice"] == "decimal(14,2)"
    rep = stages.report(store, spec)
    assert json.loads(rep["freshness"].first()["value"])["source"] == "orders"
    assert rep["recent_runs"].count() == 4


def test_field_hooks_and_mart_steps(spark, events, scratch):
    import dataclasses

    from tidemark.spec import Contract

    spec = auction_spec(reject_policy="quarantine")
    fields = tuple(
        dataclasses.replace(r, clean=F.upper, check=lambda c: F.when(F.length(c) > 3, F.lit("too long")))
        if r.name == "auction_unit"
        else r
        for r in spec.contract.fields
    )
    spec = dataclasses.replace(
        spec,
        contract=Contract(fields),
        mart_steps=(("unit_counts", lambda s: s.groupBy("auction_unit").count()),),
    )
    store = Store(spark, f"{scratch}/tables")
    stages.load_raw(store, spec, auction_feed(events.filter("event_id < 200")).select("payload"))
    stages.validate(store, spec)
    stages.transform(store, spec)
    assert store.read("unit_counts").count() > 0
    reasons = {r["reason"] for r in stages.rejects(store).collect()}
    assert "auction_unit: too long" in reasons  # units "U-10" and up fail the hook check
    staged = store.read(stages.staging_table(spec)).select("auction_unit").distinct().collect()
    assert staged and all(len(r["auction_unit"]) <= 3 for r in staged)


def test_compact_keeps_rows(spark, scratch):
    store = Store(spark, f"{scratch}/tables")
    for i in range(3):
        store.append("t", spark.createDataFrame([(i, f"v{i}")], "k long, v string"))
    before = sorted(tuple(r) for r in store.read("t").collect())
    path = store.compact("t", 1)
    assert path.rpartition("/")[2].startswith("v000001-")
    assert sorted(tuple(r) for r in store.read("t").collect()) == before
    assert Store(spark, f"{scratch}/tables").current("t")[0] == 1  # a fresh reader sees the new version


def _rec(**kw):
    base = {
        "_id": 1, "unitResultID": "k", "registeredAuctionParticipant": "P", "auctionUnit": "U",
        "serviceType": "S", "auctionProduct": "X", "executedQuantity": "1", "clearingPrice": "2",
        "deliveryStart": "2026-04-01T07:30:00", "deliveryEnd": "2026-04-01T08:00:00",
    }
    base.update(kw)
    return json.dumps(base)


def _lines(spark, *payloads):
    return spark.createDataFrame([(p,) for p in payloads], "payload string")


def test_duplicate_cursor_is_rejected_with_insert_prefix(spark, scratch):
    store = Store(spark, f"{scratch}/tables")
    spec = auction_spec(reject_policy="quarantine")
    stages.load_raw(
        store, spec,
        _lines(spark, _rec(_id=5, unitResultID="a", deliveryStart="2026-04-01T01:00:00"),
               _rec(_id=5, unitResultID="b", deliveryStart="2026-04-01T02:00:00")),
    )
    out = stages.validate(store, spec)
    assert (out.rows_written, out.rows_rejected) == (1, 1)
    (rej,) = stages.rejects(store).collect()
    assert rej["reason"] == "staging insert failed: _id: duplicate cursor" and '"b"' in rej["raw_payload"]
    # a later batch reusing a staged cursor is rejected too
    stages.load_raw(store, spec, _lines(spark, _rec(_id=5, unitResultID="c", deliveryStart="2026-04-01T03:00:00")))
    out = stages.validate(store, spec)
    assert out.rows_written == 0 and out.rows_rejected == 2  # 'b' re-read, 'c' new


def test_cleaned_key_collision_keeps_first_and_rereads_the_other(spark, scratch):
    # Q4: anti-join on the raw key, dedup on the cleaned key.
    store = Store(spark, f"{scratch}/tables")
    spec = auction_spec(reject_policy="quarantine")
    stages.load_raw(
        store, spec,
        _lines(spark, _rec(_id=1, unitResultID="X"), _rec(_id=2, unitResultID="X\t", deliveryStart="2026-04-01T09:00:00")),
    )
    first = stages.validate(store, spec)
    assert (first.rows_read, first.rows_written, first.rows_rejected, first.rows_duplicate) == (2, 1, 0, 1)
    (row,) = store.read(stages.staging_table(spec)).collect()
    assert row["unit_result_id"] == "X" and row["_id"] == 1
    again = stages.validate(store, spec)  # the 'X\t' raw row is pending again and again ignored
    assert (again.rows_read, again.rows_written, again.rows_duplicate) == (1, 0, 1)


def test_fractional_cursor_loads_truncated_but_fails_the_contract(spark, scratch):
    # Q22: the load truncates 3.7 to 3; the contract rejects a fractional _id.
    store = Store(spark, f"{scratch}/tables")
    spec = auction_spec(reject_policy="quarantine")
    stages.load_raw(store, spec, _lines(spark, _rec(_id=3.7, unitResultID="f")))
    assert store.read(stages.raw_table(spec)).first()["_id"] == 3
    out = stages.validate(store, spec)
    assert out.rows_rejected == 1
    assert stages.rejects(store).first()["reason"] == "id_: not an integer"


def test_incremental_validate_equals_full(spark, events, scratch):
    spec = auction_spec(reject_policy="quarantine")
    full, inc = Store(spark, f"{scratch}/full"), Store(spark, f"{scratch}/inc")
    collide = _lines(spark, _rec(_id=900001, unitResultID="5#||#view#||#5\t"))  # Q4: collides after trimming
    batches = [
        auction_feed(events.filter("event_id < 400")).select("payload"),
        auction_feed(events.filter("event_id >= 300 and event_id < 700")).select("payload").unionByName(collide),
        auction_feed(events.filter("event_id >= 650")).select("payload"),
    ]
    reads = []
    for batch in batches:
        stages.load_raw(full, spec, batch)
        stages.load_raw(inc, spec, batch)
        a = stages.validate(full, spec)
        b = stages.validate(inc, spec, incremental=True)
        reads.append(b.rows_read)
        assert (a.rows_read, a.rows_written, a.rows_rejected) == (b.rows_read, b.rows_written, b.rows_rejected)
    rows = lambda st: sorted(tuple(r) for r in st.read(stages.staging_table(spec)).drop("ingested_at", "extract_run_id").collect())
    assert rows(full) == rows(inc)
    assert stages.rejects(full).count() == stages.rejects(inc).count()
    carry = inc.read(stages.carry_table(spec)).count()
    assert carry == reads[-1] - stages.runs(inc).filter("stage = 'validate'").orderBy(F.col("started_at").desc()).first()["rows_written"]


def test_quirks_q8_q10_q17(spark, scratch):
    store = Store(spark, f"{scratch}/tables")
    spec = auction_spec(reject_policy="quarantine")
    load = stages.load_raw(
        store, spec,
        _lines(spark,
               _rec(_id=1, unitResultID="a", technologyType="a", clearingPrice="-13.22"),
               _rec(_id=2, unitResultID="b", technologyType="B", deliveryStart="2026-04-01T09:00:00")),
    )
    # Q8: raw.extract_run_id holds the load run's id
    assert {r["extract_run_id"] for r in stages.read_raw(store, spec).collect()} == {load.run_id}
    stages.validate(store, spec)
    stages.transform(store, spec)
    # Q17: a negative price is real data, no sign rule
    prices = [r["clearing_price_gbp_per_mw_h"] for r in store.read("fact_auction_result").collect()]
    assert min(prices) < 0
    # Q10: max over text is binary order ('a' > 'B')
    (dim,) = store.read("dim_unit").collect()
    assert dim["technology_type"] == "a"


def test_failed_extract_keeps_zero_counters(spark, scratch):
    # Q20: on extract failure counters stay 0 and the watermark after stays NULL
    store = Store(spark, f"{scratch}/tables")
    spec = auction_spec()

    def broken(watermark):
        return spark.createDataFrame([("{}", 1)], "payload string, cursor long").select(
            F.raise_error(F.lit("source down")).cast("string").alias("payload"), "cursor"
        )

    with pytest.raises(Exception, match="source down"):
        stages.extract(store, spec, broken, f"{scratch}/landing")
    (run,) = stages.runs(store).collect()
    assert run["status"] == "failed" and run["rows_read"] == 0 and run["watermark_after"] is None
    assert "source down" in run["error"]


def test_run_stages_incremental_twice(spark, events, scratch):
    store = Store(spark, f"{scratch}/tables")
    spec = auction_spec(reject_policy="quarantine")
    first = stages.run_stages(store, spec, auction_source(events), f"{scratch}/landing", incremental=True)
    second = stages.run_stages(store, spec, auction_source(events), f"{scratch}/landing", incremental=True)
    assert second["validate"].rows_read == first["validate"].rows_rejected  # only carried-over rejects
    assert second["validate"].rows_written == 0
    assert store.read("fact_auction_result").count() == first["validate"].rows_written


# -- nothing lost, nothing twice ---------------------------------------------------------
def _record(key, cursor, **changes) -> str:
    body = {
        "_id": cursor, "unitResultID": key, "registeredAuctionParticipant": "P", "auctionUnit": f"U{cursor}", "serviceType": "S",
        "auctionProduct": "A", "executedQuantity": "1", "clearingPrice": "2", "deliveryStart": "2031-01-01T00:00:00",
        "deliveryEnd": "2031-01-01T01:00:00", "technologyType": None, "postCode": None,
    }
    return json.dumps(body | changes)


def _lines(spark, *records):
    return spark.createDataFrame([(r,) for r in records], "payload string")


def _staged(store, spec):
    return sorted((r["unit_result_id"], r["_id"]) for r in store.read(stages.staging_table(spec)).collect())


def test_digit_run_ids_are_read_by_incremental_validate(spark, scratch):
    store, spec = Store(spark, f"{scratch}/tables"), auction_spec(reject_policy="quarantine")
    stages.create_tables(store, spec)
    stages.validate(store, spec, incremental=True)  # raw was just created
    for k, run_id in enumerate(("0001", "0002", "2024-01-01", "1e5"), 1):
        stages.load_raw(store, spec, _lines(spark, _record(f"k{k}", k)), run_id=run_id)
        if k != 3:
            assert stages.validate(store, spec, incremental=True).rows_written == (2 if k == 4 else 1)
    assert _staged(store, spec) == [(f"k{k}", k) for k in range(1, 5)]


def test_a_rejected_cursor_does_not_hold_back_the_next_row_of_its_key(spark, scratch):
    store, spec = Store(spark, f"{scratch}/tables"), auction_spec(reject_policy="quarantine")
    stages.load_raw(store, spec, _lines(spark, _record("W", 5)))
    stages.validate(store, spec)
    stages.load_raw(store, spec, _lines(spark, _record("X", 5), _record("X\t", 6)))
    result = stages.validate(store, spec)
    assert (result.rows_read, result.rows_written, result.rows_rejected) == (2, 1, 1)
    assert _staged(store, spec) == [("W", 5), ("X", 6)]
    stages.load_raw(store, spec, _lines(spark, _record("A", 8), _record("B", 8), _record("B ", 9), _record("A ", 10)))
    result = stages.validate(store, spec)
    assert (result.rows_written, result.rows_rejected) == (2, 1)
    assert _staged(store, spec) == [("A", 8), ("B", 9), ("W", 5), ("X", 6)]


def test_crash_before_registration_leaves_nothing_visible(spark, scratch, monkeypatch):
    store, spec = Store(spark, f"{scratch}/tables"), auction_spec(reject_policy="quarantine")
    register = Store._register

    def crash(self, entries):
        if any(t == stages.raw_table(spec) for t, _, _ in entries):
            raise RuntimeError("power cut")
        register(self, entries)

    monkeypatch.setattr(Store, "_register", crash)
    batch = _lines(spark, _record("a", 1), _record("b", 2), _record("c", 3, clearingPrice="x"))
    with pytest.raises(RuntimeError, match="power cut"):
        stages.load_raw(store, spec, batch)
    monkeypatch.setattr(Store, "_register", register)
    again = Store(spark, f"{scratch}/tables")
    stages.load_raw(again, spec, batch)
    stages.validate(again, spec)
    assert sorted(r["unit_result_id"] for r in again.read(stages.raw_table(spec)).collect()) == ["a", "b", "c"]
    assert _staged(again, spec) == [("a", 1), ("b", 2)]
    assert stages.rejects(again).count() == 1


@pytest.mark.parametrize("line", ["[1,2]", "5", '"text"', "null"])
def test_a_line_that_is_no_object_fails_the_load(spark, scratch, line):
    store, spec = Store(spark, f"{scratch}/tables"), auction_spec()
    with pytest.raises(Exception, match="not a JSON object"):
        stages.load_raw(store, spec, _lines(spark, _record("a", 1), line))
    assert not store.exists(stages.raw_table(spec))


def test_all_drift_keys_and_whole_errors_are_stored(spark, scratch):
    store, spec = Store(spark, f"{scratch}/tables"), auction_spec(reject_policy="quarantine")
    stages.load_raw(store, spec, _lines(spark, _record("a", 1, **{f"extra{k}": k for k in range(150)})))
    stages.validate(store, spec)
    assert store.read(stages.DRIFT).count() == 150
    run = stages._Run(store, spec, "load_raw", None)
    run.failure("x" * 5000)
    assert max(len(r["error"] or "") for r in stages.runs(store).collect()) == 5000


def test_transform_without_news_publishes_nothing(spark, scratch):
    store, spec = Store(spark, f"{scratch}/tables"), auction_spec(reject_policy="quarantine")
    stages.load_raw(store, spec, _lines(spark, _record("a", 1), _record("b", 2)))
    stages.validate(store, spec)
    assert stages.transform(store, spec).rows_written == 4
    before = {t: store.pointers(t) for t in (spec.dim.name, spec.fact.name)}
    again = stages.transform(Store(spark, f"{scratch}/tables"), spec)
    assert (again.rows_read, again.rows_written) == (2, 0)
    assert {t: Store(spark, f"{scratch}/tables").pointers(t) for t in before} == before
    stages.load_raw(store, spec, _lines(spark, _record("c", 3)))
    stages.validate(store, spec)
    assert stages.transform(store, spec).rows_written == 6
    assert stages.transform(store, spec, force=True).rows_written == 6
