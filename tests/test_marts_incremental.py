"""Marts merged from new staging rows only: equal to a full rebuild, reading and replacing what the rows touch."""

from __future__ import annotations

import json

import pytest

from tidemark.operators import checks
from tidemark.plans import stages
from tidemark.plans.store import Store
from tidemark.specs import auction_spec

FACT, DIM = "fact_auction_result", "dim_unit"


def rec(k, unit="U", start="2026-04-01T07:30:00", **kw):
    base = {
        "_id": k, "unitResultID": f"k{k}", "registeredAuctionParticipant": "P", "auctionUnit": unit, "serviceType": "S", "auctionProduct": "X",
        "executedQuantity": "1", "clearingPrice": str(k), "deliveryStart": start, "deliveryEnd": "2026-12-01T08:00:00", "technologyType": f"T{k % 3}", "postCode": None,
    }
    return json.dumps({**base, **kw})


def load(store, spec, *payloads, incremental=True):
    stages.load_raw(store, spec, store.spark.createDataFrame([(p,) for p in payloads], "payload string"))
    return stages.validate(store, spec, incremental=incremental)


def rows(store, table):
    df = store.read(table)
    return sorted(map(str, df.select(*sorted(df.columns)).collect()))


@pytest.fixture()
def spec():
    return auction_spec(reject_policy="quarantine")


BATCHES = [
    [rec(1), rec(2, "V", "2026-05-02T00:00:00"), rec(3, "W", "2026-05-03T00:00:00", postCode="A")],
    [rec(2, "V", "2026-05-02T00:00:00"), rec(4, "U", "2026-05-09T00:00:00", postCode="B"), rec(5, "  ", "2026-05-09T00:00:00")],
    [rec(6, "N", "2026-03-31T23:59:59"), rec(7, "U", "2026-06-30T23:00:00", registeredAuctionParticipant="Q"), rec(8, "W", "2026-05-05T00:00:00", technologyType=None)],
]


def test_three_batches_equal_a_full_rebuild(spark, scratch, spec):
    new, full = Store(spark, f"{scratch}/new"), Store(spark, f"{scratch}/full")
    for batch in BATCHES:
        load(new, spec, *batch)
        out = stages.transform(new, spec, incremental=True)
        load(full, spec, *batch)
        stages.transform(full, spec)
        assert rows(new, FACT) == rows(full, FACT) and rows(new, DIM) == rows(full, DIM)
    assert out.rows_read == 3
    assert set(new.pointers(FACT)) == {"2026-03", "2026-04", "2026-05", "2026-06"}
    # a full run over the merged marts, and merging again after it, change nothing
    before = rows(new, FACT), rows(new, DIM)
    stages.transform(new, spec, force=True)
    assert stages.transform(new, spec, incremental=True).rows_read == 0
    assert (rows(new, FACT), rows(new, DIM)) == before


def test_months_without_new_rows_keep_their_files(spark, scratch, spec):
    store = Store(spark, f"{scratch}/t")
    load(store, spec, *BATCHES[0])
    stages.transform(store, spec, incremental=True)
    first = dict(store.pointers(FACT))
    files = set(store.read(FACT, parts=["2026-05"]).inputFiles())
    load(store, spec, rec(9, "U", "2026-04-20T00:00:00"))
    out = stages.transform(store, spec, incremental=True)
    assert out.rows_read == 1
    assert store.pointers(FACT)["2026-05"] == first["2026-05"] and store.pointers(FACT)["2026-04"] != first["2026-04"]
    assert set(store.read(FACT, parts=["2026-05"]).inputFiles()) == files
    assert store.read(FACT).count() == 4 == Store(spark, f"{scratch}/t").read(FACT).count()
    assert not set(store.read(FACT, parts=["2026-04"]).inputFiles()) & files


def test_only_the_new_run_of_staging_is_scanned(spark, scratch, spec):
    store = Store(spark, f"{scratch}/t")
    load(store, spec, *BATCHES[0])
    stages.transform(store, spec, incremental=True)
    run = load(store, spec, *BATCHES[1]).run_id
    assert stages.unmerged_runs(store, spec) == [run]
    fresh = stages.staged_by(store, spec, [run])
    plan = fresh._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and run in plan
    scanned = fresh.selectExpr("_metadata.file_path AS f").distinct().collect()
    assert scanned and all(f"layout_run={run}/" in r["f"] for r in scanned)
    assert fresh.count() == 1 and "layout_run" not in store.read(stages.staging_table(spec)).columns


def test_a_grain_that_an_earlier_row_holds_stops_the_merge(spark, scratch, spec):
    store = Store(spark, f"{scratch}/t")
    load(store, spec, *BATCHES[0])
    stages.transform(store, spec, incremental=True)
    before, pointers = (rows(store, FACT), rows(store, DIM)), dict(store.pointers(FACT))
    load(store, spec, rec(10, "V", "2026-05-02T00:00:00"))  # the grain of k2
    for incremental in (True, False):
        with pytest.raises(checks.GrainViolation, match="1 values"):
            stages.transform(store, spec, incremental=incremental)
    assert (rows(store, FACT), rows(store, DIM)) == before and dict(store.pointers(FACT)) == pointers
    assert [r["status"] for r in stages.runs(store).filter("stage = 'transform'").orderBy("started_at").collect()] == ["success", "failed", "failed"]


def test_a_merge_that_fails_before_publishing_is_done_by_the_next(spark, scratch, spec, monkeypatch):
    store = Store(spark, f"{scratch}/t")
    load(store, spec, *BATCHES[0])
    with monkeypatch.context() as m:
        m.setattr(Store, "_register", lambda self, entries, parts=(): (_ for _ in ()).throw(OSError("lost")) if parts else None)
        with pytest.raises(OSError, match="lost"):
            stages.transform(store, spec, incremental=True)
    store.refresh()
    assert not store.exists(FACT) and len(stages.unmerged_runs(store, spec)) == 1
    assert stages.transform(store, spec, incremental=True).rows_read == 3
    assert store.read(FACT).count() == 3


def test_a_rewritten_staging_is_merged_again_to_the_same_marts(spark, scratch, spec):
    store = Store(spark, f"{scratch}/t")
    stages.create_tables(store, spec)
    for batch in BATCHES[:2]:
        load(store, spec, *batch)
        stages.transform(store, spec, incremental=True)
    before = rows(store, FACT), rows(store, DIM)
    store.compact(stages.staging_table(spec))
    assert len([n for n in store.layout(stages.staging_table(spec)) if not n.endswith("=none")]) == 2  # still by run
    assert len(stages.unmerged_runs(store, spec)) == 2
    stages.transform(store, spec, incremental=True)
    assert (rows(store, FACT), rows(store, DIM)) == before
    load(store, spec, *BATCHES[2])
    assert stages.transform(store, spec, incremental=True).rows_read == 3


def test_month_must_belong_to_the_grain():
    from tidemark.spec import FactSpec

    with pytest.raises(ValueError, match="no column of the grain"):
        FactSpec("f", ("a",), ("t",), month_of="t")
