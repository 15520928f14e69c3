"""Source-shaped JSON records derived from the driver tables (test and bench binding).

``auction_feed`` turns each ``events`` row into an auction-result record, with
dirty values injected by ``event_id % 50`` so every contract rule is
exercised; ``orders_feed`` renders ``orders`` rows as a second source. Both
are single projections (plus one bounded explode). The driver tables are single
files, so their rows are dealt out by key before the JSON work; adaptive
execution sets the number of partitions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Injection plan, by event_id % 50.
BAD_PRICE = 7  # clearingPrice 'not a number'
NO_PRICE = 11  # clearingPrice absent
BLANK_PARTICIPANT = 13  # registeredAuctionParticipant '  \t '
TABBED_UNIT = 17  # auctionUnit with trailing '\t\t'
EXTRA_KEY = 19  # one unknown key extraField<user_id % 3>
NULL_START = 23  # deliveryStart null
HUGE_QUANTITY = 29  # executedQuantity '123456789.0' (overflows numeric(12,4))
NULL_KEY = 31  # unitResultID null (skipped at load)
REISSUED = 37  # a second copy of the record with _id + 1,000,000
OFFSET_START = 41  # deliveryStart with '+01:00'
BLANK_TECHNOLOGY = 43  # technologyType '   '
NUMERIC_QUANTITY = 47  # executedQuantity as a JSON number
NULL_POSTCODE_EVERY = 7  # postCode null when event_id % 7 = 0
REISSUE_SHIFT = 1_000_000
KEY_SEPARATOR = "#||#"

# Service type by event type (any other type: 'Quick Reserve').
SERVICE_BY_TYPE = (
    ("view", "Dynamic Containment"),
    ("click", "Dynamic Moderation"),
    ("purchase", "Dynamic Regulation"),
    ("signup", "Slow Reserve"),
)
OTHER_SERVICE = "Quick Reserve"
ISO_NAIVE = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def _service(event_type: Column) -> Column:
    expr = None
    for t, s in SERVICE_BY_TYPE:
        expr = F.when(event_type == t, F.lit(s)) if expr is None else expr.when(event_type == t, F.lit(s))
    return expr.otherwise(F.lit(OTHER_SERVICE))


def auction_feed(events: DataFrame) -> DataFrame:
    """``events`` -> ``payload`` (JSON text) plus ``event_id`` and the record's ``_id``.

    Mapping: _id = event_id + 1; key = user_id#||#event_type#||#event_id;
    unit 'U-'||user_id; participant 'P-'||user_id%10; product = event_type;
    quantity = props.k as text; price = value as text; start = ts (ISO, UTC);
    end = start + 30 min (4 h for 'view'); technology 'T-'||user_id%6;
    postcode 'PC-'||user_id.

    One ``to_json`` per record (nulls kept); the few rows whose shape differs
    (absent key, numeric quantity, extra key) get a row-local text edit.
    """
    m = F.col("event_id") % 50
    uid = F.col("user_id")
    start_iso = F.date_format("ts", ISO_NAIVE)
    end_ts = F.when(F.col("event_type") == "view", F.col("ts") + F.expr("INTERVAL 4 HOURS")).otherwise(
        F.col("ts") + F.expr("INTERVAL 30 MINUTES")
    )
    key = F.concat_ws(KEY_SEPARATOR, uid.cast("string"), F.col("event_type"), F.col("event_id").cast("string"))
    unit = F.concat(F.lit("U-"), uid.cast("string"))
    record = F.struct(
        F.col("__cursor").alias("_id"),
        F.when(m != NULL_KEY, key).alias("unitResultID"),
        F.when(m == BLANK_PARTICIPANT, F.lit("  \t ")).otherwise(
            F.concat(F.lit("P-"), (uid % 10).cast("string"))
        ).alias("registeredAuctionParticipant"),
        F.when(m == TABBED_UNIT, F.concat(unit, F.lit("\t\t"))).otherwise(unit).alias("auctionUnit"),
        _service(F.col("event_type")).alias("serviceType"),
        F.col("event_type").alias("auctionProduct"),
        F.when(m == HUGE_QUANTITY, F.lit("123456789.0"))
        .otherwise(F.get_json_object("props", "$.k"))
        .alias("executedQuantity"),
        F.when(m == BAD_PRICE, F.lit("not a number")).otherwise(F.col("value").cast("string")).alias("clearingPrice"),
        F.when(m == NULL_START, F.lit(None).cast("string"))
        .when(m == OFFSET_START, F.concat(start_iso, F.lit("+01:00")))
        .otherwise(start_iso)
        .alias("deliveryStart"),
        F.date_format(end_ts, ISO_NAIVE).alias("deliveryEnd"),
        F.when(m == BLANK_TECHNOLOGY, F.lit("   "))
        .otherwise(F.concat(F.lit("T-"), (uid % 6).cast("string")))
        .alias("technologyType"),
        F.when(F.col("event_id") % NULL_POSTCODE_EVERY != 0, F.concat(F.lit("PC-"), uid.cast("string"))).alias(
            "postCode"
        ),
    )
    body = F.col("__body")
    payload = (
        F.when(m == NO_PRICE, F.regexp_replace(body, r',"clearingPrice":"[^"]*"', ""))
        .when(m == NUMERIC_QUANTITY, F.regexp_replace(body, r'"executedQuantity":"([0-9]+)"', '"executedQuantity":$1'))
        .when(
            m == EXTRA_KEY,
            F.concat(
                F.expr("substring(__body, 1, length(__body) - 1)"),
                F.lit(',"extraField'),
                (uid % 3).cast("string"),
                F.lit('":1}'),
            ),
        )
        .otherwise(body)
    )
    cursors = F.when(m == REISSUED, F.array(F.col("event_id") + 1, F.col("event_id") + 1 + REISSUE_SHIFT)).otherwise(
        F.array(F.col("event_id") + 1)
    )
    exploded = events.repartition("event_id").select(
        "event_id", "user_id", "event_type", "ts", "value", "props", F.explode(cursors).alias("__cursor")
    )
    with_body = exploded.select(
        "event_id", "user_id", F.col("__cursor"), F.to_json(record, {"ignoreNullFields": "false"}).alias("__body")
    )
    return with_body.select(F.col("event_id"), F.col("__cursor").alias("_id"), payload.alias("payload"))


def auction_source(events: DataFrame):
    """A source (see ``plans.stages.Fetch``) over ``events``: records with _id > watermark.

    The scan predicate is a superset written on ``event_id`` so it reaches the
    Parquet reader; the exact cursor test runs after the (re-issue) explode.
    """

    def fetch(watermark: int | None) -> DataFrame:
        wm = watermark or 0
        rows = events.filter(F.col("event_id") > F.lit(wm - 1 - REISSUE_SHIFT))
        feed = auction_feed(rows)
        return feed.filter(F.col("_id") > F.lit(wm)).select("payload", F.col("_id").alias("cursor"))

    return fetch


def orders_source(orders: DataFrame):
    """A source over ``orders`` with o_orderkey as the cursor."""

    def fetch(watermark: int | None) -> DataFrame:
        rows = orders.filter(F.col("o_orderkey") > F.lit(watermark or 0))
        return orders_feed(rows).select("payload", F.col("o_orderkey").alias("cursor"))

    return fetch


def orders_feed(orders: DataFrame) -> DataFrame:
    """``orders`` rows as JSON records (all columns, nulls kept, dates as ISO text)."""
    record = F.struct(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice",
        F.date_format("o_orderdate", ISO_NAIVE).alias("o_orderdate"), "o_orderpriority",
    )
    return orders.repartition("o_orderkey").select(
        F.col("o_orderkey"), F.to_json(record, {"ignoreNullFields": "false"}).alias("payload")
    )
