"""Source specifications: the auction-results source and a second (orders) source."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions.time import local_wall_clock
from tidemark.spec import DECIMAL, INTEGER, STRING, TIMESTAMP, Contract, DimSpec, FactSpec, FieldRule, SourceSpec

# Auction-result record contract. Staging column names and the
# source keys (aliases) they are read from, in staging order.
AUCTION_FIELDS = (
    FieldRule("id_", INTEGER, alias="_id", staged=False),
    FieldRule("unit_result_id", STRING, alias="unitResultID"),
    FieldRule("registered_auction_participant", STRING, alias="registeredAuctionParticipant"),
    FieldRule("auction_unit", STRING, alias="auctionUnit"),
    FieldRule("service_type", STRING, alias="serviceType"),
    FieldRule("auction_product", STRING, alias="auctionProduct"),
    FieldRule("executed_quantity_mw", DECIMAL, alias="executedQuantity", precision=12, scale=4),
    FieldRule("clearing_price_gbp_per_mw_h", DECIMAL, alias="clearingPrice", precision=12, scale=4),
    FieldRule("delivery_start_utc", TIMESTAMP, alias="deliveryStart"),
    FieldRule("delivery_end_utc", TIMESTAMP, alias="deliveryEnd"),
    FieldRule("technology_type", STRING, alias="technologyType", required=False),
    FieldRule("post_code", STRING, alias="postCode", required=False),
)

# Fixed value: wall-clock zone of the derived local delivery start.
LOCAL_ZONE = "Europe/London"

AUCTION_DIM = DimSpec(
    name="dim_unit",
    key="auction_unit",
    attributes=("technology_type", "post_code", "registered_auction_participant"),
    seen_column="delivery_start_utc",
)

AUCTION_FACT = FactSpec(
    name="fact_auction_result",
    grain=("auction_unit", "auction_product", "delivery_start_utc"),
    columns=(
        "service_type",
        "delivery_end_utc",
        "executed_quantity_mw",
        "clearing_price_gbp_per_mw_h",
        "unit_result_id",
    ),
    dim_key="auction_unit",
    month_of="delivery_start_utc",
)


def auction_spec(reject_policy: str = "fail", extra: str = "ignore", name: str = "auction_results") -> SourceSpec:
    return SourceSpec(
        name=name,
        contract=Contract(AUCTION_FIELDS, extra=extra),
        key_field="unitResultID",
        cursor_field="_id",
        business_key="unit_result_id",
        cursor="_id",
        reject_policy=reject_policy,
        clean_columns=("registered_auction_participant", "auction_unit", "service_type", "auction_product"),
        nullable_clean_columns=("technology_type", "post_code"),
        derived=(("delivery_start_uk", lambda: local_wall_clock(F.col("delivery_start_utc"), LOCAL_ZONE)),),
        dim=AUCTION_DIM,
        fact=AUCTION_FACT,
        freshness_delivery="delivery_start_utc",
    )


ORDER_FIELDS = (
    FieldRule("o_orderkey", INTEGER),
    FieldRule("o_custkey", INTEGER),
    FieldRule("o_orderstatus", STRING),
    FieldRule("o_totalprice", DECIMAL, precision=14, scale=2),
    FieldRule("o_orderdate", TIMESTAMP),
    FieldRule("o_orderpriority", STRING),
)


def orders_spec(reject_policy: str = "quarantine") -> SourceSpec:
    """A second source: same stages, its own contract; the order key is cursor and key."""
    return SourceSpec(
        name="orders",
        contract=Contract(ORDER_FIELDS, extra="forbid"),
        key_field="o_orderkey",
        cursor_field="o_orderkey",
        business_key="o_orderkey",
        cursor="_id",
        reject_policy=reject_policy,
        clean_columns=("o_orderstatus", "o_orderpriority"),
        freshness_delivery="o_orderdate",
    )
