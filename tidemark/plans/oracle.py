"""DuckDB SQL that computes each registered query independently from the typed tables.

The oracle never parses the Spark-made JSON: it rebuilds the feed's text
values from ``events`` columns (same injection plan) and applies the contract
rules with ``TRY_CAST``, ``trim`` and ``regexp_full_match``.
"""

from __future__ import annotations

from tidemark.plans import queries as Q
from tidemark.plans import stage_queries as S
from tidemark.spec import DECIMAL

WS = "(' ' || chr(9) || chr(13) || chr(10))"
NUM_RE = r"'[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]+)?'"


def _ts(value) -> str:
    return f"TIMESTAMP '{value.isoformat(sep=' ')}'"


FEED = f"""
ev AS (SELECT *, event_id % 50 AS m FROM events),
feed AS (
  SELECT *, unnest(CASE WHEN m = 37 THEN [event_id + 1, event_id + 1 + 1000000] ELSE [event_id + 1] END) AS _id
  FROM ev
),
keyed AS (
  SELECT *,
    CASE WHEN m <> 31 THEN CAST(user_id AS VARCHAR) || '#||#' || event_type || '#||#' || CAST(event_id AS VARCHAR) END AS raw_key,
    CASE WHEN m = 13 THEN '  ' || chr(9) || ' ' ELSE 'P-' || CAST(user_id % 10 AS VARCHAR) END AS participant_txt,
    'U-' || CAST(user_id AS VARCHAR) || CASE WHEN m = 17 THEN chr(9) || chr(9) ELSE '' END AS unit_txt,
    CASE event_type WHEN 'view' THEN 'Dynamic Containment' WHEN 'click' THEN 'Dynamic Moderation'
      WHEN 'purchase' THEN 'Dynamic Regulation' WHEN 'signup' THEN 'Slow Reserve' ELSE 'Quick Reserve' END AS service_txt,
    event_type AS product_txt,
    CASE WHEN m = 29 THEN '123456789.0' ELSE json_extract_string(props, '$.k') END AS quantity_txt,
    CASE WHEN m = 11 THEN NULL WHEN m = 7 THEN 'not a number' ELSE CAST(value AS VARCHAR) END AS price_txt,
    CASE WHEN m = 23 THEN NULL WHEN m = 41 THEN ts - INTERVAL 1 HOUR ELSE ts END AS start_utc,
    ts + CASE WHEN event_type = 'view' THEN INTERVAL 4 HOUR ELSE INTERVAL 30 MINUTE END AS end_utc,
    CASE WHEN m = 43 THEN '   ' ELSE 'T-' || CAST(user_id % 6 AS VARCHAR) END AS technology_txt,
    CASE WHEN event_id % 7 <> 0 THEN 'PC-' || CAST(user_id AS VARCHAR) END AS post_code_txt
  FROM feed
),
raw_rows AS (
  SELECT * FROM keyed WHERE raw_key IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY raw_key ORDER BY _id) = 1
),
typed AS (
  SELECT *,
    NULLIF(trim(raw_key, {WS}), '') AS unit_result_id,
    NULLIF(trim(participant_txt, {WS}), '') AS registered_auction_participant,
    NULLIF(trim(unit_txt, {WS}), '') AS auction_unit,
    NULLIF(trim(service_txt, {WS}), '') AS service_type,
    NULLIF(trim(product_txt, {WS}), '') AS auction_product,
    regexp_full_match(trim(quantity_txt, {WS}), {NUM_RE}) AS quantity_is_number,
    TRY_CAST(trim(quantity_txt, {WS}) AS DECIMAL(12,4)) AS executed_quantity_mw,
    regexp_full_match(trim(price_txt, {WS}), {NUM_RE}) AS price_is_number,
    TRY_CAST(trim(price_txt, {WS}) AS DECIMAL(12,4)) AS clearing_price_gbp_per_mw_h,
    start_utc AS delivery_start_utc,
    end_utc AS delivery_end_utc,
    NULLIF(trim(technology_txt, {WS}), '') AS technology_type,
    NULLIF(trim(post_code_txt, {WS}), '') AS post_code
  FROM raw_rows
),
checked AS (
  SELECT *,
    NULLIF(concat_ws('; ',
      CASE WHEN unit_result_id IS NULL THEN 'unit_result_id: blank' END,
      CASE WHEN registered_auction_participant IS NULL THEN 'registered_auction_participant: blank' END,
      CASE WHEN auction_unit IS NULL THEN 'auction_unit: blank' END,
      CASE WHEN service_type IS NULL THEN 'service_type: blank' END,
      CASE WHEN auction_product IS NULL THEN 'auction_product: blank' END,
      CASE WHEN quantity_txt IS NULL THEN 'executed_quantity_mw: missing'
           WHEN NOT quantity_is_number THEN 'executed_quantity_mw: not a number' END,
      CASE WHEN price_txt IS NULL THEN 'clearing_price_gbp_per_mw_h: missing'
           WHEN NOT price_is_number THEN 'clearing_price_gbp_per_mw_h: not a number' END,
      CASE WHEN delivery_start_utc IS NULL THEN 'delivery_start_utc: missing' END,
      CASE WHEN delivery_end_utc IS NULL THEN 'delivery_end_utc: missing' END
    ), '') AS contract_reason,
    NULLIF(concat_ws('; ',
      CASE WHEN quantity_is_number AND executed_quantity_mw IS NULL
           THEN 'staging insert failed: executed_quantity_mw: numeric overflow' END,
      CASE WHEN price_is_number AND clearing_price_gbp_per_mw_h IS NULL
           THEN 'staging insert failed: clearing_price_gbp_per_mw_h: numeric overflow' END
    ), '') AS insert_reason
  FROM typed
),
decided AS (
  SELECT *, COALESCE(contract_reason, insert_reason) AS reason FROM checked
),
staging AS (
  SELECT unit_result_id, _id, registered_auction_participant, auction_unit, service_type, auction_product,
    executed_quantity_mw, clearing_price_gbp_per_mw_h, delivery_start_utc, delivery_end_utc,
    timezone('{Q.LOCAL_ZONE}', timezone('UTC', delivery_start_utc)) AS delivery_start_uk,
    technology_type, post_code
  FROM decided WHERE reason IS NULL
)"""

_DECIMALS = {r.name for r in Q.AUCTION.contract.fields if r.kind == DECIMAL}
STAGING_OUT = ", ".join(f"CAST({c} AS DOUBLE) AS {c}" if c in _DECIMALS else c for c in Q._STAGING_OUT)

DIM_SQL = """SELECT auction_unit, max(technology_type) AS technology_type, max(post_code) AS post_code,
    max(registered_auction_participant) AS registered_auction_participant,
    min(delivery_start_utc) AS first_seen_utc, max(delivery_start_utc) AS last_seen_utc
  FROM {src} GROUP BY auction_unit"""

LI_ORDER = "l_partkey, l_suppkey, l_shipdate, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus"
LI_ORDER_SQL = ", ".join(f"{c} NULLS FIRST" for c in LI_ORDER.split(", "))

HOURLY_RUNS = f"""
per_hour AS (
  SELECT date_trunc('hour', ts) AS hour, count(*) AS rows_read,
    count(*) FILTER (WHERE event_id % 50 IN (7, 11, 13, 23, 29)) AS rows_rejected,
    max(ts) AS last_ts, count(*) FILTER (WHERE event_type = 'purchase') AS purchases
  FROM events GROUP BY 1
),
runs AS (
  SELECT 'run-' || strftime(hour, '%Y%m%d%H') AS run_id, '{Q.AUCTION.name}' AS source, 'validate' AS stage,
    hour AS started_at,
    CASE WHEN hour(hour) <> 23 THEN last_ts END AS ended_at,
    CASE WHEN hour(hour) = 23 THEN 'running' WHEN purchases = 0 THEN 'failed' ELSE 'success' END AS status,
    CASE WHEN hour(hour) = 23 THEN 0 ELSE rows_read END AS rows_read,
    CASE WHEN hour(hour) = 23 THEN 0 ELSE rows_read - rows_rejected END AS rows_written,
    CASE WHEN hour(hour) = 23 THEN 0 ELSE rows_rejected END AS rows_rejected,
    CASE WHEN hour(hour) <> 23 AND purchases = 0 THEN 'no purchase events' END AS error
  FROM per_hour
)"""


ORACLE: dict[str, str] = {
    "keyset_page": f"""
SELECT * FROM events WHERE event_id > {Q.KEYSET_WATERMARK} ORDER BY event_id LIMIT {Q.PAGE_SIZE}""",
    "incremental_drain": """
SELECT * FROM events WHERE event_id > 0""",
    "watermark_max": f"""
WITH {FEED}
SELECT max(_id) AS watermark, count(*) AS raw_rows FROM raw_rows""",
    "watermark_after": f"""
WITH {FEED},
page AS (SELECT _id FROM feed WHERE _id > {Q.KEYSET_WATERMARK} ORDER BY _id LIMIT {Q.EXTRACT_LIMIT})
SELECT count(*) AS rows_extracted, CAST({Q.KEYSET_WATERMARK} AS BIGINT) AS watermark_before,
  greatest(CAST({Q.KEYSET_WATERMARK} AS BIGINT), max(_id)) AS watermark_after FROM page""",
    "api_pages_unwrap": """
SELECT event_id, user_id, event_type, value, props FROM events""",
    "json_array_explode": """
SELECT event_id, user_id, event_type, value, props FROM events""",
    "load_raw_extract_keys": f"""
WITH {FEED}
SELECT raw_key AS unit_result_id, _id FROM keyed WHERE raw_key IS NOT NULL""",
    "merge_insert_only": f"""
WITH existing AS (
  SELECT * FROM lineitem WHERE l_shipdate < {_ts(Q.LINEITEM_SPLIT)}
  QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {LI_ORDER_SQL}) = 1
), batch AS (
  SELECT * FROM lineitem WHERE l_shipdate >= {_ts(Q.LINEITEM_SPLIT)}
  QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {LI_ORDER_SQL}) = 1
)
SELECT * FROM existing
UNION ALL
SELECT * FROM batch b WHERE NOT EXISTS (
  SELECT 1 FROM existing e WHERE e.l_orderkey = b.l_orderkey AND e.l_linenumber = b.l_linenumber)""",
    "reload_shift_noop": f"""
WITH {FEED},
shifted AS (SELECT raw_key, _id + {Q.REISSUE_SHIFT} AS _id FROM keyed WHERE raw_key IS NOT NULL)
SELECT (SELECT count(*) FROM raw_rows) AS raw_rows,
  (SELECT count(DISTINCT raw_key) FROM shifted s WHERE NOT EXISTS (SELECT 1 FROM raw_rows r WHERE r.raw_key = s.raw_key)) AS rows_inserted,
  (SELECT max(_id) FROM raw_rows) AS watermark""",
    "anti_join_pending": """
SELECT * FROM orders o WHERE NOT EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = o.o_orderkey)""",
    "validate_accepted": f"""
WITH {FEED}
SELECT {STAGING_OUT} FROM staging""",
    "validate_rejects": f"""
WITH {FEED}
SELECT unit_result_id, _id, reason FROM decided WHERE reason IS NOT NULL""",
    "validate_extras_forbid": f"""
WITH {FEED},
forbid AS (
  SELECT unit_result_id, _id,
    COALESCE(NULLIF(concat_ws('; ', contract_reason,
      CASE WHEN m = 19 THEN 'extra keys: extraField' || CAST(user_id % 3 AS VARCHAR) END), ''), insert_reason) AS reason
  FROM checked
)
SELECT unit_result_id, _id, reason FROM forbid WHERE reason IS NOT NULL""",
    "reject_reason_counts": f"""
WITH {FEED}
SELECT reason, count(*) AS n_rejects FROM decided WHERE reason IS NOT NULL GROUP BY reason""",
    "schema_drift_keys": f"""
WITH {FEED}
SELECT 'extraField' || CAST(user_id % 3 AS VARCHAR) AS extra_key, count(*) AS rows_with_key
FROM raw_rows WHERE m = 19 GROUP BY 1 ORDER BY 1""",
    "clean_strings": f"""
WITH {FEED}
SELECT raw_key AS unit_result_id,
  trim(participant_txt, {WS}) AS registered_auction_participant,
  trim(unit_txt, {WS}) AS auction_unit,
  trim(service_txt, {WS}) AS service_type,
  trim(product_txt, {WS}) AS auction_product,
  trim(technology_txt, {WS}) AS technology_type,
  trim(post_code_txt, {WS}) AS post_code
FROM raw_rows""",
    "clean_strings_changed": f"""
WITH {FEED}
SELECT raw_key AS unit_result_id FROM raw_rows
WHERE participant_txt <> trim(participant_txt, {WS}) OR unit_txt <> trim(unit_txt, {WS})
   OR service_txt <> trim(service_txt, {WS}) OR product_txt <> trim(product_txt, {WS})
   OR technology_txt IS DISTINCT FROM trim(technology_txt, {WS})
   OR post_code_txt IS DISTINCT FROM trim(post_code_txt, {WS})""",
    "local_wall_clock": f"""
SELECT o_orderkey, o_orderdate, timezone('{Q.LOCAL_ZONE}', timezone('UTC', o_orderdate)) AS o_orderdate_uk FROM orders""",
    "decimal_fit": """
SELECT l_orderkey, l_linenumber, l_partkey,
  CAST(TRY_CAST(l_extendedprice AS DECIMAL(12,4)) AS DOUBLE) AS price_dec,
  CAST(TRY_CAST(l_extendedprice * 1000 AS DECIMAL(12,4)) AS DOUBLE) AS price_milli_dec,
  TRY_CAST(l_extendedprice * 1000 AS DECIMAL(12,4)) IS NULL AS milli_overflow
FROM lineitem""",
    "dim_build": f"""
WITH {FEED}
{DIM_SQL.format(src="staging")}""",
    "dim_upsert": f"""
WITH {FEED},
t AS ({DIM_SQL.format(src=f"(SELECT * FROM staging WHERE delivery_start_utc < {_ts(Q.DELIVERY_SPLIT)})")}),
s AS ({DIM_SQL.format(src=f"(SELECT * FROM staging WHERE delivery_start_utc >= {_ts(Q.DELIVERY_SPLIT)})")})
SELECT COALESCE(s.auction_unit, t.auction_unit) AS auction_unit,
  CASE WHEN s.auction_unit IS NOT NULL THEN s.technology_type ELSE t.technology_type END AS technology_type,
  CASE WHEN s.auction_unit IS NOT NULL THEN s.post_code ELSE t.post_code END AS post_code,
  CASE WHEN s.auction_unit IS NOT NULL THEN s.registered_auction_participant ELSE t.registered_auction_participant END
    AS registered_auction_participant,
  least(t.first_seen_utc, s.first_seen_utc) AS first_seen_utc,
  greatest(t.last_seen_utc, s.last_seen_utc) AS last_seen_utc
FROM t FULL OUTER JOIN s ON t.auction_unit = s.auction_unit""",
    "fact_upsert": f"""
WITH {FEED},
fact AS (
  SELECT auction_unit, auction_product, delivery_start_utc, service_type, delivery_end_utc,
    executed_quantity_mw, clearing_price_gbp_per_mw_h, unit_result_id FROM staging
),
t AS (SELECT * FROM fact WHERE delivery_start_utc < {_ts(Q.DELIVERY_SPLIT + Q.OVERLAP)}),
s AS (
  SELECT auction_unit, auction_product, delivery_start_utc, service_type, delivery_end_utc, executed_quantity_mw,
    CAST(clearing_price_gbp_per_mw_h + {Q.PRICE_BUMP} AS DECIMAL(12,4)) AS clearing_price_gbp_per_mw_h, unit_result_id
  FROM fact WHERE delivery_start_utc >= {_ts(Q.DELIVERY_SPLIT - Q.OVERLAP)}
),
merged AS (
  SELECT * FROM t WHERE NOT EXISTS (
    SELECT 1 FROM s WHERE s.auction_unit = t.auction_unit AND s.auction_product = t.auction_product
      AND s.delivery_start_utc = t.delivery_start_utc)
  UNION ALL SELECT * FROM s
)
SELECT auction_unit, auction_product, delivery_start_utc, service_type, delivery_end_utc,
  CAST(executed_quantity_mw AS DOUBLE) AS executed_quantity_mw,
  CAST(clearing_price_gbp_per_mw_h AS DOUBLE) AS clearing_price_gbp_per_mw_h, unit_result_id
FROM merged""",
    "grain_violations": f"""
WITH {FEED}
SELECT 'lineitem(l_orderkey,l_linenumber)' AS grain, count(*) AS dup_groups FROM (
  SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)
UNION ALL
SELECT 'events(user_id,event_type,hour)', count(*) FROM (
  SELECT 1 FROM events GROUP BY user_id, event_type, date_trunc('hour', ts) HAVING count(*) > 1)
UNION ALL
SELECT 'fact(auction_unit,auction_product,delivery_start_utc)', count(*) FROM (
  SELECT 1 FROM staging GROUP BY auction_unit, auction_product, delivery_start_utc HAVING count(*) > 1)""",
    "uniqueness_proof": """
SELECT 'events' AS table_name, count(*) AS n_rows,
  (SELECT count(*) FROM (SELECT DISTINCT user_id, event_type, ts FROM events)) AS n_distinct,
  count(*) = (SELECT count(*) FROM (SELECT DISTINCT user_id, event_type, ts FROM events)) AS is_unique
FROM events
UNION ALL
SELECT 'lineitem', count(*),
  (SELECT count(*) FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem)),
  count(*) = (SELECT count(*) FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem))
FROM lineitem""",
    "fk_orphans": """
SELECT 'orders.o_custkey -> customer' AS fk, count(*) AS orphans FROM orders o
  WHERE o.o_custkey IS NOT NULL AND NOT EXISTS (SELECT 1 FROM customer c WHERE c.c_custkey = o.o_custkey)
UNION ALL
SELECT 'lineitem.l_orderkey -> orders', count(*) FROM lineitem l
  WHERE l.l_orderkey IS NOT NULL AND NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_orderkey = l.l_orderkey)
UNION ALL
SELECT 'lineitem.l_partkey -> part', count(*) FROM lineitem l
  WHERE l.l_partkey IS NOT NULL AND NOT EXISTS (SELECT 1 FROM part p WHERE p.p_partkey = l.l_partkey)
UNION ALL
SELECT 'lineitem.l_suppkey -> supplier', count(*) FROM lineitem l
  WHERE l.l_suppkey IS NOT NULL AND NOT EXISTS (SELECT 1 FROM supplier s WHERE s.s_suppkey = l.l_suppkey)""",
    "mart_fk_orphans": f"""
WITH {FEED}
SELECT auction_unit, count(*) AS n FROM staging
WHERE auction_unit NOT IN (SELECT auction_unit FROM staging WHERE technology_type = 'T-1') GROUP BY auction_unit""",
    "validate_duplicate_cursor": f"""
WITH {FEED},
both_rows AS (
  SELECT unit_result_id, reason, CASE WHEN event_id % 10 = 3 THEN _id - 1 ELSE _id END AS cur FROM decided
  UNION ALL SELECT unit_result_id, reason, _id + 2000000 FROM decided WHERE event_id % 10 = 3
),
owners AS (SELECT cur, min(unit_result_id) AS owner FROM both_rows WHERE reason IS NULL GROUP BY cur),
valid AS (SELECT b.unit_result_id, b.cur, b.unit_result_id = o.owner AS owns FROM both_rows b JOIN owners o ON b.cur = o.cur WHERE reason IS NULL),
inserted AS (
  SELECT unit_result_id, cur FROM valid WHERE owns
  QUALIFY row_number() OVER (PARTITION BY unit_result_id ORDER BY cur) = 1
)
SELECT unit_result_id, cur AS _id, 'insert' AS outcome, NULL AS reason FROM inserted
UNION ALL SELECT unit_result_id, cur, 'reject', 'staging insert failed: _id: duplicate cursor' FROM valid WHERE NOT owns
UNION ALL SELECT unit_result_id, cur, 'reject', reason FROM both_rows WHERE reason IS NOT NULL""",
    "validate_grammar_edges": """
SELECT event_id,
  CASE WHEN event_id % 6 IN (2, 4) THEN NULL ELSE event_id END AS i_value,
  CASE WHEN event_id % 6 = 2 THEN 'not an integer' END AS i_error,
  CASE WHEN event_id % 6 = 4 THEN 'numeric overflow' END AS i_insert_error,
  CASE WHEN event_id % 6 <> 5 THEN date_trunc('second', ts) END AS t_value,
  CASE WHEN event_id % 6 = 5 THEN 'not a timestamp' END AS t_error
FROM events""",
    "null_rates": f"""
WITH {FEED},
s AS (SELECT {STAGING_OUT} FROM staging)
"""
    + "\nUNION ALL\n".join(
        f"SELECT '{c}' AS column_name, CAST(count(*) FILTER (WHERE {c} IS NULL) AS DOUBLE) / NULLIF(count(*), 0) AS null_rate, "
        f"count(*) FILTER (WHERE {c} IS NULL) AS null_count, count(*) AS n_rows FROM s"
        for c in Q._STAGING_OUT
    ),
    "cursor_density": f"""
WITH {FEED}
SELECT 'events.event_id' AS cursor_of, min(event_id) AS min_cursor, max(event_id) AS max_cursor,
  count(*) AS n_rows, count(DISTINCT event_id) AS n_distinct,
  max(event_id) - min(event_id) + 1 - count(DISTINCT event_id) AS gaps FROM events
UNION ALL
SELECT 'raw._id', min(_id), max(_id), count(*), count(DISTINCT _id), max(_id) - min(_id) + 1 - count(DISTINCT _id)
FROM raw_rows""",
    "freshness": f"""
WITH {FEED},
src AS (
  SELECT '{Q.AUCTION.name}' AS source, {_ts(Q.LOAD_AT)} AS ingested_at, delivery_start_utc AS delivery FROM staging
  UNION ALL
  SELECT '{Q.ORDERS.name}', {_ts(Q.ORDERS_LOAD_AT)}, o_orderdate FROM orders
),
agg AS (SELECT source, max(ingested_at) AS last_ingest, max(delivery) AS last_delivery FROM src GROUP BY source)
SELECT source, last_ingest, last_delivery,
  CAST(floor((epoch_us({_ts(Q.AS_OF)}) - epoch_us(last_ingest)) / 1000000.0) AS BIGINT) AS ingest_lag_seconds,
  CAST(floor((epoch_us(last_delivery) - epoch_us({_ts(Q.AS_OF)})) / 1000000.0) AS BIGINT) AS delivery_horizon_seconds
FROM agg""",
    "run_history": f"""
WITH {HOURLY_RUNS}
SELECT run_id, source, stage, status, rows_read, rows_written, rows_rejected,
  CAST(rows_rejected AS DOUBLE) / CAST(NULLIF(rows_read, 0) AS DOUBLE) AS reject_rate,
  started_at, ended_at, (epoch_us(ended_at) - epoch_us(started_at)) / 1000000.0 AS duration_seconds
FROM runs ORDER BY started_at DESC, run_id DESC""",
    "recent_runs": f"""
WITH {HOURLY_RUNS}
SELECT run_id, source, stage, status, started_at, ended_at, rows_read, rows_written, rows_rejected, error
FROM runs ORDER BY started_at DESC, run_id DESC LIMIT {Q.RECENT_RUNS}""",
    "second_source": """
SELECT o_orderkey, o_custkey, o_orderstatus, CAST(CAST(o_totalprice AS DECIMAL(14,2)) AS DOUBLE) AS o_totalprice,
  o_orderdate, o_orderpriority FROM orders""",
    "run_summary": f"""
WITH {FEED}
SELECT (SELECT count(*) FROM keyed WHERE raw_key IS NOT NULL) AS rows_read,
  (SELECT count(*) FROM keyed WHERE raw_key IS NULL) AS rows_skipped,
  (SELECT count(*) FROM raw_rows) AS raw_rows,
  (SELECT count(*) FROM staging) AS staging_rows,
  (SELECT count(*) FROM decided WHERE reason IS NOT NULL) AS rejected_rows,
  (SELECT count(DISTINCT auction_unit) FROM staging) AS dim_rows,
  (SELECT count(*) FROM (SELECT DISTINCT auction_unit, auction_product, delivery_start_utc FROM staging)) AS fact_rows""",
    # -- what the stages wrote (plans/stage_queries.py)
    "fact_incremental": f"""
WITH {FEED}
SELECT auction_unit, auction_product, delivery_start_utc, service_type, delivery_end_utc,
  CAST(executed_quantity_mw AS DOUBLE) AS executed_quantity_mw,
  CAST(clearing_price_gbp_per_mw_h AS DOUBLE) AS clearing_price_gbp_per_mw_h, unit_result_id
FROM staging""",
    "dim_incremental": f"""
WITH {FEED}
{DIM_SQL.format(src="staging")}""",
    "stage_counters": f"""
WITH {FEED},
n AS (
  SELECT (SELECT count(*) FROM feed) AS records, (SELECT max(_id) FROM feed) AS top, (SELECT max(_id) FROM raw_rows) AS wm,
    (SELECT count(*) FROM keyed WHERE raw_key IS NOT NULL) AS loadable, (SELECT count(*) FROM raw_rows) AS raw,
    (SELECT count(*) FROM decided WHERE reason IS NOT NULL) AS rejects, (SELECT count(*) FROM staging) AS staged,
    (SELECT count(DISTINCT auction_unit) FROM staging) AS units,
    (SELECT count(*) FROM feed WHERE _id > (SELECT max(_id) FROM raw_rows)) AS late,
    (SELECT count(*) FROM keyed WHERE raw_key IS NOT NULL AND _id > (SELECT max(_id) FROM raw_rows)) AS late_loadable
)
SELECT 'extract' AS stage, 'success' AS status, records AS rows_read, records AS rows_written, 0 AS rows_rejected, 0 AS rows_skipped,
  NULL AS watermark_before, top AS watermark_after FROM n
UNION ALL SELECT 'load_raw', 'success', loadable, raw, 0, records - loadable, NULL, NULL FROM n
UNION ALL SELECT 'validate', 'success', raw, staged, rejects, 0, NULL, NULL FROM n
UNION ALL SELECT 'transform', 'success', staged, staged + units, 0, 0, NULL, NULL FROM n
UNION ALL SELECT 'extract', 'success', late, late, 0, 0, wm, greatest(wm, top) FROM n
UNION ALL SELECT 'load_raw', 'success', late_loadable, 0, 0, late - late_loadable, NULL, NULL FROM n
UNION ALL SELECT 'validate', 'success', rejects, 0, rejects, 0, NULL, NULL FROM n
UNION ALL SELECT 'transform', 'success', 0, 0, 0, 0, NULL, NULL FROM n""",
    "ledger_after_fail": f"""
WITH {FEED},
n AS (
  SELECT (SELECT count(*) FROM feed) AS records, (SELECT count(*) FROM keyed WHERE raw_key IS NOT NULL) AS loadable,
    (SELECT count(*) FROM raw_rows) AS raw, (SELECT count(*) FROM decided WHERE reason IS NOT NULL) AS rejects, (SELECT count(*) FROM staging) AS staged
)
SELECT 'extract' AS stage, 'success' AS status, records AS rows_read, records AS rows_written, 0 AS rows_rejected, false AS has_error,
  rejects AS rejects_kept, staged AS staging_kept FROM n
UNION ALL SELECT 'load_raw', 'success', loadable, raw, 0, false, rejects, staged FROM n
UNION ALL SELECT 'validate', 'failed', raw, staged, rejects, true, rejects, staged FROM n""",
    "landing_roundtrip": f"""
WITH {FEED},
half AS (SELECT max(event_id) // 2 AS h FROM events),
loaded AS (SELECT max(_id) AS wm FROM raw_rows, half WHERE event_id <= h)
SELECT raw_key AS unit_result_id, _id FROM keyed, loaded WHERE _id > wm""",
    "offline_run": f"""
WITH {FEED}
SELECT unit_result_id, _id, auction_unit, CAST(executed_quantity_mw AS DOUBLE) AS executed_quantity_mw, delivery_start_utc FROM staging""",
    "validate_shredded": f"""
WITH {FEED}
SELECT unit_result_id, _id, CASE WHEN reason IS NULL THEN 'insert' ELSE 'reject' END AS outcome, reason,
  CASE WHEN reason IS NULL THEN auction_unit END AS auction_unit, CASE WHEN reason IS NULL THEN technology_type END AS technology_type,
  CASE WHEN reason IS NULL THEN CAST(executed_quantity_mw AS DOUBLE) END AS executed_quantity_mw,
  CASE WHEN reason IS NULL THEN delivery_start_utc END AS delivery_start_utc
FROM decided""",
    "pending_by_bucket": f"""
WITH {FEED},
cut AS (SELECT CAST(floor({S.PENDING_CUT} * (max(event_id) + 1)) AS BIGINT) AS c FROM events)
SELECT raw_key AS unit_result_id, _id FROM decided, cut WHERE event_id >= c OR reason IS NOT NULL""",
    "watermark_from_footers": """
SELECT max(event_id) AS watermark, count(*) AS n_rows FROM events""",
    "datasource_drain": f"""
SELECT event_id, user_id, event_type, value, props FROM events WHERE event_id > {Q.KEYSET_WATERMARK}""",
    "stream_equals_batch": f"""
WITH {FEED}
SELECT {STAGING_OUT} FROM staging""",
    "json_array_split": """
SELECT event_id, user_id, event_type, value, props FROM events""",
    "cursor_gaps": f"""
WITH {FEED},
near AS (SELECT _id, lag(_id) OVER (ORDER BY _id) AS before FROM (SELECT DISTINCT _id FROM raw_rows))
SELECT before + 1 AS first_missing, _id - 1 AS last_missing FROM near WHERE _id > before + 1""",
    "key_uniqueness": f"""
WITH {FEED}
SELECT 'raw' AS table_name, count(*) AS n_rows, 0 AS dup_groups FROM raw_rows
UNION ALL SELECT 'staging', count(*), 0 FROM staging
UNION ALL SELECT 'staging_cursor', count(*), 0 FROM staging
UNION ALL SELECT 'dim', count(DISTINCT auction_unit), 0 FROM staging
UNION ALL SELECT 'fact', count(*), 0 FROM (SELECT DISTINCT auction_unit, auction_product, delivery_start_utc FROM staging)
UNION ALL SELECT 'runs', 8, 0""",
    "hooked_mart_step": f"""
WITH {FEED}
SELECT auction_unit, upper(auction_product) AS auction_product, count(*) AS n_rows FROM staging WHERE length(auction_unit) >= 4 GROUP BY ALL""",
    "report_two_sources": f"""
WITH {FEED},
src AS (
  SELECT '{Q.AUCTION.name}' AS source, {_ts(Q.LOAD_AT)} AS last_ingest, max(date_trunc('millisecond', delivery_start_utc)) AS last_delivery FROM staging
  UNION ALL SELECT '{Q.ORDERS.name}', {_ts(Q.ORDERS_LOAD_AT)}, max(o_orderdate) FROM orders WHERE o_orderkey > 0
)
SELECT source, last_ingest, last_delivery, CAST(floor((epoch_us({_ts(Q.AS_OF)}) - epoch_us(last_ingest)) / 1000000.0) AS BIGINT) AS ingest_lag_seconds,
  8 AS runs_listed FROM src""",
}
