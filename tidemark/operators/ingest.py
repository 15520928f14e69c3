"""Load and validate as pure frame builders (the stages add run ids, writes and counts)."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import json as J
from tidemark.operators import merge
from tidemark.operators.contract import INSERT_FAILED, apply_contract, evaluate_once, has_members, reason
from tidemark.spec import SourceSpec

DUPLICATE_CURSOR = "duplicate cursor"
NOT_AN_OBJECT = "landing line is not a JSON object"
NOT_PARSED = "raw row without its parsed payload"
PARSED = "payload_parsed"  # the payload as VARIANT, beside its text


def raw_columns(spec: SourceSpec) -> list[str]:
    return [spec.business_key, spec.cursor, "payload", "ingested_at", "extract_run_id"]


def staging_columns(spec: SourceSpec) -> list[str]:
    cols = [spec.business_key, spec.cursor]
    cols += [r.name for r in spec.staged_fields if r.name not in cols]
    cols += [name for name, _ in spec.derived]
    return cols + ["ingested_at", "extract_run_id"]


_KIND_TYPES = {
    "integer": T.LongType(),
    "timestamp": T.TimestampType(),
    "string": T.StringType(),
}


def raw_schema(spec: SourceSpec, parsed: bool = False) -> T.StructType:
    """raw: business key, cursor, payload text, ingest time, load run id; with ``parsed`` also the payload as VARIANT."""
    return T.StructType(
        [
            T.StructField(spec.business_key, T.StringType(), False),
            T.StructField(spec.cursor, T.LongType(), False),
            T.StructField("payload", T.StringType(), False),
            T.StructField("ingested_at", T.TimestampType(), False),
            T.StructField("extract_run_id", T.StringType(), False),
            *([T.StructField(PARSED, T.VariantType(), True)] if parsed else []),
        ]
    )


def staging_schema(spec: SourceSpec) -> T.StructType:
    """staging: typed contract fields plus cursor, derived columns and provenance."""
    by_name = {r.name: r for r in spec.staged_fields}
    fields = []
    for name in staging_columns(spec):
        if name == spec.cursor:
            fields.append(T.StructField(name, T.LongType(), False))
        elif name in by_name:
            rule = by_name[name]
            dtype = (
                T.DecimalType(rule.precision, rule.scale) if rule.kind == "decimal" else _KIND_TYPES[rule.kind]
            )
            fields.append(T.StructField(name, dtype, not rule.required))
        elif name == "ingested_at":
            fields.append(T.StructField(name, T.TimestampType(), False))
        elif name == "extract_run_id":
            fields.append(T.StructField(name, T.StringType(), False))
        else:  # derived wall-clock columns
            fields.append(T.StructField(name, T.TimestampNTZType(), True))
    return T.StructType(fields)


def extract_keys(lines: DataFrame, spec: SourceSpec, parsed: bool = False) -> DataFrame:
    """Landing lines (``payload``) -> ``payload``, business key text, cursor; with ``parsed`` also the VARIANT they are read from.

    Parsing is strict: a malformed line, a line that is not an object, or a
    cursor that is not a whole number fails the job (no partial append). A
    fractional cursor truncates. The key and cursor stay NULL when absent or
    JSON null. Ruling for keys that are no strings: booleans are spelt
    ``true``/``false``, numbers without trailing zeros (5.0 is ``5``).
    """
    v = J.parse_payload(F.col("payload"))
    is_object = J.payload_keys(F.col("payload")).isNotNull()
    key = F.when(is_object, J.field_as(v, spec.key_field, "string")).otherwise(F.raise_error(F.lit(NOT_AN_OBJECT)))
    if parsed:
        # behind a barrier, so that each line is parsed once for its key, its cursor and raw
        lines = evaluate_once(lines.select("payload", F.when(is_object, v).otherwise(F.raise_error(F.lit(NOT_AN_OBJECT))).alias(PARSED)))
        v = F.col(PARSED)
        key = J.field_as(v, spec.key_field, "string")
    keyed = lines.select(
        F.col("payload"),
        key.alias(spec.business_key),
        J.field_as(v, spec.cursor_field, "bigint").alias(spec.cursor),
        *([PARSED] if parsed else []),
    )
    return evaluate_once(keyed)


def loadable(keyed: DataFrame, spec: SourceSpec) -> Column:
    """Rows with both key and cursor; the rest are skipped (counted, never loaded)."""
    return F.col(spec.business_key).isNotNull() & F.col(spec.cursor).isNotNull()


def raw_batch(keyed: DataFrame, spec: SourceSpec, run_id: str, ingested_at: dt.datetime) -> DataFrame:
    """Loadable rows shaped as raw rows for this load run."""
    return keyed.filter(loadable(keyed, spec)).select(
        F.col(spec.business_key),
        F.col(spec.cursor),
        F.col("payload"),
        F.lit(ingested_at).cast("timestamp").alias("ingested_at"),
        F.lit(run_id).alias("extract_run_id"),
        *([PARSED] if PARSED in keyed.columns else []),
    )


def raw_inserts(batch: DataFrame, raw: DataFrame | None, spec: SourceSpec, deduplicated: bool = False) -> DataFrame:
    """Insert-only merge into raw: first (cursor, payload) per key; existing keys never change."""
    order = [spec.cursor, "payload"]
    if raw is None:
        return batch if deduplicated else merge.first_wins(batch, [spec.business_key], order, carried=[PARSED])
    return merge.insert_only(batch, raw, [spec.business_key], order, deduplicated)


def pending(raw: DataFrame, staging: DataFrame | None, spec: SourceSpec) -> DataFrame:
    """Raw rows whose (raw, untrimmed) key is not in staging yet (NOT EXISTS).

    The anti-join moves keys and cursors only; payloads are fetched by a
    semi-join on (key, cursor), which adaptive execution broadcasts when the
    pending keys turn out small, so the payload-heavy raw table is scanned.
    """
    if staging is None:
        return raw
    key = spec.business_key
    staged_keys = staging.select(F.col(key).cast("string").alias(key))
    todo = raw.select(key, spec.cursor).join(staged_keys, key, "left_anti")
    return raw.join(todo, [key, spec.cursor], "left_semi")


def validate_frame(pending_raw: DataFrame, spec: SourceSpec) -> DataFrame:
    """Pending raw rows -> staging-shaped rows plus ``errors`` and ``raw_payload``.

    The cursor, ingest time and run id come from the raw row, not the payload.
    """
    if has_members(pending_raw):
        # raw holds no row without a key in its payload: a null here is a row that was loaded without being parsed
        at = [r.name for r in spec.contract.fields].index(spec.business_key)
        held = F.col(f"__m{at}").isNotNull()
        pending_raw = pending_raw.withColumn("payload", F.when(held, F.col("payload")).otherwise(F.raise_error(F.lit(NOT_PARSED))))
    checked = apply_contract(pending_raw, spec.contract, "payload")
    key = spec.business_key
    raw_key = f"raw_{key}" if f"raw_{key}" in checked.columns else key
    typed = [F.col(r.name) for r in spec.staged_fields if r.name not in (key, spec.cursor)]
    derived = [build().alias(name) for name, build in spec.derived]
    cols = [
        F.col(key),
        F.col(spec.cursor),
        *typed,
        *derived,
        F.col("ingested_at"),
        F.col("extract_run_id"),
        F.col("payload").alias("raw_payload"),
        F.col("errors"),
        F.col(raw_key).cast("string").alias("raw_key"),
    ]
    return checked.select(*cols)


def staging_outcome(
    validated: DataFrame, staging: DataFrame | None, spec: SourceSpec, carry: Sequence[str] | None = None
) -> DataFrame:
    """Decide every validated row in one pass: ``insert`` or ``reject`` (+ reason).

    * rows breaking the contract are rejected with their reasons;
    * rows whose cleaned key is in staging are dropped (ON CONFLICT DO NOTHING);
    * cursors are unique too: of the rows left, one whose cursor staging holds,
      or whose cursor a row with a smaller key also has, is rejected, so it
      cannot stand in the way of a later row of its key;
    * of what remains, the first row per cleaned key wins (lowest cursor, then
      payload); later rows are duplicates, counted as read - inserted -
      rejected and never materialised.

    Only staging's key and cursor are read; both are unique there. Rejected rows
    ride through the first-wins aggregation keyed by their raw key (unique in
    raw), also in the joins, so rows without a cleaned key spread over all
    tasks. ``carry`` names the columns kept (default: staging columns and
    ``raw_payload``); the decision alone needs few.
    """
    key, cur = spec.business_key, spec.cursor
    cols = list(carry) if carry is not None else staging_columns(spec) + ["raw_payload"]
    is_valid = F.size("errors") == 0
    own = F.concat(F.lit("r:"), F.col("raw_key"))
    rows = validated.select(
        *cols,
        *[F.col(c) for c in dict.fromkeys((key, cur, "raw_payload", "raw_key")) if c not in cols],
        is_valid.alias("__valid"),
        reason(F.col("errors")).alias("__reason"),
        F.when(is_valid, F.concat(F.lit("v:"), F.col(key).cast("string"))).otherwise(own).alias("__group"),
    )
    taken = F.lit(False)
    if staging is not None:
        staged = staging.select(F.concat(F.lit("v:"), F.col(key).cast("string")).alias("__group"))
        rows = rows.join(staged, "__group", "left_anti")
        taken_cursors = staging.select(F.col(cur), F.lit(True).alias("__taken"))
        rows = rows.join(taken_cursors, cur, "left")
        taken = F.coalesce(F.col("__taken"), F.lit(False))
    owners = rows.filter(F.col("__valid") & ~taken).groupBy(cur).agg(F.min(key).alias("__owner"))
    rows = rows.join(owners, cur, "left")
    lost = F.col("__valid") & (taken | (F.col(key) != F.col("__owner")))
    rows = rows.withColumn("__lost", lost).withColumn("__group", F.when(F.col("__lost"), own).otherwise(F.col("__group")))
    rows = rows.drop("__owner", "__taken")
    first = merge.first_wins(rows, ["__group"], [cur, "raw_payload"])
    return first.select(
        *cols,
        F.when(~F.col("__valid") | F.col("__lost"), F.lit("reject")).otherwise(F.lit("insert")).alias("outcome"),
        F.when(~F.col("__valid"), F.col("__reason"))
        .when(F.col("__lost"), F.lit(f"{INSERT_FAILED}{cur}: {DUPLICATE_CURSOR}"))
        .alias("reason"),
    )


def reject_rows(rejects: DataFrame, run_id: str, source: str, at: dt.datetime) -> DataFrame:
    """Reject-table rows: run id, source, raw payload, reason, rejected_at."""
    return rejects.select(
        F.lit(run_id).alias("run_id"),
        F.lit(source).alias("source"),
        F.col("raw_payload"),
        F.col("reason"),
        F.lit(at).cast("timestamp").alias("rejected_at"),
    )


def validate_all(pending_raw: DataFrame, staging: DataFrame | None, spec: SourceSpec) -> DataFrame:
    """Pending raw rows with their outcome: insert or reject (+ reason); duplicates are left out.

    Schema: staging columns, ``raw_payload``, ``outcome``, ``reason``.
    """
    return staging_outcome(validate_frame(pending_raw, spec), staging, spec)
