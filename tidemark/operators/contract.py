"""Record contract compiled to Column expressions (validate stage core).

``apply_contract`` turns a frame holding a JSON ``payload`` text column into
the same frame plus one typed column per staged field and an ``errors``
array. Everything is a projection: no shuffle, no Python per row.
"""

from __future__ import annotations

import functools
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import coerce as C
from tidemark.functions import json as J
from tidemark.spec import DECIMAL, INTEGER, STRING, TIMESTAMP, Contract, FieldRule

# Fixed value: prefix of reasons for values that pass the contract but cannot
# be stored (numeric overflow, duplicate cursor).
INSERT_FAILED = "staging insert failed: "
EXTRA_KEYS = "extra keys"

_V = "__v"
_MEMBER = "__m"


def _member(rule: FieldRule) -> Column:
    """The member for a rule: the alias key when present (even JSON null), else the name."""
    v = F.col(_V)
    # A JSON null is a VARIANT null, not SQL NULL, so coalesce keeps a present alias.
    return F.coalesce(*[J.field(v, k) for k in rule.keys])


def _coerce(rule: FieldRule, k: Column, s: Column) -> C.Coerced:
    if rule.kind == INTEGER:
        return C.to_integer(k, s)
    if rule.kind == DECIMAL:
        return C.to_decimal(s, rule.precision, rule.scale)
    if rule.kind == TIMESTAMP:
        return C.to_timestamp_utc(s)
    if rule.kind == STRING:
        return C.to_clean_string(k, s, rule.required)
    raise ValueError(rule.kind)


def unknown_keys(contract: Contract, payload_col: str = "payload") -> Column:
    """Sorted payload keys the contract does not know (empty for a non-object)."""
    known = F.array(*[F.lit(k) for k in contract.known_keys]) if contract.known_keys else F.array().cast(
        "array<string>"
    )
    keys = F.coalesce(J.payload_keys(F.col(payload_col)), F.array().cast("array<string>"))
    return F.array_sort(F.array_except(keys, known))


@dataclass(frozen=True)
class _Compiled:
    """The contract's projection levels as reusable (unresolved) Column lists."""

    members: list
    described: list
    coerced: list
    hooked: list | None
    arrays: list
    final: list


@functools.lru_cache(maxsize=64)
def _compile(contract: Contract, payload_col: str, application_id: str) -> _Compiled:
    """Build the Column expressions once per contract (and Spark application).

    Building thousands of Column objects costs one JVM round trip each; the
    expressions only name columns, so they are reused across DataFrames.
    """
    rules = contract.fields
    n = len(rules)
    members = [_member(r).alias(f"__m{i}") for i, r in enumerate(rules)]
    # The JSON kind is only needed by integer and string rules.
    described = [
        J.kind(F.col(f"__m{i}")).alias(f"__k{i}") for i, r in enumerate(rules) if r.kind in (INTEGER, STRING)
    ] + [J.text(F.col(f"__m{i}")).alias(f"__s{i}") for i in range(n)]
    coerced = []
    for i, rule in enumerate(rules):
        c = _coerce(rule, F.col(f"__k{i}"), F.col(f"__s{i}"))
        coerced += [c.value.alias(f"__x{i}"), c.error.alias(f"__e{i}"), c.insert_error.alias(f"__i{i}")]
    hooked = None
    if any(r.clean or r.check for r in rules):
        hooked = []
        for i, rule in enumerate(rules):
            value = rule.clean(F.col(f"__x{i}")) if rule.clean else F.col(f"__x{i}")
            error = F.coalesce(F.col(f"__e{i}"), rule.check(value)) if rule.check else F.col(f"__e{i}")
            hooked += [value.alias(f"__x{i}"), error.alias(f"__e{i}"), F.col(f"__i{i}")]
    # concat with a NULL code is NULL, and array_compact drops it.
    errors = [F.concat(F.lit(f"{rule.name}: "), F.col(f"__e{i}")) for i, rule in enumerate(rules)]
    insert_errors = [F.concat(F.lit(f"{INSERT_FAILED}{rule.name}: "), F.col(f"__i{i}")) for i, rule in enumerate(rules)]
    if contract.extra == "forbid":
        extra = unknown_keys(contract, payload_col)
        errors.append(F.when(F.size(extra) > 0, F.concat(F.lit(f"{EXTRA_KEYS}: "), F.array_join(extra, ","))))
    empty = F.array().cast("array<string>")
    arrays = [F.col(f"__x{i}").alias(r.name) for i, r in enumerate(rules)] + [
        (F.array_compact(F.array(*errors)) if errors else empty).alias("__ce"),
        (F.array_compact(F.array(*insert_errors)) if insert_errors else empty).alias("__ie"),
    ]
    final = [F.col(r.name) for r in rules] + [
        F.when(F.size("__ce") > 0, F.col("__ce")).otherwise(F.col("__ie")).alias("errors")
    ]
    return _Compiled(members, described, coerced, hooked, arrays, final)


def parsed_members(df: DataFrame, contract: Contract, parsed_col: str) -> DataFrame:
    """``df`` with one VARIANT column per rule in place of ``parsed_col``, the parsed payload.

    Directly above a scan of a shredded VARIANT, Spark reads just the columns
    of these members; ``apply_contract`` then parses no text.
    """
    rest = [c for c in df.columns if c != parsed_col]
    members = [_member(r).alias(f"{_MEMBER}{i}") for i, r in enumerate(contract.fields)]
    return df.select(*rest, F.col(parsed_col).alias(_V)).select(*rest, *members)


def has_members(df: DataFrame) -> bool:
    return f"{_MEMBER}0" in df.columns


def apply_contract(df: DataFrame, contract: Contract, payload_col: str = "payload") -> DataFrame:
    """Add typed columns (named after the rules) and ``errors: array<string>``.

    Members that ``parsed_members`` has added are used; else the payload text is parsed.

    An input column whose name equals a rule name is kept as ``raw_<name>``.
    Contract errors come first; when there are none, insert errors (values that
    do not fit their staging column) are reported with the insert prefix.
    """
    rules = contract.fields
    typed_names = {r.name for r in rules}
    renamed = df.select(*[F.col(c).alias(f"raw_{c}" if c in typed_names else c) for c in df.columns])
    payload_col = f"raw_{payload_col}" if payload_col in typed_names else payload_col
    compiled = _compile(contract, payload_col, df.sparkSession.sparkContext.applicationId)
    base_cols = [F.col(c) for c in renamed.columns]
    # One projection per level: every reused sub-expression becomes a column,
    # so the optimizer never re-inlines (and multiplies) expression trees.
    if has_members(df):
        base_cols = [F.col(c) for c in renamed.columns if not c.startswith(_MEMBER)]
        members = renamed
    else:
        with_v = renamed.select(*base_cols, J.parse_payload(F.col(payload_col)).alias(_V))
        members = with_v.select(*base_cols, *compiled.members)
    described = members.select(*base_cols, *compiled.described)
    coerced = described.select(*base_cols, *compiled.coerced)
    if compiled.hooked is not None:
        coerced = coerced.select(*base_cols, *compiled.hooked)
    arrays = coerced.select(*base_cols, *compiled.arrays)
    final = arrays.select(*base_cols, *compiled.final)
    # Barrier: a one-row inline (Generate). Catalyst pushes a Filter through a
    # Project by substituting aliases, which would copy the whole rule tree into
    # every later predicate on ``errors`` (and evaluate it twice per row). A
    # filter on generator output stays above the Generate, so the contract is
    # evaluated exactly once per row.
    return evaluate_once(final)


def evaluate_once(df: DataFrame) -> DataFrame:
    """Same rows and columns, behind a one-row ``inline`` (see apply_contract)."""
    return df.select(F.inline(F.array(F.struct(*[F.col(c) for c in df.columns]))))


def reason(errors: Column) -> Column:
    """One reject message listing every failing field."""
    return F.concat_ws("; ", errors)


def drift_report(df: DataFrame, contract: Contract, payload_col: str = "payload") -> DataFrame:
    """Distinct unknown payload keys with the number of rows carrying each, sorted.

    One partial + final aggregation on the key; a key carried by most rows is
    pre-counted map-side, so no task sees all of its rows.
    """
    return (
        df.select(F.explode(unknown_keys(contract, payload_col)).alias("extra_key"))
        .groupBy("extra_key")
        .agg(F.count(F.lit(1)).alias("rows_with_key"))
        .orderBy("extra_key")
    )
