"""JSON payload access through Spark's VARIANT type."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# JSON kinds the contract distinguishes before casting.
ABSENT, NULL, STRING, NUMBER, BOOLEAN, OTHER = "absent", "null", "string", "number", "boolean", "other"


def _path(key: str) -> str:
    if "'" in key or "\\" in key:
        raise ValueError(f"unsupported JSON key {key!r}")
    return f"$['{key}']"


def parse_payload(text: Column) -> Column:
    """Parse JSON text to VARIANT; malformed text raises (the load must fail)."""
    return F.parse_json(text)


def field(v: Column, key: str) -> Column:
    """Untyped member access: SQL NULL when absent, a VARIANT null when JSON null."""
    return F.variant_get(v, _path(key), "variant")


def field_as(v: Column, key: str, type_name: str) -> Column:
    """Typed member access; raises when the value cannot be cast (ANSI)."""
    return F.variant_get(v, _path(key), type_name)


def try_field_as(v: Column, key: str, type_name: str) -> Column:
    """Typed member access; NULL when absent, JSON null or not castable."""
    return F.try_variant_get(v, _path(key), type_name)


# JSON kind by the first character of a member's JSON text
# ('~' stands for an absent member); anything else is a number.
_KIND_BY_FIRST_CHAR = (
    ("~", ABSENT),
    ('"', STRING),
    ("n", NULL),
    ("t", BOOLEAN),
    ("f", BOOLEAN),
    ("{", OTHER),
    ("[", OTHER),
)


def kind(x: Column) -> Column:
    """JSON kind of an untyped member: absent, null, string, number, boolean or other.

    Read from the first character of the member's JSON text (cheaper than
    inferring its variant schema), as one map lookup so ``x`` is referenced once.
    """
    lookup = F.create_map(*[F.lit(v) for pair in _KIND_BY_FIRST_CHAR for v in pair])
    first = F.coalesce(F.substring(F.to_json(x), 1, 1), F.lit("~"))
    return F.coalesce(F.element_at(lookup, first), F.lit(NUMBER))


def text(x: Column) -> Column:
    """Scalar member as text (numbers in their JSON spelling, booleans as true/false)."""
    return F.try_variant_get(x, "$", "string")


def payload_keys(payload_text: Column) -> Column:
    """Top-level keys of a JSON object held as text."""
    return F.json_object_keys(payload_text)
