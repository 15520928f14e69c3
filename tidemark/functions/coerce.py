"""Type rules of the record contract, as Column expressions.

Each rule takes the scalar text ``s`` of one member (``functions.json.text``)
and, where the rule depends on it, its JSON kind ``k`` (``functions.json.kind``;
integer and string rules only). Both are computed once per member, which keeps
the projection cheap. A rule returns ``(value, error, insert_error)``:

* ``value``        typed value, NULL when the rule fails or the field is empty;
* ``error``        short code when the record breaks the contract, else NULL;
* ``insert_error`` code for a value that passes the contract but does not fit
  the staging column (numeric overflow), else NULL.

Integer and string rules decide the JSON kind (string / number / boolean /
null / absent) before any cast, because they treat kinds differently.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions import json as J
from tidemark.functions.text import btrim_ws, clean_text

# Error codes used in reject reasons ("<field>: <code>").
MISSING = "missing"
BLANK = "blank"
NOT_STRING = "not a string"
NOT_INTEGER = "not an integer"
NOT_NUMBER = "not a number"
NOT_TIMESTAMP = "not a timestamp"
OVERFLOW = "numeric overflow"

# Accepted spellings.
# Decimal literal: optional sign, digits with optional fraction (or a bare
# fraction), optional exponent. Underscores between digits are removed first.
NUMBER_PATTERN = r"^[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]+)?\z"
# Whole number spelt without an exponent: its fraction, if any, is all zeros.
WHOLE_PATTERN = r"^([+-]?[0-9]+)(\.0*)?\z"
DIGIT_UNDERSCORE = r"(?<=[0-9])_(?=[0-9])"
# ISO-8601 extended date or date-time, optional fraction, optional Z or +hh:mm.
TIMESTAMP_PATTERN = (
    r"^[0-9]{4}-[0-9]{2}-[0-9]{2}"
    r"([T ][0-9]{2}:[0-9]{2}(:[0-9]{2}(\.[0-9]+)?)?(Z|[+-][0-9]{2}:[0-9]{2})?)?\z"
)


class Coerced(NamedTuple):
    value: Column
    error: Column
    insert_error: Column


def _none() -> Column:
    return F.lit(None).cast("string")


def _empty(k: Column) -> Column:
    return k.isin(J.ABSENT, J.NULL)


def _number_text(k: Column, s: Column) -> Column:
    """Numeric spelling of a string or number member, NULL for other kinds.

    Underscores between digits are dropped; the regex only runs on the rare
    strings that contain an underscore.
    """
    trimmed = btrim_ws(s)
    return (
        F.when(
            k == J.STRING,
            F.when(trimmed.contains("_"), F.regexp_replace(trimmed, DIGIT_UNDERSCORE, "")).otherwise(trimmed),
        )
        .when(k == J.NUMBER, s)
        .otherwise(_none())
    )


def _is_number(num: Column, parsed: Column) -> Column:
    """Whether ``num`` spells a decimal number. A successful decimal cast settles it
    (the cast grammar matches ours); only a failed cast pays for the regex, which
    tells an out-of-range number from text."""
    return F.when(parsed.isNotNull(), F.lit(True)).otherwise(F.coalesce(num.rlike(NUMBER_PATTERN), F.lit(False)))


def to_integer(k: Column, s: Column) -> Coerced:
    """Lax integer: integral numbers, numeric strings, booleans as 0/1.

    Without an exponent, the digits of the text decide whether it is whole, so no
    rounding hides a fraction. A whole number beyond the staged type passes the
    contract and is an insert error.
    """
    num = F.when(k == J.BOOLEAN, F.when(s == "true", "1").otherwise("0")).otherwise(_number_text(k, s))
    whole = F.regexp_extract(num, WHOLE_PATTERN, 1)
    scientific = F.when(num.rlike("[eE]"), num.try_cast("decimal(38,10)"))
    from_scientific = F.when(scientific == F.floor(scientific), scientific.try_cast("bigint"))
    value = F.when(whole != "", whole.try_cast("bigint")).otherwise(from_scientific)
    integral = (whole != "") | from_scientific.isNotNull()
    error = F.when(_empty(k), F.lit(MISSING)).when(~F.coalesce(integral, F.lit(False)), F.lit(NOT_INTEGER))
    return Coerced(value, error, F.when(error.isNull() & value.isNull(), F.lit(OVERFLOW)))


def to_decimal(s: Column, precision: int = 12, scale: int = 4) -> Coerced:
    """Decimal from a number or numeric string; booleans, NaN, Infinity and '' fail.

    Needs no JSON kind: JSON null and absent give NULL text (missing); a
    boolean, object or array spells no number. The value is rounded to
    ``scale`` places (ties away from zero); more than ``precision - scale``
    integer digits is an insert error, not a contract error.
    """
    trimmed = btrim_ws(s)
    num = F.when(trimmed.contains("_"), F.regexp_replace(trimmed, DIGIT_UNDERSCORE, "")).otherwise(trimmed)
    value = num.try_cast(f"decimal({precision},{scale})")
    is_number = _is_number(num, value)
    error = F.when(s.isNull(), F.lit(MISSING)).when(~is_number, F.lit(NOT_NUMBER))
    insert_error = F.when(error.isNull() & value.isNull(), F.lit(OVERFLOW))
    return Coerced(value, error, insert_error)


def to_timestamp_utc(s: Column) -> Coerced:
    """ISO-8601 string to an instant; a naive string means UTC, an offset is honoured.

    Needs no JSON kind: only a string can match the ISO pattern, and JSON
    null and absent give NULL text (missing).
    """
    value = F.when(s.rlike(TIMESTAMP_PATTERN), s.try_cast("timestamp"))
    error = F.when(s.isNull(), F.lit(MISSING)).when(value.isNull(), F.lit(NOT_TIMESTAMP))
    return Coerced(value, error, _none())


def to_clean_string(k: Column, s: Column, required: bool) -> Coerced:
    """Trimmed string; blank is an error when required, NULL when optional."""
    value = F.when(k == J.STRING, clean_text(s))
    wrong_kind = ~k.isin(J.STRING, J.ABSENT, J.NULL)
    if required:
        error = (
            F.when(_empty(k), F.lit(MISSING))
            .when(wrong_kind, F.lit(NOT_STRING))
            .when(value.isNull(), F.lit(BLANK))
        )
    else:
        error = F.when(wrong_kind, F.lit(NOT_STRING))
    return Coerced(value, error, _none())
