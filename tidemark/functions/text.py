"""String cleaning rules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the whitespace set trimmed from both ends of every string field
# (space, tab, carriage return, line feed). One-argument trim strips spaces only.
WHITESPACE = " \t\r\n"


def btrim_ws(c: Column) -> Column:
    """Trim the whitespace set from both ends; NULL stays NULL, blank becomes ''."""
    return F.btrim(c, F.lit(WHITESPACE))


def clean_text(c: Column) -> Column:
    """Trim the whitespace set; blank becomes NULL."""
    return F.nullif(btrim_ws(c), F.lit(""))
