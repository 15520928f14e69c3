"""Mart builders: defensive string clean, type-1 dimension, fact projection."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.text import btrim_ws
from tidemark.spec import DimSpec, FactSpec


def clean_strings(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Trim the whitespace set from ``columns``; a blank value becomes '' (not NULL)."""
    return df.withColumns({c: btrim_ws(F.col(c)) for c in columns})


def changed_predicate(not_null: Sequence[str], nullable: Sequence[str] = ()) -> Column:
    """True for rows the clean pass would rewrite: ``<>`` on NOT NULL columns,
    IS DISTINCT FROM on nullable ones."""
    cond = F.lit(False)
    for c in not_null:
        cond = cond | (F.col(c) != btrim_ws(F.col(c)))
    for c in nullable:
        cond = cond | ~F.col(c).eqNullSafe(btrim_ws(F.col(c)))
    return cond


def build_dim(staging: DataFrame, dim: DimSpec) -> DataFrame:
    """One row per dimension key: max of each attribute, first/last seen times.

    ``max`` over text is binary (code point) order. Partial + final
    aggregation on the key, so a key carrying most rows is pre-reduced map-side.
    """
    return staging.groupBy(dim.key).agg(
        *[F.max(a).alias(a) for a in dim.attributes],
        F.min(dim.seen_column).alias(dim.first_seen),
        F.max(dim.seen_column).alias(dim.last_seen),
    )


def merge_dim_state(state: DataFrame, fresh: DataFrame, dim: DimSpec) -> DataFrame:
    """Aggregates of earlier rows and of new ones, as of all rows: max of maxima, min and max of the times.

    Both have the columns of ``build_dim``. Rows only ever come to staging, so
    the state of all rows follows from these two and no old row is read again.
    """
    both = state.unionByName(fresh)
    return both.groupBy(dim.key).agg(
        *[F.max(a).alias(a) for a in dim.attributes],
        F.min(dim.first_seen).alias(dim.first_seen),
        F.max(dim.last_seen).alias(dim.last_seen),
    )


def fact_month(fact: FactSpec) -> Column:
    """The part of the fact a row belongs to: the (UTC) month of its ``month_of`` time, as yyyy-MM."""
    return F.date_format(F.col(fact.month_of), "yyyy-MM")


def fact_rows(staging: DataFrame, fact: FactSpec) -> DataFrame:
    """Fact projection: grain columns then carried columns."""
    return staging.select(*fact.grain, *[c for c in fact.columns if c not in fact.grain])
