"""Merges expressed as joins and aggregations (Parquet has no MERGE/UPDATE).

Skew: every operator here is safe when one key holds a third of the rows.
``first_wins`` is an aggregation, so it combines map-side before the shuffle
(a hot key leaves each map task as one row); the joins run on keys that are
unique on at least one side after that step.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def first_wins(df: DataFrame, keys: Sequence[str], order: Sequence[str], carried: Sequence[str] = ()) -> DataFrame:
    """One row per key: the row with the smallest ``order`` tuple (then all other columns).

    ``carried`` columns (where ``df`` has them) go with the row but cannot be
    compared, as a VARIANT: of rows equal in all others, any one's is taken.

    Deterministic replacement for "first row in file order wins": the input of
    an extract is ascending by cursor, so the lowest (cursor, payload) is the
    first. Written as ``min(struct)`` so Spark aggregates partially before the
    shuffle instead of sorting each whole key group in one task.
    """
    keys, order = list(keys), list(order)
    carried = [c for c in carried if c in df.columns]
    rest = [c for c in df.columns if c not in keys and c not in order and c not in carried]
    row = F.struct(*[F.col(c) for c in order + rest])
    out = df.groupBy(*keys).agg(F.min(row).alias("__w"), *[F.min_by(c, row).alias(c) for c in carried])
    return out.select(*[F.col(k) for k in keys], *[F.col(f"__w.{c}").alias(c) for c in order + rest], *carried).select(
        *df.columns
    )


def anti_join(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``left`` whose key is absent from ``right`` (NOT EXISTS); reads only right's keys.

    A key that ``right`` repeats leaves each map task once, so a hot key costs the shuffle one row per task.
    """
    return left.join(right.select(*keys).distinct(), list(keys), "left_anti")


def insert_only(
    batch: DataFrame,
    target: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    deduplicated: bool = False,
) -> DataFrame:
    """Rows to append for ``INSERT ... ON CONFLICT (keys) DO NOTHING``.

    First row per key wins inside the batch; keys already in ``target`` (unique
    there) never change. The target's keys are first reduced to those that
    collide: adaptive execution broadcasts the batch's keys into that semi-join
    when their measured bytes are small, so a large target is only scanned.
    """
    fresh = batch if deduplicated else first_wins(batch, keys, order)
    colliding = target.select(*keys).join(fresh.select(*keys), list(keys), "left_semi")
    return fresh.join(colliding, list(keys), "left_anti")


def upsert_aggregate(
    target: DataFrame,
    source: DataFrame,
    key: str,
    attributes: Sequence[str],
    least_cols: Sequence[str] = (),
    greatest_cols: Sequence[str] = (),
) -> DataFrame:
    """``INSERT ... ON CONFLICT (key) DO UPDATE`` for a type-1 dimension.

    New keys are inserted; matched keys take the source attributes, even NULL
    ones (so not ``coalesce``); ``least_cols`` keep the smaller and
    ``greatest_cols`` the larger value, ignoring NULLs; target-only keys stay.
    Both sides are unique on ``key``, so the full outer join has no skew.
    """
    t = target.alias("t")
    s = source.select(*source.columns, F.lit(True).alias("__matched")).alias("s")
    joined = t.join(s, F.col(f"t.{key}") == F.col(f"s.{key}"), "full_outer")
    in_src = F.col("s.__matched").isNotNull()

    def pick(c: str) -> Column:
        if c == key:
            return F.coalesce(F.col(f"s.{c}"), F.col(f"t.{c}")).alias(c)
        if c in least_cols:
            return F.least(F.col(f"t.{c}"), F.col(f"s.{c}")).alias(c)
        if c in greatest_cols:
            return F.greatest(F.col(f"t.{c}"), F.col(f"s.{c}")).alias(c)
        if c in attributes:
            return F.when(in_src, F.col(f"s.{c}")).otherwise(F.col(f"t.{c}")).alias(c)
        return F.when(in_src, F.col(f"s.{c}")).otherwise(F.col(f"t.{c}")).alias(c)

    return joined.select(*[pick(c) for c in target.columns])


def upsert_replace(target: DataFrame, source: DataFrame, grain: Sequence[str]) -> DataFrame:
    """``INSERT ... ON CONFLICT (grain) DO UPDATE SET <all>``: source rows replace matches.

    ``source`` must be unique on ``grain`` (assert it first, see checks.assert_grain).
    """
    kept = anti_join(target, source, grain)
    return kept.unionByName(source.select(*target.columns))
