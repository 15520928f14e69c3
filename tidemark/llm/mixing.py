"""Mixing sources to target weights by iterative proportional fitting.

Documents are tallied into cells of source, language and topic. Raking scales
the cells' token counts to each dimension's target shares in turn until all
three hold. The ratio of a cell's raked to its own tokens, scaled so that the
expected tokens are ``keep_share`` of all, is its weight; documents are drawn
with that probability (1 at most) by a seeded hash, and what the bound of 1
takes away stays as ``weight``, so weighted tokens meet the targets in
expectation. Without a ``keep_share`` as much is kept as no cell's probability
exceeds 1 by: every weight is 1, and the drawn tokens themselves meet the
targets in expectation.

Targets are given as shares per category, or as a power of the dimension's own
shares. Every category has its own target; only those that given shares do not
name form one category, which gets what the named ones leave. If no dimension has
more than ``MAX_CATEGORIES`` categories, the cells are raked on the driver, else
on Spark: the cells stay a table, a step is one grouped sum over them, and of
each dimension a table of factors is carried from step to step.

Null and empty categories form one category. Null text has no tokens; a document
without tokens is drawn like its cell, or always if its cell has no tokens.
Repeated rows (same id and text) are drawn together.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import id_key, materialize, other_columns

MAX_CATEGORIES = 100  # of each dimension, for raking on the driver
KEYS = ("_s", "_l", "_t")
OTHER, NONE = "(other)", "(none)"


def topic_of(text: Column) -> Column:
    """A document's topic by its most telling mark: tables, licences, contacts, prose."""
    return (
        F.when(F.coalesce(F.trim(text), F.lit("")) == "", NONE)
        .when(F.contains(text, F.lit(" | ")), "table")
        .when(F.contains(text, F.lit("License")), "licence")
        .when(F.contains(text, F.lit("@")), "contact")
        .otherwise("prose")
    )


def count_tokens(text: Column) -> Column:
    """Words between ASCII white space."""
    parts = F.split(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+")
    ends = (F.get(parts, F.lit(0)) == "").cast("int") + F.when(F.size(parts) > 1, (F.get(parts, F.size(parts) - 1) == "").cast("int")).otherwise(0)
    return (F.size(parts) - ends).cast("long")


def rake(tokens: np.ndarray, codes: np.ndarray, targets: list[np.ndarray], rounds: int = 200, within: float = 1e-9) -> np.ndarray:
    """Scale cell tokens to the target shares of each dimension in turn; codes[d] is each cell's category."""
    x = tokens.astype(float)
    total = x.sum()
    if total <= 0:
        return x
    for _ in range(rounds):
        worst = 0.0
        for code, share in zip(codes, targets, strict=True):
            have = np.bincount(code, weights=x, minlength=len(share))
            possible = np.where(have > 0, share, 0)
            want = possible / max(possible.sum(), 1e-300) * total
            scale = np.divide(want, have, out=np.ones_like(want), where=have > 0)
            worst = max(worst, float(np.abs(scale[have > 0] - 1).max(initial=0)))
            x *= scale[code]
        if worst < within:
            break
    return x


def probabilities(tokens: np.ndarray, raked: np.ndarray, keep_share: float | None) -> tuple[np.ndarray, np.ndarray]:
    """(probability, weight) of each cell: weight is what a drawn document counts."""
    ratio = np.divide(raked, tokens, out=np.full(len(tokens), np.inf), where=tokens > 0)
    if keep_share is None:
        most = ratio[np.isfinite(ratio)].max(initial=0.0)
        return np.where(np.isfinite(ratio), ratio / (most or 1.0), 1.0), np.ones(len(ratio))
    goal = keep_share * tokens.sum()
    low, high = 0.0, 1.0
    finite = ratio[np.isfinite(ratio) & (ratio > 0)]
    if len(finite):
        high = 1.0 / finite.min()
    for _ in range(200):
        scale = (low + high) / 2
        if (tokens * np.minimum(1, np.where(np.isfinite(ratio), ratio, 0) * scale)).sum() < goal:
            low = scale
        else:
            high = scale
    raw = np.where(np.isfinite(ratio), ratio, 1 / max(high, 1e-300)) * high
    p = np.minimum(1, raw)
    return p, np.divide(raw, p, out=np.ones_like(raw), where=p > 0)


def rake_cells(cells: DataFrame, targets: list[dict[str, float] | float], keep_share: float | None, rounds: int = 200, within: float = 1e-9) -> DataFrame:
    """``rake`` and ``probabilities`` on Spark: the keys of each cell with _p and _w. The driver sees sums only."""
    spark = cells.sparkSession
    total = float(cells.agg(F.sum("tokens")).first()[0] or 0)
    factors = {}
    for k, target in zip(KEYS, targets, strict=True):
        own = cells.groupBy(k).agg(F.sum("tokens").alias("_have"))
        if isinstance(target, dict):
            given = {OTHER: max(0.0, 1 - sum(target.values()))} | target
            own = own.join(spark.createDataFrame([(c, float(v)) for c, v in given.items()], f"{k} string, _share double"), k, "left").fillna(0.0, ["_share"])
        else:
            own = own.withColumn("_share", F.when(F.col("_have") > 0, F.pow(F.col("_have").cast("double"), F.lit(float(target)))).otherwise(0.0))
        factors[k] = materialize(own.select(k, "_share", F.lit(1.0).alias(f"f{k}")), "factors")

    def scaled() -> DataFrame:
        out = cells
        for k in KEYS:
            out = out.join(factors[k].select(k, f"f{k}"), k)
        return out.select(*KEYS, "tokens", (F.col("tokens") * F.col("f_s") * F.col("f_l") * F.col("f_t")).alias("_x"))

    for _ in range(rounds if total > 0 else 0):
        worst = 0.0
        for k in KEYS:
            step = materialize(scaled().groupBy(k).agg(F.sum("_x").alias("_have")).join(factors[k], k), "factors")
            ratio = F.col("_share") / F.col("_have")
            possible, most, least = step.filter("_have > 0").agg(F.sum("_share"), F.max(ratio), F.min(ratio)).first()
            unit = total / max(possible or 0.0, 1e-300)
            worst = max(worst, abs((most or 0.0) * unit - 1), abs((least or 0.0) * unit - 1))
            factors[k] = step.select(k, "_share", (F.col(f"f{k}") * F.when(F.col("_have") > 0, ratio * unit).otherwise(1.0)).alias(f"f{k}"))
        if worst < within:
            break
    raked = materialize(scaled(), "raked")
    if keep_share is None:
        most = raked.filter("tokens > 0").agg(F.max(F.col("_x") / F.col("tokens"))).first()[0]
        p = F.when(F.col("tokens") > 0, F.least(F.lit(1.0), F.col("_x") / F.col("tokens") / F.lit(most or 1.0))).otherwise(1.0)
        return materialize(raked.select(*KEYS, p.alias("_p"), F.lit(1.0).alias("_w")), "probabilities")
    # the kept tokens are concave in the scale, so steps along the tangent rise to the goal and end after finitely many
    goal, scale = keep_share * total, 0.0
    least = raked.filter("tokens > 0 AND _x > 0").agg(F.min(F.col("_x") / F.col("tokens"))).first()[0]
    while least:
        full = F.col("_x") * scale >= F.col("tokens")
        capped, free = raked.filter("tokens > 0 AND _x > 0").agg(F.sum(F.when(full, F.col("tokens")).otherwise(0)), F.sum(F.when(full, 0.0).otherwise(F.col("_x")))).first()
        after = min((goal - capped) / free, 1 / least) if free else 1 / least if goal > capped else scale
        if after <= scale * (1 + 1e-12):
            break
        scale = after
    raw = F.when(F.col("tokens") > 0, F.col("_x") / F.col("tokens") * scale).otherwise(1.0)
    p = F.least(F.lit(1.0), raw)
    return materialize(raked.select(*KEYS, p.alias("_p"), F.when(p > 0, raw / p).otherwise(1.0).alias("_w")), "probabilities")


def _raked_on_driver(tally: DataFrame, targets: list[dict[str, float] | float], keep_share: float | None) -> DataFrame:
    """``rake_cells`` for at most MAX_CATEGORIES**3 cells."""
    cells = sorted(tally.select(*KEYS, "tokens").collect(), key=tuple)
    tokens = np.array([c["tokens"] for c in cells], dtype=float)
    codes, shares = [], []
    for k, target in zip(KEYS, targets, strict=True):
        found = sorted({c[k] for c in cells})
        code = np.array([found.index(c[k]) for c in cells], dtype=np.int64)
        have = np.bincount(code, weights=tokens, minlength=len(found))
        if isinstance(target, dict):
            given = {OTHER: max(0.0, 1 - sum(target.values()))} | target
            share = np.array([given.get(c, 0.0) for c in found])
        else:
            share = np.array([h**target if h > 0 else 0.0 for h in have])
        codes.append(code)
        shares.append(share / share.sum() if share.sum() > 0 else share)
    p, weight = probabilities(tokens, rake(tokens, np.array(codes), shares), keep_share) if len(cells) else (tokens, tokens)
    table = [(*[c[k] for k in KEYS], float(a), float(w)) for c, a, w in zip(cells, p, weight, strict=True) if math.isfinite(a)]
    return tally.sparkSession.createDataFrame(table, "_s string, _l string, _t string, _p double, _w double")


def mix_sources(
    df: DataFrame, targets: dict[str, dict[str, float] | float] | None = None, id_col: str = "doc_id", text_col: str = "text",
    topic: Column | None = None, keep_share: float | None = 0.7, seed: int = 11,
) -> DataFrame:
    """The drawn rows of ``df`` with topic, tokens, probability and weight; input columns with these names are replaced.

    ``targets`` maps source, lang and topic to shares per category or to a power
    (default 0.7: large categories give way, but stay the largest). ``keep_share`` None keeps the most at weight 1.
    """
    dims = ["source", "lang", "topic"]
    targets = {d: 0.7 for d in dims} | (targets or {})
    names = other_columns(df, ["topic", "tokens", "probability", "weight"])
    told = {"source": F.col("source"), "lang": F.col("lang"), "topic": topic if topic is not None else topic_of(F.col(text_col))}
    named = [F.when(F.coalesce(c.cast("string"), F.lit("")) == "", NONE).otherwise(c.cast("string")).alias(f"_{d}") for d, c in told.items()]
    rows = df.select(
        F.struct(*[F.col(f"`{c}`") for c in names]).alias("_row"), *named, count_tokens(F.col(text_col)).alias("_tokens"),
        (F.shiftrightunsigned(F.xxhash64(F.lit(seed), id_key(df, id_col), F.xxhash64(F.col(text_col))), 11) / F.lit(float(1 << 53))).alias("_u"),
    )
    tally = rows.groupBy(*[f"_{d}" for d in dims]).agg(F.sum("_tokens").alias("tokens"))
    pooled = {d: F.when(F.col(f"_{d}").isin(list(targets[d])), F.col(f"_{d}")).otherwise(OTHER) if isinstance(targets[d], dict) else F.col(f"_{d}") for d in dims}
    keyed = [pooled[d].alias(k) for d, k in zip(dims, KEYS, strict=True)]
    tally = materialize(tally.groupBy(*keyed).agg(F.coalesce(F.sum("tokens"), F.lit(0)).alias("tokens")), "cells")
    rows = rows.select("_row", "_topic", "_tokens", "_u", *keyed)
    if max(tally.agg(*[F.count_distinct(k) for k in KEYS]).first()) > MAX_CATEGORIES:
        drawn = rake_cells(tally, [targets[d] for d in dims], keep_share)
    else:
        drawn = F.broadcast(_raked_on_driver(tally, [targets[d] for d in dims], keep_share))
    rows = rows.join(drawn, list(KEYS)).filter(F.col("_u") < F.col("_p"))
    return rows.select(
        *[F.col("_row").getField(c).alias(c) for c in names],
        F.col("_topic").alias("topic"), F.col("_tokens").alias("tokens"), F.col("_p").alias("probability"), F.col("_w").alias("weight"),
    )
