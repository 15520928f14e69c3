"""Two-pass external shuffle into shards.

Pass 1 scatters records with seeded hashes: the id and the number of shards
decide the shard (highest random weight, so one more shard takes rows only into
itself), and a hash of the record decides one of the shard's buckets, of which
there are enough for a bucket to fit in memory. Pass 2 puts each bucket into a
canonical order, shuffles it (Fisher-Yates, seeded by shard and bucket) and
numbers it after the buckets before it. A retried task deals and shuffles alike.

Null ids share one shard but spread over its buckets by their texts. Null text
has size 8 (no bytes). Repeated rows are kept; equal rows are interchangeable.
A single record larger than a bucket makes a bucket of its own size.
"""

from __future__ import annotations

from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import other_columns, shared_dir, text_bytes

FRAME = 8  # bytes a record takes besides its text
ADDED = ["size", "shard", "bucket", "slot", "grown_shard"]


def _weight(id_col: str, shard: int, seed: int) -> Column:
    return F.struct(F.xxhash64(F.lit(seed), F.col(id_col), F.lit(shard)).alias("w"), F.lit(shard).alias("shard"))


def _shuffle(key, tbl: pa.Table, seed: int) -> pa.Table:
    shard, bucket = key[0].as_py(), key[1].as_py()
    tbl = tbl.take(pa.compute.sort_indices(tbl, sort_keys=[("_order", "ascending"), ("_tie", "ascending")]))
    rng = np.random.default_rng([seed, shard, bucket])
    tbl = tbl.take(pa.array(rng.permutation(len(tbl))))  # Fisher-Yates
    slot = pa.array(np.arange(len(tbl), dtype=np.int64))
    slot = pa.compute.add(slot, tbl.column("_offset").combine_chunks())
    return tbl.drop_columns(["_order", "_tie", "_offset"]).append_column("_slot", slot)


def shuffle_into_shards(
    df: DataFrame, shards: int = 24, id_col: str = "doc_id", text_col: str = "text", seed: int = 7, bucket_bytes: int = 16 << 20
) -> DataFrame:
    """All rows of ``df`` with size, shard, bucket, slot (gapless in each shard) and grown_shard (with one more shard).

    Input columns with these names are replaced.
    """
    names = other_columns(df, ADDED)
    buckets = max(1, -(-text_bytes(df, text_col) // (shards * bucket_bytes)))
    hashed = [F.col(f"`{f.name}`") for f in df.schema.fields if f.name in names and not isinstance(f.dataType, (T.MapType, T.VariantType))]
    best = F.greatest(*[_weight(id_col, s, seed) for s in range(shards)]) if shards > 1 else _weight(id_col, 0, seed)
    dealt = df.select(
        F.struct(*[F.col(f"`{c}`") for c in names]).alias("_row"),
        best.alias("_best"),
        _weight(id_col, shards, seed).alias("_next"),
        F.xxhash64(F.lit(seed + 1), *hashed).alias("_order"),
        F.xxhash64(F.lit(seed + 2), *hashed).alias("_tie"),
        (F.coalesce(F.octet_length(F.col(text_col)), F.lit(0)) + F.lit(FRAME)).cast("long").alias("_size"),
    )
    dealt = dealt.select(
        "_row", "_order", "_tie", "_size",
        F.col("_best.shard").alias("_shard"),
        F.when(F.col("_next.w") > F.col("_best.w"), F.lit(shards)).otherwise(F.col("_best.shard")).alias("_grown"),
        F.pmod(F.xxhash64(F.lit(seed + 3), F.col("_order")), F.lit(buckets)).alias("_bucket"),
    )
    sizes = dealt.groupBy("_shard", "_bucket").agg(F.count("*").alias("_rows"))
    before = Window.partitionBy("_shard").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_shard", "_bucket", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"))
    dealt = dealt.join(offsets, ["_shard", "_bucket"])
    kept = ["_shard", "_bucket", "_row", "_size", "_grown"]
    schema = T.StructType([dealt.schema[c] for c in kept] + [T.StructField("_slot", T.LongType())])
    out = dealt.groupBy("_shard", "_bucket").applyInArrow(_in_order(partial(_shuffle, seed=seed), [*kept, "_slot"]), schema)
    return out.select(
        *[F.col("_row").getField(c).alias(c) for c in names],
        F.col("_size").alias("size"), F.col("_shard").alias("shard"), F.col("_bucket").alias("bucket"),
        F.col("_slot").alias("slot"), F.col("_grown").alias("grown_shard"),
    )


def _in_order(fn, names):
    def run(key, tbl):
        return fn(key, tbl).select(names)

    return run


def write_shards(shuffled: DataFrame, path: str | None = None) -> str:
    """Write one folder per shard, a file per bucket in slot order; returns the path."""
    path = path or f"{shared_dir(shuffled.sparkSession)}/shards"
    shuffled.repartition("shard", "bucket").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
    return path
