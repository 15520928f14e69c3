"""Helpers shared by the operators: lineage cuts, row identity, words and hashes in numpy.

Words are maximal byte runs outside a separator set. All hashes are pure
functions of the bytes, so a retried or re-run task names things alike.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.session import require_shared

U64 = np.uint64
_BYTE_BASE = 0x9E3779B97F4A7C15 | 1
_WORD_BASE = 0xC2B2AE3D27D4EB4F | 1
_MASK = (1 << 64) - 1
SLICE_BYTES = 1 << 20  # bytes hashed at a time
CHUNK_BYTES = 4 << 20  # text bytes worked on at a time inside a task


# ---------------------------------------------------------------- driver side
def shared_dir(spark: SparkSession) -> str:
    """A fresh folder below ``spark.checkpoint.dir``, which all executors share.

    Only a local session that names none falls back to a temporary folder.
    """
    base = spark.sparkContext.getConf().get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        import tempfile

        base = tempfile.mkdtemp(prefix="tidemark-llm-", dir="/tmp")
        spark.sparkContext.setCheckpointDir(base)
    require_shared(spark, base)
    path = f"{base.rstrip('/')}/llm-{uuid.uuid4().hex}"
    _FOLDERS.append(path)
    return path


_FOLDERS: list[str] = []  # made by this process and not removed


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Remove the folders that operators make inside the block; what they return must be written before it ends."""
    mark = len(_FOLDERS)
    try:
        yield
    finally:
        for path in _FOLDERS[mark:]:
            hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
            hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop, True)
        del _FOLDERS[mark:]


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Cut the lineage: write ``df`` as Parquet in the shared folder and read it back."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def id_key(df: DataFrame, id_col: str) -> Column:
    """The id as a non-null long: itself if integral, else its 64-bit hash; for joins beside a hash of the text."""
    kind = df.schema[id_col].dataType
    if isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return F.coalesce(F.col(id_col).cast("long"), F.lit(-(1 << 63)).cast("long"))
    return F.xxhash64(F.col(id_col))


def other_columns(df: DataFrame, taken: list[str]) -> list[str]:
    """Columns of ``df`` whose names are none of ``taken``, case aside."""
    low = {t.lower() for t in taken}
    return [c for c in df.columns if c.lower() not in low]


def text_bytes(df: DataFrame, text_col: str) -> int:
    """UTF-8 bytes of all texts (one narrow job), for sizing partitions."""
    return int(df.agg(F.sum(F.octet_length(F.col(text_col)))).first()[0] or 0)


# ------------------------------------------------------------------ task side
def byte_table(separators) -> np.ndarray:
    """256 booleans: True for separator bytes."""
    table = np.zeros(256, dtype=bool)
    table[list(separators)] = True
    return table


SPACES = byte_table([0x20, *range(0x09, 0x0E)])
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finalizer."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U64(27))
    x = x * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


_POWERS: dict = {}


def _powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i modulo 2**64 for i below n."""
    have = _POWERS.get(base)
    if have is None or len(have[0]) < n:
        size = max(n, 1 << 16)
        both = []
        for b in (base, pow(base, -1, 1 << 64)):
            p = np.full(size, b, dtype=U64)
            p[0] = 1
            both.append(np.multiply.accumulate(p))
        _POWERS[base] = have = tuple(both)
    return have


def span_hash(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: int = _WORD_BASE) -> np.ndarray:
    """Hash of values[start:end] for each span, by prefix sums of a polynomial (spans may overlap)."""
    n = len(values)
    power, inverse = _powers(base, n + 1)
    prefix = np.zeros(n + 1, dtype=U64)
    np.cumsum(values * power[:n], out=prefix[1:])
    out = (prefix[ends] - prefix[starts]) * inverse[starts]
    return mix(out + (ends - starts).astype(U64) * U64(0xD6E8FEB86659FD93))


def word_spans(buf: np.ndarray, bounds: np.ndarray, separators: np.ndarray = SPACES) -> tuple[np.ndarray, np.ndarray]:
    """Byte starts and ends of the words of ``buf``; no word crosses a text boundary in ``bounds``."""
    inside = np.zeros(len(buf) + 2, dtype=bool)
    np.logical_not(separators[buf], out=inside[1:-1])
    first = inside[1:] & ~inside[:-1]  # position i starts a word; the last entry is past the end
    last = inside[:-1] & ~inside[1:]  # position i ends a word (exclusive)
    cuts = bounds[(bounds > 0) & (bounds < len(buf))]
    cuts = cuts[inside[cuts] & inside[cuts + 1]]
    first[cuts] = True
    last[cuts] = True
    return np.flatnonzero(first), np.flatnonzero(last)


def word_hash(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each word, worked out in slices of bounded length."""
    out = np.empty(len(starts), dtype=U64)
    i = 0
    while i < len(starts):
        j = max(i + 1, int(np.searchsorted(ends, starts[i] + SLICE_BYTES, "right")))
        base = starts[i]
        piece = buf[base : ends[j - 1]].astype(U64) + U64(1)
        out[i:j] = span_hash(piece, starts[i:j] - base, ends[i:j] - base, _BYTE_BASE)
        i = j
    return out


def text_column(batch: pa.RecordBatch, name: str) -> pa.Array:
    """The column as an Arrow string array without nulls (null: empty)."""
    import pyarrow.compute as pc

    col = batch.column(batch.schema.get_field_index(name))
    if not pa.types.is_large_string(col.type):
        col = col.cast(pa.large_string())
    return pc.fill_null(col, "") if col.null_count else col


def chunks(col: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Rows i to j with their bytes and byte bounds (j - i + 1 of them), about ``limit`` bytes at a time."""
    n = len(col)
    if not n:
        return
    buffers = col.buffers()
    offsets = np.frombuffer(buffers[1], dtype=np.int64)[col.offset : col.offset + n + 1]
    data = np.frombuffer(buffers[2], dtype=np.uint8) if buffers[2] is not None else np.zeros(0, np.uint8)
    i = 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + limit, "right")) - 1)
        yield i, j, data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
        i = j


def words_per_text(starts: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Index of the first word of each text, and the number of words at the end."""
    return np.searchsorted(starts, bounds, "left")


# ------------------------------------------------------------- rows with a text
def _append_columns(batches, work, text_at: int, carried: int, names: list[str]):
    for batch in batches:
        parts = [work(i, j, buf, bounds) for i, j, buf, bounds in chunks(text_column(batch, batch.schema.names[text_at]))]
        if parts:
            new = [pa.concat_arrays(column) for column in zip(*parts, strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:carried], *new], names)


def map_texts(df: DataFrame, text_col: str, carry: list[str], work, fields: list[T.StructField], row: str | None = None) -> DataFrame:
    """The columns ``carry`` of ``df`` and the ``fields`` that ``work(i, j, buf, bounds)`` returns for rows i to j of a batch.

    A text goes to Python once, also when it is one of the carried columns; null is empty there. With ``row`` the carried
    columns come back as a struct of that name, so that they cannot clash with the fields.
    """
    held = list(carry) if text_col in carry else [*carry, text_col]
    base = df.select(*[F.col(f"`{c}`").alias(f"_c{k}") for k, c in enumerate(held)])
    names = [f"_c{k}" for k in range(len(carry))] + [f.name for f in fields]
    schema = T.StructType([T.StructField(f"_c{k}", df.schema[c].dataType) for k, c in enumerate(carry)] + list(fields))
    out = base.mapInArrow(partial(_append_columns, work=work, text_at=held.index(text_col), carried=len(carry), names=names), schema)
    own = [F.col(f"_c{k}").alias(c) for k, c in enumerate(carry)]
    return out.select(*([F.struct(F.lit(0).alias("_"), *own).alias(row)] if row else own), *[f.name for f in fields])
