"""Target-distribution importance resampling over hashed n-gram buckets.

Documents are drawn so that their n-grams look like those of a target set. Each
n-gram (1 to ``max_n`` words, joined by one space) falls into the bucket CRC-32
of its bytes modulo ``buckets``. With s of S corpus n-grams and t of T target
n-grams in a bucket its gain is

    floor(1000 ln((t + 1)(S + buckets) / ((s + 1)(T + buckets))))

A document weighs the floored mean gain of its n-grams, and Gumbel noise hashed
from its id turns the weights into a draw without replacement: the highest
scores are taken.

N-grams are interned chunk by chunk in an open-addressed table over NumPy
arrays. The key of an n-gram is the xxhash64 of its bytes; a slot is probed
linearly and only shared after its bytes were compared, so that two n-grams of
one key stay apart. Beside each entry stand its bucket and its count: a CRC-32
is worked out once per distinct n-gram of a chunk, and occurrences, which hold
the number of their entry, gather their gains from there.

Pass one counts both tables (at most ``buckets`` rows per task, summed by
Spark; the gains reach the driver, ``buckets`` numbers whatever the corpus).
Pass two weighs every document and is written once. Ranks need no global sort:
scores are whole numbers within about +-50,000, so a histogram of them has a
bounded number of rows, gives how many documents stand above each score, and
only the drawn documents are numbered within their score.

Null or blank text has no n-grams and weight 0. A null id is noised as the
empty string; rows with equal ids and scores are ranked by a hash of the row's
weight and columns. Empty tables give empty results; with an empty target the
gains favour rare buckets. Input columns with the names of the results are
replaced.
"""

from __future__ import annotations

import math
import zlib
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import LOWER, U64, byte_table, chunks, map_texts, materialize, other_columns, text_column, word_spans, words_per_text

BREAKS = byte_table([*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)])
BLOCK = 1 << 16  # occurrences put into the table at a time

# The constants of xxhash64.
P1, P2, P3, P4, P5 = (
    U64(x) for x in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5)
)


# ------------------------------------------------------------- keys of spans
def _turn(x: np.ndarray, by: int) -> np.ndarray:
    return (x << U64(by)) | (x >> U64(64 - by))


class Spans:
    """Byte spans of one buffer, compared and hashed eight bytes at a time."""

    def __init__(self, buf: np.ndarray, starts: np.ndarray, ends: np.ndarray):
        self.padded = np.concatenate((buf, np.zeros(8, np.uint8)))
        self.lanes = np.ndarray((len(buf) + 1,), dtype="<u8", buffer=self.padded, strides=(1,))
        self.starts, self.length = starts, ends - starts

    def lane(self, which: np.ndarray, k: int) -> np.ndarray:
        """Bytes 8k to 8k + 8 of the spans ``which``; all of them must be that long or end inside."""
        n = np.minimum(self.length[which] - 8 * k, 8).astype(U64)
        raw = self.lanes[self.starts[which] + 8 * k]
        return raw & (~U64(0) >> (U64(64) - U64(8) * n))

    def data(self, i: int) -> bytes:
        return self.padded[self.starts[i] : self.starts[i] + self.length[i]].tobytes()

    def keys(self, lo: int, hi: int) -> np.ndarray:
        """xxhash64 (seed 0) of the spans lo to hi."""
        import xxhash

        n = self.length[lo:hi]
        h = P5 + n.astype(U64)
        at = self.starts[lo:hi]
        for k in range(3):
            some = np.flatnonzero((n >= 8 * (k + 1)) & (n < 32))
            if len(some):
                h[some] = _turn(h[some] ^ (_turn(self.lanes[at[some] + 8 * k] * P2, 31) * P1), 27) * P1 + P4
        done = n & ~7
        some = np.flatnonzero((n & 4) > 0)
        four = self.lanes[at[some] + done[some]] & U64(0xFFFFFFFF)
        h[some] = _turn(h[some] ^ (four * P1), 23) * P2 + P3
        done = n & ~3
        for k in range(3):
            some = np.flatnonzero((n & 3) > k)
            h[some] = _turn(h[some] ^ (self.padded[at[some] + done[some] + k].astype(U64) * P5), 11) * P1
        h = (h ^ (h >> U64(33))) * P2
        h = (h ^ (h >> U64(29))) * P3
        h ^= h >> U64(32)
        for i in np.flatnonzero(n >= 32):
            h[i] = xxhash.xxh64_intdigest(self.data(lo + i))
        return h

    def equal(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether the spans a[i] and b[i] hold the same bytes."""
        same = self.length[a] == self.length[b]
        k = 0
        some = np.flatnonzero(same & (self.length[a] > 0))
        while len(some):
            differ = self.lane(a[some], k) != self.lane(b[some], k)
            same[some[differ]] = False
            k += 1
            some = some[~differ & (self.length[a[some]] > 8 * k)]
        return same


class Table:
    """Open-addressed table of the distinct spans of one chunk."""

    def __init__(self, spans: Spans, buckets: int, hashed=None):
        self.spans, self.buckets = spans, buckets
        self.home = np.full(2 * BLOCK, -1, dtype=np.int64)  # entry at a slot, -1: free
        self.size = 0
        self.key = np.zeros(BLOCK, U64)
        self.first = np.zeros(BLOCK, np.int64)  # the span that an entry is compared with
        hashed = hashed or spans.keys
        self.entry = np.empty(len(spans.starts), np.int64)  # of each occurrence
        for lo in range(0, len(self.entry), BLOCK):
            hi = min(lo + BLOCK, len(self.entry))
            self._reserve(self.size + hi - lo)
            self._put(np.arange(lo, hi), hashed(lo, hi))
        self.count = np.bincount(self.entry, minlength=self.size)
        self.bucket = np.fromiter((zlib.crc32(spans.data(i)) % buckets for i in self.first[: self.size]), np.int64, self.size)

    def _reserve(self, entries: int) -> None:
        """Room for ``entries`` of them at a load of one half at most; a wider table is filled anew."""
        if entries > len(self.key):
            grow = max(entries, 2 * len(self.key)) - len(self.key)
            self.key, self.first = np.append(self.key, np.zeros(grow, U64)), np.append(self.first, np.zeros(grow, np.int64))
        if 2 * entries > len(self.home):
            self.home = np.full(1 << (4 * entries - 1).bit_length(), -1, dtype=np.int64)
            mask = len(self.home) - 1
            left = np.arange(self.size)
            slot = (self.key[: self.size] & U64(mask)).astype(np.int64)
            while len(left):
                free = self.home[slot[left]] < 0
                self.home[slot[left[free]]] = left[free]  # of several, the last stays
                left = left[self.home[slot[left]] != left]
                slot[left] = (slot[left] + 1) & mask

    def _put(self, which: np.ndarray, keys: np.ndarray) -> None:
        """Find or add the entries of the spans ``which``."""
        mask = len(self.home) - 1
        slot = (keys & U64(mask)).astype(np.int64)
        left = np.arange(len(which))
        while len(left):
            at = slot[left]
            free = np.flatnonzero(self.home[at] < 0)
            if len(free):  # one occurrence claims each free slot
                claimed, by = np.unique(at[free], return_index=True)
                owner = left[free[by]]
                new = np.arange(self.size, self.size + len(owner))
                self.home[claimed], self.key[new], self.first[new] = new, keys[owner], which[owner]
                self.size += len(owner)
            found = self.home[at]
            hit = self.key[found] == keys[left]
            same = np.flatnonzero(hit)
            hit[same] = self.spans.equal(which[left[same]], self.first[found[same]])
            self.entry[which[left[hit]]] = found[hit]
            left = left[~hit]
            slot[left] = (slot[left] + 1) & mask


def ngrams(buf: np.ndarray, bounds: np.ndarray, max_n: int) -> tuple[Spans, np.ndarray, np.ndarray]:
    """Spans of all 1- to ``max_n``-grams of lower-cased words, the text of each, and words per text."""
    low = LOWER[buf]
    starts, ends = word_spans(low, bounds, BREAKS)
    n_words = np.diff(words_per_text(starts, bounds))
    doc = np.repeat(np.arange(len(n_words)), n_words)
    if max_n == 1:
        return Spans(low, starts, ends), doc, n_words
    size = ends - starts
    to = np.cumsum(size + 1) - size - 1  # each word, followed by one space
    joined = np.full(int(size.sum()) + len(size), 0x20, np.uint8)
    shift = np.repeat(to - starts, size)
    source = np.repeat(starts, size) + np.arange(len(shift)) - np.repeat(np.cumsum(size) - size, size)
    joined[source + shift] = low[source]
    lo, hi, of = [], [], []
    for k in range(1, max_n + 1):
        first = np.flatnonzero(doc[: len(doc) - k + 1] == doc[k - 1 :]) if len(doc) >= k else np.zeros(0, np.int64)
        lo.append(to[first])
        hi.append((to + size)[first + k - 1])
        of.append(doc[first])
    return Spans(joined, np.concatenate(lo), np.concatenate(hi)), np.concatenate(of), n_words


# ------------------------------------------------------------------ task side
def _count(batches, max_n: int, buckets: int):
    total = np.zeros(buckets, np.int64)
    for batch in batches:
        for _, _, buf, bounds in chunks(text_column(batch, "_text")):
            table = Table(ngrams(buf, bounds, max_n)[0], buckets)
            np.add.at(total, table.bucket, table.count)
    held = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(held, pa.int64()), pa.array(total[held], pa.int64())], ["bucket", "n"])


def _weigh(i, j, buf, bounds, gains: np.ndarray, max_n: int):
    spans, doc, n_words = ngrams(buf, bounds, max_n)
    table = Table(spans, len(gains))
    each = gains[table.bucket][table.entry]
    n = np.bincount(doc, minlength=j - i)
    total = np.zeros(j - i, np.int64)
    np.add.at(total, doc, each)
    weight = np.where(n > 0, total // np.maximum(n, 1), 0)
    return [pa.array(x.astype(np.int64)) for x in (n_words, n, weight)]


# ---------------------------------------------------------------- driver side
def bucket_counts(df: DataFrame, text_col: str = "text", max_n: int = 1, buckets: int = 10_000) -> DataFrame:
    """(bucket, n): n-grams of all texts by bucket; buckets without any are left out."""
    texts = df.select(F.col(text_col).alias("_text"))
    return texts.mapInArrow(partial(_count, max_n=max_n, buckets=buckets), "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def bucket_gains(corpus: DataFrame, target: DataFrame, text_col: str = "text", max_n: int = 1, buckets: int = 10_000) -> np.ndarray:
    """Gain of each bucket: ``buckets`` numbers, from two aggregated counts of as many rows at most."""
    counts = []
    for df in (corpus, target):
        n = np.zeros(buckets, np.int64)
        for r in bucket_counts(df, text_col, max_n, buckets).collect():
            n[r["bucket"]] = r["n"]
        counts.append(n.tolist())
    s, t = counts
    size, aim = sum(s) + buckets, sum(t) + buckets
    return np.array([math.floor(1000 * math.log((b + 1) * size / ((a + 1) * aim))) for a, b in zip(s, t, strict=True)], dtype=np.int64)


def rank_highest(rows: DataFrame, eligible: str, percent: int, id_col: str, score: str = "score", rank: str = "rank") -> DataFrame:
    """``rows`` with ``rank``: 1 for the highest score, up to ``percent`` of the rows with ``eligible``; null for the others.

    ``rows`` is read three times and should be a written table. Scores must be
    whole numbers of a bounded range: their histogram is summed in one task.
    """
    names = other_columns(rows, [rank])
    hashed = [F.col(f"`{c}`") for c in names if rows.schema[c].dataType.simpleString()[:3] not in ("map", "var")]
    rows = rows.select(
        F.struct(*[F.col(f"`{c}`") for c in names]).alias("_row"), F.when(F.expr(eligible), F.col(score)).alias("_at"),
        F.col(f"`{id_col}`").alias("_id"), F.xxhash64(*hashed).alias("_tie"),
    )
    histogram = rows.filter("_at IS NOT NULL").groupBy(F.col("_at").alias("_score")).agg(F.count("*").alias("_n"))
    size = histogram.agg(F.sum("_n")).first()[0] or 0
    drawn = size * percent // 100
    before = Window.orderBy(F.desc("_score")).rowsBetween(Window.unboundedPreceding, -1)
    above = histogram.select("_score", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_above")).filter(F.col("_above") < drawn)
    # at most one row per score of the range
    marked = rows.join(F.broadcast(above), F.col("_at") == F.col("_score"), "left")
    place = F.row_number().over(Window.partitionBy("_score").orderBy(F.col("_id").asc_nulls_first(), "_tie")) + F.col("_above")
    taken = marked.filter("_above IS NOT NULL").select("_row", F.when(place <= drawn, place).cast("long").alias("_rank"))
    left = marked.filter("_above IS NULL").select("_row", F.lit(None).cast("long").alias("_rank"))
    return taken.unionByName(left).select(*[F.col("_row").getField(c).alias(c) for c in names], F.col("_rank").alias(rank))


def resample(
    df: DataFrame, target: DataFrame, percent: int = 10, max_n: int = 1, buckets: int = 10_000, min_words: int = 20, seed: str = "2024",
    id_col: str = "doc_id", text_col: str = "text", columns: list[str] | None = None,
) -> DataFrame:
    """Columns ``columns`` of ``df`` (default: all) with n_words, n_features, weight, score and rank (null: not drawn).

    Drawn are the ``percent`` highest scores of the documents with at least ``min_words`` words.
    """
    if not 0 <= percent <= 100:
        raise ValueError("percent must be from 0 to 100")
    gains = bucket_gains(df, target, text_col, max_n, buckets)
    new = ["n_words", "n_features", "weight", "score", "rank"]
    kept = other_columns(df.select(*[f"`{c}`" for c in columns]) if columns is not None else df, new)
    carry = kept if id_col in kept else [*kept, id_col]
    fields = [T.StructField(n, T.LongType()) for n in new[:3]]
    weighed = map_texts(df, text_col, carry, partial(_weigh, gains=gains, max_n=max_n), fields)
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit(""))), 256)
    uniform = (F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") + F.lit(0.5)) / F.lit(4294967296.0)
    noise = F.floor(F.lit(-1000.0) * F.log(-F.log(uniform)))
    scored = materialize(weighed.withColumn("score", (F.col("weight") + noise).cast("long")), "scored")
    return rank_highest(scored, f"n_words >= {int(min_words)}", percent, id_col).select(*[f"`{c}`" for c in kept], *new)
