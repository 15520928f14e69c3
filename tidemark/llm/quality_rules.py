"""Quality rules: counts of words and lines, and compression bands.

A text that repeats itself compresses too well, and noise (encoded bytes, keys,
random letters) too badly. How well plain prose compresses depends on its
length, as a compressor needs some text before it finds anything to refer to.
So the limits are bands: of a whole document by its UTF-8 length, and of its
chunks of ``CHUNK`` bytes, which find a repetitive or incompressible stretch
that a long text would average out. A document fails when its whole ratio
(bytes / zstandard bytes) is outside the band of its length, or when chunks
outside theirs hold more than ``BAD_SHARE`` of its bytes. A last piece shorter
than ``MIN_CHUNK`` joins the chunk before it; a document of one chunk is judged
as a whole only.

Before that come plain counts (``base_failed``): too few words, or too many
words in three-word windows that the text holds twice or more.

Null text is empty: no words, base_failed, not kept. White space only is the
same. Rows are judged one by one, so ties, repeated rows and repeated ids give
equal verdicts; an empty table gives an empty result. Whole texts are read; a
very long one is worked on alone, chunk after chunk. Input columns with the
names of the results are replaced.
"""

from __future__ import annotations

from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import U64, map_texts, mix, other_columns, word_hash, word_spans, words_per_text

#: (UTF-8 bytes up to, least ratio, greatest ratio) of whole documents; the last band has no upper length.
BANDS = ((1 << 10, 1.10, 3.0), (4 << 10, 1.20, 4.0), (16 << 10, 1.30, 4.5), (128 << 10, 1.40, 5.0), (None, 1.40, 6.0))
CHUNK = 4096
MIN_CHUNK = 1024
CHUNK_BAND = (1.20, 4.0)
BAD_SHARE = 0.25
LEVEL = 3
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50

SYMBOL = np.zeros(256, dtype=bool)
SYMBOL[list(b"#*$%&|<>")] = True
RESULTS = [
    T.StructField(n, t())
    for n, t in (
        ("n_words", T.LongType), ("word_chars", T.LongType), ("n_symbols", T.LongType), ("n_dup_lines", T.LongType), ("n_repeat_words", T.LongType),
        ("n_bytes", T.LongType), ("ratio", T.DoubleType), ("bad_chunk_share", T.DoubleType),
    )
]


def repeated_words(words: np.ndarray, doc: np.ndarray, width: int = 3) -> np.ndarray:
    """Per word: whether it is in a window of ``width`` words that its text holds twice or more."""
    n = len(words) - width + 1
    covered = np.zeros(len(words), dtype=bool)
    if n <= 0:
        return covered
    key = mix(doc[:n].astype(U64) + U64(1))
    for k in range(width):
        key = mix(key * U64(0x9FB21C651E98DF25) + words[k : k + n])
    inside = np.flatnonzero(doc[:n] == doc[width - 1 :])
    _, which, count = np.unique(key[inside], return_inverse=True, return_counts=True)
    start = inside[count[which] > 1]
    for k in range(width):
        covered[start + k] = True
    return covered


def repeated_lines(buf: np.ndarray, bounds: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Per text: how many of its lines that hold a word equal an earlier line of it."""
    n_texts = len(bounds) - 1
    breaks = np.flatnonzero(buf == 0x0A)
    lo = np.unique(np.concatenate((bounds[:-1], breaks + 1)))
    lo = lo[lo < len(buf)]
    if not len(lo):
        return np.zeros(n_texts, np.int64)
    hi = np.append(lo[1:], len(buf))
    hi = hi - (buf[hi - 1] == 0x0A)  # without the line break; the last line of a text has none
    first = np.searchsorted(starts, lo)
    worded = (first < len(starts)) & (starts[np.minimum(first, len(starts) - 1)] < hi) if len(starts) else np.zeros(len(lo), bool)
    lo, hi = lo[worded], hi[worded]
    doc = np.searchsorted(bounds, lo, "right") - 1
    name = mix(word_hash(buf, lo, hi) + mix(doc.astype(U64) + U64(1)))
    _, at = np.unique(name, return_index=True)
    return np.bincount(doc, minlength=n_texts) - np.bincount(doc[at], minlength=n_texts)


def compression(data: memoryview, compressor, chunk: int, min_chunk: int, band: tuple[float, float]) -> tuple[float, float]:
    """(whole ratio, share of bytes in chunks outside ``band``) of one text; (1, 0) of an empty one."""
    size = len(data)
    if not size:
        return 1.0, 0.0
    ratio = size / len(compressor.compress(data))
    edges = list(range(0, size, chunk))
    if len(edges) > 1 and size - edges[-1] < min_chunk:
        edges.pop()
    bad = 0
    if len(edges) > 1:
        for lo, hi in zip(edges, [*edges[1:], size], strict=True):
            r = (hi - lo) / len(compressor.compress(data[lo:hi]))
            bad += (hi - lo) if not band[0] <= r <= band[1] else 0
    return ratio, bad / size


def _measure(i, j, buf, bounds, level: int, chunk: int, min_chunk: int, chunk_band: tuple[float, float]):
    import zstandard

    starts, ends = word_spans(buf, bounds)
    at = words_per_text(starts, bounds)
    n_words = np.diff(at)
    doc = np.repeat(np.arange(j - i), n_words)
    # code points are bytes that continue none
    head = np.concatenate(([0], np.cumsum((buf & 0xC0) != 0x80)))
    chars = np.bincount(doc, weights=head[ends] - head[starts], minlength=j - i).astype(np.int64)
    symbols = np.concatenate(([0], np.cumsum(SYMBOL[buf])))
    covered = repeated_words(word_hash(buf, starts, ends), doc)
    compressor = zstandard.ZstdCompressor(level=level)
    view = memoryview(np.ascontiguousarray(buf))
    found = [compression(view[a:b], compressor, chunk, min_chunk, chunk_band) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
    longs = (n_words, chars, np.diff(symbols[bounds]), repeated_lines(buf, bounds, starts), np.bincount(doc[covered], minlength=j - i), np.diff(bounds))
    return [*[pa.array(x.astype(np.int64)) for x in longs], *[pa.array([f[k] for f in found], pa.float64()) for k in range(2)]]


def apply_rules(
    df: DataFrame, text_col: str = "text", columns: list[str] | None = None, bands=BANDS, chunk: int = CHUNK, min_chunk: int = MIN_CHUNK,
    chunk_band: tuple[float, float] = CHUNK_BAND, bad_share: float = BAD_SHARE, level: int = LEVEL,
    min_words: int = MIN_WORDS, max_repeat_percent: int = MAX_REPEAT_PERCENT,
) -> DataFrame:
    """Columns ``columns`` of ``df`` (default: all) with the counts, ratios, ``base_failed``, ``reason`` and ``kept``.

    ``reason`` names the first rule that a document fails: words, repeated words, repetitive, incompressible, chunks;
    null where it is kept. One pass, no shuffle.
    """
    new = [f.name for f in RESULTS] + ["base_failed", "reason", "kept"]
    carry = other_columns(df.select(*[f"`{c}`" for c in columns]) if columns is not None else df, new)
    work = partial(_measure, level=level, chunk=chunk, min_chunk=min_chunk, chunk_band=chunk_band)
    out = map_texts(df, text_col, carry, work, RESULTS)
    low = high = F.lit(False)
    below = F.lit(-1)
    for top, least, most in bands:
        inside = F.col("n_bytes") > below
        if top is not None:
            inside = inside & (F.col("n_bytes") <= top)
            below = F.lit(top)
        low = low | (inside & (F.col("ratio") < least))
        high = high | (inside & (F.col("ratio") > most))
    few = F.col("n_words") < min_words
    repeats = 100 * F.col("n_repeat_words") > max_repeat_percent * F.col("n_words")
    reason = (
        F.when(few, "words").when(repeats, "repeated words").when(high, "repetitive").when(low, "incompressible")
        .when(F.col("bad_chunk_share") > bad_share, "chunks")
    )
    return out.withColumns({"base_failed": few | repeats, "reason": reason}).withColumn("kept", F.col("reason").isNull())
