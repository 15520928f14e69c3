"""Substring dedup by recompression: drop every word of a passage that occurs elsewhere.

Every text is parsed bottom-up in rounds: a run of one symbol gets one name,
then each pair of a "left" symbol and a "right" symbol gets one name. Names and
sides are hashes of the content, so they are the same in every document and
task. What a symbol depends on is its zone, a word range around it; equal word
sequences that contain a zone contain the same symbol. So a window's anchor,
chosen among the symbols of the highest round whose zones lie inside the window,
is a function of the window's words alone: equal windows share their anchor.

1. One pass over the texts writes a row per anchor: its name, where the windows
   that chose it start, and a hash of all the words they cover (the span).
2. Counting names leaves the anchors that occur twice or more. Among them, equal
   spans make all their windows repeated at once.
3. What is left are the ends of repeated passages: spans that differ, under one
   anchor. One representative of each is cut into its windows, whose hashes
   (with the anchor's, 128 bits) are counted.
4. The removed word ranges are joined to the texts.

Hot names cost little: counts combine before the shuffle, the joins back are
plain equi-joins that adaptive execution can split, and no group of occurrences
is ever collected. The only lists are those of one document's own ranges.

Null text counts as empty. Texts shorter than a window stay as they are, with
white space normalised. Repeated rows are documents like any other, so their
windows are repeated. Rows that share an id are told apart by their text.
"""

from __future__ import annotations

from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import (
    U64, chunks, id_key, materialize, mix, other_columns, span_hash, text_column, word_hash, word_spans, words_per_text,
)

ROUNDS = 4
RUN_ROUNDS = (0,)  # rounds that name runs before pairs; later runs stay as equal symbols
ZONE, ZONE_STEP = 18, 8  # preferred words in an anchor's zone, and how finely that is told


def _level(sym, s, zl, zr, doc):
    return {"sym": sym, "s": s, "zl": zl, "zr": zr, "doc": doc}


def _name_runs(x: dict, far: int) -> dict:
    """Name each run of one symbol; a run depends on the symbols on both its sides."""
    n = len(x["sym"])
    head = np.ones(n, dtype=bool)
    head[1:] = (x["sym"][1:] != x["sym"][:-1]) | (x["doc"][1:] != x["doc"][:-1])
    i = np.flatnonzero(head)
    j = np.append(i[1:], n) - 1
    count = (j - i + 1).astype(U64)
    sym = np.where(count > 1, mix(x["sym"][i] * U64(0xA24BAED4963EE407) + count), x["sym"][i])
    left_ok = (i > 0) & (x["doc"][np.maximum(i - 1, 0)] == x["doc"][i])
    right_ok = (j < n - 1) & (x["doc"][np.minimum(j + 1, n - 1)] == x["doc"][j])
    zl = np.where(left_ok, x["zl"][np.maximum(i - 1, 0)], x["zl"][i] - far)
    zr = np.where(right_ok, x["zr"][np.minimum(j + 1, n - 1)], x["zr"][j] + far)
    return _level(sym, x["s"][i], zl, zr, x["doc"][i])


def _name_pairs(x: dict, round_no: int, far: int) -> dict:
    """Name each left-right pair; a symbol left alone depends on the neighbour it could have joined."""
    n = len(x["sym"])
    left = (mix(x["sym"] + U64((round_no + 1) * 0x632BE59BD9B4E019 & (2**64 - 1))) & U64(1)).astype(bool)
    same = np.zeros(n, dtype=bool)  # followed by a symbol of its own text
    same[:-1] = x["doc"][1:] == x["doc"][:-1]
    first = np.zeros(n, dtype=bool)
    first[:-1] = left[:-1] & ~left[1:] & same[:-1]
    second = np.zeros(n, dtype=bool)
    second[1:] = first[:-1]
    zl, zr = x["zl"].copy(), x["zr"].copy()
    alone_left = np.flatnonzero(left & ~first)
    nxt = np.minimum(alone_left + 1, n - 1)
    zr[alone_left] = np.where(same[alone_left], x["zr"][nxt], x["zr"][alone_left] + far)
    alone_right = np.flatnonzero(~left & ~second)
    prv = np.maximum(alone_right - 1, 0)
    zl[alone_right] = np.where(same[prv] & (alone_right > 0), x["zl"][prv], x["zl"][alone_right] - far)
    k = np.flatnonzero(~second)
    joined = first[k]
    partner = np.minimum(k + 1, n - 1)
    sym = np.where(joined, mix(x["sym"][k] * U64(0x9FB21C651E98DF25) + mix(x["sym"][partner])), x["sym"][k])
    return _level(sym, x["s"][k], zl[k], np.where(joined, zr[partner], zr[k]), x["doc"][k])


def _first_least(values: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """Position of the least value in each range lo:hi, the leftmost of equal ones (sparse table)."""
    best = np.arange(len(values))
    out = np.zeros(len(lo), dtype=np.int64)
    size = hi - lo
    width = 1
    while True:
        now = (size >= width) & (size < 2 * width)
        a, b = best[lo[now]], best[hi[now] - width]
        out[now] = np.where(values[b] < values[a], b, a)
        if not (size >= 2 * width).any():
            return out
        a, b = best[:-width], best[width:]
        best = np.where(values[b] < values[a], b, a)
        width *= 2


def spans_of(buf: np.ndarray, bounds: np.ndarray, window: int, rounds: int) -> dict[str, np.ndarray]:
    """Runs of consecutive windows with one anchor, for the texts in ``buf``.

    Returns row (text index), start (first window's word), n (windows), sym
    (the anchor's name), sig (hash of all words the windows cover), and
    n_words per text.
    """
    starts, ends = word_spans(buf, bounds)
    at = words_per_text(starts, bounds)
    n_words = np.diff(at)
    words = word_hash(buf, starts, ends)
    n = len(words)
    empty = {k: np.zeros(0, np.int64) for k in ("row", "start", "n")} | {k: np.zeros(0, U64) for k in ("sym", "sig")}
    doc = np.repeat(np.arange(len(n_words)), n_words)
    begin = np.arange(n)
    begin = begin[begin + window <= at[1:][doc]] if n else begin
    if not len(begin):
        return empty | {"n_words": n_words}
    far = 4 * window + 4
    pos = np.arange(n)
    x = _level(words, pos, pos, pos + 1, doc)
    levels = [x]
    for r in range(rounds):
        if r in RUN_ROUNDS:
            x = _name_runs(x, far)
        x = _name_pairs(x, r, far)
        if not ((x["zr"] - x["zl"]) <= window).any():
            break
        levels.append(x)
    anchor = np.zeros(len(begin), dtype=np.int64)
    name = np.zeros(len(begin), dtype=U64)
    todo = np.arange(len(begin))
    for depth in range(len(levels) - 1, -1, -1):
        x = levels[depth]
        ok = np.flatnonzero(x["zr"] - x["zl"] <= window)
        lo = np.searchsorted(x["zl"][ok], begin[todo], "left")
        hi = np.searchsorted(x["zr"][ok], begin[todo] + window, "right")
        hit = lo < hi
        got = todo[hit]
        size = (x["zr"] - x["zl"])[ok]
        rank = ((np.abs(size - ZONE) // ZONE_STEP).astype(U64) << U64(56)) | (x["sym"][ok] >> U64(8))
        sym = ok[_first_least(rank, lo[hit], hi[hit])] if len(got) else got
        anchor[got] = x["s"][sym]
        name[got] = mix(span_hash(words, x["zl"][sym], x["zr"][sym]) + U64(depth + 1))
        todo = todo[~hit]
        if not len(todo):
            break
    head = np.ones(len(begin), dtype=bool)
    head[1:] = (name[1:] != name[:-1]) | (anchor[1:] != anchor[:-1]) | (begin[1:] != begin[:-1] + 1)
    h = np.flatnonzero(head)
    count = np.diff(np.append(h, len(begin)))
    first = begin[h]
    sig = span_hash(words, first, first + count - 1 + window)
    row = doc[first]
    return {"row": row, "start": first - at[row], "n": count, "sym": name[h], "sig": sig, "n_words": n_words}


# ------------------------------------------------------------------ task side
def _emit_spans(batches, window: int):
    for batch in batches:
        col = text_column(batch, "_text")
        for i, j, buf, bounds in chunks(col):
            r = spans_of(buf, bounds, window, ROUNDS)
            row = pa.array(r["row"] + i)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(row), batch.column(1).take(row),
                    pa.array(r["start"].astype(np.int32)), pa.array(r["n"].astype(np.int32)),
                    pa.array(r["sym"].view(np.int64)), pa.array(r["sig"].view(np.int64)),
                ],
                ["_id", "_th", "start", "n", "sym", "sig"],
            )


def _ranges(batch, name: str):
    """Flat starts and ends of a list<struct<start, end>> column, and the rows' offsets into them."""
    lists = batch.column(batch.schema.get_field_index(name))
    offsets = np.zeros(len(lists) + 1, dtype=np.int64)
    import pyarrow.compute as pc

    np.cumsum(pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False), out=offsets[1:])
    flat = lists.flatten()
    return offsets, [flat.field(k).to_numpy(zero_copy_only=False) for k in range(flat.type.num_fields)]


def _emit_windows(batches, window: int):
    """The windows of each listed span: anchor, window hash, document, start; only for spans that need the answer."""
    for batch in batches:
        col = text_column(batch, "_text")
        offsets, (start, count, sym, alone) = _ranges(batch, "spans")
        for i, j, buf, bounds in chunks(col):
            lo, hi = offsets[i], offsets[j]
            if lo == hi:
                continue
            ws, we = word_spans(buf, bounds)
            at = words_per_text(ws, bounds)
            words = word_hash(buf, ws, we)
            row = np.repeat(np.arange(i, j), np.diff(offsets[i : j + 1]))
            n = count[lo:hi].astype(np.int64)
            inner = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            local = np.repeat(start[lo:hi].astype(np.int64), n) + inner
            rows = np.repeat(row, n)
            first = local + at[rows - i]
            h = span_hash(words, first, first + window)
            pick = pa.array(rows)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pick), batch.column(1).take(pick), pa.array(local.astype(np.int32)),
                    pa.array(np.repeat(sym[lo:hi], n)), pa.array(h.view(np.int64)), pa.array(np.repeat(alone[lo:hi].astype(bool), n)),
                ],
                ["_id", "_th", "start", "sym", "wsig", "alone"],
            )


def _cut(batches, names: list[str]):
    """Drop the listed word ranges of each text."""
    for batch in batches:
        col = text_column(batch, "_text")
        offsets, (start, end) = _ranges(batch, "ranges")
        keep = [batch.column(batch.schema.get_field_index(n)) for n in names]
        texts, total, removed, spans = [], [], [], []
        for k in range(len(col)):
            words = col[k].as_buffer().to_pybytes().split()
            n, lo, hi = len(words), offsets[k], offsets[k + 1]
            gone = 0
            cut = []
            if hi > lo:
                edge = np.zeros(n + 1, dtype=np.int64)
                np.add.at(edge, start[lo:hi], 1)
                np.add.at(edge, end[lo:hi], -1)
                out = np.cumsum(edge[:n]) > 0
                gone = int(out.sum())
                turn = np.flatnonzero(np.diff(np.concatenate(([False], out, [False])).astype(np.int8)))
                cut = [{"start": int(a), "end": int(b)} for a, b in turn.reshape(-1, 2)]
                words = [words[i] for i in np.flatnonzero(~out)]
            texts.append(b" ".join(words))
            total.append(n)
            removed.append(gone)
            spans.append(cut)
        yield pa.RecordBatch.from_arrays(
            [
                *keep, pa.array(texts, pa.binary()).cast(pa.string()), pa.array(total, pa.int64()), pa.array(removed, pa.int64()),
                pa.array(spans, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))),
            ],
            [*names, "_kept", "_n", "_gone", "_cut"],
        )


# ---------------------------------------------------------------- driver side
def dedup_substrings(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 35) -> DataFrame:
    """Remove every word covered by a ``window``-word sequence that also starts anywhere else in ``df``.

    Returns the other columns of ``df``, the kept words as ``text_col``, and
    n_words, n_removed, removed_spans (word ranges); input columns with these
    names are replaced.
    """
    key = [id_key(df, id_col).alias("_id"), F.xxhash64(F.col(text_col)).alias("_th")]
    docs = df.select(*key, F.col(text_col).alias("_text"))
    kind = docs.schema["_id"].dataType.simpleString()
    spans = materialize(
        docs.mapInArrow(partial(_emit_spans, window=window), f"_id {kind}, _th long, start int, n int, sym long, sig long"), "spans"
    )
    twice = spans.groupBy("sym").agg(F.count("*").alias("c")).filter("c > 1").select("sym")
    shared = materialize(spans.join(twice, "sym", "left_semi"), "shared")

    equal = shared.groupBy("sym", "sig").agg(F.count("*").alias("c"), F.min(F.struct("_id", "_th", "start", "n")).alias("at"))
    full = shared.join(equal.filter("c > 1").select("sym", "sig"), ["sym", "sig"], "left_semi")
    full = full.select("_id", "_th", "start", (F.col("start") + F.col("n") + F.lit(window - 1)).alias("end"))

    mixed = equal.groupBy("sym").agg(F.count("*").alias("c")).filter("c > 1").select("sym")
    open_spans = equal.join(mixed, "sym", "left_semi").select("sym", "at.*", (F.col("c") == 1).alias("alone"))
    by_doc = open_spans.groupBy("_id", "_th").agg(F.collect_list(F.struct("start", "n", "sym", "alone")).alias("spans"))
    names = other_columns(df, [text_col, "n_words", "n_removed", "removed_spans"])
    base = df.select(*key, F.col(text_col).alias("_text"), F.struct(F.lit(0).alias("_"), *[F.col(f"`{c}`") for c in names]).alias("_row"))
    windows = base.join(by_doc, ["_id", "_th"], "left").filter("spans IS NOT NULL").dropDuplicates(["_id", "_th"])
    windows = windows.select("_id", "_th", "_text", "spans").mapInArrow(
        partial(_emit_windows, window=window), f"_id {kind}, _th long, start int, sym long, wsig long, alone boolean"
    )
    windows = materialize(windows, "windows")
    again = windows.groupBy("sym", "wsig").agg(F.count("*").alias("c")).filter("c > 1").select("sym", "wsig")
    edges = windows.filter("alone").join(again, ["sym", "wsig"], "left_semi")
    edges = edges.select("_id", "_th", "start", (F.col("start") + F.lit(window)).alias("end"))

    ranges = full.unionAll(edges).groupBy("_id", "_th").agg(F.collect_list(F.struct("start", "end")).alias("ranges"))
    cut = base.join(ranges, ["_id", "_th"], "left").select("_row", "_text", "ranges")
    row = base.schema["_row"].dataType.simpleString()
    cut = cut.mapInArrow(
        partial(_cut, names=["_row"]), f"_row {row}, _kept string, _n long, _gone long, _cut array<struct<start: int, end: int>>"
    )
    return cut.select(
        *[F.col("_row").getField(c).alias(c) for c in names],
        F.col("_kept").alias(text_col), F.col("_n").alias("n_words"), F.col("_gone").alias("n_removed"), F.col("_cut").alias("removed_spans"),
    )
