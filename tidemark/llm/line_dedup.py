"""Line dedup with a log-template tree.

Lines are parsed by a tree of fixed depth: the number of tokens, then the
leading tokens, where a token with a digit is a variable. In a leaf, a token
that fewer than ``min_docs`` lines, or lines of one document only, have at its
position is a variable too; a line's template is its constant tokens. A template that is constant enough and occurs in ``min_docs``
documents is boilerplate, and its lines are dropped.

1. Leaves are counted by documents; leaves below ``min_docs`` cannot recur.
2. Lines of the other leaves (token hashes only) are grouped by (leaf, line).
   The tokens of each different line, weighed by how many lines it stands for,
   give counts per (leaf, position, token), which fix the variables; documents
   are counted per template.
3. With ``exact``, every non-blank line enters the tree, and a line that
   ``min_docs`` documents have word for word is dropped as well, however short
   it is and whatever its share of variables.
4. The dropped (leaf, line) are joined to the lines, their numbers to the texts.

All counts combine before the shuffle, so a line that a third of the documents
share costs a row per task; no leaf is ever collected.

Null text is empty. Blank lines stay and are not counted as lines. Lines of
fewer than ``min_tokens`` tokens have no template: they stay, unless ``exact``
drops them. Repeated rows (same id and text) are one document. Ties do not arise: the result depends on counts only.
"""

from __future__ import annotations

from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import U64, chunks, id_key, materialize, mix, other_columns, span_hash, text_column, word_hash, word_spans, words_per_text

VARIABLE = U64(0x2545F4914F6CDD1D)
DIGIT = np.zeros(256, dtype=np.int64)
DIGIT[48:58] = 1


def parse_lines(buf: np.ndarray, bounds: np.ndarray, depth: int, min_tokens: int) -> dict[str, np.ndarray]:
    """Of each line with enough tokens: row (text), line number, leaf, hash of the whole line, and its tokens' hashes as a flat array with offsets."""
    starts, ends = word_spans(buf, bounds)
    at = words_per_text(starts, bounds)
    doc = np.repeat(np.arange(len(bounds) - 1), np.diff(at))
    breaks = np.concatenate(([0], np.cumsum(buf == 10)))
    line = breaks[starts] - breaks[bounds[doc]] if len(starts) else np.zeros(0, np.int64)
    head = np.ones(len(starts), dtype=bool)
    head[1:] = (line[1:] != line[:-1]) | (doc[1:] != doc[:-1])
    first = np.flatnonzero(head)
    count = np.diff(np.append(first, len(starts)))
    digits = np.concatenate(([0], np.cumsum(DIGIT[buf])))
    names = word_hash(buf, starts, ends)
    spelt = names.copy()
    names[digits[ends] > digits[starts]] = VARIABLE
    ok = count >= min_tokens
    first, count = first[ok], count[ok]
    leaf = mix(count.astype(U64))
    for k in range(depth):
        leaf = np.where(count > k, mix(leaf * U64(0x9FB21C651E98DF25) + names[np.minimum(first + k, max(len(names) - 1, 0))]), leaf) if len(first) else leaf
    offsets = np.concatenate(([0], np.cumsum(count)))
    flat = np.arange(offsets[-1]) - np.repeat(offsets[:-1] - first, count)
    return {"row": doc[first], "line": line[first], "leaf": leaf, "same": span_hash(spelt, first, first + count), "offsets": offsets, "tokens": (names[flat] >> U64(32)).astype(np.uint32).view(np.int32)}


# ------------------------------------------------------------------ task side
def _emit(batches, depth: int, min_tokens: int, tokens: bool):
    for batch in batches:
        for i, _, buf, bounds in chunks(text_column(batch, "_text")):
            r = parse_lines(buf, bounds, depth, min_tokens)
            pick = pa.array(r["row"] + i)
            cols = [batch.column(0).take(pick), batch.column(1).take(pick), pa.array(r["leaf"].view(np.int64))]
            names = ["_id", "_th", "leaf"]
            if tokens:
                cols += [pa.array(r["same"].view(np.int64)), pa.array(r["line"].astype(np.int32)), pa.ListArray.from_arrays(pa.array(r["offsets"].astype(np.int32)), pa.array(r["tokens"]))]
                names += ["same", "line", "tokens"]
            yield pa.RecordBatch.from_arrays(cols, names)


def _drop(batches):
    for batch in batches:
        col, drop = text_column(batch, "_text"), batch.column(batch.schema.get_field_index("drop"))
        texts, total, gone = [], [], []
        for k in range(len(col)):
            lines = col[k].as_py().split("\n")
            out = set(drop[k].as_py() or ())
            total.append(sum(bool(x.strip(" \t\r\x0b\x0c")) for x in lines))
            gone.append(len(out))
            texts.append("\n".join(x for n, x in enumerate(lines) if n not in out) if out else col[k].as_py())
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(texts, pa.string()), pa.array(total, pa.int64()), pa.array(gone, pa.int64())], ["_row", "_kept", "_n", "_gone"]
        )


# ---------------------------------------------------------------- driver side
def _in_documents(lines: DataFrame, by: list[str], min_docs: int) -> DataFrame:
    """The values of ``by`` that lines of at least ``min_docs`` documents have."""
    return lines.select(*by, "_id", "_th").distinct().groupBy(*by).agg(F.count("*").alias("c")).filter(F.col("c") >= min_docs).select(*by)


def dedup_lines(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", depth: int = 2, min_docs: int = 5, min_constant: float = 0.6, min_tokens: int = 3,
    exact: bool = True,
) -> DataFrame:
    """The other columns of ``df``, the kept lines as ``text_col``, and n_lines and n_dropped (replaced if there)."""
    key = [id_key(df, id_col).alias("_id"), F.xxhash64(F.col(text_col)).alias("_th")]
    docs = df.select(*key, F.col(text_col).alias("_text"))
    kind = docs.schema["_id"].dataType.simpleString()
    emit = partial(_emit, depth=depth, min_tokens=1 if exact else min_tokens)
    leaves = docs.mapInArrow(partial(emit, tokens=False), f"_id {kind}, _th long, leaf long")
    leaves = materialize(_in_documents(leaves, ["leaf"], min_docs), "leaves")
    lines = docs.mapInArrow(partial(emit, tokens=True), f"_id {kind}, _th long, leaf long, same long, line int, tokens array<int>")
    lines = materialize(lines.join(leaves, "leaf", "left_semi"), "lines")

    # Equal lines have equal templates: from here on each different line counts once, with how many lines it stands for.
    doc = F.struct("_id", "_th")
    kinds = lines.groupBy("leaf", "same").agg(F.count("*").alias("c"), F.min(doc).alias("a"), F.max(doc).alias("b"), F.any_value("tokens").alias("tokens"))
    kinds = materialize(kinds, "kinds")
    variable = int((np.array([VARIABLE]) >> U64(32)).astype(np.uint32).view(np.int32)[0])
    long = kinds.filter(F.size("tokens") >= min_tokens)
    each = long.select("leaf", "same", "c", "a", "b", F.size("tokens").alias("size"), F.posexplode("tokens").alias("pos", "token")).filter(F.col("token") != variable)
    votes = each.groupBy("leaf", "pos", "token").agg(F.sum("c").alias("n"), F.min("a").alias("lo"), F.max("b").alias("hi"))
    votes = votes.filter((F.col("n") >= min_docs) & (F.col("lo") != F.col("hi"))).select("leaf", "pos", "token")
    fixed = each.select("leaf", "same", "c", "a", "b", "size", "pos", "token").join(votes, ["leaf", "pos", "token"])
    fixed = fixed.groupBy("leaf", "same", "size").agg(
        F.count("*").alias("n"), F.any_value("c").alias("c"), F.any_value("a").alias("a"), F.any_value("b").alias("b"),
        F.bit_xor(F.xxhash64("pos", "token")).alias("t1"), F.bit_xor(F.xxhash64("token", "pos", F.lit(1))).alias("t2"),
    )
    template = ["leaf", "t1", "t2"]
    told = materialize(fixed.filter(F.col("n") >= F.col("size") * min_constant).select(*template, "same", "c", "a", "b"), "templates")
    # A template of too few lines, or of one document, cannot be common; documents are counted for the others only.
    often = told.groupBy(*template).agg(F.sum("c").alias("n"), F.min("a").alias("lo"), F.max("b").alias("hi"))
    often = often.filter((F.col("n") >= min_docs) & (F.col("lo") != F.col("hi"))).select(*template)
    spelt = told.join(often, template, "left_semi").select(*template, "same")
    common = _in_documents(lines.select("leaf", "same", "_id", "_th").join(spelt, ["leaf", "same"]), template, min_docs)
    gone = told.select(*template, "same").join(common, template, "left_semi").select("leaf", "same")
    if exact:
        again = kinds.filter((F.col("c") >= min_docs) & (F.col("a") != F.col("b"))).select("leaf", "same")
        copies = lines.select("leaf", "same", "_id", "_th").join(again, ["leaf", "same"], "left_semi")
        gone = gone.union(_in_documents(copies, ["leaf", "same"], min_docs))
    gone = materialize(gone.distinct(), "gone")
    drop = lines.select("leaf", "same", "_id", "_th", "line").join(gone, ["leaf", "same"], "left_semi")
    drop = drop.groupBy("_id", "_th").agg(F.collect_set("line").alias("drop"))
    names = other_columns(df, [text_col, "n_lines", "n_dropped"])
    base = df.select(*key, F.struct(F.lit(0).alias("_"), *[F.col(f"`{c}`") for c in names]).alias("_row"), F.col(text_col).alias("_text"))
    row = base.schema["_row"].dataType.simpleString()
    out = base.join(drop, ["_id", "_th"], "left").select("_row", "_text", "drop").mapInArrow(_drop, f"_row {row}, _kept string, _n long, _gone long")
    return out.select(
        *[F.col("_row").getField(c).alias(c) for c in names], F.col("_kept").alias(text_col), F.col("_n").alias("n_lines"), F.col("_gone").alias("n_dropped")
    )
