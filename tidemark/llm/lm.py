"""Language-model scoring with a weighted backoff automaton.

A state is a history of up to ``order`` - 1 tokens that the training texts hold;
its arcs are the tokens seen after it. With c the training counts and m the
``strength``, an arc of state h for token w weighs

    log10 p(w | h),  p(w | h) = (c(hw) + m p(w | h')) / (c(h) + m)

(Dirichlet smoothing; h' drops the oldest token), and the failure arc of h to h'
weighs log10 m / (c(h) + m): a token without an arc is reached by failing to
shorter histories, down to the root, where p(w) = (c + 0.5) / (N + 0.5 (V + 1)).
A text is traversed once, left to right: the state is carried from token to
token, and the weights of the arcs taken, failure arcs included, add up.

The automaton grows with the corpus, so no task ever holds it whole. Texts are
dealt to blocks of bounded size. A block sends each of its distinct n-grams
once, with its training count, packed into rows by hash bucket; a bucket sums
the counts of all blocks and answers each of them with the counts that the
others hold. From these the block builds the states, arcs and failure arcs that
its texts can walk through (``Automaton``). A hot word is one entry per block,
whatever its count; an empty pack is not sent, so there are at most as many
packs as entries.

All texts of a block walk in step, one token of each at a time. A long text
walks in pieces: the state depends on the last ``order`` - 1 tokens only, so a
piece that first reads those of the piece before, without adding their weights,
goes on in the state that one ends in.

N-grams are named by 64-bit hashes. Null text is empty (its end is its only
token). Repeated rows are trained on and scored like others. A null id counts as
the empty string.
"""

from __future__ import annotations

from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import LOWER, U64, chunks, mix, other_columns, text_bytes, text_column, word_hash, word_spans, words_per_text

END = U64(0x5851F42D4C957F2D)  # the name of the end token
START = U64(0x14057B7EF767814F)  # the name of the history before a text
STEP = U64(0x9FB21C651E98DF25)


def grams(buf: np.ndarray, bounds: np.ndarray, order: int) -> tuple[list[np.ndarray], np.ndarray]:
    """Names of the 1- to ``order``-grams that end at each token, and the index of each text's first token."""
    low = LOWER[buf]
    starts, ends = word_spans(low, bounds)
    at = words_per_text(starts, bounds)
    words = word_hash(low, starts, ends)
    n_texts = len(bounds) - 1
    tokens = np.empty(len(words) + n_texts, dtype=U64)
    doc = np.repeat(np.arange(n_texts), np.diff(at))
    tokens[np.arange(len(words)) + doc] = words
    tokens[at[1:] + np.arange(n_texts)] = END
    first = at[:-1] + np.arange(n_texts)
    out = [tokens]
    for k in range(2, order + 1):
        history = np.empty_like(tokens)
        history[1:] = out[-1][:-1]
        history[first] = mix(START + np.full(1, k, dtype=U64))[0]
        out.append(mix(history * STEP + tokens))
    return out, first


def _bucket_cuts(keys: np.ndarray, buckets: int) -> np.ndarray:
    """Where each bucket begins in sorted keys; buckets are ranges of the hash."""
    edges = np.array([(b << 64) // buckets for b in range(buckets)], dtype=U64)
    return np.append(np.searchsorted(keys, edges, "left"), len(keys))


def _narrow(values: np.ndarray) -> bytes:
    """Unsigned integers in as few bytes as the largest needs; the first byte tells the width."""
    top = int(values.max()) if len(values) else 0
    width = next(w for w in (1, 2, 4, 8) if top < 1 << (8 * w))
    return bytes([width]) + values.astype(f"<u{width}").tobytes()


def _wide(data: bytes) -> np.ndarray:
    return np.frombuffer(data, dtype=f"<u{data[0]}", offset=1).astype(np.int64)


def _block_texts(tbl: pa.Table):
    """Texts of a block in a canonical order: their bytes, bounds and other columns."""
    tbl = tbl.combine_chunks()
    batch = tbl.to_batches()[0]
    whole = list(chunks(text_column(batch, "_text"), 1 << 62))
    return batch, whole[0][2], whole[0][3]


# ------------------------------------------------------------------ task side
def _count(key, tbl, order: int, buckets: int):
    batch, buf, bounds = _block_texts(tbl)
    names, first = grams(buf, bounds, order)
    train = batch.column(batch.schema.get_field_index("_train")).to_numpy(zero_copy_only=False)
    weight = np.repeat(train, np.diff(np.append(first, len(names[0])))).astype(np.int64)
    rows = []
    for k, name in enumerate(names, 1):
        distinct, which = np.unique(name, return_inverse=True)
        counts = np.bincount(which, weights=weight, minlength=len(distinct)).astype(np.int64)
        cut = _bucket_cuts(distinct, buckets)
        for b in range(buckets):
            lo, hi = cut[b], cut[b + 1]
            if lo < hi:
                rows.append((k, b, key[0].as_py(), distinct[lo:hi].astype("<u8").tobytes(), _narrow(counts[lo:hi])))
    cols = list(zip(*rows, strict=True))
    kinds = [pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.binary()]
    return pa.table([pa.array(c, t) for c, t in zip(cols, kinds, strict=True)], names=["k", "bucket", "block", "names", "counts"])


def _sum(key, tbl):
    blocks = tbl.column("block").to_numpy()
    order = np.argsort(blocks)
    names = [np.frombuffer(tbl.column("names")[i].as_py(), dtype="<u8") for i in order]
    counts = [_wide(tbl.column("counts")[i].as_py()) for i in order]
    distinct, which = np.unique(np.concatenate(names), return_inverse=True)
    own = np.concatenate(counts)
    total = np.bincount(which, weights=own, minlength=len(distinct)).astype(np.int64)
    others = np.split(total[which] - own, np.cumsum([len(n) for n in names])[:-1])
    size = len(order)
    first = np.arange(size) == 0
    k = key[0].as_py()
    kinds = [(total > 0).sum() if k == 1 else 0, total.sum() if k == 1 else 0]
    return pa.table(
        [
            pa.array([k] * size, pa.int32()), pa.array([key[1].as_py()] * size, pa.int32()), pa.array(blocks[order], pa.int32()),
            pa.array([_narrow(o) for o in others], pa.binary()), *[pa.array(first * int(n), pa.int64()) for n in kinds],
        ],
        names=["k", "bucket", "block", "others", "types", "tokens"],
    )


class Automaton:
    """The part of the automaton that the texts of a block can walk through.

    ``which[k]`` numbers the distinct (k + 1)-grams that end at each token,
    ``counts[k]`` are their training counts. State 0 is the root; the states of
    histories of j tokens follow, then those before a text, one for each j.
    """

    def __init__(self, which: list[np.ndarray], counts: list[np.ndarray], first: np.ndarray, texts: int, tokens: int, types: int, strength: float):
        order = len(which)
        self.order, self.width = order, max(1, len(counts[0]))  # an arc's key is state * width + token
        base = [0, *np.cumsum([1, *[len(c) for c in counts[: order - 1]]]).tolist()]  # base[j]: first state of j tokens
        n_states = base[order] + order - 1
        self.fail = np.zeros(n_states, np.int64)
        self.fail_weight = np.zeros(n_states)
        begins = np.zeros(len(which[0]), bool)
        begins[first] = True
        state = [np.zeros(len(which[0]), np.int64)]  # of the history of j tokens that ends at each token
        for j in range(1, order):
            state.append(base[j] + which[j - 1])
            seen = np.append(counts[j - 1], texts)
            weight = np.log10(strength / (seen + strength))
            self.fail_weight[base[j] : base[j] + len(counts[j - 1])] = weight[:-1]
            self.fail[state[j]] = state[j - 1]  # the same end, the oldest token dropped
            self.fail_weight[base[order] + j - 1] = weight[-1]
            self.fail[base[order] + j - 1] = base[order] + j - 2 if j > 1 else 0
        self.start = base[order] + order - 2 if order > 1 else 0
        if not texts and order > 1:
            self.start = 0  # no text was trained on
        keys, to, weights = [], [], []
        p = (counts[0] + 0.5) / (tokens + 0.5 * (types + 1))
        for k in range(order):  # arcs of histories of k tokens
            distinct, at = np.unique(which[k], return_index=True)  # one place of each
            if k:
                before = np.where(begins[at], base[order] + k - 1, state[k][np.maximum(at - 1, 0)])
                held = np.where(begins[at], texts, counts[k - 1][which[k - 1][np.maximum(at - 1, 0)]])
                p = (counts[k] + strength * p[which[k - 1][at]]) / (held + strength)
            else:
                before = np.zeros(len(at), np.int64)
            arc = np.flatnonzero(counts[k] > 0) if k else np.arange(len(at))  # the root has one for every token
            end = min(k + 1, order - 1)
            reached = state[end][at[arc]]
            if not k and order > 1:
                reached = np.where(counts[0][arc] > 0, reached, 0)
            keys.append(before[arc] * self.width + which[0][at[arc]])
            to.append(reached)
            weights.append(np.log10(p[arc]))
        self.keys = np.concatenate(keys)
        by = np.argsort(self.keys)
        self.keys, self.to, self.weight = self.keys[by], np.concatenate(to)[by], np.concatenate(weights)[by]

    def step(self, state: np.ndarray, token: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(next states, weights) of reading one token in each state, through as many failure arcs as it takes."""
        state, total = state.copy(), np.zeros(len(state))
        left = np.arange(len(state))
        while len(left):
            key = state[left] * self.width + token[left]
            at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            hit = self.keys[at] == key
            done = left[hit]
            total[done] += self.weight[at[hit]]
            state[done] = self.to[at[hit]]
            left = left[~hit]
            total[left] += self.fail_weight[state[left]]
            state[left] = self.fail[state[left]]
        return state, total

    def score(self, token: np.ndarray, first: np.ndarray, sizes: np.ndarray, piece: int = 2048) -> np.ndarray:
        """Log probability of each text: tokens first to first + size."""
        warm = self.order - 1
        n = -(-sizes // piece)
        text = np.repeat(np.arange(len(sizes)), n)
        k = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        begin = first[text] + k * piece
        end = np.minimum(begin + piece, (first + sizes)[text])
        lead = np.minimum(begin - first[text], warm)  # tokens of the piece before
        by = np.argsort(begin - lead - end, kind="stable")  # long ones first
        text, begin, end, lead = text[by], begin[by], end[by], lead[by]
        state = np.where(begin - lead == first[text], self.start, 0)
        total = np.zeros(len(text))
        length = end - begin + lead
        for i in range(int(length.max(initial=0))):
            active = int(np.searchsorted(-length, -i, "left"))  # pieces longer than i
            state[:active], weight = self.step(state[:active], token[begin[:active] - lead[:active] + i])
            total[:active] += np.where(i >= lead[:active], weight, 0.0)
        return np.bincount(text, weights=total, minlength=len(sizes))


def _score(key, texts, answers, order: int, strength: float):
    batch, buf, bounds = _block_texts(texts)
    names, first = grams(buf, bounds, order)
    sizes = np.diff(np.append(first, len(names[0])))
    train = batch.column(batch.schema.get_field_index("_train")).to_numpy(zero_copy_only=False)
    weight = np.repeat(train, sizes).astype(np.int64)
    answers = answers.combine_chunks()
    by = np.lexsort((answers.column("bucket").to_numpy(), answers.column("k").to_numpy()))
    ks = answers.column("k").to_numpy()[by]
    n_types, n_tokens = answers.column("V")[0].as_py(), answers.column("N")[0].as_py()
    which, counts = [], []
    for k, name in enumerate(names, 1):
        distinct, at = np.unique(name, return_inverse=True)
        own = np.bincount(at, weights=weight, minlength=len(distinct)).astype(np.int64)
        which.append(at)
        counts.append(own + np.concatenate([_wide(answers.column("others")[int(i)].as_py()) for i in by[ks == k]]))
        if k == 1:
            n_train_texts = int(counts[0][np.searchsorted(distinct, END)])
    c = counts[0][which[0]]
    base = np.log10((c + 0.5) / (n_tokens + 0.5 * (n_types + 1)))
    automaton = Automaton(which, counts, first, n_train_texts, n_tokens, n_types, strength)
    score = automaton.score(which[0], first, sizes)
    n = len(first)
    docs = np.repeat(np.arange(n), sizes)
    columns = [
        batch.column(batch.schema.get_field_index("_row")), pa.array(sizes.astype(np.int64)),
        pa.array(np.bincount(docs, weights=c > 0, minlength=n).astype(np.int64)), pa.array(np.full(n, n_tokens, dtype=np.int64)),
        pa.array(np.bincount(docs, weights=base, minlength=n)), pa.array(score),
    ]
    return pa.table(columns, names=["_row", "_n", "_known", "_train_n", "_base", "_score"])


def _with(fn, **fixed):
    """A plain function for the grouped calls, which look at its signature."""
    if fn is _score:
        return lambda key, left, right: fn(key, left, right, **fixed)
    return lambda key, tbl: fn(key, tbl, **fixed)


# ---------------------------------------------------------------- driver side
def score_texts(
    df: DataFrame, train: str = "true", text_col: str = "text", order: int = 2, strength: float = 50.0, block_bytes: int = 12 << 20
) -> DataFrame:
    """Score all texts of ``df`` with a model of those for which the SQL condition ``train`` holds.

    Returns the other columns of ``df`` with n_tokens, n_known, train_tokens,
    base_score (root only) and score, both log10; input columns with these names
    are replaced.
    """
    names = other_columns(df, [text_col, "n_tokens", "n_known", "train_tokens", "base_score", "score"])
    blocks = max(1, -(-text_bytes(df, text_col) // block_bytes))
    docs = df.select(
        F.struct(F.lit(0).alias("_"), *[F.col(f"`{c}`") for c in names]).alias("_row"),
        F.coalesce(F.expr(train), F.lit(False)).alias("_train"),
        F.col(text_col).alias("_text"),
        F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in names if df.schema[c].dataType.simpleString()[:3] not in ("map", "var")], F.col(text_col)), F.lit(blocks)).cast("int").alias("block"),
    )
    packs = docs.groupBy("block").applyInArrow(_with(_count, order=order, buckets=blocks), "k int, bucket int, block int, names binary, counts binary")
    answers = packs.groupBy("k", "bucket").applyInArrow(_with(_sum), "k int, bucket int, block int, others binary, types long, tokens long")
    totals = answers.agg(F.sum("types").alias("V"), F.sum("tokens").alias("N"))  # one row
    answers = answers.select("k", "bucket", "block", "others").crossJoin(F.broadcast(totals))
    numbers = [T.StructField(n, T.LongType()) for n in ("_n", "_known", "_train_n")] + [T.StructField(n, T.DoubleType()) for n in ("_base", "_score")]
    schema = T.StructType([docs.schema["_row"], *numbers])
    out = docs.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(_with(_score, order=order, strength=strength), schema)
    return out.select(
        *[F.col("_row").getField(c).alias(c) for c in names],
        F.col("_n").alias("n_tokens"), F.col("_known").alias("n_known"), F.col("_train_n").alias("train_tokens"),
        F.col("_base").alias("base_score"), F.col("_score").alias("score"),
    )
