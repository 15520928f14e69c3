"""Cross-tokenizer alignment: which tokens of a byte-level BPE (A) meet which of a sentencepiece BPE (B).

Both cut the same bytes, a space and the text. A token pair is linked where the
byte ranges of its tokens overlap; offsets where a token of A and one of B end
together close a group. An id pair counts the documents that hold it linked.

Work is done on Arrow arrays, block by block (about ``block_bytes`` of text):

* Texts are cut into pieces before a space that follows a visible character. No
  token of A spans that (its pattern splits there) nor one of B (checked: no
  piece of its vocabulary has a space after another character; else, or if its
  normalizer changes texts, texts stay whole). Each distinct piece that a task
  meets is encoded once; taking lists by dictionary index, flattening them and following
  parent indices gives the tokens of all texts.
* Cumulative sums of token lengths, which start anew with each text, are the
  tokens' ends. An Acero full outer join of the two sides on the end (text
  offset plus end in the text, the document-end key), sorted by it, has one row
  per link: the pieces of the common refinement. Empty sides are filled from
  the next row, rows with both sides close groups.
* ``Table.group_by`` gives each document's distinct pairs and the block's counts
  of them; Spark sums the partial counts over blocks, marks the pairs whose
  count is the highest of their A id, and sends each block the counts of the
  pairs it holds (its numbered dictionary), so no task needs the whole table.

A text longer than a block is worked on in runs of whole pieces, whose results
add up, so memory is bounded by the block and not by the text (but for a single
piece without a space).

A text has no tokens (all counts 0, an empty ``groups_sha256``) if it is null or
empty or if the joined token bytes of A or B are not a space and the text, as
for texts with U+2581, which B reads as a space. Strings of special tokens are
plain text. Rows are aligned one by one: repeated rows and ids each count as a
document. Empty tables give empty results. Input columns with the names of the
results are replaced.
"""

from __future__ import annotations

import hashlib
from functools import partial
from itertools import chain
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import SPACES, chunks, materialize, other_columns, text_column
from tidemark.llm.token_records import _wide_space

BLOCK_BYTES = 2 << 20
KNOWN_PIECES = 1 << 20  # pieces a task remembers; then it starts anew
JOINED_BYTES = 16 << 10  # pieces that the byte-level tokenizer gets as one text
SPACE = "▁"  # how sentencepiece writes a space
COUNTS = ["n_a", "n_b", "n_groups", "n_links"]
BLOCK_COLUMNS = ["_block", "_row", *[f"_{c}" for c in COUNTS], "_sha", "_held", "_times", "_pairs", "_docs"]
NO_GLUE = pa.scalar("", pa.large_string())
MORE, TURN, NEXT, LAST = range(4)  # what follows a token id in the digest: "," "|" ";" or nothing


# ----------------------------------------------------------------- tokenizers
def _byte_letters() -> dict[str, int]:
    """The letters by which a byte-level vocabulary spells bytes: printable ones by themselves, the others from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(0x100 + k): b for k, b in enumerate(others)}


class Pair:
    """Both tokenizers: ids of pieces, and the bytes of every token."""

    def __init__(self, path_a: str, path_b: str):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        letters = _byte_letters()
        added = {t.content for t in self.a.get_added_tokens_decoder().values()}
        names = {i: n for n, i in self.a.get_vocab(with_added_tokens=True).items()}
        spelt = lambda n: n.encode() if n in added else bytes(letters[c] for c in n)
        self.bytes_a = pa.array([spelt(names.get(i, "")) for i in range(max(names) + 1)], pa.binary())
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.bytes_b = pa.array([bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace(SPACE, " ").encode() for i, p in enumerate(pieces)], pa.binary())
        self.space_b = self.b.piece_to_id(SPACE)
        model = sentencepiece_model_pb2.ModelProto()
        model.ParseFromString(self.b.serialized_model_proto())
        if not model.normalizer_spec.add_dummy_prefix:
            raise ValueError("the sentencepiece model must put a space before a text")
        changes = model.normalizer_spec.name != "identity" or model.normalizer_spec.remove_extra_whitespaces
        self.cuts = not changes and not any(SPACE in p.lstrip(SPACE) for p in pieces)
        digits = pc.cast(pa.array(np.arange(max(len(self.bytes_a), len(self.bytes_b)))), pa.large_string())
        spelt_ids = [pc.binary_join_element_wise(digits, pa.scalar(s, pa.large_string()), NO_GLUE) for s in (",", "|", ";", "")]
        self.digits = pa.concat_arrays(spelt_ids)  # by suffix, then id

        self.forget()

    def forget(self) -> None:
        """No pieces are known: names, ids of both sides, and whether the ids spell the piece."""
        self.known = pa.array([], pa.large_string())
        self.lists = [_lists([]), _lists([])]
        self.faithful = np.zeros(0, bool)

    def encode_a(self, pieces: pa.Array) -> pa.Array:
        """Ids of each piece. Pieces that end in a visible character are encoded as one text, which cuts between them."""
        (_, _, buf, bounds), = chunks(pieces, 1 << 62)
        size = np.diff(bounds)
        last = bounds[1:]
        joinable = ~SPACES[buf[last - 1]] & ~_wide_space(buf, last)
        alone = pieces.filter(pa.array(~joinable)).to_pylist()
        some = np.flatnonzero(joinable)
        total = np.cumsum(size[some])
        ends = np.unique(np.append(np.searchsorted(total, np.arange(JOINED_BYTES, total[-1] if len(some) else 0, JOINED_BYTES), "right"), len(some)))
        spelt = pieces.take(pa.array(some))
        (_, _, data, at), = chunks(spelt, 1 << 62) if len(some) else ((0, 0, b"", np.zeros(1, np.int64)),)
        texts = [bytes(data[at[i] : at[j]]).decode() for i, j in zip([0, *ends[:-1]], ends, strict=True) if j > i]
        ids = [e.ids for e in self.a.encode_batch_fast([*texts, *alone], add_special_tokens=False)]
        flat = np.fromiter(chain.from_iterable(ids), np.int32)
        length = pc.binary_length(self.bytes_a).to_numpy()[flat]
        # pieces in the order they were encoded, each with the tokens that end in it
        order = np.concatenate((some, np.flatnonzero(~joinable)))
        edge = np.searchsorted(np.cumsum(length), np.cumsum(size[order]), "right")
        lists = pa.LargeListArray.from_arrays(pa.array(np.concatenate(([0], edge))), pa.array(flat))
        back = np.empty(len(order), np.int64)
        back[order] = np.arange(len(order))
        return lists.take(pa.array(back))

    def encode_b(self, pieces: pa.Array) -> pa.Array:
        """Ids of each piece; the model puts a space before a text by itself, the first one of the piece."""
        pieces = pieces.to_pylist()
        ids = self.b.encode([p[1:] for p in pieces], num_threads=1)
        return _lists([x if len(p) > 1 else [self.space_b] for p, x in zip(pieces, ids, strict=True)])

    def learn(self, pieces: pa.Array) -> np.ndarray:
        """The number of each of the distinct ``pieces`` among the known ones; new ones are encoded."""
        if len(self.known) + len(pieces) > KNOWN_PIECES:
            self.forget()
        at = pc.index_in(pieces, value_set=self.known)
        new = pieces.filter(pc.is_null(at))
        if len(new):
            sides = [self.encode_a(new), self.encode_b(new)]
            spelt = [_faithful(x, b, new) for x, b in zip(sides, (self.bytes_a, self.bytes_b), strict=True)]
            self.faithful = np.append(self.faithful, spelt[0] & spelt[1])
            self.lists = [pa.concat_arrays([old, x]) for old, x in zip(self.lists, sides, strict=True)]
            fresh = np.asarray(at.is_null())
            at = pc.fill_null(at, 0).to_numpy().astype(np.int64)
            at[fresh] = len(self.known) + np.arange(len(new))
            self.known = pa.concat_arrays([self.known, new])
            return at
        return at.to_numpy().astype(np.int64)


def _lists(ids: list[list[int]]) -> pa.Array:
    offsets = np.concatenate(([0], np.cumsum([len(x) for x in ids]))).astype(np.int64)
    values = np.fromiter(chain.from_iterable(ids), np.int32, offsets[-1])
    return pa.LargeListArray.from_arrays(pa.array(offsets), pa.array(values))


def _faithful(lists: pa.Array, token_bytes: pa.Array, pieces: pa.Array) -> np.ndarray:
    """Whether the token bytes of each list, joined, are the bytes of its piece."""
    spelt = pc.binary_join(pa.LargeListArray.from_arrays(lists.offsets, token_bytes.take(lists.values)), b"")
    return pc.equal(spelt.cast(pa.large_binary()), pieces.cast(pa.large_binary())).to_numpy(zero_copy_only=False)


# ------------------------------------------------------------------ one block
class Aligned(NamedTuple):
    """Results of some texts: their counts, the bytes of their digests, and their distinct pairs (a << 32 | b)."""

    counts: dict[str, np.ndarray]
    digest: np.ndarray
    digest_bounds: np.ndarray
    doc: np.ndarray
    pair: np.ndarray
    times: np.ndarray


def piece_edges(buf: np.ndarray, bounds: np.ndarray, cuts: bool = True) -> np.ndarray:
    """Byte offsets where pieces begin, and the end: text bounds and spaces that follow a visible character."""
    if not cuts:
        return bounds
    at = np.flatnonzero(buf == 0x20)
    at = at[at > 0]
    at = at[~SPACES[buf[at - 1]] & ~_wide_space(buf, at)]
    both = np.sort(np.concatenate((bounds, at)), kind="stable")
    return both[np.append(True, both[1:] != both[:-1])]


def _tokens(lists: pa.Array, which: pa.Array, token_length: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids of the pieces ``which`` one after another, the piece of each, and their ends over all of them."""
    taken = lists.take(which)
    ids = taken.flatten().to_numpy()
    piece = pc.list_parent_indices(taken).to_numpy()
    return ids, piece, np.cumsum(token_length[ids])


def align(pair: Pair, buf: np.ndarray, edges: np.ndarray, bounds: np.ndarray) -> Aligned:
    """Align the texts ``buf[bounds]``, each a space and a text, cut into pieces at ``edges``."""
    n_texts = len(bounds) - 1
    pieces = pa.Array.from_buffers(pa.large_string(), len(edges) - 1, [None, pa.py_buffer(edges.astype(np.int64)), pa.py_buffer(buf)])
    named = pieces.dictionary_encode()
    which = pair.learn(named.dictionary)[named.indices.to_numpy()]
    right, sides = pair.faithful, zip(pair.lists, (pair.bytes_a, pair.bytes_b), strict=True)
    of = np.searchsorted(bounds, edges[:-1], "right") - 1  # text of each piece
    bad = np.bincount(of, weights=~right[which], minlength=n_texts) > 0
    kept = np.flatnonzero(~bad[of])
    of, which = of[kept], pa.array(which[kept])

    ids, ends, texts = [], [], []
    for lists, spelt in sides:
        i, piece, end = _tokens(lists, which, pc.binary_length(spelt).to_numpy())
        ids.append(i)
        ends.append(end)
        texts.append(of[piece])
    a, b = (pa.table({"end": e, name: i}) for name, i, e in zip("ab", ids, ends, strict=True))
    links = a.join(b, keys="end", join_type="full outer", use_threads=False)
    links = links.take(pc.sort_indices(links["end"])).combine_chunks()
    has_a, has_b = (np.asarray(links[c].is_valid()) for c in "ab")
    la, lb = (pc.fill_null_backward(links[c].combine_chunks()).to_numpy() for c in "ab")
    closes = has_a & has_b
    size = np.where(bad, 0, np.diff(bounds))
    last = np.cumsum(size)
    link_end = links["end"].to_numpy()
    doc = np.searchsorted(last, link_end, "left")
    group = np.cumsum(closes) - closes
    counts = {
        "n_a": np.bincount(texts[0], minlength=n_texts), "n_b": np.bincount(texts[1], minlength=n_texts),
        "n_groups": np.bincount(doc[closes], minlength=n_texts), "n_links": np.bincount(doc, minlength=n_texts),
    }
    digest, digest_bounds = _digest(pair, ids, [group[has_a], group[has_b]], [closes[has_a], closes[has_b]], np.isin(ends[1], last), counts)

    held = pa.table({"doc": doc, "pair": (la.astype(np.int64) << 32) | lb})
    held = held.group_by(["doc", "pair"], use_threads=False).aggregate([([], "count_all")])
    held = [held[c].to_numpy() for c in ("doc", "pair", "count_all")]
    order = np.lexsort((held[1], held[0]))
    return Aligned(counts, digest, digest_bounds, *[x[order] for x in held])


def _digest(pair: Pair, ids, groups, closes, ends_text, counts) -> tuple[np.ndarray, np.ndarray]:
    """``a1,a2|b1;a3|b2`` of all texts one after another, and where each begins: ids in the order of groups, A before B."""
    n_groups = int(counts["n_groups"].sum())
    a, b = (np.bincount(g, minlength=n_groups) for g in groups)
    to_a = np.arange(len(ids[0])) + (np.cumsum(b) - b)[groups[0]]
    to_b = np.arange(len(ids[1])) + np.cumsum(a)[groups[1]]
    width = len(pair.digits) // 4
    names = np.empty(len(ids[0]) + len(ids[1]), np.int64)
    names[to_a] = ids[0] + width * np.where(closes[0], TURN, MORE)
    names[to_b] = ids[1] + width * np.where(closes[1], np.where(ends_text, LAST, NEXT), MORE)
    spelt = pair.digits.take(pa.array(names))
    offsets = np.frombuffer(spelt.buffers()[1], np.int64)[: len(spelt) + 1]
    data = np.frombuffer(spelt.buffers()[2] or b"", np.uint8)
    return data, offsets[np.concatenate(([0], np.cumsum(counts["n_a"] + counts["n_b"])))]


def align_texts(pair: Pair, texts: pa.Array, block_bytes: int) -> tuple[dict[str, np.ndarray], list[str], np.ndarray, np.ndarray, np.ndarray]:
    """Counts and digests of non-null ``texts``, and their distinct pairs: text, pair, times. A long text goes run by run."""
    joined = pc.binary_join_element_wise(pa.scalar(" ", pa.large_string()), texts, NO_GLUE)
    filled = np.flatnonzero(pc.binary_length(texts).to_numpy() > 0)
    counts = {c: np.zeros(len(texts), np.int64) for c in COUNTS}
    digests = [""] * len(texts)
    nothing = {c: n.copy() for c, n in counts.items()}, digests, *[np.zeros(0, np.int64)] * 3
    if not len(filled):
        return nothing
    (_, _, buf, bounds), = chunks(joined.take(pa.array(filled)), 1 << 62)
    edges = piece_edges(buf, bounds, pair.cuts)
    if len(filled) > 1 or len(buf) <= 2 * block_bytes:
        runs = [(buf, edges, bounds)]
    else:
        at = np.unique(np.append(np.searchsorted(edges, np.arange(0, len(buf), block_bytes)), len(edges) - 1))
        runs = [(buf[edges[i] : edges[j]], edges[i : j + 1] - edges[i], edges[[i, j]] - edges[i]) for i, j in zip(at[:-1], at[1:], strict=True)]
    parts = []
    hashes = [hashlib.sha256() for _ in filled]
    for k, run in enumerate(runs):
        found = align(pair, *run)
        if len(runs) > 1 and not found.counts["n_a"][0]:  # one run is not the text's: it has no tokens at all
            return nothing
        for c in COUNTS:
            counts[c][filled] += found.counts[c]
        view = memoryview(found.digest)
        for d, h in enumerate(hashes):
            if k:
                h.update(b";")
            h.update(view[found.digest_bounds[d] : found.digest_bounds[d + 1]])
        parts.append(pa.table({"doc": filled[found.doc], "pair": found.pair, "times": found.times}))
    for d, h in zip(filled, hashes, strict=True):
        digests[d] = h.hexdigest() if counts["n_a"][d] else ""
    held = pa.concat_tables(parts)
    if len(runs) > 1:
        held = held.group_by(["doc", "pair"], use_threads=False).aggregate([("times", "sum")]).rename_columns(["doc", "pair", "times"])
    return counts, digests, *[held[c].to_numpy() for c in ("doc", "pair", "times")]


# ------------------------------------------------------------------ task side
def _align_blocks(batches, path_a: str, path_b: str, block_bytes: int):
    """One row per document with its pairs by their number in the block, and one per block with its pairs and their counts."""
    pair, block = None, TaskContext.get().partitionId() << 32
    for batch in batches:
        pair = pair or Pair(path_a, path_b)
        column = text_column(batch, "_text")
        for i, j, _, _ in chunks(column, block_bytes):
            counts, digests, doc, key, times = align_texts(pair, column.slice(i, j - i), block_bytes)
            named = pa.table({"pair": key}).group_by("pair", use_threads=False).aggregate([([], "count_all")]).sort_by("pair")
            pairs = named["pair"].to_numpy()
            offsets = np.concatenate(([0], np.cumsum(np.bincount(doc, minlength=j - i)))).astype(np.int32)
            no = np.searchsorted(pairs, key).astype(np.int32)
            ints = pa.list_(pa.int32())
            rows = [
                pa.array([block] * (j - i), pa.int64()), batch.column(0).slice(i, j - i), *[pa.array(counts[c]) for c in COUNTS], pa.array(digests, pa.string()),
                pa.ListArray.from_arrays(pa.array(offsets), pa.array(no)), pa.ListArray.from_arrays(pa.array(offsets), pa.array(times.astype(np.int32))),
                pa.nulls(j - i, pa.list_(pa.int64())), pa.nulls(j - i, ints),
            ]
            yield pa.RecordBatch.from_arrays(rows, BLOCK_COLUMNS)
            one = {"_block": [block], "_pairs": [pairs], "_docs": [named["count_all"].to_numpy().astype(np.int32)]}
            yield pa.RecordBatch.from_arrays([pa.array(one.get(n, [None]), r.type) for n, r in zip(BLOCK_COLUMNS, rows, strict=True)], BLOCK_COLUMNS)
            block += 1


def _gather(key, docs: pa.Table, answers: pa.Table) -> pa.Table:
    """Each document's sum of counts and number of best links, from the counts of its block's pairs."""
    size = docs.num_rows
    docs = docs.combine_chunks()
    no = answers["_no"].to_numpy()
    n, best = np.zeros(len(no), np.int64), np.zeros(len(no), bool)
    n[no], best[no] = answers["_n"].to_numpy(), answers["_best"].to_numpy()
    lists = docs["_held"].combine_chunks()
    doc, held, times = pc.list_parent_indices(lists).to_numpy(), lists.flatten().to_numpy(), docs["_times"].combine_chunks().flatten().to_numpy().astype(np.int64)
    total, top = np.zeros(size, np.int64), np.zeros(size, np.int64)
    np.add.at(total, doc, times * n[held])
    np.add.at(top, doc, times * best[held])
    columns = [docs["_row"], *[docs[f"_{c}"] for c in COUNTS], pa.array(top), pa.array(total), docs["_sha"]]
    return pa.table(columns, names=["_row", *[f"_{c}" for c in COUNTS], "_n_best", "_count_sum", "_sha"])


# ---------------------------------------------------------------- driver side
class Alignment:
    """Alignment of all texts of ``df``: written once when made, then read by document and by pair."""

    RESULTS = [*COUNTS, "n_best", "count_sum", "groups_sha256"]

    def __init__(self, df: DataFrame, path_a: str, path_b: str, text_col: str = "text", columns: list[str] | None = None, block_bytes: int = BLOCK_BYTES):
        self.names = other_columns(df.select(*[f"`{c}`" for c in columns]) if columns is not None else df, self.RESULTS)
        row = F.struct(F.lit(0).alias("_"), *[F.col(f"`{c}`") for c in self.names]).alias("_row")
        base = df.select(row, F.col(f"`{text_col}`").alias("_text"))
        longs = [T.StructField(f"_{c}", T.LongType()) for c in COUNTS]
        ints, pairs = T.ArrayType(T.IntegerType()), T.ArrayType(T.LongType())
        schema = T.StructType(
            [T.StructField("_block", T.LongType()), base.schema["_row"], *longs, T.StructField("_sha", T.StringType())]
            + [T.StructField("_held", ints), T.StructField("_times", ints), T.StructField("_pairs", pairs), T.StructField("_docs", ints)]
        )
        schema = T.StructType([T.StructField(f.name, f.dataType) for f in schema])  # a block's row has no document
        run = partial(_align_blocks, path_a=path_a, path_b=path_b, block_bytes=block_bytes)
        self.blocks = materialize(base.mapInArrow(run, schema), "aligned")

    def _dictionary(self) -> DataFrame:
        zipped = F.posexplode(F.arrays_zip("_pairs", "_docs")).alias("_no", "_z")
        return self.blocks.filter("_pairs IS NOT NULL").select("_block", zipped).select("_block", "_no", F.col("_z._pairs").alias("_pair"), F.col("_z._docs").alias("_docs"))

    def _counted(self) -> DataFrame:
        """Documents per pair over the corpus, and whether no other pair of its A id has more. An A id has at most as many pairs as B has ids."""
        counts = self._dictionary().groupBy("_pair").agg(F.sum("_docs").alias("_n"))
        of_a = Window.partitionBy(F.shiftright("_pair", 32))
        return counts.select("_pair", "_n", (F.col("_n") == F.max("_n").over(of_a)).alias("_best"))

    def pairs(self) -> DataFrame:
        """(a, b, n_docs, best) of every linked id pair."""
        return self._counted().select(
            F.shiftright("_pair", 32).cast("int").alias("a"), F.col("_pair").bitwiseAND(F.lit((1 << 32) - 1)).cast("int").alias("b"), F.col("_n").alias("n_docs"), F.col("_best").alias("best")
        )

    def documents(self) -> DataFrame:
        """The kept columns with n_a, n_b, n_groups, n_links, n_best, count_sum and groups_sha256."""
        docs = self.blocks.filter("_pairs IS NULL").drop("_pairs", "_docs")
        answers = self._dictionary().select("_block", "_no", "_pair").join(self._counted(), "_pair").select(F.col("_block").alias("_of"), "_no", "_n", "_best")
        longs = [T.StructField(f"_{c}", T.LongType()) for c in (*COUNTS, "n_best", "count_sum")]
        schema = T.StructType([docs.schema["_row"], *longs, T.StructField("_sha", T.StringType())])
        out = docs.groupBy("_block").cogroup(answers.groupBy("_of")).applyInArrow(lambda key, left, right: _gather(key, left, right), schema)
        new = [F.col(f"_{c}").alias(c) for c in self.RESULTS[:-1]] + [F.col("_sha").alias("groups_sha256")]
        return out.select(*[F.col("_row").getField(c).alias(c) for c in self.names], *new)


def align_tokenizers(df: DataFrame, path_a: str, path_b: str, text_col: str = "text", columns: list[str] | None = None, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``Alignment(...).documents()``: one row per row of ``df``. ``path_a`` and ``path_b`` must be readable by every executor."""
    return Alignment(df, path_a, path_b, text_col, columns, block_bytes).documents()
