"""N-gram Jaccard join: cells, count vectors in an R-tree, exact verification, components.

A document's set is its distinct ``width``-word shingles. Two documents link
when 100 * |intersection| >= percent * |union|; the result is the component of
every document under these links.

* Shingles are hashed into ``GROUPS`` groups; a document's group counts are a
  point. The sum of the coordinate minima of two points bounds the overlap of
  their sets from above, and so does that of a point and the upper corner of an
  R-tree node for all points in it.
* In that many dimensions a tree over the whole corpus prunes nothing near its
  root (a node of unlike documents has a corner above every point). So the
  points are first dealt to cells: with all shingles in one order, linked sets
  share a shingle among the first n - ceil(t n) + 1 of each; a cell holds the
  documents with one such shingle. Frequent shingles come last in the order (by
  a sample that grows with the corpus, so that chance cells do not; the order
  affects the cost, not the result).
* Equal sets collapse to one representative before all this; only its shingles are dealt.
* Pass 1 pairs each member of a cell with one other member, in a few turns with
  other leaders each: linear, and enough to join most groups of copies; it need
  not find every link. Pass 2
  takes all cells that still hold documents of different components and
  searches each cell's R-tree for pairs across components: first for the nearest
  one of each member, again linear, then for all. A cell too large for
  one task is split into pairs of blocks, which together hold all its pairs.
  Nothing is capped.
* A pair counts in a cell only if it could be the first cell, in the order, that
  both share: what stands before it in either prefix is then not shared, and
  must leave enough for a link. The first shared cell of linked sets passes.
  So near copies that are no links, each with edits of its own, which are rare
  shingles and come first, meet in few of the cells they share.
* Linked sets share many shingles of their prefixes (see ``_bounded``), so pairs
  that meet in a passage only are dropped; pairs whose count vectors also allow
  a link are then verified on the whole texts.

Links between documents that pass 1 has joined already are not enumerated, for
they cannot change a component. Components are found by hooking to the least
neighbour and pointer jumping, all in tables.

Null text is empty. A set without shingles links with nothing. Rows that share
an id are one vertex; null ids are told apart by their texts.
"""

from __future__ import annotations

from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import LOWER, U64, chunks, materialize, mix, span_hash, text_column, word_hash, word_spans, words_per_text

GROUPS = 64
SAMPLE_DOCS = 10_000  # documents whose shingles are counted for the order, at least,
SAMPLE_SHARE = 0.1  # and as a share: with a fixed number, cells of shingles too rare to be seen twice grow with the corpus
MAX_FREQUENT = 2_000_000  # shingles put last in the order
MAYBE_BITS = 24  # of a table that tells most other shingles from these without a search
LEAF = 32  # points in an R-tree leaf
FAN = 8  # nodes below a node
CELL = 2048  # documents of a cell searched in one task
TURNS = 1  # of pass 1; more turns leave fewer pairs to pass 2, which finds whatever links are left
HIGH = 1 << 62  # vertices of documents without an id are from here up, if no id is


# ------------------------------------------------------------------ task side
def shingle_hashes(buf: np.ndarray, bounds: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """All shingles of each text, with repetitions: (hash, text index)."""
    low = LOWER[buf]
    starts, ends = word_spans(low, bounds)
    at = words_per_text(starts, bounds)
    words = word_hash(low, starts, ends)
    n = np.diff(at)
    count = np.where(n >= width, n - width + 1, np.minimum(n, 1))
    doc = np.repeat(np.arange(len(n)), count)
    first = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + np.repeat(at[:-1], count)
    last = first + np.repeat(np.minimum(n, width), count)
    return span_hash(words, first, last), doc


def by_owner(values: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """The order of ``values`` by owner, then value; owners are small indices (of 16 bits, as a rule, which sort in linear time)."""
    first = np.argsort(values)
    kind = np.uint16 if not len(owner) or owner.max() < 1 << 16 else np.int64
    return first[np.argsort(owner[first].astype(kind), kind="stable")]


def maybe_table(frequent: np.ndarray) -> np.ndarray:
    """By the first bits of a hash, whether one of ``frequent`` begins so."""
    table = np.zeros(1 << MAYBE_BITS, dtype=bool)
    table[frequent >> U64(64 - MAYBE_BITS)] = True
    return table


def shingle_sets(
    buf: np.ndarray, bounds: np.ndarray, width: int, frequent: np.ndarray | None = None, rank: np.ndarray | None = None, maybe: np.ndarray | None = None
):
    """Distinct shingles of each text in the global order: (hash, text index). ``maybe`` is the table of ``frequent``."""
    h, doc = shingle_hashes(buf, bounds, width)
    key = h >> U64(6)
    if frequent is not None and len(frequent):
        some = np.flatnonzero((maybe_table(frequent) if maybe is None else maybe)[h >> U64(64 - MAYBE_BITS)])
        at = np.minimum(np.searchsorted(frequent, h[some]), len(frequent) - 1)
        key[some] |= np.where(frequent[at] == h[some], rank[at], 0).astype(U64) << U64(58)
    order = by_owner(key, doc)
    h, doc = h[order], doc[order]
    new = np.ones(len(h), dtype=bool)
    new[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
    return h[new], doc[new]


def prefix_size(n: np.ndarray, percent: int) -> np.ndarray:
    return np.where(n > 0, n - (percent * n + 99) // 100 + 1, 0)


def need(a: np.ndarray, b: np.ndarray, percent: int) -> np.ndarray:
    """Least overlap of linked sets of these sizes: 100 i >= percent (a + b - i)."""
    return -(-percent * (a + b) // (100 + percent))


def _common(batches, width: int):
    """Distinct shingles per batch and in how many of its texts they occur."""
    for batch in batches:
        for _, _, buf, bounds in chunks(text_column(batch, "_text")):
            h, _ = shingle_sets(buf, bounds, width)
            distinct, count = np.unique(h, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(distinct.view(np.int64)), pa.array(count)], ["h", "c"])


def _profile(batches, width: int, percent: int, frequent: np.ndarray, rank: np.ndarray, bits: int):
    maybe = maybe_table(frequent)
    for batch in batches:
        for i, j, buf, bounds in chunks(text_column(batch, "_text")):
            h, doc = shingle_sets(buf, bounds, width, frequent, rank, maybe)
            rows = j - i
            n = np.bincount(doc, minlength=rows)
            begin = np.cumsum(n) - n
            prints = []
            for salt in (0x1B873593CC9E2D51, 0x85EBCA6BC2B2AE35):
                total = np.zeros(len(h) + 1, dtype=U64)
                np.cumsum(mix(h ^ U64(salt)), out=total[1:])
                prints.append((total[begin + n] - total[begin]).view(np.int64))
            vec = np.bincount(doc * GROUPS + (h & U64(GROUPS - 1)).astype(np.int64), minlength=rows * GROUPS).reshape(rows, GROUPS)
            size = prefix_size(n, percent)
            flat = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size - begin, size)
            offsets = np.concatenate(([0], np.cumsum(size))).astype(np.int32)
            tokens = (h[flat] >> U64(64 - bits)).view(np.int64)  # a clash only adds a candidate
            yield pa.RecordBatch.from_arrays(
                [
                    *[c.slice(i, rows) for c in (batch.column(0), batch.column(1))], pa.array(n.astype(np.int32)), *[pa.array(p) for p in prints],
                    pa.array(_packed(vec), pa.binary()), pa.ListArray.from_arrays(pa.array(offsets), pa.array(tokens)),
                ],
                ["_v", "_th", "n", "f1", "f2", "vec", "prefix"],
            )


def _packed(vec: np.ndarray) -> list[bytes]:
    """Each count vector in as few bytes a count as its largest needs (1, 2 or 4)."""
    most = vec.max(1, initial=0)
    out: list[bytes] = [b""] * len(vec)
    for kind, low, high in (("<u1", 0, 1 << 8), ("<u2", 1 << 8, 1 << 16), ("<u4", 1 << 16, 1 << 32)):
        some = np.flatnonzero((most >= low) & (most < high))
        data = vec[some].astype(kind).tobytes()
        size = GROUPS * int(kind[2])
        for k, i in enumerate(some):
            out[i] = data[k * size : (k + 1) * size]
    return out


def _vectors(col) -> np.ndarray:
    """Count vectors, one row each, from a list or an array of packed ones."""
    rows = col.to_pylist() if isinstance(col, pa.Array) else col
    out = np.empty((len(rows), GROUPS), np.int64)
    size = np.array([len(r) for r in rows], dtype=np.int64)
    for width in (1, 2, 4):
        some = np.flatnonzero(size == GROUPS * width)
        if len(some):
            out[some] = np.frombuffer(b"".join([rows[i] for i in some]), dtype=f"<u{width}").reshape(-1, GROUPS)
    return out


def _by_vectors(batches, percent: int):
    """Pairs (a, b) whose count vectors allow a link, with how many shingles of their prefixes they must share at least."""
    for batch in batches:
        col = {name: batch.column(k) for k, name in enumerate(batch.schema.names)}
        if not len(col["a"]):
            continue
        n_a, n_b = (col[f"n_{e}"].to_numpy().astype(np.int64) for e in "ab")
        overlap = need(n_a, n_b, percent)
        ok = np.minimum(_vectors(col["vec_a"]), _vectors(col["vec_b"])).sum(1) >= overlap
        least = np.minimum(prefix_size(n_a, percent) - (n_a - overlap), prefix_size(n_b, percent) - (n_b - overlap))
        keep = np.flatnonzero(ok)
        yield pa.RecordBatch.from_arrays([col["a"].take(pa.array(keep)), col["b"].take(pa.array(keep)), pa.array(least[keep])], ["a", "b", "least"])


def _distinct(values: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Values and owners in order, each value once an owner."""
    order = by_owner(values, owner)
    values, owner = values[order], owner[order]
    new = np.ones(len(values), dtype=bool)
    new[1:] = (values[1:] != values[:-1]) | (owner[1:] != owner[:-1])
    return values[new], owner[new]


def _by_prefixes(batches, step: int = 1024):
    """Pairs (a, b) that share enough shingles of their prefixes.

    Of two prefixes, take the one that ends first in the order: what it shares
    with the other set lies in the other prefix too. At most n - need of its
    shingles are not shared, so linked sets share prefix - (n - need) of them at
    least; that many less the names that clash within either prefix are equal.
    """
    for batch in batches:
        col = {name: batch.column(k) for k, name in enumerate(batch.schema.names)}
        least = col["least"].to_numpy()
        sides = [(col[f"prefix_{e}"].offsets.to_numpy(), col[f"prefix_{e}"].values.to_numpy()) for e in "ab"]
        ok = np.ones(len(least), dtype=bool)
        for i in range(0, len(least), step):
            need_here = least[i : i + step]
            many = len(need_here)
            clashes, both = [], []
            for at, values in sides:
                at = at[i : i + many + 1]
                x, pair = _distinct(values[at[0] : at[-1]], np.repeat(np.arange(many), np.diff(at)))
                clashes.append(np.diff(at) - np.bincount(pair, minlength=many))
                both.append((x, pair))
            x, pair = (np.concatenate(c) for c in zip(*both, strict=True))
            order = by_owner(x, pair)
            x, pair = x[order], pair[order]
            met = pair[1:][(x[1:] == x[:-1]) & (pair[1:] == pair[:-1])]
            ok[i : i + many] = (need_here <= 1) | (np.bincount(met, minlength=many) >= need_here - np.minimum(*clashes))
        keep = pa.array(np.flatnonzero(ok))
        yield pa.RecordBatch.from_arrays([col["a"].take(keep), col["b"].take(keep)], ["a", "b"])


class RTree:
    """Points of a cell, packed into leaves by size and by their largest groups, and nodes of ``FAN`` nodes above them.

    A node knows the upper corner of its points and the least of their sizes.
    """

    def __init__(self, points: np.ndarray, sizes: np.ndarray):
        top = points.argmax(1)
        self.order = np.lexsort((points[np.arange(len(points)), top], top, sizes // max(1, int(sizes.max()) // 8 + 1)))
        cuts = np.arange(0, len(points), LEAF)
        levels = [(np.maximum.reduceat(points[self.order], cuts, axis=0), np.minimum.reduceat(sizes[self.order], cuts))]
        while len(levels[-1][1]) > FAN:
            corner, least = levels[-1]
            cuts = np.arange(0, len(least), FAN)
            levels.append((np.maximum.reduceat(corner, cuts, axis=0), np.minimum.reduceat(least, cuts)))
        self.levels = levels  # leaves first
        self.points, self.sizes = points, sizes

    def search(self, q: int, percent: int) -> np.ndarray:
        """Indices of points that may link with point ``q``: down from the root, through nodes that may hold one."""
        p, n = self.points[q], self.sizes[q]
        nodes = np.arange(len(self.levels[-1][1]))
        for depth in range(len(self.levels) - 1, -1, -1):
            corner, least = self.levels[depth]
            nodes = nodes[np.minimum(corner[nodes], p).sum(1) >= need(least[nodes], n, percent)]
            if not len(nodes):
                return nodes
            fan, size = (FAN, len(self.levels[depth - 1][1])) if depth else (LEAF, len(self.order))
            nodes = (nodes[:, None] * fan + np.arange(fan)).ravel()
            nodes = nodes[nodes < size]
        found = self.order[nodes]
        return found[np.minimum(self.points[found], p).sum(1) >= need(self.sizes[found], n, percent)]


def _search_cells(batches, percent: int, nearest: bool = False, flush: int = 200_000):
    """Rows come ordered by cell; emits (a, b): pairs of different components that may link and may share no earlier cell.

    With ``nearest``, of each row only the pair of the highest bound. A cell of one leaf has no tree above it: the pairs
    of all such cells of a batch are bounded together.
    """
    found: list = [[], []]
    rest: pa.Table | None = None  # of a cell that the next batch may go on with

    def emit(v, i, j):
        found[0].append(np.minimum(v[i], v[j]))
        found[1].append(np.maximum(v[i], v[j]))
        return len(i)

    def search(tbl: pa.Table) -> int:
        """All cells of ``tbl``, which holds them whole."""
        v, comp, sizes, side, left = (tbl.column(c).to_numpy().astype(np.int64) for c in ("_v", "c", "n", "side", "left"))
        t, lo, hi = (tbl.column(c).to_numpy() for c in ("t", "lo", "hi"))
        first = np.flatnonzero(np.append(True, (t[1:] != t[:-1]) | (lo[1:] != lo[:-1]) | (hi[1:] != hi[:-1])))
        many = np.diff(np.append(first, len(v)))
        cell = np.repeat(np.arange(len(first)), many)
        vec = tbl.column("vec").combine_chunks()
        vec = vec.chunk(0) if isinstance(vec, pa.ChunkedArray) else vec
        across = lo != hi  # a pair of blocks: only pairs across them

        def allowed(i, j):
            return (comp[i] != comp[j]) & (np.minimum(left[i], left[j]) >= need(sizes[i], sizes[j], percent)) & (~across[i] | (side[i] != side[j]))

        n = 0
        best, partner = np.zeros(len(v)), np.full(len(v), -1)  # of each row, for ``nearest``

        def prefer(i, j, value):
            for x, y in ((i, j), (j, i)):
                by = np.argsort(value, kind="stable")  # of a row's several, the highest is written last
                x, y, z = x[by], y[by], value[by]
                more = z > best[x]
                best[x[more]], partner[x[more]] = z[more], y[more]

        def take(i, j, bound):
            if nearest:
                prefer(i, j, bound / need(sizes[i], sizes[j], percent))
                return 0
            return emit(v, i, j)

        small = np.repeat(many <= LEAF, many)
        for d in range(1, min(LEAF, int(many.max()))):
            i = np.flatnonzero(small[:-d] & (cell[:-d] == cell[d:]))
            i = i[allowed(i, i + d)]
            if len(i):
                ends = [_vectors(vec.take(pa.array(x))) for x in (i, i + d)]
                bound = np.minimum(*ends).sum(1)
                ok = bound >= need(sizes[i], sizes[i + d], percent)
                n += take(i[ok], i[ok] + d, bound[ok])
        for k in np.flatnonzero(many > LEAF):
            at = np.arange(first[k], first[k] + many[k])
            points = _vectors(vec.slice(first[k], many[k]))
            tree = RTree(points, sizes[at])
            for q in range(len(at)):
                near = tree.search(q, percent)
                near = near[near > q]
                near = near[allowed(np.full(len(near), at[q]), at[near])]
                if len(near):
                    n += take(np.full(len(near), at[q]), at[near], np.minimum(points[near], points[q]).sum(1))
        if nearest:
            i = np.flatnonzero(partner >= 0)
            n += emit(v, i, partner[i])
        return n

    def once():
        a, b = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in found)
        found[:] = [[], []]
        order = np.lexsort((b, a))
        a, b = a[order], b[order]
        new = np.flatnonzero(np.append(True, (a[1:] != a[:-1]) | (b[1:] != b[:-1]))) if len(a) else np.zeros(0, np.int64)
        return pa.RecordBatch.from_arrays([pa.array(a[new]), pa.array(b[new])], ["a", "b"])

    size = 0
    for batch in batches:
        tbl = pa.Table.from_batches([batch])
        tbl = tbl if rest is None else pa.concat_tables([rest, tbl])
        if not tbl.num_rows:
            continue
        keys = [tbl.column(c).to_numpy() for c in ("t", "lo", "hi")]
        last = np.logical_and.reduce([k == k[-1] for k in keys])
        cut = len(last) - int(np.argmin(last[::-1])) if not last.all() else 0  # where the last cell begins
        rest = tbl.slice(cut)
        if cut:
            size += search(tbl.slice(0, cut).combine_chunks())
        if size >= flush:
            yield once()
            size = 0
    if rest is not None and rest.num_rows:
        search(rest.combine_chunks())
    yield once()


def _verify(batches, width: int, percent: int):
    for batch in batches:
        a, b = text_column(batch, "text_a"), text_column(batch, "text_b")
        step = 256
        for i in range(0, len(a), step):
            texts = [t.as_buffer().to_pybytes() for pair in zip(a[i : i + step], b[i : i + step], strict=True) for t in pair]
            bounds = np.concatenate(([0], np.cumsum([len(t) for t in texts])))
            h, doc = shingle_sets(np.frombuffer(b"".join(texts), dtype=np.uint8), bounds, width)
            n = np.bincount(doc, minlength=len(texts)).reshape(-1, 2)
            pair = doc // 2
            order = by_owner(h, pair)
            h, pair = h[order], pair[order]
            both = np.flatnonzero((h[1:] == h[:-1]) & (pair[1:] == pair[:-1]))
            common = np.bincount(pair[both], minlength=len(n))
            ok = (100 * common >= percent * (n.sum(1) - common)) & (common > 0)
            keep = pa.array(np.flatnonzero(ok) + i)
            yield pa.RecordBatch.from_arrays([batch.column(0).take(keep), batch.column(1).take(keep)], ["a", "b"])


# ---------------------------------------------------------------- driver side
def components(links: DataFrame) -> DataFrame:
    """(v, c): the least vertex that each linked vertex can reach. ``links`` has long columns a and b."""
    both = materialize(links.select("a", "b").unionAll(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "links")
    labels = materialize(both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("v"), F.least("a", "m").alias("c")), "labels")
    while True:
        near = both.join(labels.withColumnRenamed("v", "b"), "b").groupBy("a").agg(F.min("c").alias("m"))
        hooked = labels.join(near.withColumnRenamed("a", "v"), "v").select("v", F.col("c").alias("was"), F.least("c", "m").alias("h"))
        hop = hooked.select(F.col("v").alias("h"), F.col("h").alias("c"))
        after = materialize(hooked.join(hop, "h").select("v", "c", (F.col("c") != F.col("was")).alias("new")), "labels")
        moved = after.agg(F.sum(F.col("new").cast("int"))).first()[0] or 0
        labels = after.select("v", "c")
        if not moved:
            return labels


def _is_long(df: DataFrame, column: str) -> bool:
    return isinstance(df.schema[column].dataType, (T.ByteType, T.ShortType, T.IntegerType, T.LongType))


def _vertices(df: DataFrame, id_col: str, text_col: str) -> tuple[Column, str]:
    """The vertex of a row, and what vertices are: ``ids`` all, ``high`` ones from HIGH on have none, or ``other``.

    An integral id is its own vertex, another kind its 64-bit hash. A row without an id gets a hash of its text, from a
    part of the 64-bit numbers that holds no id; only if ids lie in both outer quarters is that left to the hash alone.
    """
    text = F.xxhash64(F.col(f"`{text_col}`"), F.lit(7))
    if not _is_long(df, id_col):
        return F.when(F.col(f"`{id_col}`").isNull(), text).otherwise(F.xxhash64(F.col(f"`{id_col}`"))), "other"
    own = F.col(f"`{id_col}`").cast("long")
    seen = df.agg(F.min(own).alias("lo"), F.max(own).alias("hi"), F.count(F.when(own.isNull(), 1)).alias("none")).first()
    if not seen["none"]:
        return own, "ids"
    short = F.shiftrightunsigned(text, 2)
    if (seen["hi"] or 0) < HIGH:
        return F.coalesce(own, short.bitwiseOR(F.lit(HIGH))), "high"
    if (seen["lo"] or 0) >= -HIGH:
        return F.coalesce(own, short.bitwiseOR(F.lit(-(1 << 63)))), "other"
    return F.coalesce(own, text), "other"


def _verified(pairs: DataFrame, points: DataFrame, profile: DataFrame, docs: DataFrame, width: int, percent: int, name: str) -> DataFrame:
    """The pairs (a, b) that link: bounded by sizes, count vectors and prefixes, then compared on the texts in ``docs``(_v, _text)."""


    def ends(pairs: DataFrame, values: DataFrame) -> DataFrame:
        """``pairs`` with the columns of ``values``(_v, ...) for a and for b."""
        for end in ("a", "b"):
            pairs = pairs.join(values.select(*[F.col(c).alias(end if c == "_v" else f"{c}_{end}") for c in values.columns]), end)
        return pairs

    def met(pairs: DataFrame, label: str) -> DataFrame:
        """The vertices in ``pairs``: a written table, so that a join with it is a broadcast while it is small."""
        both = pairs.select(F.col("a").alias("_v")).unionAll(pairs.select(F.col("b").alias("_v")))
        return materialize(both.distinct(), f"{name}-{label}")

    pairs = materialize(pairs, f"{name}-pairs")
    near = points.select("_v", "n", "vec").join(met(pairs, "met"), "_v", "left_semi")
    told = ends(pairs, near).select("a", "b", "n_a", "n_b", "vec_a", "vec_b")
    pairs = materialize(told.mapInArrow(partial(_by_vectors, percent=percent), "a long, b long, least long").groupBy("a", "b").agg(F.min("least").alias("least")), f"{name}-near")
    held = profile.select("_v", "prefix").join(met(pairs, "near-met"), "_v", "left_semi")
    pairs = ends(pairs, held).select("a", "b", "least", "prefix_a", "prefix_b").mapInArrow(_by_prefixes, "a long, b long").distinct()
    pairs = materialize(pairs, f"{name}-bounded")
    ids = met(pairs, "ids")
    docs = materialize(docs.join(ids, "_v", "left_semi"), f"{name}-texts")  # the texts of few documents
    first = docs.join(pairs, docs["_v"] == pairs["a"]).select("a", "b", F.col("_text").alias("text_a"))
    both = docs.join(first, docs["_v"] == first["b"]).select("a", "b", "text_a", F.col("_text").alias("text_b"))
    return materialize(both.mapInArrow(partial(_verify, width=width, percent=percent), "a long, b long").distinct(), f"{name}-links")


def _frequent(docs: DataFrame, total: int, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes, ascending, and ranks of the shingles that a sample of ``docs`` holds most often, MAX_FREQUENT at most."""
    share = min(1.0, max(SAMPLE_DOCS / max(total, 1), SAMPLE_SHARE))
    some = docs.filter(F.pmod(F.xxhash64("_v", F.lit(3)), F.lit(1 << 20)) < int(share * (1 << 20)) + 1)
    often = some.mapInArrow(partial(_common, width=width), "h long, c long").groupBy("h").agg(F.sum("c").alias("c")).filter("c >= 3")
    often = materialize(often.select("h", F.least(F.lit(63), (1 + F.log2(F.col("c") + 1) * 4).cast("int")).alias("rank")), "often")
    held, least = 0, 64
    for r in often.groupBy("rank").agg(F.count("*").alias("k")).orderBy(F.desc("rank")).collect():  # 64 rows at most
        held += r["k"]
        if held > MAX_FREQUENT:
            break
        least = r["rank"]
    found = often.filter(F.col("rank") >= least).toArrow()
    h = found.column("h").to_numpy().view(U64)
    by = np.argsort(h)
    return h[by], found.column("rank").to_numpy()[by].astype(np.uint8)


def link_documents(df: DataFrame, vertex: Column, text_col: str = "text", width: int = 5, percent: int = 75) -> DataFrame:
    """(_v, _th, n, c): each document's ``vertex``, text hash, set size and least reachable vertex."""
    docs = df.select(vertex.alias("_v"), F.xxhash64(F.col(f"`{text_col}`")).alias("_th"), F.col(f"`{text_col}`").alias("_text"))
    size = docs.agg(F.count("*").alias("n"), F.sum(F.octet_length("_text")).alias("bytes")).first()
    total = size["n"]
    # Names of cells: short, but 64 times as many as there are shingles in prefixes (about one in 24 bytes).
    bits = min(62, max(24, int((size["bytes"] or 0) // 24).bit_length() + 6))
    frequent, rank = _frequent(docs, total, width)
    profile = docs.mapInArrow(
        partial(_profile, width=width, percent=percent, frequent=frequent, rank=rank, bits=bits),
        "_v long, _th long, n int, f1 long, f2 long, vec binary, prefix array<long>",
    )
    profile = materialize(profile, "profile")

    rows = profile.filter("n > 0")
    classes = materialize(rows.groupBy("n", "f1", "f2").agg(F.min("_v").alias("rep")), "classes")
    members = rows.select("_v", "_th", "n", "f1", "f2").join(classes, ["n", "f1", "f2"]).select("_v", "_th", "rep")
    least = classes.select(F.col("rep").alias("_v"), "n", "f1", "f2")
    points = rows.select("_v", "n", "f1", "f2", "vec").join(least, ["_v", "n", "f1", "f2"], "left_semi").dropDuplicates(["_v", "n", "f1", "f2"])
    points = materialize(points.select("_v", "n", "vec"), "points")

    # Equal sets have equal prefixes, so the shingles of one stand for all. Most are in one set only: those are no cells.
    mine = rows.select("_v", "n", "f1", "f2", "prefix").join(least, ["_v", "n", "f1", "f2"], "left_semi")
    postings = mine.select(F.posexplode("prefix").alias("pos", "t"), "_v", "n")
    shared = postings.withColumn("k", F.count("*").over(Window.partitionBy("t"))).filter("k > 1")
    # of rows that share an id and not their text, all sets stand for it
    cells = shared.groupBy("t", "_v").agg(F.max(F.col("n") - F.col("pos")).alias("left"), F.min("n").alias("n"))  # shingles from this one on
    cells = materialize(cells, "cells")
    # a vertex with several sets links them
    several = members.groupBy("_v").agg(F.min("rep").alias("a"), F.max("rep").alias("b")).filter("a != b").select("_v", "a")
    links = materialize(members.join(several, "_v").filter("a != rep").select("a", F.col("rep").alias("b")).distinct(), "own")

    # Pass 1: every member with one member of its cell, the first in an order that changes each turn.
    told = cells.withColumn("c", F.col("_v"))
    for turn in range(TURNS):
        order = F.xxhash64(F.lit(turn), F.col("_v"))
        lead = F.min_by(F.struct("_v", "c", "n"), order).alias("lead")
        leaders = told.groupBy("t").agg(lead, F.min("c").alias("lo"), F.max("c").alias("hi")).filter("lo != hi")
        leaders = materialize(leaders.select("t", *[F.col(f"lead.{c}").alias(a) for c, a in (("_v", "a"), ("c", "ca"), ("n", "na"))]), "leaders")
        stars = told.join(leaders, "t").filter("c != ca").filter(F.least("n", "na") * 100 >= F.greatest("n", "na") * percent)
        stars = stars.select(F.least("a", "_v").alias("a"), F.greatest("a", "_v").alias("b")).distinct()
        links = links.unionAll(_verified(stars, points, rows, docs.select("_v", "_text"), width, percent, f"stars{turn}"))
        joined = components(links)
        told = _still_open(told.drop("c"), joined, "told")

    # Pass 2: pairs across components; first each member's nearest only, which joins most of what is near, then all.
    for nearest in (True, False):
        blocks = told.groupBy("t").agg(F.ceil(F.count("*") / CELL).cast("int").alias("blocks"))
        open_cells = told.withColumnRenamed("n", "_").drop("_").join(blocks, "t").join(points, "_v")
        block = F.pmod(F.xxhash64("_v"), F.col("blocks")).cast("int")
        open_cells = open_cells.select("t", "_v", "c", "n", "vec", "left", block.alias("side"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
        open_cells = open_cells.select("t", F.least("side", "other").alias("lo"), F.greatest("side", "other").alias("hi"), "_v", "c", "n", "side", "vec", "left")
        open_cells = open_cells.repartition("t", "lo", "hi").sortWithinPartitions("t", "lo", "hi")
        across = open_cells.mapInArrow(partial(_search_cells, percent=percent, nearest=nearest), "a long, b long").distinct()
        name = "nearest" if nearest else "across"
        links = links.unionAll(_verified(across, points, rows, docs.select("_v", "_text"), width, percent, name))
        joined = components(links)
        if nearest:
            told = _still_open(told.drop("c"), joined, "told")

    classed = members.join(joined.withColumnRenamed("v", "rep"), "rep", "left").select("_v", "_th", F.coalesce("c", "rep").alias("c")).distinct()
    return profile.select("_v", "_th", "n").join(classed, ["_v", "_th"], "left").select("_v", "_th", "n", F.coalesce("c", "_v").alias("c"))


def _still_open(cells: DataFrame, joined: DataFrame, name: str) -> DataFrame:
    """Rows of ``cells`` with their components ``c``, of the cells that hold several; of two members the pair has been decided."""
    told = cells.join(joined.withColumnRenamed("v", "_v"), "_v", "left").withColumn("c", F.coalesce("c", "_v"))
    several = told.groupBy("t").agg(F.min("c").alias("lo"), F.max("c").alias("hi"), F.count("*").alias("k")).filter("lo != hi AND k > 2").select("t")
    return materialize(told.join(several, "t", "left_semi"), name)


def cluster_documents(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5, percent: int = 75) -> DataFrame:
    """(id, n_shingles, component_id): a row per row of ``df``; component_id is the least id reachable by links.

    A component without any id has a null component_id.
    """
    vertex, kinds = _vertices(df, id_col, text_col)
    linked = link_documents(df, vertex, text_col, width, percent)
    n = F.col("n").cast("long").alias("n_shingles")
    if kinds != "other":
        own, least = (F.col(c) if kinds == "ids" else F.when(F.col(c) < HIGH, F.col(c)) for c in ("_v", "c"))
        kind = df.schema[id_col].dataType
        return linked.select(own.cast(kind).alias(id_col), n, least.cast(kind).alias("component_id"))
    ids = df.select(vertex.alias("_v"), F.col(f"`{id_col}`").alias("_id")).distinct()
    named = linked.join(ids, "_v")
    least = named.groupBy("c").agg(F.min("_id").alias("component_id"))
    return named.join(least, "c").select(F.col("_id").alias(id_col), n, "component_id")


def keep_one(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5, percent: int = 75) -> DataFrame:
    """The rows of ``df`` without near duplicates: of each component the row with the least vertex; rows without words all stay."""
    vertex, _ = _vertices(df, id_col, text_col)
    linked = link_documents(df, vertex, text_col, width, percent)
    # Decided on narrow rows and written, so that while they are few, rows with their texts are not shuffled for them.
    rows = materialize(linked, "decided")
    several = rows.filter("n > 0 AND _v = c").groupBy("_v").agg(F.count("*").alias("k")).filter("k > 1").select("_v")
    again = rows.filter("n > 0 AND _v = c").join(several, "_v", "left_semi").select("_v", "_th", F.lit(False).alias("gone"))
    verdict = materialize(rows.filter("_v != c").select("_v", "_th", F.lit(True).alias("gone")).unionAll(again).distinct(), "verdict")
    keyed = df.select(F.struct(F.lit(0).alias("_"), *[F.col(f"`{c}`") for c in df.columns]).alias("_row"), vertex.alias("_v"), F.xxhash64(F.col(f"`{text_col}`")).alias("_th"))
    told = keyed.join(verdict, ["_v", "_th"], "left")
    once = told.filter("gone IS NULL").select("_row")
    one_of = told.filter("NOT gone").select("_row", "_v").dropDuplicates(["_v"]).select("_row")
    return once.unionByName(one_of).select(*[F.col("_row").getField(c).alias(c) for c in df.columns])
