"""Document fingerprints by spot signatures.

Anchors are very common words (and the start of the text). A signature is an
anchor and the chain of content words after it, every ``distance``-th of them,
``chain`` in all; a fingerprint is the sorted set of its signatures' 32-bit
hashes, 8 hexadecimal digits each. Likeness is the Jaccard index of two
fingerprints; the ratio of the set lengths bounds it from above, so pairs too
unequal in length are never intersected.

Words are lower-cased (A-Z) runs of letters, digits and non-ASCII characters. A
text with words but no full chain has one signature of all its words, one
without words a signature of its bytes; the empty text (and null) has none.
Equal texts have equal fingerprints; two empty fingerprints have likeness 1.

``match_documents`` compares all documents: equal fingerprints are one class;
classes are partitioned by set length, in bands such that only neighbouring
bands can hold a match; within a band, classes meet on their rarest signatures
(of n, the n - ceil(t n) + 1 rarest: two sets of likeness t share one of them),
and only where lengths and what is left from that signature on allow a match.

``compare_neighbours`` walks the documents in ascending order of the id, the
last being followed by the first: texts are dealt once to ranges of ids, each
with a copy of the document that follows the range. Null ids come first;
repeated ids are ordered by text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import LOWER, U64, byte_table, chunks, materialize, mix, other_columns, text_bytes, text_column, word_hash, word_spans, words_per_text

BREAKS = byte_table([*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)])

# Anchors, the commonest words of English, German, French and Spanish.
ANCHORS = "the of and to der die und das de la le et que el en".split()
# Other common words, which are never part of a chain.
COMMON = "a in is it for on with as at by this that was be are or an from ist zu den mit von ein im les des un une du est pour qui dans los las y con por para es del se".split()

SAMPLE_IDS = 20_000  # ids sampled (by hash) to balance the ranges; affects only their sizes


def _hash_words(words: list[str]) -> np.ndarray:
    buf = np.frombuffer(" ".join(words).encode(), dtype=np.uint8)
    starts, ends = word_spans(buf, np.array([0, len(buf)]))
    return np.sort(word_hash(buf, starts, ends))


def _member(values: np.ndarray, table: np.ndarray) -> np.ndarray:
    at = np.minimum(np.searchsorted(table, values), len(table) - 1)
    return table[at] == values


def signatures(buf: np.ndarray, bounds: np.ndarray, distance: int = 1, chain: int = 2) -> list[np.ndarray]:
    """Sorted distinct 32-bit signatures of each text in ``buf``."""
    low = LOWER[buf]
    starts, ends = word_spans(low, bounds, BREAKS)
    at = words_per_text(starts, bounds)
    words = word_hash(low, starts, ends)
    n_texts, n = len(bounds) - 1, len(words)
    doc = np.repeat(np.arange(n_texts), np.diff(at))
    anchors = _hash_words(ANCHORS)
    anchor = _member(words, anchors) if n else np.zeros(0, bool)
    content = np.flatnonzero(~(anchor | _member(words, _hash_words(COMMON)))) if n else np.zeros(0, np.int64)
    # spots: (document, position after which the chain begins, name of the anchor); -1 before the first word
    spot = np.concatenate((np.flatnonzero(anchor), at[:-1] - 1))
    spot_doc = np.concatenate((doc[anchor], np.arange(n_texts)))
    name = np.concatenate((words[anchor], np.full(n_texts, 1, dtype=U64)))
    first = np.searchsorted(content, spot, "right")
    last = first + (chain - 1) * distance
    ok = last < len(content)
    ok[ok] = doc[content[last[ok]]] == spot_doc[ok]
    first, spot_doc, sig = first[ok], spot_doc[ok], name[ok]
    for k in range(chain):
        sig = mix(sig * U64(0x9E3779B97F4A7C15) + words[content[first + k * distance]])
    pairs = np.unique((spot_doc.astype(U64) << U64(32)) | (sig >> U64(32)))
    owner = (pairs >> U64(32)).astype(np.int64)
    low32 = (pairs & U64(0xFFFFFFFF)).astype(np.uint32)
    cut = np.searchsorted(owner, np.arange(n_texts + 1))
    out = []
    for i in range(n_texts):
        if cut[i] < cut[i + 1]:
            out.append(low32[cut[i] : cut[i + 1]])
        elif bounds[i] < bounds[i + 1]:
            raw = words[at[i] : at[i + 1]].tobytes() if at[i] < at[i + 1] else bytes(buf[bounds[i] : bounds[i + 1]])
            out.append(np.frombuffer(hashlib.sha256(raw).digest()[:4], dtype=np.uint32))
        else:
            out.append(np.zeros(0, np.uint32))
    return out


def as_text(sigs: np.ndarray) -> str:
    return sigs.astype(">u4").tobytes().hex()


def from_text(fingerprint: str) -> np.ndarray:
    return np.frombuffer(bytes.fromhex(fingerprint), dtype=">u4").astype(np.uint32)


def likeness(a: np.ndarray, b: np.ndarray, at_least: float = 0.0) -> float:
    """Jaccard index of two sorted sets, or 0 without a look if their lengths rule out ``at_least``."""
    small, large = sorted((len(a), len(b)))
    if not large:
        return 1.0
    if small < at_least * large:
        return 0.0
    both = np.sort(np.concatenate((a, b)), kind="stable")
    common = int((both[1:] == both[:-1]).sum())
    return common / (small + large - common)


def _texts_to_buffer(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    raw = [t.encode() for t in texts]
    return np.frombuffer(b"".join(raw), dtype=np.uint8), np.concatenate(([0], np.cumsum([len(r) for r in raw])))


# ------------------------------------------------------------------ task side
def _fingerprints(batches, **how) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for _, _, buf, bounds in chunks(text_column(batch, "_text")):
            out += [as_text(s) for s in signatures(buf, bounds, **how)]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.string())], ["_row", "_print"])


def _rows(batches) -> Iterator[tuple]:
    for batch in batches:
        col = text_column(batch, "_text")
        extra, guard, bucket = batch.column(0), batch.column(1).to_pylist(), batch.column(2).to_pylist()
        for i in range(len(col)):
            yield extra[i], guard[i], bucket[i], col[i].as_py()


def _neighbours(batches, limit: int = 2 << 20, **how) -> Iterator[pa.RecordBatch]:
    """Rows come ordered by bucket; a bucket's last row is the guard, the document after the bucket."""
    kind = None
    held: list[tuple] = []  # (row, text, edited text) of documents; the text of the one after the last is still to come
    size = 0

    def flush(after: str):
        texts = [h[1] for h in held] + [after]
        sigs: list[np.ndarray] = []
        edited_sigs: list[np.ndarray] = []
        edited = []
        for t, nxt in zip(texts[:-1], texts[1:], strict=True):
            half = len(t) // 2
            edited.append(t[: len(t) - half] + nxt[:half])
        for batch_of, out in ((texts, sigs), (edited, edited_sigs)):
            out += signatures(*_texts_to_buffer(batch_of), **how)
        columns = [
            pa.array([h[0].as_py() for h in held], kind),
            pa.array([len(t) for t in texts[:-1]], pa.int64()),
            pa.array([hashlib.sha256(e.encode()).hexdigest() for e in edited], pa.string()),
            pa.array([as_text(s) for s in sigs[:-1]], pa.string()),
            pa.array([as_text(s) for s in edited_sigs], pa.string()),
            pa.array([likeness(a, b) for a, b in zip(sigs[:-1], edited_sigs, strict=True)], pa.float64()),
            pa.array([likeness(a, b) for a, b in zip(sigs[:-1], sigs[1:], strict=True)], pa.float64()),
        ]
        return pa.RecordBatch.from_arrays(columns, ["_row", "_n", "_sha", "_print", "_edited", "_near_e", "_near_n"])

    for row, guard, _, text in _rows(batches):
        kind = row.type
        if held and (guard or size > limit):
            yield flush(text)
            held, size = [], 0
        if not guard:
            held.append((row, text))
            size += len(text)


# ---------------------------------------------------------------- driver side
def add_fingerprints(df: DataFrame, text_col: str = "text", name: str = "fingerprint", distance: int = 1, chain: int = 2) -> DataFrame:
    """``df`` with the column ``name`` (replaced if there); no shuffle."""
    names = other_columns(df, [name])
    base = df.select(F.struct(F.lit(0).alias("_"), *[F.col(f"`{c}`") for c in names]).alias("_row"), F.col(text_col).alias("_text"))
    out = base.mapInArrow(partial(_fingerprints, distance=distance, chain=chain), f"_row {base.schema['_row'].dataType.simpleString()}, _print string")
    return out.select(*[F.col("_row").getField(c).alias(c) for c in names], F.col("_print").alias(name))


def match_documents(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", at_least: float = 0.75, distance: int = 1, chain: int = 2
) -> tuple[DataFrame, DataFrame]:
    """(classes, links): each row's id with the class of its fingerprint, and the pairs (a, b, likeness) of classes that match.

    Classes are named by the MD5 of their fingerprint; empty fingerprints are one class without links. Pairs of equal
    fingerprints are told by the class alone. DataFrame functions but for the fingerprints; nothing is capped.
    """
    if not 0 < at_least <= 1:
        raise ValueError("at_least must be above 0, and 1 at most")
    printed = add_fingerprints(df.select(F.col(f"`{id_col}`").alias("_id"), F.col(f"`{text_col}`").alias("_text")), "_text", "_print", distance, chain)
    printed = materialize(printed.select("_id", "_print", F.md5("_print").alias("_class")), "prints")
    t = F.lit(float(at_least))
    tiny = 1e-9  # so that a product that should be whole is not rounded up
    sets = printed.filter("_print != ''").groupBy("_class").agg(F.any_value("_print").alias("_print"))
    sets = sets.select("_class", F.expr("transform(sequence(1, length(_print), 8), i -> substring(_print, i, 8))").alias("sigs"))
    sets = materialize(sets.withColumn("n", F.size("sigs")), "sets")
    each = sets.select("_class", "n", F.explode("sigs").alias("sig"))
    rare = materialize(each.groupBy("sig").agg(F.count("*").alias("c")).filter("c > 1"), "shared")
    # signatures of one class only stand first and meet nobody: places are counted from how many of them there are
    shared = each.join(rare, "sig")
    place = F.row_number().over(Window.partitionBy("_class").orderBy("c", "sig")) - 1
    total = F.count("*").over(Window.partitionBy("_class"))
    first = shared.select("_class", "n", "sig", (F.col("n") - total + place).alias("pos"))
    first = first.filter(F.col("pos") <= F.col("n") - F.ceil(t * F.col("n") - tiny))
    band = F.floor(F.log(F.col("n").cast("double")) / F.lit(-np.log(at_least)) + tiny).cast("int") if at_least < 1 else F.col("n")
    first = first.withColumn("band", band)
    small = first.select("sig", F.col("band").alias("key"), F.col("_class").alias("a"), F.col("n").alias("n_a"), F.col("pos").alias("pos_a"))
    reach = F.explode(F.array(F.col("band"), F.col("band") - 1)).alias("key")  # larger sets are looked for in the band below too
    large = first.select("sig", reach, F.col("_class").alias("b"), F.col("n").alias("n_b"), F.col("pos").alias("pos_b"))
    met = small.join(large, ["key", "sig"]).filter((F.col("n_a") < F.col("n_b")) | ((F.col("n_a") == F.col("n_b")) & (F.col("a") < F.col("b"))))
    overlap = F.ceil(t * (F.col("n_a") + F.col("n_b")) / (1 + t) - tiny)
    met = met.filter(F.col("n_a") >= t * F.col("n_b") - tiny).filter(F.least(F.col("n_a") - F.col("pos_a"), F.col("n_b") - F.col("pos_b")) >= overlap)
    pairs = materialize(met.select("a", "b").distinct(), "met")
    for end in ("a", "b"):
        pairs = pairs.join(sets.select(F.col("_class").alias(end), F.col("sigs").alias(f"sigs_{end}")), end)
    common = F.size(F.array_intersect("sigs_a", "sigs_b"))
    links = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), (common / (F.size("sigs_a") + F.size("sigs_b") - common)).alias("likeness"))
    return printed.select(F.col("_id").alias(id_col), F.col("_class").alias("class")), links.filter(F.col("likeness") >= t - tiny)


def _bucket(key: Column, bounds: list) -> Column:
    """How many of the sorted ``bounds`` are at most ``key``, by binary search."""
    if not bounds:
        return F.lit(0)
    table = F.array(*[F.lit(b) for b in bounds])
    steps = F.array(*[F.lit(1 << k) for k in range(len(bounds).bit_length() - 1, -1, -1)])
    return F.aggregate(steps, F.lit(0), lambda n, s: F.when(F.get(table, n + s - 1) <= key, n + s).otherwise(n))


def compare_neighbours(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", distance: int = 1, chain: int = 2, range_bytes: int = 16 << 20
) -> DataFrame:
    """Each document (its id) with n_chars, fingerprint, edited_sha256, edited_fingerprint, near_edited, near_next.

    The edited text has its last half replaced by the start of the next document.
    """
    integral = isinstance(df.schema[id_col].dataType, (T.ByteType, T.ShortType, T.IntegerType, T.LongType))
    key = F.coalesce(F.col(id_col).cast("long"), F.lit(-(1 << 63)).cast("long")) if integral else F.coalesce(F.col(id_col).cast("string"), F.lit(""))
    docs = df.select(key.alias("_id"), F.struct(F.col(id_col).alias("id")).alias("_row"), F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    parts = max(1, -(-text_bytes(df, text_col) // range_bytes))
    share = min(1.0, SAMPLE_IDS / max(1, docs.count()))  # by a hash threshold: about as many ids whatever the table
    some = docs.select("_id").filter(F.pmod(F.xxhash64("_id", F.lit(2)), F.lit(1 << 30)) < int(share * (1 << 30)) + 1)
    sample = sorted(r[0] for r in some.distinct().collect())
    bounds = sorted({sample[len(sample) * k // parts] for k in range(1, parts)}) if sample else []
    docs = docs.withColumn("_bucket", _bucket(F.col("_id"), bounds))
    # The first document of each range is the guard of the non-empty range before it, in a circle.
    least = docs.groupBy("_bucket").agg(F.min("_id").alias("_id"))
    heads = docs.join(F.broadcast(least), ["_bucket", "_id"])  # a row per range, of which there are at most ``parts``
    one = Window.partitionBy("_bucket").orderBy(F.xxhash64("_text"), "_text")
    heads = heads.withColumn("_k", F.row_number().over(one)).filter("_k = 1")
    order = Window.orderBy("_bucket")
    before = least.select("_bucket", F.lag("_bucket").over(order).alias("_before"))
    top = least.agg(F.max("_bucket").alias("_top"))
    before = before.crossJoin(F.broadcast(top)).select("_bucket", F.coalesce("_before", "_top").alias("_to"))  # one row
    guards = heads.join(before, "_bucket").select("_id", "_row", "_text", F.col("_to").alias("_bucket"), F.lit(1).alias("_guard"))
    rows = docs.withColumn("_guard", F.lit(0)).select("_row", "_guard", "_bucket", "_text", "_id")
    rows = rows.unionAll(guards.select("_row", "_guard", "_bucket", "_text", "_id"))
    # a range is a partition
    rows = rows.repartitionById(len(bounds) + 1, "_bucket").sortWithinPartitions("_bucket", "_guard", "_id", F.xxhash64("_text"), "_text")
    kind = docs.schema["_row"].dataType.simpleString()
    out = rows.select("_row", "_guard", "_bucket", "_text").mapInArrow(
        partial(_neighbours, distance=distance, chain=chain),
        f"_row {kind}, _n long, _sha string, _print string, _edited string, _near_e double, _near_n double",
    )
    return out.select(
        F.col("_row.id").alias(id_col), F.col("_n").alias("n_chars"), F.col("_sha").alias("edited_sha256"), F.col("_print").alias("fingerprint"),
        F.col("_edited").alias("edited_fingerprint"), F.col("_near_e").alias("near_edited"), F.col("_near_n").alias("near_next"),
    )
