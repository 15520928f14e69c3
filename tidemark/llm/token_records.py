"""Token-id output as length-delimited binary records.

Documents are range-partitioned and sorted by id; each partition becomes one
file. A record is framed as

    length of the payload   uint64, little-endian
    masked checksum of it   uint32
    payload                 id, token count, token ids
    masked checksum of it   uint32

where a checksum c (CRC-32) is stored as rotate-right(c, 15) + 0xa282ead8, so
that checksums of data that contain checksums stay sound. A payload is a uint32
length and the bytes of the id (8 bytes if integral, UTF-8 else; length 2**32-1:
null), a uint32 token count, and the ids as uint16 (uint32 where the vocabulary
needs it). The offset index (part, id, offset, length) is a separate Parquet
table, for reads in any order. A file is written under a name of its own and
renamed when complete, so a retried task leaves no half file.

Encoding splits a text before white space that follows a visible character,
where no token of a byte-level BPE can span, encodes each distinct piece that a
task meets once and puts the ids together again: the same ids as for whole
texts. Null text is empty and has only the end id. Repeated ids keep an order by
text; repeated rows are all written.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import SPACES, chunks, materialize, shared_dir, span_hash, text_bytes, text_column, word_spans

MASK_DELTA = 0xA282EAD8
NO_ID = (1 << 32) - 1
ENCODE_BYTES = 4 << 20  # texts encoded together
KNOWN_PIECES = 4 << 20  # pieces a task remembers; then it starts anew
PIECE_BYTES = 16 << 10  # joined distinct pieces per call of the tokenizer


# ------------------------------------------------------------------ records
def masked(data: bytes) -> int:
    c = zlib.crc32(data)
    return (((c >> 15) | (c << 17)) + MASK_DELTA) & 0xFFFFFFFF


def frame(payload: bytes) -> bytes:
    head = struct.pack("<Q", len(payload))
    return head + struct.pack("<I", masked(head)) + payload + struct.pack("<I", masked(payload))


def read_frame(read) -> bytes | None:
    """The next payload from ``read(n)``; None at the end; ValueError if damaged."""
    head = read(12)
    if not head:
        return None
    if len(head) < 12 or struct.unpack("<I", head[8:])[0] != masked(head[:8]):
        raise ValueError("damaged record length")
    n = struct.unpack("<Q", head[:8])[0]
    body = read(n + 4)
    if len(body) < n + 4 or struct.unpack("<I", body[n:])[0] != masked(body[:n]):
        raise ValueError("damaged record")
    return body[:n]


def pack(key, ids: np.ndarray) -> bytes:
    if key is None:
        name, size = b"", NO_ID
    else:
        name = struct.pack("<q", key) if isinstance(key, int) else str(key).encode()
        size = len(name)
    return struct.pack("<I", size) + name + struct.pack("<I", len(ids)) + ids.tobytes()


def unpack(payload: bytes, integral: bool, kind: str):
    size = struct.unpack_from("<I", payload)[0]
    at = 4 + (0 if size == NO_ID else size)
    key = None if size == NO_ID else struct.unpack("<q", payload[4:at])[0] if integral else payload[4:at].decode()
    n = struct.unpack_from("<I", payload, at)[0]
    return key, np.frombuffer(payload, dtype=kind, count=n, offset=at + 4)


def _files(folder: str):
    import pyarrow.fs

    folder = "file://" + folder[5:] if folder.startswith("file:/") and not folder.startswith("file://") else folder
    return pyarrow.fs.FileSystem.from_uri(folder)


# ----------------------------------------------------------------- encoding
class Encoder:
    """Token ids of texts, through a tokenizers file; each worker loads its own."""

    def __init__(self, path: str):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        names = self.tok.get_vocab(with_added_tokens=True)
        self.sizes = np.zeros(max(names.values()) + 1, dtype=np.int64)
        for name, i in names.items():
            self.sizes[i] = len(name)  # byte-level: one character a byte
        self.forget()

    def forget(self) -> None:
        """No pieces are known: sorted names, where their ids begin in ``flat`` and how many they are."""
        self.keys, self.offset, self.length = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.flat = np.zeros(0, np.uint32)

    def _find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where each name stands among the known ones, and whether it is one of them."""
        at = np.searchsorted(self.keys, keys)
        known = at < len(self.keys)
        known[known] = self.keys[at[known]] == keys[known]
        return at, known

    def many(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, dtype=np.uint32) for e in self.tok.encode_batch_fast(texts, add_special_tokens=False)]

    def encode(self, buf: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All token ids of the texts in ``buf`` and how many each text has."""
        n_texts = len(bounds) - 1
        starts, ends = word_spans(buf, bounds)
        if not len(starts):
            ids = self.many([bytes(buf[bounds[i] : bounds[i + 1]]).decode() for i in range(n_texts)])
            return np.concatenate([np.zeros(0, np.uint32), *ids]), np.array([len(x) for x in ids], dtype=np.int64)
        # A piece runs from the end of the word before it, or the start of its text, to the end of its word;
        # white space at the end of a text is a piece of its own. No cut follows a wider white-space character.
        cut = ends[~_wide_space(buf, ends)]
        edges = np.sort(np.concatenate((cut, bounds)), kind="stable")
        edges = edges[np.append(True, edges[1:] != edges[:-1])]
        lo, hi = edges[:-1], edges[1:]
        text = np.searchsorted(bounds, lo, "right") - 1
        keys = np.empty(len(lo), dtype=np.uint64)
        i = 0
        while i < len(lo):  # hashed in slices of bounded length
            j = max(i + 1, int(np.searchsorted(hi, lo[i] + (1 << 20), "right")))
            base = lo[i]
            keys[i:j] = span_hash(buf[base : hi[j - 1]].astype(np.uint64) + np.uint64(1), lo[i:j] - base, hi[i:j] - base)
            i = j
        names, first, which = np.unique(keys, return_index=True, return_inverse=True)
        if len(self.keys) + len(names) > KNOWN_PIECES:
            self.forget()
        _, known = self._find(names)
        if not known.all():
            self._learn(buf, names[~known], lo[first[~known]], hi[first[~known]])
        at, _ = self._find(names)
        offset, length, flat = self.offset[at], self.length[at], self.flat
        count = length[which]
        total = np.cumsum(count)
        pick = np.arange(total[-1]) - np.repeat(total - count - offset[which], count)
        per_text = np.bincount(text, weights=count, minlength=n_texts).astype(np.int64)
        return flat[pick], per_text

    def _learn(self, buf: np.ndarray, names: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
        """Encode the pieces buf[a:b] and add them to the known ones."""
        joinable = SPACES[buf[a]] & ~SPACES[buf[b - 1]] & ~_wide_space(buf, b)
        flat: list[np.ndarray] = []
        offset, length, done = np.zeros(len(a), np.int64), np.zeros(len(a), np.int64), len(self.flat)
        alone = np.flatnonzero(~joinable)
        for k, ids in zip(alone, self.many([bytes(buf[a[k] : b[k]]).decode() for k in alone]), strict=True):
            offset[k], length[k] = done, len(ids)
            flat.append(ids)
            done += len(ids)
        together = np.flatnonzero(joinable)
        size = np.cumsum(b[together] - a[together])
        i = 0
        while i < len(together):
            j = max(i + 1, int(np.searchsorted(size, (size[i - 1] if i else 0) + PIECE_BYTES, "right")))
            some = together[i:j]
            n = b[some] - a[some]
            ends = np.cumsum(n)
            where = np.arange(ends[-1]) + np.repeat(a[some] - (ends - n), n)
            (ids,) = self.many([buf[where].tobytes().decode()])
            at = np.searchsorted(np.cumsum(self.sizes[ids]), ends, "left") + 1
            length[some] = np.diff(at, prepend=0)
            offset[some] = done + at - length[some]
            flat.append(ids)
            done += len(ids)
            i = j
        self.flat = np.concatenate([self.flat, *flat])
        where = np.searchsorted(self.keys, names)
        self.keys, self.offset, self.length = (
            np.insert(x, where, y) for x, y in ((self.keys, names), (self.offset, offset), (self.length, length))
        )


def _wide_space(buf: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Whether the character before each end is white space outside ASCII."""
    b1 = buf[ends - 1]
    b2 = buf[np.maximum(ends - 2, 0)]
    b3 = buf[np.maximum(ends - 3, 0)]
    out = (b2 == 0xC2) & ((b1 == 0x85) | (b1 == 0xA0))
    out |= (b3 == 0xE1) & (b2 == 0x9A) & (b1 == 0x80)
    out |= (b3 == 0xE2) & (b2 == 0x80) & ((b1 <= 0x8A) | (b1 == 0xA8) | (b1 == 0xA9) | (b1 == 0xAF))
    out |= (b3 == 0xE2) & (b2 == 0x81) & (b1 == 0x9F)
    return out | (b3 == 0xE3) & (b2 == 0x80) & (b1 == 0x80)


# ---------------------------------------------------------------- task side
def _write(batches, tokenizer: str, folder: str, end_id: int, kind: str):
    part = TaskContext.get().partitionId()
    fs, root = _files(folder)
    own = f"{root}/.part-{part:06d}-{uuid.uuid4().hex}"
    encoder, offset = None, 0
    with fs.open_output_stream(own) as out:
        for batch in batches:
            encoder = encoder or Encoder(tokenizer)
            keys = batch.column(0)
            for i, j, buf, bounds in chunks(text_column(batch, "_text"), ENCODE_BYTES):
                ids, count = encoder.encode(buf, bounds)
                ids = ids.astype(kind)
                last = np.array([end_id], dtype=kind)
                at = np.concatenate(([0], np.cumsum(count)))
                offsets, lengths = [], []
                for k in range(j - i):
                    record = frame(pack(keys[i + k].as_py(), np.concatenate((ids[at[k] : at[k + 1]], last))))
                    out.write(record)
                    offsets.append(offset)
                    lengths.append(len(record))
                    offset += len(record)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part] * (j - i), pa.int32()), keys.slice(i, j - i), pa.array(offsets, pa.int64()), pa.array(lengths, pa.int64())],
                    ["part", "id", "offset", "length"],
                )
    final = f"{root}/part-{part:06d}.rec"
    if fs.get_file_info(final).is_file:  # a lost attempt got this far; its records are the same
        fs.delete_file(final)
    fs.move(own, final)


def _read_parts(batches, folder: str, integral: bool, kind: str, id_type):
    fs, root = _files(folder)
    for batch in batches:
        for part in batch.column(0).to_pylist():
            rows, seen = [], 0
            with fs.open_input_stream(f"{root}/part-{part:06d}.rec", buffer_size=1 << 20) as stream:
                while True:
                    payload = read_frame(stream.read)
                    if payload is not None:
                        key, ids = unpack(payload, integral, kind)
                        rows.append((part, key, seen, len(ids), zlib.crc32(ids.astype("<u4").tobytes())))
                        seen += len(ids)
                    if rows and (payload is None or len(rows) == 5000):
                        cols = list(zip(*rows, strict=True))
                        kinds = [pa.int32(), id_type, pa.int64(), pa.int64(), pa.int64()]
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], ["part", "id", "before", "n_tokens", "ids_crc32"]
                        )
                        rows = []
                    if payload is None:
                        break


def _read_at(batches, folder: str, integral: bool, kind: str, id_type):
    fs, root = _files(folder)
    for batch in batches:
        files: dict = {}
        keys, values = [], []
        for part, offset in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            if part not in files:
                files[part] = fs.open_input_file(f"{root}/part-{part:06d}.rec")
            files[part].seek(offset)
            key, ids = unpack(read_frame(files[part].read), integral, kind)
            keys.append(key)
            values.append(ids.astype(np.int32))
        for f in files.values():
            f.close()
        yield pa.RecordBatch.from_arrays([pa.array(keys, id_type), pa.array(values, pa.list_(pa.int32()))], ["id", "ids"])


# ---------------------------------------------------------------- driver side
class RecordSet:
    """Record files in ``folder`` and their offset index."""

    def __init__(self, index: DataFrame, folder: str, parts: int, integral: bool, kind: str):
        self.index, self.folder, self.parts, self.integral, self.kind = index, folder, parts, integral, kind
        self.id_type = "long" if integral else "string"
        self._args = {"folder": folder, "integral": integral, "kind": kind, "id_type": pa.int64() if integral else pa.string()}

    def read(self) -> DataFrame:
        """One row per record from the files, in no order: part, id, start (tokens of all records before it), n_tokens, ids_crc32."""
        spark = self.index.sparkSession
        parts = spark.range(0, self.parts, 1, max(1, self.parts)).select(F.col("id").cast("int").alias("part"))
        rows = parts.mapInArrow(
            partial(_read_parts, **self._args), f"part int, id {self.id_type}, before long, n_tokens long, ids_crc32 long"
        )
        rows = materialize(rows, "read-back")
        sums = rows.groupBy("part").agg(F.sum("n_tokens").alias("n"))
        base = sums.select("part", F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("base"))
        return rows.join(base, "part").select("part", "id", (F.col("base") + F.col("before")).alias("start"), "n_tokens", "ids_crc32")

    def read_shuffled(self, seed: int = 0) -> DataFrame:
        """(id, ids) of all records, read through the offset index in a seeded order."""
        order = F.xxhash64(F.lit(seed), F.col("part"), F.col("offset"))
        rows = self.index.select("part", "offset", order.alias("o")).repartition(max(1, self.parts), "o").sortWithinPartitions("o")
        return rows.select("part", "offset").mapInArrow(partial(_read_at, **self._args), f"id {self.id_type}, ids array<int>")


def write_records(
    df: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = 2, file_bytes: int = 48 << 20
) -> RecordSet:
    """Encode every whole text of ``df``, append ``end_id`` and write the records in ascending order of the id.

    ``tokenizer`` is the path of a byte-level BPE file that every executor can
    read; its vocabulary decides how wide ids are stored. A file holds about
    ``file_bytes`` of text.
    """
    from tokenizers import Tokenizer

    spark = df.sparkSession
    folder = f"{shared_dir(spark)}/records"
    fs, root = _files(folder)
    fs.create_dir(root, recursive=True)
    top = max(end_id, *Tokenizer.from_file(tokenizer).get_vocab(with_added_tokens=True).values())
    kind = "<u2" if top < 1 << 16 else "<u4"
    integral = isinstance(df.schema[id_col].dataType, (T.ByteType, T.ShortType, T.IntegerType, T.LongType))
    key = F.col(id_col).cast("long" if integral else "string").alias("_id")
    parts = max(1, -(-text_bytes(df, text_col) // file_bytes))
    docs = df.select(key, F.col(text_col).alias("_text"))
    docs = docs.repartitionByRange(parts, F.col("_id").asc_nulls_first(), F.hash("_text"))
    docs = docs.sortWithinPartitions(F.col("_id").asc_nulls_first(), F.hash("_text"), "_text")
    id_type = "long" if integral else "string"
    index = docs.mapInArrow(
        partial(_write, tokenizer=tokenizer, folder=folder, end_id=end_id, kind=kind), f"part int, id {id_type}, offset long, length long"
    )
    index = materialize(index, "offsets")
    return RecordSet(index, folder, _part_count(fs, root), integral, kind)


def _part_count(fs, root: str) -> int:
    import pyarrow.fs

    return sum(f.base_name.startswith("part-") for f in fs.get_file_info(pyarrow.fs.FileSelector(root)))
