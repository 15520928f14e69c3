"""Importance resampling: keys and table against libraries, the operator against plain Python, SQL by DuckDB."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tests.llm.helpers import SF, awkward, frame, low, prose
from tidemark.llm import importance as I
from tidemark.llm import queries as Q
from tidemark.llm.oracle import ORACLE

WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def grams_of(text, max_n):
    words = WORD.findall(low(text))
    return words, [b" ".join(words[i : i + n]) for n in range(1, max_n + 1) for i in range(len(words) - n + 1)]


def brute(rows, target, percent=10, max_n=1, buckets=10_000, min_words=20):
    """{id: (n_words, n_features, weight, score, rank)} for rows of (id, text)."""
    feats = {i: grams_of(t, max_n) for i, t in rows}
    bucket = lambda g: zlib.crc32(g) % buckets
    s = Counter(bucket(g) for _, gs in feats.values() for g in gs)
    t = Counter(bucket(g) for x in target for g in grams_of(x, max_n)[1])
    ns, nt = sum(s.values()), sum(t.values())
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (ns + buckets) / ((s[b] + 1) * (nt + buckets))))
    out = {}
    for i, (words, gs) in feats.items():
        weight = sum(gain(bucket(g)) for g in gs) // len(gs) if gs else 0
        h = int(hashlib.sha256(f"2024:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out[i] = [len(words), len(gs), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None]
    able = sorted((i for i, r in out.items() if r[0] >= min_words), key=lambda i: (-out[i][3], i))
    for k, i in enumerate(able[: percent * len(able) // 100], 1):
        out[i][4] = k
    return {i: tuple(r) for i, r in out.items()}


def result(df):
    return {r["doc_id"]: tuple(r)[1:] for r in df.select("doc_id", "n_words", "n_features", "weight", "score", "rank").collect()}


def spans_of(parts):
    ends = np.cumsum([len(p) for p in parts])
    return I.Spans(np.frombuffer(b"".join(parts), np.uint8), ends - np.array([len(p) for p in parts]), ends)


def test_keys_are_xxhash64():
    rng = random.Random(3)
    parts = [rng.randbytes(n) for n in [*range(80), 1000]] + [b"\x00" * n for n in range(40)]
    got = spans_of(parts).keys(0, len(parts))
    assert [int(x) for x in got] == [xxhash.xxh64_intdigest(p) for p in parts]


@pytest.mark.parametrize("bits", [64, 3, 0])
def test_table_keeps_spans_apart_whatever_their_keys(bits):
    """With cut keys nearly all spans share a key: only their bytes tell them apart."""
    rng = random.Random(4)
    words = [rng.randbytes(rng.randrange(1, 40)) for _ in range(300 if bits < 64 else 60_000)] + [b"\x00" * n for n in range(1, 20)]
    parts = [rng.choice(words) for _ in range(3000 if bits < 64 else 200_000)]
    spans = spans_of(parts)
    mask = np.uint64((1 << bits) - 1)
    table = I.Table(spans, 97, lambda lo, hi: spans.keys(lo, hi) & mask)
    assert table.size == len(set(parts))
    assert [spans.data(table.first[e]) for e in table.entry[:2000]] == parts[:2000]
    assert Counter(parts) == {spans.data(f): c for f, c in zip(table.first[: table.size], table.count, strict=True)}
    assert all(zlib.crc32(spans.data(f)) % 97 == b for f, b in zip(table.first[:500], table.bucket, strict=False))


@pytest.mark.parametrize("max_n", [1, 3])
def test_resampling_equals_brute_force(spark, max_n):
    texts = [*awkward(), "x" * 40 + " " + "y" * 33, *[prose(k, 20 + k) for k in range(60)], prose(70, 100_000, 50_000)]
    target = [prose(90, 50, 40), None, "", "The the 東京"]
    got = result(I.resample(frame(spark, texts), frame(spark, target), percent=30, max_n=max_n))
    assert got == brute(list(enumerate(texts)), target, 30, max_n)


def test_ties_nulls_repeated_rows_and_clashing_columns(spark):
    texts = [prose(1, 30)] * 5 + [None, "few words", prose(2, 30)]
    ids = [4, 4, 4, 2, None, None, 7, 9]
    df = frame(spark, texts, ids).withColumn("rank", F.lit("old")).withColumn("_score", F.lit(1)).withColumn("Weight", F.lit(2))
    out = I.resample(df, frame(spark, [prose(3, 30)]), percent=100)
    assert out.columns == ["doc_id", "text", "lang", "source", "n_chars", "_score", "n_words", "n_features", "weight", "score", "rank"]
    rows = out.collect()
    assert sorted(r["rank"] for r in rows if r["rank"]) == list(range(1, 7))
    assert len({r["score"] for r in rows if r["doc_id"] == 4}) == 1 and sum(r["rank"] is None for r in rows) == 2
    order = [r["score"] for r in sorted((r for r in rows if r["rank"]), key=lambda r: r["rank"])]
    assert order == sorted(order, reverse=True)


def test_empty_tables(spark):
    df = frame(spark, [prose(1, 30), prose(2, 30)])
    assert I.resample(df.limit(0), df).count() == 0
    assert I.resample(df, df.limit(0), percent=50).filter("rank = 1").count() == 1
    assert I.resample(df, df, percent=0).filter("rank IS NOT NULL").count() == 0


def test_equal_scores_go_to_the_smaller_id(spark):
    rows = spark.range(1000).selectExpr("id AS doc_id", "id % 3 AS score", "id % 10 <> 0 AS able")
    got = {r["doc_id"]: r["rank"] for r in I.rank_highest(rows, "able", 40, "doc_id").filter("rank IS NOT NULL").collect()}
    able = sorted((i for i in range(1000) if i % 10), key=lambda i: (-(i % 3), i))
    assert got == {i: k for k, i in enumerate(able[: 900 * 40 // 100], 1)}


def test_op11_equals_brute_force_and_sql(spark):
    docs = [(r["doc_id"], r["text"]) for r in Q.table(spark, SF, "documents").select("doc_id", "text").collect()]
    target = [r["text"] for r in Q.table(spark, SF, "benchmark").collect()]
    out = Q.op11_importance_resampling(spark, SF)
    got = {r["doc_id"]: tuple(r)[1:] for r in out.collect()}
    assert got == {i: r[1:] for i, r in brute(docs, target).items()}
    con = duckdb.connect()
    for name in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    sql = con.execute(ORACLE["op11_importance_resampling"])
    assert [d[0] for d in sql.description] == out.columns
    assert {r[0]: tuple(r[1:]) for r in sql.fetchall()} == got
