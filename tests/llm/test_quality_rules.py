"""Quality rules against plain Python: counts, compression bands, edge cases."""

from __future__ import annotations

import random
import re
from collections import Counter

import pytest
import zstandard
from pyspark.sql import functions as F

from tests.llm.helpers import SF, awkward, frame, prose
from tidemark.llm import queries as Q
from tidemark.llm import quality_rules as R

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept) of one text."""
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    windows = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    again = {i + k for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for k in range(3)}
    base = len(words) < 50 or 100 * len(again) > 50 * len(words)
    data, ok = text.encode(), True
    if data:
        size = lambda b: len(zstandard.ZstdCompressor(level=3).compress(b))
        least, most = next((a, b) for top, a, b in R.BANDS if top is None or len(data) <= top)
        ok = least <= len(data) / size(data) <= most
        cuts = list(range(0, len(data), 4096))
        if len(cuts) > 1 and len(data) - cuts[-1] < 1024:
            cuts.pop()
        pieces = [data[a:b] for a, b in zip(cuts, [*cuts[1:], len(data)], strict=True)]
        if len(pieces) > 1:
            ok &= sum(len(p) for p in pieces if not 1.2 <= len(p) / size(p) <= 4.0) <= 0.25 * len(data)
    symbols = sum(text.count(c) for c in "#*$%&|<>")
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(again), base, not base and ok


def rows(df):
    return {r["doc_id"]: tuple(r)[1:] for r in df.select("doc_id", *[f.name for f in R.RESULTS[:5]], "base_failed", "kept").collect()}


def odd_texts():
    rng = random.Random(5)
    noise = " ".join("".join(chr(rng.randrange(33, 126)) for _ in range(9)) for _ in range(400))
    keys = "".join(chr(rng.randrange(0x4E00, 0x9FA0)) + (" " if k % 5 == 0 else "") for k in range(6000))
    loop = "the same line again and again\n" * 400
    return [
        *awkward(), noise, keys, prose(8, 900) + "\n" + loop, loop, "a b\na b\n a b\na b\r\n\n \n\na b", "x\n", "\n\n", "#*$%&|<> é# " * 9,
        prose(9, 49), prose(9, 50), prose(10, 200_000, 30_000), "\n".join(prose(k, 12) for k in range(80)), "é a b é a b é" + prose(3, 60), "\x00 \x1c\x85 　 " * 30,
    ]


def test_rules_equal_brute_force(spark):
    texts = odd_texts()
    got = rows(R.apply_rules(frame(spark, texts)))
    for i, text in enumerate(texts):
        assert got[i] == brute(text), (i, (text or "")[:60])


def test_every_band_rejects_both_ways(spark):
    rng = random.Random(1)
    prose_of = lambda n: prose(n, n // 4, 3000)[:n]
    random_of = lambda n: " ".join("".join(rng.choice("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/%&é東") for _ in range(40)) for _ in range(n // 41))
    loop_of = lambda n: ("word%d and " % n * n)[:n]
    sizes = [800, 3000, 12_000, 90_000, 400_000]
    df = frame(spark, [f(n) for n in sizes for f in (prose_of, random_of, loop_of)])
    out = R.apply_rules(df, min_words=0, max_repeat_percent=100, bands=[(t, 1.5, m) for t, _, m in R.BANDS], chunk_band=(0, 1e9))
    got = [r["reason"] for r in out.orderBy("doc_id").collect()]
    assert got == [None, "incompressible", "repetitive"] * len(sizes)


def test_a_long_text_with_a_repetitive_stretch_fails_by_its_chunks(spark):
    text = prose(1, 30_000, 9000) + " " + "again the same line " * 6000
    r = R.apply_rules(frame(spark, [text]), max_repeat_percent=100, bands=[(None, 0, 1e9)]).first()
    assert r["reason"] == "chunks" and 0.25 < r["bad_chunk_share"] < 1


def test_clashing_columns_repeated_rows_nulls_and_empty_table(spark):
    texts = [None, "", prose(1, 80), prose(1, 80)]
    df = frame(spark, texts, [None, 1, 1, 1]).withColumn("kept", F.lit("old")).withColumn("N_Words", F.lit("old")).withColumn("_c0", F.lit("mine"))
    out = R.apply_rules(df)
    assert out.columns[:6] == ["doc_id", "text", "lang", "source", "n_chars", "_c0"] and out.columns.count("kept") == 1
    got = out.collect()
    assert sorted((r["doc_id"] or 0, r["n_words"], r["kept"], r["_c0"]) for r in got) == [(0, 0, False, "mine"), (1, 0, False, "mine"), (1, 80, True, "mine"), (1, 80, True, "mine")]
    assert [r["text"] for r in got] == texts
    assert R.apply_rules(df.limit(0)).count() == 0
    assert R.apply_rules(df, columns=["doc_id"]).columns[0:2] == ["doc_id", "n_words"]


def test_op13_on_the_small_tables(spark):
    docs = Q.table(spark, SF, "documents").select("doc_id", "text").collect()
    got = rows(Q.op13_quality_rules(spark, SF))
    assert got == {d["doc_id"]: brute(d["text"]) for d in docs}


def test_op13_keeps_good_documents(spark):
    sf = SF.replace("0.001", "0.01")
    good = Q.table(spark, sf, "labels").filter("quality = 1").select("doc_id")
    r = Q.op13_quality_rules(spark, sf).filter("NOT base_failed").join(good, "doc_id").agg(F.count("*").alias("n"), F.sum(F.col("kept").cast("int")).alias("k")).first()
    assert r["n"] > 100 and r["k"] == pytest.approx(r["n"], abs=0)
