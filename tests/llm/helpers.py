"""Small awkward inputs and plain-Python helpers for the operators' tests."""

from __future__ import annotations

import random

from pyspark.sql import types as T

SF = "/root/testdata/sf0.001"
SPACE_WORDS = rb"[^\x20\x09-\x0D]+"

DOCS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
    ]
)


def frame(spark, texts, ids=None):
    """documents-like rows; texts may hold None."""
    ids = list(range(len(texts))) if ids is None else ids
    rows = [(i, t, ("en", "de", None)[k % 3], ("a", "a", "b", None)[k % 4], None if t is None else len(t)) for k, (i, t) in enumerate(zip(ids, texts, strict=True))]
    return spark.createDataFrame(rows, DOCS)


def prose(seed: int, n: int, vocab: int = 400) -> str:
    rng = random.Random(seed)
    return " ".join(f"w{int(rng.random() ** 2 * vocab)}" for _ in range(n))


def awkward() -> list:
    """Nulls, empties, white space, one word, runs, periods, repeats, copies, near copies, a long text."""
    shared = prose(1, 60)
    base = prose(2, 120).split()
    near = base[:50] + ["changed"] + base[51:]
    return [
        None,
        "",
        " \t\n ",
        "word",
        "The the THE",
        "a " * 90,
        "x y z " * 40,
        shared,
        shared,
        prose(3, 30) + " " + shared + " " + prose(4, 30),
        prose(5, 20) + "\n" + shared,
        " ".join(base),
        " ".join(near),
        "  ".join(base),
        "été über   naïve 東京 😀 " * 12,
        prose(6, 6000, 5000),
        prose(7, 200),
    ]


def low(text) -> bytes:
    """UTF-8 with A-Z lower-cased, nothing else."""
    return (text or "").encode().lower()  # bytes.lower changes ASCII letters only
