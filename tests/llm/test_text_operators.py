"""Substring dedup, language model, Jaccard join and spot signatures against plain Python."""

from __future__ import annotations

import hashlib
import math
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.helpers import SF, awkward, frame, low, prose
from tidemark.llm import queries as Q
from tidemark.llm.jaccard import RTree, cluster_documents, components, keep_one
from tidemark.llm.lm import score_texts
from tidemark.llm.spotsigs import add_fingerprints, compare_neighbours, from_text, likeness, match_documents
from tidemark.llm.substring_dedup import dedup_substrings


# ------------------------------------------------------------- substring dedup
def brute_dedup(texts, window):
    words = [(t or "").encode().split() for t in texts]
    seen = Counter(tuple(w[i : i + window]) for w in words for i in range(len(w) - window + 1))
    out = []
    for w in words:
        gone = set()
        for i in range(len(w) - window + 1):
            if seen[tuple(w[i : i + window])] > 1:
                gone.update(range(i, i + window))
        out.append((len(w), len(gone), b" ".join(x for i, x in enumerate(w) if i not in gone).decode()))
    return out


@pytest.mark.parametrize("window", [35, 4])
def test_substring_dedup_equals_brute_force(spark, window):
    texts = awkward()
    got = {r["doc_id"]: r for r in dedup_substrings(frame(spark, texts), window=window).collect()}
    for i, want in enumerate(brute_dedup(texts, window)):
        assert (got[i]["n_words"], got[i]["n_removed"], got[i]["text"]) == want, i
        assert sum(s["end"] - s["start"] for s in got[i]["removed_spans"]) == want[1]


def test_substring_dedup_repeated_ids_nulls_and_clashing_columns(spark):
    a, b = prose(11, 50), prose(12, 50)
    df = frame(spark, [a, a, b, prose(13, 10)], [1, 1, 1, None]).withColumn("n_removed", F.lit("old")).withColumn("_id", F.lit(5))
    got = sorted((r["n_words"], r["n_removed"]) for r in dedup_substrings(df).collect())
    assert got == [(10, 0), (50, 0), (50, 50), (50, 50)]
    assert dedup_substrings(df).columns == ["doc_id", "lang", "source", "n_chars", "_id", "text", "n_words", "n_removed", "removed_spans"]
    assert dedup_substrings(df.limit(0)).count() == 0


def test_op1_on_the_small_tables(spark):
    docs = Q.table(spark, SF, "documents").select("doc_id", "text").collect()
    want = {d["doc_id"]: (n, g, hashlib.sha256(k.encode()).hexdigest()) for d, (n, g, k) in zip(docs, brute_dedup([d["text"] for d in docs], 35), strict=True)}
    got = {r["doc_id"]: tuple(r)[1:] for r in Q.op1_substring_dedup(spark, SF).collect()}
    assert got == want


# -------------------------------------------------------------- language model
def brute_lm(rows, order, m):
    """rows: (train, text); returns (n, known, N, base, score) per row by dictionaries of n-grams."""
    tokens = [[*low(t).split(), None] for _, t in rows]
    counts = [Counter() for _ in range(order + 1)]
    history = Counter()
    for (train, _), ts in zip(rows, tokens, strict=True):
        if train:
            padded = [("s", k) for k in range(order - 1)] + ts
            for i in range(len(ts)):
                for k in range(1, order + 1):
                    gram = tuple(padded[i + order - k : i + order])
                    counts[k][gram] += 1
                    history[gram[:-1]] += 1
    total, types = sum(counts[1].values()), len(counts[1])
    out = []
    for ts in tokens:
        base = score = 0.0
        padded = [("s", k) for k in range(order - 1)] + ts
        for i, w in enumerate(ts):
            p = (counts[1][(w,)] + 0.5) / (total + 0.5 * (types + 1))
            base += math.log10(p)
            for k in range(2, order + 1):
                gram = tuple(padded[i + order - k : i + order])
                p = (counts[k][gram] + m * p) / (history[gram[:-1]] + m)
            score += math.log10(p)
        out.append((len(ts), sum(counts[1][(w,)] > 0 for w in ts), total, base, score))
    return out


@pytest.mark.parametrize("order", [1, 2, 3])
def test_lm_equals_dictionaries(spark, order):
    texts = awkward()
    df = frame(spark, texts).withColumn("held", F.col("doc_id") % 4 == 1)
    got = {r["doc_id"]: r for r in score_texts(df, "NOT held", order=order, strength=7.0, block_bytes=4000).collect()}
    for i, want in enumerate(brute_lm([(i % 4 != 1, t) for i, t in enumerate(texts)], order, 7.0)):
        r = got[i]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == want[:3]
        assert (r["base_score"], r["score"]) == pytest.approx(want[3:], rel=1e-9)


def test_lm_probabilities_sum_to_one(spark):
    words = ["a", "b", "c", "never"]
    train = ["a b a c", "b b a"]
    df = frame(spark, train + [f"a {w}" for w in words] + ["a"], list(range(7)))
    rows = {r["doc_id"]: r["score"] for r in score_texts(df, "doc_id < 2", order=2).collect()}
    prefix = brute_lm([(True, t) for t in train] + [(False, "a")], 2, 50.0)[2]
    ends = brute_lm([(True, t) for t in train] + [(False, f"a {w}") for w in words], 2, 50.0)[2:]
    assert rows[6] == pytest.approx(prefix[4]) and [rows[k + 2] for k in range(4)] == pytest.approx([e[4] for e in ends])


def test_lm_without_training_rows_and_empty(spark):
    df = frame(spark, ["a b", None])
    assert [r["train_tokens"] for r in score_texts(df, "false").collect()] == [0, 0]
    assert score_texts(df.limit(0)).count() == 0


def test_op3_held_out_beats_the_base(spark):
    rows = Q.op3_lm_scoring(spark, SF).collect()
    assert len(rows) == Q.table(spark, SF, "documents").count()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 1) for r in rows)
    held = [r for r in rows if r["held_out"]]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)


# ---------------------------------------------------------------- Jaccard join
def brute_sets(texts, width=5):
    out = []
    for t in texts:
        w = low(t).split()
        out.append({tuple(w[i : i + width]) for i in range(len(w) - width + 1)} if len(w) >= width else ({tuple(w)} if w else set()))
    return out


def brute_components(texts, percent=75):
    sets = brute_sets(texts)
    parent = list(range(len(texts)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                x, y = find(i), find(j)
                parent[max(x, y)] = min(x, y)
    return [(len(s), find(i)) for i, s in enumerate(sets)]


def edited(words, seed, edits):
    rng = np.random.default_rng(seed)
    out = list(words)
    for k in rng.choice(len(out), edits, replace=False):
        out[k] = f"e{seed}_{k}"
    return " ".join(out)


def test_jaccard_equals_brute_force(spark):
    base = prose(21, 150, 3000).split()
    # near copies on both sides of the threshold, so that groups hang together by chains only
    texts = awkward() + [edited(base, s, s % 6) for s in range(24)] + [" ".join(base[: 100 + s]) for s in range(0, 50, 7)]
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in cluster_documents(frame(spark, texts)).collect()}
    assert got == dict(enumerate(brute_components(texts)))


def test_jaccard_links_at_exactly_three_quarters(spark):
    a = [f"s{i}" for i in range(11)]  # 7 shingles
    texts = [" ".join(a), " ".join(a[:10]), " ".join([*a[:9], "x", "y", "z"])]  # 6 of 7; 5 of 10
    assert [c for _, c in brute_components(texts)] == [0, 0, 2]
    edge = [f"t{i}" for i in range(8)]  # 4 shingles; its first 7 words have 3 of them
    texts += [" ".join(edge), " ".join(edge[:7])]
    got = {r["doc_id"]: r["component_id"] for r in cluster_documents(frame(spark, texts)).collect()}
    assert got == {0: 0, 1: 0, 2: 2, 3: 3, 4: 3}


def test_jaccard_hot_cells_are_split_and_whole(spark, monkeypatch):
    import tidemark.llm.jaccard as J

    monkeypatch.setattr(J, "CELL", 8)
    base = prose(31, 100, 3000).split()
    texts = [edited(base, s, 3) for s in range(40)] + [prose(900 + s, 100, 3000) for s in range(5)]
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in cluster_documents(frame(spark, texts)).collect()}
    assert got == dict(enumerate(brute_components(texts)))


def test_rtree_never_loses_a_point():
    rng = np.random.default_rng(5)
    base = rng.poisson(3, (40, 64))
    points = np.maximum(0, np.repeat(base, 5, axis=0) + (rng.random((200, 64)) < 0.05))
    sizes = points.sum(1)
    tree = RTree(points, sizes)
    for q in range(0, 200, 7):
        bound = np.minimum(points, points[q]).sum(1)
        want = np.flatnonzero(175 * bound >= 75 * (sizes + sizes[q]))
        assert set(want) <= set(tree.search(q, 75))


def test_components_of_a_long_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(1, 60)] + [(100, 101)], "a long, b long")
    assert {r["v"]: r["c"] for r in components(links).collect()} == {**{i: 1 for i in range(1, 61)}, 100: 100, 101: 100}


def test_keep_one_of_each_group(spark):
    texts = awkward()
    ids = list(range(len(texts)))
    df = frame(spark, [*texts, texts[11], texts[16], "", None], [*ids, 11, None, None, 1])
    kept = [(r["doc_id"], r["text"]) for r in keep_one(df).collect()]
    want = [(i, t) for i, (t, (n, c)) in enumerate(zip(texts, brute_components(texts), strict=True)) if not n or c == i]
    assert sorted(map(str, kept)) == sorted(map(str, [*want, (None, ""), (1, None)]))
    assert keep_one(df.limit(0)).count() == 0


def test_jaccard_text_ids(spark):
    df = frame(spark, ["a b c d e f", "a b c d e f", "q r s", None]).withColumn("doc_id", F.concat(F.lit("k"), F.col("doc_id")))
    got = {r["doc_id"]: r["component_id"] for r in cluster_documents(df).collect()}
    assert got == {"k0": "k0", "k1": "k0", "k2": "k2", "k3": "k3"}


@pytest.mark.parametrize("ids", [[(1 << 62) + 5, (1 << 62) + 9, 7 * 10**18, 3], [-(1 << 63), (1 << 63) - 1, -5, 8]])
def test_jaccard_ids_of_any_size(spark, ids):
    """With rows without an id beside them, whose vertices must be none of the ids."""
    texts = ["a b c d e f g", "a b c d e f g", "q r s t u v w", "q r s t u v w", "a b c d e f g", "lone words without a mate here", "lone words without a mate here"]
    df = frame(spark, texts, [*ids, None, None, None])
    got = sorted(((r["doc_id"], r["component_id"]) for r in cluster_documents(df).collect()), key=str)
    a, q = min(ids[:2]), min(ids[2:])
    assert got == sorted([(ids[0], a), (ids[1], a), (None, a), (ids[2], q), (ids[3], q), (None, None), (None, None)], key=str)
    assert sorted(r["text"][0] for r in keep_one(df).collect()) == ["a", "l", "q"]


def test_jaccard_an_id_with_two_texts_joins_their_groups(spark):
    df = frame(spark, ["a b c d e f g", "q r s t u v w", "a b c d e f g", "q r s t u v w"], [9, 9, 4, 6])
    assert {(r["doc_id"], r["component_id"]) for r in cluster_documents(df).collect()} == {(9, 4), (4, 4), (6, 4)}


def test_jaccard_very_long_texts_at_the_threshold(spark):
    """200,000 words: prefixes of 50,000 shingles, whose short names clash; 75 of 100 shared, and one less."""
    words = [f"w{i}" for i in range(200_004)]  # 200,000 shingles
    texts = [" ".join(words), " ".join(words[:150_004]), " ".join(words[:150_003]), " ".join(words[100_000:])]
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in cluster_documents(frame(spark, texts)).collect()}
    assert got == {0: (200_000, 0), 1: (150_000, 0), 2: (149_999, 0), 3: (100_000, 3)}
    apart = {r["doc_id"]: r["component_id"] for r in cluster_documents(frame(spark, [texts[0], texts[2]])).collect()}
    assert apart == {0: 0, 1: 1}


def test_keep_one_with_columns_of_the_operators_own_names(spark):
    df = frame(spark, ["a b c d e f", "a b c d e f", "x y"])
    for name in ("_v", "_th", "_row", "c", "n", "rep", "a"):
        df = df.withColumn(name, F.lit(f"my {name}"))
    out = keep_one(df)
    assert out.columns == df.columns
    assert sorted((r["doc_id"], r["_v"], r["_th"], r["c"]) for r in out.collect()) == [(0, "my _v", "my _th", "my c"), (2, "my _v", "my _th", "my c")]


def test_pairs_of_near_copies_that_are_no_links_meet_seldom(spark, monkeypatch):
    """600 copies of one text with edits each, most pairs of them below the threshold: pass 2 stays far from all pairs in all cells."""
    import tidemark.llm.jaccard as J

    seen = []
    base = prose(41, 150, 3000).split()
    texts = [edited(base, s, 2 + s % 8) for s in range(600)]
    real = J._verified

    def verified(pairs, *args):
        if args[-1] == "across":  # after the nearest of each
            pairs = J.materialize(pairs, "counted")
            seen.append(pairs.count())
        return real(pairs, *args)

    monkeypatch.setattr(J, "_verified", verified)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in cluster_documents(frame(spark, texts)).collect()}
    assert got == dict(enumerate(brute_components(texts)))
    assert len({c for _, c in got.values()}) > 100 and seen[0] < 600 * 599 / 2 / 10


def test_shingles_that_meet_by_chance_make_no_cells_in_a_large_corpus(spark, monkeypatch):
    """The sample behind the order of shingles grows with the corpus: with 2 documents alone nothing would be seen often."""
    import tidemark.llm.jaccard as J

    rows = {}
    rng = np.random.default_rng(5)
    common = [" ".join(f"c{k}_{i}" for i in range(5)) for k in range(30)]  # each in about 100 of 300 documents
    texts = [" ".join(w for k in range(60) for w in (common[k // 2] if k % 2 and rng.random() < 1 / 3 else f"u{s}_{k}",)) for s in range(300)]
    real = J.materialize

    def materialize(df, name):
        out = real(df, name)
        rows[name] = out.count() if name == "cells" else rows.get(name)
        return out

    monkeypatch.setattr(J, "materialize", materialize)
    monkeypatch.setattr(J, "SAMPLE_DOCS", 2)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in cluster_documents(frame(spark, texts)).collect()}
    assert got == dict(enumerate(brute_components(texts)))
    assert rows["cells"] < 300, rows["cells"]


def test_prefixes_are_compared_as_sets_that_may_clash():
    """Against one pair after another: repeated names within a prefix are clashes, and lower what must be shared."""
    import pyarrow as pa

    from tidemark.llm.jaccard import _by_prefixes

    rng = np.random.default_rng(8)
    a, b = ([rng.integers(0, 12, rng.integers(0, 9)).tolist() for _ in range(500)] for _ in "ab")
    least = rng.integers(0, 6, 500)
    kind = pa.list_(pa.int64())
    batch = pa.RecordBatch.from_arrays([pa.array(range(500)), pa.array(range(500)), pa.array(least), pa.array(a, kind), pa.array(b, kind)], ["a", "b", "least", "prefix_a", "prefix_b"])
    want = [i for i in range(500) if least[i] <= 1 or len({*a[i]} & {*b[i]}) >= least[i] - min(len(a[i]) - len({*a[i]}), len(b[i]) - len({*b[i]}))]
    assert [i for out in _by_prefixes([batch], step=64) for i in out.column(0).to_pylist()] == want and 0 < len(want) < 500


def test_op4_on_the_small_tables(spark):
    docs = Q.table(spark, SF, "documents").select("doc_id", "text").orderBy("doc_id").collect()
    ids = [d["doc_id"] for d in docs]
    want = {ids[i]: (n, ids[c]) for i, (n, c) in enumerate(brute_components([d["text"] for d in docs]))}
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in Q.op4_jaccard_join(spark, SF).collect()} == want


# ------------------------------------------------------------- spot signatures
def brute_edited(texts):
    out = []
    for i, t in enumerate(texts):
        t, nxt = t or "", texts[(i + 1) % len(texts)] or ""
        half = len(t) // 2
        out.append((len(t), hashlib.sha256((t[: len(t) - half] + nxt[:half]).encode()).hexdigest()))
    return out


@pytest.mark.parametrize("range_bytes", [1 << 24, 3000])
def test_spotsigs_neighbours(spark, range_bytes):
    texts = [prose(i, 40 + i) + " the end of it" for i in range(30)] + awkward()
    df = frame(spark, texts).repartition(5)
    got = {r["doc_id"]: r for r in compare_neighbours(df, range_bytes=range_bytes).collect()}
    alone = {r["doc_id"]: r["fingerprint"] for r in add_fingerprints(df).collect()}
    for i, want in enumerate(brute_edited(texts)):
        r = got[i]
        assert (r["n_chars"], r["edited_sha256"]) == want
        assert r["fingerprint"] == alone[i]
        a, e, n = (set(from_text(x)) for x in (r["fingerprint"], r["edited_fingerprint"], alone[(i + 1) % len(texts)]))
        for near, other in ((r["near_edited"], e), (r["near_next"], n)):
            assert near == pytest.approx(len(a & other) / len(a | other) if a | other else 1.0)


def test_spotsigs_equal_texts_and_edges(spark):
    df = frame(spark, ["", None, "!!", "the", "the of and", "only content words here", "only content words here"], [5, 4, None, 3, 3, 2, 1])
    rows = add_fingerprints(df.withColumn("fingerprint", F.lit(1))).collect()
    by = {}
    for r in rows:
        by.setdefault(r["text"] or "", set()).add(r["fingerprint"])
    assert all(len(v) == 1 for v in by.values()) and by[""] == {""} and all(v != {""} for k, v in by.items() if k)
    assert compare_neighbours(df).count() == 7 and compare_neighbours(df.limit(0)).count() == 0
    one = compare_neighbours(frame(spark, ["the one text"])).first()
    assert one["near_next"] == 1.0


@pytest.mark.parametrize("at_least", [0.75, 0.4, 1.0])
def test_spotsigs_matches_equal_brute_force(spark, at_least):
    """Every pair of different fingerprints of at least that likeness, and no other: recall and precision 1."""
    rng = np.random.default_rng(8)
    words = [f"c{i}" for i in range(400)]
    filler = ["the", "of", "and", "a", "in"]
    texts = awkward()
    for g in range(6):
        base = [str(rng.choice(filler if rng.random() < 0.5 else words)) for _ in range(60 + 40 * g)]
        for s in range(8):
            out = list(base)
            for k in rng.choice(len(out), s * (1 + g) // 2, replace=False):
                out[k] = str(rng.choice(words))
            texts.append(" ".join(out[: len(out) - 3 * (s % 3)]))
    df = frame(spark, texts + texts[-3:], [*range(len(texts)), 1, None, None]).withColumn("class", F.lit("old"))
    classes, links = match_documents(df, at_least=at_least)
    prints = {r["text"] or "": set(from_text(r["fingerprint"])) for r in add_fingerprints(df).collect()}
    of = {hashlib.md5(r["fingerprint"].encode()).hexdigest(): set(from_text(r["fingerprint"])) for r in add_fingerprints(df).collect()}
    assert classes.count() == len(texts) + 3 and {r["class"] for r in classes.collect()} == set(of) and len(prints) > 40
    names = sorted(k for k, v in of.items() if v)
    want = {}
    for i, a in enumerate(names):
        for b in names[i + 1 :]:
            j = len(of[a] & of[b]) / len(of[a] | of[b])
            if j >= at_least:
                want[(a, b)] = pytest.approx(j)
    assert {(r["a"], r["b"]): r["likeness"] for r in links.collect()} == want
    assert len(want) > 10 or at_least == 1.0
    empty = match_documents(df.limit(0), at_least=at_least)
    assert empty[0].count() == 0 and empty[1].count() == 0


def test_likeness_is_pruned_by_length():
    a, b = np.arange(3, dtype=np.uint32), np.arange(9, dtype=np.uint32)
    assert likeness(a, b) == pytest.approx(1 / 3) and likeness(a, b, at_least=0.5) == 0.0
