"""Quality, sharding, decontamination, token records, line dedup, mixing and the pipeline against plain Python."""

from __future__ import annotations

import hashlib
import io
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm.helpers import SF, awkward, frame, low, prose
from tidemark.llm import queries as Q
from tidemark.llm.decontam import decontaminate, item_words, near_phrases
from tidemark.llm.line_dedup import dedup_lines
from tidemark.llm.mixing import count_tokens, mix_sources, probabilities, rake, topic_of
from tidemark.llm.oracle import ORACLE as LLM_ORACLE
from tidemark.llm.quality import classify, fit_logistic, shrunken_rates
from tidemark.llm.sharding import shuffle_into_shards, write_shards
from tidemark.llm.token_records import frame as record_frame
from tidemark.llm.token_records import pack, read_frame, unpack, write_records


# ------------------------------------------------------------------- quality
@pytest.fixture(scope="module")
def judged(spark):
    rng = np.random.default_rng(3)
    texts, quality, toxic = [], [], []
    for i in range(400):
        words = prose(1000 + i, int(rng.integers(30, 80))).split()
        q, t = int(rng.random() > 0.2), int(rng.random() < 0.2)
        if not q:
            words = [w + "$$$" for w in words] if i % 2 else [w.upper() + "!!" for w in words]
        if t:
            words[5], words[15] = f"awful{i % 3}", "vile"
        texts.append(" ".join(words))
        quality.append(q)
        toxic.append(t)
    df = frame(spark, [*texts, None, ""]).cache()
    labels = spark.createDataFrame([(i, quality[i], toxic[i]) for i in range(0, 300)] + [(None, 1, 0), (7, None, 1)], "doc_id long, quality int, toxic int")
    return df, labels, quality, toxic


def test_quality_held_out_accuracy(judged):
    df, labels, quality, toxic = judged
    got = {r["doc_id"]: r for r in classify(df.withColumn("keep", F.lit("old")), labels).collect()}
    assert len(got) == 402
    wrong = [i for i in range(300, 400) if got[i]["keep"] != bool(quality[i] and not toxic[i])]
    assert len(wrong) <= 3
    assert not got[400]["keep"] and not got[401]["keep"] and got[400]["n_words"] == 0


def test_quality_without_labels_rejects_nothing_but_empty(judged, spark):
    df, labels, _, _ = judged
    rows = classify(df, labels.limit(0)).collect()
    assert [r["doc_id"] for r in rows if not r["keep"]] == [400, 401]
    assert classify(df.limit(0), labels).count() == 0


def test_sparse_sites_shrink_to_their_prior(spark):
    sites = [("big", 4000, 3600), ("small", 2, 2)] + [(f"s{k}", 400, 40 + 10 * (k % 5)) for k in range(20)]
    df = spark.createDataFrame([(s, n, b, 0.2) for s, n, b in sites], "site string, n long, bad long, prior double")
    got = {r["site"]: r["rate"] for r in shrunken_rates(df, ["site"], "prior", "rate").collect()}
    assert got["big"] > 0.85 and abs(got["small"] - 0.2) < 0.5 and got["small"] < got["big"]
    same = spark.createDataFrame([(f"s{k}", 1000, 200, 0.2) for k in range(9)], "site string, n long, bad long, prior double")
    assert all(abs(r["rate"] - 0.2) < 1e-6 for r in shrunken_rates(same, ["site"], "prior", "rate").collect())


def test_quality_null_and_repeated_labelled_ids(judged, spark, monkeypatch):
    import tidemark.llm.quality as M

    df, labels, _, _ = judged
    null = spark.createDataFrame([(None, 0, 1)], "doc_id long, quality int, toxic int")
    assert M._bad(labels.union(null)).count() == M._bad(labels.filter("doc_id IS NOT NULL")).count() == 300
    sizes, fit = [], M.fit_logistic
    monkeypatch.setattr(M, "MIN_HELD", 10**9)  # fit on the whole sample
    monkeypatch.setattr(M, "fit_logistic", lambda x, y: sizes.append(len(y)) or fit(x, y))
    M.fit_quality(df.union(df.filter("doc_id = 3")).union(df.filter("doc_id = 3")), labels)
    assert sizes == [300, 300]


def test_logistic_fit_recovers_odds():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(4000, 2))
    y = (rng.random(4000) < 1 / (1 + np.exp(-(0.5 + 2 * x[:, 0] - x[:, 1])))).astype(float)
    assert fit_logistic(x, y) == pytest.approx([0.5, 2, -1], abs=0.2)
    assert not fit_logistic(x, np.zeros(4000)).any()


def test_op2_accuracy(spark):
    sf = SF.replace("0.001", "0.01")
    got = {r["doc_id"]: r for r in Q.op2_quality_classifier(spark, sf).collect()}
    labels = Q.table(spark, sf, "labels").collect()
    assert len(got) == Q.table(spark, sf, "documents").count()
    good = [r["quality"] == 1 and r["toxic"] == 0 for r in labels]
    wrong = [got[r["doc_id"]]["keep"] != g for r, g in zip(labels, good, strict=True)]
    assert sum(wrong) <= 0.04 * len(labels) and not any(w for w, g in zip(wrong, good, strict=True) if g)


# ------------------------------------------------------------------ sharding
def test_sharding_is_gapless_and_minimal(spark, scratch):
    texts = [prose(i, 5 + i % 40) for i in range(300)] + awkward()
    df = frame(spark, texts).withColumn("Shard", F.lit("old")).withColumn("_row", F.lit(1))
    out = shuffle_into_shards(df, shards=6, bucket_bytes=1500)
    rows = out.collect()
    assert "Shard" not in out.columns and "_row" in out.columns and len(rows) == len(texts)
    slots = defaultdict(list)
    for r in rows:
        assert r["size"] == len((texts[r["doc_id"]] or "").encode()) + 8 and r["text"] == texts[r["doc_id"]]
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and set(slots) == set(range(6))
    assert len({(r["shard"], r["bucket"]) for r in rows}) > 6
    seven = {r["doc_id"]: r["shard"] for r in shuffle_into_shards(df.repartition(3), shards=7).collect()}
    assert all(r["grown_shard"] == seven[r["doc_id"]] and r["grown_shard"] in (r["shard"], 6) for r in rows)
    again = {r["doc_id"]: (r["shard"], r["slot"]) for r in shuffle_into_shards(df.repartition(7), shards=6, bucket_bytes=1500).collect()}
    assert again == {r["doc_id"]: (r["shard"], r["slot"]) for r in rows}
    files = spark.read.parquet(write_shards(out, f"{scratch}/shards"))
    assert sorted((r["shard"], r["slot"], r["doc_id"]) for r in files.collect()) == sorted((r["shard"], r["slot"], r["doc_id"]) for r in rows)


def test_sharding_nulls_repeats_and_empty(spark):
    df = frame(spark, ["same"] * 5 + [None, None], [1, 1, None, None, None, 2, None])
    rows = shuffle_into_shards(df, shards=3, bucket_bytes=10).collect()
    assert len(rows) == 7 and len({r["shard"] for r in rows if r["doc_id"] is None}) == 1
    assert sorted(r["size"] for r in rows) == [8, 8, 12, 12, 12, 12, 12]
    assert shuffle_into_shards(df.limit(0)).count() == 0


def test_op5_on_the_small_tables(spark):
    rows = Q.op5_sharding(spark, SF).collect()
    texts = {r["doc_id"]: r["text"] for r in Q.table(spark, SF, "documents").collect()}
    assert len(rows) == len(texts)
    assert all(r["text_crc32"] == zlib.crc32(texts[r["doc_id"]].encode()) and r["law"] == "key" and r["shard"] < 24 for r in rows)


# ------------------------------------------------------------ decontamination
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def brute_hits(texts, items, window):
    """items: (id as string, text); per text (n_words, n_hit, sorted items, contaminated)."""
    grams = defaultdict(set)
    for name, t in items:
        w = WORD.findall(low(t).decode())
        size = min(window, len(w))
        for i in range(len(w) - size + 1 if w else 0):
            grams[tuple(w[i : i + size])].add(name)
    out = []
    for t in texts:
        w = WORD.findall(low(t).decode())
        hit, met = set(), set()
        for size in {len(g) for g in grams}:
            for i in range(len(w) - size + 1):
                if found := grams.get(tuple(w[i : i + size])):
                    hit.update(range(i, i + size))
                    met |= found
        out.append((len(w), len(hit), sorted(met), bool(hit) and 20 * len(hit) >= len(w)))
    return out


def test_decontamination_equals_brute_force(spark):
    passage = prose(50, 40)
    p = passage.split()
    texts = awkward() + [
        passage, passage.upper() + "!", "; ".join(p), "x " * 30 + " ".join(p[5:18]) + " y", " ".join(p[5:17]), " ".join(p[:13] + p[20:40]),
        "tiny item stands here", "é tiny ITEM", "a a a a", prose(51, 900) + " " + " ".join(p[2:15]), (" ".join(p[:20]) + " ") * 3, "...", "7é7 b",
    ]
    items = [(1, passage), (2, "tiny item"), (3, None), (4, "!!!"), (5, "a " * 15), (10, " ".join(p[3:30])), (10, prose(52, 20)), (None, "7é7"), (2, "tiny item"), (6, "never seen words")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    df = frame(spark, texts).withColumn("items", F.lit("old"))
    rows = decontaminate(df, bench).collect()
    want = brute_hits(texts, [("" if i is None else str(i), t or "") for i, t in items], 13)
    got = {r["doc_id"]: (r["n_words"], r["n_hit"], r["items"], r["contaminated"]) for r in rows}
    assert got == dict(enumerate(want)) and len(rows) == len(texts)


def test_decontamination_beyond_the_broadcast_bound_and_empty(spark, monkeypatch):
    import tidemark.llm.decontam as D

    df, bench = frame(spark, [prose(60, 30), None]), spark.createDataFrame([(1, prose(60, 30))], "item_id long, text string")
    monkeypatch.setattr(D, "BROADCAST_BYTES", -1)
    assert sorted((r["n_hit"], r["n_items"]) for r in decontaminate(df, bench).collect()) == [(0, 0), (30, 1)]
    assert [r["n_hit"] for r in decontaminate(df, bench.limit(0)).collect()] == [0, 0]
    assert decontaminate(df.limit(0), bench).count() == 0


def test_near_phrases(spark):
    docs = spark.createDataFrame([(1, 1, "red x blue y y green z"), (2, 1, "red x x x x x x x blue green")], "_id long, _th int, _text string")
    items = item_words(spark.createDataFrame([(1, "green red blue")], "item_id long, text string"), "item_id", "text")
    assert [r["_id"] for r in near_phrases(docs, items, 6).collect()] == [1]


def test_op6_on_the_small_tables(spark):
    docs = Q.table(spark, SF, "documents").collect()
    bench = [(str(r["item_id"]), r["text"]) for r in Q.table(spark, SF, "benchmark").collect()]
    want = {}
    for d, (n, h, met, bad) in zip(docs, brute_hits([d["text"] for d in docs], bench, 13), strict=True):
        want[d["doc_id"]] = (n, h, len(met), hashlib.sha256(",".join(met).encode()).hexdigest(), bad)
    assert {r["doc_id"]: tuple(r)[1:] for r in Q.op6_decontamination(spark, SF).collect()} == want


# -------------------------------------------------------------- token records
def tokenizer():
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def test_token_records_round_trip(spark):
    from tokenizers import Tokenizer

    texts = awkward() + ["a  b", "a 　 b ", "x\x1c\x1dy z", "it's  we'll\n\n\n ok ", "tail   ", " <|endoftext|> in text", "\u0085 \t x", "東京   タワー"]
    plain = Tokenizer.from_file(tokenizer())
    ids = {i: [*plain.encode(t or "", add_special_tokens=False).ids, 2] for i, t in enumerate(texts)}
    records = write_records(frame(spark, texts).repartition(4), tokenizer(), file_bytes=9000)
    assert records.parts > 2
    before = 0
    got = {r["id"]: r for r in records.read().collect()}
    for i in range(len(texts)):
        want = (before, len(ids[i]), zlib.crc32(np.array(ids[i], dtype="<u4").tobytes()))
        assert (got[i]["start"], got[i]["n_tokens"], got[i]["ids_crc32"]) == want, texts[i]
        before += len(ids[i])
    assert {r["id"]: r["ids"] for r in records.read_shuffled(3).collect()} == ids


def test_token_records_ids_nulls_and_empty(spark):
    df = frame(spark, ["b", "a", None, "b"], [5, None, -3, 5])
    got = sorted((r["start"], r["id"], r["n_tokens"]) for r in write_records(df, tokenizer()).read().collect())
    assert got == [(0, None, 2), (2, -3, 1), (3, 5, 2), (5, 5, 2)]
    named = df.withColumn("doc_id", F.concat(F.lit("é"), F.col("doc_id")))
    assert {r["id"] for r in write_records(named, tokenizer()).read().collect()} == {None, "é-3", "é5"}
    assert write_records(df.limit(0), tokenizer()).read().count() == 0


def test_damaged_records_are_found():
    raw = record_frame(pack(7, np.array([1, 2], dtype="<u2"))) + record_frame(pack(None, np.array([], dtype="<u2")))
    stream = io.BytesIO(raw)
    key, ids = unpack(read_frame(stream.read), True, "<u2")
    assert (key, list(ids)) == (7, [1, 2]) and unpack(read_frame(stream.read), True, "<u2")[0] is None and read_frame(stream.read) is None
    for at in (3, 9, 20, len(raw) // 2 - 2):
        bad = bytearray(raw)
        bad[at] ^= 1
        with pytest.raises(ValueError, match="damaged"):
            read_frame(io.BytesIO(bytes(bad)).read)
    with pytest.raises(ValueError, match="damaged"):
        read_frame(io.BytesIO(raw[:15]).read)


def test_op7_on_the_small_tables(spark):
    from tokenizers import Tokenizer

    plain, before, want = Tokenizer.from_file(tokenizer()), 0, {}
    for r in Q.table(spark, SF, "documents").orderBy("doc_id").collect():
        ids = [*plain.encode(r["text"] or "", add_special_tokens=False).ids, 2]
        want[r["doc_id"]] = (before, len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes()))
        before += len(ids)
    assert {r["doc_id"]: tuple(r)[1:] for r in Q.op7_token_records(spark, SF).collect()} == want


# ----------------------------------------------------------------- line dedup
def brute_lines(texts, depth=2, min_docs=5, min_constant=0.6, min_tokens=3):
    lines = []  # (doc, line, tokens); equal texts with equal ids do not occur here
    for d, t in enumerate(texts):
        for n, x in enumerate((t or "").split("\n")):
            w = [b"<*>" if re.search(rb"[0-9]", y) else y for y in x.encode().split()]
            if len(w) >= min_tokens:
                lines.append((d, n, w))
    leaf = lambda w: (len(w), *w[:depth])
    docs_of = defaultdict(set)
    for d, _, w in lines:
        docs_of[leaf(w)].add(d)
    lines = [x for x in lines if len(docs_of[leaf(x[2])]) >= min_docs]
    votes, voters = Counter(), defaultdict(set)
    for d, _, w in lines:
        for k, y in enumerate(w):
            if y == b"<*>":
                continue
            votes[(leaf(w), k, y)] += 1
            voters[(leaf(w), k, y)].add(d)
    ok = {v for v, c in votes.items() if c >= min_docs and len(voters[v]) > 1}
    told, common = [], defaultdict(set)
    for d, n, w in lines:
        kept = tuple((k, y) for k, y in enumerate(w) if (leaf(w), k, y) in ok)
        if len(kept) >= len(w) * min_constant and kept:
            told.append((d, n, (leaf(w), kept)))
            common[(leaf(w), kept)].add(d)
    gone = defaultdict(set)
    for d, n, t in told:
        if len(common[t]) >= min_docs:
            gone[d].add(n)
    return ["\n".join(x for n, x in enumerate((t or "").split("\n")) if n not in gone[d]) for d, t in enumerate(texts)]


def test_line_dedup_equals_brute_force(spark):
    texts = awkward()
    for k in range(12):
        texts.append("\n".join([prose(70 + k, 12), f"Posted on day {k} by user u{k} at home", "All rights reserved by us", "", prose(90 + k, 9), "short one"]))
    texts += ["All rights reserved by us\n" * 9, "The quick brown fox\nAll  rights reserved by us", "All rights reserved by them"]
    df = frame(spark, texts).withColumn("n_lines", F.lit("old"))
    rows = {r["doc_id"]: r for r in dedup_lines(df, exact=False).collect()}
    want = brute_lines(texts)
    assert [rows[i]["text"] for i in range(len(texts))] == want
    assert "Posted on day" not in rows[len(awkward())]["text"] and "reserved by us" not in rows[len(awkward())]["text"]
    assert rows[len(awkward())]["n_lines"] == 5 and rows[len(awkward())]["n_dropped"] == 2
    assert dedup_lines(df.limit(0)).count() == 0


def test_line_dedup_repeated_rows_are_one_document(spark):
    df = frame(spark, ["one two three"] * 6, [1, 1, 1, 1, None, None])
    assert {r["n_dropped"] for r in dedup_lines(df).collect()} == {0}
    assert {r["n_dropped"] for r in dedup_lines(frame(spark, ["one two three"] * 6)).collect()} == {1}


def test_op8_on_the_small_tables(spark):
    docs = Q.table(spark, SF, "documents").select("doc_id", "text").collect()
    want = {d["doc_id"]: hashlib.sha256(t.encode()).hexdigest() for d, t in zip(docs, brute_copies([d["text"] for d in docs]), strict=True)}
    assert {r["doc_id"]: r["kept_sha256"] for r in Q.op8_line_dedup(spark, SF).collect()} == want


def brute_copies(texts, min_docs=5):
    """Of each text, the lines dropped by brute_lines, and those that min_docs texts have token for token."""
    docs_of = defaultdict(set)
    for d, t in enumerate(texts):
        for x in (t or "").split("\n"):
            docs_of[tuple(x.encode().split())].add(d)
    dropped = {k for k, v in docs_of.items() if k and len(v) >= min_docs}
    out = []
    for t, kept in zip(texts, brute_lines(texts), strict=True):
        left = iter(kept.split("\n") + [None])  # the kept lines are a subsequence of the lines
        nxt, lines = next(left), []
        for x in (t or "").split("\n"):
            if x == nxt:
                nxt = next(left)
                if tuple(x.encode().split()) not in dropped:
                    lines.append(x)
        out.append("\n".join(lines))
    return out


def test_exact_lines_are_dropped_at_any_length(spark):
    texts = awkward()
    for k in range(6):
        texts.append("\n".join([prose(70 + k, 12), "Menu", "short  one" if k % 2 else "short one", "版权所有不得转载", "call 555 0100 or 555 0199 0r 1", f"day {k}", "", "few" if k < 4 else "less"]))
    texts += ["few\nfew\nfew", "All  is one"]
    rows = {r["doc_id"]: r for r in dedup_lines(frame(spark, texts), exact=True).collect()}
    assert [rows[i]["text"] for i in range(len(texts))] == brute_copies(texts)
    first = rows[len(awkward())]
    assert first["n_dropped"] == 5 and first["text"].split("\n")[1:3] == ["day 0", ""]
    repeated = frame(spark, ["Menu"] * 6, [1, 1, 1, 1, None, None])
    assert {r["n_dropped"] for r in dedup_lines(repeated, exact=True).collect()} == {0}
    assert dedup_lines(repeated.limit(0), exact=True).count() == 0


# --------------------------------------------------------------------- mixing
def test_rake_meets_all_marginals():
    rng = np.random.default_rng(2)
    codes = [c.ravel() for c in np.indices((3, 4, 2))]
    tokens = rng.integers(1, 100, 24).astype(float)
    targets = [np.array([0.2, 0.3, 0.5]), np.array([0.1, 0.2, 0.3, 0.4]), np.array([0.6, 0.4])]
    x = rake(tokens, np.array(codes), targets)
    for c, t in zip(codes, targets, strict=True):
        assert np.bincount(c, weights=x) / x.sum() == pytest.approx(t, abs=1e-6)
    p, w = probabilities(tokens, x, 0.5)
    assert (tokens * p).sum() == pytest.approx(0.5 * tokens.sum()) and p.max() <= 1
    assert p * w / (p * w).max() == pytest.approx((x / tokens) / (x / tokens).max())


def test_mixing_draws_by_calibrated_probability(spark):
    texts = [prose(i, 20) + (" | x" if i % 5 == 0 else "") for i in range(3000)]
    df = frame(spark, texts).withColumn("source", F.when(F.col("doc_id") % 7 < 5, "big").otherwise(F.concat(F.lit("s"), F.col("doc_id") % 2))).withColumn("tokens", F.lit("old"))
    targets = {"source": {"big": 0.3, "s0": 0.4, "s1": 0.3}, "lang": 1.0, "topic": 1.0}
    rows = mix_sources(df, targets, keep_share=0.4).collect()
    assert 0.35 * len(texts) < len(rows) < 0.45 * len(texts)
    total = sum(r["tokens"] * r["weight"] for r in rows)
    for s, want in targets["source"].items():
        assert sum(r["tokens"] * r["weight"] for r in rows if r["source"] == s) / total == pytest.approx(want, abs=0.06)
    again = {r["doc_id"] for r in mix_sources(df.repartition(7), targets, keep_share=0.4).collect()}
    assert again == {r["doc_id"] for r in rows}


def test_mixing_nulls_pooled_categories_and_empty(spark, monkeypatch):
    import tidemark.llm.mixing as M

    monkeypatch.setattr(M, "MAX_CATEGORIES", 2)
    texts = awkward()
    df = frame(spark, texts)
    assert {r["doc_id"] for r in mix_sources(df, keep_share=1.0, targets={"source": 1.0, "lang": 1.0, "topic": 1.0}).collect()} == set(range(len(texts)))
    assert mix_sources(df.limit(0)).count() == 0
    rows = df.select(count_tokens(F.col("text")).alias("n"), topic_of(F.col("text")).alias("t"), "text").collect()
    assert all(r["n"] == len((r["text"] or "").encode().split()) for r in rows) and rows[0]["t"] == "(none)"


@pytest.mark.parametrize("given", [False, True])
def test_mixing_every_category_has_its_own_target(spark, given):
    texts = [prose(i, 5 + i % 9) + (" | x" if i % 5 == 0 else "") for i in range(1300)]
    df = frame(spark, texts).withColumn("source", F.concat(F.lit("h"), F.floor(F.sqrt("doc_id") * 3.6))).cache()
    cells, sources = Counter(), Counter()
    for r in df.select("source", F.coalesce("lang", F.lit("(none)")).alias("l"), topic_of(F.col("text")).alias("t"), count_tokens(F.col("text")).alias("n")).collect():
        cells[(r["source"], r["l"], r["t"])] += r["n"]
        sources[r["source"]] += r["n"]
    assert len(sources) > 101
    wanted = {s: (1 + k % 3) for k, s in enumerate(sorted(sources))}
    wanted = {s: v / sum(wanted.values()) for s, v in wanted.items()}
    keys, tokens = list(cells), np.array(list(cells.values()), dtype=float)
    codes, shares = [], []
    for d in range(3):
        found = sorted({k[d] for k in keys})
        codes.append(np.array([found.index(k[d]) for k in keys]))
        have = np.bincount(codes[-1], weights=tokens)
        share = np.array([wanted[f] for f in found]) if given and d == 0 else have**0.7
        shares.append(share / share.sum())
    p, w = probabilities(tokens, rake(tokens, np.array(codes), shares), 0.6)
    want = {k: (a, b) for k, a, b in zip(keys, p, w, strict=True)}
    rows = mix_sources(df, {"source": wanted} if given else None, keep_share=0.6).collect()
    assert 0.4 * len(texts) < len(rows) < 0.8 * len(texts)
    for r in rows:
        assert (r["probability"], r["weight"]) == pytest.approx(want[(r["source"], r["lang"] or "(none)", r["topic"])], rel=1e-6)


@pytest.mark.parametrize("on_spark", [False, True])
def test_mixing_without_a_share_meets_targets_by_the_draw_alone(spark, monkeypatch, on_spark):
    import tidemark.llm.mixing as M

    if on_spark:
        monkeypatch.setattr(M, "MAX_CATEGORIES", 1)
    texts = [prose(i, 20) + (" | x" if i % 5 == 0 else "") for i in range(6000)] + [None]
    df = frame(spark, texts).withColumn("source", F.when(F.col("doc_id") % 7 < 5, "big").otherwise(F.concat(F.lit("s"), F.col("doc_id") % 2)))
    powers = {"source": 0.8, "lang": 0.9, "topic": 1.0}
    rows = mix_sources(df, powers, keep_share=None).collect()
    cells = mix_sources(df, {"source": 1.0, "lang": 1.0, "topic": 1.0}, keep_share=1.0).select("source", F.coalesce("lang", F.lit("(none)")).alias("lang"), "topic", "tokens").collect()
    assert {r["weight"] for r in rows} == {1.0} and max(r["probability"] for r in rows) == pytest.approx(1.0)
    total = sum(r["tokens"] for r in rows)
    for d, power in powers.items():
        have = Counter()
        for c in cells:
            have[c[d]] += c["tokens"]
        want = {k: v**power for k, v in have.items() if v}
        for k, v in want.items():
            drawn = sum(r["tokens"] for r in rows if (r[d] or "(none)") == k) / total
            assert drawn == pytest.approx(v / sum(want.values()), abs=0.02), (d, k)
    assert None in {r["text"] for r in rows}


def test_op9_on_the_small_tables(spark):
    rows = Q.op9_mixing(spark, SF).collect()
    total = Q.table(spark, SF, "documents").count()
    assert 0.4 * total < len(rows) < total and all(0 < r["probability"] <= 1 for r in rows)


# ------------------------------------------------------------------- pipeline
def docs_of(spark, rows):
    """Rows collected from a frame, as one again."""
    return spark.createDataFrame(rows)


def test_pipeline_stages_against_plain_python(spark, scratch):
    from tests.llm.test_text_operators import brute_components

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    seen = [docs.collect()]
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, SF).write.parquet(f"{scratch}/{k}")
        docs = spark.read.parquet(f"{scratch}/{k}")
        assert docs.columns[: len(columns)] == columns and (k == 4 or docs.columns == columns)
        seen.append(docs.collect())
    ids = [[r["doc_id"] for r in rows] for rows in seen]
    assert all(set(b) <= set(a) and len(b) == len(set(b)) for a, b in zip(ids, ids[1:], strict=False))
    bad = {r["doc_id"] for r in spark.read.parquet(f"{SF}/labels.parquet").filter("quality = 0 OR toxic = 1").collect()}
    good = {r["doc_id"] for r in spark.read.parquet(f"{SF}/labels.parquet").filter("quality = 1 AND toxic = 0").collect()}
    assert good <= set(ids[1]) and len(bad & set(ids[1])) <= 0.6 * len(bad)  # these tables label 20 bad documents; op2 has the accuracy on more
    first = sorted(seen[1], key=lambda r: r["doc_id"])
    want = {r["doc_id"] for i, (r, (n, c)) in enumerate(zip(first, brute_components([r["text"] for r in first]), strict=True)) if not n or c == i}
    assert set(ids[2]) == want
    bench = [(str(r["item_id"]), r["text"]) for r in Q.table(spark, SF, "benchmark").collect()]
    assert set(ids[3]) == {r["doc_id"] for r, hit in zip(seen[2], brute_hits([r["text"] for r in seen[2]], bench, 13), strict=True) if not hit[3]}
    # the mixing stage draws unweighted: the drawn tokens' shares are those of its targets, and most is kept
    drawn = mix_sources(docs_of(spark, seen[3]), corpus_pipeline.MIX, keep_share=None)
    assert sorted(r["doc_id"] for r in drawn.select("doc_id").collect()) == sorted(ids[4]) and len(ids[4]) >= 0.6 * len(ids[3])
    assert {r[0] for r in drawn.select("weight").distinct().collect()} == {1.0}
    assert set(ids[5]) == set(ids[4])
    slots = defaultdict(list)
    for r in seen[5]:
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    ran = corpus_pipeline.run(spark, SF).select("doc_id", "shard", "slot").collect()
    assert sorted(map(tuple, ran)) == sorted((r["doc_id"], r["shard"], r["slot"]) for r in seen[5])


def test_entry_registers_every_operator():
    import __spark_entry__ as E

    names = set(E.queries())
    assert "pipeline" in names and all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 11))


@pytest.mark.parametrize("name", sorted(LLM_ORACLE))
def test_query_matches_its_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    want = con.execute(LLM_ORACLE[name])
    columns = [d[0] for d in want.description]
    got = Q.QUERIES[name](spark, SF)
    assert sorted(got.columns) == sorted(columns)
    assert sorted(map(tuple, got.select(*columns).collect())) == sorted(want.fetchall())
