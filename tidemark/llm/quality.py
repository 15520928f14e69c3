"""Quality classifier: document evidence, host and path posteriors, empirical Bayes.

Labels (1: good) are learnt by two heads, quality and toxicity. Features of a
word are its lower-cased form, its prefixes, and its shape (trailing marks,
capitals, repetition of the word before, no letters at all). A feature counts
for a head only if its document frequencies in the two classes differ beyond
chance (|z| at least ``MIN_Z``); its weight is the log ratio of its smoothed
rates. A document's evidence is the mean weight of its words and, for short
passages in long texts, the sum over them on a log scale; a logistic fit on a
held-out part of the labelled sample turns evidence into log odds.

Reject rates of the hosts (sources) and of the paths below them come from
grouped sums over labelled documents: a host's posterior is Beta-Binomial with
the global rate as prior mean, a path's has its host's posterior as prior mean.
The strength of each prior is fitted by moments to how much the rates differ, so
that sparse sites fall back to their host and sparse hosts to the global rate.
A document's log odds are its evidence plus the change from the global rate to
its path's posterior.

The heads are fitted on at most ``sample`` labelled documents (by hash of the
id) and keep at most ``MAX_FEATURES`` features each; these bound what reaches
the driver. Sites are counted over all labelled documents and stay distributed.

Null text is empty, and an empty text is rejected as having no words. Null host
or path is a site of its own. Labels with null are ignored; of repeated labels
of one id the worst counts; without labels of both classes a head knows nothing
and rejects nothing.
"""

from __future__ import annotations

from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import LOWER, U64, byte_table, chunks, id_key, map_texts, materialize, mix, other_columns, text_column, word_hash, word_spans, words_per_text

SAMPLE = 10_000
MAX_FEATURES = 20_000
MIN_Z = 4.0
MIN_HELD = 10  # documents of each class that the held-out part needs
NEVER = -20.0  # log odds of a head that knows nothing
PREFIXES = (4, 5, 6, 7, 8)  # bytes
FEATURE_BYTES = 1 << 20  # text whose features are held at a time: some 30 bytes for each of its own
BREAKS = byte_table([*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)])
HEADS = ("junk", "toxic")
EVIDENCE = [T.StructField("_n", T.LongType()), T.StructField("_x", T.ArrayType(T.DoubleType()))]
CAPITAL = np.zeros(256, dtype=np.int64)
CAPITAL[65:91] = 1
MARK = BREAKS.astype(np.int64)
MARK[65:91] = 0
MARK[[0x2C, 0x2E]] = 0  # comma and full stop


def features(buf: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(names, text index of each name, words per text): the features of all words, one after another kind."""
    starts, ends = word_spans(buf, bounds)
    at = words_per_text(starts, bounds)
    n_words = np.diff(at)
    doc = np.repeat(np.arange(len(n_words)), n_words)
    if not len(starts):
        return np.zeros(0, U64), np.zeros(0, np.int64), n_words
    low = LOWER[buf]
    # the letters of a word: its first run outside marks
    cs, ce = word_spans(low, bounds, BREAKS)
    cdoc = np.searchsorted(bounds, cs, "right") - 1
    whole = word_hash(low, cs, ce)
    names, docs = [mix(whole + U64(1))], [cdoc]
    for size in PREFIXES:
        long = np.flatnonzero(ce - cs > size)
        names.append(mix(word_hash(low, cs[long], cs[long] + size) + U64(2)))
        docs.append(cdoc[long])
    marks = np.concatenate(([0], np.cumsum(MARK[buf])))
    capitals = np.concatenate(([0], np.cumsum(CAPITAL[buf])))
    length = ends - starts
    raw = word_hash(buf, starts, ends)
    again = np.zeros(len(raw), dtype=bool)
    again[1:] = (raw[1:] == raw[:-1]) & (doc[1:] == doc[:-1])
    n_marks = np.minimum(marks[ends] - marks[starts], 4)
    n_caps = capitals[ends] - capitals[starts]
    caps = np.where(n_caps == 0, 0, np.where((n_caps >= 2) & (2 * n_caps >= length), 2, 1))
    shape = n_marks * 16 + caps * 4 + again * 2 + (n_marks == length)
    names.append(mix(shape.astype(U64) + U64(1 << 40)))
    docs.append(doc)
    return np.concatenate(names), np.concatenate(docs), n_words


def evidence(names: np.ndarray, doc: np.ndarray, n_words: np.ndarray, known: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Per text and head: mean and log-scaled sum of the weights of its features."""
    n = len(n_words)
    out = np.zeros((n, weights.shape[0], 2))
    if len(names) and len(known):
        seen = np.zeros(1 << 20, dtype=bool)
        seen[(known >> U64(44)).astype(np.int64)] = True
        maybe = np.flatnonzero(seen[(names >> U64(44)).astype(np.int64)])
        at = np.minimum(np.searchsorted(known, names[maybe]), len(known) - 1)
        hit = known[at] == names[maybe]
        at, docs = at[hit], doc[maybe[hit]]
        for h in range(weights.shape[0]):
            total = np.bincount(docs, weights=weights[h][at], minlength=n)
            out[:, h, 0] = total / np.maximum(n_words, 1)
            out[:, h, 1] = np.sign(total) * np.log1p(np.abs(total))
    return out


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, rounds: int = 30) -> np.ndarray:
    """Intercept and slopes by Newton steps with a small ridge on standardised columns."""
    if len(y) == 0 or y.min() == y.max():
        return np.zeros(x.shape[1] + 1)
    mean, scale = x.mean(0), x.std(0) + 1e-9
    z = np.column_stack((np.ones(len(x)), (x - mean) / scale))
    w = np.zeros(z.shape[1])
    keep = np.full(z.shape[1], ridge)
    keep[0] = 1e-6
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        h = (z * (p * (1 - p))[:, None]).T @ z + np.diag(keep)
        step = np.linalg.solve(h, z.T @ (y - p) - keep * w)
        w += np.clip(step, -3, 3)
        if np.abs(step).max() < 1e-6:
            break
    slopes = w[1:] / scale
    return np.concatenate(([w[0] - (slopes * mean).sum()], slopes))


# ------------------------------------------------------------------ task side
def _count_features(batches):
    """Per batch and feature: texts and occurrences in all and in each head's bad class."""
    for batch in batches:
        y = np.column_stack([batch.column(k).to_numpy(zero_copy_only=False) for k in range(1, 1 + len(HEADS))])
        for i, j, buf, bounds in chunks(text_column(batch, "_text"), FEATURE_BYTES):
            names, doc, _ = features(buf, bounds)
            distinct, which = np.unique(names, return_inverse=True)
            pair = np.unique(which.astype(np.int64) * (j - i) + doc)
            feature, text = pair // (j - i), pair % (j - i)
            n = len(distinct)
            cols = [np.bincount(feature, minlength=n), np.bincount(which, minlength=n)]
            for h in range(len(HEADS)):
                bad = y[i:j, h]
                cols += [np.bincount(feature, weights=bad[text], minlength=n), np.bincount(which, weights=bad[doc], minlength=n)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(distinct.view(np.int64)), *[pa.array(c.astype(np.int64)) for c in cols]],
                ["name", "df", "tf", *[f"{k}_{h}" for h in HEADS for k in ("df", "tf")]],
            )


def _evidence(i, j, buf, bounds, known: np.ndarray, weights: np.ndarray, fits: np.ndarray | None):
    """Number of words, and raw evidence (fits None) or log odds of each head, of the texts in ``buf``."""
    rows = []
    lo = 0
    while lo < j - i:  # a few texts at a time
        hi = max(lo + 1, int(np.searchsorted(bounds, bounds[lo] + FEATURE_BYTES, "right")) - 1)
        names, doc, n_words = features(buf[bounds[lo] : bounds[hi]], bounds[lo : hi + 1] - bounds[lo])
        x = evidence(names, doc, n_words, known, weights)
        if fits is not None:
            x = fits[:, 0] + (x * fits[:, 1:]).sum(2)
        rows.append(np.column_stack((n_words, x.reshape(len(n_words), -1))))
        lo = hi
    x = np.concatenate(rows)
    lists = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1, dtype=np.int32) * (x.shape[1] - 1)), pa.array(x[:, 1:].ravel()))
    return [pa.array(x[:, 0].astype(np.int64)), lists]


# ---------------------------------------------------------------- driver side
class QualityModel:
    """Fitted heads: feature names, weights, logistic fits, and the global bad rates."""

    def __init__(self, known: np.ndarray, weights: np.ndarray, fits: np.ndarray, rates: np.ndarray):
        self.known, self.weights, self.fits, self.rates = known, weights, fits, rates


def _bad(labels: DataFrame) -> DataFrame:
    """(_id, junk, toxic) of the labelled ids."""
    bad = labels.filter(F.col("doc_id").isNotNull()).select(id_key(labels, "doc_id").alias("_id"), (F.col("quality") == 0).cast("int").alias("junk"), (F.col("toxic") == 1).cast("int").alias("toxic"))
    return bad.dropna().groupBy("_id").agg(F.max("junk").alias("junk"), F.max("toxic").alias("toxic"))


def fit_quality(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample: int = SAMPLE) -> QualityModel:
    """Fit both heads on at most ``sample`` labelled documents: three quarters for weights, one for the logistic fits."""
    bad = _bad(labels)
    docs = df.select(id_key(df, id_col).alias("_id"), F.col(text_col).alias("_text"))
    # Labels of both classes may be fewer than the held-out part needs; then the fits use the whole sample.
    chosen = F.broadcast(bad.orderBy(F.xxhash64("_id"), "_id").limit(sample))
    rows = docs.join(chosen, "_id").select(F.col("_id").alias("_row"), *HEADS, "_text", (F.pmod(F.xxhash64("_id", F.lit(5)), F.lit(4)) == 0).alias("hold"))
    counts = ["df", "tf", *[f"{k}_{h}" for h in HEADS for k in ("df", "tf")]]
    schema = "name long, " + ", ".join(f"{c} long" for c in counts)
    train = rows.filter("NOT hold")
    size = train.agg(F.count("*").alias("n"), *[F.sum(h).alias(h) for h in HEADS]).first()
    table = train.select("_row", *HEADS, "_text").mapInArrow(_count_features, schema)
    table = table.groupBy("name").agg(*[F.sum(c).alias(c) for c in counts])
    z = {}
    for h in HEADS:
        n1 = size[h] or 0
        n0 = size["n"] - n1
        share = F.col("df") / F.lit(max(size["n"], 1))
        p1, p0 = F.col(f"df_{h}") / F.lit(max(n1, 1)), (F.col("df") - F.col(f"df_{h}")) / F.lit(max(n0, 1))
        spread = F.sqrt(share * (1 - share) * F.lit(1 / max(n1, 1) + 1 / max(n0, 1)) + F.lit(1e-12))
        z[h] = F.abs(p1 - p0) / spread if n1 and n0 else F.lit(0.0)
    total = table.agg(*[F.sum(c).alias(c) for c in counts]).first()
    strongest = table.select("name", *counts, *[z[h].alias(f"z_{h}") for h in HEADS])
    found: dict[int, np.ndarray] = {}
    for k, h in enumerate(HEADS):
        top = strongest.filter(F.col(f"z_{h}") >= MIN_Z).orderBy(F.desc(f"z_{h}"), "name").limit(MAX_FEATURES)
        for r in top.collect():
            t1, t0 = total[f"tf_{h}"] + 1, total["tf"] - total[f"tf_{h}"] + 1
            w = np.log((r[f"tf_{h}"] + 0.5) / t1) - np.log((r["tf"] - r[f"tf_{h}"] + 0.5) / t0)
            found.setdefault(r["name"], np.zeros(len(HEADS)))[k] = w
    known = np.array(list(found), dtype=np.int64).view(U64)
    order = np.argsort(known)
    known = known[order]
    weights = np.array(list(found.values()), dtype=np.float64).reshape(-1, len(HEADS)).T[:, order]
    told = rows.select(F.struct("_row", *HEADS, "hold").alias("_row"), "_text")
    seen = map_texts(told, "_text", ["_row"], partial(_evidence, known=known, weights=weights, fits=None), EVIDENCE)
    # rows that share a chosen id count once in the logistic fits, by their least evidence: at most ``sample`` rows
    seen = seen.groupBy("_row").agg(F.min("_x").alias("_x")).collect()
    x = np.array([r["_x"] for r in seen]).reshape(len(seen), len(HEADS), 2)
    y = np.array([[r["_row"][h] for h in HEADS] for r in seen], dtype=float).reshape(-1, len(HEADS))
    hold = np.array([r["_row"]["hold"] for r in seen], dtype=bool)
    fits = []
    for k in range(len(HEADS)):
        bad_held = int(y[hold, k].sum())
        part = hold if min(bad_held, int(hold.sum()) - bad_held) >= MIN_HELD else np.ones(len(y), dtype=bool)
        fits.append(fit_logistic(x[part, k], y[part, k]))
        if len(y) == 0 or y[:, k].min() == y[:, k].max():
            fits[-1][0] = NEVER
    fits = np.array(fits)
    rates = np.array([((size[h] or 0) + 0.5) / (size["n"] + 1) for h in HEADS])
    return QualityModel(known, weights, fits, rates)


def shrunken_rates(sites: DataFrame, by: list[str], prior: str, out: str) -> DataFrame:
    """Posterior bad rate of each site: (bad + m prior) / (n + m), m by moments over the sites' own rates.

    ``sites`` has the columns ``by``, n, bad and ``prior`` (its prior mean). One
    row of sums reaches the driver.
    """
    p = F.col(prior)
    w = F.col("n") / (F.col("n") + F.lit(20.0))  # a site counts by how well its rate is known; no large one outweighs the rest
    s = sites.agg(
        F.sum(w * (F.col("bad") / F.col("n") - p) ** 2).alias("q"),
        F.sum(w * p * (1 - p) / F.col("n")).alias("e"),  # what sampling alone adds
        F.sum(w * p * (1 - p)).alias("v"),
    ).first()
    between = max((s["q"] or 0.0) - (s["e"] or 0.0), 0.0) / max(s["v"] or 0.0, 1e-12)  # share of p(1-p) that sites differ by
    strength = min(max((1 - between) / between if between > 1e-6 else 1e6, 1.0), 1e6)
    return sites.select(*by, ((F.col("bad") + F.lit(strength) * p) / (F.col("n") + F.lit(strength))).alias(out))


def classify(
    df: DataFrame, labels: DataFrame, host: str = "source", path: str = "lang", id_col: str = "doc_id", text_col: str = "text", sample: int = SAMPLE, threshold: float = 0.5
) -> DataFrame:
    """All rows of ``df`` with p_junk, p_toxic, n_words and keep (neither reaches ``threshold``, and there are words).

    Input columns with these names are replaced.
    """
    model = fit_quality(df, labels, id_col, text_col, sample)
    names = other_columns(df, [*[f"p_{h}" for h in HEADS], "n_words", "keep"])
    bad = _bad(labels)
    marked = df.select(id_key(df, id_col).alias("_id"), F.col(host).alias("_host"), F.col(path).alias("_path")).join(bad, "_id")
    paths = marked.groupBy("_host", "_path").agg(F.count("*").alias("n"), *[F.sum(h).alias(h) for h in HEADS])
    hosts = paths.groupBy("_host").agg(F.sum("n").alias("n"), *[F.sum(h).alias(h) for h in HEADS])
    site = paths.select("_host", "_path")
    for k, h in enumerate(HEADS):
        rate = float(model.rates[k])
        host_rate = shrunken_rates(hosts.select("_host", "n", F.col(h).alias("bad"), F.lit(rate).alias("prior")), ["_host"], "prior", "prior")
        host_rate = host_rate.withColumnRenamed("_host", "_h")
        under = paths.select("_host", "_path", "n", F.col(h).alias("bad")).join(host_rate, F.col("_host").eqNullSafe(F.col("_h"))).drop("_h")
        path_rate = shrunken_rates(under, ["_host", "_path"], "prior", f"rate_{h}").withColumnsRenamed({"_host": "_h", "_path": "_p"})
        site = site.join(path_rate, F.col("_host").eqNullSafe(F.col("_h")) & F.col("_path").eqNullSafe(F.col("_p"))).drop("_h", "_p")
    site = site.select(F.col("_host").alias("_h"), F.col("_path").alias("_p"), *[f"rate_{h}" for h in HEADS])
    # As a written table its size is known when the join is planned: broadcast if small, so that texts are not shuffled by site.
    site = materialize(site, "sites")
    carry = [*names, *[c for c in (host, path) if c not in names]]
    work = partial(_evidence, known=model.known, weights=model.weights, fits=model.fits)
    scored = map_texts(df, text_col, carry, work, EVIDENCE, row="_row")
    scored = scored.select("_row", "_n", "_x", F.col("_row").getField(host).alias("_host"), F.col("_row").getField(path).alias("_path"))
    scored = scored.join(site, F.col("_host").eqNullSafe(F.col("_h")) & F.col("_path").eqNullSafe(F.col("_p")), "left")
    odds = {}
    for k, h in enumerate(HEADS):
        rate = float(model.rates[k])
        local = F.coalesce(F.col(f"rate_{h}"), F.lit(rate))
        shift = F.log(local / (1 - local)) - F.lit(float(np.log(rate / (1 - rate))))
        odds[h] = 1 / (1 + F.exp(-(F.col("_x")[k] + shift)))
    out = scored.select("_row", "_n", *[odds[h].alias(f"_p_{h}") for h in HEADS])
    keep = F.col("_n") > 0
    for h in HEADS:
        keep = keep & (F.col(f"_p_{h}") < threshold)
    return out.select(
        *[F.col("_row").getField(c).alias(c) for c in names],
        *[F.col(f"_p_{h}").alias(f"p_{h}") for h in HEADS], F.col("_n").alias("n_words"), keep.alias("keep"),
    )
