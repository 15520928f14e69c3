"""Benchmark decontamination with a distributed positional inverted index.

The index holds a posting (term, document, position) for every occurrence of a
test term in the training texts. For each window of a benchmark item the two
rarest terms are looked up; their lists, shifted by the terms' offsets, are
intersected, which leaves documents and alignments where the window may stand.
Those are compared word by word, so the matches are exact. All of it is
DataFrame expressions.

The test terms and the items are broadcast only while their measured bytes stay
below ``BROADCAST_BYTES``; beyond that they are joined by shuffle.

Null texts and items have no words. An item with fewer words than a window is
one window. Repeated items count once, by id. Repeated rows of documents get
equal results.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import id_key, materialize, other_columns

BROADCAST_BYTES = 32 << 20
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BREAKS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
DOC = ["_id", "_th"]


def split_words(text: Column) -> Column:
    """Lower-cased (A-Z) words; an empty string at either end stands for leading or trailing breaks."""
    return F.split(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), BREAKS)


def count_words(words: Column) -> Column:
    """Words of ``split_words`` without the empty strings at its ends."""
    ends = (F.get(words, F.lit(0)) == "").cast("int") + F.when(F.size(words) > 1, (F.get(words, F.size(words) - 1) == "").cast("int")).otherwise(0)
    return (F.size(words) - ends).cast("long")


def _small(df: DataFrame, size: Column) -> DataFrame:
    """``df`` marked for broadcast if its measured bytes stay below the bound."""
    return F.broadcast(df) if (df.agg(F.sum(size)).first()[0] or 0) <= BROADCAST_BYTES else df


def item_words(items: DataFrame, item_id: str, text_col: str) -> DataFrame:
    """(item, words) of the items that have words."""
    found = items.select(
        F.coalesce(F.col(item_id).cast("string"), F.lit("")).alias("item"), F.filter(split_words(F.col(text_col)), lambda w: w != "").alias("words")
    )
    return found.filter(F.size("words") > 0).distinct()


def positional_index(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """Postings (term, _id, _th, pos) of ``terms`` in docs(_id, _th, _text), written to the shared folder."""
    words = docs.select(*DOC, F.posexplode(split_words(F.col("_text"))).alias("pos", "term"))
    known = _small(terms, F.octet_length("term") + 24)
    return materialize(words.join(known, "term").select("term", *DOC, "pos"), "postings")


def windows_of(items: DataFrame, freq: DataFrame, window: int) -> DataFrame:
    """(item, from, length, rare): the windows that may occur, with the item positions of their two rarest terms."""
    each = items.select(
        F.xxhash64("item", "words").alias("no"),
        F.explode(F.sequence(F.lit(0), F.greatest(F.size("words") - window, F.lit(0)))).alias("from"),
        "words",
    )
    each = each.select("no", "from", F.posexplode(F.slice("words", F.col("from") + 1, window)).alias("k", "term"))
    each = each.join(freq, "term", "left").groupBy("no", "from").agg(
        F.sort_array(F.collect_list(F.struct(F.coalesce("df", F.lit(0)).alias("df"), (F.col("from") + F.col("k")).alias("at"), "term"))).alias("by"),
    )
    return each.filter(F.col("by")[0]["df"] > 0).select("no", "from", F.slice("by", 1, 2).alias("rare"))


def find_phrases(docs: DataFrame, items: DataFrame, window: int = 13) -> DataFrame:
    """Candidate alignments (_id, _th, no, diag): an item's words may start at document position ``diag``.

    For some window of the item both rarest terms stand where they must.
    """
    terms = items.select(F.explode("words").alias("term")).distinct()
    postings = positional_index(docs, terms)
    freq = materialize(postings.groupBy("term").agg(F.count("*").alias("df")), "frequencies")
    windows = windows_of(items, freq, window)
    anchors = windows.select("no", F.explode("rare").alias("r")).select("no", F.col("r.at").alias("at"), F.col("r.term").alias("term")).distinct()
    anchors = _small(anchors, F.octet_length("term") + 48)
    hits = postings.join(anchors, "term").select(*DOC, "no", (F.col("pos") - F.col("at")).alias("diag"), "at")
    hits = hits.groupBy(*DOC, "no", "diag").agg(F.collect_set("at").alias("seen"))
    needs = windows.groupBy("no").agg(F.collect_set(F.array(F.col("rare")[0]["at"], F.element_at("rare", -1)["at"])).alias("pairs"))
    both = F.exists("pairs", lambda p: F.array_contains(F.col("seen"), p[0]) & F.array_contains(F.col("seen"), p[1]))
    return hits.join(needs, "no").filter(both).select(*DOC, "no", "diag")


def decontaminate(
    df: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_id: str = "item_id", item_text: str = "text", window: int = 13
) -> DataFrame:
    """All rows of ``df`` with n_words, n_hit, items (sorted ids as strings), n_items and contaminated.

    A word is hit if it lies in an occurrence of an item's window; a document is
    contaminated if any word and at least a twentieth of its words are hit.
    Input columns with the new names are replaced.
    """
    names = other_columns(df, ["n_words", "n_hit", "items", "n_items", "contaminated"])
    key = [id_key(df, id_col).alias("_id"), F.xxhash64(F.col(text_col)).alias("_th")]
    docs = df.select(*key, F.col(text_col).alias("_text"))
    items = materialize(item_words(benchmark, item_id, item_text), "items")
    found = find_phrases(docs, items, window)
    bodies = items.select(F.xxhash64("item", "words").alias("no"), "item", F.col("words").alias("want"))
    bodies = _small(bodies, F.aggregate("want", F.lit(64).cast("long"), lambda n, w: n + F.octet_length(w) + 24))
    found = found.join(bodies, "no").groupBy(*DOC).agg(F.collect_list(F.struct("item", "diag", "want")).alias("_found"))
    base = df.select(*key, F.struct(*[F.col(f"`{c}`") for c in names]).alias("_row"), F.col(text_col).alias("_text"))
    joined = base.join(found, DOC, "left").select("_row", "_found", split_words(F.col("_text")).alias("_w"))

    def starts(c: Column) -> Column:  # of the item's windows that stand in the text, as document positions
        n = F.size(c["want"])
        length = F.least(n, F.lit(window))
        equal = F.transform(c["want"], lambda w, k: F.coalesce(F.get(F.col("_w"), c["diag"] + k) == w, F.lit(False)))
        whole = F.filter(F.sequence(F.lit(0), n - length), lambda i: F.forall(F.slice(equal, i + 1, length), lambda x: x))
        return F.transform(whole, lambda i: F.struct((c["diag"] + i).alias("at"), length.alias("length")))

    met = F.filter(F.transform("_found", lambda c: F.struct(c["item"].alias("item"), starts(c).alias("at"))), lambda m: F.size(m["at"]) > 0)
    joined = joined.select("_row", count_words(F.col("_w")).alias("_n"), F.coalesce(met, F.array().cast("array<struct<item:string,at:array<struct<at:int,length:int>>>>")).alias("_met"))
    spans = F.flatten(F.transform("_met", lambda m: m["at"]))
    hit = F.array_distinct(F.flatten(F.transform(F.array_distinct(spans), lambda s: F.sequence(s["at"], s["at"] + s["length"] - 1))))
    joined = joined.select(
        "_row", "_n", F.size(hit).cast("long").alias("_hit"), F.sort_array(F.array_distinct(F.transform("_met", lambda m: m["item"]))).alias("_items")
    )
    out = joined.select(
        *[F.col("_row").getField(c).alias(c) for c in names],
        F.col("_n").alias("n_words"), F.col("_hit").alias("n_hit"), F.col("_items").alias("items"), F.size("_items").cast("long").alias("n_items"),
        ((F.col("_hit") > 0) & (F.col("_hit") * 20 >= F.col("_n"))).alias("contaminated"),
    )
    # Behind a one-row generator: a caller's filter is not pushed below it, which would copy the comparison into itself.
    return out.select(F.inline(F.array(F.struct(*[F.col(f"`{c}`") for c in out.columns]))))


def near_phrases(docs: DataFrame, items: DataFrame, reach: int) -> DataFrame:
    """Proximity matches (_id, _th, no, pos): around an occurrence of the item's rarest term, at most ``reach``
    words away, stand all its distinct terms.
    """
    terms = items.select(F.xxhash64("item", "words").alias("no"), F.explode("words").alias("term")).distinct()
    postings = positional_index(docs, terms.select("term").distinct())
    freq = postings.groupBy("term").agg(F.count("*").alias("df"))
    rarest = terms.join(freq, "term", "left").groupBy("no").agg(
        F.min(F.struct(F.coalesce("df", F.lit(0)).alias("df"), "term")).alias("r"), F.count("*").alias("need")
    )
    rarest = rarest.filter("r.df > 0").select("no", "need", F.col("r.term").alias("term"))
    middle = postings.join(rarest, "term").select(*DOC, "no", "need", F.col("pos").alias("mid"))
    around = middle.join(terms, "no").withColumn("block", F.explode(F.array(*[(F.col("mid") / F.lit(reach + 1)).cast("int") + d for d in (-1, 0, 1)])))
    there = postings.withColumn("block", (F.col("pos") / F.lit(reach + 1)).cast("int"))
    seen = around.join(there, [*DOC, "term", "block"]).filter(F.abs(F.col("pos") - F.col("mid")) <= reach)
    return seen.groupBy(*DOC, "no", "mid", "need").agg(F.countDistinct("term").alias("n")).filter("n = need").select(*DOC, "no", F.col("mid").alias("pos"))
