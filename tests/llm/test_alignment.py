"""Cross-tokenizer alignment against whole-text encoding and plain Python."""

from __future__ import annotations

import hashlib
import random
from collections import Counter, defaultdict

import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tests.llm.helpers import SF, awkward, frame, prose
from tidemark.llm import alignment as L
from tidemark.llm import queries as Q

A, B = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "piece_bpe_32k.model"))


class Brute:
    def __init__(self):
        self.a, self.b = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
        self.a.encode_special_tokens = True
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        table = dict(zip(plain, plain, strict=True))
        n = 256
        for x in range(256):
            if x not in table:
                table[x], n = n, n + 1
        self.letters = {chr(c): x for x, c in table.items()}

    def tokens(self, text):
        """Ids with their bytes of both sides; None if they do not spell the text."""
        if not text:
            return None
        a = [(i, bytes(self.letters[c] for c in self.a.id_to_token(i))) for i in self.a.encode(" " + text, add_special_tokens=False).ids]
        b = []
        for i in self.b.encode(text):
            p = self.b.id_to_piece(i)
            b.append((i, bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode()))
        want = (" " + text).encode()
        return (a, b) if b"".join(x for _, x in a) == want == b"".join(x for _, x in b) else None

    def rows(self, texts):
        found, count = [], Counter()
        for t in texts:
            both = self.tokens(t)
            if both is None:
                found.append(None)
                continue
            spans = []
            for side in both:
                at, out = 0, []
                for i, x in side:
                    out.append((i, at, at + len(x)))
                    at += len(x)
                spans.append(out)
            ends = sorted({e for _, _, e in spans[0]} & {e for _, _, e in spans[1]})
            groups, lo = [], 0
            for e in ends:
                groups.append("|".join(",".join(str(i) for i, s, _ in side if lo <= s < e) for side in spans))
                lo = e
            links, k = [], 0
            for i, s, e in spans[0]:
                while spans[1][k][2] <= s:
                    k += 1
                m = k
                while m < len(spans[1]) and spans[1][m][1] < e:
                    links.append((i, spans[1][m][0]))
                    m += 1
            count.update(set(links))
            found.append((len(spans[0]), len(spans[1]), groups, links))
        best = defaultdict(int)
        for (i, _), n in count.items():
            best[i] = max(best[i], n)
        out = []
        for f in found:
            if f is None:
                out.append((0,) * 6 + ("",))
                continue
            na, nb, groups, links = f
            sha = hashlib.sha256(";".join(groups).encode()).hexdigest()
            out.append((na, nb, len(groups), len(links), sum(count[x] == best[x[0]] for x in links), sum(count[x] for x in links), sha))
        return out, {(a, b, n, n == best[a]) for (a, b), n in count.items()}


@pytest.fixture(scope="module")
def brute():
    return Brute()


def odd_texts():
    return [
        *awkward(), " ", "   ", "a ", "a  ", " a", "  a\n", "\n", "\n\n a \t b", "a▁b", "x ▁ y", "<|endoftext|> and <s> </s> <unk> <0x0A>", "it's  we'll  x　 y",
        "a\x00b \x1c c", "é ́ ​‍ ﻿", "東京 は 夜", "😀😀 👩‍👩‍👧", "don't can't 's", "1234567 89,0.1", "a" * 3000, " " * 500 + "x", "\r\n\r\n y",
    ]


def got(df):
    return {r["doc_id"]: tuple(r[c] for c in L.Alignment.RESULTS) for r in df.collect()}


@pytest.mark.parametrize("block_bytes", [4 << 20, 64])
def test_alignment_equals_brute_force(spark, brute, block_bytes):
    """Small blocks cut long texts into runs and corpus counts into many parts."""
    texts = odd_texts()
    if block_bytes == 64:
        texts = texts[:15] + texts[16:] + [prose(3, 300, 90) + " a▁b " + prose(4, 100)]
    made = L.Alignment(frame(spark, texts).repartition(3), A, B, block_bytes=block_bytes)
    want, pairs = brute.rows(texts)
    assert got(made.documents()) == dict(enumerate(want))
    assert {tuple(r) for r in made.pairs().collect()} == pairs


def test_pieces_encode_like_whole_texts(brute):
    rng = random.Random(7)
    parts = ["a", "é", "the", "'s", "'", "1", "23", ".", "!?", " ", " ", "  ", "\n", "\t", " ", "　", " ", "東", "😀", "́", "<s>", "<|endoftext|>", "\x00", "Xx", "_", " ", "\u0085"]
    pair = L.Pair(A, B)
    assert pair.cuts
    texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(1, 25))) for _ in range(4000)]
    counts, digests, *_ = L.align_texts(pair, pa.array(texts, pa.large_string()), 1 << 20)
    for k, t in enumerate(texts):
        both = brute.tokens(t)
        assert (counts["n_a"][k], counts["n_b"][k]) == ((0, 0) if both is None else tuple(map(len, both))), repr(t)
    rows, _ = brute.rows(texts)
    assert digests == [r[-1] for r in rows]


def test_nulls_repeated_rows_clashing_columns_and_empty(spark):
    texts = [prose(1, 30), prose(1, 30), None, "", prose(2, 30)]
    df = frame(spark, texts, [1, 1, None, 2, None]).withColumn("n_a", F.lit("old")).withColumn("_block", F.lit("mine")).withColumn("_row", F.lit(1))
    out = L.align_tokenizers(df, A, B)
    assert out.columns == ["doc_id", "text", "lang", "source", "n_chars", "_block", "_row", *L.Alignment.RESULTS]
    rows = out.collect()
    assert sorted(r["n_a"] > 0 for r in rows) == [False, False, True, True, True] and {r["_block"] for r in rows} == {"mine"}
    assert len({r["groups_sha256"] for r in rows}) == 3
    assert L.align_tokenizers(df.limit(0), A, B).count() == 0
    assert L.align_tokenizers(df.filter("text IS NULL OR text = ''"), A, B).filter("n_a = 0 AND count_sum = 0").count() == 2


def test_op12_on_the_small_tables(spark, brute):
    docs = Q.table(spark, SF, "documents").select("doc_id", "text").collect()
    want, _ = brute.rows([d["text"] for d in docs])
    assert got(Q.op12_tokenizer_alignment(spark, SF)) == {d["doc_id"]: w for d, w in zip(docs, want, strict=True)}
