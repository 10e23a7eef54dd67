"""Phrase mining, fill-in-the-middle and byte-level BPE against brute force, and on odd rows."""

from __future__ import annotations

import collections
import hashlib
import random
import re

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from pyspark.sql import functions as F

from martloom.llm import byte_bpe, fill_middle, phrases, queries
from martloom.llm.common import ready
from martloom.llm.packed import pack_ints, pack_words, unpack_ints, unpack_words

SF = "/root/testdata/sf0.001"
ODD = [None, "", "   ", "\n", "x", "x" * 5000, " a  b ", "Größe, né. ,. a.)  b!! don't", "<P>x", "a<S", "𝄞 𝄞　é́ \x0b z", "'s 's it's ''s", "1 12\t 3  4\r\n5", "<|endoftext|> İ̧\u0000\x1c"]
DOCS = "doc_id long, text string, lang string, row string, n long, cut int, ids string, block int, form string, word string, first int, size int"
RANKS = public_tokenizers.path(queries.BYTE_RANKS)


def table(spark, texts, langs=None, ids=None):
    """Documents with extra columns whose names the operators use inside."""
    ready(spark)
    langs = langs if langs is not None else ["en"] * len(texts)
    ids = ids if ids is not None else list(range(len(texts)))
    return spark.createDataFrame(
        [(i, t, g, "r", 7, 8, "z", 9, "f", "w", 1, 2) for i, t, g in zip(ids, texts, langs)], DOCS
    )


def random_texts(n, seed, alphabet="abcdeé .,'\n\t1 "):
    r = random.Random(seed)
    return ["".join(r.choice(alphabet) for _ in range(r.randrange(0, 300))) for _ in range(n)]


# ---- phrases ----------------------------------------------------------------------------------


def brute_phrases(rows, least, most, top, percent=50):
    totals, counts = collections.Counter(), collections.defaultdict(collections.Counter)
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    for lang, text in rows:
        lang = lang or "und"
        for piece in re.split("[.,;:!?\x0a-\x0d]", (text or "").translate(lower)):
            words = re.findall("[^\x20\x09]+", piece)
            totals[lang] += len(words)
            for size in range(1, most + 1):
                for i in range(len(words) - size + 1):
                    counts[lang][tuple(words[i : i + size])] += 1
    out = []
    for lang, own in counts.items():
        found = {p: a for p, a in own.items() if len(p) > 1 and a >= least}
        longest = collections.Counter()
        for p, a in found.items():
            for size in range(2, len(p)):
                for i in range(len(p) - size + 1):
                    longest[p[i : i + size]] = max(longest[p[i : i + size]], a)
        kept = []
        for p, a in found.items():
            if 100 * longest[p] >= percent * a:
                continue
            score, _, left, right = min(
                (1000000 * a * a // (own[p[:k]] * own[p[k:]]), k, own[p[:k]], own[p[k:]]) for k in range(1, len(p))
            )
            kept.append((-score, -a, " ".join(p).encode(), left, right))
        for rank, (s, a, p, left, right) in enumerate(sorted(kept)[:top], 1):
            out.append((lang, rank, p.decode(), -a, left, right, totals[lang], -s))
    return sorted(out)


def mined(docs, least=10, most=3, top=2000, listed=phrases.LISTED):
    scored = phrases.score_phrases(*phrases.mine_phrases(docs, least, most, listed))
    ranked = phrases.rank_phrases(phrases.without_parts(scored), top)
    return sorted(tuple(r) for r in ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())


def word_texts(n, seed):
    """Texts of few words, so that phrases repeat, in three languages and none."""
    r = random.Random(seed)
    words = ["the", "of", "The", "né", "x", "y2", "a-b", "(c", "d)", "\x1c"] + [f"w{i}" for i in range(30)]
    rows = []
    for _ in range(n):
        body = "".join(
            r.choice(words[: r.choice((3, 8, 40))]) + r.choice((" ", " ", " ", "  ", "\t", ". ", ",", "\n", "?")) for _ in range(r.randrange(60))
        )
        rows.append((r.choice(("en", "fr", None, "und")), body))
    return rows


@pytest.mark.parametrize("listed,most", [(phrases.LISTED, 3), (12, 3), (0, 3), (phrases.LISTED, 4), (9, 4), (40, 2)])
def test_phrases_equal_brute_force_with_any_list(spark, listed, most):
    rows = word_texts(250, 5)
    docs = table(spark, [t for _, t in rows], [g for g, _ in rows]).repartition(5)
    assert mined(docs, 6, most, 50, listed) == brute_phrases(rows, 6, most, 50)


def test_phrases_of_odd_rows_and_none(spark):
    rows = [("en", t) for t in ODD] * 12
    docs = table(spark, [t for _, t in rows], [g for g, _ in rows])
    want = brute_phrases(rows, 10, 3, 2000)
    assert mined(docs) == want and want
    assert mined(docs.limit(0)) == []
    assert mined(table(spark, [None, "", "  "])) == []


def test_dense_and_sparse_tiles_count_alike(monkeypatch):
    monkeypatch.setattr(phrases, "HELD", 5000)
    monkeypatch.setattr(phrases, "DENSE", 40)
    r = np.random.default_rng(3)
    first, last = (np.minimum(r.zipf(1.3, 40000), 1 << 20).astype(np.int64) - 1 for _ in range(2))
    tiles = phrases.Tiles()
    for i in range(0, 40000, 700):
        tiles.add(first[i : i + 700], last[i : i + 700])
    assert tiles.dense
    got = {(k >> 32, k & 0xFFFFFFFF): n for k, n in zip(*(x.tolist() for x in tiles.counted()))}
    assert got == collections.Counter(zip(first.tolist(), last.tolist()))
    assert len(tiles.counted()[0]) == 0


def test_scores_are_exact_beyond_64_bits(spark):
    ready(spark)
    a, left, right = 999_999_937_001, 5_000_000_000_003, 9_999_999_999_999
    totals = spark.createDataFrame([("en", 1)], "lang string, n long")
    words = spark.createDataFrame([("en", "x", left), ("en", "y", right)], "lang string, phrase string, n long")
    found = spark.createDataFrame([("en", "x y", 2, a)], "lang string, phrase string, size int, n long")
    row = phrases.score_phrases(totals, words, found).first()
    assert row["score"] == 1000000 * a * a // (left * right) and (row["l"], row["r"]) == (left, right)


# ---- fill in the middle -----------------------------------------------------------------------


def brute_fill(doc_id, text, seed=42, fim_percent=50, spm_percent=80):
    text = text or ""
    units = re.findall(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+", text)
    h = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * i : 8 * i + 8], 16) for i in range(4))
    n = len(units)
    i, j = sorted((h1 % (n + 1), h2 % (n + 1)))
    prefix, middle, suffix = "".join(units[:i]), "".join(units[i:j]), "".join(units[j:])
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= fim_percent:
        return n, "plain", None, None, text
    if h4 % 100 < spm_percent:
        return n, "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return n, "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


@pytest.mark.parametrize("percent", [50, 100])
def test_fill_equals_brute_force(spark, percent):
    texts = ODD + random_texts(150, 8) + ["<P><", "x <P", "y<S>", "w " * 3000 + "v" * 4000 + " u" * 3000]
    ids = [None, *range(1, len(texts) - 1), 3]
    got = fill_middle.fill_in_middle(table(spark, texts, ids=ids).repartition(4), fim_percent=percent)
    got = got.withColumn("back", fill_middle.restore(F.col("output"), F.col("form"))).collect()
    key = lambda r: (str(r[0]), r[1] or "")
    have = sorted(((r["row"]["doc_id"], r["row"]["text"], r["n"], r["form"], r["prefix_chars"], r["middle_chars"], r["output"]) for r in got), key=key)
    want = sorted(((i, t, *brute_fill(i, t, fim_percent=percent)) for i, t in zip(ids, texts)), key=key)
    assert have == want
    assert all(r["back"] == (r["row"]["text"] or "") and r["row"]["n"] == 7 for r in got)
    assert {r["form"] for r in got} == {"plain", "spm", "psm"}
    assert fill_middle.fill_in_middle(table(spark, texts).limit(0)).count() == 0


@pytest.mark.parametrize("error", [0, 1, 5, 127, 1000])
def test_rank_index_is_exact_and_bounded(error):
    texts = [t or "" for t in ODD] + random_texts(60, 9) + ["w " * 5000 + "v" * 4000 + " é" * 5000]
    index = fill_middle.index_texts(pa.array(texts), error)
    assert np.abs(index.residual).max() <= error
    for i, text in enumerate(texts):
        ends = [0, *(m.end() for m in re.finditer(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+", text))]
        ranks = np.arange(len(ends))
        assert index.units[i] == len(ends) - 1
        assert index.offsets(np.full(len(ends), i), ranks).tolist() == ends
    # A line stands for many ranks where words are alike.
    even = fill_middle.index_texts(pa.array(["abc " * 10000]), 1)
    assert len(even.segment) < 20


# ---- byte-level BPE ---------------------------------------------------------------------------


def whole():
    return tiktoken.Encoding(
        "whole", pat_str=public_tokenizers.PATTERN, mergeable_ranks=byte_bpe.read_ranks(RANKS), special_tokens={}
    )


def odd_unicode(n, seed):
    r = random.Random(seed)
    letters = "aé'sßİ̧́٠١२ 　\xa0\n\t\r\x0b\x1c\x85.,!😀𝄞字かな한‍­﻿"
    return ["".join(r.choice(letters) if r.random() < 0.7 else chr(r.choice((r.randrange(1, 0xD800), r.randrange(0xE000, 0x110000)))) for _ in range(r.randrange(40))) for _ in range(n)]


@pytest.mark.parametrize("block,stream", [(byte_bpe.BLOCK_CHARS, byte_bpe.STREAM_CHARS), (500, 90)])
def test_bytes_equal_the_library_and_come_back(spark, block, stream):
    texts = ODD + random_texts(80, 11) + odd_unicode(600, 12) + ["again"] * 5
    ids = [None, *range(len(texts) - 2), 3]
    docs = table(spark, texts, ids=ids).repartition(3)
    coded = byte_bpe.encode(docs, RANKS, public_tokenizers.PATTERN, block_chars=block, stream_chars=stream)
    got = coded.withColumn("back", byte_bpe.decode(F.col("ids"), RANKS)).collect()
    coder = whole()
    assert sorted((str(r["row"]["doc_id"]), r["row"]["text"] or "") for r in got) == sorted(
        (str(i), t or "") for i, t in zip(ids, texts)
    )
    for r in got:
        want = coder.encode_ordinary(r["row"]["text"] or "")
        assert np.frombuffer(r["ids"], "<u4").tolist() == want and r["n_tokens"] == len(want)
        assert bytes(r["back"]).decode() == (r["row"]["text"] or "") and r["row"]["block"] == 9


def test_bytes_of_nothing(spark):
    docs = table(spark, [None, "", None])
    coded = byte_bpe.encode(docs, RANKS, public_tokenizers.PATTERN, keep=["doc_id"])
    assert [(r["n_tokens"], bytes(r["ids"])) for r in coded.collect()] == [(0, b"")] * 3
    assert byte_bpe.encode(docs.limit(0), RANKS, public_tokenizers.PATTERN).count() == 0
    ids = spark.createDataFrame([(None,), (b"",), (np.array([3, 256], "<u4").tobytes(),)], "ids binary")
    got = [r[0] for r in ids.select(byte_bpe.decode(F.col("ids"), RANKS)).collect()]
    back = {v: k for k, v in byte_bpe.read_ranks(RANKS).items()}
    assert got == [None, b"", back[3] + back[256]]


def test_each_word_is_encoded_once():
    """The worker that holds a bucket's lists encodes a word for the first of them only."""
    calls = []

    class Coder:
        def _encode_single_piece(self, word):
            calls.append(word)
            return [len(word)] * 2

    lists = [(b, k, [w for w in (b"a", b"bb", b"ccc", b"dd") if (len(w) + w[0]) % 2 == k]) for k in (0, 1) for b in range(5)]
    rows = []
    for block, bucket, words in lists:
        body, sizes = pack_words(words)
        rows.append((block, bucket, pack_ints(np.arange(len(words))), body, sizes))
    names = ["block", "bucket", "numbers", "body", "sizes"]
    batches = [pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*part)], names) for part in (rows[:3], rows[3:8], rows[8:])]
    original, tiktoken.Encoding = tiktoken.Encoding, lambda *a, **k: Coder()
    try:
        out = [r for b in byte_bpe._encode_words(RANKS, ".")(iter(batches)) for r in b.to_pylist()]
    finally:
        tiktoken.Encoding = original
    assert sorted(calls) == [b"a", b"bb", b"ccc", b"dd"]
    assert [(r["block"], unpack_ints(r["ids"]).tolist()) for r in out] == [(b, [len(w) for w in ws for _ in "xx"]) for b, _, ws in lists]


@pytest.mark.parametrize("values", [[], [0], [255, 256, 0], [1 << 40, 3], [(1 << 63) - 1, 0]])
def test_packed_numbers_and_words(values):
    assert unpack_ints(pack_ints(np.array(values, dtype=np.int64))).tolist() == values
    words = [b"x" * (v % 50) for v in values]
    assert unpack_words(*pack_words(words)) == words


def test_streams_are_not_shuffled(spark):
    ready(spark)
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    coded = byte_bpe.encode(docs, RANKS, public_tokenizers.PATTERN, keep=["doc_id"])
    plan = coded._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 2, plan


def test_byte_query_equals_the_library(spark):
    got = {r["doc_id"]: r for r in queries.QUERIES["op13_byte_bpe"](spark, SF).collect()}
    coder = whole()
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    assert len(got) == len(rows)
    for doc_id, text in rows:
        ids = coder.encode_ordinary(text or "")
        assert got[doc_id]["n_tokens"] == len(ids)
        assert got[doc_id]["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert got[doc_id]["decoded_sha256"] == hashlib.sha256((text or "").encode()).hexdigest()
