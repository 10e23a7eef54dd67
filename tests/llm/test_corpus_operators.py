"""Each corpus operator on small tables with odd rows, and its query against brute force."""

from __future__ import annotations

import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from martloom.llm import (
    bagminhash,
    brown,
    components,
    decontaminate,
    embedding_dedup,
    packing,
    pii,
    preference,
    queries,
    token_counts,
    toxicity,
    url_filter,
)
from martloom.llm.common import ready, utf8, words_of
from martloom.llm.packed import unpack_ints, unpack_words
from martloom.session import settle

SF = "/root/testdata/sf0.001"
ODD = [None, "", "   ", "x", "x" * 5000, "Größe, né. ,. a.)  b!! don't", "<|endoftext|> <s> ▁▁a\n\n b"]
DOCS = "doc_id long, text string, row string, score double, found int, result int"


@pytest.fixture(scope="module")
def sf(spark):
    ready(spark)
    return {
        name: spark.read.parquet(f"{SF}/{name}.parquet")
        for name in ("documents", "benchmark", "labels", "embeddings")
    }


@pytest.fixture(scope="module")
def texts(sf):
    return {r["doc_id"]: r["text"] or "" for r in sf["documents"].collect()}


def table(spark, texts, ids=None):
    """Documents with extra columns whose names the operators use inside."""
    ready(spark)
    ids = ids if ids is not None else list(range(len(texts)))
    return spark.createDataFrame([(i, t, "r", 0.5, 1, 2) for i, t in zip(ids, texts)], DOCS)


def odd(spark):
    """Odd texts, a NULL id, and a repeated row."""
    return table(spark, [*ODD, "null id", "again", "again"], [*range(len(ODD)), None, 50, 50])


# ---- toxicity ---------------------------------------------------------------------------------


def test_toxicity_learns_and_keeps_every_row(spark):
    r = random.Random(1)
    plain = ["".join(r.choice("abcdef") for _ in range(5)) for _ in range(300)]
    rows = []
    for i in range(300):
        words = [r.choice(plain) for _ in range(30)]
        if i % 3 == 0:
            words.insert(r.randrange(30), r.choice(["zworm", "zqueak"]))
        rows.append(" ".join(words))
    docs = table(spark, rows)
    labels = spark.createDataFrame(
        [(i, int(i % 3 == 0)) for i in range(200)] + [(None, 1), (5, None), (7, 9)], "doc_id long, toxic int"
    )
    model = toxicity.fit(toxicity.labelled_sample(docs, labels))
    got = {r["row"]["doc_id"]: r for r in toxicity.score_toxicity(docs, model).collect()}
    right = sum(got[i]["predicted"] == (i % 3 == 0) for i in range(200, 300))
    assert right >= 97 and got[1]["row"]["score"] == 0.5
    scored = toxicity.score_toxicity(odd(spark), model).collect()
    assert len(scored) == len(ODD) + 3 and all(0 <= s["score"] <= 1 for s in scored)
    assert toxicity.score_toxicity(odd(spark).limit(0), model).count() == 0


def test_toxicity_learns_beside_many_copies_of_a_long_text(spark):
    """A third of the labelled rows is one clean text with thousands of n-grams."""
    r = random.Random(2)
    word = lambda: "".join(r.choice("abcdefghijklmnop") for _ in range(8))
    plain, long = [word() for _ in range(200)], " ".join(word() for _ in range(4000))
    toxic = ["zworm", "zqueak", "zvlyx", "zdrozz", "zhuxt", "zkyrt", "xsquv", "wrytz", "qwust", "vuxor"]
    rows = [long] * 150
    for i in range(400):
        words = [r.choice(plain) for _ in range(30)]
        if i % 10 < 3:
            words.insert(r.randrange(30), toxic[i // 10 % 10])
        rows.append(" ".join(words))
    docs = table(spark, rows)
    labels = spark.createDataFrame(
        [(i, int(i >= 150 and (i - 150) % 10 < 3)) for i in range(450)], "doc_id long, toxic int"
    )
    model = toxicity.fit(toxicity.labelled_sample(docs, labels))
    got = {r["row"]["doc_id"]: r["predicted"] for r in toxicity.score_toxicity(docs, model).collect()}
    right = sum(got[i] == ((i - 150) % 10 < 3) for i in range(450, 550))
    assert right >= 95 and not got[0], right


def test_toxicity_without_labels_or_with_one(spark):
    docs = odd(spark)
    none = toxicity.fit(toxicity.labelled_sample(docs, spark.createDataFrame([], "doc_id long, toxic int")))
    one = toxicity.fit(
        toxicity.labelled_sample(docs, spark.createDataFrame([(5, 1), (3, 1)], "doc_id long, toxic int"))
    )
    assert none.bias == 0 and not none.weights
    assert one.bias == pytest.approx(math.log(3)) and not one.weights


def test_grams_stay_inside_words():
    owner, bucket = toxicity.grams(["ab", "c", "abcd"])
    alone = [set(toxicity.grams([w])[1].tolist()) for w in ("ab", "c", "abcd")]
    for i, own in enumerate(alone):
        assert set(bucket[owner == i].tolist()) == own
    assert [len(a) for a in alone] == [3, 1, 9]  # " ab", "ab ", " ab " / " c " / 4 + 3 + 2


# ---- language model ---------------------------------------------------------------------------


def test_language_model_base_and_mass(spark, sf, texts):
    got = {r["doc_id"]: r for r in queries.QUERIES["op2_lm_scoring"](spark, SF).collect()}
    own = {d: brown.tokens_of(t.encode()) + [b""] for d, t in texts.items()}
    held = {d: zlib.crc32(str(d).encode()) % 5 == 1 for d in texts}
    counts = collections.Counter(w for d in own if not held[d] for w in own[d])
    n, v = sum(counts.values()), len(counts)
    for d, words in own.items():
        base = sum(math.log10((counts[w] + 0.5) / (n + 0.5 * (v + 1))) for w in words)
        assert got[d]["base_score"] == pytest.approx(base, abs=1e-6)
        assert (got[d]["n_tokens"], got[d]["train_tokens"]) == (len(words), n)
        assert got[d]["n_known"] == sum(counts[w] > 0 for w in words)
        assert got[d]["held_out"] == held[d]
    out = [d for d in own if held[d]]
    assert sum(got[d]["score"] for d in out) > sum(got[d]["base_score"] for d in out)


@pytest.mark.parametrize("head, dictionary", [(brown.HEAD, brown.DICTIONARY), (9, 20), (9, 9), (0, 0)])
def test_language_model_is_a_distribution(spark, head, dictionary):
    """From the first state, all known words, the end and the unseen of each ending sum to 1."""
    words = [f"w{i % 7}{chr(97 + i % 11)}" for i in range(60)]
    docs = table(spark, [" ".join(words[i : i + 9]) for i in range(52)])
    model = brown.fit(docs.select(utf8("text").alias("text")), head, dictionary)
    known = sorted(set(words))
    rare = {r["word"]: r["class"] for r in model.rare.collect()}
    class_of = {**rare, **{w.decode(): k for w, k in zip(model.words, model.classes.tolist())}}
    assert sorted(class_of) == known and (dictionary > 60) == (not rare)
    fresh = {}
    for i in range(20000):
        w = f"q{i}".encode()
        fresh.setdefault(brown.ending(w), w.decode())
    for e, w in fresh.items():
        class_of[w] = model.ending_classes[e - brown.HEAD]
    probes = table(spark, ["", *known, *fresh.values()])
    score = {r["doc_id"]: r["score"] for r in brown.score(probes, model).collect()}
    after = [model.step[class_of[w], -1] for w in [*known, *fresh.values()]]
    total = 10 ** score[0] + sum(10 ** (score[i] - a) for i, a in enumerate(after, 1))
    assert total <= 1 + 1e-6
    assert len(fresh) == brown.ENDINGS and total == pytest.approx(1, abs=1e-6)


@pytest.mark.parametrize("dictionary", [12, 40, 10_000])
def test_language_model_classes_against_brute_force(spark, dictionary):
    """Every training word, however rare, takes its class from its own neighbours; class pairs and
    scores are those of plain loops over the whole path."""
    r = random.Random(4)
    names = [f"{a}{b}" for a in "abcdefgh" for b in ("un", "de", "ist", "x")] + [f"r{i}" for i in range(80)]
    odds = [1 / (i + 1) for i in range(len(names))]
    texts = [" ".join(r.choices(names, odds, k=r.randint(0, 14))) for _ in range(250)]
    docs = table(spark, texts)
    model = brown.fit(docs.select(utf8("text").alias("text")), 8, dictionary)
    class_of = {w.decode(): k for w, k in zip(model.words, model.classes.tolist())}
    rare = {x["word"]: x for x in model.rare.collect()}
    assert not class_of.keys() & rare.keys()
    class_of |= {w: x["class"] for w, x in rare.items()}
    counts = collections.Counter(w for t in texts for w in t.split())
    assert class_of.keys() == counts.keys() and all(x["c"] == counts[w] for w, x in rare.items())

    end = brown.CLASSES - 1
    pairs = np.zeros((brown.CLASSES, brown.CLASSES))
    for t in texts:
        path = [end, *[class_of[w] for w in t.split()], end]
        for a, b in zip(path, path[1:]):
            pairs[a, b] += 1
    assert (pairs == model.pairs).all()

    head = {w for w in model.words[:8]}
    probes = ["", "unseen", "r1 r2 unseen other r3 aun", "r70 r71 r72 r73", " ".join(names), *texts[:40]]
    got = {x["doc_id"]: x for x in brown.score(table(spark, probes), model).collect()}
    for i, t in enumerate(probes):
        before, total = end, 0.0
        for w in t.split():
            e = brown.ending(w.encode()) - brown.HEAD
            k = class_of.get(w, model.ending_classes[e])
            total += model.step[before, k]
            if w in counts:
                c = counts[w] - (0 if w.encode() in head else model.taken[k])
                total += math.log10(c) - model.norm[k]
            else:
                total += model.unknown[e]
            before = k
        total += model.step[before, end]
        assert got[i]["score"] == pytest.approx(total, abs=1e-9)
        assert got[i]["n_known"] == 1 + sum(w in counts for w in t.split())


def test_word_classes_follow_the_neighbours(spark):
    """Rows of a word may come from many tasks; its class is that of greatest likelihood of all."""
    ready(spark)
    rng = np.random.default_rng(3)
    likely = np.log(rng.dirichlet(np.ones(brown.CLASSES), 2 * brown.CLASSES))
    endings = np.zeros((brown.ENDINGS, 2 * brown.CLASSES))
    rows, whole = [], collections.defaultdict(lambda: np.zeros(2 * brown.CLASSES))
    for i in range(3000):
        word = f"w{i % 700 if i < 1500 else 5}"
        codes = np.sort(rng.choice(2 * brown.CLASSES, rng.integers(1, 30), replace=False))
        counts = rng.integers(1, 400, len(codes))
        whole[word][codes] += counts
        rows.append((word, bytearray(codes.astype(np.uint8).tobytes()), bytearray(counts.astype("<u4").tobytes())))
    frame = spark.createDataFrame(rows, "word string, codes binary, counts binary").repartition(7)
    got = {r["word"]: r for r in brown.word_classes(frame, likely, endings).collect()}
    assert got.keys() == whole.keys()
    for word, met in whole.items():
        assert got[word]["c"] == met[: brown.CLASSES].sum()
        assert got[word]["class"] == int(np.argmax((met @ likely)[:-1]))


def test_exchange_gain_is_the_change_of_likelihood():
    rng = np.random.default_rng(2)
    k = brown.CLASSES
    near = rng.integers(0, 4, (k, k)).astype(float)
    after, before = rng.integers(0, 5, k).astype(float), rng.integers(0, 5, k).astype(float)
    def placed(c):
        m = near.copy()
        m[c] += after
        m[:, c] += before
        m[c, c] += 2
        return m
    new, gain = brown.best_class(placed(3), 3, after, before, 2.0)
    change = [brown.likelihood(placed(c)) - brown.likelihood(placed(3)) for c in range(k - 1)]
    assert new == int(np.argmax(change)) and gain == pytest.approx(max(change), abs=1e-6)


def test_language_model_odd_rows_and_empty_training(spark):
    docs = odd(spark)
    model = brown.fit(docs.limit(0).select(utf8("text").alias("text")))
    rows = brown.score(docs, model).collect()
    assert len(rows) == len(ODD) + 3 and all(math.isfinite(r["score"]) for r in rows)
    assert {r["n_known"] for r in rows} == {0} and {r["train_tokens"] for r in rows} == {0}


def test_language_model_blocks_hold_the_texts(spark):
    """One row a block, whatever the number of different words; each word is looked up once a block."""
    texts = [None, "", " \n", "A b\tÄ a", "x\x1cy x\u0085 Z", *[f"w{i} W{i + 1} w{i % 7}" for i in range(1500)]]
    docs = table(spark, texts, [None, *range(1, len(texts))]).select("doc_id", utf8("text").alias("text"))
    own = [brown.tokens_of(t and t.encode()) for t in texts]
    ids = [None, *range(1, len(texts))]
    common = [b"w3", b"never", b"a"]
    for tokens in (1000, brown.BLOCK_TOKENS):
        rows = brown.blocks(docs.coalesce(1), 5, common, tokens).orderBy("block").collect()
        assert len(rows) == (4 if tokens == 1000 else 1)
        got, of = [], []
        for r in rows:
            known = [common[i] for i in unpack_ints(r["common"])] if r["common"] else []
            dealt = [(w, p["bucket"]) for p in r["words"] for w in unpack_words(p["body"], p["sizes"])]
            assert all(zlib.crc32(w) % 5 == b for w, b in dealt)
            number = [b"", *known, *[w for w, _ in dealt]]
            assert len(set(number)) == len(number) and not {w for w, _ in dealt} & set(common)
            stream = [number[i] for i in unpack_ints(r["stream"])]
            assert stream[0] == b""
            got += stream[1:]
            of += r["doc_id"]
        assert of == ids and got == [w for words in own for w in [*words, b""]]
    counts = brown.word_counts(brown.blocks(docs.select("text").repartition(3), 7, tokens=500))
    held = collections.Counter(w.decode() for words in own for w in [*words, b""])
    assert {r["word"]: r["c"] for r in counts.collect()} == held


def test_language_model_over_many_blocks(spark, monkeypatch):
    """Texts scored in many small blocks, of many tasks, get the scores of one block; what joins and
    grouping move are rows of blocks and buckets, not of words."""
    r = random.Random(6)
    texts = [" ".join(f"{'abc'[i % 3]}{r.randrange(4000)}" for i in range(r.randint(0, 30))) for _ in range(1200)]
    docs = table(spark, texts)
    model = brown.fit(docs.select(utf8("text").alias("text")), 8, 20)
    whole = {x["doc_id"]: x for x in brown.score(docs.coalesce(1), model).collect()}
    small = brown.blocks
    monkeypatch.setattr(brown, "blocks", lambda d, buckets, words=(): small(d.repartition(5), buckets, words, 300))
    again = brown.fit(docs.select(utf8("text").alias("text")), 8, 20)
    assert {x["word"]: x["c"] for x in again.rare.collect()} == {x["word"]: x["c"] for x in model.rare.collect()}
    assert again.pairs.sum() == model.pairs.sum() == sum(len(t.split()) + 1 for t in texts)
    split = brown.score(docs, model).collect()
    assert len(split) == len(texts)
    for x in split:
        same = whole[x["doc_id"]]
        assert (x["n_tokens"], x["n_known"]) == (same["n_tokens"], same["n_known"])
        assert x["score"] == pytest.approx(same["score"], abs=1e-9)
        assert x["base_score"] == pytest.approx(same["base_score"], abs=1e-9)


# ---- personal data ----------------------------------------------------------------------------

RULES = (
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    ("card", r"[0-9]([\x20-]?[0-9])+"),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]"),
)


def rule_spans(text):
    out = []
    for k, (name, pattern) in enumerate(RULES):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m.group())
            total = sum(
                (lambda v: v - 9 if v > 9 else v)(int(c) * (1 + i % 2)) for i, c in enumerate(digits[::-1])
            )
            fine = {
                "email": True,
                "ip": name == "ip" and all(int(p) <= 255 for p in m.group().split(".")),
                "card": 12 <= len(digits) <= 19 and total % 10 == 0,
                "phone": 9 <= len(digits) <= 15,
            }[name]
            if fine:
                out.append((m.start(), k, m.end(), name))
    return sorted(out)


def spans_text(text):
    return ",".join(f"{n}:{a}:{e}" for a, _, e, n in rule_spans(text))


def test_rule_spans_against_brute_force(spark, texts):
    r = random.Random(5)
    alphabet = "0123456789" * 3 + "..--  ++@@ab_()\né"
    cases = ["".join(r.choice(alphabet) for _ in range(r.randint(0, 60))) for _ in range(600)]
    cases += ["a@b.c_x@d.e", "1.2.3.4.5.6.7.8", "4111 1111-1111 1111", "5 -4111111111111111", "0001.2.3.255",
              "1" * 3000, "a.b" * 2000, "+1 (605) 555-9305 4078918989542222", "é😀 x@y.zz 😀 10.0.0.1"]
    cases += list(texts.values())
    docs = table(spark, [*cases, *ODD])
    got = {r["row"]["doc_id"]: r for r in pii.find_pii(docs, pii.PiiModel()).withColumn(
        "listed", pii.listed(F.col("base"))).select("row", "listed").collect()}
    for i, text in enumerate([*cases, *ODD]):
        assert got[i]["listed"] == spans_text(text or ""), text


def test_pii_trees_and_thresholds_come_from_all_spans(spark, monkeypatch):
    """9,000 different addresses: more than any sample of them that a fit might draw."""
    n, seen = 9000, {}

    class Spy(pii.GBTClassifier):
        def fit(self, train):
            seen.update({r["label"]: r["w"] for r in train.groupBy("label").agg(F.sum("weight").alias("w")).collect()})
            return super().fit(train)

    monkeypatch.setattr(pii, "GBTClassifier", Spy)
    text = F.expr("concat('write to user', id, '@example.org or user', id, '(at)example.org')").alias("text")
    docs = spark.range(n).select(F.col("id").alias("doc_id"), text)
    model = pii.fit(docs)
    spans = lambda w: 20 * w / (1000 - w)  # noqa: E731  weight 1000 / (n + 20) each
    assert spans(seen[0]) == pytest.approx(2 * n / 3, rel=0.05)
    assert spans(seen[1]) == pytest.approx(8 * 2 * n / 3, rel=0.05)
    assert model.threshold < float("inf")


def test_pii_query_keeps_the_rules_and_adds_only(spark, texts):
    for r in queries.QUERIES["op3_pii"](spark, SF).collect():
        want = spans_text(texts[r["doc_id"]])
        assert r["base_sha256"] == hashlib.sha256(want.encode()).hexdigest()
        assert set(filter(None, want.split(","))) <= set(r["spans"].split(","))
        assert [r[f"n_{k}"] for k in pii.KINDS] == [want.count(k) for k in pii.KINDS]


def test_trees_add_what_misses_a_rule_and_redact(spark):
    r = random.Random(3)
    number = lambda: f"+1 ({r.randint(200, 999)}) 555-{r.randint(1000, 9999)}"
    rows = [f"call {number()} now or {r.randint(10**6, 10**7 - 1)} items" for _ in range(400)]
    model = pii.fit(table(spark, rows))
    assert model.trees and model.threshold < float("inf")
    docs = table(spark, ["call +1 (605) 555-9305 4078918989542222 now", "mail a@b.cc!", None, "1234567 items"])
    found = pii.find_pii(docs, model).withColumn("out", pii.redact(F.col("text"), F.col("spans")))
    out = {x["row"]["doc_id"]: x["out"] for x in found.collect()}
    assert out[0].startswith("call [") and out[1] == "mail [EMAIL]!" and out[2] == ""
    assert out[3] == "1234567 items"
    assert pii.fit(table(spark, ["no numbers"])).trees == ()


def test_trees_add_personal_data_commoner_than_the_rules_find(spark):
    """Phones without '+', addresses in words and cards with other marks, more of them than of rule
    spans; numbers of other shapes stay."""
    r = random.Random(4)
    digits = lambda n: "".join(r.choice("0123456789") for _ in range(n))

    def card():
        body = "4" + digits(14)
        total = sum(sum(divmod(int(c) * (2 - i % 2), 10)) for i, c in enumerate(body))
        return body + str(-total % 10)

    rows, missed, other = [], [], []
    for i in range(600):
        phone = f"({r.randint(200, 999)}) 555-{digits(4)}"
        number, mail = card(), ("".join(r.choice("abcdef") for _ in range(6)), f"mail{i % 9}.example.com")
        if i % 3 == 0:
            rows.append(f"call +1 {phone} or mail {'@'.join(mail)} or pay with {number} now")
            missed.append([])
            continue
        apart = "./"[i % 2].join(number[j : j + 4] for j in range(0, 16, 4))
        words = mail[0] + " (at) " + mail[1].replace(".", " (dot) ")
        rows.append(f"call {phone} or mail {words} or pay with {apart} for {digits(9)} items {digits(18)}0")
        missed.append([("phone", phone), ("email", words), ("card", apart)])
    docs = table(spark, rows)
    found = pii.find_pii(docs, pii.fit(docs))
    wanted, got, wrong = 0, 0, []
    for x in found.collect():
        want = missed[x["row"]["doc_id"]]
        if not want:
            continue
        have = [(pii.KINDS[s["kind"]], s["found"]) for s in x["spans"] if s not in x["base"]]
        wanted, got = wanted + len(want), got + sum(w in have for w in want)
        wrong += [h for h in have if h not in want]
    assert got >= 0.95 * wanted and len(wrong) <= 0.02 * wanted, (wanted, got, wrong)


# ---- URLs -------------------------------------------------------------------------------------


def test_urls_with_odd_rows(spark):
    ready(spark)
    rows = [(1, None), (2, ""), (3, "nothing"), (4, "http://A.Example.ORG/es/x"), (5, "https://b.com/de/1"),
            (6, "https://www.x.net/p.html?q#f"), (7, "x://x.net/p"), (8, "http://org"), (9, "http://c.com/en/1"),
            (9, "http://c.com/en/1"), (None, "http://x.net/q")]
    pages = spark.createDataFrame([(*r, "h") for r in rows], "page_id long, url string, hit string")
    listed = spark.createDataFrame([("x.net/p",), ("x.net/p",), (None,)], "url_key string")
    got = [tuple(r) for r in url_filter.judge_urls(pages, queries.RULES, listed).collect()]
    assert sorted(got, key=str) == sorted(
        [
            (1, "", "", None, "allow"), (2, "", "", None, "allow"), (3, "", "", None, "allow"),
            (4, "a.example.org", "/es/x", "example.org/es/", "block"), (5, "b.com", "/de/1", "com/de/", "block"),
            (6, "www.x.net", "/p.html", None, "block"), (7, "x.net", "/p", None, "block"),
            (8, "org", "", None, "allow"), (9, "c.com", "/en/1", None, "allow"),
            (9, "c.com", "/en/1", None, "allow"), (None, "x.net", "/q", None, "allow"),
        ], key=str,
    )
    assert url_filter.judge_urls(pages, queries.RULES, listed.limit(0)).where("verdict = 'block'").count() == 2


def test_bloom_has_no_false_negative_at_any_size(spark):
    ready(spark)
    keys = spark.range(3000).select(F.concat(F.lit("u"), "id").alias("k"))
    other = spark.range(3000).select(F.concat(F.lit("v"), "id").alias("k"))
    for size in (64, 1 << 20):
        bloom = url_filter.build_bloom(keys, "k", size)
        assert keys.where(bloom.may_hold(F.col("k"), spark)).count() == 3000
        if size > 64:
            assert other.where(bloom.may_hold(F.col("k"), spark)).count() < 300


# ---- preference pairs -------------------------------------------------------------------------


def test_preference_pairs(spark):
    ready(spark)
    schema = "id long, turn long, role string, text string, pair_id string"
    a = [(1, 0, "user", "hi"), (1, 0, "user", "hi"), (1, 1, "assistant", "yes"), (2, 0, "user", None),
         (3, 0, None, "q"), (4, 0, "assistant", "same"), (None, 0, "user", "x"), (5, 0, "user", "left only")]
    b = [(1, 0, "user", "hi"), (1, 1, "assistant", "no"), (1, 2, "user", "?"), (2, 0, "user", "other"),
         (3, 0, None, "q"), (3, 1, "assistant", "more"), (4, 0, "assistant", "same")]
    frames = [
        preference.gather_turns(spark.createDataFrame([(*r, "z") for r in rows], schema), "id", name)
        for rows, name in ((a, "chosen"), (b, "rejected"))
    ]
    got = {r["pair_id"]: r for r in preference.format_preferences(*frames).collect()}
    assert sorted(got) == [1, 2, 3, 4]
    one = got[1]
    assert one["prompt"] == "<|user|>\nhi<|end|>\n" and one["chosen"] == "<|assistant|>\nyes<|end|>\n"
    start, end = one["chosen_spans"][0]
    assert one["chosen"][start:end] == "yes<|end|>\n" and one["n_prompt_turns"] == 1
    assert one["rejected"].endswith("<|user|>\n?<|end|>\n") and len(one["rejected_spans"]) == 1
    assert got[2]["n_prompt_turns"] == 0 and got[2]["prompt"] == ""
    assert got[3]["chosen"] == "" and got[3]["prompt"] == "<||>\nq<|end|>\n"
    assert got[4]["chosen"] == got[4]["rejected"] == ""


# ---- token counts -----------------------------------------------------------------------------


@pytest.fixture(scope="module")
def counter():
    return token_counts.PrefixCounts(public_tokenizers.path(queries.PIECE_MODEL))


def test_prefix_counts_equal_the_library(counter, texts):
    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(queries.PIECE_MODEL))
    r = random.Random(4)
    cases = [t or "" for t in ODD] + [" " * 40, " " * 17 + "x", " " * 16 + "\ny", "日本語𝒳  \t", "a ▁▁ b", "\x00a"]
    cases += [t[:150] for t in r.sample(list(texts.values()), 12)]
    for text in cases:
        text = text[:400]
        want = [len(library.encode(text[:k])) for k in range(len(text) + 1)]
        assert counter.prefixes(text.encode()).tolist() == want, text
        for budget in (0, 1, 5, 37):
            assert counter.cut(text.encode(), budget) == max(i for i, n in enumerate(want) if n <= budget)


def test_token_counts_of_whole_texts(spark, texts):
    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(queries.PIECE_MODEL))
    for r in queries.QUERIES["op6_token_counts"](spark, SF).collect():
        text = texts[r["doc_id"]]
        n = len(library.encode(text))
        assert (r["n_tokens"], r["n_bytes"], r["over_limit"]) == (n, len(text.encode()), n > 4096)
    rows = token_counts.count_tokens(odd(spark), public_tokenizers.path(queries.PIECE_MODEL)).collect()
    assert len(rows) == len(ODD) + 3
    assert all(r["n_tokens"] == len(library.encode(r["row"]["text"] or "")) for r in rows)


def test_prefix_index_answers_without_a_tokenizer(spark):
    docs = table(spark, ["the quick brown fox, again", None])
    index = token_counts.prefix_index(docs, public_tokenizers.path(queries.PIECE_MODEL))
    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(queries.PIECE_MODEL))
    got = {r["row"]["doc_id"]: r for r in token_counts.prefix_answers(index, F.lit(9), F.lit(3)).collect()}
    text = "the quick brown fox, again"
    assert got[0]["tokens_at"] == len(library.encode(text[:9]))
    assert got[0]["chars_within"] == max(k for k in range(27) if len(library.encode(text[:k])) <= 3)
    assert (got[1]["tokens_at"], got[1]["chars_within"]) == (0, 0)
    asked = token_counts.prefix_answers(index, F.lit(-4), F.lit(-1)).collect()
    assert all((r["tokens_at"], r["chars_within"]) == (0, 0) for r in asked)
    none = F.lit(None).cast("int")
    assert all((r["tokens_at"], r["chars_within"]) == (None, None) for r in token_counts.prefix_answers(index, none, none).collect())
    counter = token_counts.counter(public_tokenizers.path(queries.PIECE_MODEL))
    counter.learn([b"some words"])
    assert counter.cut(b"some words", -3) == 0


# ---- vectors ----------------------------------------------------------------------------------


def linked(rows, threshold):
    """Brute force: links and smallest reachable id of every vector."""
    def cosine(a, b):
        return np.dot(a, b) / math.sqrt(np.dot(a, a)) / math.sqrt(np.dot(b, b))
    ids = [r[0] for r in rows]
    near = {i: set() for i in ids}
    for i, (a, la, va) in enumerate(rows):
        for b, lb, vb in rows[:i]:
            if la == lb and la is not None and cosine(np.array(va), np.array(vb)) >= threshold:
                near[a].add(b)
                near[b].add(a)
    root = dict.fromkeys(ids)
    for i in sorted(ids):
        if root[i] is None:
            stack = [i]
            while stack:
                x = stack.pop()
                if root[x] is None:
                    root[x] = i
                    stack.extend(near[x])
    return {i: (len(near[i]), root[i]) for i in ids}


@pytest.mark.parametrize("dims", [3, 16])
def test_vectors_against_brute_force(spark, dims, monkeypatch):
    ready(spark)
    monkeypatch.setattr(embedding_dedup, "TILE", 16)  # many tiles
    rng = np.random.default_rng(dims)
    centres = rng.standard_normal((12, dims))
    rows = []
    for i in range(240):
        noise = 0.3 if i % 2 else 0.05
        v = centres[rng.integers(12)] + noise * rng.standard_normal(dims)
        rows.append((i, int(rng.integers(2)), (v if i % 9 else centres[0]).tolist()))
    odd_rows = [(900, 1, None), (901, 1, [0.0] * dims), (902, 1, [float("nan")] * dims), (903, None, rows[0][2]),
                (904, 1, []), (905, 1, [None] * dims), (906, 1, [float("inf")] + [1.0] * (dims - 1)), (905, 1, [None] * dims)]
    frame = spark.createDataFrame(
        [(*r, 1.0) for r in [*rows, *odd_rows, rows[3]]], "vec_id long, label int, embedding array<double>, links double"
    )
    got = {r["vec_id"]: r for r in embedding_dedup.near_vectors(frame).collect()}
    assert len(got) == 240 + 7
    for i, (n, root) in linked(rows, 0.93).items():
        assert (got[i]["n_links"], got[i]["component_id"]) == (n, root)
    for i in range(900, 907):
        assert (got[i]["n_links"], got[i]["component_id"], got[i]["kept"]) == (0, i, True)
    assert embedding_dedup.near_vectors(frame.limit(0)).count() == 0


def test_vectors_that_share_an_id_are_apart(spark):
    ready(spark)
    rows = [(1, [1.0, 0.0]), (1, [0.0, 1.0]), (2, [1.0, 0.01]), (3, [0.01, 1.0])]
    frame = spark.createDataFrame([(i, 0, v) for i, v in rows], "vec_id long, label int, embedding array<double>")
    got = sorted(tuple(r) for r in embedding_dedup.near_vectors(frame).collect())
    assert got == [(1, 1, 1, True), (1, 1, 1, True), (2, 1, 1, False), (3, 1, 1, False)]


def vector_shuffles(df):
    """How many shuffles of a frame's plan carry vectors."""
    def walk(node):
        if node.getClass().getSimpleName() == "AdaptiveSparkPlanExec":
            return walk(node.executedPlan())
        children = node.children()
        n = sum(walk(children.apply(i)) for i in range(children.size()))
        if node.getClass().getSimpleName() == "ShuffleExchangeExec":
            n += bool({"vector", "vectors", "data"} & set(node.schema().fieldNames()))
        return n
    return walk(df._jdf.queryExecution().executedPlan())


def test_vectors_are_shuffled_once_whatever_the_tiles(spark, monkeypatch):
    ready(spark)
    counts = []
    settle = embedding_dedup.settle
    monkeypatch.setattr(embedding_dedup, "settle", lambda df: counts.append(vector_shuffles(df)) or settle(df))
    monkeypatch.setattr(embedding_dedup, "TILE", 8)
    rng = np.random.default_rng(1)
    near = rng.standard_normal(8) + 0.2 * rng.standard_normal((60, 8))  # most pairs are links
    rows = [(i, i % 2, v.tolist()) for i, v in enumerate([*near, *rng.standard_normal((20, 8))])]
    found = embedding_dedup.near_vectors(spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>"))
    assert sum(counts) + vector_shuffles(found) == 1
    assert {r["vec_id"]: (r["n_links"], r["component_id"]) for r in found.collect()} == linked(rows, 0.93)


def test_range_join_of_a_block_loses_no_pair():
    rng = np.random.default_rng(2)
    for size in (1, 2, 5):
        a, b = (0.1 * rng.standard_normal((n, size)).astype(np.float32) for n in (300, 200))
        b[:20] = a[:20]
        want = {(i, j) for i in range(300) for j in range(200) if ((a[i].astype(float) - b[j]) ** 2).sum() <= 0.01}
        got = [(int(i), int(j)) for x, y in embedding_dedup._in_range(a, b, 0.01 + 1e-5) for i, j in zip(x, y)]
        assert len(got) == len(set(got)) and want <= set(got)
        assert all(((a[i].astype(float) - b[j]) ** 2).sum() <= 0.0101 for i, j in got)


def test_vectors_with_odd_labels_and_zeros_of_both_signs(spark):
    ready(spark)
    nan = float("nan")
    rows = [(1, nan, [0.0, 1.0]), (2, nan, [-0.0, 1.0]), (2, nan, [0.0, 1.0]), (3, 0.0, [1.0, 0.0]), (4, -0.0, [1.0, -0.0]),
            (5, 0.0, [nan, 1.0]), (5, 0.0, [nan, 1.0]), (5, 0.0, [None, 1.0]), (6, 1.0, [1.0]), (7, 1.0, [1.0, 0.0])]
    frame = spark.createDataFrame([(i, x, v) for i, x, v in rows], "vec_id long, label double, embedding array<float>")
    got = sorted(tuple(r) for r in embedding_dedup.near_vectors(frame).collect())
    assert got == [(1, 1, 1, True), (2, 1, 1, False), (3, 1, 3, True), (4, 1, 3, False), (5, 0, 5, True), (5, 0, 5, True),
                   (6, 0, 6, True), (7, 0, 7, True)]


def test_vector_query_against_brute_force(spark, sf):
    rows = [(r["vec_id"], r["label"], r["embedding"]) for r in sf["embeddings"].collect()]
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in queries.QUERIES["op7_embedding_dedup"](spark, SF).collect()}
    assert got == linked(rows, 0.93)


def test_components_of_a_chain_a_star_and_loops(spark):
    ready(spark)
    links = [(i, i + 1) for i in range(20)] + [(100, 100 + i) for i in range(30)] + [(7, 7), (None, 3)]
    got = dict(components.components(spark.createDataFrame(links, "a long, b long"), "a", "b").collect())
    assert got == {**dict.fromkeys(range(21), 0), **dict.fromkeys(range(100, 130), 100)}


# ---- near-duplicate documents -----------------------------------------------------------------


def shingles(text):
    words = words_of((text or "").encode())
    return collections.Counter(
        b" ".join(words[i : i + 5]) for i in range(max(1, len(words) - 4))
    ) if words else collections.Counter()


def classes(texts, threshold=0.8):
    bags = {d: shingles(t) for d, t in texts.items()}
    root = {d: d for d, b in bags.items() if b}
    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    holders = collections.defaultdict(list)
    for d in root:
        for s in bags[d]:
            holders[s].append(d)
    for a, b in {(x, y) for held in holders.values() for x in held for y in held if x < y}:
        both = sum((bags[a] & bags[b]).values())
        if both >= threshold * (sum(bags[a].values()) + sum(bags[b].values()) - both):
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    return {d: find(d) for d in root}


def test_near_documents_against_brute_force(spark, texts):
    got = {r["doc_id"]: r for r in queries.QUERIES["op8_minhash_dedup"](spark, SF).collect()}
    want = classes(texts)
    assert all(got[d]["class_id"] == want.get(d, d) for d in texts)


def test_near_documents_chains_weights_and_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(bagminhash, "TILE", 4)  # many tiles
    monkeypatch.setattr(bagminhash, "SKETCH_TILE", 4)
    r = random.Random(8)
    word = lambda: "".join(r.choice("abcdefgh") for _ in range(4))
    base = [word() for _ in range(120)]
    cases = []
    for i in range(25):  # a chain: each a little further from the first
        base = base[:-2] + [word(), word()]
        cases.append(" ".join(base))
    cases += ["tick " * 100, "tick " * 104, "tick " * 300, "one two", "One, two!", *ODD]
    texts = dict(enumerate(cases))
    docs = table(spark, [*cases, "null id", cases[0]], [*range(len(cases)), None, 0])
    found = bagminhash.near_duplicates(docs).collect()
    assert len(found) == docs.count()
    got = {r["doc_id"]: r["class_id"] for r in found if r["print"] is not None}
    assert got == classes(texts)
    assert all(r["kept"] and r["class_id"] == r["doc_id"] for r in found if r["print"] is None)
    kept = bagminhash.keep_one(docs)
    assert kept.columns == docs.columns
    ids = [r["doc_id"] for r in kept.collect()]
    alone = [d for d in texts if d not in got or got[d] == d]
    assert sorted(ids, key=str) == sorted([*alone, None], key=str)
    assert bagminhash.near_duplicates(docs.limit(0)).count() == 0


def made_near(words, keep, r):
    """The text with its last words replaced, so that ``keep`` of its words stay."""
    return " ".join([*words[:keep], *(f"n{r.randrange(10**9)}" for _ in words[keep:])])


def test_near_documents_with_repeated_ids(spark):
    r = random.Random(31)
    texts = {}
    for name in "ABCE":
        texts[name] = " ".join(f"{name}{r.randrange(10**6)}" for _ in range(100))
    texts["E'"] = made_near(texts["E"].split(), 98, r)
    cases = [(1, "A"), (1, "B"), (2, "B"), (3, "C"), (3, "E"), (4, "E'"), (1, "A"), (4, ""), (6, "C"), (3, "E'")]
    docs = table(spark, [texts.get(t, "") for _, t in cases], [i for i, _ in cases])
    names = {t: n for n, t in texts.items()} | {"": ""}
    found = bagminhash.near_duplicates(docs).collect()
    prints = {bagminhash._print(words_of(t.encode())): n for n, t in texts.items()} | {None: ""}
    got = collections.Counter((x["doc_id"], prints[x["print"]], x["class_id"]) for x in found)
    assert got == collections.Counter(
        [(1, "A", 1), (1, "A", 1), (1, "B", 1), (2, "B", 1), (3, "C", 3), (3, "E", 3), (4, "E'", 3), (4, "", 4), (6, "C", 3), (3, "E'", 3)]
    )
    kept = sorted((x["doc_id"], names[x["text"]]) for x in bagminhash.keep_one(docs).collect())
    first = min("E", "E'", key=lambda n: bagminhash._print(words_of(texts[n].encode())))
    assert kept == sorted([(1, "A"), (1, "B"), (3, "C"), (3, first), (4, "")])


@pytest.mark.parametrize("threshold", [0.3, 0.6, 0.95])
def test_near_documents_at_other_thresholds(spark, threshold):
    r = random.Random(int(100 * threshold))
    plan = bagminhash.Plan(threshold)
    assert (1 - threshold**plan.rows) ** plan.bands <= bagminhash.MISSED and plan.size <= bagminhash.COMPONENTS
    texts = []
    for _ in range(40):
        words = [f"w{r.randrange(10**9)}" for _ in range(104)]
        texts += [" ".join(words), made_near(words, r.choice((20, 52, 60, 84, 86, 100, 102, 103)), r)]
    docs = table(spark, texts)
    got = {x["doc_id"]: x["class_id"] for x in bagminhash.near_duplicates(docs, threshold).collect()}
    assert got == classes(dict(enumerate(texts)), threshold)
    assert len(set(got.values())) < len(texts)


def test_near_documents_refuse_a_threshold_near_none():
    with pytest.raises(ValueError):
        bagminhash.Plan(0.1)


def test_a_filter_on_prints_runs_them_once(spark, capsys):
    docs = spark.createDataFrame([(1, b"a b"), (2, b""), (3, None)], "doc_id long, text binary")
    texts = docs.repartition("doc_id").withColumn("print", bagminhash._print_of(F.col("text")))
    found = texts.where("print IS NOT NULL")
    found.explain()
    plan = capsys.readouterr().out
    assert plan.count("ArrowEvalPython") == 1 and plan.index("ArrowEvalPython") < plan.index("Exchange")
    assert [(r["doc_id"], bytes(r["print"])) for r in found.collect()] == [(1, bagminhash._print([b"a", b"b"]))]


def test_signatures_estimate_weighted_similarity():
    rng = np.random.default_rng(6)
    keys = rng.integers(1, 1 << 62, 200).astype(np.uint64)
    a = np.unique(keys[:150]), rng.integers(1, 40, 150)
    b = np.unique(keys[30:180]), None
    weight = dict(zip(a[0].tolist(), a[1].tolist()))
    b = b[0], np.array([weight.get(int(k), 9) for k in b[0]])
    got = bagminhash.signatures([a, b, (a[0][:0], a[1][:0])], 4000)
    assert np.isinf(got[2]).all() and np.isfinite(got[:2]).all()
    assert (got[0] == got[1]).mean() == pytest.approx(bagminhash.similarity(a, b), abs=0.04)
    shared = bagminhash.overlaps([a, b])
    assert shared[0, 1] == np.minimum([weight.get(int(k), 0) for k in b[0]], b[1]).sum()


# ---- contamination ----------------------------------------------------------------------------


def test_contamination_in_blocks_and_odd_rows(spark):
    r = random.Random(9)
    words = [w.encode() for w in "a b c d e f".split()]
    text = lambda n: " ".join(r.choice(words).decode() for _ in range(n))
    items = [(1, text(15)), (2, text(14)), (3, "a b"), (4, ""), (5, None), (None, text(20)), (10, "F, e! D"), (1, text(13))]
    cases = [text(40) + " " + items[0][1] + " " + text(5), text(200), items[1][1], "x " * 900 + "a b", *ODD]
    benchmark = spark.createDataFrame([(*i, 1) for i in items], "item_id long, text string, n_words long")
    docs = table(spark, cases)
    results = []
    for block in (10, 10**6):
        found = decontaminate.digest(decontaminate.find_contamination(docs, benchmark, block_words=block))
        results.append({x["row"]["doc_id"]: x for x in found.collect()})
    assert results[0] == results[1]
    for i, case in enumerate(cases):
        own = words_of((case or "").encode())
        hit, seen = set(), set()
        for item, t in items:
            w = words_of((t or "").encode())
            size = min(13, len(w))
            for k in range(len(w) - size + 1 if size and item is not None else 0):
                for p in range(len(own) - size + 1):
                    if own[p : p + size] == w[k : k + size]:
                        hit |= set(range(p, p + size))
                        seen.add(str(item))
        x = results[0][i]
        assert (x["n_words"], x["n_hit"], x["n_items"]) == (len(own), len(hit), len(seen)), case
        assert x["items_sha256"] == decontaminate.items_hash(list(seen))
        assert x["contaminated"] == (len(hit) > 0 and 20 * len(hit) >= len(own))
    empty = decontaminate.find_contamination(docs, benchmark.limit(0))
    assert empty.where("n_hit > 0").count() == 0 and empty.count() == len(cases)


# ---- packing ----------------------------------------------------------------------------------


def check_packing(rows, texts, capacity=2048):
    tokenizer = Tokenizer.from_file(public_tokenizers.path(queries.WORD_MODEL))
    pieces, places = collections.Counter(), collections.defaultdict(list)
    for x in rows:
        pieces[x["doc_id"], x["piece"], x["start"], x["length"], x["ids_crc32"]] += 1
        places[x["sequence_id"]].append((x["offset"], x["length"]))
    want = collections.Counter()
    for doc, text in texts:
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 0], dtype="<u4")
        for p, at in enumerate(range(0, len(ids), capacity)):
            own = ids[at : at + capacity]
            want[doc, p, at, len(own), zlib.crc32(own.tobytes())] += 1
    assert pieces == want
    for held in places.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= capacity
    return len(places)


def test_packing_of_whole_documents(spark, texts):
    rows = queries.QUERIES["op10_packing"](spark, SF).collect()
    used = check_packing(rows, texts.items())
    assert used <= -(-sum(r["length"] for r in rows) // 2048) + 1


def test_packing_of_odd_rows(spark):
    docs = odd(spark)
    rows = packing.pack(docs, public_tokenizers.path(queries.WORD_MODEL), with_ids=True).collect()
    check_packing(rows, [(r["doc_id"], r["text"]) for r in docs.collect()])
    assert all(zlib.crc32(r["ids"]) == r["ids_crc32"] for r in rows)
    assert packing.pack(docs.limit(0), public_tokenizers.path(queries.WORD_MODEL)).count() == 0


def fewest(sizes, capacity):
    """The fewest sequences, by trying every placement."""
    best = [len(sizes)]
    def place(i, rooms):
        if len(rooms) >= best[0]:
            return
        if i == len(sizes):
            best[0] = len(rooms)
            return
        for k in range(len(rooms)):
            if rooms[k] >= sizes[i] and rooms[k] not in rooms[:k]:
                place(i + 1, [*rooms[:k], rooms[k] - sizes[i], *rooms[k + 1 :]])
        place(i + 1, [*rooms, capacity - sizes[i]])
    place(0, [])
    return best[0]


@pytest.mark.parametrize("seed", range(25))
def test_bin_completion_against_every_placement(seed):
    r = random.Random(seed)
    sizes = sorted((r.randint(1, 20) for _ in range(r.randint(1, 9))), reverse=True)
    counts = dict(collections.Counter(sizes))
    plan = packing.complete_bins(counts, 20)
    placed = collections.Counter()
    for filling, n in plan:
        assert sum(a * b for a, b in filling) <= 20
        placed.update({a: b * n for a, b in filling})
    assert placed == counts
    best = fewest(sizes, 20)
    assert packing.lower_bound(counts, 20) <= best == sum(n for _, n in plan)


def test_bin_completion_searches_beyond_the_greedy_tries():
    """Without the greedy tries the depth-first search finds what best-fit misses."""
    counts, capacity = {44: 2, 24: 3, 22: 2, 21: 1, 17: 1, 8: 2, 6: 2, 3: 1, 2: 1}, 61
    first = sum(n for _, n in packing.best_fit(counts, capacity))
    sizes = sorted((n for n, c in counts.items() for _ in range(c)), reverse=True)
    best = fewest(sizes, capacity)
    plan = packing.complete_bins(counts, capacity, searches=0)
    assert sum(n for _, n in plan) == best <= first


def test_word_tokens_of_odd_letters_equal_the_library():
    """Letters whose lower case or normal form depends on what stands beside them."""
    r = random.Random(20)
    path = public_tokenizers.path(queries.WORD_MODEL)
    library, own = Tokenizer.from_file(path), packing.WordTokens(path)
    letters = "aAbHJTWYǰİıßÉéçÇĲŉẞΣςK\u0307\u0331\u030c\u0308\u030a\u0301\u0327.,.,!?()'\"-  \n\t0١字한글\u200d’–\xa0\u3000\x85\x1c"
    texts = ["BELEDİYESİ.", "TARİHİ, x", "H̱ J̌ T̈ W̊ Y̊", "é. É, e\u0301. E\u0301,", "<|endoftext|> İ.", None, ""]
    for _ in range(20000):
        n = r.randrange(1, 25)
        pick = lambda: r.choice(letters) if r.random() < 0.9 else chr(r.choice((r.randrange(1, 0x250), r.randrange(0x300, 0x3000), r.randrange(0x1E00, 0x2100))))
        texts.append("".join(pick() for _ in range(n)))
    want = [e.ids for e in library.encode_batch([t or "" for t in texts], add_special_tokens=False)]
    got = own.encode([None if t is None else t.encode() for t in texts])
    for text, a, b in zip(texts, got, want):
        assert np.frombuffer(a, "<u4").tolist() == b, text


# ---- the pipeline -----------------------------------------------------------------------------


def test_pipeline_stages_take_effect(spark, sf, texts):
    corpus_pipeline = pytest.importorskip("corpus_pipeline")
    ready(spark)
    docs = sf["documents"].withColumn("found", F.lit(1))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before, docs = docs, settle(stage(spark, docs, SF))
        assert docs.columns == before.columns and docs.count() <= before.count(), name
    left = {r["doc_id"]: r["text"] for r in docs.collect()}
    want = classes(left)
    assert all(want[d] == d for d in want)  # no near duplicates are left
    for text in left.values():
        assert not rule_spans(text or "")
    rows = corpus_pipeline.pack(spark, docs, SF).collect()
    check_packing(rows, left.items())
