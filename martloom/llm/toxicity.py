"""Toxicity: a linear classifier on character n-grams scaled by naive Bayes log-count ratios."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martloom.llm.common import beside, let_go
from martloom.session import settle

BUCKETS = 1 << 18  # hashed n-grams that are counted
SIZES = (3, 4, 5)  # n-gram lengths; a word counts with a space on both sides
SAMPLE_ROWS = 20_000  # labelled rows the classifier is fitted on, at most
THRESHOLD = 0.7
KEPT_WORDS = 200_000  # words whose features a worker remembers
LEARNT = 16_384  # new words hashed together
ROUNDS = 60  # steps of the fit, at most
NEAR = 1e-3  # and until its gradient is this share of the first one
GRAIN = 2.0**-40  # weights are added up as whole multiples of this, so that their order is nothing


_P = np.uint64(0x9E3779B97F4A7C15)
_SHIFT = np.uint64(64 - BUCKETS.bit_length() + 1)


def grams(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the words' character n-grams, and whose they are (with repeats). The words lie
    in one string with spaces between; an n-gram is a stretch with no space inside its ends."""
    codes = np.frombuffer((" " + " ".join(words) + " ").encode("utf-32-le"), dtype=np.uint32)
    spaces = np.cumsum(codes == 32)
    codes = codes.astype(np.uint64)
    owner, bucket = [], []
    for n in SIZES:
        last = len(codes) - n + 1
        if last <= 0:
            continue
        at = np.flatnonzero(spaces[n - 2 : n - 2 + last] == spaces[:last])
        rolled = np.full(len(at), n, dtype=np.uint64)
        for k in range(n):
            rolled = (rolled ^ codes[at + k]) * _P
            rolled ^= rolled >> np.uint64(29)
        owner.append(spaces[at] - 1)
        bucket.append((rolled * _P >> _SHIFT).astype(np.int64))
    if not owner:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(owner), np.concatenate(bucket)


def words_in(text: str | None) -> set[str]:
    return set((text or "").lower().split())


class _Features:
    """The weighted n-grams of words, remembered up to a bound; new words of a batch are hashed
    together. The n-grams of all words lie in one array, those of a word one after another."""

    def __init__(self, known: np.ndarray):
        self.known = known
        self.last = np.zeros(BUCKETS, dtype=np.int32)
        self._forget()

    def _forget(self) -> None:
        self.number: dict[str, int] = {}
        self.start = np.zeros(1, dtype=np.int64)  # of each word's n-grams, and the end of all
        self.held = np.zeros(1 << 16, dtype=np.int32)

    def _learn(self, words: list[str]) -> None:
        owner, bucket = grams(words)
        hit = self.known[bucket]
        owner, bucket = owner[hit], bucket[hit]
        at = int(self.start[-1])
        end = at + len(bucket)
        if end > len(self.held):
            self.held = np.concatenate((self.held[:at], np.zeros(2 * end - at, dtype=np.int32)))
        self.held[at:end] = bucket[np.argsort(owner, kind="stable")]
        first = len(self.number)
        self.number.update(zip(words, range(first, first + len(words))))
        self.start = np.concatenate((self.start, at + np.cumsum(np.bincount(owner, minlength=len(words)))))

    def of(self, texts) -> Iterator[np.ndarray]:
        """The different known buckets of each text, in no order."""
        if len(self.number) > KEPT_WORDS:
            self._forget()
        rows = [list(words_in(text)) for text in texts]
        number = self.number
        new = list({w for words in rows for w in words if w not in number})
        for i in range(0, len(new), LEARNT):
            self._learn(new[i : i + LEARNT])
        start, held, last = self.start, self.held, self.last
        for words in rows:
            own = np.fromiter(map(number.__getitem__, words), np.int64, len(words))
            size = start[own + 1] - start[own]
            ends = np.cumsum(size)
            whole = int(ends[-1]) if len(own) else 0
            count = np.arange(whole, dtype=np.int32)
            found = held[np.repeat(start[own] - ends + size, size) + count]
            last[found] = count  # of equal buckets one stays
            yield found[last[found] == count]


@dataclass(frozen=True)
class ToxicityModel:
    """Log-odds of label 1: ``bias`` plus the weight of each known n-gram a text holds."""

    bias: float
    weights: dict[int, float] = field(default_factory=dict)

    def score(self, text: Column) -> Column:
        """Probability of label 1 as a column; empty and NULL texts get the bias alone."""
        bias = self.bias
        whole = np.zeros(BUCKETS, dtype=np.int64)
        if self.weights:
            whole[list(self.weights)] = np.rint(np.array(list(self.weights.values())) / GRAIN)

        @F.pandas_udf("double")
        def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            let_go()
            features = _Features(whole != 0)
            for texts in batches:
                odds = [bias + int(whole[held].sum()) * GRAIN for held in features.of(texts)]
                yield pd.Series(1 / (1 + np.exp(-np.clip(odds, -700, 700))), dtype="float64")

        return scored(text)


def labelled_sample(
    docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS, seed: int = 11
) -> DataFrame:
    """``(text, label)`` of the ``rows`` labelled documents that come first by a hash of the id.

    ``labels`` needs doc_id and toxic (0 or 1; others are left out; an id labelled both ways
    counts as 1). The ids are at most ``rows``, so they are broadcast and the texts never move.
    """
    chosen = (
        labels.select(F.col("doc_id").alias("_id"), F.col("toxic").cast("int").alias("label"))
        .where("_id IS NOT NULL AND label IN (0, 1)")
        .groupBy("_id")
        .agg(F.max("label").alias("label"))
        .orderBy(F.xxhash64("_id", F.lit(seed)), "_id")
        .limit(rows)
    )
    texts = docs.select(F.col("doc_id").alias("_id"), F.col("text").cast("string").alias("text"))
    return texts.join(F.broadcast(chosen), "_id").select("text", "label")


def _counts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Documents of either label per n-gram, summed over the task; bucket -1 counts documents."""
    let_go()
    held = np.zeros((BUCKETS + 1, 2), dtype=np.int64)
    for pdf in batches:
        for text, label in zip(pdf["text"], pdf["label"]):
            held[np.unique(grams(list(words_in(text)))[1]), label] += 1
            held[BUCKETS, label] += 1
    used = np.flatnonzero(held.sum(axis=1))
    yield pd.DataFrame(
        {"bucket": np.where(used == BUCKETS, -1, used), "neg": held[used, 0], "pos": held[used, 1]}
    )


def minimised(slope: Callable[[np.ndarray], tuple[float, np.ndarray]], at: np.ndarray) -> np.ndarray:
    """L-BFGS from ``at``. (``pyspark.ml`` scales each feature to unit variance inside, with which a
    regression on very many rare features does not come near its optimum.)"""
    value, down = slope(at)
    first, moves = np.linalg.norm(down), []
    for _ in range(ROUNDS):
        if np.linalg.norm(down) <= NEAR * first:
            break
        way, kept = -down, []
        for s, y in reversed(moves):
            kept.append(s @ way / (s @ y))
            way = way - kept[-1] * y
        s, y = moves[-1] if moves else (way, way * first)
        way = way * (s @ y) / (y @ y)
        for (s, y), a in zip(moves, reversed(kept)):
            way = way + (a - y @ way / (s @ y)) * s
        step = 1.0
        for _ in range(20):
            new_value, new_down = slope(at + step * way)
            if new_value <= value + 1e-4 * step * float(down @ way):
                break
            step /= 2
        else:
            break
        moved = (step * way, new_down - down)
        if moved[0] @ moved[1] > 0:
            moves = [*moves[-9:], moved]
        at, value, down = at + step * way, new_value, new_down
    return at


def fit(sample: DataFrame, regularisation: float = 1e-4) -> ToxicityModel:
    """Fit on ``(text, label)`` rows. Equal texts count once, with the label of most of them (1 if
    as many have either).

    Document counts per n-gram and label come from one pass; what reaches the driver is at most
    one row per bucket. Every n-gram of the sample gets a log-count ratio, by which the features of
    a logistic regression are scaled; none is left out beforehand. One label only, or no rows: the
    bias is the smoothed share of label 1 (a half without rows) and no n-gram counts.
    """
    folded = sample.groupBy("text").agg((F.avg("label") >= 0.5).cast("int").alias("label"))
    sample = settle(folded.repartition(12))
    counted = (
        sample.mapInPandas(_counts, "bucket int, neg long, pos long")
        .groupBy("bucket")
        .agg(F.sum("neg").alias("neg"), F.sum("pos").alias("pos"))
        .toPandas()
        .sort_values("bucket")
    )
    docs = counted[counted["bucket"] < 0][["neg", "pos"]].sum()
    neg_docs, pos_docs = int(docs["neg"]), int(docs["pos"])
    prior = math.log((pos_docs + 1) / (neg_docs + 1))
    counted = counted[counted["bucket"] >= 0]
    neg, pos = counted["neg"].to_numpy(float), counted["pos"].to_numpy(float)
    if not neg_docs or not pos_docs:
        return ToxicityModel(prior)
    ratio = np.log(((pos + 1) / (pos + 1).sum()) / ((neg + 1) / (neg + 1).sum()))
    used = np.flatnonzero(ratio)
    if not len(used):
        return ToxicityModel(prior)
    buckets, ratio = counted["bucket"].to_numpy()[used], ratio[used]

    @F.pandas_udf("array<int>")
    def held_grams(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        let_go()
        known = np.zeros(BUCKETS, dtype=bool)
        known[buckets] = True
        features = _Features(known)
        for texts in batches:
            yield pd.Series([held for held in features.of(texts)], dtype=object)

    rows = settle(sample.select("label", held_grams("text").alias("terms")))
    scale = np.zeros(BUCKETS)
    scale[buckets] = ratio

    def slope(at: np.ndarray) -> tuple[float, np.ndarray]:
        """The regularised loss and its gradient; each task sends the sums over its rows."""
        bias, weights = at[-1], at[:-1] * scale

        def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            let_go()
            loss, grown = 0.0, np.zeros(BUCKETS + 1)
            for batch in batches:
                label = batch.column(0).to_numpy()
                terms, ends = batch.column(1).flatten().to_numpy(), batch.column(1).offsets.to_numpy()
                ends = ends - ends[0]
                whole = np.concatenate(([0.0], np.cumsum(weights[terms])))
                odds = bias + whole[ends[1:]] - whole[ends[:-1]]
                loss += float((np.logaddexp(0, odds) - label * odds).sum())
                off = 1 / (1 + np.exp(-np.clip(odds, -700, 700))) - label
                grown[:-1] += np.bincount(terms, np.repeat(off, np.diff(ends)), BUCKETS)
                grown[-1] += off.sum()
            yield pa.RecordBatch.from_arrays(
                [pa.array([loss]), pa.array([grown.tobytes()], pa.binary())], ["loss", "grown"]
            )

        loss, grown = 0.0, np.zeros(BUCKETS + 1)
        for r in rows.mapInArrow(summed, "loss double, grown binary").toLocalIterator():
            loss, grown = loss + r["loss"], grown + np.frombuffer(r["grown"])
        grown[:-1] *= scale
        loss, grown = loss / (neg_docs + pos_docs), grown / (neg_docs + pos_docs)
        grown[:-1] += regularisation * at[:-1]
        return loss + regularisation / 2 * float(at[:-1] @ at[:-1]), grown

    start = np.zeros(BUCKETS + 1)
    start[-1] = prior
    fitted = minimised(slope, start)
    weights = fitted[buckets] * ratio
    return ToxicityModel(float(fitted[-1]), {int(g): float(w) for g, w in zip(buckets, weights) if w})


def score_toxicity(docs: DataFrame, model: ToxicityModel, threshold: float = THRESHOLD) -> DataFrame:
    """``row`` (the document's columns), ``score`` and ``predicted``, one row per document.

    NULL, empty and word-less texts get the score of the bias. Very long texts are scored whole.
    Repeated rows are scored alike and all returned. An empty table gives an empty result.
    """
    scored = beside(docs, score=model.score(F.col("text").cast("string")))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
