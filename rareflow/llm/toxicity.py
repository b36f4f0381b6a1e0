"""Toxicity scores: FTRL-proximal logistic regression over hashed word n-grams and skip-grams."""

from __future__ import annotations

import logging
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rareflow.llm.common import free_name, text_of
from rareflow.llm.tokens import forget

#: Buckets of the feature hash, as bits; the model never has more weights than that.
HASH_BITS = 20
#: Distances between the two words of a pair: 1 is a bigram, more are skip-grams.
GAPS = (1, 2, 3)
#: Bytes of a word's beginning that are features of their own, so that endings and compounds share what is learnt of a stem.
STEMS = (2, 4, 6, 8)
#: Labelled documents that the model learns from at most, chosen by a hash of doc_id.
LEARN_ROWS = 16_384
#: FTRL-proximal: step size and its offset, L1 and L2 strength, passes over the rows.
ALPHA, BETA, L1, L2, PASSES = 0.5, 1.0, 16.0, 1.0, 10
THRESHOLD = 0.3

_RANDOM = np.random.default_rng(11)
_BYTE = _RANDOM.integers(0, 2**64, 256, dtype=np.uint64)
_PLACE = _RANDOM.integers(0, 2**64, 64, dtype=np.uint64) | np.uint64(1)
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
#: Letters and digits, and every byte of a character beyond ASCII.
_WORD = np.zeros(256, dtype=bool)
_WORD[[*range(48, 58), *range(97, 123), *range(128, 256)]] = True


def features(texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For ranges of texts: number of the text and bucket of every word, stem, bigram and skip-gram, repeats included."""
    raws = [t.encode("utf-8", "surrogatepass") for t in texts]
    at = 0
    while at < len(raws):
        to, held = at, 0
        while to < len(raws) and (to == at or held + len(raws[to]) <= 1 << 18):
            held += len(raws[to])
            to += 1
        yield _features(raws[at:to], at)
        at = to


def _features(raws, first):
    # a byte that is no part of a word closes every text
    codes = _FOLD[np.frombuffer(b" ".join(raws) + b" ", dtype=np.uint8)]
    sizes = np.array([len(r) + 1 for r in raws])
    word = _WORD[codes]
    start = np.flatnonzero(word & ~np.concatenate([[False], word[:-1]]))
    if not len(start):
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    place = np.zeros(len(codes), dtype=np.int64)
    place[start] = start
    place = np.arange(len(codes)) - np.maximum.accumulate(place)
    value = np.where(word, _BYTE[codes] * _PLACE[place & 63], np.uint64(0))
    name = np.add.reduceat(value, start)
    name ^= name >> np.uint64(32)
    text = np.searchsorted(np.cumsum(sizes), start, side="right") + first
    numbers, names = [text], [name * _PLACE[0]]
    for stem in STEMS:
        begun = np.add.reduceat(np.where(place < stem, value, np.uint64(0)), start)
        numbers.append(text)
        names.append(((begun ^ (begun >> np.uint64(32))) * _PLACE[1] + np.uint64(stem)) * _PLACE[2])
    for gap in GAPS:
        if len(name) > gap:
            together = text[gap:] == text[:-gap]
            pair = (name[:-gap] * _PLACE[1] + name[gap:]) * _PLACE[gap + 2]
            numbers.append(text[gap:][together])
            names.append(pair[together])
    bucket = np.concatenate(names) >> np.uint64(64 - HASH_BITS)
    return np.concatenate(numbers), bucket.astype(np.int64)


@dataclass
class Model:
    """Weights that are not zero, by ascending bucket, the intercept, and how many of the two labels were learnt from."""

    buckets: np.ndarray
    weights: np.ndarray
    intercept: float
    labels: int = 0

    def scores(self, texts: list[str]) -> np.ndarray:
        """Probability of label 1 for each text; a feature counts once however often it stands in a text."""
        margin = np.full(len(texts), self.intercept)
        dense = np.zeros(1 << HASH_BITS)
        dense[self.buckets] = self.weights
        for number, bucket in features(texts):
            weight = dense[bucket]
            hit = np.flatnonzero(weight)
            once = np.unique((number[hit] << HASH_BITS) | bucket[hit])
            np.add.at(margin, once >> HASH_BITS, dense[once & ((1 << HASH_BITS) - 1)])
        return 1 / (1 + np.exp(-np.clip(margin, -500, 500)))


def fit_ftrl(rows: list[tuple[np.ndarray, int]], passes: int = PASSES) -> Model:
    """The model after ``passes`` over (distinct buckets, label), one row at a time.

    Each weight has its own rate, from its own sum of squared gradients, and stays zero until its
    gradients add up to more than the L1 strength. The intercept is not regularised.
    """
    size = (1 << HASH_BITS) + 1  # the last is the intercept
    z, n, w = np.zeros(size), np.zeros(size), np.zeros(size)
    l1 = np.full(size, L1)
    l1[-1] = 0.0
    for _ in range(passes):
        for buckets, label in rows:
            at = np.append(buckets, size - 1)
            zi, ni = z[at], n[at]
            wi = np.where(np.abs(zi) <= l1[at], 0.0, -(zi - np.sign(zi) * l1[at]) / ((BETA + np.sqrt(ni)) / ALPHA + L2))
            p = 1 / (1 + np.exp(-min(max(wi.sum(), -35.0), 35.0)))
            g = p - label
            z[at] = zi + g - (np.sqrt(ni + g * g) - np.sqrt(ni)) / ALPHA * wi
            n[at] = ni + g * g
    w = np.where(np.abs(z) <= l1, 0.0, -(z - np.sign(z) * l1) / ((BETA + np.sqrt(n)) / ALPHA + L2))
    found = np.flatnonzero(w[:-1])
    return Model(found, w[found], float(w[-1]), len({label for _, label in rows}))


def held_out(doc_id: Column) -> Column:
    """True for the quarter of the doc_ids that nothing is learnt from; a null doc_id is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def not_held_out(labels: DataFrame) -> DataFrame:
    """The labels that may be learnt from."""
    return labels.where(~held_out(F.col("doc_id")))


def learn(docs: DataFrame, labels: DataFrame, rows: int = LEARN_ROWS) -> Model:
    """A model from the texts of ``docs`` with a 0/1 ``toxic`` in ``labels``; a doc_id labelled twice counts as 1 if any label is 1.

    At most ``rows`` labelled doc_ids are taken, those with the smallest hashes, so a broadcast of them is bounded and the
    texts are not shuffled. The features are made where the texts are; one task then learns from their buckets, in the
    order of the hash. Without a labelled text every score is one half.
    """
    marked = labels.where("doc_id is not null and toxic in (0, 1)").groupBy("doc_id").agg(F.max("toxic").cast("int").alias("label"))
    chosen = marked.select(F.col("doc_id").cast("long").alias("id"), "label", F.xxhash64("doc_id").alias("place"))
    chosen = F.broadcast(chosen.orderBy("place", "id").limit(rows))
    texts = docs.select(F.col("doc_id").cast("long").alias("id"), text_of().alias("text")).join(chosen, "id")

    def buckets(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        forget()
        for batch in batches:
            lists: list[list] = [[] for _ in range(len(batch))]
            for number, bucket in features(batch["text"].tolist()):
                once = np.unique((number << HASH_BITS) | bucket)
                number, bucket = once >> HASH_BITS, once & ((1 << HASH_BITS) - 1)
                for k in np.unique(number).tolist():
                    a, z = np.searchsorted(number, [k, k + 1])
                    lists[k].append(bucket[a:z])
            made = [np.concatenate(x).astype("<i4").tobytes() if x else b"" for x in lists]
            yield pd.DataFrame({"place": batch["place"], "id": batch["id"], "label": batch["label"], "buckets": made})

    def fit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        learnt = [(np.frombuffer(b, dtype="<i4").astype(np.int64), int(y)) for batch in batches for b, y in zip(batch["buckets"], batch["label"])]
        model = fit_ftrl(learnt)
        yield pd.DataFrame({"buckets": [model.buckets.astype("<i8").tobytes()], "weights": [model.weights.tobytes()], "intercept": [model.intercept], "labels": [model.labels]})

    found = texts.select("place", "id", "label", "text").mapInPandas(buckets, "place long, id long, label int, buckets binary")
    one = found.repartition(1).sortWithinPartitions("place", "id", "buckets")
    row = one.mapInPandas(fit, "buckets binary, weights binary, intercept double, labels int").first()
    if row is None:
        return Model(np.zeros(0, dtype=np.int64), np.zeros(0), 0.0)
    return Model(np.frombuffer(row["buckets"], dtype="<i8"), np.frombuffer(row["weights"]), row["intercept"], row["labels"])


def with_scores(docs: DataFrame, model: Model, score: str = "score") -> DataFrame:
    """``docs`` with the score of each whole text as one more column; null and empty texts have the intercept's.

    A column of that name in ``docs`` is an error.
    """
    if score.lower() in {c.lower() for c in docs.columns}:
        raise ValueError(f"there is a column {score} already")

    @F.pandas_udf("double")
    def scored(texts: pd.Series) -> pd.Series:
        return pd.Series(model.scores(texts.tolist()))

    return docs.withColumn(score, scored(text_of()))


def without_toxic(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` without the rows that the model scores at ``threshold`` or above; all columns stay.

    A model that has not learnt from texts of both labels, because the labels are missing or fit no text, tells nothing apart: then
    all rows stay, with a warning.
    """
    model = learn(docs, labels)
    if model.labels < 2:
        logging.getLogger(__name__).warning("no texts of both labels to learn from: no document is rejected")
        return docs
    score = free_name(docs, "toxicity")
    return with_scores(docs, model, score).where(F.col(score) < threshold).drop(score)
