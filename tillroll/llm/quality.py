"""Quality classifier with supervised subword embeddings (operator 7).

A text is the average of the vectors of its words, its repeated words and the
character n-grams of its words, all hashed into one table; a softmax layer on
the average gives the class.  Table and layer are learned together by
stochastic gradient descent in numpy, on a bounded sample of labelled rows.

The layer is linear and the average is a sum, so scoring needs one number per
bucket: the share of its vector in the difference of the two logits.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import batches, columns, held_out, id_text, labelled_sample, small_batches

# Characters hashed at once; longer texts go block by block, each up to the end
# of a word.
BLOCK = 1 << 18
_FACTORS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93], np.uint64)


@dataclass(frozen=True)
class Params:
    buckets: int = 1 << 16
    dim: int = 16
    grams: tuple[int, ...] = (3, 4, 5)
    epochs: int = 8
    rate: float = 0.6
    seed: int = 11
    per_class: int = 2500  # labelled rows of each class, at most
    max_chars: int = 24_000_000  # of the labelled rows of a class together, whole texts


def _bucket(hashes: np.ndarray, bits: int) -> np.ndarray:
    mixed = (hashes ^ hashes >> np.uint64(31)) * _FACTORS[1]
    return (mixed >> np.uint64(64 - bits)).astype(np.int32)


def features(text: str, params: Params) -> Iterator[np.ndarray]:
    """Buckets of a text, a block at a time: of each word, of each n-gram of
    <word>, and of each word that repeats the one before.

    Words are runs of anything but ASCII white space.  A repeated word is a
    word bigram spelled with a reference back, so that one bucket learns
    repetition whatever the word is.
    """
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    bits = params.buckets.bit_length() - 1
    gaps_at = np.flatnonzero((codes == 32) | ((codes >= 9) & (codes <= 13)))
    before, end = None, 0
    while end < len(codes):
        at, after = end, np.searchsorted(gaps_at, end + BLOCK)
        end = int(gaps_at[after]) if after < len(gaps_at) else len(codes)
        own = codes[at:end].astype(np.uint64)
        gap = (own == 32) | ((own >= 9) & (own <= 13))
        chars = np.concatenate([[1], np.where(gap, 1, own), [1]]).astype(np.uint64)
        gap = np.concatenate([[True], gap, [True]])
        starts = np.flatnonzero(~gap[1:] & gap[:-1]) + 1
        if not len(starts):
            continue
        gaps = np.cumsum(gap)
        for k, n in enumerate(params.grams):
            size = len(chars) - n + 1
            if size < 1:
                continue
            inside = gaps[n - 2 : n - 2 + size] == gaps[:size]  # no gap but at the ends
            sums = chars[:size] * _FACTORS[0] + np.uint64(n)
            for j in range(1, n):
                sums = sums * _FACTORS[2] + chars[j : j + size]
            yield _bucket(sums[inside], bits)
        place = np.arange(len(chars)) - np.repeat(np.concatenate([[0], starts]), np.diff([0, *starts.tolist(), len(chars)]))
        letters = (chars + np.uint64(7)) * (place.astype(np.uint64) * _FACTORS[3] | np.uint64(1))
        letters = np.where(gap, 0, letters ^ letters >> np.uint64(29))
        words = np.add.reduceat(letters * _FACTORS[2], starts)
        yield _bucket(words, bits)
        again = np.concatenate([[before] if before is not None else [~words[0]], words[:-1]]) == words
        before = words[-1]
        yield np.zeros(int(again.sum()), np.int32)


def learn(sample: list[tuple[str, int]], params: Params) -> tuple[np.ndarray, float]:
    """(share of each bucket in the logit difference, bias).

    Classes weigh alike.  Without rows of both classes there is nothing to
    learn and every score is the neutral 0.5 (bias 0, no shares).
    """
    labels = np.array([y for _, y in sample], np.int64)
    if len(set(labels.tolist())) < 2:
        return np.zeros(params.buckets, np.float32), 0.0
    rows = []
    for text, _ in sample:
        found = [np.empty(0, np.int32), *features(text, params)]
        bucket, count = np.unique(np.concatenate(found), return_counts=True)
        rows.append((bucket, (count / max(1, count.sum())).astype(np.float32)))
    weight = len(labels) / (2 * np.bincount(labels, minlength=2))
    random = np.random.default_rng(params.seed)
    table = random.uniform(-1 / params.dim, 1 / params.dim, (params.buckets, params.dim)).astype(np.float32)
    layer, bias = np.zeros((2, params.dim), np.float32), np.zeros(2, np.float32)
    steps, done = params.epochs * len(rows), 0
    for _ in range(params.epochs):
        for i in random.permutation(len(rows)):
            bucket, share = rows[i]
            mean = share @ table[bucket]
            logits = layer @ mean + bias
            odds = np.exp(logits - logits.max())
            wrong = odds / odds.sum()
            wrong[labels[i]] -= 1
            step = np.float32(params.rate * (1 - done / steps) * weight[labels[i]])
            done += 1
            back = wrong @ layer
            layer -= step * np.outer(wrong, mean)
            bias -= step * np.float32(0.1) * wrong
            # Scaled like a one-word text's update: an average over thousands of features would hardly move them.
            table[bucket] -= step * np.outer(share * np.float32(len(share) ** 0.5), back)
    difference = layer[1] - layer[0]
    return (table @ difference).astype(np.float32), float(bias[1] - bias[0])


def probability(text: str, shares: np.ndarray, bias: float, params: Params) -> float:
    total, n = 0.0, 0
    for found in features(text, params):
        total += float(shares[found].sum(dtype=np.float64))
        n += len(found)
    logit = bias + (total / n if n else 0.0)
    return 1 / (1 + math.exp(-max(-40.0, min(40.0, logit))))


def score(docs: DataFrame, labels: DataFrame, target: str = "quality", threshold: float = 0.5, params: Params = Params()) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row of ``docs``.

    Learns ``target`` from at most ``params.per_class`` labelled rows of each
    class outside the held-out fold, and scores whole texts.  A null or empty
    text has the score of the bias alone; repeated rows score alike; a null
    doc_id stays null and is not held out.  Other columns are left out.
    """
    spark = docs.sparkSession
    small_batches(spark)
    sample = labelled_sample(docs, labels, target, params.per_class, params.max_chars)
    shares, bias = learn(sample, params)
    model = spark.sparkContext.broadcast((shares, bias))  # params.buckets floats
    schema = pa.schema([("doc_id", pa.int64()), ("score", pa.float64())])

    def run(source):
        for batch in source:
            rows = [(d, probability(t, *model.value, params)) for d, t in zip(*columns(batch, "doc_id", "text"))]
            yield from batches(rows, schema)

    scored = id_text(docs).mapInArrow(run, "doc_id long, score double")
    return scored.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted")
    )
