"""Toxicity by compression distance (operator 3).

Two zstandard dictionaries are trained, one on windows of ordinary text and
one on windows of toxic text.  A toxic text is ordinary text for the most
part, so the two are calibrated against each other before use: of the toxic
dictionary those runs of bytes stay, inside words or across them, whose rate in
toxic texts is surely a multiple of that in ordinary ones (rates over different
contexts, so that copies do not count as evidence), and these runs are cut out
of the ordinary dictionary.  The toxic compressor then has them on top of the
ordinary dictionary.  Both compress alike what is ordinary, and the bytes that
a window is shorter under the toxic one are what the ordinary one does not know.

The first bytes of every word are upper case and the others lower case, so a
stem at the start of a word is not the same as an ending that is spelled alike.

A text is cut into windows of words.  The gains of its windows give a few
counts against thresholds, and a logistic curve over them, fitted on labelled
texts that trained neither dictionary, gives the score.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import held_out, id_text, labelled_sample, small_batches


LEAD = 96
THRESHOLDS = (1, 2, 3, 4, 6)
FEATURES = len(THRESHOLDS) + 4
GRAM = 5
INITIAL = 5  # bytes of a word
BLOCK = 1 << 20


@dataclass(frozen=True)
class Params:
    window: int = 8  # words
    dictionary: int = 112_640  # bytes
    level: int = 13
    ratio: float = 8.0  # of a gram's rate in toxic text to that in ordinary text
    sure: float = 2.0  # standard deviations by which a toxic count may be too high
    per_class: int = 2500  # labelled rows of each class, at most
    max_chars: int = 24_000_000  # of the labelled rows of a class together, whole texts


@dataclass(frozen=True)
class Model:
    ordinary: bytes
    toxic: bytes
    weights: tuple[float, ...]


def words(text: str) -> list[bytes]:
    """Runs of anything but ASCII white space, in ASCII letters that are upper case
    in the first ``INITIAL`` bytes and lower case after them."""
    found = text.encode("utf-8", "surrogatepass").lower().split()
    return [w[:INITIAL].upper() + w[INITIAL:] for w in found]


def windows(tokens: list[bytes], size: int) -> list[bytes]:
    return [b" " + b" ".join(tokens[i : i + size]) + b" " for i in range(0, len(tokens), size)]


def _trained(samples: list[bytes], size: int) -> bytes:
    """A dictionary trained on ``samples``; for too few of them to train on,
    the samples themselves are the dictionary."""
    try:
        return zstandard.train_dictionary(size, samples).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[-size:]


def _contexts(texts: list[list[bytes]]) -> tuple[bytes, int]:
    """Every word once per different (word before, word after), and how many."""
    tokens = [w for t in texts for w in t]
    around = (hash(x) for t in texts for x in zip([b"", *t], t, [*t[1:], b""]))
    _, first = np.unique(np.fromiter(around, np.int64, len(tokens)), return_index=True)
    return b" " + b" ".join(tokens[i] for i in np.sort(first).tolist()) + b" ", len(first)


def _grams(data: bytes) -> np.ndarray:
    """The ``GRAM`` bytes at each place, as numbers."""
    one = np.frombuffer(data, np.uint8).astype(np.uint64)
    many = max(0, len(one) - GRAM + 1)
    return sum((one[i : i + many] << np.uint64(8 * i) for i in range(GRAM)), np.zeros(many, np.uint64))


def _counts(known: np.ndarray, data: bytes) -> np.ndarray:
    """How often each of the sorted grams ``known`` stands in ``data``."""
    total = np.zeros(len(known), np.int64)
    for at in range(0, len(data) if len(known) else 0, BLOCK):
        grams = _grams(data[at : at + BLOCK + GRAM - 1])
        place = np.searchsorted(known, grams).clip(max=len(known) - 1)
        total += np.bincount(place[known[place] == grams], minlength=len(known))
    return total


def _marked(data: bytes, grams: np.ndarray) -> np.ndarray:
    """For each byte of ``data`` whether one of ``grams`` covers it."""
    marked = np.zeros(len(data), bool)
    for at in np.flatnonzero(np.isin(_grams(data), grams)).tolist():
        marked[at : at + GRAM] = True
    return marked


def _runs(data: bytes, grams: np.ndarray) -> list[bytes]:
    """The different runs of ``data`` in which a gram of ``grams`` starts at every
    place but the last ``GRAM`` - 1."""
    runs, start = set(), None
    for i, known in enumerate([*np.isin(_grams(data), grams).tolist(), False]):
        if known and start is None:
            start = i
        elif not known and start is not None:
            runs.add(data[start : i + GRAM - 1])
            start = None
    return sorted(runs, key=lambda r: (len(r), r))


def _calibrated(ordinary: bytes, toxic: bytes, train: dict[int, list[list[bytes]]], params: Params) -> tuple[bytes, bytes]:
    """The ordinary dictionary without the grams that are toxic by their rates,
    and the runs of these in the toxic one."""
    (plain, n_plain), (rude, n_rude) = _contexts(train[0]), _contexts(train[1])
    grams = np.unique(_grams(toxic))
    in_toxic, in_ordinary = _counts(grams, rude), _counts(grams, plain)
    scale = n_rude / max(1, n_plain)
    own = grams[in_toxic - params.sure * np.sqrt(in_toxic) > params.ratio * scale * (in_ordinary + 1)]
    left = np.frombuffer(ordinary, np.uint8)[~_marked(ordinary, own)].tobytes()
    return left, b"".join(_runs(toxic, own))


class Distance:
    """Gains of a text's windows under the toxic against the ordinary dictionary."""

    def __init__(self, ordinary: bytes, toxic: bytes, params: Params):
        self.params = params
        # Bytes both dictionaries end with: they cost every window the same, and keep the
        # block of a short window from being stored raw, which would hide its gain.
        self.lead = ordinary[-LEAD:]
        # The toxic runs lie close before them, where it takes few bits to point at; as
        # many zeros instead keep all else as far away for the ordinary compressor.
        self.sizes = [self._compressor(ordinary[:-LEAD] + own + self.lead) for own in (bytes(len(toxic)), toxic)]

    def _compressor(self, content: bytes):
        shape = zstandard.ZstdCompressionParameters.from_level(
            self.params.level,
            write_content_size=False,
            write_checksum=False,
            write_dict_id=False,
            format=zstandard.FORMAT_ZSTD1_MAGICLESS,
        )
        if not content:
            return zstandard.ZstdCompressor(compression_params=shape).compress
        known = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        known.precompute_compress(compression_params=shape)
        return zstandard.ZstdCompressor(dict_data=known, compression_params=shape).compress

    def __call__(self, text: str) -> list[float]:
        """Features of a text: its windows with gains of 1, 2, 3, 4 and 6 bytes or
        more (logarithms), the most, their share of all windows and how many
        windows there are (logarithm).  No words: all zero."""
        ordinary, toxic = self.sizes
        lead = self.lead
        cut = [lead + w for w in windows(words(text), self.params.window)]
        gains = [len(ordinary(w)) - len(toxic(w)) for w in cut]
        found = [sum(g >= least for g in gains) for least in THRESHOLDS]
        many = max(1, len(gains))
        most = min(max(gains, default=0), 12)
        shares = [min(1.0, 10 * found[1] / many), min(1.0, 10 * found[2] / many)]
        return [*map(math.log1p, found), max(most, 0), *shares, math.log1p(len(gains))]


def _logistic(rows: np.ndarray, labels: np.ndarray, rounds: int = 60, ridge: float = 1e-2) -> np.ndarray:
    """Weights (the last one the constant) by Newton's method."""
    data = np.column_stack([rows, np.ones(len(rows))])
    weights = np.zeros(data.shape[1])
    for _ in range(rounds):
        odds = 1 / (1 + np.exp(-np.clip(data @ weights, -30, 30)))
        slope = data.T @ (odds - labels) + ridge * weights
        curve = (data.T * (odds * (1 - odds))) @ data + ridge * np.eye(len(weights))
        step = np.linalg.solve(curve, slope)
        weights -= step
        if np.abs(step).max() < 1e-8:
            break
    return weights


def learn(sample: list[tuple[str, int]], params: Params = Params()) -> Model:
    """The dictionaries from every first and second of three sampled texts, the
    curve from every third.  Without both classes every score is 0.5."""
    by_class = {y: [t for t, label in sample if label == y] for y in (0, 1)}
    train = {y: [words(t) for i, t in enumerate(ts) if i % 3 < 2] for y, ts in by_class.items()}
    if not train[0] or not train[1]:
        return Model(b"", b"", (0.0,) * (FEATURES + 1))
    ordinary, toxic = (_trained([w for t in train[y] for w in windows(t, params.window // 2)], params.dictionary) for y in (0, 1))
    ordinary, content = _calibrated(ordinary, toxic, train, params)
    distance = Distance(ordinary, content, params)
    rest = [(t, y) for y, ts in by_class.items() for t in ts[2::3]]
    rest = rest or [(t, y) for t, y in sample]
    rows, labels = np.array([distance(t) for t, _ in rest]), np.array([y for _, y in rest])
    if len(set(labels.tolist())) < 2:
        return Model(b"", b"", (0.0,) * (FEATURES + 1))
    return Model(ordinary, content, tuple(_logistic(rows, labels).tolist()))


class Scorer:
    def __init__(self, model: Model, params: Params):
        self.distance = Distance(model.ordinary, model.toxic, params)
        self.weights = model.weights

    def __call__(self, text: str) -> float:
        logit = sum(w * x for w, x in zip(self.weights, [*self.distance(text), 1.0]))
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, logit))))


def rater(docs: DataFrame, labels: DataFrame, target: str, params: Params):
    """A column function from text to score, learned from ``docs`` and ``labels``."""
    spark = docs.sparkSession
    small_batches(spark)
    model = learn(labelled_sample(docs, labels, target, params.per_class, params.max_chars), params)
    sent = spark.sparkContext.broadcast(model)  # two dictionaries of bounded size

    @F.pandas_udf("double")
    def rate(source: Iterator[pd.Series]) -> Iterator[pd.Series]:
        scorer = Scorer(sent.value, params)
        for texts in source:
            yield pd.Series([scorer(t) for t in texts], dtype="float64")

    return lambda text: rate(F.coalesce(text, F.lit("")))


def score(docs: DataFrame, labels: DataFrame, target: str = "toxic", threshold: float = 0.7, params: Params = Params()) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row of ``docs``.

    Learns ``target`` from at most ``params.per_class`` labelled rows of each
    class outside the held-out fold, and scores whole texts.  A null or empty
    text has no window and the score of none; repeated rows score alike; a
    null doc_id stays null and is not held out.  Other columns are left out.
    """
    rate = rater(docs, labels, target, params)
    return (
        id_text(docs)
        .select("doc_id", held_out(F.col("doc_id")).alias("held_out"), rate(F.col("text")).alias("score"))
        .withColumn("predicted", (F.col("score") >= threshold).cast("int"))
    )


def drop_toxic(docs: DataFrame, labels: DataFrame, threshold: float = 0.7, params: Params = Params()) -> DataFrame:
    """``docs``, all columns, without the rows that score ``threshold`` or more."""
    rate = rater(docs, labels, "toxic", params)
    return docs.where(rate(docs["text"]) < threshold)
