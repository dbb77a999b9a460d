"""Toxicity and quality: what they learn on a planted corpus, and edge cases."""

from __future__ import annotations

import random

import numpy as np
import pytest

from tests.llm.conftest import texts
from tillroll.llm import quality, toxicity
from tillroll.llm.common import labelled_sample

SYLLABLES = "ba de fi go hu ka lo me ni po ra su ti vo wen zar".split()
RUDE = "scoundrel blockhead nincompoop".split()


def prose(rng, n):
    return ["".join(rng.choice(SYLLABLES) for _ in range(rng.randint(1, 4))) for _ in range(n)]


@pytest.fixture(scope="module")
def corpus(spark, store):
    rng = random.Random(1)
    rows, labels = [], []
    for i in range(900):
        own = prose(rng, rng.randint(20, 200))
        toxic, good = int(i % 4 == 0), int(i % 3 != 0)
        if toxic:
            for _ in range(rng.randint(2, 6)):
                own.insert(rng.randrange(len(own)), rng.choice(RUDE))
        if not good:
            own = [w.upper() + "!!" for w in own] if i % 2 else [w for w in own for _ in range(6)]
        rows.append((i, " ".join(own)))
        labels.append((i, good, toxic))
    return (
        store(spark.createDataFrame(rows, "doc_id long, text string"), "prose"),
        store(spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), "prose-labels"),
    )


@pytest.mark.parametrize("module,target,threshold", [(toxicity, "toxic", 0.7), (quality, "quality", 0.5)])
def test_held_out_accuracy(corpus, module, target, threshold):
    docs, labels = corpus
    out = module.score(docs, labels, target, threshold).join(labels, "doc_id").where("held_out").collect()
    assert len(out) > 200
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= threshold) for r in out)
    right = np.mean([r.predicted == r[target] for r in out])
    assert right > 0.95


def test_held_out_rows_and_other_columns_are_never_learned(spark, corpus, store):
    from zlib import crc32

    docs, labels = corpus
    many = 10_000_000
    sample = labelled_sample(docs, labels, "toxic", 10_000, many)
    held = {r.text for r in docs.collect() if crc32(str(r.doc_id).encode()) % 3 == 1}
    assert sample and not {t for t, _ in sample} & held
    assert len(labelled_sample(docs, labels, "toxic", 7, many)) == 14
    flipped = labels.selectExpr("doc_id", "quality", "IF(crc32(CAST(doc_id AS STRING)) % 3 = 1, 1 - toxic, toxic) AS toxic")
    assert sorted(labelled_sample(docs, flipped, "toxic", 50, many)) == sorted(labelled_sample(docs, labels, "toxic", 50, many))


def test_the_sample_is_bounded_by_rows_and_never_cuts_a_text(corpus):
    docs, labels = corpus
    whole = {r.text for r in docs.collect()}
    free = labelled_sample(docs, labels, "toxic", 50, 10_000_000)
    bound = 8_000
    sample = labelled_sample(docs, labels, "toxic", 50, bound)
    assert {t for t, _ in sample} <= whole and set(sample) < set(free)
    for label in (0, 1):
        size = sum(len(t) for t, y in sample if y == label)
        assert bound / 2 < size <= bound


@pytest.mark.parametrize("module", [toxicity, quality])
def test_edge_cases(docs, empty, labels, module):
    out = module.score(docs, labels).collect()
    assert len(out) == len(texts()) and all(0 <= r.score <= 1 for r in out)
    by_text = {}
    for r in out:
        if r.doc_id in (40, 41, 42):  # null, empty, white space
            by_text.setdefault("none", set()).add(r.score)
    assert len(by_text["none"]) == 1
    assert all(r.held_out is False for r in out if r.doc_id is None)
    assert module.score(empty, labels).count() == 0
    unlearned = module.score(docs, labels.limit(0)).collect()
    assert {r.score for r in unlearned} == {0.5}


def test_quality_blocks_do_not_lose_features(monkeypatch):
    params = quality.Params()
    text = " ".join([*prose(random.Random(3), 300), "same", "same", "  ", "x" * 1000, "same", "y"]) + " " * 600
    whole = np.sort(np.concatenate(list(quality.features(text, params))))
    monkeypatch.setattr(quality, "BLOCK", 256)
    parts = np.sort(np.concatenate(list(quality.features(text, params))))
    assert np.array_equal(whole, parts)


def test_drop_toxic_keeps_columns_and_clean_rows(corpus):
    docs, labels = corpus
    left = toxicity.drop_toxic(docs, labels)
    assert left.columns == docs.columns
    truth = {r.doc_id: r.toxic for r in labels.collect()}
    kept = [truth[r.doc_id] for r in left.collect()]
    clean = sum(1 for t in truth.values() if not t)
    assert kept.count(1) <= 0.05 * (len(truth) - clean) and kept.count(0) >= 0.97 * clean


def test_toxic_stems_that_ordinary_words_end_in():
    rng = random.Random(5)
    stem = "achlich"  # at the start of toxic words, at the end of ordinary ones

    def text(toxic):
        own = [w + stem if rng.random() < 0.05 else w for w in prose(rng, 100)]
        if toxic:
            for _ in range(4):
                own.insert(rng.randrange(len(own)), stem + "".join(prose(rng, 1)))
        elif rng.random() < 0.03:
            own.append(stem)
        return " ".join(own)

    rows = [(text(i % 6 == 0), int(i % 6 == 0)) for i in range(1200)]
    params = toxicity.Params()
    scorer = toxicity.Scorer(toxicity.learn(rows[:900], params), params)
    found = {y: np.mean([scorer(t) >= 0.7 for t, label in rows[900:] if label == y]) for y in (0, 1)}
    assert found[1] > 0.9 and found[0] < 0.02
