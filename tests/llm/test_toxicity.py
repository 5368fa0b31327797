import random
from zlib import crc32

import numpy as np
import pytest

from tests.llm.helpers import WORDS, awkward_rows, empty, frame
from tidemark.llm import toxicity

STEMS = ["vekku", "lostra"]


def corpus(n=900, seed=4):
    """Texts of plain words; toxic ones have two words with a stem and an ending of their own."""
    rng = random.Random(seed)
    docs, labels = [], []
    for i in range(n):
        words = [rng.choice(WORDS) + rng.choice(["a", "en", "is", "or"]) for _ in range(rng.randrange(20, 200))]
        toxic = rng.random() < 0.25
        if toxic:
            for _ in range(2):
                ending = "".join(rng.choice("abcdefgh") for _ in range(3))
                words[rng.randrange(len(words))] = rng.choice(STEMS) + ending
        docs.append((i, " ".join(words), "en", "s", None))
        labels.append((i, 1, int(toxic)))
    return docs, labels


LABELS = "doc_id long, quality int, toxic int"


@pytest.fixture(scope="module")
def scored(spark):
    docs, labels = corpus()
    got = toxicity.score(frame(spark, docs), spark.createDataFrame(labels, LABELS)).collect()
    return got, {r[0]: r[2] for r in labels}


def test_held_out_documents(scored):
    got, truth = scored
    held = [r for r in got if r.held_out]
    assert all(r.held_out == (crc32(str(r.doc_id).encode()) % 3 == 1) for r in got)
    toxic = [r.score for r in held if truth[r.doc_id]]
    clean = [r.score for r in held if not truth[r.doc_id]]
    assert np.mean([t > c for t in toxic for c in clean]) > 0.97
    assert np.mean([r.predicted == truth[r.doc_id] for r in held]) > 0.93
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in got)


def test_labels_of_the_held_out_fold_change_nothing(spark, scored):
    docs, labels = corpus()
    flipped = [(i, q, 1 - t if crc32(str(i).encode()) % 3 == 1 else t) for i, q, t in labels]
    got = toxicity.score(frame(spark, docs), spark.createDataFrame(flipped, LABELS)).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, scored[0]))


def test_gradients_and_ngrams():
    places, count = toxicity.buckets(["abc", "<", "abc.", "日本"])
    assert count.tolist() == [1 + 3 + 2 + 1, 1 + 1, 7, 1 + 2 + 1]
    ends = np.cumsum(count)
    assert places[: ends[0]].tolist() == places[ends[1] : ends[2]].tolist()
    texts = ["good alpha beta", "bad gamma vekku", "vekkus delta", "plain text here"]
    trainer = toxicity.Trainer(texts, np.array([0, 1, 1, 0]))
    before = trainer.passage_logits()
    for _ in range(30):
        trainer.step(np.arange(4))
    after = trainer.passage_logits()
    assert after[1] > before[1] and after[2] > before[2] and after[0] < before[0]
    # A pass over the words gives the same logits as the training passages.
    model = toxicity.Model(trainer.gram_logits(), float(trainer.bias[1] - trainer.bias[0]), 1.0, 0.0)
    known = {}
    docs = [toxicity.words_of(t) for t in texts]
    model.learn(set().union(*docs), known)
    assert np.allclose([model.largest(d, known) for d in docs], after, atol=1e-4)


def test_awkward_documents(spark):
    rows = awkward_rows()
    docs = frame(spark, rows)
    labels = spark.createDataFrame(
        [(r[0], 1, i % 2) for i, r in enumerate(rows)] + [(None, 0, 1), (3, 1, None), (9999, 1, 1), (4, 1, 7)], LABELS
    )
    got = toxicity.score(docs, labels).collect()
    assert sorted(str(r.doc_id) for r in got) == sorted(str(r[0]) for r in rows)
    assert all(0 <= r.score <= 1 for r in got)
    kept = toxicity.drop_toxic(docs, labels)
    assert kept.columns == docs.columns
    assert kept.count() == sum(r.predicted == 0 for r in got)


def test_without_labels_and_without_documents(spark):
    none = spark.createDataFrame([], LABELS)
    docs = frame(spark, awkward_rows())
    assert {r.predicted for r in toxicity.score(docs, none).collect()} == {0}
    one = spark.createDataFrame([(i, 1, 1) for i in range(60)], LABELS)
    assert {r.predicted for r in toxicity.score(docs, one).collect()} == {1}
    assert toxicity.score(empty(spark), one).count() == 0
    assert toxicity.drop_toxic(empty(spark), none).count() == 0
