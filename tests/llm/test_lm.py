import math
import random
from collections import Counter
from zlib import crc32

import numpy as np
import pyarrow as pa
import pytest
import zstandard
from pyspark.sql import functions as F

from tests.llm.helpers import awkward_rows, empty, frame, prose
from tidemark.llm import lm

pytest.importorskip("sentencepiece")


def base_by_hand(rows):
    counts = Counter()
    for doc_id, text, *_ in rows:
        if doc_id is not None and crc32(str(doc_id).encode()) % 7 != 2:
            counts.update([*(text or "").encode().lower().split(), None])
    total, distinct = sum(counts.values()), len(counts)
    found = []
    for doc_id, text, *_ in rows:
        tokens = [*(text or "").encode().lower().split(), None]
        found.append((
            str(doc_id), doc_id is None or crc32(str(doc_id).encode()) % 7 == 2, len(tokens), sum(counts[t] > 0 for t in tokens), total,
            round(sum(math.log10((counts[t] + 1) / (total + 1 * (distinct + 1))) for t in tokens), 6),
        ))
    return sorted(found)


def test_base_score_equals_brute_force(spark):
    rows = awkward_rows()
    got = lm.score(frame(spark, rows)).collect()
    assert sorted((str(r[0]), *r[1:5], round(r[5], 6)) for r in got) == base_by_hand(rows)
    assert all(r.score < 0 for r in got)


def test_gradients():
    rng = np.random.default_rng(0)
    model = lm.Attention.fresh(np.append(np.arange(20), 20), 21, lm.CLASSES, rng)
    for name, weight in model.weights().items():
        setattr(model, name, weight.astype(np.float64))
    ids = rng.integers(3, 20, 70)
    inputs, targets, _ = lm.windows_of(ids, np.array([0, 50]), np.array([50, 20]))
    assert (targets >= 0).sum() == 70
    _, slopes = model.gradients(inputs, targets)
    for name, weight in model.weights().items():
        at = (7, 3) if name == "embedding" else tuple(rng.integers(0, s) for s in weight.shape)
        kept, step = weight[at], 1e-5
        losses = []
        for shift in (step, -step):
            weight[at] = kept + shift
            losses.append(model.gradients(inputs, targets)[0])
        weight[at] = kept
        assert (losses[0] - losses[1]) / (2 * step) == pytest.approx(slopes[name][at], rel=1e-3, abs=1e-8)


def tiny_model(seed=0, size=30):
    rng = np.random.default_rng(seed)
    starts = rng.random(size) < 0.4
    starts[lm.END] = True
    sample = [np.append(rng.integers(3, size - 5, 200), lm.END) for _ in range(4)]
    of = lm.classes_of(sample, starts)
    cells = np.zeros((lm.CLASSES + 1, size))
    for ids in sample:
        np.add.at(cells, (lm.contexts(ids, of, starts), ids), 1)
    return lm.LanguageModel(lm.train(sample, of), of, lm.shares(cells, of), starts), size


def test_probabilities_of_the_next_id_add_up_to_one():
    model, size = tiny_model()
    for prefix in ([], [5], [5, 9, 4], list(range(3, 25)) * 2):
        seqs = [np.array([*prefix, i]) for i in range(size)]
        lengths = np.array([len(s) for s in seqs])
        whole = model.score(np.concatenate(seqs), np.cumsum(lengths) - lengths, lengths)
        before = model.score(np.array(prefix, np.int64), np.array([0]), np.array([len(prefix)]))[0] if prefix else 0.0
        assert np.sum(10 ** (whole - before)) == pytest.approx(1, abs=2e-3)


def test_each_id_is_scored_once_whatever_is_scored_with_it():
    model, size = tiny_model(1)
    rng = np.random.default_rng(2)
    seqs = [rng.integers(3, size, n) for n in (1, 15, 16, 17, 32, 33, 100, 500)]
    lengths = np.array([len(s) for s in seqs])
    together = model.score(np.concatenate(seqs), np.cumsum(lengths) - lengths, lengths)
    alone = [model.score(s, np.array([0]), np.array([len(s)]))[0] for s in seqs]
    assert np.allclose(together, alone, rtol=1e-5)
    # Windows of a long text give what a full mask over its context gives.
    long = seqs[-1]
    inputs, targets, _ = lm.windows_of(long, np.array([0]), np.array([len(long)]))
    assert targets[targets >= 0].tolist() == long.tolist()
    assert inputs[0][: lm.LEAD].tolist() == [-1] * lm.LEAD and inputs[0][lm.LEAD] == lm.START


def test_ids_are_scored_from_sixteen_earlier_ones_in_128_classes():
    ids = np.arange(3, 203)
    inputs, targets, _ = lm.windows_of(ids, np.array([0]), np.array([200]))
    assert inputs.shape[1] == 32 and lm.CLASSES == 128
    assert (inputs[1:, :16] >= 0).all() and (targets[0] == ids[:16]).all()
    rng = np.random.default_rng(4)
    of = lm.classes_of([rng.integers(3, 400, 5000)], np.arange(400) % 2 == 0)
    assert sum(n == 1 for n in Counter(of.tolist()).values()) >= 64


def test_the_sample_is_cut_by_hash():
    drawn = [{"place": i * 7919 % 1000, "id": i, "text": "a"} for i in range(1000)]
    assert [r["place"] for r in lm.lowest(drawn, 300)] == list(range(300))
    assert max(r["id"] for r in lm.lowest(drawn, 300)) > 950


def test_a_trained_model_beats_an_untrained_one(spark):
    import random

    rng = random.Random(8)
    rows = [(i, prose(rng, 80), "en", "a", None) for i in range(300)]
    got = [r for r in lm.score(frame(spark, rows)).collect() if r.held_out]
    plain = sum(r.n_tokens for r in got) * -math.log10(32_000)
    assert sum(r.score for r in got) > 0.6 * plain


def test_empty_table(spark):
    assert lm.score(empty(spark)).count() == 0


def test_long_texts_train_and_one_id_does_not_flood_the_sample(spark, monkeypatch):
    """Texts over the bound give a stretch each; rows of one id are drawn like others."""
    rng = random.Random(12)
    monkeypatch.setattr(lm, "LONGEST", 300)
    drawn, train = [], lm.train
    monkeypatch.setattr(lm, "train", lambda sample, of: drawn.append(sample) or train(sample, of))
    rows = [(i, prose(rng, 150), "en", "a", None) for i in range(40)]
    assert lm.score(frame(spark, rows)).count() == 40
    learns = [i for i in range(40) if crc32(str(i).encode()) % 7 != 2]
    assert len(drawn[0]) == len(learns) and all(30 < len(ids) <= 301 for ids in drawn[0])
    same = spark.range(2000).select(F.lit(learns[0]).cast("long").alias("doc_id"), F.lit("one two three").alias("text"))
    assert lm.score(same, sample_docs=20).count() == 2000
    assert len(drawn[1]) == 20


def sequences(rows):
    """The ids of each training document, whole."""
    subwords = lm.Subwords(lm.MODEL)
    learns = [r for r in rows if crc32(str(r[0]).encode()) % 7 != 2]
    return [np.append(subwords.ids(lm.words_of(r[1].encode()))[0], lm.END) for r in learns], subwords.starts()


def test_classes_and_attention_come_from_all_training_documents(spark, monkeypatch):
    """Two documents are drawn to start from; what the others hold is learned all the same."""
    rng = random.Random(21)
    rows = [(i, " ".join([prose(rng, 30), f"{chr(97 + i % 26) * 3}{i}"] * 4), "en", "a", None) for i in range(120)]
    kept, shares, taught = [], lm.shares, lm.taught
    monkeypatch.setattr(lm, "shares", lambda cells, of: kept.append((cells.sum(axis=0), of)) or shares(cells, of))
    monkeypatch.setattr(lm, "taught", lambda encoded, model, of: kept.append((model, taught(encoded, model, of))) or kept[-1][1])
    got = lm.score(frame(spark, rows), sample_docs=2).collect()
    (start, after), (counted, of) = sorted(kept, key=lambda k: isinstance(k[0], np.ndarray))
    whole, starts = sequences(rows)
    flat = np.concatenate(whole)
    assert (of == lm.classes_of(whole, starts)).all()
    assert (counted == np.bincount(flat, minlength=len(of))).all()
    known = np.unique(flat)
    assert (after.row[known] < len(after.embedding) - 1).all()
    lengths = np.array([len(ids) for ids in whole])
    inputs, targets, _ = lm.windows_of(flat, np.cumsum(lengths) - lengths, lengths)
    classes = np.where(targets >= 0, of[targets], -1)
    moved = {r for r in np.unique(after.row[inputs[inputs >= 0]]) if (after.embedding[r] != start.embedding[r]).any()}
    assert moved == set(after.row[[lm.START, *known[known != lm.END]]])
    assert after.slopes(inputs, classes)[0] < start.slopes(inputs, classes)[0]
    plain = sum(r.score for r in got)
    monkeypatch.setattr(lm, "taught", lambda encoded, model, of: model)
    assert plain > sum(r.score for r in lm.score(frame(spark, rows), sample_docs=2).collect())


def test_windows_laid_out_in_parts_are_those_laid_out_at_once():
    rng = np.random.default_rng(6)
    lengths = np.array([1, 40, 0, 16, 333])
    ids, starts = rng.integers(3, 90, lengths.sum()), np.cumsum(lengths) - lengths
    whole = lm.windows_of(ids, starts, lengths)
    many = int(lm.windows_in(lengths).sum())
    for width in (1, 5, many):
        parts = [lm.windows_of(ids, starts, lengths, i, i + width) for i in range(0, many, width)]
        assert all((np.concatenate(p) == w).all() for p, w in zip(zip(*parts), whole))


def test_neighbours_do_not_cross_documents():
    beside = lm.Neighbours(np.bincount(np.repeat(np.arange(200), np.arange(200, 0, -1))))
    ids, other = np.array([70, 1, 80]), np.array([90, 2])
    together = beside.cells(np.concatenate([ids, other]), np.array([3, 2]))
    assert sorted(together) == sorted([*beside.cells(ids, np.array([3])), *beside.cells(other, np.array([2]))])


def test_neighbours_of_a_long_row_are_counted_in_parts(monkeypatch):
    rng = np.random.default_rng(9)
    lengths = np.array([400, 3, 1, 250, 90])
    ids = rng.integers(3, 200, lengths.sum())
    beside = lm.Neighbours(np.bincount(ids, minlength=200))
    monkeypatch.setattr(lm, "learned", lambda batches, kind: batches)
    monkeypatch.setattr(lm, "IDS_AT_ONCE", 7)
    monkeypatch.setattr(lm, "NEIGHBOURS_AT_ONCE", 50)
    counts = Counter()
    for batch in beside(iter([(ids, lengths)])):
        counts.update(dict(zip(batch["cell"].to_pylist(), batch["n"].to_pylist())))
    assert counts == Counter(beside.cells(ids, lengths).tolist())


def test_a_place_needs_logits_of_groups_and_of_one_group_only():
    """The two softmaxes give what one over all classes would, from 24 of 128 exponentials."""
    rng = np.random.default_rng(3)
    top, out, flat = rng.normal(size=(lm.DIMENSIONS, lm.GROUPS)), rng.normal(size=(lm.DIMENSIONS, lm.CLASSES)), rng.normal(size=(500, lm.DIMENSIONS))
    prior, classes = rng.normal(size=(3, lm.GROUPS, lm.GROUPS + lm.IN_GROUP)), rng.integers(0, lm.CLASSES, 500)
    order, runs = lm.by_group(classes)
    flat, group, context = flat[order], classes[order] // lm.IN_GROUP, rng.integers(0, 3, 500)
    e, sums = lm.class_exponentials(flat, context, group, runs, lm.beside_each_group(top, out).transpose(1, 0, 2), prior)
    assert e.shape == (500, 24)
    for row, h, c, g, total in zip(e, flat, context, group, sums):
        own = slice(g * lm.IN_GROUP, (g + 1) * lm.IN_GROUP)
        assert np.allclose(row, np.exp(np.append(h @ top, h @ out[:, own]) + prior[c, g]))
        assert np.allclose(total, [row[: lm.GROUPS].sum(), row[lm.GROUPS :].sum()])


def test_pairs_of_classes_do_not_cross_documents_and_are_counted_in_parts(monkeypatch):
    rng = np.random.default_rng(10)
    lengths = np.array([40, 3, 0, 1, 25, 7, 90])
    ids, of = rng.integers(3, 200, lengths.sum()), rng.integers(0, lm.CLASSES, 200)
    wanted, at = Counter(), 0
    for n in lengths:
        classes = of[ids[at : at + n]].tolist()
        wanted.update(zip([lm.CLASSES, *classes], classes))
        at += n
    for many in (1, 7, 40, 1000):
        monkeypatch.setattr(lm, "IDS_AT_ONCE", many)
        pairs = lm.pairs_of(ids, lengths, of)
        assert {c: pairs[c] for c in zip(*np.nonzero(pairs))} == wanted
    numbered, moved = lm.in_groups(of, pairs)
    assert (moved == lm.pairs_of(ids, lengths, numbered)).all()
    assert len(set(zip(of.tolist(), numbered.tolist()))) == len(set(of.tolist())) == len(set(numbered.tolist()))


def test_classes_behind_each_other_are_counted_in_all_training_documents(spark, monkeypatch):
    rng = random.Random(33)
    rows = [(i, prose(rng, 40), "en", "a", None) for i in range(60)]
    kept, taught = [], lm.taught
    monkeypatch.setattr(lm, "taught", lambda encoded, model, of: kept.append((model, of)) or taught(encoded, model, of))
    lm.score(frame(spark, rows), sample_docs=2).collect()
    whole, _ = sequences(rows)
    model, of = kept[0]
    pairs = lm.pairs_of(np.concatenate(whole), np.array(list(map(len, whole))), of)
    assert (model.prior == lm.prior_of(pairs)).all() and (model.context[model.context < lm.CLASSES] == of[model.context < lm.CLASSES]).all()
    shares = np.exp(model.prior)
    assert np.allclose(shares[..., : lm.GROUPS].sum(axis=-1), 1, atol=1e-4) and np.allclose(shares[..., lm.GROUPS :].sum(axis=-1), 1, atol=1e-4)


def test_without_training_documents_scores_are_finite(spark):
    held = [i for i in range(100) if crc32(str(i).encode()) % 7 == 2]
    got = lm.score(frame(spark, [(i, "one two three", "en", "a", None) for i in held])).collect()
    assert len(got) == len(held) and all(r.held_out and math.isfinite(r.score) and r.score < 0 for r in got)


def test_words_are_looked_up_for_many_documents_at_once(monkeypatch):
    texts = [[b"One two  THREE", b"", b" \t "], [], [b"\xff\x00 two", b"three"], [b""], [b"one " * 50]]
    table = pa.table({
        "ids": [[10 * i + j for j in range(len(t))] for i, t in enumerate(texts)], "marks": [[1] * len(t) for t in texts],
        "sizes": [list(map(len, t)) for t in texts], "texts": [zstandard.ZstdCompressor().compress(b"".join(t)) for t in texts],
    })
    words = [b"three", b"two", b"one", b"\xff\x00"]
    looked_up, calls = lm.pc.index_in, []
    monkeypatch.setattr(lm.pc, "index_in", lambda *a, **k: calls.append(1) or looked_up(*a, **k))
    for at_once, many in ((0, 5), (1 << 20, 1)):
        monkeypatch.setattr(lm, "BYTES_AT_ONCE", at_once)
        calls.clear()
        got = list(lm.numbered(table, lm._binaries(b"".join(words), np.array(list(map(len, words))))))
        assert [k for _, k, *_ in got] == table["ids"].to_pylist() and len(calls) <= many
        assert [n.tolist() for _, _, n, _ in got] == [[len(lm.words_of(x)) for x in t] for t in texts]
        assert [own.tolist() for *_, own in got] == [[words.index(w) for x in t for w in lm.words_of(x)] for t in texts]
    empty = lm.numbered(table.slice(3, 1), lm._binaries(b"", np.zeros(0, np.int32)))
    assert [(n.tolist(), own.tolist()) for _, _, n, own in empty] == [([0], [])]
