import random
from hashlib import sha256

import numpy as np
import pytest

from tests.llm.helpers import awkward_rows, empty, frame
from tidemark.llm import pieces

sentencepiece = pytest.importorskip("sentencepiece")

TEXTS = [
    "", None, " ", "a  b", " " * 40 + "x" + " " * 17, "x" * 500, "é́日本 𝔘\x00\n\t", "Ａﬁ", "thereis" * 30, "a▁b",
    "...." * 20, "  " + "." * 33, "😀😀 word", "Hello, world! It's 1999-12-31.", "print('x')  # comment\r\n\tindent",
]


@pytest.fixture(scope="module")
def model():
    return sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL)


def random_texts(model, seed=1, n=300):
    rng = random.Random(seed)
    names = [model.id_to_piece(i).replace("▁", " ") for i in range(259, model.get_piece_size())]
    letters = "abcdefghijklmnoprstuvwxyz"
    texts = []
    for _ in range(n):
        kind = rng.random()
        if kind < 0.5:
            texts.append("".join(rng.choice(names) for _ in range(rng.randrange(1, 8))))
        elif kind < 0.8:
            texts.append(" ".join("".join(rng.choice(letters) for _ in range(rng.randrange(1, 14))) for _ in range(9)))
        else:
            texts.append(" " * rng.randrange(0, 40) + rng.choice(names) + "." * rng.randrange(0, 30))
    return texts


def test_ids_are_those_of_the_model_and_decode_exactly(spark, model):
    texts = TEXTS + random_texts(model)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    encoded = pieces.encode(docs, with_ids=True)
    got = {r.doc_id: r for r in encoded.collect()}
    for i, text in enumerate(texts):
        want = model.encode(text or "")
        assert got[i].pieces == want, text
        assert got[i].n_pieces == len(want)
        assert got[i].ids_sha256 == sha256(np.array(want, "<i4").tobytes()).hexdigest()
        assert got[i].round_trip == ("▁" not in (text or ""))
    decoded = {r.doc_id: r.text for r in pieces.decode(encoded).collect()}
    assert all(decoded[i] == (t or "").replace("▁", " ") for i, t in enumerate(texts))


def test_awkward_documents(spark, model):
    rows = awkward_rows()
    got = pieces.encode(frame(spark, rows)).collect()
    assert sorted((str(r.doc_id), r.n_pieces) for r in got) == sorted((str(r[0]), len(model.encode(r[1] or ""))) for r in rows)
    assert all(r.round_trip for r in got)


def best_by_hand(unit, scores, worst):
    """Score of the best segmentation, by trying all."""
    if not unit:
        return 0.0
    options = [
        (scores.get(unit[:k], worst if k == 1 else None), k) for k in range(1, len(unit) + 1)
    ]
    return max(s + best_by_hand(unit[k:], scores, worst) for s, k in options if s is not None)


def test_viterbi_fold_finds_the_best_path(spark):
    rng = random.Random(9)
    names = {"".join(rng.choice("ab") for _ in range(rng.randrange(1, 5))) for _ in range(14)} | {"▁a", "▁"}
    normal = {p: (i + 300, -rng.random() * 10 - 0.5) for i, p in enumerate(sorted(names))}
    own = pieces.Pieces(normal, 3, frozenset(), "viterbi")
    units = sorted({"".join(rng.choice("abc") for _ in range(rng.randrange(1, 10))) for _ in range(60)})
    got = pieces.encode_units(spark.createDataFrame([(u,) for u in units], "unit string"), own).collect()
    worst = min(s for _, s in normal.values()) - 10
    scores = {p: s for p, (_, s) in normal.items()}
    found = {r.unit: pieces.cuts_of(list(r.cuts), len(r.unit)) for r in got}
    assert set(units) - set(found) == {u for u in units if not any(p in u for p in normal)}
    for unit, cuts in found.items():
        parts = [unit[a:b] for a, b in zip([0, *cuts], [*cuts, len(unit)])]
        total = sum(scores.get(p, worst) for p in parts)
        assert total == pytest.approx(best_by_hand(unit, scores, worst))


def test_empty_table(spark):
    assert pieces.encode(empty(spark)).count() == 0
