import random
from zlib import crc32

import numpy as np
import pytest

from tests.llm.helpers import awkward_rows, empty, frame
from tidemark.llm import langid

SOUNDS = {"en": "the ing tion wh ou and".split(), "de": "sch ung ein ch ö ver".split(), "fr": "eau eux que é ment ou".split()}


def text_in(lang, rng, n):
    return " ".join("".join(rng.choice(SOUNDS[lang]) for _ in range(rng.randrange(1, 4))) for _ in range(n))


@pytest.fixture(scope="module")
def documents():
    rng = random.Random(3)
    rows = []
    for i in range(400):
        lang = rng.choice(list(SOUNDS))
        rows.append((i, text_in(lang, rng, rng.randrange(3, 60)), lang, "s", None))
    return rows


def test_held_out_documents_are_told_apart(spark, documents):
    truth = {r[0]: r[2] for r in documents}
    got = langid.identify(frame(spark, documents)).collect()
    assert len(got) == 400
    for r in got:
        assert r.held_out == (crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1
    held = [r for r in got if r.held_out]
    assert sum(r.lang_pred == truth[r.doc_id] for r in held) >= 0.98 * len(held)


def test_languages_of_held_out_rows_change_nothing(spark, documents):
    swapped = [(i, t, "xx" if crc32(str(i).encode()) % 5 == 0 else lang, "other", n) for i, t, lang, _, n in documents]
    own, other = (sorted(map(tuple, langid.identify(frame(spark, d)).collect())) for d in (documents, swapped))
    assert own == other


def test_masks_hold_every_language_of_an_ngram():
    rng = np.random.default_rng(1)
    grams = {f"l{i:03}": rng.integers(0, 2**63, 500, dtype=np.uint64) for i in range(130)}
    filters = langid.Filters.build(sorted(grams), grams)
    strangers = rng.integers(0, 2**63, 20_000, dtype=np.uint64)
    masks = filters.masks(strangers)
    for i, (name, own) in enumerate(sorted(grams.items())):
        bit = np.uint64(1) << np.uint64(i % 64)
        assert (filters.masks(own)[:, i // 64] & bit != 0).all()
        assert abs(((masks[:, i // 64] & bit) != 0).mean() - filters.false_rate[i]) < 0.002


def test_ngrams_stay_inside_words():
    codes = langid.letters("Ab, c!")
    assert "".join(map(chr, codes)) == " ab c "
    assert len(langid.ngrams(codes)) == len({" a", "ab", "b ", " c", "c ", " ab", "ab ", " c ", " ab "})


def test_filters_hold_every_ngram_of_a_language(spark):
    rng = random.Random(6)
    han = "".join(chr(0x4E00 + rng.randrange(3000)) for _ in range(9000))
    rows = [(1, han, "zh", "s", None), (2, "the " * 5000 + "theory", "en", "s", None), (3, "theorie " * 50, "de", "s", None)]
    filters = langid.learn(frame(spark, rows))
    for _, text, lang, *_ in rows:
        grams = langid.ngrams(langid.letters(text))
        bit = np.uint64(1) << np.uint64(filters.languages.index(lang))
        assert (filters.masks(grams)[:, 0] & bit != 0).all()
    assert max(filters.false_rate) < 0.02
    assert all(filters.decide(han[i : i + 2])[0] == "zh" for i in range(0, 9000, 97))


def test_single_letters_decide_where_no_ngram_does():
    grams = {"en": langid.characters(langid.letters("abc")), "ru": langid.characters(langid.letters("где"))}
    filters = langid.Filters.build(["en", "ru"], grams)
    assert filters.decide("едг") == ("ru", 1.0) and filters.decide("日") == ("en", 0.0)


def test_awkward_documents(spark):
    rows = awkward_rows()
    got = langid.identify(frame(spark, rows)).collect()
    assert sorted(str(r.doc_id) for r in got) == sorted(str(r[0]) for r in rows)
    by_id = {r.doc_id: r for r in got if r.doc_id is not None}
    assert all(by_id[i].lang_pred == "und" and by_id[i].score == 0 for i in (100, 101, 102))
    assert {r.lang_pred for r in got} <= {"en", "fr", "und"}
    assert langid.identify(empty(spark)).count() == 0
    unlabelled = frame(spark, [(i, t, None, s, n) for i, t, _, s, n in rows])
    assert {r.lang_pred for r in langid.identify(unlabelled).collect()} == {"und"}
