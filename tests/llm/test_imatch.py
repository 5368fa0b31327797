from hashlib import sha256

import numpy as np
from pyspark.sql import functions as F

from tests.llm.helpers import WORDS, awkward_rows, empty, frame
from tidemark.llm import imatch


def test_order_edits_and_likeness(spark):
    rows = awkward_rows()
    docs = frame(spark, rows)
    lexicon = imatch.build_lexicon(docs)
    version = {r.text: r.v for r in docs.select(F.coalesce("text", F.lit("")).alias("text"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("v")).collect()}
    texts = sorted(
        ((r[0], r[1] or "") for r in rows),
        key=lambda r: (r[0] is None, -(r[0] or 0), -version[r[1]]),
    )
    want = []
    for i, (doc_id, text) in enumerate(texts):
        following = texts[(i + 1) % len(texts)][1]
        cut = len(text) // 3
        edited = text[: len(text) - cut] + following[:cut]
        mark, other, after = (imatch.fingerprint(t.encode(), lexicon) for t in (text, edited, following))
        want.append((
            str(doc_id), len(text), sha256(edited.encode()).hexdigest(), mark, other,
            imatch.likeness(mark, other), imatch.likeness(mark, after),
        ))
    got = imatch.fingerprints(docs).collect()
    assert sorted((str(r[0]), *r[1:]) for r in got) == sorted(want)


def test_lexicon_is_the_band_over_all_documents(spark):
    docs = frame(spark, awkward_rows())
    counts = {}
    for row in docs.collect():
        for term in imatch.terms_of((row.text or "").encode()):
            counts[term] = counts.get(term, 0) + 1
    total = docs.count()
    band = {t for t, n in counts.items() if max(2, total * imatch.MIN_SHARE) <= n <= max(2, total * imatch.MAX_SHARE)}
    assert sorted(imatch._hash(band)) == imatch.build_lexicon(docs).tolist()


def test_fingerprints_tell_edits_from_other_texts():
    rng = np.random.default_rng(0)
    lexicon = imatch._hash({f"term{i}".encode() for i in range(4000)})
    near, far = [], []
    for _ in range(100):
        own = [f"term{i}" for i in rng.integers(0, 4000, 120)]
        edit = own[:100] + [f"term{i}" for i in rng.integers(0, 4000, 20)]
        other = [f"term{i}" for i in rng.integers(0, 4000, 120)]
        marks = [imatch.fingerprint(" ".join(w + [WORDS[0]]).encode(), lexicon) for w in (own, edit, other)]
        near.append(imatch.likeness(marks[0], marks[1]))
        far.append(imatch.likeness(marks[0], marks[2]))
    assert np.mean(near) > 0.55 and np.mean(far) < 0.1
    assert imatch.fingerprint(b"b a  A", lexicon) == imatch.fingerprint(b"a, b.", lexicon)
    assert imatch.likeness(imatch.fingerprint(b"", lexicon), imatch.fingerprint(b" ,", lexicon)) == 1


def test_one_document_follows_itself_and_none_gives_none(spark):
    docs = spark.createDataFrame([(5, "one two three")], "doc_id long, text string")
    assert imatch.fingerprints(docs).first()["near_next"] == 1
    assert imatch.fingerprints(empty(spark)).count() == 0
