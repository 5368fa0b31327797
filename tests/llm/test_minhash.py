import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.helpers import WORDS, awkward_rows, empty, frame, prose
from tidemark.llm import minhash


def set_by_hand(text):
    words = [w.decode() for w in (text or "").encode().lower().split()]
    if not words:
        return frozenset()
    return frozenset(" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3)))


def groups_by_hand(rows, percent=80):
    """(doc_id, n, component, kept) by comparing all pairs of rows."""
    sets = [set_by_hand(r[1]) for r in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if both and 100 * both >= percent * (len(a) + len(sets[j]) - both):
                parent[find(i)] = find(j)
    out = []
    for i, row in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if find(j) == find(i) and rows[j][0] is not None]
        least = min(ids, default=None)
        out.append((str(row[0]), len(sets[i]), str(least), row[0] == least))
    return sorted(out)


def collected(df):
    return sorted((str(r.doc_id), r.n_shingles, str(r.component_id), r.kept) for r in df.collect())


def near_rows(seed, families, members, words):
    """Families of texts with a few words changed, so that many similarities are around 0.8."""
    rng = random.Random(seed)
    rows = []
    for _ in range(families):
        base = [f"{rng.choice(WORDS)}{rng.randrange(40)}" for _ in range(words)]
        for _ in range(members):
            text = list(base)
            for _ in range(rng.randrange(0, 1 + words // 20)):
                text[rng.randrange(words)] = f"new{rng.randrange(10**6)}"
            rows.append((len(rows), " ".join(text), "en", "a", None))
    rng.shuffle(rows)
    return rows


def test_awkward_rows_equal_brute_force(spark):
    rows = awkward_rows()
    assert collected(minhash.near_groups(frame(spark, rows))) == groups_by_hand(rows)
    assert minhash.near_groups(empty(spark)).collect() == []


@pytest.mark.parametrize("percent, tile", [(80, 128), (80, 2), (90, 3)])
def test_chains_of_near_copies_equal_brute_force(spark, percent, tile):
    rows = near_rows(11, 6, 25, 90)
    got = minhash.near_groups(frame(spark, rows), percent=percent, tile=tile)
    assert collected(got) == groups_by_hand(rows, percent)


def test_a_bucket_keeps_links_that_its_least_member_does_not_have(spark, monkeypatch):
    """All texts share one bucket a band, and it alone: the tiles have to find every link."""
    rows = near_rows(5, 8, 12, 70)
    texts = frame(spark, rows)
    described = minhash._described

    def one_bucket(batches):
        for batch in described(batches):
            bands = minhash.pa.array([[*range(minhash.BANDS)]] * batch.num_rows, minhash.pa.list_(minhash.pa.int64()))
            yield batch.set_column(batch.schema.get_field_index("bands"), "bands", bands)

    monkeypatch.setattr(minhash, "_described", one_bucket)
    for tile in (128, 5):
        assert collected(minhash.near_groups(texts, tile=tile)) == groups_by_hand(rows)


def test_matrix_product_counts_what_sets_share(monkeypatch):
    rng = np.random.default_rng(9)
    left = [np.unique(rng.integers(0, 60, n, dtype=np.uint64)) for n in (1, 5, 40, 60)]
    right = [np.unique(rng.integers(0, 60, n, dtype=np.uint64)) for n in (3, 50, 7)]
    for cells in (1 << 22, 30):
        monkeypatch.setattr(minhash, "CELLS", cells)
        got = minhash.common(left, right)
        assert got.tolist() == [[len(np.intersect1d(a, b)) for b in right] for a in left]


def test_hot_class_and_rows_without_text(spark):
    docs = spark.range(3000).select(
        F.col("id").alias("doc_id"),
        F.when(F.col("id") % 3 == 0, "one text of six words here").when(F.col("id") % 3 == 1, F.lit(None))
        .otherwise(F.concat(F.lit("w"), F.col("id").cast("string"))).alias("text"),
    )
    got = minhash.near_groups(docs)
    assert got.filter("n_shingles = 3 AND component_id = 0").count() == 1000
    assert got.filter("n_shingles = 0 AND component_id = doc_id AND kept").count() == 1000
    assert got.filter("kept").count() == 2001


def test_sketches_fill_every_coordinate_and_estimate_similarity():
    rng = np.random.default_rng(2)
    for n in (1, 2, 5, 40, 160, 500, 30_000, 70_000):
        hashes = np.unique(rng.integers(0, 2**63, n, dtype=np.uint64))
        marks = minhash.sketch(hashes)
        assert (marks < np.iinfo(np.uint64).max).all()
        # Round by round, as the method is described.
        if n <= 500:
            plain = np.full(minhash.SKETCH, np.iinfo(np.uint64).max, np.uint64)
            for i in range(2 * minhash.SKETCH):
                x = minhash._mixed(hashes ^ minhash._mixed(np.array([i], np.uint64) + np.uint64(0x5851F42D4C957F2D)))
                low = x & np.uint64((1 << 40) - 1)
                place = (x >> np.uint64(40)).astype(object) * minhash.SKETCH >> 24
                for p, v in zip(place, low):
                    p = int(p) if i < minhash.SKETCH else i - minhash.SKETCH
                    plain[p] = min(plain[p], np.uint64(i << 40) | v)
            assert (plain == marks).all()
    errors = []
    for _ in range(60):
        pool = rng.integers(0, 2**63, 480, dtype=np.uint64)
        a, b = minhash.sketch(np.unique(pool[:430])), minhash.sketch(np.unique(pool[50:]))
        errors.append((a == b).mean() - 380 / 480)
    assert abs(np.mean(errors)) < 0.015 and np.std(errors) < 0.05


def test_sets_equal_their_words():
    words = minhash.Words()
    rng = random.Random(1)
    texts = [prose(rng, n) for n in (1, 2, 3, 4, 5, 50, 400)] + ["A b\tC\x0bd  e", "", " \n", "É é a a a a a a"]
    for text in texts:
        assert len(minhash.shingles(text.encode(), words)) == len(set_by_hand(text))
    a, b = (minhash.shingles(t, words) for t in (b"a b c", b"a b c d"))
    assert not np.intersect1d(a, b).size
    assert minhash.linked(a, a) and not minhash.linked(a, b)
