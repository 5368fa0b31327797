import numpy as np
import xxhash
from pyspark.sql import functions as F

from tests.llm.helpers import awkward_rows, empty, frame
from tidemark.llm import simhash
from tidemark.llm.components import components


def fingerprint_by_hand(text):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or ([b" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups_by_hand(marks):
    """Root (an index) of each fingerprint by comparing all pairs."""
    marks = np.array(marks, np.uint64)
    parent = list(range(len(marks)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(marks)):
        for j in np.flatnonzero(np.bitwise_count(marks[i] ^ marks[i + 1:]) <= 3) + i + 1:
            a, b = find(i), find(int(j))
            parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(marks))]


def near_marks(seed=0):
    rng = np.random.default_rng(seed)
    marks = {0, 2**64 - 1, 2**64 - 2, 7}
    for base in rng.integers(0, 2**63, 20, dtype=np.uint64):
        for _ in range(40):
            mark = int(base)
            for bit in rng.integers(0, 64, rng.integers(0, 5)):
                mark ^= 1 << int(bit)
            marks.add(mark)
    return sorted(marks)


def signed(mark):
    return int(np.uint64(mark).view(np.int64))


def test_links_lose_no_pair_whatever_the_subtree_size(spark):
    marks = near_marks()
    df = spark.createDataFrame([(signed(m),) for m in marks], "bits long")
    roots = groups_by_hand(marks)
    want = {}
    for mark, root in zip(marks, roots):
        want.setdefault(root, set()).add(mark)
    for subtree_rows in (20_000, 12):
        label = {r.node: r.root for r in components(simhash.links(df, subtree_rows)).collect()}
        got = {}
        for mark in marks:
            got.setdefault(label.get(signed(mark), signed(mark)), set()).add(mark)
        assert sorted(map(sorted, got.values())) == sorted(map(sorted, want.values()))


def test_awkward_documents(spark):
    rows = awkward_rows()
    marks = [fingerprint_by_hand(r[1]) for r in rows]
    distinct = sorted(set(marks))
    root = dict(zip(distinct, groups_by_hand(distinct)))
    ids = {}
    for row, mark in zip(rows, marks):
        ids.setdefault(root[mark], []).append(row[0])
    least = {k: min((i for i in v if i is not None), default=None) for k, v in ids.items()}
    got = simhash.near_groups(frame(spark, rows)).collect()
    assert sorted((str(r[0]), r[1], str(r[2])) for r in got) == sorted(
        (str(r[0]), f"{m:016x}", str(least[root[m]])) for r, m in zip(rows, marks)
    )
    docs = frame(spark, rows)
    kept = simhash.drop_near_copies(docs)
    assert kept.columns == docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(map(str, least.values()))


def test_chain_is_one_component(spark):
    links = spark.range(300).select(F.col("id").alias("u"), (F.col("id") + 1).alias("v"))
    assert {r.root for r in components(links).collect()} == {0}


def test_empty_table(spark):
    assert simhash.near_groups(empty(spark)).count() == 0
    assert simhash.drop_near_copies(empty(spark)).count() == 0
