import hashlib
import re

import numpy as np
from pyspark.sql import functions as F

from tests.llm.helpers import awkward_rows, empty, frame
from tidemark.llm import exact


def by_hand(rows):
    groups = {}
    for doc_id, text, *_ in rows:
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", text or ""), []).append(doc_id)
    return {t: (min((i for i in ids if i is not None), default=None), len(ids)) for t, ids in groups.items()}


def test_groups_equal_brute_force(spark):
    rows = awkward_rows()
    want = by_hand(rows)
    expected = sorted(
        (str(r[0]), str(keep), n, r[0] == keep, hashlib.sha256(t.encode()).hexdigest())
        for r in rows for t in [re.sub(r"[\x20\x09-\x0D]+", " ", r[1] or "")] for keep, n in [want[t]]
    )
    for older in (None, F.lit(False), F.lit(True), F.col("doc_id") % 2 == 0):
        for shard_rows in (50_000, 5):
            got = exact.exact_groups(frame(spark, rows), older=older, shard_rows=shard_rows).collect()
            assert sorted((str(r[0]), str(r[1]), *r[2:]) for r in got) == expected


def test_one_row_of_each_group_stays(spark):
    rows = awkward_rows()
    docs = frame(spark, rows)
    kept = exact.drop_copies(docs)
    assert kept.columns == docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(keep) for keep, _ in by_hand(rows).values())


def test_hot_group_and_empty_table(spark):
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 > 0, "same text").otherwise(F.col("id").cast("string")).alias("text"))
    got = exact.exact_groups(docs)
    assert got.filter("kept").count() == 1001
    assert got.agg(F.max("group_size")).first()[0] == 2000
    assert exact.exact_groups(empty(spark)).count() == 0
    assert exact.drop_copies(empty(spark)).count() == 0


def test_perfect_hash_is_minimal_and_knows_no_strangers():
    rng = np.random.default_rng(1)
    words = rng.integers(0, 2**63, (5000, 4), dtype=np.uint64)
    mph, order = exact.PerfectHash.build(words)
    assert sorted(mph.slots(words)) == list(range(5000))
    assert (mph.slots(words[order]) == np.arange(5000)).all()
    assert sorted(order) == list(range(5000))
    # Keys that share every place are listed behind the others.
    same = np.repeat(words[:1], 3, axis=0)
    mph, order = exact.PerfectHash.build(np.concatenate([words[:10], same]))
    assert len(order) == 13 and mph.ranks[-1] == 9
