import random
from hashlib import sha256

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tests.llm.helpers import awkward_rows, empty, frame
from tidemark.llm import substrings

LAST = 2**63 - 1


def by_hand(rows, width):
    """Rows of one id are one document: the same place in them is no earlier place."""
    first = {}
    order = sorted(((LAST if i is None else i), (t or "")) for i, t in rows)
    for key, text in order:
        words = text.encode().split()
        for p in range(len(words) - width + 1):
            window = tuple(words[p : p + width])
            first[window] = min(first.get(window, (key, p)), (key, p))
    out = []
    for doc_id, text in rows:
        key, words = LAST if doc_id is None else doc_id, (text or "").encode().split()
        gone = [False] * len(words)
        for p in range(len(words) - width + 1):
            if first[tuple(words[p : p + width])] < (key, p):
                gone[p : p + width] = [True] * width
        kept = b" ".join(w for w, g in zip(words, gone) if not g)
        out.append((str(doc_id), len(words), sum(gone), sha256(kept).hexdigest()))
    return sorted(out)


def small_alphabet(seed, n=200):
    rng = random.Random(seed)
    motif = "abcabbacabcaabbccabcbbaccbabcabcacb"
    rows = []
    for i in range(n):
        words = []
        for _ in range(rng.randrange(0, 6)):
            kind = rng.random()
            if kind < 0.4:
                words += [rng.choice("abc") for _ in range(rng.randrange(1, 25))]
            elif kind < 0.6:
                words += ["a"] * rng.randrange(1, 30)
            else:
                words += motif[rng.randrange(0, 10) : rng.randrange(12, 35)]
        rows.append((i, " ".join(words) if rng.random() < 0.97 else None))
    return rows


@pytest.mark.parametrize("shard_words, task_words, chunk", [(100_000, 1_000_000, 1 << 20), (40, 50, 300)])
def test_equals_brute_force(spark, monkeypatch, shard_words, task_words, chunk):
    monkeypatch.setattr(substrings, "CHUNK_BYTES", chunk)
    rows = small_alphabet(3)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    got = substrings.dedup(docs, width=5, shard_words=shard_words, task_words=task_words).collect()
    assert sorted((str(r[0]), *r[1:]) for r in got) == by_hand(rows, 5)


def test_awkward_documents_and_kept_text(spark):
    rows = awkward_rows()
    got = substrings.dedup(frame(spark, rows), with_text=True).collect()
    assert sorted((str(r[0]), *r[1:4]) for r in got) == by_hand([(r[0], r[1]) for r in rows], substrings.WINDOW)
    assert all(sha256(r.kept.encode()).hexdigest() == r.kept_sha256 for r in got)


def test_passage_shared_by_every_document(spark):
    passage = " ".join(f"p{i}" for i in range(60))
    docs = spark.range(500).select(
        F.col("id").alias("doc_id"), F.concat(F.expr("concat('x', id, ' y', id, ' ')"), F.lit(passage)).alias("text")
    )
    got = {r.doc_id: r.n_removed for r in substrings.dedup(docs, shard_words=20, task_words=500).collect()}
    assert got == {i: 60 if i else 0 for i in range(500)}


def test_automaton_knows_every_substring_and_its_first_end():
    rng = random.Random(1)
    for _ in range(30):
        parts = [[rng.randrange(3) for _ in range(rng.randrange(1, 30))] for _ in range(4)]
        automaton, flat, start = substrings.Automaton(), [], []
        for part in parts:
            start.append(len(flat))
            automaton.add(part, len(flat))
            flat += part
        probe = [rng.randrange(3) for _ in range(60)]
        want = {}
        for place in range(3, len(probe)):
            window = probe[place - 3 : place + 1]
            ends = [s + k + 3 for s, part in zip(start, parts) for k in range(len(part) - 3) if part[k : k + 4] == window]
            if ends:
                want[place] = min(ends)
        assert dict(automaton.matches(probe, 4)) == want


def test_windows_that_share_the_upper_bits_of_their_hash_are_told_apart(monkeypatch):
    whole = substrings.window_hashes
    monkeypatch.setattr(substrings, "window_hashes", lambda words, width: whole(words, width) & np.uint64(0xFFFF))
    docs = [(i, " ".join(f"{name}{k}" for k in range(20)).encode()) for i, name in enumerate("abb")]
    want = [(1, 1, True, 0, 20), (2, 1, False, 0, 20)]
    together = pa.Table.from_batches([substrings.Windows(20, 1).chunk(docs)])
    apart = pa.Table.from_batches([substrings.Windows(20, 1).chunk([d]) for d in docs])
    ranges = together.filter(pa.compute.is_null(together["blob"]))
    for rows in (ranges, substrings._resolve(apart, 1)):
        found = substrings._join_ranges(rows, 20).to_pylist()
        assert sorted(tuple(r.values()) for r in found) == want


def test_empty_table(spark):
    assert substrings.dedup(empty(spark)).count() == 0
