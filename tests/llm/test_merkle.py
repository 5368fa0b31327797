import hashlib
import random

import pytest
from pyspark.sql import functions as F

from tests.llm.helpers import awkward_rows, empty, frame
from tidemark.llm import merkle

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_by_hand(doc_id, text, lang, source, n_chars):
    parts = []
    for value in (doc_id, source, lang, n_chars, text):
        parts.append("-" if value is None else f"{len(str(value).encode())}:{value}")
    return sha("".join(parts))


def tree_by_hand(nodes, fanout):
    """The top and, for each leaf, (place, siblings) up to it, level by level over whole lists."""
    at, proofs = list(range(len(nodes))), [[] for _ in nodes]
    while len(nodes) > 1:
        runs = [nodes[i:i + fanout] for i in range(0, len(nodes), fanout)]
        for leaf, i in enumerate(at):
            run = runs[i // fanout]
            proofs[leaf].append((i % fanout, [d for j, d in enumerate(run) if j != i % fanout]))
            at[leaf] = i // fanout
        nodes = [sha("".join(run)) for run in runs]
    return nodes[0], proofs


def manifest_by_hand(rows, fanout):
    trees = {}
    for row in rows:
        trees.setdefault(row[2], []).append((row[0] is not None, row[0] or 0, leaf_by_hand(*row)))
    names = sorted(trees, key=lambda lang: (lang is not None, (lang or "").encode()))
    below = {lang: tree_by_hand([leaf for *_, leaf in sorted(trees[lang])], fanout) for lang in names}
    root, ways = tree_by_hand([below[lang][0] for lang in names], fanout)
    return sorted(
        (str(doc_id if known else None), leaf, below[lang][0], root, [(p, list(s)) for p, s in proof + way])
        for lang, way in zip(names, ways)
        for (known, doc_id, leaf), proof in zip(sorted(trees[lang]), below[lang][1])
    )


def leaf():
    return merkle.leaf_digest(*[F.col(name) for name in FIELDS])


def collected(df):
    return sorted(
        (str(r.doc_id), r.digest, r.subroot, r.root, [(s.place, list(s.siblings)) for s in r.proof])
        for r in df.collect()
    )


@pytest.mark.parametrize("fanout, depth", [(2, 10), (2, 2), (3, 1), (5, 2)])
def test_manifest_equals_brute_force(spark, fanout, depth):
    rows = awkward_rows()
    got = merkle.manifest(frame(spark, rows), leaf(), fanout=fanout, depth=depth)
    assert collected(got) == manifest_by_hand(rows, fanout)


def test_altered_documents_fail_and_others_pass(spark):
    rows = awkward_rows()
    docs = frame(spark, rows)
    altered = merkle.leaf_digest(*[F.concat("text", F.lit("!")) if n == "text" else F.col(n) for n in FIELDS])
    claim = F.when(F.col("doc_id") % 3 == 0, altered).otherwise(leaf())
    got = merkle.checked(merkle.manifest(docs, leaf(), claim=claim)).collect()
    texts = {r[0]: r[1] for r in rows}
    assert len(got) == len(rows)
    for row in got:
        changed = row.doc_id is not None and row.doc_id % 3 == 0 and texts[row.doc_id] is not None
        assert row.verified == (not changed) == (row.folded_root == row.root)
        assert row.proof_sha256 == sha("".join(d for step in row.proof for d in step.siblings))


def test_a_tree_with_most_leaves_equal_rows_and_few_rows(spark):
    rng = random.Random(3)
    rows = [(rng.randrange(400), "t", "en" if rng.random() < 0.6 else None, None, 1) for _ in range(900)]
    rows += [(7, "t", "fr", None, 1)] * 300
    for fanout, depth in ((2, 3), (2, 10)):
        got = merkle.manifest(frame(spark, rows), leaf(), fanout=fanout, depth=depth)
        assert collected(got) == manifest_by_hand(rows, fanout)
    one = merkle.checked(merkle.manifest(frame(spark, rows[:1]), leaf())).collect()
    assert len(one) == 1 and one[0].proof == [] and one[0].root == one[0].digest and one[0].verified
    assert one[0].proof_sha256 == sha("")
    assert merkle.checked(merkle.manifest(empty(spark), leaf())).collect() == []


def test_sweeps_hold_few_messages_and_visit_labels_in_order():
    for count in (1, 2, 3, 7, 8, 100):
        nodes = [sha(str(i)) for i in range(count)]
        height = merkle.height_of(count, 2)
        top, children = merkle.forward(nodes, height, 2)
        want, proofs = tree_by_hand(list(nodes), 2)
        assert top == want
        swept = list(merkle.backward(count, height, 2, children, ()))
        assert [i for i, _ in swept] == list(range(count - 1, -1, -1))
        assert all([(p, list(s)) for p, s in proof] == proofs[i] for i, proof in swept)
    # A last block is raised to the full height of the others.
    top, _ = merkle.forward([sha("x")], 3, 2)
    assert top == sha(sha(sha(sha("x"))))
