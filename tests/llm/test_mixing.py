import itertools
import random
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from tests.llm.helpers import awkward_rows, empty, frame
from tidemark.llm import mixing


def test_targets_reshare_what_lies_above_the_limit():
    rng = random.Random(2)
    for _ in range(200):
        sizes = {name: rng.randrange(0, 1000) for name in rng.sample("abcdefgh", rng.randrange(1, 8))}
        if rng.random() < 0.5:
            sizes[None] = rng.randrange(0, 1000)
        wanted = mixing.targets_of(sizes)
        assert sum(wanted.values()) == pytest.approx(1.5 * sum(sizes.values()))
        assert all(wanted[s] <= 2 * sizes[s] + 1e-9 for s in sizes)
        names = sorted(s for s in sizes if s is not None) + [None] * (None in sizes)
        weight = {n: (3, 1, 2)[i % 3] for i, n in enumerate(names)}
        free = [wanted[s] / weight[s] for s in sizes if wanted[s] < 2 * sizes[s] - 1e-9]
        assert not free or max(free) == pytest.approx(min(free))
        level = max(free, default=0)
        assert all(wanted[s] / weight[s] <= level + 1e-6 for s in sizes) or not free


def cheapest_by_hand(capacity, quotas, repeats):
    """(most words routed, least repetition cost) over all ways to give whole words."""
    patterns = list(capacity)
    best = (0, 0)
    ways = []
    for pattern in patterns:
        most = repeats * capacity[pattern]
        ways.append([split for split in itertools.product(range(most + 1), repeat=len(pattern)) if sum(split) <= most])
    for choice in itertools.product(*ways):
        routed = dict.fromkeys(quotas, 0)
        cost = 0
        for pattern, split in zip(patterns, choice):
            for source, words in zip(pattern, split):
                routed[source] += words
            given, tier = sum(split), 0
            while given > 0:
                step = min(given, capacity[pattern])
                if not step:
                    break
                cost += step * tier
                given, tier = given - step, tier + 1
        if all(routed[s] <= quotas[s] for s in quotas):
            best = max(best, (sum(routed.values()), -cost))
    return best[0], -best[1]


def test_flow_is_cheapest_for_overlapping_sources():
    rng = random.Random(7)
    patterns = [("a",), ("b",), ("a", "b"), ("a", "b", "c"), ("c",)]
    for _ in range(40):
        capacity = {p: rng.randrange(0, 3) for p in rng.sample(patterns, 3)}
        quotas = {s: rng.randrange(0, 5) for p in capacity for s in p}
        given = mixing.route(capacity, quotas)
        cost = sum(max(0, given[p] - capacity[p]) for p in capacity)
        assert all(given[p] <= 2 * capacity[p] for p in capacity)
        assert (sum(given.values()), cost) == cheapest_by_hand(capacity, quotas, 2)


def test_awkward_documents(spark):
    rows = awkward_rows()
    docs = frame(spark, rows)
    got = mixing.mix(docs).collect()
    assert sorted(str(r.doc_id) for r in got) == sorted(str(r[0]) for r in rows)
    size_of = {}
    for r in rows:
        size_of.setdefault(r[3], []).append(len((r[1] or "").encode().split()))
    wanted = mixing.targets_of({s: sum(v) for s, v in size_of.items()})
    assert {(r.source_size, r.target) for r in got} == {(sum(v), wanted[s]) for s, v in size_of.items()}
    assert all(r.taken in (0, r["size"], 2 * r["size"]) for r in got)
    for source, sizes in size_of.items():
        taken = sum(r.taken for r in got if (r.source_size, r.target) == (sum(sizes), wanted[source]))
        assert abs(taken - wanted[source]) <= 2 * max(sizes)
    assert sorted(map(str, mixing.mix(docs).collect())) == sorted(map(str, got))
    mixed = mixing.mixed(docs)
    assert mixed.columns == docs.columns
    assert mixed.count() == sum(r.taken // r["size"] for r in got if r["size"])


def test_overlapping_sources(spark):
    docs = spark.range(400).select(
        F.col("id").alias("doc_id"), F.expr("repeat('w ', int(5 + id % 7))").alias("text"),
        F.expr("case id % 4 when 0 then array('a') when 1 then array('b', 'a') when 2 then array('b') else null end").alias("source"),
    )
    got = mixing.mix(docs).collect()
    assert len(got) == 400 and all(0 <= r.taken <= 2 * r["size"] for r in got)
    total = sum(r["size"] for r in got)
    assert abs(sum(r.taken for r in got) - 1.5 * total) <= 40


def test_too_many_patterns_is_an_error(spark, monkeypatch):
    monkeypatch.setattr(mixing, "MAX_PATTERNS", 2)
    with pytest.raises(ValueError):
        mixing.mix(frame(spark, awkward_rows()))


def test_empty_table(spark):
    assert mixing.mix(empty(spark)).count() == 0
    assert mixing.mixed(empty(spark)).count() == 0
    assert mixing.targets_of({}, share=Fraction(1)) == {}
