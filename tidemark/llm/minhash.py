"""MinHash near-dedup by fast similarity sketching.

A document is the set of its distinct word shingles, each a 64-bit hash. Its sketch has
``SKETCH`` coordinates. In round i every shingle is hashed into one coordinate with a value
in [i, i + 1), and the coordinate keeps its least value; rounds go on until every
coordinate is filled. In the second half of the rounds the coordinate is given by the
round, so even a set of one shingle fills all of them. Large sets need a round or two,
and a coordinate of two sketches is equal with the probability of the sets' Jaccard
similarity, as concentrated as with independent hashes.

``ROWS`` coordinates make a band. Documents meet in a bucket where a band is equal; two with
a similarity of 0.8 miss each other in all 40 bands of four with a probability of 8e-10,
two with 0.9 with 3e-19. Every link is confirmed on the full sets.

Documents with equal sets are one class, so copies meet as one row. Classes of a bucket are
not paired with each other: first each is confirmed against one of the bucket, the class
that meets most others in all its buckets, and the confirmed links make components. Only
buckets that still hold several components are looked at again: members of the largest
component meet the others, and these each other, in tiles of ``TILE`` classes, and tiles
inside one component are never made. Two passes go over a tile pair. The first compares
sketches and keeps the classes that have a partner of another component with a like one, in
the first bucket the two share; sketches of a link agree in less than ``ALIKE`` of the
expected coordinates with a probability of 1e-10. The second gets the full sets of these,
takes all their intersections as one matrix product and returns only links that connect
what was not connected, so it gives fewer rows than it gets. No link that a bucket holds is
lost, no pairs are written, and a bucket of near copies costs a test for each.

Only classes of candidate pairs send their shingles, once to their own key and once to that
of the pair's first class and a salt, so a class that a third of all documents is compared
with is dealt over many tasks.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b
from itertools import groupby

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.common import salt, slices, staged, text_or_empty
from tidemark.llm.components import components

# Fixed values of the sets and of a link.
SHINGLE = 4
PERCENT = 80

BANDS, ROWS = 40, 4
SKETCH = BANDS * ROWS
#: Share of the coordinates that a link expects to be equal, below which a pair is not confirmed.
ALIKE = 0.7
#: Places of a matrix of classes and shingles that is multiplied at once.
CELLS = 1 << 22
#: Classes of a tile, and words that a task remembers the hashes of.
TILE = 256
WORDS_HELD = 200_000
#: Shingle x round places that are hashed at once: what mostly fills a sketch, and at most.
ENOUGH, AT_ONCE = 8 * SKETCH, 1 << 16
VALUE_BITS = 40

SETS = "id long, key long, n long, digest binary, sketch binary, bands array<long>"
PAIRS = "a long, b long"
TILE_PAIR = ("bucket", "tile", "other")
MEMBERS = "bucket long, tile int, other int, side int, node long, comp long"


# Sets and sketches ----------------------------------------------------------------------


def _mixed(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Words(dict):
    """Hashes of the words seen lately."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= WORDS_HELD:
            self.clear()
        found = self[word] = xxhash.xxh64_intdigest(word)
        return found


def shingles(text: bytes, words: Words, size: int = SHINGLE) -> np.ndarray:
    """The distinct shingles of a text (ASCII lower case) as sorted 64-bit hashes.

    Fewer words than ``size`` are one shingle, no words are none. The number of words goes
    into the hash, so a short text is never taken for a shingle of a longer one.
    """
    found = text.lower().split()
    if not found:
        return np.zeros(0, np.uint64)
    hashes = np.fromiter(map(words.__getitem__, found), np.uint64, len(found))
    width = min(size, len(hashes))
    total = np.full(len(hashes) - width + 1, width, np.uint64)
    for i in range(width):  # position by position, so the order of the words counts
        total = _mixed(total * np.uint64(0x9E3779B97F4A7C15) + hashes[i : len(hashes) - width + 1 + i])
    return np.unique(total)


def sketch(hashes: np.ndarray, size: int = SKETCH) -> np.ndarray:
    """Least (round, value) of every coordinate; ``hashes`` are distinct and at least one."""
    least = np.full(size, np.iinfo(np.uint64).max, np.uint64)
    start, step = 0, -(-ENOUGH // len(hashes))
    while start < 2 * size:
        step = max(1, min(step, AT_ONCE // len(hashes), (size if start < size else 2 * size) - start))
        rounds = np.arange(start, start + step, dtype=np.uint64)
        x = _mixed(hashes[None, :] ^ _mixed(rounds + np.uint64(0x5851F42D4C957F2D))[:, None])
        # The upper bits say where, the lower ones are the value: 24 and 40.
        if start < size:
            place = ((x >> np.uint64(VALUE_BITS)) * np.uint64(size)) >> np.uint64(64 - VALUE_BITS)
        else:
            place = np.broadcast_to((rounds - np.uint64(size))[:, None], x.shape)
        value = (rounds[:, None] << np.uint64(VALUE_BITS)) | (x & np.uint64((1 << VALUE_BITS) - 1))
        np.minimum.at(least, place.ravel().astype(np.int64), value.ravel())
        start += step
        # Values of later rounds are larger, so a sketch is done when all places are filled.
        if least.max() < np.iinfo(np.uint64).max:
            break
    return least


def _bands(coordinates: np.ndarray) -> np.ndarray:
    """One 64-bit key for each band."""
    rows = coordinates.reshape(BANDS, ROWS)
    total = np.arange(BANDS, dtype=np.uint64)
    for i in range(ROWS):
        total = _mixed(total * np.uint64(0x9E3779B97F4A7C15) + rows[:, i])
    return total.view(np.int64)


def digest_of(hashes: np.ndarray) -> bytes | None:
    """What tells classes apart; an empty set is in none."""
    return blake2b(hashes.tobytes(), digest_size=16).digest() if len(hashes) else None


def _described(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    words = Words()
    for batch in slices(batches):
        sizes, digests, sketches, bands = [], [], [], []
        for text in batch["text"].to_pylist():
            hashes = shingles(text, words)
            sizes.append(len(hashes))
            digests.append(digest_of(hashes))
            marks = sketch(hashes) if len(hashes) else None
            bands.append(None if marks is None else _bands(marks))
            # Two bytes of a coordinate are enough to compare sketches by.
            sketches.append(None if marks is None else (_mixed(marks) & np.uint64(0xFFFF)).astype(np.uint16).tobytes())
        yield pa.RecordBatch.from_arrays(
            [
                batch["id"], batch["key"], pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()),
                pa.array(sketches, pa.binary()), pa.array(bands, pa.list_(pa.int64())),
            ],
            names=["id", "key", "n", "digest", "sketch", "bands"],
        )


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The set of each class; a text that only shares the key of the class's text is passed over."""
    words = Words()
    for batch in slices(batches, 100):
        found = [shingles(text, words) for text in batch["text"].to_pylist()]
        own = [digest_of(hashes) == digest for hashes, digest in zip(found, batch["digest"].to_pylist())]
        sets = pa.RecordBatch.from_arrays(
            [batch["node"], pa.array([hashes.tobytes() for hashes in found], pa.binary())], names=["node", "shingles"]
        )
        yield sets.filter(pa.array(own, pa.bool_()))


# Pairs ----------------------------------------------------------------------------------


def linked(a: np.ndarray, b: np.ndarray, percent: int = PERCENT) -> bool:
    """Whether the intersection is at least ``percent`` per cent of the union of two sorted sets."""
    if 100 * min(len(a), len(b)) < percent * max(len(a), len(b)):
        return False
    at = np.searchsorted(a, b)
    at[at == len(a)] = 0
    both = int((a[at] == b).sum())
    return 100 * both >= percent * (len(a) + len(b) - both)


def _confirm(percent: int):
    def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 100):
            keep = [
                linked(np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64), percent)
                for a, b in zip(batch["a_set"].to_pylist(), batch["b_set"].to_pylist())
            ]
            pairs = pa.RecordBatch.from_arrays([batch["a"], batch["b"]], names=["a", "b"])
            yield pairs.filter(pa.array(keep, pa.bool_()))

    return confirm


def _by_tile_pair(batches: Iterator[pa.RecordBatch], *names: str) -> Iterator[tuple[tuple, list[tuple]]]:
    """Rows sorted by tile pair (bucket, tile, other); one may run on into the next batch."""

    def rows():
        for batch in batches:
            yield from zip(*(batch[name].to_pylist() for name in (*TILE_PAIR, *names)))

    for key, group in groupby(rows(), key=lambda row: row[:3]):
        yield key, [row[3:] for row in group]


def _sides(rows: list[tuple]) -> tuple[list[tuple], list[tuple]]:
    """Members of both tiles, whose side is 0 or 1; those of a tile that meets itself (2) are on both."""
    return [r for r in rows if r[0] != 1], [r for r in rows if r[0] != 0]


def _likely(percent: int):
    """Members of a tile pair that have a like sketch on the other side, in another component."""
    least = int(SKETCH * percent * ALIKE / 100)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: list[tuple] = []
        for key, rows in _by_tile_pair(batches, "side", "node", "comp", "band", "sketch"):
            sides = sorted(_sides(rows), key=len)
            marks = [np.frombuffer(b"".join(r[4] for r in side), np.uint16).reshape(len(side), SKETCH) for side in sides]
            comps = np.array([r[2] for r in sides[1]], np.int64)
            wanted = set()
            for row, mark in zip(sides[0], marks[0]):
                equal = marks[1] == mark
                # Pairs that share several buckets are looked at in the first of them.
                first = equal.reshape(-1, BANDS, ROWS).all(axis=2).argmax(axis=1) == row[3]
                near = np.flatnonzero((equal.sum(axis=1) >= least) & first & (comps != row[2]))
                if len(near):
                    wanted.add(row[1])
                    wanted.update(sides[1][i][1] for i in near.tolist())
            found += [(*key, *row[:3]) for row in rows if row[1] in wanted]
            if len(found) >= 10_000:
                yield _kept(found)
                found = []
        if found:
            yield _kept(found)

    return keep


def _kept(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.int64())
    names = [*TILE_PAIR, "side", "node", "comp"]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)


def common(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of each set on the left with each on the right."""
    sets = left + right
    owner = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
    _, shingle, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = times > 1
    use = shared[shingle]
    column = (np.cumsum(shared) - 1)[shingle[use]]
    row, width = owner[use], int(shared.sum())
    out = np.zeros((len(left), len(right)), np.float32)
    step = max(1, CELLS // len(sets))
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    for start in range(0, width, step):
        a, b = np.searchsorted(column, (start, start + step))
        part = np.zeros((len(sets), min(step, width - start)), np.float32)
        part[row[a:b], column[a:b] - start] = 1
        out += part[: len(left)] @ part[len(left) :].T
    return out.astype(np.int64)


def _connecting(percent: int):
    """Links between the members of a tile pair that connect different components."""

    def find(parent: dict[int, int], x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    def connect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows in _by_tile_pair(batches, "side", "node", "comp", "shingles"):
            left, right = _sides(rows)
            sets = [[np.frombuffer(r[3], np.uint64) for r in side] for side in (left, right)]
            if not left or not right:
                continue
            both = common(*sets)
            sizes = [np.array([len(x) for x in side], np.int64) for side in sets]
            close = 100 * both >= percent * (sizes[0][:, None] + sizes[1][None, :] - both)
            parent = {comp: comp for _, _, comp, _ in rows}
            found = []
            for i, j in np.argwhere(close).tolist():
                a, b = find(parent, left[i][2]), find(parent, right[j][2])
                if a != b:
                    parent[max(a, b)] = min(a, b)
                    found.append((left[i][1], right[j][1]))
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*found)], names=["a", "b"])

    return connect


# Spark side -----------------------------------------------------------------------------


def _sets_of(texts: DataFrame, classes: DataFrame, wanted: DataFrame) -> DataFrame:
    """(node, shingles) of the classes in ``wanted``, each from the one document that stands for it."""
    places = classes.select("node", "digest", "key").join(wanted.select("node").distinct(), "node")
    # Rows that are repeated with their id share a key; partitioned by it, they are reduced in place.
    found = texts.join(places, "key").select("key", "node", "digest", "text").distinct()
    return staged(found.mapInArrow(_sets, "node long, shingles binary"), "sets")


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that are links; ``b`` may be in any number of them."""
    dealt = pairs.join(sets.select(F.col("node").alias("a"), F.col("shingles").alias("a_set")), "a").withColumn(
        "salt", salt("a")
    )
    places = pairs.select("b", salt("a").alias("salt")).distinct().join(
        sets.select(F.col("node").alias("b"), F.col("shingles").alias("b_set")), "b"
    )
    both = dealt.join(places, ["b", "salt"]).select("a", "b", "a_set", "b_set")
    return staged(both.mapInArrow(_confirm(percent), PAIRS), "links")


def _tiles(entries: DataFrame, roots: DataFrame, classes: DataFrame, size: int) -> DataFrame:
    """Members of buckets with several components, once for every tile pair they are in.

    Tiles 0 to ``mains`` - 1 hold the bucket's largest component and the next ``others`` the
    rest. A tile meets itself, if it is of the rest, and every later one of the rest.
    """
    members = staged(
        entries.join(roots, "node", "left").select("bucket", "band", "node", F.coalesce("root", "node").alias("comp")),
        "members",
    )
    sizes = members.groupBy("bucket", "comp").agg(F.count(F.lit(1)).alias("n"))
    several = sizes.groupBy("bucket").agg(
        F.max(F.struct("n", "comp")).alias("top"), F.sum("n").alias("all"), F.count(F.lit(1)).alias("comps")
    ).filter("comps > 1").select(
        "bucket", F.col("top.comp").alias("main"), F.ceil(F.col("top.n") / size).cast("int").alias("mains"),
        F.ceil((F.col("all") - F.col("top.n")) / size).cast("int").alias("others"),
    )
    own = F.xxhash64("node")
    rows = members.join(several, "bucket").withColumn(
        "own",
        F.when(F.col("comp") == F.col("main"), F.pmod(own, F.col("mains")))
        .otherwise(F.col("mains") + F.pmod(own, F.col("others"))).cast("int"),
    )
    last = F.col("mains") + F.col("others") - 1
    # Tiles of the largest component do not meet each other.
    met = F.sequence(F.when(F.col("own") < F.col("mains"), F.col("mains")).otherwise(0), last)
    pairs = rows.select("*", F.explode(met).alias("met")).select(
        "bucket", F.least("own", "met").alias("tile"), F.greatest("own", "met").alias("other"),
        # The first tile's members, the other's, or both of a tile that meets itself.
        F.when(F.col("own") < F.col("met"), 0).when(F.col("own") > F.col("met"), 1).otherwise(2).alias("side"),
        "node", "comp", "band",
    )
    return pairs.join(classes.select("node", "sketch"), "node")


def _in_tile_pairs(rows: DataFrame) -> DataFrame:
    return rows.repartition(*TILE_PAIR).sortWithinPartitions(*TILE_PAIR)


def _links(texts: DataFrame, classes: DataFrame, percent: int, tile: int) -> DataFrame:
    """Confirmed links that connect whatever all links connect."""
    entries = classes.select("node", F.posexplode("bands").alias("band", "bucket"))
    shared = entries.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    entries = staged(entries.join(shared, "bucket"), "entries")
    # Who meets most others in all its buckets stands in the middle, if anyone does.
    weighed = entries.join(entries.groupBy("node").agg(F.sum("n").alias("weight")), "node")
    middles = weighed.groupBy("bucket").agg(F.max_by("node", F.struct("weight", "node")).alias("b"))
    first = staged(
        entries.join(middles, "bucket").filter("node <> b").select(F.col("node").alias("a"), "b").distinct(), "candidates"
    )
    sets = _sets_of(texts, classes, first.select(F.explode(F.array("a", "b")).alias("node")))
    links = _confirmed(first, sets, percent)
    roots = staged(components(links), "roots")
    tiles = _tiles(entries, roots, classes, tile)
    likely = staged(_in_tile_pairs(tiles).mapInArrow(_likely(percent), MEMBERS), "likely")
    if likely.isEmpty():
        return links
    sets = _sets_of(texts, classes, likely)
    found = _in_tile_pairs(likely.join(sets, "node")).mapInArrow(_connecting(percent), PAIRS)
    return links.unionByName(staged(found, "links"))


def near_groups(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT, tile: int = TILE
) -> DataFrame:
    """One row per document: id, n_shingles, component_id, kept.

    Null, empty and blank texts have no shingles and are linked with nothing, not even each
    other. Rows without an id take part, but are never the id of a component unless no
    member has one. Repeated rows are reported as often as they occur. Very long texts are
    read whole; a task holds the set of one. An empty table gives no rows. Other columns
    are not read. ``percent`` is the least similarity of a link, 80 or more.

    Shingles are told apart by 64-bit hashes: two of a document, or of a pair, fall together
    with a probability of some 1e-14 for texts of usual length.
    """
    if percent < PERCENT:
        raise ValueError(f"the bands are made for similarities of {PERCENT} per cent or more")
    text = text_or_empty(text_col)
    texts = docs.select(
        F.col(id_col).cast("long").alias("id"), F.xxhash64(F.col(id_col).cast("long"), text).alias("key"),
        text.cast("binary").alias("text"),
    )
    rows = staged(texts.mapInArrow(_described, SETS).withColumn("salt", salt("key")), "sketches")
    classes = staged(
        # Copies are reduced before the shuffle: one row for each set and task.
        rows.filter("digest IS NOT NULL").groupBy("digest").agg(
            F.min("id").alias("least"), F.min("key").alias("key"),
            F.first("sketch").alias("sketch"), F.first("bands").alias("bands"),
        ).withColumn("node", F.monotonically_increasing_id()),
        "classes",
    )
    roots = components(_links(texts.select("key", "text"), classes, percent, tile))
    members = staged(
        classes.select("node", "digest", "least").join(roots, "node", "left")
        .select("digest", "least", F.coalesce("root", "node").alias("root")),
        "members",
    )
    answers = members.join(members.groupBy("root").agg(F.min("least").alias("component_id")), "root").select(
        "digest", "component_id"
    )
    # Rows of one set are dealt by (set, salt): a text may fill a third of them.
    sets = rows.select("id", "n", "digest", "salt")
    full = sets.filter("digest IS NOT NULL")
    places = full.select("digest", "salt").distinct().join(answers, "digest")
    found = full.join(places, ["digest", "salt"]).select("id", "n", "component_id").unionByName(
        sets.filter("digest IS NULL").select("id", "n", F.col("id").alias("component_id"))
    )
    return found.select(
        F.col("id").alias(id_col), F.col("n").alias("n_shingles"), "component_id",
        F.expr("id <=> component_id").alias("kept"),
    )
