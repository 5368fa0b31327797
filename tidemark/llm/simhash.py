"""SimHash near-dedup through a binary trie self-join.

Two 64-bit fingerprints that differ in at most three bits agree in one of four 16-bit
blocks. So there are four tries, each over the fingerprints rotated to start with another
block, and in each only node pairs that agree on the first 16 bits are joined: a subtree
below such a prefix joins with itself. Inside, node pairs are traversed together bit by
bit; a pair adds one to its error where the children differ and is pruned when the error
exceeds the budget. A subtree with more than ``SUBTREE_ROWS`` fingerprints is first cut
into pairs of its own child nodes by the same rule, again and again, so no task holds more
whatever the data.

The trie is over distinct fingerprints; documents with equal ones never meet in a task. A
task does not return all pairs it finds but a spanning star of each component among them,
so its output is bounded by its input.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.llm.common import salt, staged, text_or_empty
from tidemark.llm.components import components

# Fixed values of the fingerprint.
SHINGLE = 3
SEED = 42
BITS = 64
BUDGET = 3

BLOCK = BITS // (BUDGET + 1)
SUBTREE_ROWS = 20_000
#: Bits by which a subtree that is too large is cut at a time.
STEP = 4
#: Node pairs in flight, fingerprint pairs compared at once, and leaves joined directly.
FRONTIER = 200_000
LEAF_PAIRS = 16
HASHES_AT_ONCE = 32_768


# Fingerprints ----------------------------------------------------------------------


def fingerprint(text: bytes) -> int:
    """SimHash over the 3-word shingles of a text (ASCII lower case), as a signed 64-bit number."""
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) < SHINGLE:
        hashes = np.array([xxhash.xxh64_intdigest(joined, SEED)], np.uint64)
    else:
        gaps = np.flatnonzero(np.frombuffer(joined, np.uint8) == 32)
        starts = [0, *(gaps[: len(words) - SHINGLE] + 1).tolist()]
        ends = [*gaps[SHINGLE - 1 :].tolist(), len(joined)]
        digest = xxhash.xxh64_intdigest
        hashes = np.fromiter(
            (digest(joined[s:e], SEED) for s, e in zip(starts, ends)), np.uint64, len(starts)
        )
    ones = np.zeros(BITS, np.int64)
    for i in range(0, len(hashes), HASHES_AT_ONCE):
        part = hashes[i : i + HASHES_AT_ONCE]
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    bits = np.packbits(2 * ones > len(hashes), bitorder="little")
    return int(bits.view(np.int64)[0])


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        marks = [fingerprint(text) for text in batch["text"].to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch["id"], batch["version"], pa.array(marks, pa.int64())], names=["id", "version", "bits"]
        )


# Trie join of one task -------------------------------------------------------------


def _merge(label: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Least label of each component after adding the edges i-j."""
    while len(i):
        a, b = label[i], label[j]
        apart = a != b
        if not apart.any():
            break
        i, j, a, b = i[apart], j[apart], a[apart], b[apart]
        np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))
        while (label[label] != label).any():
            label = label[label]
    return label


def join_tries(
    bits: np.ndarray, pairs: list[np.ndarray], depth: int, label: np.ndarray, budget: int = BUDGET
) -> np.ndarray:
    """Traverse node pairs from ``depth`` on and merge the labels of linked fingerprints.

    ``pairs`` holds, for each pair, its two ranges of ``bits`` (sorted inside a range) and
    the bits in which their prefixes differ. A node joined with itself has equal ranges.
    """
    ones: dict[int, np.ndarray] = {}
    stack = [(pairs, depth)]
    while stack:
        (a_lo, a_hi, b_lo, b_hi, error), depth = stack.pop()
        count = (a_hi - a_lo) * (b_hi - b_lo)
        small = (count <= LEAF_PAIRS) | (depth >= BITS)
        if small.any():
            i, j = _all_pairs(a_lo[small], a_hi[small], b_lo[small], b_hi[small])
            near = (i < j) & (np.bitwise_count(bits[i] ^ bits[j]) <= budget)
            label = _merge(label, i[near], j[near])
        a_lo, a_hi, b_lo, b_hi, error = (x[~small] for x in (a_lo, a_hi, b_lo, b_hi, error))
        if not len(a_lo):
            continue
        if depth not in ones:
            bit = (bits >> np.uint64(BITS - 1 - depth)) & np.uint64(1)
            ones[depth] = np.concatenate([[0], np.cumsum(bit.astype(np.int64))])
        a_mid = a_hi - (ones[depth][a_hi] - ones[depth][a_lo])
        b_mid = b_hi - (ones[depth][b_hi] - ones[depth][b_lo])
        other = a_lo != b_lo  # of a node with itself, 0-1 and 1-0 are the same pairs
        children = [
            np.concatenate(column)
            for column in zip(
                (a_lo, a_mid, b_lo, b_mid, error),
                (a_mid, a_hi, b_mid, b_hi, error),
                (a_lo, a_mid, b_mid, b_hi, error + 1),
                (a_mid[other], a_hi[other], b_lo[other], b_mid[other], error[other] + 1),
            )
        ]
        keep = (children[0] < children[1]) & (children[2] < children[3]) & (children[4] <= budget)
        children = [x[keep] for x in children]
        for start in range(0, len(children[0]), FRONTIER):
            stack.append(([x[start : start + FRONTIER] for x in children], depth + 1))
    return label


def _all_pairs(a_lo, a_hi, b_lo, b_hi) -> tuple[np.ndarray, np.ndarray]:
    """Every pair of the (few) members of two ranges."""
    width = b_hi - b_lo
    count = (a_hi - a_lo) * width
    which = np.repeat(np.arange(len(count)), count)
    nth = np.arange(len(which)) - np.repeat(np.cumsum(count) - count, count)
    return a_lo[which] + nth // width[which], b_lo[which] + nth % width[which]


def _rotated(bits: np.ndarray, by: np.ndarray) -> np.ndarray:
    by = by.astype(np.uint64) % np.uint64(BITS)
    back = (np.uint64(BITS) - by) % np.uint64(BITS)
    return (bits << by) | np.where(back == 0, np.uint64(0), bits >> back)


def _stars(columns: dict[str, np.ndarray]) -> pa.RecordBatch:
    """Spanning stars of the links among whole groups of members, sorted by group and side."""
    bits = columns["bits"].view(np.uint64)
    label = np.arange(len(bits))
    keys = np.stack([columns[c] for c in ("turn", "depth", "a", "b")])
    starts = np.flatnonzero(np.concatenate([[True], (keys[:, 1:] != keys[:, :-1]).any(axis=0)]))
    ends = np.append(starts[1:], len(bits))
    a, b, depth = columns["a"][starts], columns["b"][starts], columns["depth"][starts]
    second = np.concatenate([[0], np.cumsum(columns["side"])])
    middle = ends - (second[ends] - second[starts])
    own = a == b
    error = np.bitwise_count((a ^ b).view(np.uint64)).astype(np.int64)
    for level in np.unique(depth):
        at = (depth == level) & (own | ((starts < middle) & (middle < ends)))
        pairs = [
            starts[at], np.where(own, ends, middle)[at], np.where(own, starts, middle)[at], ends[at], error[at]
        ]
        label = join_tries(bits, pairs, int(level), label)
    plain = _rotated(bits, BITS - BLOCK * columns["turn"]).view(np.int64)
    tied = np.flatnonzero(label != np.arange(len(label)))
    return pa.RecordBatch.from_arrays(
        [pa.array(plain[tied]), pa.array(plain[label[tied]])], names=["u", "v"]
    )


def _join_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches of members in group order; a group may run on into the next batch."""
    held: list[dict[str, np.ndarray]] = []

    def whole(parts):
        return {c: np.concatenate([p[c] for p in parts]) for c in parts[0]}

    for batch in batches:
        if not batch.num_rows:
            continue
        part = {c: batch[c].to_numpy(zero_copy_only=False).astype(np.int64) for c in batch.schema.names}
        last = np.array([part[c] == part[c][-1] for c in ("turn", "depth", "a", "b")]).all(axis=0)
        cut = int(len(last) - np.argmin(last[::-1])) if not last.all() else 0
        if cut:
            yield _stars(whole([*held, {c: x[:cut] for c, x in part.items()}]))
            held = []
        held.append({c: x[cut:] for c, x in part.items()})
    if held:
        yield _stars(whole(held))


# Spark side ------------------------------------------------------------------------



def _members(marks: DataFrame) -> DataFrame:
    """Each distinct fingerprint in the four rotated tries, at the node of its first block."""
    turned = marks.select("bits", F.explode(F.array(*[F.lit(i) for i in range(BUDGET + 1)])).alias("turn"))
    left = f"shiftleft(bits, {BLOCK} * turn)"
    right = f"if(turn = 0, 0L, shiftrightunsigned(bits, {BITS} - {BLOCK} * turn))"
    return (
        turned.select("turn", F.lit(BLOCK).alias("depth"), F.expr(f"{left} | {right}").alias("bits"))
        .withColumn("a", F.expr("shiftrightunsigned(bits, 64 - depth)"))
        .select("turn", "depth", "a", F.col("a").alias("b"), F.lit(0).alias("side"), "bits")
    )


def _cut(members: DataFrame) -> DataFrame:
    """Members of node pairs, ``STEP`` bits further down, at every child pair within budget."""
    child = f"cast(shiftrightunsigned(bits, 64 - depth - {STEP}) & {2**STEP - 1} as int)"
    here, there = f"((a << {STEP}) | own)", f"((a << {STEP}) | other)"
    mine_b, their_b = f"((b << {STEP}) | own)", f"((b << {STEP}) | other)"
    return (
        members.withColumn("own", F.expr(child))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.lit(2**STEP - 1))))
        .filter(f"bit_count(a ^ b) + bit_count(own ^ other) <= {BUDGET}")
        .select(
            "turn",
            F.expr(f"depth + {STEP}").alias("depth"),
            # A node with itself: the smaller child is the first side of the pair.
            F.expr(f"if(a = b, (a << {STEP}) | least(own, other), if(side = 0, {here}, {there}))").alias("a"),
            F.expr(f"if(a = b, (a << {STEP}) | greatest(own, other), if(side = 0, {their_b}, {mine_b}))").alias("b"),
            F.expr("if(a = b, int(own > other), side)").alias("side"),
            "bits",
        )
    )


def links(marks: DataFrame, subtree_rows: int = SUBTREE_ROWS) -> DataFrame:
    """Edges (u, v) that connect all distinct fingerprints within the budget of each other.

    Not every near pair is an edge, but near fingerprints always share a component.
    """
    keys = ["turn", "depth", "a", "b"]
    members, ready = _members(marks), []
    while True:
        large = members.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > subtree_rows)
        large = staged(large.select(*keys), "subtrees")
        if large.isEmpty():
            ready.append(members)
            break
        ready.append(members.join(large, keys, "left_anti"))
        members = staged(_cut(members.join(large, keys, "left_semi")), "children")
    found = [
        part.repartition(*keys).sortWithinPartitions(*keys, "side", "bits")
        .mapInArrow(_join_groups, "u long, v long")
        for part in ready
    ]
    for part in found[1:]:
        found[0] = found[0].unionByName(part)
    return found[0]


def _grouped(docs: DataFrame, id_col: str, text_col: str, subtree_rows: int) -> DataFrame:
    """(id, version of the text, bits, root of the component, component_id) per document."""
    rows = staged(
        docs.select(
            F.col(id_col).cast("long").alias("id"),
            F.xxhash64(text_or_empty(text_col)).alias("version"),
            text_or_empty(text_col).cast("binary").alias("text"),
        )
        .mapInArrow(_fingerprints, "id long, version long, bits long")
        .withColumn("salt", salt(F.coalesce("id", F.lit(0)))),
        "fingerprints",
    )
    marks = staged(rows.groupBy("bits").agg(F.min("id").alias("first")), "marks")
    nodes = components(links(marks.select("bits"), subtree_rows)).withColumnRenamed("node", "bits")
    linked = staged(marks.join(nodes, "bits"), "linked")
    least = linked.groupBy("root").agg(F.min("first").alias("least"))
    of_mark = marks.join(linked.join(least, "root").select("bits", "root", "least"), "bits", "left").select(
        "bits", F.coalesce("root", "bits").alias("root"),
        F.when(F.col("root").isNull(), F.col("first")).otherwise(F.col("least")).alias("component_id"),
    )
    # Rows of one fingerprint are dealt by (fingerprint, salt): a text may fill a third of them.
    places = rows.select("bits", "salt").distinct().join(of_mark, "bits")
    return rows.join(places, ["bits", "salt"])


def near_groups(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", subtree_rows: int = SUBTREE_ROWS
) -> DataFrame:
    """One row per document: id, fingerprint (16 hexadecimal digits), component_id.

    Null and empty texts, and texts of white space, have fingerprint zero and are linked
    like any other. Null ids take part, but are never the id of a component unless no
    member has one. Repeated rows are reported as often as they occur. An empty table
    gives no rows. Other columns are not read.
    """
    return _grouped(docs, id_col, text_col, subtree_rows).select(
        F.col("id").alias(id_col),
        F.lower(F.lpad(F.hex("bits"), 16, "0")).alias("fingerprint"),
        "component_id",
    )


def drop_near_copies(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", subtree_rows: int = SUBTREE_ROWS
) -> DataFrame:
    """The document with the smallest id of each component, with all its columns."""
    order = F.struct(F.col("id").isNull(), "id", "version")
    winners = (
        _grouped(docs, id_col, text_col, subtree_rows)
        .groupBy("root").agg(F.min(order).alias("w"))
        .select(F.coalesce(F.col("w.id").cast("string"), F.lit("")).alias("_id"), F.col("w.version").alias("_version"))
    )
    keyed = docs.withColumns({
        "_id": F.coalesce(F.col(id_col).cast("string"), F.lit("")),
        "_version": F.xxhash64(text_or_empty(text_col)),
    })
    stay = keyed.join(winners, ["_id", "_version"], "left_semi")
    one = Window.partitionBy("_id", "_version").orderBy("_id")
    return stay.withColumn("_n", F.row_number().over(one)).filter("_n = 1").select(*docs.columns)
