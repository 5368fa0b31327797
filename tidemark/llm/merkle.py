"""Merkle manifest of a dataset by time-forward processing.

Every document is a leaf; the leaves of a tree (a language) ascend by id, and runs of
``fanout`` consecutive nodes become a parent until one node is left, the subroot. The
subroots are the leaves of one more tree, whose top is the root.

Nodes are labelled by the last leaf below them, then by level, so a child's label is
smaller than its parent's. The forward sweep passes the nodes in label order: a child
sends its digest through a priority queue, ordered by label, to its parent, which is
hashed as soon as the sweep reaches its label. The reversed sweep sends the rest of the
proof, from a node up to the root, to the node's children and so down to the leaves.

The queue is external: messages inside a block of ``fanout ** depth`` consecutive nodes
wait in a heap of the task that sweeps the block, and those that leave the block are rows
of a table, sorted by label on their way to the next round. A block has a fixed number of
nodes whatever the size of a tree, so a tree with a third of all leaves is dealt over as
many tasks as it has blocks, and 10^12 leaves take four rounds. Leaf numbers come from a
range partitioning and one row per (tree, partition). The driver sees one number a round.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from hashlib import sha256
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.llm.common import staged

FANOUT = 2
#: Levels of a block: 1,024 leaves with two children a node.
DEPTH = 10
#: Partition and row of ``monotonically_increasing_id``.
ROW_BITS = 33

PROOF = "array<struct<place: int, siblings: array<string>>>"
UP = "tree string, pos long, n long, digest string"
DOWN = f"tree string, pos long, id long, digest string, claim string, subroot string, root string, proof {PROOF}"


# Digests -----------------------------------------------------------------------------


def field(value: Column) -> Column:
    """``-`` for null, else the number of UTF-8 bytes, a colon and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(*values: Column) -> Column:
    return F.sha2(F.concat(*[field(value) for value in values]).cast("binary"), 256)


def node_digest(children: list[str]) -> str:
    return sha256("".join(children).encode()).hexdigest()


def proof_digest(proof: Column) -> Column:
    """Digest of all siblings of a proof, from the leaf upwards."""
    siblings = F.flatten(F.transform(proof, lambda step: step["siblings"]))
    return F.sha2(F.concat_ws("", siblings).cast("binary"), 256)


def folded(start: Column, proof: Column) -> Column:
    """The root that a leaf's digest and a proof lead to."""

    def parent(digest: Column, step: Column) -> Column:
        siblings, place = step["siblings"], step["place"]
        before = F.concat_ws("", F.slice(siblings, F.lit(1), place))
        after = F.concat_ws("", F.slice(siblings, place + 1, F.size(siblings)))
        return F.sha2(F.concat(before, digest, after).cast("binary"), 256)

    return F.aggregate(proof, start, parent)


# Sweeps over one block -----------------------------------------------------------------


def height_of(nodes: int, fanout: int) -> int:
    """Levels above ``nodes`` nodes until one is left."""
    height = 0
    while nodes > 1:
        nodes, height = -(-nodes // fanout), height + 1
    return height


def forward(digests: list[str], height: int, fanout: int) -> tuple[str, dict[tuple[int, int], list[str]]]:
    """Digest of the node ``height`` levels above the digests, and the children of every node."""
    count, queue, children, top = len(digests), [], {}, ""

    def send(level: int, index: int, digest: str) -> None:
        end = min((index // fanout + 1) * fanout ** (level + 1), count)
        heapq.heappush(queue, (end, level + 1, index // fanout, index % fanout, digest))

    for place, digest in enumerate(digests):
        if not height:
            return digest, {}
        send(0, place, digest)
        while queue and queue[0][0] <= place + 1:
            _, level, index, _, first = heapq.heappop(queue)
            got = [first]
            while queue and queue[0][1:3] == (level, index):
                got.append(heapq.heappop(queue)[4])
            children[level, index] = got
            top = node_digest(got)
            if level < height:
                send(level, index, top)
    return top, children


def backward(
    count: int, height: int, fanout: int, children: dict[tuple[int, int], list[str]], suffix: tuple
) -> Iterator[tuple[int, tuple]]:
    """(leaf, proof) in descending order; ``suffix`` is the proof of the block's top."""
    queue = [(-count, -height, 0, suffix)]
    while queue:
        _, level, index, proof = heapq.heappop(queue)
        level = -level
        if not level:
            yield index, proof
            continue
        got = children[level, index]
        for place in range(len(got)):
            child = index * fanout + place
            end = min((child + 1) * fanout ** (level - 1), count)
            step = (place, (*got[:place], *got[place + 1 :]))
            heapq.heappush(queue, (-end, 1 - level, child, (step, *proof)))


def _blocks(batches: Iterator[pa.RecordBatch], names: list[str]) -> Iterator[tuple[tuple, list[tuple]]]:
    """Rows of each (tree, block) of batches that are sorted by them; one block is held at a time."""

    def rows():
        for batch in batches:
            yield from zip(*(batch[name].to_pylist() for name in names))

    for key, group in groupby(rows(), key=lambda row: row[:2]):
        yield key, list(group)


def _proofs(proofs: list[tuple]) -> pa.Array:
    """Proofs as an Arrow list of (place, siblings)."""
    steps = [step for proof in proofs for step in proof]
    siblings = [digest for _, found in steps for digest in found]

    def starts(sizes) -> pa.Array:
        at = [0]
        for size in sizes:
            at.append(at[-1] + size)
        return pa.array(at, pa.int32())

    lists = pa.ListArray.from_arrays(starts(len(found) for _, found in steps), pa.array(siblings, pa.string()))
    pairs = pa.StructArray.from_arrays([pa.array([p for p, _ in steps], pa.int32()), lists], ["place", "siblings"])
    return pa.ListArray.from_arrays(starts(map(len, proofs)), pairs)


def _sweep_up(fanout: int, depth: int):
    def sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (tree, block), rows in _blocks(batches, ["tree", "block", "n", "digest"]):
            n = rows[0][2]
            height = depth if n > fanout**depth else height_of(n, fanout)
            top, _ = forward([row[3] for row in rows], height, fanout)
            yield pa.RecordBatch.from_arrays(
                [pa.array([tree]), pa.array([block], pa.int64()), pa.array([-(-n // fanout**depth)], pa.int64()), pa.array([top])],
                names=["tree", "pos", "n", "digest"],
            )

    return sweep


def _sweep_down(fanout: int, depth: int):
    names = ["tree", "block", "pos", "n", "id", "digest", "claim", "subroot", "root", "suffix"]

    def sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (tree, _), (message, *rows) in _blocks(batches, names):
            n, subroot, root = rows[0][3], message[7], message[8]
            suffix = tuple((step["place"], tuple(step["siblings"])) for step in message[9])
            height = depth if n > fanout**depth else height_of(n, fanout)
            _, children = forward([row[5] for row in rows], height, fanout)
            swept = dict(backward(len(rows), height, fanout, children, suffix))
            size = len(rows)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([tree] * size), pa.array([row[2] for row in rows], pa.int64()),
                    pa.array([row[4] for row in rows], pa.int64()), pa.array([row[5] for row in rows]),
                    pa.array([row[6] for row in rows], pa.string()), pa.array([subroot] * size, pa.string()),
                    pa.array([root] * size), _proofs([swept[i] for i in range(size)]),
                ],
                names=["tree", "pos", "id", "digest", "claim", "subroot", "root", "proof"],
            )

    return sweep


# Spark side ----------------------------------------------------------------------------


def _numbered(rows: DataFrame, *order: str) -> DataFrame:
    """``rows`` with their number inside their tree (``pos``) and the size of the tree (``n``)."""
    placed = staged(
        rows.repartitionByRange("tree", *order).sortWithinPartitions("tree", *order)
        .withColumn("_at", F.monotonically_increasing_id())
        .withColumn("_part", F.shiftright("_at", ROW_BITS)),
        "numbered",
    )
    spans = placed.groupBy("tree", "_part").agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_rows"))
    before = Window.partitionBy("tree").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    spans = spans.select(
        "tree", "_part",
        (F.coalesce(F.sum("_rows").over(before), F.lit(0)) - F.col("_first")).alias("_shift"),
        F.sum("_rows").over(Window.partitionBy("tree")).alias("n"),
    )
    return placed.join(spans, ["tree", "_part"]).withColumn("pos", F.col("_at") + F.col("_shift")).drop(
        "_at", "_part", "_shift", "_row"
    )


def _by_block(rows: DataFrame, *order: str) -> DataFrame:
    return rows.repartition("tree", "block").sortWithinPartitions("tree", "block", *order)


def _rounds(nodes: DataFrame, fanout: int, depth: int) -> list[DataFrame]:
    """The nodes, their blocks' tops, the tops of those, up to one node for each tree."""
    rounds, block = [nodes], (F.col("pos") / F.lit(fanout**depth)).cast("long")
    while True:
        rows = rounds[-1].select("tree", block.alias("block"), "pos", "n", "digest")
        rounds.append(staged(_by_block(rows, "pos").mapInArrow(_sweep_up(fanout, depth), UP), "tops"))
        if (rounds[-1].agg(F.max("n")).first()[0] or 0) <= 1:
            return rounds


def _descend(rounds: list[DataFrame], tops: DataFrame, fanout: int, depth: int) -> DataFrame:
    """Proofs of the first nodes from those of the tops (tree, pos, subroot, root, proof)."""
    block = (F.col("pos") / F.lit(fanout**depth)).cast("long")
    null = F.lit(None)
    for nodes in reversed(rounds[:-1]):
        first = "id" in nodes.columns
        messages = tops.select(
            "tree", F.col("pos").alias("block"), F.lit(-1).cast("long").alias("pos"), null.cast("long").alias("n"),
            null.cast("long").alias("id"), null.cast("string").alias("digest"), null.cast("string").alias("claim"),
            "subroot", "root", F.col("proof").alias("suffix"),
        )
        rows = nodes.select(
            "tree", block.alias("block"), "pos", "n", *(["id"] if first else [null.cast("long").alias("id")]),
            "digest", *(["claim"] if first else [null.cast("string").alias("claim")]),
            null.cast("string").alias("subroot"), null.cast("string").alias("root"), null.cast(PROOF).alias("suffix"),
        )
        tops = _by_block(messages.unionByName(rows), "pos").mapInArrow(_sweep_down(fanout, depth), DOWN)
        if not first:
            tops = staged(tops, "suffixes")
    return tops


def manifest(
    docs: DataFrame, leaf: Column, id_col: str = "doc_id", tree_col: str = "lang", claim: Column | None = None,
    fanout: int = FANOUT, depth: int = DEPTH,
) -> DataFrame:
    """One row per document: id, digest (its leaf), claim, subroot, root, proof.

    ``leaf`` is the digest of a row; ``claim`` a digest that is carried along to be checked
    against the proof (by default the leaf). A proof lists, from the leaf to the root, the
    node's place among its parent's children and the siblings in order.

    Rows without a tree value are a tree of their own, before all others; trees follow by
    the bytes of their value. Rows that share an id in a tree follow by digest; rows
    without an id come first. Equal rows are leaves of their own. An empty table gives no
    rows. Texts of any length are read whole; columns that no expression names are not.
    """
    leaves = staged(
        docs.select(
            # "-" sorts before "=" and so null before every value.
            F.coalesce(F.concat(F.lit("="), F.col(tree_col).cast("string")), F.lit("-")).alias("tree"),
            F.col(id_col).cast("long").alias("id"), leaf.alias("digest"),
            (leaf if claim is None else claim).alias("claim"), F.monotonically_increasing_id().alias("_row"),
        ),
        "leaves",
    )
    nodes = staged(_numbered(leaves, "id", "digest", "claim", "_row"), "leaves")
    trees = _rounds(nodes, fanout, depth)
    subroots = trees[-1].select(F.lit("").alias("tree"), F.col("tree").alias("member"), "digest")
    members = staged(_numbered(subroots, "member"), "subroots")
    upper = _rounds(members.select("tree", "pos", "n", "digest"), fanout, depth)
    top = upper[-1].select(
        "tree", "pos", F.lit(None).cast("string").alias("subroot"), F.col("digest").alias("root"),
        F.array().cast(PROOF).alias("proof"),
    )
    ways = _descend(upper, top, fanout, depth).select("pos", F.col("digest").alias("subroot"), "root", "proof")
    tops = members.join(ways, "pos").select(
        F.col("member").alias("tree"), F.lit(0).cast("long").alias("pos"), "subroot", "root", "proof"
    )
    return _descend(trees, staged(tops, "subroot-proofs"), fanout, depth).select(
        F.col("id").alias(id_col), "digest", "claim", "subroot", "root", "proof"
    )


def checked(rows: DataFrame) -> DataFrame:
    """``manifest`` rows with the digest of the proof, the root that the claim leads to, and
    whether it is the root."""
    return rows.withColumns({
        "proof_sha256": proof_digest(F.col("proof")), "folded_root": folded(F.col("claim"), F.col("proof")),
    }).withColumn("verified", F.col("folded_root") == F.col("root"))
