"""Exact dedup through a minimal perfect hash over historical distinct digests.

Texts are equal when they are identical after every run of white space is replaced by one
space. An index over the distinct digests of earlier documents is cut into shards by
digest; each shard has a minimal perfect hash whose slots hold the full 32-byte digest and
the locator (smallest id) of the text that stays. A perfect hash answers for any key, so
each answer is checked against all bytes of the digest in the slot; what is no member is
grouped separately.

Only digests and ids are shuffled, and distinct digests only reach a shard: copies are
reduced by map-side aggregation first, so a shard is bounded by ``SHARD_ROWS`` digests
however large a group of copies is. The answer returns to the rows of a group by
(digest, salt), so that a group of any size is dealt over many tasks.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.llm.common import SPACES, salt, staged, text_or_empty

#: Distinct digests in a shard; a shard is built and probed by one task (some 5 MB).
SHARD_ROWS = 50_000
#: Levels of the perfect hash; keys that are left after them are listed.
LEVELS = 48
DIGEST_BYTES = 32

INDEX_SCHEMA = (
    "shard int, sizes binary, bits binary, digests binary, winners binary, known binary, copies binary"
)
ANSWER_SCHEMA = "digest binary, keep_id long, group_size long"


def normalised(text: str = "text") -> Column:
    return F.regexp_replace(text_or_empty(text), SPACES, " ")


def digest_of(text: str = "text") -> Column:
    return F.unhex(F.sha2(normalised(text).cast("binary"), 256))


# Perfect hash of one shard ---------------------------------------------------------


def _positions(words: np.ndarray, level: int, size: int) -> np.ndarray:
    """Where each key (four 64-bit words) falls in the bit array of a level."""
    x = words[:, level % 4] + words[:, (level + 1) % 4] * np.uint64(2 * level + 0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(32)
    return (x % np.uint64(size)).astype(np.int64)


class PerfectHash:
    """Bit arrays by level: a key lives on the first level where it is alone in its place.

    The slot of a key is the number of set bits before its place. Keys that share a place
    on every level follow in the given order and are found by comparison.
    """

    def __init__(self, sizes: np.ndarray, bits: np.ndarray):
        self.sizes = sizes
        self.bits = bits
        self.ranks = np.concatenate([[0], np.cumsum(bits, dtype=np.int64)])

    @classmethod
    def build(cls, words: np.ndarray) -> tuple[PerfectHash, np.ndarray]:
        """The hash of distinct keys, and the keys' numbers in slot order."""
        left, sizes, arrays, order = np.arange(len(words)), [], [], []
        for level in range(LEVELS):
            if not len(left):
                break
            size = max(64, 2 * len(left))
            places = _positions(words[left], level, size)
            alone = np.bincount(places, minlength=size) == 1
            sits = alone[places]
            order.append(left[sits][np.argsort(places[sits])])
            sizes.append(size)
            arrays.append(alone)
            left = left[~sits]
        order.append(left)
        bits = np.concatenate(arrays) if arrays else np.zeros(0, bool)
        return cls(np.array(sizes, np.int64), bits), np.concatenate(order)

    def slots(self, words: np.ndarray) -> np.ndarray:
        """Slot of each key, -1 where no level has a bit at its place."""
        slots = np.full(len(words), -1, np.int64)
        left, start = np.arange(len(words)), 0
        for level, size in enumerate(self.sizes):
            places = start + _positions(words[left], level, int(size))
            hit = self.bits[places]
            slots[left[hit]] = self.ranks[places[hit]]
            left, start = left[~hit], start + int(size)
        return slots


def _digest_rows(column: pa.ChunkedArray) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, DIGEST_BYTES)


def _words(digests: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(digests).view(np.uint64).reshape(-1, 4)


def _known_ids(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    known = ~column.is_null().to_numpy(zero_copy_only=False)
    return column.fill_null(0).to_numpy().astype(np.int64), known


def _build_shard(rows: pa.Table) -> pa.Table:
    digests = _digest_rows(rows["digest"])
    ids, known = _known_ids(rows["keep_id"])
    mph, order = PerfectHash.build(_words(digests))
    return pa.table({
        "shard": pa.array([rows["shard"][0].as_py()], pa.int32()),
        "sizes": [mph.sizes.tobytes()],
        "bits": [np.packbits(mph.bits).tobytes()],
        "digests": [digests[order].tobytes()],
        "winners": [ids[order].tobytes()],
        "known": [known[order].tobytes()],
        "copies": [rows["group_size"].to_numpy().astype(np.int64)[order].tobytes()],
    })


def _answers(digests: np.ndarray, ids: np.ndarray, known: np.ndarray, sizes: np.ndarray) -> pa.Table:
    flat = np.ascontiguousarray(digests).tobytes()
    return pa.table({
        "digest": pa.array([flat[i : i + DIGEST_BYTES] for i in range(0, len(flat), DIGEST_BYTES)], pa.binary()),
        "keep_id": pa.array(ids, pa.int64(), mask=~known),
        "group_size": pa.array(sizes, pa.int64()),
    })


def _probe_shard(probes: pa.Table, index: pa.Table) -> pa.Table:
    """Members take the winner of their slot; the rest stand for themselves."""
    digests = _digest_rows(probes["digest"])
    ids, known = _known_ids(probes["keep_id"])
    sizes = probes["group_size"].to_numpy().astype(np.int64)
    if not index.num_rows:
        return _answers(digests, ids, known, sizes)
    row = {name: index[name][0].as_py() for name in index.column_names}
    level_sizes = np.frombuffer(row["sizes"], np.int64)
    bits = np.unpackbits(np.frombuffer(row["bits"], np.uint8), count=int(level_sizes.sum())).astype(bool)
    mph = PerfectHash(level_sizes, bits)
    held = np.frombuffer(row["digests"], np.uint8).reshape(-1, DIGEST_BYTES)
    old_ids = np.frombuffer(row["winners"], np.int64).copy()
    old_known = np.frombuffer(row["known"], bool).copy()
    copies = np.frombuffer(row["copies"], np.int64).copy()

    slots = mph.slots(_words(digests))
    placed = int(mph.ranks[-1])
    if placed < len(held):  # keys that no level could place
        listed = {held[i].tobytes(): i for i in range(placed, len(held))}
        for i in np.flatnonzero(slots < 0):
            slots[i] = listed.get(digests[i].tobytes(), -1)
    member = slots >= 0
    member[member] = (held[slots[member]] == digests[member]).all(axis=1)
    at = slots[member]
    copies[at] += sizes[member]
    # The locator of the index wins; a later batch may still bring a smaller id.
    better = known[member] & (~old_known[at] | (ids[member] < old_ids[at]))
    old_ids[at[better]] = ids[member][better]
    old_known[at[better]] = True
    rest = ~member
    return _answers(
        np.concatenate([held, digests[rest]]), np.concatenate([old_ids, ids[rest]]),
        np.concatenate([old_known, known[rest]]), np.concatenate([copies, sizes[rest]]),
    )


# Spark side ------------------------------------------------------------------------


def _distinct(rows: DataFrame, shards: int) -> DataFrame:
    """One row for each digest, reduced before the shuffle."""
    return rows.groupBy("digest").agg(
        F.min("id").alias("keep_id"), F.count(F.lit(1)).alias("group_size")
    ).withColumn("shard", F.pmod(F.xxhash64("digest"), F.lit(shards)).cast("int"))


def build_index(distinct: DataFrame) -> DataFrame:
    """Perfect-hash shards over distinct digests (shard, digest, keep_id, group_size)."""
    return distinct.groupBy("shard").applyInArrow(_build_shard, INDEX_SCHEMA)


def look_up(probes: DataFrame, index: DataFrame) -> DataFrame:
    """Every digest of either side with its winner and the size of its group."""
    return probes.groupBy("shard").cogroup(index.groupBy("shard")).applyInArrow(_probe_shard, ANSWER_SCHEMA)


def exact_groups(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", older: Column | None = None,
    shard_rows: int = SHARD_ROWS,
) -> DataFrame:
    """One row per document: id, keep_id, group_size, kept, text_sha256.

    ``older`` marks the documents that the index is built over; by default those with an
    id up to the median. The result does not depend on it.

    Null texts count as empty, and empty texts are equal to each other. A null id is
    larger than any other, so such a row stays only in a group without ids. Rows that
    repeat an id and a text are all reported as the one that stays; ``drop_copies`` keeps
    one of them. An empty table gives no rows. Other columns are not read.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("id"), digest_of(text_col).alias("digest"))
    if older is not None:
        rows = docs.select(
            F.col(id_col).cast("long").alias("id"), digest_of(text_col).alias("digest"),
            F.coalesce(older, F.lit(False)).alias("older"),
        )
    rows = staged(rows.withColumn("salt", salt(F.coalesce("id", F.lit(0)))), "digests")
    if older is None:
        cut = rows.agg(F.percentile_approx("id", 0.5)).first()[0]
        rows = rows.withColumn("older", F.coalesce(F.col("id") <= F.lit(cut).cast("long"), F.lit(False)))
    shards = max(1, -(-rows.count() // shard_rows))
    index = build_index(_distinct(rows.filter("older"), shards))
    answers = look_up(_distinct(rows.filter("NOT older"), shards), index)
    # At most SALTS rows for a digest, and one for a text that occurs once.
    places = rows.select("digest", "salt").distinct().join(answers, "digest")
    return rows.join(places, ["digest", "salt"]).select(
        F.col("id").alias(id_col),
        "keep_id",
        "group_size",
        F.expr("id <=> keep_id").alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents that stay, with all their columns.

    Texts are shuffled once, by digest and id; of rows that repeat both, one stays.
    """
    groups = exact_groups(docs, id_col, text_col).filter("kept")
    keep = groups.select(
        F.col("text_sha256").alias("_digest"), F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("_id")
    )
    keyed = docs.withColumns({
        "_digest": F.sha2(normalised(text_col).cast("binary"), 256),
        "_id": F.coalesce(F.col(id_col).cast("string"), F.lit("")),
    })
    stay = keyed.join(keep, ["_digest", "_id"], "left_semi")
    one = Window.partitionBy("_digest", "_id").orderBy("_id")
    return stay.withColumn("_n", F.row_number().over(one)).filter("_n = 1").select(*docs.columns)

