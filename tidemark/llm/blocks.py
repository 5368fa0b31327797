"""Blocks: look up the distinct words of documents without moving every occurrence.

A block is a run of consecutive rows of a file, sized so that its texts fit a task. Each
block asks for its distinct words, the answers are joined by word, packed, and meet the
block's packed texts in one cogroup. However frequent a word is, it has one row per block.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, functions as F

from tidemark.llm.common import slices, staged, text_or_empty

#: Bytes of text that a block holds on average.
BLOCK_BYTES = 20 << 20

TEXTS = "block long, ids array<long>, marks array<int>, sizes array<int>, texts binary"
ANSWERS = "block long, n int, answers binary"


def in_blocks(docs: DataFrame, id_col: str, text_col: str, mark: Column | None = None) -> DataFrame:
    """(id, mark, text, block), the same blocks in every pass over ``docs``.

    Documents that do not come from files are written once to get a place.
    """
    wanted = [
        F.col(id_col).cast("long").alias("id"), (F.lit(0) if mark is None else mark).cast("int").alias("mark"),
        text_or_empty(text_col).alias("text"),
    ]
    place = [F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row")]
    try:
        placed = docs.select(*wanted, *place)
    except AnalysisException:
        placed = staged(docs.select(*wanted), "texts").select("id", "mark", "text", *place)
    size = placed.agg(F.sum(F.octet_length("text")), F.count(F.lit(1))).first()
    per_block = max(1, int(BLOCK_BYTES / max((size[0] or 0) / max(size[1], 1), 1)))
    block = F.xxhash64("file", F.floor(F.col("row") / F.lit(per_block)))
    return placed.select("id", "mark", "text", block.alias("block"))


def pack_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The texts (binary) of each block in one compressed row for every few documents."""
    for batch in slices(batches, 300):
        held: dict[int, list] = {}
        for block, *row in zip(*(batch[c].to_pylist() for c in ("block", "id", "mark", "text"))):
            held.setdefault(block, []).append(row)
        pack = zstandard.ZstdCompressor(level=5).compress
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(list(held), pa.int64()),
                pa.array([[r[0] for r in rows] for rows in held.values()], pa.list_(pa.int64())),
                pa.array([[r[1] for r in rows] for rows in held.values()], pa.list_(pa.int32())),
                pa.array([[len(r[2]) for r in rows] for rows in held.values()], pa.list_(pa.int32())),
                pa.array([pack(b"".join(r[2] for r in rows)) for rows in held.values()], pa.binary()),
            ],
            names=["block", "ids", "marks", "sizes", "texts"],
        )


def unpack_texts(packed: pa.Table) -> Iterator[tuple[list, list[bytes]]]:
    """Ids and texts of some documents of a block at a time."""
    for ids, sizes, texts in zip(*(packed[c].to_pylist() for c in ("ids", "sizes", "texts"))):
        raw = zstandard.ZstdDecompressor().decompress(texts)
        ends = np.cumsum(sizes).tolist()
        yield ids, [raw[a:b] for a, b in zip([0, *ends], ends)]


def marks_of(packed: pa.Table) -> list[int]:
    """The marks of the documents of a block, in the order of ``unpack_texts``."""
    return [mark for marks in packed["marks"].to_pylist() for mark in marks]


def _parts(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Start offsets (one more than rows) and the values behind them of a binary or list column."""
    whole = column.combine_chunks()
    if isinstance(whole, pa.ChunkedArray):
        whole = whole.chunk(0) if whole.num_chunks else pa.array([], column.type)
    offsets = np.frombuffer(whole.buffers()[1], np.int32)[whole.offset : whole.offset + len(whole) + 1]
    if pa.types.is_binary(whole.type):
        data = whole.buffers()[2]
        return offsets, np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return offsets, whole.values.to_numpy(zero_copy_only=False).astype(np.int64)


def pack_answers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(block, word, values) rows as one compressed row for each block of a batch."""
    pack = zstandard.ZstdCompressor(level=3).compress
    for batch in batches:
        if not batch.num_rows:
            continue
        order = np.argsort(batch["block"].to_numpy(zero_copy_only=False), kind="stable")
        rows = pa.Table.from_batches([batch]).take(pa.array(order))
        blocks = rows["block"].to_numpy()
        at, letters = _parts(rows["word"])
        value_at, values = _parts(rows["values"])
        edges = np.flatnonzero(np.concatenate([[True], blocks[1:] != blocks[:-1], [True]])).tolist()
        out = []
        for a, b in zip(edges[:-1], edges[1:]):
            raw = b"".join((
                np.diff(at[a : b + 1]).tobytes(), np.diff(value_at[a : b + 1]).tobytes(),
                values[value_at[a] : value_at[b]].tobytes(), letters[at[a] : at[b]].tobytes(),
            ))
            out.append((int(blocks[a]), b - a, pack(raw)))
        kinds = (pa.int64(), pa.int32(), pa.binary())
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[i] for r in out], t) for i, t in enumerate(kinds)], names=["block", "n", "answers"]
        )


def unpack_raw(packed: pa.Table) -> tuple[bytes, np.ndarray, np.ndarray, np.ndarray]:
    """The words of a block in a row, the bytes of each, how many values each has, and all values."""
    words, sizes, counts, values = [], [np.zeros(0, np.int32)], [np.zeros(0, np.int32)], [np.zeros(0, np.int64)]
    for n, answers in zip(packed["n"].to_pylist(), packed["answers"].to_pylist()):
        raw = zstandard.ZstdDecompressor().decompress(answers)
        size, count = np.frombuffer(raw[: 8 * n], np.int32).reshape(2, n)
        end = 8 * n + 8 * int(count.sum())
        sizes.append(size)
        counts.append(count)
        values.append(np.frombuffer(raw[8 * n : end], np.int64))
        words.append(raw[end:])
    return b"".join(words), np.concatenate(sizes), np.concatenate(counts), np.concatenate(values)


def unpack_answers(packed: pa.Table) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """The words of a block, how many values each has, and all values in a row."""
    raw, sizes, counts, values = unpack_raw(packed)
    ends = np.cumsum(sizes, dtype=np.int64).tolist()
    return [raw[a:b] for a, b in zip([0, *ends], ends)], counts, values


def answered(wanted: DataFrame, answers: DataFrame, label: str) -> DataFrame:
    """``wanted`` (block, word) joined with ``answers`` (word, values), packed by block and written.

    A word without an answer has no values.
    """
    joined = wanted.join(answers.hint("merge"), "word", "left").select("block", F.col("word").cast("binary").alias("word"), "values")
    return staged(joined.mapInArrow(pack_answers, ANSWERS), label)


def for_each_block(
    rows: DataFrame, answers: DataFrame, work: Callable[[pa.Table, pa.Table], pa.Table], schema: str
) -> DataFrame:
    """``work`` on every block's packed texts and packed answers."""
    texts = rows.select("block", "id", "mark", F.col("text").cast("binary").alias("text")).mapInArrow(pack_texts, TEXTS)
    return texts.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(
        lambda packed, found: work(packed, found), schema
    )
