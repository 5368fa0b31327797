"""User-defined functions over rows, groups and windows, Arrow batch by batch."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import chain, groupby

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F, types as T

Frame = pd.DataFrame

# Integers that may be NULL stay integers.
NULLABLE = {
    pa.int8(): pd.Int8Dtype(), pa.int16(): pd.Int16Dtype(), pa.int32(): pd.Int32Dtype(), pa.int64(): pd.Int64Dtype()
}


def map_with_lifecycle(
    df: DataFrame,
    open_task: Callable[[], object],
    map_batch: Callable[[object, Frame], Frame],
    close_task: Callable[[object], None],
    schema: str | T.StructType,
) -> DataFrame:
    """Per-task set-up and tear-down around a batch function."""

    def run(batches: Iterator[Frame]) -> Iterator[Frame]:
        resource = open_task()
        try:
            for batch in batches:
                yield map_batch(resource, batch)
        finally:
            close_task(resource)

    return df.mapInPandas(run, schema)


def accumulate(
    df: DataFrame,
    keys: list[str],
    add: Callable[[Frame], Frame],
    merge: Callable[[Frame], Frame],
    state: str | T.StructType,
    result: Callable[[DataFrame], DataFrame] = lambda d: d,
    flush_rows: int = 50_000,
) -> DataFrame:
    """User aggregate with a map-side phase.

    ``add`` turns a batch of rows into one accumulator row per key, ``merge`` does the
    same to accumulator rows. Tasks merge what they hold before the shuffle; behind it
    the accumulators pass in key order and a key is given out once the next one starts.
    A hot key thus costs one accumulator per task (or per ``flush_rows`` accumulators),
    never its rows, and no task holds more than a batch. NULL keys form a group if the
    functions group with ``dropna=False``; integers come as nullable ones.
    """
    layout = df.sparkSession.createDataFrame([], state).toArrow().schema

    def frames(batches: Iterator[pa.RecordBatch]) -> Iterator[Frame]:
        for batch in batches:
            yield batch.to_pandas(types_mapper=NULLABLE.get)

    def rows(found: Iterator[Frame]) -> Iterator[pa.RecordBatch]:
        for frame in found:
            yield pa.RecordBatch.from_pandas(frame, schema=layout, preserve_index=False)

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return rows(partially(frames(batches)))

    def final(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return rows(finally_(frames(batches)))

    def partially(batches: Iterator[Frame]) -> Iterator[Frame]:
        held: list[Frame] = []
        size = 0
        for batch in batches:
            if len(batch):
                held.append(add(batch))
                size += len(held[-1])
            if size >= flush_rows:
                held = [merge(pd.concat(held, ignore_index=True))]
                size = len(held[0])
                if size >= flush_rows // 2:
                    yield held[0]
                    held, size = [], 0
        if held:
            yield merge(pd.concat(held, ignore_index=True))

    def finally_(batches: Iterator[Frame]) -> Iterator[Frame]:
        open_key: Frame | None = None
        for batch in batches:
            if not len(batch):
                continue
            both = batch if open_key is None else pd.concat([open_key, batch], ignore_index=True)
            last = both[keys].iloc[-1]
            same = pd.Series(True, index=both.index)
            for key in keys:
                value = last[key]
                equal = both[key].isna() if pd.isna(value) else both[key] == value
                same &= equal.fillna(False).astype(bool)
            if not same.all():
                yield merge(both[~same])
            open_key = merge(both[same])
        if open_key is not None:
            yield open_key

    shuffled = df.mapInArrow(partial, state).repartition(*keys).sortWithinPartitions(*keys)
    return result(shuffled.mapInArrow(final, state))


def process_window(
    df: DataFrame,
    keys: list[str],
    ts: str,
    size: str,
    add: Callable[[Frame], Frame],
    merge: Callable[[Frame], Frame],
    state: str,
    result: Callable[[DataFrame], DataFrame] = lambda d: d,
) -> DataFrame:
    """User function over the rows of each key and window, with the window at hand.

    ``add`` and ``merge`` see ``window_start`` and ``window_end`` beside the row and work
    as in :func:`accumulate`, so a window is never gathered in one place however many
    rows it holds. ``state`` lists the accumulator columns after the keys and bounds.
    """
    windowed = df.withColumn("_w", F.window(ts, size)).select(
        *df.columns,
        F.col("_w.start").alias("window_start"),
        F.col("_w.end").alias("window_end"),
    )
    kinds = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    layout = ", ".join(
        [f"{k} {kinds[k]}" for k in keys]
        + ["window_start timestamp", "window_end timestamp", state]
    )
    return accumulate(
        windowed, [*keys, "window_start", "window_end"], add, merge, layout, result
    )


#: Results that are handed back at once.
RESULTS = 10_000


def _stretches(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[tuple, pa.RecordBatch]]:
    """Parts of sorted batches in which the keys stay the same, NULL equal to NULL."""
    for batch in batches:
        if not batch.num_rows:
            continue
        turns = np.zeros(batch.num_rows - 1, bool)
        for key in keys:
            here, before = batch[key].slice(1), batch[key].slice(0, batch.num_rows - 1)
            turns |= pc.fill_null(pc.not_equal(here, before), False).to_numpy(zero_copy_only=False)
            turns |= pc.not_equal(pc.is_null(here), pc.is_null(before)).to_numpy(zero_copy_only=False)
        edges = [0, *(np.flatnonzero(turns) + 1).tolist(), batch.num_rows]
        for start, end in zip(edges, edges[1:]):
            yield tuple(batch[key][start].as_py() for key in keys), batch.slice(start, end - start)


def ordered_window(
    df: DataFrame,
    keys: list[str],
    ts: str,
    size: str,
    order: list[str],
    function: Callable[[int, Iterator[pa.RecordBatch]], tuple],
    result: str,
) -> DataFrame:
    """User function that needs all rows of each key and window, in ``order``.

    For functions that do not merge: ``function`` gets the number of rows of the window and
    then the rows, sorted, batch by batch, and returns the values of the columns ``result``.
    The engine sorts, spilling to disk, and a batch is all that is ever held, so a window may
    have any number of rows; it is one task's to read, though. Where a function can be
    merged, :func:`process_window` spreads a window over tasks.
    """
    bounds = ["window_start", "window_end"]
    windowed = df.where(F.col(ts).isNotNull()).withColumn("_w", F.window(ts, size)).select(
        *df.columns, F.col("_w.start").alias("window_start"), F.col("_w.end").alias("window_end")
    )
    groups = [*keys, *bounds]
    # The number of rows comes first in its group, as a row of its own.
    sizes = windowed.groupBy(*groups).agg(F.count(F.lit(1)).alias("_rows"))
    rows = windowed.withColumn("_rows", F.lit(None).cast("bigint")).unionByName(sizes, allowMissingColumns=True)
    in_order = rows.repartition(*groups).sortWithinPartitions(
        *groups, F.col("_rows").desc_nulls_last(), *order
    )
    kinds = {f.name: f.dataType.simpleString() for f in windowed.schema.fields}
    layout = ", ".join([f"{name} {kinds[name]}" for name in groups] + [result])
    schema = df.sparkSession.createDataFrame([], layout).toArrow().schema
    own = [c for c in df.columns if c not in keys]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: list[tuple] = []
        for group, parts in groupby(_stretches(batches, groups), key=lambda part: part[0]):
            _, first = next(parts)
            count = first["_rows"][0].as_py()
            rest = chain([first.slice(1)], (batch for _, batch in parts))
            found.append((*group, *function(count, (batch.select(own) for batch in rest if batch.num_rows))))
            if len(found) >= RESULTS:
                yield written(found)
                found = []
        if found:
            yield written(found)

    def written(found: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(values, field.type) for values, field in zip(zip(*found), schema)], schema=schema
        )

    return in_order.mapInArrow(run, layout)


def nth_value(column: str, place: Callable[[int], int]) -> Callable[[int, Iterator[pa.RecordBatch]], tuple]:
    """For :func:`ordered_window`: the value at ``place(rows)``, counted from 0."""

    def pick(count: int, batches: Iterator[pa.RecordBatch]) -> tuple:
        left = place(count)
        for batch in batches:
            if left < batch.num_rows:
                return (batch[column][left].as_py(),)
            left -= batch.num_rows
        return (None,)

    return pick
