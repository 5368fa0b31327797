"""Running results of a stream whose hot keys are cut over tasks.

The streaming twin of ``operators.running``. The time of a key is cut into slices, and rows
are kept by (key, slice), so a key with any share of the rows is spread over the state
partitions. Three keyed stages pass on little:

* ``Reduce``, by (key, slice): how many rows, their sum and the last few of them, in one
  value however many rows there are. It comes out when the watermark passes the slice.
* ``Carry``, by key: what all earlier slices amount to, handed to each slice. It sees one
  row for a slice, and holds one value.
* ``Walk``, by (key, slice): the rows, appended as they come and never read until the carry
  is there; then they are walked in order from it and forgotten.

Rows behind the watermark are dropped by the first stage and counted by the engine. Times
are epoch microseconds. A slice of one key is sorted in memory, so ``width`` is to be a time
in which the hottest key has a task's worth of rows.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Row, functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from tidemark.functions.durations import bucket, micros
from tidemark.streaming.stateful import stateful, timer_after

#: What is kept of a row.
KEPT = ("at", "event_id", "vc", "first", "second")
LAYOUT = "at: bigint, event_id: bigint, vc: int, first: boolean, second: boolean"
SUMMARY = f"n bigint, total bigint, last array<struct<{LAYOUT}>>"


def _kept(row) -> tuple:
    """From an input row, or a struct inside one."""
    return tuple(row[name] for name in KEPT)


def _written(rows) -> list[dict]:
    """Rows as the elements of an output column; state takes tuples."""
    return [dict(zip(KEPT, row)) for row in rows]


class Reduce(StatefulProcessor):
    """Number and sum of the rows of a slice, and its last ``keep`` rows, in any order."""

    OUTPUT = f"key bigint, slice bigint, {SUMMARY}"

    def __init__(self, width: str, keep: int):
        self.width, self.keep = micros(width), keep

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.summary = handle.getValueState("summary", SUMMARY)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        known = self.summary.get()
        if known is None:
            self.handle.registerTimer(timer_after((key[1] + 1) * self.width))
        n, total, last = known or (0, None, [])
        last = [tuple(row) for row in last]
        for row in rows:
            n += 1
            if row.vc is not None:
                total = (total or 0) + row.vc
            last.append(_kept(row))
            if len(last) > 2 * self.keep:
                last = self._latest(last)
        self.summary.update((n, total, self._latest(last)))
        return iter(())

    def _latest(self, rows: list[tuple]) -> list[tuple]:
        return sorted(rows, key=lambda r: r[:2])[len(rows) - min(self.keep, len(rows)):]

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        n, total, last = self.summary.get()
        self.summary.clear()
        yield Row(key=key[0], slice=key[1], n=n, total=total, last=_written(last))

    def close(self) -> None:
        pass


class Carry(StatefulProcessor):
    """What comes before each slice of a key; slices come in order, as they close."""

    OUTPUT = Reduce.OUTPUT

    def __init__(self, keep: int):
        self.keep = keep

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.so_far = handle.getValueState("so_far", SUMMARY)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        n, total, last = self.so_far.get() or (0, None, [])
        last = [tuple(row) for row in last]
        for row in sorted(rows, key=lambda r: r.slice):
            yield Row(key=key[0], slice=row.slice, n=n, total=total, last=_written(last))
            n += row.n
            if row.total is not None:
                total = (total or 0) + row.total
            last = [*last, *map(_kept, row.last)]
            last = last[len(last) - min(self.keep, len(last)):]
        self.so_far.update((n, total, last))

    def close(self) -> None:
        pass


class Walk(StatefulProcessor):
    """Rows of a slice in order, from its carry on. Subclasses say what comes out of a row."""

    KEEP = 0
    OUTPUT = ""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.rows = handle.getListState("rows", LAYOUT.replace(":", ""))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        carry, new = None, []
        for row in rows:
            if row.n is None:
                new.append(_kept(row))
            else:
                carry = (row.n, row.total, [_kept(r) for r in row.last])
        if carry is None:
            self.rows.appendList(new)
            return
        ordered = sorted([*(tuple(r) for r in self.rows.get()), *new], key=lambda r: r[:2])
        self.rows.clear()
        yield from self.walk(key[0], *carry, ordered)

    def walk(self, key, n: int, total: int | None, last: list[tuple], rows: list[tuple]) -> Iterator[Row]:
        raise NotImplementedError

    def close(self) -> None:
        pass


class Moving(Walk):
    """Number and sum over the last ``span`` rows of a key, after every ``slide`` rows.

    ``nth`` is the row's number within its key. With ``slide`` 1 it is a moving frame,
    otherwise a sliding count window.
    """

    OUTPUT = "id bigint, event_id bigint, nth bigint, cnt bigint, total bigint"

    def __init__(self, span: int = 3, slide: int = 1):
        self.span, self.slide = span, slide
        self.KEEP = span - 1

    def walk(self, key, n, total, last, rows) -> Iterator[Row]:
        for row in rows:
            n += 1
            last = [*last, row][-self.span:]
            if n % self.slide == 0:
                known = [r[2] for r in last if r[2] is not None]
                yield Row(
                    id=key, event_id=row[1], nth=n, cnt=len(last), total=sum(known) if known else None
                )


class Changelog(Walk):
    """A running sum as retract and add rows: the old result goes, the new one comes."""

    OUTPUT = "id bigint, event_id bigint, added boolean, total bigint"

    def walk(self, key, n, total, last, rows) -> Iterator[Row]:
        total = total or 0
        for row in rows:
            if n:
                yield Row(id=key, event_id=row[1], added=False, total=total)
            n, total = n + 1, total + (row[2] or 0)
            yield Row(id=key, event_id=row[1], added=True, total=total)


class StrictNext(Walk):
    """A ``first`` row and the row right after it, if that is ``second`` and strictly in time.

    Without ``within`` any time will do.
    """

    KEEP = 1
    OUTPUT = "key bigint, first_id bigint, second_id bigint"

    def __init__(self, within: str | None = None):
        self.within = None if within is None else micros(within)

    def walk(self, key, n, total, last, rows) -> Iterator[Row]:
        for before, row in zip([*last, *rows] if last else rows, rows if last else rows[1:]):
            in_time = self.within is None or row[0] - before[0] < self.within
            if before[3] and row[4] and in_time:
                yield Row(key=key, first_id=before[1], second_id=row[1])


def sliced(df: DataFrame, key: str, ts: str, width: str, delay: str, walk: Walk) -> DataFrame:
    """``walk`` over the rows of each key of a stream, whose hot keys may hold any share of it.

    ``df`` has the columns ``key``, ``ts``, ``event_id`` and what ``walk`` reads of ``vc``,
    ``first`` and ``second``; rows come up to ``delay`` out of order. Rows without a time
    take no part.
    """
    kinds = {"vc": "int", "first": "boolean", "second": "boolean"}
    rows = df.where(F.col(ts).isNotNull()).withWatermark(ts, delay).select(
        F.col(key).cast("bigint").alias("key"), bucket(ts, width).alias("slice"), ts,
        F.unix_micros(ts).alias("at"), F.col("event_id").cast("bigint").alias("event_id"),
        *[(F.col(c) if c in df.columns else F.lit(None)).cast(kind).alias(c) for c, kind in kinds.items()],
    )
    summaries = stateful(rows, ["key", "slice"], Reduce(width, walk.KEEP), Reduce.OUTPUT)
    carries = stateful(summaries, ["key"], Carry(walk.KEEP), Carry.OUTPUT, time="None")
    as_rows = rows.select(
        "key", "slice", *KEPT, F.lit(None).cast("bigint").alias("n"), F.lit(None).cast("bigint").alias("total"),
        F.lit(None).cast(f"array<struct<{LAYOUT}>>").alias("last"),
    )
    as_carries = carries.select(
        "key", "slice", *[F.lit(None).cast(as_rows.schema[c].dataType).alias(c) for c in KEPT], "n", "total", "last"
    )
    return stateful(as_rows.unionByName(as_carries), ["key", "slice"], walk, walk.OUTPUT, time="None")
