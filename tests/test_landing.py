"""Tables landed in order of time, and what streams over them hold."""

import random

import pytest
from pyspark.sql import functions as F

from tests.conftest import as_frame, by_key
from tidemark.functions.durations import epoch_micros
from tidemark.operators import patterns, windows
from tidemark.operators.running import by_time
from tidemark.session import fresh_path
from tidemark.sources import landing
from tidemark.sources.landing import SLICE, TIMELESS, land
from tidemark.streaming.drain import LateRowsDropped, Progress, drain, drain_updates
from tidemark.streaming.sliced import Changelog, Moving, StrictNext, sliced
from tidemark.streaming.stateful import Automaton, Ordered, stateful

HOUR = 3600
FAR = 4_000_000_000


def events(span_hours, per_hour=12, keys=5, seed=1, hot=0.4):
    """(k, s, v, event_id) rows in shuffled order; key 0 has a share of ``hot``."""
    rng = random.Random(seed)
    rows = []
    for event_id in range(span_hours * per_hour):
        key = 0 if rng.random() < hot else rng.randrange(1, keys)
        rows.append((key, 1_600_000_000 + rng.randrange(span_hours * HOUR), rng.randrange(100), event_id))
    rng.shuffle(rows)
    return rows


def frame(spark, rows, files=6):
    return as_frame(spark, rows).repartition(files, F.xxhash64("event_id"))


def files_in_order(spark, landed):
    """Slices in the order in which a file stream reads them."""
    found = landing._files(spark, landed.path)
    system, of = landing._file_system(spark, landed.path)
    return [n for _, n in sorted((system.getFileStatus(of(f)).getModificationTime(), n) for n, f in found)]


def test_files_are_as_old_as_their_slice_is_early(spark):
    rows = events(48)
    df = frame(spark, rows).withColumn("ts", F.when(F.col("event_id") != 7, F.col("ts")))
    landed = land(df, "ts", "6 hours", rows_per_file=20)
    order = files_in_order(spark, landed)
    assert order == sorted(order) and order[0] == TIMELESS
    assert len(set(order)) == landed.slices and landed.most_files > 1
    back = spark.read.schema(landed.schema).option("recursiveFileLookup", "true").parquet(landed.path)
    assert sorted(map(tuple, back.collect()), key=lambda r: r[3]) == sorted(map(tuple, df.collect()), key=lambda r: r[3])


def test_slices_are_appended_where_file_times_do_not_stay(spark, monkeypatch):
    monkeypatch.setattr(landing, "_date", lambda *_: False)
    landed = land(frame(spark, events(24)), "ts", "6 hours")
    assert SLICE not in landed.path and "landed" in landed.path
    counts = windows.tumbling(landed.stream(spark).withWatermark("ts", "6 hours"), ["k"], "ts", "1 hour", n=windows.count_of())
    progress = Progress()
    drain(counts, "appended", progress=progress)
    assert progress.batches >= 4 and progress.dropped == 0


def test_state_does_not_grow_with_the_time_that_a_table_spans(spark):
    most = []
    for span in (60, 120, 240):
        landed = land(frame(spark, events(span)), "ts", "6 hours")
        rows = landed.stream(spark).withWatermark("ts", "6 hours")
        progress = Progress()
        got = drain(windows.tumbling(rows, ["k"], "ts", "1 hour", n=windows.count_of()), "span", progress=progress)
        # All windows but those of the last two slices have come out before the end.
        closed = got.agg(F.max("window_end")).first()[0].timestamp() - 1_600_000_000
        assert closed >= (span - 14) * HOUR
        assert progress.batches >= span // 6
        most.append(progress.most_state_rows)
    assert max(most) <= 1.2 * min(most), most
    whole = land(frame(spark, events(240)), "ts", "6 hours").stream(spark, slices_per_batch=1000)
    progress = Progress()
    drain(windows.tumbling(whole.withWatermark("ts", "6 hours"), ["k"], "ts", "1 hour", n=windows.count_of()), "whole", progress=progress)
    assert progress.most_state_rows > 3 * max(most)


def test_files_out_of_order_lose_rows_loudly(spark):
    path = fresh_path(spark, "disorder")
    df = frame(spark, events(72)).select("k", "s", "v", "event_id", "ts")
    # A batch is held against the watermark of the batch before the last.
    for low, high in ((48, 72), (24, 48), (0, 24)):
        part = df.where(F.col("s").between(1_600_000_000 + low * HOUR, 1_600_000_000 + high * HOUR - 1)).coalesce(1)
        part.write.mode("append").parquet(path)
    stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(path).withWatermark("ts", "1 hour")
    with pytest.raises(LateRowsDropped):
        drain(windows.tumbling(stream, ["k"], "ts", "1 hour", n=windows.count_of()), "disorder")


def ended(spark, rows, width="6 hours"):
    """The rows as a stream in order, with a far row of no key that lets everything out."""
    far = [(None, FAR, 0, 10**9)]
    return land(frame(spark, rows + far), "ts", width).stream(spark)


def test_moving_results_of_a_hot_key(spark):
    rows = events(48, hot=0.6)
    want = []
    for key, own in by_key(rows).items():
        for n, row in enumerate(own, 1):
            last = [r[2] for r in own[max(0, n - 3):n]]
            want.append((key, row[3], n, len(last), sum(last)))
    for width in ("1 hour", "2 days"):
        for slide in (1, 2):
            stream = ended(spark, rows).withColumn("vc", F.col("v"))
            got = drain(sliced(stream, "k", "ts", width, "6 hours", Moving(3, slide)), "moving")
            assert sorted(map(tuple, got.collect())) == sorted(w for w in want if w[2] % slide == 0)


def test_changelog_of_a_hot_key(spark):
    rows = events(30, hot=0.6)
    want = []
    for key, own in by_key(rows).items():
        total = 0
        for n, row in enumerate(own):
            if n:
                want.append((key, row[3], False, total))
            total += row[2]
            want.append((key, row[3], True, total))
    stream = ended(spark, rows).withColumn("vc", F.col("v"))
    got = drain(sliced(stream, "k", "ts", "1 hour", "6 hours", Changelog()), "changelog")
    assert sorted(map(tuple, got.collect())) == sorted(want)


@pytest.mark.parametrize("within", [None, "20 minutes"])
def test_strict_next_over_the_edges_of_slices(spark, within):
    rows = events(30, hot=0.6)
    limit = None if within is None else 20 * 60
    want = [
        (key, a[3], b[3])
        for key, own in by_key(rows).items() for a, b in zip(own, own[1:])
        if a[2] < 50 <= b[2] and (limit is None or b[1] - a[1] < limit)
    ]
    stream = ended(spark, rows).withColumns({"first": F.col("v") < 50, "second": F.col("v") >= 50})
    got = drain(sliced(stream, "k", "ts", "30 minutes", "6 hours", StrictNext(within)), "strict")
    assert sorted(map(tuple, got.collect())) == sorted(want)


def test_a_hot_key_is_spread_over_the_state(spark):
    """Two thirds of the rows have one key; nothing closes, so all rows are held in state."""
    rows = events(200, per_hour=10, keys=400, hot=0.67)
    session = spark.newSession()
    session.conf.set("spark.sql.shuffle.partitions", "8")
    session.conf.set("spark.sql.streaming.stateStore.providerClass", spark.conf.get("spark.sql.streaming.stateStore.providerClass"))
    stream = land(frame(spark, rows), "ts", "1000 days").stream(session).withColumn("vc", F.col("v"))
    state = fresh_path(spark, "hot-state")
    drain(sliced(stream, "k", "ts", "1 hour", "1000 days", Moving(3)), "hot", checkpoint=state)
    shares = []
    for operator in range(3):
        reader = session.read.format("statestore").option("operatorId", operator)
        try:
            held = reader.option("stateVarName", "rows").option("flattenCollectionTypes", "true").load(state)
            shares = [r["count"] for r in held.groupBy("partition_id").count().collect()]
            break
        except Exception as error:  # another stage: it has no such variable
            assert "rows" in str(error) or "STATE" in str(error).upper()
    assert sum(shares) == len(rows)
    assert max(shares) <= 0.25 * len(rows), shares


class Handle:
    """State of one key in memory that counts the rows read and written."""

    def __init__(self):
        self.moved, self.calls, self.timers = 0, 0, set()

    def getMapState(self, name, key, value):
        return Held(self)

    getListState = getValueState = lambda self, name, layout: Held(self)

    def registerTimer(self, at):
        self.timers.add(at)

    def deleteTimer(self, at):
        self.timers.discard(at)


class Held:
    def __init__(self, handle):
        self.handle, self.values, self.value = handle, {}, None

    def _count(self, value):
        self.handle.calls += 1
        self.handle.moved += sum(len(v) for v in value or () if isinstance(v, list))
        return value

    def getValue(self, key):
        return self._count(self.values.get(key))

    def updateValue(self, key, value):
        self.values[key] = self._count(value)

    def removeKey(self, key):
        del self.values[key]

    def keys(self):
        return list(self.values)

    def get(self):
        return self._count(self.value)

    def update(self, value):
        self.value = self._count(value)

    def clear(self):
        self.value = None


class Clock:
    def __init__(self, at):
        self.at = at

    def getCurrentWatermarkInMs(self):
        return self.at // 1000


class Seen(Ordered):
    def step(self, key, row):
        yield row


def test_a_row_costs_the_same_however_many_batches_fill_its_page():
    from pyspark.sql import Row

    moved = {}
    for batches in (10, 100, 1000):
        handle, buffer = Handle(), Seen()
        buffer.init(handle)
        rng = random.Random(batches)
        rows = [Row(at=rng.randrange(buffer.PAGE), event_id=i) for i in range(3000)]
        for i in range(batches):
            assert list(buffer.handleInputRows((1,), iter(rows[i::batches]), None)) == []
        assert handle.timers == {buffer.PAGE // 1000}
        out = list(buffer.handleExpiredTimer((1,), Clock(buffer.PAGE), None))
        assert [(r.at, r.event_id) for r in out] == sorted((r.at, r.event_id) for r in rows)
        assert not buffer.chunks.values and not buffer.pages.values
        moved[batches] = handle.moved
        assert handle.calls <= 10 * batches + 10
    assert set(moved.values()) == {6000}  # each row is written once and read once


STEPS = [
    patterns.Step("a", lambda row, seen: row["v"] >= 60),
    patterns.Step("b", lambda row, seen: row["v"] < 40),
    patterns.Step("c", lambda row, seen: (row["v"] > seen["a"]["v"]) & (row["v"] > 2 * seen["b"]["v"])),
]


def walked_by_hand(own, steps, within):
    """All matches of one key by trying every version so far with every row."""
    versions, found = [], []
    for row in own:
        as_dict = {"v": row[2], "vc": row[2]}
        kept = []
        for path in versions:
            if row[1] - path[0][1] >= within:
                continue
            step = steps[len(path)]
            names = {s.name: {"v": r[2], "vc": r[2]} for s, r in zip(steps, path)}
            meets = step.condition(as_dict, names)
            if meets:
                (found if len(path) + 1 == len(steps) else kept).append([*path, row])
            if step.follows == patterns.ANY or (step.follows == patterns.LATER and not meets):
                kept.append(path)
        if steps[0].condition(as_dict, {}):
            kept.append([row])
        versions = kept
    return [tuple(r[3] for r in path) for path in found]


@pytest.mark.parametrize("follows", [
    (patterns.LATER, patterns.LATER), (patterns.ANY, patterns.LATER), (patterns.LATER, patterns.ANY),
    (patterns.NEXT, patterns.LATER), (patterns.NEXT, patterns.NEXT), (patterns.ANY, patterns.ANY),
])
def test_steps_that_read_earlier_rows(spark, follows):
    """Ties in time, overlapping matches and branches against trying everything."""
    rng = random.Random(6)
    rows = [(rng.choice([0, 0, 1, 2]), 1_600_000_000 + rng.randrange(900), rng.randrange(100), i) for i in range(300)]
    steps = [STEPS[0], *[patterns.Step(s.name, s.condition, f) for s, f in zip(STEPS[1:], follows)]]
    want = sorted(m for own in by_key(rows).values() for m in walked_by_hand(own, steps, 60))
    assert want
    found = patterns.matched(frame(spark, rows), ["k"], by_time("ts", "event_id"), steps, "60 seconds")
    got = found.select(*[F.col(s.name)["event_id"] for s in steps]).collect()
    assert sorted(map(tuple, got)) == want


def test_steps_on_a_stream(spark):
    rng = random.Random(7)
    rows = [(rng.choice([0, 0, 1, 2]), 1_600_000_000 + rng.randrange(9000), rng.randrange(100), i) for i in range(300)]
    steps = [
        patterns.Step("a", lambda row, seen: row["vc"] >= 60),
        patterns.Step("b", lambda row, seen: row["vc"] < 40, patterns.ANY),
        patterns.Step("c", lambda row, seen: (row["vc"] > seen["a"]["vc"]) & (row["vc"] > 2 * seen["b"]["vc"])),
    ]
    want = sorted(m for own in by_key(rows).values() for m in walked_by_hand(own, steps, 600))
    stream = ended(spark, rows, "1 hour").withColumns({"at": epoch_micros("ts"), "vc": F.col("v")}).withWatermark("ts", "1 hour")
    got = drain(stateful(stream, ["k"], Automaton(steps, "600 seconds"), Automaton.OUTPUT), "automaton")
    assert sorted(tuple(r.events) for r in got.collect()) == want
