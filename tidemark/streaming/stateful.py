"""Keyed state and timers with ``transformWithState``.

Rows of a key come in any order, within a micro-batch and across them. Processors whose
answer depends on the order build on :class:`Ordered`: rows wait in state, in pages of
event time, until the watermark has passed the page, and are then handed over in order. So
the answer never depends on how files were grouped into batches, and what a key holds is
bounded by the watermark delay. What a processor knows of a key is read once before it is
handed rows and written once after them. Times are epoch microseconds, timers milliseconds.
"""

from __future__ import annotations

from collections import deque, namedtuple
from collections.abc import Iterator
from heapq import merge

from pyspark.sql import DataFrame, Row, functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from tidemark.functions.durations import micros
from tidemark.operators.patterns import ANY, LATER, Step


def stateful(
    df: DataFrame, keys: list[str], processor: StatefulProcessor, output: str, time: str = "EventTime"
) -> DataFrame:
    """``EventTime`` needs a watermark on ``df`` and drops rows behind it."""
    return df.groupBy(*keys).transformWithState(
        statefulProcessor=processor,
        outputStructType=output,
        outputMode="append",
        timeMode=time,
    )


def _field(state: tuple | None):
    """The single field of a state tuple, None where nothing is stored."""
    return None if state is None else state[0]


def timer_after(at: int, wait: int = 0) -> int:
    """First whole millisecond not before ``at + wait``."""
    return -(-(at + wait) // 1000)


class Ordered(StatefulProcessor):
    """Hands the rows of a key over in event-time order once the watermark passed them.

    Rows wait in pages of event time. A micro-batch appends what it brings for a page as one
    chunk and reads nothing that is there already; a page is read once, when the watermark
    has passed its end, chunk by chunk. So a row costs the same however many micro-batches
    fill its page. A page is an hour, or as long as what the processor waits for if that is
    less, and results are no later than a page.

    ``KEPT`` names the columns of a row that are kept, ``at`` first and then the tie-breaker.
    Subclasses open their state in ``open``, take it out in ``load`` and put it back in
    ``save``, handle a row in ``step``, and whatever a time alone decides in ``settle``;
    ``due`` tells when that is next.
    """

    KEPT = "at bigint, event_id bigint"
    PAGE = micros("1 hour")

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        fields = [f.split() for f in self.KEPT.split(", ")]
        self.row = namedtuple("Kept", [name for name, _ in fields])
        layout = ", ".join(f"{name}: {kind}" for name, kind in fields)
        self.chunks = handle.getMapState("chunks", "page bigint, nth int", f"rows array<struct<{layout}>>")
        self.pages = handle.getMapState("pages", "page bigint", "chunks int")
        self.wake = handle.getValueState("wake", "at bigint")
        self.open(handle)

    def open(self, handle: StatefulProcessorHandle) -> None:
        pass

    def load(self) -> None:
        pass

    def save(self) -> None:
        pass

    def step(self, key, row) -> Iterator[Row]:
        return iter(())

    def settle(self, key, now: int) -> Iterator[Row]:
        return iter(())

    def due(self) -> int | None:
        return None

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        found: dict[int, list[tuple]] = {}
        for row in rows:
            found.setdefault(row.at // self.PAGE, []).append(tuple(row[f] for f in self.row._fields))
        for page, new in found.items():
            chunks = _field(self.pages.getValue((page,))) or 0
            self.chunks.updateValue((page, chunks), (sorted(new, key=lambda r: r[:2]),))
            self.pages.updateValue((page,), (chunks + 1,))
        if found:
            self._wake_by((min(found) + 1) * self.PAGE)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        now = timerValues.getCurrentWatermarkInMs() * 1000
        self.wake.clear()
        # What is due is settled up to the first page that may still get rows.
        passed, later = now, None
        self.load()
        for (page,) in sorted(self.pages.keys()):
            if (page + 1) * self.PAGE > now:
                passed, later = min(now, page * self.PAGE), (page + 1) * self.PAGE
                break
            for row in self._read(page):
                yield from self.step(key, row)
        yield from self.settle(key, passed)
        self.save()
        due = self.due()
        if due is not None and due <= now:
            due = later
        times = [t for t in (later, due) if t is not None]
        if times:
            self._wake_by(min(times))

    def _read(self, page: int) -> Iterator[tuple]:
        """The rows of a page in order; it is forgotten."""
        chunks = []
        for nth in range(_field(self.pages.getValue((page,)))):
            chunks.append([self.row(*r) for r in _field(self.chunks.getValue((page, nth)))])
            self.chunks.removeKey((page, nth))
        self.pages.removeKey((page,))
        return merge(*chunks, key=lambda r: r[:2])

    def _wake_by(self, at: int) -> None:
        known = _field(self.wake.get())
        if known is not None and known <= at:
            return
        if known is not None:
            self.handle.deleteTimer(timer_after(known))
        self.wake.update((at,))
        self.handle.registerTimer(timer_after(at))

    def close(self) -> None:
        pass


class History(Ordered):
    """Value, list and map state side by side.

    Per row: the previous value, the sum of the last ``span`` values and how often the
    row's label occurred so far.
    """

    KEPT = "at bigint, event_id bigint, vc int, label string"
    OUTPUT = "id bigint, event_id bigint, previous_vc int, recent bigint, same_label bigint"

    def __init__(self, span: int = 3):
        self.span = span

    def open(self, handle: StatefulProcessorHandle) -> None:
        self.previous = handle.getValueState("previous", "vc int")
        self.recent = handle.getListState("recent", "vc int")
        self.labels = handle.getMapState("labels", "label string", "seen bigint")

    def load(self) -> None:
        self.last, self.seen = _field(self.previous.get()), {}
        self.window = [v[0] for v in self.recent.get()]

    def step(self, key, row) -> Iterator[Row]:
        self.window = [*self.window, row.vc][-self.span:]
        if row.label not in self.seen:
            self.seen[row.label] = _field(self.labels.getValue((row.label,))) or 0
        self.seen[row.label] += 1
        yield Row(
            id=key[0], event_id=row.event_id, previous_vc=self.last,
            recent=sum(self.window), same_label=self.seen[row.label],
        )
        self.last = row.vc

    def save(self) -> None:
        if self.seen:
            for label, seen in self.seen.items():
                self.labels.updateValue((label,), (seen,))
            self.previous.update((self.last,))
            self.recent.put([(v,) for v in self.window])


class OneShot(Ordered):
    """One timer per key, ``wait`` after the key's first row."""

    OUTPUT = "id bigint, fired_at bigint"

    def __init__(self, wait: str = "5 seconds"):
        self.wait = micros(wait)
        self.PAGE = min(self.PAGE, self.wait)

    def open(self, handle: StatefulProcessorHandle) -> None:
        self.fires = handle.getValueState("fires", "at bigint, done boolean")

    def load(self) -> None:
        self.at, self.done = self.fires.get() or (None, False)

    def save(self) -> None:
        self.fires.update((self.at, self.done))

    def step(self, key, row) -> Iterator[Row]:
        if self.at is None:
            self.at = row.at + self.wait
        return iter(())

    def settle(self, key, now: int) -> Iterator[Row]:
        at = self.due()
        if at is not None and at <= now:
            self.done = True
            yield Row(id=key[0], fired_at=at)

    def due(self) -> int | None:
        return None if self.done else self.at


class Visitors(Ordered):
    """Different visitors of a window so far, after each of its rows; the key is the window's start.

    Visitors seen are map state, looked up once a visitor and timer; all of it is dropped
    when the watermark has passed the window.
    """

    KEPT = "at bigint, event_id bigint, user_id bigint"
    OUTPUT = "window_start bigint, event_id bigint, uv bigint"

    def __init__(self, size: str = "1 day"):
        self.size = micros(size)

    def open(self, handle: StatefulProcessorHandle) -> None:
        self.seen = handle.getMapState("seen", "user_id bigint", "first bigint")
        self.count = handle.getValueState("count", "uv bigint, until bigint")

    def load(self) -> None:
        self.uv, self.until = self.count.get() or (0, None)
        self.known, self.new = {}, []

    def step(self, key, row) -> Iterator[Row]:
        self.until = key[0] + self.size
        user = row.user_id
        if user is not None and user not in self.known:
            self.known[user] = self.seen.containsKey((user,))
            if not self.known[user]:
                self.uv += 1
                self.new.append((user, row.at))
        yield Row(window_start=key[0], event_id=row.event_id, uv=self.uv)

    def settle(self, key, now: int) -> Iterator[Row]:
        if self.until is not None and self.until <= now:
            self.until = None
        return iter(())

    def save(self) -> None:
        if self.until is None:
            self.seen.clear()
            self.count.clear()
            return
        for user, at in self.new:
            self.seen.updateValue((user,), (at,))
        self.count.update((self.uv, self.until))

    def due(self) -> int | None:
        return self.until


class Rising(Ordered):
    """Alarm when a level keeps rising for ``hold``; see ``plans.sensors.rising_alarms``."""

    KEPT = "at bigint, event_id bigint, vc int"
    OUTPUT = "id bigint, armed_at bigint, alarm_at bigint"

    def __init__(self, hold: str = "5 seconds"):
        self.hold = micros(hold)
        self.PAGE = min(self.PAGE, self.hold)

    def open(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("state", "level int, armed bigint")

    def load(self) -> None:
        self.level, self.armed = self.state.get() or (0, None)

    def save(self) -> None:
        self.state.update((self.level, self.armed))

    def step(self, key, row) -> Iterator[Row]:
        yield from self.settle(key, row.at - 1)
        if row.vc <= self.level:
            self.armed = None
        elif self.armed is None:
            self.armed = row.at
        self.level = row.vc

    def settle(self, key, now: int) -> Iterator[Row]:
        at = self.due()
        if at is not None and at <= now:
            yield Row(id=key[0], armed_at=self.armed, alarm_at=at)
            self.armed = None

    def due(self) -> int | None:
        return None if self.armed is None else self.armed + self.hold


class ClickLimit(Ordered):
    """Pass the first ``limit`` clicks of a (user, ad) per UTC day, alarm once beyond.

    Counters are kept per day and dropped once the watermark leaves the day.
    """

    OUTPUT = "kind string, user_id bigint, ad_id int, event_id bigint, at bigint"
    DAY = micros("1 day")

    def __init__(self, limit: int = 100):
        self.limit = limit

    def open(self, handle: StatefulProcessorHandle) -> None:
        self.counts = handle.getMapState("counts", "day bigint", "clicks bigint")

    def load(self) -> None:
        self.known = {day: clicks[0] for (day,), clicks in self.counts.iterator()}
        self.days = dict(self.known)

    def save(self) -> None:
        for day in self.known.keys() - self.days.keys():
            self.counts.removeKey((day,))
        for day, clicks in self.days.items():
            if self.known.get(day) != clicks:
                self.counts.updateValue((day,), (clicks,))

    def step(self, key, row) -> Iterator[Row]:
        day = row.at // self.DAY
        self.days[day] = clicks = self.days.get(day, 0) + 1
        if clicks <= self.limit + 1:
            yield Row(
                kind="pass" if clicks <= self.limit else "alarm",
                user_id=key[0], ad_id=key[1], event_id=row.event_id, at=row.at,
            )

    def settle(self, key, now: int) -> Iterator[Row]:
        self.days = {day: clicks for day, clicks in self.days.items() if (day + 1) * self.DAY > now}
        return iter(())

    def due(self) -> int | None:
        return min(((day + 1) * self.DAY for day in self.days), default=None)


class Payment(StatefulProcessor):
    """Payment status of an order, emitted whenever it changes; the last one counts.

    Keeps the earliest create and pay. With only one of them a timer reports the other
    as missing ``limit`` later; a pay that still comes then corrects the status. An order
    is forgotten ``keep`` after the events it is judged by, whether it has both or lacks one:
    ``keep`` is to be longer than orders have events, as what comes later is taken for an
    order of its own.
    """

    OUTPUT = "order_id bigint, status string, version int"

    def __init__(self, limit: str = "15 minutes", keep: str = "365 days"):
        self.limit, self.keep = micros(limit), micros(keep)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.seen = handle.getValueState(
            "seen", "created bigint, paid bigint, status string, version int"
        )

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        known = self.seen.get()
        created, paid, status, version = known or (None, None, None, 0)
        for row in rows:
            if row.event_type == "create":
                created = row.at if created is None else min(created, row.at)
            else:
                paid = row.at if paid is None else min(paid, row.at)
        both = created is not None and paid is not None
        if known is None:
            first = min(t for t in (created, paid) if t is not None)
            self.handle.registerTimer(timer_after(first, self.limit))
        now = status
        if both:
            now = "paid_late" if paid - created > self.limit else "paid"
        if now != status:
            version += 1
            yield Row(order_id=key[0], status=now, version=version)
        self.seen.update((created, paid, now, version))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        known = self.seen.get()
        if known is None:
            return
        created, paid, status, version = known
        if status is None:
            status = "unpaid" if paid is None else "missing_create"
            self.seen.update((created, paid, status, version + 1))
            yield Row(order_id=key[0], status=status, version=version + 1)
        forgets = timer_after(max(t for t in (created, paid) if t is not None), self.keep)
        if forgets <= timerValues.getCurrentWatermarkInMs():
            self.seen.clear()
        else:
            self.handle.registerTimer(forgets)

    def close(self) -> None:
        pass


class Matcher(Ordered):
    """One-to-one match of two sides of a key; whichever comes first waits.

    Only one side can be waiting at a time; its rows are a queue in map state.
    Rows carry ``at``, ``row_id`` and ``side`` ("left" / "right").
    """

    KEPT = "at bigint, row_id bigint, side string"
    PAGE = micros("30 days")
    OUTPUT = "tx_id bigint, left_id bigint, right_id bigint"

    def open(self, handle: StatefulProcessorHandle) -> None:
        self.ends = handle.getValueState("ends", "side string, head bigint, tail bigint")
        self.queue = handle.getMapState("queue", "place bigint", "row_id bigint")

    def load(self) -> None:
        self.side, self.head, self.tail = self.ends.get() or (None, 0, 0)

    def save(self) -> None:
        self.ends.update((self.side, self.head, self.tail))

    def step(self, key, row) -> Iterator[Row]:
        if self.side == row.side or self.head == self.tail:
            self.queue.updateValue((self.tail,), (row.row_id,))
            self.side, self.tail = row.side, self.tail + 1
            return
        side = self.side
        waited = _field(self.queue.getValue((self.head,)))
        self.queue.removeKey((self.head,))
        self.head += 1
        left, right = (waited, row.row_id) if side == "left" else (row.row_id, waited)
        yield Row(tx_id=key[0], left_id=left, right_id=right)


class FollowedBy(Ordered):
    """``first`` then the next ``second`` row of the key, strictly within ``within``.

    Rows carry ``step`` ("first", "second" or "both"). Starts that see no second row in
    time come out as ``timeout``. With ``every`` a start meets all second rows in time,
    not only the next one, and there are no timeouts.
    """

    KEPT = "at bigint, event_id bigint, step string"
    OUTPUT = "kind string, key bigint, first_id bigint, second_id bigint"

    def __init__(self, within: str, every: bool = False):
        self.within, self.every = micros(within), every
        self.PAGE = min(self.PAGE, self.within)

    def open(self, handle: StatefulProcessorHandle) -> None:
        self.pending = handle.getListState("pending", "at bigint, event_id bigint")

    def load(self) -> None:
        self.known = [tuple(p) for p in self.pending.get()]
        self.open_starts = deque(self.known)

    def save(self) -> None:
        now = list(self.open_starts)
        if now and now != self.known:
            self.pending.put(now)
        elif self.known and not now:
            self.pending.clear()

    def step(self, key, row) -> Iterator[Row]:
        yield from self.settle(key, row.at)
        if row.step != "first":
            for _, event_id in self.open_starts:
                yield Row(kind="match", key=key[0], first_id=event_id, second_id=row.event_id)
            if not self.every:
                self.open_starts.clear()
        if row.step != "second":
            self.open_starts.append((row.at, row.event_id))

    def settle(self, key, now: int) -> Iterator[Row]:
        """Starts, oldest first, that nothing from ``now`` on can be in time for."""
        while self.open_starts and self.open_starts[0][0] + self.within <= now:
            _, event_id = self.open_starts.popleft()
            if not self.every:
                yield Row(kind="timeout", key=key[0], first_id=event_id, second_id=None)

    def due(self) -> int | None:
        return self.open_starts[0][0] + self.within if self.open_starts else None


class Automaton(Ordered):
    """Patterns of any number of steps whose conditions may read the rows matched so far.

    ``steps`` as in ``operators.patterns.matched``. A match so far is a version of its own:
    it holds its rows, moves on when a row meets its next step, and with ``ANY`` stays for
    others too. What the bound has passed is dropped. Rows carry ``vc``.
    """

    KEPT = "at bigint, event_id bigint, vc int"
    OUTPUT = "key bigint, events array<bigint>"

    def __init__(self, steps: list[Step], within: str):
        self.steps, self.within = steps, micros(within)
        self.PAGE = min(self.PAGE, self.within)

    def open(self, handle: StatefulProcessorHandle) -> None:
        self.versions = handle.getListState("versions", "rows array<struct<at: bigint, event_id: bigint, vc: int>>")

    def load(self) -> None:
        self.known = [tuple(self.row(*r) for r in version[0]) for version in self.versions.get()]
        self.paths = list(self.known)

    def save(self) -> None:
        if self.paths and self.paths != self.known:
            self.versions.put([([tuple(r) for r in path],) for path in self.paths])
        elif self.known and not self.paths:
            self.versions.clear()

    def step(self, key, row) -> Iterator[Row]:
        held = []
        for path in self.paths:
            if row.at - path[0].at >= self.within:
                continue
            step = self.steps[len(path)]
            meets = self._meets(step, row, path)
            if meets:
                yield from self._grown((*path, row), key, held)
            if step.follows == ANY or (step.follows == LATER and not meets):
                held.append(path)
        if self._meets(self.steps[0], row, ()):
            yield from self._grown((row,), key, held)
        self.paths = held

    def _grown(self, path: tuple, key, held: list) -> Iterator[Row]:
        if len(path) == len(self.steps):
            yield Row(key=key[0], events=[r.event_id for r in path])
        else:
            held.append(path)

    def _meets(self, step: Step, row, path: tuple) -> bool:
        seen = {s.name: r._asdict() for s, r in zip(self.steps, path)}
        try:
            return bool(step.condition(row._asdict(), seen))
        except TypeError:  # a comparison with a missing value
            return False

    def settle(self, key, now: int) -> Iterator[Row]:
        self.paths = [path for path in self.paths if path[0].at + self.within > now]
        return iter(())
