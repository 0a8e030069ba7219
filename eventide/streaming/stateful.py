"""Keyed state machines on streams (V1-V5) with ``transformWithState``.

These are the exact, per-row stream forms of operators whose batch forms live in
:mod:`eventide.operators`.  They work in event time: rows of a key wait in state
until the watermark has passed them and are then processed in ``(ts, id)`` order,
with deadlines (timeouts) between them.  Results therefore depend neither on the
order of arrival (within the watermark delay) nor on micro-batch borders.

A Spark key is a bucket of keys, by a hash: rows, timers and state are handled per
bucket and micro-batch, not per row, as each access to state is a call out of the
Python worker.  Rows cross the border to Python in packs, as each one that crosses it alone
costs more than all that is done with it: the tasks that read a micro-batch pack the rows of a
bucket into one (:func:`_packed`), a firing hands its rows back as columns.  A pack stands at
its latest time; rows of a slot that a bucket has gone through are late and dropped.
Rows wait in map state in pieces of bounded size, cut in order of time;
an index has the first slot (of ``slot_us``) of each piece.  One timer stands at the
end of the earliest slot or deadline.  A firing goes through all slots that the watermark
has passed, in order; it reads the pieces as their slots come up, removes them, and puts
back what is not due.  A hot key thus costs a firing the rows of a slot and of
the pieces open there, whatever else waits.

The states of a bucket's keys are read and written together, in entries of bounded size.
What stays open after a firing (rows that wait for a partner) is a queue per key, of which
the ends are among these states and all between is in pages of its own, untouched.
Deadlines are met at the end of the slot they fall in, where the rows before them are known.

Buckets are spread by Spark's shuffle.  Times in state are epoch microseconds, timers
epoch milliseconds.  A null key is a key of its own.
"""

from __future__ import annotations

import heapq
import pickle
import sys
from collections import deque
from collections.abc import Iterable, Iterator
from itertools import islice
from operator import attrgetter, itemgetter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..operators import windows as W
from ..operators.patterns import StateMachine
from ..session import num_partitions


# Functions and classes of this module run in Python workers (and in the
# driver-side runner that initialises stateful processors); ship them by value
# so those processes need not import this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])



def _us(col: str):
    return F.unix_micros(F.col(col))


def _stateful(stream: DataFrame, et: str, delay, processor, out: str) -> DataFrame:
    """``stream`` comes from :func:`_source`; the processor travels by value (see above)."""
    return _stepped(_packed(stream, et, processor).withWatermark("et", W.duration(delay or 0)), processor, out)


def _stepped(packs: DataFrame, processor, out: str) -> DataFrame:
    """The output rows of ``processor`` over ``packs``, which have their watermark."""
    found = packs.groupBy("key").transformWithState(PackedProcessor(processor), _arrays(out), "Append", "EventTime")
    return found.select(F.inline(F.arrays_zip(*found.columns)))


def _packed(stream: DataFrame, et: str, processor) -> DataFrame:
    """``key``, ``rows`` (of a bucket, as :meth:`EventTimeProcessor._read` takes them) and
    ``et``, the latest event time among them.  A task packs up to ``PACK_ROWS`` rows at a time."""
    names = [*[name for name, _ in _fields(processor.fields)], "of"]

    def packs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            held.append(batch)
            n += batch.num_rows
            if n >= PACK_ROWS:
                yield _pack(pa.Table.from_batches(held), names, et)
                held, n = [], 0
        if n:
            yield _pack(pa.Table.from_batches(held), names, et)
    return stream.mapInArrow(packs, "key long, rows binary, et timestamp")


def _pack(rows: pa.Table, names: list[str], et: str) -> pa.RecordBatch:
    rows = rows.take(pc.sort_indices(rows, sort_keys=[("key", "ascending"), (et, "ascending")]))
    keys = rows["key"].to_numpy()
    ends = [*(np.flatnonzero(keys[1:] != keys[:-1]) + 1).tolist(), len(keys)]
    columns = [rows[name].to_pylist() for name in names]
    packs, start = [], 0
    for end in ends:
        packs.append(pickle.dumps([c[start:end] for c in columns], pickle.HIGHEST_PROTOCOL))
        start = end
    last = pa.array([end - 1 for end in ends])
    return pa.RecordBatch.from_arrays([rows["key"].take(last).combine_chunks(), pa.array(packs, pa.binary()),
                                       rows[et].take(last).combine_chunks()], names=["key", "rows", "et"])


def _source(stream: DataFrame, key: str, id_col: str, et: str, *cols, buckets: int | None = None) -> DataFrame:
    """``key`` (the bucket), ``of`` (the key itself), ``id``, ``ts``, ``cols`` and the event-time column."""
    return stream.select(F.pmod(F.xxhash64(key), F.lit(buckets or BUCKETS)).alias("key"), F.col(key).alias("of"),
                         F.col(id_col).alias("id"), _us(et).alias("ts"), *cols, F.col(et))


def buckets_for(spark: SparkSession) -> int:
    """Buckets enough for an even spread over the state partitions, each costing its calls to
    state.  They stay for the life of a checkpoint, as its partitions do."""
    return 8 * num_partitions(spark)


def _micros(d) -> int:
    return int(round(W.seconds(d) * 1_000_000))


#: Width of a slot, rows of one state entry, rows of a page of a queue, rows put in order at once,
#: rows that a task packs at once, rows handed back at once, and buckets.  Each state entry is a call
#: out of the Python worker, which costs more than reading a few hundred rows.
SLOT_US = 60_000_000
PIECE_ROWS = 2_000
PAGE_ROWS = 500
SORT_ROWS = 20_000
PACK_ROWS = 100_000
OUT_ROWS = 5_000
BUCKETS = 1024


def _fields(schema: str) -> list[tuple[str, str]]:
    return [tuple(f.split()) for f in schema.split(", ")] if schema else []


def _arrays(schema: str) -> str:
    """The schema of a state entry that holds many rows: an array per column."""
    return ", ".join(f"{name} array<{kind}>" for name, kind in _fields(schema))


def _columns(rows: list) -> tuple:
    return tuple(list(c) for c in zip(*rows))


class EventTimeProcessor(StatefulProcessor):
    """Hands the rows of each key to :meth:`step` in ``(ts, id)`` order once the
    watermark has passed their slot.  ``fields`` is the schema of a waiting row,
    beginning with ``id long, ts long``; ``columns`` are the names of an output row.
    A key's state is a list of tuples with the schema ``item`` (none if empty), or what
    :meth:`unpack` makes of it.  ``timed`` says that states have deadlines.

    The key of a row is its column ``of``, or without one Spark's key."""

    fields = "id long, ts long"
    item = ""
    columns: list[str] = []
    slot_us = SLOT_US
    timed = False

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.pieces = handle.getValueState("pieces", "n array<long>, lo array<long>")
        self.passed = handle.getValueState("passed", "upto long")
        self.waiting = handle.getMapState("waiting", "n long", "rows binary")
        if self.item:
            self.values = handle.getMapState("values", "block int", _arrays(self.item + ", of long") + ", blocks int")
        if self.timed:
            self.runs_out = handle.getValueState("runs_out", "deadline long")
        self.output = Row(*self.columns)
        self.open_state(handle)

    # -- what a subclass defines ------------------------------------------------
    def open_state(self, handle) -> None:
        """Create state variables."""

    def load(self) -> None:
        """Read state of the bucket before a firing."""

    def store(self) -> None:
        """Write state of the bucket after a firing."""

    def begin(self, slot: int) -> None:
        """The rows of ``slot`` come next."""

    def unpack(self, of, items: list):
        """The state of a key (``items`` is empty for a new one)."""
        return items

    def pack(self, state) -> list:
        return state

    def step(self, of, state, row) -> Iterable[dict]:
        """Process the next row of key ``of``."""
        return ()

    def expire(self, of, state, upto_us: int) -> Iterable[dict]:
        """Deadlines at or before ``upto_us``."""
        return ()

    def deadline_us(self, state) -> int | None:
        """The earliest deadline in a state."""
        return None

    def order(self, row):
        return row[1], row[0] is not None, row[0] or 0

    # -- Spark's side -----------------------------------------------------------
    def _end_ms(self, slot: int) -> int:
        """The watermark that has passed all rows of a slot."""
        return -(-(slot + 1) * self.slot_us // 1000)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        pieces, some = self._index(), []
        first, passed = min((lo for _, lo in pieces), default=None), self.passed.get()
        for found in self._read(key, rows):
            some += found if passed is None else [r for r in found if r[1] >= passed[0]]
            if len(some) >= SORT_ROWS:
                self._wait(some, pieces)
                some = []
        self._wait(some, pieces)
        if pieces:
            self.pieces.update(_columns(pieces))
            earliest = min(lo for _, lo in pieces)
            if first is None or earliest < first:
                self.handle.registerTimer(self._end_ms(earliest))
        return iter(())

    def _read(self, key, rows) -> Iterator[list]:
        """Lists of waiting rows ``(id, ts, ..., of)`` out of packs or of plain rows."""
        names, rows = [name for name, _ in _fields(self.fields)], iter(rows)
        for r in rows:
            if isinstance(r, Row) and "rows" in r.__fields__:
                yield list(zip(*pickle.loads(r["rows"])))
                continue
            of = hasattr(r, "of")
            wanted = [*names, "of"] if of else names
            read = itemgetter(*map(r.__fields__.index, wanted)) if isinstance(r, Row) else attrgetter(*wanted)
            while r is not None:
                yield [read(x) if of else (*read(x), key[0]) for x in [r, *islice(rows, PIECE_ROWS - 1)]]
                r = next(rows, None)

    def _index(self) -> list:
        """``(number, first slot)`` of the pieces that wait."""
        had = self.pieces.get()
        return list(zip(*had)) if had else []

    def _wait(self, rows: list, pieces: list) -> None:
        rows.sort(key=itemgetter(1))
        n = 1 + max((n for n, _ in pieces), default=-1)
        for at in range(0, len(rows), PIECE_ROWS):
            piece = rows[at:at + PIECE_ROWS]
            self.waiting.updateValue((n,), (pickle.dumps(_columns(piece), pickle.HIGHEST_PROTOCOL),))
            pieces.append((n, piece[0][1] // self.slot_us))
            n += 1

    def _take(self, slot: int) -> list:
        """The rows of ``slot``, the earliest that waits, and of those after it that are due and
        read whole, as long as they are few."""
        while self.unread and self.unread[0][0] <= slot:
            n = heapq.heappop(self.unread)[1]
            for r in zip(*pickle.loads(self.waiting.getValue((n,))[0])):
                at = r[1] // self.slot_us
                if at not in self.read:
                    self.read[at] = []
                    heapq.heappush(self.slots, at)
                self.read[at].append(r)
            self.waiting.removeKey((n,))
        rows, whole = self.read.pop(slot, []), self.upto
        if self.unread:
            whole = min(whole, self.unread[0][0])
        while self.slots and (self.slots[0] <= slot or self.slots[0] < whole and len(rows) < PIECE_ROWS):
            rows += self.read.pop(heapq.heappop(self.slots), ())
        return sorted(rows, key=self.order)

    def _states(self) -> dict:
        items: dict = {}
        self.blocks = n = 0
        while self.item and (n == 0 or n < self.blocks):
            had = self.values.getValue((n,))
            if not had:
                break
            self.blocks = had[-1]
            for r in zip(*had[:-1]):
                items.setdefault(r[-1], []).append(r[:-1])
            n += 1
        return {of: self.unpack(of, some) for of, some in items.items()}

    def _put_states(self, states: dict) -> None:
        items = [(*i, of) for of, state in states.items() for i in self.pack(state)]
        blocks = -(-len(items) // PIECE_ROWS)
        for n in range(blocks):
            self.values.updateValue((n,), (*_columns(items[n * PIECE_ROWS:(n + 1) * PIECE_ROWS]), blocks))
        for n in range(blocks, self.blocks):
            self.values.removeKey((n,))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        # a timer set here for a time that has passed would not fire in this batch, so
        # the first firing of a batch does all that is due; others find nothing
        self.upto = upto = timerValues.getCurrentWatermarkInMs() * 1000 // self.slot_us
        pieces, deadline = self._index(), (self.runs_out.get() or (None,))[0] if self.timed else None
        due = [p for p in pieces if p[1] < upto]
        if not due and (deadline is None or deadline >= upto * self.slot_us):
            return
        self.load()
        states = self._states()
        self.unread, self.slots, self.read = [(lo, n) for n, lo in due], [], {}
        heapq.heapify(self.unread)
        while self.unread or self.slots:
            slot = min(heap[0] if heap is self.slots else heap[0][0] for heap in (self.unread, self.slots) if heap)
            if slot >= upto:
                break
            rows, begun = self._take(slot), None
            for r in rows:
                of, at = r[-1], r[1] // self.slot_us
                if at != begun:
                    self.begin(begun := at)
                if of not in states:
                    states[of] = self.unpack(of, [])
                state = states[of]
                if self.timed:
                    yield from self._rows(self.expire(of, state, r[1]))
                yield from self._rows(self.step(of, state, r))
        if due:
            left = [p for p in pieces if p[1] >= upto]
            self._wait([r for rows in self.read.values() for r in rows], left)
            if left:
                self.pieces.update(_columns(left))
            else:
                self.pieces.clear()
            pieces = left
        self.passed.update((upto * self.slot_us,))
        ends = [lo for _, lo in pieces]
        if self.timed:
            for of, state in states.items():
                yield from self._rows(self.expire(of, state, upto * self.slot_us))
            before, deadline = deadline, min((d for d in map(self.deadline_us, states.values()) if d is not None), default=None)
            if deadline is not None:
                self.runs_out.update((deadline,))
                ends.append(deadline // self.slot_us)
            elif before is not None:
                self.runs_out.clear()
        if self.item:
            self._put_states(states)
        self.store()
        if ends:
            self.handle.registerTimer(self._end_ms(min(ends)))

    def _rows(self, found: Iterable[dict]) -> Iterator[Row]:
        for d in found:
            yield self.output(*map(d.get, self.columns))

    def close(self) -> None:
        pass


class PackedProcessor(StatefulProcessor):
    """A processor on packs (:func:`_packed`), whose output rows leave as columns, many at once."""

    def __init__(self, processor: EventTimeProcessor):
        self.processor = processor

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.processor.init(handle)
        self.processor.output = lambda *values: values
        self.output = Row(*self.processor.columns)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        return self.processor.handleInputRows(key, rows, timerValues)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        found = iter(self.processor.handleExpiredTimer(key, timerValues, expiredTimerInfo))
        while some := list(islice(found, OUT_ROWS)):
            yield self.output(*zip(*some))  # PySpark copies lists of a row item by item, tuples not

    def close(self) -> None:
        self.processor.close()


class KeyQueue:
    """First in, first out: ``(id, ts)`` of a key.  Both ends are in memory, what is
    between them in numbered pages of map state.  Nothing but the ends is read."""

    #: Schema of an entry of either end, and of a page and its number.
    item, page_key, page = "queue string, at long, id long, ts long", "of long, no_key boolean, queue string, at long", "id long, ts long"

    def __init__(self, pages, of, name: str, items: list):
        self.pages, self.name = pages, name
        self.key = (of or 0, of is None, name)
        self.first, self.last = (min(i[1] for i in items), max(i[1] for i in items)) if items else (0, 0)
        ahead = sum(i[1] == self.first for i in items) if self.first < self.last else PAGE_ROWS
        self.head, self.tail = deque(i[2:] for i in items[:ahead]), [i[2:] for i in items[ahead:]]

    def items(self) -> list:
        """Both ends with the numbers of the pages next to them.  While there are pages,
        neither end is empty, so their numbers are known."""
        if self:
            self.peek()
        return ([(self.name, self.first, *e) for e in self.head] + [(self.name, self.last, *e) for e in self.tail])

    def __bool__(self) -> bool:
        return bool(self.head or self.tail)

    def push(self, entry: tuple) -> None:
        if len(self.tail) == PAGE_ROWS:
            self.pages.updateValue((*self.key, self.last), _columns(self.tail))
            self.last += 1
            self.tail = []
        # entries go to the head as long as nothing is behind it
        if self.tail or self.first < self.last or len(self.head) >= PAGE_ROWS:
            self.tail.append(entry)
        else:
            self.head.append(entry)

    def peek(self) -> tuple:
        if not self.head:
            if self.first < self.last:
                self.head = deque(zip(*self.pages.getValue((*self.key, self.first))))
                self.pages.removeKey((*self.key, self.first))
                self.first += 1
            else:
                self.head, self.tail = deque(self.tail), []
        return self.head[0]

    def pop(self) -> tuple:
        entry = self.peek()
        self.head.popleft()
        return entry


class _Queues(EventTimeProcessor):
    """State is queues, by name."""

    item, timed = KeyQueue.item, True
    queues: tuple[str, ...] = ()

    def open_state(self, handle) -> None:
        self.pages = handle.getMapState("pages", KeyQueue.page_key, _arrays(KeyQueue.page))

    def unpack(self, of, items):
        return {q: KeyQueue(self.pages, of, q, [i for i in items if i[0] == q]) for q in self.queues}

    def pack(self, state):
        return [i for queue in state.values() for i in queue.items()]


class _OneValue(EventTimeProcessor):
    """State is one value, ``initial`` until the first row."""

    initial = ()

    def unpack(self, of, items):
        return items or [self.initial]


# ------------------------------------------------------------------ A1
class RunningCountProcessor(_OneValue):
    """A1 exact: one output row per input row with the key's running count."""

    item, initial = "n long", (0,)
    columns = ["key", "id", "ts", "running_count"]

    def step(self, of, state, row):
        state[0] = (state[0][0] + 1,)
        return [{"key": of, "id": row[0], "ts": row[1], "running_count": state[0][0]}]


def running_count_exact(stream: DataFrame, key: str, id_col: str, et: str, delay=0,
                        buckets: int | None = None) -> DataFrame:
    """A1 per row on a stream (append mode)."""
    return _stateful(_source(stream, key, id_col, et, buckets=buckets), et, delay, RunningCountProcessor(),
                     "key long, id long, ts long, running_count long")


# ------------------------------------------------------------------ J5
class PreviousEventProcessor(_OneValue):
    """Emit each event with the key's previous event, then remember it."""

    fields = "id long, ts long, type string"
    item, initial = "id long, type string", (None, None)
    columns = ["key", "id", "ts", "type", "prev_id", "prev_type"]

    def step(self, of, state, row):
        out = {"key": of, "id": row[0], "ts": row[1], "type": row[2],
               "prev_id": state[0][0], "prev_type": state[0][1]}
        state[0] = (row[0], row[2])
        return [out]


def previous_event(stream: DataFrame, key: str, id_col: str, et: str, type_col: str, delay=0,
                   buckets: int | None = None) -> DataFrame:
    """J5 stream half: previous event per key (append mode); the rule in force is
    added per micro-batch by :func:`eventide.operators.joins.with_rule`."""
    return _stateful(_source(stream, key, id_col, et, F.col(type_col).alias("type"), buckets=buckets), et, delay,
                     PreviousEventProcessor(),
                     "key long, id long, ts long, type string, prev_id long, prev_type string")


# ------------------------------------------------------------------ J4
class ReconcileProcessor(_Queues):
    """J4 exact, one-to-one: a row takes the oldest waiting row of the other side
    that is at most ``within`` older, otherwise it waits; a row that nothing took
    until ``within`` after its time is reported as ``left_only`` / ``right_only``."""

    fields = "id long, ts long, side string"
    columns = ["key", "l_id", "l_ts", "r_id", "r_ts", "status"]
    queues = ("left", "right")

    def __init__(self, within_us: int):
        self.within = within_us

    def expire(self, of, state, upto_us):
        for side, queue in state.items():
            while queue and queue.peek()[1] + self.within < upto_us:
                vid, vts = queue.pop()
                mine = side[0]
                yield {"key": of, f"{mine}_id": vid, f"{mine}_ts": vts, "status": f"{side}_only"}

    def step(self, of, state, row):
        vid, vts, side = row[:3]
        other = "right" if side == "left" else "left"
        if not state[other]:
            state[side].push((vid, vts))
            return
        oid, ots = state[other].pop()
        yield {"key": of, f"{side[0]}_id": vid, f"{side[0]}_ts": vts, f"{other[0]}_id": oid,
               f"{other[0]}_ts": ots, "status": "matched"}

    def deadline_us(self, state):
        heads = [queue.peek()[1] for queue in state.values() if queue]
        return min(heads) + self.within + 1 if heads else None


def reconcile_exact(left: DataFrame, right: DataFrame, key: str, id_col: str, et: str,
                    within, delay=0, buckets: int | None = None) -> DataFrame:
    """J4 on two streams (append mode); both carry ``key``, ``id_col`` and the
    event-time column ``et``."""
    both = _source(left, key, id_col, et, F.lit("left").alias("side"), buckets=buckets).unionByName(
        _source(right, key, id_col, et, F.lit("right").alias("side"), buckets=buckets))
    return _stateful(both, et, delay, ReconcileProcessor(_micros(within)),
                     "key long, l_id long, l_ts long, r_id long, r_ts long, status string")


# ------------------------------------------------------------------ C1/C4
class FollowedByProcessor(_Queues):
    """C1/C4 exact: open ``first`` rows wait for a ``then`` row, which completes
    every open one that is less than ``within`` older (no skip).  A ``first`` row
    still open ``within`` after its time times out."""

    fields = "id long, ts long, is_first boolean, is_then boolean"
    columns = ["key", "first_id", "first_ts", "then_id", "then_ts", "kind"]
    queues = ("open",)

    def __init__(self, within_us: int):
        self.within = within_us

    def expire(self, of, state, upto_us):
        queue = state["open"]
        while queue and queue.peek()[1] + self.within <= upto_us:
            oid, ots = queue.pop()
            yield {"key": of, "first_id": oid, "first_ts": ots, "then_ts": ots + self.within, "kind": "timeout"}

    def step(self, of, state, row):
        vid, vts, is_first, is_then = row[:4]
        queue = state["open"]
        while is_then and queue:
            oid, ots = queue.pop()
            yield {"key": of, "first_id": oid, "first_ts": ots, "then_id": vid, "then_ts": vts, "kind": "match"}
        if is_first:
            queue.push((vid, vts))

    def deadline_us(self, state):
        return state["open"].peek()[1] + self.within if state["open"] else None


def followed_by_exact(stream: DataFrame, key: str, id_col: str, et: str, first, then,
                      within, delay=0, buckets: int | None = None) -> DataFrame:
    """C1 + C4 on a stream; ``kind`` is ``match`` (then_ts = the completing
    row) or ``timeout`` (then_ts = the timeout time).  Append mode."""
    flags = (F.coalesce(first, F.lit(False)).alias("is_first"), F.coalesce(then, F.lit(False)).alias("is_then"))
    return _stateful(_source(stream, key, id_col, et, *flags, buckets=buckets), et, delay,
                     FollowedByProcessor(_micros(within)),
                     "key long, first_id long, first_ts long, then_id long, then_ts long, kind string")


# ------------------------------------------------------------------ C5
class StateMachineProcessor(_OneValue):
    """C5 exact: the key's current state in value state; one row per event."""

    fields = "id long, ts long, ev int"
    item = "s int"
    columns = ["key", "id", "ts", "state", "accepted"]

    def __init__(self, fsm: StateMachine):
        self.fsm, self.initial = fsm, (fsm.sid[fsm.start],)

    def step(self, of, state, row):
        state[0] = (int(self.fsm.table[row[2], state[0][0]]),)
        name = self.fsm.states[state[0][0]]
        return [{"key": of, "id": row[0], "ts": row[1], "state": name, "accepted": name in self.fsm.accept}]


def state_machine_exact(stream: DataFrame, key: str, id_col: str, et: str, event_col: str,
                        fsm: StateMachine, delay=0, buckets: int | None = None) -> DataFrame:
    return _stateful(_source(stream, key, id_col, et, fsm.event_index(event_col).alias("ev"), buckets=buckets), et, delay,
                     StateMachineProcessor(fsm), "key long, id long, ts long, state string, accepted boolean")


# ------------------------------------------------------------------ N3
class BufferFlushProcessor(EventTimeProcessor):
    """A key's rows wait until the watermark reaches the next multiple of
    ``every`` after them, which is the end of their slot; then they are flushed in
    order."""

    columns = ["key", "id", "ts", "flush_ts", "position"]

    def __init__(self, every_us: int):
        self.slot_us = every_us

    def begin(self, slot: int) -> None:
        self.position: dict = {}

    def step(self, of, state, row):
        self.position[of] = position = self.position.get(of, 0) + 1
        flush = (row[1] // self.slot_us + 1) * self.slot_us
        return [{"key": of, "id": row[0], "ts": row[1], "flush_ts": flush, "position": position}]


def buffer_flush_exact(stream: DataFrame, key: str, id_col: str, et: str, every,
                       delay=0, buckets: int | None = None) -> DataFrame:
    if _micros(every) % 1000:
        raise ValueError("timers have milliseconds")
    return _stateful(_source(stream, key, id_col, et, buckets=buckets), et, delay, BufferFlushProcessor(_micros(every)),
                     "key long, id long, ts long, flush_ts long, position long")


# ------------------------------------------------------------------ V3
class RuleJoinProcessor(_OneValue):
    """Events of many keys with their key's previous event and the rule in force.

    Rules come to all buckets.  Events and rules wait together until the watermark of both
    streams has passed them and are taken in order of time, rules first, so an event meets
    the latest rule that starts at or before it, however late that rule arrived.  Of rules
    with equal start the greatest counts.  The log of rules is what waits plus the one in
    force."""

    item, initial = "id long, type string", (None, None)

    def __init__(self, rule_fields: list[str]):
        self.rule_fields = rule_fields
        rules = "".join(f", {f} string" for f in rule_fields)
        self.fields = f"id long, ts long, is_rule boolean, type string{rules}"
        self.rule_schema = "since long" + rules
        self.columns = ["id", "key", "ts", "type", "prev_id", "prev_type", "rule_since", *rule_fields]

    def order(self, row):
        # None sorts before any text
        return (row[1], not row[2], row[0] or 0,
                tuple((v is not None, v or "") for v in row[4:-1]) if row[2] else ())

    def open_state(self, handle) -> None:
        self.rule = handle.getValueState("rule", self.rule_schema)

    def load(self) -> None:
        v = self.rule.get()
        self.now = self.before = tuple(v) if v else None

    def store(self) -> None:
        if self.now != self.before:
            self.rule.update(self.now)

    def step(self, of, state, row):
        rid, ts, is_rule, kind = row[:4]
        if is_rule:
            self.now = (ts, *row[4:-1])
            return
        since, *rule = self.now or [None] * (1 + len(self.rule_fields))
        yield {"id": rid, "key": of, "ts": ts, "type": kind, "prev_id": state[0][0], "prev_type": state[0][1],
               "rule_since": since, **dict(zip(self.rule_fields, rule))}
        state[0] = (rid, kind)


def rule_join(events: DataFrame, rules: DataFrame, key: str, id_col: str, et: str, type_col: str,
              rule_fields: list[str], buckets: int, delay=0, rule_delay=0) -> DataFrame:
    """J5 with the rules as a stream of their own (append mode): ``rules`` has the
    event-time column ``et`` (when a rule starts) and text columns ``rule_fields``.

    Events go to ``buckets`` state keys by a hash of their key, each rule to all of
    them (choose about as many as there are shuffle partitions).  The query's watermark
    is the smaller of the two streams' watermarks, so events wait for the rules."""
    no_rule = [F.lit(None).cast("string").alias(f) for f in rule_fields]
    processor = RuleJoinProcessor(rule_fields)
    ev = _source(events, key, id_col, et, F.lit(False).alias("is_rule"), F.col(type_col).alias("type"), *no_rule, buckets=buckets)
    ru = rules.select(F.explode(F.sequence(F.lit(0).cast("long"), F.lit(buckets - 1).cast("long"))).alias("key"),
                      F.lit(None).cast("long").alias("of"), F.lit(None).cast("long").alias("id"), _us(et).alias("ts"),
                      F.lit(True).alias("is_rule"), F.lit(None).cast("string").alias("type"), *rule_fields, F.col(et))
    out = ("id long, key long, ts long, type string, prev_id long, prev_type string, rule_since long"
           + "".join(f", {f} string" for f in rule_fields))
    both = (_packed(ev, et, processor).withWatermark("et", W.duration(delay or 0))
            .unionByName(_packed(ru, et, processor).withWatermark("et", W.duration(rule_delay or 0))))
    return _stepped(both, processor, out)


# ------------------------------------------------------------------ V4
class TtlValueProcessor(StatefulProcessor):
    """V4: value state with a processing-time TTL; emits each row together
    with the value that was still alive for its key (then refreshes it)."""

    def __init__(self, ttl_ms: int):
        self.ttl = ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.last = handle.getValueState("last", "id long", self.ttl)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        v = self.last.get()
        prev = v[0] if v else None
        for r in sorted(rows, key=lambda r: (r.ts, r.id)):
            yield Row(key=key[0], id=int(r.id), alive_id=prev)
            prev = int(r.id)
        self.last.update((prev,))

    def close(self) -> None:
        pass


def ttl_previous(stream: DataFrame, key: str, id_col: str, et: str, ttl) -> DataFrame:
    """V4 (processing-time mode; TTL is refused in event-time mode).  Such a
    query keeps running eviction batches: stop it explicitly rather than
    waiting in ``processAllAvailable``."""
    src = stream.select(F.col(key).alias("key"), F.col(id_col).alias("id"), _us(et).alias("ts"))
    ttl_ms = int(round(W.seconds(ttl) * 1000))
    return src.groupBy("key").transformWithState(
        TtlValueProcessor(ttl_ms), "key long, id long, alive_id long", "Append", "ProcessingTime")


class TtlEventTimeProcessor(EventTimeProcessor):
    """V4 in event time: a value per ``entry`` of a key, which lives ``ttl`` from its
    last write; each write refreshes it.  Expired entries are removed at the end
    of the slot in which they run out; until then their age is checked on reading."""

    fields = "id long, ts long, entry string"
    item = "entry string, id long, ts long"
    columns = ["key", "id", "ts", "entry", "alive_id"]
    timed = True

    def __init__(self, ttl_us: int):
        self.ttl = ttl_us

    def unpack(self, of, items):
        return {entry: (rid, ts) for entry, rid, ts in items}

    def pack(self, state):
        return [(entry, *last) for entry, last in state.items()]

    def step(self, of, state, row):
        rid, ts, entry = row[:3]
        # in order of time: the entries stand in the order in which they run out
        last = state.pop(entry, None)
        state[entry] = (rid, ts)
        yield {"key": of, "id": rid, "ts": ts, "entry": entry,
               "alive_id": last[0] if last and last[1] + self.ttl >= ts else None}

    def expire(self, of, state, upto_us):
        while state:
            entry, last = next(iter(state.items()))
            if last[1] + self.ttl >= upto_us:
                break
            del state[entry]
        return ()

    def deadline_us(self, state):
        return next(iter(state.values()))[1] + self.ttl + 1 if state else None


def ttl_previous_event_time(stream: DataFrame, key: str, id_col: str, et: str, ttl, entry=None, delay=0,
                            buckets: int | None = None) -> DataFrame:
    """V4 in event time (append mode): each row with the id of the value that is still
    alive for its key and entry: written at most ``ttl`` before."""
    source = _source(stream, key, id_col, et, (F.lit("") if entry is None else entry).cast("string").alias("entry"),
                     buckets=buckets)
    return _stateful(source, et, delay, TtlEventTimeProcessor(_micros(ttl)),
                     "key long, id long, ts long, entry string, alive_id long")


# ------------------------------------------------------------------ C2/C3
class StrictSequenceProcessor(EventTimeProcessor):
    """C2/C3 exact: the last ``n - 1`` rows of the key (bounded)
    and, per new row, whether it ends ``cond_0 .. cond_{n-1}`` on consecutive
    rows."""

    def __init__(self, n: int):
        self.n = n
        self.fields = self.item = "id long, ts long, " + ", ".join(f"c{j} boolean" for j in range(n))
        self.columns = ["key"] + [f"e{j + 1}_{c}" for j in range(n) for c in ("id", "ts")]

    def step(self, of, state, row):
        window = [*state, row[:-1]][-self.n:]
        state[:] = window[1:] if len(window) == self.n else window
        if len(window) < self.n or not all(w[2 + j] for j, w in enumerate(window)):
            return ()
        out = {"key": of}
        for j, w in enumerate(window, 1):
            out[f"e{j}_id"], out[f"e{j}_ts"] = w[0], w[1]
        return [out]


def strict_sequence_exact(stream: DataFrame, key: str, id_col: str, et: str, conds, delay=0,
                          buckets: int | None = None) -> DataFrame:
    """C2/C3 on a stream (append mode): one row per match, ``e{j}_id`` and
    ``e{j}_ts`` for the j-th row of the match."""
    n = len(conds)
    flags = [F.coalesce(c, F.lit(False)).alias(f"c{j}") for j, c in enumerate(conds)]
    cols = ", ".join(f"e{j + 1}_id long, e{j + 1}_ts long" for j in range(n))
    return _stateful(_source(stream, key, id_col, et, *flags, buckets=buckets), et, delay, StrictSequenceProcessor(n),
                     f"key long, {cols}")
