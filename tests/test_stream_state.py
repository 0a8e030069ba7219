"""State by deadline, rules as a second stream, firings of late windows, TTL in event time."""

import os
import random
import tempfile
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from eventide.operators import late as L
from eventide.streaming import sinks as K
from eventide.streaming import stateful as ST

from .test_streaming import CLOSE, _replayed, run_memory


class FakeState:
    """Map, value and list state in a dict, counting what is read."""

    def __init__(self, reads):
        self.data, self.reads = {}, reads

    def getValue(self, key):
        self.reads.append(len(self.data.get(key, [()])[0]) if key in self.data and isinstance(self.data[key][0], list) else 1)
        return self.data.get(key)

    def updateValue(self, key, value):
        self.data[key] = value

    def removeKey(self, key):
        self.data.pop(key, None)

    def get(self):
        return self.data.get("one")

    def update(self, value):
        self.data["one"] = value

    def clear(self):
        self.data.clear()


class FakeHandle:
    def __init__(self):
        self.states, self.timers, self.reads = {}, set(), []

    def _state(self, name, *_):
        return self.states.setdefault(name, FakeState(self.reads))

    getMapState = getValueState = getListState = _state

    def registerTimer(self, ms):
        self.timers.add(ms)

    def listTimers(self):
        return iter(sorted(self.timers))


def drive(processor, batches, key=(1,)):
    """Micro-batches ``(rows, watermark in ms)`` through a processor, as Spark does: rows
    first, then the timers that have expired, in order."""
    handle = FakeHandle()
    processor.init(handle)
    for rows, mark in batches:
        now = SimpleNamespace(getCurrentWatermarkInMs=lambda mark=mark: mark)
        if rows:
            yield from processor.handleInputRows(key, iter(rows), now)
        for t in sorted(t for t in handle.timers if t <= mark):
            yield from processor.handleExpiredTimer(key, now, SimpleNamespace(getExpiryTimeInMs=lambda t=t: t))
            handle.timers.discard(t)
    processor.handle_seen = handle


def test_hot_key_of_a_million_rows_reads_slot_by_slot():
    """A key with 1,000,000 rows, all waiting at once: no firing holds more than the rows
    of its minute, no state entry more than a piece, and nothing is read twice."""
    n, per_slot = 1_000_000, 10_000
    rows = (SimpleNamespace(id=i, ts=(i * 7_919 % n) * (60_000_000 // per_slot)) for i in range(n))
    processor, most = ST.RunningCountProcessor(), 0
    taken = processor._take

    def counted(slot):
        nonlocal most
        out = taken(slot)
        most = max(most, len(out))
        return out
    processor._take = counted
    seen = last = 0
    for out in drive(processor, [(rows, 0), ([], 10 ** 9)]):
        seen += 1
        assert out.running_count == seen and out.ts >= last
        last = out.ts
    handle = processor.handle_seen
    assert seen == n and most == per_slot and max(handle.reads) <= ST.PIECE_ROWS
    assert len(handle.reads) < 2 * n / ST.PIECE_ROWS + 3 * n / per_slot + 200 * n / per_slot / 100 + n / 100
    assert not handle.states["waiting"].data and not handle.states["pieces"].data


@pytest.mark.parametrize("seed", range(6))
def test_reconcile_in_any_batches_equals_queue(seed):
    """Rows in random order and random micro-batches, deadlines inside, between and after
    them: the same rows as a queue over the sorted input."""
    from .test_restart_properties import _one_to_one_by_queue
    rng = random.Random(seed)
    rows = [SimpleNamespace(id=i, ts=rng.randrange(0, 40_000) * 1_000_000, side=rng.choice(["left", "right"]))
            for i in range(400)]
    within = rng.choice([1, 59, 60, 3_600])
    # arrival at most 1,000 s out of order, watermark 1,000 s behind
    arrivals = sorted(rows, key=lambda r: r.ts + rng.randrange(0, 1_000) * 1_000_000)
    batches, top = [], 0
    while arrivals:
        some, arrivals = arrivals[:(k := rng.randrange(1, 60))], arrivals[k:]
        batches.append((some, top))
        top = max(top, max(r.ts for r in some) // 1000 - 1_000_000)
    batches += [([], top), ([], 10 ** 9)]
    got = [(r.l_id, r.r_id) for r in drive(ST.ReconcileProcessor(within * 1_000_000), batches)]
    want = _one_to_one_by_queue([(1, r.ts, r.id, r.side == "left") for r in rows], within * 1_000_000)
    assert sorted(got, key=str) == want


def _rules(spark, name, batches):
    base = tempfile.mkdtemp(prefix=f"{name}-", dir="/tmp")
    for i, rows in enumerate(batches):
        path = os.path.join(base, f"f{i}.parquet")
        spark.createDataFrame(rows, "s long, a string").toPandas().to_parquet(path)
        os.utime(path, (1_600_000_000 + i, 1_600_000_000 + i))
    st = (spark.readStream.schema("s long, a string").option("maxFilesPerTrigger", 1).parquet(base))
    return st.withColumn("et", F.timestamp_seconds("s"))


def test_rules_that_arrive_late_and_out_of_order(spark):
    """The rule of 50 s arrives after the events of 60 s and after the rule of 90 s, and
    still holds for them; of two rules with one start the greater counts."""
    ev = _replayed(spark, [[(1, 7, 10, "x"), (2, 7, 60, "y")], [(3, 8, 100, "x"), (4, None, 55, "z")],
                           [(5, 7, 95, "z")], [(-1, -1, 10 ** 7, "view")]])
    rules = _rules(spark, "rules", [[(90, "late")], [(50, "first"), (50, "b")], [(20, "early")], [(10 ** 7, "end")]])
    out = run_memory(ST.rule_join(ev, rules, "user_id", "event_id", "et", "event_type", ["a"], 4,
                                  "2 minutes", "2 minutes"), "rulejoin")
    got = {(r.id, r.key, r.prev_id, r.a) for r in out.collect()}
    assert got == {(1, 7, None, None), (2, 7, 1, "first"), (3, 8, None, "late"), (4, None, None, "first"), (5, 7, 2, "late")}


def test_ttl_in_event_time_is_per_entry_and_refreshed(spark):
    rows = [(1, 7, 100, "a"), (2, 7, 3_100, "a"), (3, 7, 6_700, "a"), (4, 7, 10_301, "a"), (5, 7, 200, "b"), (6, 7, 3_800, "b")]
    st = _replayed(spark, [rows[3:], rows[:3], CLOSE])
    out = run_memory(ST.ttl_previous_event_time(st, "user_id", "event_id", "et", "1 hour", F.col("event_type"), "4 hours"), "ttl_et")
    assert {(r.id, r.alive_id) for r in out.collect()} == {(1, None), (2, 1), (3, 2), (4, None), (5, None), (6, 5)}


def test_ttl_removes_expired_entries():
    processor = ST.TtlEventTimeProcessor(3_600_000_000)
    rows = [SimpleNamespace(id=i, ts=i * 1_000_000, entry=f"e{i}") for i in range(500)]
    out = list(drive(processor, [(rows, 0), ([], 1_000_000), ([], 3_000_000), ([], 4_200_000), ([], 9_000_000)]))
    assert len(out) == 500 and not processor.handle_seen.states["values"].data
    assert not processor.handle_seen.states["runs_out"].data


def firings_by_hand(rows, size, slide, lateness):
    """Brute force of the firing rule over arrivals ``(id, ts)`` in order."""
    on_time, late, out, top = {}, {}, [], None
    for rid, ts in rows:
        last = ts // slide * slide
        for start in range(last - size + slide, last + 1, slide):
            end = start + size
            if top is None or top < end:
                on_time[start] = on_time.get(start, 0) + 1
            elif top < end + lateness:
                late[start] = late.get(start, 0) + 1
                out.append((start, late[start], on_time.get(start, 0) + late[start], rid))
        top = ts if top is None else max(top, ts)
    return sorted(out + [(s, 0, n, None) for s, n in on_time.items() if s + size <= top], key=str)


@pytest.mark.parametrize("size,slide,lateness,files", [(30, 30, 5, 3), (60, 20, 45, 5), (10, 10, 1_000, 2), (10, 10, 0, 4)])
def test_late_firings_equal_the_rule(spark, size, slide, lateness, files):
    rng = random.Random(size + files)
    arrivals = [(i, max(0, i * 2 - rng.choice([0, 0, 0, 5, 20, 60]))) for i in range(300)]
    base = tempfile.mkdtemp(prefix="firings-", dir="/tmp")
    for f in range(files):
        part = arrivals[f * 300 // files:(f + 1) * 300 // files]
        path = os.path.join(base, f"f{f}.parquet")
        spark.createDataFrame(part, "event_id long, s long").toPandas().to_parquet(path)
        os.utime(path, (1_600_000_000 + f, 1_600_000_000 + f))
    st = (spark.readStream.schema("event_id long, s long").option("maxFilesPerTrigger", 1).parquet(base)
          .withColumn("ts", F.timestamp_seconds("s")))
    out, where = os.path.join(base, "out"), os.path.join(base, "ckpt")
    sink = K.LateFirings("ts", ["event_id"], size, K.parquet_writer(out), "event_id", slide=slide if slide != size else None,
                         lateness=lateness)
    K.start_batches(st, sink, "firings", "append", trigger={"availableNow": True}, checkpoint=where).awaitTermination()
    got = spark.read.parquet(out).select(F.unix_timestamp("window_start").alias("s"), "firing", "cnt", "event_id")
    want = firings_by_hand(arrivals, size, slide, lateness)
    assert sorted((tuple(r) for r in got.collect()), key=str) == want

    # the last batch again, as after a lost commit: the same rows, and records as before
    last = files - 1
    batch = spark.createDataFrame(arrivals[last * 300 // files:], "event_id long, s long").withColumn("ts", F.timestamp_seconds("s"))
    again = K.LateFirings("ts", ["event_id"], size, K.parquet_writer(out), "event_id", slide=slide if slide != size else None,
                          lateness=lateness, state_dir=sink.state.state_dir)
    again(batch, last)
    got = spark.read.parquet(out).select(F.unix_timestamp("window_start").alias("s"), "firing", "cnt", "event_id")
    assert sorted((tuple(r) for r in got.collect()), key=str) == want


def test_records_of_closed_windows_are_left_out(spark):
    base = tempfile.mkdtemp(prefix="records-", dir="/tmp")
    sink = K.LateFirings("ts", ["event_id"], 10, K.parquet_writer(base + "/out"), "event_id", lateness=5, state_dir=base + "/state")
    for i, rows in enumerate([[(1, 1), (2, 4)], [(3, 12), (4, 3)], [(5, 40)], []]):
        sink(spark.createDataFrame(rows, "event_id long, s long").withColumn("ts", F.timestamp_seconds("s")), i)
    left = spark.read.parquet(base + "/state/windows/w-3").select(F.unix_timestamp("window_start").alias("s")).collect()
    assert [r.s for r in left] == [40]
    assert sorted(n for n in os.listdir(base + "/state/windows") if n.startswith("w-")) == ["w-2", "w-3"]
    assert L.TOO_LATE not in {c for c in spark.read.parquet(base + "/out").columns}
