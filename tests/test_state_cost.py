"""What a micro-batch pays beside its rows: state partitions, calls to state, single slots."""

import datetime as dt
import json
import random
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from eventide.plans import streams as P
from eventide.streaming import sinks as K
from eventide.streaming import stateful as ST
from eventide.streaming.replay import with_event_time

from .test_bucket_state import Counted, counted  # noqa: F401
from .test_stream_state import drive

MINUTE = 60_000_000


def test_state_partitions_follow_the_rows_not_the_session(spark):
    cores = spark.sparkContext.defaultParallelism
    with K.state_partitions(spark, 1_000):
        small, large = P._state_partitions(spark, *P._cut(100_000)), P._state_partitions(spark, *P._cut(6_000_000))
        assert small <= -(-4 // cores) * cores and 20 <= large < 20 + cores
        # keys stay in state: a longer table gets more partitions
        assert P._state_partitions(spark, *P._cut(400_000_000)) >= 400
    with K.state_partitions(spark, 2):
        assert P._state_partitions(spark, *P._cut(6_000_000)) == 2


def test_stream_in_a_session_of_many_partitions(spark, monkeypatch):
    """The stream's state has few partitions; the session keeps its own, also after an error."""
    queries, start = [], K.start
    monkeypatch.setattr(K, "start", lambda *a, **k: queries.append(start(*a, **k)) or queries[-1])
    before = spark.conf.get("spark.sql.shuffle.partitions")
    at = F.lit(dt.datetime(2024, 1, 1)).cast("timestamp_ntz") + F.make_dt_interval(secs=F.col("id") * 37)
    rows = spark.range(300).select(F.col("id").alias("event_id"), F.when(F.col("id") % 7 < 6, F.col("id") % 7).alias("user_id"),
                                   at.alias("ts"), at.alias("arrival_ts"))
    with K.state_partitions(spark, 150):
        out = P._run(spark, "cost", rows, P.ARRIVAL, lambda s: ST.running_count_exact(
            with_event_time(s), "user_id", "event_id", "et", P.DELAY, ST.buckets_for(spark)))
        assert spark.conf.get("spark.sql.shuffle.partitions") == "150"
        with pytest.raises(ZeroDivisionError):
            P._run(spark, "cost", rows, P.ARRIVAL, lambda s: 1 / 0)
        assert spark.conf.get("spark.sql.shuffle.partitions") == "150"
    assert spark.conf.get("spark.sql.shuffle.partitions") == before
    parts = {json.loads(p.json)["stateOperators"][0]["numShufflePartitions"] for p in queries[0].recentProgress}
    assert len(parts) == 1 and max(parts) < 150
    got = {r.id: (r.key, r.running_count) for r in out.collect()}
    n, want = {}, {}
    for i in range(300):
        user = i % 7 if i % 7 < 6 else None
        n[user] = n.get(user, 0) + 1
        want[i] = (user, n[user])
    assert got == want


def test_rows_that_wait_cost_few_calls_to_state(counted):  # noqa: F811
    rows = [SimpleNamespace(id=i, ts=i * MINUTE, of=i % 50) for i in range(20_000)]
    out = list(drive(ST.RunningCountProcessor(), [(rows, 0), ([], 10 ** 12)]))
    assert [r.id for r in out] == list(range(20_000))
    assert Counted.calls < 60


def test_slots_are_taken_together_when_they_are_small():
    """In order, each slot once and whole, across pieces that overlap; nothing that is not due."""
    rng = random.Random(4)
    rows = [SimpleNamespace(id=i, ts=rng.randrange(9_000 * MINUTE), of=1) for i in range(30_000)]
    rng.shuffle(rows)

    class Seen(ST.BufferFlushProcessor):
        begun, takes = [], 0

        def begin(self, slot):
            Seen.begun.append(slot)
            super().begin(slot)

        def _take(self, slot):
            Seen.takes += 1
            return super()._take(slot)
    out = list(drive(Seen(MINUTE), [(rows[:15_000], 0), (rows[15_000:], 0), ([], 5_000 * 60_000), ([], 10 ** 12)]))
    assert [(r.ts, r.id) for r in out] == sorted((r.ts, r.id) for r in rows)
    slots = [r.ts // MINUTE for r in rows]
    assert Seen.begun == sorted(set(slots)) and Seen.takes < len(Seen.begun) / 20
    last = None
    for r in out:
        at = r.ts // MINUTE
        n = n + 1 if at == last else 1
        last = at
        assert r.position == n
