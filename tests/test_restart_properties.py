"""Restart from a checkpoint and property tests (§5.4)."""

import os
import tempfile

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from eventide.operators import joins as J
from eventide.operators import late as L
from eventide.operators import patterns as P
from eventide.operators import routing as R
from eventide.operators import topn as N
from eventide.sources.tables import EVENTS_SCHEMA, events
from eventide.streaming import sinks as K
from eventide.streaming import stateful as ST
from eventide.streaming.replay import replay, with_event_time, write_replay_files

from .conftest import SF001

ORDER = ["ts", "event_id"]


def test_stateful_stream_restart_gives_same_result(spark):
    """Run two micro-batches, stop, resume from the same checkpoint: the
    per-row running counts equal one uninterrupted batch computation."""
    ev = events(spark, SF001).select("event_id", "user_id", "ts")
    base = tempfile.mkdtemp(prefix="restart-", dir="/tmp")
    src = write_replay_files(ev, os.path.join(base, "in"), 6, ORDER)
    out, ck = os.path.join(base, "out"), os.path.join(base, "ck")

    def start(max_batches=None):
        s = with_event_time(replay(spark, src, EVENTS_SCHEMA).select("event_id", "user_id", "ts"))
        q = K.start(ST.running_count_exact(s, "user_id", "event_id", "et"), "parquet", "restart",
                    trigger={"availableNow": True} if max_batches is None else {"processingTime": "0 seconds"},
                    checkpoint=ck, path=out)
        return q

    q = start(max_batches=2)
    import time
    deadline = time.time() + 120
    while time.time() < deadline and (q.lastProgress is None or q.lastProgress["batchId"] < 1):
        time.sleep(0.5)
    q.stop()
    first = spark.read.schema("key long, id long, ts long, running_count long").parquet(out).count()
    assert first < 1000
    start().awaitTermination(300)
    got = {(r.id, r.running_count) for r in spark.read.parquet(out).collect()}
    from eventide.operators import aggregates as A
    last = ev.agg(F.max("ts")).first()[0]
    want = {(r.event_id, r.running_count)
            for r in A.running_count(ev, ["user_id"], ORDER).collect() if r.ts < last}
    # rows at the last time wait: the watermark has not passed them
    assert got == want and first < len(got)


# ---------------------------------------------------------------- properties
events_st = st.lists(
    st.tuples(st.integers(0, 3), st.integers(0, 3_600), st.sampled_from(["view", "purchase", "click"]),
              st.integers(0, 100)),
    min_size=1, max_size=40)

PROP = settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))


def frame(spark, rows):
    data = [(i, u, s, t, v) for i, (u, s, t, v) in enumerate(rows)]
    return (spark.createDataFrame(data, "event_id long, user_id long, s long, event_type string, value long")
            .withColumn("ts", F.timestamp_seconds("s").cast("timestamp_ntz")))


@PROP
@given(rows=events_st)
def test_matches_plus_timeouts_are_all_firsts(spark, rows):
    df = frame(spark, rows)
    m, t = P.followed_by(df, ["user_id"], ORDER, "ts", F.col("event_type") == "view",
                         F.col("event_type") == "purchase", "10 minutes", ["event_id"])
    firsts = sorted(r.event_id for r in df.filter("event_type = 'view'").collect())
    assert sorted([r.first_event_id for r in m.collect()] + [r.first_event_id for r in t.collect()]) == firsts


@PROP
@given(rows=events_st)
def test_every_row_has_exactly_one_route(spark, rows):
    df = frame(spark, rows)
    routed = R.route_split(df, "value", [("low", 20), ("mid", 50)], "high")
    assert routed.count() == df.count()
    assert routed.filter(F.col("route").isNull()).count() == 0
    late = L.late_split(df, "ts", ["event_id"], "5 minutes", lateness="1 minute")
    assert sorted(r.event_id for r in late.collect()) == list(range(len(rows)))


@PROP
@given(rows=events_st)
def test_window_join_within_cogroup(spark, rows):
    df = frame(spark, rows)
    left = df.filter("event_type = 'view'").select("user_id", F.col("event_id").alias("l_id"),
                                                   F.col("ts").alias("l_ts"))
    right = df.filter("event_type = 'purchase'").select("user_id", F.col("event_id").alias("r_id"),
                                                        F.col("ts").alias("r_ts"))
    pairs = J.window_join(left, right, ["user_id"], "l_ts", "r_ts", "15 minutes")
    groups = {(r.user_id, r.window_start): (r.n_left, r.n_right) for r in
              J.window_cogroup(left, right, ["user_id"], "l_ts", "r_ts", "l_id", "r_id", "15 minutes").collect()}
    per = {}
    for r in pairs.collect():
        per[(r.user_id, r.window_start)] = per.get((r.user_id, r.window_start), 0) + 1
    for k, n in per.items():
        assert k in groups and n == groups[k][0] * groups[k][1]


@PROP
@given(rows=events_st)
def test_top_n_counts_dominate_dropped(spark, rows):
    df = frame(spark, rows)
    top = N.top_n_per_window(df, "ts", "1 hour", "user_id", 2).collect()
    from eventide.operators import windows as W
    allc = (df.groupBy(W.tumbling("ts", "1 hour").alias("w"), "user_id").count()
            .select(F.col("w.start").alias("ws"), "user_id", "count").collect())
    kept = {(r.window_start, r.user_id) for r in top}
    low = {}
    for r in top:
        low[r.window_start] = min(low.get(r.window_start, 1 << 30), r.cnt)
    for r in allc:
        if (r.ws, r.user_id) not in kept:
            assert r["count"] <= low[r.ws]


bounds_st = st.tuples(st.integers(-900, 900), st.integers(0, 1200)).map(lambda t: (t[0], t[0] + t[1]))


@PROP
@given(rows=events_st, b=bounds_st)
def test_interval_join_equals_brute_force(spark, rows, b):
    lo, hi = b
    df = frame(spark, rows)
    left = df.filter("event_type = 'view'").select("user_id", F.col("event_id").alias("l_id"),
                                                   F.col("ts").alias("l_ts"))
    right = df.filter("event_type = 'purchase'").select("user_id", F.col("event_id").alias("r_id"),
                                                        F.col("ts").alias("r_ts"))
    got = sorted((r.l_id, r.r_id) for r in J.interval_join(left, right, ["user_id"], "l_ts", "r_ts",
                                                             lo, hi).collect())
    data = list(enumerate(rows))
    want = sorted((i, j) for i, (u, s, t, _) in data if t == "view"
                  for j, (u2, s2, t2, _) in data if t2 == "purchase" and u2 == u and lo <= s2 - s <= hi)
    assert got == want


@PROP
@given(rows=events_st, chunks=st.integers(1, 12))
def test_chunked_scans_equal_plain_windows(spark, rows, chunks):
    from pyspark.sql import Window
    from eventide.operators.sequence import KeyedSequence
    df = frame(spark, rows)
    seq = KeyedSequence(["user_id"], ORDER, chunks=chunks)
    d = seq.prepare(df)
    d = seq.running(d, {"c": ("count", F.lit(1)), "m": ("max", F.col("value")),
                        "l": ("last", F.when(F.col("event_type") == "view", F.col("event_id")))})
    d = seq.running(d, {"nx": ("min", F.when(F.col("event_type") == "purchase", F.col("event_id")))},
                    reverse=True, inclusive=False)
    d = seq.finish(seq.lag(d, ["event_id"], 2))
    got = sorted((r.event_id, r.c, r.m, r.l, r.nx, r.prev1 and r.prev1.event_id, r.prev2 and r.prev2.event_id)
                 for r in d.collect())
    w = Window.partitionBy("user_id").orderBy(*ORDER)
    fwd = w.rowsBetween(Window.unboundedPreceding, 0)
    nxt = w.rowsBetween(1, Window.unboundedFollowing)
    want = df.select("event_id", F.count(F.lit(1)).over(fwd).alias("c"), F.max("value").over(fwd).alias("m"),
                     F.last(F.when(F.col("event_type") == "view", F.col("event_id")), True).over(fwd).alias("l"),
                     F.min(F.when(F.col("event_type") == "purchase", F.col("event_id"))).over(nxt).alias("nx"),
                     F.lag("event_id", 1).over(w).alias("p1"), F.lag("event_id", 2).over(w).alias("p2"))
    assert got == sorted(tuple(r) for r in want.collect())


def test_late_router_restart_gives_batch_result(spark):
    """Stop the foreachBatch late router after two micro-batches and resume
    from its checkpoint: per-batch state files and per-batch output folders
    make the resumed run produce exactly the batch routes."""
    import time
    ev = events(spark, SF001).select("event_id", "ts").withColumn(
        "arrival_ts", F.col("ts") + F.make_dt_interval(secs=(F.col("event_id") % 7) * 600))
    base = tempfile.mkdtemp(prefix="late-restart-", dir="/tmp")
    src = write_replay_files(ev, os.path.join(base, "in"), 5, ["arrival_ts", "event_id"])
    out, ck, state = (os.path.join(base, x) for x in ("out", "ck", "state"))

    def start(trigger):
        router = K.LateRouter("ts", ["arrival_ts", "event_id"], "30 minutes", K.parquet_writer(out),
                              lateness="10 minutes", state_dir=state)
        return K.start_batches(replay(spark, src, ev.schema), router, "late-restart",
                               trigger=trigger, checkpoint=ck)

    q = start({"processingTime": "0 seconds"})
    deadline = time.time() + 120
    while time.time() < deadline and (q.lastProgress is None or q.lastProgress["batchId"] < 1):
        time.sleep(0.5)
    q.stop()
    start({"availableNow": True}).awaitTermination(300)
    got = sorted((r.event_id, r.route) for r in spark.read.parquet(out).collect())
    want = sorted((r.event_id, r.route) for r in
                  L.late_split(ev, "ts", ["arrival_ts", "event_id"], "30 minutes",
                               lateness="10 minutes").collect())
    assert got == want


def _one_to_one_by_queue(rows_in, within):
    """Brute force: the rows of each key in order, with a queue."""
    out, queues = [], {}
    for key, ts, rid, left in sorted(rows_in, key=lambda r: (r[1], r[2])):
        if key is None:
            out.append((rid, None) if left else (None, rid))
            continue
        side, queue = queues.get(key, (None, []))
        for t, i in [x for x in queue if x[0] + within < ts]:
            out.append((i, None) if side else (None, i))
        queue = [x for x in queue if x[0] + within >= ts]
        if queue and side != left:
            other = queue.pop(0)[1]
            out.append((rid, other) if left else (other, rid))
        else:
            queue.append((ts, rid))
            side = left
        queues[key] = side, queue
    for side, queue in queues.values():
        out += [(i, None) if side else (None, i) for _, i in queue]
    return sorted(out, key=str)


@pytest.mark.parametrize("seed,chunks,within", [(1, 1, 5), (2, 7, 3), (3, 40, 30), (4, 13, 0)])
def test_one_to_one_equals_queue(spark, seed, chunks, within):
    """A hot key without any gap, other keys and null keys, tied times."""
    import random
    from eventide.operators import joins as J
    rng = random.Random(seed)
    data = [(rng.choice([1, 1, 1, 2, None]), rng.randrange(0, 900), i, rng.random() < 0.5) for i in range(1_500)]
    df = spark.createDataFrame(data, "k long, t long, id long, l boolean").withColumn("ts", F.timestamp_seconds("t"))
    left = df.filter("l").select("k", F.col("id").alias("l_id"), F.col("ts").alias("l_ts"))
    right = df.filter("NOT l").select("k", F.col("id").alias("r_id"), F.col("ts").alias("r_ts"))
    got = J.reconcile_one_to_one(left, right, ["k"], "l_ts", "r_ts", "l_id", "r_id", within, chunks=chunks)
    assert sorted(((r.l_id, r.r_id) for r in got.collect()), key=str) == _one_to_one_by_queue(data, within)


def test_one_to_one_spreads_a_hot_key(spark):
    """A key that holds all rows, a row a second and no gap: all chunks share it."""
    from eventide.operators import joins as J
    from eventide.operators.sequence import KeyedSequence
    df = spark.range(60_000).select(F.lit(1).alias("k"), F.col("id"), F.timestamp_seconds("id").alias("ts"),
                                    (F.xxhash64("id") % 2 == 0).alias("l"))
    d = KeyedSequence(["k"], ["ts", "id"], chunks=16).prepare(df)
    sizes = [r["count"] for r in d.groupBy("_chunk").count().collect()]
    assert len(sizes) == 16 and max(sizes) < 2 * 60_000 / 16
    left = df.filter("l").select("k", F.col("id").alias("l_id"), F.col("ts").alias("l_ts"))
    right = df.filter("NOT l").select("k", F.col("id").alias("r_id"), F.col("ts").alias("r_ts"))
    got = J.reconcile_one_to_one(left, right, ["k"], "l_ts", "r_ts", "l_id", "r_id", 600, chunks=16)
    data = [(1, r.id, r.id, r.l) for r in df.select("id", "l").collect()]
    assert sorted(((r.l_id, r.r_id) for r in got.collect()), key=str) == _one_to_one_by_queue(data, 600)
