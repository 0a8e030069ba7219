"""Stream forms equal the batch forms on a replayed table."""

import tempfile

import pytest
from pyspark.sql import functions as F

from eventide.operators import aggregates as A
from eventide.operators import joins as J
from eventide.operators import late as L
from eventide.operators import patterns as P
from eventide.operators import topn as N
from eventide.operators import windows as W
from eventide.sources.tables import EVENTS_SCHEMA, events
from eventide.streaming import operators as S
from eventide.streaming import sinks as K
from eventide.streaming import stateful as ST
from eventide.streaming.replay import replay, with_event_time, write_replay_files

from .conftest import SF01, rows

ORDER = ["ts", "event_id"]
NOW = {"availableNow": True}


@pytest.fixture(scope="module")
def ev(spark):
    return events(spark, SF01)


@pytest.fixture(scope="module")
def replay_dir(spark, ev):
    path = tempfile.mkdtemp(prefix="replay-", dir="/tmp")
    return write_replay_files(ev, path + "/events", 4, ORDER)


def stream(spark, replay_dir):
    return with_event_time(replay(spark, replay_dir, EVENTS_SCHEMA), "ts", "et")


def last_ts(ev):
    """Rows at the last time wait for the watermark to pass them."""
    return F.lit(ev.agg(F.max("ts")).first()[0]).cast("timestamp_ntz")


def run_memory(df, name, mode="append"):
    q = K.start(df, "memory", name, mode, trigger=NOW)
    q.awaitTermination(300)
    return df.sparkSession.table(name)


def test_pv_uv_stream_closed_windows(spark, ev, replay_dir):
    out = run_memory(S.pv_uv(stream(spark, replay_dir), "et", "user_id", "3 days", "1 day"), "pvuv")
    got = out.select(F.col("window_start").cast("timestamp_ntz").alias("ws"), "pv").collect()
    want = {r["window_start"]: r["pv"] for r in A.pv_uv(ev, "ts", "user_id", "3 days", "1 day").collect()}
    assert len(got) >= 25
    for r in got:
        assert want[r["ws"]] == r["pv"]


def test_sessions_stream(spark, ev, replay_dir):
    out = run_memory(S.sessions(stream(spark, replay_dir), "et", ["user_id"], "5 hours"), "sess")
    got = {(r.user_id, r.session_start.replace(tzinfo=None), r.n_events) for r in out.collect()}
    want = {(r.user_id, r.session_start, r.n_events)
            for r in W.sessions(ev, ["user_id"], "ts", "5 hours", ORDER).collect()}
    assert len(got) > 5000 and got <= want


def test_interval_join_stream(spark, ev, replay_dir):
    s = stream(spark, replay_dir)
    left = s.filter("event_type = 'view'").select("user_id", F.col("event_id").alias("l_id"),
                                                  F.col("et").alias("l_et"))
    right = s.filter("event_type = 'purchase'").select("user_id", F.col("event_id").alias("r_id"),
                                                       F.col("et").alias("r_et"))
    out = run_memory(S.interval_join(left, right, ["user_id"], "l_et", "r_et", "1 hour", "24 hours"), "ij")
    got = {(r.l_id, r.r_id) for r in out.collect()}
    bl = ev.filter("event_type = 'view'").select("user_id", F.col("event_id").alias("l_id"),
                                                 F.col("ts").alias("l_ts"))
    br = ev.filter("event_type = 'purchase'").select("user_id", F.col("event_id").alias("r_id"),
                                                     F.col("ts").alias("r_ts"))
    want = {(r.l_id, r.r_id) for r in J.interval_join(bl, br, ["user_id"], "l_ts", "r_ts",
                                                        "1 hour", "24 hours").collect()}
    assert got == want


def test_running_count_exact_stream(spark, ev, replay_dir):
    out = run_memory(ST.running_count_exact(stream(spark, replay_dir), "user_id", "event_id", "et"), "rc")
    got = set(rows(out.select(F.col("id").alias("event_id"), "running_count")))
    want = rows(A.running_count(ev.select("event_id", "user_id", "ts"), ["user_id"], ORDER)
                .filter(F.col("ts") < last_ts(ev)).select("event_id", "running_count"))
    assert got == set(want)


def test_state_machine_exact_stream(spark, ev, replay_dir):
    fsm = P.StateMachine({("idle", "view"): "viewed", ("viewed", "purchase"): "paid",
                          ("paid", "error"): "matched"}, "idle", {"matched"})
    out = run_memory(ST.state_machine_exact(stream(spark, replay_dir), "user_id", "event_id", "et",
                                            "event_type", fsm), "fsm")
    got = rows(out.select(F.col("id").alias("event_id"), "state"))
    want = rows(P.run_state_machine(ev.select("user_id", "event_id", "ts", "event_type"), ["user_id"], ORDER,
                                    "event_type", fsm).filter(F.col("ts") < last_ts(ev)).select("event_id", "state"))
    assert got == want


def test_previous_event_stream(spark, ev, replay_dir):
    out = run_memory(ST.previous_event(stream(spark, replay_dir), "user_id", "event_id", "et",
                                       "event_type"), "prev")
    got = rows(out.select(F.col("id").alias("event_id"), "prev_id"))
    from eventide.operators.sequence import KeyedSequence
    seq = KeyedSequence(["user_id"], ORDER)
    b = seq.finish(seq.lag(seq.prepare(ev), ["event_id"], 1))
    want = rows(b.filter(F.col("ts") < last_ts(ev)).select("event_id", F.col("prev1.event_id").alias("prev_id")))
    assert got == want


def test_followed_by_exact_stream(spark, ev, replay_dir):
    s = stream(spark, replay_dir)
    out = run_memory(ST.followed_by_exact(s, "user_id", "event_id", "et",
                                          F.col("event_type") == "view",
                                          F.col("event_type") == "purchase", "6 hours"), "fb")
    got = {(r.first_id, r.then_id) for r in out.filter("kind = 'match'").collect()}
    m, _ = P.followed_by(ev, ["user_id"], ORDER, "ts", F.col("event_type") == "view",
                         F.col("event_type") == "purchase", "6 hours", ["event_id", "ts"])
    want = {(r.first_event_id, r.then_event_id) for r in m.collect()}
    assert got == want
    timeouts = {r.first_id for r in out.filter("kind = 'timeout'").collect()}
    assert not (timeouts & {a for a, _ in want})


def test_buffer_flush_exact_stream(spark, ev, replay_dir):
    out = run_memory(ST.buffer_flush_exact(stream(spark, replay_dir), "user_id", "event_id", "et",
                                           "1 day"), "buf")
    got = rows(out.select(F.col("id").alias("event_id"), "position"))
    want = N.buffer_flush(ev.select("user_id", "event_id", "ts"), ["user_id"], "ts", "1 day", ORDER)
    want = {(r.event_id, r.position) for r in want.collect()}
    assert len(got) > 8000 and set(got) <= want


def test_late_router_stream_equals_batch(spark, ev):
    arrival = ev.withColumn("arrival_ts", F.col("ts") + F.make_dt_interval(
        secs=(F.col("event_id") % 7) * 600)).select("event_id", "ts", "arrival_ts")
    path = tempfile.mkdtemp(prefix="replay-late-", dir="/tmp") + "/events"
    write_replay_files(arrival, path, 4, ["arrival_ts", "event_id"])
    st = replay(spark, path, arrival.schema)
    outdir = tempfile.mkdtemp(prefix="late-out-", dir="/tmp")
    router = K.LateRouter("ts", ["arrival_ts", "event_id"], "30 minutes", K.parquet_writer(outdir),
                          lateness="10 minutes")
    q = K.start_batches(st, router, "late", trigger=NOW)
    q.awaitTermination(300)
    got = rows(spark.read.parquet(outdir).select("event_id", "route"))
    want = rows(L.late_split(arrival, "ts", ["arrival_ts", "event_id"], "30 minutes",
                             lateness="10 minutes").select("event_id", "route"))
    assert got == want


def test_reconcile_exact_fixture_f1(spark):
    rows_l = [("n1", 11), ("n2", 12), ("n3", 13), ("n4", 14)]
    mk = lambda data, side: spark.createDataFrame(
        [(int(k[1:]), i, ts) for i, (k, ts) in enumerate(data)], "key long, id long, ms long")
    left, right = mk(rows_l, "l"), mk(rows_l, "r")
    path = tempfile.mkdtemp(prefix="recon-", dir="/tmp")
    far = spark.createDataFrame([(-1, -1, 10**9)], "key long, id long, ms long")  # closes the stream
    left.withColumn("side", F.lit("left")).unionByName(right.withColumn("side", F.lit("right"))) \
        .unionByName(far.withColumn("side", F.lit("left"))).unionByName(far.withColumn("side", F.lit("right"))) \
        .write.parquet(path + "/in")
    st = spark.readStream.schema("key long, id long, ms long, side string").parquet(path + "/in")
    st = st.withColumn("et", F.timestamp_millis("ms"))
    out = run_memory(ST.reconcile_exact(st.filter("side = 'left'"), st.filter("side = 'right'"),
                                        "key", "id", "et", "5 seconds"), "recon")
    st_counts = {r.status: r["count"] for r in out.groupBy("status").count().collect()}
    assert st_counts == {"matched": 4}


def _fifo_reconcile(rows, within_us):
    """Brute force: per user, in (ts, id) order, a row first fails the waiting
    rows whose deadline passed, then takes the oldest waiting row of the other
    side or waits itself."""
    from collections import defaultdict
    by_user = defaultdict(list)
    for r in rows:
        by_user[r["user_id"]].append(r)
    matched, alone = set(), set()
    for user, rs in by_user.items():
        waiting = {"left": [], "right": []}
        for r in sorted(rs, key=lambda r: (r["ts_us"], r["event_id"])):
            for side in waiting:
                while waiting[side] and waiting[side][0][1] + within_us < r["ts_us"]:
                    alone.add(waiting[side].pop(0)[0])
            me = "left" if r["event_type"] == "view" else "right"
            other = "right" if me == "left" else "left"
            if waiting[other]:
                o = waiting[other].pop(0)[0]
                matched.add((r["event_id"], o) if me == "left" else (o, r["event_id"]))
            else:
                waiting[me].append((r["event_id"], r["ts_us"]))
        for side in waiting:
            alone.update(v[0] for v in waiting[side])
    return matched, alone


def test_stream_reconcile_equals_brute_force(spark):
    import __spark_entry__ as entry
    from .conftest import SF001
    ev = (events(spark, SF001).filter("event_type IN ('view', 'purchase')")
          .select("event_id", "user_id", "event_type", F.unix_micros(F.col("ts").cast("timestamp"))
                  .alias("ts_us")).collect())
    matched, alone = _fifo_reconcile([r.asDict() for r in ev], 5 * 3600 * 1_000_000)
    for name in ("stream_reconcile", "reconcile_one_to_one"):
        out = entry.queries()[name](spark, SF001).collect()
        got_pairs = {(r.l_event_id, r.r_event_id) for r in out if r.status == "matched"}
        got_alone = {r.l_event_id if r.status == "left_only" else r.r_event_id
                     for r in out if r.status != "matched"}
        assert got_pairs == matched and got_alone == alone


def _replayed(spark, batches):
    """A stream of one file per micro-batch; rows ``(id, user, seconds, type)``."""
    import time
    path = tempfile.mkdtemp(prefix="batches-", dir="/tmp") + "/in"
    for rows_ in batches:
        spark.createDataFrame(rows_, "event_id long, user_id long, s long, event_type string") \
            .coalesce(1).write.mode("append").parquet(path)
        time.sleep(1.1)  # files are taken by age
    st = spark.readStream.schema("event_id long, user_id long, s long, event_type string") \
        .option("maxFilesPerTrigger", 1).parquet(path)
    return st.withColumn("et", F.timestamp_seconds("s"))


CLOSE = [(-1, -1, 10**7, "view"), (-2, -1, 10**7, "purchase")]


def test_no_match_backwards_in_time(spark):
    """The purchase at 40 s arrives after the view at 100 s: no match, a timeout."""
    st = _replayed(spark, [[(1, 7, 100, "view")], [(2, 7, 40, "purchase")], CLOSE])
    out = run_memory(ST.followed_by_exact(st, "user_id", "event_id", "et", F.col("event_type") == "view",
                                          F.col("event_type") == "purchase", "1 hour", "2 minutes"), "backwards")
    assert [(r.first_id, r.kind) for r in out.collect()] == [(1, "timeout")]


def test_reconcile_keeps_its_bound_for_late_rows(spark):
    st = _replayed(spark, [[(1, 7, 100, "view")], [(2, 7, 40, "purchase"), (3, 7, 97, "purchase")], CLOSE])
    out = run_memory(ST.reconcile_exact(st.filter("event_type = 'view'"), st.filter("event_type = 'purchase'"),
                                        "user_id", "event_id", "et", "5 seconds", "2 minutes"), "bound")
    assert sorted((r.l_id or 0, r.r_id or 0, r.status) for r in out.collect()) == [
        (0, 2, "right_only"), (1, 3, "matched")]


def test_null_keys_on_stateful_streams(spark):
    st = _replayed(spark, [[(1, None, 10, "view"), (2, None, 20, "view")], [(3, None, 30, "view")], CLOSE])
    out = run_memory(ST.running_count_exact(st, "user_id", "event_id", "et", "1 minute"), "nullkeys")
    assert sorted((r.id, r.running_count) for r in out.collect()) == [(1, 1), (2, 2), (3, 3)]
