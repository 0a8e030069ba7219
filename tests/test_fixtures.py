"""Literal fixtures (FIXTURES.md §1, §3) with their derived expected rows."""

import tempfile

import pytest
from pyspark.sql import functions as F

from eventide.functions import scalar as U
from eventide.operators import joins as J
from eventide.operators import late as L
from eventide.operators import patterns as P
from eventide.operators import windows as W
from eventide.sources import jdbc as D


def ts_frame(spark, data, schema):
    return spark.createDataFrame(data, schema)


def ms(col):
    c = F.col(col) if isinstance(col, str) else col
    return F.timestamp_millis(c).cast("timestamp_ntz")


# The literal rows and results below are those of FIXTURES.md
# (F1-F4, X1-X9), named in each section.

# ---- F1 / X1: reconciliation --------------------------------------------
def test_f1_reconcile_all_matched(spark):
    left = spark.createDataFrame([("n1", 11), ("n2", 12), ("n3", 13), ("n4", 14)], "k string, t int") \
        .select("k", F.col("t").cast("long").alias("l_id"), ms("t").alias("l_ts"))
    right = spark.createDataFrame([("n1", 11, "1"), ("n2", 12, "2"), ("n3", 13, "3"), ("n4", 14, "4")],
                                  "k string, t int, v string") \
        .select("k", F.col("t").cast("long").alias("r_id"), ms("t").alias("r_ts"))
    out = J.reconcile(left, right, ["k"], "l_ts", "r_ts", "l_id", "r_id", 5)
    assert sorted(r.status for r in out.collect()) == ["matched"] * 4


def test_x1_reconcile_one_sided(spark):
    left = spark.createDataFrame([("a", 1, 0), ("b", 2, 1000)], "k string, l_id long, t long") \
        .select("k", "l_id", ms("t").alias("l_ts"))
    right = spark.createDataFrame([("a", 3, 2000), ("c", 4, 3000)], "k string, r_id long, t long") \
        .select("k", "r_id", ms("t").alias("r_ts"))
    out = {(r.k, r.status) for r in
           J.reconcile(left, right, ["k"], "l_ts", "r_ts", "l_id", "r_id", 5).collect()}
    assert out == {("a", "matched"), ("b", "left_only"), ("c", "right_only")}


# ---- F2: interval join, window co-group, window join ----------------------
@pytest.fixture
def f2(spark):
    left = spark.createDataFrame([("t1", 1000), ("t2", 2000), ("t3", 3000)], "k string, t long") \
        .select("k", F.col("t").alias("l_id"), ms("t").alias("l_ts"))
    right = spark.createDataFrame([("t1", 1100), ("t2", 2100), ("t3", 3100)], "k string, t long") \
        .select("k", F.col("t").alias("r_id"), ms("t").alias("r_ts"))
    return left, right


def test_f2_interval_join(f2):
    left, right = f2
    assert J.interval_join(left, right, ["k"], "l_ts", "r_ts", 1000, 5000).count() == 0
    assert J.interval_join(left, right, ["k"], "l_ts", "r_ts", 0, 0.2).count() == 3


def test_f2_window_join_and_cogroup(f2):
    left, right = f2
    wj = J.window_join(left, right, ["k"], "l_ts", "r_ts", 1)
    assert sorted((r.l_id, r.r_id) for r in wj.collect()) == [(1000, 1100), (2000, 2100), (3000, 3100)]
    cg = J.window_cogroup(left, right, ["k"], "l_ts", "r_ts", "l_id", "r_id", 1).collect()
    assert len(cg) == 3 and all(r.n_left == 1 and r.n_right == 1 for r in cg)


# ---- F3: previous event + broadcast rule ----------------------------------
def test_f3_previous_and_last_rule(spark):
    ev = spark.createDataFrame(
        [("n1", "login", 0), ("n2", "pay", 1), ("n3", "order", 2), ("n4", "login", 3), ("n1", "login", 4)],
        "user string, action string, id long").withColumn("ts", ms("id"))
    # the reference keeps only the last rule: a rule table whose last entry wins
    rules = spark.createDataFrame([(0, "login", "order"), (0, "login", "pay")],
                                  "t long, rule_prev string, rule_next string") \
        .select(ms("t").alias("rule_ts"), "rule_prev", "rule_next")
    out = J.previous_with_rule(ev, rules, ["user"], ["ts", "id"], "ts", ["id", "action"]).collect()
    assert len(out) == 5
    prevs = {r.id: (r.prev.action if r.prev else None) for r in out}
    assert prevs == {0: None, 1: None, 2: None, 3: None, 4: "login"}
    assert {(r.rule.rule_prev, r.rule.rule_next) for r in out} == {("login", "pay")}


# ---- F4: connect two types -------------------------------------------------
def test_f4_connect_map(spark):
    a = spark.createDataFrame([(i,) for i in range(1, 7)], "x long")
    b = spark.createDataFrame([(str(i),) for i in range(100, 105)], "s string")
    out = J.connect_map(a, b, U.wrap_int("x"), U.digits_to_int("s")).collect()
    assert len(out) == 11 and sorted(r.v for r in out) == [1, 2, 3, 4, 5, 6, 100, 101, 102, 103, 104]


# ---- X2: offset window; X3 is in test_sequence ---------------------------
def test_x2_offset_window(spark):
    df = spark.createDataFrame([("2024-01-01 00:00:05",)], "t string") \
        .select(F.to_timestamp_ntz("t").alias("ts"))
    r = df.select(W.tumbling("ts", 30, 10).alias("w")).first().w
    assert (str(r.start), str(r.end)) == ("2023-12-31 23:59:40", "2024-01-01 00:00:10")


# ---- X4 / X5: followed-by limit and no-skip -------------------------------
def _fb(spark, data, within="300 seconds"):
    df = spark.createDataFrame(data, "k string, id long, typ string, t long").withColumn("ts", ms("t"))
    return P.followed_by(df, ["k"], ["ts", "id"], "ts", F.col("typ") == "create",
                         F.col("typ") == "pay", within, ["id", "ts"])


def test_x4_within_is_strict(spark):
    m, t = _fb(spark, [("a", 1, "create", 0), ("a", 2, "pay", 299_999)])
    assert m.count() == 1 and t.count() == 0
    m, t = _fb(spark, [("a", 1, "create", 0), ("a", 2, "pay", 300_000)])
    assert m.count() == 0 and t.count() == 1


def test_x5_no_skip_two_matches_same_pay(spark):
    m, _ = _fb(spark, [("a", 1, "create", 0), ("a", 2, "create", 1000), ("a", 3, "order", 2000),
                       ("a", 4, "pay", 3000)])
    assert sorted((r.first_id, r.then_id) for r in m.collect()) == [(1, 4), (2, 4)]


# ---- X6: consecutive ---------------------------------------------------------
def test_x6_consecutive_overlapping(spark):
    df = spark.createDataFrame([("a", i, age, i * 1000) for i, age in enumerate([5, 6, 7, 8])],
                               "k string, id long, age int, t long").withColumn("ts", ms("t"))
    out = P.consecutive(df, ["k"], ["ts", "id"], F.col("age") > 4, 3, ["id"]).collect()
    assert sorted((r.e1_id, r.e2_id, r.e3_id) for r in out) == [(0, 1, 2), (1, 2, 3)]


def test_strict_sequence_chunked_equals_plain(spark):
    from eventide.sources.tables import events
    ev = events(spark, "/root/testdata/sf0.01")
    conds = [F.col("value") > 40, F.col("value") > 60, F.col("value") > 80]
    a = P.strict_sequence(ev, ["user_id"], ["ts", "event_id"], conds, ["event_id"])
    b = P.strict_sequence(ev, ["user_id"], ["ts", "event_id"], conds, ["event_id"],
                          chunks=34)
    assert sorted(a.collect()) == sorted(b.collect())


def test_state_machine_chunked_equals_plain(spark):
    from eventide.sources.tables import events
    ev = events(spark, "/root/testdata/sf0.01").select("user_id", "event_id", "ts", "event_type")
    fsm = P.StateMachine({("idle", "view"): "viewed", ("viewed", "purchase"): "paid",
                          ("paid", "error"): "matched"}, "idle", {"matched"})
    a = P.run_state_machine(ev, ["user_id"], ["ts", "event_id"], "event_type", fsm)
    b = P.run_state_machine(ev, ["user_id"], ["ts", "event_id"], "event_type", fsm,
                            chunks=34)
    assert sorted(a.select("event_id", "state").collect()) == sorted(b.select("event_id", "state").collect())


# ---- X7: late rule ------------------------------------------------------------
def test_x7_late_rule(spark):
    arrivals = [5, 31, 6, 35, 7]
    df = spark.createDataFrame([(i, s * 1000) for i, s in enumerate(arrivals)], "id long, t long") \
        .withColumn("ts", ms("t"))
    out = L.late_split(df, "ts", ["id"], 30, delay=0, lateness=5).collect()
    routes = {r.id: r.route for r in out}
    assert routes == {0: "on_time", 1: "on_time", 2: "late", 3: "on_time", 4: "too_late"}


def test_late_rule_sliding_windows(spark):
    # window 30 s sliding by 10 s, lateness 5 s.  Row 2 (ts 5 s) arrives after
    # ts 32 s: its windows end at 10, 20, 30 s; the last (30 s) is still open
    # for late rows, so the row is late, counted only in [0 s, 30 s).
    df = spark.createDataFrame([(0, 1), (1, 32), (2, 5), (3, 40), (4, 6)], "id long, s long") \
        .withColumn("ts", ms(F.col("s") * 1000))
    routed = L.late_split(df, "ts", ["id"], 30, slide=10, lateness=5)
    assert {r.id: r.route for r in routed.collect()} == \
        {0: "on_time", 1: "on_time", 2: "late", 3: "on_time", 4: "too_late"}
    counts = {(r.window_start.second if r.window_start.minute == 0 else r.window_start.second - 60,
               r.n_on_time, r.n_late)
              for r in L.late_window_counts(routed, "ts", 30, slide=10, lateness=5).collect()}
    assert (0, 1, 1) in counts          # [0, 30): row 0 on time, row 2 late
    assert (-20, 1, 0) in counts        # [-20, 10): only row 0; rows 2, 4 too late there


def test_late_split_chunked_equals_plain(spark):
    from eventide.sources.tables import events
    ev = events(spark, "/root/testdata/sf0.01").select("event_id", "ts")
    ev = ev.withColumn("arrival_ts", F.col("ts") + F.make_dt_interval(secs=(F.col("event_id") % 7) * 600))
    a = L.late_split(ev, "ts", ["arrival_ts", "event_id"], "30 minutes", lateness="10 minutes")
    b = L.late_split(ev, "ts", ["arrival_ts", "event_id"], "30 minutes", lateness="10 minutes",
                     chunks=20)
    assert sorted(a.select("event_id", "route").collect()) == sorted(b.select("event_id", "route").collect())


# ---- X8 / X9: string hash and int wrap ---------------------------------------
def test_x8_java_hash(spark):
    df = spark.createDataFrame([("per1",), ("n9",), ("",), ("héllo wörld 日本",), ("😀x",)], "s string")
    assert [r.h for r in df.select(U.java_hash("s").alias("h")).collect()] == \
        [3437236, 3467, 0, 1120650894, 54959989]
    U.register_sql_functions(spark)
    df.createOrReplaceTempView("hs")
    assert [r[0] for r in spark.sql("SELECT JVM_HASH(s) FROM hs").collect()] == \
        [3437236, 3467, 0, 1120650894, 54959989]


def test_x9_wrap_to_int(spark):
    df = spark.createDataFrame([(4294967297,), (4294967295,)], "x long")
    assert [r.v for r in df.select(U.wrap_int("x").alias("v")).collect()] == [1, -1]


# ---- S3 / K4: JDBC round trip on an in-process (embedded, in-memory) database ----
def test_jdbc_roundtrip(spark):
    url = "jdbc:derby:memory:eventide_test;create=true"
    props = {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}
    df = spark.createDataFrame([(f"k{i % 3}", i) for i in range(50)], "key string, cnt long")
    D.write_jdbc(df, url, "counts", mode="overwrite", batchsize=1000, properties=props)
    back = D.read_jdbc(spark, url, "counts", partition_column="cnt", num_partitions=4, properties=props)
    assert back.rdd.getNumPartitions() == 4
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, df.collect()))
    # the streaming writer skips a replayed batch id
    w = D.jdbc_batch_writer(url, "counts_log", properties=props)
    w(df, 0)
    w(df, 0)
    assert D.read_jdbc(spark, url, "counts_log", properties=props).count() == 50
    # what a failed first try of batch 1 left is replaced
    D.write_jdbc(df.limit(7).withColumn("batch_id", F.lit(1).cast("long")), url, "counts_log", properties=props)
    w(df, 1)
    assert D.read_jdbc(spark, url, "counts_log", properties=props).count() == 100


def test_console_noop_and_file_sinks(spark):
    from eventide.sources.tables import EVENTS_SCHEMA, events
    from eventide.streaming import sinks as K
    from eventide.streaming.replay import replay, write_replay_files
    src = tempfile.mkdtemp(prefix="sink-src-", dir="/tmp") + "/events"
    write_replay_files(events(spark, "/root/testdata/sf0.001"), src, 2, ["ts", "event_id"])
    st = replay(spark, src, EVENTS_SCHEMA)
    q = K.start(st.select("event_id"), "noop", "noop-test", trigger={"availableNow": True})
    q.awaitTermination(120)
    out = tempfile.mkdtemp(prefix="sink-", dir="/tmp")
    q = K.start(st.select(F.col("event_type").alias("value")), "text", "text-test",
                trigger={"availableNow": True}, path=out, maxRecordsPerFile=200)
    q.awaitTermination(120)
    assert spark.read.text(out).count() == 1000


def test_strings_that_are_no_numbers_raise(spark):
    df = spark.createDataFrame([("12",), ("-3",), ("x12y",), ("99999999999",)], "s string")
    assert [r.v for r in df.select(U.to_int("s", strict=False).alias("v")).collect()] == [12, -3, None, None]
    with pytest.raises(Exception):
        df.filter("s = 'x12y'").select(U.to_int("s").alias("v")).collect()
    assert df.select(U.digits_to_int("s", strict=False).alias("v")).collect()[2].v == 12


def test_update_log_of_a_sum(spark):
    from eventide.operators import aggregates as A
    df = spark.createDataFrame([("a", 1, 5), ("a", 2, 8)], "k string, id long, total long")
    out = A.update_log(df, ["k"], "total", order=["id"]).collect()
    assert sorted((r.id, r.seq, r.op, r.cnt) for r in out) == [(1, 0, "+I", 5), (2, 0, "-U", 5), (2, 1, "+U", 8)]


def test_hash_time_is_linear_and_total(spark):
    texts = ["", "a" * 200_000, "😀" * 50_000, "é\U0010ffff x"]

    def units(s):
        h, b = 0, s.encode("utf-16-be")
        for i in range(0, len(b), 2):
            h = (31 * h + int.from_bytes(b[i:i + 2], "big")) & 0xFFFFFFFF
        return h - (1 << 32) if h >= 1 << 31 else h
    got = spark.createDataFrame([(t,) for t in texts], "s string").select(U.java_hash("s").alias("h")).collect()
    assert [r.h for r in got] == [units(t) for t in texts]
    assert spark.sql("SELECT CAST(NULL AS STRING) AS s").select(U.java_hash("s").alias("h")).first().h is None
