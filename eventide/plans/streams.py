"""Streaming forms as registered queries.

Each query replays ``events`` as a stream of ordered files written under
``spark.checkpoint.dir``, runs the streaming operator to the end of the input
(``availableNow``) into a parquet sink there, and returns the sink read back.
The oracle is the full batch SQL: stream = batch.  A closing row far in the
future moves the watermark past all windows and timers.  Queries on keyed state
are replayed in order of arrival, out of event-time order by up to an hour, with
a watermark delay of two hours.
"""

from __future__ import annotations

import math
import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import joins as J
from ..operators import patterns as P
from ..session import num_partitions, state_location
from ..sources.stored_stream import stored_rows
from ..sources.tables import events, table_path
from ..streaming import operators as S
from ..streaming import sinks as K
from ..streaming import stateful as ST
from ..streaming.replay import replay, with_event_time, write_replay_files
from ..streaming.rolling import read_rolled, start_rolling
from . import joined, patterns
from .registry import ORACLE, query

MIN_BATCHES = 4                  # a small table still crosses micro-batch borders
ROWS_PER_TRIGGER = 1_000_000     # of a micro-batch
ROWS_PER_FILE = 50_000           # a file is a task: a larger micro-batch is read by many
ORDER = ["ts", "event_id"]
ARRIVAL = ["arrival_ts", "event_id"]
DELAY = "2 hours"                # arrivals are at most one hour late


def _closing(source: DataFrame) -> DataFrame:
    """Rows far in the future: they move the watermark past everything, so that all
    windows close and all timers fire, and are themselves never reported."""
    far = {c: F.col(c) + F.expr("INTERVAL 3650 DAYS") for c in ("ts", "arrival_ts") if c in source.columns}
    last = source.agg(*[F.max(c).alias(c) for c in far]).select(*[e.alias(c) for c, e in far.items()])
    kinds = F.explode(F.array(F.lit("view"), F.lit("purchase")))
    given = {**{c: F.col(c) for c in far}, "event_id": F.lit(-1), "user_id": F.lit(-1), "event_type": kinds}
    return last.select(*[given.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) if f.name != "event_type"
                         else kinds.alias(f.name) for f in source.schema])


def _cut(*n_rows: int) -> tuple[int, int]:
    """How many micro-batches sources of so many rows make, and files of each."""
    most = max(n_rows)
    batches = max(MIN_BATCHES, math.ceil(most / ROWS_PER_TRIGGER))
    return batches, max(1, math.ceil(most / batches / ROWS_PER_FILE))


def _state_partitions(spark: SparkSession, batches: int, files: int) -> int:
    """Tasks of a micro-batch on state: whole waves of the cores, enough for its files and one
    per ``ROWS_PER_TRIGGER`` rows of the table, whose keys are in state; at most those of the session."""
    cores = max(1, spark.sparkContext.defaultParallelism)
    return min(num_partitions(spark), math.ceil(max(batches, files) / cores) * cores)


def _replayed(spark: SparkSession, source: DataFrame, path: str, order: list[str], batches: int, files: int,
              close: bool = True) -> DataFrame:
    """``source`` (with closing rows if ``close``) as a stream of so many micro-batches."""
    rows = source.unionByName(_closing(source)) if close else source
    return replay(spark, write_replay_files(rows, path, batches * files, order), source.schema, files)


def _run(spark: SparkSession, name: str, source: DataFrame, order: list[str], build,
         mode: str = "append", batch_fn=None, close: bool = True) -> DataFrame:
    """Replay ``source`` (with closing rows if ``close``), apply ``build`` to the
    stream, run it to the end of the input and return what the sink holds."""
    base, cut = state_location(spark, name), _cut(source.count())
    stream = _replayed(spark, source, os.path.join(base, "in"), order, *cut, close)
    out_path = os.path.join(base, "out")
    where = {"trigger": {"availableNow": True}, "checkpoint": os.path.join(base, "ckpt")}
    with K.state_partitions(spark, _state_partitions(spark, *cut)):
        out = build(stream)
        q = (K.start(out, "parquet", name, mode, path=out_path, **where) if batch_fn is None
             else K.start_batches(out, batch_fn(out_path), name, mode, **where))
    q.awaitTermination()
    read = spark.read.schema(out.schema) if batch_fn is None else spark.read
    return read.parquet(out_path)


def _run_two(spark: SparkSession, name: str, sources: list[tuple[DataFrame, list[str]]], build) -> DataFrame:
    """Like :func:`_run` with a replayed stream per source, all closed."""
    base = state_location(spark, name)
    cut = _cut(*[source.count() for source, _ in sources])
    streams = [_replayed(spark, source, os.path.join(base, f"in{i}"), order, *cut)
               for i, (source, order) in enumerate(sources)]
    path = os.path.join(base, "out")
    with K.state_partitions(spark, _state_partitions(spark, *cut)):
        out = build(*streams)
        q = K.start(out, "parquet", name, "append", path=path, trigger={"availableNow": True},
                    checkpoint=os.path.join(base, "ckpt"))
    q.awaitTermination()
    return spark.read.schema(out.schema).parquet(path)


def _ts(col: str):
    """Stateful outputs carry epoch microseconds; back to the stored type."""
    return F.timestamp_micros(F.col(col)).cast("timestamp_ntz")


def _arrivals(spark, sf_dir, *cols: str) -> DataFrame:
    """Events with an arrival time up to an hour after their own."""
    return events(spark, sf_dir).select(*cols).withColumn("arrival_ts", patterns.arrival_ts())


@query("stream_running_count", ORACLE["running_count"])
def stream_running_count(spark, sf_dir):
    """A1 exact on a stream (value state): one row per event."""
    ev = _arrivals(spark, sf_dir, "event_id", "user_id", "ts")
    out = _run(spark, "running_count", ev, ARRIVAL,
               lambda s: ST.running_count_exact(with_event_time(s), "user_id", "event_id", "et", DELAY, ST.buckets_for(spark)))
    return out.select(F.col("id").alias("event_id"), F.col("key").alias("user_id"), _ts("ts").alias("ts"),
                      "running_count")


@query("stream_count_by_key", ORACLE["count_by_key"])
def stream_count_by_key(spark, sf_dir):
    """A6 + K3 stream: update-mode running counts; every micro-batch's
    updates are kept, and the latest update of each key is the result."""
    ev = events(spark, sf_dir).select("event_id", "user_id", "ts")
    out = _run(spark, "count_by_key", ev, ORDER, lambda s: S.running_counts(s, ["user_id"]),
               mode="update", batch_fn=K.parquet_writer, close=False)
    return (out.groupBy("user_id").agg(F.max_by("cnt", "batch").alias("cnt")))


@query("stream_fsm", patterns._FSM + """
SELECT user_id, event_id, ts, state, state = 'matched' AS accepted FROM walk""")
def stream_fsm(spark, sf_dir):
    """C5 exact on a stream (value state per user)."""
    fsm = P.StateMachine(patterns.FSM_TRANSITIONS, patterns.FSM_START, patterns.FSM_ACCEPT)
    ev = _arrivals(spark, sf_dir, "event_id", "user_id", "ts", "event_type")
    out = _run(spark, "fsm", ev, ARRIVAL, lambda s: ST.state_machine_exact(
        with_event_time(s), "user_id", "event_id", "et", "event_type", fsm, DELAY, ST.buckets_for(spark)))
    return out.select(F.col("key").alias("user_id"), F.col("id").alias("event_id"), _ts("ts").alias("ts"),
                      "state", "accepted")


@query("stream_prev_event_rule", ORACLE["prev_event_rule"])
def stream_prev_event_rule(spark, sf_dir):
    """J5 on a stream: previous event per user in value state; per micro-batch the
    rule in force is carried forward over the batch (rules re-read each batch)."""
    ev = _arrivals(spark, sf_dir, "event_id", "user_id", "ts", "event_type")

    def writer(path):
        write = K.parquet_writer(path)
        return lambda df, i: write(J.with_rule(
            df.withColumn("ts", _ts("ts")), joined.rules_frame(df.sparkSession), "ts", order=["id"]), i)
    out = _run(spark, "prev_event_rule", ev, ARRIVAL, lambda s: ST.previous_event(
        with_event_time(s), "user_id", "event_id", "et", "event_type", DELAY, ST.buckets_for(spark)), batch_fn=writer)
    rule_prev, rule_next = F.col("rule.rule_prev"), F.col("rule.rule_next")
    return out.select(
        F.col("id").alias("event_id"), F.col("key").alias("user_id"), "ts", F.col("type").alias("event_type"),
        F.col("prev_id").alias("prev_event_id"), F.col("prev_type").alias("prev_event_type"),
        rule_prev.alias("rule_prev"), rule_next.alias("rule_next"),
        F.coalesce((F.col("prev_type") == rule_prev) & (F.col("type") == rule_next), F.lit(False)).alias("matched"))


@query("stream_late_split", ORACLE["late_split"])
def stream_late_split(spark, sf_dir):
    """T6 exact on a stream: arrivals replayed in arrival order, routed per row
    against the highest event time seen before (state file per batch)."""
    ev = (events(spark, sf_dir).select("event_id", "ts")
          .withColumn("arrival_ts", patterns.arrival_ts()))
    router = lambda path: K.LateRouter("ts", ["arrival_ts", "event_id"], "30 minutes",
                                       K.parquet_writer(path), lateness="10 minutes")
    out = _run(spark, "late_split", ev, ARRIVAL, lambda s: s, batch_fn=router, close=False)
    return out.drop("batch")


@query("stream_late_firings", patterns._LATE + """,
n AS (SELECT window_start, window_end, count(*) AS cnt FROM r WHERE route = 'on_time' GROUP BY ALL)
SELECT window_start, window_end, 0::BIGINT AS firing, cnt, NULL::BIGINT AS event_id
FROM n WHERE window_end <= (SELECT max(ts) FROM events)
UNION ALL
SELECT r.window_start, r.window_end, row_number() OVER w AS firing, coalesce(cnt, 0) + row_number() OVER w, event_id
FROM r LEFT JOIN n ON r.window_start = n.window_start WHERE route = 'late'
WINDOW w AS (PARTITION BY r.window_start ORDER BY arrival_ts, event_id)""")
def stream_late_firings(spark, sf_dir):
    """T5 exact on a stream: the on-time firing of each 30 min window and one corrected
    firing per late row, until 10 minutes after its end."""
    ev = _arrivals(spark, sf_dir, "event_id", "ts")
    firings = lambda path: K.LateFirings("ts", ARRIVAL, "30 minutes", K.parquet_writer(path),
                                         "event_id", lateness="10 minutes")
    out = _run(spark, "late_firings", ev, ARRIVAL, lambda s: s, batch_fn=firings, close=False)
    return out.drop("batch")


def _followed(spark, sf_dir):
    ev = _arrivals(spark, sf_dir, "event_id", "user_id", "ts", "event_type")
    return _run(spark, "followed_by", ev, ARRIVAL, lambda s: ST.followed_by_exact(
        with_event_time(s), "user_id", "event_id", "et", F.col("event_type") == "view",
        F.col("event_type") == "purchase", "1 hour", DELAY, ST.buckets_for(spark)))


@query("stream_followed_by", ORACLE["cep_followed_by"])
def stream_followed_by(spark, sf_dir):
    """C1 exact on a stream: open views in list state; the completed matches."""
    return _followed(spark, sf_dir).filter("kind = 'match'").select(
        F.col("key").alias("user_id"), F.col("first_id").alias("first_event_id"),
        _ts("first_ts").alias("first_ts"), F.col("then_id").alias("then_event_id"),
        _ts("then_ts").alias("then_ts"))


@query("stream_cep_timeout", ORACLE["cep_timeout"])
def stream_cep_timeout(spark, sf_dir):
    """C4 + O3 exact on a stream: views that timed out after 1 h."""
    return _followed(spark, sf_dir).filter("kind = 'timeout'").select(
        F.col("key").alias("user_id"), F.col("first_id").alias("first_event_id"),
        _ts("first_ts").alias("first_ts"), _ts("then_ts").alias("timeout_ts"))


@query("stream_interval_join", ORACLE["interval_join_wide"])
def stream_interval_join(spark, sf_dir):
    """J1 on streams: stream-stream join, 1..24 h after a view."""
    ev = events(spark, sf_dir).select("event_id", "user_id", "ts", "event_type")

    def build(s):
        s = with_event_time(s)
        left = s.filter("event_type = 'view'").select(
            "user_id", F.col("event_id").alias("l_event_id"), F.col("et").alias("l_et"))
        right = s.filter("event_type = 'purchase'").select(
            "user_id", F.col("event_id").alias("r_event_id"), F.col("et").alias("r_et"))
        return S.interval_join(left, right, ["user_id"], "l_et", "r_et", "1 hour", "24 hours")
    out = _run(spark, "interval_join", ev, ORDER, build, close=False)
    return out.select("user_id", "l_event_id", F.col("l_et").cast("timestamp_ntz").alias("l_ts"),
                      "r_event_id", F.col("r_et").cast("timestamp_ntz").alias("r_ts"))


def _window_times(out: DataFrame, *cols) -> DataFrame:
    return out.select(F.col("window_start").cast("timestamp_ntz").alias("window_start"),
                      F.col("window_end").cast("timestamp_ntz").alias("window_end"), *cols)


@query("stream_uv_tumbling_offset", ORACLE["uv_tumbling_offset"])
def stream_uv_tumbling_offset(spark, sf_dir):
    """A5 + W1 + T3 stream: exact distinct users per 6 h window shifted by 1 h."""
    ev = _arrivals(spark, sf_dir, "event_id", "user_id", "ts")
    out = _run(spark, "uv", ev, ARRIVAL, lambda s: S.pv_uv(with_event_time(s), "et", "user_id", "6 hours",
                                                           offset="1 hour", delay=DELAY))
    return _window_times(out, "uv")


@query("stream_pv_uv_sliding", ORACLE["pv_uv_sliding"])
def stream_pv_uv_sliding(spark, sf_dir):
    """A3 + W3 + T3 stream: exact PV, UV and pv div uv over 3-day windows sliding by a day."""
    ev = _arrivals(spark, sf_dir, "event_id", "user_id", "ts")
    out = _run(spark, "pv_uv", ev, ARRIVAL, lambda s: S.pv_uv(with_event_time(s), "et", "user_id", "3 days",
                                                              "1 day", delay=DELAY))
    return _window_times(out, "pv", "uv", "ratio")


@query("stream_sql_tumble_sum", ORACLE["sql_tumble_sum"])
def stream_sql_tumble_sum(spark, sf_dir):
    """A7 + W6 + T4 stream: SQL over a streaming view, keyed sum per 1 h
    tumbling window with a watermark; append mode, closed windows."""
    ev = _arrivals(spark, sf_dir, "event_id", "ts", "event_type", "props")

    def build(s):
        return s.sparkSession.sql("""
            SELECT event_type AS key, window.start AS window_start, window.end AS window_end,
                   sum(CAST(get_json_object(props, '$.k') AS BIGINT)) AS cnt
            FROM {stream} GROUP BY event_type, window(et, '1 hour')""",
                                  stream=with_event_time(s).withWatermark("et", DELAY))
    out = _run(spark, "sql_tumble", ev, ARRIVAL, build)
    return out.select("key", F.col("window_start").cast("timestamp_ntz").alias("window_start"),
                      F.col("window_end").cast("timestamp_ntz").alias("window_end"), "cnt")


@query("stream_session_counts",
       "SELECT user_id, session_start, session_end, n_events FROM (" + ORACLE["session_counts"] + ")")
def stream_session_counts(spark, sf_dir):
    """W5 stream: session windows (gap 5 h) per user, closed sessions."""
    ev = events(spark, sf_dir).select("event_id", "user_id", "ts")
    out = _run(spark, "sessions", ev, ORDER,
               lambda s: S.sessions(with_event_time(s), "et", ["user_id"], "5 hours"))
    return out.select("user_id", F.col("session_start").cast("timestamp_ntz").alias("session_start"),
                      F.col("session_end").cast("timestamp_ntz").alias("session_end"), "n_events")


@query("stream_topn_window", ORACLE["topn_window"])
def stream_topn_window(spark, sf_dir):
    """N1 stream: daily counts in append mode, ranked per micro-batch in
    ``foreachBatch`` (a closed window arrives whole in one batch)."""
    ev = events(spark, sf_dir).select("event_id", "user_id", "ts")

    def writer(path):
        write = K.parquet_writer(path)
        return S.top_n_sink(lambda df, i: write(df.select("window_start", "window_end", "rank", "user_id",
                                                          "cnt"), i),
                            ["window_start", "window_end"], "user_id", 10)
    out = _run(spark, "topn", ev, ORDER,
               lambda s: S.windowed_counts(with_event_time(s), "et", ["user_id"], "1 day"),
               batch_fn=writer)
    return out.select(F.col("window_start").cast("timestamp_ntz").alias("window_start"),
                      F.col("window_end").cast("timestamp_ntz").alias("window_end"), "rank", "user_id", "cnt")


@query("stream_buffer_flush", ORACLE["buffer_flush"])
def stream_buffer_flush(spark, sf_dir):
    """N3 exact on a stream: list state per user flushed by hourly event-time
    timers (flushed buffers, i.e. flush times the watermark has passed)."""
    ev = _arrivals(spark, sf_dir, "event_id", "user_id", "ts")
    out = _run(spark, "buffer", ev, ARRIVAL, lambda s: ST.buffer_flush_exact(
        with_event_time(s), "user_id", "event_id", "et", "1 hour", DELAY, ST.buckets_for(spark)))
    return out.select(F.col("key").alias("user_id"), F.col("id").alias("event_id"), _ts("ts").alias("ts"),
                      _ts("flush_ts").alias("flush_ts"), "position")


@query("stream_reconcile", ORACLE["reconcile_one_to_one"])
def stream_reconcile(spark, sf_dir):
    """J4 exact one-to-one on streams: each view takes the oldest waiting
    purchase of the user (and vice versa); rows that nothing took within 5 h are
    reported alone."""
    ev = _arrivals(spark, sf_dir, "event_id", "user_id", "ts", "event_type")

    def build(s):
        s = with_event_time(s)
        return ST.reconcile_exact(s.filter("event_type = 'view'"), s.filter("event_type = 'purchase'"),
                                  "user_id", "event_id", "et", "5 hours", DELAY, ST.buckets_for(spark))
    out = _run(spark, "reconcile", ev, ARRIVAL, build)
    return out.select(F.col("key").alias("user_id"), F.col("l_id").alias("l_event_id"),
                      _ts("l_ts").alias("l_ts"), F.col("r_id").alias("r_event_id"),
                      _ts("r_ts").alias("r_ts"), "status")


@query("stream_window_join", ORACLE["window_join"])
def stream_window_join(spark, sf_dir):
    """J2 on streams: view x purchase pairs in the same 1-day window."""
    ev = events(spark, sf_dir).select("event_id", "user_id", "ts", "event_type")

    def build(s):
        s = with_event_time(s)
        left = s.filter("event_type = 'view'").select(
            "user_id", F.col("event_id").alias("l_event_id"), F.col("et").alias("l_et"))
        right = s.filter("event_type = 'purchase'").select(
            "user_id", F.col("event_id").alias("r_event_id"), F.col("et").alias("r_et"))
        return S.window_join(left, right, ["user_id"], "l_et", "r_et", "1 day")
    out = _run(spark, "window_join", ev, ORDER, build, close=False)
    return out.select("user_id", F.col("window_start").cast("timestamp_ntz").alias("window_start"),
                      F.col("window_end").cast("timestamp_ntz").alias("window_end"), "l_event_id",
                      _ts("l_et_us").alias("l_ts"), "r_event_id",
                      _ts("r_et_us").alias("r_ts"))


@query("stream_window_cogroup", ORACLE["window_cogroup"])
def stream_window_cogroup(spark, sf_dir):
    """J3 on streams: views and purchases co-grouped per (user, day)."""
    ev = events(spark, sf_dir).select("event_id", "user_id", "ts", "event_type")

    def build(s):
        s = with_event_time(s)
        return S.window_cogroup(s.filter("event_type = 'view'"), s.filter("event_type = 'purchase'"),
                                ["user_id"], "et", "et", "event_id", "event_id", "1 day")
    out = _run(spark, "cogroup", ev, ORDER, build)
    return out.withColumns({"window_start": F.col("window_start").cast("timestamp_ntz"),
                            "window_end": F.col("window_end").cast("timestamp_ntz")})


@query("stream_route_split", ORACLE["route_split"])
def stream_route_split(spark, sf_dir):
    """O1 on a stream: every route of a micro-batch written to its own sink
    (the batch is persisted once)."""
    ev = events(spark, sf_dir).select("event_id", "ts", "value")
    routes = ["low", "mid", "high"]

    def writers(path):
        def one(route):
            return lambda df, i: df.drop("route").write.mode("overwrite").parquet(
                os.path.join(path, f"route={route}", f"batch={i}"))
        return K.routed_writer("route", {r: one(r) for r in routes})
    from ..operators import routing as R
    out = _run(spark, "route_split", ev, ORDER,
               lambda s: R.route_split(s, "value", [("low", 20), ("mid", 50)], "high"),
               batch_fn=writers, close=False)
    return out.select("event_id", "value", "route")


@query("stream_update_log", ORACLE["update_log"])
def stream_update_log(spark, sf_dir):
    """A8 on a stream: the +I / -U / +U log of the exact running count."""
    from ..operators import aggregates as A
    ev = _arrivals(spark, sf_dir, "event_id", "user_id", "ts")

    def build(s):
        rc = ST.running_count_exact(with_event_time(s), "user_id", "event_id", "et", DELAY, ST.buckets_for(spark))
        rc = rc.select(F.col("id").alias("event_id"), F.col("key").alias("user_id"),
                       F.col("ts").alias("ts_us"), "running_count")
        return A.update_log(rc, ["user_id"])
    out = _run(spark, "update_log", ev, ARRIVAL, build)
    return out.select("event_id", "user_id", _ts("ts_us").alias("ts"), "op", "cnt", "seq")


def _sequence(spark, sf_dir, name, conds):
    ev = _arrivals(spark, sf_dir, "event_id", "user_id", "ts", "value")
    out = _run(spark, name, ev, ARRIVAL, lambda s: ST.strict_sequence_exact(
        with_event_time(s), "user_id", "event_id", "et", conds, DELAY, ST.buckets_for(spark)))
    cols = [F.col("key").alias("user_id")]
    for j in range(1, len(conds) + 1):
        cols += [F.col(f"e{j}_id").alias(f"e{j}_event_id"), _ts(f"e{j}_ts").alias(f"e{j}_ts")]
    return out.select(*cols)


@query("stream_consecutive", ORACLE["cep_consecutive"])
def stream_consecutive(spark, sf_dir):
    """C2 exact on a stream: value > 40 three times in a row."""
    return _sequence(spark, sf_dir, "consecutive", [F.col("value") > 40] * 3)


@query("stream_strict_sequence", ORACLE["cep_strict_sequence"])
def stream_strict_sequence(spark, sf_dir):
    """C3 exact on a stream: value > 40, > 60, > 80 on consecutive rows."""
    return _sequence(spark, sf_dir, "strict_sequence",
                     [F.col("value") > 40, F.col("value") > 60, F.col("value") > 80])


@query("stream_running_max_count", ORACLE["running_max_count"])
def stream_running_max_count(spark, sf_dir):
    """A2 on a stream: the exact per-row running count (value state) and the
    running max over all rows so far (per-batch prefix max + carried max)."""
    ev = _arrivals(spark, sf_dir, "event_id", "user_id", "ts")

    def build(s):
        rc = ST.running_count_exact(with_event_time(s), "user_id", "event_id", "et", DELAY, ST.buckets_for(spark))
        return rc.select(F.col("id").alias("event_id"), F.col("key").alias("user_id"),
                         F.col("ts").alias("ts_us"), "running_count")
    writer = lambda path: K.RunningMaxWriter("running_count", ["ts_us", "event_id"],
                                             K.parquet_writer(path), name="max_count")
    out = _run(spark, "running_max", ev, ARRIVAL, build, batch_fn=writer)
    return out.select("event_id", "user_id", _ts("ts_us").alias("ts"), "running_count", "max_count")


@query("stream_connect_map", ORACLE["connect_map"])
def stream_connect_map(spark, sf_dir):
    """J6 on streams: a stream of Long order keys and a stream of String
    customer names, each mapped to Int (wrap / digits) and merged."""
    from ..functions import scalar as U
    from ..operators import joins as J
    from ..sources.tables import read_table
    orders = read_table(spark, sf_dir, "orders").select(
        F.lit("first").alias("side"), F.col("o_orderkey").alias("k"), F.lit(None).cast("string").alias("name"))
    cust = read_table(spark, sf_dir, "customer").select(
        F.lit("second").alias("side"), F.col("c_custkey").alias("k"), F.col("c_name").alias("name"))

    def build(s):
        return J.connect_map(s.filter("side = 'first'"), s.filter("side = 'second'"),
                             U.wrap_int("k"), U.digits_to_int("name"))
    return _run(spark, "connect_map", orders.unionByName(cust), ["side", "k"], build, close=False)


_RULE_EVENTS = """SELECT ts AS rule_ts, CASE event_id % 3 WHEN 0 THEN 'view' WHEN 1 THEN 'click' ELSE 'purchase' END AS rule_prev,
       CASE event_id % 2 WHEN 0 THEN 'purchase' ELSE 'view' END AS rule_next
FROM events WHERE event_type = 'error' AND event_id % 7 = 0"""


@query("stream_rule_stream", f"""
WITH e AS (
  SELECT event_id, user_id, ts, event_type,
         lag(event_id) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS prev_event_id,
         lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS prev_event_type
  FROM events),
rules AS (SELECT rule_ts, max({{'p': rule_prev, 'n': rule_next}}) AS r FROM ({_RULE_EVENTS}) GROUP BY rule_ts)
SELECT e.*, rules.rule_ts, r.p AS rule_prev, r.n AS rule_next,
       coalesce(prev_event_type = r.p AND event_type = r.n, false) AS matched
FROM e ASOF LEFT JOIN rules ON e.ts >= rules.rule_ts
""")
def stream_rule_stream(spark, sf_dir):
    """J5 + V3: events and rules are two streams, both up to an hour out of order; some
    error events announce the rule that holds from then on."""
    ev = _arrivals(spark, sf_dir, "event_id", "user_id", "ts", "event_type")
    rules = ev.filter("event_type = 'error' AND event_id % 7 = 0").select(
        "ts", "arrival_ts", F.expr("CASE event_id % 3 WHEN 0 THEN 'view' WHEN 1 THEN 'click' ELSE 'purchase' END").alias("rule_prev"),
        F.expr("CASE event_id % 2 WHEN 0 THEN 'purchase' ELSE 'view' END").alias("rule_next"))
    out = _run_two(spark, "rule_stream", [(ev, ARRIVAL), (rules, ["arrival_ts", "ts"])], lambda e, r: ST.rule_join(
        with_event_time(e), with_event_time(r), "user_id", "event_id", "et", "event_type", ["rule_prev", "rule_next"],
        buckets=2 * num_partitions(spark), delay=DELAY, rule_delay=DELAY))
    matched = (F.col("prev_type") == F.col("rule_prev")) & (F.col("type") == F.col("rule_next"))
    return out.select(
        F.col("id").alias("event_id"), F.col("key").alias("user_id"), _ts("ts").alias("ts"), F.col("type").alias("event_type"),
        F.col("prev_id").alias("prev_event_id"), F.col("prev_type").alias("prev_event_type"),
        _ts("rule_since").alias("rule_ts"), "rule_prev", "rule_next", F.coalesce(matched, F.lit(False)).alias("matched"))


@query("stream_ttl_previous", """
SELECT event_id, user_id, ts, event_type,
       CASE WHEN prev_ts + INTERVAL 6 HOUR >= ts THEN prev_id END AS alive_event_id
FROM (SELECT event_id, user_id, ts, event_type,
             lag(event_id) OVER w AS prev_id, lag(ts) OVER w AS prev_ts
      FROM events WINDOW w AS (PARTITION BY user_id, event_type ORDER BY ts, event_id))
""")
def stream_ttl_previous(spark, sf_dir):
    """V4 in event time: the user's previous event of the type, if it is at most 6 h old
    (each write refreshes the entry)."""
    ev = _arrivals(spark, sf_dir, "event_id", "user_id", "ts", "event_type")
    out = _run(spark, "ttl", ev, ARRIVAL, lambda s: ST.ttl_previous_event_time(
        with_event_time(s), "user_id", "event_id", "et", "6 hours", F.col("event_type"), DELAY, ST.buckets_for(spark)))
    return out.select(F.col("id").alias("event_id"), F.col("key").alias("user_id"), _ts("ts").alias("ts"),
                      F.col("entry").alias("event_type"), F.col("alive_id").alias("alive_event_id"))


@query("stream_stored_rows", """
SELECT user_id, count(*) AS n, min(ts) AS first_ts, max(event_id) AS last_event_id FROM events GROUP BY user_id""")
def stream_stored_rows(spark, sf_dir):
    """S2 + K5 + K6: the table itself as a stream with offsets by file and row, in four or
    more micro-batches, written to files rolled at 64 KB with a manifest per epoch."""
    base = state_location(spark, "stored_rows")
    ev = events(spark, sf_dir).select("event_id", "user_id", "ts")
    stream = stored_rows(spark, table_path(sf_dir, "events"), ev.schema, os.path.join(base, "progress"),
                         max(1, math.ceil(ev.count() / MIN_BATCHES)))
    out = os.path.join(base, "out")
    q = start_rolling(stream, out, "stored_rows", roll_bytes=64 << 10, checkpoint=os.path.join(base, "ckpt"))
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    return (read_rolled(spark, out, ev.schema).groupBy("user_id")
            .agg(F.count("*").alias("n"), F.min("ts").alias("first_ts"), F.max("event_id").alias("last_event_id")))
