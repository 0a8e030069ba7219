"""Runnable streaming jobs: each behaviour of the reference's example jobs as
a stream over an events folder (schema ``EVENTS_SCHEMA``), built from the
operators in this package.

    python -m eventide.streaming.jobs --list
    python -m eventide.streaming.jobs pv_uv --source /data/events --sink console \
        --param size="30 seconds" --param slide="10 seconds"

A job is ``fn(stream, params) -> Job``: either a streaming DataFrame with its
output mode, or a ``foreachBatch`` function factory for jobs whose result
needs batch operators per micro-batch (ranking, routing, carried maxima).
Without ``--available-now`` the job runs until stopped; ``--trigger`` sets the
processing-time interval (the periodic checkpoint interval as well).
"""

from __future__ import annotations

import argparse
import os
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import scalar as U
from ..operators import patterns as P
from ..operators import routing as R
from ..session import build_session, state_location
from ..sources import jdbc as D
from ..sources.tables import EVENTS_SCHEMA, props_k
from . import operators as S
from . import sinks as K
from . import stateful as ST
from .replay import replay, with_event_time


@dataclass
class Job:
    df: DataFrame
    mode: str = "append"
    # foreachBatch factory: writer(df, batch_id) -> fn(batch_df, batch_id)
    batch: Callable | None = None


JOBS: dict[str, tuple[Callable[[DataFrame, dict], Job], str]] = {}

# The example jobs' own parameters, used as defaults (any of
# them can be overridden with --param key=value).
DEFAULTS: dict[str, dict] = {
    "pv_uv": {"size": "30 seconds", "slide": "10 seconds", "delay": 0},
    "window_uv": {"size": "30 seconds", "offset": "10 seconds", "delay": 0},
    "top_n": {"size": "1 minute", "n": 10, "delay": 0, "ascending": "false"},
    "top_n_processing_time": {"size": "5 seconds", "n": 5},
    "late_window_counts": {"size": "30 seconds", "delay": 0, "lateness": "5 seconds"},
    "late_split": {"size": "30 seconds", "delay": 0, "lateness": "5 seconds"},
    "late_firings": {"size": "30 seconds", "delay": 0, "lateness": "5 seconds"},
    "reconcile": {"first": "view", "then": "purchase", "within": "5 seconds"},
    "interval_join": {"first": "view", "then": "purchase", "lower": "1 second", "upper": "5 seconds"},
    "window_join": {"first": "view", "then": "purchase", "size": "1 second"},
    "window_cogroup": {"first": "view", "then": "purchase", "size": "1 second"},
    "route_split": {"low": 5.0, "mid": 7.0},
    "followed_by": {"first": "view", "then": "purchase", "within": "5 minutes"},
    "consecutive": {"thresholds": "4,4,4"},
    "state_machine": {"transitions": "idle:view:viewed;viewed:purchase:paid;paid:error:matched",
                      "start": "idle", "accept": "matched"},
    "buffer_flush": {"every": "1 second"},
    "sql_tumble": {"size": "1 second", "delay": "5 seconds"},
    "sessions": {"gap": "5 seconds"},
    "jdbc_counts": {"table": "user_counts"},
}


def job(name: str, doc: str):
    def deco(fn):
        JOBS[name] = (fn, doc)
        return fn
    return deco


def _p(params: dict, key: str, kind=str):
    """A job parameter (defaults merged in by :func:`run`)."""
    return kind(params[key]) if kind is not str or isinstance(params[key], str) else params[key]


def _sides(s: DataFrame, p: dict):
    first, then = _p(p, "first"), _p(p, "then")
    left = s.filter(F.col("event_type") == first)
    right = s.filter(F.col("event_type") == then)
    return left, right


@job("running_count", "A1: per-event running count per user (value state)")
def _running_count(s, p):
    return Job(ST.running_count_exact(s, "user_id", "event_id", "et"))


@job("key_counts", "A6/K3: running counts per user, update log per micro-batch")
def _key_counts(s, p):
    return Job(S.running_counts(s, ["user_id"]), "update")


@job("running_max", "A2: running count per user and its running max over all events")
def _running_max(s, p):
    rc = ST.running_count_exact(s, "user_id", "event_id", "et")
    return Job(rc, batch=lambda out: K.RunningMaxWriter("running_count", ["ts", "id"], out))


@job("pv_uv", "A3: PV, UV and pv div uv per sliding window (size, slide)")
def _pv_uv(s, p):
    return Job(S.pv_uv(s, "et", "user_id", _p(p, "size"), _p(p, "slide"),
                       delay=_p(p, "delay")))


@job("window_uv", "A5/W1/W7: distinct users per tumbling window with offset")
def _window_uv(s, p):
    return Job(S.pv_uv(s, "et", "user_id", _p(p, "size"),
                       offset=_p(p, "offset"), delay=_p(p, "delay")))


@job("top_n", "N1/N2/A4: top n users per tumbling window")
def _top_n(s, p):
    counts = S.windowed_counts(s, "et", ["user_id"], _p(p, "size"), delay=_p(p, "delay"))
    return Job(counts, batch=lambda out: S.top_n_sink(out, ["window_start", "window_end"], "user_id",
                                                       _p(p, "n", int), str(_p(p, "ascending")).lower() == "true"))


@job("top_n_processing_time", "N2/W4: top n users per processing-time window (ingest time)")
def _top_n_processing_time(s, p):
    from .replay import with_ingest_time
    counts = S.windowed_counts(with_ingest_time(s), "ingest_ts", ["user_id"], _p(p, "size"))
    return Job(counts, batch=lambda out: S.top_n_sink(out, ["window_start", "window_end"], "user_id",
                                                       _p(p, "n", int)))


@job("late_window_counts", "T5: per-window counts re-emitted as late rows arrive (update mode)")
def _late_window_counts(s, p):
    from ..operators import windows as W
    delay = W.seconds(_p(p, "delay")) + W.seconds(_p(p, "lateness"))
    return Job(S.windowed_counts(s, "et", [], _p(p, "size"), delay=delay), "update")


@job("late_split", "T5/T6/O2: on-time / late / too-late routing by arrival order")
def _late_split(s, p):
    return Job(s.select("event_id", "ts", F.current_timestamp().alias("arrival_ts")),
               batch=lambda out: K.LateRouter("ts", ["arrival_ts", "event_id"], _p(p, "size"),
                                              out, delay=_p(p, "delay"),
                                              lateness=_p(p, "lateness")))


@job("late_firings", "T5: the on-time firing of each window, and a corrected one per late row")
def _late_firings(s, p):
    return Job(s.select("event_id", "ts", F.current_timestamp().alias("arrival_ts")),
               batch=lambda out: K.LateFirings("ts", ["arrival_ts", "event_id"], _p(p, "size"), out, "event_id",
                                               delay=_p(p, "delay"), lateness=_p(p, "lateness")))


@job("reconcile", "J4: one-to-one reconciliation of two event types within a bound")
def _reconcile(s, p):
    left, right = _sides(s, p)
    return Job(ST.reconcile_exact(left, right, "user_id", "event_id", "et", _p(p, "within")))


@job("interval_join", "J1: second event type within [lower, upper] after the first")
def _interval_join(s, p):
    left, right = _sides(s, p)
    left = left.select("user_id", F.col("event_id").alias("l_id"), F.col("et").alias("l_et"))
    right = right.select("user_id", F.col("event_id").alias("r_id"), F.col("et").alias("r_et"))
    return Job(S.interval_join(left, right, ["user_id"], "l_et", "r_et", _p(p, "lower"),
                               _p(p, "upper")))


@job("window_join", "J2: pairs of the two event types per user and tumbling window")
def _window_join(s, p):
    left, right = _sides(s, p)
    left = left.select("user_id", F.col("event_id").alias("l_id"), F.col("et").alias("l_et"))
    right = right.select("user_id", F.col("event_id").alias("r_id"), F.col("et").alias("r_et"))
    return Job(S.window_join(left, right, ["user_id"], "l_et", "r_et", _p(p, "size")))


@job("window_cogroup", "J3: both event types co-grouped per user and tumbling window")
def _window_cogroup(s, p):
    left, right = _sides(s, p)
    return Job(S.window_cogroup(left, right, ["user_id"], "et", "et", "event_id", "event_id",
                                _p(p, "size")))


@job("previous_rule", "J5: previous event per user with the rule in force (rules: parquet path)")
def _previous_rule(s, p):
    spark = s.sparkSession
    rules = spark.read.parquet(p["rules"]) if "rules" in p else spark.sql(
        "SELECT * FROM VALUES (TIMESTAMP_NTZ'1970-01-01 00:00:00', 'view', 'purchase') "
        "AS r(rule_ts, rule_prev, rule_next)")
    from ..operators.joins import with_rule
    prev = ST.previous_event(s, "user_id", "event_id", "et", "event_type")

    def batch(out):
        def write(df, i):
            d = with_rule(df.withColumn("ts", F.timestamp_micros("ts").cast("timestamp_ntz")), rules, "ts", order=["id"])
            out(d.withColumn("matched", F.coalesce((F.col("prev_type") == F.col("rule.rule_prev"))
                                                   & (F.col("type") == F.col("rule.rule_next")), F.lit(False))), i)
        return write
    return Job(prev, batch=batch)


@job("route_split", "O1/P3: three value bands, each written to its own sink")
def _route_split(s, p):
    lo, mid = _p(p, "low", float), _p(p, "mid", float)
    routed = R.route_split(s.select("event_id", "user_id", "value"), "value",
                           [("low", lo), ("mid", mid)], "high")
    # each route gets its own output slot (``<batch>-<route>``)
    return Job(routed, batch=lambda out: K.routed_writer(
        "route", {r: (lambda df, i, r=r: out(df, f"{i}-{r}")) for r in ("low", "mid", "high")}))


@job("followed_by", "C1/C4/O3: first type followed by the second within a limit, and timeouts")
def _followed_by(s, p):
    return Job(ST.followed_by_exact(s, "user_id", "event_id", "et",
                                    F.col("event_type") == _p(p, "first"),
                                    F.col("event_type") == _p(p, "then"),
                                    _p(p, "within")))


@job("consecutive", "C2/C3: value above thresholds on consecutive events of a user")
def _consecutive(s, p):
    limits = [float(x) for x in str(_p(p, "thresholds")).split(",")]
    return Job(ST.strict_sequence_exact(s, "user_id", "event_id", "et",
                                        [F.col("value") > x for x in limits]))


@job("state_machine", "C5: keyed state machine (transitions: 'state:event:next;...')")
def _state_machine(s, p):
    spec = _p(p, "transitions")
    trans = {(a, e): b for a, e, b in (t.split(":") for t in spec.split(";") if t)}
    fsm = P.StateMachine(trans, _p(p, "start"), set(_p(p, "accept").split(",")))
    return Job(ST.state_machine_exact(s, "user_id", "event_id", "et", "event_type", fsm))


@job("buffer_flush", "N3/V2/V5: per-user buffers flushed by event-time timers")
def _buffer_flush(s, p):
    return Job(ST.buffer_flush_exact(s, "user_id", "event_id", "et", _p(p, "every")))


@job("sql_tumble", "A7/W6/T4/S4: SQL keyed sum per tumbling window over a streaming view")
def _sql_tumble(s, p):
    return Job(s.sparkSession.sql(f"""
        SELECT event_type AS key, window.start AS window_start, window.end AS window_end,
               sum(CAST(get_json_object(props, '$.k') AS BIGINT)) AS cnt
        FROM {{stream}} GROUP BY event_type, window(et, '{_p(p, "size")}')""",
                                  stream=s.withWatermark("et", _p(p, "delay"))))


@job("sessions", "W5: session windows per user")
def _sessions(s, p):
    return Job(S.sessions(s, "et", ["user_id"], _p(p, "gap")))


@job("sql_functions", "J7/U1-U3: registered scalar and lateral table functions in SQL")
def _sql_functions(s, p):
    U.register_sql_functions(s.sparkSession)
    return Job(s.sparkSession.sql(
        "SELECT e.event_type, jvm_hash(e.event_type) AS type_hash, f.first_char, f.n_chars "
        "FROM {types} AS e JOIN LATERAL leading_char(e.event_type) AS f", types=s.select("event_type")))


@job("jdbc_counts", "K4: running counts per user appended to a JDBC table (--param url=..)")
def _jdbc_counts(s, p):
    counts = S.running_counts(s, ["user_id"])
    writer = D.jdbc_batch_writer(p["url"], _p(p, "table"),
                                 properties={k[5:]: v for k, v in p.items() if k.startswith("prop.")})
    return Job(counts, "update", batch=lambda out: writer)


@job("measure_sum", "A7b: plain keyed sum of the integer measure (update mode)")
def _measure_sum(s, p):
    return Job(s.groupBy("user_id").agg(F.sum(props_k()).alias("total")), "update")


def _printer(batch: DataFrame, batch_id: int) -> None:
    print(f"-- batch {batch_id}")
    batch.show(20, truncate=False)


def run(spark, name: str, source: str, sink: str = "console", out: str | None = None,
        checkpoint: str | None = None, available_now: bool = False, trigger: str | None = None,
        params: dict | None = None, max_files_per_trigger: int = 1):
    """Start job ``name`` on the events folder ``source``; returns the query."""
    fn, _ = JOBS[name]
    stream = with_event_time(replay(spark, source, EVENTS_SCHEMA, max_files_per_trigger), "ts", "et")
    spec = fn(stream, {**DEFAULTS.get(name, {}), **(params or {})})
    trig = {"availableNow": True} if available_now else (
        {"processingTime": trigger} if trigger else None)
    ckpt = checkpoint or state_location(spark, f"job-{name}")
    if spec.batch is not None:
        if sink == "parquet":
            base = K.parquet_writer(out)
        elif sink == "noop":
            base = lambda df, i: df.write.format("noop").mode("overwrite").save()
        else:
            base = _printer
        return K.start_batches(spec.df, spec.batch(base), f"job-{name}", spec.mode, trig, ckpt)
    options = {"path": out} if sink == "parquet" else {}
    if sink == "parquet" and spec.mode != "append":
        return K.start_batches(spec.df, K.parquet_writer(out), f"job-{name}", spec.mode, trig, ckpt)
    return K.start(spec.df, sink, f"job-{name}", spec.mode, trig, ckpt, **options)


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(description=__doc__.split("\n\n")[0])
    ap.add_argument("job", nargs="?")
    ap.add_argument("--list", action="store_true")
    ap.add_argument("--source")
    ap.add_argument("--sink", default="console", choices=["console", "parquet", "noop", "memory"])
    ap.add_argument("--out")
    ap.add_argument("--checkpoint")
    ap.add_argument("--available-now", action="store_true")
    ap.add_argument("--trigger", help="processing-time interval, e.g. '10 seconds'")
    ap.add_argument("--param", action="append", default=[], help="key=value")
    a = ap.parse_args(argv)
    if a.list or not a.job:
        for k, (_, doc) in JOBS.items():
            print(f"{k:16s} {doc}")
        return
    spark = build_session(master=os.environ.get("SPARK_MASTER", "local[*]"))
    params = dict(kv.split("=", 1) for kv in a.param)
    q = run(spark, a.job, a.source, a.sink, a.out, a.checkpoint, a.available_now, a.trigger, params)
    q.awaitTermination()


if __name__ == "__main__":
    main()
