"""Patterns, late data, routing and buffering over ``events``.

create -> ``view``, pay -> ``purchase``, age -> ``value``; arrival order is
``ts + (event_id % 7) * 600 s`` (a stored stand-in for processing time).
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import late as L
from ..operators import patterns as P
from ..operators import routing as R
from ..operators import topn as N
from ..sources.tables import events
from .registry import query
from .windowed import sparse, sparse_events

ORDER = ["ts", "event_id"]


def _ev(spark, sf_dir):
    return events(spark, sf_dir).select("event_id", "user_id", "ts", "event_type", "value")


def arrival_ts():
    return F.col("ts") + F.make_dt_interval(secs=(F.col("event_id") % 7) * 600)


_FB = """
WITH n AS (
  SELECT user_id, event_id, ts, event_type,
         first_value(CASE WHEN event_type = 'purchase' THEN ts END IGNORE NULLS) OVER w AS pay_ts,
         first_value(CASE WHEN event_type = 'purchase' THEN event_id END IGNORE NULLS) OVER w AS pay_id
  FROM events
  WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id
               ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING))"""

_FB_MATCH = _FB + """
SELECT user_id, event_id AS first_event_id, ts AS first_ts, pay_id AS then_event_id, pay_ts AS then_ts
FROM n WHERE event_type = 'view' AND pay_ts IS NOT NULL AND pay_ts < ts + INTERVAL {h} HOUR"""

_FB_TIMEOUT = _FB + """
SELECT user_id, event_id AS first_event_id, ts AS first_ts, ts + INTERVAL {h} HOUR AS timeout_ts
FROM n WHERE event_type = 'view' AND (pay_ts IS NULL OR pay_ts >= ts + INTERVAL {h} HOUR)"""


def _followed_by(spark, sf_dir, hours):
    ev = _ev(spark, sf_dir)
    return P.followed_by(ev, ["user_id"], ORDER, "ts", F.col("event_type") == "view",
                         F.col("event_type") == "purchase", f"{hours} hours", ["event_id", "ts"])


@query("cep_followed_by", _FB_MATCH.format(h=1))
def cep_followed_by(spark, sf_dir):
    """View followed by purchase of the same user within 1 h."""
    return _followed_by(spark, sf_dir, 1)[0]


@query("cep_followed_by_6h", _FB_MATCH.format(h=6))
def cep_followed_by_6h(spark, sf_dir):
    """C1 with a 6 h limit."""
    return _followed_by(spark, sf_dir, 6)[0]


@query("cep_followed_by_24h", _FB_MATCH.format(h=24))
def cep_followed_by_24h(spark, sf_dir):
    """C1 with a 24 h limit."""
    return _followed_by(spark, sf_dir, 24)[0]


@query("cep_timeout", _FB_TIMEOUT.format(h=1))
def cep_timeout(spark, sf_dir):
    """C4 + O3: views whose partial match timed out after 1 h."""
    return _followed_by(spark, sf_dir, 1)[1]


_SEQ = """
SELECT user_id, {sel} FROM (
  SELECT user_id, event_id, ts, value,
         lag(event_id, 1) OVER w AS id1, lag(ts, 1) OVER w AS ts1, lag(value, 1) OVER w AS v1,
         lag(event_id, 2) OVER w AS id2, lag(ts, 2) OVER w AS ts2, lag(value, 2) OVER w AS v2
  FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))
WHERE v2 > {a} AND v1 > {b} AND value > {c}"""
_SEQ_SEL = ("id2 AS e1_event_id, ts2 AS e1_ts, id1 AS e2_event_id, ts1 AS e2_ts, "
            "event_id AS e3_event_id, ts AS e3_ts")


@query("cep_consecutive", _SEQ.format(sel=_SEQ_SEL, a=40, b=40, c=40))
def cep_consecutive(spark, sf_dir):
    """Value > 40 three times in a row for a user (overlaps kept)."""
    return P.consecutive(_ev(spark, sf_dir), ["user_id"], ORDER, F.col("value") > 40, 3,
                         ["event_id", "ts"])


@query("cep_strict_sequence", _SEQ.format(sel=_SEQ_SEL, a=40, b=60, c=80))
def cep_strict_sequence(spark, sf_dir):
    """Value > 40, then > 60, then > 80 on the next rows of a user."""
    return P.strict_sequence(_ev(spark, sf_dir), ["user_id"], ORDER,
                             [F.col("value") > 40, F.col("value") > 60, F.col("value") > 80],
                             ["event_id", "ts"])


# The order cycle view -> purchase -> error as a state machine.
FSM_TRANSITIONS = {("idle", "view"): "viewed", ("viewed", "purchase"): "paid",
                   ("paid", "error"): "matched"}
FSM_START, FSM_ACCEPT = "idle", {"matched"}

_FSM_NEXT = """CASE WHEN s IN ('idle', 'matched') AND ev = 'view' THEN 'viewed'
     WHEN s = 'viewed' AND ev = 'purchase' THEN 'paid'
     WHEN s = 'paid' AND ev = 'error' THEN 'matched'
     WHEN s = 'matched' THEN 'idle' ELSE s END"""

_FSM = f"""
WITH RECURSIVE e AS (
  SELECT user_id, event_id, ts, event_type,
         row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn
  FROM events),
walk AS (
  SELECT user_id, rn, event_id, ts, event_type,
         {_FSM_NEXT.replace('s IN', "'idle' IN").replace("s =", "'idle' =").replace('ev', 'event_type')
                   .replace('ELSE s', "ELSE 'idle'")} AS state
  FROM e WHERE rn = 1
  UNION ALL
  SELECT e.user_id, e.rn, e.event_id, e.ts, e.event_type,
         {_FSM_NEXT.replace('s IN', 'w.state IN').replace('s =', 'w.state =').replace('ev', 'e.event_type')
                   .replace('ELSE s', 'ELSE w.state')} AS state
  FROM walk w JOIN e ON e.user_id = w.user_id AND e.rn = w.rn + 1)"""


def _fsm(spark, sf_dir):
    fsm = P.StateMachine(FSM_TRANSITIONS, FSM_START, FSM_ACCEPT)
    ev = _ev(spark, sf_dir).select("user_id", "event_id", "ts", "event_type")
    return P.run_state_machine(ev, ["user_id"], ORDER, "event_type", fsm)


@query("fsm", _FSM + """
SELECT user_id, event_id, ts, event_type, state, state = 'matched' AS accepted FROM walk""")
def fsm(spark, sf_dir):
    """State of each user's view -> purchase -> error machine after every event."""
    return _fsm(spark, sf_dir)


@query("fsm_matches", _FSM + """
SELECT user_id, event_id, ts FROM walk WHERE state = 'matched'""")
def fsm_matches(spark, sf_dir):
    """The events that complete a cycle."""
    return _fsm(spark, sf_dir).filter("accepted").select("user_id", "event_id", "ts")


#: An even id above 2**53: neighbouring ids are one float apart from there on.
_LARGE = 9007199254740992


@query("cep_followed_by_sparse", sparse(_FB_MATCH.format(h=48)))
def cep_followed_by_sparse(spark, sf_dir):
    """C1 within 48 h, with a hot null key and tied times."""
    return P.followed_by(sparse_events(spark, sf_dir), ["user_id"], ORDER, "ts", F.col("event_type") == "view",
                         F.col("event_type") == "purchase", "48 hours", ["event_id", "ts"])[0]


@query("fsm_sparse", sparse(_FSM).replace("e.user_id = w.user_id", "e.user_id IS NOT DISTINCT FROM w.user_id") + f"""
SELECT CAST(user_id + {_LARGE} AS VARCHAR) AS user_id, event_id, ts, state FROM walk""")
def fsm_sparse(spark, sf_dir):
    """C5 with a hot null key, tied times, and keys beyond what a float can tell apart."""
    fsm = P.StateMachine(FSM_TRANSITIONS, FSM_START, FSM_ACCEPT)
    ev = (sparse_events(spark, sf_dir).select("user_id", "event_id", "ts", "event_type")
          .withColumn("user_id", F.col("user_id") + _LARGE))
    return P.run_state_machine(ev, ["user_id"], ORDER, "event_type", fsm).select(
        F.col("user_id").cast("string").alias("user_id"), "event_id", "ts", "state")


@query("route_split", """
SELECT event_id, value,
       CASE WHEN value <= 20 THEN 'low' WHEN value <= 50 THEN 'mid' ELSE 'high' END AS route
FROM events""")
def route_split(spark, sf_dir):
    """O1 + P3: three bands by value, one route per row."""
    ev = _ev(spark, sf_dir).select("event_id", "value")
    return R.route_split(ev, "value", [("low", 20), ("mid", 50)], "high")


_LATE = """
WITH a AS (SELECT event_id, ts, ts + to_seconds((event_id % 7) * 600) AS arrival_ts FROM events),
m AS (SELECT *, max(ts) OVER (ORDER BY arrival_ts, event_id
                              ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS watermark,
             time_bucket(INTERVAL 30 MINUTE, ts) AS window_start,
             time_bucket(INTERVAL 30 MINUTE, ts) + INTERVAL 30 MINUTE AS window_end
      FROM a),
r AS (SELECT *, CASE WHEN watermark IS NULL OR watermark < window_end THEN 'on_time'
                     WHEN watermark < window_end + INTERVAL 10 MINUTE THEN 'late'
                     ELSE 'too_late' END AS route FROM m)"""


def _late(spark, sf_dir):
    ev = _ev(spark, sf_dir).select("event_id", "ts").withColumn("arrival_ts", arrival_ts())
    return L.late_split(ev, "ts", ["arrival_ts", "event_id"], "30 minutes",
                        delay=0, lateness="10 minutes")


@query("late_split", _LATE + " SELECT * FROM r")
def late_split(spark, sf_dir):
    """T6 + O2: on-time / late / too-late routing of out-of-order arrivals."""
    return _late(spark, sf_dir)


@query("late_window_counts", _LATE + """
SELECT window_start, window_end,
       count(CASE WHEN route = 'on_time' THEN 1 END) AS n_on_time,
       count(CASE WHEN route = 'late' THEN 1 END) AS n_late, count(*) AS n_total
FROM r WHERE route <> 'too_late' GROUP BY 1, 2""")
def late_window_counts(spark, sf_dir):
    """T5: per-window counts including late firings, excluding too-late rows."""
    return L.late_window_counts(_late(spark, sf_dir), "ts", "30 minutes", lateness="10 minutes")


@query("topn_arrival_window", """
SELECT * FROM (
  SELECT window_start, window_end,
         row_number() OVER (PARTITION BY window_start ORDER BY cnt DESC, user_id) AS rank, user_id, cnt
  FROM (SELECT time_bucket(INTERVAL 1 DAY, arrival_ts) AS window_start,
               time_bucket(INTERVAL 1 DAY, arrival_ts) + INTERVAL 1 DAY AS window_end,
               user_id, count(*) AS cnt
        FROM (SELECT user_id, ts + to_seconds((event_id % 7) * 600) AS arrival_ts FROM events)
        GROUP BY 1, 2, 3))
WHERE rank <= 5""")
def topn_arrival_window(spark, sf_dir):
    """N2 + W4: top 5 users per 1-day window of arrival (processing) time."""
    ev = _ev(spark, sf_dir).select("user_id", "event_id", "ts").withColumn("arrival_ts", arrival_ts())
    return N.top_n_per_window(ev, "arrival_ts", "1 day", "user_id", 5)


@query("buffer_flush", """
SELECT user_id, event_id, ts, time_bucket(INTERVAL 1 HOUR, ts) + INTERVAL 1 HOUR AS flush_ts,
       row_number() OVER (PARTITION BY user_id, time_bucket(INTERVAL 1 HOUR, ts)
                          ORDER BY ts, event_id) AS position
FROM events""")
def buffer_flush(spark, sf_dir):
    """N3 + V2: per-user buffers flushed on the hour, in buffer order."""
    ev = _ev(spark, sf_dir).select("user_id", "event_id", "ts")
    return N.buffer_flush(ev, ["user_id"], "ts", "1 hour", ORDER)
