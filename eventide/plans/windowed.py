"""Windowed and running aggregates over ``events``.

Mapping of the reference's record to the stored table: name -> user_id,
operation -> event_type, time -> ts, arrival order -> event_id, the integer
measure -> props.k.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import accumulate as AC
from ..operators import aggregates as A
from ..operators import topn as N
from ..operators import windows as W
from ..sources.tables import events, props_k
from .registry import ORACLE, query

ORDER = ["ts", "event_id"]

_K = "CAST(json_extract_string(props, '$.k') AS BIGINT)"


@query("pv_uv_sliding", """
SELECT window_start, window_start + INTERVAL 3 DAY AS window_end,
       count(*) AS pv, count(DISTINCT user_id) AS uv,
       CAST(count(*) // count(DISTINCT user_id) AS DOUBLE) AS ratio
FROM (SELECT time_bucket(INTERVAL 1 DAY, ts) - to_days(k) AS window_start, user_id
      FROM (SELECT ts, user_id, unnest([0, 1, 2]) AS k FROM events))
GROUP BY window_start
""")
def pv_uv_sliding(spark, sf_dir):
    """A3 + W3: PV, UV and pv div uv over 3-day windows sliding by 1 day."""
    ev = events(spark, sf_dir)
    return A.pv_uv(ev, "ts", "user_id", "3 days", "1 day")


@query("pv_uv_sliding_panes", """
SELECT window_start, window_start + INTERVAL 3 DAY AS window_end,
       count(*) AS pv, count(DISTINCT user_id) AS uv,
       CAST(count(*) // count(DISTINCT user_id) AS DOUBLE) AS ratio
FROM (SELECT time_bucket(INTERVAL 1 HOUR, ts) - to_hours(k) AS window_start, user_id
      FROM (SELECT ts, user_id, unnest(range(72)) AS k FROM events))
GROUP BY window_start
""")
def pv_uv_sliding_panes(spark, sf_dir):
    """A3 + W3 by panes: 3-day windows sliding by an hour, 72 windows a row."""
    return A.pv_uv_panes(events(spark, sf_dir), "ts", "user_id", "3 days", "1 hour")


@query("frequent_values", """
SELECT event_type, level, cnt, n_rows
FROM (SELECT event_type, CAST(floor(value) AS BIGINT) AS level, count(*) AS cnt FROM events GROUP BY ALL)
JOIN (SELECT event_type, count(*) AS n_rows FROM events GROUP BY ALL) USING (event_type)
WHERE cnt > 0.01 * n_rows
""")
def frequent_values(spark, sf_dir):
    """Levels (whole part of the value) with more than 1 % of an event type's rows,
    found by a merged summary of 101 counters per type and counted exactly."""
    ev = events(spark, sf_dir).select("event_type", F.floor("value").alias("level"))
    return AC.frequent_values(ev, "level", 0.01, ["event_type"])


@query("uv_tumbling_offset", """
SELECT time_bucket(INTERVAL 6 HOUR, ts, INTERVAL 1 HOUR) AS window_start,
       time_bucket(INTERVAL 6 HOUR, ts, INTERVAL 1 HOUR) + INTERVAL 6 HOUR AS window_end,
       count(DISTINCT user_id) AS uv
FROM events GROUP BY 1, 2
""")
def uv_tumbling_offset(spark, sf_dir):
    """A5 + W1 + W7: distinct users per 6 h tumbling window shifted by 1 h."""
    ev = events(spark, sf_dir)
    return A.distinct_per_window(ev, "ts", "user_id", "6 hours", offset="1 hour")


@query("count_by_key", """
SELECT user_id, CAST(sum(1) AS BIGINT) AS cnt FROM events GROUP BY user_id
""")
def count_by_key(spark, sf_dir):
    """SQL ``sum(1) group by name``."""
    return spark.sql("SELECT user_id, sum(1) AS cnt FROM {events} GROUP BY user_id",
                     events=events(spark, sf_dir))


@query("sum_by_key", f"""
SELECT user_id, CAST(sum({_K}) AS BIGINT) AS total FROM events GROUP BY user_id
""")
def sum_by_key(spark, sf_dir):
    """Plain keyed sum of the integer measure."""
    return A.sum_by_key(events(spark, sf_dir), ["user_id"], props_k())


@query("sql_tumble_sum", f"""
SELECT event_type AS key, time_bucket(INTERVAL 1 HOUR, ts) AS window_start,
       time_bucket(INTERVAL 1 HOUR, ts) + INTERVAL 1 HOUR AS window_end,
       CAST(sum({_K}) AS BIGINT) AS cnt
FROM events GROUP BY 1, 2, 3
""")
def sql_tumble_sum(spark, sf_dir):
    """A7 + W6: SQL sum per key per 1 h tumbling window."""
    return spark.sql("""
        SELECT event_type AS key, window.start AS window_start, window.end AS window_end,
               sum(CAST(get_json_object(props, '$.k') AS BIGINT)) AS cnt
        FROM {events}
        GROUP BY event_type, window(ts, '1 hour')""", events=events(spark, sf_dir))


_RUNNING = """
SELECT event_id, user_id, ts,
       count(*) OVER (PARTITION BY user_id ORDER BY ts, event_id
                      ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS running_count
FROM events"""


@query("running_count", _RUNNING)
def running_count(spark, sf_dir):
    """A1: running count per user, one row per event."""
    ev = events(spark, sf_dir).select("event_id", "user_id", "ts")
    return A.running_count(ev, ["user_id"], ORDER)


@query("running_max_count", f"""
SELECT *, max(running_count) OVER (ORDER BY ts, event_id
                                   ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS max_count
FROM ({_RUNNING})
""")
def running_max_count(spark, sf_dir):
    """A2: global running max over A1's output (bucketed prefix max)."""
    rc = running_count(spark, sf_dir)
    return A.running_max(rc, "running_count", ORDER, name="max_count", tie=["event_id"])


@query("update_log", f"""
WITH r AS ({_RUNNING})
SELECT event_id, user_id, ts, '+I' AS op, running_count AS cnt, 0 AS seq FROM r WHERE running_count = 1
UNION ALL
SELECT event_id, user_id, ts, '-U' AS op, running_count - 1 AS cnt, 0 AS seq FROM r WHERE running_count > 1
UNION ALL
SELECT event_id, user_id, ts, '+U' AS op, running_count AS cnt, 1 AS seq FROM r WHERE running_count > 1
""")
def update_log(spark, sf_dir):
    """The update log of the running count per user (+I / -U / +U)."""
    return A.update_log(running_count(spark, sf_dir), ["user_id"])


@query("update_log_sum", f"""
WITH r AS (SELECT event_id, user_id, ts,
                  CAST(sum({_K}) OVER w AS BIGINT) AS total,
                  CAST(sum({_K}) OVER (PARTITION BY user_id ORDER BY ts, event_id
                       ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS BIGINT) AS old,
                  row_number() OVER w AS n
           FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id
                                    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
SELECT event_id, user_id, ts, '+I' AS op, total AS cnt, 0 AS seq FROM r WHERE n = 1
UNION ALL SELECT event_id, user_id, ts, '-U' AS op, old AS cnt, 0 AS seq FROM r WHERE n > 1
UNION ALL SELECT event_id, user_id, ts, '+U' AS op, total AS cnt, 1 AS seq FROM r WHERE n > 1
""")
def update_log_sum(spark, sf_dir):
    """A8 over a running sum: the old value is that of the row before."""
    ev = events(spark, sf_dir).select("event_id", "user_id", "ts", props_k().alias("k"))
    total = A.running_count(ev, ["user_id"], ORDER, name="total", measure=F.col("k"), previous="was").drop("k")
    return A.update_log(total, ["user_id"], "total", previous="was")


def sparse(sql: str) -> str:
    """``sql`` over events with day-long ties in time and users of which a tenth is null."""
    return sql.replace("FROM events", "FROM (SELECT event_id, date_trunc('day', ts)::TIMESTAMP AS ts, "
                       "CASE WHEN user_id % 10 = 0 THEN NULL ELSE user_id END AS user_id, event_type, value, props "
                       "FROM events)")


def sparse_events(spark, sf_dir):
    return events(spark, sf_dir).withColumns({
        "ts": F.date_trunc("day", "ts").cast("timestamp_ntz"),
        "user_id": F.when(F.col("user_id") % 10 != 0, F.col("user_id"))})


@query("running_count_sparse", sparse(_RUNNING))
def running_count_sparse(spark, sf_dir):
    """A1 with a hot null key and tied times."""
    return A.running_count(sparse_events(spark, sf_dir).select("event_id", "user_id", "ts"), ["user_id"], ORDER)


_DAILY = """
SELECT time_bucket(INTERVAL 1 DAY, ts) AS window_start,
       time_bucket(INTERVAL 1 DAY, ts) + INTERVAL 1 DAY AS window_end,
       user_id, count(*) AS cnt
FROM events GROUP BY 1, 2, 3"""


@query("topn_window", f"""
SELECT * FROM (
  SELECT window_start, window_end,
         row_number() OVER (PARTITION BY window_start ORDER BY cnt DESC, user_id) AS rank,
         user_id, cnt
  FROM ({_DAILY})) WHERE rank <= 10
""")
def topn_window(spark, sf_dir):
    """N1 + A4: the 10 most active users per day."""
    return N.top_n_per_window(events(spark, sf_dir), "ts", "1 day", "user_id", 10)


@query("bottomn_window", f"""
SELECT * FROM (
  SELECT window_start, window_end,
         row_number() OVER (PARTITION BY window_start ORDER BY cnt, user_id) AS rank,
         user_id, cnt
  FROM ({_DAILY})) WHERE rank <= 5
""")
def bottomn_window(spark, sf_dir):
    """N2 + A4 as written (ascending order): the 5 least active users per day."""
    return N.top_n_per_window(events(spark, sf_dir), "ts", "1 day", "user_id", 5, ascending=True)


@query("session_counts", """
SELECT user_id, session_no, min(ts) AS session_start,
       max(ts) + INTERVAL 5 HOUR AS session_end, count(*) AS n_events
FROM (SELECT user_id, ts,
             CAST(sum(CASE WHEN prev_ts IS NULL OR ts > prev_ts + INTERVAL 5 HOUR THEN 1 ELSE 0 END)
                  OVER (PARTITION BY user_id ORDER BY ts, event_id
                        ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS session_no
      FROM (SELECT user_id, ts, event_id,
                   lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS prev_ts
            FROM events))
GROUP BY user_id, session_no
""")
def session_counts(spark, sf_dir):
    """Session windows per user with a 5 h gap."""
    ev = events(spark, sf_dir).select("event_id", "user_id", "ts")
    return W.sessions(ev, ["user_id"], "ts", "5 hours", order=ORDER)


@query("session_counts_sparse", sparse(ORACLE["session_counts"]))
def session_counts_sparse(spark, sf_dir):
    """W5 with a hot null key and tied times."""
    ev = sparse_events(spark, sf_dir).select("event_id", "user_id", "ts")
    return W.sessions(ev, ["user_id"], "ts", "5 hours", order=ORDER)
