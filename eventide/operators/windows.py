"""Window assignment (W1-W7) and session windows.

Tumbling and sliding windows are Spark's ``window`` expression: half-open
``[start, end)``, an optional ``offset`` shifts the grid (``startTime``).
Sessions are computed with skew-safe ordered scans so a user with a very long
history is split across tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .sequence import KeyedSequence


def _as_number(d):
    if isinstance(d, str):
        try:
            return float(d)
        except ValueError:
            return d
    return d


def duration(d) -> str:
    """Durations are Spark interval strings ('30 seconds') or seconds (a
    number, or a numeric string from a command line)."""
    d = _as_number(d)
    if isinstance(d, (int, float)):
        return f"{int(d)} seconds" if float(d).is_integer() else f"{int(d * 1_000_000)} microseconds"
    return d


def tumbling(ts: str | Column, size, offset=None) -> Column:
    """Tumbling window struct; ``offset`` shifts window starts."""
    if offset is None:
        return F.window(ts, duration(size))
    return F.window(ts, duration(size), duration(size), duration(offset))


def sliding(ts: str | Column, size, slide, offset=None) -> Column:
    """Sliding windows; each row lands in ``size / slide`` windows."""
    if offset is None:
        return F.window(ts, duration(size), duration(slide))
    return F.window(ts, duration(size), duration(slide), duration(offset))


def assign(ts: str | Column, size, slide=None, offset=None) -> Column:
    if slide is None or duration(slide) == duration(size):
        return tumbling(ts, size, offset)
    return sliding(ts, size, slide, offset)


def bounds(win: str = "window") -> list[Column]:
    """Expose window start/end as plain columns."""
    return [F.col(f"{win}.start").alias("window_start"), F.col(f"{win}.end").alias("window_end")]


def seconds(d) -> float:
    """Interval length in seconds for a duration given as seconds or string."""
    d = _as_number(d)
    if isinstance(d, (int, float)):
        return float(d)
    num, unit = d.split()
    unit = unit.lower().rstrip("s")
    mult = {"microsecond": 1e-6, "millisecond": 1e-3, "second": 1, "minute": 60,
            "hour": 3600, "day": 86400, "week": 604800}[unit]
    return float(num) * mult


def interval(d) -> Column:
    """A day-time interval column for ``ts + interval`` arithmetic."""
    return F.expr(f"INTERVAL {int(round(seconds(d) * 1_000_000))} MICROSECONDS")


def session_ids(df: DataFrame, keys: list[str], ts: str, gap, order: list[str] | None = None,
                **seq_kw) -> DataFrame:
    """Number the sessions of each key: a new session starts when the gap to
    the previous row of the key is *more* than ``gap`` (rows exactly one gap
    apart share a session, as in Spark's ``session_window``)."""
    order = order or [ts]
    if order[0] != ts:
        raise ValueError("sessions need rows in time order")
    seq = KeyedSequence(keys, order, **seq_kw)
    # in time order the latest time before a row is that of the row before it
    d = seq.running(seq.prepare(df), {"_prev": ("max", F.col(ts))}, inclusive=False)
    d = d.withColumn("_new", F.when(F.col("_prev").isNull() |
                                     (F.col(ts) > F.col("_prev") + interval(gap)), 1)
                     .otherwise(0))
    d = seq.running(d, {"session_no": ("sum", F.col("_new"))})
    return seq.finish(d).drop("_prev", "_new")


def sessions(df: DataFrame, keys: list[str], ts: str, gap, order: list[str] | None = None,
             **seq_kw) -> DataFrame:
    """One row per session: keys, session_start, session_end (last row +
    gap), n_events.  The final aggregate is partial + final, so even a
    session holding most rows is combined in parallel."""
    d = session_ids(df, keys, ts, gap, order, **seq_kw)
    return (d.groupBy(*keys, "session_no")
            .agg(F.min(ts).alias("session_start"),
                 (F.max(ts) + interval(gap)).alias("session_end"),
                 F.count(F.lit(1)).alias("n_events")))
