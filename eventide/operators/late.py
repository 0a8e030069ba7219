"""Late data (T5, T6, O2) with a deterministic, per-row rule.

For each row let ``m`` be the highest event time among rows that *arrived*
before it, ``wm = m - delay`` the watermark it meets, and ``E`` the end of its
last window.  The row is

* ``on_time``   if ``wm < E`` (or nothing arrived before it),
* ``late``      if ``E <= wm < E + lateness`` — still counted; the window
  fires again with the corrected result,
* ``too_late``  if ``wm >= E + lateness`` — routed to the side output.

``m`` is a running max over arrival order, computed as a chunked prefix max
(never a single-task window).  Spark's own watermark drop is silent and one
micro-batch late, so the routing is computed here instead.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import windows as W
from .sequence import KeyedSequence

ON_TIME, LATE, TOO_LATE = "on_time", "late", "too_late"


def late_split(df: DataFrame, ts: str, arrival: list[str], size, slide=None, offset=None,
               delay=0, lateness=0, initial_max=None, **seq_kw) -> DataFrame:
    """Add ``watermark``, ``window_start``/``window_end`` (tumbling) or the
    last window's bounds (sliding), and ``route``.  ``initial_max`` is the
    highest event time seen before ``df`` (a stream's earlier batches)."""
    seq = KeyedSequence([], list(arrival), **seq_kw)
    d = seq.finish(seq.running(seq.prepare(df), {"_m": ("max", F.col(ts))}, inclusive=False))
    if initial_max is not None:
        d = d.withColumn("_m", F.greatest(F.col("_m"), initial_max))
    d = d.withColumn("watermark", F.col("_m") - W.interval(delay)).drop("_m")
    step = slide if slide is not None else size
    last = W.tumbling(ts, step, offset)
    d = d.withColumns({"window_start": last.start - W.interval(W.seconds(size) - W.seconds(step)),
                       "window_end": last.start + W.interval(size)}) if slide is not None else \
        d.withColumns({"window_start": last.start, "window_end": last.end})
    wm, end = F.col("watermark"), F.col("window_end")
    route = (F.when(wm.isNull() | (wm < end), F.lit(ON_TIME))
             .when(wm < end + W.interval(lateness), F.lit(LATE))
             .otherwise(F.lit(TOO_LATE)))
    return d.withColumn("route", route)


def late_window_counts(routed: DataFrame, ts: str, size, slide=None, offset=None, lateness=0,
                       keys: list[str] = ()) -> DataFrame:
    """T5: the corrected per-window result.  Every window a row belongs to
    (one for tumbling, ``size / slide`` for sliding) decides on its own:
    on time if the row's watermark is before the window end, counted by a
    late firing if within ``lateness`` after it, otherwise not counted."""
    w = W.assign(ts, size, slide, offset)
    d = routed.select(*keys, "watermark", w.alias("window"))
    wm, end = F.col("watermark"), F.col("window.end")
    d = d.withColumn("_st", F.when(wm.isNull() | (wm < end), F.lit(ON_TIME))
                     .when(wm < end + W.interval(lateness), F.lit(LATE)))
    return (d.filter(F.col("_st").isNotNull())
            .groupBy(*keys, "window")
            .agg(F.count(F.when(F.col("_st") == ON_TIME, 1)).alias("n_on_time"),
                 F.count(F.when(F.col("_st") == LATE, 1)).alias("n_late"),
                 F.count(F.lit(1)).alias("n_total"))
            .select(*keys, *W.bounds(), "n_on_time", "n_late", "n_total"))
