"""Structured Streaming forms of the operators built on Spark's own state.

Each function takes a streaming DataFrame with an event-time column of type
``TIMESTAMP`` (see :func:`eventide.streaming.replay.with_event_time`) and
returns a streaming DataFrame; the docstring names the output mode.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import topn as N
from ..operators import windows as W


def watermarked(df: DataFrame, et: str, delay=0) -> DataFrame:
    """Ascending time (delay 0) or bounded out-of-orderness."""
    return df.withWatermark(et, W.duration(delay) if delay else "0 seconds")


def windowed_counts(df: DataFrame, et: str, keys: list[str], size, slide=None, offset=None,
                    delay=0) -> DataFrame:
    """A4 stream: count per (window, keys).  Append mode: a window is emitted
    once, when the watermark passes its end."""
    return (watermarked(df, et, delay)
            .groupBy(W.assign(et, size, slide, offset).alias("window"), *keys)
            .agg(F.count(F.lit(1)).alias("cnt"))
            .select(*W.bounds(), *keys, "cnt"))


def pv_uv(df: DataFrame, et: str, uv_col: str, size, slide=None, offset=None, delay=0,
          keys: list[str] = ()) -> DataFrame:
    """A3/A5 stream: exact PV, UV and pv div uv per window, append mode.

    Two chained aggregates: rows per (window, value), then values per window.  The
    state holds one entry per value and open window, spread over the values, so
    no single entry grows."""
    step = slide if slide is not None else size
    one = (watermarked(df, et, delay)
           .groupBy(*keys, W.assign(et, size, slide, offset).alias("window"), F.col(uv_col).alias("_value"))
           .agg(F.count(F.lit(1)).alias("n")))
    # A window's end is the end of exactly one slot of the slide.
    slot = W.tumbling(F.window_time("window"), step, offset)
    return (one.groupBy(*keys, slot.alias("slot"))
            .agg(F.sum("n").alias("pv"), F.count("_value").alias("uv"))
            .select((F.col("slot.end") - W.interval(size)).alias("window_start"), F.col("slot.end").alias("window_end"),
                    *keys, "pv", "uv", F.expr("pv div uv").cast("double").alias("ratio")))


def windowed_sum(df: DataFrame, et: str, keys: list[str], size, measure, name: str = "total",
                 delay=0) -> DataFrame:
    """A7 stream (the SQL TUMBLE job): keyed sum per tumbling window; append."""
    return (watermarked(df, et, delay)
            .groupBy(*keys, W.tumbling(et, size).alias("window"))
            .agg(F.sum(measure).alias(name))
            .select(*keys, *W.bounds(), name))


def running_counts(df: DataFrame, keys: list[str], name: str = "cnt") -> DataFrame:
    """A1/A6 stream: running count per key.  Update mode: one row per changed
    key per micro-batch (the per-row form is ``RunningCountProcessor``)."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def sessions(df: DataFrame, et: str, keys: list[str], gap, delay=0) -> DataFrame:
    """W5 stream: session windows; append mode."""
    return (watermarked(df, et, delay)
            .groupBy(*keys, F.session_window(et, W.duration(gap)).alias("s"))
            .agg(F.count(F.lit(1)).alias("n_events"))
            .select(*keys, F.col("s.start").alias("session_start"),
                    F.col("s.end").alias("session_end"), "n_events"))


def interval_join(left: DataFrame, right: DataFrame, keys: list[str], l_et: str, r_et: str,
                  lower, upper, l_delay=0, r_delay=0) -> DataFrame:
    """J1 stream: stream-stream inner join with a time range; the watermarks
    on both sides bound the join state.  Append mode."""
    l = watermarked(left, l_et, l_delay).alias("l")
    r = watermarked(right, r_et, r_delay).alias("r")
    cond = [F.col(f"l.{k}") == F.col(f"r.{k}") for k in keys] + [
        F.col(f"r.{r_et}") >= F.col(f"l.{l_et}") + W.interval(lower),
        F.col(f"r.{r_et}") <= F.col(f"l.{l_et}") + W.interval(upper)]
    out = l.join(r, on=cond, how="inner")
    return out.select(*[F.col(f"l.{k}").alias(k) for k in keys],
                      *[F.col(f"l.{c}") for c in left.columns if c not in keys],
                      *[F.col(f"r.{c}") for c in right.columns if c not in keys])


def window_join(left: DataFrame, right: DataFrame, keys: list[str], l_et: str, r_et: str,
                size, l_delay=0, r_delay=0) -> DataFrame:
    """J2 stream: join on keys and the same tumbling window.  Spark allows one
    event-time column per stream, so ``window`` stays the event time and both
    raw times are carried as epoch microseconds (``{col}_us``).  Append mode."""
    def side(df, et, delay):
        return (watermarked(df, et, delay).withColumn("window", W.tumbling(et, size))
                .withColumn(f"{et}_us", F.unix_micros(F.col(et))).drop(et))
    l, r = side(left, l_et, l_delay), side(right, r_et, r_delay)
    rename = {l_et: f"{l_et}_us", r_et: f"{r_et}_us"}
    return l.join(r, on=[*keys, "window"], how="inner").select(
        *keys, *W.bounds(), *[rename.get(c, c) for c in left.columns if c not in keys],
        *[rename.get(c, c) for c in right.columns if c not in keys])


def top_n_sink(out_writer, window_cols: list[str], key: str, n: int, ascending: bool = False):
    """N1/N2 stream: ``row_number`` is refused on streams, so rank each
    micro-batch of *final* window counts (append mode emits a closed window
    whole, in one batch) and hand the top ``n`` to ``out_writer(df, id)``."""
    def write(batch: DataFrame, batch_id: int) -> None:
        ranked = N.rank_within(batch, window_cols, "cnt", [key], n, ascending)
        out_writer(ranked, batch_id)
    return write


def window_cogroup(left: DataFrame, right: DataFrame, keys: list[str], l_et: str, r_et: str,
                   l_id: str, r_id: str, size, delay=0) -> DataFrame:
    """J3 stream: both sides tagged and unioned, one aggregate per
    (key, window) with the group sizes and first / last ids; append mode."""
    def side(df, et, idc, tag):
        return df.select(*keys, F.col(et).alias("et"), F.lit(tag).alias("side"),
                         F.col(idc).alias("element_id"))
    u = watermarked(side(left, l_et, l_id, "left").unionByName(side(right, r_et, r_id, "right")),
                    "et", delay)
    is_l, is_r = F.col("side") == "left", F.col("side") == "right"
    return (u.groupBy(*keys, W.tumbling("et", size).alias("window"))
            .agg(F.count(F.when(is_l, 1)).alias("n_left"), F.count(F.when(is_r, 1)).alias("n_right"),
                 F.min(F.when(is_l, F.col("element_id"))).alias("left_first"),
                 F.max(F.when(is_l, F.col("element_id"))).alias("left_last"),
                 F.min(F.when(is_r, F.col("element_id"))).alias("right_first"),
                 F.max(F.when(is_r, F.col("element_id"))).alias("right_last"))
            .select(*keys, *W.bounds(), "n_left", "n_right", "left_first", "left_last",
                    "right_first", "right_last"))
