"""Aggregations.

Keyed and windowed aggregates are plain ``groupBy().agg()``: Spark runs a
partial aggregate before the shuffle, so hot keys and key-less (global)
windows stay parallel.  Running forms use :mod:`.sequence`.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import windows as W
from .sequence import KeyedSequence, order_micros


def count_by_key(df: DataFrame, keys: list[str], name: str = "cnt") -> DataFrame:
    """``SELECT k, sum(1) AS cnt GROUP BY k`` (BIGINT)."""
    return df.groupBy(*keys).agg(F.sum(F.lit(1)).cast("bigint").alias(name))


def sum_by_key(df: DataFrame, keys: list[str], measure: str | Column, name: str = "total") -> DataFrame:
    """Plain keyed sum."""
    return df.groupBy(*keys).agg(F.sum(measure).alias(name))


def windowed_sum(df: DataFrame, keys: list[str], ts: str, size, measure: str | Column,
                 name: str = "total", offset=None) -> DataFrame:
    """Keyed sum per tumbling window, with the window bounds."""
    return (df.groupBy(*keys, W.tumbling(ts, size, offset).alias("window"))
            .agg(F.sum(measure).alias(name))
            .select(*keys, *W.bounds(), name))


def pv_uv(df: DataFrame, ts: str, uv_col: str, size, slide=None, offset=None,
          keys: list[str] = (), exact: bool = True) -> DataFrame:
    """A3: page views, unique visitors and ``pv div uv`` (as double) per window.

    ``exact=False`` uses a HyperLogLog sketch (bounded memory per window) —
    the form to use on streams, where exact distinct counts are refused.
    """
    uv = F.countDistinct(uv_col) if exact else F.approx_count_distinct(uv_col)
    acc = UserAggregate({"pv": F.count(F.lit(1)), "uv": uv}, F.expr("pv div uv").cast("double"), "ratio")
    return (acc.apply(df, [*keys, W.assign(ts, size, slide, offset).alias("window")])
            .select(*W.bounds(), *keys, "pv", "uv", "ratio"))


def pv_uv_panes(df: DataFrame, ts: str, uv_col: str, size, slide, keys: list[str] = ()) -> DataFrame:
    """A3 + W3 by panes: exact PV, UV and ``pv div uv`` of sliding windows without giving
    each row to the ``size / slide`` windows it is in.

    Time is cut into panes as long as the greatest common divisor of size and slide.
    Rows are counted per (pane, value), with a partial aggregate.  A value seen in pane
    p belongs to the windows that end with the panes p to p + r - 1; of those its
    previous pane q already gives the ones before q + r.  So it adds one visitor from
    ``max(p, q + r)`` on and takes it away at ``p + r``: the windows' counts are running
    sums of such changes.  What is shuffled does not depend on size / slide.

    The changes of a group are at most two per pane of its time span.  A null value is a
    view without a visitor."""
    keys = list(keys)
    size_us, slide_us = (int(round(W.seconds(d) * 1_000_000)) for d in (size, slide))
    pane = math.gcd(size_us, slide_us)
    r = size_us // pane
    is_zoneless = isinstance(df.schema[ts].dataType, T.TimestampNTZType)
    us = order_micros(df, ts)
    seen = (df.select(*keys, ((us - F.pmod(us, F.lit(pane))) / pane).cast("bigint").alias("_p"), F.col(uv_col).alias("_v"))
            .groupBy(*keys, "_p", "_v").agg(F.count(F.lit(1)).alias("_n")))
    before = F.lag("_p").over(Window.partitionBy(*keys, "_v").orderBy("_p"))
    seen = seen.withColumn("_from", F.greatest(F.col("_p"), F.coalesce(before + r, F.col("_p"))))
    visitor = F.when(F.col("_v").isNotNull(), 1).otherwise(0)
    none = F.lit(0).cast("bigint")

    def change(at, views, visitors):
        return F.struct(at.cast("bigint").alias("_w"), views.cast("bigint").alias("_dn"), visitors.cast("bigint").alias("_dv"))
    changes = (seen.select(*keys, F.explode(F.array(
        change(F.col("_p"), F.col("_n"), none), change(F.col("_from"), none, visitor),
        change(F.col("_p") + r, -F.col("_n"), -visitor))).alias("_c"))
        .groupBy(*keys, F.col("_c._w").alias("_w")).agg(F.sum("_c._dn").alias("_dn"), F.sum("_c._dv").alias("_dv")))
    w = Window.partitionBy(*keys).orderBy("_w")
    to_here = w.rowsBetween(Window.unboundedPreceding, 0)
    steps = changes.select(*keys, "_w", F.lead("_w").over(w).alias("_next"),
                           F.sum("_dn").over(to_here).alias("pv"), F.sum("_dv").over(to_here).alias("uv"))
    ends = steps.where("pv > 0").select(*keys, F.explode(F.sequence("_w", F.col("_next") - 1)).alias("_w"), "pv", "uv")
    start_us = (F.col("_w") - (r - 1)) * pane

    def moment(us):
        return F.timestamp_micros(us) if not is_zoneless else F.timestamp_add(
            "MICROSECOND", us, F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'"))
    return (ends.where(F.pmod(start_us, F.lit(slide_us)) == 0)
            .select(moment(start_us).alias("window_start"), moment(start_us + size_us).alias("window_end"), *keys,
                    "pv", "uv", F.expr("pv div uv").cast("double").alias("ratio")))


def distinct_per_window(df: DataFrame, ts: str, col: str, size, slide=None, offset=None,
                        keys: list[str] = (), name: str = "uv", exact: bool = True) -> DataFrame:
    """A5: distinct values of ``col`` per window, with window start/end."""
    agg = F.countDistinct(col) if exact else F.approx_count_distinct(col)
    return (df.groupBy(*keys, W.assign(ts, size, slide, offset).alias("window"))
            .agg(agg.alias(name))
            .select(*W.bounds(), *keys, name))


def running_count(df: DataFrame, keys: list[str], order: list[str], name: str = "running_count",
                  measure: Column | None = None, previous: str | None = None, **seq_kw) -> DataFrame:
    """A1: one output per input row: the key's running sum (count by default).
    ``previous`` names a struct column with the value before the row, null on a key's
    first row; both come from one shuffle."""
    seq = KeyedSequence(list(keys), list(order), **seq_kw)
    d = seq.prepare(df)
    spec = ("count", F.lit(1)) if measure is None else ("sum", measure)
    d = seq.running(d, {name: spec})
    if previous is not None:
        d = seq.running(d, {"_was": spec, "_rows": ("count", F.lit(1))}, inclusive=False)
        d = d.withColumn(previous, F.when(F.col("_rows") > 0, F.struct(F.col("_was").alias(name)))).drop("_was", "_rows")
    return seq.finish(d)


def running_max(df: DataFrame, col: str, order: list[str], name: str = "running_max",
                keys: list[str] = (), **seq_kw) -> DataFrame:
    """A2: running max of ``col`` over ``order`` (global when ``keys`` is
    empty) — bucketed prefix max, never a single-task window."""
    seq = KeyedSequence(list(keys), list(order), **seq_kw)
    d = seq.prepare(df)
    return seq.finish(seq.running(d, {name: ("max", F.col(col))}))


def update_log(running: DataFrame, keys: list[str], cnt: str = "running_count",
               order: list[str] | None = None, previous: str | None = None, **seq_kw) -> DataFrame:
    """The change log of a running value: ``+I`` for a key's first value,
    then ``-U`` (old value) and ``+U`` (new value) for each later update.

    The old value is in ``previous`` (see :func:`running_count`; no further scan); or,
    with ``order``, on the key's previous row (any running aggregate); without both,
    ``running`` is taken to be a running count, whose old value is one less (no scan;
    also usable on streams)."""
    if previous is not None:
        d = running.withColumn("_old", F.col(f"{previous}.{cnt}")).withColumn("_first", F.col(previous).isNull())
    elif order is None:
        d = running.withColumn("_old", F.when(F.col(cnt) != 1, F.col(cnt) - 1)).withColumn(
            "_first", F.col(cnt) == 1)
    else:
        seq = KeyedSequence(list(keys), list(order), **seq_kw)
        d = seq.finish(seq.lag(seq.prepare(running), [cnt], 1, prefix="_was"))
        d = d.withColumn("_old", F.col(f"_was1.{cnt}")).withColumn("_first", F.col("_was1").isNull()).drop("_was1")
    first = F.array(F.struct(F.lit("+I").alias("op"), F.col(cnt).alias("cnt"), F.lit(0).alias("seq")))
    upd = F.array(F.struct(F.lit("-U").alias("op"), F.col("_old").alias("cnt"), F.lit(0).alias("seq")),
                  F.struct(F.lit("+U").alias("op"), F.col(cnt).alias("cnt"), F.lit(1).alias("seq")))
    return (d.withColumn("_ch", F.explode(F.when(F.col("_first"), first).otherwise(upd)))
            .select(*[c for c in running.columns if c not in (cnt, previous)],
                    F.col("_ch.op").alias("op"), F.col("_ch.cnt").cast("bigint").alias("cnt"),
                    F.col("_ch.seq").alias("seq")))


class UserAggregate:
    """A user-defined aggregate kept mergeable.

    The accumulator is a set of built-in aggregate columns (each one has
    Spark's partial / merge / final phases, so hot keys are combined in
    parallel — the reference left ``merge`` unimplemented) and ``result`` is
    an expression over the accumulator fields (the ``getResult`` step).

    >>> pvuv = UserAggregate({"pv": F.count(F.lit(1)), "uv": F.countDistinct("user_id")},
    ...                      F.expr("pv div uv").cast("double"))
    """

    def __init__(self, accumulator: dict[str, Column], result: Column | None = None,
                 name: str = "result"):
        self.accumulator, self.result, self.name = accumulator, result, name

    def apply(self, df: DataFrame, keys: list) -> DataFrame:
        out = df.groupBy(*keys).agg(*[c.alias(n) for n, c in self.accumulator.items()])
        return out if self.result is None else out.withColumn(self.name, self.result)
