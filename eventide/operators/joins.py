"""Two-stream operators.

Column names of the two sides must be distinct apart from the keys; callers
rename (``l_*`` / ``r_*``) before joining.  All joins are equi-joins on the
keys plus a time bucket, so a key with a long history is split over many
tasks, and AQE's skew-join handling can split a hot (key, bucket) further.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import windows as W
from .sequence import (CROSSES, JSON_TIMES, KeyedSequence, array_literal, order_micros, scan_udf,
                       sorted_position)


# Some functions here run in Python workers; ship them by value.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def _micros(df: DataFrame, col: str):
    return order_micros(df, col).cast("bigint")


def interval_join(left: DataFrame, right: DataFrame, keys: list[str], l_ts: str, r_ts: str,
                  lower, upper, bucket=None) -> DataFrame:
    """Inner join where ``r_ts`` lies in ``[l_ts + lower, l_ts + upper]``
    (both ends inclusive) for equal keys.

    The right side is bucketed by ``r_ts`` into ``bucket``-wide slots (default:
    the bound width); each left row is sent to the few slots its range
    touches.  Every pair is compared once, and candidate pairs are at most a
    small multiple of the matches instead of all pairs of a key."""
    lo, hi = W.seconds(lower), W.seconds(upper)
    if hi < lo:
        raise ValueError("upper bound below lower bound")
    width = W.seconds(bucket) if bucket is not None else max(hi - lo, 1e-3)
    b = max(1, int(math.ceil(width * 1_000_000)))
    lo_us, hi_us = int(round(lo * 1_000_000)), int(round(hi * 1_000_000))
    r = right.withColumn("_b", F.floor(_micros(right, r_ts) / b))
    lm = _micros(left, l_ts)
    l = left.withColumn("_b", F.explode(F.sequence(F.floor((lm + lo_us) / b),
                                                   F.floor((lm + hi_us) / b))))
    cond = [l[k] == r[k] for k in keys] + [
        l["_b"] == r["_b"],
        r[r_ts] >= l[l_ts] + W.interval(lo) if lo >= 0 else r[r_ts] >= l[l_ts] - W.interval(-lo),
        r[r_ts] <= l[l_ts] + W.interval(hi) if hi >= 0 else r[r_ts] <= l[l_ts] - W.interval(-hi),
    ]
    out = l.join(r, on=cond, how="inner")
    return out.select(*[l[k] for k in keys],
                      *[l[c] for c in left.columns if c not in keys],
                      *[r[c] for c in right.columns if c not in keys])


def window_join(left: DataFrame, right: DataFrame, keys: list[str], l_ts: str, r_ts: str,
                size, offset=None) -> DataFrame:
    """Inner join of rows with equal keys in the same tumbling window
    (all pairs of each (key, window))."""
    l = left.withColumn("_w", W.tumbling(l_ts, size, offset))
    r = right.withColumn("_w", W.tumbling(r_ts, size, offset).start)
    l = l.withColumns({"window_start": F.col("_w.start"), "window_end": F.col("_w.end")}).drop("_w")
    r = r.withColumnRenamed("_w", "window_start")
    return l.join(r, on=[*keys, "window_start"], how="inner").select(
        *keys, "window_start", "window_end",
        *[c for c in left.columns if c not in keys], *[c for c in right.columns if c not in keys])


def _tagged(left: DataFrame, right: DataFrame, keys: list[str], l_ts: str, r_ts: str,
            l_id: str, r_id: str, size, offset=None) -> DataFrame:
    def side(df, ts, idc, tag):
        w = W.tumbling(ts, size, offset)
        return df.select(*keys, w.start.alias("window_start"), w.end.alias("window_end"),
                         F.lit(tag).alias("side"), F.col(idc).alias("element_id"))
    return side(left, l_ts, l_id, "left").unionByName(side(right, r_ts, r_id, "right"))


def window_cogroup(left: DataFrame, right: DataFrame, keys: list[str], l_ts: str, r_ts: str,
                   l_id: str, r_id: str, size, offset=None) -> DataFrame:
    """One row per (key, window) present on either side, with the size
    of both groups (0 for an empty side) and the first / last element ids.
    Partial aggregation: no group is ever materialised."""
    u = _tagged(left, right, keys, l_ts, r_ts, l_id, r_id, size, offset)
    is_l, is_r = F.col("side") == "left", F.col("side") == "right"
    return (u.groupBy(*keys, "window_start", "window_end")
            .agg(F.count(F.when(is_l, 1)).alias("n_left"), F.count(F.when(is_r, 1)).alias("n_right"),
                 F.min(F.when(is_l, F.col("element_id"))).alias("left_first"),
                 F.max(F.when(is_l, F.col("element_id"))).alias("left_last"),
                 F.min(F.when(is_r, F.col("element_id"))).alias("right_first"),
                 F.max(F.when(is_r, F.col("element_id"))).alias("right_last")))


def window_cogroup_members(left: DataFrame, right: DataFrame, keys: list[str], l_ts: str,
                           r_ts: str, l_id: str, r_id: str, size, offset=None) -> DataFrame:
    """J3, element form: every element with its side and both group sizes —
    the co-grouped lists, one row per element instead of one list per group."""
    u = _tagged(left, right, keys, l_ts, r_ts, l_id, r_id, size, offset)
    sizes = window_cogroup(left, right, keys, l_ts, r_ts, l_id, r_id, size, offset) \
        .select(*keys, "window_start", "n_left", "n_right")
    return u.join(sizes, on=[*keys, "window_start"], how="inner")


def reconcile(left: DataFrame, right: DataFrame, keys: list[str], l_ts: str, r_ts: str,
              l_id: str, r_id: str, within, **seq_kw) -> DataFrame:
    """J4 (many-to-many form): pair rows of equal key whose times differ by
    at most ``within``; rows without a partner are reported alone.

    ``status`` is ``matched``, ``left_only`` or ``right_only``.  The pairs are one
    bucketed inner join.  A row is alone if the nearest rows of the other side
    before and after it (one ordered scan over both sides) are out of reach, or
    if a key is null, which matches nothing."""
    pairs = interval_join(left, right, keys, l_ts, r_ts, -W.seconds(within), W.seconds(within))
    lcols = [c for c in left.columns if c not in keys]
    rcols = [c for c in right.columns if c not in keys]
    matched = pairs.select(*keys, *lcols, *rcols, F.lit("matched").alias("status"))

    def side(df, ts, cols, other, tag):
        return df.select(*keys, F.col(ts).alias("_ts"), F.lit(tag).alias("_side"), *cols,
                         *[F.lit(None).cast(t).alias(c) for c, t in other])
    typed = lambda df, cols: [(c, df.schema[c].dataType) for c in cols]
    both = side(left, l_ts, lcols, typed(right, rcols), 0).unionByName(
        side(right, r_ts, rcols, typed(left, lcols), 1))
    seq = KeyedSequence(list(keys), ["_ts", "_side"], **seq_kw)
    d = seq.prepare(both)
    times = {0: F.when(F.col("_side") == 0, F.col("_ts")), 1: F.when(F.col("_side") == 1, F.col("_ts"))}
    d = seq.running(d, {f"_before{k}": ("max", t) for k, t in times.items()})
    d = seq.finish(seq.running(d, {f"_after{k}": ("min", t) for k, t in times.items()}, reverse=True))
    reach = W.interval(within)

    def near(k):
        return (F.coalesce(F.col(f"_before{k}") >= F.col("_ts") - reach, F.lit(False))
                | F.coalesce(F.col(f"_after{k}") <= F.col("_ts") + reach, F.lit(False)))
    no_key = F.lit(False)
    for k in keys:
        no_key = no_key | F.col(k).isNull()
    is_left = F.col("_side") == 0
    alone = (d.filter(no_key | ~F.when(is_left, near(1)).otherwise(near(0)))
             .select(*keys, *lcols, *rcols, F.when(is_left, F.lit("left_only")).otherwise(F.lit("right_only"))
                     .alias("status")))
    return matched.unionByName(alone)


def _clamped_sum(lo: np.ndarray, hi: np.ndarray, step: np.ndarray, opens: np.ndarray):
    """Row i -> the map q -> clip(q, lo, hi) + step composed from the last opening row
    up to row i.  Such maps are closed under composition, so this is a segmented
    doubling scan over three numbers per row."""
    lo, hi, step = lo.copy(), hi.copy(), step.copy()
    seg = np.cumsum(opens)
    k = 1
    while k < len(lo):
        same = seg[k:] == seg[:-k]
        if not same.any():
            break
        first = lo[:-k][same], hi[:-k][same], step[:-k][same]
        at = np.flatnonzero(same) + k
        low, high = lo[at] - first[2], hi[at] - first[2]
        lo[at], hi[at] = np.clip(first[0], low, high), np.clip(first[1], low, high)
        step[at] = step[at] + first[2]
        k *= 2
    return lo, hi, step


def _queue_scan(batches: Iterator[tuple[pd.Series, ...]]):
    """Per batch the composed maps since the chunk's first row, including each row."""
    carry = None
    for lo, hi, step, opens in batches:
        first = opens.to_numpy(dtype=bool)
        low, high, total = _clamped_sum(lo.to_numpy(dtype=np.int64), hi.to_numpy(dtype=np.int64),
                                        step.to_numpy(dtype=np.int64), first)
        if len(low) and carry is not None:
            head = np.cumsum(first) == 0
            below, above = low[head] - carry[2], high[head] - carry[2]
            low[head], high[head] = np.clip(carry[0], below, above), np.clip(carry[1], below, above)
            total[head] += carry[2]
        if len(low):
            carry = low[-1], high[-1], total[-1]
        yield low, high, total


def _queue_maps(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.Series]:
    for maps in _queue_scan(batches):
        yield pd.Series(list(np.stack(maps, axis=1)), dtype=object)


def _queue_after(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.Series]:
    begins: list[np.ndarray] = []

    def inner():
        for *maps, entry in batches:
            begins.append(entry.fillna(0).to_numpy(dtype=np.int64))
            yield maps
    for low, high, total in _queue_scan(inner()):
        yield pd.Series(np.clip(begins.pop(), low, high) + total)


def _queue_entries(totals: pd.Series) -> pd.Series:
    def one(maps):
        q, out = 0, []
        for low, high, total in maps:
            out.append(q)
            q = int(min(max(q, low), high) + total)
        return out
    return totals.map(one)


def reconcile_one_to_one(left: DataFrame, right: DataFrame, keys: list[str], l_ts: str, r_ts: str,
                         l_id: str, r_id: str, within, **seq_kw) -> DataFrame:
    """J4 (one-to-one form): in order of time and id, a row takes the oldest waiting
    row of the other side that is at most ``within`` older, or waits itself; rows
    that neither take nor are taken are reported alone, as are rows with null keys.

    Rows of one side wait at a time, and as the oldest is always taken or given up
    first, those are the last q rows of that side: the queue is one number (positive:
    left rows wait, negative: right rows).  A row first limits q to the rows of each
    side that are still within reach, then adds 1 (left) or takes 1 away (right).  Such
    maps compose to maps of the same form, so the queue before every row is a scan
    over chunks: also a key that holds all rows, without any gap, is spread over all
    chunks, and one number crosses a border between them.

    How many rows are within reach is a running count: every row is accompanied by a
    mark at its last moment, and rows minus marks before a place are those in reach.
    A row that takes meets the row it takes by (key, side, number of the row)."""
    reach = W.interval(within)

    def side(df, ts, idc, is_left):
        return df.select(*keys, F.col(ts).alias("ts"), F.col(idc).alias("id"), F.lit(is_left).alias("is_left"))
    both = side(left, l_ts, l_id, True).unionByName(side(right, r_ts, r_id, False))
    no_key = F.lit(False)
    for k in keys:
        no_key = no_key | F.col(k).isNull()
    marks = F.explode(F.array(F.struct(F.col("ts").alias("at"), F.lit(0).alias("mark")),
                              F.struct((F.col("ts") + reach).alias("at"), F.lit(1).alias("mark"))))
    rows = both.filter(~no_key).select("*", marks.alias("_m")).select("*", "_m.at", "_m.mark").drop("_m")

    # rows up to the last moment, itself included, come before its mark
    seq = KeyedSequence(list(keys), ["at", "mark", "id", "is_left"], **seq_kw)
    is_left, is_row = F.col("is_left"), F.col("mark") == 0

    def count(of_left: bool, row: bool):
        return F.when((is_left if of_left else ~is_left) & (is_row if row else ~is_row), 1).otherwise(0)
    d = seq.running(seq.prepare(rows), {
        name: ("sum", count(of_left, row)) for name, of_left, row in
        (("_rl", True, True), ("_rr", False, True), ("_ml", True, False), ("_mr", False, False))}, inclusive=False)
    d = d.withColumns({c: F.coalesce(c, F.lit(0)) for c in ("_rl", "_rr", "_ml", "_mr")})
    # marks have done their work: a row limits the queue itself
    d = d.filter(is_row).withColumns({
        "_lo": F.col("_mr") - F.col("_rr"), "_hi": F.col("_rl") - F.col("_ml"),
        "_by": F.when(is_left, 1).otherwise(-1), "_opens": seq.opens()})
    maps = [F.col(c) for c in ("_lo", "_hi", "_by", "_opens")]
    crossing = d.filter(CROSSES).withColumn("_map", scan_udf(_queue_maps, "array<bigint>")(*maps))
    entries = seq.entry_rows(crossing, "_map", F.pandas_udf(_queue_entries, "array<bigint>"), "_entry")
    d = (seq.add_carry(d, entries, ["_entry"])
         .withColumn("_q", scan_udf(_queue_after, "bigint")(*maps, F.col("_entry"))))
    before = F.col("_q") - F.col("_by")
    takes = F.when(is_left, before < 0).otherwise(before > 0)
    d = d.withColumns({"_takes": takes, "_no": F.when(is_left, F.col("_rl")).otherwise(F.col("_rr")),
                       "_oldest": F.when(is_left, F.col("_rr") + before).otherwise(F.col("_rl") - before)})
    d = seq.finish(d).select(*keys, "ts", "id", "is_left", "_takes", "_no", "_oldest")

    # the row that waited and the one that took it, if any, have one (key, side, number)
    takes, waits = F.col("_takes"), ~F.col("_takes")
    waited = (d.select(*keys, F.when(takes, ~is_left).otherwise(is_left).alias("is_left"),
                       F.when(takes, F.col("_oldest")).otherwise(F.col("_no")).alias("_no"), "_takes", "id", "ts")
              .groupBy(*keys, "is_left", "_no")
              .agg(F.max(F.when(waits, F.col("id"))).alias("id"), F.max(F.when(waits, F.col("ts"))).alias("ts"),
                   F.max(F.when(takes, F.col("id"))).alias("o_id"), F.max(F.when(takes, F.col("ts"))).alias("o_ts")))
    alone = both.filter(no_key).select("*", *[F.lit(None).cast(t).alias(c) for c, t in (
        ("o_id", both.schema["id"].dataType), ("o_ts", both.schema["ts"].dataType))])
    cols = [*keys, "ts", "id", "is_left", "o_id", "o_ts"]

    def pick(mine, other):
        return F.when(is_left, F.col(mine)).otherwise(F.col(other))
    return waited.select(*cols).unionByName(alone.select(*cols)).select(
        *keys, pick("id", "o_id").alias(l_id), pick("ts", "o_ts").alias(l_ts),
        pick("o_id", "id").alias(r_id), pick("o_ts", "ts").alias(r_ts),
        F.when(F.col("o_id").isNotNull(), F.lit("matched")).when(is_left, F.lit("left_only"))
        .otherwise(F.lit("right_only")).alias("status"))


#: Rules up to this number are searched inside the plan.
MAX_RULES_IN_PLAN = 2_000


def with_rule(ev: DataFrame, rules: DataFrame, ts: str, rule_ts: str = "rule_ts",
              order: list[str] = (), max_in_plan: int = MAX_RULES_IN_PLAN, **seq_kw) -> DataFrame:
    """The rule in force at each row's time (latest ``rule_ts <= ts``) as the struct
    ``rule``.  Of rules with equal start the greatest one counts.

    The number of rules is checked: up to ``max_in_plan`` are a sorted array that each
    row searches (no shuffle); more are merged into the time order and carried
    forward by an ordered scan."""
    rule_cols = [c for c in rules.columns if c != rule_ts]
    starts = rules.where(F.col(rule_ts).isNotNull()).groupBy(rule_ts).agg(F.max(F.struct(*rule_cols)).alias("_rule"))
    kind = starts.select(F.struct(F.col(rule_ts).alias("at"), "_rule").alias("r")).schema["r"].dataType
    few = starts.select(F.struct(F.col(rule_ts).alias("at"), "_rule").alias("r")).limit(max_in_plan + 1)
    text, size = few.agg(F.sort_array(F.collect_list("r")).alias("r")).select(
        F.to_json("r", JSON_TIMES), F.size("r")).first()
    if size <= max_in_plan:
        in_order = array_literal(text, kind)
        at = sorted_position(F.col(ts), lambda i: F.get(in_order, i)["at"], size)
        return ev.withColumn("rule", F.get(in_order, at - 1)["_rule"])
    tagged = (ev.select("*", F.lit(1).alias("_is_ev"))
              .unionByName(starts.select(F.col(rule_ts).alias(ts), F.lit(0).alias("_is_ev"), "_rule"),
                           allowMissingColumns=True))
    seq = KeyedSequence([], [ts, "_is_ev", *[o for o in order if o != ts]], **seq_kw)
    d = seq.running(seq.prepare(tagged), {"rule": ("last", F.col("_rule"))})
    return seq.finish(d).filter(F.col("_is_ev") == 1).drop("_is_ev", "_rule")


def previous_with_rule(ev: DataFrame, rules: DataFrame, keys: list[str], order: list[str],
                       ts: str, cols: list[str], rule_ts: str = "rule_ts",
                       **seq_kw) -> DataFrame:
    """Each event with the previous event of its key (``prev`` struct of
    ``cols``) and the rule in force at its time (:func:`with_rule`)."""
    seq = KeyedSequence(list(keys), list(order), **seq_kw)
    d = seq.finish(seq.lag(seq.prepare(ev), cols, 1, prefix="_prev")).withColumnRenamed("_prev1", "prev")
    return with_rule(d, rules, ts, rule_ts, order, **seq_kw)


def connect_map(first: DataFrame, second: DataFrame, map1, map2, name: str = "v") -> DataFrame:
    """Two inputs of different types mapped to one output type and
    merged (``union``; no shuffle)."""
    a = first.select(F.lit("first").alias("src"), map1.alias(name))
    b = second.select(F.lit("second").alias("src"), map2.alias(name))
    return a.unionByName(b)
