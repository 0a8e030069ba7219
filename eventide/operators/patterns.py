"""Event patterns per key (C1-C5) as ordered scans, not NFA runtimes.

Input order inside a key is ``order`` (event time, then arrival id).  All
scans go through :class:`KeyedSequence`, so a key with a huge history is
split into chunks instead of landing on one task.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import windows as W
from .sequence import CROSSES, KeyedSequence, scan_udf


# Functions and classes of this module run in Python workers (and in the
# driver-side runner that initialises stateful processors); ship them by value
# so those processes need not import this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def followed_by(df: DataFrame, keys: list[str], order: list[str], ts: str, first: Column,
                then: Column, within, cols: list[str], **seq_kw) -> tuple[DataFrame, DataFrame]:
    """C1 + C4: ``begin(first).followedBy(then).within(within)`` per key.

    Relaxed contiguity (other rows in between are skipped), the first later
    ``then`` row completes the match, no skipping after a match (several
    ``first`` rows can share one ``then`` row), and the limit is strict:
    ``then.ts - first.ts < within``.  Returns ``(matches, timeouts)``; a
    timed-out partial match is reported at ``first.ts + within`` (at the end
    of a bounded input every open partial match times out).
    """
    seq = KeyedSequence(list(keys), list(order), **seq_kw)
    d = seq.prepare(df.withColumn("_first", first).withColumn("_then", then))
    payload = F.struct(*[F.col(c) for c in order], *[F.col(c) for c in cols if c not in order])
    d = seq.running(d, {"_next": ("min", F.when(F.col("_then"), payload))},
                    reverse=True, inclusive=False)
    d = seq.finish(d).filter(F.col("_first"))
    ok = F.col("_next").isNotNull() & (F.col(f"_next.{ts}") < F.col(ts) + W.interval(within))
    base = [*keys, *[c for c in cols if c not in keys]]
    matches = d.filter(ok).select(*keys, *[F.col(c).alias(f"first_{c}") for c in base if c not in keys],
                                  *[F.col(f"_next.{c}").alias(f"then_{c}") for c in base if c not in keys])
    timeouts = d.filter(~ok).select(*keys, *[F.col(c).alias(f"first_{c}") for c in base if c not in keys],
                                    (F.col(ts) + W.interval(within)).alias("timeout_ts"))
    return matches, timeouts


def strict_sequence(df: DataFrame, keys: list[str], order: list[str], conds: list[Column],
                    cols: list[str], **seq_kw) -> DataFrame:
    """``begin(c1).next(c2)...next(cn)`` — n rows in a row of one key
    (strict contiguity) satisfying the conditions in turn; overlapping
    matches are all kept.  ``times(n).consecutive()`` is the same with one
    condition repeated.  One output row per match: ``e{j}_{col}`` for the
    j-th row of the match."""
    n = len(conds)
    seq = KeyedSequence(list(keys), list(order), **seq_kw)
    d = seq.prepare(df.withColumns({f"_c{j}": c for j, c in enumerate(conds)}))
    payload_cols = [*cols, *[f"_c{j}" for j in range(n - 1)]]
    d = seq.finish(seq.lag(d, payload_cols, n - 1, prefix="_p")) if n > 1 else seq.finish(d)
    # Row i ends a match when cond_{n-1}(i), cond_{n-2}(i-1), ..., cond_0(i-n+1).
    ok = F.col(f"_c{n - 1}")
    for back in range(1, n):
        ok = ok & F.coalesce(F.col(f"_p{back}._c{n - 1 - back}"), F.lit(False))
    sel = [*keys]
    for j in range(n):             # j-th element of the match, 1-based
        back = n - 1 - j
        for c in cols:
            src = F.col(c) if back == 0 else F.col(f"_p{back}.{c}")
            sel.append(src.alias(f"e{j + 1}_{c}"))
    return d.filter(ok).select(*sel)


def consecutive(df: DataFrame, keys: list[str], order: list[str], cond: Column, times: int,
                cols: list[str], **seq_kw) -> DataFrame:
    """``where(cond).times(n).consecutive()``."""
    return strict_sequence(df, keys, order, [cond] * times, cols, **seq_kw)


# ---------------------------------------------------------------- C5: FSM
class StateMachine:
    """A deterministic state machine over event types.

    ``transitions`` maps ``(state, event) -> state``; an event with no
    transition keeps the state.  When ``reset_on_accept`` is set, an accepting
    state behaves like ``start`` for the next event (so each completed cycle
    is reported once).
    """

    def __init__(self, transitions: dict[tuple[str, str], str], start: str,
                 accept: set[str], reset_on_accept: bool = True):
        self.states = sorted({start, *accept, *[s for s, _ in transitions], *transitions.values()})
        self.events = sorted({e for _, e in transitions})
        self.start, self.accept = start, set(accept)
        sid = {s: i for i, s in enumerate(self.states)}
        # table[event_index, state] -> next state; row len(events) = unknown event
        tab = np.tile(np.arange(len(self.states)), (len(self.events) + 1, 1))
        for (s, e), t in transitions.items():
            tab[self.events.index(e), sid[s]] = sid[t]
        if reset_on_accept:
            for a in accept:
                tab[:, sid[a]] = tab[:, sid[start]]
                tab[len(self.events), sid[a]] = sid[start]
        self.table = tab
        self.sid = sid

    def event_index(self, col: str) -> Column:
        expr = F.lit(len(self.events))
        for i, e in reversed(list(enumerate(self.events))):
            expr = F.when(F.col(col) == e, F.lit(i)).otherwise(expr)
        return expr

    def prefix_functions(self, ev_idx: np.ndarray) -> np.ndarray:
        """Row i -> the state map after rows 0..i (parallel-prefix composition
        by doubling: log2(n) vectorised steps)."""
        p = self.table[ev_idx].copy()
        k = 1
        while k < len(p):
            p[k:] = np.take_along_axis(p[k:], p[:-k], axis=1)
            k *= 2
        return p


def _composed(p: np.ndarray, opens: np.ndarray) -> np.ndarray:
    """Row i -> the composition of the state maps from the last opening row up to
    row i, by segmented doubling."""
    seg = np.cumsum(opens)
    k = 1
    while k < len(p):
        same = seg[k:] == seg[:-k]
        if not same.any():
            break
        comp = np.take_along_axis(p[k:], p[:-k], axis=1)
        p[k:][same] = comp[same]
        k *= 2
    return p


def run_state_machine(df: DataFrame, keys: list[str], order: list[str], event_col: str,
                      fsm: StateMachine, **seq_kw) -> DataFrame:
    """The state of each key's machine after every row (``state``), and
    ``accepted`` when that state is accepting.

    A vectorised function streams over the sorted chunks and composes the per-row
    state maps with a segmented doubling scan, carrying the open map from batch to
    batch.  Run over the rows of crossing keys, its last maps give the state each of
    a key's chunks begins with (one linear pass over at most as many maps as there
    are chunks); run over all rows, it applies them."""
    seq = KeyedSequence(list(keys), list(order), **seq_kw)
    d = seq.prepare(df.withColumn("_ev", fsm.event_index(event_col)))
    start, table = fsm.sid[fsm.start], fsm.table

    def scan(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[np.ndarray]:
        carry = None
        for ev, opens in batches:
            first = opens.to_numpy(dtype=bool)
            p = _composed(table[ev.to_numpy(dtype=np.int64)].copy(), first)
            if len(p) and carry is not None:
                head = np.cumsum(first) == 0
                p[head] = p[head][:, carry]
            if len(p):
                carry = p[-1].copy()
            yield p

    def maps(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for p in scan(batches):
            yield pd.Series(list(p.astype(np.int32)), dtype=object)

    def states(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        begins: list[np.ndarray] = []

        def inner():
            for ev, opens, entry in batches:
                begins.append(entry.fillna(start).to_numpy(dtype=np.int64))
                yield ev, opens
        for p in scan(inner()):
            yield pd.Series(p[np.arange(len(p)), begins.pop()].astype(np.int32))

    def fold(totals: pd.Series) -> pd.Series:
        def one(chunk_maps):
            state, out = start, []
            for m in chunk_maps:
                out.append(state)
                state = int(m[state])
            return out
        return totals.map(one)

    d = d.withColumn("_opens", seq.opens())
    crossing = d.filter(CROSSES).withColumn("_map", scan_udf(maps, "array<int>")(F.col("_ev"), F.col("_opens")))
    d = seq.add_carry(d, seq.entry_rows(crossing, "_map", F.pandas_udf(fold, "array<int>"), "_entry"), ["_entry"])
    d = d.withColumn("_si", scan_udf(states, "int")(F.col("_ev"), F.col("_opens"), F.col("_entry")))
    names = F.array(*[F.lit(x) for x in fsm.states])
    out = d.withColumn("state", F.element_at(names, F.col("_si") + 1))
    out = out.withColumn("accepted", F.col("state").isin(list(fsm.accept)))
    return seq.finish(out).drop("_ev", "_opens", "_entry", "_si")
