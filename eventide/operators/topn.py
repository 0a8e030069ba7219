"""Top-N per window (N1, N2) and keyed buffering."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import windows as W


def rank_within(df: DataFrame, group: list[str], by: str, tie: list[str], n: int,
                ascending: bool = False, name: str = "rank") -> DataFrame:
    """Keep the first ``n`` rows of each group by ``by`` (ties broken by
    ``tie`` ascending).  ``row_number() <= n`` is planned as a
    ``WindowGroupLimit``: every task trims its share to ``n`` rows per group
    before the rows are shuffled, so a group with many candidates stays cheap."""
    first = F.col(by).asc() if ascending else F.col(by).desc()
    w = Window.partitionBy(*group).orderBy(first, *[F.col(c).asc() for c in tie])
    return df.withColumn(name, F.row_number().over(w)).filter(F.col(name) <= n)


def top_n_per_window(df: DataFrame, ts: str, size, key: str, n: int, slide=None, offset=None,
                     ascending: bool = False) -> DataFrame:
    """Count rows per (window, key), keep the top ``n`` keys per
    window (count desc, key asc; ``ascending=True`` gives the as-written
    ascending order)."""
    counts = (df.groupBy(W.assign(ts, size, slide, offset).alias("window"), key)
              .agg(F.count(F.lit(1)).alias("cnt"))
              .select(*W.bounds(), key, "cnt"))
    ranked = rank_within(counts, ["window_start", "window_end"], "cnt", [key], n, ascending)
    return ranked.select("window_start", "window_end", "rank", key, "cnt")


def buffer_flush(df: DataFrame, keys: list[str], ts: str, every, order: list[str],
                 **seq_kw) -> DataFrame:
    """Rows of a key are buffered and flushed at the next multiple of
    ``every`` (an event-time timer); the buffer is cleared at each flush.

    Result in long form — one row per buffered element with its flush time
    and 1-based position — so no buffer is ever materialised as one value,
    and a hot key's buffer is numbered by a chunked scan."""
    from .aggregates import running_count
    d = df.withColumn("flush_ts", W.tumbling(ts, every).end)
    return running_count(d, [*keys, "flush_ts"], order, name="position", **seq_kw)
