"""A large micro-batch is cut into files that tasks read side by side; its rows stay the same slice of time."""

import datetime as dt
import os
import tempfile

from pyspark.sql import functions as F

from eventide.plans import streams as P
from eventide.streaming import sinks as K


def test_batches_follow_the_rows_and_files_the_batch():
    assert P._cut(0) == (4, 1) and P._cut(100_000) == (4, 1) and P._cut(600_000) == (4, 3)
    assert P._cut(6_000_000) == (6, 20) and P._cut(1_000, 6_000_000) == (6, 20)
    for n in (10_000, 10 ** 6, 10 ** 9):
        batches, files = P._cut(n)
        assert n / batches <= P.ROWS_PER_TRIGGER and n / batches / files <= P.ROWS_PER_FILE


def test_large_batch_is_read_by_many_tasks(spark, monkeypatch):
    monkeypatch.setattr(P, "ROWS_PER_FILE", 25)
    base, seen = tempfile.mkdtemp(prefix="cut-", dir="/tmp"), []
    rows = spark.range(400).select(F.col("id").alias("event_id"), (F.lit(dt.datetime(2024, 1, 1)).cast("timestamp_ntz")
                                   + F.make_dt_interval(secs=(F.col("id") * 7) % 400)).alias("ts"))
    stream = P._replayed(spark, rows, os.path.join(base, "in"), ["ts", "event_id"], *P._cut(400), close=False)

    def note(df, i):
        lo, hi, n = df.agg(F.min("ts"), F.max("ts"), F.count("*")).first()
        seen.append((lo, hi, n, df.rdd.getNumPartitions()))
    K.start_batches(stream, note, "cut", trigger={"availableNow": True}, checkpoint=base + "/ckpt").awaitTermination()
    assert len(seen) == 4 and sum(n for _, _, n, _ in seen) == 400
    assert all(parts > 1 for *_, parts in seen)
    assert all(a[1] < b[0] for a, b in zip(seen, seen[1:]))
