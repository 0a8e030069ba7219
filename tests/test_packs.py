"""Rows cross the border to Python in packs, a bucket's rows of a task in one, and come back as columns."""

import datetime as dt
import pickle
import random
from types import SimpleNamespace

import pyarrow as pa
from pyspark.sql import Row
from pyspark.sql import functions as F

from eventide.streaming import stateful as ST

from .test_stream_state import drive


def _pack_row(rows):
    """Rows ``(id, ts, of)`` as one input row."""
    return Row(key=1, rows=pickle.dumps([list(c) for c in zip(*rows)]), et=None)


def test_a_task_hands_over_one_row_per_bucket(spark):
    rows = (spark.range(20_000, numPartitions=2).select(F.col("id").alias("event_id"), F.when(F.col("id") % 61 < 60, F.col("id") % 61).alias("user_id"),
                                                        F.timestamp_seconds(F.col("id") * 7 % 20_000).alias("et")))
    processor = ST.RunningCountProcessor()
    packs = ST._packed(ST._source(rows, "user_id", "event_id", "et"), "et", processor).collect()
    assert len(packs) <= 2 * 61 < 20_000
    got = {}
    for p in packs:
        (found,) = processor._read((p.key,), [p])
        assert max(r[1] for r in found) == int(p.et.timestamp()) * 1_000_000
        got.update({r[0]: r[1:] for r in found})
    assert got == {i: (i * 7 % 20_000 * 1_000_000, i % 61 if i % 61 < 60 else None) for i in range(20_000)}


def test_packs_keep_nulls_long_numbers_and_far_times():
    far, kind = dt.datetime(9999, 12, 31, tzinfo=dt.timezone.utc), pa.timestamp("us", tz="UTC")
    table = pa.table({"key": [5, 2, 5], "of": [None, 2 ** 62 + 1, None], "id": [None, 2 ** 60 + 1, 3], "ts": [3, 1, 2],
                      "type": ["a", None, ""], "et": pa.array([far, far, far.replace(year=1)], kind)})
    batch = ST._pack(table, ["id", "ts", "type", "of"], "et").to_pylist()
    assert [(b["key"], list(zip(*pickle.loads(b["rows"]))), b["et"]) for b in batch] == [
        (2, [(2 ** 60 + 1, 1, None, 2 ** 62 + 1)], far), (5, [(3, 2, "", None), (None, 3, "a", None)], far)]


def test_packs_and_plain_rows_give_the_same_columns():
    rng = random.Random(2)
    rows = [(i, rng.randrange(10 ** 6) * 60_000_000, rng.choice([1, 2, None])) for i in range(12_000)]
    plain = [SimpleNamespace(id=i, ts=ts, of=of) for i, ts, of in rows]
    want = [tuple(r) for r in drive(ST.RunningCountProcessor(), [(plain, 0), ([], 10 ** 13)])]
    packed = [_pack_row(rows[at:at + 1_000]) for at in range(0, 12_000, 1_000)]
    out = list(drive(ST.PackedProcessor(ST.RunningCountProcessor()), [(packed, 0), ([], 10 ** 13)]))
    assert len(out) == 3 and max(len(r.id) for r in out) == ST.OUT_ROWS
    assert [x for r in out for x in zip(*r)] == want


def test_waiting_pieces_stay_bounded():
    processor = ST.PackedProcessor(ST.RunningCountProcessor())
    rows = [(i, i * 1_000_000, 1) for i in range(30_000)]
    list(drive(processor, [([_pack_row(rows)], 0)]))
    pieces = processor.handle_seen.states["waiting"].data.values()
    sizes = [len(pickle.loads(p[0])[0]) for p in pieces]
    assert sum(sizes) == 30_000 and max(sizes) <= ST.PIECE_ROWS


def test_late_row_in_a_pack_is_dropped_alone():
    """The slot of row 3 has been handled when it comes; row 4 of the same pack is in time."""
    minute = 60_000_000
    out = drive(ST.PackedProcessor(ST.RunningCountProcessor()),
                [([_pack_row([(1, 0, 7), (2, 5 * minute, 7)])], 0), ([], 4 * 60_000),
                 ([_pack_row([(3, minute, 7), (4, 4 * minute, 7)])], 4 * 60_000), ([], 10 ** 9),
                 ([_pack_row([(5, 2 * minute, 7)])], 10 ** 9)])
    assert [x for r in out for x in zip(r.id, r.running_count)] == [(1, 1), (4, 2), (2, 3)]
