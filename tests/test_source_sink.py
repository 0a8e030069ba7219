"""The source with offsets of its own, and the rolling sink with commit hooks."""

import json
import os
import tempfile
import time

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventide.sources import stored_stream as S
from eventide.streaming import rolling as R

SCHEMA = T.StructType([T.StructField("id", T.LongType()), T.StructField("ts", T.TimestampNTZType()),
                       T.StructField("s", T.StringType())])


def stored(files, group_rows=100):
    """Files of ``rows`` numbered rows each, in row groups of ``group_rows``."""
    base = tempfile.mkdtemp(prefix="stored-", dir="/tmp") + "/in"
    os.makedirs(base)
    at = 0
    for f, rows in enumerate(files):
        ids = list(range(at, at + rows))
        pq.write_table(pa.table({"s": [f"s{i}" if i % 5 else None for i in ids], "id": pa.array(ids, pa.int64()),
                                 "ts": pa.array([i * 1_000_000 for i in ids], pa.timestamp("us"))}),
                       f"{base}/f{f:03d}.parquet", row_group_size=group_rows)
        at += rows
    return base


def run(spark, base, out, limit, stop_after=None, **kw):
    stream = S.stored_rows(spark, base, SCHEMA, out + "/progress", limit)
    q = R.start_rolling(stream, out + "/files", "t", checkpoint=out + "/ckpt", **kw)
    try:
        if stop_after is None:
            q.processAllAvailable()
        else:
            while q.lastProgress is None or q.lastProgress["batchId"] < stop_after:
                time.sleep(0.02)
    finally:
        q.stop()


def test_stream_in_limits_and_in_order(spark):
    base, out = stored([250, 0, 130, 70]), tempfile.mkdtemp(prefix="sink-", dir="/tmp")
    run(spark, base, out, 60)
    epochs = R.manifests(spark, out + "/files")
    assert [sum(f["rows"] for f in files) for _, files in sorted(epochs.items())] == [60] * 7 + [30]
    got = R.read_rolled(spark, out + "/files", SCHEMA)
    assert [r.id for r in got.orderBy("id").collect()] == list(range(450))
    assert got.where("s IS NULL").count() == 90 and got.where(F.col("ts") != F.timestamp_seconds("id").cast("timestamp_ntz")).count() == 0


def test_restart_in_the_middle_of_a_file(spark):
    """Stopped in a file, and again after new files came: every row once."""
    base, out = stored([300, 200]), tempfile.mkdtemp(prefix="sink-", dir="/tmp")
    run(spark, base, out, 70, stop_after=1)
    noted = json.load(open(out + "/progress/planned.json"))
    assert 0 < noted["row"] < 300 or noted["file"] == "f001.parquet"
    run(spark, base, out, 45)
    more = stored([60])
    table = pq.read_table(f"{more}/f000.parquet")
    pq.write_table(table.set_column(table.schema.get_field_index("id"), "id", pa.array(range(500, 560))), f"{base}/f002.parquet")
    run(spark, base, out, 1_000)
    ids = sorted(r.id for r in R.read_rolled(spark, out + "/files", SCHEMA).collect())
    assert ids == list(range(560))


def test_a_planned_batch_is_read_again_between_its_offsets():
    """As Spark does after a crash between planning and commit."""
    base, out = stored([100, 100]), tempfile.mkdtemp(prefix="plan-", dir="/tmp")
    options = {"path": f"file:{base}", "progress": f"file:{out}/p", "rowsPerTrigger": "130"}
    reader = S.StoredRowsReader(SCHEMA, options)
    start, end = reader.initialOffset(), reader.latestOffset()
    assert end == {"file": "f001.parquet", "row": 30} and reader.latestOffset() == end

    def ids(r, a, b):
        return [i for cut in r.partitions(a, b) for batch in r.read(cut) for i in batch.column("id").to_pylist()]
    assert ids(reader, start, end) == list(range(130))
    again = S.StoredRowsReader(SCHEMA, options)            # a new process
    assert ids(again, start, end) == list(range(130))
    assert again.latestOffset() == S.StoredRowsReader(SCHEMA, options).latestOffset() == {"file": "f001.parquet", "row": 100}
    assert ids(again, end, again.latestOffset()) == list(range(130, 200))
    assert again.latestOffset() == {"file": "f001.parquet", "row": 100}


@pytest.mark.parametrize("roll_bytes", [20_000, 1 << 30])
def test_files_roll_by_bytes(spark, roll_bytes):
    base, out = stored([40_000], 40_000), tempfile.mkdtemp(prefix="sink-", dir="/tmp")
    run(spark, base, out, 100_000, roll_bytes=roll_bytes)
    files = [f for listed in R.manifests(spark, out + "/files").values() for f in listed]
    assert sum(f["rows"] for f in files) == 40_000
    assert all(os.path.getsize(f"{out}/files/data/{f['file']}") == f["bytes"] for f in files)
    if roll_bytes == 20_000:
        one_step = max(f["bytes"] / -(-f["rows"] // R.STEP_ROWS) for f in files)
        assert len(files) > 5 and all(f["bytes"] < 20_000 + 2 * one_step + 4_000 for f in files)
    else:
        assert len(files) == 1


def batches(n, rows=10):
    for i in range(n):
        yield pa.RecordBatch.from_pydict({"id": pa.array(range(i * rows, (i + 1) * rows), pa.int64())})


def writer(out, **options):
    return R.RollingWriter({"path": f"file:{out}", **options})


def data(out):
    return sorted(os.listdir(out + "/data"))


def test_files_roll_by_age():
    out = tempfile.mkdtemp(prefix="age-", dir="/tmp")

    def slow():
        for b in batches(6):
            yield b
            time.sleep(0.12)
    files = writer(out, rollSeconds="0.2").write(slow()).files
    assert 2 <= len(files) <= 4 and sum(r for _, r, _ in files) == 60


def test_failed_task_and_replayed_epoch_leave_no_extra_rows(spark):
    out = tempfile.mkdtemp(prefix="epoch-", dir="/tmp")
    schema = T.StructType([T.StructField("id", T.LongType())])

    def broken():
        yield from batches(2)
        raise OSError("lost")
    w = writer(out)
    with pytest.raises(OSError):
        w.write(broken())                                   # a task that dies leaves files, listed nowhere
    w.commit([writer(out).write(batches(3)), None, writer(out).write(iter([]))], 0)
    assert R.read_rolled(spark, out, schema).count() == 30
    first = [f["file"] for f in R.manifests(spark, out)[0]]
    writer(out).commit([writer(out).write(batches(3))], 0)  # the epoch again, after a crash before Spark's own commit
    assert R.read_rolled(spark, out, schema).count() == 30
    assert not set(first) & set(data(out))
    lost = writer(out).write(batches(4))
    before = data(out)
    writer(out).abort([lost, None], 1)
    assert set(before) - set(data(out)) == {n for n, _, _ in lost.files}
    assert sorted(R.manifests(spark, out)) == [0] and R.read_rolled(spark, out, schema).count() == 30
    writer(out).commit([], 1)
    assert R.manifests(spark, out)[1] == [] and R.read_rolled(spark, tempfile.mkdtemp(dir="/tmp"), schema).count() == 0
