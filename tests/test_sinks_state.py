"""Sinks and state features without a registered query: K1, K2, V4, V6."""

import tempfile

import pytest
from pyspark.sql import functions as F

from eventide.sources.tables import EVENTS_SCHEMA, events
from eventide.streaming import sinks as K
from eventide.streaming import stateful as ST
from eventide.streaming.replay import replay, with_event_time, write_replay_files

from .conftest import SF001


@pytest.fixture(scope="module")
def src(spark):
    path = tempfile.mkdtemp(prefix="sinks-", dir="/tmp") + "/events"
    return write_replay_files(events(spark, SF001), path, 3, ["ts", "event_id"])


def test_console_with_label(spark, src, capfd):
    st = replay(spark, src, EVENTS_SCHEMA).select("event_id", "event_type")
    q = K.start(st, "console", "console-test", trigger={"availableNow": True}, label="events",
                numRows=3)
    q.awaitTermination(120)
    assert q.lastProgress is not None
    # console output comes from the JVM; the same labelled rows go to memory here
    m = K.start(replay(spark, src, EVENTS_SCHEMA).select("event_id"), "memory", "labelled", trigger={"availableNow": True},
                label="events")
    m.awaitTermination(120)
    got = spark.table("labelled")
    assert got.columns == ["label", "event_id"] and got.filter("label = 'events'").count() == 1000


def test_to_table_stream_and_batch(spark, src):
    st = replay(spark, src, EVENTS_SCHEMA).select("event_id", "user_id")
    q = K.to_table(st, "events_copy", trigger={"availableNow": True})
    q.awaitTermination(120)
    assert spark.table("events_copy").count() == 1000
    # a stream-written table is read through its sink log: batch rows go elsewhere
    K.to_table(events(spark, SF001).select("event_id", "user_id"), "events_batch_copy")
    K.to_table(events(spark, SF001).select("event_id", "user_id"), "events_batch_copy")
    assert spark.table("events_batch_copy").count() == 2000


def test_ttl_value_state_processing_time(spark, src):
    st = with_event_time(replay(spark, src, EVENTS_SCHEMA))
    out = ST.ttl_previous(st, "user_id", "event_id", "et", "1 hour")
    q = K.start(out, "memory", "ttl_prev", trigger={"processingTime": "1 second"})
    # A processing-time TTL query keeps running eviction batches, so
    # processAllAvailable() would not return: poll for the rows instead.
    import time
    try:
        deadline = time.time() + 180
        while time.time() < deadline and spark.table("ttl_prev").count() < 1000:
            time.sleep(2)
    finally:
        q.stop()
    got = {r.id: r.alive_id for r in spark.table("ttl_prev").collect()}
    assert len(got) == 1000
    # within the TTL the value alive for a key is its previous event
    from pyspark.sql import Window
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    want = {r.event_id: r.p for r in events(spark, SF001)
            .select("event_id", F.lag("event_id").over(w).alias("p")).collect()}
    assert got == want


def test_ttl_value_expires(spark):
    """A value older than its time to live is gone: two rows of a key in one go, and a
    third after a pause longer than the time to live."""
    import os
    import time
    base = tempfile.mkdtemp(prefix="ttl-", dir="/tmp") + "/in"

    def add(rows_):
        spark.createDataFrame(rows_, "event_id long, user_id long, ts long").coalesce(1).write.mode("append").parquet(base)
    add([(1, 7, 1), (2, 7, 2)])
    st = with_event_time(spark.readStream.schema("event_id long, user_id long, ts long").parquet(base))
    q = K.start(ST.ttl_previous(st, "user_id", "event_id", "et", "3 seconds"), "memory", "ttl_expiry",
                trigger={"processingTime": "1 second"})

    def wait(n):
        end = time.time() + 120
        while time.time() < end and spark.table("ttl_expiry").count() < n:
            time.sleep(0.5)
    try:
        wait(2)
        time.sleep(8)
        add([(3, 7, 3)])
        wait(3)
    finally:
        q.stop()
    assert {r.id: r.alive_id for r in spark.table("ttl_expiry").collect()} == {1: None, 2: 1, 3: None}
    assert os.path.isdir(base)


def test_batch_state_is_found_after_a_restart_and_pruned(spark, src):
    import os
    out, ck = tempfile.mkdtemp(prefix="rm-", dir="/tmp"), tempfile.mkdtemp(prefix="rmck-", dir="/tmp")
    for _ in range(2):  # the second run is a new process's view: new writer, same checkpoint
        w = K.RunningMaxWriter("event_id", ["ts", "event_id"], K.parquet_writer(out))
        q = K.start_batches(replay(spark, src, EVENTS_SCHEMA).select("event_id", "ts"), w, "rm",
                            trigger={"availableNow": True}, checkpoint=ck)
        q.awaitTermination(120)
    kept = sorted(os.listdir(os.path.join(ck, "batch-state")))
    assert len([k for k in kept if k.endswith(".json") and not k.startswith(".")]) == 2
    from pyspark.sql import Window
    w = Window.orderBy("ts", "event_id").rowsBetween(Window.unboundedPreceding, 0)
    want = {(r.event_id, r.m) for r in events(spark, SF001).select("event_id", F.max("event_id").over(w).alias("m")).collect()}
    assert {(r.event_id, r.running_max) for r in spark.read.parquet(out).collect()} == want


def test_periodic_trigger_checkpoint(spark, src):
    st = replay(spark, src, EVENTS_SCHEMA).groupBy("event_type").count()
    ck = tempfile.mkdtemp(prefix="ckpt-", dir="/tmp")
    q = K.start(st, "memory", "periodic", "complete", trigger={"processingTime": "1 second"},
                checkpoint=ck)
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    assert sum(r["count"] for r in spark.table("periodic").collect()) == 1000
    import os
    assert {"commits", "offsets", "sources", "metadata"} <= set(os.listdir(ck))
