"""Every runnable streaming job starts and completes on a replayed folder."""

import os
import tempfile

import pytest

from eventide.sources.tables import events
from eventide.streaming.jobs import JOBS, run
from eventide.streaming.replay import write_replay_files

from .conftest import SF001


@pytest.fixture(scope="module")
def source(spark):
    path = tempfile.mkdtemp(prefix="jobs-", dir="/tmp") + "/events"
    return write_replay_files(events(spark, SF001), path, 2, ["ts", "event_id"])


@pytest.mark.parametrize("name", [j for j in JOBS if j != "jdbc_counts"])
def test_job_runs(spark, source, name):
    out = tempfile.mkdtemp(prefix=f"job-{name}-", dir="/tmp")
    q = run(spark, name, source, sink="parquet", out=os.path.join(out, "o"), available_now=True)
    q.awaitTermination(300)
    assert q.exception() is None
    # Every job reports something; jobs that wait for the watermark hold back the
    # rows at the last time only.
    per_event = {"running_count", "running_max", "previous_rule", "state_machine", "late_split", "route_split"}
    if name in per_event:
        assert 990 <= spark.read.parquet(os.path.join(out, "o")).count() <= 1000
    elif name in ("key_counts", "pv_uv", "window_uv", "sessions", "buffer_flush", "reconcile", "sql_tumble",
                  "window_cogroup", "measure_sum"):
        assert spark.read.parquet(os.path.join(out, "o")).count() > 0


def test_jdbc_job(spark, source):
    url = "jdbc:derby:memory:jobs_test;create=true"
    params = {"url": url, "table": "user_counts",
              "prop.driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}
    q = run(spark, "jdbc_counts", source, sink="noop", available_now=True, params=params)
    q.awaitTermination(300)
    from eventide.sources.jdbc import read_jdbc
    got = read_jdbc(spark, url, "user_counts", properties={"driver": params["prop.driver"]})
    assert got.count() > 0


def test_route_split_job_keeps_every_route(spark, source):
    out = tempfile.mkdtemp(prefix="job-routes-", dir="/tmp") + "/o"
    q = run(spark, "route_split", source, sink="parquet", out=out, available_now=True,
            params={"low": "20", "mid": "50"})
    q.awaitTermination(300)
    got = spark.read.parquet(out)
    assert got.count() == 1000
    assert {r.route for r in got.select("route").distinct().collect()} == {"low", "mid", "high"}
