"""User accumulators with a merge tree; sliding windows by panes."""

import pytest
from pyspark.sql import functions as F

from eventide.operators import accumulate as AC
from eventide.operators import aggregates as A
from eventide.sources.tables import events

from .conftest import SF01, rows


def skewed(spark, partitions=40):
    """Value v of 200 with about 6000 / (v + 1) rows, in two groups and a null one."""
    return (spark.range(200).select("id", F.explode(F.sequence(F.lit(1), (F.lit(6_000) / (F.col("id") + 1)).cast("int"))).alias("n"))
            .select(F.col("id").alias("v"), F.when(F.col("n") % 3 > 0, F.col("n") % 3).alias("k")).repartition(partitions))


@pytest.mark.parametrize("size", [5, 40, 500])
def test_heavy_hitters_hold_their_bound(spark, size):
    df = skewed(spark)
    got = {(r.k, r.v): r for r in AC.accumulate(df, AC.HeavyHitters("v", size), ["k"]).collect()}
    exact = {(r.k, r.v): r["count"] for r in df.groupBy("k", "v").count().collect()}
    totals = {r.k: r["count"] for r in df.groupBy("k").count().collect()}
    for (k, v), n in exact.items():
        if (k, v) in got:
            assert got[k, v].at_least <= n <= got[k, v].at_most
            assert got[k, v].at_most - got[k, v].at_least <= totals[k] / (size + 1)
            assert got[k, v].rows == totals[k]
        else:
            assert n <= totals[k] / (size + 1)
    assert max(sum(1 for g, _ in got if g == k) for k in totals) <= size


def test_merge_tree_keeps_fan_in(spark, monkeypatch):
    """More partial accumulators than one task may merge: the levels add up."""
    monkeypatch.setattr(AC, "FAN_IN", 3)
    df = skewed(spark, 20)
    one = AC.accumulate(df, AC.HeavyHitters("v", 1_000)).collect()
    assert {(r.v, r.at_least) for r in one} == {(r.v, r["count"]) for r in df.groupBy("v").count().collect()}
    assert {r.rows for r in one} == {df.count()}


def test_many_groups_leave_in_time(spark, monkeypatch):
    monkeypatch.setattr(AC, "OPEN_GROUPS", 7)
    df = spark.range(3_000).select((F.col("id") % 100).alias("k"), (F.col("id") % 2).alias("v"))
    got = AC.accumulate(df, AC.HeavyHitters("v", 10), ["k"]).groupBy("k").agg(F.sum("at_least").alias("n"))
    assert {(r.k, r.n) for r in got.collect()} == {(k, 30) for k in range(100)}


def test_frequent_values_are_exact_and_empty_is_empty(spark):
    df = skewed(spark)
    want = (df.groupBy("k", "v").count().join(df.groupBy("k").agg(F.count("*").alias("n_rows")).withColumnRenamed("k", "k2"),
                                              F.col("k").eqNullSafe(F.col("k2")))
            .where("count > 0.02 * n_rows").select("k", "v", F.col("count").alias("cnt"), "n_rows"))
    assert rows(AC.frequent_values(df, "v", 0.02, ["k"])) == rows(want)
    assert AC.frequent_values(df.limit(0), "v", 0.02, ["k"]).count() == 0


@pytest.mark.parametrize("size,slide,keys", [("3 days", "1 day", []), ("7 hours", "3 hours", ["event_type"]),
                                             ("1 hour", "1 hour", []), ("1 hour", "90 minutes", ["event_type"])])
def test_panes_equal_expanded_windows(spark, size, slide, keys):
    """Also where the slide does not divide the size, or leaves gaps between windows."""
    e = events(spark, SF01).withColumn("user_id", F.when(F.col("user_id") % 4 != 0, F.col("user_id")))
    got = A.pv_uv_panes(e, "ts", "user_id", size, slide, keys=keys)
    if slide == "90 minutes":
        w = F.col("ts").cast("timestamp").cast("double")
        start = F.floor(w / 5_400) * 5_400
        want = (e.where(w < start + 3_600).groupBy(*keys, start.alias("s"))
                .agg(F.count("*").alias("pv"), F.countDistinct("user_id").alias("uv")))
        assert rows(got.select("pv", "uv", *keys, F.unix_timestamp(F.col("window_start").cast("timestamp")).alias("s"))) == rows(want)
    else:
        assert rows(got) == rows(A.pv_uv(e, "ts", "user_id", size, slide, keys=keys).na.fill(0.0, ["ratio"])
                                 if keys else A.pv_uv(e, "ts", "user_id", size, slide))


def test_panes_shuffle_does_not_depend_on_the_ratio(spark):
    """The plan gives a row to no window: the changes are exploded after counting."""
    e = events(spark, SF01)
    text = A.pv_uv_panes(e, "ts", "user_id", "3 days", "1 hour")._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in text
    lines = [x for x in text.split("\n") if "Generate" in x or "partial_count" in x]
    assert "partial_count" in lines[-1] and sum("Generate" in x for x in lines) == 2
