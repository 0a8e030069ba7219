"""Chunked scans equal plain windows, whatever the keys, ties and nulls."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from eventide.operators import aggregates as A
from eventide.operators import windows as W
from eventide.operators.sequence import KeyedSequence
from eventide.sources.tables import events

from .conftest import SF01, rows

ORDER = ["ts", "event_id"]
FORCE = dict(chunks=34)


def ev(spark):
    return events(spark, SF01).select("event_id", "user_id", "ts", "event_type", "value")


def test_running_count_chunked_equals_plain(spark):
    e = ev(spark).select("event_id", "user_id", "ts")
    plain = A.running_count(e, ["user_id"], ORDER)
    chunked = A.running_count(e, ["user_id"], ORDER, **FORCE)
    assert rows(plain) == rows(chunked)


def test_global_running_max_is_chunked(spark):
    e = ev(spark)
    w = Window.orderBy(*ORDER).rowsBetween(Window.unboundedPreceding, 0)
    want = e.select("event_id", F.max("value").over(w).alias("m"))
    got = A.running_max(e, "value", ORDER, name="m", chunks=15).select("event_id", "m")
    assert rows(want) == rows(got)


def test_reverse_exclusive_min_and_last(spark):
    e = ev(spark)
    seq = KeyedSequence(["user_id"], ORDER, **FORCE)
    d = seq.prepare(e)
    pay = F.when(F.col("event_type") == "purchase", F.struct("ts", "event_id"))
    d = seq.running(d, {"next_pay": ("min", pay),
                        "next_val": ("last", F.when(F.col("value") > 100, F.col("value")))},
                    reverse=True, inclusive=False)
    got = seq.finish(d).select("event_id", "next_pay", "next_val")
    w = Window.partitionBy("user_id").orderBy(*ORDER).rowsBetween(1, Window.unboundedFollowing)
    want = e.select("event_id", F.min(pay).over(w).alias("next_pay"),
                    F.first(F.when(F.col("value") > 100, F.col("value")), ignorenulls=True)
                    .over(w).alias("next_val"))
    assert rows(want.select("event_id", F.col("next_pay.event_id").alias("p"), "next_val")) == \
        rows(got.select("event_id", F.col("next_pay.event_id").alias("p"), "next_val"))


def test_lag_across_chunks(spark):
    e = ev(spark)
    seq = KeyedSequence(["user_id"], ORDER, **FORCE)
    d = seq.lag(seq.prepare(e), ["event_id", "event_type"], 3)
    got = seq.finish(d).select("event_id", *[F.col(f"prev{j}.event_id").alias(f"p{j}") for j in (1, 2, 3)])
    w = Window.partitionBy("user_id").orderBy(*ORDER)
    want = e.select("event_id", *[F.lag("event_id", j).over(w).alias(f"p{j}") for j in (1, 2, 3)])
    assert rows(want) == rows(got)


def test_sessions_chunked(spark):
    e = ev(spark)
    assert rows(W.sessions(e, ["user_id"], "ts", "5 hours", ORDER)) == \
        rows(W.sessions(e, ["user_id"], "ts", "5 hours", ORDER, **FORCE))


def test_session_edge_one_gap_apart(spark):
    # 0 s, 5 s, 9.999 s with gap 5 s -> one session [0 s, 14.999 s)
    df = spark.createDataFrame(
        [(1, "a", "2024-01-01 00:00:00"), (2, "a", "2024-01-01 00:00:05"),
         (3, "a", "2024-01-01 00:00:09.999")], "id long, k string, t string"
    ).withColumn("ts", F.to_timestamp_ntz("t"))
    out = W.sessions(df, ["k"], "ts", "5 seconds", ["ts", "id"]).collect()
    assert len(out) == 1 and out[0]["n_events"] == 3
    assert str(out[0]["session_end"]) == "2024-01-01 00:00:14.999000"


def test_hot_key_third_of_rows_is_split(spark):
    """A user, then the null key, holding a third of all rows: the rows are spread
    evenly over the chunks and the counts equal those of a plain window."""
    e = events(spark, "/root/testdata/sf0.1")
    for hot in (F.lit(-1), F.lit(None).cast("long")):
        d0 = e.select("event_id", "ts", F.when(F.col("event_id") % 3 == 0, hot).otherwise(F.col("user_id")).alias("user_id"))
        seq = KeyedSequence(["user_id"], ORDER, chunks=24)
        d = seq.prepare(d0)
        sizes = d.groupBy("_chunk").count().toPandas()["count"]
        assert len(sizes) == 24 and sizes.max() <= 2 * sizes.mean()
        got = seq.finish(seq.running(d, {"rc": ("count", F.lit(1))})).select("event_id", "rc")
        w = Window.partitionBy("user_id").orderBy(*ORDER)
        want = d0.select("event_id", F.row_number().over(w).cast("long").alias("rc"))
        assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_one_tied_time_is_split(spark):
    d0 = spark.range(5_000).select(F.col("id"), (F.col("id") % 2).alias("k"), F.lit(7).alias("t"))
    seq = KeyedSequence(["k"], ["t"], chunks=10)
    d = seq.prepare(d0)
    assert d.groupBy("_chunk").count().agg(F.max("count")).first()[0] < 1_500
    got = seq.finish(seq.running(d, {"n": ("count", F.lit(1))})).groupBy("k").agg(
        F.countDistinct("n").alias("d"), F.max("n").alias("m")).collect()
    assert {(r.k, r.d, r.m) for r in got} == {(0, 2500, 2500), (1, 2500, 2500)}


def test_multi_column_keys_with_nulls(spark):
    e = ev(spark).select("event_id", F.when(F.col("user_id") % 5 != 0, F.col("user_id")).alias("user_id"),
                         F.when(F.col("event_id") % 7 != 0, F.col("event_type")).alias("event_type"), "ts")
    w = Window.partitionBy("user_id", "event_type").orderBy(*ORDER)
    want = e.withColumn("running_count", F.row_number().over(w).cast("long"))
    assert rows(want) == rows(A.running_count(e, ["user_id", "event_type"], ORDER, chunks=29))


def test_more_chunks_than_rows_and_no_rows(spark):
    e = ev(spark).limit(3)
    assert A.running_count(e, ["user_id"], ORDER, chunks=50).count() == 3
    assert A.running_count(e.limit(0), ["user_id"], ORDER, chunks=5).count() == 0


def test_rule_with_equal_starts_and_many_rules(spark):
    from eventide.operators import joins as J
    e = ev(spark).select("event_id", "user_id", "ts", "event_type")
    r = (spark.range(2_000).select((F.lit("2024-01-01").cast("timestamp_ntz") + F.make_dt_interval(mins=F.col("id") * 20))
                                   .alias("rule_ts"), F.col("id").cast("string").alias("name")))
    got = J.with_rule(e, r.unionByName(r.withColumn("name", F.lit(""))), "ts", order=["event_id"], chunks=11)
    want = e.withColumn("n", F.floor((F.unix_micros(F.col("ts").cast("timestamp"))
                                      - F.unix_micros(F.lit("2024-01-01").cast("timestamp"))) / 1_200_000_000))
    assert rows(got.select("event_id", F.col("rule.name").alias("n"))) == rows(
        want.select("event_id", F.least("n", F.lit(1999)).cast("string").alias("n")))


def test_scale_settings(spark):
    from eventide.session import input_bytes, scale_settings
    n = input_bytes(spark, "/root/testdata/sf0.1/events.parquet")
    assert n > 0
    small = scale_settings(n, 8)
    assert small["spark.sql.shuffle.partitions"] == "16"
    big = scale_settings(100 << 40, 8000)     # 100 TB, 1000 executors x 8 cores
    assert int(big["spark.sql.shuffle.partitions"]) == 819200


def plan_text(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_scans_share_one_shuffle_and_write_nothing(spark, tmp_path):
    """Per plan: one exchange that moves rows by (keys, chunk); the others carry summaries.
    No checkpoint is written, neither on preparing nor on running."""
    import os
    import re
    from eventide.operators import patterns as P
    e = ev(spark).select("event_id", "user_id", "ts", "event_type", "value")
    shared = spark.conf.get("spark.checkpoint.dir").removeprefix("file://")

    def written():
        return sum(len(f) for d, _, f in os.walk(shared) if "/rdd-" in d)
    before = written()
    seq = KeyedSequence(["user_id"], ORDER)
    d = seq.prepare(e)
    d = seq.running(d, {"n": ("count", F.lit(1))})
    d = seq.finish(seq.running(d, {"top": ("max", F.col("value"))}))
    views = P.followed_by(e, ["user_id"], ORDER, "ts", F.col("event_type") == "view",
                          F.col("event_type") == "purchase", "1 hour", ["event_id", "ts"])[0]
    for df in (d, views, A.running_count(e, ["user_id"], ORDER)):
        lines = plan_text(df).split("\n")
        full = [b for a, b in zip(lines, lines[1:])
                if re.search(r"Exchange hashpartitioning\(user_id#\d+L, _chunk#\d+", a) and "Aggregate" not in b]
        assert len(full) == 1 and not any("rangepartitioning" in x for x in lines)
        df.write.format("noop").mode("overwrite").save()
    assert written() == before


def test_chunk_is_a_function_of_the_row(spark):
    seq = KeyedSequence(["user_id"], ORDER, chunks=13)
    d = seq.prepare(ev(spark)).select("event_id", "_chunk")
    assert rows(d) == rows(d.repartition(5))
    # in order of (key, time, id) chunk numbers never fall, and neighbours of one key meet only if marked
    w = Window.orderBy("user_id", *ORDER)
    full = seq.prepare(ev(spark)).withColumns({"c0": F.lag("_chunk").over(w), "k0": F.lag("user_id").over(w)})
    assert full.filter("c0 > _chunk").count() == 0
    assert full.filter("c0 < _chunk AND k0 = user_id AND NOT _crosses").count() == 0


def test_bounds_keep_every_kind_of_key(spark):
    """Keys as text, dates, decimals, NaN and null; times with microseconds."""
    from decimal import Decimal
    d0 = spark.range(3_000).select(
        "id", F.when(F.col("id") % 11 != 0, F.concat(F.lit('é"'), (F.col("id") % 4).cast("string"))).alias("k"),
        F.date_add(F.lit("2024-01-01"), (F.col("id") % 3).cast("int")).alias("day"),
        F.when(F.col("id") % 5 == 0, F.lit(float("nan"))).otherwise(F.col("id") % 2 / 3).alias("x"),
        F.lit(Decimal("1.10")).alias("m"), F.timestamp_micros(F.col("id") * 37 % 501).alias("t"))
    keys = ["k", "day", "x", "m"]
    got = A.running_count(d0, keys, ["t", "id"], chunks=40).select("id", "running_count")
    w = Window.partitionBy(*keys).orderBy("t", "id")
    assert rows(got) == rows(d0.select("id", F.row_number().over(w).cast("long").alias("running_count")))


def test_rules_by_search_and_by_scan(spark):
    from eventide.operators import joins as J
    e = ev(spark).select("event_id", "user_id", "ts", "event_type")
    r = (spark.range(300).select((F.lit("2024-01-02").cast("timestamp_ntz") + F.make_dt_interval(hours=F.col("id") * 2, secs=F.lit(0.000007).cast("decimal(8,6)")))
                                 .alias("rule_ts"), F.col("id").cast("string").alias("name")))
    by_search = J.with_rule(e, r, "ts", order=["event_id"])
    assert "Exchange" not in plan_text(by_search)
    by_scan = J.with_rule(e, r, "ts", order=["event_id"], max_in_plan=10, chunks=9)
    assert rows(by_search.select("event_id", "rule.name")) == rows(by_scan.select("event_id", "rule.name"))
    assert J.with_rule(e, r.limit(0), "ts").filter("rule IS NOT NULL").count() == 0
