"""Stream sinks (K1, K3, K5, K6), routed outputs (O1/O2) and the exact
late-data router (T6) as ``foreachBatch`` functions."""

from __future__ import annotations

import json
import os
from contextlib import contextmanager

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import late as L
from ..operators.sequence import order_micros
from ..session import state_location


ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
PROVIDER_CONF = "spark.sql.streaming.stateStore.providerClass"


def use_rocksdb_state(spark) -> None:
    """Keyed state processors (transformWithState) need the RocksDB state
    store; switch to it unless the session chose another non-default one."""
    current = spark.conf.get(PROVIDER_CONF, None)
    if not current or current.endswith("HDFSBackedStateStoreProvider"):
        spark.conf.set(PROVIDER_CONF, ROCKSDB)


@contextmanager
def state_partitions(spark, n: int):
    """Streams started within have ``n`` state partitions; they keep them for the life of
    their checkpoint.  A partition costs each micro-batch a task and a commit of its state."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", n)
    try:
        yield
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def start(df: DataFrame, fmt: str, name: str, output_mode: str = "append", trigger: dict | None = None,
          checkpoint: str | None = None, label: str | None = None, **options):
    """K1/K3/K5/K6: start a streaming query on a built-in sink.

    ``fmt`` is ``console`` (with an optional ``label`` column, like a labelled
    print), ``memory`` (tests; queryable as table ``name``), ``noop`` (runs
    the query, writes nothing), or a file format (``parquet``, ``text``,
    ``json``; give ``path`` and optionally ``maxRecordsPerFile``).  The
    checkpoint defaults to a fresh folder under ``spark.checkpoint.dir``."""
    spark = df.sparkSession
    use_rocksdb_state(spark)
    if label is not None:
        df = df.select(F.lit(label).alias("label"), "*")
    w = (df.writeStream.format(fmt).outputMode(output_mode)
         .option("checkpointLocation", checkpoint or state_location(spark, name)))
    if fmt == "memory":
        w = w.queryName(name)
    for k, v in options.items():
        w = w.option(k, v)
    if trigger:
        w = w.trigger(**trigger)
    return w.start()


def start_batches(df: DataFrame, fn, name: str, output_mode: str = "append",
                  trigger: dict | None = None, checkpoint: str | None = None):
    """K5: a custom sink — ``fn(batch_df, batch_id)`` per micro-batch."""
    spark = df.sparkSession
    use_rocksdb_state(spark)
    checkpoint = checkpoint or state_location(spark, name)
    own = getattr(fn, "state", None)
    if isinstance(own, BatchScalarState) and own.state_dir is None:
        own.state_dir = os.path.join(checkpoint, "batch-state")  # found again after a restart
    w = df.writeStream.foreachBatch(fn).outputMode(output_mode).option("checkpointLocation", checkpoint)
    if trigger:
        w = w.trigger(**trigger)
    return w.start()


def routed_writer(column: str, writers: dict):
    """O1/O2 stream: write every route of a micro-batch to its own sink.  The
    batch is persisted once so the source is not re-read per route."""
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            for route, fn in writers.items():
                fn(batch.filter(F.col(column) == route), batch_id)
        finally:
            batch.unpersist()
    return write


def parquet_writer(path: str):
    """Append a micro-batch to a parquet folder, one sub-folder per batch id
    (a replayed batch overwrites its own folder: idempotent)."""
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(os.path.join(path, f"batch={batch_id}"))
    return write


class BatchScalarState:
    """One number per micro-batch in a shared folder: the value after batch
    ``n`` is written once the batch's output is written, and batch ``n``
    reads the value of the latest earlier batch, so a replayed batch sees
    exactly what it saw the first time."""

    def __init__(self, name: str, state_dir: str | None = None):
        self.name, self.state_dir = name, state_dir

    def _fs(self, spark, path: str):
        jvm = spark.sparkContext._jvm
        hp = jvm.org.apache.hadoop.fs.Path(path)
        return hp, hp.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _dir(self, spark) -> str:
        if self.state_dir is None:
            self.state_dir = state_location(spark, self.name)
        return self.state_dir

    def _numbers(self, spark) -> list[int]:
        base, fs = self._fs(spark, self._dir(spark))
        names = [st.getPath().getName() for st in fs.listStatus(base)] if fs.exists(base) else []
        return sorted(int(n[2:-5]) for n in names if n.startswith("v-") and n.endswith(".json"))

    def read_before(self, spark, batch_id: int):
        ids = [n for n in self._numbers(spark) if n < batch_id]
        if not ids:
            return None
        hp, fs = self._fs(spark, os.path.join(self._dir(spark), f"v-{max(ids)}.json"))
        stream = fs.open(hp)
        try:
            raw = spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        return json.loads(raw)["value"]

    def write(self, spark, batch_id: int, value) -> None:
        """Keep the value after ``batch_id``, and drop those that no replay can need:
        only the last batch is ever run again, and it reads the one before."""
        hp, fs = self._fs(spark, os.path.join(self._dir(spark), f"v-{batch_id}.json"))
        stream = fs.create(hp, True)
        try:
            stream.write(bytearray(json.dumps({"value": value}).encode()))
        finally:
            stream.close()
        earlier = [n for n in self._numbers(spark) if n < batch_id]
        for n in earlier[:-1]:
            fs.delete(self._fs(spark, os.path.join(self._dir(spark), f"v-{n}.json"))[0], False)


class LateRouter:
    """T6 exact on a stream: route each row by the highest event time that
    arrived *before it* — across micro-batches through :class:`BatchScalarState`,
    inside a batch through the chunked prefix max of the batch operator.
    Gives the same routes as :func:`eventide.operators.late.late_split` over
    the arrival order.  ``state_dir`` must be on shared storage (default:
    under ``spark.checkpoint.dir``)."""

    def __init__(self, ts: str, arrival: list[str], size, out, slide=None, offset=None, delay=0,
                 lateness=0, state_dir: str | None = None):
        self.ts, self.arrival, self.size, self.slide, self.offset = ts, arrival, size, slide, offset
        self.delay, self.lateness, self.out = delay, lateness, out
        self.state = BatchScalarState("late-router", state_dir)

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        batch.persist()  # the source and its stateful stage run once
        prev = self.state.read_before(spark, batch_id)
        init = None
        if prev is not None:
            init = F.timestamp_micros(F.lit(prev)).cast(batch.schema[self.ts].dataType)
        routed = L.late_split(batch, self.ts, self.arrival, self.size, self.slide, self.offset,
                              self.delay, self.lateness, initial_max=init)
        routed.persist()
        try:
            m = batch.agg(F.max(order_micros(batch, self.ts))).first()[0]
            if prev is not None and (m is None or prev > m):
                m = prev
            self.emit(routed, batch_id, m)
            self.state.write(spark, batch_id, m)
        finally:
            routed.unpersist()
            batch.unpersist()


    def emit(self, routed: DataFrame, batch_id: int, highest: int | None) -> None:
        """``highest``: the highest event time up to the end of this batch (micros)."""
        self.out(routed, batch_id)


class LateFirings(LateRouter):
    """T5 exact on a stream: the firings of each window, by the per-row rule of
    :mod:`eventide.operators.late`.

    Firing 0 has the on-time count and comes when the watermark reaches the window's
    end.  Every late row, until ``lateness`` after that, fires the window again with the
    corrected count, numbered from 1 in order of arrival and carrying the row's
    ``id_col``.  A window without on-time rows has late firings only.

    One record per open window (rows counted on time and late, whether it has fired) is
    kept per micro-batch as a table beside the router's state, and is left out once the
    watermark is past ``lateness`` after the window's end.  A batch that is run again
    reads what it read the first time.  Late rows of one window are numbered by an
    ordered scan, so a hot window is spread over tasks."""

    def __init__(self, ts: str, arrival: list[str], size, out, id_col: str, **options):
        super().__init__(ts, arrival, size, out, **options)
        self.id_col = id_col

    def _records(self, spark, batch_id: int):
        """Folder of the records after the latest batch before ``batch_id``, and all."""
        base, fs = self.state._fs(spark, self.state._dir(spark) + "/windows")
        names = [st.getPath().getName() for st in fs.listStatus(base)] if fs.exists(base) else []
        known = sorted(int(n[2:]) for n in names if n.startswith("w-")
                       and fs.exists(self.state._fs(spark, f"{base}/{n}/_SUCCESS")[0]))
        return [n for n in known if n < batch_id], fs

    def emit(self, routed: DataFrame, batch_id: int, highest: int | None) -> None:
        from ..operators import aggregates as A
        from ..operators import windows as W
        spark = routed.sparkSession
        window = W.assign(self.ts, self.size, self.slide, self.offset)
        rows = (routed.select(F.col(self.id_col).alias("id"), *[F.col(a).alias(f"_a{i}") for i, a in enumerate(self.arrival)],
                              "watermark", window.alias("w"))
                .select("*", F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end")).drop("w"))
        wm, end, wait = F.col("watermark"), F.col("window_end"), W.interval(self.lateness)
        on_time = F.coalesce(wm < end, F.lit(True))
        counted = rows.withColumn("late", ~on_time).where(on_time | (wm < end + wait))
        own = ["window_start", "window_end"]
        added = counted.groupBy(*own).agg(F.count(F.when(~F.col("late"), 1)).alias("on_time"),
                                          F.count(F.when(F.col("late"), 1)).alias("late"))
        earlier, fs = self._records(spark, batch_id)
        folder = self.state._dir(spark) + "/windows"
        none = F.lit(0).cast("bigint")
        if earlier:
            kept = spark.read.parquet(f"{folder}/w-{earlier[-1]}")
        else:
            kept = added.limit(0).withColumn("fired", F.lit(False))
        total = (kept.withColumns({"on_time_before": F.col("on_time"), "late_before": F.col("late")})
                 .unionByName(added.withColumns({"fired": F.lit(False), "on_time_before": none, "late_before": none}))
                 .groupBy(*own).agg(F.sum("on_time").alias("on_time"), F.sum("late").alias("late"),
                                    F.sum("late_before").alias("late_before"), F.max("fired").alias("fired")))
        total.persist()
        mark = None if highest is None else (F.timestamp_micros(F.lit(highest)).cast(routed.schema[self.ts].dataType)
                                             - W.interval(self.delay))
        reached = F.lit(False) if mark is None else end <= mark
        first = (total.where(reached & ~F.col("fired") & (F.col("on_time") > 0))
                 .select(*own, F.lit(0).cast("bigint").alias("firing"), F.col("on_time").alias("cnt"),
                         F.lit(None).cast(routed.schema[self.id_col].dataType).alias(self.id_col)))
        numbered = A.running_count(counted.where("late").drop("watermark", "late"), own,
                                   [f"_a{i}" for i in range(len(self.arrival))], name="n")
        again = (numbered.join(total, own).select(
            *own, (F.col("late_before") + F.col("n")).alias("firing"),
            (F.col("on_time") + F.col("late_before") + F.col("n")).alias("cnt"), F.col("id").alias(self.id_col)))
        try:
            self.out(first.unionByName(again), batch_id)
            still = F.lit(True) if mark is None else mark < end + wait
            (total.where(still).select(*own, "on_time", "late", (F.col("fired") | reached).alias("fired"))
             .coalesce(1).write.mode("overwrite").parquet(f"{folder}/w-{batch_id}"))
        finally:
            total.unpersist()
        for n in earlier[:-1]:
            fs.delete(self.state._fs(spark, f"{folder}/w-{n}")[0], True)


class RunningMaxWriter:
    """A2 on a stream: the running max of ``col`` over all rows so far, one
    output per row.  Spark refuses a second aggregation over an update
    stream, so each micro-batch takes its chunked prefix max (in ``order``)
    and adds the max of the earlier batches (:class:`BatchScalarState`)."""

    def __init__(self, col: str, order: list[str], out, name: str = "running_max",
                 state_dir: str | None = None):
        self.col, self.order, self.out, self.name = col, order, out, name
        self.state = BatchScalarState("running-max", state_dir)

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        from ..operators import aggregates as A
        spark = batch.sparkSession
        batch.persist()  # the source and its stateful stage run once
        prev = self.state.read_before(spark, batch_id)
        d = A.running_max(batch, self.col, self.order, name=self.name)
        if prev is not None:
            d = d.withColumn(self.name, F.greatest(F.col(self.name), F.lit(prev)))
        d.persist()
        try:
            self.out(d, batch_id)
            m = batch.agg(F.max(self.col)).first()[0]
            if prev is not None and (m is None or prev > m):
                m = prev
            self.state.write(spark, batch_id, m)
        finally:
            d.unpersist()
            batch.unpersist()


def to_table(df: DataFrame, table: str, name: str | None = None, output_mode: str = "append",
             trigger: dict | None = None, checkpoint: str | None = None):
    """K2: insert a stream into a catalog table (``toTable``); for a batch
    frame this is ``saveAsTable`` in append mode."""
    if not df.isStreaming:
        df.write.mode("append").saveAsTable(table)
        return None
    spark = df.sparkSession
    use_rocksdb_state(spark)
    w = (df.writeStream.outputMode(output_mode)
         .option("checkpointLocation", checkpoint or state_location(spark, name or table)))
    if trigger:
        w = w.trigger(**trigger)
    return w.toTable(table)
