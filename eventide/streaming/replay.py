"""Replay a stored table as a stream (the reference's random generators
are replaced by reading real rows in time order).

``write_replay_files`` cuts a table into ``n_files`` time-ordered parquet
files (range partitioning, so each file holds a contiguous time slice);
``replay`` reads them back with ``maxFilesPerTrigger`` so every trigger sees
the next slice.  Streaming file sources need an explicit schema.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def write_replay_files(df: DataFrame, path: str, n_files: int, order: list[str]) -> str:
    """Write ``df`` as ``n_files`` time-ordered parquet files under ``path``.

    File names sort in time order (range partition ids), which is the order
    the file source picks them up in."""
    (df.repartitionByRange(n_files, *order).sortWithinPartitions(*order)
     .write.mode("overwrite").parquet(path))
    _stamp_in_name_order(df.sparkSession, path)
    return path


def _stamp_in_name_order(spark: SparkSession, path: str) -> None:
    """The file source takes files oldest first; parallel writers finish in
    any order, so set modification times to follow the part numbers.  A store
    that cannot set times raises: the order of the stream would be arbitrary."""
    jvm = spark.sparkContext._jvm
    base = jvm.org.apache.hadoop.fs.Path(path)
    fs = base.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    parts = sorted((st.getPath() for st in fs.listStatus(base)
                    if st.getPath().getName().startswith("part-")), key=lambda p: p.getName())
    t0 = int(jvm.java.lang.System.currentTimeMillis()) - 1000 * (len(parts) + 1)
    for i, p in enumerate(parts):
        fs.setTimes(p, t0 + 1000 * i, -1)


def replay(spark: SparkSession, path: str, schema: T.StructType,
           max_files_per_trigger: int = 1) -> DataFrame:
    return (spark.readStream.schema(schema)
            .option("maxFilesPerTrigger", max_files_per_trigger)
            .parquet(path))


def with_event_time(df: DataFrame, ts: str = "ts", name: str = "et") -> DataFrame:
    """The event-time column.  Stored ``TIMESTAMP_NTZ`` values are cast to
    ``TIMESTAMP`` (the session zone is UTC), which ``withWatermark`` needs."""
    dt = df.schema[ts].dataType
    if isinstance(dt, (T.LongType, T.IntegerType)):
        return df.withColumn(name, F.timestamp_millis(F.col(ts)))
    return df.withColumn(name, F.col(ts).cast("timestamp"))


def with_ingest_time(df: DataFrame, name: str = "ingest_ts") -> DataFrame:
    """Processing time, stamped when a row is read."""
    return df.withColumn(name, F.current_timestamp())
