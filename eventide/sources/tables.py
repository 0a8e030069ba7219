"""Stored tables: parquet readers with explicit schemas.

Readers return lazy DataFrames; callers select the columns they need and
Catalyst prunes the scan to them and pushes filters into it.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

EVENTS_SCHEMA = T.StructType([
    T.StructField("event_id", T.LongType()),
    T.StructField("ts", T.TimestampNTZType()),
    T.StructField("user_id", T.LongType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("value", T.DoubleType()),
    T.StructField("props", T.StringType()),
])

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    if name == "events":
        return spark.read.schema(EVENTS_SCHEMA).parquet(table_path(sf_dir, name))
    return spark.read.parquet(table_path(sf_dir, name))


def register_views(spark: SparkSession, sf_dir: str, names=TABLES) -> None:
    """Expose stored tables to ``spark.sql`` under their own names."""
    for n in names:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(table_path(sf_dir, n))
        if path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path):
            read_table(spark, sf_dir, n).createOrReplaceTempView(n)


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "events")


def props_k(col: str = "props"):
    """The integer measure stored in ``events.props`` (JSON ``{"k": n}``)."""
    return F.get_json_object(F.col(col), "$.k").cast("bigint")
