"""K5 / K6: a sink of its own with commit hooks, and files rolled by size and age.

A Python data source, ``rolling_files``.  Each task writes parquet files under
unique names and starts the next one when the open one reaches
``rollBytes`` or has been open for ``rollSeconds``.  Nothing a task writes counts until
the epoch is committed: the commit writes one manifest per epoch, as a whole, that
lists the epoch's files.  A failed task's files are in no manifest; an aborted epoch's
files are removed; an epoch that is run again replaces its manifest and removes the
files that the former one listed.  Readers take the files of the manifests.
"""

from __future__ import annotations

import json
import sys
import time
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceStreamArrowWriter, WriterCommitMessage

from ..session import state_location
from ..sources.stored_stream import open_store, qualified, write_whole

# Writers run in Python workers; ship them by value.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: The limits of the example job's file sink.
ROLL_BYTES, ROLL_SECONDS = 1 << 30, 15 * 60
#: Rows written between two looks at size and age.
STEP_ROWS = 1_000


@dataclass
class Files(WriterCommitMessage):
    """What one task wrote: name, rows and bytes of each file."""

    files: list[tuple[str, int, int]]


class RollingWriter(DataSourceStreamArrowWriter):
    def __init__(self, options: dict):
        options = {k.lower(): v for k, v in options.items()}
        self.uri = options["path"]
        self.roll_bytes = int(options.get("rollbytes", ROLL_BYTES))
        self.roll_seconds = float(options.get("rollseconds", ROLL_SECONDS))

    def write(self, iterator: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        fs, root = open_store(self.uri)
        fs.create_dir(f"{root}/data", recursive=True)
        done: list[tuple[str, int, int]] = []
        out = writer = name = None
        rows = opened = 0

        def close():
            writer.close()
            done.append((name, rows, out.tell()))
            out.close()
        for batch in iterator:
            for at in range(0, batch.num_rows, STEP_ROWS):
                part = batch.slice(at, STEP_ROWS)
                if writer is None:
                    name, rows, opened = f"{uuid.uuid4().hex}.parquet", 0, time.monotonic()
                    out = fs.open_output_stream(f"{root}/data/{name}")
                    writer = pq.ParquetWriter(out, part.schema)
                # a row group each, so that the size is known
                writer.write_batch(part)
                rows += part.num_rows
                if out.tell() >= self.roll_bytes or time.monotonic() - opened >= self.roll_seconds:
                    close()
                    writer = None
        if writer is not None:
            close()
        return Files(done)

    def _manifest(self, epoch: int) -> tuple[pafs.FileSystem, str, str]:
        fs, root = open_store(self.uri)
        return fs, root, f"{root}/manifests/{epoch:012d}.json"

    def commit(self, messages, batchId: int) -> None:
        fs, root, manifest = self._manifest(batchId)
        files = [f for m in messages if m is not None for f in m.files]
        before = _listed(fs, manifest)
        fs.create_dir(f"{root}/manifests", recursive=True)
        write_whole(fs, manifest, json.dumps([{"file": n, "rows": r, "bytes": b} for n, r, b in files]))
        _remove(fs, root, [f["file"] for f in before])

    def abort(self, messages, batchId: int) -> None:
        fs, root, _ = self._manifest(batchId)
        _remove(fs, root, [n for m in messages if m is not None for n, _, _ in m.files])


def _listed(fs: pafs.FileSystem, manifest: str) -> list[dict]:
    if fs.get_file_info(manifest).type != pafs.FileType.File:
        return []
    with fs.open_input_stream(manifest) as f:
        return json.loads(f.read().decode())


def _remove(fs: pafs.FileSystem, root: str, names: list[str]) -> None:
    for name in names:
        if fs.get_file_info(f"{root}/data/{name}").type == pafs.FileType.File:
            fs.delete_file(f"{root}/data/{name}")


class RollingFiles(DataSource):
    @classmethod
    def name(cls) -> str:
        return "rolling_files"

    def streamWriter(self, schema: T.StructType, overwrite: bool) -> DataSourceStreamArrowWriter:
        return RollingWriter(dict(self.options))


def start_rolling(df: DataFrame, path: str, name: str, roll_bytes: int = ROLL_BYTES, roll_seconds: float = ROLL_SECONDS,
                  trigger: dict | None = None, checkpoint: str | None = None):
    """Write a stream to rolled files under ``path``."""
    from .sinks import use_rocksdb_state
    spark = df.sparkSession
    use_rocksdb_state(spark)
    spark.dataSource.register(RollingFiles)
    w = (df.writeStream.format("rolling_files").outputMode("append").option("rollBytes", roll_bytes)
         .option("rollSeconds", roll_seconds).option("path", qualified(spark, path))
         .option("checkpointLocation", checkpoint or state_location(spark, name)))
    return (w.trigger(**trigger) if trigger else w).start()


def manifests(spark: SparkSession, path: str) -> dict[int, list[dict]]:
    """The committed files of each epoch."""
    fs, root = open_store(qualified(spark, path))
    if fs.get_file_info(f"{root}/manifests").type != pafs.FileType.Directory:
        return {}
    found = fs.get_file_info(pafs.FileSelector(f"{root}/manifests"))
    return {int(f.base_name[:-5]): _listed(fs, f.path) for f in sorted(found, key=lambda f: f.path)
            if f.base_name.endswith(".json")}


def read_rolled(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The rows of all committed epochs."""
    files = [f"{path}/data/{f['file']}" for listed in manifests(spark, path).values() for f in listed]
    return spark.read.schema(schema).parquet(*files) if files else spark.createDataFrame([], schema)
