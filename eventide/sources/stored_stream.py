"""Stored parquet files as a stream with offsets of its own, read in place.

A Python data source, ``stored_rows``.  The files of a folder in order of name (or one
file) are one sequence of rows; an offset is a file's name and the number of its rows
that are done, so a stream can stop and go on in the middle of a file.  Nothing is
copied and no file times are used: files that come later must have later names.

``rowsPerTrigger`` limits a micro-batch.  Its rows are cut by row group, each cut is a
partition of its own, read by a task that opens the one row group.  Only the footers
of the files that a batch reaches are read on the driver.

Spark asks a Python source for its latest offset without saying where the stream
is.  The end of every planned batch is therefore noted in the ``progress`` folder
(beside the query's checkpoint); a query that starts again goes on from there, and a
batch that was planned but not finished is read again between the same offsets.
"""

from __future__ import annotations

import json
import sys
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

# Readers run in Python workers; ship them by value.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def qualified(spark: SparkSession, path: str) -> str:
    """``path`` with the scheme Spark itself would use, so that workers open the same
    store and not their own disk."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return str(p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(p).toString())


def open_store(uri: str) -> tuple[pafs.FileSystem, str]:
    """File system and path of a qualified address."""
    if uri.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + uri.removeprefix("file:").lstrip("/")
    if uri.startswith("s3a://"):
        uri = "s3://" + uri.removeprefix("s3a://")
    return pafs.FileSystem.from_uri(uri)


def write_whole(fs: pafs.FileSystem, path: str, text: str) -> None:
    """A small file that is there as a whole or not at all."""
    with fs.open_output_stream(f"{path}.new") as out:
        out.write(text.encode())
    fs.move(f"{path}.new", path)


class Cut(InputPartition):
    """Rows ``lo`` to ``hi`` of a row group."""

    def __init__(self, path: str, group: int, lo: int, hi: int):
        self.path, self.group, self.lo, self.hi = path, group, lo, hi


class StoredRowsReader(DataSourceStreamReader):
    def __init__(self, schema: T.StructType, options: dict):
        options = {k.lower(): v for k, v in options.items()}
        self.columns = schema.fieldNames()
        self.uri, self.progress = options["path"], options["progress"]
        self.limit = int(options.get("rowspertrigger", "1000000"))
        if self.limit < 1:
            raise ValueError("rowsPerTrigger must be positive")
        self.at: dict | None = None
        self.footers: dict[str, list[int]] = {}

    # -- the sequence of rows -----------------------------------------------
    def _files(self) -> list[str]:
        fs, path = open_store(self.uri)
        if fs.get_file_info(path).type == pafs.FileType.File:
            return [path]
        found = fs.get_file_info(pafs.FileSelector(path, recursive=False))
        return sorted(f.path for f in found if f.type == pafs.FileType.File and f.base_name[0] not in "._"
                      and f.base_name.endswith(".parquet"))

    def _groups(self, path: str) -> list[int]:
        """Rows of each row group of a file."""
        if path not in self.footers:
            fs, _ = open_store(self.uri)
            with fs.open_input_file(path) as f:
                meta = pq.ParquetFile(f).metadata
                self.footers[path] = [meta.row_group(i).num_rows for i in range(meta.num_row_groups)]
        return self.footers[path]

    def _from(self, offset: dict) -> Iterator[tuple[str, int]]:
        """Files from an offset on, each with the rows of it that are done."""
        for path in self._files():
            name = path.rsplit("/", 1)[-1]
            if name >= offset["file"]:
                yield path, offset["row"] if name == offset["file"] else 0

    # -- Spark's side -------------------------------------------------------
    def initialOffset(self) -> dict:
        return {"file": "", "row": 0}

    def latestOffset(self) -> dict:
        here = self.at or self._noted() or self.initialOffset()
        left, end = self.limit, here
        for path, done in self._from(here):
            rows = sum(self._groups(path))
            step = min(left, rows - done)
            end = {"file": path.rsplit("/", 1)[-1], "row": done + step}
            left -= step
            if not left:
                break
        return end

    def partitions(self, start: dict, end: dict) -> list[Cut]:
        cuts = []
        for path, done in self._from(start):
            name = path.rsplit("/", 1)[-1]
            if name > end["file"]:
                break
            upto = end["row"] if name == end["file"] else sum(self._groups(path))
            first = 0
            for group, rows in enumerate(self._groups(path)):
                lo, hi = max(done, first), min(upto, first + rows)
                if lo < hi:
                    cuts.append(Cut(path, group, lo - first, hi - first))
                first += rows
        self.at = end
        fs, folder = open_store(self.progress)
        fs.create_dir(folder, recursive=True)
        write_whole(fs, f"{folder}/planned.json", json.dumps(end))
        return cuts

    def _noted(self) -> dict | None:
        fs, folder = open_store(self.progress)
        if fs.get_file_info(f"{folder}/planned.json").type != pafs.FileType.File:
            return None
        with fs.open_input_stream(f"{folder}/planned.json") as f:
            return json.loads(f.read().decode())

    def read(self, cut: Cut) -> Iterator[pa.RecordBatch]:
        fs, _ = open_store(self.uri)
        with fs.open_input_file(cut.path) as f:
            at = 0
            for batch in pq.ParquetFile(f).iter_batches(row_groups=[cut.group], columns=self.columns):
                lo, hi = max(cut.lo - at, 0), min(cut.hi - at, batch.num_rows)
                if lo < hi:
                    yield batch.slice(lo, hi - lo).select(self.columns)
                at += batch.num_rows

    def commit(self, end: dict) -> None:
        """Nothing to give back: the files stay."""


class StoredRows(DataSource):
    @classmethod
    def name(cls) -> str:
        return "stored_rows"

    def streamReader(self, schema: T.StructType) -> DataSourceStreamReader:
        return StoredRowsReader(schema, dict(self.options))


def stored_rows(spark: SparkSession, path: str, schema: T.StructType, progress: str, rows_per_trigger: int) -> DataFrame:
    """The stored rows of ``path`` as a stream; ``progress`` is a folder on shared storage
    that belongs to one query."""
    spark.dataSource.register(StoredRows)
    return (spark.readStream.format("stored_rows").schema(schema)
            .option("rowsPerTrigger", rows_per_trigger).option("progress", qualified(spark, progress))
            .load(qualified(spark, path)))
