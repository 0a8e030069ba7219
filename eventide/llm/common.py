"""Helpers shared by the operators: words and lines of a text, tables in the
shared folder, and code that Python workers receive by value."""

from __future__ import annotations

import sys
import types
import uuid

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir, num_partitions

#: White space of the word contract: space, and the code points 9 to 13.
NOT_SPACE = "[^\\x20\\x09-\\x0D]"
SPACE_RUN = "[\\x20\\x09-\\x0D]+"

#: Frequent function words (fixed values) of the four languages.
FUNCTION_WORDS = {
    "en": "the of and to a in is that for it was on are as with be by at this from or an".split(),
    "de": "der die und in den von zu das mit sich des auf für ist im dem nicht ein eine als".split(),
    "fr": "de la le et les des en un du une que est pour qui dans par sur pas au avec".split(),
    "es": "de la que el en y los del se las por un para con no una su al es lo".split(),
}


def ships_by_value(module: str) -> None:
    """Send this module's functions to Python workers as code, so that executors
    need no copy of the package."""
    cloudpickle.register_pickle_by_value(sys.modules[module])


def let(value: Column, body) -> Column:
    """``body(v)`` with ``value`` evaluated once per row, even where ``body`` uses
    it inside another lambda (there it would be evaluated once per element)."""
    return F.transform(F.array(value), body)[0]


def per_worker(key, make):
    """A value built once per Python worker process and kept for its later tasks
    (functions shipped by value get new globals with every task)."""
    kept = sys.modules.setdefault("_eventide_kept", types.ModuleType("_eventide_kept"))
    if key not in kept.__dict__.setdefault("values", {}):
        kept.values[key] = make()
    return kept.values[key]


def gives_back(run):
    """``run`` for ``mapInArrow``, after whose last batch the worker process, which Spark
    keeps for later tasks, returns what it no longer uses to the system."""
    def wrapped(batches):
        yield from run(batches)
        release_memory()
    return wrapped


def release_memory() -> None:
    import ctypes
    import gc
    import pyarrow as pa
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library
        pass


def aside(df: DataFrame, *used: str, made: tuple[str, ...] = ()):
    """``df`` without the columns ``made`` by an operator and with all columns it does not
    use under names of their own, so that none clashes with the operator's; and a
    function that gives its result the old names back."""
    plain = df.drop(*made)
    names = {c: f"_extra{i}" for i, c in enumerate(plain.columns) if c not in used}
    back = {v: k for k, v in names.items()}
    return plain.withColumnsRenamed(names), lambda out: out.withColumnsRenamed(back)


def whole(text: Column) -> Column:
    return F.coalesce(text, F.lit(""))


def words(text: Column) -> Column:
    """Array of the words ``[^\\x20\\x09-\\x0D]+`` of a text (null: none)."""
    return F.filter(F.split(whole(text), SPACE_RUN), lambda w: w != "")


def lines_with_words(text: Column) -> Column:
    """The ``\\n``-split lines that hold a word."""
    return F.filter(F.split(whole(text), "\n"), lambda x: x.rlike(NOT_SPACE))


def held_out(doc_id: Column) -> Column:
    """True for rows that never train: crc32 of the id as text is divisible by 5
    (a null id counts as the empty text)."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 5 == 0


def shared_path(spark: SparkSession, name: str) -> str:
    """A new folder name below the folder all executors share."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm/{name}-{uuid.uuid4().hex[:12]}"


def to_table(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder once and go on from the files: later jobs
    neither recompute it nor depend on an executor's disk."""
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def sample_label_ids(labels: DataFrame, column: str, limit: int) -> DataFrame:
    """At most ``limit`` labelled ids outside the held-out fifth, chosen by a hash
    of the id; one row per id (the largest label, where an id has several)."""
    return (labels.select("doc_id", F.col(column).cast("int").alias("label"))
            .where(F.col("label").isNotNull() & F.col("doc_id").isNotNull()
                   & ~held_out(F.col("doc_id")))
            .groupBy("doc_id").agg(F.max("label").alias("label"))
            .orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit))


def partitions(spark: SparkSession) -> int:
    return num_partitions(spark)


ships_by_value(__name__)
