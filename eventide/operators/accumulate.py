"""User accumulators with a real merge, for structures that Spark has no aggregate for.

A user writes four small functions (create, add a batch, merge two, result).  Every
map task folds its own rows into one accumulator per group, so what is shuffled is
one accumulator per task and group, never rows.  These are merged in a tree of fixed
fan-in: no task sees more than ``FAN_IN`` accumulators of a group at a time, however
many tasks there were or however hot the group is.

:class:`HeavyHitters` is such a structure: the frequent values of a column with a
bound on the error of each count.
"""

from __future__ import annotations

import pickle
import sys
from collections.abc import Iterator

import pandas as pd
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .sequence import JSON_TIMES

# Functions and classes of this module run in Python workers; ship them by value.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Accumulators merged by one task; three levels serve FAN_IN cubed map tasks.
FAN_IN = 128
#: Groups a map task holds at a time; their accumulators leave when there are more.
OPEN_GROUPS = 1_000


class Accumulator:
    """What a user defines; values must be picklable."""

    def create(self):
        raise NotImplementedError

    def add(self, value, rows: pd.DataFrame):
        """``value`` with a batch of rows of its group."""
        raise NotImplementedError

    def merge(self, one, other):
        raise NotImplementedError

    def result(self, value) -> list[dict]:
        """Output rows of a group."""
        raise NotImplementedError

    #: Schema of a result row, and the columns that ``add`` reads.
    schema: str = ""
    columns: list[str] = []


def accumulate(df: DataFrame, how: Accumulator, keys: list[str] = ()) -> DataFrame:
    """One accumulator per group of ``keys`` (one in all without keys): its result
    rows.  Null keys are a group of their own; no rows give no result."""
    keys = list(keys)
    # key values stay in Spark: their text names the group
    text = F.to_json(F.struct(*keys), JSON_TIMES) if keys else F.lit("")
    named = df.select(text.alias("_group"), *how.columns)

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part, held = TaskContext.get().partitionId(), {}
        for batch in batches:
            for group, rows in batch.groupby("_group", sort=False):
                held[group] = how.add(held[group] if group in held else how.create(), rows[how.columns])
            if len(held) > OPEN_GROUPS:
                yield _packed(held, part)
                held = {}
        if held:
            yield _packed(held, part)

    schema = "_group string, _part int, _value binary"
    merged = named.mapInPandas(partial, schema)
    for level in (FAN_IN, FAN_IN ** 2, 0):
        at = F.floor(F.col("_part") / level).cast("int") if level else F.lit(0)
        merged = (merged.withColumn("_at", at).groupBy("_group", "_at")
                  .applyInPandas(_merging(how, level), schema))
    fields = T.StructType.fromDDL(how.schema)

    def finish(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [{"_group": g, **r} for g, v in zip(batch["_group"], batch["_value"]) for r in how.result(pickle.loads(v))]
            yield pd.DataFrame(rows, columns=["_group", *[f.name for f in fields]])
    out = merged.mapInPandas(finish, T.StructType([T.StructField("_group", T.StringType()), *fields]))
    if not keys:
        return out.drop("_group")
    parsed = F.from_json("_group", T.StructType([T.StructField(k, df.schema[k].dataType) for k in keys]), JSON_TIMES)
    return out.withColumn("_key", parsed).select("_key.*", *[f.name for f in fields])


def _packed(held: dict, part: int) -> pd.DataFrame:
    return pd.DataFrame({"_group": list(held), "_part": part, "_value": [pickle.dumps(v) for v in held.values()]})


def _merging(how: Accumulator, level: int):
    def merge(rows: pd.DataFrame) -> pd.DataFrame:
        value = None
        for packed in rows["_value"]:
            other = pickle.loads(packed)
            value = other if value is None else how.merge(value, other)
        first = rows.iloc[0]
        return pd.DataFrame({"_group": [first["_group"]], "_part": [int(first["_at"]) * level],
                             "_value": [pickle.dumps(value)]})
    return merge


class HeavyHitters(Accumulator):
    """The frequent values of a column, with at most ``size`` counters.

    Counters over ``size`` are cut by the largest count that has to go, and the cuts are
    summed up: a value's true count lies between ``at_least`` and ``at_least`` plus that
    error, which is at most rows / (size + 1).  So every value with a larger count is in
    the result.  Summaries merge by adding counters and cutting again, with the same
    bound.  Nulls are not counted as values."""

    def __init__(self, column: str, size: int, kind: str = "long"):
        self.columns, self.size = [column], size
        self.schema = f"{column} {kind}, at_least long, at_most long, rows long"

    def create(self):
        return {}, 0, 0

    def _cut(self, counts: dict, error: int, rows: int):
        if len(counts) > self.size:
            cut = sorted(counts.values(), reverse=True)[self.size]
            counts = {v: c - cut for v, c in counts.items() if c > cut}
            error += cut
        return counts, error, rows

    def add(self, value, rows):
        counts, error, n = value
        for v, c in rows[self.columns[0]].value_counts().items():
            v = v.item() if hasattr(v, "item") else v
            counts[v] = counts.get(v, 0) + int(c)
        return self._cut(counts, error, n + len(rows))

    def merge(self, one, other):
        counts = dict(one[0])
        for v, c in other[0].items():
            counts[v] = counts.get(v, 0) + c
        return self._cut(counts, one[1] + other[1], one[2] + other[2])

    def result(self, value):
        counts, error, rows = value
        column = self.columns[0]
        return [{column: v, "at_least": c, "at_most": c + error, "rows": rows} for v, c in counts.items()]


def frequent_values(df: DataFrame, column: str, min_share: float, keys: list[str] = ()) -> DataFrame:
    """Values that hold more than ``min_share`` of their group's rows, with exact counts:
    a summary of 1 / ``min_share`` counters finds all candidates, a second pass counts
    these alone.  Only candidates are joined, at most 1 / ``min_share`` a group."""
    keys = list(keys)
    kind = df.schema[column].dataType.simpleString()
    size = int(1 / min_share) + 1
    found = accumulate(df, HeavyHitters(column, size, kind), keys).select(*keys, column, "rows")
    names = [*keys, column]
    marked = found.select(*[F.col(c).alias(f"_f{i}") for i, c in enumerate(names)], F.col("rows").alias("_rows"))
    on = [F.col(c).eqNullSafe(F.col(f"_f{i}")) for i, c in enumerate(names)]
    return (df.select(*names).join(marked, on).groupBy(*names)
            .agg(F.count("*").alias("cnt"), F.first("_rows").alias("n_rows"))
            .where(F.col("cnt") > min_share * F.col("n_rows")))
