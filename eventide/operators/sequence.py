"""Ordered per-key scans that stay parallel however rows are spread over keys.

Running aggregates, ``lag`` and "first later row" searches need the rows of a
key in order.  A plain window puts every row of a key into one task.  Here the
sequence of all rows by (keys, order, hash of the row) is cut at sampled bounds
into chunks of about equal size, so a hot key, a null key and rows that tie in
``order`` are all spread over chunks.  The bounds are a sorted array inside the
plan and a row finds its chunk by binary search: the chunk number is a function
of the row, the same for every scan and for tasks that run again, and nothing is
written.  Each scan runs inside (keys, chunk), after one hash shuffle and one sort
that all scans of a prepared DataFrame share, and then adds the carry of the key's
earlier chunks.

A key crosses a border between chunks only if the bound there has that key.  Only
the rows of such keys are summarised for carries, by partial aggregation over the
input itself; the summaries, at most two keys per chunk, are joined (null-safe) as a
broadcast, whose size is thus bounded by the number of chunks.  There is one plan for
all inputs.

Only the balance of the chunks depends on the sample, never a result.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import num_partitions

CHUNK, TIE, CROSSES = "_chunk", "_tie", "_crosses"

#: Most chunks of a scan: bounds live in the plan.
MAX_CHUNKS = 20_000
#: Rows sampled per chunk, and at least, to place the bounds.
SAMPLE_PER_CHUNK, MIN_SAMPLE = 50, 4_000

_OPS = ("sum", "count", "max", "min", "last")


def order_micros(df: DataFrame, col: str) -> Column:
    """A numeric column that rises with ``col``."""
    dt = df.schema[col].dataType
    if isinstance(dt, T.TimestampNTZType):
        return F.expr(f"timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', `{col}`)")
    if isinstance(dt, T.TimestampType):
        return F.unix_micros(F.col(col))
    if isinstance(dt, T.DateType):
        return F.unix_date(F.col(col))
    return F.col(col)


def sorted_position(value: Column, bound, size: int) -> Column:
    """How many of ``size`` sorted bounds (``bound(i)`` is the i-th) are at most
    ``value``: a binary search of log2(size) steps."""
    if not size:
        return F.lit(0)
    steps = F.array(*[F.lit(1 << k) for k in reversed(range(size.bit_length()))])
    return F.aggregate(steps, F.lit(0), lambda at, step: F.when(
        (at + step <= size) & (bound(at + step - 1) <= value), at + step).otherwise(at))


def array_literal(json_text: str, element: T.DataType) -> Column:
    """A constant array given as JSON; folded to a literal when the plan is made."""
    return F.from_json(F.lit(json_text), T.ArrayType(element), JSON_TIMES)


#: Microseconds, so that bounds on times are exact.
JSON_TIMES = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}


@dataclass
class KeyedSequence:
    """Rows ordered by ``order`` within each ``keys`` group; ties in ``order`` are
    ordered by a hash of the row, or of the columns ``tie`` where they tell rows
    apart (then nothing else of ``df`` is computed to place the bounds).

    Call :meth:`prepare` once; every scan method then takes and returns a
    DataFrame that still carries the helper columns, so several scans share one
    chunking.  :meth:`finish` drops them.  ``chunks`` is the number of chunks
    (default: the session's shuffle partitions).
    """

    keys: list[str]
    order: list[str]
    chunks: int | None = None
    tie: list[str] | None = None

    # ------------------------------------------------------------------ setup
    def prepare(self, df: DataFrame) -> DataFrame:
        """Number the chunk of each row and mark the rows of keys that may cross a
        chunk border."""
        hashed = self.tie or [c for c, t in zip(df.columns, df.schema) if not _has_map(t.dataType)]
        rows = df.withColumn(TIE, F.xxhash64(*[F.col(c) for c in hashed]))
        by = [*self.keys, *self.order, TIE]
        kind = rows.select(F.struct(*by).alias("p")).schema["p"].dataType
        found, size = self._bounds(rows.select(*by))
        if not size:
            return rows.withColumns({CHUNK: F.lit(0), CROSSES: F.lit(False)})
        bounds = array_literal(found, kind)
        rows = rows.withColumn(CHUNK, sorted_position(F.struct(*by), lambda i: F.get(bounds, i), size))
        if not self.keys:
            return rows.withColumn(CROSSES, F.lit(True))
        # the bounds below and above the row's chunk
        crosses = F.lit(False)
        for at in (F.get(bounds, F.col(CHUNK) - 1), F.get(bounds, F.col(CHUNK))):
            same = at.isNotNull()
            for k in self.keys:
                same = same & at[k].eqNullSafe(F.col(k))
            crosses = crosses | same
        return rows.withColumn(CROSSES, crosses)

    def _bounds(self, places: DataFrame) -> tuple[str | None, int]:
        """Sorted places that cut the rows into about equal chunks, as JSON."""
        n = max(1, min(MAX_CHUNKS, int(self.chunks or num_partitions(places.sparkSession))))
        total = places.count() if n > 1 else 0
        if not total:
            return None, 0
        wanted = max(MIN_SAMPLE, SAMPLE_PER_CHUNK * n)
        sample = places if total <= wanted else places.sample(wanted / total, seed=7)
        picked = (sample.agg(F.sort_array(F.collect_list(F.struct("*"))).alias("s"))
                  .select(F.filter(F.transform(F.sequence(F.lit(1), F.lit(n - 1)), lambda i: F.get(
                      "s", F.floor(i * F.size("s") / n).cast("int"))), lambda p: p.isNotNull()).alias("s")))
        text, size = picked.select(F.to_json("s", JSON_TIMES), F.size("s")).first()
        return text, size

    def finish(self, df: DataFrame) -> DataFrame:
        return df.drop(CHUNK, TIE, CROSSES)

    # -------------------------------------------------------------- helpers
    @property
    def parts(self) -> list[str]:
        """What a scan is partitioned by; ``CROSSES`` follows from the others, so that
        a filter on it reaches the input."""
        return [*self.keys, CHUNK, CROSSES]

    def _order_cols(self, reverse: bool) -> list[Column]:
        return [F.col(c).desc() if reverse else F.col(c).asc() for c in [*self.order, TIE]]

    def window(self, reverse: bool = False):
        return Window.partitionBy(*self.parts).orderBy(*self._order_cols(reverse))

    def place(self) -> Column:
        return F.struct(*[F.col(c) for c in [*self.order, TIE]])

    def add_carry(self, df: DataFrame, carry: DataFrame, cols: list[str]) -> DataFrame:
        """Join ``carry`` (keys, chunk, ``cols``; at most two rows per chunk)."""
        by = [*self.keys, CHUNK]
        renamed = carry.select(*[F.col(c).alias(f"_j{i}") for i, c in enumerate(by)], *cols)
        on = [F.col(c).eqNullSafe(F.col(f"_j{i}")) for i, c in enumerate(by)]
        return df.join(F.broadcast(renamed), on, "left").drop(*[f"_j{i}" for i in range(len(by))])

    def entry_rows(self, crossing: DataFrame, state: str, fold, name: str) -> DataFrame:
        """Per (keys, chunk): what the chunk begins with, as ``name``.

        ``crossing`` holds the rows of crossing keys with the state since the start of
        the chunk in the column ``state``; ``fold`` is a vectorised function that turns
        a key's chunk states, in order, into one entry per chunk.  A key has at most as
        many states as there are chunks."""
        last = (crossing.groupBy(*self.keys, CHUNK).agg(F.max_by(state, self.place()).alias("_total"))
                .groupBy(*self.keys).agg(F.sort_array(F.collect_list(F.struct(CHUNK, "_total"))).alias("_all")))
        return (last.withColumn("_in", fold(F.col("_all._total")))
                .select(*self.keys, F.explode(F.arrays_zip(F.col(f"_all.{CHUNK}").alias("c"), F.col("_in").alias("e"))).alias("_x"))
                .select(*self.keys, F.col("_x.c").alias(CHUNK), F.col("_x.e").alias(name)))

    def opens(self) -> Column:
        """True on the first row of each key in a chunk; the rows of a partition are
        sorted where this has been added."""
        return F.row_number().over(self.window()) == 1

    # ---------------------------------------------------------------- scans
    def running(self, df: DataFrame, specs: dict[str, tuple[str, Column]], *,
                reverse: bool = False, inclusive: bool = True) -> DataFrame:
        """Add running aggregates.

        ``specs`` maps output name -> ``(op, column)``, op one of sum, count,
        max, min, last (last non-null).  ``reverse`` scans from the end
        (suffix aggregates); ``inclusive=False`` excludes the current row.
        """
        for op, _ in specs.values():
            if op not in _OPS:
                raise ValueError(f"unsupported running op {op!r}")
        end = 0 if inclusive else -1
        w = self.window(reverse).rowsBetween(Window.unboundedPreceding, end)
        summary = (df.filter(CROSSES).groupBy(*self.parts)
                   .agg(*[self._total(op, e, reverse).alias(f"_t_{name}")
                          for name, (op, e) in specs.items()]))
        cw = (Window.partitionBy(*self.keys)
              .orderBy(F.col(CHUNK).desc() if reverse else F.col(CHUNK).asc())
              .rowsBetween(Window.unboundedPreceding, -1))
        carry = summary.select(*self.parts, *[
            self._merge(op, F.col(f"_t_{name}")).over(cw).alias(f"_c_{name}")
            for name, (op, _) in specs.items()])
        out = self.add_carry(df, carry, [f"_c_{name}" for name in specs])
        out = out.withColumns({f"_l_{name}": self._local(op, e).over(w) for name, (op, e) in specs.items()})
        out = out.withColumns({
            name: self._combine(op, F.col(f"_l_{name}"), F.col(f"_c_{name}"))
            for name, (op, _) in specs.items()})
        return out.drop(*[f"_l_{n}" for n in specs], *[f"_c_{n}" for n in specs])

    def lag(self, df: DataFrame, cols: list[str], n: int, prefix: str = "prev") -> DataFrame:
        """Add ``{prefix}{j}`` = struct of ``cols`` from the j-th previous row
        of the same key (null when there is none), for j = 1..n."""
        payload = F.struct(*[F.col(c) for c in cols])
        w = self.window()
        # Last n rows of every chunk of a crossing key, then the last n rows
        # before each chunk from the n chunks before it.
        tail = (df.filter(CROSSES).select(*self.parts, *self.order, TIE, payload.alias("_p"))
                .withColumn("_rd", F.row_number().over(self.window(reverse=True)))
                .filter(F.col("_rd") <= n)
                .groupBy(*self.parts)
                .agg(F.sort_array(F.collect_list(F.struct(self.place().alias("_o"), "_p"))).alias("_tail")))
        cw = Window.partitionBy(*self.keys).orderBy(CHUNK).rowsBetween(-n, -1)
        flat = F.flatten(F.collect_list(F.col("_tail._p")).over(cw))
        carry = tail.select(*self.parts, flat.alias("_carry")).select(
            *self.parts,
            F.slice("_carry", F.greatest(F.size("_carry") - n + 1, F.lit(1)), n).alias("_carry"))
        out = (self.add_carry(df, carry, ["_carry"])
               .withColumns({"_rn": F.row_number().over(w),
                             **{f"_lag{j}": F.lag(payload, j).over(w) for j in range(1, n + 1)}}))
        fills = {}
        for j in range(1, n + 1):
            idx = F.size("_carry") - (F.lit(j) - F.col("_rn"))
            from_carry = F.when(F.col("_carry").isNotNull() & (idx >= 1),
                                F.element_at("_carry", idx))
            fills[f"{prefix}{j}"] = F.when(F.col("_rn") > j, F.col(f"_lag{j}")).otherwise(from_carry)
        return out.withColumns(fills).drop("_rn", "_carry", *[f"_lag{j}" for j in range(1, n + 1)])

    # ------------------------------------------------------- op definitions
    @staticmethod
    def _local(op: str, e: Column) -> Column:
        return {"sum": F.sum, "count": F.count, "max": F.max, "min": F.min}.get(
            op, lambda c: F.last(c, ignorenulls=True))(e)

    def _total(self, op: str, e: Column, reverse: bool) -> Column:
        if op == "last":
            key = F.when(e.isNotNull(), self.place())
            return F.min_by(e, key) if reverse else F.max_by(e, key)
        return self._local(op, e)

    @staticmethod
    def _merge(op: str, t: Column) -> Column:
        return {"sum": F.sum, "count": F.sum, "max": F.max, "min": F.min}.get(
            op, lambda c: F.last(c, ignorenulls=True))(t)

    @staticmethod
    def _combine(op: str, local: Column, carry: Column) -> Column:
        if op == "count":
            return F.coalesce(carry, F.lit(0)) + local
        if op == "sum":
            return (F.when(carry.isNull(), local).when(local.isNull(), carry)
                    .otherwise(local + carry))
        if op == "max":
            return F.greatest(local, carry)
        if op == "min":
            return F.least(local, carry)
        return F.coalesce(local, carry)


def scan_udf(fn, kind):
    """An iterator function over sorted rows.  Its value depends on the rows before, so
    the optimizer must neither move filters below it nor evaluate it a second time."""
    return F.pandas_udf(fn, kind).asNondeterministic()


def _has_map(t: T.DataType) -> bool:
    if isinstance(t, T.MapType):
        return True
    if isinstance(t, T.ArrayType):
        return _has_map(t.elementType)
    return isinstance(t, T.StructType) and any(_has_map(f.dataType) for f in t.fields)


def keyed(df: DataFrame, keys: list[str], order: list[str], **kw) -> tuple[KeyedSequence, DataFrame]:
    """Shorthand: build and prepare a :class:`KeyedSequence`."""
    seq = KeyedSequence(list(keys), list(order), **kw)
    return seq, seq.prepare(df)
