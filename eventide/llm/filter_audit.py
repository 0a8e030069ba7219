"""Interaction of filters under every order, by a recursive walk over prefixes.

Every document gets a mask with one bit per filter it fails.  Documents of a part
with equal masks are one cell, and all counts follow from the cells.  A recursive
query starts from the masks that occur with the empty prefix; each level extends
every prefix by each letter it lacks and carries the bits applied so far, so the
rows of a level say what its step does to a cell: kept, removed here, or failing
this filter but removed earlier.  The counts of the parts join these rows by mask,
and each order reads its steps from its prefixes, which orders share.

The walk has at most 2^n masks times the prefixes of n letters, whatever the table
holds (n = 5: 10,432 rows); it is the only table that is broadcast.

The filters (letters in order of the bits) are conditions on the whole text; one
more, ``SAME``, fails a document whose text a smaller ``doc_id`` has anywhere in the
table.  Texts are compared by a 128-bit hash.  Null texts count as empty, null
sources as the empty string.  Rows with a null ``doc_id`` are counted, but neither
fail ``SAME`` nor make others fail, and have no labels; of rows that repeat an id and
text none fails it for that; where an id has several labels any 1 counts.  Extra
columns are not read; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import let, to_table, whole, words

SAME = "E"

#: Conditions under which a text fails, by letter (fixed values of the query).
FILTERS: dict[str, Callable[[Column], Column]] = {
    "A": lambda t: F.size(words(t)) < 50,
    "B": lambda t: let(words(t), lambda w: 100 * F.size(F.array_distinct(w)) < 65 * F.size(w)),
    "C": lambda t: 100 * F.regexp_count(t, F.lit("[A-Z]")) > 5 * F.length(t),
    "D": lambda t: t.rlike("[#$%&*|]"),
}


def cells(docs: DataFrame, labels: DataFrame, filters: dict[str, Callable[[Column], Column]] | None = None,
          same: str | None = SAME) -> DataFrame:
    """``part, mask, n, good, toxic``: rows, and rows labelled quality 1 and toxic 1."""
    filters = FILTERS if filters is None else filters
    text = whole(F.col("text"))
    mask = F.lit(0)
    for bit, fails in enumerate(filters.values()):
        mask = mask.bitwiseOR(F.when(fails(text), 1 << bit).otherwise(0))
    keys = ["doc_id", "part", "a", "b", "mask"]
    rows = (docs.select("doc_id", F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"),
                        F.xxhash64(text).alias("a"), F.xxhash64(F.lit(1), text).alias("b"), mask.alias("mask"))
            .groupBy(*keys).agg(F.count("*").alias("n")))
    rows = to_table(rows, "filter-rows")
    known, nameless = rows.where("doc_id IS NOT NULL"), rows.where("doc_id IS NULL")
    if same is not None:
        # the key holds the id, so copies of one text are spread over tasks
        first = known.groupBy("a", "b").agg(F.min("doc_id").alias("doc_id")).withColumn("first", F.lit(True))
        repeats = F.when(F.col("first").isNull(), 1 << len(filters)).otherwise(0)
        known = (known.join(first, ["a", "b", "doc_id"], "left")
                 .withColumn("mask", F.col("mask").bitwiseOR(repeats)))
    marks = (labels.where("doc_id IS NOT NULL").groupBy("doc_id")
             .agg(*[F.max(F.when(F.col(c) == 1, 1).otherwise(0)).alias(f"is_{c}") for c in ("quality", "toxic")]))
    known = known.join(marks, "doc_id", "left").select("part", "mask", "n", "is_quality", "is_toxic")
    none = F.lit(None).cast("int")
    every = known.unionByName(nameless.select("part", "mask", "n", none.alias("is_quality"), none.alias("is_toxic")))

    def of(mark: str) -> Column:
        return F.sum(F.when(F.col(mark) == 1, F.col("n")).otherwise(0))
    return every.groupBy("part", "mask").agg(F.sum("n").alias("n"), of("is_quality").alias("good"),
                                             of("is_toxic").alias("toxic"))


def walk(masks: DataFrame, letters: str) -> DataFrame:
    """``mask, prefix, applied, bit, step`` for all prefixes of the letters' orders:
    ``applied`` are the bits up to the prefix's last letter, whose bit is ``bit``."""
    choices = ", ".join(f"named_struct('letter', '{c}', 'bit', {1 << i})" for i, c in enumerate(letters))
    return masks.sparkSession.sql(f"""
        WITH RECURSIVE walk (mask, prefix, applied, bit, step) AS (
          SELECT mask, '', 0, 0, 0 FROM {{masks}}
          UNION ALL
          SELECT mask, concat(prefix, c.letter), applied | c.bit, c.bit, step + 1
          FROM (SELECT *, explode(filter(array({choices}), x -> applied & x.bit = 0)) AS c
                FROM walk WHERE step < {len(letters)}))
        SELECT * FROM walk WHERE step > 0""", masks=masks)


def audit(docs: DataFrame, labels: DataFrame, filters: dict[str, Callable[[Column], Column]] | None = None,
          same: str | None = SAME) -> DataFrame:
    """One row per part, order of the filters, and step."""
    filters = FILTERS if filters is None else filters
    letters = "".join(filters) + (same or "")
    n = len(letters)
    counts = to_table(cells(docs, labels, filters, same), "filter-cells")
    steps = to_table(walk(counts.select("mask").distinct(), letters), "filter-walk")

    mask, bit, before = F.col("mask"), F.col("bit"), F.col("applied").bitwiseXOR(F.col("bit"))
    fails, gone = mask.bitwiseAND(bit) != 0, mask.bitwiseAND(before) != 0
    removed = fails & ~gone

    def total(which: Column, what: str = "n") -> Column:
        return F.sum(F.when(which, F.col(what)).otherwise(0))
    metrics = (counts.join(F.broadcast(steps), "mask").groupBy("part", "prefix", "step", "bit")
               .agg(total(~gone & ~fails).alias("kept"), total(removed).alias("removed"),
                    total(fails & gone).alias("redundant"), total(mask == bit).alias("unique_fails"),
                    total(removed, "good").alias("good_lost"), total(removed, "toxic").alias("toxic_lost")))
    orders = (steps.where(F.col("step") == n).select(F.col("prefix").alias("filter_order")).distinct()
              .select("filter_order", F.explode(F.sequence(F.lit(1), F.lit(n))).alias("step"))
              .withColumn("prefix", F.expr("substr(filter_order, 1, step)")).drop("step"))
    # a part and letter have one row per order
    shapley = F.sum("removed").over(Window.partitionBy("part", "bit"))
    return (metrics.join(F.broadcast(orders), "prefix")
            .select("part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails",
                    "good_lost", "toxic_lost", shapley.alias("shapley")))
