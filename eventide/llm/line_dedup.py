"""Repeated line runs, found by distributed prefix doubling over line sequences.

A document is the sequence of its lines that hold a word; blank lines belong to no
run and always stay.  All suffixes of these sequences are put into the buckets of
a suffix array by prefix doubling: from the buckets at depth h and the buckets h
lines further on follow the buckets at depth 2h.  A bucket is named by the first
position in it (documents in order of id, then lines), which is what later copies
are compared with.  A suffix whose bucket has no other member shares no longer
prefix with anything and leaves.

A run counts from ``MIN_WORDS`` words on.  Let t be the least number of lines from a
position on that reach that.  The suffixes with the same first t lines are the
interval of the suffix array in which neighbours have a longest common prefix of
at least t; its name is the pair of the two (overlapping) buckets of depth
h <= t < 2h that cover the t lines.  In every interval the first occurrence stays,
and the t lines of all others are deleted.  Of a longer run that occurs earlier all
lines go that lie in such a window; its last lines stay if no window ends with them
(lines of 60 and 10 words: the second stays).  The query's SQL has the same rule.
Doubling stops when no t is larger: deeper buckets could not change a deletion.

Null and empty texts have no lines and stay.  Equal documents: the first one
stays, the others lose their runs.  Rows that repeat id and text are one document
and get equal results; a null id comes first in order; rows with equal ids are
ordered by a hash of the text.  Extra columns pass through; an empty table gives no
rows.  Lines are compared by a 128-bit hash.  Only Spark functions are used, no
group is gathered beyond the lines of one document.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import NOT_SPACE, aside, let, to_table, whole

MIN_WORDS = 50


def _position_rows(docs: DataFrame, min_words: int) -> DataFrame:
    """``d, h`` (document), ``i`` (place), ``a, b`` (hash of the line), and ``lines``:
    the numbers of the t lines from here (null if too few words follow)."""
    parts = F.transform(F.split(whole(F.col("text")), "\n"), lambda x, k: F.struct(
        k.alias("k"), F.xxhash64(x).alias("a"), F.xxhash64(F.lit(1), x).alias("b"),
        F.regexp_count(x, F.lit(NOT_SPACE + "+")).alias("w")))
    worded = F.filter(parts, lambda p: p["w"] > 0)

    def run(all_lines: Column, i: Column) -> Column:
        # every line has a word, so min_words lines are enough to look at
        ahead = F.slice(all_lines, i + 1, min_words)
        reach = F.aggregate(ahead, F.struct(F.lit(0).alias("w"), F.lit(0).alias("t")),
                            lambda s, p: F.when(s["w"] >= min_words, s).otherwise(
                                F.struct((s["w"] + p["w"]).alias("w"), (s["t"] + 1).alias("t"))))
        return let(F.struct(reach.alias("r"), ahead.alias("l")), lambda x: F.when(
            x["r"]["w"] >= min_words, F.transform(F.slice(x["l"], 1, x["r"]["t"]), lambda p: p["k"])))

    rows = let(worded, lambda ls: F.transform(ls, lambda p, i: F.struct(
        i.alias("i"), p["a"].alias("a"), p["b"].alias("b"), run(ls, i).alias("lines"))))
    return (docs.select(F.col("doc_id").alias("d"), F.xxhash64(whole(F.col("text"))).alias("h"), rows.alias("rows"))
            .select("d", "h", F.inline("rows")))


def _same_document(a: str, b: str) -> Column:
    return F.col(f"{a}.d").eqNullSafe(F.col(f"{b}.d")) & (F.col(f"{a}.h") == F.col(f"{b}.h"))


def _ahead(table: DataFrame, by: Column, among: DataFrame | None = None) -> DataFrame:
    """``table`` with ``c2``: the bucket of the position ``by`` lines further on.  Rows
    go whose line there is no repeated one or lies beyond the document."""
    other = (table if among is None else among).select("d", "h", F.col("i").alias("j"), F.col("c").alias("c2"))
    return (table.withColumn("_to", F.col("i") + by).alias("x")
            .join(other.alias("y"), _same_document("x", "y") & (F.col("x._to") == F.col("y.j")))
            .select(*(f"x.{c}" for c in table.columns), "c2"))


def _named(table: DataFrame, keys: list[str]) -> DataFrame:
    """``table`` with ``name``: the bucket of equal ``keys``, for buckets of two or more."""
    first = table.groupBy(*keys).agg(F.min(F.struct("d", "h", "i")).alias("name"), F.count("*").alias("n")).where("n > 1")
    return table.join(first.drop("n"), keys)


def repeated(docs: DataFrame, *, min_words: int = MIN_WORDS) -> DataFrame:
    """``d, h, gone``: for documents with deletions, the sorted numbers of the lines
    that repeat an earlier run."""
    # the same id and text twice is one document
    rows = to_table(_position_rows(docs, min_words).dropDuplicates(["d", "h", "i"]), "line-rows")
    # Depth 1: only lines that occur again begin or continue a repeated run.
    again = rows.groupBy("a", "b").agg(F.count("*").alias("n")).where("n > 1").select("a", "b")
    level = rows.join(again, ["a", "b"])
    level = to_table(_named(level, ["a", "b"]).select(
        "d", "h", "i", F.size("lines").alias("t"), "lines", F.col("name").alias("c")), "line-buckets")
    depth, intervals = 1, None
    deepest = level.agg(F.max("t")).first()[0] or 0
    while True:
        here = level.where((F.col("t") >= depth) & (F.col("t") < 2 * depth))
        done = here.withColumn("c2", F.col("c")) if depth == 1 else _ahead(
            here, F.col("t") - depth, level)
        intervals = done if intervals is None else intervals.unionByName(done)
        if deepest < 2 * depth:
            break
        level = to_table(_named(_ahead(level, F.lit(depth)), ["c", "c2"]).select(
            "d", "h", "i", "t", "lines", F.col("name").alias("c")), "line-buckets")
        depth *= 2
    first = (intervals.groupBy("t", "c", "c2").agg(F.min(F.struct("d", "h", "i")).alias("first"), F.count("*").alias("n"))
             .where("n > 1").select(F.col("t").alias("_t"), F.col("c").alias("_c"), F.col("c2").alias("_c2"), "first"))
    later = (intervals.join(first, (F.col("t") == F.col("_t")) & (F.col("c") == F.col("_c")) & (F.col("c2") == F.col("_c2")))
             .where(~F.struct("d", "h", "i").eqNullSafe(F.col("first"))))
    # lines of one document only
    return (later.select("d", "h", F.explode("lines").alias("k")).distinct()
            .groupBy("d", "h").agg(F.sort_array(F.collect_list("k")).alias("gone")))


def remove_repeats(docs: DataFrame, *, min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` without later copies; ``deleted`` has the runs ``(start, lines)``."""
    gone = to_table(repeated(docs, min_words=min_words), "repeated-lines")
    plain, back = aside(docs, "doc_id", "text", made=("deleted",))
    kept = F.array_join(F.filter(F.split(F.col("text"), "\n"), lambda x, k: ~F.array_contains(F.col("y.gone"), k)), "\n")
    # starts of runs of consecutive numbers, and how far each goes
    starts = F.filter(F.transform("y.gone", lambda k, n: F.when(
        (n == 0) | (k != F.get(F.col("y.gone"), n - 1) + 1), n)), lambda n: n.isNotNull())
    runs = let(starts, lambda s: F.zip_with(s, F.slice(s, 2, F.size(s)), lambda a, b: F.struct(
        F.get(F.col("y.gone"), a).alias("start"), (F.coalesce(b, F.size("y.gone")) - a).alias("lines"))))
    return back(plain.withColumn("_h", F.xxhash64(whole(F.col("text")))).alias("x")
                # many documents have deletions: the same (sorted) join at every size
                .join(gone.hint("merge").alias("y"),
                      F.col("x.doc_id").eqNullSafe(F.col("y.d")) & (F.col("x._h") == F.col("y.h")), "left")
                .select(*(F.when(F.col("y.gone").isNull(), F.col("x.text")).otherwise(kept).alias("text") if c == "text"
                          else F.col(f"x.{c}") for c in plain.columns),
                        F.coalesce(F.when(F.col("y.gone").isNotNull(), runs),
                                   F.array().cast("array<struct<start:int,lines:int>>")).alias("deleted")))
