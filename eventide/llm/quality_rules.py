"""Quality rules: base counts of a text, and the distance of its character-class
and common-word histograms from language references.

A reference is the pooled histogram of all documents of a language (the
``lang`` column, for the languages in ``FUNCTION_WORDS``) that pass the base
rules.  A document is compared with every reference by Jensen-Shannon distance
(base 2, so 0 to 1) and takes the smallest; a wrong or missing ``lang`` thus does
no harm.  Short texts have noisy histograms: below ``min_chars`` or ``min_words``
the test concerned is skipped.

Null and empty texts have no words: all counts 0, base rule failed.  Every row
is judged by itself, so repeated rows and ties get equal results; an empty table
gives no rows.  With no reference (no document passes) only the base rules count.
Only Spark functions are used.  Repeated 3-word windows are found by 64-bit
hashes within one text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import FUNCTION_WORDS, SPACE_RUN, let, lines_with_words, to_table, whole, words

#: Character classes, taken from a text one after another; the last is the rest.
CLASSES = {"small": "[a-z]+", "space": SPACE_RUN, "capital": "[A-Z]+", "stop": "[.,;:?'\"()-]+",
           "digit": "[0-9]+", "symbol": "[#*$%&|<>!=_/@+]+"}
COMMON = sorted({w for ws in FUNCTION_WORDS.values() for w in ws})
_COMMON_CASED = sorted({*COMMON, *(w.capitalize() for w in COMMON), *(w.upper() for w in COMMON)})

MIN_BASE_WORDS, MAX_REPEAT_PERCENT = 50, 50
#: Largest distances kept, and the lengths from which they are tested.
MAX_JS_CHARS, MIN_CHARS = 0.28, 200
MAX_JS_WORDS, MIN_WORDS = 0.32, 150


def _repeat_words(w: Column) -> Column:
    """Words inside 3-word windows that occur at least twice in the text."""
    n = F.size(w)
    windows = F.when(n < 3, F.array().cast("array<struct<h:bigint,i:int>>")).otherwise(F.transform(
        F.sequence(F.lit(0), n - 3),
        lambda i: F.struct(F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)).alias("h"),
                           i.alias("i"))))
    repeated = let(F.sort_array(windows), lambda s: F.filter(F.transform(
        s, lambda x, k: F.when((x["h"] == F.get(s, k - 1)["h"]) | (x["h"] == F.get(s, k + 1)["h"]),
                               x["i"])), lambda i: i.isNotNull()))
    # A window covers three words, less those that the next window covers too.
    return let(F.sort_array(repeated), lambda p: F.aggregate(
        F.zip_with(p, F.slice(p, 2, F.size(p)),
                   lambda a, b: F.least(F.lit(3), F.coalesce(b - a, F.lit(3)))),
        F.lit(0), lambda total, x: total + x))


def _common_words(w: Column) -> Column:
    """Runs ``(i, c)``: place in ``COMMON`` and count, for common words of the text."""
    vocabulary = F.array(*map(F.lit, COMMON))
    found = F.sort_array(F.transform(F.filter(w, lambda x: x.isin(_COMMON_CASED)), F.lower))
    return let(found, lambda s: let(
        F.filter(F.transform(s, lambda x, k: F.when((k == 0) | (x != F.get(s, k - 1)), k)),
                 lambda k: k.isNotNull()),
        lambda starts: F.zip_with(
            starts, F.slice(starts, 2, F.size(starts)),
            lambda a, b: F.struct(
                (F.array_position(vocabulary, F.get(s, a)) - 1).cast("int").alias("i"),
                (F.coalesce(b, F.size(s)) - a).cast("bigint").alias("c")))))


def _class_counts(text: Column) -> Column:
    """Characters of each class, in the order of ``CLASSES`` and then the rest."""
    def step(rest: Column, patterns: list[str], counts: list[Column]) -> Column:
        if not patterns:
            return F.array(*counts, F.length(rest).cast("bigint"))
        return let(F.regexp_replace(rest, patterns[0], ""), lambda left: step(
            left, patterns[1:], [*counts, (F.length(rest) - F.length(left)).cast("bigint")]))
    return step(text, list(CLASSES.values()), [])


def measure(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``lang``, the base counts, and both histograms of every text."""
    text = whole(F.col("text"))
    per_word = let(words(text), lambda w: F.struct(
        F.size(w).cast("bigint").alias("n_words"),
        F.aggregate(w, F.lit(0).cast("bigint"), lambda n, x: n + F.length(x)).alias("word_chars"),
        _repeat_words(w).cast("bigint").alias("n_repeat_words"),
        _common_words(w).alias("common")))
    lines = let(lines_with_words(text), lambda x: F.size(x) - F.size(F.array_distinct(x)))
    symbols = F.length(F.regexp_replace(text, "[^#*$%&|<>]+", ""))
    return (docs.select("doc_id", F.col("lang"), per_word.alias("w"),
                        F.length(text).cast("bigint").alias("n_chars"),
                        symbols.cast("bigint").alias("n_symbols"),
                        lines.cast("bigint").alias("n_dup_lines"),
                        _class_counts(text).alias("classes"))
            .select("doc_id", "lang", "w.n_words", "w.word_chars", "n_symbols", "n_dup_lines",
                    "w.n_repeat_words", "n_chars", "classes", "w.common")
            .withColumn("base_failed", (F.col("n_words") < MIN_BASE_WORDS)
                        | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))))


def references(measured: DataFrame) -> dict[str, tuple[list[float], list[float]]]:
    """Class shares and common-word shares (last: all other words) per language.

    At most one row per language of ``FUNCTION_WORDS`` and bin is collected."""
    good = measured.where(~F.col("base_failed") & F.col("lang").isin(list(FUNCTION_WORDS)))
    classes = {r["lang"]: [r[f"c{i}"] for i in range(len(CLASSES) + 1)] for r in
               good.groupBy("lang").agg(*(F.sum(F.col("classes")[i]).alias(f"c{i}")
                                          for i in range(len(CLASSES) + 1))).collect()}
    total = {r["lang"]: r["n"] for r in
             good.groupBy("lang").agg(F.sum("n_words").alias("n")).collect()}
    common = {k: [0] * len(COMMON) for k in classes}
    for r in (good.select("lang", F.inline("common")).groupBy("lang", "i")
              .agg(F.sum("c").alias("c")).collect()):
        common[r["lang"]][r["i"]] = r["c"]
    return {k: ([c / sum(classes[k]) for c in classes[k]],
                [c / total[k] for c in [*common[k], total[k] - sum(common[k])]])
            for k in sorted(classes)}


def _divergence(p: Column, q: Column) -> Column:
    """One bin's part of twice the Jensen-Shannon divergence (p and q not both 0)."""
    return (F.when(p > 0, p * F.log2(2 * p / (p + q))).otherwise(0.0)
            + F.when(q > 0, q * F.log2(2 * q / (p + q))).otherwise(0.0))


def _distance(twice: Column) -> Column:
    return F.sqrt(F.greatest(twice / 2, F.lit(0.0)))


def _js_classes(counts: Column, n: Column, q: list[float]) -> Column:
    total = F.lit(0.0)
    for i, share in enumerate(q):
        p = counts[i].cast("double") / n
        total = total + F.when((p > 0) | F.lit(share > 0),
                               _divergence(p, F.lit(share))).otherwise(0.0)
    return _distance(total)


def _js_words(common: Column, n: Column, q: list[float]) -> Column:
    """Bins that the text lacks add their reference share each, so only the runs
    of the text are visited."""
    shares = F.array(*map(F.lit, q))
    sums = F.aggregate(
        common, F.struct(F.lit(0.0).alias("d"), F.lit(0.0).alias("q"), F.lit(0).cast("bigint").alias("c")),
        lambda acc, x: F.struct(
            (acc["d"] + _divergence(x["c"].cast("double") / n, F.get(shares, x["i"]))).alias("d"),
            (acc["q"] + F.get(shares, x["i"])).alias("q"), (acc["c"] + x["c"]).alias("c")))

    def finish(s: Column) -> Column:
        other = (n - s["c"]).cast("double") / n
        return _distance(s["d"] + (F.lit(sum(q[:-1])) - s["q"])
                         + F.when((other > 0) | F.lit(q[-1] > 0),
                                  _divergence(other, F.lit(q[-1]))).otherwise(0.0))
    return let(sums, finish)


def judge(measured: DataFrame, refs: dict[str, tuple[list[float], list[float]]], *,
          max_js_chars: float = MAX_JS_CHARS, max_js_words: float = MAX_JS_WORDS,
          min_chars: int = MIN_CHARS, min_words: int = MIN_WORDS) -> DataFrame:
    """Add both distances (null where not tested) and ``kept``."""
    def nearest(cols: list[Column]) -> Column:
        return F.least(*cols) if len(cols) > 1 else cols[0] if cols else F.lit(None).cast("double")

    chars = nearest([_js_classes(F.col("classes"), F.col("n_chars"), c) for c, _ in refs.values()])
    common = nearest([_js_words(F.col("common"), F.col("n_words"), w) for _, w in refs.values()])
    return (measured
            .withColumn("js_chars", F.when(F.col("n_chars") >= max(1, min_chars), chars))
            .withColumn("js_words", F.when(F.col("n_words") >= max(1, min_words), common))
            .withColumn("kept", ~F.col("base_failed")
                        & (F.coalesce(F.col("js_chars"), F.lit(0.0)) <= max_js_chars)
                        & (F.coalesce(F.col("js_words"), F.lit(0.0)) <= max_js_words)))


def apply(docs: DataFrame, **limits) -> DataFrame:
    """Measure every text once (kept as a table of short rows), pool the
    references, and judge."""
    measured = to_table(measure(docs), "quality-rules")
    return judge(measured, references(measured), **limits)
