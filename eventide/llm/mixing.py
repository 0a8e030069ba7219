"""Mixing sources to target weights by Poisson replication.

The target repetition rate of a source is its target share of the corpus over
its actual share, so the expected mix has the target shares and the expected
size is the corpus's.  Each document draws how often it is repeated from a
Poisson distribution with that mean, by inverting the distribution function at a
number in [0, 1) hashed from seed and document; it is exploded by that count and
all copies are shuffled globally: each goes to the partition its hashed key
names and is sorted there by that key.

Shares are of documents.  Without explicit weights, the target shares are the
actual ones raised to ``alpha`` and renormalised (``alpha`` 1 keeps the mix, 0
gives every source the same share), so small sources are repeated and the hot
one is thinned.  A null source is a source of its own (named in ``weights`` by
None).  Sources that ``weights`` leaves out get rate 0; weights of absent sources
are dropped and the rest renormalised.

A draw depends on id, text and seed only, so a task that runs again draws the
same.  Rows that repeat an id and text draw the same number.  Null ids and texts
hash as empty ones.  Extra columns pass through (``copy`` and ``mix_key`` are
replaced if they exist); an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import aside, let, partitions, to_table, whole

SEED, ALPHA = 17, 0.5


def uniform(seed: int, *parts: Column) -> Column:
    """A number in [0, 1) from the first 52 bits of a digest of seed and parts."""
    text = F.concat_ws("|", F.lit(str(seed)), *(F.coalesce(p.cast("string"), F.lit("")) for p in parts))
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("bigint").cast("double") / float(1 << 52)


def poisson(u: Column, rate: Column) -> Column:
    """Smallest k whose distribution function exceeds ``u``.

    The terms are summed up to a k beyond which the tail is under 2**-60; a ``u``
    in [0, 1 - 2**-52] lies below that.  Rates over 500 are split into equal parts
    of at most 500 (the exponential would underflow), each drawn with its own
    digits of ``u``."""
    def draw(v: Column, mean: Column) -> Column:
        last = F.ceil(mean + 12 * F.sqrt(mean) + 30).cast("int")
        start = F.struct(F.exp(-mean).alias("term"), F.exp(-mean).alias("cdf"), F.lit(0).alias("n"))
        return F.aggregate(
            F.sequence(F.lit(1), last), start,
            lambda s, k: F.when(v < s["cdf"], s).otherwise(F.struct(
                (s["term"] * mean / k).alias("term"), (s["cdf"] + s["term"] * mean / k).alias("cdf"),
                k.alias("n"))),
            lambda s: s["n"])
    few = let(F.struct(u.alias("u"), rate.alias("r")), lambda x: draw(x["u"], x["r"]))
    pieces = F.ceil(rate / 500).cast("int")
    many = F.aggregate(
        F.transform(F.sequence(F.lit(1), F.greatest(pieces, F.lit(1))),
                    lambda i: let(F.struct(uniform(0, u, i).alias("u"), (rate / pieces).alias("r")),
                                  lambda x: draw(x["u"], x["r"]))),
        F.lit(0), lambda a, b: a + b)
    return F.when(rate <= 0, F.lit(0)).when(rate <= 500, few).otherwise(many)


def rates(docs: DataFrame, *, weights: dict[str | None, float] | None = None,
          alpha: float = ALPHA) -> DataFrame:
    """``source, rate`` per source; one row per source, written to the shared folder."""
    counts = docs.groupBy("source").agg(F.count("*").alias("n"))
    if weights is not None:
        given = docs.sparkSession.createDataFrame(
            [(k, float(v)) for k, v in weights.items()], "source string, target double")
        counts = (counts.alias("c").join(given.alias("g"), F.col("c.source").eqNullSafe(F.col("g.source")), "left")
                  .select("c.source", "n", F.coalesce("target", F.lit(0.0)).alias("target")))
    else:
        counts = counts.withColumn("target", F.pow(F.col("n").cast("double"), F.lit(float(alpha))))
    counts = to_table(counts, "mixing-counts")
    total = counts.agg(F.sum("n").alias("n"), F.sum("target").alias("t")).first()
    if not total["n"] or not total["t"]:
        return counts.select("source", F.lit(0.0).alias("rate"))
    # target / sum(target) over n / sum(n), in one division for a stable last digit
    return counts.select("source", (F.col("target") * float(total["n"])
                                    / (F.col("n") * float(total["t"]))).alias("rate"))


def replicate(docs: DataFrame, by_source: DataFrame, *, seed: int = SEED) -> DataFrame:
    """Documents with ``rate``, ``copy`` (0, 1, ...) and ``mix_key``, in random order.

    The rates are one row per source; Spark broadcasts them when their table is
    small and otherwise splits the hot source's rows (skew join)."""
    plain, back = aside(docs, "doc_id", "text", "source", made=("rate", "copy", "mix_key"))
    names = plain.columns
    r = by_source.select(F.col("source").alias("_source"), "rate")
    joined = plain.join(r, F.col("source").eqNullSafe(F.col("_source")), "left").drop("_source")
    ident = (F.col("doc_id"), F.md5(whole(F.col("text"))))
    n = poisson(uniform(seed, *ident), F.col("rate"))
    copies = (joined.withColumn("_n", n).where(F.col("_n") > 0)
              .select(*names, "rate", F.explode(F.sequence(F.lit(0), F.col("_n") - 1)).alias("copy"))
              .withColumn("mix_key", uniform(seed + 1, *ident, F.col("copy"))))
    return back(copies.repartition(partitions(docs.sparkSession), "mix_key")
                .sortWithinPartitions("mix_key", "doc_id"))


def mix(docs: DataFrame, *, weights: dict[str | None, float] | None = None, alpha: float = ALPHA,
        seed: int = SEED) -> DataFrame:
    return replicate(docs, rates(docs, weights=weights, alpha=alpha), seed=seed)
