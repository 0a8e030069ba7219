"""From raw documents to training records: rank quality, drop near-duplicates and
benchmark leaks, mix the sources, write token ids.

Each stage takes ``(spark, docs, sf_dir)`` and works on all that the stage before
it kept.  All but the last return the columns of ``documents``.  Null and empty
texts, repeated rows, ties and extra columns are handled as each operator's module
says; an empty table goes through all stages and gives no records.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventide.llm import bagminhash, decontaminate, mixing, quality_ranker, records
from eventide.llm.common import aside, shared_path
from eventide.llm.queries import tokenizer_path
from eventide.sources.tables import read_table

#: SQL cannot express learned scores, signatures and token ids; the tests compare
#: the stages with brute-force versions.
ORACLE_SQL = None


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose Bradley-Terry score reaches the decision threshold."""
    plain, back = aside(docs, "doc_id", "text")
    model = quality_ranker.fit(docs, read_table(spark, sf_dir, "labels"))
    return back(quality_ranker.rank(plain, model, score="_score")
                .where(F.col("_score") >= quality_ranker.DECISION).select(*plain.columns))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class."""
    return bagminhash.deduplicate(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.remove(docs, read_table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated by Poisson draws to the target weights, shuffled."""
    plain, back = aside(docs, "doc_id", "text", "source")
    return back(mixing.mix(plain).select(*plain.columns))


def token_records(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Framed records of token ids, in the mixed order; one row per record."""
    return records.encode_documents(spark, docs, tokenizer_path(), end_id=2, ordered=False)


STAGES = [("quality classifier", quality), ("MinHash near-dedup", near_dedup),
          ("benchmark decontamination", decontamination),
          ("mixing sources to target weights", mix), ("token-ID / binary output", token_records)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and read again."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = shared_path(spark, "pipeline-" + name.split()[0].lower())
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
