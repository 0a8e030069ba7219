import math
import zlib

import numpy as np
import pytest
from eventide.llm import quality_ranker, quality_rules
from eventide.llm.common import held_out
from pyspark.sql import functions as F

from tests.conftest import SF01


def test_base_counts_by_hand(spark):
    text = "a b c a b c\nx *y*\n\nx *y*\n"
    r = quality_rules.apply(spark.createDataFrame([(1, text, "en")], "doc_id bigint, text string, lang string")).first()
    # a b c (words 0-2) and its repeat (3-5); "x *y* x" and others occur once
    assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (10, 14, 4, 1, 6)
    assert r.base_failed and not r.kept


def test_overlapping_repeats_count_each_word_once(spark):
    r = quality_rules.apply(spark.createDataFrame([(1, "a a a a a", "en")], "doc_id bigint, text string, lang string")).first()
    assert r.n_repeat_words == 5


def test_distance_rejects_symbols_and_keeps_prose(spark):
    prose = "the river and the town are on the map and it is as good as any of us can be " * 20
    other = "you may of course go to the house that was at the end of that road in the dale " * 20
    words = prose.split()
    odd = " ".join(f"{w}##$$%%" for w in other.replace(" the ", " xx ").split())
    rows = [(i, " ".join(np.random.default_rng(i).permutation(words)), "en") for i in range(30)]
    rows += [(99, " ".join(np.random.default_rng(99).permutation(odd.split())), "en")]
    got = {r.doc_id: r.kept for r in quality_rules.apply(
        spark.createDataFrame(rows, "doc_id bigint, text string, lang string")).collect()}
    assert not got.pop(99) and all(got.values())


def test_rules_odd_and_empty(odd_docs, no_docs):
    got = quality_rules.apply(odd_docs).collect()
    assert len(got) == odd_docs.count()
    by = {(r.doc_id, r.n_words): r for r in got}
    assert by[(3, 0)].base_failed and by[(6, 0)].n_words == 0 and by[(5, 40_000)].n_words == 40_000
    assert by[(1, 192)].kept == by[(2, 192)].kept
    assert quality_rules.apply(no_docs).count() == 0


def test_ranker_learns_held_out_labels(spark):
    docs, labels = (spark.read.parquet(f"{SF01}/{t}.parquet") for t in ("documents", "labels"))
    model = quality_ranker.fit(docs, labels)
    got = (quality_ranker.rank(docs, model).join(labels, "doc_id").where(held_out(F.col("doc_id")))
           .select(((F.col("score") >= quality_ranker.DECISION).cast("int") == F.col("quality")).cast("int").alias("ok"),
                   "score").toPandas())
    assert got["ok"].mean() >= 0.95 and got["score"].between(0, 1).all()


def test_held_out_is_the_crc_fifth(spark):
    got = spark.range(200).select("id", held_out(F.col("id")).alias("h")).collect()
    assert all(r.h == (zlib.crc32(str(r.id).encode()) % 5 == 0) for r in got)


def test_pair_fit_orders_and_cuts():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(400, 3))
    y = (x[:, 0] - 2 * x[:, 1] + 0.1 * rng.normal(size=400) > -1).astype(int)
    m = quality_ranker.fit_pairs(x, y, max_pairs=20_000)
    w = np.array(m.weights) / np.array(m.scale)
    s = (x - m.mean) @ w
    assert w[0] > 0 > w[1] and ((s >= m.cut) == y).mean() > 0.95
    low = quality_ranker.fit_pairs(x, y, max_pairs=20_000, quantile=0.5)
    assert abs((s >= low.cut).mean() - 0.5) < 0.05


def test_ranker_without_both_labels_rejects_nothing(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([(1, 1), (2, 1), (None, 0)], "doc_id bigint, quality int")
    model = quality_ranker.fit(odd_docs, labels)
    got = quality_ranker.rank(odd_docs, model).select("score").collect()
    assert len(got) == odd_docs.count() and all(r.score == 1 for r in got)
    assert quality_ranker.rank(no_docs, model).count() == 0


def test_ranker_odd_rows(spark, odd_docs):
    model = quality_ranker.Ranker([1.0] * 22, [0.0] * 22, [1.0] * 22, 0.0)
    got = quality_ranker.rank(odd_docs, model).collect()
    assert len(got) == odd_docs.count() and all(r.score is not None and not math.isnan(r.score) for r in got)
    same = [r.score for r in got if r.doc_id in (1, 2)]
    assert len(set(same)) == 1
