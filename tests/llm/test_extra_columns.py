"""Columns of the caller that bear the operators' own names come through unchanged."""

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from eventide.llm import (bagminhash, decontaminate, license_diagonals, line_dedup, mixing, site_style_tree, toxicity)

NAMES = ("_key _id _k _doc _hash _source _html _nodes _host _text _n _h _score _ws _d _to _t _c _c2 d h i k x y a b n t "
         "key label text_hash host path nodes tokens lines gone class_id_ template hash words u m bands prints").split()
TEXTS = ["the river and the town are on the map and it is as good as any place to be in " * 4, "one two three", None, "",
         "the river and the town are on the map and it is as good as any place to be in " * 4]


@pytest.fixture(scope="module")
def docs(spark):
    base = spark.createDataFrame([(i, t, "en", f"s{i % 2}", len(t or "")) for i, t in enumerate(TEXTS)],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    return base.withColumns({c: F.concat(F.lit(f"{c}-"), F.col("doc_id")) for c in NAMES})


def unchanged(out, ident="doc_id"):
    rows = out.select(ident, *NAMES).collect()
    assert rows and all(r[c] == f"{c}-{r[ident]}" for r in rows for c in NAMES)


def test_operators_keep_extra_columns(spark, docs):
    bench = spark.createDataFrame([(1, "nothing of this is there at all in any of them")], "item_id long, text string")
    for out in (bagminhash.deduplicate(docs), bagminhash.classes(docs), decontaminate.remove(docs, bench),
                mixing.mix(docs), line_dedup.remove_repeats(docs), license_diagonals.scan(docs),
                toxicity.score(docs, toxicity.Model(np.zeros(1 << toxicity.BITS), 0.0))):
        unchanged(out)
        assert set(docs.columns) <= set(out.columns)


def test_pages_keep_extra_columns(spark, docs):
    pages = docs.drop("text").withColumnsRenamed({"doc_id": "page_id"}).withColumns(
        {"url": F.lit("http://h.example/p"), "html": F.lit("<p>some words</p>")})
    unchanged(site_style_tree.extract(pages), "page_id")


def test_stages_keep_extra_columns(spark, docs, tmp_path):
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(40)], "doc_id long, quality int, toxic int")
    bench = spark.createDataFrame([(1, "nothing of this is there at all")], "item_id long, text string")
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    bench.write.parquet(str(tmp_path / "benchmark.parquet"))
    clash = docs.withColumns({"rate": F.lit("r"), "copy": F.lit("c"), "mix_key": F.lit("m")})
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, clash, str(tmp_path))
        assert out.columns == clash.columns
        for r in out.collect():
            assert (r.rate, r["copy"], r.mix_key) == ("r", "c", "m") and all(r[c] == f"{c}-{r.doc_id}" for c in NAMES)
