import math
import re
from collections import Counter

import numpy as np
import pytest
from eventide.llm import decontaminate, mixing, toxicity
from pyspark.sql import functions as F

from tests.conftest import SF01


# --- mixing -----------------------------------------------------------------

def test_poisson_inverts_the_distribution(spark):
    us = [0.0, 0.1, 0.5, 0.9, 0.999999, 1 - 1e-9]
    df = spark.createDataFrame([(u, r) for u in us for r in (0.0, 0.3, 1.0, 7.5, 120.0)], "u double, r double")
    for row in df.withColumn("n", mixing.poisson(F.col("u"), F.col("r"))).collect():
        cdf, term, k = math.exp(-row.r), math.exp(-row.r), 0
        while row.u >= cdf and k < 1000 and row.r > 0:
            k += 1
            term *= row.r / k
            cdf += term
        assert row.n == (k if row.r > 0 else 0)


def test_large_rates_keep_their_mean(spark):
    n = spark.range(300).select(mixing.poisson(mixing.uniform(3, F.col("id")), F.lit(2000.0)).alias("n")).toPandas()["n"]
    assert abs(n.mean() - 2000) < 4 * math.sqrt(2000 / 300) and 0.7 < n.var() / 2000 < 1.4


def test_mix_meets_target_shares(spark):
    docs = spark.createDataFrame([(i, f"t{i}", "a" if i < 6000 else "b" if i < 8500 else None) for i in range(9000)],
                                 "doc_id bigint, text string, source string")
    got = mixing.mix(docs, weights={"a": 1, "b": 1, None: 2, "absent": 5})
    n = Counter(r.source for r in got.select("source").collect())
    total = sum(n.values())
    assert abs(total - 9000) < 400 and abs(n["a"] / total - 0.25) < 0.03 and abs(n[None] / total - 0.5) < 0.05
    assert set(mixing.mix(docs, weights={"b": 1}).select("source").distinct().toPandas()["source"]) == {"b"}
    keys = got.toPandas()["mix_key"].to_numpy()
    assert abs(np.corrcoef(keys, got.toPandas()["doc_id"])[0, 1]) < 0.05


def test_mix_odd_rows(spark, odd_docs, no_docs):
    a, b = (sorted(map(str, mixing.mix(odd_docs).collect())) for _ in range(2))
    assert a == b and {"doc_id", "text", "key", "score", "copy"} <= set(mixing.mix(odd_docs).columns)
    rates = {r.source: r.rate for r in mixing.rates(odd_docs).collect()}
    counts = Counter(r.source for r in odd_docs.collect())
    root = sum(math.sqrt(v) for v in counts.values())
    for s, n in counts.items():
        assert rates[s] == pytest.approx(math.sqrt(n) / root / (n / sum(counts.values())))
    assert mixing.mix(no_docs).count() == 0


# --- decontamination ----------------------------------------------------------

def template(text):
    """Plain version of the canonical form, token by token."""
    out, before_number, ended = [], False, True
    for word in re.split("[ \t\n\r\v\f]+", text or ""):
        bare = word.strip(decontaminate.PUNCTUATION)
        if not bare:
            continue
        low = bare.lower()
        number = re.fullmatch(decontaminate.NUMBER[1:-1], low) is not None or low in decontaminate.NUMBER_WORDS
        if number:
            out.append(("<num>", low))
        elif low in decontaminate.UNITS and before_number:
            out.append(("<unit>", low))
        elif re.match(r"[A-ZÀ-ÖØ-Þ][a-zß-öø-ÿ]", bare) and not ended:
            out.append(("<name>", low))
        else:
            out.append((low, low))
        before_number, ended = number, re.search(r"[.!?:][\"')\]]*$", word) is not None
    return out


def brute(docs, items, window=8, share=0.5):
    found = set()
    for d, text in docs:
        t = template(text)
        for item, body in items:
            b, covered = template(body), set()
            size = min(window, len(b))
            for shift in range(-len(b), len(t)):
                hits = [i for i in range(len(b) - size + 1) if size and 0 <= i + shift and i + shift + size <= len(t)
                        and [x for x, _ in b[i:i + size]] == [x for x, _ in t[i + shift:i + shift + size]]
                        and 2 * sum(not x.startswith("<") for x, _ in b[i:i + size]) >= size]
                slots = {(b[i + k][1], t[i + shift + k][1]) for i in hits for k in range(size) if b[i + k][0].startswith("<")}
                if len({v for v, _ in slots}) == len(slots):
                    covered |= {i + k for i in hits for k in range(size)}
            if b and covered and len(covered) >= share * len(b):
                found.add((d, item))
    return found


ITEMS = [(1, "If Tom walks 5 km in 2 hours and Anna walks 7 km in the same time, how far do Tom and Anna walk in all?"),
         (2, "What is the name of the river that flows through the old town?"), (3, "Too short one"), (4, None), (5, "")]


def leaks():
    other = "a few words that have no leak in them but go on for some time"
    return [
        (10, f"{other}. {ITEMS[0][1]} {other}"),
        (11, f"{other}. If Bob walks 12 miles in 3 hours and Eve walks 9 miles in the same time, how far do Bob and Eve walk in all? {other}"),
        # Tom becomes Bob at first and Kim later: not the same question
        (12, f"{other}. If Bob walks 5 km in 2 hours and Eve walks 7 km in the same time, how far do Kim and Kim walk in all? {other}"),
        (13, other), (14, None), (15, ""), (16, f"{other}\n{ITEMS[1][1].upper()}"), (17, "too short one"),
        (18, " ".join([ITEMS[1][1]] * 3)), (None, f"{ITEMS[1][1]} {other}"), (19, "5 km 7 km 9 km " * 30)]


def test_decontamination_equals_brute_force(spark):
    docs = leaks() + [(100 + i, f"{ITEMS[1][1]} {i}") for i in range(3)]
    d = spark.createDataFrame(docs, "doc_id bigint, text string")
    b = spark.createDataFrame(ITEMS + [(None, ITEMS[1][1])], "item_id bigint, text string")
    want = brute(docs, ITEMS)
    for block in (decontaminate.BLOCK, 7):
        got = {(r.doc_id, r.item_id) for r in decontaminate.find(d, b, block=block).collect()}
        assert got == want
    assert {(10, 1), (11, 1), (16, 2), (17, 3), (18, 2)} <= want and not any(x in (13, 14, 19) for x, _ in want)
    exact = {(r.doc_id, r.item_id): r.exact for r in decontaminate.find(d, b).collect()}
    assert exact[(10, 1)] and not exact[(11, 1)]
    kept = {r.doc_id for r in decontaminate.remove(d, b).collect()}
    assert kept == {x for x, _ in docs} - {x for x, _ in want}


def test_decontamination_odd_rows(spark, odd_docs, no_docs):
    b = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    out = decontaminate.remove(odd_docs, b)
    assert out.count() == odd_docs.count() and out.columns == odd_docs.columns
    assert decontaminate.remove(no_docs, b).count() == 0
    assert decontaminate.remove(odd_docs, b.limit(0)).count() == odd_docs.count()
    assert decontaminate.find(odd_docs, b.limit(0)).count() == 0


def found(spark, docs, items):
    d = spark.createDataFrame(list(enumerate(docs)), "doc_id bigint, text string")
    b = spark.createDataFrame(list(enumerate(items)), "item_id bigint, text string")
    return {(r.doc_id, r.item_id) for r in decontaminate.find(d, b).collect()}


def test_verbatim_items_of_numbers_units_and_names(spark):
    items = ["12 + 7 = 19, 8 + 5 = 13, 40 - 2 = 38", "They met Ann Bo Cy Di Ed Flo Gus Hal Ida Jo Kim Lee Max Ned Ola Pat and 5 more",
             "Convert: 5 km 3 m 2 cm 7 mm"]
    docs = [f"some text first. {x} and more" for x in items]
    others = ["Convert: 5 km 3 m 2 cm 8 mm", "12 + 7 = 19, 8 + 6 = 14, 40 - 3 = 37"]
    assert found(spark, docs + others, items) == {(i, i) for i in range(3)}


def test_names_by_case_and_by_the_word_before(spark):
    items = ["What is the capital of France", "Tom and Anna drove 12 miles to the house of their aunt Mary",
             "Days of rain in the town of Rome"]
    docs = ["Q1\nWhat is the capital of France", "q 1,\nWhat is the capital of Spain",
            "so tom and anna drove 15 miles to the house of their aunt mary",
            "SO TOM AND ANNA DROVE 15 MILES TO THE HOUSE OF THEIR AUNT MARY", "3. Days of rain in the town of Oslo",
            "Q1\nJane is the capital of Spain", "so jim and anna drove 15 miles from the house of their aunt mary"]
    assert found(spark, docs, items) == {(0, 0), (1, 0), (2, 1), (3, 1), (4, 2)}


def test_a_long_part_of_a_long_item(spark):
    word = [f"w{chr(97 + i // 20)}{chr(97 + i % 20)}x" for i in range(200)]
    item, cut = " ".join(word), [" ".join(word[:120]), " ".join(word[120:])]
    docs = [f"lead {' '.join(word[60:85])} tail", f"lead {' '.join(word[60:84])} tail",
            " and ".join(" ".join(word[k:k + 20]) for k in (0, 30, 60, 90)), " ".join(word[:105])]
    assert found(spark, docs, [item]) == {(0, 0), (3, 0)}
    assert found(spark, cut, [item]) == {(0, 0), (1, 0)}


def test_planted_items_of_the_tables(spark):
    docs, bench = (spark.read.parquet(f"{SF01}/{t}.parquet") for t in ("documents", "benchmark"))
    got = {r.doc_id for r in decontaminate.find(docs, bench).collect()}
    items = [r.text.split() for r in bench.collect()]
    whole = {r.doc_id for r in docs.collect() if any(" ".join(i) in " ".join(r.text.split()) for i in items)}
    assert whole <= got and len(got) <= len(whole) + 3


# --- toxicity -------------------------------------------------------------------

def sentences(n=1200, seed=3):
    """Toxic rows hold a slur; the labels of rows that name one group are biased."""
    rng, rows = np.random.default_rng(seed), []
    filler = [f"word{i}" for i in range(300)]
    for i in range(n):
        words = list(rng.choice(filler, 12))
        toxic = rng.random() < 0.4
        if toxic:
            words.append(str(rng.choice(["idiotic", "vermin", "scumbag"])))
        group = rng.random()
        if group < (0.5 if toxic else 0.05):
            words.append("muslim")
        elif group > (0.95 if toxic else 0.5):
            words.append("christian")
        rng.shuffle(words)
        rows.append((i, " ".join(words), int(toxic)))
    return rows


def test_counterfactual_penalty_removes_the_bias(spark):
    rows = sentences()
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id bigint, text string")
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id bigint, toxic int")
    probe = spark.createDataFrame([(1, "my muslim friend sat here"), (2, "my christian friend sat here"),
                                   (3, "my friend sat here"), (4, "you vermin")], "doc_id bigint, text string")
    odds = {}
    for penalty in (0.0, toxicity.PENALTY):
        model = toxicity.fit(docs, labels, penalty=penalty)
        odds[penalty] = {r.doc_id: math.log(r.score / (1 - r.score)) for r in toxicity.score(probe, model).collect()}
        got = (toxicity.score(docs, model).join(labels, "doc_id")
               .select(F.avg(((F.col("score") >= 0.5).cast("int") == F.col("toxic")).cast("int")).alias("a")).first().a)
        assert got > 0.95
    gap = {p: abs(o[1] - o[2]) for p, o in odds.items()}
    assert gap[toxicity.PENALTY] < 0.2 * gap[0.0]
    fair = odds[toxicity.PENALTY]
    assert fair[1] < 0 and fair[2] < 0 and fair[4] > 0


def test_swaps_name_all_other_terms_of_the_group():
    got = toxicity.swaps({"a", "gay", "man"})
    assert len(got) == 5 + 1 and not toxicity.swaps({"nothing", "here"})
    gone, added = got[0]
    assert len(gone) and len(added) and not set(gone) & set(added)


def test_scores_of_the_tables(spark):
    docs, labels = (spark.read.parquet(f"{SF01}/{t}.parquet") for t in ("documents", "labels"))
    model = toxicity.fit(docs, labels)
    got = toxicity.score(docs, model).join(labels, "doc_id").select("score", "toxic").toPandas()
    assert ((got["score"] >= 0.5) == (got["toxic"] == 1)).mean() > 0.95
    assert toxicity.score(docs, model).count() == docs.count()


def test_toxicity_odd_rows(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([(1, 1), (2, 0), (5, 0), (None, 1), (4, None)], "doc_id bigint, toxic int")
    model = toxicity.fit(odd_docs, labels)
    got = toxicity.score(odd_docs, model).collect()
    assert len(got) == odd_docs.count() and all(0 <= r.score <= 1 for r in got)
    assert len({r.score for r in got if not (r.text or "").strip()}) == 1
    assert toxicity.score(no_docs, model).count() == 0
    none = toxicity.fit(odd_docs, labels.limit(0))
    assert {r.score for r in toxicity.score(odd_docs, none).collect()} == {0.0}


def test_log_odds_count_distinct_features():
    import pyarrow as pa
    rng = np.random.default_rng(0)
    model = toxicity.Model(np.where(rng.random(1 << toxicity.BITS) < 0.3, rng.normal(size=1 << toxicity.BITS), 0.0), 0.25)
    texts = ["Stupid stupid! stupidity", "", "  ", "one two three two", "éa É"]
    want = []
    for t in texts:
        words = {w.strip(toxicity.PUNCTUATION).lower() for w in t.split()}
        want.append(0.25 + model.weights[toxicity._features_of(words)].sum())
    assert model.log_odds(pa.array(texts)) == pytest.approx(np.array(want))
