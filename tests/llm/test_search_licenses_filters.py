"""Many-query search, license diagonals, and filter orders against brute force."""

import itertools
import math
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from eventide.llm import filter_audit, license_diagonals, shared_terms

# ---------------------------------------------------------------- search


def ranked(docs, items, k=20):
    """Brute force of the ranking rule over ``(doc_id, text)`` and ``(item_id, text)``."""
    def terms(text):
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        return re.findall(shared_terms.TERM, low)
    bags = [(i, Counter(t), len(t)) for i, t in ((i, terms(x)) for i, x in docs) if t]
    n, total = len(bags), sum(x for _, _, x in bags)
    df = Counter(t for _, b, _ in bags for t in b)
    out = []
    for item, text in {(i, x or "") for i, x in items}:
        scores = []
        for doc, bag, size in bags:
            m = 100 - 25 + 25 * size * n // total
            s = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10 ** 9 * bag[t] // (1000 * bag[t] + 12 * m))
                    for t in terms(text) if t in bag)
            if s > 0:
                scores.append((-s, doc is not None, doc or 0, doc))
        out += [(item, r, d, -s) for r, (s, _, _, d) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out, key=str)


def texts(rng, n, vocabulary):
    return [" ".join(rng.choices(vocabulary, weights=[1 / (i + 1) for i in range(len(vocabulary))],
                                 k=rng.choice([0, 1, 5, 40, 200]))) for _ in range(n)]


@pytest.mark.parametrize("seed,block", [(1, 1 << 22), (2, 400)])
def test_ranking_equals_brute_force(spark, monkeypatch, seed, block):
    """Shared and repeated terms, ties, empty texts; also in many blocks of items."""
    monkeypatch.setattr(shared_terms, "BLOCK_BYTES", block)
    monkeypatch.setattr(shared_terms, "PIECE", 16)
    rng = random.Random(seed)
    vocabulary = ["the", "The", "of", "Ünï", "ÜNÏ", "x1", "a-b", "den tal", "zebra", "q", "_", "é"] + [f"w{i}" for i in range(40)]
    docs = list(enumerate(texts(rng, 300, vocabulary)))
    docs += [(300, None), (301, docs[5][1]), (302, docs[5][1]), (None, docs[7][1]), (303, "the " * 3_000 + "w1")]
    items = [(i, t) for i, t in enumerate(texts(rng, 25, vocabulary))] + [(3, "zebra zebra w1"), (90, None), (91, "nowhere"), (None, "q w2")]
    got = shared_terms.rank(spark.createDataFrame(docs, "doc_id long, text string").repartition(7),
                            spark.createDataFrame(items + items[:3], "item_id long, text string"))
    got = sorted(((r.item_id, r.rank, r.doc_id, r.score) for r in got.collect()), key=str)
    assert got == ranked(docs, items)


def test_plan_shares_sets_and_stays_exact():
    """Items that share many terms: far fewer additions than terms, and the same sums."""
    rng = random.Random(3)
    common = list(range(60))
    items = [Counter(rng.sample(common, 40) + rng.sample(common, 10) + [1_000 + i]) for i in range(80)]
    plan = shared_terms.SharingPlan(items)
    gain = {t: rng.randrange(1, 10 ** 9) for item in items for t in item}
    import numpy as np
    of_term = {t: (np.array([0]), np.array([g], np.int64)) for t, g in gain.items()}
    scores = shared_terms.accumulate(plan, 1, of_term, len(items))
    assert [int(s) for s in scores[:, 0]] == [sum(gain[t] * c for t, c in item.items()) for item in items]
    assert plan.additions() < 0.7 * sum(len(i) for i in items)


def test_search_odd_tables(spark, odd_docs, no_docs):
    items = spark.createDataFrame([(1, "river town map", "x"), (2, None, "y")], "item_id long, text string, score string")
    got = shared_terms.rank(odd_docs, items).collect()
    assert {(r.item_id, r.rank) for r in got} == {(1, i) for i in range(1, 5)}
    assert [r.doc_id for r in sorted(got, key=lambda r: r.rank)] == [None, 1, 1, 2]
    assert shared_terms.rank(no_docs, items).count() == 0
    assert shared_terms.rank(odd_docs, items.limit(0)).count() == 0


# ---------------------------------------------------------------- licenses


MIT = next(t for label, t in license_diagonals.TEMPLATES if label == "mit" and len(t) > 200)


def scanned(spark, rows):
    df = license_diagonals.scan(spark.createDataFrame(rows, "doc_id long, text string"))
    return {r.doc_id: r for r in df.collect()}


def test_license_texts_found_with_edits(spark):
    rng = random.Random(5)
    words = MIT.split()
    noise = [f"noise{i}" for i in range(400)]
    dropped = [w for i, w in enumerate(words) if i % 17]
    swapped = [("thing" if i % 13 == 5 else w) for i, w in enumerate(words)]
    added = [x for i, w in enumerate(words) for x in ([w, "extra"] if i % 19 == 7 else [w])]
    rows = [(1, " ".join(noise + words + noise)), (2, MIT.upper().replace(" ", "\n * ")), (3, " ".join(dropped)),
            (4, " ".join(swapped)), (5, " ".join(noise[:50] + added + noise)), (6, " ".join(words[:40])),
            (7, " ".join(rng.sample(words, len(words)))), (8, " ".join(noise)), (9, MIT + "\n\n" + MIT)]
    got = scanned(spark, rows)
    assert {i for i, r in got.items() if r.labels == "mit"} == {1, 2, 3, 4, 5, 9}
    assert all(r.base_labels == "" and r.n_base == 0 and r.first_word is None for r in got.values())
    assert got[1].score == 1.0 and (got[1].spans[0]["first"], got[1].spans[0]["last"]) == (400, 400 + len(words))  # "and/or" is two
    assert 0.6 <= got[3].score < 1 and got[8].score == 0 and got[6].score == 0


def test_base_places_and_labels(spark):
    text = "The MIT License, mit-license. APACHE\nlicense general public license; GENERAL PUBLIC licenses mit  license"
    got = scanned(spark, [(1, text), (2, "mıt license MİT License"), (3, "Released under the MIT License.")])
    words = re.findall("[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+", text.lower())
    places = [i for p in license_diagonals.PHRASES for i in range(len(words)) if words[i:i + len(p.split())] == p.split()]
    r = got[1]
    assert (r.n_words, r.n_base, r.first_word, r.last_word) == (len(words), len(places), min(places), max(places))
    assert r.base_labels == r.labels == "apache,gpl,mit"
    assert got[2].n_base == 0 and got[2].base_labels == ""
    assert (got[3].labels, got[3].score) == ("mit", 1.0)


def test_license_odd_tables(spark, odd_docs, no_docs):
    clash = odd_docs.withColumnsRenamed({"copy": "_h", "key": "spans", "lang": "d"}).withColumn("_0", F.lit(3)).withColumn("b", F.lit("b"))
    out = license_diagonals.scan(clash)
    assert out.count() == clash.count()
    assert [r["_0"] for r in out.select("_0").distinct().collect()] == [3]
    assert out.where("doc_id = 3 OR doc_id = 4").select("n_words", "n_base", "labels", "score").distinct().count() == 1
    assert out.select(*[c for c in clash.columns if c not in ("score", "spans")]).exceptAll(
        clash.drop("score", "spans")).count() == 0
    assert license_diagonals.scan(no_docs).count() == 0
    with pytest.raises(ValueError):
        license_diagonals.scan(no_docs, [("x", "word " * 300_000)])


# ---------------------------------------------------------------- filter orders


def audited(docs, labels, letters="ABCDE"):
    """Brute force: every order applied to every document."""
    def words(t):
        return re.findall("[^\\x20\\x09-\\x0D]+", t)
    tests = {"A": lambda t: len(words(t)) < 50, "B": lambda t: 100 * len(set(words(t))) < 65 * len(words(t)),
             "C": lambda t: 100 * len(re.findall("[A-Z]", t)) > 5 * len(t), "D": lambda t: bool(re.search("[#$%&*|]", t))}
    smallest = {}
    for i, t, _ in docs:
        if i is not None:
            smallest[t or ""] = min(smallest.get(t or "", i), i)
    good = {i for i, q, _ in labels if q == 1} - {None}
    toxic = {i for i, _, x in labels if x == 1} - {None}
    out = {}
    parts = {s or "" for *_, s in docs}
    rows = [(i, s or "", {f for f in letters if (i is not None and i > smallest[t or ""] if f == "E" else tests[f](t or ""))})
            for i, t, s in docs]
    shapley = Counter()
    for order in itertools.permutations(letters):
        for part in parts:
            left = [(i, fails) for i, s, fails in rows if s == part]
            every = left
            for step, f in enumerate(order, 1):
                gone = [x for x in left if f in x[1]]
                here = {id(x) for x in left}
                left = [x for x in left if f not in x[1]]
                out[part, "".join(order), step] = [
                    len(left), len(gone), sum(f in x[1] and id(x) not in here for x in every),
                    sum(x[1] == {f} for x in every), sum(x[0] in good for x in gone), sum(x[0] in toxic for x in gone)]
                shapley[part, f] += len(gone)
    return {k: (*v, shapley[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


def test_orders_equal_brute_force(spark):
    rng = random.Random(11)
    pool = ["plain words " * 30, " ".join(f"word{i}" for i in range(60)), "LOUD WORDS " * 30, "few", "",
            " ".join(f"a{i} #" for i in range(60)), " ".join(f"b{i}" for i in range(60)) + " |"]
    docs = [(rng.choice([None, *range(200)]) if i % 9 == 0 else i, rng.choice([*pool, None]), rng.choice(["x", "y", None, ""]))
            for i in range(260)]
    docs += [(5, pool[1], "x"), (5, pool[1], "x"), (None, None, None)]
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1])) for i in range(0, 260, 2)] + [(4, 1, 1), (4, 0, 0), (None, 1, 1)]
    out = filter_audit.audit(spark.createDataFrame(docs, "doc_id long, text string, source string").repartition(5),
                             spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    got = {(r.part, r.filter_order, r.step): (r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost, r.shapley)
           for r in out.collect()}
    assert got == audited(docs, labels)
    assert len(got) == 600 * len({s or "" for *_, s in docs})


def test_other_filters_and_odd_tables(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([(1, 1, 0), (2, 0, 1)], "doc_id long, quality int, toxic int")
    two = {"x": lambda t: F.length(t) < 20, "y": lambda t: t.contains("river")}
    out = filter_audit.audit(odd_docs, labels, two, same=None).where("part = 'a' AND filter_order = 'xy'").orderBy("step").collect()
    # part a: 1 (twice), 4, null with river
    assert [(r.step, r.kept, r.removed, r.good_lost) for r in out] == [(1, 3, 1, 0), (2, 0, 3, 2)]
    assert filter_audit.audit(odd_docs, labels).groupBy("part").count().where("count <> 600").count() == 0
    assert filter_audit.audit(no_docs, labels).count() == 0
    assert filter_audit.audit(odd_docs, labels.limit(0)).agg(F.sum("good_lost"), F.sum("toxic_lost")).first()[0] == 0
