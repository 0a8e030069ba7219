import itertools
import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from eventide.llm import bagminhash, line_dedup

from tests.conftest import SF001


def bag(text):
    words = [w.strip(bagminhash.PUNCTUATION).lower() for w in re.split("[ \t\n\r\v\f]+", text or "")]
    words = [w for w in words if w]
    return Counter(tuple(words[i:i + 5]) for i in range(max(len(words) - 4, 1))) if words else Counter()


def jaccard(a, b):
    low, high = sum((a & b).values()), sum((a | b).values())
    return low / high if high else 0.0


def brute_classes(rows, similar=0.8):
    """Class id of each row by comparing all pairs."""
    texts = list(dict.fromkeys(t or "" for _, t in rows))
    bags, parent = [bag(t) for t in texts], list(range(len(texts)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    shared = {}
    for i, b in enumerate(bags):
        for s in b:
            shared.setdefault(s, []).append(i)
    for i, j in {p for v in shared.values() for p in itertools.combinations(v, 2)}:
        if root(i) != root(j) and jaccard(bags[i], bags[j]) >= similar:
            parent[root(i)] = root(j)
    of = {t: root(i) for i, t in enumerate(texts)}
    least = {}
    for d, t in rows:
        if d is not None:
            r = of[t or ""]
            least[r] = min(least.get(r, d), d)
    return sorted((str(d), t or "", str(least.get(of[t or ""]))) for d, t in rows)


def found_classes(df, **options):
    return sorted((str(r.doc_id), r.text or "", str(r.class_id)) for r in bagminhash.classes(df, **options).collect())


def edited(words, n, rng):
    out = list(words)
    for i in rng.choice(len(out), n, replace=False):
        out[i] = f"new{rng.integers(1 << 30)}"
    return " ".join(out)


def family(seed=0, copies=40):
    """Copies of one text with few to many edits, copies of copies, and equal texts."""
    rng = np.random.default_rng(seed)
    base = [f"w{i}" for i in rng.integers(0, 4000, 200)]
    texts = [" ".join(base)] + [edited(base, int(rng.integers(1, 9)), rng) for _ in range(copies)]
    texts += [edited(t.split(), 2, rng) for t in texts[1:15]]
    texts += texts[:5] + [f"unrelated text {i} " + edited(base[:40], 40, rng) for i in range(20)]
    return [(int(i), t) for i, t in zip(rng.permutation(len(texts)), texts)]


def test_classes_of_the_tables_equal_brute_force(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert found_classes(docs) == brute_classes(rows)


@pytest.mark.parametrize("options", [{}, {"rounds": 1, "block": 4}])
def test_family_of_copies_equals_brute_force(spark, options):
    rows = family()
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert found_classes(df, **options) == brute_classes(rows)


def test_signature_is_unbiased_for_weighted_bags():
    rng, got, want = np.random.default_rng(5), [], []
    for _ in range(60):
        words = [f"x{i}" for i in range(6)]
        n = rng.integers(0, 12, (2, 30))
        # shingles are five words, so repeat separate five-word units far apart
        units = [" ".join(rng.permutation(words)[:5]) + f" u{i}" for i in range(30)]
        a, b = (" ".join(u for u, c in zip(units, k) for _ in range(c)) for k in n)
        s = bagminhash.signatures(pa.array([a, b]))
        got.append((s[0] == s[1]).mean())
        want.append(jaccard(bag(a), bag(b)))
    error = np.array(got) - np.array(want)
    spread = math.sqrt(np.mean(np.array(want) * (1 - np.array(want))) / bagminhash.SIZE)
    assert abs(error.mean()) < 4 * spread / math.sqrt(60) and error.std() < 1.5 * spread


def test_similarity_counts_multiplicity():
    t = ["a b c d e", "a b c d e a b c d e", "", "x y"]
    bags = bagminhash._bags(pa.array(t))
    for i, j in itertools.product(range(4), repeat=2):
        assert bagminhash.similarity(bags[i], bags[j]) == pytest.approx(jaccard(bag(t[i]), bag(t[j])))


def test_classes_of_odd_rows(spark, odd_docs, no_docs):
    got = bagminhash.classes(odd_docs)
    assert got.columns == [*odd_docs.columns, "class_id"]
    rows = got.collect()
    assert len(rows) == odd_docs.count()
    assert {r.class_id for r in rows if r.doc_id in (1, 2)} == {1}
    assert {r.class_id for r in rows if not r.text} == {3}
    assert {r.class_id for r in rows if r.doc_id is None and r.text} == {1}
    assert bagminhash.classes(no_docs).count() == 0
    kept = bagminhash.deduplicate(odd_docs)
    # the text without words, "one two" and "three four five" are classes of their own
    assert kept.columns == odd_docs.columns
    assert sorted((r.doc_id, len(r.text or "")) for r in kept.select("doc_id", "text").collect()) == sorted(
        {(r.class_id, len(r.text or "")) for r in rows if r.doc_id == r.class_id})
    assert bagminhash.deduplicate(no_docs).count() == 0


def test_deduplicate_keeps_one_of_each_class(spark):
    rows = family(3) + [(500, "same words here"), (501, "same words here"), (500, "same words here"),
                        (None, "no id"), (None, "no id")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    kept = Counter(r.doc_id for r in bagminhash.deduplicate(df).collect())
    assert kept == Counter({None if c == "None" else int(c) for _, _, c in brute_classes(rows)})


def test_components_of_long_chains(spark):
    key = lambda i: bytearray(f"{i:08d}".encode())
    order = np.random.default_rng(2).permutation(60)
    edges = [(key(order[i]), key(order[i + 1])) for i in range(59) if i % 20 != 19]
    got = bagminhash.components(spark.createDataFrame(edges, "a binary, b binary")).collect()
    label = {int(bytes(r.key)): int(bytes(r.label)) for r in got}
    for start in (0, 20, 40):
        part = order[start:start + 20].tolist()
        assert {label[i] for i in part} == {min(part)}


# --- line runs ---------------------------------------------------------------------

def brute_lines(rows, min_words=50):
    """Delete every shortest run of enough words whose lines occurred before."""
    seen, out = set(), {}
    for key in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        lines = (key[1] or "").split("\n")
        worded = [k for k, x in enumerate(lines) if re.search(r"[^ \t\n\v\f\r]", x)]
        n = [len(re.findall(r"[^ \t\n\v\f\r]+", lines[k])) for k in worded]
        gone = set()
        for i in range(len(worded)):
            total = 0
            for j in range(i, len(worded)):
                total += n[j]
                if total >= min_words:
                    block = tuple(lines[k] for k in worded[i:j + 1])
                    if block in seen:
                        gone |= set(worded[i:j + 1])
                    seen.add(block)
                    break
        out[key] = key[1] if not gone else "\n".join(x for k, x in enumerate(lines) if k not in gone)
    return sorted((str(d), out[(d, t)] or "") for d, t in rows)


def test_line_runs_equal_brute_force(spark):
    rng = np.random.default_rng(4)
    pool = [" ".join(f"l{i}w{j}" for j in range(rng.integers(1, 12))) for i in range(12)] + ["", "  "]
    rows = [(i, "\n".join(pool[k] for k in rng.integers(0, len(pool), rng.integers(0, 25)))) for i in range(60)]
    copied = "\n".join(f"line {k} of a long passage" for k in range(30))
    rows += [(100, copied), (101, "start\n" + copied + "\nend"), (102, copied + "\n" + copied), (103, None), (104, "")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    for least in (5, 12, 50):
        got = sorted((str(r.doc_id), r.text or "") for r in line_dedup.remove_repeats(df, min_words=least).collect())
        assert got == brute_lines(rows, least)


def test_deleted_runs_are_maximal(spark):
    part = "\n".join(f"a line {k} with some eight words in it" for k in range(10))
    df = spark.createDataFrame([(1, part), (2, f"own\n{part}\nmore\n{part}")], "doc_id bigint, text string")
    got = {r.doc_id: r for r in line_dedup.remove_repeats(df).collect()}
    assert got[1].deleted == [] and got[2].text == "own\nmore"
    assert [(r.start, r.lines) for r in got[2].deleted] == [(1, 10), (12, 10)]


def test_line_runs_of_odd_rows(spark, odd_docs, no_docs):
    out = line_dedup.remove_repeats(odd_docs)
    assert out.columns == [*odd_docs.columns, "deleted"] and out.count() == odd_docs.count()
    texts = [(r.doc_id, r.text) for r in out.collect()]
    # the null id comes first and keeps the text; repeated rows get equal results
    assert (3, None) in texts and (4, "") in texts and len([t for t in texts if t[0] == 1]) == 2
    assert line_dedup.remove_repeats(no_docs).count() == 0
