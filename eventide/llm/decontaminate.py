"""Benchmark decontamination by template canonicalisation.

A text becomes a sequence of lower-case words without outer punctuation, in which
numbers, names (capitalised inside a sentence) and units (after a number) are
typed placeholders.  Windows of ``WINDOW`` template tokens are hashed; windows of
documents and benchmark items meet in a hash join and are compared in full.
Matches of one document, item and alignment must fill the item's slots
consistently: equal values of the item map to equal values of the document.  That
finds items whose numbers, names or units were exchanged, and drops chance
matches of mere templates.  A document is contaminated by an item if consistent
matches cover at least ``MIN_COVERAGE`` of the item's tokens, or if one alignment
covers ``MIN_RUN`` consecutive tokens (a part of a long item).

Whether a word is a name depends on its case and on the word before it.  Windows are
therefore also compared with names as plain lower-case words, and the first word of
an item also as the name or unit that it may be after the words of a document; as
such it has to be the same word.

Items shorter than a window are one window of their own length.  Templates in which
fewer than half of the tokens are words tell too little and are left out.  Besides
its template, each window is compared as its plain lower-case words.  Such verbatim
windows count without regard to slots, so a verbatim copy of any item is found
(also of one that is a single number or word).

Null and empty texts and items have no tokens and match nothing.  Rows that repeat
id and text are one document; equal items are reported each.  A null document id
is kept as such; items without an id are ignored.  Extra columns are not read by
the search and pass through ``remove``.  Empty tables give no matches.

Documents are searched in one map pass against the hashes of benchmark windows.
Those are sent to the executors in blocks of at most ``BLOCK`` hashes, one pass per
block; only windows that hit are shuffled.
"""

from __future__ import annotations

import itertools

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import aside, gives_back, let, ships_by_value, to_table, whole
from .records import _slices

WINDOW = 8
MIN_COVERAGE = 0.5
MIN_RUN = 25
#: Hashes of benchmark windows sent to executors at a time (8 bytes each).
BLOCK = 1_000_000

#: Outer punctuation (fixed values).
PUNCTUATION = ".,;:!?\"'()[]{}<>|*#%&$-_=+/\\`~^@…–—“”‘’«»¿¡"
NUMBER = r"^[+-]?\d+([.,:/]\d+)*(st|nd|rd|th)?$"
#: Number words and units (fixed values).
NUMBER_WORDS = ("one two three four five six seven eight nine ten eleven twelve thirteen fifteen "
                "twenty thirty forty fifty sixty seventy eighty ninety hundred thousand million").split()
UNITS = ("mm cm m km in ft yd mile miles inch inches foot feet yard yards meter meters metre metres "
         "kilometer kilometers kilometre kilometres g kg mg lb lbs oz gram grams kilogram kilograms "
         "pound pounds ounce ounces ton tons l ml liter liters litre litres gallon gallons s sec second "
         "seconds min minute minutes h hr hour hours day days week weeks month months year years "
         "dollar dollars cent cents euro euros usd eur gbp percent degrees mph kmh kph").split()
PLACEHOLDERS = ("<num>", "<unit>", "<name>")
_BASE = 0x9E3779B97F4A7C15 | 1


class Templates:
    """Template tokens of an array of texts, one text after another."""

    def __init__(self, texts: pa.Array):
        split = pc.ascii_split_whitespace(texts)
        coded = split.flatten().dictionary_encode()
        word = coded.dictionary
        bare = pc.utf8_trim(word, characters=PUNCTUATION)
        lower = pc.utf8_lower(bare)

        def flags(mask) -> np.ndarray:
            return mask.to_numpy(zero_copy_only=False).astype(bool)

        number = flags(pc.or_(pc.match_substring_regex(lower, NUMBER),
                              pc.is_in(lower, value_set=pa.array(NUMBER_WORDS))))
        unit = flags(pc.is_in(lower, value_set=pa.array(UNITS)))
        capital = flags(pc.match_substring_regex(bare, r"^\p{Lu}\p{Ll}+"))
        ends = flags(pc.match_substring_regex(word, r"[.!?:][\"')\]]*$"))
        names = lower.to_numpy(zero_copy_only=False).astype(object)
        hashes = pd.util.hash_array(names, categorize=False) if len(names) else np.zeros(0, np.uint64)

        use = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        text = np.repeat(np.arange(len(texts)), np.diff(split.offsets.to_numpy()))
        keep = (names != "")[use] if len(use) else np.zeros(0, bool)
        use, self.text = use[keep], text[keep]
        first = np.ones(len(use), bool)
        first[1:] = self.text[1:] != self.text[:-1]

        def before(mask: np.ndarray) -> np.ndarray:
            out = np.zeros(len(use), bool)
            out[1:] = mask[use[:-1]]
            return out & ~first

        is_number = number[use]
        is_unit = unit[use] & before(number)
        is_name = capital[use] & ~is_number & ~is_unit & ~first & ~before(ends)
        self.kind = np.select([is_number, is_unit, is_name], [1, 2, 3], 0).astype(np.int8)
        marks = np.concatenate(([0], pd.util.hash_array(np.array(PLACEHOLDERS, dtype=object),
                                                        categorize=False))).astype(np.uint64)
        self.marks, self.hashes = marks, hashes[use]
        self.values, self.use = names, use
        self.capital, self.unit = capital[use], unit[use]
        start = np.flatnonzero(first)
        # place of a token in its text
        self.place = np.arange(len(use)) - (np.repeat(start, np.diff(np.append(start, len(use))))
                                            if len(use) else 0)

    def forms(self) -> list[np.ndarray]:
        """Kinds of all tokens (0: the word itself): as template, with names as words,
        and verbatim."""
        return [self.kind, np.where(self.kind == 3, 0, self.kind), np.zeros_like(self.kind)]

    def after_words(self) -> np.ndarray:
        """Kinds as template where other words come before each text."""
        first = (self.place == 0) & (self.kind == 0)
        return np.select([first & self.unit, first & self.capital], [2, 3], self.kind)

    def windows(self, length: int, kind: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Starts of all windows that lie in one text, and their hashes in a form."""
        code = np.where(kind > 0, self.marks[kind], self.hashes)
        n = len(code) - length + 1
        if n <= 0:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        h = np.full(n, length, np.uint64)
        with np.errstate(over="ignore"):
            for i in range(length):
                h = h * np.uint64(_BASE) + code[i:i + n]
                h ^= h >> np.uint64(29)
        start = np.flatnonzero(self.text[:n] == self.text[length - 1:])
        return start, h[start]

    def template(self, span: range, kind: np.ndarray) -> list[str]:
        return [PLACEHOLDERS[kind[i] - 1] if kind[i] else self.value(i) for i in span]

    def value(self, i: int) -> str:
        return self.values[self.use[i]]


def _repeats(forms: list[np.ndarray], f: int, span: range) -> bool:
    """Whether a window has the same tokens in an earlier form."""
    here = forms[f][span.start:span.stop]
    return any((here == k[span.start:span.stop]).all() for k in forms[:f])


def benchmark_windows(benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """``item_id, n_tokens, item_at, length, hash, template, vals`` of all windows:
    telling templates, also with names as words or as after other words, and verbatim."""
    def cut(batches):
        for batch in batches:
            t = Templates(batch.column("text"))
            sizes = np.bincount(t.text, minlength=batch.num_rows)
            items, rows = batch.column("item_id").to_pylist(), []
            for length in {min(window, int(n)) for n in sizes if n}:
                for f, kind in enumerate(forms := [*t.forms(), t.after_words()]):
                    starts, hashes = t.windows(length, kind)
                    for s, h in zip(starts.tolist(), hashes.view(np.int64).tolist()):
                        n = int(sizes[t.text[s]])
                        span = range(s, s + length)
                        if (min(window, n) == length and 2 * sum(kind[i] == 0 or t.kind[i] == 0 for i in span) >= length
                                and not _repeats(forms, f, span)):
                            rows.append((items[t.text[s]], n, int(t.place[s]), length, h,
                                         t.template(span, kind), [t.value(i) for i in span]))
            columns = list(zip(*rows)) if rows else [[]] * 7
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, (pa.int64(), pa.int32(), pa.int32(), pa.int32(),
                                                          pa.int64(), pa.list_(pa.string()),
                                                          pa.list_(pa.string())))],
                names=["item_id", "n_tokens", "item_at", "length", "hash", "template", "vals"])

    rows = (benchmark.select(F.col("item_id").cast("bigint").alias("item_id"), whole(F.col("text")).alias("text"))
            .where(F.col("item_id").isNotNull()))
    return rows.mapInArrow(gives_back(cut), "item_id bigint, n_tokens int, item_at int, length int, hash bigint, "
                                "template array<string>, vals array<string>")


def _hits(docs: DataFrame, lengths: list[int], hashes: np.ndarray) -> DataFrame:
    """Windows of documents whose hash is among ``hashes``."""
    known = np.sort(hashes.astype(np.int64).view(np.uint64))
    bits = max(16, int(len(known) * 16).bit_length())
    shared = docs.sparkSession.sparkContext.broadcast((known, bits))

    def search(batches):
        known, bits = shared.value
        mask = np.uint64((1 << bits) - 1)
        maybe = np.zeros(1 << bits, bool)
        maybe[(known & mask).astype(np.int64)] = True
        for batch in batches:
            for piece in _slices(batch, "text"):
                t, rows = Templates(piece.column("text")), []
                ids, texts = piece.column("doc_id"), piece.column("text_hash")
                forms = t.forms()
                for length, (f, kind) in itertools.product(lengths, enumerate(forms)):
                    starts, h = t.windows(length, kind)
                    likely = np.flatnonzero(maybe[(h & mask).astype(np.int64)])
                    place = np.minimum(np.searchsorted(known, h[likely]), len(known) - 1)
                    for j in likely[known[place] == h[likely]].tolist():
                        s = int(starts[j])
                        span, row = range(s, s + length), int(t.text[s])
                        if not _repeats(forms, f, span):
                            rows.append((ids[row].as_py(), texts[row].as_py(), int(t.place[s]),
                                         int(h[j].view(np.int64)), t.template(span, kind),
                                         [t.value(i) for i in span]))
                if rows:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, k) for c, k in zip(zip(*rows), (
                            pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.list_(pa.string()),
                            pa.list_(pa.string())))],
                        names=["doc_id", "text_hash", "doc_at", "hash", "template", "found"])

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64("text").alias("text_hash"),
                       whole(F.col("text")).alias("text"))
    return rows.mapInArrow(gives_back(search), "doc_id bigint, text_hash bigint, doc_at int, hash bigint, "
                                   "template array<string>, found array<string>")


def find(docs: DataFrame, benchmark: DataFrame, *, window: int = WINDOW,
         min_coverage: float = MIN_COVERAGE, min_run: int = MIN_RUN, block: int = BLOCK) -> DataFrame:
    """``doc_id, text_hash, item_id, n_tokens, n_covered, exact``: one row per
    document and item that contaminates it.  ``exact``: some alignment repeats all
    slot values as they are."""
    known = to_table(benchmark_windows(benchmark, window), "benchmark-windows")
    lengths = sorted(r["length"] for r in known.select("length").distinct().collect())
    n = known.select("hash").distinct().count()
    blocks = max(1, -(-n // block))
    found = None
    for b in range(blocks):
        part = known.select("hash").distinct().where(F.pmod(F.col("hash"), F.lit(blocks)) == b)
        hashes = part.toPandas()["hash"].to_numpy()
        if len(hashes):
            hit = _hits(docs, lengths, hashes)
            found = hit if found is None else found.unionByName(hit)
    if found is None:
        found = _hits(docs.limit(0), [], np.zeros(1))
    slots = F.filter(F.zip_with("template", F.arrays_zip("vals", "found"),
                                lambda t, v: F.when(t.isin(*PLACEHOLDERS), v)), lambda v: v.isNotNull())
    # the first word of an item, where it was given a type, is the same word
    same_first = ((F.col("item_at") > 0) | ~F.get("template", F.lit(0)).isin(*PLACEHOLDERS[1:])
                  | (F.get("vals", F.lit(0)) == F.get("found", F.lit(0))))
    aligned = (found.join(known, ["hash", "template"]).where(same_first)
               .select("doc_id", "text_hash", "item_id", "n_tokens", "item_at", "length",
                       (F.col("doc_at") - F.col("item_at")).alias("shift"), slots.alias("slots"))
               # at most one row per place of the item and form in each group
               .groupBy("doc_id", "text_hash", "item_id", "n_tokens", "shift")
               .agg(F.array_distinct(F.flatten(F.collect_list("slots"))).alias("slots"),
                    F.collect_list(F.struct("item_at", "length", (F.size("slots") == 0).alias("verbatim"))).alias("spans"))
               .withColumn("agree", F.size("slots") == F.size(F.array_distinct(F.transform("slots", lambda s: s["vals"]))))
               # slots that disagree leave what is verbatim
               .withColumn("spans", F.filter("spans", lambda s: F.col("agree") | s["verbatim"]))
               .withColumn("exact", F.forall("slots", lambda s: s["vals"] == s["found"])))
    tokens = F.array_sort(F.array_distinct(F.flatten(F.transform(
        "spans", lambda s: F.sequence(s["item_at"], s["item_at"] + s["length"] - 1)))))
    # token less rank is the same all along a run
    run = let(F.transform("tokens", lambda x, i: x - i), lambda d: F.array_max(F.transform(
        F.array_distinct(d), lambda v: F.size(F.filter(d, lambda x: x == v)))))
    return (aligned.withColumn("tokens", tokens).withColumn("run", run)
            .select("doc_id", "text_hash", "item_id", "n_tokens", "exact", "run", F.explode("tokens").alias("token"))
            .groupBy("doc_id", "text_hash", "item_id", "n_tokens", "token")
            .agg(F.max("exact").alias("exact"), F.max("run").alias("run"))
            .groupBy("doc_id", "text_hash", "item_id", "n_tokens")
            .agg(F.count("*").cast("int").alias("n_covered"), F.max("exact").alias("exact"), F.max("run").alias("run"))
            .where((F.col("n_covered") >= min_coverage * F.col("n_tokens")) | (F.col("run") >= min_run))
            .drop("run"))


def remove(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """``docs`` without the contaminated ones."""
    bad = to_table(find(docs, benchmark, **options).select("doc_id", "text_hash").distinct(), "contaminated")
    b = bad.select(F.col("doc_id").alias("_doc"), F.col("text_hash").alias("_hash"))
    plain, back = aside(docs, "doc_id", "text")
    return back(plain.join(b, F.col("doc_id").eqNullSafe(F.col("_doc"))
                           & (F.xxhash64("text") == F.col("_hash")), "left_anti"))


ships_by_value(__name__)
