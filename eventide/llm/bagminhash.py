"""Near-duplicate documents by BagMinHash signatures.

A text is the bag of its five-word shingles (words in lower case without outer
punctuation; a text of fewer words is one shingle).  Two texts are linked if the
weighted Jaccard similarity of their bags is at least ``SIMILARITY``; classes are
the connected components of the links.

Signature.  The weight of a shingle is its count.  The weight axis is cut into
layers (0,1], (1,2], (2,4], (4,8], ...; every shingle has a Poisson process on each
layer below its count.  A point has a time, a height in the layer and a signature
component, all hashed from shingle, layer and number, and counts if its height is
below the weight.  The earliest counted point of each component is the signature;
two bags agree in a component with probability equal to their weighted Jaccard
similarity.  Points are generated in order of time up to a limit; texts for which
a component stayed empty are done again with twice the limit.

Search.  Equal texts are one node.  Signatures are cut into ``BANDS`` bands of
``ROWS``; nodes with an equal band share a bucket.  A bucket's members are compared
with its leader, the member that shares most buckets with others (in a group of
copies of one text, that text), never all with all.  With more ``ROUNDS``, members
then meet the leaders of the bucket's other classes, one leader a round.  What is
left, members whose class has not led, is compared exactly, in blocks: these
members against all members of the bucket in other classes, first by signature,
then by text, each pair in its smallest common bucket only; nothing but links
leaves a block.  Every candidate is verified on the bags themselves.

Equal texts (null and empty ones too) are one class, whose id is its smallest
document id; texts without words are linked to equal ones only.  Repeated rows
are equal texts.  Documents without an id belong to classes like others; a class
without any id has a null class id.  Extra columns are not read by ``classes`` and
pass through ``deduplicate``.  Empty tables give no rows.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import aside, gives_back, ships_by_value, to_table, whole
from .records import _slices

SHINGLE, SIMILARITY = 5, 0.8
BANDS, ROWS = 30, 5
SIZE = BANDS * ROWS
ROUNDS, BLOCK = 1, 512
#: Candidates whose bags are made at a time.
FILL = 64
PUNCTUATION = ".,;:!?\"'()[]{}<>|*#%&$-_=+/\\`~^@…–—“”‘’«»¿¡"


def _mix(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser (splitmix)."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _seeded(x: np.ndarray, *seeds: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        for s in seeds:
            x = _mix(x + np.uint64((0x9E3779B97F4A7C15 * (s + 1)) & (2**64 - 1)))
    return x


def _unit(x: np.ndarray) -> np.ndarray:
    """In (0, 1]."""
    return ((x >> np.uint64(11)).astype(np.float64) + 1) * 2.0**-53


def shingles(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingles of each text: text number, hash, count (sorted)."""
    split = pc.ascii_split_whitespace(texts)
    coded = split.flatten().dictionary_encode()
    bare = pc.utf8_lower(pc.utf8_trim(coded.dictionary, characters=PUNCTUATION))
    names = bare.to_numpy(zero_copy_only=False).astype(object)
    if not len(names):
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64)
    use = coded.indices.to_numpy(zero_copy_only=False)
    keep = (names != "")[use]
    code = pd.util.hash_array(names, categorize=False)[use[keep]]
    text = np.repeat(np.arange(len(texts)), np.diff(split.offsets.to_numpy()))[keep]
    size = np.bincount(text, minlength=len(texts))
    start = np.cumsum(size) - size
    # h[i] covers the words i ... i+4 of a text, or up to its end
    h, n = np.full(len(code), SHINGLE, np.uint64), len(code)
    place = np.arange(n) - start[text]
    for i in range(SHINGLE):
        inside = np.flatnonzero(place + i < size[text])
        h[inside] = _seeded(h[inside] + code[inside + i], i)
    is_start = place <= np.maximum(size[text] - SHINGLE, 0)
    h, text = h[is_start], text[is_start]
    order = np.lexsort((h, text))
    h, text = h[order], text[order]
    first = np.ones(len(h), bool)
    first[1:] = (h[1:] != h[:-1]) | (text[1:] != text[:-1])
    at = np.flatnonzero(first)
    return text[at], h[at], np.diff(np.append(at, len(h)))


def signatures(texts: pa.Array, size: int = SIZE) -> np.ndarray:
    """One row of point times per text; infinite for texts without words."""
    owner, h, count = shingles(texts)
    total = np.bincount(owner, count, minlength=len(texts))
    out = np.full((len(texts), size), np.inf)
    limit = np.where(total > 0, size * (np.log(size) + 4) / np.maximum(total, 1), 0.0)
    todo = total > 0
    while todo.any():
        mine = todo[owner]
        out[todo] = np.inf
        _points(out, owner[mine], h[mine], count[mine], limit)
        todo &= np.isinf(out).any(axis=1)
        limit *= 2
    return out


def _points(out: np.ndarray, owner: np.ndarray, h: np.ndarray, count: np.ndarray,
            limit: np.ndarray) -> None:
    """Lower ``out`` to the earliest counted points before the time limits."""
    size, flat = out.shape[1], out.reshape(-1)
    layer, below, width = 0, 0, 1
    while len(h):
        o, x, c = owner, _seeded(h, layer), count
        t, number = np.zeros(len(x)), 0
        while len(x):
            r = _seeded(x, number)
            t = t - np.log(_unit(r)) / width
            alive = t <= limit[o]
            if not alive.all():
                o, x, c, t, r = o[alive], x[alive], c[alive], t[alive], r[alive]
            r2 = _mix(r + np.uint64(0x632BE59BD9B4E019))
            height = below + 1 + (r2 >> np.uint64(32)).astype(np.int64) * width // (1 << 32)
            at = o * size + ((r2 & np.uint64(0xFFFFFFFF)) * np.uint64(size) >> np.uint64(32)).astype(np.int64)
            counted = height <= c
            np.minimum.at(flat, at[counted], t[counted])
            number += 1
        below, width, layer = below + width, (width if layer == 0 else width * 2), layer + 1
        more = count > below
        owner, h, count = owner[more], h[more], count[more]


def _prints(times: np.ndarray) -> np.ndarray:
    """Two-byte fingerprints of signature components."""
    return (_mix(times.view(np.uint64)) >> np.uint64(48)).astype("<u2")


def _band_keys(times: np.ndarray) -> np.ndarray:
    bits, keys = _mix(times.view(np.uint64)), []
    for b in range(BANDS):
        k = np.full(len(times), b, np.uint64)
        for i in range(b * ROWS, (b + 1) * ROWS):
            k = _seeded(k + bits[:, i], i)
        keys.append(k)
    return np.stack(keys, axis=1).view(np.int64)


def similarity(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Weighted Jaccard similarity of two bags ``(sorted hashes, counts)``."""
    total = int(a[1].sum() + b[1].sum())
    place = np.searchsorted(a[0], b[0])
    place[place == len(a[0])] = 0
    same = a[0][place] == b[0] if len(a[0]) else np.zeros(len(b[0]), bool)
    common = int(np.minimum(a[1][place[same]], b[1][same]).sum()) if same.any() else 0
    return common / (total - common) if total else 0.0


def _bags(texts: pa.Array) -> list[tuple[np.ndarray, np.ndarray]]:
    owner, h, count = shingles(texts)
    bounds = np.searchsorted(owner, np.arange(len(texts) + 1))
    return [(h[i:j], count[i:j]) for i, j in zip(bounds[:-1], bounds[1:])]


def _key():
    return F.unhex(F.md5(whole(F.col("text"))))


def sign(docs: DataFrame) -> DataFrame:
    """``key, doc_id, n, prints, bands`` per distinct text: digest, smallest id, rows,
    signature fingerprints, band keys (null without words)."""
    def run(batches):
        for batch in batches:
            for piece in _slices(batch, "text"):
                times = signatures(piece.column("text"))
                some = ~np.isinf(times).any(axis=1)
                prints, bands = _prints(times), _band_keys(times)
                yield pa.RecordBatch.from_arrays(
                    [piece.column("key"), piece.column("doc_id"),
                     pa.array([p.tobytes() if s else None for p, s in zip(prints, some)], pa.binary()),
                     pa.array([k.tobytes() if s else None for k, s in zip(bands, some)], pa.binary())],
                    names=["key", "doc_id", "prints", "bands"])

    rows = docs.select(_key().alias("key"), F.col("doc_id").cast("bigint").alias("doc_id"),
                       whole(F.col("text")).alias("text"))
    return (rows.mapInArrow(gives_back(run), "key binary, doc_id bigint, prints binary, bands binary")
            .groupBy("key").agg(F.min("doc_id").alias("doc_id"), F.count("*").alias("n"),
                                F.first("prints").alias("prints"), F.first("bands").alias("bands")))


def _buckets(signed: DataFrame) -> DataFrame:
    """``bucket, key`` for all buckets of two or more nodes."""
    def run(batches):
        for batch in batches:
            for piece in (batch.slice(i, 1024) for i in range(0, batch.num_rows, 1024)):
                keys = np.frombuffer(b"".join(piece.column("bands").to_pylist()), np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys), piece.column("key").take(pa.array(np.repeat(np.arange(piece.num_rows), BANDS)))],
                    names=["bucket", "key"])

    rows = (signed.where(F.col("bands").isNotNull()).select("key", "bands")
            .mapInArrow(gives_back(run), "bucket bigint, key binary"))
    shared = rows.groupBy("bucket").agg(F.count("*").alias("size")).where("size > 1")
    return rows.join(shared, "bucket")


def _verified(pairs: DataFrame, texts: DataFrame, similar: float) -> DataFrame:
    """The pairs ``a, b`` of nodes whose bags are similar enough."""
    def run(batches):
        for batch in batches:
            for piece in _slices(batch, "text_a"):
                a, b = _bags(piece.column("text_a")), _bags(piece.column("text_b"))
                good = pa.array([similarity(x, y) >= similar for x, y in zip(a, b)], pa.bool_())
                yield piece.select(["a", "b"]).filter(good)

    ta = texts.select(F.col("key").alias("a"), F.col("text").alias("text_a"))
    tb = texts.select(F.col("key").alias("b"), F.col("text").alias("text_b"))
    return (pairs.join(ta, "a").join(tb, "b").select("a", "b", "text_a", "text_b")
            .mapInArrow(gives_back(run), "a binary, b binary"))


def components(edges: DataFrame) -> DataFrame:
    """``key, label``: the smallest key of each connected component, by label
    propagation with pointer jumping; every round is a written table."""
    both = to_table(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
                    .distinct(), "links")
    labels = to_table(both.groupBy("a").agg(F.min("b").alias("m"))
                      .select(F.col("a").alias("key"), F.least("a", "m").alias("label")), "labels")
    while True:
        lower = (both.join(labels.select(F.col("key").alias("b"), "label"), "b")
                 .groupBy("a").agg(F.min("label").alias("near")))
        stepped = (labels.join(lower.withColumnRenamed("a", "key"), "key")
                   .select("key", F.col("label").alias("old"), F.least("label", "near").alias("label")))
        jumped = (stepped.alias("s").join(labels.select(F.col("key").alias("k"), F.col("label").alias("far")).alias("l"),
                                          F.col("s.label") == F.col("l.k"), "left")
                  .select("s.key", "old", F.least("s.label", F.coalesce("far", F.col("s.label"))).alias("label")))
        new = to_table(jumped, "labels")
        if new.where(F.col("old") != F.col("label")).isEmpty():
            return new.select("key", "label")
        labels = new.select("key", "label")


def _next_leaders(state: DataFrame, met: DataFrame | None) -> DataFrame:
    """``bucket, lead``: the heaviest member of each bucket whose class has not led
    there yet; no row for buckets where all classes have."""
    waiting = state
    if met is not None:
        led = (state.join(met.withColumnRenamed("lead", "key"), ["bucket", "key"]).select("bucket", "label").distinct())
        waiting = state.join(led, ["bucket", "label"], "left_anti")
    return (waiting.groupBy("bucket").agg(F.max(F.struct("weight", "key")).alias("lead"))
            .select("bucket", F.col("lead.key").alias("lead")))


def _block_links(state: DataFrame, left: DataFrame, signed: DataFrame, texts: DataFrame, similar: float,
                 block: int) -> DataFrame:
    """Links between waiting members (``left``) and members of other classes of their
    buckets.  Both sides are cut into blocks by a hash of the key; a task sees one
    block of each.  Pairs are compared in their smallest common bucket only."""
    def compare(pdf: pd.DataFrame) -> pd.DataFrame:
        bucket = pdf["bucket"].iloc[0]
        mine = np.flatnonzero(pdf["waiting"].to_numpy())
        rest = np.flatnonzero(~pdf["waiting"].to_numpy())
        prints = np.stack([np.frombuffer(x, "<u2") for x in pdf["prints"]])
        bands = np.stack([np.frombuffer(x, np.int64) for x in pdf["bands"]])
        need = SIZE * (similar - 4 * (similar * (1 - similar) / SIZE) ** 0.5)
        keys, labels, bags = pdf["key"].tolist(), pdf["label"].tolist(), {}
        parent: dict[bytes, bytes] = {}

        def root(x):
            while parent.get(x, x) != x:
                x = parent[x]
            return x

        def fill(places: list[int]) -> None:
            # bags of candidates only, a slice of texts at a time
            new = [k for k in places if k not in bags]
            if new:
                for piece in _slices(pa.RecordBatch.from_arrays(
                        [pa.array(new), pa.array(pdf["text"].iloc[new], pa.string())], ["k", "text"]), "text"):
                    bags.update(zip(piece.column("k").to_pylist(), _bags(piece.column("text"))))

        found, other_prints, other_bands = [], prints[rest], bands[rest]
        for i in mine:
            # the smallest bucket that both are in compares them, the others do not
            first = np.where(other_bands == bands[i], bands[i], np.iinfo(np.int64).max).min(axis=1) == bucket
            first[first] = (other_prints[first] == prints[i]).sum(axis=1) >= need
            candidates = rest[first].tolist()
            if any(root(labels[j]) != root(labels[i]) for j in candidates):
                fill([i])
            for at, j in enumerate(candidates):
                x, y = root(labels[i]), root(labels[j])
                if x == y:
                    continue
                if j not in bags:
                    fill(candidates[at:at + FILL])
                if similarity(bags[i], bags[j]) >= similar:
                    parent[x] = y
                    found.append((min(keys[i], keys[j]), max(keys[i], keys[j])))
        return pd.DataFrame(found, columns=["a", "b"])

    count = left.groupBy("bucket").agg(F.count("*").alias("n_left"))
    sized = count.join(state.groupBy("bucket").agg(F.count("*").alias("n_all")), "bucket").select(
        "bucket", F.ceil(F.col("n_left") / block).cast("int").alias("n_left"),
        F.ceil(F.col("n_all") / block).cast("int").alias("n_all"))

    def dealt(rows: DataFrame, own: str, other: str, waiting: bool) -> DataFrame:
        at = F.pmod(F.xxhash64("key"), F.col(own)).cast("int")
        each = F.explode(F.sequence(F.lit(0), F.col(other) - 1))
        names = ("u", "m") if waiting else ("m", "u")
        return (rows.join(sized, "bucket")
                .select("bucket", "key", "label", F.lit(waiting).alias("waiting"), at.alias(names[0]), each.alias(names[1]))
                .select("bucket", "key", "label", "waiting", "u", "m"))

    rows = dealt(left, "n_left", "n_all", True).unionByName(dealt(state, "n_all", "n_left", False))
    return (rows.join(signed.select("key", "prints", "bands"), "key").join(texts, "key")
            .groupBy("bucket", "u", "m").applyInPandas(compare, "a binary, b binary").distinct())


def links(docs: DataFrame, signed: DataFrame, *, similar: float = SIMILARITY, rounds: int = ROUNDS,
          block: int = BLOCK) -> DataFrame | None:
    """Component label of every node that has links (None: there are none)."""
    buckets = to_table(_buckets(signed), "buckets")
    weight = buckets.groupBy("key").agg(F.sum("size").alias("weight"))
    members = to_table(buckets.join(weight, "key").select("bucket", "key", "weight"), "members")
    # texts of bucketed nodes only, one row per node
    texts = to_table(docs.select(_key().alias("key"), whole(F.col("text")).alias("text"))
                     .join(members.select("key").distinct(), "key", "left_semi")
                     .groupBy("key").agg(F.first("text").alias("text")), "texts")
    edges = labels = met = None

    def state() -> DataFrame:
        if labels is None:
            return members.withColumn("label", F.col("key"))
        return members.join(labels, "key", "left").withColumn("label", F.coalesce("label", "key"))

    def add(found: DataFrame) -> None:
        nonlocal edges, labels
        if not found.isEmpty():
            edges = found if edges is None else edges.unionByName(found)
            labels = components(edges)

    for _ in range(rounds):
        now = to_table(state(), "state")
        lead = to_table(_next_leaders(now, met), "leaders")
        if lead.isEmpty():
            return labels
        heads = lead.join(now.select("bucket", F.col("key").alias("lead"), F.col("label").alias("lead_label")),
                          ["bucket", "lead"])
        pairs = (now.join(heads, "bucket").where(F.col("label") != F.col("lead_label"))
                 .select(F.least("key", "lead").alias("a"), F.greatest("key", "lead").alias("b")).distinct())
        add(to_table(_verified(to_table(pairs, "pairs"), texts, similar), "edges"))
        met = lead if met is None else met.unionByName(lead)
    now = to_table(state(), "state")
    led = now.join(met.withColumnRenamed("lead", "key"), ["bucket", "key"]).select("bucket", "label").distinct()
    left = to_table(now.join(led, ["bucket", "label"], "left_anti").select("bucket", "key", "label"), "waiting")
    if not left.isEmpty():
        touched = now.select("bucket", "key", "label").join(left.select("bucket").distinct(), "bucket", "left_semi")
        add(to_table(_block_links(touched, left, signed, texts, similar, block), "edges"))
    return labels


def _nodes(docs: DataFrame, **options) -> DataFrame:
    """``key, first``: every distinct text and the first member of its class, a struct
    ``(no_id, doc_id, key)`` of the smallest id (texts without id come last)."""
    signed = to_table(sign(docs), "signatures")
    labels = links(docs, signed, **options)
    first = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "key")
    ids = signed.select("key", "doc_id", F.col("key").alias("label"), first.alias("first"))
    if labels is not None:
        named = ids.drop("label").join(labels, "key", "left").withColumn("label", F.coalesce("label", "key"))
        least = named.groupBy("label").agg(F.min("first").alias("first"))
        ids = named.drop("first").join(least, "label")
    return to_table(ids.select("key", "first"), "classes")


def classes(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with ``class_id``: one row per document."""
    plain, back = aside(docs, "doc_id", "text", made=("class_id",))
    nodes = _nodes(docs, **options).select(F.col("key").alias("_key"), F.col("first.doc_id").alias("class_id"))
    return back(plain.withColumn("_key", _key()).join(nodes, "_key").select(*plain.columns, "class_id"))


def deduplicate(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with one row of each class: the first member.  The join is on id and
    text, so a hot group of copies, of which one row stays, meets in no task."""
    stay = (_nodes(docs, **options).where(F.col("key") == F.col("first.key"))
            .select(F.col("first.doc_id").alias("_id"), F.col("key").alias("_key")))
    plain, back = aside(docs, "doc_id", "text")
    rows = plain.withColumn("_k", _key())
    return back(rows.join(stay, (F.col("doc_id").cast("bigint")).eqNullSafe(F.col("_id")) & (F.col("_k") == F.col("_key")))
                .dropDuplicates(["_id", "_key"]).select(*plain.columns))


ships_by_value(__name__)
