"""Ranked lexical search for many queries at once, with shared term sets evaluated once.

Terms are maximal runs of ASCII letters, digits and non-ASCII characters, A-Z
lower-cased.  One pass over the documents writes, per document, its length and the
counts of the terms that any item asks for; N, L and the document frequencies
follow from that table.

A score is a sum over the item's terms, repeats included, so any split of the term
multiset into disjoint sets gives the same score.  :class:`SharingPlan` mines the
sets that items share: terms that occur in exactly the same items form one node;
then the two nodes that most items still hold side by side become a node of their
own, again and again, while at least two items gain.  The nodes and their children
form a DAG.  For a slice of documents every node's partial accumulator is computed
once, from its terms or as the sum of its two children, and each item adds up the
few nodes it is left with.

Every document with a positive score takes part; tasks keep the best ``k`` of each
item and the final ranking is over those.  Items are handled in blocks of about
``BLOCK_BYTES`` of text (split by a hash), which bounds the terms and plans that are
sent to the executors; documents are read once per block.

Null and empty texts have no terms: such documents count in neither N nor L, such
items have no rows.  Equal scores are ordered by ascending ``doc_id``, a null one
first.  Each row of the documents is a document, also where id and text repeat.
Items that repeat id and text are one; an id with several texts is ranked for each.
Extra columns of both tables are not read; an empty table gives no rows.
"""

from __future__ import annotations

import heapq
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import ships_by_value, to_table, whole

ships_by_value(__name__)

TERM = "[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+"
TOP = 20
BLOCK_BYTES = 4 << 20
PIECE = 1 << 20                  # bytes of a long text that are split at a time
MINED_NODES = 64                 # nodes of one item that are looked at for pairs; bounds work, not results
CELLS = 1 << 22                  # of the items x documents matrix of one slice

#: A-Z to a-z, all other ASCII characters that end a term to spaces.
_TABLE = bytes(b if b >= 0x80 or chr(b).isalnum() else 0x20 for b in range(256)).lower()


def terms_of(data: bytes) -> Iterator[list[bytes]]:
    """The terms of UTF-8 bytes, in lists of bounded size."""
    start = 0
    while start < len(data):
        end = start + PIECE
        while end < len(data) and _TABLE[data[end]] != 0x20:
            end += 1
        yield data[start:end].translate(_TABLE).split()
        start = end


class SharingPlan:
    """Which term sets are summed up once, and what each item adds up.

    ``own[t]`` lists ``(item, times)`` for terms only one item adds; ``atoms[t]``
    lists ``(node, times)`` for terms of shared sets; ``nodes[i]`` is the pair of
    children of node ``i`` (None for a set of terms); ``items_of[i]`` are the items
    that add node ``i`` itself."""

    def __init__(self, items: list[Counter]):
        holders = defaultdict(list)        # the j-th repeat of a term is a symbol of its own
        for item, counts in enumerate(items):
            for term, times in counts.items():
                for j in range(times):
                    holders[term, j].append(item)
        sets = defaultdict(Counter)
        for (term, _), held in holders.items():
            sets[tuple(held)][term] += 1
        self.own, self.atoms = defaultdict(list), defaultdict(list)
        self.nodes: list[tuple[int, int] | None] = []
        self.items_of: list[set[int]] = []
        for held, counts in sorted(sets.items()):
            if len(held) == 1:
                for term, times in counts.items():
                    self.own[term].append((held[0], times))
                continue
            for term, times in counts.items():
                self.atoms[term].append((len(self.nodes), times))
            self.nodes.append(None)
            self.items_of.append(set(held))
        self._mine(len(items))

    def _mine(self, n_items: int) -> None:
        held = [set() for _ in range(n_items)]
        for node, members in enumerate(self.items_of):
            for item in members:
                held[item].add(node)
        pairs = Counter()
        for nodes in held:
            most = sorted(nodes, key=lambda x: (-len(self.items_of[x]), x))[:MINED_NODES]
            pairs.update((min(a, b), max(a, b)) for i, a in enumerate(most) for b in most[:i])
        heap = [(-n, pair) for pair, n in pairs.items() if n > 1]
        heapq.heapify(heap)
        while heap:
            n, (a, b) = heapq.heappop(heap)
            both = self.items_of[a] & self.items_of[b]
            if len(both) < 2:
                continue
            if len(both) < -n:              # counted before other pairs were merged
                heapq.heappush(heap, (-len(both), (a, b)))
                continue
            new = len(self.nodes)
            self.nodes.append((a, b))
            self.items_of.append(both)
            self.items_of[a] = self.items_of[a] - both
            self.items_of[b] = self.items_of[b] - both
            beside = Counter()
            for item in both:
                held[item] -= {a, b}
                beside.update(held[item])
                held[item].add(new)
            for other, count in beside.items():
                if count > 1:
                    heapq.heappush(heap, (-count, (other, new)))

    def additions(self) -> int:
        """Vector additions of a slice that the plan needs between sets and items."""
        return sum(x is not None for x in self.nodes) + sum(map(len, self.items_of))


def _postings_of(vocabulary):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = vocabulary.value
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1)
            rows, lengths, sizes, terms, times = [], [], [], [], []
            for i in range(len(batch)):
                counts, n = Counter(), 0
                for piece in terms_of(texts[i].as_py()):
                    n += len(piece)
                    counts.update(piece)
                if n:
                    found = [(index[t], c) for t, c in counts.items() if t in index]
                    rows.append(i)
                    lengths.append(n)
                    sizes.append(len(found))
                    terms.extend(t for t, _ in found)
                    times.extend(c for _, c in found)
            offsets = pa.array(np.concatenate(([0], np.cumsum(sizes, dtype=np.int64))), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [ids.take(pa.array(rows, pa.int64())), pa.array(lengths, pa.int64()),
                 pa.ListArray.from_arrays(offsets, pa.array(terms, pa.int32())),
                 pa.ListArray.from_arrays(offsets, pa.array(times, pa.int64()))], ["doc_id", "n", "terms", "times"])
    return run


def postings(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """``doc_id, n, terms, times`` of every document that has a term."""
    sent = docs.sparkSession.sparkContext.broadcast(vocabulary)
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), whole(F.col("text")).cast("binary").alias("text"))
    return to_table(rows.mapInArrow(_postings_of(sent), "doc_id bigint, n bigint, terms array<int>, times array<bigint>"),
                    "search-postings")


class _Best:
    """The ``k`` best documents of every item so far."""

    def __init__(self, n_items: int, k: int):
        self.k, self.floor = k, np.ones(n_items, np.int64)
        self.rows = [np.empty(0, np.int64)] * 4       # item, score, id is known, id
        self.limit = 4 * k * n_items + 65_536

    def add(self, scores: np.ndarray, known: np.ndarray, ids: np.ndarray) -> None:
        item, doc = np.nonzero(scores >= self.floor[:, None])
        new = item, scores[item, doc], known[doc], ids[doc]
        self.rows = [np.concatenate(x) for x in zip(self.rows, new)]
        if len(self.rows[0]) > self.limit:
            self.prune()

    def prune(self) -> None:
        item, score, known, ids = self.rows
        order = np.lexsort((ids, known, -score, item))
        item = item[order]
        place = np.arange(len(item)) - np.searchsorted(item, item)
        order = order[place < self.k]
        self.rows = [x[order] for x in self.rows]
        last = self.rows[0][place[place < self.k] == self.k - 1]
        self.floor[last] = np.maximum(1, self.rows[1][place[place < self.k] == self.k - 1])


def accumulate(plan: SharingPlan, docs: int, of_term: dict[int, tuple[np.ndarray, np.ndarray]],
               n_items: int) -> np.ndarray:
    """Scores (items x documents of a slice); ``of_term`` has the documents and
    contributions of each term."""
    scores = np.zeros((n_items, docs), np.int64)
    partial: dict[int, np.ndarray] = {}
    for term, (at, gain) in of_term.items():
        for item, times in plan.own.get(term, ()):
            scores[item, at] += gain * times
        for node, times in plan.atoms.get(term, ()):
            if node not in partial:
                partial[node] = np.zeros(docs, np.int64)
            partial[node][at] += gain * times
    for node, children in enumerate(plan.nodes):
        if children is not None:
            present = [partial[c] for c in children if c in partial]
            if present:
                partial[node] = present[0] + present[1] if len(present) == 2 else present[0]
    for node, value in partial.items():
        for item in plan.items_of[node]:
            scores[item] += value
    return scores


def _score(plan_sent, weights, n_docs: int, n_terms: int, item_ids: list, k: int, id_type: pa.DataType):
    n_items = len(item_ids)
    step = max(64, min(4096, CELLS // max(1, n_items)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plan, weight = plan_sent.value, weights
        best = _Best(n_items, k)
        for batch in batches:
            for start in range(0, len(batch), step):
                part = batch.slice(start, step)
                ids = part.column(0)
                known = ids.is_valid().to_numpy(zero_copy_only=False).astype(np.int64)
                n = part.column(1).to_numpy()
                lists = part.column(2)
                sizes = lists.value_lengths().to_numpy()
                term = lists.flatten().to_numpy()
                tf = part.column(3).flatten().to_numpy()
                doc = np.repeat(np.arange(len(n)), sizes)
                m = 100 - 25 + (25 * n * n_docs) // n_terms
                gain = weight[term] * ((1_000_000_000 * tf) // (1000 * tf + 12 * m[doc]))
                order = np.argsort(term, kind="stable")
                term, doc, gain = term[order], doc[order], gain[order]
                cuts = np.flatnonzero(np.diff(term, prepend=-1))
                ends = np.append(cuts[1:], len(term))
                of_term = {int(term[a]): (doc[a:b], gain[a:b]) for a, b in zip(cuts, ends)}
                best.add(accumulate(plan, len(n), of_term, n_items), known, ids.fill_null(0).to_numpy())
        best.prune()
        item, score, known, ids = best.rows
        yield pa.RecordBatch.from_arrays(
            [pa.array(item.astype(np.int32)), pa.array([item_ids[i] for i in item], id_type),
             pa.array(ids, mask=known == 0), pa.array(score)], ["item", "item_id", "doc_id", "score"])
    return run


def _rank_block(docs: DataFrame, items: DataFrame, k: int) -> DataFrame:
    from pyspark.sql.pandas.types import to_arrow_type

    spark = docs.sparkSession
    kind = items.schema["item_id"].dataType
    vocabulary: dict[bytes, int] = {}
    rows, counts = items.select("item_id", F.col("text").cast("binary")).collect(), []
    for _, text in rows:
        counted = Counter()
        for piece in terms_of(bytes(text)):
            counted.update(vocabulary.setdefault(t, len(vocabulary)) for t in piece)
        counts.append(counted)
    posted = postings(docs, vocabulary)
    n_docs, n_terms = posted.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    df = posted.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("df"))
    weight = np.zeros(max(1, len(vocabulary)), np.int64)
    for term, w in df.select("term", F.floor(1000 * F.ln(F.lit(2.0 * n_docs + 2) / (2 * F.col("df") + 1)))).collect():
        weight[term] = w
    sent = spark.sparkContext.broadcast(SharingPlan(counts))
    found = posted.mapInArrow(
        _score(sent, weight, n_docs, max(1, n_terms), [r[0] for r in rows], k, to_arrow_type(kind)),
        f"item int, item_id {kind.simpleString()}, doc_id bigint, score bigint")
    best = Window.partitionBy("item").orderBy(F.desc("score"), F.asc("doc_id"))
    return (found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
            .select("item_id", "rank", "doc_id", "score"))


def rank(docs: DataFrame, items: DataFrame, *, k: int = TOP) -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``k`` best documents of every item."""
    # read once per block, and twice here
    asked = to_table(items.select("item_id", whole(F.col("text")).alias("text")).distinct(), "search-items")
    size = asked.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    blocks = max(1, -(-size // BLOCK_BYTES))
    out = None
    for block in range(blocks):
        found = _rank_block(docs, asked.where(F.pmod(F.xxhash64("text"), F.lit(blocks)) == block), k)
        out = found if out is None else out.unionByName(found)
    return out
