"""Ranked lexical search: the best documents of every item, by branch and bound over document FP-trees.

Terms are runs of letters, digits and non-ASCII characters, lower-cased (A-Z only). A document's score for an item is the sum,
over the item's distinct terms, of w * ((10^9 tf) div (1000 tf + 8 m)): w falls with the term's document frequency, m grows with
the document's length over the mean (exact 64-bit integers; only w's logarithm is taken in doubles).

1. *Restricted vectors.* One pass over the documents keeps of each its number of terms and, of the items' vocabulary, its terms
   with their frequencies. These short vectors are staged; document counts and frequencies come from them, over all documents.
2. *FP-tree.* A task takes a chunk of vectors at a time. For an item, the vectors, projected on the item's terms in order of falling
   document frequency, are sorted; equal beginnings share a path, so a node is a stretch of documents. It keeps the largest tf
   of its term and the least m among these. What its own term can add at most follows, and from the leaves up what
   any path below can add.
3. *Branch and bound.* A depth-first walk takes the most promising child first and leaves a subtree whose bound is below the item's
   k-th best score so far (which carries over from chunk to chunk); stretches of few documents are scored at once.
   Every task returns k documents an item at most; the best of these are taken in two steps.

Items are handled in blocks of ``BLOCK_BYTES`` of text at most, so what is broadcast is bounded; a block reads the documents once.
A word is a term of the vocabulary only if its bytes are equal (hashes find it, bytes decide).

Defined results: null and empty texts have no terms, match nothing and don't count as documents; documents that share no term with an
item aren't listed; equal scores are ordered by id, null ids last; repeated document rows are listed each; repeated items (same
id and text) are one item, other texts under an id are items of their own (``item_hash`` tells them apart); null item
ids are kept; texts of any length are read whole; an empty table on either side gives an empty result; extra columns are
ignored.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from plotwise.llm.tables import stage
from plotwise.llm.text import ALNUM, LOWER, buffer, bytes_hashes, slices, word_spans, words_array

#: Text of the items of a block, in bytes.
BLOCK_BYTES = 8 << 20
#: Documents, and entries of their vectors, of a chunk.
CHUNK_DOCS, CHUNK_ENTRIES = 32_768, 4_000_000
#: Documents of a stretch that is scored at once.
LEAF = 256
#: Parts that an item's candidates are ranked in before they meet.
PARTS = 64
_LAST = 2**63 - 1


class Vocabulary:
    """Distinct terms, found by hash and compared by bytes."""

    def __init__(self, terms: pa.Array):
        h = bytes_hashes(terms)
        order = np.argsort(h, kind="stable")
        self.hashes, self.terms = h[order], terms.take(pa.array(order))

    def __len__(self):
        return len(self.hashes)

    def place(self, terms: pa.Array) -> np.ndarray:
        """Number of every term; -1: not among them."""
        h = bytes_hashes(terms)
        out = np.full(len(h), -1, np.int64)
        if not len(self.hashes):
            return out
        k = np.minimum(np.searchsorted(self.hashes, h), len(self.hashes) - 1)
        todo = np.flatnonzero(self.hashes[k] == h)
        while len(todo):  # terms of one hash stand side by side
            same = pc.equal(self.terms.take(pa.array(k[todo])), terms.take(pa.array(todo))).to_numpy(zero_copy_only=False)
            out[todo[same]] = k[todo[same]]
            todo = todo[~same]
            k[todo] += 1
            todo = todo[k[todo] < len(self.hashes)]
            todo = todo[self.hashes[k[todo]] == h[todo]]
        return out


def _terms(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Distinct terms of a slice; the number of each occurrence's term, and its row."""
    buf, off = buffer(texts)
    low = LOWER[buf]
    start, end, row = word_spans(low, off, ALNUM)
    coded = words_array(low, start, end, ALNUM).dictionary_encode()
    return coded.dictionary, coded.indices.to_numpy().astype(np.int64), row


def _vector_rows(vocabulary):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = vocabulary.value
        for b in slices(batches):
            distinct, which, row = _terms(b.column("text"))
            n = np.bincount(row, minlength=b.num_rows)
            term = vocab.place(distinct)[which]
            use = term >= 0
            key, tf = np.unique(row[use] * len(vocab) + term[use], return_counts=True)
            of, term = key // max(len(vocab), 1), key % max(len(vocab), 1)
            off = pa.array(np.searchsorted(of, np.arange(b.num_rows + 1)), pa.int32())
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(n, pa.int64()), pa.ListArray.from_arrays(off, pa.array(term, pa.int32())), pa.ListArray.from_arrays(off, pa.array(tf, pa.int64()))],
                                             ["doc_id", "n", "terms", "tfs"])

    return rows


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def saturation(tf, m):
    """What an occurrence count is worth in a document of relative length m."""
    return 1_000_000_000 * tf // (1000 * tf + 8 * m)


@dataclass
class Item:
    """Terms by falling document frequency, with their weights."""
    terms: np.ndarray
    weights: np.ndarray


class Best:
    """The k best (score, document id) so far; smaller ids win ties."""

    def __init__(self, k: int):
        self.k, self.heap = k, []

    def floor(self) -> int:
        """Scores below it are of no use."""
        return self.heap[0][0] if len(self.heap) == self.k else 1

    def add(self, scores: np.ndarray, docs: np.ndarray) -> None:
        use = np.flatnonzero(scores >= self.floor())
        if len(use) > self.k:
            use = use[np.lexsort((docs[use], -scores[use]))[: self.k]]
        for s, d in zip(scores[use].tolist(), docs[use].tolist(), strict=True):
            if len(self.heap) < self.k:
                heapq.heappush(self.heap, (s, -d))
            elif (s, -d) > self.heap[0]:
                heapq.heapreplace(self.heap, (s, -d))


class Chunk:
    """Vectors of some documents, and for every term the documents that hold it."""

    def __init__(self, docs: np.ndarray, m: np.ndarray, row: np.ndarray, term: np.ndarray, tf: np.ndarray):
        self.docs, self.m = docs, m
        order = np.argsort(term, kind="stable")
        self.row, self.tf, term = row[order], tf[order], term[order]
        self.known = np.unique(term)
        self.first = np.concatenate([np.searchsorted(term, self.known), [len(term)]])

    def holders(self, term: int) -> tuple[np.ndarray, np.ndarray]:
        k = int(np.searchsorted(self.known, term))
        if k == len(self.known) or self.known[k] != term:
            return self.row[:0], self.tf[:0]
        return self.row[self.first[k] : self.first[k + 1]], self.tf[self.first[k] : self.first[k + 1]]


class Tree:
    """The FP-tree of a chunk's documents for one item: nodes are stretches [low, high) of the sorted documents."""

    def __init__(self, chunk: Chunk, item: Item):
        held = [(j, *chunk.holders(t)) for j, t in enumerate(item.terms.tolist())]
        held = [(j, rows, tf) for j, rows, tf in held if len(rows)]
        self.weights = item.weights[[j for j, *_ in held]]
        inside = np.zeros(len(chunk.docs), bool)
        for _, rows, _ in held:
            inside[rows] = True
        active = np.flatnonzero(inside)
        place = np.cumsum(inside) - 1
        tf = np.zeros((len(active), len(held)), np.int64)
        for j, (_, rows, n) in enumerate(held):
            tf[place[rows], j] = n
        # documents in the order of their paths: those with the more frequent terms first
        has = tf > 0
        packed = np.packbits(has, axis=1)
        packed = np.pad(packed, ((0, 0), (0, -packed.shape[1] % 8))).view(">u8")
        order = np.lexsort([~packed[:, c] for c in range(packed.shape[1] - 1, -1, -1)]) if len(held) else np.zeros(0, np.int64)
        self.tf, self.m, self.docs = tf[order], chunk.m[active[order]], chunk.docs[active[order]]
        self._grow(has[order])

    def _grow(self, has: np.ndarray) -> None:
        n, width = has.shape
        # the first term in which a document's path leaves that of the one before
        split = np.zeros(n, np.int64)
        if n > 1:
            differ = has[1:] != has[:-1]
            split[1:] = np.where(differ.any(axis=1), differ.argmax(axis=1), width)
        opens = has & (np.arange(width) >= split[:, None])
        level_of, low, high, tops, least = [], [], [], [], []
        for j in range(width):
            at = np.flatnonzero(opens[:, j])
            if not len(at):
                continue
            breaks = np.append(np.flatnonzero(split <= j), n)
            end = breaks[np.searchsorted(breaks, at, "right")]
            edges = np.column_stack([at, end]).ravel()
            edges = edges[:-1] if edges[-1] == n else edges
            level_of.append(np.full(len(at), j))
            low.append(at)
            high.append(end)
            tops.append(np.maximum.reduceat(self.tf[:, j], edges)[::2])
            least.append(np.minimum.reduceat(self.m, edges)[::2])
        join = lambda parts: np.concatenate(parts) if parts else np.zeros(0, np.int64)
        self.level, self.low, self.high = join(level_of), join(low), join(high)
        self.adds = self.weights[self.level] * saturation(join(tops), join(least)) if len(self.level) else self.level
        # a node's parent: the deepest stretch of an earlier term around it
        parent, owner = np.full(len(self.level), -1), np.full(n, -1)
        begin = np.searchsorted(self.level, np.arange(width + 1))
        for j in range(width):
            own = np.arange(begin[j], begin[j + 1])
            if len(own):
                parent[own] = owner[self.low[own]]
                size = self.high[own] - self.low[own]
                owner[np.repeat(self.low[own] - np.concatenate([[0], np.cumsum(size)[:-1]]), size) + np.arange(size.sum())] = np.repeat(own, size)
        # what the paths below can add, from the last term up
        self.rest = np.zeros(len(self.level), np.int64)
        for j in range(width - 1, -1, -1):
            own = np.arange(begin[j], begin[j + 1])
            own = own[parent[own] >= 0]
            np.maximum.at(self.rest, parent[own], self.adds[own] + self.rest[own])
        order = np.argsort(parent, kind="stable")
        self.children, self.first_child = order, np.searchsorted(parent[order], np.arange(-1, len(parent) + 1))

    def score(self, low: int, high: int) -> np.ndarray:
        return (self.weights * saturation(self.tf[low:high], self.m[low:high, None])).sum(axis=1)

    def search(self, best: Best) -> int:
        """Walks the tree; returns the number of documents scored."""
        scored = 0
        todo = [(0, -1, 0)]  # bound, node, what its path adds; the last one is next
        while todo:
            bound, node, path = todo.pop()
            if bound < best.floor() and node >= 0:
                continue
            low, high = (0, len(self.docs)) if node < 0 else (int(self.low[node]), int(self.high[node]))
            below = self.children[self.first_child[node + 1] : self.first_child[node + 2]]
            if high - low <= LEAF or not len(below):
                best.add(self.score(low, high), self.docs[low:high])
                scored += high - low
                continue
            # documents whose path ends here stand behind all children
            end = int(self.high[below].max())
            if end < high and path >= best.floor():
                best.add(self.score(end, high), self.docs[end:high])
                scored += high - end
            adds = path + self.adds[below]
            bounds = adds + self.rest[below]
            use = np.flatnonzero(bounds >= best.floor())
            use = use[np.argsort(bounds[use], kind="stable")]
            todo += zip(bounds[use].tolist(), below[use].tolist(), adds[use].tolist(), strict=True)
        return scored


def _search_rows(items, m_scale: tuple[int, int], k: int):
    n_docs, n_terms = m_scale

    def solve(parts: list[pa.RecordBatch], best: list[Best]) -> None:
        t = pa.Table.from_batches(parts).combine_chunks()
        n = t.column("n").to_numpy()
        lists = t.column("terms").chunk(0)
        row = np.repeat(np.arange(len(n)), np.diff(lists.offsets.to_numpy()))
        docs = t.column("doc_id").fill_null(_LAST).to_numpy()
        chunk = Chunk(docs, 10 + 90 * n * n_docs // n_terms, row, lists.flatten().to_numpy().astype(np.int64), t.column("tfs").chunk(0).flatten().to_numpy())
        for item, b in zip(items.value, best, strict=True):
            Tree(chunk, item).search(b)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [Best(k) for _ in items.value]
        held, n, size = [], 0, 0
        for b in batches:
            b = b.filter(pc.greater(b.column("n"), 0))
            a = 0
            while a < b.num_rows:
                sizes = np.cumsum(pc.list_value_length(b.column("terms").slice(a)).to_numpy())
                take = max(1, min(CHUNK_DOCS - n, int(np.searchsorted(sizes, CHUNK_ENTRIES - size, "right"))))
                part = b.slice(a, take)
                held.append(part)
                a, n, size = a + part.num_rows, n + part.num_rows, size + int(sizes[part.num_rows - 1])
                if n >= CHUNK_DOCS or size >= CHUNK_ENTRIES or a < b.num_rows:
                    solve(held, best)
                    held, n, size = [], 0, 0
        if held:
            solve(held, best)
        found = [(i, -d, s) for i, x in enumerate(best) for s, d in x.heap]
        docs = [d for _, d, _ in found]
        yield pa.RecordBatch.from_arrays([pa.array([i for i, *_ in found], pa.int32()), pa.array(docs, pa.int64()), pa.array([s for *_, s in found], pa.int64())], ["item", "doc", "score"])

    return rows


def _blocks(items: DataFrame) -> Iterator[list]:
    """Rows of (item_id, text, item_hash), in blocks of bounded size."""
    given = items.select("item_id", "text", F.xxhash64("text").alias("item_hash")).filter(F.length("text") > 0).distinct()
    size = given.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("n")).first()["n"]
    n = max(1, math.ceil(size / BLOCK_BYTES))
    for i in range(n):
        rows = given.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == i).orderBy("item_id", "item_hash").collect() if size else []
        if rows:
            yield rows


def search(docs: DataFrame, items: DataFrame, k: int = 10) -> DataFrame:
    """(item_id, rank, doc_id, score, item_hash): the k best documents of every item with a score above 0, best first."""
    spark = docs.sparkSession
    schema = "item_id long, rank int, doc_id long, score long, item_hash long"
    out = None
    for rows in _blocks(items):
        found = _search_block(docs, rows, k)
        if found is not None:
            out = found if out is None else out.unionByName(found)
    return spark.createDataFrame([], schema) if out is None else out


def _search_block(docs: DataFrame, rows: list, k: int) -> DataFrame | None:
    spark = docs.sparkSession
    distinct, which, row = _terms(pa.array([r["text"] for r in rows], pa.string()))
    if not len(distinct):
        return None
    vocab = Vocabulary(distinct)
    of_items = vocab.place(distinct)[which]
    shared = spark.sparkContext.broadcast(vocab)
    vectors = stage(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
                    .mapInArrow(_vector_rows(shared), "doc_id long, n long, terms array<int>, tfs array<long>"), "vectors")
    total = vectors.filter("n > 0").agg(F.count("*").alias("docs"), F.coalesce(F.sum("n"), F.lit(0)).alias("terms")).first()
    df = np.zeros(len(vocab), np.int64)
    # one row per term of the block
    for r in vectors.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("df")).collect():
        df[r["term"]] = r["df"]

    def item(i: int) -> Item:
        terms = np.unique(of_items[row == i])
        terms = terms[np.lexsort((terms, -df[terms]))]
        return Item(terms, np.array([weight(total["docs"], int(d)) for d in df[terms]], np.int64))

    found = [item(i) for i in range(len(rows))]
    prepared = spark.sparkContext.broadcast(found)
    best = vectors.mapInArrow(_search_rows(prepared, (total["docs"], total["terms"]), k), "item int, doc long, score long")
    order = [F.desc("score"), F.asc("doc")]
    part = F.pmod(F.xxhash64("doc"), F.lit(PARTS)).alias("part")
    ranked = best.select("*", part)
    for keys in (["item", "part"], ["item"]):
        ranked = ranked.withColumn("rank", F.row_number().over(W.partitionBy(*keys).orderBy(*order))).filter(F.col("rank") <= k)
    # one row per item of the block
    names = spark.createDataFrame([(i, r["item_id"], r["item_hash"]) for i, r in enumerate(rows)], "item int, item_id long, item_hash long")
    return (ranked.join(F.broadcast(names), "item")
            .select("item_id", "rank", F.when(F.col("doc") != _LAST, F.col("doc")).alias("doc_id"), "score", "item_hash"))
