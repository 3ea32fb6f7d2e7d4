"""Benchmark decontamination: rare n-gram seeds, then Smith-Waterman alignment.

Words are lower-cased (A-Z) runs of letters, digits and marks of any script; in scripts without blanks between words
(Chinese, Japanese, Thai and others) every character is a word. The document frequency of every benchmark
n-gram is counted over all documents; the rarest of each item's n-grams that occur at all are its seeds (always up to that part of
its n-grams, so an item that leaks often, or is much edited, keeps its seeds). Documents are searched for seeds; the stretch around
one, or around several of an item that stand near each other, is aligned with the item (match +2, mismatch and
gap -1). The score is the best local alignment over that of a perfect copy, so edited, shortened or
interrupted copies score in proportion; from ``MIN_SCORE`` on a document is contaminated.

A word weighs by how many documents and items hold the n-grams around it, against the rarer n-grams of its item, so a
stock phrase of a templated item scores little by itself, while an item that leaks often as a whole keeps full weights.
A stretch that matches ``LONG_WORDS`` words or more net is no phrase: it also counts with weights by items alone.

The benchmark is handled in blocks of bounded size, one after the other; a block's seeds go to the tasks as a
broadcast of at most ``BLOCK_BYTES`` of text. Documents are only scanned, never shuffled.

Defined results: null and empty texts on either side match nothing, nor do texts without a word; items of fewer than
``MIN_WORDS`` words match exactly, as a whole word sequence, with score 1 and one seed (its first place counts); repeated items and documents give a row
each; null ids pass through; extra columns are ignored; an empty benchmark contaminates nothing.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from math import ceil
from unicodedata import category

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plotwise.llm.text import ALNUM, LOWER, buffer, distinct, mix, slices, word_hashes, word_spans

#: Words of a seed; the part of an item's n-grams that are seeds; the fewest words of an item that is aligned.
SEED_WORDS, SEED_PART, MIN_WORDS = 3, 0.7, 8
MIN_SCORE = 0.4
#: An n-gram weighs fully up to this many documents and items, or up to the count at this part of its item's n-grams.
RARE_COUNT, RARE_PART = 3, 0.2
#: Matched words (net of mismatches and gaps) from which a stretch is taken for a copy, however many documents hold it.
LONG_WORDS = 13
BLOCK_BYTES = 4 << 20


@dataclass
class Block:
    """Items of one block: their ids and word hashes, and their seeds sorted by hash."""
    ids: list
    words: list[np.ndarray]
    hashes: np.ndarray
    first: np.ndarray  # of each hash, its place in item/at
    item: np.ndarray
    at: np.ndarray
    short: list[tuple[int, np.ndarray, np.ndarray, np.ndarray]]  # words, hashes, first place in and items, of items matched exactly
    weights: list[np.ndarray]  # of each item's words, by documents and items
    shared: list[np.ndarray]  # by items alone


#: Scripts without blanks between words, by first and last code point.
UNSPACED = ((0x0E00, 0x0EFF), (0x1000, 0x109F), (0x1780, 0x17FF), (0x1950, 0x19DF), (0x1A20, 0x1AAF), (0x1B00, 0x1B7F), (0x2E80, 0x2FDF), (0x3005, 0x3007), (0x3021, 0x312F),
            (0x31A0, 0x31BF), (0x31F0, 0x31FF), (0x3400, 0x4DBF), (0x4E00, 0xA48F), (0xA980, 0xA9DF), (0xAA60, 0xAADF), (0xF900, 0xFAFF), (0xFF66, 0xFF9F), (0x1AFF0, 0x1B2FF), (0x20000, 0x323AF))
_kinds = np.zeros(0, np.uint8)


def kinds() -> np.ndarray:
    """Of every code point: 0 separates words, 1 is part of a word, 2 is a word of its own."""
    global _kinds
    if not len(_kinds):
        made = np.array([category(chr(c))[0] in "LNM" for c in range(0x323B0)] + [False], np.uint8)
        for a, b in UNSPACED:
            made[a : b + 1] *= 2
        _kinds = made
    return _kinds


def token_spans(low: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and row of every word of lower-cased texts."""
    lead = np.flatnonzero(low >= 0xC0)
    if not len(lead):
        return word_spans(low, off, ALNUM)
    b, more = low[lead].astype(np.int64), [np.append(low, [0, 0, 0])[lead + i].astype(np.int64) & 0x3F for i in (1, 2, 3)]
    size = 2 + (b >= 0xE0) + (b >= 0xF0)
    two, three = (b & 0x1F) << 6 | more[0], (b & 0x0F) << 12 | more[0] << 6 | more[1]
    point = np.where(size == 2, two, np.where(size == 3, three, (b & 0x07) << 18 | more[0] << 12 | more[1] << 6 | more[2]))
    kind = kinds()[np.minimum(point, len(kinds()) - 1)]
    inside = ALNUM[low]
    for i in range(4):
        inside[lead[(kind == 0) & (size > i)] + i] = False
    edge = np.zeros(len(low) + 1, bool)
    edge[off] = True
    edge[lead[kind == 2]] = edge[(lead + size)[kind == 2]] = True
    start = np.flatnonzero(inside & (edge[:-1] | ~np.concatenate([[False], inside[:-1]])))
    end = np.flatnonzero(inside & (edge[1:] | ~np.concatenate([inside[1:], [False]]))) + 1
    return start, end, np.searchsorted(off, start, "right") - 1


def words_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word hashes, their rows, and the n+1 word offsets of the rows."""
    buf, off = buffer(texts)
    low = LOWER[buf]
    s, e, row = token_spans(low, off)
    return word_hashes(low, s, e, None), row, np.searchsorted(row, np.arange(len(off)))


def grams(w: np.ndarray, row: np.ndarray, edges: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, row and first word (number within its row) of every run of ``n`` words."""
    size = max(0, len(w) - n + 1)
    h = np.zeros(size, np.uint64)
    for i in range(n):
        h = (h + w[i : size + i]) * np.uint64(0xD6E8FEB86659FD93)
    full = row[:size] == row[len(row) - size :]
    return mix(h)[full], row[:size][full], (np.arange(size) - edges[row[:size]])[full]


def align(item: np.ndarray, text: np.ndarray, weights: np.ndarray | None = None) -> float:
    """Smith-Waterman over word hashes, as a part of the score of a perfect copy of ``item``; match, mismatch and gap
    count by the weight of the item's word."""
    if not len(item) or not len(text):
        return 0.0
    weights = np.ones(len(item)) if weights is None else weights
    steps = np.arange(len(text))
    h = best = np.zeros(len(text))
    for w, c in zip(item, weights.tolist(), strict=True):
        diagonal = np.concatenate([[0], h[:-1]]) + np.where(text == w, 2 * c, -c)
        top = np.maximum(np.maximum(diagonal, h - c), 0)
        h = np.maximum.accumulate(top + steps * c) - steps * c  # gaps in the item: one weight less a step
        best = np.maximum(best, h)
    return float(best.max()) / (2 * float(weights.sum()))


def judge(item: np.ndarray, text: np.ndarray, weights: np.ndarray, shared: np.ndarray) -> float:
    """The score of a stretch: by the weights, or by those of items alone if it is long."""
    got = align(item, text, weights)
    if got < 1 and (shared > weights).any():
        other = align(item, text, shared)
        if other * float(shared.sum()) >= LONG_WORDS:
            got = max(got, other)
    return got


def word_weights(count: np.ndarray) -> np.ndarray:
    """Weights of an item's words by the counts of its n-grams (falling with the square): the least of the n-grams that hold the word."""
    usual = max(RARE_COUNT, int(np.sort(count)[int(RARE_PART * len(count))]))
    gram = np.minimum(1.0, usual / np.maximum(count, 1)) ** 2
    out = np.ones(len(count) + SEED_WORDS - 1)
    for i in range(SEED_WORDS):
        out[i : i + len(gram)] = np.minimum(out[i : i + len(gram)], gram)
    return out


def _gram_counts(known: np.ndarray):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(known), np.int64)
        for b in slices(batches):
            h, row, _ = grams(*words_of(b.column("text")), SEED_WORDS)
            k = np.minimum(np.searchsorted(known, h), len(known) - 1)
            hit = known[k] == h
            k, _ = distinct(k[hit].astype(np.uint64), row[hit])
            total += np.bincount(k.astype(np.int64), minlength=len(known))
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], ["gram", "n"])

    return rows


def _counts(table: DataFrame, known: np.ndarray) -> np.ndarray:
    """Rows of ``table`` that hold each of the ``known`` n-grams."""
    out = np.zeros(len(known), np.int64)
    # one row per n-gram of the block
    for r in table.select("text").mapInArrow(_gram_counts(known), "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n")).collect():
        out[r["gram"]] = r["n"]
    return out


def make_block(docs: DataFrame, given: DataFrame, rows: list) -> Block | None:
    """Seeds of a block's items, chosen by document frequency over all documents."""
    words, own, edges = words_of(pa.array([r["text"] for r in rows], pa.string()))
    n_words = np.diff(edges)
    short = []
    for n in range(1, MIN_WORDS):
        h, row, _ = grams(words, own, edges, n)
        h, row = h[n_words[row] == n], row[n_words[row] == n]
        if len(h):
            order = np.lexsort((row, h))
            hashes, first = np.unique(h[order], return_index=True)
            short.append((n, hashes, np.concatenate([first, [len(order)]]), row[order]))
    h, row, at = grams(words, own, edges, SEED_WORDS)
    long_enough = n_words[row] >= MIN_WORDS
    h, row, at = h[long_enough], row[long_enough], at[long_enough]
    ids, split = [r["item_id"] for r in rows], [words[edges[i] : edges[i + 1]] for i in range(len(rows))]
    if not len(h):
        return Block(ids, split, h, np.zeros(1, np.int64), row, at, short, [], []) if short else None
    known = np.unique(h)
    df, of_items = (_counts(table, known)[np.searchsorted(known, h)] for table in (docs, given))
    weights, shared = [np.ones(len(x)) for x in split], [np.ones(len(x)) for x in split]
    head = np.flatnonzero(np.concatenate([[True], row[1:] != row[:-1]]))
    for a, b in zip(head, [*head[1:], len(row)], strict=True):
        weights[row[a]], shared[row[a]] = word_weights((df + of_items)[a:b]), word_weights(of_items[a:b])
    # n-grams that no document holds find nothing: the rarest of the others are the seeds
    order = np.lexsort((h, df, row))
    order = order[df[order] > 0]
    rank = np.arange(len(order)) - np.searchsorted(row[order], row[order])
    size = np.bincount(row, minlength=len(rows))[row[order]]
    order = order[rank < np.ceil(SEED_PART * size)]
    order = order[np.lexsort((at[order], row[order], h[order]))]
    hashes, first = np.unique(h[order], return_index=True)
    return Block(ids, split, hashes, np.concatenate([first, [len(order)]]), row[order], at[order], short, weights, shared)


def find_in(block: Block, texts: pa.Array, min_score: float) -> Iterator[tuple[int, int, float, int, int]]:
    """(row, item, score, first word, seeds) of every contaminated (row, item) of a slice, best stretch each."""
    words, own, edges = words_of(texts)
    for n, hashes, first, item in block.short:
        h, row, place = grams(words, own, edges, n)
        k = np.minimum(np.searchsorted(hashes, h), len(hashes) - 1)
        hit = np.flatnonzero(hashes[k] == h)
        _, one = np.unique(np.column_stack([row[hit], k[hit]]), axis=0, return_index=True)  # the first place in each row
        for j in hit[one].tolist():
            for i in item[first[k[j]] : first[k[j] + 1]].tolist():
                yield int(row[j]), i, 1.0, int(place[j]), 1
    if not len(block.hashes):
        return
    h, row, place = grams(words, own, edges, SEED_WORDS)
    k = np.minimum(np.searchsorted(block.hashes, h), len(block.hashes) - 1)
    hit = block.hashes[k] == h
    k, row, place = k[hit], row[hit], place[hit]
    if not len(k):
        return
    n = block.first[k + 1] - block.first[k]
    of = np.repeat(np.arange(len(k)), n)
    entry = block.first[k][of] + np.arange(n.sum()) - np.repeat(np.concatenate([[0], np.cumsum(n)[:-1]]), n)
    row, place, item, at = row[of], place[of], block.item[entry], block.at[entry]
    order = np.lexsort((place, item, row))
    row, place, item, at = row[order], place[order], item[order], at[order]
    length = np.array([len(w) for w in block.words])[item]
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (item[1:] != item[:-1]) | (place[1:] - place[:-1] > length[1:])
    head = np.flatnonzero(new)
    tail = np.concatenate([head[1:], [len(row)]])
    best: dict[tuple[int, int], tuple[float, int, int]] = {}
    for a, b in zip(head.tolist(), tail.tolist(), strict=True):
        r, i, m = int(row[a]), int(item[a]), int(length[a])
        lead, rest = int((place[a:b] - at[a:b]).min()), int((place[a:b] + m - at[a:b]).max())
        slack = m // 4 + 2
        lo, hi = max(0, lead - slack), min(int(edges[r + 1] - edges[r]), rest + slack)
        got = judge(block.words[i], words[edges[r] + lo : edges[r] + hi], block.weights[i], block.shared[i])
        if got >= min_score and got > best.get((r, i), (0.0,))[0]:
            best[r, i] = (got, lo, b - a)
    for (r, i), (got, lo, seeds) in best.items():
        yield r, i, got, lo, seeds


def _blocks(docs: DataFrame, benchmark: DataFrame) -> Iterator:
    """Broadcast blocks of the benchmark, each of bounded size."""
    given = benchmark.select("item_id", "text").filter(F.length("text") > 0)
    size = given.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("n")).first()["n"]
    n = max(1, ceil(size / BLOCK_BYTES))
    for i in range(n):
        rows = given.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == i).orderBy("item_id", "text").collect()
        block = make_block(docs, given, rows) if rows else None
        if block:
            yield docs.sparkSession.sparkContext.broadcast(block)


def find(docs: DataFrame, benchmark: DataFrame, min_score: float = MIN_SCORE) -> DataFrame:
    """(doc_id, item_id, score, first_word, n_seeds): every contaminated document with every item it holds."""
    schema = "doc_id long, item_id long, score double, first_word long, n_seeds long"

    def search(block):
        def rows(batches):
            for b in slices(batches):
                found = list(find_in(block.value, b.column("text"), min_score))
                ids = b.column("doc_id").to_pylist() if found else []
                yield pa.RecordBatch.from_arrays([
                    pa.array([ids[r] for r, *_ in found], pa.int64()), pa.array([block.value.ids[i] for _, i, *_ in found], pa.int64()),
                    pa.array([s for _, _, s, _, _ in found], pa.float64()), pa.array([w for *_, w, _ in found], pa.int64()), pa.array([n for *_, n in found], pa.int64())],
                    ["doc_id", "item_id", "score", "first_word", "n_seeds"])
        return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(rows, schema)

    parts = [search(b) for b in _blocks(docs, benchmark)]
    return reduce(DataFrame.unionByName, parts) if parts else docs.sparkSession.createDataFrame([], schema)


def drop(docs: DataFrame, benchmark: DataFrame, min_score: float = MIN_SCORE) -> DataFrame:
    """``docs`` without contaminated rows; same columns. Blocks filter in turn within one scan."""
    def clean(block):
        def rows(batches):
            for b in slices(batches):
                bad = {r for r, *_ in find_in(block.value, b.column("text"), min_score)}
                yield b.filter(pa.array([i not in bad for i in range(b.num_rows)], pa.bool_())) if bad else b
        return rows

    out = docs
    for block in _blocks(docs, benchmark):
        out = out.mapInArrow(clean(block), docs.schema)
    return out
