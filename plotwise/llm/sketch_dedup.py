"""Substring dedup with a count-min prefilter: removes every word covered by a window of ``window`` words whose word
sequence also starts anywhere else.

Words are ``[^\\x20\\x09-\\x0D]+`` runs, unchanged; a window stays within one document; all its places are repeats, the first
one included. Windows are judged on the input, not on what is left.

1. *Sketch.* A window is counted under its anchor: the least of its ``GRAM``-word grams by hash (leftmost of equals), which
   equal windows share. Neighbouring windows with one anchor are a span, counted once. Every task keeps a count-min
   sketch of the spans it reads (counters stop at two, no more is ever asked) and the sketches are merged block by block. Hash
   clashes and shared anchors only raise a count, so the merged sketch never estimates less than the number of a
   window's places; a window estimated below two has none but its own.
2. *Exact pass.* Only windows estimated at two or more go on. Their spans, each with the hashes of its windows, are
   grouped by (anchor, span): a span seen twice repeats as a whole, and from here on one row stands for it, however many
   copies there are. The windows of these rows are grouped by (anchor, window); what comes out single repeats nowhere.
3. *Cut.* Documents are read again: windows that the sketch lets through and that are not single are covered.
   Only documents with single windows are joined with anything.

The sketch grows with the text up to ``max_bytes`` (two counters in every ``DEPTH`` rows per expected span); it is the one thing that is
broadcast. Beyond that size the estimates get worse, so more windows go to the exact pass, and the result stays the same.
Anchors, spans and windows are told apart by 64 bits each, in pairs: 128 bits decide.

Defined results: null and empty texts have no words; texts of fewer words than a window keep everything; repeated rows are
places like any others, so they repeat each other; rows that share an id with other texts are told apart by a hash of the text; null
ids are allowed; very long texts are read in pieces of ``PIECE`` bytes; an empty table gives an empty result; extra columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plotwise.llm.tables import sift, stage
from plotwise.llm.text import BLANK, buffer, mix, slices, word_hashes, word_spans

WINDOW = 35
#: Words of an anchor's gram.
GRAM = 8
#: Bytes of a long text that are hashed at once.
PIECE = 4 << 20
#: Rows of counters; counters of a row per expected span; bytes of text per expected span (for the size alone).
DEPTH, COUNTERS, SPAN_BYTES = 4, 2, 60
#: Largest merged sketch (one bit for each counter: whether it reached two).
MAX_BYTES = 64 << 20
#: Counters of a block, in which sketches are sent and merged; spans that a task gathers before it sends them.
BLOCK = 1 << 20
GATHER = 4_000_000
_LAST = 2**63 - 1
_U = np.uint64
_K, _BASE = _U(0xD6E8FEB86659FD93), 0x9E3779B97F4A7C15 | 1


def _run_hash(w: np.ndarray, n: int) -> np.ndarray:
    """Hash of every run of ``n`` words, by doubling: that of 2k words is made of two of k."""
    have, length, out, done = w, 1, None, 0
    while True:
        factor = _U(pow(int(_K), length, 2**64))
        if n & length:
            out = have if out is None else out[: max(0, len(have) - done)] * factor + have[done:]
            done += length
        if done == n:
            return mix(out)
        have, length = have[:-length] * factor + have[length:], 2 * length


def _pieces(batch: pa.RecordBatch, window: int) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    """Bytes and offsets of a slice with the number of its first word: as a whole, or a single long text in pieces that share
    ``window`` - 1 words."""
    buf, off = buffer(batch.column("text"))
    if len(off) > 2 or len(buf) <= PIECE:
        yield buf, off, 0
        return
    at, number, size = 0, 0, PIECE
    while True:
        stop = at + size
        if stop < len(buf):
            blanks = np.flatnonzero(BLANK[buf[at:stop]])
            stop = at + int(blanks[-1]) + 1 if len(blanks) else at
        part = buf[at : min(stop, len(buf))]
        start, _, _ = word_spans(part, np.array([0, len(part)]))
        if stop < len(buf) and len(start) < 2 * window:
            size *= 2  # very long words
            continue
        yield part, np.array([0, len(part)]), number
        if stop >= len(buf):
            return
        number += len(start) - window + 1
        at, size = at + int(start[len(start) - window + 1]), PIECE


def _spans(buf: np.ndarray, off: np.ndarray, window: int) -> tuple[np.ndarray, ...]:
    """Spans of texts: row, first window (word number in its text), number of windows, anchor hash; the first window's number
    among all words, and the hash of every window by its number among all words."""
    start, end, row = word_spans(buf, off)
    n = len(start) - window + 1
    none = np.zeros(0, np.int64)
    if n <= 0:
        return none, none, none, none.astype(_U), none, none.astype(_U)
    w = word_hashes(buf, start, end)
    gram = _run_hash(w, GRAM)
    least = (gram >> _U(24) << _U(24)) | np.arange(len(gram)).astype(_U)  # 40 bits of hash, then the place
    wide, width = 1, window - GRAM + 1
    while 2 * wide <= width:
        least = np.minimum(least[:-wide], least[wide:])
        wide *= 2
    if width > wide:
        least = np.minimum(least[: -(width - wide)], least[width - wide :])
    anchor = (least[:n] & _U(0xFFFFFF)).astype(np.int64)
    valid = row[:n] == row[window - 1 :]
    new = valid.copy()
    new[1:] &= ~(valid[:-1] & (anchor[1:] == anchor[:-1]))
    head = np.flatnonzero(new)
    count = np.bincount(np.cumsum(new)[valid] - 1, minlength=len(head))
    first_word = np.searchsorted(row, np.arange(len(off) - 1))
    return row[head], head - first_word[row[head]], count, gram[anchor[head]], head, _run_hash(w, window)


def cells(anchor: np.ndarray, width: int) -> np.ndarray:
    """The counters of every anchor, one in each row of ``width`` counters (rows one after the other)."""
    out = np.empty((DEPTH, len(anchor)), np.int64)
    for i in range(DEPTH):
        h = mix(anchor + _U((i + 1) * _BASE % 2**64)) >> _U(32)
        out[i] = (h * _U(width) >> _U(32)).astype(np.int64) + i * width
    return out


class Sketch:
    """The merged sketch: whether each counter reached two."""

    def __init__(self, width: int, bits: np.ndarray):
        self.width, self.bits = width, bits

    def may_repeat(self, anchor: np.ndarray) -> np.ndarray:
        out = np.ones(len(anchor), bool)
        for at in cells(anchor, self.width):
            out &= (self.bits[at >> 3] >> (7 - (at & 7)).astype(np.uint8) & 1).astype(bool)
        return out


def _partial_rows(window: int, width: int):
    """Sketches of a task's spans, in blocks of two compressed bit planes: counters of one or more, and of two."""
    def sent(anchors: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        z = zstandard.ZstdCompressor(level=1)
        at, n = np.unique(cells(np.concatenate(anchors), width), return_counts=True)
        edges = np.searchsorted(at, np.arange(0, DEPTH * width + BLOCK, BLOCK))
        for k, (a, b) in enumerate(zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True)):
            if a < b:
                planes = np.zeros((2, BLOCK), bool)
                planes[0, at[a:b] - k * BLOCK] = True
                planes[1, at[a:b] - k * BLOCK] = n[a:b] > 1
                one, two = (z.compress(np.packbits(p).tobytes()) for p in planes)
                yield pa.RecordBatch.from_arrays([pa.array([k], pa.int64()), pa.array([one], pa.binary()), pa.array([two], pa.binary())], ["block", "one", "two"])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for b in slices(batches):
            for buf, off, _ in _pieces(b, window):
                anchor = _spans(buf, off, window)[3]
                held.append(anchor)
                size += len(anchor)
                if size >= GATHER:
                    yield from sent(held)
                    held, size = [], 0
        if size:
            yield from sent(held)

    return rows


def _merged_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of the blocks' planes, as bits of the counters that reached two."""
    z, held = zstandard.ZstdDecompressor(), {}
    for b in batches:
        for k, one, two in zip(b.column("block").to_pylist(), b.column("one"), b.column("two"), strict=True):
            one, two = (np.frombuffer(z.decompress(x.as_py()), np.uint8) for x in (one, two))
            if k not in held:
                held[k] = (one.copy(), two.copy())
            else:
                ones, twos = held[k]
                twos |= two | (ones & one)
                ones |= one
    for k, (_, twos) in held.items():
        yield pa.RecordBatch.from_arrays([pa.array([k], pa.int64()), pa.array([zstandard.ZstdCompressor(level=1).compress(twos.tobytes())], pa.binary())], ["block", "two"])


def build_sketch(docs: DataFrame, window: int = WINDOW, max_bytes: int = MAX_BYTES) -> Sketch:
    """The merged sketch of all documents' windows."""
    size = docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("n")).first()["n"]
    width = max(1024, min(COUNTERS * ceil(size / SPAN_BYTES), max_bytes * 8 // DEPTH))
    blocks = ceil(DEPTH * width / BLOCK)
    merged = (docs.select("text").mapInArrow(_partial_rows(window, width), "block long, one binary, two binary")
              .repartition(min(blocks, 256), "block").mapInArrow(_merged_rows, "block long, two binary"))
    bits = np.zeros(blocks * BLOCK // 8, np.uint8)
    # at most max_bytes, whatever the table's size
    for r in merged.collect():
        bits[r["block"] * BLOCK // 8 : (r["block"] + 1) * BLOCK // 8] = np.frombuffer(zstandard.decompress(r["two"]), np.uint8)
    return Sketch(width, bits)


def _expand(first: np.ndarray, count: np.ndarray) -> np.ndarray:
    """first, first + 1, ... of every span, one after the other."""
    return np.repeat(first - np.concatenate([[0], np.cumsum(count)[:-1]]), count) + np.arange(count.sum())


_SPAN_ROWS = "anchor long, span long, n long, doc long, tag long, start long, windows array<long>"


def _span_rows(window: int, sketch):
    """Spans that may repeat, each distinct one once per slice with its number there; doc, tag and start are those of one
    of them. ``windows``: the hashes of its windows."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            doc, tag = (b.column(c).to_numpy(zero_copy_only=False) for c in ("doc", "tag"))
            for buf, off, number in _pieces(b, window):
                row, start, count, anchor, head, hashes = _spans(buf, off, window)
                k = np.flatnonzero(sketch.value.may_repeat(anchor))
                if not len(k):
                    continue
                row, start, count, anchor, head = row[k], start[k] + number, count[k], anchor[k], head[k]
                flat = hashes[_expand(head, count)]
                edge = np.concatenate([[0], np.cumsum(count)])
                # the hash of the span: a sum over its windows by their place
                place = np.arange(len(flat)) - np.repeat(edge[:-1], count)
                total = np.concatenate([np.zeros(1, _U), np.cumsum(mix(flat + place.astype(_U) * _K))])
                span = mix(total[edge[1:]] - total[edge[:-1]] + count.astype(_U))
                order = np.lexsort((span, anchor))
                new = np.ones(len(order), bool)
                new[1:] = (anchor[order][1:] != anchor[order][:-1]) | (span[order][1:] != span[order][:-1])
                lead = order[new]
                n = np.diff(np.concatenate([np.flatnonzero(new), [len(order)]]))
                lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(count[lead])]), pa.int32()), pa.array(flat[_expand(edge[lead], count[lead])].view(np.int64)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(anchor[lead].view(np.int64)), pa.array(span[lead].view(np.int64)), pa.array(n), pa.array(doc[row[lead]]), pa.array(tag[row[lead]]), pa.array(start[lead]), lists],
                    ["anchor", "span", "n", "doc", "tag", "start", "windows"])

    return rows


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").select(
        "doc_id", F.coalesce("doc_id", F.lit(_LAST)).alias("doc"), F.xxhash64("text").alias("tag"), "text")


def single_windows(docs: DataFrame, sketch, window: int = WINDOW) -> DataFrame:
    """(doc, tag, starts): the windows that the sketch lets through and that stand nowhere else."""
    place = [F.max(c).alias(c) for c in ("doc", "tag", "start")]  # that of the only row, where there is one
    spans = _keyed(docs).mapInArrow(_span_rows(window, sketch), _SPAN_ROWS)
    distinct = spans.groupBy("anchor", "span").agg(F.sum("n").alias("n"), *place, F.first("windows").alias("windows"))
    each = distinct.select("anchor", "n", "doc", "tag", "start", F.posexplode("windows").alias("at", "window")).withColumn("start", F.col("start") + F.col("at"))
    single = each.groupBy("anchor", "window").agg(F.sum("n").alias("n"), *place).filter("n = 1")
    return single.groupBy("doc", "tag").agg(F.collect_list("start").alias("starts"))


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts compressed before they are shuffled."""
    for b in slices(batches):
        z = zstandard.ZstdCompressor(level=1)
        text = [z.compress((t or "").encode()) for t in b.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("doc"), b.column("tag"), pa.array(text, pa.binary())], ["doc_id", "doc", "tag", "packed"])


def _unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches with their texts, in parts of bounded size."""
    for b in batches:
        for i in range(0, b.num_rows, 256):
            part = b.slice(i, 256)
            text = [zstandard.decompress(x.as_py()).decode() for x in part.column("packed")]
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(text, pa.string()), part.column("starts")], ["doc_id", "text", "starts"])


def _cut_rows(window: int, sketch, packed: bool):
    """(doc_id, n_words, n_removed, kept): texts without the words that repeated windows cover."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(_unpacked(batches) if packed else batches):
            marks_row, marks = [], []
            for buf, off, number in _pieces(b, window):
                row, start, count, anchor, _, _ = _spans(buf, off, window)
                k = np.flatnonzero(sketch.value.may_repeat(anchor))
                marks_row.append(np.repeat(row[k], count[k]))
                marks.append(_expand(start[k] + number, count[k]))
            row, at = np.concatenate(marks_row), np.concatenate(marks)
            buf, off = buffer(b.column("text"))
            word, end, of = word_spans(buf, off)
            first = np.searchsorted(of, np.arange(len(off)))
            at = at + first[row]
            covers = np.zeros(len(word) + 1, bool)
            covers[at] = True
            if packed:
                lists = b.column("starts")
                size = np.diff(lists.offsets.to_numpy())
                covers[lists.flatten().to_numpy() + np.repeat(first[:-1], size)] = False
            # words that a window starting at one of the last ``window`` words covers; windows never leave their text
            begun = np.cumsum(covers[:-1])
            gone = begun - np.concatenate([np.zeros(min(window, len(begun)), begun.dtype), begun[: max(0, len(begun) - window)]]) > 0
            kept = ~gone
            last = np.zeros(len(word), bool)  # the last kept word of each text
            stay = np.flatnonzero(kept)
            if len(stay):
                last[stay[np.concatenate([of[stay][1:] != of[stay][:-1], [True]])]] = True
            inside = np.zeros(len(buf) + 2, np.int8)
            more = kept & ~last
            inside[word[kept]] += 1
            inside[end[kept & last]] -= 1
            inside[end[more] + 1] -= 1  # with the blank that follows
            use = np.cumsum(inside[: len(buf)], dtype=np.int8) > 0
            out = buf.copy()
            out[end[more]] = 0x20
            edges = np.concatenate([[0], np.cumsum(use)])[off]
            text = out[use]
            words, removed = np.diff(first), np.bincount(of[gone], minlength=b.num_rows)
            lists = pa.LargeStringArray.from_buffers(b.num_rows, pa.py_buffer(edges), pa.py_buffer(text)).cast(pa.string())
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(words, pa.int64()), pa.array(removed, pa.int64()), lists], ["doc_id", "n_words", "n_removed", "kept"])

    return rows


def dedup(docs: DataFrame, window: int = WINDOW, max_bytes: int = MAX_BYTES) -> DataFrame:
    """(doc_id, n_words, n_removed, kept), one row per row of ``docs``; ``kept``: the words that stay, one space between two."""
    sketch = docs.sparkSession.sparkContext.broadcast(build_sketch(docs, window, max_bytes))
    single = stage(single_windows(docs, sketch, window), "single-windows")
    schema = "doc_id long, n_words long, n_removed long, kept string"
    # only texts with single windows are moved
    may, rest = sift(_keyed(docs), "doc", single.select("doc"))
    moved = (may.mapInArrow(_packed, "doc_id long, doc long, tag long, packed binary").join(single, ["doc", "tag"], "left")
             .select("doc_id", "packed", F.coalesce("starts", F.array().cast("array<bigint>")).alias("starts")))
    return (rest.select("doc_id", "text").mapInArrow(_cut_rows(window, sketch, False), schema)
            .unionByName(moved.mapInArrow(_cut_rows(window, sketch, True), schema)))
