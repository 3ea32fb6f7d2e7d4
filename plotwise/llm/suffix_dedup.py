"""Suffix-array dedup: removes every byte covered by a string of ``length`` bytes that also starts earlier.

Texts are UTF-8 bytes; matches never cross documents; earlier means a smaller doc_id, or the same document
and a smaller start. Strings are judged on the input, not on what is left.

1. *Anchors.* Each window of ``length`` bytes picks its anchor: the start of its least ``GRAM``-byte gram by
   hash (leftmost of equals). Equal windows pick the same place, so equal windows meet under the
   anchor's gram. Neighbouring windows with one anchor form a span; about one row per 30 bytes is moved.
   Spans that repeat within a slice of the input are settled before the shuffle.
2. *Classes.* Under a gram, equal spans are one class: all but its earliest are repeats as a whole. A gram
   with a single class is done. Classes are keyed by 64 and 56 bits; a span has fewer than 200 bytes, too few for the texts
   that collide as polynomials mod 2**64.
3. *Suffix sort.* The earliest spans of grams with several classes overlap in part. Their windows are suffixes
   of a local buffer, sorted by a bottom-up mergesort whose comparisons find the common extension
   by binary search over prefix polynomial hashes; neighbours that agree over ``length`` bytes are verified byte by
   byte. All but the earliest of equal windows are repeats. A gram of more than ``HOT`` such spans is not sorted in one
   task: its windows are grouped by two independent 64-bit hashes, with minima taken before the shuffle.
4. Repeats are joined back to their documents, the covered bytes cut out.

Defined results: null texts are empty; texts under ``length`` bytes keep everything; a null doc_id counts
as the largest long; repeated rows (same id and text) don't repeat each other, each is judged against the other
documents; rows that share an id with other texts are told apart by a hash of the text; an empty table
gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from plotwise.llm.tables import stage
from plotwise.llm.text import buffer, mix, prefix_hashes, slices, span_hashes

#: Bytes of a gram, and of the longest piece of a text that is hashed at once.
GRAM = 40
PIECE = 4 << 20
#: Spans of one gram from which its windows are grouped by hash instead of being sorted in one task.
HOT = 20_000
#: Spans that a task sorts at a time.
CHUNK = 4_000
_LAST = 2**63 - 1
_U = np.uint64


def _windows(buf: np.ndarray, off: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Spans of one slice: first window, number of windows, anchor's gram hash, hash of the span."""
    n = len(buf) - length + 1
    none = np.zeros(0, np.int64)
    if n <= 0:
        return none, none, none.astype(_U), none.astype(_U)
    prefix = prefix_hashes(buf)
    at = np.arange(len(buf) - GRAM + 1)
    gram = mix(span_hashes(prefix, at, at + GRAM))
    least = (gram >> _U(24) << _U(24)) | at.astype(_U)  # 40 bits of hash, then the place
    wide, width = 1, length - GRAM + 1
    while 2 * wide <= width:
        least = np.minimum(least[:-wide], least[wide:])
        wide *= 2
    if width > wide:
        least = np.minimum(least[: -(width - wide)], least[width - wide :])
    anchor = (least[:n] & _U(0xFFFFFF)).astype(np.int64)
    inside = np.zeros(len(buf) + 1, np.int32)
    fits = np.diff(off) >= length
    np.add.at(inside, off[:-1][fits], 1)
    np.add.at(inside, off[1:][fits] - length + 1, -1)
    valid = np.cumsum(inside[:n]) > 0
    starts = valid.copy()
    starts[1:] &= ~(valid[:-1] & (anchor[1:] == anchor[:-1]))
    first = np.flatnonzero(starts)
    # a new text starts a new span even if the windows before it were valid: its anchor differs
    end = np.flatnonzero(valid & ~np.concatenate([valid[1:] & ~starts[1:], [False]])) + 1
    count = end - first
    return first, count, gram[anchor[first]], mix(span_hashes(prefix, first, end - 1 + length) + count.astype(_U))


def _merged(doc: np.ndarray, start: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Union of intervals by document; ``doc`` are row numbers."""
    if not len(doc):
        return doc, start, stop
    order = np.lexsort((start, doc))
    doc, start, stop = doc[order], start[order], stop[order]
    base = doc.astype(np.int64) * (int(stop.max()) + 1)  # documents side by side: one running maximum
    reach = np.maximum.accumulate(stop + base)
    fresh = np.ones(len(doc), bool)
    fresh[1:] = start[1:] + base[1:] > reach[:-1]
    head = np.flatnonzero(fresh)
    last = np.concatenate([head[1:], [len(doc)]]) - 1
    return doc[head], start[head], reach[last] - base[head]


def _anchor_rows(length: int):
    """(gram, cls, doc, place): spans (cls >= 0, its low 7 bits the number of windows) and, settled here
    already, repeated stretches (cls = minus their length)."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            whole, off = buffer(b.column("text"))
            doc = b.column("doc").to_numpy(zero_copy_only=False)
            tag = b.column("tag").to_numpy(zero_copy_only=False).astype(np.int64)
            if len(whole) > PIECE and b.num_rows == 1:
                steps = range(0, max(1, len(whole) - length + 1), PIECE)
                pieces = [(whole[s : s + PIECE + length - 1], np.array([0, min(len(whole) - s, PIECE + length - 1)]), s) for s in steps]
            else:
                pieces = [(whole, off, 0)]
            for buf, edges, base in pieces:
                first, count, gram, span = _windows(buf, edges, length)
                if not len(first):
                    continue
                row = np.searchsorted(edges, first, "right") - 1
                place = first - edges[row] + base
                cls = ((span >> _U(8)).astype(np.int64) << 7 | count) & _LAST
                order = np.lexsort((place, doc[row], cls, gram))
                same = np.zeros(len(order), bool)
                same[1:] = (gram[order][1:] == gram[order][:-1]) & (cls[order][1:] == cls[order][:-1])
                # repeated rows of one document stand at the same place: they are no repeats of each other
                head = np.maximum.accumulate(np.where(same, 0, np.arange(len(order))))
                own = (doc[row][order] == doc[row][order][head]) & (place[order] == place[order][head])
                again, lead = order[same & ~own], order[~same | own]
                r, s, e = _merged(row[again], place[again], place[again] + count[again] + length - 1)
                out = [np.concatenate(x) for x in (
                    (gram[lead].view(np.int64), mix((s + (doc[r] << 24)).astype(_U)).view(np.int64)),
                    (cls[lead], s - e),
                    (doc[row[lead]], doc[r]),
                    (place[lead] << 32 | tag[row[lead]], s << 32 | tag[r]))]
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in out], ["gram", "cls", "doc", "place"])

    return rows


def common_extension(prefix: np.ndarray, x: np.ndarray, y: np.ndarray, length: int) -> np.ndarray:
    """Length of the longest common prefix of suffixes x and y, up to ``length``, by binary search."""
    low, high = np.zeros(len(x), np.int64), np.full(len(x), length, np.int64)
    while True:
        open_ = low < high
        if not open_.any():
            return low
        mid = (low + high + 1) // 2
        same = span_hashes(prefix, x, x + mid) == span_hashes(prefix, y, y + mid)
        low, high = np.where(same, mid, low), np.where(same, high, mid - 1)


def _less(buf, prefix, x, y, length, or_equal: bool) -> np.ndarray:
    same = common_extension(prefix, x, y, length)
    at = np.minimum(same, length - 1)
    return np.where(same == length, or_equal, buf[x + at] < buf[y + at])


def merge_sort(buf: np.ndarray, prefix: np.ndarray, suffix: np.ndarray, group: np.ndarray, length: int) -> np.ndarray:
    """Order of the suffixes within their groups (``group`` ascending): bottom-up mergesort, all runs of all
    groups merged at once; an element's place is its own rank plus its rank in the other run."""
    order = np.arange(len(suffix))
    first = np.concatenate([[True], group[1:] != group[:-1]])
    head = np.flatnonzero(first)
    size = np.diff(np.concatenate([head, [len(group)]]))
    start, total = np.repeat(head, size), np.repeat(size, size)
    width = 1
    while width < size.max(initial=1):
        idx = np.flatnonzero(total > width)
        rank = idx - start[idx]
        run = rank // (2 * width) * (2 * width)
        left = rank - run < width
        mid = np.minimum(run + width, total[idx])
        end = np.minimum(run + 2 * width, total[idx])
        a, b = np.where(left, mid, run), np.where(left, end, mid)  # the other run
        low, high = a.copy(), b.copy()
        me = suffix[order[idx]]
        while True:
            act = np.flatnonzero(low < high)
            if not len(act):
                break
            m = (low[act] + high[act]) // 2
            other = suffix[order[start[idx[act]] + m]]
            # a left element goes before equals of the right run, a right one after equals of the left
            before = np.empty(len(act), bool)
            is_left = left[act]
            for side in (True, False):
                k = np.flatnonzero(is_left == side)
                if len(k):
                    before[k] = _less(buf, prefix, other[k], me[act[k]], length, or_equal=not side)
            low[act] = np.where(before, m + 1, low[act])
            high[act] = np.where(before, high[act], m)
        place = start[idx] + run + (rank - np.where(left, run, mid)) + (low - a)
        moved = order.copy()
        moved[place] = order[idx]
        order, width = moved, width * 2
    return order


def equal_windows(spans: list[bytes], group: np.ndarray, shift: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Windows of spans sorted as suffixes: (span, offset, class number); windows are equal exactly when
    their class is. ``group``: the spans' gram number; ``shift``: windows before the anchor."""
    size = np.array([len(s) for s in spans])
    buf = np.frombuffer(b"".join(spans), np.uint8)
    prefix = prefix_hashes(buf)
    count = size - length + 1
    base = np.concatenate([[0], np.cumsum(size)[:-1]])
    span = np.repeat(np.arange(len(spans)), count)
    offset = np.arange(len(span)) - np.repeat(np.concatenate([[0], np.cumsum(count)[:-1]]), count)
    suffix = base[span] + offset
    key = group[span] * 256 + (shift[span] - offset)  # equal windows have their anchor at one distance
    order = np.argsort(key, kind="stable")
    span, offset, suffix, key = span[order], offset[order], suffix[order], key[order]
    order = merge_sort(buf, prefix, suffix, key, length)
    span, offset, suffix = span[order], offset[order], suffix[order]
    same = np.zeros(len(suffix), bool)
    near = np.flatnonzero(key[1:] == key[:-1]) + 1
    agree = near[span_hashes(prefix, suffix[near], suffix[near] + length) == span_hashes(prefix, suffix[near - 1], suffix[near - 1] + length)]
    bad = []
    for i in range(0, len(agree), 50_000):  # collision verification
        k = agree[i : i + 50_000]
        true = np.lib.stride_tricks.sliding_window_view(buf, length)[suffix[k]] == np.lib.stride_tricks.sliding_window_view(buf, length)[suffix[k - 1]]
        true = true.all(axis=1)
        same[k] = true
        bad.append(key[k[~true]])
    number = np.cumsum(~same)
    for g in np.unique(np.concatenate(bad)) if bad else ():  # a collision may have spoilt a group's order
        k = np.flatnonzero(key == g)
        seen: dict[bytes, int] = {}
        number[k] = [len(suffix) + seen.setdefault(buf[s : s + length].tobytes(), int(j)) for j, s in zip(k, suffix[k], strict=True)]
    return span, offset, number


def _repeats(spans: list[bytes], gram: np.ndarray, shift: np.ndarray, doc: np.ndarray, place: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Repeated stretches (span, start, stop) among the windows of some grams' spans."""
    group = np.unique(gram, return_inverse=True)[1]
    span, offset, number = equal_windows(spans, group, shift, length)
    start = (place[span] >> 32) + offset
    order = np.lexsort((start, doc[span], number))
    head = np.ones(len(order), bool)
    head[1:] = number[order][1:] != number[order][:-1]
    lead = order[np.maximum.accumulate(np.where(head, np.arange(len(order)), 0))]
    later = (doc[span[order]] != doc[span[lead]]) | (start[order] != start[lead])
    k = order[later]
    return _merged(span[k], start[k], start[k] + length)


def _span_bytes(length: int, hot: bool):
    """Texts joined to their open spans -> (gram, shift, doc, place, bytes), or the windows of hot grams."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                text = zstandard.decompress(batch.column("packed")[i].as_py())
                doc = batch.column("doc")[i].as_py()
                spans = batch.column("spans")[i].values
                gram, cls, place = (spans.field(c).to_numpy() for c in ("gram", "cls", "place"))
                at, n = place >> 32, (cls & 127) + length - 1
                if hot:
                    buf = np.frombuffer(text, np.uint8)
                    count = cls & 127
                    k = np.repeat(np.arange(len(at)), count)
                    s = at[k] + np.arange(len(k)) - np.repeat(np.concatenate([[0], np.cumsum(count)[:-1]]), count)
                    w1 = mix(span_hashes(prefix_hashes(buf), s, s + length))
                    w2 = mix(span_hashes(prefix_hashes(255 - buf[:] ^ np.uint8(0x5A)), s, s + length))
                    yield pa.RecordBatch.from_arrays([pa.array(w1.view(np.int64)), pa.array(w2.view(np.int64)), pa.array(np.full(len(k), doc, np.int64)), pa.array(s << 32 | (place[k] & 0xFFFFFFFF))], ["w1", "w2", "doc", "place"])
                    continue
                got = [text[a : a + m] for a, m in zip(at.tolist(), n.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array(gram), pa.array(np.full(len(at), doc, np.int64)), pa.array(place), pa.array(got, pa.binary())], ["gram", "doc", "place", "bytes"])

    return rows


def _shifts(spans: list[bytes], length: int) -> np.ndarray:
    """Windows before the anchor of each span: the place of its gram, found as it was when spans were cut."""
    size = np.array([len(s) for s in spans])
    buf = np.frombuffer(b"".join(spans), np.uint8)
    base = np.concatenate([[0], np.cumsum(size)[:-1]])
    prefix = prefix_hashes(buf)
    # the anchor is the least gram of the span's first window
    at = base[:, None] + np.arange(length - GRAM + 1)
    hashes = mix(span_hashes(prefix, at, at + GRAM)) >> _U(24)
    return np.argmin(hashes, axis=1)


def _sort_rows(length: int):
    """Rows sorted by gram -> repeated stretches; whole grams are gathered up to ``CHUNK`` spans."""
    def solve(part: list[pa.RecordBatch]) -> pa.RecordBatch | None:
        t = pa.Table.from_batches(part)
        gram, doc, place = (t.column(c).to_numpy() for c in ("gram", "doc", "place"))
        spans = t.column("bytes").to_pylist()
        k, s, e = _repeats(spans, gram, _shifts(spans, length), doc, place, length)
        return pa.RecordBatch.from_arrays([pa.array(doc[k]), pa.array(s << 32 | (place[k] & 0xFFFFFFFF)), pa.array(e - s)], ["doc", "place", "n"])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for b in batches:
            a = 0
            while a < b.num_rows:
                b_part = b.slice(a, CHUNK)
                a += CHUNK
                held.append(b_part)
                if sum(x.num_rows for x in held) < CHUNK:
                    continue
                gram = b_part.column("gram").to_numpy()
                cut = int(np.flatnonzero(gram != gram[-1])[-1]) + 1 if gram[0] != gram[-1] else 0
                if not cut:
                    continue
                yield solve([*held[:-1], b_part.slice(0, cut)])
                held = [b_part.slice(cut)]
        if held:
            yield solve(held)

    return rows


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts compressed before they are shuffled."""
    for b in slices(batches):
        z = zstandard.ZstdCompressor(level=1)
        text = [z.compress((t or "").encode()) for t in b.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("doc"), b.column("tag"), pa.array(text, pa.binary())], ["doc_id", "doc", "tag", "packed"])


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        out = []
        for packed, doc_id, spans in zip(b.column("packed"), b.column("doc_id").to_pylist(), b.column("spans"), strict=True):
            text = zstandard.decompress(packed.as_py())
            n = n_runs = 0
            digest = hashlib.sha256()
            at = 0
            if spans.is_valid and len(spans.values):
                start, size = (spans.values.field(c).to_numpy() for c in ("start", "n"))
                zero = np.zeros(len(start), np.int64)
                _, s, e = _merged(zero, start, start + size)
                for x, y in zip(s.tolist(), np.minimum(e, len(text)).tolist(), strict=True):
                    digest.update(text[at:x])
                    n, n_runs, at = n + y - x, n_runs + 1, y
            digest.update(text[at:])
            out.append((doc_id, len(text), n, n_runs, digest.hexdigest()))
        columns = list(zip(*out, strict=True)) if out else [[]] * 5
        yield pa.RecordBatch.from_arrays([*[pa.array(c, pa.int64()) for c in columns[:4]], pa.array(columns[4], pa.string())], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])


def repeats(docs: DataFrame, length: int = 100, hot: int = HOT) -> DataFrame:
    """(doc, tag, start, n): stretches of bytes covered by strings that also start earlier."""
    given = _keyed(docs)
    rows = given.mapInArrow(_anchor_rows(length), "gram long, cls long, doc long, place long")
    under, of_class = W.partitionBy("gram"), W.partitionBy("gram", "cls")
    seen = (rows.withColumn("lead", F.first(F.struct("doc", F.shiftright("place", 32).alias("start"))).over(of_class.orderBy("doc", "place")))
            .withColumn("least", F.min("cls").over(under)).withColumn("most", F.max("cls").over(under)))
    own = (F.col("doc") == F.col("lead.doc")) & (F.shiftright("place", 32) == F.col("lead.start"))
    state = F.when(F.col("cls") < 0, F.lit("cut")).when(~own, F.lit("cut")).when(F.col("least") != F.col("most"), F.lit("open"))
    kept = stage(seen.withColumn("state", state).filter(F.col("state").isNotNull()).select("gram", "cls", "doc", "place", "state"), "spans")
    size = F.when(F.col("cls") < 0, -F.col("cls")).otherwise(F.col("cls").bitwiseAND(127) + length - 1)
    settled = kept.filter("state = 'cut'").select("doc", "place", size.alias("n"))

    left = kept.filter("state = 'open'")
    warm = left.groupBy("gram").agg(F.count("*").alias("k")).filter(F.col("k") > hot).select("gram")
    packed = given.select("doc_id", "doc", "tag", "text").mapInArrow(_packed, "doc_id long, doc long, tag long, packed binary")

    def with_text(open_spans: DataFrame) -> DataFrame:
        by_doc = open_spans.groupBy("doc", F.col("place").bitwiseAND(0xFFFFFFFF).alias("tag")).agg(F.collect_list(F.struct("gram", "cls", "place")).alias("spans"))
        return packed.join(by_doc, ["doc", "tag"]).select("doc", "packed", "spans")

    cool = left.join(warm, "gram", "left_anti")
    sorted_ = (with_text(cool).mapInArrow(_span_bytes(length, False), "gram long, doc long, place long, bytes binary")
               .repartition("gram").sortWithinPartitions("gram").mapInArrow(_sort_rows(length), "doc long, place long, n long"))
    found = settled.unionByName(sorted_)
    if not warm.isEmpty():
        windows = stage(with_text(left.join(warm, "gram", "left_semi")).mapInArrow(_span_bytes(length, True), "w1 long, w2 long, doc long, place long"), "windows")
        at = F.struct("doc", F.shiftright("place", 32).alias("start"))
        first = windows.groupBy("w1", "w2").agg(F.min(at).alias("first"))
        found = found.unionByName(windows.join(first, ["w1", "w2"]).filter(at != F.col("first")).select("doc", "place", F.lit(length).cast("long").alias("n")))
    return found.select("doc", F.col("place").bitwiseAND(0xFFFFFFFF).alias("tag"), F.shiftright("place", 32).alias("start"), "n")


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").select(
        "doc_id", F.coalesce("doc_id", F.lit(_LAST)).alias("doc"), F.xxhash64("text").bitwiseAND(0xFFFFFFFF).alias("tag"), "text")


def dedup(docs: DataFrame, length: int = 100, hot: int = HOT) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256), one row per row of ``docs``."""
    found = stage(repeats(docs, length, hot), "repeats")
    by_doc = found.groupBy("doc", "tag").agg(F.collect_list(F.struct("start", "n")).alias("spans"))
    packed = _keyed(docs).mapInArrow(_packed, "doc_id long, doc long, tag long, packed binary")
    return (packed.join(by_doc, ["doc", "tag"], "left").select("doc_id", "packed", "spans")
            .mapInArrow(_cut, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"))
