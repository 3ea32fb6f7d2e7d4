"""Vectorised word splitting and hashing of Arrow text batches.

Texts stay UTF-8 bytes in one buffer per slice (bounded by ``SLICE_BYTES``; a longer single
text is a slice of its own). Hashes are polynomial over random byte codes mod 2**64, with a final
mixing step; equal spans have equal hashes, and what depends on equality is verified by the caller
or keyed by two independent hashes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 20

_U = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_INV = pow(_BASE, -1, 1 << 64)
_CODES = np.random.Generator(np.random.PCG64(20240607)).integers(1, 1 << 63, 256, dtype=np.int64).astype(_U)
_CODES = _CODES * _U(2) + _U(1)

BLANK = np.zeros(256, bool)
BLANK[[0x20, *range(0x09, 0x0E)]] = True
#: Bytes of words as in ``[^\x20\x09-\x0D]+``.
NOT_BLANK = ~BLANK
#: Bytes of words without ASCII punctuation.
ALNUM = np.zeros(256, bool)
ALNUM[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True
#: Lower-cases A-Z only.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_pow = _ipow = np.ones(1, _U)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _pow, _ipow
    if len(_pow) < n:
        size = max(n, SLICE_BYTES + 1)
        up, down = np.full(size, _BASE, _U), np.full(size, _INV, _U)
        up[0] = down[0] = 1
        if size > 2 * SLICE_BYTES:  # a single very long text: don't keep its tables
            return np.multiply.accumulate(up), np.multiply.accumulate(down)
        _pow, _ipow = np.multiply.accumulate(up), np.multiply.accumulate(down)
    return _pow, _ipow


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: spreads every input bit over the word."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> _U(27))
    x = x * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def buffer(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts (null: empty) and their n+1 offsets."""
    if texts.null_count:
        texts = texts.fill_null("")
    width = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    off = np.frombuffer(texts.buffers()[1], width)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64) if len(texts) else np.zeros(1, np.int64)
    data = texts.buffers()[2]
    buf = np.frombuffer(data, np.uint8)[off[0] : off[-1]] if data is not None else np.zeros(0, np.uint8)
    return buf, off - off[0]


def slices(batches, column: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cuts record batches so that each slice holds at most ``limit`` bytes of text, or one row."""
    for batch in batches:
        texts = batch.column(column)
        if not len(texts):
            continue
        _, off = buffer(texts)
        a = 0
        while a < len(texts):
            b = max(a + 1, int(np.searchsorted(off, off[a] + limit, "right")) - 1)
            yield batch.slice(a, b - a)
            a = b


def word_spans(buf: np.ndarray, off: np.ndarray, chars: np.ndarray = NOT_BLANK) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and row of every word; words never cross rows."""
    if not len(buf):
        z = np.zeros(0, np.int64)
        return z, z, z
    w = chars[buf]
    before = np.empty_like(w)
    before[0], before[1:] = False, w[:-1]
    first = off[:-1]
    before[first[first < len(buf)]] = False
    after = np.empty_like(w)
    after[-1], after[:-1] = False, w[1:]
    after[off[1:][off[1:] > 0] - 1] = False
    starts, ends = np.flatnonzero(w & ~before), np.flatnonzero(w & ~after) + 1
    return starts, ends, np.searchsorted(off, starts, "right") - 1


def prefix_hashes(buf: np.ndarray) -> np.ndarray:
    out = np.zeros(len(buf) + 1, _U)
    np.cumsum(_CODES[buf] * _powers(len(buf) + 1)[0][: len(buf)], out=out[1:])
    return out


def span_hashes(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of each span [start, end), the same wherever it stands."""
    return (prefix[end] - prefix[start]) * _powers(len(prefix))[1][start]


def words_array(buf: np.ndarray, start: np.ndarray, end: np.ndarray, chars: np.ndarray | None = None) -> pa.Array:
    """The words as an Arrow array; ``chars``, if given, marks the bytes that words are made of (and nothing else is)."""
    if chars is None:
        inside = np.zeros(len(buf) + 1, np.int8)
        inside[start] += 1
        inside[end] -= 1  # adjacent words: the end of one is the start of the next
        inside = np.cumsum(inside[:-1], dtype=np.int8) > 0
    else:
        inside = chars[buf]
    off = np.zeros(len(start) + 1, np.int64)
    np.cumsum(end - start, out=off[1:])
    kind, width = (pa.binary(), np.int32) if off[-1] < 2**31 else (pa.large_binary(), np.int64)
    return pa.Array.from_buffers(kind, len(start), [None, pa.py_buffer(off.astype(width)), pa.py_buffer(buf[inside])])


#: Words beyond this many bytes are hashed by blake2b.
LONG_WORD = 64


def bytes_hashes(words: pa.Array, seed: int = 0) -> np.ndarray:
    """64-bit hash of every word of an Arrow binary array without nulls: a chain of mixers over its 8-byte pieces."""
    width = np.int64 if pa.types.is_large_binary(words.type) else np.int32
    off = np.frombuffer(words.buffers()[1], width)[words.offset : words.offset + len(words) + 1].astype(np.int64) if len(words) else np.zeros(1, np.int64)
    data = words.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    size = np.diff(off)
    out = mix(size.astype(_U) + _U((seed * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) % 2**64))
    padded, step = np.concatenate([data, np.zeros(8, np.uint8)]), np.arange(8)
    live, at = np.flatnonzero((size > 0) & (size <= LONG_WORD)), 0
    while len(live):
        piece = padded[(off[live] + at)[:, None] + step]
        piece[step >= (size[live] - at)[:, None]] = 0
        out[live] = mix((out[live] ^ piece.view("<u8")[:, 0]) * _U(0xD6E8FEB86659FD93) + _U(at + 1))
        at += 8
        live = live[size[live] > at]
    for i in np.flatnonzero(size > LONG_WORD).tolist():
        digest = hashlib.blake2b(data[off[i] : off[i + 1]], digest_size=8, key=seed.to_bytes(8, "little")).digest()
        out[i] = int.from_bytes(digest, "little")
    return out


def word_hashes(buf: np.ndarray, start: np.ndarray, end: np.ndarray, chars: np.ndarray | None = NOT_BLANK, seed: int = 0) -> np.ndarray:
    """Hash of every word; each distinct word is hashed once."""
    coded = words_array(buf, start, end, chars).dictionary_encode()
    return bytes_hashes(coded.dictionary, seed)[coded.indices.to_numpy()]


def shingles(buf: np.ndarray, off: np.ndarray, n: int, chars: np.ndarray = NOT_BLANK, short: bool = True) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, row and first word (number within its row) of every n-word shingle of the lower-cased
    texts; with ``short``, a text of fewer words gives one shingle of all its words."""
    low = LOWER[buf]
    s, e, row = word_spans(low, off, chars)
    z = np.zeros(0, np.int64)
    if not len(s):
        return z.astype(_U), z, z
    w = word_hashes(low, s, e, chars)
    first = np.searchsorted(row, np.arange(len(off) - 1))
    place = np.arange(len(row)) - first[row]
    k = _U(0xD6E8FEB86659FD93)
    h, r, at = z.astype(_U), z, z
    if len(w) >= n:
        full = row[: len(w) - n + 1] == row[n - 1 :]
        h = np.zeros(len(w) - n + 1, _U)
        for i in range(n):
            h = (h + w[i : len(w) - n + 1 + i]) * k
        h, r, at = mix(h)[full], row[: len(w) - n + 1][full], place[: len(w) - n + 1][full]
    if short:
        count = np.bincount(row, minlength=len(off) - 1)
        for m in range(1, n):
            rows = np.flatnonzero(count == m)
            if len(rows):
                x = np.full(len(rows), m, _U)
                for i in range(m):
                    x = (x + w[first[rows] + i]) * k
                h, r, at = np.concatenate([h, mix(x)]), np.concatenate([r, rows]), np.concatenate([at, np.zeros(len(rows), np.int64)])
    return h, r, at


def distinct(h: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (row, hash), ordered by row, then hash."""
    order = np.lexsort((h, row))
    h, row = h[order], row[order]
    keep = np.ones(len(h), bool)
    keep[1:] = (h[1:] != h[:-1]) | (row[1:] != row[:-1])
    return h[keep], row[keep]
