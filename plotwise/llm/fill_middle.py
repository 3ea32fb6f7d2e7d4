"""Fill-in-middle transformation: texts cut into prefix, middle and suffix at unit ends, and put in another order.

A unit is a run of ASCII letters or any other single code point, as ``[A-Za-z]+|[^A-Za-z]`` matches from the left. Units are never
listed: the UTF-8 bytes are viewed as 64-bit words, and every byte that ends a unit is marked in its top bit by arithmetic on whole
words (a byte ends a unit unless the next one continues its code point, or both are letters). ``bitwise_count`` gives the
units of a word, and their running sum is searched for the word that holds the cut; the cut's byte is found by clearing
the word's lowest marks. Code points are counted the same way.

The cuts come from a hash of the id alone, so a rerun, or a lost executor, gives the same result.

Forms: ``plain`` (the text as it is), ``psm`` (prefix, suffix, middle) and ``spm`` (suffix, prefix, middle), each part behind its
sentinel. A text that is empty or holds a sentinel stays plain, so ``restored`` gives back every text exactly.

Defined results: a null text is an empty one; a null id is hashed as an empty text; repeated rows give equal rows; texts of any
length are cut whole (their bytes are held once, with eight more for each eight); an empty table gives an empty result; extra
columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plotwise.llm.text import buffer, slices

#: Sentinels of prefix, suffix and middle.
SENTINELS = ("<P>", "<S>", "<M>")
#: Of 100 texts, those that stay plain beyond, and of the others those whose suffix comes first.
FIM_PERCENT, SPM_PERCENT = 90, 20
SEED = "1"

_U = np.uint64
_LOW, _HIGH = _U(0x0101010101010101), _U(0x8080808080808080)
_CASE, _SEVEN = _U(0x20) * _LOW, _U(0x7F) * _LOW
_FROM_A, _AFTER_Z = _U(0x80 - 0x61) * _LOW, _U(0x80 - 0x7B) * _LOW


def letters(x: np.ndarray) -> np.ndarray:
    """Words with the top bit of every byte that is an ASCII letter."""
    low = (x | _CASE) & _SEVEN
    return (low + _FROM_A) & ~(low + _AFTER_Z) & ~x & _HIGH


def continuations(x: np.ndarray) -> np.ndarray:
    """Words with the top bit of every byte 10xxxxxx."""
    return x & ~(x << _U(1)) & _HIGH


def unit_ends(x: np.ndarray) -> np.ndarray:
    """Words with the top bit of every byte that ends a unit; the last byte is followed by zeros."""
    def following(marks):  # those of the next byte
        out = marks >> _U(8)
        out[:-1] |= marks[1:] << _U(56)
        return out

    letter = letters(x)
    return _HIGH & ~following(continuations(x)) & ~(letter & following(letter))


def aligned(buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The texts as 64-bit words, each from a word of its own on and with a zero byte at its end at least; first words."""
    size = np.diff(off)
    first = np.concatenate([[0], np.cumsum(size // 8 + 1)])
    out = np.zeros(int(first[-1]) * 8, np.uint8)
    for a, b, at in zip(off[:-1].tolist(), off[1:].tolist(), (first[:-1] * 8).tolist(), strict=True):
        out[at : at + b - a] = buf[a:b]
    return out.view("<u8"), first


def select(marks: np.ndarray, total: np.ndarray, k: np.ndarray) -> np.ndarray:
    """Byte after the k-th mark (k from 1; 0: byte 0). ``total``: marks up to each word, inclusive."""
    word = np.searchsorted(total, k, "left")
    x = marks[np.minimum(word, len(marks) - 1)]
    rank = k - (total[word - 1] * (word > 0))
    for i in range(1, 8):  # clears the marks before it
        x = np.where(rank > i, x & (x - _U(1)), x)
    byte = np.bitwise_count((x & (~x + _U(1))) - _U(1)) >> 3
    return np.where(k > 0, word * 8 + byte + 1, 0)


def cut_bytes(buf: np.ndarray, off: np.ndarray, draws: np.ndarray) -> tuple[np.ndarray, ...]:
    """Number of units of every text, and of its first two parts (after draws[0] % (n + 1) and draws[1] % (n + 1) units, in
    order) the ends in bytes and the sizes in code points."""
    x, first = aligned(buf, off)
    marks = unit_ends(x)
    total = np.cumsum(np.bitwise_count(marks), dtype=np.int64)
    size = np.diff(off)
    before = np.where(first[:-1] > 0, total[first[:-1] - 1], 0)
    n = total[first[1:] - 1] - before - (8 * np.diff(first) - size)  # the zeros after a text are marked, too
    cuts = np.sort(draws % (n + 1), axis=0)
    starts = _HIGH & ~continuations(x)
    points = np.cumsum(np.bitwise_count(starts), dtype=np.int64)

    ends, chars = [], []
    for k in cuts:
        # the marks of earlier texts come first
        at = np.where(k > 0, select(marks, total, k + before), first[:-1] * 8)
        word, rest = at >> 3, (at & 7).astype(np.uint64)
        inside = np.bitwise_count(starts[word] & ((_U(1) << (rest * _U(8))) - _U(1)))
        chars.append(np.where(word > 0, points[word - 1], 0) + inside)
        ends.append(at - first[:-1] * 8)
    base = np.where(first[:-1] > 0, points[first[:-1] - 1], 0)
    return n, ends[0], ends[1], chars[0] - base, chars[1] - chars[0]


def _rows(fim_percent: int, spm_percent: int, sentinels: tuple[str, str, str]):
    p, s, m = (t.encode() for t in sentinels)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            buf, off = buffer(b.column("text"))
            h = np.stack([b.column(f"h{i}").to_numpy() for i in range(1, 5)])
            n, one, two, n_prefix, n_middle = cut_bytes(buf, off, h[:2])
            form, out = [], []
            raw = buf.tobytes()
            for i, (a, e) in enumerate(zip(off[:-1].tolist(), off[1:].tolist(), strict=True)):
                text = raw[a:e]
                if h[2, i] % 100 >= fim_percent or not text or p in text or s in text or m in text:
                    form.append("plain")
                    out.append(text)
                    continue
                prefix, middle, suffix = text[: one[i]], text[one[i] : two[i]], text[two[i] :]
                if h[3, i] % 100 < spm_percent:
                    form.append("spm")
                    out.append(b"".join((s, suffix, p, prefix, m, middle)))
                else:
                    form.append("psm")
                    out.append(b"".join((p, prefix, s, suffix, m, middle)))
            plain = np.array([f == "plain" for f in form], bool)
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(n, pa.int64()), pa.array(form, pa.string()), pa.array(n_prefix, pa.int64(), mask=plain), pa.array(n_middle, pa.int64(), mask=plain),
                 pa.array(out, pa.binary()).cast(pa.string())], ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"])

    return rows


def transform(docs: DataFrame, seed: str = SEED, fim_percent: int = FIM_PERCENT, spm_percent: int = SPM_PERCENT, sentinels: tuple[str, str, str] = SENTINELS) -> DataFrame:
    """(doc_id, n, form, prefix_chars, middle_chars, output), one row per row of ``docs``; n: units of the text; the sizes are in
    code points, null for plain texts."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    draws = [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long").alias(f"h{i + 1}") for i in range(4)]
    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", *draws)
            .mapInArrow(_rows(fim_percent, spm_percent, sentinels), "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string"))


def restored(output: Column, form: Column, sentinels: tuple[str, str, str] = SENTINELS) -> Column:
    """The text that ``transform`` made ``output`` from."""
    parts = F.split(output, "|".join(f"(?:{re.escape(s)})" for s in sentinels), -1)
    at = lambda *order: F.concat(*[F.get(parts, i) for i in order])
    return F.when(form == "psm", at(1, 3, 2)).when(form == "spm", at(2, 3, 1)).otherwise(output)
