import hashlib
import random
import re

import numpy as np
import pytest

from plotwise.llm import suffix_dedup as S
from plotwise.llm.text import prefix_hashes


def brute(rows, length=100):
    """By document key: later windows of equal bytes, in (doc_id, start) order."""
    last = 2**63 - 1
    first = {}
    for i, t in rows:
        b, i = (t or "").encode(), last if i is None else i
        for s in range(len(b) - length + 1):
            w = b[s : s + length]
            first[w] = min(first.get(w, (i, s)), (i, s))
    out = []
    for i, t in rows:
        b = (t or "").encode()
        mask = bytearray(len(b))
        for s in range(len(b) - length + 1):
            if first[b[s : s + length]] < (last if i is None else i, s):
                mask[s : s + length] = b"\1" * length
        kept = bytes(x for x, m in zip(b, mask, strict=True) if not m)
        out.append((i, len(b), sum(mask), len(re.findall(b"\1+", bytes(mask))), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def solved(df, **options):
    return sorted(map(tuple, S.dedup(df, **options).collect()), key=repr)


def texts(seed=0, n=40):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdéß") for _ in range(rng.randint(1, 6)))
    shared = [" ".join(word() for _ in range(60)) for _ in range(4)]
    out = []
    for _ in range(n):
        parts = [" ".join(word() for _ in range(rng.randint(0, 40)))]
        for _ in range(rng.randint(0, 3)):
            s = rng.choice(shared)
            a = rng.randint(0, len(s) // 2)
            piece = s[a : a + rng.randint(60, 260)]
            if rng.random() < 0.3:
                k = rng.randrange(len(piece))
                piece = piece[:k] + "#" + piece[k + 1 :]
            parts += [piece, word()]
        out.append(" ".join(parts))
    return out + ["x" * 400, "x" * 99, "x" * 250, "ab" * 300, "", None, "y" * 100, "y" * 100, "z" * 101]


@pytest.mark.parametrize("hot", [20_000, 2])
def test_matches_brute_force(documents, hot):
    rows = list(enumerate(texts(1)))
    assert solved(documents(*rows), hot=hot) == brute(rows)


def test_pieces_and_slices_make_no_difference(documents, monkeypatch):
    rows = list(enumerate(texts(2, 15)))
    whole = "".join(t or "" for _, t in rows) * 2
    monkeypatch.setattr(S, "PIECE", 300)
    from pyarrow import RecordBatch, array, int64, string
    def spans(piece):
        monkeypatch.setattr(S, "PIECE", piece)
        b = RecordBatch.from_arrays([array([1], int64()), array([7], int64()), array([whole], string())], ["doc", "tag", "text"])
        covered = set()
        for out in S._anchor_rows(100)(iter([b])):
            for cls, place in zip(out.column("cls").to_pylist(), out.column("place").to_pylist(), strict=True):
                if cls >= 0:
                    covered |= set(range(place >> 32, (place >> 32) + (cls & 127)))
        return covered
    assert spans(1 << 20) <= set(range(len(whole.encode())))
    n = len(whole.encode()) - 99
    assert len(spans(300) | set()) > 0 and max(spans(300)) < n


def test_repeated_rows_nulls_and_clashing_ids(documents):
    long = "".join(chr(97 + i * 7 % 26) + str(i) for i in range(100))
    rows = [(5, long), (5, long), (None, long), (6, "!" + long), (5, long[:150] + "other"), (7, None), (8, "")]
    got = solved(documents(*rows))
    assert got == brute(rows)
    assert solved(documents(*rows).limit(0)) == []


def test_crafted_texts(documents):
    # Thue-Morse words collide as polynomials mod 2**64 from 1,024 letters on; spans are shorter
    bits = [bin(i).count("1") % 2 for i in range(4096)]
    rows = [(i, "".join(ab[k] for k in bits[:m])) for i, (m, ab) in enumerate((m, ab) for m in (1024, 2048, 4096) for ab in ("ab", "ba"))]
    assert solved(documents(*rows)) == brute(rows)


def test_collisions_are_verified(monkeypatch):
    # with hashes that tell nothing apart, classes still follow the bytes
    monkeypatch.setattr(S, "span_hashes", lambda prefix, a, b: np.zeros(np.broadcast(a, b).shape, np.uint64))
    spans = [b"a" * 60 + bytes([i % 3]) + b"b" * 60 for i in range(9)]
    span, offset, number = S.equal_windows(spans, np.zeros(9, int), np.full(9, 10), 100)
    seen = {}
    for s, o, n in zip(span, offset, number, strict=True):
        assert seen.setdefault((spans[s][o : o + 100], 10 - o), n) == n
    assert len(set(seen.values())) == len(seen)


def test_merge_sort_orders_suffixes():
    rng = np.random.default_rng(0)
    buf = rng.integers(97, 99, 5000).astype(np.uint8)
    suffix = rng.permutation(4000)[:900]
    group = np.sort(rng.integers(0, 6, 900))
    order = S.merge_sort(buf, prefix_hashes(buf), suffix, group, 100)
    assert np.array_equal(group[order], group)
    got = [(g, buf[s : s + 100].tobytes()) for g, s in zip(group, suffix[order], strict=True)]
    assert got == sorted(got)
