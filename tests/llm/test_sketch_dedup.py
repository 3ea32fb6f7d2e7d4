import random
import re

import numpy as np
import pytest

from plotwise.llm import sketch_dedup as S

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(rows, window=35):
    """Rows (id, words, removed, kept), in id order."""
    split = [WORD.findall(t or "") for _, t in rows]
    seen = {}
    for w in split:
        for s in range(len(w) - window + 1):
            seen[tuple(w[s : s + window])] = seen.get(tuple(w[s : s + window]), 0) + 1
    out = []
    for (i, _), w in zip(rows, split, strict=True):
        gone = {k for s in range(len(w) - window + 1) if seen[tuple(w[s : s + window])] > 1 for k in range(s, s + window)}
        out.append((i, len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone)))
    return sorted(out, key=repr)


def solved(df, **options):
    return sorted(map(tuple, S.dedup(df, **options).collect()), key=repr)


def texts(seed, n=60, words=300, vocabulary=400):
    rng = random.Random(seed)
    word = lambda: f"w{rng.randrange(vocabulary)}é"
    gap = lambda: rng.choice([" ", "  ", "\n", "\t\x0b", " \r\n "])
    shared = [[word() for _ in range(120)] for _ in range(5)]
    out = []
    for _ in range(n):
        w = [word() for _ in range(rng.randrange(words))]
        for _ in range(rng.randrange(3)):
            s = rng.choice(shared)
            a = rng.randrange(70)
            part = s[a : a + rng.randint(30, 60)]
            if rng.random() < 0.3:
                part[rng.randrange(len(part))] = "edited"
            at = rng.randrange(len(w) + 1)
            w[at:at] = part
        out.append(gap().join([""] * rng.randrange(2) + w) + gap() * rng.randrange(2))
    return out + ["a " * 200, "a " * 34, "a b " * 100, "", None, " \n", "x" * 5000, out[3], out[3], "Ab " * 36, "ab " * 36]


@pytest.mark.parametrize("options", [{}, {"max_bytes": 512}, {"window": 9}])
def test_matches_brute_force(documents, options):
    # 512 bytes: nearly every counter reaches two, so the exact pass does all the work
    rows = list(enumerate(texts(1)))
    assert solved(documents(*rows), **options) == brute(rows, options.get("window", 35))


def test_long_texts_in_pieces(documents, monkeypatch):
    monkeypatch.setattr(S, "PIECE", 700)
    rows = [(i, t) for i, t in enumerate(texts(2, 20, 900))] + [(99, "z" * 3000 + " " + texts(2, 20, 900)[2])]
    found = {}
    for i, t in rows:  # every window of every text is in one span, whatever the pieces
        import pyarrow as pa
        b = pa.RecordBatch.from_arrays([pa.array([t], pa.string())], ["text"])
        got = []
        for buf, off, number in S._pieces(b, 35):
            row, start, count, *_ = S._spans(buf, off, 35)
            got += S._expand(start + number, count).tolist()
        found[i] = got
        assert sorted(got) == list(range(max(0, len(WORD.findall(t or "")) - 34))), i


def test_sketch_never_underestimates():
    rng = np.random.default_rng(0)
    anchors = rng.integers(0, 1 << 62, 3000).astype(np.uint64)
    width = 2000
    some = np.concatenate([anchors, anchors[:700]])
    parts = []
    for part in np.array_split(rng.permutation(some), 5):
        at, n = np.unique(S.cells(part, width), return_counts=True)
        parts.append((at, n))
    import pyarrow as pa
    import zstandard
    z = zstandard.ZstdCompressor()
    batches = []
    for at, n in parts:
        planes = np.zeros((2, S.BLOCK), bool)
        planes[0, at], planes[1, at[n > 1]] = True, True
        one, two = (z.compress(np.packbits(p).tobytes()) for p in planes)
        batches.append(pa.RecordBatch.from_arrays([pa.array([0], pa.int64()), pa.array([one], pa.binary()), pa.array([two], pa.binary())], ["block", "one", "two"]))
    (merged,) = S._merged_rows(iter(batches))
    sketch = S.Sketch(width, np.frombuffer(zstandard.decompress(merged.column("two")[0].as_py()), np.uint8))
    assert sketch.may_repeat(anchors[:700]).all()
    wide = S.Sketch(100_000, np.zeros(100_000, np.uint8))
    assert not wide.may_repeat(anchors).any()


def test_nulls_repeated_rows_clashing_ids_and_columns(spark, documents):
    long = " ".join(f"v{i}" for i in range(80))
    rows = [(5, long), (5, long), (None, "x " + long), (6, long + " tail"), (6, "other words " * 30), (7, None), (8, ""), (None, None), (9, " ".join(f"u{i}" for i in range(60)))]
    df = documents(*rows)
    assert solved(df) == brute(rows)
    assert solved(df.withColumnRenamed("lang", "doc").withColumnRenamed("source", "tag").withColumnRenamed("n_chars", "starts")) == brute(rows)
    assert solved(df.limit(0)) == []
    alone = [(1, long), (None, " ".join(f"q{i}" for i in range(50)))]
    assert solved(documents(*alone)) == brute(alone)


def test_words_of_crafted_sequences(documents):
    # Thue-Morse words, alike in every position sum, don't pass for each other
    bits = [bin(i).count("1") % 2 for i in range(4096)]
    a, b = "".join("xy"[k] for k in bits), "".join("yx"[k] for k in bits)
    tail = " ".join(f"t{i}" for i in range(34))
    rows = [(1, f"{a} {tail}"), (2, f"{b} {tail}"), (3, " ".join("pq"[k] for k in bits[:64])), (4, " ".join("qp"[k] for k in bits[:64]))]
    assert solved(documents(*rows)) == brute(rows)


def test_hot_group(documents):
    shared = " ".join(f"s{i}" for i in range(50))
    rows = [(i, f"{shared} u{i} " + " ".join(f"r{i}x{k}" for k in range(40)) if i % 3 == 0 else " ".join(f"d{i}x{k}" for k in range(60))) for i in range(400)]
    assert solved(documents(*rows).repartition(7)) == brute(rows)
