import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from plotwise.llm import ranked_search as R

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(t):
    return TERM.findall(re.sub("[A-Z]+", lambda m: m[0].lower(), t or ""))


def brute(docs, items, k=10):
    counts = [Counter(terms(t)) for _, t in docs]
    n_docs, total = sum(bool(c) for c in counts), sum(sum(c.values()) for c in counts)
    df = Counter(t for c in counts for t in c)
    out = []
    for item, text in set(items):
        scored = []
        for (i, _), c in zip(docs, counts, strict=True):
            if not c:
                continue
            m = 10 + 90 * sum(c.values()) * n_docs // total
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m)) for t in set(terms(text)) if c[t])
            if s > 0:
                scored.append((-s, i is None, i or 0, i))
        out += [(item, n + 1, i, -s) for n, (s, _, _, i) in enumerate(sorted(scored, key=lambda x: x[:3])[:k])]
    return sorted(out, key=repr)


def found(docs, items, **options):
    return sorted((tuple(r)[:4] for r in R.search(docs, items, **options).collect()), key=repr)


def corpus(seed, n=400, vocabulary=80):
    rng = random.Random(seed)
    word = lambda: f"t{min(int(rng.paretovariate(0.7)), vocabulary)}" + rng.choice(["", "é", "X"])
    docs = [(i, " ".join(word() for _ in range(rng.randrange(1, 60)))) for i in range(n)]
    docs += [(n + i, docs[5][1]) for i in range(30)]  # copies: ties
    items = [(i, " ".join(word() for _ in range(rng.randrange(1, 15)))) for i in range(20)]
    return docs, items + [(50, " ".join(f"t{i}" for i in range(100))), (51, "nothing-known"), (52, docs[7][1])]


def items_table(spark, items):
    return spark.createDataFrame(items, "item_id long, text string")


@pytest.mark.parametrize("chunk, leaf", [(32_768, 256), (50, 4), (7, 1)])
def test_matches_brute_force(spark, documents, monkeypatch, chunk, leaf):
    docs, items = corpus(1)
    # the solver runs in this process, so that the small sizes hold in it
    monkeypatch.setattr(R, "CHUNK_DOCS", chunk)
    monkeypatch.setattr(R, "LEAF", leaf)
    counts = [Counter(terms(t)) for _, t in docs]
    vocab = R.Vocabulary(pa.array(sorted({t.encode() for _, x in items for t in terms(x)}), pa.binary()))
    names = [t.decode() for t in vocab.terms.to_pylist()]
    n_docs, total = len(docs), sum(sum(c.values()) for c in counts)
    df = np.array([sum(t in c for c in counts) for t in names])

    class Shared:
        value = []

    for _, text in items:
        t = np.unique(vocab.place(pa.array([x.encode() for x in set(terms(text))], pa.binary())))
        t = t[np.lexsort((t, -df[t]))]
        Shared.value.append(R.Item(t, np.array([R.weight(n_docs, int(d)) for d in df[t]])))
    vectors = list(zip(*[(i, sum(c.values()), [k for k, t in enumerate(names) if t in c], [c[t] for t in names if t in c]) for (i, _), c in zip(docs, counts, strict=True)], strict=True))
    batch = pa.RecordBatch.from_arrays([pa.array(vectors[0], pa.int64()), pa.array(vectors[1], pa.int64()), pa.array(vectors[2], pa.list_(pa.int32())), pa.array(vectors[3], pa.list_(pa.int64()))], ["doc_id", "n", "terms", "tfs"])
    (out,) = R._search_rows(Shared, (n_docs, total), 10)(iter([batch.slice(0, 123), batch.slice(123)]))
    got = sorted(((items[i][0], d, s) for i, d, s in zip(*[c.to_pylist() for c in out.columns], strict=True)), key=repr)
    assert got == sorted(((i, d, s) for i, _, d, s in brute(docs, items)), key=repr)


def test_search_over_tables(spark, documents):
    docs, items = corpus(2)
    assert found(documents(*docs).repartition(5), items_table(spark, items)) == brute(docs, items)
    assert found(documents(*docs), items_table(spark, items), k=3) == brute(docs, items, 3)


def test_blocks_of_items(spark, documents, monkeypatch):
    docs, items = corpus(3, 80)
    monkeypatch.setattr(R, "BLOCK_BYTES", 200)
    assert found(documents(*docs), items_table(spark, items)) == brute(docs, items)


def test_bounds_leave_subtrees(documents):
    rng = np.random.default_rng(0)
    n = 20_000
    tf = rng.integers(1, 4, (n, 12)) * (rng.random((n, 12)) < np.linspace(0.6, 0.02, 12))
    row, term = np.nonzero(tf)
    chunk = R.Chunk(np.arange(n), rng.integers(20, 400, n), row, term, tf[row, term])
    item = R.Item(np.arange(12), np.array([R.weight(n, int((tf[:, j] > 0).sum())) for j in range(12)]))
    best = R.Best(10)
    scored = R.Tree(chunk, item).search(best)
    scores = (item.weights * R.saturation(tf, chunk.m[:, None])).sum(axis=1)
    want = np.lexsort((np.arange(n), -scores))[:10]
    assert sorted(best.heap) == sorted((int(scores[i]), -int(i)) for i in want)
    assert scored < n / 4


def test_colliding_hashes_are_compared_by_bytes(monkeypatch):
    monkeypatch.setattr(R, "bytes_hashes", lambda words: np.array([len(w) for w in words.to_pylist()], np.uint64))
    vocab = R.Vocabulary(pa.array([b"ab", b"cd", b"x", b"ef"], pa.binary()))
    got = vocab.place(pa.array([b"ef", b"zz", b"x", b"ab", b"cd", b"abc", b"y"], pa.binary()))
    assert [vocab.terms[int(k)].as_py() if k >= 0 else None for k in got] == [b"ef", None, b"x", b"ab", b"cd", None, None]


def test_nulls_repeats_and_empty_tables(spark, documents):
    docs = [(None, "a b c"), (3, "a b c"), (3, "a b c"), (4, None), (5, ""), (6, "-- ,"), (7, "long " * 3000 + "a"), (8, "Σ a"), (None, "a")]
    items = [(1, "a"), (1, "a"), (None, "b long"), (2, None), (3, ""), (4, "--"), (5, "Σ ÀB")]
    df = documents(*docs).withColumnRenamed("lang", "part").withColumnRenamed("source", "score")
    assert found(df, items_table(spark, items)) == brute(docs, items)
    two = [(1, "a"), (1, "b")]  # two texts under an id are two items
    assert found(df, items_table(spark, two)) == brute(docs, two)
    assert found(df.limit(0), items_table(spark, items)) == []
    assert found(df, items_table(spark, items).limit(0)) == []
