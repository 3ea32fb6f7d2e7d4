import pytest
from pyspark.sql import functions as F

from plotwise.llm import mixing as M


def fill(sizes, weights=(3, 1, 2), budget=1.5, cap=2.0):
    """The rule as told: deal by weight, cut at the cap, deal the excess again."""
    order = sorted(sizes, key=lambda s: (s is None, s))
    w = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    target, capped = {}, set()
    while True:
        left = budget * sum(sizes.values()) - sum(cap * sizes[s] for s in capped)
        free = [s for s in order if s not in capped]
        target = {s: cap * sizes[s] if s in capped else left * w[s] / sum(w[x] for x in free) for s in order}
        over = {s for s in free if target[s] > cap * sizes[s]}
        if not over:
            return target
        capped |= over


@pytest.mark.parametrize("sizes", [{"a": 10, "b": 100, "c": 20}, {"a": 5, None: 500, "z": 1, "é": 70, "Z": 40}, {"one": 7}, {f"s{i}": (i * 37) % 101 + 1 for i in range(40)}, {"a": 0, "b": 10}])
def test_targets(spark, sizes):
    got = M.source_targets(spark.createDataFrame(list(sizes.items()), "source string, source_size long"))
    want = fill(sizes)
    assert {r.source: pytest.approx(r.target) for r in got.collect()} == want


def test_counts_words_and_takes(documents):
    docs = documents((1, "a b\tc\x0bd"), (2, None), (3, "", "t"), (4, "x y z", None), (None, "w", "t"), (4, "x y z", None))
    got = M.mix_counts(docs).collect()
    assert sorted(r["size"] for r in got) == [0, 0, 1, 2, 2, 4] and len(got) == 6
    for r in got:
        assert r.taken <= 2 * r["size"] and abs(r.copies - r.target / r.source_size) < 1
    assert sorted(map(tuple, got), key=repr) == sorted(map(tuple, M.mix_counts(docs).collect()), key=repr)
    assert M.mix_counts(docs.limit(0)).count() == 0


def test_taken_comes_near_the_target(documents):
    docs = documents(*[(i, "w " * (i * 7919 % 50 + 1), f"s{i % 7}") for i in range(4000)])
    for r in M.mix_counts(docs).groupBy("source").agg(F.first("target").alias("t"), F.sum("taken").alias("n")).collect():
        assert r.n == pytest.approx(r.t, rel=0.1)


def test_mix_repeats_rows_and_keeps_columns(documents):
    docs = documents(*[(i, f"w{i} x", "ab"[i % 2]) for i in range(50)]).withColumn("_size", F.lit("own")).withColumn("target", F.lit(1))
    out = M.mix(docs)
    assert out.columns == docs.columns
    want = {(r.doc_id, r.copies) for r in M.mix_counts(docs).collect() if r.copies}
    assert {(r.doc_id, r["count"]) for r in out.groupBy("doc_id").count().collect()} == want


def test_rows_without_an_id_are_drawn_apart(documents):
    docs = documents(*[(None, f"w{i} x", "ab"[i % 2]) for i in range(400)])
    got = M.mix_counts(docs)
    # every row of a source has the same size: only the text tells them apart
    for r in got.groupBy("source").agg(F.first("target").alias("t"), F.sum("taken").alias("n"), F.first("source_size").alias("size")).collect():
        assert r.n == pytest.approx(r.t, rel=0.15)
    assert M.mix(docs).count() == got.agg(F.sum("copies")).first()[0]
