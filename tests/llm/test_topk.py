import math
import random

import pytest
from pyspark.sql import functions as F

from plotwise.llm.topk import search_block, top_k

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, queries, k=5):
    usable = [(i, [math.floor(256 * float(x)) for x in v]) for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    out = set()
    for q, v in usable:
        if q in queries:
            found = sorted((-sum(a * b for a, b in zip(v, w, strict=True)), c) for c, w in usable if c != q and len(w) == len(v))
            out |= {(q, r + 1, c, -s) for r, (s, c) in enumerate(found[:k])}
    return out


def vectors(n, dims=12, seed=1):
    rng = random.Random(seed)
    return [(i, [rng.randint(-64, 64) / 64 for _ in range(dims)]) for i in range(n)]


@pytest.mark.parametrize("candidates,queries", [(8192, 2048), (16, 3)])
def test_matches_brute_force_with_ties(spark, candidates, queries):
    rows = vectors(120) + [(200, [0.5] * 12), (201, [0.5] * 12), (202, [0.5] * 12)]
    df = spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA)
    got = top_k(df, df.filter(F.col("vec_id") % 10 == 0), candidates=candidates, query_block=queries)
    assert {(r.query_id, r.rank, r.vec_id, r.score) for r in got.collect()} == brute(rows, {i for i, _ in rows if i % 10 == 0})


def test_unusable_vectors_take_no_part(spark):
    rows = [(0, [1.0, 2.0]), (1, None), (2, []), (3, [1.0, None]), (4, [float("nan"), 1.0]), (5, [float("inf"), 1.0]), (6, [1.0, 1.0]), (None, [9.0, 9.0]), (7, [1.0, 1.0, 1.0])]
    df = spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA)
    got = top_k(df, df)
    assert {(r.query_id, r.vec_id) for r in got.collect()} == {(0, 6), (6, 0)}


def test_repeated_rows_and_empty_table(spark):
    df = spark.createDataFrame([(0, [1.0], 0), (0, [1.0], 0), (1, [2.0], 0), (1, [2.0], 0), (2, [-0.001], 0)], SCHEMA)
    got = top_k(df, df.filter("vec_id = 0")).select("query_id", "rank", "vec_id", "score").collect()
    assert sorted(map(tuple, got)) == [(0, 1, 1, 256 * 512), (0, 2, 1, 256 * 512), (0, 3, 2, -256)]
    assert top_k(df.limit(0), df.limit(0)).count() == 0


def test_large_components_stay_exact(spark):
    df = spark.createDataFrame([(0, [2.0**40, 1.0], 0), (1, [2.0**40, 1.0], 0), (2, [2.0**40, 2.0], 0), (3, [2.0**100, 0.0], 0)], SCHEMA)
    got = {r.vec_id: r.score for r in top_k(df, df.filter("vec_id = 0")).collect()}
    assert got[3] == 2**63 - 1 and got[2] == 2**63 - 1 and set(got) == {1, 2, 3}


def test_pruning_never_loses_a_tie():
    import numpy as np
    rng = np.random.default_rng(3)
    columns = rng.integers(-3, 4, (24, 400)).astype(float)
    queries = rng.integers(-3, 4, (6, 24)).astype(float)
    ids = np.arange(400)
    for i, found, score in search_block(queries, np.full(6, -1), ids, columns, 5, stride=2):
        whole = queries[i] @ columns
        order = np.lexsort((ids, -whole))[:5]
        assert found.tolist() == order.tolist() and score.tolist() == whole[order].tolist()


def test_a_known_bound_drops_only_what_it_excludes():
    import numpy as np
    rng = np.random.default_rng(5)
    columns = rng.integers(-3, 4, (24, 300)).astype(float)
    queries = rng.integers(-3, 4, (6, 24)).astype(float)
    ids, none = np.arange(300), np.full(6, -1)
    free = {i: list(zip(score.tolist(), found.tolist(), strict=True)) for i, found, score in search_block(queries, none, ids, columns, 5, stride=2)}
    for cut in (0, 2, 4):
        least = np.array([free[i][cut][0] for i in range(6)], float)
        for i, found, score in search_block(queries, none, ids, columns, 5, stride=2, least=least):
            assert list(zip(score.tolist(), found.tolist(), strict=True)) == [x for x in free[i] if x[0] >= least[i]]


def test_bounds_carry_over_vectors_of_several_lengths(spark):
    rows = vectors(60, 12) + [(i + 100, v) for i, v in vectors(50, 7, seed=2)] + [(300, [1.0] * 3), (301, [0.5] * 3)]
    df = spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA)
    got = top_k(df, df.filter(F.col("vec_id") % 10 == 0), candidates=9, query_block=4)
    assert {(r.query_id, r.rank, r.vec_id, r.score) for r in got.collect()} == brute(rows, {i for i, _ in rows if i % 10 == 0})
