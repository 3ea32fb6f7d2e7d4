"""Exact top-k search by columnar branch and bound.

Vectors are cut into blocks held in vertical layout (one row of numbers per dimension). For a query, the
inner products with a block are accumulated a few dimensions at a time; what the dimensions still to come
can add is bounded by the product of the remaining masses (norms) of query and candidate, and candidates
that can't reach the k-th best lower bound are compacted away. Results are exact, ties go to smaller ids.

Candidates are quantised and dealt to blocks once (staged). Every query meets one block first; the k-th score it finds
there is a bound for all other blocks, which give up candidates below it early and return only what reaches it. All query blocks
meet all candidate blocks, in tasks of bounded size; a block is moved once per ``QUERIES`` queries. The best
k rows of a query are taken by a window that Spark limits before it shuffles.

Defined results: vectors that are null or hold null, NaN or infinite components (also after scaling) take no part, nor do rows
with a null id; vectors only meet vectors of their own length (empty vectors none); a query doesn't
meet rows of its own id; repeated query rows (same id, same vector) are one query, repeated candidate rows
stay, each with a rank of its own; a score beyond a long is cut to the largest or smallest long.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from plotwise.llm.tables import stage

#: Vectors of a candidate block and of a query block.
CANDIDATES, QUERIES = 8192, 8192
#: Dimensions accumulated between two prunings.
STRIDE = 8


def quantised(vectors: DataFrame, id_col: str, vec_col: str, scale: float) -> DataFrame:
    """(id, v) with v = floor(scale * x), x as double; unusable rows left out."""
    y = F.transform(F.col(vec_col).cast("array<double>"), lambda e: e * F.lit(float(scale)))
    usable = F.col("_id").isNotNull() & (F.size("_y") > 0) & F.forall("_y", lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < F.lit(math.inf)))
    # from 2**52 on a double is an integer, and floor() would cut it to a long
    down = lambda e: F.when(F.abs(e) >= F.lit(2.0**52), e).otherwise(F.floor(e).cast("double"))
    return (vectors.select(F.col(id_col).cast("long").alias("_id"), y.alias("_y"))
            .filter(usable).select(F.col("_id").alias("id"), F.transform("_y", down).alias("v")))


def _exact(q: np.ndarray, c: np.ndarray) -> bool:
    """Whether double sums of products are exact: every partial sum is an integer below 2**53."""
    return float(np.abs(q).max(initial=0)) * float(np.abs(c).max(initial=0)) * max(len(c), 1) < 2**53


def search_block(queries: np.ndarray, own: np.ndarray, ids: np.ndarray, columns: np.ndarray, k: int, stride: int = STRIDE, least: np.ndarray | None = None) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each query row: (its number, ids, scores) of its best k in one candidate block.

    ``columns``: dimensions x candidates. ``own``: each query's id, which it doesn't meet. ``least``: a score that k candidates
    of each query are known to reach; lower ones needn't be returned.
    """
    dims, n = columns.shape
    if not _exact(queries, columns):
        yield from _search_large(queries, own, ids, columns, k)
        return
    edges = [*range(0, dims, stride), dims]
    rest = np.sqrt(np.stack([np.sum(columns[e:] ** 2, axis=0) for e in edges]))  # remaining mass at each edge
    for i, q in enumerate(queries):
        known = -math.inf if least is None else least[i]
        left = np.sqrt([np.sum(q[e:] ** 2) for e in edges])
        live = np.flatnonzero(ids != own[i])
        block = columns if len(live) == n else columns[:, live]
        score = np.zeros(len(live))
        for b in range(len(edges) - 1):
            score = score + q[edges[b] : edges[b + 1]] @ block[edges[b] : edges[b + 1]]
            if b + 2 < len(edges) and (len(live) > k or known > -math.inf):
                slack = left[b + 1] * rest[b + 1, live] * (1 + 1e-9) + 1e-6  # rounding of the norms
                low, floor = score - slack, known
                if len(live) > k:
                    floor = max(floor, np.partition(low, len(low) - k)[len(low) - k])
                keep = score + slack >= floor
                if keep.sum() < 0.75 * len(live):
                    live, score, block = live[keep], score[keep], block[:, keep]
        live, score = live[score >= known], score[score >= known]
        if len(score) > k:  # ties at the k-th score are all looked at
            keep = score >= np.partition(score, len(score) - k)[len(score) - k]
            live, score = live[keep], score[keep]
        order = np.lexsort((ids[live], -score))[:k]
        yield i, ids[live][order], score[order].astype(np.int64)


def _search_large(queries, own, ids, columns, k):
    """Components too large for exact doubles: Python integers, cut to a long at the end."""
    cand = [[int(x) for x in col] for col in columns.T]
    for i, q in enumerate(queries):
        whole = [int(x) for x in q]
        found = sorted((-sum(a * b for a, b in zip(whole, c, strict=True)), int(v)) for v, c in zip(ids, cand, strict=True) if v != own[i])[:k]
        yield i, np.array([v for _, v in found], np.int64), np.array([max(-(2**63), min(2**63 - 1, -s)) for s, _ in found], np.int64)


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 5, id_col: str = "vec_id", vec_col: str = "embedding", scale: float = 256.0, candidates: int = CANDIDATES, query_block: int = QUERIES) -> DataFrame:
    """query_id, rank (from 1), vec_id, score; also query_hash, which tells queries of one id apart."""
    spread = F.xxhash64("id", "v")
    c = quantised(vectors, id_col, vec_col, scale)
    q = stage(quantised(queries, id_col, vec_col, scale).distinct().withColumn("h", spread), "queries")
    n_c, n_q = (max(1, math.ceil(x.count() / size)) for x, size in ((c, candidates), (q, query_block)))
    # repeated rows share a hash, so a running number spreads them over the blocks as well; staged, as a block must stay the same
    left = stage(c.withColumn("cb", F.pmod(spread + F.monotonically_increasing_id(), F.lit(n_c))), "candidates")
    right = q.withColumn("qb", F.pmod("h", F.lit(n_q)))

    def pair(cand: pd.DataFrame, query: pd.DataFrame) -> pd.DataFrame:
        out = []
        length, qlen = cand["v"].map(len), query["v"].map(len)
        for d in set(length) & set(qlen):
            part, asked = cand[length == d], query[qlen == d]
            columns = np.ascontiguousarray(np.stack(part["v"].to_numpy()).T)
            ids, own, hashes = part["id"].to_numpy(), asked["id"].to_numpy(), asked["h"].to_numpy()
            least = asked["least"].astype("float64").fillna(-math.inf).to_numpy()
            for i, found, score in search_block(np.stack(asked["v"].to_numpy()), own, ids, columns, k, least=least):
                out.append(pd.DataFrame({"query_id": own[i], "query_hash": hashes[i], "vec_id": found, "score": score}))
        return pd.concat(out) if out else pd.DataFrame({x: pd.Series(dtype="int64") for x in ("query_id", "query_hash", "vec_id", "score")})

    def meet(blocks: DataFrame, asked: DataFrame, first: int, last: int) -> DataFrame:
        """The best of each query in the candidate blocks from ``first`` to ``last``."""
        every = lambda a, b: F.explode(F.sequence(F.lit(a).cast("long"), F.lit(b).cast("long")))
        return (blocks.withColumn("qb", every(0, n_q - 1)).groupBy("cb", "qb").cogroup(asked.withColumn("cb", every(first, last)).groupBy("cb", "qb"))
                .applyInPandas(pair, "query_id long, query_hash long, vec_id long, score long"))

    best = meet(left.filter("cb = 0"), right.withColumn("least", F.lit(None).cast("double")), 0, 0)
    if n_c > 1:
        best = stage(best, "first-block")
        # a double below the score, where the score is too large for one
        least = F.min("score").cast("double") - F.abs(F.min("score")).cast("double") * F.lit(2.0**-52)
        bounds = best.groupBy("query_id", "query_hash").agg(F.count("*").alias("n"), least.alias("least")).filter(F.col("n") == k)
        known = right.join(bounds, (F.col("id") == F.col("query_id")) & (F.col("h") == F.col("query_hash")), "left").select("id", "v", "h", "qb", "least")
        best = best.unionByName(meet(left.filter("cb > 0"), known, 1, n_c - 1))
    order = W.partitionBy("query_id", "query_hash").orderBy(F.desc("score"), F.asc("vec_id"))
    return best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score", "query_hash")
