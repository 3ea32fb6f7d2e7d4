import math
import re
import textwrap

import pytest
from pyspark.sql import functions as F

from plotwise.llm import licenses as L

FILES = "doc_id long, path string, text string, own_score string"


def terms(text):
    return re.findall(r"[a-z0-9\x80-\U0010ffff]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute(rows, least):
    """Best line of each text by cosine in the same space, from the definition."""
    vocabulary = {w for ts in L.TEMPLATES.values() for t in ts for w in terms(t)}
    n = len(rows)
    df = {w: sum(w in set(terms(t)) for _, t in rows) for w in vocabulary}
    idf = lambda w: math.log((1 + n) / (1 + df[w])) + 1 if w in vocabulary else math.log(1 + n) + 1
    vec = lambda t: {w: terms(t).count(w) * idf(w) for w in set(terms(t))}
    norm = lambda v: math.sqrt(sum(x * x for x in v.values()))
    out = {}
    for i, t in rows:
        for k, line in enumerate((t or "").split("\n")):
            v = vec(line)
            for name, texts in sorted(L.TEMPLATES.items()):
                for u in map(vec, texts):
                    c = sum(x * u.get(w, 0) for w, x in v.items()) / (norm(v) * norm(u)) if v else 0
                    if c >= least and c > out.get(i, ("", 0, 0))[1] + 1e-9:
                        out[i] = (name, c, k)
    return out


@pytest.mark.parametrize("least", [0.5, 0.75])
def test_own_licenses_match_brute_force(spark, least):
    texts = ["first line\nLicensed under the Apache License, Version 2.0.\nlast", "Released under the MIT License.", "released under the license", "Licensed under CC BY-NC 4.0 by the authors", "the the the of the", "", None, "\n\n", "public domain", "This work is licensed under the GNU General Public License, version 2 or 3\n\nSPDX-License-Identifier: ISC", "prose with license somewhere in a long line of other words"]
    rows = list(enumerate(texts))
    got = L.own_licenses(spark.createDataFrame([(i, f"d/{i}", t, "x") for i, t in rows], FILES), least=least).collect()
    want = brute(rows, least)
    assert len(got) == len(rows)
    for r in got:
        assert (r.own_license, r.line) == ((want[r.doc_id][0], want[r.doc_id][2]) if r.doc_id in want else (None, None)), r
        assert r.own_score is None or r.own_score == pytest.approx(want[r.doc_id][1], abs=1e-5)


def nearest(rows):
    speaks = {}
    for _, path, lic, score in rows:
        if path and lic and re.match(L.LICENSE_NAME, path.rsplit("/", 1)[-1]):
            d = path.rsplit("/", 1)[0] if "/" in path else ""
            speaks[d] = min(speaks.get(d, (9,)), (-score, lic, path))
    out = {}
    for i, path, lic, _ in rows:
        d, found = (path.rsplit("/", 1)[0] if "/" in path else "") if path is not None else None, None
        while lic is None and d is not None and found is None:
            found = (speaks[d][1], d) if d in speaks else None
            d = (d.rsplit("/", 1)[0] if "/" in d else "") if d else None
        out[i] = (lic, None) if lic else found or (None, None)
    return out


def test_inheritance_matches_a_walk_up(spark):
    rows = [(1, "LICENSE", "MIT", 0.9), (2, "a/x.txt", None, None), (3, "a/LICENSE.md", "ISC", 0.8), (4, "a/LICENSE", "GPL-3.0", 0.95), (5, "a/b/c/y", None, None),
            (6, "a/b/COPYING", "CC0-1.0", 0.8), (7, "ab/z", None, None), (8, "a/b/c/own", "BSD-2-Clause", 0.9), (9, None, None, None), (10, "top", None, None), (11, "q/licensed.txt", "ISC", 1.0), (12, "q/r", None, None), (13, "a/b/c/y", None, None)]
    df = spark.createDataFrame(rows, "doc_id long, path string, own_license string, own_score double")
    got = {r.doc_id: (r.license, r.inherited_from) for r in L.inherit(df).collect()}
    assert got == nearest(rows)
    without = [r for r in rows if r[0] != 1]
    got = {r.doc_id: (r.license, r.inherited_from) for r in L.inherit(df.filter(F.col("doc_id") != 1)).collect()}
    assert got == nearest(without) and L.inherit(df.limit(0)).count() == 0


def test_no_broadcast_of_ancestors(spark, tmp_path):
    n, limit = 20_000, 1 << 20
    path = F.when(F.col("id") == 0, "a/LICENSE").otherwise(F.concat_ws("/", F.lit("a"), F.lit("b" * 40), F.col("id").cast("string"), F.lit("x.txt")))
    lic = F.when(F.col("id") == 0, "MIT")
    spark.range(0, n, 1, 2).select(F.col("id").alias("doc_id"), path.alias("path"), lic.alias("own_license"), F.when(lic.isNotNull(), 0.9).alias("own_score")).write.option("compression", "zstd").parquet(str(tmp_path / "f"))
    assert sum(p.stat().st_size for p in (tmp_path / "f").glob("*.parquet")) < limit / 4 and 4 * 40 * n > limit  # small as a file, not as ancestors
    with_limit = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(with_limit)
    spark.conf.set(with_limit, str(limit))
    try:
        out = L.inherit(spark.read.parquet(str(tmp_path / "f")))
        got = out.groupBy("license", "inherited_from").count().collect()
        plan = out._jdf.queryExecution().executedPlan()
        assert sorted((r.license, r.inherited_from or "", r["count"]) for r in got) == [("MIT", "", 1), ("MIT", "a", n - 1)]
        assert "BroadcastHashJoin" not in plan.toString() and "SortMergeJoin" in plan.toString()
    finally:
        spark.conf.set(with_limit, before)


def test_empty_table(spark):
    assert L.own_licenses(spark.createDataFrame([], FILES)).count() == 0


def test_whole_texts_and_wrapped_headers(spark):
    texts = L.license_texts()
    rows, want = [], {}
    for name, ts in texts.items():
        for t in ts:
            wrapped = "\n".join(f" * {x}" for x in textwrap.wrap(" ".join(t.split()), 60))
            for given, line in ((t, None), (f"/*\n{wrapped}\n */\nint main(void) {{ return 0; }}\n" + "value = other + 1\n" * 30, 1), ("some words before it\n" * 50 + t, None)):
                want[len(rows)] = (name, line)
                rows.append((len(rows), f"d/{len(rows)}", given, "x"))
    n = len(rows)
    rows += [(n + i, f"d/{n + i}", "alpha beta gamma of the and to in delta " * 40 + str(i), "x") for i in range(40)]
    got = {r.doc_id: r for r in L.own_licenses(spark.createDataFrame(rows, FILES)).collect()}
    assert {i: got[i].own_license for i in want} == {i: name for i, (name, _) in want.items()}
    assert all(got[i].own_license is None for i in range(n, n + 40))
    assert {got[i].line for i, (_, line) in want.items() if line} <= {0, 1, 2, 3}
