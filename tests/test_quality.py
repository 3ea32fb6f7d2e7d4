"""All checks in one pass; locale order of texts."""

import random

import pytest
from pyspark.sql import functions as F

from plotwise.operators import quality as Q

from helpers import rows


def table(spark, n=600):
    rng = random.Random(2)
    some = lambda *v: rng.choice(v)
    return spark.createDataFrame([(some("A", "B", None), some(2015, 2016, None), some("x", "y"), some(1.0, 1.0, 2.0, None)) for _ in range(n)], "site string, year int, kind string, cover double")


def checks():
    return [Q.Check("key", "unique", ("site", "year", "kind")), Q.Check("values", "one value", ("site", "kind"), value="cover"), Q.Check("years", "complete", ("year",), expected=230),
            Q.Check("covers", "known", ("site", "year"), value="cover", where=F.col("kind") == "x"), Q.Check("sites", "known", ("site", "kind"), value="site"), Q.Check("kinds", "one value", ("site", "year"), value="kind")]


def test_same_violations_as_the_single_checks(spark):
    df = table(spark)
    text = lambda r, keys: ";".join(f"{k}={'NA' if r[k] is None else r[k]}" for k in keys)
    want = set()
    for c in checks():
        n_rows = {text(r, c.keys): r["count"] for r in df.groupBy(*c.keys).count().collect()}
        if c.kind == "unique":
            found = {text(r, c.keys): r.n for r in Q.unique_key_violations(df, list(c.keys)).collect()}
        elif c.kind == "one value":
            found = {text(r, c.keys): n_rows[text(r, c.keys)] for r in Q.duplicate_value_check(df, list(c.keys), c.value).collect()}
        elif c.kind == "complete":
            found = {text(r, c.keys): r.n for r in Q.completeness_check(df, list(c.keys), c.expected).collect()}
        else:
            keys = {text(r, c.keys) for r in Q.missing_listing(df, c.value, list(c.keys), c.where).collect()}
            hit = F.col(c.value).isNull() & (c.where if c.where is not None else F.lit(True))
            found = {text(r, c.keys): r["count"] for r in df.filter(hit).groupBy(*c.keys).count().collect()}
            assert set(found) == keys
        want |= {(c.name, k, n) for k, n in found.items()}
    got = rows(Q.violations(df, checks()))
    assert len({c for c, *_ in got}) >= 5 and got == sorted(want, key=repr)
    assert Q.violations(df.limit(0), checks()).count() == 0
    with pytest.raises(ValueError):
        Q.violations(df, [Q.Check("a", "odd", ("site",))])


def test_one_exchange(spark):
    plan = Q.violations(table(spark), checks())._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and plan.count("Expand") == 1


def test_norwegian_order(spark):
    words = ["zebra", "ål", "Ære", "øy", "abc", "Åse", "ære", "Zoo"]
    df = spark.createDataFrame([(1, w) for w in words] + [(1, None)], "k int, w string")
    assert rows(Q.text_range(df, ["k"], "w", "nb")) == [(1, "abc", "Åse")]
    assert rows(Q.text_range(df, ["k"], "w")) == [(1, "Zoo", "øy")]  # binary order
    assert [r.w for r in Q.sorted_rows(df, ["w"], "nb").collect()] == ["abc", "zebra", "Zoo", "ære", "Ære", "øy", "ål", "Åse", None]
    assert [r.w for r in Q.preview(df, ["k", "w"], 2, "nb").collect()] == ["abc", "zebra"]
    desc = spark.createDataFrame([(None, "w", "Word", None, "read")], "TableID string, `Variable name` string, Description string, `Units/treatment level` string, `How measured` string")
    assert [r["Variable range or levels"] for r in Q.data_dictionary(df, desc, "t", collation="nb").collect()] == ["abc - Åse"]
