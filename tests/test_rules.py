"""Ordered rules as data against one projection per edit."""

import random

import pytest
from pyspark.sql import functions as F

from plotwise.operators import corrections as C
from plotwise.operators import rules as R
from plotwise.plans import biomass

from helpers import rows

SCHEMA = "id int, year int, site string, block double, name string, mark boolean"


def frame(spark, n=400, seed=1):
    rng = random.Random(seed)
    some = lambda *v: rng.choice([*v, None])
    data = [(i, some(2015, 2016, 2017), some("A", "B", "C1"), some(1.0, 2.0, 3.5), some("x", "y1", "z"), some(True, False)) for i in range(n)]
    return spark.createDataFrame(data, SCHEMA)


def random_rules(seed, n, keyed):
    rng = random.Random(seed)
    out = []
    for _ in range(n):
        tests = [("year", "==", rng.choice((2015, 2016, 2017))), ("site", "==", rng.choice("AB"))] if keyed else []
        tests += rng.sample([("block", "==", rng.choice((1.0, 2.0))), ("block", "in", [1.0, 3.5]), ("block", "isna", None), ("name", "==", rng.choice("xz")), ("name", "in", ["x", "y1"]),
                             ("name", "isna", None), ("mark", "==", True), ("year", "in", [2016, 2017])], rng.randint(1, 3))
        target, value = rng.choice([("block", 2.0), ("block", 9.0), ("name", "x"), ("name", "z"), ("name", ("1", "2")), ("mark", False)] + ([] if keyed else [("site", "B"), ("site", ("C", "A"))]))
        out.append(R.Rule(target, tuple(tests), value))
    return out


@pytest.mark.parametrize("keyed", [True, False])
@pytest.mark.parametrize("seed,n", [(1, 3), (2, 12), (3, 25), (4, 60)])
def test_fold_equals_single_edits(spark, keyed, seed, n):
    df, rules = frame(spark, seed=seed), random_rules(seed, n, keyed)
    want = df
    for k in range(0, n, 6):  # cut now and then, or the plan of the single edits explodes
        want = C.apply_ordered_many(want, R.as_edits(rules[k : k + 6]))
        want = spark.createDataFrame(want.collect(), SCHEMA)
    got = R.apply_rules(df, rules)
    assert got.schema == df.schema and rows(got) == rows(want)
    assert R.key_columns(rules)[:2] == (["year", "site"] if keyed else [])


def test_later_rules_see_earlier_edits_and_unknown_blanks(spark):
    df = spark.createDataFrame([(1, 2015, "A", 1.0, "x", None), (2, None, "A", 1.0, "x", None), (3, None, "B", 1.0, "x", None)], SCHEMA)
    rules = [R.Rule("block", (("year", "==", 2015), ("site", "==", "A")), 2.0), R.Rule("name", (("year", "==", 2015), ("site", "==", "A"), ("block", "==", 2.0)), "q")]
    # a missing year leaves the rule unknown, unless the site already decides
    assert rows(R.apply_rules(df, rules), "id", "block", "name") == [(1, 2.0, "q"), (2, None, None), (3, 1.0, "x")]


def test_rules_from_a_table(spark):
    rules = random_rules(7, 30, True)
    table = spark.createDataFrame(R.rule_rows(rules), R.RULE_SCHEMA)
    df = frame(spark, seed=7)
    assert rows(R.apply_rules(df, R.rules_of(table.orderBy(F.rand(3))))) == rows(R.apply_rules(df, rules))
    with pytest.raises(ValueError):
        R.rules_of(spark.createDataFrame([(1, "a", "b", "like", ["x"], "set", "y")], R.RULE_SCHEMA))
    assert R.apply_rules(df, []) is df


def test_plan_size_does_not_grow_with_the_rules(spark):
    df = frame(spark)

    def nodes(n):
        plan = R.apply_rules(df, random_rules(9, n, True))._jdf.queryExecution().optimizedPlan()
        return plan.toString().count("\n")

    assert nodes(500) == nodes(20)
    assert R.apply_rules(df, random_rules(9, 500, True)).count() == 400


def test_biomass_repairs_are_rules(spark):
    assert R.key_columns(biomass.REPAIRS) == ["year", "site"]
    assert all(isinstance(r, R.Rule) for r in biomass.REPAIRS)
