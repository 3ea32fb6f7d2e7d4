from pyspark.sql import functions as F

from plotwise.operators import joins as J

from helpers import rows


def test_missing_keys_match(spark):
    l = spark.createDataFrame([(None, 1), ("a", 2)], "k string, x int")
    r = spark.createDataFrame([(None, "n"), ("a", "A")], "k string, y string")
    assert rows(J.join(l, r, "k", "left")) == rows(spark.createDataFrame([(None, 1, "n"), ("a", 2, "A")], "k string, x int, y string"))
    assert J.semi_join(l, r, "k").count() == 2


def test_natural_join_uses_all_shared_names(spark):
    l = spark.createDataFrame([("s", 1, 10.0)], "site string, yr int, v double")
    r = spark.createDataFrame([("s", 1, "x"), ("s", 2, "y")], "site string, yr int, p string")
    out = J.natural_join(l, r, "left")
    assert out.columns == ["site", "yr", "v", "p"]
    assert rows(out) == [("s", 1, 10.0, "x")]


def test_suffix_only_on_clashing_payload(spark):
    l = spark.createDataFrame([("a", 1.0)], "turfID string, cover double")
    r = spark.createDataFrame([("a", 2.0)], "TTtreat string, cover double")
    out = J.join(l, r, [("turfID", "TTtreat")], "left", suffix=("", ".new"))
    assert out.columns == ["turfID", "cover", "cover.new"]


def test_full_join_coalesces_keys(spark):
    l = spark.createDataFrame([("a", 1)], "k string, x int")
    r = spark.createDataFrame([("b", 2)], "k2 string, y int")
    out = J.join(l, r, [("k", "k2")], "full")
    assert out.columns == ["k", "x", "y"]
    assert rows(out) == [("a", 1, None), ("b", None, 2)]


def test_lookup_duplicates_multiply(spark):
    facts = spark.createDataFrame([("OVS", None)], "site string, d string")
    lk = spark.createDataFrame([("OVS", "2018-07-03"), ("OVS", "2018-07-03")], "site string, nd string")
    assert J.join(facts, lk, "site", "left").count() == 2


def test_patch_join_new_wins(spark):
    base = spark.createDataFrame([("a", 1.0, "x"), ("b", 2.0, "y")], "k string, v double, r string")
    patch = spark.createDataFrame([("a", None, "z"), ("c", 3.0, "w")], "k string, v double, r string")
    left = J.patch_join(base, patch, "k", ["v", "r"], "left")
    assert rows(left) == [("a", 1.0, "z"), ("b", 2.0, "y")]
    full = J.patch_join(base, patch, "k", ["v", "r"], "full")
    assert rows(full) == [("a", 1.0, "z"), ("b", 2.0, "y"), ("c", 3.0, "w")]


def test_null_safe_join_stays_equi_join(spark):
    l = spark.range(100).select(F.col("id").alias("k"))
    r = spark.range(100).select(F.col("id").alias("k"), F.lit(1).alias("v"))
    plan = J.join(l, r, "k", "left")._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "CartesianProduct" not in plan


def test_full_join_with_bounded_right_equals_shuffled_full_join(spark):
    l = spark.createDataFrame([("a", 1, 1.0), ("b", None, 2.0), (None, 3, 3.0), ("a", 1, 4.0)],
                              "k string, j int, x double")
    r = spark.createDataFrame([("a", 1, "A"), (None, 3, "N"), ("z", 9, "Z"), ("z", 9, "Z2"), (None, None, "NN")],
                              "k string, j int, y string")
    for by in (["k", "j"], [("k", "k"), ("j", "j")]):
        a = J.join(l, r, by, "full", broadcast=True)
        b = J.join(l, r, by, "full")
        assert a.columns == b.columns and rows(a) == rows(b)
    pa = J.patch_join(l.withColumnRenamed("x", "v"), r.withColumnRenamed("y", "v").withColumn("v", F.lit(7.0)),
                      ["k", "j"], ["v"], "full", broadcast=True)
    pb = J.patch_join(l.withColumnRenamed("x", "v"), r.withColumnRenamed("y", "v").withColumn("v", F.lit(7.0)),
                      ["k", "j"], ["v"], "full")
    assert rows(pa) == rows(pb)
