"""Layer 1: the missing-value rules of the survey scripts (S1-S22)."""

import datetime as dt

from pyspark.sql import Window
from pyspark.sql import functions as F

from plotwise.functions import semantics as S
from plotwise.functions import temporal as TM


def one(spark, expr, data, schema):
    return [r[0] for r in spark.createDataFrame(data, schema).select(expr.alias("x")).collect()]


def test_if_else_unknown_condition_gives_unknown(spark):
    got = one(spark, S.if_else_na(F.col("c"), F.lit("a"), F.lit("b")), [(True,), (False,), (None,)], "c boolean")
    assert got == ["a", "b", None]


def test_case_when_falls_through_unknown(spark):
    e = S.case_when([(F.col("c"), "a"), (F.lit(True), "z")])
    assert one(spark, e, [(True,), (None,)], "c boolean") == ["a", "z"]


def test_in_is_never_unknown(spark):
    data = [("x",), ("y",), (None,)]
    assert one(spark, S.is_in("v", ["x"]), data, "v string") == [True, False, False]
    assert one(spark, S.not_in("v", ["x"]), data, "v string") == [False, True, True]
    assert one(spark, S.is_in("v", ["x", None]), data, "v string") == [True, False, True]


def test_regex_test_false_on_missing(spark):
    data = [("TT1a",), ("abc",), (None,)]
    assert one(spark, ~S.matches("v", "TT1"), data, "v string") == [False, True, True]
    assert one(spark, S.detect("v", "TT1"), data, "v string") == [True, False, None]


def test_strict_sum_and_mean(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", None), ("b", 2.0), ("b", 3.0)], "k string, v double")
    got = dict(df.groupBy("k").agg(S.sum_strict("v").alias("s")).collect())
    assert got == {"a": None, "b": 5.0}
    got = dict(df.groupBy("k").agg(S.mean_strict("v").alias("s")).collect())
    assert got == {"a": None, "b": 2.5}
    w = Window.partitionBy("k")
    got = sorted(df.select("k", S.sum_strict("v", w).alias("s")).collect())
    assert [tuple(r) for r in got] == [("a", None), ("a", None), ("b", 5.0), ("b", 5.0)]


def test_strict_sum_restricted_rows(spark):
    df = spark.createDataFrame([("a", "S", 1.0), ("a", "O", None), ("a", "S", 2.0)], "k string, r string, v double")
    got = df.groupBy("k").agg(S.sum_strict("v", where=F.col("r") == "S").alias("s")).first()["s"]
    assert got == 3.0


def test_mean_na_rm_of_nothing_is_missing(spark):
    df = spark.createDataFrame([("a", None)], "k string, v double")
    assert df.groupBy("k").agg(S.mean_na_rm("v").alias("m")).first()["m"] is None


def test_n_distinct_counts_missing(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", None), ("a", 1.0), ("b", 2.0)], "k string, v double")
    assert dict(df.groupBy("k").agg(S.n_distinct("v").alias("n")).collect()) == {"a": 2, "b": 1}


def test_to_num_lenient(spark):
    data = [("1.5",), ("",), ("u",), (" 5 ",), ("NaN",), (None,)]
    assert one(spark, S.to_num("v"), data, "v string") == [1.5, None, None, 5.0, None, None]
    assert one(spark, S.to_num_comma("v"), [("1,5",)], "v string") == [1.5]


def test_text_compare_not_numeric(spark):
    # comparing a text column with text never casts it (no failure on '16a')
    got = one(spark, F.col("b") == F.lit("16"), [("16",), ("16a",)], "b string")
    assert got == [True, False]


def test_paste_writes_na(spark):
    got = one(spark, S.paste(F.lit("Alr"), F.col("b")), [(None,), (2,)], "b int")
    assert got == ["AlrNA", "Alr2"]


def test_r_str_whole_numbers(spark):
    assert one(spark, S.r_str("v"), [(4.0,), (4.5,)], "v double") == ["4", "4.5"]


def test_recode_keeps_unmatched(spark):
    got = one(spark, S.recode("v", {"OVSen": "OVS"}), [("OVSen",), ("ARH",), (None,)], "v string")
    assert got == ["OVS", "ARH", None]


def test_row_mean(spark):
    got = one(spark, S.row_mean("a", "b", "c", "d"), [(1.0, None, 3.0, None), (None, None, None, None)],
              "a double, b double, c double, d double")
    assert got == [2.0, None]


def test_substrings(spark):
    data = [("Gud12C",)]
    assert one(spark, S.r_substr("v", 1, 3), data, "v string") == ["Gud"]
    assert one(spark, S.str_sub_from("v", -1), data, "v string") == ["C"]
    assert one(spark, S.str_sub_from("v", 4), data, "v string") == ["12C"]
    assert one(spark, S.str_sub_from("v", -2), [("a",)], "v string") == ["a"]


def test_logit(spark):
    got = one(spark, S.logit("p"), [(0.5,), (0.0,), (1.0,)], "p double")
    assert got[0] == 0.0 and got[1] is None and got[2] is None


def test_level_rank(spark):
    got = one(spark, S.level_rank("v", ["B", "F", "G"]), [("F",), ("GF",), (None,)], "v string")
    assert got == [2, None, None]


def test_dates(spark):
    got = one(spark, TM.mixed_date("d"), [("3.7.2017",), ("42917",), ("x.y",)], "d string")
    assert got == [dt.date(2017, 7, 3), dt.date(2017, 7, 1), None]
    got = one(spark, TM.parse_date_2digit_year("d", "M/d/yy"), [("7/3/19",), ("7/3/97",)], "d string")
    assert got == [dt.date(2019, 7, 3), dt.date(1997, 7, 3)]
    got = one(spark, TM.parse_ymd_h("d"), [("2018-07-02",), ("2018-07-02 13",)], "d string")
    assert got[0] == dt.datetime(2018, 7, 2, 0, 0) and got[1] == dt.datetime(2018, 7, 2, 13, 0)


def test_filter_drops_unknown(spark):
    # NOT (NULL AND FALSE) keeps the row, NOT (NULL AND TRUE) drops it
    df = spark.createDataFrame([(1, None), (2, None), (2, "x")], "i int, v string")
    assert [r.i for r in df.filter(~((F.col("v") == "x") & (F.col("i") == 2))).collect()] == [1]
