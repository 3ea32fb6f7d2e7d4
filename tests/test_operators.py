"""Composite operators on fixtures with a row per trap."""

import datetime as dt

from pyspark.sql import functions as F

from plotwise.operators import corrections as C
from plotwise.operators import flux as FX
from plotwise.operators import grouped as G
from plotwise.operators import impute as I
from plotwise.operators import quality as Q
from plotwise.operators import reshape as R

from helpers import rows

RULES = [I.GateRule("Siri", "<", 1.35, 1.3), I.GateRule("Owen", ">", 1.5, 1.5, divide=True)]


def test_ratio_gated_rescale(spark):
    data = [  # turf, year, recorder, cover, totalVascular
        ("t1", 1, "Siri", 30.0, 50.0), ("t1", 1, "Siri", 20.0, 50.0),   # ratio 1.0 -> x1.3
        ("t2", 1, "Siri", 30.0, 50.0), ("t2", 1, "Siri", None, 50.0),   # unknown sum -> no fix
        ("t3", 1, "Owen", 60.0, 30.0), ("t3", 1, "Owen", 40.0, 30.0),   # ratio 3.3 -> /1.5
        ("t4", 1, "Owen", 5.0, 0.0),                                    # zero total -> /1.5
        ("t5", 1, "Siri", 10.0, 10.0), ("t5", 1, "Owen", 10.0, 10.0),   # Siri ratio 1.0 -> x1.3, Owen sees 13 > 15? no
        ("t6", 1, "PM", 10.0, 1.0),                                     # other recorder: untouched
    ]
    df = spark.createDataFrame(data, "turf string, yr int, rec string, cover double, tv double")
    out = I.ratio_gated_rescale(df, ["turf", "yr"], "cover", "rec", "tv", RULES)
    got = sorted(((r.turf, r.cover) for r in out.collect()), key=repr)
    assert got == sorted([("t1", 30.0 * 1.3), ("t1", 20.0 * 1.3), ("t2", 30.0), ("t2", None),
                          ("t3", 60.0 / 1.5), ("t3", 40.0 / 1.5), ("t4", 5.0 / 1.5),
                          ("t5", 10.0 * 1.3), ("t5", 10.0 * 1.3), ("t6", 10.0)], key=repr)


def test_ratio_gated_rescale_sequential_fallback_equal(spark):
    df = spark.createDataFrame([("a", 1, "Siri", 10.0, 10.0), ("a", 1, "Owen", 20.0, 10.0)],
                               "turf string, yr int, rec string, cover double, tv double")
    one = I.ratio_gated_rescale(df, ["turf", "yr"], "cover", "rec", "tv", RULES)
    step = df
    for r in RULES:
        step = I.ratio_gated_rescale(step, ["turf", "yr"], "cover", "rec", "tv", [r])
    assert rows(one) == rows(step)


def _cover(spark, data):
    return spark.createDataFrame(data, "site string, turf string, sp string, yr int, cover double, presence double")


def test_adjacent_impute_needs_exactly_two(spark):
    data = [
        ("s", "p1", "a", 2015, 10.0, 1.0), ("s", "p1", "a", 2016, None, 1.0), ("s", "p1", "a", 2017, 20.0, 1.0),
        # T2: a neighbour year with two rows -> three neighbours -> nothing
        ("s", "p2", "a", 2015, 10.0, 1.0), ("s", "p2", "a", 2016, None, 1.0), ("s", "p2", "a", 2017, 20.0, 1.0),
        ("s", "p2", "a", 2017, 30.0, 1.0),
        # T21: plot sampled 2015, 2016, 2018; 2016 missing -> mean of 2015 and 2018
        ("s", "p3", "a", 2015, 2.0, 1.0), ("s", "p3", "a", 2016, None, 1.0), ("s", "p3", "a", 2018, 4.0, 1.0),
        # only one neighbour -> nothing
        ("s", "p4", "a", 2015, 2.0, 1.0), ("s", "p4", "a", 2016, None, 1.0),
        # no presence -> not missing
        ("s", "p5", "a", 2015, 2.0, 1.0), ("s", "p5", "a", 2016, None, None), ("s", "p5", "a", 2017, 4.0, 1.0),
    ]
    out = I.adjacent_impute(_cover(spark, data), ["turf"], ["sp"], "yr", "cover", "presence",
                            ["site", "turf", "sp", "yr"])
    assert rows(out, "turf", "yr", "cover") == [("p1", 2016, 15.0), ("p3", 2016, 3.0)]


def test_site_mean_wins_over_adjacent(spark):
    data = [
        ("s", "p1", "a", 2015, 10.0, 1.0), ("s", "p1", "a", 2016, None, 1.0), ("s", "p1", "a", 2017, 20.0, 1.0),
        ("s", "p9", "a", 2016, 4.0, 1.0),   # another plot of the site has the species that year
        ("s", "p2", "b", 2016, None, 1.0),  # nothing to impute from: dropped
    ]
    comp = _cover(spark, data)
    keys = ["site", "turf", "sp", "yr"]
    adj = I.adjacent_impute(comp, ["turf"], ["sp"], "yr", "cover", "presence", keys)
    miss = comp.filter(F.col("cover").isNull() & F.col("presence").isNotNull()).select(*keys).distinct()
    gm = I.group_mean_impute(comp, ["site", "sp", "yr"], "cover", miss)
    out = I.apply_imputations(comp, keys, "cover", adj, gm)
    assert rows(out, "turf", "yr", "cover") == [("p1", 2015, 10.0), ("p1", 2016, 4.0), ("p1", 2017, 20.0),
                                                ("p9", 2016, 4.0)]


def test_imputation_never_changes_known_values(spark):
    data = [("s", f"p{i}", "a", 2015 + j, float(i * j) if (i + j) % 3 else None, 1.0)
            for i in range(6) for j in range(4)]
    comp = _cover(spark, data)
    keys = ["site", "turf", "sp", "yr"]
    adj = I.adjacent_impute(comp, ["turf"], ["sp"], "yr", "cover", "presence", keys)
    out = I.apply_imputations(comp, keys, "cover", adj, drop_missing=False)
    known = {tuple(r[k] for k in keys): r.cover for r in comp.filter(F.col("cover").isNotNull()).collect()}
    for r in out.collect():
        k = tuple(r[x] for x in keys)
        if k in known:
            assert r.cover == known[k]


def test_lookup_fill_and_explode(spark):
    df = spark.createDataFrame([(2016, "FAU", 4, None), (2016, "FAU", 3, None), (2016, "FAU", 4, "2")],
                               "year int, site string, block int, round string")
    lk = spark.createDataFrame([(2016, "FAU", [1, 2, 4, 5], "1")], "year int, site string, block array<int>, r string")
    out = I.explode_lookup_fill(df, lk, "block", ["year", "site", "block"], "round", "r")
    assert rows(out, "block", "round") == [(3, None), (4, "1"), (4, "2")]


def test_point_corrections_override_known(spark):
    df = spark.createDataFrame([("Alr3G", 2017, 1.0), ("Alr3G", 2016, 1.0), (None, 2017, 2.0)],
                               "turf string, yr int, moss double")
    fixes = spark.createDataFrame([("Alr3G", 2017, "moss", 8.6), (None, 2017, "moss", 5.0)],
                                  "turf string, yr int, column string, value double")
    out = C.point_corrections(df, fixes, ["turf", "yr"], ["moss"])
    assert rows(out) == sorted([(None, 2017, 5.0), ("Alr3G", 2016, 1.0), ("Alr3G", 2017, 8.6)], key=repr)


def test_first_row_per_key_total_order(spark):
    df = spark.createDataFrame([("k", 3, "c"), ("k", 1, "b"), ("k", 1, "a"), ("j", 5, "z")],
                               "k string, o int, v string")
    out = G.first_row_per_key(df, ["k"], ["o", "v"])
    assert rows(out) == [("j", 5, "z"), ("k", 1, "a")]


def test_group_mutate_matches_window(spark):
    from pyspark.sql import Window
    df = spark.range(200).select((F.col("id") % 7).alias("k"), F.col("id").cast("double").alias("v"))
    a = G.group_mean(df, ["k"], "v", "m")
    b = df.withColumn("m", F.avg("v").over(Window.partitionBy("k")))
    assert rows(a) == rows(b)


def test_data_dictionary(spark):
    data = spark.createDataFrame(
        [("a", 1, dt.date(2020, 1, 2), True, dt.datetime(2020, 1, 1, 5)),
         ("c", 5, dt.date(2019, 3, 4), False, dt.datetime(2021, 1, 1, 5))],
        "name string, n int, d date, flag boolean, t timestamp")
    desc = spark.createDataFrame(
        [(None, "name", "Name", None, "x"), (None, "n", "Count", "1", "y"), ("tab", "d", "Day", None, "z"),
         ("other", "d", "Other day", None, "w"), (None, "flag", "Flag", None, "v"), (None, "t", "Time", None, "u")],
        "TableID string, `Variable name` string, Description string, `Units/treatment level` string, "
        "`How measured` string")
    out = Q.data_dictionary(data, desc, "tab")
    got = sorted((r["Variable name"], r["Variable type"], r["Variable range or levels"]) for r in out.collect())
    assert got == [("d", "date", "2019-03-04 - 2020-01-02"), ("flag", "categorical", None),
                   ("n", "numeric", "1 - 5"), ("name", "categorical", "a - c"), ("t", None, None), ("t", None, None)]
    assert "TableID" not in out.columns
    assert "TableID" in Q.data_dictionary(data, desc, "tab", keep_table_id=True).columns


def test_unpivot_pivot_roundtrip(spark):
    df = spark.createDataFrame([(1, 1.0, None), (2, 3.0, 4.0)], "id int, a double, b double")
    long = R.to_long(df, ["id"], ["a", "b"], "k", "v")
    assert long.count() == 4
    back = R.to_wide(long, "k", "v", ["a", "b"], ids=["id"])
    assert rows(back) == rows(df)


def test_expand_levels_is_grid(spark):
    s = spark.createDataFrame([("x",), ("y",), ("x",)], "site string")
    g = R.expand_levels(s, {"b": [1, 2], "t": ["C", "F", "G"]})
    assert g.count() == 12


def test_flux_window_match_and_slope(spark):
    base = dt.datetime(2021, 7, 1, 12, 0, 0)
    readings = spark.createDataFrame(
        [(i, base + dt.timedelta(seconds=i), 400.0 + 2.0 * i) for i in range(0, 300, 10)],
        "rid int, ts timestamp, conc double")
    windows = spark.createDataFrame(
        [("m1", base, base + dt.timedelta(seconds=120)), ("m2", base + dt.timedelta(seconds=180),
                                                          base + dt.timedelta(seconds=240))],
        "mid string, start timestamp, end timestamp")
    m = FX.match_windows(readings, windows, "ts", "start", "end", bucket_seconds=60)
    counts = dict(m.groupBy("mid").count().collect())
    assert counts == {"m1": 12, "m2": 6}
    m = m.withColumn("sec", FX.elapsed_seconds("ts", "start"))
    slopes = {r.mid: r.slope for r in FX.measurement_slopes(m, ["mid"], "conc", "sec").collect()}
    assert abs(slopes["m1"] - 2.0) < 1e-9 and abs(slopes["m2"] - 2.0) < 1e-9


def test_results_do_not_depend_on_partitioning(spark):
    import __spark_entry__ as E
    sf = "/root/testdata/sf0.001"
    names = ["adjacent_impute", "group_ratio_rescale", "first_row_per_key", "imputation_precedence"]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        res = {}
        for n in (1, 13):
            spark.conf.set("spark.sql.shuffle.partitions", str(n))
            res[n] = {q: rows(E.queries()[q](spark, sf)) for q in names}
        assert res[1] == res[13]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_preview_is_ordered_top_n(spark):
    df = spark.createDataFrame([(3, "c"), (None, "n"), (1, "a"), (2, "b")], "k int, v string")
    assert [tuple(r) for r in Q.preview(df, ["k"], n=2).collect()] == [(1, "a"), (2, "b")]
    assert Q.preview(df, ["k"]).count() == 4
