"""Order- and data-dependent behaviours of the scripts kept on purpose."""

from pyspark.sql import functions as F

from plotwise.operators import corrections as C
from plotwise.operators import joins as J
from plotwise.plans import community as CM
from plotwise.plans import design as DS

from helpers import rows


def test_t8_rebuild_ids_cut_to_end_or_to_row_count(spark):
    df = spark.createDataFrame([("Alrust", "Alr12FGB"), ("Alrust", "37 TTC")], "siteID string, turfID string")
    got = rows(C.rebuild_ids(df, "turfID", "siteID", "TTC"), "turfID")
    assert got == [("Alr12FGB",), ("Alr37 TTC",)]  # prefix added to TTC ids too
    short = rows(C.rebuild_ids(df, "turfID", "siteID", "TTC", stop=2), "turfID")
    assert short == [("Alr",), ("Alr37 TTC",)]  # a frame with 2 rows cuts at character 2


def test_t10_block_from_one_character(spark):
    df = spark.createDataFrame([("Gud12C",)], "turfID string")
    from plotwise.functions import semantics as S
    assert df.select(S.r_substr("turfID", 4, 4).alias("b")).first().b == "1"


def test_t11_full_natural_join_on_every_shared_column(spark):
    a = spark.createDataFrame([("t", 2016, "x", 1.0)], "turfID string, Year int, recorder string, v double")
    b = spark.createDataFrame([("t", 2016, "y")], "turfID string, Year int, recorder string")
    out = J.natural_join(a, b, "full")
    assert out.count() == 2  # recorder differs, so the rows do not match


def test_t12_patch_join_on_recorder_misses_overwritten_rows(spark):
    base = spark.createDataFrame([("t", "new rec", 1.0)], "turfID string, recorder string, mossHeight double")
    patch = spark.createDataFrame([("t", "old rec", 9.0)], "turfID string, recorder string, mossHeight double")
    out = J.patch_join(base, patch, ["turfID", "recorder"], ["mossHeight"], "left")
    assert rows(out) == [("t", "new rec", 1.0)]


def test_t16_right_join_adds_unmatched_dictionary_rows(spark):
    data = spark.createDataFrame([("ARH", 1.0)], "Site string, m double")
    sites = spark.createDataFrame([("ARH", "Arhelleren"), ("OVS", "Ovstedal")], "v2 string, new string")
    out = J.join(data, sites, [("Site", "v2")], "right")
    assert rows(out) == [("ARH", 1.0, "Arhelleren"), ("OVS", None, "Ovstedal")]


def test_t17_t19_fixed_values(spark):
    # the 301 TTC height fix targets a turf outside the control dictionary
    from plotwise.plans import dictionaries as D
    assert "301 TTC" not in dict(D.TTC_TURF)
    # the design grid spells Ovstedal, the cleaned data Ovstedalen
    assert "Ovstedal" in D.DESIGN_SITES and D.SITE_NAME_FIXES["Ovstedal"] == "Ovstedalen"
    assert DS.design_grid(spark).filter(F.col("siteID") == "Ovstedalen").count() == 0


def test_t20_blank_new_name_wins(spark):
    comp = spark.createDataFrame([("Ach.mil", 2016)], "species string, Year int")
    names = spark.createDataFrame([("Ach.mil", "")], "old string, new string")
    j = J.join(comp, names, [("species", "old")], "left")
    out = j.withColumn("species", F.coalesce(F.col("new"), F.col("species")))
    assert out.first().species == ""


def test_identity_fixes(spark):
    df = spark.createDataFrame(
        [("Gudmedalen", "16", "C", "Gud16C", 2016, "A"), ("Alrust", "3", "C", "Alr9C", 2015, "A"),
         ("Alrust", "4", "F", "Alr4F", 2015, "A"), ("Gudmedalen", None, "C", "Gud5C", 2016, "A"),
         ("Alrust", "1", "C", "37 TTC", 2016, "Siri"), ("Alrust", "4", "FGB", "Alr4FGB", 2016, "B")],
        "siteID string, blockID string, Treatment string, turfID string, Year int, recorder string")
    got = rows(CM.identity_fixes(df), "turfID", "blockID", "Year")
    # Gud16C -> Gud5C with block 5; Alrust block 3 C in 2015 -> Alr3C; Alrust block 4 2015 dropped;
    # NA block at Gudmedalen -> NA turf -> dropped (T4); 37 TTC -> Alr3C by Siri -> dropped; Alr4FGB -> Alr5C
    assert got == [("Alr3C", "3", 2015), ("Alr5C", "4", 2016), ("Gud5C", "5", 2016)]


def test_corrected_modes(spark):
    import datetime as dt
    from plotwise.plans import biomass as B
    from plotwise.plans import reflectance as RF
    from plotwise.plans import soil_moisture as SM
    raw = spark.createDataFrame([(2018.0, "OVS", 2.0, "B", "B", None, "R2", 3.0, "x", None)], B.RAW_SCHEMA)
    assert B.clean_biomass(raw).count() == 2 and B.clean_biomass(raw, corrected=True).count() == 1  # T5
    w = spark.createDataFrame([("Fauske", 2, "FB", "9:00", None, "13.7.2021", 0.5, 0.7, 0.4, 0.8)],
                              "Site string, Block int, Plot string, Time string, notes string, Date string, "
                              "`After.1` double, `After.2` double, `Before.1` double, `Before.2` double")
    got = {r.pre_post_cut: (r.m_ndvi, r.plotID) for r in RF.ndvi_2021(w, corrected=True).collect()}
    assert abs(got["pre_cut"][0] - 0.6) < 1e-12 and got["pre_cut"][1] == "Fau2FB"  # T6, T7
    cols = ("Date timestamp, Site string, FCBlock double, turfID string, Treatment string, Measurement1 string, "
            "Measurement2 string, Measurement3 string, Measurement4 string, Weather string, Recorder string")
    r18 = spark.createDataFrame([(dt.datetime(2018, 7, 5), "FAU", 4.0, "C", "C", "1", "1", "1", "1", "s", "A")], cols)
    r = SM.sm_2018(r18, corrected=True).first()
    assert (r.blockID, r.plotID) == ("Fau4", "Fau4C")  # T9
