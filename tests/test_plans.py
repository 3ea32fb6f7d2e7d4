"""Layer 3: dataset chains on small hand-built fixtures, one row per trap."""

import datetime as dt

from pyspark.sql import functions as F

from plotwise.plans import biomass as B
from plotwise.plans import design as DS
from plotwise.plans import reflectance as RF
from plotwise.plans import soil_moisture as SM


def ts(y, m, d):
    return dt.datetime(y, m, d)


def test_biomass_chain(spark):
    rows = [  # Year, Site, Block, Treatment, Removed fg, Date, Round, Biomass, Name, Remark
        (2016.0, "ALR", 1.0, "F", "F", ts(2016, 7, 1), "R1", 1.0, None, None),      # T4: NA name -> AlrNA
        (2016.0, "ALR", 1.0, "G", "G", ts(2016, 7, 1), "R1", 2.0, "Olav", None),    # K23: block 2
        (2018.0, "OVS", 2.0, "B", "B", None, "R2", 3.0, "x", None),                 # T5: doubled, dated
        (2016.0, "FAU", 4.0, "FB", "F", ts(2016, 7, 2), None, 4.0, "y", None),      # K21: round 1
        (2016.0, "FAU", 3.0, "RTC", "F", ts(2016, 7, 2), "1", 5.0, "y", None),      # dropped
        (2016.0, "FAU", 3.0, None, "F", ts(2016, 7, 2), "1", 6.0, "y", None),       # dropped
        (2017.0, "OVSen", 1.0, "C", "G", ts(2017, 7, 2), "1", 7.0, "z", None),      # Ovstedalen
    ]
    raw = spark.createDataFrame(rows, B.RAW_SCHEMA)
    out = B.clean_biomass(raw)
    got = sorted((r.biomass, r.blockID, r.plotID, r.round, r.siteID, r.date) for r in out.collect())
    assert got == [
        (1.0, "AlrNA", "AlrNAF", "1", "Alrust", dt.date(2016, 7, 1)),
        (2.0, "Alr2", "Alr2G", "1", "Alrust", dt.date(2016, 7, 1)),
        (3.0, "Ovs2", "Ovs2B", "2", "Ovstedalen", dt.date(2018, 7, 3)),
        (3.0, "Ovs2", "Ovs2B", "2", "Ovstedalen", dt.date(2018, 7, 3)),
        (4.0, "Fau4", "Fau4FB", "1", "Fauske", dt.date(2016, 7, 2)),
        (7.0, "Ovs1", "Ovs1C", "1", "Ovstedalen", dt.date(2017, 7, 2)),
    ]
    assert out.columns == ["year", "date", "round", "siteID", "blockID", "plotID", "treatment", "removed_fg",
                           "biomass", "name", "remark"]
    totals = {(r.year, r.climate, r.treatment, r.removed_fg): r.biomass for r in B.plot_totals(out).collect()}
    assert totals[(2018, "boreal4", "B", "B")] == 6.0
    assert totals[(2017, "boreal4", None, "G")] == 7.0  # C is not a plot treatment level


def test_biomass_repair_on_exact_float(spark):
    rows = [(2019.0, "VIK", 5.0, "F", "F", ts(2019, 7, 1), "1", 0.57, "VG", None),
            (2019.0, "VIK", 5.0, "F", "F", ts(2019, 7, 1), "1", 0.58, "VG", None)]
    out = B.clean_biomass(spark.createDataFrame(rows, B.RAW_SCHEMA))
    assert sorted((r.biomass, r.treatment) for r in out.collect()) == [(0.57, "FB"), (0.58, "F")]


def test_soil_moisture_2015_16_pooled_mean(spark):
    cols = ("date string, site string, block int, turfID string, treatment string, removal string, M1 string, "
            "M2 string, M3 string, M4 string, blockSD string, Moisture string, weather string, recorder string, "
            "comments string")
    rows = [("2015-07-01", "Alr", 1, "Alr1F", "F", "F", "1", "2", "3", "4", None, None, "sun", "A", None),
            ("2015-07-01", "Alr", 1, "Alr1F", "F", "F", "5", None, None, None, None, None, "sun", "A", None),
            ("2015-07-01", "Alr", 2, "Alr2TT1", "F", "F", "5", None, None, None, None, None, "sun", "A", None),
            ("2015-07-01", "Ovs", 2, "Ovs2C", "C", None, "2", "2", "x", None, None, None, "rain", "B", "above table")]
    got = sorted(tuple(r) for r in SM.sm_2015_16(spark.createDataFrame(rows, cols)).collect())
    d = dt.date(2015, 7, 1)
    assert got == [(d, "Alrust", "Alr1", "Alr1F", "F", 3.0, "sun", "A", "Alr1F"),
                   (d, "Alrust", "Alr1", "Alr1F", "F", 3.0, "sun", "A", "Alr1F"),
                   (d, "Ovstedalen", "Ovs2", "Ovs2C", "C", 2.0, "rain", "B", "Ovs2C")]


def test_soil_moisture_2017_dates_and_row_mean(spark):
    cols = ("Date string, Site string, `SCBlock...5` int, `SCBlock...6` int, `Turf ID` string, Treatment string, "
            "Measurement1 string, Measurement2 string, Measurement3 string, Measurement4 string, Weather string, "
            "Recorder string")
    rows = [("3.7.2017", "ALR", 1, None, "Alr1F", "F", "1", None, "3", None, "sun", "A"),
            ("42917", "ALR", None, 2, "Alr2G", "G", "4", "4", "4", "4", "sun", "A"),
            ("42917", "ALR", None, 2, "Alr2B", "B", None, None, None, None, "sun", "A"),
            ("42917", "ALR", 3, None, "77 TTC", None, "1", "1", "1", "1", "sun", "A")]
    got = sorted(tuple(r) for r in SM.sm_2017(spark.createDataFrame(rows, cols)).collect())
    assert got == [(dt.date(2017, 7, 1), "Alrust", "Alr2", "Alr2G", "G", 4.0, "sun", "A", "Alr2G"),
                   (dt.date(2017, 7, 1), "Alrust", "Alr3", "Alr3C", "C", 1.0, "sun", "A", "77 TTC"),
                   (dt.date(2017, 7, 3), "Alrust", "Alr1", "Alr1F", "F", 2.0, "sun", "A", "Alr1F")]


def test_soil_moisture_2018_and_union(spark):
    cols = ("Date timestamp, Site string, FCBlock double, turfID string, Treatment string, Measurement1 string, "
            "Measurement2 string, Measurement3 string, Measurement4 string, Weather string, Recorder string")
    rows = [(None, "OVS", 1.0, "Ovs1C", "C", "u", "2", None, None, "sun", "A"),      # u -> 0, T13 default date
            (ts(2018, 7, 5), "FAU", 4.0, "Fau4C", "C", "1", "1", "1", "1", "sun", "A"),
            (ts(2018, 7, 5), "FAU", 1.0, "TTC 51", None, "2", "2", "2", "2", "sun", "A")]
    out = SM.sm_2018(spark.createDataFrame(rows, cols))
    got = sorted((r.siteID, r.blockID, r.turfID, r.soilmoisture, r.date) for r in out.collect())
    assert got == [("Fauske", "Fau", "Fau1C", 2.0, ts(2018, 7, 5)),
                   ("Fauske", "Fau", "Fau4C", 1.0, ts(2018, 7, 5)),
                   ("Ovstedalen", "Ovs", "Ovs1C", 1.0, ts(2018, 7, 2))]
    assert "plotID" not in out.columns
    cols15 = ("date string, site string, block int, turfID string, treatment string, removal string, M1 string, "
              "M2 string, M3 string, M4 string, blockSD string, Moisture string, weather string, recorder string, "
              "comments string")
    r15 = spark.createDataFrame([("2015-07-01", "Alr", 1, "Alr1F", "F", "F", "1", "2", "3", "4", None, None, "s",
                                  "A", None)], cols15)
    cols17 = ("Date string, Site string, `SCBlock...5` int, `SCBlock...6` int, `Turf ID` string, Treatment string, "
              "Measurement1 string, Measurement2 string, Measurement3 string, Measurement4 string, Weather string, "
              "Recorder string")
    r17 = spark.createDataFrame([("3.7.2017", "ALR", 1, None, "Alr1F", "F", "1", None, "3", None, "s", "A")], cols17)
    allsm = SM.soil_moisture(r15, r17, spark.createDataFrame(rows, cols))
    assert dict(allsm.dtypes)["date"] == "timestamp"
    assert allsm.filter(F.col("plotID").isNull()).count() == 3


def test_reflectance(spark):
    r19 = spark.createDataFrame(
        [("Fauske", 1, "C", None, "10:00", None, "7/3/19", 0.4, 0.6)],
        "Site string, Block int, Treatment string, TTC_ID string, Time string, notes string, Date string, "
        "Value1 double, Value2 double")
    got = RF.ndvi_2019(r19).first()
    assert (got.plotID, got.date, got.m_ndvi, got.pre_post_cut) == ("Fae1C", dt.date(2019, 7, 3), 0.5, "post_cut")
    w = spark.createDataFrame(
        [("Ulvhaugen", 2, "FB", "9:00", None, "13.7.2021", 0.5, 0.7, 0.4, 0.8)],
        "Site string, Block int, Plot string, Time string, notes string, Date string, `After.1` double, "
        "`After.2` double, `Before.1` double, `Before.2` double")
    got = {r.pre_post_cut: (r.m_ndvi, r.date, r.plotID) for r in RF.ndvi_2021(w).collect()}
    assert got == {"pre_cut": (0.4, "2021-07-13", "Ulv2FB"), "post_cut": (0.6, "2021-07-13", "Ulv2FB")}


def test_design_grid(spark):
    g = DS.design_grid(spark)
    assert g.count() == 384
    first = g.first()
    assert (first.siteID, first.blockID, first.treatment, first.plotID) == ("Alrust", "Alr1", "B", "Alr1B")
    assert g.filter(F.col("siteID") == "Ovstedal").select("plotID").distinct().count() == 32
