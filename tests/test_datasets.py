"""Read -> clean -> write of every dataset on small exported sheets."""

from plotwise.plans import datasets as DS


def put(path, header, *lines, sep=","):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("\n".join([sep.join(header), *lines]) + "\n", encoding="utf-8")
    return str(path)


def back(spark, out):
    return spark.read.option("header", True).option("nullValue", "NA").csv(out).collect()


def test_biomass(spark, tmp_path):
    head = DS.BM.RAW_SCHEMA.fieldNames()
    put(tmp_path / "in" / "a.csv", head, "2018,ALR,1,FB,F,2018-07-01 00:00:00,Round 2,1.5,x,NA", "2018,ALR,1,RTC,F,NA,R1,1,x,NA")
    put(tmp_path / "in" / "b.csv", head, "2019,OVSen,3,G,G,2019-07-02 00:00:00,R1,5d,y,ok")
    DS.biomass(spark, str(tmp_path / "in"), str(tmp_path / "out"))
    rows = {r.plotID: r for r in back(spark, str(tmp_path / "out"))}
    assert rows["Alr1FB"].biomass == "1.5" and rows["Alr1FB"].round == "2" and len(rows) == 2
    assert [r.biomass for p, r in rows.items() if p != "Alr1FB"] == [None]


def test_soil_moisture(spark, tmp_path):
    a = put(tmp_path / "a.csv", DS.SM_2015_16.fieldNames(), "2015-07-03,Fau,1,Fau1F,F,F,10,20,x,NA,NA,NA,sun,me,NA")
    b = put(tmp_path / "b.csv", DS.SM_2017.fieldNames(), "1.7.17,FAU,2,NA,FAU2G,G,4,6,NA,NA,sun,me", "42917,FAU,NA,2,FAU2G,G,4,6,NA,NA,sun,me")
    c = put(tmp_path / "c.csv", DS.SM_2018.fieldNames(), "2018-07-05 10:00:00,Fauske,1,Fau1B,B,u,2,NA,NA,sun,me")
    DS.soil_moisture(spark, a, b, c, str(tmp_path / "out"))
    rows = back(spark, str(tmp_path / "out"))
    by = {(r.date[:10], r.plotID): r for r in rows}
    assert by["2015-07-03", "Fau1F"].soilmoisture == "15.0"
    assert by["2017-07-01", "Fau2G"].blockID == "Fau2" and sum(r.date.startswith("2017-07-01") for r in rows) == 2


def test_reflectance_and_design(spark, tmp_path):
    a = put(tmp_path / "a.csv", DS.NDVI_2019.fieldNames(), "Høgsete,1,FB,NA,10:00,NA,7/3/19,0.4,0.6")
    DS.reflectance_2019(spark, a, str(tmp_path / "r19"))
    assert [(r.siteID, r.plotID, r.date, r.m_ndvi) for r in back(spark, str(tmp_path / "r19"))] == [("Hogsete", "Hog1FB", "2019-07-03", "0.5")]
    b = put(tmp_path / "b.csv", DS.NDVI_2021.fieldNames(), "3.7.2021;9;Alrust;2;C;0.2;0.3;0.4;0.6;NA", sep=";")
    clean = DS.reflectance_2021(spark, [b], str(tmp_path / "r21"))
    assert {(r.plotID, r.pre_post_cut, r.m_ndvi) for r in back(spark, str(tmp_path / "r21"))} == {("Alr2C", "pre_cut", "0.2"), ("Alr2C", "post_cut", "0.5")}
    grid = DS.design(spark, str(tmp_path / "design"))
    assert len(back(spark, str(tmp_path / "design"))) == 384
    words = spark.createDataFrame([(None, "siteID", "Site", None, None), ("ndvi", "m_ndvi", "Index", None, "sensor")],
                                  "TableID string, `Variable name` string, Description string, `Units/treatment level` string, `How measured` string")
    DS.dictionaries({"ndvi": clean, "design": grid}, words, str(tmp_path / "dic"))
    assert {(r.TableID, r["Variable name"]) for r in back(spark, str(tmp_path / "dic"))} == {("ndvi", "siteID"), ("ndvi", "m_ndvi"), ("design", "siteID")}
