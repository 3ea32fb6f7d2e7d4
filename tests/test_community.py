"""Community composition chain on a hand-built fixture."""

from pyspark.sql import functions as F

from plotwise.plans import community as CM

SHEET_COLS = ["siteID", "blockID", "Treatment", "turfID", "TTtreat", "subPlot", "year", "recorder",
              "totalGraminoids", "totalForbs", "totalBryophytes", "vegetationHeight", "mossHeight", "litter",
              "acro", "pleuro", "Ach mil", "Agr cap", "Empty sp", "Vio sp", "Vis vul"]


def sheet(spark, rows):
    return spark.createDataFrame(rows, ", ".join(f"`{c}` string" for c in SHEET_COLS))


def row(site, block, trt, turf, sub, year, rec, ach, agr, acro=None, pleuro=None, tb=None, vis=None, tt=None,
        vio=None):
    return (site, block, trt, turf, tt, sub, year, rec, "30", "40", tb, "5", "2", "1", acro, pleuro,
            ach, agr, None, vio, vis)


def inputs(spark):
    s = spark.createDataFrame
    db = dict(
        character_traits=s([("Ach.mil", "functionalGroup", "forb"), ("Agr.cap", "functionalGroup", "graminoid"),
                            ("Equ.arv", "functionalGroup", "pteridophyte"), ("Ach.mil", "height", "x")],
                           "species string, trait string, value string"),
        sub_turf_community=s([("51 TTC", 2015, "Ach.mil", 1), ("51 TTC", 2016, "Ach.mil", 1),
                              ("51 TTC", 2016, "Equ.arv", 2)],
                             "turfID string, year int, species string, subTurf int"),
        turf_community=s([("51 TTC", 2015, "Ach.mil", 30.0), ("51 TTC", 2015, "Agr.cap", 20.0),
                          ("51 TTC", 2016, "Ach.mil", 30.0), ("51 TTC", 2016, "Agr.cap", 20.0)],
                         "turfID string, year int, species string, cover double"),
        taxon=s([("Ach.mil", "Achillea"), ("Agr.cap", "Agrostis"), ("Equ.arv", "Equisetum")],
                "species string, speciesName string"),
        turfs=s([("51 TTC", "TTC", "", "p1")], "turfID string, TTtreat string, GRtreat string, destinationPlotID string"),
        plots=s([("p1", "Fau1")], "plotID string, blockID string"),
        blocks=s([("Fau1", "Fauske")], "blockID string, siteID string"),
        sites=s([("Fauske", 3, 1)], "siteID string, temperature_level int, precipitation_level int"),
        turf_environment=s([("51 TTC", 2015, "Siri", 50.0, 10.0, 5.0, 1.0, 2.0),
                            ("51 TTC", 2016, "Siri", 50.0, 10.0, 5.0, 1.0, 2.0)],
                           "turfID string, year int, recorder string, totalVascular double, "
                           "totalBryophytes double, vegetationHeight double, mossHeight double, litter double"),
    )
    y15 = [row("Alrust", "1", "F", "Alr1F", "%", "2015", "A", "10", "5", acro="3"),
           row("Alrust", "1", "F", "Alr1F", "T", "2015", "A", "1", "1")]
    y16 = [row("Alrust", "1", "F", "Alr1F", "%", "2016", "A", None, "6", pleuro="2", tb="9"),
           row("Alrust", "1", "F", "Alr1F", "T", "2016", "A", "1", "1"),
           row("Alrust", "1", "F", "Alr1F", "%", "2016", "A", "4", "4", vis="7")]
    y17 = [row("Alrust", "1", "F", "Alr1F", "%", "2017", "A", "20", "7"),
           row("Alrust", "1", "F", "Alr1F", "T", "2017", "A", "1", "1"),
           row("Alrust", "2", "F", "Alr2F", "%", "2017", "B", "8", "8", tt="x", vio="2")]
    return CM.CommunityInputs(
        **db,
        sheets=[sheet(spark, y16), sheet(spark, y15), sheet(spark, y17)],
        sheet_2018=None,
        bryophytes_2017=s([("Fau1C", "TTC", 11.0, 3.0, 6.0)],
                          "turfID string, TTtreat string, totalBryophytes double, mossHeight double, "
                          "vegetationHeight double"),
        species_corrections=s([("Agr.cap", "Agr.cap2", "Alrust", "Alr2F", "2017", "9", None)],
                              "old string, new string, siteID string, turfID string, Year string, cover string, "
                              "functionalGroup string").withColumn("Year", F.col("Year").cast("int")),
        merge_dictionary=s([("Agr.cap2", "Agr.cap")], "old string, new string"),
    )


def test_relational_covers_recorder_fix(spark):
    gr = CM.relational_covers(inputs(spark))
    got = {(r.Year, r.species): r.cover for r in gr.collect()}
    # 2015: Siri, sum 50 / total 50 = 1.0 < 1.35 -> all covers x 1.3
    assert got[(2015, "Ach.mil")] == 30.0 * 1.3 and got[(2015, "Agr.cap")] == 20.0 * 1.3
    # 2016: a subplot-only species (no cover) makes the sum unknown: no fix, and the row is dropped
    assert got[(2016, "Ach.mil")] == 30.0 and (2016, "Equ.arv") not in got
    # turf renamed through the dictionary, block from the 4th character
    assert {(r.turfID, r.blockID, r.Treatment) for r in gr.collect()} == {("Fau1C", "1", "C")}


def test_composition_long(spark):
    c = CM.composition_long(inputs(spark))
    assert "Empty sp" not in c.columns and "Vis vul" in c.columns  # dropped all-missing; kept outside the range
    got = {(r.turfID, r.Year, r.species, r.cover, r.presence) for r in c.collect()}
    assert ("Alr1F", 2016, "Ach.mil", None, 1.0) in got
    assert ("Alr2F", 2017, "Agr.cap", 9.0, None) in got  # keyed correction, then merge dictionary renames back


def test_community_end_to_end(spark):
    out = CM.community(inputs(spark), spark.conf.get("spark.checkpoint.dir"))
    assert out.columns == ["siteID", "blockID", "Treatment", "turfID", "Year", "graminoidCov", "forbCov", "mossCov",
                           "vegetationHeight", "mossHeight", "litter", "cover", "species", "functionalGroup",
                           "sumcover"]
    got = {(r.turfID, r.Year, r.species): (r.cover, r.functionalGroup) for r in out.collect()}
    # 2016 Ach.mil of Alr1F: presence without cover, neighbours 10 (2015) and 20 (2017) -> 15;
    # the 2016 sheet also holds a second % row with cover 4, and that site mean (4) wins
    assert got[("Alr1F", 2016, "Ach.mil")][0] == 4.0
    assert got[("Alr1F", 2017, "Ach.mil")] == (20.0, "forb")
    assert got[("Alr1F", 2015, "Agr.cap")] == (5.0, "graminoid")
    fau = {k: v for k, v in got.items() if k[0].startswith("Fau")}
    assert fau[("Fau1C", 2015, "Ach.mil")][0] == 30.0 * 1.3
    moss = {(r.turfID, r.Year): r.mossCov for r in out.collect()}
    assert moss[("Alr1F", 2015)] == 0.0  # acro 3 gives total 3, then the point correction sets 0


def test_every_stage_of_the_registered_chain_fires(spark):
    """On the driver tables each later stage meets rows that it changes."""
    from plotwise.operators import joins as J
    from plotwise.plans import catalog
    from plotwise.session import stage
    folder, sf = spark.conf.get("spark.checkpoint.dir"), "/root/testdata/sf0.001"
    inp = catalog._community_inputs(spark, sf)
    comp = stage(CM.composition_long(inp, folder), folder, "c")
    gr = stage(CM.relational_covers(inp), folder, "g")
    fgbs, t1516, t17 = CM.side_tables(comp, inp.bryophytes_2017)
    merged = stage(CM.merge_and_impute(comp, gr, folder), folder, "m")
    keys = ["siteID", "blockID", "Treatment", "turfID", "Year", "TTtreat"]
    assert comp.filter("presence = 1").groupBy("siteID", "blockID", "turfID", "Treatment", "Year", "species", "recorder").count().filter("count > 1").limit(1).count() == 1  # presence multiplicity
    assert J.semi_join(merged, t1516.select(*keys), keys).limit(1).count() == 1
    k17 = keys + ["recorder", "acro", "pleuro"]
    assert J.semi_join(merged, t17.filter("Year = 2017").select(*k17), k17).limit(1).count() == 1
    assert J.semi_join(comp, gr, ["siteID", "blockID", "turfID", "Treatment", "Year", "species"]).limit(1).count() == 1
    out = stage(CM.rejoin_attributes(merged, t1516, t17, fgbs), folder, "r")
    target = "turfID = 'Alr2XC' and Year = 2016 and species = 'Agr.cap'"
    assert out.filter(target).count() > 1
    # (the species fixes of Hol.lan in 2017 meet their first rows at sf0.01)
    assert out.filter("turfID = 'Vik2C' and Year = 2015").limit(1).count() == 1
    done = CM.finalize(out, CM.functional_groups(inp.character_traits))
    assert done.filter("species = 'Jun.sp' and functionalGroup = 'graminoid'").limit(1).count() == 1


def test_empty_columns_are_found_while_the_sheets_are_written(spark, monkeypatch):
    from plotwise.operators import reshape as R
    folder = spark.conf.get("spark.checkpoint.dir")
    want = CM.composition_long(inputs(spark)).columns

    def counted(*_):
        raise AssertionError("a pass of its own")

    monkeypatch.setattr(R, "non_null_counts", counted)
    got = CM.composition_long(inputs(spark), folder)
    assert got.columns == want and "Empty sp" not in got.columns and got.count() > 0


def test_sheet_of_2018_with_averaged_heights(spark):
    """Heights of the 2018 sheet are means per turf over its readings, written with 15 digits; trial and outside rows stay out."""
    inp = inputs(spark)
    base = row("Alrust", "1", "F", "Alr1F", "%", "2018", "A", "20", "7")
    at = {c: i for i, c in enumerate(SHEET_COLS)}

    def reading(turf="Alr1F", sub="%", height="5", moss="2", tt=None):
        r = list(base)
        r[at["turfID"]], r[at["subPlot"]], r[at["vegetationHeight"]], r[at["mossHeight"]], r[at["TTtreat"]] = turf, sub, height, moss, tt
        return tuple(r)

    inp.sheet_2018 = sheet(spark, [reading(height="10"), reading(sub="1", height="x", moss=None), reading(sub="2", height="1"), reading(sub="3", height="3", moss="1"),
                                   reading(turf="Alr9OUT"), reading(tt="TT1 5", height="900"), reading(tt="OUT", height="900")])
    got = [(r.turfID, r.vegetationHeight, r.mossHeight) for r in CM.average_heights(inp.sheet_2018).filter("subPlot = '%'").collect()]
    assert got == [("Alr1F", "4.66666666666667", "1.66666666666667")]
    c = CM.composition_long(inp).filter("Year = 2018")
    assert {(r.turfID, r.vegetationHeight, r.mossHeight, r.species) for r in c.collect()} == {("Alr1F", 4.66666666666667, 1.66666666666667, s) for s in ("Ach.mil", "Agr.cap", "Vio.sp")}
    assert CM.community(inp, spark.conf.get("spark.checkpoint.dir")).filter("Year = 2018").count() > 0


def test_sheet_rows_are_corrected_before_they_are_made_long(spark):
    """Joins and identity fixes meet one row per sheet row, not one per species; repeated dictionary entries still repeat their rows."""
    inp = inputs(spark)
    corr, merge = "old string, new string, siteID string, turfID string, Year int, cover string, functionalGroup string", "old string, new string"
    keyed = ("Agr.cap", "Agr.cap2", "Alrust", "Alr2F", 2017, "9", None)
    inp.species_corrections = spark.createDataFrame([keyed, keyed, ("Ach.mil", None, "Alrust", "Alr2F", 2017, "3", None)], corr)
    inp.merge_dictionary = spark.createDataFrame([("Agr.cap2", "Agr.cap"), ("Ach.mil", "A"), ("Ach.mil", "B"), ("Vio.sp", "A")], merge)
    c = CM.composition_long(inp, spark.conf.get("spark.checkpoint.dir"))
    plan = c._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Generate") < plan.index("Join")
    got = sorted((r.species, r.cover) for r in c.filter("turfID = 'Alr2F'").collect())
    assert got == [("A", 2.0), ("A", 3.0), ("Agr.cap", 9.0), ("Agr.cap", 9.0), ("B", 3.0)]


def test_cells_of_one_name_are_imputed_together(spark):
    """A cell without cover and presence takes the cover imputed for another cell of its keys (here two columns of one name), whether the
    composition comes long or one row per sheet row."""
    inp = inputs(spark)
    inp.merge_dictionary = spark.createDataFrame([("Vio.sp", "Ach.mil")], "old string, new string")
    inp.sheets[0] = inp.sheets[0].limit(2).union(sheet(spark, [row("Alrust", "2", "F", "Alr9F", "%", "2016", "A", "5", "4", vio="9")]))
    folder = spark.conf.get("spark.checkpoint.dir")
    gr = CM.relational_covers(inp)
    nested = CM.with_blanks(CM.composition_nested(inp, folder))
    assert nested.count() == 5  # one row per cover row of the sheets
    flat = CM.merge_and_impute(CM.composition_long(inp, folder), gr, folder)
    out = CM.cells_long(CM.merge_and_impute(nested, gr, folder)).drop("presence")
    at = "turfID = 'Alr1F' and Year = 2016 and species = 'Ach.mil'"
    assert [r.cover for r in out.filter(at).collect()] == [7.0, 7.0]  # site mean of 5 and 9
    assert sorted(map(str, out.select(flat.columns).collect())) == sorted(map(str, flat.collect()))


def test_long_rows_are_shuffled_once_after_the_roll_up(spark):
    from plotwise.session import stage
    folder = spark.conf.get("spark.checkpoint.dir")
    inp = inputs(spark)
    gr, comp = CM.relational_covers(inp), CM.composition_long(inp, folder)
    c2 = stage(CM.rejoin_attributes(CM.merge_and_impute(comp, gr, folder), *CM.side_tables(comp, inp.bryophytes_2017)[1:], CM.side_tables(comp, inp.bryophytes_2017)[0]), folder, "r")
    groups = stage(CM.functional_groups(inp.character_traits), folder, "fg")
    old = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = CM.finalize(c2, groups)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", old)
    assert "cover" in plan and "hashpartitioning(turfID" in plan
    assert sum("Exchange hashpartitioning" in x and "siteID" in x for x in plan.splitlines()) == 0  # the distinct step
