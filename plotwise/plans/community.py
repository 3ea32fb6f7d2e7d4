"""Plant community composition: relational plot database + yearly field
sheets -> one clean cover table per turf, year and species.

Stages (each a DataFrame -> DataFrame step, all lazy):

1. ``relational_covers`` - subplot counts fully joined to turf covers, then
   the dimension chain (taxon, turfs, plots, blocks, sites, environment);
   unit and observer rescaling, ratio-gated recorder fixes, restriction to
   the transplant-control dictionary, rows carried into a missing year.
2. ``composition_long`` - yearly sheets (all text) unioned by name, the
   species range turned long, presence rows flagged, names corrected in two
   dictionary stages, turf/block identity fixes.
3. ``merge_and_impute`` - database rows patched into the sheets, missing
   covers imputed (adjacent sampling occasions, then site means, which win),
   attributes re-joined, moss components zero-filled, ids rebuilt.
4. ``finalize`` - targeted sums, functional-group roll-up, strict group
   sums, point corrections, distinct, site-name fixes.

The bound sheets, the composition, the database rows, the pre-imputation frame
and the re-joined frame are each read several times; with a ``staging`` folder
(shared by all executors) they are written there as Parquet once.

Column ranges of the sheets are given by their first/last names (the
positions depend on each sheet's layout), so the same code runs on any
layout that keeps those names in order.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import semantics as S
from ..operators import corrections as C
from ..operators import grouped as G
from ..operators import impute as I
from ..operators import joins as J
from ..operators import quality as Q
from ..operators import reshape as R
from ..operators import rules as RU
from ..session import stage, stage_observed
from . import dictionaries as D
from ..sources.inline import inline_table

KEYS6 = ["siteID", "blockID", "Treatment", "turfID", "species", "Year"]


@dataclass
class SheetLayout:
    """Names bounding the column ranges of the composition sheets."""

    id_first: str = "siteID"
    id_last: str = "subPlot"
    totals_first: str = "totalGraminoids"
    totals_last: str = "mossHeight"
    species_first: str = "Ach mil"
    species_last_kept: str = "Vis vul"
    species_last_long: str = "Vio sp"
    numeric: tuple = ("totalGraminoids", "totalForbs", "totalBryophytes", "vegetationHeight", "mossHeight",
                      "litter", "acro", "pleuro")


@dataclass
class CommunityInputs:
    character_traits: DataFrame
    sub_turf_community: DataFrame
    turf_community: DataFrame
    taxon: DataFrame
    turfs: DataFrame
    plots: DataFrame
    blocks: DataFrame
    sites: DataFrame
    turf_environment: DataFrame
    sheets: list  # yearly composition sheets, all text, in binding order
    sheet_2018: DataFrame | None  # the sheet whose heights are averaged per turf
    bryophytes_2017: DataFrame
    species_corrections: DataFrame  # old, new, siteID, turfID, Year, cover(text), functionalGroup
    merge_dictionary: DataFrame  # old, new
    layout: SheetLayout = field(default_factory=SheetLayout)


# fixed values: recorder fixes (recorder, test, threshold, factor)
RECORDER_RULES = [I.GateRule("Siri", "<", 1.35, 1.3), I.GateRule("Owen", ">", 1.5, 1.5, divide=True)]

# fixed values: point corrections (turfID, Year, column, value)
POINT_FIXES = [
    ("Alr3G", 2017, "mossHeight", 8.6), ("Alr5F", 2017, "mossHeight", 17.5), ("Alr5G", 2017, "mossHeight", 17.5),
    ("Fau2F", 2017, "mossHeight", 4.0), ("Alr1C", 2017, "mossHeight", 15.0), ("Ulv2C", 2017, "mossHeight", 0.0),
    ("Ovs1C", 2017, "mossHeight", 21.0),
    ("Ulv3B", 2017, "vegetationHeight", 44.5), ("Arh2FB", 2017, "vegetationHeight", 127.5),
    ("Ovs1C", 2017, "vegetationHeight", 76.85),
    ("Alr1F", 2015, "totalBryophytes", 0.0), ("Alr1FGB", 2015, "totalBryophytes", 0.0),
    ("Ovs1C", 2015, "totalBryophytes", 100.0), ("Fau2C", 2015, "totalBryophytes", 40.0),
    ("Fau2C", 2015, "totalForbs", 65.0), ("Gud12C", 2015, "totalForbs", 70.0), ("Vik2C", 2015, "totalForbs", 60.0),
    ("Gud12C", 2015, "totalGraminoids", 22.0), ("Vik2C", 2015, "totalGraminoids", 30.0),
]
# fixed values: species-level corrections (turfID, Year, species, column, value)
SPECIES_FIXES = [
    ("Fau1C", 2017, "Hol.lan", "graminoidCov", 70.0), ("Fau2C", 2017, "Hol.lan", "graminoidCov", 60.0),
    ("Vik5C", 2017, "Hol.lan", "graminoidCov", 45.0),
    ("Fau1C", 2017, "Hol.lan", "forbCov", 70.0), ("Fau2C", 2017, "Hol.lan", "forbCov", 25.0),
    ("Vik5C", 2017, "Hol.lan", "forbCov", 60.0),
]
# fixed values: functional-group roll-up
GROUP_MERGE = {"pteridophyte": "forb", "woody": "forb"}
GROUP_OVERRIDES = {"graminoid": ["Jun.sp", "Phl.sp", "Luz.tri"],
                   "forb": ["Ped.pal", "Pop.tre", "Ste.als", "Ste.sp", "Porub", "Arenaria", "Pilosella"]}
CARRY_TURFS = ["297 TTC", "246 TTC"]  # fixed values: turfs copied from 2016 into 2017
FGB_TREATMENTS = ["FGB", "GF"]  # fixed values: full-removal plots re-added after 2015
FGB_AFTER = 2015


def functional_groups(traits: DataFrame) -> DataFrame:
    return (traits.filter(F.col("trait") == "functionalGroup")
            .select("species", F.col("value").alias("functionalGroup")))


def relational_covers(inp: CommunityInputs, corrected: bool = False) -> DataFrame:
    """Database stage. The recorded chain takes the block as the 4th
    character of the turf id (``Gud12C`` -> ``1``); ``corrected=True`` takes
    all digits after the site code."""
    n_sub = (inp.sub_turf_community.groupBy("turfID", "year", "species")
             .agg(F.count(F.lit(1)).alias("n_subturf")))
    d = J.natural_join(n_sub, inp.turf_community, "full")  # keeps subplot-only species (NA cover)
    d = J.natural_join(d, inp.taxon, "left")
    d = J.natural_join(d, inp.turfs, "left")
    d = J.join(d, inp.plots, [("destinationPlotID", "plotID")], "left")
    d = J.join(d, inp.blocks, "blockID", "left")
    d = J.join(d, inp.sites, "siteID", "left")
    d = J.natural_join(d, inp.turf_environment, "left")
    d = d.select("siteID", "blockID", F.col("destinationPlotID").alias("plotID"), "turfID", "TTtreat", "GRtreat",
                 F.col("year").alias("Year"), "species", "cover", "temperature_level", "precipitation_level",
                 "recorder", "totalVascular", "totalBryophytes", "vegetationHeight", "mossHeight", "litter")
    d = d.filter((F.col("Year") > 2014) & ((F.col("TTtreat") == "TTC") | (F.col("GRtreat") == "TTC")))

    cm = S.is_in("Year", [2015, 2017])
    d = C.apply_ordered_many(d, [
        ("vegetationHeight", cm, F.col("vegetationHeight") * 10),
        ("mossHeight", cm, F.col("mossHeight") * 10),
        ("mossHeight", (F.col("Year") == 2017) & (F.col("turfID") == "301 TTC"), F.lit(7.5)),
    ])
    d = C.coalesce_blank(d, "TTtreat", "GRtreat", missing_label="unknown botanist", label_col="recorder")
    d = d.drop("GRtreat")
    d = I.mask_scale(d, "cover", F.col("recorder") == "PM", 1.20)
    d = I.ratio_gated_rescale(d, ["turfID", "Year"], "cover", "recorder", "totalVascular", RECORDER_RULES)

    ttc = D.ttc_turf_df(d.sparkSession)
    d = J.semi_join(d, ttc.select(F.col("TTtreat").alias("__t")), [("turfID", "__t")], broadcast=True)
    d = d.withColumns({"Treatment": F.lit("C"), "TTtreat": F.col("turfID")})
    d = J.join(d, ttc, "TTtreat", "left", suffix=(".new", ""), broadcast=True)
    if corrected:
        d = d.withColumn("blockID", F.regexp_extract("turfID", "^...([0-9]+)", 1))
    else:
        d = d.withColumn("blockID", S.r_substr("turfID", 4, 4))
    d = d.drop("plotID", "temperature_level", "precipitation_level", "totalVascular", "litter", "turfID.new")
    d = d.filter(F.col("cover").isNotNull() & ~((F.col("TTtreat") == "37 TTC") & (F.col("Year") > 2015)))
    return C.carry_rows_forward(d, S.is_in("TTtreat", CARRY_TURFS) & (F.col("Year") == 2016), "Year", 2017)


def _signif_text(c) -> F.Column:
    """Number -> text with at most 15 significant digits (how the sheets
    store a computed mean before it is read back as a number)."""
    mag = F.floor(F.log10(F.abs(c)))
    r = F.when(c == 0, F.lit(0.0)).otherwise(F.round(c * F.pow(F.lit(10.0), F.lit(14) - mag)) /
                                             F.pow(F.lit(10.0), F.lit(14) - mag))
    return S.r_str(r)


def average_heights(sheet: DataFrame) -> DataFrame:
    s = sheet.filter(~S.matches("TTtreat", "TT1") & ~S.matches("TTtreat", "OUT") & ~S.matches("turfID", "OUT"))
    s = s.withColumns({c: S.to_num(c) for c in ("vegetationHeight", "mossHeight")})
    s = G.group_mutate(s, ["turfID"], {"vegetationHeight": F.avg("vegetationHeight"),
                                       "mossHeight": F.avg("mossHeight")})
    return s.withColumns({c: _signif_text(F.col(c)) for c in ("vegetationHeight", "mossHeight")})


def corrections_tables(inp: CommunityInputs) -> tuple[DataFrame, DataFrame]:
    p = (inp.species_corrections.filter(S.not_in("old", ["Vio.can", "Com.ten", "Sel.sel"]))
         .filter(F.col("cover") != "WHAT HAPPENED")
         .withColumn("cover", S.to_num("cover")))
    keyed = p.filter(F.col("Year").isNotNull()).drop("functionalGroup")
    names = (p.filter(F.col("Year").isNull() & S.not_in("old", ["Eri.bor"])).select("old", "new")
             .unionByName(inp.merge_dictionary.select("old", "new")))
    return keyed, names


def _header_names(names: DataFrame, headers: list[str]) -> dict[str, list[str]]:
    """What the merge dictionary makes of each species header: its new names (a repeated entry repeats the species), or itself. Read on the
    driver: entries of the sheets' own columns only."""
    found: dict[str, list[str]] = {}
    for r in names.filter(F.col("old").isin(headers)).select("old", "new").collect():
        found.setdefault(r["old"], []).append(r["old"] if r["new"] is None else r["new"])
    return {h: found.get(h, [h]) for h in headers}


def composition_nested(inp: CommunityInputs, staging: str | None = None) -> DataFrame:
    """Sheets -> one row per cover row of a sheet, its species as an array ``cells`` of (species, cover, times); ``times``: presence rows
    that mark the species there. Whatever doesn't depend on the species (types, keyed corrections, identity fixes) is done
    here once per sheet row, not once per species. The empty columns are found while the bound sheets are written to ``staging``."""
    lay = inp.layout
    sheets = list(inp.sheets)
    if inp.sheet_2018 is not None:
        sheets.append(average_heights(inp.sheet_2018))
    c = R.bind_rows(*sheets)
    c = c.filter(S.is_in("subPlot", ["%", "T"]))
    keep = (R.col_range(c, lay.id_first, lay.id_last) + ["year", "recorder"]
            + R.col_range(c, lay.totals_first, lay.totals_last) + ["litter", "acro", "pleuro"]
            + R.col_range(c, lay.species_first, lay.species_last_kept))
    c = c.select(*[F.col(f"`{x}`").alias("Year" if x == "year" else x) for x in keep])
    c, known = stage_observed(c, staging, "sheets", R.known_counts(c.columns))
    c = R.drop_all_null_columns(c, counts=known)
    if lay.species_first not in c.columns or lay.species_last_long not in c.columns:
        raise ValueError("species range endpoints must hold data in some sheet")
    long_cols = R.col_range(c, lay.species_first, lay.species_last_long)
    ids = [x for x in c.columns if x not in long_cols and x != "subPlot"]
    nums = [x for x in R.col_range(c, lay.totals_first, "pleuro") if x in lay.numeric]

    # presence: every presence ('T') row that holds a value for a species in a
    # turf-year matches the species' cover ('%') rows there, so a cover row is
    # repeated that often. The marks are counted on the wide rows (one per sheet
    # row, not one per species) and joined to the cover rows before they are
    # turned long, so the join moves 1/len(species) of the long data.
    keys = ["siteID", "Treatment", "turfID", "Year"]
    pres = (c.filter(F.col("subPlot") == "T").groupBy(*keys)
            .agg(F.array(*[F.count(F.col(f"`{sp}`")).cast("int") for sp in long_cols]).alias("__times")))
    # the cells are converted in a loop over an array: one expression per species makes a method too large to be compiled
    cover = c.filter(F.col("subPlot") == "%").select(
        *[(S.to_num(F.col(f"`{x}`")).alias(x) if x in nums else F.col(f"`{x}`")) for x in ids],
        F.transform(F.array(*[F.col(f"`{sp}`") for sp in long_cols]), S.to_num).alias("__covers"))
    c = J.join(cover, pres, keys, "left").withColumn("Year", S.to_num("Year").cast("int"))

    keyed, names = corrections_tables(inp)
    spark = names.sparkSession
    named = list(spark.range(1).select(F.array(*[C.normalise_names(F.lit(sp)) for sp in long_cols])).first()[0])
    final = _header_names(names, named)

    def cell(species, header, cover=None) -> F.Column:
        found = F.get("__covers", header)
        return F.struct(species.alias("species"), (found if cover is None else F.coalesce(cover, found)).alias("cover"),
                        F.coalesce(F.get("__times", header), F.lit(0)).alias("times"), header.alias("header"))
    # the keyed corrections of a sheet row: name (after the merge dictionary), cover and header
    at = inline_table(spark, [(h, i) for i, h in enumerate(named)], "__h string, header int")
    keyed = keyed.withColumns({"Year": F.col("Year").cast("int"), "__s": F.coalesce("new", "old")}).drop("new")
    keyed = J.join(J.join(keyed, names, [("__s", "old")], "left", suffix=("", ".names")), at, [("old", "__h")], "inner")
    keyed = keyed.groupBy("Year", "turfID", "siteID").agg(F.collect_list(F.struct(
        F.coalesce("new", "__s").alias("species"), "cover", "header")).alias("__keyed"))
    c = J.join(c, keyed, ["Year", "turfID", "siteID"], "left")
    species = F.array(*[F.struct(F.lit(sp).alias("species"), F.lit(i).alias("header")) for i, h in enumerate(named) for sp in final[h]])
    others = F.filter(species, lambda h: ~F.exists("__keyed", lambda k: k["header"] == h["header"]))
    own = lambda hs: F.transform(hs, lambda h: cell(h["species"], h["header"]))
    c = c.withColumn("cells", F.when(F.col("__keyed").isNull(), own(species)).otherwise(
        F.concat(own(others), F.transform("__keyed", lambda k: cell(k["species"], k["header"], k["cover"])))))
    return identity_fixes(c.select(*[F.col(f"`{x}`") for x in ids], "cells"))


def cells_long(c: DataFrame) -> DataFrame:
    """Rows with ``cells`` -> one row per species and presence mark, with ``presence``; a row without cells keeps one without a species."""
    c = c.select(*[F.col(f"`{x}`") for x in c.columns if x != "cells"], F.inline_outer("cells")).drop("header")
    c = c.withColumn("presence", F.when(F.col("times") > 0, F.lit(1.0)))
    return c.withColumn("times", F.explode(F.array_repeat(F.lit(1), F.greatest("times", F.lit(1))))).drop("times")


def with_blanks(c: DataFrame) -> DataFrame:
    """Cells without cover and presence as names alone, ``blanks`` (a JSON list, far shorter than an array in a shuffle): only a database row
    or the imputed cover of another row of the same keys can fill them."""
    holds = lambda x: x["cover"].isNotNull() | (x["times"] > 0)
    bare = lambda x: F.struct(x["species"].alias("species"), x["cover"].alias("cover"), x["times"].alias("times"))
    return c.withColumns({"blanks": F.to_json(F.transform(F.filter("cells", lambda x: ~holds(x)), lambda x: x["species"])),
                          "cells": F.transform(F.filter("cells", holds), bare)})


def _nested(c: DataFrame) -> DataFrame:
    """Long rows as rows of one cell each."""
    if "cells" in c.columns:
        return c
    one = F.array(F.struct("species", "cover", F.when(F.col("presence").isNotNull(), 1).otherwise(0).alias("times")))
    return with_blanks(c.withColumn("cells", one).drop("species", "cover", "presence"))


def composition_long(inp: CommunityInputs, staging: str | None = None) -> DataFrame:
    """Sheets -> long cover table: the cells of :func:`composition_nested`, one row each."""
    c = composition_nested(inp, staging)
    ids = [x for x in c.columns if x not in ("cells", "turfID.new")]
    return cells_long(c).select(*[F.col(f"`{x}`") for x in ids], "species", "cover", "presence", "`turfID.new`")


# fixed values: ordered identity repairs of turfs and blocks (target, tests, new value or (old, new) text within it)
IDENTITY_RULES = RU.as_rules([
    ("turfID", [("blockID", "==", "16"), ("siteID", "==", "Gudmedalen")], ("16", "5")),
    ("turfID", [("siteID", "==", "Alrust"), ("blockID", "==", "3"), ("Year", "==", 2015), ("Treatment", "==", "C")], "Alr3C"),
    ("turfID", [("turfID", "==", "Alr4FGB")], "Alr5C"),
    ("turfID", [("turfID", "==", "Lav1G ")], "Lav1G"),
    ("blockID", [("blockID", "==", "16"), ("siteID", "==", "Gudmedalen")], ("16", "5")),
    ("blockID", [("turfID", "==", "Gud12C")], "12"),
])


def identity_fixes(c: DataFrame) -> DataFrame:
    ttc = D.ttc_turf_df(c.sparkSession)
    c = J.join(c, ttc, [("turfID", "TTtreat")], "left", suffix=(".old", ".new"), broadcast=True)
    c = c.withColumn("turfID", F.coalesce("`turfID.new`", "turfID"))
    c = RU.apply_rules(c, IDENTITY_RULES)
    drop = [
        (F.col("blockID") == "4") & (F.col("Year") == 2015) & (F.col("siteID") == "Alrust"),
        (F.col("turfID") == "Gud12C") & (F.col("Year") == 2015),
        (F.col("turfID") == "Alr3C") & (F.col("recorder") == "Siri"),
    ]
    for d in drop:
        c = c.filter(~d)
    return c.filter(F.col("turfID").isNotNull())


def side_tables(comp: DataFrame, bryo: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Attribute tables of the composition, long or with ``cells`` (of the species they only need whether any has, or lacks, presence)."""
    ttc = D.ttc_turf_df(comp.sparkSession)
    fgbs = comp.filter(S.is_in("Treatment", FGB_TREATMENTS))
    if "cells" in comp.columns:
        marks = F.concat(F.transform("cells", lambda x: x["times"] > 0), F.when(F.col("blanks") != "[]", F.array(F.lit(False))).otherwise(F.array()))
        fgbs = fgbs.withColumn("presence", F.explode(F.array_distinct(marks)))
        comp = comp.drop("cells", "blanks")
    fgbs = (fgbs.drop("species", "cover", "cells", "blanks", "turfID.new")
            .distinct().filter(F.col("Year") > FGB_AFTER))
    t1516 = (comp.filter((F.col("Treatment") == "C") & S.not_in("Year", [2017, 2018]) & F.col("Year").isNotNull()))
    t1516 = J.natural_join(t1516, ttc, "right", broadcast=True)
    t1516 = t1516.drop("species", "cover", "pleuro", "acro", "litter", "presence", "turfID.new", "recorder").distinct()
    t17 = comp.filter((F.col("Treatment") == "C") & (F.col("Year") == 2017))
    t17 = J.natural_join(t17, ttc, "right", broadcast=True).drop("turfID.new", "cover", "presence", "species").distinct()
    t17 = J.join(t17, bryo, "turfID", "full", suffix=(".old", ""))
    t17 = t17.drop("totalBryophytes.old", "mossHeight.old", "vegetationHeight.old", "TTtreat.old", "litter")
    return fgbs, t1516, t17


def merge_and_impute(comp: DataFrame, gr: DataFrame, staging: str | None = None) -> DataFrame:
    """Long in, long out; rows with ``cells`` stay rows with ``cells`` (those of known cover)."""
    c = _nested(comp).withColumn("blockID", S.if_else_na(F.char_length("blockID") > 1,
                                                         F.regexp_replace("blockID", "[^0-9]", ""), F.col("blockID"))).drop("turfID.new")
    # the database rows are few (one dictionary of turfs) but grow with years and
    # species: no broadcast hint, Spark measures them. Only sheet rows of their
    # turf-years can meet one, so only these are made long for the full join.
    plot = [k for k in KEYS6 if k != "species"]
    filled = c.withColumn("cells", F.concat("cells", F.transform(F.from_json("blanks", "array<string>"), lambda b: F.struct(
        b.alias("species"), F.lit(None).cast("double").alias("cover"), F.lit(0).alias("times"))))).drop("blanks")
    in_db = gr.select(*plot).distinct()
    met = J.patch_join(cells_long(J.semi_join(filled, in_db, plot)), gr, ["siteID", "blockID", "turfID", "Treatment", "Year", "species"],
                       ["cover", "recorder", "totalBryophytes", "vegetationHeight", "mossHeight"], "full").drop("TTtreat.new")
    met = stage(_nested(met), staging, "merged")
    c2 = J.anti_join(c, in_db, plot).unionByName(met)

    idx = G.sampling_index(c2, "turfID", "Year")
    known = cells_long(c2.select(*plot, "cells"))
    adj = I.adjacent_impute(known, unit=["turfID"], item=["species"], period="Year", value="cover",
                            presence="presence", out_keys=KEYS6, index=idx)
    miss = (known.filter(~(F.col("Treatment") == "XC"))
            .filter(F.col("cover").isNull() & F.col("presence").isNotNull()).select(*KEYS6).distinct())
    site_mean = I.group_mean_impute(known, ["siteID", "species", "Year"], "cover", miss)
    # site mean applied last: it wins
    out = I.apply_imputations(c2, KEYS6, "cover", adj, site_mean, item="species", cells="cells", blanks="blanks")
    return out if "cells" in comp.columns else cells_long(out).drop("presence")


def rejoin_attributes(c2: DataFrame, t1516: DataFrame, t17: DataFrame, fgbs: DataFrame) -> DataFrame:
    cols = ["mossHeight", "vegetationHeight", "totalBryophytes", "totalGraminoids", "totalForbs"]
    k = ["siteID", "blockID", "Treatment", "turfID", "Year", "TTtreat"]
    c2 = J.patch_join(c2, t1516.select(*k, *[x for x in cols if x in t1516.columns]), k,
                      [x for x in cols if x in t1516.columns], "left")
    k17 = k + ["recorder", "acro", "pleuro"]
    c2 = J.patch_join(c2, t17.select(*k17, *[x for x in cols if x in t17.columns]), k17,
                      [x for x in cols if x in t17.columns], "left")
    c2 = c2.drop("TTtreat")
    # natural full join with the FGB plot rows (T11: a repeated FGB row
    # repeats the rows it matches). Only rows of FGB/GF plots after 2015 can
    # match one, so only that slice of the long table takes part in the join;
    # the rest is passed through untouched.
    f = fgbs.drop(*[x for x in fgbs.columns if x not in c2.columns])
    can_match = S.is_in("Treatment", FGB_TREATMENTS) & F.coalesce(F.col("Year") > FGB_AFTER, F.lit(False))
    joined = J.natural_join(c2.filter(can_match), f, "full")
    c2 = c2.filter(~can_match).unionByName(joined)
    c2 = C.paired_zero_fill(c2, "acro", "pleuro", "totalBryophytes")
    c2 = C.rebuild_ids(c2, "turfID", "siteID", "TTC")
    c2 = c2.withColumn("Treatment", F.regexp_replace("Treatment", " ", ""))
    if "cells" in c2.columns:
        c2 = c2.withColumn("cells", F.transform("cells", lambda x: x.withField("species", F.regexp_replace(x["species"], " ", "."))))
    else:
        c2 = c2.withColumn("species", F.regexp_replace("species", " ", "."))
    return c2.withColumn("blockID", S.if_else_na(F.col("turfID") == "Gud12C", F.lit("12"), F.col("blockID")))


def finalize(c2: DataFrame, fg: DataFrame) -> DataFrame:
    spark = c2.sparkSession
    c2 = G.targeted_group_sum(c2, ["turfID", "Year", "species"], "cover",
                              (F.col("turfID") == "Alr2XC") & (F.col("Year") == 2016) & (F.col("species") == "Agr.cap"),
                              key_pred=True)
    c2 = C.class_rollup(c2, fg, "species", "species", "functionalGroup", "functionalGroup",
                        merge_patterns=GROUP_MERGE, key_overrides=GROUP_OVERRIDES)
    # equal rows lie in one group: its key spares the distinct step a shuffle
    c2 = G.group_sum_strict(c2, ["turfID", "Year", "functionalGroup"], "cover", "sumcover", key_out="__group")
    fixes = inline_table(spark, POINT_FIXES, "turfID string, Year int, column string, value double")
    cols = ["mossHeight", "vegetationHeight", "totalBryophytes", "totalForbs", "totalGraminoids"]
    c2 = C.point_corrections(c2, fixes, ["turfID", "Year"], cols, broadcast=True)
    c2 = c2.withColumnsRenamed({"totalForbs": "forbCov", "totalBryophytes": "mossCov",
                                "totalGraminoids": "graminoidCov"})
    c2 = c2.drop("acro", "pleuro")
    sp = inline_table(spark, SPECIES_FIXES, "turfID string, Year int, species string, column string, value double")
    c2 = C.point_corrections(c2, sp, ["turfID", "Year", "species"], ["graminoidCov", "forbCov"], broadcast=True)
    out = c2.select("siteID", "blockID", "Treatment", "turfID", "Year", "graminoidCov", "forbCov", "mossCov",
                    "vegetationHeight", "mossHeight", "litter", "cover", "species", "functionalGroup",
                    "sumcover", "__group").distinct().drop("__group")
    return out.withColumn("siteID", S.recode("siteID", D.SITE_NAME_FIXES))


def community(inp: CommunityInputs, staging: str) -> DataFrame:
    """The whole chain. ``staging``: a folder shared by all executors for the
    frames that are read several times."""
    gr = stage(relational_covers(inp), staging, "database")
    comp = stage(with_blanks(composition_nested(inp, staging)), staging, "composition")
    fgbs, t1516, t17 = side_tables(comp, inp.bryophytes_2017)
    # small tables, written so that their size is known where they are joined
    t1516, t17 = stage(t1516, staging, "attributes_1516"), stage(t17, staging, "attributes_17")
    fg = stage(functional_groups(inp.character_traits), staging, "groups")
    c2 = merge_and_impute(comp, gr, staging)
    c2 = stage(rejoin_attributes(c2, t1516, t17, fgbs), staging, "attributes")
    return finalize(cells_long(c2).drop("presence"), fg)


def duplicate_cover_check(c2: DataFrame) -> DataFrame:
    """Turf-year-species with more than one distinct cover (should be empty)."""
    return Q.duplicate_value_check(c2, ["turfID", "Year", "species"], "cover")
