"""Removed-biomass dataset: raw sheets -> clean table -> plot-ready totals.

One narrow chain: every lookup is a fixed-size table (broadcast), the record
repairs are column expressions, so the only shuffle is the final totals
aggregation.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import semantics as S
from ..operators import impute as I
from ..operators import joins as J
from ..operators import rules as RU
from . import dictionaries as D

# declared sheet schema (every sheet of the workbook, exported one file each)
RAW_SCHEMA = T.StructType([
    T.StructField("Year", T.DoubleType()), T.StructField("Site", T.StringType()),
    T.StructField("Block", T.DoubleType()), T.StructField("Treatment", T.StringType()),
    T.StructField("Removed functional group", T.StringType()), T.StructField("Date", T.TimestampType()),
    T.StructField("Round", T.StringType()), T.StructField("Biomass", T.DoubleType()),
    T.StructField("Name", T.StringType()), T.StructField("Remark", T.StringType()),
])

# Ordered record repairs (target, tests, new value).
# A test is (column, "==" value | "in" values | "isna").
REPAIRS = RU.as_rules([
    ("block", [("year", "==", 2019), ("site", "==", "ARH"), ("block", "isna", None)], 4.0),
    ("block", [("year", "==", 2015), ("site", "==", "ALR"), ("block", "==", 4)], 5.0),
    ("block", [("year", "==", 2016), ("site", "==", "ALR"), ("block", "==", 1), ("name", "==", "Olav")], 2.0),
    ("block", [("year", "==", 2017), ("site", "==", "ALR"), ("block", "==", 1), ("name", "==", "Anja Petek")], 2.0),
    ("block", [("year", "==", 2019), ("site", "==", "HOG"), ("block", "==", 3), ("treatment", "==", "F"),
               ("name", "==", "PS")], 4.0),
    ("block", [("year", "==", 2019), ("site", "==", "ULV"), ("block", "in", [4, 5, 6]), ("name", "==", "IA")], 3.0),
    ("block", [("year", "==", 2019), ("site", "==", "VES"), ("block", "==", 3), ("treatment", "==", "FGB"),
               ("name", "==", "PS")], 4.0),
    ("treatment", [("year", "==", 2019), ("site", "==", "VIK"), ("block", "==", 5), ("biomass", "==", 0.57),
                   ("name", "==", "VG")], "FB"),
    ("removed_fg", [("year", "==", 2019), ("site", "==", "VIK"), ("block", "==", 2), ("biomass", "==", 1.77),
                    ("name", "==", "sari")], "F"),
    ("removed_fg", [("year", "==", 2019), ("site", "==", "GUD"), ("block", "==", 12), ("biomass", "==", 0.56),
                    ("name", "==", "PS")], "G"),
    ("removed_fg", [("year", "==", 2019), ("site", "==", "GUD"), ("block", "==", 12), ("biomass", "==", 0.17),
                    ("name", "==", "PS")], "B"),
    ("removed_fg", [("year", "==", 2019), ("site", "==", "GUD"), ("block", "==", 12), ("biomass", "==", 0.89),
                    ("name", "==", "PS")], "G"),
    ("treatment", [("year", "==", 2019), ("site", "==", "SKJ"), ("block", "==", 2), ("biomass", "in", [0.43, 1.84]),
                   ("name", "==", "sari")], "FB"),
])


def clean_biomass(raw: DataFrame, rounds: DataFrame | None = None, dates: DataFrame | None = None,
                  corrected: bool = False) -> DataFrame:
    """Raw sheets -> clean biomass table. ``corrected=True`` drops the
    duplicated row of the date lookup, which otherwise doubles the affected
    rows (kept by default, as recorded)."""
    spark = raw.sparkSession
    rounds = rounds if rounds is not None else D.biomass_rounds_df(spark)
    dates = dates if dates is not None else D.biomass_dates_df(spark)
    b = raw.select(F.col("Year").alias("year"), F.col("Date").alias("date"), F.col("Site").alias("site"),
                   F.col("Block").alias("block"), F.col("Treatment").alias("treatment"),
                   F.col("`Removed functional group`").alias("removed_fg"), F.col("Round").alias("round"),
                   F.col("Biomass").alias("biomass"), F.col("Name").alias("name"), F.col("Remark").alias("remark"))
    b = b.withColumns({"site": S.recode("site", {"OVSen": "OVS"}),
                       "round": S.str_sub_from("round", -1),
                       "date": F.to_date("date")})
    rounds = rounds.withColumns({"year": F.col("year").cast("double"),
                                 "block": F.transform("block", lambda x: x.cast("double"))})
    b = I.explode_lookup_fill(b, rounds, "block", ["year", "site", "block"], "round", "round_new",
                              broadcast=True)  # fixed table
    b = b.filter(F.col("treatment") != "RTC")
    b = RU.apply_rules(b, REPAIRS)
    dates = dates.withColumn("year", F.col("year").cast("double"))
    if corrected:
        dates = dates.distinct()
    b = I.lookup_fill(b, dates, ["year", "site"], "date", "newdate", broadcast=True)  # duplicated OVS row doubles rows
    b = b.withColumn("site", S.recode("site", D.SITE_FROM_FIELD_CODE))
    b = b.withColumn("block", S.paste(S.r_substr("site", 1, 3), S.r_str("block")))
    b = b.withColumn("plotID", S.paste("block", "treatment"))
    return b.select(F.col("year").cast("int").alias("year"), "date", "round", F.col("site").alias("siteID"),
                    F.col("block").alias("blockID"), "plotID", "treatment", "removed_fg", "biomass", "name", "remark")


def with_climate(df: DataFrame, climate: DataFrame | None = None) -> DataFrame:
    """Attach zone, precipitation level and the ordered climate label (a
    label outside the level list is NULL)."""
    climate = climate if climate is not None else D.climate_df(df.sparkSession)
    j = J.join(df, climate, "siteID", "left", broadcast=True)
    lab = F.concat(F.col("biogeographic_zone"), F.col("prep_level").cast("string"))
    rank = S.level_rank(lab, D.CLIMATE_LEVELS)
    return j.withColumns({"climate": F.when(rank.isNotNull(), lab), "climate_rank": rank})


def plot_totals(clean: DataFrame) -> DataFrame:
    """Stacked-bar totals: biomass per year x climate x treatment x removed group."""
    t = with_climate(clean)
    rank = S.level_rank("treatment", D.PLOT_TREATMENT_LEVELS)
    t = t.withColumn("treatment", F.when(rank.isNotNull(), F.col("treatment")))
    return (t.groupBy("year", "climate", "treatment", "removed_fg")
            .agg(F.sum("biomass").alias("biomass")))


def unique_key_rule(clean: DataFrame) -> DataFrame:
    from ..operators import quality as Q
    return Q.unique_key_violations(clean, ["year", "siteID", "blockID", "treatment", "removed_fg", "round"])
