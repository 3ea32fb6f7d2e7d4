"""Lookup tables of the field survey, held as data.

Fixed values: these names, codes and dates must equal the survey's own
records for results to match; they are listed as text, in their natural
order. Each ``*_df`` helper turns one into a small DataFrame (bounded size,
so joins against it may broadcast).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from ..sources.inline import inline_table

# --- fixed values: site codes (old, v2, v3, new) ---------------------------
SITE_CODES = [
    ("Arh", "ARH", "arh", "Arhelleren"),
    ("Ovs", "OVS", "ovs", "Ovstedal"),
    ("Ves", "VES", "ves", "Veskre"),
    ("Skj", "SKJ", "skj", "Skjellingahaugen"),
    ("Lav", "LAV", "lav", "Lavisdalen"),
    ("Gud", "GUD", "gud", "Gudmedalen"),
    ("Ulv", "ULV", "ulv", "Ulvhaugen"),
    ("Vik", "VIK", "vik", "Vikesland"),
    ("Hog", "HOG", "hog", "Hogsete"),
    ("Alr", "ALR", "alr", "Alrust"),
    ("Fau", "FAU", "fau", "Fauske"),
    ("Ram", "RAM", "ram", "Rambera"),
]

# --- fixed values: transplant-control turf -> removal-experiment turf (TTtreat, turfID) -
TTC_TURF = [
    ("51 TTC", "Fau1C"), ("57 TTC", "Fau2C"), ("68 TTC", "Fau4C"), ("73 TTC", "Fau5C"),
    ("29 TTC", "Alr1C"), ("31 TTC", "Alr2C"), ("37 TTC", "Alr3C"),
    ("134 TTC", "Vik2C"), ("140 TTC", "Vik3C"), ("141 TTC", "Vik4C"), ("146 TTC", "Vik5C"),
    ("101 TTC", "Hog1C"), ("110 TTC", "Hog2C"), ("115 TTC", "Hog3C"),
    ("286 TTC", "Ovs1C"), ("291 TTC", "Ovs2C"), ("297 TTC", "Ovs3C"),
    ("211 TTC", "Arh1C"), ("222 TTC", "Arh3C"), ("226 TTC", "Arh4C"),
    ("263 TTC", "Ves1C"), ("281 TTC", "Ves4C"),
    ("194 TTC", "Ram4C"), ("198 TTC", "Ram5C"),
    ("6 TTC", "Ulv2C"), ("11 TTC", "Ulv3C"),
    ("236 TTC", "Skj1C"), ("243 TTC", "Skj2C"), ("246 TTC", "Skj3C"), ("251 TTC", "Skj4C"),
    ("511 TTC", "Gud12C"),
]

# --- fixed values: three-letter field codes -> site names ------------------
SITE_FROM_FIELD_CODE = {
    "ULV": "Ulvehaugen", "LAV": "Lavisdalen", "GUD": "Gudmedalen", "SKJ": "Skjelingahaugen",
    "ALR": "Alrust", "HOG": "Hogsete", "RAM": "Rambera", "VES": "Veskre",
    "FAU": "Fauske", "VIK": "Vikesland", "ARH": "Arhelleren", "OVS": "Ovstedalen",
}

# --- fixed values: final spelling of three site names ----------------------
SITE_NAME_FIXES = {"Ulvhaugen": "Ulvehaugen", "Skjellingahaugen": "Skjelingahaugen", "Ovstedal": "Ovstedalen"}

# --- fixed values: biomass rounds to impute (year, site, blocks, round) ----
BIOMASS_ROUNDS = [
    (2016, "ALR", [5], "2"),
    (2016, "ARH", [1, 2, 3, 4], "1"),
    (2016, "FAU", [1, 2, 4, 5], "1"),
    (2016, "RAM", [4, 5, 6, 8], "1"),
    (2016, "VIK", [2, 3, 4, 5], "1"),
]

# --- fixed values: missing 2018 biomass dates (year, site, date); OVS twice -
BIOMASS_DATES = [
    (2018, "OVS", "2018-07-03"), (2018, "ARH", "2018-07-04"), (2018, "ULV", "2018-08-09"),
    (2018, "SKJ", "2018-08-16"), (2018, "FAU", "2018-07-10"), (2018, "LAV", "2018-08-14"),
    (2018, "HOG", "2018-07-05"), (2018, "VES", "2018-08-06"), (2018, "RAM", "2018-08-07"),
    (2018, "ALR", "2018-07-12"), (2018, "GUD", "2018-08-15"), (2018, "OVS", "2018-07-03"),
    (2018, "VIK", "2018-07-05"),
]

# --- fixed values: climate grid (site, biogeographic zone, precipitation level)
CLIMATE = [
    ("Ulvehaugen", "alpine", 1), ("Lavisdalen", "alpine", 2), ("Gudmedalen", "alpine", 3),
    ("Skjelingahaugen", "alpine", 4), ("Alrust", "sub.alpine", 1), ("Hogsete", "sub.alpine", 2),
    ("Rambera", "sub.alpine", 3), ("Veskre", "sub.alpine", 4), ("Fauske", "boreal", 1),
    ("Vikesland", "boreal", 2), ("Arhelleren", "boreal", 3), ("Ovstedalen", "boreal", 4),
]
CLIMATE_LEVELS = ["boreal1", "boreal2", "boreal3", "boreal4", "sub.alpine1", "sub.alpine2", "sub.alpine3",
                  "sub.alpine4", "alpine1", "alpine2", "alpine3", "alpine4"]
PLOT_TREATMENT_LEVELS = ["B", "F", "G", "FB", "GB", "FG", "FGB"]

# --- fixed values: reflectance site spellings -> site names ----------------
REFLECTANCE_SITES_2019 = {
    "Gudmesdalen": "Gudmedalen", "Låvisdalen": "Lavisdalen", "Rambæra": "Rambera", "Ulvehaugen": "Ulvehaugen",
    "Skjellingahaugen": "Skjelingahaugen", "Ålrust": "Alrust", "Arhelleren": "Arhelleren", "Fauske": "Fauske",
    "Høgsete": "Hogsete", "Øvstedal": "Ovstedalen", "Vikesland": "Vikesland", "Veskre": "Veskre",
}
REFLECTANCE_SITES_2021 = {
    "Gudmedalen": "Gudmedalen", "Låvisdalen": "Lavisdalen", "Rambæra": "Rambera", "Ulvhaugen": "Ulvehaugen",
    "Skjellingahaugen": "Skjelingahaugen", "Ålrust": "Alrust", "Arhelleren": "Arhelleren", "Fauske": "Fauske",
    "Høgsete": "Hogsete", "Øvstedal": "Ovstedalen", "Vikesland": "Vikesland", "Veskre": "Veskre",
}
# reflectance site codes (Fauske is "Fae" here)
REFLECTANCE_CODES = {
    "Gudmedalen": "Gud", "Lavisdalen": "Lav", "Rambera": "Ram", "Ulvehaugen": "Ulv", "Skjelingahaugen": "Skj",
    "Alrust": "Alr", "Arhelleren": "Arh", "Fauske": "Fae", "Hogsete": "Hog", "Ovstedalen": "Ovs",
    "Vikesland": "Vik", "Veskre": "Ves",
}

# --- fixed values: design of the 2021 metadata grid ------------------------
DESIGN_SITES = ["Arhelleren", "Alrust", "Fauske", "Gudmedalen", "Hogsete", "Lavisdalen", "Ovstedal", "Rambera",
                "Skjelingahaugen", "Ulvehaugen", "Veskre", "Vikesland"]
DESIGN_BLOCKS = [1, 2, 3, 4]
DESIGN_TREATMENTS = ["C", "F", "G", "B", "FB", "GB", "GF", "FGB"]


def site_codes_df(spark: SparkSession) -> DataFrame:
    return inline_table(spark, SITE_CODES, "old string, v2 string, v3 string, new string")


def ttc_turf_df(spark: SparkSession) -> DataFrame:
    return inline_table(spark, TTC_TURF, "TTtreat string, turfID string")


def biomass_rounds_df(spark: SparkSession) -> DataFrame:
    return inline_table(spark, BIOMASS_ROUNDS, "year int, site string, block array<int>, round_new string")


def biomass_dates_df(spark: SparkSession) -> DataFrame:
    from pyspark.sql import functions as F
    return (inline_table(spark, BIOMASS_DATES, "year int, site string, newdate string")
            .withColumn("newdate", F.to_date("newdate")))


def climate_df(spark: SparkSession) -> DataFrame:
    return inline_table(spark, CLIMATE, "siteID string, biogeographic_zone string, prep_level int")
