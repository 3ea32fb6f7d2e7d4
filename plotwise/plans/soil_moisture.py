"""Soil-moisture datasets 2015-2018: three per-year chains, one union.

The only shuffle is the 2015-16 pooled mean per (date, turf), an
aggregation joined back to its rows; the site/turf dictionaries are fixed
size and broadcast.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import semantics as S
from ..functions import temporal as TM
from ..operators import grouped as G
from ..operators import joins as J
from ..operators import reshape as R
from . import biomass
from . import dictionaries as D

OUT = ["date", "siteID", "blockID", "plotID", "treatment", "soilmoisture", "weather", "recorder", "turfID"]
_EXCLUDE_TURFS = ["TT1", "TT2", "TT3", "TT4", "RTC", "P"]  # fixed values: turf id fragments dropped


def _drop_turfs(df: DataFrame, col: str, patterns) -> DataFrame:
    for p in patterns:
        df = df.filter(~S.matches(col, p))
    return df


def sm_2015_16(raw: DataFrame) -> DataFrame:
    m = ["M1", "M2", "M3", "M4"]
    d = raw.withColumns({c: S.to_num(c) for c in m})
    d = d.filter(S.is_in("comments", ["fewer readings", "above table", "above table 100%"]) | F.col("comments").isNull())
    d = _drop_turfs(d, "turfID", _EXCLUDE_TURFS).filter(F.col("treatment").isNotNull())
    d = G.pooled_group_mean(d, ["date", "turfID"], m, "SM", extra={"sameDayMeasurement": F.count(F.lit(1))})
    codes = {old: new for old, _, _, new in D.SITE_CODES}
    d = d.withColumn("siteID", S.recode("site", codes))
    d = d.withColumn("removal", S.if_else_na(F.col("removal").isNull(), F.lit("C"), F.col("removal")))
    d = d.withColumn("FCturfID", S.if_else_na(F.col("removal").isNotNull(),
                                              S.paste(S.r_substr("siteID", 1, 3), F.col("block"), F.col("removal")),
                                              F.lit("")))
    d = d.withColumn("date", TM.parse_date("date", "yyyy-MM-dd"))
    d = d.filter(~(F.col("treatment") == "XC"))
    d = d.drop("treatment").withColumnRenamed("removal", "treatment")
    d = d.withColumn("blockID", S.paste(S.r_substr("siteID", 1, 3), F.col("block")))
    d = d.withColumn("siteID", S.recode("siteID", D.SITE_NAME_FIXES))
    return d.select("date", "siteID", "blockID", F.col("FCturfID").alias("plotID"), "treatment",
                    F.col("SM").alias("soilmoisture"), "weather", "recorder", "turfID")


def sm_2017(raw: DataFrame) -> DataFrame:
    m = ["Measurement1", "Measurement2", "Measurement3", "Measurement4"]
    d = raw.withColumn("Date", TM.mixed_date("Date"))
    d = d.withColumnRenamed("Turf ID", "turfID")
    d = _drop_turfs(d, "turfID", _EXCLUDE_TURFS)
    d = d.withColumns({c: S.to_num(c) for c in m})
    d = d.withColumn("soilmoisture", S.row_mean(*m))
    d = d.withColumn("Treatment", S.if_else_na(F.col("Treatment").isNull() & S.matches("turfID", "TTC"),
                                               F.lit("C"), F.col("Treatment")))
    d = d.filter(F.col("soilmoisture").isNotNull() & F.col("Treatment").isNotNull())
    d = d.withColumn("Site", S.recode("Site", D.SITE_FROM_FIELD_CODE))
    d = d.withColumn("block", F.coalesce(F.col("`SCBlock...5`"), F.col("`SCBlock...6`")))
    d = d.withColumn("blockID", S.paste(S.r_substr("Site", 1, 3), F.col("block")))
    d = d.withColumn("plotID", S.paste("blockID", "Treatment"))
    return d.select(F.col("Date").alias("date"), F.col("Site").alias("siteID"), "blockID", "plotID",
                    F.col("Treatment").alias("treatment"), "soilmoisture", F.col("Weather").alias("weather"),
                    F.col("Recorder").alias("recorder"), "turfID")


def sm_2018(raw: DataFrame, corrected: bool = False) -> DataFrame:
    """``corrected=True`` keeps the plot id and the block number (the
    recorded chain computes the plot id but drops it, and keeps only the site
    code as block)."""
    spark = raw.sparkSession
    m = ["Measurement1", "Measurement2", "Measurement3", "Measurement4"]
    sites = D.site_codes_df(spark).select("v2", "new")
    ttc = D.ttc_turf_df(spark)

    t = raw.filter(S.matches("turfID", "TTC"))
    t = t.withColumn("turfID", F.regexp_replace("turfID", "TTC ", ""))
    t = t.withColumn("turfID", S.if_else_na(F.char_length("turfID") < 4, F.concat(F.col("turfID"), F.lit(" TTC")),
                                            F.col("turfID")))
    t = t.withColumn("Treatment", F.lit("C")).withColumnsRenamed({"turfID": "TTtreat", "FCBlock": "blockID"})
    t = J.join(t, sites, [("Site", "v2")], "right", broadcast=True).drop("Site").withColumnRenamed("new", "siteID")
    t = J.join(t, ttc, None, "right", broadcast=True).filter(F.col("Measurement1").isNotNull())

    d = J.join(raw, sites, [("Site", "v2")], "right", broadcast=True).drop("Site")
    d = d.withColumnsRenamed({"new": "siteID", "FCBlock": "blockID"})
    d = d.filter(~S.matches("turfID", "T")).filter(~S.matches("turfID", "P"))
    d = R.bind_rows(d, t)
    d = d.withColumns({c: S.to_num(F.regexp_replace(F.col(c).cast("string"), "u", "0")) for c in m})
    d = d.withColumn("SM", S.row_mean(*m))
    d = d.withColumn("blockID", S.case_when([(F.col("turfID") == "Fau4C", 4.0), (F.col("turfID") == "Ulv2C", 2.0),
                                             (F.col("turfID") == "Gud12C", 12.0)], default=F.col("blockID")))
    plot = S.if_else_na(S.is_in("turfID", ["C", "B", "G", "F", "GF", "GB", "FB", "FGB"]),
                        S.paste(S.r_substr("siteID", 1, 3), S.r_str("blockID"), F.col("Treatment")), F.col("turfID"))
    if corrected:
        d = d.withColumn("plotID", plot).withColumn("blockID", S.paste(S.r_substr("siteID", 1, 3), S.r_str("blockID")))
    else:
        # plotID is computed but not kept (the output has no plotID for 2018)
        d = d.withColumn("blockID", S.r_substr("siteID", 1, 3))
    d = d.filter(F.col("Treatment").isNotNull())
    default = F.to_timestamp(F.lit("2018-07-02 00:00:00"))
    for site in ("Arhelleren", "Ovstedal"):  # tested before the site-name fix below
        d = d.withColumn("Date", S.if_else_na(F.col("Date").isNull() & (F.col("siteID") == site), default,
                                              F.col("Date")))
    d = d.withColumn("siteID", S.recode("siteID", D.SITE_NAME_FIXES))
    return d.select(F.col("Date").alias("date"), "siteID", "blockID", *(["plotID"] if corrected else []),
                    F.col("Treatment").alias("treatment"), F.col("SM").alias("soilmoisture"),
                    F.col("Weather").alias("weather"), F.col("Recorder").alias("recorder"), "turfID")


def with_climate(clean: DataFrame) -> DataFrame:
    """Zone, precipitation level and ordered climate label of each reading's site."""
    return biomass.with_climate(clean)


def soil_moisture(raw1516: DataFrame, raw2017: DataFrame, raw2018: DataFrame) -> DataFrame:
    """Union by name: dates (2015-2017) and date-times (2018) become
    date-times; 2018 rows have no plotID."""
    return R.bind_rows(sm_2015_16(raw1516), sm_2017(raw2017), sm_2018(raw2018)).select(*OUT)
