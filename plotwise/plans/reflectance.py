"""Reflectance (NDVI) datasets: 2019 single reading pairs, 2021 pre/post cut.

Narrow chains only (no shuffle): recodes, id building, pair means, unpivot.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import semantics as S
from ..functions import temporal as TM
from ..operators import reshape as R
from . import dictionaries as D

OUT_2019 = ["siteID", "blockID", "plotID", "Treatment", "TTC_ID", "pre_post_cut", "date", "Time", "m_ndvi", "notes"]
OUT_2021 = ["siteID", "blockID", "plotID", "Treatment", "pre_post_cut", "date", "Time", "m_ndvi", "notes"]


def _codes(corrected: bool) -> dict:
    """Site codes; the recorded table codes Fauske "Fae", ``corrected``
    uses "Fau" as everywhere else."""
    return {**D.REFLECTANCE_CODES, "Fauske": "Fau"} if corrected else D.REFLECTANCE_CODES


def ndvi_2019(raw: DataFrame, corrected: bool = False) -> DataFrame:
    d = raw.withColumn("siteID", S.recode("Site", D.REFLECTANCE_SITES_2019))
    d = d.withColumn("Site_Code", S.recode("siteID", _codes(corrected)))
    d = d.withColumn("blockID", S.paste("Site_Code", "Block"))
    d = d.withColumn("plotID", S.paste("blockID", "Treatment"))
    d = d.withColumn("date", TM.parse_date_2digit_year("Date", "M/d/yy"))
    d = d.withColumn("m_ndvi", (F.col("Value1") + F.col("Value2")) / 2)
    d = d.withColumn("pre_post_cut", F.lit("post_cut"))
    return d.select(*OUT_2019)


def ndvi_2021(*weeks: DataFrame, corrected: bool = False) -> DataFrame:
    """``corrected=True`` averages both pre-cut readings (the recorded
    computation adds the first reading to itself) and codes Fauske "Fau"."""
    d = R.bind_rows(*weeks)
    d = d.withColumn("date", TM.format_date(TM.parse_date("Date", "d.M.yyyy")))
    d = d.withColumn("siteID", S.recode("Site", D.REFLECTANCE_SITES_2021))
    d = d.withColumn("Site_Code", S.recode("siteID", _codes(corrected)))
    d = d.withColumn("blockID", S.paste("Site_Code", "Block"))
    d = d.withColumn("plotID", S.paste("blockID", "Plot"))
    d = d.withColumn("Treatment", F.col("Plot"))
    d = d.withColumn("m_ndvi_after", (F.col("`After.1`") + F.col("`After.2`")) / 2)
    # the pre-cut "mean" adds the first reading to itself, as recorded
    second = F.col("`Before.2`") if corrected else F.col("`Before.1`")
    d = d.withColumn("m_ndvi_before", (F.col("`Before.1`") + second) / 2)
    ids = [c for c in d.columns if c not in ("m_ndvi_before", "m_ndvi_after")]
    long = R.to_long(d, ids, ["m_ndvi_before", "m_ndvi_after"], "pre_post_cut", "m_ndvi")
    long = long.withColumn("pre_post_cut",
                           S.recode("pre_post_cut", {"m_ndvi_before": "pre_cut", "m_ndvi_after": "post_cut"}))
    return long.select(*OUT_2021)
