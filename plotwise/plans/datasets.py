"""One function per dataset: read the exported sheets, clean, write the tidy table.

Inputs are delimited files (a workbook is a folder with one file per sheet); every
reader has a declared schema. Each function writes header + ``NA`` text under ``out``
and returns the clean table, and ``dictionaries`` describes the tables that were written.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import semantics as S
from ..operators import quality as Q
from ..operators import reshape as R
from ..sources import io
from . import biomass as BM
from . import community as CM
from . import design as DG
from . import reflectance as RF
from . import soil_moisture as SM


_TYPES = {"number": T.DoubleType(), "time": T.TimestampType()}


def _schema(columns: str) -> T.StructType:
    """Comma-separated column names, each text unless marked ``:number`` or ``:time``."""
    parts = [c.strip().partition(":") for c in columns.split(",")]
    return T.StructType([T.StructField(name, _TYPES.get(kind, T.StringType())) for name, _, kind in parts])


# declared layouts of the exported sheets
_FOUR = "Measurement1, Measurement2, Measurement3, Measurement4, Weather, Recorder"
SM_2015_16 = _schema("date, site, block:number, turfID, treatment, removal, M1, M2, M3, M4, blockSD, Moisture, weather, recorder, comments")
SM_2017 = _schema("Date, Site, SCBlock...5:number, SCBlock...6:number, Turf ID, Treatment, " + _FOUR)
SM_2018 = _schema("Date:time, Site, FCBlock:number, turfID, Treatment, " + _FOUR)
NDVI_2019 = _schema("Site, Block:number, Treatment, TTC_ID, Time, notes, Date, Value1:number, Value2:number")
NDVI_2021 = _schema("Date, Time, Site, Block:number, Plot, Before.1:number, Before.2:number, After.1:number, After.2:number, notes")


def _write(df: DataFrame, out: str) -> DataFrame:
    io.write_csv(df, out)
    return df


def _read(spark: SparkSession, path: str, schema: T.StructType, sep: str = ",") -> DataFrame:
    """Text cells as read, the text ``NA`` and blanks missing, numbers parsed leniently, times by cast."""
    raw = io.read_delim_text(spark, path, schema.fieldNames(), sep=sep)
    cells = []
    for f in schema.fields:
        c = F.col(f"`{f.name}`")
        v = S.to_num(c) if isinstance(f.dataType, T.DoubleType) else c if isinstance(f.dataType, T.StringType) else c.try_cast(f.dataType)
        cells.append(v.alias(f.name))
    return raw.select(cells)


def biomass(spark: SparkSession, sheets: str, out: str) -> DataFrame:
    return _write(BM.clean_biomass(_read(spark, sheets, BM.RAW_SCHEMA)), out)


def soil_moisture(spark: SparkSession, path_2015_16: str, path_2017: str, path_2018: str, out: str) -> DataFrame:
    return _write(SM.soil_moisture(_read(spark, path_2015_16, SM_2015_16), _read(spark, path_2017, SM_2017),
                                   _read(spark, path_2018, SM_2018)), out)


def reflectance_2019(spark: SparkSession, path: str, out: str) -> DataFrame:
    return _write(RF.ndvi_2019(_read(spark, path, NDVI_2019)), out)


def reflectance_2021(spark: SparkSession, paths: list[str], out: str) -> DataFrame:
    return _write(RF.ndvi_2021(*[_read(spark, p, NDVI_2021, sep=";") for p in paths]), out)


def design(spark: SparkSession, out: str) -> DataFrame:
    return _write(DG.design_grid(spark), out)


def community(inputs: CM.CommunityInputs, staging: str, out: str) -> DataFrame:
    return _write(CM.community(inputs, staging), out)


def dictionaries(tables: Mapping[str, DataFrame], descriptions: DataFrame, out: str) -> DataFrame:
    """The data dictionary of every clean table, by table id, as one table."""
    parts = [Q.data_dictionary(df, descriptions, name).withColumn("TableID", F.lit(name)) for name, df in tables.items()]
    return _write(R.bind_rows(*parts), out)
